"""User function surfaces.

* U1 -- a per-row user function over columns: ``vectorized`` wraps a pandas
  function as an Arrow-batched ``pandas_udf`` (never a row-at-a-time UDF).
* U2 -- a group function that keeps the row count is served by windows and by
  grouped statistics joined back (``windows.fill_group_median``), not by
  gathering groups in Python.
* U3 -- user estimators subclass ``pyspark.ml.Estimator`` / ``Model`` (see
  ``operators.models.LinearRegressionGD`` and ``operators.features``).
* U4 -- user metrics are functions DataFrame -> one-row DataFrame (see
  ``operators.evaluate``); ``metric_row`` applies several and joins them.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

__all__ = ["vectorized", "metric_row"]


def vectorized(fn: Callable, return_type: str = "double"):
    """``fn(pd.Series, ...) -> pd.Series`` as a pandas UDF (Arrow batches)."""
    return F.pandas_udf(fn, return_type)


def metric_row(df: DataFrame, metrics: Mapping[str, Callable[[DataFrame], DataFrame]]) -> DataFrame:
    """U4: apply one-row metric functions and put their columns side by side."""
    out = None
    for name, m in metrics.items():
        r = m(df).limit(2)
        if r.count() > 1:
            raise ValueError(f"metric {name} gave more than one row")
        r = r.select(*[F.col(c).alias(f"{name}_{c}") for c in r.columns]).withColumn("__k", F.lit(1))
        out = r if out is None else out.join(F.broadcast(r), "__k")
    return out.drop("__k")
