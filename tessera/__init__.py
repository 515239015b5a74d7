"""tessera: Spark-native analytics toolkit.

Table cleaning, joins, grouped statistics, ordered-series windows, group-rule
filters, fitted feature stages, model training/evaluation through pyspark.ml
and distributed clustering, all written as Spark DataFrame jobs.
"""

from tessera.session import get_session, table, ensure_checkpoint_dir, cut_lineage

__all__ = ["get_session", "table", "ensure_checkpoint_dir", "cut_lineage"]
