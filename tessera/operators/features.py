"""Fitted feature stages.

Fitted artefacts (category lists, means, medians, modes) are model-sized and are
fitted on the training rows only; ``transform`` is a pure projection (or a join
with a per-group statistic), so applying a stage to a large or streaming
DataFrame adds no shuffle unless a grouped statistic is involved.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml import Estimator, Model, Pipeline
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.operators.clean import literal_map

__all__ = ["DummyEncoder", "DummyModel", "LabelEncoder", "LabelModel", "one_hot_stages", "Standardizer",
           "StandardizerModel", "MedianImputer", "MedianImputerModel", "ImputeRules", "ImputeRulesModel",
           "hash_unit", "hash_split", "stratified_split", "kfold", "pipeline"]


MAX_CATEGORIES = 10_000


def _sorted_distinct(df: DataFrame, col: str, limit: int = MAX_CATEGORIES) -> list:
    """Distinct values in order; a column with more than ``limit`` is an error, since every
    value becomes an output column or an entry of a literal map."""
    vals = [r[0] for r in df.select(col).where(F.col(col).isNotNull()).distinct().limit(limit + 1).collect()]
    if len(vals) > limit:
        raise ValueError(f"{col} has more than {limit} categories; join a table of codes instead")
    return sorted(vals)


class DummyEncoder(Estimator):
    """One 0/1 column per category of each input column, categories sorted, the
    first one dropped (``drop_first``).  NULL and unseen values give all zeros.
    Output columns are named ``{col}_{value}``."""

    def __init__(self, inputCols: Sequence[str], dropFirst: bool = True, dropInput: bool = True):
        super().__init__()
        self.inputCols, self.dropFirst, self.dropInput = list(inputCols), dropFirst, dropInput

    def _fit(self, df: DataFrame) -> "DummyModel":
        cats = {c: _sorted_distinct(df, c) for c in self.inputCols}
        return DummyModel(cats, self.dropFirst, self.dropInput)


class DummyModel(Model):
    def __init__(self, categories: Mapping[str, list], dropFirst: bool = True, dropInput: bool = True):
        super().__init__()
        self.categories, self.dropFirst, self.dropInput = dict(categories), dropFirst, dropInput

    def output_columns(self) -> list[str]:
        out = []
        for c, vals in self.categories.items():
            out += [f"{c}_{v}" for v in (vals[1:] if self.dropFirst else vals)]
        return out

    def _transform(self, df: DataFrame) -> DataFrame:
        new = {}
        for c, vals in self.categories.items():
            for v in (vals[1:] if self.dropFirst else vals):
                new[f"{c}_{v}"] = F.when(F.col(c) == F.lit(v), 1).otherwise(0)
        out = df.withColumns(new)
        return out.drop(*self.categories) if self.dropInput else out


class LabelEncoder(Estimator):
    """Codes 0..K-1 in sorted order of the distinct values (numbers sort as numbers)."""

    def __init__(self, inputCol: str, outputCol: str | None = None):
        super().__init__()
        self.inputCol, self.outputCol = inputCol, outputCol or f"{inputCol}_code"

    def _fit(self, df: DataFrame) -> "LabelModel":
        return LabelModel(self.inputCol, self.outputCol, _sorted_distinct(df, self.inputCol))


class LabelModel(Model):
    def __init__(self, inputCol: str, outputCol: str, labels: list):
        super().__init__()
        self.inputCol, self.outputCol, self.labels = inputCol, outputCol, list(labels)

    def _transform(self, df: DataFrame) -> DataFrame:
        m = literal_map({v: i for i, v in enumerate(self.labels)})
        return df.withColumn(self.outputCol, F.element_at(m, F.col(self.inputCol)))


def one_hot_stages(inputCols: Sequence[str], suffix: str = "_ohe") -> list:
    """Every distinct value is a category; unknown and NULL -> all zeros.

    ``StringIndexer(handleInvalid='keep')`` reserves one extra index for them and
    ``OneHotEncoder(dropLast=True)`` drops exactly that slot.
    """
    from pyspark.ml.feature import OneHotEncoder, StringIndexer

    idx = [f"{c}__idx" for c in inputCols]
    return [StringIndexer(inputCols=list(inputCols), outputCols=idx, handleInvalid="keep",
                          stringOrderType="alphabetAsc"),
            OneHotEncoder(inputCols=idx, outputCols=[f"{c}{suffix}" for c in inputCols], dropLast=True)]


class Standardizer(Estimator):
    """``(x - mean) / population std`` fitted in one aggregate; zero std -> 0."""

    def __init__(self, inputCols: Sequence[str], suffix: str = ""):
        super().__init__()
        self.inputCols, self.suffix = list(inputCols), suffix

    def _fit(self, df: DataFrame) -> "StandardizerModel":
        aggs = []
        for c in self.inputCols:
            aggs += [F.avg(c).alias(f"m_{c}"), F.stddev_pop(c).alias(f"s_{c}")]
        row = df.agg(*aggs).first()
        stats = {c: (row[f"m_{c}"], row[f"s_{c}"]) for c in self.inputCols}
        return StandardizerModel(stats, self.suffix)


class StandardizerModel(Model):
    def __init__(self, stats: Mapping[str, tuple], suffix: str = ""):
        super().__init__()
        self.stats, self.suffix = dict(stats), suffix

    def _transform(self, df: DataFrame) -> DataFrame:
        new = {}
        for c, (m, s) in self.stats.items():
            x = F.col(c).cast("double")
            new[f"{c}{self.suffix}"] = (F.lit(0.0) if not s else (x - F.lit(m)) / F.lit(s))
        return df.withColumns(new)


class MedianImputer(Estimator):
    """NULLs take the exact median of their column (all columns in one job)."""

    def __init__(self, inputCols: Sequence[str]):
        super().__init__()
        self.inputCols = list(inputCols)

    def _fit(self, df: DataFrame) -> "MedianImputerModel":
        from tessera.operators.aggregate import exact_quantiles

        long = df.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column_name"),
                                                      F.col(c).cast("double").alias("value"))
                                             for c in self.inputCols])).alias("kv")).select("kv.*")
        med = exact_quantiles(long, "value", [0.5], by=["column_name"], prefix="m").collect()
        return MedianImputerModel({r["column_name"]: r["m0"] for r in med})


class MedianImputerModel(Model):
    def __init__(self, medians: Mapping[str, float]):
        super().__init__()
        self.medians = dict(medians)

    def _transform(self, df: DataFrame) -> DataFrame:
        return df.withColumns({c: F.coalesce(F.col(c), F.lit(v)) for c, v in self.medians.items()
                               if v is not None})


class ImputeRules(Estimator):
    """Group median, global median and mode fills as one fitted stage.

    ``group_median`` maps column -> group keys; ``median`` and ``mode`` list columns.
    Statistics come from the fitting rows.  For parity with refit-on-test flows,
    ``refit_medians=True`` makes ``transform`` recompute both median kinds on the
    rows it is given (modes stay fitted).
    """

    def __init__(self, group_median: Mapping[str, Sequence[str]] | None = None,
                 median: Sequence[str] = (), mode: Sequence[str] = (), refit_medians: bool = False):
        super().__init__()
        self.group_median = {k: list(v) for k, v in (group_median or {}).items()}
        self.median, self.mode, self.refit = list(median), list(mode), refit_medians

    def _fit(self, df: DataFrame) -> "ImputeRulesModel":
        from tessera.operators.aggregate import mode as mode_of

        modes = {}
        for c in self.mode:
            r = mode_of(df, c, alias="m").first()
            modes[c] = r["m"] if r else None
        model = ImputeRulesModel(self.group_median, self.median, modes, self.refit)
        if not self.refit:
            model.fit_medians(df)
        return model


class ImputeRulesModel(Model):
    def __init__(self, group_median, median, modes, refit):
        super().__init__()
        self.group_median, self.median, self.modes, self.refit = group_median, median, modes, refit
        self.group_tables: dict[str, DataFrame] = {}
        self.medians: dict[str, float] = {}

    def fit_medians(self, df: DataFrame) -> None:
        from tessera.operators.aggregate import group_median
        from tessera.session import cut_lineage

        # one row per group: small, checkpointed so later transforms do not recompute it
        self.group_tables = {c: cut_lineage(group_median(df, c, keys, alias=f"__gm_{c}"))
                             for c, keys in self.group_median.items()}
        if self.median:
            self.medians = MedianImputer(self.median).fit(df).medians

    def _transform(self, df: DataFrame) -> DataFrame:
        if self.refit:
            self.fit_medians(df)
        out = df
        for c, keys in self.group_median.items():
            out = (out.join(self.group_tables[c], keys, "left")
                      .withColumn(c, F.coalesce(F.col(c), F.col(f"__gm_{c}"))).drop(f"__gm_{c}"))
        out = out.withColumns({c: F.coalesce(F.col(c), F.lit(v)) for c, v in self.medians.items() if v is not None})
        return out.withColumns({c: F.coalesce(F.col(c), F.lit(v)) for c, v in self.modes.items() if v is not None})


def hash_unit(key, seed: int = 42):
    """Stable pseudo-uniform number in [0, 1) from a key: first 32 bits of md5(seed:key)."""
    k = F.col(key) if isinstance(key, str) else key
    h = F.md5(F.concat(F.lit(f"{seed}:"), k.cast("string")))
    return F.conv(F.substring(h, 1, 8), 16, 10).cast("long") / F.lit(4294967296.0)


def hash_split(df: DataFrame, key: str, test_frac: float = 0.25, seed: int = 42,
               flag: str = "is_test") -> DataFrame:
    """Deterministic split by key hash; stable under repartitioning and retries."""
    return df.withColumn(flag, hash_unit(key, seed) < F.lit(float(test_frac)))


def stratified_split(df: DataFrame, key: str, label: str, test_frac: float = 0.25, seed: int = 42,
                     flag: str = "is_test") -> DataFrame:
    """Per class, the ``ceil(frac * n_class)`` rows with the smallest key hash are test.

    The position inside a class is a distributed prefix count (no per-class task).
    """
    from tessera.operators.windows import ordinal

    h = df.withColumn("__h", hash_unit(key, seed))
    pos = ordinal(h, [label], ["__h", key], "__o")
    sizes = df.groupBy(label).agg(F.count(F.lit(1)).alias("__n"))
    out = pos.join(sizes, [label], "left")
    return (out.withColumn(flag, F.col("__o") < F.ceil(F.col("__n") * F.lit(float(test_frac))))
               .drop("__h", "__o", "__n"))


def kfold(df: DataFrame, k: int, order: Sequence[str], label: str | None = None, name: str = "fold") -> DataFrame:
    """Fold column for ``CrossValidator(foldCol=...)`` (contiguous, stratified if ``label``)."""
    from tessera.operators.windows import assign_folds

    return assign_folds(df, label, k, order, name)


def pipeline(stages: Sequence) -> Pipeline:
    """X9."""
    return Pipeline(stages=list(stages))
