"""Projections, filters and predicates.

Every function takes and returns a DataFrame and only adds Project/Filter nodes,
so Catalyst keeps pruning columns and pushing filters into the Parquet scan.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.functions.scalar import col_of, nan_to_null

__all__ = [
    "drop_columns", "drop_positions", "rename_all", "rename", "select_cols",
    "select_numeric", "add_column", "where", "null_if", "remap_keep", "remap_null",
    "lookup", "cast_col", "threshold_label", "fill_null", "split_features_target",
    "nulls_from_nan", "literal_map",
]


def drop_columns(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Absent names are ignored."""
    return df.drop(*names)


def drop_positions(df: DataFrame, positions: Sequence[int]) -> DataFrame:
    """Drop columns by 0-based position."""
    gone = {df.columns[i] for i in positions}
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c not in gone])


def rename_all(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Give every column a new name, in order."""
    return df.toDF(*names)


def rename(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """Rename some columns; unknown names are ignored."""
    return df.withColumnsRenamed({k: v for k, v in mapping.items() if k in df.columns})


def select_cols(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """P4."""
    return df.select(*names)


def select_numeric(df: DataFrame) -> DataFrame:
    """P5: keep numeric columns only (chosen from the schema, no data read)."""
    return df.select(*[f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)])


def add_column(df: DataFrame, name: str, expr: Column) -> DataFrame:
    """P6."""
    return df.withColumn(name, expr)


def where(df: DataFrame, cond: Column) -> DataFrame:
    """A plain predicate; Catalyst pushes it into the scan."""
    return df.where(cond)


def null_if(df: DataFrame, cols: Sequence[str], sentinel: str = "...", to_type: str = "double") -> DataFrame:
    """Sentinel text becomes NULL, then the column is typed (bad text -> NULL)."""
    return df.withColumns({c: F.nullif(F.trim(F.col(c).cast("string")), F.lit(sentinel)).try_cast(to_type)
                           for c in cols})


def literal_map(mapping: Mapping) -> Column:
    """A tiny fixed dictionary as a map literal (no join needed)."""
    items = []
    for k, v in mapping.items():
        items += [F.lit(k), F.lit(v)]
    return F.create_map(*items)


def remap_keep(df: DataFrame, col: str, mapping, key: str = "key", value: str = "value") -> DataFrame:
    """Replace matched values, keep unmatched ones.

    ``mapping`` is either a small dict (map literal) or a DataFrame
    ``(key, value)``.  A DataFrame mapping is joined; Spark broadcasts it when
    its measured size is under ``spark.sql.autoBroadcastJoinThreshold`` and
    shuffles otherwise.
    """
    if isinstance(mapping, Mapping):
        m = literal_map(mapping)
        return df.withColumn(col, F.coalesce(F.element_at(m, F.col(col)), F.col(col)))
    m = mapping.select(F.col(key).alias("__k"), F.col(value).alias("__v")) \
        .groupBy("__k").agg(F.min("__v").alias("__v"))  # a repeated key gives its smallest value
    return (df.join(m, F.col(col) == F.col("__k"), "left")
              .withColumn(col, F.coalesce(F.col("__v"), F.col(col)))
              .drop("__k", "__v"))


def remap_null(df: DataFrame, col: str, mapping, out: str | None = None,
               key: str = "key", value: str = "value") -> DataFrame:
    """P10: mapped value, NULL when the value has no entry."""
    out = out or col
    if isinstance(mapping, Mapping):
        return df.withColumn(out, F.element_at(literal_map(mapping), F.col(col)))
    m = mapping.select(F.col(key).alias("__k"), F.col(value).alias("__v")) \
        .groupBy("__k").agg(F.min("__v").alias("__v"))  # a repeated key gives its smallest value
    return (df.join(m, F.col(col) == F.col("__k"), "left")
              .withColumn(out, F.col("__v")).drop("__k", "__v"))


def lookup(df: DataFrame, key_col: str, key_value, col: str) -> DataFrame:
    """One cell by label, kept as a (at most) one-row DataFrame."""
    return df.where(F.col(key_col) == F.lit(key_value)).select(col)


def cast_col(df: DataFrame, col: str, to_type: str, strict: bool = False) -> DataFrame:
    """``try_cast`` by default (bad values -> NULL), ``cast`` when strict."""
    c = F.col(col)
    return df.withColumn(col, c.cast(to_type) if strict else c.try_cast(to_type))


def threshold_label(prob, t: float) -> Column:
    """``prob >= t`` as 0/1."""
    return (col_of(prob) >= F.lit(float(t))).cast("int")


def fill_null(df: DataFrame, values: Mapping[str, object] | None = None, **fills) -> DataFrame:
    """Fill NULLs per column with literal values or columns (e.g. fitted statistics)."""
    values = dict(values or {}, **fills)
    return df.withColumns({c: F.coalesce(F.col(c), v if isinstance(v, Column) else F.lit(v))
                           for c, v in values.items()})


def split_features_target(df: DataFrame, target: str, features: Sequence[str] | None = None,
                          out: str = "features") -> DataFrame:
    """One vector column of features next to the label column."""
    from pyspark.ml.feature import VectorAssembler

    feats = list(features) if features else [c for c in df.columns if c != target]
    return VectorAssembler(inputCols=feats, outputCol=out, handleInvalid="keep").transform(df)


def nulls_from_nan(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Entry rule: NaN -> NULL for floating columns."""
    floats = {f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))}
    cols = [c for c in (cols or df.columns) if c in floats]
    return df.withColumns({c: nan_to_null(c) for c in cols})
