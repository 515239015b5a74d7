"""File sources and sinks.

Skipping a preamble or a footer needs each line's position in its file.  Lines
are read by the text reader (blank lines are lines; LF, CRLF and CR end one) and
decoded from their bytes, ordered inside their file by (split start offset, row id
within the split), and numbered with the distributed prefix count of
``windows.ordinal`` -- no file is funnelled through one task or the driver.
"""

from __future__ import annotations

from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

__all__ = ["read_csv", "read_lines", "read_csv_skip", "read_sheet", "load_table", "load_arrays",
           "write_csv", "preview"]


def read_csv(spark: SparkSession, path: str, schema: str | None = None, header: bool = True,
             encoding: str = "UTF-8") -> DataFrame:
    """Header line, quoted fields may hold commas; a fixed schema avoids an inference pass."""
    r = spark.read.option("header", header).option("quote", '"').option("escape", '"').option("encoding", encoding)
    if schema:
        return r.schema(schema).csv(path)
    return r.option("inferSchema", True).csv(path)


_SPARK_CHARSETS = {"US-ASCII", "ISO-8859-1"}


def _decoded(raw: Column, encoding: str) -> Column:
    """Text of a line's bytes, in any charset whose line ends are single bytes."""
    name = encoding.upper().replace("_", "-")
    if name in ("UTF-8", "UTF8"):
        return raw.cast("string")
    if name in _SPARK_CHARSETS:
        return F.decode(raw, name)

    def decode(s: pd.Series) -> pd.Series:
        return s.map(lambda b: bytes(b).decode(encoding))

    return F.pandas_udf(decode, "string")(raw)


def read_lines(spark: SparkSession, path: str, encoding: str = "UTF-8") -> DataFrame:
    """Every line of the file(s) with its file name and 0-based position (``line_no``) in that file."""
    from tessera.operators.windows import ordinal

    raw = (spark.read.text(path)
                .select(_decoded(F.col("value").cast("binary"), encoding).alias("value"),
                        F.col("_metadata.file_path").alias("file"),
                        F.col("_metadata.file_block_start").alias("block"),
                        F.monotonically_increasing_id().alias("rid")))
    return ordinal(raw, ["file"], ["block", "rid"], "line_no").select("file", "line_no", "value")


def read_csv_skip(spark: SparkSession, path: str, skip_rows: int = 0, skip_footer: int = 0,
                  schema: str | None = None, encoding: str = "UTF-8") -> DataFrame:
    """Drop ``skip_rows`` preamble lines and ``skip_footer`` trailing lines of each
    file; the next line is the header.  Columns are typed by ``schema`` (DDL, names in
    file order) or else named from the header and kept as text."""
    lines = read_lines(spark, path, encoding)
    totals = lines.groupBy("file").agg(F.count(F.lit(1)).alias("__total"))
    body = lines.join(totals, "file").where(
        (F.col("line_no") >= skip_rows) & (F.col("line_no") < F.col("__total") - skip_footer))
    if schema is None:
        head = body.where(F.col("line_no") == skip_rows).select("value").first()
        if head is None:
            raise ValueError(f"no header line after {skip_rows} skipped rows in {path}")
        names = next(iter(spark.createDataFrame([(head[0],)], "v string")
                          .select(F.from_csv("v", ",".join(f"c{i} string" for i in range(head[0].count(",") + 1)))
                                  .alias("s")).select("s.*").collect()))
        schema = ", ".join(f"`{n}` string" for n in names)
    rows = body.where(F.col("line_no") > skip_rows)
    parsed = rows.select(F.from_csv("value", schema, {"quote": '"', "escape": '"'}).alias("r"))
    return parsed.select("r.*")


def read_sheet(spark: SparkSession, path: str, skip_rows: int = 0, skip_footer: int = 0,
               schema: str | None = None, encoding: str = "UTF-8") -> DataFrame:
    """S3: a spreadsheet exported as CSV (binary workbooks are read through their export)."""
    return read_csv_skip(spark, path, skip_rows, skip_footer, schema, encoding)


def load_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """S5."""
    from tessera.session import table

    return table(spark, sf_dir, name)


def load_arrays(spark: SparkSession, path: str, features: str, label: str, scale: float = 255.0,
                id_col: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Tensor features (nested arrays are flattened) scaled by ``1/scale``, the
    label column, and the class list as a DataFrame of distinct labels."""
    from pyspark.sql import types as T

    df = spark.read.parquet(path)
    x = F.col(features)
    dt = df.schema[features].dataType
    while isinstance(dt, T.ArrayType) and isinstance(dt.elementType, T.ArrayType):
        x = F.flatten(x)
        dt = dt.elementType
    cols = [id_col] if id_col else []
    out = df.select(*cols, F.transform(x, lambda v: v.cast("double") / F.lit(float(scale))).alias("x"),
                    F.col(label).alias("label"))
    classes = df.select(F.col(label).alias("label")).distinct()
    return out, classes


def write_csv(df: DataFrame, path: str, partition_by: Sequence[str] | None = None, header: bool = True) -> None:
    """Header, no index; one folder per value of ``partition_by`` (e.g. per model)."""
    w = df.write.mode("overwrite").option("header", header)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.csv(path)


def preview(df: DataFrame, n: int = 5) -> tuple[DataFrame, int, int]:
    """First rows, row count and column count."""
    return df.limit(n), df.count(), len(df.columns)
