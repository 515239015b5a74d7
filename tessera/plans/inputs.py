"""Stand-in inputs derived from the shared tables.

The reference's own inputs are not available, so each reference input is mapped
to a driver table (see FIXTURES.md section E).  NULLs are induced by fixed rules,
identical in the Spark plans and in the SQL oracles.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.operators.clean import threshold_label
from tessera.session import table


def nation_code(col) -> F.Column:
    """Digit-free nation label, e.g. 0 -> 'NA', 12 -> 'NBC' (digits mapped to letters)."""
    return F.concat(F.lit("N"), F.translate(col.cast("string"), "0123456789", "ABCDEFGHIJ"))


def passengers(spark: SparkSession, d: str) -> DataFrame:
    """events as passengers: value (age-like) NULL where event_id % 7 = 0,
    props.k (fare-like) NULL where event_id % 5 = 0, event_type NULL where event_id % 9 = 0."""
    ev = table(spark, d, "events")
    k = F.get_json_object("props", "$.k").cast("double")
    return ev.select(
        "event_id", "user_id", "ts",
        F.when(F.col("event_id") % 9 == 0, F.lit(None)).otherwise(F.col("event_type")).alias("event_type"),
        F.col("event_type").alias("group_type"),
        F.when(F.col("event_id") % 7 == 0, F.lit(None)).otherwise(F.col("value")).alias("value"),
        F.when(F.col("event_id") % 5 == 0, F.lit(None)).otherwise(k).alias("k"))


def scored_lines(spark: SparkSession, d: str) -> DataFrame:
    """lineitem as a scored binary problem: y = returnflag 'R', fixed score in [0, 0.9]."""
    li = table(spark, d, "lineitem")
    p = F.col("l_discount") * 5 + F.col("l_tax") * 5
    return li.select("l_orderkey", "l_linenumber", (F.col("l_returnflag") == "R").cast("int").alias("y"),
                     p.alias("p"), threshold_label(p, 0.5).alias("pred"))
