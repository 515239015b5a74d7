"""Query plans over the shared tables, one per operator group of the inventory.

Each function takes ``(spark, sf_dir)`` and returns a lazy DataFrame whose
computed columns carry the same names as the SQL oracle's.  Doubles are rounded
in the last projection (sum order differs between engines).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera.functions import scalar as S
from tessera.operators import aggregate as A
from tessera.operators import clean as P
from tessera.operators import evaluate as E
from tessera.operators import features as X
from tessera.operators import groups as G
from tessera.operators import joins as J
from tessera.operators import order as O
from tessera.operators import windows as W
from tessera.plans.inputs import nation_code, passengers, scored_lines
from tessera.session import table

# fixed values: label rewrites applied to two of the sources (unmatched labels stay)
RENAMED = {"NA": "Nation Alpha", "NB": "Nation Bravo", "NC": "Nation Charlie"}

# zone of a nation by a rule on its number; multiples of nine have none (their rows drop)
ZONES = {f"NATION_{k}": f"zone {k % 5}" for k in range(25) if k % 9}



def _r(c, n=4):
    return F.round(c, n)


# ----------------------------------------------------------------------------- 2.1-2.4 tables

def clean_join(spark: SparkSession, d: str) -> DataFrame:
    """Three sources cleaned to one country key and joined."""
    nat = table(spark, d, "nation")
    raw = nat.select(
        F.concat(nation_code(F.col("n_nationkey")), F.lit(" ("), F.col("n_regionkey").cast("string"),
                 F.lit(")"), F.col("n_nationkey").cast("string")).alias("raw"),
        "n_regionkey",
        F.when(F.col("n_nationkey") % 4 == 0, F.lit("...")).otherwise(
            (F.col("n_nationkey") * 10).cast("string")).alias("supply"))
    energy = raw.withColumn("Country", F.trim(S.strip_digits(S.strip_parens("raw", trim=False))))
    energy = P.rename_all(energy, ["raw", "n_regionkey", "supply", "Country"])
    energy = P.null_if(energy, ["supply"])
    energy = P.add_column(energy, "supply_gj", F.col("supply") * 1000000)
    energy = P.remap_keep(P.drop_columns(P.drop_positions(energy, [0]), ["supply"]), "Country", RENAMED)
    cust = P.cast_col(P.where(table(spark, d, "customer"), F.col("c_acctbal") <= 9000), "c_acctbal", "double")
    gdp = (cust.groupBy("c_nationkey")
               .agg(F.count(F.lit(1)).alias("customers"), F.avg("c_acctbal").alias("avg_acctbal"))
               .withColumn("Country", nation_code(F.col("c_nationkey"))))
    gdp = P.remap_keep(gdp, "Country", RENAMED).drop("c_nationkey")
    reg = P.rename(table(spark, d, "region"), {"r_regionkey": "n_regionkey", "r_name": "region"})
    out = J.inner_join(J.inner_join(energy, gdp, "Country"), reg, "n_regionkey")
    return P.select_cols(out.select("Country", "region", "supply_gj", "customers",
                                    _r(F.col("avg_acctbal")).alias("avg_acctbal")),
                         ["Country", "region", "supply_gj", "customers", "avg_acctbal"])


def _yearly(spark, d):
    li = table(spark, d, "lineitem")
    three = F.col("l_linenumber") == 3
    five = F.col("l_linenumber") == 5
    return li.select(
        "l_orderkey", "l_linenumber",
        F.when(three | five, F.lit(None)).otherwise(F.col("l_quantity")).alias("c1"),
        F.when(five, F.lit(None)).otherwise(F.col("l_extendedprice") / 1000).alias("c2"),
        F.when(five, F.lit(None)).otherwise(F.col("l_discount") * 100).alias("c3"),
        F.when(three | five, F.lit(None)).otherwise(F.col("l_tax") * 100).alias("c4"))


def row_mean_rank(spark: SparkSession, d: str) -> DataFrame:
    """Mean across columns (NULLs skipped), top 10 rows with their positions."""
    y = _yearly(spark, d).withColumn("row_mean", A.row_mean(["c1", "c2", "c3", "c4"]))
    top = O.top_k(y, "row_mean", 10, desc=True, tiebreak=["l_orderkey", "l_linenumber"])
    w = Window.orderBy(F.col("row_mean").desc_nulls_last(), "l_orderkey", "l_linenumber")
    return top.select("l_orderkey", "l_linenumber", _r(F.col("row_mean")).alias("row_mean"),
                      (F.row_number().over(w) - 1).cast("long").alias("position"))


def ratio_argmax(spark: SparkSession, d: str) -> DataFrame:
    """Customer with the largest finished-order share of spend."""
    o = table(spark, d, "orders")
    per = o.groupBy("o_custkey").agg(
        F.sum(F.when(F.col("o_orderstatus") == "F", F.col("o_totalprice")).otherwise(0.0)).alias("f"),
        F.sum("o_totalprice").alias("t"))
    per = P.add_column(per, "ratio", S.safe_div("f", "t"))
    best = A.arg_max(per, "o_custkey", "ratio")
    return best.select("o_custkey", _r(F.col("ratio"), 6).alias("max_ratio"))


def nth_label(spark: SparkSession, d: str) -> DataFrame:
    """Third customer by account balance (descending, NULLs last)."""
    c = table(spark, d, "customer")
    return W.nth_by_order(c, "c_acctbal", 2, desc=True, tiebreak=["c_custkey"]).select(
        "c_custkey", "c_name", "c_acctbal", F.col("position").cast("int").alias("position"))


def lookup_cell(spark: SparkSession, d: str) -> DataFrame:
    """Cells of the sixth customer by balance, looked up by its key; ``nation`` is the
    one cell looked up by label in the nation table."""
    c = table(spark, d, "customer")
    sixth = W.nth_by_order(c, "c_acctbal", 5, desc=True, tiebreak=["c_custkey"]).select("c_custkey")
    cell = P.lookup(table(spark, d, "nation"), "n_nationkey", 3, "n_name").withColumnRenamed("n_name", "nation")
    row = J.semi_join(c, sixth, "c_custkey").select("c_custkey", "c_mktsegment", "c_acctbal", F.lit(1).alias("one"))
    return J.inner_join(row, cell.withColumn("one", F.lit(1)), "one").drop("one")


def corr_pair(spark: SparkSession, d: str) -> DataFrame:
    """A5: Pearson correlation per return flag; NULL pairs skipped."""
    li = table(spark, d, "lineitem")
    q = F.when(F.col("l_linenumber") == 3, F.lit(None)).otherwise(F.col("l_quantity"))
    return (A.corr(li.withColumn("q", q), "q", "l_extendedprice", by=["l_returnflag"])
              .select("l_returnflag", _r(F.col("corr"), 6).alias("corr")))


def group_stats(spark: SparkSession, d: str) -> DataFrame:
    """Size, sum, mean, std of balance per zone (dictionary lookup)."""
    c = table(spark, d, "customer")
    n = table(spark, d, "nation").select("n_nationkey", "n_name")
    cn = P.remap_null(J.lookup_join(c, n, "c_nationkey", "n_nationkey", keep_unmatched=False), "n_name", ZONES, out="zone")
    st = A.group_stats(cn, "zone", "c_acctbal")
    return st.select("zone", "size", _r(F.col("sum"), 2).alias("sum"), _r(F.col("mean")).alias("mean"),
                     _r(F.col("std")).alias("std"))


def describe(spark: SparkSession, d: str) -> DataFrame:
    """Describe the numeric columns of part (exact quartiles)."""
    p = P.select_numeric(table(spark, d, "part"))
    ds = A.describe(p)
    return ds.select("column_name", "count", *[_r(F.col(c)).alias(c) for c in
                                          ["mean", "std", "min", "p25", "p50", "p75", "max"]])


def profile(spark: SparkSession, d: str) -> DataFrame:
    """Non-NULL count and type per column of part."""
    return A.profile(table(spark, d, "part"))


def group_median_fill(spark: SparkSession, d: str) -> DataFrame:
    """NULL values take the exact median of their event type."""
    ev = passengers(spark, d)
    out = W.fill_group_median(ev, "value", ["group_type"])
    return out.select("event_id", "group_type", _r(F.col("value")).alias("value"))


def median_fill(spark: SparkSession, d: str) -> DataFrame:
    """NULLs of two columns take their column's exact median."""
    ev = passengers(spark, d)
    out = X.MedianImputer(["value", "k"]).fit(ev).transform(ev)
    return out.select("event_id", _r(F.col("value")).alias("value"), _r(F.col("k")).alias("k"))


def mode_fill(spark: SparkSession, d: str) -> DataFrame:
    """NULL event types take the most frequent type (smallest on ties)."""
    ev = passengers(spark, d)
    m = A.mode(ev, "event_type", alias="m").first()["m"]
    return P.fill_null(ev, {"event_type": m}).select("event_id", "event_type")


def impute_rules(spark: SparkSession, d: str) -> DataFrame:
    """Group median by (type, user), global median, mode -- fitted on the train part."""
    ev = passengers(spark, d)
    split = X.hash_split(ev, "event_id", 0.25, seed=7)
    train = split.where(~F.col("is_test"))
    model = X.ImputeRules(group_median={"value": ["group_type", "user_id"]}, median=["k"],
                          mode=["event_type"]).fit(train)
    out = model.transform(split)
    return out.select("event_id", "is_test", _r(F.col("value")).alias("value"), _r(F.col("k")).alias("k"),
                      "event_type")


def class_counts(spark: SparkSession, d: str) -> DataFrame:
    """A11."""
    return A.class_counts(table(spark, d, "events"), "event_type")


def distinct_values(spark: SparkSession, d: str) -> DataFrame:
    """A14."""
    return A.distinct_values(table(spark, d, "events"), "event_type")


def pop_mean_std(spark: SparkSession, d: str) -> DataFrame:
    """Mean and population std of order totals per status."""
    o = table(spark, d, "orders")
    st = A.mean_std_pop(o, "o_totalprice", by=["o_orderstatus"])
    return st.select("o_orderstatus", _r(F.col("mean"), 2).alias("mean"), _r(F.col("std"), 2).alias("std"))


def extremes(spark: SparkSession, d: str) -> DataFrame:
    """A2: largest and smallest price per return flag."""
    li = table(spark, d, "lineitem")
    return li.groupBy("l_returnflag").agg(F.max("l_extendedprice").alias("max_price"),
                                          F.min("l_extendedprice").alias("min_price"))


def _rounded_total(spark, d):
    return table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderstatus",
                                            F.round("o_totalprice", -1).alias("bucket"))


def ambiguous_keys(spark: SparkSession, d: str) -> DataFrame:
    """Orders whose rounded total is shared with another order."""
    return G.keep_ambiguous(_rounded_total(spark, d), "bucket").select("o_orderkey", "bucket")


def unique_keys(spark: SparkSession, d: str) -> DataFrame:
    """Orders whose rounded total is unique."""
    return G.keep_unique(_rounded_total(spark, d), "bucket").select("o_orderkey", "bucket")


def groups_all(spark: SparkSession, d: str) -> DataFrame:
    """A10: orders of customers whose every order is finished."""
    o = _rounded_total(spark, d)
    return G.keep_groups_all(o, "o_custkey", F.col("o_orderstatus") == "F").select("o_orderkey", "o_custkey")


def eliminate_by_groups(spark: SparkSession, d: str) -> DataFrame:
    """sum/product elimination over the (order, part) key pairs of all line items."""
    li = table(spark, d, "lineitem")
    x, y = F.col("l_orderkey").cast("long"), F.col("l_partkey").cast("long")
    return G.eliminate_by_groups(li.select(F.least(x, y).alias("a"), F.greatest(x, y).alias("b")), "a", "b")


def range_pairs(spark: SparkSession, d: str) -> DataFrame:
    """All (i, j) with lo <= i <= j <= hi for each supplier's key range."""
    s = table(spark, d, "supplier").select("s_suppkey", F.col("s_nationkey").alias("lo"),
                                          (F.col("s_nationkey") + 3).alias("hi"))
    return J.range_pairs(s, "lo", "hi", keep=["s_suppkey"])


def theta_sums(spark: SparkSession, d: str) -> DataFrame:
    """For each customer the number and value (in cents) of all orders that cost at most twenty times its balance."""
    c = table(spark, d, "customer").select("c_custkey", (F.col("c_acctbal") * 20).alias("limit"))
    o = table(spark, d, "orders").select("o_totalprice", F.round(F.col("o_totalprice") * 100).cast("long").alias("cents"))
    return J.theta_aggregate(c, o, "limit", "o_totalprice", ">=", {"cents": "cents"}).select("c_custkey", "matches", "cents")


def range_matches(spark: SparkSession, d: str) -> DataFrame:
    """Pairs of lines and parts where the line's price lies within two of twenty times the part's."""
    li = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice")
    p = table(spark, d, "part").select("p_partkey", (F.col("p_retailprice") * 20 - 2).alias("lo"), (F.col("p_retailprice") * 20 + 2).alias("hi"))
    return J.range_join(li, p, "l_extendedprice", "lo", "hi").select("l_orderkey", "l_linenumber", "p_partkey")


def least_tier(spark: SparkSession, d: str) -> DataFrame:
    """For each line the smallest supplier key of the tier (key modulo 3) whose balance, times ten, covers its price."""
    li = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", (F.col("l_suppkey") % 3).alias("tier"), "l_extendedprice")
    s = table(spark, d, "supplier").select("s_suppkey", (F.col("s_suppkey") % 3).alias("tier"), (F.col("s_acctbal") * 10).alias("capacity"))
    return J.least_reaching(li, s, ["tier"], "l_extendedprice", "capacity", "s_suppkey", "least") \
        .select("l_orderkey", "l_linenumber", "least")


def deepest_basin(spark: SparkSession, d: str) -> DataFrame:
    """Deepest basin of every user's value series ordered by (ts, event_id)."""
    ev = table(spark, d, "events")
    b = W.deepest_basin(ev, ["user_id"], ["ts", "event_id"], "value")
    return b.select("user_id", "left_index", "right_index", _r(F.col("depth")).alias("depth"),
                    _r(F.col("lowest")).alias("lowest"))


def running_bank(spark: SparkSession, d: str) -> DataFrame:
    """Position, last bank height and bank flag of every point."""
    ev = table(spark, d, "events")
    rb = W.running_bank(ev, ["user_id"], ["ts", "event_id"], "value")
    return rb.select("event_id", "user_id", "pos", "bank", "is_bank")


def first_reaching(spark: SparkSession, d: str) -> DataFrame:
    """Each customer's first order at which cumulative spend reaches 500,000."""
    o = table(spark, d, "orders").select("o_custkey", "o_orderdate", "o_orderkey", "o_totalprice")
    r = J.first_reaching(o, ["o_custkey"], ["o_orderdate", "o_orderkey"], "o_totalprice", 500000.0)
    return r.select("o_custkey", "o_orderkey", _r(F.col("running"), 2).alias("running"))


def capacity_lookup(spark: SparkSession, d: str) -> DataFrame:
    """Fewest trials for (floors, glasses) requests drawn from supplier rows."""
    s = table(spark, d, "supplier").select(
        "s_suppkey", (F.abs(F.col("s_acctbal")).cast("long") + 1).alias("floors"),
        ((F.col("s_nationkey") % 4) + 1).alias("glasses"))
    return G.capacity_lookup(s, "floors", "glasses", "trials")


# ----------------------------------------------------------------------------- 2.6 order

def top_abs(spark: SparkSession, d: str) -> DataFrame:
    """The 15 parts whose price is farthest from 1500."""
    p = table(spark, d, "part").withColumn("score", F.col("p_retailprice") - 1500)
    t = O.top_k(p, "score", 15, desc=True, by_abs=True, tiebreak=["p_partkey"])
    return t.select("p_partkey", _r(F.col("score")).alias("score"))


def sorted_nulls_last(spark: SparkSession, d: str) -> DataFrame:
    """O1: suppliers by balance, descending, NULL balances (induced) last."""
    s = table(spark, d, "supplier").withColumn(
        "bal", F.when(F.col("s_suppkey") % 10 == 0, F.lit(None)).otherwise(F.col("s_acctbal")))
    return O.sort_nulls_last(s, ["bal"], desc=True, tiebreak=["s_suppkey"]).select("s_suppkey", "bal")


def random_rows(spark: SparkSession, d: str) -> DataFrame:
    """16 rows drawn with replacement by seeded position hashes."""
    return O.random_rows(table(spark, d, "customer"), 16, ["c_custkey"], seed=3).select("draw", "c_custkey", "c_name")


# ----------------------------------------------------------------------------- 2.8 scalar

def array_scale(spark: SparkSession, d: str) -> DataFrame:
    """Reshape to 8x8, flatten back, divide by 255."""
    e = table(spark, d, "embeddings")
    nested = F.transform(F.sequence(F.lit(0), F.lit(7)), lambda r: F.slice("embedding", r * 8 + 1, 8))
    flat = S.flatten_array(nested)
    sc = S.scale_array(flat, 255)
    return e.select("vec_id", F.size(flat).alias("n"),
                    _r(F.aggregate(sc, F.lit(0.0), lambda a, x: a + x), 8).alias("total"))


# fixed values: weights of the affine score (w_i = ((i mod 7) - 3) / 10), bias 0.5
DOT_WEIGHTS = [((i % 7) - 3) / 10 for i in range(64)]


def dot(spark: SparkSession, d: str) -> DataFrame:
    """Affine score b + x . w and one component of each embedding."""
    e = table(spark, d, "embeddings")
    return e.select("vec_id", _r(S.affine(0.5, DOT_WEIGHTS, F.col("embedding")), 6).alias("score"),
                    _r(S.take_component("embedding", 3).cast("double"), 6).alias("x3"))


def text_clean(spark: SparkSession, d: str) -> DataFrame:
    """Strip bracketed text and digits from customer names, format balance."""
    c = table(spark, d, "customer")
    raw = F.concat(F.col("c_name"), F.lit(" (seg "), F.col("c_mktsegment"), F.lit(")"))
    return c.select("c_custkey", S.strip_digits(S.strip_parens(raw)).alias("clean"),
                    S.format_num("c_acctbal", 0).alias("bal_text"))


# ----------------------------------------------------------------------------- 2.9 features

SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]


def dummies(spark: SparkSession, d: str) -> DataFrame:
    """Sorted categories, first dropped, one 0/1 column each."""
    c = table(spark, d, "customer").select("c_custkey", "c_mktsegment")
    m = X.DummyEncoder(["c_mktsegment"]).fit(c)
    return m.transform(c)


def label_codes(spark: SparkSession, d: str) -> DataFrame:
    """Sorted codes from 0."""
    p = table(spark, d, "part").select("p_partkey", "p_type")
    m = X.LabelEncoder("p_type", "code").fit(p)
    return m.transform(p).select("p_partkey", F.col("code").cast("long").alias("code"))


def one_hot(spark: SparkSession, d: str) -> DataFrame:
    """StringIndexer(keep) + OneHotEncoder(dropLast): position of the hot slot."""
    from pyspark.ml import Pipeline
    from pyspark.ml.functions import vector_to_array

    p = table(spark, d, "part").select("p_partkey", "p_brand")
    model = Pipeline(stages=X.one_hot_stages(["p_brand"])).fit(p)
    arr = vector_to_array(F.col("p_brand_ohe"))
    return model.transform(p).select("p_partkey", (F.array_position(arr, 1.0) - 1).alias("hot"),
                                     F.size(arr).alias("width"))


def standardize(spark: SparkSession, d: str) -> DataFrame:
    """Z-scores with population std, fitted on the rows given."""
    li = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice")
    m = X.Standardizer(["l_quantity", "l_extendedprice"], suffix="_z").fit(li)
    return m.transform(li).select("l_orderkey", "l_linenumber", _r(F.col("l_quantity_z")).alias("q_z"),
                                  _r(F.col("l_extendedprice_z")).alias("p_z"))


def hash_split(spark: SparkSession, d: str) -> DataFrame:
    """25 % test by key hash."""
    o = table(spark, d, "orders").select("o_orderkey")
    return X.hash_split(o, "o_orderkey", 0.25, seed=42)


def stratified_split(spark: SparkSession, d: str) -> DataFrame:
    """25 % test per order status by key hash rank."""
    o = table(spark, d, "orders").select("o_orderkey", "o_orderstatus")
    return X.stratified_split(o, "o_orderkey", "o_orderstatus", 0.25, seed=42)


def folds(spark: SparkSession, d: str) -> DataFrame:
    """Five contiguous stratified folds per status in key order."""
    o = table(spark, d, "orders").select("o_orderkey", "o_orderstatus")
    return X.kfold(o, 5, ["o_orderkey"], label="o_orderstatus")


# ----------------------------------------------------------------------------- 2.11 evaluation

def metrics(spark: SparkSession, d: str) -> DataFrame:
    """Accuracy, precision, recall and F1 of a fixed score at 0.5."""
    s = scored_lines(spark, d)
    return E.prf(s, "y", "pred")


def metric_row(spark: SparkSession, d: str) -> DataFrame:
    """User metrics side by side: the four ratios and the AUC of the fixed score."""
    from tessera.functions.udf import metric_row as side_by_side

    return side_by_side(scored_lines(spark, d), {
        "cut": lambda df: E.prf(df, "y", "pred"), "rank": lambda df: E.roc_auc(df, "y", "p").select(_r(F.col("auc"), 6).alias("auc"))})


def user_function(spark: SparkSession, d: str) -> DataFrame:
    """A user function over two columns, Arrow-batched: each line's price after discount, in whole cents."""
    from tessera.functions.udf import vectorized

    net = vectorized(lambda price, off: (price * 100).round().astype("int64") * (100 - (off * 100).round().astype("int64")) // 100, "long")
    li = table(spark, d, "lineitem")
    return li.select("l_orderkey", "l_linenumber", net(F.col("l_extendedprice").cast("double"), F.col("l_discount").cast("double")).alias("cents"))


def group_members(spark: SparkSession, d: str) -> DataFrame:
    """The lines of every order as one sorted list (number:part)."""
    li = table(spark, d, "lineitem")
    got = A.group_members(li, "l_orderkey", ["l_linenumber", "l_partkey"])
    return got.select("l_orderkey", F.array_join(F.transform("members", lambda m: F.concat_ws(":", m["l_linenumber"], m["l_partkey"])), ",")
                      .alias("members"))


def array_load(spark: SparkSession, d: str) -> DataFrame:
    """Array features loaded, flattened and scaled by 1/255, with their labels; the sum of each vector."""
    from tessera.sources.files import load_arrays

    x, _ = load_arrays(spark, f"{d.rstrip('/')}/embeddings.parquet", "embedding", "label", 255.0, id_col="vec_id")
    return x.select("vec_id", "label", F.round(F.aggregate("x", F.lit(0.0), lambda a, v: a + v), 9).alias("total"))


def feature_vector(spark: SparkSession, d: str) -> DataFrame:
    """The features of a line as one vector next to its target; the vector's length and last entry."""
    from pyspark.ml.functions import vector_to_array

    li = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", *[F.col(c).cast("double").alias(c) for c in (
        "l_quantity", "l_discount", "l_tax")], F.col("l_extendedprice").cast("double").alias("target"))
    got = P.split_features_target(li, "target", ["l_quantity", "l_discount", "l_tax"])
    v = vector_to_array("features")
    return got.select("l_orderkey", "l_linenumber", "target", F.size(v).alias("width"), F.element_at(v, -1).alias("last"))


def auc(spark: SparkSession, d: str) -> DataFrame:
    """Exact ROC-AUC of the fixed score, per line number and overall."""
    s = scored_lines(spark, d)
    per = E.roc_auc(s, "y", "p", by=["l_linenumber"]).select("l_linenumber", _r(F.col("auc"), 6).alias("auc"))
    tot = E.roc_auc(s, "y", "p").select(F.lit(0).alias("l_linenumber"), _r(F.col("auc"), 6).alias("auc"))
    return per.unionByName(tot)


def _house(spark, d):
    li = table(spark, d, "lineitem")
    return li.select((F.col("l_extendedprice") / 1000).alias("y"),
                     (F.col("l_quantity") * 1.5 + 3).alias("z"), "l_returnflag")


def r2(spark: SparkSession, d: str) -> DataFrame:
    """R^2 of a fixed price rule per return flag."""
    return E.r2(_house(spark, d), "y", "z", by=["l_returnflag"]).select("l_returnflag",
                                                                         _r(F.col("r2"), 6).alias("r2"))


def half_mse(spark: SparkSession, d: str) -> DataFrame:
    """E5: J = sum((h-y)^2)/(2m) per return flag."""
    return E.half_mse(_house(spark, d), "y", "z", by=["l_returnflag"]).select("l_returnflag",
                                                                               _r(F.col("J")).alias("J"))


def threshold_sweep(spark: SparkSession, d: str) -> DataFrame:
    """The 17-threshold sweep in one aggregate."""
    s = scored_lines(spark, d)
    return E.threshold_sweep(s, "y", "p").select(_r(F.col("threshold"), 2).alias("threshold"),
                                                 "accuracy", "precision", "recall", "f1")


def confusion(spark: SparkSession, d: str) -> DataFrame:
    """E7."""
    return E.confusion(scored_lines(spark, d), "y", "pred")


def scores_by_split(spark: SparkSession, d: str) -> DataFrame:
    """Accuracy on train and test parts."""
    s = X.hash_split(scored_lines(spark, d), "l_orderkey", 0.25, seed=42)
    return E.scores_by_split(s, "y", "pred", "is_test")


def metrics_table(spark: SparkSession, d: str) -> DataFrame:
    """Two fixed scorers' metrics in long form (model, metric, value)."""
    s = scored_lines(spark, d)
    s2 = s.withColumn("pred", (F.col("p") >= 0.3).cast("int"))
    t = E.metrics_table({"cut_050": E.prf(s, "y", "pred"), "cut_030": E.prf(s2, "y", "pred")}, wide=False)
    return t
