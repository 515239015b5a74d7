"""Filter interaction audit by forward-backward path counting on the subset lattice.

Filters applied one after the other walk through the lattice of the subsets of filters
that have acted: an order is a path from the empty set to the full one, a step of it is
an edge (state, filter).  What a filter removes on an edge does not depend on the order
inside the state, so all orders share the 2^(k-1) * k edges.  ``path_counts`` counts the
orders that reach each state (forward) and that lead from it to the end (backward); their
product weights an edge's removals in the filter's Shapley sum, and the rows of each order
are read from the same edges.

Spark does the counting: each document becomes one failure mask, masks are counted per
part, and the edges' sums are taken over those (part, mask) counts, at most 2^k of them a
part.  A part of any size is combined in the map tasks.

The five filters (words: maximal runs of no ``[\\x20\\x09-\\x0D]``, case-sensitive): A under 200 words;
B 100 * distinct words < 50 * words; C 100 * ``[A-Z]`` characters > 2 * code points;
D any ``[#$%&*|]``; E text identical to that of a smaller doc_id anywhere in the table.

Defined cases: null text is empty, null source is the part ''; a row with a null doc_id never fails
E and makes no other row fail it; repeated rows each count; a doc_id with several label
rows is good (toxic) if one of them says so, a null label says nothing; extra columns are
ignored; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FILTERS = "ABCDE"
MOST = 8  # filters: 8! orders of 8 steps are 322,560 step rows
SHORT, DISTINCT, CAPITALS = 200, 50, 2


def allowed(k: int, before: Iterable[tuple[int, int]] = ()) -> list[tuple[int, int]]:
    """Edges (state, filter) of the lattice; ``before`` lists (x, y): x acts before y."""
    need = [0] * k
    for x, y in before:
        need[y] |= 1 << x
    return [(s, f) for s in range(1 << k) for f in range(k) if not s >> f & 1 and need[f] & ~s == 0]


def path_counts(k: int, edges: Sequence[tuple[int, int]]) -> tuple[list[int], list[int]]:
    """(forward, backward): orders from the empty set to each state, and from it to the full set."""
    forward, backward = [0] * (1 << k), [0] * (1 << k)
    forward[0] = backward[-1] = 1
    for s, f in edges:  # ascending states: a state's ways in are complete when its edges are read
        forward[s | 1 << f] += forward[s]
    for s, f in reversed(edges):
        backward[s] += backward[s | 1 << f]
    return forward, backward


def orders(k: int, edges: Sequence[tuple[int, int]]) -> list[tuple[int, ...]]:
    """All orders, as the paths from the empty to the full set."""
    out: dict[int, list[int]] = {}
    for s, f in edges:
        out.setdefault(s, []).append(f)
    paths: list[tuple[int, tuple[int, ...]]] = [(0, ())]
    for _ in range(k):
        paths = [(s | 1 << f, (*p, f)) for s, p in paths for f in out.get(s, [])]
    return [p for _, p in paths]


def masks(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, mask, n, good, toxic): documents of each part by the set of filters they fail
    (bit i: the i-th of FILTERS)."""
    text = F.coalesce("text", F.lit(""))
    words = F.array_remove(F.split(text, r"[\x20\x09-\x0D]+"), "")
    capitals = F.length(text) - F.length(F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", ""))

    def bit(condition: Column, i: int) -> Column:
        return F.when(condition, F.lit(1 << i)).otherwise(F.lit(0))

    rows = docs.select(
        "doc_id", F.coalesce("source", F.lit("")).alias("part"), text.alias("text"), words.alias("words")).select(
        "doc_id", "part", F.unhex(F.sha2("text", 256)).alias("h"),
        (bit(F.size("words") < SHORT, 0) + bit(100 * F.size(F.array_distinct("words")) < DISTINCT * F.size("words"), 1)
         + bit(100 * capitals > CAPITALS * F.length("text"), 2) + bit(F.col("text").rlike("[#$%&*|]"), 3)).alias("mask"))
    marks = labels.where("doc_id is not null").groupBy("doc_id").agg(
        F.max(F.coalesce(F.col("quality") == 1, F.lit(False))).alias("good"),
        F.max(F.coalesce(F.col("toxic") == 1, F.lit(False))).alias("toxic"))
    rows = rows.groupBy("doc_id", "h", "part", "mask").agg(F.count(F.lit(1)).alias("n")).join(marks, "doc_id", "left")
    # equal texts have equal masks: a group of copies shrinks to one row a part and label before it meets
    one = rows.groupBy("h", "part", "mask", F.coalesce("good", F.lit(False)).alias("good"),
                       F.coalesce("toxic", F.lit(False)).alias("toxic")).agg(
        F.sum("n").alias("n"), F.sum(F.when(F.col("doc_id").isNull(), F.col("n"))).alias("no_id"),
        F.min(F.when(F.col("doc_id").isNotNull(), F.struct("doc_id", "n"))).alias("low"))
    first = one.groupBy("h").agg(F.min("low.doc_id").alias("first"))
    at_first = F.when(F.col("low.doc_id") == F.col("first"), F.col("low.n")).otherwise(F.lit(0))
    passes = F.coalesce("no_id", F.lit(0)) + at_first
    e = 1 << FILTERS.index("E")
    split = one.join(first, "h").select("part", "good", "toxic", F.explode(F.array(
        F.struct(F.col("mask").alias("mask"), passes.alias("n")),
        F.struct((F.col("mask") + e).alias("mask"), (F.col("n") - passes).alias("n")))).alias("x"))
    n = F.col("x.n")
    return split.where("x.n > 0").groupBy("part", F.col("x.mask").alias("mask")).agg(
        F.sum(n).alias("n"), F.sum(F.when(F.col("good"), n).otherwise(0)).alias("good"),
        F.sum(F.when(F.col("toxic"), n).otherwise(0)).alias("toxic"))


def audit(counts: DataFrame, names: Sequence[str], before: Iterable[tuple[str, str]] = ()) -> DataFrame:
    """One row per part, order and step from (part, mask, n, good, toxic): kept, removed,
    redundant, unique_fails, good_lost, toxic_lost, shapley.  ``before`` restricts the
    orders: (x, y) keeps those where x acts before y."""
    k = len(names)
    if not 0 < k <= MOST:
        raise ValueError(f"1 to {MOST} filters, not {k}")
    edges = allowed(k, [(names.index(x), names.index(y)) for x, y in before])
    forward, backward = path_counts(k, edges)
    if not backward[0]:
        raise ValueError("no order satisfies the precedences")
    steps, weights = [], {(s, f): forward[s] * backward[s | 1 << f] for s, f in edges}
    for path in orders(k, edges):
        state, name = 0, "".join(names[f] for f in path)
        for i, f in enumerate(path):
            steps.append((name, i + 1, state, f, weights[state, f]))
            state |= 1 << f
    spark = counts.sparkSession
    lattice = F.array(*[F.struct(F.lit(s).alias("state"), F.lit(f).alias("f"), F.lit(1 << f).alias("bit"), F.lit(w).cast("long").alias("weight"))
                        for (s, f), w in weights.items()])
    seen, fails = F.col("mask").bitwiseAND(F.col("state")) != 0, F.col("mask").bitwiseAND(F.col("bit")) != 0

    def total(what: str, condition: Column) -> Column:
        return F.sum(F.when(condition, F.col(what)).otherwise(0)).cast("long")

    sums = counts.select("part", "mask", "n", "good", "toxic", F.explode(lattice).alias("e")) \
        .select("*", "e.state", "e.f", "e.bit", "e.weight").groupBy("part", "state", "f", "weight").agg(
            total("n", ~seen & ~fails).alias("kept"), total("n", ~seen & fails).alias("removed"),
            total("n", seen & fails).alias("redundant"), total("n", F.col("mask") == F.col("bit")).alias("unique_fails"),
            total("good", ~seen & fails).alias("good_lost"), total("toxic", ~seen & fails).alias("toxic_lost"))
    shares = sums.groupBy("part", "f").agg(F.sum(F.col("weight") * F.col("removed")).cast("long").alias("shapley"))
    step = spark.createDataFrame(steps, "filter_order string, step int, state int, f int, weight long").drop("weight")
    # at most MOST! * MOST step rows, whatever the data: a bounded broadcast
    return sums.join(shares, ["part", "f"]).join(F.broadcast(step), ["state", "f"]).select(
        "part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")


def audit_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The five filters' audit over whole ``docs``."""
    return audit(masks(docs, labels), FILTERS)
