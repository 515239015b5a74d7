"""Personal data by candidate gradient boosting, in DataFrame expressions only.

Base spans follow four fixed patterns with a check of each match (octets, Luhn digits,
number of digits); they always stay.  Beside them, high-recall generators propose further
spans that may overlap: addresses with written-out signs or without a top level, colon
groups, number groups that look like an address, card or phone number.  Proposals that
touch a base span are put aside; boosted trees score the others by their format (lengths,
kinds of signs, digit groups, octets, Luhn digits) and context (neighbouring signs, key
words before it).

Labels come by weak supervision from all documents.
Each base span is written anew, in its own context, in shapes that the base patterns miss
(``(at)`` and ``(dot)``, colon groups, dotted cards, phones without a plus): positives.  It
is also written as look-alikes (no top level, octets above 255, clock times, wrong check
digit, dates, decimals), and proposals of another kind on a new shape count as wrong too:
negatives.  Natural proposals are negatives unless they have one of the new shapes; those
stay unlabelled and out of the fit.  Per kind, the smallest probability (0.5 or more) from which
held-out proposals -- all of which touch no base span -- are right with a share of
``PRECISION`` is the threshold.  Proposals above it are added; where they overlap in a
chain, the likeliest of the chain.

The trees are turned into a column expression, so scoring happens inside the row: no
shuffle, no Python, no pairs.  Positions count code points, ends are exclusive; running
sums and maxima use blocks of the square root of the number of spans and overlaps are
found by sorted sweeps, so a text with very many spans is not quadratic.

Defined cases: null or empty text -> no spans (SHA-256 of the empty string); too few
proposals of either label -> no trees, base spans only; repeated rows are treated one by
one; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.shared import cut_lineage

KINDS = ["email", "ip", "card", "phone"]
PRECISION = 0.95
TREES = 20
DEPTH = 4

# Matches equal those of the plain patterns; possessive groups and the look-behind (or the
# end of the match before) only keep long runs linear.
BASE = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++\.[A-Za-z0-9-]"
             r"(?:(?!\.(?![A-Za-z0-9-]))[A-Za-z0-9.-])*+",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:(?![ -](?![0-9]))[0-9 -])++",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
}
PROPOSED = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}+(?:@| ?[\[(]at[\])] ?)[A-Za-z0-9-]{1,63}+"
             r"(?:(?:\.| ?[\[(]dot[\])] ?)[A-Za-z0-9-]{1,63}+){0,8}",
    "ip": r"(?<![0-9A-Fa-f:.])(?:[0-9]{1,5}(?:\.[0-9]{1,5}){3}|(?:[0-9A-Fa-f]{1,4}:){3,7}[0-9A-Fa-f]{1,4})(?![0-9A-Fa-f:])",
    "card": r"(?<![0-9])[0-9](?:[ .-]?[0-9]){11,18}(?![0-9])",
    "phone": r"(?<![0-9])(?:\+|00)?[0-9(][0-9() .-]{6,20}[0-9](?![0-9])",
}
CONTEXT = ["mail|contact|write", "ip|host|server|addr", "card|visa|pay|credit", "phone|call|tel|fax|mobile"]
_OCTET = r"0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _add(x: Column, y: Column) -> Column:
    return x + y


def _larger(x: Column, y: Column) -> Column:
    return F.greatest(x, y)


def running(values: Column, join: Callable[[Column, Column], Column] = _add) -> Column:
    """Exclusive running sum (or another ``join`` that 0 leaves unchanged, such as the
    maximum) of a non-empty array of int of at least 0, in about n * sqrt(n) steps."""

    def total(a: Column) -> Column:
        return F.aggregate(a, F.lit(0), join)

    def blocks(a: Column, s: Column) -> Column:
        each = F.sequence(F.lit(0), F.ceil(F.size(a) / s).cast("int") - 1)
        totals = F.transform(each, lambda c: total(F.slice(a, c * s + 1, s)))
        before = let(totals, lambda t: F.transform(each, lambda c: total(F.slice(t, F.lit(1), c))))
        return let(before, lambda b: F.transform(F.sequence(F.lit(0), F.size(a) - 1), lambda i: join(F.get(
            b, F.floor(i / s).cast("int")), total(F.slice(a, F.floor(i / s).cast("int") * s + 1, F.pmod(i, s))))))

    return let(values, lambda a: let(F.ceil(F.sqrt(F.size(a))).cast("int"), lambda s: blocks(a, s)))


def matches(text: Column, pattern: str) -> Column:
    """array<struct(start, end, m, before, after)> of all matches; null without any."""
    p = F.lit(pattern)
    hit = F.regexp_extract_all(text, p, F.lit(0))
    gap = F.split(text, pattern, -1)

    def build(h: Column, g: Column) -> Column:
        lengths = F.zip_with(F.slice(g, 1, F.size(h)), h, lambda x, y: F.length(x) + F.length(y))
        return let(running(lengths), lambda r: F.transform(h, lambda m, i: F.struct(
            (F.get(r, i) + F.length(F.get(g, i))).alias("start"),
            (F.get(r, i) + F.length(F.get(g, i)) + F.length(m)).alias("end"), m.alias("m"),
            F.right(F.get(g, i), F.lit(24)).alias("before"), F.left(F.get(g, i + 1), F.lit(1)).alias("after"))))

    return let(hit, lambda h: F.when(F.size(h) > 0, let(gap, lambda g: build(h, g))))


_AT, _DOT = r"[\[(]at[\])]", r"\.|[\[(]dot[\])]"
_FAR = 2_000_000_000  # beyond the end of any text
_SPAN = "array<struct<start:int,kind:int,end:int>>"
_FOUND = "array<struct<start:int,kind:int,end:int,m:string,before:string,after:string>>"
_ROW = "array<struct<start:int,end:int,m:string,before:string,after:string>>"


def _found(text: Column, pattern: str, some: Column) -> Column:
    return F.coalesce(F.when(some, matches(text, pattern)), F.array().cast(_ROW))


def _digits(m: Column) -> Column:
    return F.regexp_replace(m, "[^0-9]", "")


def _valid(kind: str, m: Column) -> Column:
    if kind == "ip":
        return m.rlike(rf"^{_OCTET}(?:\.{_OCTET}){{3}}$")
    n = F.length(_digits(m))
    if kind == "card":
        return n.between(12, 19) & _luhn(m)
    return n.between(9, 15) if kind == "phone" else F.lit(True)


def _luhn(m: Column) -> Column:
    d = _digits(m)
    return F.coalesce(F.call_function("luhn_check", F.when(F.length(d) <= 19, d)), F.lit(False))


def _spans(found: Column) -> Column:
    return F.transform(found, lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end")))


def _kinds(kind: str, found: Column) -> Column:
    """The matches with their kind, in the fields of ``_FOUND``."""
    return F.transform(found, lambda s: F.struct(
        s["start"].alias("start"), F.lit(KINDS.index(kind)).alias("kind"), s["end"].alias("end"), s["m"].alias("m"),
        s["before"].alias("before"), s["after"].alias("after")))


def has_digit(text: Column) -> Column:
    return text.rlike("[0-9]")


def base_matches(text: Column, digit: Column, kind: str) -> Column:
    """Array of ``_FOUND`` of the base spans of a kind; ``digit``: the text has one."""
    some = {"email": text.contains("@"), "ip": digit & text.contains("."), "card": digit, "phone": digit & text.contains("+")}
    return _kinds(kind, F.filter(_found(text, BASE[kind], some[kind]), lambda s: _valid(kind, s["m"])))


def base_spans(text: Column, digit: Column, kind: str) -> Column:
    """array<struct(start, kind, end)> of the base spans of a kind."""
    return _spans(base_matches(text, digit, kind))


def _count(m: Column, keep: str) -> Column:
    return F.length(F.regexp_replace(m, f"[^{keep}]", "")).cast("double")


def _is(c: Column, pattern: str) -> Column:
    return c.rlike(pattern).cast("double")


def _features(s: Column) -> list[Column]:
    m, last = s["m"], F.lower(s["before"])
    return [*[(s["kind"] == k).cast("double") for k in range(len(KINDS))], F.length(m).cast("double"),
            *[_count(m, k) for k in ("0-9", "A-Za-z", " ", ".", r"\-", "()", "+", "@", ":")],
            _is(s["before"], r"[A-Za-z0-9]$"), _is(s["before"], r"(^|\s)$"),
            _is(s["after"], r"[A-Za-z0-9]"), _is(s["after"], r"^\s?$"), *[_is(last, k) for k in CONTEXT],
            F.length(F.regexp_extract(m, "^[^0-9]*([0-9]*)", 1)).cast("double"),
            F.length(F.regexp_extract(m, "([0-9]*)[^0-9]*$", 1)).cast("double"),
            _is(m, _AT), _is(m, _DOT), _is(m, "[A-Fa-f]"), _valid("ip", m).cast("double"), _luhn(m).cast("double"),
            _is(m, "^(?:19|20)[0-9]{2}-[0-9]{2}-[0-9]{2}")]


N_FEATURES = 4 + 1 + 9 + 4 + len(CONTEXT) + 2 + 6
_NAMES = [f"f{i}" for i in range(N_FEATURES)]


def described(s: Column) -> list[Column]:
    """The fields kind, f0, f1, ... of a proposal."""
    return [s["kind"].alias("kind"), *[f.alias(n) for f, n in zip(_features(s), _NAMES, strict=True)]]


def proposals(text: Column, digit: Column) -> Column:
    """Array of ``_FOUND`` of all generators."""
    some = {"email": text.contains("@") | text.contains("(at)") | text.contains("[at]") | text.contains("(at]") | text.contains("[at)"),
            "ip": (digit & text.contains(".")) | text.contains(":"), "card": digit, "phone": digit}
    return F.concat(*[_kinds(k, _found(text, PROPOSED[k], some[k])) for k in KINDS])


def untouched(found: Column, base: Column) -> Column:
    """The proposals that touch no base span, by start: all spans are sorted, base spans first;
    a proposal is free if no base span that begins up to its start reaches beyond it and none
    begins before its end."""
    def item(s: Column, own: int, m: Column, before: Column, after: Column) -> Column:
        return F.struct(s["start"].alias("start"), F.lit(own).alias("own"), s["kind"].alias("kind"), s["end"].alias("end"),
                        m.alias("m"), before.alias("before"), after.alias("after"))

    none = F.lit("")
    items = F.array_sort(F.concat(F.transform(base, lambda b: item(b, 0, none, none, none)),
                                  F.transform(found, lambda s: item(s, 1, s["m"], s["before"], s["after"]))))

    def sweep(a: Column) -> Column:
        reach = running(F.transform(a, lambda s: F.when(s["own"] == 0, s["end"]).otherwise(0)), _larger)
        ahead = F.reverse(running(F.reverse(F.transform(
            a, lambda s: F.when(s["own"] == 0, _FAR - s["start"]).otherwise(0))), _larger))
        return let(reach, lambda r: let(ahead, lambda n: F.filter(a, lambda s, i: (s["own"] == 1) & (
            F.get(r, i) <= s["start"]) & (_FAR - F.get(n, i) >= s["end"]))))

    free = F.when((F.size(found) > 0) & (F.size(base) > 0), let(items, sweep)).otherwise(F.when(F.size(found) > 0, items))
    empty = F.array().cast(_FOUND)
    return F.coalesce(F.transform(free, lambda s: F.struct(*[s[c].alias(c) for c in ("start", "kind", "end", "m", "before", "after")])),
                      empty)


def likeliest(spans: Column) -> Column:
    """Of each chain of overlapping spans (struct of start, kind, end, p; sorted by start) the
    one of the largest p, then the smallest start and kind."""
    def chains(a: Column) -> Column:
        new = let(running(F.transform(a, lambda s: s["end"]), _larger), lambda r: F.transform(
            a, lambda s, i: (s["start"] >= F.get(r, i)).cast("int")))
        named = let(new, lambda f: let(running(f), lambda r: F.transform(a, lambda s, i: F.struct(
            (F.get(r, i) + F.get(f, i)).alias("run"), (-s["p"]).alias("less"), s["start"].alias("start"),
            s["kind"].alias("kind"), s["end"].alias("end")))))
        return let(F.array_sort(named), lambda g: F.filter(g, lambda s, i: (i == 0) | (F.get(g, i - 1)["run"] < s["run"])))

    return F.coalesce(F.when(F.size(spans) > 0, _spans(let(spans, chains))), F.array().cast(_SPAN))


def _seen_shape(s: Column) -> Column:
    """Natural proposals in one of the new shapes: neither right nor wrong is known."""
    m, n = s["m"], F.length(_digits(s["m"]))
    shape = [m.rlike(_AT) & m.rlike(_DOT), m.contains(":") & m.rlike("[A-Fa-f]|(?::[0-9]+){5}"),
             _luhn(m) & m.rlike(r"^[0-9]{4}(?:\.[0-9]{1,4}){2,4}$"),
             n.between(9, 15) & F.lower(s["before"]).rlike(CONTEXT[3])]
    out = F.lit(False)
    for k, c in enumerate(shape):
        out = out | ((s["kind"] == k) & c)
    return out


def rewritten(s: Column) -> Column:
    """array<struct(t, kind, start, end)>: a base span written anew in its context; ``end`` is
    that of the new span, or 0 for a look-alike."""
    m, d = s["m"], _digits(s["m"])
    name, place = F.substring_index(m, "@", 1), F.substring_index(m, "@", -1)
    octet = [F.get(F.split(m, r"\."), F.lit(i)).cast("int") for i in range(4)]
    hexes = [F.lower(F.hex(o)) for o in octet]
    groups = lambda x: F.regexp_replace(x, "([0-9]{4})(?=[0-9])", "$1.")
    wrong = F.concat(F.substring(d, 1, 11), F.pmod(F.substring(d, 12, 1).cast("int") + 1, F.lit(10)).cast("string"),
                     F.substring(d, 13, 19))
    two = lambda o, n: F.lpad(F.pmod(o, F.lit(n)).cast("string"), 2, "0")
    forms = {
        "email": ([F.concat(name, F.lit(" (at) "), F.regexp_replace(place, r"\.", " (dot) ")),
                   F.concat(name, F.lit("[at]"), F.regexp_replace(place, r"\.", "[dot]")), F.concat(name, F.lit(" (at) "), place)],
                  [F.concat(name, F.lit(" (at) "), F.substring_index(place, ".", 1)),
                   F.concat(name, F.lit("@"), F.substring_index(place, ".", 1))]),
        "ip": ([F.concat_ws(":", F.lit("2001"), F.lit("db8"), *hexes), F.concat_ws(":", F.lit("fe80:0:0:0"), *hexes)],
               [F.concat_ws(".", *octet[:3], octet[3] + 256),
                F.concat_ws(":", two(octet[0], 24), *[two(o, 60) for o in octet[1:]])]),
        "card": ([groups(d)], [groups(wrong), wrong]),
        "phone": ([F.regexp_replace(m, r"^\+", ""), F.regexp_replace(m, r"^\+", "00"),
                   F.regexp_replace(m, r"^\+[0-9]{1,3}[ .-]?(?=[(0-9])", "")],
                  [F.concat(F.lit("20"), F.substring(d, 1, 2), F.lit("-0"), F.substring(d, 3, 1), F.lit("-1"),
                            F.substring(d, 4, 1), F.lit(" 1"), F.substring(d, 5, 1)),
                   F.concat(F.substring(d, 1, 1), F.lit("."), F.substring(d, 2, 18))]),
    }

    def one(form: Column, right: bool) -> Column:
        at = F.length(s["before"])
        return F.struct(F.concat(s["before"], form, s["after"]).alias("t"), s["kind"].alias("kind"), at.alias("start"),
                        (at + F.length(form) if right else F.lit(0)).alias("end"))

    out = F.array().cast("array<struct<t:string,kind:int,start:int,end:int>>")
    for k, name_ in enumerate(KINDS):
        right, look = forms[name_]
        out = F.when(s["kind"] == k, F.array(*[one(f, True) for f in right], *[one(f, False) for f in look])).otherwise(out)
    return out


class Model:
    """Boosted trees as nested tuples (feature, threshold, left, right) or leaf values, their
    weights, and a threshold a kind (None: nothing of this kind is added)."""

    def __init__(self, trees: list, weights: list[float], cut: list[float | None]):
        self.trees, self.weights, self.cut = trees, weights, cut

    def probability(self, s: Column) -> Column:
        def walk(t) -> Column:
            return F.lit(float(t)) if not isinstance(t, tuple) else \
                F.when(s[_NAMES[t[0]]] <= t[1], walk(t[2])).otherwise(walk(t[3]))

        margin = F.lit(0.0)
        for t, w in zip(self.trees, self.weights, strict=True):
            margin = margin + F.lit(w) * walk(t)
        return 1 / (1 + F.exp(-2 * margin))

    def selected(self, s: Column, p: Column) -> Column:
        out = F.lit(False)
        for k, cut in enumerate(self.cut):
            if cut is not None:
                out = out | ((s["kind"] == k) & (p >= cut))
        return out


def _tree(node):
    if node.getClass().getSimpleName() == "LeafNode":
        return node.prediction()
    split = node.split()
    return split.featureIndex(), split.threshold(), _tree(node.leftChild()), _tree(node.rightChild())


def train(docs: DataFrame, precision: float = PRECISION) -> Model | None:
    """Trees and thresholds from all documents; None if a label is too rare."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    t, d = F.col("t"), F.col("d")
    base = F.concat(*[base_matches(t, d, k) for k in KINDS])
    fit = (F.pmod(F.xxhash64("doc_id", F.lit(4)), F.lit(10)) < 7).alias("fit")
    free = untouched(F.col("found"), F.col("b")).alias("free")
    shown = cut_lineage(docs.select(text.alias("t"), has_digit(text).alias("d"), fit)
                        .select("fit", base.alias("m"), proposals(t, d).alias("found"))
                        .select("fit", "m", "found", _spans(F.col("m")).alias("b")).select("fit", "m", free))
    natural = shown.select("fit", F.explode("free").alias("s")).where(~_seen_shape(F.col("s"))).select("fit", F.lit(0.0).alias("label"), "s")
    anew = cut_lineage(shown.select("fit", F.explode("m").alias("s")).select("fit", F.explode(rewritten(F.col("s"))).alias("w")))
    anew = cut_lineage(anew.select("fit", "w", F.col("w.t").alias("t"), has_digit(F.col("w.t")).alias("d"))
                       .select("fit", "w", _spans(base).alias("b"), proposals(t, d).alias("found")).select("fit", "w", free)) \
        .select("fit", "w", F.explode("free").alias("s"))
    same = F.col("s.kind") == F.col("w.kind")
    exact = same & (F.col("s.start") == F.col("w.start")) & (F.col("s.end") == F.col("w.end"))
    anew = anew.where((F.col("w.end") == 0) | exact | ~same).select("fit", exact.cast("double").alias("label"), "s")
    data = cut_lineage(natural.unionByName(anew).select("label", "fit", *described(F.col("s"))))
    count = {(r.label, r.fit): r.n for r in data.groupBy("label", "fit").agg(F.count(F.lit(1)).alias("n")).collect()}
    if min(count.get((y, f), 0) for y in (0.0, 1.0) for f in (True, False)) < 10:
        return None
    ready = VectorAssembler(inputCols=_NAMES, outputCol="features").transform(data)
    gbt = GBTClassifier(maxIter=TREES, maxDepth=DEPTH, stepSize=0.3, seed=3, maxBins=32).fit(ready.where("fit"))
    p = vector_to_array("probability")[1]
    bins = gbt.transform(ready.where("not fit")).groupBy("kind", F.floor(p * 200).cast("int").alias("bin")) \
        .agg(F.count(F.lit(1)).alias("n"), F.sum("label").alias("right")).collect()
    cut: list[float | None] = []
    for k in range(len(KINDS)):
        best, n, right = None, 0, 0.0
        held = {r.bin: r for r in bins if r.kind == k}
        for at in range(200, 99, -1):  # bins without held-out proposals change no precision
            if at in held:
                n, right = n + held[at].n, right + held[at].right
            if n >= 10 and right / n >= precision:
                best = at / 200
        cut.append(best)
    return Model([_tree(t._call_java("rootNode")) for t in gbt.trees], list(gbt.treeWeights), cut)


def _text_of(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.concat_ws(",", F.transform(F.array_sort(spans), lambda s: F.concat_ws(
        ":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))))


def with_added(rows: DataFrame, model: Model) -> DataFrame:
    """``rows`` with t, d, base and a column ``added``: proposals that touch no base span, above the
    threshold of their kind, the likeliest of each chain."""
    free = rows.withColumn("found", proposals(F.col("t"), F.col("d"))).withColumn("found", untouched(F.col("found"), F.col("base")))
    scored = free.withColumn("found", F.transform("found", lambda s: F.struct(
        s["start"].alias("start"), s["end"].alias("end"), *described(s)))) \
        .withColumn("found", F.transform("found", lambda s: F.struct(
            s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end"), model.probability(s).alias("p"))))
    return scored.withColumn("found", F.filter("found", lambda s: model.selected(s, s["p"]))) \
        .withColumn("added", likeliest(F.col("found"))).drop("found")


def find_private(docs: DataFrame) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone (base spans), base_sha256, spans, n_added."""
    model = train(docs)
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("t"), has_digit(text).alias("d"))
    rows = rows.select("doc_id", "t", "d", *[base_spans(F.col("t"), F.col("d"), k).alias(f"b_{k}") for k in KINDS]) \
        .withColumn("base", F.concat(*[F.col(f"b_{k}") for k in KINDS]))
    none = F.array().cast(_SPAN)
    rows = with_added(rows, model) if model else rows.withColumn("added", none)
    return rows.select("doc_id", *[F.size(f"b_{k}").cast("long").alias(f"n_{k}") for k in KINDS],
                       F.sha2(_text_of(F.col("base")), 256).alias("base_sha256"),
                       _text_of(F.concat("base", "added")).alias("spans"), F.size("added").cast("long").alias("n_added"))
