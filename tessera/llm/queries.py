"""The registered queries of this subpackage: one per operator, each over its whole
table with production parameters, and the SQL twin where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tessera.llm.shared import prepare, table

Query = Callable[[SparkSession, str], DataFrame]


def op1_kd_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tessera.llm.shard_kd import kd_shards

    return kd_shards(table(spark, sf_dir, "documents"), shards=8)


def op2_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tessera.llm.shared import scratch
    from tessera.llm.token_files import read_index, write_tokens

    path = scratch(spark, "tokens")
    write_tokens(table(spark, sf_dir, "documents"), path)
    return read_index(spark, path)


def op3_pii_boosting(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tessera.llm.pii_boost import find_private

    return find_private(table(spark, sf_dir, "documents"))


def op4_toxic_pu(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tessera.llm.toxic_pu import score_documents

    return score_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_template_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tessera.llm.decontam_template import leaking_documents

    return leaking_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op6_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tessera.llm.license_lr import licences

    return licences(table(spark, sf_dir, "documents"))


def op7_lsh_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tessera.llm.lsh_forest import near_groups

    return near_groups(table(spark, sf_dir, "documents"))


def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tessera.llm.exact_dedup import exact_groups

    return exact_groups(table(spark, sf_dir, "documents"))


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tessera.llm.packing import pack_documents

    return pack_documents(table(spark, sf_dir, "documents"))


def op10_lang_zstd(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tessera.llm.lang_zstd import identify

    return identify(table(spark, sf_dir, "documents"))


def op11_simhash_golay(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tessera.llm.simhash_golay import near_fingerprints

    return near_fingerprints(table(spark, sf_dir, "documents"))


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tessera.llm.conversation_repair import repair_damaged

    return repair_damaged(table(spark, sf_dir, "conversations"))


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tessera.llm.filter_audit import audit_documents

    return audit_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def _crc32_sql(ascii_text: str) -> str:
    """CRC-32 of an ASCII string in SQL: one step a bit, low bits first."""
    bits = (f"flatten(list_transform(string_split({ascii_text}, ''), "
            "lambda c: list_transform(range(8), lambda i: (ord(c) >> i::int)::bigint & 1)))")
    return (f"xor(list_reduce(list_concat([4294967295::bigint], {bits}), "
            "lambda c, b: xor(c >> 1, 3988292384 * ((c + b) % 2))), 4294967295)")


def _repair_sql() -> str:
    """The repair as a recursion from the last row to the first; a state's value is the least
    (cost, audit, repaired text)."""
    def put(rest: str, letter: str, cost: str, line: str = "''") -> str:
        return (f"case when {rest} is not null then {{'c': {rest}.c + {cost}, 'a': '{letter}' || {rest}.a, "
                f"'t': {line} || {rest}.t}} end")

    def least(*options: str) -> str:
        return f"list_min(list_filter([{', '.join(options)}], lambda x: x is not null))"

    def line(role: str, text: str) -> str:
        return f"chr(10) || {role} || ':' || {text}"

    turn_to = ["u", "u", "a", "u"]
    role_of = {"u": "'user'", "a": "'assistant'"}
    kept = [{"s": "s", "u": "u"}, {"u": "u"}, {"a": "a"}, {"u": "u"}]
    cols = []
    for name, to, keep in zip("xsua", turn_to, kept, strict=True):
        drop = put("r." + name, "D", "2")
        again = put("r." + to, "R", "1 + extra", line(role_of[to], "text"))
        keeps = [f"case when not gone and ini = '{i}' then {put('r.' + t, 'K', 'extra', line('role', 'text'))} end"
                 for i, t in keep.items()]
        cols.append(least(drop, f"case when not gone then {again} end", *keeps) + f" as {name}")

    def insert(rest: str, role: str) -> str:
        return put(rest, "I", "5", line(f"'{role}'", "''"))

    step = ", ".join(cols)
    both = insert(f"({insert('a', 'assistant')})", "user")
    closed = (f"{least('x', insert('u', 'user'), both)} as x, {least('s', insert('u', 'user'), both)} as s, "
              f"{least('u', insert('a', 'assistant'))} as u, {least('a', insert('u', 'user'))} as a")
    kind = "struct(c bigint, a varchar, t varchar)"
    none = f"cast(null as {kind})"
    zero = f"cast({{'c': 0, 'a': '', 't': ''}} as {kind})"
    ends = f"{zero} as x, {none} as s, {none} as u, {zero} as a"
    key = "coalesce(conv_id::varchar, ' ') || ':' || coalesce(turn::varchar, ' ')"
    return rf"""
        with recursive p as (select conv_id, turn, coalesce(role, ' ') as role, coalesce(text, ' ') as text,
                                    {_crc32_sql(key)} % 20 as part from conversations),
        d as (select conv_id, turn, case part when 4 then 'user' else role end as role,
                     case part when 1 then '' when 2 then regexp_replace(text, '[.!?]', '', 'g') else text end as text,
                     unnest(range(case part when 3 then 2 else 1 end)) as copy from p where part <> 0),
        o as (select *, row_number() over w as i, lag(substr(role, 1, 1)) over w as prev, substr(role, 1, 1) as ini,
                     not regexp_matches(text, '[^ 	-]') as blank,
                     row_number() over (partition by conv_id, role, text order by turn nulls first, copy) > 1 as again,
                     not regexp_matches(text, '[.!?][ 	-]*$') as open
              from d window w as (partition by conv_id order by turn nulls first, role, md5(text), copy)),
        f as (select *, blank or again as gone, case when open then 5 else 0 end as extra from o),
        n as (select conv_id, count(*) as n, coalesce(max(turn) - min(turn) + 1 - count(distinct turn), 0) as gaps,
                     count(*) filter (blank) as blank, count(*) filter (again and not blank) as duplicate,
                     count(*) filter (open and not gone) as truncated,
                     count(*) filter (prev is not null and prev || ini not in ('su', 'ua', 'au')) as illegal
              from f group by conv_id),
        r as (select conv_id, n as i, {closed} from (select conv_id, n, {ends} from n)
              union all
              select conv_id, i, {closed} from (
                  select r.conv_id, r.i - 1 as i, {step} from r join f on f.conv_id is not distinct from r.conv_id and f.i = r.i)),
        b as (select conv_id, x from r where i = 0)
        select a.conv_id, coalesce(gaps, 0) as gaps, coalesce(blank, 0) as blank, coalesce(duplicate, 0) as duplicate,
               coalesce(truncated, 0) as truncated, coalesce(illegal, 0) as illegal, coalesce(b.x.c, 0) as cost,
               coalesce(b.x.a, '') as audit, sha256(substr(coalesce(b.x.t, ''), 2)) as repaired_sha256
        from (select distinct conv_id from conversations) a
        left join n on n.conv_id is not distinct from a.conv_id left join b on b.conv_id is not distinct from a.conv_id"""


ORACLES: dict[str, str] = {
    "op8_exact_dedup": r"""
        with d as (select doc_id, coalesce(text, '') t,
                          regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') norm from documents),
             k as (select doc_id, norm,
                          first_value(doc_id) over (partition by norm order by length(t) desc, doc_id) keep_id,
                          count(*) over (partition by norm) group_size from d)
        select doc_id, keep_id, group_size, doc_id = keep_id as kept, sha256(norm) as text_sha256 from k""",
    "op12_conversation_repair": _repair_sql(),
    "op13_filter_audit": r"""
        with d as (select coalesce(source, '') as part, coalesce(text, '') as t, doc_id,
                          list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') as ws from documents),
             l as (select doc_id, coalesce(bool_or(quality = 1), false) as good, coalesce(bool_or(toxic = 1), false) as toxic
                   from labels group by doc_id),
             m as (select part, coalesce(good, false) as good, coalesce(toxic, false) as toxic,
                          (len(ws) < 200)::int + 2 * (100 * len(list_distinct(ws)) < 50 * len(ws))::int
                          + 4 * (100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 2 * length(t))::int
                          + 8 * regexp_matches(t, '[#$%&*|]')::int
                          + 16 * coalesce(d.doc_id > min(d.doc_id) over (partition by t), false)::int as mask
                   from d left join l on d.doc_id = l.doc_id),
             c as (select part, mask, count(*) as n, count(*) filter (good) as good, count(*) filter (toxic) as toxic
                   from m group by part, mask),
             f as (select unnest(['A', 'B', 'C', 'D', 'E']) as x, unnest([1, 2, 4, 8, 16]) as bit),
             o as (select a.x || b.x || c.x || d.x || e.x as filter_order, [a.bit, b.bit, c.bit, d.bit, e.bit] as bits
                   from f a, f b, f c, f d, f e where a.bit + b.bit + c.bit + d.bit + e.bit = 31
                   and (a.bit | b.bit | c.bit | d.bit | e.bit) = 31),
             s as (select filter_order, step, bits[step] as bit, coalesce(list_sum(bits[1:step - 1]), 0)::int as state
                   from o, range(1, 6) t(step)),
             r as (select part, filter_order, step, bit,
                          coalesce(sum(n) filter (mask & (state | bit) = 0), 0) as kept,
                          coalesce(sum(n) filter (mask & state = 0 and mask & bit <> 0), 0) as removed,
                          coalesce(sum(n) filter (mask & state <> 0 and mask & bit <> 0), 0) as redundant,
                          coalesce(sum(n) filter (mask = bit), 0) as unique_fails,
                          coalesce(sum(good) filter (mask & state = 0 and mask & bit <> 0), 0) as good_lost,
                          coalesce(sum(toxic) filter (mask & state = 0 and mask & bit <> 0), 0) as toxic_lost
                   from c, s group by part, filter_order, step, bit)
        select part, filter_order, step::int as step, kept::bigint as kept, removed::bigint as removed,
               redundant::bigint as redundant, unique_fails::bigint as unique_fails, good_lost::bigint as good_lost,
               toxic_lost::bigint as toxic_lost, (sum(removed) over (partition by part, bit))::bigint as shapley from r""",
}

_QUERIES: list[Query] = [op1_kd_shards, op2_token_files, op3_pii_boosting, op4_toxic_pu, op5_template_decontamination, op6_license_scan, op7_lsh_forest, op8_exact_dedup, op9_packing, op10_lang_zstd,
                         op11_simhash_golay, op12_conversation_repair, op13_filter_audit]


def _with_checkpoint(fn: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        prepare(spark)
        return fn(spark, sf_dir)

    run.__name__, run.__doc__ = fn.__name__, fn.__doc__
    return run


def queries() -> dict[str, Query]:
    return {fn.__name__: _with_checkpoint(fn) for fn in _QUERIES}


def oracle_sql() -> dict[str, str]:
    return dict(ORACLES)
