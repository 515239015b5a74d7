"""DuckDB SQL oracles, one per query in ``queries`` that has a SQL form.

Each statement runs on views named after the shared tables.  Column names equal
the Spark plans' names; doubles are rounded the same way.
"""

from __future__ import annotations


_CODE = "'N' || translate(CAST({c} AS VARCHAR), '0123456789', 'ABCDEFGHIJ')"


def _case(col: str, mapping: dict, default: str) -> str:
    arms = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in mapping.items())
    return f"CASE {col} {arms} ELSE {default} END"


_RENAME = {"NA": "Nation Alpha", "NB": "Nation Bravo", "NC": "Nation Charlie"}

_PASSENGERS = """
  SELECT event_id, user_id, ts,
         CASE WHEN event_id % 9 = 0 THEN NULL ELSE event_type END AS event_type,
         event_type AS group_type,
         CASE WHEN event_id % 7 = 0 THEN NULL ELSE value END AS value,
         CASE WHEN event_id % 5 = 0 THEN NULL
              ELSE CAST(json_extract_string(props, '$.k') AS DOUBLE) END AS k
  FROM events"""

_SCORED = """
  SELECT l_orderkey, l_linenumber, CAST(l_returnflag = 'R' AS INTEGER) AS y,
         l_discount * 5 + l_tax * 5 AS p,
         CAST(l_discount * 5 + l_tax * 5 >= 0.5 AS INTEGER) AS pred
  FROM lineitem"""


def _hash_unit(key: str, seed: int) -> str:
    return (f"CAST(CAST('0x' || substr(md5('{seed}:' || CAST({key} AS VARCHAR)), 1, 8) AS BIGINT) AS DOUBLE)"
            f" / CAST(4294967296 AS DOUBLE)")


def _ratios(tp="tp", fp="fp", fn="fn", tn="tn") -> str:
    # ratios of integer counts are bit-identical in both engines: left unrounded
    return (f"CAST({tp} + {tn} AS DOUBLE) / ({tp} + {fp} + {fn} + {tn}) AS accuracy, "
            f"coalesce(CAST({tp} AS DOUBLE) / nullif({tp} + {fp}, 0), 0) AS precision, "
            f"coalesce(CAST({tp} AS DOUBLE) / nullif({tp} + {fn}, 0), 0) AS recall, "
            f"coalesce(CAST(2 * {tp} AS DOUBLE) / nullif(2 * {tp} + {fp} + {fn}, 0), 0) AS f1")


_COUNTS = ("count_if(y = 1 AND pred = 1) AS tp, count_if(y <> 1 AND pred = 1) AS fp, "
           "count_if(y = 1 AND pred <> 1) AS fn, count_if(y <> 1 AND pred <> 1) AS tn")


def _describe_sql() -> str:
    parts = []
    for c in ["p_partkey", "p_size", "p_retailprice"]:
        v = f"CAST({c} AS DOUBLE)"
        parts.append(
            f"SELECT '{c}' AS column_name, count({c}) AS count, (round(avg({v}), 4) + 0.0::DOUBLE) AS mean, "
            f"(round(stddev_samp({v}), 4) + 0.0::DOUBLE) AS std, (round(min({v}), 4) + 0.0::DOUBLE) AS min, "
            f"(round(quantile_cont({v}, 0.25), 4) + 0.0::DOUBLE) AS p25, (round(quantile_cont({v}, 0.5), 4) + 0.0::DOUBLE) AS p50, "
            f"(round(quantile_cont({v}, 0.75), 4) + 0.0::DOUBLE) AS p75, (round(max({v}), 4) + 0.0::DOUBLE) AS max FROM part")
    return "\nUNION ALL\n".join(parts)


def _profile_sql() -> str:
    cols = [("p_partkey", "bigint"), ("p_name", "string"), ("p_brand", "string"), ("p_type", "string"),
            ("p_size", "int"), ("p_retailprice", "double")]
    return "\nUNION ALL\n".join(f"SELECT '{c}' AS column_name, count({c}) AS non_null, '{t}' AS dtype FROM part"
                                for c, t in cols)


_BASIN_CTE = """
  s AS (SELECT event_id, user_id, value AS h,
               row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS pos FROM events),
  f AS (SELECT *,
          max(h) OVER (PARTITION BY user_id ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS bank,
          max(h) OVER (PARTITION BY user_id ORDER BY pos ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS rbank
        FROM s),
  g AS (SELECT *, (bank IS NULL OR h > bank) AS is_bank, (rbank IS NULL OR h > rbank) AS is_rbank FROM f)"""


def oracle_sql() -> dict[str, str]:
    q: dict[str, str] = {}
    code_n, code_c = _CODE.format(c="n_nationkey"), _CODE.format(c="c_nationkey")
    q["clean_join"] = f"""
WITH raw AS (
  SELECT {code_n} || ' (' || CAST(n_regionkey AS VARCHAR) || ')' || CAST(n_nationkey AS VARCHAR) AS raw,
         n_regionkey,
         CASE WHEN n_nationkey % 4 = 0 THEN '...' ELSE CAST(n_nationkey * 10 AS VARCHAR) END AS supply
  FROM nation),
energy AS (
  SELECT {_case("trim(regexp_replace(regexp_replace(raw, '\\(.*\\)', '', 'g'), '\\d+', '', 'g'))", _RENAME,
                "trim(regexp_replace(regexp_replace(raw, '\\(.*\\)', '', 'g'), '\\d+', '', 'g'))")} AS Country,
         n_regionkey, TRY_CAST(nullif(trim(supply), '...') AS DOUBLE) * 1000000 AS supply_gj
  FROM raw),
gdp AS (
  SELECT {_case(code_c, _RENAME, code_c)} AS Country, count(*) AS customers, avg(c_acctbal) AS avg_acctbal
  FROM customer WHERE c_acctbal <= 9000 GROUP BY c_nationkey)
SELECT e.Country, r.r_name AS region, e.supply_gj, g.customers, (round(g.avg_acctbal, 4) + 0.0::DOUBLE) AS avg_acctbal
FROM energy e JOIN gdp g ON e.Country = g.Country JOIN region r ON e.n_regionkey = r.r_regionkey"""

    q["row_mean_rank"] = """
WITH y AS (
  SELECT l_orderkey, l_linenumber,
    CASE WHEN l_linenumber IN (3, 5) THEN NULL ELSE l_quantity END AS c1,
    CASE WHEN l_linenumber = 5 THEN NULL ELSE l_extendedprice / 1000 END AS c2,
    CASE WHEN l_linenumber = 5 THEN NULL ELSE l_discount * 100 END AS c3,
    CASE WHEN l_linenumber IN (3, 5) THEN NULL ELSE l_tax * 100 END AS c4
  FROM lineitem),
m AS (
  SELECT *, (0.0::DOUBLE + coalesce(c1, 0.0) + coalesce(c2, 0.0) + coalesce(c3, 0.0) + coalesce(c4, 0.0))
            / nullif(CAST(c1 IS NOT NULL AS INTEGER) + CAST(c2 IS NOT NULL AS INTEGER)
                     + CAST(c3 IS NOT NULL AS INTEGER) + CAST(c4 IS NOT NULL AS INTEGER), 0) AS rm
  FROM y)
SELECT l_orderkey, l_linenumber, (round(rm, 4) + 0.0::DOUBLE) AS row_mean,
       row_number() OVER (ORDER BY rm DESC NULLS LAST, l_orderkey, l_linenumber) - 1 AS position
FROM m ORDER BY rm DESC NULLS LAST, l_orderkey, l_linenumber LIMIT 10"""

    q["ratio_argmax"] = """
WITH per AS (
  SELECT o_custkey, sum(CASE WHEN o_orderstatus = 'F' THEN o_totalprice ELSE 0.0 END) AS f,
         sum(o_totalprice) AS t FROM orders GROUP BY o_custkey),
r AS (SELECT o_custkey, f / nullif(t, 0) AS ratio FROM per)
SELECT o_custkey, (round(ratio, 6) + 0.0::DOUBLE) AS max_ratio FROM r WHERE ratio IS NOT NULL
ORDER BY ratio DESC, o_custkey LIMIT 1"""

    q["nth_label"] = """
SELECT c_custkey, c_name, c_acctbal, 2 AS position FROM customer
ORDER BY c_acctbal DESC NULLS LAST, c_custkey LIMIT 1 OFFSET 2"""

    q["lookup_cell"] = """
SELECT c_custkey, c_mktsegment, c_acctbal, (SELECT n_name FROM nation WHERE n_nationkey = 3) AS nation FROM customer
WHERE c_custkey = (SELECT c_custkey FROM customer ORDER BY c_acctbal DESC NULLS LAST, c_custkey LIMIT 1 OFFSET 5)"""

    q["corr_pair"] = """
SELECT l_returnflag,
       (round(corr(CASE WHEN l_linenumber = 3 THEN NULL ELSE l_quantity END, l_extendedprice), 6) + 0.0::DOUBLE) AS corr
FROM lineitem GROUP BY l_returnflag"""

    zones = {f"NATION_{k}": f"zone {k % 5}" for k in range(25) if k % 9}
    q["group_stats"] = f"""
WITH cn AS (
  SELECT c.c_acctbal, {_case("n.n_name", zones, "NULL")} AS zone
  FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey)
SELECT zone, count(*) AS size, (round(sum(c_acctbal), 2) + 0.0::DOUBLE) AS sum, (round(avg(c_acctbal), 4) + 0.0::DOUBLE) AS mean,
       (round(stddev_samp(c_acctbal), 4) + 0.0::DOUBLE) AS std
FROM cn WHERE zone IS NOT NULL GROUP BY zone"""

    q["random_rows"] = """
WITH t AS (SELECT c_custkey, c_name, row_number() OVER (ORDER BY c_custkey) - 1 AS pos FROM customer),
d AS (SELECT draw, CAST('0x' || substr(md5('3:' || CAST(draw AS VARCHAR)), 1, 12) AS BIGINT) % (SELECT count(*) FROM customer) AS pos
      FROM (SELECT unnest(range(16)) AS draw))
SELECT draw, c_custkey, c_name FROM d JOIN t USING (pos)"""

    q["describe"] = _describe_sql()
    q["profile"] = _profile_sql()

    q["group_median_fill"] = f"""
WITH ev AS ({_PASSENGERS}),
med AS (SELECT group_type, median(value) AS m FROM ev GROUP BY group_type)
SELECT ev.event_id, ev.group_type, (round(coalesce(ev.value, med.m), 4) + 0.0::DOUBLE) AS value
FROM ev LEFT JOIN med ON ev.group_type = med.group_type"""

    q["median_fill"] = f"""
WITH ev AS ({_PASSENGERS})
SELECT event_id, (round(coalesce(value, (SELECT median(value) FROM ev)), 4) + 0.0::DOUBLE) AS value,
       (round(coalesce(k, (SELECT median(k) FROM ev)), 4) + 0.0::DOUBLE) AS k FROM ev"""

    q["mode_fill"] = f"""
WITH ev AS ({_PASSENGERS}),
m AS (SELECT event_type FROM ev WHERE event_type IS NOT NULL GROUP BY event_type
      ORDER BY count(*) DESC, event_type LIMIT 1)
SELECT event_id, coalesce(ev.event_type, (SELECT event_type FROM m)) AS event_type FROM ev"""

    q["impute_rules"] = f"""
WITH ev AS (SELECT *, {_hash_unit("event_id", 7)} < 0.25 AS is_test FROM ({_PASSENGERS})),
gm AS (SELECT group_type, user_id, median(value) AS gm FROM ev WHERE NOT is_test GROUP BY group_type, user_id),
mo AS (SELECT event_type AS mo FROM ev WHERE NOT is_test AND event_type IS NOT NULL GROUP BY event_type
       ORDER BY count(*) DESC, event_type LIMIT 1)
SELECT ev.event_id, ev.is_test, (round(coalesce(ev.value, gm.gm), 4) + 0.0::DOUBLE) AS value,
       (round(coalesce(ev.k, (SELECT median(k) FROM ev WHERE NOT is_test)), 4) + 0.0::DOUBLE) AS k,
       coalesce(ev.event_type, (SELECT mo FROM mo)) AS event_type
FROM ev LEFT JOIN gm ON ev.group_type = gm.group_type AND ev.user_id = gm.user_id"""

    q["class_counts"] = "SELECT event_type, count(*) AS n FROM events GROUP BY event_type"
    q["distinct_values"] = "SELECT DISTINCT event_type FROM events"
    q["pop_mean_std"] = """
SELECT o_orderstatus, (round(avg(o_totalprice), 2) + 0.0::DOUBLE) AS mean, (round(stddev_pop(o_totalprice), 2) + 0.0::DOUBLE) AS std
FROM orders GROUP BY o_orderstatus"""
    q["extremes"] = """
SELECT l_returnflag, max(l_extendedprice) AS max_price, min(l_extendedprice) AS min_price
FROM lineitem GROUP BY l_returnflag"""

    rounded = "SELECT o_orderkey, o_custkey, o_orderstatus, (round(o_totalprice, -1) + 0.0::DOUBLE) AS bucket FROM orders"
    q["ambiguous_keys"] = f"""
WITH o AS ({rounded})
SELECT o_orderkey, bucket FROM o WHERE bucket IN (SELECT bucket FROM o GROUP BY bucket HAVING count(*) > 1)"""
    q["unique_keys"] = f"""
WITH o AS ({rounded})
SELECT o_orderkey, bucket FROM o WHERE bucket IN (SELECT bucket FROM o GROUP BY bucket HAVING count(*) = 1)"""
    q["groups_all"] = """
SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey IN (
  SELECT o_custkey FROM orders GROUP BY o_custkey HAVING bool_and(coalesce(o_orderstatus = 'F', false)))"""

    q["eliminate_by_groups"] = """
WITH src AS (
  SELECT CAST(l_orderkey AS BIGINT) AS x, CAST(l_partkey AS BIGINT) AS y FROM lineitem),
pairs AS (SELECT DISTINCT least(x, y) AS a, greatest(x, y) AS b FROM src),
p AS (SELECT a, b, a * b AS prod, a + b AS total FROM pairs),
amb AS (SELECT prod FROM p GROUP BY prod HAVING count(*) > 1),
step1 AS (SELECT * FROM p WHERE prod IN (SELECT prod FROM amb)),
goods AS (SELECT total FROM p GROUP BY total HAVING bool_and(prod IN (SELECT prod FROM amb))),
step2 AS (SELECT * FROM step1 WHERE total IN (SELECT total FROM goods)),
step3 AS (SELECT * FROM step2 WHERE prod IN (SELECT prod FROM step2 GROUP BY prod HAVING count(*) = 1)),
step4 AS (SELECT * FROM step3 WHERE total IN (SELECT total FROM step3 GROUP BY total HAVING count(*) = 1))
SELECT a, b, prod, total FROM step4"""

    q["range_pairs"] = """
WITH a AS (
  SELECT s_suppkey, CAST(s_nationkey AS BIGINT) + 3 AS hi,
         unnest(generate_series(CAST(s_nationkey AS BIGINT), CAST(s_nationkey AS BIGINT) + 3)) AS i
  FROM supplier)
SELECT s_suppkey, i, unnest(generate_series(i, hi)) AS j FROM a"""

    q["deepest_basin"] = f"""
WITH {_BASIN_CTE},
  g2 AS (SELECT *,
           min(CASE WHEN is_bank THEN pos END) OVER (PARTITION BY user_id ORDER BY pos
               ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS next_bank,
           max(CASE WHEN is_rbank THEN pos END) OVER (PARTITION BY user_id ORDER BY pos
               ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prev_rbank
         FROM g),
  fl AS (SELECT user_id, bank AS b, min(h) AS low FROM g2 WHERE NOT is_bank GROUP BY user_id, bank),
  rl AS (SELECT user_id, rbank AS b, min(h) AS low FROM g2 WHERE NOT is_rbank GROUP BY user_id, rbank),
  cand AS (
    SELECT g2.user_id, 0 AS dir, g2.pos AS left_index, g2.next_bank AS right_index, g2.h - fl.low AS depth, fl.low AS lowest
    FROM g2 JOIN fl ON g2.user_id = fl.user_id AND g2.h = fl.b WHERE g2.is_bank AND g2.next_bank IS NOT NULL
    UNION ALL
    SELECT g2.user_id, 1, g2.prev_rbank, g2.pos, g2.h - rl.low, rl.low
    FROM g2 JOIN rl ON g2.user_id = rl.user_id AND g2.h = rl.b WHERE g2.is_rbank AND g2.prev_rbank IS NOT NULL),
  ranked AS (
    SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY depth DESC, dir,
                                 CASE WHEN dir = 0 THEN right_index ELSE -left_index END) AS rn
    FROM cand WHERE depth > 0)
SELECT user_id, left_index, right_index, (round(depth, 4) + 0.0::DOUBLE) AS depth,
       (round(lowest, 4) + 0.0::DOUBLE) AS lowest FROM ranked WHERE rn = 1"""

    q["running_bank"] = f"""
WITH {_BASIN_CTE}
SELECT event_id, user_id, pos, bank, is_bank FROM g"""

    q["first_reaching"] = """
WITH r AS (
  SELECT o_custkey, o_orderkey, o_orderdate,
         sum(o_totalprice) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey
                                 ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS running
  FROM orders),
h AS (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS rn
      FROM r WHERE running >= 500000)
SELECT o_custkey, o_orderkey, (round(running, 2) + 0.0::DOUBLE) AS running FROM h WHERE rn = 1"""

    q["capacity_lookup"] = """
WITH RECURSIVE req AS (
  SELECT s_suppkey, CAST(trunc(abs(s_acctbal)) AS BIGINT) + 1 AS floors, (s_nationkey % 4) + 1 AS glasses
  FROM supplier),
cap(n, f1, f2, f3, f4) AS (
  SELECT 0::BIGINT, 0::BIGINT, 0::BIGINT, 0::BIGINT, 0::BIGINT
  UNION ALL
  SELECT n + 1, n + 1, f1 + f2 + 1, f2 + f3 + 1, f3 + f4 + 1 FROM cap WHERE n < (SELECT max(floors) FROM req))
SELECT s_suppkey, floors, glasses,
       (SELECT min(n) FROM cap WHERE n >= 1 AND
          (CASE glasses WHEN 1 THEN f1 WHEN 2 THEN f2 WHEN 3 THEN f3 ELSE f4 END) >= floors) AS trials
FROM req"""

    q["top_abs"] = """
SELECT p_partkey, (round(p_retailprice - 1500, 4) + 0.0::DOUBLE) AS score FROM part
ORDER BY abs(p_retailprice - 1500) DESC, p_partkey LIMIT 15"""
    q["sorted_nulls_last"] = """
SELECT s_suppkey, CASE WHEN s_suppkey % 10 = 0 THEN NULL ELSE s_acctbal END AS bal FROM supplier
ORDER BY bal DESC NULLS LAST, s_suppkey"""

    q["array_scale"] = """
SELECT vec_id, CAST(len(embedding) AS INTEGER) AS n,
       (round(list_reduce(list_transform(embedding, lambda x: CAST(x AS DOUBLE) / 255.0::DOUBLE), lambda a, b: a + b), 8) + 0.0::DOUBLE)
         AS total
FROM embeddings"""
    q["dot"] = """
SELECT vec_id,
       (round(0.5::DOUBLE + list_reduce(list_transform(range(64), lambda i: CAST(embedding[i + 1] AS DOUBLE)
             * (CAST((i % 7) - 3 AS DOUBLE) / 10::DOUBLE)), lambda a, b: a + b), 6) + 0.0::DOUBLE) AS score,
       (round(CAST(embedding[4] AS DOUBLE), 6) + 0.0::DOUBLE) AS x3
FROM embeddings"""
    q["text_clean"] = """
SELECT c_custkey,
       regexp_replace(trim(regexp_replace(c_name || ' (seg ' || c_mktsegment || ')', '\\(.*\\)', '', 'g')),
                      '\\d+', '', 'g') AS clean,
       format('{:,.0f}', c_acctbal) AS bal_text
FROM customer"""

    dummies = ", ".join(f"CAST(c_mktsegment = '{s}' AS INTEGER) AS c_mktsegment_{s}"
                        for s in ["BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"])
    q["dummies"] = f"SELECT c_custkey, {dummies} FROM customer"
    q["label_codes"] = "SELECT p_partkey, dense_rank() OVER (ORDER BY p_type) - 1 AS code FROM part"
    q["one_hot"] = """
SELECT p_partkey, dense_rank() OVER (ORDER BY p_brand) - 1 AS hot,
       CAST((SELECT count(DISTINCT p_brand) FROM part) AS INTEGER) AS width FROM part"""
    q["standardize"] = """
WITH s AS (SELECT avg(l_quantity) AS m1, stddev_pop(l_quantity) AS s1,
                  avg(l_extendedprice) AS m2, stddev_pop(l_extendedprice) AS s2 FROM lineitem)
SELECT l_orderkey, l_linenumber, (round((l_quantity - m1) / s1, 4) + 0.0::DOUBLE) AS q_z, (round((l_extendedprice - m2) / s2, 4) + 0.0::DOUBLE) AS p_z
FROM lineitem, s"""
    q["hash_split"] = f"SELECT o_orderkey, {_hash_unit('o_orderkey', 42)} < 0.25 AS is_test FROM orders"
    q["stratified_split"] = f"""
WITH h AS (SELECT o_orderkey, o_orderstatus, {_hash_unit('o_orderkey', 42)} AS u FROM orders),
r AS (SELECT *, row_number() OVER (PARTITION BY o_orderstatus ORDER BY u, o_orderkey) - 1 AS o,
             count(*) OVER (PARTITION BY o_orderstatus) AS n FROM h)
SELECT o_orderkey, o_orderstatus, o < ceil(n * 0.25) AS is_test FROM r"""
    q["folds"] = """
SELECT o_orderkey, o_orderstatus,
       CAST(ntile(5) OVER (PARTITION BY o_orderstatus ORDER BY o_orderkey) - 1 AS INTEGER) AS fold
FROM orders"""

    q["metrics"] = f"WITH s AS ({_SCORED}), c AS (SELECT {_COUNTS} FROM s) SELECT {_ratios()} FROM c"
    q["auc"] = f"""
WITH s AS ({_SCORED}),
g AS (SELECT l_linenumber, p, count_if(y = 1) AS pos, count_if(y <> 1) AS neg FROM s GROUP BY l_linenumber, p),
c AS (SELECT *, coalesce(sum(neg) OVER (PARTITION BY l_linenumber ORDER BY p
                                         ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS nb FROM g),
g0 AS (SELECT p, count_if(y = 1) AS pos, count_if(y <> 1) AS neg FROM s GROUP BY p),
c0 AS (SELECT *, coalesce(sum(neg) OVER (ORDER BY p ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS nb
       FROM g0)
SELECT l_linenumber, (round(sum(pos * (nb + neg / 2.0)) / (sum(pos) * sum(neg)), 6) + 0.0::DOUBLE) AS auc FROM c GROUP BY l_linenumber
UNION ALL
SELECT 0 AS l_linenumber, (round(sum(pos * (nb + neg / 2.0)) / (sum(pos) * sum(neg)), 6) + 0.0::DOUBLE) AS auc FROM c0"""
    house = "SELECT l_extendedprice / 1000 AS y, l_quantity * 1.5 + 3 AS z, l_returnflag FROM lineitem"
    q["r2"] = f"""
WITH h AS ({house})
SELECT l_returnflag, (round(1 - sum((y - z) * (y - z)) / (var_pop(y) * count(y)), 6) + 0.0::DOUBLE) AS r2
FROM h GROUP BY l_returnflag"""
    q["half_mse"] = f"""
WITH h AS ({house})
SELECT l_returnflag, (round(sum((z - y) * (z - y)) / (2 * count(*)), 4) + 0.0::DOUBLE) AS J FROM h GROUP BY l_returnflag"""
    q["threshold_sweep"] = f"""
WITH s AS ({_SCORED}),
t AS (SELECT 0.1::DOUBLE + 0.05::DOUBLE * CAST(i AS DOUBLE) AS threshold FROM range(17) r(i)),
c AS (SELECT t.threshold,
             count_if(s.y = 1 AND s.p >= t.threshold) AS tp, count_if(s.y <> 1 AND s.p >= t.threshold) AS fp,
             count_if(s.y = 1 AND s.p < t.threshold) AS fn, count_if(s.y <> 1 AND s.p < t.threshold) AS tn
      FROM t, s GROUP BY t.threshold)
SELECT (round(threshold, 2) + 0.0::DOUBLE) AS threshold, {_ratios()} FROM c"""
    q["confusion"] = f"""
WITH s AS ({_SCORED}) SELECT y AS actual, pred AS predicted, count(*) AS n FROM s GROUP BY y, pred"""
    q["scores_by_split"] = f"""
WITH s AS (SELECT *, {_hash_unit('l_orderkey', 42)} < 0.25 AS is_test FROM ({_SCORED}))
SELECT is_test, avg(CAST(y = pred AS DOUBLE)) AS accuracy FROM s GROUP BY is_test"""
    q["metrics_table"] = f"""
WITH s AS ({_SCORED}),
c AS (SELECT 'cut_050' AS model, {_COUNTS} FROM s
      UNION ALL
      SELECT 'cut_030', count_if(y = 1 AND p >= 0.3), count_if(y <> 1 AND p >= 0.3),
             count_if(y = 1 AND p < 0.3), count_if(y <> 1 AND p < 0.3) FROM s),
w AS (SELECT model, {_ratios()} FROM c)
UNPIVOT w ON accuracy, precision, recall, f1 INTO NAME metric VALUE value"""

    q["ols"] = """
SELECT l_returnflag, (round(regr_slope(l_extendedprice, l_quantity), 4) + 0.0::DOUBLE) AS slope,
       (round(regr_intercept(l_extendedprice, l_quantity), 4) + 0.0::DOUBLE) AS intercept,
       (round(regr_r2(l_extendedprice, l_quantity), 6) + 0.0::DOUBLE) AS r2
FROM lineitem GROUP BY l_returnflag"""
    q["gd_steps"] = """
WITH RECURSIVE d AS (SELECT l_quantity / 50 AS x, l_extendedprice / 100000 AS y FROM lineitem),
s AS (SELECT CAST(count(*) AS DOUBLE) AS m, sum(x) AS sx, sum(y) AS sy, sum(x * x) AS sxx, sum(x * y) AS sxy,
             sum(y * y) AS syy FROM d),
it(i, b, w) AS (
  SELECT 0, 0.0::DOUBLE, 0.0::DOUBLE
  UNION ALL
  SELECT i + 1, b - 0.1 * (m * b + sx * w - sy) / m, w - 0.1 * (b * sx + sxx * w - sxy) / m
  FROM it, s WHERE i < 5)
SELECT i AS iteration, (round(b, 8) + 0.0::DOUBLE) AS b, (round(w, 8) + 0.0::DOUBLE) AS w,
       (round((m * b * b + w * sxx * w + syy + 2 * b * (sx * w) - 2 * b * sy - 2 * (w * sxy)) / (2 * m), 8) + 0.0::DOUBLE) AS J
FROM it, s WHERE i >= 1"""
    q["cost_history"] = """
WITH RECURSIVE d AS (SELECT l_quantity / 50 AS x1, l_discount * 10 AS x2, l_extendedprice / 100000 AS y
                     FROM lineitem),
s AS (SELECT CAST(count(*) AS DOUBLE) AS m, sum(x1) AS s1, sum(x2) AS s2, sum(y) AS sy, sum(x1 * x1) AS s11,
             sum(x1 * x2) AS s12, sum(x2 * x2) AS s22, sum(x1 * y) AS s1y, sum(x2 * y) AS s2y, sum(y * y) AS syy
      FROM d),
it(i, b, w1, w2, j, j1, j2) AS (
  SELECT 0, 0.0::DOUBLE, 0.0::DOUBLE, 0.0::DOUBLE, -1.0::DOUBLE, NULL::DOUBLE, NULL::DOUBLE
  UNION ALL
  SELECT i + 1, nb, nw1, nw2,
         (m * nb * nb + (nw1 * nw1 * s11 + 2 * nw1 * nw2 * s12 + nw2 * nw2 * s22) + syy
          + 2 * nb * (s1 * nw1 + s2 * nw2) - 2 * nb * sy - 2 * (nw1 * s1y + nw2 * s2y)) / (2 * m),
         j, j1
  FROM (SELECT it.*, s.*,
               b - 0.5 * (m * b + s1 * w1 + s2 * w2 - sy) / m AS nb,
               w1 - 0.5 * (b * s1 + s11 * w1 + s12 * w2 - s1y) / m AS nw1,
               w2 - 0.5 * (b * s2 + s12 * w1 + s22 * w2 - s2y) / m AS nw2
        FROM it, s) t
  WHERE NOT (i >= 3 AND abs(j2 - j1) < 1e-10) AND i <= 10001)
SELECT CAST(i AS INTEGER) AS iteration, (round(j, 10) + 0.0::DOUBLE) AS J FROM it WHERE i >= 1"""
    q["dbscan"] = """
WITH RECURSIVE p AS (SELECT c_custkey AS id, c_acctbal / 1000 AS x, c_nationkey * 0.4::DOUBLE AS y FROM customer),
nb AS (SELECT a.id, b.id AS id2 FROM p a JOIN p b
       ON (0.0::DOUBLE + (a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y)) <= 0.5625),
core AS (SELECT id FROM nb GROUP BY id HAVING count(*) >= 20),
ce AS (SELECT nb.id, nb.id2 FROM nb JOIN core c1 ON nb.id = c1.id JOIN core c2 ON nb.id2 = c2.id),
reach(id, root) AS (SELECT id, id FROM core UNION SELECT ce.id2, r.root FROM reach r JOIN ce ON r.id = ce.id),
comp AS (SELECT id, min(root) AS root FROM reach GROUP BY id),
lab AS (SELECT root, dense_rank() OVER (ORDER BY root) - 1 AS label FROM (SELECT DISTINCT root FROM comp)),
core_lab AS (SELECT comp.id, lab.label FROM comp JOIN lab ON comp.root = lab.root),
border AS (SELECT nb.id, min(cl.label) AS label FROM nb JOIN core_lab cl ON nb.id2 = cl.id
           WHERE nb.id NOT IN (SELECT id FROM core) GROUP BY nb.id)
SELECT p.id AS c_custkey, CAST(coalesce(cl.label, b.label, -1) AS INTEGER) AS label,
       p.id IN (SELECT id FROM core) AS is_core
FROM p LEFT JOIN core_lab cl ON p.id = cl.id LEFT JOIN border b ON p.id = b.id"""
    q["components"] = """
WITH RECURSIVE e AS (
  SELECT DISTINCT a.l_partkey AS src, b.l_partkey AS dst FROM lineitem a JOIN lineitem b
  ON a.l_orderkey = b.l_orderkey AND b.l_linenumber = a.l_linenumber + 1 WHERE a.l_partkey <> b.l_partkey),
s AS (SELECT src AS a, dst AS b FROM e UNION SELECT dst, src FROM e),
reach(node, root) AS (SELECT DISTINCT a, a FROM s UNION SELECT s.b, r.root FROM reach r JOIN s ON r.node = s.a)
SELECT node AS part, min(root) AS component FROM reach GROUP BY node"""
    # single linkage: the tree grown point by point, the next point by (square, smaller id, larger id)
    prim = """
WITH RECURSIVE pt AS (SELECT s_suppkey AS id, s_acctbal / 1000 AS x, s_nationkey * 0.4::DOUBLE AS y FROM supplier),
first AS (SELECT * FROM pt ORDER BY id LIMIT 1),
prim AS (
  SELECT 1 AS step, p.id, p.x, p.y, p.id = f.id AS used,
         (p.x - f.x) * (p.x - f.x) + (p.y - f.y) * (p.y - f.y) AS d2, least(p.id, f.id) AS a, greatest(p.id, f.id) AS b
  FROM pt p, first f
  UNION ALL
  SELECT step + 1, id, x, y, used OR id = pid, CASE WHEN closer THEN nd ELSE d2 END, CASE WHEN closer THEN least(id, pid) ELSE a END,
         CASE WHEN closer THEN greatest(id, pid) ELSE b END
  FROM (SELECT *, NOT used AND id <> pid AND (nd < d2 OR nd = d2 AND (least(id, pid) < a OR least(id, pid) = a AND greatest(id, pid) < b)) AS closer
        FROM (SELECT *, (x - px) * (x - px) + (y - py) * (y - py) AS nd
              FROM (SELECT *, first_value(id) OVER w AS pid, first_value(x) OVER w AS px, first_value(y) OVER w AS py
                    FROM prim WHERE step < (SELECT count(*) FROM pt) WINDOW w AS (ORDER BY used, d2, a, b)))))
, mst AS (SELECT a, b, d2 FROM prim WHERE step = (SELECT count(*) FROM pt) AND id <> (SELECT id FROM first))"""
    q["single_link_merges"] = prim + " SELECT a, b, round(sqrt(d2), 9) AS height FROM mst"
    q["single_link"] = prim + """,
kept AS (SELECT a, b, d2 FROM mst ORDER BY d2 DESC, a DESC, b DESC OFFSET 4),
ways AS (SELECT a, b FROM kept UNION ALL SELECT b, a FROM kept),
reach(id, root) AS (SELECT id, id FROM pt UNION SELECT ways.b, r.root FROM reach r JOIN ways ON r.id = ways.a)
SELECT id AS s_suppkey, CAST(dense_rank() OVER (ORDER BY root) - 1 AS INTEGER) AS label,
       (SELECT round(sqrt(max(d2)), 9) FROM kept) AS height
FROM (SELECT id, min(root) AS root FROM reach GROUP BY id)"""
    # held-out R^2 per fold: the line of the other folds against the fold's own rows
    q["cv_linear"] = """
WITH li AS (SELECT l_orderkey % 5 AS fold, CAST(l_quantity AS DOUBLE) AS x, CAST(l_extendedprice AS DOUBLE) AS y FROM lineitem),
line AS (SELECT f.fold, regr_slope(li.y, li.x) AS b, regr_intercept(li.y, li.x) AS a
         FROM (SELECT DISTINCT fold FROM li) f JOIN li ON li.fold <> f.fold GROUP BY f.fold),
own AS (SELECT fold, avg(y) AS m, count(*) AS n FROM li GROUP BY fold)
SELECT li.fold, any_value(own.n) AS n,
       round(1 - sum((y - a - b * x) * (y - a - b * x)) / sum((y - m) * (y - m)), 6) AS r2
FROM li JOIN line ON li.fold = line.fold JOIN own ON li.fold = own.fold GROUP BY li.fold"""
    q["theta_sums"] = """
SELECT c_custkey, count(o_orderkey) AS matches, CAST(coalesce(sum(CAST(round(o_totalprice * 100) AS BIGINT)), 0) AS BIGINT) AS cents
FROM customer LEFT JOIN orders ON c_acctbal * 20 >= o_totalprice GROUP BY c_custkey"""
    q["range_matches"] = """
SELECT l_orderkey, l_linenumber, p_partkey FROM lineitem JOIN part
ON l_extendedprice BETWEEN p_retailprice * 20 - 2 AND p_retailprice * 20 + 2"""
    q["least_tier"] = """
SELECT l_orderkey, l_linenumber, (SELECT min(s_suppkey) FROM supplier
                                  WHERE s_suppkey % 3 = l_suppkey % 3 AND s_acctbal * 10 >= l_extendedprice) AS least
FROM lineitem"""
    # complete linkage, greedily: the closest two clusters merge, distances to others are the larger ones
    q["complete_link"] = """
WITH RECURSIVE pt AS (SELECT s_suppkey AS id, s_acctbal / 1000 AS x, s_nationkey * 0.4::DOUBLE AS y FROM supplier),
m AS (
  SELECT 1 AS step, p.id AS a, q.id AS b, (p.x - q.x) * (p.x - q.x) + (p.y - q.y) * (p.y - q.y) AS d2 FROM pt p JOIN pt q ON p.id < q.id
  UNION ALL
  SELECT step + 1, least(na, nb), greatest(na, nb), max(d2)
  FROM (SELECT step, d2, CASE WHEN a = mb THEN ma ELSE a END AS na, CASE WHEN b = mb THEN ma ELSE b END AS nb
        FROM (SELECT *, first_value(a) OVER w AS ma, first_value(b) OVER w AS mb FROM m WINDOW w AS (ORDER BY d2, a, b)))
  WHERE na <> nb GROUP BY step, least(na, nb), greatest(na, nb)),
merges AS (SELECT a, b, d2 FROM m QUALIFY row_number() OVER (PARTITION BY step ORDER BY d2, a, b) = 1),
kept AS (SELECT a, b, d2 FROM merges ORDER BY d2 DESC, a DESC, b DESC OFFSET 4),
ways AS (SELECT a, b FROM kept UNION ALL SELECT b, a FROM kept),
reach(id, root) AS (SELECT id, id FROM pt UNION SELECT ways.b, r.root FROM reach r JOIN ways ON r.id = ways.a)
SELECT id AS s_suppkey, CAST(dense_rank() OVER (ORDER BY root) - 1 AS INTEGER) AS label,
       (SELECT round(sqrt(max(d2)), 9) FROM kept) AS height
FROM (SELECT id, min(root) AS root FROM reach GROUP BY id)"""
    q["metric_row"] = f"""
SELECT m.accuracy AS cut_accuracy, m.precision AS cut_precision, m.recall AS cut_recall, m.f1 AS cut_f1, a.auc AS rank_auc
FROM ({q["metrics"]}) m, (SELECT auc FROM ({q["auc"]}) WHERE l_linenumber = 0) a"""
    q["user_function"] = """
SELECT l_orderkey, l_linenumber,
       CAST(round(l_extendedprice * 100) AS BIGINT) * (100 - CAST(round(l_discount * 100) AS BIGINT)) // 100 AS cents FROM lineitem"""
    q["group_members"] = """
SELECT l_orderkey, string_agg(l_linenumber || ':' || l_partkey, ',' ORDER BY l_linenumber, l_partkey) AS members
FROM lineitem GROUP BY l_orderkey"""
    q["array_load"] = """
SELECT vec_id, label, round(list_sum(list_transform(embedding, lambda v: CAST(v AS DOUBLE) / 255)), 9) AS total FROM embeddings"""
    q["feature_vector"] = """
SELECT l_orderkey, l_linenumber, CAST(l_extendedprice AS DOUBLE) AS target, CAST(3 AS INTEGER) AS width, CAST(l_tax AS DOUBLE) AS last FROM lineitem"""
    q["dbscan_vectors"] = """
WITH RECURSIVE p AS (SELECT vec_id AS id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
nb AS (SELECT a.id, b.id AS id2 FROM p a JOIN p b ON list_distance(a.v, b.v) <= 1.15),
core AS (SELECT id FROM nb GROUP BY id HAVING count(*) >= 3),
ce AS (SELECT nb.id, nb.id2 FROM nb JOIN core c1 ON nb.id = c1.id JOIN core c2 ON nb.id2 = c2.id),
reach(id, root) AS (SELECT id, id FROM core UNION SELECT ce.id2, r.root FROM reach r JOIN ce ON r.id = ce.id),
comp AS (SELECT id, min(root) AS root FROM reach GROUP BY id),
lab AS (SELECT root, dense_rank() OVER (ORDER BY root) - 1 AS label FROM (SELECT DISTINCT root FROM comp)),
core_lab AS (SELECT comp.id, lab.label FROM comp JOIN lab ON comp.root = lab.root),
border AS (SELECT nb.id, min(cl.label) AS label FROM nb JOIN core_lab cl ON nb.id2 = cl.id
           WHERE nb.id NOT IN (SELECT id FROM core) GROUP BY nb.id)
SELECT p.id AS vec_id, CAST(coalesce(cl.label, b.label, -1) AS INTEGER) AS label, p.id IN (SELECT id FROM core) AS is_core
FROM p LEFT JOIN core_lab cl ON p.id = cl.id LEFT JOIN border b ON p.id = b.id"""
    return q
