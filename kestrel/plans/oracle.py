"""Independent DuckDB SQL for each catalogue query (tables registered as views by name).

Written from the query's meaning, not from the Spark code: window functions where the Spark side
uses ordered scans, plain aggregates where it uses partial-aggregate tricks. Sums are exact decimals
and rounded values go through DECIMAL(20,8) so both engines produce the same bits.
"""

from __future__ import annotations

from kestrel.plans.catalog import (BALANCE_CLASSES_OK, DAY_OFFSET, REGIONS_OK, SCORE_HALF_AT,
                                   SEGMENTS_OK, STAMP_FORMS)
from kestrel.sources.tables import DRIVER_TABLES

HOURS = [f"Hora_{i}" for i in range(1, 25)]
WS = r"[\s\x{0B}\x{1C}-\x{1F}\x{85}\p{Z}]"  # white space as str.strip() removes it, for RE2


def _r2(x: str) -> str:
    """Round half up to 2 places, through an 8-place decimal, back to double."""
    return f"CAST(ROUND(CAST(({x}) AS DECIMAL(20,8)), 2) AS DOUBLE)"


def _xsum(x: str) -> str:
    return f"CAST(SUM(CAST(({x}) AS DECIMAL(18,2))) AS DOUBLE)"


def _strip(x: str) -> str:
    return f"regexp_replace({x}, '^{WS}+|{WS}+$', '', 'g')"


def _safe(x: str) -> str:
    num = r"[+-]?(\d+(_\d+)*\.?(\d+(_\d+)*)?|\.\d+(_\d+)*)([eE][+-]?\d+(_\d+)*)?"
    return (f"(CASE WHEN regexp_full_match({x}, '{num}') THEN TRY_CAST(replace({x}, '_', '') AS DOUBLE) "
            f"WHEN regexp_full_match(lower({x}), '[+-]?(inf|infinity)') THEN "
            f"(CASE WHEN {x} LIKE '-%' THEN CAST('-inf' AS DOUBLE) ELSE CAST('inf' AS DOUBLE) END) "
            f"WHEN regexp_full_match(lower({x}), '[+-]?nan') THEN CAST('nan' AS DOUBLE) ELSE 0.0 END)")


def _in(vals) -> str:
    return ", ".join(f"'{v}'" for v in vals)


def _local_date(ts: str) -> str:
    h = int(DAY_OFFSET[1:3])
    sign = "-" if DAY_OFFSET.startswith("-") else "+"
    return f"CAST({ts} {sign} INTERVAL {h} HOUR AS DATE)"


def _f(x: str) -> str:
    return f"((({x}) * CAST(9 AS DOUBLE)) / CAST(5 AS DOUBLE) + CAST(32 AS DOUBLE))"


def _row_total(cols) -> str:
    return "(" + " + ".join(["CAST(0 AS DOUBLE)"] + [f"COALESCE({c}, 0)" for c in cols]) + ")"


def _wide(src: str, key: str, val: str) -> str:
    cols = ", ".join(f"COALESCE(CAST(SUM(CASE WHEN hr = {i} THEN {val} END) AS DOUBLE), 0.0) AS Hora_{i}"
                     for i in range(1, 25))
    return f"SELECT {key}, {cols} FROM {src} GROUP BY {key}"


MASTER_CTE = f"""
m AS (
  SELECT c.c_custkey,
         CASE WHEN c.c_acctbal < 0 THEN lower(c.c_mktsegment) ELSE ' ' || c.c_mktsegment || ' ' END AS Nombre_Agente,
         r.r_name AS Agente_OFEI, n.n_name AS Central,
         CASE WHEN c.c_acctbal < 0 THEN ' neg' WHEN c.c_acctbal < 5000 THEN 'low ' ELSE 'High' END AS Tipo_Central
  FROM customer c JOIN nation n ON n.n_nationkey = c.c_nationkey JOIN region r ON r.r_regionkey = n.n_regionkey),
f AS (
  SELECT * FROM m
  WHERE (COALESCE(upper({_strip('Nombre_Agente')}) IN ({_in(SEGMENTS_OK)}), FALSE)
         OR COALESCE(upper({_strip('Agente_OFEI')}) IN ({_in(REGIONS_OK)}), FALSE))
    AND COALESCE(upper({_strip('Tipo_Central')}) IN ({_in(BALANCE_CLASSES_OK)}), FALSE)),
k AS (
  SELECT c_custkey, Nombre_Agente, Agente_OFEI, Central, Tipo_Central FROM (
    SELECT *, ROW_NUMBER() OVER (PARTITION BY Central ORDER BY c_custkey) AS rn FROM f) WHERE rn = 1)"""

PREFS_CTE = """
prefs AS (
  SELECT c_custkey,
         CASE WHEN c_acctbal < 0 THEN NULL ELSE c_mktsegment = 'BUILDING' END AS likejazz,
         CASE WHEN c_mktsegment = 'HOUSEHOLD' THEN NULL ELSE c_acctbal > 5000 END AS likerock,
         CASE WHEN c_nationkey > 20 THEN NULL ELSE c_nationkey < 10 END AS likeopera
  FROM customer)"""

WEATHER_CTE = f"""
b AS (
  SELECT e.event_id, e.user_id, e.ts, e.value, e.event_type, n.n_name AS pais, {_local_date('e.ts')} AS fecha,
         CASE WHEN e.event_type <> 'error' THEN e.value END AS wind
  FROM events e JOIN customer c ON c.c_custkey = e.user_id JOIN nation n ON n.n_nationkey = c.c_nationkey),
agg AS (
  SELECT user_id, pais, fecha,
         {_r2(_f(_xsum('value') + ' / COUNT(value)'))} AS temperatura_f,
         {_r2(_f('MAX(value)'))} AS temp_max_f,
         {_r2(_f('MIN(value)'))} AS temp_min_f,
         MAX(value) AS indice_uv,
         {_r2(_xsum('wind') + ' / COUNT(wind)')} AS velocidad_viento
  FROM b GROUP BY user_id, pais, fecha),
pc AS (
  SELECT user_id, fecha, event_type AS cobertura_nubes FROM (
    SELECT user_id, fecha, event_type, ROW_NUMBER() OVER (PARTITION BY user_id, fecha ORDER BY ts, event_id) AS rn
    FROM b) WHERE rn = 1),
daily AS (
  SELECT a.user_id AS localidad, a.pais, a.fecha, a.temperatura_f, a.temp_max_f, a.temp_min_f,
         pc.cobertura_nubes, a.indice_uv, a.velocidad_viento
  FROM agg a JOIN pc ON pc.user_id = a.user_id AND pc.fecha = a.fecha)"""

SALES_CONSOLIDATED = """
SELECT c.c_name AS customer_name, c.c_mktsegment AS customer_segment, p.p_name AS part_name,
       s.s_name AS supplier_name, n.n_name AS supplier_nation, CAST(o.o_orderdate AS DATE) AS order_date,
       CAST(SUM(CAST(l.l_quantity AS DECIMAL(18,2))) AS DOUBLE) AS total_quantity,
       CAST(SUM(CAST(l.l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS total_sales
FROM lineitem l
JOIN orders o ON o.o_orderkey = l.l_orderkey
JOIN customer c ON c.c_custkey = o.o_custkey
JOIN part p ON p.p_partkey = l.l_partkey
JOIN supplier s ON s.s_suppkey = l.l_suppkey
JOIN nation n ON n.n_nationkey = s.s_nationkey
GROUP BY 1, 2, 3, 4, 5, 6"""


def _q01() -> str:
    cyc = ["l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_partkey", "l_suppkey", "l_linestatus",
           "l_shipdate"]
    toks = ", ".join(f"CAST({c} AS VARCHAR)" for c in cyc * 3)
    hours = ", ".join(f"{_safe(_strip(f'p[{i + 3}]'))} AS Hora_{i + 1}" for i in range(24))
    return f"""
WITH src AS (
  SELECT CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS plant,
         CASE WHEN l_linenumber = 1 THEN lower(l_returnflag) ELSE l_returnflag END AS typ,
         CASE WHEN l_linenumber = 7 THEN list_slice([{toks}], 1, 23) ELSE [{toks}] END AS toks
  FROM lineitem),
lines AS (SELECT plant || ' , ' || typ || ' , ' || array_to_string(toks, ' , ') AS line FROM src),
parts AS (SELECT line, string_split(line, ',') AS p FROM lines)
SELECT {_strip('p[1]')} AS Planta, {hours}
FROM parts
WHERE regexp_matches(line, ',\\s*R\\s*,') AND len(p) >= 26 AND upper({_strip('p[2]')}) = 'R'"""


def _q02() -> str:
    return f"""
WITH l AS (SELECT conv_id, turn, role, {_strip("upper(role) || ': ' || text")} AS line FROM conversations),
h AS (SELECT *, upper(line) LIKE 'USER:%' AS is_header,
             CASE WHEN upper(line) LIKE 'USER:%' THEN {_strip("substr(line, strpos(line, ':') + 1)")} END AS hdr
      FROM l),
w AS (SELECT conv_id, turn, role, is_header,
             LAST_VALUE(hdr IGNORE NULLS) OVER (PARTITION BY conv_id ORDER BY turn
                                                ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS agent
      FROM h)
SELECT conv_id, turn, role, agent FROM w WHERE NOT is_header"""


def _q05() -> str:
    def cnt(check, table, column, cond):
        return (f"SELECT '{check}' AS check_name, '{table}' AS table_name, '{column}' AS column_name, "
                f"COUNT(*) FILTER (WHERE {cond}) AS violations FROM {table}")

    def dup(table, cols):
        return (f"SELECT 'unique' AS check_name, '{table}' AS table_name, '{cols}' AS column_name, "
                f"(SELECT COUNT(*) FROM (SELECT {cols} FROM {table} GROUP BY {cols} HAVING COUNT(*) > 1)) AS violations")

    parts = [
        cnt("not_null", "orders", "o_orderkey", "o_orderkey IS NULL"),
        cnt("not_null", "orders", "o_custkey", "o_custkey IS NULL"),
        cnt("not_null", "orders", "o_orderdate", "o_orderdate IS NULL"),
        cnt("domain", "orders", "o_orderstatus", "o_orderstatus IS NULL OR o_orderstatus NOT IN ('F', 'O', 'P')"),
        cnt("domain", "orders", "o_orderpriority", "o_orderpriority IS NULL OR o_orderpriority NOT IN "
            "('1-URGENT', '2-HIGH', '3-MEDIUM', '4-NOT SPECIFIED', '5-LOW')"),
        cnt("non_negative", "orders", "o_totalprice", "o_totalprice < 0"),
        cnt("decimal_fit", "orders", "o_totalprice",
            "o_totalprice IS NOT NULL AND TRY_CAST(o_totalprice AS DECIMAL(8,2)) IS NULL"),
        dup("orders", "o_orderkey"),
        dup("orders", "o_custkey,o_orderdate"),
        cnt("not_null", "customer", "c_custkey", "c_custkey IS NULL"),
        cnt("not_null", "customer", "c_name", "c_name IS NULL"),
        cnt("non_negative", "customer", "c_acctbal", "c_acctbal < 0"),
        cnt("max_length", "customer", "c_name", "length(c_name) > 18"),
        cnt("max_length", "customer", "c_mktsegment", "length(c_mktsegment) > 9"),
        cnt("domain", "customer", "c_mktsegment", "c_mktsegment IS NULL OR c_mktsegment NOT IN "
            "('AUTOMOBILE', 'BUILDING', 'FURNITURE', 'HOUSEHOLD', 'MACHINERY')"),
        dup("customer", "c_custkey"),
        dup("customer", "c_name"),
    ]
    return "\nUNION ALL\n".join(parts)


def _q05b() -> str:
    def rows(check, table, column, key, cond):
        return f"SELECT '{check}' AS check_name, '{table}' AS table_name, '{column}' AS column_name, {key} AS key FROM {table} WHERE {cond}"

    def again(table, cols, key, names=None):
        return (f"SELECT 'unique', '{table}', '{names or cols}', key FROM (SELECT {key} AS key, COUNT(*) OVER (PARTITION BY {cols}) AS n "
                f"FROM {table}) WHERE n > 1")

    o, c = ("orders", "o_orderkey"), ("customer", "c_custkey")
    return "\nUNION ALL\n".join([
        *[rows("not_null", o[0], x, o[1], f"{x} IS NULL") for x in ("o_orderkey", "o_custkey", "o_orderdate")],
        rows("domain", o[0], "o_orderstatus", o[1], "o_orderstatus IS NULL OR o_orderstatus NOT IN ('F', 'O', 'P')"),
        rows("domain", o[0], "o_orderpriority", o[1], "o_orderpriority IS NULL OR o_orderpriority NOT IN "
             "('1-URGENT', '2-HIGH', '3-MEDIUM', '4-NOT SPECIFIED', '5-LOW')"),
        rows("non_negative", o[0], "o_totalprice", o[1], "o_totalprice < 0"),
        rows("decimal_fit", o[0], "o_totalprice", o[1], "o_totalprice IS NOT NULL AND TRY_CAST(o_totalprice AS DECIMAL(8,2)) IS NULL"),
        again(o[0], "o_orderkey", o[1]), again(o[0], "o_custkey, o_orderdate", o[1], "o_custkey,o_orderdate"),
        *[rows("not_null", c[0], x, c[1], f"{x} IS NULL") for x in ("c_custkey", "c_name")],
        rows("non_negative", c[0], "c_acctbal", c[1], "c_acctbal < 0"),
        rows("max_length", c[0], "c_name", c[1], "length(c_name) > 18"), rows("max_length", c[0], "c_mktsegment", c[1], "length(c_mktsegment) > 9"),
        rows("domain", c[0], "c_mktsegment", c[1], "c_mktsegment IS NULL OR c_mktsegment NOT IN "
             "('AUTOMOBILE', 'BUILDING', 'FURNITURE', 'HOUSEHOLD', 'MACHINERY')"),
        again(c[0], "c_custkey", c[1]), again(c[0], "c_name", c[1]),
        again(c[0], "c_nationkey, c_mktsegment, floor(c_acctbal / 100)", c[1], "c_nationkey,c_mktsegment,hundreds"),
        again("lineitem", "l_orderkey, l_partkey", "l_orderkey", "l_orderkey,l_partkey"),
        rows("not_null", "lineitem", "l_shipdate", "l_orderkey", "l_shipdate IS NULL"),
        rows("domain", "lineitem", "l_returnflag", "l_orderkey", "l_returnflag IS NULL OR l_returnflag NOT IN ('A', 'N')")])


def _q06() -> str:
    k = r"regexp_extract(props, ':\s*(-?\d+)', 1)"
    toks = [k, f"{k} || 'd'", f"{k} || '_5'", f"'.' || {k}", f"{k} || 'e1'", f"'0x' || {k}",
            f"' +' || {k} || ' '", "event_type", f"{k} || '.5.5'", "CAST(value AS VARCHAR)"]
    sel = "\nUNION ALL\n".join(f"SELECT event_id, {i} AS token_pos, {t} AS token FROM events" for i, t in enumerate(toks))
    return f"SELECT event_id, token_pos, token, {_safe(_strip('token'))} AS number FROM ({sel})"


def _q09() -> str:
    hours = ", ".join(f"w.Hora_{i}" for i in range(1, 25))
    return f"""
WITH {MASTER_CTE},
d AS (SELECT n.n_name AS Central, CAST(hour(e.ts) AS INTEGER) + 1 AS hr, CAST(e.value AS DECIMAL(18,2)) AS v
      FROM events e JOIN customer c ON c.c_custkey = e.user_id JOIN nation n ON n.n_nationkey = c.c_nationkey),
w AS ({_wide('d', 'Central', 'v')}),
j AS (SELECT k.Nombre_Agente, k.Agente_OFEI, k.Central, k.Tipo_Central, {hours},
             {_row_total(['w.' + h for h in HOURS])} AS Suma_Horas
      FROM k JOIN w ON w.Central = k.Central)
SELECT * FROM j WHERE Suma_Horas > 0"""


def _q08_wide() -> str:
    return f"""
h AS (SELECT user_id, CAST(hour(ts) AS INTEGER) + 1 AS hr,
             CAST(CASE WHEN event_type = 'error' THEN -value ELSE value END AS DECIMAL(18,2)) AS v FROM events),
w AS ({_wide('h', 'user_id', 'v')})"""


def _q11() -> str:
    fmts = {"1-URGENT": "%Y-%m-%d %H:%M:%S", "2-HIGH": "%-m/%-d/%Y %-H:%M:%S", "3-MEDIUM": "%Y-%m-%d",
            "4-NOT SPECIFIED": "%Y-%m-%dT%H:%M:%S", "5-LOW": "%Y%m%d"}
    assert set(fmts) == {p for p, _ in STAMP_FORMS}
    case = " ".join(f"WHEN o_orderpriority = '{p}' THEN strftime(o_orderdate, '{f}')" for p, f in fmts.items())
    return (f"SELECT o_orderkey, CASE {case} END AS order_text, "
            f"CASE WHEN o_orderpriority IN ({_in(fmts)}) THEN o_orderdate END AS parsed_ts FROM orders")


def _q34() -> str:
    p = f"CAST(d.n_chars AS DOUBLE) / (CAST(d.n_chars AS DOUBLE) + CAST({SCORE_HALF_AT} AS DOUBLE))"

    def ratio(a, b):
        return f"(CASE WHEN ({b}) = 0 THEN 0.0 ELSE CAST({a} AS DOUBLE) / CAST({b} AS DOUBLE) END)"

    def f1(pr, rc):
        return f"(CASE WHEN ({pr} + {rc}) = 0 THEN 0.0 ELSE 2.0 * {pr} * {rc} / ({pr} + {rc}) END)"

    return f"""
WITH s AS (SELECT l.toxic AS y, {p} AS p FROM documents d JOIN labels l ON l.doc_id = d.doc_id),
g AS (SELECT p, CAST(SUM(y) AS BIGINT) AS pos, CAST(SUM(1 - y) AS BIGINT) AS neg FROM s GROUP BY p),
c AS (SELECT pos, neg, SUM(neg) OVER (ORDER BY p ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cum_neg FROM g),
a AS (SELECT SUM(CAST(pos AS DOUBLE) * (CAST(cum_neg AS DOUBLE) - neg * 0.5))
             / (CAST(SUM(pos) AS DOUBLE) * CAST(SUM(neg) AS DOUBLE)) AS auc FROM c),
k AS (SELECT COUNT(*) FILTER (WHERE y = 0 AND p < 0.5) AS tn, COUNT(*) FILTER (WHERE y = 0 AND p >= 0.5) AS fp,
             COUNT(*) FILTER (WHERE y = 1 AND p < 0.5) AS fn, COUNT(*) FILTER (WHERE y = 1 AND p >= 0.5) AS tp FROM s),
m AS (SELECT *, {ratio('tn', 'tn + fn')} AS p0, {ratio('tn', 'tn + fp')} AS r0,
             {ratio('tp', 'tp + fp')} AS p1, {ratio('tp', 'tp + fn')} AS r1,
             CAST(tn + fp AS DOUBLE) AS s0, CAST(tp + fn AS DOUBLE) AS s1 FROM k),
m2 AS (SELECT *, {f1('p0', 'r0')} AS f0, {f1('p1', 'r1')} AS f1 FROM m),
r AS (SELECT (SELECT auc FROM a) AS auc, CAST(tn AS DOUBLE) AS tn, CAST(fp AS DOUBLE) AS fp,
             CAST(fn AS DOUBLE) AS fn, CAST(tp AS DOUBLE) AS tp,
             p0 AS precision_0, r0 AS recall_0, f0 AS f1_0, s0 AS support_0,
             p1 AS precision_1, r1 AS recall_1, f1 AS f1_1, s1 AS support_1,
             {ratio('tp + tn', 'tp + tn + fp + fn')} AS accuracy,
             (p0 + p1) / 2.0 AS macro_precision, (r0 + r1) / 2.0 AS macro_recall, (f0 + f1) / 2.0 AS macro_f1,
             {ratio('p0 * s0 + p1 * s1', 's0 + s1')} AS weighted_precision,
             {ratio('r0 * s0 + r1 * s1', 's0 + s1')} AS weighted_recall,
             {ratio('f0 * s0 + f1 * s1', 's0 + s1')} AS weighted_f1
      FROM m2)
SELECT metric, value FROM r UNPIVOT (value FOR metric IN (auc, tn, fp, fn, tp, precision_0, recall_0, f1_0,
  support_0, precision_1, recall_1, f1_1, support_1, accuracy, macro_precision, macro_recall, macro_f1,
  weighted_precision, weighted_recall, weighted_f1))"""


def _q35() -> str:
    def upto(m, f):
        return f"GREATEST(0, ({m} - {f} + 4) // 5)"

    sizes = [f"({upto('st + n', f)} - {upto('st', f)})" for f in range(5)]
    bounds = [" + ".join(sizes[: i + 1]) for i in range(4)]
    fold = " + ".join(f"CAST(rk >= ({b}) AS INTEGER)" for b in bounds)
    return f"""
WITH c AS (SELECT toxic, COUNT(*) AS n, MIN(doc_id) AS first_id FROM labels GROUP BY toxic),
s AS (SELECT toxic, n, COALESCE(SUM(n) OVER (ORDER BY first_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS st
      FROM c),
r AS (SELECT doc_id, toxic, ROW_NUMBER() OVER (PARTITION BY toxic ORDER BY doc_id) - 1 AS rk FROM labels)
SELECT r.doc_id, r.toxic, CAST({fold} AS INTEGER) AS fold FROM r JOIN s ON s.toxic = r.toxic"""


def _on_files() -> dict[str, str]:
    """Queries over files and stored tables: the SQL has the values the files were written from."""
    stamp = " ".join(f"WHEN o_orderpriority = '{p}' THEN {text}" for p, text in {
        "1-URGENT": "strftime(ot, '%Y-%m-%d %H:%M:%S.%g')",
        "2-HIGH": "strftime(ot, '%m/%d/%Y %I:%M %p')",
        "3-MEDIUM": "strftime(ot, '%b %-d, %Y')",
        "4-NOT SPECIFIED": "strftime(ot, '%-d %B %Y %H:%M')",
        "5-LOW": "strftime(ot, '%Y/%m/%d')"}.items())
    parsed = ("CASE WHEN o_orderpriority IN ('3-MEDIUM', '5-LOW') THEN date_trunc('day', ot) "
              "WHEN o_orderpriority IN ('2-HIGH', '4-NOT SPECIFIED') THEN date_trunc('minute', ot) ELSE ot END")
    p_of = f"CAST(n_chars AS DOUBLE) / (CAST(n_chars AS DOUBLE) + CAST({SCORE_HALF_AT} AS DOUBLE))"
    gaps = """
u AS (SELECT CASE WHEN doc_id % 7 <> 0 THEN doc_id END AS doc_id, lang, n_chars
      FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)),
f AS (SELECT * FROM u UNION ALL SELECT * FROM u WHERE doc_id % 5 = 0)"""
    return {
        "q07b_master_sheet": """
SELECT n.n_name AS central,
       CASE WHEN c.c_acctbal < 0 THEN lower(c.c_mktsegment) ELSE c.c_mktsegment END AS agente,
       CASE WHEN c.c_acctbal < 0 THEN 'neg' WHEN c.c_acctbal < 5000 THEN 'low' ELSE 'High' END AS tipo, r.r_name AS ofei
FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey JOIN region r ON n.n_regionkey = r.r_regionkey""",
        "q10c_load_with_rejects": """
WITH x AS (SELECT *, CASE WHEN o_orderkey % 16 = 3 THEN o_orderpriority END AS bad FROM orders),
y AS (SELECT *, CASE bad WHEN '1-URGENT' THEN 'o_totalprice: not decimal(10,2)' WHEN '2-HIGH' THEN 'o_orderkey: not bigint'
                         WHEN '3-MEDIUM' THEN '2 fields' WHEN '4-NOT SPECIFIED' THEN 'o_custkey: null' END AS reason FROM x)
SELECT 'loaded' AS reason, COUNT(*) AS n, CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total, MIN(o_orderdate) AS first_date
FROM y WHERE reason IS NULL
UNION ALL SELECT reason, COUNT(*), NULL, NULL FROM y WHERE reason IS NOT NULL GROUP BY reason""",
        "q11b_more_timestamps": f"""
WITH x AS (SELECT *, o_orderdate + to_hours(o_orderkey % 24) + to_minutes(o_custkey % 60) AS ot FROM orders)
SELECT o_orderkey, CASE {stamp} END AS order_text, {parsed} AS parsed_ts FROM x""",
        "q14b_offset_stamps": """
WITH x AS (SELECT *, CASE event_id % 3 WHEN 0 THEN -300 WHEN 1 THEN 0 ELSE 330 END AS m,
                  CASE event_id % 3 WHEN 0 THEN '-05:00' WHEN 1 THEN '+00:00' ELSE '+05:30' END AS o FROM events)
SELECT event_id, strftime(ts + to_minutes(m), '%Y-%m-%d %H:%M:%S') || o AS stamp, date_trunc('second', ts) AS instant FROM x""",
        "q15b_defaults": """
SELECT c_custkey, CASE WHEN c_nationkey <> 1 THEN c_name END AS name, TRUE AS active, 0 AS visits, CAST(NULL AS VARCHAR) AS note
FROM customer""",
        "q02c_sections_over_splits": f"""
WITH l AS (SELECT conv_id, turn, role, conv_id % 2 AS file, {_strip("regexp_replace(text, '[' || chr(13) || chr(10) || ']+', ' ', 'g')")} AS t FROM conversations),
w AS (SELECT *, LAST_VALUE(CASE WHEN role = 'user' THEN t END IGNORE NULLS) OVER (
               PARTITION BY file ORDER BY conv_id, turn ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS agent FROM l)
SELECT conv_id, turn, role, agent FROM w WHERE role <> 'user'""",
        "q04b_identity_inserts": """
WITH n AS (SELECT COUNT(*) FILTER (WHERE o_orderstatus = 'F') AS f, COUNT(*) FILTER (WHERE o_orderstatus <> 'F') AS r FROM orders)
SELECT 1 AS batch, f AS n, f AS n_keys, 1 AS first_sk, f AS last_sk FROM n UNION ALL SELECT 2, r, r, f + 1, f + r FROM n""",
        "q05b_violating_rows": _q05b(),
        "q12b_local_month": """
WITH x AS (SELECT o_orderkey, o_custkey, o_orderdate + to_hours(CAST(o_orderkey % 24 AS INTEGER)) AS ordered_at FROM orders)
SELECT *, CAST(ordered_at - INTERVAL 5 HOUR AS DATE) AS local_day FROM x
WHERE date_trunc('month', ordered_at - INTERVAL 5 HOUR) = DATE '1996-03-01'""",
        "q14c_summary_refresh": f"""
WITH b AS (SELECT *, CASE WHEN event_type <> 'error' THEN value END AS wind, {_local_date('ts')} AS fecha FROM events)
SELECT user_id, fecha, {_xsum('value')} AS suma_temp, {_xsum('COALESCE(wind, 0)')} AS suma_viento, COUNT(*) AS lecturas, COUNT(wind) AS n_viento,
       {_r2(_xsum('value') + ' / COUNT(*)')} AS temp_prom, {_r2(_xsum('COALESCE(wind, 0)') + ' / COUNT(*)')} AS viento_prom_cero,
       {_r2(_xsum('wind') + ' / NULLIF(COUNT(wind), 0)')} AS viento_prom,
       fecha IN (SELECT fecha FROM b WHERE day(fecha) <= 10 AND event_id % 11 < 2) AS rewritten
FROM b GROUP BY user_id, fecha""",
        "q22b_stored_sketches": """
SELECT l_returnflag, COUNT(*) AS n, COUNT(DISTINCT l_partkey) AS n_parts, TRUE AS median_in_bound, TRUE AS parts_in_bound
FROM lineitem GROUP BY l_returnflag""",
        "q26c_named_export": f"""
WITH t AS (SELECT *, ROW_NUMBER() OVER (ORDER BY total_sales DESC, customer_name, customer_segment, part_name, supplier_name, supplier_nation, order_date) AS k
           FROM ({SALES_CONSOLIDATED}))
SELECT '00' || CAST((k - 1) // 4 AS VARCHAR) AS file, customer_name, part_name, order_date, total_sales FROM t WHERE k <= 10""",
        "q36d_forest_invariants": """
SELECT COUNT(*) AS filas, 0 AS sin_puntaje, 0 AS fuera_de_rango, 0 AS suma_distinta, 0 AS distintas_con_la_semilla, TRUE AS separa
FROM documents""",
        "q15c_rollup_two_countries": f"""
WITH b AS (
  SELECT e.event_id, e.user_id % 40 AS place, e.ts, e.value, e.event_type, n.n_name AS pais, {_local_date('e.ts')} AS fecha
  FROM events e JOIN customer c ON c.c_custkey = e.user_id JOIN nation n ON n.n_nationkey = c.c_nationkey),
a AS (SELECT place, pais, fecha, {_r2(_f(_xsum('value') + ' / COUNT(value)'))} AS temperatura_f,
             {_r2(_f('MAX(value)'))} AS temp_max_f, {_r2(_f('MIN(value)'))} AS temp_min_f FROM b GROUP BY place, pais, fecha),
c AS (SELECT place, fecha, event_type FROM (
        SELECT place, fecha, event_type, ROW_NUMBER() OVER (PARTITION BY place, fecha ORDER BY ts, event_id) AS rn FROM b) WHERE rn = 1)
SELECT a.*, c.event_type AS cobertura_nubes FROM a JOIN c ON a.place = c.place AND a.fecha = c.fecha""",
        "q30b_clashing_file": "SELECT CAST(c_custkey AS INTEGER) AS id, c_acctbal AS monto_total, CAST(c_nationkey AS INTEGER) AS dist FROM customer",
        "q36b_feature_rows": """
WITH r AS (SELECT d.doc_id, CASE WHEN d.n_chars % 10 <> 0 THEN CAST(d.n_chars AS DOUBLE) END AS n,
                  CASE WHEN d.doc_id % 9 <> 0 THEN d.lang END AS lang, l.toxic
           FROM documents d JOIN labels l ON l.doc_id = d.doc_id),
m AS (SELECT quantile_cont(n, 0.5) AS med FROM r),
k AS (SELECT lang FROM r WHERE lang IS NOT NULL GROUP BY lang ORDER BY COUNT(*) DESC, lang LIMIT 1),
i AS (SELECT doc_id, toxic, COALESCE(n, (SELECT med FROM m)) AS n_imputed, COALESCE(lang, (SELECT lang FROM k)) AS lang_imputed FROM r)
SELECT *, """ + ", ".join(f"CAST(lang_imputed = '{v}' AS INTEGER) AS lang_imputed_{v}" for v in ("de", "en", "es", "fr")) + """,
       ROUND(CAST(COUNT(*) OVER () AS DOUBLE) / ((SELECT COUNT(DISTINCT toxic) FROM r) * COUNT(*) OVER (PARTITION BY toxic)), 9) AS weight
FROM i""",
        "q36c_fold_auc": f"""
WITH f AS ({_q35()}),
s AS (SELECT f.fold, l.toxic AS y, {p_of} AS p FROM documents d JOIN labels l ON l.doc_id = d.doc_id JOIN f ON f.doc_id = d.doc_id),
a AS (SELECT x.fold, SUM(CASE WHEN x.p > z.p THEN 1.0 WHEN x.p = z.p THEN 0.5 ELSE 0.0 END) / COUNT(*) AS auc
      FROM s x JOIN s z ON x.fold = z.fold AND x.y = 1 AND z.y = 0 GROUP BY x.fold)
SELECT fold, ROUND(CAST(auc AS DOUBLE), 9) AS auc FROM a
UNION ALL SELECT -1, ROUND(AVG(CAST(auc AS DOUBLE)), 9) FROM a UNION ALL SELECT -2, ROUND(STDDEV_POP(CAST(auc AS DOUBLE)), 9) FROM a""",
        "q37c_score_file_rows": f"""
WITH {gaps}
SELECT CAST(doc_id AS INTEGER) AS doc_id, {p_of} AS toxic, lang, CAST(n_chars AS INTEGER) AS n_chars, CAST(n_chars * 3 AS INTEGER) AS n_chars_again FROM f""",
        "q37d_score_file_summary": f"""
WITH {gaps}
SELECT ROUND(AVG({p_of}), 9) AS p_media, COUNT(*) FILTER (WHERE {p_of} >= 0.5) AS n_fraude, COUNT(*) AS filas FROM f""",
    }


def oracle_sql() -> dict[str, str]:
    hours_w = ", ".join(f"w.{h}" for h in HOURS)
    q = {
        "q01_typed_records": _q01(),
        "q02_sections": _q02(),
        "q02b_distinct_sections": f"SELECT COUNT(DISTINCT agent) AS agentes_unicos, COUNT(*) AS registros FROM ({_q02()})",
        "q03_first_event_per_day": f"""
SELECT user_id, fecha, event_id, ts, event_type, value FROM (
  SELECT user_id, {_local_date('ts')} AS fecha, event_id, ts, event_type, value,
         ROW_NUMBER() OVER (PARTITION BY user_id, {_local_date('ts')} ORDER BY ts, event_id) AS rn
  FROM events) WHERE rn = 1""",
        "q04_surrogate_keys": "SELECT s_suppkey, s_name, CAST(ROW_NUMBER() OVER (ORDER BY s_suppkey) AS BIGINT) AS supplier_sk FROM supplier",
        "q05_quality_report": _q05(),
        "q06_safe_numbers": _q06(),
        "q07_master_filter": f"WITH {MASTER_CTE} SELECT * FROM k",
        "q08_hours_row_total": f"""
WITH {_q08_wide()},
t AS (SELECT user_id, {hours_w}, {_row_total(['w.' + h for h in HOURS])} AS Suma_Horas FROM w)
SELECT * FROM t WHERE Suma_Horas > 0""",
        "q09_master_join_declarations": _q09(),
        "q10_tab_bulk_load": "SELECT * FROM orders",
        "q10b_pipe_bulk_load": "SELECT * FROM supplier",
        "q11_auto_timestamps": _q11(),
        "q12_month_layout": ("SELECT * FROM orders WHERE o_orderdate >= TIMESTAMP '1996-03-01 00:00:00' "
                             "AND o_orderdate < TIMESTAMP '1996-04-01 00:00:00'"),
        "q13_bucketed_layout": f"""
SELECT user_id, COUNT(*) AS n_events, MIN(ts) AS first_ts, MAX(ts) AS last_ts, {_xsum('value')} AS total_value
FROM events WHERE ts >= TIMESTAMP '2024-01-08 00:00:00' AND ts < TIMESTAMP '2024-01-15 00:00:00'
GROUP BY user_id""",
        "q14_daily_summary": f"""
WITH p AS (
  SELECT user_id, {_local_date('ts')} AS fecha, {_xsum('value')} AS suma_temp,
         CAST(SUM(COALESCE(CAST(CASE WHEN event_type <> 'error' THEN value END AS DECIMAL(18,2)), 0)) AS DOUBLE) AS suma_viento,
         COUNT(*) AS lecturas, COUNT(CASE WHEN event_type <> 'error' THEN value END) AS n_viento
  FROM events GROUP BY 1, 2)
SELECT user_id, fecha, suma_temp, suma_viento, lecturas, n_viento,
       {_r2('suma_temp / lecturas')} AS temp_prom,
       {_r2('suma_viento / lecturas')} AS viento_prom_cero,
       {_r2('suma_viento / NULLIF(n_viento, 0)')} AS viento_prom
FROM p""",
        "q15_daily_rollup": f"WITH {WEATHER_CTE} SELECT * FROM daily",
        "q16_hourly_delta": """
SELECT event_id, user_id, ts, value,
       CAST(CAST(value AS DECIMAL(18,2)) - CAST(LAG(value) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS DECIMAL(18,2)) AS DOUBLE) AS delta_value
FROM events""",
        "q16b_update_from": f"""
WITH p AS (SELECT l_orderkey, {_xsum('l_extendedprice')} AS total FROM lineitem GROUP BY l_orderkey)
SELECT o.o_orderkey, o.o_custkey, o.o_orderstatus,
       CASE WHEN p.l_orderkey IS NOT NULL THEN p.total ELSE o.o_totalprice END AS o_totalprice
FROM orders o LEFT JOIN p ON p.l_orderkey = o.o_orderkey""",
        "q17_daily_delta": f"""
WITH {WEATHER_CTE}
SELECT localidad, fecha, temperatura_f,
       CAST(CAST(temperatura_f AS DECIMAL(18,2)) - CAST(LAG(temperatura_f) OVER (PARTITION BY localidad ORDER BY fecha) AS DECIMAL(18,2)) AS DOUBLE) AS delta_temp_f
FROM daily""",
        "q18_row_counts": "\nUNION ALL\n".join(
            f"SELECT '{t}' AS tabla, COUNT(*) AS filas FROM {t}" for t in DRIVER_TABLES) + "\nORDER BY tabla",
        "q19_one_flag": f"WITH {PREFS_CTE} SELECT COUNT(*) AS usuarios_jazz FROM prefs WHERE likejazz = TRUE",
        "q20_two_flags": (f"WITH {PREFS_CTE} SELECT COUNT(*) AS usuarios_opera_y_rock FROM prefs "
                          "WHERE likeopera = TRUE AND likerock = TRUE"),
        "q21_describe": f"""
SELECT {_r2(_xsum('o_totalprice') + ' / COUNT(o_totalprice)')} AS promedio_ventas,
       {_r2('STDDEV_SAMP(o_totalprice)')} AS desviacion_std,
       MIN(o_totalprice) AS minimo, MAX(o_totalprice) AS maximo, COUNT(*) AS total_ventas
FROM orders""",
        "q22_median_mode": """
SELECT (SELECT quantile_cont(l_quantity, 0.5) FROM lineitem) AS mediana, m.l_quantity AS moda, m.frecuencia
FROM (SELECT l_quantity, COUNT(*) AS frecuencia FROM lineitem WHERE l_quantity IS NOT NULL
      GROUP BY l_quantity ORDER BY frecuencia DESC, l_quantity ASC LIMIT 1) m""",
        "q23_unified_metrics": f"""
SELECT {_r2(_xsum('l_extendedprice') + ' / COUNT(l_extendedprice)')} AS promedio,
       (SELECT quantile_cont(l_extendedprice, 0.5) FROM lineitem) AS mediana,
       (SELECT l_extendedprice FROM lineitem WHERE l_extendedprice IS NOT NULL GROUP BY l_extendedprice
        ORDER BY COUNT(*) DESC, l_extendedprice ASC LIMIT 1) AS moda
FROM lineitem""",
        "q24_flag_buyers": f"""
WITH {PREFS_CTE}
SELECT {_r2(_xsum('l.l_extendedprice') + ' / COUNT(*)')} AS promedio_ventas,
       COUNT(l.l_orderkey) AS total_ventas, COUNT(DISTINCT o.o_custkey) AS total_compradores
FROM lineitem l JOIN orders o ON o.o_orderkey = l.l_orderkey JOIN prefs u ON u.c_custkey = o.o_custkey
WHERE u.likerock = TRUE AND u.likejazz = FALSE""",
        "q25_sales_consolidation": SALES_CONSOLIDATED,
        "q26_top10": f"""
SELECT * FROM ({SALES_CONSOLIDATED}) x
ORDER BY total_sales DESC, customer_name, customer_segment, part_name, supplier_name, supplier_nation, order_date
LIMIT 10""",
        "q27_wide_long_roundtrip": f"""
WITH {_q08_wide()},
long AS (SELECT user_id, valor FROM w UNPIVOT (valor FOR hora IN ({', '.join(HOURS)})))
SELECT user_id, {_xsum('valor')} AS total, COUNT(*) FILTER (WHERE valor <> 0) AS horas_activas
FROM long GROUP BY user_id""",
        "q28_median_impute": """
SELECT c_custkey, COALESCE(CASE WHEN c_acctbal >= 0 THEN c_acctbal END,
       (SELECT quantile_cont(c_acctbal, 0.5) FROM customer WHERE c_acctbal >= 0)) AS c_acctbal_imputed
FROM customer""",
        "q29_mode_impute": """
SELECT doc_id, COALESCE(CASE WHEN lang <> 'es' THEN lang END,
       (SELECT lang FROM documents WHERE lang <> 'es' GROUP BY lang ORDER BY COUNT(*) DESC, lang ASC LIMIT 1)) AS lang_imputed
FROM documents""",
        "q30_column_tools": ("SELECT d.n_chars AS N_CHARS, d.lang AS LANG, d.source AS SOURCE "
                             "FROM documents d JOIN labels l ON l.doc_id = d.doc_id"),
        "q31_class_shares": ("SELECT toxic, COUNT(*) AS n, CAST(COUNT(*) AS DOUBLE) / CAST(SUM(COUNT(*)) OVER () AS DOUBLE) "
                             "AS share FROM labels GROUP BY toxic"),
        "q32_class_weights": ("SELECT toxic, COUNT(*) AS n, CAST(SUM(COUNT(*)) OVER () AS DOUBLE) / "
                              "(CAST(COUNT(*) OVER () AS DOUBLE) * CAST(COUNT(*) AS DOUBLE)) AS weight "
                              "FROM labels GROUP BY toxic"),
        "q33_one_hot": """
WITH tr AS (SELECT DISTINCT d.lang FROM documents d JOIN labels l ON l.doc_id = d.doc_id)
SELECT doc_id,
""" + ",\n".join(f"  CAST(lang = '{v}' AND '{v}' IN (SELECT lang FROM tr) AS INTEGER) AS lang_{v}"
                 for v in ("de", "en", "es", "fr")) + "\nFROM documents",
        "q34_auc_report": _q34(),
        "q35_stratified_folds": _q35(),
    }
    q["q13b_range_sorted_layout"] = q["q13_bucketed_layout"]
    q["q25b_stored_consolidation"] = q["q25_sales_consolidation"]
    q["q26b_single_file_export"] = q["q26_top10"]
    return q | _on_files()
