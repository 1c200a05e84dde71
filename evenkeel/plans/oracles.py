"""ANSI SQL that states the expected result of each registered query over the same tables."""

from __future__ import annotations

from evenkeel.plans.warehouse import SOURCES, as_ctes

SECONDS = "strftime({0}, '%Y-%m-%d %H:%M:%S')"
ORDER_KEYS = "o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority"
LINE_KEYS = "l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_returnflag, l_shipdate"


def ts(expression: str, alias: str) -> str:
    return f"{SECONDS.format(expression)} AS {alias}"


def over(sources: str, body: str, recursive: bool = False) -> str:
    """``body`` with the named derived tables in scope."""
    names = [n for n in sources.split() if n in SOURCES]
    text = body.strip()
    if not names:
        return text
    rest = ", " + text.removeprefix("WITH ").removeprefix("RECURSIVE ") if text.startswith("WITH ") else " " + text
    return f"WITH {'RECURSIVE ' if recursive else ''}{as_ctes(*names)}{rest}"


def _pass(condition: str) -> str:
    return f"CASE WHEN {condition} THEN 'PASS' ELSE 'FAIL' END AS status"


def _hash60(text: str) -> str:
    return f"CAST(concat('0x', substr(md5({text}), 1, 15)) AS BIGINT)"


_ORDER_TEXT = (
    "concat_ws('~|~', CAST(o_orderkey AS VARCHAR), CAST(o_custkey AS VARCHAR), o_orderstatus, "
    "CAST(CAST(round(o_totalprice * 1000000) AS DECIMAL(38,0)) AS VARCHAR), "
    + SECONDS.format("o_orderdate")
    + ", o_orderpriority)"
)
_EVENT_TEXT = (
    "concat_ws(chr(31), CAST(event_id AS VARCHAR), " + SECONDS.format("ts") + ", CAST(user_id AS VARCHAR), event_type, "
    "rtrim(rtrim(CAST(CAST(round(value, 6) AS DECIMAL(38,6)) AS VARCHAR), '0'), '.'), props)"
)


def _canonical_fingerprint() -> str:
    """Eight 32-bit limbs in 128-bit sums, carried from the lowest to the highest."""
    limb = "CAST(concat('0x', substr(h, {start}, 8)) AS BIGINT)"
    limbs = ", ".join(f"{limb.format(start=8 * i + 1)} AS w{i}" for i in range(8))
    sums = ", ".join(f"CAST(sum(w{i}) AS HUGEINT) AS s{i}, bit_xor(w{i}) AS x{i}" for i in range(8))
    steps, previous = [], "folded"
    for i in reversed(range(8)):
        carry = f" + c{i + 1}" if i < 7 else ""
        steps.append(
            f"k{i} AS (SELECT *, (s{i}{carry}) // 4294967296 AS c{i}, (s{i}{carry}) % 4294967296 AS r{i} FROM {previous})"
        )
        previous = f"k{i}"
    sum_hex = ", ".join(f"printf('%08x', CAST(r{i} AS BIGINT))" for i in range(8))
    xor_hex = ", ".join(f"printf('%08x', x{i})" for i in range(8))
    return f"""
        WITH hashed AS (SELECT sha256({_EVENT_TEXT}) AS h FROM events),
        limbs AS (SELECT {limbs} FROM hashed),
        folded AS (SELECT count(*) AS row_count, {sums} FROM limbs),
        {', '.join(steps)},
        shown AS (SELECT row_count, concat({sum_hex}) AS sum_hex, concat({xor_hex}) AS xor_hex FROM {previous})
        SELECT row_count, sum_hex, xor_hex,
               sha256(concat(CAST(row_count AS VARCHAR), ':', regexp_replace(sum_hex, '^0+', ''), ':',
                             regexp_replace(xor_hex, '^0+', ''))) AS digest
        FROM shown"""


_ORDER_DIFF = """
    SELECT coalesce(s.o_orderkey, t.o_orderkey) AS o_orderkey,
           CASE WHEN t.o_orderkey IS NULL THEN 'only_source' WHEN s.o_orderkey IS NULL THEN 'only_target'
                ELSE 'differs' END AS side,
           CASE WHEN s.o_orderkey IS NULL THEN 0 ELSE 1 END AS n_source,
           CASE WHEN t.o_orderkey IS NULL THEN 0 ELSE 1 END AS n_target
    FROM orders s FULL JOIN orders_target t ON s.o_orderkey = t.o_orderkey
    WHERE s.o_orderkey IS NULL OR t.o_orderkey IS NULL OR s.o_custkey <> t.o_custkey
       OR s.o_orderstatus <> t.o_orderstatus OR s.o_totalprice <> t.o_totalprice
       OR s.o_orderdate <> t.o_orderdate OR s.o_orderpriority <> t.o_orderpriority"""


def _copies(columns: str, source: str, target: str, shown: str) -> str:
    """Rows one side holds more often, by how many copies."""
    return f"""
        WITH missing AS (SELECT {columns} FROM {source} EXCEPT ALL SELECT {columns} FROM {target}),
        surplus AS (SELECT {columns} FROM {target} EXCEPT ALL SELECT {columns} FROM {source})
        SELECT {shown}, 'only_source' AS side, count(*) AS copies FROM missing GROUP BY {columns}
        UNION ALL SELECT {shown}, 'only_target', count(*) FROM surplus GROUP BY {columns}"""


_EPOCH_CLASSES = """
    WITH s AS (SELECT event_id, any_value(raw) AS raw, count(*) AS n FROM epoch_source GROUP BY event_id),
    t AS (SELECT event_id, max(converted_ts) AS ts, count(*) AS n FROM epoch_target GROUP BY event_id),
    paired AS (SELECT coalesce(s.event_id, t.event_id) AS event_id, s.raw, t.ts, s.n AS s_n, t.n AS t_n,
                      CASE WHEN s.raw BETWEEN 0 AND 4133980799999 THEN make_timestamp(s.raw * 1000) END AS sane,
                      CASE WHEN s.raw BETWEEN -62135596800000 AND 253402300799999
                           THEN make_timestamp(s.raw * 1000) END AS instant
               FROM s FULL JOIN t ON s.event_id = t.event_id),
    classified AS (SELECT *, CASE
        WHEN s_n IS NULL THEN 'only_target'
        WHEN t_n > 1 THEN 'duplicate_key'
        WHEN raw IS NULL AND ts IS NULL THEN 'null_source'
        WHEN raw IS NULL THEN 'should_be_null'
        WHEN sane IS NULL AND ts IS NOT NULL THEN 'should_be_null'
        WHEN sane IS NULL THEN 'nulled'
        WHEN year(sane) NOT BETWEEN 2020 AND 2030 THEN 'lying_column'
        WHEN date_trunc('second', sane) = date_trunc('second', ts) THEN 'matched'
        ELSE 'mismatch' END AS class FROM paired)"""

_BALANCE_DIFF = """
    WITH paired AS (SELECT s.c_custkey, s.balance AS sb, t.balance AS tb, s.balance_text AS sx, t.balance_text AS tx,
                           t.c_custkey IS NULL AS gone
                    FROM balance_source s LEFT JOIN balance_target t ON s.c_custkey = t.c_custkey),
    found AS (
        SELECT c_custkey, 'balance' AS "column",
               CASE WHEN gone THEN 'only_source' WHEN sb <> tb THEN 'value' END AS reason FROM paired
        UNION ALL
        SELECT c_custkey, 'balance_text',
               CASE WHEN gone THEN 'only_source'
                    WHEN try_cast(sx AS DECIMAL(38,18)) IS NULL OR try_cast(tx AS DECIMAL(38,18)) IS NULL
                         THEN CASE WHEN sx <> tx THEN 'unparseable' END
                    WHEN CAST(sx AS DECIMAL(38,18)) <> CAST(tx AS DECIMAL(38,18)) THEN 'value' END
        FROM (SELECT c_custkey, gone, sx, tx FROM paired))"""

_VERSIONS = """
    one AS (SELECT user_id, changed_at, arg_max(event_type, event_id) AS event_type FROM user_changes
            GROUP BY user_id, changed_at),
    stepped AS (SELECT *, lag(event_type) OVER (PARTITION BY user_id ORDER BY changed_at) AS prior FROM one),
    starts AS (SELECT user_id, event_type, changed_at FROM stepped WHERE prior IS DISTINCT FROM event_type),
    versions AS (SELECT user_id, event_type, changed_at AS eff_from,
                        coalesce(lead(changed_at) OVER (PARTITION BY user_id ORDER BY changed_at),
                                 TIMESTAMP '9999-12-31 00:00:00') AS eff_to,
                        lead(changed_at) OVER (PARTITION BY user_id ORDER BY changed_at) IS NULL AS is_current,
                        md5(concat(CAST(user_id AS VARCHAR), '|', event_type)) AS row_hash FROM starts)"""
_BROKEN = """
    broken AS (SELECT user_id, event_type, eff_from,
                      CASE WHEN day(eff_from) % 13 = 0 AND NOT is_current THEN eff_to + INTERVAL 1 HOUR ELSE eff_to END
                        AS eff_to,
                      CASE WHEN user_id % 29 = 0 THEN FALSE ELSE is_current END AS is_current,
                      CASE WHEN hour(eff_from) = 5 THEN '0' ELSE row_hash END AS row_hash FROM versions),
    following AS (SELECT *, lead(eff_from) OVER (PARTITION BY user_id ORDER BY eff_from, eff_to) AS next_from FROM broken),
    entity AS (SELECT user_id, count(*) FILTER (WHERE is_current) AS n_current FROM broken GROUP BY user_id),
    violations AS (
        SELECT 'gap' AS rule, user_id FROM following
        WHERE next_from IS NOT NULL AND date_trunc('second', next_from) <> date_trunc('second', eff_to)
        UNION ALL SELECT 'current', user_id FROM entity WHERE n_current <> 1
        UNION ALL SELECT 'terminal', user_id FROM broken WHERE NOT is_current AND CAST(eff_to AS DATE) = DATE '9999-12-31'
        UNION ALL SELECT 'row_hash', user_id FROM broken
        WHERE row_hash <> md5(concat(CAST(user_id AS VARCHAR), '|', event_type)))"""

_MERGED = f"""
    SELECT t.o_orderkey, CASE WHEN d.op IS NULL THEN t.o_custkey ELSE d.o_custkey END AS o_custkey,
           CASE WHEN d.op IS NULL THEN t.o_orderstatus ELSE d.o_orderstatus END AS o_orderstatus,
           CASE WHEN d.op IS NULL THEN t.o_totalprice ELSE d.o_totalprice END AS o_totalprice,
           CASE WHEN d.op IS NULL THEN t.o_orderdate ELSE d.o_orderdate END AS o_orderdate,
           CASE WHEN d.op IS NULL THEN t.o_orderpriority ELSE d.o_orderpriority END AS o_orderpriority,
           CASE WHEN d.op IS NULL THEN 'unchanged' WHEN d.op = 'D' THEN 'delete' ELSE 'update' END AS action
    FROM orders t LEFT JOIN order_delta d ON t.o_orderkey = d.o_orderkey
    UNION ALL
    SELECT {ORDER_KEYS}, 'insert' FROM order_delta d
    WHERE op <> 'D' AND NOT EXISTS (SELECT 1 FROM orders t WHERE t.o_orderkey = d.o_orderkey)"""

_PERCENTILES = """
    WITH ranked AS (SELECT {by}, value, row_number() OVER (PARTITION BY {by} ORDER BY value) AS rn,
                           count(*) OVER (PARTITION BY {by}) AS n FROM metric_runs WHERE value IS NOT NULL),
    summary AS (SELECT {by}, count(*) AS runs, max(CASE WHEN rn = (n * 50 + 99) // 100 THEN value END) AS p50,
                       max(CASE WHEN rn = (n * 95 + 99) // 100 THEN value END) AS p95,
                       min(value) AS min, max(value) AS max
                FROM ranked GROUP BY {by})"""

_ORPHANS = "SELECT o.o_orderkey, o.o_custkey FROM orders o LEFT JOIN customer_kept c ON o.o_custkey = c.c_custkey WHERE c.c_custkey IS NULL"

_FOLLOWERS = """
    SELECT f.interaction_id, f.date_key, f.program_sk, f.resolved_flag, count(r.interaction_id) AS followers
    FROM fact_interaction f LEFT JOIN fact_interaction r
      ON r.customer_ref = f.customer_ref AND r.start_ts > f.end_ts AND r.start_ts <= f.end_ts + INTERVAL 7 DAY
    GROUP BY ALL"""



def _masked(name: str, given: str, secret: str) -> str:
    """CTEs ``name`` (id, mask) of the texts of ``given`` (id, t): halves that take turns in being shifted."""
    char, shift = "substr(a, i, 1)", "('0x' || substr(s, (i - 1) * 8 + 1, 8))::BIGINT"
    moved = " ".join(
        f"WHEN {char} BETWEEN '{chr(f)}' AND '{chr(f + n - 1)}' THEN chr((({shift} + ascii({char}) - {f}) % {n} + {f})::INTEGER)"
        for f, n in ((48, 10), (65, 26), (97, 26))
    )
    text = f"{name}_0 AS (SELECT id, left(t, length(t) // 2) AS a, substr(t, length(t) // 2 + 1) AS b FROM ({given}))"
    for r in range(8):
        hashes = f"list_transform(range(0, (length(a) + 7) // 8), lambda j: sha256(concat_ws(':', '{secret}', '{r}', j, b)))"
        text += f""",
        {name}_{r + 1} AS (SELECT id, b AS a, coalesce(array_to_string(list_transform(range(1, length(a) + 1),
                lambda i: CASE {moved} ELSE {char} END), ''), '') AS b
            FROM (SELECT *, coalesce(array_to_string({hashes}, ''), '') AS s FROM {name}_{r}))"""
    return f"{text},\n        {name} AS (SELECT id, a || b AS mask FROM {name}_8)"


_PROFILE = """
    WITH v AS (SELECT count(*) FILTER (WHERE event_id IS NULL) AS id_nulls,
        count(*) FILTER (WHERE event_type IS NULL) AS type_nulls,
        count(*) FILTER (WHERE value_text IS NOT NULL AND try_cast(value_text AS DECIMAL(10,1)) IS NULL) AS not_number,
        count(*) FILTER (WHERE try_cast(value_text AS DECIMAL(38,18))
                               <> round(try_cast(value_text AS DECIMAL(38,18)), 1)) AS lost,
        count(*) FILTER (WHERE try_cast(user_text AS BIGINT) IS NULL) AS not_int FROM raw_events)"""

ORACLES: dict[str, str] = {
    "rowcount_parity": over("orders_target lineitem_target", f"""
        WITH c AS (
            SELECT 'orders' AS target, (SELECT count(*) FROM orders) AS s, (SELECT count(*) FROM orders_target) AS t,
                   0.001 * (SELECT count(*) FROM orders) AS tol
            UNION ALL SELECT 'orders_exact', (SELECT count(*) FROM orders), (SELECT count(*) FROM orders_target), 0
            UNION ALL SELECT 'orders_urgent', (SELECT count(*) FROM orders WHERE o_orderpriority = '1-URGENT'),
                   (SELECT count(*) FROM orders_target WHERE o_orderpriority = '1-URGENT'), 5
            UNION ALL SELECT 'lineitem', (SELECT count(*) FROM lineitem), (SELECT count(*) FROM lineitem_target),
                   0.0001 * (SELECT count(*) FROM lineitem))
        SELECT target, {_pass('abs(s - t) <= tol')}, CAST(s AS VARCHAR) AS expected, CAST(t AS VARCHAR) AS actual FROM c"""),
    "aggregate_parity": over("money_source money_target", f"""
        WITH s AS (SELECT sum(price) AS total, max(price) AS top, count(DISTINCT l_orderkey) AS keys,
                          count(l_returnflag) AS flags, min(l_returnflag) AS flag, min(l_shipdate) AS first,
                          max(l_shipdate) AS last FROM money_source),
        t AS (SELECT sum(price) AS total, max(price) AS top, count(DISTINCT l_orderkey) AS keys,
                     count(l_returnflag) AS flags, min(l_returnflag) AS flag, min(l_shipdate) AS first,
                     max(l_shipdate) AS last FROM money_target)
        SELECT 'money.price:sum' AS target, {_pass('s.total = t.total')}, CAST(s.total AS VARCHAR) AS expected,
               CAST(t.total AS VARCHAR) AS actual FROM s, t
        UNION ALL SELECT 'money.price:max', {_pass('abs(s.top - t.top) <= 0.001 * s.top')}, CAST(s.top AS VARCHAR),
               CAST(t.top AS VARCHAR) FROM s, t
        UNION ALL SELECT 'money.l_orderkey:count_distinct', {_pass('s.keys = t.keys')}, CAST(s.keys AS VARCHAR),
               CAST(t.keys AS VARCHAR) FROM s, t
        UNION ALL SELECT 'money.l_returnflag:count', {_pass('s.flags = t.flags')}, CAST(s.flags AS VARCHAR),
               CAST(t.flags AS VARCHAR) FROM s, t
        UNION ALL SELECT 'money.l_returnflag:min', {_pass('s.flag = t.flag')}, s.flag, t.flag FROM s, t
        UNION ALL SELECT 'money.l_shipdate:min', {_pass('s.first = t.first')}, CAST(s.first AS VARCHAR),
               CAST(t.first AS VARCHAR) FROM s, t
        UNION ALL SELECT 'money.l_shipdate:max', {_pass('abs(epoch(s.last) - epoch(t.last)) <= 1')},
               CAST(s.last AS VARCHAR), CAST(t.last AS VARCHAR) FROM s, t"""),
    "fingerprint_digest": f"""
        SELECT count(*) AS row_count, CAST(sum(CAST({_hash60(_ORDER_TEXT)} AS HUGEINT)) AS VARCHAR) AS hash_sum FROM orders""",
    "fingerprint_buckets": f"""
        SELECT {_hash60('CAST(o_orderkey AS VARCHAR)')} % 256 AS bucket, count(*) AS row_count,
               CAST(sum(CAST({_hash60(_ORDER_TEXT)} AS HUGEINT)) AS VARCHAR) AS hash_sum FROM orders GROUP BY 1""",
    "fingerprint_canonical": _canonical_fingerprint(),
    "fingerprint_parity": over("orders_target", f"""
        WITH d AS (SELECT count(*) AS n FROM (SELECT {ORDER_KEYS} FROM orders EXCEPT ALL SELECT {ORDER_KEYS} FROM orders_target)),
        k AS (SELECT count(*) AS n FROM (SELECT o_custkey, o_orderstatus, o_orderdate FROM orders
                                         EXCEPT ALL SELECT o_custkey, o_orderstatus, o_orderdate FROM orders_target))
        SELECT 'same' AS target, 'PASS' AS status UNION ALL SELECT 'same_fast', 'PASS'
        UNION ALL SELECT 'changed', {_pass('n = 0')} FROM d UNION ALL SELECT 'changed_fast', {_pass('n = 0')} FROM k"""),
    "localize_keys": over("orders_target", _ORDER_DIFF),
    "localize_by_sketch": over("orders_target", _ORDER_DIFF),
    "localize_summary": over("orders_target", f"SELECT side, count(*) AS n FROM ({_ORDER_DIFF}) GROUP BY side"),
    "localize_sample": over("orders_target", f"SELECT * FROM ({_ORDER_DIFF}) ORDER BY o_orderkey LIMIT 10"),
    "localize_duplicate_keys": over("lineitem_target", f"""
        WITH odd AS (
            SELECT l_orderkey, l_linenumber FROM
                (SELECT {LINE_KEYS} FROM lineitem EXCEPT ALL SELECT {LINE_KEYS} FROM lineitem_target)
            UNION SELECT l_orderkey, l_linenumber FROM
                (SELECT {LINE_KEYS} FROM lineitem_target EXCEPT ALL SELECT {LINE_KEYS} FROM lineitem)),
        s AS (SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY ALL),
        t AS (SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem_target GROUP BY ALL)
        SELECT o.l_orderkey, o.l_linenumber,
               CASE WHEN t.n IS NULL THEN 'only_source' WHEN s.n IS NULL THEN 'only_target' ELSE 'differs' END AS side,
               coalesce(s.n, 0) AS n_source, coalesce(t.n, 0) AS n_target
        FROM odd o LEFT JOIN s ON o.l_orderkey = s.l_orderkey AND o.l_linenumber = s.l_linenumber
                   LEFT JOIN t ON o.l_orderkey = t.l_orderkey AND o.l_linenumber = t.l_linenumber"""),
    "multiset_diff": over("orders_target", _copies(
        "o_custkey, o_orderstatus, o_totalprice", "orders", "orders_target",
        "concat_ws('|', CAST(o_custkey AS VARCHAR), o_orderstatus, "
        "rtrim(rtrim(CAST(CAST(round(o_totalprice, 6) AS DECIMAL(38,6)) AS VARCHAR), '0'), '.')) AS row")),
    "row_diff": over("lineitem_target", _copies(
        "l_returnflag, l_linenumber, l_quantity", "lineitem", "lineitem_target", "l_returnflag, l_linenumber, l_quantity")),
    "query_parity_rowset": over("elt_staging", f"""
        WITH a AS (SELECT event_type AS channel, count(*) AS n, sum(CAST(value AS DECIMAL(12,2))) AS amount FROM events GROUP BY 1),
        b AS (SELECT channel, count(*) AS n, sum(amount) AS amount FROM elt_staging GROUP BY 1),
        f AS (SELECT channel, count(*) AS n, NULL AS amount FROM elt_staging WHERE status = 'raw' GROUP BY 1)
        SELECT 'channel_rollup' AS target, {_pass('count(*) = 0')} FROM (SELECT * FROM a EXCEPT ALL SELECT * FROM b)
        UNION ALL SELECT 'channel_rollup_filtered', {_pass('count(*) = 0')} FROM (SELECT * FROM a EXCEPT ALL SELECT * FROM f)"""),
    "query_parity_scalar": over("fact_interaction", f"""
        SELECT 'approx_distinct_contacts' AS target, 'PASS' AS status
        UNION ALL SELECT 'resolved_only', {_pass('count(*) FILTER (WHERE NOT resolved_flag) <= 0.05 * count(*)')}
        FROM fact_interaction"""),
    "transform_diff": over("raw_invoices", f"""
        SELECT 'same' AS target, 'PASS' AS status UNION ALL SELECT 'extra_column', 'FAIL'
        UNION ALL SELECT 'drops_deletes', {_pass("count(*) FILTER (WHERE op = 'D') = 0")} FROM raw_invoices"""),
    "transform_unit": over("elt_staging", """
        WITH odd AS (SELECT CAST(count(*) FILTER (WHERE id = 1 AND amount <> 99.99) AS VARCHAR) AS n FROM elt_staging WHERE status = 'raw')
        SELECT 'mart' AS target, 'PASS' AS status, '0' AS missing, '0' AS extra
        UNION ALL SELECT 'mart_bad', CASE WHEN n = '0' THEN 'PASS' ELSE 'FAIL' END, n, n FROM odd"""),
    "property_asserts": over("raw_events", f"""
        WITH c AS (
            SELECT 'lineitem.unique(l_orderkey, l_linenumber)' AS target, (SELECT count(*) FROM lineitem) AS e,
                   (SELECT count(*) FROM (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem)) AS a
            UNION ALL SELECT 'lineitem.l_tax no_nulls', 0, (SELECT count(*) FROM lineitem WHERE l_tax IS NULL)
            UNION ALL SELECT 'orders.unique(o_orderkey)', (SELECT count(*) FROM orders), (SELECT count(DISTINCT o_orderkey) FROM orders)
            UNION ALL SELECT 'orders.o_orderdate no_nulls', 0, (SELECT count(*) FROM orders WHERE o_orderdate IS NULL)
            UNION ALL SELECT 'raw_events.rowcount', -1, (SELECT count(*) FROM raw_events)
            UNION ALL SELECT 'raw_events.event_type no_nulls', 0, (SELECT count(*) FROM raw_events WHERE event_type IS NULL)
            UNION ALL SELECT 'raw_events.day_text no_nulls', 0, (SELECT count(*) FROM raw_events WHERE day_text IS NULL))
        SELECT target, {_pass('e = a')}, CAST(e AS VARCHAR) AS expected, CAST(a AS VARCHAR) AS actual FROM c"""),
    "raw_to_mart": over("elt_staging", f"""
        SELECT id, channel, CAST(amount AS DOUBLE) AS amount, {ts('event_ts', 'event_ts')} FROM elt_staging WHERE status = 'raw'"""),
    "invoices_from_raw": over("raw_invoices", f"""
        SELECT invoice_id, CAST(amount AS DOUBLE) AS amount, {ts('make_timestamp(issued_ms * 1000)', 'issued_ts')}, upper(op) AS op
        FROM raw_invoices WHERE upper(op) <> 'D'"""),
    "epoch_conversion": over("epoch_source epoch_target", _EPOCH_CLASSES + " SELECT class, count(*) AS n FROM classified GROUP BY class"),
    "epoch_failures": over("epoch_source epoch_target", _EPOCH_CLASSES + f"""
        SELECT event_id, raw, {ts('instant', 'expected')}, {ts('ts', 'actual')}, class FROM classified
        WHERE class NOT IN ('matched', 'nulled', 'null_source')"""),
    "epoch_checks": over("epoch_source epoch_target epoch_audit", _EPOCH_CLASSES + f""",
        k AS (SELECT count(*) FILTER (WHERE class NOT IN ('matched', 'nulled', 'null_source')) AS bad,
                     count(*) FILTER (WHERE class IN ('nulled', 'should_be_null') AND raw IS NOT NULL) AS outside,
                     (SELECT count(*) FROM epoch_audit) AS audited FROM classified)
        SELECT 'events.converted_ts' AS target, {_pass('bad = 0')}, '0' AS expected, CAST(bad AS VARCHAR) AS actual FROM k
        UNION ALL SELECT 'events.converted_ts (audit)', {_pass('audited >= outside')}, CAST(outside AS VARCHAR),
               CAST(audited AS VARCHAR) FROM k WHERE outside > 0"""),
    "decimal_roundtrip": over("balance_source balance_target", _BALANCE_DIFF + " SELECT * FROM found WHERE reason IS NOT NULL"),
    "decimal_checks": over("balance_source balance_target", _BALANCE_DIFF + f"""
        SELECT concat('customer.', "column") AS target, {_pass('count(reason) = 0')}, '0' AS expected,
               CAST(count(reason) AS VARCHAR) AS actual FROM found GROUP BY "column" """),
    "scd2_build": over("user_changes", f"""
        WITH {_VERSIONS} SELECT user_id, event_type, {ts('eff_from', 'eff_from')}, {ts('eff_to', 'eff_to')}, is_current, row_hash
        FROM versions"""),
    "scd2_continuity": over("user_changes", f"""
        WITH {_VERSIONS}, {_BROKEN} SELECT rule, user_id AS entity, count(*) AS n FROM violations GROUP BY rule, user_id"""),
    "scd2_checks": over("user_changes", f"""
        WITH {_VERSIONS}, {_BROKEN}, rules AS (SELECT unnest(['gap', 'current', 'terminal', 'row_hash']) AS rule)
        SELECT concat('good:', rule) AS target, 'PASS' AS status, '0' AS expected, '0' AS actual FROM rules
        UNION ALL
        SELECT concat('broken:', r.rule), {_pass('count(v.user_id) = 0')}, '0', CAST(count(v.user_id) AS VARCHAR)
        FROM rules r LEFT JOIN violations v ON v.rule = r.rule GROUP BY r.rule"""),
    "row_hash": over("customer_hashed", """
        SELECT c_custkey, row_hash, md5(concat_ws('|', CAST(c_custkey AS VARCHAR), c_name, c_mktsegment)) AS computed_hash
        FROM customer_hashed WHERE row_hash <> md5(concat_ws('|', CAST(c_custkey AS VARCHAR), c_name, c_mktsegment))"""),
    "merge_apply": over("order_delta", f"""
        SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, {ts('o_orderdate', 'o_orderdate')}, o_orderpriority
        FROM ({_MERGED}) WHERE action <> 'delete'"""),
    "versioned_merge": over("order_patch", f"""
        SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, {ts('o_orderdate', 'o_orderdate')}, o_orderpriority FROM
            (SELECT * FROM orders WHERE o_orderkey NOT IN (SELECT o_orderkey FROM order_patch)
             UNION ALL SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority FROM order_patch WHERE op <> 'D')"""),
    "versioned_history": over("order_patch", """
        SELECT 1 AS version, 'load' AS run_id, 'overwrite' AS action, count(*) AS n_rows, false AS kept_some FROM orders
        UNION ALL SELECT 2, 'patch', 'merge', (SELECT count(*) FROM orders WHERE o_orderkey NOT IN (SELECT o_orderkey FROM order_patch))
            + (SELECT count(*) FROM order_patch WHERE op <> 'D'), (SELECT count(*) FROM orders) > 1000"""),
    "merge_actions": over("order_delta", f"SELECT action, count(*) AS n FROM ({_MERGED}) GROUP BY action"),
    "merge_idempotent": over("order_delta", f"""
        SELECT 'merge' AS target, 'PASS' AS status
        UNION ALL SELECT 'append', {_pass('count(*) = 0')} FROM order_delta"""),
    "deletes_absent": over("order_delta", f"""
        SELECT 'merged (deletes)' AS target, 'PASS' AS status, '0' AS expected, '0' AS actual
        UNION ALL SELECT 'unmerged (deletes)', {_pass('count(*) = 0')}, '0', CAST(count(*) AS VARCHAR)
        FROM orders WHERE o_orderkey IN (SELECT o_orderkey FROM order_delta WHERE op = 'D')"""),
    "change_log_merge": over("user_state user_changes", """
        WITH newest AS (SELECT *, row_number() OVER (PARTITION BY user_id
                            ORDER BY changed_at DESC, CASE WHEN op = 'D' THEN 0 ELSE 1 END) AS rn FROM user_changes),
        d AS (SELECT user_id, event_type, value, op FROM newest WHERE rn = 1)
        SELECT t.user_id, coalesce(d.event_type, t.event_type) AS event_type, coalesce(d.value, t.value) AS value
        FROM user_state t LEFT JOIN d ON t.user_id = d.user_id WHERE d.op IS DISTINCT FROM 'D'
        UNION ALL SELECT user_id, event_type, value FROM d
        WHERE op <> 'D' AND user_id NOT IN (SELECT user_id FROM user_state)"""),
    "fk_orphan": over("customer_kept", f"""
        WITH s AS (SELECT count(*) FILTER (WHERE c.c_custkey IS NULL) / count(*) AS rate
                   FROM orders o LEFT JOIN customer c ON o.o_custkey = c.c_custkey),
        t AS (SELECT (SELECT count(*) FROM ({_ORPHANS})) / count(*) AS rate FROM orders)
        SELECT 'same' AS target, 'PASS' AS status
        UNION ALL SELECT 'orders.o_custkey', {_pass('abs(t.rate - s.rate) <= 0.005')} FROM s, t
        UNION ALL SELECT 'orders.o_custkey (cap)', {_pass('rate <= 0.05')} FROM t"""),
    "fk_orphan_counts": over("customer_kept", f"""
        SELECT count(*) AS children, (SELECT count(*) FROM ({_ORPHANS})) AS orphans FROM orders"""),
    "fk_orphan_rows": over("customer_kept", _ORPHANS),
    "conformance_profile": over("raw_events", _PROFILE + """
        SELECT 'event_id' AS "column", 'present' AS rule, 0 AS bad, 'INT64' AS expected, 'INT64' AS actual
        UNION ALL SELECT 'event_id', 'type', 0, 'INT64', 'INT64'
        UNION ALL SELECT 'event_id', 'not_null', id_nulls, '0', CAST(id_nulls AS VARCHAR) FROM v
        UNION ALL SELECT 'user_id', 'present', 1, 'INT64', 'expected as a rename of user_text'
        UNION ALL SELECT 'value_text', 'present', 0, 'NUMERIC(10,1)', 'STRING'
        UNION ALL SELECT 'value_text', 'type', 1, 'NUMERIC(10,1)', 'STRING'
        UNION ALL SELECT 'value_text', 'convertible', not_number, '0', CAST(not_number AS VARCHAR) FROM v
        UNION ALL SELECT 'value_text', 'scale', lost, '0', CAST(lost AS VARCHAR) FROM v
        UNION ALL SELECT 'EVENT_TYPE', 'present', 0, 'STRING', 'STRING'
        UNION ALL SELECT 'EVENT_TYPE', 'type', 0, 'STRING', 'STRING'
        UNION ALL SELECT 'EVENT_TYPE', 'not_null', type_nulls, '0', CAST(type_nulls AS VARCHAR) FROM v
        UNION ALL SELECT 'ts_ms', 'present', 0, 'NUMERIC(38,9)', 'INT64'
        UNION ALL SELECT 'ts_ms', 'declared_scale', 1, 'a scale', 'NUMERIC'
        UNION ALL SELECT 'ts_ms', 'type', 1, 'NUMERIC(38,9)', 'INT64'
        UNION ALL SELECT 'ts_ms', 'convertible', 0, '0', '0'
        UNION ALL SELECT 'props', 'present', 0, 'MAP<STRING,INT64>', 'STRING'
        UNION ALL SELECT 'props', 'type', 1, 'MAP<STRING,INT64>', 'STRING'"""),
    "conformance_mapping": over("raw_events", _PROFILE + """
        SELECT 'event_id' AS "column", 'present' AS rule, 0 AS bad UNION ALL SELECT 'event_id', 'type', 0
        UNION ALL SELECT 'user_text', 'present', 0 UNION ALL SELECT 'user_text', 'type', 0
        UNION ALL SELECT 'user_text', 'convertible', not_int FROM v
        UNION ALL SELECT 'value_text', 'present', 0 UNION ALL SELECT 'value_text', 'type', 1
        UNION ALL SELECT 'value_text', 'convertible', not_number FROM v
        UNION ALL SELECT 'value_text', 'scale', lost FROM v
        UNION ALL SELECT 'EVENT_TYPE', 'present', 0 UNION ALL SELECT 'EVENT_TYPE', 'type', 0
        UNION ALL SELECT 'ts_ms', 'present', 0 UNION ALL SELECT 'ts_ms', 'declared_scale', 1
        UNION ALL SELECT 'ts_ms', 'type', 1 UNION ALL SELECT 'ts_ms', 'convertible', 0
        UNION ALL SELECT 'props', 'present', 0 UNION ALL SELECT 'props', 'type', 1"""),
    "conform": over("raw_events", f"""
        SELECT event_id, CAST(user_text AS BIGINT) AS user_id, CAST(CAST(value_text AS DECIMAL(12,3)) AS DOUBLE) AS value,
               event_type, {ts('make_timestamp(ts_ms * 1000)', 'ts')},
               CAST(CAST(try_strptime(day_text, '%Y%m%d') AS DATE) AS VARCHAR) AS partition_date, 'k' AS prop,
               CAST(json_extract(props, '$.k') AS BIGINT) AS prop_value
        FROM raw_events WHERE value_text <> 'oops' AND try_strptime(day_text, '%Y%m%d') IS NOT NULL"""),
    "conform_quarantine": over("raw_events", """
        SELECT event_id, value_text, day_text,
               concat_ws(',', CASE WHEN value_text = 'oops' THEN 'value' END,
                              CASE WHEN try_strptime(day_text, '%Y%m%d') IS NULL THEN 'partition_date' END) AS failed
        FROM raw_events WHERE value_text = 'oops' OR try_strptime(day_text, '%Y%m%d') IS NULL"""),
    "bulk_load_check": over("elt_staging", """
        WITH e AS (SELECT CAST(count(*) AS VARCHAR) AS n FROM elt_staging), p AS (SELECT CAST(count(*) AS VARCHAR) AS n FROM part)
        SELECT 'json' AS target, 'PASS' AS status, CAST(NULL AS VARCHAR) AS expected, n AS actual FROM e
        UNION ALL SELECT 'csv', 'PASS', NULL, n FROM p UNION ALL SELECT 'orc', 'PASS', NULL, n FROM p
        UNION ALL SELECT 'orc (partition column p_brand)', 'PASS', NULL, NULL
        UNION ALL SELECT 'orc_other', 'FAIL', '-1', n FROM p
        UNION ALL SELECT 'orc_other (partition column no_such_column)', 'FAIL', NULL, NULL
        UNION ALL SELECT 'missing', 'FAIL', NULL, NULL"""),
    "file_intake": """
        WITH k AS (SELECT event_id % 8 AS part, count(*) AS n, sum(event_id) AS ids FROM events GROUP BY 1),
             r(part, reason) AS (VALUES (0, 'good'), (1, 'good'), (2, 'header'), (3, 'order'), (4, 'checksum'), (5, 'unlisted'), (6, 'good'), (7, 'ambiguous'))
        SELECT part, reason, CASE WHEN reason = 'good' THEN n ELSE 0 END AS n_rows, CASE WHEN reason = 'good' THEN ids ELSE 0 END AS ids FROM k JOIN r USING (part)
        UNION ALL SELECT 9, 'missing', 0, 0""",
    "egress_roundtrip": over("elt_staging", f"""
        WITH k AS (SELECT count(*) FILTER (WHERE status <> 'raw') AS n, sum(CASE WHEN status <> 'raw' THEN amount ELSE 0 END) AS a
                   FROM elt_staging)
        SELECT 'events (identity)' AS target, 'PASS' AS status UNION ALL SELECT 'events (row count)', 'PASS'
        UNION ALL SELECT 'events (control total amount)', 'PASS'
        UNION ALL SELECT 'events_raw (identity)', {_pass('n = 0')} FROM k
        UNION ALL SELECT 'events_raw (row count)', {_pass('n = 0')} FROM k
        UNION ALL SELECT 'events_raw (control total amount)', {_pass('a = 0')} FROM k"""),
    "control_totals": over("raw_events", """
        SELECT count(*) AS row_count, CAST(coalesce(sum(try_cast(value_text AS DECIMAL(38,9))), 0) AS DOUBLE) AS total FROM raw_events"""),
    "exact_totals": over("digit_amounts", """
        SELECT count(*) AS row_count, rtrim(rtrim(CAST(sum(try_cast(amount AS DECIMAL(38,20))) AS VARCHAR), '0'), '.') AS total, 0 AS beyond
        FROM digit_amounts"""),
    "retained_events": "SELECT event_type, count(*) AS n FROM events WHERE ts >= TIMESTAMP '2024-01-23 00:00:00' GROUP BY 1",
    "incremental_rows": f"""
        SELECT 'events' AS source_table, {ts('max(ts)', 'last_value')}, '2024-02-01 00:00:00' AS last_run_ts, 'run-2' AS run_id
        FROM events WHERE ts > TIMESTAMP '2024-01-15 00:00:00'""",
    "metrics_percentiles": over("metric_runs", _PERCENTILES.format(by="query_id, metric") + " SELECT * FROM summary"),
    "metrics_budget": over("metric_runs", _PERCENTILES.format(by="query_id, metric") + f"""
        SELECT 'click:value' AS target, {_pass('p95 <= 1000')} FROM summary WHERE query_id = 'click' AND metric = 'value'
        UNION ALL SELECT 'error:value', {_pass('p95 <= 50')} FROM summary WHERE query_id = 'error' AND metric = 'value'
        UNION ALL SELECT 'view:elapsed_ms', 'FAIL'"""),
    "metrics_compare": over("metric_runs", _PERCENTILES.format(by="query_id, side, metric") + f""",
        wide AS (SELECT query_id, metric, max(CASE WHEN side = 'a' THEN p95 END) AS a, max(CASE WHEN side = 'b' THEN p95 END) AS b
                 FROM summary GROUP BY query_id, metric)
        SELECT concat(query_id, ':', metric) AS target,
               {_pass("(metric = 'value' AND b <= a * 2.0) OR (metric = 'user' AND b < a * 0.5)")}, a, b FROM wide
        UNION ALL SELECT DISTINCT concat(query_id, ':bytes'), 'FAIL', CAST(NULL AS DOUBLE), CAST(NULL AS DOUBLE) FROM wide"""),
    "metrics_regression": over("metric_runs metric_baseline", _PERCENTILES.format(by="query_id, metric") + f"""
        SELECT concat(s.query_id, ':value') AS target, {_pass('b.value IS NULL OR s.p95 <= b.value * 1.1')},
               b.value IS NULL AS measurement
        FROM summary s LEFT JOIN metric_baseline b ON s.query_id = b.query_id WHERE s.metric = 'value'"""),
    "metrics_baseline_next": over("metric_runs metric_baseline", _PERCENTILES.format(by="query_id, metric") + """
        SELECT query_id, metric, value FROM metric_baseline
        UNION ALL SELECT query_id, metric, p95 FROM summary
        WHERE metric = 'value' AND query_id NOT IN (SELECT query_id FROM metric_baseline)"""),
    "signoff_coverage": over("customer_kept", f"""
        WITH o AS (SELECT (SELECT count(*) FROM ({_ORPHANS})) <= 0.01 * count(*) AS good FROM orders)
        SELECT 'rowcount_parity' AS pattern, 'PASS' AS status, 1 AS checks, TRUE AS covered
        UNION ALL SELECT 'fingerprint_parity', 'FAIL', 1, FALSE
        UNION ALL SELECT 'fk_orphan', CASE WHEN good THEN 'PASS' ELSE 'FAIL' END, 1, good FROM o"""),
    "signoff_gaps": over("customer_kept", f"""
        SELECT 'Transform' AS flow_group, 'fingerprint_parity' AS pattern UNION ALL SELECT 'Egress', 'egress_parity'
        UNION ALL SELECT 'Transform', 'fk_orphan' FROM (SELECT (SELECT count(*) FROM ({_ORPHANS})) AS n, count(*) AS every FROM orders)
        WHERE n > 0.01 * every"""),
    "check_export": over("customer_kept", f"""
        SELECT 'rowcount_parity' AS pattern, 'orders' AS target, 'pass' AS status
        UNION ALL SELECT 'fingerprint_parity', 'orders', 'fail'
        UNION ALL SELECT 'fk_orphan', 'orders (cap)', CASE WHEN (SELECT count(*) FROM ({_ORPHANS})) <= 0.01 * count(*)
                                                           THEN 'pass' ELSE 'fail' END FROM orders"""),
    "chat_counts": """
        SELECT conv_id, count(*) AS message_count, count(*) FILTER (WHERE role = 'assistant') AS agent_message_count,
               count(*) FILTER (WHERE role <> 'assistant') AS customer_message_count,
               min(turn) FILTER (WHERE role = 'assistant') AS first_response_turn
        FROM conversations GROUP BY conv_id""",
    "ivr_sessions": f"""
        SELECT user_id, {ts('min(ts)', 'first_event_ts')}, {ts('max(ts)', 'last_event_ts')}, count(*) AS hops,
               NOT bool_or(event_type = 'purchase') AS contained
        FROM events GROUP BY user_id""",
    "ivr_path": """
        SELECT user_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS hop, event_type FROM events""",
    "unite_channels": """
        SELECT 'digital' AS channel, count(*) AS n, 0 AS with_amount, count(DISTINCT user_id) AS customers FROM events
        UNION ALL SELECT 'order', count(*), count(o_totalprice), count(DISTINCT o_custkey) FROM orders""",
    "surrogate_lookup": over("fact_interaction dim_agent", """
        SELECT coalesce(a.agent_sk, -1) AS surrogate, count(*) AS n
        FROM fact_interaction f LEFT JOIN dim_agent a ON a.agent_sk = f.agent_sk AND a.is_current GROUP BY 1"""),
    "period_totals": f"""
        SELECT {ts('p', 'period_start')}, event_type, count(*) AS n, CAST(sum(amount) AS DOUBLE) AS amount,
               grouping(p) * 2 + grouping(event_type) AS grouping_level
        FROM (SELECT CAST(date_trunc('week', ts) AS TIMESTAMP) AS p, event_type, CAST(value AS DECIMAL(12,2)) AS amount FROM events)
        GROUP BY ROLLUP (p, event_type)""",
    "hourly_totals": f"SELECT {ts('date_trunc(' + chr(39) + 'hour' + chr(39) + ', ts)', 'period_start')}, count(*) AS n, max(value) AS top FROM events GROUP BY 1",
    "section_totals": """
        WITH lines AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM documents),
        sums AS (SELECT doc_id, count(*) AS section_count, CAST(sum(length(line)) AS DOUBLE) AS scored_points,
                        CAST(sum(length(line) + 10) AS DOUBLE) AS max_points FROM lines GROUP BY doc_id)
        SELECT *, round(scored_points / max_points * 100, 2) AS overall_pct FROM sums""",
    "range_self_join": over("fact_interaction", f"SELECT interaction_id, followers FROM ({_FOLLOWERS})"),
    "conformance_nested": """
        WITH v AS (SELECT l_linenumber AS n, l_returnflag AS flag, unnest([l_extendedprice, l_discount, l_extendedprice]) AS amount,
                          unnest([1, 2, 3]) AS i FROM lineitem),
        k AS (SELECT * FROM v WHERE i < 3 OR n <> 3),
        c AS (SELECT 'amounts' AS "column", 'not_null' AS rule, 0 AS bad
              UNION ALL SELECT 'amounts[]', 'not_null', count(*) FILTER (WHERE i = 3 AND n = 3) FROM v
              UNION ALL SELECT 'amounts[].number', 'not_null', count(*) FILTER (WHERE n IS NULL) FROM k
              UNION ALL SELECT 'amounts[].number', 'convertible', count(*) FILTER (WHERE n = 7) FROM k
              UNION ALL SELECT 'amounts[].amount', 'convertible', 0
              UNION ALL SELECT 'amounts[].amount', 'scale', count(*) FILTER (WHERE amount <> round(amount, 1)) FROM k
              UNION ALL SELECT 'amounts[].flag', 'not_null', count(*) FILTER (WHERE flag = 'R' OR flag IS NULL) FROM k)
        SELECT "column", rule, bad, '0' AS expected, CAST(bad AS VARCHAR) AS actual FROM c""",
    "follow_up_pairs": over("fact_interaction", f"""
        SELECT f.interaction_id, r.interaction_id AS follower_id, {ts('r.start_ts', 'started_at')}
        FROM fact_interaction f JOIN fact_interaction r
          ON r.customer_ref = f.customer_ref AND r.start_ts > f.end_ts AND r.start_ts <= f.end_ts + INTERVAL 7 DAY"""),
    "masked_customers": f"""
        WITH {_masked('keys', 'SELECT c_custkey AS id, CAST(c_custkey AS VARCHAR) AS t FROM customer', 'example:customer')},
        {_masked('names', 'SELECT c_custkey AS id, c_name AS t FROM customer', 'example:name')},
        n AS (SELECT o_custkey, count(*) AS n_orders FROM orders GROUP BY 1)
        SELECT keys.mask AS customer_mask, names.mask AS name_mask, c_mktsegment, n_orders
        FROM customer JOIN keys ON keys.id = c_custkey JOIN names ON names.id = c_custkey LEFT JOIN n ON o_custkey = c_custkey""",
    "monthly_users": """
        SELECT strftime(ts, '%Y-%m') AS month, event_type, count(DISTINCT user_id) AS n_users FROM events GROUP BY ALL""",
    "latest_per_user": """
        SELECT user_id, event_id, event_type, value FROM (
            SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events)
        WHERE rn = 1""",
    "org_ancestry": over("org_links", """
        WITH RECURSIVE good AS (
            SELECT unit_id, unit_id AS root_id, 0 AS depth FROM org_links WHERE parent_id IS NULL
            UNION ALL SELECT l.unit_id, g.root_id, g.depth + 1 FROM org_links l JOIN good g ON l.parent_id = g.unit_id),
        lost AS (
            SELECT unit_id, parent_id AS root_id, 1 AS depth FROM org_links
            WHERE parent_id IS NOT NULL AND parent_id NOT IN (SELECT unit_id FROM org_links)
            UNION ALL SELECT l.unit_id, g.root_id, g.depth + 1 FROM org_links l JOIN lost g ON l.parent_id = g.unit_id)
        SELECT unit_id, root_id, depth, 'rooted' AS status FROM good UNION ALL SELECT unit_id, root_id, depth, 'orphan' FROM lost
        UNION ALL SELECT unit_id, NULL, NULL, 'cycle' FROM org_links
        WHERE unit_id NOT IN (SELECT unit_id FROM good) AND unit_id NOT IN (SELECT unit_id FROM lost)""", recursive=True),
    "org_hierarchy": over("ods_org_unit", """
        WITH RECURSIVE tree AS (
            SELECT *, org_unit_id AS root_unit_id, 0 AS depth, unit_name AS path_names FROM ods_org_unit
            WHERE parent_unit_id IS NULL
            UNION ALL
            SELECT u.*, t.root_unit_id, t.depth + 1, concat(t.path_names, ' > ', u.unit_name)
            FROM tree t JOIN ods_org_unit u ON u.parent_unit_id = t.org_unit_id WHERE t.depth + 1 <= 6)
        SELECT org_unit_id, unit_code, unit_name, unit_type, site_code, root_unit_id, depth, path_names FROM tree""", True),
    "active_agents": over("fact_interaction dim_agent", """
        SELECT date_key, site_code, count(*) AS interactions, TRUE AS agents_close, TRUE AS pairs_close
        FROM fact_interaction JOIN dim_agent USING (agent_sk) GROUP BY date_key, site_code"""),
    "csat_rollup": over("fact_csat_survey dim_program", """
        SELECT client_id, program_code, count(*) AS surveys, avg(csat_score) AS avg_csat,
               count(*) FILTER (WHERE nps_score >= 9) / count(*) * 100 AS pct_promoters,
               2 * grouping(client_id) + grouping(program_code) AS grouping_level
        FROM fact_csat_survey JOIN dim_program USING (program_sk) GROUP BY ROLLUP (client_id, program_code)"""),
    "call_drivers": over("ods_call dim_disposition", r"""
        WITH labelled AS (SELECT CAST(call_date AS VARCHAR) AS call_date, queue_id, talk_seconds,
            CASE WHEN regexp_matches(disposition_desc, '(?i)(bill|invoice|charge|refund)') THEN 'BILLING'
                 WHEN regexp_matches(disposition_desc, '(?i)(password|login|locked|reset)') THEN 'ACCESS'
                 WHEN regexp_matches(disposition_desc, '(?i)(cancel|churn|retention)') THEN 'RETENTION'
                 ELSE coalesce(nullif(regexp_extract(disposition_desc, '^\[([A-Z]{2,5})\]', 1), ''), 'OTHER') END AS call_driver,
            nullif(regexp_extract(disposition_desc, 'ref#(\d+)', 1), '') AS embedded_ref_no
            FROM ods_call JOIN dim_disposition USING (disposition_code))
        SELECT call_date, queue_id, call_driver, embedded_ref_no, count(*) AS calls, avg(talk_seconds) AS avg_talk_seconds
        FROM labelled GROUP BY ALL"""),
    "repeat_contacts": over("ods_interaction", f"""
        WITH p AS (SELECT *, lag(start_ts) OVER (PARTITION BY customer_ref ORDER BY start_ts, interaction_id) AS prior
                   FROM ods_interaction WHERE customer_ref <> '')
        SELECT interaction_id, customer_ref, channel, {ts('start_ts', 'start_ts')}, {ts('prior', 'prev_contact_ts')},
               CASE WHEN floor(epoch(start_ts)) - floor(epoch(prior)) <= 259200 THEN 1 ELSE 0 END AS repeat_within_72h FROM p"""),
    "billing_reconciliation": over("stg_fin_invoice ods_invoice_acid", f"""
        SELECT invoice_no, CAST(s.total_amount AS DOUBLE) AS staged_amount, CAST(a.total_amount AS DOUBLE) AS ods_amount,
               {ts('make_timestamp(issued_ts_sec * 1000)', 'staged_issued_ts')}, {ts('a.issued_ts', 'ods_issued_ts')},
               CAST(floor(epoch(a.issued_ts)) AS BIGINT) - issued_ts_sec // 1000 AS drift_seconds,
               CASE WHEN abs(s.total_amount - a.total_amount) > 0.01 THEN 'AMOUNT_MISMATCH'
                    WHEN floor(epoch(a.issued_ts)) <> issued_ts_sec // 1000 THEN 'TS_MISMATCH' ELSE 'OK' END AS recon_status
        FROM stg_fin_invoice s JOIN ods_invoice_acid a ON s.invoice_id = a.invoice_id"""),
    "agent_roster": over("ods_agent_scd2 ods_agent_assignment_scd2", f"""
        WITH h AS (SELECT *, row_number() OVER (PARTITION BY agent_id ORDER BY eff_from_ts DESC, agent_history_id DESC) AS rn
                   FROM ods_agent_scd2)
        SELECT h.agent_id, employee_no, org_unit_id, job_grade, employment_type, status, {ts('eff_from_ts', 'eff_from_ts')},
               g.program_id AS current_program_id, g.queue_id AS current_queue_id, g.role_on_program
        FROM h LEFT JOIN ods_agent_assignment_scd2 g ON g.agent_id = h.agent_id AND g.is_current WHERE h.rn = 1"""),
    "agent_scorecard": over("dim_agent agg_agent_daily fact_qa_evaluation ods_agent_skill_scd2", """
        WITH p AS (SELECT agent_sk, avg(avg_handle_seconds) AS aht, avg(adherence_pct) AS adherence,
                          CAST(sum(interactions_handled) AS BIGINT) AS volume FROM agg_agent_daily GROUP BY 1),
        q AS (SELECT agent_sk, avg(overall_pct) AS avg_qa_pct FROM fact_qa_evaluation GROUP BY 1),
        k AS (SELECT agent_id, count(*) AS n FROM ods_agent_skill_scd2 WHERE is_current AND certified GROUP BY 1)
        SELECT a.agent_sk, full_name, site_code, job_grade, aht, adherence, volume, avg_qa_pct,
               coalesce(k.n, 0) AS certified_skills,
               percent_rank() OVER (ORDER BY aht NULLS FIRST) AS aht_pctile,
               ntile(4) OVER (ORDER BY avg_qa_pct DESC NULLS LAST, a.agent_sk) AS qa_quartile
        FROM dim_agent a JOIN p USING (agent_sk) LEFT JOIN q USING (agent_sk) LEFT JOIN k USING (agent_id)
        WHERE a.is_current"""),
    "attrition_risk": over("dim_agent fact_adherence_daily ods_attrition_event", """
        WITH d AS (SELECT agent_sk, avg(adherence_pct) AS adherence_90d FROM fact_adherence_daily GROUP BY 1),
        n AS (SELECT agent_id, count(*) AS notice_events FROM ods_attrition_event GROUP BY 1),
        b AS (SELECT a.agent_sk, a.agent_id, full_name, site_code, adherence_90d, coalesce(notice_events, 0) AS notice_events,
                     ntile(5) OVER (ORDER BY adherence_90d NULLS FIRST, a.agent_sk) AS band
              FROM dim_agent a JOIN d USING (agent_sk) LEFT JOIN n USING (agent_id)
              WHERE a.is_current AND a.status = 'ACTIVE')
        SELECT agent_sk, agent_id, full_name, site_code, adherence_90d, notice_events,
               CASE WHEN band = 1 OR notice_events > 0 THEN 'HIGH' WHEN band = 2 THEN 'MEDIUM' ELSE 'LOW' END AS attrition_risk
        FROM b"""),
    "queue_sla_attainment": over("fact_queue_interval dim_queue stg_crm_sla_target", """
        WITH g AS (SELECT q.queue_code, q.media_type, f.date_key,
                          CAST(sum(answered_in_sl) AS DOUBLE) / nullif(sum(answered), 0) * 100 AS sl_pct,
                          max(t.target_value) AS sl_target
                   FROM fact_queue_interval f JOIN dim_queue q USING (queue_sk)
                   LEFT JOIN stg_crm_sla_target t ON t.queue_id = q.queue_id AND t.metric_code = 'SL_20_80'
                   GROUP BY 1, 2, 3)
        SELECT *, CASE WHEN sl_pct >= sl_target THEN 'MET' ELSE 'MISSED' END AS attainment FROM g"""),
    "first_contact_resolution": over("fact_interaction", f"""
        WITH w AS ({_FOLLOWERS})
        SELECT date_key, program_sk, CAST(sum(greatest(followers, 1)) AS BIGINT) AS resolved_interactions,
               count(*) FILTER (WHERE followers = 0) AS fcr_count,
               count(*) FILTER (WHERE followers = 0) / CAST(sum(greatest(followers, 1)) AS DOUBLE) * 100 AS fcr_pct
        FROM w WHERE resolved_flag GROUP BY 1, 2"""),
    "occupancy": over("fact_agent_activity dim_agent", """
        WITH g AS (SELECT date_key, site_code, agent_sk,
                CAST(coalesce(sum(state_seconds) FILTER (WHERE state_code IN ('TALK', 'HOLD', 'ACW')), 0) AS BIGINT) AS handle_seconds,
                CAST(coalesce(sum(state_seconds) FILTER (WHERE state_code = 'READY'), 0) AS BIGINT) AS ready_seconds,
                CAST(coalesce(sum(state_seconds) FILTER (WHERE state_code LIKE 'AUX%'), 0) AS BIGINT) AS aux_seconds
            FROM fact_agent_activity JOIN dim_agent USING (agent_sk) GROUP BY ALL)
        SELECT *, handle_seconds / nullif(handle_seconds + ready_seconds, 0) * 100 AS occupancy_pct FROM g"""),
    "shrinkage": over("fact_adherence_daily dim_agent ods_schedule dim_shift", """
        SELECT f.date_key, a.site_code, CAST(sum(scheduled_minutes) AS BIGINT) AS scheduled_minutes,
               CAST(sum(worked_minutes) AS BIGINT) AS worked_minutes,
               CAST(sum(exception_minutes + timeoff_minutes) AS BIGINT) AS shrinkage_minutes,
               CAST(sum(exception_minutes + timeoff_minutes) AS DOUBLE) / nullif(sum(scheduled_minutes), 0) * 100 AS shrinkage_pct,
               count(DISTINCT s.schedule_id) AS schedules, count(DISTINCT h.shift_sk) AS overnight_shifts
        FROM fact_adherence_daily f JOIN dim_agent a USING (agent_sk)
        LEFT JOIN ods_schedule s ON s.agent_id = a.agent_id AND s.sched_date = strptime(CAST(f.date_key AS VARCHAR), '%Y%m%d')
        LEFT JOIN dim_shift h ON h.shift_id = s.shift_id AND h.overnight_flag
        GROUP BY 1, 2"""),
    "shrinkage_dedup": over("fact_adherence_daily dim_agent ods_schedule dim_shift", """
        WITH m AS (SELECT date_key, site_code, CAST(sum(scheduled_minutes) AS BIGINT) AS scheduled_minutes,
                          CAST(sum(worked_minutes) AS BIGINT) AS worked_minutes,
                          CAST(sum(exception_minutes + timeoff_minutes) AS BIGINT) AS shrinkage_minutes
                   FROM fact_adherence_daily JOIN dim_agent USING (agent_sk) GROUP BY 1, 2),
        p AS (SELECT DISTINCT date_key, site_code, agent_id FROM fact_adherence_daily JOIN dim_agent USING (agent_sk)),
        c AS (SELECT date_key, site_code, count(DISTINCT s.schedule_id) AS schedules, count(DISTINCT h.shift_sk) AS overnight_shifts
              FROM p LEFT JOIN ods_schedule s ON s.agent_id = p.agent_id AND s.sched_date = strptime(CAST(date_key AS VARCHAR), '%Y%m%d')
              LEFT JOIN dim_shift h ON h.shift_id = s.shift_id AND h.overnight_flag GROUP BY 1, 2)
        SELECT m.*, CAST(shrinkage_minutes AS DOUBLE) / nullif(scheduled_minutes, 0) * 100 AS shrinkage_pct, schedules, overnight_shifts
        FROM m JOIN c ON m.date_key = c.date_key AND m.site_code = c.site_code"""),
    "program_margin": over("agg_billing_monthly ods_timesheet ods_payroll_adjustment ods_contract_line", """
        WITH l AS (SELECT program_id, work_month, CAST(sum(billable_minutes) AS BIGINT) AS minutes FROM ods_timesheet GROUP BY 1, 2),
        j AS (SELECT period_month, sum(amount) AS total FROM ods_payroll_adjustment GROUP BY 1),
        c AS (SELECT CAST(sum(min_commit) AS BIGINT) AS committed_min FROM ods_contract_line)
        SELECT b.period_month, client_sk, b.program_sk, CAST(billed_amount AS DOUBLE) AS billed_amount,
               CAST(net_revenue AS DOUBLE) AS net_revenue,
               minutes / CAST(60.0 AS DOUBLE) * CAST(18.5 AS DOUBLE) AS est_labor_cost,
               CAST(j.total AS DOUBLE) AS total_adjustments,
               CAST(net_revenue AS DOUBLE) - minutes / CAST(60.0 AS DOUBLE) * CAST(18.5 AS DOUBLE)
                 - coalesce(CAST(j.total AS DOUBLE), 0) AS est_margin,
               c.committed_min
        FROM agg_billing_monthly b LEFT JOIN l ON l.work_month = CAST(concat(b.period_month, '-01') AS DATE)
        LEFT JOIN j ON j.period_month = b.period_month CROSS JOIN c"""),
    "client_summary": over("dim_client dim_program agg_program_monthly agg_csat_rollup_monthly agg_billing_monthly fact_ticket", """
        WITH k AS (SELECT program_sk, count(*) FILTER (WHERE status IN ('OPEN', 'PENDING')) AS open_tickets,
                          count(*) FILTER (WHERE sla_breached_flag) AS sla_breached_tickets FROM fact_ticket GROUP BY 1)
        SELECT client_code, client_name, m.period_month, program_code, interactions, avg_handle_seconds, avg_csat,
               pct_promoters, pct_detractors, CAST(billed_amount AS DOUBLE) AS billed_amount,
               CAST(sla_credit_amount AS DOUBLE) AS sla_credit_amount, CAST(net_revenue AS DOUBLE) AS net_revenue,
               open_tickets, sla_breached_tickets
        FROM agg_program_monthly m JOIN dim_program p ON p.program_sk = m.program_sk JOIN dim_client c ON c.client_id = p.client_id
        LEFT JOIN agg_csat_rollup_monthly s ON s.program_sk = m.program_sk AND s.period_month = m.period_month
        LEFT JOIN agg_billing_monthly b ON b.program_sk = m.program_sk AND b.period_month = m.period_month
        LEFT JOIN k ON k.program_sk = m.program_sk WHERE m.grouping_level = 0"""),
}
