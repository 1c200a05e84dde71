"""Source tables of the mart and validation queries, derived from whole given tables.

Each is one SELECT in the common part of Spark SQL and ANSI SQL, with the given tables as
``{name}``; ``@MS(x)`` stands for the epoch milliseconds of a timestamp.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

GIVEN = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()

_DATE_KEY = "CAST(year({0}) * 10000 + month({0}) * 100 + day({0}) AS INT)"
_MONTH_KEY = "CAST(year({0}) * 100 + month({0}) AS INT)"
_MONTH_TEXT = "concat(CAST(year({0}) AS STRING), '-', lpad(CAST(month({0}) AS STRING), 2, '0'))"

SOURCES = {
    # contact-centre tables
    "ods_org_unit": """
        SELECT p_partkey AS org_unit_id,
               CASE WHEN p_partkey % 97 = 0 THEN NULL ELSE CAST(floor(p_partkey / 3) AS BIGINT) END AS parent_unit_id,
               concat('U', CAST(p_partkey AS STRING)) AS unit_code, p_name AS unit_name, p_type AS unit_type,
               p_brand AS site_code
        FROM {part}""",
    "org_links": """
        SELECT p_partkey AS unit_id,
               CASE WHEN p_partkey % 700 = 1 THEN NULL WHEN p_partkey % 700 = 300 THEN -p_partkey
                    WHEN p_partkey % 700 = 500 THEN p_partkey + 40 ELSE p_partkey - 1 END AS parent_id
        FROM {part}""",
    "fact_interaction": f"""
        SELECT event_id AS interaction_id, user_id % 100 AS agent_sk, event_type AS channel,
               CASE WHEN user_id % 41 = 0 THEN NULL ELSE concat('C', CAST(user_id AS STRING)) END AS customer_ref,
               {_DATE_KEY.format('ts')} AS date_key, event_id % 7 AS program_sk,
               ts AS start_ts, ts + INTERVAL 20 MINUTE AS end_ts, event_id % 3 <> 0 AS resolved_flag
        FROM {{events}}""",
    "dim_agent": """
        SELECT s_suppkey AS agent_sk, s_suppkey + 1000 AS agent_id, s_name AS full_name,
               concat('SITE', CAST(s_nationkey AS STRING)) AS site_code,
               CASE WHEN s_suppkey % 3 = 0 THEN 'SENIOR' ELSE 'JUNIOR' END AS job_grade,
               s_suppkey % 9 <> 0 AS is_current,
               CASE WHEN s_suppkey % 5 = 0 THEN 'LEFT' ELSE 'ACTIVE' END AS status
        FROM {supplier}""",
    "fact_csat_survey": """
        SELECT o_orderkey AS survey_id, o_custkey % 25 AS program_sk, 1 + o_orderkey % 5 AS csat_score,
               CASE WHEN o_orderkey % 13 = 0 THEN NULL ELSE o_orderkey % 11 END AS nps_score
        FROM {orders}""",
    "dim_program": """
        SELECT n_nationkey AS program_sk, n_regionkey AS client_id, n_name AS program_code FROM {nation}""",
    "ods_call": """
        SELECT CAST(date_trunc('month', l_shipdate) AS DATE) AS call_date, l_suppkey % 10 AS queue_id,
               l_partkey AS disposition_code, CAST(l_quantity AS BIGINT) AS talk_seconds
        FROM {lineitem}""",
    "dim_disposition": """
        SELECT p_partkey AS disposition_code,
               CASE p_partkey % 8
                    WHEN 0 THEN concat('Billing query ref#', CAST(p_partkey % 5 AS STRING))
                    WHEN 1 THEN concat('PASSWORD reset ', p_name)
                    WHEN 2 THEN '[TECH] line down'
                    WHEN 3 THEN concat('Retention offer ref#', CAST(p_partkey % 3 AS STRING))
                    WHEN 4 THEN concat('[NET] ', p_name)
                    WHEN 5 THEN 'refund of an Invoice'
                    WHEN 6 THEN NULL
                    ELSE p_name END AS disposition_desc
        FROM {part}""",
    "ods_interaction": """
        SELECT event_id AS interaction_id,
               CASE WHEN user_id % 17 = 0 THEN '' WHEN user_id % 19 = 0 THEN NULL
                    ELSE concat('C', CAST(user_id AS STRING)) END AS customer_ref,
               event_type AS channel, ts AS start_ts
        FROM {events}""",
    "stg_fin_invoice": """
        SELECT o_orderkey AS invoice_id, concat('INV-', CAST(o_orderkey * 7 + 3 AS STRING)) AS invoice_no,
               CAST(o_totalprice AS DECIMAL(12,2)) AS total_amount,
               @MS(o_orderdate) AS issued_ts_sec
        FROM {orders}""",
    "ods_invoice_acid": """
        SELECT o_orderkey AS invoice_id,
               CAST(o_totalprice AS DECIMAL(12,2))
                 + CASE WHEN o_orderkey % 101 = 0 THEN 0.02 WHEN o_orderkey % 103 = 0 THEN 0.01 ELSE 0.00 END
                 AS total_amount,
               CASE WHEN o_orderkey % 53 = 0 THEN o_orderdate + INTERVAL 90 SECOND ELSE o_orderdate END AS issued_ts
        FROM {orders}""",
    "ods_agent_scd2": """
        SELECT event_id AS agent_history_id, user_id AS agent_id, concat('E', CAST(user_id AS STRING)) AS employee_no,
               user_id % 30 AS org_unit_id, event_type AS job_grade,
               CASE WHEN user_id % 2 = 0 THEN 'FULL' ELSE 'PART' END AS employment_type,
               CASE WHEN event_type = 'error' THEN 'LEAVE' ELSE 'ACTIVE' END AS status, ts AS eff_from_ts
        FROM {events}""",
    "ods_agent_assignment_scd2": """
        SELECT p_partkey % 120 AS agent_id, p_size AS program_id, p_partkey % 10 AS queue_id,
               p_type AS role_on_program, p_size % 17 = 0 AS is_current
        FROM {part}""",
    "agg_agent_daily": """
        SELECT l_suppkey AS agent_sk, CAST(l_quantity AS BIGINT) AS avg_handle_seconds,
               CAST(round(l_discount * 100) AS BIGINT) AS adherence_pct, l_linenumber AS interactions_handled
        FROM {lineitem}""",
    "fact_qa_evaluation": """
        SELECT o_custkey % 90 AS agent_sk, o_orderkey % 101 AS overall_pct FROM {orders}""",
    "ods_agent_skill_scd2": """
        SELECT p_partkey % 80 + 1000 AS agent_id, p_size % 2 = 0 AS is_current, p_size % 3 <> 0 AS certified
        FROM {part}""",
    "fact_adherence_daily": f"""
        SELECT l_suppkey AS agent_sk, {_DATE_KEY.format('l_shipdate')} AS date_key,
               CAST(round(l_discount * 100) AS BIGINT) AS adherence_pct,
               CAST(l_quantity AS BIGINT) * 10 AS scheduled_minutes, CAST(l_quantity AS BIGINT) * 8 AS worked_minutes,
               l_linenumber AS exception_minutes, CAST(round(l_tax * 100) AS BIGINT) AS timeoff_minutes
        FROM {{lineitem}}""",
    "ods_attrition_event": """
        SELECT c_custkey - c_custkey % 3 + 1000 AS agent_id, c_mktsegment AS reason FROM {customer}""",
    "fact_queue_interval": f"""
        SELECT l_suppkey % 40 AS queue_sk, {_MONTH_KEY.format('l_shipdate')} AS date_key,
               l_linenumber AS answered_in_sl,
               CASE WHEN l_suppkey % 40 = 7 THEN 0 ELSE CAST(l_quantity AS BIGINT) END AS answered
        FROM {{lineitem}}""",
    "dim_queue": """
        SELECT n_nationkey AS queue_sk, n_nationkey % 12 AS queue_id,
               concat('Q', CAST(n_nationkey % 8 AS STRING)) AS queue_code,
               CASE WHEN n_nationkey % 2 = 0 THEN 'VOICE' ELSE 'CHAT' END AS media_type
        FROM {nation}""",
    "stg_crm_sla_target": """
        SELECT p_partkey % 9 AS queue_id, CASE WHEN p_size % 2 = 0 THEN 'SL_20_80' ELSE 'ASA' END AS metric_code,
               p_size % 20 AS target_value
        FROM {part}""",
    "fact_agent_activity": f"""
        SELECT l_suppkey AS agent_sk, {_MONTH_KEY.format('l_shipdate')} AS date_key,
               CASE l_linenumber WHEN 1 THEN 'TALK' WHEN 2 THEN 'HOLD' WHEN 3 THEN 'ACW' WHEN 4 THEN 'READY'
                    WHEN 5 THEN 'AUX1' ELSE 'AUX_BREAK' END AS state_code,
               CAST(l_quantity AS BIGINT) * 60 AS state_seconds
        FROM {{lineitem}}""",
    "ods_schedule": """
        SELECT o_orderkey AS schedule_id, o_custkey % 100 + 1000 AS agent_id,
               CAST(o_orderdate AS DATE) AS sched_date, o_orderkey % 12 AS shift_id
        FROM {orders}""",
    "dim_shift": """
        SELECT n_nationkey AS shift_sk, n_nationkey % 15 AS shift_id, n_nationkey % 2 = 0 AS overnight_flag
        FROM {nation}""",
    "agg_billing_monthly": f"""
        SELECT {_MONTH_TEXT.format('o_orderdate')} AS period_month, o_custkey % 25 AS program_sk,
               o_custkey % 5 AS client_sk,
               CAST(sum(CAST(o_totalprice AS DECIMAL(12,2))) AS DECIMAL(18,2)) AS billed_amount,
               CAST(sum(CAST(o_orderkey % 50 AS DECIMAL(12,2))) AS DECIMAL(18,2)) AS sla_credit_amount,
               CAST(sum(CAST(o_totalprice AS DECIMAL(12,2)) - CAST(o_orderkey % 50 AS DECIMAL(12,2)))
                    AS DECIMAL(18,2)) AS net_revenue
        FROM {{orders}} GROUP BY 1, 2, 3""",
    "ods_timesheet": """
        SELECT l_suppkey % 25 AS program_id, CAST(date_trunc('month', l_shipdate) AS DATE) AS work_month,
               CAST(l_quantity AS BIGINT) AS billable_minutes
        FROM {lineitem}""",
    "ods_payroll_adjustment": f"""
        SELECT {_MONTH_TEXT.format('o_orderdate')} AS period_month, CAST(o_orderkey % 100 AS DECIMAL(12,2)) AS amount
        FROM {{orders}} WHERE month(o_orderdate) <> 2""",
    "ods_contract_line": """
        SELECT p_partkey AS line_id, p_size AS min_commit FROM {part}""",
    "dim_client": """
        SELECT r_regionkey AS client_id, concat('CL', CAST(r_regionkey AS STRING)) AS client_code,
               r_name AS client_name
        FROM {region}""",
    "agg_program_monthly": f"""
        SELECT l_suppkey % 25 AS program_sk, {_MONTH_TEXT.format('l_shipdate')} AS period_month,
               count(*) AS interactions, avg(CAST(l_quantity AS BIGINT)) AS avg_handle_seconds,
               avg(l_linenumber) AS avg_csat, CASE WHEN l_suppkey % 25 = 24 THEN 1 ELSE 0 END AS grouping_level
        FROM {{lineitem}} GROUP BY 1, 2, 6""",
    "agg_csat_rollup_monthly": f"""
        SELECT o_custkey % 23 AS program_sk, {_MONTH_TEXT.format('o_orderdate')} AS period_month,
               sum(CASE WHEN o_orderkey % 11 >= 9 THEN 1 ELSE 0 END) / count(*) * 100 AS pct_promoters,
               sum(CASE WHEN o_orderkey % 11 <= 6 THEN 1 ELSE 0 END) / count(*) * 100 AS pct_detractors
        FROM {{orders}} GROUP BY 1, 2""",
    "fact_ticket": """
        SELECT o_custkey % 20 AS program_sk,
               CASE o_orderstatus WHEN 'O' THEN 'OPEN' WHEN 'P' THEN 'PENDING' ELSE 'CLOSED' END AS status,
               o_orderkey % 7 = 0 AS sla_breached_flag
        FROM {orders}""",
    # migrated copies with planted faults
    "orders_target": """
        SELECT o_orderkey, o_custkey, o_orderstatus,
               CASE WHEN o_orderkey % 997 = 0 THEN o_totalprice + CAST(0.01 AS DOUBLE) ELSE o_totalprice END
                 AS o_totalprice,
               o_orderdate, o_orderpriority
        FROM {orders} WHERE o_orderkey % 1009 <> 1
        UNION ALL
        SELECT -1 - o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority
        FROM {orders} WHERE o_orderkey % 2003 = 5""",
    "lineitem_target": """
        SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax,
               CASE WHEN l_partkey % 499 = 0 THEN 'X' ELSE l_returnflag END AS l_returnflag, l_linestatus,
               CASE WHEN l_suppkey % 50 = 3 THEN l_shipdate + INTERVAL 1 SECOND ELSE l_shipdate END AS l_shipdate
        FROM {lineitem} WHERE l_orderkey % 701 <> 0""",
    "money_source": """
        SELECT l_orderkey, l_partkey, l_returnflag, l_shipdate, CAST(l_extendedprice AS DECIMAL(12,2)) AS price
        FROM {lineitem}""",
    "money_target": """
        SELECT l_orderkey, l_partkey, CASE WHEN l_partkey % 499 = 0 THEN NULL ELSE l_returnflag END AS l_returnflag,
               l_shipdate + INTERVAL 1 SECOND AS l_shipdate,
               CAST(CAST(l_extendedprice AS DECIMAL(12,2))
                    + CASE WHEN l_partkey % 499 = 0 THEN 0.01 ELSE 0.00 END AS DECIMAL(14,2)) AS price
        FROM {lineitem}""",
    "epoch_source": """
        SELECT event_id,
               CASE WHEN event_id % 211 = 0 THEN 99999999999999999 WHEN event_id % 223 = 0 THEN -5
                    WHEN event_id % 227 = 0 THEN NULL WHEN event_id % 229 = 0 THEN 1000 ELSE @MS(ts) END AS raw
        FROM {events}""",
    "epoch_target": """
        SELECT event_id,
               CASE WHEN event_id % 422 = 0 THEN ts WHEN event_id % 211 = 0 OR event_id % 223 = 0 THEN NULL
                    WHEN event_id % 454 = 0 THEN ts WHEN event_id % 227 = 0 THEN NULL
                    WHEN event_id % 301 = 0 THEN ts + INTERVAL 1 HOUR ELSE ts END AS converted_ts
        FROM {events}
        UNION ALL SELECT -1 - event_id, ts FROM {events} WHERE event_id % 997 = 1
        UNION ALL SELECT event_id, ts FROM {events} WHERE event_id % 991 = 2""",
    "epoch_audit": """
        SELECT 'epoch_source' AS src_table, event_id AS row_id FROM {events}
        WHERE event_id % 211 = 0 OR event_id % 223 = 0""",
    "balance_source": """
        SELECT c_custkey, CAST(c_acctbal AS DECIMAL(12,2)) AS balance,
               CASE WHEN c_custkey % 50 = 0 THEN 'n/a' ELSE CAST(CAST(c_acctbal AS DECIMAL(12,2)) AS STRING) END
                 AS balance_text
        FROM {customer}""",
    "balance_target": """
        SELECT c_custkey,
               CAST(CAST(c_acctbal AS DECIMAL(12,2)) + CASE WHEN c_custkey % 31 = 0 THEN 0.01 ELSE 0.00 END
                    AS DECIMAL(16,4)) AS balance,
               CASE WHEN c_custkey % 100 = 0 THEN 'none' WHEN c_custkey % 50 = 0 THEN 'n/a'
                    ELSE CAST(CAST(CAST(c_acctbal AS DECIMAL(12,2)) AS DECIMAL(16,4)) AS STRING) END AS balance_text
        FROM {customer} WHERE c_custkey % 97 <> 5""",
    "customer_hashed": """
        SELECT c_custkey, c_name, c_mktsegment,
               CASE WHEN c_custkey % 37 = 0 THEN md5(c_name)
                    ELSE md5(concat(CAST(c_custkey AS STRING), '|', c_name, '|', c_mktsegment)) END AS row_hash
        FROM {customer}""",
    "order_patch": """
        SELECT o_orderkey, o_custkey, 'X' AS o_orderstatus, o_totalprice + CAST(1 AS DOUBLE) AS o_totalprice, o_orderdate,
               o_orderpriority, CASE WHEN o_orderkey % 5 = 0 THEN 'D' ELSE 'U' END AS op
        FROM {orders} WHERE o_orderkey BETWEEN 100 AND 140
        UNION ALL
        SELECT -1 - o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority, 'I'
        FROM {orders} WHERE o_orderkey % 500 = 7""",
    "order_delta": """
        SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority, 'D' AS op
        FROM {orders} WHERE o_orderkey % 10 = 3
        UNION ALL
        SELECT o_orderkey, o_custkey, 'X', o_totalprice + CAST(1 AS DOUBLE), o_orderdate, o_orderpriority, 'U'
        FROM {orders} WHERE o_orderkey % 10 = 5
        UNION ALL
        SELECT -1 - o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority,
               CASE WHEN o_orderkey % 20 = 7 THEN 'I' ELSE 'D' END
        FROM {orders} WHERE o_orderkey % 10 = 7""",
    "user_state": """
        SELECT DISTINCT user_id + 3 AS user_id, 'start' AS event_type, CAST(0 AS DOUBLE) AS value FROM {events}""",
    "user_changes": """
        SELECT user_id, event_type, value, ts AS changed_at, event_id,
               CASE WHEN event_type = 'error' THEN 'D' ELSE 'U' END AS op
        FROM {events}""",
    "customer_kept": """
        SELECT c_custkey, c_name FROM {customer} WHERE c_custkey % 10 <> 0""",
    "metric_runs": """
        SELECT event_type AS query_id, CASE WHEN event_id % 2 = 0 THEN 'a' ELSE 'b' END AS side,
               'value' AS metric, value FROM {events}
        UNION ALL
        SELECT event_type, CASE WHEN event_id % 2 = 0 THEN 'a' ELSE 'b' END, 'user', CAST(user_id AS DOUBLE)
        FROM {events}""",
    "metric_baseline": """
        SELECT event_type AS query_id, 'value' AS metric,
               CASE WHEN event_type = 'click' THEN max(value) / 4 ELSE max(value) END AS value
        FROM {events} WHERE event_type <> 'view' GROUP BY event_type""",
    "raw_events": """
        SELECT event_id, CAST(user_id AS STRING) AS user_text,
               CASE WHEN event_id % 71 = 0 THEN 'oops' ELSE CAST(CAST(value AS DECIMAL(10,3)) AS STRING) END AS value_text,
               CASE WHEN event_id % 89 = 0 THEN NULL ELSE event_type END AS event_type,
               CAST(@MS(ts) AS BIGINT) AS ts_ms,
               concat(CAST(year(ts) AS STRING), lpad(CAST(month(ts) AS STRING), 2, '0'),
                      CASE WHEN event_id % 83 = 0 THEN '99' ELSE lpad(CAST(day(ts) AS STRING), 2, '0') END) AS day_text,
               props
        FROM {events}""",
    "digit_amounts": """
        SELECT CASE WHEN event_id % 50 = 0 THEN 'none' WHEN event_id % 51 = 0 THEN NULL
                    ELSE concat(CASE WHEN event_id % 3 = 0 THEN '-' ELSE '' END, CAST(event_id AS STRING), '.',
                                lpad(CAST(event_id AS STRING), 20, '0')) END AS amount
        FROM {events}""",
    "raw_invoices": """
        SELECT o_orderkey AS invoice_id, @MS(o_orderdate) AS issued_ms, CAST(o_totalprice AS DECIMAL(12,2)) AS amount,
               CASE o_orderstatus WHEN 'F' THEN 'i' WHEN 'O' THEN 'U' ELSE 'D' END AS op
        FROM {orders}""",
    "elt_staging": """
        SELECT event_id AS id, event_type AS channel, CAST(value AS DECIMAL(12,2)) AS amount, ts AS event_ts,
               CASE WHEN event_id % 4 = 0 THEN 'void' ELSE 'raw' END AS status
        FROM {events}""",
}


def spark_text(sql: str) -> str:
    return re.sub(r"@MS\((\w+)\)", r"unix_millis(CAST(\1 AS TIMESTAMP))", sql)


def ansi_text(sql: str) -> str:
    named = re.sub(r"\{(\w+)\}", r"\1", sql)
    return re.sub(r"@MS\((\w+)\)", r"(epoch_us(\1) // 1000)", named)


def given(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def source(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A given table, or a table derived from given ones."""
    if name in GIVEN:
        return given(spark, folder, name)
    sql = spark_text(SOURCES[name])
    used = set(re.findall(r"\{(\w+)\}", sql))
    return spark.sql(sql, **{t: given(spark, folder, t) for t in used})


def as_ctes(*names: str) -> str:
    """The derived tables as a list of common table expressions."""
    return ", ".join(f"{n} AS ({ansi_text(SOURCES[n]).strip()})" for n in names)
