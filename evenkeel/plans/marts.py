"""The contact-centre mart queries.

Facts are folded to their join key before they meet a dimension, so a hot key travels as one
row per task, and regular expressions run once per dimension row. Windows over a whole result
use the distributed ranking of ``operators.ranking``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from evenkeel.functions.scalars import date_key, epoch_seconds, epoch_to_timestamp, floor_millis, percent, regex_group
from evenkeel.operators.hierarchy import descend
from evenkeel.operators.intervals import followers_within
from evenkeel.operators.ordered import ROWS_PER_CHUNK, find_cuts, latest_per_key, with_previous
from evenkeel.operators.ranking import ntile, with_percent_rank, with_row_number

# The labels, patterns and limits of the call-driver and contact rules.
DRIVER_PATTERNS = (
    ("BILLING", r"(?i)(bill|invoice|charge|refund)"),
    ("ACCESS", r"(?i)(password|login|locked|reset)"),
    ("RETENTION", r"(?i)(cancel|churn|retention)"),
)
TAG_PATTERN = r"^\[([A-Z]{2,5})\]"
REFERENCE_PATTERN = r"ref#(\d+)"
REPEAT_SECONDS = 259_200
FOLLOW_UP_DAYS = 7
SLA_METRIC = "SL_20_80"
HANDLING_STATES = ("TALK", "HOLD", "ACW")
LABOUR_RATE_PER_HOUR = 18.5


def org_hierarchy(org_units: DataFrame) -> DataFrame:
    tree = descend(
        org_units,
        "org_unit_id",
        "parent_unit_id",
        "unit_name",
        max_depth=6,
        keep=["unit_code", "unit_name", "unit_type", "site_code"],
    )
    return tree.withColumnsRenamed({"root_id": "root_unit_id", "path": "path_names"})


def active_agents(interactions: DataFrame, agents: DataFrame, rsd: float = 0.01) -> DataFrame:
    """Approximate agents and agent/channel pairs per day and site: judge by tolerance."""
    pair = F.concat_ws("|", F.col("agent_sk").cast("string"), F.col("channel"))
    # distinct (day, agent, channel) with its count carries all that the site level needs
    folded = interactions.groupBy("date_key", "agent_sk", "channel").agg(F.count(F.lit(1)).alias("n"))
    placed = folded.join(agents.select("agent_sk", "site_code"), "agent_sk")
    return placed.groupBy("date_key", "site_code").agg(
        F.approx_count_distinct("agent_sk", rsd).alias("approx_active_agents"),
        F.approx_count_distinct(F.when(F.col("channel").isNotNull(), pair), rsd).alias("approx_agent_channel_pairs"),
        F.sum("n").alias("interactions"),
    )


def csat_rollup(surveys: DataFrame, programs: DataFrame) -> DataFrame:
    folded = surveys.groupBy("program_sk").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("csat_score").alias("csat"),
        F.count("csat_score").alias("scored"),
        F.count_if(F.col("nps_score") >= 9).alias("promoters"),
    )
    joined = folded.join(programs.select("program_sk", "client_id", "program_code"), "program_sk")
    return joined.rollup("client_id", "program_code").agg(
        F.sum("n").alias("surveys"),
        F.try_divide(F.sum("csat").cast("double"), F.sum("scored")).alias("avg_csat"),
        percent(F.sum("promoters"), F.sum("n")).alias("pct_promoters"),
        F.grouping_id().cast("int").alias("grouping_level"),
    )


def call_driver(description: Column) -> Column:
    """First pattern that matches, else the bracketed tag, else OTHER."""
    tag = regex_group(description, TAG_PATTERN)
    first, *rest = DRIVER_PATTERNS
    label = F.when(description.rlike(first[1]), first[0])
    for name, pattern in rest:
        label = label.when(description.rlike(pattern), name)
    return label.otherwise(F.coalesce(tag, F.lit("OTHER")))


def call_drivers(calls: DataFrame, dispositions: DataFrame) -> DataFrame:
    folded = calls.groupBy("call_date", "queue_id", "disposition_code").agg(
        F.count(F.lit(1)).alias("n"), F.sum("talk_seconds").alias("talk"), F.count("talk_seconds").alias("timed")
    )
    text = F.col("disposition_desc")
    labelled = dispositions.select(
        "disposition_code",
        call_driver(text).alias("call_driver"),
        regex_group(text, REFERENCE_PATTERN).alias("embedded_ref_no"),
    )
    joined = folded.join(labelled, "disposition_code")
    return joined.groupBy("call_date", "queue_id", "call_driver", "embedded_ref_no").agg(
        F.sum("n").alias("calls"), F.try_divide(F.sum("talk").cast("double"), F.sum("timed")).alias("avg_talk_seconds")
    )


def repeat_contacts(interactions: DataFrame, rows_per_chunk: int = ROWS_PER_CHUNK) -> DataFrame:
    """Contacts within 72 hours of the customer's previous one; ties ordered by interaction."""
    known = interactions.where(F.col("customer_ref").isNotNull() & (F.col("customer_ref") != ""))
    rows = known.select("interaction_id", "customer_ref", "channel", "start_ts")
    order = ["start_ts", "interaction_id"]
    cuts = find_cuts(rows, ["customer_ref"], order, rows_per_chunk)
    stepped = with_previous(rows, ["customer_ref"], order, {"prev_contact_ts": "start_ts"}, cuts)
    gap = epoch_seconds(F.col("start_ts")) - epoch_seconds(F.col("prev_contact_ts"))
    return stepped.withColumn("repeat_within_72h", F.when(gap <= REPEAT_SECONDS, 1).otherwise(0))


def billing_reconciliation(staged: DataFrame, invoices: DataFrame) -> DataFrame:
    s = staged.select("invoice_id", "invoice_no", F.col("total_amount").alias("staged_amount"), "issued_ts_sec")
    a = invoices.select("invoice_id", F.col("total_amount").alias("ods_amount"), F.col("issued_ts").alias("ods_issued_ts"))
    joined = s.join(a, "invoice_id")
    drift = epoch_seconds(F.col("ods_issued_ts")) - floor_millis(F.col("issued_ts_sec"))
    status = (
        F.when(F.abs(F.col("staged_amount") - F.col("ods_amount")) > F.lit("0.01").cast("decimal(3,2)"), "AMOUNT_MISMATCH")
        .when(drift != 0, "TS_MISMATCH")
        .otherwise("OK")
    )
    return joined.select(
        "invoice_no",
        "staged_amount",
        "ods_amount",
        epoch_to_timestamp(F.col("issued_ts_sec"), "millis").alias("staged_issued_ts"),
        "ods_issued_ts",
        drift.alias("drift_seconds"),
        status.alias("recon_status"),
    )


def agent_roster(agent_versions: DataFrame, assignments: DataFrame) -> DataFrame:
    """Latest version of each agent with its current assignments; several give several rows."""
    columns = ["agent_id", "employee_no", "org_unit_id", "job_grade", "employment_type", "status", "eff_from_ts"]
    order = [F.col("eff_from_ts").desc_nulls_last()]
    if "agent_history_id" in agent_versions.columns:
        order.append(F.col("agent_history_id").desc_nulls_last())
    latest = latest_per_key(agent_versions, ["agent_id"], order).select(*columns)
    current = assignments.where("is_current").select(
        "agent_id",
        F.col("program_id").alias("current_program_id"),
        F.col("queue_id").alias("current_queue_id"),
        "role_on_program",
    )
    return latest.join(current, "agent_id", "left")


def agent_scorecard(
    agents: DataFrame, daily: DataFrame, evaluations: DataFrame, skills: DataFrame
) -> DataFrame:
    """Ranks run after the joins and the filter on current agents; ties ordered by agent."""
    performance = daily.groupBy("agent_sk").agg(
        F.avg("avg_handle_seconds").alias("aht"),
        F.avg("adherence_pct").alias("adherence"),
        F.sum("interactions_handled").alias("volume"),
    )
    quality = evaluations.groupBy("agent_sk").agg(F.avg("overall_pct").alias("avg_qa_pct"))
    certified = skills.where(F.col("is_current") & F.col("certified")).groupBy("agent_id").agg(
        F.count(F.lit(1)).alias("certified_skills")
    )
    current = agents.where("is_current").select("agent_sk", "agent_id", "full_name", "site_code", "job_grade")
    cards = (
        current.join(performance, "agent_sk")
        .join(quality, "agent_sk", "left")
        .join(certified, "agent_id", "left")
        .withColumn("certified_skills", F.coalesce("certified_skills", F.lit(0)))
        .drop("agent_id")
    )
    by_aht = with_row_number(cards, [F.col("aht").asc_nulls_first(), F.col("agent_sk").asc()], "n")
    ranked = with_percent_rank(by_aht, "aht", F.col("n"), F.col("n_of"), "aht_pctile").drop("n", "n_of")
    by_quality = with_row_number(ranked, [F.col("avg_qa_pct").desc_nulls_last(), F.col("agent_sk").asc()], "n")
    return by_quality.withColumn("qa_quartile", ntile(4, F.col("n"), F.col("n_of"))).drop("n", "n_of")


def attrition_risk(agents: DataFrame, adherence: DataFrame, events: DataFrame) -> DataFrame:
    """Weekly volume, which the view reads too, cannot change a row and is left out."""
    kept = adherence.groupBy("agent_sk").agg(F.avg("adherence_pct").alias("adherence_90d"))
    notices = events.groupBy("agent_id").agg(F.count(F.lit(1)).alias("notice_events"))
    active = agents.where(F.col("is_current") & (F.col("status") == "ACTIVE"))
    joined = (
        active.select("agent_sk", "agent_id", "full_name", "site_code")
        .join(kept, "agent_sk")
        .join(notices, "agent_id", "left")
        .withColumn("notice_events", F.coalesce("notice_events", F.lit(0)))
    )
    placed = with_row_number(joined, [F.col("adherence_90d").asc_nulls_first(), F.col("agent_sk").asc()], "n")
    band = ntile(5, F.col("n"), F.col("n_of"))
    risk = F.when((band == 1) | (F.col("notice_events") > 0), "HIGH").when(band == 2, "MEDIUM").otherwise("LOW")
    return placed.select(
        "agent_sk", "agent_id", "full_name", "site_code", "adherence_90d", "notice_events", risk.alias("attrition_risk")
    )


def queue_sla_attainment(intervals: DataFrame, queues: DataFrame, targets: DataFrame) -> DataFrame:
    """A queue with several targets weighs that many times, as the plain join would have it."""
    folded = intervals.groupBy("queue_sk", "date_key").agg(
        F.sum("answered_in_sl").alias("in_sl"), F.sum("answered").alias("answered")
    )
    wanted = targets.where(F.col("metric_code") == SLA_METRIC).groupBy("queue_id").agg(
        F.max("target_value").alias("target"), F.count(F.lit(1)).alias("copies")
    )
    joined = folded.join(queues.select("queue_sk", "queue_id", "queue_code", "media_type"), "queue_sk").join(
        wanted, "queue_id", "left"
    )
    weight = F.coalesce("copies", F.lit(1))
    grouped = joined.groupBy("queue_code", "media_type", "date_key").agg(
        percent(F.sum(F.col("in_sl") * weight), F.sum(F.col("answered") * weight)).alias("sl_pct"),
        F.max("target").alias("sl_target"),
    )
    met = F.coalesce(F.col("sl_pct") >= F.col("sl_target"), F.lit(False))
    return grouped.withColumn("attainment", F.when(met, "MET").otherwise("MISSED"))


def first_contact_resolution(interactions: DataFrame, rows_per_chunk: int = ROWS_PER_CHUNK) -> DataFrame:
    """An interaction with k repeats within 7 days counts k times, one without counts once."""
    followed = followers_within(
        interactions,
        "interaction_id",
        "customer_ref",
        "start_ts",
        "end_ts",
        FOLLOW_UP_DAYS,
        keep=["date_key", "program_sk", "resolved_flag"],
        rows_per_chunk=rows_per_chunk,
    )
    alone = F.col("followers") == 0
    return followed.where("resolved_flag").groupBy("date_key", "program_sk").agg(
        F.sum(F.greatest("followers", F.lit(1))).alias("resolved_interactions"),
        F.count_if(alone).alias("fcr_count"),
        percent(F.count_if(alone), F.sum(F.greatest("followers", F.lit(1)))).alias("fcr_pct"),
    )


def occupancy(activity: DataFrame, agents: DataFrame) -> DataFrame:
    state, seconds = F.col("state_code"), F.col("state_seconds")

    def spent(condition: Column) -> Column:
        return F.sum(F.when(condition, seconds).otherwise(0))

    folded = activity.groupBy("date_key", "agent_sk").agg(
        spent(state.isin(*HANDLING_STATES)).alias("h"),
        spent(state == "READY").alias("r"),
        spent(state.like("AUX%")).alias("x"),
    )
    joined = folded.join(agents.select("agent_sk", "site_code"), "agent_sk")
    return joined.groupBy("date_key", "site_code", "agent_sk").agg(
        F.sum("h").alias("handle_seconds"),
        F.sum("r").alias("ready_seconds"),
        F.sum("x").alias("aux_seconds"),
        percent(F.sum("h"), F.sum("h") + F.sum("r")).alias("occupancy_pct"),
    )


def shrinkage(
    adherence: DataFrame,
    agents: DataFrame,
    schedules: DataFrame,
    shifts: DataFrame,
    dedup: bool = False,
) -> DataFrame:
    """Minutes lost per day and site. Several schedules of an agent and day inflate the sums, as
    in the view; with ``dedup`` they do not."""
    folded = adherence.groupBy("date_key", "agent_sk").agg(
        F.sum("scheduled_minutes").alias("scheduled"),
        F.sum("worked_minutes").alias("worked"),
        F.sum(F.col("exception_minutes") + F.col("timeoff_minutes")).alias("lost"),
    )
    base = folded.join(agents.select("agent_sk", "agent_id", "site_code"), "agent_sk")
    overnight = shifts.where("overnight_flag").select("shift_id", "shift_sk")
    day = date_key(F.col("sched_date")).alias("date_key")
    planned = schedules.select("agent_id", day, "schedule_id", "shift_id").join(overnight, "shift_id", "left")
    joined = base.join(planned, ["agent_id", "date_key"], "left")
    keys = ["date_key", "site_code"]
    sums = [
        F.sum("scheduled").alias("scheduled_minutes"),
        F.sum("worked").alias("worked_minutes"),
        F.sum("lost").alias("shrinkage_minutes"),
        percent(F.sum("lost"), F.sum("scheduled")).alias("shrinkage_pct"),
    ]
    distinct = [
        F.count_distinct("schedule_id").alias("schedules"),
        F.count_distinct("shift_sk").alias("overnight_shifts"),
    ]
    if not dedup:
        return joined.groupBy(*keys).agg(*sums, *distinct)
    return base.groupBy(*keys).agg(*sums).join(joined.groupBy(*keys).agg(*distinct), keys)


def program_margin(
    billing: DataFrame, timesheets: DataFrame, adjustments: DataFrame, contract_lines: DataFrame
) -> DataFrame:
    """Labour is per program and month but joined on the month alone, as in the view."""
    month = lambda c: F.date_trunc("month", F.col(c).try_cast("date")).cast("date")
    labour = timesheets.groupBy("program_id", month("work_month").alias("_month")).agg(
        F.sum("billable_minutes").alias("minutes")
    )
    adjusted = adjustments.groupBy(month("period_month").alias("_month")).agg(F.sum("amount").alias("total_adjustments"))
    committed = contract_lines.agg(F.sum("min_commit").alias("committed_min"))
    cost = F.col("minutes") / F.lit(60.0) * F.lit(LABOUR_RATE_PER_HOUR)
    adjustment = F.coalesce(F.col("total_adjustments"), F.lit(0)).cast("double")
    joined = (
        billing.withColumn("_month", month("period_month"))
        .join(labour.drop("program_id"), "_month", "left")
        .join(adjusted, "_month", "left")
    )
    return joined.select(
        "period_month",
        "client_sk",
        "program_sk",
        "billed_amount",
        "net_revenue",
        cost.alias("est_labor_cost"),
        "total_adjustments",
        (F.col("net_revenue").cast("double") - cost - adjustment).alias("est_margin"),
        committed.scalar().alias("committed_min"),
    )


def client_summary(
    clients: DataFrame,
    programs: DataFrame,
    program_months: DataFrame,
    csat_months: DataFrame,
    billing_months: DataFrame,
    tickets: DataFrame,
) -> DataFrame:
    open_now = F.col("status").isin("OPEN", "PENDING")
    by_program = tickets.groupBy("program_sk").agg(
        F.count_if(open_now).alias("open_tickets"),
        F.count_if(F.col("sla_breached_flag")).alias("sla_breached_tickets"),
    )
    months = program_months.where(F.col("grouping_level") == 0).select(
        "program_sk", "period_month", "interactions", "avg_handle_seconds", "avg_csat"
    )
    csat = csat_months.select("program_sk", "period_month", "pct_promoters", "pct_detractors")
    billing = billing_months.select("program_sk", "period_month", "billed_amount", "sla_credit_amount", "net_revenue")
    return (
        clients.select("client_id", "client_code", "client_name")
        .join(programs.select("client_id", "program_sk", "program_code"), "client_id")
        .join(months, "program_sk")
        .join(csat, ["program_sk", "period_month"], "left")
        .join(billing, ["program_sk", "period_month"], "left")
        .join(by_program, "program_sk", "left")
        .drop("client_id", "program_sk")
    )
