"""Jobs from staging to the operational layer and on to facts and aggregates."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from evenkeel.functions.canon import column
from evenkeel.functions.scalars import epoch_to_timestamp
from evenkeel.operators.merge import DELETE, apply_merge, latest_changes
from evenkeel.operators.ordered import ROWS_PER_CHUNK, find_cuts, with_running_sum


def invoices_from_raw(raw: DataFrame, epoch_column: str = "issued_ms", upper_case_op: bool = False) -> DataFrame:
    """Raw invoice changes without deletes, the epoch in milliseconds as a timestamp."""
    op = F.upper("op") if upper_case_op else F.col("op")
    rest = [c for c in raw.columns if c not in (epoch_column, "op")]
    kept = raw.withColumn("op", op).where(F.col("op") != DELETE)
    return kept.select(*rest, epoch_to_timestamp(F.col(epoch_column), "millis").alias("issued_ts"), "op")


def raw_to_mart(staging: DataFrame, status: str = "raw") -> DataFrame:
    """Rows in the given status, without the status."""
    return staging.where(F.col("status") == status).drop("status")


def apply_change_log(
    target: DataFrame, changes: DataFrame, keys: Sequence[str], changed_at: str, op: str = "op"
) -> DataFrame:
    """The newest change of each key merged into the target; ties go to the delete."""
    order = [column(changed_at).desc_nulls_last(), (column(op) == DELETE).desc()]
    newest = latest_changes(changes, keys, order)
    return apply_merge(target, newest, keys, op, check_unique=False)


def ivr_sessions(events: DataFrame, session: str, at: str, menu: str, exit_menus: Sequence[str]) -> DataFrame:
    """(session, first_event_ts, last_event_ts, hops, contained): a session that never reached
    one of ``exit_menus`` was contained."""
    left = column(menu).isin(*exit_menus)
    return events.groupBy(session).agg(
        F.min(at).alias("first_event_ts"),
        F.max(at).alias("last_event_ts"),
        F.count(F.lit(1)).alias("hops"),
        (F.count_if(left) == 0).alias("contained"),
    )


def ivr_path(
    events: DataFrame,
    session: str,
    at: str,
    menu: str,
    tie_break: str,
    rows_per_chunk: int = ROWS_PER_CHUNK,
) -> DataFrame:
    """(session, hop, menu): the path as numbered rows, so that no session has to fit in one value."""
    steps = events.select(session, at, tie_break, menu).withColumn("_one", F.lit(1))
    cuts = find_cuts(steps, [session], [at, tie_break], rows_per_chunk)
    numbered = with_running_sum(steps, [session], [at, tie_break], "_one", "hop", cuts)
    return numbered.select(session, "hop", menu)


def chat_counts(messages: DataFrame, chat: str, turn: str, role: str, agent_role: str = "assistant") -> DataFrame:
    """Message counts per chat and the turn of the first agent answer, from one row per message."""
    is_agent = column(role) == agent_role
    return messages.groupBy(chat).agg(
        F.count(F.lit(1)).alias("message_count"),
        F.count_if(is_agent).alias("agent_message_count"),
        F.count_if(~is_agent).alias("customer_message_count"),
        F.min(F.when(is_agent, column(turn))).alias("first_response_turn"),
    )


def chat_sessions(transcripts: DataFrame, messages: str = "messages", agent_sender: str = "agent") -> DataFrame:
    """Counts and seconds to the first agent answer from an array<struct<sender, ts, ...>> column."""
    said = column(messages)
    agent = F.filter(said, lambda m: m["sender"] == agent_sender)
    customer = F.filter(said, lambda m: m["sender"] != agent_sender)
    asked = F.array_min(F.transform(customer, lambda m: m["ts"]))
    answered = F.array_min(F.transform(F.filter(agent, lambda m: m["ts"] >= asked), lambda m: m["ts"]))
    return transcripts.select(
        *[column(c) for c in transcripts.columns if c != messages],
        F.size(said).alias("message_count"),
        F.size(agent).alias("agent_message_count"),
        F.size(customer).alias("customer_message_count"),
        (F.unix_seconds(answered.cast("timestamp")) - F.unix_seconds(asked.cast("timestamp"))).alias(
            "first_response_seconds"
        ),
    )


def section_totals(forms: DataFrame, sections: str, points: str, maximum: str) -> DataFrame:
    """Section count, points and percentage from an array of scored sections."""
    items = column(sections)
    zero = F.lit(0.0)
    scored = F.aggregate(items, zero, lambda acc, s: acc + F.coalesce(s[points].cast("double"), zero))
    most = F.aggregate(items, zero, lambda acc, s: acc + F.coalesce(s[maximum].cast("double"), zero))
    return forms.select(
        *[column(c) for c in forms.columns if c != sections],
        F.size(items).alias("section_count"),
        scored.alias("scored_points"),
        most.alias("max_points"),
        F.round(F.try_divide(scored, most) * 100, 2).alias("overall_pct"),
    )


def unite_channels(channels: Mapping[str, DataFrame], columns: Mapping[str, Mapping[str, str]]) -> DataFrame:
    """One interaction frame from several: per channel {output column: input column}; a missing one is NULL."""
    names = list(dict.fromkeys(n for mapping in columns.values() for n in mapping))
    united = None
    for channel, df in channels.items():
        mapping = columns[channel]
        picked = [column(mapping[n]).alias(n) for n in names if n in mapping]
        part = df.select(F.lit(channel).alias("channel"), *picked)
        united = part if united is None else united.unionByName(part, allowMissingColumns=True)
    return united.select("channel", *names)


def with_surrogate(fact: DataFrame, dimension: DataFrame, natural: str, surrogate: str, default: int = -1) -> DataFrame:
    """Add the surrogate key of the current dimension row; the default where there is none."""
    current = dimension.where("is_current") if "is_current" in dimension.columns else dimension
    keys = current.select(natural, surrogate)
    joined = fact.join(keys, natural, "left")
    return joined.withColumn(surrogate, F.coalesce(column(surrogate), F.lit(default)))


def period_totals(
    fact: DataFrame, at: str, period: str, by: Sequence[str], measures: Sequence[Column], rollup: bool = False
) -> DataFrame:
    """Measures per hour, day, week or month and the ``by`` columns, or their rollup with its level."""
    placed = fact.withColumn("period_start", F.date_trunc(period, column(at)))
    if not rollup:
        return placed.groupBy("period_start", *by).agg(*measures)
    return placed.rollup("period_start", *by).agg(*measures, F.grouping_id().cast("int").alias("grouping_level"))
