"""Readers, writers, generated tables and incremental intake."""

import datetime
import os

import pytest
from pyspark.sql import functions as F

from evenkeel.operators import merge
from evenkeel.plans import marts, staging
from evenkeel.sources import readers, synthetic, writers
from evenkeel.streaming import incremental

FACT = "interaction_id bigint, channel string, amount decimal(12,2), event_ts timestamp, event_date date"


@pytest.fixture(scope="module")
def facts(spark):
    rows = [(1000 + i, "voice" if i % 2 else "chat", f"{i}.50", f"2026-06-0{1 + i % 3} 10:00:00") for i in range(8)]
    df = spark.createDataFrame(rows, "interaction_id bigint, channel string, a string, t string")
    return df.select("interaction_id", "channel", F.col("a").cast("decimal(12,2)").alias("amount"),
                     F.to_timestamp("t").alias("event_ts"), F.to_date("t").alias("event_date"))


def verdicts(df):
    return {r.target: r.status for r in df.collect()}


def test_loads(spark, facts, tmp_path):
    base = str(tmp_path)
    facts.write.parquet(f"{base}/parquet")
    facts.write.orc(f"{base}/orc")
    facts.write.csv(f"{base}/csv", sep="|", header=True)
    facts.write.json(f"{base}/json")
    facts.write.partitionBy("event_date").json(f"{base}/hive")
    for name, extra in {"parquet": {}, "orc": {}, "csv": {"delimiter": "|", "skip_leading_rows": 1}, "json": {"schema": FACT}}.items():
        load = writers.Load(name, f"{base}/{name}", name, f"{base}/out-{name}", 8, **extra)
        assert verdicts(writers.bulk_load(spark, load)) == {name: "PASS"}
        assert spark.read.parquet(f"{base}/out-{name}").agg(F.sum("amount")).first()[0] == 32
    hive = dict(partition_prefix=f"{base}/hive", partition_column="event_date")
    load = writers.Load("hive", f"{base}/hive", "json", f"{base}/out-hive", 8, **hive)
    assert set(verdicts(writers.bulk_load(spark, load)).values()) == {"PASS"}
    assert dict(spark.read.parquet(f"{base}/out-hive").dtypes)["event_date"] == "date"
    texts = readers.read_files(spark, f"{base}/hive", "json", partition_prefix=f"{base}/hive", partition_types="strings")
    assert dict(texts.dtypes)["event_date"] == "string"
    wrong = writers.Load("wrong", f"{base}/parquet", "parquet", f"{base}/out-wrong", 99, partition_column="nope")
    assert set(verdicts(writers.bulk_load(spark, wrong)).values()) == {"FAIL"}
    assert verdicts(writers.bulk_load(spark, writers.Load("gone", f"{base}/gone", "csv", f"{base}/x"))) == {"gone": "FAIL"}
    with pytest.raises(ValueError):
        readers.read_files(spark, base, "xml")


def test_csv_with_several_leading_lines(spark, tmp_path):
    for i in range(2):
        (tmp_path / f"f{i}.csv").write_text(f"made by {i}\n\nid;name;at\n{i};x;2024-01-01 00:00:00\n{i + 5};y;\n")
    got = readers.read_files(spark, str(tmp_path), "csv", delimiter=";", skip_leading_rows=3)
    assert got.dtypes == [("id", "bigint"), ("name", "string"), ("at", "timestamp")]
    assert sorted(r.id for r in got.collect()) == [0, 1, 5, 6]
    typed = readers.read_files(spark, str(tmp_path), "csv", "id int, name string, at string", delimiter=";", skip_leading_rows=3)
    assert typed.count() == 4


def test_text_formats(spark, tmp_path):
    (tmp_path / "a.txt").write_text("1|x\n2|y\n")
    assert readers.read_delimited(spark, str(tmp_path / "a.txt"), "id int, v string").count() == 2
    (tmp_path / "b.json").write_text('{"a": 1, "tags": ["x"], "m": {"k": "v"}}\n\n{broken\n{"a": "no"}\n{"a": 2}\n')
    good, bad = readers.read_json_lines(spark, str(tmp_path / "b.json"), "a int, tags array<string>, m map<string,string>")
    assert sorted(r.a for r in good.collect()) == [1, 2] and bad.count() == 2
    (tmp_path / "c.log").write_text("2024-01-01 00:00:01;S1;MENU=main;\nrubbish\n")
    got = readers.read_regex_lines(spark, str(tmp_path / "c.log"), r"^([^;]+);([^;]+);MENU=([^;]*);$", ["at", "session", "menu"])
    assert {tuple(r) for r in got.collect()} == {("2024-01-01 00:00:01", "S1", "main"), (None, None, None)}
    spark.sparkContext.parallelize([("k1", "v1"), ("k2", "v2")], 1).saveAsSequenceFile(str(tmp_path / "seq"))
    assert {tuple(r) for r in readers.read_sequence_file(spark, str(tmp_path / "seq")).collect()} == {("k1", "v1"), ("k2", "v2")}


def test_tables(spark, facts, tmp_path):
    writers.replace_table(facts, "facts_copy")
    assert spark.table("facts_copy").count() == 8
    writers.write_bucketed(facts, "facts_bucketed", 4, "interaction_id", "interaction_id")
    assert spark.table("facts_bucketed").count() == 8
    spark.sql("CREATE TABLE facts_days (interaction_id bigint, amount decimal(12,2), event_date date) USING parquet PARTITIONED BY (event_date)")
    writers.insert_partitions(facts.select("amount", "interaction_id", "event_date"), "facts_days")
    writers.insert_partitions(facts.where("event_date = '2026-06-01'").limit(1), "facts_days")
    assert {str(r.event_date): r["count"] for r in spark.table("facts_days").groupBy("event_date").count().collect()} == {
        "2026-06-01": 1, "2026-06-02": 3, "2026-06-03": 2}
    out = str(tmp_path / "laid")
    writers.write_partitioned(facts, out, ["event_date"], ["interaction_id"], files_per_partition=2)
    assert spark.read.parquet(out).count() == 8 and os.path.isdir(f"{out}/event_date=2026-06-01")
    kept = writers.retain_partitions(spark.read.parquet(out), "event_date", 1, "2026-06-03")
    assert kept.count() == 5 and "PartitionFilters: [isnotnull(event_date" in kept._jdf.queryExecution().toString()
    path = str(tmp_path / "live")
    facts.write.parquet(path)
    delta = facts.where("interaction_id < 1003").withColumn("op", F.lit("D"))
    writers.swap_in(merge.apply_merge(spark.read.parquet(path), delta, ["interaction_id"]), path, str(tmp_path / "stage"))
    assert spark.read.parquet(path).count() == 5


def test_egress(spark, facts, tmp_path):
    path = str(tmp_path / "out")
    columns = ["interaction_id", "channel", "amount"]
    writers.export_json(facts.select(*columns), path)
    back, bad = readers.read_json_lines(spark, path, "interaction_id bigint, channel string, amount string")
    assert bad.isEmpty()
    assert set(verdicts(writers.egress_parity("e", facts, back, columns, "amount")).values()) == {"PASS"}
    assert set(verdicts(writers.egress_parity("e", facts, back.where("interaction_id <> 1001"), columns, "amount")).values()) == {"FAIL"}
    assert tuple(writers.control_totals(back, "amount").first()) == (8, 32)


def test_synthetic(spark):
    columns = {"customer_id": "id % 1000000", "amount": ("round(rand(7) * 1000, 2)", "decimal(12,2)"),
               "event_date": "date_add(DATE'2026-01-01', CAST(id % 365 AS INT))", "channel": "element_at(array('voice', 'chat', 'email'), CAST(id % 3 AS INT) + 1)"}
    df = synthetic.synthetic_table(spark, 50_000, columns)
    assert df.count() == 50_000 and df.agg(F.min("id"), F.max("id")).first() == (1, 50_000)
    assert df.select("channel").distinct().count() == 3 and df.exceptAll(synthetic.synthetic_table(spark, 50_000, columns)).isEmpty()


def test_incremental(spark, tmp_path):
    df = spark.createDataFrame([(1, "2024-01-01"), (2, "2024-01-02")], "id int, at string")
    fresh = incremental.new_rows(df, "at", "2024-01-01")
    assert [r.id for r in fresh.collect()] == [2]
    mark = incremental.next_watermark(fresh, "t", "at", "r2", "2024-02-01", "2024-01-01").first()
    assert mark.last_value == "2024-01-02"
    assert incremental.next_watermark(fresh.where("false"), "t", "at", "r3", "2024-02-01", mark.last_value).first().last_value == "2024-01-02"


def test_stream_appends_once(spark, tmp_path):
    source, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    schema = "id bigint, at timestamp"

    def batch(ids):
        at = F.timestamp_seconds(F.lit(1_700_000_000) + F.col("id"))
        ids_df = spark.createDataFrame([(i,) for i in ids], "id bigint")
        ids_df.select("id", at.alias("at")).coalesce(1).write.mode("append").parquet(source)
        stream = incremental.file_stream(spark, source, schema)
        query = incremental.append_stream(stream, ["id"], "at", "1 hour", out, state)
        query.awaitTermination(120)
        return sorted(r.id for r in spark.read.parquet(out).collect())

    assert batch([1, 2, 2]) == [1, 2]
    assert batch([2, 3]) == [1, 2, 3]


def test_hierarchy_edges(spark):
    rows = [(1, None, "root")] + [(i, i - 1, f"n{i}") for i in range(2, 10)] + [(50, 51, "a"), (51, 50, "b"), (60, 999, "lost")]
    df = spark.createDataFrame(rows, "org_unit_id int, parent_unit_id int, unit_name string")
    for c in ("unit_code", "unit_type", "site_code"):
        df = df.withColumn(c, F.lit("x"))
    got = {r.org_unit_id: (r.depth, r.path_names) for r in marts.org_hierarchy(df).collect()}
    assert set(got) == set(range(1, 8)) and got[3] == (2, "root > n2 > n3")


def test_staging_arrays(spark):
    at = datetime.datetime(2024, 1, 1)
    said = [("customer", at), ("agent", at + datetime.timedelta(seconds=42)), ("agent", at + datetime.timedelta(seconds=60))]
    df = spark.createDataFrame([("c1", said), ("c2", said[:1])], "chat_ref string, messages array<struct<sender:string,ts:timestamp>>")
    got = {r.chat_ref: (r.message_count, r.agent_message_count, r.customer_message_count, r.first_response_seconds)
           for r in staging.chat_sessions(df).collect()}
    assert got == {"c1": (3, 2, 1, 42), "c2": (1, 0, 1, None)}
    forms = spark.createDataFrame([(1, [(3, 4), (None, 6)])], "id int, s array<struct<p:int,m:int>>")
    assert staging.section_totals(forms, "s", "p", "m").first().overall_pct == 30.0
