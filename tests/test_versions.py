"""Versioned tables and file intake, with planted faults."""

import gzip
import hashlib
import os

import pytest
from pyspark.sql import functions as F

from evenkeel.sources import intake
from evenkeel.sources.versioned import ConflictError, VersionedTable
from evenkeel.streaming import incremental


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.fixture
def table(spark, tmp_path):
    made = VersionedTable(spark, str(tmp_path / "table"), ("id",), rows_per_file=100)
    made.overwrite(spark.range(1000).select("id", (F.col("id") * 2).alias("v"), F.lit("old").alias("t")))
    return made


def test_merge_keeps_untouched_files(spark, table):
    before = {r.file for r in table.manifest().collect()}
    delta = spark.createDataFrame([(5, 0, "new", "U"), (7, 0, "x", "D"), (4, 1, "new", "U"), (2000, 9, "new", "I"), (3000, 9, "x", "D")], "id long, v long, t string, op string")
    assert len(before) == 10 and table.merge(delta) == 2
    after = {r.file for r in table.manifest().collect()}
    assert len(before & after) == 9
    want = {i: (i * 2, "old") for i in range(1000)} | {5: (0, "new"), 4: (1, "new"), 2000: (9, "new")}
    del want[7]
    assert {r.id: (r.v, r.t) for r in table.read().collect()} == want
    assert table.read(1).where("t = 'old'").count() == 1000
    assert [(r.action, r.n_rows, r.kept_files) for r in table.history().orderBy("version").collect()] == [("overwrite", 1000, 0), ("merge", 1000, 9)]


def test_merge_of_keys_outside_and_of_none(spark, table):
    delta = spark.createDataFrame([(-5, 1, "new", "I"), (None, 1, "null", "I")], "id long, v long, t string, op string")
    table.merge(delta)
    assert table.history().where("version = 2").first().kept_files == 10 and table.read().count() == 1002
    table.merge(delta.limit(0))
    assert table.read().count() == 1002
    with pytest.raises(Exception, match="more than once"):
        table.merge(spark.createDataFrame([(1, 1, "a", "U"), (1, 2, "b", "U")], "id long, v long, t string, op string"))
    assert table.version() == 3


def test_a_failure_before_the_commit_leaves_the_old_version(spark, table, monkeypatch):
    def dies(self, entry):
        raise OSError("lost")

    with monkeypatch.context() as m:
        m.setattr(VersionedTable, "_commit", dies)
        with pytest.raises(OSError):
            table.overwrite(spark.range(3).select("id", F.lit(1).cast("long").alias("v"), F.lit("t").alias("t")))
    assert table.version() == 1 and table.read().count() == 1000
    table.overwrite(table.read().where("id < 10"))
    assert table.read().count() == 10 and table.read(1).count() == 1000


def test_of_two_writers_one_is_refused(spark, table, monkeypatch):
    base = table._last()
    monkeypatch.setattr(VersionedTable, "_last", lambda self: base)
    more = spark.range(5).select("id", F.lit(1).cast("long").alias("v"), F.lit("t").alias("t"))
    assert table.append(more) == 2
    with pytest.raises(ConflictError):
        table.append(more)
    monkeypatch.undo()
    assert table.read().count() == 1005


def test_a_hot_key_fills_several_files(spark, tmp_path):
    made = VersionedTable(spark, str(tmp_path / "hot"), ("id",), rows_per_file=100)
    made.overwrite(spark.range(1000).select(F.lit(1).alias("id"), F.col("id").alias("v")))
    files = made.manifest().collect()
    assert len(files) > 5 and max(f.n_rows for f in files) < 400


def test_small_files_share_tasks(spark, tmp_path):
    """The range sample and the listing would otherwise send rows and results for each file to the driver."""
    made = VersionedTable(spark, str(tmp_path / "small"), ("id",), rows_per_file=10)
    tracker, sc = spark.sparkContext.statusTracker(), spark.sparkContext
    sc.setJobGroup("small-files", "")
    made.overwrite(spark.range(3000).select("id", F.lit("t").alias("t")))
    made.merge(spark.createDataFrame([(5, "new", "U"), (-1, "new", "I")], "id long, t string, op string"))
    rows = made.read()
    sc.setLocalProperty("spark.jobGroup.id", None)
    stages = [tracker.getStageInfo(s) for j in tracker.getJobIdsForGroup("small-files") for s in tracker.getJobInfo(j).stageIds]
    assert max(s.numTasks for s in stages if s is not None) < 100
    files = made.manifest(1).collect()
    assert len(files) == 300 and all(f.n_rows == 10 and f.high - f.low == 9 for f in files)
    assert rows.count() == 3001 and {r.id for r in rows.where("t = 'new'").collect()} == {5, -1}


def test_batches_are_taken_once_and_audited(spark, tmp_path):
    source, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    table = VersionedTable(spark, out, ("id",))

    def run(ids):
        spark.createDataFrame([(i, f"2024-01-{i:02d}") for i in ids], "id long, at string").coalesce(1).write.mode("append").parquet(source)
        stream = incremental.file_stream(spark, source, "id long, at string")
        incremental.ledgered_stream(stream, table, "s", state, "at").awaitTermination(120)

    run([1, 2])
    run([5, 3])
    # the batch is played again, as after a failure between the commit and the checkpoint
    os.remove(f"{state}/commits/1")
    crc = f"{state}/commits/.1.crc"
    if os.path.exists(crc):
        os.remove(crc)
    run([9])
    assert sorted(r.id for r in table.read().collect()) == [1, 2, 3, 5, 9]
    audit = [(r.run_id, r.n_rows, r.last_value, r.status) for r in incremental.audit_rows(table).collect()]
    assert audit == [("s-0", 2, "2024-01-02", "SUCCESS"), ("s-1", 2, "2024-01-05", "SUCCESS"), ("s-2", 1, "2024-01-09", "SUCCESS")]


def test_intake_with_planted_faults(spark, tmp_path):
    files = {
        "a/good.csv": b"id|name\n1|x\n2|y\n", "b/good 2.csv": b'"id"| name \r\n3|z\n', "drift.csv": b"id|nom|more\n4|x|y\n", "moved.csv": b"name|id\nx|5\n",
        "wrong.csv": b"id|name\n6|x\n", "unlisted.csv": b"id|name\n7|x\n", "empty.csv": b"", "twice.csv": b"id|name\n8|x\n", "good.csv.gz": b"id|name\n9|gz\n",
        "cut.csv.gz": b"id|name\n" + os.urandom(3000).hex().encode(), "junk.csv.gz": b"", "two.csv.gz": b"id|name\n10|m\n",
    }
    for name, content in files.items():
        at = tmp_path / "in" / name
        at.parent.mkdir(parents=True, exist_ok=True)
        raw = gzip.compress(content) if name.endswith(".gz") else content
        raw = raw[:-700] if name.startswith("cut") else b"no gzip" if name.startswith("junk") else raw
        raw = gzip.compress(b"id|name\n") + gzip.compress(b"10|m\n") if name.startswith("two") else raw
        at.write_bytes(raw)
    listed = [(n, hashlib.sha256(c).hexdigest().upper()) for n, c in files.items() if n not in ("unlisted.csv", "wrong.csv")]
    listed += [("wrong.csv", "0" * 64), ("gone.csv", "1" * 64), ("twice.csv", "2" * 64), ("a/good.csv", listed[0][1])]
    folder = str(tmp_path / "in")
    found = intake.judged(intake.examined(spark, folder), spark.createDataFrame(listed, "file string, sha256 string"), ["id", "name"], "|")
    want = {
        "a/good.csv": [], "b/good 2.csv": [], "drift.csv": ["header"], "moved.csv": ["order"], "wrong.csv": ["checksum"], "unlisted.csv": ["unlisted"],
        "empty.csv": ["missing"], "twice.csv": ["ambiguous"], "good.csv.gz": [], "cut.csv.gz": ["corrupt"], "junk.csv.gz": ["corrupt"], "two.csv.gz": [], "gone.csv": ["missing"],
    }
    assert {r.file: r.reasons for r in found.collect()} == want
    assert {(tuple(r.missing), tuple(r.extra)) for r in found.where("file = 'drift.csv'").collect()} == {(("name",), ("nom", "more"))}
    assert rows_of(intake.landed(spark, found, "id int, name string", "|")) == [
        (1, "x", "a/good.csv"), (10, "m", "two.csv.gz"), (2, "y", "a/good.csv"), (3, "z", "b/good 2.csv"), (9, "gz", "good.csv.gz")
    ]
    assert intake.quarantined(found).count() == 9
    run = intake.audit(found, "r1", "2024-01-01").first()
    assert (run.n_files, run.n_good, run.n_bad, run.status) == (13, 4, 9, "QUARANTINED")


def test_intake_of_an_empty_folder(spark, tmp_path):
    (tmp_path / "none").mkdir()
    manifest = spark.createDataFrame([("x.csv", "00")], "file string, sha256 string")
    found = intake.judged(intake.examined(spark, str(tmp_path / "none")), manifest, ["id"])
    assert [(r.file, r.reasons) for r in found.collect()] == [("x.csv", ["missing"])]
    assert intake.landed(spark, found, "id int").isEmpty()
