"""Files taken in against a manifest: digests, headers, compressed files, and which ones are good.

Digests of plain files are taken by SQL functions on the ``binaryFile`` source. A ``.gz`` file is unpacked in an Arrow
task, a megabyte at a time, so its plain text is never held whole; its digest and header are those of the plain text.
A file's stored bytes are one value, so files above ``spark.sql.sources.binaryFile.maxLength`` (2 GB) stop the job. Spark lists no
file of no bytes, so such a file counts as missing where it was promised.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes of a file's first line that are looked at, and of plain text unpacked at once.
HEADER_BYTES, STEP_BYTES = 1 << 16, 1 << 20
EXAMINED = "path string, n_bytes long, sha256 string, header string, sound boolean"


def _unpacked(content: memoryview, digest, head: bytearray) -> bool:
    """Feed the plain text to ``digest``; whether the file holds whole gzip members and nothing else."""
    rest = content
    while len(rest):
        member = zlib.decompressobj(31)
        while not member.eof:
            try:
                plain = member.decompress(rest, STEP_BYTES)
            except zlib.error:
                return False
            rest = memoryview(member.unconsumed_tail or member.unused_data)
            if not plain and not member.eof and not len(rest):
                return False
            digest.update(plain)
            head += plain[: HEADER_BYTES - len(head)]
    return len(content) > 0


def _packed_files(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for path, content in zip(batch.column("path"), batch.column("content"), strict=True):
            digest, head = hashlib.sha256(), bytearray()
            raw = memoryview(content.as_buffer())
            sound = _unpacked(raw, digest, head)
            header = bytes(head).split(b"\n", 1)[0].decode(errors="replace")
            rows.append({"path": path.as_py(), "n_bytes": len(raw), "sha256": digest.hexdigest(), "header": header, "sound": sound})
        schema = pa.schema([("path", pa.string()), ("n_bytes", pa.int64()), ("sha256", pa.string()), ("header", pa.string()), ("sound", pa.bool_())])
        yield pa.RecordBatch.from_pylist(rows, schema=schema)


def examined(spark: SparkSession, folder: str) -> DataFrame:
    """(file, path, n_bytes, sha256, header, sound) of every file below ``folder``; file is the path below it."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folder).select("path", "length", "content")
    packed = F.col("path").endswith(".gz")
    first = F.substring_index(F.substring("content", 1, HEADER_BYTES).cast("string"), "\n", 1)
    plain = found.where(~packed).select("path", F.col("length").alias("n_bytes"), F.sha2("content", 256).alias("sha256"), first.alias("header"), F.lit(True).alias("sound"))
    unpacked = found.where(packed).select("path", "content").mapInArrow(_packed_files, EXAMINED)
    name = F.substring_index("path", _bare(folder) + "/", -1)
    return plain.unionByName(unpacked).select(name.alias("file"), "*")


def _bare(folder: str) -> str:
    """A folder without its scheme, which Spark spells in more than one way."""
    return re.sub(r"^[A-Za-z0-9+.-]+:/*", "", folder).lstrip("/").removesuffix("/")


def _columns(header: Column, delimiter: str) -> Column:
    cells = F.split(F.rtrim(header, F.lit("\r")), F.lit("\\Q" + delimiter + "\\E"))
    return F.transform(cells, lambda c: F.btrim(F.trim(c), F.lit('"')))


def judged(files: DataFrame, manifest: DataFrame, header: Sequence[str] | None = None, delimiter: str = ",") -> DataFrame:
    """(file, path, n_bytes, sha256, expected_sha256, reasons, missing, extra): one row per file, found or promised.

    ``manifest`` is (file, sha256). Reasons are missing (promised, not found), unlisted, ambiguous (promised with several
    digests), corrupt (does not unpack), checksum, header (columns missing or added) and order (the same columns in
    another order). No reason means good. Digests compare without regard to case.
    """
    promised = manifest.groupBy("file").agg(F.min(F.lower("sha256")).alias("expected_sha256"), F.max(F.lower("sha256")).alias("_other"))
    both = files.join(promised.withColumn("_promised", F.lit(True)), "file", "full")
    found, listed = F.col("path").isNotNull(), F.col("_promised").isNotNull()
    many = ~F.col("expected_sha256").eqNullSafe(F.col("_other"))
    names = _columns(F.col("header"), delimiter)
    wanted = F.array(*[F.lit(c) for c in header]) if header is not None else names
    missing = F.when(found & F.col("sound"), F.array_except(wanted, names))
    extra = F.when(found & F.col("sound"), F.array_except(names, wanted))
    compared = both.withColumns({"missing": missing, "extra": extra})
    drift = (F.size("missing") > 0) | (F.size("extra") > 0) | (F.size(names) != F.size(wanted))
    reasons = [
        (listed & ~found, "missing"), (found & ~listed, "unlisted"), (listed & many, "ambiguous"), (found & ~F.col("sound"), "corrupt"),
        (found & listed & F.col("sound") & ~many & ~F.col("sha256").eqNullSafe(F.col("expected_sha256")), "checksum"),
        (found & F.col("sound") & drift, "header"), (found & F.col("sound") & ~drift & (names != wanted), "order"),
    ]
    found_reasons = F.array_compact(F.array(*[F.when(when, F.lit(reason)) for when, reason in reasons]))
    return compared.select("file", "path", "n_bytes", "sha256", "expected_sha256", found_reasons.alias("reasons"), "missing", "extra")


def good(verdicts: DataFrame) -> DataFrame:
    return verdicts.where(F.size("reasons") == 0)


def quarantined(verdicts: DataFrame) -> DataFrame:
    """The files that must not be loaded, with why."""
    return verdicts.where(F.size("reasons") > 0)


def landed(spark: SparkSession, verdicts: DataFrame, schema: str, delimiter: str = ",") -> DataFrame:
    """Rows of the good files with ``_file``; a record that does not fit ``schema`` stops the job.

    The names of the files go through the driver, as in any listing of files; none is opened unless it is good.
    """
    rows = {r["path"]: r["file"] for r in good(verdicts).select("path", "file").collect()}
    if not rows:
        return spark.createDataFrame([], schema).withColumn("_file", F.lit(None).cast("string"))
    read = spark.read.schema(schema).option("sep", delimiter).option("header", True).option("mode", "FAILFAST").csv(sorted(rows))
    some = next(iter(rows))
    root = some[: len(some) - len(rows[some])]
    at = F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))
    return read.select("*", F.substring_index(at, _bare(root) + "/", -1).alias("_file"))


def audit(verdicts: DataFrame, run_id: str, run_ts: str) -> DataFrame:
    """One row about the run: files found and promised, good and bad, bytes, and SUCCESS or QUARANTINED."""
    bad = F.count_if(F.size("reasons") > 0)
    return verdicts.agg(
        F.count(F.lit(1)).alias("n_files"), (F.count(F.lit(1)) - bad).alias("n_good"), bad.alias("n_bad"), F.coalesce(F.sum("n_bytes"), F.lit(0)).alias("n_bytes"),
        F.when(bad > 0, "QUARANTINED").otherwise("SUCCESS").alias("status"),
    ).select(F.lit(run_id).alias("run_id"), F.lit(run_ts).cast("timestamp").alias("run_ts"), "*")
