"""Tables of Parquet files that change by whole versions.

A table is a folder: ``data`` holds files that are never changed, ``manifests`` lists of files, and ``commits`` one
small JSON file per version, which names its manifest. The commit is written last, under a temporary name, and renamed;
a rename that would replace a commit fails. So a reader sees the version before or the version after, a writer that dies
in between leaves nothing but unused files, and of two writers at once one is refused.

``merge`` rewrites only files that hold a key of the delta; the manifest keeps each file's key range, which narrows the
search before any file is opened. ``append`` can be given a writer's name and batch number: a batch that was taken
already adds nothing, and each commit carries an audit entry of its run.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from evenkeel.functions.canon import column
from evenkeel.operators.merge import apply_merge
from evenkeel.session import setting

COMMIT = "version bigint, manifest string, writers map<string,bigint>, run_id string, action string, n_rows bigint, n_files bigint, kept_files bigint, last_value string"
#: Rows of one data file, as a guide; a task writes one such file or, of smaller ones, as many as hold ROWS_PER_TASK.
ROWS_PER_FILE, ROWS_PER_TASK = 4_000_000, 250_000


class ConflictError(RuntimeError):
    """Another writer committed the version first."""


@dataclass(frozen=True)
class VersionedTable:
    spark: SparkSession
    path: str
    keys: tuple[str, ...]
    rows_per_file: int = ROWS_PER_FILE

    # commits

    def history(self) -> DataFrame:
        """One row per version: the audit entry of the run that made it."""
        if not self._files().exists(self._hadoop_path("commits")):
            return self.spark.createDataFrame([], COMMIT)
        return self.spark.read.schema(COMMIT).json(f"{self.path}/commits")

    def _last(self) -> dict:
        last = self.history().orderBy(F.desc("version")).first()
        return last.asDict() if last is not None else {"version": 0, "manifest": None, "writers": {}, "last_value": None}

    def version(self) -> int:
        return self._last()["version"]

    def _hadoop_path(self, *parts: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path("/".join([self.path, *parts]))

    def _files(self):
        return self._hadoop_path().getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _commit(self, entry: dict) -> None:
        jvm, files = self.spark._jvm, self._files()
        files.mkdirs(self._hadoop_path("commits"))
        temporary = self._hadoop_path("commits", f"_{uuid.uuid4().hex}")
        out = files.create(temporary, False)
        out.write(bytearray(json.dumps(entry).encode()))
        out.close()
        context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(files.getUri(), self.spark._jsc.hadoopConfiguration())
        final = self._hadoop_path("commits", f"{entry['version']:012d}.json")
        try:
            context.rename(temporary, final, self.spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0))
        except Exception as error:
            files.delete(temporary, False)
            if files.exists(final):
                raise ConflictError(f"version {entry['version']} of {self.path} was committed by another writer") from error
            raise

    # files and manifests

    def manifest(self, version: int | None = None) -> DataFrame | None:
        """(file, n_rows, low, high): the files of a version and the range of their first key; None for no version."""
        rows = self.history()
        rows = rows.where(F.col("version") == version) if version is not None else rows.orderBy(F.desc("version"))
        found = rows.first()
        if found is None:
            return None
        return self.spark.read.parquet(f"{self.path}/{found['manifest']}")

    def _load(self, files: Sequence[str], schema: T.StructType) -> DataFrame:
        if not files:
            return self.spark.createDataFrame([], schema)
        # by default each file is listed by a task of its own
        with setting(self.spark, "spark.sql.sources.parallelPartitionDiscovery.parallelism", str(self.spark.sparkContext.defaultParallelism)):
            return self.spark.read.schema(schema).parquet(*[f"{self.path}/{f}" for f in files])

    def _schema(self, manifest: DataFrame) -> T.StructType:
        return T.StructType.fromJson(json.loads(manifest.schema["file"].metadata["schema"]))

    def read(self, version: int | None = None) -> DataFrame:
        """The rows of a version, the last one by default. The list of files goes through the driver, as any listing does."""
        manifest = self.manifest(version)
        if manifest is None:
            raise ValueError(f"{self.path} has no version {version or ''}")
        return self._load([r["file"] for r in manifest.select("file").collect()], self._schema(manifest))

    def _written(self, rows: DataFrame) -> DataFrame:
        """Write ``rows`` in ranges of the keys and list the files.

        Finding the ranges sends a sample of rows for each task to the driver, so small files share a task.
        """
        folder = f"data/{uuid.uuid4().hex}"
        files = max(1, ROWS_PER_TASK // self.rows_per_file)
        parts = max(1, -(-rows.count() // (self.rows_per_file * files)))
        by = [column(k) for k in self.keys]
        # other columns part rows of one key, which may be very many
        spread = [column(f.name) for f in rows.schema.fields if f.name not in self.keys and isinstance(f.dataType, T.AtomicType)]
        sorted_rows = rows.repartitionByRange(parts, *by, *spread).sortWithinPartitions(*by)
        sorted_rows.write.option("maxRecordsPerFile", self.rows_per_file if files > 1 else 0).parquet(f"{self.path}/{folder}")
        landed = self.spark.read.schema(rows.schema).parquet(f"{self.path}/{folder}")
        name = F.concat(F.lit(f"{folder}/"), F.url_decode(F.substring_index("_metadata.file_path", "/", -1)))
        first = column(self.keys[0])
        listed = landed.groupBy(name.alias("file")).agg(F.count(F.lit(1)).alias("n_rows"), F.min(first).alias("low"), F.max(first).alias("high"))
        return listed.select(F.col("file").alias("file", metadata={"schema": rows.schema.json()}), "n_rows", "low", "high")

    def _publish(self, base: dict, manifest: DataFrame, kept_files: int, action: str, run_id: str | None, writers: dict, last_value: str | None) -> int:
        name = f"manifests/{uuid.uuid4().hex}"
        # one row per file of the table
        manifest.coalesce(1).write.parquet(f"{self.path}/{name}")
        size = self.spark.read.parquet(f"{self.path}/{name}").agg(F.coalesce(F.sum("n_rows"), F.lit(0)).alias("n"), F.count(F.lit(1)).alias("f")).first()
        entry = {
            "version": base["version"] + 1, "manifest": name, "writers": writers, "run_id": run_id or uuid.uuid4().hex, "action": action,
            "n_rows": size["n"], "n_files": size["f"], "kept_files": kept_files, "last_value": last_value,
        }
        self._commit(entry)
        return entry["version"]

    # writes

    def overwrite(self, rows: DataFrame, run_id: str | None = None) -> int:
        """A version of just ``rows``, which may be computed from the table itself."""
        base = self._last()
        return self._publish(base, self._written(rows), 0, "overwrite", run_id, base["writers"] or {}, base["last_value"])

    def append(
        self, rows: DataFrame, writer: str | None = None, batch: int | None = None, run_id: str | None = None, check_column: str | None = None
    ) -> int | None:
        """A version with ``rows`` added; None, and nothing added, for a batch of ``writer`` that is in already.

        ``check_column`` keeps its highest value, as text, in the audit entry.
        """
        base = self._last()
        writers = dict(base["writers"] or {})
        if writer is not None and batch is not None:
            if batch <= writers.get(writer, -1):
                return None
            writers[writer] = batch
        before = self.manifest(base["version"]) if base["version"] else None
        listed = self._written(rows)
        kept = before.count() if before is not None else 0
        last = base["last_value"]
        if check_column is not None:
            highest = rows.agg(F.max(column(check_column)).cast("string")).first()[0]
            last = highest if highest is not None else last
        both = listed if before is None else listed.unionByName(before.select("file", "n_rows", "low", "high"))
        both = both.select(F.col("file").alias("file", metadata={"schema": (rows.schema if before is None else self._schema(before)).json()}), "n_rows", "low", "high")
        return self._publish(base, both, kept, "append", run_id, writers, last)

    def touched_files(self, delta: DataFrame) -> list[str]:
        """Files that hold a key of ``delta``: those whose range it meets are searched by their key columns alone."""
        manifest = self.manifest()
        first = column(self.keys[0])
        span = delta.agg(F.min(first).alias("low"), F.max(first).alias("high")).first()
        near = manifest.where((F.col("high") >= F.lit(span["low"])) & (F.col("low") <= F.lit(span["high"])))
        names = [r["file"] for r in near.select("file").collect()]
        if not names:
            return []
        rows = self._load(names, self._schema(manifest)).where(first.between(F.lit(span["low"]), F.lit(span["high"])))
        at = F.concat_ws("/", F.lit("data"), F.url_decode(F.substring_index("_metadata.file_path", "/", -2)))
        wanted = delta.select(*[column(k) for k in self.keys]).distinct()
        hit = rows.select(*[column(k) for k in self.keys], at.alias("_file")).join(wanted, list(self.keys), "left_semi")
        return [r["_file"] for r in hit.select("_file").distinct().collect()]

    def merge(self, delta: DataFrame, op: str = "op", run_id: str | None = None) -> int:
        """A version after ``apply_merge`` of ``delta``; files without one of its keys stay as they are."""
        base = self._last()
        if not base["version"]:
            raise ValueError(f"{self.path} has no version to merge into")
        manifest = self.manifest(base["version"])
        schema, touched = self._schema(manifest), self.touched_files(delta)
        merged = apply_merge(self._load(touched, schema), delta, list(self.keys), op)
        fresh = self._written(merged.select(*[column(f.name) for f in schema.fields]))
        rest = manifest.where(~F.col("file").isin(touched)) if touched else manifest
        both = fresh.unionByName(rest)
        both = both.select(F.col("file").alias("file", metadata={"schema": schema.json()}), "n_rows", "low", "high")
        return self._publish(base, both, rest.count(), "merge", run_id, base["writers"] or {}, base["last_value"])
