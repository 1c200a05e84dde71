"""Batch readers for the load formats, with explicit schemas unless inference is asked for."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from evenkeel.functions.canon import column
from evenkeel.functions.logical import spark_type
from evenkeel.session import setting

FORMATS = ("parquet", "csv", "json", "avro", "orc")
Schema = T.StructType | str | None


def read_files(
    spark: SparkSession,
    path: str | list[str],
    format: str,
    schema: Schema = None,
    infer: bool = True,
    delimiter: str = ",",
    skip_leading_rows: int = 0,
    partition_prefix: str | None = None,
    partition_types: str = "auto",
    strict: bool = False,
) -> DataFrame:
    """Read one of the load formats; AVRO needs the spark-avro package on the class path.

    ``strict`` makes a CSV or JSON record that does not fit its schema an error when it is read; else it reads as NULLs.

    ``partition_prefix`` is the folder above ``name=value`` directories, whose names become
    columns; ``partition_types`` is auto or strings, or custom with the types in ``schema``.
    """
    format = format.lower()
    if format not in FORMATS:
        raise ValueError(f"unknown format {format}; one of {', '.join(FORMATS)}")
    if format == "csv" and skip_leading_rows > 1:
        return _read_csv_skipping(spark, path, schema, infer, delimiter, skip_leading_rows, strict)
    reader = spark.read.format(format)
    if strict and format in ("csv", "json"):
        reader = reader.option("mode", "FAILFAST")
    if schema is not None:
        reader = reader.schema(schema)
    elif format == "csv":
        reader = reader.option("inferSchema", infer)
    if format == "csv":
        reader = reader.option("sep", delimiter).option("header", skip_leading_rows == 1)
    if format == "json" and schema is None and not infer:
        reader = reader.option("primitivesAsString", True)
    if partition_prefix is not None:
        reader = reader.option("basePath", partition_prefix)
        if partition_types == "strings":
            with setting(spark, "spark.sql.sources.partitionColumnTypeInference.enabled", "false"):
                return reader.load(path)
    return reader.load(path)


def _read_csv_skipping(
    spark: SparkSession, path, schema: Schema, infer: bool, delimiter: str, skip: int, strict: bool
) -> DataFrame:
    """CSV whose first ``skip`` lines per file are dropped; the last of them names the columns.

    Spark itself drops at most one. A file's block at offset 0 holds its leading lines, and ids
    rise with the line inside a block, so the bound is one small number per file.
    """
    lines = spark.read.text(path).select(
        "value",
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_start"),
        F.monotonically_increasing_id().alias("_order"),
    )
    by_line = Window.partitionBy("_file").orderBy("_order")
    heads = lines.where(F.col("_start") == 0).withColumn("_line", F.row_number().over(by_line))
    last = heads.where(F.col("_line") == skip)
    bound = last.select("_file", F.col("_order").alias("_last"))
    kept = (F.col("_start") > 0) | (F.col("_order") > F.col("_last"))
    body = lines.join(bound, "_file").where(kept).select("value")
    if isinstance(schema, T.StructType):
        ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    elif schema is not None:
        ddl = schema
    else:
        header = last.select("value").first()
        names = [n.strip() for n in header["value"].split(delimiter)] if header else []
        ddl = ", ".join(f"`{n}` string" for n in names)
    rows = body.select(F.from_csv("value", ddl, {"sep": delimiter, "mode": "FAILFAST" if strict else "PERMISSIVE"}).alias("r")).select("r.*")
    return rows if schema is not None or not infer else _narrowed(rows)


def _narrowed(rows: DataFrame) -> DataFrame:
    """String columns cast to the narrowest type that all their values fit, from one pass."""
    candidates = ("bigint", "double", "boolean", "timestamp")
    unfit = [
        F.count_if(column(c).isNotNull() & column(c).try_cast(t).isNull()).alias(f"{i}_{t}")
        for i, c in enumerate(rows.columns)
        for t in candidates
    ]
    found = rows.agg(*unfit).first()
    types = [next((t for t in candidates if found[f"{i}_{t}"] == 0), "string") for i in range(len(rows.columns))]
    return rows.select(*[column(c).cast(t).alias(c) for c, t in zip(rows.columns, types)])


def read_delimited(
    spark: SparkSession, path: str, schema: T.StructType | str, delimiter: str = "|", header: bool = False
) -> DataFrame:
    """Delimited text with an explicit schema."""
    return spark.read.csv(path, schema=schema, sep=delimiter, header=header)


def read_json_lines(
    spark: SparkSession, path: str, schema: T.StructType | str
) -> tuple[DataFrame, DataFrame]:
    """JSON lines with an explicit schema: the good rows, and the malformed lines as text.

    Blank lines are skipped.
    """
    wanted = schema if isinstance(schema, T.StructType) else T.StructType.fromDDL(schema)
    raw = spark.read.text(path).where(F.trim("value") != "")
    full = T.StructType([*wanted.fields, T.StructField("_corrupt_record", T.StringType())])
    parsed = raw.select("value", F.from_json("value", full, {"mode": "PERMISSIVE"}).alias("r"))
    corrupt = F.col("r").isNull() | F.col("r._corrupt_record").isNotNull()
    good = parsed.where(~corrupt).select(*[F.col("r").getField(n).alias(n) for n in wanted.fieldNames()])
    return good, parsed.where(corrupt).select(F.col("value").alias("line"))


def read_regex_lines(spark: SparkSession, path: str, pattern: str, columns: list[str]) -> DataFrame:
    """Text lines cut by a regex, one capture group per column; a line without a match is all NULL."""
    hit = F.col("value").rlike(pattern)
    groups = [
        F.when(hit, F.regexp_extract("value", pattern, i + 1)).alias(name) for i, name in enumerate(columns)
    ]
    return spark.read.text(path).select(*groups)


def read_sequence_file(spark: SparkSession, path: str, key: str = "key", value: str = "value") -> DataFrame:
    """A Hadoop sequence file of text values; keys are kept as text."""
    pairs = spark.sparkContext.sequenceFile(path).map(lambda kv: (str(kv[0]), str(kv[1])))
    return spark.createDataFrame(pairs, f"`{key}` string, `{value}` string")


def literal_table(spark: SparkSession, columns: dict[str, str], rows: list[dict]) -> DataFrame:
    """A small typed table from literals; ISO strings become dates and timestamps.

    Types are Spark DDL or warehouse spellings; a decimal without a scale gets scale 9.
    """
    texts = [[None if r.get(c) is None else _literal_text(r[c]) for c in columns] for r in rows]
    raw = spark.createDataFrame(texts, ", ".join(f"`{c}` string" for c in columns))
    out = []
    for c, declared in columns.items():
        wanted = spark_type(declared)
        nested = isinstance(wanted, (T.ArrayType, T.StructType, T.MapType))
        value = F.from_json(column(c), wanted) if nested else column(c).cast(wanted)
        out.append(value.alias(c))
    return raw.select(*out)


def _literal_text(value) -> str:
    if isinstance(value, bool):
        return "true" if value else "false"
    if isinstance(value, (list, dict)):
        return json.dumps(value, default=str)
    return str(value)
