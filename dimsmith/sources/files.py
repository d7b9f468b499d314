"""File sources: delimited text (declared or inferred schema), schema drift,
provenance, and the incremental (exactly-once) file stream.

Streaming CSV needs a schema up front. ``stream_schema`` infers it once with
a batch read, stores it as JSON next to the stream's checkpoint and reuses the
stored copy on every later run, so a new file with extra columns does not
silently change the table (that needs an explicit full refresh).
"""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed reader options of the declared delimited-text format.
DELIMITED_DEFAULTS = {"sep": ",", "quote": '"', "escape": "\\", "header": "true"}
SOURCE_FILE = "source_file"
_RECORD = "_record"


def all_string_schema(columns: Sequence[str]) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType(), True) for c in columns])


def read_delimited(spark: SparkSession, path: str | Sequence[str],
                   schema: T.StructType | str | None = None,
                   options: Mapping[str, object] | None = None) -> DataFrame:
    """Batch delimited text; a declared schema skips inference (one pass)."""
    opts = {**DELIMITED_DEFAULTS, **{k: str(v).lower() if isinstance(v, bool) else str(v)
                                     for k, v in (options or {}).items()}}
    reader = spark.read.options(**opts)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.csv(path if isinstance(path, str) else list(path))


def with_provenance(df: DataFrame, column: str = SOURCE_FILE) -> DataFrame:
    """Source file of every row (works on batch and streaming file scans)."""
    return df.withColumn(column, F.col("_metadata.file_path"))


def header_index(spark: SparkSession, path: str) -> DataFrame:
    """(file, header): the first line of every file below a folder, found by a job over its blocks.

    Only lines of blocks that start a file count; each partition keeps one line a
    file. A file without lines is absent.
    """
    # a block's lines stand in one partition, in order
    lines = spark.read.option("recursiveFileLookup", "true").text(path).select(
        "value", F.col("_metadata.file_path").alias("uri"), F.col("_metadata.file_block_start").alias("start"),
        F.monotonically_increasing_id().alias("nth"))
    first = lines.where("start = 0").groupBy("uri").agg(F.min_by("value", "nth").alias("header"))
    return first.select(F.url_decode(F.replace("uri", F.lit("+"), F.lit("%2B"))).alias("file"), "header")


def _headers(spark: SparkSession, path: str) -> dict[str, list[str]]:
    """Header line -> its files, in order: a row for each different header."""
    found = header_index(spark, path).groupBy("header").agg(F.array_sort(F.collect_list("file")).alias("files"))
    return {r.header: r.files for r in found.orderBy(F.col("files")[0]).collect()}


def read_with_drift(spark: SparkSession, drops: Sequence[str],
                    declared: Mapping[str, str],
                    options: Mapping[str, object] | None = None) -> DataFrame:
    """Schema drift: files are read by their own header (files of one folder may
    differ, also in the order of columns); declared columns are cast (try_cast,
    bad values -> NULL), undeclared ones flow through as strings, and all are
    unioned by name (missing columns -> NULL)."""
    out = None
    groups = [files for path in drops for header, files in _headers(spark, path).items() if header]
    for files in groups:
        raw = read_delimited(spark, files, options=options)
        cols = []
        for c in raw.columns:
            if c in declared:
                cols.append(F.expr(f"try_cast(`{c}` AS {declared[c]})").alias(c))
            else:
                cols.append(F.col(c))
        for c, typ in declared.items():
            if c not in raw.columns:
                cols.append(F.lit(None).cast(typ).alias(c))
        part = raw.select(*cols)
        out = part if out is None else out.unionByName(part, allowMissingColumns=True)
    if out is None:
        raise ValueError("no drops given")
    return out


def _read_text(spark: SparkSession, path: str) -> str | None:
    from dimsmith.sinks.files import exists
    if not exists(spark, path):
        return None
    return "\n".join(r.value for r in spark.read.text(path).collect())


def stream_schema(spark: SparkSession, source: str, fmt: str, options: Mapping[str, object],
                  schema_path: str) -> T.StructType:
    """Schema of a file stream: stored JSON if present, else inferred once and stored."""
    stored = _read_text(spark, schema_path)
    if stored:
        return T.StructType.fromJson(json.loads(stored))
    reader = spark.read.format(fmt).options(**{k: str(v) for k, v in options.items()})
    files: str | list[str] = source
    if fmt == "csv" and str(options.get("header", "false")).lower() == "true" and "pathGlobFilter" not in options:
        # later files may have more columns: infer from those with the widest header
        found = _headers(spark, source)
        if len(found) > 1:
            sep = str(options.get("sep", ","))
            files = found[max(found, key=lambda h: (h.count(sep), h))]
    schema = reader.load(files).schema
    spark.createDataFrame([(json.dumps(schema.jsonValue()),)], "value string") \
        .coalesce(1).write.mode("overwrite").text(schema_path)
    return schema


def read_file_stream(spark: SparkSession, source: str, fmt: str = "csv",
                     options: Mapping[str, object] | None = None,
                     schema: T.StructType | None = None, schema_path: str | None = None,
                     provenance: str | None = SOURCE_FILE, rescue: str | None = None,
                     max_files: int | None = None, max_bytes: str | int | None = None,
                     max_age: str | None = None, archive: str | None = None) -> DataFrame:
    """Incremental file source: each landed file is read once (the checkpoint
    of the consuming query records which files were taken).

    ``rescue`` (delimited text): a column that keeps, as JSON, what does not fit
    the schema: values that cannot be cast, by column, and under ``_record`` the
    whole line where it has more or fewer fields. NULL where all fits.

    ``max_files`` / ``max_bytes``: at most so much a micro-batch (one file at
    least). ``max_age``: how much older than the newest file a file that arrives
    late may be (Spark's default: 7 days; older ones are never read). ``archive``:
    a folder outside the source to which a file moves once the batch after its
    own has begun, so that listing the source stays cheap.
    """
    life = {"maxFilesPerTrigger": max_files, "maxBytesPerTrigger": max_bytes, "maxFileAge": max_age,
            "cleanSource": "archive" if archive else None, "sourceArchiveDir": archive}
    options = {**(options or {}), **{k: v for k, v in life.items() if v is not None}}
    opts = {k: (str(v).lower() if isinstance(v, bool) else str(v))
            for k, v in (options or {}).items()}
    if schema is None:
        if schema_path is None:
            raise ValueError("a streaming file source needs schema or schema_path")
        schema = stream_schema(spark, source, fmt, opts, schema_path)
    if rescue is None:
        df = spark.readStream.format(fmt).options(**opts).schema(schema).load(source)
        return with_provenance(df, provenance) if provenance else df
    if fmt != "csv":
        raise ValueError("rescue is for delimited text")
    text = all_string_schema(schema.names).add(_RECORD, T.StringType())
    opts.pop("inferSchema", None)
    df = (spark.readStream.format(fmt).options(**opts, columnNameOfCorruptRecord=_RECORD, mode="PERMISSIVE")
          .schema(text).load(source))
    lost = []
    for f in schema.fields:
        kept = F.expr(f"try_cast(`{f.name}` AS {f.dataType.simpleString()})")
        lost.append(F.when(F.col(f.name).isNotNull() & kept.isNull(), F.struct(F.lit(f.name).alias("k"), F.col(f.name).alias("v"))))
    lost.append(F.when(F.col(_RECORD).isNotNull(), F.struct(F.lit(_RECORD).alias("k"), F.col(_RECORD).alias("v"))))
    found = F.filter(F.array(*lost), lambda x: x.isNotNull())
    out = df.select(
        *[F.expr(f"try_cast(`{f.name}` AS {f.dataType.simpleString()})").alias(f.name) for f in schema.fields],
        F.when(F.size(found) > 0, F.to_json(F.map_from_entries(found))).alias(rescue),
        *([F.col("_metadata.file_path").alias(provenance)] if provenance else []))
    return out
