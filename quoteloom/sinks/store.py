"""Partitioned Parquet tables: upsert, pruned reads, statistics, retention."""

from __future__ import annotations

import json
import re
import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import utc_day_string
from ..operators.blocks import join_keys
from ..operators.tables import merge, natural_key
from ..session import shared_dir

DAY_MS = 86_400_000
PARTITIONS = ["exchange", "data_type", "symbol", "date"]
COMPRESSION = "zstd"


def _hadoop_path(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


SCHEMA_FILE = "_schema.json"


def declared_schema(spark: SparkSession, path: str) -> T.StructType | None:
    """The schema kept next to the table's data, so that no read has to open footers."""
    fs, p = _hadoop_path(spark, f"{path.rstrip('/')}/{SCHEMA_FILE}")
    if not fs.exists(p):
        return None
    stream = fs.open(p)
    try:
        return T.StructType.fromJson(json.loads(spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")))
    finally:
        stream.close()


def _declare(spark: SparkSession, path: str, schema: T.StructType) -> None:
    fs, p = _hadoop_path(spark, f"{path.rstrip('/')}/{SCHEMA_FILE}")
    stream = fs.create(p, True)
    try:
        stream.write(bytearray(schema.json().encode()))
    finally:
        stream.close()


def table_exists(spark: SparkSession, path: str) -> bool:
    """Whether the folder holds a table: a schema, or data files of another writer."""
    if declared_schema(spark, path) is not None:
        return True
    fs, p = _hadoop_path(spark, path)
    if not fs.exists(p):
        return False
    found = fs.listFiles(p, True)
    while found.hasNext():
        if found.next().getPath().getName().endswith(".parquet"):
            return True
    return False


def _as_text(schema: T.StructType, parts: list[str]) -> T.StructType:
    return T.StructType([T.StructField(f.name, T.StringType() if f.name in parts else f.dataType) for f in schema])


def read_table(spark: SparkSession, path: str, parts: list[str] | None = None) -> DataFrame:
    """The table with its partition columns as text, whatever the folder names look like
    (a timeframe ``1d`` would otherwise be read as the number 1.0).  The schema is the
    declared one; only a table of another writer has its footers merged."""
    schema = declared_schema(spark, path)
    if schema is None:
        schema = _as_text(spark.read.option("mergeSchema", "true").parquet(path).schema, parts or PARTITIONS)
    return spark.read.schema(schema).parquet(path)


def with_date(df: DataFrame, on: str = "timestamp") -> DataFrame:
    """Add the UTC date of an epoch-ms column as the partition column."""
    return df.withColumn("date", utc_day_string(F.col(on)))


def narrow(df: DataFrame, columns: list[str]) -> DataFrame:
    """Store the listed doubles with 32 bit."""
    return df.withColumns({c: F.col(c).cast("float") for c in columns if c in df.columns})


def overwrite_partitions(df: DataFrame, path: str, parts: list[str], order: list[str]) -> None:
    """Replace exactly the partitions that occur in ``df``.

    The rebalance hint brings the rows of a partition together at run time, merges small
    partitions into one task and splits a hot one over several; sorting inside the files
    gives readers statistics to skip by.
    """
    (
        df.hint("rebalance", *parts)
        .sortWithinPartitions(*parts, *order)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("compression", COMPRESSION)
        .partitionBy(*parts)
        .parquet(path)
    )


STAGE_DONE = "_staged_whole"


def _stage_root(spark: SparkSession, path: str) -> str:
    """Beside the table, on its file system; the underscore hides it from readers."""
    fs, p = _hadoop_path(spark, path)
    table = fs.makeQualified(p)
    return spark.sparkContext._jvm.org.apache.hadoop.fs.Path(table.getParent(), f"_staged-{table.getName()}").toString()


def _mark_whole(spark: SparkSession, stage: str) -> None:
    """From here on the stage replaces its partitions, whatever fails.  An own marker: a
    cluster may have the writer's success file switched off."""
    fs, p = _hadoop_path(spark, f"{stage}/{STAGE_DONE}")
    fs.create(p, True).close()


def finish_staged(spark: SparkSession, path: str, parts: list[str], columns: list[str]) -> None:
    """Complete what a failed upsert left: a whole stage replaces its partitions, one that
    was never finished is dropped, for the table was not touched yet."""
    fs, root = _hadoop_path(spark, _stage_root(spark, path))
    if not fs.exists(root):
        return
    for status in fs.listStatus(root):
        stage = status.getPath()
        if any(fs.exists(_hadoop_path(spark, f"{stage}/{name}")[1]) for name in (STAGE_DONE, "_SUCCESS")):
            _replace(spark, str(stage), path, parts, columns)
        fs.delete(stage, True)


def _replace(spark: SparkSession, stage: str, path: str, parts: list[str], columns: list[str]) -> None:
    merged = spark.read.parquet(stage)
    overwrite_partitions(merged, path, parts, columns)
    _declare(spark, path, _as_text(merged.schema, parts))


def upsert(
    incoming: DataFrame,
    path: str,
    keys: list[str] | None = None,
    parts: list[str] | None = None,
    order_by: list[str] | None = None,
    keep: str = "last",
) -> None:
    """Merge rows into the table: one row per key, the incoming one (``last``) or the
    stored one (``first``) winning.

    The batch is computed once.  The span of its dates prunes the table's folders before
    they are listed into tasks, and a semi-join keeps only the partitions that the batch
    touches.  A table can't be read and replaced in one job, so the merged rows are first
    written beside it; that copy goes only after the partitions are replaced, and the next
    upsert finishes one that a failure left.  An empty batch changes nothing, and the same
    batch again gives the same table.  One writer per table at a time.
    """
    spark = incoming.sparkSession
    parts = list(parts or [c for c in PARTITIONS if c in incoming.columns])
    keys = list(keys or natural_key(incoming))
    order = list(order_by or ["timestamp"])
    keyed = list(dict.fromkeys([*parts, *keys]))
    columns = [c for c in order if c not in parts]
    finish_staged(spark, path, parts, columns)
    incoming = incoming.persist()
    try:
        span = F.col("date") if "date" in parts else F.lit(None)
        first, last, undated, rows = incoming.agg(
            F.min(span.cast("string")), F.max(span.cast("string")), F.count_if(span.isNull()), F.count(F.lit(1))
        ).first()
        if not rows:
            return
        if table_exists(spark, path):
            kinds = incoming.schema
            stored = read_table(spark, path, parts)
            if "date" in parts:
                inside = F.col("date").between(first, last)
                stored = stored.filter(inside | F.col("date").isNull() if undated else inside)
            stored = stored.withColumns({c: F.col(c).cast(kinds[c].dataType) for c in parts})
            touched = incoming.select(*[F.col(c).alias(f"_{c}") for c in parts]).distinct()
            same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in parts])
            existing = stored.join(touched, same, "left_semi")
        else:
            existing = incoming.limit(0)
        stage = f"{_stage_root(spark, path)}/{uuid.uuid4().hex}"
        merge(existing, incoming, keyed, order, keep).write.option("compression", COMPRESSION).parquet(stage)
        _mark_whole(spark, stage)
        _replace(spark, stage, path, parts, columns)
        fs, p = _hadoop_path(spark, stage)
        fs.delete(p, True)
    finally:
        incoming.unpersist()


# -- reads ---------------------------------------------------------------------------


def load_range(table: DataFrame, start: str, end: str, name: str | None = None, column: str = "instrument_name") -> DataFrame:
    """Rows of the days from start to end; the date test prunes partitions."""
    out = table.filter(F.col("date").between(start, end))
    return out if name is None else out.filter(F.col(column) == name)


def load_latest_day(table: DataFrame, keys: list[str], today: str, look_back: int | None = 30) -> DataFrame:
    """Rows of each key's newest day among the last ``look_back`` days (None: of any age)."""
    recent = table.filter(F.col("date") <= today)
    if look_back is not None:
        recent = recent.filter(F.col("date") >= F.date_sub(F.lit(today).cast("date"), look_back - 1).cast("string"))
    newest = recent.groupBy(*keys).agg(F.max("date").alias("date"))
    return join_keys(recent, newest, keys, "left_semi", plain=("date",))


def store_stats(table: DataFrame, keys: list[str], on: str = "timestamp") -> DataFrame:
    """Rows, first and last time per stored series."""
    return table.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("row_count"), F.min(on).alias("start_time"), F.max(on).alias("end_time")
    )


def incremental_plan(universe: DataFrame, stats: DataFrame, keys: list[str], now_ms: int) -> DataFrame:
    """Where to go on per series: a day after its last row, one day back for a new one;
    series that are up to date are left out."""
    start = F.when(F.col("end_time").isNotNull(), F.col("end_time") + DAY_MS).otherwise(F.lit(now_ms - DAY_MS))
    return (
        universe.select(*keys)
        .distinct()
        .join(stats.select(*keys, "end_time"), keys, "left")
        .withColumn("start_ms", start)
        .withColumn("end_ms", F.lit(now_ms))
        .filter(F.col("end_time").isNull() | (F.col("start_ms") < now_ms))
        .select(*keys, F.col("end_time").alias("last_ms"), "start_ms", "end_ms")
    )


def query_rows(
    table: DataFrame, name: str | None = None, start_ms: int | None = None, end_ms: int | None = None,
    limit: int | None = None, on: str = "timestamp", column: str = "instrument_name", ties: list[str] | None = None,
) -> DataFrame:
    """Newest rows first, optionally of one instrument and time range; all of them unless a
    ``limit`` asks for the newest few."""
    out = table
    if name is not None:
        out = out.filter(F.col(column) == name)
    if start_ms is not None:
        out = out.filter(F.col(on) >= start_ms)
    if end_ms is not None:
        out = out.filter(F.col(on) <= end_ms)
    out = out.orderBy(F.desc(on), *(ties or []))
    return out if limit is None else out.limit(limit)


def count_by_day(table: DataFrame, on: str = "timestamp") -> DataFrame:
    return table.groupBy(utc_day_string(F.col(on)).alias("date")).agg(F.count(F.lit(1)).alias("rows"))


def levels_as_json(df: DataFrame, columns: list[str]) -> DataFrame:
    """Nested level columns as JSON text, for stores without nested types."""
    return df.withColumns({c: F.to_json(c) for c in columns})


# -- maintenance ---------------------------------------------------------------------


def files_of(spark: SparkSession, path: str) -> DataFrame:
    """Data files under a folder with their size; contents are not read."""
    listing = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", "*.parquet")
        .option("recursiveFileLookup", "true")
        .load(path)
    )
    return listing.select(F.col("_metadata.file_path").alias("path"), F.col("length").alias("bytes"))


def rename_files(spark: SparkSession, folder: str, old: str, new: str) -> None:
    """Change the ending of the data files in one folder."""
    fs, p = _hadoop_path(spark, folder)
    for status in fs.listStatus(p):
        name = status.getPath().toString()
        if name.endswith(old):
            fs.rename(status.getPath(), _hadoop_path(spark, name.removesuffix(old) + new)[1])


def _part_of(name: str) -> Column:
    value = F.regexp_extract("path", rf"/{name}=([^/]*)/", 1)
    return F.nullif(value, F.lit(""))


def retention_plan(files: DataFrame, today: str, keep_days: int = 14, execute: bool = False) -> DataFrame:
    """Per date partition: files, MB, and whether it is older than the days to keep."""
    day = _part_of("date").try_cast("date")
    cutoff = F.date_sub(F.lit(today).cast("date"), keep_days)
    return (
        files.withColumns({"partition": F.regexp_extract("path", r"^(.*/date=[^/]*)/", 1), "date": day})
        .filter(F.col("date").isNotNull())
        .groupBy("partition", "date")
        .agg(F.count(F.lit(1)).alias("files"), F.sum("bytes").alias("bytes"))
        .withColumns(
            {
                "size_mb": F.round(F.col("bytes") / (1024 * 1024), 2),
                "action": F.when(F.col("date") >= cutoff, "KEEP").otherwise("DELETE" if execute else "WOULD_DELETE"),
            }
        )
    )


def prune(spark: SparkSession, path: str, today: str, keep_days: int = 14, execute: bool = False) -> DataFrame:
    """The retention plan; with ``execute`` the listed partitions are dropped.  The plan
    has one row per date partition, so it is small enough to walk on the driver."""
    plan = retention_plan(files_of(spark, path), today, keep_days, execute)
    if execute:
        shared_dir(spark)
        plan = plan.checkpoint()  # the listing must not change under the deletion
        for row in plan.filter(F.col("action") == "DELETE").select("partition").toLocalIterator():
            fs, p = _hadoop_path(spark, row["partition"])
            fs.delete(p, True)
    return plan


def storage_audit(spark: SparkSession, path: str) -> DataFrame:
    """Files, bytes and rows per folder below ``path``; an unreadable file counts no rows.

    Row counts come from footers, so no data page is read.
    """
    root = rf"^.*{re.escape(path.rstrip('/').rpartition('/')[2])}(/.*)?/[^/]*$"
    folder = F.regexp_extract("path", root, 1).alias("folder")
    return files_of(spark, path).join(footers(spark, path), "path").groupBy(folder).agg(
        F.count(F.lit(1)).alias("files"), F.sum("bytes").alias("bytes"), F.sum("rows").alias("rows")
    )


def source_inventory(files: DataFrame) -> DataFrame:
    """Files and bytes per (exchange, data_type, symbol), from the partition folders."""
    named = files.withColumns({c: _part_of(c) for c in ("exchange", "data_type", "symbol")})
    return (
        named.filter(F.col("exchange").isNotNull() & F.col("data_type").isNotNull())
        .groupBy("exchange", "data_type", "symbol")
        .agg(F.count(F.lit(1)).alias("files"), F.sum("bytes").alias("bytes"))
    )


def footers(spark: SparkSession, path: str) -> DataFrame:
    """Rows per file, or the error that kept its footer from being read.

    Spark's reader counts rows from the footers, on any file system that it can list, and
    passes over what it can't read.  Files without a counted row (empty or broken ones) are
    then opened where they lie in the join, by ranged reads of the footer alone, on the file
    systems that pyarrow knows; another one is an error.  Neither names nor contents pass
    through the driver or make up a row.
    """
    counted = (
        spark.read.schema("_none int")
        .options(ignoreCorruptFiles=True, recursiveFileLookup=True, pathGlobFilter="*.parquet")
        .parquet(path)
        .groupBy(F.col("_metadata.file_path").alias("path"))
        .agg(F.count(F.lit(1)).alias("rows"))
    )

    def check(batches):
        from urllib.parse import unquote, urlsplit

        import pyarrow as pa
        from pyarrow import fs
        from pyarrow import parquet as pq

        stores = {}

        def store_of(parts):
            root = f"{'s3' if parts.scheme in ('s3a', 's3n') else parts.scheme}://{parts.netloc}/"
            if root not in stores:
                stores[root] = fs.FileSystem.from_uri(root)
            return stores[root]

        for batch in batches:
            rows, errors = batch.column("rows").to_pylist(), [None] * batch.num_rows
            for at, (file, known) in enumerate(zip(batch.column("path").to_pylist(), rows)):
                if known is not None:
                    continue
                parts = urlsplit(file)
                store, base = store_of(parts)
                try:
                    with store.open_input_file(base.rstrip("/") + unquote(parts.path)) as source:
                        rows[at] = pq.read_metadata(source).num_rows
                except Exception as exc:  # noqa: BLE001 - the failure is the result
                    rows[at], errors[at] = 0, type(exc).__name__
            columns = [batch.column("path"), pa.array(rows, pa.int64()), pa.array(errors, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, names=["path", "rows", "error"])

    found = files_of(spark, path).select("path").join(counted, "path", "left").select("path", "rows")
    return found.mapInArrow(check, "path string, rows long, error string")


def file_checks(spark: SparkSession, path: str) -> DataFrame:
    """Footers with what the status ladder needs: warnings for empty, errors for unreadable
    files and for files in an epoch-zero partition."""
    epoch_zero = F.contains("path", F.lit("/date=1970-01-01/"))
    return footers(spark, path).withColumns(
        {
            "date": _part_of("date"),
            **{c: _part_of(c) for c in ("exchange", "data_type", "symbol")},
            "warnings": F.lit(0).cast("long"),
            "errors": F.col("error").isNotNull().cast("long") + epoch_zero.cast("long"),
        }
    )
