"""S7: incremental Bronze -> Silver with Structured Streaming.

Only files that arrived since the last run are read (file-source checkpoint),
with an available-now trigger so the job processes what is there and stops.
The wanted regions are a filter on the stream's partition column, so folders of
other regions are not read. Each micro-batch goes through two writes and a move:

    <staging>/<stream>/batch=<id>/incoming   its cleansed rows (P1-P10)
    <staging>/<stream>/batch=<id>/merged     D1 over those rows and the stored
                                             rows of the months that they touch,
                                             in Silver's folders
    <silver>/region=<xx>/trending_month=<yyyymm>   replaced by the merged folders

D1's keys lie in one folder each, so folders are merged in rounds of bounded
size, and the shuffle files of a round are gone before the next one starts.

The survivors of D1 are the first rows of a total order, so merging stored
survivors with new rows gives what a replay of all history would: Silver is
read in the touched folders only, which are opened by name. A batch's entry in
``<staging>/manifest`` (one line of JSON: its folders and counts) is written
between the second and the third step. A run that dies before it starts the
batch again with Silver untouched; one that dies after it repeats only the
third step, for the folders that were not moved yet. What earlier batches staged
is deleted before a batch starts, and its incoming rows once they are merged, so
neither staging nor its listing grows with history; lines of the manifest are
folded into files of ``FOLD``.
"""

from __future__ import annotations

import datetime as _dt
import json
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trendflow.config import API_PAYLOAD_SCHEMA, FLAT_TEXT_SCHEMA, SILVER_PARTITIONS, SILVER_REGIONS
from trendflow.functions.dates import month_number
from trendflow.operators.cleanse import CLEAN_COLUMNS, cleanse, explode_items, to_flat, with_audit, with_ratios
from trendflow.operators.dedup import AUDIT_COLUMNS, merge_latest
from trendflow.plans.silver import STATS_JOB
from trendflow.sinks import files
from trendflow.sinks.parquet import observed, write_table
from trendflow.sources.bronze import region_filter

#: Manifest files of single batches that are folded into one.
FOLD = 50

MANIFEST_SCHEMA = ("stream string, batch long, folders array<struct<region: string, trending_month: int>>, "
                   "rows_read long, rows_staged long, rows_merged long")


def _stream(spark: SparkSession, bronze_path: str, fmt: str, regions: Iterable[str] | None, max_files: int | None) -> DataFrame:
    reader = spark.readStream
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    if fmt == "csv":
        schema = T.StructType(FLAT_TEXT_SCHEMA.fields + [T.StructField("region", T.StringType())])
        df = (reader.schema(schema).option("header", True).option("multiLine", True)
              .option("escape", '"').csv(bronze_path))
        df = df.withColumn("_ingested_at", F.col("_metadata.file_modification_time"))
    elif fmt == "json":
        schema = T.StructType(API_PAYLOAD_SCHEMA.fields + [T.StructField("region", T.StringType())])
        df = reader.schema(schema).option("multiLine", True).json(bronze_path)
    else:
        raise ValueError(f"unknown Bronze format {fmt!r}")
    return region_filter(df, regions)


def _stream_id(spark: SparkSession, checkpoint_path: str) -> str:
    """The id that the checkpoint has for good; batches are numbered within it."""
    return json.loads(files.read_text(spark, f"{checkpoint_path.rstrip('/')}/metadata"))["id"]


def incremental_silver(spark: SparkSession, bronze_path: str, staging_path: str,
                       silver_path: str, checkpoint_path: str, fmt: str = "csv",
                       regions: Iterable[str] | None = tuple(SILVER_REGIONS),
                       run_date: _dt.date | str | None = None,
                       max_files_per_batch: int | None = None) -> dict:
    """One incremental run. Returns the (region, month) folders that were
    replaced, the micro-batch ids, and per batch the rows read (videos), staged
    and merged (M1).

    ``checkpoint_path`` must be on shared storage (it is the stream's
    progress log); ``staging_path`` and ``silver_path`` must differ.
    """
    staging_path, silver_path = staging_path.rstrip("/"), silver_path.rstrip("/")
    if staging_path == silver_path:
        raise ValueError("staging and Silver must be separate folders")
    entries: list[dict] = []

    def take(batch: DataFrame, batch_id: int) -> None:
        stream = _stream_id(spark, checkpoint_path)
        home = f"{staging_path}/{stream}/batch={batch_id}"
        for name in files.children(spark, f"{staging_path}/{stream}"):
            if int(name.partition("=")[2]) < batch_id:  # committed long ago
                files.delete(spark, f"{staging_path}/{stream}/{name}")
        noted = files.read_text(spark, _entry_path(staging_path, stream, batch_id))
        entry = json.loads(noted) if noted else merge_batch(spark, batch, home, silver_path, run_date)
        entry |= {"stream": stream, "batch": batch_id}
        if not noted:
            files.replace_text(spark, _entry_path(staging_path, stream, batch_id), json.dumps(entry) + "\n")
        files.delete(spark, f"{home}/incoming")
        publish(spark, home, silver_path, entry)
        entries.append(entry)
        fold_manifest(spark, staging_path)

    query = (
        _stream(spark, bronze_path, fmt, regions, max_files_per_batch).writeStream
        .foreachBatch(take)
        .option("checkpointLocation", checkpoint_path)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    counts = ("batch", "rows_read", "rows_staged", "rows_merged")
    return {"partitions": sorted({folder for e in entries for folder in folders(e)}, key=repr),
            "batches": [e["batch"] for e in entries],
            "metrics": [{k: e[k] for k in counts} for e in entries]}


def folders(entry: dict) -> list[tuple]:
    return [(f["region"], f["trending_month"]) for f in entry["folders"]]


def _region_folder(region: str | None) -> str:
    """Folder in which a region's incoming rows lie (null apart from empty text)."""
    return "none" if region is None else f"r-{region}"


def merge_batch(spark: SparkSession, batch: DataFrame, home: str, silver_path: str,
                run_date: _dt.date | str | None = None) -> dict:
    """Stage a micro-batch, and merge it with the stored rows of its folders.

    The folders and counts are observed by the writes themselves. They are few:
    regions x months of one delivery.
    """
    videos, read = observed(explode_items(batch), "stream_read", rows=F.count(F.lit(1)))
    rows = with_audit(cleanse(to_flat(videos, run_date)).select(*CLEAN_COLUMNS), STATS_JOB)
    rows = rows.withColumn("trending_month", month_number("trending_date_parsed"))
    rows, staged = observed(rows, "stream_staged", rows=F.count(F.lit(1)),
                            folders=F.collect_set(F.struct(*SILVER_PARTITIONS)))
    laid = F.coalesce(F.concat(F.lit(_region_folder("")), F.col("region")), F.lit(_region_folder(None)))
    rows.withColumn("of", laid).write.mode("overwrite").partitionBy("of").parquet(f"{home}/incoming")
    touched = sorted(((f["region"], f["trending_month"]) for f in staged.get["folders"] or []), key=repr)
    files.delete(spark, f"{home}/merged")
    n = 0
    for some, part in merge_rounds(spark, f"{home}/incoming", silver_path, touched):
        merged, out = observed(merged_rows(spark, f"{home}/incoming", silver_path, rows.schema, some, part),
                               "stream_merged", rows=F.count(F.lit(1)))
        write_table(merged, f"{home}/merged", partition_by=SILVER_PARTITIONS, mode="append")
        n += out.get["rows"]
    return {"folders": [dict(zip(SILVER_PARTITIONS, f, strict=True)) for f in touched],
            "rows_read": read.get["rows"], "rows_staged": staged.get["rows"], "rows_merged": n}


def merge_rounds(spark: SparkSession, incoming_path: str, silver_path: str,
                 touched: list[tuple]) -> list[tuple[list[tuple], Column | None]]:
    """The touched folders dealt over rounds, each with the condition for its
    incoming rows (None: all): small regions together, a large one by months (its
    incoming rows are then read in each of its rounds, of which there are few)."""
    months: dict = {}
    for region, month in touched:
        months.setdefault(region, []).append(month)
    new = {r: files.size(spark, f"{incoming_path}/{files.folder_name('of', _region_folder(r))}") for r in months}
    region_path = {r: f"{silver_path}/{files.folder_name(SILVER_PARTITIONS[0], r)}" for r in months}
    # what is stored of other months counts here, so this may be more than is read
    bytes_of = {r: new[r] + files.size(spark, region_path[r]) for r in months}
    most = files.round_size(sum(bytes_of.values()))
    if sum(bytes_of.values()) <= most:
        return [(touched, None)] if touched else []
    rounds = []
    for some in files.packed({r: n for r, n in bytes_of.items() if n <= most}, most):
        rounds.append(([(r, m) for r in some for m in months[r]], F.col("of").isin([_region_folder(r) for r in some])))
    for region in (r for r, n in bytes_of.items() if n > most):
        stored = {m: files.size(spark, f"{region_path[region]}/{files.folder_name(SILVER_PARTITIONS[1], m)}") for m in months[region]}
        for some in files.packed({m: n + new[region] / len(stored) for m, n in stored.items()}, most):
            month = F.col("trending_month")
            held = month.isin([m for m in some if m is not None])
            rounds.append(([(region, m) for m in some],
                           (F.col("of") == _region_folder(region)) & ((held | month.isNull()) if None in some else held)))
    return rounds


def merged_rows(spark: SparkSession, incoming_path: str, silver_path: str, schema: T.StructType,
                touched: list[tuple], part: Column | None = None) -> DataFrame:
    """D1 over staged rows (those of ``part`` alone) and the stored rows of the
    touched folders (lazy). What follows from the other columns is derived again
    instead of being shuffled."""
    columns = [*CLEAN_COLUMNS, *AUDIT_COLUMNS, "trending_month"]
    sent = [c for c in columns if c not in ("like_ratio", "engagement_rate", "trending_month")]
    new = spark.read.schema(schema).parquet(incoming_path)
    new = (new if part is None else new.where(part)).select(*sent)
    stored = files.read_partitions(spark, silver_path, SILVER_PARTITIONS, touched, schema).select(*sent)
    rows = with_ratios(merge_latest(stored, new)).withColumn("trending_month", month_number("trending_date_parsed"))
    return rows.select(*columns)


def publish(spark: SparkSession, home: str, silver_path: str, entry: dict) -> None:
    """Replace the folders of an entry by its merged ones. Repeating it is harmless."""
    files.move_partitions(spark, f"{home}/merged", silver_path, SILVER_PARTITIONS, folders(entry))


# ---------------------------------------------------------------- manifest --

def _entry_path(staging_path: str, stream: str, batch_id: int) -> str:
    return f"{staging_path}/manifest/{stream}-{batch_id}.json"


def fold_manifest(spark: SparkSession, staging_path: str, fold: int = FOLD) -> None:
    """Once there are more than ``fold`` files of single batches, fold the oldest
    ``fold`` into one. The newest stays, as a batch that is repeated looks for it."""
    root = f"{staging_path}/manifest"
    single = [n for n in files.children(spark, root) if n.endswith(".json") and not n.startswith((".", "folded-"))]
    if len(single) <= fold:
        return
    single.sort(key=lambda n: (n.rpartition("-")[0], int(n.rpartition("-")[2].removesuffix(".json"))))
    old = single[:fold]
    text = "".join(files.read_text(spark, f"{root}/{n}") for n in old)
    files.replace_text(spark, f"{root}/folded-{old[0].removesuffix('.json')}.json", text)
    for n in old:
        files.delete(spark, f"{root}/{n}")


def read_manifest(spark: SparkSession, staging_path: str) -> DataFrame:
    """(stream, batch, region, trending_month, rows_read, rows_staged,
    rows_merged): the folders that each batch replaced. A batch is listed once,
    also if a run died while its file was folded."""
    return (spark.read.schema(MANIFEST_SCHEMA).json(f"{staging_path.rstrip('/')}/manifest")
            .dropDuplicates(["stream", "batch"])
            .select("stream", "batch", F.inline("folders"), "rows_read", "rows_staged", "rows_merged"))


def touched_since(spark: SparkSession, staging_path: str, seen: dict[str, int]) -> tuple[list[tuple], dict[str, int]]:
    """Folders that batches after ``seen`` (last batch per stream) replaced, and
    the last batch per stream now."""
    if not files.exists(spark, f"{staging_path.rstrip('/')}/manifest"):
        return [], dict(seen)
    manifest = read_manifest(spark, staging_path)
    last = F.lit(-1)
    for stream, batch in seen.items():
        last = F.when(F.col("stream") == stream, batch).otherwise(last)
    rows = manifest.where(F.col("batch") > last).select(*SILVER_PARTITIONS).distinct().collect()
    now = {r["stream"]: r["batch"] for r in manifest.groupBy("stream").agg(F.max("batch").alias("batch")).collect()}
    return sorted(((r[0], r[1]) for r in rows), key=repr), dict(seen) | now
