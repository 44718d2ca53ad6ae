"""Registered queries: each takes (spark, sf_dir) and returns a DataFrame
over the driver's whole tables; ``ORACLE_SQL`` holds the DuckDB text that
must give the same rows (audit timestamps are never part of an output)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trendflow.functions.dates import parse_trending_date
from trendflow.functions.paths import decode_key, region_from_path
from trendflow.operators import aggregate as agg
from trendflow.operators import quality as dq
from trendflow.operators.cleanse import bad_flat_rows, cast_flat, cleanse, fill_metric_zeros, flatten_api, with_ratios
from trendflow.operators.dedup import latest_statistics
from trendflow.operators.enrich import (
    category_lookup, enrich, join_categories, unmatched_count,
)
from trendflow.operators.envelope import attach_envelope
from trendflow.operators.reference import document_report, reference_rows
from trendflow.operators.cleanse import CLEAN_COLUMNS
from trendflow.plans.gold import read_gold
from trendflow.plans.orchestrate import Layout, run_all
from trendflow.plans.silver import build_silver_statistics
from trendflow.session import scratch_path, tidy_shuffles
from trendflow.sinks.parquet import land_reference, write_table
from trendflow.sources import bronze
from trendflow.sources import tables as src
from trendflow.streaming.incremental import incremental_silver

Query = Callable[[SparkSession, str], DataFrame]


# ----------------------------------------------------------------- inputs --

def silver_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Statistics mapping -> zero-fill, ratios (P8-P10) -> latest row (D1)."""
    return latest_statistics(with_ratios(fill_metric_zeros(src.statistics_view(spark, sf_dir))))


def gold_input(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver view enriched with category names (P19, D3, J1, P20)."""
    return enrich(silver_view(spark, sf_dir), src.category_lookup_view(spark, sf_dir))


# ---------------------------------------------------------------- queries --

def q_region_prune_scan(spark, sf_dir):
    """S1 + P6: statistics stored by region, joined to the wanted rows of the
    region table; the scan opens those regions' folders only (dynamic partition
    pruning). Runs a job when called, as it writes the table."""
    path = scratch_path(spark, "by-region")
    stats = src.statistics_view(spark, sf_dir).select("video_id", "region", "trending_date_parsed", "views")
    write_table(stats, path)
    wanted = src.table(spark, sf_dir, "region").where(F.col("r_name").isin("AMERICA", "ASIA", "EUROPE"))
    wanted = wanted.select(F.lower("r_name").alias("region"))
    return spark.read.schema(stats.schema).parquet(path).join(wanted, "region").select(stats.columns)


def q_csv_bad_records(spark, sf_dir):
    """M2 for CSV: the statistics land as CSV text in which, by fixed rules on
    the order key, records end early, have fields to spare or no video id; counts
    per region and reason. Runs a job when called, as it writes files."""
    path = scratch_path(spark, "bad-csv")
    order = F.col("l_orderkey")
    flat = src.flat_bronze_view(spark, sf_dir, extra={"_order": order})
    names = [c for c in flat.columns if c not in ("region", "_order")]
    quoted = [F.concat(F.lit('"'), F.replace(F.coalesce(F.col(c), F.lit("")), F.lit('"'), F.lit('""')), F.lit('"')) for c in names]
    values = [F.when(F.col(c).isNull(), "").otherwise(q) for c, q in zip(names, quoted, strict=True)]
    whole = F.concat_ws(",", *values)
    line = (F.when(F.col("_order") % 37 == 0, F.concat_ws(",", *values[:5]))
            .when(F.col("_order") % 41 == 0, F.concat_ws(",", whole, F.lit("spare"), F.lit('"two, of them"'))).otherwise(whole))
    flat.select(line.alias("value"), F.upper(F.trim("region")).alias("region")).write.partitionBy("region").option(
        "lineSep", "\n").text(path)
    rows = bronze.read_flat_statistics(spark, path, regions=None, bad_records=True, header=False)
    return bad_flat_rows(rows).groupBy("region", "reason").agg(F.count(F.lit(1)).alias("n"), F.max("fields").alias("fields"))


def q_flat_cast(spark, sf_dir):
    """P4 + P5 + P6-P10 on raw CSV-shaped text."""
    typed = cast_flat(src.flat_bronze_view(spark, sf_dir))
    return cleanse(typed).select(*[c for c in CLEAN_COLUMNS if c != "_ingested_at"])


def q_nested_flatten(spark, sf_dir):
    """S3 + P2 + P3: API payload documents flattened to the flat columns."""
    flat = flatten_api(src.api_payload_view(spark, sf_dir))
    return flat.select(
        "video_id", "trending_date", "title", "channel_title", "category_id", "publish_time",
        "tags", "views", "likes", "dislikes", "comment_count", "thumbnail_link",
        "comments_disabled", "region")


def q_trending_date_parse(spark, sf_dir):
    """P7: `yy.dd.MM`, ISO, impossible and junk date text."""
    raw = src.raw_dates_view(spark, sf_dir)
    return raw.select("event_id", "trending_date",
                      parse_trending_date("trending_date").alias("trending_date_parsed"))


def q_metric_ratios(spark, sf_dir):
    """P8-P10 with null, zero and negative metrics."""
    out = with_ratios(fill_metric_zeros(src.statistics_with_gaps(spark, sf_dir)))
    return out.select("video_id", "region", "trending_date_parsed", "views", "likes", "dislikes",
                      "comment_count", "like_ratio", "engagement_rate")


def q_silver_statistics(spark, sf_dir):
    """P1-P11 + D1: raw CSV-shaped text -> Silver rows (audit stamps and the
    per-run delivery time left out of the compared output)."""
    silver = build_silver_statistics(src.flat_bronze_view(spark, sf_dir))
    return silver.select(*[c for c in CLEAN_COLUMNS if c != "_ingested_at"])


def q_dedup_latest(spark, sf_dir):
    """D1 + W1: one row per (video_id, region, trending_date_parsed)."""
    return silver_view(spark, sf_dir)


def q_reference_explode(spark, sf_dir):
    """S4 + P13-P17 + D4 + D2: category documents -> reference rows; documents
    of lower page numbers are delivered later."""
    docs = src.category_documents_view(spark, sf_dir)
    docs = docs.withColumn("_delivered_at", F.timestamp_seconds(-F.col("page")))
    return reference_rows(docs, document_cols=["region", "page"]).select(
        "category_id", "category_name", "region")


def q_reference_spellings(spark, sf_dir):
    """P14: reference rows that come flat, not as documents, in each spelling of
    their id and title columns: renamed already, joined by a mark, and dotted."""
    rows = src.category_items_view(spark, sf_dir)
    spelled = {"renamed": ("category_id", "category_name"), "marked": ("id", "snippet_title"), "dotted": ("id", "snippet.title")}
    out = None
    for kind, (cid, name) in spelled.items():
        frame = rows.select(F.col("item_id").alias(cid), F.col("title").alias(name), "region", "page", F.lit("kept").alias("etag"))
        part = reference_rows(frame, document_cols=["page"]).select("category_id", "category_name", "region", F.lit(kind).alias("spelling"))
        out = part if out is None else out.unionByName(part)
    return out


def q_reference_report(spark, sf_dir):
    """M2 + P18: per-document item counts and errors of the reference lane, with
    unreadable and empty documents among them."""
    docs = src.category_documents_view(spark, sf_dir)
    kind = F.col("page") % 3
    docs = (docs.withColumn("_corrupt_record", F.when(kind == 1, "{"))
            .withColumn("items", F.when(kind == 2, F.slice("items", 1, 0)).otherwise(F.col("items"))))
    return document_report(docs, ["region", "page"])


def q_category_lookup_join(spark, sf_dir):
    """P19 + D3 + J1 + P20."""
    return gold_input(spark, sf_dir).select(
        "video_id", "region", "trending_date_parsed", "category_id", "category_name", "views")


def q_unmatched_categories(spark, sf_dir):
    """J2: rows with no category after the join."""
    joined = join_categories(silver_view(spark, sf_dir),
                             category_lookup(src.category_lookup_view(spark, sf_dir)))
    return unmatched_count(joined)


def q_trending_analytics(spark, sf_dir):
    """A1."""
    return agg.trending_analytics(gold_input(spark, sf_dir))


def q_channel_analytics(spark, sf_dir):
    """A2 + W2."""
    return agg.channel_analytics(gold_input(spark, sf_dir))


def q_channel_top_k(spark, sf_dir):
    """W2 + rank filter: top 10 channels per region."""
    return agg.top_channels(gold_input(spark, sf_dir), 10).select(
        "region", "channel_title", "total_views", "rank_in_region")


def q_category_analytics(spark, sf_dir):
    """A3 + W3."""
    return agg.category_analytics(gold_input(spark, sf_dir))


def q_dq_inflight(spark, sf_dir):
    """Q1 + Q2 on statistics with injected gaps."""
    return dq.inflight_counts(src.statistics_with_gaps(spark, sf_dir))


def _dq_tables(spark, sf_dir, extra_missing: bool = False):
    tables = {
        "clean_statistics": lambda: src.statistics_with_gaps(spark, sf_dir),
        "clean_reference_data": lambda: src.category_lookup_view(spark, sf_dir),
    }
    if extra_missing:
        tables["clean_missing"] = lambda: spark.read.parquet(f"{sf_dir.rstrip('/')}/clean_missing.parquet")
    return tables


def q_dq_report(spark, sf_dir):
    """Q3-Q6 + Q8 for the two Silver-shaped tables."""
    return dq.quality_report(spark, _dq_tables(spark, sf_dir)).select(
        "check", "table", "column", "passed", "value", "negative", "extreme", "error",
        F.array_join("missing", ",").alias("missing"))


def q_dq_verdict(spark, sf_dir):
    """Q7 + Q9 + Q10: one table is absent; verdict over all results."""
    return dq.verdict(dq.quality_report(spark, _dq_tables(spark, sf_dir, extra_missing=True)))


def q_payload_envelope(spark, sf_dir):
    """P21 + P22: event pages wrapped in the ingest envelope."""
    pages = src.event_pages(spark, sf_dir)
    docs = attach_envelope(pages, "ingested", F.concat(F.lit(" "), F.upper("event_type")))
    return docs.select(
        F.col("_pipeline_metadata.ingestion_id").alias("ingestion_id"),
        F.col("_pipeline_metadata.region").alias("region"),
        F.col("_pipeline_metadata.ingestion_timestamp").alias("ingestion_timestamp"),
        F.col("_pipeline_metadata.video_count").alias("video_count"),
        F.col("_pipeline_metadata.source").alias("source"),
        "date", "hour", "page")


def q_region_from_path(spark, sf_dir):
    """S8 + S9: region of URL-encoded and plain landing keys."""
    keys = src.object_keys_view(spark, sf_dir)
    return keys.select("s_suppkey", "object_key", decode_key("object_key").alias("decoded_key"),
                       region_from_path("object_key").alias("region"))


def land_flat_delivery(spark, sf_dir, bronze_path, keep):
    """One delivery of gzipped CSV files under ``region=<NAME>/``. A key's rows
    share a file, hence a delivery time."""
    flat = src.flat_bronze_view(spark, sf_dir, keep=keep).withColumn("region", F.upper(F.trim("region")))
    with tidy_shuffles(spark):
        (flat.repartition("region", "video_id", "trending_date").write.mode("append").option("header", True)
         .option("escape", '"').option("compression", "gzip").partitionBy("region").csv(bronze_path))


def q_bronze_incremental(spark, sf_dir):
    """S7: the even orders, the odd ones, and every fifth order again land as
    CSV one after the other; each delivery is merged into Silver by a run of its
    own. Returns Silver. Runs its jobs when called, as it writes tables."""
    root = scratch_path(spark, "incremental")
    order = F.col("l_orderkey")
    for keep in (order % 2 == 0, order % 2 == 1, order % 5 == 0):
        land_flat_delivery(spark, sf_dir, f"{root}/bronze", keep)
        incremental_silver(spark, f"{root}/bronze", f"{root}/staging", f"{root}/silver", f"{root}/checkpoint", regions=None)
    return spark.read.parquet(f"{root}/silver").select(*[c for c in CLEAN_COLUMNS if c != "_ingested_at"])


def q_pipeline_end_to_end(spark, sf_dir):
    """O1: CSV of the even orders and API documents of the odd ones land under
    one Bronze prefix in shared scratch; both lanes, the quality gate and Gold
    run over it. Returns the stored Gold category table. Runs its jobs when
    called, as it writes tables.
    """
    root = scratch_path(spark, "end-to-end")
    layout = Layout(f"{root}/bronze/statistics", f"{root}/bronze/reference", f"{root}/silver", f"{root}/gold")
    even = F.col("l_orderkey") % 2 == 0
    land_flat_delivery(spark, sf_dir, layout.bronze_statistics, even)
    api = src.api_payload_view(spark, sf_dir, keep=~even)
    with tidy_shuffles(spark):
        (api.select("items", "_pipeline_metadata", F.upper("_pipeline_metadata.region").alias("region"),
                    F.lit("2024-01-01").alias("date"), F.lit("03").alias("hour"))
         .write.mode("append").option("compression", "gzip").partitionBy("region", "date", "hour").json(layout.bronze_statistics))
    item = F.struct(F.col("category_id").cast("string").alias("id"),
                    F.struct(F.col("category_name").alias("title")).alias("snippet"))
    # one document per region, of the few nations that it has
    land_reference(src.category_lookup_view(spark, sf_dir).groupBy(F.upper("region").alias("region"))
                   .agg(F.collect_list(item).alias("items")), layout.bronze_reference)
    result = run_all(spark, layout, fmt="mixed", regions=None, multi_line=False)
    if result.gold is None:
        raise RuntimeError(f"quality gate: {result.quality_results}")
    return read_gold(spark, layout.gold_root, "category_analytics").drop("_aggregated_at")


QUERIES: dict[str, Query] = {
    "region_prune_scan": q_region_prune_scan,
    "csv_bad_records": q_csv_bad_records,
    "flat_cast": q_flat_cast,
    "nested_flatten": q_nested_flatten,
    "trending_date_parse": q_trending_date_parse,
    "metric_ratios": q_metric_ratios,
    "dedup_latest": q_dedup_latest,
    "silver_statistics": q_silver_statistics,
    "bronze_incremental": q_bronze_incremental,
    "reference_explode": q_reference_explode,
    "reference_spellings": q_reference_spellings,
    "reference_report": q_reference_report,
    "category_lookup_join": q_category_lookup_join,
    "unmatched_categories": q_unmatched_categories,
    "trending_analytics": q_trending_analytics,
    "channel_analytics": q_channel_analytics,
    "channel_top_k": q_channel_top_k,
    "category_analytics": q_category_analytics,
    "dq_inflight": q_dq_inflight,
    "dq_report": q_dq_report,
    "dq_verdict": q_dq_verdict,
    "payload_envelope": q_payload_envelope,
    "region_from_path": q_region_from_path,
    "pipeline_end_to_end": q_pipeline_end_to_end,
}
