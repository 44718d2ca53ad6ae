"""Statistics-, reference- and payload-shaped views over the driver's tables.

The trending pipeline has no public sample data, so the registered queries
derive their inputs from the star-schema test tables. Every view is a lazy
join/projection over whole tables; nothing is sampled or capped, so the work
grows with the scale factor.

Mapping (statistics): one lineitem = one trending row.
    video_id      <- l_partkey (text)      trending_date_parsed <- l_shipdate
    title         <- p_name                channel_title        <- s_name
    category_id   <- s_nationkey           region               <- lower(r_name)
    views/likes/dislikes/comment_count <- extendedprice, quantity*100,
                                          discount*100, tax*100
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from trendflow.config import MAX_ITEMS_PER_PAGE


#: Session setting: number of tasks over which fact tables are spread.
SPREAD = "spark.trendflow.spreadTasks"
#: A category id that no lookup entry has.
UNLISTED_CATEGORY = 99


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def fact_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A fact table, one task per file split.

    A file stored as a single Parquet row group cannot be split. Local runs
    over such files (tests, bench) may set ``SPREAD`` to a number of tasks, to
    which the rows are then dealt round-robin; a cluster leaves it unset.
    """
    df = table(spark, sf_dir, name)
    tasks = spark.conf.get(SPREAD, None)
    return df.repartition(int(tasks)) if tasks else df


def _geo(spark: SparkSession, sf_dir: str) -> DataFrame:
    """nation -> region names (25 rows by the star schema's definition)."""
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    region = table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    return nation.join(region, nation.n_regionkey == region.r_regionkey)


def _lineitem_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    lineitem = fact_table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
        "l_extendedprice", "l_discount", "l_tax", "l_shipdate")
    part = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_type")
    supplier = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_nationkey")
    return (
        lineitem
        .join(part, lineitem.l_partkey == part.p_partkey)
        .join(supplier, lineitem.l_suppkey == supplier.s_suppkey)
        .join(_geo(spark, sf_dir), F.col("s_nationkey") == F.col("n_nationkey"))
    )


def statistics_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed statistics rows (Silver input shape, before metrics); by a fixed
    rule on the order key some rows have a category without an entry."""
    category = F.when(F.col("l_orderkey") % 103 == 0, UNLISTED_CATEGORY).otherwise(F.col("s_nationkey"))
    return _lineitem_facts(spark, sf_dir).select(
        F.col("l_partkey").cast("string").alias("video_id"),
        F.col("l_shipdate").cast("date").alias("trending_date_parsed"),
        F.col("p_name").alias("title"),
        F.col("s_name").alias("channel_title"),
        category.cast("bigint").alias("category_id"),
        F.floor("l_extendedprice").cast("bigint").alias("views"),
        F.floor(F.col("l_quantity") * 100).cast("bigint").alias("likes"),
        F.round(F.col("l_discount") * 100).cast("bigint").alias("dislikes"),
        F.round(F.col("l_tax") * 100).cast("bigint").alias("comment_count"),
        F.lower("r_name").alias("region"),
    )


def statistics_with_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Statistics rows with missing, zero and negative metrics injected by a
    fixed rule on the order key (every row is kept)."""
    ok = F.col("l_orderkey")
    facts = _lineitem_facts(spark, sf_dir)
    views = F.floor("l_extendedprice").cast("bigint")
    return facts.select(
        F.col("l_partkey").cast("string").alias("video_id"),
        F.col("l_shipdate").cast("date").alias("trending_date_parsed"),
        F.when(ok % 89 == 0, F.lit(None)).otherwise(F.col("p_name")).alias("title"),
        F.when(ok % 83 == 0, F.lit(None)).otherwise(F.col("s_name")).alias("channel_title"),
        F.col("s_nationkey").cast("bigint").alias("category_id"),
        F.when(ok % 97 == 0, F.lit(None).cast("bigint"))
         .when(ok % 79 == 0, F.lit(0).cast("bigint"))
         .when(ok % 73 == 0, -views)
         .otherwise(views).alias("views"),
        F.when(ok % 71 == 0, F.lit(None).cast("bigint"))
         .otherwise(F.floor(F.col("l_quantity") * 100).cast("bigint")).alias("likes"),
        F.when(ok % 67 == 0, F.lit(None).cast("bigint"))
         .otherwise(F.round(F.col("l_discount") * 100).cast("bigint")).alias("dislikes"),
        F.when(ok % 61 == 0, F.lit(None).cast("bigint"))
         .otherwise(F.round(F.col("l_tax") * 100).cast("bigint")).alias("comment_count"),
        F.lower("r_name").alias("region"),
    )


def flat_bronze_view(spark: SparkSession, sf_dir: str, keep: Column | None = None,
                     extra: dict[str, Column] | None = None) -> DataFrame:
    """Statistics rows as raw CSV text (every column a string), with junk
    values injected by a fixed rule: null ids, non-numeric and fractional
    counts, unknown flags, padded upper-case regions. All rows are kept, or
    those of the line items for which ``keep`` holds (a delivery). ``extra``
    columns of the line items follow the others."""
    ok = F.col("l_orderkey")
    ln = F.col("l_linenumber")
    views = F.floor("l_extendedprice").cast("bigint").cast("string")
    flag = F.when(ln == 1, F.lit("true")).when(ln == 2, F.lit("maybe")).otherwise(F.lit("false"))
    facts = _lineitem_facts(spark, sf_dir)
    facts = facts if keep is None else facts.where(keep)
    return facts.select(
        F.when(ok % 101 == 0, F.lit(None)).otherwise(F.col("l_partkey").cast("string")).alias("video_id"),
        F.col("l_shipdate").cast("date").cast("string").alias("trending_date"),
        F.col("p_name").alias("title"),
        F.col("s_name").alias("channel_title"),
        F.when(ok % 53 == 0, F.lit("n/a"))
         .otherwise(F.col("s_nationkey").cast("string")).alias("category_id"),
        F.col("l_shipdate").cast("string").alias("publish_time"),
        F.col("p_type").alias("tags"),
        F.when(ok % 97 == 0, F.lit("n/a"))
         .when(ok % 59 == 0, F.concat(views, F.lit(".75")))
         .otherwise(views).alias("views"),
        F.when(ok % 71 == 0, F.lit(None))
         .otherwise(F.floor(F.col("l_quantity") * 100).cast("bigint").cast("string")).alias("likes"),
        F.when(ok % 67 == 0, F.lit(""))
         .otherwise(F.round(F.col("l_discount") * 100).cast("bigint").cast("string")).alias("dislikes"),
        F.round(F.col("l_tax") * 100).cast("bigint").cast("string").alias("comment_count"),
        F.lit(None).cast("string").alias("thumbnail_link"),
        flag.alias("comments_disabled"),
        F.lit("false").alias("ratings_disabled"),
        F.lit("False").alias("video_error_or_removed"),
        F.col("p_type").alias("description"),
        F.concat(F.lit(" "), F.upper("r_name"), F.lit(" ")).alias("region"),
        *[c.alias(name) for name, c in (extra or {}).items()],
    )


def api_payload_view(spark: SparkSession, sf_dir: str, keep: Column | None = None) -> DataFrame:
    """API-shaped payload documents: one document per order, whose line
    items are the videos (an order has a bounded number of lines, like an
    API page). Counts are text, as the API returns them; every fourth line
    lacks its dislike count, like videos with hidden ratings. ``keep`` as above."""
    facts = _lineitem_facts(spark, sf_dir)
    facts = facts if keep is None else facts.where(keep)
    item = F.struct(
        F.col("l_partkey").cast("string").alias("id"),
        F.struct(
            F.col("p_name").alias("title"),
            F.col("s_name").alias("channelTitle"),
            F.col("s_nationkey").cast("string").alias("categoryId"),
            F.col("l_shipdate").cast("string").alias("publishedAt"),
            F.split("p_type", " ").alias("tags"),
            F.col("p_type").alias("description"),
            F.struct(F.struct(F.concat(F.lit("thumb/"), F.col("l_partkey").cast("string"))
                              .alias("url")).alias("default")).alias("thumbnails"),
        ).alias("snippet"),
        F.struct(
            F.floor("l_extendedprice").cast("bigint").cast("string").alias("viewCount"),
            F.floor(F.col("l_quantity") * 100).cast("bigint").cast("string").alias("likeCount"),
            F.when(F.col("l_linenumber") % 4 == 0, F.lit(None).cast("string"))
             .otherwise(F.round(F.col("l_discount") * 100).cast("bigint").cast("string"))
             .alias("dislikeCount"),
            F.round(F.col("l_tax") * 100).cast("bigint").cast("string").alias("commentCount"),
        ).alias("statistics"),
    )
    docs = facts.groupBy("l_orderkey", F.lower("r_name").alias("region"),
                         F.col("l_shipdate").cast("date").alias("ship_day")).agg(
        F.array_sort(F.collect_list(F.struct(F.col("l_linenumber").alias("pos"), item.alias("item"))))
        .alias("lines"),
        F.max("l_shipdate").alias("ingested"),
    )
    return docs.select(
        F.col("l_orderkey").alias("document_id"),
        F.transform("lines", lambda x: x["item"]).alias("items"),
        F.struct(
            F.date_format("ingested", "yyyyMMdd_HHmmss").alias("ingestion_id"),
            F.col("region").alias("region"),
            F.date_format("ingested", "yyyy-MM-dd'T'HH:mm:ss").alias("ingestion_timestamp"),
            F.lit(None).cast("bigint").alias("video_count"),
            F.lit("test_tables").alias("source"),
        ).alias("_pipeline_metadata"),
        F.col("ship_day"),
    )


def category_lookup_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reference rows (category_id, category_name, region) from nation/region."""
    return _geo(spark, sf_dir).select(
        F.col("n_nationkey").cast("bigint").alias("category_id"),
        F.col("n_name").alias("category_name"),
        F.lower("r_name").alias("region"),
    )


def category_documents_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Category documents (``kind``, ``etag``, ``items[]``) built from the
    supplier table: suppliers of a region are paged into documents of at
    most 50 items; an item's id is the supplier's nation (so ids repeat
    inside a document) and its title the supplier name. Junk ids, fractional
    ids, null ids and null titles are injected by a fixed rule."""
    supplier = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_nationkey")
    sk = F.col("s_suppkey")
    rows = supplier.join(_geo(spark, sf_dir), F.col("s_nationkey") == F.col("n_nationkey"))
    item_id = (
        F.when(sk % 17 == 0, F.lit(None).cast("string"))
        .when(sk % 13 == 0, F.concat(F.lit("x"), sk.cast("string")))
        .when(sk % 11 == 0, F.concat(F.col("s_nationkey").cast("string"), F.lit(".5")))
        .otherwise(F.col("s_nationkey").cast("string"))
    )
    title = F.when(sk % 19 == 0, F.lit(None).cast("string")).otherwise(F.col("s_name"))
    item = F.struct(
        F.lit("videoCategory").alias("kind"),
        F.concat(F.lit("e"), sk.cast("string")).alias("etag"),
        item_id.alias("id"),
        F.struct(F.lit("channel").alias("channelId"), title.alias("title"),
                 F.lit(True).alias("assignable")).alias("snippet"),
    )
    page = F.floor(sk / MAX_ITEMS_PER_PAGE)
    docs = rows.groupBy(F.lower("r_name").alias("region"), page.alias("page")).agg(
        F.array_sort(F.collect_list(F.struct(sk.alias("pos"), item.alias("item")))).alias("lines"))
    return docs.select(
        "region", "page",
        F.lit("videoCategoryListResponse").alias("kind"),
        F.concat(F.lit("p"), F.col("page").cast("string")).alias("etag"),
        F.transform("lines", lambda x: x["item"]).alias("items"),
    )


def category_items_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Category items as flat rows, a page per supplier so that the highest
    supplier's name wins; junk, fractional and null ids and null titles by the
    same rules as in the documents."""
    supplier = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_nationkey")
    sk = F.col("s_suppkey")
    nation = F.col("s_nationkey").cast("string")
    rows = supplier.join(_geo(spark, sf_dir), F.col("s_nationkey") == F.col("n_nationkey"))
    return rows.select(
        F.when(sk % 17 == 0, F.lit(None).cast("string")).when(sk % 13 == 0, F.concat(F.lit("x"), sk.cast("string")))
        .when(sk % 11 == 0, F.concat(nation, F.lit(".5"))).otherwise(nation).alias("item_id"),
        F.when(sk % 19 == 0, F.lit(None).cast("string")).otherwise(F.col("s_name")).alias("title"),
        F.concat(F.lit(" "), F.col("r_name")).alias("region"), sk.alias("page"))


def raw_dates_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw trending-date text in four shapes, from event timestamps:
    `yy.dd.MM`, ISO date, an impossible `24.32.13`, and junk."""
    events = table(spark, sf_dir, "events").select("event_id", "ts")
    kind = F.col("event_id") % 4
    text = (
        F.when(kind == 0, F.date_format("ts", "yy.dd.MM"))
        .when(kind == 1, F.date_format("ts", "yyyy-MM-dd"))
        .when(kind == 2, F.lit("24.32.13"))
        .otherwise(F.lit("garbage"))
    )
    return events.select("event_id", "ts", text.alias("trending_date"))


def object_keys_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landing object keys, one per supplier: plain ``region=`` keys,
    URL-encoded keys, and keys with no region segment."""
    supplier = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    rows = supplier.join(_geo(spark, sf_dir), F.col("s_nationkey") == F.col("n_nationkey"))
    kind = F.col("s_suppkey") % 3
    name = F.concat(F.lit("s"), F.col("s_suppkey").cast("string"), F.lit(".json"))
    reg = F.regexp_replace(F.upper("r_name"), " ", "_")
    key = (
        F.when(kind == 0, F.concat(F.lit("landing/raw/region="), reg, F.lit("/"), name))
        .when(kind == 1, F.concat(F.lit("landing/raw/region%3D"), reg, F.lit("/date%3D2024-01-01/"), name))
        .otherwise(F.concat(F.lit("landing/raw/"), name))
    )
    return rows.select("s_suppkey", key.alias("object_key"))


def event_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events paged like API responses: one page per (event_type, block of
    50 consecutive event ids), so a page never exceeds 50 items. The page's
    stamp is its latest event time; the event type stands in for the
    region."""
    events = table(spark, sf_dir, "events").select("event_id", "ts", "event_type", "value")
    page = F.floor(F.col("event_id") / MAX_ITEMS_PER_PAGE)
    docs = events.groupBy(F.col("event_type"), page.alias("page")).agg(
        F.array_sort(F.collect_list(F.struct("event_id", "value"))).alias("items"),
        F.max("ts").alias("ingested"))
    return docs
