"""Bronze statistics -> typed, cleansed rows (format dispatch, flatten,
coercion, null handling, derived metrics, audit columns)."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trendflow.config import FLAT_COLUMNS, FLAT_NAMES, METRIC_COLUMNS
from trendflow.functions.coerce import normalise_region, try_bool, try_long, try_text
from trendflow.functions.dates import format_trending_date, parse_trending_date
from trendflow.functions.metrics import engagement_rate, like_ratio


# ---------------------------------------------------------------- dispatch --

def is_api_shape(df: DataFrame) -> bool:
    """True for API payload rows (nested, dotted or ``__``-flattened names)."""
    cols = set(df.columns)
    if "items" in cols:
        return True
    if "snippet.title" in cols or "snippet__title" in cols:
        return True
    snippet = _field_type(df.schema, ["snippet"])
    return isinstance(snippet, T.StructType)


def _field_type(schema: T.StructType, parts: list[str]):
    dtype: T.DataType = schema
    for part in parts:
        if not isinstance(dtype, T.StructType) or part not in dtype.fieldNames():
            return None
        dtype = dtype[part].dataType
    return dtype


def has_field(df: DataFrame, path: str) -> bool:
    """True when ``path`` exists as a struct path, dotted name or ``__`` name."""
    parts = path.split(".")
    return (_field_type(df.schema, parts) is not None or path in df.columns
            or "__".join(parts) in df.columns)


def field_or(df: DataFrame, path: str, default: Column | None = None) -> Column:
    """Column at a dotted path, in whichever spelling the frame carries:
    a nested struct path, a literal dotted column name, or ``__`` joined
    names. Falls back to ``default`` (null) when none is present."""
    parts = path.split(".")
    if _field_type(df.schema, parts) is not None:
        col = F.col(parts[0])
        for part in parts[1:]:
            col = col.getField(part)
        return col
    if path in df.columns:
        return F.col(f"`{path}`")
    flat = "__".join(parts)
    if flat in df.columns:
        return F.col(flat)
    return default if default is not None else F.lit(None)


# ---------------------------------------------------------------- API rows --

def explode_items(df: DataFrame) -> DataFrame:
    """One row per ``items[]`` element; the element's fields become columns
    and the document's other columns are kept (envelope, region, ...)."""
    if "items" not in df.columns:
        return df
    keep = [c for c in df.columns if c != "items"]
    exploded = df.select(*keep, F.explode("items").alias("_item"))
    item_fields = exploded.schema["_item"].dataType.fieldNames()
    return exploded.select(*keep, *[F.col("_item").getField(f).alias(f) for f in item_fields])


def flatten_api(df: DataFrame, run_date: _dt.date | str | None = None) -> DataFrame:
    """API payload rows -> the 17 flat columns (text metrics still raw).

    trending_date is the run day as `yy.dd.MM`: ``run_date`` when given,
    else the day of the envelope's ingestion timestamp, else today (UTC).
    Missing optional fields default: dislikes 0, tags/thumbnail null,
    flags false. Tags arrays are joined with ``|``. The day itself is carried as
    trending_date_parsed, as two digits of a year do not tell the century.
    """
    df = explode_items(df)
    if run_date is not None:
        day = F.lit(str(run_date)).cast("date")
    else:
        stamp = field_or(df, "_pipeline_metadata.ingestion_timestamp")
        text = stamp.cast("string")  # a stamp with an offset counts by its UTC day (session time zone)
        day = F.coalesce(F.to_date(text.try_cast("timestamp")), F.try_to_date(F.substring(text, 1, 10)), F.current_date())
    tags = field_or(df, "snippet.tags")
    tags_type = _tags_type(df)
    if isinstance(tags_type, T.ArrayType):
        tags = F.array_join(tags, "|")
    region = field_or(df, "region", field_or(df, "_pipeline_metadata.region"))
    null_text = F.lit(None).cast("string")
    return df.select(
        try_text(field_or(df, "id")).alias("video_id"),
        format_trending_date(day).alias("trending_date"),
        day.alias("trending_date_parsed"),
        try_text(field_or(df, "snippet.title")).alias("title"),
        try_text(field_or(df, "snippet.channelTitle")).alias("channel_title"),
        try_long(field_or(df, "snippet.categoryId")).alias("category_id"),
        try_text(field_or(df, "snippet.publishedAt")).alias("publish_time"),
        try_text(tags).alias("tags") if tags_type is not None else null_text.alias("tags"),
        try_long(field_or(df, "statistics.viewCount")).alias("views"),
        try_long(field_or(df, "statistics.likeCount")).alias("likes"),
        F.coalesce(try_long(field_or(df, "statistics.dislikeCount")), F.lit(0).cast("bigint"))
        .alias("dislikes"),
        try_long(field_or(df, "statistics.commentCount")).alias("comment_count"),
        try_text(field_or(df, "snippet.thumbnails.default.url")).alias("thumbnail_link"),
        F.lit(False).alias("comments_disabled"),
        F.lit(False).alias("ratings_disabled"),
        F.lit(False).alias("video_error_or_removed"),
        try_text(field_or(df, "snippet.description")).alias("description"),
        try_text(region).alias("region"),
        *([F.col("_ingested_at")] if "_ingested_at" in df.columns else
          [_ingested_at(df).alias("_ingested_at")]),
    )


def _tags_type(df: DataFrame):
    parts = ["snippet", "tags"]
    found = _field_type(df.schema, parts)
    if found is not None:
        return found
    for name in ("snippet.tags", "snippet__tags"):
        if name in df.columns:
            return df.schema[name].dataType
    return None


def _ingested_at(df: DataFrame) -> Column:
    stamp = field_or(df, "_pipeline_metadata.ingestion_timestamp")
    return F.try_to_timestamp(stamp.cast("string"))


# --------------------------------------------------------------- flat rows --

def cast_flat(df: DataFrame) -> DataFrame:
    """Flat (CSV) rows -> the 17 typed columns; junk becomes null. A day that
    is parsed already stays."""
    casters = {T.StringType(): try_text, T.LongType(): try_long, T.BooleanType(): try_bool}
    cols = []
    for name, dtype in FLAT_COLUMNS:
        source = F.col(name) if name in df.columns else F.lit(None)
        cols.append(casters[dtype](source).cast(dtype).alias(name))
    cols.append(try_text(F.col("region")).alias("region"))
    if "_ingested_at" in df.columns:
        cols.append(F.col("_ingested_at").try_cast("timestamp").alias("_ingested_at"))
    else:
        cols.append(F.lit(None).cast("timestamp").alias("_ingested_at"))
    if "trending_date_parsed" in df.columns:
        cols.append(F.col("trending_date_parsed").try_cast("date").alias("trending_date_parsed"))
    return df.select(*cols)


def to_flat(df: DataFrame, run_date: _dt.date | str | None = None) -> DataFrame:
    """Format dispatch: API payloads are flattened, flat rows are cast."""
    return flatten_api(df, run_date) if is_api_shape(df) else cast_flat(df)


#: Fields of a CSV record, quoted ones (which may hold anything) as one.
_CSV_FIELDS = r'(?:^|,)(?:"(?:[^"]|"")*+"|[^",][^,]*+|)'


def bad_flat_rows(df: DataFrame) -> DataFrame:
    """M2 of CSV rows (from ``read_flat_statistics(bad_records=True)``): a row per
    record that Silver does not hold as it was meant, with file and reason.

    Records with too few or too many fields are read as far as they go; those
    without a video id are dropped (P5).
    """
    record = F.col("_corrupt_record")
    fields = F.regexp_count(record, F.lit(_CSV_FIELDS))
    reason = (F.when(fields < len(FLAT_NAMES), "too few fields").when(fields > len(FLAT_NAMES), "too many fields")
              .when(record.isNotNull(), "malformed record")
              .when(try_text(F.col("video_id")).isNull(), "no video id"))
    return (df.select("source_file", normalise_region(F.col("region")).alias("region"), reason.alias("reason"),
                      fields.alias("fields"), "video_id", record.alias("record"))
            .where(F.col("reason").isNotNull()))


# --------------------------------------------------------------- cleansing --

def fill_metric_zeros(df: DataFrame, cols: list[str] = METRIC_COLUMNS) -> DataFrame:
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(0).cast("bigint")) for c in cols})


def with_ratios(df: DataFrame) -> DataFrame:
    return df.withColumns({"like_ratio": like_ratio(), "engagement_rate": engagement_rate()})


def cleanse(df: DataFrame) -> DataFrame:
    """Drop rows without video_id, normalise region, parse the trending
    date, zero-fill the four counts and derive the two ratios."""
    out = df.filter(F.col("video_id").isNotNull()).withColumn("region", normalise_region("region"))
    if "trending_date_parsed" not in out.columns:
        out = out.withColumn("trending_date_parsed", parse_trending_date("trending_date"))
    out = with_ratios(fill_metric_zeros(out))
    if all(c in out.columns for c in CLEAN_COLUMNS):
        out = out.select(*CLEAN_COLUMNS, *[c for c in out.columns if c not in CLEAN_COLUMNS])
    return out


def with_audit(df: DataFrame, job_name: str) -> DataFrame:
    return df.withColumns({"_processed_at": F.current_timestamp(), "_job_name": F.lit(job_name)})


# Column order of cleansed rows (before audit columns). Dedup tie-breaks
# follow frame order, so every path into D1 selects this order first.
CLEAN_COLUMNS = FLAT_NAMES + ["region", "_ingested_at", "trending_date_parsed",
                              "like_ratio", "engagement_rate"]
