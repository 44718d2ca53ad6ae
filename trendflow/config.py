"""Fixed values and table schemas shared by every layer.

Values marked FIXED must stay equal to the upstream pipeline's constants,
otherwise the quality gate and the Silver scan would decide differently.
"""

from __future__ import annotations

from pyspark.sql import types as T

# --- FIXED values (must equal the upstream pipeline) -----------------------
# Data-quality thresholds.
MIN_ROW_COUNT = 10
MAX_NULL_PCT = 5.0
MAX_VIEWS = 50_000_000_000

# Columns whose absence or nulls fail the quality gate, per Silver table.
CRITICAL_COLUMNS = {
    "clean_statistics": ["video_id", "title", "channel_title", "views", "region"],
    "clean_reference_data": ["category_id", "category_name", "region"],
}

# Tables the quality gate checks when the caller names none.
DEFAULT_DQ_TABLES = ["clean_statistics", "clean_reference_data"]

# Regions that the Bronze -> Silver statistics scan lets through.
SILVER_REGIONS = ["ca", "gb", "us", "in"]

# Regions landed by the ingest step (upper case as configured upstream).
INGEST_REGIONS = ["US", "GB", "CA", "DE", "FR", "IN", "JP", "KR", "MX", "RU"]

# Payload provenance literal and item cap per API page.
PAYLOAD_SOURCE = "youtube_data_api_v3"
MAX_ITEMS_PER_PAGE = 50

# Formats: API rows get the run day as `yy.dd.MM`; raw landing partitions.
TRENDING_DATE_FORMAT = "yy.dd.MM"
TRENDING_DATE_PATTERN = r"^\d{2}\.\d{2}\.\d{2}$"
INGEST_DATE_FORMAT = "yyyy-MM-dd"
INGEST_HOUR_FORMAT = "HH"
INGEST_ID_FORMAT = "yyyyMMdd_HHmmss"

UNKNOWN_CATEGORY = "Unknown"
UNKNOWN_REGION = "unknown"
# --- end FIXED values --------------------------------------------------------

# Silver statistics lie in folders by region and month of the trending day (an
# integer like 202411), so that a delivery rewrites the months that it touches.
SILVER_PARTITIONS = ["region", "trending_month"]

METRIC_COLUMNS = ["views", "likes", "dislikes", "comment_count"]
STAT_KEY = ["video_id", "region", "trending_date_parsed"]

# Flat (CSV) Bronze statistics: every column is read as text and coerced
# afterwards, so a malformed value becomes null instead of failing the job.
FLAT_COLUMNS = [
    ("video_id", T.StringType()),
    ("trending_date", T.StringType()),
    ("title", T.StringType()),
    ("channel_title", T.StringType()),
    ("category_id", T.LongType()),
    ("publish_time", T.StringType()),
    ("tags", T.StringType()),
    ("views", T.LongType()),
    ("likes", T.LongType()),
    ("dislikes", T.LongType()),
    ("comment_count", T.LongType()),
    ("thumbnail_link", T.StringType()),
    ("comments_disabled", T.BooleanType()),
    ("ratings_disabled", T.BooleanType()),
    ("video_error_or_removed", T.BooleanType()),
    ("description", T.StringType()),
]
FLAT_NAMES = [name for name, _ in FLAT_COLUMNS]

FLAT_TEXT_SCHEMA = T.StructType(
    [T.StructField(name, T.StringType()) for name in FLAT_NAMES]
)

# API payload as landed by the ingest step (one document per page).
API_ITEM = T.StructType([
    T.StructField("id", T.StringType()),
    T.StructField("snippet", T.StructType([
        T.StructField("title", T.StringType()),
        T.StructField("channelTitle", T.StringType()),
        T.StructField("categoryId", T.StringType()),
        T.StructField("publishedAt", T.StringType()),
        T.StructField("tags", T.ArrayType(T.StringType())),
        T.StructField("description", T.StringType()),
        T.StructField("thumbnails", T.StructType([
            T.StructField("default", T.StructType([
                T.StructField("url", T.StringType()),
            ])),
        ])),
    ])),
    T.StructField("statistics", T.StructType([
        T.StructField("viewCount", T.StringType()),
        T.StructField("likeCount", T.StringType()),
        T.StructField("dislikeCount", T.StringType()),
        T.StructField("commentCount", T.StringType()),
    ])),
])
PIPELINE_METADATA = T.StructType([
    T.StructField("ingestion_id", T.StringType()),
    T.StructField("region", T.StringType()),
    T.StructField("ingestion_timestamp", T.StringType()),
    T.StructField("video_count", T.LongType()),
    T.StructField("source", T.StringType()),
])
API_PAYLOAD_SCHEMA = T.StructType([
    T.StructField("items", T.ArrayType(API_ITEM)),
    T.StructField("_pipeline_metadata", PIPELINE_METADATA),
])

CATEGORY_ITEM = T.StructType([
    T.StructField("kind", T.StringType()),
    T.StructField("etag", T.StringType()),
    T.StructField("id", T.StringType()),
    T.StructField("snippet", T.StructType([
        T.StructField("channelId", T.StringType()),
        T.StructField("title", T.StringType()),
        T.StructField("assignable", T.BooleanType()),
    ])),
])
CATEGORY_DOCUMENT_SCHEMA = T.StructType([
    T.StructField("kind", T.StringType()),
    T.StructField("etag", T.StringType()),
    T.StructField("items", T.ArrayType(CATEGORY_ITEM)),
])

SILVER_REFERENCE_SCHEMA = T.StructType([
    T.StructField("category_id", T.LongType()),
    T.StructField("category_name", T.StringType()),
    T.StructField("_processed_at", T.TimestampType()),
    T.StructField("region", T.StringType()),
])

DQ_RESULT_SCHEMA = T.StructType([
    T.StructField("check", T.StringType()),
    T.StructField("table", T.StringType()),
    T.StructField("column", T.StringType()),
    T.StructField("passed", T.BooleanType()),
    T.StructField("value", T.DoubleType()),
    T.StructField("missing", T.ArrayType(T.StringType())),
    T.StructField("negative", T.LongType()),
    T.StructField("extreme", T.LongType()),
    T.StructField("error", T.StringType()),
])
