"""Column contracts of the bronze, silver and gold tables and of the report rows."""

from pyspark.sql.types import (
    ArrayType,
    BooleanType,
    DataType,
    DoubleType,
    LongType,
    StringType,
    StructField,
    StructType,
)

TEXT, LONG, FLAG, REAL = StringType(), LongType(), BooleanType(), DoubleType()


def struct(**fields: DataType) -> StructType:
    return StructType([StructField(name, kind) for name, kind in fields.items()])


# Raw statistics, CSV layout: everything is text until it is cast. ``region`` is
# the partition directory.
STATS_CSV = struct(
    video_id=TEXT,
    trending_date=TEXT,
    title=TEXT,
    channel_title=TEXT,
    category_id=TEXT,
    publish_time=TEXT,
    tags=TEXT,
    views=TEXT,
    likes=TEXT,
    dislikes=TEXT,
    comment_count=TEXT,
    thumbnail_link=TEXT,
    comments_disabled=TEXT,
    ratings_disabled=TEXT,
    video_error_or_removed=TEXT,
    description=TEXT,
    region=TEXT,
)

# Raw statistics, API layout: nested objects, counts as text.
STATS_API = struct(
    id=TEXT,
    snippet=struct(
        title=TEXT,
        channelTitle=TEXT,
        categoryId=TEXT,
        publishedAt=TEXT,
        tags=ArrayType(TEXT),
        description=TEXT,
        thumbnails=struct(default=struct(url=TEXT)),
    ),
    statistics=struct(viewCount=TEXT, likeCount=TEXT, dislikeCount=TEXT, commentCount=TEXT),
    region=TEXT,
)

# The 17 canonical columns of the cleaned statistics, in order.
CANONICAL = {
    "video_id": "string",
    "trending_date": "string",
    "title": "string",
    "channel_title": "string",
    "category_id": "bigint",
    "publish_time": "string",
    "tags": "string",
    "views": "bigint",
    "likes": "bigint",
    "dislikes": "bigint",
    "comment_count": "bigint",
    "thumbnail_link": "string",
    "comments_disabled": "boolean",
    "ratings_disabled": "boolean",
    "video_error_or_removed": "boolean",
    "description": "string",
    "region": "string",
}

MEASURES = ("views", "likes", "dislikes", "comment_count")
VIDEO_KEY = ("video_id", "region", "trending_date_parsed")

# One item of a category reference document.
REFERENCE_ITEM = struct(
    kind=TEXT, etag=TEXT, id=TEXT, snippet=struct(channelId=TEXT, title=TEXT, assignable=FLAG)
)

CHECK_RECORD = struct(
    check=TEXT,
    table=TEXT,
    column=TEXT,
    value=REAL,
    threshold=REAL,
    missing_columns=ArrayType(TEXT),
    negative_count=LONG,
    extreme_count=LONG,
    latest_record=TEXT,
    cutoff=TEXT,
    passed=FLAG,
    message=TEXT,
)

INGEST_REPORT = struct(key=TEXT, region=TEXT, rows=LONG, error=TEXT, missing_columns=ArrayType(TEXT))

# The columns each silver table must have, filled in.
CRITICAL_COLUMNS = {
    "clean_statistics": ("video_id", "title", "channel_title", "views", "region"),
    "clean_reference_data": ("id", "region"),
}
