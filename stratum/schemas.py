"""Schemas, keys and defaults of the tables, in one place."""

from __future__ import annotations

from pyspark.sql import types as T

_TYPES = {
    "string": T.StringType(),
    "int": T.IntegerType(),
    "bigint": T.LongType(),
    "boolean": T.BooleanType(),
    "date": T.DateType(),
    "timestamp_ntz": T.TimestampNTZType(),
    "array<string>": T.ArrayType(T.StringType()),
}


def _schema(columns: str) -> T.StructType:
    """A schema from `name type, ...` without a session."""
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in (c.split() for c in columns.split(", "))])


# Names and order of columns that inputs and users of the tables rely on.

BRONZE_TO_SILVER = {
    "id": "post_id",
    "shortCode": "shortcode",
    "caption": "caption",
    "ownerUsername": "owner_username",
    "likesCount": "likes_count",
    "commentsCount": "comments_count",
    "videoViewCount": "video_view_count",
    "videoPlayCount": "video_play_count",
    "ownerId": "owner_id",
    "ownerFullName": "owner_full_name",
    "url": "url",
    "hashtags": "hashtags",
    "mentions": "mentions",
    "taggedUsers": "tagged_users",
    "latestComments": "latest_comments",
    "timestamp": "timestamp",
}

ADMIRALITY_CODES = ("A1", "A2", "A3", "A4", "A5", "A6", "B1", "B2", "B3", "B4", "B5", "B6", "C1", "C2")

ANALYSIS_VERSION = 3

BRONZE = _schema(
    "id string, shortCode string, url string, inputUrl string, caption string, type string, productType string, firstComment string, alt string, "
    "ownerId string, ownerUsername string, ownerFullName string, likesCount bigint, commentsCount bigint, videoViewCount bigint, videoPlayCount bigint, "
    "displayUrl string, dimensionsHeight bigint, dimensionsWidth bigint, images array<string>, audioUrl string, videoUrl string, hashtags array<string>, "
    "mentions array<string>, taggedUsers array<string>, latestComments array<string>, childPosts array<string>, coauthorProducers array<string>, "
    "requestErrorMessages array<string>, timestamp string, username string, isCommentsDisabled boolean, isPinned boolean, locationId string, locationName string, "
    "error string, errorDescription string"
)

SILVER = _schema(
    "post_id string, shortcode string, url string, caption string, owner_id string, owner_username string, likes_count int, comments_count int, "
    "video_play_count int, video_view_count int, timestamp timestamp_ntz, hashtags string, meta_data string, has_engagement_bait boolean, "
    "media_files string, media_count int, source_dataset string, processed_on timestamp_ntz"
)
PROGRESS = _schema("source_dataset string, post_count int, completed_at timestamp_ntz")
WATERMARKS = _schema("name string, timestamp timestamp_ntz, config_hash string")
GOLD = _schema("post_id string, schema_version int, result_json string, analysed_at timestamp_ntz")
DEAD_LETTER = _schema("post_id string, domain string, error string, attempts int, failed_at timestamp_ntz, status string")
DIM_PROFILE = _schema(
    "profile_key int, owner_id string, owner_username string, channel string, effective_from timestamp_ntz, effective_to timestamp_ntz, is_current boolean"
)
DIM_TIME = _schema("date_key int, date date, year int, quarter int, month int, day int, day_of_week int, week int, is_weekend boolean")
ANALYTICS_VIEW = _schema(
    "post_id string, shortcode string, url string, caption string, owner_id string, owner_username string, likes_count int, comments_count int, "
    "video_view_count int, timestamp timestamp_ntz, hashtags string, source_dataset string, processed_on timestamp_ntz, result_json string, "
    "gold_analysed_at timestamp_ntz, profile_key int, channel string, effective_from timestamp_ntz, effective_to timestamp_ntz, is_current boolean"
)

#: Columns that a bronze row may lack, with their defaults (`source_dataset` is filled from the file).
SILVER_DEFAULTS = {
    "url": None,
    "owner_id": None,
    "video_play_count": 0,
    "video_view_count": 0,
    "hashtags": "[]",
    "meta_data": None,
    "has_engagement_bait": False,
    "media_files": "[]",
    "media_count": 0,
    "processed_on": None,
}

#: Tables by name: schema and key.
TABLES: dict[str, tuple[T.StructType, tuple[str, ...]]] = {
    "silver_ig_posts": (SILVER, ("post_id",)),
    "silver_ig_progress": (PROGRESS, ("source_dataset",)),
    "watermarks": (WATERMARKS, ("name",)),
    "gold_ig_analyses": (GOLD, ("post_id",)),
    "dead_letter": (DEAD_LETTER, ("post_id", "domain")),
    "dim_profile": (DIM_PROFILE, ("profile_key",)),
    "dim_time": (DIM_TIME, ("date_key",)),
}

#: Columns that must not be null, beside the keys.
REQUIRED: dict[str, tuple[str, ...]] = {
    "silver_ig_posts": ("hashtags", "has_engagement_bait", "media_files", "media_count", "source_dataset"),
    "watermarks": ("timestamp",),
    "dim_profile": ("owner_id", "effective_from"),
}

#: What a column gets that a row's source doesn't have.
DEFAULTS: dict[str, dict[str, object]] = {
    "silver_ig_posts": {"hashtags": "[]", "has_engagement_bait": False, "media_files": "[]", "media_count": 0},
    "gold_ig_analyses": {"schema_version": ANALYSIS_VERSION},
    "dead_letter": {"domain": "instagram", "status": "pending"},
    "dim_profile": {"channel": "instagram"},
}

#: Foreign keys: table -> (column, the table of whose key it is one).
PARENTS: dict[str, tuple[str, str]] = {"gold_ig_analyses": ("post_id", "silver_ig_posts")}

#: Tables that the pipeline keeps for itself, beside the contract.
INTERNAL_TABLES: dict[str, tuple[T.StructType, tuple[str, ...]]] = {
    "bronze_catalog": (
        _schema("dataset_id string, path string, file string, modified_ms bigint, n_bytes bigint, n_rows bigint, fingerprint string, schema string, error string"),
        ("file",),
    ),
    "bronze_quarantine": (_schema("dataset_id string, reason string, n_expected bigint, n_found bigint, first_seen timestamp_ntz, last_seen timestamp_ntz"), ("dataset_id",)),
    "stream_batches": (_schema("stream string, batch_id bigint, run_ts timestamp_ntz, n_rows bigint, done boolean"), ("stream", "batch_id")),
}

#: Tables of the first schema version, which the import writes and the migration reads.
OLD_SILVER = T.StructType([f if f.name != "processed_on" else T.StructField("silvered_at", T.TimestampNTZType()) for f in SILVER.fields])
OLD_GOLD = _schema("post_id string, schema_version int, status string, result_json string, error string, attempts int, analysed_at timestamp_ntz")
OLD_TABLES: dict[str, tuple[T.StructType, tuple[str, ...]]] = {
    "silver_posts": (OLD_SILVER, ("post_id",)),
    "silver_progress": (PROGRESS, ("source_dataset",)),
    "gold_analyses": (OLD_GOLD, ("post_id",)),
}


def mismatches(name: str, actual: T.StructType) -> list[str]:
    """What an actual schema lacks of the named table's; further columns are fine."""
    have = {f.name: f.dataType for f in actual.fields}
    found = []
    for wanted in TABLES[name][0].fields:
        if wanted.name not in have:
            found.append(f"{name}.{wanted.name} is missing")
        elif have[wanted.name] != wanted.dataType:
            found.append(f"{name}.{wanted.name} is {have[wanted.name].simpleString()}, not {wanted.dataType.simpleString()}")
    return found
