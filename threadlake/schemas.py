"""Fixed schemas per layer and entity."""

from pyspark.sql import types as T

PARTITION_COLUMN = "ingestion_date"

_STRING, _LONG = T.StringType(), T.LongType()


def _struct(*fields):
    return T.StructType([T.StructField(name, kind) for name, kind in fields])


# Raw items are read with every scalar as text; types are settled when conforming.
RAW_STORY = _struct(
    ("id", _STRING), ("type", _STRING), ("by", _STRING), ("time", _STRING),
    ("title", _STRING), ("url", _STRING), ("text", _STRING), ("score", _STRING),
    ("descendants", _STRING), ("kids", T.ArrayType(_STRING)),
    ("dead", _STRING), ("deleted", _STRING),
)

RAW_COMMENT = _struct(
    ("id", _STRING), ("type", _STRING), ("by", _STRING), ("time", _STRING),
    ("text", _STRING), ("parent", _STRING), ("kids", T.ArrayType(_STRING)),
    ("dead", _STRING), ("deleted", _STRING),
)

# Any item of the source: a story or a comment.
RAW_ITEM = T.StructType(
    RAW_STORY.fields + [T.StructField("parent", _STRING)]
)

STORY = _struct(
    ("id", _LONG), ("type", _STRING), ("by", _STRING), ("time", T.TimestampType()),
    ("title", _STRING), ("url", _STRING), ("text", _STRING), ("score", _LONG),
    ("descendants", _LONG), ("kids", T.ArrayType(_LONG)),
    ("dead", T.BooleanType()), ("deleted", T.BooleanType()),
)

COMMENT = _struct(
    ("id", _LONG), ("type", _STRING), ("by", _STRING), ("time", T.TimestampType()),
    ("text", _STRING), ("parent", _LONG), ("kids", T.ArrayType(_LONG)),
    ("dead", T.BooleanType()), ("deleted", T.BooleanType()),
)

RANKED_IDS = _struct(("rank", T.IntegerType()), ("id", _LONG))


def with_partition(schema: T.StructType) -> T.StructType:
    return T.StructType(schema.fields + [T.StructField(PARTITION_COLUMN, _STRING)])


PROCESSED_STORY = with_partition(STORY)
PROCESSED_COMMENT = with_partition(COMMENT)

OUTPUT_STORY = with_partition(
    T.StructType(
        STORY.fields
        + _struct(
            ("score_velocity", _LONG), ("comment_velocity", _LONG),
            ("observations_in_window", _LONG), ("hours_to_peak", T.DoubleType()),
            ("is_long_tail", T.BooleanType()), ("dominant_topics", _STRING),
        ).fields
    )
)

OUTPUT_COMMENT = with_partition(
    T.StructType(
        COMMENT.fields
        + _struct(("sentiment_score", T.DoubleType()), ("sentiment_label", _STRING)).fields
    )
)

TRACKING_STATE = _struct(
    ("story_id", _LONG), ("first_seen", _STRING), ("last_updated", _STRING),
    ("last_score", _LONG), ("last_descendants", _LONG),
)

OBSERVED_STATE = _struct(
    ("id", _LONG),
    ("seen", T.ArrayType(_struct(("day", _STRING), ("score", _LONG), ("descendants", _LONG)))),
)

OBSERVED_LOG = _struct(
    ("as_of", _STRING), ("made_from", T.MapType(_STRING, _STRING)), ("ids", _LONG),
    ("saved_at", _STRING),
)

CHECK_RESULT = _struct(
    ("name", _STRING), ("passed", T.BooleanType()), ("severity", _STRING),
    ("description", _STRING), ("affected_records", _LONG),
    ("details", T.MapType(_STRING, _STRING)), ("sample_ids", T.ArrayType(_LONG)),
)

ENTITY_TALLY = _struct(("passed", _LONG), ("failed", _LONG))

QUALITY_REPORT = _struct(
    ("ingestion_date", _STRING), ("generated_at", _STRING), ("total_checks", _LONG),
    ("passed_checks", _LONG), ("failed_checks", _LONG),
    ("has_critical_failures", T.BooleanType()),
    ("entities", T.MapType(_STRING, ENTITY_TALLY)), ("checks", T.ArrayType(CHECK_RESULT)),
)

MANIFEST = _struct(
    ("layer", _STRING), ("entity", _STRING), ("partition_date", _STRING),
    ("format", _STRING), ("compression", _STRING), ("record_count", _LONG),
    ("column_count", _LONG), ("ingestion_timestamp", _STRING),
    ("extras", T.MapType(_STRING, _STRING)),
)
