"""Event contracts: schema, accepted values and defaults per stream."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, functions as F, types as T

CORRUPT = "_corrupt_record"


@dataclass(frozen=True)
class Contract:
    """Shape of one event stream."""

    name: str
    ddl: str
    event_types: tuple[str, ...]
    required: tuple[str, ...]
    nullable: tuple[str, ...] = ()
    defaults: dict = field(default_factory=dict)
    version: str = "1.0.0"

    @property
    def schema(self) -> T.StructType:
        return T.StructType.fromDDL(self.ddl)

    @property
    def fields(self) -> list[str]:
        return self.schema.fieldNames()

    def with_defaults(self, df: DataFrame) -> DataFrame:
        """Fill the fields that have a default."""
        present = {c: v for c, v in self.defaults.items() if c in df.columns}
        return df.withColumns({c: F.coalesce(F.col(c), F.lit(v)) for c, v in present.items()})


_HEAD = "event_id string, event_type string, schema_version string, user_id string"
_TIMES = "event_time string, ingestion_time string"
_PLAY_REQUIRED = ("event_id", "event_type", "user_id", "session_id", "content_id", "event_time")
_REQUIRED = ("event_id", "event_type", "user_id", "event_time")

# The stream contracts.
CONTRACTS = {
    "playback": Contract(
        "playback",
        f"{_HEAD}, session_id string, device_id string, device_type string, app_version string,"
        f" content_id string, position_seconds double, playback_seconds double, {_TIMES}",
        ("video_play", "video_pause", "video_seek", "video_stop", "video_complete"),
        _PLAY_REQUIRED,
        defaults={"schema_version": "1.0.0"},
    ),
    "search": Contract(
        "search",
        f"{_HEAD}, session_id string, device_id string, device_type string, app_version string,"
        f" query_text string, results_count int, selected_content_id string, {_TIMES}",
        ("search",),
        _REQUIRED,
        nullable=("selected_content_id",),
        defaults={"event_type": "search", "schema_version": "1.0.0"},
    ),
    "recommendation": Contract(
        "recommendation",
        f"{_HEAD}, session_id string, device_id string, model_version string,"
        f" recommended_content_ids array<string>, clicked_content_id string, position_index int, {_TIMES}",
        ("recommendation_impression", "recommendation_click"),
        _REQUIRED,
        nullable=("clicked_content_id",),
        defaults={"schema_version": "1.0.0", "position_index": 0},
    ),
    "user": Contract(
        "user",
        f"{_HEAD}, session_id string, device_id string, content_id string, metadata_json string, {_TIMES}",
        ("login", "logout", "watchlist_add", "content_impression"),
        _REQUIRED,
        nullable=("content_id", "metadata_json"),
        defaults={"schema_version": "1.0.0"},
    ),
    "subscription": Contract(
        "subscription",
        f"{_HEAD}, subscription_id string, plan_id string, status string, price_cents int,"
        f" payment_method string, {_TIMES}",
        ("subscription_event",),
        _REQUIRED,
        defaults={"event_type": "subscription_event", "schema_version": "1.0.0"},
    ),
}

# Accepted devices and subscription states.
DEVICE_TYPES = ["smart_tv", "mobile", "tablet", "web", "streaming_stick"]
SUBSCRIPTION_STATES = ["active", "past_due", "canceled", "expired"]
