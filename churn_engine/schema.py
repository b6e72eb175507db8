"""Schemas, page names and feature names."""

from __future__ import annotations

from pyspark.sql import types as T

RAW_LOG = T.StructType(
    [
        T.StructField("userId", T.StringType()),
        T.StructField("sessionId", T.LongType()),
        T.StructField("itemInSession", T.LongType()),
        T.StructField("ts", T.LongType()),
        T.StructField("registration", T.TimestampNTZType()),
        T.StructField("gender", T.StringType()),
        T.StructField("level", T.StringType()),
        T.StructField("page", T.StringType()),
        T.StructField("artist", T.StringType()),
        T.StructField("song", T.StringType()),
        T.StructField("length", T.DoubleType()),
    ]
)

# Page names as they occur in the log, and the feature that counts each of them.
SONG_PAGE = "NextSong"
CHURN_PAGE = "Cancellation Confirmation"
PAGE_COUNTS = {
    "friends_added": "Add Friend",
    "thumbs_up_count": "Thumbs Up",
    "thumbs_down_count": "Thumbs Down",
    "playlists_created": "Add to Playlist",
    "help_visits": "Help",
    "error_count": "Error",
    "settings_visits": "Settings",
    "cancel_page_visits": "Cancel",
    "logout_count": "Logout",
    "home_visits": "Home",
    "about_visits": "About",
    "ad_count": "Roll Advert",
}
PAGE_SET_COUNTS = {
    "downgrade_attempts": ["Downgrade", "Submit Downgrade"],
    "upgrade_attempts": ["Upgrade", "Submit Upgrade"],
}

# Codes of the two categories.
GENDER_CODES = {"F": 0, "M": 1}
LEVEL_CODES = {"free": 0, "paid": 1}

# Carried with every feature row, never used as model input.
CARRIED = ["registration", "ts_min", "ts_max", "total_length"]
KEYS = ["userId", "obs_date"]
LABEL = "churned"

FEATURES_V0 = [
    "gender",
    "level",
    "num_sessions",
    "max_item_in_session",
    "avg_session_length_seconds",
    "num_songs_played",
    "unique_artists",
    "days_active",
    "membership_length",
    "days_since_last_activity",
    "songs_per_day",
    "sessions_per_day",
]

FEATURES_V1 = [
    "gender",
    "level_first",
    "level_current",
    "num_sessions",
    "avg_session_length",
    "num_songs_played",
    "unique_artists",
    "unique_songs",
    "avg_song_length",
    "days_active",
    "membership_length",
    "days_since_last_activity",
    "songs_last_7_days",
    "sessions_last_7_days",
    "songs_per_day_overall",
    "songs_per_day_recent",
    "activity_decline",
    "songs_per_session",
    "artist_diversity",
    "downgraded",
    *PAGE_COUNTS,
    *PAGE_SET_COUNTS,
    "total_page_views",
    "has_social_activity",
    "positive_actions",
    "satisfaction_ratio",
    "engagement_rate",
    "problem_signals",
    "ads_per_song",
    "actions_per_session",
]

FEATURES_V2 = FEATURES_V1 + [
    "artists_last_7_days",
    "avg_session_length_recent",
    "songs_historical",
    "sessions_historical",
    "artists_historical",
    "recent_vs_historical_songs",
    "recent_vs_historical_sessions",
    "recent_vs_historical_artists",
    "session_length_decline",
    "artist_exploration_rate",
    "days_on_current_level",
    "cancel_visits_recent",
    "help_visits_recent",
    "thumbs_down_recent",
    "days_since_cancel_visit",
    "days_since_help_visit",
    "days_since_downgrade_attempt",
    "session_freq_trend",
    "session_consistency",
    "weighted_songs",
    "weighted_sessions",
    "last_session_length",
    "churn_risk_score",
]
