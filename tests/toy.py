"""Small hand-written logs."""

from __future__ import annotations

from datetime import datetime

from churn_engine.functions.timeexpr import to_millis
from churn_engine.operators.clean import clean_events
from churn_engine.operators.snapshots import Snapshots
from churn_engine.schema import RAW_LOG

OBS = "2018-10-15"
AT = Snapshots.at(OBS)


def event(ts: str, page: str = "Home", user: str | None = "1", session: int | None = 1, item: int = 0, **more) -> dict:
    row = {
        "userId": user,
        "sessionId": session,
        "itemInSession": item,
        "ts": to_millis(ts),
        "registration": datetime(2018, 8, 8),
        "gender": "F",
        "level": "free",
        "page": page,
        "artist": None,
        "song": None,
        "length": None,
    }
    unknown = set(more) - set(row)
    assert not unknown, unknown
    return row | more


def song(ts: str, artist: str = "a", title: str = "s", length: float | None = 100.0, **more) -> dict:
    return event(ts, "NextSong", artist=artist, song=title, length=length, **more)


def raw(spark, rows: list[dict]):
    return spark.createDataFrame([tuple(r[f] for f in RAW_LOG.fieldNames()) for r in rows], RAW_LOG)


def cleaned(spark, rows: list[dict]):
    return clean_events(raw(spark, rows))
