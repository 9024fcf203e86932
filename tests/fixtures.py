"""Small hand-made event views."""

from __future__ import annotations

import datetime as dt
import random

T0 = dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc)
SCHEMA = ("event_id string, event_name string, event_timestamp timestamp, user_pseudo_id string, merged_user_id string, "
          "user_id string, session_id string, platform string, event_value double, "
          "custom_parameters map<string,struct<value:string,type:string>>, kind string")


def random_events(seed: int, n: int = 120, users: int = 4, names: str = "abc", span_hours: int = 72) -> list[dict]:
    """Events of a few users; the first user holds a third or more, and some share a second."""
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        user = "u0" if rnd.random() < 0.4 else f"u{rnd.randrange(users)}"
        at = T0 + dt.timedelta(seconds=rnd.randrange(span_hours * 3600 // 600) * 600)
        rows.append({
            "event_id": f"e{i:04d}", "event_name": rnd.choice(names), "event_timestamp": at, "user_pseudo_id": user,
            "merged_user_id": user, "user_id": None, "session_id": f"{user}-{at:%d}", "platform": rnd.choice(["Web", "iOS"]),
            "event_value": float(rnd.randrange(1, 9)), "custom_parameters": {"k": (str(i % 7), "number")}, "kind": rnd.choice("xy"),
        })
    return rows


def frame(spark, rows: list[dict]):
    names = [part.split()[0] for part in SCHEMA.split(", ")]
    return spark.createDataFrame([tuple(r[n] for n in names) for r in rows], SCHEMA)
