"""The keyed state behind `jobs.users_with_ttl`."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterator

from pyspark.sql import Row
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

# What is kept of a user; times are microseconds, the three choices are JSON beside the places they were made at.
FIELDS = ["seen", "user_id", "info", "info_at", "info_id", "first", "first_at", "first_id", "latest", "latest_at", "latest_id", "version"]
PICTURE = ", ".join(f"{f} {'bigint' if f in ('seen', 'version') or f.endswith('_at') else 'string'}" for f in FIELDS)


class UserPicture(StatefulProcessor):
    def __init__(self, keep: dt.timedelta):
        self.keep = keep // dt.timedelta(microseconds=1)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.user = handle.getValueState("user", PICTURE)

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        # Each call to the store is a round trip: the picture is asked for once, and says itself which timer it has.
        stored = self.user.get()
        now = None if stored is None else dict(zip(FIELDS, stored, strict=True))
        timer = None if now is None else self._end(now)
        # The order of rows in a batch is not given; only what lies behind a gap needs it.
        for r in sorted(rows, key=lambda r: (r.at, r.event_id or "")):
            if now is None or r.at - now["seen"] > self.keep:
                now = dict.fromkeys(FIELDS) | {"seen": r.at, "version": now["version"] if now else 0}
            elif now["seen"] - r.at > self.keep:
                continue  # belongs to a picture that has ended
            self._tell(now, r)
        if now is not None:
            now["version"] += 1
            self.user.update(tuple(now[f] for f in FIELDS))
            if timer != self._end(now):
                if timer is not None:
                    self.handle.deleteTimer(timer)
                self.handle.registerTimer(self._end(now))
            yield Row(app_id=key[0], user_pseudo_id=key[1], **now)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        self.user.clear()
        return iter(())

    def close(self) -> None:
        pass

    def _end(self, now: dict) -> int:
        """The millisecond at which a picture's timer fires."""
        return (now["seen"] + self.keep) // 1000 + 1

    @staticmethod
    def _tell(now: dict, r: Row) -> None:
        at = (r.at, r.event_id or "")
        now["seen"] = max(now["seen"], r.at)
        now["user_id"] = max((u for u in (now["user_id"], r.user_id) if u is not None), default=None)
        for name, value, earlier in (("info", r.info, True), ("first", r.first, True), ("latest", r.latest, False)):
            old = now[f"{name}_at"]
            if value is not None and (old is None or (at < (old, now[f"{name}_id"])) == earlier):
                now[name], now[f"{name}_at"], now[f"{name}_id"] = value, *at
