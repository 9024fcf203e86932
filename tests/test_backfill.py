"""Back-fill in windows: a run that was killed goes on with what is not complete."""

import datetime as dt

from compare import DATA
from eventloom.catalog import etl
from eventloom.operators import backfill


def test_windows_cover_the_days_once():
    found = backfill.windows(dt.date(2024, 1, 1), dt.date(2024, 1, 12), 5)
    assert found[0] == (dt.date(2024, 1, 8), dt.date(2024, 1, 13)) and found[-1] == (dt.date(2024, 1, 1), dt.date(2024, 1, 3))
    assert sum((b - a).days for a, b in found) == 12 and backfill.windows(dt.date(2024, 1, 2), dt.date(2024, 1, 1), 5) == []


def test_a_killed_run_is_resumed(spark, tmp_path):
    old, span = etl.old_events(spark, DATA.format("0.001")), (dt.date(2023, 12, 31), dt.date(2024, 2, 1), 8)
    moved = backfill.backfill_windows(old, str(tmp_path), *span, stop_after=2)
    before = {p: p.stat().st_mtime_ns for p in tmp_path.rglob("part-*")}
    # The next window was being written when the driver died: some rows, no mark of completion.
    low, high = backfill.windows(*span)[2]
    cut = tmp_path / f"window={low:%Y%m%d}-{high:%Y%m%d}"
    backfill.backfill_events(old).limit(3).write.parquet(str(cut))
    (cut / "_SUCCESS").unlink()
    assert backfill.backfilled(spark, str(tmp_path)).count() < old.count()
    rest = backfill.backfill_windows(old, str(tmp_path), *span)
    assert len(moved) == 2 and cut.name in rest and not set(moved) & set(rest)
    assert all(p.stat().st_mtime_ns == t for p, t in before.items())
    ids = [r.event_id for r in backfill.backfilled(spark, str(tmp_path)).select("event_id").collect()]
    assert sorted(ids) == sorted(r.event_id for r in old.select("event_id").collect())
    assert backfill.backfill_windows(old, str(tmp_path), *span) == []
