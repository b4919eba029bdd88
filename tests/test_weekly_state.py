"""The incremental weekly summary equals a full run after random late, changed and removed rows."""

import datetime as dt
import random

from curbwise.plans import weekly, weekly_state as W

TYPED, PLAIN = "{} date, foldertype string, issuedrowpermits long", "date date, count_permits long"


def _frames(spark, rows):
    return {s: spark.createDataFrame(rows[s], TYPED.format(W.SOURCES[s][0]) if W.SOURCES[s][2] else PLAIN) for s in W.SOURCES}


def _row(rng, source, day):
    return (day, rng.choice(["DS", "EX", "RW", "ZZ"]), rng.randrange(9)) if W.SOURCES[source][2] else (day, rng.randrange(9))


def test_random_late_rows(spark, tmp_path):
    rng, root, start = random.Random(4), str(tmp_path / "state"), dt.date(2023, 6, 1)
    rows = {s: [_row(rng, s, start + dt.timedelta(rng.randrange(200))) for _ in range(15)] for s in W.SOURCES}
    W.update(spark, root, _frames(spark, rows))
    for turn in range(4):
        dirty = set()
        for s in W.SOURCES:
            for _ in range(3):  # late, early and new rows, and removed ones
                new = _row(rng, s, start + dt.timedelta(rng.randrange(-60, 260)))
                rows[s].append(new)
                gone = rows[s].pop(rng.randrange(len(rows[s])))
                dirty |= {new[0], gone[0]}
            edge = rng.choice([min, max])(rows[s])
            rows[s] = [r for r in rows[s] if r[0] != edge[0]]  # the first or the last week may go
            dirty.add(edge[0])
        frames = _frames(spark, rows)
        days = spark.createDataFrame([(d,) for d in dirty], "date date")
        for _ in range(2 if turn == 1 else 1):  # a run may be repeated
            W.update(spark, root, frames, days)
        want = sorted(map(tuple, weekly.weekly_summary(*[frames[s] for s in W.SOURCES]).collect()))
        got = W.summary(spark, root)
        assert sorted(map(tuple, got.collect())) == want and len(want) > 10


def test_only_dirty_weeks_are_computed(spark, tmp_path):
    root, day = str(tmp_path / "state"), dt.date(2024, 1, 3)
    rows = {s: [_row(random.Random(1), s, day), _row(random.Random(2), s, day + dt.timedelta(70))] for s in W.SOURCES}
    W.update(spark, root, _frames(spark, rows))
    changed = {s: [(*r[:-1], 100) for r in rows[s]] for s in W.SOURCES}  # both weeks changed, one is named
    W.update(spark, root, _frames(spark, changed), spark.createDataFrame([(day,)], "date date"))
    from curbwise.sources import sinks
    n = {(r.source, r.week.month): r.n for r in sinks.read_latest(spark, root).collect()}
    assert all(n[s, 1] == 100 and n[s, 3] < 100 for s in W.SOURCES)


def test_state_of_the_fixture_gives_the_registered_summary(spark, tmp_path):
    from curbwise.sources.tables import PermitTables
    t = PermitTables.from_fixture(spark, "/root/testdata/sf0.001")
    W.update(spark, str(tmp_path / "s"), W.source_frames(t))
    assert sorted(map(tuple, W.summary(spark, str(tmp_path / "s")).collect())) == sorted(map(tuple, weekly.weekly_summary_report(t).collect()))


def test_empty_state(spark, tmp_path):
    assert W.summary(spark, str(tmp_path / "none")).count() == 0
