import random

import pytest

from kelvane.operators import alerts

START = 1_700_000_000_000  # not on a five-minute boundary
STEP = 300_000
SCHEMA = "room string, bucket_ms bigint, max_temp double"


def detect(spark, rows, **options):
    found = alerts.detect_alerts(spark.createDataFrame(rows, SCHEMA), **options)
    return [tuple(r) for r in found.orderBy("room", "window_start_ms", "consecutive_count").collect()]


def series(*temps, room="bedroom", start=START):
    return [(room, start + i * STEP, float(t)) for i, t in enumerate(temps)]


@pytest.mark.parametrize("temps, counts", [
    ((22, 21.5, 23, 24.9), []),
    ((26, 27), []),
    ((26, 27, 28), [3]),
    ((26, 27, 28, 29), [3, 4]),
    ((26, 27, 28, 22, 26, 27, 28), [3, 3]),
    ((26, 27, 20, 26, 27, 28), [3]),
    ((26, 27, 25.0, 28), []),
    ((26, 27, float("nan"), 28), []),
])
def test_single_room(spark, temps, counts):
    assert [a[3] for a in detect(spark, series(*temps))] == counts


def test_alert_fields(spark):
    assert detect(spark, series(26, 27, 28)) == [("bedroom", START + 2 * STEP, 28.0, 3)]


def test_rooms_are_apart(spark):
    rows = series(26, 27, 28) + series(26, room="kitchen", start=START + 100_000)
    assert [a[0] for a in detect(spark, rows)] == ["bedroom"]


def test_silent_window(spark):
    rows = [r for i, r in enumerate(series(26, 27, 0, 28)) if i != 2]
    assert [a[3] for a in detect(spark, rows)] == [3]
    assert detect(spark, rows, gap_resets=True) == []


def test_redelivered_window(spark):
    rows = series(26, 27) + series(26)
    assert [a[3] for a in detect(spark, rows)] == [3]
    assert detect(spark, rows, dedupe=True) == []


def test_many_copies_are_counted_one_by_one(spark):
    rows = series(20, 26) + series(20, 26)[1:] * 4 + series(20, 26, 27)[2:] + series(20)
    assert [a[1:] for a in detect(spark, rows)] == [
        (START + STEP, 26.0, n) for n in (3, 4, 5)] + [(START + 2 * STEP, 27.0, 6)]
    runs = alerts.hot_runs(spark.createDataFrame(rows, SCHEMA)).collect()
    assert len(runs) == len(rows)


def test_settings(spark):
    assert [a[3] for a in detect(spark, series(31, 29, 31, 32), threshold=30, consecutive=2)] == [2]
    assert [a[3] for a in detect(spark, series(26, 1, 26), consecutive=1)] == [1, 1]


def brute(rows, threshold, consecutive, gap_resets):
    out, run, last = [], {}, {}
    for room, bucket, temp in sorted(rows, key=lambda r: r[:2]):
        if gap_resets and bucket - last.get(room, bucket) > STEP:
            run[room] = 0
        last[room] = bucket
        run[room] = run.get(room, 0) + 1 if temp > threshold else 0
        if run[room] >= consecutive:
            out.append((room, bucket, temp, run[room]))
    return sorted(out)


@pytest.mark.parametrize("seed", range(4))
@pytest.mark.parametrize("gap_resets", [False, True])
def test_runs_across_chunks_against_a_loop(spark, seed, gap_resets):
    rng = random.Random(seed)
    hot = rng.choice([0.5, 0.9, 0.98])
    rows = [(room, i * STEP, 26.0 if rng.random() < hot else rng.choice([20.0, float("nan")]))
            for room in ("a", "b", "") for i in range(150) if rng.random() < 0.9]
    found = detect(spark, rows, gap_resets=gap_resets, chunk="30 minutes")
    assert sorted(found) == brute(rows, 25.0, 3, gap_resets)


def test_runs_are_counted_with_one_shuffle_of_the_rows(spark):
    rows = spark.createDataFrame([("a", i * 300_000, 30.0, 1.0, 1.0, 1.0) for i in range(4)],
                                 "room string, bucket_ms bigint, max_temp double, avg_temp double, "
                                 "max_humidity double, avg_humidity double")
    plan = alerts.hot_runs(rows)._jdf.queryExecution().executedPlan().toString()
    # Once for each branch: the same exchange, reused when run. Others carry a row per chunk.
    assert plan.count("REPARTITION_BY_COL") == 2
    assert "Exchange hashpartitioning(room" not in plan.split("REPARTITION_BY_COL")[-1]
