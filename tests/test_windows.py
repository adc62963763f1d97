import math
import random

from pyspark.sql import functions as F

from kelvane.operators import windows

SCHEMA = "room string, second double, temp_c double, humidity double"


def readings(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).withColumn(
        "time", F.timestamp_millis((F.col("second") * 1000).cast("bigint")))


def tumble(spark, rows, *args):
    found = windows.tumble(readings(spark, rows), *args).orderBy("room", "bucket_ms").collect()
    return [tuple(r) for r in found]


def test_single(spark):
    assert tumble(spark, [("r", 1.0, 22.5, 60.0)]) == [("r", 0, 22.5, 22.5, 60.0, 60.0)]


def test_max_and_mean(spark):
    rows = [("r", float(i), t, 50.0) for i, t in enumerate((20.0, 30.0, 25.0))]
    assert tumble(spark, rows)[0][2:4] == (30.0, 25.0)


def test_humidity_apart(spark):
    rows = [("r", 1.0, 20.0, 40.0), ("r", 2.0, 22.0, 80.0), ("r", 3.0, 21.0, 60.0)]
    assert tumble(spark, rows) == [("r", 0, 22.0, 21.0, 80.0, 60.0)]


def test_partial_results_merge(spark):
    rng = random.Random(1)
    rows = [(rng.choice("ab"), rng.uniform(0, 3000), float(rng.randrange(100)), 1.0)
            for _ in range(500)]
    one = windows.tumble(readings(spark, rows).coalesce(1))
    many = windows.tumble(readings(spark, rows).repartition(7))
    assert sorted(one.collect()) == sorted(many.collect())


def test_all_negative(spark):
    assert tumble(spark, [("r", 1.0, -5.0, 1.0), ("r", 2.0, -9.0, 1.0)])[0][2] == -5.0


def test_boundary_and_alignment(spark):
    rows = [("r", 299.999, 1.0, 1.0), ("r", 300.0, 2.0, 1.0), ("r", -0.001, 3.0, 1.0)]
    assert [r[1] for r in tumble(spark, rows)] == [-300_000, 0, 300_000]


def test_infinite_max_reads_zero_and_mean_stays(spark):
    rows = [("a", 1.0, float("inf"), 1.0), ("b", 1.0, float("-inf"), float("inf"))]
    (a, b) = tumble(spark, rows)
    assert a[2] == 0.0 and math.isinf(a[3])
    assert b[2] == 0.0 and b[4] == 0.0 and math.isinf(b[5])


def test_nan_and_absent_values(spark):
    (row,) = tumble(spark, [("r", 1.0, float("nan"), None), ("r", 2.0, 5.0, 4.0)])
    assert math.isnan(row[2]) and row[4:] == (4.0, 4.0)


def test_table_form_round_trip(spark):
    found = windows.tumble(readings(spark, [("r", 1.0, 2.0, 3.0)]))
    stored = windows.as_table_rows(found)
    assert str(stored.collect()[0].event_date) == "1970-01-01"
    assert windows.from_table_rows(stored).collect() == found.collect()


def brute_late(rows, width=300, delay=10):
    late = []
    for second, at in rows:
        end = second // width * width + width
        late.append(any(a < at and s - delay >= end for s, a in rows))
    return late


def test_late_rows_against_brute_force(spark):
    rng = random.Random(7)
    rows = []
    for _ in range(400):
        second = rng.randrange(0, 6000)
        rows.append((second, second + rng.choice([0, 0, 0, 5, 400, 2000])))
    frame = spark.createDataFrame(
        [(i, float(s), a) for i, (s, a) in enumerate(rows)], "i int, second double, arrival bigint"
    ).withColumn("time", F.timestamp_seconds("second"))
    found = windows.with_lateness(frame).orderBy("i").collect()
    assert [r.late for r in found] == brute_late(rows)
    assert any(r.late for r in found) and len(found) == 400
