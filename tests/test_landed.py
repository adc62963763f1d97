"""Landed lines: places, spans, restarts inside a file; counters of the payload job."""

import io
import os
import random
import threading

import pytest
from pyspark.sql import functions as F

from kelvane.sinks.tables import ensure_tables
from kelvane.sources.landed import START, LandedReader, Span, landed_topic, lines_of, packed
from kelvane.sources.tables import scan
from kelvane.streaming import jobs

ONCE = {"availableNow": True}


@pytest.mark.parametrize("chunk", [1, 3, 1 << 20])
def test_every_line_belongs_to_one_span(monkeypatch, chunk):
    monkeypatch.setattr("kelvane.sources.landed.CHUNK", chunk)
    rng = random.Random(chunk)
    for text in [b"", b"\n", b"a", b"a\n", b"\n\na\n\nbb", b"one\r\ntwo\r\n", bytes(rng.choice(b"ab\n") for _ in range(60))]:
        whole = list(lines_of(io.BytesIO(text), 0, len(text)))
        assert [line for _, line in whole] == text.decode().replace("\r\n", "\n").encode().split(b"\n")[
            :text.count(b"\n") + (not text.endswith(b"\n") and text != b"")]
        for size in (1, 2, 5, 7):
            spans = [list(lines_of(io.BytesIO(text), low, min(low + size, len(text)))) for low in range(0, len(text), size)]
            assert sum(spans, []) == whole


def land(folder, name, text, second):
    os.makedirs(folder, exist_ok=True)
    path = f"{folder}/{name}"
    with open(path, "wb") as file:
        file.write(text)
    os.utime(path, (second, second))


def planned(reader, start):
    end = reader.latestOffset()
    rows = [r for span in reader.partitions(start, end) for b in reader.read(span) for r in b.to_pylist()]
    return end, [(r["value"].decode(), r["byte"]) for r in rows]


def test_offsets_follow_time_file_and_byte(tmp_path):
    folder = str(tmp_path / "in")
    land(folder, "b.txt", b"b0\nb1\n", 1000)
    land(folder, "a.txt", b"a0\na1\na2", 1000)
    land(folder, "0.txt", b"late\n", 2000)
    land(folder, "_hidden", b"no\n", 1000)
    reader = LandedReader({"path": folder, "settle": "0", "batchBytes": "4", "spanBytes": "3"})
    at, found = reader.initialOffset(), []
    assert reader.partitions(at, START) == []
    for _ in range(9):
        at, rows = planned(reader, at)
        found.append(rows)
    lines = [x for rows in found for x in rows]
    assert lines == [("a0", 0), ("a1", 3), ("a2", 6), ("b0", 0), ("b1", 3), ("late", 0)]
    assert max(map(len, found)) <= 2 and found[-1] == []
    # After a restart the first look takes all that is left.
    again = LandedReader({"path": folder, "settle": "0", "batchBytes": "4"})
    end = again.latestOffset()
    assert again.partitions({"time": 1000_000_000, "file": f"{folder}/a.txt", "byte": 3}, end)[0].low == 3
    assert LandedReader({"path": folder, "settle": "1e12"}).latestOffset() == START


def test_spans_share_tasks(tmp_path):
    folder = str(tmp_path / "in")
    for i in range(30):
        land(folder, f"{i:02}.txt", b"".join(b"%d %d\n" % (i, j) for j in range(i + 1)), 1000 + i // 7)
    plain = LandedReader({"path": folder, "settle": "0", "spanBytes": "4"})
    few = LandedReader({"path": folder, "settle": "0", "spanBytes": "4", "tasks": "5"})
    end, found = planned(plain, START)
    assert planned(few, START) == (end, found) and len(found) == 30 * 31 // 2
    assert len(few.partitions(START, end)) <= 6 < len(plain.partitions(START, end))
    middle = {"time": 1002 * 10**6, "file": f"{folder}/15.txt", "byte": 7}
    assert planned(few, middle) == planned(plain, middle)
    # Little to read makes no more tasks than spans; much of it none that is very long.
    assert len(LandedReader({"path": folder, "settle": "0", "tasks": "500"}).partitions(START, end)) == 1
    spans = [Span(0, "a", low, low + 10) for low in range(0, 100, 10)]
    assert [[s.low for s in t.spans] for t in packed(spans, 35)] == [[0, 10, 20], [30, 40, 50], [60, 70, 80], [90]]


def payload(i, temp):
    return (f'{{"schema_version":"1","sensor_id":"s{i}","room":"r","temp_c":{temp},"humidity":1,"pressure":2,'
            f'"timestamp_ms":{1622505600000 + i}}}\n').encode()


def test_payload_job_goes_on_inside_a_file_and_counts(spark, tmp_path):
    root, folder = str(tmp_path / "tables"), str(tmp_path / "in")
    ensure_tables(spark, root)
    # The first line of a key stays, wherever a micro-batch ends; every tenth line is bad.
    lines = [payload(i % 40, float(i)) if i % 10 else b"bad\n" for i in range(200)]
    land(folder, "0.txt", lines[0], 999)
    seen, enough = [], threading.Event()

    def count(batch, accepted, rejected):
        if not seen:
            land(folder, "a.txt", b"".join(lines[1:150]), 1000)
            land(folder, "b.txt", b"".join(lines[150:]), 1001)
        seen.append((accepted, rejected))
        if sum(a + r for a, r in seen) >= 60:
            enough.set()

    source = lambda size: landed_topic(spark, folder, settle=0, batch_bytes=size, span_bytes=500)
    start = lambda size, trigger: jobs.start_payload_job(
        source(size), root, f"{tmp_path}/rejects", f"{tmp_path}/cp", trigger, outcomes=count)
    query = start(4000, {"processingTime": "0 seconds"})
    enough.wait(60)
    query.stop()
    assert len([x for x in seen if sum(x)]) >= 3 and sum(map(sum, seen)) < 200
    # A run to the end is one micro-batch here; the first repeats what was interrupted.
    for _ in range(2):
        start(1 << 30, ONCE).awaitTermination()
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
    stored = {r.sensor_id: r.temp_c for r in scan(spark, root, "readings_raw").collect()}
    assert stored == {f"s{i}": float(i) for i in range(40) if i % 10}
    rejects = spark.read.option("recursiveFileLookup", "true").parquet(f"{tmp_path}/rejects")
    assert rejects.groupBy("reject_reason").count().collect() == [("malformed_json", 20)], seen
    assert rejects.agg(F.count_distinct("offset")).first()[0] == 3


def test_counts_of_each_micro_batch_without_another_job(spark, tmp_path):
    root, folder = str(tmp_path / "tables"), str(tmp_path / "topic")
    ensure_tables(spark, root)
    for part, values in enumerate(([payload(1, 1.0), b"bad"], [payload(2, 1.0), payload(3, 2.0), b"", None])):
        spark.createDataFrame([(None, v, 0, 10 * part + i) for i, v in enumerate(values)],
                              "key binary, value binary, partition int, offset bigint").coalesce(1).write.mode(
            "append").parquet(folder)
    from kelvane.sources import topics
    seen, told = {}, threading.Event()

    def count(batch, accepted, rejected):
        seen[batch] = (accepted, rejected)
        if len(seen) == 2:
            told.set()

    jobs.start_payload_job(topics.file_topic(spark, folder, 1), root, f"{tmp_path}/rejects", f"{tmp_path}/cp", ONCE,
                           outcomes=count).awaitTermination()
    told.wait(30)
    assert seen == {0: (1, 1), 1: (2, 2)}
