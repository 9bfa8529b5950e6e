"""Runs from start and end events: the same rows however the stream is cut, late events, lost runs, bounded state."""

from __future__ import annotations

import os
import random
import sys

import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from docledger.streaming import runs

cloudpickle.register_pickle_by_value(sys.modules[__name__])
SF = "/root/testdata/sf0.001"
HOUR = 3600


def plain(events, allowed):
    """run, start, end, status and error of each run, key by key in order of time."""
    out, by = [], {}
    for run, k, start, error, at in events:
        by.setdefault(run, []).append((at, k, start, error))
    for run, rows in by.items():
        rows.sort()
        for i, (at, _, start, _) in enumerate(rows):
            if not start:
                continue
            following = rows[i + 1] if i + 1 < len(rows) else None
            if following is None or following[0] > at + allowed:
                out.append((run, at, at + allowed, "failed", runs.TIMED_OUT))
            elif following[2]:
                out.append((run, at, following[0], "failed", runs.NOT_ENDED))
            else:
                out.append((run, at, following[0], "failed" if following[3] else "success", following[3]))
    return sorted(out, key=str)


def frame(spark, events):
    rows = spark.createDataFrame(events, "run string, id long, start boolean, error string, s double")
    return rows.select("run", "id", "start", "error", F.timestamp_seconds("s").alias("at"))


def test_rows_do_not_depend_on_the_cuts(spark, tmp_path):
    rng = random.Random(1)
    events = [(f"r{rng.randint(0, 5)}", k, rng.random() < 0.55, rng.choice([None, None, "bad"]), float(rng.randint(0, 40) * 600)) for k in range(150)]
    expected = plain(events, HOUR)
    flush = [("", -1, False, None, 1e6)]
    for name, cuts in (("one", [0, 150]), ("four", [0, 30, 60, 120, 150])):
        # Within the delay of two hours the stream comes in any order.
        ordered = sorted(events, key=lambda e: e[4] + rng.random() * 5000)
        batches = [frame(spark, ordered[a:b]) for a, b in zip(cuts, cuts[1:], strict=False)] + [frame(spark, flush)]
        got = runs.replay(batches[0], batches, f"file://{tmp_path}/{name}", lambda s: runs.run_logs(s, HOUR, "2 hours")).collect()
        assert sorted(((r.run, r.start_time.timestamp(), r.end_time.timestamp(), r.status, r.error_message) for r in got), key=str) == expected


def test_nulls_and_open_runs(spark, tmp_path):
    events = [(None, 1, True, None, 5.0), ("a", 2, True, None, 10.0), ("b", 3, False, None, 10.0), ("a", 4, False, "oops", 20.0), ("c", 5, True, None, 30.0)]
    batches = [frame(spark, events), frame(spark, [("z", 9, False, None, 4000.0)])]
    got = runs.replay(batches[0], batches, f"file://{tmp_path}/x", lambda s: runs.run_logs(s, HOUR, "1 second")).collect()
    assert sorted((r.run, r.status, r.error_message) for r in got) == [("a", "failed", "oops"), ("c", "failed", runs.TIMED_OUT)]


def test_copies_in_a_stream(spark, tmp_path):
    rows = spark.createDataFrame([("h1", 1.0), ("h1", 2.0), ("h2", 3.0), (None, 3.0), (None, 4.0)], "file_hash string, s double").select("file_hash", F.timestamp_seconds("s").alias("modified"))
    later = spark.createDataFrame([("h1", 50.0), ("h3", 60.0)], "file_hash string, s double").select("file_hash", F.timestamp_seconds("s").alias("modified"))
    got = runs.replay(rows, [rows, later], f"file://{tmp_path}/x", lambda s: runs.distinct_files(s, "1 hour")).collect()
    assert sorted(str(r.file_hash) for r in got) == ["None", "h1", "h2", "h3"]


def test_a_batch_of_several_parts_is_one_micro_batch(spark, tmp_path):
    """A batch is written by as many tasks as it has parts, and still comes at once."""
    events = [("a", 1, True, None, 10.0), ("a", 2, False, None, 20.0), ("b", 3, True, None, 15.0)]
    batches = [frame(spark, events).repartition(3, "id"), frame(spark, [("z", 9, False, None, 9000.0)])]
    got = runs.replay(batches[0], batches, f"file://{tmp_path}/x", lambda s: runs.run_logs(s, HOUR, "1 second")).collect()
    assert sorted((r.run, r.status) for r in got) == [("a", "success"), ("b", "failed")]
    assert len([f for f in os.listdir(tmp_path / "x" / "in") if f.endswith(".parquet")]) > 2


@pytest.mark.skipif(not os.path.isdir(SF), reason="needs the small tables")
@pytest.mark.parametrize("name", ["run_stream", "stream_distinct"])
def test_agrees_with_sql(spark, name):
    from .test_entry import test_agrees_with_sql as check

    check(spark, name)
