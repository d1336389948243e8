import random

import pytest
from pyspark.sql import functions as F

from railpulse.operators import sequence

CALLS = "train string, stop string, arrival_time int, stop_sequence bigint"
EVENTS = "id int, train string, stop string, second int, stop_sequence string"


def filled(spark, calls, events, **options):
    rows = sequence.with_stop_sequence(spark.createDataFrame(events, EVENTS), spark.createDataFrame(calls, CALLS),
                                       ["train", "stop"], "second", **options).collect()
    return {r["id"]: (r["stop_sequence"], r["planned_time"], r["off_plan"]) for r in rows}


def test_trips_that_call_twice_and_midnight(spark):
    calls = [("1", "A", 3600, 1), ("1", "A", 7200, 9), ("1", "A", 86_400 + 60, 30), ("1", "B", 10, 2),
             (None, "A", 5, 7), ("1", "A", None, 8), ("1", "A", 3700, None), ("1", "B", 10, 1)]
    events = [(1, "1", "A", 3700, "old"), (2, "1", "A", 5401, None), (3, "1", "A", 5400, None),
              (4, "1", "A", 86_390, None), (5, "1", "B", 10, None), (6, "1", "B", 3611, None),
              (7, None, "A", 5, None), (8, "1", None, 5, None), (9, "1", "A", None, None),
              (10, "2", "A", 3600, None), (11, "1", "B", 3610, None)]
    none = (None, None, None)
    assert filled(spark, calls, events) == {
        1: (1, 3600, 100), 2: (9, 7200, -1799), 3: (1, 3600, 1800), 4: (30, 60, -70), 5: (1, 10, 0),
        6: none, 7: none, 8: none, 9: none, 10: none, 11: (1, 10, 3600)}
    assert filled(spark, calls, events, tolerance=100)[3] == none
    assert filled(spark, [], events) == dict.fromkeys(range(1, 12), none)
    assert filled(spark, calls, []) == {}
    with pytest.raises(ValueError, match="tolerance"):
        filled(spark, calls, events, tolerance=3601)


def test_against_brute_force(spark):
    source = random.Random(4)
    calls = [(str(source.randrange(3)), str(source.randrange(3)), source.randrange(30 * 3600), source.randrange(40))
             for _ in range(400)]
    events = [(k, str(source.randrange(4)), str(source.randrange(3)), source.randrange(86_400), None)
              for k in range(500)] + [(500, "1", "1", 5, None)] * 3
    got = filled(spark, calls, events)
    for k, train, stop, second, _ in events:
        near = []
        for t, s, at, number in calls:
            late = (second - at + 43_200) % 86_400 - 43_200
            if (t, s) == (train, stop) and abs(late) <= 3600:
                near.append((abs(late), at % 86_400, number, late))
        best = min(near, default=None)
        assert got[k] == ((best[2], best[1], best[3]) if best else (None, None, None))


def test_plan_has_no_range_join_and_keeps_rows(spark):
    events = spark.createDataFrame([(1, "1", "1", 5, None)] * 4, EVENTS).withColumn("extra", F.lit("x"))
    calls = spark.createDataFrame([("1", "1", 5, 5), ("1", "1", 6, 6)], CALLS).withColumn("extra", F.lit("y"))
    found = sequence.with_stop_sequence(events, calls, ["train", "stop"], "second")
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    assert [r["extra"] for r in found.collect()] == ["x"] * 4
