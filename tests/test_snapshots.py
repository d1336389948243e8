import copy
import json

import pytest

from railpulse.operators import filters, quality, reshape
from railpulse.plans import ingest
from railpulse.sources import snapshots

STATION = {
    "name": "Penn", "code": "NYP", "tz": "America/New_York", "bus": False,
    "schArr": "2025-11-15T08:00:00-05:00", "schDep": "2025-11-15T08:05:00-05:00",
    "arr": "2025-11-15T08:01:00-05:00", "dep": "2025-11-15T13:06:00Z",
    "arrCmnt": "", "depCmnt": "", "platform": "", "status": "Departed",
}
TRAIN = {
    "routeName": "NE R", "trainNum": "7", "trainNumRaw": "7", "trainID": "7-15",
    "lat": 40.7, "lon": -74, "trainTimely": "", "iconColor": "", "stations": [STATION],
    "heading": "N", "eventCode": "NYP", "eventTZ": None, "eventName": "x", "origCode": "WAS",
    "originTZ": None, "origName": "", "destCode": "BOS", "destTZ": None, "destName": "",
    "trainState": "Active", "velocity": 60.5, "statusMsg": "", "createdAt": "", "updatedAt": "",
    "lastValTS": "", "objectID": 12, "provider": "Amtrak", "providerShort": "AMTK",
    "onlyOfTrainNum": True, "alerts": [{"message": "late"}],
}


def document(change=lambda train: None):
    train = copy.deepcopy(TRAIN)
    change(train)
    return json.dumps({"7": [train]})


def parsed(spark, *texts):
    rows = spark.createDataFrame(list(enumerate(texts)), "n int, value string")
    return snapshots.parse_snapshots(rows)


def verdicts(spark, *texts):
    return [r["violations"] > 0 for r in parsed(spark, *texts).orderBy("n").collect()]


def changed(path, value):
    """A document with one field replaced, or removed when the value is ``...``."""
    def change(train):
        owner = train
        for step in path[:-1]:
            owner = owner[step]
        if value is ...:
            del owner[path[-1]]
        else:
            owner[path[-1]] = value
    return document(change)


ACCEPTED = [
    document(), "{}", '{"7": []}', changed(["stations"], []), changed(["alerts"], []),
    changed(["extra"], 1), changed(["objectID"], ...), changed(["objectID"], None),
    changed(["objectID"], "12"), changed(["objectID"], 12.0), changed(["eventTZ"], ...),
    changed(["lat"], "40.7"), changed(["lat"], 40), changed(["stations", 0, "bus"], "no"),
    changed(["stations", 0, "bus"], 1), changed(["stations", 0, "arr"], None),
    changed(["stations", 0, "tz"], ...), "\n " + document() + "\n",
]
REJECTED = [
    "", "null", "[]", "5", document()[:-2], document() + " tail", document() + document(),
    '{"7": 5}', '{"7": [5]}', '{"7": null}', '{"7": [null]}',
    changed(["trainNumRaw"], 7), changed(["routeName"], None), changed(["provider"], ...),
    changed(["stations"], ...), changed(["stations"], None), changed(["stations"], {"a": 1}),
    changed(["stations", 0], "x"), changed(["stations", 0, "code"], ...),
    changed(["stations", 0, "arr"], 5), changed(["stations", 0, "bus"], "maybe"),
    changed(["stations", 0, "bus"], 2), changed(["stations", 0, "bus"], None),
    changed(["alerts"], ...), changed(["alerts", 0, "message"], 1), changed(["lat"], "north"),
    changed(["objectID"], 1.5), changed(["onlyOfTrainNum"], "perhaps"),
]


def test_accepted(spark):
    assert verdicts(spark, *ACCEPTED) == [False] * len(ACCEPTED)


def test_rejected(spark):
    assert verdicts(spark, *REJECTED) == [True] * len(REJECTED)


def test_one_bad_train_rejects_the_whole_document(spark):
    two = json.loads(document())
    two["8"] = [copy.deepcopy(TRAIN), {**TRAIN, "provider": None}]
    checked = parsed(spark, json.dumps(two), document())
    trains = reshape.flatten_trains(snapshots.accepted_snapshots(checked))
    assert trains.count() == 1
    assert [r["n"] for r in snapshots.rejected_snapshots(checked).collect()] == [0]
    assert tuple(quality.snapshot_counts(checked).first()) == (2, 1, 1)


def test_flat_rows_have_all_fields_and_types(spark):
    row = reshape.flatten_trains(parsed(spark, document())).first()
    assert row["lat"] == 40.7 and row["lon"] == -74.0 and row["objectID"] == 12
    assert row["onlyOfTrainNum"] is True and row["eventTZ"] is None


def test_train_without_stations_keeps_a_null_row_until_the_filter(spark):
    rows = reshape.station_rows(parsed(spark, changed(["stations"], [])))
    assert [(r["trainNumRaw"], r["code"], r["bus"]) for r in rows.collect()] == [("7", None, None)]
    assert filters.departed_rail(rows).count() == 0


def test_read_stage(spark):
    import datetime as dt
    docs = spark.createDataFrame(
        [(document(),), (changed(["provider"], "Metro"),), (changed(["stations", 0, "bus"], "yes"),),
         (changed(["stations", 0, "status"], "Enroute"),), (document()[:-3],)], "value string")
    rows = ingest.read_stage(docs).collect()
    assert len(rows) == 1
    assert rows[0]["arr"] == dt.datetime(2025, 11, 15, 13, 1)
    assert rows[0]["dep"] == dt.datetime(2025, 11, 15, 13, 6)
    assert rows[0]["schArr"] == dt.datetime(2025, 11, 15, 13, 0)
    for cutoff, kept in [("2025-11-15 13:06:00", 0), ("2025-11-15 13:05:59", 1),
                         ("2025-11-15T08:05:59-05:00", 1)]:
        assert ingest.read_stage(docs, cutoff).count() == kept


@pytest.mark.parametrize("cutoff, kept", [(None, 3), ("2025-01-01 00:00:00", 1)])
def test_cutoff_is_strict_and_drops_nulls_only_when_set(spark, cutoff, kept):
    rows = spark.sql(
        "select * from values (timestamp_ntz'2025-01-01 00:00:00'),"
        " (timestamp_ntz'2025-01-01 00:00:01'), (null) as t(dep)")
    assert filters.newer_than(rows, cutoff).count() == kept


def test_typed_trains_explode_too(spark):
    from railpulse.schemas import TRAIN as LAYOUT
    row = json.loads(document())["7"][0]
    row["lon"] = float(row["lon"])
    rows = reshape.explode_stations(spark.createDataFrame([row], LAYOUT))
    assert rows.first()["code"] == "NYP"
