import json

import pytest
from conftest import rows
from pyspark.sql import functions as F

from tidemark.operators import logs as L, payloads as P
from tidemark.operators.joins import join_small_side
from tidemark.plans.lake import Lake
from tidemark.plans.runlog import append_run_log, captured

RUN = "tenant_code string, api_year int, grain_update string, run_type string, run_date string, run_timestamp string"
RECORD = "seq long, timestamp string, name string, level string, message string, pathname string, lineno int, args map<string,string>, kwargs map<string,string>"


def log(spark, *entries):
    """Entries are (run, seq, level, message)."""
    data = [
        ("t", 2024, None, run, "2024-01-01", "2024-01-01 00:00:00", seq, f"at{seq}", "task", level, message, "p.py", seq, {"0": str(seq)}, {"k": run})
        for run, seq, level, message in entries
    ]
    return spark.createDataFrame(data, f"{RUN}, {RECORD}")


def test_rollup_keeps_order_and_the_last_arguments(spark):
    frame = log(spark, ("a", 2, "ERROR", "second"), ("a", 1, "INFO", "an ERROR inside"), ("a", 3, "INFO", "fine"), ("b", 1, "INFO", "fine"))
    (row,) = L.error_rollup(frame).collect()
    assert (row["run_type"], row["part"], row["n_errors"], row["args"], row["last_error_timestamp"]) == ("a", 0, 2, {"0": "2"}, "at2")
    assert [(e["message"], e["lineno"]) for e in row["errors"]] == [("an ERROR inside", 1), ("second", 2)]
    assert set(row["errors"][0].asDict()) == {"timestamp", "name", "level", "message", "pathname", "lineno"}


def test_long_runs_are_in_parts_and_whole(spark):
    frame = log(spark, *[("big", i, "ERROR", str(i)) for i in range(25)], *[("small", i, "ERROR", str(i)) for i in (3, 17)])
    parts = rows(L.error_rollup(frame, chunk=10).select("run_type", "part", "n_errors", F.size("errors")))
    assert parts == [("big", 0, 25, 10), ("big", 1, 25, 10), ("big", 2, 25, 5), ("small", 0, 2, 2)]


def test_map_index_names(spark):
    runs = spark.createDataFrame([("r", 0), ("r", 1), ("r", 2), ("s", 0)], "run string, map_index int")
    files = spark.createDataFrame([("r", 0, "/in/a.csv"), ("r", 1, "b.csv")], "run string, map_index int, path string")
    assert rows(L.map_index_names(runs, files, ["run"])) == [("r", 0, "a.csv"), ("r", 1, "b.csv"), ("r", 2, None), ("s", 0, None)]
    none = spark.createDataFrame([(None, 0), ("", 0)], "run string, map_index int")
    files = spark.createDataFrame([(None, 0, "/in/c.csv"), ("", 0, "d.csv")], "run string, map_index int, path string")
    assert rows(L.map_index_names(none, files, ["run"])) == [("", 0, "d.csv"), (None, 0, "c.csv")]


def test_grains_null_and_blank_are_runs_of_their_own(spark):
    frame = log(spark, ("a", 1, "ERROR", "of null"))
    both = frame.unionByName(frame.withColumns({"grain_update": F.lit(""), "message": F.lit("of blank")}))
    got = rows(L.error_rollup(both).select("grain_update", "n_errors", F.transform("errors", lambda e: e["message"])))
    assert got == [("", 1, ["of blank"]), (None, 1, ["of null"])]


def test_parts_follow_one_rule(spark):
    """Positions are by order, so that neither gaps nor one error more change what a part holds."""
    for n in (4, 5):
        frame = log(spark, *[("r", 10 ** i, "ERROR", str(i)) for i in range(n)])
        parts = rows(L.error_rollup(frame, chunk=4).select("part", F.size("errors")))
        assert parts == [(0, 4), (1, 1)][: n - 3]


def test_errors_without_a_position_are_listed(spark):
    frame = log(spark, ("some", None, "ERROR", "unplaced"), ("some", -3, "ERROR", "before"), ("some", 2, "ERROR", "placed"), *[("none", None, "ERROR", str(i)) for i in range(5)])
    parts = rows(L.error_rollup(frame, chunk=3).select("run_type", "part", "n_errors", F.transform("errors", lambda e: e["message"])))
    assert [(r[0], r[1], r[2], len(r[3])) for r in parts] == [("none", 0, 5, 3), ("none", 1, 5, 2), ("some", 0, 3, 3)]
    assert parts[2][3] == ["unplaced", "before", "placed"] and sorted(parts[0][3] + parts[1][3]) == list("01234")


def test_captured_work_logs_its_error_and_raises(spark, folder):
    lake = Lake(folder)
    run = {"tenant_code": "t", "api_year": 2024, "run_type": "x", "run_date": "2024-01-01", "run_timestamp": "2024-01-01 00:00:00"}

    def divide(a, by):
        return a / by

    assert captured(spark, lake, run, divide, 4, by=2) == 2
    assert lake.read_run_log(spark).isEmpty()
    with pytest.raises(ZeroDivisionError):
        captured(spark, lake, run, divide, 4, by=0)
    (row,) = lake.read_run_log(spark).select("*", F.col("result").cast("string").alias("text")).collect()
    document = json.loads(row["text"])
    assert (row["tenant_code"], row["grain_update"], row["run_type"]) == ("t", None, "x")
    assert document["args"] == {"0": "4"} and document["kwargs"] == {"by": "0"}
    assert document["errors"][0]["message"] == "work stopped by ZeroDivisionError: division by zero"


def test_run_log_keeps_any_json(spark, folder):
    text = json.dumps({"a": "$$ ' \" \\", "n": None, "l": [1, {"b": 2}]})
    frame = spark.createDataFrame([("t", 2024, "", "x", "2024-01-01", "2024-01-01 00:00:00", text)], f"{RUN}, result string")
    append_run_log(frame, Lake(folder))
    row = Lake(folder).read_run_log(spark).select(F.col("result").cast("string"), "grain_update").first()
    assert json.loads(row[0]) == json.loads(text) and row[1] is None


@pytest.fixture
def sending(spark):
    payloads = spark.createDataFrame([("e", "new"), ("e", "new"), ("e", "ok"), ("e", "bad"), ("f", "ok"), ("e", "fixed")], "endpoint string, payload string")
    sent = spark.createDataFrame(
        [("e", "ok", "2024-01-01", 201), ("e", "bad", "2024-01-05", 500), ("e", "fixed", "2024-01-01", 500), ("e", "fixed", "2024-01-02", 201)],
        "endpoint string, p string, at string, status_code int",
    ).select("endpoint", F.sha2("p", 256).alias("payload_hash"), F.col("at").cast("timestamp").alias("sent_at"), "status_code")
    return payloads, sent


@pytest.mark.parametrize(
    "options, expected",
    [
        ({}, [("e", "new", 2, "new"), ("f", "ok", 1, "new")]),
        ({"resend_status_codes": [500]}, [("e", "bad", 1, "resend"), ("e", "new", 2, "new"), ("f", "ok", 1, "new")]),
        ({"older_than": "2024-01-02"}, [("e", "new", 2, "new"), ("e", "ok", 1, "resend"), ("f", "ok", 1, "new")]),
        ({"newer_than": "2024-01-01 12:00:00"}, [("e", "bad", 1, "resend"), ("e", "fixed", 1, "resend"), ("e", "new", 2, "new"), ("f", "ok", 1, "new")]),
        ({"newer_than": "2024-01-01 12:00:00", "resend_status_codes": [201]}, [("e", "fixed", 1, "resend"), ("e", "new", 2, "new"), ("f", "ok", 1, "new")]),
        ({"force": True}, [("e", "bad", 1, "forced"), ("e", "fixed", 1, "forced"), ("e", "new", 2, "forced"), ("e", "ok", 1, "forced"), ("f", "ok", 1, "forced")]),
    ],
)
def test_payloads_to_send(sending, options, expected):
    assert rows(P.payloads_to_send(*sending, **options), "endpoint", "payload", "copies", "reason") == expected


@pytest.mark.parametrize("limit", [None, 0])
def test_payloads_without_endpoint_or_text_are_sent(spark, sending, monkeypatch, limit):
    """Whether the chosen side is broadcast or not."""
    if limit is not None:
        monkeypatch.setattr(P, "join_small_side", lambda *sides: join_small_side(*sides, limit=limit))
    payloads = spark.createDataFrame([(None, "new"), (None, "new"), ("e", None), (None, None), ("", "new"), ("e", "ok")], "endpoint string, payload string")
    got = rows(P.payloads_to_send(payloads, sending[1]), "endpoint", "payload", "copies", "reason")
    assert got == sorted([(None, "new", 2, "new"), ("e", None, 1, "new"), (None, None, 1, "new"), ("", "new", 1, "new")], key=repr)


def test_changed_inputs(spark):
    current = spark.createDataFrame([("a", "1"), ("b", "2"), ("c", "3")], "path string, content_hash string")
    state = spark.createDataFrame([("a", "1"), ("b", "old")], "path string, content_hash string")
    assert rows(P.changed_inputs(current, state), "path") == [("b",), ("c",)]
    assert P.changed_inputs(current, state, force=True).count() == 3
    assert P.changed_inputs(current, state, skip_hashing=True).count() == 3
