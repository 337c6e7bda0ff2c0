import json
from pathlib import Path

import pytest
from conftest import rows
from pyspark.sql import functions as F

from tidemark.plans.lake import Lake
from tidemark.plans.load import load_raw, resolve_versions, store_raw
from tidemark.plans.sideload import sideload
from tidemark.sinks.jsonl import write_json_lines
from tidemark.sources.landing import raw_envelope, scan_landing, scan_variant, unread_files, with_row_numbers
from tidemark.sources.manifest import file_fingerprints, file_manifest, with_folder
from tidemark.sources.mappings import mapping_from_json, read_mapping
from tidemark.streaming.landing import ingest_landing, refresh_landing

VERSIONS = dict(ods_version="7.1", data_model_version="5.0")


def put(root, path, *records):
    file = Path(root, path)
    file.parent.mkdir(parents=True, exist_ok=True)
    file.write_text("".join((r if isinstance(r, str) else json.dumps(r)) + "\n" for r in records))


def test_envelope_columns(spark, folder):
    put(folder, "12345678/2024/20240131/20240131T010203/resources/students.jsonl", {"id": 1}, "", {"id": 2, "n": None})
    put(folder, "a b/2023/20240131/20240131T010203/descriptors/grade_descriptors.json", {"id": 3})
    raw = raw_envelope(with_row_numbers(scan_landing(spark, folder)), **VERSIONS)
    got = rows(
        raw, "tenant_code", "api_year", "kind", "name", F.col("pull_date").cast("string"), F.col("pull_timestamp").cast("string"),
        "file_row_number", "ods_version", "data_model_version", F.col("v").cast("string"), F.col("filename").contains("%20"),
    )
    moment = ("2024-01-31", "2024-01-31 01:02:03")
    assert got == [
        ("12345678", 2024, "resources", "students", *moment, 1, "7.1", "5.0", '{"id":1}', False),
        ("12345678", 2024, "resources", "students", *moment, 2, "7.1", "5.0", '{"id":2,"n":null}', False),
        ("a b", 2023, "descriptors", "grade_descriptors", *moment, 1, "7.1", "5.0", '{"id":3}', False),
    ]


def test_bad_lines(spark, folder):
    put(folder, "t/2024/20240131/20240131T010203/resources/students.jsonl", {"id": 1}, "{broken")
    lines = scan_landing(spark, folder)
    with pytest.raises(Exception, match="Malformed"):
        raw_envelope(lines, **VERSIONS).collect()
    assert rows(raw_envelope(lines, **VERSIONS, on_bad_line="null"), F.col("v").isNull()) == [(False,), (True,)]
    with pytest.raises(ValueError):
        raw_envelope(lines, **VERSIONS, lineage="other")


def test_row_numbers_across_splits(spark, folder):
    """A file read in many pieces is numbered by its own line order."""
    put(folder, "one.jsonl", *[f'{{"i": {i}}}' for i in range(1, 20001)])
    put(folder, "two.jsonl", *[f'{{"i": {i}}}' for i in range(1, 5001)])
    spark.conf.set("spark.sql.files.maxPartitionBytes", "10000")
    try:
        lines = scan_landing(spark, folder)
        assert lines.select("file_path", "block_start").distinct().count() > 20
        numbered = with_row_numbers(lines).withColumn("i", F.get_json_object("value", "$.i").cast("bigint"))
        assert numbered.count() == 25000
        assert numbered.filter("i <> file_row_number").isEmpty()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_load_time_lineage_and_given_values(spark, folder):
    put(folder, "anywhere/x.json", {"id": 1})
    raw = raw_envelope(
        scan_landing(spark, folder), **VERSIONS, tenant_code="t", api_year=2024, kind="resources", name="students", lineage="load_time"
    )
    row = raw.withColumns({"today": F.col("pull_date") == F.current_date()}).drop("v").first()
    assert (row["tenant_code"], row["api_year"], row["name"], row["file_row_number"], row["today"]) == ("t", 2024, "students", None, True)


def test_load_replaces_or_appends(spark, folder):
    lake = Lake(folder + "/lake")
    first = "in/t/2024/20240101/20240101T000000/resources"
    put(folder, f"{first}/students.jsonl", {"id": 1}, {"id": 2})
    put(folder, f"{first}/schools.jsonl", {"id": 9})
    load_raw(spark, lake, f"{folder}/{first}", **VERSIONS)
    load_raw(spark, lake, f"{folder}/{first}", **VERSIONS)
    counted = lambda: rows(lake.read_raw(spark).groupBy("name").count())
    assert counted() == [("schools", 2), ("students", 4)]
    second = "in/t/2024/20240102/20240102T000000/resources"
    put(folder, f"{second}/students.jsonl", {"id": 3})
    seen = []
    load_raw(spark, lake, f"{folder}/{second}", **VERSIONS, full_refresh=True, then=seen.append)
    assert counted() == [("schools", 2), ("students", 1)] and seen == [lake.raw]
    load_raw(spark, lake, f"{folder}/{first}", has_change_versions=False, transform=lambda df: df.filter("name = 'schools'"))
    assert rows(lake.read_raw(spark).filter("name = 'schools'"), "ods_version", "data_model_version") == [("ED-FI2", "ED-FI2")]
    assert lake.raw_table(spark, "students").count() == 1


def test_versions():
    assert resolve_versions("1", None, found=("2", "3")) == ("1", "3")
    assert resolve_versions(None, None, has_change_versions=False) == ("ED-FI2", "ED-FI2")
    with pytest.raises(ValueError):
        resolve_versions("1", None)


def test_names_that_are_no_words_are_kept_apart(spark, folder):
    lake = Lake(folder + "/lake")
    put(folder, "in/t/2024/20240101/20240101T000000/resources/a-b.jsonl", {"id": 1})
    put(folder, "in/t/2024/20240101/20240101T000000/resources/ab.jsonl", {"id": 2})
    load_raw(spark, lake, folder + "/in", **VERSIONS)
    assert rows(lake.read_raw(spark), "name", F.col("v").cast("string")) == [("ab", '{"id":2}'), (None, '{"id":1}')]


def test_stream_takes_every_file_once(spark, folder):
    lake, checkpoint = Lake(folder + "/lake"), folder + "/checkpoint"
    run = lambda: ingest_landing(spark, lake, folder + "/in", checkpoint, **VERSIONS, files_per_batch=1)
    base = "in/t/2024/20240101/20240101T000000/resources"
    put(folder, f"{base}/students.jsonl", {"id": 1}, {"id": 2})
    put(folder, f"{base}/schools.jsonl", {"id": 3})
    run()
    run()
    assert rows(lake.read_raw(spark).groupBy("name").count()) == [("schools", 1), ("students", 2)]
    put(folder, "in/t/2024/20240102/20240102T000000/resources/students.jsonl", {"id": 4})
    run()
    assert rows(lake.read_raw(spark).groupBy("name").count()) == [("schools", 1), ("students", 3)]


def test_stream_batch_written_before_a_crash_is_not_doubled(spark, folder):
    """Rows that a broken-off batch left in the table are replaced when it is run again."""
    lake = Lake(folder + "/lake")
    base = "in/t/2024/20240101/20240101T000000/resources"
    put(folder, f"{base}/students.jsonl", {"id": 1}, {"id": 2})
    put(folder, f"{base}/a-b.jsonl", {"id": 3})
    left_over = raw_envelope(scan_landing(spark, folder + "/in"), **VERSIONS)
    store_raw(left_over, lake, full_refresh=False)
    put(folder, "other/t/2024/20231201/20231201T000000/resources/students.jsonl", {"id": 0})
    store_raw(raw_envelope(scan_landing(spark, folder + "/other"), **VERSIONS), lake, full_refresh=False)
    ingest_landing(spark, lake, folder + "/in", folder + "/checkpoint", **VERSIONS)
    assert rows(lake.read_raw(spark), "name", F.col("v").cast("string")) == [
        ("students", '{"id":0}'), ("students", '{"id":1}'), ("students", '{"id":2}'), (None, '{"id":3}'),
    ]


def test_stream_full_refresh(spark, folder):
    lake = Lake(folder + "/lake")
    options = dict(kind="resources", tenant_code="t", api_year=2024, **VERSIONS)
    put(folder, "in/t/2024/20240101/20240101T000000/resources/students.jsonl", {"id": 1})
    for _ in range(2):
        ingest_landing(spark, lake, folder + "/in", folder + "/first", **options)
    put(folder, "in/t/2024/20240102/20240102T000000/resources/students.jsonl", {"id": 2})
    refresh_landing(spark, lake, folder + "/in", folder + "/second", **options)
    assert rows(lake.read_raw(spark), F.col("v").cast("string")) == [('{"id":1}',), ('{"id":2}',)]
    with pytest.raises(ValueError):
        refresh_landing(spark, lake, folder + "/in", folder + "/second", **options)


def test_sideload(spark, folder):
    lake = Lake(folder + "/lake")
    base = "in/t/2024/20240101/20240101T000000/x"
    put(folder, f"{base}/studentGrades.jsonl", {"id": 1})
    put(folder, f"{base}/gradeDescriptors.jsonl", {"id": 2})
    put(folder, f"{base}/others.jsonl", {"id": 3})
    options = dict(run_type="nwea", tenant_code="t", api_year=2024, **VERSIONS)
    sideload(spark, lake, folder + "/in", ["studentGrades", "grade_descriptors"], **options)
    sideload(spark, lake, folder + "/in", ["studentGrades", "grade_descriptors"], **options, full_refresh=True)
    assert rows(lake.read_raw(spark), "kind", "name", "api_year") == [
        ("descriptors", "grade_descriptors__nwea", 2024), ("resources", "student_grades__nwea", 2024),
    ]
    assert lake.raw_table(spark, "_descriptors").count() == 1
    with pytest.raises(ValueError):
        sideload(spark, lake, folder + "/in", [], **options)


def test_json_lines_keep_nulls(spark, folder):
    frame = spark.createDataFrame([(1, None), (2, "x")], "a int, b string")
    write_json_lines(frame, folder + "/out")
    assert rows(spark.read.text(folder + "/out")) == [('{"a":1,"b":null}',), ('{"a":2,"b":"x"}',)]


def test_variant_scan(spark, folder):
    put(folder, "a/x.json", {"id": 1}, {"id": 2})
    assert rows(scan_variant(spark, folder), F.col("v").cast("string")) == [('{"id":1}',), ('{"id":2}',)]


def test_manifest(spark, folder):
    put(folder, "in/a b/one_2024.csv", "x")
    put(folder, "in/c/d/two.txt", "xy")
    got = with_folder(file_manifest(spark, folder + "/in", r"_\d{4}"), folder + "/in")
    assert rows(got, "folder", "file", "length", "matched") == [("a b", "one_2024.csv", 2, True), ("c/d", "two.txt", 3, False)]
    assert rows(file_manifest(spark, folder + "/in"), "matched") == [(True,), (True,)]
    assert file_manifest(spark, folder + "/none").isEmpty()


def test_fingerprints(spark, folder):
    put(folder, "in/a.txt", "x", "y")
    put(folder, "in/b.txt", "x", "y")
    put(folder, "in/c.txt", "x", "x", "y", "y")
    hashes = {Path(row["path"]).name: row["content_hash"] for row in file_fingerprints(spark, folder + "/in").collect()}
    assert hashes["a.txt"] == hashes["b.txt"] != hashes["c.txt"]


def test_fingerprints_tell_the_order_of_lines_but_not_how_a_file_is_cut(spark, folder):
    lines = [f"line {i}" for i in range(3000)]
    for name, own in (("a", lines), ("b", lines), ("swapped", [lines[1], lines[0], *lines[2:]])):
        put(folder, f"in/{name}.txt", *own)
    once = dict(rows(file_fingerprints(spark, folder + "/in")))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "5000")
    try:
        assert dict(rows(file_fingerprints(spark, folder + "/in"))) == once
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    a, b, swapped = (next(h for path, h in once.items() if path.endswith(f"/{n}.txt")) for n in ("a", "b", "swapped"))
    assert a == b != swapped


@pytest.mark.parametrize("name", ["a%20b.csv", "100%.csv", "c#1 d+e.csv"])
def test_manifest_takes_names_as_they_are(spark, folder, name):
    put(folder, f"in/{name}", "x")
    assert rows(with_folder(file_manifest(spark, folder + "/in", r"[.]csv$"), folder + "/in"), "file", "matched") == [(name, True)]


def test_packed_and_unread_files(spark, folder):
    import gzip

    base = "in/t/2024/20240101/20240101T000000/resources"
    put(folder, f"{base}/students.ndjson", {"id": 1})
    put(folder, f"{base}/notes.csv", "x")
    with gzip.open(f"{folder}/{base}/schools.jsonl.gz", "wt") as file:
        file.write("".join(f'{{"id": {i}}}\n' for i in range(1, 501)))
    raw = raw_envelope(with_row_numbers(scan_landing(spark, folder + "/in")), **VERSIONS)
    assert rows(raw.groupBy("name").agg(F.count("*"), F.max("file_row_number"))) == [("schools", 500, 500), ("students", 1, 1)]
    assert raw.filter("name = 'schools' and file_row_number <> variant_get(v, '$.id', 'int')").isEmpty()
    assert [r[0].rsplit("/", 1)[1] for r in rows(unread_files(spark, folder + "/in"), "path")] == ["notes.csv"]


def test_payloads_over_several_lines_go_through_the_landing_folder(spark, folder):
    from tidemark.sinks.jsonl import write_landing

    frame = spark.createDataFrame([("t", 2024, "20240101", "20240101T000000", "resources", "students", '{"a":\n 1}')], "tenant_code string, api_year int, ds string, ts string, kind string, name string, payload string")
    write_landing(frame, folder + "/in")
    assert rows(raw_envelope(scan_landing(spark, folder + "/in"), **VERSIONS), "name", F.col("v").cast("string")) == [("students", '{"a":1}')]


def test_mapping(spark, folder):
    Path(folder, "map.json").write_text('{\n "t": "1",\n "u": 2\n}')
    assert rows(read_mapping(spark, folder + "/map.json")) == [("t", "1"), ("u", "2")]
    assert rows(mapping_from_json(spark, '{"a": "b"}')) == [("a", "b")]
