"""Sharding against a plain count of the same records."""

import csv
import random
from collections import Counter
from pathlib import Path

import pytest
from conftest import rows
from pyspark.sql import functions as F

from checks.queries import _all_shards, _csvs
from tidemark.plans.shard import partition_on_tenant_and_year, read_shards, rejected_rows, shard_rows
from tidemark.sources.csvs import read_text_columns

DISTRICTS = ["north", "south side", "é-lab", "007"]


def records(n, seed, districts=DISTRICTS, years=range(2011, 2016)):
    """Most of the records are of the first district, one is of the last."""
    random.seed(seed)
    out = [(f"p{i:05}", random.choice(districts[:2] if i % 3 else districts[:1]), str(random.choice(years)), random.choice(["", "NA", 'say "so"', "a,b"])) for i in range(n)]
    out[n // 2] = (out[n // 2][0], districts[-1], *out[n // 2][2:])
    return out


def put(path, data, header=("pupil", "tenant_code", "api_year", "remark")):
    Path(path).parent.mkdir(parents=True, exist_ok=True)
    with open(path, "w", newline="") as file:
        csv.writer(file, lineterminator="\n").writerows([header, *data])
    return str(path)


def counts(spark, target):
    return {(r["tenant_code"], r["api_year"]): r["count"] for r in read_shards(spark, target).groupBy("tenant_code", "api_year").count().collect()}


def folders(target):
    return {p.relative_to(target).as_posix() for p in Path(target).glob("*/*") if any(p.glob("part-*"))}


def test_rows_lie_in_the_folder_of_their_tenant_and_year(spark, folder):
    data = records(700, 1, ["north", "west", "lone"])
    path = put(f"{folder}/enrol.csv", data)
    (target,) = partition_on_tenant_and_year(spark, Path(path), Path(folder) / "out")
    want = Counter(r[1:3] for r in data)
    assert target == f"{folder}/out/enrol" and counts(spark, target) == want
    assert folders(target) == {f"tenant_code={t}/api_year={y}" for t, y in want}
    assert rows(read_shards(spark, target), "pupil", "remark", "tenant_code", "api_year") == sorted([(r[0], r[3], r[1], r[2]) for r in data], key=repr)


def test_each_file_has_a_folder_of_its_own(spark, folder):
    sizes = {"a": 11, "b.2": 90, "c d": 3}
    paths = [put(f"{folder}/{stem}.csv", records(n, n)) for stem, n in sizes.items()]
    targets = partition_on_tenant_and_year(spark, [Path(paths[0]), *paths[1:]], f"{folder}/out")
    assert [t.rsplit("/", 1)[1] for t in targets] == list(sizes)
    assert [sum(counts(spark, t).values()) for t in targets] == list(sizes.values())


@pytest.mark.parametrize("name", ["with blank", "half%", "c#1", "plus+and=", "pct%20y"])
def test_names_of_files_may_hold_any_character(spark, folder, name):
    (target,) = partition_on_tenant_and_year(spark, put(f"{folder}/{name}.csv", records(20, 5)), f"{folder}/out")
    assert sum(counts(spark, target).values()) == 20


def test_columns_and_values_may_have_other_names(spark, folder):
    data = records(300, 2, ["N", "S", "X"], years=range(1, 5))
    path = put(f"{folder}/x.csv", data, ("pupil", "school", "term", "remark"))
    (target,) = partition_on_tenant_and_year(
        spark, path, f"{folder}/out", tenant_col="school", tenant_map={"N": "north", "S": "south"}, year_col="term", year_map={1: 2020, "2": "2021", 3: "03"},
    )
    tenants, years = {"N": "north", "S": "south"}, {"1": "2020", "2": "2021", "3": "03"}
    assert counts(spark, target) == Counter((tenants.get(r[1]), years.get(r[2])) for r in data)
    shards = read_shards(spark, target)
    assert shards.columns == ["pupil", "school", "term", "remark", "tenant_code", "api_year"]
    assert rejected_rows(shards).count() == sum(r[1] not in tenants or r[2] not in years for r in data)


def test_a_lone_row_beside_a_huge_tenant(spark, folder):
    n, lone = 1_200_000, 777_777
    source = spark.range(n).select(
        F.format_string("u%07d", F.col("id")).alias("pupil"), F.when(F.col("id") == lone, "lone").when(F.col("id") % 50 == 0, "small").otherwise("huge").alias("tenant_code"),
        (F.col("id") % 4 + 2018).cast("string").alias("api_year"),
    )
    source.coalesce(1).write.option("header", True).csv(f"{folder}/in")
    (path,) = Path(folder, "in").glob("*.csv")
    (target,) = partition_on_tenant_and_year(spark, str(path), f"{folder}/out")
    got = counts(spark, target)
    assert got["lone", str(lone % 4 + 2018)] == 1 and sum(got.values()) == n
    assert sum(k for (tenant, _), k in got.items() if tenant == "small") == sum(i % 50 == 0 and i != lone for i in range(0, n, 50))
    assert rows(read_shards(spark, target).filter("tenant_code = 'lone'"), "pupil") == [(f"u{lone:07}",)]


def test_malformed_records_are_kept_beside_the_rows(spark, folder):
    good, bad = records(40, 8), ["p1,north,2011,x,surplus", "p2,north", 'p3,north,2012,"torn', 'in two"']
    path = put(f"{folder}/m.csv", good)
    Path(path).write_text(Path(path).read_text() + "\n".join(bad) + "\n")
    (target,) = partition_on_tenant_and_year(spark, path, f"{folder}/out")
    assert counts(spark, target) == Counter(r[1:3] for r in good)
    assert rows(spark.read.text(f"{folder}/out/_malformed/m")) == sorted([(line,) for line in bad], key=repr)
    whole = put(f"{folder}/w.csv", [("p1", "north", "2011", "two\nlines")])
    (target,) = partition_on_tenant_and_year(spark, whole, f"{folder}/out", multiline=True)
    assert rows(read_shards(spark, target), "remark") == [("two\nlines",)] and not Path(folder, "out/_malformed/w").exists()
    short = put(f"{folder}/s.csv", [("p1", "north", "2011", "two\nlines"), ("p2", "north")])
    (target,) = partition_on_tenant_and_year(spark, short, f"{folder}/out", multiline=True)
    assert rows(read_shards(spark, target), "pupil") == [("p1",)] and rows(spark.read.text(f"{folder}/out/_malformed/s")) == [("p2,north",)]


@pytest.mark.parametrize("block", ["128m", "64"])
def test_only_the_first_line_is_the_header(spark, folder, block):
    """Lines that equal it later on stay, in every block alike."""
    head = ("pupil", "tenant_code", "api_year", "remark")
    good = [("p1", "north", "2011", "a"), head, ("p2", "north", "2011", "b"), *[("p3", "south", "2012", "c" * 20)] * 9, head]
    path = put(f"{folder}/j.csv", good)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", block)
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        (target,) = partition_on_tenant_and_year(spark, path, f"{folder}/out")
        assert counts(spark, target) == Counter(r[1:3] for r in good)
        put(f"{folder}/two/b.csv", good[:3])
        Path(folder, "two/b.csv").write_text("\n" + Path(folder, "two/b.csv").read_text())
        put(f"{folder}/two/a.csv", good)
        both = read_text_columns(spark, f"{folder}/two")
        assert rows(both, "pupil") == sorted((r[0],) for r in good + good[:3])
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_csvs_of_queries_are_written_in_parallel(spark, folder):
    data = [(f"p{i}", "north" if i % 2 else "south", "2011") for i in range(40)]
    lines = spark.createDataFrame([(",".join(r),) for r in data], "value string").repartition(4)
    paths = _csvs(spark, lines, "pupil,tenant_code,api_year", "some")
    assert len(paths) == 4
    targets = partition_on_tenant_and_year(spark, paths, f"{folder}/out")
    assert rows(_all_shards(spark, targets)) == sorted(data, key=repr)


def test_what_is_refused(spark, folder):
    path = put(f"{folder}/in/d.csv", records(9, 3))
    Path(folder, "folder.csv").mkdir()
    for wrong in (f"{folder}/absent.csv", f"{folder}/folder.csv", put(f"{folder}/d.tsv", [])):
        with pytest.raises(ValueError):
            partition_on_tenant_and_year(spark, wrong, folder)
    with pytest.raises(ValueError, match="base name"):
        partition_on_tenant_and_year(spark, [path, put(f"{folder}/other/d.csv", [])], folder)
    for options in ({"tenant_col": "nobody"}, {"year_col": "never"}):
        with pytest.raises(KeyError, match="nobody|never"):
            partition_on_tenant_and_year(spark, path, f"{folder}/out", **options)
    assert not Path(folder, "out").exists()
    with pytest.raises(ValueError, match="two values"):
        partition_on_tenant_and_year(spark, path, folder, year_map={2011: "a", "2011": "b"})


def test_sharding_again_replaces_the_rows(spark, folder):
    for seed, districts in ((1, ["old", "older"]), (2, ["new", "newer"])):
        data = records(30, seed, districts)
        (target,) = partition_on_tenant_and_year(spark, put(f"{folder}/d.csv", data), folder)
    assert counts(spark, target) == Counter(r[1:3] for r in data)


@pytest.mark.parametrize("entries", [3, 90])
def test_maps_of_any_length_give_the_same(spark, entries):
    data = spark.range(600).select((F.col("id") % 120).cast("string").alias("t"), F.lit("9").alias("y"), "id")
    values = {**{k: f"v{k}" for k in range(entries)}, **{str(k): f"v{k}" for k in range(0, entries, 2)}}
    got = rows(shard_rows(data, "t", values, "y", {}), "id", "tenant_code", "api_year")
    assert got == sorted([(i, f"v{i % 120}" if i % 120 < entries else None, None) for i in range(600)], key=repr)


def test_files_without_rows(spark, folder):
    header = put(f"{folder}/h.csv", [])
    (target,) = partition_on_tenant_and_year(spark, header, f"{folder}/out")
    assert not folders(target)
    only_bad = put(f"{folder}/b.csv", [("p1", "north")])
    (target,) = partition_on_tenant_and_year(spark, only_bad, f"{folder}/out")
    assert not folders(target) and rows(spark.read.text(f"{folder}/out/_malformed/b")) == [("p1,north",)]
    with pytest.raises(KeyError):
        Path(folder, "e.csv").write_text("")
        partition_on_tenant_and_year(spark, f"{folder}/e.csv", f"{folder}/out")
