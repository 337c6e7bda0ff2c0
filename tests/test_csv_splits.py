"""CSV records that reach over splits, and many files of few headers."""

import csv
import io
import random
from pathlib import Path

import pytest
from conftest import rows

from tidemark.plans.shard import partition_on_tenant_and_year, read_all_shards
from tidemark.sources import csvs
from tidemark.sources.csvs import MALFORMED, first_lines, quoted_records, read_text_columns, well_formed


@pytest.fixture
def split(spark):
    """Sets the bytes of a split."""
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    yield lambda size: spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
    spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def put(folder, name, text):
    path = Path(folder, name)
    path.write_bytes(text.encode())
    return str(path)


def table(seed, n=120):
    source = random.Random(seed)
    pieces = ["a", "bc", "\n", "\n\n", '"', ",", " ", "é", "\r\n", "x" * 30]
    return [[str(i), "".join(source.choice(pieces) for _ in range(source.randrange(6))), source.choice(["t1", "", 'q"q'])] for i in range(n)]


def written(own, end):
    text = io.StringIO()
    writer = csv.writer(text, lineterminator=end)
    writer.writerow(["id", "note", "tenant"])
    writer.writerows(own)
    return text.getvalue()


@pytest.mark.parametrize("size", [40, 97, 1000, 10**6])
@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_records_over_splits(spark, folder, split, size, end):
    split(size)
    paths, want = [], []
    for seed in range(3):
        own = table(seed)
        paths.append(put(folder, f"f{seed}.csv", written(own, end)))
        want += [tuple(r) for r in own]
    got = read_text_columns(spark, paths, quoted_breaks=True)
    if size < 1000:
        assert spark.read.text(paths).rdd.getNumPartitions() > 20
    assert got.filter(got[MALFORMED].isNotNull()).count() == 0
    assert rows(well_formed(got)) == sorted(want, key=repr)


@pytest.mark.parametrize("limit", [0, 1 << 30])
def test_blocks_beyond_the_broadcast_limit_are_the_same(spark, folder, split, monkeypatch, limit):
    split(50)
    monkeypatch.setattr(csvs, "BROADCAST_BYTES", limit)
    monkeypatch.setattr(csvs, "join_small_side", lambda *a, f=csvs.join_small_side, **k: f(*a, **k, limit=limit))
    own = table(9)
    path = put(folder, "f.csv", written(own, "\n"))
    assert rows(well_formed(read_text_columns(spark, path, quoted_breaks=True))) == sorted(map(tuple, own), key=repr)


@pytest.mark.parametrize("size", [25, 10**6])
def test_open_quotes_and_blank_lines(spark, folder, split, size):
    split(size)
    path = put(folder, "f.csv", 'id,note\n\n1,"a\n\nb"\n   \n2,c,d\n3,e\n4,"open\n5,f\n6,g')
    got = read_text_columns(spark, path, quoted_breaks=True)
    assert rows(well_formed(got)) == [("1", "a\n\nb"), ("3", "e")]
    assert rows(got.filter(got[MALFORMED].isNotNull()).select("note", MALFORMED), MALFORMED) == sorted([("2,c,d",), ('4,"open\n5,f\n6,g',)], key=repr)


def test_records_that_are_too_long_stay_in_pieces(spark, folder, split, monkeypatch):
    split(30)
    monkeypatch.setattr(csvs, "MOST_BYTES", 60)
    path = put(folder, "f.csv", 'id,note\n1,"a\nb"\n2,"' + "\n".join(f"{i},x" for i in range(60)))
    got = read_text_columns(spark, path, quoted_breaks=True)
    assert rows(well_formed(got)) == [("1", "a\nb")]
    torn = [r[0] for r in got.filter(got[MALFORMED].isNotNull()).select("note", MALFORMED).select(MALFORMED).collect()]
    assert len(torn) > 2 and sorted("\n".join(torn).split("\n")) == sorted(['2,"0,x', *(f"{i},x" for i in range(1, 60))])


def test_header_with_a_line_break_over_splits(spark, folder, split):
    split(10)
    path = put(folder, "f.csv", '\n"id\nof it","no\nte"\n1,2\n"id\nof it","no\nte"\n')
    assert first_lines(spark, [path]) == {path: '"id\nof it","no\nte"'}
    got = [r["value"] for r in quoted_records(spark, [path]).filter("not __first").collect()]
    assert sorted(got) == sorted(["1,2", '"id\nof it","no\nte"'])


def test_empty_files(spark, folder):
    empty, head = put(folder, "e.csv", ""), put(folder, "h.csv", "id,note\n")
    assert first_lines(spark, [empty, head]) == {empty: None, head: "id,note"}
    assert read_text_columns(spark, head, quoted_breaks=True).count() == 0
    with pytest.raises(ValueError, match="different headers"):
        read_text_columns(spark, [empty, head])


def test_scan_that_is_cut_finer_is_refused(spark, folder, split):
    path = put(folder, "f.csv", written(table(1), "\n"))
    split(10**6)
    records = quoted_records(spark, [path])
    split(50)
    with pytest.raises(Exception, match="cut otherwise"):
        records.collect()


def many(folder, n):
    made = []
    for i in range(n):
        head, line = ("pupil,tenant_code,api_year", "p{},t,{}") if i % 2 else ("api_year,pupil,tenant_code", "{1},p{0},t")
        made.append(put(folder, f"n{n}-{i}.csv", "\n".join([head, *(line.format(f"{i}-{k}", 2020 + k) for k in range(3)), "torn"])))
    return made


def test_jobs_do_not_grow_with_files(spark, folder):
    jobs = {}
    for n in (4, 40):
        spark.sparkContext.setJobGroup(f"files-{n}", "")
        targets = partition_on_tenant_and_year(spark, many(folder, n), f"{folder}/out{n}")
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        jobs[n] = len(spark.sparkContext.statusTracker().getJobIdsForGroup(f"files-{n}"))
        got = read_all_shards(spark, targets)
        assert rows(got, "file", "pupil", "tenant_code", "api_year") == sorted([(f"n{n}-{i}", f"p{i}-{k}", "t", str(2020 + k)) for i in range(n) for k in range(3)], key=repr)
        assert spark.read.text(f"{folder}/out{n}/_malformed/*").count() == n
    assert 0 < jobs[40] <= jobs[4] + 2


def test_columns_in_another_order_meet_their_names(spark, folder):
    a, b = put(folder, "a.csv", "pupil,tenant_code,api_year\np1,x,2020\n"), put(folder, "b.csv", "tenant_code,pupil,api_year\ny,p2,\n")
    targets = partition_on_tenant_and_year(spark, [a, b], f"{folder}/out")
    assert rows(read_all_shards(spark, targets), "file", "pupil", "tenant_code", "api_year") == [("a", "p1", "x", "2020"), ("b", "p2", "y", None)]


def test_values_of_any_character(spark, folder):
    path = put(folder, "odd name+.csv", "pupil,tenant_code,api_year\np,a/b c+%20=é,2020\n")
    (target,) = partition_on_tenant_and_year(spark, path, f"{folder}/out")
    assert rows(read_all_shards(spark, [target]), "file", "tenant_code") == [("odd name+", "a/b c+%20=é")]


def test_very_many_small_splits_share_tasks(spark, folder, split):
    split(50)
    own = [r for seed in range(8) for r in table(seed)]
    path = put(folder, "many.csv", written(own, "\n"))
    assert spark.read.text(path).rdd.getNumPartitions() > 200
    got = read_text_columns(spark, path, quoted_breaks=True)
    assert got.rdd.getNumPartitions() <= 2 * csvs.TASKS_OF_CORE * spark.sparkContext.defaultParallelism  # whole records, and pieces
    assert rows(well_formed(got)) == sorted([tuple(r) for r in own], key=repr)
    split(csvs.TASK_BYTES)
    lines = spark.read.text([path] * 40)
    assert csvs._in_fewer_tasks(lines) is lines  # blocks of that size have their own tasks
