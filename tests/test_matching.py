import math
import random

import pytest
from conftest import rows

from tidemark.operators import matchrates as R
from tidemark.plans import idmatch
from tidemark.plans.lake import Lake
from tidemark.schemas import MATCH_RATES
from tidemark.sources.csvs import read_match_rates


def rate_rows(spark, data):
    full = [(s, e, n, d, n / d, t, 2024, a) for s, e, n, d, t, a in data]
    return spark.createDataFrame(full, MATCH_RATES)


def test_match_rates_against_brute_force(spark):
    rng = random.Random(7)
    source = [(rng.choice(["t", "u"]), rng.choice([None, 1, 1, 1, 2, 3]), str(rng.randrange(6))) for _ in range(300)]
    people = [(rng.choice(["t", "u"]), rng.randrange(1, 9), rng.choice([None, "1", "4"])) for _ in range(12)]
    got = R.match_rates(
        spark.createDataFrame(source, "tenant_code string, a int, b string"),
        spark.createDataFrame(people, "tenant_code string, x int, y string"), ["a", "b"], ["x", "y"], by=["tenant_code"],
    )
    want = []
    for tenant in ("t", "u"):
        mine = [row for row in source if row[0] == tenant]
        for i, s in ((1, "a"), (2, "b")):
            for j, e in ((1, "x"), (2, "y")):
                ids = {str(p[j]) for p in people if p[0] == tenant and p[j] is not None}
                hits = sum(row[i] is not None and str(row[i]) in ids for row in mine)
                want.append((tenant, s, e, hits, len(mine)))
    assert rows(got, "tenant_code", "source_column_name", "edfi_column_name", "num_matches", "num_rows") == sorted(want, key=repr)
    assert all(math.isclose(row["match_rate"], row["num_matches"] / row["num_rows"]) for row in got.collect())


PAIR = ("tenant_code", "source_column_name", "edfi_column_name")


@pytest.fixture(scope="module")
def many_columns(spark):
    """Ids in `a`, half of them known, one hot; codes that never match in `b`, texts in `c`, nulls in `d`; an unknown tenant."""
    rng = random.Random(11)
    source = [
        (t, rng.choice([rng.randrange(400), 7]), f"code{rng.randrange(50)}", "" if i % 3 else f"text {i}", None)
        for i in range(1500) for t in [rng.choice(["t", "u", "v", None])]
    ]
    people = [(t, i, str(i * 2) if i % 2 else None) for t in ("t", "u") for i in range(200)]
    return (
        spark.createDataFrame(source, "tenant_code string, a int, b string, c string, d string"),
        spark.createDataFrame(people, "tenant_code string, x int, y string"), ["a", "b", "c", "d"], ["x", "y"], ["tenant_code"],
    )


@pytest.mark.parametrize("limit", [64 << 20, 0])
@pytest.mark.parametrize("required", [0.0, 0.05, 0.3, 0.7, 1.0])
def test_sufficient_rates_are_those_of_match_rates(many_columns, required, limit):
    every = R.match_rates(*many_columns[:4], by=many_columns[4])
    got = R.sufficient_rates(*many_columns[:4], by=many_columns[4], required=required, limit=limit)
    want = rows(every.filter(R.meets_rate(required)))
    assert got.columns == every.columns and rows(got) == want and (want or required > 0.7)


def test_sufficient_rates_without_groups_or_rows(spark, many_columns):
    source, people, source_columns, roster_columns, _ = many_columns
    for left, right in ((source, people), (source.filter("false"), people), (source, people.filter("false"))):
        every = R.match_rates(left, right, source_columns, roster_columns)
        assert rows(R.sufficient_rates(left, right, source_columns, roster_columns, required=0.2)) == rows(every.filter(R.meets_rate(0.2)))


def test_bounds_lose_no_pair_and_leave_out_what_cannot_suffice(many_columns, monkeypatch):
    source, people, source_columns, roster_columns, by = many_columns
    ids, known = R._ids(source, source_columns, by, "source_column_name"), R.settled(R._known(people, roster_columns, by))
    every = R.match_rates(source, people, source_columns, roster_columns, by=by)
    for required in (0.01, 0.3, 0.6):
        enough = set(rows(every.filter(R.meets_rate(required)), *PAIR))
        possible = set(rows(R.possible_pairs(ids, known, roster_columns, by, by, required), *PAIR))
        assert enough <= possible
        if required == 0.3:
            assert enough and {pair[1] for pair in possible} == {"a"}
    assert R.possible_pairs(ids, known, roster_columns, by, by, 0.3, limit=R.BITMAP_BYTES) is None
    # all ids at one place: bounds say little, and still lose nothing
    monkeypatch.setattr(R.F, "xxhash64", lambda *columns: R.F.when(R.F.col(columns[0]).isNotNull(), R.F.lit(5)).otherwise(5))
    crowded = set(rows(R.possible_pairs(ids, known, roster_columns, by, by, 0.3), *PAIR))
    assert set(rows(every.filter(R.meets_rate(0.3)), *PAIR)) < crowded


def test_best_config_breaks_ties_by_name(spark):
    rates = rate_rows(spark, [("s1", "e1", 5, 10, "t", "x"), ("s2", "e1", 5, 10, "t", "x"), ("s0", "e2", 5, 10, "t", "x"),
                              ("s9", "e9", 4, 10, "t", "x"), ("s1", "e1", 4, 10, "t", "y")])
    assert rows(R.best_config(rates), "assessment_name", "source_column_name", "edfi_column_name") == [("x", "s0", "e2")]
    assert rows(R.best_config_of(rates, "t", 2024, "x"), "source_column_name", "edfi_column_name") == [("s0", "e2")]
    assert R.best_config_of(rates, "t", 2024, "y").isEmpty()
    assert rows(R.max_rate(rates)) == [(0.5,)]
    assert rows(R.max_rate(rates, 0.9)) == [(None,)]


def test_gate(spark):
    rates = rate_rows(spark, [("s", "e", 5, 10, "t", "x"), ("s", "e", 4, 10, "t", "y")])
    assert rows(R.gate(rates, 0.5, ["assessment_name"])) == [("x", True), ("y", False)]
    assert rows(R.gate(rates.filter("false"))) == [(False,)]
    assert rows(R.gate(rates.filter("false"), reused=True)) == [(True,)]


def test_id_match_computes_publishes_and_reuses(spark, folder):
    lake = Lake(folder)
    source = spark.createDataFrame([("1", "9"), ("2", "9"), ("3", "9"), ("4", "9")], "local string, state string")
    people = spark.createDataFrame([("t", 2024, 1), ("t", 2024, 2), ("t", 2023, 3)], "tenant_code string, api_year int, unique_id int")
    options = dict(tenant_code="t", api_year=2024, assessment_name="x", source_columns=["local", "state"], roster_columns=["unique_id"])
    best, passed = idmatch.id_match(spark, lake, source, people, **options)
    assert passed and rows(best, "source_column_name", "num_matches", "num_rows") == [("local", 2, 4)]
    assert lake.read_match_rates(spark).count() == 2
    again, passed = idmatch.id_match(spark, lake, source.filter("false"), people, **options)
    assert passed and rows(again, "source_column_name", "match_rate") == [("local", 0.5)]
    other, passed = idmatch.id_match(spark, lake, source, people, **{**options, "assessment_name": "z"}, required=0.9)
    assert not passed and other.isEmpty() and lake.read_match_rates(spark).filter("assessment_name = 'z'").isEmpty()
    earlier, passed = idmatch.id_match(
        spark, lake, source, people, **{**options, "assessment_name": "w"}, required=0.2, parameters={"roster_api_year": 2023}
    )
    assert passed and rows(earlier, "num_matches") == [(1,)]


def test_match_rate_files(spark, folder):
    lake = Lake(folder + "/lake")
    path = folder + "/student_id_match_rates.csv"
    with open(path, "w") as file:
        file.write('source,roster,"n",d,rate\n"a, b",id,5,10,0.5\nc,id,1,10,0.1\n')
    options = dict(tenant_code="t", api_year=2024, assessment_name="x")
    assert idmatch.publish_match_rate_file(spark, lake, path, **options)
    assert idmatch.publish_match_rate_file(spark, lake, path, **options)
    assert rows(lake.read_match_rates(spark), "source_column_name", "num_matches", "match_rate") == [("a, b", 5, 0.5), ("c", 1, 0.1)]
    assert not idmatch.publish_match_rate_file(spark, lake, path, **options, reused=True)
    assert not idmatch.publish_match_rate_file(spark, lake, folder + "/none.csv", **options)
    named = folder + "/named.csv"
    with open(named, "w") as file:
        file.write("match_rate,num_rows,num_matches,edfi_column_name,source_column_name\n0.49,100,49,id,a\n")
    assert rows(read_match_rates(spark, named)) == [("a", "id", 49, 100, 0.49)]
    assert not idmatch.file_passes(spark, named)
    assert idmatch.file_passes(spark, named, 0.49)
    assert not idmatch.file_passes(spark, folder + "/none.csv")
    assert idmatch.file_passes(spark, folder + "/none.csv", reused=True)
