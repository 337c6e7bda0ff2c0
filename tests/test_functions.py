import pytest
from conftest import rows
from pyspark.sql import functions as F

from tidemark import functions as fn


def one(spark, column, **values):
    frame = spark.createDataFrame([(1,)], "one int").withColumns({name: F.lit(value) for name, value in values.items()})
    return frame.select(column.alias("x")).first()["x"]


@pytest.mark.parametrize(
    "camel, snake",
    [
        ("students", "students"),
        ("studentSchoolAssociations", "student_school_associations"),
        ("courseLevel2Types", "course_level2_types"),
        ("already_snake", "already_snake"),
    ],
)
def test_camel_to_snake(spark, camel, snake):
    assert one(spark, fn.camel_to_snake(F.col("n")), n=camel) == snake


@pytest.mark.parametrize("snake, camel", [("students", "students"), ("student_school_associations", "studentSchoolAssociations")])
def test_snake_to_camel(spark, snake, camel):
    assert one(spark, fn.snake_to_camel(F.col("n")), n=snake) == camel


@pytest.mark.parametrize(
    "path, is_directory, stem",
    [
        ("/grandparent/parent/file.with.periods.csv", False, "file.with.periods"),
        ("/tmp/dirname.with.periods", True, "dirname.with.periods"),
        ("plain", False, "plain"),
        ("/a/.hidden", False, ".hidden"),
        ("/a/b..c", False, "b."),
    ],
)
def test_file_stem(spark, path, is_directory, stem):
    assert one(spark, fn.file_stem(F.col("p"), is_directory), p=path) == stem


def test_path_pieces(spark):
    assert one(spark, fn.base_name(F.col("p")), p="/a/b/c.csv") == "c.csv"
    assert one(spark, fn.directory_name(F.col("p")), p="/a/b/c.csv") == "/a/b"
    joined = fn.join_path(F.lit("a"), F.lit(None).cast("string"), F.lit(2024).cast("string"))
    assert one(spark, joined) == "a/2024"


@pytest.mark.parametrize(
    "path, expected",
    [
        (
            "file:/lake/ten/2024/20240131/20240131T010203/resources/students.jsonl",
            ("ten", 2024, "resources", "students", "2024-01-31", "2024-01-31 01:02:03"),
        ),
        # a tenant code of eight digits is not the date
        (
            "s3a://b/20999999/2024/20240131/20240131T010203/resource_deletes/schools.json",
            ("20999999", 2024, "resource_deletes", "schools", "2024-01-31", "2024-01-31 01:02:03"),
        ),
        # written by Spark
        (
            "/l/tenant_code=a b/api_year=2023/ds=20230101/ts=20230101T000000/kind=descriptors/name=x_descriptors/part-0-ab.c000.txt",
            ("a b", 2023, "descriptors", "x_descriptors", "2023-01-01", "2023-01-01 00:00:00"),
        ),
        ("/l/t/2023/20230101/20230101T000000/resources/staffs.jsonl/part-00.json", ("t", 2023, "resources", "staffs", "2023-01-01", "2023-01-01 00:00:00")),
        # a name with a hyphen is no name, a date that does not exist is no date
        ("/l/t/2023/20231399/20231399T000000/resources/a-b.jsonl", ("t", 2023, "resources", None, None, None)),
        ("/elsewhere/students.jsonl", (None, None, None, "students", None, None)),
    ],
)
def test_landing_lineage(spark, path, expected):
    lineage = fn.landing_lineage(F.col("p"))
    frame = spark.createDataFrame([(path,)], "p string").select(*[column.alias(name) for name, column in lineage.items()])
    row = frame.select(
        "tenant_code", "api_year", "kind", "name", F.col("pull_date").cast("string"), F.col("pull_timestamp").cast("string")
    ).first()
    assert tuple(row) == expected


def test_decoded_path(spark):
    assert one(spark, fn.decoded_path(F.col("p")), p="file:/a%20b/c+d%25.json") == "file:/a b/c+d%.json"


def test_maps(spark):
    frame = spark.createDataFrame(
        [({"a": "1", "b": "2"}, {"b": "3"}), ({"a": "1"}, None), (None, {"c": "4"})],
        "own map<string,string>, injected map<string,string>",
    )
    merged = [row[0] for row in frame.select(fn.inject_parameters(F.col("injected"), F.col("own"))).collect()]
    assert merged == [{"a": "1", "b": "3"}, {"a": "1"}, {"c": "4"}]
    params = spark.createDataFrame(
        [({"INPUT_FILE": "a", "input_file_2": "b", "Input_FileType": "csv", "OUTPUT": "c"},)], "m map<string,string>"
    )
    assert params.select(fn.input_parameters(F.col("m"))).first()[0] == {"INPUT_FILE": "a", "input_file_2": "b"}
    assert params.select(fn.get_or(F.col("m"), "absent", F.lit("d"))).first()[0] == "d"


def test_lists(spark):
    frame = spark.createDataFrame([([["a", None], None, ["b"]],)], "p array<array<string>>")
    assert frame.select(fn.flatten_paths(F.col("p"))).first()[0] == ["a", "b"]
    pairs = spark.createDataFrame([([("x", 1), ("y", 2)],)], "e array<struct<name:string,mark:int>>")
    assert pairs.select(fn.field_list(F.col("e"), "mark")).first()[0] == [1, 2]
    zipped = pairs.select(fn.pair_up(fn.field_list(F.col("e"), "name"), fn.field_list(F.col("e"), "mark"))).first()[0]
    assert [tuple(pair) for pair in zipped] == [("x", 1), ("y", 2)]


def test_scalars(spark):
    assert one(spark, fn.json_text(F.col("v")), v='say "hi"') == '"say \\"hi\\""'
    assert one(spark, fn.json_text(F.col("v")), v=3) == "3"
    assert one(spark, fn.json_text(F.lit(None).cast("string"))) == "null"
    assert one(spark, fn.as_number(F.col("v")), v=" 0.5 ") == 0.5
    assert one(spark, fn.as_number(F.col("v")), v="n/a") is None
    assert one(spark, fn.same_text(F.lit(7), F.lit("7"))) is True
    assert one(spark, fn.utc_iso(F.lit("2024-01-02 03:04:05").cast("timestamp"))) == "2024-01-02T03:04:05+00:00"
    assert one(spark, fn.utc_iso(F.lit("2024-01-02 03:04:05.25").cast("timestamp"))) == "2024-01-02T03:04:05.250000+00:00"
    assert rows(spark.range(1).select(fn.flag(F.lit(None).cast("boolean")))) == [(False,)]
