"""Key-value mappings given as JSON."""

from pyspark.sql import DataFrame, SparkSession, functions as F


def read_mapping(spark: SparkSession, path: str, key: str = "tenant", value: str = "expected_lea_id") -> DataFrame:
    """A JSON object in a file, one row per key."""
    text = spark.read.text(path, wholetext=True)
    return mapping_rows(text, "value", key, value)


def mapping_from_json(spark: SparkSession, text: str, key: str = "tenant", value: str = "expected_lea_id") -> DataFrame:
    return mapping_rows(spark.createDataFrame([(text,)], "value string"), "value", key, value)


def mapping_rows(
    rows: DataFrame, column: str, key: str = "tenant", value: str = "expected_lea_id", keep: list[str] | None = None
) -> DataFrame:
    """Entries of the JSON objects of a text column, beside the columns to keep."""
    return rows.select(*(keep or []), F.explode(F.from_json(column, "map<string,string>")).alias(key, value))
