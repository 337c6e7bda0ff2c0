"""Target tables and names of transformed files that are loaded directly."""

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.constants import DESCRIPTORS_TABLE
from tidemark.functions import camel_to_snake


def sideload_table(endpoint: Column) -> Column:
    """Names that hold `descriptor` share a table; others have one of their own."""
    snake = camel_to_snake(endpoint)
    return F.when(snake.contains("descriptor"), DESCRIPTORS_TABLE).otherwise(snake)


def sideload_name(endpoint: Column, run_type: Column | str) -> Column:
    """Name under which the rows are kept apart from those pulled from a source."""
    kind = F.lit(run_type) if isinstance(run_type, str) else run_type
    return F.concat_ws("__", camel_to_snake(endpoint), kind)


def routed(rows: DataFrame, endpoint: str, run_type: str) -> DataFrame:
    return rows.withColumns(
        {"table_name": sideload_table(F.col(endpoint)), "name": sideload_name(F.col(endpoint), run_type)}
    )
