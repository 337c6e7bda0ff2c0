"""Where the tables of a lake are, and how they are read."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark import schemas as S
from tidemark.constants import CHANGE_VERSION_TABLE, TOTAL_COUNTS_TABLE
from tidemark.operators.endpoints import table_name
from tidemark.sources.tables import read_or_empty


@dataclass(frozen=True)
class Lake:
    root: str

    def path(self, table: str) -> str:
        return f"{self.root.rstrip('/')}/{table}"

    @property
    def raw(self) -> str:
        return self.path("raw")

    @property
    def landing(self) -> str:
        return self.path("landing")

    @property
    def ledger(self) -> str:
        return self.path(CHANGE_VERSION_TABLE)

    @property
    def total_counts(self) -> str:
        return self.path(TOTAL_COUNTS_TABLE)

    @property
    def match_rates(self) -> str:
        return self.path("match_rates")

    @property
    def run_log(self) -> str:
        return self.path("run_log")

    def read_raw(self, spark: SparkSession, within: Mapping[str, object] | None = None) -> DataFrame:
        return read_or_empty(spark, self.raw, S.RAW, within)

    def read_ledger(self, spark: SparkSession, within: Mapping[str, object] | None = None) -> DataFrame:
        return read_or_empty(spark, self.ledger, S.LEDGER, within)

    def read_total_counts(self, spark: SparkSession, within: Mapping[str, object] | None = None) -> DataFrame:
        return read_or_empty(spark, self.total_counts, S.TOTAL_COUNTS, within)

    def read_match_rates(self, spark: SparkSession, within: Mapping[str, object] | None = None) -> DataFrame:
        return read_or_empty(spark, self.match_rates, S.MATCH_RATES, within)

    def read_run_log(self, spark: SparkSession, within: Mapping[str, object] | None = None) -> DataFrame:
        return read_or_empty(spark, self.run_log, S.RUN_LOG, within)

    def raw_table(self, spark: SparkSession, table: str) -> DataFrame:
        """One table of the raw layer by its name; a filter on the partition columns."""
        return self.read_raw(spark).filter(table_name(F.col("kind"), F.col("name")) == table)
