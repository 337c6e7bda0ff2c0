"""Matching ids of a file with a roster: reuse or compute the rates, gate on them, publish them."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.constants import REQUIRED_MATCH_RATE
from tidemark.operators import matchrates as R
from tidemark.operators.joins import settled
from tidemark.plans.lake import Lake
from tidemark.schemas import MATCH_RATE_FILE, MATCH_RATE_PARTITIONS, MATCH_RATES
from tidemark.sinks import grain
from tidemark.sources.csvs import read_positional, read_match_rates
from tidemark.sources.feed import roster_of
from tidemark.sources.tables import path_exists


def id_match(
    spark: SparkSession, lake: Lake, source: DataFrame, roster: DataFrame, *, tenant_code: str, api_year: int,
    assessment_name: str, source_columns: Sequence[str], roster_columns: Sequence[str],
    required: float = REQUIRED_MATCH_RATE, parameters: Mapping[str, object] | None = None,
) -> tuple[DataFrame, bool]:
    """The best pair of id columns, and whether rows may be loaded.

    A sufficient rate of an earlier run is used again. Otherwise rates are computed from the source and the roster
    of the tenant-year, and published when one suffices.
    """
    grain_of_run = {"tenant_code": tenant_code, "api_year": api_year, "assessment_name": assessment_name}
    known = lake.read_match_rates(spark, grain_of_run)
    if not known.filter(R.meets_rate(required)).isEmpty():
        return R.best_config_of(known, tenant_code, api_year, assessment_name, required), True
    people = roster_of(roster, tenant_code, api_year, parameters)
    rates = R.match_rates(source, people, source_columns, roster_columns)
    labelled = rates.withColumns({key: F.lit(value) for key, value in grain_of_run.items()}).select(MATCH_RATES.names)
    computed = settled(labelled)
    passed = R.gate(computed, required).first()["passed"]
    if passed:
        publish_match_rates(computed, lake)
    return R.best_config(computed, required), passed


def publish_match_rates(rates: DataFrame, lake: Lake) -> None:
    """Replace the rates of the assessments in `rates`."""
    grain.replace(rates, lake.match_rates, MATCH_RATES, MATCH_RATE_PARTITIONS)


def publish_match_rate_file(
    spark: SparkSession, lake: Lake, path: str, *, tenant_code: str, api_year: int, assessment_name: str, reused: bool = False
) -> bool:
    """Replace the rates of an assessment by those of a CSV, columns by position; nothing to do without a file."""
    if reused or not path_exists(spark, path):
        return False
    rates = read_positional(spark, path, MATCH_RATE_FILE)
    labels = {"tenant_code": tenant_code, "api_year": api_year, "assessment_name": assessment_name}
    publish_match_rates(rates.withColumns({key: F.lit(value) for key, value in labels.items()}), lake)
    return True


def file_passes(spark: SparkSession, path: str, required: float = REQUIRED_MATCH_RATE, reused: bool = False) -> bool:
    """Gate on a CSV of rates, columns by name. Without a file there is nothing to load."""
    if reused:
        return True
    return R.gate(read_match_rates(spark, path), required).first()["passed"]
