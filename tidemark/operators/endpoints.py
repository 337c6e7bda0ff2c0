"""Endpoint configuration and selection."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidemark import constants as C
from tidemark.functions import camel_to_snake, merge_maps, or_empty
from tidemark.schemas import ENDPOINTS

_KEYS = ["tenant_code", "api_year", "name"]


def endpoints_from_config(
    spark: SparkSession, configs: Mapping | Sequence | None, *, tenant_code: str, api_year: int,
    kind: str = C.RESOURCES, multiyear: bool = False,
) -> DataFrame:
    """Endpoint rows of one tenant-year.

    A mapping `{endpoint: options}` follows its options; deletes and key changes are fetched only where
    `fetch_deletes` says so. A list of `(endpoint, namespace)` enables everything.
    """
    if not configs:
        rows = []
    elif isinstance(configs, Mapping):
        rows = [_config_row(name, dict(options)) for name, options in configs.items()]
    elif isinstance(configs, (list, tuple)):
        rows = [_config_row(name, {"namespace": space, "fetch_deletes": True}) for name, space in configs]
    else:
        raise ValueError(f"endpoint configs must be a mapping or a list of pairs, not {type(configs).__name__}")
    raw = spark.createDataFrame([(tenant_code, api_year, kind, *row) for row in rows], ENDPOINTS)
    return normalise_endpoints(raw, multiyear=multiyear)


def _config_row(name: str, options: dict) -> tuple:
    query = {key: str(value) for key, value in (options.get("query_parameters") or {}).items()}
    return (
        name, options.get("namespace"), options.get("enabled"), options.get("fetch_deletes"),
        options.get("page_size"), options.get("num_retries"), options.get("change_version_step_size"), query,
    )


def normalise_endpoints(raw: DataFrame, *, multiyear: bool = False) -> DataFrame:
    """Enabled endpoints with snake-case names and defaults filled in."""
    parameters = or_empty(F.col("query_parameters"))
    if multiyear:
        year = F.create_map(F.lit(C.SCHOOL_YEAR_PARAMETER), F.col("api_year").cast("string"))
        parameters = merge_maps(parameters, year)
    defaults = {
        "namespace": C.DEFAULT_NAMESPACE,
        "page_size": C.DEFAULT_PAGE_SIZE,
        "num_retries": C.DEFAULT_NUM_RETRIES,
        "change_version_step_size": C.DEFAULT_CHANGE_VERSION_STEP,
        "fetch_deletes": False,
    }
    return raw.filter(F.coalesce("enabled", F.lit(True))).withColumns(
        {
            "name": camel_to_snake(F.col("name")),
            "enabled": F.lit(True),
            "query_parameters": parameters,
            **{column: F.coalesce(column, F.lit(value)) for column, value in defaults.items()},
        }
    )


def merge_endpoints(*tables: DataFrame) -> DataFrame:
    """Union of endpoint tables, one row per endpoint; a later table wins."""
    ranked = [table.withColumn("__rank", F.lit(rank)) for rank, table in enumerate(tables)]
    whole = reduce(DataFrame.unionByName, ranked)
    others = [column for column in tables[0].columns if column not in _KEYS]
    last = F.max_by(F.struct(*others), "__rank").alias("__last")
    return whole.groupBy(*_KEYS).agg(last).select(*_KEYS, "__last.*").select(tables[0].columns)


def endpoint_streams(endpoints: DataFrame, *, get_key_changes: bool = True) -> DataFrame:
    """One row per record stream: each endpoint, and for resources that ask for it, deletes and key changes."""
    extra = [F.lit(C.RESOURCE_DELETES)] + ([F.lit(C.RESOURCE_KEY_CHANGES)] if get_key_changes else [])
    with_deletes = (F.col("kind") == C.RESOURCES) & F.col("fetch_deletes")
    kinds = F.when(with_deletes, F.array(F.col("kind"), *extra)).otherwise(F.array("kind"))
    return endpoints.withColumn("kind", F.explode(kinds))


def named(names: Iterable[str] | None) -> Column:
    """Names that are in a list; no list, or an empty one, takes all."""
    wanted = list(names or [])
    return F.col("name").isin(wanted) if wanted else F.lit(True)


def specified(requested: Iterable[str] | None, enabled: Iterable[str] | None) -> Column:
    """In the endpoints asked for in this run and in the enabled ones; an empty list does not restrict."""
    return named(requested) & named(enabled)


def requested_endpoints(endpoints: DataFrame, requested: DataFrame) -> DataFrame:
    """Endpoints named in a table of names in any case style; an empty table takes none."""
    wanted = requested.select(camel_to_snake(F.col("name")).alias("name")).distinct()
    return endpoints.join(wanted, "name", "left_semi")


def snake_names(spark: SparkSession, names: Iterable[str] | None) -> DataFrame:
    """Names asked for by a user, as a table in snake case."""
    raw = F.array(*[F.lit(name) for name in names or []]).cast("array<string>")
    return spark.range(1).select(F.explode(raw).alias("name")).select(camel_to_snake(F.col("name")).alias("name")).distinct()


def equality_filter(feed: DataFrame, parameters: Mapping[str, object]) -> DataFrame:
    """Rows that equal every given parameter; as plain predicates they reach the scan."""
    return reduce(lambda rows, item: rows.filter(F.col(item[0]) == F.lit(item[1])), parameters.items(), feed)


def parameter_keys(endpoints: DataFrame) -> list[str]:
    """Names of the parameters that some endpoint sets; a few, from the configuration."""
    if "query_parameters" not in endpoints.columns:
        return []
    keys = endpoints.select(F.explode(F.map_keys("query_parameters")).alias("key")).distinct()
    return sorted(row["key"] for row in keys.collect())


def meets_parameters(keys: Sequence[str]) -> Column:
    """Feed rows that equal every parameter of their endpoint; each key is a column of the feed."""
    conditions = [
        F.coalesce(F.col(key).cast("string") == F.col("query_parameters")[key], F.col("query_parameters")[key].isNull())
        for key in keys
    ]
    return reduce(Column.__and__, conditions, F.lit(True))


def kinds_to_run(streams: DataFrame, full_refresh: bool) -> DataFrame:
    """A full refresh leaves deletes and key changes out."""
    if not full_refresh:
        return streams
    return streams.filter(~F.col("kind").isin(C.RESOURCE_DELETES, C.RESOURCE_KEY_CHANGES))


def table_name(kind: Column, name: Column) -> Column:
    """Table of a stream: deletes, key changes and descriptors share one each, a resource has its own."""
    return (
        F.when(kind == C.RESOURCE_DELETES, C.DELETES_TABLE)
        .when(kind == C.RESOURCE_KEY_CHANGES, C.KEY_CHANGES_TABLE)
        .when(kind == C.DESCRIPTORS, C.DESCRIPTORS_TABLE)
        .otherwise(name)
    )
