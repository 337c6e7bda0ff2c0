"""How well source ids match roster ids, the best pair, and gates on the rate."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.constants import REQUIRED_MATCH_RATE
from tidemark.operators.joins import BROADCAST_BYTES, join_small_side, settled

ASSESSMENT = ["tenant_code", "api_year", "assessment_name"]
#: Bits of a sketch for each roster id of the largest roster, and bits and bytes of one of Spark's bitmaps.
BITS_PER_ID = 16
BITMAP_BITS, BITMAP_BYTES = 32_768, 4_096


def match_rates(
    source: DataFrame, roster: DataFrame, source_columns: Sequence[str], roster_columns: Sequence[str],
    by: Sequence[str] = (), roster_by: Sequence[str] | None = None,
) -> DataFrame:
    """Share of source rows whose id occurs in the roster, for every pair of id columns.

    Rates are per group `by`; the roster is kept apart by `roster_by`, those of `by` that the roster has. Every
    source row counts, copies and null ids included. Ids are counted per value before they meet the roster, and the
    roster is reduced to one row per value, so a frequent id is one row on either side of the join.
    """
    by, roster_by = _groups_of(roster, by, roster_by)
    ids = _ids(source, source_columns, by, "source_column_name")
    return _exact(ids, _known(roster, roster_columns, roster_by), roster_columns, by, roster_by)


def sufficient_rates(
    source: DataFrame, roster: DataFrame, source_columns: Sequence[str], roster_columns: Sequence[str],
    by: Sequence[str] = (), roster_by: Sequence[str] | None = None, required: float = REQUIRED_MATCH_RATE, *,
    limit: int = BROADCAST_BYTES,
) -> DataFrame:
    """The rates of `match_rates` that suffice, for sources of many columns of which few are ids.

    First each pair's rate is bounded from above in one scan that moves no ids: rows are counted whose hash is set in a
    bitmap of the roster's ids. Only columns of which some pair can suffice are then counted exactly. Without bitmaps
    that fit in `limit` bytes all are; the result is the same.
    """
    by, roster_by = _groups_of(roster, by, roster_by)
    ids = _ids(source, source_columns, by, "source_column_name")
    known = settled(_known(roster, roster_columns, roster_by))
    if required > 0:  # at 0 every pair suffices
        possible = possible_pairs(ids, known, roster_columns, by, roster_by, required, limit)
        if possible is not None:
            columns = [*by, "source_column_name"]
            ids = join_small_side(ids, possible.select(*columns).distinct(), columns, "left_semi")
    return _exact(ids, known, roster_columns, by, roster_by).filter(meets_rate(required))


def possible_pairs(
    ids: DataFrame, known: DataFrame, roster_columns: Sequence[str], by: Sequence[str], roster_by: Sequence[str],
    required: float, limit: int = BROADCAST_BYTES,
) -> DataFrame | None:
    """Pairs of columns, for each group, whose rate may be sufficient: all that are, and few others. `ids` as from `_ids`,
    `known` settled.

    Different ids of one hash make a bound too high, never too low. Nothing where the bitmaps have more than `limit` bytes.
    """
    largest = known.groupBy(*roster_by).count().agg(F.max("count").alias("n")).first()["n"] or 0
    bits = max(BITMAP_BITS, 1 << (BITS_PER_ID * largest - 1).bit_length()) if largest else BITMAP_BITS
    place = F.pmod(F.xxhash64("id"), F.lit(bits)) + 1
    bitmaps = settled(
        known.groupBy(*roster_by, F.bitmap_bucket_number(place).alias("__bitmap"))
        .agg(*[F.bitmap_construct_agg(F.bitmap_bit_position(F.when(F.col(flag), place))).alias(flag) for flag in _flags(roster_columns)])
    )
    size = bitmaps.count() * len(roster_columns) * BITMAP_BYTES
    if size > limit:
        return None
    placed = ids.select(*by, "source_column_name", F.bitmap_bucket_number(place).alias("__bitmap"), F.bitmap_bit_position(place).alias("__bit"), F.col("id").isNotNull().alias("__told"))
    met = join_small_side(placed, bitmaps, [*roster_by, "__bitmap"], "left", size=size)
    bounds = met.groupBy(*by, "source_column_name").agg(
        F.count(F.lit(1)).alias("num_rows"), *[F.count_if(F.col("__told") & _bit_is_set(F.col(flag), F.col("__bit"))).alias(flag) for flag in _flags(roster_columns)]
    )
    return _by_pair(bounds, roster_columns, by).filter(meets_rate(required)).select(*by, "source_column_name", "edfi_column_name")


def _bit_is_set(bitmap: Column, bit: Column) -> Column:
    byte = F.conv(F.hex(F.substring(bitmap, F.floor(bit / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    return F.coalesce(F.getbit(byte, (bit % 8).cast("int")) == 1, F.lit(False))


def _groups_of(roster: DataFrame, by: Sequence[str], roster_by: Sequence[str] | None) -> tuple[list[str], list[str]]:
    return list(by), [key for key in by if key in roster.columns] if roster_by is None else list(roster_by)


def _flags(roster_columns: Sequence[str]) -> list[str]:
    return [f"__in_{i}" for i in range(len(roster_columns))]


def _known(roster: DataFrame, columns: Sequence[str], roster_by: Sequence[str]) -> DataFrame:
    """Each id of a roster once, with the columns that have it."""
    flags = [F.bool_or(F.col("edfi_column_name") == column).alias(flag) for column, flag in zip(columns, _flags(columns))]
    return _ids(roster, columns, roster_by, "edfi_column_name").filter("id is not null").groupBy(*roster_by, "id").agg(*flags)


def _exact(ids: DataFrame, known: DataFrame, roster_columns: Sequence[str], by: Sequence[str], roster_by: Sequence[str]) -> DataFrame:
    values = ids.groupBy(*by, "source_column_name", "id").agg(F.count(F.lit(1)).alias("rows"))
    matches = [F.sum(F.when(F.col(flag), F.col("rows")).otherwise(0)).alias(flag) for flag in _flags(roster_columns)]
    sums = values.join(known, [*roster_by, "id"], "left").groupBy(*by, "source_column_name").agg(F.sum("rows").alias("num_rows"), *matches)
    return _by_pair(sums, roster_columns, by)


def _by_pair(sums: DataFrame, roster_columns: Sequence[str], by: Sequence[str]) -> DataFrame:
    """A row for each pair from one for each source column, with the matches of each roster column."""
    pairs = [
        F.struct(F.lit(column).alias("edfi_column_name"), F.col(flag).alias("num_matches")) for column, flag in zip(roster_columns, _flags(roster_columns))
    ]
    rates = sums.select(*by, "source_column_name", "num_rows", F.inline(F.array(*pairs)))
    return rates.select(
        *by, "source_column_name", "edfi_column_name", "num_matches", "num_rows",
        (F.col("num_matches") / F.col("num_rows")).alias("match_rate"),
    )


def _ids(rows: DataFrame, columns: Sequence[str], by: Sequence[str], label: str) -> DataFrame:
    pairs = [F.struct(F.lit(c).alias(label), F.col(c).cast("string").alias("id")) for c in columns]
    return rows.select(*by, F.inline(F.array(*pairs)))


def meets_rate(required: float = REQUIRED_MATCH_RATE) -> Column:
    return F.col("match_rate") >= F.lit(required)


def best_config(rates: DataFrame, required: float = REQUIRED_MATCH_RATE, by: Sequence[str] = ASSESSMENT) -> DataFrame:
    """The pair with the highest sufficient rate per group; on a tie the last column names win."""
    order = ["match_rate", "edfi_column_name", "source_column_name"]
    others = [column for column in rates.columns if column not in (*by, *order)]
    best = F.max(F.struct(*order, *others)).alias("best")
    return rates.filter(meets_rate(required)).groupBy(*by).agg(best).select(*by, "best.*").select(rates.columns)


def best_config_of(
    rates: DataFrame, tenant_code: str, api_year: int, assessment_name: str, required: float = REQUIRED_MATCH_RATE
) -> DataFrame:
    """The same for one assessment, as a top-1 that reads one partition."""
    mine = (
        (F.col("tenant_code") == tenant_code) & (F.col("api_year") == api_year)
        & (F.col("assessment_name") == assessment_name)
    )
    return (
        rates.filter(mine & meets_rate(required))
        .orderBy(F.desc("match_rate"), F.desc("edfi_column_name"), F.desc("source_column_name"))
        .limit(1)
    )


def max_rate(rates: DataFrame, required: float = REQUIRED_MATCH_RATE, by: Sequence[str] = ()) -> DataFrame:
    """Highest sufficient rate; null, or no row per group, when none is."""
    return rates.filter(meets_rate(required)).groupBy(*by).agg(F.max("match_rate").alias("max_match_rate"))


def gate(
    rates: DataFrame, required: float = REQUIRED_MATCH_RATE, by: Sequence[str] = (), reused: bool = False
) -> DataFrame:
    """Whether at least one rate suffices. Reused rates have passed before. No rates: nothing to load."""
    passed = F.lit(True) if reused else F.coalesce(F.bool_or(meets_rate(required)), F.lit(False))
    return rates.groupBy(*by).agg(passed.alias("passed"))
