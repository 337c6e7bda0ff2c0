"""Columns read from file paths.

A landing file lies at `{tenant}/{year}/{date}/{timestamp}/{kind}/{endpoint}.jsonl`. A folder written by Spark
holds the same segments as `key=value` and ends in `part-` files; both forms are read.
"""

from pyspark.sql import Column, functions as F

from tidemark.constants import PATH_DATE_FORMAT, PATH_TIMESTAMP_FORMAT

# Shapes of the path segments.
DATE_SEGMENT = r"\d{8}"
TIMESTAMP_SEGMENT = r"\d{8}T\d{6}"
NAME_SEGMENT = r"\w+"

_PULL = rf"/(?:ds=)?({DATE_SEGMENT})/(?:ts=)?({TIMESTAMP_SEGMENT})/"
_NAME = rf"/(?:({NAME_SEGMENT})\.(?:jsonl?|ndjson)(?:\.gz)?(?:/part-[^/]+)?|name=({NAME_SEGMENT})/part-[^/]+)$"
_OWNER = (
    rf"/(?:tenant_code=)?([^/]+)/(?:api_year=)?(\d{{4}})"
    rf"/(?:ds=)?{DATE_SEGMENT}/(?:ts=)?{TIMESTAMP_SEGMENT}/(?:kind=)?(\w+)/"
)


def _capture(path: Column, pattern: str, group: int) -> Column:
    return F.nullif(F.regexp_extract(path, pattern, group), F.lit(""))


def decoded_path(path: Column) -> Column:
    """Undo the percent encoding of `_metadata.file_path`; a plus sign in a file name is kept."""
    return F.try_url_decode(F.replace(path, F.lit("+"), F.lit("%2B")))


def pull_date(path: Column) -> Column:
    """Date segment that stands before the timestamp segment, so a tenant of eight digits is not taken."""
    return F.try_to_timestamp(_capture(path, _PULL, 1), F.lit(PATH_DATE_FORMAT)).cast("date")


def pull_timestamp(path: Column) -> Column:
    return F.try_to_timestamp(_capture(path, _PULL, 2), F.lit(PATH_TIMESTAMP_FORMAT))


def endpoint_name(path: Column) -> Column:
    """File name without `.json`, `.jsonl` or `.ndjson`, packed or not; null when it is no plain word."""
    return F.coalesce(_capture(path, _NAME, 1), _capture(path, _NAME, 2))


def landing_lineage(path: Column) -> dict[str, Column]:
    """Every value that the landing layout encodes, null where the path does not follow it."""
    return {
        "tenant_code": _capture(path, _OWNER, 1),
        "api_year": _capture(path, _OWNER, 2).cast("int"),
        "kind": _capture(path, _OWNER, 3),
        "name": endpoint_name(path),
        "pull_date": pull_date(path),
        "pull_timestamp": pull_timestamp(path),
    }


def base_name(path: Column) -> Column:
    return F.regexp_extract(path, "([^/]*)$", 1)


def directory_name(path: Column) -> Column:
    return F.regexp_replace(path, "/?[^/]*$", "")


def file_stem(path: Column, is_directory: Column | bool = False) -> Column:
    """Base name without its last extension; a directory keeps its dots, and so does a dot file."""
    name = base_name(path)
    directory = F.lit(is_directory) if isinstance(is_directory, bool) else is_directory
    return F.when(directory, name).otherwise(F.regexp_replace(name, r"^(\.*[^.].*)\.[^.]*$", "$1"))


def join_path(*parts: Column) -> Column:
    """Segments joined by `/`; null segments are left out."""
    return F.concat_ws("/", *parts)
