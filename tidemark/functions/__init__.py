from tidemark.functions.maps import (
    field_list, flatten_paths, get_or, input_mapping, input_parameters, inject_parameters, merge_maps, or_empty, pair_up, run_basename,
    stringify_values,
)
from tidemark.functions.names import camel_to_snake, snake_to_camel
from tidemark.functions.paths import (
    base_name, decoded_path, directory_name, endpoint_name, file_stem, join_path, landing_lineage,
    pull_date, pull_timestamp,
)
from tidemark.functions.scalars import as_number, flag, json_text, same_text, utc_iso

__all__ = [
    "as_number", "base_name", "camel_to_snake", "decoded_path", "directory_name", "endpoint_name", "field_list",
    "file_stem", "flag", "flatten_paths", "get_or", "inject_parameters", "input_mapping", "input_parameters", "join_path",
    "json_text", "landing_lineage", "merge_maps", "or_empty", "pair_up", "pull_date", "pull_timestamp", "run_basename", "same_text",
    "snake_to_camel", "stringify_values", "utc_iso",
]
