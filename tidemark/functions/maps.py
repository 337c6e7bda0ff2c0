"""Maps and lists of run parameters."""

from pyspark.sql import Column, functions as F

from tidemark.functions.paths import file_stem

# Name of a run that has no input file.
NO_INPUT_FILE = "non_file_source"


def get_or(params: Column, key: str, default: Column) -> Column:
    return F.coalesce(params[F.lit(key)], default)


def or_empty(params: Column) -> Column:
    """A map of text, empty where it is null."""
    return F.coalesce(params, F.create_map().cast("map<string,string>"))


def merge_maps(first: Column, second: Column) -> Column:
    """Both maps; on a common key the second wins. Null counts as an empty map."""
    left, right = or_empty(first), or_empty(second)
    return F.map_concat(F.map_filter(left, lambda key, _: ~F.map_contains_key(right, key)), right)


def inject_parameters(injected: Column, own: Column) -> Column:
    """Parameters of a run with injected ones laid over its own."""
    return merge_maps(own, injected)


def input_parameters(params: Column) -> Column:
    """Parameters that name an input file: key starts with `input_file`, `input_filetype` excepted."""
    return F.map_filter(
        params,
        lambda key, _: F.lower(key).startswith("input_file") & (F.lower(key) != F.lit("input_filetype")),
    )


def stringify_values(params: Column) -> Column:
    return F.transform_values(params, lambda _, value: value.cast("string"))


def field_list(items: Column, field: str) -> Column:
    """One field of every struct of a list."""
    return F.transform(items, lambda item: item[field])


def pair_up(*lists: Column) -> Column:
    """Lists of equal length, zipped by position."""
    return F.arrays_zip(*lists)


def flatten_paths(nested: Column) -> Column:
    """One list out of a list of lists, without the nulls on either level."""
    lists = F.filter(nested, lambda part: part.isNotNull())
    return F.filter(F.flatten(lists), lambda path: path.isNotNull())


def input_mapping(names: Column, paths: Column) -> Column:
    """Parameter names with their files, paired by position."""
    return F.map_from_arrays(names, paths)


def run_basename(paths: Column) -> Column:
    """Stem of the first input file, which names the outputs of a run."""
    return F.coalesce(file_stem(F.get(paths, F.lit(0))), F.lit(NO_INPUT_FILE))
