"""Endpoint name casing."""

from pyspark.sql import Column, functions as F


def camel_to_snake(name: Column) -> Column:
    """`studentSchoolAssociations` -> `student_school_associations`; snake case stays as it is."""
    return F.lower(F.regexp_replace(name, "([a-z0-9])([A-Z])", "$1_$2"))


def snake_to_camel(name: Column) -> Column:
    """`student_schools` -> `studentSchools`; the first word keeps its case."""
    words = F.split(name, "_")
    rest = F.transform(F.slice(words, 2, F.greatest(F.size(words), F.lit(1))), lambda word: F.initcap(word))
    return F.concat(F.get(words, 0), F.array_join(rest, ""))
