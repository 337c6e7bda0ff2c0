"""Small value functions."""

from pyspark.sql import Column, functions as F


def flag(value: Column) -> Column:
    """A nullable flag as plain true or false."""
    return F.coalesce(value, F.lit(False))


def json_text(value: Column) -> Column:
    """Any value as JSON text, scalars included; null becomes `null`."""
    wrapped = F.to_json(F.array(value), {"ignoreNullFields": "false"})
    return F.substring(wrapped, F.lit(2), F.length(wrapped) - 2)


def as_number(text: Column) -> Column:
    """CSV text as a number, null where it is none."""
    return F.trim(text).try_cast("double")


def same_text(left: Column, right: Column) -> Column:
    """Equality of ids that may be text on one side and numbers on the other."""
    return left.cast("string") == right.cast("string")


def utc_iso(moment: Column, fraction: bool = False) -> Column:
    """ISO text in UTC; the fraction is left out when it is zero, unless it is asked for."""
    utc = F.to_utc_timestamp(moment, F.current_timezone())
    whole = F.date_format(utc, "yyyy-MM-dd'T'HH:mm:ss'+00:00'")
    micros = F.date_format(utc, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+00:00'")
    return micros if fraction else F.when(F.date_trunc("second", utc) == utc, whole).otherwise(micros)
