"""Does every connection see the organisation its tenant is mapped to?

The organisation of a connection comes from its token, else from the agencies it lists, else from the schools
that its calendars name. Each step is one aggregate per connection; they are joined and compared.
"""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.constants import CONNECTION_PREFIX, FAIL_ON, LEA_TYPE, ORG_STATUSES
from tidemark.functions import same_text
from tidemark.operators.joins import join_small_side, settled
from tidemark.operators.outcomes import fail_when, status_in

RESULT = [
    "connection_id", "tenant", "year", "expected_lea_id", "actual_org_id", "method_used", "status", "message",
    "n_token_ids", "n_leas", "n_via_schools",
]


def parse_connections(
    connections: DataFrame, prefix: str = CONNECTION_PREFIX, exclude: Iterable[str] = (), tenant: str = r"\w+"
) -> DataFrame:
    """Connections named `{prefix}_{tenant}_{year}` with tenant and year. The tenant may hold underscores.

    Of several groups of four digits the last is the year, so a name that goes on with digits after its year needs a
    narrower pattern of its `tenant` (a regular expression without groups).
    """
    pattern = rf"^{re.escape(prefix)}_({tenant})_(\d{{4}})"
    name = F.col("connection_id")
    kept = connections.filter(name.rlike(pattern))
    excluded = list(exclude)
    if excluded:
        kept = kept.filter(~name.isin(excluded))
    return kept.withColumns(
        {"tenant": F.regexp_extract(name, pattern, 1), "year": F.regexp_extract(name, pattern, 2)}
    )


def token_leas(token_orgs: DataFrame) -> DataFrame:
    """Agency ids that the token of a connection lists."""
    agencies = F.filter(
        "orgs", lambda org: (org["type"] == LEA_TYPE) & org["local_education_agency_id"].isNotNull()
    )
    ids = F.transform(agencies, lambda org: org["local_education_agency_id"].cast("string"))
    return token_orgs.select("connection_id", F.coalesce(ids, F.array().cast("array<string>")).alias("token_ids"))


def listed_leas(leas: DataFrame) -> DataFrame:
    """How many agencies a connection lists, and the one id where there is one."""
    lea = F.try_variant_get("v", "$.localEducationAgencyId", "string")
    ids = leas.select("connection_id", lea.alias("lea_id")).filter("lea_id is not null")
    return ids.groupBy("connection_id").agg(
        F.count(F.lit(1)).alias("n_leas"), F.min("lea_id").alias("lea_from_list")
    )


def calendar_schools(calendars: DataFrame) -> DataFrame:
    school = F.try_variant_get("v", "$.schoolReference.schoolId", "string")
    return calendars.select("connection_id", school.alias("school_id")).filter("school_id is not null").distinct()


def leas_via_schools(calendars: DataFrame, schools: DataFrame) -> DataFrame:
    """Agencies of the schools that occur in calendars: how many, and the one id where there is one.

    A connection without schools in its calendars does not appear.
    """
    used = calendar_schools(calendars)
    # a school that is listed twice gives its agency twice, which counting different ones does not mind
    owners = schools.select(
        "connection_id",
        F.try_variant_get("v", "$.schoolId", "string").alias("school_id"),
        F.try_variant_get("v", "$.localEducationAgencyReference.localEducationAgencyId", "string").alias("lea_id"),
    ).filter("school_id is not null and lea_id is not null")
    agencies = used.join(owners, ["connection_id", "school_id"], "left")
    return agencies.groupBy("connection_id").agg(
        F.count_distinct("lea_id").alias("n_via_schools"), F.min("lea_id").alias("lea_from_schools")
    )


def with_org(connections: DataFrame) -> DataFrame:
    """Pick the organisation along the fallback chain and name the step that gave it, with what each step saw."""
    tokens = F.coalesce("token_ids", F.array().cast("array<string>"))
    connections = connections.withColumns({"n_token_ids": F.size(tokens), "n_leas": F.coalesce("n_leas", F.lit(0))})
    one_token, several_tokens = F.col("n_token_ids") == 1, F.col("n_token_ids") > 1
    expected = F.coalesce(F.col("expected_lea_id").cast("string"), F.lit(""))
    as_expected = F.get(tokens, F.lit(0)) == expected
    step = (
        F.when(one_token & as_expected, "token").when(one_token, "token_differs").when(several_tokens, "token_many")
        .when(F.col("n_leas") == 1, "agencies").when(F.col("n_via_schools") == 1, "schools").otherwise("none")
    )
    given = {"token": expected, "agencies": F.col("lea_from_list"), "schools": F.col("lea_from_schools")}
    actual = F.coalesce(*[F.when(F.col("method_used") == name, value) for name, value in given.items()])
    return connections.withColumn("method_used", step).withColumn("actual_org_id", actual)


def with_status(connections: DataFrame) -> DataFrame:
    """Compare the organisation found with the expected one; a connection with an error is not compared."""
    error = F.col("error") if "error" in connections.columns else F.lit(None).cast("string")
    expected, actual = F.col("expected_lea_id").cast("string"), F.col("actual_org_id")
    status = (
        F.when(error.isNotNull(), "ERROR").when(expected.isNull(), "NO_MAPPING").when(actual.isNull(), "NO_ORG_ID")
        .when(same_text(F.col("expected_lea_id"), actual), "MATCH").otherwise("MISMATCH")
    )
    text = F.concat_ws(" ", F.concat(F.lit("wanted="), expected), F.concat(F.lit("seen="), actual), F.concat(F.lit("step="), "method_used"))
    judged = connections.withColumns({"status": status, "message": F.coalesce(error, text)})
    return judged.withColumns(
        {"actual_org_id": F.when(error.isNull(), actual), "method_used": F.when(error.isNull(), F.col("method_used")).otherwise("error")}
    )


def validate_tenant_orgs(
    connections: DataFrame, token_orgs: DataFrame, leas: DataFrame, calendars: DataFrame, schools: DataFrame,
    mapping: DataFrame, *, prefix: str = CONNECTION_PREFIX, exclude: Iterable[str] = (), tenant: str = r"\w+",
) -> DataFrame:
    """One row per connection: what was expected, what was found, by which step, and the verdict."""
    parsed = parse_connections(connections, prefix, exclude, tenant)
    expected = mapping.select("tenant", F.col("expected_lea_id").cast("string").alias("expected_lea_id"))
    rows = join_small_side(parsed, expected, ["tenant"], "left")
    for step in (token_leas(token_orgs), listed_leas(leas), leas_via_schools(calendars, schools)):
        rows = rows.join(step, "connection_id", "left")
    return with_status(with_org(rows)).select(RESULT)


def multi_org_tenants(results: DataFrame) -> DataFrame:
    """Tenants seen with more than one organisation, one row per tenant and organisation."""
    compared = results.filter(F.col("actual_org_id").isNotNull() & status_in(["MATCH", "MISMATCH"]))
    pairs = settled(compared.select("tenant", F.col("actual_org_id").alias("org_id")).distinct())
    several = pairs.groupBy("tenant").agg(F.count(F.lit(1)).alias("n_orgs")).filter("n_orgs > 1")
    return pairs.join(several, "tenant")


def status_histogram(results: DataFrame) -> DataFrame:
    """One row: connections in all and per status."""
    per_status = [F.count_if(F.col("status") == status).alias(status.lower()) for status in ORG_STATUSES]
    return results.agg(F.count(F.lit(1)).alias("total"), *per_status)


def fail_on_status(results: DataFrame, fail_on: Iterable[str] = FAIL_ON) -> None:
    """Raise when a connection has one of the statuses; an empty list never raises."""
    rows = results.select("connection_id", "status")
    fail_when(rows, status_in(fail_on), "organisation check failed")
