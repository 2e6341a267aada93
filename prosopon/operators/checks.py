"""Checks of canonical records. A Spark schema already guarantees the types and that there are no other fields."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from prosopon.schemas import METHODS, PROVENANCE_FIELDS


def orphan_fields() -> Column:
    """Provenance whose field is none of a record's."""
    prefix = lambda p: F.substring_index(F.substring_index(p["field"], "[", 1), ".", 1)
    return F.transform(F.filter("provenance", lambda p: ~prefix(p).isin(PROVENANCE_FIELDS)), lambda p: p["field"])


def canonical_fault() -> Column:
    """The first constraint that a record breaks, or null."""
    low = lambda c: F.coalesce(F.length(c) < 1, F.lit(True))
    unit = lambda c: F.coalesce(c.between(0.0, 1.0), F.lit(False))
    lists = F.lit(False)
    for c in ("emails", "phones", "skills", "experience", "education", "provenance"):
        lists = lists | F.col(c).isNull()
    return (
        F.when(low(F.col("candidate_id")), "schema violation at 'candidate_id'")
        .when(lists, "schema violation: a list is null")
        .when(F.exists("emails", lambda x: x.isNull()), "schema violation at 'emails'")
        .when(F.exists("phones", lambda x: x.isNull()), "schema violation at 'phones'")
        .when(F.exists("skills", lambda s: low(s["name"]) | ~unit(s["confidence"])), "schema violation at 'skills'")
        .when(F.exists("provenance", lambda p: low(p["field"]) | low(p["source"]) | ~F.coalesce(p["method"].isin(METHODS), F.lit(False)) | ~unit(p["confidence"])), "schema violation at 'provenance'")
        .when(~unit(F.col("overall_confidence")), "overall_confidence is outside [0, 1]")
        .when(F.size(orphan_fields()) > 0, F.concat(F.lit("provenance of unknown fields: "), F.array_join(orphan_fields(), ", ")))
    )


def validate_canonical(records: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(records that pass, errors: candidate_id, stage, message)."""
    r = records.withColumn("fault", canonical_fault())
    return r.where("fault IS NULL").drop("fault"), r.where("fault IS NOT NULL").select("candidate_id", F.lit("validate_canonical").alias("stage"), F.col("fault").alias("message"))
