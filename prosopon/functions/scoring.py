"""Confidence of a field from how and where it was found."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from prosopon.schemas import AGREEMENT_BONUS, BASE_SCORE, SOURCE_PRIORITY, TIER_WEIGHT, UNKNOWN_SCORE, UNKNOWN_WEIGHT


def _of(c: Column, table: dict[str, float], default: float) -> Column:
    return F.coalesce(F.try_element_at(F.create_map(*(F.lit(x) for kv in table.items() for x in kv)), c), F.lit(default))


def round3(x: Column) -> Column:
    """To three places, halves up. The last bits of a sum, which depend on the order of its parts, don't decide: the same in every SQL
    engine."""
    return F.floor(F.round(x * 1000, 6) + 0.5) / 1000


def base_score(method: Column) -> Column:
    return _of(method, BASE_SCORE, UNKNOWN_SCORE)


def tier_weight(source_type: Column) -> Column:
    return _of(source_type, TIER_WEIGHT, UNKNOWN_WEIGHT)


def confidence(score: Column, weight: Column, agreeing: Column) -> Column:
    return round3(F.least(score * weight + AGREEMENT_BONUS * agreeing, F.lit(1.0)))


def field_confidence(method: Column, source_type: Column, agreeing: Column | None = None) -> Column:
    return confidence(base_score(method), tier_weight(source_type), F.lit(0) if agreeing is None else agreeing)


def priority(source_type: Column) -> Column:
    return F.coalesce(F.try_element_at(F.create_map(*(F.lit(x) for k, s in enumerate(SOURCE_PRIORITY) for x in (s, k))), source_type), F.lit(len(SOURCE_PRIORITY)))
