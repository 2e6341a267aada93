"""One record per person: conflicts resolved by source priority, with confidence and provenance.

Each field is an aggregate of its own over the clustered records (partial aggregation before each shuffle), so a plan that
needs few fields computes few; `canonical` brings the fields together in one aggregation by cluster. Collected lists are
sorted by (rec_ord, position), so results don't depend on the order of rows. Their length is that of the result's arrays.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from prosopon.functions.phones import normalize_phone
from prosopon.functions.scoring import base_score, confidence, field_confidence, priority, round3, tier_weight
from prosopon.functions.text import email_key, normalize_date, normalize_location, normalize_name, normalize_skill, strip
from prosopon.operators.durable import drop_table, write_table
from prosopon.operators.resolve import candidate_ids
from prosopon.schemas import CANONICAL, LINKS, PROVENANCE


def _method(field: str, default: str = "direct") -> Column:
    return F.coalesce(F.try_element_at("methods", F.lit(field)), F.lit(default))


def _prov(field: Column, source: Column, method: Column, conf: Column) -> Column:
    return F.struct(field.alias("field"), source.alias("source"), method.alias("method"), conf.cast("double").alias("confidence"))


def pick_scalars(c: DataFrame) -> DataFrame:
    """full_name, location and headline of the record with the best source; ties go to the first record."""
    rank = F.struct(priority(F.col("source_type")).alias("p"), "rec_ord")

    def pick(field: str, present: Column) -> Column:
        value = F.struct(F.col(field).alias("value"), "source_id", _method(field).alias("method"), field_confidence(_method(field), F.col("source_type")).alias("conf"))
        return F.min_by(value, F.when(present, rank)).alias(field)

    g = c.groupBy("cluster_ord").agg(pick("full_name", F.col("full_name") != ""), pick("location", F.col("location").isNotNull()), pick("headline", F.col("headline") != ""))
    prov = lambda f: F.when(F.col(f).isNotNull(), F.array(_prov(F.lit(f), F.col(f"{f}.source_id"), F.col(f"{f}.method"), F.col(f"{f}.conf")))).otherwise(F.array().cast(PROVENANCE))
    return g.select(
        "cluster_ord", normalize_name(F.col("full_name.value")).alias("full_name"), normalize_location(F.col("location.value")).alias("location"), F.col("headline.value").alias("headline"),
        prov("full_name").alias("prov_name"), prov("location").alias("prov_location"), prov("headline").alias("prov_headline"),
    )


def _contributions(c: DataFrame, field: str, default: str) -> DataFrame:
    return c.select("cluster_ord", "rec_ord", "source_id", "source_type", _method(field, default).alias("method"), F.posexplode(field).alias("pos", "x"))


def _agreed(rows: DataFrame, field: str) -> DataFrame:
    """Values by first appearance; all contributors carry the first one's method and the value's confidence."""
    at = F.struct("rec_ord", "pos")
    g = rows.groupBy("cluster_ord", "key").agg(
        F.min(at).alias("at"), F.min_by(F.struct("method", "source_type"), at).alias("first"), F.count("*").alias("n"), F.array_sort(F.collect_list(F.struct("rec_ord", "pos", "source_id"))).alias("who")
    )
    g = g.withColumn("conf", confidence(base_score(F.col("first.method")), tier_weight(F.col("first.source_type")), F.col("n") - 1))
    lists = g.groupBy("cluster_ord").agg(F.array_sort(F.collect_list(F.struct("at", "key", "conf", F.col("first.method").alias("method"), "who"))).alias("v"))
    prov = F.flatten(F.transform("v", lambda v, i: F.transform(v["who"], lambda w: _prov(F.concat(F.lit(f"{field}["), i.cast("string"), F.lit("]")), w["source_id"], v["method"], v["conf"]))))
    return lists.select("cluster_ord", F.transform("v", lambda v: v["key"]).alias(field), prov.alias(f"prov_{field}"))


def merge_emails(c: DataFrame) -> DataFrame:
    rows = _contributions(c, "emails", "direct").withColumn("key", email_key(F.col("x"))).where("key IS NOT NULL")
    return _agreed(rows, "emails")


def merge_phones(c: DataFrame) -> DataFrame:
    """Numbers that cannot be normalized leave a row of provenance only, in prov_phones_failed."""
    rows = _contributions(c, "phones", "direct").withColumn("key", normalize_phone(F.col("x")))
    failed = rows.where("key IS NULL").groupBy("cluster_ord").agg(F.array_sort(F.collect_list(F.struct("rec_ord", "pos", "source_id"))).alias("w"))
    failed = failed.select("cluster_ord", F.transform("w", lambda w: _prov(F.lit("phones"), w["source_id"], F.lit("failed_normalize"), F.lit(0.1))).alias("prov_phones_failed"))
    return _together([_agreed(rows.where("key IS NOT NULL"), "phones"), failed])


def merge_skills(c: DataFrame) -> DataFrame:
    """The best method and the best source tier count, each for itself; every mention adds to the agreement."""
    rows = _contributions(c, "skills", "heuristic").withColumn("key", normalize_skill(F.col("x"))).where("key IS NOT NULL")
    g = rows.groupBy("cluster_ord", "key").agg(
        F.min(F.struct("rec_ord", "pos")).alias("at"),
        confidence(F.max(base_score(F.col("method"))), F.max(tier_weight(F.col("source_type"))), F.count("*") - 1).alias("conf"),
        F.array_sort(F.collect_list(F.struct("rec_ord", "pos", "source_id", "method"))).alias("who"),
    )
    lists = g.groupBy("cluster_ord").agg(F.array_sort(F.collect_list(F.struct("at", "key", "conf", "who"))).alias("v"))
    skills = F.transform("v", lambda v: F.struct(v["key"].alias("name"), v["conf"].alias("confidence"), F.transform(v["who"], lambda w: w["source_id"]).alias("sources")))
    prov = F.flatten(F.transform("v", lambda v: F.transform(v["who"], lambda w: _prov(F.concat(F.lit("skills["), v["key"], F.lit("]")), w["source_id"], w["method"], v["conf"]))))
    return lists.select("cluster_ord", skills.alias("skills"), prov.alias("prov_skills"))


def _by_priority(c: DataFrame, field: str, first: str, second: str) -> DataFrame:
    low = lambda x: F.lower(strip(F.coalesce(F.col(f"x.{x}"), F.lit(""))))
    return _contributions(c, field, "direct").select(
        "cluster_ord", F.struct(priority(F.col("source_type")).alias("p"), "rec_ord", "pos").alias("at"), "source_id", "method", "source_type", "x", low(first).alias("k1"), low(second).alias("k2")
    )


def _entry_provenance(rows: DataFrame, field: str) -> DataFrame:
    entry = F.struct("at", _prov(F.concat(F.lit(f"{field}["), "k1", F.lit("|"), "k2", F.lit("]")), F.col("source_id"), F.col("method"), field_confidence(F.col("method"), F.col("source_type"))).alias("p"))
    return rows.groupBy("cluster_ord").agg(F.transform(F.array_sort(F.collect_list(entry)), lambda e: e["p"]).alias(f"prov_{field}"))


def merge_experience(c: DataFrame) -> DataFrame:
    """One entry per company and title, from the best source; a missing summary is filled from the next entry that has one."""
    rows = _by_priority(c, "experience", "company", "title")
    has = F.col("x.summary") != ""
    g = rows.groupBy("cluster_ord", "k1", "k2").agg(F.min("at").alias("at"), F.min_by("x", "at").alias("x"), F.min_by("x.summary", F.when(has, F.col("at"))).alias("filled"))
    e = F.struct(
        F.col("x.company").alias("company"), F.col("x.title").alias("title"), normalize_date(F.col("x.start")).alias("start"), normalize_date(F.col("x.end")).alias("end"),
        F.coalesce("filled", "x.summary").alias("summary"),
    )
    lists = g.groupBy("cluster_ord").agg(F.transform(F.array_sort(F.collect_list(F.struct("at", e.alias("e")))), lambda v: v["e"]).alias("experience"))
    return _together([lists, _entry_provenance(rows, "experience")])


def merge_education(c: DataFrame) -> DataFrame:
    """One entry per institution and degree, whole, from the best source."""
    rows = _by_priority(c, "education", "institution", "degree")
    g = rows.groupBy("cluster_ord", "k1", "k2").agg(F.min("at").alias("at"), F.min_by("x", "at").alias("e"))
    lists = g.groupBy("cluster_ord").agg(F.transform(F.array_sort(F.collect_list(F.struct("at", "e"))), lambda v: v["e"]).alias("education"))
    return _together([lists, _entry_provenance(rows, "education")])


def _together(parts: list[DataFrame]) -> DataFrame:
    """Frames of different columns by cluster_ord in one: a union and one aggregation, in which each column has one value."""
    union = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    return union.groupBy("cluster_ord").agg(*(F.first(x, ignorenulls=True).alias(x) for x in union.columns if x != "cluster_ord"))


def overall_confidence() -> Column:
    return round3(overall_score())


def overall_score() -> Column:
    """From provenance: 0.7 of the mean of three required fields and 0.3 of that of the optional fields that score."""
    mean = lambda f: F.expr(
        f"aggregate(filter(provenance, p -> substring_index(p.field, '[', 1) = '{f}'), struct(0D AS s, 0 AS n), (a, p) -> struct(a.s + p.confidence AS s, a.n + 1 AS n), a -> if(a.n = 0, 0.5D, a.s / a.n))"
    )
    filled = {"full_name": F.col("full_name").isNotNull(), "location": F.col("location").isNotNull(), "headline": F.coalesce(F.col("headline"), F.lit("")) != ""}
    score = lambda f: F.when(filled.get(f, F.size(f) > 0), mean(f)).otherwise(0.0)
    required = (score("full_name") + score("emails") + score("skills")) / 3
    optional = F.filter(F.array(*map(score, ("phones", "location", "headline", "experience", "education"))), lambda s: s > 0)
    average = F.aggregate(optional, F.lit(0.0), lambda a, s: a + s) / F.size(optional)
    return F.when(F.size(optional) > 0, 0.7 * required + 0.3 * average).otherwise(required)


def canonical(clustered: DataFrame) -> DataFrame:
    """All fields of every cluster, in the order of CANONICAL, and cluster_ord: a table. clustered: a table, since every field reads it.

    Each field is a plan of its own, written before they meet: one plan of all of them takes the driver more memory and time than the data."""
    fields = {"ids": lambda c: candidate_ids(c).drop("n_records"), **{f.__name__: f for f in (pick_scalars, merge_emails, merge_phones, merge_skills, merge_experience, merge_education)}}
    tables = [write_table(f(clustered), name) for name, f in fields.items()]
    records = write_table(_records(_together(tables)), "records")
    for t in tables:
        drop_table(t)
    return records


def _records(parts: DataFrame) -> DataFrame:
    empty = lambda x, kind: F.coalesce(F.col(x), F.array().cast(kind))
    prov = [empty(f"prov_{x}", PROVENANCE) for x in ("name", "emails", "phones_failed", "phones", "location", "headline", "skills", "experience", "education")]
    full = parts.select(
        "cluster_ord", "candidate_id", "full_name", "location", "headline", *(empty(x, CANONICAL[x]).alias(x) for x in ("emails", "phones", "skills", "experience", "education")),
        F.concat(*prov).alias("provenance"), F.lit(None).cast("double").alias("years_experience"),
        F.struct(*(F.lit(None).cast("string").alias(x) for x in ("linkedin", "github", "portfolio")), F.array().cast("array<string>").alias("other")).cast(LINKS).alias("links"),
    )
    return full.withColumn("overall_confidence", overall_confidence()).select("cluster_ord", *CANONICAL)
