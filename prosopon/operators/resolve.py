"""Which records are one person: shared email or phone keys, their closure, and a guarded fall-back on names.

Every function takes a frame of partial records (see prosopon.schemas.PARTIAL).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from prosopon.functions.text import email_key, name_key, phone_key, slugify
from prosopon.operators.components import connected_components
from prosopon.operators.durable import drop_table, write_table
from prosopon.operators.hot import Lookups, shuffled


def identity_keys(partials: DataFrame) -> DataFrame:
    """rec_ord, key: the usable email and phone keys of each record; the two kinds cannot meet."""
    emails = partials.select("rec_ord", F.explode("emails").alias("x")).select("rec_ord", F.concat(F.lit("e:"), email_key(F.col("x"))).alias("key"))
    phones = partials.select("rec_ord", F.explode("phones").alias("x")).select("rec_ord", F.concat(F.lit("p:"), phone_key(F.col("x"))).alias("key"))
    return emails.unionByName(phones).where("key IS NOT NULL").distinct()


def identity_edges(partials: DataFrame) -> DataFrame:
    """a, b: every record of a key with the key's first record. A key of n records makes n - 1 edges, not n squared.

    The first record comes from an aggregate with partial sums and a join, so a key that holds a large share of the records
    does not have to fit in one task (the adaptive skew join splits it)."""
    keys = identity_keys(partials)
    first = keys.groupBy("key").agg(F.min("rec_ord").alias("a"), F.count("*").alias("n")).where("n > 1")
    return keys.join(shuffled(first), "key").where("rec_ord <> a").select("a", F.col("rec_ord").alias("b")).distinct()


def identity_clusters(partials: DataFrame) -> DataFrame:
    """rec_ord, root: the smallest rec_ord that shared keys reach."""
    c = connected_components(identity_edges(partials)).withColumnRenamed("node", "rec_ord")
    return partials.select("rec_ord").join(shuffled(c), "rec_ord", "left").select("rec_ord", F.coalesce("component", "rec_ord").alias("root"))


def name_fallback(partials: DataFrame, roots: DataFrame) -> DataFrame:
    """rec_ord, root: records of clusters without any email or phone go to the one cluster with identity that has a record of
    their name; with none or several they stay. A cluster without identity is a single record. A cluster of very many
    records does not meet in one task."""
    r = partials.select("rec_ord", name_key(F.col("full_name")).alias("name"), (F.size("emails") + F.size("phones") > 0).alias("bears")).join(shuffled(roots), "rec_ord")
    unique = r.where("bears AND name IS NOT NULL").groupBy("name").agg(F.min("root").alias("low"), F.max("root").alias("high")).where("low = high").select("name", F.col("low").alias("target"))
    lone = r.where("NOT bears").join(shuffled(unique), "name", "left").select("rec_ord", F.coalesce("target", "root").alias("root"))
    moved = write_table(r.where("bears").select("rec_ord", "root").unionByName(lone), "moved")
    # A lone record may come before the cluster that it joins.
    low = moved.groupBy("root").agg(F.min("rec_ord").alias("cluster_ord"))
    look = Lookups()
    out = write_table(look.left(moved, "root", low, look.hot_keys(moved, "root")).select("rec_ord", F.col("cluster_ord").alias("root")), "roots")
    look.drop()
    drop_table(moved)
    return out


def resolve(partials: DataFrame) -> DataFrame:
    """The records with cluster_ord, the smallest rec_ord of their cluster."""
    roots = name_fallback(partials, identity_clusters(partials))
    return partials.join(shuffled(roots.withColumnRenamed("root", "cluster_ord")), "rec_ord")


def candidate_ids(clustered: DataFrame) -> DataFrame:
    """cluster_ord, candidate_id, n_records: slug of the first name, and a digest of the sorted source ids."""
    name = F.when(F.col("full_name") != "", F.col("full_name"))
    g = clustered.groupBy("cluster_ord").agg(
        F.min_by(name, F.when(name.isNotNull(), F.col("rec_ord"))).alias("name"),
        F.substring(F.sha1(F.array_join(F.array_sort(F.collect_list("source_id")), "|").cast("binary")), 1, 6).alias("digest"),
        F.count("*").alias("n_records"),
    )
    return g.select("cluster_ord", F.concat_ws("-", F.when(F.col("name").isNull(), "unknown").otherwise(slugify(F.col("name"))), "digest").alias("candidate_id"), "n_records")
