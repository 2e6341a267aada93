"""Ranked lexical search over a tiered index.

A text's score for an item is a sum over the item's terms of integer impacts: a weight that falls with the number of texts that
hold the term, times a saturated count that falls with the text's length (`impacts` has the formula). The index holds each term's
postings in tiers, highest impacts first. A histogram of the saturated counts gives each term its cuts: the first tier of
a term has about as many postings as `share` of the texts (`first` at least), the next `factor` times as many, and so on; whole steps of
the histogram go together. Cuts are shares because residuals are quantiles of a term's impacts, which more texts do not lower. Each term
carries its residual bounds: the highest impact below each tier.

Items are answered from the first tier where that is proven to be exact. A text that tiers up to now have shown scores at least what
they add up to, and at most that plus the residuals of the item's terms under which it was not seen; one not seen at all at
most the sum of all residuals. The scores of the k texts with the highest lower bounds are completed from the postings by text; the
lowest of them is the threshold. If the sum of all residuals is below it, only seen texts whose highest bound reaches it can
be among the best; their scores are completed too, and the best k are exact. Items without this proof, or with more such texts
than `most` an item, fall through to the next tier; after the last tier all scores are whole.

Postings by text are made in the task that reads it, without a shuffle. Tables are written and read from the shared folder. Only
counts come to the driver; candidates are broadcast only where there are at most `BROADCAST_ROWS` of them.

Defined results: a null text or one without terms is not counted and never found; an item without terms, or whose terms no
text has, has no row; repeated items are answered each for itself, repeated texts are each a text of their own; equal scores are
ranked by doc_id (nulls first); an empty table gives an empty table; other columns are not read.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from prosopon.llm.common import keyed_text, prepare, utf8
from prosopon.operators.durable import drop_table, write_table

#: Terms, over UTF-8: every byte of a character above ASCII counts, so that whole characters do.
TERM = re.compile(rb"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
#: Steps of the histogram of saturated counts, which are below a million or equal to it.
STEPS = 64
#: Most rows (of two numbers each) that are sent to all tasks.
BROADCAST_ROWS = 500_000


def terms_of(text: str) -> list[bytes]:
    """Only A-Z are lower-cased, as bytes.lower() does."""
    return TERM.findall(utf8(text).lower())


def postings(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """row, doc_id, n (terms of the text, with repeats), term, tf; and for each text that has terms one row whose term is null."""
    texts = keyed_text(docs, id_col, text_col).select(F.monotonically_increasing_id().alias("row"), "doc_id", "text")
    prepare(docs.sparkSession)

    def run(batches):
        for b in batches:
            row, sizes, n, terms, tf, ids = [], [], [], [], [], []
            for r, i, t in zip(b.column("row").to_pylist(), b.column("doc_id").to_pylist(), b.column("text").to_pylist()):
                counts = Counter(terms_of(t))
                if counts:
                    row.append(r)
                    ids.append(i)
                    n.append(sum(counts.values()))
                    sizes.append(len(counts) + 1)
                    terms.append(None)
                    terms += counts
                    tf.append(0)
                    tf += counts.values()
            each = np.repeat(np.arange(len(row)), sizes)
            yield pa.RecordBatch.from_arrays([pa.array(row, pa.int64()).take(each), pa.array(ids, pa.int64()).take(each), pa.array(n, pa.int64()).take(each), pa.array(terms, pa.binary()).cast(pa.string()), pa.array(tf, pa.int64())], names=["row", "doc_id", "n", "term", "tf"])

    return texts.mapInArrow(run, "row long, doc_id long, n long, term string, tf long")


def query_terms(items: DataFrame, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """item (a number for each row), item_id, term: the terms of every item, once each."""
    p = postings(items, id_col, text_col)
    return p.where("term IS NOT NULL").select(F.col("row").alias("item"), F.col("doc_id").alias("item_id"), "term")


def saturated(n_texts: int, n_terms: int) -> Column:
    return F.expr(f"(1000000000 * tf) div (1000 * tf + 20 * (50 + (50 * n * {n_texts}L) div {max(1, n_terms)}L))")


@dataclass(frozen=True)
class Index:
    """forward: row, doc_id, term, impact, by text. tiers: the same by tier, each file a range of texts, its postings by term, so that
    a text's sums are mostly made in one task. terms: term, df, weight, residual (the highest impact below each tier but the last)."""

    forward: DataFrame
    tiers: DataFrame
    terms: DataFrame
    levels: int

    def drop(self) -> None:
        for t in (self.forward, self.tiers, self.terms):
            drop_table(t)


def build(docs: DataFrame, terms: DataFrame | None = None, first: int = 2048, factor: int = 4, share: float = 1 / 32, id_col: str = "doc_id", text_col: str = "text") -> Index:
    """The index of all texts; with `terms` (a column term) of these terms only. Counts of texts and lengths are those of whole texts."""
    p = postings(docs, id_col, text_col)
    if terms is not None:
        asked = terms.select("term").distinct().withColumn("asked", F.lit(True))
        p = p.join(asked, "term", "left").where("asked OR term IS NULL").drop("asked")
    p = write_table(p, "postings")
    total = p.where("term IS NULL").agg(F.count("*").alias("texts"), F.coalesce(F.sum("n"), F.lit(0)).alias("terms")).first()
    first = max(first, int(total["texts"] * share))
    cuts = []
    while first * factor ** len(cuts) < total["texts"]:
        cuts.append(first * factor ** len(cuts))
    own = p.where("term IS NOT NULL").withColumn("part", saturated(total["texts"], total["terms"]))
    own = own.withColumn("step", F.least(F.lit(STEPS - 1), F.expr(f"part div {1_000_000 // STEPS}")).cast("int"))
    steps = own.groupBy("term", "step").agg(F.count("*").alias("n"), F.max("part").alias("top"))
    above = F.coalesce(F.sum("n").over(Window.partitionBy("term").orderBy(F.desc("step")).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    weight = F.floor(1000 * F.log((2 * F.lit(total["texts"]) + 2) / (2 * F.col("df") + 1)))
    listed = lambda cols, kind: F.array(*cols) if cols else F.array().cast(kind)
    by_term = (
        steps.withColumn("above", above).groupBy("term").agg(
            F.sum("n").alias("df"), listed([F.min(F.when(F.col("above") < c, F.col("step"))) for c in cuts], "array<int>").alias("cut"),
            listed([F.coalesce(F.max(F.when(F.col("above") >= c, F.col("top"))), F.lit(0)) for c in cuts], "array<bigint>").alias("below"),
        )
        .withColumn("weight", weight).select("term", "df", "weight", "cut", F.transform("below", lambda x: x * F.col("weight")).alias("residual"))
    )
    by_term = write_table(by_term, "terms")
    tier = F.lit(0)
    for k in range(len(cuts)):
        tier = tier + (F.col("step") < F.get("cut", F.lit(k))).cast("int")
    full = own.join(by_term.select("term", "weight", "cut"), "term").select("row", "doc_id", "term", (F.col("weight") * F.col("part")).alias("impact"), tier.alias("tier"))
    tiers = write_table(full.sortWithinPartitions("tier", "term"), "tiers", "tier")  # dealt by text already
    forward = write_table(full.drop("tier"), "forward")
    drop_table(p)
    return Index(forward, tiers, by_term, len(cuts) + 1)


def _best(scored: DataFrame, k: int, *ties: str) -> DataFrame:
    """The k best rows of each item, with rank."""
    order = Window.partitionBy("item").orderBy(F.desc("score"), *ties, F.asc("row"))
    return scored.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _whole(index: Index, asked: DataFrame, pairs: DataFrame | None = None) -> DataFrame:
    """item, row, doc_id, score: of some pairs (a written table of item and row) from the postings by text, of all from all tiers."""
    own, keys = index.tiers, ["term"]
    if pairs is not None:
        own, keys = index.forward.join(F.broadcast(pairs) if pairs.count() <= BROADCAST_ROWS else pairs, "row"), ["item", "term"]
    return own.join(asked.select("item", "term"), keys).groupBy("item", "row", "doc_id").agg(F.sum("impact").alias("score")).where("score > 0")


def search(index: Index, asked: DataFrame, k: int = 50, most: int = 5000) -> DataFrame:
    """item_id, rank, doc_id, score, level (the tier that settled the item) of the k best texts of each item. asked: rows of query_terms(), written."""
    names = asked.select("item", "item_id").distinct()
    left = write_table(asked.join(index.terms.select("term", "residual"), "term").select("item", "term", "residual"), "asked")
    done = []
    keep = lambda scored, level: done.append(write_table(_best(scored, k, "doc_id").drop("rank").withColumn("level", F.lit(level)), "best"))
    for level in range(index.levels):
        if level == index.levels - 1:
            keep(_whole(index, left), level)
            break
        now = left.select("item", "term", F.get("residual", F.lit(level)).alias("rest"))
        seen = index.tiers.where(F.col("tier") <= level).join(now, "term").groupBy("item", "row").agg(F.sum("impact").alias("score"), F.sum("rest").alias("known"))
        seen = write_table(seen, "seen")
        top = write_table(_best(seen, k).select("item", "row"), "top")
        least = _whole(index, left, top).groupBy("item").agg(F.min("score").alias("score"), F.count("*").alias("n"))
        bounds = now.groupBy("item").agg(F.sum("rest").alias("rest")).join(least, "item", "left")
        bounds = write_table(bounds.select("item", "rest", F.when(F.col("n") == k, F.col("score")).otherwise(0).alias("least")).where("rest < least OR rest = 0"), "bounds")
        could = write_table(seen.join(bounds, "item").where("score + rest - known >= least").select("item", "row", "rest"), "candidates")
        few = could.groupBy("item", "rest").agg(F.count("*").alias("n")).where((F.col("n") <= most) | (F.col("rest") == 0))
        nothing = bounds.where("rest = 0").select("item")  # terms of which no tier below has any posting
        proven = write_table(few.select("item").unionByName(nothing).distinct(), "proven")
        chosen = write_table(could.select("item", "row").join(proven, "item"), "chosen")
        keep(_whole(index, left, chosen), level)
        still = write_table(left.join(proven, "item", "left_anti"), "asked")
        for t in (seen, top, bounds, could, proven, chosen, left):
            drop_table(t)
        left = still
        if not left.head(1):
            break
    drop_table(left)
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    return _best(out, k, "doc_id").join(names, "item").select("item_id", "rank", "doc_id", "score", "level")


def answer(docs: DataFrame, items: DataFrame, k: int = 50, first: int = 2048, factor: int = 4, most: int = 5000) -> DataFrame:
    """The k best texts of every item, from an index of the items' terms."""
    asked = write_table(query_terms(items), "queries")
    index = build(docs, asked, first, factor)
    out = search(index, asked, k, most)
    index.drop()
    return out
