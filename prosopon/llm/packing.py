"""Optimal length buckets.

The lengths of all documents are counted into one exact histogram; T tokens in all have at most sqrt(2 T) different lengths, so it is
small (and the driver holds it) however many documents there are. Dynamic programming over it chooses at most `n_buckets`
boundaries so that the padding of all documents to their bucket's bound is the least possible; bounds are lengths that occur. For a
fixed number of buckets the cost of ending at a length is a line in that length for every place where the last bucket may begin, so
the lower hull of these lines gives each optimum without trying all of them. Inside a bucket, documents ordered by length form
batches of at most `token_budget` padded tokens. A bucket is dealt to as many shards as its count needs, so that no task holds more
than about `shard_rows` documents of it; a shard's last batch may be short.

Defined results: a null or empty text has length 0 and is packed in the lowest bucket (a batch counts it as one token); a document longer than
the budget is a batch of its own; ties in length are ordered by doc_id; repeated rows are packed each for itself; an empty
table gives an empty table. The table of lengths stays in the shared folder, since the result reads it.
"""

from __future__ import annotations

import bisect
import itertools

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from prosopon.llm.token_counts import count_tokens
from prosopon.operators.durable import write_table


def word_count(text: Column) -> Column:
    """Words `[^\\x20\\x09-\\x0D]+` of a text."""
    text = F.coalesce(text.cast("string"), F.lit(""))
    pieces = F.size(F.split(text, "[\\x20\\x09-\\x0D]+"))
    blank = lambda c: F.instr(F.lit(" \t\n\x0b\x0c\r"), c).cast("boolean") & (F.length(c) > 0)
    return F.when(F.length(text) == 0, 0).otherwise(pieces - blank(F.substring(text, 1, 1)).cast("int") - (blank(F.right(text, F.lit(1))) & (pieces > 1)).cast("int")).cast("long")


def histogram(lengths: DataFrame) -> list[tuple[int, int]]:
    """(length, count), ascending. lengths: n_tokens."""
    return sorted((r["n_tokens"], r["n"]) for r in lengths.groupBy("n_tokens").agg(F.count("*").alias("n")).collect())


def best_bounds(cells: list[tuple[int, int]], n_buckets: int) -> list[int]:
    """The bounds of at most n_buckets buckets with the least padding in sum."""
    if not cells:
        return []
    top = [t for t, _ in cells]
    count, total = [0, *itertools.accumulate(n for _, n in cells)], [0, *itertools.accumulate(t * n for t, n in cells)]
    n = len(cells)
    # best[j]: padding of the first j cells. Before the first round only no cells at all have been packed.
    best: list[int | None] = [0] + [None] * n
    back: list[list[int]] = []
    for _ in range(min(n_buckets, n)):
        # A bucket of the cells i to j - 1 costs top[j - 1] * (count[j] - count[i]) - (total[j] - total[i]): for each i a line in top.
        lines: list[tuple[int, int, int]] = []  # slope, height at 0, i; the slopes fall
        first = 0
        new, begin = [0] + [None] * n, [0] * (n + 1)
        for j in range(1, n + 1):
            if (before := best[j - 1]) is not None:
                slope, height = -count[j - 1], before + total[j - 1]
                while len(lines) - first > 1:
                    (m0, b0, _), (m1, b1, _) = lines[-2:]
                    if (height - b0) * (m0 - m1) > (b1 - b0) * (m0 - slope):
                        break
                    lines.pop()  # nowhere below the lines beside it
                lines.append((slope, height, j - 1))
            q = top[j - 1]
            while len(lines) - first > 1 and lines[first + 1][0] * q + lines[first + 1][1] <= lines[first][0] * q + lines[first][1]:
                first += 1
            slope, height, begin[j] = lines[first]
            new[j] = slope * q + height + q * count[j] - total[j]
        back.append(begin)
        best = new
    bounds, j = [], n
    for begin in reversed(back):
        if j == 0:
            break
        bounds.append(top[j - 1])
        j = begin[j]
    return sorted(bounds)


def pack(df: DataFrame, length: Column | None = None, n_buckets: int = 16, token_budget: int = 32768, shard_rows: int = 8192, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_tokens, bucket, bucket_length, batch (bucket-shard-number), slot, padding. length: a column of df; words of the text by default."""
    n = F.coalesce((word_count(F.col(text_col)) if length is None else length).cast("long"), F.lit(0))
    lengths = write_table(df.select(F.col(id_col).cast("long").alias("doc_id"), F.greatest(n, F.lit(0)).alias("n_tokens")), "lengths")
    cells = histogram(lengths)
    bounds = best_bounds(cells, n_buckets)
    per = [0] * max(1, len(bounds))
    for top, k in cells:
        per[bisect.bisect_left(bounds, top)] += k
    shards = [max(1, -(-k // shard_rows)) for k in per]
    pick = lambda values: F.element_at(F.array(*(F.lit(int(v)).cast("long") for v in values)), F.col("bucket") + 1)
    bucket = F.lit(0)
    for b in bounds[:-1]:
        bucket = bucket + (F.col("n_tokens") > b).cast("int")
    rank = F.row_number().over(Window.partitionBy("bucket", "shard").orderBy(F.desc("n_tokens"), "doc_id")) - 1
    return (
        lengths.withColumn("bucket", bucket.cast("int"))
        .withColumn("bucket_length", pick(bounds or [0]))
        .withColumn("shard", F.pmod(F.xxhash64("doc_id", "n_tokens"), pick(shards)))
        .withColumn("rank", rank)
        .withColumn("capacity", F.greatest(F.lit(1), F.expr(f"{int(token_budget)} div greatest(bucket_length, 1)")))
        .select(
            "doc_id", "n_tokens", "bucket", "bucket_length",
            F.concat_ws("-", "bucket", "shard", F.expr("rank div capacity")).alias("batch"),
            F.expr("rank % capacity").cast("long").alias("slot"), (F.col("bucket_length") - F.col("n_tokens")).alias("padding"),
        )
    )


def pack_tokens(df: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """pack() by the exact number of tokens that a .json vocabulary gives, so that token_budget bounds tokens."""
    return pack(count_tokens(df, tokenizer_path, id_col=id_col, text_col=text_col), F.col("n_tokens"), **how)
