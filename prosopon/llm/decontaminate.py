"""Benchmark decontamination, with DataFrame functions only.

A window is `size` consecutive words of an item, or all words of an item that has fewer. Windows are compared as sets of shingles
(five words, or all of a shorter window) of which an occurrence must contain every one. With containment of all shingles the
prefix that is necessary holds one: the shingle that is rarest in the documents. Three steps:

1. rarity: occurrences in all documents of the shingles that windows have;
2. the rarest shingle of each window is joined with the documents' shingles. Its place in the text and in the window give the
   only place where the window can begin (positional bound), and what is left of the text has to be long enough (length bound);
3. the words of that stretch are compared with the window's, one by one, so equal hashes of shingles decide nothing.

Both joins send the windows to the tasks, in blocks of a proven size (rows and bytes); the documents are read once for each
block and step and are never shuffled. What is shuffled are hits: one row for each window and place.

Defined results: a null or empty text has no words and is clean; an item without words has no window; items with equal item_id
are one item, a null item_id is named by the empty text; repeated rows are judged each for itself; an empty table gives an empty
table; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from prosopon.llm.common import keyed_text
from prosopon.operators.durable import drop_table, write_table

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Most windows, and bytes of their words, that are sent to the tasks at once.
BLOCK_ROWS, BLOCK_BYTES = 100_000, 16_000_000


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(F.translate(text, _UPPER, _LOWER), NOT_WORD), "")


def _shingle(words: Column, at: Column, k: int) -> Column:
    """The hash of the k words from `at` on."""
    return F.xxhash64(*(F.get(words, at + d) for d in range(k)))


def windows_of(items: DataFrame, size: int, shingle: int, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """item, window (its words, joined), n_words: each window of each item once."""
    w = items.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("item"), words_of(F.coalesce(F.col(text_col).cast("string"), F.lit(""))).alias("words"))
    n = F.least(F.lit(size), F.size("words"))
    w = w.where(F.size("words") > 0).select("item", "words", n.alias("n_words"), F.explode(F.sequence(F.lit(0), F.size("words") - n)).alias("at"))
    return w.select("item", F.array_join(F.slice("words", F.col("at") + 1, F.col("n_words")), " ").alias("window"), "n_words").distinct()


def _shingles(windows: DataFrame, shingle: int) -> DataFrame:
    """window, n_words, k, at, shingle: the shingles of each window."""
    k = F.least(F.lit(shingle), F.col("n_words"))
    w = windows.select("window", "n_words", F.split("window", " ").alias("words"), k.alias("k"), F.explode(F.sequence(F.lit(0), F.col("n_words") - k)).alias("at"))
    value = F.coalesce(*(F.when(F.col("k") == j, _shingle(F.col("words"), F.col("at"), j)) for j in range(1, shingle + 1)))
    return w.select("window", "n_words", "k", "at", value.alias("shingle"))


def _placed(texts: DataFrame, kinds: list[int], base: bool) -> DataFrame:
    """The columns of texts and, for each place and each length of shingles, at and shingle; with `base` one row more, at -1."""
    places = F.explode(F.sequence(F.lit(-1 if base else 0), F.col("n") * len(kinds) - 1))
    p = texts.where("n > 0") if not base else texts
    p = p.select("*", places.alias("p"))
    at = F.floor(F.col("p") / len(kinds)).cast("int") if len(kinds) > 1 else F.col("p")
    value = F.coalesce(*(F.when((F.pmod(F.col("p"), F.lit(len(kinds))) == j) & (at + k <= F.col("n")) & (at >= 0), _shingle(F.col("words"), at, k)) for j, k in enumerate(kinds)))
    return p.select(*texts.columns, at.alias("at"), value.alias("shingle"))


def _blocks(windows: DataFrame, rows: int, size: int) -> int:
    """How many blocks keep each below the bounds; hash by window, doubled until the largest fits (one window alone always does)."""
    n, total = windows.agg(F.count("*"), F.coalesce(F.sum(F.octet_length("window")), F.lit(0))).first()
    blocks = max(1, -(-n // rows), -(-total // size))
    while blocks > 1:
        by = windows.groupBy(F.pmod(F.xxhash64("window"), F.lit(blocks)).alias("b")).agg(F.count("*").alias("n"), F.sum(F.octet_length("window")).alias("size"))
        if not by.where((F.col("n") > rows) | ((F.col("size") > size) & (F.col("n") > 1))).head(1):
            break
        blocks *= 2
    return blocks


def scan(
    docs: DataFrame, items: DataFrame, size: int = 10, shingle: int = 5, block_rows: int = BLOCK_ROWS, block_bytes: int = BLOCK_BYTES, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """doc_id, n_words, n_hit (words inside any occurrence of a window), n_items (items with occurring windows), items (their ids,
    sorted as strings), contaminated. One row per row of docs."""
    spark = docs.sparkSession
    of_item = write_table(windows_of(items, size, shingle), "windows")
    shingles = write_table(_shingles(of_item.select("window", "n_words").distinct(), shingle), "shingles")
    kinds = sorted(r["k"] for r in shingles.select("k").distinct().collect()) or [shingle]
    texts = keyed_text(docs, id_col, text_col).select(F.monotonically_increasing_id().alias("row"), "doc_id", words_of(F.col("text")).alias("words"))
    texts = texts.select("row", "doc_id", F.size("words").cast("long").alias("n"), "words")
    blocks = _blocks(of_item.select("window").distinct(), block_rows, block_bytes)
    if blocks > 1:  # rows are numbered once
        texts = write_table(texts, "texts")
    in_block = lambda b, c: F.pmod(F.xxhash64(c), F.lit(blocks)) == b

    seen = []
    for b in range(blocks):
        own = shingles.where(in_block(b, "window")).select("shingle").distinct()
        found = _placed(texts.select("n", "words"), kinds, False).select("shingle").join(F.broadcast(own), "shingle")
        seen.append(write_table(found.groupBy("shingle").agg(F.count("*").alias("n_seen")), "rarity"))
    rarity = seen[0]
    for more in seen[1:]:  # a shingle of windows in several blocks was counted for each, with equal results
        rarity = rarity.unionByName(more)
    rarity = rarity.groupBy("shingle").agg(F.max("n_seen").alias("n_seen"))
    rarest = F.min_by(F.struct("shingle", "at"), F.struct("n_seen", "at"))
    # A window of which a shingle never occurs can't occur.
    occurring = shingles.join(rarity, "shingle", "left").groupBy("window", "n_words").agg(rarest.alias("r"), F.count("n_seen").alias("found"), F.count("*").alias("all")).where("found = all")
    prefix = write_table(occurring.select(F.col("r.shingle").alias("key"), F.col("r.at").alias("offset"), F.col("n_words").alias("width"), "window"), "prefix")

    start = F.col("at") - F.col("offset")
    fits = (F.col("shingle") == F.col("key")) & (start >= 0) & (start + F.col("width") <= F.col("n"))
    same = F.array_join(F.slice("words", start + 1, F.col("width")), " ") == F.col("window")
    parts = []
    for b in range(blocks):
        rows = _placed(texts, kinds, b == 0).join(F.broadcast(prefix.where(in_block(b, "window"))), fits & same, "left").where("at < 0 OR window IS NOT NULL")
        parts.append(write_table(rows.select("row", F.when(F.col("at") < 0, F.col("doc_id")).alias("doc_id"), F.when(F.col("at") < 0, F.col("n")).alias("n"), start.alias("start"), (start + F.col("width")).alias("end"), "window"), "hits"))
    for t in [shingles, prefix, *seen, *([texts] if blocks > 1 else [])]:
        drop_table(t)
    out = parts[0]
    for more in parts[1:]:
        out = out.unionByName(more)

    hits = out.where("window IS NOT NULL")
    spans = hits.groupBy("row", "start").agg(F.max("end").alias("end"))
    before = F.max("end").over(Window.partitionBy("row").orderBy("start").rowsBetween(Window.unboundedPreceding, -1))
    covered = spans.select("row", "end", F.greatest(F.col("start"), F.coalesce(before, F.lit(0))).alias("free"))
    n_hit = covered.groupBy("row").agg(F.sum(F.greatest(F.col("end") - F.col("free"), F.lit(0))).alias("n_hit"))
    which = hits.select("row", "window").distinct().join(of_item.select("window", "item"), "window").select("row", "item").distinct()
    which = which.groupBy("row").agg(F.count("*").alias("n_items"), F.array_sort(F.collect_list("item")).alias("items"))
    full = parts[0].where("n IS NOT NULL").select("row", "doc_id", F.col("n").alias("n_words"))
    full = full.join(n_hit, "row", "left").join(which, "row", "left")
    return full.select(
        "doc_id", "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"), F.coalesce("n_items", F.lit(0)).cast("long").alias("n_items"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"), (F.coalesce("n_hit", F.lit(0)) > 0).alias("contaminated"),
    )


def digest(scanned: DataFrame) -> DataFrame:
    """The columns of scan() with the items as a digest of their ids, joined by commas."""
    return scanned.select("doc_id", "n_words", "n_hit", "n_items", F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated")
