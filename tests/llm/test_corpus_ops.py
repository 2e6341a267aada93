"""Alignment, decontamination and search against plain versions, with nulls, empty and long texts, ties, repeated rows, empty tables and
clashing columns."""

from __future__ import annotations

import hashlib
import random

import brute
import pytest
from pyspark.sql import functions as F
from test_ops import TEXTS, pairs

from prosopon.llm import alignment, decontaminate, search
from prosopon.operators.durable import write_table

P = pytest.importorskip("public_tokenizers")
A, B = P.path("byte_bpe_50k.json"), P.path("piece_bpe_32k.model")
MORE = ["a\nb", "a \n b", "end.\n\n  Next\t\tcolumn \n", " lead", "two  spaces   three", "a  b c　d", "x▁y", "<s> and </s> <0x41> <unk>", "ñandú Ünïcode ﬁ ½", "0123456789 1,000.50", "\x1c!\x1d \x85", "​﻿ z", "it's we'll 'S"]


@pytest.fixture(scope="module")
def odd(spark):
    """Every text twice under different keys; one row repeated whole; a null key; columns with clashing names."""
    texts = TEXTS + MORE
    rows = [(k, t) for k, t in enumerate(texts)] + [(100 + k, t) for k, t in enumerate(texts)] + [(3, "a"), (None, "no key")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumns({c: F.lit("x") for c in ("row", "n", "words", "window", "term", "stripe", "item", "n_a", "score", "at")})
    return df.repartition(3).cache()


@pytest.fixture(scope="module")
def docs(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet").cache()


@pytest.fixture(scope="module")
def items(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/benchmark.parquet").cache()


@pytest.fixture(scope="module")
def sides():
    from sentencepiece import SentencePieceProcessor
    from tokenizers import Tokenizer

    a, b = Tokenizer.from_file(A), SentencePieceProcessor(model_file=B)
    a.encode_special_tokens = True
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    byte = {chr(x): x for x in shown} | {chr(256 + k): x for k, x in enumerate(x for x in range(256) if x not in shown)}
    piece = lambda p: bytes([int(p[3:5], 16)]) if len(p) == 6 and p.startswith("<0x") else p.replace("▁", " ").encode()
    encode_a = lambda t: [(i, bytes(byte[c] for c in a.id_to_token(i))) for i in a.encode(t, add_special_tokens=False).ids]
    encode_b = lambda t: [(i, piece(b.id_to_piece(i))) for i in b.encode(t)]
    return encode_a, encode_b


def rows_of(df, *cols):
    return sorted((tuple(r) for r in df.select(*cols).collect()), key=repr)


# ---- alignment

STATS = ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


def plain(rows, sides):
    return sorted(((*r[:-1], hashlib.sha256(r[-1].encode()).hexdigest() if r[1] else "") for r in brute.alignment(rows, *sides)), key=repr)


@pytest.mark.parametrize("stripes", [128, 3000])
def test_alignment(odd, sides, stripes):
    assert rows_of(alignment.align(odd, A, B, stripes), *STATS) == plain(pairs(odd), sides)
    assert alignment.align(odd.limit(0), A, B).collect() == []


def test_alignment_of_the_table(spark, docs, sides):
    short = docs.where("length(text) < 4000")
    assert rows_of(alignment.align(short, A, B), *STATS) == plain(pairs(short), sides)


def test_alignment_is_the_same_however_it_is_dealt(spark, docs, monkeypatch):
    """More partitions than stripes (so that stripes are salted), and small slices and calls."""
    want = rows_of(alignment.align(docs, A, B), *STATS)
    monkeypatch.setattr(alignment, "SLICE", 1000)
    n = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "200")
    try:
        assert rows_of(alignment.align(docs.repartition(5), A, B, 64), *STATS) == want
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", n)


def test_units_are_encoded_as_in_their_text(sides):
    rng = random.Random(3)
    aligner = alignment.Aligner(A, B)
    parts = [" ", "  ", "\n", "\t", " ", "\x1c", "　", "the", "ing", "Er", "ñ", "日本", "1", "99", ".", ",", "'s", "<s>", "​", "😀", "\x00", " ", "--", "\r\n"]
    for _ in range(400):
        text = "".join(rng.choices(parts, k=rng.randrange(1, 25)))
        (stat,), links = aligner.align([text])
        got = [(int(x), int(y)) for _, a, b in links for x, y in zip(a, b)]
        (want,) = brute.alignment([(0, text)], *sides)
        assert stat[1:] == want[1:4] and len(got) == want[4], text
        assert (stat[0] or "") == (hashlib.sha256(want[-1].encode()).hexdigest() if want[1] else ""), text


def test_texts_are_cut_at_words_though_some_pieces_hold_white_space(sides):
    """The model has pieces such as ');' and a carriage return: no cut there, cuts everywhere else, and the same tokens."""
    aligner = alignment.Aligner(A, B)
    assert aligner.units("one two\n\n three\u3000four  ") == [" one", " two", "\n\n three", "\u3000four", "  "]
    assert aligner.units("f();\r\n x\t\ry\r") == [" f();\r\n x", "\t\ry\r"]
    assert len(aligner.units("a\r" * 300_000)) == 1 and len(aligner.units(" \ra" * 300_000)) == 300_000
    whole = alignment.Aligner(A, B)
    whole.b.cuts = False  # as with a model whose pieces hold spaces behind other characters
    rng = random.Random(4)
    parts = ["\r", "\r\n", "\n\r", " \r ", "\n", " ", "  ", "();", "}", "};", "/**", "*/", "']", "the", "ing", "ñ", "1", ",", "\u3000", "\x1c"]
    for _ in range(400):
        text = "".join(rng.choices(parts, k=rng.randrange(1, 25)))
        (stat,), links = aligner.align([text])
        (want,) = brute.alignment([(0, text)], *sides)
        assert stat[1:] == want[1:4] and sum(len(a) for _, a, _ in links) == want[4], text
        assert (stat[0] or "") == (hashlib.sha256(want[-1].encode()).hexdigest() if want[1] else ""), text
        assert whole.units(text) == [" " + text] and whole.align([text])[0] == [stat]


def test_remembered_units_are_bounded(monkeypatch, sides):
    monkeypatch.setattr(alignment, "REMEMBERED", 5)
    aligner = alignment.Aligner(A, B)
    for t in ["one two three", "four five six seven", "one two three four", "eight▁ nine", "one nine"]:
        (stat,), links = aligner.align([t])
        (want,) = brute.alignment([(0, t)], *sides)
        assert stat[1:] == want[1:4] and sum(len(a) for _, a, _ in links) == want[4]


# ---- decontamination

FOUND = ("doc_id", "n_words", "n_hit", "items")
ITEMS = [(1, "One two THREE four five six seven eight nine ten eleven twelve"), (2, "four five six seven eight nine ten eleven twelve thirteen fourteen"), (3, "brown fox"), (30, "brown fox"), (3, "quick brown"),
         (4, "x"), (5, None), (6, "?!"), (None, "tab and vertical"), (7, "a a a a a a a a a a a a"), (8, "é ñ ß quoted"), (9, "word word word"), (10, "the the the")]


@pytest.fixture(scope="module")
def planted(spark, odd):
    more = ["zero one two three; four five six seven eight nine TEN eleven twelve thirteen fourteen fifteen", "one two three four five six seven eight nine", "brown, fox! quick (brown) fox", "a " * 40, "a a a a a a a a a", "x x", "X"]
    return odd.select("doc_id", "text").unionByName(spark.createDataFrame([(1000 + k, t) for k, t in enumerate(more)] * 2, "doc_id long, text string")).withColumn("window", F.lit(1))


@pytest.mark.parametrize("size, shingle, blocks", [(10, 5, {}), (10, 5, {"block_rows": 12}), (4, 2, {"block_bytes": 900}), (3, 1, {})])
def test_decontamination(spark, planted, size, shingle, blocks):
    items = spark.createDataFrame(ITEMS, "item_id long, text string").withColumns({"doc_id": F.lit(1), "words": F.lit("x")})
    got = rows_of(decontaminate.scan(planted, items, size, shingle, **blocks), *FOUND)
    assert got == sorted(brute.decontamination(pairs(planted), ITEMS, size), key=repr)
    assert any(r[2] for r in got) and not all(r[2] for r in got)


def test_decontamination_of_the_table(docs, items):
    got = rows_of(decontaminate.scan(docs, items), *FOUND)
    assert got == sorted(brute.decontamination(pairs(docs), [(r["item_id"], r["text"]) for r in items.collect()], 10), key=repr)
    assert any(r[2] for r in got)


def test_decontamination_of_empty_tables(docs, items, odd):
    assert decontaminate.scan(docs.limit(0), items).collect() == []
    assert {tuple(r) for r in decontaminate.digest(decontaminate.scan(odd, items.limit(0))).select("n_hit", "n_items", "items_sha256", "contaminated").collect()} == {(0, 0, hashlib.sha256(b"").hexdigest(), False)}


# ---- search

RANKED = ("item_id", "rank", "doc_id", "score")


@pytest.mark.parametrize("k, first, factor, most", [(50, 8192, 8, 2000), (3, 2, 2, 2000), (5, 4, 3, 4), (2, 1, 2, 1000)])
def test_search(spark, odd, docs, k, first, factor, most):
    rows = pairs(docs.limit(120)) + pairs(odd)
    both = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"row": F.lit("x"), "term": F.lit(1)}).repartition(3)
    asked = [(i, t) for i, t in enumerate([*TEXTS, *MORE])] + [(7, "a a A"), (7, "a a A"), (None, "one the")] + [(500 + r, t) for r, (_, t) in enumerate(rows[:20])]
    items = spark.createDataFrame(asked, "item_id long, text string").withColumn("doc_id", F.lit("x"))
    got = search.answer(both, items, k, first, factor, most).cache()
    assert rows_of(got, *RANKED) == sorted(brute.search(rows, asked, k), key=repr)
    if first < 8:  # some items are settled by a higher tier, others fall through
        assert got.select("level").distinct().count() > 1


def test_search_of_empty_tables(docs, items):
    assert search.answer(docs.limit(0), items).collect() == search.answer(docs, items.limit(0)).collect() == []


def test_index_of_all_terms(docs, items):
    """An index that is not limited to the items' terms gives the same."""
    asked = write_table(search.query_terms(items), "queries")
    index = search.build(docs, first=16, factor=4)
    assert rows_of(search.search(index, asked, 10), *RANKED) == rows_of(search.answer(docs, items, 10), *RANKED)
    assert index.levels > 1 and index.tiers.count() == index.forward.count()
