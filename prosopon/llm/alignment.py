"""Alignment of two tokenizers: which tokens of a byte-level BPE (side A) stand for which of a sentencepiece model (side B).

Both sides encode a space and the text. Tokens are placed by their bytes; an A and a B token occurrence are linked where their byte
ranges overlap, and places where both sides end a token cut them into groups. An id pair's count is the number of links in
all texts that hold it.

Texts are cut before each run of white space that follows another character, unless it begins with one that B has a piece for with another
character before it (a carriage return behind brackets, say; found when the model is loaded). No token of either side reaches over such
a place: A's pattern has no alternative that goes from another character to white space, and B no piece. So a unit (white space and what follows up to the next) has its tokens whatever
stands around it, and each distinct unit of a batch is encoded, placed and linked once. Links of a batch are counted
for each text and pair and packed by stripe.

B's ids are dealt to stripes (id modulo their number, so that frequent low ids are spread). Counting: each stripe has a dense matrix, its B
ids by all A ids, and np.add.at() adds the batches' sums; first in as many parts as the cluster has partitions for, whose non-zero cells are
then added by stripe. Row maxima are the best counts. Scoring: a stripe's counts and its links meet in one task, the counts first; links
stream by, one batch at a time, and leave sums for each text.

Memory: a matrix and one batch a task. A text that is one unit, however long, is held whole. Links are written once, to the shared
folder, and dropped at the end; results are written before.

Defined results: a null or empty text, and one whose bytes either side does not give back, has no tokens: zeros and an empty
groups_sha256; repeated rows are aligned each for itself, and each adds to the counts; an empty table gives an empty table; other columns
are not read.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from prosopon.llm.common import keyed_text, prepare
from prosopon.llm.token_counts import ByteBPE
from prosopon.operators.durable import drop_table, write_table

#: White space (the Unicode property) that both sides know.
SPACE = "\t-\r " + "".join(map(chr, (0x85, 0xA0, 0x1680, 0x2028, 0x2029, 0x202F, 0x205F, 0x3000))) + chr(0x2000) + "-" + chr(0x200A)
MARK = chr(0x2581)
#: Characters that one call encodes, links that are packed at once, and units that a task remembers.
CALL, SLICE, REMEMBERED = 200_000, 2_000_000, 400_000
_CODEC = "zstd"


class Pieces:
    """A sentencepiece model with byte fallback, its pieces as bytes."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.n = self.model.get_piece_size()
        names = [self.model.id_to_piece(i) for i in range(self.n)]
        inside = re.compile(f"[^{SPACE}{MARK}]([{SPACE}{MARK}])")
        joins = {m[1] for x in names for m in inside.finditer(x)}  # white space that may be in a token with another character before it
        self.cuts = not joins & {" ", MARK}
        more = f"(?:[{''.join(sorted(joins))}][{SPACE}]*(?:[^{SPACE}]+|\\Z))*" if joins else ""
        self.unit = re.compile(f"[{SPACE}]*[^{SPACE}]+{more}|[{SPACE}]+\\Z")
        byte = [re.fullmatch("<0x([0-9A-F]{2})>", x) if self.model.is_byte(i) else None for i, x in enumerate(names)]
        self.bytes = [bytes([int(m[1], 16)]) if m else x.replace(MARK, " ").encode() for m, x in zip(byte, names)]
        self.size = np.array([len(x) for x in self.bytes], np.int64)

    def encode(self, text: str) -> list[int]:
        """Of a text that begins with a space, which the model adds by itself."""
        return self.model.encode(text[1:])

    def joined(self, ids: list[int]) -> bytes:
        return b"".join(map(self.bytes.__getitem__, ids))


class Aligner:
    """Tokens, groups and links of units; remembers what it has seen."""

    def __init__(self, a_path: str, b_path: str):
        self.a, self.b = ByteBPE(a_path), Pieces(b_path)
        self.a_names, self.b_names = [str(i) for i in range(len(self.a.size))], [str(i) for i in range(self.b.n)]
        self.forget()

    def forget(self) -> None:
        self.known: dict[str, int] = {}
        self.n_a, self.n_b, self.n_groups = (np.zeros(0, np.int64) for _ in range(3))
        self.groups: list[str | None] = []  # None: not the unit's bytes
        self.first = np.zeros(1, np.int64)  # where a unit's links begin, and the end of all
        self.link_a, self.link_b = np.zeros(0, np.uint16 if len(self.a.size) <= 1 << 16 else np.int64), np.zeros(0, np.uint16 if self.b.n <= 1 << 16 else np.int64)

    def units(self, text: str) -> list[str]:
        text = " " + text
        return self.b.unit.findall(text) if self.b.cuts else [text]

    def learn(self, units: set[str]) -> None:
        """Encodes those units that are not known."""
        if len(self.known) > REMEMBERED:
            self.forget()
        new = [u for u in units if u not in self.known]
        alone = [] if self.b.cuts else new
        batch, size = [], 0
        for u in new if self.b.cuts else ():
            if MARK in u or u[-1:].isspace() or len(u) > CALL:
                alone.append(u)
                continue
            batch.append(u)
            size += len(u)
            if size > CALL:
                self._add(batch)
                batch, size = [], 0
        if batch:
            self._add(batch)
        for u in alone:
            self._add([u], not self.b.cuts)

    def _add(self, units: list[str], bare: bool = False) -> None:
        """Units that end in another character than white space, encoded in one call behind ' a', or a single one as it is."""
        text = "".join(units) if bare else " a" + "".join(units)
        raw = text.encode()
        a, b = self.a.enc.encode_ordinary(text), self.b.encode(text)
        if self.b.joined(b) != raw or int(self.a.size[a].sum()) != len(raw):
            if len(units) > 1:
                for u in units:
                    self._add([u])
            else:
                self._keep(units, [0], [0], [0], [None], np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64))
            return
        skip = 0 if bare else 2
        a, b = np.array(a, np.int64), np.array(b, np.int64)
        end_a, end_b = np.cumsum(self.a.size[a]), np.cumsum(self.b.size[b])
        a, b, end_a, end_b = a[end_a > skip], b[end_b > skip], end_a[end_a > skip] - skip, end_b[end_b > skip] - skip
        ends = np.cumsum([len(u.encode()) for u in units])
        both = np.intersect1d(end_a, end_b, assume_unique=True)
        cut = np.union1d(end_a, end_b)  # each stretch between two cuts lies in one token of either side
        unit_of = np.searchsorted(ends, both)
        na, nb = np.searchsorted(end_a, ends, "right"), np.searchsorted(end_b, ends, "right")
        ga, gb = np.searchsorted(end_a, both, "right").tolist(), np.searchsorted(end_b, both, "right").tolist()
        sa, sb = [self.a_names[x] for x in a.tolist()], [self.b_names[x] for x in b.tolist()]
        texts, i, j = [], 0, 0
        for x, y in zip(ga, gb):
            texts.append((sa[i] if x - i == 1 else ",".join(sa[i:x])) + "|" + (sb[j] if y - j == 1 else ",".join(sb[j:y])))
            i, j = x, y
        n_groups = np.bincount(unit_of, minlength=len(units))
        at, groups = 0, []
        for n in n_groups.tolist():
            groups.append(texts[at] if n == 1 else ";".join(texts[at : at + n]))
            at += n
        self._keep(units, np.diff(na, prepend=0), np.diff(nb, prepend=0), n_groups, groups, a[np.searchsorted(end_a, cut)], b[np.searchsorted(end_b, cut)], np.bincount(np.searchsorted(ends, cut), minlength=len(units)))

    def _keep(self, units, n_a, n_b, n_groups, groups, link_a, link_b, n_links) -> None:
        for u in units:
            self.known[u] = len(self.known)
        self.pending.append((n_a, n_b, n_groups, link_a, link_b, n_links if len(n_links) else [0]))
        self.groups += groups

    def align(self, texts: list[str]):
        """For each text (groups as a string or None, n_a, n_b, n_groups), and a generator of (text's place, A ids, B ids) of links, by slices."""
        cut = [self.units(t) if t else [] for t in texts]
        self.pending = []
        wanted = set().union(*cut)
        self.learn(wanted)
        if self.pending:
            cols = [np.concatenate([np.asarray(p[k]) for p in self.pending]) for k in range(6)]
            self.n_a, self.n_b, self.n_groups = (np.concatenate([old, new]) for old, new in zip((self.n_a, self.n_b, self.n_groups), cols))
            self.link_a, self.link_b = np.concatenate([self.link_a, cols[3].astype(self.link_a.dtype)]), np.concatenate([self.link_b, cols[4].astype(self.link_b.dtype)])
            self.first = np.concatenate([self.first, self.first[-1] + np.cumsum(cols[5])]).astype(np.int64)
        stats, kept = [], []
        for k, units in enumerate(cut):
            ids = list(map(self.known.__getitem__, units))
            parts = list(map(self.groups.__getitem__, ids))
            if not ids or None in parts:
                stats.append((None, 0, 0, 0))
                continue
            at = np.array(ids, np.int64)
            stats.append((hashlib.sha256(";".join(parts).encode()).hexdigest(), int(self.n_a[at].sum()), int(self.n_b[at].sum()), int(self.n_groups[at].sum())))
            kept.append((k, at))
        return stats, self._links(kept)

    def _links(self, kept):
        place = np.repeat(np.array([k for k, _ in kept], np.int64), [len(at) for _, at in kept]) if kept else np.zeros(0, np.int64)
        unit = np.concatenate([at for _, at in kept]) if kept else np.zeros(0, np.int64)
        n = self.first[unit + 1] - self.first[unit]
        total = np.cumsum(n)
        start = 0
        while start < len(unit):
            stop = max(start + 1, int(np.searchsorted(total, (total[start - 1] if start else 0) + SLICE, "right")))
            m = n[start:stop]
            inner = np.arange(m.sum()) - np.repeat(np.cumsum(m) - m, m) + np.repeat(self.first[unit[start:stop]], m)
            yield np.repeat(place[start:stop], m), self.link_a[inner], self.link_b[inner]
            start = stop


def _pack(x: np.ndarray) -> bytes:
    return pa.compress(np.ascontiguousarray(x).tobytes(), codec=_CODEC, asbytes=True)


def _unpack(data: bytes, n: int, kind) -> np.ndarray:
    return np.frombuffer(pa.decompress(data, decompressed_size=n * np.dtype(kind).itemsize, codec=_CODEC, asbytes=True), kind)


_STATS = ["row", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256"]
_LINKS = ["stripe", "n_cells", "cells", "sums", "n_pairs", "pair_cell", "pair_text", "pair_links"]
_SCHEMA = "row long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, stripe int, n_cells long, cells binary, sums binary, n_pairs long, pair_cell binary, pair_text binary, pair_links binary"
_KINDS = dict(x.split(" ") for x in _SCHEMA.split(", "))
_ARROW = pa.schema([(k, {"long": pa.int64(), "int": pa.int32(), "string": pa.string(), "binary": pa.binary()}[t]) for k, t in _KINDS.items()])


def _batch(cols: dict) -> pa.RecordBatch:
    n = len(next(iter(cols.values())))
    return pa.RecordBatch.from_arrays([pa.array(cols[f.name], f.type) if f.name in cols else pa.nulls(n, f.type) for f in _ARROW], schema=_ARROW)


def _packed(base: int, place: np.ndarray, a: np.ndarray, b: np.ndarray, n_texts: int, n_a: int, stripes: int, width: int) -> dict:
    """The links of a batch by stripe: sums for each cell of the stripe's matrix, and for each cell and text the number of links.
    A cell is (B id div stripes) * n_a + A id; the texts are rows base to base + n_texts."""
    b = b.astype(np.int64)
    key = (((b % stripes) * width + b // stripes) * n_a + a) * n_texts + place
    key, n = np.unique(key, return_counts=True)
    code = key // n_texts
    first = np.flatnonzero(np.diff(code, prepend=-1))
    cell, sums = code[first], np.add.reduceat(n, first) if len(first) else n
    edges = np.arange(stripes + 1) * width * n_a
    pairs, cells = np.searchsorted(code, edges), np.searchsorted(cell, edges)
    out = {k: [] for k in ("row", *_LINKS)}
    for s in np.flatnonzero(np.diff(pairs)):
        p, c = slice(pairs[s], pairs[s + 1]), slice(cells[s], cells[s + 1])
        own = cell[c] - edges[s]
        # cells as steps, which are small and compress well; pairs as places among the cells
        row = (base, int(s), len(own), _pack(np.diff(own, prepend=0).astype(np.uint32)), _pack(sums[c].astype(np.uint32)), int(p.stop - p.start),
               _pack(np.diff(np.searchsorted(own, code[p] - edges[s]), prepend=0).astype(np.uint8)), _pack((key[p] % n_texts).astype(np.uint32)), _pack(n[p].astype(np.uint32)))
        for k, v in zip(out, row):
            out[k].append(v)
    return out


def _cells(r: dict) -> np.ndarray:
    return np.cumsum(_unpack(r["cells"], r["n_cells"], np.uint32), dtype=np.int64)


def _rows(batch: pa.RecordBatch):
    return (dict(zip(batch.schema.names, x)) for x in zip(*(c.to_pylist() for c in batch.columns)))


def _counted(parts: DataFrame, keys: list[str], cells: int) -> DataFrame:
    """stripe, n_cells, cells, sums: the sums of all rows of each key, added up in a dense matrix."""

    def run(batches):
        block, at = np.zeros(cells, np.int64), None

        def done():
            own = np.flatnonzero(block)
            sums = block[own]
            block[own] = 0
            return pa.RecordBatch.from_pydict({"stripe": pa.array([at[0]], pa.int32()), "n_cells": pa.array([len(own)], pa.int64()), "cells": [_pack(np.diff(own, prepend=0).astype(np.uint32))], "sums": [_pack(sums)]})

        for b in batches:
            for r in _rows(b):
                now = (r["stripe"], *(r[k] for k in keys[1:]))
                if now != at and at is not None:
                    yield done()
                at = now
                sums = r["sums"]
                np.add.at(block, _cells(r), _unpack(sums, r["n_cells"], np.int64 if r["wide"] else np.uint32).astype(np.int64))
        if at is not None:
            yield done()

    dealt = parts.repartition(*keys).sortWithinPartitions(*keys)
    return dealt.mapInArrow(run, "stripe int, n_cells long, cells binary, sums binary")


def align(df: DataFrame, a_path: str, b_path: str, stripes: int = 128, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best (links whose pair's count is the highest of its B id), count_sum (of the counts of the
    links' pairs), groups_sha256 (of the groups' ids). One row per row. stripes: more of them need less memory a task."""
    spark = df.sparkSession
    prepare(spark)
    probe = ByteBPE(a_path)
    n_a, width = len(probe.size), -(-Pieces(b_path).n // stripes)
    texts = keyed_text(df, id_col, text_col).select(F.monotonically_increasing_id().alias("row"), "doc_id", "text")

    def run(batches):
        aligner = Aligner(a_path, b_path)
        for batch in batches:
            rows, ids, t = (c.to_pylist() for c in batch.columns)
            if not rows:
                continue
            stats, links = aligner.align(t)
            n_links = np.zeros(len(rows), np.int64)
            for place, a, b in links:
                n_links += np.bincount(place, minlength=len(rows))
                yield _batch(_packed(rows[0], place, a, b, len(rows), n_a, stripes, width))
            yield _batch({"row": rows, "doc_id": ids, "n_a": [s[1] for s in stats], "n_b": [s[2] for s in stats], "n_groups": [s[3] for s in stats], "n_links": n_links, "groups_sha256": [s[0] or "" for s in stats]})

    both = write_table(texts.mapInArrow(run, _SCHEMA), "links")  # rows are numbered one by one inside a task
    links = both.where("stripe IS NOT NULL")
    salts = max(1, -(-int(spark.conf.get("spark.sql.shuffle.partitions")) // stripes))
    parts = links.select("stripe", F.pmod(F.xxhash64("row"), F.lit(salts)).cast("int").alias("salt"), "n_cells", "cells", "sums", F.lit(False).alias("wide"))
    some = _counted(parts, ["stripe", "salt"], width * n_a).withColumn("wide", F.lit(True))
    counts = write_table(_counted(some, ["stripe"], width * n_a), "counts")

    nothing = {k: F.lit(None).cast(_KINDS[k]) for k in ("row", "n_pairs", "pair_cell", "pair_text", "pair_links")}
    first = counts.select("stripe", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("salt"), F.lit(0).alias("kind"), "n_cells", "cells", "sums", *(v.alias(k) for k, v in nothing.items()))
    then = links.select("stripe", F.pmod(F.xxhash64("row"), F.lit(salts)).cast("int").alias("salt"), F.lit(1).alias("kind"), "n_cells", "cells", F.lit(None).cast("binary").alias("sums"), *nothing)

    def score(batches):
        block = np.zeros(width * n_a, np.int64)
        own, highest = np.zeros(0, np.int64), np.zeros(width, np.int64)
        for b in batches:
            for r in _rows(b):
                if r["kind"] == 0:
                    block[own] = 0
                    own = _cells(r)
                    block[own] = _unpack(r["sums"], r["n_cells"], np.int64)
                    highest = block.reshape(width, n_a).max(axis=1)
                    continue
                cell = _cells(r)
                count = block[cell]
                best = count == highest[cell // n_a]
                at = np.cumsum(_unpack(r["pair_cell"], r["n_pairs"], np.uint8), dtype=np.int64)
                text, n = _unpack(r["pair_text"], r["n_pairs"], np.uint32).astype(np.int64), _unpack(r["pair_links"], r["n_pairs"], np.uint32).astype(np.int64)
                used, text = np.unique(text, return_inverse=True)
                n_best, count_sum = np.zeros(len(used), np.int64), np.zeros(len(used), np.int64)
                np.add.at(n_best, text, n * best[at])
                np.add.at(count_sum, text, n * count[at])
                yield pa.RecordBatch.from_arrays([pa.array(used + r["row"]), pa.array(n_best), pa.array(count_sum)], names=["row", "n_best", "count_sum"])

    dealt = first.unionByName(then).repartition("stripe", "salt").sortWithinPartitions("stripe", "salt", "kind")
    sums = dealt.mapInArrow(score, "row long, n_best long, count_sum long").groupBy("row").agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))
    stats = both.where("stripe IS NULL").select(*_STATS).join(sums, "row", "left")
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("long").alias(c)
    out = write_table(stats.select("doc_id", "n_a", "n_b", "n_groups", "n_links", zero("n_best"), zero("count_sum"), "groups_sha256"), "aligned")
    drop_table(both)
    drop_table(counts)
    return out
