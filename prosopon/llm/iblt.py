"""Document fingerprints: invertible Bloom lookup sketches of paragraph digests.

A text is cut into paragraphs (lines, and long lines at sentence marks, so that one-line texts have parts as well). Every
paragraph has a 64-bit digest, tagged with how often the text has had it before, so that repetitions count. A sketch has
rows of cells; each digest is added to one cell of every row: its count, the sum of the digests and the sum of their
checksums. Two sketches of one size are subtracted cell by cell; what both texts share cancels out. Peeling then takes
cells that hold one digest only (count 1 or -1 and a checksum that fits), notes the digest and removes it from its other
cells, until all cells are empty. When it gets stuck, or the difference is not smaller than the sketch, both sides are
sketched anew with four times the cells. The digests recovered give the likeness: 2 * shared / (paragraphs of both). The string
that is returned as fingerprint is the smallest sketch; for most pairs that differ much, likeness comes from larger sketches of the
two texts, as the retry demands. Sketches with more than SPARE cells for each digest that still don't peel (digests that agree by
design in all their cells) are settled by comparing the sorted digests.

All documents of a batch are sketched and peeled together, each in its own range of cells.

Defined results: a null text is empty and has no paragraphs; two texts without paragraphs have likeness 1; equal texts have
equal fingerprints and likeness 1; repeated rows follow one another in the order, ties in doc_id are ordered by the text and
a null doc_id comes last; a table of one row has itself as the next document; an empty table gives an empty table.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from prosopon.llm.common import keyed_text, prepare, utf8

ROWS = 3
#: Cells of each row in the sketch that is the fingerprint.
WIDTH = 8
#: Cells for each digest from which a sketch that does not peel is given up.
SPARE = 16
LONG_LINE = 100
_PART = re.compile(r"(?<=[.!?;,|])\s+|\n+")
_WORDS = re.compile(r"(?:\S+\s*){1,16}")


def paragraphs(text: str) -> list[str]:
    out = []
    for line in text.split("\n"):
        if len(line) <= LONG_LINE:
            if line.strip():
                out.append(line)
            continue
        for part in _PART.split(line):
            if len(part) <= 2 * LONG_LINE:
                if part:
                    out.append(part)
            else:
                out += _WORDS.findall(part)
    return out


def digests(text: str) -> np.ndarray:
    """64-bit digests of the paragraphs, in order; the k-th copy of a paragraph has a digest of its own."""
    seen: dict[str, int] = {}
    out = []
    for p in paragraphs(text):
        k = seen.get(p, 0)
        seen[p] = k + 1
        out.append(xxhash.xxh64_intdigest(utf8(p), k))
    return np.array(out, np.uint64)


def _mix(x: np.ndarray, salt: int) -> np.ndarray:
    """A bijection of 64 bits with good spread."""
    x = x ^ np.uint64((0x9E3779B97F4A7C15 * (salt + 1)) & 0xFFFFFFFFFFFFFFFF)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Sketches:
    """One sketch for each of several texts, ROWS times width cells each."""

    def __init__(self, n: int, width: int):
        self.n, self.width = n, width
        size = n * ROWS * width
        self.count, self.keys, self.checks = np.zeros(size, np.int64), np.zeros(size, np.uint64), np.zeros(size, np.uint64)

    def cells(self, owner: np.ndarray, key: np.ndarray) -> list[np.ndarray]:
        return [(owner * ROWS + r) * self.width + (_mix(key, r) % np.uint64(self.width)).astype(np.int64) for r in range(ROWS)]

    def add(self, owner: np.ndarray, key: np.ndarray, sign) -> None:
        """sign: 1, -1 or an array of them."""
        s = np.broadcast_to(np.asarray(sign, np.int64), key.shape)
        k, c = key * s.astype(np.uint64), _mix(key, 97) * s.astype(np.uint64)
        for at in self.cells(owner, key):
            np.add.at(self.count, at, s)
            np.add.at(self.keys, at, k)
            np.add.at(self.checks, at, c)

    def peel(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """For each text the number of digests that only the first and only the second side has, and whether all were found."""
        first, second = np.zeros(self.n, np.int64), np.zeros(self.n, np.int64)
        per = ROWS * self.width
        todo = np.flatnonzero(np.abs(self.count) == 1)
        while len(todo):
            sign = self.count[todo]
            key = self.keys[todo] * sign.astype(np.uint64)
            ok = (np.abs(sign) == 1) & (self.checks[todo] == _mix(key, 97) * sign.astype(np.uint64))
            at, key, sign = todo[ok], key[ok], sign[ok]
            owner = at // per
            order = np.lexsort((key, owner))  # a digest that is alone in several of its cells counts once
            owner, key, sign = owner[order], key[order], sign[order]
            new = np.ones(len(key), bool)
            new[1:] = (owner[1:] != owner[:-1]) | (key[1:] != key[:-1])
            owner, key, sign = owner[new], key[new], sign[new]
            if not len(key):
                break
            np.add.at(first, owner[sign > 0], 1)
            np.add.at(second, owner[sign < 0], 1)
            self.add(owner, key, -sign)
            todo = np.unique(np.concatenate(self.cells(owner, key)))
            todo = todo[np.abs(self.count[todo]) == 1]
        left = ((self.count != 0) | (self.keys != 0) | (self.checks != 0)).reshape(self.n, per).any(1)
        return first, second, ~left


def fingerprints(parts: list[np.ndarray], width: int = WIDTH) -> list[str]:
    """Each sketch in hex, with the number of paragraphs in front."""
    s = Sketches(len(parts), width)
    n = [len(p) for p in parts]
    s.add(np.repeat(np.arange(len(parts)), n), np.concatenate([*parts, np.zeros(0, np.uint64)]), 1)
    raw = np.stack([s.count.astype(np.uint64), s.keys, s.checks], 1).reshape(len(parts), -1) if parts else []
    return [f"{k:x}:{r.astype('>u8').tobytes().hex()}" for k, r in zip(n, raw)]


def differences(a: list[np.ndarray], b: list[np.ndarray], width: int = WIDTH) -> tuple[np.ndarray, np.ndarray]:
    """For each pair the number of digests of a that b lacks and the other way about, by subtracting and peeling."""
    first, second = np.zeros(len(a), np.int64), np.zeros(len(a), np.int64)
    todo = np.arange(len(a))
    sizes = np.array([len(x) + len(y) for x, y in zip(a, b)], np.int64)
    while len(todo):
        for i in todo[width > SPARE * sizes[todo] + 64]:
            x, y = Counter(a[i].tolist()), Counter(b[i].tolist())
            first[i], second[i] = (x - y).total(), (y - x).total()
        todo = todo[width <= SPARE * sizes[todo] + 64]
        stuck = [todo[:0]]
        for k in range(0, len(todo), max(1, 2_000_000 // (ROWS * width))):  # bounded cells at a time
            ids = todo[k : k + max(1, 2_000_000 // (ROWS * width))]
            s = Sketches(len(ids), width)
            for side, sign in ((a, 1), (b, -1)):
                got = [side[i] for i in ids]
                s.add(np.repeat(np.arange(len(ids)), [len(x) for x in got]), np.concatenate([*got, np.zeros(0, np.uint64)]), sign)
            x, y, ok = s.peel()
            first[ids[ok]], second[ids[ok]] = x[ok], y[ok]
            stuck.append(ids[~ok])
        todo, width = np.concatenate(stuck), width * 4
    return first, second


def likeness(a: list[np.ndarray], b: list[np.ndarray]) -> list[float]:
    x, y = differences(a, b)
    na, nb = np.array([len(p) for p in a]), np.array([len(p) for p in b])
    both = na + nb
    return np.where(both == 0, 1.0, (both - x - y) / np.maximum(both, 1)).tolist()


def edited(text: str, other: str) -> str:
    half = len(text) // 2
    return text[: len(text) - half] + other[:half]


SCHEMA = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def with_next(docs: DataFrame, rows_per_block: int = 1024) -> DataFrame:
    """Rows (block, guest, doc_id, text), partitioned by block and sorted so that the row below is the next document: doc_id
    descends inside a block, and below it stands, as a guest, the first document of the next block that has rows (below the
    last block that of the first). The bounds of the blocks are quantiles of doc_id; they and the first keys of the blocks,
    at most 10,000, are all that comes to the driver."""
    blocks = max(1, min(10_000, docs.count() // rows_per_block))
    cuts = docs.agg(F.percentile_approx("doc_id", [k / blocks for k in range(1, blocks)], 100_000).alias("q")).head()["q"] if blocks > 1 else []
    cuts = sorted({int(q) for q in cuts or []})
    spark = docs.sparkSession
    # Descending: block 0 holds the largest keys; null keys are in the last one.
    above = spark.sparkContext.broadcast(np.array(cuts, np.int64))

    def start(batches):
        for b in batches:
            ids = b.column(0).to_numpy(zero_copy_only=False)
            null = b.column(0).is_null().to_numpy(zero_copy_only=False)
            k = len(above.value) - np.searchsorted(above.value, np.where(null, 0, ids).astype(np.int64), side="left")
            yield pa.RecordBatch.from_arrays([pa.array(np.where(null, len(above.value), k).astype(np.int32)), b.column(0), b.column(1)], names=["block", "doc_id", "text"])

    prepare(spark)
    low = F.coalesce("doc_id", F.lit(-(2**63)))
    placed = lambda d, more: d.mapInArrow(start, StructType.fromDDL(f"block int, doc_id long{more}"))
    tops = sorted((r["block"], r["top"]) for r in placed(docs.select("doc_id", F.lit(0).alias("x")), ", text int").groupBy("block").agg(F.max(low).alias("top")).collect())
    guests = [(top, tops[k - 1][0]) for k, (_, top) in enumerate(tops)]  # a block's first document also ends the block before
    guest = F.broadcast(spark.createDataFrame(guests, "top long, host int"))
    both = placed(docs, ", text string").join(guest, low == F.col("top"), "left")
    own, out = F.struct("block", F.lit(False).alias("guest")), F.struct(F.col("host").alias("block"), F.lit(True).alias("guest"))
    at = F.explode(F.when(F.col("host").isNull(), F.array(own)).otherwise(F.array(own, out)))
    return both.select(at.alias("at"), "doc_id", "text").select("at.block", "at.guest", "doc_id", "text").repartition("block").sortWithinPartitions("block", "guest", F.desc_nulls_last("doc_id"), "text")


def compare(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprints of every row's text and of its edited text, and the likeness to that and to the next document."""
    schema = StructType.fromDDL(SCHEMA)
    arrow = to_arrow_schema(schema)

    def run(batches):
        rows: list[tuple] = []  # the last one waits for the row below

        def done():
            here = [k for k, r in enumerate(rows[:-1]) if not r[1]]
            if not here:
                return None
            own = {k: digests(rows[k][3]) for k in {x for k in here for x in (k, k + 1)}}
            texts = [edited(rows[k][3], rows[k + 1][3]) for k in here]
            mine, after, new = [own[k] for k in here], [own[k + 1] for k in here], [digests(t) for t in texts]
            cols = (
                [rows[k][2] for k in here], [len(rows[k][3]) for k in here], [hashlib.sha256(utf8(t)).hexdigest() for t in texts],
                fingerprints(mine), fingerprints(new), likeness(mine, new), likeness(mine, after),
            )
            return pa.RecordBatch.from_arrays([pa.array(c, type=t.type) for c, t in zip(cols, arrow)], schema=arrow)

        for b in batches:
            rows += zip(*(c.to_pylist() for c in b.columns))
            if (out := done()) is not None:
                yield out
            rows = rows[-1:]

    return with_next(keyed_text(df, id_col, text_col)).mapInArrow(run, schema)
