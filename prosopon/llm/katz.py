"""Katz backoff: Good-Turing discounted n-gram counts with exactly normalised backoff weights.

A gram of k words is known by its history (its first k - 1 words) and its suffix (its last k - 1). Every pair of words that
training saw is kept, those seen once too.

Model. With counts up to K discounted by Good-Turing (Katz 1987), per order:
    P1(w)        = d1(c(w)) c(w) / N for a known word; the mass that the discounts free is the unknown word's
    Pk(w | x)    = unit(x) dk(c) c        if training saw w after the history x, c times; unit(x) = s(x) / c(x)
                 = alpha(x) Pk-1(w | x')  otherwise, x' being x without its first word; alpha is 1 for an unseen history
    alpha(x)     = (1 - sum of Pk over the words seen after x) / (1 - sum of Pk-1 over them)
s(x) is 1, or c(x) / (c(x) + 1) for a history whose words leave no mass and which could not back off otherwise. A text's first
word has the start as its whole history. Two tables hold the model of an order, both partitioned by the history (`part`):
grams (history, suffix, count, the suffix's lower-order probability) and histories (count, unit, alpha).

Codes. A word or gram that is at least one in HOT of all tokens is hot; there are at most HOT of an order, and every task gets
them. Its code is its place among them; any other has its 64-bit hash, with the highest bit set. Grams are dealt to fragments by
a cold history's code, and by the whole gram where the history is hot, so no frequent word is in one task. A fragment is sized by tokens
and their number is not limited. What goes to a fragment is packed: codes of two bytes or eight, grouped by history.

Evaluation. The recursion log Pk(w | x) - log Pk-1(w | x') is log(unit(x) dk(c) c) - log Pk-1(w | x') for a gram that training saw
and log alpha(x) for any other, so a text's score is the sum of these steps over its tokens and orders. Hot words and hot grams are
answered where the text is; every other step goes to the fragment of its gram, which returns one sum per text. A fragment also
answers for the cold words themselves: each is the history of just one token.

Hashes of 64 bits may collide by chance (one in 2^63 a pair). Defined results: a null text is empty and has the end token only;
without any training text all tokens are unknown and score log10(1) in the model; repeated rows are counted and scored each for
itself; a null doc_id has the remainder of the empty text; an empty table gives an empty table.
"""

from __future__ import annotations

import itertools
import math
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from prosopon.llm.common import crc_mod, keyed_text, prepare
from prosopon.llm.hashing import distinct_words, mix
from prosopon.operators.durable import drop_table, release, write_table

U = np.uint64
START, END = U(0x5BF03635DE1C2A01), U(0x2545F4914F6CDD1D)
K = 5
HOT = 65_000
#: Rows and bytes of one Arrow batch, and bytes and texts that are packed together.
BATCH, BATCH_BYTES, UNIT_BYTES, UNIT_TEXTS = 20_000, 4_000_000, 6_000_000, 60_000
#: Tokens for which there is one fragment in counting, and in scoring (where it holds the model's grams only).
FRAGMENT, LOOKUP = 2_000_000, 6_000_000
#: Folders of a model table.
PARTS = 4

_TYPES = {"int": pa.int32(), "long": pa.int64(), "double": pa.float64(), "boolean": pa.bool_(), "binary": pa.binary()}


def _arrow(df: DataFrame, ddl: str, run) -> DataFrame:
    prepare(df.sparkSession)
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH))
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))

    def lean(batches):
        pa.set_memory_pool(pa.system_memory_pool())  # Arrow's own pools keep what a task has freed
        yield from run(batches)

    return df.mapInArrow(lean, ddl)


def _batch(ddl: str, cols) -> pa.RecordBatch:
    schema = pa.schema([(n, _TYPES[t]) for n, t in (x.split() for x in ddl.split(","))])
    return pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c, type=t.type) for c, t in zip(cols, schema)], schema=schema)


def _rows(batches):
    for b in batches:
        yield from zip(*(c.to_pylist() for c in b.columns))


def _ints(b: pa.RecordBatch, k: int) -> np.ndarray:
    return b.column(k).to_numpy(zero_copy_only=False)


# ---- tokens and grams


def tokens(texts) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of the distinct tokens, the end last; for every token of the texts its place among them; where each text's begin (one more)."""
    h, which, at = distinct_words(texts)
    begin = at + np.arange(len(texts) + 1)
    w = np.full(len(which) + len(texts), len(h), np.int64)
    is_word = np.ones(len(w), bool)
    is_word[begin[1:] - 1] = False
    w[is_word] = which
    return np.append(h, END), w, begin


def _cold(h: np.ndarray) -> np.ndarray:
    """The code of a hash that is not hot: negative."""
    return (h | U(1 << 63)).view(np.int64)


def gram_hash(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Names a gram by the codes of its history and its suffix."""
    return mix(x.view(U) * U(0x9FB21C651E98DF25) + mix(y.view(U) ^ U(0xA0761D6478BD642F)))


@dataclass
class Level:
    """What every task knows of an order: its hot grams by code, and as histories of the next order."""

    hashes: np.ndarray
    count: np.ndarray
    logp: np.ndarray
    #: What the gram adds to a text's score.
    step: np.ndarray
    unit: np.ndarray = field(default_factory=lambda: np.zeros(0))
    alpha: np.ndarray = field(default_factory=lambda: np.zeros(0))

    def code(self, h: np.ndarray) -> np.ndarray:
        at = _found(self.hashes, h)
        return np.where(at >= 0, at, _cold(h))


def _grams(here: np.ndarray, begin: np.ndarray, levels: list[Level]):
    """For order 2 and up: codes of history and suffix, and the token at which the gram ends. here: codes of the tokens; levels: orders
    below."""
    at = (np.arange(len(here)) - np.repeat(begin[:-1], np.diff(begin))).astype(np.int32)
    before = np.empty_like(here)
    before[1:] = here[:-1]
    before[at == 0] = levels[0].code(np.array([START]))[0]
    yield before, here, np.arange(len(here))
    for k, level in enumerate(levels[1:], start=1):
        here = level.code(gram_hash(before, here))  # of the gram that ends at a token
        before = np.empty_like(here)
        before[1:] = here[:-1]
        where = np.flatnonzero(at >= k)
        yield before[where], here[where], where


# ---- packing


def _pressed(*parts: np.ndarray) -> bytes:
    """Arrays of numbers, pressed, with their types and sizes."""
    heads = [f"{p.dtype.str}{p.nbytes:012d}".encode() for p in parts]
    raw = b"".join([*heads, *(p.tobytes() for p in parts)])
    return bytes([len(parts)]) + len(raw).to_bytes(5, "little") + pa.compress(raw, codec="zstd", asbytes=True)


def _parts(blob: bytes) -> list[np.ndarray]:
    raw = pa.decompress(memoryview(blob)[6:], decompressed_size=int.from_bytes(blob[1:6], "little"), codec="zstd", asbytes=True)
    out, at = [], 15 * blob[0]
    for k in range(blob[0]):
        kind, size = np.dtype(raw[15 * k : 15 * k + 3].decode()), int(raw[15 * k + 3 : 15 * k + 15])
        out.append(np.frombuffer(raw, kind, size // kind.itemsize, at))
        at += size
    return out


def _small(x: np.ndarray) -> np.ndarray:
    """In the fewest bytes that hold all the numbers."""
    most = int(x.max()) if len(x) else 0
    return x.astype("|u1" if most < 1 << 8 else "<u2" if most < 1 << 16 else "<u4" if most < 1 << 32 else "<u8")


def _starts(*keys: np.ndarray) -> np.ndarray:
    """Where runs of equal keys begin."""
    new = np.zeros(len(keys[0]), bool)
    new[:1] = True
    for k in keys:
        new[1:] |= k[1:] != k[:-1]
    return np.flatnonzero(new)


def _width(codes: np.ndarray, hot: bool) -> np.ndarray:
    return codes.astype("<u2") if hot else codes.astype("<i8")


def pack(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, bytes]:
    """Codes of histories and suffixes, grouped by history; and the order of the grams in it. The four kinds (history hot or cold,
    suffix hot or cold) stand one after the other."""
    orders, parts = [], []
    for k in range(4):
        ids = np.flatnonzero(((x < 0) == (k > 1)) & ((y < 0) == (k % 2 == 1)))
        ids = ids[np.argsort(x[ids] << 16 | y[ids] if k == 0 else x[ids])]
        xs, ys = x[ids], y[ids]
        at = _starts(xs)
        orders.append(ids)
        parts += [_width(xs[at], k < 2), _small(np.diff(np.append(at, len(xs)))), _width(ys, k % 2 == 0)]
    return np.concatenate(orders), _pressed(*parts)


def unpack(blob: bytes) -> tuple[np.ndarray, np.ndarray]:
    p = _parts(blob)
    x = np.concatenate([np.repeat(p[3 * k].astype(np.int64), p[3 * k + 1]) for k in range(4)])
    return x, np.concatenate([p[3 * k + 2].astype(np.int64) for k in range(4)])


def _place(x: np.ndarray, y: np.ndarray, n: int) -> np.ndarray:
    """The fragment of a gram: by its history if that is cold, by the whole gram otherwise."""
    h = np.where(x < 0, mix(x.view(U)), gram_hash(x, y))
    return (((h >> U(32)) * U(n)) >> U(32)).astype(np.int64)


def _dealt(place: np.ndarray, n: int):
    """(fragment, indices of its items)."""
    order = np.argsort(place.astype("<u2") if n <= 1 << 16 else place, kind="stable")
    at = _starts(place[order])
    for i, j in itertools.pairwise([*at.tolist(), len(place)] if len(place) else ()):
        yield int(place[order[i]]), order[i:j]


def _units(batches):
    """The rows of several batches, joined up to a bounded number of characters and rows."""
    held: list[pa.RecordBatch] = []
    chars = rows = 0
    for b in batches:
        if not b.num_rows:
            continue
        held.append(b)
        chars += b.column(b.num_columns - 1).nbytes
        rows += b.num_rows
        if chars >= UNIT_BYTES or rows + BATCH > UNIT_TEXTS:
            yield pa.Table.from_batches(held)
            held, chars, rows = [], 0, 0
    if held:
        yield pa.Table.from_batches(held)


# ---- counting


def _words(texts: DataFrame) -> DataFrame:
    """Counts of the training tokens by hash."""

    def run(batches):
        for t in _units(batches):
            w, which, _ = tokens(t.column(0))
            c = np.bincount(which, minlength=len(w))
            w, c = w[c > 0], c[c > 0]
            for i in range(0, len(w), 200_000):
                yield _batch("h long, c long", (w[i : i + 200_000].view(np.int64), c[i : i + 200_000]))

    return _arrow(texts, "h long, c long", run).groupBy("h").agg(F.sum("c").alias("c"))


COUNTS = "fragment int, grams binary, counts binary"
#: low: the suffix's lower-order probability, null where it is hot.
GRAMS = "x long, y long, c long, low double"


def _counted(texts: DataFrame, order: int, sent, fragments: int) -> DataFrame:
    """The grams of one order, with their counts."""

    def count(batches):
        for t in _units(batches):
            w, which, begin = tokens(t.column(0))
            x, y, _ = next(itertools.islice(_grams(sent.value[0].code(w)[which], begin, sent.value), order - 2, None))
            sort = np.argsort(gram_hash(x, y))
            x, y = x[sort], y[sort]
            at = _starts(x, y) if len(x) else np.zeros(0, np.int64)
            c = np.diff(np.append(at, len(x)))
            x, y = x[at], y[at]
            out = []
            for f, ids in _dealt(_place(x, y, fragments), fragments):
                sort, blob = pack(x[ids], y[ids])
                out.append((f, blob, _pressed(_small(c[ids][sort]))))
            if out:
                yield _batch(COUNTS, zip(*out))

    def merge(batches):
        low = np.exp(sent.value[-1].logp * math.log(10))
        for _, group in itertools.groupby(_rows(batches), key=lambda r: r[0]):
            parts = [(*unpack(grams), _parts(counts)[0].astype(np.int64)) for _, grams, counts in group]
            x, y, c = (np.concatenate(p) for p in zip(*parts))
            sort = np.argsort(gram_hash(x, y))
            x, y, c = x[sort], y[sort], c[sort]
            at = _starts(x, y)
            x, y, c = x[at], y[at], np.add.reduceat(c, at)
            sort = np.argsort(x)
            x, y, c = x[sort], y[sort], c[sort]
            for i in range(0, len(x), 200_000):
                m = slice(i, i + 200_000)
                hot = y[m] >= 0
                p = np.where(hot, low[np.where(hot, y[m], 0)], 0.0) if len(low) else np.zeros(len(hot))
                yield _batch(GRAMS, (x[m], y[m], c[m], pa.array(p, mask=~hot)))

    dealt = _arrow(texts, COUNTS, count).repartitionById(fragments, F.col("fragment")).sortWithinPartitions("fragment")
    return _arrow(dealt, GRAMS, merge)


def discounts(n: dict[int, int], k: int = K) -> list[float]:
    """Good-Turing factors of the counts 1 to k in Katz' form. n: how many n-grams have a count. Where the counts of counts do not
    give factors above 0 and at most 1 (tiny or odd tables), absolute discounting takes their place."""
    if n.get(1) and all(n.get(r) for r in range(1, k + 2)):
        a = (k + 1) * n[k + 1] / n[1]
        if a < 1:
            d = [((r + 1) * n[r + 1] / (r * n[r]) - a) / (1 - a) for r in range(1, k + 1)]
            if all(0 < x <= 1 for x in d) and d[0] < 1:
                return d
    b = n.get(1, 0) / (n.get(1, 0) + 2 * n.get(2, 0)) if n.get(1) and n.get(2) else 0.5
    return [1 - b / r for r in range(1, k + 1)]


def _factors(grams: DataFrame) -> tuple[dict[int, int], list[float]]:
    n = {r["c"]: r["n"] for r in grams.where(F.col("c") <= K + 1).groupBy("c").agg(F.count("*").alias("n")).collect()}
    return n, discounts(n)


def _discounted(c, d: list[float]):
    """c times its factor, for a Column or an array."""
    if isinstance(c, Column):
        factor = F.lit(1.0)
        for r in range(len(d), 0, -1):
            factor = F.when(c == r, d[r - 1]).otherwise(factor)
        return c * factor
    return c * np.concatenate([[1.0], d, [1.0]])[np.minimum(c, len(d) + 1)]


# ---- the model


def _with_low(grams: DataFrame, lower: DataFrame) -> DataFrame:
    """grams with the lower-order probability of cold suffixes as well. lower: code, p of all cold grams of the order below. No code
    on either side has more than one in HOT of all tokens, so the join has no hot key."""
    cold = grams.where("y < 0").drop("low").join(lower.select(F.col("code").alias("y"), F.col("p").alias("low")), "y").select("x", "y", "c", "low")
    return grams.where("y >= 0").unionByName(cold)


def _stored(df: DataFrame, what: str) -> DataFrame:
    """A model table, partitioned by the history."""
    return write_table(df.withColumn("part", F.pmod(F.xxhash64("x"), F.lit(PARTS)).cast("int")), what, "part")


def _histories(grams: DataFrame, d: list[float]) -> DataFrame:
    """x, total, and the logarithms of unit and alpha. Hot histories are summed before they are shuffled."""
    total, kept, lower = F.col("total"), F.col("kept"), F.col("lower")
    sums = grams.groupBy("x").agg(F.sum("c").alias("total"), F.sum(_discounted(F.col("c"), d)).alias("kept"), F.sum("low").alias("lower"))
    sums = sums.withColumn("s", F.when(kept > total * (1 - 1e-12), total / (total + 1)).otherwise(1.0))
    return sums.select("x", "total", F.log10(F.col("s") / total).alias("unit"), F.log10((1 - F.col("s") * kept / total) / (1 - lower)).alias("alpha"))


def _hot_of(df: DataFrame, *cols: str) -> list[np.ndarray]:
    """Columns of at most HOT rows, or a few more, by the first."""
    got = df.select(*cols).toPandas().sort_values(cols[0])
    return [got[c].to_numpy() for c in cols]


def _below(grams: DataFrame, histories: DataFrame, d: list[float], least: int) -> DataFrame:
    """code, p of the cold grams of this order, for the next one."""
    unit = histories.select("x", "unit")
    hot, cold = unit.where("x >= 0"), unit.where("x < 0")  # at most HOT of the former
    grams = grams.where(F.col("c") < least)
    p = grams.where("x >= 0").join(F.broadcast(hot), "x").unionByName(grams.where("x < 0").join(cold, "x"))
    p = p.select("x", "y", (_discounted(F.col("c"), d) * F.pow(F.lit(10.0), F.col("unit"))).alias("p"))

    def run(batches):
        for b in batches:
            code = _cold(gram_hash(_ints(b, 0), _ints(b, 1)))
            yield pa.RecordBatch.from_arrays([pa.array(code), b.column(2)], names=["code", "p"])

    return _arrow(p, "code long, p double", run)


@dataclass
class Order:
    grams: DataFrame
    histories: DataFrame
    factors: list[float]


@dataclass
class Model:
    levels: list[Level]
    orders: list[Order]
    tokens: int
    types: int
    unknown: float
    #: Factors of the words' counts, and what these are divided by.
    words: tuple[list[float], int]


def train(texts: DataFrame, order: int = 2) -> Model:
    """texts: text. Grams of 1 to `order` words."""
    spark = texts.sparkSession
    words = write_table(_words(texts), "words")
    release(spark)
    n, types, n_texts = words.agg(F.sum("c"), F.count("*"), F.max(F.when(F.col("h") == int(END.view(np.int64)), F.col("c")))).head()
    n, n_texts = n or 0, n_texts or 0
    least = max(1, -(-n // HOT))
    of, d1 = _factors(words)
    freed = sum((1 - d1[r - 1]) * r * of.get(r, 0) for r in range(1, K + 1))
    if n and not freed:  # no rare words at all: the unknown word still needs mass
        mass, unknown = n + 1, math.log10(1 / (n + 1))
    else:
        mass, unknown = max(n, 1), math.log10(freed / n) if n else 0.0
    # The end is always among the hot words, and the start, which no text asks for as a word.
    h, c = _hot_of(words.where((F.col("c") >= least) | (F.col("h") == int(END.view(np.int64)))), "h", "c") if n else (np.zeros(0, np.int64),) * 2
    h, c = np.append(h.astype(np.int64).view(U), START), np.append(c.astype(np.int64), n_texts)
    sort = np.argsort(h)
    h, c = h[sort], c[sort]
    with np.errstate(divide="ignore"):
        logp = np.log10(_discounted(c, d1) / mass)
    levels, orders = [Level(h, c, logp, logp)], []
    p1 = (_discounted(F.col("c"), d1) / float(mass)).alias("p")
    lower = words.where(F.col("c") < least).select(F.col("h").bitwiseOR(F.lit(-(2**63))).alias("code"), p1)
    fragments = max(1, math.ceil(n / FRAGMENT))
    drop = [words]
    for k in range(2, order + 1):
        sent = spark.sparkContext.broadcast(levels)
        counted = write_table(_counted(texts, k, sent, fragments), "counted")
        release(spark)
        grams = _stored(_with_low(counted, lower), "grams")
        for t in [counted, *drop]:
            drop_table(t)
        release(spark)
        _, d = _factors(grams)
        histories = _stored(_histories(grams, d), "histories")
        release(spark)
        below, drop = levels[-1], []
        x, unit, alpha = _hot_of(histories.where("x >= 0"), "x", "unit", "alpha")
        below.unit, below.alpha = np.zeros(len(below.hashes)), np.zeros(len(below.hashes))
        below.unit[x.astype(np.int64)], below.alpha[x.astype(np.int64)] = unit, alpha
        # A gram as frequent as this has a history and a suffix that are hot.
        x, y, c = (v.astype(np.int64) for v in _hot_of(grams.where(F.col("c") >= least).where("x >= 0 AND y >= 0"), "x", "y", "c"))
        h = gram_hash(x, y)
        sort = np.argsort(h)
        x, y, c = x[sort], y[sort], c[sort]
        logp = np.log10(_discounted(c, d)) + below.unit[x]
        levels.append(Level(h[sort], c, logp, logp - below.logp[y]))
        orders.append(Order(grams, histories, d))
        if k < order:
            lower = write_table(_below(grams, histories, d, least), "below")
            release(spark)
            drop = [lower]
    return Model(levels, orders, n, types, unknown, (d1, mass))


# ---- scoring

# unit -1: histories, then grams of the model; otherwise what a unit of texts asks for. fragment -1: the texts' keys.
ASK = "place int, fragment int, unit long, level int, keys binary, more binary"
HEADS = np.dtype([("doc", "<i8"), ("null", "?"), ("held", "?"), ("n", "<i8"), ("known", "<i8"), ("base", "<f8"), ("score", "<f8")])


def _entries(order: Order, level: int, fragments: int) -> DataFrame:
    """The model's rows of an order, packed by fragment. Hot histories are with every task already."""

    def rows(kind):
        def run(batches):
            for t in _tables(batches):
                x = t.column(0).to_numpy()
                out = []
                if kind:
                    y, c, low = (t.column(k).to_numpy() for k in (1, 2, 3))
                    for f, ids in _dealt(_place(x, y, fragments), fragments):
                        sort, blob = pack(x[ids], y[ids])
                        ids = ids[sort]
                        known, which = np.unique(low[ids], return_inverse=True)
                        out.append((f, f, -1, level, blob, _pressed(known, _small(which), _small(c[ids]))))
                else:
                    total, unit, alpha = (t.column(k).to_numpy() for k in (1, 2, 3))
                    for f, ids in _dealt(_place(x, x, fragments), fragments):
                        out.append((f, f, -2, level, _pressed(x[ids], _small(total[ids])), _pressed(unit[ids], alpha[ids])))
                if out:
                    yield _batch(ASK, zip(*out))

        return run

    grams = _arrow(order.grams.select("x", "y", "c", "low"), ASK, rows(1))
    return grams.unionByName(_arrow(order.histories.where("x < 0").select("x", "total", "unit", "alpha"), ASK, rows(0)))


def _tables(batches, most: int = 500_000):
    held, n = [], 0
    for b in batches:
        if b.num_rows:
            held.append(b)
            n += b.num_rows
        if n >= most:
            yield pa.Table.from_batches(held)
            held, n = [], 0
    if held:
        yield pa.Table.from_batches(held)


def _asked(docs: DataFrame, sent, fragments: int) -> DataFrame:
    """What the hot words and grams do not answer. docs: doc_id, held_out, text."""

    def run(batches):
        task = TaskContext.get().partitionId() << 24
        levels = sent.value
        for seq, t in enumerate(_units(batches)):
            unit, m = task + seq, t.num_rows
            w, which, begin = tokens(t.column(2))
            which = which.astype(np.int32)
            owner = np.repeat(np.arange(m, dtype=np.int32), np.diff(begin))
            heads = np.zeros(m, HEADS)
            ids = t.column(0)
            heads["null"], heads["doc"] = ids.is_null().to_numpy(), ids.fill_null(0).to_numpy()
            heads["held"], heads["n"] = t.column(1).to_numpy(), np.diff(begin)
            code = levels[0].code(w)
            hot = code >= 0
            of = lambda v: np.where(hot, v[np.where(hot, code, 0)], 0.0)[which]
            heads["known"] = np.bincount(owner, of((levels[0].count > 0).astype(float)), m)
            heads["base"] = np.bincount(owner, of(np.log10(levels[0].count + 0.5)), m)
            heads["score"] = np.bincount(owner, of(levels[0].logp), m)
            out = []
            for k, (x, y, at) in enumerate(_grams(code[which], begin, levels[:-1]), start=1):
                out += ((f, f, unit, k, *q) for f, q in _questions(x, y, owner[at], levels[k], heads, fragments))
            out.append((unit % fragments, -1, unit, 0, heads.tobytes(), b""))
            yield _batch(ASK, zip(*out))

    return _arrow(docs, ASK, run)


def _questions(x: np.ndarray, y: np.ndarray, who: np.ndarray, level: Level, heads: np.ndarray, fragments: int):
    """Per fragment each gram once, with the texts that have it and how often. Hot grams are answered here."""
    h = gram_hash(x, y)
    sort = np.argsort(h & ~U(0xFFFF) | who.astype(U))  # by gram and text; two grams that stand mixed are asked for in pieces
    # Of all tokens at once there are as few arrays as can be: they are the most that a task holds.
    del h
    x, y, who = x[sort], y[sort], who.astype("<u2")[sort]
    del sort
    at = _starts(x, y, who) if len(x) else np.zeros(0, np.int64)
    times = np.diff(np.append(at, len(x)))
    x, y, who = x[at], y[at], who[at]
    gram = _starts(x, y) if len(x) else at
    texts = np.diff(np.append(gram, len(x)))
    code = level.code(gram_hash(x[gram], y[gram]))
    mine = np.repeat(code, texts)
    hot = np.flatnonzero(mine >= 0)
    heads["score"] += np.bincount(who[hot], level.step[mine[hot]] * times[hot], len(heads))
    del mine, hot
    gram, texts = gram[code < 0], texts[code < 0]
    gx, gy = x[gram], y[gram]
    for f, ids in _dealt(_place(gx, gy, fragments), fragments):
        sort, blob = pack(gx[ids], gy[ids])
        ids = ids[sort]
        n = texts[ids]
        take = np.repeat(gram[ids] - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum())
        yield f, (blob, _pressed(_small(n), who[take].astype("<u2"), _small(times[take])))


SUMS = "unit long, fragment int, rows binary"
SUM = np.dtype([("text", "<u2"), ("known", "<u4"), ("base", "<f8"), ("score", "<f8")])


def _found(keys: np.ndarray, asked: np.ndarray) -> np.ndarray:
    """The place of each value among the sorted keys, or -1. Sorted look-ups keep to the cache."""
    out = np.full(len(asked), -1)
    if len(keys) and len(asked):
        order = np.argsort(asked)
        asked = asked[order]
        at = np.minimum(np.searchsorted(keys, asked), len(keys) - 1)
        hit = keys[at] == asked
        out[order[hit]] = at[hit]
    return out


class _Fragment:
    """The model's rows of one fragment and order."""

    def __init__(self, level: Level, d: list[float]):
        self.level, self.d = level, d
        self.heads: list[tuple] = []
        self.rows: list[tuple] = []
        self.ready = False

    def add(self, kind: int, keys: bytes, more: bytes) -> None:
        if kind == -2:
            self.heads.append((*_parts(keys), *_parts(more)))
        else:
            x, y = unpack(keys)
            low, which, c = _parts(more)
            self.rows.append((gram_hash(x, y), c.astype(np.int64), low[which]))

    def _prepare(self) -> None:
        empty = (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0), np.zeros(0))
        x, total, unit, alpha = (np.concatenate(p) for p in zip(empty, *self.heads))
        sort = np.argsort(x)
        self.x, self.total, self.unit, self.alpha = x[sort], total[sort].astype(np.int64), unit[sort], alpha[sort]
        h, c, low = (np.concatenate(p) for p in zip((np.zeros(0, U), np.zeros(0, np.int64), np.zeros(0)), *self.rows))
        sort = np.argsort(h)
        self.h, self.gain = h[sort], (np.log10(_discounted(c, self.d)) - np.log10(low))[sort]
        self.heads, self.rows, self.ready = [], [], True

    def history(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Logarithms of unit and alpha, and the count; 0 for unseen ones."""
        unit, alpha, total = np.zeros(len(x)), np.zeros(len(x)), np.zeros(len(x), np.int64)
        hot = x >= 0
        unit[hot], alpha[hot] = self.level.unit[x[hot]], self.level.alpha[x[hot]]
        cold = np.flatnonzero(~hot)
        at = _found(self.x, x[cold])
        cold, at = cold[at >= 0], at[at >= 0]
        unit[cold], alpha[cold], total[cold] = self.unit[at], self.alpha[at], self.total[at]
        return unit, alpha, total

    def answer(self, keys: bytes, more: bytes, words, unknown: float) -> np.ndarray:
        """One sum per text. words: log P1 by count, where the histories are words; these are answered for as well."""
        if not self.ready:
            self._prepare()
        x, y = unpack(keys)
        n, who, times = _parts(more)
        run = _starts(x)
        each = np.diff(np.append(run, len(x)))
        unit, alpha, total = (np.repeat(v, each) for v in self.history(x[run]))
        at = _found(self.h, gram_hash(x, y))
        step = np.where(at >= 0, unit + self.gain[at], alpha) if len(self.h) else alpha
        known, base = np.zeros(len(x)), np.zeros(len(x))
        if words is not None:
            cold = x < 0
            seen = cold & (total > 0)
            step = step + np.where(seen, words(np.maximum(total, 1)), np.where(cold, unknown, 0.0))
            known, base = seen.astype(float), np.where(cold, np.log10(total + 0.5), 0.0)
        text = np.flatnonzero(np.bincount(who))
        spread = lambda v: np.bincount(who, np.repeat(v, n) * times)[text]
        out = np.zeros(len(text), SUM)
        out["text"], out["known"], out["base"], out["score"] = text, np.rint(spread(known)), spread(base), spread(step)
        return out


def _answered(asked: DataFrame, sent, factors: list[list[float]], d1: list[float], mass: float, unknown: float, fragments: int) -> DataFrame:
    """For each fragment and unit one sum per text."""

    def words(c):
        return np.log10(_discounted(c, d1) / mass)

    def run(batches):
        for f, group in itertools.groupby(_rows(batches), key=lambda r: r[1]):
            held = {k: _Fragment(level, d) for k, (level, d) in enumerate(zip(sent.value, factors), start=1)}
            for unit, asks in itertools.groupby(group, key=lambda r: r[2]):
                if f < 0:
                    yield _batch(SUMS, ([unit], [-1], [next(asks)[4]]))
                elif unit < 0:
                    for _, _, _, k, keys, more in asks:
                        held[k].add(unit, keys, more)
                else:
                    got = np.concatenate([held[k].answer(keys, more, words if k == 1 else None, unknown) for _, _, _, k, keys, more in asks])
                    yield _batch(SUMS, ([unit], [f], [got.tobytes()]))

    return _arrow(asked.repartitionById(fragments, F.col("place")).sortWithinPartitions("fragment", "unit"), SUMS, run)


SCORES = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"


def _scores(sums: DataFrame, n_tokens: int, n_types: int) -> DataFrame:
    norm = math.log10(n_tokens + 0.5 * (n_types + 1))

    def run(batches):
        for _, group in itertools.groupby(_rows(batches), key=lambda r: r[0]):
            heads = None
            for _, f, rows in group:
                if f < 0:
                    heads = np.frombuffer(rows, HEADS).copy()
                    continue
                x = np.frombuffer(rows, SUM)
                np.add.at(heads["score"], x["text"], x["score"])
                np.add.at(heads["known"], x["text"], x["known"].astype(np.int64))
                np.add.at(heads["base"], x["text"], x["base"])
            doc = pa.array(heads["doc"], mask=heads["null"].copy())
            yield _batch(SCORES, (doc, heads["held"], heads["n"], heads["known"], np.full(len(heads), n_tokens), heads["base"] - heads["n"] * norm, heads["score"]))

    return _arrow(sums.repartition("unit").sortWithinPartitions("unit", "fragment"), SCORES, run)


def lm_score(df: DataFrame, held_out_of: int = 5, held_out: int = 1, order: int = 2, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of df. The model learns from the rows whose crc32(doc_id as text) mod held_out_of is not held_out; order
    (2 or more) is the number of words of its longest grams."""
    if order < 2:
        raise ValueError("a backoff model needs grams of two words at least")
    spark = df.sparkSession
    docs = keyed_text(df, id_col, text_col).withColumn("held_out", crc_mod(F.col("doc_id"), held_out_of) == held_out)
    model = train(docs.where("NOT held_out").select("text"), order)
    fragments = max(1, math.ceil(model.tokens / LOOKUP))
    sent = spark.sparkContext.broadcast(model.levels)
    asked = _asked(docs.select("doc_id", "held_out", "text"), sent, fragments)
    for k, o in enumerate(model.orders, start=1):
        asked = asked.unionByName(_entries(o, k, fragments))
    d1, mass = model.words
    return _scores(_answered(asked, sent, [o.factors for o in model.orders], d1, mass, model.unknown, fragments), model.tokens, model.types)
