"""N-gram Jaccard join with vertical partitioning.

The n-grams (word shingles) of all texts have one global order: by fragment (a range of their hashes), and for the choice of
prefixes by document frequency and hash. The order is cut into its fragments; every task of a fragment sees all that the
texts have of it, so it knows the document frequencies there. What it returns to the texts is summed per text: how many of
its n-grams nobody else has, and the others with their frequencies.

A pair of texts whose sets overlap enough must share its first common n-gram within both prefixes (of n - min_overlap + 1
n-grams, rarest first). N-grams that only one text has fill places of the prefix without making candidates, so copies with
many changes of their own make none. Of two texts that meet in an n-gram at places i and j, at most n_a - i and n_b - j
n-grams can be common; pairs for which that is too few go.

Candidates are settled in two passes. First every text is compared with one leader, and the links found are closed to
components; then all pairs that meet and are still in different components are compared, so no link between them is lost,
and a group of m copies costs about m comparisons rather than m squared. A comparison counts the partial overlaps of the two
sets fragment by fragment, and sums them per pair.

Texts with equal sets are one node from the start. Defined results: a null or empty text (no words) has 0 shingles, links
with nothing and is its own component; fewer words than n make one shingle; repeated rows and ties are one node; a row with a
null doc_id has a null component; an empty table gives an empty table.
"""

from __future__ import annotations

import itertools

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from prosopon.llm.common import keyed_text, prepare
from prosopon.llm.hashing import shingle_sets
from prosopon.operators.components import connected_components
from prosopon.operators.durable import drop_table, release, write_table

U = np.uint64
#: Shingles that one fragment has on average, at most.
FRAGMENT = 1_500_000
#: Fragments in which the two sets of a candidate pair are compared.
PARTS = 4
#: Texts in the sample that finds very common shingles, and the share of it from which one is that.
SAMPLE, COMMON = 2000, 0.02
#: Rows of one shingle that are compared in one task, at most about; and from which they are not brought together for their leader.
BLOCK, MANY = 4096, 256
#: Rows of 64 bits each, at most, in the table that tells most of the texts whose sets are not needed.
SLOTS = 1 << 18
MAYBE = "maybe_among_ids"


def _arrow(df: DataFrame, ddl: str, run) -> DataFrame:
    prepare(df.sparkSession)
    return df.mapInArrow(run, StructType.fromDDL(ddl))


def _rows(batches):
    """Tuples of Python values."""
    for b in batches:
        yield from zip(*(c.to_pylist() for c in b.columns))


_TYPES = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary()}


def _batch(ddl: str, cols) -> pa.RecordBatch:
    schema = pa.schema([(name, _TYPES[kind]) for name, kind in (x.split() for x in ddl.split(","))])
    return pa.RecordBatch.from_arrays([pa.array(c, type=t.type) for c, t in zip(cols, schema)], schema=schema)


def _steps(text: np.ndarray, ends) -> tuple[np.ndarray, np.ndarray]:
    """The ascending text numbers of each group, one byte each however many groups there are: the step from the one before, and 255 for
    255 further without a text. ends: where each group begins (one more). Bytes, and where each group's begin."""
    ends = np.asarray(ends)
    step = np.diff(text, prepend=0)
    first = ends[:-1][ends[:-1] < ends[1:]]
    step[first] = text[first]
    far, near = np.divmod(step, 255)
    at = np.arange(len(text)) + np.cumsum(far)
    out = np.full(len(text) + int(far.sum()), 255, np.uint8)
    out[at] = near
    return out, np.concatenate([[0], at + 1])[ends]


def _texts(steps: bytes) -> np.ndarray:
    """The text numbers of one group of _steps()."""
    x = np.frombuffer(steps, np.uint8)
    return np.cumsum(x, dtype=np.int64)[x < 255]


# fragment < 0: what goes on to the batch unchanged (the texts' keys). place: where the row is dealt to.
CUT = "place int, fragment int, batch long, docs binary, items binary"
HEADS = np.dtype([("doc", "<i8"), ("node", "<i8"), ("n", "<i4"), ("parity", "V64")])
HOT = np.dtype([("text", "<u2"), ("item", "<i8")])


def _common(docs: DataFrame, words: int) -> np.ndarray:
    """Hashes of shingles that a bounded sample of the texts shows to be very common. They come last in the order without being
    counted, so that no fragment gets a row from every text for them; which ones they are does not change any result."""
    n = docs.count()
    few = docs.where(F.pmod(F.xxhash64("doc_id"), F.lit(max(1, n))) < SAMPLE).select("text")

    def run(batches):
        for b in batches:
            yield _batch("item long", [shingle_sets(b.column(0), words)[0].view(np.int64)])

    least = max(20, int(COMMON * min(n, SAMPLE)))
    got = _arrow(few, "item long", run).groupBy("item").count().where(F.col("count") >= least).select("item").collect()
    return np.sort(np.array([r["item"] for r in got], np.int64).view(U))


def _digest(shingles: np.ndarray) -> int:
    """Names a node: texts with equal sets have equal ones."""
    return xxhash.xxh3_64_intdigest(shingles.tobytes()) - (1 << 63)


def _parity(shingles: np.ndarray, who: np.ndarray, m: int) -> np.ndarray:
    """For each text the parities of its shingles in 512 cells. Two sets differ in at least as many shingles as parities."""
    odd = np.bincount(who * 512 + (shingles & U(511)).astype(np.int64), minlength=512 * m) & 1
    return np.packbits(odd.astype(np.uint8).reshape(m, 512), axis=1).view("V64").reshape(-1)


def _cut(docs: DataFrame, words: int, bits: int, common) -> DataFrame:
    """For each batch of texts: its keys, and its shingles by fragment (docs: the steps of their texts; items: 32 bits each)."""

    def run(batches):
        task = TaskContext.get().partitionId() << 24
        for seq, b in enumerate(x for x in batches if x.num_rows):
            s, at = shingle_sets(b.column(1), words)
            n = np.diff(at)
            heads = np.zeros(len(n), HEADS)
            heads["doc"], heads["n"] = b.column(0).to_numpy(zero_copy_only=False), n
            heads["node"] = [_digest(s[i:j]) for i, j in itertools.pairwise(at)]
            frag = (s >> U(64 - bits)).astype(np.int64)
            who = np.repeat(np.arange(len(n)), n)
            heads["parity"] = _parity(s, who, len(n))
            every = np.isin(s, common.value)
            hot = np.zeros(int(every.sum()), HOT)
            hot["text"], hot["item"] = who[every], (frag[every] << 32) | ((s[every] >> U(32 - bits)) & U(0xFFFFFFFF)).astype(np.int64)
            yield _batch(CUT, ([(task + seq) % (1 << bits)], [-1], [task + seq], [heads.tobytes()], [hot.tobytes()]))
            s, frag, who = s[~every], frag[~every], who[~every]
            order = np.argsort(frag, kind="stable")  # by fragment, text, hash
            frag, who, low = frag[order], who[order], ((s >> U(32 - bits)) & U(0xFFFFFFFF)).astype(np.uint32)[order]
            ends = np.searchsorted(frag, np.arange((1 << bits) + 1))
            steps, begin = _steps(who, ends)
            low = low.astype("<u4", copy=False)
            out = []
            for f in range(1 << bits):
                if ends[f] < ends[f + 1]:
                    out.append((f, f, task + seq, steps[begin[f] : begin[f + 1]].tobytes(), low[ends[f] : ends[f + 1]].tobytes()))
            if out:
                yield _batch(CUT, zip(*out))

    return _arrow(docs, CUT, run)


# singles: the steps of the texts of shingles that no other text has; texts: those of the shared ones.
SEEN = "batch long, fragment int, singles binary, texts binary, shared binary"
SHARED = np.dtype([("rank", "u1"), ("item", "<u4")])


def _frequencies(cut: DataFrame, bits: int) -> DataFrame:
    """For each fragment and batch: whose shingles no other text has, and the others with their frequency's rank."""

    def run(batches):
        for f, group in itertools.groupby(_rows(batches), key=lambda r: r[1]):
            if f < 0:
                for r in group:
                    yield _batch(SEEN, ([r[2]], [-1], [r[3]], [b""], [r[4]]))
                continue
            rows = list(group)
            items = np.concatenate([np.frombuffer(r[4], "<u4") for r in rows])
            _, where, df = np.unique(items, return_inverse=True, return_counts=True)
            rank = np.where(df == 1, 0, np.minimum(254, 1 + np.floor(4 * np.log2(df)))).astype(np.uint8)[where]
            done = 0
            for r in rows:
                n = len(r[4]) // 4
                rk, it = rank[done : done + n], items[done : done + n]
                done += n
                text, more = _texts(r[3]), rk > 0
                shared = np.zeros(int(more.sum()), SHARED)
                shared["rank"], shared["item"] = rk[more], it[more]
                singles, texts = (_steps(x, [0, len(x)])[0].tobytes() for x in (text[~more], text[more]))
                yield _batch(SEEN, ([r[2]], [f], [singles], [texts], [shared.tobytes()]))

    return _arrow(cut.repartition(1 << bits, "place").sortWithinPartitions("fragment", "batch"), SEEN, run)


# kind 0: a text (doc_id, node, n, parity); kind 1: a shingle of a node's prefix (item, place).
FOUND = "kind int, doc_id long, node long, n int, item long, place int, parity binary"


def _prefixes(seen: DataFrame, percent: int) -> DataFrame:
    def run(batches):
        for _, group in itertools.groupby(_rows(batches), key=lambda r: r[0]):
            rows = list(group)
            heads = np.concatenate([np.frombuffer(r[2], HEADS) for r in rows if r[1] < 0])
            hot = np.concatenate([np.frombuffer(r[4], HOT) for r in rows if r[1] < 0])
            m = len(heads)
            zero = np.zeros(m, np.int32)
            yield _batch(FOUND, (zero, heads["doc"], heads["node"], heads["n"], zero, zero, [x.tobytes() for x in heads["parity"]]))
            alone = np.zeros(m, np.int64)
            parts = [np.zeros(0, SHARED)]
            owners = [np.zeros(0, np.int64)]
            frags = [np.zeros(0, np.int64)]
            for _, f, singles, texts, shared in rows:
                if f >= 0:
                    np.add.at(alone, _texts(singles), 1)
                    parts.append(np.frombuffer(shared, SHARED))
                    owners.append(_texts(texts))
                    frags.append(np.full(len(parts[-1]), f, np.int64))
            p, f = np.concatenate(parts), np.concatenate(frags)
            text, item = np.concatenate([*owners, hot["text"].astype(np.int64)]), np.concatenate([(f << 32) | p["item"].astype(np.int64), hot["item"]])
            rank = np.concatenate([p["rank"], np.full(len(hot), 255, np.uint8)])
            order = np.lexsort((item, rank, text))
            text, item = text[order], item[order]
            begin = np.searchsorted(text, np.arange(m))
            place = alone[text] + np.arange(len(text)) - begin[text]
            n = heads["n"].astype(np.int64)
            most = n - (percent * n + 99) // 100  # of a text's shingles, those that its partner may lack
            use = place <= most[text]
            text, item, place = text[use], item[use], place[use]
            yield _batch(FOUND, (np.ones(len(text), np.int32), heads["doc"][text], heads["node"][text], heads["n"][text], item, place.astype(np.int32), [None] * len(text)))

    return _arrow(seen.repartition("batch").sortWithinPartitions("batch", "fragment"), FOUND, run)


def _enough(na, i, nb, j, percent: int):
    """Whether texts of na and nb shingles that first meet at places i and j can link."""
    most = np.minimum(np.minimum(na - i, nb - j), np.minimum(na, nb))
    return 100 * most >= percent * (na + nb - most)


RUN = "item long, node long, n int, place int"
PAIR = "a long, b long, na int, nb int"


ORDER = ("item", "place", "n", "node")


def _ordered(rows: DataFrame) -> DataFrame:
    """Dealt out by ranges of the whole order, so that a shingle that very many nodes have is spread over several tasks."""
    return rows.repartitionByRange(*ORDER).sortWithinPartitions(*ORDER)


def _meeting(found: DataFrame) -> DataFrame:
    """The prefix rows of shingles that several nodes have in their prefixes, once per node. Equal sets have equal places. The first and
    the last shingle of a task may go on in the next one, so their rows stay in any case."""

    def run(batches):
        rest = first = None  # the last row, and whether another node of its item came before
        for b in batches:
            cols = [c.to_numpy(zero_copy_only=False) for c in b.columns]
            if not len(cols[0]):
                continue
            before = False
            if rest is not None:
                cols, before = [np.concatenate([x, y]) for x, y in zip(rest[0], cols)], rest[1]
            item = cols[0]
            first = item[0] if first is None else first
            same = item[1:] == item[:-1]
            met = np.concatenate([[before], same]) | (item == first)
            met[:-1] |= same
            yield _batch(RUN, [c[:-1][met[:-1]] for c in cols])
            rest = [c[-1:] for c in cols], bool(met[-1])
        if rest is not None:
            yield _batch(RUN, rest[0])

    # Copies of a text have the same rows; they are made one before they are dealt out.
    rows = found.where("kind = 1").select("item", "node", "n", "place").distinct()
    return _arrow(_ordered(rows), RUN, run)


def _stars(meeting: DataFrame, percent: int) -> DataFrame:
    """For every node one partner: the leader that it meets most often. The first node by place leads those of an item. Items that many
    nodes have are compared with their leader wherever their rows are; the rows of any other item are dealt to one task."""

    def run(batches):
        lead = None  # item, node, n, place of the current item's first row
        for b in batches:
            cols = [c.to_numpy(zero_copy_only=False).astype(np.int64) for c in b.columns]
            if not len(cols[0]):
                continue
            if lead is not None:
                cols = [np.concatenate([x, y]) for x, y in zip(lead, cols)]
            item, node, n, place = cols
            first = np.flatnonzero(np.concatenate([[True], item[1:] != item[:-1]]))
            at = np.repeat(first, np.diff(np.append(first, len(item))))
            k = np.flatnonzero((node != node[at]) & _enough(n[at], place[at], n, place, percent))
            yield _batch(PAIR, (node[at[k]], node[k], n[at[k]].astype(np.int32), n[k].astype(np.int32)))
            lead = [c[first[-1:]] for c in cols]

    leads = meeting.groupBy("item").agg(F.count("*").alias("rows"), F.min(F.struct("place", "n", "node")).alias("lead"))
    many = write_table(leads.where(F.col("rows") >= MANY).select("item", "lead"), "leads")
    few = meeting.join(many.select("item"), "item", "left_anti")
    apart = _arrow(few.repartition("item").sortWithinPartitions(*ORDER), PAIR, run)
    most = F.least(F.col("lead.n") - F.col("lead.place"), F.col("n") - F.col("place"), F.col("lead.n"), F.col("n"))
    spread = meeting.join(many, "item").where(F.col("node") != F.col("lead.node")).where(100 * most >= percent * (F.col("lead.n") + F.col("n") - most))
    pairs = apart.unionByName(spread.select(F.col("lead.node").alias("a"), F.col("node").alias("b"), F.col("lead.n").alias("na"), F.col("n").alias("nb")))
    counted = pairs.groupBy("a", "b", "na", "nb").agg(F.count("*").alias("times"))
    return counted.groupBy("b", "nb").agg(F.max_by(F.struct("a", "na"), F.struct("times", "a")).alias("x")).select("x.a", "b", "x.na", "nb")


def _blocks(batches):
    """Arrays node, n, place, component, chunk, and whether all chunks are one, of each block; rows are sorted by item, low, high."""
    rest: list[list[np.ndarray]] = []
    done = lambda: [np.concatenate(c) for c in zip(*rest)]
    for b in batches:
        cols = [c.to_numpy(zero_copy_only=False) for c in b.columns]
        if not len(cols[0]):
            continue
        edge = np.flatnonzero((np.diff(cols[0]) != 0) | (np.diff(cols[1]) != 0) | (np.diff(cols[2]) != 0)) + 1
        for i, j in itertools.pairwise([0, *edge.tolist(), len(cols[0])]):
            piece = [c[i:j] for c in cols]
            if rest and any(rest[0][k][0] != piece[k][0] for k in range(3)):
                yield done()
                rest = []
            rest.append(piece)
    if rest:
        yield done()


def _across(meeting: DataFrame, percent: int) -> DataFrame:
    """All pairs that meet, are in different components and can link. meeting: also component and parity; sets whose parities differ
    in more cells than linked sets differ in shingles cannot link. The rows of a shingle are dealt to
    chunks of bounded size, and every two chunks meet in a block of their own."""
    mixed = meeting.groupBy("item").agg(F.min("component").alias("lo"), F.max("component").alias("hi"), F.count("*").alias("rows")).where("lo < hi")
    dealt = meeting.join(mixed.select("item", F.ceil(F.col("rows") / BLOCK).cast("int").alias("chunks")), "item")
    dealt = dealt.withColumn("chunk", F.pmod(F.xxhash64("node"), F.col("chunks")).cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
    cells = dealt.select("item", F.least("chunk", "other").alias("low"), F.greatest("chunk", "other").alias("high"), "node", "n", "place", "component", "chunk", "parity")

    def run(batches):
        for _, low, high, node, n, place, comp, chunk, parity in _blocks(batches):
            n = n.astype(np.int64)
            cells = np.frombuffer(b"".join(parity), "<u8").reshape(len(node), 8)
            for i in range(0, len(node), 256):
                m = slice(i, i + 256)
                ok = (comp[m, None] != comp[None, i:]) & _enough(n[m, None], place[m, None], n[None, i:], place[None, i:], percent)
                ok &= np.arange(i, min(i + 256, len(node)))[:, None] < np.arange(i, len(node))[None, :]
                if low[0] != high[0]:
                    ok &= chunk[m, None] != chunk[None, i:]
                x, y = np.nonzero(ok)
                x, y = x + i, y + i
                differ = np.concatenate([np.zeros(0, np.int64), *(np.bitwise_count(cells[x[k : k + 100_000]] ^ cells[y[k : k + 100_000]]).sum(1, dtype=np.int64) for k in range(0, len(x), 100_000))])
                close = (100 + percent) * differ <= (100 - percent) * (n[x] + n[y])
                x, y = x[close], y[close]
                swap = node[x] > node[y]
                x, y = np.where(swap, y, x), np.where(swap, x, y)
                for k in range(0, len(x), 100_000):
                    xs, ys = x[k : k + 100_000], y[k : k + 100_000]
                    yield _batch(PAIR, (node[xs], node[ys], n[xs].astype(np.int32), n[ys].astype(np.int32)))

    return _arrow(cells.repartition("item", "low", "high").sortWithinPartitions("item", "low", "high", "place", "n", "node"), PAIR, run).distinct()


SET = "node long, part int, items binary"


def _marked(rows: DataFrame, ids: DataFrame) -> DataFrame:
    """rows and a boolean MAYBE: true where doc_id is among ids, and for few others, which share a bit with one of them. The bits come as
    a broadcast table of at most SLOTS rows, so that the other texts need not be shuffled to the join that decides."""
    key, bits = F.xxhash64(F.col("doc_id").cast("long")), "bits_of_ids"
    bit = F.expr("shiftleft(1L, cast(shiftrightunsigned(xxhash64(cast(doc_id AS long)), 58) AS int))")
    slot = F.pmod(key, F.lit(SLOTS)).alias("slot_of_id")
    known = ids.groupBy(slot).agg(F.bit_or(bit).alias(bits))
    found = rows.select("*", slot).join(F.broadcast(known), "slot_of_id", "left")
    return found.select(*rows.columns, F.coalesce(F.col(bits).bitwiseAND(bit) != 0, F.lit(False)).alias(MAYBE))


def _sets(texts: DataFrame, words: int) -> DataFrame:
    """texts: node, text. The sets in PARTS fragments of the hash range."""

    def run(batches):
        for b in batches:
            if b.num_rows:
                nodes = b.column(0).to_pylist()
                s, at = shingle_sets(b.column(1), words)
                part = (s >> U(62)).astype(np.int64)
                out = []
                for k, (i, j) in enumerate(itertools.pairwise(at)):
                    if _digest(s[i:j]) != nodes[k]:  # another text of the same doc_id
                        continue
                    cuts = i + np.searchsorted(part[i:j], np.arange(PARTS + 1))
                    out += [(nodes[k], p, s[x:y].tobytes()) for p, (x, y) in enumerate(itertools.pairwise(cuts)) if x < y]
                yield _batch(SET, zip(*out) if out else ([], [], []))

    return _arrow(texts, SET, run)


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs that link: partial overlaps are counted in each fragment and summed per pair."""

    def run(batches):
        for b in batches:
            if b.num_rows:
                left, right = b.column(2).to_pylist(), b.column(3).to_pylist()
                same = [len(np.intersect1d(np.frombuffer(x, "<u8"), np.frombuffer(y, "<u8"), assume_unique=True)) for x, y in zip(left, right)]
                yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), b.column(4), b.column(5), pa.array(same, pa.int32())], names=["a", "b", "na", "nb", "same"])

    side = lambda c: sets.select(F.col("node").alias(c), "part", F.col("items").alias(f"items_{c}"))
    parts = pairs.withColumn("part", F.explode(F.array(*map(F.lit, range(PARTS)))))
    both = parts.join(side("a"), ["a", "part"]).join(side("b"), ["b", "part"]).select("a", "b", "items_a", "items_b", "na", "nb")
    overlap = _arrow(both, "a long, b long, na int, nb int, same int", run).groupBy("a", "b", "na", "nb").agg(F.sum("same").alias("same"))
    return overlap.where(100 * F.col("same") >= percent * (F.col("na") + F.col("nb") - F.col("same"))).select("a", "b")


def _classes(docs: DataFrame, words: int, percent: int) -> DataFrame:
    """doc_id, node (names the set), n, component_id for every row of docs (doc_id, text) that has a doc_id."""
    spark = docs.sparkSession
    keyed = docs.where("doc_id IS NOT NULL")
    size = docs.agg(F.sum(F.length("text"))).head()[0] or 0
    bits = max(1, int(np.ceil(np.log2(max(1, size / 6 / FRAGMENT)))))
    common = spark.sparkContext.broadcast(_common(keyed, words))
    found = write_table(_prefixes(_frequencies(_cut(keyed, words, bits, common), bits), percent), "prefixes", tidy=True)
    texts = found.where("kind = 0").select("doc_id", "node", "n")
    meeting = write_table(_meeting(found), "meeting", tidy=True)
    # One text of each node that meets another.
    need = meeting.select("node").distinct()
    chosen = write_table(texts.where("n > 0").groupBy("node").agg(F.min("doc_id").alias("doc_id")).join(need, "node"), "chosen", tidy=True)
    sets = write_table(_sets(_marked(keyed, chosen).where(MAYBE).join(chosen, "doc_id").select("node", "text"), words), "sets", tidy=True)
    links = write_table(_verified(_stars(meeting, percent), sets, percent), "links", tidy=True)
    component = connected_components(links)
    parity = found.where("kind = 0").groupBy("node").agg(F.min("parity").alias("parity"))
    named = meeting.join(component, "node", "left").withColumn("component", F.coalesce("component", "node")).join(parity, "node")
    more = write_table(_verified(_across(named, percent), sets, percent), "links", tidy=True)
    release(spark)
    if more.head(1):
        component = connected_components(links.unionByName(more))
    labelled = texts.join(component, "node", "left").withColumn("component", F.coalesce("component", "node"))
    smallest = labelled.where("n > 0").groupBy("component").agg(F.min("doc_id").alias("smallest"))
    out = labelled.join(smallest, "component", "left").select("doc_id", "node", "n", F.when(F.col("n") > 0, F.col("smallest")).otherwise(F.col("doc_id")).alias("component_id"))
    out = write_table(out, "classes", tidy=True)
    for t in (found, sets, chosen, meeting, links, more):
        drop_table(t)
    return out


def join(df: DataFrame, words: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_shingles, component_id (smallest doc_id that links reach) for every row. Texts link when
    100 * intersection >= percent * union of their sets of word shingles."""
    docs = keyed_text(df, id_col, text_col)
    out = _classes(docs, words, percent).select("doc_id", F.col("n").cast("long").alias("n_shingles"), "component_id")
    return out.unionByName(_counted(docs.where("doc_id IS NULL"), words))


def _counted(docs: DataFrame, words: int) -> DataFrame:
    def run(batches):
        for b in batches:
            n = np.diff(shingle_sets(b.column(1), words)[1])
            yield _batch("doc_id long, n_shingles long, component_id long", ([None] * len(n), n, [None] * len(n)))

    return _arrow(docs, "doc_id long, n_shingles long, component_id long", run)


def _with_node(df: DataFrame, words: int) -> DataFrame:
    """df (doc_id, text and a struct) and the name of each text's set, in a column `node`."""
    names = df.columns

    def run(batches):
        for b in batches:
            s, at = shingle_sets(b.column("text").fill_null(""), words)
            node = pa.array([_digest(s[i:j]) for i, j in itertools.pairwise(at)], pa.int64())
            yield pa.RecordBatch.from_arrays([*b.columns, node], names=[*names, "node"])

    prepare(df.sparkSession)
    return df.mapInArrow(run, StructType([*df.schema.fields, StructField("node", LongType())]))


def one_of_each(df: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """One row of each group of linked documents: that with the smallest doc_id. Rows that share their doc_id count each by its own
    text; of those with the same doc_id and the same set the smallest, by all columns in order, stays. Rows without words link with
    nothing; rows with a null doc_id stay. Returns the columns of df."""
    classes = _classes(keyed_text(df), words, percent)
    per = classes.groupBy("doc_id").agg(F.count("*").alias("times"), F.min("component_id").alias("component_id"))
    gone = write_table(per.where("times > 1 OR component_id <> doc_id").select("doc_id"), "gone", tidy=True)
    marked = _marked(df, gone)
    out = marked.where(~F.col(MAYBE)).unionByName(marked.where(MAYBE).join(gone, "doc_id", "left_anti").select(marked.columns)).select(df.columns)
    again = per.where("times > 1").select("doc_id")
    if not again.head(1):
        return out
    rest = "rest_of_row"
    rows = _with_node(df.join(again, "doc_id", "left_semi").select("doc_id", "text", F.struct(*df.columns).alias(rest)), words)
    stay = classes.where("component_id = doc_id").select("doc_id", "node").distinct()
    first = rows.join(stay, ["doc_id", "node"], "left_semi").groupBy("doc_id", "node").agg(F.min(rest).alias(rest))
    return out.unionByName(first.select(f"{rest}.*"))
