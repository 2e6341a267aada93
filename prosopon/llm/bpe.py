"""Byte-level BPE by DuckDB recursive queries, one per partition and batch.

A text is cut into the matches of the tokenizer's pattern. The distinct matches of a batch become rows (word, position, token), one
per byte. A recursive query joins neighbouring tokens with the merge table and contracts each word's leftmost pair of minimum rank,
until no word has a pair left. Pairs of that rank further right that do not overlap are contracted in the same round: a token's rank is
above those of the parts it is made of, so no contraction makes a pair that would have to come before them. (A token that can also
be cut into a part of higher rank is never made from it: before that part could be made, all of the token's bytes, which nothing
from outside has joined, would have become the token itself. The tests encode every token of the vocabulary.) Decoding joins the ids of each whole text with the vocabulary and aggregates the tokens' bytes in the order
of their positions.

Matches of more than PIECE bytes (a run of letters without any break) go through the same query in pieces. Tokens are the encoding
of their bytes if and only if every two neighbours are the encoding of theirs: the first contraction across a boundary would touch
only the two tokens beside it, and would so come in the encoding of these two as well. Where two pieces meet in tokens that are not
their own encoding, the tokens around are encoded together, more of them each time, until all boundaries hold. Matches of more than SEGMENT
bytes are encoded segment by segment, and the segments spliced likewise. The queries get bounded numbers of bytes and of ids at a time, and
write nothing to the disk, so a worker's memory grows with its longest text's bytes and ids alone (four bytes an id).

Defined results: a null text is empty, has no ids and decodes to an empty text; repeated rows are encoded each for itself;
ids that are null are skipped in decoding, ids that the vocabulary lacks are an error; an empty table gives an empty table.
"""

from __future__ import annotations

import base64
import gc
import hashlib
import itertools
from array import array
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame

from prosopon.llm.common import keyed_text, map_arrow, utf8

#: Bytes of a match that are encoded at once.
PIECE = 64
#: Bytes of a match whose pieces are held as lists at once, a multiple of PIECE.
SEGMENT = 1 << 18
#: Bytes, and ids, that a query gets at once.
QUERY_BYTES, QUERY_IDS = 1 << 20, 1 << 19
#: Longest word, and group of words, that a worker remembers.
MEMO_CHARS = 1000
#: Tokens on each side that are encoded anew where pieces do not fit, at first.
AROUND = 4
#: Distinct words, and groups of words, that a worker remembers in each of two generations.
MEMO = 300_000

#: start: g (place of a token), word, id, nxt (place of the next token of the word, or -1).
ENCODE = """
WITH RECURSIVE state(g, word, id, nxt, done) AS (
    SELECT g, word, id, nxt, false FROM start
    UNION ALL
    (
    WITH pair AS MATERIALIZED (
        SELECT a.word, a.g, b.g AS other, b.nxt AS after, m.rank
        FROM state a JOIN state b ON a.nxt = b.g JOIN merges m ON CAST(a.id AS BIGINT) * 4294967296 + b.id = m.both WHERE NOT a.done AND NOT b.done
    ),
    best AS MATERIALIZED (SELECT word, min(rank) AS rank FROM pair GROUP BY word),
    least AS MATERIALIZED (SELECT pair.* FROM pair JOIN best ON pair.word = best.word AND pair.rank = best.rank),
    joined AS MATERIALIZED (SELECT * FROM least l ANTI JOIN least before ON l.g = before.other)
    SELECT a.g, a.word, coalesce(j.rank, a.id), CASE WHEN j.g IS NULL THEN a.nxt ELSE j.after END, best.word IS NULL
    FROM state a ANTI JOIN joined gone ON a.g = gone.other LEFT JOIN joined j ON a.g = j.g LEFT JOIN best ON a.word = best.word WHERE NOT a.done
    )
)
SELECT g, word, id FROM state WHERE done
"""

#: The bytes of a token are held as letters, so that they can be joined.
DECODE = "SELECT t.k, string_agg(v.letters, '' ORDER BY t.pos) AS letters FROM given_ids t JOIN vocabulary v ON t.id = v.id GROUP BY t.k"
LETTER = 256


class Vocabulary:
    """Ranks of a .tiktoken file, and the merge table: every pair of tokens whose joined bytes are a token."""

    def __init__(self, path: str):
        import duckdb

        self.rank = {base64.b64decode(a): int(b) for a, b in (line.split() for line in open(path, "rb") if line.strip())}
        self.bytes_of = {k: b for b, k in self.rank.items()}
        pairs = [(self.rank[t[:i]], self.rank[t[i:]], k) for t, k in self.rank.items() for i in range(1, len(t)) if t[:i] in self.rank and t[i:] in self.rank]
        pairs = [(a, b, k) for a, b, k in pairs if k > max(a, b)]
        self.decimal = [str(k) for k in range(max(self.bytes_of) + 1)]
        self.byte_id = np.array([self.rank[bytes([b])] for b in range(256)], np.int32)
        self.fits: dict[tuple[int, int], bool] = {}
        self.db = duckdb.connect(":memory:", config={"threads": 1, "memory_limit": "350MB", "temp_directory": "", "preserve_insertion_order": False})
        left, right, rank = np.array(pairs, np.int64).T
        self._table("merges", both=left << 32 | right, rank=rank.astype(np.int32))
        self._table("vocabulary", id=np.fromiter(self.bytes_of, np.int32), letters=["".join(chr(LETTER + x) for x in b) for b in self.bytes_of.values()])

    def _table(self, name: str, **cols) -> None:
        self.db.register("given", pa.table(cols))
        self.db.execute(f"CREATE OR REPLACE TABLE {name} AS SELECT * FROM given")

    def encode_words(self, words: list[bytes]) -> list[list[int]]:
        """Ids of each word."""
        long = [k for k, w in enumerate(words) if len(w) > PIECE]
        out = self._contract([w if len(w) <= PIECE else w[:1] for w in words])
        for some in self._bounded(long, [len(words[k]) for k in long], SEGMENT):
            if len(words[some[0]]) > SEGMENT:  # it is alone
                w = words[some[0]]
                coded = [[array("i", self._spliced([w[i : i + SEGMENT]])[0]) for i in range(0, len(w), SEGMENT)]]
                self._splice(coded)
                ids = array("i")
                for x in coded[0]:
                    ids.extend(x)
                out[some[0]] = ids
            else:
                for k, ids in zip(some, self._spliced([words[k] for k in some])):
                    out[k] = ids
        return out

    def _spliced(self, words: list[bytes]) -> list[list[int]]:
        """Ids of each word, by its pieces."""
        pieces = [[w[i : i + PIECE] for i in range(0, len(w), PIECE)] for w in words]
        got = iter(self._contract(list(itertools.chain.from_iterable(pieces))))
        coded = [[next(got) for _ in p] for p in pieces]
        self._splice(coded)
        return [list(itertools.chain.from_iterable(c)) for c in coded]

    @staticmethod
    def _bounded(items: list, sizes: list[int], most: int):
        """The items in their order, in lists whose sizes add up to `most`; a larger one is alone."""
        some, total = [], 0
        for x, n in zip(items, sizes):
            if some and total + n > most:
                yield some
                some, total = [], 0
            some.append(x)
            total += n
        if some:
            yield some

    def _contract(self, words: list[bytes]) -> list[list[int]]:
        """Ids of each word, by the recursive query. No word is empty."""
        return list(itertools.chain.from_iterable(map(self._contract_some, self._bounded(words, list(map(len, words)), QUERY_BYTES))))

    def _contract_some(self, words: list[bytes]) -> list[list[int]]:
        n = np.array([len(w) for w in words])
        ends = np.cumsum(n)
        g = np.arange(ends[-1], dtype=np.int32)
        nxt = g + 1
        nxt[ends - 1] = -1
        self._table("start", g=g, word=np.repeat(np.arange(len(words), dtype=np.int32), n), id=self.byte_id[np.frombuffer(b"".join(words), np.uint8)], nxt=nxt)
        got = self.db.execute(ENCODE).fetchnumpy()
        order = np.argsort(got["g"], kind="stable")
        ids, cut = got["id"][order].tolist(), np.searchsorted(got["word"][order], np.arange(len(words) + 1)).tolist()
        return [ids[i:j] for i, j in itertools.pairwise(cut)]

    def _joined(self, ids) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids))

    def _fit(self, pairs: set[tuple[int, int]]) -> dict[tuple[int, int], bool]:
        """Whether two tokens are the encoding of their joined bytes."""
        if len(self.fits) > MEMO:
            self.fits.clear()
        new = list(pairs - self.fits.keys())
        self.fits |= {p: ids == [*p] for p, ids in zip(new, self._contract([self._joined(p) for p in new]))}
        return self.fits

    def _splice(self, coded: list[list[list[int]]]) -> None:
        """Makes the pieces of each word the word's encoding. A piece is a list of ids, none empty."""
        # How many tokens on each side to encode anew if a boundary does not hold; 0 where it is proven.
        todo = [[AROUND] * (len(c) - 1) for c in coded]
        while any(map(any, todo)):
            meet = lambda c, k: (c[k][-1], c[k + 1][0])
            fits = self._fit({meet(c, k) for c, t in zip(coded, todo) for k, m in enumerate(t) if m})
            anew: list[tuple[int, int]] = []
            for i, (c, t) in enumerate(zip(coded, todo)):
                last = -2
                for k, m in enumerate(t):
                    if m and fits[meet(c, k)]:
                        t[k] = 0
                    elif m and k > last + 1:  # its neighbour may wait for the next round
                        anew.append((i, k))
                        last = k
            got = self._contract([self._joined([*coded[i][k][-todo[i][k] :], *coded[i][k + 1][: todo[i][k]]]) for i, k in anew])
            for (i, k), ids in zip(reversed(anew), reversed(got)):
                c, t = coded[i], todo[i]
                m = t[k]
                left, right = c[k][:-m], c[k + 1][m:]
                if not left and k:
                    t[k - 1] = max(t[k - 1], 2 * m)
                if not right and k + 1 < len(t):
                    t[k + 1] = max(t[k + 1], 2 * m)
                c[k : k + 2] = parts = [x for x in (left, ids, right) if x]
                t[k : k + 1] = [2 * m] * (len(parts) - 1)

    def decode_all(self, rows: list[np.ndarray]) -> list[bytes]:
        """The bytes of each array of ids."""
        out: list[list[bytes]] = [[] for _ in rows]
        slices = [(k, r[i : i + QUERY_IDS]) for k, r in enumerate(rows) for i in range(0, len(r), QUERY_IDS)]
        for some in self._bounded(slices, [len(x) for _, x in slices], QUERY_IDS):
            for (k, _), part in zip(some, self._decode([x for _, x in some])):
                out[k].append(part)
        return list(map(b"".join, out))

    def _decode(self, rows: list[np.ndarray]) -> list[bytes]:
        """The bytes of each array of ids, by one query. No array is empty."""
        flat = np.concatenate(rows)
        if unknown := set(np.unique(flat).tolist()) - self.bytes_of.keys():
            raise ValueError(f"ids without a token: {sorted(unknown)[:5]}")
        self._table("given_ids", k=np.repeat(np.arange(len(rows), dtype=np.int32), list(map(len, rows))), pos=np.arange(len(flat), dtype=np.int32), id=flat)
        out = [b""] * len(rows)
        for k, letters in self.db.execute(DECODE).fetchall():
            out[k] = (np.frombuffer(letters.encode("utf-16-le"), "<u2") - LETTER).astype(np.uint8).tobytes()
        return out


@lru_cache(1)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


class Memo:
    """Remembers what was used last, in two generations of a fixed size."""

    def __init__(self, most: int = MEMO):
        self.young, self.old, self.most = {}, {}, most

    def known(self, keys: list) -> list:
        """What is remembered of the keys, None for others; it counts as used."""
        out = list(map(self.young.get, keys))
        again = {k: v for k, x in zip(keys, out) if x is None and (v := self.old.get(k)) is not None}
        if again:
            out = [again.get(k) if x is None else x for k, x in zip(keys, out)]
            self.add(again)
        return out

    def add(self, items: dict) -> None:
        if len(self.young) + len(items) > self.most:
            self.old, self.young = self.young, {}
        self.young |= items


_GAP = regex.compile(r"\s |\x1f")
_GROUP = regex.compile(r"\s*\S+|\s+$")


def groups(texts: list[str]) -> tuple[pa.Array, np.ndarray]:
    """The texts cut where white space follows another character, and where each text's groups begin (one more). No match of the
    pattern goes across such a place, and none before it looks beyond it, so the matches of the groups are the matches of the text."""
    plain = [_GAP.search(t) is None for t in texts]
    # In most texts no white space stands before a space, so the cuts are before the spaces; these texts are cut all at once.
    lists = pc.split_pattern(pc.replace_substring(pa.array([t if p else "" for t, p in zip(texts, plain)], pa.large_string()), " ", "\x1f "), "\x1f")
    flat, begin = lists.flatten(), lists.offsets.to_numpy()
    real = pc.greater(pc.binary_length(flat), 0)
    flat, begin = flat.filter(real), np.concatenate([[0], np.cumsum(real.to_numpy(zero_copy_only=False))])[begin] if texts else np.zeros(1, np.int64)
    if all(plain):
        return flat, begin
    other = {k: _GROUP.findall(t) for k, (t, p) in enumerate(zip(texts, plain)) if not p}
    n = np.diff(begin)
    parts, at = [], 0
    for k, found in other.items():
        parts += [flat.slice(begin[at], begin[k] - begin[at]), pa.array(found, pa.large_string())]
        n[k], at = len(found), k
    return pa.concat_arrays([*parts, flat.slice(begin[at])]), np.concatenate([[0], np.cumsum(n)])


def _gather(values: np.ndarray, begin: np.ndarray, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The stretches of values that begin[k]:begin[k + 1] names, for each k of which, and where these begin (one more)."""
    n = np.diff(begin)[which]
    ends = np.concatenate([[0], np.cumsum(n)])
    return values[np.repeat(begin[:-1][which] - ends[:-1], n) + np.arange(ends[-1])], ends


class Codec:
    """Encodes the texts of a batch."""

    def __init__(self, path: str, pattern: str):
        self.vocabulary, self.pattern = vocabulary(path), regex.compile(pattern)
        self.words, self.groups = Memo(), Memo()

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of each text."""
        collects = gc.isenabled()
        gc.disable()  # nothing here makes cycles, and a pass over all that is remembered is slow
        try:
            return self._encode(texts)
        finally:
            if collects:
                gc.enable()

    def _encode(self, texts: list[str]) -> list[np.ndarray]:
        flat, begin = groups(texts)
        coded = flat.dictionary_encode()
        names = coded.dictionary.to_pylist()
        ids = self._ids(names)
        size = np.concatenate([[0], np.cumsum(np.fromiter(map(len, ids), np.int64, len(ids)) // 4)])
        got, ends = _gather(np.frombuffer(b"".join(ids), "<i4"), size, coded.indices.to_numpy())
        cuts = ends[begin].tolist()
        return [got[i:j] for i, j in itertools.pairwise(cuts)]

    def _ids(self, names: list[str]) -> list[bytes]:
        """The ids of each group, of four bytes each."""
        out = self.groups.known(names)
        missing = [k for k, x in enumerate(out) if x is None]
        cut = [self.pattern.findall(names[k]) for k in missing]
        words = list(set(itertools.chain.from_iterable(cut)))
        found = dict(zip(words, self.words.known(words)))
        new = [w for w, x in found.items() if x is None]
        ids = self.vocabulary.encode_words([utf8(w) for w in new])
        raw = np.fromiter(itertools.chain.from_iterable(ids), "<i4").tobytes()
        fresh = {w: raw[4 * (e - len(i)) : 4 * e] for w, i, e in zip(new, ids, itertools.accumulate(map(len, ids)))}
        self.words.add({w: x for w, x in fresh.items() if len(w) <= MEMO_CHARS})
        found |= fresh
        fresh = {names[k]: found[ws[0]] if len(ws) == 1 else b"".join(map(found.__getitem__, ws)) for k, ws in zip(missing, cut)}
        self.groups.add({g: x for g, x in fresh.items() if len(g) <= MEMO_CHARS})
        for k in missing:
            out[k] = fresh[names[k]]
        return out

    def digest(self, ids: np.ndarray) -> str:
        """SHA-256 of the decimal ids, joined by one space."""
        sha = hashlib.sha256()
        for i in range(0, len(ids), QUERY_IDS):
            sha.update((" " * (i > 0) + " ".join(map(self.vocabulary.decimal.__getitem__, ids[i : i + QUERY_IDS].tolist()))).encode())
        return sha.hexdigest()


@lru_cache(1)
def codec(path: str, pattern: str) -> Codec:
    """One for each worker, so that what it remembers serves its next tasks."""
    return Codec(path, pattern)


def encode(df: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, ids: the token ids of every row's whole text."""

    def start():
        c = codec(path, pattern)
        return lambda ids, texts: (ids, c.encode(texts))

    return map_arrow(keyed_text(df, id_col, text_col), "doc_id long, ids array<int>", start)


def decode(df: DataFrame, path: str) -> DataFrame:
    """doc_id, bytes: from rows of doc_id, ids."""

    def start():
        v = vocabulary(path)
        return lambda keys, ids: (keys, v.decode_all([np.array([k for k in (r or ()) if k is not None], np.int32) for r in ids]))

    return map_arrow(df.select("doc_id", "ids"), "doc_id long, bytes binary", start)


DIGEST = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"


def round_trip(df: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Number and digest of every row's ids, and digest of the bytes that these ids, text by text, decode to."""

    def start():
        c = codec(path, pattern)

        def f(keys, texts):
            coded = c.encode(texts)
            return keys, list(map(len, coded)), list(map(c.digest, coded)), [hashlib.sha256(b).hexdigest() for b in c.vocabulary.decode_all(coded)]

        return f

    return map_arrow(keyed_text(df, id_col, text_col), DIGEST, start)
