"""64-bit hashes of words and word sequences, for whole batches at once.

A word's hash is a cryptographic digest (BLAKE2b) of its bytes, cut to 64 bits: different words share one only by a chance of
one in 2^64 a pair, however the texts are made up. A worker remembers the hashes of the words it has met last.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from prosopon.llm.common import utf8

U = np.uint64
#: Words whose hashes a worker remembers.
MEMO = 400_000


class _Words(dict):
    """Hashes by word; asked for a batch's distinct words only."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= MEMO:
            self.clear()
        self[word] = h = int.from_bytes(hashlib.blake2b(word, digest_size=8).digest(), "little")
        return h


_words = _Words()


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64 bits with good spread."""
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def distinct_words(texts) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of the distinct words `[^\\x20\\x09-\\x0D]+` of all texts with A-Z in lower case; for every word of the texts its place
    among them; and where each text's words begin (one more). texts: a list, or a column without nulls."""
    if isinstance(texts, list):
        texts = pa.array([utf8(t) for t in texts], pa.large_binary()).view(pa.large_string())
    elif isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    lists = pc.ascii_split_whitespace(pc.ascii_lower(texts))
    coded = lists.flatten().dictionary_encode()
    words = coded.dictionary.cast(pa.large_binary()).to_pylist()
    which = coded.indices.to_numpy()
    real = which != (words.index(b"") if b"" in words else -1)  # white space at a text's edges leaves an empty piece there
    begin = np.concatenate([[0], np.cumsum(real)])[lists.offsets.to_numpy()] if len(texts) else np.zeros(1, np.int64)
    return np.fromiter(map(_words.__getitem__, words), U, len(words)), which[real], begin


def word_hashes(texts) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of all texts, and where each text's begin (one more)."""
    hashes, which, begin = distinct_words(texts)
    return hashes[which], begin


def shingle_sets(texts, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct k-word shingles of every text, by text and then hash: hashes, and where each text's begin (one more). A text
    with fewer words has the whole sequence as its one shingle; one without words has none."""
    h, at = word_hashes(texts)
    n = np.diff(at)
    owner = np.repeat(np.arange(len(texts)), n)
    s = h.copy()
    for j in range(1, k):
        m = max(0, len(h) - j)
        s[:m] = mix(s[:m] * U(0x9FB21C651E98DF25) + h[j:])
    keep = np.arange(len(h)) + k <= at[1:][owner]
    s, who = s[keep], owner[keep]
    short = np.flatnonzero((n > 0) & (n < k))
    if len(short):
        folded = []
        for i in short:
            x = h[at[i] : at[i] + 1] ^ U(n[i])
            for j in range(1, n[i]):
                x = mix(x * U(0x9FB21C651E98DF25) + h[at[i] + j])
            folded.append(mix(x)[0])
        s, who = np.concatenate([s, np.array(folded, U)]), np.concatenate([who, short])
    order = np.lexsort((s, who))
    s, who = s[order], who[order]
    new = np.ones(len(s), bool)
    new[1:] = (s[1:] != s[:-1]) | (who[1:] != who[:-1])
    return s[new], np.searchsorted(who[new], np.arange(len(texts) + 1))
