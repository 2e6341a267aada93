"""Token counts with overlap resynchronisation.

Texts up to `chunk` characters are encoded whole. Longer ones are encoded in overlapping chunks with the byte offset of
every token. Two neighbouring chunks are spliced at a boundary that both report and that is proven stable: a letter or number
followed by something of another kind (letter, number, symbol, ASCII white space), or a symbol followed by ASCII white
space. No alternative of the pre-tokenizer's pattern goes from a letter to what is none, from a number to what is none, or
from a symbol to white space; its only look-ahead follows white space; and places whose two characters stand together inside
an added token are left out. So what stands left of such a place is encoded without regard to what stands right of it, and the
other way about. Kinds are those on which the oldest and the newest character table at hand agree; a character of no agreed
kind proves nothing. Where the overlap holds no such boundary it is doubled, and at last the chunk itself, up to the rest of
the text: a text that is one run of letters, say, is encoded whole.

A .json file of byte-level BPE is run by its own vocabulary as ranks (the merges are in the order of the ids, which is
verified when it is loaded); the added tokens' strings inside a text are one token each, as the library does by default.

Defined results: a null text is empty and has 0 tokens; repeated rows are counted each for itself; an empty table gives an
empty table.
"""

from __future__ import annotations

import functools
import json
import re
import unicodedata

import numpy as np
from pyspark.sql import DataFrame

from prosopon.llm.common import keyed_text, map_arrow, utf8

LETTER, NUMBER, SYMBOL, SPACE = 1, 2, 3, 4


@functools.cache
def _kind(code: int) -> int:
    """The kind of a character, 0 where none is proven."""
    c = chr(code)
    if c in " \t\n\v\f\r":
        return SPACE
    old, new = unicodedata.ucd_3_2_0.category(c)[0], unicodedata.category(c)[0]
    kinds = {"L": LETTER, "N": NUMBER, "P": SYMBOL, "S": SYMBOL}
    return kinds.get(new, 0) if kinds.get(old) == kinds.get(new) else 0


def _byte_of_char() -> dict[str, int]:
    """The usual table of byte-level BPE: printable bytes stand for themselves, the others for code points from 256 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(rest)}


class ByteBPE:
    """Counts as the tokenizers library does for a byte-level BPE .json."""

    def __init__(self, path: str):
        import public_tokenizers
        import tiktoken

        spec = json.loads(open(path, encoding="utf-8").read())
        model, pre = spec["model"], spec["pre_tokenizer"]
        plain = spec["normalizer"] is None and pre["type"] == "ByteLevel" and pre["use_regex"] and not pre["add_prefix_space"] and not model.get("ignore_merges")
        if not plain or model["type"] != "BPE" or any(t["lstrip"] or t["rstrip"] or t["single_word"] or t["normalized"] or re.search(r"\s", t["content"]) for t in spec["added_tokens"]):
            raise ValueError(f"{path}: not a plain byte-level BPE")
        of = _byte_of_char()
        added = {t["content"] for t in spec["added_tokens"]}
        ranks = {bytes(of[c] for c in s): k for s, k in model["vocab"].items() if s not in added}
        made = [model["vocab"]["".join(m.split(" ") if isinstance(m, str) else m)] for m in model["merges"]]
        if made != sorted(made) or len(made) + 256 != len(ranks):
            raise ValueError(f"{path}: the merges are not in the order of the ids")
        self.enc = tiktoken.Encoding("counts", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.size = np.zeros(max(ranks.values()) + 1, np.int64)
        for b, k in ranks.items():
            self.size[k] = len(b)
        self.added = re.compile("|".join(map(re.escape, sorted(added, key=len, reverse=True)))) if added else None
        self.inside = {t[i : i + 2] for t in added for i in range(len(t) - 1)}

    def count(self, text: str) -> int:
        if self.added is None or not self.added.search(text):
            return len(self.enc.encode_ordinary(text))
        return sum(len(self.enc.encode_ordinary(p)) for p in self.added.split(text)) + len(self.added.findall(text))

    def offsets(self, text: str) -> np.ndarray:
        """Byte offsets at which tokens start, and the end of the text."""
        sizes, at = [], 0
        for m in self.added.finditer(text) if self.added else ():
            sizes += [self.size[self.enc.encode_ordinary(text[at : m.start()])], np.array([len(m[0])])]
            at = m.end()
        sizes.append(self.size[np.array(self.enc.encode_ordinary(text[at:]), dtype=np.int64)])
        return np.concatenate([[0], np.cumsum(np.concatenate(sizes))]).astype(np.int64)


def _stable(bpe: ByteBPE, text: str, shift: int, offsets: np.ndarray) -> np.ndarray:
    """Those of the byte offsets that are proven boundaries inside text, which starts at byte `shift`."""
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
    sizes = 1 + (codes >= 0x80) + (codes >= 0x800) + (codes >= 0x10000)
    starts = shift + np.cumsum(sizes) - sizes
    at = np.searchsorted(starts, offsets)
    offsets, at = offsets[(at > 0) & (at < len(starts))], at[(at > 0) & (at < len(starts))]
    whole = starts[at] == offsets  # a token may start inside a character
    offsets, at = offsets[whole], at[whole]
    used, place = np.unique(codes[np.concatenate([at - 1, at])], return_inverse=True)
    before, after = np.array([_kind(int(c)) for c in used], np.int64)[place].reshape(2, -1)
    ok = np.isin(before, (LETTER, NUMBER)) & (after != before) & (after > 0) | (before == SYMBOL) & (after == SPACE)
    ok[ok] = [text[k - 1 : k + 1] not in bpe.inside for k in at[ok]]
    return offsets[ok]


def count_long(bpe: ByteBPE, text: str, chunk: int, overlap: int) -> int:
    """Tokens of a text of any length, from overlapping chunks."""
    total, start, size = 0, 0, chunk
    while len(text) - start > size:
        head = text[start : start + size]
        raw = utf8(head)
        a = bpe.offsets(head)
        wide = min(overlap, size)
        cut = None
        while cut is None:
            tail = head[size - wide :]  # what the next chunk shares with this one
            shift = len(raw) - len(utf8(tail))
            b = bpe.offsets(text[start + size - wide : start + 2 * size - wide]) + shift
            common = _stable(bpe, tail, shift, np.intersect1d(a, b, assume_unique=True))
            if len(common):
                cut = int(common[len(common) // 2])
            elif wide == size:
                break
            else:
                wide = min(2 * wide, size)
        if cut is None:  # nothing to align by: a longer chunk from the same place
            size *= 2
            continue
        total += int(np.searchsorted(a, cut))
        start += len(raw[:cut].decode("utf-8", "surrogatepass"))
        size = chunk
    return total + bpe.count(text[start:])


SCHEMA = "doc_id long, n_bytes long, n_tokens long, over_limit boolean"


def count_tokens(df: DataFrame, tokenizer_path: str, limit: int = 1024, chunk: int = 16384, overlap: int = 512, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row. chunk, overlap: in characters."""

    def start():
        bpe = ByteBPE(tokenizer_path)

        def f(ids, texts):
            n = [bpe.count(t) if len(t) <= chunk else count_long(bpe, t, chunk, overlap) for t in texts]
            return ids, [len(utf8(t)) for t in texts], n, [x > limit for x in n]

        return f

    return map_arrow(keyed_text(df, id_col, text_col), SCHEMA, start)
