"""Toxicity by noisy-channel deobfuscation.

Writers hide words by look-alike characters (1d10t), spacing (i d i o t, i.d.i.o.t) and repetition (idiooot). Each such
stretch becomes a lattice: every observed character may stand for the letters that it looks like, a repeated character for
one or two of it, a separator between single letters for nothing or for a word boundary. The Viterbi algorithm finds the
path that is likeliest under a character trigram model and the channel's costs. Only stretches whose lattice is one path that reads as
they are written (letters without any repetition) are their own decoding. Where a token may be meant as it stands (doubled
letters, no letters at all) or its edge may be punctuation or a letter (!diot, wow!), all these readings count as words.
The restored text is then scored by a logistic regression over words and word beginnings.

Training. The character model counts the words of all documents, labels not being used. The classifier is fitted on a bounded sample:
`max_labelled` labelled rows (expected), chosen by a hash of doc_id. Its features are selected on that sample: those that at least
`min_docs` of the rows have, whose odds differ by more than e between the labels, and of them the `max_features` that divide the
labels best. That is the classifier's regularisation, and it bounds the model that is sent to the tasks; every word of every text is
looked up in it. doc_id, lang and source are never inputs of a score.

Defined results: a null or empty text has the score of a text without any feature; without usable labels of both kinds among the
rows all scores are the share of toxic rows (0 if there is none); labels that are null are left out; a doc_id that has several labels
counts once for each; repeated rows are scored each for itself; an empty table gives an empty table.
"""

from __future__ import annotations

import math
import re
import unicodedata
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from prosopon.llm.common import crc_mod, keyed_text, map_arrow, map_whole

#: The letters that a character may stand for.
LOOKS_LIKE = {"0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g", "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "(": "c", "€": "e", "£": "l", "¡": "i", "%": "x"}
SEPARATORS = ".-_*~·'"
EDGE = ".,;:!?\"'()[]{}<>«»“”…"
LETTERS = "abcdefghijklmnopqrstuvwxyz"
#: Symbols of the character model: 0 is a word's boundary, 1 to 26 letters, 27 any other letter.
N_SYM = 28
COST = {"same": 0.0, "look": 1.0, "repeat": 0.5, "skip": 0.7, "break": 2.0}

_EDGE_LETTERS = "".join(c for c in EDGE if c in LOOKS_LIKE)
_PLAIN_EDGE = "".join(c for c in EDGE if c not in LOOKS_LIKE)
_RUNS = re.compile(r"(.)\1*", re.S)
_PARTS = re.compile(f"[{re.escape(SEPARATORS)}]+")
_DOUBLE = re.compile(r"(.)\1")
_TRIPLE = re.compile(r"(.)\1\1")
_LETTER = re.compile(r"[^\W\d_]")
_STEADY = re.compile(r"(?:([^\W\d_])(?!\1))*[^\W\d_]?")
_NUMBER = re.compile(r"[$€£+]?\d+(?:[.,:/-]\d+)*%?")
_LOOK = re.escape("".join(LOOKS_LIKE))
#: Three or more single characters, each with at most one mark on either side, and any white space between them.
_ONE = rf"[^\s\w]?[\w{_LOOK}][^\s\w]?"
_SPACED = re.compile(rf"(?<!\S)(?:{_ONE}\s+){{2,}}{_ONE}(?!\S)")
_CORE = re.compile(rf"\w|[{_LOOK}]")


def symbol(c: str) -> int:
    k = ord(c) - 96
    if 1 <= k <= 26:
        return k
    base = unicodedata.normalize("NFD", c)[:1]
    k = ord(base) - 96 if base else 0
    return k if 1 <= k <= 26 else 27


@dataclass
class CharModel:
    """logp[a][b][c]: log probability of c after a, b; add-half smoothing."""

    logp: list = field(default_factory=list)

    @staticmethod
    def of(counts: dict[int, int]) -> CharModel:
        n = np.full((N_SYM, N_SYM, N_SYM), 0.5)
        for k, v in counts.items():
            n.reshape(-1)[k] += v
        return CharModel(np.log(n / n.sum(2, keepdims=True)).tolist())


@lru_cache(maxsize=8192)
def _stands_for(c: str, run: int, joined: bool, edge: bool) -> tuple[tuple[str, float, tuple[int, ...]], ...]:
    """What a group of equal characters may stand for, with costs and the model's symbols."""
    opts: list[tuple[str, float]] = []
    if c.isalpha():
        opts.append((c * min(run, 2), COST["repeat"] * max(0, run - 2)))
        if run > 1:
            opts.append((c, COST["repeat"] * (run - 1)))
    if c == " " or joined and c in SEPARATORS:
        opts += [("", COST["skip"]), (" ", COST["break"])]
    for x in LOOKS_LIKE.get(c, ""):
        opts.append((x * min(run, 2), COST["look"] * run))
        if run > 1:
            opts.append((x, COST["look"] + COST["repeat"] * (run - 1)))
    if edge:
        opts.append(("", COST["skip"]))
    return tuple((x, cost, tuple(0 if y == " " else symbol(y) for y in x)) for x, cost in opts or [(c * run, 0.0)])


def _options(word: str, edges: bool = False) -> list[tuple[tuple[str, float, tuple[int, ...]], ...]]:
    """The options of each group of equal characters. edges: marks at the edges may also stand for nothing."""
    joined = not word.isalpha() and sum(c in SEPARATORS for c in word) >= 2 and all(len(p) <= 1 for p in _PARTS.split(word))
    spans = [m.span() for m in _RUNS.finditer(word)]
    if not edges:
        return [_stands_for(word[i], j - i, joined, False) for i, j in spans]
    first, last = len(word) - len(word.lstrip(_EDGE_LETTERS)), len(word.rstrip(_EDGE_LETTERS))
    return [_stands_for(word[i], j - i, joined, j <= first or i >= last) for i, j in spans]


def viterbi(word: str, lm: CharModel, edges: bool = False) -> str:
    """The likeliest reading of one stretch; boundaries inside it come out as spaces."""
    return _likeliest(_options(word, edges), lm)


def _likeliest(options: list, lm: CharModel) -> str:
    # A path's text is a chain of its pieces, so that long stretches are not copied at every step.
    paths: dict[tuple[int, int], tuple[float, str, tuple | None]] = {(0, 0): (0.0, "", None)}
    logp = lm.logp
    for opts in options:
        if len(opts) == len(paths) == 1:  # most steps: nothing to choose from
            ((x, s, symbols),) = opts
            (((p, q), (score, end, chain)),) = paths.items()
            s = score - s
            for k in symbols:
                s += logp[p][q][k]
                p, q = (q, k) if k else (0, 0)
            paths = {(p, q): (s, x[-1:] or end, (chain, x))}
            continue
        new: dict[tuple[int, int], tuple[float, str, tuple | None]] = {}
        for (a, b), (score, end, chain) in paths.items():
            for x, cost, symbols in opts:
                s, p, q = score - cost, a, b
                for k in symbols:
                    s += logp[p][q][k]
                    p, q = (q, k) if k else (0, 0)
                if (at := new.get((p, q))) is None or (s, x) > at[:2]:
                    new[p, q] = (s, x[-1:] or end, (chain, x))
        paths = new

    def text(chain: tuple | None) -> str:
        pieces = []
        while chain:
            chain, x = chain
            pieces.append(x)
        return "".join(reversed(pieces))

    ends = [(s + (logp[a][b][0] if b else 0.0), chain) for (a, b), (s, _, chain) in paths.items()]
    best = max(s for s, _ in ends)
    return max(text(chain) for s, chain in ends if s == best)


def ambiguous(token: str) -> bool:
    """Whether the lattice of a lower-case token has more than one path, or one that reads otherwise than the token."""
    if token.isalpha():
        return _DOUBLE.search(token) is not None
    return _several(token, _options(token))


def _several(token: str, options: list) -> bool:
    return any(len(opts) > 1 or not opts[0][0].startswith(m[1]) for opts, m in zip(options, _RUNS.finditer(token)))


class Restorer:
    """Decodes tokens; what it has decoded is remembered, up to a fixed number."""

    def __init__(self, lm: CharModel, most: int = 200_000):
        self.lm, self.most, self.known = lm, most, {}

    def _decoded(self, token: str, edges: bool = False) -> str:
        if token.isalpha() and not _DOUBLE.search(token):
            return token
        options = _options(token)
        if not _several(token, options):
            return token
        return _likeliest(_options(token, True) if edges else options, self.lm)

    def readings(self, token: str) -> tuple[str, ...]:
        """What a token may be read as, the likeliest first."""
        wide = token.strip(_PLAIN_EDGE)
        if (out := self.known.get(wide)) is None:
            if wide.isalpha() and not _DOUBLE.search(wide):
                return (wide,)
            bare = wide.strip(EDGE)
            found = [bare] if _NUMBER.fullmatch(bare) else []
            found.append(self._decoded(wide, wide != bare))
            if wide != bare and bare:
                found += [self._decoded(bare), self._decoded(wide)]
            if bare.isalpha() and not _TRIPLE.search(bare) or not _LETTER.search(bare):
                found.append(bare)
            out = tuple(dict.fromkeys(found))
            if len(self.known) >= self.most:
                self.known.clear()
            self.known[wide] = out
        return out

    def token(self, token: str) -> str:
        return self.readings(token)[0]

    def _joined(self, stretch: str) -> str:
        """The word or words of single characters with white space between them."""
        return viterbi(" ".join(_CORE.search(x)[0] if (k := re.search(r"\w", x)) is None else k[0] for x in stretch.split()), self.lm)

    def spaced(self, low: str) -> list[str]:
        """Words hidden by white space between single letters."""
        return [w for m in _SPACED.finditer(low) for w in self._joined(m[0]).split()]

    def words(self, text: str) -> set[str]:
        """The distinct words of the restored text."""
        low = text.lower()
        out: set[str] = set()
        for t in set(low.split()):
            for w in self.readings(t):
                if " " in w:
                    out.update(w.split())
                elif w:
                    out.add(w)
        out.update(self.spaced(low))
        return out

    def text(self, text: str) -> str:
        """The whole restored text, lower-case."""
        low = _SPACED.sub(lambda m: self._joined(m[0]), text.lower())
        return re.sub(r"\S+", lambda m: self._kept_edges(m[0]), low)

    def _kept_edges(self, token: str) -> str:
        bare, wide, best = token.strip(EDGE), token.strip(_PLAIN_EDGE), self.token(token)
        if not bare or not best:
            return token
        return token.replace(bare if bare == best or best == self._decoded(bare) else wide, best, 1)


PREFIXES = (4, 5, 6)


def features(word: str) -> list[str]:
    return [word, *[f"{word[:k]}*" for k in PREFIXES if len(word) >= k]]


def char_counts(df: DataFrame) -> dict[int, int]:
    """Trigram counts over the words of all documents; at most N_SYM cubed cells."""
    table = np.zeros(0x251, np.uint8)  # the last: all other characters
    for k in range(0x250):
        c = chr(k).lower()
        table[k] = symbol(c) if len(c) == 1 and c.isalpha() else 0

    def start():
        def f(texts):
            codes = np.frombuffer("\n\n".join(["", *texts, ""]).encode("utf-32-le", "surrogatepass"), np.uint32)
            s = table[np.minimum(codes, 0x250)]
            s = s[np.concatenate([[True], (s[1:] | s[:-1]) != 0])].astype(np.uint16)  # one boundary between words
            b = np.concatenate([s[:1] * 0, s[:-1]])
            a = np.concatenate([b[:1] * 0, b[:-1]]) * (b != 0)
            use = (s | b) != 0
            n = np.bincount(((a * N_SYM + b) * N_SYM + s)[use], minlength=N_SYM**3)  # below 1 << 16
            at = np.flatnonzero(n)
            return at.tolist(), n[at].tolist()

        return f

    got = map_arrow(df.select("text"), "cell int, n long", start).groupBy("cell").agg(F.sum("n").alias("n")).collect()
    return {r["cell"]: r["n"] for r in got}


@dataclass
class Model:
    lm: CharModel
    weight: dict[str, float]
    bias: float


def _fit(rows: list[tuple[int, list[int]]], n_features: int, l2: float = 1e-4, steps: int = 300) -> tuple[np.ndarray, float]:
    """Logistic regression over binary features by gradient steps with momentum."""
    y = np.array([r[0] for r in rows], float)
    who = np.repeat(np.arange(len(rows)), [len(r[1]) for r in rows])
    what = np.array([k for r in rows for k in r[1]], np.int64)
    w, b = np.zeros(n_features), math.log((y.sum() + 0.5) / (len(y) - y.sum() + 0.5))
    vw, vb, rate = np.zeros_like(w), 0.0, 1.0
    df = np.bincount(what, minlength=n_features) + 1.0
    for _ in range(steps):
        z = b + np.bincount(who, w[what], len(rows))
        g = 1 / (1 + np.exp(-np.clip(z, -30, 30))) - y
        gw = np.bincount(what, g[who], n_features) / df + l2 * w
        vw = 0.9 * vw - rate * 0.3 * gw
        vb = 0.9 * vb - rate * 0.3 * g.mean()
        w, b = w + vw, b + vb
    return w, b


def train(docs: DataFrame, labels: DataFrame, held_out_of: int = 5, max_labelled: int = 20_000, max_features: int = 4096, min_docs: int = 3) -> Model:
    """docs: doc_id, text. labels: doc_id, toxic."""
    lm = CharModel.of(char_counts(docs))
    usable = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic")).where("toxic IN (0, 1)").where(crc_mod(F.col("doc_id"), held_out_of) != 0)
    n = usable.count()
    # An expected max_labelled rows at most: a bounded sample, sent to the executors as ids.
    sample = usable.where(F.pmod(F.xxhash64("doc_id"), F.lit(max(n, 1))) < max_labelled)
    mine = docs.join(F.broadcast(sample), "doc_id").select("toxic", "text")

    def count():
        r = Restorer(lm)

        def f(toxic, texts):
            seen: dict[str, list[int]] = {}
            for y, t in zip(toxic, texts):
                for x in {x for w in r.words(t) for x in features(w)}:
                    seen.setdefault(x, [0, 0])[y] += 1
            return list(seen), [v[0] for v in seen.values()], [v[1] for v in seen.values()]

        return f

    counted = map_arrow(mine, "feature string, clean long, toxic long", count).groupBy("feature").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
    both = {r["toxic"]: r["n"] for r in mine.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    if not both.get(0) or not both.get(1):
        share = both.get(1, 0) / max(1, sum(both.values()))
        return Model(lm, {}, math.log(max(share, 1e-12) / max(1 - share, 1e-12)))
    odds = F.log((F.col("toxic") + 0.5) / (both[1] + 1)) - F.log((F.col("clean") + 0.5) / (both[0] + 1))
    best = counted.where(F.col("toxic") + F.col("clean") >= min_docs).withColumn("gain", F.abs(odds) * F.greatest(F.col("toxic") / both[1], F.col("clean") / both[0])).where(F.abs(odds) > 1.0)
    chosen = [r["feature"] for r in best.orderBy(F.desc("gain"), "feature").limit(max_features).collect()]
    index = {x: k for k, x in enumerate(chosen)}

    def pick():
        hits = Hits(lm, index)
        return lambda toxic, texts: (toxic, [sorted(index[x] for x in hits(t)) for t in texts])

    rows = [(r["toxic"], r["ids"]) for r in map_arrow(mine, "toxic int, ids array<int>", pick).collect()]
    w, b = _fit(sorted(rows), len(chosen))
    return Model(lm, {x: float(w[k]) for x, k in index.items()}, float(b))


class Hits:
    """Those of the given features that a text's words have: the features of all words that its tokens may be read as.

    The letters that a token begins with, up to and with the first doubled one, begin all its readings, and if they are four or more these are
    single words. So a token is only decoded if one of the features goes on where these letters end; shorter ones are settled by them."""

    def __init__(self, lm: CharModel, wanted, most: int = 200_000):
        self.restorer, self.wanted, self.most = Restorer(lm), wanted, most
        self.known, self.without = {}, set()  # tokens with features, and those that have none
        self.heads: dict[str, list[str]] = {}  # a word has no feature that begins with other four characters than it does
        for x in wanted:
            self.heads.setdefault(x[:4], []).append(x)

    def of(self, words) -> tuple[str, ...]:
        return tuple(x for w in words if w[:4] in self.heads for x in features(w) if x in self.wanted)

    def token(self, token: str) -> tuple[str, ...]:
        if (h := self.known.get(token)) is None:
            wide = token.strip(_PLAIN_EDGE)
            n = _STEADY.match(wide).end()
            near, steady = self.heads.get(wide[:4], ()), wide[:n]
            if n >= 4 and not near:
                h = ()
            elif n >= 4 and n == len(wide):
                h = tuple([x for x in features(wide) if x in self.wanted])
            elif n >= 4 and not any(x.startswith(steady) for x in near):
                h = tuple(x for k in PREFIXES if k < n and (x := f"{steady[:k]}*") in self.wanted)
            else:
                h = self.of(w for x in self.restorer.readings(token) for w in x.split())
            if len(self.known) + len(self.without) >= self.most:
                self.known.clear()
                self.without.clear()
            if h:
                self.known[token] = h
            else:
                self.without.add(token)
        return h

    def __call__(self, text: str) -> set[str]:
        low, found = text.lower(), set()
        for t in set(low.split()) - self.without:
            found.update(self.token(t))
        found.update(self.of(self.restorer.spaced(low)))
        return found


class Scorer:
    def __init__(self, model: Model):
        self.model, self.hits = model, Hits(model.lm, model.weight)

    def __call__(self, text: str) -> float:
        z = self.model.bias + sum(self.model.weight[x] for x in sorted(self.hits(text)))
        return 1 / (1 + math.exp(-max(-700.0, min(700.0, z))))


SCHEMA = "doc_id long, held_out boolean, score double, predicted int"


def score(docs: DataFrame, model: Model, held_out_of: int = 5) -> DataFrame:
    """One row per row of docs."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def start():
        scorer = Scorer(sent.value)

        def f(ids, texts, held):
            out = [scorer(t) for t in texts]
            return ids, held, out, [int(s >= 0.5) for s in out]

        return f

    return map_arrow(docs.select("doc_id", "text", (crc_mod(F.col("doc_id"), held_out_of) == 0).alias("held_out")), SCHEMA, start)


def detect(df: DataFrame, labels: DataFrame, **how) -> DataFrame:
    """Trains on the labelled rows of df and scores all its rows."""
    docs = keyed_text(df)
    return score(docs, train(docs, labels, **how))


def keep_clean(df: DataFrame, labels: DataFrame, **how) -> DataFrame:
    """The rows of df that score below 0.5."""
    sent = df.sparkSession.sparkContext.broadcast(train(keyed_text(df), labels, **how))

    def start():
        scorer = Scorer(sent.value)
        return lambda texts: ([scorer(t) < 0.5 for t in texts], texts)

    return map_whole(df, start)
