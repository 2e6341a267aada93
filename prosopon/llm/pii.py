"""Personal data by anchor expansion.

One Aho-Corasick automaton walks the text in lower case and reports anchors: at-signs, plus signs, digits, URL schemes, words that
introduce an account number, and words and prefixes that introduce a secret. From each anchor a small deterministic parser expands to both sides, finds the boundaries and
validates (labels of a domain, parts of an address, digit counts, Luhn).

Kinds: email, ip, card, phone (the base kinds: leftmost, not overlapping within a kind, failing matches dropped without a
retry), and three that the anchors add: url (scheme or www. to the end of the run), account (a cue such as "IBAN" or
"account no." followed by an identifier with at least four digits) and secret (a cue such as "token" with an assignment sign, or a known
prefix, and a run of at least 16 letters and digits of both kinds). Spans are code points, end exclusive.

Defined results: a null text is empty and has no spans; ties in start are ordered by kind as listed; repeated rows are
treated each for itself; an empty table gives an empty table.
"""

from __future__ import annotations

import hashlib
import re

from pyspark.sql import DataFrame

from prosopon.llm.common import keyed_text, map_arrow, map_whole

KINDS = ("email", "ip", "card", "phone", "url", "account", "secret")
BASE = 4

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_LABEL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789-")
_DIGIT = frozenset("0123456789")
_PHONE = frozenset(" ().0123456789-")
#: What introduces an account or identity number.
CUES = ("account number", "account no", "account", "acct", "iban", "passport", "ssn", "social security", "tax id")
#: What introduces a secret, and how well-known keys begin.
SECRET_CUES = ("token", "secret", "password", "passwd", "api_key", "api-key", "apikey", "access_key", "private_key", "bearer")
SECRET_PREFIXES = ("sk_live_", "sk_test_", "pk_live_", "rk_live_", "ghp_", "gho_", "github_pat_", "glpat-", "xoxb-", "xoxp-", "akia", "aiza")
_AFTER_SECRET = re.compile(r"[\w-]{0,12}[\"']?[ \t]{0,3}(?:[:=]{1,2}|[ \t]is|[ \t])[ \t]{0,3}[\"']?([A-Za-z0-9_+/.\-]{16,}={0,2})")
_KEY = re.compile(r"[A-Za-z0-9_-]{12,}")
_AFTER_CUE = re.compile(r"[ \t]{0,3}(?:number|no\.?|is)?[ \t]{0,3}[:#=]?[ \t]{0,3}([A-Za-z]{0,4}[0-9][A-Za-z0-9]{0,33}(?:[ -][A-Za-z]{0,4}[0-9][A-Za-z0-9]{0,33}){0,9})(?![A-Za-z0-9])")
_URL_END = re.compile(r"[\s<>\"'`|\\^{}]")


def _automaton():
    import ahocorasick

    a = ahocorasick.Automaton()
    for c in _DIGIT:
        a.add_word(c, ("d", 1))
    a.add_word("@", ("@", 1))
    a.add_word("+", ("+", 1))
    for s in ("http://", "https://", "ftp://", "www."):
        a.add_word(s, ("u", len(s)))
    for kind, words in (("a", CUES), ("s", SECRET_CUES), ("k", SECRET_PREFIXES)):
        for s in words:
            a.add_word(s, (kind, len(s)))
    a.make_automaton()
    return a


_LOWER = {k: k + 32 for k in range(65, 91)}


def _lowered(text: str) -> str:
    """In lower case, every character at its place."""
    low = text.lower()
    return low if len(low) == len(text) else text.translate(_LOWER)


def _mixed(x: str) -> bool:
    return any(c in _DIGIT for c in x) and any(c.isalpha() for c in x)


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if k % 2:
            d = d * 2 - 9 if d > 4 else d * 2
        total += d
    return total % 10 == 0


def _email(t: str, at: int, low: int) -> tuple[int, int] | None:
    s = at
    while s > low and t[s - 1] in _LOCAL:
        s -= 1
    e, n, dots = at + 1, len(t), 0
    while e < n and t[e] in _LABEL:
        e += 1
    if s == at or e == at + 1:
        return None
    while e + 1 < n and t[e] == "." and t[e + 1] in _LABEL:
        e += 2
        dots += 1
        while e < n and t[e] in _LABEL:
            e += 1
    return (s, e) if dots else None


def _run(t: str, i: int) -> int:
    n = len(t)
    while i < n and t[i] in _DIGIT:
        i += 1
    return i


def _ip(t: str, s: int, e: int) -> tuple[int, bool] | None:
    """From a run of digits s:e; the end and whether all parts are at most 255."""
    parts, n = [t[s:e]], len(t)
    for _ in range(3):
        if e + 1 >= n or t[e] != "." or t[e + 1] not in _DIGIT:
            return None
        b = e + 1
        e = _run(t, b)
        parts.append(t[b:e])
    return e, all(len(p := x.lstrip("0")) <= 3 and int(p or 0) <= 255 for x in parts)


def _card(t: str, s: int) -> int:
    e, n = s + 1, len(t)
    while e < n:
        if t[e] in _DIGIT:
            e += 1
        elif t[e] in " -" and e + 1 < n and t[e + 1] in _DIGIT:
            e += 2
        else:
            break
    return e


def _phone(t: str, s: int) -> int | None:
    n = len(t)
    if s + 1 >= n or t[s + 1] not in _DIGIT:
        return None
    e = s + 2
    last = -1
    while e < n and t[e] in _PHONE:
        if t[e] in _DIGIT:
            last = e
        e += 1
    return last + 1 if last >= s + 3 else None


def find_spans(text: str, automaton) -> list[tuple[int, int, int]]:
    """(start, kind, end), by start and then kind."""
    out: list[tuple[int, int, int]] = []
    email_at = ip_at = card_at = phone_at = url_at = account_at = secret_at = run_end = 0
    for last, (what, size) in automaton.iter(_lowered(text)):
        i = last - size + 1
        if what == "d":
            if i < run_end:
                continue
            run_end = _run(text, i)
            if i >= ip_at and (m := _ip(text, i, run_end)):
                ip_at = m[0]
                if m[1]:
                    out.append((i, 1, ip_at))
            if i >= card_at and (e := _card(text, i)) > i + 1:
                card_at = e
                digits = text[i:e].replace(" ", "").replace("-", "")
                if 14 <= len(digits) <= 19 and luhn(digits):
                    out.append((i, 2, e))
        elif what == "@":
            if i >= email_at and (m := _email(text, i, email_at)):
                email_at = m[1]
                out.append((m[0], 0, m[1]))
        elif what == "+":
            if i >= phone_at and (e := _phone(text, i)):
                phone_at = e
                if 10 <= sum(c in _DIGIT for c in text[i:e]) <= 15:
                    out.append((i, 3, e))
        elif what == "u":
            if i >= url_at and (i == 0 or not text[i - 1].isalnum()):
                m = _URL_END.search(text, last + 1)
                e = m.start() if m else len(text)
                while e > last + 1 and text[e - 1] in ".,;:!?)":
                    e -= 1
                if e > last + 1:
                    url_at = e
                    out.append((i, 4, e))
        elif what == "s":
            m = _AFTER_SECRET.match(text, last + 1)
            if m and m.start(1) >= secret_at and _mixed(m[1]):
                secret_at = m.end(1)
                out.append((m.start(1), 6, secret_at))
        elif what == "k":
            m = _KEY.match(text, last + 1)
            if i >= secret_at and m and (i == 0 or not text[i - 1].isalnum()) and _mixed(m[0]):
                secret_at = m.end()
                out.append((i, 6, secret_at))
        elif i >= account_at and (i == 0 or not text[i - 1].isalnum()):
            m = _AFTER_CUE.match(text, last + 1)
            if m and sum(c in _DIGIT for c in m[1]) >= 4:
                account_at = m.end(1)
                out.append((m.start(1), 5, m.end(1)))
    out.sort()
    return out


def as_text(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)


def redact(text: str, spans: list[tuple[int, int, int]]) -> str:
    """Each covered stretch becomes <KIND> of the span that starts first; a span that reaches further extends it."""
    out, at, k = [], 0, 0
    while k < len(spans):
        s, kind, e = spans[k]
        k += 1
        while k < len(spans) and spans[k][0] < e:
            e = max(e, spans[k][2])
            k += 1
        out += [text[at:s], f"<{KINDS[kind].upper()}>"]
        at = e
    return "".join([*out, text[at:]])


SCHEMA = "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, n_url long, n_account long, n_secret long, redacted string"


def scan(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: counts and spans of each kind, and the redacted text."""

    def start():
        a = _automaton()

        def f(ids, texts):
            out = []
            for i, t in zip(ids, texts):
                found = find_spans(t, a)
                n = [0] * len(KINDS)
                for x in found:
                    n[x[1]] += 1
                base = as_text([x for x in found if x[1] < BASE])
                out.append((i, *n[:BASE], hashlib.sha256(base.encode()).hexdigest(), as_text(found), *n[BASE:], redact(t, found)))
            return list(zip(*out))

        return f

    return map_arrow(keyed_text(df, id_col, text_col), SCHEMA, start)


def redacted(df: DataFrame) -> DataFrame:
    """df with redacted texts."""

    def start():
        a = _automaton()
        return lambda texts: ([True] * len(texts), [redact(t, find_spans(t, a)) for t in texts])

    return map_whole(df, start)
