"""Quality rules, line first.

Every line of a text is judged by three kinds of rule (punctuation, navigation, boilerplate). Lines that fail are
removed; a document is rejected when it loses too much of its text that way. Document-level counts are taken from the
whole, uncleaned text.

Defined results: a null text is an empty one (0 words, so it fails the base rule); a text without a line that fails is
returned unchanged; repeated rows are judged each for itself; an empty table gives an empty table.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import DataFrame

from prosopon.llm.common import ASCII_SPACE, keyed_text, map_arrow, map_whole, utf8

SYMBOLS = "#*$%&|<>"

#: Phrases that mark a short line as page furniture, and menu entries, in English, German, French and Spanish.
BOILERPLATE = (
    "all rights reserved", "cookie policy", "accept cookies", "privacy policy", "terms of use", "terms of service",
    "subscribe to our", "sign up for our", "enable javascript", "powered by", "share this", "follow us", "licensed under",
    "alle rechte vorbehalten", "cookies akzeptieren", "cookie-richtlinie", "datenschutzerklärung", "nutzungsbedingungen",
    "newsletter abonnieren", "javascript aktivieren", "bereitgestellt von", "artikel teilen", "folgen sie uns",
    "tous droits réservés", "accepter les cookies", "politique de cookies", "politique de confidentialité", "conditions d'utilisation",
    "mentions légales", "abonnez-vous à", "activer javascript", "propulsé par", "partager cet article", "suivez-nous",
    "todos los derechos reservados", "aceptar cookies", "política de cookies", "política de privacidad", "condiciones de uso",
    "aviso legal", "suscríbete a", "activar javascript", "con la tecnología de", "compartir este", "síguenos",
)
NAVIGATION = (
    "home", "about", "about us", "contact", "contact us", "login", "log in", "sign in", "sign up", "register", "menu", "search", "next", "previous", "read more", "back to top", "skip to content", "sitemap", "faq",
    "startseite", "über uns", "kontakt", "impressum", "anmelden", "registrieren", "menü", "suche", "suchen", "weiter", "zurück", "mehr lesen", "weiterlesen", "nach oben", "zum inhalt springen",
    "accueil", "à propos", "contactez-nous", "connexion", "se connecter", "s'inscrire", "recherche", "rechercher", "suivant", "précédent", "lire la suite", "haut de page", "aller au contenu", "plan du site",
    "inicio", "acerca de", "sobre nosotros", "contacto", "iniciar sesión", "registrarse", "menú", "buscar", "siguiente", "anterior", "leer más", "volver arriba", "ir al contenido", "mapa del sitio",
)
#: What a sentence, a heading or a list may end with.
CLOSING = ".!?…:;,\"'»”’)]}。！？"
SEPARATORS = re.compile(r"[|»›>•·/]+")


@dataclass(frozen=True)
class LineRules:
    """Punctuation: a line with too many other marks, or a short one that ends with no closing mark. Navigation: a menu entry, or several
    between separators. Boilerplate: a short line with one of the phrases. max_loss: largest share of the non-space characters that failing lines may hold. max_symbols: largest share of a line's
    non-space characters that are neither letters, digits nor ordinary punctuation. nav_items: separated items that make a
    navigation line. short: words up to which a line can be boilerplate."""

    max_loss: float = 0.5
    max_symbols: float = 0.3
    nav_items: int = 4
    short: int = 15


_PLAIN = re.compile(r"[\w\s.,;:!?'\"()\-]", re.UNICODE)


def line_fault(line: str, rules: LineRules) -> str | None:
    """The rule that a line fails, if any. Blank lines pass."""
    bare = line.strip(ASCII_SPACE)
    if not bare:
        return None
    odd = _PLAIN.sub("", bare)
    if odd or not any(c.isalnum() for c in bare):
        seen = len("".join(bare.split()))
        if len(odd) > rules.max_symbols * seen or not any(c.isalnum() for c in bare):
            return "punctuation"
        items = [x for x in SEPARATORS.split(bare) if x.strip()]
        entries = len(items) > 1 and all(x.strip(" .:").lower() in NAVIGATION for x in items)
        if entries or len(items) >= rules.nav_items and len(bare.split()) <= 4 * len(items):
            return "navigation"
    if len(bare) <= 12 * rules.short and len(bare.split()) <= rules.short:
        low = bare.lower()
        if low.strip(" .:") in NAVIGATION:
            return "navigation"
        if any(p in low for p in BOILERPLATE):
            return "boilerplate"
        if bare[-1] not in CLOSING:
            return "punctuation"
    return None


def clean_lines(text: str, rules: LineRules) -> tuple[str, float]:
    """The text without failing lines, and the share of non-space characters lost."""
    kept, lost, total = [], 0, 0
    for line in text.split("\n"):
        n = len("".join(line.split()))
        total += n
        if line_fault(line, rules):
            lost += n
        else:
            kept.append(line)
    return ("\n".join(kept) if lost else text), (lost / total if total else 0.0)


def counts(text: str) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words of a whole text."""
    raw = utf8(text)
    words = raw.split()
    chars = len(text) - sum(map(text.count, ASCII_SPACE))
    seen: set[bytes] = set()
    dup = 0
    for line in raw.split(b"\n"):
        if line in seen:
            dup += 1
        elif line.strip():
            seen.add(line)
    marks, first = bytearray(len(words)), {}
    for i, window in enumerate(zip(words, words[1:], words[2:])):
        j = first.setdefault(window, i)
        if j != i:
            marks[i : i + 3] = marks[j : j + 3] = b"\1\1\1"
    return len(words), chars, sum(map(text.count, SYMBOLS)), dup, sum(marks)


SCHEMA = (
    "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "base_failed boolean, kept boolean, lost_share double, cleaned string"
)


def verdict(text: str, rules: LineRules, min_words: int, max_repeat_percent: int) -> tuple:
    """The counts, whether the base rule fails, whether the text is kept, the share lost and the cleaned text."""
    c = counts(text)
    bad = c[0] < min_words or 100 * c[4] > max_repeat_percent * c[0]
    cleaned, lost = clean_lines(text, rules)
    return (*c, bad, not bad and lost <= rules.max_loss, lost, cleaned)


def judge(df: DataFrame, rules: LineRules = LineRules(), min_words: int = 50, max_repeat_percent: int = 50, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: counts, verdict and the cleaned text."""

    def start():
        return lambda ids, texts: list(zip(*((i, *verdict(t, rules, min_words, max_repeat_percent)) for i, t in zip(ids, texts))))

    return map_arrow(keyed_text(df, id_col, text_col), SCHEMA, start)


def keep_good(df: DataFrame, rules: LineRules = LineRules(), min_words: int = 50, max_repeat_percent: int = 50) -> DataFrame:
    """The rows of df whose texts are kept, with cleaned texts."""

    def start():
        def f(texts):
            out = [verdict(t, rules, min_words, max_repeat_percent) for t in texts]
            return [x[6] for x in out], [x[8] for x in out]

        return f

    return map_whole(df, start)
