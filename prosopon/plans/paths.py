"""Output paths such as emails[0] or skills[].name, compiled to Columns against a schema at plan time."""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, StructType


@dataclass(frozen=True)
class Token:
    """key, index or each (the brackets without a number)."""

    kind: str
    value: str | int | None = None


_TOKEN = re.compile(r"\.|(?P<key>[^.\[\]]+)|\[(?P<index>\d*)\]")


def tokenize(path: str) -> list[Token]:
    """Dots are skipped; at the first thing that is no token the path ends."""
    out, at = [], 0
    while m := _TOKEN.match(path, at):
        at = m.end()
        if m["key"]:
            out.append(Token("key", m["key"]))
        elif m["index"]:
            out.append(Token("index", int(m["index"])))
        elif m["index"] == "":
            out.append(Token("each"))
    return out


def compile_path(path: str, root: StructType) -> tuple[Column, DataType] | None:
    """The value at a path, null where a row lacks it, and its type; None if no row can have it."""
    tokens = tokenize(path)
    if not tokens or tokens[0].kind != "key" or tokens[0].value not in root.fieldNames():
        return None
    return _resolve(F.col(f"`{tokens[0].value}`"), root[tokens[0].value].dataType, tokens[1:])


def _resolve(c: Column, kind: DataType, tokens: list[Token]) -> tuple[Column, DataType] | None:
    if not tokens:
        return c, kind
    t, rest = tokens[0], tokens[1:]
    if t.kind == "key":
        if isinstance(kind, StructType) and t.value in kind.fieldNames():
            return _resolve(c.getField(t.value), kind[t.value].dataType, rest)
        return None
    if not isinstance(kind, ArrayType):
        return None
    if t.kind == "index":
        return _resolve(F.get(c, F.lit(t.value)), kind.elementType, rest)
    if not rest:
        return c, kind
    of: list[DataType] = []

    def element(x: Column) -> Column:
        got = _resolve(x, kind.elementType, rest)
        of[:] = [got[1]] if got else []
        return got[0] if got else F.lit(None).cast("string")

    mapped = F.filter(F.transform(c, element), lambda x: x.isNotNull())
    if not of:  # no element can have it: a list without elements
        return F.when(c.isNotNull(), F.array().cast("array<string>")), ArrayType(_string())
    return mapped, ArrayType(of[0])


def _string() -> DataType:
    from pyspark.sql.types import StringType

    return StringType()
