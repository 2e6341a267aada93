"""Shaping of canonical records by an output configuration, and the checks that it implies.

The configuration is compiled once, at plan time, into Columns: paths, normalizers and type checks cost nothing per row that
Catalyst does not see. Rows that fail become error rows.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from dataclasses import dataclass, field
from pathlib import Path

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, ByteType, DataType, DecimalType, DoubleType, FloatType, IntegerType, LongType, ShortType, StringType, StructType

from prosopon.functions.phones import normalize_phone
from prosopon.functions.text import normalize_date, normalize_skill
from prosopon.plans.paths import compile_path

#: Directives of `normalize`; register more here.
NORMALIZERS: dict[str, Callable[[Column], Column]] = {"e164": normalize_phone, "canonical": normalize_skill, "yyyy-mm": normalize_date, "date": normalize_date}


@dataclass(frozen=True)
class Field:
    path: str
    type: str = "string"
    required: bool = False
    source: str | None = None
    normalize: str | None = None

    @property
    def source_path(self) -> str:
        return self.path if self.source is None else self.source


@dataclass(frozen=True)
class Config:
    fields: list[Field] = field(default_factory=list)
    include_confidence: bool = True
    include_provenance: bool = True
    on_missing: str = "null"


def parse_config(spec: dict) -> Config:
    fields = [Field(f["path"], f.get("type", "string"), f.get("required", False), f.get("from"), f.get("normalize")) for f in spec.get("fields", [])]
    return Config(fields, spec.get("include_confidence", True), spec.get("include_provenance", True), spec.get("on_missing", "null"))


def load_config(path: str) -> Config:
    """FileNotFoundError if there is no such file, ValueError if it is not JSON."""
    if not Path(path).exists():
        raise FileNotFoundError(f"no such config: {path}")
    try:
        return parse_config(json.loads(Path(path).read_text(encoding="utf-8")))
    except (json.JSONDecodeError, OSError) as e:
        raise ValueError(f"config {path}: {e}") from e


#: Every field of a record under its own name.
DEFAULT_CONFIG = Config(
    [
        Field("full_name", "string"),
        Field("emails", "string[]"),
        Field("phones", "string[]"),
        Field("location", "object"),
        Field("links", "object"),
        Field("headline", "string"),
        Field("years_experience", "number"),
        Field("skills", "array"),
        Field("experience", "array"),
        Field("education", "array"),
    ]
)


def _normalized(c: Column, kind: DataType, directive: str | None) -> tuple[Column, DataType]:
    f = NORMALIZERS.get((directive or "").lower())
    if f is None:
        return c, kind
    if isinstance(kind, ArrayType):
        if isinstance(kind.elementType, (ArrayType, StructType)):
            return c, kind
        return F.transform(c, lambda x: F.when(x.isNotNull(), f(x.cast("string")))), ArrayType(StringType())
    if isinstance(kind, StructType):
        return c, kind
    return f(c.cast("string")), StringType()


@dataclass(frozen=True)
class _Compiled:
    name: str
    raw: Column
    value: Column
    kind: DataType
    spec: Field | None


def _compile(config: Config, root: StructType) -> list[_Compiled]:
    """The output's keys in order; of equal keys the first place and the last value."""
    out: dict[str, _Compiled] = {}
    for s in config.fields:
        raw, kind = compile_path(s.source_path, root) or (F.lit(None).cast("string"), StringType())
        value, kind = _normalized(raw, kind, s.normalize)
        out[s.path] = _Compiled(s.path, raw, value, kind, s)
    for name, on in (("overall_confidence", config.include_confidence), ("provenance", config.include_provenance)):
        if on:
            out[name] = _Compiled(name, F.col(name), F.col(name), root[name].dataType, None)
    return list(out.values())


_JSON = {"string": StringType, "number": (DoubleType, FloatType, DecimalType, IntegerType, LongType, ShortType, ByteType), "integer": (IntegerType, LongType, ShortType, ByteType), "boolean": BooleanType, "object": StructType, "array": ArrayType}


def type_violation(c: Column, kind: DataType, declared: str, nullable: bool) -> Column:
    """Whether a value that is present breaks its declared type. Unknown types allow anything; X[] has items of type X (unknown: string) and none that is null."""
    null = F.lit(False) if nullable else c.isNull()
    if declared.endswith("[]"):
        if not isinstance(kind, ArrayType):
            return c.isNotNull() | null
        item = isinstance(kind.elementType, _JSON.get(declared[:-2], StringType))
        return null | F.coalesce(F.exists(c, lambda x: x.isNull()) if item else F.size(c) > 0, F.lit(False))
    if declared not in _JSON:
        return F.lit(False)
    return null if isinstance(kind, _JSON[declared]) else c.isNotNull() | null


def project(records: DataFrame, config: Config) -> DataFrame:
    """The records with project_error (first missing field under the policy "error"), violation (first broken type) and document
    (the JSON object, keys in order)."""
    fields = _compile(config, records.schema)
    missing = lambda x: x.raw.isNull()
    strict = config.on_missing == "error"
    own = [x for x in fields if x.spec]
    no = F.lit(None).cast("string")
    error = F.coalesce(*(F.when(missing(x), F.lit(f"field '{x.name}' (from '{x.spec.source_path}') is missing")) for x in own), no) if strict else no
    nullable = config.on_missing == "null"
    broken = []
    for x in own:
        bad = type_violation(x.value, x.kind, x.spec.type, nullable)
        if config.on_missing == "omit":
            bad = bad & ~missing(x)
        broken.append(F.when(bad, F.lit(f"schema violation at '{x.name}'")))
    if config.include_confidence:
        broken.append(F.when(~F.col("overall_confidence").between(0.0, 1.0), F.lit("schema violation at 'overall_confidence'")))
    parts = [F.to_json(F.struct(x.value.alias(x.name)), {"ignoreNullFields": "false"}) for x in fields]
    kept = [F.when(~missing(x), p) if config.on_missing == "omit" and x.spec else p for x, p in zip(fields, parts)]
    inner = F.transform(F.filter(F.array(*kept), lambda j: j.isNotNull()), lambda j: F.substring(j, F.lit(2), F.length(j) - 2)) if fields else F.array().cast("array<string>")
    document = F.concat(F.lit("{"), F.array_join(inner, ","), F.lit("}"))
    return records.select("*", error.alias("project_error"), F.coalesce(*broken, no).alias("violation"), document.alias("document"))


def projected_columns(records: DataFrame, config: Config) -> DataFrame:
    """The same values as columns, for use in tables; a missing value is null."""
    return records.select("cluster_ord", *(x.value.alias(x.name) for x in _compile(config, records.schema)))
