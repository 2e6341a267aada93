"""JSON documents of any size, read by many tasks.

The text source deals a file out by closing braces, so a document on a single line has many rows too. Whether a split begins inside a string,
and inside which brackets, is only known once all before it have been read: the first pass reduces each split, in both states, to
what it closes of the brackets before it and what it leaves open. These are composed over the splits of a file. The second pass cuts each split,
from the state that is now known, into entries of the lists that stand directly in the top-level object, and the skeleton around
them. Entries that reach over a split's end are brought together by their number. Every entry is parsed for itself, and the skeleton, with a
number in place of each list's entries: the first fault of a document lies in one of them, so the whole is valid if and only if all are.

Defined results: those of files.json_scan(), entry by entry. A document that is not UTF-8, not JSON (wherever the fault is) or without a
top-level list `candidates` is an error and has no entries; an empty list has none either. What is not an entry of such a list is
held by one task; an entry, as a variant, must be below 16 MB.
"""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from prosopon.operators.durable import drop_table, write_table
from prosopon.operators.workers import ship
from prosopon.sources.files import bare

_ESCAPED = re.compile(r"\\.", re.S)
_NOT_BRACKET = re.compile(r"[^][{}]+")
_TOKEN = re.compile(r'"(?:[^"\\]|\\.)*+"?|[][{},]', re.S)
_REST_OF_STRING = re.compile(r'(?:[^"\\]|\\.)*+"?', re.S)
#: Stands in a skeleton for the entries of a list; no valid document has it.
_LIST = "\x00"


def json_parts(spark: SparkSession, files: DataFrame, paths: list[str]) -> DataFrame:
    """file_ord, name, size (of the file), start (of the split), at (order inside it), part (bytes before a closing brace).
    files: file_ord, given (a path), name."""
    m = F.col("_metadata")
    raw = spark.read.option("lineSep", "}").text(paths).select(F.url_decode(F.replace(m["file_path"], F.lit("+"), F.lit("%2B"))).alias("path"), m["file_size"].alias("size"), m["file_block_start"].alias("start"), F.monotonically_increasing_id().alias("at"), F.col("value").cast("binary").alias("part"))
    return raw.join(F.broadcast(files), bare(F.col("path")) == bare(F.col("given"))).select("file_ord", "name", "size", "start", "at", "part")


def _rows(batches):
    for b in batches:
        names = b.schema.names
        for r in zip(*(c.to_pylist() for c in b.columns)):
            yield dict(zip(names, r))


def _reduced(closed: int, opened: str, brackets: str) -> tuple[int, str]:
    """What a run of brackets closes of those before it, and leaves open, after what did so until here."""
    for b in brackets:
        if b in "{[":
            opened += b
        elif opened:
            opened = opened[:-1]
        else:
            closed += 1
    return closed, opened


_WALK = "file_ord int, start long, bytes long, size long, utf8 boolean, turns boolean, closed0 int, opened0 string, closed1 int, opened1 string"


def _schema(ddl: str) -> pa.Schema:
    kinds = {"int": pa.int32(), "long": pa.int64(), "string": pa.string(), "boolean": pa.bool_()}
    return pa.schema([(k, kinds[t]) for k, t in (x.split(" ") for x in ddl.split(", "))])


def _walk(batches):
    """Each split, from outside (0) and inside (1) a string. A split's parts come together and in order."""
    now = None
    done = lambda: pa.RecordBatch.from_pylist([now | {f"{c}{s}": v for s in (0, 1) for c, v in zip(("closed", "opened"), ends[s])}], _schema(_WALK))
    for r in _rows(batches):
        if now is None or (r["file_ord"], r["start"]) != (now["file_ord"], now["start"]):
            if now is not None:
                yield done()
            now, ends = {k: r[k] for k in ("file_ord", "start", "size")} | {"bytes": 0, "utf8": True, "turns": False}, [(0, ""), (0, "")]
        now["bytes"] += len(r["part"]) + 1
        try:
            runs = _ESCAPED.sub("", r["part"].decode() + "}").split('"')
        except UnicodeDecodeError:
            now["utf8"] = False
            continue
        for s in (0, 1):
            ends[s] = _reduced(*ends[s], _NOT_BRACKET.sub("", "".join(runs[s ^ now["turns"] :: 2])))
        now["turns"] ^= len(runs) % 2 == 0
    if now is not None:
        yield done()


def _compose(splits: pa.Table) -> pa.Table:
    """The state in which each split of one file begins: inside a string, the brackets that are open; cut: no brace ends the file; mark: the source
    left out a byte order mark, which JSON does not have."""
    rows = sorted(splits.to_pylist(), key=lambda r: r["start"])
    total, size = sum(r["bytes"] for r in rows), rows[0]["size"]
    cut, mark = total > size, total < size
    inside, stack, out = False, "", []
    for k, r in enumerate(rows):
        out.append({"file_ord": r["file_ord"], "start": r["start"], "inside": inside, "stack": stack, "cut": cut and k == len(rows) - 1, "utf8": all(x["utf8"] for x in rows), "mark": mark})
        s = int(inside)
        stack = stack[: max(0, len(stack) - r[f"closed{s}"])] + r[f"opened{s}"]
        inside ^= r["turns"]
    return pa.Table.from_pylist(out, _schema(_BEGIN))


_BEGIN = "file_ord int, start long, inside boolean, stack string, cut boolean, utf8 boolean, mark boolean"
_CUT = "file_ord int, name string, start long, list int, entry long, whole boolean, skeleton boolean, seq long, text string"


def _cut(batches):
    """Entries (list: how many lists began in the split before, 0 for one that was open; entry: commas in it since), and skeleton."""
    schema, out, key = _schema(_CUT), [], None

    def put(kind: str, whole: bool = True) -> None:
        text = "".join(held)
        held.clear()
        if text or kind == "entry":
            out.append({"file_ord": key[0], "name": name, "start": key[1], "list": lists, "entry": commas, "whole": whole, "skeleton": kind == "skeleton", "seq": seq, "text": text})

    def close() -> None:
        put("entry" if stack.startswith("{[") else "skeleton", False)

    for r in _rows(batches):
        if (r["file_ord"], r["start"]) != key:
            if key is not None:
                close()
                if len(out) > 1000:
                    yield pa.RecordBatch.from_pylist(out, schema)
                    out.clear()
            key, name, inside, stack, held, lists, commas, seq, begun = (r["file_ord"], r["start"]), r["name"], r["inside"], r["stack"], [], 0, 0, 0, False
        text = r["part"].decode()
        text += "" if r["cut"] and r["last"] else "}"
        at = begin = 0
        if inside:
            m = _REST_OF_STRING.match(text)
            inside, begin = not _ESCAPED.sub("", m.group()).endswith('"'), m.end()
        for m in _TOKEN.finditer(text, begin):
            x = m.group()
            if x[0] == '"':
                plain = _ESCAPED.sub("", x)
                inside = len(plain) < 2 or plain[-1] != '"'
                continue
            in_list = stack == "{["
            if x == ",":
                if in_list:
                    held.append(text[at : m.start()])
                    put("entry", begun)
                    commas, begun, at = commas + 1, True, m.end()
                continue
            if x in "{[":
                stack += x
                if stack == "{[":
                    held.append(text[at : m.end()].replace(_LIST, "\x01") + _LIST)
                    put("skeleton")
                    lists, commas, begun, at, seq = lists + 1, 0, True, m.end(), seq + 1
            else:
                if in_list:
                    held.append(text[at : m.start()])
                    put("entry", begun)
                    at = m.start()
                    seq += 1
                stack = stack[:-1]
        held.append(text[at:] if stack.startswith("{[") else text[at:].replace(_LIST, "\x01"))
        if len(out) > 1000:
            yield pa.RecordBatch.from_pylist(out, schema)
            out.clear()
    if key is not None:
        close()
    if out:
        yield pa.RecordBatch.from_pylist(out, schema)


def _skeletons(parts: pa.Table) -> pa.Table:
    """The skeleton of one file, lists numbered."""
    rows = sorted(parts.to_pylist(), key=lambda r: (r["start"], r["seq"]))
    text = "".join(r["text"] for r in rows)
    first, *more = text.split(_LIST)
    return pa.table({"file_ord": pa.array([rows[0]["file_ord"]], pa.int32()), "text": [first + "".join(f"{k}{x}" for k, x in enumerate(more))]})


def json_split_scan(parts: DataFrame, files: DataFrame) -> DataFrame:
    """file_ord, name, ok, error, pos, e: a row for every file (pos null) and for every entry of the good ones (e: a variant).
    parts: of json_parts(); files: file_ord, name."""
    ship(parts.sparkSession)
    order = ["file_ord", "start", "at"]
    # A split is read by one task, in order: the first pass needs no shuffle.
    walked = write_table(parts.mapInArrow(_walk, _WALK), "walked")
    begins = write_table(walked.groupBy("file_ord").applyInArrow(_compose, _BEGIN), "splits")
    split = Window.partitionBy("file_ord", "start").orderBy("at")
    known = parts.join(begins.where("utf8").drop("utf8", "mark"), ["file_ord", "start"]).withColumn("last", F.lead("at").over(split).isNull())
    cut = write_table(known.sortWithinPartitions(*order).mapInArrow(_cut, _CUT), "json-cut")  # dealt by split already
    # Lists and commas before each split: those of a list that is still open count on.
    spans = cut.groupBy("file_ord", "start").agg(F.max("list").alias("lists"), F.max_by("entry", F.struct("list", "entry")).alias("commas"))
    file = Window.partitionBy("file_ord").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    spans = spans.withColumn("lists_before", F.coalesce(F.sum("lists").over(file), F.lit(0)))
    same = Window.partitionBy("file_ord", "list_after").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    spans = spans.withColumn("list_after", F.col("lists_before") + F.col("lists"))
    spans = spans.withColumn("run", F.sum("commas").over(same.rowsBetween(Window.unboundedPreceding, 0)))
    spans = spans.withColumn("commas_before", F.coalesce(F.lag("run").over(Window.partitionBy("file_ord").orderBy("start")), F.lit(0)))
    # Written, so that its size is known: a row for each split, sent to the entries where that is small.
    spans = write_table(spans.select("file_ord", "start", "lists_before", "commas_before"), "spans")
    entries = cut.where("NOT skeleton").join(spans, ["file_ord", "start"])
    entries = entries.select(
        "file_ord", "start", "whole", "text", (F.col("lists_before") + F.col("list") - 1).alias("list"),
        (F.col("entry") + F.when(F.col("list") == 0, F.col("commas_before")).otherwise(0)).alias("pos"),
    )
    torn = entries.where("NOT whole").groupBy("file_ord", "list", "pos").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("start", "text"))), lambda x: x["text"]), "").alias("text"))
    every = entries.where("whole").select("file_ord", "list", "pos", "text").unionByName(torn)
    # In brackets, so that two values without a comma between them are a fault; an empty list has one blank entry.
    every = every.withColumn("v", F.try_parse_json(F.concat(F.lit("["), "text", F.lit("]")))).withColumn("v", F.expr("try_variant_get(v, '$', 'array<variant>')"))
    every = write_table(every.select("file_ord", "list", "pos", F.coalesce(F.size("v"), F.lit(-1)).alias("n"), F.get("v", F.lit(0)).alias("e")), "json-entries")
    faults = every.groupBy("file_ord", "list").agg(F.count("*").alias("entries"), F.count_if(F.col("n") != 1).alias("bad"), F.min("n").alias("n"))
    faults = faults.groupBy("file_ord").agg(F.max((F.col("bad") > 0) & ~((F.col("entries") == 1) & (F.col("n") == 0))).alias("faulty"))
    whole = cut.where("skeleton").groupBy("file_ord").applyInArrow(_skeletons, "file_ord int, text string").select("file_ord", F.try_parse_json("text").alias("v"))
    at = "try_variant_get(v, '$.candidates', 'variant')"
    listed = F.coalesce(F.expr("schema_of_variant(v)").startswith("OBJECT") & F.expr(f"schema_of_variant({at})").startswith("ARRAY"), F.lit(False))
    whole = whole.select("file_ord", F.col("v").isNotNull().alias("valid"), listed.alias("listed"), F.expr("try_variant_get(v, '$.candidates[0]', 'int')").alias("list"))
    state = files.select("file_ord", "name").join(begins.groupBy("file_ord").agg(F.min("utf8").alias("utf8"), F.max("mark").alias("mark")), "file_ord", "left").join(whole, "file_ord", "left").join(faults, "file_ord", "left")
    error = F.when(~F.coalesce("utf8", F.lit(True)), "failed to decode as UTF-8").when(~F.coalesce("valid", F.lit(False)) | F.coalesce("faulty", F.lit(False)) | F.col("mark"), "failed to parse JSON").when(~F.col("listed"), "expected top-level 'candidates' list, found none")
    state = write_table(state.select("file_ord", "name", "list", error.alias("error")), "json-files")
    for t in (walked, begins, cut, spans):
        drop_table(t)
    rows = every.where("n = 1").join(state.where("error IS NULL").select("file_ord", "name", "list"), ["file_ord", "list"])
    rows = rows.select("file_ord", "name", F.lit(True).alias("ok"), F.lit(None).cast("string").alias("error"), F.col("pos").cast("int").alias("pos"), "e")
    return rows.unionByName(state.select("file_ord", "name", F.col("error").isNull().alias("ok"), "error", F.lit(None).cast("int").alias("pos"), F.lit(None).cast("variant").alias("e")))
