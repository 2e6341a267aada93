"""CSV files of any size, read by many tasks.

The text source deals a file out by splits that begin at line breaks. Whether a split begins inside a quoted field is only known once
all before it have been read, so the first pass walks over each split in both states, outside and inside, and keeps for either
how it ends and how many rows end in it. These are composed over the splits of a file: the state by the last split whose end does not
depend on its begin and the changes since, row numbers by a running sum. The second pass parses each split from the state that
is now known. A row that reaches over a split's end is left in pieces, which are brought together by its number.

Rows, their numbers and columns are those of a reader that goes through the whole file: quotes open only at the begin of a field, line
breaks inside quotes belong to the field, lone carriage returns end rows, blank lines are no rows, of equal column names the last
counts, short rows lack their last columns, a byte order mark is accepted.

Defined results: an empty file, or one whose first line is blank, has no known column and is an error; so is one with bytes that are not
UTF-8, with a field above the csv module's limit, or whose header does not end in the first split. A file with an error has no rows. A quoted
field that is never closed ends with the file, a line break included.
"""

from __future__ import annotations

import csv
import io
import json

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from prosopon.operators.durable import write_table
from prosopon.operators.workers import ship
from prosopon.sources.files import bare

#: No text ends with this: a reader that is outside quotes makes it a row of its own.
_END = "\x00end\x00"


def csv_lines(spark: SparkSession, files: DataFrame, paths: list[str]) -> DataFrame:
    """file_ord, name, size (of the file), start (of the split), at (order inside it), line (bytes). files: file_ord, given (a path), name."""
    m = F.col("_metadata")
    raw = spark.read.option("lineSep", "\n").text(paths).select(F.url_decode(F.replace(m["file_path"], F.lit("+"), F.lit("%2B"))).alias("path"), m["file_size"].alias("size"), m["file_block_start"].alias("start"), F.monotonically_increasing_id().alias("at"), F.col("value").cast("binary").alias("line"))
    return raw.join(F.broadcast(files), bare(F.col("path")) == bare(F.col("given"))).select("file_ord", "name", "size", "start", "at", "line")


def _parsed(text: str) -> list[list[str]]:
    return list(csv.reader(io.StringIO(text, newline="")))


def _step(line: str, inside: bool) -> tuple[int, bool]:
    """How many rows end in a line that begins in this state, and the state after it."""
    if '"' not in line and "\r" not in line[:-1]:
        return (0, True) if inside else (int(line not in ("", "\r")), False)
    rows = _parsed(('"' if inside else "") + line + "\n" + _END)
    return sum(map(bool, rows[:-1])), rows[-1] != [_END]


def _splits(batches):
    """((file_ord, name, start, the other columns), iterator of lines) of each split, whose rows come together and in order."""
    now, at = None, None

    def rows():
        for b in batches:
            names = b.schema.names
            cols = [c.to_pylist() for c in b.columns]
            for r in zip(*cols):
                yield dict(zip(names, r))

    source = rows()
    held = next(source, None)

    def lines(key):
        nonlocal held
        first = held["start"] == 0
        while held is not None and (held["file_ord"], held["start"]) == key:
            now["bytes"] += len(held["line"]) + 1
            line = held["line"].decode()
            yield line.removeprefix("﻿") if first else line
            first, held = False, next(source, None)

    while held is not None:
        now = held | {"bytes": 0}
        at = (now["file_ord"], now["start"])
        own = lines(at)
        yield now, own
        while held is not None and (held["file_ord"], held["start"]) == at:  # what was not read
            held = next(source, None)


_WALK = "file_ord int, name string, start long, n0 long, end0 boolean, error0 string, n1 long, end1 boolean, error1 string, header string, bytes long, size long"


def _walk(batches):
    """Each split from both states; the header of a file's first split."""
    for r, lines in _splits(batches):
        n, state, error, head, open_head = [0, 0], [False, True], [None, None], None, []
        try:
            for line in lines:
                begun = state[0]
                for s in (0, 1):
                    if not error[s]:
                        try:
                            more, state[s] = _step(line, state[s])
                            n[s] += more
                        except csv.Error as e:
                            error[s] = str(e)
                if r["start"] == 0 and head is None and not error[0]:
                    open_head.append(line if not begun and not open_head else "\n" + line)
                    if not state[0]:
                        head = json.dumps((_parsed("".join(open_head)) or [[]])[0])
        except UnicodeDecodeError:
            error = ["not valid UTF-8"] * 2
        yield pa.RecordBatch.from_pylist([{"file_ord": r["file_ord"], "name": r["name"], "start": r["start"], "n0": n[0], "end0": state[0], "error0": error[0], "n1": n[1], "end1": state[1], "error1": error[1], "header": head, "bytes": r["bytes"], "size": r["size"]}], _schema(_WALK))


def _schema(ddl: str) -> pa.Schema:
    kinds = {"int": pa.int32(), "long": pa.int64(), "string": pa.string(), "boolean": pa.bool_(), "binary": pa.binary()}
    return pa.schema([(k, kinds[t]) for k, t in (x.split(" ") for x in ddl.split(", "))])


def _composed(walked: DataFrame) -> DataFrame:
    """file_ord, start, inside (the state in which a split begins), n_before (rows that end before it), header and error of the file; cut: whether it
    ends the file without a line break."""
    file = Window.partitionBy("file_ord")
    before = file.orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    fixed = F.col("end0") == F.col("end1")  # the end does not depend on the begin
    turns = (F.col("end0") & ~F.col("end1")).cast("int")  # the end is the other state
    w = walked.select("*", F.coalesce(F.sum(turns).over(before), F.lit(0)).alias("turned"))
    last = F.last(F.when(fixed, F.struct(F.col("end0").cast("int").alias("state"), F.col("turned").alias("turned"))), ignorenulls=True).over(before)
    w = w.withColumn("last", last)
    inside = F.pmod(F.coalesce("last.state", F.lit(0)) + F.col("turned") - F.coalesce("last.turned", F.lit(0)), F.lit(2)) == 1
    w = w.withColumn("inside", inside)
    own = lambda c: F.when(F.col("inside"), F.col(f"{c}1")).otherwise(F.col(f"{c}0"))
    w = w.withColumns({"n": own("n"), "error": own("error")})
    return w.select(
        "file_ord", "start", "inside", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("n_before"), F.max("header").over(file).alias("header"),
        F.min_by("error", F.when(F.col("error").isNotNull(), F.col("start"))).over(file).alias("error"),
        (F.lead("start").over(file.orderBy("start")).isNull() & (F.sum("bytes").over(file) > F.col("size"))).alias("cut"),
    )


def _scanned(columns: list[str]) -> str:
    return "file_ord int, name string, n long, error string, header string, key long, first long, start long, piece string, " + ", ".join(f"c_{c} string" for c in columns)


def _picked(columns: list[str], header: str):
    names = json.loads(header)
    at = [max((k for k, x in enumerate(names) if x == c), default=None) for c in columns]
    return lambda row: [row[k] if k is not None and k < len(row) else None for k in at]


def _parse(columns: list[str], most: int = 2000):
    """The rows that begin and end in a split; pieces of those that do not."""
    schema = _schema(_scanned(columns))

    def batch(r, rows, **more):
        cols = {"file_ord": [r["file_ord"]] * len(rows), "name": [r["name"]] * len(rows), "n": [n for n, _ in rows]} | {f"c_{c}": [v[k] for _, v in rows] for k, c in enumerate(columns)}
        cols |= {k: [v] * len(rows) for k, v in more.items()}
        return pa.RecordBatch.from_arrays([pa.array(cols[f.name], f.type) if f.name in cols else pa.nulls(len(rows), f.type) for f in schema], schema=schema)

    def run(batches):
        none = [None] * len(columns)
        for r, lines in _splits(batches):
            pick = _picked(columns, r["header"])
            n, inside, held, here, ended, unquoted = r["n_before"], r["inside"], [], not r["inside"], 0, 0
            piece = lambda text: batch(r, [(None, none)], header=r["header"], key=n + ended if here else r["n_before"], first=n, start=r["start"], piece=text)
            try:
                for line in lines:
                    more, now = _step(line, inside)
                    ended += more
                    held.append(line)
                    unquoted = unquoted + len(line) if inside and now and '"' not in line else 0
                    if unquoted > csv.field_size_limit():
                        raise csv.Error(f"field larger than field limit ({csv.field_size_limit()})")
                    inside = now
                    if inside or here and '"' not in line and len(held) < most:
                        continue
                    if here:
                        rows = [x for x in _parsed("\n".join(held) + "\n") if x]
                        yield batch(r, [(n + k, pick(x)) for k, x in enumerate(rows)])
                        n += len(rows)
                    else:
                        yield piece("\n".join(held) + "\n")
                        n += ended
                    held, here, ended = [], True, 0
                if held and not inside:
                    rows = [x for x in _parsed("\n".join(held) + "\n") if x]
                    yield batch(r, [(n + k, pick(x)) for k, x in enumerate(rows)])
                elif held:
                    yield piece("\n".join(held) + ("" if r["cut"] else "\n"))
            except csv.Error as e:
                yield batch(r, [(None, none)], error=str(e))

    return run


def _joined(columns: list[str]):
    schema = _schema(_scanned(columns))

    def run(batches):
        for b in batches:
            out = []
            for r in b.to_pylist():
                pick = _picked(columns, r["header"])
                own = {k: r[k] for k in ("file_ord", "name")}
                try:
                    rows = [x for x in _parsed(r["text"]) if x]
                    out += [own | {"n": r["first"] + k} | {f"c_{c}": v for c, v in zip(columns, pick(x))} for k, x in enumerate(rows)]
                except csv.Error as e:
                    out.append(own | {"error": str(e)})
            yield pa.RecordBatch.from_pylist(out, schema)

    return run


def csv_split_scan(lines: DataFrame, files: DataFrame, columns: list[str]) -> DataFrame:
    """file_ord, name, ok, error, pos and the known columns of every row, as files.csv_scan() gives them. lines: of csv_lines(); files: file_ord, name."""
    ship(lines.sparkSession)
    order = ["file_ord", "start", "at"]
    by_split = lambda df: df.repartition("file_ord", "start").sortWithinPartitions(*order)
    # A split is read by one task, in order: the first pass needs no shuffle.
    walked = write_table(lines.mapInArrow(_walk, _WALK), "walked")
    splits = write_table(_composed(walked), "splits")
    names = files.select("file_ord", "name").join(splits.groupBy("file_ord").agg(F.max("header").alias("header"), F.min("error").alias("error")), "file_ord", "left")
    head = F.from_json(F.coalesce("header", F.lit("[]")), "array<string>")
    known = F.arrays_overlap(head, F.array(*map(F.lit, columns)))
    shown = F.concat(F.lit("no recognized header columns found; got ["), F.array_join(F.transform(head, lambda x: F.concat(F.lit("'"), x, F.lit("'"))), ", "), F.lit("]"))
    fault = F.when(F.col("error").isNotNull(), F.concat(F.lit("failed to read CSV: "), "error")).when(~known, shown)
    names = write_table(names.select("file_ord", "name", fault.alias("error")), "csv-files")
    use = splits.join(names.where("error IS NULL").select("file_ord"), "file_ord").select("file_ord", "start", "inside", "n_before", "header", "cut")
    parsed = by_split(lines).join(use, ["file_ord", "start"]).sortWithinPartitions(*order).mapInArrow(_parse(columns), _scanned(columns))
    parsed = write_table(parsed, "csv-rows")
    pieces = parsed.where("piece IS NOT NULL").groupBy("file_ord", "name", "header", "key").agg(F.min("first").alias("first"), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("start", "piece"))), lambda x: x["piece"]), "").alias("text"))
    joined = write_table(pieces.mapInArrow(_joined(columns), _scanned(columns)), "csv-rows")
    every = parsed.where("piece IS NULL").unionByName(joined)
    late = every.where("error IS NOT NULL").groupBy("file_ord").agg(F.concat(F.lit("failed to read CSV: "), F.min("error")).alias("late"))
    names = names.join(late, "file_ord", "left").select("file_ord", "name", F.coalesce("error", "late").alias("error"))
    cols = [f"c_{c}" for c in columns]
    rows = every.where("n > 0").join(late.select("file_ord"), "file_ord", "left_anti")
    rows = rows.select("file_ord", "name", F.lit(True).alias("ok"), F.lit(None).cast("string").alias("error"), (F.col("n") - 1).cast("int").alias("pos"), *cols)
    return rows.unionByName(names.select("file_ord", "name", F.col("error").isNull().alias("ok"), "error", F.lit(None).cast("int").alias("pos"), *(F.lit(None).cast("string").alias(c) for c in cols)))
