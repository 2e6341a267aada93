"""Scans of source files: one row per file or row, with errors as rows instead of exceptions."""

from __future__ import annotations

import csv
import io
from collections.abc import Callable
from pathlib import PurePosixPath

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from prosopon.functions.text import strip
from prosopon.operators.workers import ship
from prosopon.schemas import EXTENSIONS
from prosopon.sources.pdf import extract_text

CSV_COLUMNS = ["name", "email", "phone", "current_company", "title"]
#: Fixed value: characters of text below which a résumé counts as unreadable.
LEAST_TEXT = 20


def basename(path: Column) -> Column:
    return F.substring_index(path, "/", -1)


def infer_source_type(path: Column) -> Column:
    """By the lower-cased extension; null for others."""
    ext = F.regexp_extract(F.lower(basename(path)), r"\.([a-z0-9]+)$", 1)
    return F.try_element_at(F.create_map(*(F.lit(x) for kv in EXTENSIONS.items() for x in kv)), ext)


def dir_listing(spark: SparkSession, path: str) -> DataFrame:
    """path, name, source_type of the known files directly in a directory, by name; contents are not read."""
    found = spark.read.format("binaryFile").load(path).select("path")
    return found.select("path", basename(F.col("path")).alias("name"), infer_source_type(F.col("path")).alias("source_type")).where("source_type IS NOT NULL").orderBy("name")


def bare(path: Column) -> Column:
    """Without the scheme that Spark puts before a path."""
    return F.regexp_replace(path, "^[a-z0-9]+:/*", "/")


def list_directory(spark: SparkSession, path: str) -> list[str] | None:
    """The paths of the known files directly in a directory of any of Hadoop's file systems, in the order of their names; None where there
    is no such directory."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(at) or not fs.getFileStatus(at).isDirectory():
        return None
    names = sorted(f.getPath().getName() for f in fs.listStatus(at) if f.isFile())
    return [f"{path.rstrip('/')}/{x}" for x in names if PurePosixPath(x).suffix.lower().lstrip(".") in EXTENSIONS]


def read_directory(spark: SparkSession, path: str) -> DataFrame:
    """read_files() of all known files directly in a directory, numbered in the order of their names. One listing by Spark: neither the
    names nor a path for each file pass the driver's Python, and small files share tasks."""
    found = dir_listing(spark, path).select(F.monotonically_increasing_id().alias("file_ord"), "path", "name", "source_type")
    raw = spark.read.option("ignoreMissingFiles", True).format("binaryFile").load(path).where(infer_source_type(F.col("path")).isNotNull()).select("path", "content")
    # Each file counts as 4 MB when splits are cut, which would make a task of a few files.
    return found.join(raw.coalesce(int(spark.conf.get("spark.sql.shuffle.partitions"))), "path").select("file_ord", bare(F.col("path")).alias("path"), "name", "source_type", "content")


def read_files(spark: SparkSession, files: DataFrame, paths: list[str]) -> DataFrame:
    """file_ord, path, name, source_type, content (bytes). files: file_ord, given (a path), name. A file that cannot be found has no row."""
    raw = spark.read.option("ignoreMissingFiles", True).format("binaryFile").load(paths).select("path", "content")
    # Full paths tell files of one name apart; the scheme that Spark puts before them is left out.
    return raw.join(F.broadcast(files), bare(F.col("path")) == bare(F.col("given"))).select("file_ord", "path", "name", infer_source_type(F.col("path")).alias("source_type"), "content")


def text_scan(files: DataFrame) -> DataFrame:
    """The whole content as text; bytes that are not UTF-8 are an error, an empty file is not."""
    ok = F.is_valid_utf8("content")
    return files.select(*(c for c in files.columns if c != "content"), ok.alias("ok"), F.when(~ok, "failed to decode as UTF-8").alias("error"), F.when(ok, F.decode("content", "UTF-8")).alias("text"))


def csv_scan(files: DataFrame) -> DataFrame:
    """Files that are already in a table; csv_splits reads files of any size from where they lie, with the same result.

    file_ord, name, ok, error, pos and the known columns of every row. A file needs one known column in its header. A byte
    order mark is accepted; of equal column names the last counts. Rows of blank lines don't exist and don't count."""
    out = "file_ord int, name string, ok boolean, error string, pos int, " + ", ".join(f"c_{c} string" for c in CSV_COLUMNS)

    def rows(batches):
        import pandas as pd

        for pdf in batches:
            found = []
            for order, name, content in zip(pdf["file_ord"], pdf["name"], pdf["content"]):
                none = [None] * len(CSV_COLUMNS)
                try:
                    reader = csv.DictReader(io.StringIO(bytes(content).decode("utf-8-sig"), newline=""))
                    head = reader.fieldnames or []
                    if not set(head) & set(CSV_COLUMNS):
                        found.append([order, name, False, f"no recognized header columns found; got {head}", None, *none])
                        continue
                    own = [[order, name, True, None, k, *(r.get(c) for c in CSV_COLUMNS)] for k, r in enumerate(reader)]
                    found += [[order, name, True, None, None, *none], *own]
                except (UnicodeDecodeError, csv.Error) as e:
                    found.append([order, name, False, f"failed to read CSV: {e}", None, *none])
            yield pd.DataFrame(found, columns=["file_ord", "name", "ok", "error", "pos", *(f"c_{c}" for c in CSV_COLUMNS)]).astype({"pos": "Int32"})

    return files.select("file_ord", "name", "content").mapInPandas(rows, out)


def json_scan(texts: DataFrame) -> DataFrame:
    """From file_ord, name, ok, error, text: ok, error and the entries (array of variants) of the top-level list `candidates`."""
    v = F.try_parse_json("text")
    entries = F.expr("try_variant_get(v, '$.candidates', 'array<variant>')")
    is_list = F.coalesce(F.expr("schema_of_variant(variant_get(v, '$.candidates', 'variant'))").startswith("ARRAY"), F.lit(False))
    is_object = F.coalesce(F.expr("schema_of_variant(v)").startswith("OBJECT"), F.lit(False))
    parsed = texts.withColumn("v", v)
    good = F.col("ok") & F.col("v").isNotNull() & is_object & is_list
    error = F.when(~F.col("ok"), F.col("error")).when(F.col("v").isNull(), "failed to parse JSON").when(~(is_object & is_list), "expected top-level 'candidates' list, found none")
    return parsed.select("file_ord", "name", F.coalesce(good, F.lit(False)).alias("ok"), error.alias("error"), F.when(good, entries).alias("entries"))


def pdf_scan(files: DataFrame, extract: Callable[[bytes], str] = extract_text) -> DataFrame:
    """Text of PDFs; a file that cannot be read is an error row."""

    def run(batches):
        import pyarrow as pa

        for b in batches:
            texts, errors = [], []
            for c in b.column("content").to_pylist():
                try:
                    text, error = extract(bytes(c)), None
                except Exception as e:  # any fault of a file is that file's error row
                    text, error = None, f"failed to open/parse PDF: {e}"
                texts.append(text)
                errors.append(error)
            yield pa.RecordBatch.from_arrays([b.column("file_ord"), b.column("name"), pa.array(texts, pa.string()), pa.array(errors, pa.string())], names=["file_ord", "name", "text", "error"])

    ship(files.sparkSession)
    return text_gate(files.select("file_ord", "name", "content").mapInArrow(run, "file_ord int, name string, text string, error string"))


def text_gate(texts: DataFrame) -> DataFrame:
    """Extracted texts with next to nothing in them are errors. texts: text and, if any, error."""
    enough = F.length(strip(F.coalesce("text", F.lit("")))) >= LEAST_TEXT
    error = F.coalesce("error", F.when(~enough, "no usable text extracted")) if "error" in texts.columns else F.when(~enough, "no usable text extracted")
    return texts.select(*(c for c in texts.columns if c not in ("text", "error")), error.isNull().alias("ok"), error.alias("error"), F.when(error.isNull(), F.col("text")).alias("text"))
