"""From sources to documents: load, resolve, fuse, check, shape, check, report."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from prosopon.operators.checks import canonical_fault
from prosopon.operators.durable import drop_table, write_table
from prosopon.operators.fuse import canonical
from prosopon.operators.resolve import resolve
from prosopon.plans.shape import Config, project
from prosopon.schemas import EXTENSIONS, PARTIAL
from prosopon.sources.csv_splits import csv_lines, csv_split_scan
from prosopon.sources.files import CSV_COLUMNS, basename, pdf_scan, read_files, text_scan
from prosopon.sources.json_splits import json_parts, json_split_scan
from prosopon.sources.pdf import extract_text
from prosopon.sources.partials import csv_partials, json_partials, note_partials, numbered, resume_partials

SOURCE_ERROR = "path string, source_type string, stage string, message string"


#: The stage of records without any fault.
DONE = "output"


@dataclass(frozen=True)
class Report:
    """outcomes: one row for each record, with the stage at which it ended (DONE: its document is output) and that stage's message; a table
    by stage, written in the one pass that checks and shapes. Errors are rows of it; counts of stages read no data."""

    partials: DataFrame
    records: DataFrame
    outcomes: DataFrame
    source_errors: DataFrame

    @property
    def candidates(self) -> DataFrame:
        """cluster_ord, candidate_id, document."""
        return self.outcomes.where(F.col("stage") == DONE).select("cluster_ord", "candidate_id", "document")

    @property
    def candidate_errors(self) -> DataFrame:
        """candidate_id, stage, message."""
        return self.outcomes.where(F.col("stage") != DONE).select("candidate_id", "stage", "message")

    def metrics(self) -> dict[str, int]:
        stages = {r["stage"]: r["n"] for r in self.outcomes.groupBy("stage").agg(F.count("*").alias("n")).collect()}
        done, every = stages.get(DONE, 0), sum(stages.values())
        return {
            "partial_records_loaded": self.partials.count(), "canonical_records_merged": every, "candidates_in_output": done,
            "source_errors": self.source_errors.count(), "candidate_errors": every - done,
        }


def load(spark: SparkSession, sources: list[tuple[str, str]], extract_pdf: Callable[[bytes], str] = extract_text) -> tuple[DataFrame, DataFrame]:
    """(partials, source errors) of (path, type) pairs. A file that fails is an error row; the others go on."""
    errors: list[tuple[str, str, str, str]] = []
    parts: list[DataFrame] = []
    failed: list[DataFrame] = []
    known: list[tuple[str, str]] = []
    fs = spark._jvm.org.apache.hadoop.fs
    for path, kind in sources:
        p = fs.Path(path)
        if kind not in EXTENSIONS.values():
            errors.append((path, kind, "load", f"unknown source type: {kind}"))
        elif not p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p):
            errors.append((path, kind, "load", "file not found"))
        else:
            known.append((path, kind))

    order = spark.createDataFrame([(k, p) for k, (p, _) in enumerate(known)], "file_ord int, given string").withColumn("name", basename(F.col("given")))

    def fail(df: DataFrame, kind: str, stage: str) -> None:
        at = df.join(F.broadcast(order.select("file_ord", "given")), "file_ord")
        failed.append(at.select(F.col("given").alias("path"), F.lit(kind).alias("source_type"), F.lit(stage).alias("stage"), F.col("error").alias("message")))

    for kind in EXTENSIONS.values():
        mine = [(k, p) for k, (p, t) in enumerate(known) if t == kind]
        if not mine:
            continue
        named = order.join(F.broadcast(spark.createDataFrame([(k,) for k, _ in mine], "file_ord int")), "file_ord")
        if kind == "csv":
            rows = csv_split_scan(csv_lines(spark, named, [p for _, p in mine]), named, CSV_COLUMNS)
            parts.append(csv_partials(rows))
            fail(rows.where("NOT ok"), kind, "load")
            continue
        if kind == "ats_json":
            rows = json_split_scan(json_parts(spark, named, [p for _, p in mine]), named)
            good, bad = json_partials(rows)
            parts.append(good)
            fail(rows.where("NOT ok"), kind, "load")
            fail(bad, kind, "parse")
            continue
        files = read_files(spark, named, [p for _, p in mine])
        if kind == "resume_pdf":
            rows = pdf_scan(files, extract_pdf)
            parts.append(resume_partials(rows.where("ok")))
            fail(rows.where("NOT ok"), kind, "load")
        else:
            rows = text_scan(files)
            parts.append(note_partials(rows.where("ok")))
            fail(rows.where("NOT ok"), kind, "load")
    all_errors = spark.createDataFrame(errors, SOURCE_ERROR)
    for f in failed:
        all_errors = all_errors.unionByName(f)
    return (numbered(parts) if parts else spark.createDataFrame([], PARTIAL)), all_errors


def run(spark: SparkSession, sources: list[tuple[str, str]], config: Config, extract_pdf: Callable[[bytes], str] = extract_text) -> Report:
    partials, source_errors = load(spark, sources, extract_pdf)
    return run_partials(partials, source_errors, config)


def run_partials(partials: DataFrame, source_errors: DataFrame, config: Config) -> Report:
    """Partials and clustered records are read by several plans, and fused records by several runs, so all are written once."""
    partials = write_table(partials, "partials")
    clustered = write_table(resolve(partials), "clustered")
    records = canonical(clustered)
    drop_table(clustered)
    return Report(partials, records, write_table(outcomes(records, config), "outcomes", "stage"), source_errors)


def outcomes(records: DataFrame, config: Config) -> DataFrame:
    """cluster_ord, candidate_id, message, document, stage: every record checked, shaped and checked again. Its first fault counts."""
    r = project(records, config).withColumn("fault", canonical_fault())
    faults = {"validate_canonical": "fault", "project": "project_error", "validate_projection": "violation"}
    stage = F.coalesce(*(F.when(F.col(c).isNotNull(), F.lit(name)) for name, c in faults.items()), F.lit(DONE))
    r = r.select("cluster_ord", "candidate_id", F.coalesce(*faults.values()).alias("message"), "document", stage.alias("stage"))
    return r.withColumn("document", F.when(F.col("stage") == DONE, F.col("document")))


def from_files(spark: SparkSession, paths: list[str], config: Config, extract_pdf: Callable[[bytes], str] = extract_text) -> Report:
    """Types by extension; unknown ones are errors, after those of the run."""
    typed = [(p, EXTENSIONS.get(p.rsplit(".", 1)[-1].lower() if "." in p.rsplit("/", 1)[-1] else "")) for p in paths]
    report = run(spark, [(p, t) for p, t in typed if t], config, extract_pdf)
    unknown = [(p, "unknown", "load", "unrecognized file extension") for p, t in typed if not t]
    if not unknown:
        return report
    more = spark.createDataFrame(unknown, SOURCE_ERROR)
    return replace(report, source_errors=report.source_errors.unionByName(more))
