"""Command line: python -m prosopon.cli --dir samples --config config.json --output out.json"""

from __future__ import annotations

import argparse
import json
import logging
import sys
from collections.abc import Iterable
from pathlib import Path
from typing import TextIO

from pyspark.sql import SparkSession

from prosopon.plans.run import Report, from_files, run
from prosopon.plans.shape import Config, load_config
from prosopon.sources.files import list_directory

log = logging.getLogger("prosopon")
TYPED = {"csv": "csv", "ats": "ats_json", "pdf": "resume_pdf", "notes": "recruiter_notes"}


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="prosopon", description=__doc__)
    for flag in TYPED:
        p.add_argument(f"--{flag}", nargs="+", default=[], metavar="FILE")
    p.add_argument("--files", nargs="+", default=[], metavar="FILE", help="files whose type is inferred from their extension")
    p.add_argument("--dir", nargs="+", default=[], metavar="DIR", help="directories whose known files are read, in the order of their names")
    p.add_argument("--config", help="output configuration (default: configs/default_config.json)")
    p.add_argument("--output", help="file to write to (default: standard output)")
    p.add_argument("--indent", type=int, default=2)
    p.add_argument("--no-metadata", action="store_true")
    p.add_argument("--verbose", "-v", action="store_true")
    return p


def scan_directories(spark: SparkSession, dirs: list[str]) -> list[str]:
    out = []
    for d in dirs:
        found = list_directory(spark, d)
        if found is None:
            log.warning("not a directory, skipped: %s", d)
        out += found or []
    return out


def totals_of(reports: list[Report]) -> dict[str, int]:
    counts = [x.metrics() for x in reports]
    return {k: sum(c[k] for c in counts) for k in counts[0]}


def write_output(reports: list[Report], totals: dict[str, int] | None, out: TextIO, indent: int) -> None:
    """One JSON document, written row by row as they come, errors too: the driver holds one partition of them at a time."""
    line = lambda level: "\n" + " " * indent * level

    def entries(key: str, rows: Iterable, level: int) -> None:
        out.write(f'{line(level)}"{key}": [')
        n = 0
        for x in rows:
            out.write(("," if n else "") + line(level + 1) + json.dumps(x, indent=indent, ensure_ascii=False).replace("\n", line(level + 1)))
            n += 1
        out.write((line(level) if n else "") + "]")

    out.write("{")
    entries("candidates", (json.loads(r["document"]) for x in reports for r in x.candidates.orderBy("cluster_ord").toLocalIterator()), 1)
    if totals is not None:
        out.write("," + line(1) + '"run_metadata": {')
        for k in ("partial_records_loaded", "canonical_records_merged", "candidates_in_output"):
            out.write(f'{line(2)}"{k}": {totals[k]},')
        entries("source_errors", (r.asDict() for x in reports for r in x.source_errors.toLocalIterator()), 2)
        out.write(",")
        entries("candidate_errors", (r.asDict() for x in reports for r in x.candidate_errors.toLocalIterator()), 2)
        out.write(line(1) + "}")
    out.write("\n}\n")


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> int:
    p = parser()
    a = p.parse_args(argv)
    logging.basicConfig(level=logging.DEBUG if a.verbose else logging.WARNING)
    typed = [(f, kind) for flag, kind in TYPED.items() for f in getattr(a, flag)]
    if not typed and not a.files and not a.dir:
        p.error("no sources given")
    path = a.config or "configs/default_config.json"
    if a.config is None and not Path(path).exists():
        p.error(f"no --config given and {path} not found")
    try:
        config: Config = load_config(path)
    except (FileNotFoundError, ValueError) as e:
        print(f"error: {e}", file=sys.stderr)
        return 1
    spark = spark or SparkSession.builder.appName("prosopon").getOrCreate()
    inferred = [*a.files, *scan_directories(spark, a.dir)]
    if not typed and not inferred:
        p.error("no sources given")
    # Two independent runs: people in both are not brought together.
    reports = [from_files(spark, inferred, config)] if inferred else []
    reports += [run(spark, typed, config)] if typed else []
    totals = totals_of(reports)
    errors = totals["source_errors"] + totals["candidate_errors"]
    shown = None if a.no_metadata else totals
    if a.output is None:
        write_output(reports, shown, sys.stdout, a.indent)
    else:
        Path(a.output).parent.mkdir(parents=True, exist_ok=True)
        with open(a.output, "w", encoding="utf-8") as f:
            write_output(reports, shown, f, a.indent)
        print(f"Output written to {a.output}", file=sys.stderr)
    n = totals["candidates_in_output"]
    print(f"Done: {n} candidate(s), {errors} error(s)", file=sys.stderr)
    return int(n == 0 and errors > 0)


if __name__ == "__main__":
    sys.exit(main())
