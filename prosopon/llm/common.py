"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Callable, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from prosopon.operators.workers import ship

#: The contract's white space: space, tab, newline, vertical tab, form feed, carriage return.
ASCII_SPACE = " \t\n\x0b\x0c\r"

#: Rows and bytes of one Arrow batch; long texts make 10,000 rows too many for a small executor.
BATCH_ROWS, BATCH_BYTES = "1000", "8000000"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def keyed_text(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only the key (as long) and the text, so that extra columns cannot clash. A null text is empty."""
    return df.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))


def utf8(text: str) -> bytes:
    return text.encode("utf-8", "surrogatepass")


def crc_mod(doc_id: Column, by: int) -> Column:
    """crc32 of the key's decimal text, modulo `by`; a null key counts as the empty text."""
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), F.lit(by))


def prepare(spark: SparkSession) -> None:
    """What every operator with Python workers needs of its session."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)
    ship(spark)


def map_whole(df: DataFrame, start: Callable[[], Callable[[list[str]], tuple[list[bool], list[str]]]], text_col: str = "text") -> DataFrame:
    """The rows of df that stay, with all their columns. `start()` runs once per task; what it returns maps the texts of a batch
    (null: empty) to whether each stays and its new text; n_chars, where df has it, follows the text."""
    prepare(df.sparkSession)
    names = df.columns

    def run(batches):
        f = start()
        for b in batches:
            if not b.num_rows:
                continue
            old = b.column(names.index(text_col)).to_pylist()
            keep, new = f([t or "" for t in old])
            new = [n if t is not None else None for t, n in zip(old, new)]
            cols = dict(zip(names, b.columns))
            cols[text_col] = pa.array(new, b.column(names.index(text_col)).type)
            if "n_chars" in cols:
                cols["n_chars"] = pa.array([None if n is None else len(n) for n in new], cols["n_chars"].type)
            yield pa.RecordBatch.from_arrays(list(cols.values()), names=names).filter(pa.array(keep))

    return df.mapInArrow(run, df.schema)


def map_arrow(df: DataFrame, schema: StructType | str, start: Callable[[], Callable[..., Sequence[Sequence]]]) -> DataFrame:
    """`start()` runs once per task; what it returns maps the columns of a batch (lists) to the output's columns."""
    prepare(df.sparkSession)
    if isinstance(schema, str):
        schema = StructType.fromDDL(schema)
    arrow = to_arrow_schema(schema)

    def run(batches):
        f = start()
        for b in batches:
            if b.num_rows:
                cols = f(*(c.to_pylist() for c in b.columns))
                yield pa.RecordBatch.from_arrays([pa.array(c, type=t.type) for c, t in zip(cols, arrow)], schema=arrow)

    return df.mapInArrow(run, schema)
