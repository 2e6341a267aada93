"""Look-ups whose hot keys do not meet in one task.

A key is hot when it holds at least 1/1,024 of the rows, and `least` rows; so there are at most 1,024 hot keys. They are found exactly,
by a count with partial sums. Rows of hot keys stay where they are and are answered by a broadcast table of at most one row for each hot key;
all other rows are shuffled to their keys. No row is dropped or moved to another key.

Whether to broadcast a table is Spark's choice only if it has fewer than `least` rows: it goes by the size of files, and those of numbers are so
compact that a million rows stay below its threshold, which the driver then has to hold.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from prosopon.operators.durable import drop_table, write_table

MOST_HOT = 1024
LEAST = 100_000


def shuffled(table: DataFrame) -> DataFrame:
    """For joins of tables that grow with the records: never broadcast, whatever their files' size. The adaptive skew join still splits hot keys."""
    return table.hint("merge")


class Lookups:
    """Left joins with tables of unique keys; drop() when the results have been written."""

    def __init__(self, least: int = LEAST):
        self.least, self._tables = least, []

    def hot_keys(self, rows: DataFrame, key: str) -> DataFrame | None:
        """The hot keys, at most MOST_HOT of them; None if there is none. rows: a written table, of which the count is metadata."""
        n = rows.count()
        if n < self.least:
            return None
        found = rows.where(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("n")).where(F.col("n") >= max(self.least, -(-n // MOST_HOT)))
        hot = write_table(found.select(key), "hot")
        self._tables.append(hot)
        return hot if hot.head(1) else None

    def left(self, rows: DataFrame, key: str, table: DataFrame, hot: DataFrame | None, small: bool = False) -> DataFrame:
        """rows LEFT JOIN table USING (key). hot: hot_keys() of the rows; table: one row for each key at most; small: fewer than `least` in all."""
        rest = table if small else shuffled(table)
        if hot is None:
            return rows.join(rest, key, "left")
        few = F.broadcast(table.join(F.broadcast(hot), key))
        warm = rows.join(F.broadcast(hot), key, "left_semi").join(few, key, "left")
        cold = rows.join(F.broadcast(hot), key, "left_anti").join(rest, key, "left")
        return warm.unionByName(cold)

    def drop(self) -> None:
        for t in self._tables:
            drop_table(t)
        self._tables = []
