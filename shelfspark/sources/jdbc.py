"""JDBC snapshot sources and sinks.

The projection / top-n / order semantics are format independent
(:func:`topn_projection`), so they are exercised on Parquet snapshots; the
JDBC wrappers only add connection options. Reads are split into parallel
partitions when a numeric partition column is given.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def topn_projection(df: DataFrame, columns: Sequence[str] | None = None,
                    top_n: int | None = None, order_by: Sequence[str] | None = None) -> DataFrame:
    """``SELECT [TOP n] cols FROM t [ORDER BY o]``. A limit is only taken with
    an order (TakeOrderedAndProject), so it is deterministic; column entries
    may carry ' DESC'."""
    out = df.select(*columns) if columns else df
    if order_by:
        keys = []
        for o in order_by:
            name, _, direction = o.strip().partition(" ")
            c = F.col(name)
            keys.append(c.desc_nulls_last() if direction.strip().upper() == "DESC"
                        else c.asc_nulls_first())
        out = out.orderBy(*keys)
    if top_n is not None:
        out = out.limit(int(top_n))
    return out


@dataclass(frozen=True)
class JdbcTable:
    """A table (or ``(subquery) AS t``) of a database, as Spark's own JDBC source sees it.

    ``parallel`` bounds the connections of reads and writes. ``split`` (column, least, greatest)
    spreads a read over them; without it a read has one partition.
    """

    address: str
    name: str
    options: dict[str, str] = field(default_factory=dict)
    parallel: int = 8
    split: tuple[str, int, int] | None = None

    def _all(self) -> dict[str, str]:
        own = {"url": self.address, "dbtable": self.name, "numPartitions": str(self.parallel)}
        return {**self.options, **own}

    def rows(self, spark: SparkSession) -> DataFrame:
        """All rows; projection, order and limit that follow are pushed down where the dialect allows."""
        opts = self._all()
        if self.split:
            opts |= dict(zip(("partitionColumn", "lowerBound", "upperBound"), map(str, self.split), strict=True))
        return spark.read.format("jdbc").options(**opts).load()

    def add(self, df: DataFrame) -> None:
        df.write.format("jdbc").options(**self._all()).mode("append").save()

    def replace(self, df: DataFrame, keep_definition: bool = True) -> None:
        """New rows for the table; by default its schema, indexes and grants stay and it is only emptied."""
        df.write.format("jdbc").options(**self._all(), truncate=str(keep_definition).lower()).mode("overwrite").save()
