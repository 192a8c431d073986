"""Key pages as a data source (``key_pages``): a listing's landed pages, in batch and as a stream (S1, S2).

A client that follows a listing lands its pages with :func:`land`: one folder for each group of consecutive page numbers, named
after the first, so that listing the folders is enough to know what there is. A batch read makes one partition of each
group and takes comparisons of ``UpdatedAt`` into the reader. A stream's offset is the number of the last page that was
read: after a restart it goes on with the page after the stored one and opens no earlier group.

Folders are listed and read through Arrow's file systems (local or mounted paths, and the object stores that they know).
"""

from __future__ import annotations

import json
import operator
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource,
    DataSourceReader,
    DataSourceStreamReader,
    EqualTo,
    GreaterThan,
    GreaterThanOrEqual,
    InputPartition,
    LessThan,
    LessThanOrEqual,
)

NAME, GROUP = "key_pages", "pages_from"
SCHEMA = pa.schema([("Id", pa.string()), ("UpdatedAt", pa.string()), ("page", pa.int64())])
COMPARED = {EqualTo: operator.eq, GreaterThan: operator.gt, GreaterThanOrEqual: operator.ge, LessThan: operator.lt,
            LessThanOrEqual: operator.le}


def land(envelopes: DataFrame, path: str, group_pages: int = 100) -> None:
    """Append page envelopes (page_no, envelope) to the landed pages at ``path``."""
    first = F.floor(F.col("page_no") / group_pages) * group_pages
    (envelopes.select(F.col("page_no").cast("long").alias("page_no"), "envelope", first.cast("long").alias(GROUP))
     .repartition(GROUP).write.mode("append").partitionBy(GROUP).json(path))


def read_keys(spark: SparkSession, path: str) -> DataFrame:
    """Id, UpdatedAt, page of every key in the landed pages that has an Id."""
    return _registered(spark).read.format(NAME).load(path)


def stream_keys(spark: SparkSession, path: str) -> DataFrame:
    """The same as a stream, from page number to page number."""
    return _registered(spark).readStream.format(NAME).load(path)


def _registered(spark: SparkSession) -> SparkSession:
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(KeyPages)
    return spark


@dataclass
class Pages(InputPartition):
    """The pages of one group whose numbers lie in (after, until]."""

    folder: str
    after: int | None = None
    until: int | None = None


def _text(value) -> str | None:
    """A JSON value as text, as a string column of Spark's JSON reader has it."""
    if value is None or isinstance(value, str):
        return value
    return json.dumps(value, separators=(",", ":"), ensure_ascii=False)


def keys_of(envelope: str) -> list[tuple[str, str | None]]:
    """(Id, UpdatedAt) of the items of a page that have an Id; a page that is not such JSON has none."""
    try:
        items = json.loads(envelope).get("Items")
    except (ValueError, AttributeError, TypeError):
        return []
    rows = [(_text(i.get("Id")), _text(i.get("UpdatedAt"))) for i in items if isinstance(i, dict)] if isinstance(items, list) else []
    return [r for r in rows if r[0]]


class Landed:
    """The landed pages at a path."""

    def __init__(self, options):
        if not options.get("path"):
            raise ValueError(f"{NAME}: load() needs the path of the landed pages")
        self.path = options["path"]

    def _at(self):
        return fs.FileSystem.from_uri(self.path)

    def groups(self) -> list[tuple[int, str]]:
        """(first page number, folder) of each group, in order."""
        where, root = self._at()
        found = where.get_file_info(fs.FileSelector(root, allow_not_found=True))
        return sorted((int(i.base_name.partition("=")[2]), i.path) for i in found if i.base_name.startswith(f"{GROUP}="))

    def pages(self, part: Pages) -> Iterator[tuple[int, str]]:
        where, _ = self._at()
        for info in sorted(where.get_file_info(fs.FileSelector(part.folder)), key=lambda i: i.path):
            if not info.base_name.startswith("part-"):
                continue
            with where.open_input_stream(info.path, compression="detect") as f:
                for line in f.read().splitlines():
                    row = json.loads(line)
                    n = row["page_no"]
                    if (part.after is None or n > part.after) and (part.until is None or n <= part.until):
                        yield n, row.get("envelope")

    def batches(self, part: Pages, keep=lambda updated: True) -> Iterator[pa.RecordBatch]:
        out = []
        for n, envelope in self.pages(part):
            out += [(i, u, n) for i, u in keys_of(envelope) if keep(u)]
            if len(out) > 10_000:
                yield self._batch(out)
                out = []
        yield self._batch(out)

    @staticmethod
    def _batch(rows):
        return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], f.type) for k, f in enumerate(SCHEMA)], schema=SCHEMA)


class KeyPageReader(Landed, DataSourceReader):
    def __init__(self, options):
        super().__init__(options)
        self.bounds: list[tuple[str, str]] = []

    def pushFilters(self, filters):
        for f in filters:
            if type(f) in COMPARED and f.attribute == ("UpdatedAt",) and isinstance(f.value, str):
                self.bounds.append((type(f).__name__, f.value))
            else:
                yield f

    def partitions(self):
        return [Pages(folder) for _, folder in self.groups()]

    def read(self, partition):
        if partition is None:       # nothing landed yet
            return
        by_name = {k.__name__: op for k, op in COMPARED.items()}

        def keep(updated):
            return all(updated is not None and by_name[name](updated, value) for name, value in self.bounds)
        yield from self.batches(partition, keep)


class KeyPageStream(Landed, DataSourceStreamReader):
    def initialOffset(self):
        return {"page": -1}

    def latestOffset(self):
        groups = self.groups()
        if not groups:
            return self.initialOffset()
        return {"page": max((n for n, _ in self.pages(Pages(groups[-1][1]))), default=-1)}

    def partitions(self, start, end):
        after, until = start["page"], end["page"]
        groups = self.groups()
        nexts = [first for first, _ in groups[1:]] + [until + 1]
        return [Pages(folder, after, until) for (first, folder), following in zip(groups, nexts, strict=True)
                if first <= until and following - 1 > after]

    def read(self, partition):
        yield from self.batches(partition)


class KeyPages(DataSource):
    @classmethod
    def name(cls):
        return NAME

    def schema(self):
        return "Id string, UpdatedAt string, page long"

    def reader(self, schema):
        return KeyPageReader(self.options)

    def streamReader(self, schema):
        return KeyPageStream(self.options)
