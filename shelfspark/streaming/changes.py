"""Incremental ("changes") refresh: newly landed item versions are merged
into the curated snapshot, re-curating only the touched keys.

The snapshot lies in hash buckets of the key (:class:`BucketedSnapshot`): a run reads the buckets
that its items fall into and rewrites those that they change. Batch form: :func:`merge_arrived`
(:func:`upsert_latest` is the same as a plan over two frames). Streaming forms read the landing
folder with Structured Streaming (``availableNow``), whose checkpoint replaces a hand-kept "since" instant:
:func:`start_changes_stream` merges every micro-batch, :func:`start_newest_stream` keeps the newest version
of each key as keyed state and merges what that emits.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StructField, StructType

from ..operators import curate as cu
from ..schemas import CURATED_SCHEMA, SILVER_SCHEMA
from ..session import settings
from ..sources.buckets import BucketedSnapshot

_STORE = "spark.sql.streaming.stateStore"
#: Keyed state lies in RocksDB on the executors' disks, all stores of an executor in one bounded part of its memory. Spark's
#: default store holds every key's row in the heap. A checkpoint keeps the store that it was made with.
STATE_ON_DISK = {f"{_STORE}.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
                 f"{_STORE}.rocksdb.boundedMemoryUsage": "true", f"{_STORE}.rocksdb.maxMemoryUsageMB": "128",
                 f"{_STORE}.rocksdb.trackTotalNumberOfRows": "false", f"{_STORE}.rocksdb.compression": "zstd"}


def touched_keys(arrived: DataFrame) -> DataFrame:
    """Distinct GTINs of newly arrived raw items (a DataFrame, never a list)."""
    gtin = cu.read_fields("raw_json", cu.SOURCES["GTIN"], F.coalesce)
    return arrived.select(gtin.alias("GTIN")).where(F.col("GTIN").isNotNull()).distinct()


def upsert_latest(previous: DataFrame, arrived: DataFrame) -> DataFrame:
    """Latest-per-key snapshot after ``arrived`` raw items land on top of the
    ``previous`` curated snapshot (itself one row per key).

    Only rows of touched keys take part in the window; the untouched part of
    the snapshot passes through an anti join, unchanged."""
    new = cu.curate(arrived)
    keys = new.select("GTIN").where(F.col("GTIN").isNotNull()).distinct()
    untouched = previous.where(F.col("GTIN").isNotNull()).join(keys, "GTIN", "left_anti")
    touched = previous.where(F.col("GTIN").isNotNull()).join(keys, "GTIN", "left_semi")
    merged = cu.latest_per_key(touched.unionByName(new.where(F.col("GTIN").isNotNull())))
    # NULL-key rows (malformed documents) collapse to one row, as in a full run
    nulls = cu.latest_per_key(previous.where(F.col("GTIN").isNull())
                              .unionByName(new.where(F.col("GTIN").isNull())))
    return untouched.unionByName(merged).unionByName(nulls).select(*previous.columns)


def curated_snapshot(spark: SparkSession, path: str, n_buckets: int = 64) -> BucketedSnapshot:
    """The curated table, one row for each GTIN, in buckets that a changes run rewrites singly (K2). Rows keep the
    digest of their document, so that the order of versions is total across runs."""
    schema = StructType([*CURATED_SCHEMA.fields, StructField(cu.DOC_DIGEST, BinaryType())])
    return BucketedSnapshot(spark, path, schema, "GTIN", lambda df: cu.latest_per_key(df, then=["_arrived"]), n_buckets)


def merge_arrived(snapshot: BucketedSnapshot, arrived: DataFrame) -> list[int]:
    """Curate arrived raw items and merge them; the numbers of the buckets that changed."""
    return snapshot.merge(cu.curate(arrived, digest=True))


def start_changes_stream(spark: SparkSession, landing_path: str, snapshot: BucketedSnapshot, checkpoint: str,
                         fmt: str = "json"):
    """Merge every newly landed file of silver rows into ``snapshot``.

    Runs with ``availableNow``: all files present are processed (in as many
    micro-batches as needed) and the query stops; rerunning only sees new
    files. A replayed batch changes nothing. Returns the StreamingQuery (call ``awaitTermination()``)."""
    src = spark.readStream.schema(SILVER_SCHEMA).format(fmt).load(landing_path)
    return (src.writeStream.foreachBatch(lambda batch, _: merge_arrived(snapshot, batch) and None)
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())


def _falling(c: str) -> Column:
    """Text whose order is the reverse of the column's; NULL stays NULL, hence the least: a maximum over it is
    the column's smallest value. Hexadecimal digits are turned round; the mark at the end makes a prefix the greater one."""
    return F.concat(F.translate(F.hex(F.col(c)), "0123456789ABCDEF", "FEDCBA9876543210"), F.lit("G"))


def newest_versions(curated: DataFrame) -> DataFrame:
    """The newest version of each GTIN as one aggregate, for streams: its state holds one row for each key.

    The order is that of :func:`~shelfspark.operators.curate.latest_per_key` (newest instants first, then the
    smallest Id, then the smallest digest), as one value whose maximum is kept. Spark combines it in each map
    task before the shuffle, so that keyless rows, or a key that very many rows share, send one row a task.
    """
    order = [*[F.col(c) for c in cu.VERSION_ORDER], _falling("Id"), _falling(cu.DOC_DIGEST)]
    best = F.max(F.struct(F.struct(*order).alias("order"), F.struct(*[F.col(c) for c in curated.columns]).alias("row")))
    return curated.groupBy("GTIN").agg(best.alias("best")).select("best.row.*")


def start_newest_stream(spark: SparkSession, landing_path: str, snapshot: BucketedSnapshot, checkpoint: str,
                        fmt: str = "json"):
    """Stateful form of the changes stream: the state store (:data:`STATE_ON_DISK`) holds the newest version of every
    key ever seen.

    Each trigger emits the keys of its rows (update mode), in their newest version: a late or repeated item
    emits the version that the state already had, which the snapshot's merge recognises and does not write. State and
    source position are recovered from ``checkpoint``."""
    src = spark.readStream.schema(SILVER_SCHEMA).format(fmt).load(landing_path)
    newest = newest_versions(cu.curate(src, digest=True))
    with settings(spark, STATE_ON_DISK):      # a stream takes the settings of its start
        return (newest.writeStream.outputMode("update").foreachBatch(lambda batch, _: snapshot.merge(batch) and None)
                .option("checkpointLocation", checkpoint)
                .trigger(availableNow=True).start())
