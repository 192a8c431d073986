"""Composite jobs: full refresh, changes refresh, category-name profile and
data-quality probes, each writing staged table versions and one run-metrics
row. Counts come from ``Observation`` during the writes (no second scan)."""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..operators import curate as cu
from ..operators import hierarchy as hi
from ..operators import packaging as pk
from ..operators import profile as pr
from ..operators import publish as pb
from ..schemas import CURATED_COLUMNS, SILVER_SCHEMA
from ..session import drop_path, path_exists, save, staged
from ..sources import pages
from ..sources.buckets import BucketedSnapshot
from ..sources.tables import TableStore
from ..streaming import changes as ch


@dataclass
class CategoryConfig:
    rules: Sequence[hi.Rule]
    own_provider: str
    placeholder: str
    as_of: str
    months: int = 4


@dataclass
class RunResult:
    tables: dict[str, str] = field(default_factory=dict)
    metrics: dict[str, int | float] = field(default_factory=dict)


#: Counts that are taken while gold rows are written.
GOLD_METRICS = {"categorised": ("CATEGORY_SOURCE", None), "placeholder": ("CATEGORY_SOURCE", hi.SOURCE_PLACEHOLDER),
                "with_case_dims": ("Case_GTIN", None)}


def observed_write(store: TableStore, df: DataFrame, name: str, metrics: dict,
                   prefix: str, extra: dict | None = None) -> str:
    """Write a table and add the number of its rows to ``metrics``, with counts of the rows whose column is
    set (or equals a value): ``extra`` is name -> (column, value or None), or an aggregate."""
    obs = Observation(f"{name}-{time.time_ns()}")
    aggs = [F.count(F.lit(1)).alias(f"{prefix}_rows")]
    for k, v in (extra or {}).items():
        if isinstance(v, tuple):
            column, value = v
            v = F.count_if(F.col(column).isNotNull() if value is None else F.col(column) == F.lit(value))
        aggs.append(v.alias(f"{prefix}_{k}"))
    path = store.write(df.observe(obs, *aggs), name)
    metrics.update(obs.get)
    return path


def gold_rows(curated: DataFrame, hierarchy: DataFrame, weekly_sales: DataFrame, cfg: CategoryConfig,
              paths: list[str] | None = None) -> DataFrame:
    """Curated rows with categories and case dimensions. The self join of the cases reads categorised rows that
    are staged, so that the cascade runs once; their folder is added to ``paths``, for callers that drop it once the
    rows are stored."""
    recent = hi.recent_sales_lookup(hierarchy, weekly_sales, cfg.as_of, cfg.months)
    return pk.case_dimensions(staged(hi.category_cascade(curated, hierarchy, recent, cfg.rules, cfg.own_provider,
                                                         cfg.placeholder), "categorised", paths))


def write_gold(store: TableStore, curated: DataFrame, hierarchy: DataFrame, weekly_sales: DataFrame, cfg: CategoryConfig,
               metrics: dict) -> str:
    """Store :func:`gold_rows` with their counts; what they were made of is dropped."""
    fresh: list[str] = []
    try:
        return observed_write(store, gold_rows(curated, hierarchy, weekly_sales, cfg, fresh), "gold", metrics, "gold",
                              GOLD_METRICS)
    finally:
        for path in fresh:
            drop_path(store.spark, path)


def enrich(store: TableStore, curated: DataFrame, hierarchy: DataFrame, weekly_sales: DataFrame,
           cfg: CategoryConfig, result: RunResult) -> None:
    """curated -> gold: categories and case dimensions in one plan, written once."""
    result.tables["gold"] = write_gold(store, curated, hierarchy, weekly_sales, cfg, result.metrics)


def snapshot_of(store: TableStore) -> BucketedSnapshot:
    """The curated table of a store: one row for each GTIN, in buckets."""
    return ch.curated_snapshot(store.spark, f"{store.root}/curated-buckets")


def curated_rows(store: TableStore) -> DataFrame:
    return snapshot_of(store).read().select(*CURATED_COLUMNS)


def curate_all(store: TableStore, silver: DataFrame, res: RunResult) -> None:
    """Silver -> the curated snapshot and the rejected rows, from a single parse of each document (F2).

    The parsed rows are stored once with their reasons; both tables read them, each the columns that it shows. They
    are dropped when both are written.
    """
    checked = cu.curate_checked(silver)
    part, n = store.stage(checked, "checked")
    rows = store.read_part("checked", part, checked.schema)
    res.metrics["checked_rows"] = n
    snapshot = snapshot_of(store)
    obs = Observation(f"curated-{time.time_ns()}")
    snapshot.replace(cu.clean_rows(rows, digest=True).observe(obs, F.count(F.lit(1)).alias("versions")))
    res.metrics["curated_versions"] = obs.get["versions"]
    res.metrics["curated_rows"] = snapshot.read().count()
    res.tables["curated"] = snapshot.path
    res.tables["quarantine"] = observed_write(store, cu.rejected_rows(rows), "quarantine", res.metrics, "quarantine")
    store.drop_part("checked", part)


def full_refresh(spark: SparkSession, store: TableStore, silver: DataFrame, hierarchy: DataFrame,
                 weekly_sales: DataFrame, cfg: CategoryConfig, segment: str | None = None,
                 run_ts: str | None = None) -> RunResult:
    """Silver -> curated (latest per key) -> gold; every layer a staged version."""
    t0 = time.time()
    res = RunResult()
    src = cu.segment_filter(silver, segment)
    res.tables["silver"] = observed_write(store, src, "silver", res.metrics, "silver")
    curate_all(store, store.read("silver"), res)
    enrich(store, curated_rows(store), hierarchy, weekly_sales, cfg, res)
    res.metrics["duration_sec"] = round(time.time() - t0, 3)
    _append_run_metrics(spark, store, "full", run_ts, res)
    return res


def changes_refresh(spark: SparkSession, store: TableStore, arrived: DataFrame,
                    hierarchy: DataFrame, weekly_sales: DataFrame, cfg: CategoryConfig,
                    segment: str | None = None, run_ts: str | None = None) -> tuple[RunResult, DataFrame]:
    """Arrived raw items -> silver (append) -> curated (touched keys merged) ->
    gold. Returns the touched GTINs as a DataFrame (for the publish job)."""
    t0 = time.time()
    res = RunResult()
    filtered = cu.segment_filter(arrived, segment)
    # computed once: what the source gave is stored first, and read back from there
    old = store.version("silver")
    part = store.write(filtered, "silver", mode="append", skip_if_empty=True)
    if not part or (old is not None and part in old.parts):
        return res, spark.createDataFrame([], "GTIN string")
    src = store.read_part("silver", part, filtered.schema)
    touched = ch.touched_keys(src)
    snapshot = snapshot_of(store)
    res.metrics["curated_buckets"] = len(ch.merge_arrived(snapshot, src))  # the others stay as they are
    res.metrics["curated_rows"] = snapshot.read().count()
    res.tables["curated"] = snapshot.path
    enrich(store, curated_rows(store), hierarchy, weekly_sales, cfg, res)
    res.metrics["duration_sec"] = round(time.time() - t0, 3)
    _append_run_metrics(spark, store, "changes", run_ts, res)
    return res, touched


def _append_run_metrics(spark: SparkSession, store: TableStore, kind: str, run_ts: str | None,
                        res: RunResult) -> None:
    row = {"kind": kind, "run_ts": run_ts or time.strftime("%Y-%m-%dT%H:%M:%S"),
           **{k: float(v) for k, v in res.metrics.items()}}
    cols = sorted(k for k in row if k not in ("kind", "run_ts"))
    df = spark.createDataFrame([tuple([row["kind"], row["run_ts"]] + [row[c] for c in cols])],
                               ", ".join(["kind string", "run_ts string"] + [f"{c} double" for c in cols]))
    store.write(df, "run_metrics", mode="append")


def landed_silver(spark: SparkSession, store: TableStore, envelopes: DataFrame, fetch: pages.Fetcher, ingest_ts: str,
                  batch_size: int = 1000) -> DataFrame:
    """Landed key pages -> bronze keys -> request batches -> fetched items, stored as silver and read back."""
    keys = pages.page_keys(pages.parse_pages(envelopes).select("page"))
    store.write(pages.bronze(keys, ingest_ts), "bronze", skip_if_empty=True)
    batches = pages.id_batches(store.read("bronze"), batch_size)
    store.write(pages.fetch_batches(batches, fetch, ingest_ts), "silver")
    return store.read("silver")


def once(spark: SparkSession, path: str, make: Callable[[], DataFrame]) -> DataFrame:
    """The table at ``path``, written by ``make()`` unless an earlier run finished it (Spark's success mark)."""
    if not path_exists(spark, f"{path}/_SUCCESS"):
        save(make(), path, mode="overwrite")
    return spark.read.parquet(path)


def pages_to_gold(spark: SparkSession, store: TableStore, run: str, envelopes: DataFrame, fetch: pages.Fetcher,
                  ingest_ts: str, hierarchy: DataFrame, weekly_sales: DataFrame, cfg: CategoryConfig,
                  batch_size: int = 1000, round_batches: int = 100) -> RunResult:
    """Landed key pages to gold as one job that can be run again under the same name ``run`` (K1).

    Every stage is a table of the run: key pages -> keys -> request batches -> fetched items -> curated, rejected ->
    gold. A finished stage is read, not made again. Items are fetched ``round_batches`` requests at a time, each
    round a table of its own, so that a run that dies repeats the requests of one round at most.
    """
    t0, res, at = time.time(), RunResult(), f"{store.root}/run-{run}"
    keys = once(spark, f"{at}/keys", lambda: pages.bronze(
        pages.page_keys(pages.parse_pages(envelopes).select("page")), ingest_ts))
    batches = once(spark, f"{at}/batches", lambda: pages.id_batches(keys, batch_size))
    last = batches.agg(F.max("batch_no")).head()[0]
    rounds = 0 if last is None else last // round_batches + 1
    for k in range(rounds):
        here = batches.where(F.col("batch_no").between(k * round_batches, (k + 1) * round_batches - 1))
        once(spark, f"{at}/silver/round={k}", lambda here=here: pages.fetch_batches(here, fetch, ingest_ts))
    silver = spark.read.schema(SILVER_SCHEMA).parquet(*[f"{at}/silver/round={k}" for k in range(rounds)]) if rounds \
        else spark.createDataFrame([], SILVER_SCHEMA)
    checked = once(spark, f"{at}/checked", lambda: cu.curate_checked(silver))
    curated = once(spark, f"{at}/curated", lambda: cu.latest_per_key(cu.clean_rows(checked, digest=True)))
    rejected = once(spark, f"{at}/rejected", lambda: cu.rejected_rows(checked))
    gold = once(spark, f"{at}/gold", lambda: gold_rows(curated.select(*CURATED_COLUMNS), hierarchy, weekly_sales, cfg))
    for name, df in {"keys": keys, "batches": batches, "silver": silver, "curated": curated, "rejected": rejected,
                     "gold": gold}.items():
        res.tables[name] = f"{at}/{name}"
        res.metrics[f"{name}_rows"] = df.count()    # from the file footers
    res.metrics["duration_sec"] = round(time.time() - t0, 3)
    _append_run_metrics(spark, store, "pages_to_gold", run, res)
    return res


MANIFEST_COLUMNS = "target string, url string, gtin string, meta string"


def manifest_step(store: TableStore, gold: DataFrame, touched: DataFrame | None, res: RunResult,
                  folder: str = "images/") -> None:
    """Gold -> manifest winners -> plan against the stored manifest; both are stored.

    ``touched`` restricts the run to these GTINs: other targets keep their rows, and none are
    planned for removal. Nothing is sent anywhere: the plan is a table.
    """
    rows = pb.publishable(gold)
    if touched is not None:
        rows = pb.restrict_to_keys(rows, touched)
    now = pb.manifest(rows, folder=folder, winners_only=True).select(
        "target", "url", "gtin", pb.metadata_text("metadata").alias("meta"))
    now = now.where(F.col("target").isNotNull())
    part = store.write(now, "manifest_run")
    now = store.read_part("manifest_run", part, now.schema)
    had = store.exists("manifest")
    old = store.read("manifest") if had else store.spark.createDataFrame([], MANIFEST_COLUMNS)
    if touched is not None:
        known = old.join(now.select("target"), "target", "left_semi")
        rest = old.join(now.select("target"), "target", "left_anti")
    else:
        known, rest = old, old.limit(0)
    plan = pb.manifest_diff(known.select("target", "url", "meta"), now.select("target", "url", "meta"))
    res.tables["manifest_plan"] = observed_write(
        store, plan, "manifest_plan", res.metrics, "plan",
        {a: F.count_if(F.col("action") == F.lit(a)) for a in ("add", "update", "keep", "remove")})
    res.tables["manifest"] = observed_write(store, rest.unionByName(now), "manifest", res.metrics, "manifest")


def changes_with_manifest(spark: SparkSession, store: TableStore, arrived: DataFrame, hierarchy: DataFrame,
                          weekly_sales: DataFrame, cfg: CategoryConfig, run_ts: str | None = None) -> RunResult:
    """Changes refresh, then the manifest of the touched keys. No arrived item: nothing is done at all."""
    res, touched = changes_refresh(spark, store, arrived, hierarchy, weekly_sales, cfg, run_ts=run_ts)
    if res.tables:
        manifest_step(store, store.read("gold"), touched, res)
        _append_run_metrics(spark, store, "changes_manifest", run_ts, res)
    return res


def full_with_manifest(spark: SparkSession, store: TableStore, silver: DataFrame, hierarchy: DataFrame,
                       weekly_sales: DataFrame, cfg: CategoryConfig, run_ts: str | None = None) -> RunResult:
    """Full refresh, then the manifest and its plan, then one row of run metrics."""
    res = full_refresh(spark, store, silver, hierarchy, weekly_sales, cfg, run_ts=run_ts)
    manifest_step(store, store.read("gold"), None, res)
    _append_run_metrics(spark, store, "full_manifest", run_ts, res)
    return res


def category_profile(silver: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Best name per category code and the conflict summary."""
    p = pr.category_names(silver).orderBy("GpcCategoryCode")
    return p, pr.category_name_conflicts(silver)


def probes(curated: DataFrame, silver: DataFrame, bronze: DataFrame, keys: DataFrame) -> dict:
    """Data-quality probes: deleted counts, key lookups, silver ids missing
    from the key listing."""
    return {"deleted_counts": pr.deleted_counts(curated),
            "key_lookup": pr.json_isin(silver, keys),
            "missing_keys": pr.missing_keys(silver.select("Id").where(F.col("Id").isNotNull())
                                            .distinct(), bronze)}
