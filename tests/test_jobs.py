import tempfile

from pyspark.sql import functions as F

from shelfspark.operators import curate as cu
from shelfspark.plans import fixtures as fx
from shelfspark.plans import jobs as J
from shelfspark.plans import rules as R
from shelfspark.sources.tables import TableStore
from small_tables import SF_SMALL


def test_full_then_changes_refresh(spark):
    store = TableStore(spark, tempfile.mkdtemp(prefix="shelf-jobs-"))
    cfg = J.CategoryConfig(R.EXCLUSION_RULES, R.OWN_PROVIDER, R.PLACEHOLDER, R.AS_OF)
    silver = fx.silver(spark, SF_SMALL)
    old = silver.where(F.col("ingest_ts") < F.lit(R.RUN_START))
    new = silver.where(F.col("ingest_ts") >= F.lit(R.RUN_START))
    h, ws = fx.hierarchy(spark, SF_SMALL), fx.weekly_sales(spark, SF_SMALL)

    res = J.full_refresh(spark, store, old, h, ws, cfg, run_ts="r1")
    n_latest_old = cu.latest_per_key(cu.curate(old)).count()
    assert res.metrics["curated_rows"] == n_latest_old
    assert res.metrics["gold_rows"] == n_latest_old
    rejected = store.read("quarantine")
    assert sorted(map(tuple, rejected.collect()), key=str) == sorted(map(tuple, cu.quarantine(old).collect()), key=str)
    assert store.read("gold").count() == n_latest_old

    res2, touched = J.changes_refresh(spark, store, new, h, ws, cfg, run_ts="r2")
    full = cu.latest_per_key(cu.curate(silver))
    cols = ["GTIN", "BrandName", "UpdatedAt"]
    got = sorted(map(tuple, J.curated_rows(store).select(*cols).collect()), key=str)
    assert got == sorted(map(tuple, full.select(*cols).collect()), key=str)
    assert touched.count() == new.select("Id").distinct().count()
    assert store.read("run_metrics").count() == 2
    assert "Case_GTIN" in store.read("gold").columns


def test_manifest_jobs_and_empty_changes(spark):
    store = TableStore(spark, tempfile.mkdtemp(prefix="shelf-manifest-"))
    cfg = J.CategoryConfig(R.EXCLUSION_RULES, R.OWN_PROVIDER, R.PLACEHOLDER, R.AS_OF)
    silver = fx.silver(spark, SF_SMALL)
    old = silver.where(F.col("ingest_ts") < F.lit(R.RUN_START))
    new = silver.where(F.col("ingest_ts") >= F.lit(R.RUN_START))
    h, ws = fx.hierarchy(spark, SF_SMALL), fx.weekly_sales(spark, SF_SMALL)
    first = J.full_with_manifest(spark, store, old, h, ws, cfg, run_ts="r1")
    assert first.metrics["plan_add"] == first.metrics["plan_rows"] == first.metrics["manifest_rows"] > 0
    none = J.changes_with_manifest(spark, store, new.where("false"), h, ws, cfg, run_ts="r2")
    assert none.tables == {}
    J.changes_with_manifest(spark, store, new, h, ws, cfg, run_ts="r3")
    other = TableStore(spark, tempfile.mkdtemp(prefix="shelf-manifest-"))
    J.full_with_manifest(spark, other, silver, h, ws, cfg)
    cols = ["target", "url", "gtin", "meta"]
    assert sorted(map(tuple, store.read("manifest").select(*cols).collect())) == sorted(
        map(tuple, other.read("manifest").select(*cols).collect()))


def _scratch(spark):
    import os
    from shelfspark.session import ensure_checkpoint_dir
    at = os.path.join(ensure_checkpoint_dir(spark), "shelfspark")
    return {f for f in os.listdir(at) if not f.startswith("silver-landing")} if os.path.exists(at) else set()


def _data_files(root):
    import os
    return [n for _, _, names in os.walk(root) for n in names if n.startswith("part-") and n.endswith(".parquet")]


def test_manifest_jobs_leave_no_working_copies(spark):
    import os
    root = tempfile.mkdtemp(prefix="shelf-space-")
    store = TableStore(spark, root)
    cfg = J.CategoryConfig(R.EXCLUSION_RULES, R.OWN_PROVIDER, R.PLACEHOLDER, R.AS_OF)
    silver, before = fx.silver(spark, SF_SMALL), _scratch(spark)
    h, ws = fx.hierarchy(spark, SF_SMALL), fx.weekly_sales(spark, SF_SMALL)
    J.full_with_manifest(spark, store, silver.where(F.col("ingest_ts") < F.lit(R.RUN_START)), h, ws, cfg)
    J.changes_with_manifest(spark, store, silver.where(F.col("ingest_ts") >= F.lit(R.RUN_START)), h, ws, cfg)
    assert _scratch(spark) == before and os.listdir(f"{root}/checked") == []
    names = _data_files(root)
    assert names and all(n.endswith(".zstd.parquet") for n in names)


def test_run_summary_leaves_its_tables_only(spark):
    from shelfspark.plans import queries as Q
    before = _scratch(spark)
    assert Q.q_run_summary(spark, SF_SMALL).count() == 1
    assert {f.rsplit("-", 1)[0] for f in _scratch(spark) - before} == {"run"}


def test_saved_tables_leave_no_shuffle_files(spark):
    import time
    from shelfspark.session import save, staged
    blocks = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def files():
        found, it = set(), blocks.getAllFiles().iterator()
        while it.hasNext():
            found.add(it.next().getName())
        return {f for f in found if f.startswith("shuffle_")}
    df = spark.range(5000).repartition(3).groupBy((F.col("id") % 7).alias("g")).agg(F.max("id").alias("m"))
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before, had = files(), spark.conf.get(key)
    save(df, f"{tempfile.mkdtemp(prefix='shelf-shuffle-')}/t")
    for _ in range(50):       # files go a moment later
        if not files() - before:
            break
        time.sleep(0.2)
    assert not files() - before and spark.conf.get(key) == had
    # the frame can be used again
    assert staged(df, "again").count() == df.count() == 7


def test_landed_pages_to_silver(spark):
    import json
    store = TableStore(spark, tempfile.mkdtemp(prefix="shelf-landed-"))
    pages = [(json.dumps({"Items": [{"Id": "a"}, {"Id": "b"}]}),), (json.dumps({"Items": []}),),
             (json.dumps({"Items": [{"Id": "b"}, {"Id": "c"}]}),)]
    fetch = lambda ids: [{"CatalogueItemInfo": {"Id": i}} for i in ids]
    got = J.landed_silver(spark, store, spark.createDataFrame(pages, "envelope string"), fetch, "t", batch_size=2)
    assert sorted(r["Id"] for r in got.collect()) == ["a", "b", "c"]


def test_curated_and_rejected_rows_come_from_one_parse(spark, monkeypatch):
    """Both tables are read from rows that one from_json made of each document."""
    calls = []
    read = cu.parse_fields

    def noted(*a, **k):
        calls.append(a)
        return read(*a, **k)
    monkeypatch.setattr(cu, "parse_fields", noted)
    store = TableStore(spark, tempfile.mkdtemp(prefix="shelf-checked-"))
    silver = fx.silver(spark, SF_SMALL)
    res = J.RunResult()
    J.curate_all(store, silver, res)
    assert len(calls) == 1 and res.metrics["checked_rows"] == silver.count()
    monkeypatch.setattr(cu, "parse_fields", read)
    full = cu.latest_curated(silver)
    got = J.curated_rows(store).select(*full.columns)
    assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, full.collect()), key=str)
    assert sorted(map(tuple, store.read("quarantine").collect()), key=str) == sorted(
        map(tuple, cu.quarantine(silver).collect()), key=str)


def test_pages_to_gold_resumes_after_each_stage(spark, monkeypatch):
    """Killed after every write, the job goes on where it was; no id is fetched twice."""
    import json
    import os
    import uuid
    root = tempfile.mkdtemp(prefix="shelf-resume-")
    asked = os.path.join(root, "asked")
    os.makedirs(asked)
    store = TableStore(spark, os.path.join(root, "tables"))
    cfg = J.CategoryConfig(R.EXCLUSION_RULES, R.OWN_PROVIDER, R.PLACEHOLDER, R.AS_OF)
    h, ws = fx.hierarchy(spark, SF_SMALL), fx.weekly_sales(spark, SF_SMALL)
    pages = spark.createDataFrame([(json.dumps({"Items": [{"Id": f"i{k}"} for k in range(a, a + 5)]}),) for a in (0, 3, 8)],
                                  "envelope string")

    def fetch(ids):
        with open(os.path.join(asked, uuid.uuid4().hex), "w") as f:
            f.write("\n".join(ids))
        return [{"CatalogueItemInfo": {"Id": i}, "TradeItem": {"Gtin": i[1:]}} for i in ids] + ["{bad"]

    real, budget = J.once, [0]

    def dies(session, path, make):
        done = J.path_exists(session, f"{path}/_SUCCESS")
        out = real(session, path, make)
        if not done:
            budget[0] -= 1
            if budget[0] < 0:
                raise KeyboardInterrupt
        return out
    monkeypatch.setattr(J, "once", dies)
    runs = 0
    while True:
        runs, budget[0] = runs + 1, 0
        try:
            res = J.pages_to_gold(spark, store, "r", pages, fetch, "t", h, ws, cfg, batch_size=4, round_batches=1)
            break
        except KeyboardInterrupt:
            assert runs < 20
    assert runs == 11                                   # keys, batches, four rounds, four tables and the last run
    ids = [i for f in os.listdir(asked) for i in open(os.path.join(asked, f)).read().split()]
    assert sorted(ids) == sorted(f"i{k}" for k in range(13))
    assert res.metrics["curated_rows"] == res.metrics["gold_rows"] == 14
    assert res.metrics["rejected_rows"] == 4 and res.metrics["keys_rows"] == 15
