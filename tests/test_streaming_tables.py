import json
import os
import tempfile

import pytest

from shelfspark.sources.tables import TableStore
from shelfspark.streaming import changes as CH


def _doc(g, start, brand):
    return json.dumps({"TradeItem": {"Gtin": g, "DeliveryPurchasingInformationModule": {
        "DeliveryPurchasingInformation": {"StartAvailabilityDateTime": start}},
        "TradeItemDescriptionModule": {"TradeItemDescriptionInformation": {
            "BrandNameInformation": {"BrandName": brand}}}}})


def test_table_store_staged_overwrite(spark):
    root = tempfile.mkdtemp(prefix="shelf-")
    st = TableStore(spark, root)
    st.write(spark.createDataFrame([(1,), (2,)], "x int"), "t")
    cur = st.read("t")
    # rewrite the table from itself: the earlier version stays readable
    st.write(cur.selectExpr("x * 10 AS x"), "t")
    assert sorted(r.x for r in st.read("t").collect()) == [10, 20]
    st.write(spark.createDataFrame([(3, "a")], "x int, y string"), "t", mode="append")
    assert sorted((r.x, r.y) for r in st.read("t").collect()) == [(3, "a"), (10, None), (20, None)]
    assert st.write(spark.createDataFrame([], "x int"), "t2", skip_if_empty=True) == ""
    assert not st.exists("t2")


def test_upsert_equals_full_recompute(spark):
    from shelfspark.operators import curate as cu
    old = [("i1", _doc("a", "2020", "old"), "t1"), ("i2", _doc("b", "2020", "b1"), "t1"),
           ("i3", "{bad", "t1")]
    new = [("i1", _doc("a", "2021", "new"), "t2"), ("i4", _doc("c", "2020", "c1"), "t2"),
           ("i5", _doc("b", "2019", "older"), "t2")]
    s = "Id string, raw_json string, ingest_ts string"
    prev = cu.latest_per_key(cu.curate(spark.createDataFrame(old, s)))
    inc = CH.upsert_latest(prev, spark.createDataFrame(new, s))
    full = cu.latest_per_key(cu.curate(spark.createDataFrame(old + new, s)))
    key = lambda r: (r["GTIN"] or "", r["UpdatedAt"])
    assert sorted(map(tuple, inc.collect()), key=str) == sorted(map(tuple, full.collect()), key=str)
    assert {r["GTIN"]: r["BrandName"] for r in inc.collect()} == {"a": "new", "b": "b1", "c": "c1", None: None}
    assert CH.touched_keys(spark.createDataFrame(new, s)).count() == 3


def _land(folder, name, items):
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "w") as f:
        for i, (doc, ts) in enumerate(items):
            f.write(json.dumps({"Id": f"{name}-{i}", "raw_json": doc, "ingest_ts": ts}) + "\n")


def _brands(snapshot):
    return {r["GTIN"]: r["BrandName"] for r in snapshot.read().collect()}


def _files(path):
    """Name and time of change of every data file of a table."""
    found = {}
    for top, _, names in os.walk(path):
        for n in names:
            if n.startswith("part-"):
                found[os.path.join(os.path.relpath(top, path), n)] = os.stat(os.path.join(top, n)).st_mtime_ns
    return found


@pytest.mark.parametrize("start", [CH.start_changes_stream, CH.start_newest_stream])
def test_changes_stream_available_now(spark, start):
    root = tempfile.mkdtemp(prefix="shelf-stream-")
    landing, ck = os.path.join(root, "landing"), os.path.join(root, "ck")
    snap = CH.curated_snapshot(spark, os.path.join(root, "curated"), n_buckets=8)
    _land(landing, "b1.json", [(_doc("a", "2020", "a1"), "t1"), (_doc("b", "2020", "b1"), "t1"), ("{bad", "t1")])
    start(spark, landing, snap, ck).awaitTermination()
    assert _brands(snap) == {"a": "a1", "b": "b1", None: None}
    _land(landing, "b2.json", [(_doc("a", "2021", "a2"), "t2")])
    start(spark, landing, snap, ck).awaitTermination()
    assert _brands(snap) == {"a": "a2", "b": "b1", None: None}


def test_one_row_rewrites_one_bucket(spark):
    root = tempfile.mkdtemp(prefix="shelf-buckets-")
    s = "Id string, raw_json string, ingest_ts string"
    snap = CH.curated_snapshot(spark, os.path.join(root, "curated"), n_buckets=16)
    rows = [(f"i{g}", _doc(f"{g}", "2020", f"b{g}"), "t1") for g in range(200)]
    assert CH.merge_arrived(snap, spark.createDataFrame(rows, s)) == list(range(16))
    before = _files(snap.path)
    assert len(before) == 16
    one = spark.createDataFrame([("x", _doc("7", "2021", "new"), "t2")], s)
    changed = CH.merge_arrived(snap, one)
    after = _files(snap.path)
    assert len(changed) == 1
    rewritten = {f for f in after if after[f] != before.get(f)}
    assert len(rewritten) == 1 and all(f.startswith(f"bucket_of_16={changed[0]}/") for f in rewritten)
    assert len(after) == 16 and _brands(snap)["7"] == "new" and len(_brands(snap)) == 200
    # the same row again, and an older one: no file changes
    assert CH.merge_arrived(snap, one) == [] and _files(snap.path) == after
    assert CH.merge_arrived(snap, spark.createDataFrame([("x", _doc("9", "2019", "old"), "t0")], s)) == []
    assert CH.merge_arrived(snap, spark.createDataFrame([], s)) == [] and _files(snap.path) == after


def test_a_merge_that_died_is_finished_by_the_next_read(spark, monkeypatch):
    from shelfspark.sources.buckets import BucketedSnapshot
    root = tempfile.mkdtemp(prefix="shelf-redo-")
    s = "Id string, raw_json string, ingest_ts string"
    snap = CH.curated_snapshot(spark, os.path.join(root, "curated"), n_buckets=4)
    CH.merge_arrived(snap, spark.createDataFrame([(f"i{g}", _doc(f"{g}", "2020", "old"), "t1") for g in range(20)], s))
    finish = BucketedSnapshot._finish
    calls = []

    def dies(self):
        calls.append(1)
        if len(calls) == 2:
            raise KeyboardInterrupt
        finish(self)
    monkeypatch.setattr(BucketedSnapshot, "_finish", dies)
    with pytest.raises(KeyboardInterrupt):
        CH.merge_arrived(snap, spark.createDataFrame([("x", _doc("3", "2021", "new"), "t2")], s))
    monkeypatch.setattr(BucketedSnapshot, "_finish", finish)
    assert _brands(snap) == {f"{g}": "new" if g == 3 else "old" for g in range(20)}
    assert not os.path.exists(snap.copy)


def test_stateful_stream_with_late_and_repeated_items_equals_batch(spark):
    """Three triggers, each a query of its own that starts from the checkpoint; items late and repeated."""
    from shelfspark.operators import curate as cu
    root = tempfile.mkdtemp(prefix="shelf-state-")
    landing, ck = os.path.join(root, "landing"), os.path.join(root, "ck")
    snap = CH.curated_snapshot(spark, os.path.join(root, "curated"), n_buckets=4)
    turns = [[(_doc("a", "2021", "a2"), "t2"), (_doc("b", "2020", "b1"), "t1"), ("{bad", "t1"), (_doc("c", None, "c"), "t1")],
             [(_doc("a", "2020", "late"), "t1"), (_doc("b", "2020", "b1"), "t1"), (_doc("d", "2022", "d"), "t3"), ("[1]", "t0")],
             [(_doc("a", "2021", "a2"), "t2"), (_doc("b", "2020", "b2"), "t4"), (_doc("c", "2019", "c2"), "t0")]]
    seen, changed = [], []
    for k, items in enumerate(turns):
        _land(landing, f"b{k}.json", items)
        before = _files(snap.path) if k else {}
        CH.start_newest_stream(spark, landing, snap, ck).awaitTermination()
        after = _files(snap.path)
        changed.append(sum(after[f] != before.get(f) for f in after))
        seen += [(f"b{k}.json-{i}", *x) for i, x in enumerate(items)]
        full = cu.latest_curated(spark.createDataFrame(seen, "Id string, raw_json string, ingest_ts string"))
        got = snap.read().select(*full.columns)
        assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, full.collect()), key=str)
    # nothing but repeats: no file of the table changes
    files = _files(snap.path)
    _land(landing, "b3.json", turns[0] + turns[2])
    CH.start_newest_stream(spark, landing, snap, ck).awaitTermination()
    assert _files(snap.path) == files and changed[0] > 0


def test_keyed_state_lies_on_disk(spark):
    """RocksDB's files are in the checkpoint, not the maps of the store that keeps all rows in the heap."""
    root = tempfile.mkdtemp(prefix="shelf-store-")
    landing, ck = os.path.join(root, "landing"), os.path.join(root, "ck")
    snap = CH.curated_snapshot(spark, os.path.join(root, "curated"), n_buckets=4)
    had = {k: spark.conf.get(k, None) for k in CH.STATE_ON_DISK}
    for k in range(2):
        _land(landing, f"b{k}.json", [(_doc(f"{g}", f"202{k}", f"b{k}"), "t1") for g in range(20)])
        CH.start_newest_stream(spark, landing, snap, ck).awaitTermination()
    names = [n for _, _, files in os.walk(os.path.join(ck, "state")) for n in files]
    assert any(n.endswith(".zip") for n in names) and not any(n.endswith(".delta") for n in names)
    assert {k: spark.conf.get(k, None) for k in CH.STATE_ON_DISK} == had
    assert _brands(snap) == {f"{g}": "b1" for g in range(20)}


def test_newest_versions_is_combined_before_the_shuffle(spark):
    from shelfspark.operators import curate as cu
    silver = spark.createDataFrame([("i", _doc("a", "2020", "x"), "t")], "Id string, raw_json string, ingest_ts string")
    plan = CH.newest_versions(cu.curate(silver, digest=True))._jdf.queryExecution().executedPlan().toString()
    assert "partial_max" in plan


def test_unreadable_pointer_is_an_error_and_failed_append_is_invisible(spark):
    from pyspark.sql import functions as F
    root = tempfile.mkdtemp(prefix="shelf-pointer-")
    st = TableStore(spark, root)
    st.write(spark.range(50).toDF("x"), "t")
    with pytest.raises(Exception):  # noqa: B017 - whatever the engine raises
        st.write(spark.range(9).select(F.raise_error(F.lit("no")).cast("bigint").alias("x")), "t", mode="append")
    assert st.read("t").count() == 50
    st.write(spark.range(3).toDF("x"), "t", mode="append", tag="b#1")
    st.write(spark.range(3).toDF("x"), "t", mode="append", tag="b#1")
    assert st.read("t").count() == 53
    last = max((d for d in os.listdir(f"{root}/t") if d.startswith("_p-")), key=lambda d: int(d[3:]))
    for f in os.listdir(f"{root}/t/{last}"):
        if f.startswith("part"):
            with open(f"{root}/t/{last}/{f}", "w") as out:
                out.write("{damaged")
    with pytest.raises(Exception):  # noqa: B017
        st.exists("t")
    assert not TableStore(spark, root).exists("another")


def _staged_in(do):
    """The names of what the merges in ``do`` stage."""
    seen = []
    from shelfspark.sources import buckets
    real = buckets.staged
    buckets.staged = lambda df, name, *a: seen.append(name) or real(df, name, *a)
    try:
        do()
    finally:
        buckets.staged = real
    return seen


def test_first_merge_stages_nothing_and_later_ones_drop_what_they_staged(spark):
    from shelfspark.session import ensure_checkpoint_dir
    root = tempfile.mkdtemp(prefix="shelf-first-")
    s = "Id string, raw_json string, ingest_ts string"
    snap = CH.curated_snapshot(spark, os.path.join(root, "curated"), n_buckets=4)
    rows = spark.createDataFrame([(f"i{g}", _doc(f"{g}", "2020", "old"), "t1") for g in range(20)], s)
    scratch = os.path.join(ensure_checkpoint_dir(spark), "shelfspark")
    left = lambda: {f for f in os.listdir(scratch) if f.startswith("merge_")} if os.path.exists(scratch) else set()
    before = left()
    assert _staged_in(lambda: CH.merge_arrived(snap, rows)) == []
    more = spark.createDataFrame([("x", _doc("3", "2021", "new"), "t2"), ("y", _doc("z", "2021", "z"), "t2"), ("n", "{bad", "t2")], s)
    assert _staged_in(lambda: CH.merge_arrived(snap, more)) == ["merge_rows", "merge_won"]
    assert left() == before
    assert _brands(snap) == {**{f"{g}": "new" if g == 3 else "old" for g in range(20)}, "z": "z", None: None}


def test_a_first_write_that_died_is_no_table(spark):
    root = tempfile.mkdtemp(prefix="shelf-half-")
    s = "Id string, raw_json string, ingest_ts string"
    snap = CH.curated_snapshot(spark, os.path.join(root, "curated"), n_buckets=4)
    CH.merge_arrived(snap, spark.createDataFrame([("i", _doc("a", "2020", "half"), "t1")], s))
    os.remove(os.path.join(snap.path, "_SUCCESS"))
    assert not snap.exists() and snap.read().count() == 0
    CH.merge_arrived(snap, spark.createDataFrame([("i", _doc("b", "2020", "b"), "t1")], s))
    assert _brands(snap) == {"b": "b"}


def test_landed_files_are_compressed_and_dropped(spark):
    from shelfspark.plans import queries as Q
    silver = spark.createDataFrame([("i", _doc("a", "2020", "x"), "t")], "Id string, raw_json string, ingest_ts string")
    seen = []

    def start(spark, landing, snapshot, checkpoint):
        seen.append((landing, [f for f in os.listdir(landing) if f.startswith("part-")]))
        return CH.start_changes_stream(spark, landing, snapshot, checkpoint)
    assert Q._landed_in_turns(spark, "unused", [silver], start).count() == 1
    (landing, names), = seen
    assert names and all(n.endswith(".json.gz") for n in names) and not os.path.exists(landing)
