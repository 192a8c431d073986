import corpus_pipeline as P
from shelfspark.llm import bpe, decontam, langid, line_dedup, simhash_dups

SF = "/root/testdata/sf0.001"


def test_stages_in_order():
    assert [f.__module__.rsplit(".", 1)[1] for _, f in P.STAGES] == [
        "langid", "line_dedup", "simhash_dups", "decontam", "bpe"]


def test_run_applies_every_decision(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    one = langid.stage(spark, docs, SF)
    two = line_dedup.stage(spark, one, SF)
    lines = sum(len(r["text"].split("\n")) for r in one.collect())
    assert sum(len(r["text"].split("\n")) for r in two.collect() if r["text"]) < lines
    assert all(r["n_chars"] == len(r["text"]) for r in two.collect())
    groups = {}
    for r in simhash_dups.near_duplicates(two).collect():
        groups.setdefault(r["component_id"], []).append(r["doc_id"])
    three = simhash_dups.stage(spark, two, SF)
    assert sorted(r["doc_id"] for r in three.collect()) == sorted(min(g) for g in groups.values())
    four = decontam.stage(spark, three, SF)
    texts = {r["doc_id"]: r["text"] for r in four.collect()}
    assert decontam.contaminated(four, spark.read.parquet(f"{SF}/benchmark.parquet")).count() == 0
    want = {i: s[0] for (i, t) in texts.items() for s in [bpe.Coder(bpe.VOCABULARY).encode([t])[0]]}
    got = {r["doc_id"]: r["n_tokens"] for r in P.run(spark, SF).collect()}
    assert got == {i: len(s) // 4 for i, s in want.items()}


def test_empty_table_runs_through(spark, make_docs):
    docs = make_docs([]).where("false")
    for _, stage in P.STAGES:
        docs = stage(spark, docs, SF)
    assert docs.count() == 0
