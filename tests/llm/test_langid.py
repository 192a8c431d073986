import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfspark.llm import langid

SF = "/root/testdata/sf0.01"


def brute(em, tr, st):
    n, k = em.shape
    a, b = np.zeros((n, k)), np.ones((n, k))
    a[0] = np.exp(st + em[0])
    for t in range(1, n):
        a[t] = (a[t - 1] @ np.exp(tr)) * np.exp(em[t])
        a[t] /= a[t].sum()
    for t in range(n - 2, -1, -1):
        b[t] = np.exp(tr) @ (b[t + 1] * np.exp(em[t + 1]))
        b[t] /= b[t].sum()
    p = a * b
    return p / p.sum(axis=1, keepdims=True)


@pytest.mark.parametrize("seed", range(4))
def test_marginals_equal_plain_forward_backward(seed):
    rng = np.random.default_rng(seed)
    lens = np.array([1, 0, langid.BLOCK, 3 * langid.BLOCK + 5, 2, langid.BLOCK + 1])
    em, tr, st = rng.normal(size=(lens.sum(), 3)), rng.normal(size=(3, 3)), rng.normal(size=3)
    got, at = langid.marginals(em, lens, tr, st), 0
    for n in lens:
        if n:
            assert np.allclose(got[at:at + n], brute(em[at:at + n], tr, st))
        at += n


@pytest.fixture(scope="module")
def model(spark):
    return langid.fit(spark.read.parquet(f"{SF}/documents.parquet"))


def test_held_out_accuracy(spark):
    out = langid.query(spark, SF).join(spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang"), "doc_id")
    held = out.where("held_out")
    assert held.count() > 250
    assert held.where("lang = lang_pred").count() / held.count() > 0.98
    assert out.where("score < 0 or score > 1").count() == 0


def test_code_switched_words(model, spark):
    docs = {r["lang"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").where("n_chars > 500").collect()}
    en, de = " ".join(docs["en"].split()[:30]), " ".join(docs["de"].split()[:30])
    spans = langid.Labeller(model).spans(f"{en} 12 | {de}")
    assert [s[0] for s in spans] == ["en", "de"]
    assert abs(spans[1][1] - 31) <= 2


def test_odd_rows(spark, make_docs, model):
    docs = make_docs([(1, None), (2, ""), (3, "12 | 34 --"), (4, "the and of " * 20_000), (4, "the and of " * 20_000),
                      (None, "le la les est et")])
    docs = docs.withColumn("score", F.lit("x")).withColumn("Lang_Pred", F.lit("y"))
    out = langid.label_documents(docs, model)
    assert out.columns == ["doc_id", "text", "lang", "source", "n_chars", "lang_pred", "score", "n_switches"]
    got = sorted(((r["doc_id"] or 0, r["lang_pred"], r["score"]) for r in out.collect()))
    assert [g[:2] for g in got] == [(0, "fr"), (1, "und"), (2, "und"), (3, "und"), (4, "en"), (4, "en")]
    assert got[1][2] == got[2][2] == got[3][2] == 0.0 and got[4] == got[5]


def test_empty_and_unlabelled(spark, make_docs):
    none = make_docs([]).where("false")
    assert langid.fit(none) is None
    assert langid.label_documents(none, None).count() == 0
    plain = make_docs(["the of"]).withColumn("lang", F.lit(None).cast("string"))
    assert [r["lang_pred"] for r in langid.label_documents(plain, langid.fit(plain)).collect()] == ["und"]


def test_stage_rejects_und_only_and_keeps_columns(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = langid.stage(spark, docs, SF)
    assert out.columns == docs.columns
    assert out.count() >= 0.99 * docs.count()


def test_emissions_equal_the_sum_of_features(spark, monkeypatch):
    kept = {}

    class Kept(langid.Model):
        def __init__(self, labels, index, weights, trans, start):
            kept.update(index)
            super().__init__(labels, index, weights, trans, start)
    monkeypatch.setattr(langid, "Model", Kept)
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = langid.training_rows(docs)[:120]
    model = langid.train(rows)
    words = ["", "a", "ab", "abc", "ж", "aжb", "the" * 700, *{langid.letters(w) for t, _ in rows for w in t.split()}][:2000]
    plain = np.array([sum((model.weights[kept[f]] for f in langid.features(w) if w and f in kept),
                          np.zeros(len(model.labels))) for w in words])
    for step in (langid.STEP_LETTERS, 50):
        monkeypatch.setattr(langid, "STEP_LETTERS", step)
        assert np.allclose(model.emissions(words), plain)


def test_slices_of_a_long_text_change_nothing(model, spark, monkeypatch):
    import pyarrow as pa
    rows = spark.read.parquet(f"{SF}/documents.parquet").where("n_chars > 300").limit(60).collect()
    text = pa.array([" 12 ".join(r["text"] for r in rows)])
    whole = langid.Labeller(model).label(text)
    spans = langid.Labeller(model).spans(text[0].as_py())
    monkeypatch.setattr(langid, "SLICE", 97)
    monkeypatch.setattr(langid, "CACHE_WORDS", 50)
    parts = langid.Labeller(model).label(text)
    assert whole[0] == parts[0] and np.allclose(whole[1], parts[1]) and list(whole[2]) == list(parts[2])
    assert langid.Labeller(model).spans(text[0].as_py()) == spans
