import math
import random
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from shelfspark.llm import kneser_ney as K

SF = "/root/testdata/sf0.001"


def tokens(t):
    return (t or "").encode().lower().split() + [None]


class Plain:
    """The same model with dictionaries."""

    def __init__(self, texts):
        self.c, pairs, self.ctx = Counter(), Counter(), Counter()
        for t in texts:
            w = tokens(t)
            self.c.update(w)
            pairs.update(zip([b""] + w, w))
            self.ctx.update([b""] + w[:-1])
        self.pairs, self.n, self.v = pairs, sum(self.c.values()), len(self.c)
        self.d = K.discounts([sum(x == i for x in pairs.values()) for i in range(1, 5)])
        self.follow = defaultdict(Counter)
        self.cont = Counter()
        for (u, w), x in pairs.items():
            self.follow[u][min(x, 3)] += 1
            self.cont[w] += 1
        self.low = K.discounts([sum(x == i for x in self.cont.values()) for i in range(1, 5)])
        self.rest = sum(self.low[min(x, 3) - 1] for x in self.cont.values()) / len(pairs) if pairs else 1.0

    def cut(self, x, d):
        return x - d[min(x, 3) - 1] if x else 0.0

    def lowest(self, w):
        total = len(self.pairs)
        return self.cut(self.cont[w], self.low) / total + self.rest / (self.v + 1)

    def prob(self, u, w):
        if not self.ctx[u]:
            return self.lowest(w)
        back = sum(self.d[i - 1] * x for i, x in self.follow[u].items()) / self.ctx[u]
        return self.cut(self.pairs[u, w], self.d) / self.ctx[u] + back * self.lowest(w)

    def score(self, t):
        w = tokens(t)
        base = sum(math.log10((self.c[x] + 0.1) / (self.n + 0.1 * (self.v + 1))) for x in w)
        return len(w), sum(self.c[x] > 0 for x in w), self.n, base, sum(math.log10(self.prob(*p)) for p in zip([b""] + w, w))


class Plain3(Plain):
    """The same of order 3."""

    def __init__(self, texts):
        super().__init__(texts)
        self.triples = Counter(t for x in texts for w in [[b""] + tokens(x)] for t in zip(w, w[1:], w[2:]))
        self.d3 = K.discounts([sum(x == i for x in self.triples.values()) for i in range(1, 5)])
        self.follow3, self.raw = defaultdict(Counter), self.pairs
        for (u, v, _), x in self.triples.items():
            self.follow3[u, v][min(x, 3)] += 1
        left = Counter((v, w) for _, v, w in self.triples)
        self.pairs = Counter({p: x if p[0] == b"" else left[p] for p, x in self.raw.items()})
        self.d = K.discounts([sum(x == i for x in self.pairs.values()) for i in range(1, 5)])
        self.ctx, self.follow = Counter(), defaultdict(Counter)
        for (u, _), x in self.pairs.items():
            self.ctx[u] += x
            self.follow[u][min(x, 3)] += 1

    def prob3(self, u, v, w):
        if (u, v) not in self.follow3:
            return self.prob(v, w)
        total = self.raw[u, v]
        back = sum(self.d3[i - 1] * x for i, x in self.follow3[u, v].items()) / total
        return self.cut(self.triples[u, v, w], self.d3) / total + back * self.prob(v, w)

    def score(self, t):
        w = [b""] + tokens(t)
        return (*super().score(t)[:4], math.log10(self.prob(*w[:2])) + sum(math.log10(self.prob3(*x)) for x in zip(w, w[1:], w[2:])))


def close(got, want):
    return got[:3] == want[:3] and all(math.isclose(a, b, rel_tol=1e-9, abs_tol=1e-9) for a, b in zip(got[3:], want[3:]))


def scores(df):
    return {r["doc_id"]: (r["n_tokens"], r["n_known"], r["train_tokens"], r["base_score"], r["score"]) for r in df.collect()}


def test_query_equals_plain_model(spark):
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    m = (Plain, Plain3)[K.ORDER - 2]([t for i, t in docs.items() if zlib.crc32(str(i).encode()) % 10])
    got = scores(K.query(spark, SF))
    assert got.keys() == docs.keys()
    assert all(close(got[i], m.score(t)) for i, t in docs.items())


@pytest.mark.parametrize("order,seed", [(2, 0), (2, 1), (3, 2), (3, 3)])
def test_many_ranges_and_flushes(spark, make_docs, monkeypatch, order, seed):
    import shelfspark.llm.kneser_ney as module
    monkeypatch.setattr(module, "RANGE", 200)
    rng = random.Random(seed)
    vocab = [f"w{int(rng.paretovariate(0.7))}" for _ in range(200)]
    texts = [" ".join(rng.choice(vocab) if rng.random() < 0.7 else "Hot" for _ in range(rng.randint(0, 60))) for _ in range(80)]
    m = (Plain, Plain3)[order - 2](texts)
    assert math.isclose(sum(m.prob(b"hot", w) for w in [*m.c, b"?"]), 1.0)
    assert order == 2 or math.isclose(sum(m.prob3(b"hot", b"hot", w) for w in [*m.c, b"?"]), 1.0)
    model = K.fit(make_docs(texts), order=order)
    assert model.ranges > 5
    new = [*texts, "never seen hot words", "hot hot unseen hot", ""]
    got = scores(K.score_documents(make_docs(new), model))
    assert all(close(got[i], m.score(t)) for i, t in enumerate(new))


def test_packing():
    import numpy as np
    a = np.sort(np.random.default_rng(0).integers(0, 2 ** 63, 1000).astype(np.uint64) * np.uint64(2))
    assert (K.unpack(K.pack(a), 1000) == a).all()


@pytest.mark.parametrize("order", [2, 3])
def test_odd_rows(spark, make_docs, order):
    docs = make_docs([(1, None), (2, ""), (2, ""), (None, "A b"), (3, "a B " * 100_000)])
    docs = docs.withColumn("score", F.lit("clash")).withColumn("range", F.lit(1))
    m = (Plain, Plain3)[order - 2]([r["text"] for r in docs.collect()])
    out = K.score_documents(docs, K.fit(docs, order=order)).collect()
    assert len(out) == 5
    assert all(close((r["n_tokens"], r["n_known"], r["train_tokens"], r["base_score"], r["score"]),
                     m.score({1: None, 2: "", None: "a b", 3: "a b " * 100_000}[r["doc_id"]])) for r in out)
    none = docs.where("false")
    assert K.score_documents(none, K.fit(none, order=order)).count() == 0
    assert all(r["score"] == 0 and r["train_tokens"] == 0 for r in K.score_documents(docs, K.fit(none, order=order)).collect())
