import random
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from shelfspark.llm import spelling as S
from shelfspark.llm.fm_index import FmIndex


def one_error(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) > len(b):
        a, b = b, a
    i = 0
    while i < len(a) and a[i] == b[i]:
        i += 1
    return a[i + 1:] == b[i + 1:] if len(a) == len(b) else a[i:] == b[i + 1:]


def words_of(rows, min_letters=6, min_count=5, fault=True):
    """The contract read literally."""
    n = Counter()
    for i, t in rows:
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")
        for run in re.findall("[A-Za-zÀ-ÿ]+", low):
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if fault and h % 199 == 0:
                k = h % len(run)
                run = run[:k] + run[k + 1:]
            n[run] += 1
    return {w: c for w, c in n.items() if len(w) >= min_letters and c >= min_count}


def brute(vocab, ratio=5):
    out = {}
    for w, n in vocab.items():
        near = [x for x in vocab if one_error(w, x)]
        best = min(near, key=lambda x: (-vocab[x], x), default=None)
        form = best if best is not None and vocab[best] >= ratio * n else None
        out[w] = [form, None, n, len(near), vocab.get(form)]
    for w in out:
        end = w
        while out[end][0] is not None:
            end = out[end][0]
        out[w][1] = end
    return {(w, *v) for w, v in out.items()}


def rows_of(df):
    assert df.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    got = [tuple(r) for r in df.collect()]
    assert len(got) == len(set(got))
    return set(got)


@pytest.mark.parametrize("letters", ["ab", "abcdeféÿ"])
def test_index_finds_each_half_exactly(letters):
    rnd = random.Random(3)
    for _ in range(60):
        vocab = list({"".join(rnd.choice(letters) for _ in range(rnd.randint(1, 20))) for _ in range(50)})
        asked = list(dict.fromkeys(vocab[:25] + ["".join(rnd.choice(letters + "z") for _ in range(4)) for _ in range(9)]))
        index = FmIndex(vocab)
        for left in (True, False):
            q, w = index.near(asked, left)
            want = {(i, k) for i, x in enumerate(asked) for k, y in enumerate(vocab) if one_error(x, y)
                    and (y.startswith(x[:len(x) // 2]) if left else y.endswith(x[len(x) // 2:]))}
            assert sorted(zip(q.tolist(), w.tolist(), strict=True)) == sorted(want)


def vocabulary(seed, size=400):
    rnd = random.Random(seed)
    base = ["".join(rnd.choice(["ba", "co", "di", "é", "ru", "s"]) for _ in range(rnd.randint(2, 7))) for _ in range(size // 4)]
    vocab = {w: rnd.choice([5, 9, 60, 900]) for w in base}
    for w in base * 3:
        k = rnd.randrange(len(w) + 1)
        vocab.setdefault(w[:k] + rnd.choice(["", "x", "b"]) + w[k + rnd.randrange(2):], rnd.choice([5, 6, 40]))
    return {w: n for w, n in vocab.items() if w}


def test_groups_equal_brute_force_in_shards_and_blocks(spark, monkeypatch):
    for seed, (shard, block) in enumerate([(40_000, 40_000), (60, 7), (25, 3)]):
        monkeypatch.setattr(S, "SHARD", shard)
        monkeypatch.setattr(S, "BLOCK", block)
        monkeypatch.setattr(S, "HOT", 10 ** 9)
        vocab = vocabulary(seed)
        df = spark.createDataFrame(list(vocab.items()), "word string, n long")
        assert rows_of(S.group_variants(df)) == brute(vocab)


def test_long_chains_end_at_their_root(spark):
    vocab = {"abcdef" + "x" * k: 5 ** (k + 1) for k in range(9)}
    df = spark.createDataFrame(list(vocab.items()), "word string, n long")
    assert rows_of(S.group_variants(df)) == brute(vocab)


def test_query_rule_on_documents(spark, make_docs, tmp_path):
    rnd = random.Random(5)
    words = ["recEive", "receeve", "letters", "létters", "LÉtters", "A" * 3000, "short", "banana×", "banana"]
    docs = [(i, " ".join(rnd.choice(words) for _ in range(60)) + ("1" if i % 2 else "İſ")) for i in range(60)]
    docs += [(None, "receive letters " * 8), (7, None), (8, ""), (9, "receive receive"), (9, "receive receive")]
    make_docs(docs).select("*", *[F.lit(1).alias(c) for c in ("word", "n", "i", "t", "half")]).write.parquet(
        str(tmp_path / "documents.parquet"))
    got = rows_of(S.query(spark, str(tmp_path)))
    assert got == brute(words_of(docs)) and any(r[1] for r in got)


def test_whole_small_table_equals_brute_force(spark):
    sf = "/root/testdata/sf0.001"
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    assert rows_of(S.query(spark, sf)) == brute(words_of(docs))


def test_empty_table_and_held_words(spark, make_docs, monkeypatch):
    assert S.group_variants(S.word_counts(make_docs([]))).collect() == []
    monkeypatch.setattr(S, "HELD_WORDS", 2)
    rows = [(i, "alpha bravo charlie delta echoes foxtrot") for i in range(6)]
    got = {tuple(r) for r in S.word_counts(make_docs(rows)).collect()}
    assert got == set(words_of(rows, fault=False).items())
