"""Spelling variants: words one code point apart, linked to the far commoner one, by FM-index search schemes.

Two words with one error between them share the first or the second half of either. Every word is therefore
sent to the shards of the halves that a near word can have, and asks in the shards of its own two halves. A
shard builds a bidirectional FM-index over its delimited vocabulary (``fm_index``) and runs the two searches of the
scheme: one half exactly, then the other with one error, by suffix-rank intervals. Shards hold about SHARD
words; a half that very many words share is cut into blocks of BLOCK words, and its words ask in each.

Defined results: null texts have no words and a null id prints as nothing; repeated rows count again; equal counts
go to the word that is smaller in code-point order; an empty table has no words; a run of letters of any length is one
word, taken whole. Only the text and id columns are read, so no other column can clash.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfspark.llm.common import cut, table, text_batches
from shelfspark.llm.fm_index import FmIndex

#: Letters of a word once A-Z are lower-cased (UTF-8 keeps all other bytes).
RUN = re.compile("[a-zÀ-ÿ]+")
#: Distinct words and bytes of them that a task holds before it hands their counts on.
HELD_WORDS, HELD_BYTES = 500_000, 64 << 20
#: Entries of a shard; words of a block of a half that more words share; a half is cut if more than one entry
#: in HOT has it, so that at most HOT halves are (the bound of the broadcast).
SHARD, BLOCK, HOT = 40_000, 40_000, 4096
MIN_LETTERS, MIN_COUNT, RATIO = 6, 5, 5
#: One run in so many loses a code point (the fault that the query plants).
FAULTS = 199


def with_fault(doc: bytes, run: str) -> str:
    """The run as the query reads it: a crc of id and run decides whether and where a code point is missing."""
    h = zlib.crc32(run.encode(), zlib.crc32(doc + b":"))
    if h % FAULTS:
        return run
    k = h % len(run)
    return run[:k] + run[k + 1:]


def word_counts(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", min_letters: int = MIN_LETTERS,
                min_count: int = MIN_COUNT, read: Callable[[bytes, str], str] = lambda _, run: run) -> DataFrame:
    """word, n: the words of all whole texts. ``read`` gives the word for an id and a run of letters."""
    def count(batches):
        held, size = Counter(), 0

        def out():
            return pa.RecordBatch.from_arrays([pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())],
                                              names=["word", "n"])
        for b in text_batches(batches):
            ids = b.column(0).to_pylist()
            for i, t in zip(ids, b.column(1).cast(pa.large_binary()).to_pylist(), strict=True):
                if t is None:
                    continue
                doc = (i or "").encode()
                for run, n in Counter(RUN.findall(t.lower().decode())).items():
                    word = read(doc, run)
                    if len(word) >= min_letters:
                        if word not in held:
                            size += len(word)
                        held[word] += n
                if len(held) > HELD_WORDS or size > HELD_BYTES:
                    yield out()
                    held, size = Counter(), 0
        if held:
            yield out()

    parts = docs.select(F.col(doc_id).cast("string").alias("i"), F.col(text).alias("t")).mapInArrow(count, "word string, n long")
    return parts.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= min_count)


def entries(vocab: DataFrame) -> DataFrame:
    """side, half, word, n, own: each word with every half that a word one error away can have; ``own``: its own half."""
    size, odd = F.length("word"), F.length("word") % 2
    own = {"L": F.floor(size / 2), "R": F.ceil(size / 2)}
    other = {"L": own["L"] + odd * 2 - 1, "R": own["R"] + 1 - odd * 2}  # of the words one longer and one shorter

    def half(side, length):
        begin = F.lit(1) if side == "L" else size - length + 1
        return F.substring("word", begin.cast("int"), length.cast("int"))

    places = [F.struct(F.lit(s).alias("side"), half(s, n[s]).alias("half"), F.lit(mine).alias("own"))
              for s in ("L", "R") for n, mine in ((own, True), (other, False))]
    return vocab.select("word", "n", F.explode(F.array(*places)).alias("p")).select("p.side", "p.half", "word", "n", "p.own")


def near_words(vocab: DataFrame) -> DataFrame:
    """word, near, near_n: all ordered pairs of words of ``vocab`` (word, n) with exactly one error between them."""
    spots = entries(vocab)
    total = spots.count()
    least = max(BLOCK, total // HOT)
    hot = (spots.groupBy("side", "half").count().where(F.col("count") > least)
           .select("side", "half", F.ceil(F.col("count") / BLOCK).cast("int").alias("blocks")))
    blocks = F.coalesce("blocks", F.lit(1))
    home = F.pmod(F.xxhash64("word"), blocks).cast("int")
    placed = (spots.join(F.broadcast(hot), ["side", "half"], "left")
              .select("*", home.alias("home"), F.explode(F.when(F.col("own"), F.sequence(F.lit(0), blocks - 1))
                                                         .otherwise(F.array(home))).alias("block")))
    shards = max(1, -(-total // SHARD))
    placed = placed.select(F.pmod(F.xxhash64("side", "half", "block"), F.lit(shards)).alias("shard"), "side", "word", "n",
                           "own", (F.col("block") == F.col("home")).alias("kept"))
    pairs = placed.groupBy("shard").applyInArrow(_search_shard, "word string, near string, near_n long")
    return pairs.distinct()


def _search_shard(rows: pa.Table) -> pa.Table:
    words, n = np.array(rows["word"].to_pylist(), dtype=object), rows["n"].to_numpy()
    side, own, kept = (rows[c].to_numpy(zero_copy_only=False) for c in ("side", "own", "kept"))
    counts = dict(zip(words[kept], n[kept], strict=True))
    vocab = list(counts)
    out = [], [], []
    if vocab:
        index = FmIndex(vocab)
        for s in ("L", "R"):
            asked = list(dict.fromkeys(words[own & (side == s)]))
            for a, b in zip(*index.near(asked, s == "L"), strict=True):
                out[0].append(asked[a])
                out[1].append(vocab[b])
                out[2].append(counts[vocab[b]])
    return pa.table([pa.array(x, t) for x, t in zip(out, (pa.string(), pa.string(), pa.int64()), strict=True)],
                    names=["word", "near", "near_n"])


def roots(forms: DataFrame, rounds: int) -> DataFrame:
    """word, root: where following ``forms`` (word, form) ends; each round doubles the reach of every link."""
    links = cut(forms.select("word", F.col("form").alias("root")), "spelling_links")
    for _ in range(rounds):
        on = links.select(F.col("word").alias("root"), F.col("root").alias("further"))
        links = cut(links.join(on, "root", "left").select("word", F.coalesce("further", "root").alias("root")), "spelling_links")
    return links


def group_variants(vocab: DataFrame, ratio: int = RATIO) -> DataFrame:
    """word, form, root, n, n_near, form_n of every word of ``vocab`` (distinct word, n).

    The form is the near word of largest n if that n is at least ``ratio`` (2 or more) times the word's; counts
    grow by it along a chain of forms, so that chains are short and end.
    """
    best = F.min(F.struct((-F.col("near_n")).alias("m"), "near"))
    stats = near_words(vocab).groupBy("word").agg(F.count("*").alias("n_near"), best.alias("b"))
    form = F.when(-F.col("b.m") >= ratio * F.col("n"), F.col("b.near"))
    table_ = cut(vocab.join(stats, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), form.alias("form"),
        F.when(form.isNotNull(), -F.col("b.m")).alias("form_n")), "spelling_forms")
    top = table_.agg(F.max("n"), F.min("n")).head()
    depth = 0
    while top[0] is not None and top[1] * ratio ** (depth + 1) <= top[0]:
        depth += 1                                     # no chain is longer than this
    ends = roots(table_.where("form is not null"), (depth - 1).bit_length() if depth > 1 else 0)
    return table_.join(ends, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def query(spark, sf_dir: str) -> DataFrame:
    vocab = word_counts(table(spark, sf_dir, "documents"), read=with_fault)
    return group_variants(cut(vocab, "spelling_words"))
