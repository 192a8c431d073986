"""Language identification of code-switched text with a linear-chain conditional random field.

Each white-space word of a document gets a label (a language). Its emission scores come from
affix, character n-gram and lexicon features; the transition scores between neighbouring labels
are learned with them by maximising the likelihood of the label sequences. Marginals of every
word come from forward-backward over the whole text.

Defined results: null text or text without letters gives ``und`` with score 0; words without
letters take part in the chain with flat emissions and in no vote; equal votes go to the label
that sorts first; repeated rows are labelled alike; an empty table, or one without labelled rows
to learn from, gives ``und``; input columns named like an output column are replaced.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfspark.llm.common import text_batches, without

#: Bound of the training sample: documents of each language and characters of a document.
DOCS_PER_LANG, MAX_CHARS = 80, 20_000
#: Words of a training sequence; mean words of a run in it before another document goes on.
SEQ, RUN = 32, 10
#: Distinct words, and code points of them, whose emissions a task keeps before it starts anew.
CACHE_WORDS, CACHE_LETTERS = 300_000, 6_000_000
#: Bytes of texts labelled at once; words of a longer text that are labelled at once; letters featurised at once.
STEP_BYTES, SLICE, STEP_LETTERS = 512 << 10, 100_000, 500_000
#: Words of a block of the chain.
BLOCK = 64
OUT = {"lang_pred": T.StringType(), "score": T.DoubleType(), "n_switches": T.IntegerType()}


def letters(word: str) -> str:
    """The lower-case letters of a word."""
    w = word.lower()
    return w if w.isalpha() else "".join(c for c in w if c.isalpha())


def features(w: str) -> list[str]:
    """Lexicon, affix and n-gram features of the letters of a word."""
    p = f"^{w}$"
    out = ["=" + w]
    out += ["<" + w[:k] for k in (1, 2, 3)] + [">" + w[-k:] for k in (1, 2, 3)]
    out += [p[i:i + 2] for i in range(len(p) - 1)] + [p[i:i + 3] for i in range(len(p) - 2)]
    return out


GRAM2, GRAM3, PREFIX, SUFFIX = range(4)


class Model:
    """Feature weights by label, transitions and start scores.

    Features of up to three letters are looked up by number: their kind and symbols in one integer.
    """

    def __init__(self, labels, index, weights, trans, start):
        self.labels, self.weights, self.trans, self.start = labels, weights, trans, start
        self.lexicon = {f[1:]: i for f, i in index.items() if f[0] == "="}
        short = [({"<": PREFIX, ">": SUFFIX}.get(f[0], len(f) - 2), f.lstrip("<>"), i) for f, i in index.items() if f[0] != "="]
        self.symbols = np.unique([ord(c) for _, f, _ in short for c in f] or [0])
        self.base = len(self.symbols) + 2               # 0: no symbol, base - 1: one that no feature has
        kinds = np.array([k for k, _, _ in short], dtype=np.int64)
        syms = np.array([[ord(c) for c in f.ljust(3, "\0")] for _, f, _ in short], dtype=np.int64).reshape(-1, 3)
        keys = self._keys(kinds, *np.where(syms > 0, self._symbols(syms), 0).T)
        order = np.argsort(keys)
        self.keys, self.rows = keys[order], np.array([i for _, _, i in short], dtype=np.int64)[order]

    def _symbols(self, codes):
        at = np.minimum(np.searchsorted(self.symbols, codes), len(self.symbols) - 1)
        return np.where(self.symbols[at] == codes, at + 1, self.base - 1)

    def _keys(self, kind, a, b, c):
        return ((kind * self.base + a) * self.base + b) * self.base + c

    def _add(self, out, owner, keys):
        """Add the weights of the features with these keys to the rows of ``out`` that own them."""
        at = np.minimum(np.searchsorted(self.keys, keys), max(len(self.keys) - 1, 0))
        hit = self.keys[at] == keys if len(self.keys) else np.zeros(len(keys), dtype=bool)
        owner, rows = owner[hit], self.rows[at[hit]] if len(self.keys) else at[hit]
        for c in range(out.shape[1]):
            out[:, c] += np.bincount(owner, weights=self.weights[rows, c], minlength=len(out))

    def _grams(self, out, text: str, owner, starts: int):
        """Bigrams and trigrams of ``text`` whose first symbol is among the first ``starts``, inside one owner."""
        sym = self._symbols(np.frombuffer(text.encode("utf-32-le"), dtype=np.uint32).astype(np.int64))
        for n in (2, 3):
            i = np.arange(max(min(starts, len(sym) - n + 1), 0))
            i = i[owner[i] == owner[i + n - 1]]
            self._add(out, owner[i], self._keys(n - 2, sym[i], sym[i + 1], sym[i + 2] if n == 3 else 0))

    def emissions(self, words: list[str]) -> np.ndarray:
        """Scores of words (their letters); no letters: zeros. Words go STEP_LETTERS letters at a time."""
        out = np.zeros((len(words), len(self.labels)))
        first = 0
        while first < len(words):
            last, size = first + 1, len(words[first])
            while last < len(words) and size + len(words[last]) <= STEP_LETTERS:
                size += len(words[last])
                last += 1
            some = words[first:last]
            part = out[first:last]
            full = [f"^{w}$" if w else "" for w in some]
            lens = np.fromiter(map(len, full), dtype=np.int64, count=len(full))
            if size <= STEP_LETTERS:
                self._grams(part, "".join(full), np.repeat(np.arange(len(some)), lens), int(lens.sum()))
            else:
                for a in range(0, len(full[0]), STEP_LETTERS):
                    piece = full[0][a:a + STEP_LETTERS + 2]
                    self._grams(part, piece, np.zeros(len(piece), dtype=np.int64), STEP_LETTERS)
            ends = "".join(w[:3].ljust(3, "\0") + w[-3:].rjust(3, "\0") for w in some)
            codes = np.frombuffer(ends.encode("utf-32-le"), dtype=np.uint32).astype(np.int64).reshape(-1, 6)
            sym = np.where(codes > 0, self._symbols(codes), 0)
            owner = np.flatnonzero(lens)
            sym, n = sym[owner], lens[owner] - 2
            for k in (1, 2, 3):
                a, b, c = (np.where(j < k, sym[:, j], 0) for j in range(3))
                self._add(part, owner, self._keys(PREFIX, a, b, c))
                # a suffix of k letters starts 3 - k into the last three; a shorter word is its own suffix
                at = 6 - np.minimum(n, k)
                a, b, c = (np.where(at + j < 6, np.take_along_axis(sym, np.minimum(at + j, 5)[:, None], 1)[:, 0], 0)
                           for j in range(3))
                self._add(part, owner, self._keys(SUFFIX, a, b, c))
            rows = np.fromiter((self.lexicon.get(w, -1) if w else -1 for w in some), dtype=np.int64, count=len(some))
            part[rows >= 0] += self.weights[rows[rows >= 0]]
            first = last
        return out


def before_first(trans: np.ndarray, start: np.ndarray) -> np.ndarray:
    """A state before the first word, chosen so that one transition gives the start scores."""
    return np.linalg.lstsq(np.exp(trans - trans.max()).T, np.exp(start - start.max()), rcond=None)[0]


def transfer(em: np.ndarray, trans: np.ndarray) -> np.ndarray:
    """Product of the transfer matrices of a chain's words, scaled."""
    k = em.shape[1]
    e, tr = np.exp(em - em.max(axis=1, keepdims=True)) + 1e-300, np.exp(trans - trans.max())
    n = -(-len(e) // BLOCK)
    e = np.concatenate([e, np.full((n * BLOCK - len(e), k), np.nan)]).reshape(n, BLOCK, k)
    total = np.broadcast_to(np.eye(k), (n, k, k)).copy()
    for t in range(BLOCK):
        go = ~np.isnan(e[:, t, 0])
        m = (total[go] @ tr) * e[go, t][:, None, :]
        total[go] = m / m.sum(axis=(1, 2), keepdims=True)
    out = np.eye(k)
    for m in total:
        out = out @ m
        out /= out.sum()
    return out


def marginals(em: np.ndarray, lens: np.ndarray, trans: np.ndarray, start: np.ndarray, before=None, after=None) -> np.ndarray:
    """Posterior label probabilities of every word of chains that lie one after another in ``em``.

    ``before`` and ``after`` are the forward state before and the backward state after a single chain, if it is
    part of a longer one.

    Chains are cut into blocks of BLOCK words; the product of a block's transfer matrices
    carries the exact forward and backward state across it, so that all blocks of all chains
    run side by side and a very long chain costs no long loop.
    """
    n, k = em.shape
    out = np.zeros((n, k))
    lens = np.asarray(lens)
    chains = np.flatnonzero(lens)
    if not len(chains):
        return out
    first = np.concatenate(([0], np.cumsum(lens)[:-1]))[chains]
    length = lens[chains]
    nb = -(-length // BLOCK)
    chain_of = np.repeat(np.arange(len(chains)), nb)
    block_in = np.arange(len(chain_of)) - np.repeat(np.cumsum(nb) - nb, nb)
    at = first[chain_of] + block_in * BLOCK
    size = np.minimum(BLOCK, length[chain_of] - block_in * BLOCK)
    steps = np.arange(BLOCK)
    real = steps[None, :] < size[:, None]
    pos = np.where(real, at[:, None] + steps[None, :], 0)
    e = np.exp(em - em.max(axis=1, keepdims=True)) + 1e-300
    tr = np.exp(trans - trans.max())
    e = e[pos]                                   # blocks x BLOCK x labels
    eye = np.eye(k)
    total = np.broadcast_to(eye, (len(at), k, k)).copy()
    for t in range(BLOCK):                       # transfer matrix of each block
        go = real[:, t]
        m = (total[go] @ tr) * e[go, t][:, None, :]
        total[go] = m / m.sum(axis=(1, 2), keepdims=True)
    order = np.argsort(block_in, kind="stable")
    bounds = np.searchsorted(block_in[order], np.arange(nb.max() + 1))
    fwd = np.zeros((len(at), k))                 # state before the block
    bwd = np.ones((len(at), k))                  # state after the block
    fwd[order[bounds[0]:bounds[1]]] = before_first(trans, start) if before is None else before
    if after is not None:
        bwd[-1] = after
    for b in range(1, nb.max()):
        ids = order[bounds[b]:bounds[b + 1]]
        v = np.einsum("nk,nkl->nl", fwd[ids - 1], total[ids - 1])
        fwd[ids] = v / np.abs(v).sum(axis=1, keepdims=True)
    for b in range(nb.max() - 2, -1, -1):
        nxt = order[bounds[b + 1]:bounds[b + 2]]
        v = np.einsum("nkl,nl->nk", total[nxt], bwd[nxt])
        bwd[nxt - 1] = v / v.sum(axis=1, keepdims=True)
    alpha = np.zeros_like(e)
    v = fwd
    for t in range(BLOCK):
        v = (v @ tr) * e[:, t]
        v = v / np.maximum(np.abs(v).sum(axis=1, keepdims=True), 1e-300)
        alpha[:, t] = v
    v = bwd.copy()
    for t in range(BLOCK - 1, -1, -1):
        go = real[:, t]
        post = alpha[go, t] * v[go]
        post = post / np.maximum(post.sum(axis=1, keepdims=True), 1e-300)
        out[pos[go, t]] = post
        w = (v[go] * e[go, t]) @ tr.T
        v[go] = w / w.sum(axis=1, keepdims=True)
    return out


def _sequences(docs: list[tuple[list[str], int]], rng) -> tuple[list[list[str]], list[list[int]]]:
    """Training sequences of SEQ words: runs of random length, each from a document drawn anew."""
    queues: dict[int, list] = {}
    for words, y in docs:
        queues.setdefault(y, []).append(words)
    labels = sorted(queues)
    streams = {y: [w for d in queues[y] for w in d] for y in labels}
    at = dict.fromkeys(labels, 0)
    n_seq = max(1, min(4000, sum(map(len, streams.values())) // SEQ))
    xs, ys = [], []
    for _ in range(n_seq):
        x, y = [], []
        while len(x) < SEQ:
            lab = labels[rng.integers(len(labels))]
            run = min(int(rng.geometric(1 / RUN)), SEQ - len(x))
            s = streams[lab]
            got = [s[(at[lab] + j) % len(s)] for j in range(run)]
            at[lab] = (at[lab] + run) % len(s)
            x += got
            y += [lab] * run
        xs.append(x)
        ys.append(y)
    return xs, ys


def train(rows: list[tuple[str, str]], seed: int = 7, rounds: int = 40, l2: float = 1e-4) -> Model | None:
    """Fit the model on (text, lang) rows by full-batch adaptive gradient steps on the likelihood."""
    docs = [([w for w in map(letters, t.split()) if w], lang) for t, lang in rows]
    labels = sorted({lang for w, lang in docs if w})
    if not labels:
        return None
    docs = [(w, labels.index(lang)) for w, lang in docs if w]
    rng = np.random.default_rng(seed)
    xs, ys = _sequences(docs, rng)
    types = {w: i for i, w in enumerate(dict.fromkeys(w for x in xs for w in x))}
    per_type = [features(w) for w in types]
    seen: dict[str, int] = {}
    for fs in per_type:
        for f in set(fs):
            seen[f] = seen.get(f, 0) + 1
    index = {f: i for i, f in enumerate(sorted(f for f, c in seen.items() if c >= 2 or f[0] == "="))}
    owner = np.repeat(np.arange(len(per_type)), [len(f) for f in per_type])
    flat = np.asarray([index.get(f, -1) for fs in per_type for f in fs])
    owner, flat = owner[flat >= 0], flat[flat >= 0]
    x = np.asarray([[types[w] for w in s] for s in xs])
    y = np.asarray(ys)
    k, n = len(labels), len(labels) and len(xs)
    w, tr, st = np.zeros((len(index), k)), np.zeros((k, k)), np.zeros(k)
    hist = [np.full(a.shape, 1e-8) for a in (w, tr, st)]
    lens = np.full(n, SEQ)
    gold = np.zeros((n, SEQ, k))
    np.put_along_axis(gold, y[:, :, None], 1.0, axis=2)
    gold_tr = np.zeros((k, k))
    np.add.at(gold_tr, (y[:, :-1].ravel(), y[:, 1:].ravel()), 1.0)
    for _ in range(rounds):
        em_t = np.stack([np.bincount(owner, weights=w[flat, c], minlength=len(types)) for c in range(k)], axis=1)
        e = np.exp(em_t[x] - em_t[x].max(axis=2, keepdims=True))
        et = np.exp(tr - tr.max())
        a, b = np.zeros_like(e), np.ones_like(e)
        v = np.exp(st - st.max()) * e[:, 0]
        a[:, 0] = v / v.sum(1, keepdims=True)
        for t in range(1, SEQ):
            v = (a[:, t - 1] @ et) * e[:, t]
            a[:, t] = v / v.sum(1, keepdims=True)
        for t in range(SEQ - 2, -1, -1):
            v = (b[:, t + 1] * e[:, t + 1]) @ et.T
            b[:, t] = v / v.sum(1, keepdims=True)
        post = a * b
        post /= post.sum(2, keepdims=True)
        pair = np.zeros((k, k))
        for t in range(SEQ - 1):
            p = a[:, t][:, :, None] * et[None] * (b[:, t + 1] * e[:, t + 1])[:, None, :]
            pair += (p / p.sum(axis=(1, 2), keepdims=True)).sum(0)
        diff = gold - post
        by_type = np.stack([np.bincount(x.ravel(), weights=diff[:, :, c].ravel(), minlength=len(types))
                            for c in range(k)], axis=1)
        grads = [np.stack([np.bincount(flat, weights=by_type[owner, c], minlength=len(index)) for c in range(k)],
                          axis=1) / n - l2 * w,
                 (gold_tr - pair) / n, (gold[:, 0] - post[:, 0]).sum(0) / n]
        for p, g, h in zip((w, tr, st), grads, hist, strict=True):
            h += g * g
            p += 0.5 * g / np.sqrt(h)
    return Model(labels, index, w, tr, st)


def training_rows(docs: DataFrame, per_lang: int = DOCS_PER_LANG) -> list[tuple[str, str]]:
    """A bounded sample: about ``per_lang`` documents of each language, picked by a hash of doc_id.

    Only rows with a text, a lang and a doc_id whose crc32 modulo 3 is not 1 take part.
    """
    able = docs.where("text is not null and lang is not null and crc32(cast(doc_id as string)) % 3 <> 1"
                      f" and length(text) <= {MAX_CHARS}")
    counts = {r[0]: r[1] for r in able.groupBy("lang").count().collect()}
    if not counts:
        return []
    # the share of the hash range that holds per_lang documents on average
    share = F.create_map(*[x for k, c in counts.items() for x in (F.lit(k), F.lit(min(1.0, per_lang / c)))])
    rank = F.xxhash64("doc_id", "text")
    unit = F.shiftrightunsigned(rank, 11).cast("double") / float(1 << 53)
    got = (able.where(unit < F.try_element_at(share, F.col("lang"))).select("text", "lang", rank.alias("r"))
           .orderBy("lang", "r", "text").limit(2 * per_lang * len(counts)).collect())
    return [(r["text"], r["lang"]) for r in got]


def fit(docs: DataFrame) -> Model | None:
    return train(training_rows(docs))


def split_words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """Words of each text, the number of each word among the distinct ones, the distinct words."""
    lists = pc.utf8_split_whitespace(pc.fill_null(texts, ""))
    flat = pc.list_flatten(lists)
    real = pc.greater(pc.binary_length(flat), 0)
    ends = np.cumsum(pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64))
    count = np.concatenate([[0], np.cumsum(real.to_numpy(zero_copy_only=False))])[np.concatenate([[0], ends])]
    coded = flat.filter(real).dictionary_encode()
    return np.diff(count), coded.indices.to_numpy(zero_copy_only=False), coded.dictionary


class Labeller:
    """Labels texts; keeps the emissions of words it has met, within bounds."""

    def __init__(self, model: Model):
        self.model = model
        self.clear()

    def clear(self):
        self.rows: dict[str, int] = {}
        self.letters = 0
        self.em = np.zeros((CACHE_WORDS, len(self.model.labels)))
        self.has = np.zeros(CACHE_WORDS, dtype=bool)

    def emitted(self, words: pa.Array):
        """Emissions of distinct words, and whether they have letters."""
        if len(words) > CACHE_WORDS or (pc.sum(pc.binary_length(words)).as_py() or 0) > CACHE_LETTERS:
            plain = [[letters(w) for w in words.slice(a, SLICE).to_pylist()] for a in range(0, len(words), SLICE)]
            return (np.concatenate([self.model.emissions(p) for p in plain]),
                    np.concatenate([np.fromiter(map(bool, p), dtype=bool, count=len(p)) for p in plain]))
        names, rows = words.to_pylist(), self.rows
        if len(rows) + len(names) > CACHE_WORDS or self.letters > CACHE_LETTERS:
            self.clear()
            rows = self.rows
        new = [w for w in names if w not in rows]
        if new:
            plain, a, b = [letters(w) for w in new], len(rows), len(rows) + len(new)
            rows.update(zip(new, range(a, b), strict=True))
            self.em[a:b] = self.model.emissions(plain)
            self.has[a:b] = np.fromiter(map(bool, plain), dtype=bool, count=len(plain))
            self.letters += sum(map(len, new))
        at = np.fromiter(map(rows.__getitem__, names), dtype=np.int64, count=len(names))
        return self.em[at], self.has[at]

    def slices(self, texts: pa.Array):
        """(words of each text, marginals, whether a word has letters) of parts of the texts, in order.

        Texts go together, but a single one of more than SLICE words goes in slices: the product of each slice's
        transfer matrices carries the exact forward and backward state across the others.
        """
        model = self.model
        lens, at, words = split_words(texts)
        em, has = self.emitted(words)
        if len(lens) != 1 or lens[0] <= SLICE:
            yield lens, marginals(em[at], lens, model.trans, model.start), has[at]
            return
        parts = [slice(a, a + SLICE) for a in range(0, len(at), SLICE)]
        moves = [transfer(em[at[p]], model.trans) for p in parts]
        afters = [np.ones(len(model.labels))]
        for m in reversed(moves[1:]):
            v = m @ afters[-1]
            afters.append(v / v.sum())
        before = before_first(model.trans, model.start)
        for p, m, after in zip(parts, moves, reversed(afters), strict=True):
            here = at[p]
            yield np.array([len(here)]), marginals(em[here], [len(here)], model.trans, model.start, before, after), has[here]
            before = before @ m
            before = before / np.abs(before).sum()

    def label(self, texts: pa.Array):
        """Likeliest language, its share of the votes and label changes of each text."""
        n, k = len(texts), len(self.model.labels)
        votes, known, switches, last = np.zeros((n, k)), np.zeros(n, dtype=bool), np.zeros(n, dtype=np.int64), None
        for lens, post, has in self.slices(texts):
            doc = np.repeat(np.arange(n), lens)[has]
            for c in range(k):
                votes[:, c] += np.bincount(doc, weights=post[has, c], minlength=n)
            known |= np.bincount(doc, minlength=n) > 0
            # changes of the likeliest label between neighbouring words with letters, in one text
            tag = post.argmax(axis=1)[has]
            if last is not None:
                tag, doc = np.concatenate([last, tag]), np.concatenate([[0] * len(last), doc]).astype(np.int64)
            switches += np.bincount(doc[1:][(tag[1:] != tag[:-1]) & (doc[1:] == doc[:-1])], minlength=n)
            last = tag[-1:]
        best, total = votes.argmax(axis=1), votes.sum(axis=1)
        names = [self.model.labels[b] if k else "und" for b, k in zip(best, known, strict=True)]
        score = np.where(known, np.clip(votes[np.arange(n), best] / np.maximum(total, 1e-300), 0, 1), 0.0)
        return names, score, switches

    def spans(self, text: str) -> list[tuple[str, int, int]]:
        """Runs of words of one language: (language, first word, words). Words without letters go with the run."""
        out: list[list] = []
        i = 0
        for _, post, has in self.slices(pa.array([text])):
            for y, h in zip(post.argmax(axis=1), has, strict=True):
                if h and (not out or out[-1][0] != self.model.labels[y]):
                    out.append([self.model.labels[y], i, 0])
                i += 1
                if out:
                    out[-1][2] = i - out[-1][1]
        return [tuple(x) for x in out]


def label_documents(docs: DataFrame, model: Model | None, text: str = "text") -> DataFrame:
    """``docs`` with lang_pred, score (share of the votes) and n_switches (label changes between words)."""
    base = without(docs, *OUT)
    schema = T.StructType([*base.schema.fields, *[T.StructField(k, v) for k, v in OUT.items()]])
    if model is None:
        return base.select("*", F.lit("und").alias("lang_pred"), F.lit(0.0).alias("score"), F.lit(0).alias("n_switches"))
    shared = docs.sparkSession.sparkContext.broadcast(model)  # as large as the bounded sample makes it

    def run(batches):
        lab = Labeller(shared.value)
        for b in text_batches(batches, STEP_BYTES):
            names, score, switches = lab.label(b.column(b.schema.names.index(text)))
            yield pa.RecordBatch.from_arrays(
                [*b.columns, pa.array(names, pa.string()), pa.array(score, pa.float64()),
                 pa.array(switches.astype(np.int32), pa.int32())], names=[*b.schema.names, *OUT])

    return base.mapInArrow(run, schema)


def query(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = fit(docs)
    out = label_documents(docs.select("doc_id", "text"), model)
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 3 == 1, F.lit(False))
    return out.select("doc_id", held.alias("held_out"), "lang_pred", "score", "n_switches")


def stage(spark, docs: DataFrame, sf_dir: str, min_score: float = 0.4) -> DataFrame:
    """Pipeline stage: documents without a language (``und``), or whose words no language has 0.4 of, go."""
    out = label_documents(docs, fit(docs))
    return out.where((F.col("lang_pred") != "und") & (F.col("score") >= min_score)).select(*docs.columns)


