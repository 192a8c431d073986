"""Language-model scoring: an interpolated modified Kneser-Ney model of order 2 or 3, counted in Spark.

Counting is distributed: tasks combine the counts of their documents and send them, as compressed
sorted arrays, to ranges of the key space; one range is merged by one task and holds a bounded
expected number of tokens, however many the corpus has. Ranges follow the counts, so a word or
pair that makes up a third of the corpus takes its own range and is split by the next word.

The model lies in a folder that all workers mount, as sorted arrays that they map into memory:

- ``words``: 64-bit hashes of the distinct words; a word's number is its place. Beside it, by number:
  counts, sums of counts, back-off weights and continuation probabilities;
- ``pairs-*``: numbers of distinct pairs (context * words + word) with their counts, by range;
- at order 3 also ``triples-*``: (number of the pair * words + word), a pair's number being its place in
  all ranges, and beside the pairs their back-off weights and continuation counts. A triple lies in
  the range of its pair, those of a pair with more tokens than a range are spread by their words.

Lookups are binary searches of sorted distinct keys, so pages are visited in order. Every file is
written under a name of the task's own and then renamed, or at a place that only one task fills,
so a repeated task does no harm.

Words are those of lower-cased (A-Z) text split at ASCII white space, then one end. Score: the
log10 probability of words and end. Counts are those of the corpus at the highest order and for
pairs that begin a text, else numbers of distinct words before. The lowest order interpolates with
a uniform one over the words and one unknown word; an unknown context backs off wholly.

Defined results: null text is the empty text (one end); without training documents every score is
0; rows without doc_id are scored but not learned from; repeated rows count as often as they occur;
an empty table gives no rows; extra columns are not read.
"""

from __future__ import annotations

import os
import zlib
from dataclasses import dataclass
from urllib.parse import urlparse

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfspark.llm.common import text_batches, texts_of
from shelfspark.session import scratch_path

#: Tokens of a range that one task merges; distinct keys that a task holds before it sends them.
RANGE, FLUSH = 3_000_000, 2_000_000
#: Order of the query's model.
ORDER = 2
#: Files that a task holds mapped at a time.
MAPS = 4_000
_BLOB = "range int, n long, keys binary, counts binary"
START = np.uint64(xxhash.xxh64_intdigest(b" "))
END = xxhash.xxh64_intdigest(b"\n")


def pack(a: np.ndarray) -> bytes:
    """A sorted array of unsigned 64-bit numbers: differences, byte by byte, compressed."""
    d = np.diff(a, prepend=np.zeros(1, dtype=a.dtype)).astype("<u8")
    return zlib.compress(np.ascontiguousarray(d.view(np.uint8).reshape(-1, 8).T).tobytes(), 1)


def unpack(b: bytes, n: int) -> np.ndarray:
    d = np.frombuffer(zlib.decompress(b), dtype=np.uint8).reshape(8, n).T
    return np.cumsum(np.ascontiguousarray(d).view("<u8").ravel(), dtype=np.uint64)


def pack_counts(c: np.ndarray) -> bytes:
    return zlib.compress(np.ascontiguousarray(c.astype("<u8").view(np.uint8).reshape(-1, 8).T).tobytes(), 1)


def unpack_counts(b: bytes, n: int) -> np.ndarray:
    d = np.frombuffer(zlib.decompress(b), dtype=np.uint8).reshape(8, n).T
    return np.ascontiguousarray(d).view("<u8").ravel().astype(np.int64)


def summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct sorted keys with their summed counts."""
    if not len(keys):
        return keys, counts
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
    return keys[first], np.add.reduceat(counts, first)


def token_hashes(texts: list[str], cache: dict) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all tokens (words and one end for each text) and the number of tokens of each text."""
    if len(cache) > 400_000:
        cache.clear()
    words = [t.encode("utf-8", "replace").lower().split() for t in texts]
    new = set().union(*words).difference(cache) if words else ()
    digest = xxhash.xxh64_intdigest
    cache.update((w, digest(w)) for w in new)
    lens = np.fromiter((len(w) + 1 for w in words), dtype=np.int64, count=len(words))
    flat: list[int] = []
    get = cache.__getitem__
    for w in words:
        flat.extend(map(get, w))
        flat.append(END)
    return np.asarray(flat, dtype=np.uint64), lens


class Sender:
    """Sums the counts of a task's keys and gives them out by range when there are many."""

    def __init__(self, range_of, ranges: int):
        self.range_of, self.ranges = range_of, ranges
        self.keys, self.counts, self.held = [], [], 0

    def add(self, keys: np.ndarray, counts: np.ndarray):
        self.keys.append(keys)
        self.counts.append(counts)
        self.held += len(keys)
        if self.held > FLUSH:
            k, c = summed(np.concatenate(self.keys), np.concatenate(self.counts))
            if len(k) > FLUSH // 2:
                yield from self._send(k, c)
                k, c = k[:0], c[:0]
            self.keys, self.counts, self.held = [k], [c], len(k)

    def close(self):
        if self.held:
            yield from self._send(*summed(np.concatenate(self.keys), np.concatenate(self.counts)))

    def _send(self, k, c):
        at = self.range_of(k)
        for r in np.unique(at):
            m = at == r
            yield pa.RecordBatch.from_arrays(
                [pa.array([int(r)], pa.int32()), pa.array([int(m.sum())], pa.int64()), pa.array([pack(k[m])], pa.binary()),
                 pa.array([pack_counts(c[m])], pa.binary())], names=["range", "n", "keys", "counts"])


def merged(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """The summed counts of all that was sent to one range."""
    ks, cs = [], []
    for n, k, c in zip(*(table.column(x).to_pylist() for x in ("n", "keys", "counts")), strict=True):
        ks.append(unpack(k, n))
        cs.append(unpack_counts(c, n))
    return summed(np.concatenate(ks), np.concatenate(cs))


def save(path: str, a: np.ndarray) -> None:
    """Write an array under a name of this task, then rename it."""
    part = f"{path}.{os.getpid()}-{os.urandom(4).hex()}"
    a.tofile(part)
    os.replace(part, path)


def save_counts(path: str, c: np.ndarray) -> None:
    """Write counts in as few bytes each as the greatest needs."""
    top = int(c.max()) if len(c) else 0
    save(path, c.astype(next(f"<u{b}" for b in (1, 2, 4, 8) if top < 1 << 8 * b)))


def fill(path: str, at: int, a: np.ndarray) -> None:
    """Write an array into its place in a file that exists."""
    with open(path, "r+b") as f:
        f.seek(at * a.itemsize)
        f.write(a.tobytes())


def mapped(path: str, dtype) -> np.ndarray:
    return np.memmap(path, dtype=dtype, mode="r") if os.path.getsize(path) else np.zeros(0, dtype=dtype)


def model_folder(spark: SparkSession) -> str:
    """A new folder below spark.checkpoint.dir, which must be one that all workers mount to be mapped."""
    at = urlparse(scratch_path(spark, "kneser-ney"))
    if at.scheme not in ("", "file"):
        raise ValueError("memory-mapping needs a model folder on a mounted file system; give one as folder=")
    os.makedirs(at.path)
    return at.path


@dataclass
class Model:
    """What is small: sizes, discounts, and where the arrays lie."""
    folder: str
    n: int = 0            # training tokens
    v: int = 0            # distinct ones
    size: int = 0         # entries of the word arrays: v and the start
    ranges: int = 1
    step: int = RANGE     # tokens of a range
    order: int = 2
    discounts: tuple = (0.0, 0.0, 0.0)
    discounts3: tuple = (0.0, 0.0, 0.0)
    unknown: float = 1.0  # probability of an unknown word at the lowest order

    def path(self, name: str) -> str:
        return os.path.join(self.folder, name)


class Arrays:
    """A worker's view of the model."""

    def __init__(self, m: Model):
        self.m = m
        self.words = mapped(m.path("words"), "<u8")
        self.counts = mapped(m.path("counts"), "<i8")
        self.sums = mapped(m.path("sums"), "<i8")
        self.mass = float(m.n + (self.counts[self.number(np.asarray([START]))[0]] if m.size else 0)) or 1.0
        self.open: dict[str, np.ndarray] = {}
        self.offsets = mapped(m.path("pair-offsets"), "<i8") if os.path.exists(m.path("pair-offsets")) else None

    def number(self, hashes: np.ndarray) -> np.ndarray:
        """Numbers of words by hash; -1: unknown."""
        at = np.searchsorted(self.words, hashes)
        at[at == len(self.words)] = 0
        return np.where(self.words[at] == hashes, at, -1) if len(self.words) else np.full(len(hashes), -1)

    def range_of(self, keys: np.ndarray) -> np.ndarray:
        """Ranges of pairs: their place in the sorted pairs, expected from the words' counts."""
        u, w = np.divmod(keys, np.uint64(max(1, self.m.size)))
        u, w = u.astype(np.int64), w.astype(np.int64)
        place = (self.sums[u] + self.counts[u] * (self.sums[w] / self.mass)) / self.mass
        return np.minimum((place * self.m.ranges).astype(np.int64), self.m.ranges - 1)

    def file(self, name: str, dtype: str = "<u8", entries: int | None = None) -> np.ndarray:
        """A mapped array, the oldest going when there are many; of counts, their number tells their width."""
        if name not in self.open:
            if len(self.open) >= MAPS:
                self.open.pop(next(iter(self.open)))
            p = self.m.path(name)
            if entries:      # counts
                dtype = f"<u{os.path.getsize(p) // entries}"
            self.open[name] = mapped(p, dtype) if os.path.exists(p) else np.zeros(0, dtype=dtype)
        return self.open[name]

    def find(self, kind: str, at: np.ndarray, keys: np.ndarray) -> np.ndarray:
        """Places of sorted distinct keys in their ranges' files; -1: never seen."""
        out = np.full(len(keys), -1, dtype=np.int64)
        for r in np.unique(at):
            k = self.file(f"{kind}-{r}")
            if len(k):
                mine = np.flatnonzero(at == r)
                i = np.searchsorted(k, keys[mine])
                i[i == len(k)] = 0
                out[mine] = np.where(k[i] == keys[mine], i, -1)
        return out

    def values(self, kind: str, name: str, at: np.ndarray, i: np.ndarray, dtype: str | None = None) -> np.ndarray:
        """What lies beside the keys at some places; 0 at place -1."""
        out = np.zeros(len(i), dtype=dtype or "<i8")
        for r in np.unique(at[i >= 0]):
            mine = np.flatnonzero((at == r) & (i >= 0))
            f = f"{kind}-{r}-{name}" if name else f"{kind}-{r}"
            out[mine] = (self.file(f, dtype) if dtype else self.file(f, entries=len(self.file(f"{kind}-{r}"))))[i[mine]]
        return out

    def pairs(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Range and place of sorted distinct pairs."""
        at = self.range_of(keys)
        return at, self.find("pairs", at, keys)

    def numbered(self, number: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Range and place of pairs by number."""
        at = np.searchsorted(self.offsets, number, side="right") - 1
        return at, number - self.offsets[at]

    def triple_range(self, keys: np.ndarray) -> np.ndarray:
        pair, w = np.divmod(keys, np.uint64(self.m.size))
        number, inv = np.unique(pair.astype(np.int64), return_inverse=True)
        at, i = self.numbered(number)
        count = self.values("pairs", "counts", at, i)[inv]
        more = (count * (self.sums[w.astype(np.int64)] / self.mass) / self.m.step).astype(np.int64)
        return np.minimum(at[inv] + more, self.m.ranges - 1)


def discounts(n: list[int]) -> tuple[float, float, float]:
    """Modified Kneser-Ney discounts from the numbers of keys counted once to four times."""
    if min(n) <= 0:
        return 0.75, 0.75, 0.75
    y = n[0] / (n[0] + 2 * n[1])
    d = [1 - 2 * y * n[1] / n[0], 2 - 3 * y * n[2] / n[1], 3 - 4 * y * n[3] / n[2]]
    return tuple(min(max(x, 0.0), k + 1.0) for k, x in enumerate(d))


def _pairs(tok: np.ndarray, lens: np.ndarray, arrays: Arrays) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of each token's context and of the token."""
    uniq, inv = np.unique(tok, return_inverse=True)
    w = arrays.number(uniq)[inv]
    u = np.concatenate(([0], w[:-1]))
    u[np.cumsum(lens) - lens] = arrays.number(np.asarray([START]))[0]
    return u, w


def _triples(u: np.ndarray, w: np.ndarray, lens: np.ndarray, arrays: Arrays) -> tuple[np.ndarray, ...]:
    """Of all tokens: range and place of the pair that ends there (-1: never seen), and the number of the
    pair before (-1: none, or never seen)."""
    both = (u >= 0) & (w >= 0)
    key, inv = np.unique(u[both].astype(np.uint64) * np.uint64(arrays.m.size) + w[both].astype(np.uint64), return_inverse=True)
    r, i = arrays.pairs(key)
    at, place, number = np.zeros(len(u), dtype=np.int64), np.full(len(u), -1), np.full(len(u), -1)
    at[both], place[both] = r[inv], i[inv]
    if arrays.offsets is None:
        return at, place, number
    number[both] = np.where(i >= 0, arrays.offsets[r] + i, -1)[inv]
    before = np.concatenate(([-1], number[:-1]))
    before[np.cumsum(lens) - lens] = -1
    return at, place, before


def _table(rows: list[tuple]) -> pa.Table:
    """Rows (kind, range, keys, counts) as sent."""
    return pa.table({"kind": pa.array([x[0] for x in rows], pa.string()), "range": pa.array([x[1] for x in rows], pa.int32()),
                     "n": pa.array([len(x[2]) for x in rows], pa.int64()),
                     "keys": pa.array([pack(x[2]) for x in rows], pa.binary()),
                     "counts": pa.array([pack_counts(x[3]) for x in rows], pa.binary())})


def _dense(table: pa.Table, kinds, first: int, last: int) -> dict[str, np.ndarray]:
    """Sums of each kind as arrays over the numbers from first to last."""
    out = {}
    for kind in kinds:
        out[kind] = np.zeros(last - first, dtype=np.int64)
        part = table.filter(pa.compute.equal(table.column("kind"), kind))
        if part.num_rows:
            k, c = merged(part)
            out[kind][k.astype(np.int64) - first] = c
    return out


def fit(docs: DataFrame, folder: str | None = None, order: int = 2) -> Model:
    """Count and store a model of the texts of ``docs``."""
    if order not in (2, 3):
        raise ValueError("order must be 2 or 3")
    spark = docs.sparkSession
    m = Model(folder or model_folder(spark), order=order, step=RANGE)
    texts = docs.select("text")
    tasks = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))

    def send_words(batches):
        s, cache = Sender(lambda k: (k >> np.uint64(44)).astype(np.int64) * tasks >> 20, tasks), {}
        for b in text_batches(batches):
            tok, lens = token_hashes(texts_of(b), cache)
            k, c = np.unique(tok, return_counts=True)
            yield from s.add(np.append(k, START), np.append(c, len(lens)))
        yield from s.close()

    def keep_words(table: pa.Table) -> pa.Table:
        k, c = merged(table)
        r = table.column("range")[0].as_py()
        save(m.path(f"words-{r}"), k)
        save(m.path(f"words-{r}-counts"), c)
        return pa.table({"range": pa.array([r], pa.int32()), "n": pa.array([len(k)], pa.int64()),
                         "total": pa.array([int(c.sum())], pa.int64())})

    parts = sorted(texts.mapInArrow(send_words, _BLOB).groupBy("range")
                   .applyInArrow(keep_words, "range int, n long, total long").collect())   # one row of each range
    m.size = sum(p["n"] for p in parts)
    for name in ("words", "counts", "sums", "weights", "contexts", "continuation"):
        with open(m.path(name), "wb") as f:
            f.truncate(8 * m.size)
    if not m.size:
        return m
    at, before, places = 0, 0, []
    for p in parts:
        places.append((p["range"], at, before))
        at, before = at + p["n"], before + p["total"]

    def place_words(batches):
        for b in batches:
            for r, first, total in zip(*(c.to_pylist() for c in b.columns), strict=True):
                k, c = mapped(m.path(f"words-{r}"), "<u8"), mapped(m.path(f"words-{r}-counts"), "<i8")
                fill(m.path("words"), first, k)
                fill(m.path("counts"), first, c)
                fill(m.path("sums"), first, total + np.cumsum(c) - c)
                yield pa.RecordBatch.from_arrays([pa.array([r], pa.int32())], names=["range"])

    spark.createDataFrame(places, "range int, first long, total long").repartition(len(places)).mapInArrow(
        place_words, "range int").collect()
    starts = int(Arrays(m).counts[Arrays(m).number(np.asarray([START]))[0]])
    m.n, m.v = before - starts, m.size - 1
    m.ranges = max(1, -(-m.n // m.step))

    def send_pairs(batches):
        arrays, cache = Arrays(m), {}
        s = Sender(arrays.range_of, m.ranges)
        for b in text_batches(batches):
            tok, lens = token_hashes(texts_of(b), cache)
            u, w = _pairs(tok, lens, arrays)
            k, c = np.unique(u.astype(np.uint64) * np.uint64(m.size) + w.astype(np.uint64), return_counts=True)
            yield from s.add(k, c)
        yield from s.close()

    # pairs by range: stored; what words and contexts need of them goes on, by range of words
    words_of = lambda w: w.astype(np.int64) * m.ranges // m.size

    def seen(c):
        return "seen", -1, np.arange(1, 5, dtype=np.uint64), np.asarray([(c == i).sum() for i in range(1, 5)])

    def pair_rows(k, c):
        """What words and contexts need of sorted pairs and their counts."""
        u, w = np.divmod(k, np.uint64(m.size))
        rows = [seen(c)]
        for kind, by, where in [("word", w, None)] + [(f"n{i}", u, (c == i) if i < 3 else (c >= 3)) for i in (1, 2, 3)]:
            key, n = np.unique(by if where is None else by[where], return_counts=True)
            to = words_of(key)
            rows += [(kind, int(q), key[to == q], n[to == q]) for q in np.unique(to)]
        if order > 2:
            key, n = summed(u, c)
            to = words_of(key)
            rows += [("total", int(q), key[to == q], n[to == q]) for q in np.unique(to)]
        return _table(rows)

    def keep_pairs(table: pa.Table) -> pa.Table:
        k, c = merged(table)
        r = table.column("range")[0].as_py()
        save(m.path(f"pairs-{r}"), k.astype("<u8"))
        save_counts(m.path(f"pairs-{r}-counts"), c)
        return pair_rows(k, c) if order == 2 else _table([("size", r, np.asarray([len(k)], dtype=np.uint64), np.ones(1, np.int64))])

    blob = f"kind string, {_BLOB}"

    def stored(df, name):
        at = scratch_path(spark, name)
        df.write.parquet(at)
        return spark.read.parquet(at)

    def discounts_of(kept):
        total = np.zeros(4, dtype=np.int64)
        for r in kept.where("kind = 'seen'").select("counts").toLocalIterator():
            total += unpack_counts(r["counts"], 4)
        return discounts(total.tolist())

    kept = stored(texts.mapInArrow(send_pairs, _BLOB).groupBy("range").applyInArrow(keep_pairs, blob), "kneser-ney-words")
    if order > 2:
        sizes = np.zeros(m.ranges, dtype=np.int64)
        for r in kept.select("range", "keys").toLocalIterator():       # one number of each range
            sizes[r["range"]] = unpack(r["keys"], 1)[0]
        offsets = np.concatenate(([0], np.cumsum(sizes)))
        if int(offsets[-1]) * m.size >= 1 << 64:
            raise ValueError("triples beyond 64 bits: use order 2")
        save(m.path("pair-offsets"), offsets.astype("<i8"))

        def send_triples(batches):
            arrays, cache = Arrays(m), {}
            s = Sender(arrays.triple_range, m.ranges)
            for b in text_batches(batches):
                tok, lens = token_hashes(texts_of(b), cache)
                u, w = _pairs(tok, lens, arrays)
                before = _triples(u, w, lens, arrays)[2]
                in_ = before >= 0
                yield from s.add(*np.unique(before[in_].astype(np.uint64) * np.uint64(m.size) + w[in_].astype(np.uint64),
                                            return_counts=True))
            yield from s.close()

        def keep_triples(table: pa.Table) -> pa.Table:
            k, c = merged(table)
            r = table.column("range")[0].as_py()
            save(m.path(f"triples-{r}"), k.astype("<u8"))
            save_counts(m.path(f"triples-{r}-counts"), c)
            arrays = Arrays(m)
            before, w = np.divmod(k, np.uint64(m.size))
            number, inv = np.unique(before.astype(np.int64), return_inverse=True)
            at, i = arrays.numbered(number)
            v = arrays.values("pairs", "", at, i, "<u8") % np.uint64(m.size)
            key, left = np.unique(v[inv] * np.uint64(m.size) + w, return_counts=True)
            to, i = arrays.pairs(key)
            rows = [seen(c)] + [("left", int(q), (arrays.offsets[q] + i[to == q]).astype(np.uint64), left[to == q]) for q in np.unique(to)]
            for kind, where in (("n1", c == 1), ("n2", c == 2), ("n3", c >= 3)):
                key, n = np.unique(before[where], return_counts=True)
                to = arrays.numbered(key.astype(np.int64))[0]
                rows += [(kind, int(q), key[to == q], n[to == q]) for q in np.unique(to)]
            return _table(rows)

        triples = stored(texts.mapInArrow(send_triples, _BLOB).groupBy("range").applyInArrow(keep_triples, blob),
                         "kneser-ney-triples")
        m.discounts3 = discounts_of(triples)

        def keep_lower(table: pa.Table) -> pa.Table:
            """Back-off weights and continuation counts of a range of pairs."""
            r = table.column("range")[0].as_py()
            arrays = Arrays(m)
            k, first, last = arrays.file(f"pairs-{r}"), int(arrays.offsets[r]), int(arrays.offsets[r + 1])
            count = arrays.file(f"pairs-{r}-counts", entries=len(k)).astype(np.int64)
            sums = _dense(table, ("left", "n1", "n2", "n3"), first, last)
            start = arrays.number(np.asarray([START]))[0]
            c = np.where(k // np.uint64(m.size) == np.uint64(start), count, sums["left"])
            save(m.path(f"pairs-{r}-weights"), sum(d * sums[f"n{i + 1}"] for i, d in enumerate(m.discounts3)) / count)
            save_counts(m.path(f"pairs-{r}-lower"), c)
            return pair_rows(np.asarray(k), c)

        every = kept.where("kind = 'size'").select(F.lit("none").alias("kind"), "range", "n", "keys", "counts")
        kept = stored(triples.where("kind <> 'seen'").unionByName(every).groupBy("range").applyInArrow(keep_lower, blob),
                      "kneser-ney-lower")
    m.discounts = discounts_of(kept)

    def keep_contexts(table: pa.Table) -> pa.Table:
        """Back-off weights of a range of contexts, continuation counts of a range of words."""
        q = table.column("range")[0].as_py()
        first, last = (-(-x * m.size // m.ranges) for x in (q, q + 1))
        sums = _dense(table, ("word", "n1", "n2", "n3", "total"), first, last)
        total = mapped(m.path("counts"), "<i8")[first:last] if order == 2 else sums["total"]
        back = sum(d * sums[f"n{i + 1}"] for i, d in enumerate(m.discounts))
        followed = sums["n1"] + sums["n2"] + sums["n3"] > 0
        fill(m.path("weights"), first, np.where(followed, back / np.maximum(total, 1), 1.0))
        fill(m.path("contexts"), first, total.astype(np.int64))
        fill(m.path("continuation"), first, sums["word"].astype(np.float64))
        w = sums["word"]
        return pa.table({"pairs": pa.array([int(w.sum())], pa.int64()),
                         **{f"c{i}": pa.array([int((w == i).sum())], pa.int64()) for i in range(1, 5)},
                         "more": pa.array([int((w >= 3).sum())], pa.int64())})

    kinds = kept.where("kind <> 'seen'").groupBy("range").applyInArrow(
        keep_contexts, "pairs long, c1 long, c2 long, c3 long, c4 long, more long")
    got = kinds.agg(*[F.sum(c).alias(c) for c in kinds.columns]).head()
    low = discounts([got["c1"], got["c2"], got["c3"], got["c4"]])
    m.unknown = (low[0] * got["c1"] + low[1] * got["c2"] + low[2] * got["more"]) / got["pairs"] / (m.v + 1)

    def finish(batches):
        """Continuation probabilities in place of the counts; written aside, so that a repeated task reads counts."""
        for b in batches:
            for q in b.column(0).to_pylist():
                first, last = (-(-x * m.size // m.ranges) for x in (q, q + 1))
                c = np.array(mapped(m.path("continuation"), "<f8")[first:last])
                d = np.select([c == 0, c == 1, c == 2], [0.0, low[0], low[1]], low[2])
                fill(m.path("lowest"), first, (c - d) / got["pairs"] + m.unknown)
                yield pa.RecordBatch.from_arrays([pa.array([q], pa.int32())], names=["range"])

    with open(m.path("lowest"), "wb") as f:
        f.truncate(8 * m.size)
    spark.range(m.ranges).select(F.col("id").cast("int").alias("range")).repartition(
        min(m.ranges, 4 * tasks)).mapInArrow(finish, "range int").collect()
    return m


def _cut(n: np.ndarray, d: tuple) -> np.ndarray:
    """Counts less their discounts."""
    return n - np.select([n == 0, n == 1, n == 2], [0.0, *d[:2]], d[2])


def score_documents(docs: DataFrame, m: Model) -> DataFrame:
    """(doc_id, n_tokens, n_known, train_tokens, base_score, score) of every row."""
    base = docs.select("doc_id", "text")
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches):
        arrays, cache = Arrays(m), {}
        weights, lowest = ((mapped(m.path(x), "<f8") for x in ("weights", "lowest")) if m.size else (None, None))
        contexts = mapped(m.path("contexts"), "<i8") if m.size else None
        floor = m.n + 0.1 * (m.v + 1)
        for b in text_batches(batches):
            tok, lens = token_hashes(texts_of(b), cache)
            starts = np.cumsum(lens) - lens
            if not m.size:
                known, base_, full = np.zeros(len(tok)), np.full(len(tok), np.log10(0.1 / floor)), np.zeros(len(tok))
            else:
                u, w = _pairs(tok, lens, arrays)
                c = np.where(w >= 0, arrays.counts[np.maximum(w, 0)], 0)
                known, base_ = c > 0, np.log10((c + 0.1) / floor)
                low = np.where(w >= 0, lowest[np.maximum(w, 0)], m.unknown)
                ctx = np.where(u >= 0, weights[np.maximum(u, 0)], 1.0)
                at, place, before = _triples(u, w, lens, arrays)
                n = arrays.values("pairs", "counts" if m.order == 2 else "lower", at, place)
                full = _cut(n, m.discounts) / np.maximum(contexts[np.maximum(u, 0)], 1) + ctx * low
                if m.order > 2:
                    got = np.flatnonzero(before >= 0)
                    number, pair = np.unique(before[got], return_inverse=True)
                    at, place = arrays.numbered(number)
                    total, back = arrays.values("pairs", "counts", at, place), arrays.values("pairs", "weights", at, place, "<f8")
                    key, inv = np.unique(before[got].astype(np.uint64) * np.uint64(m.size) + np.maximum(w[got], 0).astype(np.uint64),
                                         return_inverse=True)
                    to = arrays.triple_range(key)
                    n = np.where(w[got] >= 0, arrays.values("triples", "counts", to, arrays.find("triples", to, key))[inv], 0)
                    full[got] = _cut(n, m.discounts3) / total[pair] + back[pair] * full[got]
                full = np.log10(full)
            sums = [np.add.reduceat(x.astype(np.float64), starts) for x in (known, base_, full)]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(lens, pa.int64()), pa.array(sums[0].astype(np.int64), pa.int64()),
                 pa.array([m.n] * len(lens), pa.int64()), pa.array(sums[1], pa.float64()), pa.array(sums[2], pa.float64())],
                names=["doc_id", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    return base.mapInArrow(run, f"doc_id {kind}, n_tokens long, n_known long, train_tokens long, base_score double, score double")


def query(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    rest = F.crc32(F.col("doc_id").cast("string")) % 10
    out = score_documents(docs, fit(docs.where(rest != 0), order=ORDER))
    return out.select("doc_id", F.coalesce(rest == 0, F.lit(False)).alias("held_out"), "n_tokens", "n_known", "train_tokens",
                      "base_score", "score", F.pow(F.lit(10.0), -F.col("score") / F.col("n_tokens")).alias("perplexity"))
