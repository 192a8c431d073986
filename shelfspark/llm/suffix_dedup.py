"""Removal of long strings that repeat in the corpus, by external induced sorting of suffixes.

Every byte that lies in a string of ``LENGTH`` bytes which also starts anywhere else goes.

1. Anchors: the least hash among the ``GRAM``-byte strings inside a LENGTH-byte string is one of its
   places, and equal strings have equal anchors at equal places. Consecutive starts with one
   anchor are a fragment: their bytes and the LENGTH - 1 behind them. Fragments are counted by
   anchor, with the least and greatest of their hashes (a grouped sum, combined in the tasks).
   Starts of an anchor that occurs once cannot repeat; where all fragments of an anchor are
   equal, all repeat. The anchors that occur more often are stored as one sorted array in a folder
   that all workers mount, and mapped into memory.
2. The remaining anchors have unlike fragments. Those go, equal ones of a task once, to shards by the
   anchor's hash, so that equal strings meet; there are as many shards as hold about
   ``SHARD_BYTES`` each. A shard's suffixes are sorted by induction with common prefixes
   (``induced_sort``); a suffix repeats if it shares LENGTH bytes with a neighbour.
   A hot anchor, whose fragments alone would fill a shard (say one sentence of a third of all
   documents between unlike neighbours), is split: its starts go one by one, as hashes of their
   LENGTH bytes combined in the tasks, and are counted in the shards that those hashes fall in.
3. The bits of repeated starts are stored by fragment, and a last pass over the documents removes
   what they cover. What the shards write is put together into one file of each kind, so a task maps as
   many files at any size, and looks up all of a batch at once.

Texts are read three times and never shuffled; fragment and start hashes have 64 bits. Texts are
walked in windows of ``WINDOW`` bytes, so that a long text takes some tens of bytes of memory for each
of its own; a fragment ends where its window of the text does. Defined results: null
text is the empty text; texts shorter than LENGTH stay as they are; repeated rows repeat each
other and go wholly, if they are long enough; an empty table gives no rows; extra columns are
not read.
"""

from __future__ import annotations

import hashlib
import os
import shutil

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfspark.llm.common import cut, text_batches, texts_of
from shelfspark.llm.induced_sort import repeated_places
from shelfspark.llm.kneser_ney import mapped, model_folder, save

LENGTH, GRAM, SHARD_BYTES, WINDOW = 200, 32, 3 << 20, 1 << 20
_PLACE = np.uint64((1 << 31) - 1)
_BASE = np.uint64(0xD1342543DE82EF95)
_powers: dict[str, np.ndarray] = {}


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def _power(n: int):
    if len(_powers.get("up", ())) < n:
        size = max(n, 1 << 20)
        _powers["up"] = np.cumprod(np.full(size, _BASE))
        _powers["down"] = np.cumprod(np.full(size, np.uint64(pow(int(_BASE), -1, 1 << 64))))
    return _powers["up"][:n], _powers["down"][:n]


def fragments(data: np.ndarray, sizes: np.ndarray, length: int = LENGTH):
    """Fragments of texts that lie one after another: (first start, starts, anchor hash, fragment hash).

    Long texts are cut at every WINDOW starts of their own, so the result does not depend on the batch."""
    found, begin, group = [], 0, []
    for size in [*sizes.tolist(), None]:
        held = sum(group)
        if group and (size is None or held + size > WINDOW):
            found.append((begin, _fragments(data[begin:begin + held], np.asarray(group), length)))
            begin, group = begin + held, []
        if size is not None and size > WINDOW:
            for i in range(0, size - length + 1, WINDOW):
                n = min(size - i, WINDOW + length - 1)
                found.append((begin + i, _fragments(data[begin + i:begin + i + n], np.asarray([n]), length)))
            begin += size
        elif size is not None:
            group.append(size)
    parts = [(first + at, *rest) for at, (first, *rest) in found] or [_fragments(data, sizes, length)]
    return tuple(np.concatenate(x) for x in zip(*parts, strict=True))


def start_hashes(data: np.ndarray, first: np.ndarray, starts: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """The starts of some fragments, and hashes of the ``length`` bytes behind each."""
    at = np.repeat(first - np.cumsum(starts) + starts, starts) + np.arange(starts.sum())
    out, cuts = np.zeros(len(at), np.uint64), np.searchsorted(at, np.arange(0, len(data) + WINDOW, WINDOW))
    for i, (a, z) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)):
        if a < z:
            part = data[i * WINDOW:(i + 1) * WINDOW + length]
            up, down = _power(len(part))
            sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum((part.astype(np.uint64) + np.uint64(1)) * up)))
            here = at[a:z] - i * WINDOW
            out[a:z] = _mix((sums[here + length] - sums[here]) * down[here])
    return at, out


def _fragments(data: np.ndarray, sizes: np.ndarray, length: int):
    gram, n = min(GRAM, length), len(data)
    none = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64), np.zeros(0, np.uint64), np.zeros(0, np.uint64)
    if n < length or not (sizes >= length).any():
        return none
    up, down = _power(n)
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up)))
    hashes = _mix((sums[gram:] - sums[:-gram]) * down[:n - gram + 1])
    least = (hashes & ~_PLACE) | np.arange(len(hashes), dtype=np.uint64)   # ties: the leftmost
    width, step = length - gram + 1, 1
    while 2 * step <= width:
        least = np.minimum(least[:-step], least[step:])
        step *= 2
    if width > step:
        least = np.minimum(least[:len(least) - (width - step)], least[width - step:])
    place = (least & _PLACE).astype(np.int64)
    inside = np.ones(n - length + 1, dtype=bool)
    ends = np.cumsum(sizes)
    for s, e in zip((ends - sizes).tolist(), ends.tolist(), strict=True):
        inside[max(s, e - length + 1):e] = False
    at = np.flatnonzero(inside)
    place = place[at]
    new = np.flatnonzero(np.concatenate(([True], (place[1:] != place[:-1]) | (at[1:] != at[:-1] + 1))))
    first, starts = at[new], np.diff(new, append=len(at))
    stop = first + starts - 1 + length
    # least hashes crowd at the low end: mixed again, they spread evenly over ranges
    return first, starts, _mix(~hashes[place[new]]), _mix((sums[stop] - sums[first]) * down[first] + starts.astype(np.uint64))


def _batch(b: pa.RecordBatch):
    raw = [t.encode("utf-8", "replace") for t in texts_of(b)]
    sizes = np.fromiter(map(len, raw), dtype=np.int64, count=len(raw))
    return np.frombuffer(b"".join(raw), dtype=np.uint8), sizes


def _range(h: np.ndarray, n: int) -> np.ndarray:
    """One of n ranges of hashes, in their order."""
    return ((h >> np.uint64(40)) * np.uint64(n) >> np.uint64(24)).astype(np.int64)


def _within(keys: np.ndarray, lo: np.ndarray, hi: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Places of some keys, each in its own sorted part keys[lo:hi]: of the first that is not less."""
    while (live := lo < hi).any():
        mid = (lo + hi) // 2
        less = live.copy()
        less[live] = keys[mid[live]] < wanted[live]
        lo, hi = np.where(less, mid + 1, lo), np.where(live & ~less, mid, hi)
    return lo


class Stored:
    """Arrays of one name, by range: written one by one, then joined into one file of each kind, mapped as a whole."""

    def __init__(self, folder: str, name: str, kinds: dict[str, str]):
        self.path, self.kinds = f"{folder}/{name}", kinds

    def write(self, r: int, **arrays: np.ndarray) -> None:
        for k, a in arrays.items():
            save(f"{self.path}-{r}-{k}", a.astype(self.kinds[k]))

    def join(self, written: DataFrame, ranges: int) -> None:
        """Join what tasks wrote, the entries of each kind by ``range`` (a row each), and store where each range begins."""
        rows, path, kinds = written.select("range", *self.kinds).collect(), self.path, self.kinds
        rows.sort()
        begins = {}
        for k, kind in kinds.items():
            sizes = np.zeros(ranges, dtype=np.int64)
            for row in rows:
                sizes[row["range"]] = row[k]
            begins[k] = np.concatenate(([0], np.cumsum(sizes)))
            save(f"{path}-{k}-begin", begins[k])
            with open(f"{path}-{k}", "wb") as f:
                f.truncate(int(begins[k][-1]) * np.dtype(kind).itemsize)

        def copy(batches):
            for b in batches:
                for x in b.to_pylist():
                    for k, kind in kinds.items():
                        with open(f"{path}-{x['range']}-{k}", "rb") as part, open(f"{path}-{k}", "r+b") as whole:
                            whole.seek(x[k] * np.dtype(kind).itemsize)
                            shutil.copyfileobj(part, whole, 1 << 20)
                yield pa.RecordBatch.from_arrays([pa.array([b.num_rows], pa.int64())], names=["n"])

        if rows:
            spark = written.sparkSession
            at = [(row["range"], *[int(begins[k][row["range"]]) for k in kinds]) for row in rows]
            tasks = spark.createDataFrame(at, ", ".join(f"{c} long" for c in ("range", *kinds)))
            tasks.repartition(min(len(at), int(spark.conf.get("spark.sql.shuffle.partitions")))).mapInArrow(copy, "n long").count()
            for row in rows:
                for k in kinds:
                    os.remove(f"{path}-{row['range']}-{k}")

    def arrays(self) -> dict[str, np.ndarray]:
        """Each kind as a whole."""
        return {k: np.asarray(mapped(f"{self.path}-{k}", t)) for k, t in self.kinds.items()}

    def begins(self, kind: str) -> np.ndarray:
        """Where each range begins, and the end."""
        return np.asarray(mapped(f"{self.path}-{kind}-begin", "<i8"))


def remove_repeats(docs: DataFrame, length: int = LENGTH, folder: str | None = None, keep: bool = False) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256) of every row; keep: also the remaining bytes, ``kept``."""
    spark = docs.sparkSession
    base = docs.select("doc_id", "text")
    at = folder or model_folder(spark)
    ranges = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))

    def count(batches):
        for b in text_batches(batches):
            _, _, h, f = fragments(*_batch(b), length)
            if len(h):
                order = np.argsort(h, kind="stable")
                h, f = h[order], f[order].view(np.int64)
                new = np.flatnonzero(np.concatenate(([True], h[1:] != h[:-1])))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(h[new].view(np.int64)), pa.array(np.diff(new, append=len(h))),
                     pa.array(np.minimum.reduceat(f, new)), pa.array(np.maximum.reduceat(f, new))], names=["h", "n", "lo", "hi"])

    counted = (base.select("text").mapInArrow(count, "h long, n long, lo long, hi long").groupBy("h")
               .agg(F.sum("n").alias("n"), F.min("lo").alias("lo"), F.max("hi").alias("hi")).where("n > 1"))
    known = counted.select("h", "n", (F.col("lo") != F.col("hi")).alias("unlike"),
                           F.expr(f"cast(shiftrightunsigned(shiftrightunsigned(h, 40) * {ranges}, 24) AS int)").alias("range"))
    anchor_kinds = {"keys": "<u8", "unlike": "u1"}
    hot = max(1, SHARD_BYTES // (length + length // 2))      # fragments that fill a shard

    def keep_anchors(t: pa.Table) -> pa.Table:
        h, n = t.column("h").to_numpy().view(np.uint64), t.column("n").to_numpy()
        order, unlike = np.argsort(h), t.column("unlike").to_numpy().astype(np.int64)
        unlike += unlike * (n > hot)
        r = t.column("range")[0].as_py()
        Stored(at, "anchors", anchor_kinds).write(r, keys=h[order], unlike=unlike[order])
        sums = [int(n[unlike == i].sum()) for i in (1, 2)]
        return pa.table({x: pa.array([v], pa.int64()) for x, v in zip(
            ("range", "keys", "unlike", "n_unlike", "n_hot"), (r, len(h), len(h), *sums), strict=True)})

    done = cut(known.groupBy("range").applyInArrow(keep_anchors, "range long, keys long, unlike long, n_unlike long, n_hot long"),
               "repeat-anchors")
    Stored(at, "anchors", anchor_kinds).join(done, ranges)     # ranges are in the order of hashes: so are all keys
    sent = done.agg(F.sum("n_unlike"), F.sum("n_hot")).head()
    # bytes to sort, and nine bytes for each start of a hot anchor
    weight = (sent[0] or 0) * (length + length // 2) + (sent[1] or 0) * 9 * (length - min(GRAM, length) + 1) // 2
    shards = max(1, -(-weight // SHARD_BYTES))

    def looked_up(h: np.ndarray, anchors: dict[str, np.ndarray]) -> np.ndarray:
        """0: occurs once, 1: all fragments are equal, 2: unlike ones, 3: very many, some of them unlike."""
        keys = anchors["keys"]
        if not len(keys):
            return np.zeros(len(h), dtype=np.int64)
        key, inv = np.unique(h, return_inverse=True)
        i = np.minimum(np.searchsorted(keys, key), len(keys) - 1)
        return np.where(keys[i] == key, 1 + anchors["unlike"][i].astype(np.int64), 0)[inv]

    def send(batches):
        anchors = Stored(at, "anchors", anchor_kinds).arrays()
        for b in text_batches(batches):
            data, sizes = _batch(b)
            first, starts, h, f = fragments(data, sizes, length)
            if not len(h):
                continue
            state = looked_up(h, anchors)
            mine = np.flatnonzero(state == 3)
            if len(mine):
                key, n = np.unique(start_hashes(data, first[mine], starts[mine], length)[1], return_counts=True)
                n, to = np.minimum(n, 2).astype(np.uint8), _range(key, shards)
                edges = np.flatnonzero(np.concatenate(([True], to[1:] != to[:-1], [True])))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(to[edges[:-1]].astype(np.int32)), pa.array(np.diff(edges)), *[pa.array(np.zeros(len(edges) - 1, np.int64))] * 2,
                     pa.array([key[a:z].tobytes() + n[a:z].tobytes() for a, z in zip(edges[:-1], edges[1:], strict=True)], pa.binary())],
                    names=["shard", "f", "starts", "copies", "body"])
            mine = np.flatnonzero(state == 2)
            _, one, copies = np.unique(f[mine], return_index=True, return_counts=True)
            one = mine[one]
            for i in range(0, len(one), 20_000):
                o, c = one[i:i + 20_000], copies[i:i + 20_000]
                stop = first[o] + starts[o] - 1 + length
                yield pa.RecordBatch.from_arrays(
                    [pa.array(_range(h[o], shards).astype(np.int32)), pa.array(f[o].view(np.int64)), pa.array(starts[o]),
                     pa.array(c), pa.array([data[a:z].tobytes() for a, z in zip(first[o], stop, strict=True)], pa.binary())],
                    names=["shard", "f", "starts", "copies", "body"])

    mark_kinds, start_kinds = {"keys": "<u8", "at": "<i8", "marks": "u1"}, {"keys": "<u8"}

    def count_starts(t: pa.Table) -> np.ndarray:
        """Starts of hot anchors that occur more often: those of a shard, each task's as keys and counts up to 2."""
        keys, counts = [], []
        for n, body in zip(t.column("f").to_pylist(), t.column("body"), strict=True):
            raw = np.frombuffer(body.as_buffer(), dtype=np.uint8)
            keys.append(raw[:8 * n].view("<u8"))
            counts.append(raw[8 * n:])
        key, counts = np.concatenate(keys), np.concatenate(counts)
        order = np.argsort(key, kind="stable")
        key, counts = key[order], counts[order]
        first = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
        return key[first][np.add.reduceat(counts, first, dtype=np.int64) > 1]

    def wrote(*sizes: int) -> pa.Table:
        names = ("range", "counted", "fragments", "bits")
        return pa.table({x: pa.array([v], pa.int64()) for x, v in zip(names, (*sizes, 0, 0)[:4], strict=True)})

    def sort_shard(t: pa.Table) -> pa.Table:
        r, single = t.column("shard")[0].as_py(), pa.compute.equal(t.column("starts"), 0)
        lists, t = t.filter(single), t.filter(pa.compute.invert(single))
        counted = count_starts(lists) if lists.num_rows else np.zeros(0, np.uint64)
        Stored(at, "starts", start_kinds).write(r, keys=counted)
        if not t.num_rows:
            return wrote(r, len(counted))
        f = t.column("f").to_numpy().view(np.uint64)
        key, one, inv = np.unique(f, return_index=True, return_inverse=True)
        copies = np.bincount(inv, weights=t.column("copies").to_numpy())
        starts = t.column("starts").to_numpy()[one]
        bodies = t.column("body").take(pa.array(one)).to_pylist()
        sizes = np.fromiter(map(len, bodies), dtype=np.int64, count=len(bodies)) + 1
        text = np.frombuffer(b"\0".join([*bodies, b""]), dtype=np.uint8).astype(np.uint16) + 1
        begin = np.cumsum(sizes) - sizes
        text[begin + sizes - 1] = 0
        again = repeated_places(text, length)
        place = np.cumsum(starts) - starts
        index = np.arange(starts.sum()) - np.repeat(place, starts) + np.repeat(begin, starts)
        marks = again[index] | np.repeat(copies > 1, starts)
        bits = np.packbits(marks)
        Stored(at, "marks", mark_kinds).write(r, keys=key, at=place, marks=bits)
        return wrote(r, len(counted), len(key), len(bits))

    done = cut(base.select("text").mapInArrow(send, "shard int, f long, starts long, copies long, body binary")
               .groupBy("shard").applyInArrow(sort_shard, "range long, counted long, fragments long, bits long"), "repeat-shards")
    Stored(at, "starts", start_kinds).join(done.select("range", F.col("counted").alias("keys")), shards)     # in the order of hashes
    Stored(at, "marks", mark_kinds).join(done.where("fragments > 0").select(
        "range", F.col("fragments").alias("keys"), F.col("fragments").alias("at"), F.col("bits").alias("marks")), shards)
    kind = docs.schema["doc_id"].dataType.simpleString()

    def remove(batches):
        anchors, marks = Stored(at, "anchors", anchor_kinds).arrays(), Stored(at, "marks", mark_kinds)
        counted, stored = Stored(at, "starts", start_kinds).arrays()["keys"], marks.arrays()
        of_keys, of_bits = marks.begins("keys"), 8 * marks.begins("marks")
        for b in text_batches(batches):
            data, sizes = _batch(b)
            first, starts, h, f = fragments(data, sizes, length)
            again = np.zeros(len(data), dtype=bool)
            if len(h):
                state = looked_up(h, anchors)
                same = np.flatnonzero(state == 1)
                edge = np.zeros(len(data) + 1, dtype=np.int8)      # fragments are apart: one may begin where another ends
                edge[first[same]] += 1
                edge[first[same] + starts[same]] -= 1
                again |= np.cumsum(edge[:-1], dtype=np.int8).view(bool)
                mine = np.flatnonzero(state == 3)
                if len(mine):
                    begin, key = start_hashes(data, first[mine], starts[mine], length)
                    if len(counted):
                        i = np.minimum(np.searchsorted(counted, key), len(counted) - 1)
                        again[begin] = counted[i] == key
                mine = np.flatnonzero(state == 2)
                if len(mine):
                    r = _range(h[mine], shards)
                    i = _within(stored["keys"], of_keys[r], of_keys[r + 1], f[mine])
                    off = np.arange(starts[mine].sum()) - np.repeat(np.cumsum(starts[mine]) - starts[mine], starts[mine])
                    bit = np.repeat(of_bits[r] + stored["at"][i], starts[mine]) + off
                    again[np.repeat(first[mine], starts[mine]) + off] = stored["marks"][bit >> 3] >> (7 - (bit & 7)).astype(np.uint8) & 1
            total = np.cumsum(again, dtype=np.int32)
            gone = total > 0
            gone[length:] = total[length:] > total[:-length]
            ends = np.cumsum(sizes)
            rows = []
            for s, e in zip((ends - sizes).tolist(), ends.tolist(), strict=True):
                g = gone[s:e]
                left = data[s:e][~g].tobytes() if g.any() else data[s:e].tobytes()
                spans = int(g[:1].sum() + (g[1:] & ~g[:-1]).sum())
                rows.append((e - s, e - s - len(left), spans, hashlib.sha256(left).hexdigest(), left))
            cols = [list(c) for c in zip(*rows, strict=True)]
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary()][:5 if keep else 4]
            names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"]
            yield pa.RecordBatch.from_arrays([b.column(0), *[pa.array(c, k) for c, k in zip(cols, kinds, strict=False)]],
                                             names=names[:len(kinds) + 1])

    out = f"doc_id {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + ", kept binary" * keep
    return base.mapInArrow(remove, out)


def query(spark, sf_dir: str) -> DataFrame:
    return remove_repeats(spark.read.parquet(f"{sf_dir}/documents.parquet"))
