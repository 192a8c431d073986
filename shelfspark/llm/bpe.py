"""BPE encoding and decoding with content-defined chunk reuse.

A rolling hash of the last ``WINDOW`` bytes cuts a text where its top bits are zero, so equal
passages are cut alike wherever they stand. A chunk is encoded once in a task and its result is
reused for all documents of the task that hold it. At a join the chunks' outer words may be
halves of one word, so the text around each join is encoded again as one piece, together with the
next whole word of either chunk; it is accepted when its outer ids agree exactly with those the
chunks have for these words, else the piece grows by more words, up to the whole text.

Chunks are encoded by white-space words: the tokenizer's normaliser and splitter never carry
anything across ASCII white space, and equal words of a task are given to the library once, many joined in one text. Ids
and decoded text are those of the tokenizers library for the whole text; tests compare them.

Every task needs only its own documents: no shuffle, caches of bounded size, and a lost executor
costs the tasks it ran. The vocabulary's path is a parameter and must be readable on workers.

Defined results: null text is encoded as the empty text (no ids); repeated rows give repeated
results; an empty table gives no rows; input columns named like an output column are replaced.
"""

from __future__ import annotations

import hashlib
import os

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfspark.llm.common import text_batches, texts_of, without

VOCABULARY = public_tokenizers.path("word_bpe_49k.json")
#: Bytes that the rolling hash sees; a cut every 2**CUT_BITS bytes on average.
WINDOW, CUT_BITS = 16, 10
#: Chunks and words that a task keeps before it starts anew.
CACHE_CHUNKS, CACHE_WORDS = 20_000, 400_000
#: Words that are given to the library as one text.
TOGETHER = 64
#: Bytes of texts encoded at once.
STEP_BYTES = 512 << 10
_GEAR = np.random.default_rng(20_241).integers(0, 1 << 32, size=256, dtype=np.uint32)


def cut_points(data: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Sorted places where texts, lying one after another in ``data`` from ``starts``, are cut.

    A place is the first byte of a chunk: content-defined, at a character's start, and never
    within WINDOW bytes of its text's start, so that only the text itself decides.
    """
    h = _GEAR[data]
    step = 1
    while step < WINDOW:                      # h[i]: sum of gear[data[i - j]] << j for j < 2 * step
        h[step:] = h[step:] + (h[:-step] << np.uint32(step))
        step *= 2
    places = np.flatnonzero(h >> np.uint32(32 - CUT_BITS) == 0) + 1
    for _ in range(3):                        # to the next start of a character
        inside = places < len(data)
        places[inside] += (data[places[inside]] & 0xC0) == 0x80
    places = places[places < len(data)]
    begun = starts[np.searchsorted(starts, places, side="right") - 1]
    return np.unique(places[places - begun >= WINDOW])


class Coder:
    """Encodes texts with one tokenizer and the caches of one task."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.lib = Tokenizer.from_file(path)
        self.lib.no_truncation()
        self.lib.no_padding()
        self.words: dict[bytes, tuple[bytes, str]] = {}
        self.chunks: dict[bytes, tuple] = {}

    def _library(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.lib.encode_batch(texts, add_special_tokens=False)]

    def _pair(self, ids: list[int]) -> tuple[bytes, str]:
        return np.asarray(ids, dtype="<u4").tobytes(), self.lib.decode(ids, skip_special_tokens=False)

    def _by_words(self, words: list[str]) -> tuple[list[list[int]], list[bytes]]:
        """The ids of each word, also as bytes. ``TOGETHER`` words are one text for the library, joined by spaces; where
        a token begins says whose it is."""
        ids, packed = [], []
        groups = [words[i:i + TOGETHER] for i in range(0, len(words), TOGETHER)]
        for group, e in zip(groups, self.lib.encode_batch([" ".join(g) for g in groups], add_special_tokens=False), strict=True):
            got, begins = e.ids, np.fromiter((a for a, _ in e.offsets), dtype=np.int64)
            if (begins[1:] < begins[:-1]).any():
                each = self._library(group)
                ids += each
                packed += [np.asarray(x, dtype="<u4").tobytes() for x in each]
                continue
            raw, at = np.asarray(got, dtype="<u4").tobytes(), 0
            for end in np.searchsorted(begins, np.cumsum([len(w) + 1 for w in group])).tolist():
                ids.append(got[at:end])
                packed.append(raw[4 * at:4 * end])
                at = end
        return ids, packed

    def _learn(self, words: set[bytes]) -> None:
        new = [w for w in words if w not in self.words]
        if not new:
            return
        ids, packed = self._by_words([w.decode() for w in new])
        texts = self.lib.decode_batch(ids, skip_special_tokens=False)
        self.words.update(zip(new, zip(packed, texts, strict=True), strict=True))

    def _of_words(self, words: list[bytes]) -> tuple[bytes, str]:
        got = [self.words[w] for w in words]
        return b"".join([g[0] for g in got]), " ".join([g[1] for g in got if g[0]])

    def _chunk_results(self, chunks: list[bytes], keys: list[bytes]) -> None:
        """Encodes chunks that are new: (head, ids, text, first word, last word, tail); no white space: (chunk,)."""
        new = {k: c for k, c in zip(keys, chunks, strict=True) if k not in self.chunks}
        parts = {}
        for k, c in new.items():
            w = c.split()
            head = b"" if c[:1].isspace() else (w.pop(0) if w else b"")
            if head and len(head) == len(c):
                self.chunks[k] = (c,)
                continue
            tail = b"" if c[-1:].isspace() or not w else w.pop()
            parts[k] = (head, w, tail)
        self._learn({x for _, w, _ in parts.values() for x in w})
        for k, (head, w, tail) in parts.items():
            self.chunks[k] = (head, *self._of_words(w), w[0] if w else b"", w[-1] if w else b"", tail)

    def encode(self, texts: list[str]) -> list[tuple[bytes, str]]:
        """(ids as little-endian unsigned 32-bit integers, decoded text) of each text."""
        if len(self.chunks) > CACHE_CHUNKS:
            self.chunks.clear()
        if len(self.words) > CACHE_WORDS:
            self.words.clear()
        raw = [t.encode() for t in texts]
        sizes = np.fromiter(map(len, raw), dtype=np.int64, count=len(raw))
        starts = np.cumsum(sizes) - sizes
        data = b"".join(raw)
        places = cut_points(np.frombuffer(data, dtype=np.uint8), starts) if data else np.zeros(0, dtype=np.int64)
        bounds = np.union1d(np.append(starts, len(data)), places).tolist()
        chunks = [data[a:b] for a, b in zip(bounds, bounds[1:], strict=False)]
        keys = [hashlib.blake2b(c, digest_size=16).digest() for c in chunks]
        self._chunk_results(chunks, keys)
        first = np.searchsorted(bounds, starts).tolist()
        plans, seams = [], {}
        for i, n in enumerate(sizes.tolist()):
            # pieces: chunk results, and between them the words that joins have cut
            pieces, open_, left = [], b"", b""
            j = first[i]
            while n > 0:
                c = self.chunks[keys[j]]
                n -= len(chunks[j])
                j += 1
                if len(c) == 1:
                    open_ += c[0]
                    continue
                open_ += c[0]
                if open_:
                    seam = (left, open_, c[3])
                    seams[seam] = None
                    pieces.append(seam)
                if c[1]:
                    pieces.append(c[1:3])
                    left = c[4]
                open_ = c[5]
            if open_:
                seam = (left, open_, b"")
                seams[seam] = None
                pieces.append(seam)
            plans.append(pieces)
        self._learn({x for s in seams for x in (s[0], s[2]) if x})
        tried = self._library([b" ".join(x for x in s if x).decode() for s in seams])
        for s, ids in zip(list(seams), tried, strict=True):
            got = np.asarray(ids, dtype="<u4").tobytes()
            a, b = (self.words[x][0] if x else b"" for x in (s[0], s[2]))
            if got.startswith(a) and got.endswith(b) and len(got) >= len(a) + len(b):
                seams[s] = self._pair(ids[len(a) // 4:len(ids) - len(b) // 4])
        out = []
        for text, pieces in zip(texts, plans, strict=True):
            done = [seams[p] if len(p) == 3 else p for p in pieces]
            if None in done:                    # no agreement: the piece has grown to the whole text
                out.append(self._pair(self._library([text])[0]))
            else:
                out.append((b"".join([d[0] for d in done]), " ".join([d[1] for d in done if d[0]])))
        return out


def encode_documents(docs: DataFrame, path: str = VOCABULARY, keep: bool = False, text: str = "text") -> DataFrame:
    """``docs`` less its text, with n_tokens and the digests of ids and decoded text; keep: also ids and decoded."""
    extra = [T.StructField("n_tokens", T.LongType()), T.StructField("ids_sha256", T.StringType()),
             T.StructField("decoded_sha256", T.StringType())]
    if keep:
        extra += [T.StructField("ids", T.ArrayType(T.IntegerType())), T.StructField("decoded", T.StringType())]
    base = without(docs, *[f.name for f in extra])
    schema = T.StructType([*[f for f in base.schema.fields if f.name != text], *extra])

    def run(batches):
        coder = Coder(path)
        for b in text_batches(batches, STEP_BYTES):
            got = coder.encode(texts_of(b, text))
            cols = [c for n, c in zip(b.schema.names, b.columns, strict=True) if n != text]
            cols += [pa.array([len(i) // 4 for i, _ in got], pa.int64()),
                     pa.array([hashlib.sha256(i).hexdigest() for i, _ in got], pa.string()),
                     pa.array([hashlib.sha256(s.encode()).hexdigest() for _, s in got], pa.string())]
            if keep:
                cols += [pa.array([np.frombuffer(i, dtype="<u4").astype(np.int32) for i, _ in got], pa.list_(pa.int32())),
                         pa.array([s for _, s in got], pa.string())]
            yield pa.RecordBatch.from_arrays(cols, names=schema.fieldNames())

    return base.mapInArrow(run, schema)


def query(spark, sf_dir: str) -> DataFrame:
    return encode_documents(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))


def stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Last pipeline stage: the ids' digests of each document that is left."""
    return encode_documents(docs.select("doc_id", F.col("text")))
