"""Packing along a space-filling curve.

Documents are tokenised once; the token ids, hashed into ``buckets``, give a
damped and normalised count vector, which a fixed random projection maps to
``dims`` dimensions.  The quantised point's index on the Hilbert curve is the
sort key: the table is range-partitioned and sorted by it (ties by doc_id, so
a group of equal documents is split over ranges as well), and each range packs
its documents one after another, cutting where a sequence is full.  Similar
documents so meet in a sequence.

Every sequence but those at a range's end is full.  The rest at the end is cut
into sequences whose lengths are powers of two, which need no padding; there
is no padding at all, at any number of ranges.

The tokeniser's pre-tokeniser drops white space and never joins across it, and
its normaliser works inside words, so a text's ids are its words' ids one
after another; each worker keeps the ids of words it has met (bounded).
``by_words=False`` encodes whole texts, for tokenisers without that property.

Cases: null or empty text is the end id alone; a repeated doc_id is packed
once per row; an empty table gives an empty result; other input columns are
not used, whatever their names.
"""

from __future__ import annotations

import os
import sys
import uuid
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext, cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import scratch_path
from .common import encoded, partitions, table, texts, worker_cache

cloudpickle.register_pickle_by_value(sys.modules[__name__])

SEQUENCE = 2048
END_ID = 1
TOKENIZER = "word_bpe_49k.json"
_MEMO_WORDS = 2_000_000
_CHUNK_BYTES = 1 << 20
#: ASCII marks but the apostrophe, which the pre-tokeniser joins to letters.
_MARKS = b'!"#$%&()*+,-./:;<=>?@[\\]^_`{|}~'


def hilbert(points: np.ndarray, bits: int) -> np.ndarray:
    """Index on the Hilbert curve of each row of ``points`` (integers below
    2**bits), by Skilling's transform, for all rows at once."""
    x = points.astype(np.int64).copy()
    dims = x.shape[1]
    q = 1 << (bits - 1)
    while q > 1:
        p = q - 1
        for i in range(dims):
            high = (x[:, i] & q) > 0
            swap = np.where(high, 0, (x[:, 0] ^ x[:, i]) & p)
            x[:, 0] ^= np.where(high, p, swap)
            x[:, i] ^= swap
        q >>= 1
    for i in range(1, dims):
        x[:, i] ^= x[:, i - 1]
    flip = np.zeros(len(x), dtype=np.int64)
    q = 1 << (bits - 1)
    while q > 1:
        flip ^= np.where((x[:, dims - 1] & q) > 0, q - 1, 0)
        q >>= 1
    x ^= flip[:, None]
    key = np.zeros(len(x), dtype=np.int64)
    for b in range(bits - 1, -1, -1):
        for i in range(dims):
            key = (key << 1) | ((x[:, i] >> b) & 1)
    return key


class WordTokens:
    """Ids of texts, word by word, with a bounded memory of words."""

    def __init__(self, path: str, by_words: bool):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer, pre_tokenizers

        self.model, self.by_words = Tokenizer.from_file(path), by_words
        vocab = self.model.get_vocab(with_added_tokens=True)
        top = max(vocab.values()) + 1
        self.kind = np.dtype("<u2") if top <= 1 << 16 else np.dtype("<u4")
        self.ends = np.zeros(top, dtype=bool)
        for token, i in vocab.items():
            self.ends[i] = token.endswith("</w>")
        self.memo: dict[bytes, bytes] = {}
        # The model without normaliser and pre-tokeniser, which leave
        # lower-case ASCII words between spaces as they are (if they do).
        self.bare = Tokenizer(self.model.model)
        self.bare.pre_tokenizer = pre_tokenizers.CharDelimiterSplit(" ")
        probe = ["a the quick brown fox jumps over zyx abcdefghijklmnopqrstuvwxyz ll ve re the"]
        if self._encode(probe)[0].tolist() != self._encode(probe, self.bare)[0].tolist():
            self.bare = self.model

    def _encode(self, strings: list[str], model=None) -> list[np.ndarray]:
        # encode(), but for the offsets, which nothing here needs
        found = (model or self.model).encode_batch_fast(strings, add_special_tokens=False) if strings else []
        return [np.array(x.ids, dtype=self.kind) for x in found]

    def _plain(self, words: list[bytes], model) -> dict[bytes, bytes]:
        """Ids of lower-case words of letters only: each is one pre-token and
        ends in one word-end token, so they can be encoded together."""
        text = b" ".join(words).decode("utf-8", "surrogatepass")
        ids = self._encode([text], model)[0]
        cuts = np.flatnonzero(self.ends[ids]) + 1
        if len(cuts) != len(words) or (words and cuts[-1] != len(ids)):
            return {w: x.tobytes() for w, x in zip(words, self._encode([w.decode("utf-8", "surrogatepass") for w in words]))}
        raw, size, out, a = ids.tobytes(), self.kind.itemsize, {}, 0
        for w, b in zip(words, (cuts * size).tolist()):
            out[w] = raw[a:b]
            a = b
        return out

    def _learn(self, words: list[bytes]) -> dict[bytes, bytes]:
        """Ids of words that the memory does not have."""
        if len(self.memo) > _MEMO_WORDS:
            self.memo.clear()
        memo, simple, plain, parts, odd = self.memo, set(), set(), [], []
        for w in words:
            if w.isalpha() and w.islower():  # ASCII letters
                simple.add(w)
                continue
            core = w.rstrip(_MARKS)
            if core.isalpha() and core.islower():
                if core not in memo:
                    simple.add(core)
            else:
                s = core.decode("utf-8", "surrogatepass")
                if not s.isalpha() or s != s.lower():
                    odd.append(w)
                    continue
                if core not in memo:
                    plain.add(core)
            if len(core) < len(w):
                parts.append((w, core, w[len(core) :]))
        memo.update(self._plain(list(simple), self.bare))
        memo.update(self._plain(list(plain), self.model))
        # marks after a letter are a pre-token of their own
        marks = list({p[2] for p in parts})
        tails = {m: x.tobytes() for m, x in zip(marks, self._encode([m.decode() for m in marks]))}
        for w, core, tail in parts:
            memo[w] = memo[core] + tails[tail]
        for w, x in zip(odd, self._encode([w.decode("utf-8", "surrogatepass") for w in odd])):
            memo[w] = x.tobytes()
        return {w: memo[w] for w in words}

    def ids(self, chunk: list[str | None]) -> list[bytes]:
        """Little-endian ids of each text."""
        if not self.by_words:
            return [x.tobytes() for x in self._encode([t or "" for t in chunk])]
        split = []
        for t in chunk:
            raw = encoded(t)
            # the normaliser lower-cases; doing it here makes for fewer words
            # (a text that may hold special tokens stays as it is)
            split.append((raw if b"<|" in raw else raw.lower()).split())
        # the chunk's own words: small, so that it stays in the processor's cache
        held = self.memo.get
        own = {w: held(w) for w in set().union(*split)}
        own.update(self._learn([w for w, x in own.items() if x is None]))
        known = own.__getitem__
        return [b"".join(map(known, words)) for words in split]


def tokens(path: str, by_words: bool) -> WordTokens:
    return worker_cache(f"tokens {by_words} {path}", lambda: WordTokens(path, by_words))


def curve_keys(ids: list[np.ndarray], dims: int, bits: int, buckets: int) -> np.ndarray:
    """Hilbert keys of documents, from their hashed id counts."""
    weights = np.random.RandomState(8).standard_normal((buckets, dims))
    counts = np.empty((len(ids), buckets))
    for i, own in enumerate(ids):
        hashed = (own.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(40)
        counts[i] = np.bincount((hashed % np.uint64(buckets)).astype(np.int64), minlength=buckets)
    vectors = np.log1p(counts)
    vectors /= np.maximum(np.sqrt((vectors**2).sum(axis=1, keepdims=True)), 1e-12)
    spots = np.clip((vectors @ weights + 4) / 8, 0, 1 - 1e-9)
    return hilbert((spots * (1 << bits)).astype(np.int64), bits)


def tokenised(docs: DataFrame, text: str, doc_id: str, path: str, by_words: bool, end_id: int, dims: int, bits: int, buckets: int) -> DataFrame:
    """(doc_id, key, n, ids): ids with the end id, little-endian."""

    def run(batches):
        model = tokens(path, by_words)
        end = np.array([end_id], dtype=model.kind).tobytes()
        for batch in batches:
            chunk, size, start = [], 0, 0
            for i, t in enumerate(texts(batch.column(1))):
                chunk.append(t)
                size += len(t or "")
                if size >= _CHUNK_BYTES or i == batch.num_rows - 1:
                    raw = [x + end for x in model.ids(chunk)]
                    ids = [np.frombuffer(x, dtype=model.kind) for x in raw]
                    yield pa.RecordBatch.from_arrays(
                        [
                            batch.column(0).slice(start, len(chunk)),
                            pa.array(curve_keys(ids, dims, bits, buckets)),
                            pa.array([len(x) for x in ids], pa.int64()),
                            pa.array(raw, pa.binary()),
                        ],
                        ["doc_id", "key", "n", "ids"],
                    )
                    chunk, size, start = [], 0, i + 1

    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")).mapInArrow(
        run, "doc_id long, key long, n long, ids binary"
    )


class Packer:
    """Cuts a stream of documents into sequences."""

    def __init__(self, size: int, first: int):
        self.size, self.next, self.used = size, first, 0
        self.open: list[tuple] = []
        self.rows: list[tuple] = []

    def _close(self, pieces: list[tuple]) -> None:
        at = 0
        for doc, start, ids, total in pieces:
            self.rows.append((doc, start, len(ids), zlib.crc32(ids.astype("<u4").tobytes()), total, self.next, at, ids))
            at += len(ids)
        self.next += 1

    def add(self, doc: int | None, ids: np.ndarray) -> None:
        start = 0
        while start < len(ids):
            part = ids[start : start + self.size - self.used]
            self.open.append((doc, start, part, len(ids)))
            self.used += len(part)
            start += len(part)
            if self.used == self.size:
                self._close(self.open)
                self.open, self.used = [], 0

    def finish(self) -> None:
        """The rest, as sequences whose lengths are powers of two."""
        rest, self.open = self.open, []
        while self.used:
            room = 1 << (self.used.bit_length() - 1)
            self.used -= room
            pieces = []
            while room:
                doc, start, ids, total = rest.pop(0)
                pieces.append((doc, start, ids[:room], total))
                if len(ids) > room:
                    rest.insert(0, (doc, start + room, ids[room:], total))
                room -= len(pieces[-1][2])
            self._close(pieces)

    def take(self, with_ids: bool) -> pa.RecordBatch:
        rows, self.rows = self.rows, []
        names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
        columns = [pa.array([r[i] for r in rows], pa.int64()) for i in range(7)]
        if with_ids:
            columns.append(pa.array([r[7].astype(np.int32) for r in rows], pa.list_(pa.int32())))
            names.append("ids")
        return pa.RecordBatch.from_arrays(columns, names)


def pack_documents(
    docs: DataFrame,
    text: str = "text",
    doc_id: str = "doc_id",
    tokenizer: str | None = None,
    by_words: bool = True,
    size: int = SEQUENCE,
    end_id: int = END_ID,
    dims: int = 4,
    bits: int = 12,
    buckets: int = 1024,
    with_ids: bool = True,
) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens,
    sequence_id, offset and, with ``with_ids``, the ids.  ``tokenizer`` is a
    file that every executor has; ``size`` is a power of two."""
    if tokenizer is None:
        import public_tokenizers

        tokenizer = public_tokenizers.path(TOKENIZER)
    spark = docs.sparkSession
    kind = tokens(tokenizer, by_words).kind
    rows = tokenised(docs, text, doc_id, tokenizer, by_words, end_id, dims, bits, buckets)
    path = scratch_path(spark, "llm", f"tokens-{uuid.uuid4().hex}")
    rows.write.option("compression", "zstd").parquet(path)
    order = ["key", "doc_id", "n"]
    sorted_rows = spark.read.schema(rows.schema).parquet(path).repartitionByRange(partitions(spark), *order).sortWithinPartitions(*order, "ids")

    def run(batches):
        packer = Packer(size, TaskContext.get().partitionId() << 40)
        for batch in batches:
            for doc, ids in zip(batch.column(0).to_pylist(), batch.column(1)):
                packer.add(doc, np.frombuffer(ids.as_py(), dtype=kind))
            if packer.rows:
                yield packer.take(with_ids)
        packer.finish()
        yield packer.take(with_ids)

    schema = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
    return sorted_rows.select("doc_id", "ids").mapInArrow(run, schema + (", ids array<int>" if with_ids else ""))


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents").select("doc_id", "text"), with_ids=False)
