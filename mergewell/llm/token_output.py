"""Token ids in wavelet-matrix files.

Documents are dealt out by ranges of their id, encoded, and packed into shards of a few million
tokens.  A shard is one compressed file: bit-planes of a wavelet matrix with rank samples, and the
ids and lengths of its documents.  From that file alone, tokens can be read at any place, counted,
and looked up (:class:`WaveletMatrix`), or all of them read back.

The tokenizer drops white space and treats each run between it alone, so words are encoded once and
remembered; beyond the bound on the memory a worker encodes a word again.

Scale: one shuffle of the texts (the sort), then one pass; a worker holds one shard.  Files are the
rows of a table in shared storage, so any file system that Spark can write will do and a lost
executor's shards are written again.  The driver sees a row per shard, which is one for
``SHARD_TOKENS`` tokens; their starts are broadcast only under ``BROADCAST_SHARDS`` rows.

Defined results: a null text is empty and holds the end id alone; null ids come first; rows that share
an id follow in order of their text, each with its own row; an empty table gives no files.
"""

from __future__ import annotations

import os
import struct
import zlib
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize, partitions_for, remembered, whole_texts

END = 1
SHARD_TOKENS = 4_000_000
BROADCAST_SHARDS = 500_000
#: Words that a worker remembers: the first ones it meets, among which are the frequent ones.
REMEMBERED = 600_000
#: A word that the tokenizer gives one id; it parts the words that are encoded together.
_MARK = "~"
_MAGIC = b"WMTX0001"
_SAMPLE = 4096  # bits between rank samples


class WaveletMatrix:
    """A sequence of integers as bit-planes, most significant first.

    At each plane, numbers with a 0 bit move before those with a 1 bit, in their order.
    """

    def __init__(self, n: int, bits: int, planes: list[np.ndarray], samples: list[np.ndarray]):
        self.n, self.bits, self.planes, self.samples = n, bits, planes, samples
        self.zeros = [n - int(self._ones(k, n)) for k in range(bits)]

    @classmethod
    def build(cls, values: np.ndarray) -> WaveletMatrix:
        bits = max(1, int(values.max(initial=0)).bit_length())
        now, planes, samples = values, [], []
        for k in range(bits):
            one = (now >> (bits - 1 - k)) & 1 != 0
            planes.append(np.packbits(one, bitorder="little"))
            samples.append(cls._sampled(planes[-1]))
            now = np.concatenate([now[~one], now[one]])
        return cls(len(values), bits, planes, samples)

    @staticmethod
    def _sampled(plane: np.ndarray) -> np.ndarray:
        step = _SAMPLE // 8
        padded = np.concatenate([plane, np.zeros(-len(plane) % step, np.uint8)]).reshape(-1, step)
        return np.concatenate([[0], np.cumsum(np.bitwise_count(padded).sum(axis=1, dtype=np.int64))]).astype(np.uint32)

    def _ones(self, k: int, i):
        """Ones of plane ``k`` before ``i`` (a number or an array)."""
        at = np.atleast_1d(np.asarray(i, dtype=np.int64))
        block, plane = at // _SAMPLE, self.planes[k]
        out = self.samples[k][block].astype(np.int64)
        for j, (b, x) in enumerate(zip(block, at)):
            start, whole = b * (_SAMPLE // 8), x // 8
            out[j] += int(np.bitwise_count(plane[start:whole]).sum(dtype=np.int64))
            if x % 8:
                out[j] += int(plane[whole] & ((1 << (x % 8)) - 1)).bit_count()
        return out[0] if np.isscalar(i) or np.ndim(i) == 0 else out

    def _bit(self, k: int, i: int) -> int:
        return int(self.planes[k][i >> 3] >> (i & 7)) & 1

    def access(self, i: int) -> int:
        """The value at place ``i``."""
        value = 0
        for k in range(self.bits):
            one = self._bit(k, i)
            ones = int(self._ones(k, i))
            i = self.zeros[k] + ones if one else i - ones
            value = value << 1 | one
        return value

    def rank(self, value: int, i: int | None = None) -> int:
        """How often ``value`` stands before place ``i``; in all without ``i``."""
        low, high = 0, self.n if i is None else i
        if value >> self.bits:
            return 0
        for k in range(self.bits):
            a, b = (int(x) for x in self._ones(k, np.array([low, high])))
            if value >> (self.bits - 1 - k) & 1:
                low, high = self.zeros[k] + a, self.zeros[k] + b
            else:
                low, high = low - a, high - b
        return high - low

    def select(self, value: int, j: int) -> int:
        """The place of occurrence ``j`` (from 0) of ``value``, or -1."""
        if not 0 <= j < self.rank(value):
            return -1
        low = 0
        for k in range(self.bits):
            ones = int(self._ones(k, low))
            low = self.zeros[k] + ones if value >> (self.bits - 1 - k) & 1 else low - ones
        at = low + j
        for k in reversed(range(self.bits)):
            one = value >> (self.bits - 1 - k) & 1
            at = self._select_bit(k, one, at - self.zeros[k] if one else at)
        return at

    def _select_bit(self, k: int, one: int, j: int) -> int:
        before = self.samples[k].astype(np.int64)
        if not one:
            before = np.minimum(np.arange(len(before)) * _SAMPLE, self.n) - before
        block = int(np.searchsorted(before, j, side="right")) - 1
        start = block * (_SAMPLE // 8)
        bits = np.unpackbits(self.planes[k][start : start + _SAMPLE // 8], bitorder="little")
        return block * _SAMPLE + int(np.flatnonzero(bits == one)[j - before[block]])

    def occurrences(self, value: int) -> list[int]:
        return [self.select(value, j) for j in range(self.rank(value))]

    def values(self) -> np.ndarray:
        """The whole sequence, rebuilt from the last plane up."""
        kind = np.uint16 if self.bits <= 16 else np.uint32
        now = np.zeros(self.n, kind)
        for k in reversed(range(self.bits)):
            one = np.unpackbits(self.planes[k], count=self.n, bitorder="little").view(bool)
            before = np.empty(self.n, kind)
            before[~one] = now[: self.zeros[k]]
            before[one] = now[self.zeros[k] :]
            before |= one.astype(kind) << kind(self.bits - 1 - k)
            now = before
        return now


def write_shard(values: np.ndarray, doc_ids: list[int | None], lengths: np.ndarray) -> bytes:
    """The shard's file."""
    wm = WaveletMatrix.build(values)
    known = np.array([d is not None for d in doc_ids], dtype=np.uint8)
    ids = np.array([d or 0 for d in doc_ids], dtype="<i8")
    parts = [ids.tobytes(), known.tobytes(), lengths.astype("<u8").tobytes()]
    for plane, sample in zip(wm.planes, wm.samples):
        parts += [plane.tobytes(), sample.astype("<u4").tobytes()]
    z = zstandard.ZstdCompressor(level=1)
    packed = [z.compress(p) for p in parts]
    head = struct.pack("<8sQQBI", _MAGIC, wm.n, len(doc_ids), wm.bits, len(packed))
    return head + struct.pack(f"<{len(packed)}Q", *map(len, packed)) + b"".join(packed)


def read_shard(data: bytes) -> tuple[WaveletMatrix, list[int | None], np.ndarray]:
    magic, n, docs, bits, count = struct.unpack_from("<8sQQBI", data)
    if magic != _MAGIC:
        raise ValueError("not a token shard")
    at = struct.calcsize("<8sQQBI")
    sizes = struct.unpack_from(f"<{count}Q", data, at)
    at += 8 * count
    z, parts = zstandard.ZstdDecompressor(), []
    for size in sizes:
        parts.append(z.decompress(data[at : at + size]))
        at += size
    known = np.frombuffer(parts[1], np.uint8)
    ids = [int(d) if k else None for d, k in zip(np.frombuffer(parts[0], "<i8"), known)]
    planes = [np.frombuffer(p, np.uint8) for p in parts[3::2]]
    samples = [np.frombuffer(p, "<u4") for p in parts[4::2]]
    return WaveletMatrix(n, bits, planes, samples), ids, np.frombuffer(parts[2], "<u8")


class _Words(dict):
    """Numbers of words; a new word gets the next number and waits to be encoded."""

    def __init__(self) -> None:
        self.waiting: list[bytes] = []
        self.next = 1  # 0 is the end of a document

    def __missing__(self, word: bytes) -> int:
        self[word] = n = self.next
        self.next += 1
        self.waiting.append(word)
        return n


class Encoder:
    """Encodes whole texts through remembered words, ids as the tokenizer gives for the whole text."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        marked = self.tokenizer.encode(_MARK, add_special_tokens=False).ids
        self.mark = marked[0] if len(marked) == 1 else None
        self.kind = np.uint16 if self.tokenizer.get_vocab_size() <= 1 << 16 else np.uint32
        self.words = _Words()
        self.flat = np.array([END], dtype=self.kind)
        self.starts = np.zeros(1, np.int64)
        self.sizes = np.ones(1, np.int64)

    def _encode_waiting(self) -> None:
        waiting = self.words.waiting
        if not waiting:
            return
        # A full stop or comma after an ASCII letter or digit is a token run of its own.
        stems = [w[:-1] if w[-1:] in b".," and w[-2:-1].isalnum() else w for w in waiting]
        first, number = len(self.starts), self.words.get  # words that wait have numbers from ``first`` on
        parts = dict.fromkeys([*stems, b".", b","])
        unknown = [w for w in parts if number(w, first) >= first]
        ids = dict(zip(unknown, self._encode_words([w.decode() for w in unknown])))
        for w in parts:
            if w not in ids:
                n = number(w)
                ids[w] = self.flat[self.starts[n] : self.starts[n] + self.sizes[n]].tolist()
        new = [ids[s] + (ids[w[-1:]] if len(s) < len(w) else []) for s, w in zip(stems, waiting)]
        sizes = np.array([len(x) for x in new], dtype=np.int64)
        starts = len(self.flat) + np.concatenate([[0], np.cumsum(sizes)[:-1]])
        self.flat = np.concatenate([self.flat, np.array([i for x in new for i in x], dtype=self.kind)])
        self.starts, self.sizes = np.concatenate([self.starts, starts]), np.concatenate([self.sizes, sizes])
        waiting.clear()

    def _trim(self) -> None:
        """Drops the words beyond the bound; numbers are given in order, so these are the latest."""
        if len(self.words) > REMEMBERED:
            for w in list(islice(reversed(self.words), len(self.words) - REMEMBERED)):
                del self.words[w]
            self.words.next = keep = REMEMBERED + 1
            self.starts, self.sizes = self.starts[:keep], self.sizes[:keep]
            self.flat = self.flat[: int(self.starts[-1] + self.sizes[-1])]

    def _encode_words(self, words: list[str]) -> list[list[int]]:
        """Ids of each word; words go to the tokenizer in longer texts, parted by the mark, and without offsets."""
        plain = [w for w in words if _MARK not in w and "<|" not in w] if self.mark is not None else []
        found: dict[str, list[int]] = {}
        for i in range(0, len(plain), 200):
            part = plain[i : i + 200]
            row, at = self.tokenizer.encode_batch_fast([f" {_MARK} ".join(part) + f" {_MARK}"], add_special_tokens=False)[0].ids, 0
            for w in part:
                end = row.index(self.mark, at)
                found[w] = row[at:end]
                at = end + 1
        return [found[w] if w in found else self.tokenizer.encode(w, add_special_tokens=False).ids for w in words]

    def encode(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """All ids with an end id after each text, and how many each text has."""
        numbers: list[int] = []
        ends = []
        number = self.words.__getitem__
        for t in texts:
            # Case is dropped by the tokenizer; only its special names depend on it.
            numbers.extend(map(number, (t if b"<|" in t else t.lower()).split()))
            numbers.append(0)
            ends.append(len(numbers))
        self._encode_waiting()
        at = np.array(numbers, dtype=np.int64)
        size = self.sizes[at]
        upto = np.cumsum(size)
        total = int(upto[-1]) if len(upto) else 0
        out = self.flat[np.repeat(self.starts[at] - (upto - size), size) + np.arange(total)]
        self._trim()
        return out, np.diff(np.concatenate([[0], upto[np.array(ends, dtype=np.int64) - 1]])) if ends else np.zeros(0, np.int64)


def encoder_for(path: str) -> Encoder:
    """The worker's encoder; its tasks share what it remembers."""
    return remembered(f"encoder {path}", lambda: Encoder(path))


def _pack(path: str, shard_tokens: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoder_for(path)
        part = TaskContext.get().partitionId()
        held: list[np.ndarray] = []
        ids: list[int | None] = []
        lengths: list[np.ndarray] = []
        tokens = seq = 0

        def file() -> pa.RecordBatch:
            nonlocal tokens, seq
            data = write_shard(np.concatenate(held), ids, np.concatenate(lengths))
            row = pa.RecordBatch.from_pydict({"part": pa.array([part], pa.int32()), "seq": pa.array([seq], pa.int32()), "n_docs": pa.array([len(ids)], pa.int64()), "n_tokens": pa.array([tokens], pa.int64()), "file": pa.array([data], pa.binary())})
            held.clear(), ids.clear(), lengths.clear()
            tokens, seq = 0, seq + 1
            return row

        for batch in batches:
            for at in range(0, batch.num_rows, 200):
                piece = batch.slice(at, 200)
                out, sizes = encoder.encode(piece.column(1).cast(pa.binary()).to_pylist())
                held.append(out)
                lengths.append(sizes)
                ids.extend(piece.column(0).to_pylist())
                tokens += len(out)
                if tokens >= shard_tokens:
                    yield file()
        if ids:
            yield file()

    return run


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def write_token_files(docs: DataFrame, vocabulary: str | None = None, shard_tokens: int = SHARD_TOKENS) -> DataFrame:
    """Write the files; returns their table ``part, seq, n_docs, n_tokens, file`` in shared storage."""
    docs = whole_texts(docs)
    dealt = docs.repartitionByRange(partitions_for(docs), F.col("doc_id").asc_nulls_first()).sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "text")
    return materialize(dealt.mapInArrow(_pack(vocabulary or default_vocabulary(), shard_tokens), "part int, seq int, n_docs long, n_tokens long, file binary"), "tokens")


def _unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for start, data in zip(batch.column(0).to_pylist(), batch.column(1)):
            wm, ids, lengths = read_shard(data.as_py())
            values = wm.values()
            ends = np.cumsum(lengths.astype(np.int64))
            begins = ends - lengths.astype(np.int64)
            crc = [zlib.crc32(values[a:b].astype("<u4").tobytes()) for a, b in zip(begins, ends)]
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(start + begins, pa.int64()), pa.array(lengths.astype(np.int64), pa.int64()), pa.array(crc, pa.int64())], names=["doc_id", "start", "n_tokens", "ids_crc32"])


def read_token_files(files: DataFrame) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of every document, from the files."""
    shards = files.select("part", "seq", "n_tokens")
    parts = shards.groupBy("part").agg(F.sum("n_tokens").alias("t"))
    parts = parts.select("part", (F.sum("t").over(Window.orderBy("part")) - F.col("t")).alias("before"))
    within = shards.withColumn("inside", F.sum("n_tokens").over(Window.partitionBy("part").orderBy("seq")) - F.col("n_tokens"))
    starts = materialize(within.join(parts, "part").select("part", "seq", (F.col("before") + F.col("inside")).alias("start")), "starts")
    side = F.broadcast(starts) if starts.count() <= BROADCAST_SHARDS else starts
    return files.select("part", "seq", "file").join(side, ["part", "seq"]).select("start", "file").mapInArrow(_unpack, "doc_id long, start long, n_tokens long, ids_crc32 long")
