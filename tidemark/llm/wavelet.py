"""Token ids in wavelet-matrix files: one compressed file per shard with access, counting and occurrence lookup.

Documents are sorted by id over range partitions, encoded, and written in shards of about ``shard_tokens`` ids. A shard
is one binary value of a table in the shared folder, written by Spark's committer, so a lost executor leaves no half
file. The value is a file of its own: header, alphabet, document directory, and per bit-plane a rank directory and
separately compressed blocks, so that a lookup opens only the blocks it passes through.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import work_dir
from .common import blocks
from .encoder import encoder

MAGIC = b"WVLT0001"
BLOCK = 1 << 16  # bits of a plane that are compressed together
TOGETHER = 2000  # texts that are encoded at once, or fewer where they are long
HEAD = struct.Struct("<8sQIIQ")  # magic, ids, planes, alphabet size, documents


def write_file(ids: np.ndarray, doc_ids: np.ndarray, lengths: np.ndarray) -> bytes:
    """The bytes of a shard. ``doc_ids`` and ``lengths`` say which documents the ids belong to, in order."""
    symbols, codes = alphabet(ids)
    levels = max(1, int(len(symbols) - 1).bit_length()) if len(symbols) else 0
    press = zstandard.ZstdCompressor(level=1)
    dictionary = press.compress(np.concatenate([doc_ids.astype("<i8"), lengths.astype("<i8")]).tobytes())
    heads, bodies = [], []
    for level in range(levels - 1, -1, -1):
        blocks, ones, low, high = [], [], [], []
        for a in range(0, len(ids), BLOCK):  # what a block needs stays in the processor's cache
            part = codes[a : a + BLOCK]
            on = (part & codes.dtype.type(1 << level)) != 0
            blocks.append(press.compress(np.packbits(on, bitorder="little").tobytes()))
            low.append(part.compress(~on))
            high.append(part.compress(on))
            ones.append(len(high[-1]))
        before = np.concatenate([[0], np.cumsum(ones)])
        ends = np.concatenate([[0], np.cumsum([len(b) for b in blocks])])
        heads.append(np.concatenate([before, ends]).astype("<i8").tobytes())
        bodies.append(b"".join(blocks))
        codes = np.concatenate([*low, *high])
    names = symbols.astype("<u4").tobytes()
    return b"".join([HEAD.pack(MAGIC, len(ids), levels, len(symbols), len(doc_ids)), names,
                     struct.pack("<Q", len(dictionary)), dictionary, *heads, *bodies])


def alphabet(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The ids that occur, ascending, and each id's place among them."""
    if not len(ids):
        return np.zeros(0, np.int64), np.zeros(0, np.uint16)
    seen = np.zeros(int(ids.max()) + 1, bool)
    seen[ids] = True
    symbols = np.flatnonzero(seen)
    place = np.zeros(len(seen), np.uint16 if len(symbols) <= 1 << 16 else np.uint32)
    place[symbols] = np.arange(len(symbols))
    return symbols, place[ids]


class WaveletFile:
    """Reads a shard. Positions and ids out of range raise IndexError or count as absent."""

    def __init__(self, raw: bytes):
        self.raw = raw
        magic, self.n, self.levels, size, self.docs = HEAD.unpack_from(raw)
        if magic != MAGIC:
            raise ValueError("not a wavelet file")
        at = HEAD.size
        self.symbols = np.frombuffer(raw, "<u4", size, at)
        at += 4 * size
        (packed,) = struct.unpack_from("<Q", raw, at)
        at += 8
        table = np.frombuffer(zstandard.ZstdDecompressor().decompress(raw[at : at + packed]) if packed else b"", "<i8")
        self.doc_ids, self.lengths = table[: self.docs], table[self.docs :]
        at += packed
        count = -(-self.n // BLOCK) + 1
        self.ones, self.ends = [], []
        for _ in range(self.levels):
            both = np.frombuffer(raw, "<i8", 2 * count, at)
            self.ones.append(both[:count])
            self.ends.append(both[count:])
            at += 16 * count
        self.body = []
        for ends in self.ends:
            self.body.append(at)
            at += int(ends[-1])
        self._open: dict[tuple[int, int], np.ndarray] = {}
        self._press = zstandard.ZstdDecompressor()

    def _block(self, level: int, block: int) -> np.ndarray:
        key = (level, block)
        if key not in self._open:
            if len(self._open) > 64:
                self._open.clear()
            a, b = (self.body[level] + int(x) for x in self.ends[level][block : block + 2])
            packed = np.frombuffer(self._press.decompress(self.raw[a:b]), np.uint8)
            self._open[key] = np.unpackbits(packed, bitorder="little")
        return self._open[key]

    def _rank1(self, level: int, i: int) -> int:
        """Ones of a plane before position i."""
        block, rest = divmod(i, BLOCK)
        return int(self.ones[level][block]) + (int(self._block(level, block)[:rest].sum()) if rest else 0)

    def _zeros(self, level: int) -> int:
        return self.n - int(self.ones[level][-1])

    def _select(self, level: int, bit: int, k: int) -> int:
        """Position of the k-th (from 0) zero or one of a plane."""
        ones = self.ones[level]
        before = ones if bit else np.minimum(np.arange(len(ones)) * BLOCK, self.n) - ones
        block = int(np.searchsorted(before, k, "right")) - 1
        inside = np.flatnonzero(self._block(level, block)[: self.n - block * BLOCK] == bit)
        return block * BLOCK + int(inside[k - int(before[block])])

    def access(self, i: int) -> int:
        """The id at position i."""
        if not 0 <= i < self.n:
            raise IndexError(i)
        code = 0
        for level in range(self.levels):
            bit = int(self._block(level, i // BLOCK)[i % BLOCK])
            ones = self._rank1(level, i)
            code = code << 1 | bit
            i = self._zeros(level) + ones if bit else i - ones
        return int(self.symbols[code])

    def _code(self, token: int) -> int | None:
        at = int(np.searchsorted(self.symbols, token))
        return at if at < len(self.symbols) and self.symbols[at] == token else None

    def _range(self, code: int, start: int, end: int) -> tuple[int, int]:
        """Where the occurrences of a code within [start, end) lie after the last plane."""
        for level in range(self.levels):
            a, b = self._rank1(level, start), self._rank1(level, end)
            if code >> (self.levels - 1 - level) & 1:
                start, end = self._zeros(level) + a, self._zeros(level) + b
            else:
                start, end = start - a, end - b
        return start, end

    def count(self, token: int, start: int = 0, end: int | None = None) -> int:
        """How often an id occurs in [start, end)."""
        code = self._code(token)
        start, end = max(0, start), self.n if end is None else min(end, self.n)
        if code is None or start >= end:
            return 0
        a, b = self._range(code, start, end)
        return b - a

    def locate(self, token: int, k: int) -> int:
        """Position of the k-th (from 0) occurrence of an id."""
        code = self._code(token)
        if code is None or not 0 <= k < self.count(token):
            raise IndexError(k)
        at = self._range(code, 0, self.n)[0] + k
        for level in range(self.levels - 1, -1, -1):
            bit = code >> (self.levels - 1 - level) & 1
            at = self._select(level, bit, at - self._zeros(level) if bit else at)
        return at

    def decode(self) -> np.ndarray:
        """All ids, plane by plane from the last one."""
        kind = np.uint16 if len(self.symbols) <= 1 << 16 else np.uint32
        codes = np.zeros(self.n, kind)
        for level in range(self.levels - 1, -1, -1):
            ends = (self.body[level] + self.ends[level]).tolist()
            low, high, up = 0, self._zeros(level), np.empty_like(codes)
            for block, (a, b) in enumerate(zip(ends, ends[1:], strict=False)):
                part = up[block * BLOCK : (block + 1) * BLOCK]
                packed = np.frombuffer(self._press.decompress(self.raw[a:b]), np.uint8)
                on = np.unpackbits(packed, count=len(part), bitorder="little").view(bool)
                # Places are quicker than masks where zeros and ones take turns.
                zeros, ones = np.flatnonzero(~on), np.flatnonzero(on)
                part[zeros] = codes[low : low + len(zeros)]
                part[ones] = codes[high : high + len(ones)] | kind(1 << (self.levels - 1 - level))
                low, high = low + len(zeros), high + len(ones)
            codes = up
        return self.symbols[codes]


def write_shards(docs: DataFrame, path: str, tokenizer: str, end_id: int = 0, shard_tokens: int = 1 << 21,
                 cache: int = 800_000) -> None:
    """Encode all documents and write them in ascending ``doc_id`` order (nulls first) as wavelet files below ``path``.

    Every row is one document with the end id after it; a null text counts as empty. Rows of one id stay together.
    A document is never split, so a shard may exceed ``shard_tokens`` by its last document.
    ``cache`` is the number of chunks in a generation of the token cache.
    """

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, part, seq = encoder(tokenizer, cache), TaskContext.get().partitionId(), 0
        end = np.array([end_id], enc.dtype).tobytes()
        names, lengths, parts, held = [], [], [], 0

        def flush() -> pa.RecordBatch:
            ids = np.frombuffer(b"".join(parts), enc.dtype)
            known = np.array([x is not None for x in names])
            raw = write_file(ids, np.array([x or 0 for x in names], np.int64),
                             np.where(known, 1, -1) * np.array(lengths, np.int64))
            return pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int32()), pa.array([seq], pa.int32()), pa.array([len(ids)], pa.int64()),
                 pa.array([len(names)], pa.int64()), pa.array([raw], pa.binary())],
                names=["part", "seq", "n_tokens", "n_docs", "file"])

        for batch in batches:
            for block in blocks(batch, 1, TOGETHER, 8 << 20):
                ids, texts = block.column(0).to_pylist(), block.column(1).to_pylist()
                for doc_id, raw in zip(ids, enc.encode(texts, TOGETHER), strict=True):
                    names.append(doc_id)
                    parts.append(raw + end)
                    lengths.append(len(parts[-1]) // enc.dtype.itemsize)
                    held += lengths[-1]
                    if held >= shard_tokens:
                        yield flush()
                        names, lengths, parts, held, seq = [], [], [], 0, seq + 1
        if names:
            yield flush()

    ordered = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    ordered = ordered.repartitionByRange("doc_id").sortWithinPartitions("doc_id", F.xxhash64("text"))
    shards = ordered.mapInArrow(encode, "part int, seq int, n_tokens long, n_docs long, file binary")
    shards.write.option("compression", "none").parquet(path)


def read_shards(spark: SparkSession, path: str) -> DataFrame:
    """Per document, from the files: ``doc_id, start, n_tokens, ids_crc32, shard_part, shard_seq``.

    ``start`` counts the ids of all documents before it. Totals of shards are summed per range partition first, so
    the one ordered pass over everything has a row per partition.
    """
    schema = "part int, seq int, n_tokens long, n_docs long, file binary"
    shards = spark.read.schema(schema).parquet(path)

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, seq, raw in zip(*(batch.column(k).to_pylist() for k in range(3)), strict=True):
                shard = WaveletFile(raw)
                ids = shard.decode().astype("<u4", copy=False)
                sizes = np.abs(shard.lengths)
                ends = np.cumsum(sizes)
                view = memoryview(np.ascontiguousarray(ids)).cast("B")
                starts = ends - sizes
                crcs = [zlib.crc32(view[4 * a : 4 * b]) for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([part] * len(ends), pa.int32()), pa.array([seq] * len(ends), pa.int32()),
                     pa.array(shard.doc_ids, pa.int64(), mask=shard.lengths < 0), pa.array(starts, pa.int64()),
                     pa.array(sizes, pa.int64()), pa.array(crcs, pa.int64())],
                    names=["shard_part", "shard_seq", "doc_id", "local", "n_tokens", "ids_crc32"])

    rows = shards.select("part", "seq", "file").mapInArrow(
        decode, "shard_part int, shard_seq int, doc_id long, local long, n_tokens long, ids_crc32 long")
    sizes = shards.select(F.col("part").alias("shard_part"), F.col("seq").alias("shard_seq"),
                          F.col("n_tokens").alias("held"))
    parts = sizes.groupBy("shard_part").agg(F.sum("held").alias("part_held"))
    earlier = Window.orderBy("shard_part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("shard_part", F.coalesce(F.sum("part_held").over(earlier), F.lit(0)).alias("part_start"))
    inside = Window.partitionBy("shard_part").orderBy("shard_seq").rowsBetween(Window.unboundedPreceding, -1)
    bases = sizes.withColumn("seq_start", F.coalesce(F.sum("held").over(inside), F.lit(0))).join(parts, "shard_part")
    bases = bases.select("shard_part", "shard_seq", (F.col("part_start") + F.col("seq_start")).alias("base"))
    out = rows.join(bases, ["shard_part", "shard_seq"])
    return out.select("doc_id", (F.col("base") + F.col("local")).alias("start"), "n_tokens", "ids_crc32",
                      "shard_part", "shard_seq")


def encode_and_read(docs: DataFrame, tokenizer: str, end_id: int = 0) -> DataFrame:
    """Write all documents to wavelet files in the shared folder and read the digests back from them."""
    spark = docs.sparkSession
    path = work_dir(spark, "wavelet")
    write_shards(docs, path, tokenizer, end_id)
    return read_shards(spark, path)
