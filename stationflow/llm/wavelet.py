"""Token ids of a corpus as wavelet matrices, one per shard.

A shard holds whole documents in ascending id order, about ``SHARD_TOKENS`` tokens (one document at least, however
long). Its file is a row of a Parquet table: the ids' bit-planes, most significant first, each stably sorted by the
plane before, with counts of ones every 512 bits, compressed with zstandard in frames of 64 KiB. Opened, it answers what
token stands at a place, how often a token occurs before a place, and where its k-th occurrence is; each of these opens
the counts and at most three frames a plane.

Documents are dealt by ranges of their id, encoded and written in one pass; shards are numbered in order, and start
positions are added from the token totals of the ranges. Spark writes the table, so a lost executor's shards are
written again by another.

A null text is empty: its document is the end token. Null ids come first. Documents with equal ids follow each other in
the order of a hash of their texts. No documents, no shards. Extra columns are dropped.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator
from functools import cached_property

import numpy as np
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .tables import shared_dir, ship, shuffle_partitions, utf8
from .tokens import encoder, vocabulary_path

END_ID = 2
SHARD_TOKENS = 4_000_000
_BLOCK = 512
#: Bytes of a plane that are compressed together.
_FRAME = 1 << 16
#: Ids that decoding puts in place together.
_CHUNK = 1 << 15
_MAGIC = b"WVM2"
_HEAD = struct.Struct("<4sBQQ")


class _Plane:
    """Bits of one plane in frames, each opened when first asked for, and counts of ones before each block."""

    def __init__(self, frames: list[bytes], ones: bytes) -> None:
        self._frames, self._counts = frames, ones
        self._open: dict[int, np.ndarray] = {}

    @cached_property
    def ones(self) -> np.ndarray:
        return np.frombuffer(_opened(self._counts), "<u4")

    def _frame(self, number: int) -> np.ndarray:
        if number not in self._open:
            self._open[number] = np.frombuffer(_opened(self._frames[number]), np.uint8)
        return self._open[number]

    def cut(self, start: int, stop: int) -> np.ndarray:
        """Bytes of one block; blocks do not cross frames."""
        number, at = divmod(start, _FRAME)
        return self._frame(number)[at : at + stop - start]

    def bits(self, n: int) -> np.ndarray:
        """All bits; frames opened for this are not kept."""
        if not n:
            return np.zeros(0, bool)
        packed = np.concatenate([np.frombuffer(_opened(f), np.uint8) for f in self._frames])
        return np.unpackbits(packed, count=n, bitorder="little").view(bool)

    @property
    def opened(self) -> int:
        return len(self._open)


def _opened(frame: bytes) -> bytes:
    import zstandard

    return zstandard.ZstdDecompressor().decompress(frame)


def _partition(ids: np.ndarray) -> Iterator[tuple[np.ndarray, int]]:
    """Bits of each plane and how many are zero; each plane is the one before, zeros first."""
    levels = max(1, int(ids.max()).bit_length()) if len(ids) else 1
    ids = ids.astype(np.uint16 if levels <= 16 else np.uint32)
    other = np.empty_like(ids)
    for level in range(levels - 1, -1, -1):
        bit = (ids & ids.dtype.type(1 << level)) != 0
        zeros = len(ids) - int(np.count_nonzero(bit))
        yield bit, zeros
        np.compress(~bit, ids, out=other[:zeros])
        np.compress(bit, ids, out=other[zeros:])
        ids, other = other, ids


class WaveletMatrix:
    """Bit-planes of a sequence of unsigned integers, with rank and select."""

    def __init__(self, n: int, planes: list[_Plane], zeros: list[int]) -> None:
        self.n, self.planes, self.zeros = n, planes, zeros

    def decode(self) -> np.ndarray:
        """All ids: the planes undone from the last to the first."""
        ids = np.zeros(self.n, np.uint16 if len(self.planes) <= 16 else np.uint32)
        for level in reversed(range(len(self.planes))):
            bit, z = self.planes[level].bits(self.n), self.zeros[level]
            ids[z:] |= ids.dtype.type(1 << (len(self.planes) - 1 - level))
            before, zero, one = np.empty_like(ids), 0, z
            for at in range(0, self.n, _CHUNK):  # parts that stay in the cache
                held, out = bit[at : at + _CHUNK], before[at : at + _CHUNK]
                zeros, ones = np.flatnonzero(~held), np.flatnonzero(held)
                out[zeros], out[ones] = ids[zero : zero + len(zeros)], ids[one : one + len(ones)]
                zero, one = zero + len(zeros), one + len(ones)
            ids = before
        return ids.astype(np.uint32)

    def _rank1(self, level: int, i: int) -> int:
        block, rest = divmod(i, _BLOCK)
        count = int(self.planes[level].ones[block])
        if rest:
            start = block * (_BLOCK // 8)
            held = self.planes[level].cut(start, start + _BLOCK // 8)
            count += int(np.bitwise_count(held[: rest // 8]).sum())
            if rest % 8:
                count += (int(held[rest // 8]) & ((1 << rest % 8) - 1)).bit_count()
        return count

    def access(self, i: int) -> int:
        """The id at place ``i``."""
        value = 0
        for level, plane in enumerate(self.planes):
            ones = self._rank1(level, i)
            bit = int(plane.cut(i // 8, i // 8 + 1)[0]) >> i % 8 & 1
            i = self.zeros[level] + ones if bit else i - ones
            value = value << 1 | bit
        return value

    def _range(self, symbol: int, end: int) -> tuple[int, int]:
        start = 0
        if symbol >> len(self.planes):
            return 0, 0
        for level in range(len(self.planes)):
            before, upto = self._rank1(level, start), self._rank1(level, end)
            if symbol >> (len(self.planes) - 1 - level) & 1:
                start, end = self.zeros[level] + before, self.zeros[level] + upto
            else:
                start, end = start - before, end - upto
        return start, end

    def rank(self, symbol: int, end: int) -> int:
        """How often ``symbol`` occurs before place ``end``."""
        start, stop = self._range(symbol, end)
        return stop - start

    def count(self, symbol: int) -> int:
        return self.rank(symbol, self.n)

    def _select_bit(self, level: int, bit: bool, k: int) -> int:
        ones = self.planes[level].ones.astype(np.int64)
        counts = ones if bit else np.arange(len(ones)) * _BLOCK - ones
        block = int(np.searchsorted(counts, k, "right")) - 1
        start = block * (_BLOCK // 8)
        bits = np.unpackbits(self.planes[level].cut(start, start + _BLOCK // 8), bitorder="little") == bit
        return block * _BLOCK + int(np.flatnonzero(bits)[k - int(counts[block])])

    def select(self, symbol: int, k: int) -> int:
        """Place of the ``k``-th occurrence (from 0) of ``symbol``."""
        start, stop = self._range(symbol, self.n)
        if not 0 <= k < stop - start:
            raise IndexError(f"{symbol} occurs {stop - start} times")
        at = start + k
        for level in reversed(range(len(self.planes))):
            bit = symbol >> (len(self.planes) - 1 - level) & 1
            at = self._select_bit(level, bool(bit), at - self.zeros[level] if bit else at)
        return at

    def occurrences(self, symbol: int) -> list[int]:
        return [self.select(symbol, k) for k in range(self.count(symbol))]


def to_bytes(ids: np.ndarray, lengths: np.ndarray) -> bytes:
    """A shard's file: ids, and how many of them each document has.

    A head and the sizes of all frames come first, then the frames, each compressed by itself: the documents' lengths,
    and per plane its counts and its bits.
    """
    import zstandard

    compress = zstandard.ZstdCompressor(level=1, write_checksum=True).compress
    frames, zeros = [compress(lengths.astype("<u8").tobytes())], []
    blocks = -(-len(ids) // _BLOCK)
    for bit, none in _partition(ids):
        plane = np.zeros(blocks * (_BLOCK // 8), np.uint8)
        packed = np.packbits(bit, bitorder="little")
        plane[: len(packed)] = packed
        counts = np.bitwise_count(plane.view(np.uint64)).reshape(-1, _BLOCK // 64).sum(1, dtype=np.uint32)
        frames.append(compress(np.concatenate([[0], np.cumsum(counts)]).astype("<u4").tobytes()))
        frames += [compress(plane[at : at + _FRAME].tobytes()) for at in range(0, len(plane), _FRAME)]
        zeros.append(none)
    head = _HEAD.pack(_MAGIC, len(zeros), len(ids), len(lengths))
    sizes = np.array([len(f) for f in frames], "<u8").tobytes()
    return b"".join([head, np.array(zeros, "<u8").tobytes(), sizes, *frames])


def from_bytes(data: bytes) -> tuple[WaveletMatrix, np.ndarray]:
    """The matrix of a shard's file and the lengths of its documents; bits stay compressed until they are asked for."""
    magic, levels, n, n_docs = _HEAD.unpack_from(data)
    if magic != _MAGIC:
        raise ValueError("not a wavelet shard")
    zeros = np.frombuffer(data, "<u8", levels, _HEAD.size)
    per_plane = 1 + -(-(-(-n // _BLOCK) * (_BLOCK // 8)) // _FRAME)
    at = _HEAD.size + zeros.nbytes
    sizes = np.frombuffer(data, "<u8", 1 + levels * per_plane, at)
    ends = at + sizes.nbytes + np.cumsum(sizes.astype(np.int64))
    frames = [data[end - size : end] for end, size in zip(ends.tolist(), sizes.tolist(), strict=True)]
    planes = []
    for level in range(levels):
        counts, *bits = frames[1 + level * per_plane : 1 + (level + 1) * per_plane]
        planes.append(_Plane(bits, counts))
    lengths = np.frombuffer(_opened(frames[0]), "<u8", n_docs)
    return WaveletMatrix(n, planes, [int(z) for z in zeros]), lengths


def write_shards(
    docs: DataFrame,
    path: str,
    tokenizer: str | None = None,
    end_id: int = END_ID,
    shard_tokens: int = SHARD_TOKENS,
    ranges: int | None = None,
) -> None:
    """Write the table of shards to ``path``, a folder that all executors reach.

    Columns: part and shard (order of the shards), start (tokens of the part before it), n_docs, n_tokens, doc_ids and
    file.
    """
    spark = docs.sparkSession
    ship(spark)
    tokenizer = tokenizer or vocabulary_path()
    slim = docs.select("doc_id", "text").withColumn("tie", F.xxhash64("text"))
    dealt = slim.repartitionByRange(ranges or shuffle_partitions(spark), "doc_id", "tie").sortWithinPartitions("doc_id", "tie")
    id_type = slim.schema["doc_id"].dataType.simpleString()

    def encoded(batches) -> Iterator:
        import pyarrow as pa
        from pyspark import TaskContext

        encode, end = encoder(tokenizer).encode, end_id.to_bytes(4, "little")
        part, shard, start = TaskContext.get().partitionId(), 0, 0
        names, texts, held = [], [], 0

        def made():
            lengths = np.array([len(t) // 4 for t in texts], np.int64)
            ids = np.frombuffer(b"".join(texts), "<u4")
            numbers = [pa.array([x], pa.int64()) for x in (part, shard, start, len(texts), len(ids))]
            listed = pa.ListArray.from_arrays([0, len(texts)], pa.concat_arrays(names))
            file = pa.array([to_bytes(ids, lengths)], pa.binary())
            columns = ["part", "shard", "start", "n_docs", "n_tokens", "doc_ids", "file"]
            return pa.RecordBatch.from_arrays([*numbers, listed, file], columns)

        for batch in batches:
            for row, text in enumerate(utf8(batch.column(1))):
                texts.append(encode(text) + end)
                names.append(batch.column(0).slice(row, 1))
                held += len(texts[-1]) // 4
                if held >= shard_tokens:
                    yield made()
                    shard, start = shard + 1, start + held
                    names, texts, held = [], [], 0
        if texts:
            yield made()

    schema = (
        "part bigint, shard bigint, start bigint, n_docs bigint, n_tokens bigint, "
        f"doc_ids array<{id_type}>, file binary"
    )
    # The files are compressed already.
    dealt.mapInArrow(encoded, schema).write.option("compression", "none").parquet(path)


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start (tokens of all documents before), n_tokens and ids of each document, decoded from the shards."""
    ship(spark)
    shards = spark.read.parquet(path)
    id_type = shards.schema["doc_ids"].dataType.elementType.simpleString()

    def decoded(batches) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            for row in range(batch.num_rows):
                matrix, lengths = from_bytes(batch.column("file")[row].as_py())
                ids = matrix.decode().astype("<u4")
                ends = np.cumsum(lengths.astype(np.int64))
                doc_ids = batch.column("doc_ids")[row].values
                for a in range(0, len(ends), 2000):
                    b = min(a + 2000, len(ends))
                    first = int(ends[a - 1]) if a else 0
                    offsets = np.concatenate([[first], ends[a:b]])
                    chunk = ids[first : int(ends[b - 1])].tobytes()
                    cuts = pa.py_buffer(((offsets - first) * 4).astype(np.int32).tobytes())
                    binary = pa.Array.from_buffers(pa.binary(), b - a, [None, cuts, pa.py_buffer(chunk)])
                    begin = batch.column("start")[row].as_py() + offsets[:-1]
                    part = pa.array(np.full(b - a, batch.column("part")[row].as_py()), pa.int64())
                    columns = [part, doc_ids.slice(a, b - a), pa.array(begin), pa.array(np.diff(offsets)), binary]
                    yield pa.RecordBatch.from_arrays(columns, ["part", "doc_id", "begin", "n_tokens", "ids"])

    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    # One row per range of ids, so its size is bounded by the number of ranges.
    bases = (
        shards.groupBy("part")
        .agg(F.sum("n_tokens").alias("tokens"))
        .select("part", F.coalesce(F.sum("tokens").over(before), F.lit(0)).alias("base"))
    )
    schema = f"part bigint, doc_id {id_type}, begin bigint, n_tokens bigint, ids binary"
    return (
        shards.select("part", "start", "doc_ids", "file")
        .mapInArrow(decoded, schema)
        .join(F.broadcast(bases), "part")
        .select("doc_id", (F.col("base") + F.col("begin")).alias("start"), "n_tokens", "ids")
    )


def query(docs: DataFrame, tokenizer: str | None = None) -> DataFrame:
    """Write all documents, read them back, and give a digest in place of the ids."""
    path = shared_dir(docs.sparkSession, "wavelet")
    write_shards(docs, path, tokenizer)
    found = read_documents(docs.sparkSession, path)
    return found.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))
