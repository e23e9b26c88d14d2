"""Drawing documents that look like a target text collection, by importance of hashed word runs.

1. Words: an untrained ``tokenizers`` split (a regular expression, no vocabulary) over ASCII-lowered text returns word
   offsets. Texts are cut into pieces at separators first, so memory does not grow with a text's number of words.
2. Pairs of offsets make the windows of one to ``LONGEST`` words. The CRC of a window comes from those of its words,
   which are combined for a whole slice of texts at once, since appending bytes is linear in the register.
3. A document's buckets are stored once (two bytes a feature). Counts per bucket of all documents and of all target texts
   are summed in the tasks before they move: at most ``BUCKETS`` rows a task, ``BUCKETS`` numbers in the driver.
4. A bucket's gain is the floored log ratio of its smoothed shares; a document's weight is the sum of its gains.
5. A Gumbel number of the document's id is added, and the highest scores are drawn without replacement. Ranks are running
   numbers over blocks of rows in order, so no task orders all rows.

Nulls and odd input: a null or empty text has no words, weight 0 and can't be drawn (documents need ``min_words``). A null
id counts as an empty one. Rows that repeat an id are documents of their own with the same random number; equal scores are
drawn by smaller id, rows equal in both in any order. Empty tables give no rows, and an empty target gives gains from
smoothing alone. Extra columns are not read, whatever their names; ``resample`` keeps them.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.blocks import running_total
from .tables import free_name, ship, slices, staged, utf8

BUCKETS = 10_000
LONGEST = 3
MIN_WORDS = 20
PERCENT = 5
SEED = 42
#: Rows that are ordered in one task.
ROWS_PER_BLOCK = 100_000
#: Bytes of text handled at once, and longest piece given to the splitter (a longer word is a piece of its own).
SLICE, PIECE = 2 << 20, 1 << 18
#: Words of more bytes are hashed one by one.
_SHORT = 64
_SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


@dataclass(frozen=True)
class Draw:
    """``percent`` of the documents with ``min_words`` words or more are drawn."""

    percent: int = PERCENT
    min_words: int = MIN_WORDS
    seed: int = SEED


# --- words -----------------------------------------------------------------------------------------------------------


@lru_cache(maxsize=1)
def _splitter():
    from tokenizers import Regex, pre_tokenizers

    return pre_tokenizers.Split(Regex(_SEPARATORS), "removed")


@lru_cache(maxsize=1)
def _separator() -> np.ndarray:
    found = np.ones(256, bool)
    found[128:] = False
    found[ord("0") : ord("9") + 1] = False
    found[ord("a") : ord("z") + 1] = False
    return found


def _pieces(text: bytes) -> Iterator[tuple[int, bytes]]:
    """Start and bytes of the pieces of a lowered text; a cut follows a separator."""
    start = 0
    while len(text) - start > PIECE:
        end, width = start + PIECE, PIECE
        while True:
            marks = np.flatnonzero(_separator()[np.frombuffer(text, np.uint8, end - start, start)])
            if len(marks) or end == len(text):
                break
            width *= 2
            end = min(start + width, len(text))
        if not len(marks):
            break
        cut = start + int(marks[-1]) + 1
        yield start, text[start:cut]
        start = cut
    yield start, text[start:]


def word_offsets(text: bytes) -> np.ndarray:
    """Byte offsets (from, to) of the words of an ASCII-lowered text, one row per word."""
    from tokenizers import PreTokenizedString

    found = []
    for start, piece in _pieces(text):
        if not piece:
            continue
        split = PreTokenizedString(piece.decode())
        _splitter().pre_tokenize(split)
        spans = [s[1] for s in split.get_splits(offset_type="byte")]
        if spans:
            found.append(np.array(spans, np.int64) + start)
    return np.concatenate(found) if found else np.zeros((0, 2), np.int64)


# --- checksums of windows --------------------------------------------------------------------------------------------


@lru_cache(maxsize=1)
def _tables() -> tuple[np.ndarray, np.ndarray]:
    """The checksum's table of bytes, and what ``n`` zero bytes do to each byte of a register, for n to ``_SHORT``."""
    byte = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        byte = np.where(byte & 1, np.uint32(0xEDB88320) ^ (byte >> 1), byte >> 1)
    moved = np.empty((_SHORT + 1, 4, 256), np.uint32)
    moved[0] = np.arange(256, dtype=np.uint32)[None, :] << (8 * np.arange(4, dtype=np.uint32))[:, None]
    for n in range(_SHORT):
        moved[n + 1] = byte[moved[n] & 255] ^ (moved[n] >> 8)
    return byte, moved.reshape(-1)


def _appended(crc: np.ndarray, more: np.ndarray | np.uint32, size: np.ndarray | int) -> np.ndarray:
    """Checksums of strings followed by others of checksum ``more`` and at most ``_SHORT`` bytes."""
    _, moved = _tables()
    at = np.asarray(size, np.int64) * 1024
    out = moved[at + (crc & 255)]
    for k in (1, 2, 3):
        out ^= moved[at + 256 * k + ((crc >> (8 * k)) & 255)]
    return out ^ more


def _word_crcs(data: np.ndarray, spans: np.ndarray) -> np.ndarray:
    byte, _ = _tables()
    starts, sizes = spans[:, 0], spans[:, 1] - spans[:, 0]
    order = np.argsort(-np.minimum(sizes, _SHORT + 1), kind="stable")
    first = int(np.searchsorted(-sizes[order], -_SHORT, "left"))
    crc = np.full(len(spans), 0xFFFFFFFF, np.uint32)
    short, left = order[first:], sizes[order[first:]]
    register, at = crc[short], starts[short]
    ends = np.searchsorted(-left, -np.arange(1, _SHORT + 1), "right")  # how many words have a byte number k
    for k in range(int(left[0]) if len(left) else 0):
        n = ends[k]
        register[:n] = byte[(register[:n] ^ data[at[:n] + k]) & 255] ^ (register[:n] >> 8)
    crc[short] = register ^ np.uint32(0xFFFFFFFF)
    for i in order[:first]:
        crc[i] = zlib.crc32(data[spans[i, 0] : spans[i, 1]].tobytes())
    return crc


def window_crcs(data: np.ndarray, spans: np.ndarray, owner: np.ndarray) -> list[np.ndarray]:
    """Checksums of the windows of 1, 2 ... ``LONGEST`` words joined by a space, by their first word, and their owners.

    A window lies within one owner; entry k is (checksums, owners) of the windows of k + 1 words.
    """
    sizes = spans[:, 1] - spans[:, 0]
    words = _word_crcs(data, spans)
    found, runs = [(words, owner)], words
    long = np.flatnonzero(sizes > _SHORT)
    space = np.uint32(zlib.crc32(b" "))
    for k in range(1, LONGEST):
        n = max(0, len(words) - k)
        before = _appended(runs[:n], space, 1)
        runs = _appended(before, words[k:], np.minimum(sizes[k:], _SHORT))
        for i in long[long >= k]:
            runs[i - k] = zlib.crc32(data[spans[i, 0] : spans[i, 1]].tobytes(), int(before[i - k]))
        same = owner[:n] == owner[k:]
        found.append((runs[same], owner[:n][same]))
    return found


def buckets(texts: list[bytes]) -> tuple[list[np.ndarray], np.ndarray]:
    """The buckets of all features of each text (16 bits each) and the texts' numbers of words."""
    lowered = [t.lower() for t in texts]  # of bytes: A to Z alone
    spans = [word_offsets(t) for t in lowered]
    counts = np.array([len(s) for s in spans], np.int64)
    begins = np.cumsum([0, *map(len, lowered)])
    data = np.frombuffer(b"".join(lowered), np.uint8)
    together = np.concatenate([s + b for s, b in zip(spans, begins, strict=False)]) if len(texts) else np.zeros((0, 2), np.int64)
    found = window_crcs(data, together, np.repeat(np.arange(len(texts)), counts))
    value = np.concatenate([(crc % np.uint32(BUCKETS)).astype(np.uint16) for crc, _ in found])
    of = np.concatenate([o for _, o in found])
    value = value[np.argsort(of, kind="stable")]
    return np.split(value, np.cumsum(np.bincount(of, minlength=len(texts)))[:-1]), counts


# --- the corpus ------------------------------------------------------------------------------------------------------


def features(docs: DataFrame) -> DataFrame:
    """doc_id, text_key (a hash of the text), n_words, n_features and buckets (binary) of each row."""
    ship(docs.sparkSession)
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def made(batches):
        import pyarrow as pa

        names = ["doc_id", "text_key", "n_words", "n_features", "buckets"]
        for batch in batches:
            texts = utf8(batch.column(2))
            for a, b in slices(map(len, texts), SLICE):
                parts, counts = buckets(texts[a:b])
                columns = [
                    batch.column(0).slice(a, b - a), batch.column(1).slice(a, b - a), pa.array(counts),
                    pa.array([len(p) for p in parts], pa.int64()), pa.array([p.tobytes() for p in parts], pa.binary()),
                ]
                yield pa.RecordBatch.from_arrays(columns, names)

    schema = f"doc_id {id_type}, text_key bigint, n_words bigint, n_features bigint, buckets binary"
    return docs.select("doc_id", F.xxhash64("text"), "text").mapInArrow(made, schema)


def histogram(found: DataFrame) -> np.ndarray:
    """How many features each bucket has, over all rows of ``features``."""

    def counted(batches):
        import pyarrow as pa

        total = np.zeros(BUCKETS, np.int64)
        for batch in batches:
            for blob in batch.column(0):
                total += np.bincount(np.frombuffer(blob.as_buffer() or b"", np.uint16), minlength=BUCKETS)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], ["bucket", "n"])

    rows = found.select("buckets").mapInArrow(counted, "bucket bigint, n bigint").groupBy("bucket").agg(F.sum("n").alias("n"))
    out = np.zeros(BUCKETS, np.int64)
    for row in rows.collect():  # at most BUCKETS rows
        out[row.bucket] = row.n
    return out


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Gain of each bucket from its counts in the corpus and in the target."""
    total, aimed = float(corpus.sum() + BUCKETS), float(target.sum() + BUCKETS)
    ratio = [float(t + 1) * total / (float(s + 1) * aimed) for s, t in zip(corpus.tolist(), target.tolist(), strict=True)]
    return np.array([math.floor(1000 * math.log(x)) for x in ratio], np.int64)


def weights(found: DataFrame, gain: np.ndarray) -> DataFrame:
    """``found`` (rows of ``features``) with ``weight`` instead of the buckets."""
    names = [c for c in found.columns if c != "buckets"]
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in found.select(*names).schema)

    def weighed(batches):
        import pyarrow as pa

        for batch in batches:
            sums = [int(gain[np.frombuffer(x.as_buffer() or b"", np.uint16)].sum()) for x in batch.column(len(names))]
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(names)], pa.array(sums, pa.int64())], [*names, "weight"])

    return found.select(*names, "buckets").mapInArrow(weighed, f"{schema}, weight bigint")


def noise(seed: int) -> F.Column:
    """A document's Gumbel number, in thousandths, rounded down."""
    key = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(key, 256), 1, 8), 16, 10).cast("bigint")
    return F.floor(-1000 * F.log(-F.log((h + F.lit(0.5)) / F.lit(4294967296.0))))


def scored(docs: DataFrame, target: DataFrame, draw: Draw = Draw()) -> DataFrame:
    """doc_id, text_key, n_words, n_features, weight, score and rank of every document; the undrawn have no rank.

    ``docs`` needs doc_id and text, ``target`` text.
    """
    found = staged(features(docs), "features")
    aimed = features(target.select(F.lit(0).cast("bigint").alias("doc_id"), "text"))
    gain = gains(histogram(found), histogram(aimed))
    rows = weights(found, gain).withColumn("score", F.col("weight") + noise(draw.seed))
    rows = staged(rows.withColumn("behind", -F.col("score")), "scores")
    able = rows.filter(F.col("n_words") >= draw.min_words)
    drawn = draw.percent * able.count() // 100
    ranked = running_total(able, [], ["behind", "doc_id"], running="rank", total="all_ranks", rows_per_block=ROWS_PER_BLOCK)
    ranked = ranked.withColumn("rank", F.when(F.col("rank") <= drawn, F.col("rank"))).drop("all_ranks")
    others = rows.filter(F.col("n_words") < draw.min_words).withColumn("rank", F.lit(None).cast("bigint"))
    return ranked.unionByName(others).drop("behind")


def resample(docs: DataFrame, target: DataFrame, draw: Draw = Draw()) -> DataFrame:
    """The drawn documents with all their columns."""
    drawn = scored(docs, target, draw).filter("rank is not null")
    i, k, name = free_name(docs, "drawn_id"), free_name(docs, "drawn_key"), free_name(docs, "text_key")
    wanted = drawn.select(F.col("doc_id").alias(i), F.col("text_key").alias(k)).distinct()
    rows = docs.withColumn(name, F.xxhash64("text"))
    same = F.col("doc_id").eqNullSafe(F.col(i)) & (F.col(name) == F.col(k))
    return rows.join(wanted, same, "left_semi").select(*docs.columns)


def query(docs: DataFrame, target: DataFrame) -> DataFrame:
    found = scored(docs.select("doc_id", "text"), target.select("text"))
    return found.select("doc_id", "n_features", "weight", "score", "rank", "n_words")
