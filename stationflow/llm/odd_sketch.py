"""Near-duplicates by MinHash bands, verified with odd sketches and confirmed on the full sets.

1. A document is the set of its distinct word shingles. Equal sets are one class, represented by its smallest id, so
   copies cost nothing from here on.
2. ``BANDS`` bands of ``ROWS`` MinHash samples put classes into buckets. All samples of a class are folded into a
   bitmap of ``SKETCH_BITS`` bits in which each sample flips one bit. The population count of the XOR of two bitmaps
   estimates the share of differing samples, most precisely where they are few, so it tells likely from unlikely links.
3. Verification: within each bucket the likely links are found from the bitmaps; a spanning forest of them leaves the
   task. Their components, the candidate groups, contain all links between different sets.
4. Confirmation: each candidate group gets the full sets of its members, each once, and links are confirmed in order
   of their estimate; pairs that are connected already are skipped. A spanning forest of the confirmed links leaves the
   task, and the components of these are the result. So no group yields more links than it has members.

Buckets of more than ``BLOCK_CLASSES`` members and groups of more than ``BLOCK_SETS`` members or ``BLOCK_BYTES`` of sets
are dealt into blocks, and each task compares two blocks; a set of more than half of that has a block of its own.
Comparisons of a group with itself remain quadratic in its number of different sets, without rows for them.

A link at the threshold misses all bands with probability (1 - s^ROWS)^BANDS: 1e-7 at 0.8 and 7e-11 at 0.85; the margin
of the estimate adds about 1e-6.

Texts without words have an empty set, link with nothing and are kept; so do null texts. With fewer words than a
shingle the whole sequence is one shingle. Null ids take no part: component null, kept. Repeated rows with one id share
a component and are kept or left together; ``deduplicate`` keeps one of them. No documents, no rows.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .components import components
from .tables import free_name, ship, slices, staged, utf8
from .words import mix, run_hashes, word_hashes

BANDS, ROWS = 40, 5
SKETCH_BITS = 512
#: A likely link: estimated similarity at most so far below the threshold (about five standard deviations).
MARGIN = 0.15
BLOCK_CLASSES, BLOCK_SETS = 10_000, 1_000
#: Most bytes of the sets of a block, at 8 bytes for each shingle; a task holds two blocks, and some copies of them.
BLOCK_BYTES = 6 << 20
#: Most bytes of a group's sets as bitmaps over the shingles of the group.
_BITMAPS = 16 << 20
_SLICE = 1 << 20


@dataclass(frozen=True)
class Rule:
    """Shingles of ``words`` words; a link has 100 * intersection >= ``percent`` * union."""

    words: int = 5
    percent: int = 80


def shingle_sets(texts: list[bytes], size: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of all texts, text by text, and how many each text has."""
    words, counts = word_hashes(texts, lower=True)
    ends = np.cumsum(counts)
    begins = ends - counts
    owner = np.repeat(np.arange(len(texts)), counts)
    runs = run_hashes(words, size)
    inside = owner[: len(runs)] == owner[size - 1 :][: len(runs)] if len(runs) else np.zeros(0, bool)
    values, owners = [runs[inside]], [owner[: len(runs)][inside]]
    for i in np.flatnonzero((counts > 0) & (counts < size)):
        values.append(run_hashes(words[begins[i] : ends[i]], int(counts[i])))
        owners.append(np.array([i]))
    value, of = np.concatenate(values), np.concatenate(owners)
    order = np.lexsort((value, of))
    value, of = value[order], of[order]
    new = np.ones(len(value), bool)
    new[1:] = (value[1:] != value[:-1]) | (of[1:] != of[:-1])
    return value[new], np.bincount(of[new], minlength=len(texts))


def _samples(values: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """MinHash samples of each set, one row per set."""
    numbers = mix(np.arange(1, 2 * BANDS * ROWS + 1, dtype=np.uint64))
    found = np.empty((len(starts), BANDS * ROWS), np.uint64)
    for i in range(BANDS * ROWS):
        found[:, i] = np.minimum.reduceat(values * (numbers[2 * i] | np.uint64(1)) + numbers[2 * i + 1], starts)
    return found


def _sketches(samples: np.ndarray) -> np.ndarray:
    """Parity bitmaps: each sample, told apart by its number, flips one bit."""
    place = mix(samples + np.arange(samples.shape[1], dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) % np.uint64(SKETCH_BITS)
    bits = np.zeros((len(samples), SKETCH_BITS), np.uint8)
    rows = np.arange(len(samples))
    for i in range(samples.shape[1]):
        bits[rows, place[:, i]] ^= 1
    return np.packbits(bits, axis=1)


def _bands(samples: np.ndarray) -> np.ndarray:
    grouped = samples.reshape(len(samples), BANDS, ROWS)
    total = np.tile(np.arange(1, BANDS + 1, dtype=np.uint64), (len(samples), 1))
    for i in range(ROWS):
        total = total * np.uint64(0x9E3779B97F4A7C15) + grouped[:, :, i]
    return mix(total).view(np.int64)


def most_different(percent: int) -> int:
    """The largest population count of an XOR that still means a likely link."""
    differing = 2 * BANDS * ROWS * (1 - max(0.0, percent / 100 - MARGIN))
    return int(SKETCH_BITS / 2 * (1 - (1 - 2 / SKETCH_BITS) ** differing)) + 1


def signatures(docs: DataFrame, rule: Rule) -> DataFrame:
    """doc_id, n_shingles, k1 and k2 (a 128-bit key of the set), bands and sketch of each document with an id."""
    ship(docs.sparkSession)
    slim = docs.select("doc_id", "text").filter("doc_id is not null")
    id_type = slim.schema["doc_id"].dataType.simpleString()

    def signed(batches):
        import pyarrow as pa
        import xxhash

        names = ["doc_id", "n_shingles", "k1", "k2", "bands", "sketch"]
        for batch in batches:
            texts = utf8(batch.column(1))
            for a, b in slices(map(len, texts), _SLICE):
                values, counts = shingle_sets(texts[a:b], rule.words)
                ends = np.cumsum(counts)
                some = np.flatnonzero(counts)
                keys = np.zeros((b - a, 2), np.int64)
                raw = values.tobytes()
                for i in some:
                    digest = xxhash.xxh3_128_digest(raw[8 * (ends[i] - counts[i]) : 8 * ends[i]])
                    keys[i] = np.frombuffer(digest, np.int64)
                bands, sketch = [None] * (b - a), [None] * (b - a)
                if len(some):
                    samples = _samples(values, (ends - counts)[some])
                    for i, x, y in zip(some, _bands(samples), _sketches(samples), strict=True):
                        bands[i], sketch[i] = x, y.tobytes()
                columns = [
                    batch.column(0).slice(a, b - a), pa.array(counts.astype(np.int64)), pa.array(keys[:, 0].copy()),
                    pa.array(keys[:, 1].copy()), pa.array(bands, pa.list_(pa.int64())), pa.array(sketch, pa.binary()),
                ]
                yield pa.RecordBatch.from_arrays(columns, names)

    schema = f"doc_id {id_type}, n_shingles bigint, k1 bigint, k2 bigint, bands array<bigint>, sketch binary"
    return slim.mapInArrow(signed, schema)


def _sets(docs: DataFrame, rule: Rule) -> DataFrame:
    """id and set (64-bit hashes, ascending) of each document."""
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def made(batches):
        import pyarrow as pa

        for batch in batches:
            texts = utf8(batch.column(1))
            for a, b in slices(map(len, texts), _SLICE):
                values, counts = shingle_sets(texts[a:b], rule.words)
                parts = np.split(values, np.cumsum(counts)[:-1])
                columns = [batch.column(0).slice(a, b - a), pa.array([p.tobytes() for p in parts], pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, ["id", "set"])

    return docs.select("doc_id", "text").mapInArrow(made, f"id {id_type}, set binary")


def _buckets(classes: DataFrame) -> DataFrame:
    """key, id and size of buckets with two classes or more; buckets with the same members count once."""
    rows = classes.select("id", F.explode("bands").alias("key"))
    mark = F.xxhash64("id")
    bucket = rows.groupBy("key").agg(
        F.min("id").alias("low"), F.count("*").alias("size"), F.bit_xor(mark).alias("m1"), F.sum(mark % (1 << 31)).alias("m2")
    )
    same = Window.partitionBy("m1", "m2", "low", "size").orderBy("key")
    several = bucket.filter("size > 1").withColumn("copy", F.row_number().over(same)).filter("copy = 1")
    return rows.join(several.select("key", "size"), "key")


def _in_blocks(members: DataFrame, size: int) -> DataFrame:
    """Deal the members of a group (``size`` of them) into blocks; a member goes to every pair of blocks with its own."""
    own = F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int")
    return (
        members.withColumn("blocks", F.ceil(F.col("size") / size).cast("int"))
        .withColumn("own", own)
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .withColumns({"low": F.least("own", "other"), "high": F.greatest("own", "other")})
        .drop("blocks", "own", "other", "size")
    )


def _placed(members: DataFrame) -> DataFrame:
    """Add the ``block`` of each member of a group; ``members``: group, size, id, n.

    A hash deals a group into parts of about ``BLOCK_SETS`` members, and each part is cut by the running size of its sets:
    a block holds ``BLOCK_BYTES`` at most. A set of more than half of that stands alone.
    """
    half, size = BLOCK_BYTES // 2, 8 * F.col("n")
    part = Window.partitionBy("group", "part", "long").orderBy("id")
    before = F.coalesce(F.sum(size).over(part.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    number = F.when(F.col("long"), F.row_number().over(part)).otherwise(F.floor(before / half))
    return (
        members.withColumns(
            {"part": F.pmod(F.xxhash64("id"), F.ceil(F.col("size") / BLOCK_SETS).cast("bigint")), "long": size > half}
        )
        .withColumn("block", F.concat_ws("-", "part", F.col("long").cast("int"), number))
        .select("group", "id", "n", "block")
    )


def _in_placed_blocks(placed: DataFrame) -> DataFrame:
    """A member goes to every pair of blocks with its own."""
    blocks = placed.select("group", "block").distinct().groupBy("group").agg(F.collect_list("block").alias("others"))
    return (
        placed.join(blocks, "group")
        .withColumn("other", F.explode("others"))
        .withColumns({"low": F.least("block", "other"), "high": F.greatest("block", "other")})
        .select("group", "id", "low", "high")
    )


def _forest(sketch: np.ndarray, counts: np.ndarray, limit: int, percent: int, confirm=None) -> list[tuple[int, int]]:
    """A spanning forest of the likely links, or of those that ``confirm`` accepts; the most similar come first.

    ``confirm`` takes a member and an array of others and says which are linked.
    """
    n = len(sketch)
    root, found = np.arange(n), []
    for i in range(n - 1):
        rest = np.arange(i + 1, n)
        rest = rest[root[rest] != root[i]]
        small, large = np.minimum(counts[rest], counts[i]), np.maximum(counts[rest], counts[i])
        rest = rest[100 * small >= percent * large]
        far = np.bitwise_count(sketch[rest] ^ sketch[i]).sum(1)
        rest = rest[far <= limit]
        if confirm is not None and len(rest):
            rest = rest[confirm(i, rest)]
        for j in rest:
            if root[j] != root[i]:
                found.append((i, int(j)))
                root[root == root[j]] = root[i]
    return found


def _columns(table):
    ids, counts = table.column("id"), np.asarray(table.column("n"))
    sketch = np.frombuffer(b"".join(table.column("sketch").to_pylist()), np.uint64).reshape(len(ids), -1)
    return ids, counts, sketch


def _pairs(ids, found):
    import pyarrow as pa

    left, right = ([p[x] for p in found] for x in (0, 1))
    return pa.table({"a": ids.take(pa.array(left, pa.int64())), "b": ids.take(pa.array(right, pa.int64()))})


def _likely(members: DataFrame, limit: int, percent: int) -> DataFrame:
    """a, b: a spanning forest of the likely links of each bucket; ``members``: key, size, id, n, sketch."""
    id_type = members.schema["id"].dataType.simpleString()

    def forest(table):
        ids, counts, sketch = _columns(table)
        return _pairs(ids, _forest(sketch, counts, limit, percent))

    dealt = _in_blocks(members, BLOCK_CLASSES)
    return dealt.groupBy("key", "low", "high").applyInArrow(forest, f"a {id_type}, b {id_type}").distinct()


def _confirmer(sets: list[np.ndarray], counts: np.ndarray, percent: int):
    """Which of some members link with one, on the full sets."""
    flat = np.concatenate(sets)
    values, place = np.unique(flat, return_inverse=True)
    width = -(-len(values) // 64)
    if len(sets) * width * 8 > _BITMAPS:

        def one_by_one(i, others):
            both = np.array([np.isin(sets[j], sets[i], assume_unique=True).sum() for j in others])
            return 100 * both >= percent * (counts[i] + counts[others] - both)

        return one_by_one
    bits = np.zeros((len(sets), width), np.uint64)
    owner = np.repeat(np.arange(len(sets)), [len(x) for x in sets])
    np.bitwise_or.at(bits, (owner, place // 64), np.uint64(1) << (place % 64).astype(np.uint64))

    def at_once(i, others):
        both = np.concatenate(
            [np.bitwise_count(bits[others[k : k + 256]] & bits[i]).sum(1, dtype=np.int64) for k in range(0, len(others), 256)]
        )
        return 100 * both >= percent * (counts[i] + counts[others] - both)

    return at_once


def _confirmed(members: DataFrame, limit: int, percent: int) -> DataFrame:
    """a, b: a spanning forest of the links of each candidate group; ``members``: group, low, high, id, n, sketch, set."""
    id_type = members.schema["id"].dataType.simpleString()

    def forest(table):
        ids, counts, sketch = _columns(table)
        sets = [np.frombuffer(x, np.uint64) for x in table.column("set").to_pylist()]
        return _pairs(ids, _forest(sketch, counts, limit, percent, _confirmer(sets, counts, percent)))

    return members.groupBy("group", "low", "high").applyInArrow(forest, f"a {id_type}, b {id_type}").distinct()


def link(docs: DataFrame, rule: Rule = Rule()) -> DataFrame:
    """doc_id, n_shingles, component_id and kept of every row of ``docs`` (doc_id and text)."""
    signed = staged(signatures(docs, rule), "signatures")
    has = signed.filter("n_shingles > 0")
    keys = has.groupBy("k1", "k2").agg(F.min("doc_id").alias("id"))
    first = Window.partitionBy("k1", "k2").orderBy("doc_id")
    one_each = has.withColumn("copy", F.row_number().over(first)).filter("copy = 1")
    classes = staged(
        one_each.select(F.col("doc_id").alias("id"), F.col("n_shingles").alias("n"), "bands", "sketch"), "classes"
    )
    sketch = classes.select("id", "n", "sketch")
    limit = most_different(rule.percent)

    likely = staged(_likely(_buckets(classes).join(sketch, "id"), limit, rule.percent), "likely")
    groups = components(likely)
    wanted = groups.select("id")
    texts = docs.filter("doc_id is not null").select("doc_id", "text")
    texts = texts.join(wanted, F.col("doc_id") == F.col("id"), "left_semi")
    sets = _sets(texts, rule).dropDuplicates(["id"])
    sizes = groups.groupBy("component").agg(F.count("*").alias("size"))
    sized = groups.join(sizes, "component").withColumnRenamed("component", "group")
    placed = staged(_placed(sized.join(sketch.select("id", "n"), "id")), "blocks")
    members = _in_placed_blocks(placed).join(sketch.join(sets, "id"), "id")
    links = staged(_confirmed(members, limit, rule.percent), "confirmed")
    found = components(links)

    rows = docs.select("doc_id").filter("doc_id is null")
    nobody = rows.select("doc_id", F.lit(None).cast("bigint").alias("n_shingles"), "doc_id", F.lit(True)).toDF(*_RESULT)
    named = (
        signed.select("doc_id", "n_shingles", "k1", "k2")
        .join(keys, ["k1", "k2"], "left")
        .withColumn("id", F.coalesce("id", "doc_id"))
        .join(found, "id", "left")
        .select("doc_id", "n_shingles", F.coalesce("component", "id").alias("component_id"))
    )
    return named.withColumn("kept", F.col("doc_id") == F.col("component_id")).unionByName(nobody)


_RESULT = ["doc_id", "n_shingles", "component_id", "kept"]


def deduplicate(docs: DataFrame, rule: Rule = Rule()) -> DataFrame:
    """The documents that are kept, with all their columns; of rows that repeat an id, one. Null ids are kept."""
    kept = link(docs, rule).filter("kept").select(F.col("doc_id").alias(free_name(docs, "kept_id"))).distinct()
    name = kept.columns[0]
    same = F.col("doc_id").eqNullSafe(F.col(name))
    with_id = docs.join(kept, same, "left_semi").filter("doc_id is not null").dropDuplicates(["doc_id"])
    return with_id.unionByName(docs.filter("doc_id is null"))


def query(docs: DataFrame) -> DataFrame:
    return link(docs.select("doc_id", "text"), Rule(words=3, percent=85)).select(*_RESULT)
