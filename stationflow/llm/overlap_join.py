"""Similarity self-join on word shingles by T-occurrence search (DivideSkip) over inverted lists.

A document is the set of its distinct word shingles; equal sets are one class, so copies cost nothing beyond their hashes.
Two sets link when 100 * intersection >= percent * union, so the smaller-or-equal partner of a set of n shingles occurs in
at least T = ceil(percent * n / 100) of its inverted lists, and every one of these lists has two members or more.

1. ``signatures``: size and 128-bit key of each document's set, and the shingles that are frequent within a task. At most
   ``LONG_LISTS`` of them, the most frequent of the corpus, are the *long lists*: known to every task, never shuffled.
2. ``occurrences``: all other shingles move once, packed by hash buckets, so a bucket holds whole inverted lists. It
   returns, per class and length, how many of its shingles lie in lists of that length, and one vertex per list.
3. A class with fewer than T shingles in lists of two or more has no partner. For the others, lists are ordered by length
   with the long ones last; two linked sets share a list among the first n - T + 1 of each. Classes are joined to the
   vertices of these lists only, so a list of m members gives m edges, and the connected components hold all links.
4. ``search``: each component gets its members' texts, each once. For one set after the other the T-occurrence problem
   is solved over the lists of the smaller sets: the L longest lists are put aside, the short ones merged by a heap
   (MergeSkip), members that occur T - L times are looked up in the long ones by binary search, and the exact
   overlap decides. Members that are connected already are passed over; a spanning forest leaves the task.
5. A component of more than ``GROUP_BYTES`` of sets is dealt into parts, each searched together with the same ``PIVOTS``
   members of the component. That connects the usual large group, many versions of one text, in linear work. Only if it
   leaves several pieces, pairs of parts are searched as well, so no link is lost.

A bucket also names each set that has shingles in it (16 bytes), so what moves grows from 6 bytes a shingle towards 22
where the corpus needs more buckets than a set has shingles.

The driver gets the long lists, the filter of step 4 (a bitmap of fixed size) and tables of at most ``BROADCAST_BYTES``,
at any size of the corpus; all other joins move their rows between tasks. The result is stored.

Nothing is capped: frequent shingles beyond ``LONG_LISTS`` are ordinary lists, which changes the plan but not the result.
Lists that are no long lists have at most about 0.2 % of all sets as members, as frequent ones are seen within tasks.

Nulls and odd input: null and empty texts and texts without words have an empty set and link with nothing. Texts with
fewer words than a shingle are one shingle, their whole sequence. ``doc_id`` must be an integer; rows that repeat an id are
one vertex with several sets (linked with what any of them links with), each with a size of its own. Rows with a null id
get a size and no component. Very long texts are hashed whole, in pieces. Empty tables give no rows. Extra columns are not read.
"""

from __future__ import annotations

import heapq
from bisect import bisect_left
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .components import components
from .tables import ship, slices, small_broadcasts, staged, utf8
from .words import mix, run_hashes, word_hashes

#: Lists that every task knows (24 bytes each), and what makes one: so many sets of a task, and that share of all sets.
LONG_LISTS, LONG_IN_TASK, LONG_SHARE = 200_000, 8, 1 / 2000
#: Bytes of text hashed at once, and bytes of text whose lists are counted or packed together.
SLICE, TOGETHER = 1 << 20, 8 << 20
#: Most bytes of moved hashes in a bucket, and least buckets, so that the lists spread over a cluster.
BUCKET_BYTES, MIN_BUCKETS = 10 << 20, 64
GROUP_BYTES, PIVOTS = 8 << 20, 8
#: Bits of the filter in front of the join that fetches the candidates' texts.
FILTER_BITS = 1 << 24
#: Weight of the search in long lists against merging.
MU = 0.5
#: Elements of short lists merged by a heap; more are counted in one pass over an array, with the same result.
HEAP = 4096
#: Bytes of a hash that move: lists may then hold a chance member, which the search finds out.
_MOVED = 6
_LONG = 1 << 40


@dataclass(frozen=True)
class Rule:
    """Shingles of ``words`` words; a link has 100 * intersection >= ``percent`` * union."""

    words: int = 5
    percent: int = 80

    def needed(self, n):
        """Shingles that a set of ``n`` shares with any partner."""
        return -(-self.percent * n // 100)


def shingle_sets(texts: list[bytes], size: int) -> list[np.ndarray]:
    """Ascending distinct shingle hashes of each text."""
    hashes, counts = word_hashes(texts, lower=True)
    ends = np.cumsum(counts)
    found = []
    for end, n in zip(ends.tolist(), counts.tolist(), strict=True):
        words = hashes[end - n : end]
        found.append(np.unique(run_hashes(words, min(size, n))) if n else np.zeros(0, np.uint64))
    return found


def set_key(values: np.ndarray) -> tuple[int, int]:
    import xxhash

    return tuple(np.frombuffer(xxhash.xxh3_128_digest(values.tobytes()), np.int64).tolist())


def _gathered(batches, text_at: int) -> Iterator[tuple[list[bytes], list]]:
    """Texts and (batch, row) places, about ``TOGETHER`` bytes at a time."""
    texts, places, size = [], [], 0
    for batch in batches:
        found = utf8(batch.column(text_at))
        for a, b in slices(map(len, found), TOGETHER):
            more = sum(map(len, found[a:b]))
            if texts and size + more > TOGETHER:
                yield texts, places
                texts, places, size = [], [], 0
            texts += found[a:b]
            places.append(batch.slice(a, b - a))
            size += more
    if texts:
        yield texts, places


def _distinct_sets(texts: list[bytes], words: int) -> tuple[list[np.ndarray], list[tuple[int, int] | None]]:
    """Set and key of each text; the key of an empty set is None."""
    sets = []
    for a, b in slices(map(len, texts), SLICE):
        sets += shingle_sets(texts[a:b], words)
    return sets, [set_key(s) if len(s) else None for s in sets]


# --- lists of the corpus ---------------------------------------------------------------------------------------------


def signatures(docs: DataFrame, rule: Rule) -> DataFrame:
    """Rows of documents (doc_id, n, k1, k2) and of shingles frequent within a task (hash, sets); the others are null."""
    ship(docs.sparkSession)

    def signed(batches):
        import pyarrow as pa

        names = ["doc_id", "n", "k1", "k2", "hash", "sets"]
        types = [pa.int64()] * 6
        for texts, places in _gathered(batches, 1):
            sets, keys = _distinct_sets(texts, rule.words)
            ids = [x for p in places for x in p.column(0).to_pylist()]
            columns = [ids, [len(s) for s in sets], [k and k[0] for k in keys], [k and k[1] for k in keys]]
            none = [None] * len(ids)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip([*columns, none, none], types, strict=True)], names)
            one_each = list({k: s for k, s in zip(keys, sets, strict=True) if k}.values())
            if one_each:
                value, times = np.unique(np.concatenate(one_each), return_counts=True)
                often = times >= LONG_IN_TASK
                found = [pa.array(value[often].view(np.int64)), pa.array(times[often].astype(np.int64))]
                yield pa.RecordBatch.from_arrays([pa.nulls(int(often.sum()), pa.int64())] * 4 + found, names)

    schema = "doc_id bigint, n bigint, k1 bigint, k2 bigint, hash bigint, sets bigint"
    return docs.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(signed, schema)


def long_lists(signed: DataFrame, sets: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes (ascending) and lengths of the long lists; at most ``LONG_LISTS``."""
    found = (
        signed.filter("hash is not null")
        .groupBy("hash")
        .agg(F.sum("sets").alias("sets"))
        .filter(F.col("sets") >= LONG_SHARE * sets)
        .orderBy(F.desc("sets"), "hash")
        .limit(LONG_LISTS)
        .toArrow()
    )
    value = np.asarray(found.column("hash").combine_chunks()).view(np.uint64) if len(found) else np.zeros(0, np.uint64)
    length = np.asarray(found.column("sets").combine_chunks()) if len(found) else np.zeros(0, np.int64)
    order = np.argsort(value)
    return value[order], length[order]


def _packed(docs: DataFrame, rule: Rule, long: tuple[np.ndarray, np.ndarray], buckets: int) -> DataFrame:
    """bucket; nodes (keys of sets), counts (size, shingles here) and the shingles; what is known of long lists."""
    value, length = docs.sparkSession.sparkContext.broadcast(long[0]), docs.sparkSession.sparkContext.broadcast(long[1])

    def packed(batches):
        import pyarrow as pa

        for texts, _ in _gathered(batches, 0):
            sets, keys = _distinct_sets(texts, rule.words)
            kept = {k: s for k, s in zip(keys, sets, strict=True) if k}
            if not kept:
                continue
            node = np.array([k[0] for k in kept], np.int64)
            sizes = np.array([len(s) for s in kept.values()], np.int64)
            flat, of = np.concatenate(list(kept.values())), np.repeat(np.arange(len(node)), sizes)
            place = np.minimum(np.searchsorted(value.value, flat), max(0, len(value.value) - 1))
            is_long = value.value[place] == flat if len(value.value) else np.zeros(len(flat), bool)
            # A long list stands behind all others in order of length; its place is its vertex.
            at_long = place[is_long]
            known = np.column_stack([node[of[is_long]], sizes[of[is_long]], _LONG + length.value[at_long], at_long])
            flat, of = flat[~is_long], of[~is_long].astype(np.int32)
            bucket = (mix(flat) % np.uint64(buckets)).astype(np.int32)
            order = np.argsort(bucket, kind="stable")
            flat, of = flat[order], of[order]
            at = np.concatenate([[0], np.cumsum(np.bincount(bucket, minlength=buckets))])
            known_bucket = known[:, 0] % buckets
            rows = []
            for b in np.union1d(np.flatnonzero(np.diff(at)), known_bucket).tolist():
                here, own = flat[at[b] : at[b + 1]], of[at[b] : at[b + 1]]
                some, times = np.unique(own, return_counts=True)
                counts = np.column_stack([sizes[some], times]).astype(np.int32)
                moved = here.astype(">u8").view(np.uint8).reshape(-1, 8)[:, 8 - _MOVED :]
                rows.append((b, node[some].tobytes(), counts.tobytes(), moved.tobytes(), known[known_bucket == b].tobytes()))
            types = [pa.int32(), *[pa.binary()] * 4]
            columns = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)]
            yield pa.RecordBatch.from_arrays(columns, ["bucket", "nodes", "counts", "shingles", "known"])

    schema = "bucket int, nodes binary, counts binary, shingles binary, known binary"
    return docs.select("text").mapInArrow(packed, schema)


def _summed(rows: np.ndarray) -> np.ndarray:
    """Distinct rows and how often each occurs, as a further column."""
    if not len(rows):
        return np.zeros((0, rows.shape[1] + 1), np.int64)
    rows = rows[np.lexsort(rows.T[::-1])]
    first = np.flatnonzero(np.concatenate([[True], (rows[1:] != rows[:-1]).any(1)]))
    return np.column_stack([rows[first], np.diff(np.append(first, len(rows)))])


def occurrences(packed: DataFrame) -> DataFrame:
    """node, n, length, vertex and shingles: how many shingles of a class lie in lists of a length and vertex."""

    def of_lists(table):
        import pyarrow as pa

        def joined(column, kind, width):
            return np.frombuffer(b"".join(table.column(column).to_pylist()), kind).reshape(-1, width)

        node, counts, known = joined("nodes", np.int64, 1)[:, 0], joined("counts", np.int32, 2), joined("known", np.int64, 4)
        value = np.zeros((int(counts[:, 1].sum()), 8), np.uint8)
        value[:, 8 - _MOVED :] = joined("shingles", np.uint8, _MOVED)
        value = value.view(">u8")[:, 0].astype(np.uint64)
        about = np.repeat(np.arange(len(node), dtype=np.int32), counts[:, 1])
        once = np.zeros(len(node), bool)  # of sets that were packed apart, one
        once[np.unique(node, return_index=True)[1]] = True
        if not once.all():
            kept = once[about]
            value, about = value[kept], about[kept]
        order = np.argsort(value, kind="stable")
        value, about = value[order], about[order]
        new_list = np.ones(len(value), bool)
        new_list[1:] = value[1:] != value[:-1]
        single = new_list & np.append(new_list[1:], True)
        about, new_list = about[~single], new_list[~single]
        starts = np.flatnonzero(new_list)
        owner, lengths = node[about], np.diff(np.append(starts, len(about)))
        least = np.minimum.reduceat(owner, starts) if len(starts) else owner
        rows = np.column_stack([owner, counts[about, 0], np.repeat(lengths, lengths), np.repeat(least, lengths)])
        copies = known[np.lexsort(known.T[::-1])] if len(known) else known
        different = np.concatenate([[True], (copies[1:] != copies[:-1]).any(1)]) if len(copies) else np.zeros(0, bool)
        out = np.concatenate([_summed(rows), _summed(copies[different])])
        names = ["node", "n", "length", "vertex", "shingles"]
        types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int32()]
        return pa.table([pa.array(np.ascontiguousarray(out[:, i]), t) for i, t in enumerate(types)], names=names)

    schema = "node bigint, n int, length bigint, vertex bigint, shingles int"
    return packed.groupBy("bucket").applyInArrow(of_lists, schema)


def candidate_edges(found: DataFrame, rule: Rule) -> DataFrame:
    """a (class) and b (vertex of a list): lists among the first n - T + 1 of a class that may have a partner."""
    whole = Window.partitionBy("node")
    shorter = whole.orderBy("length").rangeBetween(Window.unboundedPreceding, -1)
    needed = F.expr(f"({rule.percent} * n + 99) div 100")
    return (
        found.withColumns(
            {
                "shared": F.sum("shingles").over(whole),
                "before": F.coalesce(F.sum("shingles").over(shorter), F.lit(0)),
                "needed": needed,
            }
        )
        # Lists of one member come first of all: n - shared of them.
        .filter("shared >= needed and n - shared + before < n - needed + 1")
        .select(F.col("node").alias("a"), F.col("vertex").alias("b"))
        .distinct()
    )


# --- the search ------------------------------------------------------------------------------------------------------


def merge_skip(lists: list[list[int]], needed: int) -> Iterator[tuple[int, int]]:
    """Values that occur in at least ``needed`` of the ascending lists, with the number of their lists."""
    heap = [(x[0], i, 0) for i, x in enumerate(lists) if x]
    heapq.heapify(heap)
    while len(heap) >= needed:
        value, popped = heap[0][0], []
        while heap and heap[0][0] == value:
            popped.append(heapq.heappop(heap))
        if len(popped) >= needed:
            yield value, len(popped)
            target = value + 1
        else:  # no value below the next head can still be in enough lists
            while heap and len(popped) < needed - 1:
                popped.append(heapq.heappop(heap))
            if not heap:
                return
            target = heap[0][0]
        for _, i, at in popped:
            at = bisect_left(lists[i], target, at)
            if at < len(lists[i]):
                heapq.heappush(heap, (lists[i][at], i, at))


class Lists:
    """Inverted lists of some sets, in ascending order of size."""

    def __init__(self, sets: list[np.ndarray], percent: int):
        self.percent = percent
        self.sizes = np.array([len(s) for s in sets], np.int64)
        value, owner = np.concatenate(sets), np.repeat(np.arange(len(sets)), self.sizes)
        order = np.argsort(value, kind="stable")
        value, self.member = value[order], owner[order]
        new = np.ones(len(value), bool)
        new[1:] = value[1:] != value[:-1]
        number = np.cumsum(new) - 1
        self.start = np.flatnonzero(new)[number]
        self.key = number << 32 | self.member
        self.places = np.argsort(self.member, kind="stable")
        self.begin = np.concatenate([[0], np.cumsum(self.sizes)])

    def partners(self, i: int, root: np.ndarray) -> Iterator[int]:
        """Members before ``i`` that link with it and do not share its root (which may change in between)."""
        n = int(self.sizes[i])
        needed = -(-self.percent * n // 100)
        low = int(np.searchsorted(self.sizes, needed))  # smaller sets can't link
        if low >= i:
            return
        at = self.places[self.begin[i] : self.begin[i + 1]]
        at = at[at > self.start[at]]
        if len(at) < needed:
            return
        length = at - self.start[at]
        aside = min(needed - 1, int(needed / (MU * np.log2(length.max() + 1) + 1)))
        by_length = np.argsort(length, kind="stable")
        short, long = by_length[: len(at) - aside], at[by_length[len(at) - aside :]]
        found, ends = _ranges(self.start[at[short]], length[short])
        found = self.member[found]
        wanted = (found >= low) & (root[found] != root[i])
        most = needed - aside
        if not wanted.any():
            return
        if wanted.sum() <= HEAP:
            kept = np.concatenate([[0], np.cumsum(wanted)])[np.concatenate([[0], ends])]
            values = found[wanted].tolist()
            candidates = list(merge_skip([values[a:b] for a, b in zip(kept[:-1], kept[1:], strict=True)], most))
            member, times = np.array(candidates, np.int64).reshape(-1, 2).T
        else:
            times = np.bincount(found[wanted])
            member = np.flatnonzero(times >= most)
            times = times[member]
        step = max(1, (1 << 18) // max(1, len(long)))
        for a in range(0, len(member), step):
            some = member[a : a + step]
            overlap = times[a : a + step] + self._in_lists(some, long)
            for j in some[100 * overlap >= self.percent * (n + self.sizes[some] - overlap)].tolist():
                if root[j] != root[i]:
                    yield j

    def _in_lists(self, members: np.ndarray, at: np.ndarray) -> np.ndarray:
        """In how many of the lists through the places ``at`` each member is, by binary search."""
        if not len(at):
            return np.zeros(len(members), np.int64)
        key = ((self.key[at] >> 32) << 32)[None, :] | members[:, None]
        place = np.minimum(np.searchsorted(self.key, key), len(self.key) - 1)
        return (self.key[place] == key).sum(1)


def _ranges(starts: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All places of the ranges one after the other, and where each range ends among them."""
    ends = np.cumsum(lengths)
    return np.arange(int(ends[-1]) if len(ends) else 0) + np.repeat(starts - (ends - lengths), lengths), ends


def forest(sets: list[np.ndarray], percent: int, labels: np.ndarray | None = None) -> list[tuple[int, int]]:
    """Links that connect all linked sets, at most one less than there are sets; equal ``labels`` are connected already."""
    order = np.argsort([len(s) for s in sets], kind="stable")
    lists = Lists([sets[k] for k in order], percent)
    root = np.arange(len(sets)) if labels is None else np.unique(labels[order], return_inverse=True)[1]
    found = []
    for i in range(1, len(sets)):
        for j in lists.partners(i, root):
            found.append((int(order[i]), int(order[j])))
            root[root == root[j]] = root[i]
    return found


def _searched(members: DataFrame, rule: Rule, keys: list[str]) -> DataFrame:
    """a, b: connecting links of each group; ``members``: the keys, low, k1, k2, text and perhaps label."""
    labelled = "label" in members.columns

    def search(table):
        import pyarrow as pa

        texts, low = utf8(table.column("text").combine_chunks()), table.column("low").to_pylist()
        wanted = list(zip(table.column("k1").to_pylist(), table.column("k2").to_pylist(), strict=True))
        sets, keys = _distinct_sets(texts, rule.words)
        # Rows that repeat an id bring texts of other classes, or the same again.
        one_each = {k: i for i, k in enumerate(keys) if k == wanted[i]}
        chosen = list(one_each.values())
        labels = np.asarray(table.column("label"))[chosen] if labelled else None
        links = forest([sets[i] for i in chosen], rule.percent, labels) if len(chosen) > 1 else []
        a, b = ([low[chosen[p[x]]] for p in links] for x in (0, 1))
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return members.groupBy(*keys).applyInArrow(search, "a bigint, b bigint")


# --- the join --------------------------------------------------------------------------------------------------------


def _likely_texts(docs: DataFrame, rows: DataFrame) -> DataFrame:
    """low and text of all documents that ``rows`` names in ``low``, and of a few others: what is worth moving.

    A bitmap over hashes of the wanted ids, in words of 64 bits, is broadcast: ``FILTER_BITS`` bits, so at most
    ``FILTER_BITS`` / 64 rows, at any size of the corpus. Where it is nearly full it lets nearly all pass.
    """
    texts = docs.select(F.col("doc_id").cast("bigint").alias("low"), "text").filter("low is not null")

    def placed(df: DataFrame) -> DataFrame:
        slot = F.pmod(F.xxhash64("low"), F.lit(FILTER_BITS))
        bit = F.expr("shiftleft(1L, cast(slot & 63 as int))")
        return df.withColumn("slot", slot).withColumns({"word": F.shiftright("slot", 6), "bit": bit})

    bits = placed(rows.select("low")).groupBy("word").agg(F.bit_or("bit").alias("bits"))
    return placed(texts).join(F.broadcast(bits), "word").filter("bits & bit <> 0").select("low", "text")


def _links(docs: DataFrame, classes: DataFrame, edges: DataFrame, rule: Rule) -> DataFrame:
    """a, b (doc_ids of classes): links that connect all linked classes."""
    grouped = components(edges).withColumnRenamed("component", "group")
    able = edges.select(F.col("a").alias("id")).distinct()
    members = grouped.join(able, "id", "left_semi").withColumnRenamed("id", "k1").join(classes, "k1")
    members = staged(members, "members")
    parts = F.ceil(F.col("bytes") / GROUP_BYTES).cast("int")
    groups = members.groupBy("group").agg(F.count("*").alias("size"), F.sum(8 * F.col("n")).alias("bytes"))
    sized = members.join(groups.filter("size > 1").select("group", parts.alias("parts")), "group")
    part = F.pmod(F.xxhash64("low"), F.col("parts")).cast("int")
    dealt = staged(sized.select("group", "low", "k1", "k2", "parts", part.alias("part")), "parts")
    by_hash = Window.partitionBy("group").orderBy(F.xxhash64("k1", "k2"), "k1", "k2")
    pivots = dealt.filter("parts > 1").withColumn("place", F.row_number().over(by_hash)).filter(F.col("place") <= PIVOTS)
    everywhere = pivots.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).filter("other <> part")
    columns = ["group", "low", "k1", "k2"]
    asked = dealt.select(*columns, "part").unionByName(everywhere.select(*columns, F.col("other").alias("part")))

    def with_text(rows: DataFrame) -> DataFrame:
        return rows.join(_likely_texts(docs, rows), "low")

    links = staged(_searched(with_text(asked), rule, ["group", "part"]), "links")
    large = dealt.filter("parts > 1")
    if not large.limit(1).count():
        return links
    # What is still in several pieces: pairs of parts, with the pieces known so far.
    pieces = components(links).toDF("low", "label")
    pieces = large.join(pieces, "low", "left").withColumn("label", F.coalesce("label", "low"))
    pieces = staged(pieces, "pieces")
    open_groups = pieces.groupBy("group").agg(F.min("label").alias("x"), F.max("label").alias("y")).filter("x <> y")
    rest = pieces.join(open_groups.select("group"), "group", "left_semi")
    pairs = (
        rest.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
        .filter("other <> part")
        .withColumns({"first": F.least("part", "other"), "second": F.greatest("part", "other")})
        .select(*columns, "label", "first", "second")
    )
    more = staged(_searched(with_text(pairs), rule, ["group", "first", "second"]), "links")
    return links.unionByName(more)


def join(docs: DataFrame, rule: Rule = Rule()) -> DataFrame:
    """doc_id, n_shingles and component_id of every row of ``docs`` (doc_id and text)."""
    with small_broadcasts(docs.sparkSession):
        return staged(_joined(docs, rule), "components")


def _joined(docs: DataFrame, rule: Rule) -> DataFrame:
    slim = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    all_rows = staged(signatures(slim, rule), "signatures")
    signed = all_rows.filter("n is not null").select("doc_id", "n", "k1", "k2")
    has = signed.filter("n > 0 and doc_id is not null")
    classes = staged(has.groupBy("k1", "k2").agg(F.min("doc_id").alias("low"), F.first("n").alias("n")), "classes")
    sets, shingles = classes.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    buckets = max(MIN_BUCKETS, -(-_MOVED * shingles // BUCKET_BYTES))
    long = long_lists(all_rows, sets)
    texts = slim.filter("doc_id is not null")
    found = occurrences(_packed(texts, rule, long, buckets))
    edges = staged(candidate_edges(found, rule), "edges")
    links = _links(texts, classes, edges, rule)
    # An id with several sets is one vertex.
    twice = has.groupBy("doc_id").agg(F.count("*").alias("rows")).filter("rows > 1").select("doc_id")
    of_class = has.join(classes.drop("n"), ["k1", "k2"])
    own = of_class.join(twice, "doc_id", "left_semi").filter("doc_id <> low").select(F.col("doc_id").alias("a"), F.col("low").alias("b"))
    connected = components(links.unionByName(own)).withColumnRenamed("id", "low")
    low = F.when(F.col("doc_id").isNotNull(), F.coalesce("low", "doc_id"))
    return (
        signed.join(classes.drop("n"), ["k1", "k2"], "left")
        .withColumn("low", low)
        .join(connected, "low", "left")
        .select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("component", "low").alias("component_id"))
    )


def query(docs: DataFrame) -> DataFrame:
    return join(docs.select("doc_id", "text"), Rule(words=4, percent=85))
