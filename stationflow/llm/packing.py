"""Pack tokenised documents into as few sequences as possible, by bin completion with branch and bound.

Where a document goes depends on its length alone, and there are at most ``capacity`` lengths. So the corpus is counted
by length, and the plan is made for these counts (that table, at most ``capacity`` rows, is all the driver sees):

1. Best fit decreasing gives the first incumbent, in closed form for all documents of a length at once.
2. Bin completion: around the largest document left, the undominated fillings of the rest of the sequence are listed,
   least waste first, and one is applied as often as the counts allow. A branch ends when its waste exceeds what
   any plan with one sequence less than the incumbent may waste. Better plans become incumbents.
3. The search ends at the lower bound on the number of sequences, or after turning back ``nodes`` times; the incumbent
   stands.

The plan is a list of (filling, times). Pieces get a rank among those of their length, and the rank gives sequence and
place. Lengths with many pieces are ranked in blocks by hash, so no length, however common, is handled by one task.

A null text is empty: its document is the end token alone. Null ids and repeated rows are packed like any other; rows
equal in all columns may change places, which gives the same rows. Equal lengths are ranked by id. No documents, no
rows. Extra columns are dropped.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections import Counter

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .tables import ship, small_batches, staged, utf8
from .tokens import encoder, vocabulary_path

CAPACITY = 4096
END_ID = 1
ROWS_PER_BLOCK = 200_000
#: How often the search may turn back, fillings tried per node and steps to find them.
NODES = 2_000
FILLINGS = 6
STEPS = 300

Plan = list[tuple[tuple[tuple[int, int], ...], int]]  # ((length, how many), ...), times


def tokenized_pieces(
    docs: DataFrame, path: str | None = None, capacity: int = CAPACITY, end_id: int = END_ID
) -> DataFrame:
    """doc_id, piece, start, length, ids (little-endian unsigned 32-bit) of each piece of each document."""
    ship(docs.sparkSession)
    path = path or vocabulary_path()
    slim = docs.select("doc_id", "text")
    id_type = slim.schema["doc_id"].dataType.simpleString()

    def cut(batches):
        import pyarrow as pa

        words, end = encoder(path), end_id.to_bytes(4, "little")
        try:
            yield from pieces_of(batches, words.encode, end)
        finally:  # else each idle worker of an executor would hold its pieces beside the next stages
            words.forget()
            pa.default_memory_pool().release_unused()

    def pieces_of(batches, encode, end):
        import pyarrow as pa

        width = 4 * capacity
        for batch in batches:
            rows, piece, start, length, parts, held = [], [], [], [], [], 0

            def made(batch=batch):
                return pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).take(pa.array(rows, pa.int64())),
                        pa.array(piece, pa.int32()),
                        pa.array(start, pa.int64()),
                        pa.array(length, pa.int32()),
                        pa.array(parts, pa.binary()),
                    ],
                    ["doc_id", "piece", "start", "length", "ids"],
                )

            for row, text in enumerate(utf8(batch.column(1))):
                ids = encode(text) + end
                for number, at in enumerate(range(0, len(ids), width)):
                    part = ids[at : at + width]
                    rows.append(row)
                    piece.append(number)
                    start.append(at // 4)
                    length.append(len(part) // 4)
                    parts.append(part)
                held += len(ids)
                if held > 8 << 20:
                    yield made()
                    rows, piece, start, length, parts, held = [], [], [], [], [], 0
            yield made()

    schema = f"doc_id {id_type}, piece int, start bigint, length int, ids binary"
    return slim.mapInArrow(cut, schema)


def lower_bound(counts: dict[int, int], capacity: int) -> int:
    """Sequences that any plan needs: by total length, and by what cannot share a sequence with large pieces."""
    best = -(-sum(s * n for s, n in counts.items()) // capacity)
    sizes = sorted(counts)
    for least in [s for s in sizes if 2 * s <= capacity] or [0]:
        alone = sum(counts[s] for s in sizes if s > capacity - least)
        large = [(s, counts[s]) for s in sizes if capacity - least >= s > capacity / 2]
        small = sum(s * counts[s] for s in sizes if least <= s <= capacity / 2)
        room = sum((capacity - s) * n for s, n in large)
        best = max(best, alone + sum(n for _, n in large) + max(0, -(-(small - room) // capacity)))
        if len(sizes) > 512 and least > 64:  # the bound seldom improves further, and each step reads all lengths
            break
    return best


def best_fit(counts: dict[int, int], capacity: int) -> Plan:
    """Best fit decreasing, for all pieces of a length at once."""
    open_bins: dict[int, list[tuple[tuple[tuple[int, int], ...], int]]] = {}
    rooms: list[int] = []
    done: Plan = []

    def put(room: int, filling: tuple[tuple[int, int], ...], times: int) -> None:
        if room == 0:
            done.append((filling, times))
            return
        if room not in open_bins:
            insort(rooms, room)
        open_bins.setdefault(room, []).append((filling, times))

    for size in sorted(counts, reverse=True):
        left = counts[size]
        while left:
            at = bisect_left(rooms, size)
            if at < len(rooms):
                room = rooms[at]
                filling, times = open_bins[room].pop()
                if not open_bins[room]:
                    del open_bins[room], rooms[at]
            else:
                room, filling, times = capacity, (), left
            each = min(room // size, left)  # the fullest sequence that fits stays the fullest until it is full
            full = min(times, left // each)
            put(room - each * size, (*filling, (size, each)), full)
            left -= each * full
            if full < times and filling:
                put(room, filling, times - full)
    for room in rooms:
        done += open_bins[room]
    return done


def fillings(counts: dict[int, int], sizes: list[int], first: int, capacity: int) -> list[tuple[tuple[int, int], ...]]:
    """Undominated fillings around one piece of length ``first``, least waste first.

    A filling is dominated if another piece still fits, or if one of its pieces can be exchanged for a larger one
    that is left: the larger piece is harder to place later, so the exchange never needs more sequences.
    """
    found: list[tuple[int, tuple[tuple[int, int], ...]]] = []
    room, steps = capacity - first, STEPS
    used = Counter([first])
    falling = [-s for s in sizes]
    start = bisect_left(falling, -room)
    stack: list[tuple[int, int, tuple[tuple[int, int], ...]]] = [(start, room, ())]
    while stack and steps:
        steps -= 1
        at, rest, chosen = stack.pop()
        while at < len(sizes) and (sizes[at] > rest or counts[sizes[at]] - (sizes[at] == first) <= 0):
            at += 1
        if at == len(sizes):
            if not _dominated(counts, sizes, falling, chosen, rest, used):
                found.append((rest, ((first, 1), *chosen)))
                if rest == 0 and len(found) >= FILLINGS:
                    break
            continue
        size = sizes[at]
        most = min(counts[size] - (size == first), rest // size)
        # The last one pushed is tried first: as many as fit, then one less, and so on.
        for n in {0, 1, most - 1} - {most} if most > 1 else {0}:
            if n >= 0:
                stack.append((at + 1, rest - n * size, (*chosen, (size, n)) if n else chosen))
        stack.append((at + 1, rest - most * size, (*chosen, (size, most))))
    found.sort(key=lambda f: f[0])
    return [f for _, f in found[:FILLINGS]] or [((first, 1),)]


def _dominated(counts, sizes, falling, chosen, slack, used) -> bool:
    """``falling`` holds the negated lengths, so that lengths within the slack are found by halving."""
    if slack == 0:
        return False
    taken = used + Counter(dict(chosen))
    for size, _ in chosen:
        for at in range(bisect_left(falling, -size - slack), bisect_left(falling, -size)):
            if counts[sizes[at]] > taken[sizes[at]]:
                return True
    smallest = next((s for s in reversed(sizes) if counts[s] > taken[s]), None)
    return smallest is not None and smallest <= slack


def _merged(filling: tuple[tuple[int, int], ...]) -> tuple[tuple[int, int], ...]:
    """One entry per length, longest first."""
    total: dict[int, int] = {}
    for size, n in filling:
        total[size] = total.get(size, 0) + n
    return tuple(sorted(total.items(), reverse=True))


def plan_sequences(counts: dict[int, int], capacity: int = CAPACITY, nodes: int = NODES) -> Plan:
    """Fillings and how often each is used, so that all pieces have a place."""
    counts = {s: n for s, n in counts.items() if n}
    if not counts:
        return []
    best = [(_merged(f), t) for f, t in best_fit(counts, capacity)]
    n_best, least = sum(t for _, t in best), lower_bound(counts, capacity)
    total = sum(s * n for s, n in counts.items())
    if n_best == least:
        return best

    left, sizes = dict(counts), sorted(counts, reverse=True)
    # Each level: the fillings not tried yet, and what the level has taken: (filling, times, waste).
    levels: list[list] = [[fillings(left, sizes, sizes[0], capacity)[::-1], None]]
    waste, bins = 0, 0
    while levels and nodes and n_best > least:
        untried, taken = levels[-1]
        if taken:  # undo, then try the next
            nodes -= 1
            filling, times, lost = taken
            for size, n in filling:
                left[size] += n * times
            waste, bins, levels[-1][1] = waste - lost, bins - times, None
        if not untried:
            levels.pop()
            continue
        filling = _merged(untried.pop())
        lost_each = capacity - sum(s * n for s, n in filling)
        times = min(left[s] // n for s, n in filling)
        allowed = (n_best - 1) * capacity - total - waste
        if lost_each:
            times = min(times, allowed // lost_each)
        if times <= 0:  # the fillings that follow waste no less
            levels.pop()
            continue
        for size, n in filling:
            left[size] -= n * times
        waste, bins = waste + lost_each * times, bins + times
        levels[-1][1] = (filling, times, lost_each * times)
        sizes_left = [s for s in sizes if left[s] > 0]
        if sizes_left:
            levels.append([fillings(left, sizes_left, sizes_left[0], capacity)[::-1], None])
        elif bins < n_best:
            n_best, best = bins, [(f, t) for _, (f, t, _) in levels]
    return best


def _slots(plan: Plan):
    """Per length: first ranks, how many per sequence, first sequence and first offset of each use of the length."""
    import numpy as np

    rows: dict[int, list[tuple[int, int, int, int]]] = {}
    next_rank: Counter[int] = Counter()
    sequence = 0
    for filling, times in plan:
        offset = 0
        for size, n in filling:
            rows.setdefault(size, []).append((next_rank[size], n, sequence, offset))
            next_rank[size] += n * times
            offset += n * size
        sequence += times
    return {size: np.array(r, dtype=np.int64).T for size, r in rows.items()}


def place(pieces: DataFrame, capacity: int = CAPACITY, nodes: int = NODES, rows_per_block: int = ROWS_PER_BLOCK):
    """Add ``sequence_id`` and ``offset``. ``pieces`` (doc_id, piece, length and any others) should be a stored table."""
    spark = pieces.sparkSession
    ship(spark)
    # At most ``capacity`` rows.
    counts = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}
    slots = _slots(plan_sequences(counts, capacity, nodes))
    blocks = spark.createDataFrame([(s, -(-n // rows_per_block)) for s, n in counts.items()], "length int, blocks int")
    # One row per length, so at most ``capacity`` rows are broadcast.
    dealt = pieces.join(F.broadcast(blocks), "length").withColumn(
        "block", F.pmod(F.xxhash64("doc_id", "piece"), F.col("blocks")).cast("int")
    )
    earlier = Window.partitionBy("length").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    bases = (
        dealt.groupBy("length", "block")
        .agg(F.count("*").alias("n"))
        .select("length", "block", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("base"))
    )
    others = [c for c in pieces.columns if c not in {"doc_id", "piece", "length", "ids"}]
    inside = Window.partitionBy("length", "block").orderBy("doc_id", "piece", *others)
    ranked = dealt.withColumn("rank", F.row_number().over(inside) - 1).join(bases, ["length", "block"])

    def found(length, rank):
        import numpy as np
        import pyarrow as pa

        lengths, ranks = length.to_numpy(zero_copy_only=False), rank.to_numpy(zero_copy_only=False)
        sequence, offset = np.zeros(len(ranks), np.int64), np.zeros(len(ranks), np.int64)
        for size in np.unique(lengths):
            here = np.flatnonzero(lengths == size)
            first, each, first_sequence, first_offset = slots[int(size)]
            use = np.searchsorted(first, ranks[here], "right") - 1
            step, place = np.divmod(ranks[here] - first[use], each[use])
            sequence[here] = first_sequence[use] + step
            offset[here] = first_offset[use] + place * int(size)
        return pa.StructArray.from_arrays([sequence, offset], ["sequence_id", "offset"])

    at = F.arrow_udf(found, "sequence_id bigint, offset bigint")
    return ranked.withColumn("at", at("length", F.col("rank") + F.col("base"))).select(*pieces.columns, "at.*")


def _stored(pieces: DataFrame) -> DataFrame:
    """Small batches, as ids are made from whole texts."""
    with small_batches(pieces.sparkSession):
        return staged(pieces, "pieces")


def pack(docs: DataFrame, path: str | None = None, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """Pieces with their ids, sequence and offset there."""
    return place(_stored(tokenized_pieces(docs, path, capacity, end_id)), capacity)


def sequences(packed: DataFrame) -> DataFrame:
    """sequence_id, n_tokens and ids of every sequence; a sequence holds at most ``capacity`` tokens."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids", "length")))
    ids = F.aggregate("parts", F.lit(b""), lambda all_ids, part: F.concat(all_ids, part["ids"]))
    gathered = packed.groupBy("sequence_id").agg(parts.alias("parts"), F.sum("length").alias("n_tokens"))
    return gathered.select("sequence_id", "n_tokens", ids.alias("ids"))


def query(docs: DataFrame, path: str | None = None, capacity: int = CAPACITY) -> DataFrame:
    """Where each piece is, with a digest of its ids in place of the ids.

    The digest is stored beside the ids, as batches of ids read back would fill an executor's memory.
    """
    pieces = _stored(tokenized_pieces(docs, path, capacity).withColumn("ids_crc32", F.crc32("ids")))
    return place(pieces.drop("ids"), capacity).select(
        "doc_id", "piece", "start", F.col("length").cast("bigint").alias("length"), "ids_crc32", "sequence_id", "offset"
    )
