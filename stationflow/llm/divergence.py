"""How sources differ in their words: a pointer sort of word starts, then smoothed shares compared exactly.

1. A task joins the texts of a slice into one buffer and keeps a pointer to the start of every word (a suffix pointer that
   is compared up to the word's end). A multikey quicksort puts the pointers of a slice in order: three ways by eight
   bytes at a time, equal ones go on with the next eight. Runs of equal words give, per (lang, source), how often a word
   occurs and in how many documents. A document lies in one slice, so its numbers just add up.
2. Spark sums these rows by (lang, source, word), then finds each language's words of enough documents.
3. Shares are whole numbers: 1 + floor(SCALE * (count + SMOOTH) / (N + SMOOTH * V)).
4. ``pair`` is the sum over all kept words of the differences of two sources' shares. A word that both lack adds the same
   amount each time, so tasks sum only what present words add beyond that: a task takes the words of one language in one
   shard and two blocks of at most about ``SOURCES`` sources, and returns one row per pair of sources, never one per word
   and pair. All pairs of sources are the asked-for result.
5. ``term`` keeps each group's first words by excess over the language; only these ranks leave the sort.

A hot source or language is summed in the tasks before it moves, and its words are spread over shards by their hash.

Nulls and odd input: null text, lang and source are empty strings (a group of their own, together with empty ones). Empty
texts and texts without words add nothing, but their group exists. Repeated rows are documents of their own. A text longer
than a slice is one by itself. Ties in value go by the item's bytes. An empty table gives no rows. Extra columns are not read.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .tables import ship, slices, staged, utf8

MIN_DOCS = 30
SMOOTH = 5
SCALE = 1_000_000_000
TOP = 50
#: Bytes of text whose words are sorted together.
SLICE = 16 << 20
#: Sources that a task compares with as many others.
SOURCES = 256
#: Cells (words times sources) compared at once in a task.
_CELLS = 1 << 20
#: Rows of words that a task compares.
SHARD_ROWS = 500_000
#: Pointers that are sorted without another partition, and the chunks of eight bytes compared at once there.
_SMALL, _CHUNKS = 1 << 14, 6


# --- the pointer sort ------------------------------------------------------------------------------------------------


def _letters() -> np.ndarray:
    found = np.zeros(256, bool)
    found[128:] = True
    for a, z in ("AZ", "az"):
        found[ord(a) : ord(z) + 1] = True
    return found


_LETTER = _letters()
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def word_starts(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and size of each longest run of letters (ASCII letters and all bytes beyond ASCII)."""
    edges = np.flatnonzero(np.diff(np.concatenate([[False], _LETTER[data], [False]]).view(np.int8)))
    return edges[::2], edges[1::2] - edges[::2]


def _keys(chunks: np.ndarray, starts: np.ndarray, sizes: np.ndarray, depth: int) -> np.ndarray:
    """Bytes ``8 * depth`` to ``8 * depth + 7`` of each word as a number that orders like them; zeros behind its end."""
    left = np.clip(sizes - 8 * depth, 0, 8)
    value = chunks[np.where(left > 0, starts + 8 * depth, 0)].astype(np.uint64)
    unused = (8 * np.minimum(8 - left, 7)).astype(np.uint64)
    return np.where(left > 0, (value >> unused) << unused, np.uint64(0))


def _sorted_at_once(data, chunks, starts, sizes, part, depth) -> tuple[np.ndarray, np.ndarray]:
    """Order of a small part, and where its runs begin."""
    first, size = starts[part], sizes[part]
    needed = -(-int(size.max()) // 8) - depth
    if needed > _CHUNKS:
        words = [data[a : a + n].tobytes() for a, n in zip(first, size, strict=True)]
        place = sorted(range(len(part)), key=words.__getitem__)
        new = [k == 0 or words[place[k]] != words[place[k - 1]] for k in range(len(place))]
        return part[place], np.flatnonzero(new)
    keys = [_keys(chunks, first, size, depth + k) for k in range(max(1, needed))]
    place = np.lexsort(keys[::-1])
    new = np.zeros(len(part), bool)
    new[0] = True
    for key in keys:
        new[1:] |= key[place][1:] != key[place][:-1]
    return part[place], np.flatnonzero(new)


def sort_pointers(data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order of the pointers by word (stable), and where the runs of equal words begin in it.

    At least eight zero bytes must follow the last word of ``data``; words hold none.
    """
    chunks = np.ndarray((len(data) - 7,), ">u8", data, 0, (1,))
    order, begins, filled = np.empty(len(starts), np.int64), [np.zeros(0, np.int64)], 0
    todo = [(np.arange(len(starts)), 0)] if len(starts) else []
    while todo:
        part, depth = todo.pop()
        if depth is None or len(part) <= _SMALL:
            runs = np.zeros(1, np.int64)
            if depth is not None:
                part, runs = _sorted_at_once(data, chunks, starts, sizes, part, depth)
            order[filled : filled + len(part)] = part
            begins.append(runs + filled)
            filled += len(part)
            continue
        key = _keys(chunks, starts[part], sizes[part], depth)
        sample = key[:: max(1, len(key) // 255)]
        pivot = np.partition(sample, len(sample) // 2)[len(sample) // 2]
        low, high = part[key < pivot], part[key > pivot]
        same = part[key == pivot]
        ended = sizes[same].max() <= 8 * (depth + 1)
        todo += [(p, d) for p, d in ((high, depth), (same, None if ended else depth + 1), (low, depth)) if len(p)]
    return order, np.concatenate(begins)


def counted_words(texts: list[bytes], groups: np.ndarray) -> tuple[list[bytes], np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Words in order, and per (word, group): the word's number, the group, occurrences and documents."""
    data = _LOWER[np.frombuffer(b"\n".join(texts) + b"\n" + bytes(8), np.uint8)]
    begins = np.cumsum([0, *(len(t) + 1 for t in texts)])
    starts, sizes = word_starts(data)
    order, runs = sort_pointers(data, starts, sizes)
    words = [data[a : a + n].tobytes() for a, n in zip(starts[order[runs]], sizes[order[runs]], strict=True)]
    if not words:
        return [], *(np.zeros(0, np.int64) for _ in range(4))
    doc = (np.searchsorted(begins, starts, "right") - 1)[order]
    word = np.repeat(np.arange(len(runs)), np.diff(np.append(runs, len(order))))
    each = np.flatnonzero(np.concatenate([[True], (doc[1:] != doc[:-1]) | (word[1:] != word[:-1])]))
    times = np.diff(np.append(each, len(order)))
    wide = int(groups.max()) + 1
    key = word[each] * wide + groups[doc[each]]
    place = np.argsort(key, kind="stable")
    at = np.flatnonzero(np.concatenate([[True], key[place][1:] != key[place][:-1]]))
    found = key[place][at]
    return words, found // wide, found % wide, np.add.reduceat(times[place], at), np.diff(np.append(at, len(place)))


# --- the corpus ------------------------------------------------------------------------------------------------------


def _named(docs: DataFrame) -> DataFrame:
    return docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")])


def word_counts(docs: DataFrame) -> DataFrame:
    """lang, source, term, n (occurrences) and docs (documents with it), summed over the corpus."""
    ship(docs.sparkSession)

    def counted(batches):
        import pyarrow as pa

        texts, langs, sources, size = [], [], [], 0

        def rows():
            pairs = list(zip(langs, sources, strict=True))
            number = {p: i for i, p in enumerate(dict.fromkeys(pairs))}
            words, word, group, n, df = counted_words(texts, np.array([number[p] for p in pairs]))
            of, column = pa.array(group), [pa.array([p[i] for p in number], pa.string()) for i in (0, 1)]
            terms = pa.array(words, pa.binary()).cast(pa.string())
            columns = [column[0].take(of), column[1].take(of), terms.take(pa.array(word)), pa.array(n), pa.array(df)]
            return pa.RecordBatch.from_arrays(columns, ["lang", "source", "term", "n", "docs"])

        for batch in batches:
            found = utf8(batch.column(2))
            lang, source = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for a, b in slices(map(len, found), SLICE):
                if texts and size + sum(map(len, found[a:b])) > SLICE:
                    yield rows()
                    texts, langs, sources, size = [], [], [], 0
                texts += found[a:b]
                langs += lang[a:b]
                sources += source[a:b]
                size += sum(map(len, found[a:b]))
        if texts:
            yield rows()

    schema = "lang string, source string, term string, n bigint, docs bigint"
    rows = _named(docs).mapInArrow(counted, schema)
    return rows.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def share(n: str, total: str, kept: str = "kept") -> F.Column:
    """A smoothed share as a whole number; null where nothing is kept. Decimals, so products don't overflow."""
    over = f"cast({total} as decimal(25,0)) + {SMOOTH} * cast({kept} as decimal(20,0))"
    of = f"cast({n} + {SMOOTH} as decimal(20,0)) * cast({SCALE} as decimal(10,0))"
    return F.expr(f"case when {kept} > 0 then 1 + (({of}) div ({over})) end")


def _pairs(present: DataFrame, absent: DataFrame) -> DataFrame:
    """lang, source, item, more and gap of each ordered pair of sources, in parts to be summed.

    ``present``: lang, source, term, p, block, blocks, shard. ``absent`` has a row without a term for every source and
    shard, with the share of an absent word. ``gap`` is the difference of these, ``more`` what words of the shard that
    one of the two blocks has add beyond it.
    """

    def compared(key, table):
        import pyarrow as pa

        lang, _, low, high = (k.as_py() for k in key)
        block = np.asarray(table.column("block"))
        missing = np.asarray(table.column("term").is_null())
        names = table.column("source").combine_chunks().dictionary_encode()
        code = np.asarray(names.indices)
        n = len(names.dictionary)
        p = np.asarray(table.column("p").fill_null(0))
        base, side = np.zeros(n, np.int64), np.zeros(n, np.int64)
        base[code[missing]], side[code[missing]] = p[missing], block[missing]
        terms = table.column("term").combine_chunks().dictionary_encode()
        word = np.asarray(terms.indices.fill_null(0))[~missing]
        place = np.argsort(word, kind="stable")
        word, column, value = word[place], code[~missing][place], p[~missing][place]
        more, gap = np.zeros((n, n), np.int64), np.abs(base[:, None] - base[None, :])
        step = max(1, _CELLS // max(1, n))
        for a in range(0, len(terms.dictionary), step):
            b = min(a + step, len(terms.dictionary))
            i, j = np.searchsorted(word, [a, b])
            cells = np.repeat(base[:, None], b - a, axis=1)
            cells[column[i:j], word[i:j] - a] = value[i:j]
            for s in range(n):
                more[s] += np.abs(cells - cells[s]).sum(1) - (b - a) * gap[s]
        wanted = (side[:, None] != side[None, :]) if low != high else ~np.eye(n, dtype=bool)
        x, y = np.nonzero(wanted)
        columns = [
            pa.array([lang] * len(x), pa.string()), names.dictionary.take(pa.array(x)), names.dictionary.take(pa.array(y)),
            pa.array(more[x, y]), pa.array(gap[x, y]),
        ]
        return pa.table(columns, names=["lang", "source", "item", "more", "gap"])

    columns = ["lang", "source", "term", "p", "block", "blocks", "shard"]
    dealt = (
        present.select(*columns)
        .unionByName(absent.select(*columns))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .withColumns({"low": F.least("block", "other"), "high": F.greatest("block", "other")})
        .select("lang", "source", "term", "p", "block", "shard", "low", "high")
    )
    schema = "lang string, source string, item string, more bigint, gap bigint"
    return dealt.groupBy("lang", "shard", "low", "high").applyInArrow(compared, schema)


def audit(docs: DataFrame, min_docs: int = MIN_DOCS, top: int = TOP) -> DataFrame:
    """lang, source, part, item, value and rank: distances to the language's other sources, and each source's own words."""
    word = Window.partitionBy("lang", "term")
    counts = staged(word_counts(docs), "words")
    kept = counts.withColumns({"in_docs": F.sum("docs").over(word), "lang_n": F.sum("n").over(word)})
    kept = staged(kept.filter(F.col("in_docs") >= min_docs).drop("in_docs", "docs"), "kept")

    totals = kept.groupBy("lang", "source").agg(F.sum("n").alias("n"), F.count("*").alias("rows"))
    groups = _named(docs).select("lang", "source").distinct().join(totals, ["lang", "source"], "left")
    groups = staged(groups.fillna(0, ["n", "rows"]).withColumnRenamed("n", "total"), "groups")
    sizes = kept.groupBy("lang").agg(F.countDistinct("term").alias("kept"))
    blocks = F.ceil(F.col("sources") / SOURCES).cast("int")
    langs = (
        groups.groupBy("lang")
        .agg(F.count("*").alias("sources"), F.sum("total").alias("lang_total"), F.sum("rows").alias("rows"))
        .join(sizes, "lang", "left")
        .fillna(0, ["kept"])
        .withColumn("blocks", blocks)
        .withColumn("shards", F.greatest(F.lit(1), F.ceil(2 * F.col("rows") / F.col("blocks") / SHARD_ROWS)).cast("int"))
        .select("lang", "lang_total", "kept", "blocks", "shards")
    )
    block = F.pmod(F.xxhash64("source"), F.col("blocks")).cast("int")
    groups = staged(groups.drop("rows").join(langs, "lang").withColumn("block", block), "sources")

    rows = kept.join(groups, ["lang", "source"]).withColumns(
        {"p": share("n", "total"), "shard": F.pmod(F.xxhash64("term"), F.col("shards")).cast("int")}
    )
    none = groups.withColumns(
        {
            "term": F.lit(None).cast("string"),
            "p": F.coalesce(share("0", "total"), F.lit(0)),
            "shard": F.explode(F.sequence(F.lit(0), F.col("shards") - 1)),
        }
    )
    parts = _pairs(rows, none).groupBy("lang", "source", "item").agg(F.sum("more").alias("more"), F.max("gap").alias("gap"))
    number = groups.select("lang", "kept").distinct()
    pairs = parts.join(number, "lang").withColumn("value", F.col("more") + F.col("kept") * F.col("gap"))
    terms = (
        rows.withColumn("value", F.col("p") - share("lang_n", "lang_total"))
        .filter("value > 0")
        .withColumnRenamed("term", "item")
    )
    place = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    columns = ["lang", "source", "part", "item", "value", "rank"]
    listed = [
        found.withColumns({"part": F.lit(part), "rank": F.row_number().over(place)}) for part, found in (("pair", pairs), ("term", terms))
    ]
    return listed[0].select(*columns).unionByName(listed[1].filter(F.col("rank") <= top).select(*columns))


def query(docs: DataFrame) -> DataFrame:
    return audit(docs.select("lang", "source", "text"))
