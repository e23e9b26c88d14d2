"""Repeated phrases across documents, found exactly and removed but for their first occurrence.

A window is ``WINDOW`` consecutive words. Its anchor is the smallest hash among its runs of ``ANCHOR`` words, so equal
windows have equal anchors, and neighbouring windows mostly share one. Runs common in a sample of the texts are anchors
only of windows that have no other run: a short phrase said in many contexts would gather all of these.

1. Texts are told apart by a hash; what an exact copy of a text of a smaller id holds is removed as a whole.
2. Anchors that occur in two different texts or more are recurring. Only (anchor, text) pairs move for this. Common
   anchors are recurring by the sample's evidence, and their pairs never move, so a passage that a third of all
   documents share makes no large group. (At most ``HOT`` runs are kept as common; others are treated like all the rest.)
3. Documents with recurring anchors give up the regions around these: runs of windows with one anchor. Equal regions
   are merged with the smallest and largest id that has them, from partial aggregates.
4. Regions are dealt by anchor into shards. A shard confirms its recurring windows word by word, compiles them into an
   Aho-Corasick automaton over word numbers, and runs its own regions through it to locate every occurrence, each with
   the smallest id that has it. An anchor of more than ``LARGE_REGIONS`` regions or ``LARGE_CHARS`` characters of them
   would make a large shard. Its regions are cut into single windows instead, whose smallest and largest ids come from
   partial aggregates and go back to the regions by (window, salt), so no task holds what one anchor or window has.
5. Each document loses the words covered by windows that a smaller id has.

Null and empty texts have no words. Null ids lose nothing and are no one's first occurrence. Repeated rows with one id
are the same document. No documents, no rows. Extra columns are dropped.
"""

from __future__ import annotations

import hashlib

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .tables import ship, slices, staged, utf8
from .words import run_hashes, word_hashes

WINDOW = 13
ANCHOR = 5
#: Texts sampled for common runs (one in so many), how many of them make a run common, and how many runs are kept.
HOT_SAMPLE, HOT_TEXTS, HOT = 64, 32, 65_536
#: Regions of a shard, on average, and most regions and characters of an anchor that goes to one. 25,000 regions of 21
#: words, all of them recurring, took 170 MB and 6 s.
SHARD_REGIONS = 5_000
LARGE_REGIONS, LARGE_CHARS = 25_000, 4 << 20
#: Groups that the regions of one window are dealt into where regions are cut into single windows.
SALTS = 256
_SLICE = 1 << 20
#: The bit that marks common runs; it also makes them larger than all others.
_COMMON = np.uint64(1 << 63)


def _sliding_minimum(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of ``width`` consecutive values from each place."""
    found, have = values, 1
    while have < width:
        step = min(have, width - have)
        found, have = np.minimum(found[:-step], found[step:]), have + step
    return found


def _runs(words: np.ndarray, size: int, hot: np.ndarray) -> np.ndarray:
    """Hashes of ``size`` consecutive words, marked where they are in ``hot`` (sorted)."""
    runs = run_hashes(words, size) >> np.uint64(1)
    if len(hot):
        known = hot[np.minimum(np.searchsorted(hot, runs), len(hot) - 1)] == runs
        runs[known] |= _COMMON
    return runs


def anchor_runs(texts: list[bytes], hot: np.ndarray, window: int = WINDOW, anchor: int = ANCHOR):
    """Runs of windows with one anchor: anchor, text number, first window (place in its text) and number of windows.

    Also the number of words of each text. Anchors in ``hot`` are marked by ``_COMMON``.
    """
    words, counts = word_hashes(texts)
    ends = np.cumsum(counts)
    none = np.zeros(0, np.int64)
    if len(words) < window:
        return np.zeros(0, np.uint64), none, none, none, counts
    least = _sliding_minimum(_runs(words, anchor, hot), window - anchor + 1)
    owner = np.repeat(np.arange(len(texts)), counts)
    places = np.flatnonzero(owner[: len(least)] == owner[window - 1 :])
    if not len(places):
        return np.zeros(0, np.uint64), none, none, none, counts
    value, of = least[places], owner[places]
    new = np.ones(len(places), bool)
    new[1:] = (value[1:] != value[:-1]) | (of[1:] != of[:-1])
    first = np.flatnonzero(new)
    lengths = np.diff(np.append(first, len(places)))
    return value[first], of[first], places[first] - (ends - counts)[of[first]], lengths, counts


def _common_runs(texts: DataFrame) -> np.ndarray:
    """The runs that occur in ``HOT_TEXTS`` sampled texts or more, at most ``HOT``, sorted; ``texts``: t1, text."""

    def found(batches):
        import pyarrow as pa

        for batch in batches:
            raw, key = utf8(batch.column(1)), np.asarray(batch.column(0))
            for a, b in slices(map(len, raw), _SLICE):
                words, counts = word_hashes(raw[a:b])
                runs = run_hashes(words, ANCHOR) >> np.uint64(1)
                owner = np.repeat(key[a:b], counts)
                whole = owner[: len(runs)] == owner[len(owner) - len(runs) :]
                columns = [pa.array(runs[whole].view(np.int64)), pa.array(owner[: len(runs)][whole])]
                yield pa.RecordBatch.from_arrays(columns, ["run", "t1"])

    sampled = texts.filter(F.pmod("t1", F.lit(HOT_SAMPLE)) == 0).select("t1", "text")
    pairs = sampled.mapInArrow(found, "run bigint, t1 bigint").distinct()
    common = pairs.groupBy("run").count().filter(F.col("count") >= HOT_TEXTS).orderBy(F.desc("count"), "run")
    return np.sort(np.array([r["run"] for r in common.limit(HOT).collect()], np.int64)).view(np.uint64)  # at most HOT


def _anchors(texts: DataFrame, hot: np.ndarray) -> DataFrame:
    """anchor and t1 of each run of windows, without common anchors; ``texts``: t1, text."""

    def found(batches):
        import pyarrow as pa

        for batch in batches:
            raw, key = utf8(batch.column(1)), np.asarray(batch.column(0))
            for a, b in slices(map(len, raw), _SLICE):
                value, of, *_ = anchor_runs(raw[a:b], hot)
                order = np.lexsort((value, of))
                value, of = value[order], of[order]
                once = np.ones(len(value), bool)
                once[1:] = (value[1:] != value[:-1]) | (of[1:] != of[:-1])
                once &= value < _COMMON
                columns = [pa.array(value[once].view(np.int64)), pa.array(key[a:b][of[once]])]
                yield pa.RecordBatch.from_arrays(columns, ["anchor", "t1"])

    return texts.select("t1", "text").mapInArrow(found, "anchor bigint, t1 bigint")


def _digest(words: list[bytes]) -> str:
    return hashlib.sha256(b" ".join(words)).hexdigest()


def _regions(docs: DataFrame, hot: np.ndarray) -> DataFrame:
    """Final rows of documents without candidates, text and regions of the others; ``docs``: doc_id, t1, text, first,
    anchors."""
    id_type = docs.schema["doc_id"].dataType.simpleString()
    names = ["doc_id", "t1", "n_words", "n_removed", "kept_sha256", "text", "regions"]

    def found(batches):
        import pyarrow as pa

        region = pa.struct([("anchor", pa.int64()), ("start", pa.int32()), ("words", pa.string())])
        for batch in batches:
            raw = utf8(batch.column("text"))
            ids, first = batch.column("doc_id").to_pylist(), batch.column("first").to_pylist()
            anchors = batch.column("anchors").to_pylist()
            for a, b in slices(map(len, raw), _SLICE):
                value, of, start, length, counts = anchor_runs(raw[a:b], hot)
                begin = np.searchsorted(of, np.arange(b - a + 1))
                n_removed, digest, text, regions = [], [], [], []
                for i in range(b - a):
                    mine, n = slice(begin[i], begin[i + 1]), int(counts[i])
                    copy = ids[a + i] is not None and ids[a + i] > first[a + i]
                    known = np.array(anchors[a + i] or [], np.int64).view(np.uint64)
                    again = np.isin(value[mine], known) | (value[mine] >= _COMMON)
                    words = raw[a + i].split()
                    if copy or ids[a + i] is None or not again.any():
                        gone = copy and n >= WINDOW
                        n_removed.append(n if gone else 0)
                        digest.append(_digest([] if gone else words))
                        text.append(None)
                        regions.append(None)
                        continue
                    n_removed.append(None)
                    digest.append(None)
                    text.append(raw[a + i])
                    regions.append(
                        [
                            {"anchor": int(v), "start": int(s), "words": b" ".join(words[s : s + k + WINDOW - 1]).decode()}
                            for v, s, k in zip(
                                value[mine][again].view(np.int64), start[mine][again], length[mine][again], strict=True
                            )
                        ]
                    )
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").slice(a, b - a),
                        batch.column("t1").slice(a, b - a),
                        pa.array(counts.astype(np.int64)),
                        pa.array(n_removed, pa.int64()),
                        pa.array(digest, pa.string()),
                        pa.array(text, pa.binary()).cast(pa.string()),
                        pa.array(regions, pa.list_(region)),
                    ],
                    names,
                )

    schema = (
        f"doc_id {id_type}, t1 bigint, n_words bigint, n_removed bigint, kept_sha256 string, text string, "
        "regions array<struct<anchor:bigint,start:int,words:string>>"
    )
    return docs.select("doc_id", "t1", "text", "first", "anchors").mapInArrow(found, schema)


def locate(texts: list[list[str]], low: list, high: list, window: int = WINDOW) -> list[list | None]:
    """For each region, the smallest id that has each of its windows; None if that helps none of its documents.

    ``low`` and ``high`` are the smallest and largest id of the documents that have the region.
    """
    import ahocorasick

    numbers: dict[str, int] = {}
    coded = [tuple(numbers.setdefault(w, len(numbers)) for w in words) for words in texts]
    first: dict[tuple, object] = {}
    for words, doc in zip(coded, low, strict=True):
        for i in range(len(words) - window + 1):
            phrase = words[i : i + window]
            if phrase not in first or doc < first[phrase]:
                first[phrase] = doc
    recurring = set()
    for words, last in zip(coded, high, strict=True):
        for i in range(len(words) - window + 1):
            phrase = words[i : i + window]
            if first[phrase] < last:
                recurring.add(phrase)
    if not recurring:
        return [None] * len(texts)
    automaton = ahocorasick.Automaton(ahocorasick.STORE_ANY, ahocorasick.KEY_SEQUENCE)
    for phrase in recurring:
        automaton.add_word(phrase, first[phrase])
    automaton.make_automaton()
    found = []
    for words in coded:
        owners = [None] * (len(words) - window + 1)
        for end, doc in automaton.iter(words):
            owners[end - window + 1] = doc
        found.append(owners if any(o is not None for o in owners) else None)
    return found


def _owners(regions: DataFrame, shards: int) -> DataFrame:
    """anchor, r (hash of the region) and owners of the regions that have recurring windows."""
    id_type = regions.schema["low"].dataType.simpleString()

    def located(table):
        import pyarrow as pa

        texts = [w.split(" ") for w in table.column("words").to_pylist()]
        owners = locate(texts, table.column("low").to_pylist(), table.column("high").to_pylist())
        some = [i for i, o in enumerate(owners) if o is not None]
        kind = table.schema.field("low").type
        return pa.table(
            {
                "anchor": table.column("anchor").take(some),
                "r": table.column("r").take(some),
                "owners": pa.array([owners[i] for i in some], pa.list_(kind)),
            }
        )

    dealt = regions.withColumn("shard", F.pmod("anchor", F.lit(shards)))
    return dealt.groupBy("shard").applyInArrow(located, f"anchor bigint, r bigint, owners array<{id_type}>")


def _single_windows(regions: DataFrame) -> DataFrame:
    """at and window of each window of the regions."""

    def cut(texts):
        import pyarrow as pa

        found = []
        for text in texts.to_pylist():
            words = text.split(" ")
            found.append([" ".join(words[i : i + WINDOW]) for i in range(len(words) - WINDOW + 1)])
        return pa.array(found, pa.list_(pa.string()))

    return regions.withColumn("cut", F.arrow_udf(cut, "array<string>")("words")).select(
        "anchor", "r", "low", "high", F.posexplode("cut").alias("at", "window")
    )


def _cleaned(docs: DataFrame) -> DataFrame:
    """Remove windows (places of their first words) from texts; ``docs``: doc_id, n_words, text, places."""

    def made(texts, places):
        import pyarrow as pa

        removed, kept = [], []
        for text, starts in zip(utf8(texts), places.to_pylist(), strict=True):
            words = text.split()
            gone = np.zeros(len(words) + WINDOW, np.int64)
            at = np.unique(np.array(starts or [], np.int64))
            gone[at] += 1
            gone[at + WINDOW] -= 1
            covered = np.cumsum(gone)[: len(words)] > 0
            removed.append(int(covered.sum()))
            kept.append(b" ".join([words[i] for i in np.flatnonzero(~covered)]))
        columns = [pa.array(removed, pa.int64()), pa.array(kept, pa.binary()).cast(pa.string())]
        return pa.StructArray.from_arrays(columns, ["n_removed", "kept"])

    cut = F.arrow_udf(made, "n_removed bigint, kept string")
    return docs.withColumn("cut", cut("text", "places"))


def repeated_phrases(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, n_removed and kept_sha256 (of the kept words, joined by one space) of each document."""
    spark = docs.sparkSession
    ship(spark)
    text = F.coalesce("text", F.lit(""))
    known = docs.select("doc_id", text.alias("text")).withColumns(
        {"t1": F.xxhash64("text"), "t2": F.xxhash64(F.lit(1), "text")}
    )
    with_id = known.filter("doc_id is not null")
    hot = _common_runs(with_id)

    by_anchor = Window.partitionBy("anchor")
    recurring = (
        _anchors(with_id, hot)
        .withColumns({"low": F.min("t1").over(by_anchor), "high": F.max("t1").over(by_anchor)})
        .filter("low <> high")
        .groupBy("t1")
        .agg(F.collect_set("anchor").alias("anchors"))
    )
    recurring = staged(recurring, "anchors")
    firsts = staged(with_id.groupBy("t1", "t2").agg(F.min("doc_id").alias("first")), "texts")
    about = firsts.join(recurring, "t1", "left")
    judged = staged(_regions(known.join(about, ["t1", "t2"], "left"), hot), "regions", compression="zstd")

    places = judged.filter("regions is not null").select("doc_id", "t1", F.inline("regions"))
    places = places.withColumn("r", F.xxhash64("words"))
    merged = places.groupBy("anchor", "r", "words").agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high"))
    merged = staged(merged, "merged", compression="zstd")
    n_regions = F.count("*").alias("regions")
    sizes = merged.groupBy("anchor").agg(n_regions, F.sum(F.length("words")).alias("chars"))
    large = sizes.filter((F.col("regions") > LARGE_REGIONS) | (F.col("chars") > LARGE_CHARS)).select("anchor")
    large = staged(large, "large")
    some = large.limit(1).count() > 0
    small = merged.join(large, "anchor", "left_anti") if some else merged
    # Pairs of a window of the region and the smallest id that has it.
    pair = F.transform("owners", lambda o, i: F.struct(i.alias("at"), o.alias("first")))
    owners = _owners(small, max(1, -(-merged.count() // SHARD_REGIONS)))
    owners = owners.select("anchor", "r", F.filter(pair, lambda x: x["first"].isNotNull()).alias("owners"))
    if some:
        single = _single_windows(merged.join(large, "anchor", "left_semi")).withColumn("salt", F.pmod("r", F.lit(SALTS)))
        single = staged(single, "windows", compression="zstd")
        dealt = single.groupBy("window", "salt").agg(F.min("low").alias("low"), F.max("high").alias("high"))
        ends = [F.min("low").alias("first"), F.max("high").alias("last"), F.collect_list("salt").alias("salts")]
        first = dealt.groupBy("window").agg(*ends).filter("first < last")
        first = first.select("window", "first", F.explode("salts").alias("salt"))
        located = single.join(first, ["window", "salt"]).groupBy("anchor", "r")
        owners = owners.unionByName(located.agg(F.collect_list(F.struct("at", "first")).alias("owners")))
    owners = staged(owners, "owners")

    earlier = F.filter("owners", lambda x: x["first"] < F.col("doc_id"))
    earlier = F.transform(earlier, lambda x: F.col("start") + x["at"])
    gone = (
        places.select("doc_id", "t1", "anchor", "r", "start")
        .join(owners, ["anchor", "r"])
        .select("doc_id", "t1", earlier.alias("at"))
        .filter(F.size("at") > 0)
        .groupBy("doc_id", "t1")
        .agg(F.flatten(F.collect_list("at")).alias("places"))
    )
    open_docs = judged.filter("regions is not null").select("doc_id", "t1", "n_words", "text")
    cut = _cleaned(open_docs.join(gone, ["doc_id", "t1"], "left"))
    names = ["doc_id", "n_words", "n_removed", "kept_sha256"]
    done = judged.filter("regions is null").select(*names)
    cleaned = cut.select("doc_id", "n_words", "cut.n_removed", F.sha2("cut.kept", 256).alias("kept_sha256"))
    return done.unionByName(cleaned)


def query(docs: DataFrame) -> DataFrame:
    return repeated_phrases(docs.select("doc_id", "text"))
