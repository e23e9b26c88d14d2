"""Toxicity by compression distance: two zstandard dictionaries, one length difference per window.

* The ordinary dictionary is trained on windows of ordinary text.
* The toxic dictionary is not trained on whole toxic text, most of whose words are ordinary. A list replaces it: the
  words that toxic documents have more often than chance explains and ordinary documents lack. Copies count once there:
  of documents of a class whose three-word runs have the same least hash, as copies and most near copies do, one is
  counted, since the words of a document that is copied often would pass for words of many. Training arranges them
  by how often they occur, and each listed word that it leaves out is added, so the dictionary holds the whole list.
  The list is laid behind the ordinary content, so both dictionaries compress ordinary text alike; the ordinary one
  gets filler of the same size there. Toxic phrases of ordinary words are not found.
* A text is cut into windows of about ``WINDOW`` bytes at white space, all of it. Each window is compressed with both
  dictionaries, and the difference in length is its evidence. Matches start at ``MIN_MATCH`` bytes, so chance
  matches of syllables count little.
* A logistic curve over a few statistics of the windows, fitted to labelled documents, gives a score from 0 to 1.

Learned from a bounded sample of labelled documents: at most ``TOXIC_DOCS`` and ``ORDINARY_DOCS`` of them, by a hash of
their id, at most ``LEXICON`` words and ``WINDOWS`` windows of those. Every document is scored in full. Scoring works
row by row; of documents only words and short windows of the sample are ever moved.

A null or empty text has no windows and gets the score of a text without evidence. Ids with contradictory labels teach
nothing, nor do null labels or null ids; repeated equal labels count once. With one class only, or no labels, every
score is the share of toxic labels (0 without labels). Null ids and repeated rows are scored like others; extra columns
pass through.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import lru_cache

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .tables import ship, staged

FOLDS = 5
TOXIC_DOCS = 4_000
ORDINARY_DOCS = 12_000
LEXICON = 4_000
WINDOWS = 20_000
WINDOW = 250
MIN_MATCH = 6
#: Sizes of the dictionaries in bytes; the toxic content is at least so large, and grows with the list.
ORDINARY_BYTES, TOXIC_BYTES = 16_384, 1_024
#: A word of the toxic dictionary occurs so many times more often in toxic documents than elsewhere.
LEAST_RATIO = 20.0
#: Words expected on the list by chance alone: the probability of a listed word's split, had chance dealt its documents
#: to the two classes, is at most this over the number of words that could be listed.
CHANCE_WORDS = 5
#: Around a word, so that it is trained as a whole.
_STRIPPED = b".,;:!?|#*$%&()\"'"
#: Where the content of a trained dictionary begins: after its three starting offsets. Fixed value.
_OFFSETS = bytes.fromhex("01000000" "04000000" "08000000")


@dataclass(frozen=True)
class Model:
    """Dictionaries, and the curve: means, scales and weights of the statistics, bias last."""

    ordinary: bytes
    toxic: bytes
    means: tuple[float, ...]
    scales: tuple[float, ...]
    weights: tuple[float, ...]


def windows(text: bytes, size: int = WINDOW) -> list[bytes]:
    """The words of a text in runs of at most ``size`` bytes, one word at least."""
    found, words, held = [], [], 0
    for word in text.lower().split():
        if words and held + len(word) + 1 > size:
            found.append(b" %b " % b" ".join(words))
            words, held = [], 0
        words.append(word)
        held += len(word) + 1
    if words:
        found.append(b" %b " % b" ".join(words))
    return found


@lru_cache(maxsize=8)
def _compressor(dictionary: bytes):
    import zstandard as zstd

    log = max(15, len(dictionary).bit_length() + 1)  # the search tree has places for the whole dictionary
    parameters = zstd.ZstdCompressionParameters(
        window_log=max(17, log), hash_log=15, chain_log=log, search_log=6, min_match=MIN_MATCH, target_length=64,
        strategy=zstd.STRATEGY_BTOPT, write_content_size=False, write_checksum=False, write_dict_id=False,
    )
    return zstd.ZstdCompressor(dict_data=zstd.ZstdCompressionDict(dictionary), compression_params=parameters)


def evidence(text: bytes, ordinary: bytes, toxic: bytes) -> np.ndarray:
    """Per window: bytes that the toxic dictionary saves over the ordinary one."""
    plain, other = _compressor(ordinary).compress, _compressor(toxic).compress
    return np.array([len(plain(w)) - len(other(w)) for w in windows(text)], dtype=np.float64)


def statistics(saved: np.ndarray) -> list[float]:
    if not len(saved):
        return [0.0] * 9
    high = np.sort(saved)[::-1]
    shares = [float((saved >= k).mean()) for k in (2, 3, 4, 5)]
    return [float(saved.mean()), float(high[0]), float(high[:3].mean()), float(high[:6].mean()), *shares,
            float(np.log1p((saved >= 4).sum()))]


def held_out(doc_id: Column, folds: int = FOLDS) -> Column:
    fold = F.crc32(doc_id.cast("string").cast("binary")) % folds
    return F.coalesce(fold == 0, F.lit(False))


def clear_labels(labels: DataFrame) -> DataFrame:
    """doc_id and toxic, one row per id, without contradictions and without the held-out fold."""
    return (
        labels.filter(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
        .groupBy("doc_id")
        .agg(F.min("toxic").alias("toxic"), F.max("toxic").alias("high"))
        .filter(F.col("toxic") == F.col("high"))
        .select("doc_id", "toxic")
    )


def labelled_sample(clear: DataFrame, toxic_docs: int = TOXIC_DOCS, ordinary_docs: int = ORDINARY_DOCS) -> DataFrame:
    """At most so many rows per class, by a hash of their id."""
    order = F.xxhash64("doc_id")
    parts = [clear.filter(F.col("toxic") == y).orderBy(order, "doc_id").limit(n) for y, n in ((1, toxic_docs), (0, ordinary_docs))]
    return parts[0].unionByName(parts[1])


def _words(texts):
    import pyarrow as pa

    from .tables import utf8

    found = []
    for text in utf8(texts):
        words = {w.strip(_STRIPPED) for w in text.lower().split()} - {b""}
        found.append([w.decode("utf-8", "replace") for w in sorted(words) if len(w) <= 60])
    return pa.array(found, pa.list_(pa.string()))


def _signatures(texts):
    """The least hash of a text's runs of three words; of all its words, if there are fewer. Without words null."""
    import pyarrow as pa

    from .tables import utf8
    from .words import run_hashes, word_hashes

    found = []
    for text in utf8(texts):
        words = word_hashes([text], lower=True)[0]
        runs = run_hashes(words, min(3, len(words))) if len(words) else words
        found.append(int(runs.min().view("i8")) if len(runs) else None)
    return pa.array(found, pa.int64())


def _windows_of(most: int):
    """At most so many short windows of each text, by a checksum."""

    def of(texts):
        import zlib

        import pyarrow as pa

        from .tables import utf8

        found = [sorted(set(windows(t, 100)), key=lambda w: (zlib.crc32(w), w))[:most] for t in utf8(texts)]
        return pa.array(found, pa.list_(pa.binary()))

    return of


def train_dictionaries(ordinary_windows: list[bytes], lexicon: list[tuple[str, int]]) -> tuple[bytes, bytes]:
    """The two dictionaries, equal but for the toxic content (or filler of its size) at the end."""
    base, _ = _trained(ordinary_windows, ORDINARY_BYTES)
    total = sum(n for _, n in lexicon) or 1
    uses = [w.encode() for w, n in lexicon for _ in range(max(1, min(n, n * 80_000 // total)))]
    np.random.default_rng(0).shuffle(uses)
    groups = [b" %b " % b" ".join(uses[i : i + 4]) for i in range(0, len(uses), 4)]
    _, content = _trained(groups, max(TOXIC_BYTES, sum(2 * (len(w.encode()) + 1) for w, _ in lexicon)))
    held = set(content.split())
    left = [w for w, _ in reversed(lexicon) if w.encode() not in held]
    if left:
        content = b" %b " % " ".join(left).encode() + content
    return base + (b"\xff\xfe\xfd" * len(content))[: len(content)], base + content


def _trained(samples: list[bytes], size: int) -> tuple[bytes, bytes]:
    """A trained dictionary and its content; too few samples are their own dictionary."""
    import zstandard as zstd

    try:
        whole = zstd.train_dictionary(size, samples).as_bytes()
        return whole, whole[whole.index(_OFFSETS) + len(_OFFSETS) :]
    except (zstd.ZstdError, ValueError):
        joined = b"".join(dict.fromkeys(samples))[-size:].rjust(16)
        return joined, joined


def _fit_curve(x: np.ndarray, y: np.ndarray) -> tuple[tuple[float, ...], ...]:
    """Logistic regression by Newton steps, with a small penalty on the weights."""
    means, scales = x.mean(0), x.std(0) + 1e-9
    a = np.column_stack([(x - means) / scales, np.ones(len(x))])
    weights, penalty = np.zeros(a.shape[1]), np.eye(a.shape[1])
    penalty[-1, -1] = 1e-6
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(a @ weights, -30, 30)))
        hessian = (a * (p * (1 - p))[:, None]).T @ a + penalty
        weights = weights - np.linalg.solve(hessian, a.T @ (p - y) + penalty @ weights)
    return tuple(map(float, means)), tuple(map(float, scales)), tuple(map(float, weights))


def fit(docs: DataFrame, labels: DataFrame, toxic_docs: int = TOXIC_DOCS, ordinary_docs: int = ORDINARY_DOCS) -> Model:
    """Learn dictionaries and curve from labelled documents outside the held-out fold."""
    ship(docs.sparkSession)
    spark = docs.sparkSession
    clear = clear_labels(labels.select("doc_id", "toxic"))
    chosen = labelled_sample(clear, toxic_docs, ordinary_docs).collect()  # bounded
    share = clear.agg(F.avg("toxic")).first()[0] or 0.0
    if share in (0.0, 1.0):
        bias = 30.0 if share else -30.0
        return Model(b" " * 16, b" " * 16, (0.0,) * 9, (1.0,) * 9, (*(0.0,) * 9, bias))
    sample = spark.createDataFrame([(r["doc_id"], r["toxic"]) for r in chosen], labels.select("doc_id", "toxic").schema)
    # At most ``toxic_docs + ordinary_docs`` ids are broadcast; documents stay where they are.
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(F.broadcast(sample), "doc_id")

    words, signature = F.arrow_udf(_words, "array<string>")("text"), F.arrow_udf(_signatures, "bigint")("text")
    # Copies count once, texts without words each; a row per sampled document at most.
    distinct = (
        texts.select("doc_id", "toxic", words.alias("words"), signature.alias("signature"))
        .groupBy("toxic", F.coalesce("signature", F.xxhash64("doc_id")).alias("signature"))
        .agg(F.min("words").alias("words"))
        .select("toxic", "words")
    )
    distinct = staged(distinct, "distinct")
    sizes = {r["toxic"]: r["count"] for r in distinct.groupBy("toxic").count().collect()}
    toxic_texts, ordinary_texts = max(1, sizes.get(1, 0)), max(1, sizes.get(0, 0))
    counted = (
        distinct.select("toxic", F.explode("words").alias("word"))
        .groupBy("word")
        .agg(F.sum("toxic").alias("toxic"), F.sum(1 - F.col("toxic")).alias("ordinary"))
        .filter("toxic + ordinary > 1")
    )
    counted = staged(counted, "words")
    chance = CHANCE_WORDS / max(CHANCE_WORDS, counted.count())
    rate, other = F.col("toxic") / toxic_texts, F.col("ordinary") / ordinary_texts
    # Chernoff's bound on the tail of the binomial distribution, as a logarithm.
    n, share_toxic = F.col("toxic") + F.col("ordinary"), toxic_texts / (toxic_texts + ordinary_texts)
    surprise = F.col("toxic") * F.log(F.col("toxic") / (n * share_toxic)) + F.when(
        F.col("ordinary") > 0, F.col("ordinary") * F.log(F.col("ordinary") / (n * (1 - share_toxic)))
    ).otherwise(0.0)
    lexicon = (
        counted.filter((rate > LEAST_RATIO * other) & (surprise >= -float(np.log(chance))))
        .orderBy(F.desc("toxic"), "word")
        .limit(LEXICON)
        .collect()
    )
    # Twice the windows wanted, over all ordinary documents: a bound on what the tasks send, whatever their number.
    each = -(-2 * WINDOWS // sum(1 - r["toxic"] for r in chosen))
    piece = F.explode(F.arrow_udf(_windows_of(each), "array<binary>")("text")).alias("piece")
    pieces = texts.filter("toxic = 0").select(piece).orderBy(F.xxhash64("piece"), "piece").limit(WINDOWS).collect()
    ordinary, toxic = train_dictionaries([bytes(r["piece"]) for r in pieces], [(r["word"], r["toxic"]) for r in lexicon])

    facts = F.arrow_udf(_statistics_of(ordinary, toxic), "array<double>")("text").alias("x")
    known = texts.select("doc_id", "toxic", facts).orderBy(F.xxhash64("doc_id"), "doc_id").collect()
    if not known:
        return Model(ordinary, toxic, (0.0,) * 9, (1.0,) * 9, (*(0.0,) * 9, float(np.log(share / (1 - share)))))
    is_toxic = np.array([float(r["toxic"]) for r in known])
    means, scales, weights = _fit_curve(np.array([r["x"] for r in known]), is_toxic)
    # The sample holds more toxic documents than the labels: move the curve back to their share.
    held = min(max(is_toxic.mean(), 1e-6), 1 - 1e-6)
    bias = weights[-1] + float(np.log(share / (1 - share)) - np.log(held / (1 - held)))
    return Model(ordinary, toxic, means, scales, (*weights[:-1], bias))


def _statistics_of(ordinary: bytes, toxic: bytes):
    def of(texts):
        import pyarrow as pa

        from .tables import utf8

        return pa.array([statistics(evidence(t, ordinary, toxic)) for t in utf8(texts)], pa.list_(pa.float64()))

    return of


def score(docs: DataFrame, model: Model, text: str = "text", name: str = "score") -> DataFrame:
    """Add the score of each text, from 0 to 1, as column ``name``."""
    ship(docs.sparkSession)

    def of(texts):
        import pyarrow as pa

        from .tables import utf8

        weights, means, scales = np.array(model.weights), np.array(model.means), np.array(model.scales)
        found = []
        for t in utf8(texts):
            x = (np.array(statistics(evidence(t, model.ordinary, model.toxic))) - means) / scales
            found.append(1 / (1 + np.exp(-np.clip(x @ weights[:-1] + weights[-1], -30, 30))))
        return pa.array(found, pa.float64())

    return docs.withColumn(name, F.arrow_udf(of, "double")(F.coalesce(F.col(text), F.lit(""))))


def query(docs: DataFrame, labels: DataFrame) -> DataFrame:
    scored = score(docs.select("doc_id", "text"), fit(docs, labels))
    predicted = F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted")
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", predicted)
