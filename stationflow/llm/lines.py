"""Line-first cleaning: judge lines, remove those that fail, then reject documents that lose too much.

A line fails if it is

* shouted: mostly capitals with doubled exclamation marks,
* navigation: short entries between separators,
* symbol noise: many of its words carry symbols,
* stuttered: one word is said ``STUTTERS`` times or more, in a row or as most of its words,
* boilerplate: a licence, copyright, cookie or script notice,
* a repeat of an earlier line.

Whether a line ends in terminal punctuation is a weaker sign: it makes a line fail only where it is also long enough
to be prose (``UNENDED_WORDS``) and has no sentence end anywhere.

A document is rejected if the lines it loses hold more than ``MOST_LOST`` percent of its words, or by the base rules:
fewer than ``FEWEST_WORDS`` words, or more than ``MOST_REPEATED`` percent of its words in repeated windows of
``WINDOW`` words. Rules look at one row, so nothing moves between tasks and no line is compared with other documents.

Null and empty texts have no words and are rejected. Null ids, repeated rows and extra columns pass through. Repeats
are found by sorting hashes of 64 bits, so the work is n log n for n words. Only DataFrame functions are used.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .tables import free_name

WINDOW = 8  # a power of two, see repeated_words
FEWEST_WORDS = 20
MOST_REPEATED = 30
MOST_LOST = 50
UNENDED_WORDS = 60
STUTTERS = 4
WORD = r"[^\x20\x09-\x0D]+"
SYMBOLS = "#*$%&|<>"
#: Phrases of notices that are not part of a text, in lower case.
NOTICES = (
    "licensed under the", "all rights reserved", "copyright (c)", "©", "spdx-license", "terms of service",
    "terms of use", "privacy policy", "use cookies", "uses cookies", "accept cookies", "enable javascript",
    "lorem ipsum", "click here", "subscribe to our", "sign up for",
)
SEPARATORS = "|»›·•"
#: Symbols that prose doubles nowhere.
DOUBLED = ("##", "**", "$$", "%%", "&&", "<<", ">>")


def _any(text: Column, phrases: Iterable[str]) -> Column:
    return reduce(lambda a, b: a | b, [text.contains(p) for p in phrases])


def _count(line: Column, pattern: str) -> Column:
    return F.regexp_count(line, F.lit(pattern))


def _stuttered(line: Column) -> Column:
    """Whether a word is said ``STUTTERS`` times or more, in a row or more often than all others together.

    Equal words stand together in sorted order, so a word that makes up most of the words holds the middle place.
    """

    def judged(words: Column) -> Column:
        def said(word: Column) -> Column:
            return F.size(F.filter(words, lambda w: w == word))

        middle = F.get(F.array_sort(words), F.floor(F.size(words) / 2).cast("int"))

        def again(w: Column, i: Column) -> Column:
            return reduce(lambda a, b: a & b, [F.get(words, i + k).eqNullSafe(w) for k in range(1, STUTTERS)])

        in_a_row = F.exists(F.transform(words, again), lambda x: x)
        few = F.size(F.array_distinct(words)) <= F.size(words) - (STUTTERS - 1)
        return few & (in_a_row | _let(_let(middle, said), lambda n: (n >= STUTTERS) & (2 * n > F.size(words))))

    return _let(F.regexp_extract_all(line, F.lit(WORD), F.lit(0)), judged)


def line_fails(line: Column) -> Column:
    """Judge one line that has a word. Plain searches come first; the costly tests see only lines that need them."""
    shouted = line.contains("!!") & (100 * _count(line, r"[^\x20\x09-\x0Da-z]*!!") > 40 * _count(line, WORD))
    between = _count(line, rf"(?<!\S)[{SEPARATORS}](?!\S)")
    navigation = _any(line, SEPARATORS) & (between >= 3) & (100 * between > 20 * _count(line, WORD))
    noise = _any(line, DOUBLED) & (100 * _count(line, r"[#*$%&<>]{2,}(?!\S)") > 40 * _count(line, WORD))
    stuttered = _stuttered(line)
    notice = _any(F.lower(line), NOTICES)
    unended = ~line.rlike(r"[.!?…:;。！？]") & (_count(line, WORD) >= UNENDED_WORDS)
    return shouted | navigation | noise | stuttered | unended | notice


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once per row, also where lambdas of ``body`` refer to it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def repeated_words(words: Column) -> Column:
    """Words inside windows of ``WINDOW`` words that are found twice or more, the first one included."""

    def paired(step: int) -> Callable[[Column], Column]:
        def pairs(h: Column) -> Column:
            rest = F.greatest(F.size(h) - step, F.lit(0))
            return F.zip_with(F.slice(h, 1, rest), F.slice(h, step + 1, rest), lambda a, b: F.xxhash64(a, b))

        return pairs

    def hashes(w: Column) -> Column:
        # Hashes of 2, 4 and then 8 words, each from two of the half length.
        value = F.transform(w, lambda x: F.xxhash64(x))
        for step in (1 << i for i in range(WINDOW.bit_length() - 1)):
            value = _let(value, paired(step))
        return value

    def placed(h: Column) -> Column:
        return F.array_sort(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("at"))))

    def covered(h: Column) -> Column:
        # Without a repeat there is nothing to sort.
        found = _let(_let(placed(h), _twins), _reach)
        return F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(found)

    return F.when(F.size(words) <= WINDOW, F.lit(0)).otherwise(_let(_let(words, hashes), covered))


def _twins(windows: Column) -> Column:
    """Places of the windows whose hash stands next to an equal one, in order."""

    def twin(x: Column, i: Column) -> Column:
        same_before = F.coalesce(F.get(windows, i - 1)["h"] == x["h"], F.lit(False))
        return same_before | F.coalesce(F.get(windows, i + 1)["h"] == x["h"], F.lit(False))

    return F.array_sort(F.transform(F.filter(windows, twin), lambda x: x["at"]))


def _reach(places: Column) -> Column:
    """Words covered by windows at these places."""
    whole = F.lit(WINDOW)
    gaps = F.transform(places, lambda p, i: F.least(F.coalesce(F.get(places, i + 1) - p, whole), whole))
    return F.aggregate(gaps, F.lit(0), lambda total, gap: total + gap)


def judge(docs: DataFrame, text: str = "text") -> DataFrame:
    """Add the base counts, the cleaned text and the verdict.

    ``n_words``, ``word_chars``, ``n_symbols``, ``n_dup_lines``, ``n_repeat_words``, ``base_failed``, ``n_lost_words``
    (words of the removed lines), ``cleaned`` (the lines that stay) and ``kept``. Columns of these names are replaced.
    """
    whole = F.coalesce(F.col(text), F.lit(""))
    words, lines = free_name(docs, "words"), free_name(docs, "lines")
    repeats = free_name(docs, "repeats")
    good = F.filter(F.array_distinct(F.col(lines)), lambda line: ~line_fails(line))
    n_words, n_repeat = F.col("n_words"), F.col("n_repeat_words")
    counted = docs.withColumns(
        {
            words: F.regexp_extract_all(whole, F.lit(WORD), F.lit(0)),
            lines: F.filter(F.split(whole, "\n", -1), lambda line: line.rlike(WORD)),
        }
    ).withColumns(
        {
            "n_words": F.size(words).cast("bigint"),
            "word_chars": F.length(F.array_join(words, "")).cast("bigint"),
            "n_symbols": (F.length(whole) - F.length(F.translate(whole, SYMBOLS, ""))).cast("bigint"),
            "n_dup_lines": (F.size(lines) - F.size(F.array_distinct(lines))).cast("bigint"),
            repeats: repeated_words(F.col(words)).cast("bigint"),
        }
    )
    cleaned = counted.withColumns({"n_repeat_words": F.col(repeats), "cleaned": F.array_join(good, "\n")})
    return (
        cleaned.drop(words, lines, repeats)
        .withColumns(
            {
                "base_failed": (n_words < FEWEST_WORDS) | (100 * n_repeat > MOST_REPEATED * n_words),
                "n_lost_words": n_words - _count(F.col("cleaned"), WORD),
            }
        )
        .withColumn("kept", ~F.col("base_failed") & (100 * F.col("n_lost_words") <= MOST_LOST * n_words))
    )


def query(docs: DataFrame) -> DataFrame:
    """The base counts and the verdict of each document."""
    judged = judge(docs.select("doc_id", "text"))
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        "n_lost_words",
    )
