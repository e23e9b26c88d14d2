"""T-occurrence join, importance resampling and source divergence against brute force."""

import hashlib
import heapq
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import types as T

from stationflow.llm import components, divergence, importance, overlap_join, tables
from stationflow.llm.overlap_join import Rule, forest, merge_skip

WORD = re.compile(r"[^\x20\x09-\x0D]+")
ASCII_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


# --- overlap join ----------------------------------------------------------------------------------------------------


def shingles(text, n):
    words = WORD.findall((text or "").translate(ASCII_LOWER))
    return frozenset([tuple(words)] if 0 < len(words) < n else [tuple(words[i : i + n]) for i in range(len(words) - n + 1)])


def linked(rows, rule):
    """(id, size, component) of each row; rows of one id are one vertex."""
    parent = {i: i for i, _ in rows if i is not None}

    def root(v):
        while parent[v] != v:
            v = parent[v]
        return v

    sets = [(i, shingles(t, rule.words)) for i, t in rows]
    for x, (a, s) in enumerate(sets):
        for b, t in sets[x + 1 :]:
            both = len(s & t)
            if None not in (a, b) and both and 100 * both >= rule.percent * (len(s) + len(t) - both):
                ra, rb = root(a), root(b)
                parent[max(ra, rb)] = min(ra, rb)
    return sorted((str(i), len(s), None if i is None else root(i)) for i, s in sets)


def joined(docs, rule):
    return sorted((str(r.doc_id), r.n_shingles, r.component_id) for r in overlap_join.join(docs, rule).collect())


def versions(prose, n, edits, seed=8, size=90):
    rng = random.Random(seed)
    base = prose(5 + seed, size).split()
    for _ in range(n):
        words = list(base)
        for _ in range(rng.randrange(0, edits)):
            words[rng.randrange(len(words))] = f"n{rng.random()}"
        yield " ".join(words)


ODD = [(1, None), (2, ""), (3, " \n"), (4, "two words"), (5, "TWO\twords"), (6, "two words!"), (8, "É a b c"), (9, "é a b c")]


@pytest.mark.parametrize("rule", [Rule(4, 85), Rule(5, 80)])
def test_links_are_those_of_brute_force(make_docs, prose, rule):
    rows = ODD + [(100 + i, prose(i, 40)) for i in range(8)] + [(7, prose(3, 40).upper()), (90, prose(3, 40))]
    rows += [(200 + i, t) for i, t in enumerate(versions(prose, 60, 7))]
    assert joined(make_docs(rows), rule) == linked(rows, rule)


def test_any_bounds_give_the_same_links(make_docs, prose, monkeypatch):
    """Tiny parts, buckets, filters and heaps, and every shingle of three sets a long list."""
    rows = ODD + [(300 + i, t) for i, t in enumerate(versions(prose, 50, 9, seed=2))]
    rows += [(500 + i, t + " " + prose(77, 30)) for i, t in enumerate(versions(prose, 15, 4, seed=4, size=50))]
    random.Random(1).shuffle(rows)
    expected = linked(rows, Rule(4, 85))
    changes = {
        "parts": {"GROUP_BYTES": 3000, "PIVOTS": 2},
        "parts without pivots": {"GROUP_BYTES": 1500, "PIVOTS": 0},
        "buckets": {"BUCKET_BYTES": 500, "TOGETHER": 2000, "SLICE": 700},
        "long lists": {"LONG_IN_TASK": 3, "LONG_LISTS": 10_000, "LONG_SHARE": 0.0},
        "some long lists": {"LONG_IN_TASK": 2, "LONG_LISTS": 40, "LONG_SHARE": 0.0},
        "no heap": {"HEAP": 0, "FILTER_BITS": 64},
    }
    for change in changes.values():
        with monkeypatch.context() as patched:
            for name, value in change.items():
                patched.setattr(overlap_join, name, value)
            assert joined(make_docs(rows), Rule(4, 85)) == expected, change


def test_repeated_and_null_ids(make_docs, prose):
    a, b = prose(1, 60), prose(2, 60)
    rows = [(5, a), (2, a), (5, b), (9, b), (9, b), (None, a), (None, None), (7, None), (7, prose(3, 60)), (8, prose(3, 60) + " x")]
    assert joined(make_docs(rows), Rule(4, 85)) == linked(rows, Rule(4, 85))


def test_join_of_an_empty_table(make_docs):
    assert overlap_join.query(make_docs([])).count() == 0
    assert joined(make_docs([(1, None)]), Rule()) == [("1", 0, 1)]


@pytest.fixture
def plans(monkeypatch):
    """Plans of all tables that the join and its components store, as their actions see the settings."""
    seen, plain = [], tables.staged

    def told(df, *args, **named):
        seen.append(df._jdf.queryExecution().executedPlan().toString())
        return plain(df, *args, **named)

    monkeypatch.setattr(components, "staged", told)
    monkeypatch.setattr(overlap_join, "staged", told)
    return seen


def test_components_keep_large_tables_out_of_the_driver(spark, plans):
    """Tables of 400,000 vertices are 1 to 4 MB of files, which Spark would broadcast by default."""
    links = spark.range(400_000).selectExpr("id + 1000 a", "id % 200000 + 1000 b")
    found = components.components(links)
    assert [tuple(r) for r in found.selectExpr("count(*)", "sum(component - 1000 - (id - 1000) % 200000)").collect()] == [(400_000, 0)]
    assert sum("Join" in p for p in plans) >= 3
    assert not any("BroadcastHashJoin" in p for p in plans)


def test_join_broadcasts_nothing_that_grows(make_docs, prose, plans, monkeypatch):
    """With no table small enough only the filter of the texts, a bitmap, is left; parts and pairs of parts included."""
    monkeypatch.setattr(tables, "BROADCAST_BYTES", 0, raising=False)
    monkeypatch.setattr(overlap_join, "GROUP_BYTES", 3000)
    monkeypatch.setattr(overlap_join, "PIVOTS", 0)
    rows = ODD + [(300 + i, t) for i, t in enumerate(versions(prose, 30, 9, seed=2))]
    assert joined(make_docs(rows), Rule(4, 85)) == linked(rows, Rule(4, 85))
    broadcast = [line for p in plans for line in p.splitlines() if "BroadcastHashJoin" in line]
    assert len(broadcast) == 2 and all("[word#" in line for line in broadcast)


def test_small_broadcasts_lower_larger_settings_only(spark):
    fixed, adaptive = tables._BROADCASTS
    before = spark.conf.get(fixed)
    try:
        for value, expected in (("10MB", "262144"), ("-1", "-1"), ("1k", "1k")):
            spark.conf.set(fixed, value)
            spark.conf.set(adaptive, value)
            with pytest.raises(ZeroDivisionError), tables.small_broadcasts(spark):
                assert spark.conf.get(fixed) == spark.conf.get(adaptive) == expected
                1 / 0
            assert spark.conf.get(fixed) == spark.conf.get(adaptive) == value
        spark.conf.unset(adaptive)
        spark.conf.unset(fixed)
        default = spark.conf.get(fixed)
        with tables.small_broadcasts(spark):
            assert (spark.conf.get(fixed), spark.conf.get(adaptive, None)) == ("262144", None)
        assert spark.conf.get(fixed) == default
    finally:
        spark.conf.unset(adaptive)
        spark.conf.set(fixed, before)


def test_merge_skip_counts_lists():
    rng = random.Random(5)
    for _ in range(200):
        lists = [sorted(rng.sample(range(30), rng.randrange(0, 20))) for _ in range(rng.randrange(1, 12))]
        times = Counter(heapq.merge(*lists))
        for needed in range(1, len(lists) + 1):
            assert dict(merge_skip(lists, needed)) == {v: n for v, n in times.items() if n >= needed}


@pytest.mark.parametrize("heap", [0, 4096])
def test_forest_connects_what_is_linked(heap, monkeypatch):
    monkeypatch.setattr(overlap_join, "HEAP", heap)
    rng = random.Random(6)
    for percent in (50, 80, 85, 100):
        base = [sorted(rng.sample(range(400), 60)) for _ in range(4)]
        sets = []
        for _ in range(70):
            s = set(rng.choice(base))
            for _ in range(rng.randrange(0, 12)):
                s.discard(rng.choice(sorted(s)))
                s.add(rng.randrange(400))
            sets.append(np.array(sorted(s), np.uint64))
        plain = [set(s.tolist()) for s in sets]
        links = {(i, j) for i in range(70) for j in range(i) if 100 * len(plain[i] & plain[j]) >= percent * len(plain[i] | plain[j])}

        def pieces(pairs):
            label = list(range(70))
            for i, j in pairs:
                label = [label[i] if x == label[j] else x for x in label]
            return sorted(sorted(i for i in range(70) if label[i] == x) for x in set(label))

        found = forest(sets, percent)
        assert all(p in links or p[::-1] in links for p in found) and len(found) < 70
        assert pieces(found) == pieces(links)


# --- importance resampling -------------------------------------------------------------------------------------------

TOKEN = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def runs(text):
    words = TOKEN.findall((text or "").translate(ASCII_LOWER))
    return len(words), [" ".join(words[i : i + k]) for k in (1, 2, 3) for i in range(len(words) - k + 1)]


def resampled(rows, target, percent=5):
    hashed = [(i, *runs(t)) for i, t in rows]
    bucket = lambda f: zlib.crc32(f.encode()) % 10000
    s = Counter(bucket(f) for _, _, fs in hashed for f in fs)
    t = Counter(bucket(f) for x in target for f in runs(x)[1])
    total, aimed = sum(s.values()), sum(t.values())
    gain = {b: math.floor(1000 * math.log((t[b] + 1) * (total + 10000) / ((s[b] + 1) * (aimed + 10000)))) for b in s}
    out = []
    for i, n, fs in hashed:
        h = int(hashlib.sha256(f"42:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        weight = sum(gain[bucket(f)] for f in fs)
        out.append((i, n, len(fs), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))))
    able = sorted((-r[4], r[0] is not None, r[0]) for r in out if r[1] >= 20)
    rank = {k: p for p, k in enumerate(able[: percent * len(able) // 100], 1)}
    return sorted((str(r[0]), *r[2:], rank.get((-r[4], r[0] is not None, r[0])) if r[1] >= 20 else None) for r in out)


def scored(docs, target, percent=5):
    draw = importance.Draw(percent=percent)
    return sorted((str(r.doc_id), r.n_features, r.weight, r.score, r.rank) for r in importance.scored(docs, target, draw).collect())


TEXTS = ["Ünï-cödé  words,and 12a3 É é\x00nul", "x" * 70 + " b " + "y" * 64 + " " + "z" * 65, "a", "a b", "", None, ", . !", "🙂 ok🙂"]


@pytest.mark.parametrize("block", [4, 1000])
def test_resampling(spark, make_docs, monkeypatch, block):
    monkeypatch.setattr(importance, "ROWS_PER_BLOCK", block)
    rng = random.Random(11)
    words = [f"w{i}" for i in range(50)] + ["Ab", "éa", "the", "q" * 66]
    rows = list(enumerate(TEXTS)) + [(None, " ".join(words[:30]))]
    rows += [(100 + i, " ".join(rng.choices(words, k=rng.randrange(0, 60)))) for i in range(60)]
    target = [" ".join(rng.choices(words[:9], k=40)) for _ in range(5)] + [None, ""]
    goal = spark.createDataFrame([(t, "x") for t in target], "text string, weight string")
    assert scored(make_docs(rows), goal, 30) == resampled(rows, target, 30)


def test_pieces_and_slices_do_not_matter(monkeypatch):
    text = " ".join(["é" * 40, "ab-cd", "x" * 200, "q"] * 30).encode()
    whole = importance.word_offsets(text).tolist()
    assert [text[a:b].decode() for a, b in whole] == TOKEN.findall(text.decode())
    for size in (1, 7, 64, 333):
        monkeypatch.setattr(importance, "PIECE", size)
        assert importance.word_offsets(text).tolist() == whole


def test_buckets_are_checksums():
    found, counts = importance.buckets([(t or "").encode() for t in TEXTS])
    for t, values, n in zip(TEXTS, found, counts, strict=True):
        assert n == runs(t)[0]
        assert sorted(values.tolist()) == sorted(zlib.crc32(f.encode()) % 10000 for f in runs(t)[1])
    assert importance.buckets([b""])[1].tolist() == [0]


def test_resample_returns_whole_documents(spark, make_docs):
    rows = [(i % 30, f"word{i % 3} " * 25) for i in range(60)] + [(3, None), (99, "short")]
    docs = make_docs(rows)
    goal = spark.createDataFrame([("word1 " * 30,)], "text string")
    drawn = importance.resample(docs, goal, importance.Draw(percent=50))
    assert drawn.columns == docs.columns and 30 <= drawn.count() < 62
    assert {r.doc_id for r in drawn.collect()} <= {i for i, t in rows if t and len(t) > 60}
    assert importance.query(docs.limit(0), goal).count() == 0
    assert importance.query(docs, goal.limit(0)).count() == 62


# --- source divergence -----------------------------------------------------------------------------------------------

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
GROUPS = T.StructType([T.StructField(c, T.StringType()) for c in ("lang", "source", "text", "term", "n", "Value", "shard")])


def audited(rows, min_docs, top):
    counts, docs, groups = defaultdict(Counter), defaultdict(Counter), set()
    for lang, source, text in rows:
        lang, source = lang or "", source or ""
        terms = TERM.findall((text or "").translate(ASCII_LOWER))
        groups.add((lang, source))
        counts[lang, source].update(terms)
        docs[lang].update(set(terms))
    out = []
    for lang, source in groups:
        kept = [t for t, n in docs[lang].items() if n >= min_docs]
        sources = [s for x, s in groups if x == lang]

        def share(count, total):
            return 1 + 1000000000 * (count + 5) // (total + 5 * len(kept))

        def shares(names):
            n = {t: sum(counts[lang, s][t] for s in names) for t in kept}
            return n, {t: share(n[t], sum(n.values())) for t in kept}

        n, p = shares([source])
        q = shares(sources)[1]
        pairs = [(sum(abs(p[t] - r[t]) for t in kept), s) for s in sources if s != source for r in [shares([s])[1]]]
        terms = [(p[t] - q[t], t) for t in kept if n[t] > 0 and p[t] > q[t]]
        for part, found, most in (("pair", pairs, len(pairs)), ("term", terms, top)):
            found.sort(key=lambda x: (-x[0], x[1].encode()))
            out += [(lang, source, part, item, v, k) for k, (v, item) in enumerate(found[:most], 1)]
    return sorted(out)


def divergence_rows(n=200, sources=9, seed=3):
    rng = random.Random(seed)
    words = [f"w{'abcdefghij'[i % 10] * (i // 10 + 1)}" for i in range(60)] + ["Über", "über", "É", "é", "l" * 30, "l" * 31, "l" * 300]
    rows = [("en", None, "Some words"), (None, "s1", None), (None, "", "x1y-z"), ("de", "only", ""), ("en", "s0", "é" * 2000)]
    for _ in range(n):
        of = rng.randrange(sources)
        text = rng.choice([" ", "-", "1"]).join(rng.choices(words[of : of + 30], k=rng.randrange(0, 50)))
        rows.append((rng.choice(["en", "en", "de"]), f"s{of}", text))
    return rows


@pytest.mark.parametrize("change", [{}, {"SOURCES": 2, "SHARD_ROWS": 40, "_CELLS": 16}, {"SLICE": 400, "_SMALL": 4, "_CHUNKS": 1}])
def test_divergence(spark, monkeypatch, change):
    for name, value in change.items():
        monkeypatch.setattr(divergence, name, value)
    rows = divergence_rows()
    frame = spark.createDataFrame([(*r, "t", "5", "v", None) for r in rows], GROUPS).repartition(3)
    got = sorted(tuple(r) for r in divergence.audit(frame, min_docs=8, top=7).collect())
    assert got == audited(rows, 8, 7)


def test_divergence_without_kept_terms(spark):
    rows = divergence_rows(20)
    frame = spark.createDataFrame([(*r, "t", "5", "v", None) for r in rows], GROUPS)
    got = sorted(tuple(r) for r in divergence.query(frame).collect())
    assert got == audited(rows, 30, 50) and {r[4] for r in got} == {0}
    assert divergence.query(frame.limit(0)).count() == 0


def test_pointer_sort_is_a_stable_sort(monkeypatch):
    rng = random.Random(2)
    words = [bytes(rng.choices(b"abz\xc3\xa9", k=rng.choice([1, 2, 7, 8, 9, 15, 16, 17, 40, 130]))) for _ in range(300)]
    chosen = [rng.choice(words) for _ in range(4000)]
    data = np.frombuffer(b" ".join(chosen) + b" " + bytes(8), np.uint8)
    for small, chunks in ((1 << 14, 6), (3, 6), (100, 1), (1, 30), (600, 30)):
        monkeypatch.setattr(divergence, "_SMALL", small)
        monkeypatch.setattr(divergence, "_CHUNKS", chunks)
        starts, sizes = divergence.word_starts(data)
        order, begins = divergence.sort_pointers(data, starts, sizes)
        assert order.tolist() == sorted(range(len(chosen)), key=chosen.__getitem__)
        ordered = [chosen[i] for i in order]
        assert begins.tolist() == [i for i in range(len(ordered)) if i == 0 or ordered[i] != ordered[i - 1]]
    assert divergence.sort_pointers(np.zeros(8, np.uint8), np.zeros(0, np.int64), np.zeros(0, np.int64))[0].tolist() == []
