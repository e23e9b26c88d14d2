"""Operators that look at the whole corpus, against brute force on small tables."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from stationflow.llm import ann, mixing, odd_sketch, phrases, toxicity
from stationflow.llm.components import components
from stationflow.llm.words import run_hashes, word_hashes

WORD = re.compile(r"[^\x20\x09-\x0D]+")


# --- words and components --------------------------------------------------------------------------------------------


def test_word_hashes_agree_with_words():
    texts = [b"", b" ", b"a b\tc", b"A b", "é🙂 é🙂\x0b\x1cx".encode(), b"x" * 100, b"a" * 99 + b" b"]
    hashes, counts = word_hashes(texts)
    words = [w for t in texts for w in t.split()]
    assert counts.tolist() == [len(t.split()) for t in texts]
    assert len(set(zip(words, hashes.tolist()))) == len(set(words)) == len(set(hashes.tolist()))
    lower, _ = word_hashes(texts, lower=True)
    assert lower[0] == lower[3] != hashes[3]


def test_long_inputs_are_cut_at_spaces(monkeypatch):
    text = b" ".join(b"w%d" % (i % 50) for i in range(3000)) + b" " + b"y" * 500 + b" end"
    whole = word_hashes([text, b"z", text])
    monkeypatch.setattr("stationflow.llm.words.PIECE", 64)
    cut = word_hashes([text, b"z", text])
    assert (whole[0] == cut[0]).all() and (whole[1] == cut[1]).all()
    assert len(run_hashes(whole[0], 7)) == len(whole[0]) - 6
    assert len(run_hashes(whole[0][:3], 7)) == 0


def test_components(spark):
    rng = random.Random(4)
    links = [(i, i + 1) for i in range(100, 140)] + [(rng.randrange(60), rng.randrange(60)) for _ in range(35)]
    links += [(300, i) for i in range(301, 330)] + [(7, 7)]
    got = dict(components(spark.createDataFrame(links, "a long, b long")).collect())
    parent = {v: v for e in links for v in e}

    def root(v):
        while parent[v] != v:
            v = parent[v]
        return v

    for a, b in links:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    assert got == {v: root(v) for v in parent if v in got}
    assert set(got) == {v for a, b in links if a != b for v in (a, b)}


# --- near-duplicates -------------------------------------------------------------------------------------------------


def shingles(text, n):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = WORD.findall(lower)
    return frozenset([tuple(words)] if 0 < len(words) < n else [tuple(words[i : i + n]) for i in range(len(words) - n + 1)])


def linked(rows, rule):
    sets = {i: shingles(t, rule.words) for i, t in rows}
    parent = {i: i for i in sets}

    def root(v):
        while parent[v] != v:
            v = parent[v]
        return v

    ids = sorted(sets)
    for x, a in enumerate(ids):
        for b in ids[x + 1 :]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= rule.percent * (len(sets[a]) + len(sets[b]) - both):
                ra, rb = root(a), root(b)
                parent[max(ra, rb)] = min(ra, rb)
    return {i: (len(sets[i]), root(i)) for i in ids}


def near_copies(prose, n=60):
    rng = random.Random(8)
    base = prose(5, 90).split()
    rows = [(i, prose(i, 40)) for i in range(100, 110)]
    for i in range(n):  # some link with the base, some only with each other, some with nothing
        words = list(base)
        for _ in range(rng.randrange(0, 6)):
            words[rng.randrange(len(words))] = f"n{rng.random()}"
        rows.append((200 + i, " ".join(words)))
    return rows


@pytest.mark.parametrize("rule", [odd_sketch.Rule(3, 85), odd_sketch.Rule(5, 80)])
def test_near_duplicates(make_docs, prose, rule, monkeypatch):
    rows = near_copies(prose)
    rows += [(1, None), (2, ""), (3, " \n"), (4, "two words"), (5, "TWO\twords"), (6, "two words!"), (7, prose(100, 40).upper())]
    rows += [(8, "É a b"), (9, "é a b")]
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in odd_sketch.link(make_docs(rows), rule).collect()}
    assert got == linked(rows, rule)


def test_large_groups_are_compared_in_blocks(spark, make_docs, prose, monkeypatch):
    monkeypatch.setattr(odd_sketch, "BLOCK_CLASSES", 7)
    monkeypatch.setattr(odd_sketch, "BLOCK_SETS", 9)
    monkeypatch.setattr(odd_sketch, "_BITMAPS", 0)
    rows = near_copies(prose, 40)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in odd_sketch.link(make_docs(rows)).collect()}
    assert got == linked(rows, odd_sketch.Rule())


def test_blocks_of_sets_are_bounded_in_bytes(spark, make_docs, prose, monkeypatch):
    monkeypatch.setattr(odd_sketch, "BLOCK_BYTES", 4_000)
    sizes = {i: 20 + i * 37 % 150 for i in range(400)} | {i: 300 + i for i in range(400, 410)}
    members = spark.createDataFrame([(g, 410, i, n) for g in (1, 2) for i, n in sizes.items()], "group long, size long, id long, n long")
    blocks = defaultdict(list)
    for r in odd_sketch._placed(members).collect():
        blocks[r.group, r.block].append(8 * r.n)
    assert sum(map(len, blocks.values())) == 820
    assert all(sum(b) <= 4_000 or len(b) == 1 for b in blocks.values())
    assert len(blocks) < 820 / 2
    rows = near_copies(prose, 40)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in odd_sketch.link(make_docs(rows)).collect()}
    assert got == linked(rows, odd_sketch.Rule())


def test_deduplicate_keeps_one_of_each(make_docs, prose):
    rows = [(3, prose(1, 30)), (1, prose(1, 30)), (1, prose(1, 30)), (2, prose(2, 30)), (None, prose(1, 30)), (9, None), (8, "")]
    docs = make_docs(rows)
    kept = odd_sketch.deduplicate(docs)
    assert kept.columns == docs.columns
    assert Counter(r.doc_id for r in kept.collect()) == Counter([1, 2, None, 9, 8])
    assert odd_sketch.query(make_docs([])).count() == 0


def test_sketch_estimates_similarity():
    rng = np.random.default_rng(1)
    a = np.sort(rng.integers(0, 2**63, 400).astype(np.uint64))
    b = np.sort(np.concatenate([a[:380], rng.integers(0, 2**63, 20).astype(np.uint64)]))
    samples = odd_sketch._samples(np.concatenate([a, b]), np.array([0, 400]))
    x, y = odd_sketch._sketches(samples)
    far = int(np.bitwise_count(x ^ y).sum())
    k, n = odd_sketch.BANDS * odd_sketch.ROWS, odd_sketch.SKETCH_BITS
    estimate = 1 + n / (4 * k) * np.log(1 - 2 * far / n)
    assert abs(estimate - 380 / 420) < 0.08


# --- repeated phrases ------------------------------------------------------------------------------------------------


def without_repeats(rows):
    words = [(i, WORD.findall(t or "")) for i, t in rows]
    first = {}
    for i, w in words:
        for k in range(len(w) - 12):
            key = tuple(w[k : k + 13])
            if i is not None:
                first[key] = min(first.get(key, i), i)
    found = []
    for i, w in words:
        gone = set()
        for k in range(len(w) - 12):
            if i is not None and first[tuple(w[k : k + 13])] < i:
                gone |= set(range(k, k + 13))
        kept = " ".join(x for k, x in enumerate(w) if k not in gone)
        found.append((i, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return Counter(found)


def phrase_rows(prose):
    shared, other = prose(50, 60), prose(51, 13)
    rows = [(i, f"{prose(i, 20)} {shared} {prose(i + 1000, 15)}") for i in range(10, 30)]
    rows += [(40, other), (41, f"x {other} y"), (42, other.replace(" ", "\n")), (43, f"{other[:-1]}"), (44, "same " * 40), (45, "same " * 30)]
    rows += [(46, shared), (46, shared), (5, f"{prose(3, 4)}\t{shared}"), (1, None), (2, ""), (None, shared), (47, "short text"), (48, "short text")]
    rows += [(49, f"{prose(50, 30)} é🙂 {prose(50, 60)}")]
    return rows


@pytest.mark.parametrize("hot", [False, True])
def test_repeated_phrases(make_docs, prose, hot, monkeypatch):
    if hot:
        monkeypatch.setattr(phrases, "HOT_SAMPLE", 1)
        monkeypatch.setattr(phrases, "HOT_TEXTS", 3)
        monkeypatch.setattr(phrases, "HOT", 20)
    rows = phrase_rows(prose)
    got = phrases.repeated_phrases(make_docs(rows)).collect()
    assert Counter(tuple(r) for r in got) == without_repeats(rows)
    assert phrases.query(make_docs([])).count() == 0


def test_one_anchor_in_many_contexts(make_docs, prose, monkeypatch):
    common = prose(70, 5)  # five words in 200 contexts, some of which recur
    rows = [(i, f"{prose(100 + i % 120, 12)} {common} {prose(400 + i % 90, 12)} {common}") for i in range(200)]
    rows += [(300 + i, f"{prose(100 + i, 12)} {common} {prose(600 + i, 3)} {'again ' * 20}") for i in range(20)]
    widest, locate = [], phrases._owners

    def seen(regions, shards):
        widest.append(max((r["count"] for r in regions.groupBy("anchor").count().collect()), default=0))
        return locate(regions, shards)

    monkeypatch.setattr(phrases, "LARGE_REGIONS", 10, raising=False)
    monkeypatch.setattr(phrases, "_owners", seen)
    got = phrases.repeated_phrases(make_docs(rows)).collect()
    assert Counter(tuple(r) for r in got) == without_repeats(rows)
    assert widest[0] <= 10


def test_common_runs_are_no_anchors_beside_others(prose):
    common = prose(70, 5).encode()
    texts = [f"{prose(100 + i, 12)} ".encode() + common + f" {prose(400 + i, 12)}".encode() for i in range(40)]
    texts.append(b" ".join([common] * 4))
    hot = np.unique(run_hashes(word_hashes([common + b" " + common])[0], 5) >> np.uint64(1))
    value, of, start, length, counts = phrases.anchor_runs(texts, hot)
    assert not np.isin(value[of < 40], hot).any() and (value[of < 40] < phrases._COMMON).all()
    assert (value[of == 40] >= phrases._COMMON).all()  # only common runs: one of them is the anchor
    assert [int(length[of == i].sum()) for i in range(41)] == [int(c) - 12 for c in counts]


def test_phrases_on_given_documents(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert Counter(tuple(r) for r in phrases.query(docs).collect()) == without_repeats(rows)


# --- mixing ----------------------------------------------------------------------------------------------------------


def targets(sizes, weights, most=3.0):
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    target, open_ones, rest = {}, set(names), float(sum(sizes.values()))
    while open_ones:
        level = rest / sum(weight[s] for s in open_ones)
        above = {s for s in open_ones if level * weight[s] > most * sizes[s]}
        if not above:
            return target | {s: level * weight[s] for s in open_ones}
        target |= {s: most * sizes[s] for s in above}
        rest -= sum(target[s] for s in above)
        open_ones -= above
    return target


def test_mix(make_docs, prose):
    rng = random.Random(2)
    rows = [(i, prose(i, rng.randrange(1, 80)), rng.choice(["b", "a", "é", "Z", ""])) for i in range(400)]
    rows += [(1000 + i, prose(i, 9), None) for i in range(40)] + [(2000, "one two", "tiny"), (2001, None, "a"), (2002, "", "void")]
    rows += [(None, "no id here", "b"), (3, rows[3][1], rows[3][2])]
    docs = make_docs(rows)
    got = mixing.mix(docs).collect()
    assert len(got) == len(rows)
    sizes = defaultdict(int)
    for _, text, source in rows:
        sizes[source] += len(WORD.findall(text or ""))
    expected = targets(sizes, mixing.WEIGHTS)
    taken = defaultdict(int)
    for r in got:
        assert r.source_size == sizes[r.source]
        assert r.target == pytest.approx(expected[r.source])
        assert 0 <= r.copies <= 3
        taken[r.source] += int(r["size"]) * r.copies
    for source, target in expected.items():
        assert abs(taken[source] - target) <= max(3, 0.02 * target), source
    again = mixing.mix(docs.repartition(5)).select("doc_id", "text", "copies").collect()
    assert Counter((r.doc_id, r.text, r.copies) for r in got) == Counter(tuple(r) for r in again)
    mixed = mixing.mixed_rows(docs)
    assert mixed.columns == docs.columns
    assert Counter(r.doc_id for r in mixed.collect()) == Counter({r.doc_id: 0 for r in got}) + Counter(
        x for r in got for x in [r.doc_id] * r.copies
    )
    assert mixing.query(make_docs([])).count() == 0


def test_propensity_changes_who_is_taken(make_docs, prose):
    rows = [(i, prose(i, 20), "a") for i in range(300)] + [(1000 + i, prose(i, 20), "b") for i in range(900)]
    odds = F.when(F.col("doc_id") % 2 == 0, 0.1).otherwise(1.0)
    got = mixing.mix(make_docs(rows), weights=(1.0, 1.0), propensity=odds).filter("source = 'b' and copies > 0").collect()
    assert sum(r.doc_id % 2 for r in got) > 0.7 * len(got)


# --- nearest neighbours ----------------------------------------------------------------------------------------------


def exact_nearest(rows, k):
    found = {}
    for q, x in rows:
        if q % 5 == 0:
            d = sorted((float(np.sqrt(((np.array(x, float) - np.array(y, float)) ** 2).sum())), i) for i, y in rows if i != q)
            found[q] = d[:k]
    return found


def test_nearest(spark):
    rng = np.random.default_rng(5)
    centres = rng.standard_normal((6, 24))
    rows = [(i, (centres[i % 6] + 0.5 * rng.standard_normal(24)).astype(np.float32).tolist()) for i in range(300)]
    rows += [(1000 + i, rows[5][1]) for i in range(40)]
    bad = [(2000, None), (2005, [0.0] * 24), (2010, [float("nan")] + [1.0] * 23), (2015, [1.0] * 23 + [None]), (2020, [float("inf")] * 24)]
    bad += [(2025, [1.0, 2.0]), (2030, []), (None, rows[0][1])]
    frame = spark.createDataFrame([*rows, *bad, rows[0]], "vec_id long, vector array<float>")
    for blocks in (40, 10_000):
        got = defaultdict(list)
        for r in ann.nearest(frame, F.col("vec_id") % 5 == 0, block_rows=blocks, group_queries=17).orderBy("query_id", "rank").collect():
            assert r.rank == len(got[r.query_id]) + 1
            got[r.query_id].append((r.score, r.vec_id))
        expected = exact_nearest(rows, 10)
        assert set(got) == set(expected)
        hits = sum(len({v for _, v in got[q]} & {v for _, v in e}) for q, e in expected.items())
        assert hits >= 0.98 * sum(map(len, expected.values()))
        for q in (1000, 1005):
            assert [v for _, v in got[q]] == [v for _, v in expected[q]]
            assert all(s == 0 for s, _ in got[q])
    few = frame.filter("vec_id in (0, 7, 14)")
    assert ann.nearest(few, F.col("vec_id") % 5 == 0).count() == 2
    assert ann.nearest(frame.limit(0), F.col("vec_id") % 5 == 0).count() == 0
    assert ann.nearest(frame.filter("vec_id > 2000"), F.col("vec_id") % 5 == 0).count() == 0


def test_recall_on_given_vectors(spark, sf):
    table = spark.read.parquet(f"{sf}/embeddings.parquet")
    rows = [(r.vec_id, r.embedding) for r in table.collect()]
    got = defaultdict(set)
    for r in ann.query(table).collect():
        got[r.query_id].add(r.vec_id)
    hits = total = 0
    for q, x in rows:
        if q % 100 == 0:
            near = sorted((float(((np.array(x) - np.array(y)) ** 2).sum()), i) for i, y in rows if i != q)[:10]
            hits += len(got[q] & {i for _, i in near})
            total += len(near)
    assert hits >= 0.95 * total


# --- toxicity --------------------------------------------------------------------------------------------------------


def test_toxicity(spark, make_docs):
    rng = random.Random(6)
    calm = [f"{a}{b}" for a in ("lor", "mun", "tev", "sal", "pom") for b in ("an", "ite", "oda", "urr", "ek", "ist")]
    foul = ["grubnarf", "zoxxplut", "vilequark"]
    rows, labels = [], []
    for i in range(600):
        words = [rng.choice(calm) for _ in range(rng.randrange(20, 120))]
        toxic = i % 4 == 0
        if toxic:
            for _ in range(6):
                words[rng.randrange(len(words))] = rng.choice(foul)
        rows.append((i, " ".join(words)))
        labels.append((i, 1, int(toxic)))
    rows += [(5000, None), (5001, ""), (None, rows[0][1]), (0, rows[0][1]), (5002, "x" * 30_000)]
    labels += [(1, 1, 1), (1, 1, 0), (None, 1, 1), (2, 1, None), (7, 1, 0), (9999, 1, 1)]
    table = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    got = toxicity.query(make_docs(rows), table).collect()
    assert len(got) == len(rows)
    truth = {i: y for i, _, y in labels[:600]}
    for r in got:
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5)
        assert r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
    held = [(r.predicted, truth[r.doc_id]) for r in got if r.held_out and r.doc_id in truth]
    assert sum(p == y for p, y in held) >= 0.95 * len(held)
    one_class = toxicity.query(make_docs(rows), table.filter("toxic = 0")).agg(F.max("score")).first()[0]
    assert one_class < 0.01
    nothing = toxicity.query(make_docs(rows), table.limit(0))
    assert nothing.agg(F.max("predicted")).first()[0] == 0
    assert toxicity.query(make_docs([]), table).count() == 0


def test_the_toxic_dictionary_holds_the_whole_list(spark, make_docs):
    rng = random.Random(8)
    name = lambda a: a + "".join(rng.choice("aeioubdgklmnprstvz") for _ in range(9))
    calm, foul, rare = [name("c") for _ in range(200)], [name("f") for _ in range(300)], [name("r") for _ in range(40)]
    rows, labels, planted = [], [], {}
    for i in range(2400):
        words = [rng.choice(calm) for _ in range(60)]
        if i % 4 == 0:
            k = i // 4
            planted[i] = [rng.choice(foul) for _ in range(14)] + [rare[k % 40]] * (k < 400)
            words += planted[i]
            rng.shuffle(words)
        rows.append((i, " ".join(words)))
        labels.append((i, 1, int(i % 4 == 0)))
    learned = {i for i in planted if zlib.crc32(str(i).encode()) % 5}
    seen = Counter(w for i in learned for w in set(planted[i]))
    table = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    model = toxicity.fit(make_docs(rows), table)
    held = set(model.toxic.split())
    wanted = [w for w in foul + rare if seen[w] >= 9]
    assert len(wanted) > 280 and sum(w in rare for w in wanted) > 5
    assert min(seen[w] for w in wanted) < 0.02 * len(learned)
    assert [w for w in wanted if w.encode() not in held] == []
    # A word counts, wherever in the dictionary it stands.
    assert all(toxicity.evidence(b"  %b  " % w.encode(), model.ordinary, model.toxic)[0] >= 2 for w in wanted)


def test_words_of_copied_documents_do_not_pass_for_toxic_words(spark, make_docs):
    rng = random.Random(9)
    name = lambda a: a + "".join(rng.choice("aeioubdgklmnprstvz") for _ in range(8))
    calm, foul = [name("c") for _ in range(200)], [name("f") for _ in range(6)]
    rows, labels, seldom = [], [], set()
    for i in range(1600):
        if i % 4 or i % 160 == 0:
            words = [rng.choice(calm) for _ in range(60)]
        if i % 160 == 0:  # each of these texts comes forty times, every other time a little changed
            own = [name("s") for _ in range(40)]
            seldom |= set(own)
            copied = [*words, *own, foul[i // 160 % 6], foul[(i // 160 + 1) % 6]]
            rng.shuffle(copied)
        if i % 4 == 0:
            words = copied[: len(copied) - i // 4 % 2]
        rows.append((i, " ".join(words)))
        labels.append((i, 1, int(i % 4 == 0)))
    for i in range(1600, 2000):
        rows.append((i, " ".join([rng.choice(calm) for _ in range(30)] + rng.sample(foul, 2))))
        labels.append((i, 1, 1))
    table = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    model = toxicity.fit(make_docs(rows), table)
    held = set(model.toxic.split())
    assert {w.encode() for w in foul} <= held
    assert not {w.encode() for w in seldom} & held


def test_texts_without_toxic_documents_or_words_are_scored(spark, make_docs):
    rows = [(i, "some ordinary words " * 5) for i in range(20)] + [(30, None), (31, "")]
    table = spark.createDataFrame([(i, 1, int(i >= 30)) for i in range(60)], "doc_id long, quality int, toxic int")
    for some in (rows, rows[:20], rows[20:]):
        assert toxicity.query(make_docs(some), table).filter("score between 0 and 1").count() == len(some)


def test_windows_cover_the_text():
    text = b"Ab  cd\n" * 200 + b"x" * 600
    found = toxicity.windows(text)
    assert b" ".join(w.strip() for w in found).split() == text.lower().split()
    assert all(len(w) <= 252 for w in found[:-1])


def test_mixed_rows_keep_columns_of_any_name(spark):
    rows = [(i, f"one two three {i}", "ab"[i % 2], f"s{i}", f"x{i}", f"t{i}", f"c{i}", i + 0.5) for i in range(40)]
    names = ["doc_id", "text", "source", "size", "copies", "target", "_copy", "row"]
    got = mixing.mixed_rows(spark.createDataFrame(rows, names))
    assert got.columns == names
    held = Counter(tuple(r) for r in got.collect())
    assert set(held) <= set(rows)
    taken = Counter({r.doc_id: r.copies for r in mixing.mix(spark.createDataFrame(rows, names)).collect() if r.copies})
    assert Counter({r[0]: n for r, n in held.items()}) == taken
