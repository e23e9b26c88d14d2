"""Packing and wavelet shards against direct encoding."""

import zlib
from collections import Counter

import numpy as np
import pytest
from tokenizers import Tokenizer

from stationflow.llm import packing, tokens, wavelet
from stationflow.llm.tables import shared_dir
from stationflow.llm.tokens import WordEncoder, vocabulary_path

ODD = [
    "", " ", "\n\t", "Hello, WORLD's 123 e-mail isn't'd 'S", "straße ÉCOLE naïve ΣΟΦΟΣ İstanbul", "a\x1cb\x85c\u00a0d\u2003e",
    "<|endoftext|> x<|startoftext|>y <|end", "日本語 text 🙂🙂 e\u0301 \ufb01n", "\x00\x01 zero", "x" * 5000, "1234567890" * 30,
]


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(vocabulary_path())


def ids_of(tokenizer, text):
    return tokenizer.encode(text or "", add_special_tokens=False).ids


def test_words_encode_like_the_whole_text(tokenizer):
    encoder = WordEncoder(vocabulary_path(), kept=3)
    for text in [*ODD, " ".join(ODD), "\n".join(ODD)]:
        assert np.frombuffer(encoder.encode(text.encode()), "<u4").tolist() == ids_of(tokenizer, text), text


@pytest.fixture(scope="module")
def rows(prose):
    texts = [None, *ODD, prose(1, 1500), prose(2, 40), prose(2, 40)]
    return [(i * 3, t) for i, t in enumerate(texts)] + [(None, "no id"), (6, ODD[1])]


def test_only_words_not_seen_before_are_broken_into_pieces(tokenizer, monkeypatch):
    broken = []

    class Counted:
        def findall(self, text):
            broken.append(text)
            return pieces.findall(text)

    pieces = tokens._PIECES
    monkeypatch.setattr(tokens, "_PIECES", Counted())
    encode = tokens.WordEncoder(tokens.vocabulary_path()).encode
    text = "It's 'REAL', we'll see: 3.14 (r\u00e9el) --''s don't!!'ve\n" * 30
    expected = np.array(tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
    assert encode(text.encode()) == expected
    assert sum(map(len, broken)) < 3 * len(text) / 30
    broken.clear()
    assert encode(text.encode()) == expected and not broken


def test_packing(make_docs, rows, tokenizer):
    got = packing.pack(make_docs(rows), capacity=256).collect()
    expected = Counter()
    for doc, text in rows:
        ids = [*ids_of(tokenizer, text), 1]
        for piece, at in enumerate(range(0, len(ids), 256)):
            expected[doc, piece, at, tuple(ids[at : at + 256])] += 1
    assert Counter((r.doc_id, r.piece, r.start, tuple(np.frombuffer(r.ids, "<u4").tolist())) for r in got) == expected
    places = {}
    for r in got:
        places.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for spans in places.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= 256
    total = sum(r.length for r in got)
    assert len(places) <= -(-total // 256) + 1


def test_packing_takes_small_batches_and_reads_no_ids_back(spark, make_docs, rows, tokenizer, monkeypatch):
    read, passed = "spark.sql.parquet.columnarReaderBatchSize", "spark.sql.execution.arrow.maxBytesPerBatch"
    before, held, stored = {k: spark.conf.get(k) for k in (read, passed)}, [], []

    def recorded(df, *rest):
        held.append((int(spark.conf.get(read)), int(spark.conf.get(passed).rstrip("b"))))
        stored.append(packing_staged(df, *rest))
        return stored[-1]

    packing_staged = packing.staged
    monkeypatch.setattr(packing, "staged", recorded)
    try:
        for k in before:
            spark.conf.unset(k)
        defaults = {k: spark.conf.get(k) for k in before}
        got = packing.query(make_docs(rows), capacity=256)
        assert held[0][0] <= 512 and held[0][1] <= 1 << 20
        assert {k: spark.conf.get(k) for k in before} == defaults
        spark.conf.set(read, "100")
        packing.pack(make_docs(rows), capacity=256)
        assert held[1][0] == 100 and held[1][1] <= 1 << 20 and spark.conf.get(read) == "100"
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert "ids:binary" not in got._jdf.queryExecution().toString()
    kept = Counter((r.doc_id, r.piece, r.start, r.length, zlib.crc32(r.ids)) for r in stored[0].collect())
    assert Counter(tuple(r)[:5] for r in got.collect()) == kept
    assert sum(r.length for r in stored[0].collect()) == sum(len(ids_of(tokenizer, t)) + 1 for _, t in rows)


def test_sequences_hold_the_ids(make_docs, rows):
    packed = packing.pack(make_docs(rows), capacity=128)
    held = {r.sequence_id: r for r in packing.sequences(packed).collect()}
    for r in packed.collect():
        assert held[r.sequence_id].ids[4 * r.offset : 4 * (r.offset + r.length)] == r.ids
        assert held[r.sequence_id].n_tokens <= 128


def test_hot_length_is_ranked_in_blocks(spark):
    pieces = spark.range(1000).selectExpr("id as doc_id", "0 as piece", "0L as start", "30 as length")
    got = packing.place(pieces, capacity=100, rows_per_block=70).collect()
    assert len({(r.sequence_id, r.offset) for r in got}) == 1000
    assert len({r.sequence_id for r in got}) == 334


@pytest.mark.parametrize("seed", range(6))
def test_plan_is_complete_and_no_worse_than_best_fit(seed):
    rng = np.random.default_rng(seed)
    sizes = rng.integers(1 + 10 * seed, 60, 120).tolist()
    counts = dict(Counter(sizes))
    plan = packing.plan_sequences(counts, 100)
    used = Counter()
    for filling, times in plan:
        assert sum(s * n for s, n in filling) <= 100
        for s, n in filling:
            used[s] += n * times
    n = sum(t for _, t in plan)
    assert used == counts
    assert packing.lower_bound(counts, 100) <= n <= sum(t for _, t in packing.best_fit(counts, 100))


def test_bin_completion_beats_best_fit():
    counts = {44: 3, 32: 3, 24: 3, 46: 1, 30: 2, 27: 2, 22: 2, 35: 1, 29: 2, 36: 3}
    sequences = sum(t for _, t in packing.plan_sequences(counts, 100))
    assert sequences < sum(t for _, t in packing.best_fit(counts, 100)) or sequences == packing.lower_bound(counts, 100)
    assert packing.plan_sequences({}, 100) == []


def test_wavelet_matrix():
    rng = np.random.default_rng(3)
    for ids in (rng.integers(0, 49_408, 3000), rng.integers(0, 3, 1025), np.array([7]), np.zeros(600, np.int64)):
        ids = ids.astype(np.uint32)
        opened, lengths = wavelet.from_bytes(wavelet.to_bytes(ids, np.array([len(ids)])))
        assert lengths.tolist() == [len(ids)]
        assert (opened.decode() == ids).all()
        for i in rng.integers(0, len(ids), 50):
            symbol = int(ids[i])
            assert opened.access(int(i)) == symbol
            assert opened.rank(symbol, int(i)) == int((ids[:i] == symbol).sum())
        symbol = int(ids[0])
        assert opened.occurrences(symbol) == np.flatnonzero(ids == symbol).tolist()
        assert opened.count(60_000) == 0
        with pytest.raises(IndexError):
            opened.select(symbol, len(ids))


def test_wavelet_opens_only_the_frames_it_needs():
    ids = np.random.default_rng(5).integers(0, 49_408, 3_000_000).astype(np.uint32)
    matrix, _ = wavelet.from_bytes(wavelet.to_bytes(ids, np.array([len(ids)])))
    assert sum(p.opened for p in matrix.planes) == 0
    assert matrix.access(2_000_000) == ids[2_000_000]
    assert {p.opened for p in matrix.planes} == {1}
    symbol = int(ids[77])
    assert matrix.count(symbol) == int((ids == symbol).sum())
    assert max(p.opened for p in matrix.planes) <= 3
    assert matrix.occurrences(symbol) == np.flatnonzero(ids == symbol).tolist()
    assert (matrix.decode() == ids).all()


def test_wavelet_of_wide_ids_and_none():
    ids = np.random.default_rng(6).integers(0, 1 << 20, 5000).astype(np.uint32)
    assert (wavelet.from_bytes(wavelet.to_bytes(ids, np.array([5000])))[0].decode() == ids).all()
    empty, lengths = wavelet.from_bytes(wavelet.to_bytes(ids[:0], np.array([], np.int64)))
    assert len(empty.decode()) == len(lengths) == empty.count(0) == 0


def test_letters_beyond_ascii_encode_like_the_tokenizer(tokenizer):
    rng = np.random.default_rng(7)
    letters = [chr(c) for c in (*range(0x21, 0x7F), *range(0xA0, 0x180))] + [" "] * 30
    encoder = WordEncoder(vocabulary_path())
    for _ in range(3000):
        text = "".join(rng.choice(letters, rng.integers(0, 25)))
        assert np.frombuffer(encoder.encode(text.encode()), "<u4").tolist() == ids_of(tokenizer, text), text


def test_wavelet_round_trip(spark, make_docs, rows, tokenizer):
    path = shared_dir(spark, "wavelet")
    wavelet.write_shards(make_docs(rows), path, shard_tokens=500, ranges=3)
    assert spark.read.parquet(path).count() > 3
    got = wavelet.read_documents(spark, path).orderBy("start").collect()
    start = 0
    for r in got:
        assert r.start == start
        start += r.n_tokens
    order = [r.doc_id for r in got]
    assert order == sorted(order, key=lambda i: -1 if i is None else i)
    texts = Counter((r.doc_id, tuple(np.frombuffer(r.ids, "<u4").tolist())) for r in got)
    assert texts == Counter((i, (*ids_of(tokenizer, t), 2)) for i, t in rows)


def test_queries_on_empty_and_given_tables(spark, make_docs, sf, tokenizer):
    empty = make_docs([])
    assert packing.query(empty).count() == 0
    assert wavelet.query(empty).count() == 0
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    start, got = 0, {r.doc_id: r for r in wavelet.query(docs).collect()}
    for r in docs.orderBy("doc_id").collect():
        ids = np.array([*ids_of(tokenizer, r.text), 2], "<u4")
        assert got[r.doc_id][1:] == (start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)
