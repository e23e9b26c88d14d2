"""The corpus pipeline, stage by stage, and its last result."""

import tracemalloc
import zlib
from collections import Counter

import numpy as np
from tokenizers import Tokenizer

import corpus_pipeline
from stationflow.llm import odd_sketch, packing, pii, words
from stationflow.llm.tables import staged
from stationflow.llm.tokens import encoder, vocabulary_path


def test_stages(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "near_dedup", "pii", "mixing", "packing"]
    before = docs
    for name, stage in corpus_pipeline.STAGES:
        after = staged(stage(spark, before, sf), name)
        if name != "packing":
            assert after.columns == docs.columns
        rows = after.collect()
        if name == "toxicity":
            assert 0.7 * docs.count() < len(rows) < docs.count()
        elif name == "near_dedup":
            kept = {r.doc_id for r in odd_sketch.link(before).filter("kept").collect()}
            assert {r.doc_id for r in rows} == kept and len(rows) == len(kept)
        elif name == "pii":
            assert all(not pii.plain_spans(r.text or "") for r in rows)
            assert all(r.n_chars == len(r.text) for r in rows)
        elif name == "mixing":
            assert max(Counter(r.doc_id for r in rows).values()) <= 3
        else:
            tokenizer = Tokenizer.from_file(vocabulary_path())
            expected = Counter()
            for r in before.collect():
                ids = np.array([*tokenizer.encode(r.text or "", add_special_tokens=False).ids, 1], "<u4")
                for piece, at in enumerate(range(0, len(ids), 4096)):
                    part = ids[at : at + 4096]
                    expected[r.doc_id, piece, at, len(part), zlib.crc32(part.tobytes())] += 1
            assert Counter(tuple(r)[:5] for r in rows) == expected
            used = Counter()
            for r in rows:
                used[r.sequence_id] += r.length
            assert max(used.values()) <= 4096
        before = after


def test_workers_keep_no_pieces_after_a_task(spark, make_docs, prose):
    docs = make_docs([(i, prose(i, 300) + " \u4e00\u4e8c") for i in range(40)]).repartition(4)
    assert packing.tokenized_pieces(docs).count() == 40
    path = vocabulary_path()

    def held(batches):
        import pyarrow as pa

        for batch in batches:
            kept = encoder(path)
            yield pa.RecordBatch.from_arrays([pa.array([len(kept._ids) + len(kept._others)] * len(batch))], ["held"])

    found = spark.range(0, 16, 1, 16).mapInArrow(held, "held bigint").collect()
    assert max(r.held for r in found) == 0


def test_word_hashes_of_a_megabyte_take_little_memory():
    text = b"some words of a text " * (1 << 16)
    words._powers.cache_clear()
    tracemalloc.start()
    hashes, counts = words.word_hashes([text])
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert counts.tolist() == [len(hashes)] == [5 << 16]
    assert peak < 32 << 20


def test_stages_set_small_batches_in_place_of_defaults_only(spark, sf):
    rows, size = "spark.sql.parquet.columnarReaderBatchSize", "spark.sql.execution.arrow.maxBytesPerBatch"
    before = {k: spark.conf.get(k) for k in (rows, size)}
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    try:
        for k in before:
            spark.conf.unset(k)
        corpus_pipeline.sources_mixed(spark, docs, sf)
        assert int(spark.conf.get(rows)) <= 512 and int(spark.conf.get(size).rstrip("b")) <= 1 << 20
        spark.conf.set(rows, "100")
        corpus_pipeline.sources_mixed(spark, docs, sf)
        assert spark.conf.get(rows) == "100"
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
