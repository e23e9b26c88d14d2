"""The chunked sequence store and the study against arrays in memory."""

import math
import random
from datetime import datetime, timedelta

import numpy as np
import pytest

from stationflow.operators.sequence_store import SequenceLayout, sequence_chunks, sequence_index, stored_sequences
from stationflow.plans import read_study, sequence_study, write_study
from stationflow.plans.sequence_study import cell_digest

START = datetime(2024, 1, 1)
SIZES = {"a": 23, "b": 24, "c": 25, "d": 100, "e": 1, "f": 60, "g": 47, "h": 31}
TARGET = "o3_next_24h_max"


def in_memory(sizes, length=24):
    """Rows, and (first row, part) of each sequence, in (station, time) order."""
    table, starts = [], []
    for name in sorted(sizes):
        first = len(table)
        table += [(name, START + timedelta(hours=i)) for i in range(sizes[name])]
        starts += range(first, first + max(sizes[name] - length + 1, 0))
    a, b = int(len(starts) * 0.70), int(len(starts) * 0.85)
    return table, [(s, "train" if i < a else "val" if i < b else "test") for i, s in enumerate(starts)]


@pytest.fixture(scope="module")
def frame(spark):
    table, _ = in_memory(SIZES)
    data = [(n, d, float(i), float(-i) / 4, float(i % 7)) for i, (n, d) in enumerate(table)]
    random.Random(9).shuffle(data)
    made = spark.createDataFrame(data, "station_name string, date timestamp, x double, y double, t double")
    return made.repartition(4).cache()


@pytest.mark.parametrize("chunk_rows", [1, 2, 5, 23, 24, 1000])
@pytest.mark.parametrize("length", [1, 24])
def test_slices_are_the_sequences(frame, chunk_rows, length):
    table, starts = in_memory(SIZES, length)
    cells = np.array([(i, -i / 4) for i in range(len(table))], np.float32)
    layout = SequenceLayout(("x", "y"), "t", length)
    chunks = sequence_chunks(frame, layout, chunk_rows=chunk_rows).cache()
    got = sorted(stored_sequences(chunks, layout).collect(), key=lambda r: r.position)
    assert [r.position for r in got] == list(range(1, len(starts) + 1))
    for r, (s, part) in zip(got, starts, strict=True):
        assert ((r.station_name, r.date), r.split) == (table[s], part)
        assert r.sequence == cells[s : s + length].reshape(-1).tolist()
        assert r.target == (s + length - 1) % 7
    index = {(r.station_name, r.date): (r.position, r.split) for r in sequence_index(chunks).collect()}
    assert index == {(r.station_name, r.date): (r.position, r.split) for r in got}
    assert stored_sequences(chunks, layout, "val").count() == sum(p == "val" for _, p in starts)


def test_cells_are_stored_about_once(frame):
    layout = SequenceLayout(("x", "y"), "t")
    chunks = sequence_chunks(frame, layout, chunk_rows=50).collect()
    assert {c.station_name for c in chunks} == {n for n, size in SIZES.items() if size >= 24}
    assert all(len(c.cells) == 2 * len(c.targets) == 2 * (c.starts + 23) for c in chunks)
    assert sum(len(c.targets) for c in chunks) == sum(s for s in SIZES.values() if s >= 24) + 23 * (2 - 1)  # d: two chunks


def test_cut_stations_give_the_same_chunks(frame, rows):
    layout = SequenceLayout(("x", "y"), "t")
    whole = rows(sequence_chunks(frame, layout, chunk_rows=10, rows_per_block=None))
    assert whole == rows(sequence_chunks(frame, layout, chunk_rows=10, rows_per_block=3))


@pytest.fixture(scope="module")
def dataset(spark):
    table, _ = in_memory(SIZES)
    rng = random.Random(3)
    data = []
    for i, (name, date) in enumerate(table):
        odd = {7: None, 40: float("nan"), 90: float("inf")}.get(i, rng.uniform(-5, 90))
        target = None if i == 120 else rng.uniform(0, 50)
        data.append((name, date, "athens" if i % 3 else "porto", "fall", odd, i % 5, 2.0, 1.0, target))
    schema = f"station_name string, date timestamp, city string, season string, a double, n int, flat double, pm10_next_24h_mean double, {TARGET} double"
    return spark.createDataFrame(data, schema), data


def studied(data):
    """Scaled cells and targets of every sequence, computed in memory from the rows that are complete."""
    cities, seasons = ["ancona", "athens", "zaragoza", "porto"], ["fall", "spring", "summer", "winter"]
    clean = [r for r in data if r[8] is not None and r[4] is not None and math.isfinite(r[4])]
    x = np.array([[r[4], r[5], r[6], *(r[2] == c for c in cities), *(r[3] == s for s in seasons)] for r in clean], np.float32)
    y = np.array([r[8] for r in clean], np.float32)
    starts = [i for i in range(len(clean) - 23) if clean[i][0] == clean[i + 23][0]]
    trained = sorted({p for s in starts[: int(len(starts) * 0.70)] for p in range(s, s + 24)})

    def scaled(v):
        of = v[trained].astype(np.float64)
        deviation = of.std(0)
        return ((v - of.mean(0)) / np.where(deviation == 0, 1.0, deviation)).astype(np.float32)

    x, y = scaled(x), scaled(y)
    return {clean[s][:2]: (x[s : s + 24].reshape(-1), y[s + 23]) for s in starts}


def test_study_against_memory(spark, dataset, tmp_path):
    frame, data = dataset
    study = write_study(sequence_study(frame, TARGET, chunk_rows=9), str(tmp_path / "study"))
    assert study.layout.features[:4] == ("a", "n", "flat", "city_ancona") and "city_porto" in study.layout.features
    expected = studied(data)
    again = read_study(spark, str(tmp_path / "study"))
    assert again.layout == study.layout
    got = again.sequences().withColumn("digest", cell_digest()).collect()
    assert {(r.station_name, r.date) for r in got} == set(expected) and len(got) == len(expected)
    for r in got:
        cells, target = expected[(r.station_name, r.date)]
        np.testing.assert_allclose(r.sequence, cells, rtol=1e-5, atol=1e-6)
        assert r.target == pytest.approx(float(target), rel=1e-5, abs=1e-6)
        weights = (np.arange(len(cells)) + 1) * 7919 % 1009 / 1009.0
        assert r.digest == pytest.approx(float(np.dot(np.array(r.sequence), weights)), abs=1e-6)


def test_study_of_short_stations(spark, dataset):
    frame, _ = dataset
    study = sequence_study(frame.filter("station_name in ('a', 'e')"), TARGET)
    assert study.sequences().count() == 0
    assert sequence_study(frame.limit(0), TARGET).sequences().count() == 0
