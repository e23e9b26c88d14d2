"""Sequences and their split against a position-based version in memory."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from stationflow.operators import sequences

START = datetime(2024, 1, 1)
SIZES = {"a": 23, "b": 24, "c": 25, "d": 100, "e": 1, "f": 60, "g": 47, "h": 31}


def in_memory(sizes, length=24, train=0.70, validation=0.85):
    """Positions of starts, their parts and the rows the training part covers."""
    table, starts = [], []
    for name in sorted(sizes):
        first = len(table)
        table += [(name, START + timedelta(hours=i)) for i in range(sizes[name])]
        starts += range(first, first + max(sizes[name] - length + 1, 0))
    a, b = int(len(starts) * train), int(len(starts) * validation)
    parts = {table[s]: "train" if i < a else "val" if i < b else "test" for i, s in enumerate(starts)}
    covered = {table[p] for s in starts[:a] for p in range(s, s + length)}
    return table, parts, covered


@pytest.fixture(scope="module")
def frame(spark):
    random.seed(9)
    table, _, _ = in_memory(SIZES)
    data = [(n, d, float(i), float(-i)) for i, (n, d) in enumerate(table)]
    random.shuffle(data)
    made = spark.createDataFrame(data, "station_name string, date timestamp, x double, y double").repartition(4).cache()
    made.count()
    return made


BLOCKS = pytest.mark.parametrize("rows_per_block", [None, 1, 10, 1000])


@BLOCKS
def test_starts(frame, rows_per_block):
    _, parts, _ = in_memory(SIZES)
    got = sequences.sequence_starts(frame, rows_per_block=rows_per_block).collect()
    assert {(r["station_name"], r["date"]) for r in got} == set(parts) and len(got) == len(parts)
    assert all(r["station_rows"] == SIZES[r["station_name"]] for r in got)
    assert all(r["date"] == START + timedelta(hours=r["row_number"] - 1) for r in got)


@BLOCKS
def test_split(frame, rows_per_block):
    _, parts, _ = in_memory(SIZES)
    got = sequences.ordered_split(frame, rows_per_block=rows_per_block).collect()
    assert {(r["station_name"], r["date"]): r["split"] for r in got} == parts
    assert sorted(r["position"] for r in got) == list(range(1, len(parts) + 1))


@BLOCKS
def test_rows_of_the_training_sequences(frame, rows_per_block):
    _, _, covered = in_memory(SIZES)
    got = sequences.train_rows(frame, rows_per_block=rows_per_block)
    assert got.columns == frame.columns
    assert sorted((r["station_name"], r["date"]) for r in got.collect()) == sorted(covered)


@pytest.mark.parametrize("sizes", [{"a": 24}, {"a": 10}, {"a": 25, "b": 24}])
def test_small_inputs(spark, sizes):
    table, parts, covered = in_memory(sizes)
    frame = spark.createDataFrame(table, "station_name string, date timestamp")
    got = sequences.ordered_split(frame).collect()
    assert {(r["station_name"], r["date"]): r["split"] for r in got} == parts
    assert {(r["station_name"], r["date"]) for r in sequences.train_rows(frame).collect()} == covered


@BLOCKS
def test_contents(frame, rows_per_block):
    _, parts, _ = in_memory(SIZES)
    by_key = {(r["station_name"], r["date"]): r for r in frame.collect()}
    got = sequences.sequences(frame, ["x", "y"], "y", rows_per_block=rows_per_block).collect()
    assert {(r["station_name"], r["date"]) for r in got} == set(parts) and len(got) == len(parts)
    for r in got:
        spanned = [by_key[(r["station_name"], r["date"] + timedelta(hours=i))] for i in range(24)]
        assert r["sequence"] == [[s["x"], s["y"]] for s in spanned]
        assert r["y"] == spanned[-1]["y"]


def test_other_lengths(frame):
    got = sequences.sequences(frame, ["x"], "y", length=5)
    assert got.count() == sum(max(n - 4, 0) for n in SIZES.values())
    assert got.filter(F.size("sequence") != 5).count() == 0
