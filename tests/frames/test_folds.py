"""Folds by leaps and windows over overlapping segments, against plain loops."""

import math
import random

import pytest
from pyspark.sql import functions as F

from cadenza.operators import sampling, series


def _series(seed: int, clips: int, rows: int):
    """Rows with gaps, nulls, NaN-free values, long quiet stretches and a null clip."""
    rng = random.Random(seed)
    made = []
    for c in [None, *(f"c{i}" for i in range(clips))]:
        at, level = 0, 0.0
        for _ in range(rng.randrange(1, rows)):
            at += rng.choice((1, 1, 1, 3))
            level = rng.choice((level, level, level + rng.uniform(-2, 2), rng.uniform(-100, 100)))
            made.append((c, at, None if rng.random() < 0.1 else level))
    return made


@pytest.fixture
def small_batches(spark):
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, "37")
    yield
    spark.conf.set(name, before)


def _frame(spark, rows):
    return spark.createDataFrame(rows, "c string, i long, v double").repartition(3)


@pytest.mark.parametrize("most", [0.5, 3.0, 500.0])
def test_acceptance_is_the_plain_fold(spark, small_batches, most):
    rows = _series(7, 6, 900)
    want, last, clip = {}, None, object()
    for c, i, v in rows:
        if c != clip:
            clip, last = c, None
        good = None if v is None else last is None or abs(v - last) <= most
        last = v if good else last
        want[c, i] = good
    got = series.accepted(_frame(spark, rows), "c", "i", ["v"], series.near_value(most)).collect()
    assert {(r["c"], r["i"]): r["accepted"] for r in got} == want and len(got) == len(rows)


def test_a_row_that_nothing_follows_and_one_far_behind_it(spark, small_batches):
    rows = [("a", i, 0.0 if i in (0, 950) else 50.0 + i) for i in range(1000)]
    got = series.accepted(_frame(spark, rows), "c", "i", ["v"], series.near_value(1.0)).where("accepted").collect()
    assert sorted(r["i"] for r in got) == [0, 950]


def test_best_values_are_the_plain_fold(spark, small_batches):
    rows = _series(8, 4, 700)
    want, clip = {}, object()
    for c, i, v in rows:
        if c != clip:
            clip, best, stale = c, math.inf, 0
        best, stale = (v, 0) if v is not None and v < best - 0.5 else (best, stale + 1)
        want[c, i] = (best, stale, stale >= 5)
    got = series.improvements(_frame(spark, rows), "c", "i", "v", 0.5, 5).collect()
    assert {(r["c"], r["i"]): (r["best"], r["stale"], r["stopped"]) for r in got} == want


def test_folds_of_an_empty_table(spark):
    empty = _frame(spark, [])
    assert series.accepted(empty, "c", "i", ["v"], series.near_value(1.0)).columns == ["c", "i", "v", "accepted"]
    assert series.accepted(empty, "c", "i", ["v"], series.near_value(1.0)).count() == 0
    assert series.improvements(empty, "c", "i", "v", 0.5, 5).count() == 0


@pytest.mark.parametrize("segment", [4, 10, 50_000])
def test_segments_do_not_change_windows(spark, segment):
    rows = _series(9, 3, 60)
    df = _frame(spark, rows)
    by_clip = {}
    for c, i, v in rows:
        by_clip.setdefault(c, []).append((i, v))
    mean = lambda near: None if not near else round(sum(near) / len(near))
    want_index, want_row, want_delta = {}, {}, {}
    for c, own in by_clip.items():
        for n, (i, v) in enumerate(own):
            want_index[c, i] = mean([x for j, x in own if abs(j - i) <= 6 and x is not None])
            want_row[c, i] = mean([x for _, x in own[max(0, n - 6) : n + 7] if x is not None])
            if n and own[n - 1][0] == i - 1:
                want_delta[c, i] = None if v is None or own[n - 1][1] is None else abs(v - own[n - 1][1])
    got = lambda found, out: {(r["c"], r["i"]): r[out] for r in found.collect()}
    assert got(series.smooth_by_index(df, "c", "i", ["v"], 6, segment), "v_smooth") == want_index
    assert got(series.smooth_by_row(df, "c", "i", ["v"], 6, segment), "v_smooth") == want_row
    assert got(series.consecutive_deltas(df, "c", "i", "v", segment), "delta") == want_delta


@pytest.mark.parametrize("segment", [4, 50_000])
def test_segments_do_not_change_samples(spark, segment):
    rows = [("a", i, float(i % 4)) for i in range(40)] + [("b", i, 0.0) for i in range(5)] + [(None, 1, None)]
    df = _frame(spark, rows)
    kept = sampling.capped_silence(df, "c", "i", F.col("v") < 2, 0.2, segment).collect()
    # 20 voiced rows allow floor(20 * 0.2 / 0.8) silent ones; b has one row, and an unknown level is voiced
    assert sorted(r["i"] for r in kept if r["c"] == "a" and r["v"] < 2) == [0, 1, 4, 5, 8]
    assert [(r["c"], r["i"]) for r in kept if r["c"] != "a"] in ([("b", 0), (None, 1)], [(None, 1), ("b", 0)])
    picks = sampling.spread_picks(df, "c", "i", 4, segment).collect()
    assert sorted(r["i"] for r in picks if r["c"] == "a") == [0, 13, 26, 39]
    assert len([r for r in picks if r["c"] == "b"]) == 4 and len([r for r in picks if r["c"] is None]) == 1
