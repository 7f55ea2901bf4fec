"""Scans over segments, quantiles by counts, co-moments by lag, nearest of a list, block search: against brute force."""

import itertools
import math
import random
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from cadenza.functions.geometry import MatchGates
from cadenza.operators import metrics, pairing, quantiles, sampling, search, series, sync

FRAMES = "clip string, i long, v double, other int"


def _clips(seed=1):
    r = random.Random(seed)
    rows = []
    for clip, n, share in (("a", 137, 0.3), ("b", 60, 0.9), ("c", 5, 0.0), ("d", 1, 1.0), (None, 40, 0.5)):
        rows += [(clip, i * (3 if clip == "b" else 1), float(r.randint(0, 90)) if r.random() < share else None, 7) for i in range(n)]
    return rows


def _by_clip(rows):
    out = {}
    for row in sorted(rows, key=lambda x: (x[0] or "", x[1])):
        out.setdefault(row[0], []).append(row)
    return out


@pytest.mark.parametrize("segment", [4, 50_000])
def test_fill_over_segments(spark, segment):
    rows = _clips()
    df = spark.createDataFrame(rows, FRAMES).repartition(3)
    filled = {(r["clip"], r["i"]): r["out"] for r in series.fill_signal(df, "clip", "i", "v", "out", segment).collect()}
    short = {(r["clip"], r["i"]): (r["v"], r["interpolated"], r["other"]) for r in series.fill_short_gaps(df, "clip", "i", ["v"], 2, segment=segment).collect()}
    near = {(r["clip"], r["i"]): r["distance"] for r in sampling.nearest_distance(df, "clip", "i", F.col("v").isNotNull(), segment=segment).collect()}
    assert len(filled) == len(short) == len(near) == len(rows)
    for clip, own in _by_clip(rows).items():
        known = [p for p, x in enumerate(own) if x[2] is not None]
        for p, (_, i, v, _) in enumerate(own):
            before, after = max((q for q in known if q <= p), default=None), min((q for q in known if q >= p), default=None)
            if not known:
                want = 0.0
            elif v is not None or before is None or after is None:
                want = v if v is not None else own[after if before is None else before][2]
            else:
                want = own[before][2] + (own[after][2] - own[before][2]) * (p - before) / (after - before)
            assert filled[clip, i] == pytest.approx(want)
            inner = v is None and before is not None and after is not None and after - before - 1 <= 2
            assert short[clip, i][1:] == (inner, 7)
            assert short[clip, i][0] == (pytest.approx(round(want)) if inner else v)
            assert near[clip, i] == min((abs(own[q][1] - i) for q in known), default=None)


def test_scans_are_linear_in_a_clip(spark):
    """One clip: eight times the frames may take far less than sixty-four times the time."""
    took = []
    for n in (50_000, 400_000):
        df = spark.range(n).select(F.lit("c").alias("clip"), F.col("id").alias("i"), F.when(F.col("id") % 97 == 0, F.col("id").cast("double")).alias("v"))
        began = time.perf_counter()
        series.fill_signal(df, "clip", "i", "v", "out").agg(F.sum("out")).collect()
        took.append(time.perf_counter() - began)
    assert took[1] < 20 * took[0] + 5


def test_spread_by_division(spark):
    sizes = sorted({(m, c) for m in (*range(1, 40), 97, 1000, 4096) for c in (1, 2, 3, 7, 8, m // 2, m) if 1 <= c <= m})
    df = spark.createDataFrame(sizes, "m long, c long").withColumn("place", F.explode(F.sequence(F.lit(0).cast("long"), F.col("m") - 1)))
    found = df.where(sampling.is_spread(F.col("place"), F.col("m"), F.col("c"))).groupBy("m", "c").agg(F.array_sort(F.collect_list("place")).alias("p")).collect()
    for r in found:
        m, c = r["m"], r["c"]
        want = sorted({0} if c == 1 else {m - 1 if k == c - 1 else math.floor(k * ((m - 1) / (c - 1))) for k in range(c)})
        assert r["p"] == want
    assert len(found) == len(sizes)


def test_quantiles_equal_percentile(spark):
    r = random.Random(4)
    rows = [("wide", r.choice([-1, 1]) * 10 ** r.uniform(-9, 12)) for _ in range(500)] + [("ties", float(r.randint(0, 4))) for _ in range(300)] + [("one", 2.5)] + [("none", None)] * 3
    rows += [("ends", x) for x in (float("inf"), float("-inf"), 1.0, 1.0, float("inf"))] + [("nan", x) for x in (1.0, float("nan"), 2.0)] + [(None, float(i)) for i in range(10)] + [("near", 1 + i * 2**-52) for i in range(30)] + [("zero", x) for x in (0.0, -0.0, 5e-324, -5e-324)]
    df = spark.createDataFrame(rows, "g string, x double").repartition(4)
    probs = [0.0, 0.05, 0.1, 0.25, 0.5, 0.77, 0.9, 0.95, 1.0]
    got = {x["g"]: (x["q"], x["h"]) for x in quantiles.quantiles(df, ["g"], {"q": F.col("x"), "h": F.col("x") / 3}, probs).collect()}
    want = {x["g"]: x["q"] for x in df.groupBy("g").agg(F.percentile("x", F.array(*map(F.lit, probs))).alias("q")).collect()}
    assert set(got) == set(want) - {"none"}
    for g, (q, _) in got.items():
        assert np.array_equal(np.array(q), np.array(want[g]), equal_nan=True), g
    whole = quantiles.quantiles(df.where("g = 'ties'"), [], {"q": F.col("x")}, [0.5]).collect()
    assert [x["q"] for x in whole] == [[want["ties"][4]]]


def test_bins_never_fall(spark):
    r = random.Random(6)
    values = sorted(r.choice([-1, 1]) * 10 ** r.uniform(-320, 308) for _ in range(5000)) + [float("inf"), float("nan")]
    bins = [x[0] for x in spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v double").orderBy("i").select(quantiles.bin_of(F.col("v"))).collect()]
    assert bins == sorted(bins)


def test_distributions_beside_groups_without_values(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 3.0), ("a", float("inf")), ("b", None), (None, 5.0)], "g string, x double")
    found = {r["g"]: r.asDict() for r in metrics.distributions(df, ["g"], F.col("x")).collect()}
    assert (found["a"]["count"], found["a"]["p50"], found["b"]["count"], found["b"]["p50"], found[None]["p90"]) == (2, 2.0, 0, None, 5.0)


def test_lags_equal_direct_correlation(spark):
    r = np.random.default_rng(7)
    clips = {"a": 77, "b": 20, "c": 9, "d": 2, "e": 1, "f": 60}
    rows = []
    for clip, n in clips.items():
        x = r.normal(size=n)
        y = np.roll(x, 2) + 0.1 * r.normal(size=n)
        if clip == "f":
            x[:] = 1e6
            x[30:] += 1e-9 * r.normal(size=30)
            y[5:40] = 3.25
        rows += [(clip, i + 1, float(a), float(b)) for i, (a, b) in enumerate(zip(x, y, strict=True))]
    df = spark.createDataFrame(rows, "c string, frame_idx long, l double, r double").repartition(3)
    got = {(x["c"], x["window_id"]): (x["lag"], x["correlation"]) for x in sync.best_lags(df, "c", "l", "r", 20, 7).collect()}
    count = 0
    for clip, n in clips.items():
        l, y = (np.array([x[k] for x in rows if x[0] == clip]) for k in (2, 3))  # noqa: E741
        starts = list(range(0, max(1, n - 20 + 1), 7))
        starts += [max(0, n - 20)] if starts[-1] + 20 < n else []
        for number, s in enumerate(sorted(set(starts))):
            a, b = l[s : s + 20], y[s : s + 20]
            best = None
            for lag in sorted(range(-3, 4), key=lambda k: (abs(k), k)):
                if abs(lag) > max(0, len(a) - 2):
                    continue
                p, q = (a[-lag:], b[:lag]) if lag < 0 else (a[: len(a) - lag], b[lag:])
                p, q = p - p.mean(), q - q.mean()
                scale = np.linalg.norm(p) * np.linalg.norm(q)
                c = round(float(p @ q / scale), 9) if scale > 1e-12 else 0.0
                if best is None or c > best[1] + 2e-9:
                    best = (lag, c)
            count += 1
            if clip != "f":
                assert got[clip, number][0] == best[0] and got[clip, number][1] == pytest.approx(best[1], abs=1e-8)
            elif s + 20 <= 30:
                assert got[clip, number] == (0, 0.0)
    assert len(got) == count


@pytest.mark.parametrize("segment", [5, 50_000])
def test_nearest_of_uneven_windows(spark, segment):
    r = random.Random(9)
    frames = [(c, i, "kept") for c, n in (("a", 80), ("b", 12), ("none", 4), (None, 6)) for i in range(n)]
    windows = [(c, k, r.choice([-3.0, r.uniform(0, 80), float(r.randint(0, 80)), r.randint(0, 160) / 2])) for c in ("a", "b", None) for k in range(25)] + [("a", 99, None), ("a", None, 3.0)]
    got = sync.nearest_of(spark.createDataFrame(frames, "clip string, i long, __extra string").withColumnRenamed("__extra", "other"), spark.createDataFrame(windows, "clip string, id long, center double"), "clip", "i", "center", "id", segment).collect()
    assert len(got) == len(frames)
    for x in got:
        own = [(abs(m - x["i"]), k, m) for c, k, m in windows if c == x["clip"] and m is not None and k is not None]
        assert (x["id"], x["center"]) == (min(own)[1:] if own else (None, None)) and x["other"] == "kept"


AXES = {"top": [0.0, 0.1, 0.2], "scale": [0.9, 1.0, 1.1], "xoff": [-2.0, 0.0], "yoff": [0.0, 3.0]}


def test_grid_equals_loops(spark, monkeypatch):
    r = np.random.default_rng(2)
    face = [(float(c), float(u), float(u + 60), 50.0) for c, u in zip(r.integers(80, 120, 90), r.integers(20, 40, 90), strict=True)]
    box = [(c - 25, u + 6, c + 25, u + 56) if i % 3 else (c - 30, u, c + 30, u + 70) for i, (c, u, _, _) in enumerate(face)]
    df = spark.createDataFrame([(*f, *b) for f, b in zip(face, box, strict=True)], "center double, upper double, lower double, width double, x1 double, y1 double, x2 double, y2 double").repartition(4)
    want = []
    for values in itertools.product(*AXES.values()):
        top, scale, xoff, yoff = values
        overlaps, drifts = [], []
        for (c, u, lo, w), (a, b, e, f) in zip(face, box, strict=True):
            side = round(w * scale)
            x, y = round(c + xoff - side / 2), round(u + (lo - u) * top + yoff)
            both = max(0, min(e, x + side) - max(a, x)) * max(0, min(f, y + side) - max(b, y))
            overlaps.append(both / ((e - a) * (f - b) + side * side - both))
            drifts.append(math.hypot((a + e) / 2 - x - side / 2, (b + f) / 2 - y - side / 2))
        want.append((*values, np.mean(overlaps), np.mean([o >= 0.995 for o in overlaps]), np.mean(drifts), np.mean([d <= 1 for d in drifts])))
    monkeypatch.setattr(search, "CHUNK", 5)
    monkeypatch.setattr(search, "SAMPLES", 16)
    names = ["iou", "iou_pass", "drift", "center_pass"]
    sums = sorted(search.grid_sums(df, AXES, search.square_errors, names).collect(), key=lambda x: x["ordinal"])
    assert [(*(x[n] for n in AXES), *(x[n] / x["samples"] for n in names)) for x in sums] == [pytest.approx(w) for w in want]
    best = {x["key"]: x["ordinal"] for x in search.calibrated(df, AXES).collect()}
    key = lambda w, by: tuple(round(float(w[4 + i]), 12) for i in by)
    first = lambda by: max(range(len(want)), key=lambda i: (key(want[i], by), -i))
    assert best == {"mean": first([0, 3]), "gate": first([1, 3, 0])}
    assert search.calibrated(df.limit(0), AXES).collect() == []


def test_first_parameters_win_ties(spark):
    df = spark.createDataFrame([(1.0,)], "x double")
    found = search.grid_sums(df, {"p": [3.0, 1.0, 2.0], "q": [0.0, 1.0]}, lambda p, r: {"e": r["x"] * 0 + p["q"] * 0}, ["e"])
    assert [(r["ordinal"], r["p"], r["q"]) for r in search.best_of(found, {"k": [F.col("e")]}).collect()] == [(0, 3.0, 0.0)]


KIND = "persona string, id long, yaw double, pitch double, roll double, cx double, cy double, w double, h double, embedding array<double>, point array<double>, mouth array<double>"


def _row(i, yaw=0.0, embedding=(1.0, 0.0)):
    return ("p", i, yaw, 0.0, 0.0, 0.5, 0.5, 1.0, 1.0, None if embedding is None else list(embedding), [0.0, 0.0], [0.0, 0.0])


def test_reasons_put_geometry_before_embeddings(spark):
    targets = [_row(1, 90.0, None), _row(2, 0.0, None), _row(3), _row(4, None), _row(5, 90.0)]
    decide = lambda sources: {r["target_id"]: r for r in pairing.decisions(spark.createDataFrame(targets, KIND), spark.createDataFrame(sources, KIND)).collect()}
    got = decide([_row(10, 0.0, None)])
    assert {k: r["reject_reason"] for k, r in got.items()} == {1: "pose_geometry_no_match", 2: "identity_embedding_missing", 3: "identity_mismatch", 4: "invalid_target_observation", 5: "pose_geometry_no_match"}
    assert got[3]["identity_mismatch_count"] == 0 and got[3]["max_rejected_similarity"] is None
    got = decide([_row(10, 0.0, None), _row(11, 1.0, (0.0, 1.0)), _row(12, 2.0)])
    assert (got[3]["status"], got[3]["source_id"], got[3]["identity_mismatch_count"], got[3]["valid_candidate_count"]) == ("matched", 12, 1, 1)
    assert got[2]["reject_reason"] == "identity_embedding_missing" and got[2]["identity_mismatch_count"] == 0


def test_gates_are_above_zero():
    with pytest.raises(ValueError, match="above 0"):
        MatchGates(yaw=0.0)


def test_small_grid_is_measured_where_samples_are_read(spark):
    """No blocks travel between two Python steps, and a task tells one sum per parameter, whatever its batches."""
    df = spark.range(30_000, numPartitions=2).selectExpr("cast(id as double) x")
    found = search.grid_sums(df, {"p": [1.0, 2.0]}, lambda p, r: {"e": r["x"] * p["p"]}, ["e"])
    assert found._jdf.queryExecution().executedPlan().toString().count("MapInArrow") == 1
    total = 29_999 * 15_000.0
    assert sorted((r["ordinal"], r["samples"], r["e"]) for r in found.collect()) == [(0, 30_000, total), (1, 30_000, 2 * total)]
