"""Hand-computed values for the frame-series operators."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from cadenza.functions import arrays, audio, geometry, numeric, text, vectors
from cadenza.operators import metrics, pairing, sampling, series, sync


def _rows(df, *keys):
    return sorted(tuple(r[k] for k in keys) for r in df.collect())


def test_bbox_reasons(spark):
    df = spark.createDataFrame([(1, 50, 50, 50, 80), (2, -1, 0, 50, 50), (3, 0, 0, 20, 50), (4, 0, 0, 95, 95), (5, 10, 10, 60, 60)], "i int, x1 int, y1 int, x2 int, y2 int")
    got = _rows(df.select("i", geometry.quality_reason(geometry.box(), F.lit(100), F.lit(100)).alias("r")), "i", "r")
    assert got == [(1, "invalid"), (2, "outside_frame"), (3, "too_small"), (4, "too_large"), (5, None)]


def test_continuity_compares_with_last_accepted(spark):
    df = spark.createDataFrame([("a", 1, 50.0, 50.0, 150.0, 150.0), ("a", 2, 120.0, 50.0, 200.0, 130.0), ("a", 3, 51.0, 50.0, 151.0, 150.0), ("a", 4, None, None, None, None)], "c string, i int, x1 double, y1 double, x2 double, y2 double")
    got = series.accepted(df, "c", "i", ["x1", "y1", "x2", "y2"], series.near_box(200, 200))
    assert _rows(got, "i", "accepted") == [(1, True), (2, False), (3, True), (4, None)]


def test_jump(spark):
    df = spark.createDataFrame([("a", 1, 10.0, 10.0, 50.0, 50.0), ("a", 2, 150.0, 150.0, 190.0, 190.0)], "c string, i int, x1 double, y1 double, x2 double, y2 double")
    assert _rows(series.accepted(df, "c", "i", ["x1", "y1", "x2", "y2"], series.small_jump(200, 200)), "i", "accepted") == [(1, True), (2, False)]


def test_gap_fill(spark):
    rows = [(1, 10, 10, 110, 110), (2, None, None, None, None), (3, 14, 10, 114, 110), (4, None, None, None, None), (5, None, None, None, None), (6, 20, 10, 120, 110)]
    df = spark.createDataFrame([("a", *r) for r in rows], "c string, i int, x1 int, y1 int, x2 int, y2 int")
    got = _rows(series.fill_short_gaps(df, "c", "i", ["x1", "y1", "x2", "y2"], 1), "i", "x1", "y1", "x2", "y2", "interpolated")
    assert got[1] == (2, 12, 10, 112, 110, True)
    assert got[3][1:] == (None, None, None, None, False) and got[4][1] is None


def test_fill_signal(spark):
    df = spark.createDataFrame([("a", i, v) for i, v in enumerate([None, 1.0, None, 3.0, None])] + [("b", 0, None)], "c string, i int, v double")
    got = series.fill_signal(df, "c", "i", "v", "f")
    assert [r[1] for r in _rows(got.where("c = 'a'"), "i", "f")] == [1, 1, 2, 3, 3]
    assert got.where("c = 'b'").first()["f"] == 0.0


def test_smoothing_is_by_index(spark):
    df = spark.createDataFrame([("a", 1, 10), ("a", 2, 20), ("a", 5, 100)], "c string, i int, x int")
    assert _rows(series.smooth_by_index(df, "c", "i", ["x"], 1), "i", "x_smooth") == [(1, 15), (2, 15), (5, 100)]
    assert _rows(series.smooth_by_row(df, "c", "i", ["x"], 1), "i", "x_smooth") == [(1, 15), (2, 43), (5, 60)]


def test_best_lag(spark):
    audio_, mouth = [0, 1, 0, 1, 0, 1, 0, 1], [0, 0, 1, 0, 1, 0, 1, 0]
    df = spark.createDataFrame([("a", i + 1, float(x), float(y)) for i, (x, y) in enumerate(zip(audio_, mouth, strict=True))], "c string, frame_idx long, a double, m double")
    row = sync.best_lags(df, "c", "a", "m", 50, 25).first()
    assert (row["lag"], round(row["correlation"], 6)) == (1, 1.0)
    flat = df.withColumn("m", F.lit(1.0))
    assert sync.best_lags(flat, "c", "a", "m", 50, 25).first()["correlation"] == 0.0


def test_windows(spark):
    df = spark.createDataFrame([("a", i + 1) for i in range(60)], "c string, frame_idx long")
    assert _rows(sync.window_starts(df, "c", 50, 25), "window_id", "start", "stop") == [(0, 0, 50), (1, 10, 60)]
    for width, stride, n in ((50, 25, 75), (20, 10, 40), (20, 10, 47), (7, 3, 5), (6, 5, 33)):
        df = spark.createDataFrame([("a", i + 1) for i in range(n)], "c string, frame_idx long")
        windows = _rows(sync.window_starts(df, "c", width, stride), "window_id", "start", "stop")
        want = {i + 1: min(windows, key=lambda w: (abs((w[1] + w[2] - 1) / 2 - i), w[0]))[0] for i in range(n)}
        assert dict(_rows(sync.nearest_window(df, "c", width, stride), "frame_idx", "window_id")) == want
    near = dict(_rows(sync.nearest_window(spark.createDataFrame([("a", i + 1) for i in range(40)], "c string, frame_idx long"), "c", 20, 10), "frame_idx", "window_id"))
    assert near[15] == 0 and near[16] == 1 and near[26] == 2  # 0-based frames 14, 15 and 25; centres 9.5, 19.5 and 29.5


def test_window_flags(spark):
    df = spark.createDataFrame([(True, "low"), (True, "high"), (False, "low")], "s boolean, c string")
    assert [r[0] for r in df.select(sync.window_flags(F.col("s"), F.col("c"))).collect()] == [["low_sync_confidence"], [], []]


def test_folds_keep_other_columns(spark):
    """64-bit ids beside nulls, decimals and structs pass through a fold unchanged."""
    rows = [("a", i, float(i), None if i == 1 else 2**60 + i, "x" if i % 2 else None, (2**61 + i, None)) for i in range(6)]
    df = spark.createDataFrame(rows, "c string, i long, v double, big long, s string, st struct<p:long,q:string>").withColumn("d", F.lit("1.10").cast("decimal(20,2)"))
    out = series.accepted(df, "c", "i", ["v"], series.near_value(1.0))
    assert out.columns[:-1] == df.columns and [f.dataType for f in out.schema][:-1] == [f.dataType for f in df.schema]
    assert sorted(tuple(r)[:-1] for r in out.collect()) == sorted(tuple(r) for r in df.collect())


def test_sync_reject(spark):
    df = spark.createDataFrame([(True, 0.10, 3), (True, 0.3, 3), (False, 0.9, 3), (True, 0.9, 2)], "s boolean, c double, l int")
    assert [r[0] for r in df.select(sync.reject_reason(F.col("s"), F.col("c"), F.col("l"))).collect()] == [None, "sync_lag", None, None]


def _observation(persona, i, yaw=0.0, roll=0.0, who=0, dx=0.0, mouth=0.0):
    e = [0.0] * 4
    e[who] = 1.0
    return (persona, i, yaw, 0.0, roll, 0.5, 0.5, 0.5, 0.5, [3.0 * x for x in e] if i % 2 else e, [dx, 0.0, 0.0, 0.0], [0.0, mouth])


OBSERVATION = "persona string, id long, yaw double, pitch double, roll double, cx double, cy double, w double, h double, embedding array<double>, point array<double>, mouth array<double>"


def _decide(spark, target, sources):
    t, s = spark.createDataFrame([target], OBSERVATION), spark.createDataFrame(sources, OBSERVATION)
    return pairing.decisions(t, s).first()


def test_match_alignment_comes_first(spark):
    r = _decide(spark, _observation("p", 100), [_observation("p", 1, dx=0.2), _observation("p", 2, yaw=1.0)])
    assert (r["source_id"], r["valid_candidate_count"], r["second_best_score"], r["score_margin"]) == (2, 1, None, None)


def test_match_mouth_gate(spark):
    """The mouth gate rejects by itself; failures are counted per gate where nothing matches."""
    r = _decide(spark, _observation("p", 100), [_observation("p", 1, mouth=0.2), _observation("p", 2, yaw=1.0)])
    assert (r["source_id"], r["valid_candidate_count"], r["mouth_failures"]) == (2, 1, 0)
    r = _decide(spark, _observation("p", 100), [_observation("p", 1, mouth=0.2), _observation("p", 2, dx=0.2, mouth=0.2)])
    assert (r["reject_reason"], r["stable_failures"], r["mouth_failures"]) == ("post_crop_alignment_mismatch", 1, 2)


def test_match_needs_an_observation(spark):
    whole = _observation("p", 100)
    assert _decide(spark, (*whole[:9], None, *whole[10:]), [_observation("p", 1)])["reject_reason"] == "identity_embedding_missing"
    assert _decide(spark, (*whole[:2], None, *whole[3:]), [_observation("p", 1)])["reject_reason"] == "invalid_target_observation"


def test_match_ranks_on_the_unrounded_score(spark):
    r = _decide(spark, _observation("p", 100), [_observation("p", 1, yaw=1e-10), _observation("p", 2, yaw=1e-11)])
    assert r["source_id"] == 2


def test_match_identity(spark):
    r = _decide(spark, _observation("p", 100), [_observation("p", 1, who=1), _observation("p", 2, yaw=1.0)])
    assert (r["source_id"], r["identity_similarity"], r["identity_mismatch_count"], r["max_rejected_similarity"]) == (2, 1.0, 1, 0.0)
    r = _decide(spark, _observation("p", 100), [_observation("p", 1, who=1), _observation("p", 2, who=2)])
    assert (r["reject_reason"], r["identity_mismatch_count"], r["max_rejected_similarity"]) == ("identity_mismatch", 2, 0.0)


def test_match_ties_and_gates(spark):
    r = _decide(spark, _observation("p", 100), [_observation("p", 2), _observation("p", 1)])
    assert (r["source_id"], r["valid_candidate_count"], r["score_margin"]) == (1, 2, 0.0)
    assert _decide(spark, _observation("p", 100, yaw=20.0), [_observation("p", 1)])["reject_reason"] == "pose_geometry_no_match"
    assert _decide(spark, _observation("p", 100), [_observation("q", 1)])["reject_reason"] == "pose_geometry_no_match"
    assert _decide(spark, _observation("p", 100, roll=-179.0), [_observation("p", 1, roll=179.0)])["source_id"] == 1
    assert _decide(spark, _observation("p", 100, yaw=-178.0), [_observation("p", 1, yaw=179.0)])["source_id"] == 1


def test_all_pairs_match_without_bins(spark):
    """The binned equi-join finds what a plain comparison of all pairs finds."""
    r = np.random.default_rng(1)
    make = lambda n, o: [(f"p{i % 3}", o + i, float(r.uniform(-180, 180)), 0.0, 0.0, 0.5, 0.5, 0.5, 0.5, [1.0, 0.0, 0.0, 0.0], [0.0] * 4, [0.0] * 2) for i in range(n)]
    t, s = make(80, 0), make(80, 1000)
    got = {(x["target_id"], x["source_id"]) for x in pairing.candidates(spark.createDataFrame(t, OBSERVATION), spark.createDataFrame(s, OBSERVATION)).collect()}
    want = {(a[1], b[1]) for a in t for b in s if a[0] == b[0] and abs((a[2] - b[2] + 180) % 360 - 180) <= 5}
    assert got == want


def test_idle_cap(spark):
    df = spark.createDataFrame([("a", i, i >= 100) for i in range(200)], "c string, i long, speech boolean")
    got = [r[0] for r in _rows(sampling.idle_sample(df, "c", "i", ~F.col("speech"), 0.10), "i")]
    assert len(got) == 10 and got == sorted(got) and min(got) == 60 and max(got) == 99


def test_silence_cap(spark):
    df = spark.createDataFrame([("a", i, i - 1 < 8) for i in range(1, 11)], "c string, i long, silent boolean")
    assert sampling.capped_silence(df, "c", "i", F.col("silent"), 0.5).count() == 4


def test_splits(spark):
    ids = spark.createDataFrame([(f"c{i}",) for i in range(10)], "c string")
    got = sampling.hash_split(ids, "c", "p:", 0.2)
    assert dict(_rows(got.groupBy("split").count(), "split", "count")) == {"train": 8, "val": 2}
    assert _rows(got, "c", "split") == _rows(sampling.hash_split(ids.repartition(7), "c", "p:", 0.2), "c", "split")
    df = spark.createDataFrame([("a", 0, 10), ("a", 8, 10), ("a", 9, 10)], "c string, i long, n long")
    assert [r[0] for r in df.select(sampling.tail_split(F.col("i"), F.col("n"), 0.2)).collect()] == ["train", "val", "val"]


def test_media_selection(spark):
    df = spark.createDataFrame(list(enumerate("aaabbc")), "i long, c string")
    assert [r[0] for r in _rows(sampling.first_groups(df, "c", "i", 2, 2), "i")] == [0, 1, 3, 4]


def test_spread_index_is_linspace(spark):
    rows = [(k, m, c) for m in range(1, 60, 7) for c in range(1, m + 1) for k in range(c)]
    got = spark.createDataFrame(rows, "k int, m int, c int").select("k", "m", "c", numeric.spread_index(F.col("k"), F.col("m"), F.col("c")).alias("i")).collect()
    assert all(r["i"] == np.linspace(0, r["m"] - 1, r["c"], dtype=int)[r["k"]] for r in got)


def test_phase_and_improvement(spark):
    df = spark.createDataFrame([(1,), (3,), (9,)], "s int")
    assert [r[0] for r in df.select(series.phase(F.col("s"), 10, 2, 2)).collect()] == ["warmup", "main", "stabilization"]
    run = spark.createDataFrame([("a", i, v) for i, v in enumerate([5.0, 4.9, 3.0, 3.5, 3.4])], "c string, i int, v double")
    assert _rows(series.improvements(run, "c", "i", "v", 0.5, 2), "i", "best", "stale", "stopped")[-1] == (4, 3.0, 2, True)


def test_shift_and_context(spark):
    df = spark.createDataFrame([([0, 1, 2, 3, 4], list(range(30)))], "v array<int>, w array<int>")
    r = df.select(series.shift_window(F.col("v"), 2), series.context_window(F.col("w"), F.lit(0)), series.context_window(F.col("w"), F.lit(29)), series.context_window(F.col("v"), F.lit(0))).first()
    assert r[0] == [2, 3, 4, 4, 4] and r[1] == list(range(20)) and r[2] == list(range(10, 30)) and r[3] is None


def test_session_chunks(spark):
    want = [(0, 20), (20, 50), (70, 50), (120, 1)]
    assert audio.session_chunks(121) == want and audio.session_chunks(0) == []
    got = spark.range(1).select(F.inline(series.session_chunks(F.lit(121)))).collect()
    assert [tuple(r) for r in got] == want


def test_temporal_pairs_need_consecutive_frames(spark):
    df = spark.createDataFrame([("a", 1, 1.0), ("a", 2, 4.0), ("a", 5, 9.0), ("b", 3, 1.0)], "c string, i long, v double")
    assert _rows(series.consecutive_deltas(df, "c", "i", "v"), "c", "delta") == [("a", 3.0)]


def test_boxes(spark):
    df = spark.createDataFrame([(0, 0, 10, 10, 1, 0, 11, 10)], "x1 int, y1 int, x2 int, y2 int, a int, b int, c int, d int")
    r = df.select(geometry.iou(geometry.box(), geometry.box("a", "b", "c", "d")), geometry.center_drift(geometry.box(), geometry.box("a", "b", "c", "d"))).first()
    assert r[0] == pytest.approx(90 / 110) and r[1] == 1.0


def test_numbers(spark):
    df = spark.createDataFrame([(0.5,), (1.5,), (2.5,)], "x double")
    assert [r[0] for r in df.select(numeric.half_even(F.col("x"))).collect()] == [0, 2, 2]
    d = spark.createDataFrame([(-179.0, 179.0), (0.0, 180.0)], "t double, s double").select(numeric.angle_delta(F.col("t"), F.col("s"))).collect()
    assert [r[0] for r in d] == [2.0, 180.0]
    odd = spark.createDataFrame([(1.0,), (float("nan"),), (float("inf"),), (3.0,)], "x double").agg(*numeric.distribution(F.col("x"))).first()
    assert (odd["count"], odd["mean"], odd["std"], odd["p50"]) == (2, 2.0, 1.0, 2.0)


def test_strings(spark):
    df = spark.createDataFrame([("a b/c.mp4", "25/1", "Al", ""), ("..", "7", "Al", "Bo"), ("_x_", "1/0", "", "Bo")], "n string, r string, s string, o string")
    got = df.select(text.safe_component(F.col("n")), text.rate(F.col("r")), text.speaker(F.col("s"), F.col("o"))).collect()
    assert [tuple(r) for r in got] == [("a_b_c.mp4", 25.0, "Al"), ("sample", 7.0, ""), ("x", None, "")]


def test_names_take_one_pass(spark):
    """Outer dots and bars go without a second expression over the text, whose runs inside would be tried from each of their places; null has the default name."""
    df = spark.createDataFrame([("a" + "_." * 200_000 + "b",), (None,), ("._a b_.",)], "n string").select(text.safe_component(F.col("n")).alias("n"))
    assert df._jdf.queryExecution().optimizedPlan().toString().count("regexp_replace") <= 1
    assert [r["n"] for r in df.collect()] == ["a" + "_." * 200_000 + "b", "sample", "a_b"]


def test_vectors(spark):
    r = spark.createDataFrame([([3.0, 4.0], [0.0, 0.0])], "a array<double>, z array<double>").select(vectors.unit(F.col("a")), vectors.unit(F.col("z")), vectors.dot(F.col("a"), F.col("a"))).first()
    assert r[0] == [0.6, 0.8] and r[1] is None and r[2] == 25.0


def test_suppression(spark):
    rows = [("a", 1, 0, 0, 10, 10, 0.9), ("a", 2, 1, 0, 11, 10, 0.8), ("a", 3, 50, 50, 60, 60, 0.1)]
    df = spark.createDataFrame(rows, "g string, box_id long, x1 long, y1 long, x2 long, y2 long, score double")
    assert [r[0] for r in _rows(metrics.suppressed(df, ["g"], "score", 0.45), "box_id")] == [1, 3]


def test_suppression_of_many_frames_has_no_python(spark):
    """Ties go to the smaller box_id, boxes without score come last, unknown sides overlap nothing; frames are an aggregate."""
    r = np.random.default_rng(3)
    rows = []
    for g in ("a", "b", None):
        for i in range(40):
            x, y = (float(v) for v in r.integers(0, 30, 2))
            rows.append((g, i, x, y, None if i == 7 else float("nan") if i == 8 else x + 20, y + 20, None if i % 9 == 4 else float(r.integers(0, 5))))
    out = metrics.suppressed(spark.createDataFrame(rows, "g string, box_id long, x1 double, y1 double, x2 double, y2 double, score double"), ["g"], "score", 0.3)
    assert "Pandas" not in out._jdf.queryExecution().executedPlan().toString()
    want = set()
    for g in ("a", "b", None):
        kept = []
        for b in sorted((b for b in rows if b[0] == g), key=lambda b: (b[6] is None, -(b[6] or 0.0), b[1])):
            if b[4] is None or b[4] != b[4] or not any(_overlap(b, k) > 0.3 for k in kept if k[4] is not None and k[4] == k[4]):
                kept.append(b)
        want |= {(g, b[1]) for b in kept}
    assert {(x["g"], x["box_id"]) for x in out.collect()} == want and 6 < len(want) < 100


def _overlap(a, b):
    both = max(0.0, min(a[4], b[4]) - max(a[2], b[2])) * max(0.0, min(a[5], b[5]) - max(a[3], b[3]))
    return both / ((a[4] - a[2]) * (a[5] - a[3]) + (b[4] - b[2]) * (b[5] - b[3]) - both)


def test_common_reasons_ties_by_first(spark):
    df = spark.createDataFrame([(0, "b"), (1, "a"), (2, "a"), (3, "b"), (4, "c")], "i int, r string")
    assert [x["r"] for x in metrics.common_reasons(df, "r", "i", 2).collect()] == ["b", "a"]


def test_batch_means(spark):
    df = spark.createDataFrame([(0, 1.0), (1, 1.0), (2, 4.0)], "i long, v double").withColumn("w", F.col("v"))
    assert tuple(metrics.batch_then_mean(df, "i", 2, ["v"], ["w"]).first()) == (2.5, 2.0)


def test_images():
    zero, one = np.zeros((24, 24)), np.ones((24, 24))
    m = arrays.image_metrics(zero, one)
    assert (m["mae"], m["rmse"], m["max_abs"]) == (1.0, 1.0, 1.0)
    assert arrays.image_metrics(one, one)["psnr"] == float("inf") and arrays.ssim_gaussian(one, one) == pytest.approx(1.0) and arrays.ssim_box(one, one) == pytest.approx(1.0)
    assert arrays.laplacian_variance(one) == 0.0
    a = np.zeros((2, 1, 4, 4))
    b = a.copy()
    a[1], b[1] = 0.5, 1.0
    assert arrays.temporal_error(a, b, (1, 1, 3, 3)) == 0.5
    assert arrays.charbonnier(a, a)[0] == pytest.approx(1e-3)
    assert (arrays.to_bytes(arrays.to_signed(np.arange(256, dtype=np.uint8))) == np.arange(256)).all()


def test_audio():
    x = np.arange(641, dtype=np.float32)
    b = audio.blocks(x)
    assert b.shape == (2, 640) and b[1, 0] == 640 and not b[1, 1:].any()
    assert audio.levels(np.ones(640, np.float32), 3).tolist() == [1.0, 0.0, 0.0]
    f = np.arange(30)[:, None] * np.ones((1, 4))
    assert audio.context_window(f, 29)[0, 0] == 10 and audio.context_window(f, 0)[-1, 0] == 19
    with pytest.raises(ValueError):
        audio.context_window(f[:5], 0)
    hz = np.array([100.0, 999.0, 1000.0, 5000.0])
    assert np.allclose(audio.mel_to_hz(audio.hz_to_mel(hz)), hz)
    m = audio.mel_spectrum(np.zeros(1600))
    assert m.shape == (11, 80) and np.allclose(m, -70.0)
    tone = audio.mel_spectrum(np.sin(2 * np.pi * 1000 * np.arange(8000) / 16000))
    assert abs(audio.mel_to_hz(np.linspace(0, audio.hz_to_mel(8000.0), 82))[1 + tone.mean(axis=0).argmax()] - 1000) < 60


def test_image_udf(spark):
    df = spark.createDataFrame(pd.DataFrame({"a": [[0.0] * 256], "b": [[1.0] * 256]}))
    r = df.select(arrays.image_metrics_udf(16, 16)("a", "b").alias("m")).first()["m"]
    assert (r["mae"], r["rmse"]) == (1.0, 1.0)


MARKS = {1: (100, 90), 10: (100, 45), 13: (100, 112), 14: (100, 120), 33: (70, 70), 61: (82, 118), 133: (90, 70), 152: (100, 150), 234: (55, 100), 263: (130, 70), 291: (118, 118), 362: (110, 70), 454: (145, 100)}


def test_landmarks(spark):
    from cadenza.functions import landmarks

    kind = "a map<int,struct<x:double,y:double>>, b map<int,struct<x:double,y:double>>, x1 int, y1 int, x2 int, y2 int, u1 int, v1 int, u2 int, v2 int"
    a = {k: (float(x), float(y)) for k, (x, y) in MARKS.items()}
    b = {k: (x + 10, y + 20) for k, (x, y) in a.items()}
    df = spark.createDataFrame([(a, b, 50, 40, 150, 160, 60, 60, 160, 180), ({k: v for k, v in a.items() if k != 61}, b, 50, 40, 150, 160, 60, 60, 160, 180)], kind)
    rmse, mouth = landmarks.alignment(F.col("a"), geometry.box(), F.col("b"), geometry.box("u1", "v1", "u2", "v2"))
    rows = df.select(rmse.alias("r"), mouth.alias("m"), landmarks.five_points(F.col("a")).alias("p")).collect()
    assert (rows[0]["r"], rows[0]["m"]) == (0.0, 0.0) and rows[1]["p"] is None
    assert [tuple(p) for p in rows[0]["p"]] == [(80, 70), (120, 70), (100, 90), (82, 118), (118, 118)]


def test_contours(spark):
    from cadenza.functions import landmarks

    assert len(landmarks.CONTOUR_68) == 68
    r = np.random.default_rng(2)
    pts = r.uniform(40, 200, (98, 2))
    df = spark.createDataFrame([([tuple(map(float, p)) for p in pts],)], "p array<struct<x:double,y:double>>")
    row = df.select(landmarks.contour_68(F.col("p")).alias("c")).select("c", landmarks.contour_roi(F.col("c"), F.lit(640), F.lit(480)).alias("roi")).first()
    c = np.array([tuple(x) for x in row["c"]])
    assert np.allclose(c[0], pts[0]) and np.allclose(c[37], (pts[60] + pts[62]) / 2) and np.allclose(c[67], pts[95])
    x1, y1, x2, y2 = row["roi"]
    assert 0 <= x1 < x2 < 640 and 0 <= y1 < y2 < 480
