"""Landmarks inside pairing, places across clips, training logs and pictures."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from cadenza.functions import arrays, text
from cadenza.operators import pairing, scans

MARKS = {1: (0.5, 0.5), 33: (0.25, 0.25), 61: (0.375, 0.75), 152: (0.5, 1.0), 234: (0.0, 0.5), 263: (0.75, 0.25), 291: (0.625, 0.75), 454: (1.0, 0.5)}
FACE = "persona string, id long, yaw double, pitch double, roll double, x1 double, y1 double, x2 double, y2 double, frame_width int, frame_height int, embedding array<double>, landmarks map<int,struct<x:double,y:double>>"


def _face(n, yaw=0.0, nose=0.0, lips=0.0, without=None, box=(100.0, 100.0, 200.0, 200.0)):
    x1, y1, x2, y2 = box
    at = {k: (x1 + (x + (nose if k == 1 else 0.0)) * (x2 - x1), y1 + (y + (lips if k in (61, 291) else 0.0)) * (y2 - y1)) for k, (x, y) in MARKS.items() if k != without}
    return ("p", n, yaw, 0.0, 0.0, x1, y1, x2, y2, 640, 480, [1.0, 0.0], at)


def _decide(spark, target, sources):
    seen = lambda rows: pairing.observed(spark.createDataFrame(rows, FACE))
    return pairing.decisions(seen([target]), seen(sources)).first()


def test_landmarks_decide_the_match(spark):
    """A nose 0.12 of the box away is sqrt(0.12^2 / 12) = 0.0346 in the mean, 0.15 is beyond the gate of 0.04."""
    r = _decide(spark, _face(1), [_face(2, yaw=1.0, nose=0.12), _face(3, nose=0.15), _face(4, lips=0.05), _face(5, without=1), _face(6, without=61)])
    assert (r["source_id"], r["valid_candidate_count"], r["second_best_score"]) == (2, 1, None)
    assert r["stable_alignment"] == pytest.approx(math.sqrt(0.12**2 / 12), abs=1e-6) and r["mouth_delta"] == 0.0
    r = _decide(spark, _face(1), [_face(3, nose=0.15), _face(4, lips=0.05), _face(5, without=1), _face(6, without=61)])
    assert (r["reject_reason"], r["stable_failures"], r["mouth_failures"]) == ("post_crop_alignment_mismatch", 2, 2)


def test_boxes_give_the_geometry(spark):
    r = _decide(spark, _face(1), [_face(2, box=(120.0, 100.0, 225.0, 200.0))])
    assert (r["center_delta_x"], r["center_delta_y"], r["width_ratio"], r["height_ratio"]) == (pytest.approx(-22.5 / 640, abs=1e-6), 0.0, pytest.approx(100 / 105, abs=1e-6), 1.0)
    missing = list(_face(1))
    missing[5:9] = [None] * 4
    assert _decide(spark, tuple(missing), [_face(2)])["reject_reason"] == "invalid_target_observation"


def test_two_best_of_many(spark):
    """Winner, runner-up and margin are those of a full sort, whatever the number of rivals and their ties."""
    yaws = [float(x) for x in np.random.default_rng(4).integers(0, 5, 400)]
    r = _decide(spark, _face(1), [_face(10 + i, yaw=1.0 + y if i % 7 else y / 2 + 0.5) for i, y in enumerate(yaws)])
    want = sorted(((1.0 + y if i % 7 else y / 2 + 0.5) / 5, 10 + i) for i, y in enumerate(yaws) if (1.0 + y if i % 7 else y / 2 + 0.5) <= 5)
    assert (r["source_id"], r["matching_score"], r["second_best_score"], r["valid_candidate_count"]) == (want[0][1], pytest.approx(want[0][0]), pytest.approx(want[1][0]), len(want))


def test_no_pair_is_sorted_by_score(spark):
    seen = pairing.observed(spark.createDataFrame([_face(1)], FACE))
    plan = pairing.decisions(seen, seen)._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "collect_top_k" in plan


@pytest.mark.parametrize("segment", [1, 3, 50_000])
def test_places_across_clips(spark, segment):
    rows = [(g, c, i) for g in ("a", "b", None) for c in ("x", "y", None) for i in (5, 1, 9, 2)] + [("a", "x", None)]
    df = spark.createDataFrame(rows, "g string, c string, i long")
    got = {(r["g"], r["c"], r["i"]): r["place"] for r in scans.numbered(df, "g", "c", "i", segment=segment).collect()}
    key = lambda r: (r[1] is not None, r[1] or "", r[2] is not None, r[2] or 0)
    want = {r: n for g in ("a", "b", None) for n, r in enumerate(sorted((r for r in rows if r[0] == g), key=key), 1)}
    assert got == want
    assert scans.numbered(df.limit(0), "g", "c", "i").count() == 0


def test_general_numbers(spark):
    values = [0.0, 1.0, -1.5, 123456.0, 1234567.0, 0.0001, 0.00001234, 999999.5, 99999.96, 1e-300, 2.5e120, 100.0, 0.1, float("inf"), float("-inf"), None]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    for digits in (1, 3, 6):
        got = [r[0] for r in df.select(text.general(F.col("x"), digits)).collect()]
        assert got == [None if v is None else f"{v:.{digits}g}" for v in values]
    assert df.limit(1).select(text.general(F.lit(float("nan")), 3)).first()[0] == "nan"


def test_training_lines(spark):
    kind = "step long, epoch long, phase string, learning_rate double, train_loss double, val_loss double, val_mouth_loss double"
    df = spark.createDataFrame([(i, i // 4, "main", 1e-4 / i, 0.25 * i, 0.5 if i == 3 else None, 0.125 if i == 3 else None) for i in range(1, 9)], kind)
    lines = {r["step"]: r["line"] for r in df.where(text.logged(7, 4, df.columns)).select("step", text.training_line(7, df.columns).alias("line")).collect()}
    assert sorted(lines) == [1, 3, 4, 7, 8]
    assert lines[3] == "[train] step=3/7 epoch=0 phase=main lr=3.33e-05 train_loss=0.75 val_loss=0.5 val_mouth_loss=0.125"
    assert lines[4] == "[train] step=4/7 epoch=1 phase=main lr=2.5e-05 train_loss=1"
    assert df.where(text.logged(7, 0, df.columns)).isEmpty()
    plain = df.drop("val_loss")
    assert [r[0] for r in plain.where(text.logged(8, 4, plain.columns)).select("step").orderBy("step").collect()] == [1, 4, 8]


def test_pictures():
    low, high = np.full((3, 2, 2), -1.0), np.full((3, 2, 2), 0.5)
    row = arrays.side_by_side(low, high, low)
    assert row.shape == (2, 8, 3) and row[0, :, 0].tolist() == [0, 0, 191, 191, 0, 0, 191, 191]
    with pytest.raises(ValueError, match="three planes"):
        arrays.as_picture(np.zeros((2, 2, 2)))


def test_pasting():
    frame, roi, made = np.zeros((12, 12, 3), np.uint8), np.full((6, 6, 3), 10, np.uint8), np.full((4, 4, 3), 201, np.uint8)
    out = arrays.pasted(frame, (2, 3, 8, 9), roi, made, edge=1)
    assert out[3, 2, 0] == 10 and out[4, 3, 0] == 201 and out[2, 2, 0] == 0 and not frame.any() and (roi == 10).all()
    half = arrays.pasted(frame, (2, 3, 8, 9), roi, made, edge=1, keep=np.full((4, 4), 51, np.uint8))
    assert half[4, 3, 0] == 162  # 10 x 0.2 + 201 x 0.8 = 162.8, cut off
    with pytest.raises(ValueError, match="resize"):
        arrays.pasted(frame, (0, 0, 3, 3), roi, made, edge=1)
    assert arrays.pasted(frame, (0, 0, 3, 3), roi, made, edge=1, resize=lambda image, w, h: image[:h, :w])[1, 1, 0] == 201
    with pytest.raises(ValueError, match="does not fit"):
        arrays.pasted(frame, (0, 0, 6, 6), roi, made, edge=2)


SEEN = "persona string, id long, yaw double, pitch double, roll double, cx double, cy double, w double, h double, embedding array<double>, point array<double>, mouth array<double>"


def _seen(r, first, n):
    """Observations of two personas round the turn of yaw, some without vectors, with a zero or a short one, or without points."""
    out = []
    for i in range(first, first + n):
        vector = {0: None, 1: [0.0] * 3, 2: [1.0, 0.5], 3: [1.0, None, 0.0]}.get(i % 13, [float(x) for x in r.normal(size=3)])
        points = {0: None, 1: [0.0]}.get(i % 11, [float(x) for x in r.normal(0, 0.03, 2)])
        out.append((f"p{i % 2}", i, float(r.integers(176, 184)), float(r.normal(0, 3)), float(r.normal(0, 3)), float(r.normal(0.5, 0.05)), float(r.normal(0.5, 0.02)), 1.0, float(r.uniform(0.9, 1.1)), vector, points, [0.0, 0.0]))
    return out + [(None, first + n, 180.0, 0.0, 0.0, 0.5, 0.5, 1.0, 1.0, [1.0, 0.0, 0.0], [0.0, 0.0], [0.0, 0.0])]


@pytest.mark.parametrize(("dealt", "cells"), [(16_384, 1 << 18), (17, 40)])
def test_decisions_in_tiles_are_those_of_all_pairs(spark, monkeypatch, dealt, cells):
    """No pair is exchanged, and chunks of a cell give what a list of all pairs gives."""
    r = np.random.default_rng(8)
    t, s = (spark.createDataFrame(_seen(r, first, 240), SEEN) for first in (0, 1000))
    gates = pairing.MatchGates(similarity=0.1)
    want = {}
    for x in pairing.candidates(t, s, gates).collect():
        want.setdefault(x["target_id"], []).append(x)
    monkeypatch.setattr(pairing, "DEALT", dealt)
    monkeypatch.setattr(pairing, "CELLS", cells)
    decided = pairing.decisions(t, s, gates)
    plan = decided._jdf.queryExecution().executedPlan().toString()
    assert "FlatMapCoGroupsInArrow" in plan and "__cx" not in plan
    got = {x["target_id"]: x for x in decided.collect()}
    assert len(got) == 241 and sum(map(len, want.values())) > 1000
    for i, x in got.items():
        pairs = want.get(i, [])
        alike = [p for p in pairs if p["similarity"] is not None and p["similarity"] >= 0.1]
        other = [p for p in pairs if p["compared"] and p not in alike]
        good = sorted((p["score"], p["source_id"]) for p in alike if p["alignment"] is not None and p["alignment"] <= 0.04 and p["mouth_delta"] <= 0.04)
        first, second = (*good, (None, None), (None, None))[:2]
        near = lambda v: None if v is None else pytest.approx(v, abs=1e-6)
        assert (x["source_id"], x["matching_score"], x["second_best_score"], x["valid_candidate_count"]) == (first[1], near(first[0]), near(second[0]), len(good))
        assert (x["identity_mismatch_count"], x["max_rejected_similarity"]) == (len(other), near(max((p["similarity"] for p in other if p["similarity"] is not None), default=None)))
        assert x["stable_failures"] == (0 if good else sum(p["alignment"] is None or p["alignment"] > 0.04 for p in alike))
