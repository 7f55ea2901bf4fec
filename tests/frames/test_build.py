"""Settings of a build, previews, the face square and a detector's proposals."""

import math

import pytest
from pyspark.sql import functions as F

from cadenza.functions import landmarks
from cadenza.functions.geometry import MatchGates
from cadenza.operators import metrics, pairing
from cadenza.plans import snapshot
from cadenza.sources import config

NEEDED = {"data_root": "/d", "persona_id": "p", "snapshot_root": "/s", "work_root": "/w", "wenet_onnx": "/m"}


def test_settings_of_a_file(tmp_path):
    path = tmp_path / "build.yaml"
    path.write_text("\n".join(f"{k}: {v}" for k, v in NEEDED.items()) + """
idle_max_ratio: 0.3
preview_count_per_group: 2
matching:
  max_center_y_delta: 0.2
  max_height_ratio: 1.5
  max_stable_landmark_rmse: 0.5
post_crop_alignment:
  max_stable_landmark_rmse: 0.06
identity:
  min_cosine_similarity: 0.5
blur:
  min_source_face_laplacian_variance: 10
sync:
  max_lag_frames: 5
""")
    got = config.read_settings(str(path))
    g = got.build.gates
    assert (g.centers(), g.ratios(), g.alignment, g.mouth, g.similarity) == ((0.05, 0.2), {"w": (0.9, 1.1), "h": (0.9, 1.5)}, 0.06, 0.04, 0.5)
    assert (got.build.source_blur, got.build.face_blur, got.build.idle_ratio, got.build.val_share, got.build.preview) == (10, 60.0, 0.3, 0.2, 2)
    assert (got.sync["max_lag_frames"], got.sync["stride_seconds"], got.job["fps"], got.job["data_root"]) == (5, 1.0, 25, "/d")


@pytest.mark.parametrize(("payload", "why"), [
    ([], "mapping"), ({}, "needed"), (NEEDED | {"colour": 1}, "unknown settings"), (NEEDED | {"matching": {"yaw": 1}}, "unknown settings of matching"), (NEEDED | {"blur": 3}, "blur must be a mapping"),
])
def test_faulty_settings(payload, why):
    with pytest.raises(ValueError, match=why):
        config.settings(payload)


def test_own_gates_of_height_and_vertical_centre(spark):
    row = "persona string, id long, yaw double, pitch double, roll double, cx double, cy double, w double, h double, embedding array<double>, point array<double>, mouth array<double>"
    make = lambda i, cy, h: ("p", i, 0.0, 0.0, 0.0, 0.5, cy, 1.0, h, [1.0], [0.0, 0.0], [0.0, 0.0])
    t, s = spark.createDataFrame([make(1, 0.6, 1.3)], row), spark.createDataFrame([make(2, 0.5, 1.0)], row)
    assert pairing.decisions(t, s).first()["reject_reason"] == "pose_geometry_no_match"
    got = pairing.decisions(t, s, MatchGates(center_y=0.2, high_height=1.5)).first()
    assert (got["source_id"], got["center_delta_y"], got["height_ratio"]) == (2, 0.1, 1.3)
    assert abs(got["matching_score"] - (0.5 + math.log(1.3) / math.log(1.5))) < 1e-6


def test_nine_preview_groups(spark):
    rows = [
        (f"p{i}", i, float(i % 3), None if i == 4 else 1.0 / (i + 1), float(-i), 0.0, 1.0, 0.0, float(i) / 10, 1.0 / (i + 1), 1.0, 0.01 * i, 0.0, 1.0 - i / 10, "low" if i in (1, 2) else "high", i == 3)
        for i in range(5)
    ]
    df = spark.createDataFrame(rows, (
        "pair_id string, frame_idx long, matching_score double, score_margin double, pose_delta_yaw double, pose_delta_pitch double, pose_delta_roll double, center_delta_x double, center_delta_y double, "
        "width_ratio double, height_ratio double, stable_alignment double, mouth_delta double, identity_similarity double, confidence string, is_idle boolean"
    ))
    got = {}
    for r in sorted(snapshot.previews(df, 3).collect(), key=lambda r: r["rank"]):
        got.setdefault(r["group"], []).append(r["frame_idx"])
    last = [4, 3, 2]
    assert got == {
        "best_score": [0, 3, 1], "smallest_margin": [3, 2, 1], "near_pose_threshold": last, "near_center_threshold": last, "near_scale_threshold": last, "near_post_crop_threshold": last,
        "near_identity_threshold": last, "low_sync_confidence": [1, 2], "idle_retained": [3],
    }
    assert snapshot.previews(df.limit(0)).isEmpty()


def test_face_square(spark):
    marks = {234: (100.0, 100.0), 454: (200.0, 100.0), 33: (120.0, 80.0), 263: (180.0, 80.0), 152: (150.0, 180.0)}
    df = spark.createDataFrame([(1, marks), (2, {k: (x + 500, y) for k, (x, y) in marks.items()}), (3, {k: v for k, v in marks.items() if k != 152}), (4, None)], "i int, m map<int,struct<x:double,y:double>>")
    got = {r["i"]: tuple(r)[1:] for r in df.select("i", *landmarks.face_square(F.col("m"), F.lit(640), F.lit(480))).collect()}
    # 105.6 wide about 149, from 80 + 100 * 0.096; pushed in from the right
    assert got == {1: (96, 90, 202, 196), 2: (534, 90, 640, 196), 3: (None,) * 4, 4: (None,) * 4}


def test_proposals(spark):
    zero = [[0.0, 0.0], [0.0, 0.0]]
    one = lambda v: [[0.0, 0.0], [0.0, v]]
    rows = [("a", [[[0.1, 0.3], [None, 0.2]], one(0.9)], [*[zero] * 4, one(1.0), one(0.5), one(2.0), one(3.0)]), ("b", [], []), ("c", None, None)]
    df = spark.createDataFrame(rows, "f string, scores array<array<array<double>>>, offsets array<array<array<double>>>")
    got = sorted(tuple(r) for r in metrics.proposals(df, ["f"], 8).collect())
    assert got == [("a", 1, 8.0, 0.0, 9.0, 1.0, 0.3), ("a", 7, 0.0, 4.0, 25.0, 33.0, 0.9)]
    assert metrics.suppressed(metrics.proposals(df, ["f"], 8), ["f"], "score").count() == 2
