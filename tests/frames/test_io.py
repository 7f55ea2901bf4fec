"""Sources, sinks, the snapshot build, and the driver contract."""

import io
import json
import wave

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from cadenza.plans import snapshot
from cadenza.sources import manifests, sinks


def test_manifest(spark, tmp_path):
    good = {"clip_id": "a", "frame_idx": 1, "audio_idx": 0, "frame_path": "clips/a/1.jpg", "bnf_path": "clips/a/b.npy", "bbox_xyxy": [80, 40, 240, 200], "split": "train", "flags": []}
    path = tmp_path / "m.jsonl"
    path.write_text("\n".join(json.dumps(x) for x in (good, good | {"split": "val"})) + "\n\n")
    assert manifests.read_manifest(spark, str(path)).count() == 2
    assert manifests.read_manifest(spark, str(path), "val").count() == 1
    assert manifests.manifest_faults(manifests.read_manifest(spark, str(path))).count() == 0
    path.write_text(json.dumps(good | {"frame_path": "../x"}) + "\n" + json.dumps(good | {"bbox_xyxy": [1, 2, 3]}))
    assert {r["fault"] for r in manifests.manifest_faults(manifests.read_manifest(spark, str(path))).collect()} == {"bad_path", "bad_bbox"}
    path.write_text('{"clip_id": "a", "frame_idx": "x"}')
    with pytest.raises(Exception):
        manifests.read_manifest(spark, str(path)).collect()


def test_write_manifest_counts_splits(spark, tmp_path):
    df = spark.createDataFrame([("a", "train"), ("b", "train"), ("c", "val")], "clip_id string, split string")
    assert sinks.write_manifest(df, str(tmp_path / "out")) == {"train": 2, "val": 1}
    assert json.loads((tmp_path / "out" / "splits.json").read_text()) == {"train": 2, "val": 1}


def test_publish_keeps_the_old_snapshot_on_failure(spark, tmp_path):
    live = str(tmp_path / "live")
    sinks.write_snapshot(spark.createDataFrame([("a", "train", 1), ("b", "val", 2)], "clip_id string, split string, v int"), live)
    assert manifests.read_snapshot(spark, live).count() == 2
    with pytest.raises(OSError):
        sinks.publish(spark, str(tmp_path / "missing"), live)
    assert manifests.read_snapshot(spark, live).count() == 2
    sinks.write_snapshot(spark.createDataFrame([("a", "train", 1)], "clip_id string, split string, v int"), live)
    with pytest.raises(ValueError):
        manifests.read_snapshot(spark, live)


def test_waveforms_and_features(spark, tmp_path):
    data = io.BytesIO()
    with wave.open(data, "wb") as w:
        w.setnchannels(2), w.setsampwidth(2), w.setframerate(8000)
        w.writeframes(np.repeat(np.array([0, 16384, -16384, 0], "<i2"), 2).tobytes())
    (tmp_path / "a.wav").write_bytes(data.getvalue())
    got = manifests.read_waveforms(spark, str(tmp_path / "*.wav")).first()["samples"]
    assert len(got) == 8 and max(got) == pytest.approx(0.5, abs=0.1) and got[0] == 0.0
    np.save(tmp_path / "b.npy", np.arange(6, dtype=np.float32).reshape(3, 2))
    rows = manifests.read_features(spark, str(tmp_path / "*.npy")).orderBy("row").collect()
    assert [r["values"] for r in rows] == [[0, 1], [2, 3], [4, 5]]


def test_media_listing(spark, tmp_path):
    for name in ("s1/video/b.MP4", "s1/video/a.mov", "s2/video/c.mkv", "s2/video/d.txt"):
        p = tmp_path / "root" / name
        p.parent.mkdir(parents=True, exist_ok=True)
        p.write_bytes(b"x")
    got = manifests.media_files(spark, str(tmp_path / "root"), recursive=True).collect()
    assert [(r["group"], r["path"].rsplit("/", 1)[1]) for r in got] == [("s1", "a.mov"), ("s1", "b.MP4"), ("s2", "c.mkv")]
    assert manifests.media_files(spark, str(tmp_path / "root"), recursive=True, limit=1).count() == 1


def test_boxes_json(spark, tmp_path):
    (tmp_path / "o.json").write_text(json.dumps({"000001": [1.5, 9.5, 2.5, 8.2]}))
    assert tuple(manifests.read_boxes(spark, str(tmp_path / "o.json")).first()) == (1, 2, 2, 10, 8)
    assert tuple(manifests.read_boxes(spark, str(tmp_path / "o.json"), truncate=True).first()) == (1, 1, 2, 9, 8)


def test_one_source():
    assert manifests.one_source("x", None) == ("local", "x")
    for bad in ((None, None), ("a", "b")):
        with pytest.raises(ValueError):
            manifests.one_source(*bad)


def test_cache_builds_once(spark, tmp_path):
    calls = []

    def build():
        calls.append(1)
        return spark.range(3)

    assert [sinks.cached(spark, str(tmp_path), "s", {"v": v}, build)[1] for v in (1, 1, 2)] == [False, True, False]
    assert len(calls) == 2


def _frames(spark, rows):
    schema = (
        "persona string, clip_id string, frame_idx long, id long, yaw double, pitch double, roll double, cx double, cy double, w double, h double, embedding array<double>, point array<double>, mouth array<double>, "
        "landmark_valid boolean, bbox_continuity_valid boolean, face_blur double, mouth_blur double, audio_available boolean, sync_rejected boolean, speech boolean, observed_reason string, confidence string"
    )
    return spark.createDataFrame(rows, schema)


def test_snapshot_build(spark):
    row = lambda c, i, n, **k: ("p", c, i, n, k.get("yaw", 0.0), 0.0, 0.0, 0.5, 0.5, 0.5, 0.5, [1.0, 0.0], [0.0, 0.0], [0.0, 0.0], k.get("ok", True), True, k.get("blur", 100.0), 100.0, True, False, k.get("speech", True), k.get("why"), "low" if i % 2 else "high")
    targets = [row(f"c{c}", i, c * 100 + i, ok=i not in (3, 6), why="face_too_small" if i == 6 else None, blur=10.0 if i == 4 else 100.0, yaw=40.0 if i == 5 else 0.0, speech=i < 30) for c in range(4) for i in range(1, 41)]
    decisions, pairs = snapshot.build(_frames(spark, targets), _frames(spark, [row("s", 1, 9001), row("s", 2, 9002, blur=20.0)]))
    decisions = decisions.cache()
    assert decisions.count() == len(targets)
    counts = {r["reject_reason"]: r["count"] for r in decisions.groupBy("reject_reason").count().collect()}
    assert counts["landmark_missing"] == counts["target_face_blur"] == counts["pose_geometry_no_match"] == 4
    assert counts["face_too_small"] == 4
    kept = pairs.collect()
    assert all(r["flags"] == (["low_sync_confidence"] if r["speech"] and r["frame_idx"] % 2 else []) for r in kept)
    assert snapshot.row_fault(pairs).isEmpty()
    wild = pairs.withColumn("matching_score", F.when(F.col("frame_idx") == 1, float("nan")).otherwise(F.col("matching_score"))).withColumn("valid_candidate_count", F.when(F.col("frame_idx") == 2, 0).otherwise(1))
    assert {r["fault"] for r in snapshot.row_fault(wild).collect()} == {"not_finite", "no_valid_candidate"}
    one_clip = _frames(spark, [row("c0", i, i) for i in range(1, 4)])
    with pytest.raises(Exception, match="at least two clips"):
        snapshot.build(one_clip, _frames(spark, [row("s", 1, 9001)]))[1].collect()
    assert counts[None] == len(kept) and counts["idle_downsampled"] == 4 * 11 - sum(r["is_idle"] for r in kept)
    assert sum(r["is_idle"] for r in kept) == 4 * 2 and {r["source_id"] for r in kept} == {9001}
    assert {r["sample_weight"] for r in kept if r["is_idle"]} == {0.25}
    assert len({r["split"] for r in kept}) == 2 and all(len({r["split"] for r in kept if r["clip_id"] == c}) == 1 for c in ("c0", "c1"))
    report = {r["clip_id"]: r for r in snapshot.report(decisions).collect()}
    assert len(report) == 4
    first = report["c0"]
    assert first["rejection_counts"] == {"landmark_missing": 1, "face_too_small": 1, "target_face_blur": 1, "pose_geometry_no_match": 1, "idle_downsampled": 9}
    assert (first["clip_status"], first["speech_windows"], first["idle_windows"], first["low_confidence_frames"]) == ("ready", 29, 11, 20)
    assert (first["blur_target_face_distribution"]["count"], first["blur_target_face_distribution"]["min"], first["matching_score_distribution"]["count"]) == (40, 10.0, first["retained"])
    assert first["matching_score_margin_distribution"] is None and "correlation_distribution" not in first.asDict()


def test_plug_point_is_made_once_per_task(spark):
    def make():
        seen = []

        def model(part):
            seen.append(len(part))
            return pd.DataFrame({"id": part["id"], "batches": len(seen)})

        return model

    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "5")
    try:
        out = snapshot.analysed(spark.range(0, 20, 1, 1), make, "id long, batches long").agg(F.max("batches")).first()[0]
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "10000")
    assert out == 4


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    names = set(entry.queries())
    assert set(entry.oracle_sql()) <= names and "pair_decisions" in names
