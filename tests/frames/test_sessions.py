"""Sessions with carry-over, caches per clip, checks before publishing, pinned clips, examples, logs, gates."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from cadenza.operators import metrics, sampling, sessions
from cadenza.plans import snapshot
from cadenza.sources import manifests, sinks


def _blocks(spark, sizes):
    r = np.random.default_rng(3)
    whole = {clip: r.normal(size=(n, 4)).astype(np.float32) for clip, n in sizes.items()}
    rows = [(clip, i, [float(x) for x in row]) for clip, m in whole.items() for i, row in enumerate(m)]
    return whole, spark.createDataFrame(rows, "clip string, block long, samples array<float>").repartition(5)


SIZES = {"a": 1, "b": 9, "c": 20, "d": 21, "e": 70, "f": 133, "g": 270}


def test_an_identity_encoder_gives_the_file_back(spark):
    whole, df = _blocks(spark, SIZES)
    rows = sessions.session_features(df, "clip", "block", "samples", lambda x: x).collect()
    assert len(rows) == sum(SIZES.values())
    for r in rows:
        assert np.array_equal(np.array(r["features"], np.float32), whole[r["clip"]][r["block"]])


def _direct(m, encode):
    """Chunk after chunk in a loop."""
    out, at, tail = [], 0, np.zeros((0, m.shape[1]), np.float32)
    while at < len(m):
        now = m[at : at + (20 if at == 0 else 50)]
        lead = 0 if at == 0 else 10
        whole = np.zeros((lead + len(now) + 20, m.shape[1]), np.float32)
        whole[lead + 10 - len(tail) : lead + 10], whole[lead + 10 : lead + 10 + len(now)] = tail, now
        rows = encode(whole)[lead : lead + len(now) + 19]
        out += [rows[min(max(i - 1, 0), len(rows) - 20) :][:20] for i in range(len(now))]
        tail, at = now[-10:], at + len(now)
    return out


def test_windows_see_the_chunk_before(spark):
    encode = lambda x: np.stack([np.cumsum(x.sum(1)), np.arange(len(x))], 1).astype(np.float32)
    whole, df = _blocks(spark, SIZES)
    got = {(r["clip"], r["block"]): np.array(r["window"]).reshape(-1, 2) for r in sessions.session_windows(df, "clip", "block", "samples", encode).collect()}
    assert len(got) == sum(SIZES.values())
    for clip, m in whole.items():
        for i, want in enumerate(_direct(m, encode)):
            assert np.allclose(got[clip, i], want, atol=1e-4)


def test_a_short_encoder_is_an_error(spark):
    _, df = _blocks(spark, {"a": 5})
    with pytest.raises(Exception, match="of 24 rows"):
        sessions.session_features(df, "clip", "block", "samples", lambda x: x[:3]).collect()
    assert sessions.session_features(df.limit(0), "clip", "block", "samples", lambda x: x).collect() == []


def _clips(spark, changed=(), dropped=()):
    return spark.createDataFrame([(f"c{i}", f"d{i}{'+' if i in changed else ''}") for i in range(12) if i not in dropped], "clip_id string, digest string")


def test_only_changed_clips_are_computed(spark, tmp_path):
    seen = []

    def compute(todo):
        seen.append({r["clip_id"] for r in todo.collect()})
        return todo.where("clip_id <> 'c4'").select("clip_id", F.explode(F.array(F.lit(1), F.lit(2))).alias("x"), F.col("digest").alias("of"))

    run = lambda clips, **settings: sinks.cached_clips(spark, str(tmp_path), "s", clips, {"v": 1} | settings, compute)
    rows, counts = run(_clips(spark))
    assert counts == {"hits": 0, "misses": 12} and rows.count() == 22 and set().union(*seen) == {f"c{i}" for i in range(12)}
    seen.clear()
    rows, counts = run(_clips(spark))
    assert counts == {"hits": 12, "misses": 0} and rows.count() == 22 and not seen
    rows, counts = run(_clips(spark, changed=(3,), dropped=(7,)))
    assert counts == {"hits": 10, "misses": 1} and seen == [{"c3"}]
    found = rows.collect()
    assert len(found) == 20 and {r["of"] for r in found if r["clip_id"] == "c3"} == {"d3+"} and not any(r["clip_id"] == "c7" for r in found)
    assert run(_clips(spark))[1] == {"hits": 12, "misses": 0}  # what a clip was before is still there
    assert run(_clips(spark), other=2)[1]["misses"] == 12


def test_a_failed_run_keeps_what_it_finished(spark, tmp_path):
    calls = []

    def compute(todo):
        calls.append(todo.count())
        if len(calls) == 3:
            raise RuntimeError("lost")
        return todo.select("clip_id", F.lit(1).alias("x"))

    run = lambda: sinks.cached_clips(spark, str(tmp_path), "s", _clips(spark), {}, compute)
    with pytest.raises(RuntimeError):
        run()
    done = calls[0] + calls[1]
    rows, counts = run()
    assert counts == {"hits": done, "misses": 12 - done} and rows.count() == 12


def test_cache_map(spark):
    df = spark.createDataFrame([("a", "x", True), ("b", "x", False), ("a", "y", True)], "clip string, stage string, hit boolean")
    assert {k: tuple(v) for k, v in metrics.cache_map(df).first()["cache"].items()} == {"x": (1, 1), "y": (1, 0)}


def test_publishing_checks_audio_and_splits(spark, tmp_path):
    kind = "pair_id string, clip_id string, frame_idx long, split string, valid_candidate_count long, audio array<array<double>>"
    row = lambda i, split, audio: (f"p{i}", "c", i, split, 1, audio)
    good, live = [[0.0, 1.0], [2.0, 3.0]], str(tmp_path / "live")
    made = lambda rows: spark.createDataFrame(rows, kind)
    publish = lambda rows: snapshot.publish(made(rows), made(rows).select("pair_id"), live, "audio", (2, 2))
    with pytest.raises(ValueError, match="1 rows audio_shape, first p2"):
        publish([row(1, "train", good), row(2, "val", good[:1])])
    with pytest.raises(ValueError, match="not_finite"):
        publish([row(1, "train", good), row(2, "val", [[0.0, float("nan")], [1.0, 1.0]])])
    with pytest.raises(ValueError, match="'val'"):
        publish([row(1, "train", good)])
    publish([row(1, "train", good), row(2, "val", good)])
    assert manifests.read_snapshot(spark, live).count() == 2


def test_pinned_clips(spark):
    df = spark.createDataFrame([("a", 0), ("b", 1), ("a", 2), ("c", 3), ("c", 4)], "c string, i long")
    got = lambda **k: sorted(r["i"] for r in sampling.first_groups(df, "c", "i", 0, 1, **k).collect())
    assert got(pinned=("c", "b")) == [1, 3]
    with pytest.raises(ValueError, match="zz"):
        got(pinned=("a", "zz"))
    with pytest.raises(ValueError):
        got()


def test_examples_of_reasons(spark):
    df = spark.createDataFrame([(0, "b"), (1, "a"), (2, "a"), (3, "b"), (4, "c"), (5, "a"), (6, None)], "i long, r string")
    assert sorted((x["r"], x["i"], x["place"]) for x in metrics.reason_examples(df, "r", "i", 2, 2).collect()) == [("a", 1, 1), ("a", 2, 2), ("b", 0, 1), ("b", 3, 2)]


def test_logged_steps(spark):
    df = spark.range(1, 24).select(F.col("id").alias("step"), F.when(F.col("id") == 13, 1.0).alias("val"))
    steps = lambda n, *c: sorted(r["step"] for r in sampling.log_rows(df, "step", 23, n, c).collect())
    assert steps(10, "val") == [1, 10, 13, 20, 23] and steps(10) == [1, 10, 20, 23] and steps(0) == []


def test_all_gates(spark):
    one = spark.createDataFrame([(0.0, 0.0, 0.02, 0.95, 0.94, 0.999, 1.0, None, 2.0, 1.0, 2.1)], ", ".join(f"{c} double" for _, c, _, _ in metrics.PARITY_GATES))
    assert [r["passed"] for r in metrics.parity_gates(one).collect()] == [True, True, True, True, False, True, True, False, True, True, False]
