"""Hand-computed values for frame zips, motion, weights and tables per split."""

import numpy as np
import pytest

from cadenza.functions.arrays import image_metrics
from cadenza.operators import parity
from cadenza.sources import manifests


def test_zip_ends_with_the_shorter_series(spark):
    a = spark.createDataFrame([("x", 5, 1.0), ("x", 9, 2.0), ("x", 12, None), ("y", 1, 4.0), (None, 1, 6.0)], "c string, i int, a double")
    b = spark.createDataFrame([("x", 1, 7.0), ("x", 2, 8.0), ("z", 1, 3.0)], "c string, i int, b double")
    got = {(r["c"], r["position"]): (r["has_0"], r["has_1"], r["a"], r["b"]) for r in parity.zipped([a, b], "c", "i").collect()}
    assert got == {
        ("x", 0): (True, True, 1.0, 7.0), ("x", 1): (True, True, 2.0, 8.0), ("x", 2): (True, False, None, None),
        ("y", 0): (True, False, 4.0, None), ("z", 0): (False, True, None, 3.0), (None, 0): (True, False, 6.0, None),
    }
    assert parity.zipped([a.limit(0), b.limit(0)], "c", "i").count() == 0
    three = parity.zipped([a, b, b.withColumnRenamed("b", "d")], "c", "i")
    assert three.where("has_0 and has_1 and has_2").count() == 2


def test_motion_of_two_series(spark):
    rows = [("x", 1, [10, 20], [10, 20]), ("x", 2, [13, 20], [10, 24]), ("y", 1, [1, 2], [3, 4]), ("z", 1, [1, 2], [1, 2]), ("z", 2, None, [1, 2])]
    df = spark.createDataFrame(rows, "c string, i int, a array<int>, b array<int>")
    got = {(r["c"], r["i"]): (r["mae"], r["rmse"], r["max_abs"]) for r in parity.temporal_errors(df, "c", "i", "a", "b").collect()}
    assert set(got) == {("x", 2), ("z", 2)} and got["z", 2] == (None, None, None)
    assert got["x", 2] == pytest.approx((3.5, np.sqrt(12.5), 4.0))


def test_motion_similarity(spark):
    g = np.random.default_rng(3)
    a, b = g.integers(0, 256, (2, 2, 144))
    df = spark.createDataFrame([("x", i, a[i].tolist(), b[i].tolist()) for i in range(2)], "c string, i int, a array<int>, b array<int>")
    got = parity.temporal_errors(df, "c", "i", "a", "b", (12, 12)).collect()
    want = [np.clip(v[1] - v[0] + 128, 0, 255).reshape(12, 12).astype(float) for v in (a, b)]
    assert len(got) == 1 and got[0]["ssim"] == pytest.approx(image_metrics(*want, 255.0)["ssim"])
    assert got[0]["mae"] == pytest.approx(np.abs((a[1] - a[0]) - (b[1] - b[0])).mean())


def test_weights(spark):
    a = spark.createDataFrame([("w", [1.0, 2.0]), ("b", [5.0]), ("none", [])], "n string, v array<double>")
    b = spark.createDataFrame([("w", [1.5, 2.0]), ("b", [3.0]), ("none", [])], "n string, v array<double>")
    assert tuple(parity.weight_parity(a, b, "n", "v").first()) == pytest.approx((3, 2.5 / 3, 2.0))
    assert tuple(parity.weight_parity(a.limit(0), b.limit(0), "n", "v").first()) == (0, None, 0.0)
    for other in (b.where("n <> 'b'"), b.union(spark.createDataFrame([("more", [1.0])], b.schema)), spark.createDataFrame([("w", [1.0]), ("b", [3.0]), ("none", [])], b.schema)):
        with pytest.raises(Exception, match="names or sizes differ"):
            parity.weight_parity(a, other, "n", "v").collect()


def test_split_tables(spark):
    rows = spark.createDataFrame([("b", 1, "train"), ("a", 2, "train"), ("a", 1, "train"), ("c", 1, "val"), ("d", 1, "test"), ("e", 1, None)], "clip_id string, frame_idx int, split string")
    got = manifests.split_tables(rows)
    assert [tuple(r) for r in got["train"].collect()] == [("a", 1), ("a", 2), ("b", 1)] and got["val"].columns == ["clip_id", "frame_idx"]
    assert list(manifests.split_tables(rows.where("split <> 'val'"), every=False)) == ["train"]
    for bad, every in ((rows.where("split <> 'val'"), True), (rows.limit(0), False)):
        with pytest.raises(ValueError, match="no rows for splits"):
            manifests.split_tables(bad, every=every)
