"""Queries over all their rows, against counts and values taken apart from them."""

import hashlib
import re

from cadenza.plans import metric_queries, sampling_queries, scalar_queries, series_queries
from cadenza.plans.standins import frames, table

SF = "/root/testdata/sf0.01"


def test_validation_means_has_all_orders(spark):
    rows = table(spark, SF, "orders").select("o_orderkey", "o_totalprice", "o_custkey").collect()
    batches = {}
    for r in rows:
        batches.setdefault(r[0] // 64, []).append(float(r[1]))
    got = metric_queries.validation_means(spark, SF).first()
    assert len(rows) > 1001
    assert abs(got["loss"] - sum(sum(b) / len(b) for b in batches.values()) / len(batches)) < 1e-4
    assert abs(got["mae"] - sum(r[2] for r in rows) / len(rows)) < 1e-4


def test_epoch_order_goes_to_the_end(spark):
    ids = [r[0] for r in table(spark, SF, "embeddings").select("vec_id").collect()]
    order = sorted(ids, key=lambda i: hashlib.md5(f"17:3:{i}".encode()).hexdigest())
    assert len(order) > 50
    assert sorted((r["n"], r["vec_id"]) for r in sampling_queries.epoch_order(spark, SF).collect()) == list(enumerate(order, 1))[40:]


def test_names_of_whole_texts_and_lines_of_all_frames(spark):
    texts = {r[0]: r[1] for r in table(spark, SF, "documents").select("doc_id", "text").collect() if r[1] is not None}
    got = {r["doc_id"]: r["name"] for r in scalar_queries.safe_names(spark, SF).collect()}
    assert max(map(len, got.values())) > 24
    assert all(got[i] == (re.sub(r"[^A-Za-z0-9._-]+", "_", t).strip("._") or "sample") for i, t in texts.items())
    assert scalar_queries.log_lines(spark, SF).count() == frames(spark, SF).count()


def test_context_of_every_frame(spark):
    clips = {}
    for r in sorted(frames(spark, SF).select("clip_id", "frame_idx", "k").collect()):
        clips.setdefault(r[0], []).append(r[2])
    want = {}
    for c, v in clips.items():
        for i in range(len(v)):
            at = min(i, len(v) - 20)
            want[c, i] = (v[at], v[at + 19]) if len(v) >= 20 else (None, None)
    assert {(r["clip_id"], r["index"]): (r["first"], r["last"]) for r in series_queries.context_windows(spark, SF).collect()} == want
