"""Folds, gap filling, smoothing, windows and lags over the stand-in frame series."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators import series, sessions, sync
from .standins import BOXES, FRAMES, HEIGHT, WIDTH, boxes, frames


def continuity_fold(spark: SparkSession, sf_dir: str) -> DataFrame:
    f = frames(spark, sf_dir).select("clip_id", "frame_idx", "value")
    return series.accepted(f, "clip_id", "frame_idx", ["value"], series.near_value(40.0)).select("clip_id", "frame_idx", "accepted")


def box_continuity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Box continuity after the invalid boxes are nulled; null boxes pass through."""
    b = boxes(spark, sf_dir).select("clip_id", "frame_idx", *(F.col(c).cast("double").alias(c) for c in ("x1", "y1", "x2", "y2")))
    return series.accepted(b, "clip_id", "frame_idx", ["x1", "y1", "x2", "y2"], series.near_box(WIDTH, HEIGHT, 0.25, 4.0)).select("clip_id", "frame_idx", "accepted")


def jump_fold(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = boxes(spark, sf_dir).where("x1 is not null").select("clip_id", "frame_idx", *(F.col(c).cast("double").alias(c) for c in ("x1", "y1", "x2", "y2")))
    kept = series.accepted(b, "clip_id", "frame_idx", ["x1", "y1", "x2", "y2"], series.small_jump(WIDTH, HEIGHT))
    return kept.groupBy("clip_id").agg(F.count_if("accepted").alias("kept"), F.count_if(~F.col("accepted")).alias("dropped"))


def gap_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = boxes(spark, sf_dir).select("clip_id", "frame_idx", "x1", "y1", "x2", "y2")
    return series.fill_short_gaps(b, "clip_id", "frame_idx", ["x1", "y1", "x2", "y2"], 2)


def fill_signal(spark: SparkSession, sf_dir: str) -> DataFrame:
    f = frames(spark, sf_dir).withColumn("signal", F.when(~F.col("event_type").isin("error", "view"), F.col("value")))
    return series.fill_signal(f, "clip_id", "frame_idx", "signal", "filled").select("clip_id", "frame_idx", F.round("filled", 6).alias("filled"))


def smooth_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = boxes(spark, sf_dir).where("x1 is not null").select("clip_id", "frame_idx", "x1", "y2")
    return series.smooth_by_index(b, "clip_id", "frame_idx", ["x1", "y2"], 1).select("clip_id", "frame_idx", "x1_smooth", "y2_smooth")


def smooth_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = boxes(spark, sf_dir).where("x1 is not null").select("clip_id", "frame_idx", "x1", "y2")
    return series.smooth_by_row(b, "clip_id", "frame_idx", ["x1", "y2"], 2).select("clip_id", "frame_idx", "x1_smooth", "y2_smooth")


def temporal_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    f = frames(spark, sf_dir).where("event_type <> 'error'")
    return series.consecutive_deltas(f, "clip_id", "frame_idx", "value").groupBy("clip_id").agg(F.count("*").alias("pairs"), F.round(F.avg("delta"), 6).alias("mean_delta"))


def temporal_delta(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = Window.partitionBy("clip_id").orderBy("frame_idx")
    f = frames(spark, sf_dir).withColumn("d", F.abs(F.col("value") - F.lag("value").over(w)))
    return f.groupBy("clip_id").agg(F.round(F.coalesce(F.avg("d"), F.lit(0.0)), 6).alias("temporal_delta"))


def sync_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = sync.speech_windows(frames(spark, sf_dir), "clip_id", "value", 20, 10, 15.0, 0.7)
    return w.select("clip_id", "window_id", "start", "stop", F.round("voiced", 6).alias("voiced"), "has_speech")


def best_lag(spark: SparkSession, sf_dir: str) -> DataFrame:
    f = frames(spark, sf_dir).select("clip_id", "frame_idx", "value", F.col("k").cast("double").alias("k"))
    return sync.best_lags(f, "clip_id", "value", "k", 20, 10).select("clip_id", "window_id", "lag", F.round("correlation", 6).alias("correlation"))


def nearest_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    f = frames(spark, sf_dir).select("clip_id", "frame_idx")
    return sync.nearest_window(f, "clip_id", 20, 10).select("clip_id", "frame_idx", "window_id", "center")


def irregular_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every frame's nearest window where windows lie anywhere: a purchase is one, numbered by event, its centre up to three frames on."""
    f = frames(spark, sf_dir).select("clip_id", "frame_idx", "event_id", "event_type", "k")
    windows = f.where("event_type = 'purchase'").select("clip_id", F.col("event_id").alias("window_id"), (F.col("frame_idx") + F.pmod("k", F.lit(7)) / 2).alias("center"))
    return sync.nearest_of(f.select("clip_id", "frame_idx"), windows, "clip_id", "frame_idx", "center", "window_id")


def session_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What an encoder that passes its input on leaves in every frame's window: a frame's value stands for its block of audio."""
    f = frames(spark, sf_dir).select("clip_id", (F.col("frame_idx") - 1).alias("block"), F.array(F.col("value").cast("float")).alias("samples"))
    made = sessions.session_windows(f, "clip_id", "block", "samples", lambda samples: samples)
    total = F.aggregate("window", F.lit(0.0), lambda s, x: s + x.cast("double"))
    return made.select("clip_id", "block", F.round(total, 4).alias("total"), F.round(F.get("window", F.lit(11)).cast("double"), 4).alias("twelfth"))


def window_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every window with centre, speech, lag, confidence and the flags it gives its frames."""
    f = frames(spark, sf_dir).select("clip_id", "frame_idx", "value", F.col("k").cast("double").alias("k"))
    w = sync.window_records(f, "clip_id", "value", "k", 20, 10, 15.0, 0.7)
    flags = F.array_join(sync.window_flags(F.col("has_speech"), F.col("confidence")), ",")
    return w.select("clip_id", "window_id", "start", "stop", "center", "has_speech", "lag", F.round("correlation", 6).alias("correlation"), "confidence", flags.alias("flags"))


def sync_reject(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reject reasons by window, from its speech flag, correlation and lag."""
    f = frames(spark, sf_dir).select("clip_id", "frame_idx", "value", F.col("k").cast("double").alias("k"))
    lags = sync.best_lags(f, "clip_id", "value", "k", 20, 10)
    speech = sync.speech_windows(f, "clip_id", "value", 20, 10, 15.0, 0.7).select("clip_id", "window_id", "has_speech")
    reason = F.coalesce(sync.reject_reason(F.col("has_speech"), F.col("correlation"), F.col("lag")), F.lit(""))
    return lags.join(speech, ["clip_id", "window_id"]).groupBy(reason.alias("reason")).agg(F.count("*").alias("count"))


def lag_sweep(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mean absolute difference of value and the value ``lag`` frames later, for lags -5..5: one window each, no join."""
    w = Window.partitionBy("clip_id").orderBy("frame_idx")
    f = frames(spark, sf_dir).select("value", *(F.abs(F.col("value") - F.lag("value", -lag).over(w)).alias(f"l{lag + 5}") for lag in range(-5, 6)))
    sums = f.agg(*(F.round(F.avg(f"l{i}"), 6).alias(f"l{i}") for i in range(11)))
    return sums.select(F.inline(F.array(*(F.struct(F.lit(i - 5).cast("long").alias("lag"), F.col(f"l{i}").alias("mae")) for i in range(11)))))


def shift_audio(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every frame's value five frames on, the last one repeated at the end; windows over the clip, no array of it."""
    return series.shifted(frames(spark, sf_dir), "clip_id", "frame_idx", "k", 5, "shifted").select("clip_id", "frame_idx", "shifted")


def context_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First and last of the 20-element context of every frame; windows over the clip, no array of it."""
    w = Window.partitionBy("clip_id").orderBy("frame_idx")
    index, n = F.col("frame_idx") - 1, F.count("*").over(Window.partitionBy("clip_id"))
    f = frames(spark, sf_dir).select("clip_id", index.alias("index"), "frame_idx", "k", n.alias("n"))
    # contexts near the end start at the last place that leaves 20; a struct, as k itself may be null
    start = F.last(F.when(F.col("index") <= F.col("n") - 20, F.struct("k")), ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0))
    stop = F.when(F.col("index") <= F.col("n") - 20, F.lead("k", 19).over(w)).otherwise(F.last("k").over(w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))
    return f.select("clip_id", "index", start["k"].alias("first"), F.when(F.col("n") >= 20, stop).alias("last"))


def session_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = frames(spark, sf_dir).groupBy("clip_id").agg(F.count("*").cast("int").alias("n"))
    return n.select("clip_id", F.inline(series.session_chunks(F.col("n"))))


def session_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    f = frames(spark, sf_dir)
    n = F.lit(40)
    return f.select("clip_id", "frame_idx", series.session_row(F.col("frame_idx"), n).alias("row"))


def early_stop(spark: SparkSession, sf_dir: str) -> DataFrame:
    f = frames(spark, sf_dir).select("clip_id", "frame_idx", "value")
    return series.improvements(f, "clip_id", "frame_idx", "value", 2.0, 10).select("clip_id", "frame_idx", "best", "stale", "stopped")


def training_phase(spark: SparkSession, sf_dir: str) -> DataFrame:
    return frames(spark, sf_dir).groupBy(series.phase(F.col("frame_idx"), 60, 10, 12).alias("phase")).agg(F.count("*").alias("count"))


_CONTINUITY = f"""WITH RECURSIVE {FRAMES}, fold AS (
  SELECT clip_id, frame_idx, true AS accepted, value AS last FROM frames WHERE frame_idx = 1
  UNION ALL
  SELECT n.clip_id, n.frame_idx, abs(n.value - f.last) <= 40, CASE WHEN abs(n.value - f.last) <= 40 THEN n.value ELSE f.last END FROM fold f JOIN frames n ON n.clip_id = f.clip_id AND n.frame_idx = f.frame_idx + 1
) SELECT clip_id, frame_idx, accepted FROM fold"""


def _box_fold(source: str, close: str, out: str) -> str:
    """A fold over boxes in SQL: c is the current row, l* the last accepted box."""
    keep = ", ".join(f"CASE WHEN c.x1 IS NOT NULL AND (f.l1 IS NULL OR {close}) THEN c.{x} ELSE f.l{i} END" for i, x in enumerate(("x1", "y1", "x2", "y2"), 1))
    return f"""WITH RECURSIVE {source}, fold AS (
  SELECT clip_id, frame_idx, CASE WHEN x1 IS NOT NULL THEN true END AS accepted, x1::DOUBLE AS l1, y1::DOUBLE AS l2, x2::DOUBLE AS l3, y2::DOUBLE AS l4 FROM s WHERE frame_idx = 1
  UNION ALL
  SELECT c.clip_id, c.frame_idx, CASE WHEN c.x1 IS NULL THEN NULL WHEN f.l1 IS NULL THEN true ELSE {close} END, {keep} FROM fold f JOIN s c ON c.clip_id = f.clip_id AND c.frame_idx = f.frame_idx + 1
) {out}"""


_NEAR = f"""(sqrt((((f.l1 + f.l3) - (c.x1 + c.x2)) / 2.0 / {WIDTH})^2 + (((f.l2 + f.l4) - (c.y1 + c.y2)) / 2.0 / {HEIGHT})^2) <= 0.25
  AND (c.x2 - c.x1) / greatest(f.l3 - f.l1, 1e-9) BETWEEN 0.25 AND 4 AND (c.y2 - c.y1) / greatest(f.l4 - f.l2, 1e-9) BETWEEN 0.25 AND 4)"""
_JUMP = f"(sqrt((((f.l1 + f.l3) - (c.x1 + c.x2)) / 2.0)^2 + (((f.l2 + f.l4) - (c.y1 + c.y2)) / 2.0)^2) / sqrt({WIDTH}^2 + {HEIGHT}^2) <= 0.25)"

_AROUND = """last_value({c} IGNORE NULLS) OVER (PARTITION BY clip_id ORDER BY frame_idx ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS a_{c},
  first_value({c} IGNORE NULLS) OVER (PARTITION BY clip_id ORDER BY frame_idx ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS b_{c}"""
_GAP_COLUMNS = ", ".join(_AROUND.format(c=c) for c in ("x1", "y1", "x2", "y2", "p"))
_FILLED = ", ".join(f"CASE WHEN x1 IS NULL AND b_p - a_p - 1 <= 2 THEN round_even(a_{c} + (b_{c} - a_{c}) * ((frame_idx - a_p) / (b_p - a_p)::DOUBLE), 0)::BIGINT ELSE {c} END AS {c}" for c in ("x1", "y1", "x2", "y2"))

_WINDOWS = f"""{FRAMES}, n AS (SELECT clip_id, max(frame_idx) AS n FROM frames GROUP BY 1),
u AS (SELECT DISTINCT clip_id, n, s FROM (SELECT clip_id, n, unnest(range(0, greatest(n - 20, 0) + 1, 10)) AS s FROM n UNION ALL SELECT clip_id, n, greatest(n - 20, 0) FROM n)),
windows AS (SELECT clip_id, row_number() OVER (PARTITION BY clip_id ORDER BY s) - 1 AS window_id, s AS start, least(s + 20, n) AS stop FROM u)"""
_SPEECH = """speech AS (SELECT w.clip_id, window_id, start, stop, avg((value > 15)::INT::DOUBLE) AS voiced FROM windows w JOIN frames f ON f.clip_id = w.clip_id AND f.frame_idx > start AND f.frame_idx <= stop GROUP BY ALL)"""
_LAGS = """pairs AS (
  SELECT w.clip_id, window_id, lag, a.value AS x, b.k::DOUBLE AS y FROM windows w, (SELECT unnest(range(-3, 4)) AS lag) l
  JOIN frames a ON a.clip_id = w.clip_id AND a.frame_idx > start AND a.frame_idx <= stop JOIN frames b ON b.clip_id = w.clip_id AND b.frame_idx = a.frame_idx + lag AND b.frame_idx > start AND b.frame_idx <= stop
  WHERE abs(lag) <= least(3, greatest(0, stop - start - 2))
), m AS (SELECT *, x - avg(x) OVER p AS dx, y - avg(y) OVER p AS dy FROM pairs WINDOW p AS (PARTITION BY clip_id, window_id, lag)),
c AS (SELECT clip_id, window_id, lag, round(CASE WHEN sqrt(sum(dx*dx)) * sqrt(sum(dy*dy)) > 1e-12 THEN sum(dx*dy) / (sqrt(sum(dx*dx)) * sqrt(sum(dy*dy))) ELSE 0 END, 9) AS correlation FROM m GROUP BY 1, 2, 3),
best AS (SELECT * FROM c QUALIFY row_number() OVER (PARTITION BY clip_id, window_id ORDER BY correlation DESC, abs(lag), lag) = 1)"""
_ARRAYS = f"{FRAMES}, v AS (SELECT clip_id, list(k ORDER BY frame_idx) AS v FROM frames GROUP BY 1)"

QUERIES = {f.__name__: f for f in (
    continuity_fold, box_continuity, jump_fold, gap_fill, fill_signal, smooth_index, smooth_rows, temporal_pairs, temporal_delta, sync_windows, best_lag, nearest_window, irregular_windows, session_windows, window_records,
    sync_reject, lag_sweep, shift_audio, context_windows, session_chunks, session_rows, early_stop, training_phase,
)}

ORACLE_SQL = {
    "continuity_fold": _CONTINUITY,
    "box_continuity": _box_fold(f"{BOXES}, s AS (SELECT clip_id, frame_idx, x1, y1, x2, y2 FROM boxes)", _NEAR, "SELECT clip_id, frame_idx, accepted FROM fold"),
    "jump_fold": _box_fold(
        f"{BOXES}, s AS (SELECT clip_id, row_number() OVER (PARTITION BY clip_id ORDER BY frame_idx) AS frame_idx, x1, y1, x2, y2 FROM boxes WHERE x1 IS NOT NULL)", _JUMP,
        "SELECT clip_id, count(*) FILTER (accepted) AS kept, count(*) FILTER (NOT accepted) AS dropped FROM fold GROUP BY 1",
    ),
    "gap_fill": f"WITH {BOXES}, p AS (SELECT *, CASE WHEN x1 IS NOT NULL THEN frame_idx END AS p FROM boxes), g AS (SELECT *, {_GAP_COLUMNS} FROM p) SELECT clip_id, frame_idx, {_FILLED}, coalesce(x1 IS NULL AND b_p - a_p - 1 <= 2, false) AS interpolated FROM g",
    "fill_signal": f"WITH {FRAMES}, s AS (SELECT *, CASE WHEN event_type NOT IN ('error', 'view') THEN value END AS x, CASE WHEN event_type NOT IN ('error', 'view') THEN frame_idx END AS p FROM frames), g AS (SELECT *, {_AROUND.format(c='x')}, {_AROUND.format(c='p')} FROM s) SELECT clip_id, frame_idx, round(coalesce(x, a_x + (b_x - a_x) * ((frame_idx - a_p) / (b_p - a_p)::DOUBLE), a_x, b_x, 0), 6) AS filled FROM g",
    "smooth_index": f"WITH {BOXES} SELECT clip_id, frame_idx, round_even(avg(x1) OVER w, 0)::BIGINT AS x1_smooth, round_even(avg(y2) OVER w, 0)::BIGINT AS y2_smooth FROM boxes WHERE x1 IS NOT NULL WINDOW w AS (PARTITION BY clip_id ORDER BY frame_idx RANGE BETWEEN 1 PRECEDING AND 1 FOLLOWING)",
    "smooth_rows": f"WITH {BOXES} SELECT clip_id, frame_idx, round_even(avg(x1) OVER w, 0)::BIGINT AS x1_smooth, round_even(avg(y2) OVER w, 0)::BIGINT AS y2_smooth FROM boxes WHERE x1 IS NOT NULL WINDOW w AS (PARTITION BY clip_id ORDER BY frame_idx ROWS BETWEEN 2 PRECEDING AND 2 FOLLOWING)",
    "temporal_pairs": f"WITH {FRAMES}, d AS (SELECT clip_id, frame_idx, abs(value - lag(value) OVER w) AS delta, lag(frame_idx) OVER w AS before FROM frames WHERE event_type <> 'error' WINDOW w AS (PARTITION BY clip_id ORDER BY frame_idx)) SELECT clip_id, count(*) AS pairs, round(avg(delta), 6) AS mean_delta FROM d WHERE frame_idx = before + 1 GROUP BY 1",
    "temporal_delta": f"WITH {FRAMES}, d AS (SELECT clip_id, abs(value - lag(value) OVER (PARTITION BY clip_id ORDER BY frame_idx)) AS d FROM frames) SELECT clip_id, round(coalesce(avg(d), 0), 6) AS temporal_delta FROM d GROUP BY 1",
    "sync_windows": f"WITH {_WINDOWS}, {_SPEECH} SELECT clip_id, window_id, start, stop, round(voiced, 6) AS voiced, voiced >= 0.7 AS has_speech FROM speech",
    "best_lag": f"WITH {_WINDOWS}, {_LAGS} SELECT clip_id, window_id, lag, round(correlation, 6) AS correlation FROM best",
    "session_windows": f"""WITH {FRAMES}, b AS (SELECT clip_id, frame_idx - 1 AS block, value::FLOAT::DOUBLE AS v FROM frames),
      c AS (SELECT *, CASE WHEN block < 20 THEN 0 ELSE 20 + (block - 20) // 50 * 50 END AS start, CASE WHEN block < 20 THEN 20 ELSE 50 END AS size FROM b),
      w AS (SELECT clip_id, block, start, start + size AS stop, start + greatest(block - start - 1, 0) - 10 AS low FROM c)
      SELECT w.clip_id, w.block, round(coalesce(sum(b.v), 0), 4) AS total, round(coalesce(max(b.v) FILTER (b.block = low + 11), 0), 4) AS twelfth FROM w LEFT JOIN b ON b.clip_id = w.clip_id AND b.block BETWEEN low AND low + 19 AND b.block < stop GROUP BY 1, 2""",
    "irregular_windows": f"WITH {FRAMES}, w AS (SELECT clip_id, event_id AS window_id, frame_idx + (k % 7) / 2.0 AS center FROM frames WHERE event_type = 'purchase') SELECT f.clip_id, f.frame_idx, w.window_id, w.center::DOUBLE AS center FROM frames f LEFT JOIN w ON f.clip_id = w.clip_id QUALIFY row_number() OVER (PARTITION BY f.clip_id, f.frame_idx ORDER BY abs(w.center - f.frame_idx), w.window_id) = 1",
    "nearest_window": f"WITH {_WINDOWS} SELECT f.clip_id, f.frame_idx, w.window_id, (start + stop - 1) / 2.0 AS center FROM frames f JOIN windows w ON f.clip_id = w.clip_id QUALIFY row_number() OVER (PARTITION BY f.clip_id, f.frame_idx ORDER BY abs((start + stop - 1) / 2.0 - (f.frame_idx - 1)), window_id) = 1",
    "window_records": f"WITH {_WINDOWS}, {_SPEECH}, {_LAGS} SELECT clip_id, window_id, start, stop, (start + stop - 1) / 2.0 AS center, voiced >= 0.7 AS has_speech, lag, round(correlation, 6) AS correlation, CASE WHEN correlation >= 0.20 THEN 'high' ELSE 'low' END AS confidence, CASE WHEN voiced >= 0.7 AND correlation < 0.20 THEN 'low_sync_confidence' ELSE '' END AS flags FROM best JOIN speech USING (clip_id, window_id)",
    "sync_reject": f"WITH {_WINDOWS}, {_SPEECH}, {_LAGS} SELECT CASE WHEN voiced >= 0.7 AND correlation >= 0.20 AND abs(lag) > 2 THEN 'sync_lag' ELSE '' END AS reason, count(*) AS count FROM best JOIN speech USING (clip_id, window_id) GROUP BY 1",
    "lag_sweep": f"WITH {FRAMES} SELECT lag, round(avg(abs(a.value - b.value)), 6) AS mae FROM frames a, (SELECT unnest(range(-5, 6)) AS lag) l JOIN frames b ON a.clip_id = b.clip_id AND b.frame_idx = a.frame_idx + lag GROUP BY 1",
    "shift_audio": f"WITH {_ARRAYS} SELECT clip_id, i AS frame_idx, v[least(i + 5, len(v))] AS shifted FROM (SELECT clip_id, v, unnest(range(1, len(v) + 1)) AS i FROM v)",
    "context_windows": f"WITH {_ARRAYS}, i AS (SELECT clip_id, v, unnest(range(0, len(v))) AS i FROM v) SELECT clip_id, i AS index, CASE WHEN len(v) >= 20 THEN v[greatest(0, least(i, len(v) - 20)) + 1] END AS first, CASE WHEN len(v) >= 20 THEN v[greatest(0, least(i, len(v) - 20)) + 20] END AS last FROM i",
    "session_chunks": f"WITH {FRAMES}, n AS (SELECT clip_id, count(*) AS n FROM frames GROUP BY 1) SELECT clip_id, 0::BIGINT AS start, least(20, n) AS length FROM n UNION ALL SELECT clip_id, s, least(50, n - s) FROM (SELECT clip_id, n, unnest(range(20, n, 50)) AS s FROM n)",
    "session_rows": f"WITH {FRAMES} SELECT clip_id, frame_idx, least(greatest(frame_idx - 1, 0), 39) AS row FROM frames",
    "early_stop": f"""WITH RECURSIVE {FRAMES}, fold AS (
      SELECT clip_id, frame_idx, value AS best, 0::BIGINT AS stale FROM frames WHERE frame_idx = 1
      UNION ALL SELECT n.clip_id, n.frame_idx, CASE WHEN n.value < f.best - 2 THEN n.value ELSE f.best END, CASE WHEN n.value < f.best - 2 THEN 0 ELSE f.stale + 1 END FROM fold f JOIN frames n ON n.clip_id = f.clip_id AND n.frame_idx = f.frame_idx + 1
    ) SELECT clip_id, frame_idx, best, stale, stale >= 10 AS stopped FROM fold""",
    "training_phase": f"WITH {FRAMES} SELECT CASE WHEN frame_idx <= 10 THEN 'warmup' WHEN frame_idx > 48 THEN 'stabilization' ELSE 'main' END AS phase, count(*) AS count FROM frames GROUP BY 1",
}
