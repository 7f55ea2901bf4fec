"""Scalar geometry, strings and hashes over the stand-in tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import geometry, landmarks, numeric, text
from ..operators import metrics, series
from .standins import BOXES, FRAMES, HEIGHT, WIDTH, boxes, frames, table


def normalized_boxes(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = boxes(spark, sf_dir).where("x1 is not null")
    made = geometry.normalized(geometry.box(), F.lit(WIDTH), F.lit(HEIGHT))
    return b.select("event_id", *(F.round(v, 9).alias(k) for k, v in made.items()))


def angle_deltas(spark: SparkSession, sf_dir: str) -> DataFrame:
    f = frames(spark, sf_dir)
    return f.select("event_id", F.round(numeric.angle_delta(F.col("value") * 4, F.col("k") * -7.0), 6).alias("delta"))


def euler_angles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nine components of an embedding as a matrix; the first of its two branches covers nearly all rows."""
    e = table(spark, sf_dir, "embeddings")
    r = {(i, j): F.element_at("embedding", 3 * i + j + 1).cast("double") for i in range(3) for j in range(3)}
    return e.select("vec_id", *(F.round(v, 6).alias(k) for k, v in geometry.euler(r).items()))


def mouth_shapes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Openness and padded box of four points made from embedding components."""
    e = table(spark, sf_dir, "embeddings")
    p = [(F.element_at("embedding", 2 * i + 1).cast("double") * 200 + 300, F.element_at("embedding", 2 * i + 2).cast("double") * 200 + 200) for i in range(4)]
    b = geometry.padded_box([x for x, _ in p], [y for _, y in p], F.lit(WIDTH), F.lit(HEIGHT))
    return e.select("vec_id", F.round(geometry.openness(*p), 6).alias("openness"), *(v.cast("long").alias(n) for n, v in zip(("x1", "y1", "x2", "y2"), b, strict=True)))


def moved_boxes(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = boxes(spark, sf_dir).where("x1 is not null")
    made = geometry.scaled_box(geometry.box(), F.lit(WIDTH), F.lit(HEIGHT), 3, -2, 1.15)
    return b.select("event_id", *(v.alias(n) for n, v in zip(("nx1", "ny1", "nx2", "ny2"), made, strict=True)))


def square_boxes(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = boxes(spark, sf_dir).where("x1 is not null")
    made = geometry.square_box((F.col("x1") + F.col("x2")) / 2, F.col("y1"), F.col("x2") - F.col("x1") + F.lit(0.5), F.lit(WIDTH), F.lit(HEIGHT))
    return b.select("event_id", *(v.alias(n) for n, v in zip(("sx1", "sy1", "sx2", "sy2"), made, strict=True)))


def part_boxes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mouth's part of each box, and the box as widened before landmarks are looked for."""
    b = boxes(spark, sf_dir).where("x1 is not null")
    mouth, wide = geometry.mouth_part(geometry.box()), geometry.widened_box(geometry.box(), F.lit(WIDTH), F.lit(HEIGHT))
    names = [f"{p}{c}" for p in ("m", "w") for c in ("x1", "y1", "x2", "y2")]
    return b.select("event_id", *(v.alias(n) for n, v in zip(names, mouth + wide, strict=True)))


def permuted_boxes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Box JSON by frame in the order x1, x2, y1, y2, read back as x1, y1, x2, y2; rounded half to even and truncated."""
    b = boxes(spark, sf_dir).where("x1 is not null")
    half = [F.col(c) + F.lit(0.5) for c in ("x1", "x2", "y1", "y2")]
    packed = b.select("event_id", F.to_json(F.create_map(F.col("frame_idx").cast("string"), F.array(*half))).alias("js"))
    read = packed.select("event_id", F.explode(F.from_json("js", "map<string,array<double>>")).alias("frame", "v"))
    at = lambda i: F.get("v", F.lit(i))
    return read.select("event_id", F.col("frame").cast("long").alias("frame"), numeric.half_even(at(0)).alias("x1"), numeric.half_even(at(2)).alias("y1"), at(1).cast("long").alias("x2"), at(3).cast("long").alias("y2"))


def safe_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents").select("doc_id", F.col("text").alias("t"))
    return d.select("doc_id", text.safe_component(F.col("t")).alias("name"))


def media_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    f = frames(spark, sf_dir)
    written = F.when(F.col("k") % 3 == 0, F.col("k").cast("string")).otherwise(F.concat(F.col("k").cast("string"), F.lit("/"), (F.col("k") % 4).cast("string")))
    return f.select("event_id", F.round(text.rate(written), 6).alias("rate"))


def speakers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Speaker of a row from two names; the other one is empty, the same or different."""
    d = table(spark, sf_dir, "documents")
    other = F.when(F.col("doc_id") % 3 == 0, "").when(F.col("doc_id") % 3 == 1, F.col("source")).otherwise(F.col("lang"))
    return d.groupBy(text.speaker(F.col("source"), other).alias("speaker")).agg(F.count("*").alias("count"))


def content_hashes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", F.sha2("text", 256).alias("sha256"))


def json_presence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether a nested key is there, and numbers that JSON can't hold as text."""
    e = table(spark, sf_dir, "events")
    safe = F.when(F.col("value") > 300, F.lit("inf")).otherwise(F.round("value", 2).cast("string"))
    return e.groupBy(F.get_json_object("props", "$.k").isNotNull().alias("has_k"), F.get_json_object("props", "$.k.z").isNotNull().alias("has_z"), (safe == "inf").alias("infinite")).agg(F.count("*").alias("count"))


def log_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    f = frames(spark, sf_dir)
    return f.select("event_id", F.format_string("step=%d clip=%d loss=%.4f", "frame_idx", "clip_id", "value").alias("line"))


def training_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of the logged steps of every clip's run: frames are steps of 60, purchases are validated. No number here is a tie of its last digit, which SQL rounds by the binary value."""
    steps = frames(spark, sf_dir).select(
        "clip_id", F.col("frame_idx").alias("step"), F.floor((F.col("frame_idx") - 1) / 20).alias("epoch"), series.phase(F.col("frame_idx"), 60, 10, 12).alias("phase"),
        (F.col("k") / 1e6).alias("learning_rate"), (F.col("value") * 100).alias("train_loss"), F.when(F.col("event_type") == "purchase", F.col("value") / 1000).alias("val_loss"),
        F.when((F.col("event_type") == "purchase") & (F.col("k") > 50), F.col("value")).alias("val_mouth_mae"),
    )
    return steps.where(text.logged(60, 25, steps.columns)).select("clip_id", "step", text.training_line(60, steps.columns).alias("line"))


#: Where the landmarks of the stand-in faces lie before an embedding moves them.
FACE = ((234, 220, 240), (454, 420, 240), (33, 260, 200), (263, 380, 200), (152, 320, 340))


def face_squares(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The square cut out of a frame around five landmarks, moved by the first ten numbers of an embedding."""
    at = lambda n, base: F.element_at("embedding", n).cast("double") * 400 + base
    marks = F.create_map(*(v for i, (mark, x, y) in enumerate(FACE) for v in (F.lit(mark), F.struct(at(2 * i + 1, x).alias("x"), at(2 * i + 2, y).alias("y")))))
    placed = table(spark, sf_dir, "embeddings").select("vec_id", marks.alias("marks"))
    return placed.select("vec_id", *(v.alias(n) for n, v in zip(("x1", "y1", "x2", "y2"), landmarks.face_square(F.col("marks"), F.lit(WIDTH), F.lit(HEIGHT)), strict=True)))


def detector_proposals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Proposals of two anchors on 2 x 3 cells: the first 12 numbers of an embedding are scores, the next 48 offsets."""
    plane = lambda first: F.transform(F.array(F.lit(0), F.lit(3)), lambda r: F.slice("embedding", first + r, F.lit(3)))
    planes = lambda n, first: F.array(*(plane(F.lit(first + 6 * i)) for i in range(n)))
    heads = table(spark, sf_dir, "embeddings").select("vec_id", planes(2, 1).alias("scores"), planes(8, 13).alias("offsets"))
    found = metrics.proposals(heads, ["vec_id"], 8, least=0.1)
    return found.select("vec_id", "box_id", *(F.round(c, 6).alias(c) for c in ("x1", "y1", "x2", "y2", "score")))


QUERIES = {f.__name__: f for f in (
    face_squares, detector_proposals,
    normalized_boxes, angle_deltas, euler_angles, mouth_shapes, moved_boxes, square_boxes, part_boxes, permuted_boxes, safe_names, media_rates, speakers, content_hashes, json_presence, log_lines, training_log,
)}

_E = "SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings"
_PX = ", ".join(f"e[{2 * i + 1}] * 200 + 300 AS px{i}, e[{2 * i + 2}] * 200 + 200 AS py{i}" for i in range(4))
_X4, _Y4 = ", ".join(f"px{i}" for i in range(4)), ", ".join(f"py{i}" for i in range(4))

_MARKS = ", ".join(f"e[{2 * i + 1}] * 400 + {x} AS x{m}, e[{2 * i + 2}] * 400 + {y} AS y{m}" for i, (m, x, y) in enumerate(FACE))

ORACLE_SQL = {
    "face_squares": f"""WITH e AS (SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings), m AS (SELECT vec_id, {_MARKS} FROM e),
      s AS (SELECT vec_id, least(greatest(1, round_even(greatest(32, sqrt((x234 - x454)^2 + (y234 - y454)^2) * 1.056::DOUBLE), 0)), {HEIGHT}) AS s, (x234 + x454) / 2 - 1 AS cx, (y33 + y263) / 2 + (y152 - (y33 + y263) / 2) * 0.096::DOUBLE AS top FROM m),
      b AS (SELECT vec_id, s, greatest(0, least(round_even(cx - s / 2, 0), {WIDTH} - s)) AS x, greatest(0, least(round_even(top, 0), {HEIGHT} - s)) AS y FROM s)
      SELECT vec_id, x::BIGINT AS x1, y::BIGINT AS y1, (x + s)::BIGINT AS x2, (y + s)::BIGINT AS y2 FROM b""",
    "detector_proposals": """WITH c AS (SELECT vec_id, embedding::DOUBLE[] AS e, unnest(range(0, 12)) AS i FROM embeddings), k AS (SELECT *, e[i + 1] AS score, i // 6 * 24 + i % 6 + 13 AS o, i % 3 * 8 AS x, i % 6 // 3 * 8 AS y FROM c)
      SELECT vec_id, i AS box_id, round(x - e[o] * 8, 6) AS x1, round(y - e[o + 6] * 8, 6) AS y1, round(x + e[o + 12] * 8 + 1, 6) AS x2, round(y + e[o + 18] * 8 + 1, 6) AS y2, round(score, 6) AS score FROM k WHERE score >= 0.1""",
    "normalized_boxes": f"WITH {BOXES} SELECT event_id, round((x1 + x2) / (2.0 * {WIDTH}), 9)::DOUBLE AS cx, round((y1 + y2) / (2.0 * {HEIGHT}), 9)::DOUBLE AS cy, round((x2 - x1) / {WIDTH}, 9) AS w, round((y2 - y1) / {HEIGHT}, 9) AS h FROM boxes WHERE x1 IS NOT NULL",
    "angle_deltas": f"WITH {FRAMES}, d AS (SELECT event_id, value * 4 - k * -7.0::DOUBLE + 180 AS d FROM frames) SELECT event_id, round(CASE WHEN d - 360 * floor(d / 360) - 180 = -180 THEN 180 ELSE d - 360 * floor(d / 360) - 180 END, 6) AS delta FROM d",
    "euler_angles": f"WITH e AS ({_E}) SELECT vec_id, round(degrees(atan2(-e[7], sqrt(e[1]^2 + e[4]^2))), 6) AS yaw, round(degrees(CASE WHEN sqrt(e[1]^2 + e[4]^2) < 1e-6 THEN atan2(-e[6], e[5]) ELSE atan2(e[8], e[9]) END), 6) AS pitch, round(degrees(CASE WHEN sqrt(e[1]^2 + e[4]^2) < 1e-6 THEN 0 ELSE atan2(e[4], e[1]) END), 6) AS roll FROM e",
    "mouth_shapes": f"WITH e AS ({_E}), p AS (SELECT vec_id, {_PX} FROM e), b AS (SELECT *, least({_X4}) AS a, greatest({_X4}) AS c, least({_Y4}) AS b, greatest({_Y4}) AS d FROM p), q AS (SELECT *, greatest(c - a, d - b, 1) * 0.35::DOUBLE AS pad FROM b) SELECT vec_id, round(sqrt((px0 - px1)^2 + (py0 - py1)^2) / greatest(sqrt((px2 - px3)^2 + (py2 - py3)^2), 1e-6), 6) AS openness, greatest(0, floor(a - pad))::BIGINT AS x1, greatest(0, floor(b - pad))::BIGINT AS y1, least({WIDTH}, ceil(c + pad))::BIGINT AS x2, least({HEIGHT}, ceil(d + pad))::BIGINT AS y2 FROM q",
    "moved_boxes": f"WITH {BOXES}, s AS (SELECT *, greatest(32, round_even((x2 - x1) * 1.15::DOUBLE, 0)) AS w, greatest(32, round_even((y2 - y1) * 1.15::DOUBLE, 0)) AS h FROM boxes WHERE x1 IS NOT NULL), n AS (SELECT *, round_even((x1 + x2) / 2 - w / 2, 0) + 3 AS nx, round_even((y1 + y2) / 2 - h / 2, 0) - 2 AS ny FROM s) SELECT event_id, greatest(0, least(nx, {WIDTH} - 2))::BIGINT AS nx1, greatest(0, least(ny, {HEIGHT} - 2))::BIGINT AS ny1, greatest(greatest(0, least(nx, {WIDTH} - 2)) + 1, least(nx + w, {WIDTH}))::BIGINT AS nx2, greatest(greatest(0, least(ny, {HEIGHT} - 2)) + 1, least(ny + h, {HEIGHT}))::BIGINT AS ny2 FROM n",
    "square_boxes": f"WITH {BOXES}, s AS (SELECT *, least(greatest(1, round_even(x2 - x1 + 0.5::DOUBLE, 0)), {WIDTH}, {HEIGHT}) AS s FROM boxes WHERE x1 IS NOT NULL), n AS (SELECT *, greatest(0, least(round_even((x1 + x2) / 2 - s / 2, 0), {WIDTH} - s)) AS x, greatest(0, least(y1, {HEIGHT} - s)) AS y FROM s) SELECT event_id, x::BIGINT AS sx1, y::BIGINT AS sy1, (x + s)::BIGINT AS sx2, (y + s)::BIGINT AS sy2 FROM n",
    "part_boxes": f"""WITH {BOXES}, b AS (SELECT *, greatest(0, trunc(greatest(0, x1 - (x2 - x1) * 0.1::DOUBLE)))::BIGINT AS l, greatest(0, y1) AS u FROM boxes WHERE x1 IS NOT NULL)
      SELECT event_id, round_even(x1 + (x2 - x1) * 0.2::DOUBLE, 0)::BIGINT AS mx1, round_even(y1 + (y2 - y1) * 0.45::DOUBLE, 0)::BIGINT AS my1, round_even(x1 + (x2 - x1) * 0.8::DOUBLE, 0)::BIGINT AS mx2, round_even(y1 + (y2 - y1) * 0.95::DOUBLE, 0)::BIGINT AS my2,
        l AS wx1, u AS wy1, trunc(least({WIDTH} - 1.0::DOUBLE, x2 + (x2 - l) * 0.1::DOUBLE))::BIGINT AS wx2, trunc(least({HEIGHT} - 1.0::DOUBLE, y2 + (y2 - u) * 0.1::DOUBLE))::BIGINT AS wy2 FROM b""",
    "permuted_boxes": f"WITH {BOXES} SELECT event_id, frame_idx AS frame, round_even(x1 + 0.5::DOUBLE, 0)::BIGINT AS x1, round_even(y1 + 0.5::DOUBLE, 0)::BIGINT AS y1, trunc(x2 + 0.5::DOUBLE)::BIGINT AS x2, trunc(y2 + 0.5::DOUBLE)::BIGINT AS y2 FROM boxes WHERE x1 IS NOT NULL",
    "safe_names": r"SELECT doc_id, coalesce(nullif(regexp_replace(regexp_replace(text, '[^A-Za-z0-9._-]+', '_', 'g'), '^[._]+|[._]+$', '', 'g'), ''), 'sample') AS name FROM documents",
    "media_rates": f"WITH {FRAMES} SELECT event_id, round(CASE WHEN k % 3 = 0 THEN k::DOUBLE WHEN k % 4 <> 0 THEN k / (k % 4)::DOUBLE END, 6) AS rate FROM frames",
    "speakers": "WITH d AS (SELECT source, CASE doc_id % 3 WHEN 0 THEN '' WHEN 1 THEN source ELSE lang END AS other FROM documents) SELECT CASE WHEN source <> '' AND (other = '' OR other = source) THEN source ELSE '' END AS speaker, count(*) AS count FROM d GROUP BY 1",
    "content_hashes": "SELECT doc_id, sha256(text) AS sha256 FROM documents",
    "json_presence": "SELECT json_extract(props, '$.k') IS NOT NULL AS has_k, json_extract(props, '$.k.z') IS NOT NULL AS has_z, value > 300 AS infinite, count(*) AS count FROM events GROUP BY 1, 2, 3",
    "training_log": f"""WITH {FRAMES} SELECT clip_id, frame_idx AS step, printf('[train] step=%d/60 epoch=%d phase=%s lr=%.3g train_loss=%.6g', frame_idx, (frame_idx - 1) // 20, CASE WHEN frame_idx <= 10 THEN 'warmup' WHEN frame_idx > 48 THEN 'stabilization' ELSE 'main' END, k / 1e6::DOUBLE, value * 100)
      || CASE WHEN event_type = 'purchase' THEN printf(' val_loss=%.6g', value / 1000) ELSE '' END || CASE WHEN event_type = 'purchase' AND k > 50 THEN printf(' val_mouth_mae=%.6g', value) ELSE '' END AS line
      FROM frames WHERE frame_idx IN (1, 60) OR frame_idx % 25 = 0 OR event_type = 'purchase'""",
    "log_lines": f"WITH {FRAMES} SELECT event_id, printf('step=%d clip=%d loss=%.4f', frame_idx, clip_id, value) AS line FROM frames",
}
