"""Frame series, boxes and observations made from the driver's tables, and the same in SQL.

No table holds faces or audio, so events stand for frames (clip = user, index = order in time) and
embeddings for observations; see the README.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

WIDTH, HEIGHT = 640, 480


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = Window.partitionBy("clip_id").orderBy("ts", "event_id")
    own = table(spark, sf_dir, "events").withColumnRenamed("user_id", "clip_id")
    placed = own.withColumns({"frame_idx": F.row_number().over(w).cast("long"), "k": F.get_json_object("props", "$.k").cast("long")})
    return placed.select("clip_id", "frame_idx", "event_id", "event_type", "value", "k")


FRAMES = """frames AS (
  SELECT user_id AS clip_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS frame_idx, event_id, event_type, value, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events
)"""


def boxes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """frames with a box in a WIDTH x HEIGHT frame, null for error events."""
    f = frames(spark, sf_dir)
    x1, y1 = F.floor(F.col("value") * 2), F.col("k") * 3
    seen = F.col("event_type") != "error"
    made = {"x1": x1, "y1": y1, "x2": x1 + F.col("k") * 2 + 10, "y2": y1 + F.col("k") + F.floor("value")}
    return f.withColumns({c: F.when(seen, v).cast("long") for c, v in made.items()})


BOXES = (
    FRAMES
    + """, boxes AS (
  SELECT *, CASE WHEN event_type <> 'error' THEN floor(value * 2)::BIGINT END AS x1, CASE WHEN event_type <> 'error' THEN k * 3 END AS y1,
    CASE WHEN event_type <> 'error' THEN (floor(value * 2) + k * 2 + 10)::BIGINT END AS x2, CASE WHEN event_type <> 'error' THEN (k * 3 + k + floor(value))::BIGINT END AS y2 FROM frames
)"""
)

#: Components of an embedding that stand for geometry: (name, 1-based place, scale, offset).
PARTS = (("yaw", 1, 30.0, 0.0), ("pitch", 2, 20.0, 0.0), ("roll", 3, 20.0, 0.0), ("cx", 4, 0.2, 0.5), ("cy", 5, 0.2, 0.5), ("w", 6, 0.3, 1.0), ("h", 7, 0.3, 1.0))
POINT, MOUTH = (11, 4), (15, 2)


def observations(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """(targets, sources): odd and even vec_id of each label. Every 17th has no embedding and every 23rd no yaw."""
    e = table(spark, sf_dir, "embeddings")
    made = e.select(
        F.col("label").cast("long").alias("persona"), F.col("vec_id").alias("id"), F.when(F.col("vec_id") % 17 != 0, F.col("embedding")).alias("embedding"),
        *((F.element_at("embedding", place).cast("double") * scale + offset).alias(name) for name, place, scale, offset in PARTS),
        F.transform(F.slice("embedding", *POINT), lambda x: x.cast("double") * 0.2).alias("point"), F.transform(F.slice("embedding", *MOUTH), lambda x: x.cast("double") * 0.2).alias("mouth"),
    ).withColumn("yaw", F.when(F.col("id") % 23 != 0, F.col("yaw")))
    return made.where("id % 2 = 1"), made.where("id % 2 = 0")


OBSERVATIONS = (
    "obs AS (SELECT label::BIGINT AS persona, vec_id AS id, embedding::DOUBLE[] AS e, vec_id % 17 <> 0 AS known, "
    + ", ".join(f"CASE WHEN {'vec_id % 23 <> 0' if n == 'yaw' else 'true'} THEN embedding[{p}]::DOUBLE * {s} + {o} END AS {n}" for n, p, s, o in PARTS)
    + " FROM embeddings)"
)

#: Where the landmarks of a stand-in face lie in its box before an embedding moves them: (landmark, share of width, share of height).
FACE_MARKS = ((1, 0.5, 0.5), (33, 0.25, 0.25), (61, 0.375, 0.75), (152, 0.5, 1.0), (234, 0.0, 0.5), (263, 0.75, 0.25), (291, 0.625, 0.75), (454, 1.0, 0.5))


def faces(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Targets and sources like ``observations``, with a box and landmarks instead of geometry and ready points.

    Landmark i moves by numbers 11 + i and 21 + i of the embedding; every 29th face has no tip of the nose.
    """
    n = lambda at: F.element_at("embedding", at).cast("double")
    e = table(spark, sf_dir, "embeddings")
    sized = e.withColumns({"x1": F.floor(n(4) * 100 + 200).cast("double"), "y1": F.floor(n(5) * 100 + 120).cast("double"), "bw": F.floor(n(6) * 60 + 200).cast("double"), "bh": F.floor(n(7) * 60 + 200).cast("double")})
    marks = F.create_map(*(v for i, (mark, x, y) in enumerate(FACE_MARKS) for v in (F.lit(mark), F.struct((F.col("x1") + F.col("bw") * x + n(11 + i) * 32).alias("x"), (F.col("y1") + F.col("bh") * y + n(21 + i) * 32).alias("y")))))
    made = sized.select(
        F.col("label").cast("long").alias("persona"), F.col("vec_id").alias("id"), F.when(F.col("vec_id") % 17 != 0, F.col("embedding")).alias("embedding"),
        *(F.when(F.lit(name != "yaw") | (F.col("vec_id") % 23 != 0), n(place) * scale + offset).alias(name) for name, place, scale, offset in PARTS[:3]),
        "x1", "y1", (F.col("x1") + F.col("bw")).alias("x2"), (F.col("y1") + F.col("bh")).alias("y2"), F.lit(WIDTH).alias("frame_width"), F.lit(HEIGHT).alias("frame_height"),
        F.map_filter(marks, lambda k, v: (k != 1) | (F.col("vec_id") % 29 != 0)).alias("landmarks"),
    )
    return made.where("id % 2 = 1"), made.where("id % 2 = 0")


_STABLE = [i for i, (mark, *_) in enumerate(FACE_MARKS) if mark not in (61, 291)]
_CORNERS = [i for i, (mark, *_) in enumerate(FACE_MARKS) if mark in (61, 291)]
_AT = [(f"({x}::DOUBLE + e[{11 + i}] * 32 / bw)", f"({y}::DOUBLE + e[{21 + i}] * 32 / bh)") for i, (_, x, y) in enumerate(FACE_MARKS)]
_POINTS = ", ".join(v for i in _STABLE for v in _AT[i])
_CENTRE = ", ".join("(" + " + ".join(_AT[i][axis] for i in _CORNERS) + ") / 2" for axis in (0, 1))
FACES = f"""raw_faces AS (SELECT label::BIGINT AS persona, vec_id AS id, embedding::DOUBLE[] AS e FROM embeddings), sized_faces AS (
  SELECT *, floor(e[4] * 100 + 200) AS x1, floor(e[5] * 100 + 120) AS y1, floor(e[6] * 60 + 200) AS bw, floor(e[7] * 60 + 200) AS bh FROM raw_faces
), obs AS (
  SELECT persona, id, e, id % 17 <> 0 AS known, {", ".join(f"CASE WHEN {'id % 23 <> 0' if n == 'yaw' else 'true'} THEN e[{p}] * {s} + {o} END AS {n}" for n, p, s, o in PARTS[:3])},
    (x1 + x1 + bw) / {2.0 * WIDTH}::DOUBLE AS cx, (y1 + y1 + bh) / {2.0 * HEIGHT}::DOUBLE AS cy, bw / {WIDTH} AS w, bh / {HEIGHT} AS h,
    CASE WHEN id % 29 <> 0 THEN [{_POINTS}] END AS points, [{_CENTRE}] AS centre FROM sized_faces
)"""
