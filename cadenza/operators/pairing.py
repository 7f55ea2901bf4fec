"""Best-match pairing of target frames with source frames of the same persona.

A pair has to pass seven range gates (pose, centre, size ratio), then an identity gate on the cosine
of its embeddings, then two alignment gates (stable landmarks, mouth centre); of what is left the
lowest score wins, ties to the smaller source frame. Every target gets one decision with the first
reason that applies. A target without box or pose is decided before any candidate; embeddings count
only once geometry has: a target without one is told so where some source is in reach, and sources
without one are in reach but neither alike nor mismatches.

Decisions are made in tiles. Yaw and pitch are cut into bins as wide as their gates; a target lies in the
cell (persona, yaw, pitch) of its bins and each source is listed in its own and the neighbouring ones. A cell
with more than DEALT rows of a side is dealt to chunks, and every two chunks meet in one task, so a persona
whose frames all look ahead is still spread over tasks. A task compares its targets, in order of the
horizontal centre, with the sources in reach of that, as matrices of bounded size; only counts and the two
best of each target leave it. Rows with their vectors cross the network once per cell and chunk, pairs never.
``candidates`` lists the pairs themselves, by an equi-join of ids and geometry in the same bins.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.internal import InternalFunction

from ..functions.geometry import MatchGates, box, match_score, normalized
from ..functions.landmarks import aligned
from ..functions.numeric import angle_delta
from ..functions.vectors import dot, norm, unit

GEOMETRY = ("yaw", "pitch", "roll", "cx", "cy", "w", "h")
DIFFERENCES = ("pose_delta_yaw", "pose_delta_pitch", "pose_delta_roll", "center_delta_x", "center_delta_y", "width_ratio", "height_ratio")
#: Rows of a side of a cell that one task holds, and pairs of a matrix that it holds at once.
DEALT, CELLS = 16_384, 1 << 18
WON = ("source_id", "similarity", "alignment", "mouth_delta", *(f"d_{c}" for c in GEOMETRY))
COUNTED = ("geometry_count", "identity_count", "valid_candidate_count", "identity_mismatch_count", "stable_failures", "mouth_failures")


def observed(frames: DataFrame, marks: str = "landmarks", width: str = "frame_width", height: str = "frame_height") -> DataFrame:
    """``frames`` with what pairing compares: centre and size of the box x1, y1, x2, y2 as shares of the frame, and landmarks as shares of the box.

    ``marks`` is a map<int, struct<x, y>>. A frame without box or frame size has null geometry; one that lacks a stable
    landmark or a mouth corner is in reach of others but aligned with none.
    """
    point, mouth = aligned(F.col(marks), box())
    return frames.withColumns(normalized(box(), F.col(width), F.col(height)) | {"point": point, "mouth": mouth})


def turned_bin(angle: str, gate: float) -> tuple[Column, int]:
    """(bin of an angle, number of bins), at least as wide as the gate."""
    bins = max(1, int(360 // gate))
    return F.floor(F.pmod(F.col(angle), F.lit(360.0)) / (360.0 / bins)), bins


def near(at: Column, bins: int | None) -> Column:
    """A bin and its neighbours, each once; round a circle of ``bins``."""
    around = F.transform(F.array(F.lit(-1), F.lit(0), F.lit(1)), lambda d: at + d if bins is None else F.pmod(at + d, F.lit(bins)))
    return F.array_distinct(around)


def in_reach(targets: DataFrame, sources: DataFrame, gates: MatchGates = MatchGates()) -> DataFrame:
    """Pairs that pass the range gates: (persona, target_id, source_id) and the differences d_*."""

    yaw, yaws = turned_bin("yaw", gates.yaw)
    pitch, pitches = turned_bin("pitch", gates.pitch)
    across = F.floor(F.col("cx") / gates.center)
    t = targets.select("persona", F.col("id").alias("target_id"), *(F.col(c).alias(f"t_{c}") for c in GEOMETRY), yaw.alias("__yaw"), pitch.alias("__pitch"), across.alias("__cx"))
    s = sources.select("persona", F.col("id").alias("source_id"), *(F.col(c).alias(f"s_{c}") for c in GEOMETRY), near(yaw, yaws).alias("__yaw"), near(pitch, pitches).alias("__pitch"), near(across, None).alias("__cx"))
    for c in ("__yaw", "__pitch", "__cx"):
        s = s.withColumn(c, F.explode(c))
    pairs = t.join(s, ["persona", "__yaw", "__pitch", "__cx"])
    turned = {c: angle_delta(F.col(f"t_{c}"), F.col(f"s_{c}")) for c in GEOMETRY[:3]}
    moved = {c: F.col(f"t_{c}") - F.col(f"s_{c}") for c in GEOMETRY[3:5]}
    sized = {c: F.col(f"t_{c}") / F.col(f"s_{c}") for c in GEOMETRY[5:]}
    pairs = pairs.select("persona", "target_id", "source_id", *(v.alias(f"d_{c}") for c, v in (turned | moved | sized).items()))
    d = {c: F.col(f"d_{c}") for c in GEOMETRY}
    inside = [F.abs(d["yaw"]) <= gates.yaw, F.abs(d["pitch"]) <= gates.pitch, F.abs(d["roll"]) <= gates.roll, F.abs(d["cx"]) <= gates.centers()[0], F.abs(d["cy"]) <= gates.centers()[1]]
    inside += [d[c].between(*ends) for c, ends in gates.ratios().items()]
    for gate in inside:
        pairs = pairs.where(gate)
    return pairs


def candidates(targets: DataFrame, sources: DataFrame, gates: MatchGates = MatchGates()) -> DataFrame:
    """Pairs in reach with score, similarity, alignment and mouth_delta; ``compared`` if both sides have an embedding.

    Both sides have persona, id, GEOMETRY, embedding, point (array<double> of aligned coordinates of the
    stable landmarks) and mouth (array<double>, the mouth's centre likewise).
    """
    own = lambda df, p: df.select(F.col("id").alias("target_id" if p == "t" else "source_id"), unit(F.col("embedding")).alias(f"{p}_unit"), F.col("embedding").isNotNull().alias(f"{p}_known"), F.col("point").alias(f"{p}_point"), F.col("mouth").alias(f"{p}_mouth"))
    # the target's vectors come last, so that pairs leave this join partitioned by target
    pairs = in_reach(targets, sources, gates).join(own(sources, "s"), "source_id").join(own(targets, "t"), "target_id")
    square = lambda a, b: F.aggregate(F.zip_with(a, b, lambda x, y: (x - y) * (x - y)), F.lit(0.0), lambda x, y: x + y)
    return pairs.select(
        "persona", "target_id", "source_id", *(f"d_{c}" for c in GEOMETRY), dot(F.col("t_unit"), F.col("s_unit")).alias("similarity"), (F.col("t_known") & F.col("s_known")).alias("compared"),
        F.sqrt(square("t_point", "s_point") / F.size("t_point")).alias("alignment"), F.sqrt(square("t_mouth", "s_mouth")).alias("mouth_delta"),
        match_score({c: F.col(f"d_{c}") for c in GEOMETRY}, gates).alias("score"),
    )


def numbers(column: pa.ChunkedArray, fill: float) -> tuple[np.ndarray, np.ndarray]:
    """Lists as (matrix with a row per place, their lengths): short ones end in ``fill``, a null is ``fill`` throughout, of length -1."""
    lists = pa.chunked_array(column).combine_chunks()
    size = pc.fill_null(pc.list_value_length(lists), -1).to_numpy(zero_copy_only=False)
    width = max(0, int(size.max(initial=0)))
    out = np.full((len(size), width), fill)
    out[np.arange(width) < size[:, None]] = lists.flatten().to_numpy(zero_copy_only=False)
    return np.ascontiguousarray(out.T), size


def turned(target: np.ndarray, source: np.ndarray) -> np.ndarray:
    """``angle_delta`` of arrays."""
    out = target - source + 180.0
    far = (out < 0) | (out >= 360)
    if far.any():
        out[far] = np.mod(out[far], 360.0)
    out -= 180.0
    out[out == -180.0] = 180.0
    return out


def scores(d: dict[str, np.ndarray], gates: MatchGates) -> np.ndarray:
    """``match_score`` of arrays."""

    def ratio(r: np.ndarray, low: float, high: float) -> np.ndarray:
        return np.abs(np.log(r)) / np.maximum(np.where(r >= 1.0, np.log(high), np.abs(np.log(low)) if low > 0 else 0.0), 1e-12)

    across, down = gates.centers()
    pose = np.abs(d["yaw"]) / gates.yaw + np.abs(d["pitch"]) / gates.pitch + np.abs(d["roll"]) / gates.roll
    position = np.abs(d["cx"]) / across + np.abs(d["cy"]) / down
    scale = ratio(d["w"], *gates.ratios()["w"]) + ratio(d["h"], *gates.ratios()["h"])
    return gates.pose_weight * pose + gates.position_weight * position + gates.scale_weight * scale


class Side:
    """One side of a tile as arrays, in order of the horizontal centre."""

    def __init__(self, table: pa.Table) -> None:
        table = table.sort_by([("cx", "ascending")])
        self.id = table.column("id").combine_chunks()
        self.place = np.empty(len(self.id), np.int64)
        self.place[pc.sort_indices(self.id).to_numpy()] = np.arange(len(self.id))
        self.at = {c: table.column(c).to_numpy() for c in GEOMETRY}
        self.known = table.column("known").to_numpy()
        vector, self.size = numbers(table.column("embedding"), 0.0)
        self.unit = np.ascontiguousarray((vector / np.where(self.size >= 0, table.column("norm").to_numpy(), 1.0)).T)
        self.point, self.mouth = numbers(table.column("point"), np.nan), numbers(table.column("mouth"), np.nan)


def square_gaps(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray], i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Sum of squared differences of rows i of a and j of b; NaN where one is null or longer."""
    (x, nx), (y, ny) = a, b
    out = np.zeros(len(i))
    for c in range(min(len(x), len(y))):
        gap = x[c][i] - y[c][j]
        out += np.where((nx[i] <= c) & (ny[j] <= c), 0.0, gap * gap)
    out[(nx[i] != ny[j]) | (nx[i] < 0)] = np.nan
    return out


def weighed(gates: MatchGates) -> Callable[[pa.Table, pa.Table], dict[str, np.ndarray]]:
    """What a tile says of its targets: per target in reach of any source a row with its counts and its best source, and a row without counts for the second best."""

    def block(t: Side, s: Side, at: slice) -> dict[str, np.ndarray]:
        low, high = np.searchsorted(s.at["cx"], [t.at["cx"][at.start] - 2 * gates.center, t.at["cx"][at.stop - 1] + 2 * gates.center])
        to = slice(low, high)
        rows = at.stop - at.start
        inside = np.ones((rows, high - low), bool)
        for c, gate in zip(GEOMETRY, (gates.yaw, gates.pitch, gates.roll, *gates.centers()), strict=False):
            x, y = t.at[c][at, None], s.at[c][None, to]
            inside &= np.abs(turned(x, y) if c in GEOMETRY[:3] else x - y) <= gate
        with np.errstate(divide="ignore", invalid="ignore"):
            for c, (least, most) in gates.ratios().items():
                ratio = t.at[c][at, None] / s.at[c][None, to]
                inside &= (ratio >= least) & (ratio <= most)
        i, j = np.nonzero(inside)
        if t.unit.shape[1] == s.unit.shape[1]:
            similarity = (t.unit[at] @ s.unit[to].T)[i, j]
        else:  # of different sizes throughout
            similarity = np.zeros(len(i))
        i, j = i + at.start, j + low
        count = lambda where: np.bincount(where - at.start, minlength=rows)
        comparable = (t.size[i] >= 0) & (t.size[i] == s.size[j])
        alike = comparable & ~(similarity < gates.similarity)
        mismatch = t.known[i] & s.known[j] & ~alike
        rejected = np.full(rows, np.nan)
        own = np.flatnonzero(comparable & ~alike)
        if len(own):
            starts = np.flatnonzero(np.diff(i[own], prepend=-1))
            rejected[i[own][starts] - at.start] = np.maximum.reduceat(similarity[own], starts)
        found = {"geometry_count": count(i), "identity_mismatch_count": count(i[mismatch]), "max_rejected_similarity": rejected}
        i, j, similarity = i[alike], j[alike], similarity[alike]
        with np.errstate(divide="ignore", invalid="ignore"):
            alignment = np.sqrt(square_gaps(t.point, s.point, i, j) / t.point[1][i])
        mouth = np.sqrt(square_gaps(t.mouth, s.mouth, i, j))
        stable, central = alignment <= gates.alignment, mouth <= gates.mouth
        good = stable & central
        found |= {"identity_count": count(i), "stable_failures": count(i[~stable]), "mouth_failures": count(i[~central]), "valid_candidate_count": count(i[good])}
        i, j = i[good], j[good]
        d = {c: turned(t.at[c][i], s.at[c][j]) for c in GEOMETRY[:3]} | {c: t.at[c][i] - s.at[c][j] for c in GEOMETRY[3:5]} | {c: t.at[c][i] / s.at[c][j] for c in GEOMETRY[5:]}
        score = scores(d, gates)
        order = np.lexsort((s.place[j], score, i))
        first = np.diff(i[order], prepend=-1) != 0
        second = ~first & np.append(False, first[:-1])
        won = {"score": score, "similarity": similarity[good], "alignment": alignment[good], "mouth_delta": mouth[good]} | {f"d_{c}": v for c, v in d.items()}
        # row of every target's best among the good ones, -1 where there is none
        best = np.full(rows, -1)
        best[i[order[first]] - at.start] = order[first]
        reached = np.flatnonzero(found["geometry_count"])
        best, next_best = best[reached], order[second]
        out = {"target": np.append(reached + at.start, i[next_best]), "source": np.append(np.where(best >= 0, j[best], -1) if len(j) else best, j[next_best])}
        out |= {c: np.append(v[reached], np.full(len(next_best), np.nan if c == "max_rejected_similarity" else 0)) for c, v in found.items()}
        return out | {c: np.append(v[best] if len(v) else np.full(len(best), np.nan), v[next_best]) for c, v in won.items()}

    def run(targets: pa.Table, sources: pa.Table) -> pa.Table:
        if not targets.num_rows or not sources.num_rows:
            targets, sources = targets.slice(0, 0), sources.slice(0, 0)
        t, s = Side(targets), Side(sources)
        n, made, start = len(t.id), [], 0
        while start < n:
            # fewer targets at a time where many sources are near
            stop = min(n, start + max(1, CELLS // len(s.id)))
            made.append(block(t, s, slice(start, stop)))
            start = stop
        names = ["target", "source", *COUNTED, "max_rejected_similarity", "score", *WON[1:]]
        whole = {c: np.concatenate([np.zeros(0), *(m[c] for m in made)]) for c in names}
        source = whole["source"].astype(np.int64)
        without = source < 0
        columns = [t.id.take(pa.array(whole["target"].astype(np.int64))), s.id.take(pa.array(np.maximum(source, 0), mask=without))]
        columns += [pa.array(whole[c].astype(np.int64)) for c in COUNTED] + [pa.array(whole["max_rejected_similarity"], mask=np.isnan(whole["max_rejected_similarity"]))]
        columns += [pa.array(whole[c], mask=without) for c in ("score", *WON[1:])]
        return pa.table(columns, names=["target_id", "source_id", *names[2:]])

    return run


def tiles(targets: DataFrame, sources: DataFrame, gates: MatchGates, dealt: int | None = None) -> DataFrame:
    """Counts, and best and second best source, of targets by tile: see ``weighed``. Both sides have whole geometry."""
    dealt = DEALT if dealt is None else dealt
    cell = ["persona", "__yaw", "__pitch"]
    (yaw, yaws), (pitch, pitches) = turned_bin("yaw", gates.yaw), turned_bin("pitch", gates.pitch)
    own = [*(F.col(c).cast("double").alias(c) for c in GEOMETRY), F.col("embedding").isNotNull().alias("known"), F.when(norm(F.col("embedding")) > 1e-12, norm(F.col("embedding"))).alias("norm")]
    vectors = [F.when(F.col("norm").isNotNull(), F.col("embedding")).alias("embedding"), "point", "mouth"]

    def side(df: DataFrame, at: tuple[Column, Column]) -> DataFrame:
        # every column under an alias: both sides may come from one table
        named = df.where("persona is not null").select(*(F.col(c).alias(c) for c in ("persona", "id", "embedding", "point", "mouth")), *own, at[0].alias("__yaw"), at[1].alias("__pitch"))
        return named.select(*cell, "id", *GEOMETRY, "known", "norm", *vectors)

    t = side(targets, (yaw, pitch))
    s = side(sources, (near(yaw, yaws), near(pitch, pitches))).withColumn("__yaw", F.explode("__yaw")).withColumn("__pitch", F.explode("__pitch"))
    sizes = t.groupBy(*cell).agg(F.count("*").alias("t")).join(s.groupBy(*cell).agg(F.count("*").alias("s")), cell)
    chunks = [F.ceil(F.col(c) / dealt).cast("int").alias(f"__{c}") for c in ("t", "s")]
    # at most a row for every ``dealt`` rows that are listed
    large = F.broadcast(sizes.where(F.greatest("t", "s") > dealt).select(*cell, *chunks))

    def met(df: DataFrame, mine: str, other: str, i: str, j: str) -> DataFrame:
        placed = df.join(large, cell, "left").withColumn(i, F.pmod(F.xxhash64("id"), F.coalesce(mine, F.lit(1))).cast("int"))
        return placed.withColumn(j, F.explode(F.sequence(F.lit(0), F.coalesce(other, F.lit(1)) - 1))).drop(mine, other)

    key = [*cell, "__i", "__j"]
    kind = targets.schema["id"].dataType.simpleString(), sources.schema["id"].dataType.simpleString()
    schema = f"target_id {kind[0]}, source_id {kind[1]}, " + ", ".join(f"{c} long" for c in COUNTED) + ", max_rejected_similarity double, score double, " + ", ".join(f"{c} double" for c in WON[1:])
    return met(t, "__t", "__s", "__i", "__j").groupBy(*key).cogroup(met(s, "__s", "__t", "__j", "__i").groupBy(*key)).applyInArrow(weighed(gates), schema)


def decisions(targets: DataFrame, sources: DataFrame, gates: MatchGates = MatchGates()) -> DataFrame:
    """One row per target: winner and its differences, runner-up, margin, counts by stage, and the reason of the unmatched.

    Both sides have what ``candidates`` says.
    """
    seen = F.col("yaw").isNotNull()
    for c in GEOMETRY[1:]:
        seen = seen & F.col(c).isNotNull()
    known = F.col("embedding").isNotNull()
    found = tiles(targets.where(seen), sources.where(seen), gates)
    # a target has a row or two per chunk of the sources in its cell
    best = InternalFunction.collect_top_k(F.when(F.col("score").isNotNull(), F.struct("score", *WON)), 2, True)
    counts = found.groupBy("target_id").agg(*(F.sum(c).alias(c) for c in COUNTED), F.max("max_rejected_similarity").alias("max_rejected_similarity"), best.alias("__best"))
    first, second = F.get("__best", F.lit(0)), F.get("__best", F.lit(1))
    counts = counts.select("*", first["score"].alias("score"), *(first[c].alias(c) for c in WON), second["score"].alias("second")).drop("__best")
    joined = targets.select("persona", F.col("id").alias("target_id"), seen.alias("__seen"), known.alias("__known")).join(counts, "target_id", "left")
    count = lambda c: F.coalesce(c, F.lit(0)).cast("long")
    none = count("valid_candidate_count") == 0
    reason = (
        F.when(~F.col("__seen"), "invalid_target_observation").when(count("geometry_count") == 0, "pose_geometry_no_match").when(~F.col("__known"), "identity_embedding_missing")
        .when(F.col("identity_count") == 0, "identity_mismatch").when(none, "post_crop_alignment_mismatch")
    )
    # failures explain a target without match; a match doesn't report those of its rivals
    failed = lambda c: F.when(none & (F.col("identity_count") > 0), count(c)).otherwise(F.lit(0).cast("long")).alias(c)
    return joined.select(
        "persona", "target_id", F.when(none, "rejected").otherwise("matched").alias("status"), reason.alias("reject_reason"),
        "source_id", F.round("score", 6).alias("matching_score"), F.round("similarity", 6).alias("identity_similarity"), F.round("alignment", 6).alias("stable_alignment"), F.round("mouth_delta", 6).alias("mouth_delta"),
        count("valid_candidate_count").alias("valid_candidate_count"), count("identity_mismatch_count").alias("identity_mismatch_count"), failed("stable_failures"), failed("mouth_failures"),
        F.round("max_rejected_similarity", 6).alias("max_rejected_similarity"), F.round("second", 6).alias("second_best_score"), F.round(F.col("second") - F.col("score"), 6).alias("score_margin"),
        *(F.round(f"d_{c}", 6).alias(name) for c, name in zip(GEOMETRY, DIFFERENCES, strict=True)),
    )


def first_reason(checks: list[tuple[str, Column]]) -> Column:
    """The name of the first check that fails, null if none does: a reject cascade in one CASE."""
    out = None
    for name, fails in checks:
        out = F.when(fails, name) if out is None else out.when(fails, name)
    return out


def fallback(keys: DataFrame, places: list[DataFrame], on: str, value: str) -> DataFrame:
    """The value of the first of several tables that has the key."""
    found = keys
    for i, place in enumerate(places):
        found = found.join(place.select(on, F.col(value).alias(f"__{i}")), on, "left")
    return found.withColumn(value, F.coalesce(*(f"__{i}" for i in range(len(places))))).drop(*(f"__{i}" for i in range(len(places))))
