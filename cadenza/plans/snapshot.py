"""The pose-paired snapshot build: observations to decisions, pairs, report and published snapshot.

Detectors, feature encoders and image codecs are plug points: functions over Arrow batches that
turn media rows into observations. Everything after them is DataFrame work.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.geometry import MatchGates
from ..functions.numeric import distribution
from ..functions.text import pair_id
from ..operators import pairing, sampling, sync
from ..sources import sinks

Analyser = Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]


def analysed(media: DataFrame, make: Callable[[], Callable[[pd.DataFrame], pd.DataFrame]], schema: str) -> DataFrame:
    """Observations by an injected model: ``make`` is called once per task and its result once per batch."""

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = make()
        for part in parts:
            yield model(part)

    return media.mapInPandas(run, schema)


@dataclass(frozen=True)
class BuildConfig:
    gates: MatchGates = field(default_factory=MatchGates)
    face_blur: float = 60.0
    source_blur: float = 60.0
    mouth_blur: float = 40.0
    idle_ratio: float = 0.10
    idle_weight: float = 0.25
    val_share: float = 0.2
    salt: str = "split"
    preview: int = 8


def early_reason(config: BuildConfig):
    """The reasons that need no candidate, first one wins; a reason that the analysis gave itself stands for the generic one."""
    own = F.nullif("observed_reason", F.lit(""))
    return (
        F.when(~F.col("landmark_valid"), F.coalesce(own, F.lit("landmark_missing"))).when(~F.col("bbox_continuity_valid"), F.coalesce(own, F.lit("bbox_discontinuity")))
        .when(F.col("face_blur") < config.face_blur, "target_face_blur").when(F.col("mouth_blur") < config.mouth_blur, "target_mouth_blur")
        .when(~F.col("audio_available"), "bnf_out_of_range").when(F.coalesce("sync_rejected", F.lit(False)), "sync_lag")
    )


def build(targets: DataFrame, sources: DataFrame, config: BuildConfig = BuildConfig()) -> tuple[DataFrame, DataFrame]:
    """(decisions, pairs). Both sides have the pairing columns, or the boxes and landmarks that ``pairing.observed`` makes them from;
    targets also clip_id, frame_idx, speech, confidence and the gated values.

    Rows that fail early never reach the join; exactly one decision is made per target frame. Clips are
    split within each persona, and a persona with fewer than two clips fails the build when a pair of it is read.
    """
    targets, sources = (side if "point" in side.columns else pairing.observed(side) for side in (targets, sources))
    judged = targets.withColumn("early", early_reason(config))
    usable = sources.where(F.col("landmark_valid") & F.col("bbox_continuity_valid") & F.col("embedding").isNotNull() & (F.col("face_blur") >= config.source_blur))
    matched = pairing.decisions(judged.where("early is null"), usable, config.gates).drop("persona")
    joined = judged.join(matched, F.col("id") == F.col("target_id"), "left").withColumn("reason", F.coalesce("early", "reject_reason"))
    splits = sampling.group_split(targets, "persona", "clip_id", config.salt, config.val_share)
    alone = F.raise_error(F.concat(F.lit("a split by clip needs at least two clips of persona "), F.col("persona").cast("string")))
    splits = splits.withColumn("split", F.coalesce("split", alone.cast("string")))
    kept = joined.where("reason is null").join(splits, ["persona", "clip_id"])
    keyed = kept.withColumn("__part", F.concat_ws("/", "persona", "clip_id", "split"))
    idle = sampling.idle_sample(keyed, "__part", "frame_idx", ~F.col("speech"), config.idle_ratio)
    pairs = keyed.where("speech").unionByName(idle).drop("__part")
    pairs = pairs.withColumns({
        "pair_id": pair_id(F.col("clip_id"), F.col("frame_idx"), F.col("source_id")), "sample_weight": F.when(F.col("speech"), 1.0).otherwise(config.idle_weight), "is_idle": ~F.col("speech"),
        "flags": sync.window_flags(F.col("speech"), F.col("confidence")),
    })
    stay = pairs.select(F.col("id").alias("stay_id"))
    decided = joined.join(stay, F.col("id") == F.col("stay_id"), "left")
    reason = F.coalesce("reason", F.when(F.col("stay_id").isNull(), "idle_downsampled"))
    decided = decided.withColumns({"reject_reason": reason, "status": F.when(reason.isNull(), "retained").otherwise("rejected")})
    return decided.drop("early", "reason", "target_id", "stay_id"), pairs.drop("early", "reason", "target_id", "status", "reject_reason", "observed_reason")


def row_fault(pairs: DataFrame, audio: str | None = None, shape: tuple[int, int] = (20, 256)) -> DataFrame:
    """(pair_id, fault) of rows that may not be published: numbers that are not finite, audio of another shape, no valid candidate."""
    numbers = [F.col(f.name) for f in pairs.schema.fields if f.dataType.typeName() in ("double", "float")]
    lists = [F.col(f.name) for f in pairs.schema.fields if f.dataType.simpleString() in ("array<double>", "array<float>") and f.name != audio]
    odd = lambda x: F.isnan(x) | (F.abs(x) == float("inf"))
    wild = F.lit(False)
    for c in numbers:
        wild = wild | F.coalesce(odd(c), F.lit(False))
    for c in lists:
        wild = wild | F.coalesce(F.exists(c, odd), F.lit(False))
    wrong = F.lit(False)
    if audio is not None:
        wrong = (F.size(audio) != shape[0]) | F.exists(audio, lambda row: F.size(row) != shape[1])
        wild = wild | F.coalesce(F.exists(audio, lambda row: F.exists(row, odd)), F.lit(False))
    fault = F.when(wild, "not_finite").when(F.coalesce(wrong, F.lit(True)), "audio_shape").when(F.coalesce(F.col("valid_candidate_count") <= 0, F.lit(True)), "no_valid_candidate")
    return pairs.select("pair_id", fault.alias("fault")).where("fault is not null")


#: Reasons counted one by one in the report.
REASONS = (
    "landmark_missing", "bbox_discontinuity", "target_face_blur", "target_mouth_blur", "bnf_out_of_range", "sync_lag", "invalid_target_observation", "identity_embedding_missing",
    "pose_geometry_no_match", "identity_mismatch", "post_crop_alignment_mismatch", "idle_downsampled",
)


def report(decisions: DataFrame) -> DataFrame:
    """Per clip: counts by reason, rates, distributions of the measures and, as far as ``decisions`` has their columns, of blur, lags and correlations, and window counts."""
    kept = F.col("status") == "retained"
    spread = lambda v: F.when(F.count(v) > 0, F.struct(*distribution(v)))
    seen = {"blur_target_face": "face_blur", "blur_target_mouth": "mouth_blur", "best_lag": "best_lag", "correlation": "correlation", "identity_max_rejected_similarity": "max_rejected_similarity"}
    spreads = {name: F.col(c) for name, c in seen.items() if c in decisions.columns} | {"identity_similarity": F.when(kept, F.col("identity_similarity")), "matching_score": F.when(kept, F.col("matching_score"))}
    spreads |= {"valid_candidate_count": F.when(kept, F.col("valid_candidate_count")), "matching_score_margin": F.when(kept, F.col("score_margin"))}
    # reasons that an analysis gave itself are counted too; a clip has a few
    by_reason = decisions.where("reject_reason is not null").groupBy("clip_id", "reject_reason").agg(F.count("*").alias("n"))
    named = by_reason.groupBy("clip_id").agg(F.map_from_entries(F.collect_list(F.struct("reject_reason", "n"))).alias("rejection_counts"))
    measures = ("matching_score", "identity_similarity", "stable_alignment", "mouth_delta", "score_margin")
    counted = decisions.groupBy("clip_id").agg(
        F.count("*").alias("frames"), F.count_if(kept).alias("retained"), (F.count_if(kept) / F.count("*")).alias("retained_share"),
        F.count_if(kept & F.col("speech")).alias("speech"), F.count_if(kept & ~F.col("speech")).alias("idle"), F.count_if(F.col("landmark_valid")).alias("landmarks"), F.count_if(F.col("bbox_continuity_valid")).alias("continuous"),
        *(F.count_if(F.col("reject_reason") == r).alias(r) for r in REASONS),
        F.count_if(kept & F.col("second_best_score").isNull()).alias("without_runner_up"), F.count_if(F.col("stable_failures") > 0).alias("stable_mismatch"), F.count_if(F.col("mouth_failures") > 0).alias("mouth_mismatch"),
        F.avg(F.when(kept, F.col("valid_candidate_count"))).alias("candidates_mean"), F.count_distinct(F.when(kept, F.col("source_id"))).alias("sources_used"),
        *(x for c in measures for x in (F.avg(F.when(kept, F.col(c))).alias(f"{c}_mean"), F.percentile(F.when(kept, F.col(c)), F.lit(0.5)).alias(f"{c}_p50"), F.percentile(F.when(kept, F.col(c)), F.lit(0.95)).alias(f"{c}_p95"))),
        F.when(F.count_if(kept) > 0, "ready").otherwise("no_valid_samples").alias("clip_status"), F.count_if(F.col("speech")).alias("speech_windows"), F.count_if(~F.col("speech")).alias("idle_windows"),
        F.count_if(F.col("confidence") == "low").alias("low_confidence_frames"),
        *(spread(v.cast("double")).alias(f"{name}_distribution") for name, v in spreads.items()),
    )
    return counted.join(named, "clip_id", "left").withColumn("rejection_counts", F.coalesce("rejection_counts", F.create_map().cast("map<string,bigint>")))


def previews(pairs: DataFrame, count: int = 8) -> DataFrame:
    """(group, rank, key, and the pair's columns): the first ``count`` pairs of nine groups; ties by target frame, then pair_id.

    A pair is listed once for each group it may be in, and ranked within them: one scan, and no more than ``count`` rows of a group leave a task.
    """
    # fixed values: the names of the groups
    most = lambda *cs: F.greatest(*(F.abs(c) for c in cs))
    c = F.col
    keys = [
        ("best_score", c("matching_score"), F.lit(True)), ("smallest_margin", c("score_margin"), c("score_margin").isNotNull()),
        ("near_pose_threshold", -most(c("pose_delta_yaw"), c("pose_delta_pitch"), c("pose_delta_roll")), F.lit(True)), ("near_center_threshold", -most(c("center_delta_x"), c("center_delta_y")), F.lit(True)),
        ("near_scale_threshold", -most(F.ln("width_ratio"), F.ln("height_ratio")), F.lit(True)), ("near_post_crop_threshold", -F.greatest("stable_alignment", "mouth_delta"), F.lit(True)),
        ("near_identity_threshold", c("identity_similarity"), F.lit(True)), ("low_sync_confidence", c("matching_score"), c("confidence") == "low"), ("idle_retained", c("frame_idx"), c("is_idle")),
    ]
    listed = F.array_compact(F.array(*(F.when(may, F.struct(F.lit(name).alias("group"), key.cast("double").alias("key"))) for name, key, may in keys)))
    each = pairs.select("*", F.inline(listed))
    return sampling.top_by(each, ["group"], [F.col("key"), F.col("frame_idx"), F.col("pair_id")], count)


def publish(pairs: DataFrame, decisions: DataFrame, live: str, audio: str | None = None, shape: tuple[int, int] = (20, 256), splits: tuple[str, ...] = ("train", "val")) -> None:
    """Pairs as a snapshot by split, decisions beside it; nothing is published if a row is at fault or a split has no rows.

    ``audio`` names the column of feature windows, array<array<..>>, every one of which must have ``shape`` and finite values.
    """
    worst = row_fault(pairs, audio, shape).groupBy("fault").agg(F.count("*").alias("rows"), F.min("pair_id").alias("first")).collect()  # a row per kind of fault
    if worst:
        raise ValueError("; ".join(f"{r['rows']} rows {r['fault']}, first {r['first']}" for r in worst))
    empty = set(splits) - {r["split"] for r in pairs.groupBy("split").count().collect()}  # a row per split
    if empty:
        raise ValueError(f"no rows for splits {sorted(empty)}")
    sinks.write_snapshot(pairs, live)
    sinks.write_decisions(decisions, f"{live}-decisions")
