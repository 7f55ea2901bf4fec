"""A snapshot build's settings from a YAML mapping."""

from __future__ import annotations

from dataclasses import dataclass, field, replace
from typing import Any

from ..functions.geometry import MatchGates
from ..plans.snapshot import BuildConfig

#: A setting's name in the file, and the field it sets.
MATCHING = {
    "max_yaw_delta": "yaw", "max_pitch_delta": "pitch", "max_roll_delta": "roll", "max_center_x_delta": "center", "max_center_y_delta": "center_y",
    "min_width_ratio": "low_ratio", "max_width_ratio": "high_ratio", "min_height_ratio": "low_height", "max_height_ratio": "high_height",
    "pose_weight": "pose_weight", "position_weight": "position_weight", "scale_weight": "scale_weight",
    "max_stable_landmark_rmse": "alignment", "max_mouth_center_delta": "mouth",
}
POST_CROP = {"max_stable_landmark_rmse": "alignment", "max_mouth_center_delta": "mouth"}
BLUR = {"min_source_face_laplacian_variance": "source_blur", "min_target_face_laplacian_variance": "face_blur", "min_target_mouth_laplacian_variance": "mouth_blur"}
BUILD = {"idle_max_ratio": "idle_ratio", "idle_sample_weight": "idle_weight", "validation_fraction": "val_share", "split_salt": "salt", "preview_count_per_group": "preview"}
NEEDED = ("data_root", "persona_id", "snapshot_root", "work_root", "wenet_onnx")
DEFAULTS = {"landmark_model_asset_path": None, "fps": 25, "sample_rate": 16000, "progress": True, "strict": False}
SYNC = {"window_seconds": 2.0, "stride_seconds": 1.0, "max_lag_frames": 3, "max_reject_lag_frames": 2, "min_correlation": 0.2, "silence_rms_threshold": 0.001, "speech_fraction_threshold": 0.25}
IDENTITY = ("arcface_onnx", "hf_repo", "hf_filename", "hf_revision", "cache_dir", "expected_sha256", "min_cosine_similarity")
RUNTIME = {"device": "auto", "clip_workers": 4, "cuda_max_inflight": 2, "warn_on_cpu_fallback": True}


@dataclass(frozen=True)
class Settings:
    """What a file says: the build's own settings, those of its windows, and those that a plugged-in model or a launcher reads."""

    build: BuildConfig
    sync: dict[str, Any]
    job: dict[str, Any]
    runtime: dict[str, Any]
    identity: dict[str, Any] = field(default_factory=dict)


def named(section: str, given: Any, names: dict[str, str]) -> dict[str, Any]:
    """The fields that a section sets; a setting that nobody knows is an error."""
    if not isinstance(given or {}, dict):
        raise ValueError(f"{section} must be a mapping")
    odd = sorted(set(given or {}) - set(names))
    if odd:
        raise ValueError(f"unknown settings of {section}: {', '.join(odd)}")
    return {names[k]: v for k, v in (given or {}).items()}


def settings(payload: Any) -> Settings:
    """Settings from a mapping; post_crop_alignment goes before what matching says of the same gates. Defaults stand for what is absent."""
    if not isinstance(payload, dict):
        raise ValueError("a configuration must be a mapping")
    missing = [k for k in NEEDED if k not in payload]
    if missing:
        raise ValueError(f"settings that are needed: {', '.join(missing)}")
    left = dict(payload)
    gates = replace(MatchGates(), **named("matching", left.pop("matching", None), MATCHING))
    gates = replace(gates, **{k: float(v) for k, v in named("post_crop_alignment", left.pop("post_crop_alignment", None), POST_CROP).items()})
    same = lambda d: {k: k for k in d}
    identity = named("identity", left.pop("identity", None), same(IDENTITY))
    if "min_cosine_similarity" in identity:
        gates = replace(gates, similarity=float(identity["min_cosine_similarity"]))
    blur = named("blur", left.pop("blur", None), BLUR)
    sync = SYNC | named("sync", left.pop("sync", None), same(SYNC))
    runtime = RUNTIME | named("runtime", left.pop("runtime", None), same(RUNTIME))
    build = {BUILD[k]: left.pop(k) for k in BUILD if k in left}
    job = DEFAULTS | named("the configuration", left, same((*NEEDED, *DEFAULTS)))
    return Settings(replace(BuildConfig(), gates=gates, **blur, **build), sync, job, runtime, identity)


def read_settings(path: str) -> Settings:
    """Settings of a YAML file of the driver."""
    try:
        import yaml
    except ImportError as error:
        raise RuntimeError("reading YAML needs the yaml package; settings() takes a mapping") from error
    with open(path, encoding="utf-8") as file:
        return settings(yaml.safe_load(file))
