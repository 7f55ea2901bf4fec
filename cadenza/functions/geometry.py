"""Boxes, landmarks and poses as column expressions. A box is (x1, y1, x2, y2)."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

Box = tuple[Column, Column, Column, Column]


def box(x1: str = "x1", y1: str = "y1", x2: str = "x2", y2: str = "y2") -> Box:
    return F.col(x1), F.col(y1), F.col(x2), F.col(y2)


def quality_reason(b: Box, width: Column, height: Column, least: int = 32, most: float = 0.9) -> Column:
    """First failing gate, or null."""
    x1, y1, x2, y2 = b
    w, h = x2 - x1, y2 - y1
    return (
        F.when((w <= 0) | (h <= 0), "invalid").when((x1 < 0) | (y1 < 0) | (x2 > width) | (y2 > height), "outside_frame")
        .when((w < least) | (h < least), "too_small").when((w > width * most) | (h > height * most), "too_large")
    )


def normalized(b: Box, width: Column, height: Column) -> dict[str, Column]:
    """Centre and size as fractions of the frame."""
    x1, y1, x2, y2 = b
    return {"cx": (x1 + x2) / (2.0 * width), "cy": (y1 + y2) / (2.0 * height), "w": (x2 - x1) / width, "h": (y2 - y1) / height}


def iou(a: Box, b: Box) -> Column:
    wide = F.greatest(F.lit(0), F.least(a[2], b[2]) - F.greatest(a[0], b[0]))
    high = F.greatest(F.lit(0), F.least(a[3], b[3]) - F.greatest(a[1], b[1]))
    both = wide * high
    either = (a[2] - a[0]) * (a[3] - a[1]) + (b[2] - b[0]) * (b[3] - b[1]) - both
    return F.when(either > 0, both / either).otherwise(0.0)


def center_drift(a: Box, b: Box) -> Column:
    return F.hypot((a[0] + a[2]) / 2 - (b[0] + b[2]) / 2, (a[1] + a[3]) / 2 - (b[1] + b[3]) / 2)


def euler(r: dict[tuple[int, int], Column]) -> dict[str, Column]:
    """Yaw, pitch and roll in degrees from the entries of a rotation matrix."""
    across = F.hypot(r[0, 0], r[1, 0])
    flat = across < 1e-6
    pitch = F.when(flat, F.atan2(-r[1, 2], r[1, 1])).otherwise(F.atan2(r[2, 1], r[2, 2]))
    roll = F.when(flat, F.lit(0.0)).otherwise(F.atan2(r[1, 0], r[0, 0]))
    return {"yaw": F.degrees(F.atan2(-r[2, 0], across)), "pitch": F.degrees(pitch), "roll": F.degrees(roll)}


def distance(ax: Column, ay: Column, bx: Column, by: Column) -> Column:
    return F.hypot(ax - bx, ay - by)


def openness(upper: tuple[Column, Column], lower: tuple[Column, Column], left: tuple[Column, Column], right: tuple[Column, Column]) -> Column:
    """Mouth height over mouth width."""
    return distance(*upper, *lower) / F.greatest(distance(*left, *right), F.lit(1e-6))


def padded_box(xs: list[Column], ys: list[Column], width: Column, height: Column, pad: float = 0.35) -> list[Column]:
    """The box around some points, padded by a share of its longer side, within the frame."""
    x1, x2, y1, y2 = F.least(*xs), F.greatest(*xs), F.least(*ys), F.greatest(*ys)
    by = F.greatest(x2 - x1, y2 - y1, F.lit(1.0)) * pad
    zero = F.lit(0)
    return [F.greatest(zero, F.floor(x1 - by)), F.greatest(zero, F.floor(y1 - by)), F.least(width, F.ceil(x2 + by)), F.least(height, F.ceil(y2 + by))]


def mouth_part(b: Box) -> list[Column]:
    """The mouth's part of a face box: the middle 60% of its width, from 45% to 95% of its height."""
    x1, y1, x2, y2 = b
    w, h = x2 - x1, y2 - y1
    return [F.rint(v).cast("long") for v in (x1 + w * 0.2, y1 + h * 0.45, x1 + w * 0.8, y1 + h * 0.95)]


def widened_box(b: Box, width: Column, height: Column) -> list[Column]:
    """A detector's box grown by a tenth: to the left by its width, to the right by its new width, downwards by its height."""
    x1, y1, x2, y2 = b
    left, up = F.greatest(F.lit(0.0), x1 - (x2 - x1) * 0.1).cast("long"), F.greatest(F.lit(0), y1)
    right = F.least(width - 1.0, x2 + (x2 - left) * 0.1).cast("long")
    down = F.least(height - 1.0, y2 + (y2 - up) * 0.1).cast("long")
    return [left, up.cast("long"), right, down]


def scaled_box(b: Box, width: Column, height: Column, dx: int = 0, dy: int = 0, scale: float = 1.0, least: int = 32) -> list[Column]:
    """A box scaled about its centre, shifted and kept inside with at least a pixel; halves round to even."""
    x1, y1, x2, y2 = b
    w = F.greatest(F.lit(least), F.rint((x2 - x1) * scale))
    h = F.greatest(F.lit(least), F.rint((y2 - y1) * scale))
    nx, ny = F.rint((x1 + x2) / 2 - w / 2) + dx, F.rint((y1 + y2) / 2 - h / 2) + dy
    left, up = F.greatest(F.lit(0), F.least(nx, width - 2)), F.greatest(F.lit(0), F.least(ny, height - 2))
    right, down = F.greatest(left + 1, F.least(nx + w, width)), F.greatest(up + 1, F.least(ny + h, height))
    return [v.cast("long") for v in (left, up, right, down)]


def square_box(cx: Column, top: Column, side: Column, width: Column, height: Column) -> list[Column]:
    """A square of a given side hung from its top middle and pushed into the frame."""
    s = F.least(F.greatest(F.lit(1), F.rint(side)), width, height)
    x = F.greatest(F.lit(0), F.least(F.rint(cx - s / 2), width - s))
    y = F.greatest(F.lit(0), F.least(F.rint(top), height - s))
    return [v.cast("long") for v in (x, y, x + s, y + s)]


@dataclass(frozen=True)
class MatchGates:
    """Largest accepted differences between a target and a source, and score weights.

    The vertical centre and the height have the gates of the horizontal centre and the width unless they are given their own.
    """

    yaw: float = 5.0
    pitch: float = 5.0
    roll: float = 4.0
    center: float = 0.05
    low_ratio: float = 0.9
    high_ratio: float = 1.1
    similarity: float = 0.35
    alignment: float = 0.04
    mouth: float = 0.04
    pose_weight: float = 1.0
    position_weight: float = 1.0
    scale_weight: float = 1.0
    center_y: float | None = None
    low_height: float | None = None
    high_height: float | None = None

    def __post_init__(self) -> None:
        if min(self.yaw, self.pitch, self.roll, *self.centers()) <= 0:
            raise ValueError("gates of angles and centres have to be above 0: scores are differences in units of their gates")

    def centers(self) -> tuple[float, float]:
        return self.center, self.center if self.center_y is None else self.center_y

    def ratios(self) -> dict[str, tuple[float, float]]:
        low = self.low_ratio if self.low_height is None else self.low_height
        high = self.high_ratio if self.high_height is None else self.high_height
        return {"w": (self.low_ratio, self.high_ratio), "h": (low, high)}


def ratio_distance(ratio: Column, low: float, high: float) -> Column:
    """Log distance from 1, in units of the gate on the ratio's own side."""
    unit = F.when(ratio >= 1.0, F.ln(F.lit(high))).otherwise(F.abs(F.ln(F.lit(low))))
    return F.abs(F.ln(ratio)) / F.greatest(unit, F.lit(1e-12))


def match_score(d: dict[str, Column], g: MatchGates) -> Column:
    pose = F.abs(d["yaw"]) / g.yaw + F.abs(d["pitch"]) / g.pitch + F.abs(d["roll"]) / g.roll
    across, down = g.centers()
    position = F.abs(d["cx"]) / across + F.abs(d["cy"]) / down
    scale = ratio_distance(d["w"], *g.ratios()["w"]) + ratio_distance(d["h"], *g.ratios()["h"])
    return g.pose_weight * pose + g.position_weight * position + g.scale_weight * scale
