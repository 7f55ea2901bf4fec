"""Landmarks as column expressions: map<int, struct<x, y>> by index, or array<struct<x, y>> in order."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .geometry import Box, distance, square_box

#: Landmark numbers of the face mesh.
MOUTH_CORNERS, MOUTH_MIDDLE, EYES, NOSE, CHIN, CHEEKS = (61, 291), (13, 14), ((33, 133), (362, 263)), 1, 152, (234, 454)
STABLE = (1, 33, 152, 234, 263, 454)
OUTER_EYES = (33, 263)
#: Place and size of the face square: share of the way from eyes to chin, cheek widths, pixels to the right.
SQUARE_TOP, SQUARE_WIDTH, SQUARE_RIGHT = 0.096, 1.056, -1.0
#: Which of 98 contour points make the 68: the same point twice, or the middle of two.
CONTOUR_68 = (
    [(i, i) for i in (*range(0, 34, 2), *range(33, 38), *range(42, 47), *range(51, 61))]
    + [(60, 62), (62, 64), (64, 64), (64, 66), (60, 66), (68, 68), (68, 70), (70, 72), (72, 72), (72, 74), (68, 74)]
    + [(i, i) for i in range(76, 96)]
)


def point(marks: Column, index: int) -> Column:
    return F.try_element_at(marks, F.lit(index))


def middle(a: Column, b: Column) -> Column:
    return F.struct(((a["x"] + b["x"]) / 2).alias("x"), ((a["y"] + b["y"]) / 2).alias("y"))


def five_points(marks: Column) -> Column:
    """Eyes by x, nose, mouth corners by x; null if a landmark is missing."""
    eyes = F.array_sort(F.array(*(middle(point(marks, a), point(marks, b)) for a, b in EYES)))
    mouth = F.array_sort(F.array(*(point(marks, i) for i in MOUTH_CORNERS)))
    needed = [*MOUTH_CORNERS, NOSE, *(i for e in EYES for i in e)]
    whole = F.lit(True)
    for i in needed:
        whole = whole & point(marks, i).isNotNull()
    return F.when(whole, F.concat(eyes, F.array(point(marks, NOSE)), mouth))


def in_box(p: Column, b: Box) -> tuple[Column, Column]:
    """A point as shares of a box's sides."""
    x1, y1, x2, y2 = b
    return (p["x"] - x1) / (x2 - x1), (p["y"] - y1) / (y2 - y1)


def aligned(marks: Column, b: Box) -> tuple[Column, Column]:
    """(coordinates of the stable landmarks in turn, centre of the mouth), both as arrays of shares of a box's sides; null if a landmark is missing."""
    stable = [v for i in STABLE for v in in_box(point(marks, i), b)]
    mouth = in_box(middle(*(point(marks, i) for i in MOUTH_CORNERS)), b)
    whole = lambda values: F.when(~F.exists(F.array(*values), F.isnull), F.array(*(v.cast("double") for v in values)))
    return whole(stable), whole(mouth)


def alignment(source: Column, source_box: Box, target: Column, target_box: Box) -> tuple[Column, Column]:
    """(root mean square gap of the stable landmarks inside their boxes, distance of the mouth centres)."""
    gaps = []
    for i in STABLE:
        (ax, ay), (bx, by) = in_box(point(source, i), source_box), in_box(point(target, i), target_box)
        gaps += [(ax - bx) * (ax - bx), (ay - by) * (ay - by)]
    total = gaps[0]
    for g in gaps[1:]:
        total = total + g
    a = in_box(middle(*(point(source, i) for i in MOUTH_CORNERS)), source_box)
    b = in_box(middle(*(point(target, i) for i in MOUTH_CORNERS)), target_box)
    return F.sqrt(total / len(gaps)), F.hypot(a[0] - b[0], a[1] - b[1])


def face_square(marks: Column, width: Column, height: Column, least: float = 32.0) -> list[Column]:
    """[x1, y1, x2, y2] of the square a little wider than the cheeks, hung just below the eyes, within the frame; nulls if a landmark is missing."""
    left, right = (point(marks, i) for i in CHEEKS)
    eyes, chin = middle(*(point(marks, i) for i in OUTER_EYES)), point(marks, CHIN)
    side = F.greatest(F.lit(least), distance(left["x"], left["y"], right["x"], right["y"]) * SQUARE_WIDTH)
    box = square_box(middle(left, right)["x"] + SQUARE_RIGHT, eyes["y"] + (chin["y"] - eyes["y"]) * SQUARE_TOP, side, width, height)
    whole = F.lit(True)
    for i in (*CHEEKS, *OUTER_EYES, CHIN):
        whole = whole & point(marks, i).isNotNull()
    return [F.when(whole, v) for v in box]


def contour_68(points: Column) -> Column:
    """68 contour points from 98."""
    pairs = F.array(*(F.struct(F.lit(a).alias("a"), F.lit(b).alias("b")) for a, b in CONTOUR_68))
    return F.when(F.size(points) == 98, F.transform(pairs, lambda p: middle(F.get(points, p["a"]), F.get(points, p["b"]))))


def contour_roi(points: Column, width: Column, height: Column) -> Column:
    """array<long> box from 68 contour points truncated to pixels: hung from the brows, as wide as the face's proportions ask; null if empty."""
    whole = F.transform(points, lambda p: F.struct(p["x"].cast("long").alias("x"), p["y"].cast("long").alias("y")))
    inner = F.concat(F.slice(whole, 2, 15), F.slice(whole, 31, 37))
    reach = lambda ps, c: (F.array_min(F.transform(ps, lambda p: p[c])), F.array_max(F.transform(ps, lambda p: p[c])))
    (left, right), (top, bottom) = reach(whole, "x"), reach(whole, "y")
    (il, ir), (it, _) = reach(inner, "x"), reach(inner, "y")
    ratio = F.least(F.lit(1.0), (right - left) / (bottom - top))
    side = (ir - il) / ratio
    center = il + F.floor((ir - il) / 2)
    box = [F.greatest(F.lit(0.0), center - side * 0.5), F.greatest(F.lit(0.0), it + side * 0.11), F.least(width - 1.0, center + side * 0.5), F.least(height - 1.0, it + side * 1.11)]
    x1, y1, x2, y2 = (v.cast("long") for v in box)
    return F.when((bottom > top) & (right > left) & (ir > il) & (x2 > x1) & (y2 > y1), F.array(x1, y1, x2, y2))
