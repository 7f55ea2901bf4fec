"""String expressions for names, paths and rates."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def safe_component(name: Column, default: str = "sample") -> Column:
    """A name fit for a path: other characters become _, outer . and _ go; ``default`` if nothing is left or the name is null."""
    cleaned = F.btrim(F.regexp_replace(name, "[^A-Za-z0-9._-]++", "_"), F.lit("._"))
    return F.coalesce(F.nullif(cleaned, F.lit("")), F.lit(default))


def folder_prefix(path: Column) -> Column:
    """A path without outer slashes, and one slash after it unless it is empty."""
    bare = F.regexp_replace(path, "^/+|/+$", "")
    return F.when(bare == "", bare).otherwise(F.concat(bare, F.lit("/")))


def rate(text: Column) -> Column:
    """'25/1' or '25' as a number; null if the denominator is 0."""
    parts = F.split(text, "/")
    low = F.coalesce(F.get(parts, F.lit(1)), F.lit("1")).cast("double")
    return F.when(low != 0, F.get(parts, F.lit(0)).cast("double") / low)


def speaker(source: Column, other: Column) -> Column:
    """The source's name if it is not empty and the other is empty or the same; else ''."""
    own, second = F.trim(F.coalesce(source, F.lit(""))), F.trim(F.coalesce(other, F.lit("")))
    return F.when((own != "") & ((second == "") | (second == own)), own).otherwise("")


def general(x: Column, digits: int) -> Column:
    """A number with at most ``digits`` significant digits: plain from 1e-4 up to its digits, else with an exponent; no zeros at the end.

    Ties are rounded up on the shortest decimal form; null, NaN and infinities are null, 'nan' and 'inf'.
    """
    sized = F.split(F.format_string(f"%.{digits - 1}e", F.abs(x.cast("double"))), "e")
    figures, power = F.replace(F.get(sized, F.lit(0)), F.lit(".")), F.get(sized, F.lit(1)).cast("int")
    bare = lambda s: F.regexp_replace(s, r"\.?0*$", "")
    split_at = lambda n: bare(F.concat(F.substr(figures, F.lit(1), n), F.lit("."), F.substr(figures, n + 1)))
    small = bare(F.concat(F.lit("0."), F.repeat(F.lit("0"), -power - 1), figures))
    plain = F.when(power >= 0, split_at(power + 1)).otherwise(small)
    far = F.concat(split_at(F.lit(1)), F.lit("e"), F.when(power < 0, "-").otherwise("+"), F.lpad(F.abs(power).cast("string"), 2, "0"))
    # a power of three digits keeps them
    far = F.when(F.abs(power) < 100, far).otherwise(F.concat(split_at(F.lit(1)), F.lit("e"), F.when(power < 0, "-").otherwise("+"), F.abs(power).cast("string")))
    number = F.when(x == 0, F.lit("0")).when(F.isnan(x), F.lit("nan")).when(F.abs(x) == float("inf"), F.lit("inf")).otherwise(F.when((power >= -4) & (power < digits), plain).otherwise(far))
    return F.when(x.isNotNull(), F.concat(F.when((x < 0), "-").otherwise(""), number))


#: Measures of a validation that a line of a training log names, in this order.
VALIDATED = ("val_loss", "val_reconstruction_loss", "val_mouth_loss", "val_mouth_mae", "val_lpips_mouth", "val_mouth_temporal_error", "val_audio_shift_mouth_mae_delta")


def training_line(last: int, columns: list[str]) -> Column:
    """A step's line of the log: step, epoch, phase, learning_rate, train_loss, and those of VALIDATED that ``columns`` has and the row knows."""
    parts = [F.lit("[train]"), F.format_string(f"step=%d/{last}", "step"), F.format_string("epoch=%d", "epoch"), F.concat(F.lit("phase="), F.col("phase"))]
    parts += [F.concat(F.lit("lr="), general(F.col("learning_rate"), 3)), F.concat(F.lit("train_loss="), general(F.col("train_loss"), 6))]
    return F.concat_ws(" ", *parts, *(F.concat(F.lit(f"{c}="), general(F.col(c), 6)) for c in VALIDATED if c in columns))


def logged(last: int, interval: int, columns: list[str]) -> Column:
    """Whether a step has a line: the first, the last, every ``interval``-th and validated ones; none if the interval isn't positive."""
    if interval <= 0:
        return F.lit(False)
    chosen = F.col("step").isin(1, last) | (F.col("step") % interval == 0)
    for c in VALIDATED[:2]:
        chosen = chosen | F.col(c).isNotNull() if c in columns else chosen
    return chosen


def pair_id(clip: Column, target: Column, source: Column) -> Column:
    return F.format_string("%s__target_%06d__silent_%06d", clip.cast("string"), target, source)
