"""Dense-array kernels (images, losses) in NumPy, and Arrow UDFs over flat array<float> columns."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F


def laplacian_variance(gray: np.ndarray) -> float:
    """Variance of the 4-neighbour Laplacian with mirrored borders: low for blurred images."""
    p = np.pad(gray.astype(np.float64), 1, mode="reflect")
    return float((p[:-2, 1:-1] + p[2:, 1:-1] + p[1:-1, :-2] + p[1:-1, 2:] - 4 * p[1:-1, 1:-1]).var())


def _filtered(x: np.ndarray, kernel: np.ndarray, mode: str) -> np.ndarray:
    """Separable filter over the last two axes, same size; mode of padding as in np.pad."""
    r = len(kernel) // 2
    for axis in (-2, -1):
        pad = [(0, 0)] * x.ndim
        pad[axis] = (r, r)
        windows = np.lib.stride_tricks.sliding_window_view(np.pad(x, pad, mode=mode), len(kernel), axis=axis)
        x = windows @ kernel
    return x


def _ssim(a: np.ndarray, b: np.ndarray, kernel: np.ndarray, span: float, mode: str) -> float:
    a, b = a.astype(np.float64), b.astype(np.float64)
    c1, c2 = (0.01 * span) ** 2, (0.03 * span) ** 2
    f = lambda x: _filtered(x, kernel, mode)
    ma, mb = f(a), f(b)
    va, vb, cov = f(a * a) - ma * ma, f(b * b) - mb * mb, f(a * b) - ma * mb
    return float((((2 * ma * mb + c1) * (2 * cov + c2)) / ((ma * ma + mb * mb + c1) * (va + vb + c2))).mean())


def ssim_gaussian(a: np.ndarray, b: np.ndarray, size: int = 11, sigma: float = 1.5, span: float = 255.0) -> float:
    """Structural similarity under a Gaussian window, mirrored borders."""
    x = np.arange(size) - size // 2
    k = np.exp(-(x**2) / (2 * sigma**2))
    return _ssim(a, b, k / k.sum(), span, "reflect")


def ssim_box(a: np.ndarray, b: np.ndarray, size: int = 11, span: float = 2.0) -> float:
    """Structural similarity under a flat window, zero borders that count."""
    return _ssim(a, b, np.full(size, 1 / size), span, "constant")


def image_metrics(a: np.ndarray, b: np.ndarray, peak: float = 255.0) -> dict[str, float]:
    gap = a.astype(np.float64) - b.astype(np.float64)
    rmse = float(np.sqrt((gap**2).mean()))
    return {"mae": float(np.abs(gap).mean()), "rmse": rmse, "max_abs": float(np.abs(gap).max()), "psnr": float("inf") if rmse == 0 else 20 * np.log10(peak / rmse), "ssim": ssim_gaussian(a, b, span=peak)}


def crop(image: np.ndarray, box: tuple[int, int, int, int]) -> np.ndarray:
    """Part of an image [..., h, w] inside (x1, y1, x2, y2)."""
    x1, y1, x2, y2 = box
    return image[..., y1:y2, x1:x2]


#: The mouth (x, y, width, height) in a 160 x 160 face, the masked part of it, and its inset in a 168 x 168 source.
MOUTH, MASK, INSET = (32, 72, 96, 72), (5, 5, 150, 145), 4


def corners(region: tuple[int, int, int, int]) -> tuple[int, int, int, int]:
    x, y, w, h = region
    return x, y, x + w, y + h


def face_part(source: np.ndarray) -> np.ndarray:
    """The inner part of a source region, without its inset."""
    return source[..., INSET:-INSET, INSET:-INSET]


def signed_psnr(a: np.ndarray, b: np.ndarray, span: float = 2.0) -> np.ndarray:
    """Per sample, for images in [-1, 1]; the squared error is at least 1e-12."""
    mse = ((a.astype(np.float64) - b) ** 2).reshape(len(a), -1).mean(axis=1)
    return 10 * np.log10(span**2 / np.maximum(mse, 1e-12))


def masked(image: np.ndarray, box: tuple[int, int, int, int], value: float = 0.0) -> np.ndarray:
    out = image.copy()
    crop(out, box)[...] = value
    return out


def to_signed(image: np.ndarray) -> np.ndarray:
    """Bytes as floats in [-1, 1]."""
    return ((image.astype(np.float32) - 127.5) / 127.5).astype(np.float32)


def to_bytes(image: np.ndarray) -> np.ndarray:
    return np.clip(np.rint(image.astype(np.float64) * 127.5 + 127.5), 0, 255).astype(np.uint8)


def blended(under: np.ndarray, over: np.ndarray, alpha: np.ndarray) -> np.ndarray:
    return np.clip(np.rint(over * alpha + under * (1 - alpha)), 0, 255).astype(np.uint8)


def as_picture(planes: np.ndarray) -> np.ndarray:
    """Three planes in [-1, 1] as a picture of bytes, cut off below the next whole number."""
    if planes.shape[0] != 3:
        raise ValueError(f"three planes expected, got shape {planes.shape}")
    return np.clip((np.moveaxis(planes, 0, -1) + 1.0) * 127.5, 0, 255).astype(np.uint8)


def side_by_side(given: np.ndarray, made: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Input, result and target as pictures in a row, then the difference of the last two."""
    pictures = [as_picture(p) for p in (given, made, wanted)]
    gap = np.abs(pictures[1].astype(int) - pictures[2]).astype(np.uint8)
    return np.hstack([*pictures, gap])


def pasted(frame: np.ndarray, box: tuple[int, int, int, int], roi: np.ndarray, made: np.ndarray, edge: int = 4, keep: np.ndarray | None = None, resize=None) -> np.ndarray:
    """A frame whose box shows ``roi`` with ``made`` inside its edge; ``keep`` (bytes) says how much of the roi shines through.

    ``resize(image, width, height)`` brings the roi to the box's size and is needed where they differ.
    """
    face, (h, w) = roi.copy(), made.shape[:2]
    if face.shape[:2] != (h + 2 * edge, w + 2 * edge):
        raise ValueError(f"a roi of {face.shape[:2]} does not fit a result of {(h, w)} with an edge of {edge}")
    inner = face[edge : edge + h, edge : edge + w]
    share = 0.0 if keep is None else (keep.astype(np.float32) / 255.0)[..., None]
    inner[...] = np.clip(inner.astype(np.float32) * share + made.astype(np.float32) * (1.0 - share), 0, 255).astype(np.uint8)
    x1, y1, x2, y2 = box
    if face.shape[:2] != (y2 - y1, x2 - x1):
        if resize is None:
            raise ValueError("a box of another size than the roi needs a resize")
        face = resize(face, x2 - x1, y2 - y1)
    out = frame.copy()
    out[y1:y2, x1:x2] = face
    return out


def charbonnier(a: np.ndarray, b: np.ndarray, eps: float = 1e-3) -> np.ndarray:
    """Per sample: mean of a smooth absolute difference."""
    return np.sqrt((a - b) ** 2 + eps**2).reshape(len(a), -1).mean(axis=1)


def region_weighted(a: np.ndarray, b: np.ndarray, box: tuple[int, int, int, int] = (5, 5, 155, 150), weight: float = 4.0) -> np.ndarray:
    """Per sample: mean absolute difference, multiplied by a weight inside a box."""
    w = np.ones(a.shape[-2:])
    crop(w, box)[...] = weight
    return (np.abs(a - b) * w).reshape(len(a), -1).mean(axis=1)


def combined(a: np.ndarray, b: np.ndarray, box: tuple[int, int, int, int] = (5, 5, 155, 150), share: float = 0.5, eps: float = 1e-3) -> np.ndarray:
    return charbonnier(a, b, eps) + share * region_weighted(a, b, box)


def temporal_error(a: np.ndarray, b: np.ndarray, box: tuple[int, int, int, int]) -> float:
    """Mean difference of frame-to-frame motion inside a box; 0 for a single frame."""
    if len(a) < 2:
        return 0.0
    return float(np.abs(np.diff(crop(a, box), axis=0) - np.diff(crop(b, box), axis=0)).mean())


def image_metrics_udf(height: int, width: int, peak: float = 255.0):
    """Arrow UDF over two flat images: struct<mae, rmse, max_abs, psnr, ssim>."""

    @F.pandas_udf("mae double, rmse double, max_abs double, psnr double, ssim double")
    def run(a: pd.Series, b: pd.Series) -> pd.DataFrame:
        shape = (height, width)
        return pd.DataFrame([image_metrics(np.asarray(x).reshape(shape), np.asarray(y).reshape(shape), peak) for x, y in zip(a, b, strict=True)], columns=["mae", "rmse", "max_abs", "psnr", "ssim"])

    return run


def blur_udf(height: int, width: int):
    @F.pandas_udf("double")
    def run(image: pd.Series) -> pd.Series:
        return pd.Series([laplacian_variance(np.asarray(x).reshape(height, width)) for x in image], dtype="float64")

    return run


def tiled(values: Column, times: int) -> Column:
    """Each element repeated, as a wider signal."""
    return F.flatten(F.transform(values, lambda x: F.array_repeat(x, times)))
