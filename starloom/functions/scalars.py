"""Scalar expressions on columns, and their NumPy twins where a kernel needs them."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F


def edge_weight(a: Column, b: Column) -> Column:
    """64 * (min / max) / (a + b) of two log-degrees; one for an edge between nodes of like, low degree is large."""
    return F.lit(64.0) * (F.least(a, b) / F.greatest(a, b)) / (a + b)


def alias_weight(degree: Column) -> Column:
    """Neighbours of high degree count less: 1 / log(1 + degree); null at degree 0."""
    return F.when(degree > 0, F.lit(1.0) / F.log1p(degree))


def quantise16(p: Column) -> Column:
    """A probability as 16 bits; 1.0 saturates at the highest value instead of wrapping to 0."""
    return F.least(F.floor(p * 65536), F.lit(65535)).cast("int")


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def distance(a: Column, b: Column) -> Column:
    def square(x: Column, y: Column) -> Column:
        d = x.cast("double") - y.cast("double")
        return d * d

    return F.sqrt(F.aggregate(F.zip_with(a, b, square), F.lit(0.0), lambda s, x: s + x))


def clip(x: Column, low: float, high: float) -> Column:
    return F.greatest(F.least(x, F.lit(high)), F.lit(low))


def pack_colour(r: Column, g: Column, b: Column) -> Column:
    """b << 16 | g << 8 | r, in 32 bits."""
    return F.shiftleft(b.cast("int"), 16).bitwiseOR(F.shiftleft(g.cast("int"), 8)).bitwiseOR(r.cast("int"))


def unpack_colour(c: Column) -> tuple[Column, Column, Column]:
    return c.bitwiseAND(F.lit(255)), F.shiftright(c, 8).bitwiseAND(F.lit(255)), F.shiftright(c, 16).bitwiseAND(F.lit(255))


def next_power_of_two(side: Column) -> Column:
    return F.when(side > 0, F.pow(F.lit(2.0), F.ceil(F.log2(side)))).otherwise(F.lit(0.0))


def box_distance(x: Column, y: Column, cx: Column, cy: Column, side: Column) -> Column:
    """Least distance from a point to a square; 0 inside."""
    return F.hypot(F.greatest(F.abs(x - cx) - side / 2, F.lit(0.0)), F.greatest(F.abs(y - cy) - side / 2, F.lit(0.0)))


def splitmix64(x: np.ndarray) -> np.ndarray:
    """The public SplitMix64 mixing function, on unsigned 64-bit arrays (wraps around)."""
    with np.errstate(over="ignore"):
        z = x + np.uint64(0x9E3779B97F4A7C15)
        z = (z ^ z >> np.uint64(30)) * np.uint64(0xBF58476D1CE4E5B9)
        z = (z ^ z >> np.uint64(27)) * np.uint64(0x94D049BB133111EB)
        return z ^ z >> np.uint64(31)


def uniform(*cols: Column) -> Column:
    """A reproducible uniform number in [0, 1) from a hash of the columns."""
    return F.pmod(F.xxhash64(*cols), F.lit(1 << 52)) / float(1 << 52)


def hsluv_to_rgb(h: np.ndarray, s: np.ndarray, lightness: np.ndarray) -> np.ndarray:
    """HSLuv (degrees, 0..100, 0..100) to sRGB in 0..1, rows by 3; after the public HSLuv specification."""
    h, s, lightness = (np.asarray(x, float) for x in (h, s, lightness))
    # sRGB's matrix from XYZ, the white point's u' and v', and the CIE constants.
    matrix = np.array([[3.240969941904521, -1.537383177570093, -0.498610760293], [-0.96924363628087, 1.87596750150772, 0.041555057407175], [0.055630079696993, -0.20397695888897, 1.056971514242878]])
    ref_u, ref_v, kappa, epsilon = 0.19783000664283, 0.46831999493879, 903.2962962, 0.0088564516
    sub1 = (lightness + 16) ** 3 / 1560896
    sub2 = np.where(sub1 > epsilon, sub1, lightness / kappa)
    theta = np.radians(h)
    longest = np.full(h.shape, np.inf)
    for m1, m2, m3 in matrix:
        for t in (0, 1):
            top1 = (284517 * m1 - 94839 * m3) * sub2
            top2 = (838422 * m3 + 769860 * m2 + 731718 * m1) * lightness * sub2 - 769860 * t * lightness
            bottom = (632260 * m3 - 126452 * m2) * sub2 + 126452 * t
            with np.errstate(divide="ignore", invalid="ignore"):
                length = (top2 / bottom) / (np.sin(theta) - top1 / bottom * np.cos(theta))
            longest = np.where(length >= 0, np.minimum(longest, length), longest)
    c = np.where((lightness > 99.9999999) | (lightness < 1e-8), 0.0, longest * s / 100)
    u, v = np.cos(theta) * c, np.sin(theta) * c
    with np.errstate(divide="ignore", invalid="ignore"):
        var_u, var_v = u / (13 * lightness) + ref_u, v / (13 * lightness) + ref_v
        y = np.where(lightness <= 8, lightness / kappa, ((lightness + 16) / 116) ** 3)
        x = y * 9 * var_u / (4 * var_v)
        z = y * (12 - 3 * var_u - 20 * var_v) / (4 * var_v)
    xyz = np.where((lightness < 1e-8)[..., None], 0.0, np.stack([x, y, z], -1))
    rgb = xyz @ matrix.T
    return np.clip(np.where(rgb <= 0.0031308, 12.92 * rgb, 1.055 * np.maximum(rgb, 1e-12) ** (1 / 2.4) - 0.055), 0, 1)
