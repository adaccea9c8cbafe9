"""Mask algebra on sparse labels ``[slide,] roi, element, y, x, label``.

What looks at a neighbourhood works on tiles with a halo, so that a pixel is sent to a few tiles at most, whatever the
radius.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cellgrid.functions.keys import roi_key, typed_key
from cellgrid.operators.tiles import by_label_tile, moved
from cellgrid.sources.storage import stored

SIDES = [(-1, 0), (1, 0), (0, -1), (0, 1)]

#: Pixels of the frames that a task of :func:`blob` writes out.
PIXELS = 1 << 20


def _at(*dfs: DataFrame) -> list[str]:
    return [*roi_key(*dfs), "y", "x"]


def _named(df: DataFrame, element: str) -> DataFrame:
    return df.select(*roi_key(df), F.lit(element).alias("element"), "y", "x", "label")


def subtract(a: DataFrame, b: DataFrame, element: str = "difference") -> DataFrame:
    """a's labels where b is background."""
    at = _at(a, b)
    return _named(a.join(b.select(*at), at, "left_anti"), element)


def multiply(a: DataFrame, b: DataFrame, element: str = "product", kind: str = "int") -> DataFrame:
    """Products of the labels where both have one; a product beyond 32 bits is an error, but for the ``kind`` bigint."""
    at = _at(a, b)
    both = a.select(*at, F.col("label").alias("l")).join(b.select(*at, F.col("label").alias("m")), at)
    return _named(both.withColumn("label", (F.col("l").cast("bigint") * F.col("m")).cast(kind)), element)


def disk(radius: float, strict: bool = False) -> list[tuple[int, int, int]]:
    """Offsets ``dy, dx, d2`` of a disk; at most, or ``strict`` under, the radius away."""
    r = int(radius)
    inside = (lambda d: d < radius * radius) if strict else (lambda d: d <= radius * radius)
    return [(y, x, y * y + x * x) for y in range(-r, r + 1) for x in range(-r, r + 1) if inside(y * y + x * x)]


def nearest(seeds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each pixel the squared distance of the nearest seed (a positive label) and its label; of equally near ones the smallest.

    Where there is none, the distance is the largest integer. A column's nearest seeds give parabolas along each row, whose
    lower envelope (Felzenszwalb and Huttenlocher, 2012) is found for all rows together. Work is linear in the pixels. A
    parabola is weighed with a number above all labels, to which its label is added, so that ties are part of the integers.
    """
    h, w = seeds.shape
    far = np.iinfo(np.int64).max
    label = seeds.astype(np.int64)
    weight = int(label.max(initial=0)) + 1
    rows = np.arange(h)[:, None]
    above = np.maximum.accumulate(np.where(label > 0, rows, -1), axis=0)
    below = np.minimum.accumulate(np.where(label > 0, rows, h)[::-1], axis=0)[::-1]
    cost = np.full((h, w), far)
    for at, some in ((above, above >= 0), (below, below < h)):
        y, x = np.nonzero(some)
        d = y - at[y, x]
        cost[y, x] = np.minimum(cost[y, x], d * d * weight + label[at[y, x], x])
    centre = np.zeros((h, w + 1), np.int64)  # the parabolas of each row's envelope, and from where each is lowest
    start = np.full((h, w + 1), far)
    top = np.full(h, -1)
    for q in range(w):
        todo = np.flatnonzero(cost[:, q] < far)
        while len(todo):
            p = centre[todo, top[todo]]
            empty = top[todo] < 0
            # the first place where q is as low as p: a quotient rounded up
            rise = cost[todo, q] + weight * q * q - np.where(empty, 0, cost[todo, p] + weight * p * p)
            first = np.where(empty, 0, -(-rise // (2 * weight * np.maximum(q - p, 1))))
            hidden = ~empty & (first <= start[todo, top[todo]])
            done = todo[~hidden]
            top[todo[hidden]] -= 1
            top[done] += 1
            centre[done, top[done]] = q
            start[done, top[done]] = np.maximum(first[~hidden], 0)
            todo = todo[hidden]
    # the envelope's parabola at each place: how many have begun
    begun = np.zeros((h, w + 1), np.int64)
    y, k = np.nonzero(np.arange(w + 1)[None, :] <= top[:, None])
    np.add.at(begun, (y, np.minimum(start[y, k], w)), 1)
    begun = np.cumsum(begun, axis=1)[:, :w] - 1
    p = np.take_along_axis(centre, np.maximum(begun, 0), axis=1)
    low = np.take_along_axis(cost, p, axis=1)
    known = (begun >= 0) & (low < far)
    low = np.where(known, low, 0) + weight * (np.arange(w) - p) ** 2
    return np.where(known, low // weight, far), np.where(known, low % weight, 0).astype(seeds.dtype)


def expand(labels: DataFrame, radius: float, extent: DataFrame, element: str = "expanded", tile: int = 256) -> DataFrame:
    """Labels grown by ``radius``: background within it takes the nearest label (ties: the smallest)."""

    def kernel(area: np.ndarray, frame: np.ndarray) -> np.ndarray:
        d2, label = nearest(area)
        return np.where(d2 <= radius * radius, label, 0)

    return _named(by_label_tile(labels, extent, int(radius), kernel, tile), element)


def _boundary(area: np.ndarray, frame: np.ndarray) -> np.ndarray:
    """Pixels, of label or background, with a 4-neighbour within the image of another value."""
    out = np.zeros(area.shape, bool)
    for dy, dx in SIDES:
        out |= moved(frame, dy, dx) & (moved(area, dy, dx) != area)
    return out & frame


def erode(labels: DataFrame, radius: float, extent: DataFrame, element: str = "eroded", tile: int = 256) -> DataFrame:
    """Labels without the pixels less than ``radius`` away from a boundary pixel."""

    def kernel(area: np.ndarray, frame: np.ndarray) -> np.ndarray:
        d2, _ = nearest(_boundary(area, frame).astype(np.int32))
        return np.where(d2 < radius * radius, 0, area)

    return _named(by_label_tile(labels, extent, math.ceil(radius) + 1, kernel, tile), element)


def _bound(labels: DataFrame, radius: float, extent: DataFrame) -> DataFrame:
    return labels if radius == 0 else expand(labels, radius, extent) if radius > 0 else erode(labels, -radius, extent)


def ring(labels: DataFrame, extent: DataFrame, outer: float = 7, inner: float = 2, element: str = "ring") -> DataFrame:
    """The labels at ``outer`` without what lies within ``inner``; positive radii grow, negative ones erode."""
    if outer <= inner:
        raise ValueError("the outer radius must exceed the inner one")
    at = _at(labels, extent)
    return _named(_bound(labels, outer, extent).join(_bound(labels, inner, extent).select(*at), at, "left_anti"), element)


def _dilated(area: np.ndarray, radius: float) -> np.ndarray:
    return (nearest(area)[0] <= radius * radius).astype(np.int32)


def _shrunk(area: np.ndarray, frame: np.ndarray, radius: float) -> np.ndarray:
    return np.where(_dilated(((area == 0) & frame).astype(np.int32), radius) == 0, area, 0)


def _binary(points: DataFrame, radius: float, extent: DataFrame, halo: int, kernel, tile: int) -> DataFrame:
    if radius < 0:
        raise ValueError("the radius must not be negative")
    at = _at(points, extent)
    return by_label_tile(points.select(*at, F.lit(1).alias("label")), extent, halo, kernel, tile).select(*at)


def dilate(points: DataFrame, radius: float, extent: DataFrame, tile: int = 256) -> DataFrame:
    """Pixels ``[slide,] roi, y, x`` within ``radius`` of a foreground pixel."""
    return _binary(points, radius, extent, int(radius), lambda area, frame: _dilated(area, radius), tile)


def shrink(points: DataFrame, radius: float, extent: DataFrame, tile: int = 256) -> DataFrame:
    """Pixels whose whole disk, as far as it lies in the image, is foreground."""
    return _binary(points, radius, extent, int(radius), lambda area, frame: _shrunk(area, frame, radius), tile)


def morph_open(points: DataFrame, radius: float, extent: DataFrame) -> DataFrame:
    """Opening of a binary mask: what the disk fits into."""
    return dilate(shrink(points, radius, extent), radius, extent)


def morph_close(points: DataFrame, radius: float, extent: DataFrame) -> DataFrame:
    """Closing of a binary mask: without the gaps that the disk does not fit into."""
    return shrink(dilate(points, radius, extent), radius, extent)


def _resized(c: str, size: Column, out: Column) -> Column:
    """Where index ``c`` of ``size`` counts if an axis is resized to ``out``.

    An output interpolates between the two inputs next to its place, after a blur that reaches four standard deviations,
    each half of what the scale exceeds 1 by; borders are mirrored.
    """
    scale = size / out
    reach = F.floor(F.greatest(scale - 1, F.lit(0.0)) / 2 * 4 + 0.5)

    def counts(i: Column) -> Column:
        at = F.abs((i + 0.5) * size / out - 0.5)
        at = F.when(at > size - 1, 2 * (size - 1) - at).otherwise(at)
        return (i >= 0) & (i < out) & (F.col(c) >= F.floor(at) - reach) & (F.col(c) <= F.ceil(at) + reach)

    some = F.sequence(F.floor((F.col(c) - reach - 2) / scale - 1), F.ceil((F.col(c) + reach + 2) / scale + 1))
    return F.transform(F.filter(some, counts), lambda i: i.cast("int"))


def blob(points: DataFrame, extent: DataFrame, work: tuple[int, int] = (250, 250), radius: float = 5, element: str = "blob") -> DataFrame:
    """A smooth 0/1 mask of foreground pixels, from an opening and closing on a coarse grid.

    The mask is resized to ``work`` cells and back by linear interpolation (with a blur where it gets smaller); what
    exceeds 0 is foreground. The grid of an ROI is one array, so ``work`` bounds what a task holds.
    """
    h, w = work
    if h <= 0 or w <= 0 or radius < 0:
        raise ValueError("the grid must have cells, and the radius must not be negative")
    key = roi_key(points, extent)
    frame = extent.select(*key, "height", "width").distinct()
    coarse = points.select(*key, "y", "x").join(frame, key).withColumn("cy", F.explode(_resized("y", F.col("height"), F.lit(h))))
    coarse = coarse.select(*key, "x", "width", "cy").distinct().withColumn("cx", F.explode(_resized("x", F.col("width"), F.lit(w))))
    coarse = coarse.select(*key, "cy", "cx").distinct()

    def smoothed(pdf: pd.DataFrame) -> pd.DataFrame:
        area, whole = np.zeros((h, w), np.int32), np.ones((h, w), bool)
        area[pdf.cy, pdf.cx] = 1
        area = _dilated(_shrunk(area, whole, radius), radius)  # opening
        area = _shrunk(_dilated(area, radius), whole, radius)  # closing
        y, x = np.nonzero(area)
        return pd.DataFrame({**{k: pdf[k].iloc[0] for k in key}, "y": y, "x": x})

    smooth = stored(coarse.groupBy(*key).applyInPandas(smoothed, f"{typed_key(key)}, y int, x int").join(frame, key))
    # the columns of each cell, of each row of cells, of each line; lines are dealt out before their pixels are written out
    pixels = frame.agg(F.sum(F.col("height").cast("bigint") * F.col("width"))).first()[0] or 0
    across = smooth.select(*key, "x", "width").distinct().select(*key, "x", _resized("x", F.lit(w), F.col("width")).alias("px"))
    together = F.array_distinct(F.flatten(F.collect_list("px"))).alias("px")
    rows = smooth.join(across, [*key, "x"]).groupBy(*key, "y", "height").agg(together)
    lines = rows.withColumn("py", F.explode(_resized("y", F.lit(h), F.col("height")))).repartition(max(1, -(-pixels // PIXELS)), *key, "py")
    fine = lines.groupBy(*key, "py").agg(together).select(*key, F.col("py").alias("y"), F.explode("px").alias("x"))
    return _named(fine.withColumn("label", F.lit(1)), element)
