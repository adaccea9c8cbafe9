"""Neighbourhood kernels on halo tiles.

Pixels go to every tile whose core they lie in or near, so that a kernel sees what it needs; a tile is bounded, whatever
the image's size.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellgrid.functions.keys import element_key, roi_key, typed_key


def halo_tiles(pixels: DataFrame, radius: int, tile: int) -> DataFrame:
    """Pixels with ``ty, tx`` of each tile whose core is at most ``radius`` away."""
    near = lambda c: F.explode(F.sequence(F.floor((F.col(c) - radius) / tile), F.floor((F.col(c) + radius) / tile)))
    return pixels.withColumn("ty", near("y")).withColumn("tx", near("x"))


def _framed(df: DataFrame, extent: DataFrame, on: list[str], radius: int, tile: int) -> DataFrame:
    """Halo tiles within the frames ``height, width``."""
    frame = extent.select(*on, "height", "width").distinct()
    tiles = halo_tiles(df, radius, tile).join(frame, on)
    return tiles.where((F.col("ty") >= 0) & (F.col("tx") >= 0) & (F.col("ty") * tile < F.col("height")) & (F.col("tx") * tile < F.col("width")))


def by_tile(pixels: DataFrame, elements: DataFrame, radius: int, kernel: Callable[[np.ndarray], np.ndarray], tile: int = 512) -> DataFrame:
    """``kernel`` on each tile with its surroundings: an array in, one of the same shape out.

    Beyond the image the nearest pixel is repeated. ``elements`` has each element's height and width.
    """
    key = element_key(pixels, elements)

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        first = pdf.iloc[0]
        y0, x0, h, w = int(first.ty) * tile, int(first.tx) * tile, int(first.height), int(first.width)
        y1, x1 = min(y0 + tile, h), min(x0 + tile, w)
        ya, xa, yb, xb = max(0, y0 - radius), max(0, x0 - radius), min(h, y1 + radius), min(w, x1 + radius)
        area = np.zeros((yb - ya, xb - xa))
        area[pdf.y.to_numpy() - ya, pdf.x.to_numpy() - xa] = pdf.value.to_numpy()
        pad = ((ya - (y0 - radius), y1 + radius - yb), (xa - (x0 - radius), x1 + radius - xb))
        out = kernel(np.pad(area, pad, mode="edge"))[radius : radius + y1 - y0, radius : radius + x1 - x0]
        y, x = np.mgrid[y0:y1, x0:x1]
        return pd.DataFrame({**{k: first[k] for k in key}, "y": y.ravel(), "x": x.ravel(), "value": out.ravel()})

    tiles = _framed(pixels, elements, key, radius, tile)
    return tiles.groupBy(*key, "ty", "tx").applyInPandas(run, f"{typed_key(key)}, y int, x int, value double")


def by_label_tile(labels: DataFrame, extent: DataFrame, radius: int, kernel: Callable[[np.ndarray, np.ndarray], np.ndarray], tile: int = 256) -> DataFrame:
    """``kernel`` on tiles of sparse labels ``[slide,] roi, y, x, label``: labels (0 for none) and what lies in the frame in, labels out.

    Both arrays have ``radius`` pixels around the tile. Tiles with nothing in or around them are left out, so a kernel
    must give none for none. ``extent`` has ``[slide,] roi, height, width``.
    """
    key = roi_key(labels, extent)

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        first = pdf.iloc[0]
        y0, x0, h, w = int(first.ty) * tile, int(first.tx) * tile, int(first.height), int(first.width)
        area = np.zeros((tile + 2 * radius, tile + 2 * radius), np.int32)
        area[pdf.y.to_numpy() - y0 + radius, pdf.x.to_numpy() - x0 + radius] = pdf.label.to_numpy()
        y, x = np.ogrid[y0 - radius : y0 + tile + radius, x0 - radius : x0 + tile + radius]
        frame = (y >= 0) & (y < h) & (x >= 0) & (x < w)
        core = slice(radius, radius + tile)
        out = np.where(frame, kernel(area, frame), 0)[core, core]
        y, x = np.nonzero(out)
        return pd.DataFrame({**{k: first[k] for k in key}, "y": y + y0, "x": x + x0, "label": out[y, x]})

    tiles = _framed(labels.select(*key, "y", "x", "label"), extent, key, radius, tile)
    return tiles.groupBy(*key, "ty", "tx").applyInPandas(run, f"{typed_key(key)}, y int, x int, label int")


def moved(area: np.ndarray, dy: int, dx: int) -> np.ndarray:
    """``out[y, x] = area[y + dy, x + dx]``; 0 from beyond the array."""
    h, w = area.shape
    out = np.zeros_like(area)
    out[max(0, -dy) : h - max(0, dy), max(0, -dx) : w - max(0, dx)] = area[max(0, dy) : h + min(0, dy), max(0, dx) : w + min(0, dx)]
    return out


def whole_groups(batches: Iterator[pd.DataFrame], keys: list[str]) -> Iterator[pd.DataFrame]:
    """Rows that come sorted by ``keys``, cut so that no group is divided."""
    held: list[pd.DataFrame] = []
    for pdf in batches:
        if pdf.empty:
            continue
        last = (pdf[keys] != pdf[keys].iloc[-1]).any(axis=1).to_numpy()
        ends = len(pdf) if not last.any() else int(np.flatnonzero(last)[-1]) + 1  # where the last group begins
        if last.any():
            yield pd.concat([*held, pdf.iloc[:ends]], ignore_index=True)
            held = [pdf.iloc[ends:]]
        elif held and (held[-1][keys].iloc[-1] != pdf[keys].iloc[0]).any():
            yield pd.concat(held, ignore_index=True)
            held = [pdf]
        else:
            held.append(pdf)
    if held:
        yield pd.concat(held, ignore_index=True)
