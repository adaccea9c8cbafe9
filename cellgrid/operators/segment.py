"""Segmentation: a callable on stacked channels, and labelled components."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cellgrid.functions.keys import roi_key, typed_key
from cellgrid.operators.tiles import halo_tiles, whole_groups
from cellgrid.sources.storage import stored


def stack_channels(pixels: DataFrame, names: list[str]) -> DataFrame:
    """``[slide,] roi, y, x, values``: the values of several elements in the order of ``names``."""
    return _stacked(pixels, names).select(*roi_key(pixels), "y", "x", F.array(*[f"v{i}" for i in range(len(names))]).alias("values"))


def _stacked(pixels: DataFrame, names: list[str]) -> DataFrame:
    per = [F.max(F.when(F.col("element") == n, F.col("value"))).alias(f"v{i}") for i, n in enumerate(names)]
    return pixels.where(F.col("element").isin(*names)).groupBy(*roi_key(pixels), "y", "x").agg(*per)


#: The model of a Python worker: the token of the call it belongs to, and what its ``load`` gave.
_MODEL: list = [None, None]


def _model(token: str, load: Callable[[], Callable]) -> Callable:
    """The model of a call, loaded the first time that a worker needs it. A worker keeps one, that of its last call."""
    if _MODEL[0] != token:
        _MODEL[:] = [token, load()]
    return _MODEL[1]


Labels = dict[str, np.ndarray]


def segment_objects(
    pixels: DataFrame, fn: Callable[[np.ndarray], Labels] | None, names: list[str], tile: int = 512, halo: int = 64, instances: bool = False,
    load: Callable[[], Callable[[list[np.ndarray]], list[Labels]]] | None = None, batch: int = 4,
) -> DataFrame:
    """Label masks from ``fn``: an array (channels, height, width) in, integer masks by name out.

    A model that is dear to load comes as ``load`` instead (and None for ``fn``): each Python worker calls it once, and what
    it gives takes lists of up to ``batch`` arrays. Tiles come with ``halo`` pixels around them, so that what a task holds
    is bounded whatever the image's size.

    Labels are classes, which a tile gives to its own pixels. With ``instances`` they are objects: the tile that holds an
    object's first pixel gives all of it (an object must not reach further than ``halo`` beyond that tile), and objects are
    numbered from 1 per ROI and element, in order of tiles. Of two objects at a pixel the smaller number wins.
    """
    if (fn is None) == (load is None):
        raise ValueError("either a function or what loads one")
    key, token = roi_key(pixels), uuid.uuid4().hex
    load = load or (lambda: lambda images: [fn(i) for i in images])
    at, values = [*key, "ty", "tx"], [f"v{i}" for i in range(len(names))]

    def image(pdf: pd.DataFrame) -> np.ndarray:
        ya, xa = max(0, int(pdf.ty.iloc[0]) * tile - halo), max(0, int(pdf.tx.iloc[0]) * tile - halo)
        out = np.zeros((len(names), pdf.y.max() + 1 - ya, pdf.x.max() + 1 - xa))
        out[:, pdf.y - ya, pdf.x - xa] = pdf[values].to_numpy().T
        return out

    def rows(pdf: pd.DataFrame, found: Labels) -> pd.DataFrame:
        y0, x0 = int(pdf.ty.iloc[0]) * tile, int(pdf.tx.iloc[0]) * tile
        ya, xa = max(0, y0 - halo), max(0, x0 - halo)
        parts = []
        for name, labels in found.items():
            y, x = np.nonzero(labels)
            label = labels[y, x]
            own = (y + ya >= y0) & (y + ya < y0 + tile) & (x + xa >= x0) & (x + xa < x0 + tile)
            if instances:
                _, first, place = np.unique(label, return_index=True, return_inverse=True)  # pixels come row by row
                own = own[first][place]
            parts.append(pd.DataFrame({**{k: pdf[k].iloc[0] for k in at}, "element": name, "y": y[own] + ya, "x": x[own] + xa, "label": label[own]}))
        return pd.concat(parts)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[pd.DataFrame] = []

        def segmented() -> Iterator[pd.DataFrame]:
            for pdf, found in zip(held, _model(token, load)([image(h) for h in held])):
                yield rows(pdf, found)
            held.clear()

        for whole in whole_groups(batches, at):
            for _, pdf in whole.groupby(at, sort=False):
                held.append(pdf)
                if len(held) == batch:
                    yield from segmented()
        if held:
            yield from segmented()

    tiles = halo_tiles(_stacked(pixels, names), halo, tile).where("ty >= 0 and tx >= 0")
    found = tiles.repartition(*at).sortWithinPartitions(*at).mapInPandas(run, f"{typed_key(key)}, ty bigint, tx bigint, element string, y int, x int, label int")
    if instances:
        found = stored(found)
        each = [*key, "element", "ty", "tx", "label"]
        number = F.row_number().over(Window.partitionBy(*key, "element").orderBy("ty", "tx", "label"))
        numbers = found.select(*each).distinct().withColumn("number", number)
        # stored labels take so little room that all of their pixels would be broadcast
        found = found.hint("merge").join(numbers, each).groupBy(*key, "element", "y", "x").agg(F.min("number").alias("label"))
    return found.select(*key, "element", "y", "x", "label")


def min_labels(edges: DataFrame, most_rounds: int = 100) -> DataFrame:
    """``[slide,] roi, node, label``: the smallest node that edges ``[slide,] roi, a, b`` lead to, for every node of an edge."""
    key = roi_key(edges)
    e = edges.select(*key, F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct()
    e, state = stored(e), None
    for _ in range(most_rounds):
        both = e.unionByName(e.select(*key, F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy(*key, "a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.join(least, [*key, "a"]).where("b > a").select(*key, F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        least = large.groupBy(*key, "a").agg(F.min("b").alias("m"))
        small = large.join(least, [*key, "a"]).where("b <> m").select(*key, F.col("b").alias("a"), F.col("m").alias("b"))
        e = stored(small.unionByName(least.select(*key, "a", F.col("m").alias("b"))).distinct())
        now = e.agg(F.count("*"), F.bit_xor(F.xxhash64(*key, "a", "b"))).first()
        if now == state:
            return e.select(*key, F.col("a").alias("node"), F.col("b").alias("label"))
        state = now
    raise RuntimeError("components did not settle")


def label_components(points: DataFrame, width: int, connectivity: int = 8, tile: int = 256, element: str = "components") -> DataFrame:
    """Connected components of foreground pixels ``[slide,] roi, y, x``, numbered from 1 in order of their first pixels.

    Tiles are labelled apart; pixels on both sides of a seam are edges between those labels, and the smallest label wins.
    ``width`` is at least that of the image.
    """
    key = roi_key(points)
    steps = [(0, 1), (1, 0)] + ([(1, 1), (1, -1)] if connectivity == 8 else [])

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        y, x = pdf.y.to_numpy(np.int64), pdf.x.to_numpy(np.int64)
        y0, x0 = y.min(), x.min()
        at = np.full((y.max() - y0 + 3, x.max() - x0 + 3), -1, np.int64)
        at[y - y0 + 1, x - x0 + 1] = np.arange(len(y))
        node = y * width + x
        label = node.copy()
        links = [(at[y - y0 + 1, x - x0 + 1], at[y - y0 + 1 + dy, x - x0 + 1 + dx]) for dy, dx in steps]
        a, b = (np.concatenate(z) for z in zip(*links))
        a, b = a[b >= 0], b[b >= 0]
        order = np.argsort(node)
        where = lambda v: order[np.searchsorted(node[order], v)]
        while True:
            new = label.copy()
            np.minimum.at(new, a, label[b])
            np.minimum.at(new, b, label[a])
            new = np.minimum(new, new[where(new)])  # jump to the label of the label
            if (new == label).all():
                break
            label = new
        return pd.DataFrame({**{k: pdf[k].iloc[0] for k in key}, "y": y, "x": x, "part": label})

    tiled = points.select(*key, "y", "x", F.floor(F.col("y") / tile).alias("ty"), F.floor(F.col("x") / tile).alias("tx"))
    parts = stored(tiled.groupBy(*key, "ty", "tx").applyInPandas(run, f"{typed_key(key)}, y int, x int, part bigint"))
    seam = parts.where(f"y % {tile} in (0, {tile - 1}) or x % {tile} in (0, {tile - 1})")
    offsets = F.array(*[F.struct(F.lit(dy).alias("dy"), F.lit(dx).alias("dx")) for dy, dx in steps])
    moved = seam.withColumn("o", F.explode(offsets)).select(*key, (F.col("y") + F.col("o.dy")).alias("y"), (F.col("x") + F.col("o.dx")).alias("x"), F.col("part").alias("a"))
    edges = moved.join(seam.withColumnRenamed("part", "b"), [*key, "y", "x"]).where("a <> b").select(*key, "a", "b")
    labels = min_labels(edges).select(*key, F.col("node").alias("part"), F.col("label").alias("root"))
    whole = parts.join(labels, [*key, "part"], "left").withColumn("root", F.coalesce("root", "part"))
    numbers = whole.select(*key, "root").distinct().withColumn("label", F.row_number().over(Window.partitionBy(*key).orderBy("root")))
    return whole.join(numbers, [*key, "root"]).select(*key, F.lit(element).alias("element"), "y", "x", "label")
