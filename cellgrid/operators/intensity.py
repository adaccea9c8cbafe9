"""Intensity statistics of labelled objects."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cellgrid.functions.keys import roi_key

#: Metrics by name: functions from a value column to an aggregate.
METRICS: dict[str, Callable[[Column], Column]] = {
    "mean": F.avg, "median": F.median, "min": F.min, "max": F.max, "sum": F.sum, "std": F.stddev_pop,
    "median_approx": lambda v: F.kll_sketch_get_quantile_double(F.kll_sketch_agg_double(v.cast("double"), SKETCH), F.lit(0.5).cast("double")),
}

#: Size of a quantile sketch (Karnin, Lang and Liberty, 2016): up to so many values are kept as they are; beyond, the rank of
#: what a sketch gives is off by under RANK_ERROR of the values, in 99 of 100 cases.
SKETCH, RANK_ERROR = 400, 0.01


def register_metric(name: str, build: Callable[[Column], Column]) -> None:
    """Add a metric: any aggregate expression, a grouped-aggregate pandas UDF among them."""
    if name in METRICS:
        raise ValueError(f"there is a metric {name} already")
    METRICS[name] = build


#: Pixels and labels meet by tiles of 64 x 64 pixels: a coordinate's higher bits name the tile, the lower ones the place in it.
BITS = 6


def _tiled(df: DataFrame) -> DataFrame:
    """Adds ``__ty, __tx``, the tile, and ``__at``, the place in it."""
    low = lambda c: F.col(c).bitwiseAND(F.lit((1 << BITS) - 1))
    tile = {f"__t{c}": F.shiftright(c, BITS).cast("bigint") for c in "yx"}
    return df.withColumns(tile | {"__at": (low("y") * (1 << BITS) + low("x")).cast("int")})


def _label_tiles(labels: DataFrame, key: list[str]) -> DataFrame:
    """``<key>, __ty, __tx, mask, __bare, __none, __base, __codes, __names``: the label at place p is ``__names[__codes[p - __base]]``, none for -1.

    Labels and masks that are null stand in rows of their own (``__none, __bare``), and so do further labels of a mask at
    the same pixel.
    """
    at = [*key, "__ty", "__tx", "mask", "__bare", "__none"]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for *name, place, label in pdf.itertuples(index=False, name=None):
                names, code = np.unique(label, return_inverse=True)
                turn = pd.Series(place).groupby(place).cumcount().to_numpy() if len(np.unique(place)) < len(place) else np.zeros(len(place))
                for t in range(int(turn.max()) + 1):
                    own = place[turn == t]
                    codes = np.full(own.max() + 1 - own.min(), -1, np.int32)
                    codes[own - own.min()] = code[turn == t]
                    rows.append((*name, own.min(), codes, names))
            yield pd.DataFrame(rows, columns=[*at, "__base", "__codes", "__names"])

    kind = labels.schema["label"].dataType.simpleString()
    full = [F.coalesce("element", F.lit("")).alias("mask"), F.isnull("element").alias("__bare"), F.isnull("label").alias("__none"), F.coalesce("label", F.lit("0").cast(kind)).alias("label")]
    flat = _tiled(labels).select(*key, "__ty", "__tx", "__at", *full).dropna(subset=[*key, "__at"])
    # both lists come from the same rows in the same order
    lists = flat.groupBy(*at).agg(F.collect_list("__at").alias("__at"), F.collect_list("label").alias("label"))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in flat.select(*at).schema) + f", __base int, __codes array<int>, __names array<{kind}>"
    return lists.mapInPandas(run, schema)


def under(pixels: DataFrame, labels: DataFrame) -> DataFrame:
    """``[slide,] roi, y, x, mask, label, channel, value``: each pixel of each channel under each label.

    Labels are gathered by tile, and a pixel looks its labels up in its tile's. So what follows by object finds nearly all
    of an object's pixels in one partition; if they met by pixel, an object would be spread over all of them.
    """
    key = roi_key(pixels, labels)
    tile = ["__ty", "__tx", *key]
    seen = _tiled(pixels.select(*key, "y", "x", F.col("element").alias("channel"), "value")).drop("y", "x").join(_label_tiles(labels, key), tile)
    # places are carried by tile only, so that all that is made from the same pixels can share their shuffle
    code = F.get("__codes", F.col("__at") - F.col("__base"))
    mask, label = F.when(~F.col("__bare"), F.col("mask")).alias("mask"), F.when(~F.col("__none"), F.get("__names", code)).alias("label")
    y, x = [(F.shiftleft(f"__t{c}", BITS) + low).cast(pixels.schema[c].dataType).alias(c) for c, low in (("y", F.shiftright("__at", BITS)), ("x", F.col("__at").bitwiseAND(F.lit((1 << BITS) - 1))))]
    return seen.where(code >= 0).select(*key, y, x, mask, label, "channel", "value")


def intensity(pixels: DataFrame, labels: DataFrame, metrics=("mean", "median"), channels: list[str] | None = None) -> DataFrame:
    """``[slide,] roi, mask, channel, label`` and a column for each metric: one join of all masks with all channels."""
    if unknown := [m for m in metrics if m not in METRICS]:
        raise ValueError(f"unknown metrics {unknown}; there are {sorted(METRICS)}")
    if channels is not None:
        pixels = pixels.where(F.col("element").isin(*channels))
    key, both = roi_key(pixels, labels), under(pixels, labels)
    return both.groupBy(*key, "mask", "channel", "label").agg(*[METRICS[m](F.col("value")).alias(m) for m in metrics])


def features(wide: DataFrame, metrics: list[str]) -> DataFrame:
    """Metrics as rows ``[slide,] roi, mask, channel, metric, label, value``."""
    return wide.unpivot([*roi_key(wide), "mask", "channel", "label"], metrics, "metric", "value")


def sketches(pixels: DataFrame, labels: DataFrame, tile: int = 512, by: tuple[str, ...] = ("label",)) -> DataFrame:
    """``[slide,] roi, mask, channel, <by>, tile_y, tile_x, sketch``: a quantile sketch of the values under the objects, tile by tile.

    Sketches of tiles can be stored, and merged with those of further ones by :func:`quantiles`. ``by=()`` takes a mask's
    objects together.
    """
    key, both = roi_key(pixels, labels), under(pixels, labels)
    tiles = [F.floor(F.col(c) / tile).cast("int").alias(f"tile_{c}") for c in "yx"]
    return both.groupBy(*key, "mask", "channel", *by, *tiles).agg(F.kll_sketch_agg_double(F.col("value").cast("double"), SKETCH).alias("sketch"))


def quantiles(sketched: DataFrame, share: float = 0.5) -> DataFrame:
    """``n, value``: the number of values and their approximate quantile, from the merged sketches of each group's tiles."""
    key = [c for c in sketched.columns if c not in ("tile_y", "tile_x", "sketch")]
    merged = sketched.groupBy(*key).agg(F.kll_merge_agg_double("sketch").alias("sketch"))
    return merged.select(*key, F.kll_sketch_get_n_double("sketch").alias("n"), F.kll_sketch_get_quantile_double("sketch", F.lit(float(share))).alias("value"))
