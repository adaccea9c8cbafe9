"""Image enhancement."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cellgrid.functions.keys import element_key, roi_key
from cellgrid.operators.masks import disk
from cellgrid.operators.tiles import by_tile
from cellgrid.sources.storage import stored


def renamed(pattern: str) -> Column:
    """Output names of a step over several inputs: ``${input}`` in the pattern is the input's name."""
    return F.replace(F.lit(pattern), F.lit("${input}"), F.col("element"))


def percentiles(pixels: DataFrame, shares: list[float], margin: float = 0.002) -> DataFrame:
    """``[slide,] roi, element, p``: exact percentiles of each element, with linear interpolation.

    Approximate percentiles a little below and above bracket each one; only values in a bracket are counted and ordered,
    so that no task holds an element's values. Brackets are stored before pixels meet them: they are taken for as large as
    the sketches they come from, and pixels would be shuffled by element, of which there may be few.
    """
    key = element_key(pixels)
    probes = [min(1.0, max(0.0, s + d)) for s in shares for d in (-margin, margin)]
    rough = F.percentile_approx("value", F.array(*map(F.lit, probes)), F.lit(10_000)).alias("b")
    rough = stored(pixels.groupBy(*key).agg(rough, F.count("value").alias("n"), F.min("value").alias("least"), F.max("value").alias("most")))
    at = pixels.select(*key, "value").join(rough, key)
    few = F.col("n") * margin < 8  # there, a bracket may miss the rank by its rounding
    end = lambda i, all_: F.when(few, F.col(all_)).otherwise(F.col("b")[i])
    brackets = [F.struct(F.lit(i).alias("i"), end(2 * i, "least").alias("lo"), end(2 * i + 1, "most").alias("hi")) for i in range(len(shares))]
    each = at.select(*key, "value", "n", F.inline(F.array(*brackets))).where("value <= hi")
    # what lies below a bracket counts at its lower end, as one value
    each = each.withColumns({"below": F.when(F.col("value") < F.col("lo"), 1).otherwise(0), "value": F.greatest("value", "lo")})
    counted = each.groupBy(*key, "i", "n", "value").agg(F.sum(1 - F.col("below")).alias("here"), F.sum("below").alias("below"))
    order = Window.partitionBy(*key, "i").orderBy("value")
    counted = counted.withColumn("upto", F.sum(F.col("here") + F.col("below")).over(order)).where("here > 0")
    place = F.get(F.array(*map(F.lit, shares)), F.col("i")) * (F.col("n") - 1)
    reached = lambda rank: F.min(F.when(F.col("upto") > rank, F.col("value")))
    found = counted.withColumn("place", place).groupBy(*key, "i", "place").agg(reached(F.floor("place")).alias("lo"), reached(F.ceil("place")).alias("hi"))
    part = F.col("place") - F.floor("place")
    value = F.when(part == 0, F.col("lo")).otherwise(F.col("lo") * (1 - part) + F.col("hi") * part)
    return found.groupBy(*key).agg(F.transform(F.array_sort(F.collect_list(F.struct("i", value.alias("v")))), lambda x: x["v"]).alias("p"))


def normalize(pixels: DataFrame, low: float = 1.0, high: float = 99.0, approx: bool = False, pattern: str = "${input}") -> DataFrame:
    """Values between two percentiles of their element, scaled to 0..1 as float; a flat element is an error.

    Percentiles are exact with linear interpolation, or approximate if that is enough. They are worked out and stored
    first, as in :func:`percentiles`.
    """
    if not 0 <= low < high <= 100:
        raise ValueError("percentiles must satisfy 0 <= low < high <= 100")
    key = element_key(pixels)
    shares = [low / 100, high / 100]
    rough = F.percentile_approx("value", F.array(*map(F.lit, shares))).alias("p")
    limits = pixels.groupBy(*key).agg(rough) if approx else percentiles(pixels, shares)
    limits = stored(limits.select(*key, F.col("p")[0].alias("lo"), F.col("p")[1].alias("hi")))
    width = F.col("hi") - F.col("lo")
    width = F.when(width > 0, width).otherwise(F.raise_error(F.concat(F.lit("no contrast in "), "element")).cast("double"))
    v = F.least(F.greatest((F.col("value") - F.col("lo")) / width, F.lit(0.0)), F.lit(1.0)).cast("float")
    return pixels.join(limits, key).select(*roi_key(pixels), renamed(pattern).alias("element"), "y", "x", v.alias("value"))


def median_denoise(pixels: DataFrame, elements: DataFrame, radius: int = 3, pattern: str = "${input}", tile: int = 512) -> DataFrame:
    """Median over a disk; beyond the image the nearest pixel is repeated."""
    if radius < 1:
        raise ValueError("the radius must be 1 at least")
    offsets = [(y, x) for y, x, _ in disk(radius)]

    def kernel(area: np.ndarray) -> np.ndarray:
        around = np.pad(area, radius, mode="edge")
        h, w = area.shape
        out = np.empty_like(area)
        for top in range(0, h, 64):  # rows at a time, as every offset is a copy
            n = min(64, h - top)
            stack = np.stack([around[radius + top + y : radius + top + y + n, radius + x : radius + x + w] for y, x in offsets])
            out[top : top + n] = np.median(stack, axis=0)
        return out

    return by_tile(pixels, elements, radius, kernel, tile).withColumn("element", renamed(pattern))


def mean_of_images(pixels: DataFrame, names: list[str], output: str = "mean") -> DataFrame:
    """Mean of several elements, as float; a pixel that one of them lacks is an error."""
    if not names:
        raise ValueError("mean of no images")
    n = len(set(names))
    mean = pixels.where(F.col("element").isin(*names)).groupBy(*roi_key(pixels), "y", "x").agg(F.avg("value").alias("v"), F.count("*").alias("n"))
    value = F.when(F.col("n") == n, F.col("v")).otherwise(F.raise_error(F.lit("images differ in shape")).cast("double"))
    return mean.select(*roi_key(pixels), F.lit(output).alias("element"), "y", "x", value.cast("float").alias("value"))
