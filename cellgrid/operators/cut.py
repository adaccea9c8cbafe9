"""ROI cutting and pyramids."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellgrid.functions.geometry import covers
from cellgrid.functions.keys import element_key


def cut_window(rois: DataFrame, elements: DataFrame, margin: int = 0) -> DataFrame:
    """Each ROI's window ``y0, y1, x0, x1`` (half-open) in each element of its slide: with a margin, cut to the frame."""
    if margin < 0:
        raise ValueError("the margin must not be negative")
    return rois.join(elements.select("slide", "element", "height", "width"), "slide").withColumns({
        "y0": F.greatest(F.lit(0), F.col("row_start") - margin), "y1": F.least("height", F.col("row_stop") + margin),
        "x0": F.greatest(F.lit(0), F.col("column_start") - margin), "x1": F.least("width", F.col("column_stop") + margin),
    })


def cut(pixels: DataFrame, rois: DataFrame, elements: DataFrame, margin: int = 0, mask_value: float = 0.0, tile: int = 64) -> DataFrame:
    """Pixels of each ROI, with coordinates from its window's corner: ``slide, roi, element, y, x, value``.

    All inputs have their ``slide``. Windows and pixels meet by tiles, an equi-join, so a pixel goes to every window that
    holds it without a test of all pairs. For polygons (vertices rounded half-even) pixels outside take ``mask_value``;
    the outline counts as inside.
    """
    known = F.when(F.col("poly_type").isin("rectangle", "polygon"), F.col("poly_type")).otherwise(F.raise_error(F.concat(F.lit("unknown poly_type "), "poly_type")))
    w = cut_window(rois, elements, margin).withColumn("poly_type", known)
    span = lambda a, b: F.sequence(F.expr(f"{a} div {tile}"), F.expr(f"({b} - 1) div {tile}"))
    w = w.where("y1 > y0 and x1 > x0").withColumn("__ty", F.explode(span("y0", "y1"))).withColumn("__tx", F.explode(span("x0", "x1")))
    ring = F.transform("polygon_vertices", lambda v: F.struct(F.bround(v["row"] - F.col("y0")).alias("y"), F.bround(v["col"] - F.col("x0")).alias("x")))
    w = w.select("slide", "roi", "element", "poly_type", ring.alias("__ring"), "y0", "y1", "x0", "x1", "__ty", "__tx")
    p = pixels.select("slide", "element", "y", "x", "value").withColumns({"__ty": F.expr(f"cast(y div {tile} as bigint)"), "__tx": F.expr(f"cast(x div {tile} as bigint)")})
    both = p.join(w, ["slide", "element", "__ty", "__tx"]).where("y >= y0 and y < y1 and x >= x0 and x < x1")
    ly, lx = F.col("y") - F.col("y0"), F.col("x") - F.col("x0")
    inside = (F.col("poly_type") == "rectangle") | covers(F.col("__ring"), lx.cast("double"), ly.cast("double"))
    # in a step of its own: in one select, the test's functions would see the new y and x
    both = both.withColumn("value", F.when(inside, F.col("value")).otherwise(F.lit(float(mask_value))))
    return both.select("slide", "roi", "element", ly.alias("y"), lx.alias("x"), "value")


def cut_all(pixels: DataFrame, channels: DataFrame, rois: DataFrame, elements: DataFrame, margin: int = 0, mask_value: float = 0.0) -> DataFrame:
    """All ROIs from the elements named in ``channels(slide, element)``, in one plan."""
    return cut(pixels.join(channels.select("slide", "element"), ["slide", "element"], "left_semi"), rois, elements, margin, mask_value)


def pyramid(df: DataFrame, levels: int, factor: int = 2, labels: bool = False) -> DataFrame:
    """``level`` 0 to levels - 1: images by mean over factor x factor, labels by the pixel at the corner.

    Level 0 is the input itself. Each further level of an image adds up sums and counts of the one before, so that only
    the first is made from full-size pixels. Cut blocks at the border average what they have.
    """
    if levels < 1 or factor < 2:
        raise ValueError("a pyramid has a level, and a factor of 2, at least")
    value, key = "label" if labels else "value", element_key(df)
    down = lambda c, f: F.expr(f"cast({c} div {f} as int)").alias(c)
    out = df.select(*key, F.lit(0).alias("level"), "y", "x", value)
    if labels:
        for level in range(1, levels):
            f = factor**level
            out = out.unionByName(df.where(f"y % {f} = 0 and x % {f} = 0").select(*key, F.lit(level).alias("level"), down("y", f), down("x", f), value))
        return out
    sums = df.select(*key, "y", "x", F.col("value").alias("total"), F.lit(1).cast("bigint").alias("n"))
    for level in range(1, levels):
        sums = sums.groupBy(*key, down("y", factor), down("x", factor)).agg(F.sum("total").alias("total"), F.sum("n").alias("n"))
        out = out.unionByName(sums.select(*key, F.lit(level).alias("level"), "y", "x", (F.col("total") / F.col("n")).alias("value")))
    return out


def upsample(df: DataFrame, factor: int) -> DataFrame:
    """Each pixel as factor x factor pixels."""
    if factor < 1:
        raise ValueError("the factor must be 1 at least")
    steps = lambda: F.explode(F.sequence(F.lit(0), F.lit(factor - 1)))
    big = df.withColumn("__dy", steps()).withColumn("__dx", steps())
    return big.withColumns({"y": F.col("y") * factor + F.col("__dy"), "x": F.col("x") * factor + F.col("__dx")}).drop("__dy", "__dx")
