"""ROI candidates: filters, overlap, non-maximum suppression, ROI tables."""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cellgrid.functions.geometry import boxes_overlap, clip_rings, corners, polygon_bbox, rescale
from cellgrid.functions.keys import element_key
from cellgrid.sources.storage import stored


def filter_candidates(cands: DataFrame, min_area: float, max_area: float, min_iou: float, min_stability: float) -> DataFrame:
    """Candidates whose area lies strictly between the limits and whose scores exceed theirs."""
    area = F.col("w").cast("bigint") * F.col("h")
    return cands.where((area > min_area) & (area < max_area) & (F.col("predicted_iou") > min_iou) & (F.col("stability_score") > min_stability))


def mask_intensity(cand_pixels: DataFrame, pixels: DataFrame, min_int: float | None = None) -> DataFrame:
    """``slide, cand_id, mean_int``: mean value under each candidate's mask (``slide, cand_id, y, x``), above ``min_int`` if given.

    Candidates without pixels have no mean and are left out.
    """
    both = cand_pixels.join(pixels.select("slide", "y", "x", "value"), ["slide", "y", "x"])
    means = both.groupBy("slide", "cand_id").agg(F.avg("value").alias("mean_int"))
    return means if min_int is None else means.where(F.col("mean_int") > min_int)


def overlap_pairs(boxes: DataFrame, cell: int = 128, key: str = "ordinal", carry: Sequence[str] = ()) -> DataFrame:
    """``slide, a, b`` (a < b): overlapping boxes of a slide, and both boxes' columns in ``carry`` as ``a_`` and ``b_`` with their names.

    Boxes meet in grid cells, an equi-join. Two boxes may share several cells; the pair counts in the cell that holds
    the top left corner of what they share, so that no pair comes twice.
    """
    at = lambda n, e: F.sequence(F.floor(F.col(n) / cell), F.floor((F.col(n) + F.greatest(F.col(e), F.lit(1)) - 1) / cell))
    spread = boxes.withColumn("cx", F.explode(at("x", "w"))).withColumn("cy", F.explode(at("y", "h")))
    side = lambda p: spread.select("slide", "cx", "cy", *[F.col(c).alias(f"{p}_{c}") for c in dict.fromkeys((key, "x", "y", "w", "h", *carry))])
    both = side("a").join(side("b"), ["slide", "cx", "cy"]).where((F.col(f"a_{key}") < F.col(f"b_{key}")) & boxes_overlap("a_", "b_"))
    home = (F.floor(F.greatest("a_x", "b_x") / cell) == F.col("cx")) & (F.floor(F.greatest("a_y", "b_y") / cell) == F.col("cy"))
    return both.where(home).select("slide", F.col(f"a_{key}").alias("a"), F.col(f"b_{key}").alias("b"), *[f"{p}_{c}" for p in "ab" for c in carry])


def nms(boxes: DataFrame, score: str = "predicted_iou", key: str = "ordinal", cell: int = 128, most: int = 50_000) -> DataFrame:
    """Boxes that greedy non-maximum suppression keeps: by score, ties by ``key``, any overlap removes.

    Overlaps go to the tile of their lower-ranked box, which thus sees all that may suppress it; tiles hold ``most`` boxes
    on average. In order of rank, a tile settles each box of which it knows enough: a kept neighbour removes it, and with
    all neighbours removed it stays. What waits for another tile is left to the next round, which shifts the tiles by half
    their side, so that rounds are as many as the tiles that a chain of overlaps crosses, not as the boxes in it.
    """
    # pairs bring score and place along, which joins with the boxes would take two shuffles for
    pairs = overlap_pairs(boxes, cell, key, list(dict.fromkeys([score, "x", "y"])))
    sa, sb = (F.col(f"{p}_{score}").cast("double") for p in "ab")
    first = (sa > sb) | ((sa == sb) & (F.col("a") < F.col("b")))
    lower = lambda c: F.when(first, F.col(f"b_{c}")).otherwise(F.col(f"a_{c}"))
    hi, lo = F.when(first, F.col("a")).otherwise(F.col("b")), F.when(first, F.col("b")).otherwise(F.col("a"))
    live = stored(pairs.select("slide", hi.alias("hi"), lo.alias("lo"), lower(score).cast("double").alias("s"), lower("x").alias("x"), lower("y").alias("y")))
    span = live.agg(F.count("*").alias("n"), *[(F.max(c) - F.min(c) + 1).alias(c) for c in ("x", "y")], F.countDistinct("slide").alias("slides")).first()
    id_type = dict(live.dtypes)["lo"]
    gone = live.select("slide", "lo").limit(0)
    if span.n:
        side = max(4 * cell, math.ceil(math.sqrt(span.x * span.y * span.slides * most / span.n)))

    def settle(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["s", "lo"], ascending=[False, True])
        kept = dict.fromkeys(pdf.hi[pdf.top].tolist(), True)  # by box: True if it stays, False if not
        los, his = pdf.lo.to_numpy(), pdf.hi.tolist()
        begin = np.flatnonzero(np.append(True, los[1:] != los[:-1])).tolist()
        own = []
        for at, end in zip(begin, [*begin[1:], len(his)]):
            states = [kept.get(h) for h in his[at:end]]
            if True in states or None not in states:
                own.append(lo := los[at].item() if hasattr(los[at], "item") else los[at])
                kept[lo] = True not in states
        return pd.DataFrame({"slide": pdf.slide.iloc[0], "id": own, "kept": [kept[k] for k in own]})

    r = 0
    while not live.isEmpty():
        tops = live.select("slide", F.col("lo").alias("hi"), F.lit(False).alias("top")).distinct()
        shift = r % 2 * (side // 2)
        tile = [F.floor((F.col(c) + shift) / side).alias(f"t{c}") for c in "xy"]
        known = live.join(tops, ["slide", "hi"], "left").select("slide", "hi", "lo", "s", F.coalesce("top", F.lit(True)).alias("top"), *tile)
        done = stored(known.groupBy("slide", "tx", "ty").applyInPandas(settle, f"slide string, id {id_type}, kept boolean"))
        lost = done.where("not kept").select("slide", F.col("id").alias("lo"))
        gone = gone.unionByName(lost)
        rest = live.join(done.select("slide", F.col("id").alias("lo")), ["slide", "lo"], "left_anti")
        live, r = stored(rest.join(lost.withColumnRenamed("lo", "hi"), ["slide", "hi"], "left_anti")), r + 1
    return boxes.join(gone.withColumnRenamed("lo", key), ["slide", key], "left_anti")


def refine(cands: DataFrame, min_area: float, max_area: float, min_iou: float, min_stability: float, bright: DataFrame | None = None) -> DataFrame:
    """Corners of the candidates that pass the filters, are bright (``slide, cand_id``, if given) and survive suppression."""
    good = filter_candidates(cands, min_area, max_area, min_iou, min_stability)
    if bright is not None:
        good = good.join(bright.select("slide", F.col("cand_id").alias("ordinal")), ["slide", "ordinal"], "left_semi")
    box = [F.col(c) for c in "xywh"]
    return nms(good).select("slide", "ordinal", corners(*box).alias("ring"))


def clip_polygons(polys: DataFrame, height: int, width: int) -> DataFrame:
    """Polygons (``ring`` in (row, col)) cut to the frame, a row for each ``part`` that is left; those outside are dropped."""
    return clip_rings(polys, F.lit(height), F.lit(width))


def _order() -> list:
    # rows and columns halved and rounded half-even to thousands, so that a grid of ROIs is read row by row
    return [F.bround(F.col(c) / 2, -3) for c in ("row_start", "column_start")] + [F.col("ordinal")]


def order_rois(rois: DataFrame) -> DataFrame:
    """ROIs with their ``place`` in reading order, by slide."""
    order = [*_order(), *(["part"] if "part" in rois.columns else [])]
    return rois.withColumn("place", F.row_number().over(Window.partitionBy("slide").orderBy(*order)) - 1)


def name_rois(rois: DataFrame) -> DataFrame:
    """ROIs named ROI_000, ROI_001 and so on in reading order."""
    return order_rois(rois).withColumn("roi", F.format_string("ROI_%03d", "place")).drop("place")


def build_rois(polys: DataFrame, height: int, width: int, level: int) -> DataFrame:
    """ROI table from polygons drawn at a pyramid level: scaled, cut to the frame, boxed, ordered and named."""
    full = clip_polygons(polys.withColumn("ring", rescale(F.col("ring"), level)), height, width)
    box = full.withColumn("box", polygon_bbox(F.col("ring"))).select("*", "box.*").drop("box")
    return name_rois(box)


def visual_rois(rois: DataFrame, level: int) -> DataFrame:
    """``slide, roi, ring``: the corners of each ROI at a pyramid level, cut to integers."""
    k = 1 << level
    c = lambda r, s: F.struct((F.col(r) / k).cast("int").alias("row"), (F.col(s) / k).cast("int").alias("col"))
    ring = F.array(c("row_start", "column_start"), c("row_start", "column_stop"), c("row_stop", "column_stop"), c("row_stop", "column_start"))
    return rois.select("slide", "roi", ring.alias("ring"))


def rgb_stretch(pixels: DataFrame, lo: float | None = None, hi: float | None = None) -> DataFrame:
    """``rgb``: values stretched from [lo, hi] (the element's own range if not given) to 0..255, three times."""
    limits = pixels.groupBy(*element_key(pixels)).agg(
        (F.min("value") if lo is None else F.lit(float(lo))).alias("lo"), (F.max("value") if hi is None else F.lit(float(hi))).alias("hi")
    )
    v = F.try_divide(F.col("value") - F.col("lo"), F.col("hi") - F.col("lo"))
    byte = F.floor(F.least(F.greatest(v, F.lit(0.0)), F.lit(1.0)) * 255).cast("int")
    return pixels.join(limits, element_key(pixels)).select(*element_key(pixels), "y", "x", F.when(v.isNotNull(), F.array_repeat(byte, 3)).alias("rgb"))


def auto_thresholds(pixels: DataFrame, nominal: float, level: int = 0, lo: float = 0.75, hi: float = 1.25) -> DataFrame:
    """Sampling density, area limits and least intensity for a detector, per element."""
    side = F.greatest(F.max("y") + 1, F.max("x") + 1)
    area = lambda f: F.lit((f * nominal / (1 << level)) ** 2)
    return pixels.groupBy(*element_key(pixels)).agg(
        (2 * (side / nominal).cast("int")).alias("density"), area(lo).alias("min_area"), area(hi).alias("max_area"), F.avg("value").alias("min_int")
    )
