"""Object tables: joins across masks, wide matrices, exclusion by polygons."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellgrid.functions.geometry import points_in
from cellgrid.functions.keys import roi_key


def obs_table(morphology: DataFrame, columns: list[str], masks: list[str]) -> DataFrame:
    """One row per label with each mask's columns as ``<column>_<mask>``; null where a mask lacks the label."""
    per = [F.max(F.when(F.col("mask") == m, F.col(f"`{c}`"))).alias(f"{c}_{m}") for m in masks for c in columns]
    return morphology.where(F.col("mask").isin(*masks)).groupBy(*roi_key(morphology), "label").agg(*per)


def wide(features: DataFrame, names: list[str]) -> DataFrame:
    """Features as columns ``<channel>_<metric>_<mask>``, from a given list of names."""
    name = F.concat_ws("_", "channel", "metric", "mask")
    return features.withColumn("feature", name).groupBy(*roi_key(features), "label").pivot("feature", names).agg(F.first("value"))


def reindex(signal: DataFrame, obs: DataFrame) -> DataFrame:
    """The signal of exactly the labels of ``obs``; null where there is none."""
    own = [*roi_key(obs, signal), "label"]
    return obs.select(*own).join(signal, own, "left")


def pack_arrays(df: DataFrame) -> DataFrame:
    """Columns ``base-<dimension><suffix>`` as one array ``base<suffix>``; a base of one dimension stays as it is."""
    groups: dict[str, dict[int, str]] = {}
    for c in df.columns:
        if m := re.fullmatch(r"(.+)-(\d+)(.*)", c):
            dims = groups.setdefault(m[1] + m[3], {})
            if int(m[2]) in dims:
                raise ValueError(f"{c} repeats a dimension")
            dims[int(m[2])] = c
    for name, dims in groups.items():
        if len(dims) > 1:
            df = df.withColumn(name, F.array(*[F.col(f"`{dims[d]}`") for d in sorted(dims)])).drop(*dims.values())
    return df


def link_region(df: DataFrame, mask: str, masks: list[str]) -> DataFrame:
    """The table with ``region`` (the annotated mask) and ``cell`` (the label)."""
    if mask not in masks:
        raise ValueError(f"{mask} is none of the masks {masks}")
    return df.withColumns({"region": F.lit(mask), "cell": F.col("label")})


def excluded(points: DataFrame, shapes: DataFrame, cell: float = 64.0) -> DataFrame:
    """``[slide,] roi, label, shape_key``: objects (``[slide,] roi, label, x, y``) that a shape of the key covers, its edges included."""
    key = roi_key(points, shapes)
    return points_in(points.where("x is not null and y is not null"), shapes, key, cell=cell).select(*key, "label", "shape_key").distinct()


def used_shapes(features: DataFrame, shapes: DataFrame, prefix: str = "qc_exclude") -> DataFrame:
    """``shape_key, used``: whether shapes of a key belong to the marker of any feature."""
    keys = features.select(F.concat(F.lit(prefix + "_"), F.substring_index("feature", "_", 1)).alias("shape_key")).distinct().withColumn("hit", F.lit(True))
    return shapes.select("shape_key").distinct().join(keys, "shape_key", "left").select("shape_key", F.col("hit").isNotNull().alias("used"))


def qc_mask(features: DataFrame, points: DataFrame, shapes: DataFrame, prefix: str = "qc_exclude", cell: float = 64.0) -> DataFrame:
    """Features (``roi, label, feature``) with ``keep``: false where a shape of the feature's marker covers the object.

    The marker is the feature's name up to its first ``_``; objects without a centroid are kept.
    """
    out = excluded(points, shapes, cell).withColumn("hit", F.lit(True))
    key = F.concat(F.lit(prefix + "_"), F.substring_index("feature", "_", 1))
    return features.withColumn("shape_key", key).join(out, [*roi_key(features, out), "label", "shape_key"], "left").withColumn("keep", F.col("hit").isNull()).drop("hit", "shape_key")
