"""Object tables end to end, and sequences of steps over named elements."""

from __future__ import annotations

import warnings
from collections.abc import Collection, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cellgrid.functions.keys import roi_key
from cellgrid.operators import intensity as measure
from cellgrid.operators import objects, regions
from cellgrid.sources import tables
from cellgrid.sources.storage import stored


def _known(asked: Sequence[str] | None, df: DataFrame, what: str) -> list[str]:
    """The elements that are asked for, or all; one that is not there is an error. Names are as many as a catalog has."""
    there = sorted(r.element for r in df.select("element").distinct().collect())
    if gone := [n for n in asked or () if n not in there]:
        raise ValueError(f"{what} {gone} not found; there are {there}")
    return list(asked) if asked else there


def quantify(
    pixels: DataFrame, labels: DataFrame, shapes: DataFrame | None = None, masks: Mapping[str, str] | None = None, annotate: str = "cell",
    metrics: Sequence[str] = ("mean", "median"), channels: Sequence[str] | None = None, properties: Sequence[str] = regions.DEFAULT, prefix: str = "qc_exclude",
    catalog: DataFrame | None = None,
) -> DataFrame:
    """``[slide,] roi, label, feature, value, keep`` and ``<property>_<mask>``: each object's features beside its morphology.

    ``masks`` names the label elements by suffix (all elements under their own names, if left out). An object is a label
    of any of them; its features are all of channel x metric x mask, null where a mask lacks the label or no pixel lies
    under it. With ``shapes``, ``keep`` is false for features of a marker one of whose shapes covers the object's
    centroid in the mask ``annotate``. Masks and channels that are not there are an error that names those that are. What
    there is comes from ``catalog(element, kind)``, with the kinds ``image`` and ``labels``; without one, from a pass over all pixels.
    """
    there = lambda kind, df: df if catalog is None else catalog.where(F.col("kind") == kind)
    masks = dict(masks) if masks else {m: m for m in _known(None, there("labels", labels), "masks")}
    _known(list(masks.values()), there("labels", labels), "masks")
    channels = _known(channels, there("image", pixels), "channels")
    if shapes is not None and (annotate not in masks or "centroid" not in properties):
        raise ValueError(f"exclusion needs the centroid of {annotate!r}; there are {list(masks)}")
    suffix = F.coalesce(*[F.when(F.col("element") == e, s) for s, e in masks.items()])
    labels = labels.where(F.col("element").isin(*masks.values())).withColumn("element", suffix)
    morphology = regions.properties(labels, properties)
    columns = [c for c in morphology.columns if c not in regions.object_key(morphology)]
    obs = objects.obs_table(morphology, columns, list(masks))
    names = [(c, m, s) for c in channels for m in metrics for s in masks]
    named = F.array(*[F.struct(F.lit(c).alias("channel"), F.lit(m).alias("metric"), F.lit(s).alias("mask")) for c, m, s in names])
    long = measure.features(measure.intensity(pixels, labels, metrics, channels), list(metrics))
    table = obs.withColumn("f", F.explode(named)).select("*", "f.*").drop("f").join(long, [*roi_key(obs, long), "label", "channel", "metric", "mask"], "left")
    table = table.withColumn("feature", F.concat_ws("_", "channel", "metric", "mask")).drop("channel", "metric", "mask")
    if shapes is None:
        return table.withColumn("keep", F.lit(True))
    # a small aggregate of its own, as the whole of obs would be worked out twice
    own = regions.basic(labels.where(F.col("element") == annotate))
    points = own.select(*roi_key(own), "label", F.col("`centroid-1`").alias("x"), F.col("`centroid-0`").alias("y"))
    return objects.qc_mask(table, points, shapes, prefix)


def qc_after(table: DataFrame, points: DataFrame, shapes: DataFrame, prefix: str = "qc_exclude") -> DataFrame:
    """Exclusion on a table of features that has been stored; warns if no shape belongs to any of its markers."""
    if objects.used_shapes(table, shapes, prefix).where("used").isEmpty():
        warnings.warn(f"no exclusion shapes match {prefix}_ and a marker of the table", stacklevel=2)
    return objects.qc_mask(table.drop("keep"), points, shapes, prefix)


def rewrite_qc(spark: SparkSession, path: str, name: str, points: DataFrame, shapes: DataFrame, prefix: str = "qc_exclude") -> None:
    """Exclusion on the stored table ``name``, which the result replaces at once; if it fails, the table stays as it is."""
    table = tables.read_stored(spark, path, {"table_name": name}).drop("table_name")
    tables.write_table(qc_after(table, points, shapes, prefix), path, name, overwrite=True)


def typed(df: DataFrame, kind: str) -> DataFrame:
    """An output as stored: labels as 32-bit integers without background, images with their type and a channel axis."""
    if kind == "labels":
        return df.select(*roi_key(df), "element", "y", "x", F.col("label").cast("int").alias("label")).where("label <> 0")
    if kind == "image":
        return df.select(*roi_key(df), "element", F.lit(0).alias("c"), "y", "x", "value")
    raise ValueError(f"{kind!r} is neither labels nor image")


def missing_inputs(catalog: DataFrame, steps: Sequence[tuple[Sequence[str], Sequence[str]]]) -> DataFrame:
    """``[slide,] roi, step, element``: inputs of steps (inputs, outputs) that an ROI neither holds nor gets from earlier steps."""
    made: set[str] = set()
    needed = []
    for i, (inputs, outputs) in enumerate(steps):
        needed += [(i, e) for e in inputs if e not in made]
        made |= set(outputs)
    key = roi_key(catalog)
    everywhere = catalog.select(*key).distinct().withColumn("asked", F.array(*[F.struct(F.lit(s).alias("step"), F.lit(e).alias("element")) for s, e in needed]))
    asked = everywhere.select(*key, F.inline("asked"))
    return asked.join(catalog.select(*key, "element"), [*key, "element"], "left_anti").select(*key, "step", "element")


def run_steps(elements: Mapping[str, DataFrame], steps: Sequence[tuple], keep: Collection[str] = ()) -> dict[str, DataFrame]:
    """Apply steps (function, input names, output names) in order; all ROIs are in each plan.

    A function takes DataFrames and returns one, or as many as there are output names. An output that ``keep`` names, or
    that several later steps read, is written to shared storage, so that it is worked out once; the others are part of the
    plan of the step that reads them. A name that is made again stands for the later element from there on.
    """
    if gone := set(keep) - {o for _, _, outputs in steps for o in outputs}:
        raise ValueError(f"no step makes {sorted(gone)}")
    known = dict(elements)
    for at, (fn, inputs, outputs) in enumerate(steps):
        if gone := [i for i in inputs if i not in known]:
            raise ValueError(f"no element {gone}")
        made = fn(*[known[i] for i in inputs])
        made = [made] if isinstance(made, DataFrame) else list(made)
        if len(made) != len(outputs):
            raise ValueError(f"{len(made)} results for the names {list(outputs)}")
        for name, df in zip(outputs, made):
            known[name] = stored(df) if name in keep or _readers(name, steps[at + 1 :]) > 1 else df
    return known


def _readers(name: str, steps: Sequence[tuple]) -> int:
    """How many steps read an element before one makes it anew."""
    n = 0
    for _, inputs, outputs in steps:
        n += name in inputs
        if name in outputs:
            break
    return n


def level_check(catalog: DataFrame, level: int, names: list[str]) -> DataFrame:
    """``[slide,] roi, element``: inputs that lack a level (``catalog`` has a row for each level of an element)."""
    key = roi_key(catalog)
    asked = catalog.select(*key).distinct().withColumn("element", F.explode(F.array(*map(F.lit, names))))
    return asked.join(catalog.where(F.col("level") == level).select(*key, "element"), [*key, "element"], "left_anti")
