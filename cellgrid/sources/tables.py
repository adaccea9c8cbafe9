"""Sources and sinks of pixels, ROIs, shapes and object tables.

Pixels are rows ``slide, roi, element, y, x, value``, dense within an element's extent; labels are rows ``slide, roi,
element, y, x, label`` without background. Elements are the catalog ``slide, roi, element, height, width``. Tables that
have no ``slide`` are of one slide. ``level`` is a column where there are several. What is stored is kept by its whole key
in a :class:`~cellgrid.sources.store.Store`.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cellgrid.functions.keys import element_key, roi_key
from cellgrid.sources.store import Store


def list_files(spark: SparkSession, folder: str, glob: str = "*.tif*") -> DataFrame:
    """``path, length`` of a folder's files; contents are not read."""
    return spark.read.format("binaryFile").option("pathGlobFilter", glob).load(folder).select("path", "length")


def image_shape(pixels: DataFrame) -> DataFrame:
    """Height and width of each element."""
    return pixels.groupBy(*element_key(pixels)).agg((F.max("y") + 1).alias("height"), (F.max("x") + 1).alias("width"))


def read_level(pixels: DataFrame, level: int = 0) -> DataFrame:
    """The pixels of one pyramid level."""
    return pixels.where(F.col("level") == level).drop("level")


def levels(pixels: DataFrame) -> DataFrame:
    """The levels of each element, in order."""
    return pixels.groupBy(*element_key(pixels)).agg(F.sort_array(F.collect_set("level")).alias("levels"))


def strided_level(pixels: DataFrame, level: int) -> DataFrame:
    """A level of each element: the stored one, or every 2^k-th pixel of its highest stored level below it."""
    top = pixels.groupBy(*element_key(pixels)).agg(F.max("level").alias("top"))
    key = element_key(pixels)
    own = pixels.join(top, key).where(F.col("level") == F.least("top", F.lit(level)))
    k = F.call_function("shiftleft", F.lit(1), F.greatest(F.lit(level) - F.col("top"), F.lit(0)))
    own = own.withColumn("k", k).where("y % k = 0 and x % k = 0")
    return own.select(*key, F.expr("y div k").cast("int").alias("y"), F.expr("x div k").cast("int").alias("x"), "value")


def project_channel_mean(pixels: DataFrame) -> DataFrame:
    """Elements with a leading axis ``z`` as the mean over it; others as they are."""
    return pixels.groupBy(*element_key(pixels), "y", "x").agg(F.avg("value").alias("value"))


def write_rois(rois: DataFrame, path: str, csv: str | None = None) -> None:
    """Store an ROI table as Parquet, and for reading by eye as CSV with the vertices as JSON."""
    rois.write.mode("overwrite").parquet(path)
    if csv:
        rois.withColumn("polygon_vertices", F.to_json("polygon_vertices")).write.mode("overwrite").csv(csv, header=True)


def read_rois(spark: SparkSession, path: str, level: int = 0) -> DataFrame:
    """A stored ROI table, with coordinates divided by 2**level."""
    k = float(1 << level)
    rois = spark.read.parquet(path)
    scaled = {c: F.col(c) / k for c in ("row_start", "row_stop", "column_start", "column_stop")}
    ring = F.transform("polygon_vertices", lambda v: F.struct((v["row"] / k).alias("row"), (v["col"] / k).alias("col")))
    return rois.withColumns(scaled | {"polygon_vertices": ring})


def swap_axes(ring: Column | str) -> Column:
    """Vertices in (row, col) as (x, y)."""
    return F.transform(ring, lambda v: F.struct(v["col"].cast("double").alias("x"), v["row"].cast("double").alias("y")))


def write_shapes(shapes: DataFrame, path: str, order: str = "xy", layers: Sequence[str] = (), rois: DataFrame | None = None) -> None:
    """Store polygons by ROI and shape key; ``order="yx"`` takes (row, col) vertices.

    The shapes of an ROI and key that are stored already are replaced, all others stay. ``layers`` (shape keys) that have no
    shapes any more are deleted: those of the ROIs in ``rois``, or of all.
    """
    if order == "yx":
        shapes = shapes.withColumn("ring", swap_axes("ring"))
    store = Store(shapes.sparkSession, path, [*roi_key(shapes), "shape_key"])
    drop = store.keys()
    if drop is not None:
        drop = drop.where(F.col("shape_key").isin(*layers)) if layers else drop.limit(0)
        if rois is not None:
            drop = drop.join(rois.select(*roi_key(shapes)).distinct(), roi_key(shapes), "left_semi")
    store.write(shapes, overwrite=True, drop=drop)


def write_element(df: DataFrame, path: str, overwrite: bool = False, tile: int = 512) -> None:
    """Store elements by slide, ROI and name (and level), in tiles. Without ``overwrite`` one that is there already is an error."""
    key = [*element_key(df), *(["level"] if "level" in df.columns else [])]
    Store(df.sparkSession, path, key, tile).write(df, overwrite)


def write_table(df: DataFrame, path: str, name: str, overwrite: bool = False) -> None:
    """Store an object table under its name, by slide and ROI; the same policy as for elements. It may be made from the one it replaces."""
    Store(df.sparkSession, path, ["table_name", *roi_key(df)]).write(df.withColumn("table_name", F.lit(name)), overwrite)


def read_stored(spark: SparkSession, path: str, where: Mapping[str, object] | None = None, tiles: Sequence[tuple[int, int]] | None = None) -> DataFrame:
    """What the sinks have stored: all, or the keys that ``where`` names (and some ``tiles`` of them), from as few files as hold them."""
    return Store.open(spark, path).read(where, tiles)


def tile_index(pixels: DataFrame, tile: int = 512) -> DataFrame:
    """Pixels with the tile that holds them."""
    return pixels.withColumns({"tile_y": F.floor(F.col("y") / tile).cast("int"), "tile_x": F.floor(F.col("x") / tile).cast("int")})


def assemble_rois(cut: DataFrame, path: str, expected: DataFrame | None = None, allowed: list[str] | None = None, tile: int = 512) -> None:
    """Store cut pixels as one table by slide, ROI and element, in tiles. An expected ROI without pixels is an error.

    ROIs that are stored already are replaced, those of other slides stay, whatever their names.
    """
    if allowed is not None:
        cut = cut.where(F.col("element").isin(allowed))
    if expected is not None:
        key = roi_key(cut, expected)
        if gone := expected.select(*key).distinct().join(cut.select(*key), key, "left_anti").head():
            raise ValueError(f"no pixels for {' '.join(gone)}")
    write_element(cut, path, overwrite=True, tile=tile)
