"""One query for each operator over images, masks, ROIs and file lists made from the driver tables, with DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cellgrid.functions import geometry
from cellgrid.operators import channels, cut, enhance, intensity, masks, objects, regions, rois, segment
from cellgrid.plans import quantify as plan
from cellgrid.sources import fixtures as fx
from cellgrid.sources import storage, tables
from cellgrid.streaming import arrivals

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}

# ---- the inputs as DuckDB views

VIEWS = {
    "image": "SELECT 'R0' AS roi, event_type AS element, user_id::INT AS y, ((day(ts) - 1) * 24 + hour(ts))::INT AS x, sum(round(value * 100)::BIGINT)::DOUBLE AS value FROM events GROUP BY ALL",
    "extent": "SELECT DISTINCT 'R0' AS roi, event_type AS element, (SELECT max(user_id) + 1 FROM events)::INT AS height, 720::INT AS width FROM events",
    "dense": "SELECT roi, element, y, x, coalesce(value, 0.0) AS value FROM (SELECT * FROM (SELECT roi, element, unnest(range(height))::INT AS y FROM extent), (SELECT unnest(range(720))::INT AS x)) LEFT JOIN image USING (roi, element, y, x)",
    "emb": "SELECT 'R0' AS roi, 'emb' AS element, vec_id::INT AS y, (i - 1)::INT AS x, round(embedding[i]::DOUBLE * 10000) + 0.0 AS value FROM (SELECT vec_id, embedding, unnest(generate_series(1, len(embedding))) AS i FROM embeddings)",
    "grid": "SELECT y::INT AS y, x::INT AS x, ((y // 10) * 30 + x // 24 + 1)::INT AS label, 4 * (y % 10 - 5) * (y % 10 - 5) + (x % 24 - 12) * (x % 24 - 12) AS d FROM (SELECT unnest(range((SELECT max(user_id) + 1 FROM events))) AS y), (SELECT unnest(range(720)) AS x)",
    "fine": "SELECT roi, element, y, x, value + (y * 7 + x * 13) % 101 AS value FROM dense",
    "cell": "SELECT 'R0' AS roi, 'cell' AS element, y, x, label FROM grid WHERE d <= 90",
    "nucleus": "SELECT 'R0' AS roi, 'nucleus' AS element, y, x, label FROM grid WHERE d <= 30 AND label % 7 <> 0",
    "labels_": "SELECT * FROM cell UNION ALL SELECT * FROM nucleus",
    "files": "SELECT p_partkey AS ordinal, CASE WHEN p_partkey % 11 = 0 THEN 'junk_' || p_partkey || '.tif' ELSE 'img/S1_' || (p_size % 5 + 1) || '.0.4_R000_' || CASE WHEN p_partkey % 4 = 0 THEN 'dapi_' ELSE 'Cy3_' END || replace(p_brand, '#', '') || '-' || p_type || '_F.ome.tif' END AS path FROM part",
    "parsed0": "SELECT ordinal, path, regexp_extract(path, '[^/]+$') AS base FROM files",
    "parsed": "SELECT ordinal, path, round, marker, printf('%03d', round) || '_' || marker AS channel FROM (SELECT ordinal, path, regexp_extract(base, '^[^_]+_([0-9]+)\\.0\\.4_R000_', 1)::INT AS round, CASE WHEN upper(string_split(base, '_')[4]) LIKE '%DAPI%' THEN 'DAPI' ELSE regexp_replace(string_split(base, '_')[5], '-[^-]*$', '') END AS marker FROM parsed0 WHERE regexp_matches(base, '^[^_]+_[0-9]+\\.0\\.4_R000_[^_]+_.*\\.tiff?'))",
    "deduped": "SELECT * FROM parsed QUALIFY row_number() OVER (PARTITION BY channel ORDER BY ordinal DESC) = 1",
    "slide_extent": "SELECT 'S' || k AS slide, element, least(8, h - 8 * k)::INT AS height, 720::INT AS width FROM (SELECT element, height AS h, unnest(range((height + 7) // 8)) AS k FROM extent)",
    "slide_dense": "SELECT 'S' || (y // 8) AS slide, element, (y % 8)::INT AS y, x, value FROM dense",
    "catalog": "SELECT DISTINCT o_custkey::VARCHAR AS roi, o_orderpriority AS element, (o_orderkey % 3)::INT AS level FROM orders",
    "candidates": """SELECT 'S' || (o_custkey // 100 % (SELECT (max(height) + 7) // 8 FROM extent)) AS slide, o_orderkey AS ordinal, (o_custkey * 7 % 2000)::INT AS x, (o_orderkey * 13 % 2000)::INT AS y, (20 + o_orderkey % 60)::INT AS w, (20 + o_custkey % 60)::INT AS h, (o_orderkey * 37 % 1000) / 1000.0::DOUBLE AS predicted_iou, (o_orderkey * 53 % 1000) / 1000.0::DOUBLE AS stability_score FROM orders""",
    "rois": """SELECT 'S' || (s_suppkey % (SELECT (max(height) + 7) // 8 FROM extent)) AS slide, 'ROI_' || lpad((s_suppkey // (SELECT (max(height) + 7) // 8 FROM extent))::VARCHAR, 3, '0') AS roi, (s_suppkey % 4)::INT AS row_start, (s_suppkey % 4 + 5)::INT AS row_stop, (s_suppkey * 37 % 680)::INT AS column_start, (s_suppkey * 37 % 680 + 60)::INT AS column_stop, CASE WHEN s_suppkey % 4 = 3 THEN 'polygon' ELSE 'rectangle' END AS poly_type FROM supplier""",
    "windows": """SELECT r.*, e.element, e.height, greatest(0, row_start - 2) AS y0, least(height, row_stop + 2) AS y1, greatest(0, column_start - 2) AS x0, least(width, column_stop + 2) AS x1 FROM rois r JOIN slide_extent e ON e.slide = r.slide""",
    "shape0": "SELECT n_nationkey AS shape_id, 'qc_exclude_' || ns[(n_nationkey % len(ns) + 1)::INT] AS shape_key, (n_nationkey % 5 * 144 + 10)::DOUBLE AS x0, (n_nationkey % 7 * 20 + 5)::DOUBLE AS y0, (40 + 3 * n_nationkey)::DOUBLE AS w, (10 + n_nationkey % 9)::DOUBLE AS h FROM nation, (SELECT list_sort(list(DISTINCT event_type)) AS ns FROM events)",
    "edges": "SELECT shape_id, shape_key, unnest([{'ax': x0, 'ay': y0, 'bx': x0 + w, 'by': y0 + 3}, {'ax': x0 + w, 'ay': y0 + 3, 'bx': x0 + w - 8, 'by': y0 + h + 3}, {'ax': x0 + w - 8, 'ay': y0 + h + 3, 'bx': x0 + 4, 'by': y0 + h}, {'ax': x0 + 4, 'ay': y0 + h, 'bx': x0, 'by': y0}]) AS e FROM shape0",
    "centroids": "SELECT roi, label, avg(x) AS px, avg(y) AS py FROM cell GROUP BY roi, label",
    "hits": "SELECT DISTINCT roi, label, shape_key FROM (SELECT roi, label, shape_key, shape_id, sum(((e.ay > py) <> (e.by > py) AND CASE WHEN e.by > e.ay THEN (e.bx - e.ax) * (py - e.ay) - (e.by - e.ay) * (px - e.ax) > 0 ELSE (e.bx - e.ax) * (py - e.ay) - (e.by - e.ay) * (px - e.ax) < 0 END)::INT) AS crossings, max(((e.bx - e.ax) * (py - e.ay) = (e.by - e.ay) * (px - e.ax) AND px BETWEEN least(e.ax, e.bx) AND greatest(e.ax, e.bx) AND py BETWEEN least(e.ay, e.by) AND greatest(e.ay, e.by))::INT) AS on_edge FROM centroids, edges GROUP BY ALL) WHERE crossings % 2 = 1 OR on_edge = 1",
    "stats": "SELECT roi, l.element AS mask, i.element AS channel, label, avg(value) AS mean, median(value) AS median, min(value) AS min, max(value) AS max, sum(value) AS sum, stddev_pop(value) AS std FROM labels_ l JOIN dense i USING (roi, y, x) GROUP BY ALL",
    "mom": "SELECT roi, element AS mask, label, count(*) AS n, sum(y::BIGINT)::BIGINT AS sy, sum(x::BIGINT)::BIGINT AS sx, sum(y::BIGINT * y)::BIGINT AS syy, sum(x::BIGINT * x)::BIGINT AS sxx, sum(x::BIGINT * y)::BIGINT AS sxy, min(y) AS y0, min(x) AS x0, max(y) + 1 AS y1, max(x) + 1 AS x1 FROM labels_ GROUP BY ALL",
    "axes": "SELECT *, CASE WHEN xx = yy AND xy = 0 THEN pi() / 4 ELSE pi() / 2 - 0.5 * atan2(2 * xy, xx - yy) END AS turn, (yy + xx + sqrt((yy - xx) * (yy - xx) + 4 * xy * xy)) / 2 AS l1, greatest((yy + xx - sqrt((yy - xx) * (yy - xx) + 4 * xy * xy)) / 2, 0.0) AS l2 FROM (SELECT *, (syy * n - sy * sy) / (n * n)::DOUBLE AS yy, (sxx * n - sx * sx) / (n * n)::DOUBLE AS xx, (sxy * n - sy * sx) / (n * n)::DOUBLE AS xy FROM mom)",
}


def _with(sql: str) -> str:
    """The statement with the views it uses, in order."""
    import re

    used: set[str] = set()
    todo = [sql]
    while todo:
        text = todo.pop()
        for name, body in VIEWS.items():
            if name not in used and re.search(rf"\b{name}\b", text):
                used.add(name)
                todo.append(body)
    views = ", ".join(f"{n} AS ({VIEWS[n]})" for n in VIEWS if n in used)
    if sql.lstrip().startswith("WITH "):
        return f"WITH RECURSIVE {views}, {sql.lstrip()[5:]}" if views else sql
    return f"WITH RECURSIVE {views} {sql}" if views else sql


def query(name: str, sql: str | None = None):
    """Register a query, with the SQL that gives its rows."""

    def add(f: Callable[[SparkSession, str], DataFrame]):
        QUERIES[name] = f
        if sql:
            SQL[name] = _with(sql)
        return f

    return add


def both_masks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fx.mask(spark, sf_dir).unionByName(fx.mask(spark, sf_dir, nucleus=True))


def frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fx.extent(spark, sf_dir).select("roi", "height", "width").distinct()


def _rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Doubles rounded, with no negative zero."""
    return df.select(*[(F.round(F.col(f"`{c}`"), digits) + 0.0).alias(c) if t == "double" else F.col(f"`{c}`") for c, t in df.dtypes])


# ---- sources and sinks


@query("list_files", "SELECT replace(p_brand, '#', '') AS folder, 1::BIGINT AS files, true AS filled FROM part GROUP BY p_brand")
def list_files(spark, d):
    """Parts are written as a file for each brand, and the files listed."""
    parts = spark.read.parquet(f"{d}/part.parquet").withColumn("brand", F.regexp_replace("p_brand", "#", ""))
    parts.repartition("brand").write.partitionBy("brand").parquet(path := storage.shared_dir(spark))
    found = tables.list_files(spark, path, "*.parquet").withColumn("folder", F.regexp_extract("path", "brand=([^/]+)/", 1))
    return found.groupBy("folder").agg(F.count("*").alias("files"), (F.min("length") > 0).alias("filled"))


@query("image_shape", "SELECT roi, element, max(y) + 1 AS height, max(x) + 1 AS width FROM dense GROUP BY ALL")
def image_shape(spark, d):
    return tables.image_shape(fx.dense_image(spark, d))


_PYRAMID = "SELECT roi, element, l::INT AS level, (y // (2 ** l)::INT)::INT AS y, (x // (2 ** l)::INT)::INT AS x, avg(value) AS value FROM dense, (SELECT unnest(range(3)) AS l) GROUP BY ALL"


@query("read_level", f"SELECT roi, element, y, x, value FROM ({_PYRAMID}) WHERE level = 1")
def read_level(spark, d):
    return tables.read_level(cut.pyramid(fx.dense_image(spark, d), 3), 1)


@query("levels", "SELECT roi, element, string_agg(level, ',' ORDER BY level) AS levels FROM catalog GROUP BY ALL")
def levels(spark, d):
    return tables.levels(fx.orders_catalog(spark, d)).withColumn("levels", F.array_join("levels", ","))


@query("strided_level", "SELECT roi, element, (y // 4)::INT AS y, (x // 4)::INT AS x, value FROM dense WHERE y % 4 = 0 AND x % 4 = 0")
def strided_level(spark, d):
    return tables.strided_level(fx.dense_image(spark, d).withColumn("level", F.lit(0)), 2)


@query("project_channel_mean", "SELECT roi, 'all' AS element, y, x, avg(value) AS value FROM dense GROUP BY ALL")
def project_channel_mean(spark, d):
    return tables.project_channel_mean(fx.dense_image(spark, d).withColumns({"z": F.col("element"), "element": F.lit("all")}))


@query("roi_roundtrip", "SELECT slide, roi, row_start / 2.0::DOUBLE AS row_start, row_stop / 2.0::DOUBLE AS row_stop, column_start / 2.0::DOUBLE AS column_start, column_stop / 2.0::DOUBLE AS column_stop, poly_type FROM rois")
def roi_roundtrip(spark, d):
    tables.write_rois(fx.rois(spark, d), path := storage.shared_dir(spark), f"{path}-csv")
    assert spark.read.csv(f"{path}-csv", header=True).columns == fx.rois(spark, d).columns
    return tables.read_rois(spark, path, 1).drop("polygon_vertices")


@query("shape_swap", "SELECT slide, roi, poly_type AS shape_key, row_start::DOUBLE AS first_y, column_start::DOUBLE AS first_x, 3 AS n FROM rois WHERE slide <> 'S0' OR poly_type = 'rectangle'")
def shape_swap(spark, d):
    """Shapes are stored by ROI and layer, and a layer of one slide is emptied again."""
    ring = fx.rois(spark, d).select("slide", "roi", F.col("poly_type").alias("shape_key"), F.col("polygon_vertices").alias("ring"))
    tables.write_shapes(ring, path := storage.shared_dir(spark), order="yx")
    tables.write_shapes(ring.limit(0), path, order="yx", layers=["polygon"], rois=ring.where("slide = 'S0'"))
    back = tables.read_stored(spark, path)
    return back.select("slide", "roi", "shape_key", F.col("ring")[0]["y"].alias("first_y"), F.col("ring")[0]["x"].alias("first_x"), F.size("ring").alias("n"))


@query("element_sink", "SELECT slide, element, y, x, CASE WHEN element = 'click' THEN 1.0 ELSE value END AS value, 'R0' AS roi FROM slide_dense WHERE value > 0")
def element_sink(spark, d):
    """Elements of all slides under one ROI name; those of one channel are replaced."""
    image = fx.slide_image(spark, d).where("value > 0").withColumn("roi", F.lit("R0"))
    tables.write_element(image, path := storage.shared_dir(spark), tile=64)
    tables.write_element(image.where("element = 'click'").withColumn("value", F.lit(1.0)), path, overwrite=True, tile=64)
    return tables.read_stored(spark, path)


@query("element_tile", "SELECT slide, element, y, x, value, 'R0' AS roi FROM slide_dense WHERE value > 0 AND slide = 'S1' AND element = 'view' AND x // 64 = 3")
def element_tile(spark, d):
    """One tile of one element of one slide."""
    image = fx.slide_image(spark, d).where("value > 0").withColumn("roi", F.lit("R0"))
    tables.write_element(image, path := storage.shared_dir(spark), tile=64)
    return tables.read_stored(spark, path, {"slide": "S1", "element": "view"}, tiles=[(0, 3)])


@query("table_sink", "SELECT roi, mask, channel, label, mean FROM stats")
def table_sink(spark, d):
    tables.write_table(intensity.intensity(fx.dense_image(spark, d), both_masks(spark, d), ["mean"]), path := storage.shared_dir(spark), "stats")
    return tables.read_stored(spark, path, {"table_name": "stats"}).select("roi", "mask", "channel", "label", "mean")


@query("assemble_rois", "SELECT w.slide, w.roi, w.element, count(*) AS n, sum(value) AS total FROM windows w JOIN slide_dense i ON w.slide = i.slide AND w.element = i.element AND y >= row_start AND y < least(height, row_stop) AND x >= column_start AND x < column_stop GROUP BY ALL")
def assemble_rois(spark, d):
    """Slides are stored in two turns, with the same names of ROIs."""
    roi = fx.rois(spark, d).withColumn("poly_type", F.lit("rectangle"))
    path, first = storage.shared_dir(spark), F.col("slide").isin("S0", "S1")
    for mine in (first, ~first):
        tables.assemble_rois(cut.cut(fx.slide_image(spark, d).where(mine), roi.where(mine), fx.slide_extent(spark, d).where(mine)), path, expected=roi.where(mine))
    return tables.read_stored(spark, path).groupBy("slide", "roi", "element").agg(F.count("*").alias("n"), F.sum("value").alias("total"))


@query("tile_index", "SELECT roi, element, y, x, value, (y // 64)::INT AS tile_y, (x // 64)::INT AS tile_x FROM image")
def tile_index(spark, d):
    return tables.tile_index(fx.image(spark, d), 64)


# ---- channels


@query("channel_parse", "SELECT * FROM parsed")
def channel_parse(spark, d):
    return channels.parse_channels(fx.files(spark, d))


@query("channel_dedupe", "SELECT * FROM deduped")
def channel_dedupe(spark, d):
    return channels.dedupe_channels(channel_parse(spark, d))


_LATEST = "SELECT marker, arg_max(channel, round) AS channel, max(round) AS round, arg_max(path, round) AS path FROM {} GROUP BY marker"
_DAPI = "(SELECT * FROM deduped WHERE upper(marker) <> 'DAPI' OR channel = '001_DAPI')"
_CHOSEN = "(SELECT * FROM deduped WHERE round = 2)"
_SELECT = f"WITH chosen AS ({_LATEST.format(_CHOSEN)}), rest AS ({_LATEST.format(_DAPI)}), selected AS (SELECT * FROM chosen UNION ALL SELECT * FROM rest WHERE marker NOT IN (SELECT marker FROM chosen)) "


def _second_round(spark, d):
    """The channels of one round."""
    return channel_dedupe(spark, d).where("round = 2").select("channel")


@query("channel_latest", _LATEST.format(_DAPI))
def channel_latest(spark, d):
    return channels.select_channels(channel_parse(spark, d))


@query("channel_include", _SELECT + "SELECT * FROM selected")
def channel_include(spark, d):
    return channels.select_channels(channel_parse(spark, d), include=_second_round(spark, d))


@query("channel_exclude", _LATEST.format("(SELECT * FROM deduped WHERE (upper(marker) <> 'DAPI' OR channel = '001_DAPI') AND round <> 2)"))
def channel_exclude(spark, d):
    return channels.select_channels(channel_parse(spark, d), exclude=_second_round(spark, d))


@query("channel_markers", f"SELECT * FROM ({_LATEST.format(_DAPI)}) WHERE marker IN ('DAPI', 'Brand11', 'Brand12', 'Brand13') AND marker <> 'Brand12'")
def channel_markers(spark, d):
    return channels.select_channels(channel_parse(spark, d), use=["DAPI", "Brand11", "Brand12", "Brand13"], ignore=["Brand12"])


@query("channel_unused", f"SELECT * FROM parsed WHERE path NOT IN (SELECT path FROM ({_LATEST.format(_DAPI)}))")
def channel_unused(spark, d):
    return channels.unused_files(channel_parse(spark, d), channel_latest(spark, d)).select("ordinal", "path", "round", "marker", "channel")


@query("channels_missing", f"SELECT * FROM ({_LATEST.format(_DAPI)}) WHERE path NOT IN (SELECT path FROM files WHERE ordinal % 3 > 0)")
def channels_missing(spark, d):
    return channels.missing_channels(channel_latest(spark, d), fx.files(spark, d).where("ordinal % 3 > 0")).select("marker", "channel", "round", "path")


@query("channel_unknown", "SELECT marker FROM (SELECT 'Brand' || p_brand_ AS marker FROM (SELECT DISTINCT p_partkey % 90 AS p_brand_ FROM part)) WHERE marker NOT IN (SELECT marker FROM parsed)")
def channel_unknown(spark, d):
    asked = spark.read.parquet(f"{d}/part.parquet").select(F.concat(F.lit("Brand"), (F.col("p_partkey") % 90).cast("string")).alias("marker"))
    return channels.unknown_markers(channel_parse(spark, d), asked)


# ---- ROI candidates

_GOOD = "SELECT * FROM candidates WHERE w * h > 1000 AND w * h < 4000 AND predicted_iou > 0.2 AND stability_score > 0.3"


@query("roi_threshold", _GOOD)
def roi_threshold(spark, d):
    return rois.filter_candidates(fx.candidates(spark, d), 1000, 4000, 0.2, 0.3)


_MEANS = "SELECT slide, cand_id, avg(value) AS mean_int FROM (SELECT slide, ordinal AS cand_id, (y * 8 // 2000 + d // 3)::INT AS y, (x * 720 // 2000 + d % 3)::INT AS x FROM (SELECT *, unnest(range(9)) AS d FROM candidates)) JOIN slide_dense i USING (slide, y, x) WHERE element = 'click' GROUP BY ALL HAVING avg(value) > 5"


def _bright_ones(spark, d):
    return rois.mask_intensity(fx.candidate_masks(spark, d), fx.slide_image(spark, d).where("element = 'click'"), 5)


@query("roi_mask_intensity", f"SELECT slide, cand_id, round(mean_int, 6) AS mean_int FROM ({_MEANS})")
def roi_mask_intensity(spark, d):
    return _rounded(_bright_ones(spark, d))


_PAIRS = "SELECT a.slide, a.ordinal AS a, b.ordinal AS b FROM candidates a JOIN candidates b ON a.slide = b.slide AND a.ordinal < b.ordinal AND a.x < b.x + b.w AND b.x < a.x + a.w AND a.y < b.y + b.h AND b.y < a.y + a.h"


@query("bbox_overlap", "SELECT a.slide, a.ordinal AS a, (SELECT count(*) FROM candidates b WHERE b.slide = a.slide AND b.ordinal <> a.ordinal AND a.x < b.x + b.w AND b.x < a.x + a.w AND a.y < b.y + b.h AND b.y < a.y + a.h) AS overlaps FROM candidates a")
def bbox_overlap(spark, d):
    """How many boxes each overlaps."""
    c = fx.candidates(spark, d)
    pairs = rois.overlap_pairs(c)
    found = pairs.unionByName(pairs.select("slide", F.col("b").alias("a"), F.col("a").alias("b"))).groupBy("slide", "a").agg(F.count("*").alias("n"))
    return c.select("slide", F.col("ordinal").alias("a")).join(found, ["slide", "a"], "left").select("slide", "a", F.coalesce("n", F.lit(0)).cast("bigint").alias("overlaps"))


@query("bbox_overlap_pairs", _PAIRS)
def bbox_overlap_pairs(spark, d):
    return rois.overlap_pairs(fx.candidates(spark, d))


def _suppressed(boxes: str, columns: str) -> str:
    """Suppression in rounds: a box falls to a kept one of higher rank, and stays once all of those have fallen."""
    return f"""WITH boxes AS MATERIALIZED ({boxes}),
ranks AS MATERIALIZED (SELECT a.slide, a.ordinal AS hi, b.ordinal AS lo FROM boxes a JOIN boxes b ON a.slide = b.slide AND (a.predicted_iou > b.predicted_iou OR (a.predicted_iou = b.predicted_iou AND a.ordinal < b.ordinal)) AND a.x < b.x + b.w AND b.x < a.x + a.w AND a.y < b.y + b.h AND b.y < a.y + a.h),
rounds AS (SELECT 0 AS r, slide, ordinal, 0 AS state FROM boxes
  UNION ALL
  SELECT s.r + 1, s.slide, s.ordinal, CASE WHEN any_value(s.state) <> 0 THEN any_value(s.state) WHEN coalesce(bool_or(t.state = 1), false) THEN 2 WHEN coalesce(bool_or(t.state = 0), false) THEN 0 ELSE 1 END
  FROM rounds s LEFT JOIN ranks k ON k.slide = s.slide AND k.lo = s.ordinal LEFT JOIN rounds t ON t.slide = k.slide AND t.ordinal = k.hi
  WHERE EXISTS (SELECT 1 FROM rounds WHERE state = 0) GROUP BY s.r, s.slide, s.ordinal)
SELECT {columns} FROM boxes JOIN rounds USING (slide, ordinal) WHERE state = 1 AND r = (SELECT max(r) FROM rounds)"""


@query("roi_nms", _suppressed("SELECT * FROM candidates", "boxes.*"))
def roi_nms(spark, d):
    return rois.nms(fx.candidates(spark, d))


@query("roi_refine", _suppressed(f"SELECT c.* FROM ({_GOOD}) c JOIN ({_MEANS}) m ON m.slide = c.slide AND m.cand_id = c.ordinal", "slide, ordinal, y::DOUBLE AS top, x::DOUBLE AS left_, (y + h)::DOUBLE AS bottom, (x + w)::DOUBLE AS right_"))
def roi_refine(spark, d):
    out = rois.refine(fx.candidates(spark, d), 1000, 4000, 0.2, 0.3, _bright_ones(spark, d))
    return out.select("slide", "ordinal", F.col("ring")[0]["row"].alias("top"), F.col("ring")[0]["col"].alias("left_"), F.col("ring")[2]["row"].alias("bottom"), F.col("ring")[2]["col"].alias("right_"))


@query("bbox_corners", "SELECT slide, ordinal, y::DOUBLE AS top, x::DOUBLE AS left_, (y + h)::DOUBLE AS bottom, (x + w)::DOUBLE AS right_ FROM candidates")
def bbox_corners(spark, d):
    c = fx.candidates(spark, d).withColumn("r", geometry.corners(*[F.col(n) for n in "xywh"]))
    return c.select("slide", "ordinal", F.col("r")[0]["row"].alias("top"), F.col("r")[0]["col"].alias("left_"), F.col("r")[2]["row"].alias("bottom"), F.col("r")[2]["col"].alias("right_"))


@query("polygon_bbox", "SELECT slide, ordinal, y AS row_start, y + h AS row_stop, x AS column_start, x + w AS column_stop FROM candidates")
def polygon_bbox(spark, d):
    c = fx.candidates(spark, d).withColumn("b", geometry.polygon_bbox(geometry.corners(*[F.col(n) for n in "xywh"])))
    return c.select("slide", "ordinal", "b.*")


@query("polygon_rescale", "SELECT slide, ordinal, floor(y / 3.0)::DOUBLE * 4 AS first_row, floor((x + w) / 3.0)::DOUBLE * 4 AS second_col FROM candidates")
def polygon_rescale(spark, d):
    c = fx.candidates(spark, d).withColumn("r", geometry.rescale(geometry.corners(*[F.col(n) / 3 for n in "xywh"]), 2))
    return c.select("slide", "ordinal", F.col("r")[0]["row"].alias("first_row"), F.col("r")[1]["col"].alias("second_col"))


_BUILT = "SELECT slide, ordinal, y * 4 AS r0, least(3000, (y + h) * 4) AS r1, x * 4 AS c0, least(5000, (x + w) * 4) AS c1 FROM candidates WHERE y * 4 < 3000 AND x * 4 < 5000"
_PLACED = f"SELECT *, row_number() OVER (PARTITION BY slide ORDER BY round_even(r0 / 2.0, -3), round_even(c0 / 2.0, -3), ordinal) - 1 AS place FROM ({_BUILT})"


def _polys(spark, d):
    return fx.candidates(spark, d).select("slide", "ordinal", geometry.corners(*[F.col(n) for n in "xywh"]).alias("ring"))


@query("polygon_clip", f"SELECT slide, ordinal, r0::INT AS row_start, r1::INT AS row_stop, c0::INT AS column_start, c1::INT AS column_stop FROM ({_BUILT})")
def polygon_clip(spark, d):
    full = _polys(spark, d).withColumn("ring", geometry.rescale(F.col("ring"), 2))
    return rois.clip_polygons(full, 3000, 5000).select("slide", "ordinal", geometry.polygon_bbox(F.col("ring")).alias("b")).select("slide", "ordinal", "b.*")


_LEGS = "SELECT slide, ordinal, y + h AS bottom, x AS c0, x + w // 3 AS c1 FROM candidates UNION ALL SELECT slide, ordinal, y + h, x + w - w // 3, x + w FROM candidates"


@query("polygon_parts", f"SELECT slide, ordinal, 0 AS row_start, least(1000, bottom)::INT AS row_stop, c0::INT AS column_start, least(1500, c1)::INT AS column_stop FROM ({_LEGS}) WHERE c0 < 1500")
def polygon_parts(spark, d):
    """Boxes as arches whose crown lies above the frame, which leaves two legs of each."""
    at = lambda r, c: f"struct(double({r}) as row, double({c}) as col)"
    outline = [("-9", "x"), ("y + h", "x"), ("y + h", "x + w div 3"), ("-3", "x + w div 3"), ("-3", "x + w - w div 3"), ("y + h", "x + w - w div 3"), ("y + h", "x + w"), ("-9", "x + w")]
    arches = fx.candidates(spark, d).selectExpr("slide", "ordinal", f"array({', '.join(at(*v) for v in outline)}) as ring")
    return rois.clip_polygons(arches, 1000, 1500).select("slide", "ordinal", geometry.polygon_bbox(F.col("ring")).alias("b")).select("slide", "ordinal", "b.*")


@query("roi_sort", f"SELECT slide, ordinal, place::INT AS place FROM ({_PLACED})")
def roi_sort(spark, d):
    return rois.order_rois(rois.build_rois(_polys(spark, d), 3000, 5000, 2).drop("roi")).select("slide", "ordinal", "place")


@query("roi_name", f"SELECT slide, ordinal, printf('ROI_%03d', place) AS roi FROM ({_PLACED})")
def roi_name(spark, d):
    return rois.build_rois(_polys(spark, d), 3000, 5000, 2).select("slide", "ordinal", "roi")


@query("roi_build", f"SELECT slide, ordinal, printf('ROI_%03d', place) AS roi, r0::INT AS row_start, r1::INT AS row_stop, c0::INT AS column_start, c1::INT AS column_stop FROM ({_PLACED})")
def roi_build(spark, d):
    return rois.build_rois(_polys(spark, d), 3000, 5000, 2).drop("ring").select("slide", "ordinal", "roi", "row_start", "row_stop", "column_start", "column_stop")


@query("roi_visual", "SELECT slide, roi, row_start // 4 AS top, column_start // 4 AS left_, row_stop // 4 AS bottom, column_stop // 4 AS right_ FROM rois")
def roi_visual(spark, d):
    v = rois.visual_rois(fx.rois(spark, d), 2)
    return v.select("slide", "roi", F.col("ring")[0]["row"].alias("top"), F.col("ring")[0]["col"].alias("left_"), F.col("ring")[2]["row"].alias("bottom"), F.col("ring")[2]["col"].alias("right_"))


@query("rgb_stretch", "SELECT roi, element, y, x, floor(least(greatest((value - lo) / (hi - lo), 0.0), 1.0) * 255)::INT AS red FROM dense JOIN (SELECT roi, element, min(value) AS lo, max(value) AS hi FROM dense GROUP BY ALL) USING (roi, element)")
def rgb_stretch(spark, d):
    return rois.rgb_stretch(fx.dense_image(spark, d)).select("roi", "element", "y", "x", F.col("rgb")[0].alias("red"))


@query("roi_thresholds_auto", "SELECT roi, element, 2 * floor(greatest(max(y) + 1, max(x) + 1) / 50.0)::INT AS density, (0.75 * 50 / 2) * (0.75 * 50 / 2)::DOUBLE AS min_area, (1.25 * 50 / 2) * (1.25 * 50 / 2)::DOUBLE AS max_area, round(avg(value), 6) AS min_int FROM dense GROUP BY ALL")
def roi_thresholds_auto(spark, d):
    return _rounded(rois.auto_thresholds(fx.dense_image(spark, d), 50.0, 1))


# ---- cutting and pyramids


@query("cut_window", "SELECT slide, roi, element, y0, y1, x0, x1 FROM windows")
def cut_window(spark, d):
    return cut.cut_window(fx.rois(spark, d), fx.slide_extent(spark, d), 2).select("slide", "roi", "element", "y0", "y1", "x0", "x1")


_CUT = "SELECT w.slide, w.roi, w.element, (y - y0)::INT AS y, (x - x0)::INT AS x, {} AS value FROM windows w JOIN slide_dense i ON w.slide = i.slide AND w.element = i.element AND y >= y0 AND y < y1 AND x >= x0 AND x < x1"


@query("cut_rectangle", _CUT.format("value") + " WHERE poly_type = 'rectangle'")
def cut_rectangle(spark, d):
    return cut.cut(fx.slide_image(spark, d), fx.rois(spark, d).where("poly_type = 'rectangle'"), fx.slide_extent(spark, d), 2)


# the triangle's right angle is its top left corner: under the slanted edge, edges included
_TRIANGLE = "CASE WHEN poly_type = 'rectangle' OR (y >= row_start AND x >= column_start AND (y - row_start) * (column_stop - 1 - column_start) + (x - column_start) * (row_stop - 1 - row_start) <= (column_stop - 1 - column_start) * (row_stop - 1 - row_start)) THEN value ELSE -1.0 END"


@query("cut_polygon", _CUT.format(_TRIANGLE) + " WHERE poly_type = 'polygon'")
def cut_polygon(spark, d):
    return cut.cut(fx.slide_image(spark, d), fx.rois(spark, d).where("poly_type = 'polygon'"), fx.slide_extent(spark, d), 2, -1.0)


@query("cut_all", _CUT.format(_TRIANGLE) + " WHERE w.element IN ('click', 'view')")
def cut_all(spark, d):
    named = fx.slide_extent(spark, d).where("element in ('click', 'view')")
    return cut.cut_all(fx.slide_image(spark, d), named, fx.rois(spark, d), fx.slide_extent(spark, d), 2, -1.0)


@query("pyramid_image", _PYRAMID)
def pyramid_image(spark, d):
    return cut.pyramid(fx.dense_image(spark, d), 3)


@query("pyramid_labels", "SELECT roi, element, l::INT AS level, (y // (2 ** l)::INT)::INT AS y, (x // (2 ** l)::INT)::INT AS x, label FROM cell, (SELECT unnest(range(3)) AS l) WHERE y % (2 ** l)::INT = 0 AND x % (2 ** l)::INT = 0")
def pyramid_labels(spark, d):
    return cut.pyramid(fx.mask(spark, d), 3, labels=True)


@query("upsample_nearest", "SELECT roi, element, (y * 2 + dy)::INT AS y, (x * 2 + dx)::INT AS x, label FROM cell, (SELECT unnest(range(2)) AS dy), (SELECT unnest(range(2)) AS dx)")
def upsample_nearest(spark, d):
    return cut.upsample(fx.mask(spark, d), 2)


# ---- enhancement

_NORM = "SELECT roi, element{} AS element, y, x, round(least(greatest((value - lo) / (hi - lo), 0.0), 1.0)::FLOAT::DOUBLE, 6) AS value FROM {} JOIN (SELECT roi, element, quantile_cont(value, 0.05) AS lo, quantile_cont(value, 0.99) AS hi FROM {} GROUP BY ALL) USING (roi, element)"


@query("normalize", _NORM.format("", "emb", "emb"))
def normalize(spark, d):
    out = enhance.normalize(fx.embedded_image(spark, d), 5, 99)
    return out.withColumn("value", F.round(F.col("value").cast("double"), 6))


@query("normalize_fanout", _NORM.format(" || '_norm'", "fine", "fine"))
def normalize_fanout(spark, d):
    """Three channels of dense pixels with another value each, as zeros outnumber events by far."""
    image = fx.dense_image(spark, d).withColumn("value", F.col("value") + (F.col("y") * 7 + F.col("x") * 13) % 101)
    out = enhance.normalize(image, 5, 99, pattern="${input}_norm")
    return out.withColumn("value", F.round(F.col("value").cast("double"), 6))


_DISK = ", ".join(f"({y}, {x})" for y, x, _ in masks.disk(2))


@query("median_denoise", f"SELECT p.roi, p.element, p.y, p.x, median(q.value) AS value FROM emb p, (SELECT max(y) AS my, max(x) AS mx FROM emb), (VALUES {_DISK}) o(dy, dx) JOIN emb q ON q.y = least(greatest(p.y + dy, 0), my) AND q.x = least(greatest(p.x + dx, 0), mx) GROUP BY ALL")
def median_denoise(spark, d):
    image = fx.embedded_image(spark, d)
    return enhance.median_denoise(image, tables.image_shape(image), 2, tile=128)


@query("mean_images", "SELECT roi, 'm' AS element, y, x, avg(value)::FLOAT AS value FROM dense WHERE element IN ('click', 'view') GROUP BY ALL")
def mean_images(spark, d):
    return enhance.mean_of_images(fx.dense_image(spark, d), ["click", "view"], "m")


# ---- masks


@query("mask_subtract", "SELECT 'R0' AS roi, 'difference' AS element, y, x, label FROM grid WHERE d <= 90 AND NOT (d <= 30 AND label % 7 <> 0)")
def mask_subtract(spark, d):
    return masks.subtract(fx.mask(spark, d), fx.mask(spark, d, nucleus=True))


@query("mask_multiply", "SELECT 'R0' AS roi, 'product' AS element, y, x, (label * label)::INT AS label FROM grid WHERE d <= 30 AND label % 7 <> 0")
def mask_multiply(spark, d):
    """Products are 32-bit integers, or 64-bit ones if labels are too many for that."""
    kind = "int" if fx.last_label(spark, d) ** 2 < 1 << 31 else "bigint"
    return masks.multiply(fx.mask(spark, d), fx.mask(spark, d, nucleus=True), kind=kind)


def _disk_sql(radius: float, strict: bool = False) -> str:
    return "(VALUES " + ", ".join(f"({y}, {x}, {k})" for y, x, k in masks.disk(radius, strict)) + ") o(dy, dx, d2)"


def _expanded(radius: float, src: str = "nucleus") -> str:
    near = f"SELECT roi, (y + dy)::INT AS y, (x + dx)::INT AS x, arg_min(label, d2 * 1000000000::BIGINT + label) AS label FROM {src}, {_disk_sql(radius)} GROUP BY ALL"
    return f"SELECT roi, y, x, label FROM {src} UNION ALL SELECT * FROM ({near}) n ANTI JOIN {src} USING (roi, y, x) WHERE y >= 0 AND x >= 0 AND x < 720 AND y < (SELECT max(height) FROM extent)"


# labels follow from their place, so that what lies around a pixel needs no join; h is the height
_PLACES = "(SELECT y, x, label, d, max(y) OVER () + 1 AS h FROM grid)"


def _label_at(y: str, x: str, limit: int = 90, more: str = "true") -> str:
    label, d = f"((({y}) // 10) * 30 + ({x}) // 24 + 1)", f"(4 * (({y}) % 10 - 5) * (({y}) % 10 - 5) + (({x}) % 24 - 12) * (({x}) % 24 - 12))"
    return f"(CASE WHEN {y} < 0 OR {x} < 0 OR {y} >= h OR {x} >= 720 THEN NULL WHEN {d} <= {limit} AND {more.format(label)} THEN {label} ELSE 0 END)"


def _offsets(radius: float, strict: bool = False) -> str:
    return "[" + ", ".join(f"{{'a': {y}, 'b': {x}, 'd2': {k}::BIGINT}}" for y, x, k in masks.disk(radius, strict)) + "]"


def _near(radius: float) -> str:
    """The label of the nearest nucleus within a radius, null if there is none."""
    label = _label_at("y + o.a", "x + o.b", 30, "{} % 7 <> 0")
    return f"(list_min(list_transform({_offsets(radius)}, lambda o: CASE WHEN {label} > 0 THEN o.d2 * 1000000000 + {label} END)) % 1000000000)::INT"


def _rim(y: str, x: str) -> str:
    return "(" + " OR ".join(f"coalesce({_label_at(f'{y} + {a}', f'{x} + {b}')} <> {_label_at(y, x)}, false)" for a, b in masks.SIDES) + ")"


_ERODED = f"SELECT y, x, label FROM {_PLACES} WHERE d <= 90 AND len(list_filter({_offsets(2, True)}, lambda o: {_rim('y + o.a', 'x + o.b')})) = 0"
_RING = f"SELECT y, x, d, outer_ AS label FROM (SELECT y, x, d, {_near(4)} AS outer_, {_near(1)} AS inner_ FROM {_PLACES}) WHERE outer_ IS NOT NULL AND inner_ IS NULL"


@query("mask_expand", f"SELECT roi, 'expanded' AS element, y, x, label FROM ({_expanded(3)})")
def mask_expand(spark, d):
    return masks.expand(fx.mask(spark, d, nucleus=True), 3, frame(spark, d))


@query("mask_erode", f"SELECT 'R0' AS roi, 'eroded' AS element, y, x, label FROM ({_ERODED})")
def mask_erode(spark, d):
    return masks.erode(fx.mask(spark, d), 2, frame(spark, d))


@query("mask_ring", f"SELECT 'R0' AS roi, 'ring' AS element, y, x, label FROM ({_RING})")
def mask_ring(spark, d):
    return masks.ring(fx.mask(spark, d, nucleus=True), frame(spark, d), 4, 1)


_OPEN = "SELECT DISTINCT y + dy AS y, x + dx AS x FROM ({e}), {disk} WHERE y + dy >= 0 AND x + dx >= 0 AND y + dy < {h} AND x + dx < {w}"
_CLOSE = "SELECT p.y, p.x FROM (SELECT y, x FROM (SELECT unnest(range({h})) AS y), (SELECT unnest(range({w})) AS x)) p, {disk} LEFT JOIN ({s}) q ON q.y = p.y + dy AND q.x = p.x + dx WHERE p.y + dy >= 0 AND p.x + dx >= 0 AND p.y + dy < {h} AND p.x + dx < {w} GROUP BY p.y, p.x HAVING count(q.y) = count(*)"
_H = "(SELECT max(height) FROM extent)"


def _shrunk(s: str, h: str = _H, w: str = "720", r: float = 2) -> str:
    return _CLOSE.format(s=s, disk=_disk_sql(r), h=h, w=w)


def _grown(s: str, h: str = _H, w: str = "720", r: float = 2) -> str:
    return _OPEN.format(e=s, disk=_disk_sql(r), h=h, w=w)


_POINTS = "SELECT y, x FROM cell"


@query("morph_open", f"SELECT 'R0' AS roi, y::INT AS y, x::INT AS x FROM ({_grown(_shrunk(_POINTS))})")
def morph_open(spark, d):
    return masks.morph_open(fx.mask(spark, d).select("roi", "y", "x"), 2, frame(spark, d))


@query("morph_close", f"SELECT 'R0' AS roi, y::INT AS y, x::INT AS x FROM ({_shrunk(_grown(_POINTS))})")
def morph_close(spark, d):
    return masks.morph_close(fx.mask(spark, d).select("roi", "y", "x"), 2, frame(spark, d))


def _axis(n: int, size: str) -> str:
    """``i, p``: the pixels that count in cell i of n, and (in ``f``) whether pixel p takes part of cell i."""
    centre = f"abs((i + 0.5::DOUBLE) * {size} / {n} - 0.5)"
    centre = f"(CASE WHEN {centre} > {size} - 1 THEN 2 * ({size} - 1) - {centre} ELSE {centre} END)"
    reach = f"floor(greatest({size} / {n}::DOUBLE - 1, 0) / 2 * 4 + 0.5)"
    back = f"abs((p + 0.5::DOUBLE) * {n} / {size} - 0.5)"
    back = f"(CASE WHEN {back} > {n - 1} THEN {2 * (n - 1)} - {back} ELSE {back} END)"
    blur = f"floor(greatest({n} / {size}::DOUBLE - 1, 0) / 2 * 4 + 0.5)"
    return f"SELECT i, p, p >= floor({centre}) - {reach} AND p <= ceil({centre}) + {reach} AS counts, i >= floor({back}) - {blur} AND i <= ceil({back}) + {blur} AS takes FROM (SELECT unnest(range({n})) AS i), (SELECT unnest(range({size})) AS p)"


_COARSE = "SELECT DISTINCT r.i AS y, c.i AS x FROM image JOIN rows_ r ON r.p = y AND r.counts JOIN columns_ c ON c.p = x AND c.counts WHERE element = 'click' AND value > 25000"
_SMOOTH = _shrunk(_grown(_grown(_shrunk("SELECT * FROM coarse_", "30", "60", 1), "30", "60", 1), "30", "60", 1), "30", "60", 1)


@query("mask_blob", f"WITH rows_ AS MATERIALIZED ({_axis(30, _H)}), columns_ AS MATERIALIZED ({_axis(60, '720')}), coarse_ AS MATERIALIZED ({_COARSE}) SELECT DISTINCT 'R0' AS roi, 'blob' AS element, r.p::INT AS y, c.p::INT AS x, 1 AS label FROM ({_SMOOTH}) s JOIN rows_ r ON r.i = s.y AND r.takes JOIN columns_ c ON c.i = s.x AND c.takes")
def mask_blob(spark, d):
    points = fx.image(spark, d).where("element = 'click' and value > 25000")
    return masks.blob(points, frame(spark, d), (30, 60), 1)


# ---- segmentation


@query("stack_channels", "SELECT roi, y, x, max(value) FILTER (element = 'click') AS first, max(value) FILTER (element = 'view') AS second FROM dense WHERE element IN ('click', 'view') GROUP BY ALL")
def stack_channels(spark, d):
    return segment.stack_channels(fx.dense_image(spark, d), ["click", "view"]).select("roi", "y", "x", F.col("values")[0].alias("first"), F.col("values")[1].alias("second"))


def _bright(image):
    """A model's stand-in: 1 where the first channel exceeds the second."""
    return {"bright": (image[0] > image[1]).astype("int32")}


@query("segment_callable", "SELECT roi, 'bright' AS element, y, x, 1 AS label FROM (SELECT roi, y, x, max(value) FILTER (element = 'click') AS a, max(value) FILTER (element = 'view') AS b FROM dense WHERE element IN ('click', 'view') GROUP BY ALL) WHERE a > b")
def segment_callable(spark, d):
    return segment.segment_objects(fx.dense_image(spark, d), _bright, ["click", "view"])


def _load_boxes():
    """A model's stand-in: numbers the blocks of 6 x 8 pixels whose first pixel is bright, in a batch of images."""

    def boxes(image):
        out = np.zeros(image[0].shape, "int32")
        for i, (y, x) in enumerate(np.argwhere(image[0] == 3)):
            out[y : y + 6, x : x + 8] = i + 1
        return {"box": out}

    return lambda images: [boxes(i) for i in images]


@query("segment_instances", "SELECT 'R0' AS roi, 'box' AS element, (y + dy)::INT AS y, (x + dx)::INT AS x, label FROM (SELECT y, x, (row_number() OVER (ORDER BY y // 64, x // 64, y, x))::INT AS label FROM grid WHERE y % 10 = 2 AND x % 24 = 5 AND label % 5 <> 0), (SELECT unnest(range(6)) AS dy), (SELECT unnest(range(8)) AS dx) WHERE y + dy < (SELECT max(height) FROM extent)")
def segment_instances(spark, d):
    """Objects that lie over seams of tiles, in order of the tiles that hold their first pixels."""
    label = F.expr("(y div 10) * 30 + x div 24 + 1")
    start = (F.col("y") % 10 == 2) & (F.col("x") % 24 == 5) & (label % 5 != 0)
    image = fx.dense_image(spark, d).where("element = 'click'").withColumn("value", F.when(start, 3.0).otherwise(0.0))
    return segment.segment_objects(image, None, ["click"], tile=64, halo=16, instances=True, load=_load_boxes)


_LINKED = """WITH found AS MATERIALIZED (SELECT y, x, (y * 720 + x)::BIGINT AS node FROM dense WHERE element = 'click' AND value > 100),
links AS MATERIALIZED (SELECT a.node AS a, b.node AS b FROM found a, (VALUES (0, 0), (0, 1), (1, 0), (0, -1), (-1, 0), (1, 1), (1, -1), (-1, 1), (-1, -1)) o(dy, dx) JOIN found b ON b.y = a.y + dy AND b.x = a.x + dx),
rounds AS (SELECT 0 AS r, node, node AS root, true AS moved FROM found
  UNION ALL
  SELECT s.r + 1, s.node, min(t.root), min(t.root) < s.root FROM rounds s JOIN links l ON l.a = s.node JOIN rounds t ON t.node = l.b
  WHERE EXISTS (SELECT 1 FROM rounds WHERE moved) GROUP BY s.r, s.node, s.root)
SELECT 'R0' AS roi, 'components' AS element, y, x, dense_rank() OVER (ORDER BY root)::INT AS label FROM rounds JOIN found USING (node) WHERE r = (SELECT max(r) FROM rounds)"""


@query("label_components", _LINKED)
def label_components(spark, d):
    points = fx.dense_image(spark, d).where("element = 'click' and value > 100").select("roi", "y", "x")
    return segment.label_components(points, fx.WIDTH, 8, 64)


# ---- steps


def _priorities(spark, d) -> list[str]:
    return sorted(r.element for r in fx.orders_catalog(spark, d).select("element").distinct().collect())


@query("level_check", "SELECT roi, element FROM (SELECT DISTINCT roi FROM catalog) CROSS JOIN (SELECT DISTINCT element FROM catalog) ANTI JOIN (SELECT roi, element FROM catalog WHERE level = 2) USING (roi, element)")
def level_check(spark, d):
    return plan.level_check(fx.orders_catalog(spark, d), 2, _priorities(spark, d))


@query("pipeline_missing", "SELECT roi, step::INT AS step, element FROM (SELECT DISTINCT roi FROM catalog) CROSS JOIN (SELECT element, (row_number() OVER (ORDER BY element) - 1) // 2 AS step FROM (SELECT DISTINCT element FROM catalog)) ANTI JOIN catalog USING (roi, element)")
def pipeline_missing(spark, d):
    names = _priorities(spark, d)
    steps = [(names[i : i + 2] + [f"made {i - 2}"] * (i > 0), [f"made {i}"]) for i in range(0, len(names), 2)]
    return plan.missing_inputs(fx.orders_catalog(spark, d).select("roi", "element").distinct(), steps)


@query("output_typing", "SELECT roi, element, y, x, label, c::INT AS c, value FROM (SELECT roi, element, y, x, label, NULL AS c, NULL::DOUBLE AS value FROM labels_ UNION ALL SELECT roi, element, y, x, NULL, 0, value FROM image)")
def output_typing(spark, d):
    wide = both_masks(spark, d).withColumn("label", F.col("label").cast("double"))
    return plan.typed(wide, "labels").unionByName(plan.typed(fx.image(spark, d), "image"), allowMissingColumns=True)


@query("pipeline_run", f"SELECT 'R0' AS roi, 'ring' AS element, y, x, label FROM ({_RING}) WHERE d <= 90")
def pipeline_run(spark, d):
    within = lambda a, b: a.join(b.select("roi", "y", "x"), ["roi", "y", "x"], "left_semi").select("roi", "element", "y", "x", "label")
    steps = [(lambda n: masks.ring(n, frame(spark, d), 4, 1), ["nucleus"], ["ring"]), (within, ["ring", "cell"], ["out"])]
    return plan.run_steps({"nucleus": fx.mask(spark, d, nucleus=True), "cell": fx.mask(spark, d)}, steps)["out"]


# ---- morphology

_REGION = {
    "region_area": ("n AS area", ["area"]),
    "region_centroid": ('round(sy / n::DOUBLE, 6) AS "centroid-0", round(sx / n::DOUBLE, 6) AS "centroid-1"', ["centroid-0", "centroid-1"]),
    "region_eccentricity": ("round(CASE WHEN l1 = 0 THEN 0.0 ELSE sqrt(1 - l2 / l1) END, 6) AS eccentricity", ["eccentricity"]),
    "region_bbox": ('y0 AS "bbox-0", x0 AS "bbox-1", y1 AS "bbox-2", x1 AS "bbox-3", (y1 - y0) * (x1 - x0) AS area_bbox, round(n / ((y1 - y0) * (x1 - x0))::DOUBLE, 6) AS extent', ["bbox-0", "bbox-1", "bbox-2", "bbox-3", "area_bbox", "extent"]),
    "region_eqdiam": ("round(sqrt(4 * n / pi()), 6) AS equivalent_diameter_area", ["equivalent_diameter_area"]),
    "region_axes": ('round(xx, 6) AS "inertia_tensor-0-0", round(-xy, 6) + 0.0 AS "inertia_tensor-0-1", round(yy, 6) AS "inertia_tensor-1-1", round(turn - CASE WHEN turn > pi() / 2 THEN pi() ELSE 0 END, 6) + 0.0 AS orientation, round(l1, 6) AS "inertia_tensor_eigvals-0", round(l2, 6) AS "inertia_tensor_eigvals-1", round(4 * sqrt(l1), 6) AS axis_major_length, round(4 * sqrt(l2), 6) AS axis_minor_length', ["inertia_tensor-0-0", "inertia_tensor-0-1", "inertia_tensor-1-1", "orientation", "inertia_tensor_eigvals-0", "inertia_tensor_eigvals-1", "axis_major_length", "axis_minor_length"]),
}


def _region(name: str, columns: list[str]):
    return lambda spark, d: _rounded(regions.basic(both_masks(spark, d)).select("roi", "mask", "label", *[F.col(f"`{c}`") for c in columns]))


for _name, (_sql, _columns) in _REGION.items():
    query(_name, f"SELECT roi, mask, label, {_sql} FROM axes")(_region(_name, _columns))


_M = [(p, q) for p in range(4) for q in range(4)]
_NU = [(p, q) for p, q in _M if p + q > 1]


def _moments_sql() -> str:
    """Raw and central moments as sums over pixels, from the centroid itself; normalised ones and Hu's from those."""
    at = "SELECT l.roi, l.element AS mask, l.label, (y - y0)::DOUBLE AS v, (x - x0)::DOUBLE AS u, y - sy / n::DOUBLE AS dv, x - sx / n::DOUBLE AS du FROM labels_ l JOIN mom m ON m.roi = l.roi AND m.mask = l.element AND m.label = l.label"
    power = lambda c, k: " * ".join([c] * k) or "1.0::DOUBLE"
    sums = ", ".join(f"sum({power('v', p)} * {power('u', q)}) AS m{p}{q}, sum({power('dv', p)} * {power('du', q)}) AS mu{p}{q}" for p, q in _M)
    nu = ", ".join(f"mu{p}{q} / pow(m00, {1 + (p + q) / 2}) AS nu{p}{q}" for p, q in _NU)
    hu = [
        "nu20 + nu02", "(nu20 - nu02) ** 2 + 4 * nu11 ** 2", "(nu30 - 3 * nu12) ** 2 + (3 * nu21 - nu03) ** 2", "(nu30 + nu12) ** 2 + (nu21 + nu03) ** 2",
        "(nu30 - 3 * nu12) * (nu30 + nu12) * ((nu30 + nu12) ** 2 - 3 * (nu21 + nu03) ** 2) + (3 * nu21 - nu03) * (nu21 + nu03) * (3 * (nu30 + nu12) ** 2 - (nu21 + nu03) ** 2)",
        "(nu20 - nu02) * ((nu30 + nu12) ** 2 - (nu21 + nu03) ** 2) + 4 * nu11 * (nu30 + nu12) * (nu21 + nu03)",
        "(3 * nu21 - nu03) * (nu30 + nu12) * ((nu30 + nu12) ** 2 - 3 * (nu21 + nu03) ** 2) - (nu30 - 3 * nu12) * (nu21 + nu03) * (3 * (nu30 + nu12) ** 2 - (nu21 + nu03) ** 2)",
    ]
    columns = [f"m{p}{q}" for p, q in _M] + [f"round(mu{p}{q}, 2) + 0.0 AS mu{p}{q}" for p, q in _M] + [f"round(nu{p}{q}, 6) + 0.0 AS nu{p}{q}" for p, q in _NU]
    columns += [f"round({h}, 6) + 0.0 AS hu{i}" for i, h in enumerate(hu)]
    return f"SELECT roi, mask, label, {', '.join(columns)} FROM (SELECT *, {nu} FROM (SELECT roi, mask, label, {sums} FROM ({at}) GROUP BY ALL))"


@query("region_moments", _moments_sql())
def region_moments(spark, d):
    digits = {f"mu{p}{q}": 2 for p, q in _M} | {f"nu{p}{q}": 6 for p, q in _NU} | {f"hu{i}": 6 for i in range(7)}
    m = regions.moments(both_masks(spark, d)).drop("centroid_local-0", "centroid_local-1")
    return m.withColumns({c: F.round(c, n) + 0.0 for c, n in digits.items()})


_PERIMETER = """own AS (SELECT element AS mask, label, y, x FROM labels_),
border AS (SELECT p.mask AS mask, p.label AS label, p.y AS y, p.x AS x FROM own p, (VALUES (0, 1), (1, 0), (0, -1), (-1, 0)) s(dy, dx) LEFT JOIN own q ON q.mask = p.mask AND q.label = p.label AND q.y = p.y + dy AND q.x = p.x + dx WHERE q.y IS NULL GROUP BY p.mask, p.label, p.y, p.x),
code AS (SELECT p.mask, p.label, p.y, p.x, 1 + sum(CASE WHEN q.y IS NULL THEN 0 WHEN dy = 0 OR dx = 0 THEN 2 ELSE 10 END) AS code FROM border p, (VALUES (0, 1), (1, 0), (0, -1), (-1, 0), (1, 1), (1, -1), (-1, 1), (-1, -1)) s(dy, dx) LEFT JOIN border q ON q.mask = p.mask AND q.label = p.label AND q.y = p.y + dy AND q.x = p.x + dx GROUP BY ALL)
SELECT 'R0' AS roi, mask, label, round(sum(CASE WHEN code IN (5, 7, 15, 17, 25, 27) THEN 1.0::DOUBLE WHEN code IN (21, 33) THEN sqrt(2) WHEN code IN (13, 23) THEN (1 + sqrt(2)) / 2 ELSE 0 END), 6) AS perimeter FROM code GROUP BY mask, label"""


@query("region_perimeter", f"WITH {_PERIMETER}")
def region_perimeter(spark, d):
    return _rounded(regions.perimeter(both_masks(spark, d)))


_QUADS = "quads AS (SELECT element AS mask, label, y + dy AS qy, x + dx AS qx, bit_or(b) AS p FROM labels_, (VALUES (0, 0, 1), (0, -1, 2), (-1, 0, 4), (-1, -1, 8)) o(dy, dx, b) GROUP BY ALL)"


@query("region_euler", f"WITH {_QUADS} SELECT 'R0' AS roi, mask, label, ((count(*) FILTER (p IN (1, 2, 4, 8)) - count(*) FILTER (p IN (7, 11, 13, 14)) - 2 * count(*) FILTER (p IN (6, 9))) / 4)::INT AS euler_number FROM quads GROUP BY ALL")
def region_euler(spark, d):
    return regions.euler_number(both_masks(spark, d))


@query("region_crofton", f"WITH {_QUADS} SELECT 'R0' AS roi, mask, label, round(pi() / 4 * (sum((((p & 1) > 0) <> ((p & 2) > 0))::INT) + sum((((p & 1) > 0) <> ((p & 4) > 0))::INT) + (sum((((p & 1) > 0) <> ((p & 8) > 0))::INT) + sum((((p & 2) > 0) <> ((p & 4) > 0))::INT)) / sqrt(2)) / 2, 6) AS perimeter_crofton FROM quads GROUP BY ALL")
def region_crofton(spark, d):
    return _rounded(regions.perimeter_crofton(both_masks(spark, d)))


# a row of the hull reaches as far as any line between two points does; points are the middles of the pixels' sides
_HULL = """WITH ends AS (SELECT roi, element AS mask, label, y, min(x)::DOUBLE AS lo, max(x)::DOUBLE AS hi FROM labels_ GROUP BY ALL),
points AS (SELECT DISTINCT roi, mask, label, e.y + dy AS y, CASE side WHEN 'lo' THEN lo ELSE hi END + dx AS x FROM ends e, (VALUES ('lo', 0.0::DOUBLE, -0.5::DOUBLE), ('hi', 0.0, 0.5), ('lo', -0.5, 0.0), ('lo', 0.5, 0.0), ('hi', -0.5, 0.0), ('hi', 0.5, 0.0)) o(side, dy, dx)),
spans AS (SELECT e.roi, e.mask, e.label, e.y, max(CASE WHEN a.y = b.y THEN a.x ELSE a.x + (e.y - a.y) * (b.x - a.x) / (b.y - a.y) END) AS r, min(CASE WHEN a.y = b.y THEN a.x ELSE a.x + (e.y - a.y) * (b.x - a.x) / (b.y - a.y) END) AS l
  FROM ends e JOIN points a ON a.roi = e.roi AND a.mask = e.mask AND a.label = e.label AND a.y <= e.y JOIN points b ON b.roi = e.roi AND b.mask = e.mask AND b.label = e.label AND b.y >= e.y GROUP BY ALL),
areas AS (SELECT roi, mask, label, sum(greatest(0, floor(r + 1e-9) - ceil(l - 1e-9) + 1))::BIGINT AS area_convex FROM spans GROUP BY ALL),
feret AS (SELECT a.roi, a.mask, a.label, max(sqrt((a.y - b.y) * (a.y - b.y) + (a.x - b.x) * (a.x - b.x))) AS feret FROM points a JOIN points b ON a.roi = b.roi AND a.mask = b.mask AND a.label = b.label GROUP BY ALL)
SELECT roi, mask, label, {} FROM areas JOIN feret USING (roi, mask, label) JOIN mom USING (roi, mask, label)"""


@query("region_solidity", _HULL.format("round(n / area_convex::DOUBLE, 6) AS solidity"))
def region_solidity(spark, d):
    return _rounded(regions.hull(both_masks(spark, d)).select("roi", "mask", "label", "solidity"))


@query("region_hull", _HULL.format("area_convex, round(feret, 6) AS feret_diameter_max"))
def region_hull(spark, d):
    return _rounded(regions.hull(both_masks(spark, d)).select("roi", "mask", "label", "area_convex", "feret_diameter_max"))


# a cell without its nucleus has a hole, which filling closes; where the image ends in a nucleus, the hole is open
@query("region_filled", "SELECT c.roi, 'difference' AS mask, label, c.n - CASE WHEN (c.y1 - 1) % 10 > 7 THEN 0 ELSE coalesce(m.n, 0) END AS area_filled FROM mom c LEFT JOIN (SELECT label, n FROM mom WHERE mask = 'nucleus') m USING (label) WHERE mask = 'cell'")
def region_filled(spark, d):
    return regions.filled(mask_subtract(spark, d))


@query("region_coords", "SELECT roi, element AS mask, label, arg_min(y, y * 1000 + x) AS first_y, arg_min(x, y * 1000 + x) AS first_x, count(*)::INT AS n FROM labels_ GROUP BY ALL")
def region_coords(spark, d):
    c = regions.coords(both_masks(spark, d))
    return c.select("roi", "mask", "label", F.col("coords")[0]["y"].alias("first_y"), F.col("coords")[0]["x"].alias("first_x"), F.size("coords").alias("n"))


# ---- intensity


def _intensity(*metrics: str):
    return lambda spark, d: _rounded(intensity.intensity(fx.dense_image(spark, d), both_masks(spark, d), metrics))


for _name, _metrics in {"intensity_mean": ("mean",), "intensity_minmax": ("min", "max"), "intensity_median": ("median",), "intensity_sum": ("sum",), "intensity_std": ("std",), "intensity_all": ("mean", "median", "min", "max", "sum", "std")}.items():
    query(_name, "SELECT roi, mask, channel, label, " + ", ".join(f"round({m}, 6) + 0.0 AS {m}" for m in _metrics) + " FROM stats")(_intensity(*_metrics))

# the sketch's rank is off by its stated error at most; of values that are equal, any rank they share will do
@query("intensity_sketch", "SELECT roi, l.element AS mask, i.element AS channel, count(*) AS n, true AS within FROM labels_ l JOIN dense i USING (roi, y, x) GROUP BY ALL")
def intensity_sketch(spark, d):
    """Approximate medians of whole masks from sketches of tiles, and whether their rank is within the error."""
    px, lb = fx.dense_image(spark, d), both_masks(spark, d)
    found = intensity.quantiles(intensity.sketches(px, lb, 64, by=()))
    each = intensity.under(px, lb).withColumnRenamed("value", "v")
    ranks = each.join(found, ["roi", "mask", "channel"]).groupBy("roi", "mask", "channel", "n").agg(F.avg((F.col("v") < F.col("value")).cast("int")).alias("below"), F.avg((F.col("v") <= F.col("value")).cast("int")).alias("upto"))
    error = intensity.RANK_ERROR
    return ranks.select("roi", "mask", "channel", "n", ((F.col("below") <= 0.5 + error) & (F.col("upto") >= 0.5 - error)).alias("within"))


if "spread" not in intensity.METRICS:
    intensity.register_metric("spread", lambda v: F.max(v) - F.min(v))


@query("intensity_custom", "SELECT roi, mask, channel, label, max - min AS spread FROM stats WHERE channel IN ('click', 'view')")
def intensity_custom(spark, d):
    return intensity.intensity(fx.dense_image(spark, d), both_masks(spark, d), ["spread"], ["click", "view"])


# ---- object tables

_MASKS = ["cell", "nucleus"]


@query("obs_outer", "SELECT roi, label, max(n) FILTER (mask = 'cell') AS area_cell, max(n) FILTER (mask = 'nucleus') AS area_nucleus FROM mom GROUP BY ALL")
def obs_outer(spark, d):
    return objects.obs_table(regions.basic(both_masks(spark, d)), ["area"], _MASKS)


_WIDE = "SELECT roi, label, " + ", ".join(f"max({m}) FILTER (channel = '{c}' AND mask = '{k}') AS {c}_{m}_{k}" for c in ("click", "view") for m in ("max", "min") for k in _MASKS) + " FROM stats WHERE channel IN ('click', 'view') GROUP BY ALL"
_NAMES = [f"{c}_{m}_{k}" for c in ("click", "view") for m in ("max", "min") for k in _MASKS]


def _long(spark, d):
    found = intensity.intensity(fx.dense_image(spark, d), both_masks(spark, d), ["max", "min"], ["click", "view"])
    return intensity.features(found, ["max", "min"])


@query("signal_wide", _WIDE)
def signal_wide(spark, d):
    return objects.wide(_long(spark, d), _NAMES)


@query("signal_reindex", f"SELECT o.roi, o.label, w.* EXCLUDE (roi, label) FROM (SELECT roi, label FROM mom WHERE mask = 'nucleus') o LEFT JOIN ({_WIDE}) w ON w.roi = o.roi AND w.label = o.label")
def signal_reindex(spark, d):
    obs = regions.basic(fx.mask(spark, d, nucleus=True)).select("roi", "label")
    return objects.reindex(signal_wide(spark, d), obs)


@query("obsm_arrays", "SELECT roi, label, round(sy / n::DOUBLE, 6) AS y, round(sx / n::DOUBLE, 6) AS x, 2::INT AS n FROM mom WHERE mask = 'cell'")
def obsm_arrays(spark, d):
    t = objects.obs_table(regions.basic(fx.mask(spark, d)).withColumnsRenamed({"centroid-0": "c0", "centroid-1": "c1"}), ["c0", "c1"], ["cell"])
    packed = objects.pack_arrays(t.withColumnsRenamed({"c0_cell": "centroid-0_cell", "c1_cell": "centroid-1_cell"}))
    return packed.select("roi", "label", F.round(F.col("centroid_cell")[0], 6).alias("y"), F.round(F.col("centroid_cell")[1], 6).alias("x"), F.size("centroid_cell").alias("n"))


@query("region_link", "SELECT roi, label, n AS area, 'cell' AS region, label AS cell FROM mom WHERE mask = 'cell'")
def region_link(spark, d):
    return objects.link_region(regions.basic(fx.mask(spark, d)).select("roi", "label", "area"), "cell", _MASKS)


def _points(spark, d):
    m = regions.basic(fx.mask(spark, d))
    return m.select("roi", "label", F.col("`centroid-1`").alias("x"), F.col("`centroid-0`").alias("y"))


@query("qc_point_in_polygon", "SELECT * FROM hits")
def qc_point_in_polygon(spark, d):
    return objects.excluded(_points(spark, d), fx.shapes(spark, d))


_QC = "SELECT s.roi, s.label, s.channel || '_mean_' || s.mask AS feature, round(s.mean, 6) + 0.0 AS value, h.label IS NULL AS keep FROM stats s LEFT JOIN hits h ON h.roi = s.roi AND h.label = s.label AND h.shape_key = 'qc_exclude_' || string_split(s.channel, '_')[1]"


def _features(spark, d):
    found = intensity.intensity(fx.dense_image(spark, d), both_masks(spark, d), ["mean"])
    return _rounded(found.select("roi", "label", F.concat_ws("_", "channel", F.lit("mean"), "mask").alias("feature"), F.col("mean").alias("value")))


@query("qc_feature_mask", _QC)
def qc_feature_mask(spark, d):
    return objects.qc_mask(_features(spark, d), _points(spark, d), fx.shapes(spark, d)).select("roi", "label", "feature", "value", "keep")


@query("qc_rewrite", _QC)
def qc_rewrite(spark, d):
    """Exclusion on a stored table, which it replaces."""
    tables.write_table(_features(spark, d), path := storage.shared_dir(spark), "objects")
    plan.rewrite_qc(spark, path, "objects", _points(spark, d), fx.shapes(spark, d))
    return tables.read_stored(spark, path).select("roi", "label", "feature", "value", "keep")


@query("qc_rerun", f"SELECT shape_key, count(*) AS excluded FROM ({_QC.replace('SELECT s.roi', 'SELECT h.shape_key, s.roi')}) WHERE NOT keep GROUP BY ALL")
def qc_rerun(spark, d):
    """Exclusion on a stored table; how many features each key of shapes takes out."""
    tables.write_table(_features(spark, d), path := storage.shared_dir(spark), "objects")
    out = plan.qc_after(tables.read_stored(spark, path), _points(spark, d), fx.shapes(spark, d))
    key = F.concat(F.lit("qc_exclude_"), F.substring_index("feature", "_", 1))
    return out.where("not keep").groupBy(key.alias("shape_key")).agg(F.count("*").alias("excluded"))


@query("qc_shapes_used", "SELECT shape_key, shape_key IN (SELECT 'qc_exclude_' || element FROM extent WHERE element <> 'click') AS used FROM shape0 GROUP BY shape_key")
def qc_shapes_used(spark, d):
    named = fx.image(spark, d).where("element <> 'click'").select(F.concat("element", F.lit("_mean_cell")).alias("feature"))
    return objects.used_shapes(named, fx.shapes(spark, d))


_OBS = ", ".join(f'max({c}) FILTER (mask = \'{m}\') AS "{n}_{m}"' for m in ("cell", "nucleus") for n, c in (("area", "n"), ("centroid-0", "round(sy / n::DOUBLE, 6)"), ("centroid-1", "round(sx / n::DOUBLE, 6)"), ("eccentricity", "round(CASE WHEN l1 = 0 THEN 0.0 ELSE sqrt(1 - l2 / l1) END, 6)"), ("euler_number", "euler_number"), ("solidity", "solidity"), ("perimeter", "perimeter")))

# every object of either mask with every feature
_CODES, _LENGTHS = _PERIMETER.rsplit("\n", 1)
_HULLS, _SOLIDITY = _HULL.format("round(n / area_convex::DOUBLE, 6) AS solidity").removeprefix("WITH ").rsplit("\n", 1)
_QUANTIFY = f"""WITH {_QUADS}, {_CODES}, lengths AS ({_LENGTHS}), {_HULLS}, solids AS ({_SOLIDITY}),
eulers AS (SELECT 'R0' AS roi, mask, label, ((count(*) FILTER (p IN (1, 2, 4, 8)) - count(*) FILTER (p IN (7, 11, 13, 14)) - 2 * count(*) FILTER (p IN (6, 9))) / 4)::INT AS euler_number FROM quads GROUP BY ALL),
obs AS (SELECT roi, label, {_OBS} FROM axes JOIN eulers USING (roi, mask, label) JOIN lengths USING (roi, mask, label) JOIN solids USING (roi, mask, label) GROUP BY ALL),
named AS (SELECT element AS channel, metric, mask FROM extent, (VALUES ('mean'), ('median')) m(metric), (VALUES ('cell'), ('nucleus')) k(mask)),
long AS (UNPIVOT (SELECT roi, label, channel, mask, mean, median FROM stats) ON mean, median INTO NAME metric VALUE value)
SELECT obs.*, channel || '_' || metric || '_' || mask AS feature, round(value, 6) + 0.0 AS value, h.label IS NULL AS keep
FROM obs CROSS JOIN named LEFT JOIN long USING (roi, label, channel, metric, mask)
LEFT JOIN hits h ON h.roi = obs.roi AND h.label = obs.label AND h.shape_key = 'qc_exclude_' || string_split(channel, '_')[1]"""


@query("quantify", _QUANTIFY)
def quantify(spark, d):
    images = fx.extent(spark, d).select("roi", "element", F.lit("image").alias("kind"))
    named = images.select("roi", F.explode(F.array(*map(F.lit, _MASKS))).alias("element"), F.lit("labels").alias("kind"))
    return _rounded(plan.quantify(fx.dense_image(spark, d), both_masks(spark, d), fx.shapes(spark, d), catalog=images.unionByName(named)))


# pixels and labels of every window, each from the window's corner
_IN_WINDOWS = "SELECT w.slide, w.roi, y - y0 AS y, x - x0 AS x, {} FROM windows w JOIN slide_dense i ON w.slide = i.slide AND w.element = i.element AND y >= y0 AND y < y1 AND x >= x0 AND x < x1 WHERE w.element IN ('click', 'view')"
_SLIDE_CELL = "(SELECT 'S' || (y // 8) AS slide, (y % 8)::INT AS y, x, label FROM cell)"


@query("quantify_slides", f"WITH inside AS ({_IN_WINDOWS.format('w.element AS channel, value, w.y0 AS top, w.x0 AS left_')}), seen AS (SELECT i.slide, roi, channel, label, i.y, i.x, value FROM inside i JOIN {_SLIDE_CELL} c ON c.slide = i.slide AND c.y = i.y + top AND c.x = i.x + left_), areas AS (SELECT slide, roi, label, count(*) AS area_cell, round(avg(y), 6) AS cy, round(avg(x), 6) AS cx FROM seen WHERE channel = 'click' GROUP BY ALL) SELECT slide, roi, label, any_value(area_cell) AS area_cell, any_value(cy) + 0.0 AS \"centroid-0_cell\", any_value(cx) + 0.0 AS \"centroid-1_cell\", channel || '_mean_cell' AS feature, round(avg(value), 6) + 0.0 AS value, true AS keep FROM seen JOIN areas USING (slide, roi, label) GROUP BY slide, roi, label, channel")
def quantify_slides(spark, d):
    """Objects in the windows of all slides, where names of ROIs repeat from slide to slide."""
    windows, frames, named = fx.rois(spark, d).withColumn("poly_type", F.lit("rectangle")), fx.slide_extent(spark, d), F.col("element").isin("click", "view")
    px = cut.cut(fx.slide_image(spark, d).where(named), windows, frames, 2)
    strip = F.expr(f"y div {fx.STRIP}").cast("string")
    cells = fx.mask(spark, d).select(F.concat(F.lit("S"), strip).alias("slide"), "element", F.expr(f"y % {fx.STRIP}").alias("y"), "x", F.col("label").alias("value"))
    lb = cut.cut(cells, windows, frames.where("element = 'click'").withColumn("element", F.lit("cell")), 2)
    lb = lb.withColumn("label", F.col("value").cast("int")).drop("value")
    out = plan.quantify(px, lb, channels=["click", "view"], metrics=["mean"], properties=["label", "area", "centroid"])
    return _rounded(out)


# ---- arrivals


_PIXELS = "slide string, element string, y int, x int, value double"
#: Pixels of three files.
_MOST = 1 << 27


def _arrive(spark, d, image, path):
    """Adds pixel files: three, or more where one would hold too many pixels for a task. A channel of a slide is in one file.

    Zeros take so little room that a file would be one row group, and as small as what one task reads: row groups are
    small, and not compressed.
    """
    shares = -(-fx.pixels(spark, d) // _MOST)
    share = F.pmod(F.xxhash64("slide"), F.lit(shares))
    image.repartition(3 * shares, "element", share).write.mode("append").option("parquet.block.size", 8 << 20).option("compression", "none").parquet(path)


@query("stream_cut", _CUT.format(_TRIANGLE.replace("-1.0 END", "0.0 END")))
def stream_cut(spark, d):
    base = storage.shared_dir(spark)
    _arrive(spark, d, fx.slide_image(spark, d), f"{base}/in")
    arrivals.stream_cut(spark, f"{base}/in", _PIXELS, fx.rois(spark, d), fx.slide_extent(spark, d), f"{base}/out", f"{base}/state", 2).awaitTermination()
    return arrivals.cut_channels(spark, f"{base}/out").drop("batch")


@query("stream_assemble", "SELECT w.slide, w.roi, w.element, count(*) AS n, sum(value) AS total FROM windows w JOIN slide_dense i ON w.slide = i.slide AND w.element = i.element AND y >= row_start AND y < least(height, row_stop) AND x >= column_start AND x < column_stop WHERE w.slide <> 'S1' GROUP BY ALL")
def stream_assemble(spark, d):
    """Channels come in two turns with a restart between, some twice; one of slide S1 never does, so that this slide isn't assembled."""
    base, roi = storage.shared_dir(spark), fx.rois(spark, d).withColumn("poly_type", F.lit("rectangle"))
    image = fx.slide_image(spark, d).where("slide <> 'S1' or element <> 'view'")
    for turn in (image.where("element <> 'view'"), image.where("element in ('click', 'view')")):
        _arrive(spark, d, turn, f"{base}/in")
        arrivals.stream_cut(spark, f"{base}/in", _PIXELS, roi, fx.slide_extent(spark, d), f"{base}/out", f"{base}/state", files=2, store=f"{base}/store").awaitTermination()
    return tables.read_stored(spark, f"{base}/store").groupBy("slide", "roi", "element").agg(F.count("*").alias("n"), F.sum("value").alias("total"))


@query("stream_ready", "SELECT slide FROM (SELECT (user_id % 7)::VARCHAR AS slide, count(DISTINCT event_type) AS n FROM events WHERE user_id % 7 < 5 OR event_type <> 'click' GROUP BY ALL) WHERE n = (SELECT count(DISTINCT event_type) FROM events)")
def stream_ready(spark, d):
    slide = (F.col("y") % 7).cast("string").alias("slide")
    found = fx.image(spark, d).where("y % 7 < 5 or element <> 'click'").select(slide, "element").distinct()
    names = fx.extent(spark, d).select("element")
    expected = fx.image(spark, d).select(slide).distinct().join(F.broadcast(names))
    return arrivals.ready_slides(found, expected)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(SQL)
