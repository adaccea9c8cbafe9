"""Operators on small analytic inputs."""

import uuid

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from cellgrid import queries
from cellgrid.functions import geometry
from cellgrid.operators import channels, cut, enhance, intensity, masks, objects, regions, rois, segment
from cellgrid.plans import quantify as plan
from cellgrid.sources import fixtures, tables
from cellgrid.streaming import arrivals


def pixels(spark, array, element="A", roi="R0"):
    y, x = np.mgrid[: array.shape[0], : array.shape[1]]
    return spark.createDataFrame(pd.DataFrame({"roi": roi, "element": element, "y": y.ravel().astype("int32"), "x": x.ravel().astype("int32"), "value": array.ravel().astype(float)}))


def labels(spark, array, element="cell"):
    y, x = np.nonzero(array)
    return spark.createDataFrame(pd.DataFrame({"roi": "R0", "element": element, "y": y.astype("int32"), "x": x.astype("int32"), "label": array[y, x].astype("int32")}), "roi string, element string, y int, x int, label int")


def extent(spark, h, w):
    return spark.createDataFrame([("R0", "A", h, w)], "roi string, element string, height int, width int")


def array(df, shape, value="label"):
    out = np.zeros(shape)
    for r in df.collect():
        out[r.y, r.x] = r[value]
    return out


def test_subtract_and_multiply(spark):
    cell, nucleus = np.ones((5, 5), int), np.zeros((5, 5), int)
    nucleus[1:4, 1:4] = 1
    assert array(masks.subtract(labels(spark, cell), labels(spark, nucleus)), (5, 5)).sum() == 16
    across, down = np.zeros((3, 3), int), np.zeros((3, 3), int)
    across[1], down[:, 1] = 2, 3
    assert array(masks.multiply(labels(spark, across), labels(spark, down)), (3, 3))[1, 1] == 6


def test_products_beyond_32_bits(spark, tmp_path):
    own = labels(spark, np.full((2, 2), 50_000))
    assert {r.label for r in masks.multiply(own, own, kind="bigint").collect()} == {2_500_000_000}
    with pytest.raises(Exception, match="CAST_OVERFLOW"):
        masks.multiply(own, own).collect()
    # a tall image has labels up to 46,380
    spark.sql("select timestamp'2024-01-01' as ts, 15459L as user_id, 'click' as event_type, 1.0D as value").write.parquet(f"file://{tmp_path}/events.parquet")
    found = queries.queries()["mask_multiply"](spark, f"file://{tmp_path}")
    most = found.agg(F.max("label").alias("label"), F.count("*").alias("n")).first()
    cells = fixtures.mask(spark, f"file://{tmp_path}", nucleus=True).agg(F.max("label").alias("label"), F.count("*").alias("n")).first()
    assert most.n == cells.n and most.label == cells.label**2 > 1 << 31
    assert dict(queries.queries()["mask_multiply"](spark, "/root/testdata/sf0.001").dtypes)["label"] == "int"


def test_ring_around_a_pixel(spark):
    one = np.zeros((11, 11), int)
    one[5, 5] = 1
    ring = array(masks.ring(labels(spark, one), extent(spark, 11, 11), 2, 0), (11, 11))
    d2 = (np.mgrid[:11, :11][0] - 5) ** 2 + (np.mgrid[:11, :11][1] - 5) ** 2
    assert ((ring > 0) == ((d2 <= 4) & (d2 > 0))).all()
    with pytest.raises(ValueError):
        masks.ring(labels(spark, one), extent(spark, 11, 11), 1, 2)


def test_erosion_ring(spark):
    framed = np.zeros((11, 11), int)
    framed[1:10, 1:10] = 1
    ring = array(masks.ring(labels(spark, framed), extent(spark, 11, 11), 0, -2), (11, 11))
    expected = framed.copy()
    expected[3:8, 3:8] = 0
    assert (ring == expected).all()
    whole = np.ones((6, 6), int)  # flush with the image on all sides: nothing to erode
    assert array(masks.erode(labels(spark, whole), 2, extent(spark, 6, 6)), (6, 6)).sum() == 36


def test_expand_takes_the_nearest_label(spark):
    two = np.zeros((5, 9), int)
    two[2, 1], two[2, 7] = 4, 2
    out = array(masks.expand(labels(spark, two), 3, extent(spark, 5, 9)), (5, 9))
    assert out[2, 3] == 4 and out[2, 5] == 2 and out[2, 4] == 2  # a tie goes to the smaller label


def test_growth_and_erosion_across_tiles(spark):
    rng = np.random.default_rng(7)
    area = np.where(rng.random((37, 45)) < 0.02, rng.integers(1, 50, (37, 45)), 0)
    area[10:22, 12:30] = 60
    area[15:20, 20:24] = 61
    y, x = np.nonzero(area)
    grown, shrunk = area.copy(), area.copy()
    rim = {(i, j) for i in range(37) for j in range(45) for di, dj in masks.SIDES if 0 <= i + di < 37 and 0 <= j + dj < 45 and area[i + di, j + dj] != area[i, j]}
    for i in range(37):
        for j in range(45):
            d2 = (y - i) ** 2 + (x - j) ** 2
            if not area[i, j] and d2.min() <= 9:
                grown[i, j] = min(area[a, b] for a, b, d in zip(y, x, d2) if d == d2.min())
            if any((i - a) ** 2 + (j - b) ** 2 < 4 for a, b in rim):
                shrunk[i, j] = 0
    own, frame = labels(spark, area), extent(spark, 37, 45)
    assert (array(masks.expand(own, 3, frame, tile=8), area.shape) == grown).all()
    assert (array(masks.erode(own, 2, frame, tile=8), area.shape) == shrunk).all()


def test_opening_and_closing_across_tiles(spark):
    rng = np.random.default_rng(8)
    area = rng.random((30, 41)) < 0.7
    inside = lambda i, j: 0 <= i < 30 and 0 <= j < 41
    disk = masks.disk(1)
    grow = lambda a: np.array([[any(inside(i + y, j + x) and a[i + y, j + x] for y, x, _ in disk) for j in range(41)] for i in range(30)])
    wane = lambda a: np.array([[all(not inside(i + y, j + x) or a[i + y, j + x] for y, x, _ in disk) for j in range(41)] for i in range(30)])
    points, frame = labels(spark, area.astype(int)), extent(spark, 30, 41)
    for ours, theirs in ((masks.dilate(points, 1, frame, tile=7), grow(area)), (masks.shrink(points, 1, frame, tile=7), wane(area))):
        assert (array(ours.withColumn("label", F.lit(1)), area.shape) == theirs).all()


def resized(image, shape):
    """Resizing by linear interpolation with mirrored borders, after a Gaussian blur where it gets smaller."""
    for axis, n in enumerate(shape):
        size = image.shape[axis]
        sigma, at = max(0.0, (size / n - 1) / 2), np.arange(size)
        mirror = lambda k, size=size: np.abs((k + size - 1) % max(1, 2 * size - 2) - size + 1)
        if sigma:
            reach = int(4 * sigma + 0.5)
            steps = np.arange(-reach, reach + 1)
            weight = np.exp(-0.5 * (steps / sigma) ** 2)
            image = sum(w * np.take(image, mirror(at + k), axis) for w, k in zip(weight / weight.sum(), steps))
        c = (np.arange(n) + 0.5) * size / n - 0.5
        c = np.abs(c)
        c = np.where(c > size - 1, 2 * (size - 1) - c, c)
        low, part = np.floor(c).astype(int), c - np.floor(c)
        part = part.reshape([-1 if a == axis else 1 for a in range(2)])
        image = np.take(image, low, axis) * (1 - part) + np.take(image, np.minimum(low + 1, size - 1), axis) * part
    return image


@pytest.mark.parametrize(("shape", "work"), [((60, 90), (20, 25)), ((33, 40), (50, 16)), ((24, 24), (24, 24))])
def test_blob_resizes_both_ways(spark, shape, work):
    area = np.zeros(shape)
    area[5:20, 8:22] = 3
    area[shape[0] - 4 :, shape[1] - 5 :] = 1
    area[22, shape[1] // 2] = 1
    coarse = resized((area > 0).astype(float), work) > 0
    disk, inside = masks.disk(1), lambda i, j: 0 <= i < work[0] and 0 <= j < work[1]
    for every in (all, any, any, all):  # opening, closing
        missing = every is all
        coarse = np.array([[every(coarse[i + y, j + x] if inside(i + y, j + x) else missing for y, x, _ in disk) for j in range(work[1])] for i in range(work[0])])
    expected = resized(coarse.astype(float), shape) > 0
    out = masks.blob(labels(spark, area.astype(int)), extent(spark, *shape), work, 1)
    assert (array(out, shape) == expected).all() and 0 < expected.sum() < expected.size
    with pytest.raises(ValueError):
        masks.blob(labels(spark, area.astype(int)), extent(spark, *shape), (0, 5))


def test_normalize(spark):
    ramp = np.linspace(0, 100, 11).reshape(1, 11)
    out = array(enhance.normalize(pixels(spark, ramp), 10, 90), (1, 11), "value")
    assert np.allclose(out, np.clip((ramp - 10) / 80, 0, 1))
    with pytest.raises(ValueError):
        enhance.normalize(pixels(spark, ramp), 90, 10)
    with pytest.raises(Exception, match="no contrast"):
        enhance.normalize(pixels(spark, np.zeros((3, 3)))).collect()


def test_percentiles_are_exact(spark):
    rng = np.random.default_rng(3)
    shares = [0.0, 0.01, 0.37, 0.5, 0.995, 1.0]
    for image in (rng.normal(0, 100, (90, 110)), rng.poisson(0.3, (60, 60)), np.array([[7.0]]), np.array([[1.0, 2.0]])):
        got = enhance.percentiles(pixels(spark, image.astype(float)), shares).first().p
        assert np.allclose(got, np.percentile(image, [100 * s for s in shares]), rtol=1e-12)


def test_mean_of_images(spark):
    a, b = pixels(spark, np.full((2, 2), 10.0)), pixels(spark, np.full((2, 2), 20.0), "B")
    assert array(enhance.mean_of_images(a.unionByName(b), ["A", "B"]), (2, 2), "value").sum() == 60
    with pytest.raises(Exception, match="differ"):
        enhance.mean_of_images(a.unionByName(pixels(spark, np.ones((1, 2)), "B")), ["A", "B"]).collect()


def test_median_over_tiles(spark):
    image = np.random.default_rng(0).integers(0, 255, (40, 50)).astype(float)
    out = array(enhance.median_denoise(pixels(spark, image), extent(spark, 40, 50), 2, tile=16), image.shape, "value")
    p = np.pad(image, 2, mode="edge")
    expected = np.median([p[2 + y : 42 + y, 2 + x : 52 + x] for y, x, _ in masks.disk(2)], axis=0)
    assert (out == expected).all()


def test_components_across_tiles(spark):
    image = np.random.default_rng(1).random((40, 40)) < 0.55
    y, x = np.nonzero(image)
    points = spark.createDataFrame(pd.DataFrame({"roi": "R0", "y": y.astype("int32"), "x": x.astype("int32")}))
    for connectivity in (4, 8):
        got = array(segment.label_components(points, 40, connectivity, tile=7), image.shape)
        seen = np.zeros(image.shape, int)
        number = 0
        for a, b in zip(y, x):
            if not seen[a, b]:
                number += 1
                todo = [(a, b)]
                while todo:
                    i, j = todo.pop()
                    if 0 <= i < 40 and 0 <= j < 40 and image[i, j] and not seen[i, j]:
                        seen[i, j] = number
                        todo += [(i + dy, j + dx) for dy in (-1, 0, 1) for dx in (-1, 0, 1) if connectivity == 8 or not (dy and dx)]
        assert (got == seen).all()


ROI = "slide string, roi string, row_start int, row_stop int, column_start int, column_stop int, poly_type string, polygon_vertices array<struct<row:double,col:double>>"


def on_slide(df, slide):
    return df.withColumn("slide", F.lit(slide))


def test_cut_margin_and_polygon(spark):
    image = np.add.outer(np.arange(100), np.arange(100)).astype(float)
    vertices = [{"row": 10.0, "col": 10.0}, {"row": 20.0, "col": 10.0}, {"row": 10.0, "col": 20.0}]
    table = spark.createDataFrame([("s", "r", 40, 50, 40, 50, "rectangle", vertices), ("s", "e", 95, 100, 0, 5, "rectangle", vertices), ("s", "p", 10, 21, 10, 21, "polygon", vertices)], ROI)
    px, frame = on_slide(pixels(spark, image), "s"), on_slide(extent(spark, 100, 100), "s")
    out = cut.cut(px, table, frame, margin=2, mask_value=-5.0).toPandas()
    r = out[out.roi == "r"]
    assert len(r) == 14 * 14 and r[(r.y == 0) & (r.x == 0)].value.item() == 76
    assert len(out[out.roi == "e"]) == 7 * 7
    p = out[out.roi == "p"]
    assert (p.value != -5).sum() == 66 and p[(p.y == 2) & (p.x == 12)].value.item() == 30
    with pytest.raises(Exception, match="unknown poly_type"):
        cut.cut(px, table.withColumn("poly_type", F.lit("star")), frame).collect()
    with pytest.raises(ValueError):
        cut.cut(px, table, frame, margin=-1)


def two_slides(spark):
    """Slides of another size and other values, each with an ROI that would fit both."""
    px = on_slide(pixels(spark, np.full((30, 30), 1.0)), "s").unionByName(on_slide(pixels(spark, np.full((12, 12), 2.0)), "t"))
    frame = on_slide(extent(spark, 30, 30), "s").unionByName(on_slide(extent(spark, 12, 12), "t"))
    table = spark.createDataFrame([("s", "a", 5, 20, 5, 20, "rectangle", None), ("t", "b", 5, 20, 5, 20, "rectangle", None)], ROI)
    return px, frame, table


def test_slides_are_cut_apart(spark):
    px, frame, table = two_slides(spark)
    got = {(r.slide, r.roi): (r.n, r.v) for r in cut.cut(px, table, frame).groupBy("slide", "roi").agg(F.count("*").alias("n"), F.avg("value").alias("v")).collect()}
    assert got == {("s", "a"): (225, 1.0), ("t", "b"): (49, 2.0)}
    assert "CartesianProduct" not in cut.cut(px, table, frame)._jdf.queryExecution().executedPlan().toString()
    only = spark.createDataFrame([("t", "A")], "slide string, element string")
    assert {r.slide for r in cut.cut_all(px, only, table, frame).collect()} == {"t"}


def test_means_of_candidates_by_slide(spark):
    px, _, _ = two_slides(spark)
    masks_ = spark.createDataFrame([(s, 1, 3, 3) for s in "st"], "slide string, cand_id bigint, y int, x int")
    assert {(r.slide, r.mean_int) for r in rois.mask_intensity(masks_, px).collect()} == {("s", 1.0), ("t", 2.0)}
    boxes = spark.createDataFrame([(s, 1, 0, 0, 10, 10, 0.9, 0.9) for s in "st"], "slide string, ordinal bigint, x int, y int, w int, h int, predicted_iou double, stability_score double")
    assert [r.slide for r in rois.refine(boxes, 1, 1000, 0, 0, rois.mask_intensity(masks_, px, 1.5)).collect()] == ["t"]


def test_arrivals_of_several_slides(spark, tmp_path):
    px, frame, table = two_slides(spark)
    place, schema = f"file://{tmp_path}", "slide string, element string, y int, x int, value double"
    def arrive(df):
        df.select("slide", "element", F.col("y").cast("int"), F.col("x").cast("int"), "value").coalesce(1).write.mode("append").parquet(f"{place}/in")
        arrivals.stream_cut(spark, f"{place}/in", schema, table, frame, f"{place}/out", f"{place}/state").awaitTermination()
        got = spark.read.parquet(f"{place}/out").groupBy("slide", "roi", "element").agg(F.count("*").alias("n"), F.avg("value").alias("v")).collect()
        return {(r.slide, r.roi, r.element): (r.n, r.v) for r in got}

    first = {("s", "a", "A"): (225, 1.0), ("t", "b", "A"): (49, 2.0)}
    assert arrive(px) == first  # two slides in a batch
    assert arrive(px.withColumn("value", F.lit(9.0))) == first  # the same channels again are dropped
    catalog = frame.select("slide", "element")
    assert {r.slide for r in arrivals.ready_slides(catalog.where("slide = 't'"), catalog).collect()} == {"t"}


def test_channel_rules(spark):
    names = ["S_1.0.4_R000_dapi_A-x_F.tif", "S_2.0.4_R000_DAPI_A-x_F.tif", "S_1.0.4_R000_Cy3_CD3-AF_F.tif", "S_3.0.4_R000_Cy3_CD3-AF_F.tiff", "S_2.0.4_R000_Cy5_HLA-DR-AF647_F.tif", "notes.tif"]
    parsed = channels.parse_channels(spark.createDataFrame(list(enumerate(names)), "ordinal bigint, path string"))
    pick = lambda **k: {r.marker: r.channel for r in channels.select_channels(parsed, **k).collect()}
    assert pick() == {"DAPI": "001_DAPI", "CD3": "003_CD3", "HLA-DR": "002_HLA-DR"}
    assert pick(include=["001_CD3"])["CD3"] == "001_CD3"
    assert pick(include=["002_DAPI"])["DAPI"] == "002_DAPI"
    assert "DAPI" not in pick(exclude=["001_DAPI"])
    assert pick(include=["003_CD3"], exclude=["003_CD3"])["CD3"] == "003_CD3"
    assert set(pick(use=["CD3", "DAPI"], ignore=["DAPI"])) == {"CD3"}
    assert [r.marker for r in channels.unknown_markers(parsed, ["CD3", "CD99"]).collect()] == ["CD99"]
    table = lambda column, *names: spark.createDataFrame([(n,) for n in names], f"{column} string")
    assert pick(include=table("channel", "001_CD3"), use=table("marker", "CD3", "DAPI"), ignore=table("marker", "DAPI")) == {"CD3": "001_CD3"}
    assert "DAPI" not in pick(exclude=table("channel", "001_DAPI")) and pick(include=table("channel"), use=table("marker")) == {}
    chosen = channels.select_channels(parsed)
    assert channels.require_channels(chosen, parsed) is chosen
    with pytest.raises(FileNotFoundError, match="003_CD3"):
        channels.require_channels(chosen, parsed.where("channel <> '003_CD3'"))
    with pytest.raises(ValueError):
        channels.select_channels(parsed.limit(0))


def test_region_shapes(spark):
    a = np.zeros((12, 12), int)
    a[1:6, 1:6] = 1
    a[3, 3] = 0  # a hole
    a[7:11, 7:9] = 2
    got = {r.label: r for r in regions.basic(labels(spark, a)).collect()}
    assert got[1].area == 24 and got[2]["centroid-0"] == 8.5 and got[2]["bbox-3"] == 9
    assert got[2].eccentricity == pytest.approx(np.sqrt(1 - 0.25 / 1.25)) and abs(got[2].orientation) < 1e-9
    assert {r.label: r.euler_number for r in regions.euler_number(labels(spark, a)).collect()} == {1: 0, 2: 1}
    assert {r.label: r.area_filled for r in regions.filled(labels(spark, a)).collect()} == {1: 25, 2: 8}
    hull = {r.label: r for r in regions.hull(labels(spark, a)).collect()}
    assert hull[1].area_convex == 25 and hull[2].solidity == 1.0 and hull[2].feret_diameter_max == pytest.approx(np.hypot(4, 1), abs=0.3)
    line = np.zeros((3, 8), int)
    line[1, 1:7] = 1
    assert regions.perimeter(labels(spark, line)).first().perimeter == pytest.approx(4.0)


def test_intensity_and_registry(spark):
    a = np.zeros((4, 4), int)
    a[:2, :2] = 1
    image = np.arange(16.0).reshape(4, 4)
    r = intensity.intensity(pixels(spark, image), labels(spark, a), list(intensity.METRICS)).first()
    inside = image[:2, :2]
    assert (r["mean"], r["median"], r["min"], r["max"], r["sum"]) == (inside.mean(), np.median(inside), 0, 5, inside.sum()) and r["std"] == pytest.approx(inside.std())
    with pytest.raises(ValueError):
        intensity.intensity(pixels(spark, image), labels(spark, a), ["nothing"])
    with pytest.raises(ValueError):
        intensity.register_metric("mean", F.avg)


def test_pixels_under_labels_meet_by_tiles(spark):
    """As by a join on pixels, with labels that overlap, are null or large, and places below zero; an object stays in one partition."""
    rng, big = np.random.default_rng(5), 2**60
    at = [("S0" if i % 2 else "S1", "R0", int(y), int(x)) for i, (y, x) in enumerate(rng.integers(-70, 140, (3000, 2)))]
    px = spark.createDataFrame([(*p, "AB"[i % 2], float(i)) for i, p in enumerate(at)] + [("S0", "R0", None, 1, "A", 1.0)], "slide string, roi string, y int, x int, element string, value double")
    names = [big, big + 1, None, 7, 7]
    lb = spark.createDataFrame([(*p, [None, "cell", "nucleus"][i % 3], names[i % 5]) for i, p in enumerate(at[::2] + at[::3])] + [("S0", "R0", None, 1, "cell", 1), (None, "R0", 0, 0, "cell", 1)], "slide string, roi string, y int, x int, element string, label bigint")
    on = ["slide", "roi", "y", "x"]
    plain = lb.withColumnRenamed("element", "mask").join(px.withColumnRenamed("element", "channel"), on).select(*on, "mask", "label", "channel", "value")
    assert sorted(map(repr, intensity.under(px, lb).collect())) == sorted(map(repr, plain.collect()))
    area = np.arange(128 * 128).reshape(128, 128) // 128 // 16 * 8 + np.arange(128) // 16 + 1
    places = intensity.under(pixels(spark, area), labels(spark, area)).select("label", F.spark_partition_id()).distinct()
    assert places.count() == 64


def test_exclusion_by_marker(spark):
    points = spark.createDataFrame([("R0", 1, 10.0, 10.0), ("R0", 2, 50.0, 50.0), ("R0", 3, 20.0, 5.0), ("R0", 4, None, None)], "roi string, label int, x double, y double")
    ring = [{"x": 0.0, "y": 0.0}, {"x": 20.0, "y": 0.0}, {"x": 20.0, "y": 20.0}, {"x": 0.0, "y": 20.0}]
    shapes = spark.createDataFrame([("R0", "qc_exclude_A", ring)], "roi string, shape_key string, ring array<struct<x:double,y:double>>")
    table = points.select("roi", "label").crossJoin(spark.createDataFrame([("A_mean_cell",), ("A_norm_max_cell",), ("B_mean_cell",)], "feature string"))
    got = {(r.label, r.feature): r.keep for r in objects.qc_mask(table, points, shapes).collect()}
    assert [got[k, "A_mean_cell"] for k in (1, 2, 3, 4)] == [False, True, False, True]  # the edge counts as inside
    assert not got[1, "A_norm_max_cell"] and all(got[k, "B_mean_cell"] for k in (1, 2, 3, 4))


def test_wide_tables(spark):
    df = spark.createDataFrame([(1, 2.0, 3.0, 4.0)], "`label` int, `centroid-1_cell` double, `centroid-0_cell` double, `only-0_cell` double")
    packed = objects.pack_arrays(df)
    assert packed.first()["centroid_cell"] == [3.0, 2.0] and "only-0_cell" in packed.columns
    with pytest.raises(ValueError):
        objects.link_region(df, "x", ["cell"])


def test_boxes(spark):
    boxes = spark.createDataFrame([("s", 1, 0, 0, 10, 10, 0.9), ("s", 2, 5, 5, 10, 10, 0.8), ("s", 3, 10, 0, 10, 5, 0.7), ("t", 4, 0, 0, 10, 10, 0.1)], "slide string, ordinal int, x int, y int, w int, h int, predicted_iou double")
    assert {(r.a, r.b) for r in rois.overlap_pairs(boxes, 4).collect()} == {(1, 2)}  # touching is not overlapping
    assert {r.ordinal for r in rois.nms(boxes).collect()} == {1, 3, 4}


def test_clip(spark):
    ring = [{"row": -10.0, "col": 5.0}, {"row": 10.0, "col": 5.0}, {"row": 10.0, "col": 25.0}, {"row": -10.0, "col": 25.0}]
    df = spark.createDataFrame([(1, ring), (2, [{k: v + 500 for k, v in p.items()} for p in ring])], "id int, ring array<struct<row:double,col:double>>")
    out = geometry.clip_rings(df, F.lit(100), F.lit(20)).collect()
    assert [r.id for r in out] == [1] and {(v.row, v.col) for v in out[0].ring} == {(0.0, 5.0), (10.0, 5.0), (10.0, 20.0), (0.0, 20.0)}


def test_quantified_objects(spark):
    cell, nucleus = np.zeros((20, 20), int), np.zeros((20, 20), int)
    cell[1:9, 1:9], cell[12:18, 12:18], nucleus[3:6, 3:6], nucleus[14, 14] = 1, 2, 1, 3
    image = np.arange(400.0).reshape(20, 20)
    image_b = pixels(spark, image[:10] * 2, "B")  # has no pixel under object 2
    own = labels(spark, cell).unionByName(labels(spark, nucleus, "nucleus"))
    px = pixels(spark, image).unionByName(image_b)
    ring = [{"x": 0.0, "y": 0.0}, {"x": 9.0, "y": 0.0}, {"x": 9.0, "y": 9.0}, {"x": 0.0, "y": 9.0}]
    shapes = spark.createDataFrame([("R0", "qc_exclude_A", ring)], "roi string, shape_key string, ring array<struct<x:double,y:double>>")
    got = plan.quantify(px, own, shapes).toPandas()
    assert len(got) == 3 * 8 and set(got.label) == {1, 2, 3}  # each object of either mask, each feature
    one = got[(got.label == 1)].set_index("feature")
    assert one.value["A_mean_cell"] == image[1:9, 1:9].mean() and one.value["B_median_nucleus"] == np.median(image[3:6, 3:6] * 2)
    assert not one.keep["A_mean_nucleus"] and one.keep["B_mean_cell"]
    first = one.iloc[0]
    assert (first.area_cell, first.area_nucleus, first.solidity_cell, first.euler_number_cell, first["centroid-0_nucleus"]) == (64, 9, 1.0, 1, 4.0)
    assert first.perimeter_cell == 28.0 and first.eccentricity_cell == 0.0
    two, three = got[got.label == 2].set_index("feature"), got[got.label == 3].set_index("feature")
    assert pd.isna(two.value["B_mean_cell"]) and two.value["A_mean_cell"] > 0 and pd.isna(two.area_nucleus.iloc[0])
    assert pd.isna(three.area_cell.iloc[0]) and three.value["A_mean_nucleus"] == image[14, 14]
    with pytest.raises(ValueError, match="nothing.*cell.*nucleus"):
        plan.quantify(px, own, masks={"cell": "cell", "x": "nothing"})
    with pytest.raises(ValueError, match="C.*A.*B"):
        plan.quantify(px, own, channels=["A", "C"])
    with pytest.raises(ValueError, match="centroid"):
        plan.quantify(px, own, shapes, masks={"n": "nucleus"})
    with pytest.raises(ValueError, match="unknown properties"):
        plan.quantify(px, own, properties=["colour"])
    some = plan.quantify(px, own, masks={"c": "cell"}, channels=["A"], metrics=["max"], properties=["area", "bbox", "area_filled"])
    assert some.columns == ["roi", "label", "area_c", "bbox-0_c", "bbox-1_c", "bbox-2_c", "bbox-3_c", "area_filled_c", "value", "feature", "keep"]


def test_exclusion_afterwards_warns(spark):
    table = spark.createDataFrame([("R0", 1, "A_mean_cell", 1.0)], "roi string, label int, feature string, value double")
    points = spark.createDataFrame([("R0", 1, 1.0, 1.0)], "roi string, label int, x double, y double")
    shapes = spark.createDataFrame([("R0", "qc_exclude_Z", [])], "roi string, shape_key string, ring array<struct<x:double,y:double>>")
    with pytest.warns(UserWarning, match="no exclusion shapes"):
        plan.qc_after(table, points, shapes)


def test_output_types(spark):
    got = plan.typed(labels(spark, np.eye(3, dtype=int)).withColumn("label", F.col("label").cast("double")), "labels")
    assert dict(got.dtypes)["label"] == "int" and got.count() == 3
    assert plan.typed(pixels(spark, np.ones((2, 2))), "image").columns == ["roi", "element", "c", "y", "x", "value"]
    with pytest.raises(ValueError):
        plan.typed(got, "table")


def test_sinks_and_sources(spark, tmp_path):
    place = f"file://{tmp_path}"
    one = pixels(spark, np.arange(6.0).reshape(2, 3))
    tables.write_element(one, f"{place}/e")
    with pytest.raises(ValueError, match="stored already"):
        tables.write_element(one, f"{place}/e")
    tables.write_element(one.withColumn("value", F.lit(1.0)), f"{place}/e", overwrite=True)
    assert tables.read_stored(spark, f"{place}/e").agg(F.sum("value")).first()[0] == 6.0
    tables.write_table(one, f"{place}/t", "x")
    with pytest.raises(ValueError, match="stored already"):
        tables.write_table(one, f"{place}/t", "x")
    one.write.parquet(f"{place}/l")
    assert {r.path.rpartition(".")[2] for r in tables.list_files(spark, f"{place}/l", "*.parquet").collect()} == {"parquet"}
    ring = [{"row": 1.0, "col": 2.0}]
    shapes = spark.createDataFrame([("R0", "a", ring), ("R0", "b", ring)], "roi string, shape_key string, ring array<struct<row:double,col:double>>")
    tables.write_shapes(shapes, f"{place}/s", order="yx")
    tables.write_shapes(shapes.where("shape_key = 'a'").withColumn("roi", F.lit("R1")), f"{place}/s", order="yx")  # another ROI's layer of the name
    tables.write_shapes(shapes.where("shape_key = 'c'"), f"{place}/s", order="yx", layers=["a"], rois=shapes)
    back = tables.read_stored(spark, f"{place}/s").collect()
    assert sorted((r.roi, r.shape_key, r.ring[0].x, r.ring[0].y) for r in back) == [("R0", "b", 2.0, 1.0), ("R1", "a", 2.0, 1.0)]
    tables.write_shapes(shapes.limit(0), f"{place}/s", layers=["a"])
    assert [(r.roi, r.shape_key) for r in tables.read_stored(spark, f"{place}/s").collect()] == [("R0", "b")]
    cut_ = on_slide(one, "s")
    with pytest.raises(ValueError, match="no pixels for t R0"):
        tables.assemble_rois(cut_, f"{place}/a", expected=spark.createDataFrame([("s", "R0"), ("t", "R0")], "slide string, roi string"))
    tables.assemble_rois(cut_, f"{place}/a", allowed=["A"], tile=2)
    assert tables.read_stored(spark, f"{place}/a").count() == 6
    table = spark.createDataFrame([("s", "r", 4, 8, 4, 8, "polygon", [{"row": 4.0, "col": 8.0}])], ROI)
    tables.write_rois(table, f"{place}/r", f"{place}/csv")
    assert tables.read_rois(spark, f"{place}/r", 2).first().polygon_vertices[0].col == 2.0
    assert spark.read.csv(f"{place}/csv", header=True).first().polygon_vertices == '[{"row":4.0,"col":8.0}]'


def test_pyramid_and_parameters(spark):
    image = np.random.default_rng(2).integers(0, 99, (7, 10)).astype(float)
    got = cut.pyramid(pixels(spark, image), 3).toPandas()
    for level in (0, 1, 2):
        f, own = 1 << level, got[got.level == level].set_index(["y", "x"]).value
        blocks = {(i, j): image[i * f : (i + 1) * f, j * f : (j + 1) * f].mean() for i in range(-(-7 // f)) for j in range(-(-10 // f))}
        assert len(own) == len(blocks) and all(own[k] == pytest.approx(v) for k, v in blocks.items())
    for call in (lambda: cut.pyramid(pixels(spark, image), 0), lambda: cut.pyramid(pixels(spark, image), 2, 1), lambda: cut.upsample(pixels(spark, image), 0)):
        with pytest.raises(ValueError):
            call()


def test_perimeter_and_filling_of_winding_objects(spark):
    rng = np.random.default_rng(9)
    area = np.where(rng.random((40, 37)) < 0.6, 1, 0)
    area[30:, 20:] = 2
    got = {r.label: r.perimeter for r in regions.perimeter(labels(spark, area), tile=7).collect()}
    filled = {r.label: r.area_filled for r in regions.filled(labels(spark, area)).collect()}
    for k in (1, 2):
        own = np.pad(area == k, 1)
        border = own & ~(np.pad(own[2:, 1:-1] & own[:-2, 1:-1] & own[1:-1, 2:] & own[1:-1, :-2], 1))
        total = 0.0
        for y, x in np.argwhere(border):
            code = 1 + 2 * sum(border[y + a, x + b] for a, b in masks.SIDES) + 10 * sum(border[y + a, x + b] for a in (-1, 1) for b in (-1, 1))
            total += next((w for w, codes in regions.PERIMETER.items() if code in codes), 0)
        assert got[k] == pytest.approx(total)
        ys, xs = np.nonzero(own)
        out, todo = set(), [(ys.min() - 1, xs.min() - 1)]
        while todo:
            y, x = todo.pop()
            if (y, x) not in out and ys.min() - 1 <= y <= ys.max() + 1 and xs.min() - 1 <= x <= xs.max() + 1 and not own[y, x]:
                out.add((y, x))
                todo += [(y + a, x + b) for a, b in masks.SIDES]
        assert filled[k] == (np.ptp(ys) + 3) * (np.ptp(xs) + 3) - len(out)


def test_steps(spark):
    one = labels(spark, np.eye(3, dtype=int))
    with pytest.raises(ValueError):
        plan.run_steps({"a": one}, [(lambda x: x, ["b"], ["c"])])
    with pytest.raises(ValueError):
        plan.run_steps({"a": one}, [(lambda x: [x, x], ["a"], ["c"])])


def test_segmentation_takes_bounded_tiles(spark):
    image = np.random.default_rng(5).integers(0, 9, (2, 70, 53)).astype(float)
    df = pixels(spark, image[0], "A").unionByName(pixels(spark, image[1], "B"))

    def bright(part):
        assert part.shape[1] <= 24 and part.shape[2] <= 24
        return {"bright": (part[0] > part[1]).astype("int32")}

    got = segment.segment_objects(df, bright, ["A", "B"], tile=16, halo=4)
    assert (array(got, (70, 53)) == (image[0] > image[1])).all() and got.count() == (image[0] > image[1]).sum()


def test_segmented_objects_across_seams(spark):
    image = np.zeros((70, 53))
    boxes = [(y, x) for y in range(1, 62, 7) for x in range(2, 46, 7)]
    for y, x in boxes:
        image[y : y + 4, x : x + 4] = 1

    def squares(part):
        # numbers each full square by its first pixel, in no order of the image
        up, left = np.pad(part[0], ((1, 0), (0, 0)))[:-1], np.pad(part[0], ((0, 0), (1, 0)))[:, :-1]
        out = np.zeros(part[0].shape, "int32")
        for i, (y, x) in enumerate(np.argwhere((part[0] > 0) & (up == 0) & (left == 0))):
            out[y : y + 4, x : x + 4] = i + 1
        return {"cell": np.where(part[0] > 0, out, 0)}

    got = segment.segment_objects(pixels(spark, image), squares, ["A"], tile=16, halo=5, instances=True)
    found = array(got, (70, 53))
    assert ((found > 0) == (image > 0)).all() and got.count() == (image > 0).sum()
    assert sorted(int(found[y, x]) for y, x in boxes) == list(range(1, len(boxes) + 1))
    assert all((found[y : y + 4, x : x + 4] == found[y, x]).all() for y, x in boxes)


def test_slides_with_equal_names_of_rois(spark, tmp_path):
    """Two slides' ROI_000 are stored in turn, measured and masked apart."""
    px = on_slide(pixels(spark, np.full((12, 12), 1.0)), "s").unionByName(on_slide(pixels(spark, np.full((12, 12), 100.0)), "t"))
    area = np.zeros((12, 12), int)
    area[2:6, 2:6] = 1
    lb = on_slide(labels(spark, area), "s").unionByName(on_slide(labels(spark, area.T[::-1].copy()), "t"))
    place = f"file://{tmp_path}/a"
    for slide in "st":
        tables.assemble_rois(px.where(F.col("slide") == slide), place, tile=4)
    assert {(r.slide, r.v, r.n) for r in tables.read_stored(spark, place).groupBy("slide").agg(F.avg("value").alias("v"), F.count("*").alias("n")).collect()} == {("s", 1.0, 144), ("t", 100.0, 144)}
    got = {r.slide: r["mean"] for r in intensity.intensity(px, lb).collect()}
    assert got == {"s": 1.0, "t": 100.0}
    frame = on_slide(extent(spark, 12, 12), "s").unionByName(on_slide(extent(spark, 12, 12), "t"))
    for of in (lambda l, e: masks.expand(l, 2, e), lambda l, e: masks.erode(l, 1, e), lambda l, e: masks.ring(l, e, 2, 1), lambda l, e: masks.blob(l, e, (6, 6), 1)):
        both = of(lb, frame)
        for slide in "st":
            alone = of(lb.where(F.col("slide") == slide).drop("slide"), frame.where(F.col("slide") == slide).drop("slide"))
            assert sorted(map(tuple, both.where(F.col("slide") == slide).drop("slide").collect())) == sorted(map(tuple, alone.collect()))
    ring = [{"x": 0.0, "y": 0.0}, {"x": 9.0, "y": 0.0}, {"x": 9.0, "y": 6.0}, {"x": 0.0, "y": 6.0}]
    shapes = spark.createDataFrame([("s", "R0", "qc_exclude_A", ring)], "slide string, roi string, shape_key string, ring array<struct<x:double,y:double>>")
    table = plan.quantify(px, lb, shapes, properties=list(regions.PROPERTIES))
    assert {(r.slide, r.feature, r.value, r.keep) for r in table.collect()} == {(s, f"A_{m}_cell", v, s == "t") for s, v in (("s", 1.0), ("t", 100.0)) for m in ("mean", "median")}
    assert {r.label: (r.num_pixels_cell, len(r.coords_cell)) for r in table.collect()} == {1: (16, 16)} and "moments_hu-6_cell" in table.columns and "inertia_tensor-1-0_cell" in table.columns
    assert enhance.percentiles(px, [0.5]).count() == 2 and segment.label_components(lb, 12).select("slide", "label").distinct().count() == 2
    with pytest.raises(ValueError, match="slide"):
        intensity.intensity(px, lb.drop("slide"))


def test_stores_read_few_files_of_a_tile(spark, tmp_path):
    place, image = f"file://{tmp_path}/s", np.arange(64.0 * 64).reshape(64, 64)
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # as many files as there are shuffle partitions
    try:
        tables.write_element(on_slide(pixels(spark, image), "s"), place, tile=8)
        tables.write_element(on_slide(pixels(spark, image), "t"), place, tile=8)
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    from cellgrid.sources.store import Store, curve, curve_of

    store = Store.open(spark, place)
    one = store.files({"slide": "s"}, [(3, 5)])
    assert store.key == ["slide", "roi", "element"] and store.tile == 8 and len(one) <= 2 < 4 <= len(store.files()) / 2
    got = tables.read_stored(spark, place, {"slide": "s"}, [(3, 5)]).collect()
    assert sorted(r.value for r in got) == sorted(image[24:32, 40:48].ravel())
    assert tables.read_stored(spark, place, {"slide": "u"}).count() == 0
    places = spark.range(256).select((F.col("id") % 16).alias("y"), F.floor(F.col("id") / 16).alias("x")).withColumn("z", curve(F.col("y"), F.col("x"))).collect()
    assert all(r.z == curve_of(r.y, r.x) for r in places) and sorted(r.z for r in places) == list(range(256))


def test_a_table_is_replaced_by_what_it_gives(spark, tmp_path, monkeypatch):
    from cellgrid.sources.store import Store

    place = f"file://{tmp_path}/t"
    rows = [("s", "R0", 1, "A_mean_cell", 1.0), ("s", "R0", 2, "A_mean_cell", 2.0), ("t", "R0", 1, "A_mean_cell", 3.0)]
    table = spark.createDataFrame(rows, "slide string, roi string, label int, feature string, value double")
    tables.write_table(table, place, "objects")
    tables.write_table(table.where("slide = 't'"), place, "others")
    points = spark.createDataFrame([("s", "R0", 1, 1.0, 1.0)], "slide string, roi string, label int, x double, y double")
    ring = [{"x": 0.0, "y": 0.0}, {"x": 2.0, "y": 0.0}, {"x": 2.0, "y": 2.0}]
    shapes = spark.createDataFrame([("s", "R0", "qc_exclude_A", ring)], "slide string, roi string, shape_key string, ring array<struct<x:double,y:double>>")
    with monkeypatch.context() as m:  # the files are there, but the write ends before its commit
        m.setattr(Store, "_commit", lambda *a: (_ for _ in ()).throw(KeyboardInterrupt()))
        with pytest.raises(KeyboardInterrupt):
            plan.rewrite_qc(spark, place, "objects", points, shapes)
    stored_ = lambda: {(r.table_name, r.slide, r.label): r.asDict().get("keep") for r in tables.read_stored(spark, place).collect()}
    assert set(stored_().values()) == {None} and len(stored_()) == 4
    plan.rewrite_qc(spark, place, "objects", points, shapes)
    got = tables.read_stored(spark, place, {"table_name": "objects"}).collect()
    assert {(r.slide, r.label): r.keep for r in got} == {("s", 1): False, ("s", 2): True, ("t", 1): True}
    assert tables.read_stored(spark, place, {"table_name": "others"}).count() == 1
    store = Store.open(spark, place)
    base = store.version()
    store._commit(store.manifest(), base)
    with pytest.raises(RuntimeError, match="another write"):
        store._commit(store.manifest(), base)
    assert store.clean() > 0 and tables.read_stored(spark, place).count() == 4
    (tmp_path / "t" / "claims" / str(store.version() + 1)).touch()  # a writer died while it committed
    with pytest.raises(RuntimeError, match="unlock"):
        tables.write_table(table, place, "objects", overwrite=True)
    store.unlock()
    tables.write_table(table, place, "objects", overwrite=True)


def test_filling_over_strips(spark):
    rng = np.random.default_rng(4)
    area = np.where(rng.random((60, 50)) < 0.62, 1, 0)
    spiral = np.zeros((60, 50), int)
    spiral[5:55, 5:45], spiral[8:52, 8:42], spiral[20:40, 15:30], spiral[25:30, 18:25] = 2, 0, 2, 0  # a ring, an island in it, a hole in that
    want = {k: {r.label: r.area_filled for r in regions.filled(labels(spark, a)).collect()} for k, a in (("a", area), ("s", spiral))}
    assert want["s"] == {2: 50 * 40}
    for strip in (2, 3, 7, 16):
        for k, a in (("a", area), ("s", spiral)):
            assert {r.label: r.area_filled for r in regions.filled(labels(spark, a), strip).collect()} == want[k]


def test_hulls_of_random_objects(spark):
    rng = np.random.default_rng(6)
    area = np.zeros((90, 90), int)
    for k in range(1, 10):
        y, x = (10 + 30 * i for i in divmod(k - 1, 3))
        pts = rng.integers(-9, 10, (rng.integers(1, 30), 2))
        area[y + pts[:, 0], x + pts[:, 1]] = k
    got = {r.label: r for r in regions.hull(labels(spark, area)).collect()}
    for k in range(1, 10):
        y, x = np.nonzero(area == k)
        pts = np.concatenate([np.stack([y + a, x + b], 1) for a, b in ((0.5, 0), (-0.5, 0), (0, 0.5), (0, -0.5))])
        feret = max(np.hypot(*(pts - p).T).max() for p in pts)
        # a centre is in the hull if no line through two corners has it on one side and all corners on the other
        lines = [(p, q) for p in pts for q in pts if (p != q).any() and (((q - p)[0] * (pts - p)[:, 1] - (q - p)[1] * (pts - p)[:, 0]) >= 0).all()]
        inside = sum(all((q - p)[0] * (j - p[1]) - (q - p)[1] * (i - p[0]) >= -1e-9 for p, q in lines) for i in range(y.min(), y.max() + 1) for j in range(x.min(), x.max() + 1))
        assert got[k].feret_diameter_max == pytest.approx(feret) and got[k].area_convex == inside and got[k].area == len(y)


def test_nearest_seeds():
    rng = np.random.default_rng(8)
    for h, w, share in ((1, 9, 0.3), (9, 1, 0.3), (17, 23, 0.02), (20, 20, 0.3), (8, 8, 0.0)):
        seeds = np.where(rng.random((h, w)) < share, rng.integers(1, 2**31 - 1, (h, w)), 0).astype(np.int32)
        d2, label = masks.nearest(seeds)
        ys, xs = np.nonzero(seeds)
        for y in range(h):
            for x in range(w):
                own = sorted(((a - y) ** 2 + (b - x) ** 2, seeds[a, b]) for a, b in zip(ys, xs))
                assert (d2[y, x], label[y, x]) == (own[0] if own else (np.iinfo(np.int64).max, 0))


def test_model_is_loaded_once_a_worker(spark, tmp_path):
    image = np.random.default_rng(5).integers(0, 9, (64, 64)).astype(float)

    def load():
        (tmp_path / f"load-{uuid.uuid4().hex}").touch()

        def batch(parts):
            assert 1 <= len(parts) <= 3
            (tmp_path / f"batch-{uuid.uuid4().hex}").touch()
            return [{"bright": (p[0] > 4).astype("int32")} for p in parts]

        return batch

    got = segment.segment_objects(pixels(spark, image), None, ["A"], tile=8, halo=1, load=load, batch=3)
    assert (array(got, (64, 64)) == (image > 4)).all()
    loads, batches = (len(list(tmp_path.glob(f"{k}-*"))) for k in ("load", "batch"))
    assert loads <= spark.sparkContext.defaultParallelism < batches < 64  # fewer than tiles, more than loads
    with pytest.raises(ValueError):
        segment.segment_objects(pixels(spark, image), None, ["A"])


def test_suppression_of_a_long_chain(spark, monkeypatch):
    """Each box overlaps the next and is outranked by it: a box depends on all those after it."""
    n = 10_000
    boxes = spark.range(n).selectExpr("'s' as slide", "id as ordinal", "int(id % 100 * 9) as x", "int(id div 100 * 20) as y", "int(10) as w", "int(10) as h", "id / 10000.0D as predicted_iou")
    rounds = []
    monkeypatch.setattr(rois, "stored", lambda df, of=rois.stored: rounds.append(1) or of(df))
    kept = {r.ordinal for r in rois.nms(boxes).collect()}
    assert len(rounds) <= 4  # the overlaps, and one round
    assert kept == {100 * row + c for row in range(100) for c in range(99, -1, -2)}
    rng = np.random.default_rng(2)
    rows = [("s", int(i), int(rng.integers(0, 900)), int(rng.integers(0, 900)), int(rng.integers(5, 60)), int(rng.integers(5, 60)), float(rng.integers(0, 20))) for i in range(600)]
    some = spark.createDataFrame(rows, "slide string, ordinal bigint, x int, y int, w int, h int, predicted_iou double")
    want = []
    for b in sorted(rows, key=lambda r: (-r[6], r[1])):
        if not any(b[2] < k[2] + k[4] and k[2] < b[2] + b[4] and b[3] < k[3] + k[5] and k[3] < b[3] + b[5] for k in want):
            want.append(b)
    assert {r.ordinal for r in rois.nms(some, cell=16, most=20).collect()} == {b[1] for b in want}  # small tiles, several rounds


def test_clipping_into_parts(spark):
    arch = [(-5, 0), (20, 0), (20, 10), (-2, 10), (-2, 20), (20, 20), (20, 30), (-5, 30)]
    comb = [(5, 5), (5, 60), (-5, 50), (-5, 40), (3, 35), (-5, 30), (-5, 20), (2, 15)]
    inside = [(1, 1), (5, 1), (5, 5)]
    rows = [(k, [{"row": float(r), "col": float(c)} for r, c in ring]) for k, ring in enumerate((arch, comb, inside, [(-9, 0), (-1, 5), (-9, 9)]))] + [(4, None)]
    got = geometry.clip_rings(spark.createDataFrame(rows, "id int, ring array<struct<row:double,col:double>>"), F.lit(100), F.lit(25)).collect()
    parts = {(r.id, r.part): {(v.row, v.col) for v in r.ring} for r in got}
    assert parts[0, 0] == {(0, 0), (20, 0), (20, 10), (0, 10)} and parts[0, 1] == {(0, 20), (20, 20), (20, 25), (0, 25)}
    assert parts[2, 0] == set(inside) and {k for k, _ in parts} == {0, 1, 2}
    area = lambda ring: abs(sum(a[0] * b[1] - a[1] * b[0] for a, b in zip(ring, [*ring[1:], ring[0]]))) / 2
    rng = np.random.default_rng(3)
    for _ in range(40):  # stars, cut by a frame; the area that is left against a count of fine cells
        turn, far = np.sort(rng.random(9)) * 2 * np.pi, rng.uniform(2, 14, 9)
        ring = [(10 + f * np.sin(t), 10 + f * np.cos(t)) for t, f in zip(turn, far)]
        left = geometry.clip_ring(ring, 16.0, 18.0)
        y, x = (g.ravel() for g in np.mgrid[0.05:16:0.1, 0.05:18:0.1])
        odd = np.zeros(len(y), bool)
        for (ay, ax), (by, bx) in zip(ring, [*ring[1:], ring[0]]):
            odd ^= ((ay > y) != (by > y)) & (x < (bx - ax) * (y - ay) / (by - ay) + ax)
        assert sum(map(area, left)) == pytest.approx(odd.sum() * 0.01, abs=2.0)
        assert all(0 <= r <= 16 and 0 <= c <= 18 for part in left for r, c in part)


def test_sketches_of_tiles_merge(spark):
    rng = np.random.default_rng(12)
    image = rng.gamma(2, 50, (200, 200))
    area = np.ones((200, 200), int)
    area[:, :3] = 2  # few pixels: exact
    sketched = intensity.sketches(pixels(spark, image), labels(spark, area), 32)
    assert sketched.count() >= 49
    got = {r.label: (r.n, r.value) for r in intensity.quantiles(sketched, 0.5).collect()}
    for k in (1, 2):
        own = np.sort(image[area == k])
        rank = np.searchsorted(own, got[k][1]) / len(own)
        assert got[k][0] == len(own) and abs(rank - 0.5) < (intensity.RANK_ERROR if k == 1 else 0.005)
    one = {r.label: r.median_approx for r in intensity.intensity(pixels(spark, image), labels(spark, area), ["median_approx"]).collect()}
    assert abs((image[area == 1] < one[1]).mean() - 0.5) < intensity.RANK_ERROR


def test_shared_steps_run_once(spark):
    count = spark.sparkContext.accumulator(0)

    def counted(df):
        def run(batches):
            for pdf in batches:
                count.add(len(pdf))
                yield pdf

        return df.mapInPandas(run, df.schema)

    one = labels(spark, np.eye(5, dtype=int))
    twice = [(counted, ["a"], ["b"]), (lambda b: b.where("y < 3"), ["b"], ["c"]), (lambda b: b.where("y >= 3"), ["b"], ["d"]), (lambda c, d: c.unionByName(d), ["c", "d"], ["e"])]
    made = plan.run_steps({"a": one}, twice)
    assert made["e"].count() == 5 and count.value == 5
    made = plan.run_steps({"a": one}, [(counted, ["a"], ["b"]), (lambda b: b, ["b"], ["c"])])
    assert count.value == 5  # nothing is worked out until it is read
    made = plan.run_steps({"a": one}, [(counted, ["a"], ["b"]), (lambda b: b, ["b"], ["c"])], keep=["b"])
    assert made["c"].count() == made["b"].count() == 5 and count.value == 10
    # a name that is made anew
    made = plan.run_steps({"a": one}, [(counted, ["a"], ["a"]), (lambda a: a.limit(1), ["a"], ["a"])])
    assert made["a"].count() == 1
    with pytest.raises(ValueError, match="no step makes"):
        plan.run_steps({"a": one}, twice, keep=["z"])


def test_slides_are_assembled_once_they_are_complete(spark, tmp_path, monkeypatch):
    px, frame, table = two_slides(spark)
    frame = frame.unionByName(frame.withColumn("element", F.lit("B")))
    place, schema = f"file://{tmp_path}", "slide string, element string, y int, x int, value double"
    calls = []
    monkeypatch.setattr(arrivals, "assemble_rois", lambda own, store, of=arrivals.assemble_rois: calls.append(sorted({r.slide for r in own.select("slide").distinct().collect()})) or of(own, store))

    def arrive(*dfs, **more):
        for df in dfs:
            df.select("slide", "element", F.col("y").cast("int"), F.col("x").cast("int"), "value").coalesce(1).write.mode("append").parquet(f"{place}/in")
        q = arrivals.stream_cut(spark, f"{place}/in", schema, table, frame, f"{place}/out", f"{place}/state", store=f"{place}/store", **more)
        q.awaitTermination()

    a, b = px, px.withColumns({"element": F.lit("B"), "value": F.col("value") * 10})
    s, t = F.col("slide") == "s", F.col("slide") == "t"
    arrive(a.where(s), a.where(t), b.where(s), b.where(s).withColumn("value", F.lit(-1.0)))  # four files in a trigger, one channel twice
    assert calls == [["s"]]
    broken = arrivals.cut
    monkeypatch.setattr(arrivals, "cut", lambda *a_: (_ for _ in ()).throw(RuntimeError("lost")))
    with pytest.raises(Exception, match="lost"):
        arrive(b.where(t), files=1)
    monkeypatch.setattr(arrivals, "cut", broken)
    arrive(a.where(s).withColumn("value", F.lit(-2.0)), px.withColumn("element", F.lit("X")))  # restarts; a late repeat, and a channel nobody asked for
    assert calls == [["s"], ["t"]]
    got = {(r.slide, r.roi, r.element): (r.n, r.v) for r in tables.read_stored(spark, f"{place}/store").groupBy("slide", "roi", "element").agg(F.count("*").alias("n"), F.avg("value").alias("v")).collect()}
    assert got.keys() == {("s", "a", "A"), ("s", "a", "B"), ("t", "b", "A"), ("t", "b", "B")} and got["t", "b", "B"] == (49, 20.0) and got["s", "a", "A"] == (225, 1.0)
    assert got["s", "a", "B"] in ((225, 10.0), (225, -1.0))  # of two files in one trigger, the first by name


def test_files_of_cut_slides_are_as_few_as_tasks(spark, tmp_path, monkeypatch):
    """Sixty slides, of which half are assembled in a later batch, from the batches that hold their channels."""
    slides = spark.range(60).select(F.concat(F.lit("s"), F.col("id")).alias("slide"), F.col("id"))
    px = slides.select("slide", F.explode(F.sequence(F.lit(0), F.lit(3))).alias("y"), F.col("id").cast("double").alias("value")).withColumn("x", F.explode(F.array(F.lit(0), F.lit(1))))
    frame = slides.select("slide", F.explode(F.array(F.lit("A"), F.lit("B"))).alias("element"), F.lit(4).alias("height"), F.lit(2).alias("width"))
    table = slides.select("slide", F.lit("r").alias("roi"), F.lit(1).alias("row_start"), F.lit(3).alias("row_stop"), F.lit(0).alias("column_start"), F.lit(2).alias("column_stop"), F.lit("rectangle").alias("poly_type"), F.lit(None).cast("array<struct<row:double,col:double>>").alias("polygon_vertices"))
    place, schema, half = f"file://{tmp_path}", "slide string, element string, y int, x int, value double", F.xxhash64("slide") % 2 == 0
    taken = []
    monkeypatch.setattr(arrivals, "assemble_rois", lambda own, store, of=arrivals.assemble_rois: taken.append(sorted({f.split("batch=")[1].split("/")[0] for f in own.inputFiles() if "_arrived" not in f})) or of(own, store))
    for turn in (px.withColumn("element", F.lit("A")).where(half), px.withColumn("element", F.lit("A")).where(~half), px.withColumn("element", F.lit("B")).where(~half)):
        turn.select("slide", "element", "y", "x", "value").coalesce(1).write.mode("append").parquet(f"{place}/in")
        arrivals.stream_cut(spark, f"{place}/in", schema, table, frame, f"{place}/out", f"{place}/state", store=f"{place}/store").awaitTermination()
    n = px.where(~half).select("slide").distinct().count()
    assert 0 < n < 60 and taken == [["1", "2"]]
    assert len(list(tmp_path.glob("out/batch=*/**/*.parquet"))) <= 12  # four tasks a batch
    got = tables.read_stored(spark, f"{place}/store").groupBy("slide").agg(F.count("*").alias("n"), F.countDistinct("value").alias("v")).collect()
    assert len(got) == n and {(r.n, r.v) for r in got} == {(8, 1)}


def test_arriving_files_grow_in_number(spark, tmp_path, monkeypatch):
    image = fixtures.slide_image(spark, "/root/testdata/sf0.001")
    monkeypatch.setattr(queries, "_MOST", 1 << 14)
    queries._arrive(spark, "/root/testdata/sf0.001", image, f"file://{tmp_path}/in")
    back = spark.read.parquet(f"file://{tmp_path}/in").withColumn("file", F.input_file_name())
    assert back.select("file").distinct().count() > 3
    assert back.select("file", "slide", "element").distinct().count() == image.select("slide", "element").distinct().count()
    assert back.count() == image.count()


@pytest.mark.parametrize("grid", ["mask", "dense_image", "slide_image"])
def test_grids_are_planned_with_their_size(spark, grid):
    """A grid that is taken for one row is broadcast, however large it is."""
    df = getattr(fixtures, grid)(spark, "/root/testdata/sf0.001")
    df = df.where("value > 0") if "value" in df.columns else df
    assert df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes() >= 8 * df.count()


def broadcast_rows(plan):
    """The most rows that a broadcast of an executed plan holds."""
    name, most = plan.getClass().getSimpleName(), 0
    if name == "BroadcastExchangeExec":
        most = plan.metrics().apply("numOutputRows").value()
    inner = "executedPlan" if name == "AdaptiveSparkPlanExec" else "plan" if name.endswith("QueryStageExec") else None
    children = [getattr(plan, inner)()] if inner else [plan.children().apply(i) for i in range(plan.children().size())]
    return max([most, *map(broadcast_rows, children)])


@pytest.mark.parametrize("chosen", ["true", "element in ('click', 'view')"])
@pytest.mark.parametrize("grid", ["dense_image", "slide_image"])
def test_grids_are_not_broadcast(spark, grid, chosen):
    """Lines of a grid are few; the grid that is made from them is not."""
    large = spark.range(100_000).select(F.col("id").cast("int").alias("y"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "100k")
    try:
        df = getattr(fixtures, grid)(spark, "/root/testdata/sf0.001").where(chosen).join(large, "y")
        assert len(df.collect()) > 720 * 10
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert 0 < broadcast_rows(df._jdf.queryExecution().executedPlan()) <= 720


def test_pixels_meet_percentiles_without_a_shuffle(spark):
    """Elements are few, so that a shuffle by element would leave all pixels to few tasks."""
    df = queries.queries()["normalize_fanout"](spark, "/root/testdata/sf0.001")
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    assert "SortMergeJoin" not in plan.toString() and broadcast_rows(plan) <= 720


def test_pixels_of_objects_are_not_broadcast(spark):
    df = queries.queries()["segment_instances"](spark, "/root/testdata/sf0.001")
    assert len(df.collect()) > 0
    assert broadcast_rows(df._jdf.queryExecution().executedPlan()) == 0


def test_blob_is_written_out_by_many_tasks(spark, monkeypatch):
    points = spark.createDataFrame([("R0", y, x) for y in range(20, 60) for x in range(20, 60)], "roi string, y int, x int")
    frame = spark.createDataFrame([("R0", 90, 80)], "roi string, height int, width int")
    whole = masks.blob(points, frame, (9, 8), 1)
    assert whole.count() == whole.distinct().count() > 0
    monkeypatch.setattr(masks, "PIXELS", 900)
    dealt = masks.blob(points, frame, (9, 8), 1)
    assert dealt.select(F.spark_partition_id()).distinct().count() > 1
    assert dealt.exceptAll(whole).isEmpty() and whole.exceptAll(dealt).isEmpty()


def test_overlap_pairs_carry_columns(spark):
    boxes = spark.createDataFrame([("S0", 1, 0, 0, 9, 9, 0.5), ("S0", 2, 5, 5, 9, 9, 0.75), ("S1", 3, 5, 5, 9, 9, 1.0)], "slide string, ordinal bigint, x int, y int, w int, h int, s double")
    assert [tuple(r) for r in rois.overlap_pairs(boxes, carry=["s", "x"]).collect()] == [("S0", 1, 2, 0.5, 0, 0.75, 5)]
