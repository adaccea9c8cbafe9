"""Images, masks, ROIs and file lists made from the star-schema and event tables, for queries and tests.

Intensities are integers, so that sums do not depend on their order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

WIDTH = 720
#: Rows of a slide.
STRIP = 8
#: Pixels that a task makes.
TASK = 1 << 20


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def image(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A sparse image: a channel per event type, a row per user, a column per hour of the month."""
    e = _table(spark, sf_dir, "events")
    x = ((F.dayofmonth("ts") - 1) * 24 + F.hour("ts")).cast("int")
    v = F.sum(F.round(F.col("value") * 100).cast("bigint")).cast("double")
    return e.groupBy(F.lit("R0").alias("roi"), F.col("event_type").alias("element"), F.col("user_id").cast("int").alias("y"), x.alias("x")).agg(v.alias("value"))


def _catalog(spark: SparkSession, sf_dir: str) -> tuple[list[str | None], int]:
    """The names of the image's elements, which are as few as the event types, and its height.

    Grids are ranges of a size that is known when they are planned: what explodes from one row is taken for one row, and
    would be made by one task and sent to the driver as the small side of a join.
    """
    found = _table(spark, sf_dir, "events").groupBy("event_type").agg(F.max("user_id").alias("last")).collect()
    return [r["event_type"] for r in found], 1 + max((r["last"] for r in found if r["last"] is not None), default=-1)


def _named(names: list[str | None], i: str) -> Column:
    return F.get(F.array(*map(F.lit, names)).cast("array<string>"), F.expr(i)).alias("element")


def _tasks(pixels: int) -> int:
    return max(1, -(-pixels // TASK))


def pixels(spark: SparkSession, sf_dir: str) -> int:
    """The pixels of the dense image."""
    names, height = _catalog(spark, sf_dir)
    return max(1, height * len(names) * WIDTH)


def extent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The catalog of the image's elements."""
    names, height = _catalog(spark, sf_dir)
    return spark.range(len(names)).select(F.lit("R0").alias("roi"), _named(names, "int(id)"), F.lit(height).alias("height"), F.lit(WIDTH).alias("width"))


def dense_image(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The image with zeros where it has no event.

    Lines of an element meet their pixels as a map, and are dealt out in strips before their pixels are written out, so
    that the grid is neither made by a few tasks nor shuffled. Columns come by a join: what explodes from a line is taken
    for one row, and once the lines are known to be few the whole grid would be broadcast.
    """
    names, height = _catalog(spark, sf_dir)
    n = max(1, len(names))
    lines = spark.range(height * len(names)).select(F.lit("R0").alias("roi"), _named(names, f"int(id % {n})"), F.expr(f"int(id div {n})").alias("y"))
    values = image(spark, sf_dir).where("x is not null").groupBy("roi", "element", "y").agg(F.map_from_entries(F.collect_list(F.struct("x", "value"))).alias("values"))
    lines = lines.join(values, ["roi", "element", "y"], "left").repartition(_tasks(height * len(names) * WIDTH), F.expr(f"y div {STRIP}"))
    grid = lines.crossJoin(F.broadcast(spark.range(WIDTH).select(F.col("id").cast("int").alias("x"))))
    return grid.select("roi", "element", "y", "x", F.coalesce(F.try_element_at("values", "x"), F.lit(0.0)).alias("value"))


def embedded_image(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A dense signed image: a row per vector, a column per component."""
    e = _table(spark, sf_dir, "embeddings").select(F.col("vec_id").cast("int").alias("y"), F.posexplode("embedding").alias("x", "e"))
    return e.select(F.lit("R0").alias("roi"), F.lit("emb").alias("element"), "y", "x", (F.round(F.col("e").cast("double") * 10000) + 0.0).alias("value"))


def mask(spark: SparkSession, sf_dir: str, nucleus: bool = False) -> DataFrame:
    """Ellipses on a 10 x 24 grid over the image; nuclei are smaller, and every 7th cell has none."""
    _, height = _catalog(spark, sf_dir)
    p = spark.range(0, height * WIDTH, 1, _tasks(height * WIDTH)).selectExpr(f"int(id div {WIDTH}) as y", f"int(id % {WIDTH}) as x")
    p = p.withColumn("label", F.expr("cast((y div 10) * 30 + x div 24 + 1 as int)"))
    p = p.where(f"4 * (y % 10 - 5) * (y % 10 - 5) + (x % 24 - 12) * (x % 24 - 12) <= {30 if nucleus else 90}")
    if nucleus:
        p = p.where("label % 7 <> 0")
    return p.select(F.lit("R0").alias("roi"), F.lit("nucleus" if nucleus else "cell").alias("element"), "y", "x", "label")


def last_label(spark: SparkSession, sf_dir: str) -> int:
    """No label of the masks is above it."""
    _, height = _catalog(spark, sf_dir)
    return (max(0, height - 1) // 10 + 1) * 30


def files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``ordinal, path``: file names of imaging rounds, with some that don't fit."""
    dye = F.when(F.col("p_partkey") % 4 == 0, "dapi_").otherwise("Cy3_")
    name = F.concat(F.lit("img/S1_"), (F.col("p_size") % 5 + 1).cast("string"), F.lit(".0.4_R000_"), dye, F.regexp_replace("p_brand", "#", ""), F.lit("-"), F.col("p_type"), F.lit("_F.ome.tif"))
    junk = F.concat(F.lit("junk_"), F.col("p_partkey").cast("string"), F.lit(".tif"))
    return _table(spark, sf_dir, "part").select(F.col("p_partkey").alias("ordinal"), F.when(F.col("p_partkey") % 11 == 0, junk).otherwise(name).alias("path"))


def slides(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``n``: the number of slides, each a strip of the image."""
    _, height = _catalog(spark, sf_dir)
    return spark.range(1).select(F.lit(-(-height // STRIP) or None).cast("int").alias("n"))


def slide_extent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The catalog of the slides' elements; the last strip may be lower."""
    names, height = _catalog(spark, sf_dir)
    n = max(1, len(names))
    e = spark.range(-(-height // STRIP) * len(names)).select(_named(names, f"int(id % {n})"), F.expr(f"int(id div {n})").alias("k"))
    return e.select(F.concat(F.lit("S"), F.col("k").cast("string")).alias("slide"), "element", F.least(F.lit(STRIP), height - STRIP * F.col("k")).alias("height"), F.lit(WIDTH).alias("width"))


def slide_image(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The dense image by slide."""
    slide = F.concat(F.lit("S"), F.expr(f"cast(y div {STRIP} as string)"))
    return dense_image(spark, sf_dir).select(slide.alias("slide"), "element", F.expr(f"y % {STRIP}").alias("y"), "x", "value")


def candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Boxes of a detector: the orders of a hundred customers on a slide."""
    o = _table(spark, sf_dir, "orders").join(F.broadcast(slides(spark, sf_dir)))
    return o.selectExpr(
        "concat('S', cast(o_custkey div 100 % n as string)) as slide", "o_orderkey as ordinal", "cast(o_custkey * 7 % 2000 as int) as x", "cast(o_orderkey * 13 % 2000 as int) as y",
        "cast(20 + o_orderkey % 60 as int) as w", "cast(20 + o_custkey % 60 as int) as h",
        "(o_orderkey * 37 % 1000) / 1000.0D as predicted_iou", "(o_orderkey * 53 % 1000) / 1000.0D as stability_score",
    )


def candidate_masks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``slide, cand_id, y, x``: a patch of 3 x 3 pixels of the slide's image for each candidate."""
    c = candidates(spark, sf_dir).withColumn("d", F.explode(F.sequence(F.lit(0), F.lit(8))))
    return c.selectExpr("slide", "ordinal as cand_id", f"cast(y * {STRIP} div 2000 + d div 3 as int) as y", f"cast(x * {WIDTH} div 2000 + d % 3 as int) as x")


def rois(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A window for each supplier, dealt over the slides: rectangles, and a triangle for every fourth. Names start again in each slide."""
    n = _table(spark, sf_dir, "supplier").join(F.broadcast(slides(spark, sf_dir)))
    n = n.selectExpr("concat('S', cast(s_suppkey % n as string)) as slide", "concat('ROI_', lpad(cast(s_suppkey div n as string), 3, '0')) as roi", "cast(s_suppkey % 4 as int) as row_start", "cast(s_suppkey % 4 + 5 as int) as row_stop", "cast(s_suppkey * 37 % 680 as int) as column_start", "cast(s_suppkey * 37 % 680 + 60 as int) as column_stop", "s_suppkey % 4 = 3 as tri")
    ring = F.expr("array(struct(double(row_start) as row, double(column_start) as col), struct(row_stop - 1.0D as row, double(column_start) as col), struct(double(row_start) as row, column_stop - 1.0D as col))")
    return n.withColumns({"poly_type": F.when(F.col("tri"), "polygon").otherwise("rectangle"), "polygon_vertices": ring}).drop("tri")


def orders_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A catalog of many ROIs: a customer's orders stand for elements (by priority) with some of three levels."""
    return _table(spark, sf_dir, "orders").selectExpr("cast(o_custkey as string) as roi", "o_orderpriority as element", "cast(o_orderkey % 3 as int) as level").distinct()


def shapes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quadrilaterals with slanted edges, five per channel, as exclusion shapes in (x, y)."""
    names = extent(spark, sf_dir).agg(F.sort_array(F.collect_set("element")).alias("names"))
    n = _table(spark, sf_dir, "nation").join(F.broadcast(names))
    n = n.selectExpr("n_nationkey as shape_id", "concat('qc_exclude_', names[n_nationkey % size(names)]) as shape_key", "double(n_nationkey % 5 * 144 + 10) as x0", "double(n_nationkey % 7 * 20 + 5) as y0", "double(40 + 3 * n_nationkey) as w", "double(10 + n_nationkey % 9) as h")
    ring = F.expr("array(struct(x0 as x, y0 as y), struct(x0 + w as x, y0 + 3 as y), struct(x0 + w - 8 as x, y0 + h + 3 as y), struct(x0 + 4 as x, y0 + h as y))")
    return n.select(F.lit("R0").alias("roi"), "shape_key", "shape_id", ring.alias("ring"))
