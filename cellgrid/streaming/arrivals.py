"""Channels that arrive one by one: each is cut once, and a slide is assembled once, when all of its channels are there."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from cellgrid.operators.cut import cut
from cellgrid.sources.tables import assemble_rois

ARRIVED = "slide string, element string, file string, ready boolean"


def _arrived(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    """New channels of a slide, each with the first file that brought it; ``ready`` with the one that completes the slide."""
    seen = set(state.get[0]) if state.exists else set()
    out = []
    for file, element, n in sorted(r for b in batches for r in zip(b.file.tolist(), b.element.tolist(), b.n_expected.tolist())):
        if element not in seen:
            seen.add(element)
            out.append((key[0], element, file, len(seen) == n))
    state.update((sorted(seen),))
    yield pd.DataFrame(out, columns=["slide", "element", "file", "ready"])


def arrivals(spark: SparkSession, source: str, schema: str, elements: DataFrame, files: int = 16) -> DataFrame:
    """A stream ``slide, element, file, ready`` of the channels that come in Parquet files of pixels, each once.

    State per slide says which of the channels in ``elements(slide, element)`` have come; others are left out, as are
    channels that come again. An image is dense, so its first pixel stands for it, and a file's others aren't read. A
    trigger takes up to ``files`` files.
    """
    pixels = spark.readStream.schema(schema).option("maxFilesPerTrigger", files).parquet(source)
    first = pixels.where("y = 0 and x = 0").select("slide", "element", F.col("_metadata.file_path").alias("file"))
    known = elements.select("slide", "element").distinct()
    known = known.join(known.groupBy("slide").agg(F.count("*").alias("n_expected")), "slide")
    named = first.join(known, ["slide", "element"])
    return named.groupBy("slide").applyInPandasWithState(_arrived, ARRIVED, "seen array<string>", "append", GroupStateTimeout.NoTimeout)


def stream_cut(
    spark: SparkSession, source: str, schema: str, rois: DataFrame, elements: DataFrame, out: str, checkpoint: str, margin: int = 0, files: int = 16, store: str | None = None,
) -> StreamingQuery:
    """Cut arriving pixel files (Parquet ``slide, element, y, x, value``; a file holds whole channels) and append them to ``out``.

    A slide all of whose channels have come is assembled in ``store``, in the batch that brings the last one. What a batch
    does replaces what an earlier try of the same batch did, so that a restart neither loses nor repeats a channel or slide.
    What a batch has brought is a table beside its pixels, which names the batches that hold a slide's channels.
    """
    come_to = f"{out}/_arrived"

    def one(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{come_to}/batch={number}")
        come = spark.read.schema(ARRIVED).parquet(f"{come_to}/batch={number}")
        paths = sorted(r.file for r in come.select("file").distinct().collect())  # as many as a trigger takes
        if not paths:
            return
        place = lambda c: F.array_position(F.array(*map(F.lit, paths)), c).cast("int").alias("file")
        new = come.select("slide", "element", place(F.col("file")))
        pixels = spark.read.schema(schema).parquet(*paths).select("*", place(F.col("_metadata.file_path")))
        fresh = pixels.join(F.broadcast(new), ["slide", "element", "file"]).drop("file")
        cut(fresh, rois, elements, margin).write.mode("overwrite").parquet(f"{out}/batch={number}")
        ready = come.where("ready").select("slide")
        if store and not ready.isEmpty():
            held = spark.read.schema(f"{ARRIVED}, batch bigint").parquet(come_to).where(F.col("batch") <= number).join(ready, "slide", "left_semi")
            batches = [r.batch for r in held.select("batch").distinct().collect()]
            assemble_rois(cut_channels(spark, out, batches).drop("batch").join(ready, "slide", "left_semi"), store)

    return arrivals(spark, source, schema, elements, files).writeStream.foreachBatch(one).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def cut_channels(spark: SparkSession, out: str, batches: Sequence[int] | None = None) -> DataFrame:
    """What the stream has cut, in some batches or all: ``slide, roi, element, y, x, value``, and the ``batch``."""
    folders = [out] if batches is None else [f"{out}/batch={b}" for b in sorted(batches)]
    cut_ = spark.read.schema("slide string, roi string, element string, y int, x int, value double, batch bigint").option("basePath", out).parquet(*folders)
    return cut_.select("slide", "roi", "element", "y", "x", "value", "batch")


def ready_slides(cut_channels: DataFrame, expected: DataFrame) -> DataFrame:
    """Slides all of whose expected channels (``slide, element``) have been cut."""
    open_ = expected.join(cut_channels.select("slide", "element"), ["slide", "element"], "left_anti")
    return expected.select("slide").distinct().join(open_.select("slide"), "slide", "left_anti")
