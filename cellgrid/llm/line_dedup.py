"""Line dedup: of a line that several documents hold, only the first document keeps it.

What has been seen is kept as levelled sorted runs, each a table of line hashes with the first document that held the
line, bucketed and sorted by hash. A batch of documents merge-joins the runs bucket by bucket (the runs are not dealt
out again), what the runs don't know becomes a run of level 0, and whenever a level holds ``fan_out`` runs they are
merged into one of the next level.

Batches are taken in ascending order of doc_id, so the first document to show a line is the one with the smallest id.
"""

from __future__ import annotations

import functools
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cellgrid.llm._shared import SPACE, ascii_lower, discard, shared_dir, stored

LONG_MAX = (1 << 63) - 1
HASH = ["h1", "h2"]
#: Lines of a batch, beyond which there are more batches.
BATCH_LINES = 1 << 31


def line_key(line: Column) -> Column:
    """A line without white space at its ends, A-Z lower-cased."""
    return ascii_lower(F.btrim(line, F.lit(SPACE)))


class Runs:
    """Levelled runs of line hashes: ``h1, h2, first`` (two 64-bit hashes of the key, and its first document)."""

    def __init__(self, spark: SparkSession, buckets: int | None = None, fan_out: int = 3):
        self.spark, self.fan_out = spark, fan_out
        self.buckets = buckets or max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
        self.base, self.name = shared_dir(spark), f"line_runs_{uuid.uuid4().hex}"
        self.levels: list[list[str]] = []
        self.made = 0

    def _write(self, df: DataFrame) -> str:
        self.made += 1
        table = f"{self.name}_{self.made}"
        dealt = df.repartition(self.buckets, *HASH).sortWithinPartitions(*HASH)
        dealt.write.bucketBy(self.buckets, *HASH).sortBy(*HASH).option("path", f"{self.base}/{self.made}").format("parquet").saveAsTable(table)
        return table

    def _drop(self, table: str) -> None:
        self.spark.sql(f"DROP TABLE {table}")
        discard(f"{self.base}/{table.rpartition('_')[2]}", self.spark)

    def first_seen(self, keys: DataFrame) -> DataFrame:
        """``keys`` (one row for each hash) with ``seen``: the first document that the runs know, or null."""
        tables = [t for level in self.levels for t in level]
        for i, t in enumerate(tables):
            run = self.spark.table(t).select(*HASH, F.col("first").alias(f"seen{i}"))
            keys = keys.join(run.hint("merge"), HASH, "left")
        seen = [f"seen{i}" for i in range(len(tables))]
        return keys.withColumn("seen", F.coalesce(*seen) if seen else F.lit(None).cast("bigint")).drop(*seen)

    def add(self, keys: DataFrame) -> None:
        """Add a run of keys that no run holds, then merge the levels that are full."""
        new, at = self._write(keys), 0
        while True:
            if len(self.levels) <= at:
                self.levels.append([])
            self.levels[at].append(new)
            if len(self.levels[at]) < self.fan_out:
                return
            old, self.levels[at] = self.levels[at], []
            new, at = self._write(functools.reduce(DataFrame.unionByName, map(self.spark.table, old))), at + 1
            for t in old:
                self._drop(t)

    def close(self) -> None:
        for level in self.levels:
            for t in level:
                self._drop(t)


def repeated_lines(docs: DataFrame, min_chars: int = 10, batches: int = 4, fan_out: int = 3) -> DataFrame:
    """Lines to drop, ``doc, row_key, pos``: a line whose key an earlier document holds.

    ``docs`` has ``doc`` (bigint, not null), ``row_key`` (tells rows of one doc apart) and ``text``. At least ``batches``
    ranges of doc, of about as many lines each and ``BATCH_LINES`` at most, are taken one after the other (a document
    is never divided); a new call on later documents would go on with the same runs.
    """
    spark = docs.sparkSession
    lines = docs.select("doc", "row_key", F.posexplode(F.split("text", "\n")).alias("pos", "line"))
    lines = lines.withColumn("key", line_key(F.col("line"))).where(F.char_length("key") >= min_chars)
    lines = lines.select("doc", "row_key", "pos", F.xxhash64("key").alias("h1"), F.xxhash64(F.lit("line"), "key").alias("h2"))
    at = shared_dir(spark)
    lines = stored(lines, at)
    batches = max(batches, -(-lines.count() // BATCH_LINES))
    # approximate quantiles of the ids; rows without one (counted as the last) don't shift them
    shares = [i / batches for i in range(1, batches)]
    inner = lines.where(F.col("doc") < LONG_MAX).agg(F.percentile_approx("doc", F.array(*map(F.lit, shares)), F.lit(10_000))).first()[0] if shares else []
    edges = [None, *sorted(set(inner or [])), None]
    runs, drops = Runs(spark, fan_out=fan_out), []
    try:
        for i, (low, high) in enumerate(zip(edges, edges[1:])):
            batch = lines if low is None else lines.where(F.col("doc") > low)
            batch = batch if high is None else batch.where(F.col("doc") <= high)
            keys = batch.groupBy(*HASH).agg(F.min("doc").alias("first"), F.max("doc").alias("last"))
            keys = stored(runs.first_seen(keys))
            late = keys.where("seen is not null or last > first").select(*HASH, F.coalesce("seen", "first").alias("first"))
            drops.append(stored(batch.join(late, HASH).where("doc > first").select("doc", "row_key", "pos")))
            if high is not None:
                runs.add(keys.where("seen is null").select(*HASH, "first"))
            discard(keys)
    finally:
        runs.close()
    discard(lines)
    return functools.reduce(DataFrame.unionByName, drops)


def dedup_lines(docs: DataFrame, min_chars: int = 10, batches: int = 4, fan_out: int = 3, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with ``n_lines, n_dropped`` (bigint) and ``kept`` (the lines that stay, joined by a line feed).

    A null or empty text is one empty line. Keys under ``min_chars`` code points stay everywhere, and a line that only
    one document repeats stays there. Rows without an id count as one document after all others; rows of one id as one
    document. Texts of any length are split whole; columns of the names that are added give way. An empty table gives no
    rows.
    """
    base = docs.withColumn("__text", F.coalesce(F.col(text), F.lit(""))).withColumns(
        {"__doc": F.coalesce(F.col(doc_id).cast("bigint"), F.lit(LONG_MAX)), "__row": F.xxhash64("__text")}
    )
    source = base.select(F.col("__doc").alias("doc"), F.col("__row").alias("row_key"), F.col("__text").alias("text"))
    drops = repeated_lines(source, min_chars, batches, fan_out)
    drops = drops.groupBy(F.col("doc").alias("__doc"), F.col("row_key").alias("__row")).agg(F.collect_set("pos").alias("__drop"))
    joined = base.join(drops, ["__doc", "__row"], "left").withColumn("__lines", F.split("__text", "\n"))
    n = F.size("__lines")
    keep = F.array_except(F.sequence(F.lit(0), n - 1), F.col("__drop"))
    kept = F.when(F.col("__drop").isNull(), F.col("__text")).otherwise(
        F.array_join(F.transform(keep, lambda i: F.get(F.col("__lines"), i)), "\n")
    )
    return joined.withColumns(
        {"n_lines": n.cast("bigint"), "n_dropped": F.coalesce(F.size("__drop"), F.lit(0)).cast("bigint"), "kept": kept}
    ).drop("__text", "__doc", "__row", "__drop", "__lines")
