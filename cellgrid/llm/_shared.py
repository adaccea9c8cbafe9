"""Helpers that several operators use: shared storage, text columns and ordered ranges of ids."""

from __future__ import annotations

import math
import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Characters that separate words: space, and tab to carriage return.
SPACE = " \t\n\x0b\x0c\r"
WORD = r"[^\x20\x09-\x0D]+"
GAP = r"[\x20\x09-\x0D]+"

LONG_MIN = -(1 << 63)


def shared_dir(spark: SparkSession) -> str:
    """A new folder under ``spark.checkpoint.dir``, which the driver and all executors share.

    Where the session does not name one, a local session (tests) gets a temporary folder of its own; a session on a
    cluster must name one, as executors do not see each other's disks.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        base = "file://" + tempfile.mkdtemp(prefix="cellgrid-")
    return f"{base.rstrip('/')}/cellgrid-{uuid.uuid4().hex}"


def stored(df: DataFrame, path: str | None = None) -> DataFrame:
    """Write ``df`` as Parquet to shared storage and read it back: cuts the lineage and outlives any executor."""
    path = path or shared_dir(df.sparkSession)
    df.write.parquet(path)
    back = df.sparkSession.read.schema(df.schema).parquet(path)
    back._stored_at = path
    return back


def discard(what: DataFrame | str, spark: SparkSession | None = None) -> None:
    """Delete what :func:`stored` has written (the DataFrame it gave, or a folder) and no plan reads any more."""
    path, spark = (what, spark) if isinstance(what, str) else (what._stored_at, what.sparkSession)
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def split_join(rows: DataFrame, one: DataFrame, keys: list[str], by: list[str], salts: int = 256) -> DataFrame:
    """``rows`` joined with ``one`` (a row for each key at most), where any number of rows may share a key.

    Each key is split into up to ``salts`` keys by a hash of ``by``: first these meet ``one``, then the rows meet them.
    """
    salted = rows.withColumn("__salt", F.pmod(F.xxhash64(F.lit("salt"), *by), F.lit(salts)))
    few = salted.select(*keys, "__salt").distinct().join(one, keys)
    return salted.join(few, [*keys, "__salt"]).drop("__salt")


def crowded(deal: Callable[[DataFrame], DataFrame], nodes: DataFrame, node: str, keys: list[str], large: int, share: int = 16) -> DataFrame:
    """``keys, chunks``: into how many chunks of about ``large`` rows to cut the groups of ``deal(nodes)`` that hold more.

    Groups are counted on the nodes that a hash picks, one of ``share``. That only balances the work: whatever is cut, all
    is compared. There are at most 2 x rows / large such groups.
    """
    some = deal(nodes.where(F.pmod(F.xxhash64(F.lit("share"), node), F.lit(share)) == 0))
    rows = F.count("*") * share
    found = some.groupBy(*keys).agg(F.ceil(rows / large).cast("int").alias("chunks"), F.count("*").alias("n"))
    return stored(found.where(F.col("n") * share > large).select(*keys, "chunks"))


def in_chunks(rows: DataFrame, keys: list[str], node: str) -> DataFrame:
    """Rows dealt out and sorted by ``keys, i, j``: those of a group with ``chunks`` come to each pair i <= j of its chunks."""
    chunks = F.coalesce("chunks", F.lit(1))
    own = F.pmod(F.xxhash64(F.lit("chunk"), node), chunks).cast("int")
    pair = F.transform(F.sequence(F.lit(0), chunks - 1), lambda x: F.struct(F.least(own, x).alias("i"), F.greatest(own, x).alias("j")))
    others = [c for c in rows.columns if c not in (*keys, "chunks")]
    dealt = rows.withColumn("pair", F.explode(pair)).select(*keys, "pair.i", "pair.j", *others)
    return dealt.repartition(*keys, "i", "j").sortWithinPartitions(*keys, "i", "j")


def whole_groups(batches: Iterator[pd.DataFrame], keys: list[str]) -> Iterator[pd.DataFrame]:
    """Rows that come sorted by ``keys``, cut so that no group is divided."""
    rest = None
    for pdf in batches:
        pdf = pdf if rest is None else pd.concat([rest, pdf], ignore_index=True)
        if len(pdf):
            key = pdf[keys].to_numpy()
            others = np.flatnonzero((key != key[-1]).any(axis=1))
            open_ = int(others[-1]) + 1 if len(others) else 0
            if open_:
                yield pdf.iloc[:open_].reset_index(drop=True)
            rest = pdf.iloc[open_:]
    if rest is not None and len(rest):
        yield rest.reset_index(drop=True)


def words(text: Column) -> Column:
    """Words of a text; none for an empty one."""
    return F.array_remove(F.split(text, GAP), "")


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z alone. Texts without other letters take the fast way."""
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(F.translate(text, upper, lower))


def bigints(values: list[int]) -> Column:
    """An array of constants, one literal in the plan however many there are."""
    return F.from_json(F.lit(f"[{','.join(map(str, values))}]"), "array<bigint>")


class Ranges:
    """Consecutive ranges of a bigint column with about as many rows each; a row's range is found without a join.

    ``lows`` and ``highs`` are the least and greatest value of each range, in order; equal values share a range. There
    are at most ``most`` of them (a literal of 1 MB), so that ranges have over ``rows`` rows beyond 262 million.
    """

    def __init__(self, ids: DataFrame, rows: int = 2000, most: int = 1 << 17):
        (name,) = ids.columns
        total = ids.count()
        n = max(1, min(most, math.ceil(total / rows)))
        dealt = ids.repartitionByRange(n, name) if n > 1 else ids
        found = (
            dealt.groupBy((F.spark_partition_id() if n > 1 else F.lit(0)).alias("part"))
            .agg(F.min(name).alias("low"), F.max(name).alias("high"))
            .collect()
        )
        found = sorted((r.low, r.high) for r in found if r.low is not None)
        self.total = total
        self.lows, self.highs = [a for a, _ in found] or [0], [b for _, b in found] or [0]

    def __len__(self) -> int:
        return len(self.lows)

    def of(self, value: Column) -> Column:
        """The index of the range that holds a value: a binary search over the lower ends."""
        lows = bigints(self.lows)
        steps = [1 << s for s in range(max(1, (len(self) - 1).bit_length()) - 1, -1, -1)]
        return F.aggregate(
            F.array(*map(F.lit, steps)),
            F.lit(0),
            lambda at, step: F.when(F.get(lows, at + step) <= value, at + step).otherwise(at),
        )
