"""Mixing sources to target weights by Efraimidis-Spirakis sampling.

Each source has a target in words. The mix takes a source's documents in complete epochs as long as the target holds
them, and for the rest samples without replacement, weighted by quality: each document draws a key ``-ln(u)/weight``
and the documents with the smallest keys are taken until their words reach the budget (Efraimidis and Spirakis, 2006).

A source may hold most rows, so no source is sorted as a whole. Keys fall into ``slices`` slices of their range; the
words of each (source, slice) are summed with partial aggregation, prefix sums over those few rows find the slice in
which the budget ends, and only the documents of that slice are sorted.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cellgrid.llm._shared import WORD, stored


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def prose_weight(text: Column, size: Column) -> Column:
    """A quality weight in (0, 1]: near 1 where words have the usual mean length, less the further they are from it."""
    mean = (F.char_length(text) + 1.0) / (size + 1.0)
    return 1.0 / (1.0 + F.abs(F.ln(mean / 7.0)))


def draw(doc_id: Column, seed: str) -> Column:
    """A number in (0, 1) that depends on the id and the seed alone, so that reruns agree."""
    digits = F.md5(F.concat(F.lit(seed), F.coalesce(doc_id.cast("string"), F.lit(""))).cast("binary"))
    return (F.conv(F.substring(digits, 1, 12), 16, 10).cast("double") + 0.5) / float(1 << 48)


def source_targets(sizes: DataFrame, weights: list[float], share: float = 1.0, most_epochs: float = 3.0) -> DataFrame:
    """``src, source_size, target`` of each source in ``sizes(src, size)``.

    Sources in code point order, null last, take the weights in turn. Targets share ``share`` of all words by weight; a
    target stops at ``most_epochs`` times its source's size, and what is left over is shared by weight among the
    others until none is above. That end is one water level L with target = min(cap, weight x L), found from the
    sources in order of cap / weight.
    """
    per = sizes.groupBy("src").agg(F.sum("size").alias("source_size"))
    order = Window.orderBy(F.col("src").asc_nulls_last())
    turn = F.pmod(F.row_number().over(order) - 1, F.lit(len(weights)))
    per = per.withColumn("weight", F.get(F.array(*[F.lit(float(w)) for w in weights]), turn))
    per = per.withColumn("cap", most_epochs * F.col("source_size"))
    everything = Window.partitionBy()
    by_ratio = Window.orderBy(F.col("cap") / F.col("weight"), F.col("src").asc_nulls_last())
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    from_here = by_ratio.rowsBetween(0, Window.unboundedFollowing)
    level = (share * F.sum("source_size").over(everything) - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / F.sum("weight").over(from_here)
    per = per.withColumn("here", level)
    # the first source, by ratio, that the level doesn't fill fixes the level for it and all after it
    free = F.min(F.when(F.col("here") <= F.col("cap") / F.col("weight"), F.struct((F.col("cap") / F.col("weight")).alias("r"), F.col("here").alias("level")))).over(everything)
    target = F.coalesce(F.least(F.col("cap"), F.col("weight") * free["level"]), F.col("cap"))
    return per.select("src", "source_size", target.alias("target"))


def mix(docs: DataFrame, weights: list[float], share: float = 1.0, most_epochs: float = 3.0, seed: str = "mix", slices: int = 4096, quality=prose_weight, doc_id: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """``doc_id, size, source_size, target, copies``: how often the mix takes each document.

    ``size`` is the number of words (0 for a null or empty text). Documents are taken whole: the last one of a source
    is in if more than half of it fits the budget. Documents without words have nothing to take: they come with every
    complete epoch and are never sampled. Null ids draw one key, and ties are broken by id and size, so repeated rows
    are taken one after another. Words of texts of any length all count. An empty table gives no rows.
    """
    size = word_count(F.col(text))
    rows = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(source).cast("string").alias("src"), size.alias("size"), F.col(text).alias("text"))
    key = -F.ln(draw(F.col("doc_id"), seed)) / quality(F.coalesce("text", F.lit("")), F.col("size"))
    rows = stored(rows.select("doc_id", "src", "size", key.alias("key")))
    # key / (1 + key) spreads keys over (0, 1): the most that a slice expects is a few times the mean, for weights from 0.1 to 1
    rows = rows.withColumn("slice", F.floor(F.col("key") / (1.0 + F.col("key")) * slices).cast("int"))
    targets = source_targets(rows, weights, share, most_epochs)
    targets = targets.withColumn("epochs", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(1))
    targets = stored(targets.withColumn("budget", F.col("target") - F.col("epochs") * F.col("source_size")))
    in_source = Window.partitionBy("src").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    slices_of = rows.groupBy("src", "slice").agg(F.sum("size").alias("words")).withColumn("below", F.coalesce(F.sum("words").over(in_source), F.lit(0)))
    cut = slices_of.join(targets, slices_of["src"].eqNullSafe(targets["src"])).select(
        slices_of["src"].alias("s"), F.col("slice").alias("k"), "below", "words", "source_size", "target", "epochs", "budget"
    )
    joined = rows.join(cut, rows["src"].eqNullSafe(cut["s"]) & (F.col("slice") == F.col("k")))
    whole, open_ = F.col("below") + F.col("words") <= F.col("budget"), F.col("below") < F.col("budget")
    plain = joined.where(~(open_ & ~whole)).withColumn("taken", F.when(whole & (F.col("size") > 0), 1).otherwise(0))
    in_slice = Window.partitionBy("src", "slice").orderBy("key", "doc_id", "size").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    upto = F.col("below") + F.sum("size").over(in_slice)
    fits = (upto - F.col("size") / 2.0 <= F.col("budget")) & (F.col("size") > 0)
    edge = joined.where(open_ & ~whole).withColumn("taken", F.when(fits, 1).otherwise(0))
    return plain.unionByName(edge).select("doc_id", "size", "source_size", "target", (F.col("epochs") + F.col("taken")).cast("int").alias("copies"))


def repeat_documents(docs: DataFrame, weights: list[float], doc_id: str = "doc_id", **settings) -> DataFrame:
    """``docs`` with each row as often as the mix takes it (rows that share an id equally often)."""
    copies = mix(docs, weights, doc_id=doc_id, **settings).groupBy("doc_id").agg(F.max("copies").alias("__copies"))
    taken = copies.where("__copies > 0").withColumnRenamed("doc_id", "__id")
    joined = docs.join(taken, F.col(doc_id).cast("bigint").eqNullSafe(F.col("__id")))
    return joined.withColumn("__copy", F.explode(F.sequence(F.lit(1), F.col("__copies")))).select(*docs.columns)
