"""Exact top-k search by inner product with three-phase uniform threshold (Cao and Wang, 2004).

The components of all vectors are cut into ``lists`` slices. Each slice is a list of partial scores of its own, dealt out
over the tasks apart from the others; a score is the sum of its parts.

1. Each list gives its locally best parts for each query. The k-th best score of the objects seen is a safe cutoff.
2. The cutoff is broadcast, and each list gives all parts of at least cutoff / lists. An object that no list gives has a
   score below the cutoff, whatever the signs of its parts, so what is collected suffices.
3. The scores of what was collected are resolved from the vectors, and the best k are taken.

Equal vectors are one object with its k + 1 smallest ids, which is all that any query can return of them. Queries are
taken in blocks of at most ``block``, whose matrix is broadcast; only numbers of objects and queries are dealt out.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cellgrid.llm._shared import stored

#: Parts that a task holds at once.
CELLS = 1 << 22


def quantised(vector: Column, scale: float = 64.0) -> Column:
    """Each component x as floor(scale * x), x as double; null for vectors with null or non-finite components."""
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    return F.when(~F.exists(vector, bad), F.transform(vector, lambda x: F.floor(x.cast("double") * scale).cast("bigint")))


def _parts(batches: Iterator[pa.RecordBatch], matrices: list[np.ndarray]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """List, object ids and parts (objects x queries) of the rows ``list, cid, part``, in chunks."""
    for batch in batches:
        which = batch.column("list").to_numpy()
        ids = batch.column("cid").to_numpy()
        for one in np.unique(which):
            at, m = np.flatnonzero(which == one), matrices[one]
            part = batch.column("part").take(pa.array(at)).flatten().to_numpy().reshape(len(at), -1)
            size = max(16, CELLS // len(m))
            for i in range(0, len(at), size):
                own = part[i : i + size]
                bound = float(np.abs(own).max(initial=0)) * float(np.abs(m).max(initial=0)) * max(1, m.shape[1])
                if bound >= 2**62:
                    raise ValueError("the scores of these vectors don't fit 64 bits")
                # products and sums under 2**53 are exact as doubles
                s = own @ m.T if bound >= 2**53 else np.rint(own.astype(np.float64) @ m.T.astype(np.float64)).astype(np.int64)
                yield int(one), ids[at[i : i + size]], s


def _best(shared, k: int):
    """Phase 1: pairs ``cid, query`` of the k best parts that a task has of each list."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: dict[int, tuple] = {}
        for one, ids, s in _parts(batches, shared.value):
            values, names = s, np.broadcast_to(ids[:, None], s.shape)
            if one in kept:
                values, names = np.concatenate([kept[one][0], values]), np.concatenate([kept[one][1], names])
            if len(values) > k:
                top = np.argpartition(values, len(values) - k, axis=0)[-k:]
                values, names = np.take_along_axis(values, top, axis=0), np.take_along_axis(names, top, axis=0)
            kept[one] = values, names
        for values, names in kept.values():
            query = np.broadcast_to(np.arange(values.shape[1], dtype=np.int32), values.shape)
            yield pa.RecordBatch.from_arrays([pa.array(names.ravel()), pa.array(query.ravel())], names=["cid", "query"])

    return run


def _reaching(shared, limits):
    """Phase 2: pairs ``cid, query`` of all parts that reach their query's limit."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, ids, s in _parts(batches, shared.value):
            row, query = np.nonzero(s >= limits.value)
            yield pa.RecordBatch.from_arrays([pa.array(ids[row]), pa.array(query.astype(np.int32))], names=["cid", "query"])

    return run


def _scores(shared, limits=None):
    """Exact scores ``query, cid, score`` of rows ``cid, ints, queries``; those under a query's limit are left out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            queries = batch.column("queries")
            size = np.diff(queries.offsets.to_numpy())
            query, at = queries.flatten().to_numpy(), np.repeat(np.arange(len(size)), size)
            vectors = batch.column("ints").flatten().to_numpy().reshape(len(size), -1)
            score = np.zeros(len(query), np.int64)
            step = max(1, CELLS // max(1, vectors.shape[1]))
            for i in range(0, len(query), step):
                some = slice(i, i + step)
                for m, own in zip(shared.value, np.split(vectors, np.cumsum([m.shape[1] for m in shared.value])[:-1], axis=1)):
                    score[some] += np.einsum("ij,ij->i", m[query[some]], own[at[some]])
            good = np.arange(len(query)) if limits is None else np.flatnonzero(score >= limits.value[query])
            columns = [query[good], batch.column("cid").to_numpy()[at[good]], score[good]]
            yield pa.RecordBatch.from_arrays([*map(pa.array, columns)], names=["query", "cid", "score"])

    return run


def _in_block(objects: DataFrame, sliced: DataFrame, queries: DataFrame, low: int, size: int, k: int, lists: int) -> DataFrame:
    """``q, ranked`` of one block of queries: the k + 1 best ``(score, vec_id)``, in order."""
    spark, keep = objects.sparkSession, k + 1
    block = queries.where((F.col("q") >= low) & (F.col("q") < low + size)).select("q", "ints").toArrow()
    numbers = block.column("q").to_numpy()
    matrix = block.column("ints").combine_chunks().flatten().to_numpy().reshape(len(numbers), -1)
    step = -(-matrix.shape[1] // lists) or 1
    shared = spark.sparkContext.broadcast([np.ascontiguousarray(matrix[:, i * step : (i + 1) * step]) for i in range(lists)])

    def exact(pairs: DataFrame, limits=None) -> DataFrame:
        # a row for each object: its vector once, with the queries (of this block) that ask for it
        asked = pairs.groupBy("cid").agg(F.collect_set("query").alias("queries")).join(objects.select("cid", "ints"), "cid")
        return asked.mapInArrow(_scores(shared, limits), "query int, cid bigint, score bigint")

    seen = exact(sliced.mapInArrow(_best(shared, keep), "cid bigint, query int"))
    order = Window.partitionBy("query").orderBy(F.col("score").desc(), "cid")
    nth = seen.withColumn("n", F.row_number().over(order)).where(F.col("n") == keep).select("query", "score").toArrow()
    cutoff = np.full(len(numbers), -(1 << 62), np.int64)  # with fewer objects than asked for, all are taken
    cutoff[nth.column("query").to_numpy()] = nth.column("score").to_numpy()
    limits = spark.sparkContext.broadcast(-(-cutoff // lists))  # parts are integers: one reaches the mean rounded up
    found = exact(sliced.mapInArrow(_reaching(shared, limits), "cid bigint, query int"), spark.sparkContext.broadcast(cutoff))
    best = found.join(objects.select("cid", "ids"), "cid")
    nearest = Window.partitionBy("query").orderBy(F.col("score").desc(), F.col("ids")[0])
    best = best.withColumn("n", F.row_number().over(nearest)).where(F.col("n") <= keep)
    one = best.select("query", "score", F.explode("ids").alias("vec_id"))
    order = Window.partitionBy("query").orderBy(F.col("score").desc(), "vec_id")
    one = one.withColumn("n", F.row_number().over(order)).where(F.col("n") <= keep)
    ranked = one.groupBy("query").agg(F.array_sort(F.collect_list(F.struct("n", "vec_id", "score"))).alias("ranked"))
    names = spark.createDataFrame(pa.table({"query": np.arange(len(numbers), dtype=np.int32), "q": numbers}))
    return ranked.join(F.broadcast(names), "query").select("q", "ranked")


def top_k(vectors: DataFrame, is_query: Column, k: int = 20, scale: float = 64.0, lists: int = 2, block: int = 4096, vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """``query_id, rank, vec_id, score``: each query's k best other rows by inner product of quantised vectors.

    Ties go to the smaller vec_id; with fewer than k other rows, all are returned. Vectors that are null or hold null
    or non-finite components, and rows without an id, take no part. Shorter vectors count as filled up with zeros. Rows
    that repeat an id and a vector count once, and no row is returned for a query of its own id. No queries or an empty
    table give no rows. Scores must fit 62 bits.
    """
    spark = vectors.sparkSession
    rows = vectors.select(F.col(vec_id).cast("bigint").alias("vec_id"), quantised(F.col(vector), scale).alias("ints"), is_query.alias("asks"))
    rows = rows.where("vec_id is not null and ints is not null")
    total, dims = rows.agg(F.count("*"), F.max(F.size("ints"))).first()
    if not total:
        return spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score bigint")
    dims = max(dims, lists)
    rows = rows.withColumn("ints", F.concat("ints", F.array_repeat(F.lit(0).cast("bigint"), F.lit(dims) - F.size("ints")))).distinct()
    smallest = Window.partitionBy("ints").orderBy("vec_id")
    few = rows.select("ints", "vec_id").distinct().withColumn("n", F.row_number().over(smallest)).where(F.col("n") <= k + 1)
    tasks = max(1, total // 8192)
    objects = few.groupBy("ints").agg(F.sort_array(F.collect_list("vec_id")).alias("ids")).repartition(tasks)
    objects = stored(objects.withColumn("cid", F.monotonically_increasing_id()))
    step = -(-dims // lists)
    parts = F.array(*[F.struct(F.lit(i).alias("list"), F.slice("ints", i * step + 1, step).alias("part")) for i in range(lists)])
    sliced = stored(objects.select("cid", F.explode(parts).alias("x")).select("x.list", "cid", "x.part").repartition(tasks))

    asked = rows.where("asks").select("ints", F.col("vec_id").alias("query_id"))
    queries = asked.select("ints").distinct().repartition(1 + total // (20 * block)).withColumn("at", F.monotonically_increasing_id())
    queries = stored(queries.withColumn("q", F.col("at")).drop("at"))
    blocks = sorted(r.b for r in queries.select((F.floor(F.col("q") / block) * block).alias("b")).distinct().collect())
    found = [stored(_in_block(objects, sliced, queries, low, block, k, lists)) for low in blocks]
    if not found:
        return spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score bigint")
    ranked = functools.reduce(DataFrame.unionByName, found).join(queries, "q").select("ints", "ranked")
    answers = asked.join(ranked, "ints")
    own = F.slice(F.filter("ranked", lambda x: x["vec_id"] != F.col("query_id")), 1, k)
    return answers.select("query_id", F.posexplode(own).alias("at", "x")).select("query_id", (F.col("at") + 1).alias("rank"), "x.vec_id", "x.score")
