"""SimHash near-dedup by anchor-point covering.

Fingerprints of 64 bits are linked if at most ``bits`` of them differ. The bits fall into ``blocks`` blocks, so two
linked fingerprints differ in at most t = bits // blocks bits of some block. The anchors of a block are the words of a
covering code: a Hamming code of length 2^r - 1, whose balls of radius 1 cover every word, and all values of the bits
that are left. Of two block values t apart, some value lies within ceil(t / 2) of both, and its anchor within one more.
So each fingerprint goes to every anchor within covering radius plus half the threshold (rounded up), from both sides,
and each linked pair meets at an anchor.

What meets is compared per anchor. An anchor yields links that connect what is connected there (a spanning forest), not
all pairs; large anchors are cut into pairs of chunks. Components come from alternating large-star and small-star steps
(Kiveris et al., 2014), each a few joins on the links, written to shared storage.
"""

from __future__ import annotations

import functools
import itertools
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cellgrid.llm._shared import crowded, discard, in_chunks, shared_dir, stored, whole_groups

#: For each value of a byte, its bits from the lowest.
_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").astype(np.int64)


def simhash(text: bytes, width: int, seed: int) -> int:
    """Fingerprint of a text's shingles with repeats, as a signed 64-bit integer; 0 without words."""
    found = text.lower().split()  # of bytes: A-Z, and white space from 09 to 0D and 20
    if not found:
        return 0
    joined = b" ".join(found)
    sizes = np.fromiter(map(len, found), np.int64, len(found))
    ends = np.cumsum(sizes + 1) - 1
    starts = ends - sizes
    n = max(1, len(found) - width + 1)
    last = ends[min(width, len(found)) - 1 :]
    hashes = np.fromiter((xxhash.xxh64_intdigest(joined[a:b], seed) for a, b in zip(starts[:n].tolist(), last.tolist())), np.uint64, n)
    octets = hashes.astype("<u8").view(np.uint8).reshape(-1, 8)
    ones = np.concatenate([np.bincount(octets[:, i], minlength=256) @ _BITS for i in range(8)])
    return int(np.packbits(ones * 2 > n, bitorder="little").view("<i8")[0])


def fingerprint(text: Column, width: int = 4, seed: int = 42) -> Column:
    """SimHash of ``width``-word shingles (fewer words: all of them) under XXH64; A-Z count as a-z, null as empty."""

    @F.pandas_udf("bigint")
    def of(texts: pd.Series) -> pd.Series:
        return pd.Series([simhash(t, width, seed) for t in texts], dtype="int64")

    return of(F.coalesce(text, F.lit("")).cast("binary"))


def _blocks(blocks: int) -> list[tuple[int, int]]:
    """First bit and number of bits of each block."""
    edges = [64 * i // blocks for i in range(blocks + 1)]
    return [(a, b - a) for a, b in itertools.pairwise(edges)]


def _flips(size: int, radius: int) -> tuple[int, list[list[int]]]:
    """r, and for each syndrome of the Hamming code the changes of up to ``radius`` bits that lead to an anchor."""
    r = (size + 1).bit_length() - 1
    n = (1 << r) - 1
    out: list[list[int]] = [[] for _ in range(1 << r)]
    for k in range(radius + 1):
        for places in itertools.combinations(range(size), k):
            syndrome = functools.reduce(lambda s, p: s ^ (p + 1 if p < n else 0), places, 0)
            out[syndrome].append(sum(1 << p for p in places))
    return r, out


def anchors(value: Column, size: int, threshold: int) -> Column:
    """The anchors of a block value of ``size`` bits: all within covering radius plus half the threshold."""
    r, flips = _flips(size, 1 + -(-threshold // 2))
    n = (1 << r) - 1
    syndrome = F.lit(0)
    for k in range(r):
        mask = sum(1 << p for p in range(n) if (p + 1) >> k & 1)
        syndrome = syndrome + F.bit_count(value.bitwiseAND(F.lit(mask))).bitwiseAND(1) * (1 << k)
    table = F.array(*[F.array(*[F.lit(x).cast("bigint") for x in row]) for row in flips])
    return F.transform(F.get(table, syndrome), lambda x: value.bitwiseXOR(x))


def _linked(fp: np.ndarray, others: np.ndarray, bits: int, total: int) -> np.ndarray:
    apart = np.bitwise_count(fp ^ others)
    return (apart[:, 0] <= bits) & (apart.sum(axis=1) <= total)


def _forest(fps: np.ndarray, bits: int, total: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Links that connect what is connected among ``fps``."""
    while len(fps) > 1:
        queue, fps = [fps[0]], fps[1:]
        while queue and len(fps):
            at = queue.pop()
            near = _linked(at, fps, bits, total)
            if near.any():
                found, fps = fps[near], fps[~near]
                yield np.broadcast_to(at, found.shape), found
                queue.extend(found)


def _links(names: list[str], keys: list[str], bits: int, total: int):
    """Links per anchor of rows that come sorted by anchor."""

    def pairs(key: np.ndarray, fps: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        new = np.ones(len(key), bool)
        new[1:] = (key[1:] != key[:-1]).any(axis=1)
        begins = np.flatnonzero(new)
        sizes = np.diff(np.append(begins, len(key)))
        group = np.repeat(np.arange(len(begins)), sizes)
        small = np.flatnonzero((sizes <= 8)[group])
        for shift in range(1, 8):
            a = small[:-shift] if shift < len(small) else small[:0]
            b = small[shift:]
            same = group[a] == group[b]
            a, b = a[same], b[same]
            near = _linked(fps[a], fps[b], bits, total)
            yield fps[a[near]], fps[b[near]]
        for i in np.flatnonzero(sizes > 8):
            own = fps[begins[i] : begins[i] + sizes[i]]
            if len(own) <= 1024:
                # all at once; what many links connect is left to the forest
                a, b = np.nonzero(np.triu(np.bitwise_count(own[:, None, 0] ^ own[None, :, 0]) <= bits, 1))
                near = _linked(own[a], own[b], bits, total)
                if near.sum() <= 2 * len(own):
                    yield own[a[near]], own[b[near]]
                    continue
            yield from _forest(own, bits, total)

    def out(found: Iterator[tuple[np.ndarray, np.ndarray]]) -> Iterator[pd.DataFrame]:
        for a, b in found:
            if len(a):
                columns = {f"a{i}": a[:, i].astype("int64") for i in range(len(names))} | {f"b{i}": b[:, i].astype("int64") for i in range(len(names))}
                yield pd.DataFrame(columns).drop_duplicates()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in whole_groups(batches, keys):
            yield from out(pairs(pdf[keys].to_numpy(np.int64), pdf[names].to_numpy(np.int64).astype(np.uint64)))

    return run


def near_links(fps: DataFrame, bits: int = 4, blocks: int = 2, total: int | None = None, large: int = 20_000) -> DataFrame:
    """Links ``a0.., b0..`` between the distinct rows of ``fps`` (one or more bigint columns).

    Two rows are linked if their first columns differ in at most ``bits`` bits and all columns together in at most
    ``total`` (no further condition with one column). The links connect exactly what is connected; anchors of about
    ``large`` rows or more are compared in pairs of chunks of that size.
    """
    names = fps.columns
    total = 64 * len(names) if total is None else total
    first = F.col(names[0])
    rows = []
    for i, (at, size) in enumerate(_blocks(blocks)):
        value = F.shiftrightunsigned(first, at).bitwiseAND(F.lit((1 << size) - 1))
        rows.append(F.struct(F.lit(i).alias("block"), anchors(value, size, bits // blocks).alias("anchors")))

    def dealt(some: DataFrame) -> DataFrame:
        return some.select(*names, F.explode(F.array(*rows)).alias("at")).select(*names, "at.block", F.explode("at.anchors").alias("anchor"))

    at = ["block", "anchor"]
    cut = in_chunks(dealt(fps).join(crowded(dealt, fps, names[0], at, large), at, "left"), at, names[0])
    schema = ", ".join(f"{x}{i} bigint" for x in "ab" for i in range(len(names)))
    return cut.mapInPandas(_links(names, [*at, "i", "j"], bits, total), schema)


def star_labels(links: DataFrame, most_rounds: int = 60) -> DataFrame:
    """``node, label`` of every linked node; the label is the smallest node of its component. ``links`` has ``a, b``.

    Nodes may be of any orderable type. Each round runs on the links alone and is written to shared storage.
    """
    spark = links.sparkSession
    path = shared_dir(spark)
    edges = stored(links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), f"{path}/0")
    state = None
    for i in range(1, most_rounds + 1):
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        new = stored(small.unionByName(least.select("a", F.col("m").alias("b"))).distinct(), f"{path}/{i}")
        now = new.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first()
        discard(f"{path}/{i - 1}", spark)
        edges = new
        if now == state:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("label"))
        state = now
    raise RuntimeError("components did not settle")


def near_components(docs: DataFrame, width: int = 4, bits: int = 4, blocks: int = 2, seeds: tuple[int, ...] = (42,), total: int | None = None, doc_id: str = "doc_id", text: str = "text", carry: tuple[str, ...] = ()) -> DataFrame:
    """``doc_id, fp0.., component, component_id`` for each row: the smallest doc_id that links lead to, its own included.

    ``component`` is the component's smallest fingerprint; columns named in ``carry`` come along. One fingerprint for each of ``seeds``; links hold ``bits`` for each of them in turn and ``total`` for all. Equal
    texts, repeated rows and texts without words meet as equal fingerprints. Null ids take part but name no component
    unless it has no other (then null). An empty table gives no rows.
    """
    names = [f"fp{i}" for i in range(len(seeds))]
    rows = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).alias("text"), *carry)
    rows = stored(rows.select("doc_id", *carry, *[fingerprint(F.col("text"), width, s).alias(n) for s, n in zip(seeds, names)]))
    classes = stored(rows.groupBy(*names).agg(F.min("doc_id").alias("least")))
    links = []
    for i in range(len(names)):
        turned = names[i:] + names[:i]
        found = near_links(classes.select(*turned), bits, blocks, total)
        node = lambda x, i=i: F.struct(*[F.col(f"{x}{(j - i) % len(names)}").alias(n) for j, n in enumerate(names)])
        links.append(found.select(node("a").alias("a"), node("b").alias("b")))
    labels = star_labels(functools.reduce(DataFrame.unionByName, links))
    labels = labels.select(*[F.col(f"node.{n}").alias(n) for n in names], "label")
    labelled = classes.join(labels, names, "left").withColumn("label", F.coalesce("label", F.struct(*names)))
    component = labelled.groupBy("label").agg(F.min("least").alias("component_id"))
    named = labelled.join(component, "label").select(*names, F.col("label").alias("component"), "component_id")
    return rows.join(named, names).select("doc_id", *carry, *names, "component", "component_id")


def keep_one(docs: DataFrame, doc_id: str = "doc_id", **settings) -> DataFrame:
    """The rows of ``docs`` without near-duplicates: of each component the row of the smallest id (nulls last) stays."""
    numbered = stored(docs.withColumn("__row", F.monotonically_increasing_id()))
    found = near_components(numbered, doc_id=doc_id, carry=("__row",), **settings)
    first = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "__row"))["__row"]
    kept = found.groupBy("component").agg(first.alias("__row")).select("__row")
    return numbered.join(kept, "__row", "left_semi").select(*docs.columns)
