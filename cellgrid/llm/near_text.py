"""Near-duplicates by exact shingle similarity, with SimHash bits for candidates.

Each set of shingles gets 512 SimHash bits. The first 64 are its fingerprint: fingerprints within ``BITS`` bits meet at the
anchors of :func:`~cellgrid.llm.simhash.near_links`, whatever the size of the sets, and what meets is tested on the whole sets.

At a similarity of 0.8 fingerprints are further apart than anchors can cover, so the other bits lead to what is left. Bits of two sets of Jaccard similarity J differ with a probability of about
acos(2J / (1 + J)) / pi, so sets meet in a table keyed by k of the bits with a probability of (1 - that)^k. There are as
many tables as make a miss at the least similarity improbable (``MISSED``); k grows with the rows beyond 16 million, so
that a bucket holds some thousand unrelated sets at most. In small sets bits differ more often; those meet by their least
hashes instead, as many as two similar sets must share one of (the prefix filter of Chaudhuri et al., 2006).

What meets is only a candidate: a pair is linked if the similarity of its whole shingle sets, as hashes, reaches the limit
(in blocks hashes have 32 bits, which adds a shared one to a pair of sets of 400 with a probability of 0.004 %). First, what
anchors link and neighbours in a few tables are tested, which joins large groups of copies with a few links a text. Then, in all tables, texts that the first round left apart are compared in blocks: a bucket's task marks the texts that may have
a partner there, by two words of SimHash bits and then by all of them (a pair counts in the first of the tables in which
it meets alone); the sets of those left are sent to the bucket, and a task gives links that connect what is connected in it, not its pairs. So the links connect exactly what all candidates
would connect.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellgrid.llm._shared import crowded, discard, in_chunks, shared_dir, stored, whole_groups
from cellgrid.llm.simhash import near_links, star_labels

WORDS = 8  # 64-bit words of SimHash bits
#: Differing bits of fingerprints that anchors cover.
BITS = 4
MISSED = 1e-3
#: Standard deviations above the expected differences in bits at which a candidate is left out.
SPREAD = 4.5
#: Tables of the first round.
FEW = 8
#: Shingles up to which a set is small, and under which bits say too little of it.
SMALL, TINY = 64, 32
#: Rows of a bucket, and of its texts that may have a partner, above which it is compared in pairs of chunks.
LARGE, BLOCK = 4000, 512

_MIX = np.random.default_rng(42).integers(0, 1 << 63, WORDS, dtype=np.uint64)


def shingles(text: bytes, width: int) -> np.ndarray:
    """Sorted hashes of a text's different shingles (fewer words: all of them); A-Z count as a-z, none without words."""
    found = text.lower().split()
    if not found:
        return np.empty(0, np.uint64)
    n = max(1, len(found) - width + 1)
    joined = (b" ".join(found[i : i + width]) for i in range(n))
    return np.unique(np.fromiter(map(xxhash.xxh64_intdigest, joined), np.uint64, n))


def sketch(hashes: np.ndarray) -> np.ndarray:
    """The SimHash words of a set of hashes, each of them mixed anew for each word."""
    ones = np.zeros(64 * WORDS, np.int64)
    for at in range(0, len(hashes), 4096):
        z = hashes[at : at + 4096, None] ^ _MIX
        z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        z ^= z >> np.uint64(31)
        ones += np.unpackbits(z.view(np.uint8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return np.packbits(ones * 2 > len(hashes), bitorder="little").view("<u8")


def apart(similarity: float) -> float:
    """Probability that a SimHash bit of two sets of that similarity differs."""
    return math.acos(2 * similarity / (1 + similarity)) / math.pi


def tables(rows: int, similarity: float) -> np.ndarray:
    """The bits of each table's key, one row a table."""
    k = max(13, min(24, math.ceil(math.log2(max(1, rows))) - 11))
    n = math.ceil(math.log(MISSED) / math.log(1 - (1 - apart(similarity)) ** k))
    rng = np.random.default_rng(7)
    return np.stack([rng.permutation(64 * WORDS)[:k] for _ in range(n)])


def _sketched(docs: DataFrame, width: int, similarity: float) -> DataFrame:
    """``row, doc_id, key, n, bits, least``: a digest, the size, the SimHash bits and (if small) the least hashes of each row's shingle set."""
    most = SMALL / similarity

    def least(s: np.ndarray) -> np.ndarray:
        return s[: len(s) - math.ceil(similarity * len(s) - 1e-9) + 1 if len(s) <= most else 0].view(np.int64)

    @F.pandas_udf("key binary, n int, bits binary, least array<bigint>")
    def of(texts: pd.Series) -> pd.DataFrame:
        sets = [shingles(t, width) for t in texts]
        return pd.DataFrame({"key": [xxhash.xxh3_128_digest(s) for s in sets], "n": [len(s) for s in sets], "bits": [sketch(s).tobytes() for s in sets], "least": list(map(least, sets))})

    return docs.select("row", "doc_id", of(F.coalesce("text", F.lit("")).cast("binary")).alias("s")).select("row", "doc_id", "s.*")


def _sets(docs: DataFrame, nodes: DataFrame, width: int, bits: int = 64) -> DataFrame:
    """``row, s``: the shingle sets of some rows, as hashes or (``bits`` = 32) their upper halves."""

    @F.pandas_udf("array<bigint>" if bits == 64 else "array<int>")
    def of(texts: pd.Series) -> pd.Series:
        cut = lambda s: s.view(np.int64) if bits == 64 else (s >> np.uint64(32)).astype(np.uint32).view(np.int32)
        return pd.Series([cut(shingles(t, width)) for t in texts])

    texts = docs.join(nodes, "row", "left_semi").select("row", F.coalesce("text", F.lit("")).cast("binary").alias("text"))
    return texts.select("row", of("text").alias("s"))


def _keys(octets: np.ndarray, chosen: np.ndarray) -> np.ndarray:
    """The keys of rows of SimHash bits in each table."""
    power = 1 << np.arange(chosen.shape[1], dtype=np.int64)
    bits = np.unpackbits(octets, axis=1, bitorder="little")
    return np.stack([bits[:, t] @ power for t in chosen], axis=1)


def _met_before(bucket: np.ndarray, n: np.ndarray, octets: np.ndarray, chosen: np.ndarray) -> Callable[[np.ndarray, np.ndarray], np.ndarray]:
    """Whether two rows of a bucket also meet in an earlier table (there they are compared as well)."""
    keys, large = _keys(octets, chosen), n >= SMALL
    own = np.clip(bucket >> 32, 0, len(chosen) - 1)
    of_table = large & (bucket >> 32 == own) & (keys[np.arange(len(n)), own] == bucket & 0xFFFFFFFF)
    own = np.where(of_table, own, len(chosen))  # least hashes come after all tables

    def before(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        met = (keys[a] == keys[b]) & (large[a] & large[b])[:, None]
        return met.any(axis=1) & (met.argmax(axis=1) < own[a])

    return before


def _dealt(nodes: DataFrame, chosen: np.ndarray, few: int | None = None) -> DataFrame:
    """``bucket, node, label, n, f0, f1``: each node in its bucket of every table (the first ``few`` tables)."""
    chosen = chosen[:few]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for whole in batches:
            for at in range(0, len(whole), 1000):
                pdf = whole.iloc[at : at + 1000]
                n = pdf.n.to_numpy()
                octets = np.frombuffer(b"".join(pdf.bits), np.uint8).reshape(len(pdf), -1)
                words = np.ascontiguousarray(octets).view("<i8")
                large = np.flatnonzero(n >= SMALL)
                keys = _keys(octets[large], chosen) + (np.arange(len(chosen), dtype=np.int64) << 32)
                least = [x[:few] for x in pdf.least]
                row = np.concatenate([np.repeat(large, len(chosen)), np.repeat(np.arange(len(n)), list(map(len, least)))])
                bucket = np.concatenate([keys.ravel(), *least]).astype(np.int64)
                yield pd.DataFrame({"bucket": bucket, **{c: pdf[c].to_numpy()[row] for c in ("node", "label", "n")}, "f0": words[row, 0], "f1": words[row, 1]})

    return nodes.select("node", "label", "n", "bits", "least").mapInPandas(run, "bucket bigint, node bigint, label bigint, n int, f0 bigint, f1 bigint")


def _most(n: np.ndarray, similarity: float, words: int) -> np.ndarray:
    """Differences in the bits of some words beyond which a set of ``n`` hashes is taken to be less similar to another; none for tiny sets."""
    p, bits = apart(similarity), 64 * words
    return np.where(n < TINY, bits, math.ceil(bits * p + SPREAD * math.sqrt(bits * p * (1 - p))))


def _sizes_fit(n: np.ndarray, a: np.ndarray, b: np.ndarray, similarity: float) -> np.ndarray:
    return np.minimum(n[a], n[b]) >= similarity * np.maximum(n[a], n[b])


def _neighbours(nodes: DataFrame, chosen: np.ndarray, similarity: float) -> DataFrame:
    """``a, b``: pairs that are next to each other in a bucket, in order of the first word, and can be similar."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in whole_groups(batches, ["bucket", "i"]):
            f = pdf[["f0", "f1"]].to_numpy().view(np.uint64)
            key = pdf[["bucket", "i"]].to_numpy()
            turn = (key[:, 0] >> 32).astype(np.uint64) * np.uint64(7) % np.uint64(63) + np.uint64(1)
            turned = f[:, 0] << turn | f[:, 0] >> (np.uint64(64) - turn)  # another order in each table
            order = np.lexsort((turned, key[:, 1], key[:, 0]))
            a, b = order[:-1], order[1:]
            n, node = pdf.n.to_numpy(), pdf.node.to_numpy()
            near = (key[a] == key[b]).all(axis=1) & _sizes_fit(n, a, b, similarity)
            a, b = a[near], b[near]
            near = np.bitwise_count(f[a] ^ f[b]).sum(axis=1) <= _most(n[a], similarity, 2)
            yield pd.DataFrame({"a": np.minimum(node[a], node[b])[near], "b": np.maximum(node[a], node[b])[near]})

    dealt = _dealt(nodes, chosen, FEW)
    hot = crowded(lambda some: _dealt(some, chosen, FEW), nodes, "node", ["bucket"], LARGE)
    part = F.pmod(F.shiftrightunsigned("f0", 40), F.coalesce("chunks", F.lit(1)))
    dealt = dealt.join(hot, "bucket", "left").select("bucket", part.alias("i"), "node", "n", "f0", "f1")
    return dealt.repartition("bucket", "i").sortWithinPartitions("bucket", "i").mapInPandas(run, "a bigint, b bigint")


def _covered(nodes: DataFrame) -> DataFrame:
    """``a, b``: pairs by anchor covering, which connect all nodes that fingerprints within ``BITS`` bits connect."""

    @F.pandas_udf("bigint")
    def first_word(bits: pd.Series) -> pd.Series:
        return pd.Series(np.frombuffer(b"".join(bits), "<i8")[::WORDS])

    printed = stored(nodes.select("node", first_word("bits").alias("fp")))
    classes = stored(printed.groupBy("fp").agg(F.min("node").alias("least")))
    same = printed.join(classes, "fp").where("node <> least").select(F.col("least").alias("a"), F.col("node").alias("b"))
    found = near_links(classes.select("fp"), BITS).distinct()
    for x in "ab":
        found = found.join(classes.select(F.col("fp").alias(f"{x}0"), F.col("least").alias(x)), f"{x}0")
    found = stored(same.unionByName(found.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))))
    discard(printed)
    discard(classes)
    return found


def _verified(pairs: DataFrame, docs: DataFrame, width: int, similarity: float) -> DataFrame:
    """The pairs whose shingle sets reach the similarity."""
    pairs = stored(pairs)
    sets = stored(_sets(docs, pairs.select(F.explode(F.array("a", "b")).alias("row")).distinct(), width))
    both = pairs.join(sets.select(F.col("row").alias("a"), F.col("s").alias("sa")), "a").join(sets.select(F.col("row").alias("b"), F.col("s").alias("sb")), "b")
    shared = F.size(F.array_intersect("sa", "sb"))
    found = stored(both.where(shared / (F.size("sa") + F.size("sb") - shared) >= similarity).select("a", "b"))
    discard(sets)
    discard(pairs)
    return found


def _may_match(n: np.ndarray, label: np.ndarray, f: np.ndarray, similarity: float, before: Callable[[np.ndarray, np.ndarray], np.ndarray]) -> np.ndarray:
    """Of the rows of one bucket, those that have a partner of another label that can be similar and was not met ``before``."""
    out, most = np.zeros(len(n), bool), _most(n, similarity, f.shape[1])[:, None]
    for at in range(0, len(n), 256):
        own = slice(at, at + 256)
        apart_ = sum(np.bitwise_count(f[own, None, w] ^ f[None, at:, w]).astype(np.int16) for w in range(f.shape[1]))
        a, b = np.nonzero(apart_ <= most[own])
        a, b = a + at, b + at
        near = (a < b) & (label[a] != label[b])
        near[near] = _sizes_fit(n, a[near], b[near], similarity)
        near[near] = ~before(a[near], b[near])
        out[a[near]] = out[b[near]] = True
    return out


def _marked(rows: DataFrame, similarity: float, chosen: np.ndarray) -> DataFrame:
    """``bucket, node, label, n``: rows of buckets (``bits``, or two words ``f0, f1``) that may have a partner of another label there.

    With all bits, partners with which a row meets in an earlier table don't count.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in whole_groups(batches, ["bucket", "i", "j"]):
            key, n, label = pdf[["bucket", "i", "j"]].to_numpy(), pdf.n.to_numpy(), pdf.label.to_numpy()
            f = np.frombuffer(b"".join(pdf.bits), "<u8").reshape(len(pdf), -1) if "bits" in pdf else pdf[["f0", "f1"]].to_numpy().view(np.uint64)
            before = _met_before(key[:, 0], n, f.view(np.uint8), chosen) if "bits" in pdf else lambda a, b: np.zeros(len(a), bool)
            begin = np.flatnonzero(np.append(True, (key[1:] != key[:-1]).any(axis=1)))
            size = np.diff(np.append(begin, len(key)))
            group, out = np.repeat(np.arange(len(begin)), size), np.zeros(len(key), bool)
            small = np.flatnonzero((size <= 32)[group])
            for shift in range(1, min(int(size.max()), 32)):  # all small buckets at once
                a, b = small[:-shift], small[shift:]
                near = (group[a] == group[b]) & (label[a] != label[b]) & _sizes_fit(n, a, b, similarity)
                a, b = a[near], b[near]
                near = np.bitwise_count(f[a] ^ f[b]).sum(axis=1) <= _most(n[a], similarity, f.shape[1])
                near[near] = ~before(a[near], b[near])
                out[a[near]] = out[b[near]] = True
            for g in np.flatnonzero(size > 32):
                own = slice(begin[g], begin[g] + size[g])
                out[own] = _may_match(n[own], label[own], f[own], similarity, lambda a, b: before(a + begin[g], b + begin[g]))  # noqa: B023
            yield pdf.loc[out, ["bucket", "node", "label", "n"]]

    return in_chunks(rows, ["bucket"], "node").mapInPandas(run, "bucket bigint, node bigint, label bigint, n int").distinct()


def _active(named: DataFrame, chosen: np.ndarray, similarity: float) -> DataFrame:
    """``bucket, node``: texts that may have a partner of another label in a bucket."""
    hot = crowded(lambda some: _dealt(some, chosen), named, "node", ["bucket"], LARGE)
    some = stored(_marked(_dealt(named, chosen).join(hot, "bucket", "left"), similarity, chosen))
    hot = crowded(lambda x: x, some, "node", ["bucket"], LARGE)
    found = stored(_marked(some.join(hot, "bucket", "left").join(named.select("node", "bits"), "node"), similarity, chosen).select("bucket", "node"))
    discard(some)
    return found


def linked(sets: list[np.ndarray], similarity: float) -> np.ndarray:
    """For each of some sets the first that links of at least the similarity lead to."""
    m, n = len(sets), np.array([len(s) for s in sets])
    token, row = np.concatenate(sets), np.repeat(np.arange(m), n)
    order = np.argsort(token, kind="stable")
    token, row = token[order], row[order]
    same = token[1:] == token[:-1]
    shared = np.append(False, same) | np.append(same, False)  # tokens of one set alone count in no pair
    token, row = token[shared], row[shared]
    column = np.cumsum(np.append(False, token[1:] != token[:-1])) if len(token) else np.empty(0, np.int64)
    both = np.zeros((m, m), np.float32)
    for at in range(0, int(column[-1]) + 1 if len(column) else 0, 4096):
        some = slice(*np.searchsorted(column, [at, at + 4096]))
        held = np.zeros((m, 4096), np.float32)
        held[row[some], column[some] - at] = 1
        both += held @ held.T
    both = both.astype(np.float64)
    near = both / (n[:, None] + n[None] - both) >= similarity
    np.fill_diagonal(near, True)
    label = np.arange(m)
    while True:
        new = np.where(near, label[None], m).min(axis=1)
        new = new[np.minimum(new, label)]
        if (new == label).all():
            return label
        label = new


def _compared(active: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """``a, b``: links that connect what is similar among the texts of each bucket."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in whole_groups(batches, ["bucket", "i", "j"]):
            key, node, s = pdf[["bucket", "i", "j"]].to_numpy(), pdf.node.to_numpy(), pdf.s.to_numpy()
            begin = np.append(np.flatnonzero(np.append(True, (key[1:] != key[:-1]).any(axis=1))), len(key))
            a, b = [], []
            for lo, hi in zip(begin[:-1], begin[1:]):
                if hi - lo > 1:
                    root = linked(list(s[lo:hi]), similarity)
                    found = np.flatnonzero(root != np.arange(hi - lo))
                    a.append(node[lo:hi][root[found]])
                    b.append(node[lo:hi][found])
            if a:
                yield pd.DataFrame({"a": np.concatenate(a), "b": np.concatenate(b)})

    hot = crowded(lambda some: some, active, "node", ["bucket"], BLOCK)
    held = active.select("bucket", "node").join(hot, "bucket", "left").join(sets.withColumnRenamed("row", "node"), "node")
    return in_chunks(held, ["bucket"], "node").mapInPandas(run, "a bigint, b bigint")


def keep_one(docs: DataFrame, width: int = 5, similarity: float = 0.8, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` without near-duplicates: of each component the row of the smallest id (nulls last) stays.

    Rows are linked if their sets of ``width``-word shingles have a Jaccard similarity of ``similarity`` or more (fewer
    words make one shingle, null counts as empty, and texts without words are equal). Components are what such links
    connect. Of rows with one id, or none, the first stays; an empty table gives no rows; other columns come along.
    """
    numbered = stored(docs.withColumn("__row", F.monotonically_increasing_id()))
    given = numbered.select(F.col("__row").alias("row"), F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).alias("text"))
    rows = stored(_sketched(given, width, similarity))
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row")
    # a class of equal sets is named by its first row
    classes = rows.groupBy("key").agg(F.min(order).alias("first"), F.first("n").alias("n"), F.first("bits").alias("bits"), F.first("least").alias("hashes"))
    classes = stored(classes.select(F.col("first.row").alias("node"), "first", "n", "bits", F.col("hashes").alias("least")))
    discard(rows)
    chosen = tables(classes.count(), similarity)
    nodes = classes.where("n > 0")
    covered = _covered(nodes)
    links = _verified(covered.unionByName(_neighbours(nodes.withColumn("label", F.col("node")), chosen, similarity)).distinct(), given, width, similarity)
    discard(covered)
    named = stored(nodes.join(star_labels(links), "node", "left").withColumn("label", F.coalesce("label", "node")))
    active = _active(named, chosen, similarity)
    sets = stored(_sets(given, active.select(F.col("node").alias("row")).distinct(), width, 32))
    more = stored(_compared(active, sets, similarity).distinct())
    for used in (sets, active, named):
        discard(used)
    labels = star_labels(links.unionByName(more))
    kept = classes.join(labels, "node", "left").groupBy(F.coalesce("label", "node").alias("label")).agg(F.min("first")["row"].alias("__row")).select("__row")
    return numbered.join(kept, "__row", "left_semi").select(*docs.columns)
