"""Collocations: phrases of two and three words by how much more often they come than their parts would let expect.

Words get ids in order of frequency, and pairs of ids are counted by direct-address tiling: the plane of pairs is cut into
square tiles; a tile with many occurrences (that of the most frequent words, say) is an array with a counter for each of
its pairs, which ``bincount`` fills; the pairs of all other tiles are sorted and counted as coordinates. For phrases of
three words the frequent pairs are ranked in turn, slice by slice, and (pair, next word) is counted the same way.

Texts are encoded slice by slice. A slice holds a bounded number of words (or one longer text) with a dictionary of its
own. Words that are too rare for any phrase never get an id; ids go back to the slices by a join of the slices'
dictionaries, however large the vocabulary grows. A bitmap of bounded size tells slices which pairs are frequent; where
it errs, a phrase is counted in vain and falls to its own count.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast, TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cellgrid.llm._runs import text_slices
from cellgrid.llm._shared import discard, shared_dir, split_join, stored

#: Words of a slice.
TOKENS = 1 << 21
#: Ids along the side of a tile, and the occurrences from which a tile is an array.
SIDE, DENSE = 1024, 1 << 16

# Characters that end a piece, and those between words.
PIECE_ENDS = b".,;:!?\n\x0b\x0c\r"
BLANKS = b" \t"

#: Bits of the bitmap of frequent pairs, at most (64 MB), and of a piece of it that one group of rows makes (32 KB).
MOST_BITS, PIECE_BITS = 1 << 29, 1 << 18

#: A byte that no UTF-8 text holds stands for the end of a piece.
END = b"\xff"


def _bytes_table() -> bytes:
    table = bytearray(range(256))
    for b in range(ord("A"), ord("Z") + 1):
        table[b] = b + 32
    for b in PIECE_ENDS:
        table[b] = END[0]
    return bytes(table)


def tile_counts(i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Different pairs of ids under 2^32, and how often each comes."""
    i, j = i.astype(np.uint64), j.astype(np.uint64)
    tile = i // SIDE << np.uint64(32) | j // SIDE
    names, here = np.unique(tile, return_counts=True)
    found, rest = [], np.ones(len(tile), bool)
    for name in names[here >= DENSE]:
        mine = tile == name
        rest &= ~mine
        counts = np.bincount((i[mine] % SIDE * SIDE + j[mine] % SIDE).astype(np.int64), minlength=SIDE * SIDE)
        at = np.flatnonzero(counts)
        found.append((int(name >> np.uint64(32)) * SIDE + at // SIDE, int(name & np.uint64(0xFFFFFFFF)) * SIDE + at % SIDE, counts[at]))
    codes, counts = np.unique(_codes(i[rest], j[rest]), return_counts=True)
    found.append((*_apart(codes), counts))
    return tuple(np.concatenate([f[k] for f in found]).astype(np.int64) for k in range(3))


def encoded_slices(docs: DataFrame) -> DataFrame:
    """Slices of ``docs(lang, text)``: rows with ``tokens`` (ids of the slice's dictionary, 32-bit), rows with ``word, at, n``.

    ``slice`` tells slices apart, and a slice has one ``lang``. ``part`` is the order of its rows of tokens. The end of a
    piece is the id -1.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, number = _bytes_table(), TaskContext.get().partitionId() << 32
        held: dict[str, tuple[dict[bytes, int], list[np.ndarray]]] = {}
        size = 0

        def flush() -> Iterator[pa.RecordBatch]:
            nonlocal number, size
            for lang, (ids, arrays) in held.items():
                words = list(ids)
                counts = np.bincount(np.concatenate(arrays), minlength=len(words))
                arrays = [np.where(a == 0, np.int32(-1), a) for a in arrays]
                n = len(words) - 1  # the first entry is the end of a piece
                yield rows(number, lang, n, part=pa.nulls(n, pa.int32()), tokens=pa.nulls(n, pa.binary()), word=pa.array(words[1:], pa.binary()).cast(pa.string()), at=pa.array(np.arange(1, n + 1, dtype=np.int32)), n=pa.array(counts[1:]))
                for part, a in enumerate(arrays):
                    yield rows(number, lang, 1, part=pa.array([part], pa.int32()), tokens=pa.array([a.tobytes()]), word=pa.nulls(1, pa.string()), at=pa.nulls(1, pa.int32()), n=pa.nulls(1, pa.int64()))
                number += 1
            held.clear()
            size = 0

        def rows(slice_: int, lang: str, k: int, **columns) -> pa.RecordBatch:
            return pa.RecordBatch.from_pydict({"slice": pa.array(np.full(k, slice_)), "lang": pa.array([lang] * k, pa.string()), **columns})

        for batch in batches:
            langs = batch["lang"].fill_null("und")
            for lang in langs.unique().to_pylist():
                texts = batch["text"].filter(pc.equal(langs, lang)).fill_null("")
                for few in text_slices(texts):
                    data = END.join(few.cast(pa.binary()).to_pylist()) + END
                    words = data.translate(table).replace(END, b" " + END + b" ").split()  # leaves BLANKS alone as white space
                    ids, arrays = held.setdefault(lang, ({END: 0}, []))
                    arrays.append(np.fromiter((ids.setdefault(w, len(ids)) for w in words), np.int32, len(words)))
                    size += len(words)
                    if size >= TOKENS:
                        yield from flush()
        if size:
            yield from flush()

    return docs.mapInArrow(run, "slice bigint, lang string, part int, tokens binary, word string, at int, n bigint")


def ranked(df: DataFrame, order: list[Column | str], path: str) -> DataFrame:
    """``df`` with ``id``: its place (from 0) in its ``lang`` in the given order; sorted over all tasks."""
    order = ["lang", *order]
    dealt = df.repartitionByRange(*order).sortWithinPartitions(*order)
    placed = stored(dealt.withColumns({"__part": F.spark_partition_id(), "__at": F.monotonically_increasing_id()}), path)
    ranges = placed.groupBy("lang", "__part").agg(F.min("__at").alias("first"), F.count("*").alias("rows"))
    before = Window.partitionBy("lang").orderBy("__part")
    shift = F.sum("rows").over(before) - F.col("rows") - F.col("first")
    return placed.join(ranges.select("lang", "__part", shift.alias("shift")), ["lang", "__part"]).withColumn("id", F.col("__at") + F.col("shift")).drop("__part", "__at", "shift")


def _tokens(left: pa.Table) -> np.ndarray:
    order = np.argsort(left["part"].to_numpy())
    return np.concatenate([np.frombuffer(t, np.int32) for t in left["tokens"].take(pa.array(order)).to_pylist()]) if len(order) else np.empty(0, np.int32)


def _word_ids(tokens: np.ndarray, at: np.ndarray, id_: np.ndarray) -> np.ndarray:
    """Ids of a slice's tokens; -1 for rare words and ends of pieces."""
    of = np.full(int(tokens.max(initial=0)) + 2, -1, np.int64)  # the last entry is that of -1
    of[at] = id_
    return of[tokens]


def _codes(i: np.ndarray, j: np.ndarray) -> np.ndarray:
    return i.astype(np.uint64) << np.uint64(32) | j.astype(np.uint64)


def _apart(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return (codes >> np.uint64(32)).astype(np.int64), (codes & np.uint64(0xFFFFFFFF)).astype(np.int64)


def _slots(lang: str, codes: np.ndarray, bits: int) -> np.ndarray:
    """Places of pairs in a bitmap of a power of two of bits: a multiplicative hash, once more after a fold."""
    h = (codes ^ np.uint64(zlib.crc32(lang.encode()) * 0x9E3779B97F4A7C15 & (1 << 64) - 1)) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ h >> np.uint64(31)) * np.uint64(0x94D049BB133111EB)
    return h >> np.uint64(64 - (bits.bit_length() - 1))


def pair_bitmap(pairs: DataFrame) -> tuple[Broadcast, int]:
    """A bitmap of pairs ``lang, i, j``, broadcast, and its number of bits: 16 or more for each pair, but at most MOST_BITS.

    Where it is full, it lets more pairs pass; its size stays bounded.
    """
    bits = max(PIECE_BITS, min(MOST_BITS, 1 << (pairs.count() * 16).bit_length()))

    def slots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes = _codes(batch["i"].to_numpy(), batch["j"].to_numpy())
            for lang in batch["lang"].unique().to_pylist():
                at = _slots(lang, codes[pc.equal(batch["lang"], lang).to_numpy(zero_copy_only=False)], bits).astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(at // PIECE_BITS), pa.array(at % PIECE_BITS)], ["piece", "slot"])

    def packed(key: tuple, rows: pa.Table) -> pa.Table:
        own = np.zeros(PIECE_BITS, bool)
        own[rows["slot"].to_numpy()] = True
        return pa.table({"piece": [key[0].as_py()], "bits": [np.packbits(own, bitorder="little").tobytes()]})

    found = pairs.mapInArrow(slots, "piece bigint, slot bigint").groupBy("piece").applyInArrow(packed, "piece bigint, bits binary").collect()
    whole = bytearray(bits // 8)
    for r in found:
        whole[r.piece * PIECE_BITS // 8 : (r.piece + 1) * PIECE_BITS // 8] = r.bits
    return pairs.sparkSession.sparkContext.broadcast(bytes(whole)), bits


def _table(key: tuple, n: np.ndarray, **columns: np.ndarray) -> pa.Table:
    return pa.table({"slice": pa.array(np.full(len(n), key[0].as_py())), "lang": pa.array([key[1].as_py()] * len(n), pa.string()), **columns, "n": n})


def _pairs_of(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
    words = _word_ids(_tokens(left), right["at"].to_numpy(), right["id"].to_numpy())
    both = (words[:-1] >= 0) & (words[1:] >= 0)
    i, j, n = tile_counts(words[:-1][both], words[1:][both])
    return _table(key, n, i=i, j=j)


def _triples_of(frequent: Broadcast, bits: int):
    """Phrases of three words, both of whose pairs are in the bitmap."""

    def run(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        words = _word_ids(_tokens(left), right["at"].to_numpy(), right["id"].to_numpy())
        place = np.flatnonzero((words[:-1] >= 0) & (words[1:] >= 0))
        codes, of = np.unique(_codes(words[place], words[place + 1]), return_inverse=True)
        slots = _slots(key[1].as_py(), codes, bits)
        known = np.frombuffer(frequent.value, np.uint8)[(slots >> np.uint64(3)).astype(np.int64)] >> (slots & np.uint64(7)).astype(np.uint8) & 1 == 1
        pair = np.full(len(words), -1, np.int64)
        pair[place] = np.where(known[of], of, -1)
        at = np.flatnonzero((pair[:-1] >= 0) & (pair[1:] >= 0)) if len(pair) else place
        # pairs are ranked by how often they begin a phrase, so that frequent ones share tiles
        often = np.bincount(pair[at], minlength=len(codes))
        order = np.argsort(-often, kind="stable")
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order))
        p, k, n = tile_counts(rank[pair[at]], words[at + 2])
        i, j = _apart(codes[order[p]])
        return _table(key, n, i=i, j=j, k=k)

    return run


SLICE = ["slice", "lang"]


def exact_score(a: Column, left: Column, right: Column) -> Column:
    """floor(1000000 a^2 / (l r)) with integers of 38 digits; at most a million, as a exceeds neither l nor r."""
    big = lambda c: c.cast("decimal(19,0)")
    million = F.lit(1_000_000).cast("decimal(7,0)")
    top = (big(a) * big(a)).cast("decimal(31,0)") * million
    return F.call_function("div", top, big(left) * big(right))


def phrases(docs: DataFrame, least: int = 10, share: int = 50, lang: str = "lang", text: str = "text") -> DataFrame:
    """Candidates that stay: ``lang, phrase, a, l, r, score``, and ``n``, the words of the language.

    Phrases of two and three words with at least ``least`` occurrences, without those pairs that lie in a phrase of three
    words which has at least ``share`` per cent as many. ``l`` and ``r`` are the occurrences of the two parts of the cut
    that gives the lower score (the first of them).
    """
    spark = docs.sparkSession
    path = shared_dir(spark)
    own = docs.select(F.col(lang).cast("string").alias("lang"), F.col(text).alias("text"))
    slices = stored(encoded_slices(own), f"{path}/slices")
    tokens = slices.where("tokens is not null").select(*SLICE, "part", "tokens")
    local = slices.where("word is not null").select(*SLICE, "word", "at", "n")
    words = local.groupBy("lang", "word").agg(F.sum("n").alias("f"))
    words = stored(words, f"{path}/words")
    totals = words.groupBy("lang").agg(F.sum("f").alias("n"))
    words = stored(ranked(words.where(F.col("f") >= least), [F.desc("f"), "word"], f"{path}/word_order"), f"{path}/word_ids")
    known = stored(local.join(words.select("lang", "word", "id"), ["lang", "word"]).select(*SLICE, "at", "id"), f"{path}/known")
    sides = tokens.groupBy(*SLICE).cogroup(known.groupBy(*SLICE))
    pairs = sides.applyInArrow(_pairs_of, "slice bigint, lang string, i bigint, j bigint, n bigint")
    pairs = stored(pairs.groupBy("lang", "i", "j").agg(F.sum("n").alias("a")).where(F.col("a") >= least), f"{path}/pairs")
    triples = sides.applyInArrow(_triples_of(*pair_bitmap(pairs)), "slice bigint, lang string, i bigint, j bigint, k bigint, n bigint")
    triples = stored(triples.groupBy("lang", "i", "j", "k").agg(F.sum("n").alias("a")).where(F.col("a") >= least), f"{path}/triples")

    def word(column: str, name: str, count: str) -> DataFrame:
        return words.select("lang", F.col("id").alias(column), F.col("word").alias(name), F.col("f").alias(count))

    first = split_join(pairs, word("i", "w1", "f1"), ["lang", "i"], ["j"])
    named = stored(split_join(first, word("j", "w2", "f2"), ["lang", "j"], ["i"]), f"{path}/named")
    head = split_join(triples, named.select("lang", "i", "j", "w1", "w2", "f1", F.col("a").alias("f12")), ["lang", "i", "j"], ["k"])
    tail = named.select("lang", F.col("i").alias("j"), F.col("j").alias("k"), F.col("w2").alias("w3"), F.col("f2").alias("f3"), F.col("a").alias("f23"))
    whole = split_join(head, tail, ["lang", "j", "k"], ["i"])
    one, two = exact_score(F.col("a"), F.col("f1"), F.col("f23")), exact_score(F.col("a"), F.col("f12"), F.col("f3"))
    whole = whole.withColumns({"one": one, "two": two})
    cut = lambda x, y: F.when(F.col("one") <= F.col("two"), F.col(x)).otherwise(F.col(y))
    long = whole.select("lang", F.concat_ws(" ", "w1", "w2", "w3").alias("phrase"), "a", cut("f1", "f12").alias("l"), cut("f23", "f3").alias("r"), F.least("one", "two").alias("score"))
    inside = triples.select("lang", "i", "j", "a").unionByName(triples.select("lang", F.col("j").alias("i"), F.col("k").alias("j"), "a")).groupBy("lang", "i", "j").agg(F.max("a").alias("longer"))
    short = named.join(inside, ["lang", "i", "j"], "left").where(F.coalesce(100 * F.col("longer") < share * F.col("a"), F.lit(True)))
    short = short.select("lang", F.concat_ws(" ", "w1", "w2").alias("phrase"), "a", F.col("f1").alias("l"), F.col("f2").alias("r"), exact_score(F.col("a"), F.col("f1"), F.col("f2")).alias("score"))
    out = stored(short.unionByName(long).join(totals, "lang"))
    discard(path, spark)
    return out


def top_phrases(docs: DataFrame, least: int = 10, share: int = 50, top: int = 2000, lang: str = "lang", text: str = "text") -> DataFrame:
    """The ``top`` phrases of each language by score, then occurrences, then the phrase in byte order; ``rank`` from 1.

    A null language counts as ``und``, a null text as empty; repeated rows count each. Texts of any length count whole (one
    text at a time must fit a task). An empty table gives no rows; columns other than the two don't matter.
    """
    found = phrases(docs, least, share, lang, text)
    placed = ranked(found, [F.desc("score"), F.desc("a"), "phrase"], shared_dir(docs.sparkSession)).where(F.col("id") < top)
    return placed.select("lang", (F.col("id") + 1).alias("rank"), "phrase", "a", "l", "r", "n", "score")
