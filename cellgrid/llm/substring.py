"""Substring dedup: words under a repeated window of words go.

A window is ``width`` consecutive words of one document. Each has one anchor: of the ``gram``-word grams in it the one
with the least hash, leftmost on ties. Equal windows have equal anchors at the same place, so all copies of a window meet
under its anchor's hash; windows in a row with one anchor form a segment.

The segments of repeated anchors are the reference. It is cut into shards by anchor, and each shard gets a suffix
automaton over its distinct segments with the number of occurrences of each state. Segments are streamed through their
shard's automaton; where the longest match that occurs twice reaches ``width`` words, the window is repeated, and
repeated windows in a row are one maximal span. The reference grows with the corpus, so automata are not broadcast: a
segment goes to the one shard that can match it. What is broadcast is a bitmap of the repeated anchors with a set
greatest size; once that is too small it lets more segments pass, and the result is the same.

Hashes only choose what meets: windows are compared as words. Shards of over ``large`` distinct segments are too much for
one task's automaton; their windows are spread over all tasks and counted by Spark, as words too.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cellgrid.llm._shared import discard, shared_dir, stored

GRAM = 8

_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True

#: Texts are hashed in pieces of about so many bytes, so that a batch needs little memory.
PIECE = 1 << 21

_BASE = np.uint64(0x9E3779B97F4A7C15)
_STEP = np.uint64(0xC2B2AE3D27D4EB4F)


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xA0761D6478BD642F)
    return h ^ (h >> np.uint64(32))


class _Powers:
    """Powers of an odd number and of its inverse modulo 2**64, as far as they have been needed."""

    up = down = np.ones(1, np.uint64)

    @classmethod
    def to(cls, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(cls.up) < n:
            size = 1 << int(n - 1).bit_length()
            inverse = np.uint64(pow(int(_BASE), -1, 1 << 64))
            cls.up = np.cumprod(np.concatenate([[np.uint64(1)], np.full(size - 1, _BASE)]))
            cls.down = np.cumprod(np.concatenate([[np.uint64(1)], np.full(size - 1, inverse)]))
        return cls.up[:n], cls.down[:n]


def _word_places(data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and document of each word of texts that follow one another in ``data``, beginning at ``starts``."""
    space = _SPACE[data]
    head = np.zeros(len(data) + 1, bool)
    head[starts] = True
    head[len(data)] = True
    before = np.concatenate([[True], space[:-1]])
    after = np.concatenate([space[1:], [True]])
    first = np.flatnonzero(~space & (before | head[:-1]))
    last = np.flatnonzero(~space & (after | head[1:]))
    return first, last + 1, np.searchsorted(starts, first, "right") - 1


def _segments(data: np.ndarray, starts: np.ndarray, width: int, gram: int) -> tuple[np.ndarray, ...]:
    """Word places of the texts, and document, anchor hash, first and last window (word numbers) of each segment."""
    first, last, doc = _word_places(data, starts)
    none = np.empty(0, np.int64)
    if len(first) < width:
        return first, last, doc, none, none.astype(np.uint64), none, none
    up, down = _Powers.to(len(data) + 1)
    sums = np.concatenate([[np.uint64(0)], np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[:-1])])
    word = _mix((sums[last] - sums[first]) * down[first])
    n = len(word) - gram + 1
    g = np.zeros(n, np.uint64)
    for j in range(gram):
        g = g * _STEP + word[j : j + n]
    g = _mix(g)
    # least gram of each window: doubling, then two overlapping halves
    place, reach, span = np.arange(n), 1, width - gram + 1
    least = g
    while reach * 2 <= span:
        a, b = least[:-reach], least[reach:]
        left = a <= b
        least, place = np.where(left, a, b), np.where(left, place[:-reach], place[reach:])
        reach *= 2
    if reach < span:
        a, b = least[: len(least) - (span - reach)], least[span - reach :]
        left = a <= b
        least, place = np.where(left, a, b), np.where(left, place[: len(a)], place[span - reach :])
    windows = np.flatnonzero(doc[: len(word) - width + 1] == doc[width - 1 :])
    anchor, own = place[windows], doc[windows]
    new = np.ones(len(windows), bool)
    new[1:] = (anchor[1:] != anchor[:-1]) | (own[1:] != own[:-1])
    begin = np.flatnonzero(new)
    end = np.append(begin[1:], len(windows)) - 1 if len(begin) else begin
    return first, last, doc, own[begin], g[anchor[begin]], windows[begin], windows[end]


def _pieces(texts: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Texts of an array in pieces: number of the first, bytes, starts. Null texts are empty."""
    offsets = np.frombuffer(texts.buffers()[1], np.int32, len(texts) + 1, texts.offset * 4).astype(np.int64)
    whole = np.frombuffer(texts.buffers()[2], np.uint8) if texts.buffers()[2] is not None else np.empty(0, np.uint8)
    at = 0
    while at < len(texts):
        upto = max(at + 1, int(np.searchsorted(offsets, offsets[at] + PIECE, "right")) - 1)
        yield at, whole[offsets[at] : offsets[upto]], offsets[at:upto] - offsets[at]
        at = upto


def _anchors_of(width: int, gram: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, data, starts in _pieces(batch.column("text")):
                h = _segments(data, starts, width, gram)[4]
                yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64))], names=["anchor"])

    return run


def _segments_of(width: int, gram: int, bitmap, shift: int):
    """Rows ``anchor, words, doc, row_key, at, n`` of the segments whose anchors are in the bitmap."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.frombuffer(bitmap.value, np.uint64)
        for batch in batches:
            ids, keys = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("doc", "row_key"))
            for at, data, starts in _pieces(batch.column("text")):
                first, last, doc, own, h, begin, end = _segments(data, starts, width, gram)
                hit = np.flatnonzero(_hits(bits, shift, h))
                if not len(hit):
                    continue
                text = data.tobytes()
                own, h, begin, end = own[hit], h[hit], begin[hit], end[hit]
                words = [b" ".join(text[a:b].split()) for a, b in zip(first[begin].tolist(), last[end + width - 1].tolist())]
                zero = np.searchsorted(doc, own)  # number of the document's first word
                columns = [h.view(np.int64), pa.array(words, pa.binary()), ids[at + own], keys[at + own], (begin - zero).astype(np.int64), (end - begin + 1).astype(np.int32)]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["anchor", "words", "doc", "row_key", "at", "n"])

    return run


class Automaton:
    """Suffix automaton over several word sequences, with how often each state occurs."""

    def __init__(self):
        self.next: list[dict] = [{}]
        self.link, self.size, self.count = [-1], [0], [0]

    def _state(self, size: int) -> int:
        self.next.append({})
        self.link.append(0)
        self.size.append(size)
        self.count.append(0)
        return len(self.size) - 1

    def _split(self, p: int, word, q: int) -> int:
        clone = self._state(self.size[p] + 1)
        self.next[clone], self.link[clone], self.link[q] = dict(self.next[q]), self.link[q], clone
        while p >= 0 and self.next[p].get(word) == q:
            self.next[p][word] = clone
            p = self.link[p]
        return clone

    def add(self, words: list, times: int) -> None:
        at = 0
        for word in words:
            q = self.next[at].get(word)
            if q is not None:
                at = q if self.size[q] == self.size[at] + 1 else self._split(at, word, q)
            else:
                new, p = self._state(self.size[at] + 1), at
                while p >= 0 and word not in self.next[p]:
                    self.next[p][word] = new
                    p = self.link[p]
                if p >= 0:
                    q = self.next[p][word]
                    self.link[new] = q if self.size[q] == self.size[p] + 1 else self._split(p, word, q)
                at = new
            self.count[at] += times

    def close(self) -> None:
        """Add up occurrences along the suffix links."""
        for s in sorted(range(1, len(self.size)), key=self.size.__getitem__, reverse=True):
            self.count[self.link[s]] += self.count[s]

    def repeated(self, words: list, width: int) -> list[bool]:
        """For each window of a sequence, whether it occurs twice: streams the words, keeping the longest match up to ``width``."""
        at, out = 0, []
        for i, word in enumerate(words):
            at = self.next[at][word]
            while self.size[self.link[at]] >= width:
                at = self.link[at]
            if i >= width - 1:
                out.append(self.count[at] >= 2)
        return out


def _spans(flags: np.ndarray) -> tuple[list[int], list[int]]:
    edge = np.diff(np.concatenate([[0], np.asarray(flags, np.int8), [0]]))
    return np.flatnonzero(edge == 1).tolist(), (np.flatnonzero(edge == -1) - 1).tolist()


def _match(width: int):
    """Spans of repeated windows ``anchor, k1, k2, lo, hi`` of distinct segments that come sorted by anchor."""

    def shard(rows: list) -> Iterator[tuple]:
        automaton, split = Automaton(), [r.words.split(b" ") for r in rows]
        for r, w in zip(rows, split):
            automaton.add(w, r.times)
        automaton.close()
        for r, w in zip(rows, split):
            for lo, hi in zip(*_spans(np.array(automaton.repeated(w, width)))):
                yield r.anchor, r.k1, r.k2, lo, hi

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list = []
        out: list[tuple] = []
        for pdf in batches:
            for r in pdf.itertuples(index=False):
                if held and held[0].anchor != r.anchor:
                    out.extend(shard(held))
                    held = []
                held.append(r)
            yield pd.DataFrame(out, columns=["anchor", "k1", "k2", "lo", "hi"])
            out = []
        yield pd.DataFrame([x for x in shard(held)] if held else [], columns=["anchor", "k1", "k2", "lo", "hi"])

    return run


def _windows_of(width: int):
    """Every window of segments: ``anchor, k1, k2, lo, times, words``."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for r in pdf.itertuples(index=False):
                words = r.words.split(b" ")
                for lo in range(len(words) - width + 1):
                    out.append((r.anchor, r.k1, r.k2, lo, r.times, b" ".join(words[lo : lo + width])))
            yield pd.DataFrame(out, columns=["anchor", "k1", "k2", "lo", "times", "words"])

    return run


class Bitmap:
    """A bit for each anchor of a table, broadcast: at least 64 bits for each, and ``most_bits`` in all at most.

    Where that makes bits shared, more anchors seem to be in the table; the size stays bounded.
    """

    def __init__(self, anchors: DataFrame, most_bits: int):
        bits = max(64, min(most_bits, 1 << (anchors.count() * 64).bit_length()))
        self.shift = 64 - (bits.bit_length() - 1)
        slot = F.shiftrightunsigned("anchor", self.shift)
        bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), F.pmod(slot, F.lit(64)).cast("int"))
        found = anchors.groupBy(F.shiftright(slot, 6).alias("w")).agg(F.bit_or(bit).alias("bits")).toPandas()
        words = np.zeros(bits // 64, np.int64)
        words[found["w"].to_numpy(np.int64)] = found["bits"].to_numpy(np.int64)
        self.words = anchors.sparkSession.sparkContext.broadcast(words.tobytes())


def _hits(words: np.ndarray, shift: int, anchors: np.ndarray) -> np.ndarray:
    slot = anchors >> np.uint64(shift)
    return words[(slot >> np.uint64(6)).astype(np.int64)] >> (slot & np.uint64(63)) & np.uint64(1) != 0


def _in_bitmap(shared, shift: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = np.frombuffer(shared.value, np.uint64)
        for batch in batches:
            yield batch.filter(pa.array(_hits(words, shift, batch.column("anchor").to_numpy().view(np.uint64))))

    return run


def repeated_windows(docs: DataFrame, width: int, gram: int = GRAM, large: int = 20_000, most_bits: int = 1 << 29) -> DataFrame:
    """Spans ``doc, row_key, lo, hi`` of numbers of the words at which repeated windows start.

    ``docs`` has ``doc, row_key`` (bigint) and ``text`` (binary).
    """
    spark, gram = docs.sparkSession, min(gram, width)
    anchors = docs.select("text").mapInArrow(_anchors_of(width, gram), "anchor bigint")
    twice = Bitmap(stored(anchors.groupBy("anchor").agg(F.count("*").alias("times")).where("times > 1").select("anchor")), most_bits)
    found = docs.mapInArrow(_segments_of(width, gram, twice.words, twice.shift), "anchor bigint, words binary, doc bigint, row_key bigint, at bigint, n int")
    found = found.withColumns({"k1": F.xxhash64("words"), "k2": F.xxhash64(F.lit("segment"), "words")})
    place, keys = shared_dir(spark), ["anchor", "k1", "k2"]
    # the words are by far the largest column, and are read again for shards of several segments alone
    found.write.option("compression", "zstd").parquet(place)
    found = spark.read.schema(found.schema).parquet(place)
    distinct = found.groupBy(*keys).agg(F.count("*").alias("times"), F.max("n").alias("n"))
    distinct = stored(distinct)
    sized = distinct.groupBy("anchor").agg(F.count("*").alias("different"), F.sum("times").alias("total"))
    sized = stored(sized.where("total > 1"))
    alone = distinct.join(sized.where("different = 1").select("anchor"), "anchor").select(*keys, F.lit(0).alias("lo"), (F.col("n") - 1).alias("hi"))
    shards = sized.where("different > 1")
    several = Bitmap(shards.select("anchor"), most_bits)
    some = found.select(*keys, "words").mapInArrow(_in_bitmap(several.words, several.shift), "anchor bigint, k1 bigint, k2 bigint, words binary")
    some = some.groupBy(*keys).agg(F.count("*").alias("times"), F.max("words").alias("words"))
    few = some.join(shards.where(f"different <= {large}").select("anchor"), "anchor").repartition("anchor").sortWithinPartitions("anchor")
    few = few.mapInPandas(_match(width), "anchor bigint, k1 bigint, k2 bigint, lo int, hi int")
    spans = alone.unionByName(few)
    crowded = shards.where(f"different > {large}")
    if not crowded.isEmpty():
        many = some.join(crowded.select("anchor"), "anchor")
        windows = many.mapInPandas(_windows_of(width), "anchor bigint, k1 bigint, k2 bigint, lo int, times bigint, words binary")
        counted = windows.groupBy("words").agg(F.sum("times").alias("all")).where("all > 1")
        spans = spans.unionByName(windows.join(counted, "words").select(*keys, "lo", F.col("lo").alias("hi")))
    spans = found.select(*keys, "doc", "row_key", "at").join(spans, keys)
    spans = stored(spans.select("doc", "row_key", (F.col("at") + F.col("lo")).alias("lo"), (F.col("at") + F.col("hi")).alias("hi")))
    discard(place, spark)
    for used in (distinct, sized):
        discard(used)
    return spans


def _without(text: pd.Series, spans: pd.Series, width: pd.Series) -> pd.DataFrame:
    rows = []
    for t, found, w in zip(text, spans, width):
        words = t.split()
        n = len(words)
        if found is not None and len(found):
            cover = np.zeros(n + 1, np.int32)
            for s in found:
                cover[s["lo"]] += 1
                cover[s["hi"] + w] -= 1
            stay = np.cumsum(cover[:-1]) == 0
            words = [x for x, k in zip(words, stay.tolist()) if k]
        rows.append((n, n - len(words), b" ".join(words)))
    return pd.DataFrame(rows, columns=["n_words", "n_removed", "kept"])


def remove_repeats(docs: DataFrame, width: int = 35, gram: int = GRAM, large: int = 20_000, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with ``n_words, n_removed`` (bigint) and ``kept``: the text without repeated windows of ``width`` words.

    Words are as they stand, and come out joined by one space. A window that starts at any other place of any document
    is repeated; all its places go, and windows are judged on the input. A null or empty text has no words, and texts
    under ``width`` words lose none. Rows that repeat a document count as two documents. Texts of any length are taken
    whole; columns of the names that are added give way. An empty table gives no rows.
    """
    base = docs.withColumn("__text", F.coalesce(F.col(text), F.lit("")).cast("binary"))
    base = base.withColumns({"__doc": F.coalesce(F.col(doc_id).cast("bigint"), F.lit(-1)), "__row": F.xxhash64("__text", doc_id)})
    source = base.select(F.col("__doc").alias("doc"), F.col("__row").alias("row_key"), F.col("__text").alias("text"))
    spans = repeated_windows(source, width, gram, large).groupBy(F.col("doc").alias("__doc"), F.col("row_key").alias("__row"))
    spans = spans.agg(F.collect_set(F.struct("lo", "hi")).alias("__spans"))
    joined = base.join(spans, ["__doc", "__row"], "left")
    without = F.pandas_udf(_without, "n_words bigint, n_removed bigint, kept binary")
    joined = joined.withColumn("__out", without("__text", "__spans", F.lit(width)))
    out = joined.withColumns({"n_words": F.col("__out.n_words"), "n_removed": F.col("__out.n_removed"), "kept": F.col("__out.kept").cast("string")})
    return out.drop("__text", "__doc", "__row", "__spans", "__out")
