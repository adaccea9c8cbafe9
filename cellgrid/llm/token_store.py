"""Token ids in binary files, coded by a static range asymmetric numeral system (Duda, 2013).

The documents are dealt into ranges of ascending doc_id. Within a range they form groups of about ``group`` ids. A group
is one row of a Parquet file: its documents and their sizes, its frequency table, counted over all its ids, and blocks of
``block`` ids that share the table but are coded independently. A block's ids are interleaved over ``lanes`` coder states,
so that a step codes one id of each lane with array operations, and it carries its first states, checkpoints from which
decoding can start in its midst, and a CRC-32 of its ids.

States have 63 bits and renormalise by 32-bit words; words are stored in the order in which a decoder reads them.
"""

from __future__ import annotations

import itertools
import os
import random
import re
import zlib
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cellgrid.llm._runs import Recall, places, sums, text_slices

LOW = np.uint64(1 << 31)
BITS32 = np.uint64(32)

CHECKPOINT = "struct<step:int,word:int,states:binary>"
BLOCK = f"struct<n:int,words:binary,states:binary,checkpoints:array<{CHECKPOINT}>,crc32:bigint>"
SCHEMA = f"segment int, part int, n_ids bigint, lanes int, scale int, frequencies binary, doc_ids array<bigint>, sizes array<bigint>, blocks array<{BLOCK}>"


@dataclass(frozen=True)
class Table:
    """Frequencies that sum to 2**scale, their prefix sums, and the symbol of each slot."""

    scale: int
    frequency: np.ndarray
    begin: np.ndarray

    @classmethod
    def counted(cls, counts: np.ndarray) -> Table:
        """Frequencies near the counts' shares; what occurs gets one at least."""
        present = np.flatnonzero(counts)
        scale = max(12, min(24, int(len(present)).bit_length() + 3))
        share = np.maximum(1, counts[present] * ((1 << scale) - len(present)) // max(1, counts.sum()))
        share[np.argmax(share)] += (1 << scale) - share.sum()
        frequency = np.zeros(len(counts), np.uint64)
        frequency[present] = share
        return cls.of(scale, frequency)

    @classmethod
    def of(cls, scale: int, frequency: np.ndarray) -> Table:
        return cls(scale, frequency, np.cumsum(frequency) - frequency)

    def packed(self) -> bytes:
        return zlib.compress(self.frequency.astype("<u4").tobytes(), 6)

    @classmethod
    def unpacked(cls, scale: int, data: bytes) -> Table:
        return cls.of(scale, np.frombuffer(zlib.decompress(data), "<u4").astype(np.uint64))

    def slots(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.frequency), dtype=np.uint32), self.frequency.astype(np.int64))


def encode_block(ids: np.ndarray, table: Table, lanes: int, every: int) -> dict:
    """Code ids; a checkpoint every ``every`` steps."""
    x, words, checkpoints, written = np.full(lanes, LOW), [], [], 0
    scale, room = np.uint64(table.scale), np.uint64(63 - table.scale)
    frequency, begin = table.frequency[ids], table.begin[ids]
    steps = -(-len(ids) // lanes)
    for t in range(steps - 1, -1, -1):
        f, b = frequency[t * lanes : (t + 1) * lanes], begin[t * lanes : (t + 1) * lanes]
        y = x[: len(f)]
        full = y >= f << room
        if full.any():
            words.append((y[full] & np.uint64(0xFFFFFFFF)).astype("<u4"))
            written += len(words[-1])
            y = np.where(full, y >> BITS32, y)
        q, r = np.divmod(y, f)
        x[: len(f)] = (q << scale) + r + b
        if t and t % every == 0:
            checkpoints.append((t, written, x.astype("<u8").tobytes()))
    words.reverse()
    return {
        "words": b"".join(w.tobytes() for w in words),
        "states": x.astype("<u8").tobytes(),
        "checkpoints": [{"step": t, "word": written - n, "states": s} for t, n, s in reversed(checkpoints)],
        "crc32": zlib.crc32(ids.astype("<u4").tobytes()),
    }


def decode_block(words: bytes, states: bytes, n: int, table: Table, slots: np.ndarray, lanes: int, step: int = 0, word: int = 0) -> np.ndarray:
    """Ids from ``step`` on (0, or a checkpoint's step with its word and states) to the block's end, ``n`` ids in all."""
    stream, x = np.frombuffer(words, "<u4").astype(np.uint64), np.frombuffer(states, "<u8").astype(np.uint64)
    scale, mask = np.uint64(table.scale), np.uint64((1 << table.scale) - 1)
    out = np.empty(n, np.uint32)
    for t in range(step, -(-n // lanes)):
        y = x[: min(lanes, n - t * lanes)]
        slot = y & mask
        s = slots[slot]
        out[t * lanes : t * lanes + len(y)] = s
        y = table.frequency[s] * (y >> scale) + slot - table.begin[s]
        low = np.flatnonzero(y < LOW)
        if len(low):
            y[low] = (y[low] << BITS32) | stream[word : word + len(low)]
            word += len(low)
        x[: len(y)] = y
    return out[step * lanes :]


def _group(segment: int, part: int, docs: list[tuple[int | None, np.ndarray]], lanes: int, block: int, every: int) -> dict:
    ids = np.concatenate([d for _, d in docs])
    table = Table.counted(np.bincount(ids))
    blocks = [{"n": len(ids[i : i + block])} | encode_block(ids[i : i + block], table, lanes, every) for i in range(0, len(ids), block)]
    held = {"doc_ids": [k for k, _ in docs], "sizes": [len(d) for _, d in docs], "n_ids": len(ids)}
    return {"segment": segment, "part": part, "lanes": lanes, "scale": table.scale, "frequencies": table.packed(), "blocks": blocks} | held


def write_ids(docs: DataFrame, path: str, content: str = "ids", encode: Callable[[pa.Array], Iterable[pa.Array]] | None = None, lanes: int = 1024, block: int = 1 << 17, group: int = 1 << 21, every: int = 64, rows: int = 8192) -> DataFrame:
    """Write the ids of ``docs`` as coded files in ascending doc_id order; returns what :func:`read_ids` does.

    ``content`` holds little-endian 32-bit integers, all at least 0 and under 2**24, or texts that ``encode`` makes such
    integers of (:func:`text_encoder`). The rows are dealt out by ranges of doc_id, about ``rows`` each, and then turned
    into groups by one task a range, which holds one group and one slice of texts at a time. Null ids come
    first; rows of one doc_id come in order of a hash of their content, so that reruns agree. Null content counts as no
    ids, and a document without ids is kept; one of any length may fill many blocks; an empty table gives files without
    rows. Other columns of ``docs`` are not read.
    """
    spark = docs.sparkSession
    rows_ = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col(content).alias("content"))
    order = [F.col("doc_id").asc_nulls_first(), F.xxhash64("content")]
    dealt = rows_.repartitionByRange(max(1, -(-docs.count() // rows)), *order).sortWithinPartitions(*order)
    checkpoint = pa.struct([("step", pa.int32()), ("word", pa.int32()), ("states", pa.binary())])
    block_type = pa.struct([("n", pa.int32()), ("words", pa.binary()), ("states", pa.binary()), ("checkpoints", pa.list_(checkpoint)), ("crc32", pa.int64())])
    fields = [("segment", pa.int32()), ("part", pa.int32()), ("n_ids", pa.int64()), ("lanes", pa.int32()), ("scale", pa.int32()), ("frequencies", pa.binary())]
    names = pa.schema([*fields, ("doc_ids", pa.list_(pa.int64())), ("sizes", pa.list_(pa.int64())), ("blocks", pa.list_(block_type))])

    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        segment, part, held, size = TaskContext.get().partitionId(), 0, [], 0
        for batch in batches:
            content = batch.column("content")
            parts = encode(content) if encode else [content]
            for doc, data in zip(batch.column("doc_id").to_pylist(), itertools.chain.from_iterable(parts)):
                if size >= group:
                    yield pa.RecordBatch.from_pylist([_group(segment, part, held, lanes, block, every)], schema=names)
                    part, held, size = part + 1, [], 0
                own = np.frombuffer(data.as_buffer(), "<u4") if data.is_valid and len(data.as_buffer()) else np.empty(0, np.uint32)
                held.append((doc, own.copy()))
                size += len(own)
        if held:
            yield pa.RecordBatch.from_pylist([_group(segment, part, held, lanes, block, every)], schema=names)

    dealt.mapInArrow(coded, SCHEMA).write.parquet(path)
    return read_ids(spark, path)


def read_ids(spark: SparkSession, path: str, with_ids: bool = True) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` and, unless left out, ``ids`` (binary) of each document in the files.

    ``start`` counts the ids of all documents before. Blocks are checked against their CRC-32. Groups are decoded in
    parallel; their first positions come from sums over the groups of a range and over the ranges, a few numbers each.
    """
    groups = spark.read.schema(SCHEMA).parquet(path)
    sizes = groups.select("segment", "part", "n_ids")
    before = lambda w: F.coalesce(F.sum("n_ids").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    in_segment = sizes.withColumn("__at", before(Window.partitionBy("segment").orderBy("part")))
    segments = sizes.groupBy("segment").agg(F.sum("n_ids").alias("n_ids"))
    segments = segments.select("segment", before(Window.orderBy("segment")).alias("__first"))
    bases = in_segment.join(segments, "segment").select("segment", "part", (F.col("__at") + F.col("__first")).alias("__base"))
    schema = "segment int, part int, doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint" + ", ids binary" * with_ids

    def decoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for g in (r for i in range(batch.num_rows) for r in batch.slice(i, 1).to_pylist()):
                table = Table.unpacked(g["scale"], g["frequencies"])
                slots, whole = table.slots(), []
                for b in g["blocks"]:
                    whole.append(decode_block(b["words"], b["states"], b["n"], table, slots, g["lanes"]).astype("<u4").tobytes())
                    if zlib.crc32(whole[-1]) != b["crc32"]:
                        raise ValueError(f"damaged block in segment {g['segment']}, part {g['part']}")
                raw, n = b"".join(whole), np.array(g["sizes"], np.int64)
                end = np.cumsum(n)
                own = [raw[4 * a : 4 * b] for a, b in zip((end - n).tolist(), end.tolist())]
                columns = [pa.array([g[k]] * len(n), pa.int32()) for k in ("segment", "part")]
                columns += [pa.array(g["doc_ids"], pa.int64()), pa.array(end - n), pa.array(n), pa.array(list(map(zlib.crc32, own)), pa.int64())]
                columns += [pa.array(own, pa.binary())] if with_ids else []
                yield pa.RecordBatch.from_arrays(columns, names=re.findall(r"(\w+) \w+", schema))

    docs = groups.mapInArrow(decoded, schema).join(bases, ["segment", "part"])
    return docs.withColumn("start", F.col("start") + F.col("__base")).drop("segment", "part", "__base")


# ---- ids from a tokenizers file

#: Pieces longer than LONGEST bytes are not remembered, nor more than so many; that bounds what a worker holds.
LONGEST, MOST_PIECES = 40, 600_000

#: Words of these characters alone (printable ASCII, U+00C0 to U+00FF) fall into pieces by the pattern below.
PLAIN = "^[!-~\u00c0-\u00ff]+$"
#: The pre-tokeniser's pattern, after lower-casing, for such words.
LETTERS = "[a-z\u00df-\u00f6\u00f8-\u00ff]+"
PIECES = f"'s|'t|'re|'ve|'m|'ll|'d|{LETTERS}|[0-9]|[^a-z0-9\u00df-\u00f6\u00f8-\u00ff]+"


def _byte_letters() -> dict[int, str]:
    """Each character from U+00C0 to U+00FF as the letters that stand for its UTF-8 bytes in a byte-level vocabulary.

    Bytes 33-126, 161-172 and 174-255 stand for themselves; the others, in order, for the characters from U+0100.
    """
    own = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b]
    letter = {b: chr(b) for b in own} | {b: chr(256 + i) for i, b in enumerate(b for b in range(256) if b not in own)}
    return {c: "".join(letter[b] for b in chr(c).encode()) for c in range(0xC0, 0x100)}


class Words:
    """The ids of words by a tokenizer.

    Words of plain letters are cut into pieces, each different one of which the tokenizer's model encodes once; the
    tokenizer encodes all other words, and those that hold an added token's string, whole. That short way is only taken
    if it agrees with the tokenizer on ``trials`` words: every plain character alone, and random words of them.
    """

    def __init__(self, definition: str, trials: int = 4000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(definition)
        # strings that the library finds in a text before it cuts it into pieces, before or after lower-casing
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.pieces = Recall(MOST_PIECES, LONGEST)
        self.letters = _byte_letters()
        self.plain = self._agrees(trials)

    def _agrees(self, trials: int) -> bool:
        plain = [chr(c) for c in (*range(0x21, 0x7F), *range(0xC0, 0x100))]
        chance = random.Random(7)
        tried = [*plain, *("".join(chance.choices(plain, k=chance.randint(2, 9))) for _ in range(trials // 2))]
        tried += ["".join(chance.choices("aeinst'Td\u00e9.,1", k=chance.randint(2, 12))) for _ in range(trials - len(tried))]
        tried = [w for w in tried if not any(t.lower() in w.lower() for t in self.added)]
        short, whole = (list(map(bytes, np.split(f.astype("<u4"), np.cumsum(n)[:-1]))) for f, n in (self._in_pieces(pa.array(tried)), self._whole(pa.array(tried))))
        return short == whole

    def _whole(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        return _flat([e.ids for e in self.tokenizer.encode_batch_fast(words.to_pylist(), add_special_tokens=False)])

    def _modelled(self, pieces: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        model, letters = self.tokenizer.model, self.letters
        return _flat([[t.id for t in model.tokenize(p if p.isascii() else p.translate(letters))] for p in pieces.to_pylist()])

    def _in_pieces(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        lower = pc.utf8_lower(words)
        mixed = pc.invert(pc.match_substring_regex(lower, pattern=f"^{LETTERS}$"))  # the others are one piece each
        apart = pc.replace_substring_regex(lower.filter(mixed), pattern=f"({PIECES})", replacement="\\0 ")
        split = pc.split_pattern(pc.replace_with_mask(lower, mixed, pc.ascii_rtrim(apart, " ")), " ")
        coded = pc.dictionary_encode(split.flatten())
        flat, first, size = self.pieces.runs(coded.dictionary, self._modelled)
        at = coded.indices.to_numpy()
        return flat[places(first[at], size[at])], sums(size[at], split.offsets.to_numpy()[1:] - split.offsets[0].as_py())

    def _of(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """``flat, first, size`` of different words."""
        short = pc.match_substring_regex(words, pattern=PLAIN).to_numpy(zero_copy_only=False) & self.plain
        for t in self.added:
            short &= ~pc.match_substring(pc.utf8_lower(words), t.lower()).to_numpy(zero_copy_only=False)
        size, parts = np.zeros(len(words), np.int64), []
        for chosen, encode in ((short, self._in_pieces), (~short, self._whole)):
            if chosen.any():
                flat, size[chosen] = encode(words.filter(pa.array(chosen)))
                parts.append(flat)
        first = np.zeros(len(words), np.int64)
        order = np.concatenate([np.flatnonzero(short), np.flatnonzero(~short)])
        first[order] = np.cumsum(size[order]) - size[order]
        return np.concatenate([np.empty(0, np.uint32), *parts]), first, size

    def encode(self, texts: pa.Array, end: int) -> pa.Array:
        """The ids of texts without nulls, ``end`` after each: every different word is looked up once."""
        split = pc.ascii_split_whitespace(texts)
        coded = pc.dictionary_encode(split.flatten())
        flat, first, size = self._of(coded.dictionary)
        flat, first, size = np.append(flat, end), np.append(first, len(flat)), np.append(size, 1)
        ends = split.offsets.to_numpy()[1:] - split.offsets[0].as_py()
        word = np.insert(coded.indices.to_numpy(), ends, len(size) - 1)
        out = flat[places(first[word], size[word])].astype("<u4")
        offsets = np.concatenate([[0], 4 * np.cumsum(sums(size[word], ends + 1 + np.arange(len(ends))))]).astype(np.int32)
        return pa.Array.from_buffers(pa.binary(), len(texts), [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(out.tobytes())])


def _flat(ids: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    """Lists as one array and their sizes."""
    return np.fromiter(itertools.chain.from_iterable(ids), np.uint32), np.fromiter(map(len, ids), np.int64, len(ids))


#: The words of the tokenizer that this Python worker used last.
_LAST: dict[str, Words] = {}


def text_encoder(spark: SparkSession, definition: str, end_id: int) -> Callable[[pa.Array], Iterator[pa.Array]]:
    """A function for tasks: from texts to their ids and ``end_id``, as little-endian 32-bit integers, slice by slice.

    ``definition`` is the text of a file of the tokenizers library whose normaliser and pre-tokeniser drop white space
    and never look across it, so that words are encoded apart. A null text counts as empty; texts are encoded whole,
    however long.
    """
    shared, key = spark.sparkContext.broadcast(definition), str(zlib.crc32(definition.encode()))

    def encode(texts: pa.Array) -> Iterator[pa.Array]:
        if key not in _LAST:
            _LAST.clear()
            _LAST[key] = Words(shared.value)
        return (_LAST[key].encode(part, end_id) for part in text_slices(texts.fill_null("")))

    return encode


def tokenizer_ids(spark: SparkSession, definition: str, end_id: int):
    """:func:`text_encoder` as a function from a text column to a binary column."""
    encode = text_encoder(spark, definition, end_id)

    @F.arrow_udf("binary")
    def of(texts: pa.Array) -> pa.Array:
        return pa.concat_arrays([*encode(texts), pa.array([], pa.binary())])

    return of
