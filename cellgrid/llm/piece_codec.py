"""SentencePiece encoding and decoding with an Aho-Corasick automaton and a single-pass Viterbi search.

The automaton over all pieces reads a text once. At each position its output links give the pieces that end there, and
each relaxes the best score of a segmentation that ends there. Ties go to the longest last piece. Characters that no
piece covers become byte pieces where the model has them. Automaton and search work on arrays: many texts take a step
together.

The pieces come from a model file and are sent to the tasks as a broadcast (at most a vocabulary, a few MB). Scores of a
unigram model are log-probabilities and are used as they are. A BPE model stores merge ranks instead; a piece of rank r
then gets the log-probability that Zipf's law gives it, -ln(r + 1) - ln(H) with H the harmonic sum over the pieces.

No piece has the space mark after another character, and none has a line feed, so a segmentation splits before each run
of spaces and around line feeds. Each part is segmented once and remembered, up to a bound.
"""

from __future__ import annotations

import ctypes
import math
import re
import uuid
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cellgrid.llm._runs import Recall, places, sums, text_slices

MARK = "▁"
#: Scores are kept as multiples of 1 / SCALE, so that sums are exact and ties are ties.
SCALE = 1 << 20
#: Cells of a Viterbi table; texts under which each is searched by itself; rows that are decoded, bytes that are encoded at once.
CELLS, FEW, ROWS, BYTES = 1 << 20, 8, 1000, 1 << 21


@dataclass(frozen=True)
class Vocabulary:
    """Pieces that the automaton looks for (text, score, id), byte pieces, the unknown piece and texts for decoding."""

    pieces: list[tuple[str, int, int]]
    bytes_: list[int] | None
    unknown: int
    unknown_score: int
    texts: list[bytes]
    splits: bool


def load_vocabulary(path: str) -> Vocabulary:
    """Read a SentencePiece model file."""
    import sentencepiece
    from sentencepiece import sentencepiece_model_pb2 as pb

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    proto = pb.ModelProto()
    with open(path, "rb") as f:
        proto.ParseFromString(f.read())
    ids = range(model.get_piece_size())
    plain = [i for i in ids if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))]
    raw = {i: model.get_score(i) for i in plain}
    if proto.trainer_spec.model_type == pb.TrainerSpec.BPE:
        harmonic = sum(1 / (k + 1) for k in range(len(plain)))
        raw = {i: -math.log(1 - s) - math.log(harmonic) for i, s in raw.items()}
    raw = {i: round(s * SCALE) for i, s in raw.items()}
    pieces = [(model.id_to_piece(i), raw[i], i) for i in plain]
    at = {model.id_to_piece(i): i for i in ids if model.is_byte(i)}
    octets = [at[f"<0x{b:02X}>"] for b in range(256)] if len(at) == 256 else None
    back = {i: b for b, i in enumerate(octets or [])}
    texts = [bytes([back[i]]) if i in back else b"" if model.is_control(i) else model.id_to_piece(i).replace(MARK, " ").encode() for i in ids]
    texts[model.unk_id()] = b" \xe2\x81\x87 "
    splits = not any("\n" in p or re.search(f"[^{MARK}]{MARK}", p) for p, _, _ in pieces)
    return Vocabulary(pieces, octets, model.unk_id(), min(raw.values()) - 10 * SCALE, texts, splits)


class Automaton:
    """The Aho-Corasick automaton of the pieces as arrays, so that many texts are read at once.

    Characters that are in no piece of several characters lead back to the root; all others have a column of their own.
    Transitions are complete (failure links are followed beforehand). ``out`` is the state of the longest piece that ends
    in a state, ``shorter`` that of the next one.
    """

    def __init__(self, pieces: list[tuple[str, int, int]]):
        joined = sorted({c for text, _, _ in pieces if len(text) > 1 for c in text})
        self.column = np.zeros(0x110000, np.uint16 if len(joined) < 65535 else np.uint32)
        self.column[[ord(c) for c in joined]] = np.arange(1, len(joined) + 1)
        self.alone = np.full(0x110000, -1, np.int32)  # pieces of one character
        children: list[dict[int, int]] = [{}]
        own: dict[int, tuple[int, int, int]] = {}
        for text, score, i in pieces:
            if len(text) == 1:
                self.alone[ord(text)] = i
            at, columns = 0, self.column[[ord(c) for c in text]].tolist()
            for c in columns if all(columns) else ():
                at = children[at].setdefault(c, len(children))
                if at == len(children):
                    children.append({})
            if at:
                own[at] = (len(text), score, i)
        n = len(children)
        self.size, self.score, self.piece = np.zeros(n, np.int64), np.zeros(n, np.int64), np.zeros(n, np.int32)
        for at, (size, score, i) in own.items():
            self.size[at], self.score[at], self.piece[at] = size, score, i
        fail, depth = np.zeros(n, np.int64), [[0]]
        self.row = np.zeros(n, np.int32)
        rows = [np.zeros(len(joined) + 1, np.uint16 if n < 65536 else np.uint32)]
        for c, child in children[0].items():
            rows[0][c] = child
        while depth[-1]:  # level by level, so that what a failure link leads to is complete
            for at in depth[-1] if depth[-1] != [0] else ():
                for c, child in children[at].items():
                    fail[child] = rows[self.row[fail[at]]][c]
                self.row[at] = self.row[fail[at]]
                if children[at]:
                    rows.append(rows[self.row[fail[at]]].copy())
                    self.row[at] = len(rows) - 1
                    rows[-1][list(children[at])] = list(children[at].values())
            depth.append([child for at in depth[-1] for child in children[at].values()])
        self.next = np.stack(rows)
        self.out, self.shorter = np.zeros(n, np.int32), np.zeros(n, np.int32)
        for level in depth[1:]:
            for at in level:
                self.shorter[at] = self.out[fail[at]]
                self.out[at] = at if self.size[at] else self.shorter[at]


class Segmenter:
    """The best segmentations by a vocabulary, and what it has segmented."""

    def __init__(self, vocabulary: Vocabulary, most: int = 600_000):
        self.vocabulary, self.known = vocabulary, Recall(most, 64)
        self.automaton = Automaton(vocabulary.pieces)
        self.score = np.zeros(1 + max((i for _, _, i in vocabulary.pieces), default=0), np.int64)
        for _, score, i in vocabulary.pieces:
            self.score[i] = score

    def segment(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of texts' best segmentations, one text after the other, and how many each has."""
        chars = np.frombuffer("".join(texts.to_pylist()).encode("utf-32-le"), "<u4")
        chars = np.where(chars == 32, np.uint32(ord(MARK)), chars)
        length = pc.utf8_length(texts).to_numpy().astype(np.int64)
        begin = np.cumsum(length) - length
        order = np.argsort(-length, kind="stable")
        found = []
        at = 0
        while at < len(order):  # longest first, so many at once that the tables stay small
            n = min(len(order) - at, max(1, CELLS // (int(length[order[at]]) + 1)))
            some = order[at : at + n]
            if n < FEW and length[some].max() > 64:  # a step for so few costs more than each by itself
                one = self._by_itself(chars[begin[some[0]] : begin[some[0]] + length[some[0]]])
                found.append((one, np.array([len(one)])))
                n = 1
            else:
                found.append(self._viterbi(chars, begin[some], length[some]))
            at += n
        flat = np.concatenate([f for f, _ in found] or [np.empty(0, np.int64)])
        size = np.concatenate([s for _, s in found] or [np.empty(0, np.int64)])
        back = np.empty_like(order)
        back[order] = np.arange(len(order))
        return self._spelled(flat[places((np.cumsum(size) - size)[back], size[back])], size[back])

    def _viterbi(self, chars: np.ndarray, begin: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Pieces (or -1 - c for a character c that no piece covers) of texts that come longest first."""
        a, unknown = self.automaton, self.vocabulary.unknown_score
        most, n = int(length[0]), len(length)
        best = np.zeros((most + 1, n), np.int64)
        piece, step = np.zeros((most + 1, n), np.int32), np.ones((most + 1, n), np.int32)
        state = np.zeros(n, np.int64)
        upto = n - np.searchsorted(length[::-1], np.arange(most), "right")
        for t in range(most):
            k = upto[t]  # the texts that are longer than t
            c = chars[begin[:k] + t]
            state = a.next[a.row[state[:k]], a.column[c]].astype(np.int64)
            # a character by itself, as a piece or as none; then all longer pieces that end here, from short to long
            own = a.alone[c]
            top = best[t, :k] + np.where(own >= 0, self.score[own], unknown)
            last, size = np.where(own >= 0, own, -1 - c.astype(np.int64)), np.ones(k, np.int32)
            at, out = np.arange(k), a.out[state]
            while len(at := at[out > 0]):
                out = out[out > 0]
                total = best[t + 1 - a.size[out], at] + a.score[out]
                # of equal scores the longest last piece wins
                better = (total > top[at]) | ((total == top[at]) & (a.size[out] > size[at]))
                w, s = at[better], out[better]
                top[w], last[w], size[w] = total[better], a.piece[s], a.size[s]
                out = a.shorter[out]
            best[t + 1, :k], piece[t + 1, :k], step[t + 1, :k] = top, last, size
        at, which, taken = length.copy(), np.arange(n), []
        while len(which := which[at[which] > 0]):
            taken.append((which, piece[at[which], which]))
            at[which] -= step[at[which], which]
        count = np.zeros(n, np.int64)
        for w, _ in taken:
            count[w] += 1
        flat, end = np.empty(count.sum(), np.int64), np.cumsum(count)
        for k, (w, p) in enumerate(taken):  # from the last piece to the first
            flat[end[w] - 1 - k] = p
        return flat, count

    def _by_itself(self, chars: np.ndarray) -> np.ndarray:
        """The same search over one long text."""
        a, score, unknown = self.automaton, self.score, self.vocabulary.unknown_score
        best, taken, state = [0], [], 0
        own = a.alone[chars]
        alone = zip(own.tolist(), np.where(own >= 0, score[own], unknown).tolist(), chars.tolist(), a.column[chars].tolist())
        for t, (i, s, c, column) in enumerate(alone):
            top, last, size = best[t] + s, i if i >= 0 else -1 - c, 1
            state = a.next.item(a.row.item(state), column)
            at = a.out.item(state)
            while at:
                n = a.size.item(at)
                total = best[t + 1 - n] + a.score.item(at)
                if total > top or (total == top and n > size):
                    top, last, size = total, a.piece.item(at), n
                at = a.shorter.item(at)
            best.append(top)
            taken.append((last, size))
        out, at = [], len(taken)
        while at:
            last, size = taken[at - 1]
            out.append(last)
            at -= size
        return np.array(out[::-1], np.int64)

    def _spelled(self, flat: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Uncovered characters as byte pieces where the model has them, else as the unknown piece."""
        odd = np.flatnonzero(flat < 0)
        if not len(odd):
            return flat, size
        v = self.vocabulary
        spelled = [[v.bytes_[b] for b in chr(-1 - c).encode()] if v.bytes_ else [v.unknown] for c in flat[odd].tolist()]
        each = np.ones(len(flat), np.int64)
        each[odd] = list(map(len, spelled))
        out = np.repeat(flat, each)
        out[places((np.cumsum(each) - each)[odd], each[odd])] = [i for s in spelled for i in s]
        return out, sums(each, np.cumsum(size))

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of texts without nulls, one text after the other, and how many each has."""
        spaced = pc.replace_substring(texts, MARK, " ")
        marked = pc.binary_join_element_wise(pc.if_else(pc.equal(texts, ""), "", " "), spaced, "")
        if not self.vocabulary.splits:
            return self.segment(marked)
        offsets = np.frombuffer(marked.buffers()[1], np.int32, len(marked) + 1, marked.offset * 4)
        data = np.frombuffer(marked.buffers()[2], np.uint8)[: offsets[-1]] if offsets[-1] else np.empty(0, np.uint8)
        space, feed = data == 32, data == 10
        head = feed.copy()
        head[1:] |= feed[:-1] | (space[1:] & ~space[:-1])
        head[offsets[:-1][offsets[:-1] < len(data)]] = True
        begin = np.flatnonzero(head)
        ends = pa.py_buffer(np.append(begin, len(data)).astype(np.int32).tobytes())
        parts = pc.dictionary_encode(pa.StringArray.from_buffers(len(begin), ends, marked.buffers()[2]))
        flat, first, size = self.known.runs(parts.dictionary, self.segment)
        at = parts.indices.to_numpy()
        return flat[places(first[at], size[at])], sums(size[at], np.searchsorted(begin, offsets[1:]))


#: The segmenter of the last vocabulary that this Python worker used: tasks that follow go on with what it knows.
_LAST: dict[str, Segmenter] = {}


def _give_back() -> None:
    """Return freed memory to the system: a worker keeps what its earlier tasks have freed, beside the JVM that needs it."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:  # glibc has it
        trim(0)


def _segmenter(key: str, vocabulary: Vocabulary) -> Segmenter:
    if key not in _LAST:
        _LAST.clear()
        _give_back()
        _LAST[key] = Segmenter(vocabulary)
    _give_back()
    return _LAST[key]


def encoder(spark: SparkSession, vocabulary: Vocabulary):
    """A function from a text column to its ids, ``array<int>``. A null text gives null, an empty one no ids."""
    shared, key = spark.sparkContext.broadcast(vocabulary), uuid.uuid4().hex

    @F.arrow_udf("array<int>")
    def encode(texts: pa.Array) -> pa.Array:
        segmenter = _segmenter(key, shared.value)
        found = [segmenter.encode(part) for part in text_slices(texts.fill_null(""), BYTES)]
        values = np.concatenate([f for f, _ in found] or [np.empty(0)]).astype(np.int32)
        offsets = np.concatenate([[0], np.cumsum(np.concatenate([s for _, s in found] or [np.empty(0)]))]).astype(np.int32)
        return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values), mask=texts.is_null())

    return encode


class Speller:
    """Texts from ids: the pieces' bytes, one after the other, without the space that encoding puts first."""

    def __init__(self, texts: list[bytes]):
        self.n, self.empty = len(texts), np.array([not t for t in texts])
        self.pieces = pa.array([*texts, *(t.removeprefix(b" ") for t in texts)], pa.binary())

    def decode(self, flat: np.ndarray, size: np.ndarray) -> pa.Array:
        begin = np.cumsum(size) - size
        first = begin[size > 0]
        if self.empty[flat[first]].any():
            return self._slowly(flat, size)
        which = flat.astype(np.int64)
        which[first] += self.n
        taken = self.pieces.take(pa.array(which))
        at = np.frombuffer(taken.buffers()[1], np.int32, len(taken) + 1, taken.offset * 4)
        offsets = pa.py_buffer(np.append(at[begin], at[-1]).astype(np.int32).tobytes())
        out = pa.StringArray.from_buffers(len(size), offsets, taken.buffers()[2])
        try:
            out.validate(full=True)
        except pa.ArrowInvalid:  # byte pieces that are no UTF-8
            return self._slowly(flat, size)
        return out

    def _slowly(self, flat: np.ndarray, size: np.ndarray) -> pa.Array:
        pieces = self.pieces.to_pylist()
        rows = np.split(flat, np.cumsum(size)[:-1]) if len(size) else []
        return pa.array([b"".join(pieces[i] for i in row.tolist()).removeprefix(b" ").decode(errors="replace") for row in rows], pa.string())


def decoder(spark: SparkSession, vocabulary: Vocabulary):
    """A function from an ids column to the text: the inverse of :func:`encoder` for texts without the space mark."""
    shared = spark.sparkContext.broadcast(vocabulary.texts)

    @F.arrow_udf("string")
    def decode(ids: pa.Array) -> pa.Array:
        speller, out = Speller(shared.value), []
        for at in range(0, len(ids), ROWS):
            some = ids.slice(at, ROWS)
            size = pc.list_value_length(some).fill_null(0).to_numpy().astype(np.int64)
            texts = speller.decode(some.flatten().to_numpy(), size)
            out.append(pc.if_else(some.is_valid(), texts, pa.scalar(None, pa.string())))
        return pa.concat_arrays(out or [pa.array([], pa.string())])

    return decode


def encode_texts(docs: DataFrame, model: str, text: str | Column = "text", out: str = "ids") -> DataFrame:
    """``docs`` with the ids of a text column in ``out``, in place of a column of that name.

    The ids are those of the best segmentation by the model's scores. A model of merge ranks (BPE) has no such scores and
    gets them from its ranks, so its ids differ from what its own merges give. A null text has null ids, an empty text
    none; texts of any length are encoded whole; repeated rows have equal ids; an empty table gives no rows.
    """
    return docs.withColumn(out, encoder(docs.sparkSession, load_vocabulary(model))(F.col(text) if isinstance(text, str) else text))


def decode_ids(df: DataFrame, model: str, ids: str = "ids", out: str = "text") -> DataFrame:
    """``df`` with the text of an ids column in ``out``."""
    return df.withColumn(out, decoder(df.sparkSession, load_vocabulary(model))(F.col(ids)))
