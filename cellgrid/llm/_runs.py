"""Runs of integers by string, as arrays: what encoders work out once for each different word."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Texts are taken in slices of about so many bytes (one text at least).
SLICE = 1 << 22


def text_slices(texts: pa.Array, size: int = SLICE) -> Iterator[pa.Array]:
    """Consecutive slices of a string array, each of about ``size`` bytes or of one longer text."""
    offsets = np.frombuffer(texts.buffers()[1], np.int32, len(texts) + 1, texts.offset * 4) if len(texts) else np.zeros(1, np.int32)
    at = 0
    while at < len(texts):
        upto = max(at + 1, int(np.searchsorted(offsets, int(offsets[at]) + size, "right")) - 1)
        yield texts.slice(at, upto - at)
        at = upto


def places(first: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The positions of runs that begin at ``first`` and have ``size`` elements, one run after the other."""
    upto = np.cumsum(size)
    return np.repeat(first - upto + size, size) + np.arange(upto[-1] if len(upto) else 0)


def sums(values: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Sums of the values between consecutive ends (the first begins at 0)."""
    total = np.concatenate([[0], np.cumsum(values)])[ends]
    return np.diff(total, prepend=0)


class Recall:
    """Runs by string. At most ``most`` strings, and none of over ``longest`` bytes, are remembered."""

    def __init__(self, most: int, longest: int):
        self.most, self.longest = most, longest
        self.names = pa.array([], pa.string())
        self.flat, self.size = np.empty(0, np.uint32), np.empty(0, np.int64)

    def runs(self, names: pa.Array, work: Callable[[pa.Array], tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """``flat, first, size`` of different strings; ``work`` gives the runs of those that are not known."""
        at = pc.index_in(names, value_set=self.names).fill_null(-1).to_numpy().astype(np.int64)
        missing = np.flatnonzero(at < 0)
        flat, size = self.flat, self.size
        if len(missing):
            new = names.take(pa.array(missing))
            more, its = work(new)
            at[missing] = len(size) + np.arange(len(missing))
            flat, size = np.concatenate([flat, more.astype(np.uint32)]), np.concatenate([size, its])
            self._keep(new, more, its)
        first = np.cumsum(size) - size
        return flat, first[at], size[at]

    def _keep(self, new: pa.Array, flat: np.ndarray, size: np.ndarray) -> None:
        short = np.flatnonzero(pc.less_equal(pc.binary_length(new), self.longest).to_numpy(zero_copy_only=False))[: self.most - len(self.names)]
        if len(short):
            first = np.cumsum(size) - size
            self.names = pa.concat_arrays([self.names, new.take(pa.array(short))])
            self.flat = np.concatenate([self.flat, flat[places(first[short], size[short])].astype(np.uint32)])
            self.size = np.concatenate([self.size, size[short]])
