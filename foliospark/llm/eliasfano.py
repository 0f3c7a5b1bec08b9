"""Elias-Fano sequences and files of arrays that are mapped, not loaded.

A sequence that never falls is held as packed low bits and as high parts in
unary, with the ones and zeros before each word of 64 bits. Elements and
successors are found for whole arrays of questions at once.
"""

from __future__ import annotations

import json
import tempfile
from collections import OrderedDict

import numpy as np
from pyarrow import fs

_U = np.uint64


def _mask(width: int) -> np.uint64:
    return _U((1 << width) - 1)


def _select(words: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """Place of the one of ``rank`` (from 0) in each word."""
    at = np.zeros(len(words), np.int64)
    for width in (32, 16, 8, 4, 2, 1):
        low = words & _mask(width)
        ones = np.bitwise_count(low).astype(np.int64)
        over = rank >= ones
        rank = rank - np.where(over, ones, 0)
        words = np.where(over, words >> _U(width), low)
        at += np.where(over, width, 0)
    return at


def encode(values: np.ndarray) -> dict[str, np.ndarray]:
    """Arrays of a sequence of numbers below 2 ** 64 that never falls."""
    values = values.astype(_U)
    n = len(values)
    last = int(values[-1]) if n else 0
    width = max(0, ((last + 1) // max(n, 1)).bit_length() - 1)
    where = np.arange(n, dtype=np.int64) * width
    low = np.zeros(n * width // 64 + 2, _U)
    if n and width:
        word, shift = where >> 6, (where & 63).astype(_U)
        lows = values & _mask(width)
        starts = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]]))
        low[word[starts]] = np.bitwise_or.reduceat(lows << shift, starts)
        over = np.flatnonzero((where & 63) + width > 64)
        low[word[over] + 1] |= lows[over] >> (_U(64) - shift[over])
    places = (values >> _U(width)).astype(np.int64) + np.arange(n)
    bits = np.zeros((n + (last >> width) + 1) // 64 + 1, _U)
    if n:
        word = places >> 6
        starts = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]]))
        bits[word[starts]] = np.bitwise_or.reduceat(_U(1) << (places & 63).astype(_U), starts)
    ones = np.concatenate([[0], np.cumsum(np.bitwise_count(bits).astype(np.int64))])[:-1]
    zeros = 64 * np.arange(len(bits)) - ones
    return {"shape": np.array([n, width, last], _U), "low": low, "bits": bits, "ones": ones.astype(np.uint32), "zeros": zeros.astype(np.uint32)}


class Monotone:
    """A sequence over (mapped) arrays of :func:`encode`."""

    def __init__(self, arrays: dict[str, np.ndarray]):
        self.n, self.width, self.last = (int(x) for x in arrays["shape"])
        self.low, self.bits, self.ones, self.zeros = (arrays[c] for c in ("low", "bits", "ones", "zeros"))

    def _low(self, i: np.ndarray) -> np.ndarray:
        if not self.width:
            return np.zeros(len(i), _U)
        where = i * self.width
        word, shift = where >> 6, (where & 63).astype(_U)
        more = np.where(shift > 0, self.low[word + 1] << ((_U(64) - shift) & _U(63)), _U(0))
        return (self.low[word] >> shift | more) & _mask(self.width)

    def take(self, i: np.ndarray) -> np.ndarray:
        """The elements at places ``i``."""
        i = np.asarray(i, np.int64)
        word = np.searchsorted(self.ones, i.astype(np.uint32), side="right") - 1
        place = 64 * word + _select(self.bits[word], i - self.ones[word].astype(np.int64))
        return (place - i).astype(_U) << _U(self.width) | self._low(i)

    def _before(self, high: np.ndarray) -> np.ndarray:
        """How many elements have a high part of ``high`` at most."""
        word = np.searchsorted(self.zeros, high.astype(np.uint32), side="right") - 1
        place = 64 * word + _select(~self.bits[word], high - self.zeros[word].astype(np.int64))
        return place - high

    def successor(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each number the place of the first element that is not below it, and whether that equals it."""
        x = np.asarray(x, _U)
        inside = (x <= _U(self.last)) & (self.n > 0)
        x = np.where(inside, x, _U(0))
        high, low = (x >> _U(self.width)).astype(np.int64), x & _mask(self.width)
        start = np.where(high > 0, self._before(np.maximum(high - 1, 0)), 0)
        end = self._before(high)
        left, right = start.copy(), end.copy()
        open_ = np.flatnonzero(left < right)
        while len(open_):
            middle = (left[open_] + right[open_]) >> 1
            below = self._low(middle) < low[open_]
            left[open_] = np.where(below, middle + 1, left[open_])
            right[open_] = np.where(below, right[open_], middle)
            open_ = open_[left[open_] < right[open_]]
        same = left < end
        same[same] = self._low(left[same]) == low[same]
        return np.where(inside, left, self.n), same & inside


def split(arrays: dict[str, np.ndarray], name: str) -> dict[str, np.ndarray]:
    """Those arrays whose names begin with ``name`` and a dot."""
    return {k[len(name) + 1 :]: v for k, v in arrays.items() if k.startswith(name + ".")}


def named(name: str, arrays: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    return {f"{name}.{k}": v for k, v in arrays.items()}


def save(uri: str, arrays: dict[str, np.ndarray]) -> None:
    """Write arrays one after the other behind a header, in any store that pyarrow opens."""
    store, path = fs.FileSystem.from_uri(uri)
    head, at = {}, 0
    for name, x in arrays.items():
        head[name] = (x.dtype.str, len(x), at)
        at += -(-x.nbytes // 8) * 8
    text = json.dumps(head).encode()
    text += b" " * (-len(text) % 8)
    store.create_dir(path.rpartition("/")[0], recursive=True)
    with store.open_output_stream(path) as out:
        out.write(len(text).to_bytes(8, "little") + text)
        for x in arrays.values():
            out.write(np.ascontiguousarray(x).tobytes() + b"\0" * (-x.nbytes % 8))


def mapped(uri: str) -> dict[str, np.ndarray]:
    """Arrays of a file, as views of mapped memory. A file that is not on a mounted store is copied to an unlinked one first."""
    store, path = fs.FileSystem.from_uri(uri)
    if isinstance(store, fs.LocalFileSystem):
        data = np.memmap(path, np.uint8, "r")
    else:
        with tempfile.TemporaryFile() as own:  # unlinked: it goes with the mapping
            with store.open_input_stream(path) as file:
                while block := file.read(1 << 22):
                    own.write(block)
            own.flush()
            data = np.memmap(own, np.uint8, "r")
    size = int.from_bytes(data[:8].tobytes(), "little")
    head, start = json.loads(data[8 : 8 + size].tobytes()), 8 + size
    return {name: data[start + at : start + at + n * np.dtype(kind).itemsize].view(kind) for name, (kind, n, at) in head.items()}


#: Mappings that a worker keeps open.
KEPT = 4096
_OPEN: OrderedDict[str, dict[str, np.ndarray]] = OrderedDict()


def opened(uri: str) -> dict[str, np.ndarray]:
    """As :func:`mapped`, kept for the next call."""
    if uri not in _OPEN:
        _OPEN[uri] = mapped(uri)
        while len(_OPEN) > KEPT:
            _OPEN.popitem(last=False)
    _OPEN.move_to_end(uri)
    return _OPEN[uri]
