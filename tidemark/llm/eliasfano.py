"""Elias-Fano sequences over numpy arrays, and files of arrays that tasks map into memory.

A sequence of n numbers below u that never falls takes about 2 + log2(u / n) bits a number: the low bits are packed, the
high bits stand in unary in a bit vector. All questions are answered for many places or numbers at once.
"""

from __future__ import annotations

import json
import mmap
import tempfile
import uuid

import numpy as np
from pyarrow import fs

U = np.uint64
WORD = 64
ALIGN = 64
#: Low parts of up to so many bits are written out for many questions at a time, so many numbers in one go.
WIDEST = 32
TOGETHER = 1 << 15


class Monotone:
    """A sequence that never falls, as the arrays ``shape`` (length, low bits), ``low``, ``high`` and ``ones``.

    ``ones`` counts the set bits before each word of ``high``.
    """

    NAMES = ("shape", "low", "high", "ones")

    def __init__(self, shape: np.ndarray, low: np.ndarray, high: np.ndarray, ones: np.ndarray):
        self.n, self.bits = int(shape[0]), int(shape[1])
        self.shape, self.low, self.high, self.ones = shape, low, high, ones
        self.zeros = np.arange(len(high), dtype=np.int64) * WORD - ones
        self.starts = self.lows = None

    def prepared(self) -> Monotone:
        """With the first place of every high part written out, at four bytes a number, and low parts in whole bytes if
        they are not wide: for many questions at a time."""
        if self.starts is None:
            clear = np.flatnonzero(np.unpackbits(self.high.view(np.uint8), bitorder="little") == 0)
            starts = np.concatenate(([0], clear - np.arange(len(clear))))
            self.starts = starts.astype(np.uint32 if self.n < 1 << 32 else np.int64)
            if self.bits <= WIDEST:
                self.lows = self._all_low(np.min_scalar_type((1 << self.bits) - 1))
        return self

    def _all_low(self, kind: np.dtype) -> np.ndarray:
        out = np.empty(self.n, dtype=kind)
        for at in range(0, self.n, TOGETHER):
            out[at : at + TOGETHER] = self._low(np.arange(at, min(at + TOGETHER, self.n)))
        return out

    def numbers(self) -> np.ndarray:
        """All numbers, as uint64."""
        ones = np.flatnonzero(np.unpackbits(self.high.view(np.uint8), bitorder="little"))
        return ((ones - np.arange(self.n)).astype(U) << U(self.bits)) | self._all_low(U)

    @classmethod
    def of(cls, values: np.ndarray) -> Monotone:
        values = values.astype(U)
        n = len(values)
        bits = max(((int(values[-1]) + 1) // n).bit_length() - 1, 0) if n else 0
        low = np.zeros(n * bits // WORD + 2, dtype=U)
        if bits:
            own = values & U((1 << bits) - 1)
            at = np.arange(n, dtype=U) * U(bits)
            word, shift = (at >> U(6)).astype(np.int64), at & U(63)
            np.add.at(low, word, own << shift)
            # In two steps, as a shift by 64 is undefined; what does not reach the next word adds nothing.
            np.add.at(low, word + 1, own >> U(1) >> (U(63) - shift))
        place = (values >> U(bits)).astype(np.int64) + np.arange(n)
        set_bits = np.zeros((int(place[-1]) + 2 if n else 1) // WORD * WORD + WORD, dtype=np.uint8)
        set_bits[place] = 1
        high = np.packbits(set_bits, bitorder="little").view(U)
        ones = np.concatenate(([0], np.cumsum(np.bitwise_count(high), dtype=np.int64)[:-1]))
        return cls(np.array([n, bits], dtype=np.int64), low, high, ones.astype(np.min_scalar_type(max(n, 1))))

    def arrays(self) -> dict[str, np.ndarray]:
        return {name: getattr(self, name) for name in self.NAMES}

    def _select(self, rank: np.ndarray, before: np.ndarray, flip: bool) -> np.ndarray:
        """Position of the bit with so many set (or clear) bits before it."""
        word = np.searchsorted(before, rank, side="right") - 1
        left = rank - before[word].astype(np.int64)
        rest = ~self.high[word] if flip else self.high[word]
        place = word * WORD
        for half in (32, 16, 8, 4, 2, 1):
            below = np.bitwise_count(rest & U((1 << half) - 1)).astype(np.int64)
            over = left >= below
            left -= np.where(over, below, 0)
            rest = np.where(over, rest >> U(half), rest)
            place += np.where(over, half, 0)
        return place

    def _low(self, at: np.ndarray) -> np.ndarray:
        if not self.bits:
            return np.zeros(len(at), dtype=U)
        bit = at.astype(U) * U(self.bits)
        word, shift = (bit >> U(6)).astype(np.int64), bit & U(63)
        both = (self.low[word] >> shift) | (self.low[word + 1] << U(1) << (U(63) - shift))
        return both & U((1 << self.bits) - 1)

    def __getitem__(self, at: np.ndarray) -> np.ndarray:
        """The numbers at these places, as uint64."""
        if self.starts is None:
            high = self._select(at, self.ones, False) - at
        else:
            high = np.searchsorted(self.starts, at, side="right") - 1
        return (high.astype(U) << U(self.bits)) | self._low(at)

    def successor(self, targets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Place of the first number that is not below each target, and whether it equals the target.

        Each target is searched for once, in ascending order, so that those near each other find the same memory.
        """
        targets = targets.astype(U)
        if (targets[1:] <= targets[:-1]).any():
            own, at = np.unique(targets, return_inverse=True)
            place, equal = self.successor(own)
            return place[at], equal[at]
        low = self._low if self.lows is None else self.lows.__getitem__
        high, own = targets >> U(self.bits), targets & U((1 << self.bits) - 1)
        clear = U(len(self.high) * WORD - self.n - 1)  # the last clear bit
        beyond = high > clear
        high = np.minimum(high, clear).astype(np.int64)
        if self.starts is None:
            lo = np.where(high > 0, self._select(np.maximum(high - 1, 0), self.zeros, True) - high + 1, 0)
            hi = self._select(high, self.zeros, True) - high
        else:
            lo, hi = (self.starts[h].astype(np.int64) for h in (high, high + 1))
        lo, end = np.minimum(lo, self.n), np.minimum(hi, self.n)
        active = np.flatnonzero(lo < end)
        first, last, wanted = lo[active], end[active], own[active]
        while len(active):
            mid = (first + last) >> 1
            less = low(mid) < wanted
            first, last = np.where(less, mid + 1, first), np.where(less, last, mid)
            unsettled = first < last
            if not unsettled.all():
                lo[active[~unsettled]] = first[~unsettled]
                active, first, last, wanted = active[unsettled], first[unsettled], last[unsettled], wanted[unsettled]
        inside = lo < end
        equal = inside & ~beyond
        equal[inside] &= low(lo[inside]) == own[inside]
        return np.where(beyond, self.n, lo), equal


def open_store(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)


def save(path: str, arrays: dict[str, np.ndarray]) -> None:
    """Write the arrays to one file: beside first, then under its name, so that a repeated task does no harm."""
    head, at = {}, 0
    for name, a in arrays.items():
        head[name] = (a.dtype.str, len(a), at)
        at += -(-a.nbytes // ALIGN) * ALIGN
    text = json.dumps(head).encode()
    store, own = open_store(path)
    store.create_dir(own.rsplit("/", 1)[0], recursive=True)
    draft = f"{own}.{uuid.uuid4().hex}"
    with store.open_output_stream(draft) as sink:
        sink.write(len(text).to_bytes(8, "little") + text)
        sink.write(b"\0" * (-(8 + len(text)) % ALIGN))
        for a in arrays.values():
            sink.write(np.ascontiguousarray(a).tobytes())
            sink.write(b"\0" * (-a.nbytes % ALIGN))
    if store.get_file_info(own).type == fs.FileType.File and not isinstance(store, fs.LocalFileSystem):
        store.delete_file(draft)  # an earlier attempt has written the same arrays
    else:
        store.move(draft, own)


def load(path: str) -> dict[str, np.ndarray] | None:
    """The arrays of a file, mapped into memory; None if there is no such file.

    A file of a remote store is copied to the task's own disk first, without a name that could outlive the task.
    """
    store, own = open_store(path)
    if store.get_file_info(own).type != fs.FileType.File:
        return None
    if isinstance(store, fs.LocalFileSystem):
        file = open(own, "rb")
    else:
        file = tempfile.TemporaryFile()
        with store.open_input_stream(own) as source:
            while part := source.read(1 << 22):
                file.write(part)
        file.flush()
    with file:
        whole = mmap.mmap(file.fileno(), 0, access=mmap.ACCESS_READ)
    size = int.from_bytes(whole[:8], "little")
    start = -(-(8 + size) // ALIGN) * ALIGN
    head = json.loads(whole[8 : 8 + size])
    return {name: np.frombuffer(whole, kind, n, start + at) for name, (kind, n, at) in head.items()}



def prefixed(name: str, sequence: Monotone) -> dict[str, np.ndarray]:
    return {f"{name}.{k}": a for k, a in sequence.arrays().items()}


def sequence(arrays: dict[str, np.ndarray], name: str) -> Monotone:
    return Monotone(*[arrays[f"{name}.{k}"] for k in Monotone.NAMES])
