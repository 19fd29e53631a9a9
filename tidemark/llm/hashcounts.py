"""Counts by 64-bit hash, kept in files that grow with what is counted and that tasks map into memory.

A file holds the hashes with the same first bits as an Elias-Fano sequence, and their counts beside it. Nothing but the
number of files and their sizes comes to the driver.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.eliasfano import Monotone, load, prefixed, save, sequence
from tidemark.llm.words import U
from tidemark.session import stage

#: Hashes of one file.
FILE = 1 << 21


@dataclass(frozen=True)
class HashCounts:
    """``parts``: the first ``bits`` bits of the hashes of each file."""

    folder: str
    bits: int
    parts: tuple[int, ...]

    @cached_property
    def _open(self) -> dict[int, tuple[Monotone, np.ndarray] | None]:
        return {}

    def _file(self, part: int) -> tuple[Monotone, np.ndarray] | None:
        if part not in self._open:
            arrays = load(f"{self.folder}/part-{part}") if part in self.parts else None
            self._open[part] = (sequence(arrays, "hashes"), arrays["counts"]) if arrays else None
        return self._open[part]

    def __getitem__(self, hashes: np.ndarray) -> np.ndarray:
        """The count of each hash, 0 for one that was not counted."""
        own, at = np.unique(hashes, return_inverse=True)
        out = np.zeros(len(own), dtype=np.int64)
        part = (own >> U(1) >> U(63 - self.bits)).astype(np.int64)
        ends = np.searchsorted(part, np.arange((1 << self.bits) + 1))
        for p in np.flatnonzero(ends[1:] > ends[:-1]):
            file, span = self._file(int(p)), slice(ends[p], ends[p + 1])
            if file:
                place, found = file[0].successor(own[span])
                out[span][found] = file[1][place[found]]
        return out[at]


def write_counts(counted: DataFrame, folder: str, own: str | None = None) -> HashCounts:
    """Write (hash, n), one row per hash, each file by one task. ``own``: a folder for staged rows."""
    counted = stage(counted, own)
    bits = max(-(-counted.count() // FILE) - 1, 0).bit_length()
    part = F.shiftrightunsigned(F.shiftrightunsigned("hash", 1), 63 - bits).alias("part")

    def build(key: tuple, table: pa.Table) -> pa.Table:
        hashes, n = table.column("hash").to_numpy().view(U), table.column("n").to_numpy()
        order = np.argsort(hashes)
        counts = n[order].astype(np.min_scalar_type(int(n.max())))
        save(f"{folder}/part-{key[0].as_py()}", prefixed("hashes", Monotone.of(hashes[order])) | {"counts": counts})
        return pa.table({"part": pa.array([key[0].as_py()], pa.int64())})

    files = counted.select("hash", "n", part).groupBy("part").applyInArrow(build, "part long")
    return HashCounts(folder, bits, tuple(sorted(r["part"] for r in stage(files, own).collect())))  # a row per file
