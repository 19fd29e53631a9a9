"""Benchmark decontamination by the q-gram lemma.

A benchmark text of length L that stands in a document with at most e edits shares at least L - q + 1 - e * q of its
q-grams with it, all within e + 1 neighbouring diagonals (position in the document minus position in the item). Shared
q-grams are counted in bands of diagonals that overlap by e, so that one band holds any such occurrence whole: a band
is wider than the item's e, lest the overlap reach into more than one other. Bands that reach the bound are aligned,
within the band, and kept if they need no more than e edits.

Texts are compared lower-cased, runs of white space as one space. The benchmark goes to every task in blocks of at
most BLOCK_BYTES of text; a larger benchmark takes several passes over the documents.

An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.frames import map_texts, packed
from tidemark.llm.words import BASE, U, mix
Q = 12
#: Edits allowed, as a share of the item's length; fewer for items so short that the bound would be empty.
EDITS = 0.05
BLOCK_BYTES = 4 << 20
#: Fewest diagonals of a band besides the overlap.
BAND = 32
FILTER_BITS = 24


def normal(text: str) -> bytes:
    return " ".join(text.lower().split()).encode()


def qgrams(b: np.ndarray, q: int) -> np.ndarray:
    """A hash of the q bytes from each position."""
    if len(b) < q:
        return np.zeros(0, dtype=U)
    h, width, out, done = b.astype(U) + U(1), 1, None, 0
    power = BASE
    while width <= q:
        if q & width:
            if out is None:
                out, done = h, width
            else:
                out = out[: len(h) - done] * power + h[done:]
                done += width
        if width * 2 <= q:
            h = h[:-width] * power + h[width:]
        power = U(int(power) ** 2 % (1 << 64))
        width *= 2
    return mix(out[: len(b) - q + 1])


class Index:
    """The q-grams of a block of benchmark texts: where each stands, and a bit table that rules most others out."""

    def __init__(self, items: list[tuple[int, bytes]], q: int = Q, edits: float = EDITS):
        self.items, self.q = items, q
        lengths = np.array([len(t) for _, t in items], dtype=np.int64)
        self.e = np.minimum((lengths * edits).astype(np.int64), np.maximum(lengths // q - 1, 0))
        self.band = np.maximum(BAND, self.e + 1)
        self.bound = np.maximum(lengths - q + 1 - self.e * q, 1)
        grams = [qgrams(np.frombuffer(t, np.uint8), q) for _, t in items]
        every = np.concatenate(grams) if grams else np.zeros(0, dtype=U)
        item = np.repeat(np.arange(len(grams)), [len(g) for g in grams])
        place = np.concatenate([np.arange(len(g)) for g in grams]) if grams else np.zeros(0, dtype=np.int64)
        order = np.argsort(every, kind="stable")
        self.item, self.place = item[order], place[order]
        self.keys, self.first = np.unique(every[order], return_index=True)
        self.last = np.append(self.first[1:], len(every))
        self.table = np.zeros(1 << FILTER_BITS, dtype=bool)
        self.table[(self.keys >> U(64 - FILTER_BITS)).astype(np.int64)] = True

    def hits(self, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(item, diagonal) of each q-gram shared with the text."""
        grams = qgrams(b, self.q)
        at = np.flatnonzero(self.table[(grams >> U(64 - FILTER_BITS)).astype(np.int64)])
        key = np.searchsorted(self.keys, grams[at])
        key[key == len(self.keys)] = 0
        same = self.keys[key] == grams[at] if len(at) else np.zeros(0, dtype=bool)
        at, key = at[same], key[same]
        n = self.last[key] - self.first[key]
        which = np.repeat(self.first[key], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        return self.item[which], np.repeat(at, n) - self.place[which]

    def find(self, text: bytes) -> Iterator[tuple[int, int, int, int]]:
        """(item, start, end, edits) of the items that stand in the text, the best place of each."""
        found: dict[int, tuple[int, int, int]] = {}
        for k, (_, item) in enumerate(self.items):
            if 0 < len(item) < self.q and (at := text.find(item)) >= 0:
                found[k] = (0, at, at + len(item))
        item, diagonal = self.hits(np.frombuffer(text, np.uint8))
        if len(item):
            shift = int(diagonal.min())
            width = self.band[item]
            band = (diagonal - shift) // width
            back = (diagonal - shift - band * width < self.e[item]) & (band > 0)
            both = np.concatenate((band, band[back] - 1)), np.concatenate((item, item[back]))
            code, count = np.unique(both[1] * (int(band.max()) + 1) + both[0], return_counts=True)
            for c in code[count >= self.bound[code // (int(band.max()) + 1)]].tolist():
                k, b = divmod(c, int(band.max()) + 1)
                if k in found and found[k][0] == 0:
                    continue
                e, length, width = int(self.e[k]), len(self.items[k][1]), int(self.band[k])
                lo = b * width + shift - e
                # Bytes that no text has: at the text's begin an item's first bytes may be lacking.
                pad = min(max(-lo, 0), e)
                lo = max(lo, 0)
                hi = min(b * width + shift + width + length + 2 * e, len(text))
                edits, start, end = align(self.items[k][1], b"\xff" * pad + text[lo:hi], width + 2 * e)
                start, end = max(start - pad, 0), max(end - pad, 0)
                if edits <= e and (k not in found or edits < found[k][0]):
                    found[k] = (edits, lo + start, lo + end)
        for k, (edits, start, end) in found.items():
            yield self.items[k][0], start, end, edits


def align(item: bytes, region: bytes, width: int) -> tuple[int, int, int]:
    """(edits, start, end) of the place in ``region`` that needs the fewest edits to be ``item``.

    Rows of the table are computed in the band of ``width`` + edits diagonals that a start within the first ``width``
    bytes can use.
    """
    at = region.find(item)
    if at >= 0:
        return 0, at, at + len(item)
    a, b = np.frombuffer(item, np.uint8), np.frombuffer(region, np.uint8)
    span = min(2 * width, len(b)) + 1
    far = len(a) + len(b)
    cost = np.zeros(span, dtype=np.int64)
    start = np.arange(span)
    steps = np.arange(span)
    # cost[d] in row i is the place d + i of the region: a match or change stays on d, a dropped byte moves to d - 1.
    for i, byte in enumerate(a.tolist()):
        place = np.arange(span) + i
        inside = place < len(b)
        same = np.zeros(span, dtype=bool)
        same[inside] = b[place[inside]] == byte
        change = np.where(inside, cost + ~same, far)
        skip = np.append(cost[1:], far) + 1
        from_skip = skip < change
        cost = np.where(from_skip, skip, change)
        start = np.where(from_skip, np.append(start[1:], 0), start)
        order = (cost - steps) * (span + 1) + steps
        best = np.minimum.accumulate(order)
        source = best % (span + 1)
        cost = np.where(place + 1 <= len(b), cost[source] + steps - source, far)
        start = start[source]
    k = int(cost.argmin())
    return int(cost[k]), int(start[k]), min(k + len(a), len(b))


def blocks(benchmark: DataFrame, id: str, text: str) -> Iterator[list[tuple[int, bytes]]]:
    """The benchmark's texts in blocks of at most BLOCK_BYTES, or of one longer text."""
    rows = benchmark.select(F.col(id).cast("long").alias("id"), F.col(text).alias("text")).filter("text is not null")
    block, size = [], 0
    for row in rows.distinct().orderBy("id", "text").toLocalIterator():
        item = normal(row["text"])
        if block and size + len(item) > BLOCK_BYTES:
            yield block
            block, size = [], 0
        block.append((row["id"], item))
        size += len(item)
    if block:
        yield block


class Finder:
    """Finds a block's items in texts; builds its index in the task that uses it."""

    def __init__(self, block: list[tuple[int, bytes]], q: int, edits: float):
        self.block, self.q, self.edits, self.index = block, q, edits, None

    def __call__(self, text: str | None) -> list[tuple[int, int, int, int]]:
        self.index = self.index or Index(self.block, self.q, self.edits)
        return list(self.index.find(normal(text or "")))


def leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    id: str = "doc_id",
    text: str = "text",
    item: str = "item_id",
    item_text: str = "text",
    q: int = Q,
    edits: float = EDITS,
) -> DataFrame:
    """(id, item_id, start, end, edits): a row for every row of ``docs`` and benchmark text that stands in it.

    ``start`` and ``end`` are bytes of the normalised text, of the place with the fewest edits. Items shorter than q
    bytes are looked for exactly; empty and null items and texts match nothing. Whole texts are read, once per block
    of the benchmark, and nothing is shuffled.
    """
    rows = docs.select(F.col(id).cast("long").alias("id"), F.col(text).alias("text"))
    names = ["id", "item_id", "start", "end", "edits"]
    found = rows.limit(0).selectExpr("id", *[f"0L AS `{n}`" for n in names[1:]])
    for block in blocks(benchmark, item, item_text):
        finder = Finder(block, q, edits)

        def work(batch: pa.RecordBatch, finder: Finder = finder):
            found = [(i, *hit) for i, t in enumerate(batch.column("text").to_pylist()) for hit in finder(t)]
            if found:
                at, *columns = zip(*found)
                columns = [batch.column("id").take(pa.array(at)), *[pa.array(c, pa.int64()) for c in columns]]
                yield pa.RecordBatch.from_arrays(columns, names)

        found = found.union(map_texts(rows, work, ", ".join(f"`{n}` long" for n in names), "text"))
    return found


def drop_leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    text: str = "text",
    item: str = "item_id",
    item_text: str = "text",
    q: int = Q,
    edits: float = EDITS,
) -> DataFrame:
    """``docs`` without the rows that hold a benchmark text; each block of the benchmark filters what is left."""
    rows = packed(docs).withColumn("text", F.col(f"row.{text}"))
    for block in blocks(benchmark, item, item_text):
        finder = Finder(block, q, edits)

        def work(batch: pa.RecordBatch, finder: Finder = finder):
            clean = [not finder(t) for t in batch.column("text").to_pylist()]
            yield batch.filter(pa.array(clean, pa.bool_()))

        rows = map_texts(rows, work, rows.schema, "text")
    return rows.select("row.*")
