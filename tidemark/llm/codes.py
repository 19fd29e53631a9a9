"""Vector code compression: product codes by exact integer arithmetic.

Components become integers floor(SCALE * x). A vector is cut into equal parts; each part position has a codebook, and
a part's code is the index of the nearest entry. Distances come from matrix products: integers are split into limbs so
narrow that a float64 product of two limbs stays below 2^53 when summed over a part; the products are put together in
int64. So distances are exact whatever the order of summation, and of equal distances the first index is taken.

Entries are the floors of mean parts: every task adds up the parts of its rows by entry, the sums are added by Spark,
and only the codebooks themselves (at most ENTRIES times the vector's length) come to the driver and go to the tasks.

Rows whose vector is null or holds a null or non-finite component are dropped. Of the others the vector of the least
id that can be coded gives the length. A vector of another length, or with components so large that a distance might
leave 64 bits, stays with a null code and error and teaches nothing. With fewer vectors than ENTRIES the codebooks are
shorter; of an empty table nothing comes back. Null ids come after all others, rows of equal id in the order of their
integers; repeated rows each count. Other columns of the table are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.frames import small_batches
from tidemark.operators.joins import spread_join
from tidemark.session import stage

SCALE = 256
PARTS = 16
ENTRIES = 64
ROUNDS = 2
#: Bits that a float64 holds exactly.
EXACT = 53


def _limbs(values: np.ndarray, width: int) -> list[np.ndarray]:
    """``values`` = sum of limb i times 2^(width * i). All limbs are below 2^width in size, all but the last positive."""
    out = []
    while np.abs(values).max(initial=0) >= 1 << width:
        out.append(values & ((1 << width) - 1))
        values = values >> width
    return [*out, values]


def exact_products(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """The dot products of the rows of ``x`` with those of ``y``, both int64, exact where they fit in 64 bits."""
    width = (EXACT - (x.shape[1] - 1).bit_length()) // 2
    right = [limb.T.astype(np.float64) for limb in _limbs(y, width)]
    out = np.zeros((len(x), len(y)), dtype=np.int64)
    for i, left in enumerate(_limbs(x, width)):
        for j, limb in enumerate(right):
            if width * (i + j) < 64:
                out += (left.astype(np.float64) @ limb).astype(np.int64) << (width * (i + j))
    return out


def nearest(x: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each row of ``x`` the first of the nearest rows of ``book`` and the squared distance."""
    away = (x * x).sum(axis=1)[:, None] - 2 * exact_products(x, book) + (book * book).sum(axis=1)
    best = away.argmin(axis=1)
    return best, away[np.arange(len(x)), best]


@dataclass(frozen=True)
class Codebooks:
    """``entries``: integers by part, entry and position within the part."""

    entries: np.ndarray

    def parts(self, vectors: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        n = self.entries.shape[2]
        for part in range(len(self.entries)):
            yield part, vectors[:, part * n : (part + 1) * n]

    def codes(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Index by row and part, and the row's squared distances summed over parts."""
        found = [nearest(x, self.entries[part]) for part, x in self.parts(vectors)]
        return np.stack([i for i, _ in found], axis=1), sum(d for _, d in found)

    @property
    def sha256(self) -> str:
        return hashlib.sha256(",".join(map(str, self.entries.ravel().tolist())).encode()).hexdigest()


def integers(vector: Column) -> Column:
    """floor(SCALE * x) of each component; null for a vector that is null or has a null or non-finite component."""
    x = vector.cast("array<double>")
    finite = F.forall(x, lambda v: F.coalesce(F.abs(v) < F.lit(float("inf")), F.lit(False)))
    return F.when(x.isNotNull() & finite, F.transform(x, lambda v: F.floor(v * SCALE)))


def _within(vector: Column, parts: int) -> Column:
    """Can be cut into equal parts, and distances surely fit in 64 bits: length * (2 * largest)^2 < 2^62."""
    largest = F.floor(F.sqrt(F.lit(2.0**62) / F.size(vector)) / 2)
    small = F.forall(vector, lambda v: (v <= largest) & (v >= -largest))
    return (F.size(vector) > 0) & (F.size(vector) % parts == 0) & small


def _matrix(column: pa.Array, length: int) -> np.ndarray:
    return column.drop_null().flatten().to_numpy(zero_copy_only=False).reshape(-1, length)


def _trained(rows: DataFrame, parts: int, entries: int, rounds: int) -> Codebooks | None:
    """Codebooks of the rows (id, vector), all of one length; None without rows."""
    first = rows.orderBy(F.col("id").asc_nulls_last(), "vector").limit(entries).collect()
    if not first:
        return None
    start = np.array([r["vector"] for r in first], dtype=np.int64)
    length = start.shape[1]
    books = Codebooks(start.reshape(len(first), parts, length // parts).swapaxes(0, 1))
    for _ in range(rounds):
        found = _sums(rows, books).collect()  # a row per part, used entry and position
        new = books.entries.copy()
        for r in found:
            new[r["part"], r["entry"], r["place"]] = int(r["total"]) // r["n"]
        books = Codebooks(new)
    return books


def _sums(rows: DataFrame, books: Codebooks) -> DataFrame:
    """(part, entry, place, total, n): components added up by nearest entry, within each task first."""
    shape = books.entries.shape

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals, counts = np.zeros(shape, dtype=np.int64), np.zeros(shape[:2], dtype=np.int64)
        for batch in batches:
            for part, x in books.parts(_matrix(batch.column("vector"), shape[0] * shape[2])):
                best, _ = nearest(x, books.entries[part])
                np.add.at(totals[part], best, x)
                counts[part] += np.bincount(best, minlength=shape[1])
        part, entry, place = np.nonzero(np.broadcast_to(counts[:, :, None] > 0, shape))
        columns = [part, entry, place, totals[part, entry, place], counts[part, entry]]
        names = ["part", "entry", "place", "total", "n"]
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names)

    own = small_batches(rows.select("vector")).mapInArrow(work, "part long, entry long, place long, total long, n long")
    total = F.sum(F.col("total").cast("decimal(20,0)")).alias("total")
    return own.groupBy("part", "entry", "place").agg(total, F.sum("n").alias("n"))


def compress(
    vectors: DataFrame,
    id: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
    parts: int = PARTS,
    entries: int = ENTRIES,
    rounds: int = ROUNDS,
) -> DataFrame:
    """(id, label, code, error, label_error, codebooks_sha256) per row kept.

    ``code`` has two hex digits a part, which bounds ``entries`` to 256. ``error`` is the squared distance to the coded
    vector, ``label_error`` its sum over the rows of equal label, nulls together; null where it does not fit in 64 bits.
    ``vectors`` is read once per round and twice more, its other columns never.
    """
    if not 1 <= entries <= 256:
        raise ValueError("two hex digits index at most 256 entries")
    rows = vectors.select(F.col(id).alias("id"), F.col(label).alias("label"), integers(F.col(vector)).alias("vector"))
    rows = rows.filter("vector is not null")
    codable = rows.filter(_within(F.col("vector"), parts)).select("id", "vector")
    least = codable.orderBy(F.col("id").asc_nulls_last(), "vector").limit(1).collect()
    length = len(least[0]["vector"]) if least else 0
    books = _trained(codable.filter(F.size("vector") == length), parts, entries, rounds)
    fits = _within(F.col("vector"), parts) & (F.size("vector") == length)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes, errors = [None] * len(batch), [None] * len(batch)
            held = np.flatnonzero(batch.column("vector").is_valid().to_numpy(zero_copy_only=False))
            if len(held):
                index, error = books.codes(_matrix(batch.column("vector"), length))
                for at, own, e in zip(held, index.astype(np.uint8), error.tolist()):
                    codes[at], errors[at] = own.tobytes().hex(), e
            columns = [batch.column("id"), batch.column("label"), pa.array(codes, pa.string()), pa.array(errors, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, ["id", "label", "code", "error"])

    shaped = rows.select("id", "label", F.when(fits, F.col("vector")).alias("vector"))
    missing = F.lit(None)
    schema = shaped.select("id", "label", missing.cast("string").alias("code"), missing.cast("long").alias("error")).schema
    coded = stage(small_batches(shaped).mapInArrow(work, schema))
    total = F.sum(F.col("error").cast("decimal(20,0)")).try_cast("long").alias("label_error")
    totals = stage(coded.groupBy("label").agg(total))
    joined = spread_join(coded, totals, [("label", "label")], "left", null_safe=True)
    digest = F.lit(books.sha256 if books else hashlib.sha256(b"").hexdigest()).alias("codebooks_sha256")
    return joined.select("id", "label", "code", "error", "label_error", digest)
