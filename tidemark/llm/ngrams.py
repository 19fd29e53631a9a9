"""Language-model scores from an Elias-Fano trie of n-grams up to three tokens.

Tokens are words and one end a text. The trie is cut into shards by the word before the scored token: a shard holds its
words, what follows each (level 2), which words stand before it (contexts), and what follows each context (level 3). The
third token is written as its rank among what follows the second, a small number. Every level is one Elias-Fano
sequence, made monotone by adding up the ranges before it, with Elias-Fano pointers from the level above and smoothed
probabilities quantised to 8 bits; it is mapped into memory and searched for successors. A word that is too frequent
for one shard is split by the word before it; its level 2 is added up over the parts and repeated in each.

Probabilities are interpolated with absolute discounts for n-grams seen once, twice and more often, estimated by each
shard from its own counts; the last level is the additive base model. Counting and scoring send what belongs to a shard
packed, the tokens of a piece of texts together; a text's score is the sum over the shards. So nothing of the model or
the corpus is whole in one task but the vocabulary, which tasks map into memory from files that grow with it.

Words are told apart by 64-bit hashes. Texts may be empty or null (one end is scored) and of any length; repeated rows
each count and are each scored; a null id is learned from. Without texts to learn from every score is 0. An empty table
gives no rows. Other columns are ignored.
"""

from __future__ import annotations

import struct
import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.eliasfano import Monotone, load, prefixed, save, sequence
from tidemark.llm.frames import map_texts, release, small_batches
from tidemark.llm.words import U, flat, lowered, mix, salt, span_hashes, word_spans
from tidemark.session import shared_dir, stage, staging

ADDED = 0.1
#: Occurrences that a shard of the trie is made for.
SHARD = 1 << 21
#: Words of one vocabulary file.
VOCABULARY = 1 << 22
#: The most frequent words, so many, are looked up by tables in memory rather than in the mapped files.
PREPARED = 1 << 24
#: Words are told apart by how often they occur, in steps of so many powers of two.
TIER = 3
#: Packed pieces that one task joins at a time; more are joined in rounds.
PIECES = 2048
#: Tokens looked up together.
TOGETHER = 1 << 18
#: Quantised probabilities take one byte.
CODES = 256
LEVEL = 3
END = salt(4321)
#: Discounts where a shard has too few counts to estimate them.
DISCOUNTS = (0.7, 0.9, 1.1)

TOKEN, BIGRAM = 0, 1
PACKED = "shard long, piece long, kind int, payload binary"


def learns(id: Column) -> Column:
    """Documents whose crc32(id as text) mod 10 is not 0 teach the model."""
    return F.coalesce(F.crc32(id.cast("string").cast("binary")) % 10 != 0, F.lit(True))


# --- packed arrays --------------------------------------------------------------------------------------------------


def pack(*arrays: np.ndarray) -> bytes:
    """Arrays of one length, byte by byte of the numbers so that equal high bytes stand together, compressed."""
    head, body = [struct.pack("<qq", len(arrays), len(arrays[0]))], []
    for a in arrays:
        if a.dtype.kind != "f":
            a = a.astype(np.min_scalar_type(int(a.max(initial=0))))
        head.append(a.dtype.str.encode().ljust(4))
        body.append(np.ascontiguousarray(a).view(np.uint8).reshape(len(a), a.itemsize).T.tobytes())
    return b"".join(head) + zstandard.compress(b"".join(body), LEVEL)


def unpack(raw: bytes) -> list[np.ndarray]:
    """What was packed; whole numbers as int64."""
    count, n = struct.unpack_from("<qq", raw)
    kinds = [np.dtype(raw[16 + 4 * i : 20 + 4 * i].decode().strip()) for i in range(count)]
    body, at, out = zstandard.decompress(raw[16 + 4 * count :]), 0, []
    for kind in kinds:
        size = n * kind.itemsize
        planes = np.frombuffer(body, np.uint8, size, at).reshape(kind.itemsize, n)
        own = np.ascontiguousarray(planes.T).view(kind).ravel()
        out.append(own if kind.kind == "f" else own.astype(np.int64))
        at += size
    return out


def _ranks(column: np.ndarray) -> np.ndarray:
    """Each number's rank among the different ones."""
    starts = _runs(column)
    _, at = np.unique(column[starts[:-1]], return_inverse=True)
    return np.repeat(at, np.diff(starts))


def sort_key(columns: list[np.ndarray]) -> np.ndarray | None:
    """One number a row that sorts like the columns, first column first; None if they do not fit in 64 bits, even with
    ranks in place of as many of them as needed."""
    columns = list(columns)
    width = lambda c: int(c.max(initial=0)).bit_length()
    widths = [width(c) for c in columns]
    for i in range(len(columns)):
        if sum(widths) > 64:
            columns[i] = _ranks(columns[i])
            widths[i] = width(columns[i])
    if sum(widths) > 64:
        return None
    key = np.zeros(len(columns[0]), dtype=U)
    for c, width in zip(columns, widths):
        key = (key << U(width)) | c.astype(U)
    return key


def sorted_order(columns: list[np.ndarray]) -> np.ndarray:
    key = sort_key(columns)
    return np.lexsort(columns[::-1]) if key is None else np.argsort(key)


def summed(keys: list[np.ndarray], n: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """The distinct rows of ``keys``, sorted by the first column first, and their sums of ``n``."""
    order = sorted_order(keys)
    keys, n = [k[order] for k in keys], n[order]
    if not len(n):
        return keys, n
    first = np.flatnonzero(np.concatenate(([True], np.logical_or.reduce([k[1:] != k[:-1] for k in keys]))))
    return [k[first] for k in keys], np.add.reduceat(n, first)


# --- vocabulary -----------------------------------------------------------------------------------------------------


def tokens(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all texts' tokens in order, and where each text's begin (and the last one's end)."""
    b, offsets = flat(texts)
    b = lowered(b)
    starts, ends = word_spans(b, offsets)
    words = span_hashes(b, starts, ends)
    bounds = np.searchsorted(starts, offsets) + np.arange(len(offsets))
    out = np.empty(len(words) + len(texts), dtype=U)
    is_end = np.zeros(len(out), dtype=bool)
    is_end[bounds[1:] - 1] = True
    out[is_end], out[~is_end] = END, words
    return out, bounds


@dataclass(frozen=True)
class Vocabulary:
    """Words in files by how often they occur (in steps of TIER) and by the first bits of their hash.

    A word's id is its rank in the order of ``files`` (tier, bits, part, words), frequent tiers first, so that frequent
    words have small ids; ``unknown`` and ``start`` follow.
    """

    folder: str
    files: tuple[tuple[int, int, int, int], ...]
    total: int

    @cached_property
    def _bases(self) -> np.ndarray:
        return np.concatenate(([0], np.cumsum([f[3] for f in self.files], dtype=np.int64)))

    @property
    def unknown(self) -> int:
        return int(self._bases[-1])

    @property
    def start(self) -> int:
        return self.unknown + 1

    @cached_property
    def _open(self) -> dict:
        return {}

    def _file(self, at: int) -> tuple[Monotone, np.ndarray]:
        if at not in self._open:
            tier, _, part, _ = self.files[at]
            arrays = load(f"{self.folder}/words-{tier}-{part}")
            self._open[at] = sequence(arrays, "hashes"), arrays["counts"]
        return self._open[at]

    def _hashes(self, at: int) -> Monotone:
        hashes, _ = self._file(at)
        return hashes.prepared() if self._bases[at + 1] <= PREPARED else hashes

    def ids(self, hashes: np.ndarray) -> np.ndarray:
        out = np.full(len(hashes), self.unknown, dtype=np.int64)
        left = np.arange(len(hashes))
        for at in sorted(range(len(self.files)), key=lambda f: -self.files[f][3]):  # large files first: most words are rare
            _, bits, part, _ = self.files[at]
            own = left[_first_bits(hashes[left], bits) == U(part)] if bits else left
            place, found = self._hashes(at).successor(hashes[own])
            out[own[found]] = place[found] + self._bases[at]
            left = left[out[left] == self.unknown]
        return out

    def counts(self, ids: np.ndarray) -> np.ndarray:
        """How often the words with these ids occur; a start as often as an end."""
        out = np.zeros(len(ids), dtype=np.int64)
        file = np.searchsorted(self._bases, ids, side="right") - 1
        for at in np.flatnonzero(np.bincount(file, minlength=len(self.files))[: len(self.files)]):
            own = np.flatnonzero(file == at)
            out[own] = self._file(int(at))[1][ids[own] - self._bases[at]]
        if (ids == self.start).any():
            out[ids == self.start] = self.counts(self.ids(np.array([END])))
        return out

    def base(self, counts: np.ndarray) -> np.ndarray:
        """log10 of the base model's probability of a token that occurs so often."""
        return np.log10((counts + ADDED) / (self.total + ADDED * (self.unknown + 1)))


def _first_bits(hashes: np.ndarray, bits: int) -> np.ndarray:
    return hashes >> U(1) >> U(63 - bits)


def count_words(rows: DataFrame) -> DataFrame:
    """(hash, n) for the column ``text``, added up within each piece of texts and each task first."""

    def work(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        hashes, n = np.unique(tokens(batch.column("text"))[0], return_counts=True)
        yield pa.RecordBatch.from_arrays([pa.array(hashes.view(np.int64)), pa.array(n)], ["hash", "n"])

    counts = map_texts(rows.select("text"), work, "hash long, n long", "text")
    return counts.groupBy("hash").agg(F.sum("n").alias("n"))


def write_vocabulary(rows: DataFrame, folder: str, own: str) -> Vocabulary:
    """Counts the words of the column ``text`` and writes their files, each built by one task. ``own``: for staged rows."""
    tier = F.floor(F.log2("n") / TIER).cast("int")
    counted = stage(count_words(rows).withColumn("tier", tier), own)
    sizes = {r["tier"]: r["count"] for r in counted.groupBy("tier").count().collect()}  # a row for each power of 2 ** TIER
    bits = {t: max(-(-n // VOCABULARY) - 1, 0).bit_length() for t, n in sizes.items()}
    shift = F.lit(63)
    for t, own_bits in bits.items():
        shift = F.when(F.col("tier") == t, 63 - own_bits).otherwise(shift)
    part = F.call_function("shiftrightunsigned", F.shiftrightunsigned("hash", 1), shift.cast("int")).alias("part")

    def build(key: tuple, table: pa.Table) -> pa.Table:
        hashes, n = table.column("hash").to_numpy().view(U), table.column("n").to_numpy()
        order = np.argsort(hashes)
        tier, part = (k.as_py() for k in key)
        counts = n[order].astype(np.min_scalar_type(int(n.max())))
        save(f"{folder}/words-{tier}-{part}", prefixed("hashes", Monotone.of(hashes[order])) | {"counts": counts})
        return pa.table({"tier": pa.array([tier], pa.int32()), "part": [part], "size": [len(n)], "total": [int(n.sum())]})

    parted = counted.select("hash", "n", "tier", part)
    files = parted.groupBy("tier", "part").applyInArrow(build, "tier int, part long, size long, total long")
    found = sorted(stage(files, own).collect(), key=lambda r: (-r["tier"], r["part"]))  # a row for each VOCABULARY words
    return Vocabulary(folder, tuple((r["tier"], bits[r["tier"]], r["part"], r["size"]) for r in found), sum(r["total"] for r in found))


# --- shards ---------------------------------------------------------------------------------------------------------


@dataclass(frozen=True)
class Model:
    vocabulary: Vocabulary
    shards: int
    shard_size: int

    def path(self, shard: int) -> str:
        return f"{self.vocabulary.folder}/shard-{shard}"

    def splits(self, counts: np.ndarray) -> np.ndarray:
        """Into how many parts a word that occurs so often is split by the word before it."""
        return 1 + counts // self.shard_size

    @cached_property
    def split_words(self) -> np.ndarray:
        """The words in several parts, sorted. Only files of words that are frequent enough are read."""
        vocabulary, found = self.vocabulary, [np.zeros(0, dtype=np.int64)]
        for at, (tier, *_) in enumerate(vocabulary.files):
            if 1 << (tier + 1) * TIER >= self.shard_size:
                words = np.flatnonzero(self.splits(vocabulary._file(at)[1].astype(np.int64)) > 1) + vocabulary._bases[at]
                found.append(words)
        start = np.array([vocabulary.start])
        if vocabulary.files and self.splits(vocabulary.counts(start))[0] > 1:
            found.append(start)
        return np.concatenate(found)

    def shard_of(self, word: np.ndarray, part: np.ndarray) -> np.ndarray:
        return (mix(mix(word.astype(U) + salt(41)) + part.astype(U) * salt(42)) % U(self.shards)).astype(np.int64)

    def part_of(self, before: np.ndarray, splits: np.ndarray) -> np.ndarray:
        return (mix(before.astype(U) + salt(43)) % splits.astype(U)).astype(np.int64)


def trigrams(ids: np.ndarray, bounds: np.ndarray, start: int) -> tuple[np.ndarray, np.ndarray]:
    """The tokens two and one places before each; ``start`` before a text's first."""
    two, one = (np.concatenate((np.full(k, start), ids[: max(len(ids) - k, 0)]))[: len(ids)] for k in (2, 1))
    first = bounds[:-1]
    one[first], two[first] = start, start
    second = first[bounds[1:] - first > 1] + 1
    two[second] = start
    return two, one


class Piece:
    """The tokens of some texts: ``words``, the ids that occur, sorted, the unknown and the start last, ``counts`` of
    each, and for every token and the two before it (``w3``, ``w2``, ``w1``) its place among them."""

    def __init__(self, model: Model, texts: pa.Array):
        vocabulary = model.vocabulary
        hashes, self.bounds = tokens(texts)
        own, at = np.unique(hashes, return_inverse=True)
        ids = vocabulary.ids(own)
        every = np.sort(np.concatenate((ids, [vocabulary.unknown, vocabulary.start])))
        self.words = every[_runs(every)[:-1]]
        self.counts = vocabulary.counts(self.words)
        self.w3 = np.searchsorted(self.words, ids)[at]
        self.w1, self.w2 = trigrams(self.w3, self.bounds, len(self.words) - 1)
        self.splits = model.splits(self.counts)
        self.shard_of_word = model.shard_of(self.words, np.zeros(len(self.words), dtype=np.int64))
        self.model = model

    def shards(self, w1: np.ndarray, w2: np.ndarray) -> np.ndarray:
        out = self.shard_of_word[w2]
        split = np.flatnonzero(self.splits[w2] > 1)
        if len(split):
            part = self.model.part_of(self.words[w1[split]], self.splits[w2[split]])
            out[split] = self.model.shard_of(self.words[w2[split]], part)
        return out


def _packed_rows(rows: list[tuple]) -> pa.RecordBatch:
    types = [pa.int64(), pa.int64(), pa.int32(), pa.binary()]
    columns = [pa.array(c, t) for c, t in zip(zip(*rows) if rows else [()] * 4, types)]
    return pa.RecordBatch.from_arrays(columns, ["shard", "piece", "kind", "payload"])


def _runs(column: np.ndarray) -> np.ndarray:
    """Where each run of equal numbers begins, and the length of the column."""
    if not len(column):
        return np.zeros(1, dtype=np.int64)
    changes = np.flatnonzero(column[1:] != column[:-1]) + 1
    return np.concatenate(([0], changes, [len(column)]))


class _Pieces:
    """Numbers the pieces of text: the task's number above a count within it, the same when a task is repeated."""

    def __init__(self):
        self.next = None

    def take(self) -> int:
        if self.next is None:
            self.next = TaskContext.get().partitionId() << 32
        self.next += 1
        return self.next


def _counted(rows: DataFrame, model: Model) -> DataFrame:
    """PACKED rows of kind TOKEN: the n-grams (w2, w1, w3, n) of a piece of the column ``text``, by shard."""

    def work(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        own = Piece(model, batch.column("text"))
        (w2, w1, w3), n = summed([own.w2, own.w1, own.w3], np.ones(len(own.w3), dtype=np.int64))
        shard = own.shards(w1, w2)
        order = np.argsort(shard, kind="stable")
        shard, number = shard[order], pieces.take()
        ends = _runs(shard)
        columns = [*[own.words[w[order]] for w in (w2, w1, w3)], n[order]]
        spans = zip(ends[:-1], ends[1:])
        yield _packed_rows([(int(shard[a]), number, TOKEN, pack(*[c[a:b] for c in columns])) for a, b in spans])

    pieces = _Pieces()
    return map_texts(rows.select("text"), work, PACKED, "text")


def _columns(table: pa.Table, kind: int, width: int) -> list[np.ndarray]:
    """The rows of all payloads of a kind."""
    rows = [unpack(p.as_py()) for p, k in zip(table.column("payload"), table.column("kind").to_pylist()) if k == kind]
    return [np.concatenate([r[i] for r in rows]) if rows else np.zeros(0, dtype=np.int64) for i in range(width)]


def _grams(table: pa.Table) -> tuple[list[np.ndarray], np.ndarray]:
    """(w2, w1, w3) and the sums of their counts."""
    *keys, n = _columns(table, TOKEN, 4)
    return summed(keys, n)


def _follow(table: pa.Table) -> tuple[list[np.ndarray], np.ndarray]:
    """(w2, w3) of split words and their counts: whole ones, repeated if several parts of a word are in the shard."""
    whole = _columns(table, BIGRAM, 3)
    (w2, w3, n), _ = summed(whole, np.ones(len(whole[0]), dtype=np.int64))
    return [w2, w3], n


def _fewer_pieces(packed: DataFrame, folder: str) -> DataFrame:
    """Joins pieces of a shard, PIECES at a time, until one task can take all: equal n-grams meet, so a shard that many
    pieces send the same few n-grams to stays small."""

    def merge(key: tuple, table: pa.Table) -> pa.Table:
        keys, n = _grams(table)
        return pa.Table.from_batches([_packed_rows([(key[0].as_py(), key[1].as_py(), TOKEN, pack(*keys, n))])])

    while True:
        most = packed.groupBy("shard").count().agg(F.max("count")).first()[0] or 0
        if most <= PIECES:
            return packed
        group = F.pmod(F.xxhash64("piece"), F.lit(-(-most // PIECES)))
        merged = packed.withColumn("piece", group).groupBy("shard", "piece").applyInArrow(merge, PACKED)
        packed = stage(merged, folder)


def _split_words(packed: DataFrame, model: Model) -> DataFrame:
    """PACKED rows of kind BIGRAM: for words in several parts what follows them (w2, w3, n), added up, for every part."""

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for payload in batch.column("payload"):
                w2, _, w3, n = unpack(payload.as_py())
                # Payloads are sorted by w2.
                ends = np.searchsorted(w2, model.split_words), np.searchsorted(w2, model.split_words, side="right")
                own = np.concatenate([np.zeros(0, dtype=np.int64), *[np.arange(a, b) for a, b in zip(*ends)]])
                keys, n = summed([w2[own], w3[own]], n[own])
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in (*keys, n)], ["w2", "w3", "n"])

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            w2, w3, n = (batch.column(c).to_numpy() for c in ("w2", "w3", "n"))
            words, at = np.unique(w2, return_inverse=True)
            splits = model.splits(model.vocabulary.counts(words))[at]
            for part in range(int(splits.max(initial=0))):
                own = np.flatnonzero(splits > part)
                shard = model.shard_of(w2[own], np.full(len(own), part))
                order = np.argsort(shard, kind="stable")
                own, shard = own[order], shard[order]
                ends = _runs(shard)
                spans = [(int(shard[a]), own[a:b]) for a, b in zip(ends[:-1], ends[1:])]
                yield _packed_rows([(s, part, BIGRAM, pack(w2[i], w3[i], n[i])) for s, i in spans])

    pairs = small_batches(packed.select("payload")).mapInArrow(pick, "w2 long, w3 long, n long")
    return pairs.groupBy("w2", "w3").agg(F.sum("n").alias("n")).mapInArrow(deal, PACKED)


def _discounts(n: np.ndarray) -> np.ndarray:
    """What to take off counts of 1, 2 and more, from how many n-grams occur once to four times."""
    seen = [int((n == k).sum()) for k in range(1, 5)]
    if not all(seen):
        return np.array(DISCOUNTS)
    y = seen[0] / (seen[0] + 2 * seen[1])
    raw = [k + 1 - (k + 2) * y * seen[k + 1] / seen[k] for k in range(3)]
    return np.clip(raw, 0.05, [0.95, 1.9, 2.85])


def _smoothed(n: np.ndarray, parent: np.ndarray, parents: int, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The discounted share of each count among its parent's, and for each parent what is left over (1 if it has none)."""
    taken = off[np.minimum(n, 3) - 1]
    totals = np.maximum(np.bincount(parent, weights=n, minlength=parents), 1)
    left = np.bincount(parent, weights=taken, minlength=parents) / totals
    return (n - taken) / totals[parent], np.where(np.bincount(parent, minlength=parents) > 0, left, 1.0)


def _quantised(name: str, probability: np.ndarray) -> dict[str, np.ndarray]:
    """-log10 of the probabilities as codes of one byte, in even steps between the ends, and what each code stands for:
    the mean of what has it, so that the sum over all n-grams stays."""
    bits = -np.log10(probability)
    low, high = bits.min(initial=np.inf), bits.max(initial=0)
    step = max((high - low) / (CODES - 1), 1e-9) if len(bits) else 1.0
    codes = np.round((bits - low) / step).astype(np.uint8)
    number = np.maximum(np.bincount(codes, minlength=CODES), 1)
    return {f"{name}.codes": codes, f"{name}.means": np.bincount(codes, weights=bits, minlength=CODES) / number}


def _level(values: np.ndarray, parent: np.ndarray, parents: int) -> dict[str, np.ndarray]:
    """Pointers to each parent's range, and the ranges' ascending values with the ends of the ranges before added."""
    pointers = np.concatenate(([0], np.cumsum(np.bincount(parent, minlength=parents))))
    last = np.zeros(parents, dtype=np.int64)
    full = pointers[1:] > pointers[:-1]
    last[full] = values[pointers[1:][full] - 1] + 1
    before = np.concatenate(([0], np.cumsum(last)[:-1]))
    return prefixed("pointers", Monotone.of(pointers)) | prefixed("values", Monotone.of(values + before[parent]))


class Level:
    def __init__(self, arrays: dict[str, np.ndarray], name: str):
        own = {k.removeprefix(f"{name}."): a for k, a in arrays.items() if k.startswith(f"{name}.")}
        self.pointers = sequence(own, "pointers").numbers().astype(np.int64)
        self.values, self.codes, self.means = sequence(own, "values").prepared(), own["codes"], own["means"]

    def ranges(self, parents: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """First place, end and the number added to the values of each parent's range."""
        first, end = self.pointers[parents], self.pointers[parents + 1]
        added = np.zeros(len(first), dtype=np.int64)
        inner = first > 0
        added[inner] = self.values[first[inner] - 1].astype(np.int64) + 1
        return first, end, added

    def find(self, ranges: tuple[np.ndarray, np.ndarray, np.ndarray], values: np.ndarray) -> np.ndarray:
        """Place of each value in its range, -1 if it is not there."""
        first, end, added = ranges
        place, equal = self.values.successor(values + added)
        return np.where(equal & (place >= first) & (place < end), place, -1)


def shard_arrays(
    grams: list[np.ndarray], n: np.ndarray, follow: list[np.ndarray], m: np.ndarray, vocabulary: Vocabulary
) -> dict[str, np.ndarray]:
    """The trie of n-grams (w2, w1, w3), sorted, with counts ``n``; ``follow`` (w2, w3) and ``m``: level 2 of split words."""
    w2, w1, w3 = grams
    starts = _runs(w2)
    own = np.repeat(~np.isin(w2[starts[:-1]], follow[0]), np.diff(starts))
    pairs, pair_n = summed([np.concatenate((w2[own], follow[0])), np.concatenate((w3[own], follow[1]))], np.concatenate((n[own], m)))
    first = _runs(pairs[0])
    words = pairs[0][first[:-1]]
    parent = np.repeat(np.arange(len(words)), np.diff(first))
    share, left = _smoothed(pair_n, parent, len(words), _discounts(pair_n))
    two = share + left[parent] * 10 ** vocabulary.base(vocabulary.counts(pairs[1]))
    out = {f"two.{k}": a for k, a in _level(pairs[1], parent, len(words)).items()}
    out |= prefixed("words", Monotone.of(words)) | _quantised("two", two) | _quantised("words", left)

    lead = _runs_of_rows(w2, w1)
    above = np.searchsorted(words, w2[lead[:-1]])
    out |= {f"contexts.{k}": a for k, a in _level(w1[lead[:-1]], above, len(words)).items()}
    contexts, repeat = len(lead) - 1, np.diff(lead)
    context, word = np.repeat(np.arange(contexts), repeat), np.repeat(above, repeat)
    width = int(max(pairs[1].max(initial=0), w3.max(initial=0))).bit_length()
    place = np.searchsorted((parent << width) + pairs[1], (word << width) + w3)
    share, left = _smoothed(n, context, contexts, _discounts(n))
    three = share + left[context] * two[place]
    out |= {f"three.{k}": a for k, a in _level(place - first[word], context, contexts).items()}
    return out | _quantised("three", three) | _quantised("contexts", left)


def _runs_of_rows(*columns: np.ndarray) -> np.ndarray:
    """Where each run of equal rows begins, and the length of the columns."""
    if not len(columns[0]):
        return np.zeros(1, dtype=np.int64)
    changes = np.flatnonzero(np.logical_or.reduce([c[1:] != c[:-1] for c in columns])) + 1
    return np.concatenate(([0], changes, [len(columns[0])]))


class Shard:
    """A shard's trie, mapped into memory. A shard without n-grams knows no word."""

    def __init__(self, path: str, vocabulary: Vocabulary):
        self.vocabulary, arrays = vocabulary, load(path)
        self.words = sequence(arrays, "words").prepared() if arrays else None
        if arrays:
            self.left = arrays["words.means"][arrays["words.codes"]]
            self.two, self.contexts, self.three = (Level(arrays, n) for n in ("two", "contexts", "three"))

    def scores(self, w2: np.ndarray, w1: np.ndarray, w3: np.ndarray) -> np.ndarray:
        """log10 of each w3's probability after (w1, w2). Each different n-gram is looked up once, in ascending order."""
        order = sorted_order([w2, w1, w3])
        w2, w1, w3 = w2[order], w1[order], w3[order]
        first = _runs_of_rows(w2, w1, w3)
        out = np.empty(len(order))
        out[order] = np.repeat(self._scores(*(c[first[:-1]] for c in (w2, w1, w3))), np.diff(first))
        return out

    def _scores(self, w2: np.ndarray, w1: np.ndarray, w3: np.ndarray) -> np.ndarray:
        """The same for n-grams whose equal (w2, w1) stand together."""
        base = self.vocabulary.base(self.vocabulary.counts(w3))
        if self.words is None:
            return base
        lead = _runs_of_rows(w2, w1)
        repeat, lead = np.diff(lead), lead[:-1]
        word, known = self.words.successor(w2[lead])
        kept = np.repeat(known, repeat)
        lead, repeat, word, w3 = lead[known], repeat[known], word[known], w3[kept]
        each = lambda a: np.repeat(a, repeat)
        follow = self.two.ranges(word)
        context = self.contexts.find(self.contexts.ranges(word), w1[lead])
        place = self.two.find(tuple(each(a) for a in follow), w3)
        held = place >= 0
        loss = np.empty(len(w3))
        loss[held] = self.two.means[self.two.codes[place[held]]]
        loss[~held] = self.left[each(word)[~held]] - base[kept][~held]
        has = each(context >= 0)
        deep = np.full(len(w3), -1)
        ranges = self.three.ranges(np.maximum(context, 0))
        both = has & held
        deep[both] = self.three.find(tuple(each(a)[both] for a in ranges), (place - each(follow[0]))[both])
        found = deep >= 0
        loss[found] = self.three.means[self.three.codes[deep[found]]]
        back = has & ~found
        loss[back] += self.contexts.means[self.contexts.codes[each(context)[back]]]
        out = base.copy()
        out[kept] = -loss
        return out


def train(docs: DataFrame, text: str = "text", folder: str | None = None, shard: int = SHARD) -> Model:
    """The trie of the texts, in files under ``folder`` (by default one of its own in the shared folder), kept there."""
    spark = docs.sparkSession
    folder = folder or f"{shared_dir(spark)}/ngrams-{uuid.uuid4().hex}"
    rows = docs.select(F.col(text).alias("text"))
    with staging(spark) as own:
        vocabulary = write_vocabulary(rows, folder, own)
    model = Model(vocabulary, max(1, -(-vocabulary.total // shard)), shard)
    release(spark)

    def build(key: tuple, table: pa.Table) -> pa.Table:
        grams, n = _grams(table)
        follow, m = _follow(table)
        save(model.path(key[0].as_py()), shard_arrays(grams, n, follow, m, vocabulary))
        return pa.table({"shard": pa.array([key[0].as_py()], pa.int64()), "grams": pa.array([len(n)], pa.int64())})

    with staging(spark) as own:
        packed = _fewer_pieces(stage(_counted(rows, model), own), own)
        every = packed.union(_split_words(packed, model))
        stage(every.groupBy("shard").applyInArrow(build, "shard long, grams long"), own)
    del packed, every
    release(spark)
    return model


# --- scores ---------------------------------------------------------------------------------------------------------

DOCUMENT = 2
SCORED = "id long, n_tokens long, n_known long, base_score double, score double"


def score(docs: DataFrame, model: Model, id: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, n_tokens, n_known, base_score, score) per row: known tokens, and log10 probabilities by base model and trie.

    A piece's rows are found again by the piece's number, so ``docs`` must give the same rows when a task is repeated,
    as a table read from files does.
    """
    rows = docs.select(F.col(id).cast("long").alias("id"), F.col(text).alias("text"))
    vocabulary = model.vocabulary

    def ask(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        own = Piece(model, batch.column("text"))
        base, known = vocabulary.base(own.counts)[own.w3], (own.counts > 0)[own.w3]
        lengths = np.diff(own.bounds)
        doc = np.repeat(np.arange(len(batch)), lengths)
        # After an unknown word only the base model is left.
        plain = own.w2 == len(own.words) - 2
        summed_up = lambda doc, w: np.bincount(doc, weights=w, minlength=len(batch)).astype(float)
        columns = [lengths, summed_up(doc, known).astype(np.int64), summed_up(doc, base), summed_up(doc[plain], base[plain])]
        names = ["id", "n_tokens", "n_known", "base_score", "score"]
        table = pa.RecordBatch.from_arrays([batch.column("id"), *[pa.array(c) for c in columns]], names)
        sink, number = pa.BufferOutputStream(), pieces.take()
        with pa.ipc.new_stream(sink, table.schema) as writer:
            writer.write_batch(table)
        out = [(number % model.shards, number, DOCUMENT, sink.getvalue().to_pybytes())]
        asked = np.flatnonzero(~plain)
        w2, w1, w3, doc = (c[asked] for c in (own.w2, own.w1, own.w3, doc))
        shard = own.shards(w1, w2)
        order = sorted_order([shard, w2, w1])
        shard = shard[order]
        ends = _runs(shard)
        columns = [*[own.words[w[order]] for w in (w2, w1, w3)], doc[order]]
        for a, b in zip(ends[:-1], ends[1:]):
            out.append((int(shard[a]), number, TOKEN, pack(*[c[a:b] for c in columns])))
        yield _packed_rows(out)

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, trie, held, size = None, None, [], 0

        def scored() -> pa.RecordBatch:
            """The sums by text of the pieces held, which are of one shard and looked up together."""
            w2, w1, w3, _ = (np.concatenate(c) for c in zip(*[columns for _, columns in held]))
            scores, out = trie.scores(w2, w1, w3), []
            for (number, (*_, doc)), first in zip(held, np.cumsum([0, *[len(c[0]) for _, c in held]])):
                seen = np.flatnonzero(np.bincount(doc))
                sums = np.bincount(doc, weights=scores[first : first + len(doc)])
                out.append((0, number, TOKEN, pack(seen, sums[seen])))
            held.clear()
            return _packed_rows(out)

        for batch in batches:
            for shard, piece, kind, payload in zip(*(batch.column(c) for c in ("shard", "piece", "kind", "payload"))):
                if kind.as_py() == DOCUMENT:
                    yield _packed_rows([(0, piece.as_py(), DOCUMENT, payload.as_py())])
                    continue
                if at != shard.as_py():
                    if held:
                        yield scored()
                    at, size = shard.as_py(), 0
                    trie = Shard(model.path(at), vocabulary)
                held.append((piece.as_py(), unpack(payload.as_py())))
                size += len(held[-1][1][0])
                if size >= TOGETHER:
                    yield scored()
                    size = 0
        if held:
            yield scored()

    def add(key: tuple, table: pa.Table) -> pa.Table:
        kinds, payloads = table.column("kind").to_pylist(), table.column("payload")
        rows = pa.ipc.open_stream(payloads[kinds.index(DOCUMENT)].as_buffer()).read_all()
        total = rows.column("score").to_numpy().copy()
        for kind, payload in zip(kinds, payloads):
            if kind == TOKEN:
                doc, sums = unpack(payload.as_py())
                total[doc] += sums
        return rows.set_column(4, "score", pa.array(total))

    pieces = _Pieces()
    asked = map_texts(rows, ask, PACKED, "text").hint("rebalance", "shard").sortWithinPartitions("shard")
    return small_batches(asked).mapInArrow(answer, PACKED).groupBy("piece").applyInArrow(add, SCORED)


def score_documents(docs: DataFrame, id: str = "doc_id", text: str = "text", shard: int = SHARD) -> DataFrame:
    """(id, held_out, n_tokens, n_known, train_tokens, base_score, score) per row, learned from the rows that
    :func:`learns` names."""
    model = train(docs.filter(learns(F.col(id))), text, shard=shard)
    found = score(docs, model, id, text)
    total = F.lit(model.vocabulary.total).cast("long").alias("train_tokens")
    return found.select("id", (~learns(F.col("id"))).alias("held_out"), "n_tokens", "n_known", total, "base_score", "score")
