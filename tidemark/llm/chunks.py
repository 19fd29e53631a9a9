"""Substring dedup with content-defined chunks of a gear rolling hash.

The gear hash of a position depends on the WINDOW bytes up to it. A chunk ends where the hash is the largest within
REACH positions to either side, so ends depend on the text around them alone: an insertion moves them along and
changes only the chunks it touches. Equal chunks have equal digests. A run of neighbouring chunks that all stand in
other documents too is a repeated passage.

An empty table gives an empty result.
"""

from __future__ import annotations

import json

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.window import Window

from tidemark.llm.frames import map_texts, packed, prefiltered, release, small_batches
from tidemark.llm.words import BASE, BASE_INVERSE, U, flat, mix, salt, span_hashes, word_spans
from tidemark.session import stage

WINDOW = 16
REACH = 16
TIE = 64
#: No chunk is longer, whatever the text: what is known of a chunk fits in numbers of 16 bits.
LONGEST = 1 << 15
MIN_WORDS = 50
GEAR = (mix((np.arange(256, dtype=U) + U(1)) * salt(40)) >> U(32)).astype(np.uint32)


def chunk_ends(b: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Positions after the last byte of each chunk of all texts, in order; a text's end always ends a chunk."""
    lengths = np.diff(offsets)
    gap = WINDOW + REACH
    shift = np.repeat(np.arange(len(lengths)) * gap, lengths)
    place = np.arange(len(b)) + shift + gap
    gear = np.zeros(len(b) + gap * (len(lengths) + 1), dtype=np.uint32)
    gear[place] = GEAR[b]
    step = 1
    while step < WINDOW:
        later = gear.copy()
        later[step:] += gear[:-step] << np.uint32(step)
        gear = later
        step *= 2
    inside = np.zeros(len(gear), dtype=bool)
    inside[place] = True
    gear[~inside] = 0
    largest = _largest(gear, REACH)
    after = np.concatenate((largest[1:], [0]))
    before = _largest(gear[::-1], REACH)[::-1]
    before = np.concatenate(([0], before[:-1]))
    largest_here = ((gear >= before) & (gear >= after))[place]
    cuts = np.flatnonzero(largest_here & (gear > before)[place]) + 1
    cuts = np.union1d(cuts, offsets[1:][lengths > 0])
    ties = np.flatnonzero(largest_here & (gear == before)[place]) + 1
    cuts = np.union1d(cuts, _spread(ties, np.union1d(cuts, offsets))) if len(ties) else cuts
    starts = np.concatenate(([0], cuts[:-1]))
    long = np.flatnonzero(cuts - starts > LONGEST)
    more = [np.arange(starts[i] + LONGEST, cuts[i], LONGEST) for i in long]
    return np.union1d(cuts, np.concatenate(more)) if more else cuts


def _spread(ties: np.ndarray, cuts: np.ndarray) -> np.ndarray:
    """Of the positions with the same largest hash as one before, those at least TIE after the last cut.

    Only text that repeats itself has them, a word over and over; there, chunks of any phase are alike again.
    """
    kept, last = [], 0
    before = cuts[np.maximum(np.searchsorted(cuts, ties) - 1, 0)]
    for tie, cut in zip(ties.tolist(), before.tolist()):
        last = max(last, cut)
        if tie - last >= TIE:
            kept.append(tie)
            last = tie
    return np.array(kept, dtype=np.int64)


def _largest(x: np.ndarray, n: int) -> np.ndarray:
    """Largest of x[i : i + n]; n is a power of two."""
    out, step = x.copy(), 1
    while step < n:
        out[:-step] = np.maximum(out[:-step], out[step:])
        step *= 2
    return out


def chunked(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, at, size, n_words, lead, lead_words, tail, tail_words, digest): the chunks of every whole text.

    ``at`` is the first byte in UTF-8, ``n_words`` counts the words that begin in the chunk. ``lead`` and ``tail`` are
    the bytes before and after in which a passage that holds this chunk, but not its neighbour there, must end: the
    neighbour, and what the hash of its ends sees beyond. Rows without an id or text have no chunks.
    """

    def work(batch: pa.RecordBatch):
        b, offsets = flat(batch.column("text"))
        ends = chunk_ends(b, offsets)
        starts = np.concatenate(([0], ends[:-1])).astype(np.int64) if len(ends) else ends
        digests = span_hashes(b, starts, ends)
        doc = np.searchsorted(offsets, starts, side="right") - 1
        first, _ = word_spans(b, offsets)
        words = lambda lo, hi: (np.searchsorted(first, hi) - np.searchsorted(first, lo)).astype(np.int32)
        size = ends - starts
        around = np.concatenate(([0], size, [0])) + WINDOW + REACH
        lead = np.minimum(around[:-2], starts - offsets[doc])
        tail = np.minimum(around[2:], offsets[doc + 1] - ends)
        columns = [batch.column("id").to_numpy()[doc], (starts - offsets[doc]).astype(np.int32), size.astype(np.int32)]
        columns += [words(starts, ends), lead.astype(np.int32), words(starts - lead, starts)]
        columns += [tail.astype(np.int32), words(ends, ends + tail), digests.view(np.int64)]
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names)

    names = ["id", "at", "size", "n_words", "lead", "lead_words", "tail", "tail_words", "digest"]
    kinds = {"id": "long", "digest": "long"}
    rows = docs.select(F.col(id).cast("long").alias("id"), F.col(text).alias("text")).filter("id is not null")
    return map_texts(rows, work, ", ".join(f"{n} {kinds.get(n, 'int')}" for n in names), "text")


#: How the numbers of a chunk share two longs: name and bits, from the lowest.
SHARED = ((("n_words", 16), ("size", 16), ("at", 31)), (("tail_words", 16), ("tail", 16), ("lead_words", 15), ("lead", 16)))


def _together(chunks: DataFrame) -> DataFrame:
    """(digest, id, a, b): a row of a shuffle has eight bytes a column, so small numbers share one."""
    packed_ = []
    for name, fields in zip("ab", SHARED):
        base, own = 0, F.lit(0).cast("long")
        for field, bits in fields:
            own = own.bitwiseOR(F.shiftleft(F.col(field).cast("long"), base))
            base += bits
        packed_.append(own.alias(name))
    return chunks.select("digest", "id", *packed_)


def _apart(rows: DataFrame) -> DataFrame:
    """The columns of :func:`chunked` again, and the others."""
    columns = []
    for name, fields in zip("ab", SHARED):
        base = 0
        for field, bits in fields:
            columns.append(F.shiftrightunsigned(name, base).bitwiseAND(F.lit((1 << bits) - 1)).cast("int").alias(field))
            base += bits
    return rows.select(*[c for c in rows.columns if c not in "ab"], *columns)


def repeated_runs(docs: DataFrame, id: str = "doc_id", text: str = "text", min_words: int = MIN_WORDS) -> DataFrame:
    """Runs of neighbouring chunks that other documents hold, if they may be part of ``min_words`` repeated words.

    (id, at, until, n_words, first_id, lead, tail, digests): ``first_id`` is the smallest id that holds the run. A run too
    short by itself, or one that no document is known to hold as a whole, carries the ``digests`` of its chunks, to be
    looked at word by word. Only digests are shuffled, first to find those of more than one document, then to mark their
    chunks; a digest of very many documents is counted map-side and its chunks are spread by the join. A run whose chunks
    stand first in different documents goes to :func:`split_runs`.
    """
    return _runs(stage(chunked(docs, id, text)), min_words)


def _runs(chunks: DataFrame, min_words: int) -> DataFrame:
    many = chunks.groupBy("digest").agg(F.min("id").alias("lo"), F.max("id").alias("hi")).filter("lo != hi")
    many = stage(many.drop("hi"))
    release(chunks.sparkSession)
    shared = _apart(_together(chunks).join(many, "digest"))
    in_doc = Window.partitionBy("id").orderBy("at")
    again = F.coalesce(F.lag("at").over(in_doc) == F.col("at"), F.lit(False))
    shared = shared.withColumn("again", again).filter("not again").drop("again")
    opens = F.col("at") != F.coalesce(F.lag(F.col("at") + F.col("size")).over(in_doc), F.lit(-1))
    runs = shared.withColumn("run", F.sum(opens.cast("int")).over(in_doc))
    ends = runs.groupBy("id", "run").agg(
        F.min("at").alias("at"),
        F.max(F.col("at") + F.col("size")).alias("until"),
        F.sum("n_words").alias("n_words"),
        F.min("lo").alias("least"),
        F.max("lo").alias("first_id"),
        F.sort_array(F.collect_list(F.struct("at", "size", "n_words", "lo", "digest"))).alias("chunks"),
        *[F.min_by(c, "at").alias(c) for c in ("lead", "lead_words")],
        *[F.max_by(c, "at").alias(c) for c in ("tail", "tail_words")],
    )
    ends = ends.filter(F.col("n_words") + F.col("lead_words") + F.col("tail_words") >= min_words)
    ends = ends.withColumn("digests", F.when(F.col("n_words") < min_words, F.col("chunks.digest")))
    ends = ends.withColumn("chunks", F.when(F.col("least") != F.col("first_id"), F.col("chunks")))
    ends = stage(ends.drop("run", "lead_words", "tail_words", "least"))
    alike = ends.filter("chunks is null").drop("chunks")
    return alike.union(split_runs(ends.filter("chunks is not null"), min_words).select(*alike.columns))


def split_runs(runs: DataFrame, min_words: int) -> DataFrame:
    """``runs`` whose ``chunks`` stand first in different documents, split by the smallest id that holds each passage.

    A window is the fewest neighbouring chunks, from or up to one of them, with ``min_words`` words; a shorter run is one
    window. Documents that share a passage share its windows, so the smallest id of a window is that of the passage,
    also where a chunk of it stands in an earlier document by itself. Windows of one smallest id make one row; rows of
    different ids may overlap. What is in no shared window is a run of its own that no one document is sure to hold; it
    carries its ``digests``, as do windows that are too short.
    Windows of chunks with the same smallest id take that one; only the others are shuffled, as hashes.
    """

    def mixed(batches):
        for batch in batches:
            found = []
            for row in batch.select(["id", "at", "chunks"]).to_pylist():
                run = _Run(row["chunks"], min_words)
                found += [(row["id"], row["at"], *w) for w in zip(*(x[~run.alike].tolist() for x in (run.i, run.j, run.hash)))]
            if found:
                kinds = [pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int64()]
                columns = [pa.array(c, t) for c, t in zip(zip(*found), kinds)]
                yield pa.RecordBatch.from_arrays(columns, ["of", "of_at", "i", "j", "window"])

    windows = small_batches(runs.select("id", "at", "chunks")).mapInArrow(mixed, "of long, of_at int, i int, j int, window long")
    holders = windows.groupBy("window").agg(F.min("of").alias("lo"), F.max("of").alias("hi")).filter("lo != hi")
    held = windows.join(holders, "window").groupBy("of", "of_at")
    held = held.agg(F.collect_list(F.struct("i", "j", "lo")).alias("held"))
    met = runs.join(held, (F.col("id") == F.col("of")) & (F.col("at") == F.col("of_at")), "left").drop("of", "of_at")

    def split(batches):
        for batch in batches:
            rows = [r for row in batch.to_pylist() for r in _Run(row["chunks"], min_words).rows(row)]
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array([r[f.name] for r in rows], f.type) for f in fields], fields.names)

    schema = runs.drop("chunks").schema
    fields = to_arrow_schema(schema)
    return small_batches(met).mapInArrow(split, schema)


class _Run:
    """The windows ``i`` to ``j`` of a run's chunks, in order, with their hashes and whether one id is first in all."""

    def __init__(self, chunks: list[dict], min_words: int):
        self.min_words = min_words
        self.at, self.size, self.n_words, self.lo, self.digest = (
            np.array([c[k] for c in chunks], dtype=np.int64) for k in ("at", "size", "n_words", "lo", "digest")
        )
        self.words = np.concatenate(([0], np.cumsum(self.n_words)))
        n = len(chunks)
        if self.words[-1] < min_words:
            self.i, self.j = np.array([0]), np.array([n])
        else:
            i, j = np.arange(n), np.arange(1, n + 1)
            to = np.searchsorted(self.words, self.words[i] + min_words)
            since = np.searchsorted(self.words, self.words[j] - min_words, side="right") - 1
            pairs = np.concatenate((np.stack((i, to), 1)[to <= n], np.stack((since, j), 1)[since >= 0]))
            self.i, self.j = np.unique(pairs, axis=0).T
        changes = np.concatenate(([0], np.cumsum(self.lo[1:] != self.lo[:-1])))
        self.alike = changes[self.i] == changes[self.j - 1]
        powers = np.full(n + 1, BASE, dtype=U)
        powers[0] = 1
        digests = mix(self.digest.view(U))
        sums = np.concatenate((np.zeros(1, dtype=U), np.cumsum(digests * np.cumprod(powers)[:-1])))
        powers[1:] = BASE_INVERSE
        spans = (sums[self.j] - sums[self.i]) * np.cumprod(powers)[self.i]
        self.hash = mix(spans + (self.j - self.i).astype(U) * salt(98)).view(np.int64)

    def rows(self, run: dict) -> list[dict]:
        """The rows of the run, given in ``held`` its shared windows that are not alike, with their smallest ids."""
        found = {(w["i"], w["j"]): w["lo"] for w in run["held"] or []}
        found.update({(i, j): int(self.lo[i]) for i, j in zip(self.i[self.alike].tolist(), self.j[self.alike].tolist())})
        spans: dict[int, list[list[int]]] = {}
        for (i, j), lo in sorted(found.items()):
            own = spans.setdefault(lo, [])
            if own and i <= own[-1][1]:
                own[-1][1] = max(j, own[-1][1])
            else:
                own.append([i, j])
        out = [self._row(run, i, j, lo, held=True) for lo, own in spans.items() for i, j in own]
        covered = np.zeros(len(self.at) + 2, dtype=bool)
        covered[[0, -1]] = True
        for i, j in found:
            covered[i + 1 : j + 1] = True
        edges = np.flatnonzero(covered[1:] != covered[:-1])
        for i, j in edges.reshape(-1, 2).tolist():
            # What a passage can have beyond the part: the neighbour, and the bytes that the hash of its ends sees.
            n = self.words[min(j + 1, len(self.at))] - self.words[max(i - 1, 0)] + WINDOW + REACH
            if not found or n >= self.min_words:
                out.append(self._row(run, i, j, int(self.lo[i:j].max()), held=False))
        return out

    def _row(self, run: dict, i: int, j: int, first: int, held: bool) -> dict:
        row = dict(run, at=int(self.at[i]), until=int(self.at[j - 1] + self.size[j - 1]), first_id=first)
        row["n_words"] = int(self.words[j] - self.words[i])
        row["digests"] = None if held and row["n_words"] >= self.min_words else self.digest[i:j].tolist()
        if i:
            row["lead"] = int(min(self.size[i - 1] + WINDOW + REACH, self.at[i]))
        if j < len(self.at):
            row["tail"] = int(min(self.size[j] + WINDOW + REACH, run["until"] + run["tail"] - row["until"]))
        return row


def repeated_passages(docs: DataFrame, id: str = "doc_id", text: str = "text", min_words: int = MIN_WORDS) -> DataFrame:
    """(id, start, end, n_words, first_id): passages of at least ``min_words`` words that stand in other documents too.

    Bytes ``start`` to ``end`` of the text in UTF-8, one row per place, also in the document of the smallest id that
    holds the passage, ``first_id``; passages first held by different documents may overlap. Runs long enough by
    themselves are taken as they are, at most a chunk short at either end. Around the others, every ``min_words`` words in
    a row are looked up among all places that hold one of their chunks, however many documents these are in. Exact and
    near copies are passages too. Rows without an id or a text have none. Of rows with the same id the chunks at the same
    place count once.
    """
    chunks = stage(chunked(docs, id, text))
    runs = stage(_runs(chunks, min_words))
    release(docs.sparkSession)
    names = ["id", "start", "end", "n_words", "first_id"]
    sure = runs.filter("digests is null").withColumnsRenamed({"at": "start", "until": "end"}).select(*names)
    open_ = runs.filter("digests is not null")
    return sure.union(_by_words(docs, chunks, open_, id, text, min_words).select(*names))


def _by_words(docs: DataFrame, chunks: DataFrame, runs: DataFrame, id: str, text: str, min_words: int) -> DataFrame:
    """The passages in and next to ``runs`` that another document holds word by word.

    Windows are ``min_words`` words in a row with what is between them. A window in a run is compared, by its hash, with
    those around every chunk that has the digest of one of the run's: a passage holds such a chunk wherever it stands.
    """
    digests = runs.select(F.explode("digests").alias("wanted")).distinct()
    places = prefiltered(chunks.select("digest", "id", "at", "size"), ["digest"], digests, ["wanted"])
    places = places.join(digests, F.col("digest") == F.col("wanted"), "left_semi")
    spots = places.select("id", F.struct("at", (F.col("at") + F.col("size")).alias("until"), F.lit(False).alias("own")).alias("spot"))
    around = F.struct((F.col("at") - F.col("lead")).alias("at"), (F.col("until") + F.col("tail")).alias("until"), F.lit(True).alias("own"))
    spots = spots.union(runs.select("id", around.alias("spot")))
    spots = stage(spots.groupBy("id").agg(F.collect_set("spot").alias("spots")).withColumnRenamed("id", "spot_id"))
    rows = docs.select(F.col(id).cast("long").alias("id"), F.col(text).alias("text")).filter("id is not null and text is not null")
    met = prefiltered(rows, ["id"], spots, ["spot_id"]).join(spots, F.col("id") == F.col("spot_id")).drop("spot_id")

    def work(batch: pa.RecordBatch):
        b, offsets = flat(batch.column("text"))
        firsts, lasts = word_spans(b, offsets)
        bounds = np.searchsorted(firsts, offsets)
        found = []
        for row, (doc, spots) in enumerate(zip(batch.column("id").to_pylist(), batch.column("spots").to_pylist())):
            first, last = (x[bounds[row] : bounds[row + 1]] for x in (firsts, lasts))
            starts, ends = first[: max(len(first) - min_words + 1, 0)], last[min_words - 1 :]
            wanted, own = np.zeros(len(starts) + 1, dtype=np.int32), np.zeros(len(starts) + 1, dtype=np.int32)
            for s in spots:
                at, until = s["at"] + offsets[row], s["until"] + offsets[row]
                if s["own"]:
                    i, j = np.searchsorted(starts, at), np.searchsorted(ends, until, side="right")
                else:
                    i, j = np.searchsorted(ends, until), np.searchsorted(starts, at, side="right")
                if i < j:
                    for marks in (wanted, own) if s["own"] else (wanted,):
                        marks[i] += 1
                        marks[j] -= 1
            at = np.flatnonzero(np.cumsum(wanted[:-1]) > 0)
            found.append((np.full(len(at), doc), at, starts[at], ends[at], np.cumsum(own[:-1])[at] > 0, offsets[row]))
        doc, at, starts, ends, own = (np.concatenate(c) for c in list(zip(*found))[:5])
        base = np.repeat([f[5] for f in found], [len(f[0]) for f in found])
        hashes = span_hashes(b, starts, ends).view(np.int64)
        columns = [doc, at.astype(np.int32), (starts - base).astype(np.int32), (ends - base).astype(np.int32), own, hashes]
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["id", "at", "start", "end", "own", "window"])

    windows = stage(map_texts(met, work, "id long, at int, start int, end int, own boolean, window long", "text"))
    holders = windows.groupBy("window").agg(F.min("id").alias("first_id"), F.max("id").alias("last_id"), F.max("own").alias("asked"))
    holders = holders.filter("asked and first_id != last_id").select(F.col("window").alias("held"), "first_id")
    shared = windows.filter("own").join(holders, F.col("window") == F.col("held"))
    shared = shared.select("id", "first_id", "at", "start", "end").distinct()
    stretch = F.col("at") - F.dense_rank().over(Window.partitionBy("id", "first_id").orderBy("at"))
    shared = shared.withColumn("stretch", stretch).groupBy("id", "first_id", "stretch")
    n_words = F.max("at") - F.min("at") + F.lit(min_words)
    return shared.agg(F.min("start").alias("start"), F.max("end").alias("end"), n_words.cast("long").alias("n_words"))


def drop_repeated(docs: DataFrame, id: str = "doc_id", text: str = "text", min_words: int = MIN_WORDS) -> DataFrame:
    """``docs`` without repeated passages, but for those of the smallest id that holds them: same rows and columns.

    Characters cut by an end of a passage go whole. Rows without an id or a text stay as they are.
    """
    found = repeated_passages(docs, id, text, min_words).filter("id != first_id")
    spans = found.groupBy("id").agg(F.collect_set(F.struct("start", "end")).alias("spans"))
    spans = stage(spans.withColumnRenamed("id", "span_id"))
    rows = packed(docs).withColumn("doc", F.col(f"row.{id}").cast("long")).withColumn("text", F.col(f"row.{text}"))
    cut = rows.join(spans, F.col("doc") == F.col("span_id"), "left")
    cut = cut.select("row", "text", F.to_json("spans").alias("spans"))

    def work(batch: pa.RecordBatch):
        texts = []
        for value, listed in zip(batch.column("text").to_pylist(), batch.column("spans").to_pylist()):
            if value is not None and listed:
                raw, kept, at = value.encode(), [], 0
                for span in sorted(json.loads(listed), key=lambda s: s["start"]):
                    kept.append(raw[at : max(at, span["start"])])
                    at = max(at, span["end"])
                value = b"".join([*kept, raw[at:]]).decode(errors="ignore")
            texts.append(value)
        yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(texts, pa.string())], ["row", "fresh"])

    schema = T.StructType([cut.schema["row"], T.StructField("fresh", T.StringType())])
    fresh = map_texts(cut, work, schema, "text")
    columns = [F.col("fresh").alias(c) if c == text else F.col("row").getField(c).alias(c) for c in docs.columns]
    return fresh.select(*columns)
