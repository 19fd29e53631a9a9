"""Source divergence audit: how far the word use of a language's sources lies apart, in exact arithmetic.

Terms are runs of A-Z, a-z and characters beyond ASCII. One CountVectorizer is fitted on the documents' different terms
(a term's documents are added up first, and it is in no more rows than the minimum asks for), which carry their language,
so that every language has its own minimum of documents and its own vocabulary, in one fit however many languages there
are; the vocabulary size is the largest integer, so no term is left out. It makes sparse vectors of the terms of many documents of a (language, source) at once, one for each power of two
in their numbers, and these are summed with that weight; smoothed frequencies are integers. Sources are compared block by block of terms: a block holds the
frequencies of some sources for some terms, and adds its share of every pair's distance. Terms that neither source has
need no row: their share follows from how many there are.

Null text, language and source count as empty. Rows are documents: repeated ones count again, ids are not used. A
language without kept terms has pairs of distance 0 and no terms; an empty table gives no rows. Other columns of the
table are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.feature import CountVectorizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.frames import small_batches
from tidemark.llm.words import flat, lowered, word_spans
from tidemark.session import stage

MIN_DOCS = 30
LARGEST_INT = (1 << 31) - 1
TOP = 50
SMOOTH = 5
UNIT = 1_000_000_000
#: Between term and language; no term holds it.
JOINT = "\x00"
#: Bytes of text whose terms a task adds up together (one longer text is worked on alone).
TOGETHER = 8 << 20
#: Terms, in how many rows they are told, that a task makes the rows of together.
ROW = 1 << 15
#: Sums that a task holds at a time, and bits of the ids in a row of them.
HELD = 1 << 21
RANGE_BITS = 11
#: Terms and, on either side of a pair, sources of one block; blocks are about so large.
BLOCK_TERMS = 1024
BLOCK_SOURCES = 128


def _lists(elements: pa.Array, at: np.ndarray, ends: np.ndarray) -> pa.Array:
    """Lists of the elements at these places, cut at ``ends``."""
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), elements.take(pa.array(at)).cast(pa.string()))


def _terms(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """Of each term of the texts in order: the text's place and the term's place among the different terms, which follow."""
    b, offsets = flat(texts)
    b = lowered(b)
    inside = (b >= 97) & (b <= 122) | (b >= 128)
    starts, ends = word_spans(np.where(inside, b, np.uint8(32)), offsets)
    cuts = np.concatenate(([0], np.cumsum(ends - starts)))
    found = pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(cuts), pa.py_buffer(b[inside])).dictionary_encode()
    text = np.repeat(np.arange(len(texts)), np.diff(np.searchsorted(starts, offsets)))
    return text, found.indices.to_numpy().astype(np.int64), found.dictionary


def _told(rows: pa.Table, min_docs: int) -> pa.RecordBatch:
    """TOLD rows for documents (lang, source, text): the terms of 1, 2, ... and of ``min_docs`` or more of them, then for each
    language and source, and each power of two, those terms in whose number there it is contained."""
    rows = rows.combine_chunks()
    lang, source = (rows.column(c).combine_chunks().dictionary_encode() for c in ("lang", "source"))
    text, term, names = _terms(rows.column("text").combine_chunks())
    width = max(len(names), 1)
    key, n = np.unique(text * width + term, return_counts=True)
    text, term = key // width, key % width
    lang_of, source_of = (c.indices.to_numpy().astype(np.int64) for c in (lang, source))
    marked, own = np.unique(lang_of[text] * width + term, return_inverse=True)
    marks = pa.array([JOINT + x.encode().hex().upper() for x in lang.dictionary.to_pylist()], pa.large_string())
    between = pa.scalar("", pa.large_string())
    names = pc.binary_join_element_wise(names.take(pa.array(marked % width)), marks.take(pa.array(marked // width)), between)
    held_by = np.minimum(np.bincount(own, minlength=len(marked)), min_docs)
    by_number = np.argsort(held_by, kind="stable")
    numbers, first = np.unique(held_by[by_number], return_index=True)
    seen = _lists(names, by_number, np.append(first, len(by_number)))

    wide = max(len(source.dictionary), 1)
    group, at = np.unique((lang_of * wide + source_of)[text], return_inverse=True)
    key, place = np.unique(at * max(len(marked), 1) + own, return_inverse=True)
    total = np.bincount(place, weights=n, minlength=len(key)).astype(np.int64)
    at, own = key // max(len(marked), 1), key % max(len(marked), 1)
    groups, weights, chosen, ends = [], [], [], [0]
    for bit in range(int(total.max(initial=0)).bit_length()):
        held = np.flatnonzero(total >> bit & 1)
        first = np.flatnonzero(np.diff(at[held], prepend=-1))
        groups.append(group[at[held[first]]])
        weights.append(np.full(len(first), 1 << bit))
        chosen.append(own[held])
        ends.extend(ends[-1] + np.concatenate((first[1:], [len(held)])) if len(held) else [])
    groups, chosen = (np.concatenate([np.zeros(0, np.int64), *c]) for c in (groups, chosen))
    sums = _lists(names, chosen, np.array(ends))
    columns = [
        pa.concat_arrays([seen, pa.nulls(len(sums), seen.type)]),
        *[
            pa.concat_arrays([pa.nulls(len(seen), pa.string()), c.dictionary.cast(pa.string()).take(pa.array(i))])
            for c, i in ((lang, groups // wide), (source, groups % wide))
        ],
        pa.array(np.concatenate([numbers, *weights]), pa.int64()),
        pa.concat_arrays([pa.nulls(len(seen), sums.type), sums]),
    ]
    return pa.RecordBatch.from_arrays(columns, ["seen", "lang", "source", "weight", "terms"])


TOLD = "seen array<string>, lang string, source string, weight long, terms array<string>"


def _repeated(counted: pa.Table) -> pa.RecordBatch:
    """Rows whose ``seen`` holds each term n times in all, but no row twice, for (term, n)."""
    counted = counted.combine_chunks()
    n = counted.column("n").to_numpy()
    often = [np.flatnonzero(n > k) for k in range(int(n.max(initial=0)))]
    lists = _lists(counted.column("term").combine_chunks(), np.concatenate(often), np.cumsum([0, *map(len, often)]))
    return pa.RecordBatch.from_arrays([lists], ["seen"])


def marked_terms(docs: DataFrame, min_docs: int) -> DataFrame:
    """TOLD rows for documents (lang, source, text): their terms with JOINT and the language, A-Z lower-cased.

    A term of n documents is in so many rows' ``seen``, or in ``min_docs`` if there are more: so it is in ``min_docs`` rows if
    and only if so many documents hold it. In the other rows ``weight`` of each of the ``terms`` stand in documents of ``lang``
    and ``source`` besides those that other rows tell of. TOGETHER bytes of text are told together; the documents of a term
    are added up over all of them.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            held.append(batch)
            size += batch.column("text").nbytes
            if size >= TOGETHER:
                yield _told(pa.Table.from_batches(held), min_docs)
                held, size = [], 0
        if held:
            yield _told(pa.Table.from_batches(held), min_docs)

    def repeat(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            held.append(batch)
            size += len(batch)
            if size >= ROW:
                yield _repeated(pa.Table.from_batches(held))
                held, size = [], 0
        if size:
            yield _repeated(pa.Table.from_batches(held))

    told = stage(small_batches(docs.select("lang", "source", "text")).mapInArrow(work, TOLD))
    named = told.filter("seen is not null").select(F.explode("seen").alias("term"), "weight")
    number = F.least(F.sum("weight"), F.lit(min_docs)).alias("n")
    seen = named.groupBy("term").agg(number).mapInArrow(repeat, "seen array<string>")
    blank = {f.name: F.lit(None).cast(f.dataType).alias(f.name) for f in told.schema}
    sums = told.filter("terms is not null").select(blank["seen"], "lang", "source", "weight", "terms")
    return seen.select("seen", *[blank[c] for c in ("lang", "source", "weight", "terms")]).union(sums)


def _added(keys: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The different keys, sorted, and the sums of their ``n``."""
    order = np.argsort(keys, kind="stable")
    keys, n = keys[order], n[order]
    first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1]))) if len(keys) else np.zeros(0, np.int64)
    return keys[first], np.add.reduceat(n, first) if len(keys) else n


def _summed(vectors: DataFrame) -> DataFrame:
    """(lang, source, term_id, n) for (lang, source, weight, ids): the weights of the rows with each id.

    Tasks add up first, HELD sums at a time, and send those of a range of ids in one row.
    """

    def packed(places: dict, keys: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
        block = keys >> RANGE_BITS
        first = np.flatnonzero(np.concatenate(([True], block[1:] != block[:-1]))) if len(keys) else np.zeros(0, np.int64)
        names, ends = list(places), pa.array(np.append(first, len(keys)), pa.int32())
        place = [names[i] for i in (keys[first] >> 32).tolist()]
        columns = [pa.array([p[i] for p in place], pa.string()) for i in (0, 1)]
        columns.append(pa.array((keys[first] & 0xFFFFFFFF) >> RANGE_BITS))
        columns.append(pa.ListArray.from_arrays(ends, pa.array((keys & 0xFFFFFFFF).astype(np.int32))))
        columns.append(pa.ListArray.from_arrays(ends, pa.array(n)))
        return pa.RecordBatch.from_arrays(columns, ["lang", "source", "block", "ids", "n"])

    def partly(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        places, keys, n, size = {}, [], [], 0
        for batch in batches:
            ids = batch.column("ids")
            lengths = pc.list_value_length(ids).to_numpy()
            pairs = zip(batch.column("lang").to_pylist(), batch.column("source").to_pylist())
            place = np.array([places.setdefault(p, len(places)) for p in pairs], dtype=np.int64)
            keys.append((np.repeat(place, lengths) << 32) | ids.flatten().to_numpy())
            n.append(np.repeat(batch.column("weight").to_numpy(), lengths))
            size += len(n[-1])
            if size >= HELD:
                own, sums = _added(np.concatenate(keys), np.concatenate(n))
                keys, n, size = [own], [sums], len(own)
                if size >= HELD // 2:
                    yield packed(places, own, sums)
                    places, keys, n, size = {}, [], [], 0
        if size:
            yield packed(places, *_added(np.concatenate(keys), np.concatenate(n)))

    def wholly(key: tuple, table: pa.Table) -> pa.Table:
        ids, n = (table.column(c).combine_chunks().flatten().to_numpy() for c in ("ids", "n"))
        ids, n = _added(ids, n)
        names = [pa.array([key[i].as_py()] * len(ids), pa.string()) for i in (0, 1)]
        return pa.table([*names, pa.array(ids), pa.array(n)], names=["lang", "source", "term_id", "n"])

    sent = small_batches(vectors).mapInArrow(partly, "lang string, source string, block long, ids array<int>, n array<long>")
    return sent.groupBy("lang", "source", "block").applyInArrow(wholly, "lang string, source string, term_id int, n long")


def term_counts(docs: DataFrame, min_docs: int = MIN_DOCS) -> tuple[DataFrame, DataFrame]:
    """For documents (lang, source, text): (lang, source, term_id, n) summed over the vectors, and (term_id, lang, term).

    The vocabulary passes through the driver, as CountVectorizer keeps it there; it holds only terms of at least
    ``min_docs`` documents of their language.
    """
    spark = docs.sparkSession
    rows = marked_terms(docs, min_docs)
    # So many documents of one empty term: it is always kept, as a vocabulary must not be empty.
    marks = spark.range(min_docs).select(F.array(F.lit("")).alias("terms"))
    counter = CountVectorizer(inputCol="terms", outputCol="vector", minDF=float(min_docs), vocabSize=LARGEST_INT)
    # Only whether a term is in so many documents counts here.
    model = counter.fit(rows.filter("seen is not null").select(F.col("seen").alias("terms")).union(marks))
    vectors = model.transform(rows.filter("terms is not null").select("lang", "source", "weight", "terms"))
    # A row's terms are different, so every value is 1.
    vectors = vectors.select("lang", "source", "weight", F.unwrap_udt("vector")["indices"].alias("ids"))
    counts = stage(_summed(vectors))
    vocabulary = model.vocabulary
    names = pa.table({"term_id": pa.array(range(len(vocabulary)), pa.int32()), "name": vocabulary})
    named = F.split("name", JOINT, 2)
    listed = spark.createDataFrame(names).filter("name != ''")
    lang = F.decode(F.unhex(named[1]), "UTF-8").alias("lang")
    return counts, stage(listed.select("term_id", lang, named[0].alias("term")))


def frequency(n: str, total: str, kept: str) -> Column:
    """1 + floor(UNIT * (n + SMOOTH) / (total + SMOOTH * kept)), exact."""
    above = f"cast({n} + {SMOOTH} as decimal(26,0)) * cast({UNIT} as decimal(10,0))"
    return F.expr(f"1 + ({above}) div cast({total} + {SMOOTH} * {kept} as decimal(26,0))")


def _pair_distances(counts: DataFrame, groups: DataFrame) -> DataFrame:
    """(lang, source, item, value): sums over all kept terms of the differences of two sources' frequencies.

    ``counts`` (lang, source, term_id, p), ``groups`` (lang, source, base, kept): frequencies of the terms a source
    has, and of one that it has not.
    """
    sizes = groups.groupBy("lang").agg(F.count("*").alias("sources"))
    groups = groups.join(sizes.withColumnRenamed("lang", "l"), F.col("lang") == F.col("l")).drop("l")
    tiles = F.ceil(F.col("sources") / BLOCK_SOURCES)
    tile = F.pmod(F.xxhash64("source"), tiles)
    blocks = F.ceil(F.col("kept") / BLOCK_TERMS)
    placed = groups.select("lang", "source", "base", "kept", tile.alias("tile"), tiles.alias("tiles"), blocks.alias("blocks"))
    used = placed.filter("kept > 0")
    empty = used.select("*", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"))
    empty = empty.select("lang", "source", "tile", "tiles", "block", F.lit(-1).alias("term_id"), F.col("base").alias("p"))
    place = used.select(F.col("lang").alias("l"), F.col("source").alias("s"), "tile", "tiles", "blocks")
    held = counts.join(place, (F.col("lang") == F.col("l")) & (F.col("source") == F.col("s")))
    block = F.pmod(F.col("term_id").cast("long"), F.col("blocks"))
    held = held.select("lang", "source", "tile", "tiles", block.alias("block"), "term_id", "p")
    rows = empty.union(held).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
    rows = rows.select(
        "lang", "block", F.least("tile", "other").alias("low"), F.greatest("tile", "other").alias("high"), "tile",
        "source", "term_id", "p",
    )

    def compare(key: tuple, table: pa.Table) -> pa.Table:
        lang, low, high = key[0].as_py(), key[2].as_py(), key[3].as_py()
        source = table.column("source").combine_chunks().dictionary_encode()
        names, at = source.dictionary, source.indices.to_numpy()
        term, p = table.column("term_id").to_numpy(), table.column("p").to_numpy()
        tile_of = np.zeros(len(names), dtype=np.int64)
        tile_of[at] = table.column("tile").to_numpy()
        base = np.zeros(len(names), dtype=np.int64)
        base[at[term < 0]] = p[term < 0]
        seen, column = np.unique(term[term >= 0], return_inverse=True)
        matrix = np.repeat(base[:, None], len(seen), axis=1)
        matrix[at[term >= 0], column] = p[term >= 0]
        left, right = np.flatnonzero(tile_of == low), np.flatnonzero(tile_of == high)
        found = []
        for x in left:
            others = right[right != x]
            found.append((np.full(len(others), x), others, np.abs(matrix[others] - matrix[x]).sum(axis=1)))
        x, y, value = (np.concatenate(c) if c else np.zeros(0, np.int64) for c in (zip(*found) if found else ((), (), ())))
        if low != high:
            x, y, value = np.concatenate([x, y]), np.concatenate([y, x]), np.concatenate([value, value])
        columns = [pa.array([lang] * len(x), pa.string()), names.take(pa.array(x)), names.take(pa.array(y))]
        columns += [pa.array(value, pa.int64()), pa.array(np.full(len(x), len(seen)), pa.int64())]
        return pa.table(columns, names=["lang", "source", "item", "share", "seen"])

    shares = rows.groupBy("lang", "block", "low", "high").applyInArrow(
        compare, "lang string, source string, item string, share long, seen long"
    )
    summed = shares.groupBy("lang", "source", "item").agg(F.sum("share").alias("share"), F.sum("seen").alias("seen"))
    side = lambda n: placed.select(
        F.col("lang").alias(f"{n}_lang"), F.col("source").alias(f"{n}_source"), F.col("base").alias(f"{n}_base"), F.col("kept").alias(f"{n}_kept")
    )
    based = summed.join(side("x"), (F.col("lang") == F.col("x_lang")) & (F.col("source") == F.col("x_source")))
    based = based.join(side("y"), (F.col("lang") == F.col("y_lang")) & (F.col("item") == F.col("y_source")))
    unseen = (F.col("x_kept") - F.col("seen")) * F.abs(F.col("x_base") - F.col("y_base"))
    compared = based.select("lang", "source", "item", (F.col("share") + unseen).alias("value"))
    bare = placed.filter("kept = 0").select("lang", "source")
    others = bare.select(F.col("lang").alias("l"), F.col("source").alias("item"))
    alike = bare.join(others, (F.col("lang") == F.col("l")) & (F.col("source") != F.col("item")))
    return compared.union(alike.select("lang", "source", "item", F.lit(0).cast("long").alias("value")))


def audit(
    docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source", min_docs: int = MIN_DOCS, top: int = TOP
) -> DataFrame:
    """(lang, source, part, item, value, rank) for every (lang, source) that occurs.

    Part ``pair``: the other sources of the language and the summed differences of frequencies over all its kept terms,
    the farthest first. Part ``term``: the ``top`` terms that a source has more often than its language, by how much.
    Equal values are ranked by item.
    """
    blank = lambda c: F.coalesce(F.col(c), F.lit("")).alias
    rows = docs.select(blank(lang)("lang"), blank(source)("source"), blank(text)("text"))
    counts, vocabulary = term_counts(rows, min_docs)
    kept = vocabulary.groupBy(F.col("lang").alias("k_lang")).agg(F.count("*").alias("kept"))
    totals = counts.groupBy(F.col("lang").alias("t_lang"), F.col("source").alias("t_source")).agg(F.sum("n").alias("total"))
    groups = rows.select("lang", "source").distinct().join(kept, F.col("lang") == F.col("k_lang"), "left")
    same = (F.col("lang") == F.col("t_lang")) & (F.col("source") == F.col("t_source"))
    groups = groups.join(totals, same, "left").select(
        "lang", "source", F.coalesce("kept", F.lit(0)).cast("long").alias("kept"), F.coalesce("total", F.lit(0)).alias("total")
    )
    base = F.when(F.col("kept") > 0, frequency("0", "total", "kept")).otherwise(F.lit(0).cast("long"))
    groups = stage(groups.withColumn("base", base))
    named = groups.select(F.col("lang").alias("g_lang"), F.col("source").alias("g_source"), "kept", "total")
    same = (F.col("lang") == F.col("g_lang")) & (F.col("source") == F.col("g_source"))
    own = counts.join(named, same).select("lang", "source", "term_id", "n", frequency("n", "total", "kept").alias("p"))
    pairs = _pair_distances(own.drop("n"), groups.select("lang", "source", "base", "kept"))

    whole = groups.groupBy(F.col("lang").alias("w_lang")).agg(F.sum("total").alias("total"), F.max("kept").alias("kept"))
    in_lang = counts.groupBy(F.col("lang").alias("c_lang"), F.col("term_id").alias("c_id")).agg(F.sum("n").alias("n"))
    in_lang = in_lang.join(whole, F.col("c_lang") == F.col("w_lang"))
    in_lang = in_lang.select("c_lang", "c_id", frequency("n", "total", "kept").alias("q"))
    usual = vocabulary.join(in_lang, (F.col("lang") == F.col("c_lang")) & (F.col("term_id") == F.col("c_id")))
    usual = usual.select(F.col("term_id").alias("u_id"), "term", "q")
    over = own.join(usual, F.col("term_id") == F.col("u_id")).filter("p > q")
    over = over.select("lang", "source", F.col("term").alias("item"), (F.col("p") - F.col("q")).alias("value"))

    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")

    def ranked(df: DataFrame, part: str) -> DataFrame:
        found = df.select("lang", "source", F.lit(part).alias("part"), "item", "value", F.row_number().over(order).alias("rank"))
        return found.filter(F.col("rank") <= top) if part == "term" else found

    return ranked(pairs, "pair").union(ranked(over, "term"))
