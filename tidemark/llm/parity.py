"""N-gram Jaccard join with parity sketches, and the groups of near-duplicate documents it links.

A document is the set of its word shingles. With similarity at least t, two sets differ in at most
D = min(sizes) * (1 - t) / t elements. Sets of a band of sizes are split by hash into more parts than D; the XOR of a
part's shingle hashes is its parity sketch, and equal tokens cancel, so at most D parts differ: two linked sets have at
least one part with the same XOR. That part is the join key. The parity bits of a whole set (a 1024-bit sketch, each
shingle flipping one bit) differ in at most as many bits as the sets differ in shingles, which rules out most other
pairs of a key while they are joined: also those of copies edited a little more than a link allows, of which a large
group has as many as the square of its size.

A link shares all but as many keys as a set of its size may differ in, so of each set's keys, rarest first, only as many
are kept as guarantee that two linked sets still meet (a prefix filter). Keys that very many unlike sets share, such as parts that
hold nothing but a common passage, are the last in that order: a set that shares little else keeps none of them.

Equal sets are one node from the start. In each key only the best-connected set is compared with the others; keys
whose sets are all connected by then need nothing more. Of the rest, only sets not yet connected are compared; the sets
of a large key are dealt to blocks, and pairs of blocks to tasks.

An empty table gives an empty result.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.frames import map_texts, packed, prefiltered, release, surely_not
from tidemark.llm.graph import components
from tidemark.llm.words import U, mix, salt, shingle_sets
from tidemark.session import stage

WORDS = 5
PERCENT = 80
#: A band reaches from a size to this many times the size.
BAND = 1.5
#: Longs of the sketch. With few, sets of some hundred shingles differ in most bits whether or not they are alike.
SKETCH = 16
BAND_BITS = 8
#: Bands up to this one are pruned by how many keys a pair shares; sets beyond have millions of shingles.
LAST_BAND = 32
#: Keys are shuffled in so many rounds, each a share of them by hash, so that less disk is in use at a time.
ROUNDS = 3
#: Sets of a key that one task compares with as many others.
BLOCK = 1000
#: Copies that one task has seen already send no keys again; it remembers this many sets.
SEEN = 1 << 18


def max_difference(size: int, percent: int) -> int:
    """Most elements in which a set of this size and another, not smaller one can differ and still be linked."""
    return size * (100 - percent) // percent


class Bands:
    """Bands of set sizes, and for each how many parts its sets are split into.

    Of ``parts`` parts at most D differ, so more than ``empties`` of them agree. If a set has no more empty parts than
    that, a part with tokens is among those that agree. The few sets with more empty parts also use those as keys.
    """

    def __init__(self, percent: int):
        self.percent = percent
        first = next(n for n in range(1, 102) if max_difference(n, percent) >= 1) if percent < 100 else 1 << 62
        self.lows, self.parts, self.empties = [first], [], []

    def low(self, band: int) -> int:
        while band + 1 >= len(self.lows):
            low = self.lows[-1]
            high = max(int(low * BAND), low + 1)
            most = max_difference(high - 1, self.percent)
            empties = 1
            while empties < most:
                parts = most + 1 + empties
                expected = parts * (1 - 1 / parts) ** low
                if empties >= expected + 2 * expected**0.5:
                    break
                empties += 1
            self.lows.append(high)
            self.parts.append(most + 1 + empties)
            self.empties.append(empties)
        return self.lows[band]

    def of(self, size: int) -> list[int]:
        """The set's band, and the one below if a set there is large enough to be linked with it."""
        if size < self.lows[0]:
            return []
        band = 0
        while self.low(band + 1) <= size:
            band += 1
        least_partner = -(-size * self.percent // 100)
        return [band] + [k for k in range(band - 1, -1, -1) if self.lows[k + 1] > least_partner]


def part_keys(tokens: np.ndarray, bands: Bands) -> list[tuple[int, int, np.ndarray]]:
    """For each band of a set of token hashes: the band, the number of empty parts, and the join keys, one per part.

    A key's lowest byte is its band.
    """
    out = []
    for band in bands.of(len(tokens)):
        bands.low(band)
        parts, empties = bands.parts[band], bands.empties[band]
        place = (mix(tokens ^ salt(1000 + band)) % U(parts)).astype(np.int64)
        sketch = np.zeros(parts, dtype=U)
        np.bitwise_xor.at(sketch, place, tokens)
        empty = np.bincount(place, minlength=parts) == 0
        keys = mix(sketch ^ mix((np.arange(parts, dtype=U) << U(16)) + U(band) + U(1)))
        keys = (keys << U(BAND_BITS)) | U(band)
        out.append((band, int(empty.sum()), keys if empty.sum() > empties else keys[~empty]))
    return out


def parity_sketch(tokens: np.ndarray) -> np.ndarray:
    """SKETCH longs; each token flips one bit."""
    bit = mix(tokens ^ salt(7)) % U(64 * SKETCH)
    sketch = np.zeros(SKETCH, dtype=U)
    np.bitwise_xor.at(sketch, (bit >> U(6)).astype(np.int64), U(1) << (bit & U(63)))
    return sketch


def set_hash(tokens: np.ndarray) -> np.uint64:
    return mix(mix(tokens ^ salt(3)).sum(keepdims=True) + np.array([len(tokens)], dtype=U) * salt(4))[0]


def shingled(docs: DataFrame, id: str, text: str, words: int, percent: int) -> DataFrame:
    """(id, th, n, sid, s0.., empty, keys): per row its id, text hash, number of shingles, set hash, sketch and join keys.

    ``empty`` has the number of empty parts for each band, above the band in the lowest byte.
    ``sid`` is null for a text without words. ``keys`` are empty where the task has sent those of an equal set.
    """
    narrow = docs.select(F.col(id).cast("long").alias("id"), F.xxhash64(text).alias("th"), F.col(text).alias("text"))

    def work(batch: pa.RecordBatch):
        rows = []
        for tokens in shingle_sets(batch.column("text"), words):
            sid = int(set_hash(tokens).astype(np.int64)) if len(tokens) else None
            found = part_keys(tokens, bands)
            empty = [(n << BAND_BITS) + band for band, n, _ in found]
            keys = np.concatenate([np.zeros(0, dtype=U), *[k for _, _, k in found]]).view(np.int64)
            if sid in seen:
                keys = keys[:0]
            elif sid is not None:
                if len(seen) >= SEEN:
                    seen.clear()
                seen.add(sid)
            rows.append((len(tokens), sid, parity_sketch(tokens).view(np.int64), empty, keys))
        n, sid, sketch, empty, keys = zip(*rows)
        sketches = np.stack(sketch)
        ends = np.cumsum([0, *map(len, keys)]).astype(np.int32)
        columns = [batch.column("id"), batch.column("th"), pa.array(n, pa.int64()), pa.array(sid, pa.int64())]
        columns += [pa.array(sketches[:, j]) for j in range(SKETCH)]
        columns.append(pa.array(empty, pa.list_(pa.int64())))
        columns.append(pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(keys))))
        names = ["id", "th", "n", "sid", *[f"s{j}" for j in range(SKETCH)], "empty", "keys"]
        yield pa.RecordBatch.from_arrays(columns, names)

    bands, seen = Bands(percent), set()
    schema = "id long, th long, n long, sid long, " + ", ".join(f"s{j} long" for j in range(SKETCH))
    return map_texts(narrow, work, schema + ", empty array<long>, keys array<long>", "text")


def _could_link(percent: int) -> Column:
    """Sizes and sketches of sides x and y allow a link: of sizes x and y, linked sets differ in at most
    (x + y) * (100 - percent) / (100 + percent) shingles."""
    small, large = F.least("x_n", "y_n"), F.greatest("x_n", "y_n")
    bits = [F.bit_count(F.col(f"x_s{j}").bitwiseXOR(F.col(f"y_s{j}"))) for j in range(SKETCH)]
    differ = reduce(lambda a, b: a + b, bits)
    return (100 * small >= percent * large) & ((100 + percent) * differ <= (100 - percent) * (small + large))


def rarest_keys(members: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """(sid, key): of ``members`` (sid, key, c), keys of several sets and a rank of how many, those that links need.

    Two sets of a band that are linked differ in at most D of its ``parts``: parts - 1 - empties for the largest set of
    the band, fewer for one of ``n`` shingles (if ``sets`` has this column). A set with e empty parts has parts - e keys;
    in a link it shares at least parts - D - e of them, as no more parts are empty in both. So if all its keys are put in
    an order that all sets follow, one of the first D + 1 is shared, and among the first of the other set too. Keys that
    no other set has come first in that order, then the others by c. Sets with more empty parts than ``empties`` keep all
    keys, as do bands of millions of shingles.
    """
    bands = Bands(percent)
    table = [(bands.low(b) and bands.parts[b], bands.empties[b]) for b in range(LAST_BAND)] if percent < 100 else []
    mask = F.lit((1 << BAND_BITS) - 1)
    band = F.col("key").bitwiseAND(mask)
    own = Window.partitionBy("sid", "band")
    ranked = members.withColumn("band", band).select(
        "sid", "key", "band", F.row_number().over(own.orderBy("c", "key")).alias("at"), F.count("*").over(own).alias("held")
    )
    size = F.col("n") if "n" in sets.columns else F.lit(None).cast("long")
    empty = sets.select(F.col("sid").alias("e_sid"), "empty", size.alias("size"))
    ranked = ranked.join(empty, F.col("sid") == F.col("e_sid"))
    if not table:
        return ranked.select("sid", "key")
    place = F.least(F.col("band") + 1, F.lit(LAST_BAND)).cast("int")
    parts, empties = (F.element_at(F.array(*[F.lit(t[i]) for t in table]), place) for i in (0, 1))
    mine = F.filter("empty", lambda e: e.bitwiseAND(mask) == F.col("band"))
    gaps = F.shiftright(F.coalesce(F.get(mine, F.lit(0)), F.lit(0)), BAND_BITS)
    alone = parts - gaps - F.col("held")
    most = F.least(parts - 1 - empties, F.expr(f"size * {100 - percent} div {percent}"))
    needed = (F.col("at") <= most + 1 - alone) | (gaps > empties) | (F.col("band") >= LAST_BAND)
    return ranked.filter(needed).select("sid", "key")


def _side(df: DataFrame, name: str) -> DataFrame:
    return df.select(*[F.col(c).alias(f"{name}_{c}") for c in df.columns])


def verified(pairs: DataFrame, sets: DataFrame, docs: DataFrame, text: str, words: int, percent: int) -> DataFrame:
    """(a, b): the pairs (x_sid, y_sid) whose shingle sets are similar enough, counted on the whole texts.

    ``sets`` names one text hash per set; only the texts of these are fetched.
    """
    named = [sets.select(*[F.col(c).alias(f"{side}_{c}") for c in ("sid", "rep_id", "rep_th")]) for side in "xy"]
    pairs = stage(pairs.join(named[0], "x_sid").join(named[1], "y_sid"))
    sides = [pairs.select(F.col(f"{side}_rep_id").alias("id"), F.col(f"{side}_rep_th").alias("th")) for side in "xy"]
    rows = docs.select("id", F.xxhash64(text).alias("th"), F.col(text).alias("text"))
    texts = prefiltered(rows, ["id", "th"], sides[0].union(sides[1]), ["id", "th"])

    def with_text(df: DataFrame, side: str) -> DataFrame:
        own = texts.select("th", "id", F.col("text").alias(f"{side}_text"))
        same = (F.col(f"{side}_rep_th") == F.col("th")) & F.col(f"{side}_rep_id").eqNullSafe(F.col("id"))
        return df.join(own, same).drop("th", "id", f"{side}_rep_th", f"{side}_rep_id")

    both = with_text(with_text(pairs, "x"), "y")

    def work(batch: pa.RecordBatch):
        x_sets = shingle_sets(batch.column("x_text"), words)
        y_sets = shingle_sets(batch.column("y_text"), words)
        keep = []
        for x, y in zip(x_sets, y_sets):
            shared = len(np.intersect1d(x, y, assume_unique=True))
            keep.append(100 * shared >= percent * (len(x) + len(y) - shared))
        kept = batch.filter(pa.array(keep, pa.bool_()))
        yield pa.RecordBatch.from_arrays([kept.column("x_sid"), kept.column("y_sid")], ["a", "b"])

    return map_texts(both, work, "a long, b long", "x_text").distinct()


def near_components(
    docs: DataFrame, id: str = "doc_id", text: str = "text", words: int = WORDS, percent: int = PERCENT
) -> DataFrame:
    """(id, th, n_shingles, component) per row; ``component`` is the least set hash its set reaches through links.

    Two rows link when 100 * (shared shingles) >= ``percent`` * (shingles of either). Texts with fewer words have one
    shingle, all their words; null texts and texts without words have none and ``component`` null: they link with
    nothing. Rows of equal sets share a component, also rows with a null or repeated id. Exact: no link between
    different texts is lost but for hashes of 64 bits that collide.
    """
    spark = docs.sparkSession
    rows = stage(shingled(docs, id, text, words, percent))
    keyed = rows.select("sid", F.explode("keys").alias("key"))
    parts = []
    for turn in range(ROUNDS):
        some = keyed.filter(F.pmod(F.shiftright("key", BAND_BITS), F.lit(ROUNDS)) == turn)
        ends = [F.min("sid").alias("lo"), F.max("sid").alias("hi"), F.count("*").alias("c")]
        repeated = some.groupBy("key").agg(*ends).filter("lo != hi")
        repeated = stage(repeated.select("key", "c"))
        release(spark)
        parts.append(stage(some.join(repeated, "key").distinct()))
        release(spark)
    members = reduce(DataFrame.union, parts)
    empties = rows.select("sid", "empty", "n").join(members.select("sid").distinct(), "sid", "left_semi")
    empties = empties.groupBy("sid").agg(F.min("empty").alias("empty"), F.min("n").alias("n"))
    members = stage(rarest_keys(members, empties, percent))
    release(spark)

    same_in_all = [F.min(c).alias(c) for c in ["n", *[f"s{j}" for j in range(SKETCH)]]]
    in_keys = members.select("sid").distinct()
    sets = rows.drop("keys", "empty").join(in_keys, "sid", "left_semi")
    least = sets.groupBy("sid").agg(F.min("id").alias("rep_id"), *same_in_all)
    same = (F.col("sid") == F.col("l_sid")) & F.col("id").eqNullSafe(F.col("rep_id"))
    hashes = sets.join(least.select(F.col("sid").alias("l_sid"), "rep_id"), same)
    sets = stage(least.join(hashes.groupBy("sid").agg(F.min("th").alias("rep_th")), "sid"))

    light = sets.drop("rep_id", "rep_th")
    counts = members.groupBy("key").agg(F.count("*").alias("c"))
    score = members.join(counts, "key").groupBy("sid").agg(F.sum(F.col("c") - 1).alias("score"))
    ranked = score.select("sid", (F.col("score") * 1024 + F.pmod("sid", F.lit(1024))).alias("rank"))
    hubs = members.join(ranked, "sid").groupBy("key").agg(F.max_by("sid", "rank").alias("hub"))
    stars = members.join(hubs, "key").filter("sid != hub")
    stars = stars.select(F.least("sid", "hub").alias("a"), F.greatest("sid", "hub").alias("b")).distinct()
    narrow_docs = docs.select(F.col(id).cast("long").alias("id"), F.col(text).alias("text"))

    def candidates(pairs: DataFrame) -> DataFrame:
        x, y = _side(light, "x"), _side(light, "y")
        pairs = pairs.join(x, F.col("a") == F.col("x_sid")).join(y, F.col("b") == F.col("y_sid"))
        return pairs.filter(_could_link(percent)).select("x_sid", "y_sid")

    compared = stage(candidates(stars))
    links = stage(verified(compared, sets, narrow_docs, "text", words, percent))
    release(spark)
    labels = components(links)

    # Keys whose sets are not all connected yet: the pairs of sets in different components.
    placed = members.join(labels, F.col("sid") == F.col("node"), "left")
    placed = placed.select("key", "sid", F.coalesce("label", "sid").alias("label"))
    mixed = placed.groupBy("key").agg(F.min("label").alias("lo"), F.max("label").alias("hi"), F.count("*").alias("c"))
    mixed = mixed.filter("lo != hi").select("key", F.ceil(F.col("c") / BLOCK).alias("blocks"))
    open_ = stage(placed.join(mixed, "key").join(light, "sid"))
    own, other = F.pmod(F.xxhash64("sid"), F.col("blocks")), F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    x = _side(open_.select("*", other.alias("other")).withColumn("cell", own * F.col("blocks") + F.col("other")), "x")
    y = _side(open_.select("*", other.alias("other")).withColumn("cell", F.col("other") * F.col("blocks") + own), "y")
    meet = (F.col("x_key") == F.col("y_key")) & (F.col("x_cell") == F.col("y_cell"))
    apart = meet & (F.col("x_sid") < F.col("y_sid")) & (F.col("x_label") != F.col("y_label"))
    rest = x.join(y, apart & _could_link(percent)).select("x_sid", "y_sid").distinct()
    rest = stage(rest.join(compared, ["x_sid", "y_sid"], "left_anti"))
    more = verified(rest, sets, narrow_docs, "text", words, percent)
    labels = components(links.union(more).union(labels.select(F.col("node").alias("a"), F.col("label").alias("b"))))
    release(spark)
    found = rows.select("id", "th", "n", "sid").join(labels, F.col("sid") == F.col("node"), "left")
    return found.select("id", "th", F.col("n").alias("n_shingles"), F.coalesce("label", "sid").alias("component"))


def document_components(
    docs: DataFrame, id: str = "doc_id", text: str = "text", words: int = WORDS, percent: int = PERCENT
) -> DataFrame:
    """(id, n_shingles, component_id) per row: the smallest id reachable by links, itself included.

    A row that links with nothing has its own id; one without an id has the smallest id of its group, or null.
    """
    rows = stage(near_components(docs, id, text, words, percent))
    least = rows.filter("component is not null").groupBy("component").agg(F.min("id").alias("least_id"))
    least = stage(least.withColumnRenamed("component", "c"))
    joined = rows.join(least, F.col("component") == F.col("c"), "left")
    return joined.select("id", "n_shingles", F.coalesce("least_id", "id").alias("component_id"))


def one_per_group(
    docs: DataFrame, id: str = "doc_id", text: str = "text", words: int = WORDS, percent: int = PERCENT
) -> DataFrame:
    """``docs`` with one row of each group of near-duplicates: the one with the smallest id (then text hash).

    Rows with an id come before rows without. Texts without words are in no group and stay. Of equal rows one stays.
    """
    rows = near_components(docs, id, text, words, percent)
    key = F.when(F.col("id").isNull(), F.col("th")).otherwise(F.col("id"))
    ranked = stage(rows.select("id", "th", "component", F.col("id").isNull().alias("no_id"), key.alias("rank")))
    grouped = ranked.filter("component is not null")
    named = grouped.filter("not no_id").groupBy("component").agg(F.min("rank").alias("best"))
    nameless = grouped.groupBy("component").agg(F.min(F.when(F.col("no_id"), F.col("rank"))).alias("best_th"))
    best = nameless.join(named, "component", "left")
    chosen = best.select(
        F.col("component").alias("c"), F.col("best").isNull().alias("c_no_id"), F.coalesce("best", "best_th").alias("c_rank")
    )
    same = (F.col("component") == F.col("c")) & (F.col("no_id") == F.col("c_no_id")) & (F.col("rank") == F.col("c_rank"))
    kept = grouped.join(stage(chosen), same, "left_semi")
    kept = kept.groupBy("id", "component").agg(F.min("th").alias("th")).select("id", "th")
    counted = grouped.groupBy("id", "th").agg(F.count("*").alias("n")).join(
        kept.select(F.col("id").alias("k_id"), F.col("th").alias("k_th")),
        F.col("id").eqNullSafe(F.col("k_id")) & (F.col("th") == F.col("k_th")),
        "left",
    )
    # Rows of these ids and texts all go, or one of equal rows stays; no other row needs a shuffle.
    open_ = counted.select("id", "th", F.col("k_th").isNotNull().alias("stays"), "n").filter("not stays or n > 1")
    open_ = stage(open_.select(F.col("id").alias("o_id"), F.col("th").alias("o_th"), "stays"))

    full = packed(docs).withColumns({"id": F.col(f"row.{id}").cast("long"), "th": F.xxhash64(f"row.{text}")})
    near = prefiltered(full, ["id", "th"], open_, ["o_id", "o_th"])
    same = (F.col("th") == F.col("o_th")) & F.col("id").eqNullSafe(F.col("o_id"))
    met = near.join(open_, same, "left")
    single = met.filter("stays").dropDuplicates(["o_id", "o_th"])
    rest = surely_not(full, ["id", "th"], open_, ["o_id", "o_th"])
    return rest.select("row").union(met.filter("stays is null").select("row")).union(single.select("row")).select("row.*")
