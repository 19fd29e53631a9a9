"""SimHash fingerprints of documents, and all fingerprints within a Hamming radius, with DataFrame functions only.

A text's terms are its distinct words, lower-cased, each weighing its length in characters: frequent short words say
little. Every term's 64-bit hash votes with its weight for its ones and against its zeros; a bit of the fingerprint is
set if the votes for it prevail. Votes are summed two to a long, so that a text of any length needs 32 sums.

An empty table gives an empty result.
"""

from __future__ import annotations

from functools import reduce
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.operators.sizing import input_bytes
from tidemark.session import stage

SPACE = r"[\x20\x09-\x0D]+"
BITS = 64
LONGEST = 32
LOW_BITS = 0x0000000100000001
RADIUS = 3
#: The fingerprint is cut into BLOCKS; a table is keyed by all but RADIUS of them.
BLOCKS = 6
#: Target bytes of a range of ids, and the most ranges.
RANGE_BYTES = 8 << 20
MAX_RANGES = 4_096


def _terms(text: Column) -> Column:
    return F.array_distinct(F.split(F.lower(F.coalesce(text, F.lit(""))), SPACE))


def _votes(term: Column) -> list[Column]:
    """Sums over terms: 32 longs with the weights of the ones of bits k (low half) and k + 32 (high half), and all."""
    weight = F.least(F.length(term), F.lit(LONGEST)).cast("long")
    bits = F.xxhash64(term)
    ones = [F.sum(F.shiftrightunsigned(bits, k).bitwiseAND(F.lit(LOW_BITS)) * weight) for k in range(BITS // 2)]
    return [s.alias(f"v{k}") for k, s in enumerate(ones)] + [F.sum(weight).alias("all")]


def _fingerprint() -> Column:
    """From the sums of :func:`_votes`; a tie gives 0, and so does a text without words."""
    low, high = F.lit(0xFFFFFFFF), F.col("all")
    bits = []
    for k in range(BITS // 2):
        bits.append(F.when(2 * F.col(f"v{k}").bitwiseAND(low) > high, F.lit(1 << k)).otherwise(F.lit(0)))
        top = (1 << (k + 32)) - (1 << 64 if k == 31 else 0)
        bits.append(F.when(2 * F.shiftrightunsigned(f"v{k}", 32) > high, F.lit(top)).otherwise(F.lit(0)))
    return reduce(lambda a, b: a.bitwiseOR(b), [b.cast("long") for b in bits])


def fingerprints(df: DataFrame, keys: list[str], text: str) -> DataFrame:
    """(keys, fp): a fingerprint per distinct value of ``keys``, which must tell the rows of ``df`` apart.

    Whole texts; null and empty texts have fingerprint 0, equal texts equal fingerprints. Each text's votes are summed
    in the task that reads it, so at most one row per text is shuffled, and none if ``df`` is partitioned by the keys.
    """
    terms = df.select(*keys, F.explode(_terms(F.col(text))).alias("term"))
    return terms.groupBy(*keys).agg(*_votes(F.col("term"))).select(*keys, _fingerprint().alias("fp"))


def likeness(a: Column, b: Column) -> Column:
    """Share of equal bits of two fingerprints, 0 to 1."""
    return 1 - F.bit_count(a.bitwiseXOR(b)) / F.lit(float(BITS))


def to_hex(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), BITS // 4, "0"))


def compare_edited(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """Fingerprints of every text and of its edited text, and how alike they are to each other and to the next text.

    The edited text has its last quarter (floor(n_chars / 4) code points) replaced by the first as many, or all, of the
    next document by ascending id; after the last comes the first. Rows of one id follow each other by text. A row
    without an id has no next document: its last quarter is cut off and ``near_next`` is null.

    Ids are cut into ranges at quantiles, which are ids themselves, so the document after a range is known by its id
    and added to the range; then every range is worked on by itself and nothing else is shuffled.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(id).cast("long").alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    n = min(MAX_RANGES, max(int(spark.conf.get("spark.sql.shuffle.partitions")), input_bytes(rows) // RANGE_BYTES, 2))
    marks = [F.lit(i / n) for i in range(1, n)]
    cut = F.percentile_approx("id", F.array(*marks), F.lit(100 * n))
    least, bounds = rows.agg(F.min("id"), cut).first()
    bounds = sorted({b for b in bounds or [] if b > least})
    below = F.array(*[F.lit(b).cast("long") for b in bounds]) if bounds else F.array().cast("array<long>")
    # A range's number is how many bounds are not above the id: a binary search among the sorted bounds.
    place = F.expr(_search(bounds, "id")) if bounds else F.lit(0)
    loose = F.pmod(F.xxhash64("text"), F.lit(len(bounds) + 1)).cast("int")
    own = rows.withColumn("range", F.when(F.col("id").isNull(), loose).otherwise(place))
    own = own.withColumn("kind", F.when(F.col("id").isNull(), 2).otherwise(0))
    after = rows.filter(F.col("id").isin([least, *bounds])) if least is not None else rows.limit(0)
    turn = F.when(F.col("id") == F.lit(least), F.lit(len(bounds))).otherwise(F.array_position(below, F.col("id")) - 1)
    after = after.select("id", "text", turn.cast("int").alias("range"), F.lit(1).alias("kind"))

    order = Window.partitionBy("range").orderBy("kind", "id", "text")
    placed = own.unionByName(after).withColumn("at", F.row_number().over(order))
    placed = placed.withColumn("next", F.when(F.col("kind") == 0, F.lead("text").over(order)))
    n_chars = F.length("text")
    placed = placed.withColumn("n", n_chars.cast("long"))
    quarter = F.floor(n_chars / 4).cast("int")
    kept = F.substring(F.col("text"), F.lit(1), n_chars - quarter)
    edited = F.concat(kept, F.substring(F.coalesce("next", F.lit("")), F.lit(1), quarter))
    placed = placed.withColumn("edited", edited).withColumn("sha", F.sha2("edited", 256))
    both = F.explode(
        F.array(
            F.struct(F.lit(0).alias("side"), F.col("text").alias("side_text")),
            F.struct(F.lit(1).alias("side"), F.col("edited").alias("side_text")),
        )
    )
    keys = ["range", "at", "kind", "id", "n", "sha"]
    sides = placed.select(*keys, both.alias("s"))
    prints = fingerprints(sides.select(*keys, "s.side", "s.side_text"), [*keys, "side"], "side_text")
    pair = prints.groupBy(*keys).agg(
        F.max(F.when(F.col("side") == 0, F.col("fp"))).alias("fp"),
        F.max(F.when(F.col("side") == 1, F.col("fp"))).alias("edited_fp"),
    )
    in_range = Window.partitionBy("range").orderBy("at")
    pair = pair.withColumn("next_fp", F.when(F.col("kind") == 0, F.lead("fp").over(in_range)))
    return pair.filter("kind != 1").select(
        F.col("id"),
        F.col("n").alias("n_chars"),
        F.col("sha").alias("edited_sha256"),
        to_hex(F.col("fp")).alias("fingerprint"),
        to_hex(F.col("edited_fp")).alias("edited_fingerprint"),
        likeness(F.col("fp"), F.col("edited_fp")).alias("near_edited"),
        likeness(F.col("fp"), F.col("next_fp")).alias("near_next"),
    )


def _search(bounds: list[int], name: str) -> str:
    """How many of the sorted ``bounds`` are at most the column ``name``, as nested comparisons."""

    def part(lo: int, hi: int) -> str:
        if lo == hi:
            return str(lo)
        mid = (lo + hi) // 2
        return f"IF({name} < {bounds[mid]}L, {part(lo, mid)}, {part(mid + 1, hi)})"

    return part(0, len(bounds))


def block_keys(fp: Column, blocks: int = BLOCKS, radius: int = RADIUS) -> Column:
    """Array of (table, key): one permuted table for each choice of ``blocks - radius`` blocks, keyed by those blocks.

    Two fingerprints that differ in at most ``radius`` bits agree on at least one such choice.
    """
    if not 0 <= radius < blocks:
        raise ValueError("the radius must be less than the number of blocks")
    edges = [round(i * BITS / blocks) for i in range(blocks + 1)]
    keys = []
    for table, chosen in enumerate(combinations(range(blocks), blocks - radius)):
        mask = sum(((1 << (edges[b + 1] - edges[b])) - 1) << edges[b] for b in chosen)
        signed = mask - (1 << 64) if mask >> 63 else mask
        keys.append(F.struct(F.lit(table).alias("table"), fp.bitwiseAND(F.lit(signed).cast("long")).alias("key")))
    return F.array(*keys)


def within_radius(queries: DataFrame, prints: DataFrame, radius: int = RADIUS, blocks: int = BLOCKS) -> DataFrame:
    """(query_fp, fp, distance): for every fingerprint of ``queries`` all of ``prints`` at most ``radius`` bits away.

    Both have a long column ``fp``; each distinct value is looked up once however many documents share it, so copies
    meet as one. Exact: every pair within the radius is found, and reported from the first table it meets in. Rows
    without a fingerprint match nothing.
    """
    tables = lambda df, name: (
        df.select(F.col("fp").alias(name)).filter(F.col(name).isNotNull()).distinct()
        .select(name, F.inline(block_keys(F.col(name), blocks, radius)))
    )
    found = stage(tables(prints, "fp"))
    q = tables(queries, "query_fp").withColumnsRenamed({"table": "q_table", "key": "q_key"})
    distance = F.bit_count(F.col("query_fp").bitwiseXOR(F.col("fp")))
    same = (F.col("q_table") == F.col("table")) & (F.col("q_key") == F.col("key")) & (distance <= radius)
    pairs = q.join(found, same).select("query_fp", "fp", distance.cast("int").alias("distance"))
    return pairs.distinct()
