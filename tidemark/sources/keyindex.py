"""Which folders of a table may hold a key: key ranges and Bloom filters, so that a load reads no other.

A filter is a table of 64-bit words. A key belongs to one word and sets four of its bits; a folder may hold the key if all
four are set. With 2^level words, chosen for about four keys a word, one absent key in some hundred seems held. Only
words with a bit are stored, in the folder ``_index`` of a write, so that small parts of a large write cost little.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import replace
from functools import reduce
from typing import TYPE_CHECKING

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.plans.model import Dataset

if TYPE_CHECKING:
    from tidemark.sources.store import Folder, Store

INDEX = "_index"
KEYS_A_WORD = 4
BITS_A_KEY = 4
MAX_LEVEL = 36
#: So many keys are tried first; folders in which one of them may be need no more trying.
FIRST = 1000
SCHEMA = "part int, word long, bits long"


def keys_of(ds: Dataset) -> tuple[str, ...]:
    """The columns whose values loads look up in the stored table; none for tables that are never asked."""
    return ds.keys if ds.load == "insert" else ds.unique


def text_of(ds: Dataset) -> Column | None:
    """A one-column key as text that sorts like the key; None for other keys."""
    keys = keys_of(ds)
    kinds = [ds.schema[k].dataType for k in keys]
    return F.col(keys[0]).cast("string") if kinds in ([T.StringType()], [T.DateType()]) else None


def _hash(keys: Sequence[str]) -> Column:
    return F.xxhash64(*[F.col(f"`{k}`") for k in keys])


def _word(hash: Column, level: int) -> Column:
    """The hash's first ``level`` bits, one at least."""
    return F.shiftrightunsigned(F.shiftrightunsigned(hash, 1), 63 - level)


def _bits(hash: Column) -> Column:
    """Four bits of a word, from the hash's last bits."""
    places = [F.shiftright(hash, 6 * i).bitwiseAND(F.lit(63)).cast("int") for i in range(BITS_A_KEY)]
    return reduce(Column.bitwiseOR, [F.call_function("shiftleft", F.lit(1).cast("long"), p) for p in places])


def build(store: Store, ds: Dataset, folders: list[Folder]) -> list[Folder]:
    """Write the index of what one write has left, from its key columns alone; the folders with their index's level."""
    keys = keys_of(ds)
    most = max((f.rows for f in folders), default=0)
    if not keys or not most:
        return folders
    level = min(max(most // KEYS_A_WORD, 1).bit_length(), MAX_LEVEL)
    part = folders[0].part
    fields = [ds.schema[k] for k in keys] + ([T.StructField(part, T.IntegerType())] if part else [])
    path = f"{store.root}/{ds.name}/{folders[0].written}"
    rows = store.spark.read.schema(T.StructType(fields)).parquet(path)
    rows = rows.select(_hash(keys).alias("hash"), F.col(part).alias("part") if part else F.lit(0).alias("part"))
    words = rows.groupBy("part", _word(F.col("hash"), level).alias("word")).agg(F.bit_or(_bits(F.col("hash"))).alias("bits"))
    words.write.parquet(f"{path}/{INDEX}")
    return [replace(f, level=level) for f in folders]


def may_hold(store: Store, ds: Dataset, folders: Sequence[Folder], keys: DataFrame) -> list[Folder]:
    """The folders in which one of the rows of ``keys`` (the key columns, read from files) may be; a null equals a null.

    Folders without an index count as holding any key. At most a row per folder comes back from the tasks.
    """
    names = keys_of(ds)
    text = text_of(ds)
    open_ = [f for f in folders if f.rows != 0]
    if text is not None and open_:
        ends = keys.agg(F.min(text), F.max(text), F.count_if(text.isNull())).first()
        if not ends[2]:
            open_ = [f for f in open_ if f.level is None or _meets(f, ends[0], ends[1])]
    hit = {f.path for f in open_ if f.level is None}
    hashes = keys.select(_hash(names).alias("hash"))
    for some in (hashes.limit(FIRST), hashes):
        left = [f for f in open_ if f.path not in hit]
        if left:
            hit |= _probed(store, ds, left, some)
    return [f for f in open_ if f.path in hit]


def _meets(folder: Folder, low: str | None, high: str | None) -> bool:
    if folder.low is None or low is None:
        return False
    return folder.low.encode() <= high.encode() and low.encode() <= folder.high.encode()


def _probed(store: Store, ds: Dataset, folders: Sequence[Folder], hashes: DataFrame) -> set[str]:
    """Paths of the folders in whose filter one of the hashes is."""
    by_part = {(f.written, f.number): f.path for f in folders}
    found: set[str] = set()
    for level in sorted({f.level for f in folders}):
        own = [f for f in folders if f.level == level]
        writes = sorted({f.written for f in own})
        words = store.spark.read.schema(SCHEMA).parquet(*[f"{store.root}/{ds.name}/{w}/{INDEX}" for w in writes])
        words = words.filter(F.col("part").isin(sorted({f.number for f in own})))
        words = words.select("*", F.regexp_extract("_metadata.file_path", r"data/[^/]+", 0).alias("write"))
        keyed = hashes.select(_word(F.col("hash"), level).alias("k_word"), _bits(F.col("hash")).alias("k_bits"))
        all_set = F.col("bits").bitwiseAND(F.col("k_bits")) == F.col("k_bits")
        met = words.join(keyed, (F.col("word") == F.col("k_word")) & all_set).select("write", "part").distinct()
        found |= {by_part[tuple(r)] for r in met.collect() if tuple(r) in by_part}
    return found
