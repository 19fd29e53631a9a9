"""Warehouse tables as parquet folders with an atomic switch.

A load writes its rows into a new folder that nobody reads yet. Committing adds one small numbered file that lists the
folders in force; the highest number is the current state. A load that fails before that leaves the old state in place,
and readers of the old state keep their files.

The state also describes each folder: rows, highest cursor, broken rules, a fingerprint of the rows that adds up over
folders, and the least and greatest key. So a load compares and counts without reading what is stored.
"""

from __future__ import annotations

import json
import re
import time
import uuid
from collections.abc import Mapping, Sequence
from dataclasses import asdict, dataclass, field
from itertools import zip_longest

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.scalars import conform, month_number
from tidemark.operators import runs
from tidemark.operators.rows import multiset_sums, sort_for_layout
from tidemark.plans.model import Dataset
from tidemark.session import CODEC
from tidemark.sources import keyindex

PART = "_month"
BUCKET = "_bucket"
REJECTED = -1  # label of quarantined rows, in place of a month


@dataclass(frozen=True)
class Folder:
    """A folder of rows.

    ``month`` or ``bucket`` (one of ``buckets``) says which part of the table it holds, ``base`` is added to its stored
    ids. ``rows``, ``cursor`` (the highest), ``sums`` (see ``multiset_sums``), ``low`` and ``high`` (of a one-column key
    of text or day) describe its rows; ``level`` is that of its key index, see ``keyindex``.
    """

    path: str
    month: int | None = None
    rows: int | None = None
    cursor: int | None = None
    bucket: int | None = None
    buckets: int | None = None
    base: int = 0
    sums: tuple[int, ...] | None = None
    low: str | None = None
    high: str | None = None
    level: int | None = None

    @property
    def written(self) -> str:
        """The folder of the write that it belongs to."""
        return re.sub(rf"/({PART}|{BUCKET})=[^/]*$", "", self.path)

    @property
    def part(self) -> str | None:
        """The column that a write's folders are split by."""
        return PART if self.month is not None else BUCKET if self.bucket is not None else None

    @property
    def number(self) -> int:
        """Month, bucket or 0."""
        return next((n for n in (self.month, self.bucket) if n is not None), 0)


@dataclass(frozen=True)
class Written:
    """What a write left: its folders, not yet in force, and the number of rows that break each of the given rules."""

    folders: list[Folder]
    broken: dict[str, int] = field(default_factory=dict)

    @property
    def rows(self) -> int:
        return sum(f.rows for f in self.folders)


def bucket_of(keys: Sequence[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*[F.col(f"`{k}`") for k in keys]), F.lit(buckets)).cast("int")


def added_up(folders: Sequence[Folder]) -> tuple[int, ...] | None:
    """The fingerprint of all folders' rows together; None if one has none."""
    if any(f.sums is None for f in folders):
        return None
    return tuple(sum(c) for c in zip(*[f.sums for f in folders])) if folders else EMPTY


def to_compact(folders: Sequence[Folder], rows: int) -> list[list[Folder]]:
    """The folders worth rewriting, in lists to be written one after the other; each part has one new folder in a list.

    Folders of one part with fewer than ``rows`` rows are packed, the smallest first, until they have as many. None of
    them has more than two thirds of its pack's rows, so every row moves to a folder at least half as large again, and is
    rewritten only as often as its folder can grow so. Buckets have one folder each; rejected rows stay where they are.
    """
    small = [f for f in folders if f.bucket is None and f.month != REJECTED and f.rows is not None and f.rows < rows]
    parts: dict[int, list[list[Folder]]] = {}
    for f in sorted(small, key=lambda f: (f.rows, f.path)):
        packs = parts.setdefault(f.number, [[]])
        if sum(g.rows for g in packs[-1]) >= rows:
            packs.append([])
        packs[-1].append(f)
    for packs in parts.values():
        for pack in packs:
            while pack and 3 * pack[-1].rows > 2 * sum(g.rows for g in pack):
                pack.pop()
        packs[:] = [pack for pack in packs if len(pack) > 1]
    return [[f for pack in packs if pack for f in pack] for packs in zip_longest(*parts.values())]


#: The columns of ``multiset_sums``, and the fingerprint of no rows.
SUMS = ("rows", *[f"h{seed}_{shift}" for seed in (1, 2) for shift in (0, 22, 44)])
EMPTY = (0,) * len(SUMS)


class Store:
    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        self._hadoop = spark._jvm.org.apache.hadoop.fs
        self._conf = spark._jsc.hadoopConfiguration()

    # --- small files ---------------------------------------------------------------------------------------------

    def _path(self, path: str):
        return self._hadoop.Path(path)

    def _fs(self):
        return self._path(self.root).getFileSystem(self._conf)

    def _children(self, path: str) -> list[str]:
        fs, folder = self._fs(), self._path(path)
        return [s.getPath().getName() for s in fs.listStatus(folder)] if fs.exists(folder) else []

    def _states(self, ds: Dataset) -> str:
        return f"{self.root}/{ds.name}/_state"

    def _versions(self, ds: Dataset) -> list[int]:
        names = self._children(self._states(ds))
        return sorted(int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit())

    def _version(self, ds: Dataset) -> int:
        return max(self._versions(ds), default=-1)

    def _put(self, ds: Dataset, version: int, folders: Sequence[Folder]) -> None:
        """Write beside, then rename. The rename refuses an existing name, so of two writers one fails."""
        states = self._states(ds)
        draft = self._path(f"{states}/.{uuid.uuid4().hex}")
        out = self._fs().create(draft, False)
        out.write(bytearray(json.dumps([asdict(f) for f in folders]).encode()))
        out.close()
        context = self._hadoop.FileContext.getFileContext(draft.toUri(), self._conf)
        no_options = self.spark.sparkContext._gateway.new_array(getattr(self._hadoop, "Options$Rename"), 0)
        context.rename(draft, self._path(f"{states}/{version:08d}.json"), no_options)

    # --- state ---------------------------------------------------------------------------------------------------

    def exists(self, ds: Dataset) -> bool:
        return self._version(ds) >= 0

    def ensure(self, ds: Dataset) -> str:
        """Create the empty table unless it is there: ``created`` or ``exists``."""
        if self.exists(ds):
            return "exists"
        self._put(ds, 0, [])
        return "created"

    def state(self, ds: Dataset) -> tuple[int, list[Folder]]:
        version = self._version(ds)
        if version < 0:
            raise FileNotFoundError(f"{ds.name} has not been created")
        return version, self._folders(ds, version)

    def _folders(self, ds: Dataset, version: int) -> list[Folder]:
        stream = self._fs().open(self._path(f"{self._states(ds)}/{version:08d}.json"))
        try:
            text = self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        return [Folder(**{k: tuple(v) if isinstance(v, list) else v for k, v in f.items()}) for f in json.loads(text)]

    def commit(self, ds: Dataset, base: int, folders: Sequence[Folder]) -> None:
        """Put the folders in force, provided nobody committed since state ``base`` was read."""
        self._put(ds, base + 1, folders)

    # --- rows ----------------------------------------------------------------------------------------------------

    def read_folders(self, ds: Dataset, folders: Sequence[Folder]) -> DataFrame:
        """All stored columns of the folders' rows, ids as the table gives them."""
        if not folders:
            return self.spark.createDataFrame([], ds.stored_schema)
        df = self.spark.read.schema(ds.stored_schema).parquet(*[f"{self.root}/{ds.name}/{f.path}" for f in folders])
        if not ds.surrogate or not any(f.base for f in folders):
            return df
        # One row per folder: the number of folders bounds what is broadcast.
        bases = self.spark.createDataFrame([(f.path, f.base) for f in folders], "__folder string, __base long")
        own = F.regexp_extract("_metadata.file_path", rf"data/[^/]+(/{BUCKET}=[0-9]+)?", 0)
        placed = df.select("*", own.alias("__own")).join(F.broadcast(bases), F.col("__own") == F.col("__folder"))
        return placed.select((F.col("id") + F.col("__base")).alias("id"), *ds.schema.names)

    def read(self, ds: Dataset, with_id: bool = False) -> DataFrame:
        """The current rows, declared columns only."""
        _, folders = self.state(ds)
        valid = [f for f in folders if f.month != REJECTED]
        return self.read_folders(ds, valid).select(*(ds.stored_schema if with_id else ds.schema).names)

    def quarantine(self, ds: Dataset) -> DataFrame:
        """Rows rejected by earlier loads, with the ``reason``."""
        _, folders = self.state(ds)
        schema = T.StructType([*ds.schema.fields, T.StructField("reason", T.StringType())])
        paths = [f"{self.root}/{ds.name}/{f.path}" for f in folders if f.month == REJECTED]
        return self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)

    def write(self, ds: Dataset, df: DataFrame, checks: Mapping[str, Column] | None = None, buckets: int = 0) -> Written:
        """Write rows into a new folder, not yet in force.

        Tables kept by month are spread by a rebalance on the month, which splits a month too large for one task,
        and are sorted inside each file. Rows with a ``reason`` go to a folder of their own, in the same pass.
        ``df`` may be runs of days, see operators/runs.py: runs are shuffled and sorted, days are made in the tasks that write.
        ``buckets``: ``df`` has a column BUCKET and is written by it. ``checks``: rules and when a row breaks them.

        A folder of one part is described while it is written; the tasks of the writing stage report their rows once,
        also if they are repeated. Several parts are described by one pass over what was written.
        """
        name = f"data/{uuid.uuid4().hex}"
        path = f"{self.root}/{ds.name}/{name}"
        checks = checks or {}
        facts = self._facts(ds, checks)
        if not ds.month_column and not buckets:
            seen = Observation()
            df.observe(seen, *facts).write.parquet(path, compression=CODEC)
            return self._indexed(ds, [self._described(name, seen.get)], self._broken(checks, [seen.get]))
        if buckets:
            part = BUCKET
            df.write.partitionBy(part).parquet(path, compression=CODEC)
        else:
            part = PART
            is_runs = runs.FIRST in df.columns
            df, day = (runs.by_month(df, ds.period), runs.FIRST) if is_runs else (df, ds.month_column)
            label = month_number(day)
            if "reason" in df.columns:
                label = F.when(F.col("reason") != "", REJECTED).otherwise(label)
            monthly = df.withColumn(part, label).hint("rebalance", part)
            monthly = sort_for_layout(monthly, [part, *[day if k == ds.month_column else k for k in ds.keys]])
            if is_runs:
                more = ["reason"] if "reason" in df.columns else []
                monthly = monthly.withColumn(ds.month_column, runs.days_of(ds.period))
                monthly = monthly.select(*ds.stored_schema.names, *more, part)
            monthly.write.partitionBy(part).parquet(path, compression=CODEC)
        if not any(c.startswith(f"{part}=") for c in self._children(path)):
            return Written([])
        schema = T.StructType([*ds.stored_schema.fields, T.StructField(part, T.IntegerType())])
        every = self.spark.read.schema(schema).parquet(path).groupBy(part).agg(*facts)
        found = sorted((r.asDict() for r in every.collect()), key=lambda r: r[part])  # a row per part
        own = lambda n: {"bucket": n, "buckets": buckets} if buckets else {"month": n}
        folders = [self._described(f"{name}/{part}={r[part]}", r, **own(r[part])) for r in found]
        return self._indexed(ds, folders, self._broken(checks, [r for r in found if buckets or r[part] != REJECTED]))

    def _facts(self, ds: Dataset, checks: Mapping[str, Column]) -> list[Column]:
        cursor = F.col(ds.cursor) if ds.cursor else F.lit(None).cast("long")
        key = keyindex.text_of(ds)
        # Not text where there is no key: a least text is found by sorting all rows, a least number is not.
        key = F.lit(None).cast("long") if key is None else key
        ends = [F.max(cursor).alias("cursor"), F.min(key).alias("low"), F.max(key).alias("high")]
        broken = [F.count_if(rule).alias(f"broken{i}") for i, rule in enumerate(checks.values())]
        return [*multiset_sums(ds.schema.names), *ends, *broken]

    @staticmethod
    def _described(path: str, facts: Mapping, **part: int) -> Folder:
        sums = tuple(int(facts.get(n) or 0) for n in SUMS)
        ends = {k: facts.get(k) for k in ("cursor", "low", "high")}
        return Folder(path, rows=sums[0], sums=sums, **ends, **part)

    @staticmethod
    def _broken(checks: Mapping[str, Column], facts: Sequence[Mapping]) -> dict[str, int]:
        counts = {rule: sum(f.get(f"broken{i}") or 0 for f in facts) for i, rule in enumerate(checks)}
        return {rule: n for rule, n in counts.items() if n}

    def _indexed(self, ds: Dataset, folders: list[Folder], broken: dict[str, int]) -> Written:
        return Written(keyindex.build(self, ds, folders), broken)

    def may_hold(self, ds: Dataset, folders: Sequence[Folder], keys: DataFrame) -> list[Folder]:
        """The folders in which one of the keys may be; in the others surely none is. See ``keyindex``."""
        return keyindex.may_hold(self, ds, folders, keys)

    def append(self, ds: Dataset, df: DataFrame) -> None:
        version, folders = self.state(ds)
        self.commit(ds, version, folders + self.write(ds, conform(df, ds.stored_schema)).folders)

    def overwrite(self, ds: Dataset, df: DataFrame) -> None:
        """Replace all rows; ``df`` may read the table itself, as the old folders stay."""
        version, _ = self.state(ds)
        self.commit(ds, version, self.write(ds, conform(df, ds.stored_schema)).folders)

    def compact(self, ds: Dataset, rows: int) -> int:
        """Put the rows of small folders into larger ones, see ``to_compact``; returns by how many folders there are fewer.

        Ids, cursor and fingerprints stay as they are. The old folders are left to readers and :meth:`vacuum`. A load that
        commits meanwhile wins, and nothing is compacted.
        """
        version, folders = self.state(ds)
        old, written = [], []
        for group in to_compact(folders, rows):
            held = self.read_folders(ds, group)
            fresh = self.write(ds, held if ds.month_column else held.hint("rebalance")).folders
            if added_up(group) not in (None, added_up(fresh)):
                raise RuntimeError(f"{ds.name}: the rows changed while they were compacted")
            old += group
            written += fresh
        if old:
            self.commit(ds, version, [f for f in folders if f not in old] + written)
        return len(old) - len(written)

    def vacuum(self, ds: Dataset, keep: int = 10, hours: float = 7 * 24) -> int:
        """Delete the folders that none of the last ``keep`` states names; returns their number.

        Folders younger than ``hours`` stay, as a load may be writing them: it must be longer than any load or reader
        takes. State files stay too, they are small, and a late writer must find its number taken.
        """
        if keep < 1:
            raise ValueError("keep at least the current state")
        fs, now = self._fs(), time.time() * 1000
        data = f"{self.root}/{ds.name}/data"
        found = {f"data/{name}" for name in self._children(data)}
        parts = {
            f"{f}/{c}" for f in found for c in self._children(f"{self.root}/{ds.name}/{f}") if c.startswith((PART, BUCKET))
        }
        kept = [f for version in self._versions(ds)[-keep:] for f in self._folders(ds, version)]
        named, in_use = {f.path for f in kept}, {f.written for f in kept}
        unused = (found - in_use) | {p for p in parts - named if p.rsplit("/", 1)[0] in in_use}
        paths = [self._path(f"{self.root}/{ds.name}/{name}") for name in sorted(unused)]
        old = [p for p in paths if now - fs.getFileStatus(p).getModificationTime() >= hours * 3_600_000]
        return sum(fs.delete(p, True) for p in old)
