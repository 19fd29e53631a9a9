"""Create, load, synchronise and view the warehouse tables."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, replace
from datetime import date
from typing import TypeVar

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.functions.scalars import conform, month_number
from tidemark.operators import loads, runs
from tidemark.operators.keys import number_staged
from tidemark.operators.quality import Rules, RuleViolation, mark, repeats, taken, violations
from tidemark.operators.rows import collapse, diff_rows, distinct, multiset_sums
from tidemark.operators.runs import upsert_days
from tidemark.operators.sizing import estimated_small
from tidemark.plans.catalog import DATASETS
from tidemark.plans.model import Dataset, Inputs
from tidemark.session import setting, stage, staging
from tidemark.sources.profiles import Profile, write_table
from tidemark.sources.records import export_records
from tidemark.sources.store import BUCKET, REJECTED, SUMS, Folder, Store, added_up, bucket_of

#: Rows of a bucket, the part of a table that a synchronisation replaces at a time, and the most buckets of a table.
BUCKET_ROWS = ("spark.tidemark.bucket.rows", 1_000_000)
MAX_BUCKETS = 4096
#: Folders with fewer rows are small, see ``Warehouse.compact``.
COMPACT_ROWS = ("spark.tidemark.compact.rows", 5_000_000)

CREATED, EXISTS, LOADED = "created", "exists", "loaded"
NOTHING_NEW, IN_STEP, FAILED = "nothing new", "in step", "failed"


@dataclass(frozen=True)
class LoadReport:
    dataset: str
    outcome: str
    inserted: int = 0
    updated: int = 0
    quarantined: int = 0
    message: str = ""


@dataclass(frozen=True)
class Run:
    """What one load works with: its staging folder and its view of the source."""

    folder: str
    inputs: Inputs


@dataclass(frozen=True)
class Staged:
    """A written frame, with the fingerprint of its rows (the first number is their count) and the rules they break.

    All three come from the one pass that wrote it.
    """

    rows: DataFrame
    sums: tuple[int, ...]
    broken: dict[str, int]


Result = TypeVar("Result")


class LoadFailed(RuntimeError):
    """A load that changed nothing; ``report`` says why."""

    def __init__(self, report: LoadReport):
        super().__init__(f"{report.dataset}: {report.message}")
        self.report = report


class Warehouse:
    """The tables under ``root``, filled from the source tables that ``read`` gives by name.

    ``end`` is the last day of generated dates, today by default. ``land`` copies the source tables of each load to the
    shared folder first: for databases, which are then read once per load, whatever the load counts and compares.
    """

    def __init__(
        self,
        spark: SparkSession,
        root: str,
        read: Callable[[str], DataFrame],
        end: date | None = None,
        land: bool = False,
    ):
        self.spark = spark
        self.store = Store(spark, root)
        self.inputs = Inputs(spark, read, end)
        self._land = land

    def create(self, name: str) -> LoadReport:
        return LoadReport(name, self.store.ensure(DATASETS[name]))

    def build(self, name: str) -> DataFrame:
        """The transformed source."""
        return DATASETS[name].build(self.inputs)

    def view(self, name: str) -> DataFrame:
        """What a reader asks for: the transformed source; for the calendar the stored table with its ids."""
        ds = DATASETS[name]
        return self.store.read(ds, with_id=True) if ds.sync is None else self.build(name)

    def export(self, name: str, path: str) -> None:
        export_records(self.view(name), path)

    def publish(self, name: str, profile: Profile) -> None:
        """Write the stored rows with their ids to a table of the same name elsewhere, such as a reporting database."""
        ds = DATASETS[name]
        write_table(self.store.read(ds, with_id=ds.surrogate), profile, name)

    def load(self, name: str, clear: bool = False) -> LoadReport:
        """Add the rows the table does not have yet, by the table's protocol. ``clear`` empties it first."""
        run = {"append": self._append, "insert": self._insert, "all": self._append_all}[DATASETS[name].load]
        return self._guarded(run, DATASETS[name], clear)

    def sync(self, name: str) -> LoadReport:
        """Bring the table in step with the source, by the table's protocol."""
        ds = DATASETS[name]
        if ds.sync is None:
            raise ValueError(f"{name} has no synchronisation")
        return self._guarded({"replace": self._replace, "merge": self._merge, "upsert": self._upsert}[ds.sync], ds)

    def _guarded(self, run: Callable[..., Result], ds: Dataset, *args) -> Result:
        """Each load has a folder and inputs of its own, so loads of one warehouse may run side by side."""
        try:
            with staging(self.spark) as folder:
                inputs = self.inputs.landed(folder) if self._land else self.inputs
                return run(Run(folder, inputs), ds, *args)
        except (RuleViolation, PySparkException) as error:
            raise LoadFailed(LoadReport(ds.name, FAILED, message=str(error))) from error
        except Py4JJavaError as error:
            cause = str(error.java_exception)
            message = f"another writer committed first: {cause}" if "FileAlreadyExists" in cause else cause
            raise LoadFailed(LoadReport(ds.name, FAILED, message=message)) from error

    def compact(self, name: str) -> int:
        """Join the small folders that loads have left into larger ones, see ``Store.compact``; how many fewer there are."""
        rows = setting(self.spark, COMPACT_ROWS)
        return self._guarded(lambda _, ds: self.store.compact(ds, rows), DATASETS[name])

    def vacuum(self, name: str, keep: int = 10, hours: float = 7 * 24) -> int:
        """Delete replaced rows and what failed loads left, see ``Store.vacuum``."""
        return self.store.vacuum(DATASETS[name], keep, hours)

    # --- plain loads -----------------------------------------------------------------------------------------------

    def _append(self, run: Run, ds: Dataset, clear: bool) -> LoadReport:
        version, folders = self._state(ds, clear)
        mark_at = max((f.cursor for f in folders if f.cursor is not None), default=0)
        new = run.inputs.increment(ds.cursor_table, mark_at, ds.number)
        return self._add(run, ds, ds.build(new), version, folders)

    def _insert(self, run: Run, ds: Dataset, clear: bool) -> LoadReport:
        """Find the absent keys first, from keys alone; if few, pick their rows out of the source by a broadcast.

        Only folders that may hold one of the source's keys are read.
        """
        version, folders = self._state(ds, clear)
        source = ds.build(run.inputs)
        if not folders:
            return self._add(run, ds, collapse(source, ds.keys, ds.order, "first"), version, folders)
        wanted = stage(conform(source, ds.schema).select(*ds.keys).distinct(), run.folder)
        near = self.store.may_hold(ds, folders, wanted)
        target = self.store.read_folders(ds, near).select(*ds.schema.names)
        absent = stage(loads.absent_keys(wanted, target, ds.keys), run.folder)
        if absent.isEmpty():
            return LoadReport(ds.name, NOTHING_NEW)
        if estimated_small(absent):
            rows = loads.insert_keys(source, absent, ds.keys, ds.order)
        else:
            rows = loads.insert_absent(source, target, ds.keys, ds.order)
        return self._add(run, ds, rows, version, folders)

    def _append_all(self, run: Run, ds: Dataset, clear: bool) -> LoadReport:
        """Every distinct source row is added, whatever the table holds. Rows that break a rule are set aside."""
        version, folders = self._state(ds, clear)
        written = self.store.write(ds, self._marked(run, ds)).folders
        inserted = sum(f.rows for f in written if f.month != REJECTED)
        quarantined = sum(f.rows for f in written if f.month == REJECTED)
        if written:
            self.store.commit(ds, version, folders + written)
        return LoadReport(ds.name, LOADED if inserted else NOTHING_NEW, inserted, quarantined=quarantined)

    def _marked(self, run: Run, ds: Dataset) -> DataFrame:
        """The distinct source rows with their ``reason``; as runs of days where the table has them and each day of a run
        keeps or breaks the rules with the others."""
        if not ds.build_runs or ds.rules.unique:
            return mark(self._distinct(run, ds), ds.rules)
        days = ds.build_runs(run.inputs).withColumnRenamed(runs.FIRST, ds.month_column)
        return mark(days, ds.rules).withColumnRenamed(ds.month_column, runs.FIRST)

    def _add(self, run: Run, ds: Dataset, rows: DataFrame, version: int, folders: list[Folder]) -> LoadReport:
        written, inserted = self._write_checked(run, ds, rows, folders, is_added=True)
        if not inserted:
            return LoadReport(ds.name, NOTHING_NEW)
        self.store.commit(ds, version, folders + written)
        return LoadReport(ds.name, LOADED, inserted)

    # --- synchronisation -------------------------------------------------------------------------------------------

    def _replace(self, run: Run, ds: Dataset) -> LoadReport:
        """The source is read once into a staged copy, compared by stored fingerprints, and written where it differs.

        The fingerprints of the whole tables settle whether anything differs, without reading the target. If so those of
        the buckets say where, and only these buckets are written anew; the others keep their folders, and their ids
        move along.
        """
        version, folders = self._state(ds)
        staged = self._stage(run, ds, ds.build(run.inputs))
        if staged.sums == self._stored_sums(ds, folders):
            return LoadReport(ds.name, IN_STEP)
        buckets, changed = self._differing(ds, staged, folders)
        part = staged.rows if changed is None else staged.rows.filter(self._bucket(ds, buckets).isin(changed))
        self._raise_if(violations(part, ds.rules))
        kept = [] if changed is None else [f for f in folders if f.buckets == buckets and f.bucket not in changed]
        written = self._write_buckets(run, ds, part, buckets)
        self.store.commit(ds, version, _numbered(kept + written))
        return LoadReport(ds.name, LOADED, staged.sums[0])

    def differences(self, name: str) -> DataFrame:
        """Keys that are missing in the stored table, extra in it or changed against the source, see ``diff_rows``.

        For tables with a unique column. Only buckets whose fingerprints differ are read.
        """
        ds = DATASETS[name]
        if not ds.unique or ds.sync != "replace":
            raise ValueError(f"{name} has no unique column, or is not kept by buckets")
        _, folders = self._state(ds)
        with staging(self.spark) as folder:
            staged = self._stage(Run(folder, self.inputs), ds, ds.build(self.inputs))
            source, near = staged.rows, list(folders)
            if staged.sums == self._stored_sums(ds, folders):
                source, near = source.limit(0), []
            stored = None
            if near:
                buckets, changed = self._differing(ds, staged, folders)
                if changed is not None:
                    differs = self._bucket(ds, buckets).isin(changed)
                    near = [f for f in folders if f.buckets != buckets or f.bucket in changed]
                    source, stored = source.filter(differs), self.store.read_folders(ds, near).filter(differs)
            stored = self.store.read_folders(ds, near) if stored is None else stored
            return stage(diff_rows(source, stored.select(*ds.schema.names), ds.unique))

    def _bucket(self, ds: Dataset, buckets: int) -> Column:
        return bucket_of(ds.unique or (ds.cursor,), buckets)

    def _stored_sums(self, ds: Dataset, folders: Sequence[Folder]) -> tuple[int, ...]:
        """The fingerprint of the folders' rows; they are read only if a folder came without one."""
        known = added_up(folders)
        if known is None:
            known = tuple(int(n or 0) for n in self.store.read_folders(ds, folders).agg(*multiset_sums(ds.schema.names)).first())
        return known

    def _differing(self, ds: Dataset, staged: Staged, folders: Sequence[Folder]) -> tuple[int, list[int] | None]:
        """The number of buckets, and those in which source and table differ; None for all, where the table is not yet
        kept by buckets or has outgrown them. Rows appended since the last synchronisation are in no bucket's folder:
        theirs count as different. At most one row per bucket comes back.
        """
        wanted = min(max(-(-staged.sums[0] // setting(self.spark, BUCKET_ROWS)) - 1, 0).bit_length(), MAX_BUCKETS.bit_length() - 1)
        buckets = max((f.buckets for f in folders if f.buckets), default=0)
        if not buckets or 1 << wanted > 4 * buckets or any(f.sums is None for f in folders):
            return 1 << wanted, None
        stored = {f.bucket: f.sums for f in folders if f.buckets == buckets}
        found = staged.rows.groupBy(self._bucket(ds, buckets).alias(BUCKET)).agg(*multiset_sums(ds.schema.names)).collect()
        own = {r[BUCKET]: tuple(int(r[n]) for n in SUMS) for r in found}
        changed = {b for b in own.keys() | stored.keys() if own.get(b) != stored.get(b)}
        loose = [f for f in folders if f.buckets != buckets]
        if loose:
            held = self.store.read_folders(ds, loose).select(self._bucket(ds, buckets).alias(BUCKET)).distinct().collect()
            changed |= {r[BUCKET] for r in held}
        return buckets, sorted(changed)

    def _write_buckets(self, run: Run, ds: Dataset, rows: DataFrame, buckets: int) -> list[Folder]:
        """Write staged rows bucket by bucket, numbered from 1 in each.

        A row's number is its place among the bucket's rows by staged file and position, the same if a task is repeated.
        Rows are shuffled once, a bucket to a task, and written once.
        """
        if buckets == 1:
            written = self.store.write(ds, number_staged(rows)).folders
            return [replace(f, bucket=0, buckets=1) for f in written if f.rows]
        place = Window.partitionBy(BUCKET).orderBy("__file", "__index")
        dealt = rows.select(
            "*",
            self._bucket(ds, buckets).alias(BUCKET),
            F.col("_metadata.file_name").alias("__file"),
            F.col("_metadata.row_index").alias("__index"),
        ).withColumn("id", F.row_number().over(place).cast("long"))
        return self.store.write(ds, dealt.select(*ds.stored_schema.names, BUCKET), buckets=buckets).folders

    def _merge(self, run: Run, ds: Dataset) -> LoadReport:
        """Equal fingerprints mean that nothing is to be merged; then the target is not read."""
        version, folders = self._state(ds)
        staged = self._stage(run, ds, ds.build(run.inputs), Rules(ds.rules.not_null, ds.rules.max_length))
        self._raise_if(staged.broken)
        if staged.sums == added_up(folders):
            return LoadReport(ds.name, IN_STEP)
        source, rows = staged.rows, staged.sums[0]
        months, _, _ = self._touched(ds, source)
        if not months:
            if rows == sum(f.rows for f in folders):
                return LoadReport(ds.name, IN_STEP)
            return LoadReport(ds.name, LOADED, 0, rows)

        def next_state(src: DataFrame, tgt: DataFrame) -> DataFrame:
            return loads.merge(src, tgt, ds.keys, ds.order)

        inserted = self._rewrite(run, ds, source, months, version, folders, next_state)
        return LoadReport(ds.name, LOADED, inserted, rows - inserted)

    def _upsert(self, run: Run, ds: Dataset) -> LoadReport:
        version, folders = self._state(ds)
        if ds.build_runs:
            return self._upsert_runs(run, ds, version, folders)
        source = stage(self._distinct(run, ds), run.folder)
        months, updated, most = self._touched(ds, source)
        if not months:
            return LoadReport(ds.name, IN_STEP)

        def next_state(src: DataFrame, tgt: DataFrame) -> DataFrame:
            if ds.period:
                tgt = tgt.select(*ds.schema.names)
                return upsert_days(src, tgt, ds.keys, ds.update, ds.month_column, ds.period, ds.order, run.folder)
            return loads.upsert(src, tgt, ds.keys, ds.update, ds.order, unique_source=most <= 1, folder=run.folder)

        inserted = self._rewrite(run, ds, source, months, version, folders, next_state)
        return LoadReport(ds.name, LOADED, inserted, updated)

    def _upsert_runs(self, run: Run, ds: Dataset, version: int, folders: list[Folder]) -> LoadReport:
        """The upsert of a table whose source comes as runs: stored days are read once, made into runs and compared as such.

        Stored rows without a day match nothing; the source has none, so their folder is never touched.
        """
        source = stage(ds.build_runs(run.inputs), run.folder)
        target = runs.to_runs(self.store.read(ds), ds.month_column, ds.period, run.folder)
        keys = [k for k in ds.keys if k != ds.month_column]
        found = runs.touched_months(source, target, keys, ds.period).collect()  # a row per month
        months = {r["month"] for r in found if r["month"] is not None}
        if not months:
            return LoadReport(ds.name, IN_STEP)
        changed = runs.upsert_runs(source, target, keys, ds.update, ds.period, ds.order, run.folder)
        part = runs.by_month(changed, ds.period).filter(month_number(runs.FIRST).isin(sorted(months)))
        old = [f for f in folders if f.month in months]
        written, after = self._write_checked(run, ds, part, [])
        self.store.commit(ds, version, [f for f in folders if f.month not in months] + written)
        return LoadReport(ds.name, LOADED, after - sum(f.rows for f in old), sum(r["matched"] for r in found))

    def _touched(self, ds: Dataset, source: DataFrame) -> tuple[set[int], int, int]:
        """Months to rewrite, number of matched target rows, largest number of source rows of one key.

        At most one row per month comes back.
        """
        found = loads.touched_months(source, self.store.read(ds), ds.keys, ds.month_column).collect()
        months = {r["month"] for r in found if r["month"] is not None}
        return months, sum(r["matched"] for r in found), max((r["most"] for r in found), default=0)

    def _rewrite(
        self,
        run: Run,
        ds: Dataset,
        source: DataFrame,
        months: set[int],
        version: int,
        folders: list[Folder],
        next_state: Callable[[DataFrame, DataFrame], DataFrame],
    ) -> int:
        """Write the next state of the touched months; all other months keep their folders. Returns rows gained."""
        old = [f for f in folders if f.month in months]
        target = self.store.read_folders(ds, old)
        touched = source.filter(month_number(ds.month_column).isin(sorted(months)))
        written, after = self._write_checked(run, ds, next_state(touched, target), [])
        self.store.commit(ds, version, [f for f in folders if f.month not in months] + written)
        return after - sum(f.rows for f in old)

    # --- shared ----------------------------------------------------------------------------------------------------

    def _state(self, ds: Dataset, clear: bool = False) -> tuple[int, list[Folder]]:
        version, folders = self.store.state(ds)
        return version, [] if clear else folders

    def _distinct(self, run: Run, ds: Dataset) -> DataFrame:
        if ds.build_distinct:
            return ds.build_distinct(run.inputs)
        return distinct(conform(ds.build(run.inputs), ds.schema))

    def _stage(self, run: Run, ds: Dataset, rows: DataFrame, rules: Rules | None = None) -> Staged:
        """Write ``rows`` to the load's folder; what is counted is counted in that pass, once per row.

        The counters stand in the writing stage, whose tasks report once however often they are repeated.
        """
        checks = rules.checks() if rules else {}
        seen = Observation()
        counted = [F.count_if(rule).alias(f"broken{i}") for i, rule in enumerate(checks.values())]
        staged = stage(conform(rows, ds.schema).observe(seen, *multiset_sums(ds.schema.names), *counted), run.folder)
        facts = seen.get
        broken = {rule: n for i, rule in enumerate(checks) if (n := facts.get(f"broken{i}"))}
        return Staged(staged, tuple(int(facts.get(n) or 0) for n in SUMS), broken)

    def _write_checked(
        self, run: Run, ds: Dataset, rows: DataFrame, folders: Sequence[Folder], is_added: bool = False
    ) -> tuple[list[Folder], int]:
        """Write rows where nobody reads them yet, check them, and return their folders and number.

        Rows and broken rules are counted by the pass that writes. Rows added to ``folders`` need a cursor, where the
        table has one, and a key that these do not hold. Tables with a surrogate key are staged first and numbered on
        the way to their folder; the first rows of a table that is synchronised by buckets go to buckets.
        """
        rules = ds.rules
        if is_added and ds.cursor:
            rules = replace(rules, not_null=[*rules.not_null, ds.cursor])
        if not ds.surrogate:
            rows = rows if runs.FIRST in rows.columns else conform(rows, ds.schema)
            written = self.store.write(ds, rows, rules.checks())
            self._raise_if(written.broken | repeats(self.store.read_folders(ds, written.folders), rules))
            return written.folders, written.rows
        staged = self._stage(run, ds, rows, rules)
        clashes = self._clashes(run, ds, staged.rows, folders) if is_added and ds.cursor and folders else {}
        self._raise_if(staged.broken | repeats(staged.rows, rules) | clashes)
        if not staged.sums[0]:
            return [], 0
        if ds.sync == "replace" and not folders:
            buckets, _ = self._differing(ds, staged, [])
            return _numbered(self._write_buckets(run, ds, staged.rows, buckets)), staged.sums[0]
        known = sum(f.rows for f in folders)
        return self.store.write(ds, number_staged(staged.rows, known)).folders, staged.sums[0]

    def _clashes(self, run: Run, ds: Dataset, rows: DataFrame, folders: Sequence[Folder]) -> dict[str, int]:
        """New rows whose unique key is stored; folders that surely hold none are not read."""
        if not ds.unique:
            return {}
        keys = stage(rows.select(*ds.unique).distinct(), run.folder)
        near = self.store.may_hold(ds, folders, keys)
        clashes = taken(keys, self.store.read_folders(ds, near), ds.unique).count() if near else 0
        return {f"{', '.join(ds.unique)} is already in the table": clashes} if clashes else {}

    @staticmethod
    def _raise_if(found: dict[str, int]) -> None:
        if found:
            raise RuleViolation(found)


def _numbered(folders: Sequence[Folder]) -> list[Folder]:
    """Folders of buckets in order, the ids of each following on the last one's."""
    out, before = [], 0
    for f in sorted(folders, key=lambda f: f.bucket):
        out.append(replace(f, base=before))
        before += f.rows
    return out
