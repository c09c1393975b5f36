"""The whole load: raw frames in, nine stored tables out."""

from __future__ import annotations

import logging
from collections.abc import Callable, Iterable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from functools import partial

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from starquay.functions.columns import named
from starquay.operators.cleaning import missing_report
from starquay.operators.keys import largest_key
from starquay.plans import quality, tables
from starquay.plans.keyed import KEYED, affected_keys, changed_winners, rows_of_keys, with_kept_ids
from starquay.schemas import MISSING_SHARE, RAW_DEMOGRAPHICS, RAW_TEMPERATURE, TABLES
from starquay.sources import ledger, versions
from starquay.sources.readers import read_arrivals, read_csv, read_table, read_text_splits, stored_tables
from starquay.sources.sinks import added_rows, key_of, replaced_rows, write_segment
from starquay.sources.versions import Progress, Version
from starquay.staging import released, stage

log = logging.getLogger(__name__)

# What loads remember: which columns of the arrivals were sparse, and how often each was
# filled in each batch.
SPARSE = "sparse_columns"
PROFILES = "arrival_profiles"

# Tables made of each input.
TABLES_OF = {
    "arrivals": ("fact_immigration", "dim_immigration_personal", "dim_immigration_airline"),
    "temperature": ("dim_temperature",),
    "demographics": ("dim_demog_population", "dim_demog_statistics"),
    "labels": ("country_code", "city_code", "state_code"),
}


@dataclass
class RawFrames:
    """The raw inputs. A load may cover only some of them."""

    arrivals: DataFrame | None = None
    temperature: DataFrame | None = None
    demographics: DataFrame | None = None
    labels: DataFrame | None = None


def read_raw(
    spark: SparkSession,
    arrivals: str | list[str] | None = None,
    temperature: str | list[str] | None = None,
    demographics: str | list[str] | None = None,
    labels: str | list[str] | None = None,
    arrivals_format: str = "parquet",
    arrivals_fallback: str | None = None,
) -> RawFrames:
    """Raw frames from paths, globs or lists of files; each data set has its own."""
    raw = RawFrames()
    if arrivals:
        raw.arrivals = read_arrivals(spark, arrivals, arrivals_format, arrivals_fallback)
    if temperature:
        raw.temperature = read_csv(spark, temperature, RAW_TEMPERATURE)
    if demographics:
        raw.demographics = read_csv(spark, demographics, RAW_DEMOGRAPHICS, ";")
    if labels:
        raw.labels = read_text_splits(spark, labels)
    return raw


_OTHERS = "__others"


def _present(column: Column, kind: str) -> Column:
    """NULL for NaN as well, which does not keep a row, as in ``na.drop``."""
    return F.nanvl(column, F.lit(None)) if kind in ("double", "float") else column


@dataclass
class Cleaning:
    """What cleaning the arrivals did: row counts, the columns that counted as sparse, and how
    many values each raw column had."""

    before_rows: int
    after_rows: int
    sparse: list[str]
    filled: dict[str, int]


def stage_arrivals(
    raw: DataFrame, threshold: float = MISSING_SHARE, sparse: Sequence[str] | None = None
) -> tuple[DataFrame, Cleaning]:
    """Clean arrivals with the columns the tables need, and what cleaning did.

    Three tables come from this frame, and telling whether a row is empty needs every
    column that is not sparse. One wide scan writes the needed columns, observes how
    often each column is filled, and keeps, for rows without any needed value, which
    other columns are. Which columns are sparse is decided from those counts, and empty
    rows are left out on reading back. ``sparse`` repeats an earlier decision instead.
    There is no shuffle in that pass, so a task that is run again does not count twice.
    """
    have = [c for c in tables.ARRIVAL_COLUMNS if c in raw.columns]
    others = [c for c in raw.columns if c not in have]
    held = {c: _present(named(c), kind) for c, kind in raw.dtypes}
    blank = F.coalesce(*(held[c].cast("string") for c in have)).isNull()
    filled = F.array_compact(F.array(*(F.when(held[c].isNotNull(), F.lit(c)) for c in others)))
    if not others:
        filled = F.array().cast("array<string>")
    seen = Observation("raw")
    counts = [F.count(named(c)).alias(f"c{i}") for i, c in enumerate(raw.columns)]
    observed = raw.observe(seen, F.count(F.lit(1)).alias("rows"), *counts)
    staged = stage(observed.select(*map(named, have), F.when(blank, filled).alias(_OTHERS)), "arrivals")
    found = seen.get
    rows = found["rows"]
    values = {c: found[f"c{i}"] for i, c in enumerate(raw.columns)}
    if sparse is None:
        shares = {c: 1 - n / rows for c, n in values.items()} if rows else {}
        sparse = [c for c, share in shares.items() if c in others and share > threshold]
    dense = F.array(*(F.lit(c) for c in others if c not in sparse)).cast("array<string>")
    kept = F.col(_OTHERS).isNull() | F.arrays_overlap(_OTHERS, dense)
    clean = staged.where(kept)
    after = clean.count()
    return clean.select(*map(named, have)), Cleaning(rows, after, list(sparse), values)


def _at_once(steps: list[Callable[[], None]]) -> None:
    """Run independent steps from several threads, so that the small jobs of one
    table fill the cores that the last tasks of another leave idle."""
    with ThreadPoolExecutor(max_workers=max(1, len(steps))) as pool:
        for running in [pool.submit(step) for step in steps]:
            running.result()


@dataclass
class _Load:
    """What a load has made so far: paths under the root by table, none of them published.
    ``base`` is the version it started from."""

    spark: SparkSession
    root: str
    base: Version
    progress: Progress
    made: dict[str, list[str]] = field(default_factory=dict)
    notes: dict[str, object] = field(default_factory=dict)

    def __post_init__(self) -> None:
        self.earlier = self.progress.finished()

    def write(self, name: str, rows: Callable[[], DataFrame], as_files: bool = False) -> None:
        """Write a table whole, unless this load has finished it before it was interrupted."""
        if name in self.earlier:
            self.made[name] = self.earlier[name]
            return
        with released(self.spark):
            self.made[name] = write_segment(rows(), self.root, name, as_files)
        self.progress.finish(name, self.made[name])

    def read(self, name: str) -> DataFrame:
        return versions.read(self.spark, self.root, name, at=Version(0, self.made))

    def version(self) -> Version:
        """The version as it will be published."""
        return Version(self.base.number + 1, {**self.base.tables, **self.made}, {**self.base.notes, **self.notes})

    def publish(self) -> None:
        versions.publish(self.spark, self.root, self.base, self.made, self.notes)
        self.progress.forget()


def _rows_of_arrivals(arrivals: DataFrame) -> dict[str, DataFrame]:
    return {
        "fact_immigration": tables.fact_rows(arrivals),
        "dim_immigration_personal": tables.personal_rows(arrivals),
        "dim_immigration_airline": tables.airline_rows(arrivals),
    }


def _cleaned(raw: DataFrame, sparse: Sequence[str] | None) -> tuple[DataFrame, Cleaning]:
    arrivals, done = stage_arrivals(raw, sparse=sparse)
    log.info(
        "arrivals: %d rows, %d after cleaning, without %s",
        done.before_rows, done.after_rows, ", ".join(done.sparse) or "no column",
    )
    return arrivals, done


def _profile(done: Cleaning, batch: int) -> dict[str, object]:
    return {"batch": batch, "rows": done.before_rows, "filled": done.filled}


def _load_arrivals(load: _Load, raw: DataFrame, sparse: Sequence[str] | None) -> None:
    names = TABLES_OF["arrivals"]
    if all(name in load.earlier for name in (SPARSE, PROFILES, *names)):
        load.made.update({name: load.earlier[name] for name in names})
        load.notes.update({note: load.earlier[note] for note in (SPARSE, PROFILES)})
        return
    with released(load.spark):
        arrivals, done = _cleaned(raw, load.earlier.get(SPARSE, sparse))
        found = {PROFILES: [_profile(done, load.base.number + 1)], SPARSE: done.sparse}
        for note, value in found.items():
            load.notes[note] = value
            if note not in load.earlier:
                load.progress.finish(note, value)
        rows = _rows_of_arrivals(arrivals)
        _at_once([partial(load.write, name, partial(tables.with_key, df, name)) for name, df in rows.items()])


def _load_keyed(load: _Load, name: str, raw: DataFrame) -> None:
    """The winners are a table of their own, from which the tables of the input are made."""
    given = KEYED[name]
    load.write(given.state, lambda: given.winners(raw).select(*map(named, given.columns)), as_files=True)
    winners = load.read(given.state)

    def rows(table: str) -> DataFrame:
        made = given.outputs[table](winners)
        return tables.with_key(made, table) if TABLES[table].id_column else tables.typed(made, table)

    _at_once([partial(load.write, table, partial(rows, table), True) for table in given.outputs])


def _refresh_arrivals(load: _Load, raw: DataFrame, sparse: Sequence[str] | None) -> None:
    def add(name: str, rows: DataFrame) -> None:
        with released(load.spark):
            typed = tables.typed(rows, name)
            load.made[name] = added_rows(load.spark, typed, load.root, TABLES[name], load.base)

    with released(load.spark):
        arrivals, done = _cleaned(raw, sparse)
        load.notes[SPARSE] = load.base.notes.get(SPARSE, done.sparse)
        load.notes[PROFILES] = [*load.base.notes.get(PROFILES, []), _profile(done, load.base.number + 1)]
        _at_once([partial(add, name, rows) for name, rows in _rows_of_arrivals(arrivals).items()])


def _refresh_keyed(load: _Load, name: str, raw: DataFrame) -> None:
    """Decide again for the keys that the batch holds, and replace what came of them."""
    given, spark, root = KEYED[name], load.spark, load.root
    if given.state not in load.base.tables:
        if stored_tables(spark, root, given.outputs, load.base):
            raise ValueError(f"{name} was stored without {given.state}: load it in full once")
        _load_keyed(load, name, raw)
        return
    with released(spark):
        known = versions.read(spark, root, given.state, at=load.base).select(*map(named, given.columns))
        incoming = given.winners(raw).select(*map(named, given.columns))
        if incoming.dtypes != known.dtypes:
            raise TypeError(f"{name}: {incoming.dtypes}, but stored as {known.dtypes}")
        changed = stage(changed_winners(known, stage(incoming, "incoming"), given), "changed")
        if changed.isEmpty():
            return
        keys = stage(changed.select(key_of(given.key)), "changed_keys")
        held = load.base.tables[given.state]
        load.made[given.state] = replaced_rows(
            spark, root, given.state, known.schema, held, given.key, keys, changed
        )
        winners = load.read(given.state)

        def replace(table: str) -> None:
            spec = TABLES[table]
            with released(spark):
                keys = stage(affected_keys(changed, given, table), "affected_keys")
                rows = rows_of_keys(given.rows(table, winners), spec.natural_key, keys)
                if spec.id_column:
                    stored = read_table(spark, root, table, load.base)
                    last = largest_key(stored, spec.id_column)
                    rows = with_kept_ids(rows_of_keys(stored, spec.natural_key, keys), rows, table, last)
                load.made[table] = replaced_rows(
                    spark, root, table, spec.schema, load.base.tables[table], spec.natural_key, keys, rows
                )

        _at_once([partial(replace, table) for table in given.outputs])


def _each_input(raw: RawFrames, arrivals, keyed) -> None:
    steps = [] if raw.arrivals is None else [partial(arrivals, raw.arrivals)]
    steps += [partial(keyed, name, df) for name in KEYED if (df := getattr(raw, name)) is not None]
    _at_once(steps)


def _write_ledger(load: _Load, files: DataFrame | None, replace: Iterable[str] = ()) -> None:
    """Add ``files`` to the ledger, in place of those of the inputs in ``replace``."""
    if files is None:
        return
    replaced = list(replace)
    new = files.withColumn("batch", F.lit(load.base.number + 1).cast("bigint"))
    kept = list(load.base.tables.get(ledger.LEDGER, []))
    if replaced and kept:
        old = ledger.ledger(load.spark, load.root, load.base)
        new, kept = old.where(~F.col("input").isin(replaced)).unionByName(new), []
    load.made[ledger.LEDGER] = kept + write_segment(new, load.root, ledger.LEDGER)


def sparse_columns_of(spark: SparkSession, root: str) -> list[str] | None:
    """The columns that counted as sparse in the full load under ``root``, if it had arrivals."""
    return versions.latest(spark, root).notes.get(SPARSE)


def stored_profile(spark: SparkSession, root: str, ascending: bool = False) -> DataFrame:
    """(column_name, missing_count, missing_percentage) of the raw arrivals of all batches so
    far, as ``cleaning.missing_profile`` would give of all of them at once. Counts
    add up, so no raw file is read again. A row that two batches delivered counts twice,
    as it does in a load of both."""
    profiles = versions.latest(spark, root).notes.get(PROFILES, [])
    rows = sum(profile["rows"] for profile in profiles)
    filled: dict[str, int] = {}
    for profile in profiles:
        for name, count in profile["filled"].items():
            filled[name] = filled.get(name, 0) + count
    counted = [(name, rows - count, rows) for name, count in filled.items()]
    return missing_report(spark.createDataFrame(counted, "column_name string, missing_count bigint, rows bigint"), "rows", ascending)


def sparse_on_all_data(spark: SparkSession, root: str, threshold: float = MISSING_SHARE) -> list[str]:
    """The columns that a load of all batches so far would count as sparse, to compare with
    the decision that refreshes repeat."""
    needed = set(tables.ARRIVAL_COLUMNS)
    found = stored_profile(spark, root).where(F.col("missing_percentage") > threshold * 100).collect()
    return sorted(row.column_name for row in found if row.column_name not in needed)


def full_load(
    raw: RawFrames,
    root: str,
    sparse: Sequence[str] | None = None,
    files: DataFrame | None = None,
    checked: bool = True,
) -> list[str] | None:
    """Replace the tables of the given inputs under ``root``, all at once.

    The tables are written beside the old ones and checked, and then become the current
    version. A load that fails, or whose tables do not pass, leaves the version before as
    it is. The columns of the arrivals that counted as sparse, or were given as such, are
    returned, and kept with the version for the refreshes. ``files``, as listed by
    ``ledger.list_files``, go into the ledger; with them a load that was interrupted and is
    started again on the same files goes on with the tables that it had not finished.
    """
    given = {name: df for name, df in vars(raw).items() if df is not None}
    if not given:
        return None
    spark = next(iter(given.values())).sparkSession
    base = versions.latest(spark, root)
    load_id = None if files is None else f"{base.number}-{ledger.fingerprint(files)}"
    load = _Load(spark, root, base, Progress(spark, root, load_id))
    _each_input(raw, lambda df: _load_arrivals(load, df, sparse), partial(_load_keyed, load))
    if checked:
        _check(spark, stored_tables(spark, root, tables_of(raw), load.version()), tables_of(raw))
    _write_ledger(load, files, replace=given)
    load.publish()
    return load.notes.get(SPARSE)


def refresh(
    spark: SparkSession,
    raw: RawFrames,
    root: str,
    sparse: Sequence[str] | None = None,
    files: DataFrame | None = None,
) -> None:
    """Bring the tables under ``root`` to what one load of all inputs so far would give.

    Arrivals that are new are added. Temperatures, demographics and labels are decided
    again for the keys of the batch, and what changes is replaced. All of it shows at
    once. Running it again with the same inputs changes nothing. Which columns are sparse,
    and so which rows are empty, is as in the full load, not as in the batch at hand,
    unless ``sparse`` says otherwise.
    """
    base = versions.latest(spark, root)
    load = _Load(spark, root, base, Progress(spark, root, None))
    decided = base.notes.get(SPARSE) if sparse is None else sparse
    _each_input(raw, lambda df: _refresh_arrivals(load, df, decided), partial(_refresh_keyed, load))
    changed = [name for name, paths in load.made.items() if paths != base.tables.get(name)]
    quality.require_schemas(
        spark,
        stored_tables(spark, root, [name for name in changed if name in TABLES], load.version()),
        {name: TABLES[name].schema for name in changed if name in TABLES},
    )
    _write_ledger(load, files)
    if changed or files is not None:
        load.publish()


def read_unseen(
    spark: SparkSession,
    root: str,
    inputs: Mapping[str, str],
    arrivals_format: str = "parquet",
) -> tuple[RawFrames, DataFrame | None]:
    """The raw frames of those files behind ``inputs`` (path or glob by data set) that the
    ledger under ``root`` does not hold, and their list for the next version. An input
    without new files is not read at all. Their paths come to the driver, as
    they do whenever files are read."""
    new = ledger.unseen(spark, root, ledger.list_files(spark, inputs))
    rows = new.collect()
    paths: dict[str, list[str]] = {}
    for row in sorted(rows, key=lambda row: row.path):
        paths.setdefault(row.input, []).append(row.path)
    listed = spark.createDataFrame(rows, ledger.FILE_SCHEMA) if rows else None
    return read_raw(spark, **paths, arrivals_format=arrivals_format), listed


def tables_of(raw: RawFrames) -> list[str]:
    """Names of the tables that a load of these inputs writes."""
    return [
        name for given, names in TABLES_OF.items() if getattr(raw, given) is not None for name in names
    ]


def _check(spark: SparkSession, stored: Mapping[str, DataFrame], names: Iterable[str]) -> DataFrame:
    quality.require_schemas(spark, stored, {name: TABLES[name].schema for name in names})
    return quality.require_rows(spark, stored)


def check(spark: SparkSession, root: str, names: Iterable[str] = tuple(TABLES)) -> DataFrame:
    """Raise unless the tables of the current version exist, have their schema and hold
    rows; else return their row counts."""
    names = list(names)
    return _check(spark, stored_tables(spark, root, names), names)
