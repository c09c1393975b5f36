"""Inputs of which one row per key counts, and how a later batch changes what counts.

A full load picks a winner per key and makes tables of the winners. The winners are kept
beside the tables, as raw as they came, with the columns that broke their ties. So a
refresh can decide again: an incoming row that beats the stored winner of its key takes
its place, and the rows of the tables that were made of it are replaced. A load and a
refresh then leave what one load of both would.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starquay.functions.columns import named
from starquay.operators import labels
from starquay.operators.cleaning import first_per_key
from starquay.operators.keys import dense_key
from starquay.plans import tables
from starquay.schemas import (
    DEMOGRAPHICS_KEY,
    RAW_DEMOGRAPHICS,
    RAW_TEMPERATURE,
    TABLES,
    TEMPERATURE_KEY,
)
from starquay.staging import stage

_NEW, _KEY, _ROW, _RANK, _KEPT = "__new", "__key", "__row", "__rank", "__kept"


@dataclass(frozen=True)
class KeyedInput:
    """``winners``: raw rows to one row per ``key``, with ``columns``. ``order``: what decides
    between rows of a key, before all their other columns in order. ``outputs``: the rows
    of each table, as the winners give them.
    """

    state: str
    key: tuple[str, ...]
    columns: tuple[str, ...]
    winners: Callable[[DataFrame], DataFrame]
    order: Callable[[], list[Column]]
    outputs: dict[str, Callable[[DataFrame], DataFrame]]

    def rows(self, table: str, winners: DataFrame) -> DataFrame:
        """Typed rows of a table without surrogate key; distinct where they get one."""
        typed = tables.typed(self.outputs[table](winners), table)
        return typed.distinct() if TABLES[table].id_column else typed


def _in_order(schema, names: set[str]) -> tuple[str, ...]:
    return tuple(name for name in schema.names if name in names)


def _last_entry_first() -> list[Column]:
    """A file that is delivered again takes the place of what it said before."""
    first, *rest = labels.ENTRY_ORDER
    return [F.desc(first), F.desc(_NEW), *map(F.desc, rest)]


KEYED = {
    "temperature": KeyedInput(
        "winning_temperature",
        tuple(TEMPERATURE_KEY),
        _in_order(RAW_TEMPERATURE, tables.TEMPERATURE_COLUMNS),
        tables.temperature_winners,
        tables.temperature_order,
        {"dim_temperature": tables.temperature_rows},
    ),
    "demographics": KeyedInput(
        "winning_demographics",
        tuple(DEMOGRAPHICS_KEY),
        _in_order(RAW_DEMOGRAPHICS, tables.DEMOGRAPHIC_COLUMNS),
        tables.clean_demographics,
        list,
        {
            "dim_demog_population": tables.population_rows,
            "dim_demog_statistics": tables.statistics_rows,
        },
    ),
    "labels": KeyedInput(
        "winning_labels",
        ("section", "code"),
        ("file", "section", "position", "code", "label"),
        lambda raw: labels.last_entries(labels.entries_of(raw)),
        _last_entry_first,
        {
            "country_code": labels.country_codes,
            "city_code": labels.city_codes,
            "state_code": labels.state_codes,
        },
    ),
}


def _keyed(df: DataFrame, key: Sequence[str]) -> DataFrame:
    return df.withColumn(_KEY, F.struct(*map(named, key)))


def changed_winners(known: DataFrame, incoming: DataFrame, given: KeyedInput) -> DataFrame:
    """The rows of ``incoming``, one per key, that beat the ``known`` winner of their key or
    have none.

    History is cut to the incoming keys by a semi join, which AQE turns into a broadcast of
    the smaller side on its measured size, so it is scanned and not shuffled. Of equal
    rows the known one stays.
    """
    asked = _keyed(incoming, given.key).select(_KEY)
    history = _keyed(known, given.key).join(asked, _KEY, "left_semi").drop(_KEY)
    both = history.withColumn(_NEW, F.lit(0)).unionByName(incoming.withColumn(_NEW, F.lit(1)))
    best = first_per_key(both, given.key, given.order()).where(F.col(_NEW) == 1).drop(_NEW)
    row = F.struct(*map(named, given.columns)).alias(_ROW)
    same = history.select(row)
    return best.withColumn(_ROW, row).join(same, _ROW, "left_anti").drop(_ROW)


def affected_keys(changed: DataFrame, given: KeyedInput, table: str) -> DataFrame:
    """The natural keys of a table that ``changed`` winners have a part in, as structs. Those
    of a winner and of the one it replaces are the same: they come from the key of the input."""
    return _keyed(given.rows(table, changed), TABLES[table].natural_key).select(_KEY).distinct()


def rows_of_keys(df: DataFrame, key: Sequence[str], keys: DataFrame) -> DataFrame:
    return _keyed(df, key).join(keys, _KEY, "left_semi").drop(_KEY)


def with_kept_ids(old: DataFrame, new: DataFrame, table: str, last: int) -> DataFrame:
    """Rows ``new`` of some natural keys with the surrogate keys of the rows ``old`` of those
    keys: a row that stays keeps its own, a changed row takes that of a row that goes,
    in order, and what is left gets new ones from ``last`` + 1."""
    spec = TABLES[table]
    plain = [name for name in spec.schema.names if name != spec.id_column]
    row, key = F.struct(*map(named, plain)), F.struct(*map(named, spec.natural_key))
    before = old.select(row.alias(_ROW), key.alias(_KEY), F.col(spec.id_column).alias(_KEPT))
    after = new.select(row.alias(_ROW), key.alias(_KEY))
    same = after.join(before.select(_ROW, _KEPT), _ROW).select(_ROW, _KEPT)
    gone = before.join(after.select(_ROW), _ROW, "left_anti").withColumn(
        _RANK, F.row_number().over(Window.partitionBy(_KEY).orderBy(_KEPT))
    )
    come = after.join(before.select(_ROW), _ROW, "left_anti").withColumn(
        _RANK, F.row_number().over(Window.partitionBy(_KEY).orderBy(_ROW))
    )
    paired = come.join(gone.select(_KEY, _RANK, _KEPT), [_KEY, _RANK], "left").select(_ROW, _KEPT)
    settled = stage(same.unionByName(paired), "kept_ids").select(f"{_ROW}.*", _KEPT)
    fresh = dense_key(settled.where(F.col(_KEPT).isNull()).drop(_KEPT), spec.id_column, spec.natural_key, start=last)
    known = settled.where(F.col(_KEPT).isNotNull()).withColumnRenamed(_KEPT, spec.id_column)
    return known.unionByName(fresh).select(*map(named, spec.schema.names))
