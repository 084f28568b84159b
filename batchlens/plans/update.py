"""The update run: ingest new batches, profile them, mine their rules."""

from __future__ import annotations

from collections.abc import Collection, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame

from batchlens.functions.dates import FORMATS, PIVOT
from batchlens.operators import eda, states
from batchlens.operators.batching import assign_batches
from batchlens.operators.checks import Guard
from batchlens.operators.profile import profile
from batchlens.operators.rules import MIN_RULES, mine_rules
from batchlens.session import configure, scratch_scope
from batchlens.sources.csvs import read_csvs
from batchlens.sources.warehouse import Saved, Warehouse


@dataclass(frozen=True)
class Updated:
    saved: Saved
    profiled: int
    mined: int


def seed(
    warehouse: Warehouse,
    csv_path: str,
    kinds: Mapping[str, str],
    time_column: str,
    *,
    multiline: bool = True,
    on_bad: str = "error",
    **saving,
) -> Saved:
    """Ingest a CSV folder: merge the files, type them, assign batches, store the new ones."""
    rows = read_csvs(configure(warehouse.spark), csv_path, kinds, multiline=multiline, on_bad=on_bad)
    return ingest(warehouse, rows, time_column, on_bad=on_bad, **saving)


def ingest(
    warehouse: Warehouse,
    df: DataFrame,
    time_column: str,
    *,
    formats: Sequence[str] = FORMATS,
    pivot: int = PIVOT,
    on_bad: str = "error",
    **saving,
) -> Saved:
    """Store the new batches of df. With on_bad='null' a date text that fits no format makes its row undated."""
    configure(warehouse.spark)
    return warehouse.save(assign_batches(df, time_column, formats=formats, pivot=pivot, on_bad=on_bad), **saving)


def backfill_dq(warehouse: Warehouse, kinds: Mapping[str, str], *, unknown: str = "error") -> int:
    """Profile all batches that lack quality records, together; returns their number."""
    todo = warehouse.pending_dq()
    if todo:
        warehouse.save_dq(profile(warehouse.raw(todo), kinds, unknown=unknown), len(todo))
    return len(todo)


def backfill_rules(
    warehouse: Warehouse,
    kinds: Mapping[str, str],
    exclude: Collection[str] = (),
    *,
    retry_empty: bool = True,
    **mining,
) -> int:
    """Mine all batches that lack rules, together; returns their number."""
    todo = warehouse.pending_rules(retry_empty)
    if todo:
        warehouse.save_rules(mine_rules(warehouse.raw(todo), kinds, exclude, **mining), todo)
    return len(todo)


def backfill_states(warehouse: Warehouse, kinds: Mapping[str, str], *, unknown: str = "error") -> int:
    """Count the values of all batches that lack their states, together; returns their number."""
    todo = warehouse.pending_states(kinds)
    if todo:
        rows = warehouse.raw(todo)
        own = eda.known(rows, kinds, unknown)
        warehouse.save_states(states.value_states(rows, own), states.pair_states(rows, own), own, todo)
    return len(todo)


def update(
    warehouse: Warehouse,
    source: DataFrame | str,
    kinds: Mapping[str, str],
    time_column: str,
    target: str | None = None,
    *,
    min_rules: int = MIN_RULES,
    late: str = "drop",
    unknown: str = "error",
    retry_empty: bool = True,
    formats: Sequence[str] = FORMATS,
    pivot: int = PIVOT,
    on_bad: str = "error",
    multiline: bool = True,
    guard: Guard | None = None,
    **mining,
) -> Updated:
    """Bring the warehouse up to date with a CSV folder or a DataFrame.

    Time and target columns are profiled but not mined. A run that died is completed by the next
    one, because every step takes the batches that still lack its result. formats, pivot and on_bad
    tell how dates are read, multiline and on_bad how CSV files are, guard which batches may be stored; further
    arguments go to the mining.
    Intermediate tables of the run are gone when it ends.
    """
    spark = configure(warehouse.spark)
    exclude = [time_column] if target is None else [time_column, target]
    mining["min_rules"] = min_rules
    with scratch_scope(spark):
        df = read_csvs(spark, source, kinds, multiline=multiline, on_bad=on_bad) if isinstance(source, str) else source
        saved = ingest(warehouse, df, time_column, formats=formats, pivot=pivot, on_bad=on_bad, late=late, guard=guard)
        profiled = backfill_dq(warehouse, kinds, unknown=unknown)
        mined = backfill_rules(warehouse, kinds, exclude, retry_empty=retry_empty, **mining)
    return Updated(saved, profiled, mined)
