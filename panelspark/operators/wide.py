"""Panels through the numpy rules of ``grid``: one shuffle by entity, many entities at a time, no window in Spark.

The rows of a partition come in the order of entities and days and are laid out as days by entities, a block of entities of
bounded size at a time; an entity has as many rows as there are dates. With slots a block has every day of the calendar, so
days between an entity's rows exist in the block only. Ranks among the values of a date take two narrow shuffles: the values
to their dates, in packed rows, and the ranks back to their entities, where everything else is computed.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelspark.expr import Expr
from panelspark.operators import grid

#: Cells of a block, of eight bytes in each array.
CELLS = 1 << 17


def _floats(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    return np.array(column.cast(pa.float64()).to_numpy(zero_copy_only=False), dtype=float)


def _entities(batches: Iterator[pa.RecordBatch], days: int | None) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Tables of whole entities and the first row of each, with at most about CELLS cells (or one entity)."""
    held: list[pa.Table] = []
    rows = 0

    def cut(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
        starts = np.flatnonzero(np.asarray(table["_row"]) == 1)
        return starts, np.diff(np.r_[starts, table.num_rows])

    def blocks(table: pa.Table, starts: np.ndarray, sizes: np.ndarray) -> Iterator[tuple[pa.Table, np.ndarray]]:
        begin = 0
        while begin < len(starts):
            longest = np.maximum.accumulate(np.full(len(starts) - begin, days) if days else sizes[begin:])
            wide = longest * np.arange(1, len(longest) + 1)
            # A long series among short ones would leave most cells empty.
            end = begin + max(1, int(np.searchsorted(wide > np.minimum(CELLS, 65536 + 4 * np.cumsum(longest)), True)))
            last = starts[end] if end < len(starts) else table.num_rows
            yield table.slice(starts[begin], last - starts[begin]), starts[begin:end] - starts[begin]
            begin = end

    for batch in batches:
        if batch.num_rows:
            held.append(pa.Table.from_batches([batch]))
            rows += batch.num_rows
        if rows * (4 if days else 1) >= CELLS:
            table = pa.concat_tables(held).combine_chunks()
            starts, sizes = cut(table)
            if len(starts) > 1:
                yield from blocks(table.slice(0, starts[-1]), starts[:-1], sizes[:-1])
                table = table.slice(starts[-1])
            held, rows = [table], table.num_rows
    if rows:
        table = pa.concat_tables(held).combine_chunks()
        yield from blocks(table, *cut(table))


def _laid(table: pa.Table, starts: np.ndarray, slots: bool, days: int | None, own: np.ndarray) -> tuple[np.ndarray, np.ndarray, tuple[int, int]]:
    """Day and entity of the block's cells that stand for its rows ``own``, and the block's shape."""
    entity = np.repeat(np.arange(len(starts)), np.diff(np.r_[starts, table.num_rows]))[own]
    if slots:
        return np.asarray(table["slot"])[own] - 1, entity, (days, len(starts))
    first = np.r_[0, np.flatnonzero(np.diff(entity)) + 1]
    day = np.arange(len(entity)) - first[entity]
    return day, entity, (int(day.max()) + 1, len(starts))


def _spread(table: pa.Table, names: list[str], own: np.ndarray, at: tuple[np.ndarray, np.ndarray], shape: tuple[int, int]) -> dict[str, np.ndarray]:
    out = {}
    for n in names:
        out[n] = np.full(shape, np.nan)
        out[n][at] = _floats(table[n])[own]
    return out


def _in_order(df: DataFrame, *order: str) -> DataFrame:
    """The row's number in its entity: this asks for whole entities in order, and shuffles only what does not lie so already."""
    return df.withColumn("_row", F.row_number().over(Window.partitionBy("entity").orderBy(*order)))


def _run(slots: bool, work: Callable[[pa.Table, np.ndarray, int | None], Iterator[pa.RecordBatch]]) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = next(batches, None)
        while first is not None and not first.num_rows:
            first = next(batches, None)
        if first is None:
            return
        days = int(first.column("_days")[0].as_py()) if slots else None

        def all_of_them() -> Iterator[pa.RecordBatch]:
            yield first
            yield from batches

        for table, starts in _entities(all_of_them(), days):
            yield from work(table, starts, days)

    return run


def _date_ranks(panel: DataFrame, day: str, exprs: dict[str, Expr], slots: bool) -> DataFrame:
    """(entity, day, one column for each expression): its average-tie share among the values of the day of all entities."""
    names, kind = list(exprs), panel.schema["entity"].dataType
    made_of = grid.Program(exprs)
    measures = made_of.measures
    key = panel.schema[day].dataType
    packed = T.StructType([T.StructField("day", key), T.StructField("entity", T.ArrayType(kind)), *(T.StructField(f"{p}_{n}", T.ArrayType(T.DoubleType())) for n in names for p in ("own", "all"))])

    def pack(table: pa.Table, starts: np.ndarray, days: int | None) -> Iterator[pa.RecordBatch]:
        """A row for each day: the entities that have a row on it, their values, and (with slots) the values of the others."""
        own = np.arange(table.num_rows)
        *at, shape = _laid(table, starts, slots, days, own)
        here = np.zeros(shape, bool)
        here[tuple(at)] = True
        values = made_of.run(_spread(table, measures, own, tuple(at), shape), there=None if slots else here)
        # Days are dates of the calendar: rows in their order, whatever their place in the entity.
        by_day = table[day].combine_chunks() if isinstance(table[day], pa.ChunkedArray) else table[day]
        order = np.asarray(pc.sort_indices(by_day))
        sorted_days = by_day.take(pa.array(order))
        coded = np.asarray(sorted_days.cast(pa.int32())) if not slots else np.asarray(sorted_days)
        first = np.r_[0, np.flatnonzero(np.diff(coded)) + 1]
        offsets = pa.array(np.r_[first, len(coded)], pa.int32())
        present = coded[first]
        columns = {"entity": pa.ListArray.from_arrays(offsets, table["entity"].combine_chunks().take(pa.array(order)))}
        for n in names:
            v = values[n][tuple(at)][order]
            columns[f"own_{n}"] = pa.ListArray.from_arrays(offsets, pa.array(v))
        made = {"day": sorted_days.take(pa.array(first)), **columns}
        rest: dict[str, pa.Array] = {}
        if slots:
            # Every day of the calendar has values, also where no entity of the block has a row.
            missing = np.setdiff1d(np.arange(1, days + 1), present)
            others = np.r_[present, missing] - 1
            made["day"] = pa.concat_arrays([made["day"], pa.array(missing, made["day"].type)])
            empty = pa.array(np.r_[np.asarray(offsets), np.full(len(missing), len(coded))], pa.int32())
            for c in columns:
                made[c] = pa.ListArray.from_arrays(empty, columns[c].values)
            for n in names:
                v = np.where(here, np.nan, values[n])[others]
                ok = ~np.isnan(v)
                rest[n] = pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(ok.sum(axis=1))], pa.int32()), pa.array(v[ok]))
        else:
            for n in names:
                rest[n] = pa.ListArray.from_arrays(pa.array(np.zeros(len(first) + 1), pa.int32()), pa.array([], pa.float64()))
        made |= {f"all_{n}": rest[n] for n in names}
        yield pa.RecordBatch.from_arrays([made[f.name] for f in packed], [f.name for f in packed])

    placed = _in_order(panel.select("entity", day, *(["_days"] if slots else []), *(m for m in measures)), day)
    by_date = placed.mapInArrow(_run(slots, pack), packed)
    numbered = by_date.withColumn("_part", F.row_number().over(Window.partitionBy("day").orderBy(F.lit(0))))
    ranked = T.StructType([T.StructField("entity", kind), T.StructField(day, key), *(T.StructField(n, T.DoubleType()) for n in names)])

    def rank(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The packed rows of one day after another."""
        held: list[pa.RecordBatch] = []

        def of_day() -> Iterator[pa.RecordBatch]:
            table = pa.Table.from_batches(held)
            entity = pa.concat_arrays([c.flatten() for c in table["entity"].chunks])
            if not len(entity):
                return
            out = [entity, pa.concat_arrays([table["day"].chunk(0).slice(0, 1)]).take(pa.array(np.zeros(len(entity), np.int64)))]
            for n in names:
                own, others = (np.concatenate([_floats(c.flatten()) for c in table[f"{p}_{n}"].chunks]) for p in ("own", "all"))
                v = np.sort(np.r_[own[~np.isnan(own)], others])
                below, upto = np.searchsorted(v, own, "left"), np.searchsorted(v, own, "right")
                share = (below + 1 + (upto - below - 1) / 2) / max(len(v), 1)
                out.append(pa.array(share, mask=np.isnan(own)))
            whole = pa.RecordBatch.from_arrays(out, ranked.names)
            for k in range(0, whole.num_rows, 10_000):
                yield whole.slice(k, 10_000)

        for batch in batches:
            starts = np.flatnonzero(np.asarray(batch.column("_part")) == 1)
            for begin, end in zip(np.r_[0, starts], np.r_[starts, batch.num_rows], strict=True):
                if begin in starts and held:
                    yield from of_day()
                    held = []
                if end > begin:
                    held.append(batch.slice(begin, end - begin))
        if held:
            yield from of_day()

    return numbered.mapInArrow(rank, ranked)


def evaluate_wide(panel: DataFrame, program: grid.Program, days: DataFrame | None = None) -> DataFrame:
    """entity, dt and one column for each expression of the program, an entity having one row a day.

    With ``days`` (dt, slot), a calendar, windows count its days and not the entity's rows.
    """
    slots, day = days is not None, "dt" if days is None else "slot"
    if slots:
        # As many rows as there are dates.
        panel = panel.join(F.broadcast(days), "dt").withColumn("_days", days.agg(F.max("slot")).scalar())
    measures, names, ranks = program.measures, list(program.outputs), list(program.ranks)
    keep = ["entity", "dt", *(["slot", "_days"] if slots else [])]
    rows = panel.select(*keep, *measures)
    if ranks:
        found = _date_ranks(panel, day, program.ranks, slots)
        none: Column = F.lit(None)
        mine = rows.select(*rows.columns, *(none.cast("double").alias(n) for n in ranks), F.lit(False).alias("_rank"))
        theirs = [F.col(c) if c in (day, "entity", *ranks) else F.lit(True) if c == "_rank" else none.cast(mine.schema[c].dataType) for c in mine.columns]
        theirs = [c.alias(n) for c, n in zip(theirs, mine.columns, strict=True)]
        # A rank follows its row.
        rows = _in_order(mine.union(found.select(*theirs)), day, "_rank")
    else:
        rows = _in_order(rows, day)
    out = T.StructType([panel.schema["entity"], panel.schema["dt"], *(T.StructField(n, T.DoubleType()) for n in names)])

    def work(table: pa.Table, starts: np.ndarray, total: int | None) -> Iterator[pa.RecordBatch]:
        own = np.flatnonzero(np.asarray(table["_rank"].cast(pa.int8())) == 0) if ranks else np.arange(table.num_rows)
        *at, shape = _laid(table, starts, slots, total, own)
        at = tuple(at)
        given = {n: np.full(shape, np.nan) for n in ranks}
        for n in ranks:
            given[n][at] = _floats(table[n])[own + 1]
        there = None if slots else np.zeros(shape, bool)
        if not slots:
            there[at] = True
        found = program.run(_spread(table, measures, own, at, shape), given, there)
        columns = [table[c].combine_chunks().take(pa.array(own)) for c in ("entity", "dt")]
        for n in names:
            v = found[n][at]
            columns.append(pa.array(v, mask=np.isnan(v)))
        whole = pa.RecordBatch.from_arrays(columns, out.names)
        for k in range(0, whole.num_rows, 10_000):
            yield whole.slice(k, 10_000)

    return rows.mapInArrow(_run(slots, work), out)
