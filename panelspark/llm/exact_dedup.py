"""Exact dedup with a log-structured merge index over text digests.

Memtables collapse the digests of a task's rows and flush sorted runs, each with a Bloom filter, cut by digest shard. A
large index has levels: a level cuts by ``RADIX`` shards only, merges the runs of a shard that so many tasks flushed, and
cuts them again for the next level, so runs stay long and their number grows with the rows alone.
Compaction merges the runs of a shard in tiers of ``FANOUT``: rows that no other run's filter claims pass through, the
rest are merged, and of equal digests the best row (longest original text, then smallest id) stays. Every hit is then
verified: its normalised bytes are compared with those of the row that stays; should two texts share a digest, the rows
of that digest are regrouped by their text itself.

Defined cases: a null text counts as empty; all empty texts are one group; a null id sorts after every id; repeated rows
count as copies; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelspark.llm._common import key_filter, only_maybe, parallelism, small_batches, stash

#: Rows that a memtable holds before it is flushed as sorted runs.
MEMTABLE_ROWS = 1 << 17
#: Digests of one shard of the index, about: bounds the memory of a compaction task.
SHARD_ROWS = 400_000
#: Runs merged at a time.
FANOUT = 8
#: Shards that a level of the index is cut into, and tasks whose runs one group of the level merges.
RADIX = 64
#: Bits of a filter for each digest, and bits set for each.
FILTER_BITS_PER_KEY, FILTER_PROBES = 12, 4
NO_ID = np.iinfo(np.int64).max

WHITE_SPACE = r"[\x20\x09-\x0D]+"
RUN_SCHEMA = "shard long, task long, digests binary, ids binary, chars binary, copies binary, filter binary"
INDEX_SCHEMA = "digest binary, keep_id long, group_size long"


def _words(digests: np.ndarray) -> np.ndarray:
    """Two 64-bit words of each digest (of a fixed-width byte string), for the filters."""
    width = digests.dtype.itemsize
    raw = np.zeros((len(digests), 16), np.uint8)
    raw[:, : min(16, width)] = digests.view(np.uint8).reshape(len(digests), width)[:, :16]
    return raw.view(np.uint64)


class RunFilter:
    """Bloom filter of a sorted run; its size is a power of two."""

    def __init__(self, bits: np.ndarray):
        self.bits = bits

    @staticmethod
    def _slots(digests: np.ndarray, size: int) -> Iterator[np.ndarray]:
        w = _words(digests)
        step = w[:, 1] | np.uint64(1)
        for k in range(FILTER_PROBES):
            yield (w[:, 0] + np.uint64(k) * step) >> np.uint64(7) & np.uint64(size - 1)

    @classmethod
    def of(cls, digests: np.ndarray) -> RunFilter:
        size = 64
        while size < FILTER_BITS_PER_KEY * len(digests):
            size *= 2
        on = np.zeros(size, bool)
        for s in cls._slots(digests, size):
            on[s.astype(np.int64)] = True
        return cls(np.packbits(on, bitorder="little"))

    def may_have(self, digests: np.ndarray) -> np.ndarray:
        found = np.ones(len(digests), bool)
        for s in self._slots(digests, len(self.bits) * 8):
            s = s.astype(np.int64)
            found &= (self.bits[s >> 3] >> (s & 7).astype(np.uint8) & 1).astype(bool)
        return found


def collapse(digests: np.ndarray, ids: np.ndarray, chars: np.ndarray, copies: np.ndarray) -> tuple[np.ndarray, ...]:
    """Sorted by digest, one row each: the longest text, then the smallest id, and the sum of the copies."""
    order = np.lexsort((ids, -chars, digests))
    digests, ids, chars, copies = digests[order], ids[order], chars[order], copies[order]
    if not len(digests):
        return digests, ids, chars, copies
    first = np.flatnonzero(np.r_[True, digests[1:] != digests[:-1]])
    return digests[first], ids[first], chars[first], np.add.reduceat(copies, first)


def _cut(cols: tuple[np.ndarray, ...], task: int, shards: int, total: int) -> pa.RecordBatch:
    """Rows of RUN_SCHEMA: the sorted run cut into ``shards`` of ``total`` digest classes."""
    shard = (_words(cols[0])[:, 0] % np.uint64(total)).astype(np.int64) * shards // total
    out: dict[str, list] = {k: [] for k in ("shard", "task", "digests", "ids", "chars", "copies", "filter")}
    order = np.argsort(shard, kind="stable")
    for own in np.split(order, np.flatnonzero(np.diff(shard[order])) + 1) if len(order) else []:
        part = [c[own] for c in cols]
        for name, x in zip(("digests", "ids", "chars", "copies"), part, strict=True):
            out[name].append(x.tobytes())
        out["filter"].append(RunFilter.of(part[0]).bits.tobytes())
        out["shard"].append(int(shard[own[0]]))
        out["task"].append(task)
    return pa.RecordBatch.from_arrays([pa.array(out["shard"], pa.int64()), pa.array(out["task"], pa.int64()), *(pa.array(out[k], pa.binary()) for k in list(out)[2:])], names=list(out))


def flush_memtables(shards: int, total: int, width: int):
    """For mapInArrow: rows (digest, doc_id, chars) in, one row for each sorted run and shard out."""

    def flush(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        t = pa.Table.from_batches(held)
        digests = np.frombuffer(b"".join(t["digest"].to_pylist()), f"S{width}")
        ids = t["doc_id"].fill_null(NO_ID).to_numpy()
        cols = collapse(digests, ids, t["chars"].to_numpy().astype(np.int64), np.ones(len(ids), np.int64))
        return _cut(cols, TaskContext.get().partitionId(), shards, total)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows = [], 0
        for b in batches:
            if not b.num_rows:
                continue
            held.append(b)
            rows += b.num_rows
            if rows >= MEMTABLE_ROWS:
                yield flush(held)
                held, rows = [], 0
        if held:
            yield flush(held)

    return run


def merge_runs(runs: list[tuple[tuple[np.ndarray, ...], RunFilter]]) -> tuple[tuple[np.ndarray, ...], RunFilter]:
    """One run of several: only rows that another run's filter claims are compared."""
    alone, met = [], []
    for k, (cols, _) in enumerate(runs):
        claimed = np.zeros(len(cols[0]), bool)
        for j, (_, f) in enumerate(runs):
            if j != k:
                rest = np.flatnonzero(~claimed)
                claimed[rest] = f.may_have(cols[0][rest])
        alone.append([c[~claimed] for c in cols])
        met.append([c[claimed] for c in cols])
    merged = collapse(*(np.concatenate(x) for x in zip(*met, strict=True)))
    cols = [np.concatenate(x) for x in zip(merged, *alone, strict=True)]
    order = np.argsort(cols[0], kind="stable")
    cols = tuple(c[order] for c in cols)
    return cols, RunFilter.of(cols[0])


def _merged(table: pa.Table, width: int) -> tuple[np.ndarray, ...]:
    """One run of all runs of a group: tiers of runs become one; smallest identifiers stay."""
    runs = []
    for row in table.to_pylist():
        cols = (np.frombuffer(row["digests"], f"S{width}"), *(np.frombuffer(row[k], np.int64) for k in ("ids", "chars", "copies")))
        runs.append((cols, RunFilter(np.frombuffer(row["filter"], np.uint8))))
    while len(runs) > 1:
        runs = [merge_runs(runs[k : k + FANOUT]) if len(runs[k : k + FANOUT]) > 1 else runs[k] for k in range(0, len(runs), FANOUT)]
    return runs[0][0]


def compact(width: int):
    """For applyInArrow over a shard of the last level: its part of the index."""

    def run(table: pa.Table) -> pa.Table:
        digests, ids, _, copies = _merged(table, width)
        raw = pa.FixedSizeBinaryArray.from_buffers(pa.binary(width), len(digests), [None, pa.py_buffer(np.ascontiguousarray(digests).tobytes())])
        keep = pa.array(ids, mask=ids == NO_ID)
        return pa.table({"digest": raw.cast(pa.binary()), "keep_id": keep, "group_size": pa.array(copies)})

    return run


def descend(shards: int, total: int, width: int):
    """For applyInArrow over the runs that RADIX tasks flushed for a shard: one run, cut for the next level."""

    def run(table: pa.Table) -> pa.Table:
        return pa.Table.from_batches([_cut(_merged(table, width), table["task"][0].as_py() // RADIX, shards, total)])

    return run


def _normalised(docs: DataFrame) -> DataFrame:
    """doc_id, chars (code points of the original text), norm."""
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.char_length(text).cast("long").alias("chars"), F.regexp_replace(text, WHITE_SPACE, "").alias("norm"))


def digest_entries(docs: DataFrame) -> DataFrame:
    """doc_id, chars and the SHA-256 of the normalised text of every row."""
    return _normalised(docs).select("doc_id", "chars", F.unhex(F.sha2("norm", 256)).alias("sha"))


def lsm_index(entries: DataFrame, digest_bytes: int = 32) -> DataFrame:
    """(digest, keep_id, group_size) of all entries; a digest that many rows share leaves each task as one row."""
    total = max(parallelism(entries.sparkSession), -(-entries.count() // SHARD_ROWS))
    steps = [total]  # shards of each level, the last first
    while steps[-1] > RADIX:
        steps.append(-(-steps[-1] // RADIX))
    first, *deeper = reversed(steps)
    runs = entries.select("digest", "doc_id", "chars").mapInArrow(flush_memtables(first, total, digest_bytes), RUN_SCHEMA)
    for shards in deeper:
        runs = runs.groupBy("shard", F.expr(f"task div {RADIX}")).applyInArrow(descend(shards, total, digest_bytes), RUN_SCHEMA)
    return runs.groupBy("shard").applyInArrow(compact(digest_bytes), INDEX_SCHEMA)


def exact_dedup(docs: DataFrame, digest_bytes: int = 32) -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256 (of the normalised text).

    ``digest_bytes``: bytes of the SHA-256 that key the index; fewer only to exercise the verification.
    """
    small_batches(docs.sparkSession, 20_000)
    entries = stash(digest_entries(docs), "lsm-entries").withColumn("digest", F.substring("sha", 1, digest_bytes))
    index = stash(lsm_index(entries, digest_bytes), "lsm-index")
    member = entries.join(index, "digest").select("doc_id", "keep_id", "group_size", "sha", "digest")
    clash = stash(clashing(docs, index.filter("group_size > 1").select("digest"), digest_bytes), "lsm-clash")
    if not clash.isEmpty():
        member = _regrouped(docs, member, clash, digest_bytes)
    return member.select("doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), F.lower(F.hex("sha")).alias("text_sha256"))


def clashing(docs: DataFrame, hits: DataFrame, digest_bytes: int) -> DataFrame:
    """Digests of ``hits`` that stand for more than one normalised text: the bytes of all hits are compared.

    Only texts whose digest may be a hit are moved, and equal ones leave a task once.
    """
    rows = _normalised(docs).select("norm", F.substring(F.unhex(F.sha2("norm", 256)), 1, digest_bytes).alias("digest"))
    texts = only_maybe(rows, "digest", key_filter(hits, "digest", hits.count())).select("digest", "norm").distinct()
    return texts.groupBy("digest").agg(F.count("*").alias("texts")).filter("texts > 1").select("digest")


def _regrouped(docs: DataFrame, member: DataFrame, clash: DataFrame, digest_bytes: int) -> DataFrame:
    """``member`` with the rows of clashing digests grouped by their whole normalised text."""
    rows = _normalised(docs).withColumn("sha", F.unhex(F.sha2("norm", 256))).withColumn("digest", F.substring("sha", 1, digest_bytes)).join(clash, "digest", "left_semi")
    best = rows.groupBy("norm").agg(F.min(F.struct((-F.col("chars")).alias("c"), F.coalesce("doc_id", F.lit(int(NO_ID))).alias("id"))).alias("b"), F.count("*").alias("group_size"))
    best = best.select("norm", F.when(F.col("b.id") != int(NO_ID), F.col("b.id")).alias("keep_id"), "group_size")
    again = rows.join(best, "norm").select("doc_id", "keep_id", "group_size", "sha", "digest")
    return member.join(clash, "digest", "left_anti").unionByName(again)
