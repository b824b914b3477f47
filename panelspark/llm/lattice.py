"""Near-duplicate vectors by lattice hashing.

Each of TABLES tables projects a unit vector by a random matrix to BLOCKS times eight dimensions and decodes every eight to
the nearest point of the E8 lattice; the points together are its home cell. It is also put into PROBES neighbouring cells:
those that one of the 240 shortest lattice vectors away from one of the points come next in distance. Vectors that meet in
a cell which is home to one of them are candidates; links are confirmed by the cosine in double precision.

Equal vectors are one class from the start. In a cell every member is first compared with the cell's hub; members of cells
that are then still of several components are compared in blocks inside a task, and only links that join components leave
it. Numbers of links are then counted once over the members of each component, in blocks again, so that a pair that met
in many cells counts once and no pair is ever a row.

Measured on random pairs (tests/llm): of pairs at a cosine of exactly 0.95 a table misses about 0.68, so all of 16 miss 2 of
1,000; at 0.97 fewer than 1 of 10,000. A cell's unlike members grow with the table; ``blocks=3`` suits billions of vectors.

Defined cases: vectors that are null, empty or zero, or hold null or non-finite components, link with nothing; vectors of
different lengths do not link; rows that repeat are vectors of their own (each other's links); a null id comes after every
id; ties cannot matter; an empty table gives no row; other columns are ignored.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelspark.llm._common import discard, process_cache, small_batches, stash
from panelspark.llm.grouping import connected_components

LEAST = 0.95
TABLES, BLOCKS, PROBES, SCALE = 16, 2, 4, 0.7
#: Vectors compared at a time on either side.
BLOCK = 1024
#: Members that are brought together in one task, about, where groups are small.
TOGETHER = 1 << 14
_NO_ID = 2**63 - 1


def _shortest() -> np.ndarray:
    """The 240 shortest vectors of the lattice."""
    pairs = [(i, j, s, t) for i, j in itertools.combinations(range(8), 2) for s in (1, -1) for t in (1, -1)]
    whole = np.zeros((len(pairs), 8))
    for k, (i, j, s, t) in enumerate(pairs):
        whole[k, [i, j]] = s, t
    half = np.array(list(itertools.product((0.5, -0.5), repeat=8)))
    return np.r_[whole, half[(half < 0).sum(axis=1) % 2 == 0]]


def _even_sum(x: np.ndarray) -> np.ndarray:
    """The nearest points of whole numbers with an even sum."""
    near = np.rint(x)
    odd = np.flatnonzero(near.sum(axis=1) % 2)
    worst = np.abs(x - near)[odd].argmax(axis=1)
    near[odd, worst] += np.where(x[odd, worst] > near[odd, worst], 1.0, -1.0)
    return near


def nearest(x: np.ndarray) -> np.ndarray:
    """The nearest points of E8: whole numbers, or all of them and a half, of even sum."""
    whole, half = _even_sum(x), _even_sum(x - 0.5) + 0.5
    return np.where((((x - whole) ** 2).sum(axis=1) <= ((x - half) ** 2).sum(axis=1))[:, None], whole, half)


class Cells:
    """Cells of unit vectors of ``dim`` components."""

    def __init__(self, dim: int, tables: int = TABLES, blocks: int = BLOCKS, probes: int = PROBES, scale: float = SCALE):
        rng = np.random.default_rng([13, dim])
        self.probes, self.blocks = probes, blocks
        self.project = rng.normal(size=(tables, dim, 8 * blocks)) * scale
        self.weights = rng.integers(1, 2**63, size=(8 * blocks), dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        self.salt = rng.integers(1, 2**63, size=tables, dtype=np.uint64)
        self.moves = _shortest()

    def _hash(self, doubled: np.ndarray, table: int) -> np.ndarray:
        x = (doubled.astype(np.int64).astype(np.uint64) * self.weights).sum(axis=-1, dtype=np.uint64) + self.salt[table]
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return (x ^ (x >> np.uint64(31))).view(np.int64)

    def of(self, unit: np.ndarray) -> np.ndarray:
        """(vector, table, place): the home cell first, then the neighbouring ones."""
        n = len(unit)
        out = np.empty((n, len(self.project), 1 + self.probes), np.int64)
        for t, matrix in enumerate(self.project):
            x = (unit @ matrix).reshape(n * self.blocks, 8)
            home = nearest(x)
            farther = (2 - 2 * (x - home) @ self.moves.T).reshape(n, -1)  # squared distance of the neighbour less that of home
            by = np.argpartition(farther, self.probes, axis=1)[:, : self.probes]
            home = home.reshape(n, self.blocks * 8)
            out[:, t, 0] = self._hash(2 * home, t)
            block, move = by // len(self.moves), by % len(self.moves)
            for k in range(self.probes):
                moved = home.reshape(n, self.blocks, 8).copy()
                moved[np.arange(n), block[:, k]] += self.moves[move[:, k]]
                out[:, t, 1 + k] = self._hash(2 * moved.reshape(n, -1), t)
        return out


def _matrix(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """Unit vectors of a list column; all lists have one length."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    x = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _cells(classes: DataFrame, tables: int, blocks: int, probes: int, scale: float) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            length = b["vector"].value_lengths().to_numpy(zero_copy_only=False)
            for dim in np.unique(length):
                part = b.filter(pa.array(length == dim))
                cells = process_cache(f"cells {dim} {tables} {blocks} {probes} {scale}", lambda d=int(dim): Cells(d, tables, blocks, probes, scale))
                found = cells.of(_matrix(part["vector"])).reshape(part.num_rows, -1)
                lists = pa.ListArray.from_arrays(pa.array(np.arange(part.num_rows + 1, dtype=np.int32) * found.shape[1]), pa.array(found.ravel()))
                yield pa.RecordBatch.from_arrays([part["node"], lists], names=["node", "cells"])

    found = classes.select("node", "vector").mapInArrow(run, "node long, cells array<long>")
    placed = found.select("node", F.posexplode("cells").alias("place", "cell"))
    return placed.select("cell", F.col("node").alias("id"), (F.col("place") % (1 + probes) != 0).cast("int").alias("probe"))


def _confirm(pairs: DataFrame, classes: DataFrame, least: float) -> DataFrame:
    """Of pairs (a, b) those that are linked."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            a_n, b_n = (b[c].value_lengths().to_numpy(zero_copy_only=False) for c in ("va", "vb"))
            for dim in np.unique(a_n[a_n == b_n]):
                part = b.filter(pa.array((a_n == dim) & (b_n == dim)))
                linked = (_matrix(part["va"]) * _matrix(part["vb"])).sum(axis=1) >= least
                yield part.select(["a", "b"]).filter(pa.array(linked))

    with_a = pairs.join(classes.select(F.col("node").alias("a"), F.col("vector").alias("va")), "a")
    with_b = with_a.join(classes.select(F.col("node").alias("b"), F.col("vector").alias("vb")), "b")
    return with_b.select("a", "b", "va", "vb").mapInArrow(run, "a long, b long")


def _in_blocks(members: DataFrame, group: str, sizes: DataFrame, parts: int) -> DataFrame:
    """``members`` with (task, lo, hi, side): every two blocks of a group meet in one task; small groups share tasks.

    ``sizes``: (group, n), n being the number of members of the group.
    """
    dealt = members.join(sizes, group).withColumn("blocks", F.ceil(F.col("n") / BLOCK).cast("int"))
    dealt = dealt.withColumn("side", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    dealt = dealt.withColumn("lo", F.least("side", "other")).withColumn("hi", F.greatest("side", "other"))
    alone = F.xxhash64(group, "lo", "hi")
    return dealt.withColumn("task", F.when(F.col("blocks") == 1, F.pmod(F.xxhash64(group), F.lit(parts))).otherwise(alone)).drop("n", "blocks", "other")


def _block_pairs(table: pa.Table, group: str, least: float) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For each group and pair of blocks of a task: rows of its members on either side and which of them are linked (a pair
    once)."""
    key = np.stack([table[c].to_numpy() for c in (group, "lo", "hi")])
    length = pa.compute.list_value_length(table["vector"]).to_numpy()
    order = np.lexsort((length, *key[::-1]))
    apart = np.flatnonzero(np.r_[True, (np.diff(key[:, order]) != 0).any(axis=0) | (np.diff(length[order]) != 0)])
    side = table["side"].to_numpy()
    for lo, hi in zip(apart, [*apart[1:], len(order)], strict=True):
        rows = order[lo:hi]
        if len(rows) < 2:
            continue
        unit = _matrix(table["vector"].take(pa.array(rows)))
        first, second = key[1][rows[0]], key[2][rows[0]]
        left, right = np.flatnonzero(side[rows] == first), np.flatnonzero(side[rows] == second)
        linked = unit[left] @ unit[right].T >= least
        if first == second:
            linked = np.triu(linked, 1)
        yield rows[left], rows[right], linked


def _joins(least: float):
    """Links between members of different components, as few as join what is linked in a group."""

    def run(table: pa.Table) -> pa.Table:
        ids, own, root, out = table["id"].to_numpy(), table["component"].to_numpy(), {}, []

        def find(c: int) -> int:
            while root.setdefault(c, c) != c:
                root[c] = root[root[c]]
                c = root[c]
            return c

        for left, right, linked in _block_pairs(table, "cell", least):
            linked = linked & (own[left][:, None] != own[right][None, :])
            for i, j in np.argwhere(linked):
                x, y = find(int(own[left[i]])), find(int(own[right[j]]))
                if x != y:
                    root[x] = y
                    out.append((int(ids[left[i]]), int(ids[right[j]])))
        return pa.table({"a": pa.array([a for a, _ in out], pa.int64()), "b": pa.array([b for _, b in out], pa.int64())})

    return run


def _tally(least: float):
    """Of each member of a component how many vectors (``copies`` of each member) it is linked with."""

    def run(table: pa.Table) -> pa.Table:
        copies, n = table["copies"].to_numpy(), np.zeros(table.num_rows, np.int64)
        for left, right, linked in _block_pairs(table, "component", least):
            n[left] += linked @ copies[right]
            n[right] += copies[left] @ linked
        return pa.table({"id": table["id"], "n": pa.array(n)})

    return run


def near_vectors(vectors: DataFrame, least: float = LEAST, tables: int = TABLES, blocks: int = BLOCKS, probes: int = PROBES, scale: float = SCALE) -> DataFrame:
    """vec_id, n_links, component_id (smallest id that links reach), kept for every row of ``vectors`` (vec_id, embedding)."""
    spark = vectors.sparkSession
    small_batches(spark)
    rows = vectors.select(F.coalesce(F.col("vec_id").cast("long"), F.lit(_NO_ID)).alias("vec_id"), F.col("embedding").cast("array<double>").alias("vector"))
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    usable = F.coalesce(finite & F.exists("vector", lambda x: x != 0), F.lit(False))
    rows = rows.withColumn("vector", F.when(usable, F.col("vector")))
    classes = rows.filter("vector is not null").groupBy("vector").agg(F.count("*").alias("copies"), F.min("vec_id").alias("first"))
    classes = stash(classes.withColumn("node", F.monotonically_increasing_id()), "vector-classes")
    placed = stash(_cells(classes, tables, blocks, probes, scale), "vector-cells")
    # A cell counts if it is home to one of at least two members; its hub is the first of those at home.
    hubs = placed.groupBy("cell").agg(F.count("*").alias("n"), F.min(F.struct("probe", "id")).alias("hub")).filter("n > 1 and hub.probe = 0")
    hubs = stash(hubs.select("cell", "n", F.col("hub.id").alias("hub")), "vector-hubs")
    met = stash(placed.join(hubs, "cell").select("cell", "id", "hub", "n"), "vector-meetings")
    pairs = met.filter("id <> hub").select(F.least("id", "hub").alias("a"), F.greatest("id", "hub").alias("b")).distinct()
    links = stash(_confirm(pairs, classes, least), "vector-links")
    found = stash(connected_components(links), "vector-components")
    # Cells of more than two members that are still of several components.
    held = stash(met.filter("n > 2").join(found, "id", "left").select("cell", "id", "n", F.coalesce("component", "id").alias("component")), "vector-held")
    mixed = stash(held.groupBy("cell").agg(F.min("component").alias("x"), F.max("component").alias("y"), F.count("*").alias("n")).filter("x <> y").select("cell", "n"), "vector-mixed")
    parts = lambda df: max(1, df.count() // TOGETHER)
    vector = classes.select(F.col("node").alias("id"), "vector")
    open_cells = held.select("cell", "id", "component").join(mixed.select("cell"), "cell", "left_semi")
    dealt = _in_blocks(open_cells, "cell", mixed, parts(open_cells)).join(vector, "id")
    more = stash(dealt.groupBy("task").applyInArrow(_joins(least), "a long, b long"), "vector-links")
    whole = stash(connected_components(links.unionByName(more)), "vector-components")
    discard(spark, placed, hubs, met, links, found, held, mixed, more)
    sizes = whole.groupBy("component").agg(F.count("*").alias("n"))
    weighed = _in_blocks(whole, "component", sizes, parts(whole)).join(classes.select(F.col("node").alias("id"), "vector", "copies"), "id")
    linked = weighed.groupBy("task").applyInArrow(_tally(least), "id long, n long").groupBy("id").agg(F.sum("n").alias("n"))
    of_node = whole.join(linked, "id").join(classes.select(F.col("node").alias("id"), "first"), "id")
    lead = of_node.groupBy("component").agg(F.min("first").alias("lead"))
    of_node = stash(of_node.join(lead, "component").select(F.col("id").alias("node"), "n", "lead"), "vector-nodes")
    of_class = classes.join(of_node, "node", "left").select("vector", (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("lead", "first").alias("lead"))
    # Rows of one vector, however many, meet one row of the right side.
    linked = rows.filter("vector is not null").join(of_class, "vector").select("vec_id", "n_links", F.col("lead").alias("component_id"))
    out = linked.unionByName(rows.filter("vector is null").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id")))
    real = lambda c: F.when(F.col(c) != _NO_ID, F.col(c)).alias(c)
    return out.select(real("vec_id"), "n_links", real("component_id"), (F.col("vec_id") == F.col("component_id")).alias("kept"))
