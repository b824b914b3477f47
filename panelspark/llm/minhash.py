"""MinHash near-dedup with circulant permutations.

A document's set is its distinct shingles of five words. Two permutations give a whole signature: the first spreads the
shingles over the slots 0..D-1, the second ranks the slots; coordinate k is the smallest rank of the set's slots when the
second permutation is shifted circularly by k. Bands of coordinates are the buckets of candidates; every link is then
confirmed on the full sets. Documents with equal sets are one class from the start, so a group of copies is one row in
the buckets.

Defined cases: null or empty text, or text without words, has no shingle and is linked with nothing; fewer words than five
are one shingle; texts of any length are used whole; a document is an id (null or not) with the hash of its text: rows that
repeat both are one document, rows that repeat an id with another text are another; a null id comes after every id, and of
equal ids the smaller hash comes first; an empty table gives no row.

With ``BANDS`` bands of ``ROWS`` coordinates that were independent a link of similarity 0.75 would escape all buckets with
probability (1 - 0.75**5)**45 < 5.1e-6, and links above it with less. Circulant coordinates come from one permutation;
tests/llm measures the share of band misses on planted pairs. Candidates that share a bucket are all decided on their full sets.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelspark.llm._common import discard, key_filter, maybe_among, only_maybe, process_cache, small_batches, stash
from panelspark.llm.grouping import link_buckets

WORDS, LEAST_PERCENT = 5, 75
ROWS, BANDS = 5, 45
SLOT_BITS = 20
CACHE_WORDS = 250_000
_NO_ID = 2**63 - 1
#: Key of a document: its id (a null one last) and a hash of its text.
_KEY = ["_id", "_th"]
_MIX = np.array([0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F], np.uint64)


def _mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads them."""
    x = (x ^ (x >> np.uint64(30))) * _MIX[1]
    x = (x ^ (x >> np.uint64(27))) * _MIX[2]
    return x ^ (x >> np.uint64(31))


def shingler():
    """Text to its sorted distinct shingles, as 64-bit hashes of the lower-cased (A-Z) words."""

    class Hashes(dict):
        def __missing__(self, word: bytes) -> int:
            if len(self) >= CACHE_WORDS:
                self.clear()
            h = self[word] = int.from_bytes(hashlib.blake2b(word, digest_size=8).digest(), "little")
            return h

    known = Hashes()

    def shingles(text: str | None) -> np.ndarray:
        words = (text or "").encode().lower().split()
        if not words:
            return np.zeros(0, np.uint64)
        h = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
        k = min(WORDS, len(h))
        out = np.full(len(h) - k + 1, np.uint64(k))
        for j in range(k):
            out = _mixed(out * _MIX[0] + h[j : len(h) - k + 1 + j])
        return np.unique(out)

    return shingles


class Circulant:
    """Bucket keys of shingle sets by two permutations of the slots."""

    def __init__(self) -> None:
        slots = 1 << SLOT_BITS
        rank = np.random.default_rng(20).permutation(slots).astype(np.int32)
        coordinates = ROWS * BANDS
        self.shifted = np.lib.stride_tricks.sliding_window_view(np.r_[rank, rank[:coordinates]], coordinates)  # row s: ranks of s, s+1, ...
        self.salt = _mixed(np.arange(1, BANDS + 1, dtype=np.uint64) * _MIX[3])

    def keys(self, shingles: np.ndarray) -> np.ndarray:
        """Bucket keys."""
        slot = np.unique((_mixed(shingles * _MIX[4]) >> np.uint64(64 - SLOT_BITS)).astype(np.int64))
        signature = self.shifted[slot[:256]].min(axis=0)
        for at in range(256, len(slot), 256):
            signature = np.minimum(signature, self.shifted[slot[at : at + 256]].min(axis=0))
        key = self.salt.copy()
        for row in signature.reshape(BANDS, ROWS).T.astype(np.uint64):
            key = _mixed(key * _MIX[0] + row)
        return key.view(np.int64)


def _tools():
    """The shingler and the permutations of this worker."""
    return process_cache("minhash", lambda: (shingler(), Circulant()))


def _keyed(docs: DataFrame) -> DataFrame:
    """``docs`` with the key of a document."""
    return docs.withColumn("_id", F.coalesce(F.col("doc_id").cast("long"), F.lit(_NO_ID))).withColumn("_th", F.xxhash64(F.col("text").cast("string")))


def sketches(docs: DataFrame) -> DataFrame:
    """_id, _th, n_shingles, set_key (of equal sets equal), bands (keys of the buckets)."""
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles, circulant = _tools()
        for b in batches:
            sets = [shingles(t) for t in b["text"].to_pylist()]
            keys = [hashlib.blake2b(s.tobytes(), digest_size=16).digest() for s in sets]
            bands = [circulant.keys(s) if len(s) else np.zeros(0, np.int64) for s in sets]
            yield pa.RecordBatch.from_arrays([b["_id"], b["_th"], pa.array([len(s) for s in sets], pa.int64()), pa.array(keys, pa.binary()), pa.array(bands, pa.list_(pa.int64()))], names=[*_KEY, "n_shingles", "set_key", "bands"])

    rows = _keyed(docs).select(*_KEY, F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, "_id long, _th long, n_shingles long, set_key binary, bands array<long>")


def _confirm(texts: DataFrame):
    """Of pairs (a, b) those whose full sets reach the similarity."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles = _tools()[0]
        held: tuple[int | None, np.ndarray] = (None, np.zeros(0, np.uint64))
        for b in batches:
            keep = []
            for a, ta, tb in zip(b["a"].to_pylist(), b["ta"].to_pylist(), b["tb"].to_pylist(), strict=True):
                if held[0] != a:
                    held = (a, shingles(ta))
                other = shingles(tb)
                common = len(np.intersect1d(held[1], other, assume_unique=True))
                keep.append(100 * common >= LEAST_PERCENT * (len(held[1]) + len(other) - common))
            yield b.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    def verify(pairs: DataFrame) -> DataFrame:
        with_a = pairs.join(texts.select(F.col("node").alias("a"), F.col("text").alias("ta")), "a")
        with_b = with_a.join(texts.select(F.col("node").alias("b"), F.col("text").alias("tb")), "b")
        return with_b.select("a", "b", "ta", "tb").mapInArrow(run, "a long, b long")

    return verify


def _links_of_block(table: pa.Table) -> pa.Table:
    """Links of the full sets between the two sides of a block pair, as few as join all that is linked."""
    shingles = _tools()[0]
    ids, own, side = (table[c].to_numpy() for c in ("id", "component", "side"))
    if own.min() == own.max():
        return pa.table({"a": pa.array([], pa.int64()), "b": pa.array([], pa.int64())})
    sets = [shingles(t) for t in table["text"].to_pylist()]
    size = np.array([len(s) for s in sets])
    names, code, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    number = np.cumsum(count > 1) - 1  # only shingles of two sets or more matter
    row = np.repeat(np.arange(len(sets)), size)
    use = count[code] > 1
    row, col = row[use], number[code[use]]
    common = np.zeros((len(sets), len(sets)), np.float32)
    order = np.argsort(col, kind="stable")
    row, col = row[order], col[order]
    for at in range(0, int(number[-1]) + 1, 2048):
        lo, hi = np.searchsorted(col, (at, at + 2048))
        part = np.zeros((len(sets), min(2048, int(number[-1]) + 1 - at)), np.float32)
        part[row[lo:hi], col[lo:hi] - at] = 1
        common += part @ part.T
    linked = 100 * common >= LEAST_PERCENT * (size[:, None] + size[None, :] - common)
    linked &= (own[:, None] != own[None, :]) & ((side[:, None] != side[None, :]) | (side.min() == side.max()))
    root = {c: c for c in own.tolist()}

    def find(c: int) -> int:
        while root[c] != c:
            root[c] = root[root[c]]
            c = root[c]
        return c

    out = []
    for i, j in np.argwhere(np.triu(linked, 1)).tolist():
        x, y = find(int(own[i])), find(int(own[j]))
        if x != y:
            root[max(x, y)] = min(x, y)
            out.append((min(int(ids[i]), int(ids[j])), max(int(ids[i]), int(ids[j]))))
    return pa.table({"a": pa.array([a for a, _ in out], pa.int64()), "b": pa.array([b for _, b in out], pa.int64())})


def _in_blocks(texts: DataFrame):
    """Comparison of two blocks of a bucket at a time, each in a group of its own."""

    def compare(blocks: DataFrame) -> DataFrame:
        with_text = blocks.join(texts.select(F.col("node").alias("id"), "text"), "id")
        return with_text.groupBy("bucket", "lo", "hi").applyInArrow(_links_of_block, "a long, b long")

    return compare


def _grouped(docs: DataFrame) -> DataFrame:
    """_id, _th, n_shingles, component_id, kept for every row of ``docs``; ids are not null here.

    A class (documents with equal sets) has its first document's key and a number, ``node``, by which it is linked.
    """
    small_batches(docs.sparkSession)
    rows = stash(sketches(docs), "sketches")
    key = F.struct(*_KEY)
    classes = rows.filter("n_shingles > 0").groupBy("set_key").agg(F.min(key).alias("first"))
    classes = stash(classes.select("set_key", "first._id", "first._th").withColumn("node", F.monotonically_increasing_id()), "classes")
    heads = rows.join(classes, ["set_key", *_KEY]).dropDuplicates(["node"])
    buckets = heads.select(F.explode("bands").alias("bucket"), F.col("node").alias("id"), F.col("n_shingles").alias("n"))
    shared = stash(buckets.groupBy("bucket").agg(F.count("*").alias("many")).filter("many > 1").select("bucket"), "shared-buckets")
    members = stash(buckets.join(shared, "bucket", "left_semi"), "buckets")
    ids = stash(classes.join(members.select(F.col("id").alias("node")).distinct(), "node", "left_semi").select(*_KEY, "node", F.xxhash64(*_KEY).alias("at")), "candidates")
    known = _keyed(docs).select(*_KEY, "text").withColumn("at", F.xxhash64(*_KEY))
    texts = stash(only_maybe(known, "at", key_filter(ids, "at", ids.count())).drop("at").join(ids.drop("at"), _KEY).select("node", "text").dropDuplicates(["node"]), "candidate-texts")
    found = link_buckets(members, _confirm(texts), LEAST_PERCENT, _in_blocks(texts))
    linked = stash(classes.join(found.withColumnRenamed("id", "node"), "node"), "linked")
    # Components are named by their first document: nodes are numbered in no order.
    lead = linked.groupBy("component").agg(F.min(key).alias("lead"))
    led = linked.join(lead, "component").select("node", "lead")
    of_class = stash(classes.join(led, "node", "left").select("set_key", F.coalesce("lead", key).alias("lead")), "components")
    discard(docs.sparkSession, classes, shared, members, ids, texts, linked)
    # A class of very many copies is one row of the right side; the left side of the join is split where it is skewed.
    out = rows.select(*_KEY, "n_shingles", "set_key").join(of_class, "set_key", "left").withColumn("lead", F.when(F.col("n_shingles") > 0, F.col("lead")).otherwise(key))
    return out.select(*_KEY, "n_shingles", F.col("lead._id").alias("component_id"), ((F.col("lead._id") == F.col("_id")) & (F.col("lead._th") == F.col("_th"))).alias("kept"))


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id (smallest id that links reach), kept for every row of ``docs``."""
    real = lambda c: F.when(F.col(c) != _NO_ID, F.col(c))
    return _grouped(docs).select(real("_id").alias("doc_id"), "n_shingles", real("component_id").alias("component_id"), "kept")


def keep_one(docs: DataFrame) -> DataFrame:
    """``docs`` with one document of each group of near duplicates: the one of smallest id, once; all columns stay.

    Only rows that may be in a group, or may be repeated, are moved.
    """
    found = stash(_grouped(docs).select(F.col("_id").alias("_near_id"), F.col("_th").alias("_near_th"), "kept"), "near")
    touched = found.groupBy("_near_id", "_near_th").agg(F.min("kept").alias("_near_kept"), F.count("*").alias("many")).filter("not _near_kept or many > 1").drop("many")
    touched = stash(touched.withColumn("_near_at", F.xxhash64("_near_id", "_near_th")), "near-touched")
    marked = maybe_among(_keyed(docs).withColumn("_at", F.xxhash64(*_KEY)), "_at", key_filter(touched, "_near_at", touched.count()))
    rest = marked.filter("_maybe").join(touched, (F.col("_id") == F.col("_near_id")) & (F.col("_th") == F.col("_near_th")), "left").filter("_near_kept is null or _near_kept")
    repeated = rest.filter("_near_kept").dropDuplicates(_KEY)
    return marked.filter("not _maybe").select(*docs.columns).unionByName(rest.filter("_near_kept is null").select(*docs.columns)).unionByName(repeated.select(*docs.columns))
