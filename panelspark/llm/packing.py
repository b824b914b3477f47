"""Best-fit packing with bound-certified repacking.

Documents become token pieces of at most ``capacity``. Pieces are dealt to partitions; each is packed by best-fit
decreasing, and dual-feasible functions give a lower bound of its bins. A partition whose bins equal the bound is certified.
The others have a gap: the pieces of their bins that are not full are exchanged, i.e. dealt anew among fewer partitions by
another hash, bounded and packed again, as long as that saves bins, or until one partition holds what is left.

Defined cases: a null text counts as empty and is one piece with the closing id 0 alone; texts of any length are cut into
whole pieces and a last shorter one; repeated rows are packed as often as they occur; an empty table gives no piece.
"""

from __future__ import annotations

import re
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelspark.llm._common import discard, process_cache, small_batches, stash

CAPACITY = 2048
#: Pieces of one partition of a packing round, about.
PARTITION_PIECES = 100_000
#: The factor by which partitions get fewer in an exchange, where what is left allows it.
SHRINK = 8
CACHE_WORDS = 300_000

#: Texts of only these characters are cut into words by WORDS, the tokenizer's own rule for them, and words are looked up.
PLAIN = re.compile(r"[\t\n\r\x20-\x7eÀ-įı-ňŊ-ž]*")
WORDS = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[^\W\d_]+|\d|(?:[^\s\w]|_)+")
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
PACKED = f"{PIECES}, sequence_id long, offset long, full_bin boolean, certified boolean"


def _byte_letters() -> dict[int, str]:
    """The letters that byte-level pre-tokenization writes for bytes: printable ones for themselves, the rest from 256 on."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in own]
    return {b: chr(b) for b in own} | {b: chr(256 + k) for k, b in enumerate(rest)}


def word_encoder(tokenizer_path: str):
    """List of texts to their ids (little-endian 32-bit bytes), as the tokenizers library encodes them without special tokens added."""
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(tokenizer_path)
    model, letters = tokenizer.model, _byte_letters()
    known: dict[str, bytes] = {}  # what stands between white space: no token crosses white space
    cache: dict[str, bytes] = {}  # its words

    def whole(text: str) -> bytes:
        return np.array(tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def word(w: str) -> bytes:
        ids = cache.get(w)
        if ids is None:
            spelled = w if w.isascii() else "".join(map(letters.__getitem__, w.encode()))
            got = [t.id for t in model.tokenize(spelled)]
            ids = cache[w] = struct.pack(f"<{len(got)}I", *got)
        return ids

    def encode(texts: list[str | None]) -> list[bytes]:
        split = [t.lower().split() if t and PLAIN.fullmatch(t) and "<|" not in t else None for t in texts]
        seen = set().union(*(ws for ws in split if ws))
        if len(known) + len(seen) > CACHE_WORDS:
            known.clear()
            cache.clear()
        for x in seen:
            if x not in known:
                known[x] = word(x) if x.isalpha() else b"".join(map(word, WORDS.findall(x)))
        return [b"".join(map(known.__getitem__, ws)) if ws is not None else whole(t) if t else b"" for t, ws in zip(texts, split, strict=True)]

    return encode


def token_pieces(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 of each piece; a document's ids end with id 0."""
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = process_cache(f"words {tokenizer_path}", lambda: word_encoder(tokenizer_path))
        for b in batches:
            out: list[tuple] = []
            for doc_id, ids in zip(b["doc_id"].to_pylist(), encode(b["text"].to_pylist()), strict=True):
                ids += b"\0\0\0\0"
                for k, at in enumerate(range(0, len(ids), 4 * capacity)):
                    cut = ids[at : at + 4 * capacity]
                    out.append((doc_id, k, at // 4, len(cut) // 4, zlib.crc32(cut)))
            yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*out, strict=True) if out else [[]] * 5, (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()), strict=True)], names=["doc_id", "piece", "start", "length", "ids_crc32"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, PIECES)


def lower_bound(lengths: np.ndarray, capacity: int) -> int:
    """Bins that the lengths need at least: the best of two families of dual-feasible functions and of the plain sum."""
    count = np.bincount(lengths, minlength=capacity + 1)
    size = np.arange(capacity + 1)
    best = -(-int((count * size).sum()) // capacity)
    more = np.cumsum(count[::-1])[::-1]  # pieces of at least this length
    volume = np.r_[0, np.cumsum(count * size)]  # tokens of pieces shorter than this
    for p in range(1, capacity // 2 + 1):  # longer than capacity - p count as whole bins, shorter than p as nothing
        whole = int(more[capacity - p + 1])
        rest = int(volume[capacity - p + 1] - volume[p])
        best = max(best, whole + -(-rest // capacity))
    for k in range(1, 101):  # rounds (k + 1) x / capacity down, but keeps exact multiples
        value = np.where((k + 1) * size % capacity == 0, k * size, (k + 1) * size // capacity * capacity)  # times k
        best = max(best, -(-int((count * value).sum()) // (k * capacity)))
    return best


def best_fit_decreasing(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bin and offset of each piece, and the free room of each bin; open bins by room, found through a bit for each room."""
    order = np.argsort(-lengths, kind="stable")
    bins, offset = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    open_bins: list[list[int]] = [[] for _ in range(capacity + 1)]
    rooms, room = 0, []
    for i, n in zip(order.tolist(), lengths[order].tolist(), strict=True):
        fit = rooms >> n
        if fit:
            r = n + (fit & -fit).bit_length() - 1
            b = open_bins[r].pop()
            if not open_bins[r]:
                rooms ^= 1 << r
        else:
            r, b = capacity, len(room)
            room.append(capacity)
        bins[i], offset[i] = b, capacity - r
        r -= n
        room[b] = r
        if r:
            if not open_bins[r]:
                rooms |= 1 << r
            open_bins[r].append(b)
    return bins, offset, np.array(room, np.int64)


def _pack_partition(capacity: int, turn: int):
    def run(table: pa.Table) -> pa.Table:
        order = pa.compute.sort_indices(table, [(c, "ascending") for c in ("doc_id", "piece", "length", "ids_crc32")])
        table = table.take(order)
        lengths = table["length"].to_numpy()
        bins, offset, room = best_fit_decreasing(lengths, capacity)
        bound = lower_bound(lengths, capacity)
        part = int(table["part"][0].as_py())
        table = table.select(["doc_id", "piece", "start", "length", "ids_crc32"])
        table = table.append_column("sequence_id", pa.array((turn << 56) + (part << 32) + bins))
        table = table.append_column("offset", pa.array(offset))
        table = table.append_column("full_bin", pa.array(room[bins] == 0))
        return table.append_column("certified", pa.array(np.full(len(bins), len(room) == bound)))

    return run


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``pieces`` with sequence_id, offset (gapless from 0) and certified (its partition's bins equal their lower bound)."""
    spark = pieces.sparkSession
    left, done, held, before, turn = pieces, None, None, None, 0
    count = left.count()
    parts = max(1, -(-count // PARTITION_PIECES))
    while True:
        dealt = left.withColumn("part", F.pmod(F.xxhash64(F.lit(turn), "doc_id", "piece"), F.lit(parts)).cast("int"))
        packed = stash(dealt.groupBy("part").applyInArrow(_pack_partition(capacity, turn), PACKED), "packing")
        bins = packed.agg(F.countDistinct("sequence_id").alias("n")).first()["n"]
        if before is not None and bins >= before:  # this exchange saved nothing: what it was to improve stays
            done = held if done is None else done.unionByName(held)
            discard(spark, packed)
            break
        gap = F.lit(False) if parts == 1 else ~F.col("certified") & ~F.col("full_bin")
        final = packed.filter(~gap)
        done = final if done is None else done.unionByName(final)
        held = packed.filter(gap)
        rest = held.agg(F.count("*").alias("n"), F.countDistinct("sequence_id").alias("bins")).first()
        if not rest["n"]:
            break
        left, count, before, turn = held.select(*pieces.columns), rest["n"], rest["bins"], turn + 1
        parts = max(1, -(-count // PARTITION_PIECES), parts // SHRINK if count <= PARTITION_PIECES * (parts // SHRINK) * 2 else parts // 2)
    return done.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset", "certified")


def pack_documents(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY) -> DataFrame:
    """Pieces of all rows of ``docs`` with the sequence and the place they are packed at."""
    small_batches(docs.sparkSession)
    pieces = stash(token_pieces(docs, tokenizer_path, capacity), "token-pieces")
    packed = pack(pieces, capacity)
    discard(docs.sparkSession, pieces)
    return packed
