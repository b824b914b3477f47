"""Repeated strings by a depth-limited radix sort of suffixes, over bytes and over words.

Only repeats of ``threshold`` symbols matter, so suffixes are told apart through that depth and no further. A ``Unit`` says
what a symbol is: BYTES finds repeated strings of 400 bytes, whose bytes are removed; WORDS finds repeated passages of over
50 words (ASCII white space between them), which are reported only. Both go through the same passes together. Each pass of
the sort groups suffixes by one more digit, most significant first, and drops those that stand alone:

1. The first digit of a suffix is the string of ``gram`` symbols of smallest hash (leftmost of equal ones) that starts in its
   first threshold - gram + 1 places, together with its place. Equal suffixes agree on it, and neighbouring suffixes share
   it, so one row stands for about a hundred of them.
2. Where the whole surroundings of that string (all symbols of all suffixes it may stand for) occur twice, all those suffixes
   are repeats; they leave the sort, but one of each group stays to be met by others.
3. The rest is divided by the place of the string into blocks of ``block`` suffixes; the digit is what these share. Blocks
   that stand alone drop out; of those that do not, the ones whose surroundings occur twice leave as in pass 2.
4. Suffixes of the remaining blocks are compared through the full depth: equal groups are the repeated windows.

Where digits decide that something is repeated they are compared by two independent 64-bit hashes of the string, seeded
apart. Every symbol that a repeated window covers counts, in all its occurrences; windows never cross documents.

Defined cases: null text counts as empty; texts under a threshold have no window of that unit; texts of any length are used
whole; rows that repeat id and text count as other places of the same strings and share one result; a null id stays null;
ties of hashes go to the leftmost place; an empty table gives no row; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelspark.llm._common import discard, having_key, key_filter, maybe_among, meeting, only_maybe, process_cache, small_batches, stash

#: Window starts handled at a time: bounds memory where a text is very long.
SEGMENT = 1 << 20
#: Bytes of texts that are handled as one array, about (a longer text is one by itself).
GROUP = 1 << 18


@dataclass(frozen=True)
class Unit:
    """A kind of symbol with the shortest repeat that matters (``threshold`` symbols) and the sizes of the digits."""

    number: int
    threshold: int
    gram: int
    block: int
    least_bytes: int  # of a text that has a window

    @property
    def span(self) -> int:
        """Largest place of the first digit's string in a suffix."""
        return self.threshold - self.gram

    @property
    def salt(self) -> np.uint64:
        return np.uint64(self.number * 0x632BE59BD9B4E019 % 2**64)


BYTES = Unit(0, 400, 64, 16, 400)
WORDS = Unit(1, 51, 8, 4, 101)
UNITS = (BYTES, WORDS)


def _of_unit(what) -> Column:
    """``what(unit)`` for the unit of a row."""
    out = F.lit(what(UNITS[0]))
    for u in UNITS[1:]:
        out = F.when(F.col("unit") == u.number, F.lit(what(u))).otherwise(out)
    return out


class Rolling:
    """Hashes of strings of symbols from prefix sums: sum of value(symbol) * base**k over the string, modulo 2**64."""

    def __init__(self, seed: int):
        rng = np.random.default_rng(seed)
        self.table = rng.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        base = int(rng.integers(1, 2**62)) * 4 + 3
        self.base, self.back = np.uint64(base % 2**64), np.uint64(pow(base, -1, 2**64))
        self.up = self.down = np.ones(1, np.uint64)
        self.word_salt = np.uint64(rng.integers(1, 2**63))

    def values(self, symbols: np.ndarray) -> np.ndarray:
        """Odd numbers for the symbols: bytes, or hashes of words."""
        return self.table[symbols] if symbols.dtype == np.uint8 else _mixed(symbols ^ self.word_salt) | np.uint64(1)

    def prefix(self, symbols: np.ndarray) -> np.ndarray:
        while len(self.up) <= len(symbols):
            n = len(self.up)
            self.up = np.r_[self.up, self.up * (self.up[-1:] * self.base)]
            self.down = np.r_[self.down, self.down * (self.down[-1:] * self.back)]
            assert len(self.up) == 2 * n
        out = np.zeros(len(symbols) + 1, np.uint64)
        np.cumsum(self.values(symbols) * self.up[: len(symbols)], out=out[1:])
        return out

    def of(self, prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return _mixed((prefix[end] - prefix[start]) * self.down[start])


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _rolling() -> tuple[Rolling, Rolling]:
    return process_cache("rolling", lambda: (Rolling(1), Rolling(2)))


def _grouped_texts(texts: list[str]) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """Texts in groups of about GROUP bytes: number of the first text, all bytes (a line feed after each text), starts, ends."""
    raw, at = [t.encode() for t in texts], 0
    while at < len(raw):
        upto, size = at + 1, len(raw[at])
        while upto < len(raw) and size + len(raw[upto]) <= GROUP:
            size += len(raw[upto])
            upto += 1
        ends = np.cumsum([len(x) + 1 for x in raw[at:upto]]) - 1
        yield at, np.frombuffer(b"\n".join(raw[at:upto]) + b"\n", np.uint8), np.r_[0, ends[:-1] + 1], ends
        at = upto


def _symbols(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray, rolling: Rolling) -> Iterator[tuple[Unit, np.ndarray, np.ndarray, np.ndarray]]:
    """For each unit the symbols of a group of texts, and where each text starts and ends among them."""
    yield BYTES, raw, starts, ends
    space = (raw == 32) | ((raw >= 9) & (raw <= 13))
    edge = np.flatnonzero(np.diff(space, prepend=True))
    lo, hi = edge[::2], edge[1::2]  # the array ends with a line feed, so no word is open
    yield WORDS, rolling.of(rolling.prefix(raw), lo, hi), np.searchsorted(lo, starts), np.searchsorted(lo, ends)


def anchors(symbols: np.ndarray, starts: np.ndarray, ends: np.ndarray, rolling: Rolling, unit: Unit = BYTES) -> tuple[np.ndarray, ...]:
    """First digits of all suffixes of the texts: hash and place of each string, and the first and last suffix it stands for."""
    real = np.zeros(len(symbols) + 1, np.int8)  # starts of windows that end inside their text
    whole = ends - starts >= unit.threshold
    np.add.at(real, starts[whole], 1)
    np.add.at(real, ends[whole] - unit.threshold + 1, -1)
    real = np.cumsum(real[:-1], dtype=np.int8).astype(bool)
    parts = []
    for at in range(0, max(len(symbols) - unit.threshold + 1, 0), SEGMENT):
        cut = symbols[at : at + SEGMENT + unit.threshold - 1]
        prefix = rolling.prefix(cut)
        n = len(cut) - unit.gram + 1
        gram = _mixed((prefix[unit.gram :] - prefix[: -unit.gram]) * rolling.down[:n] + unit.salt)
        order = (gram >> np.uint64(32) << np.uint64(32)) | np.arange(n, dtype=np.uint64)
        width = unit.span + 1
        padded = np.full(-(-n // width) * width, np.iinfo(np.uint64).max)
        padded[:n] = order
        blocks = padded.reshape(-1, width)
        ahead = np.minimum.accumulate(blocks, axis=1).ravel()
        behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
        many = len(cut) - unit.threshold + 1
        start = np.flatnonzero(real[at : at + many])
        if not len(start):
            continue
        least = (np.minimum(behind[start], ahead[start + width - 1]) & np.uint64(0xFFFFFFFF)).astype(np.int64)
        first = np.flatnonzero(np.r_[True, least[1:] != least[:-1]])
        place, last = least[first], start[np.r_[first[1:], len(start)] - 1]
        parts.append([gram[place], place + at, start[first] + at, last + at])
    if not parts:
        return (np.zeros(0, np.uint64), *(np.zeros(0, np.int64) for _ in range(3)))
    for before, after in zip(parts, parts[1:], strict=False):
        if before[1][-1] == after[1][0]:  # the same string across a segment's border
            after[2][0] = before[2][-1]
            for k in range(4):
                before[k] = before[k][:-1]
    return tuple(np.concatenate(x) for x in zip(*parts, strict=True))


def _keyed(docs: DataFrame) -> DataFrame:
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"))
    return rows.withColumn("th", F.xxhash64("text")).withColumn("row", F.xxhash64("doc_id", "th"))


def _first_digits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    rolling = _rolling()[0]
    for b in batches:
        out = [[np.zeros(0, np.int64)] * 6]
        for at, *group in _grouped_texts(b["text"].to_pylist()):
            for u, symbols, starts, ends in _symbols(*group, rolling):
                gram, place, first, last = anchors(symbols, starts, ends, rolling, u)
                own = np.searchsorted(starts, first, "right") - 1
                out.append([gram.view(np.int64), own + at, np.full(len(own), u.number), place - starts[own], place - last, place - first])
        gram, own, unit, place, near, far = (np.concatenate(x) for x in zip(*out, strict=True))
        yield pa.RecordBatch.from_arrays([pa.array(gram), b["row"].take(pa.array(own)), pa.array(unit.astype(np.int8)), pa.array(place.astype(np.int32)), pa.array(near.astype(np.int16)), pa.array(far.astype(np.int16))], names=["gram", "row", "unit", "place", "near", "far"])


def _per_text(batches: Iterator[pa.RecordBatch], what, names: list[str]) -> Iterator[pa.RecordBatch]:
    """Rows of ``what(unit, prefixes, hashes, start, end, places, nears, fars)`` for the listed strings of the texts: it gets
    places in the group, start and end of each one's text there, and gives the number of each row's string and arrays, of
    which the first is a place in the group."""
    both = _rolling()
    for b in batches:
        listed = b["listed"]
        child, borders = listed.flatten(), np.r_[0, np.cumsum(np.asarray(listed.value_lengths()))]
        unit, place, near, far = (child.field(k).to_numpy().astype(np.int64) for k in ("unit", "place", "near", "far"))
        owner = np.repeat(np.arange(b.num_rows), np.diff(borders))
        out = [[np.zeros(0, np.int64)] * (2 + len(names))]
        for at, raw, *edges in _grouped_texts(b["text"].to_pylist()):
            some = np.arange(borders[at], borders[at + len(edges[0])])
            for u, symbols, starts, ends in _symbols(raw, *edges, both[0]):
                own = some[unit[some] == u.number]
                if not len(own):
                    continue
                k = owner[own] - at
                nth, moved, *rest = what(u, [r.prefix(symbols) for r in both], both, starts[k], ends[k], place[own] + starts[k], near[own], far[own])
                out.append([k[nth] + at, np.full(len(nth), u.number), moved - starts[k[nth]], *rest])
        cols = [np.concatenate([c.view(np.int64) if c.dtype == np.uint64 else c.astype(np.int64) for c in x]) for x in zip(*out, strict=True)]
        row = pa.array(cols[0])
        yield pa.RecordBatch.from_arrays([b["doc_id"].take(row), b["th"].take(row), pa.array(cols[1].astype(np.int8)), *map(pa.array, cols[2:])], names=["doc_id", "th", "unit", *names])


def _surroundings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def what(u, prefixes, both, start, end, place, near, far):
        nth = np.flatnonzero((place >= start) & (place + u.gram <= end))  # all, unless two rows share a key
        start, end, place = start[nth], end[nth], place[nth]
        whole = (place - u.span >= start) & (place + u.threshold <= end)
        lo, hi = np.where(whole, place - u.span, place), np.where(whole, place + u.threshold, place)
        gram, *around = (_mixed(h + u.salt) for h in (both[0].of(prefixes[0], place, place + u.gram), *(r.of(f, lo, hi) for r, f in zip(both, prefixes, strict=True))))
        return nth, place, near[nth], far[nth], gram, whole.astype(np.int64), *around

    return _per_text(batches, what, ["place", "near", "far", "gram", "whole", "h1", "h2"])


def _cores(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def what(u, prefixes, both, start, end, place, near, far):
        lows = np.arange(0, u.span + 1, u.block)
        highs = np.minimum(lows + u.block - 1, u.span)
        salts = (lows + 1).astype(np.uint64) * np.array([0x9E3779B97F4A7C15], np.uint64) + u.salt
        first, last = place[:, None] - lows, place[:, None] - highs + u.threshold  # what all suffixes of a block share
        ok = (near[:, None] <= highs) & (far[:, None] >= lows) & (first >= start[:, None]) & (last <= end[:, None]) & (place[:, None] + u.gram <= end[:, None])
        k, j = np.nonzero(ok)
        p, low, high, salt = place[k], lows[j], highs[j], salts[j]
        whole = (p - high >= start[k]) & (p - low + u.threshold <= end[k])
        lo, hi = np.where(whole, p - high, p), np.where(whole, p - low + u.threshold, p)
        around = [_mixed(r.of(f, lo, hi) + salt) for r, f in zip(both, prefixes, strict=True)]
        core = _mixed(both[0].of(prefixes[0], first[k, j], last[k, j]) + salt)
        return k, p, np.maximum(near[k], low), np.minimum(far[k], high), core, whole.astype(np.int64), *around

    return _per_text(batches, what, ["place", "near", "far", "core", "whole", "h1", "h2"])


def _windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def what(u, prefixes, both, start, end, place, near, far):
        many = far - near + 1
        nth = np.repeat(np.arange(len(many)), many)
        at = (place - far)[nth] + np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
        inside = (at >= start[nth]) & (at + u.threshold <= end[nth])
        at, one = np.unique(at[inside], return_index=True)
        return nth[inside][one], at, *(_mixed(r.of(f, at, at + u.threshold) + u.salt) for r, f in zip(both, prefixes, strict=True))

    return _per_text(batches, what, ["start", "h1", "h2"])


def _listed(rows: DataFrame, keys: list[str]) -> DataFrame:
    return rows.groupBy(*keys).agg(F.collect_set(F.struct("unit", "place", "near", "far")).alias("listed"))


def repeated_spans(docs: DataFrame) -> DataFrame:
    """(doc_id, th, spans): ranges (unit, start, end), not yet merged, of the repeated windows of each text that has one."""
    small_batches(docs.sparkSession)
    rows = _keyed(docs)
    spark = docs.sparkSession
    long_enough = F.octet_length("text") >= min(u.least_bytes for u in UNITS)
    digits = stash(rows.select("row", "text").filter(long_enough).mapInArrow(_first_digits, "gram long, row long, unit byte, place int, near short, far short"), "first-digits")
    again = stash(digits.groupBy("gram").agg(F.count("*").alias("n")).filter("n > 1"), "met-grams")
    met = stash(_listed(having_key(digits, "gram", again, digits.count()), ["row"]), "met-digits")
    discard(spark, digits, again)
    texts = stash(only_maybe(rows, "row", key_filter(met, "row", met.count())).join(met, "row").select("doc_id", "th", "text", "listed"), "met-texts")
    discard(spark, met)

    def with_text(listed: DataFrame) -> DataFrame:
        own = listed.select(F.col("doc_id").alias("_id"), F.col("th").alias("_th"), "listed")
        return texts.drop("listed").join(own, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("th") == F.col("_th"))).select("doc_id", "th", "text", "listed")

    own = "doc_id long, th long, unit byte, place long, near long, far long"
    span, threshold, block = (_of_unit(lambda u, k=k: getattr(u, k)) for k in ("span", "threshold", "block"))
    around = stash(texts.mapInArrow(_surroundings, f"{own}, gram long, whole long, h1 long, h2 long"), "surroundings")
    wide, rest = _settled(around, "gram", F.col("place") - span, F.col("place") + threshold)
    discard(spark, around)
    cores = stash(with_text(rest).mapInArrow(_cores, f"{own}, core long, whole long, h1 long, h2 long"), "cores")
    shared = stash(cores.groupBy("core").agg(F.count("*").alias("n")).filter("n > 1"), "met-cores")
    blocks = stash(having_key(cores, "core", shared, cores.count()), "blocks")
    discard(spark, cores, rest, shared)
    low = F.floor(F.col("near") / block) * block
    narrow, rest = _settled(blocks, "core", F.col("place") - F.least(low + block - 1, span), F.col("place") - low + threshold)
    discard(spark, blocks)
    windows = stash(with_text(rest).mapInArrow(_windows, "doc_id long, th long, unit byte, start long, h1 long, h2 long"), "windows")
    discard(spark, rest, texts)
    equal = stash(windows.groupBy("h1", "h2").agg(F.count("*").alias("n")).filter("n > 1"), "equal-windows")
    found = meeting(windows, ["h1", "h2"], equal, windows.count(), "left_semi").select("doc_id", "th", "unit", "start", (F.col("start") + threshold).alias("end"))
    spans = stash(wide.unionByName(narrow).unionByName(found).groupBy("doc_id", "th").agg(F.collect_set(F.struct("unit", "start", "end")).alias("spans")), "repeated-spans")
    discard(spark, windows, equal, wide, narrow)
    return spans


def _settled(rows: DataFrame, digit: str, start: Column, end: Column) -> tuple[DataFrame, DataFrame]:
    """Of rows with the hash (h1, h2) of their surroundings, where they lie inside the text (``whole``): the ranges of
    those that occur twice, and what goes on to the next pass, listed by text: the others, and one of each group that is
    settled if its digit is still open."""
    key = F.struct("doc_id", "th", "place", "near")
    twice = stash(rows.filter("whole = 1").groupBy("h1", "h2").agg(F.count("*").alias("n"), F.min(key).alias("one")).filter("n > 1"), "met-twice")
    sure = meeting(rows.filter("whole = 1"), ["h1", "h2"], twice, rows.count(), "left").withColumn("done", F.col("one").isNotNull()).withColumn("one", F.coalesce(key == F.col("one"), F.lit(False)))
    edge = rows.filter("whole = 0").withColumn("one", F.lit(False)).withColumn("done", F.lit(False))
    told = stash(sure.unionByName(edge).drop("h1", "h2", "whole"), "told")
    spans = stash(told.filter("done").select("doc_id", "th", "unit", start.cast("long").alias("start"), end.cast("long").alias("end")), "spans")
    left = told.filter("not done or one")
    still = stash(left.groupBy(digit).agg(F.count("*").alias("n"), F.min("done").alias("settled")).filter("not settled").drop("settled"), "open-digits")
    rest = stash(_listed(having_key(left, digit, still, told.count()), ["doc_id", "th"]), "rest")
    discard(rows.sparkSession, told, still, twice)
    return spans, rest


def merged(start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Maximal runs of the union of ranges (touching ones are one run)."""
    order = np.argsort(start, kind="stable")
    start, end = start[order], np.maximum.accumulate(end[order])
    new = np.r_[True, start[1:] > end[:-1]]
    return start[new], end[np.r_[np.flatnonzero(new)[1:] - 1, len(end) - 1]]


#: Places of the texts of a batch are told apart by this many bits.
_PLACE_BITS = 40


def _runs(owner: np.ndarray, start: np.ndarray, end: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Maximal runs of the ranges of ``n`` texts: where those of each text begin (n + 1 borders), their starts and ends."""
    if not len(start):
        return np.zeros(n + 1, np.int64), start, end
    base = owner << _PLACE_BITS
    lo, hi = merged(base + start, base + end)
    text = lo >> _PLACE_BITS
    return np.searchsorted(text, np.arange(n + 1)), lo - (text << _PLACE_BITS), hi - (text << _PLACE_BITS)


_RANGES = "array<struct<start:bigint,end:bigint>>"


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def listed(borders: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> pa.Array:
        return pa.ListArray.from_arrays(pa.array(borders.astype(np.int32)), pa.StructArray.from_arrays([pa.array(lo), pa.array(hi)], ["start", "end"]))

    for b in batches:
        n, many = b.num_rows, np.asarray(b["spans"].value_lengths().fill_null(0))
        child, owner = b["spans"].flatten(), np.repeat(np.arange(n), many)
        unit, start, end = (np.asarray(child.field(k)).astype(np.int64) for k in ("unit", "start", "end"))
        spans, passages = (_runs(owner[unit == u.number], start[unit == u.number], end[unit == u.number], n) for u in (BYTES, WORDS))
        sizes, kept = [], []
        borders, lo, hi = (x.tolist() for x in spans)
        for k, text in enumerate(b["text"].to_pylist()):
            raw, left, at = text.encode(), [], 0
            for r in range(borders[k], borders[k + 1]):
                left.append(raw[at : lo[r]])
                at = hi[r]
            kept.append(b"".join([*left, raw[at:]]))
            sizes.append(len(raw))
        gone = np.array(sizes, np.int64) - np.array([len(x) for x in kept], np.int64)
        yield pa.RecordBatch.from_arrays([b["doc_id"], pa.array(sizes, pa.int64()), pa.array(gone), listed(*spans), pa.array(kept, pa.binary()), listed(*passages)], names=["doc_id", "n_bytes", "n_removed", "spans", "kept", "passages"])


def remove_repeats(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, spans (removed runs of bytes), kept (the remaining bytes) and passages (runs of words that
    repeated passages of over 50 words cover; nothing is removed for them) for every row of ``docs``."""
    spans = repeated_spans(docs).withColumn("row", F.xxhash64("doc_id", "th"))
    rows = maybe_among(_keyed(docs), "row", key_filter(spans, "row", spans.count()))
    none = F.array().cast(_RANGES)
    clean = rows.filter(~F.col("_maybe")).select("doc_id", F.octet_length("text").cast("long").alias("n_bytes"), F.lit(0).cast("long").alias("n_removed"), none.alias("spans"), F.encode("text", "utf-8").alias("kept"), none.alias("passages"))
    own = spans.select(F.col("row").alias("_row"), F.col("doc_id").alias("_id"), F.col("th").alias("_th"), "spans")
    met = rows.filter("_maybe").join(own, (F.col("row") == F.col("_row")) & F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("th") == F.col("_th")), "left")
    cut = met.select("doc_id", "text", "spans").mapInArrow(_cut, f"doc_id long, n_bytes long, n_removed long, spans {_RANGES}, kept binary, passages {_RANGES}")
    return clean.unionByName(cut)
