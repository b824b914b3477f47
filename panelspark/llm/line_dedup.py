"""Line dedup by winnowing over line hashes, with DataFrame functions only.

A document is the sequence of the hashes of its lines that are not blank. Of every window of ``RUN`` lines the smallest
hash (the last of equal ones) is its fingerprint, so two equal runs of ``RUN`` lines always share one at the same place.
Positions are joined on fingerprints that occur more than once; around such a position the match is extended both ways by
every window the fingerprint stands for, compared line by line. A window that also occurs earlier (in a document with a
smaller id, or earlier in the same one) is a repeat, and the lines that repeats cover, runs of any length from RUN on, are
deleted. The first occurrence stays.

Runs of fewer lines that total over ``LONG_WORDS`` words (one long line included) are windows too, with no fingerprint: each
is a row of its own, and equal ones are counted. With ``long_words`` None only runs of RUN lines are windows (the rule of
the query's SQL). A passage that is only part of a line is never a window.

Defined cases: null text stays null and has no lines; blank lines never count and stay; words are what stands between ASCII
white space; documents of fewer than RUN lines and at most LONG_WORDS words stay as they are; rows that repeat both id and text share one fate; a null id comes after every id; very common lines are
only counted, never paired with each other; other columns pass through.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelspark.llm._common import discard, having_key, key_filter, let, maybe_among, stash

#: Lines of the shortest run that is deleted when it repeats: the winnowing window.
RUN = 3
#: Runs of fewer lines are windows too if they hold more words than this.
LONG_WORDS = 50
_LAST = 2**63 - 1


def _lines(text: Column) -> Column:
    return F.split(text, "\n", -1)


def _filled(line: Column) -> Column:
    return F.trim(F.translate(line, "\t\r\x0b\x0c", "    ")) != ""


def _keyed(docs: DataFrame) -> DataFrame:
    """``docs`` with the key of a row: its id (a null one last) and a hash of its text."""
    return docs.withColumn("_ld_id", F.coalesce(F.col("doc_id").cast("long"), F.lit(_LAST))).withColumn("_ld_th", F.xxhash64("text"))


def _windows(run: int) -> Column:
    """Of each window of ``hashes``: its fingerprint (hash, minus its position)."""
    each = F.sequence(F.lit(0), F.size("hashes") - run)
    return F.transform(each, lambda i: F.array_min(F.array(*(F.struct(F.col("hashes")[i + k].alias("h"), (-(i + k)).alias("p")) for k in range(run)))))


def _long_windows(rows: DataFrame, run: int, long_words: int) -> DataFrame:
    """(_ld_id, _ld_th, start, size, window): runs of fewer than ``run`` lines that hold more than ``long_words`` words."""
    words = lambda i, size: sum((F.get("words", i + k) for k in range(1, size)), F.get("words", i))
    starts = lambda size: F.filter(F.sequence(F.lit(0), F.size("words") - 1), lambda i: words(i, size) > long_words)
    placed = lambda size: F.transform(starts(size), lambda i: F.struct(i.alias("start"), F.lit(size).alias("size")))
    places = F.flatten(F.array(*map(placed, range(1, run))))
    each = rows.filter(F.size("words") > 0).withColumn("r", F.explode(places)).select("_ld_id", "_ld_th", "r.start", "r.size", "hashes")
    return each.select("_ld_id", "_ld_th", "start", "size", F.slice("hashes", F.col("start") + 1, F.col("size")).alias("window"))


def _later(windows: DataFrame, label: str, work: list[DataFrame]) -> DataFrame:
    """(_ld_id, _ld_th, start, size) of the windows that are not the first of their kind; ``windows`` is a work table, so that
    the join has a shuffle on either side and a very common window can be split."""
    first = stash(windows.groupBy("window").agg(F.min(F.struct("_ld_id", "_ld_th", "start")).alias("first"), F.count("*").alias("n")).filter("n > 1").drop("n"), label)
    work += [windows, first]
    return windows.join(first, "window").filter(F.struct("_ld_id", "_ld_th", "start") != F.col("first")).select("_ld_id", "_ld_th", "start", "size")


def repeated_windows(docs: DataFrame, run: int = RUN, long_words: int | None = LONG_WORDS) -> tuple[DataFrame, list[DataFrame]]:
    """(_ld_id, _ld_th, start, size): windows of ``size`` lines, by the first line's place among lines not blank, that occur
    earlier; and the work tables that it reads."""
    lines = F.filter(_lines(F.col("text")), _filled)
    hashed = lambda x: F.xxhash64(F.trim(x)).alias("h")
    each = (lambda x: F.struct(hashed(x))) if long_words is None else (lambda x: F.struct(hashed(x), F.regexp_count(x, F.lit(r"\S+")).alias("n")))
    all_rows = stash(_keyed(docs.select("doc_id", "text")).select("_ld_id", "_ld_th", F.transform(lines, each).alias("lines")), "line-hashes")
    hashes = all_rows.select("_ld_id", "_ld_th", F.col("lines.h").alias("hashes")).filter(F.size("hashes") >= run)
    # The place of the minimum never moves back, so each fingerprint stands for adjacent windows, from lo to hi.
    minima = hashes.withColumn("w", _windows(run)).withColumn("turns", F.filter(F.sequence(F.lit(0), F.size("w") - 1), lambda i: (i == 0) | (F.get("w", i)["p"] != F.get("w", i - 1)["p"])))
    ranges = F.transform("turns", lambda i, k: F.struct(F.get("w", i)["h"].alias("h"), i.alias("lo"), (F.coalesce(F.get("turns", k + 1), F.size("w")) - 1).alias("hi")))
    prints = stash(minima.select("_ld_id", "_ld_th", F.explode(ranges).alias("r")).select("_ld_id", "_ld_th", "r.h", "r.lo", "r.hi"), "line-prints")
    often = stash(prints.groupBy("h").agg(F.count("*").alias("n")).filter("n > 1"), "line-often")
    places = having_key(prints, "h", often, prints.count()).groupBy("_ld_id", "_ld_th").agg(F.collect_set(F.struct("lo", "hi")).alias("places"))
    # The windows that a repeated fingerprint stands for: they reach both ways from its place.
    starts = F.flatten(F.transform("places", lambda r: F.sequence(r["lo"], r["hi"])))
    windows = hashes.join(places, ["_ld_id", "_ld_th"]).select("_ld_id", "_ld_th", F.explode(starts).alias("start"), "hashes")
    windows = stash(windows.select("_ld_id", "_ld_th", "start", F.lit(run).alias("size"), F.slice("hashes", F.col("start") + 1, run).alias("window")), "line-windows")
    discard(docs.sparkSession, prints, often)
    work = [all_rows]
    found = _later(windows, "line-first", work)
    if long_words is None:
        return found, work
    with_words = all_rows.select("_ld_id", "_ld_th", F.col("lines.h").alias("hashes"), F.col("lines.n").alias("words"))
    return found.unionByName(_later(stash(_long_windows(with_words, run, long_words), "line-long"), "line-long-first", work)), work


def _without(text: Column, found: Column) -> Column:
    """struct<text, n_removed>: the text without the windows (start, size) at these places among its lines that are not blank."""
    all_lines = lambda lines: F.sequence(F.lit(0), F.size(lines) - 1)

    def cut(lines: Column, gone: Column) -> Column:
        kept = F.array_join(F.transform(F.array_except(all_lines(lines), gone), lambda i: F.get(lines, i)), "\n")
        return F.struct(F.when(F.size(gone) > 0, kept).otherwise(text).alias("text"), F.size(gone).cast("long").alias("n_removed"))

    def windows(lines: Column, full: Column) -> Column:
        return let(F.array_distinct(F.flatten(F.transform(found, lambda w: F.slice(full, w["start"] + 1, w["size"])))), lambda gone: cut(lines, gone))

    done = let(_lines(text), lambda lines: let(F.filter(all_lines(lines), lambda i: _filled(F.get(lines, i))), lambda full: windows(lines, full)))
    return F.when(text.isNotNull(), done).otherwise(F.struct(F.lit(None).cast("string").alias("text"), F.lit(0).cast("long").alias("n_removed")))


def line_report(docs: DataFrame, run: int = RUN, long_words: int | None = LONG_WORDS) -> DataFrame:
    """``docs`` with the kept text in ``text`` and the numbers ``n_lines`` (all lines) and ``n_removed`` (they replace columns of these names)."""
    found, work = repeated_windows(docs, run, long_words)
    repeats = found.groupBy("_ld_id", "_ld_th").agg(F.collect_set(F.struct("start", "size")).alias("_ld_found"))
    repeats = stash(repeats.withColumn("_ld_at", F.xxhash64("_ld_id", "_ld_th")), "line-repeats")
    discard(docs.sparkSession, *work)
    marked = maybe_among(_keyed(docs).withColumn("_ld_at", F.xxhash64("_ld_id", "_ld_th")), "_ld_at", key_filter(repeats, "_ld_at", repeats.count())).withColumnRenamed("_maybe", "_ld_may")
    columns = [c for c in docs.columns if c not in ("n_lines", "n_removed")]
    n_lines = F.when(F.col("text").isNull(), 0).otherwise(F.size(_lines(F.col("text")))).cast("long")
    whole = marked.filter(~F.col("_ld_may")).select(*columns, n_lines.alias("n_lines"), F.lit(0).cast("long").alias("n_removed"))
    met = marked.filter("_ld_may").join(repeats.select("_ld_id", "_ld_th", "_ld_found"), ["_ld_id", "_ld_th"], "left")
    met = met.withColumn("_ld_out", _without(F.col("text"), F.coalesce("_ld_found", F.array().cast("array<struct<start:int,size:int>>"))))
    changed = met.select(*(F.col("_ld_out.text").alias("text") if c == "text" else c for c in columns), n_lines.alias("n_lines"), F.col("_ld_out.n_removed").alias("n_removed"))
    return whole.unionByName(changed)


def dedup_lines(docs: DataFrame, run: int = RUN, long_words: int | None = LONG_WORDS) -> DataFrame:
    """``docs`` without repeated runs of lines; a document of which nothing but blank lines is left by that goes."""
    report = line_report(docs, run, long_words)
    return report.filter((F.col("n_removed") == 0) | _filled(F.translate("text", "\n", " "))).select(*docs.columns)
