"""SpotSigs document fingerprints, with DataFrame functions only.

A spot is a word right after a common word (an anchor); its signature is the anchor and the chain of the next ``CHAIN``
content words, common words skipped. The set of a text's signatures is its fingerprint: it follows the prose and ignores
what has no common words, such as navigation. Sets are compared by Jaccard similarity; near duplicates are searched among
sets of like length only (partitions of set length, each compared with itself and the next), on the rarest signatures of a
set (so many that similar sets must share one; those of a single set are met by none), and confirmed on the whole sets. These
are rules of the pruned search that lose no link.

Defined cases: null text counts as empty; a text without a spot has one signature, of all its words, or of the text itself
where it has no word; equal texts have equal fingerprints; texts of any length are used whole; rows that repeat an id
follow each other in the order of their text's hash; a null id comes after every id; the document after the last is the
first; other columns are ignored.
"""

from __future__ import annotations

from collections import Counter

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelspark.llm._common import discard, key_filter, let, meeting, only_maybe, parallelism, stash
from panelspark.llm.grouping import link_buckets

CHAIN = 2
LEAST_PERCENT = 75
#: Common words (articles, prepositions, pronouns, auxiliaries) of the languages of the corpus.
ANCHORS = (
    "a an the is are was were be been to of in on at for with from by and or that this it as he she they you i we not have has had",
    "der die das den dem des ein eine einen einer ist sind war und oder mit von zu im in auf für nicht sich es er sie wir als auch an",
    "le la les l un une des du de est sont et ou que qui dans pour par sur pas avec ce il elle nous vous au aux en",
    "el la los las un una unos de del es son y o que en por para con no se su al lo como más pero",
)
_LAST = 2**63 - 1
#: Bytes of text in one range of ids, about; there are at least RANGES ranges for each of Spark's partitions.
RANGE_BYTES, RANGES = 1 << 24, 8


def _places(size: Column) -> Column:
    return F.when(size > 0, F.sequence(F.lit(0), size - 1)).otherwise(F.array().cast("array<int>"))


def signatures(text: Column) -> Column:
    """Distinct signatures of a text, as 48-bit hashes in ascending order."""
    anchors = sorted({w for line in ANCHORS for w in line.split()})
    whole = F.coalesce(text, F.lit(""))

    def spots(words: Column, content: Column) -> Column:
        after = lambda j: (F.get(content, j) > 0) & ((j == 0) | (F.get(content, j - 1) < F.get(content, j) - 1))
        chain = lambda j: F.xxhash64(F.get(words, F.get(content, j) - 1), *(F.get(words, F.get(content, j + k)) for k in range(CHAIN)))
        return F.transform(F.filter(_places(F.size(content) - (CHAIN - 1)), after), chain)

    def of_words(words: Column) -> Column:
        content = F.filter(_places(F.size(words)), lambda i: ~F.get(words, i).isin(anchors))
        found = let(content, lambda c: spots(words, c))
        rest = F.when(F.size(words) > 0, F.xxhash64(F.lit("words"), words)).otherwise(F.xxhash64(F.lit("text"), whole))
        return let(found, lambda s: F.when(F.size(s) > 0, s).otherwise(F.array(rest)))

    hashes = let(F.regexp_extract_all(F.lower(whole), F.lit(r"[\p{L}\p{N}]+"), F.lit(0)), of_words)
    return F.array_sort(F.array_distinct(F.transform(hashes, lambda h: F.shiftrightunsigned(h, 16))))


def fingerprint(sigs: Column) -> Column:
    """Signatures as text: 12 hexadecimal digits each."""
    return F.array_join(F.transform(sigs, lambda s: F.lower(F.lpad(F.hex(s), 12, "0"))), "")


def likeness(a: Column, b: Column) -> Column:
    """Jaccard similarity of two sets of signatures."""
    common = F.size(F.array_intersect(a, b))
    return common / (F.size(a) + F.size(b) - common)


def _rows(docs: DataFrame) -> DataFrame:
    """id (a null one last), text and a hash of it."""
    rows = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(_LAST)).alias("id"), F.coalesce("text", F.lit("")).alias("text"))
    return rows.withColumn("th", F.xxhash64("text"))


def with_next(docs: DataFrame, classes: DataFrame | None = None) -> DataFrame:
    """(doc_id, text, next_text): the text of the next document in ascending order of id, after the last that of the first.

    Rows are dealt to ranges of ids; a range learns the first row of the next one as a row of its own, at its end. An id of
    very many rows is divided further by the hash of the text. The bounds and the first ids of the ranges (one for each
    RANGE_BYTES of text, about) are all that passes through the driver.

    With ``classes`` from ``near_classes`` also class_id. A class is a row without text before the rows it is of, so that
    texts are moved once only, in the shuffle to their range.
    """
    spark = docs.sparkSession
    led = None
    if classes is not None:
        led = classes.filter(~F.col("class_id").eqNullSafe(F.col("doc_id"))).select(F.coalesce("doc_id", F.lit(_LAST)).alias("id"), "th", "class_id").distinct()
        led = stash(led, "led")
        discard(spark)  # what the search has shuffled is over, the texts come next
    rows = _rows(docs)
    size = rows.agg(F.sum(F.octet_length("text")).alias("b")).first()["b"] or 0
    parts = max(RANGES * parallelism(spark), -(-size // RANGE_BYTES))
    quantiles = Counter(int(b) for b in rows.approxQuantile("id", [k / parts for k in range(1, parts)], 0.25 / parts))
    wide = [x for x, n in quantiles.items() if n > 2]
    dealt = _range_of(F.col("id"), sorted(quantiles)).cast("long")
    if wide:
        bits = max(quantiles.values()).bit_length()
        cut = F.when(F.col("id").isin(wide), F.shiftright("th", 64 - bits) + (1 << (bits - 1))).otherwise(1 << bits)
        dealt = dealt * (2 << bits) + cut
    rows = rows.withColumn("range", dealt)
    own_id = F.when(F.col("id") != _LAST, F.col("id"))
    heads = sorted(rows.groupBy("range").agg(F.min(F.struct("id", "th")).alias("h")).select("range", "h.id", "h.th").collect())
    if not heads:
        return rows.select(F.col("id").alias("doc_id"), "text", F.col("text").alias("next_text"), *([] if led is None else [own_id.alias("class_id")]))
    after = spark.createDataFrame([(r["range"], *heads[(k + 1) % len(heads)][1:]) for k, r in enumerate(heads)], "into long, id long, th long")
    lead = rows.join(F.broadcast(after), ["id", "th"]).select("id", "text", "th", F.col("into").alias("range"), F.lit(True).alias("guest")).dropDuplicates(["range"])
    both = rows.select("id", "text", "th", "range", F.lit(False).alias("guest")).unionByName(lead)
    w = Window.partitionBy("range").orderBy("guest", "id", "th")
    if led is None:
        out = both.withColumn("next_text", F.lead("text").over(w)).filter(~F.col("guest"))
        return out.select(own_id.alias("doc_id"), "text", "next_text")
    both = both.unionByName(led.withColumns({"range": dealt, "guest": F.lit(False)}), allowMissingColumns=True)
    w = w.orderBy("guest", "id", "th", F.col("class_id").asc_nulls_last())
    known = F.last(F.when(F.col("class_id").isNotNull(), F.struct("id", "th", "class_id")), ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    # At most one class stands between two texts.
    out = both.withColumns({"next_text": F.coalesce(F.lead("text").over(w), F.lead("text", 2).over(w)), "known": known}).filter(~F.col("guest") & F.col("text").isNotNull())
    of_it = (F.col("known.id") == F.col("id")) & (F.col("known.th") == F.col("th"))
    return out.select(own_id.alias("doc_id"), "text", "next_text", F.when(of_it, F.col("known.class_id")).otherwise(own_id).alias("class_id"))


def _range_of(value: Column, bounds: list[int], fan: int = 64) -> Column:
    """Number of bounds that are at most ``value``; in two steps, so that many bounds cost little."""
    if not bounds:
        return F.lit(0)
    groups = [bounds[k : k + fan] for k in range(0, len(bounds), fan)]
    literal = lambda xs: F.array(*(F.lit(x).cast("long") for x in xs))
    upto = lambda xs: F.size(F.filter(xs, lambda b: b <= value))
    group = F.greatest(upto(literal([g[0] for g in groups])) - 1, F.lit(0))
    return let(group, lambda g: g * fan + upto(F.get(F.array(*map(literal, groups)), g))).cast("int")


def edited(text: Column, other: Column) -> Column:
    """``text`` whose last half (rounded down) is replaced by as many first code points of ``other``, or all it has."""
    n = F.char_length(text)
    half = F.floor(n / 2).cast("int")
    return F.concat(F.substring(text, F.lit(1), n - half), F.substring(other, F.lit(1), half))


def near_classes(docs: DataFrame) -> DataFrame:
    """doc_id, th (hash of the text), class_id (smallest id that links of at least LEAST_PERCENT reach) for every row of ``docs``.

    Equal fingerprints are one class from the start; classes are linked within buckets (length partition, signature).
    """
    spark = docs.sparkSession
    rows = _rows(docs).select(F.col("id").alias("doc_id"), "th", signatures(F.col("text")).alias("sigs"))
    keyed = stash(rows.withColumn("key", F.sha2(F.array_join("sigs", ","), 256)), "signatures")
    classes = stash(keyed.groupBy("key").agg(F.min(F.struct("doc_id", "th")).alias("first")).withColumn("id", F.monotonically_increasing_id()), "signature-classes")
    first = classes.select("key", "first.doc_id", "first.th", "id")
    heads = stash(keyed.join(first, ["key", "doc_id", "th"]).dropDuplicates(["id"]).select("id", "sigs"), "signature-sets")
    keys = stash(keyed.select("doc_id", "th", "key"), "signature-keys")
    discard(spark, keyed)
    spread = heads.select("id", F.size("sigs").cast("long").alias("n"), F.explode("sigs").alias("sig"))
    often = stash(spread.groupBy("sig").agg(F.count("*").alias("df")).filter("df > 1"), "shared-signatures")
    known = often.agg(F.count("*").alias("sigs"), F.sum("df").alias("rows")).first()
    near = only_maybe(spread, "sig", key_filter(often, "sig", known["sigs"]))
    shared = meeting(near, ["sig"], often.withColumn("n", F.col("df")), known["rows"] or 0).groupBy("id", "n").agg(F.array_sort(F.collect_list(F.struct("df", "sig"))).alias("s"))
    # Similar sets share one of their first n - ceil(0.75 n) + 1 signatures in any common order; here the rarest come first,
    # and of these the ones that no other set has, which are not in ``s``.
    first_ones = (F.col("n") - F.ceil(F.col("n") * LEAST_PERCENT / 100) + 1) - (F.col("n") - F.size("s"))
    prefix = F.transform(F.slice("s", F.lit(1), first_ones.cast("int")), lambda x: x["sig"])
    level = F.floor(F.log(F.col("n").cast("double")) / F.log(F.lit(100 / LEAST_PERCENT))).cast("int")
    each = stash(shared.filter(first_ones > 0).select("id", "n", level.alias("level"), F.explode(prefix).alias("sig")), "rare-signatures")
    buckets = each.select(F.explode(F.array("level", F.col("level") + 1)).alias("part"), "sig", "id", "n").select(F.xxhash64("part", "sig").alias("bucket"), "id", "n")
    company = stash(buckets.groupBy("bucket").agg(F.count("*").alias("many")).filter("many > 1").select("bucket"), "shared-buckets")
    members = stash(buckets.join(company, "bucket", "left_semi").distinct(), "signature-buckets")
    discard(spark, often, each, company)

    def alike(a: Column, b: Column) -> Column:
        both = F.size(F.array_intersect(a, b))
        within = F.least(F.size(a), F.size(b)) * 100 >= F.greatest(F.size(a), F.size(b)) * LEAST_PERCENT
        return F.when(within, 100 * both >= LEAST_PERCENT * (F.size(a) + F.size(b) - both)).otherwise(False)

    def verify(pairs: DataFrame) -> DataFrame:
        a, b = (heads.select(F.col("id").alias(x), F.col("sigs").alias(f"s{x}")) for x in ("a", "b"))
        return pairs.join(a, "a").join(b, "b").filter(alike(F.col("sa"), F.col("sb"))).select("a", "b")

    def compare(blocks: DataFrame) -> DataFrame:
        """Two blocks of a bucket are one row, so no pair but a link leaves it."""
        own = F.struct("id", "component", "sigs")
        two = blocks.join(heads, "id").groupBy("bucket", "lo", "hi").agg(F.collect_list(F.when(F.col("side") == F.col("lo"), own)).alias("xs"), F.collect_list(F.when(F.col("side") == F.col("hi"), own)).alias("ys"))
        met = lambda x, y: (x["component"] != y["component"]) & ((F.col("lo") < F.col("hi")) | (x["id"] < y["id"])) & alike(x["sigs"], y["sigs"])
        links = F.flatten(F.transform("xs", lambda x: F.transform(F.filter("ys", lambda y: met(x, y)), lambda y: F.struct(F.least(x["id"], y["id"]).alias("a"), F.greatest(x["id"], y["id"]).alias("b")))))
        return two.select(F.explode(links).alias("l")).select("l.a", "l.b").distinct()

    found = link_buckets(members, verify, LEAST_PERCENT, compare)
    linked = classes.join(found, "id").groupBy("component").agg(F.min("first.doc_id").alias("lead"))
    led = found.join(linked, "component").select("id", "lead")
    of_class = stash(classes.join(led, "id", "left").select("key", F.coalesce("lead", "first.doc_id").alias("class_id")), "classes")
    # A fingerprint of very many rows is one row of the right side; the left side of the join is split where it is skewed.
    out = stash(keys.join(of_class, "key").drop("key"), "near-classes")
    discard(spark, keys, classes, heads, members, of_class)
    return out.select(*(F.when(F.col(c) != _LAST, F.col(c)).alias(c) for c in ("doc_id", "class_id")), "th")
