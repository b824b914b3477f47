"""Connected components, and links inside buckets of candidates, without pairing all members of a bucket."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelspark.llm._common import discard, meeting, stash


def connected_components(edges: DataFrame) -> DataFrame:
    """(id, component): the smallest id that each end of ``edges`` (a, b) reaches, by alternating large and small stars."""
    now = stash(edges.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "stars")
    before = None
    while True:
        shape = now.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
        if shape == before or not shape["n"]:
            break
        before = shape
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        # A work table: the join then has a shuffle on either side, and Spark can split an id of very many links.
        least = stash(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), "star-least")
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct()
        down = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(down, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(down.select("u", F.col("m").alias("v")))
        last, now = now, stash(small.filter("u <> v").distinct(), "stars")
        discard(edges.sparkSession, last, least)
    roots = now.select(F.col("v").alias("id")).distinct().select("id", F.col("id").alias("component"))
    return now.groupBy("u").agg(F.min("v").alias("component")).select(F.col("u").alias("id"), "component").unionByName(roots.join(now.select(F.col("u").alias("id")), "id", "left_anti"))


#: Members of a bucket in one block of comparison.
BLOCK = 400


def link_buckets(members: DataFrame, verify: Callable[[DataFrame], DataFrame], least_percent: int, compare: Callable[[DataFrame], DataFrame], block: int = BLOCK) -> DataFrame:
    """(id, component) of ids that verified links join; ``members`` (bucket, id, n) share a bucket if they may be linked.

    First every member is compared with the hub of its bucket: the member that meets most others over all its buckets, so
    that copies of one text meet that text; ``verify`` keeps the true ones of pairs (a, b). Where a bucket then still holds
    more than one component, its members are dealt to blocks, those of its largest component apart, and every two blocks
    that may hold members of different components are compared as one group by ``compare`` (rows bucket, lo, hi, id,
    component, side in; of each group (bucket, lo, hi) enough links (a, b) out to join what is linked across components).
    Buckets of the same members are compared once. After that no link between two members of a bucket is missing, whatever
    its size. ``n`` is a size: pairs of which the smaller is under ``least_percent`` of the larger cannot be linked.
    """
    spark = members.sparkSession
    total = members.count()
    many = stash(members.groupBy("bucket").agg(F.count("*").alias("n")).withColumn("many", F.col("n")), "bucket-sizes")
    degree = meeting(members, ["bucket"], many, total).groupBy("id").agg(F.sum("many").alias("degree"))
    ranked = stash(members.join(degree, "id"), "members")
    hub = ranked.groupBy("bucket").agg(F.max(F.struct("degree", (-F.col("id")).alias("order"), "n")).alias("h"), F.count("*").alias("n"))
    hub = stash(hub.select("bucket", "n", (-F.col("h.order")).alias("a"), F.col("h.n").alias("an")), "hubs")
    close = F.least("an", "bn") * 100 >= F.greatest("an", "bn") * least_percent
    met = meeting(ranked.select("bucket", F.col("id").alias("b"), F.col("n").alias("bn")), ["bucket"], hub, total).filter((F.col("a") != F.col("b")) & close)
    tried = stash(met.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "pairs")
    links = stash(verify(tried), "links")
    found = stash(connected_components(links), "found")
    held = stash(members.join(found, "id", "left").select("bucket", "id", F.coalesce("component", "id").alias("component")), "held")
    discard(spark, ranked, hub, many, tried)
    # Of each bucket: its largest component, the numbers in and out of it, and a name of its set of members.
    parts = held.groupBy("bucket", "component").agg(F.count("*").alias("n"), *(F.sum(F.xxhash64("id", F.lit(k)).cast("decimal(38,0)")).alias(f"h{k}") for k in (1, 2)))
    of_bucket = parts.groupBy("bucket").agg(F.max(F.struct("n", "component")).alias("top"), F.sum("n").alias("n"), F.sum("h1").alias("h1"), F.sum("h2").alias("h2"))
    mixed = of_bucket.filter("top.n < n").groupBy("n", "h1", "h2").agg(F.min(F.struct("bucket", F.col("top.component").alias("main"), F.col("top.n").alias("inside"))).alias("b"))
    mixed = stash(mixed.select("b.bucket", "b.main", "n", F.ceil(F.col("b.inside") / block).cast("int").alias("inner"), F.ceil((F.col("n") - F.col("b.inside")) / block).cast("int").alias("outer")), "mixed")
    mine = meeting(held, ["bucket"], mixed, total).withColumn("is_main", F.col("component") == F.col("main"))
    # Blocks of members outside the largest component are numbered from 0, those inside it follow; two of the latter need no comparison.
    deal = lambda blocks: F.pmod(F.xxhash64("id"), blocks).cast("int")
    side = F.when(F.col("is_main"), F.col("outer") + deal(F.col("inner"))).otherwise(deal(F.col("outer")))
    last = F.when(F.col("is_main"), F.col("outer")).otherwise(F.col("outer") + F.col("inner")) - 1
    dealt = mine.withColumn("side", side).withColumn("other", F.explode(F.sequence(F.lit(0), last)))
    blocks = dealt.select("bucket", F.least("side", "other").alias("lo"), F.greatest("side", "other").alias("hi"), "id", "component", "side")
    more = stash(compare(blocks), "links")
    discard(spark, held, mixed)
    joined = connected_components(links.unionByName(more))
    discard(spark, links, more)
    return joined
