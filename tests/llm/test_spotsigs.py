"""Classes of SpotSigs beside the next document: what is moved, and rows that repeat an id."""

from __future__ import annotations

import random
from collections import Counter

from panelspark.llm import queries, spotsigs

SCHEMA = "doc_id long, text string"


def _copies(n: int, copies: int, words: int) -> list[tuple[int, str]]:
    """``copies`` near copies of each of ``n`` texts; row i is one of text i % n."""
    rng = random.Random(3)
    texts = [" ".join(f"the {rng.getrandbits(32):08x}" for _ in range(words)) for _ in range(n)]
    return [(n * j + k, f"{t} {j}") for j in range(copies) for k, t in enumerate(texts)]


def test_op8_moves_texts_once(spark, tmp_path):
    """Texts that have near duplicates are shuffled to their range of ids, and nowhere else."""
    table = _copies(60, 5, 300)
    spark.createDataFrame(table, SCHEMA).repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    found = queries.op8_spotsigs(spark, str(tmp_path))
    core = spark.sparkContext._jsc.sc()

    def shuffled() -> int:
        core.listenerBus().waitUntilEmpty(30_000)
        executors = core.statusStore().executorList(False)
        return sum(executors.apply(k).totalShuffleWrite() for k in range(executors.size()))

    before = shuffled()
    found.write.parquet(f"{tmp_path}/out")
    moved = shuffled() - before
    assert {(r["doc_id"], r["class_id"]) for r in spark.read.parquet(f"{tmp_path}/out").collect()} == {(i, i % 60) for i, _ in table}
    size = sum(len(t) for _, t in table)
    assert size / 3 < moved < 1.2 * size


def test_next_and_class_of_repeated_ids(spark):
    """Classes stand between the texts of a range; ids that repeat, also without end, and null ids take none from each other."""
    table = [*_copies(20, 3, 40), *_copies(20, 1, 40), (None, "the lone text without an id"), (None, _copies(20, 1, 40)[7][1]), *[(31, f"the other {k} text of it") for k in range(200)], (4, None), (4, ""), (31, "")]
    docs = spark.createDataFrame(table, SCHEMA).repartition(3)
    classes = spotsigs.near_classes(docs)
    known = {(r["doc_id"], r["th"]): r["class_id"] for r in classes.collect()}
    assert any(i is not None and c != i for (i, _), c in known.items())
    hashes = {r["text"]: r["th"] for r in spotsigs._rows(docs).select("text", "th").distinct().collect()}
    order = sorted((2**63 - 1 if i is None else i, hashes[t or ""], i, t or "") for i, t in table)
    want = Counter((i, t, order[(k + 1) % len(order)][3], known[i, h]) for k, (_, h, i, t) in enumerate(order))
    assert Counter(map(tuple, spotsigs.with_next(docs, classes).collect())) == want
    assert Counter(map(tuple, spotsigs.with_next(docs).collect())) == Counter(x[:3] for x in want.elements())


def test_no_rows(spark):
    empty = spark.createDataFrame([], SCHEMA)
    found = spotsigs.with_next(empty, spotsigs.near_classes(empty))
    assert found.columns == ["doc_id", "text", "next_text", "class_id"] and found.count() == 0
