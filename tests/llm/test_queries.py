"""Every registered opN_ query, with production parameters, against brute force on the hostile table."""

from __future__ import annotations

import hashlib
import math
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from panelspark.llm import langid, packing, queries, toxicity
from tests.llm.test_operators import SCHEMA, _components, _lines_left, _passages, _secrets, _shingles, _signatures, _table

NO_ID = 2**63 - 1
sha = lambda b: hashlib.sha256(b if isinstance(b, bytes) else b.encode()).hexdigest()


@pytest.fixture(scope="module")
def rows():
    """As in a table whose ids are distinct; one row has none."""
    seen, out = set(), []
    for r in _table():
        if r[0] not in seen:
            seen.add(r[0])
            out.append(r)
    return out


@pytest.fixture(scope="module")
def sf(spark, rows, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("sf"))
    spark.createDataFrame(rows, SCHEMA).repartition(3).write.parquet(f"{path}/documents.parquet")
    marks = [(i, 1, int(i % 4 == 0)) for i in range(5, 40)] + [(7, 1, 1), (None, 1, 1), (9, 1, None), (10**6, 0, 1)]
    spark.createDataFrame(marks, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    return path


@pytest.fixture(scope="module")
def nothing(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("empty"))
    spark.createDataFrame([], SCHEMA).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    return path


@pytest.mark.parametrize("name", sorted(queries.queries()))
def test_empty_tables(spark, nothing, name):
    assert queries.queries()[name](spark, nothing).count() == 0


def test_op1(spark, sf, rows):
    norm = lambda t: "".join(c for c in t or "" if c not in " \t\n\v\f\r")
    groups = defaultdict(list)
    for r in rows:
        groups[norm(r[1])].append((-len(r[1] or ""), NO_ID if r[0] is None else r[0], r[0]))
    want = {(r[0], min(groups[norm(r[1])])[2], len(groups[norm(r[1])]), r[0] == min(groups[norm(r[1])])[2], sha(norm(r[1]))) for r in rows}
    assert {(r["doc_id"], r["keep_id"], r["group_size"], r["kept"], r["text_sha256"]) for r in queries.op1_exact_dedup(spark, sf).collect()} == want


def _severity(model, text):
    """(expected severity, P(grade > 0), grade), term by term."""
    words = toxicity.WORD.findall((text or "").lower())
    tf = Counter(k for w in words for k in toxicity._keys(w))
    total = sum(float(model.weights[k]) * math.log(1 + 100 * n / len(words)) for k, n in tf.items())
    above = [1 / (1 + math.exp(min(max(t - total, -40), 40))) for t in model.thresholds]
    if not np.isfinite(model.thresholds).all():
        above = [0.0, 0.0]
    chance = [1 - above[0], above[0] - above[1], above[1]]
    return sum(above), above[0], chance.index(max(chance))


def test_op2(spark, sf, rows):
    text = {r[0]: r[1] for r in rows}
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    model = toxicity.fit_toxicity(docs, labels)
    got = queries.op2_toxicity(spark, sf).collect()
    assert Counter(r["doc_id"] for r in got) == Counter(list(text))
    for r in got:
        severity, p, grade = _severity(model, text[r["doc_id"]])
        assert r["severity"] == pytest.approx(severity, abs=1e-4) and r["p_toxic"] == pytest.approx(p, abs=1e-4)
        assert r["rejected"] == (r["p_toxic"] >= toxicity.REJECT) and (r["grade"] == grade or abs(p - 0.5) < 1e-3)


def test_op3(spark, sf, rows):
    text = {r[0]: r[1] for r in rows}
    held = {i: zlib.crc32(str(i).encode()) % 4 == 2 if i is not None else False for i in text}
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    model = langid.fit_languages(docs.filter(F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 != 2, F.lit(True))))
    got = queries.op3_language_id(spark, sf).collect()
    assert {r["doc_id"]: r["held_out"] for r in got} == held and len(got) == len(rows)
    for r in got:
        t = text[r["doc_id"]]
        if not any(c.isalpha() for c in t or ""):
            assert (r["lang_pred"], r["score"]) == ("und", 0.0)
            continue
        grams = Counter(langid.ngrams(t).tolist())
        own = [c for c in t.lower() if c.isalpha()]
        share = sum(c in model.alphabet for c in own) / len(own)

        def losses(weights, bias, grams=grams, share=share):
            f = (sum(n * weights[g].astype(float) for g, n in grams.items()) / sum(grams.values()) + bias) * share
            return [sum(w * math.log(1 + math.exp(-c * x)) for w, c, x in zip(model.bit_weight, code, f, strict=True)) for code in model.code.tolist()]

        first = int(np.argmin(losses(model.weights, model.bias)))
        loss = losses(model.mixed_weights, model.mixed_bias)
        chance = [math.exp(min(loss) - x) for x in loss]
        assert r["lang_pred"] == model.langs[first]
        assert r["score"] == pytest.approx(chance[first] / sum(chance), abs=1e-4)


def test_op4(spark, sf, rows):
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    want = set()
    for r in rows:
        ids = library.encode(r[1] or "")
        want.add((r[0], len(ids), sha(",".join(map(str, ids))), sha(library.decode(ids))))
    assert {(r["doc_id"], r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in queries.op4_sentencepiece(spark, sf).collect()} == want


def test_op5(spark, sf, rows):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    want = set()
    for r in rows:
        ids = np.array([*tokenizer.encode(r[1] or "", add_special_tokens=False).ids, 0], "<u4")
        want |= {(r[0], k // 2048, k, len(ids[k : k + 2048]), zlib.crc32(ids[k : k + 2048].tobytes())) for k in range(0, len(ids), 2048)}
    got = queries.op5_packing(spark, sf).collect()
    assert {(r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in got} == want and len(got) == len(want)
    bins = defaultdict(list)
    for r in got:
        bins[r["sequence_id"]].append((r["offset"], r["length"]))
    for placed in bins.values():
        at = 0
        for offset, length in sorted(placed):
            assert offset == at
            at += length
        assert at <= 2048
    assert len(bins) <= 1 + packing.lower_bound(np.array([r["length"] for r in got]), 2048)


def test_op6(spark, sf, rows):
    want = {}
    for r in rows:
        found = _secrets(r[1] or "")
        want[r[0]] = (*(sum(f[2] == k for f in found) for k in ("assign", "access", "hex")), sha(",".join(f"{k}:{a}:{b}" for a, _, k, b in found)))
    got = queries.op6_secrets(spark, sf).collect()
    assert {r["doc_id"]: (r["n_assign"], r["n_access"], r["n_hex"], r["base_sha256"]) for r in got} == want and len(got) == len(rows)
    for r in got:
        base = [x for x in r["spans"].split(",") if x.split(":")[0] in ("assign", "access", "hex")]
        assert sha(",".join(base)) == r["base_sha256"]


def test_op7(spark, sf, rows):
    want = _lines_left(rows, 3)
    for r in queries.op7_line_dedup(spark, sf).collect():
        if r["text"] is not None:
            assert (r["text"], r["n_removed"], r["kept_sha256"]) == (*want[r["doc_id"]], sha(want[r["doc_id"]][0]))


def test_op8(spark, sf, rows):
    order = sorted((NO_ID if r[0] is None else r[0], r[1] or "") for r in rows)
    sets = {i: _signatures(t) for i, t in order}
    classes = _components(sets, 75)
    share = lambda a, b: len(a & b) / len(a | b)
    got = {NO_ID if r["doc_id"] is None else r["doc_id"]: r for r in queries.op8_spotsigs(spark, sf).collect()}
    assert len(got) == len(order)
    prints = defaultdict(set)
    for k, (i, t) in enumerate(order):
        following = order[(k + 1) % len(order)]
        half = len(t) // 2
        edited = t[: len(t) - half] + following[1][:half]
        r = got[i]
        assert (r["n_chars"], r["edited_sha256"]) == (len(t), sha(edited))
        assert len(r["fingerprint"]) == 12 * len(sets[i]) and len(r["edited_fingerprint"]) == 12 * len(_signatures(edited))
        assert r["near_edited"] == pytest.approx(share(sets[i], _signatures(edited)))
        assert r["near_next"] == pytest.approx(share(sets[i], sets[following[0]]))
        assert (NO_ID if r["class_id"] is None else r["class_id"]) == classes[i]
        prints[frozenset(sets[i])].add(r["fingerprint"])
    assert all(len(p) == 1 for p in prints.values()) and len({x for p in prints.values() for x in p}) == len(prints)


def test_op9(spark, sf, rows):
    sets = {NO_ID if r[0] is None else r[0]: _shingles(r[1]) for r in rows}
    want = _components(sets, 75)
    real = lambda k: None if k == NO_ID else k
    assert {(r["doc_id"], r["n_shingles"], r["component_id"], r["kept"]) for r in queries.op9_minhash(spark, sf).collect()} == {(real(k), len(s), real(want[k]), want[k] == k) for k, s in sets.items()}


def test_op10(spark, sf, rows):
    raw = [(r[0], (r[1] or "").encode()) for r in rows]
    count = Counter(b[k : k + 400] for _, b in raw for k in range(len(b) - 399))
    words = {key[0]: sum(hi - lo for lo, hi in key[1]) for key in _passages(raw, 51)}
    want = set()
    for i, b in raw:
        gone = np.zeros(len(b), bool)
        for k in range(len(b) - 399):
            if count[b[k : k + 400]] > 1:
                gone[k : k + 400] = True
        runs = int((np.diff(np.r_[0, gone.astype(int)]) == 1).sum())
        want.add((i, len(b), int(gone.sum()), runs, sha(bytes(np.frombuffer(b, np.uint8)[~gone])), words[i]))
    assert {(r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"], r["n_passage_words"]) for r in queries.op10_suffix_array(spark, sf).collect()} == want


def test_pipeline_on_the_hostile_table(spark, sf, rows):
    """Null texts, repeated rows, a null id, other columns: every stage keeps the columns, and all that is left is packed."""
    import corpus_pipeline as cp

    docs = spark.read.parquet(f"{sf}/documents.parquet")
    columns = docs.columns
    for name, stage in cp.STAGES[:-1]:
        docs = cp.stash(stage(spark, docs.unionByName(docs.limit(3)) if name == "line_dedup" else docs, sf), f"hostile-{name}")
        assert docs.columns == columns
    left = Counter(r["doc_id"] for r in docs.collect())
    packed = cp.STAGES[-1][1](spark, docs, sf).collect()
    assert Counter(r["doc_id"] for r in packed if r["piece"] == 0) == left
