"""Phrases, tokenizer alignment and vector near-dedup against brute force."""

from __future__ import annotations

import hashlib
import random
import re
from collections import Counter

import numpy as np
import public_tokenizers
import pytest

from panelspark.llm import alignment, collocation, lattice, queries
from tests.llm.test_operators import SCHEMA, _table

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
VECTORS = "vec_id long, embedding array<float>, label int, cell string, node string, n string, component string, vector string"


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(9)
    extra = [(1000 + k, t, rng.choice(["en", "de", None]), "s", 1, "x", 1, "g", "d", "p", "i") for k, t in enumerate(["<|endoftext|> a▁b", " two  spaces\n\n x \t", "it's 12'34 　ｗ", "trailing ", "\x00\x1c y", "naïve café 日本 😀 done", "?" * 40, "one two one two one two. one two! ONE\tTWO one", "the big cat sat on it, the big dog sat on it; " * 120])]
    return [*_table(), *extra]


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def _phrases(rows, least, longest):
    """(lang, phrase) to count by brute force, and words of each language."""
    f, n = Counter(), Counter()
    for r in rows:
        text = re.sub("[A-Z]", lambda m: m[0].lower(), r[1] or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", text):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[r[2] or "und"] += len(words)
            f.update((r[2] or "und", tuple(words[i : i + k])) for k in range(1, longest + 1) for i in range(len(words) - k + 1))
    return {k: v for k, v in f.items() if v >= least}, n


def _collocations(rows, least, longest, top):
    f, n = _phrases(rows, least, longest)
    inside = {}
    for (lang, words), a in f.items():
        for k in range(1, len(words)):
            for i in range(len(words) - k + 1):
                inside[lang, words[i : i + k]] = max(inside.get((lang, words[i : i + k]), 0), a)
    out = {}
    for (lang, words), a in f.items():
        if len(words) > 1 and 100 * inside.get((lang, words), 0) < 100 * a:
            score, _, l, r = min((1000 * a * n[lang] // (f[lang, words[:k]] * f[lang, words[k:]]), k, f[lang, words[:k]], f[lang, words[k:]]) for k in range(1, len(words)))
            out.setdefault(lang, []).append((-score, -a, " ".join(words).encode(), l, r))
    return {(lang, k + 1, p.decode(), -a, l, r, n[lang], -s) for lang, found in out.items() for k, (s, a, p, l, r) in enumerate(sorted(found)[:top])}


@pytest.mark.parametrize(("least", "longest", "top", "shard"), [(100, 5, 2000, 1 << 20), (3, 5, 2000, 1 << 20), (2, 4, 7, 200), (4, 7, 50, 1000), (2, 2, 10, 64)])
def test_collocations(docs, rows, monkeypatch, least, longest, top, shard):
    monkeypatch.setattr(collocation, "SHARD_WORDS", shard)
    got = [tuple(r) for r in collocation.collocations(docs, least, longest, top).collect()]
    want = _collocations(rows, least, longest, top)
    assert len(want) > 3 and set(got) == want and len(got) == len(want)


def test_phrase_counts_give_extensions(docs, rows, empty):
    counts, totals = collocation.phrase_counts(docs, 5, 4)
    f, n = _phrases(rows, 5, 4)
    got = {(r["lang"], tuple(r["phrase"].split(" "))): r for r in counts.collect()}
    assert {k: r["f"] for k, r in got.items()} == f and {r["lang"]: r["n"] for r in totals.collect()} == dict(n)
    for (lang, words), r in got.items():
        if 1 < len(words) < 4:
            assert r["right"] == max((v for (g, w), v in f.items() if g == lang and w[:-1] == words), default=None)
            most = max((v for (g, w), v in f.items() if g == lang and w[1:] == words), default=None)
            assert r["left"] == (most if most == r["f"] else None)
    assert collocation.collocations(empty).count() == 0


def test_sorted_contexts():
    rng = np.random.default_rng(3)
    seq = np.r_[rng.integers(0, 4, 300), 0]
    for depth in (1, 2, 3, 5, 7):
        for step in (1, -1):
            keys = [[int(seq[(i + step * d) % len(seq)]) for d in range(depth)] for i in range(len(seq))]
            assert [keys[i] for i in collocation.sorted_contexts(seq, depth, step)] == sorted(keys)


def _aligned(rows):
    import sentencepiece
    from tokenizers import Tokenizer
    from tokenizers.decoders import ByteLevel  # noqa: F401

    a = Tokenizer.from_file(A)
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=B)
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    byte_of = {chr(x): x for x in printable} | {chr(256 + k): x for k, x in enumerate(x for x in range(256) if x not in printable)}
    found, count = [], Counter()
    for r in rows:
        found.append((r[0], None))
        if not r[1]:
            continue
        ea, ib = a.encode(" " + r[1], add_special_tokens=False), b.encode(r[1])
        ba = [bytes(byte_of[c] for c in t) for t in ea.tokens]
        bb = [bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode() for i in ib]
        if b"".join(ba) != (" " + r[1]).encode() or b"".join(bb) != b"".join(ba):
            continue
        links, groups, x, y, ends = [], [([], [])], 0, 0, (np.cumsum([len(t) for t in ba]), np.cumsum([len(t) for t in bb]))
        groups[-1][0].append(ea.ids[0])
        groups[-1][1].append(ib[0])
        while True:
            links.append((ea.ids[x], ib[y]))
            if ends[0][x] == ends[1][y]:
                x, y = x + 1, y + 1
                if x == len(ba):
                    break
                groups.append(([ea.ids[x]], [ib[y]]))
            elif ends[0][x] < ends[1][y]:
                x += 1
                groups[-1][0].append(ea.ids[x])
            else:
                y += 1
                groups[-1][1].append(ib[y])
        found[-1] = (r[0], (len(ba), len(bb), groups, links))
        count.update(set(links))
    top = {}
    for (i, _), n in count.items():
        top[i] = max(top.get(i, 0), n)
    out = []
    for i, f in found:
        if f is None:
            out.append((i, 0, 0, 0, 0, "", 0, 0))
        else:
            text = ";".join(f"{','.join(map(str, p))}|{','.join(map(str, q))}" for p, q in f[2])
            out.append((i, f[0], f[1], len(f[2]), len(f[3]), text, sum(count[k] == top[k[0]] for k in f[3]), sum(count[k] for k in f[3])))
    return out


@pytest.mark.parametrize(("shard", "cache", "joined"), [(1 << 20, 500_000, 256), (300, 50, 3)])
def test_alignment(docs, rows, empty, monkeypatch, shard, cache, joined):
    monkeypatch.setattr(alignment, "SHARD_UNITS", shard)
    monkeypatch.setattr(alignment, "CACHE_UNITS", cache)
    monkeypatch.setattr(alignment, "JOINED", joined)
    got = [tuple(r) for r in alignment.align_tokens(docs, A, B).collect()]
    assert Counter(got) == Counter(_aligned(rows))
    assert any(g[1] == 0 and g[5] == "" for g in got)
    digests = Counter((r["doc_id"], r["groups"]) for r in alignment.align_tokens(docs, A, B, digest=True).collect())
    assert digests == Counter((g[0], hashlib.sha256(g[5].encode()).hexdigest() if g[5] else "") for g in got)
    assert alignment.align_tokens(empty, A, B).count() == 0


def test_alignment_of_random_strings():
    rng = random.Random(4)
    letters = "aabbeeestt  \n\t'.,09éß日😀 　\x1c<|>▁_-ABC"
    texts = ["".join(rng.choice(letters) for _ in range(rng.randint(1, 60))) for _ in range(600)]
    aligner = alignment.Aligner(A, B)
    want = {i: w for i, *w in _aligned([(k, t) for k, t in enumerate(texts)])}
    for k, t in enumerate(texts):
        found = aligner.align(alignment.units_of(t))
        good = bool(found.good.all())
        assert [int(found.n_a.sum()), int(found.n_b.sum()), int(found.n_groups.sum()), int(found.n_links.sum()), ";".join(found.texts)] == want[k][:5] if good else want[k][0] == 0


def test_components_end_at_the_last_token():
    a, b = np.array([2, 5, 6, 9, 10]), np.array([1, 4, 6, 7, 10])
    assert alignment.components(a, b).tolist() == [7, 7, 7, 9, 9, 7, 7, 7, 9, 9]


def _vectors():
    rng = np.random.default_rng(7)
    base = rng.normal(size=(40, 32))
    rows = [(k, base[k].tolist()) for k in range(40)]
    for k in range(30):  # near vectors, just above and just below the threshold
        u = base[k] / np.linalg.norm(base[k])
        w = rng.normal(size=32)
        w -= (w @ u) * u
        c = (0.96, 0.99, 0.93)[k % 3]
        rows.append((100 + k, (3 * (c * u + np.sqrt(1 - c * c) * w / np.linalg.norm(w))).tolist()))
    rows += [(200 + k, base[0].tolist()) for k in range(25)] + [(300 + k, (base[1] + rng.normal(size=32) * 0.03).tolist()) for k in range(60)]
    rows += [(400, None), (401, []), (402, [0.0] * 32), (403, [1.0, None] + [0.0] * 30), (404, [float("nan")] * 32), (405, [float("inf")] + [0.0] * 31), (406, [1.0, 2.0]), (407, [2.0, 4.0]), (None, base[2].tolist()), rows[3], rows[3]]
    return rows


def _linked(rows):
    unit = {}
    for k, (_, v) in enumerate(rows):
        if v and all(x is not None and np.isfinite(x) for x in v) and any(v):
            x = np.array(v, np.float32).astype(float)
            unit[k] = x / np.linalg.norm(x)
    key = [2**63 - 1 if i is None else i for i, _ in rows]
    links = {k: [j for j in unit if j != k and len(unit[j]) == len(unit[k]) and unit[j] @ unit[k] >= 0.95] if k in unit else [] for k in range(len(rows))}
    lead = {}
    for k in range(len(rows)):
        seen, todo = {k}, [k]
        while todo:
            for j in links[todo.pop()]:
                if j not in seen:
                    seen.add(j)
                    todo.append(j)
        lead[k] = min(key[j] for j in seen)
    real = lambda i: None if i == 2**63 - 1 else i
    return Counter((real(key[k]), len(links[k]), real(lead[k]), key[k] == lead[k]) for k in range(len(rows)))


@pytest.mark.parametrize(("block", "together"), [(1024, 1 << 14), (7, 20)])
def test_near_vectors(spark, monkeypatch, block, together):
    monkeypatch.setattr(lattice, "BLOCK", block)
    monkeypatch.setattr(lattice, "TOGETHER", together)
    rows = _vectors()
    table = spark.createDataFrame([(i, v, 1, "a", "b", "c", "d", "e") for i, v in rows], VECTORS).repartition(3)
    assert Counter(tuple(r) for r in lattice.near_vectors(table).collect()) == _linked(rows)
    assert lattice.near_vectors(table.limit(0)).count() == 0


def test_op13_query_on_whole_tables(spark, tmp_path):
    rows = _vectors()
    spark.createDataFrame([(i, v, 1, "a", "b", "c", "d", "e") for i, v in rows], VECTORS).write.parquet(f"{tmp_path}/embeddings.parquet")
    assert Counter(tuple(r) for r in queries.op13_lattice(spark, str(tmp_path)).collect()) == _linked(rows)


def test_op13_query_on_an_empty_table(spark, tmp_path):
    spark.createDataFrame([], VECTORS).write.parquet(f"{tmp_path}/embeddings.parquet")
    assert queries.op13_lattice(spark, str(tmp_path)).count() == 0


def test_lattice_points_and_recall():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(500, 8)) * 2
    near = lattice.nearest(x)
    assert ((near * 2) % 1 == 0).all() and (near.sum(axis=1) % 2 == 0).all() and (((x - near) ** 2).sum(axis=1) <= 1 + 1e-9).all()
    for move in lattice._shortest():
        assert (((x - near) ** 2).sum(axis=1) <= ((x - near - move) ** 2).sum(axis=1) + 1e-9).all()
    u = rng.normal(size=(3000, 64))
    u /= np.linalg.norm(u, axis=1, keepdims=True)
    w = rng.normal(size=u.shape)
    w -= (w * u).sum(axis=1, keepdims=True) * u
    v = 0.95 * u + np.sqrt(1 - 0.95**2) * w / np.linalg.norm(w, axis=1, keepdims=True)
    cells = lattice.Cells(64)
    a, b = cells.of(u), cells.of(v)
    meet = ((a[:, :, :1] == b).any(axis=2) | (b[:, :, :1] == a).any(axis=2)).any(axis=1)
    assert meet.mean() > 0.99


def test_mixed_and_foreign_texts_are_ambiguous(spark):
    """Texts of one language are told and sure; halves of two and letters of another alphabet are not."""
    from panelspark.llm import langid

    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    held = "crc32(cast(doc_id as string)) % 4 = 2"
    model = langid.fit_languages(docs.filter(f"not {held}"))
    predict = model.predictor()
    rows = [(r["lang"], r["text"]) for r in docs.filter(held).collect() if r["text"] and len(r["text"]) > 400]
    found = [(lang, *predict(text)) for lang, text in rows]
    assert np.mean([lang == got for lang, got, _, _ in found]) > 0.99
    assert np.mean([unsure for *_, unsure in found]) < 0.05
    by = {lang: [t for x, t in rows if x == lang] for lang in model.langs}
    mixed = [predict(a[: (n := min(len(a), len(b)))] + " " + b[:n]) for p, q in (("de", "en"), ("fr", "es"), ("en", "fr")) for a, b in zip(by[p][:15], by[q][:15], strict=False)]
    assert np.mean([unsure for _, _, unsure in mixed]) > 0.5 and np.mean([score for _, score, _ in mixed]) < 0.9
    for text in ("Съешь ещё этих мягких французских булок да выпей чаю", "これは日本語の文章です", "Η γρήγορη αλεπού"):
        assert predict(text)[2] and predict(text)[1] < 0.5
    assert len(set(np.round(model.bit_weight, 6))) > 0 and predict("12345 !!") == ("und", 0.0, True)
