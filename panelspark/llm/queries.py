"""Registered queries of the training-data operators: each applies its operator to the whole ``documents`` table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from panelspark.llm.alignment import align_tokens
from panelspark.llm.collocation import collocations
from panelspark.llm.exact_dedup import exact_dedup
from panelspark.llm.langid import fit_languages
from panelspark.llm.lattice import near_vectors
from panelspark.llm.line_dedup import line_report
from panelspark.llm.minhash import near_duplicates
from panelspark.llm.packing import pack_documents
from panelspark.llm.pieces import decode, encode
from panelspark.llm.secret_scan import RULES, scan_secrets
from panelspark.llm.spotsigs import edited, fingerprint, likeness, near_classes, signatures, with_next
from panelspark.llm.suffix_dedup import remove_repeats
from panelspark.llm.toxicity import fit_toxicity


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(documents(spark, sf_dir))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return fit_toxicity(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")).score(docs)


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(False))
    found = fit_languages(docs.filter(~held_out)).predict(docs)
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score", "ambiguous")


def op4_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("piece_bpe_32k.model")
    there_and_back = decode(encode(documents(spark, sf_dir), path), path)
    ids = F.concat_ws(",", F.col("ids").cast("array<string>"))
    return there_and_back.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(ids, 256).alias("ids_sha256"), F.sha2("text", 256).alias("decoded_sha256"))


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(documents(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json"))


def op6_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan_secrets(documents(spark, sf_dir))

    def listed(kept: Callable | None) -> Column:
        spans = F.filter("findings", kept) if kept else F.col("findings")
        return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")

    def number(kind: str) -> Column:
        return F.size(F.filter("findings", lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")

    base = ("assign", "access", "hex")
    return found.select("doc_id", *map(number, base), F.sha2(listed(lambda x: x["kind"].isin(*base)), 256).alias("base_sha256"), listed(None).alias("spans"))


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """By the rule of OP7_SQL, runs of three lines only; the pipeline's stage also takes shorter runs of many words."""
    return line_report(documents(spark, sf_dir), long_words=None).select("doc_id", "n_lines", "n_removed", F.sha2("text", 256).alias("kept_sha256"), "text")


def op8_spotsigs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three sets of signatures for each document: of its text, of its edited text, and of the next document; and class_id,
    the smallest id that near-duplicate links reach."""
    docs = documents(spark, sf_dir)
    both = with_next(docs, near_classes(docs)).withColumn("edited_text", edited(F.col("text"), F.col("next_text")))
    sets = both.select("doc_id", "class_id", F.char_length("text").cast("long").alias("n_chars"), F.sha2("edited_text", 256).alias("edited_sha256"), signatures(F.col("text")).alias("own"), signatures(F.col("edited_text")).alias("other"), signatures(F.col("next_text")).alias("next"))
    return sets.select("doc_id", "class_id", "n_chars", "edited_sha256", fingerprint(F.col("own")).alias("fingerprint"), fingerprint(F.col("other")).alias("edited_fingerprint"), likeness(F.col("own"), F.col("other")).alias("near_edited"), likeness(F.col("own"), F.col("next")).alias("near_next"))


def op9_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(documents(spark, sf_dir))


def op10_suffix_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Also n_passage_words: words that stand in a passage of over 50 words which repeats, shorter than 400 bytes or not."""
    cut = remove_repeats(documents(spark, sf_dir))
    repeated = F.aggregate("passages", F.lit(0).cast("long"), lambda n, r: n + r["end"] - r["start"])
    return cut.select("doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"), repeated.alias("n_passage_words"))


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(documents(spark, sf_dir))


def op12_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = align_tokens(documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"), digest=True)
    return found.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", F.col("groups").alias("groups_sha256"))


def op13_lattice(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


OP1_SQL = r"""
WITH t AS (
  SELECT doc_id, length(coalesce(text, '')) AS n, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS norm
  FROM documents
), g AS (
  SELECT doc_id, norm, first_value(doc_id) OVER (PARTITION BY norm ORDER BY n DESC, doc_id) AS keep_id,
         count(*) OVER (PARTITION BY norm) AS group_size
  FROM t
)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(norm) AS text_sha256 FROM g
"""


OP7_SQL = r"""
WITH l AS (
  SELECT doc_id, unnest(ls) AS line, generate_subscripts(ls, 1) AS i FROM (SELECT doc_id, string_split(text, chr(10)) AS ls FROM documents)
), f AS (
  SELECT doc_id, i, trim(line) AS t, row_number() OVER (PARTITION BY doc_id ORDER BY i) AS k
  FROM l WHERE trim(translate(line, chr(9) || chr(13) || chr(11) || chr(12), '    ')) <> ''
), w AS (
  SELECT doc_id, k, t, lead(t, 1) OVER q AS t2, lead(t, 2) OVER q AS t3 FROM f WINDOW q AS (PARTITION BY doc_id ORDER BY k)
), g AS (
  SELECT doc_id, k, row_number() OVER (PARTITION BY t, t2, t3 ORDER BY doc_id, k) AS nth FROM w WHERE t3 IS NOT NULL
), gone AS (
  SELECT DISTINCT doc_id, k + o AS k FROM g, (VALUES (0), (1), (2)) v(o) WHERE nth > 1
), cut AS (
  SELECT l.doc_id, count(*) AS n_lines, count(gone.k) AS n_removed,
         coalesce(string_agg(line, chr(10) ORDER BY l.i) FILTER (gone.k IS NULL), '') AS text
  FROM l LEFT JOIN f ON l.doc_id = f.doc_id AND l.i = f.i LEFT JOIN gone ON f.doc_id = gone.doc_id AND f.k = gone.k GROUP BY l.doc_id
)
SELECT doc_id, n_lines, n_removed, sha256(text) AS kept_sha256, text FROM cut
"""


#: Kind, version-independent order, pattern of a match, and pattern whose group 1 is measured, with the least length.
_OP6_KINDS = [(r.kind, r.pattern.replace("'", "''"), r.measured.replace("'", "''"), r.least) for r in RULES]
_OP6_MATCHES = "\n  UNION ALL\n".join(
    f"""  SELECT doc_id, {k} AS rank, '{kind}' AS kind, unnest(string_split_regex(t, '{pattern}')[1:len(regexp_extract_all(t, '{pattern}'))]) AS gap,
         unnest(regexp_extract_all(t, '{pattern}')) AS hit, generate_subscripts(regexp_extract_all(t, '{pattern}'), 1) AS nth, '{measured}' AS measured, {least} AS least FROM t"""
    for k, (kind, pattern, measured, least) in enumerate(_OP6_KINDS)
)
OP6_SQL = f"""
WITH t AS (SELECT doc_id, coalesce(text, '') AS t FROM documents), m AS (
{_OP6_MATCHES}
), e AS (
  SELECT *, sum(length(gap) + length(hit)) OVER (PARTITION BY doc_id, rank ORDER BY nth) AS stop FROM m
), f AS (
  SELECT doc_id, rank, kind, concat(kind, ':', (stop - length(hit))::BIGINT, ':', stop::BIGINT) AS span, stop - length(hit) AS start
  FROM e WHERE length(regexp_extract(hit, measured, 1)) >= least
)
SELECT t.doc_id, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access, count(*) FILTER (kind = 'hex') AS n_hex,
       sha256(coalesce(string_agg(span, ',' ORDER BY start, rank) FILTER (rank < 3), '')) AS base_sha256, coalesce(string_agg(span, ',' ORDER BY start, rank), '') AS spans
FROM t LEFT JOIN f ON t.doc_id = f.doc_id GROUP BY t.doc_id
"""

OP9_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws FROM documents
), s AS (
  SELECT DISTINCT doc_id, unnest(list_transform(range(1, greatest(len(ws) - 3, 2)), lambda i: array_to_string(ws[i:i + 4], ' '))) AS shingle FROM w WHERE len(ws) > 0
), n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id
), shared AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS common FROM s a JOIN s b ON a.shingle = b.shingle AND a.doc_id < b.doc_id GROUP BY ALL
), link AS (
  SELECT x, y FROM shared JOIN n p ON p.doc_id = x JOIN n q ON q.doc_id = y WHERE 100 * common >= 75 * (p.n + q.n - common)
), edge AS (SELECT x, y FROM link UNION ALL SELECT y, x FROM link
), reach(x, y) AS (
  SELECT doc_id, doc_id FROM documents UNION SELECT reach.x, edge.y FROM reach JOIN edge ON edge.x = reach.y
), c AS (SELECT x AS doc_id, min(y) AS component_id FROM reach GROUP BY x)
SELECT c.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, component_id, c.doc_id = component_id AS kept FROM c LEFT JOIN n ON c.doc_id = n.doc_id
"""


OP11_SQL = r"""
WITH d AS (
  SELECT coalesce(lang, 'und') AS lang, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents
), p AS (SELECT lang, unnest(regexp_split_to_array(t, '[.,;:!?\x0A-\x0D]')) AS piece FROM d
), w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS ws FROM p
), total AS (SELECT lang, sum(len(ws))::BIGINT AS n FROM w GROUP BY lang
), g AS (
  SELECT lang, k, unnest(list_transform(range(1, len(ws) - k + 2), lambda i: array_to_string(ws[i:i + k - 1], ' '))) AS phrase
  FROM w, range(1, 6) x(k) WHERE len(ws) >= k
), f AS (SELECT lang, k, phrase, count(*) AS a FROM g GROUP BY ALL HAVING count(*) >= 100
), cand AS (
  SELECT * FROM f c WHERE k > 1 AND NOT EXISTS (
    SELECT 1 FROM f o WHERE o.lang = c.lang AND o.k > c.k AND 100 * o.a >= 100 * c.a AND contains(' ' || o.phrase || ' ', ' ' || c.phrase || ' '))
), cut AS (
  SELECT c.lang, c.phrase, c.a, x.i, l.a AS l, r.a AS r, n, (1000::HUGEINT * c.a * n) // (l.a::HUGEINT * r.a) AS score
  FROM cand c JOIN total ON total.lang = c.lang JOIN range(1, 5) x(i) ON x.i < c.k
  JOIN f l ON l.lang = c.lang AND l.phrase = array_to_string(string_split(c.phrase, ' ')[1:x.i], ' ')
  JOIN f r ON r.lang = c.lang AND r.phrase = array_to_string(string_split(c.phrase, ' ')[x.i + 1:], ' ')
), best AS (SELECT * FROM cut QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, i) = 1
), ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM best)
SELECT lang, rank, phrase, a, l, r, n, score::BIGINT AS score FROM ranked WHERE rank <= 2000
"""


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {"pipeline": corpus_pipeline.run} | {f.__name__: f for f in (op1_exact_dedup, op2_toxicity, op3_language_id, op4_sentencepiece, op5_packing, op6_secrets, op7_line_dedup, op8_spotsigs, op9_minhash, op10_suffix_array, op11_collocations, op12_alignment, op13_lattice)}


def oracle_sql() -> dict[str, str]:
    return {"op1_exact_dedup": OP1_SQL, "op6_secrets": OP6_SQL, "op7_line_dedup": OP7_SQL, "op9_minhash": OP9_SQL, "op11_collocations": OP11_SQL}
