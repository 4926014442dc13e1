"""The registered queries of the operators and their oracle SQL.

Every query applies its operator to the whole table with the parameters
below; the operators themselves are general.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (alignment, divergence, imatch, impact, jaccard, linededup, mixing, multiindex, packing, sharding,
               substrings, tokenfile, toxicity)

MIN_SITES = 10
SHARDS = 16
SCALE = 64
EMBEDDING_DIM = 64
WINDOW = 35
SEQUENCE = 4096
FILE_END_ID = 2
PACK_END_ID = 1
MIX_CAP = 3


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def line_digest(cleaned: DataFrame) -> DataFrame:
    return cleaned.select("doc_id", "n_lines", "n_removed",
                          F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


def op1_jaccard_join(spark, sf_dir):
    """Near-duplicate components of all documents."""
    return jaccard.link_documents(_table(spark, sf_dir, "documents")) \
        .select("doc_id", "n_shingles", "component_id")


def op2_line_dedup(spark, sf_dir):
    """Boilerplate lines (10 sources or more) cut from all documents."""
    return line_digest(linededup.dedup_lines(_table(spark, sf_dir, "documents"), MIN_SITES))


def vocabulary(name: str) -> str:
    """The installed public vocabulary file, at one path on every machine."""
    import public_tokenizers

    return str(public_tokenizers.path(name))


def op3_exact_top_k(spark, sf_dir):
    """The 20 largest inner products of every 20th vector with all others."""
    vectors = impact.quantised(_table(spark, sf_dir, "embeddings"), SCALE)
    index = impact.build_index(vectors)
    return impact.search_index(index, vectors.filter("vec_id % 20 = 0"), EMBEDDING_DIM, 20)


def op4_substring_dedup(spark, sf_dir):
    """Words under repeated 35-word windows cut from all documents."""
    return substrings.remove_repeats(_table(spark, sf_dir, "documents"), WINDOW, texts=False) \
        .withColumnRenamed("kept", "kept_sha256")


def op5_token_files(spark, sf_dir):
    """All documents written as wavelet-matrix token files and read back."""
    path = tokenfile.write_token_files(_table(spark, sf_dir, "documents"),
                                       vocabulary("byte_bpe_50k.json"), FILE_END_ID)
    return tokenfile.read_documents(spark, path)


def op6_toxicity(spark, sf_dir):
    """All documents scored by their nearest labelled examples."""
    docs, labels = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")
    return toxicity.score_documents(docs, labels).select(
        "doc_id", toxicity.held_out(F.col("doc_id")).alias("held_out"), "score",
        (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted"))


def op7_nearest_neighbours(spark, sf_dir):
    """The 5 nearest found of every 50th vector among all others."""
    vectors = multiindex.usable_vectors(_table(spark, sf_dir, "embeddings"))
    return multiindex.search_multi_index(vectors, vectors.filter("vec_id % 50 = 0"), 5)


def op9_best_fit_packing(spark, sf_dir):
    """All documents packed into sequences of at most 4096 tokens."""
    return packing.pack_documents(_table(spark, sf_dir, "documents"),
                                  vocabulary("word_bpe_49k.json"), PACK_END_ID, SEQUENCE)


def op8_mix_sources(spark, sf_dir):
    """All documents mixed to their sources' targets."""
    return mixing.mix_sources(_table(spark, sf_dir, "documents"), MIX_CAP) \
        .select("doc_id", "size", "source_size", "target", "taken")


def op10_shard_documents(spark, sf_dir):
    """All documents dealt uniformly into 16 shards."""
    return sharding.shard_documents(_table(spark, sf_dir, "documents"), SHARDS)


def op11_source_divergence(spark, sf_dir):
    """How the sources of each language differ, and the terms each of them overuses."""
    return divergence.audit_sources(_table(spark, sf_dir, "documents"))


def op12_document_fingerprints(spark, sf_dir):
    """All documents and their edited forms fingerprinted, and how alike the fingerprints are."""
    return imatch.fingerprint_documents(_table(spark, sf_dir, "documents"))


def op13_tokenizer_alignment(spark, sf_dir):
    """The ids of two tokenizers aligned over all documents."""
    return alignment.align_documents(_table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"),
                                     vocabulary("piece_bpe_32k.model"))


QUERIES = {
    "op1_jaccard_join": op1_jaccard_join,
    "op2_line_dedup": op2_line_dedup,
    "op3_exact_top_k": op3_exact_top_k,
    "op4_substring_dedup": op4_substring_dedup,
    "op5_token_files": op5_token_files,
    "op6_toxicity": op6_toxicity,
    "op7_nearest_neighbours": op7_nearest_neighbours,
    "op8_mix_sources": op8_mix_sources,
    "op9_best_fit_packing": op9_best_fit_packing,
    "op10_shard_documents": op10_shard_documents,
    "op11_source_divergence": op11_source_divergence,
    "op12_document_fingerprints": op12_document_fingerprints,
    "op13_tokenizer_alignment": op13_tokenizer_alignment,
}

LINES_SQL = f"""
WITH lines AS (
  SELECT doc_id, md5(coalesce(text, '')) AS fp, coalesce(source, chr(0)) AS site,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos,
         unnest(string_split(coalesce(text, ''), chr(10))) AS raw
  FROM documents),
known AS (
  SELECT trim(raw, ' ' || chr(9) || chr(11) || chr(12) || chr(13)) AS line, min(doc_id) AS holder
  FROM lines GROUP BY 1
  HAVING line <> '' AND count(DISTINCT site) >= {MIN_SITES}),
marked AS (
  SELECT l.doc_id, l.fp, l.pos, l.raw,
         trim(raw, ' ' || chr(9) || chr(11) || chr(12) || chr(13)) <> '' AS counted,
         k.line IS NOT NULL AND l.doc_id IS DISTINCT FROM k.holder AS cut
  FROM lines l LEFT JOIN known k
    ON trim(l.raw, ' ' || chr(9) || chr(11) || chr(12) || chr(13)) = k.line)
SELECT doc_id, CAST(sum(CAST(counted AS INT)) AS BIGINT) AS n_lines,
       CAST(sum(CAST(cut AS INT)) AS BIGINT) AS n_removed,
       sha256(coalesce(string_agg(raw, chr(10) ORDER BY pos) FILTER (NOT cut), '')) AS kept_sha256
FROM marked GROUP BY doc_id, fp
"""

MIX_SQL = f"""
WITH docs AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS BIGINT) AS size,
         CAST('0x' || substr(md5('mix|' || coalesce(CAST(doc_id AS VARCHAR), '') || '|' || coalesce(source, '')), 1, 15)
              AS BIGINT) AS k
  FROM documents),
sizes AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM docs GROUP BY source),
ranked AS (
  SELECT *, source_size * {MIX_CAP} AS full_size,
         (row_number() OVER (ORDER BY source ASC NULLS LAST) - 1) % 3 + 1 AS w FROM sizes),
shared AS (
  SELECT *, CAST((SELECT sum(source_size) FROM sizes) - coalesce(sum(full_size) OVER before, 0) AS DOUBLE)
         / CAST((SELECT sum(w) FROM ranked) - coalesce(sum(w) OVER before, 0) AS DOUBLE) AS share
  FROM ranked
  WINDOW before AS (ORDER BY full_size / w ASC, source ASC NULLS LAST
                    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
targets AS (
  SELECT source, source_size,
         CASE WHEN full_size <= share * w THEN CAST(full_size AS DOUBLE)
              ELSE (SELECT max(share) FROM shared WHERE full_size > share * w) * w END AS target
  FROM shared),
cut AS (
  SELECT *, CAST(floor(target + 0.5) AS BIGINT) AS budget,
         CASE WHEN source_size > 0 THEN CAST(floor(target + 0.5) AS BIGINT) // source_size ELSE 0 END AS epochs
  FROM targets)
SELECT d.doc_id, d.size, c.source_size, c.target,
       CAST(c.epochs * d.size + greatest(0, least(d.size, c.budget - c.epochs * c.source_size - coalesce(
         sum(d.size) OVER (PARTITION BY d.source ORDER BY d.k, d.doc_id, d.size
                           ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))) AS BIGINT) AS taken
FROM docs d JOIN cut c ON d.source IS NOT DISTINCT FROM c.source
"""

JACCARD_SQL = f"""
WITH RECURSIVE docs AS (
  SELECT row_number() OVER () AS r, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                            'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
shingles AS (
  SELECT DISTINCT r, array_to_string(w[i:i + 4], ' ') AS s
  FROM (SELECT r, w, unnest(range(1, greatest(2, len(w) - 3))) AS i FROM docs WHERE len(w) > 0)),
sizes AS (SELECT r, count(*) AS n FROM shingles GROUP BY r),
met AS (
  SELECT a.r AS u, b.r AS v, count(*) AS m FROM shingles a JOIN shingles b ON a.s = b.s AND a.r < b.r GROUP BY 1, 2),
links AS (
  SELECT u, v FROM met JOIN sizes x ON x.r = u JOIN sizes y ON y.r = v WHERE 100 * m >= {jaccard.PERCENT} * (x.n + y.n - m)),
ways AS (SELECT u, v FROM links UNION ALL SELECT v, u FROM links),
reach AS (
  SELECT r AS u, r AS v FROM docs
  UNION
  SELECT reach.u, ways.v FROM reach JOIN ways ON reach.v = ways.u)
SELECT any_value(d.doc_id) AS doc_id, CAST(coalesce(any_value(sizes.n), 0) AS BIGINT) AS n_shingles,
       min(x.doc_id) AS component_id
FROM reach JOIN docs d ON d.r = reach.u JOIN docs x ON x.r = reach.v LEFT JOIN sizes ON sizes.r = reach.u
GROUP BY reach.u
"""

TOP_SQL = f"""
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor({SCALE} * x::DOUBLE)) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND list_count(embedding) = len(embedding)
    AND len(list_filter(embedding, lambda x: NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.e, c.e) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 20 = 0),
r AS (
  SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
         vec_id, score FROM s)
SELECT * FROM r WHERE rank <= 20
"""

SUBSTRING_SQL = f"""
WITH docs AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
windows AS (
  SELECT r, i, md5(array_to_string(w[i:i + {WINDOW - 1}], ' ')) AS h
  FROM (SELECT r, w, unnest(range(1, len(w) - {WINDOW - 2})) AS i FROM docs WHERE len(w) >= {WINDOW})),
twice AS (SELECT h FROM windows GROUP BY h HAVING count(*) > 1),
covered AS (
  SELECT DISTINCT r, p FROM (SELECT r, unnest(range(i, i + {WINDOW})) AS p FROM windows SEMI JOIN twice USING (h))),
kept AS (
  SELECT r, count(*) AS n, string_agg(word, ' ' ORDER BY p) AS text
  FROM (SELECT r, unnest(w) AS word, generate_subscripts(w, 1) AS p FROM docs) ANTI JOIN covered USING (r, p) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(n, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(kept.text, '')) AS kept_sha256
FROM docs LEFT JOIN kept USING (r)
"""

DIVERGENCE_SQL = f"""
WITH docs AS (
  SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         coalesce(text, '') AS text FROM documents),
words AS (
  SELECT r, lang, source, translate(unnest(regexp_extract_all(text, '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+')),
                                    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS term FROM docs),
counts AS (SELECT lang, source, term, count(*) AS n, count(DISTINCT r) AS d FROM words GROUP BY ALL),
kept AS (
  SELECT lang, term, sum(n) AS total FROM counts GROUP BY ALL HAVING sum(d) >= {divergence.LEAST_DOCUMENTS}),
langs AS (
  SELECT g.lang, count(k.term) AS v, coalesce(sum(k.total), 0) AS total
  FROM (SELECT DISTINCT lang FROM docs) g LEFT JOIN kept k USING (lang) GROUP BY g.lang),
held AS (SELECT c.lang, c.source, c.term, c.n FROM counts c JOIN kept USING (lang, term)),
sources AS (
  SELECT g.lang, g.source, coalesce(sum(h.n), 0) AS total
  FROM (SELECT DISTINCT lang, source FROM docs) g LEFT JOIN held h USING (lang, source) GROUP BY ALL),
shares AS (
  SELECT s.lang, s.source, k.term, coalesce(h.n, 0) AS n,
         1 + ({divergence.SCALE}::HUGEINT * (coalesce(h.n, 0) + {divergence.SMOOTHING}))
             // (s.total + {divergence.SMOOTHING} * l.v) AS p,
         1 + ({divergence.SCALE}::HUGEINT * (k.total + {divergence.SMOOTHING}))
             // (l.total + {divergence.SMOOTHING} * l.v) AS q
  FROM sources s JOIN langs l USING (lang) JOIN kept k USING (lang)
  LEFT JOIN held h ON h.lang = s.lang AND h.source = s.source AND h.term = k.term),
found AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item,
         coalesce((SELECT sum(abs(x.p - y.p)) FROM shares x JOIN shares y USING (lang, term)
                   WHERE x.lang = a.lang AND x.source = a.source AND y.source = b.source), 0) AS value
  FROM sources a JOIN sources b ON a.lang = b.lang AND a.source <> b.source
  UNION ALL
  SELECT lang, source, 'term', term, p - q FROM shares WHERE n > 0 AND p > q),
ranked AS (
  SELECT lang, source, part, item, CAST(value AS BIGINT) AS value,
         CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank
  FROM found)
SELECT * FROM ranked WHERE part = 'pair' OR rank <= {divergence.TOP}
"""

ORACLE_SQL = {
    "op1_jaccard_join": JACCARD_SQL,
    "op2_line_dedup": LINES_SQL,
    "op3_exact_top_k": TOP_SQL,
    "op4_substring_dedup": SUBSTRING_SQL,
    "op8_mix_sources": MIX_SQL,
    "op11_source_divergence": DIVERGENCE_SQL,
}
