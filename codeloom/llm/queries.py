"""The queries of the operators and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from codeloom.llm import bpe, chat, html, licences, minhash, packing, phrases, pii, quality, substring, tokencount, vectors, whitening


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op1_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.extract_pages(table(spark, sf_dir, "pages"))


def op2_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.near_vectors(table(spark, sf_dir, "embeddings"))


#: Labels spread over the links until nothing changes: the smallest id of each component.
COMPONENTS_SQL = """
, reach(id, low) AS (
  SELECT id, id FROM nodes
  UNION SELECT l.b, r.low FROM reach AS r JOIN links AS l ON r.id = l.a
), lowest AS (SELECT id, min(low) AS component_id FROM reach GROUP BY id)
"""

OP2_SQL = (
    """
WITH RECURSIVE usable AS (
  SELECT vec_id AS id, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), scaled AS (SELECT id, v, sqrt(list_inner_product(v, v)) AS norm FROM usable
), links AS (
  SELECT a.id AS a, b.id AS b FROM scaled AS a JOIN scaled AS b ON a.id <> b.id AND len(a.v) = len(b.v)
  WHERE list_inner_product(a.v, b.v) / (a.norm * b.norm) >= 0.95
), nodes AS (SELECT vec_id AS id FROM embeddings)
"""
    + COMPONENTS_SQL
    + """
SELECT vec_id, (SELECT count(*) FROM links WHERE a = vec_id) AS n_links, component_id, vec_id = component_id AS kept
FROM embeddings JOIN lowest ON vec_id = id
"""
)


def op3_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"))


OP3_SQL = (
    r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^ 	-
]+') AS w FROM documents
), shingles AS (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS s FROM words, unnest(range(1, greatest(len(w) - 3, 2))) AS u(i)
  WHERE len(w) > 0
), sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), pairs AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS shared FROM shingles AS x JOIN shingles AS y ON x.s = y.s AND x.doc_id <> y.doc_id
  GROUP BY ALL
), links AS (
  SELECT a, b FROM pairs JOIN sizes AS p ON a = p.doc_id JOIN sizes AS q ON b = q.doc_id
  WHERE 100 * shared >= 85 * (p.n + q.n - shared)
), nodes AS (SELECT doc_id AS id FROM documents)
"""
    + COMPONENTS_SQL
    + """
SELECT d.doc_id, coalesce(n, 0) AS n_shingles, component_id, d.doc_id = component_id AS kept
FROM documents AS d JOIN lowest ON d.doc_id = id LEFT JOIN sizes AS s ON d.doc_id = s.doc_id
"""
)


def op4_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.format_conversations(table(spark, sf_dir, "conversations"))


OP4_SQL = """
WITH whole AS (
  SELECT conv_id, list({'r': role, 't': text} ORDER BY turn NULLS FIRST, role NULLS FIRST, text NULLS FIRST) AS turns
  FROM conversations GROUP BY conv_id
), prefixes AS (
  SELECT DISTINCT turns[1:k] AS turns FROM whole, unnest(range(1, len(turns))) AS u(k)
), kept AS (
  SELECT min(conv_id) AS conv_id, turns, count(*) AS n_copies FROM whole
  WHERE turns NOT IN (SELECT turns FROM prefixes) GROUP BY turns
)
SELECT conv_id, len(turns) AS n_turns, n_copies, array_to_string(list_transform(turns, lambda x:
  '<|im_start|>' || replace(coalesce(x.r, ''), '<|', '< |') || chr(10) || replace(coalesce(x.t, ''), '<|', '< |') || '<|im_end|>' || chr(10)), '') AS text
FROM kept
"""


def op5_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = table(spark, sf_dir, "documents")
    return tokencount.count_tokens(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


def op6_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(bpe.encode_documents(table(spark, sf_dir, "documents"), vocabulary()))


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    verdicts = quality.judge(table(spark, sf_dir, "documents"))
    return verdicts.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


OP7_SQL = r"""
WITH d AS (
  SELECT doc_id, source, text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
         string_split(coalesce(text, ''), chr(10)) AS ls FROM documents
), windows AS (
  SELECT doc_id, i, array_to_string(w[i:i + 7], ' ') AS x FROM d, unnest(range(1, len(w) - 6)) AS u(i)
), twice AS (
  SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, x) AS c FROM windows) WHERE c > 1
), covered AS (
  SELECT doc_id, sum(least(8, coalesce(nxt - i, 8))) AS n
  FROM (SELECT doc_id, i, lead(i) OVER (PARTITION BY doc_id ORDER BY i) AS nxt FROM twice) GROUP BY doc_id
), lines AS (
  SELECT doc_id, source, text, l, trim(translate(regexp_replace(l, '[\x20\x09\x0B-\x0D]+', ' ', 'g'),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) AS x FROM d, unnest(ls) AS u(l)
), dup AS (
  SELECT doc_id, count(*) - count(DISTINCT l) AS n FROM lines WHERE x <> '' GROUP BY doc_id
), hosts AS (
  SELECT source, count(DISTINCT text) AS n FROM d GROUP BY source
), often AS (
  SELECT l.source, l.x, min(l.doc_id) AS owner FROM lines AS l JOIN hosts AS h ON l.source IS NOT DISTINCT FROM h.source
  WHERE l.x <> '' GROUP BY l.source, l.x, h.n HAVING count(DISTINCT l.text) > 10
    AND (100 * count(DISTINCT l.text) > 5 * h.n OR count(DISTINCT l.text) > 1000)
), lost AS (
  SELECT l.doc_id, sum(len(string_split(l.x, ' '))) AS n FROM lines AS l
  JOIN often AS o ON l.x = o.x AND l.source IS NOT DISTINCT FROM o.source WHERE l.doc_id <> o.owner GROUP BY l.doc_id
), base AS (
  SELECT d.doc_id, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars,
         length(coalesce(text, '')) - length(regexp_replace(coalesce(text, ''), '[#*$%&|<>]', '', 'g')) AS n_symbols,
         coalesce(dup.n, 0) AS n_dup_lines, CAST(coalesce(covered.n, 0) AS BIGINT) AS n_repeat_words,
         coalesce(lost.n, 0) AS lost
  FROM d LEFT JOIN covered USING (doc_id) LEFT JOIN dup USING (doc_id) LEFT JOIN lost USING (doc_id)
), judged AS (
  SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM base
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND (lost = 0 OR n_words - lost >= 20) AS kept FROM judged
"""


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.digests(packing.pack_documents(table(spark, sf_dir, "documents"), vocabulary()))


def op9_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.digests(pii.find_spans(table(spark, sf_dir, "documents")))


def op10_substring(spark: SparkSession, sf_dir: str) -> DataFrame:
    left = substring.dedup_documents(table(spark, sf_dir, "documents").select("doc_id", "text"))
    kept = F.array_join(quality.words_of(F.coalesce("text", F.lit(""))), " ")
    return left.select("doc_id", "n_words", "n_removed", F.sha2(kept.cast("binary"), 256).alias("kept_sha256"))


OP10_SQL = r"""
WITH words AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^ 	-
]+') AS w FROM documents
), windows AS (
  SELECT doc_id, i, array_to_string(w[i:i + 19], ' ') AS x FROM words, unnest(range(1, len(w) - 18)) AS u(i)
), later AS (
  SELECT doc_id, i FROM (SELECT doc_id, i, row_number() OVER (PARTITION BY x ORDER BY doc_id, i) AS r FROM windows) WHERE r > 1
), gone AS (SELECT doc_id, list(DISTINCT i + k) AS places FROM later, unnest(range(0, 20)) AS u(k) GROUP BY doc_id)
SELECT doc_id, len(w) AS n_words, coalesce(len(places), 0) AS n_removed,
       sha256(array_to_string(CASE WHEN places IS NULL THEN w ELSE list_filter(w, lambda x, i: NOT list_contains(places, i)) END, ' ')) AS kept_sha256
FROM words LEFT JOIN gone USING (doc_id)
"""


def op11_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licences.digests(licences.scan_licences(table(spark, sf_dir, "documents")))


def op12_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.mine_phrases(table(spark, sf_dir, "documents"))


OP12_SQL = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, regexp_extract_all(p, '[^\x20\x09]+') AS w
  FROM documents, unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[.,;:!?\x0A-\x0D]')) AS u(p)
), sizes AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM pieces GROUP BY lang
), one AS (SELECT lang, w[i] AS x, count(*) AS f FROM pieces, unnest(range(1, len(w) + 1)) AS u(i) GROUP BY ALL
), two AS (
  SELECT lang, w[i] AS x, w[i + 1] AS y, count(*) AS f FROM pieces, unnest(range(1, len(w))) AS u(i) GROUP BY ALL HAVING count(*) >= 10
), three AS (
  SELECT lang, w[i] AS x, w[i + 1] AS y, w[i + 2] AS z, count(*) AS f FROM pieces, unnest(range(1, len(w) - 1)) AS u(i) GROUP BY ALL HAVING count(*) >= 10
), held AS (
  SELECT lang, x, y, max(f) AS f FROM (SELECT lang, x, y, f FROM three UNION ALL SELECT lang, y, z, f FROM three) GROUP BY ALL
), cuts AS (
  SELECT t.lang, t.x || ' ' || t.y AS phrase, 1 AS k, t.f AS a, p.f AS l, q.f AS r FROM two AS t
  JOIN one AS p ON p.lang = t.lang AND p.x = t.x JOIN one AS q ON q.lang = t.lang AND q.x = t.y
  LEFT JOIN held AS h ON h.lang = t.lang AND h.x = t.x AND h.y = t.y WHERE h.f IS NULL OR 100 * h.f < 50 * t.f
  UNION ALL
  SELECT t.lang, t.x || ' ' || t.y || ' ' || t.z, 1, t.f, p.f, q.f FROM three AS t
  JOIN one AS p ON p.lang = t.lang AND p.x = t.x JOIN two AS q ON q.lang = t.lang AND q.x = t.y AND q.y = t.z
  UNION ALL
  SELECT t.lang, t.x || ' ' || t.y || ' ' || t.z, 2, t.f, p.f, q.f FROM three AS t
  JOIN two AS p ON p.lang = t.lang AND p.x = t.x AND p.y = t.y JOIN one AS q ON q.lang = t.lang AND q.x = t.z
), scored AS (
  SELECT *, CAST((1000000::HUGEINT * a * a) // (l::HUGEINT * r) AS BIGINT) AS score FROM cuts
), best AS (
  SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM best
)
SELECT lang, rank, phrase, a, l, r, n, score FROM placed JOIN sizes USING (lang) WHERE rank <= 2000
"""


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = whitening.whiten(table(spark, sf_dir, "embeddings"))
    return made.withColumn("deviation", F.col("deviation").try_cast("long"))


QUERIES = {
    "op1_html": op1_html, "op2_vectors": op2_vectors, "op3_minhash": op3_minhash, "op4_chat": op4_chat, "op5_tokens": op5_tokens,
    "op6_bpe": op6_bpe, "op7_quality": op7_quality, "op8_packing": op8_packing, "op9_pii": op9_pii,
    "op10_substring": op10_substring, "op11_licenses": op11_licenses, "op12_phrases": op12_phrases, "op13_whitening": op13_whitening,
}
ORACLE = {
    "op2_vectors": OP2_SQL, "op3_minhash": OP3_SQL, "op4_chat": OP4_SQL, "op7_quality": OP7_SQL, "op10_substring": OP10_SQL,
    "op12_phrases": OP12_SQL,
}
