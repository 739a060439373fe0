"""The registered queries of the training-data operators, with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import hard_negatives, jaccard, language_id, lm_scoring, mixing, nearest, piece_codec, quality, secret_scan, token_counts, url_filter, variants, vector_dedup
from .common import compacted, is_bucket


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, held_out = _table(spark, sf_dir, "documents"), is_bucket(F.col("doc_id"), 3, 1)
    model = language_id.train(docs, F.col("doc_id").isNotNull() & ~held_out)
    found = language_id.identify(docs.select("doc_id", held_out.alias("held_out"), "text"), model)
    return found.drop("text")


def op2_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scoring.score(_table(spark, sf_dir, "documents"), is_bucket(F.col("doc_id"), 7, 2))


def op3_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.scan(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    of = lambda k: F.size(F.filter("spans", lambda s: s["kind"] == k)).cast("long").alias(f"n_{k}")
    base = secret_scan.digest(F.col("spans"), secret_scan.KINDS[:3])
    return found.select("doc_id", of("assign"), of("access"), of("hex"), F.sha2(base, 256).alias("base_sha256"), secret_scan.digest(F.col("spans")).alias("spans"))


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = mixing.mix(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "size", "source_size", "target", "taken")


def op5_piece_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    return piece_codec.digests(_table(spark, sf_dir, "documents"), _piece_model())


def op6_vector_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_dedup.near_duplicates(_table(spark, sf_dir, "embeddings"))


def op7_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(_table(spark, sf_dir, "pages"))


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op9_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.jaccard_join(_table(spark, sf_dir, "documents"))


def op10_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest.search(_table(spark, sf_dir, "embeddings"))


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(_table(spark, sf_dir, "embeddings"), label=label)


def op12_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(_table(spark, sf_dir, "documents"), _piece_model())


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    # shorter runs hold no word of six; a 199th of the runs lose a letter
    found = variants.runs(_table(spark, sf_dir, "documents").select("doc_id", "text"), "[A-Za-z\u00C0-\u00FF]{6,}")
    h = F.crc32(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), F.col("run")).cast("binary"))
    word = F.when(h % 199 == 0, variants.without(F.col("run"), h % F.length("run"))).otherwise(F.col("run"))
    return variants.group_variants(variants.count_words(found.select(word.alias("word"))))


def _piece_model() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def _filed(query):
    """The query, its result in files of some size whatever the partitions of its table are."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return compacted(query(spark, sf_dir), like=_table(spark, sf_dir, _TABLES.get(query.__name__, "documents")))

    return run


_TABLES = {"op6_vector_dedup": "embeddings", "op7_url_filter": "pages", "op10_nearest": "embeddings", "op11_hard_negatives": "embeddings"}
QUERIES = {f.__name__: _filed(f) for f in (op1_language_id, op2_lm_scoring, op3_secret_scan, op4_mixing, op5_piece_codec, op6_vector_dedup, op7_url_filter, op8_quality, op9_jaccard_join, op10_nearest, op11_hard_negatives, op12_token_counts, op13_spelling_variants)}

ORACLES = {
    "op4_mixing": r"""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
    md5(coalesce(doc_id::VARCHAR, '') || ':' || md5(coalesce(text, ''))) AS o
  FROM documents),
per AS (SELECT source, sum(size)::BIGINT AS source_size, (sum(size) * 2)::BIGINT AS cap, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS n FROM d GROUP BY source),
weighed AS (SELECT *, ([5, 2, 1])[1 + n % 3] AS w, cap * ([2, 5, 10])[1 + n % 3] AS ratio FROM per),
levels AS (
  SELECT *, row_number() OVER r AS nth,
    ((sum(source_size) OVER () * 150)::DOUBLE / 100 - coalesce(sum(cap) OVER (r ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::DOUBLE)
      / sum(w) OVER (r ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)::DOUBLE AS level
  FROM weighed WINDOW r AS (ORDER BY ratio, source NULLS LAST)),
targets AS (
  SELECT source, source_size, CASE WHEN cap > w * level THEN w * first_level ELSE cap::DOUBLE END AS target
  FROM levels, (SELECT arg_min(level, nth) AS first_level FROM levels WHERE cap > w * level)),
timed AS (
  SELECT d.*, source_size, target, sum(size) OVER (PARTITION BY d.source ORDER BY o, doc_id NULLS FIRST ROWS UNBOUNDED PRECEDING) AS cum
  FROM d JOIN targets t ON d.source IS NOT DISTINCT FROM t.source),
passes AS (
  SELECT *, (cum + pass * source_size)::DOUBLE / target AS finish
  FROM timed, (SELECT unnest([0, 1]) AS pass) WHERE size > 0 AND target > 0),
queued AS (
  SELECT *, sum(size) OVER (ORDER BY finish, source NULLS FIRST, o, doc_id NULLS FIRST, pass ROWS UNBOUNDED PRECEDING) AS run FROM passes),
got AS (SELECT doc_id, o, sum(size) AS taken FROM queued WHERE run <= (SELECT sum(size) * 150 // 100 FROM d) GROUP BY ALL)
SELECT t.doc_id, t.size, t.source_size, t.target, coalesce(g.taken, 0)::BIGINT AS taken
FROM timed t LEFT JOIN got g ON t.doc_id IS NOT DISTINCT FROM g.doc_id AND t.o = g.o
""",
    "op6_vector_dedup": r"""
WITH RECURSIVE v AS (
  SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings
  WHERE embedding IS NOT NULL AND label IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS (
  SELECT a.vec_id AS x, b.vec_id AS y FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
  WHERE list_cosine_similarity(a.e, b.e) >= 0.93),
reach(x, y) AS (SELECT x, y FROM links UNION SELECT r.x, l.y FROM reach r JOIN links l ON l.x = r.y),
c AS (SELECT vec_id, least(vec_id, coalesce((SELECT min(y) FROM reach r WHERE r.x = vec_id), vec_id)) AS component_id FROM embeddings)
SELECT vec_id, (SELECT count(*) FROM links l WHERE l.x = vec_id) AS n_links, component_id, vec_id = component_id AS kept FROM c
""",
    # exact: as many vectors as this is run on have no more buckets than are probed
    "op10_nearest": r"""
WITH v AS (
  SELECT DISTINCT vec_id, embedding::DOUBLE[] AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
s AS (SELECT a.vec_id AS query_id, b.vec_id, list_inner_product(a.e, b.e) AS score FROM v a JOIN v b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e) WHERE a.vec_id % 20 = 0)
SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank, vec_id, score FROM s QUALIFY rank <= 20
""",
    "op11_hard_negatives": r"""
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e
  FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS same, list_inner_product(a.e, c.e)::BIGINT AS score
  FROM v a JOIN v c ON a.vec_id <> c.vec_id AND len(a.e) = len(c.e) WHERE a.vec_id % 100 = 0),
p AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT p.anchor_id, positive_id, row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, vec_id)::INTEGER AS rank, vec_id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
QUALIFY rank <= 10
""",
    "op13_spelling_variants": r"""
WITH RECURSIVE crc AS (
  SELECT list_transform(range(256), lambda i: list_reduce(range(8), lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END, i)) AS of_byte),
runs AS (
  SELECT doc_id, run, count(*) AS n
  FROM (SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[A-Za-z\x{00C0}-\x{00FF}]+')) AS run FROM documents)
  WHERE len(run) >= 6 GROUP BY ALL),
hashed AS (
  SELECT run, n, xor(4294967295, list_reduce(
    list_transform(range(1, 1 + octet_length(encode(t))), lambda i: ('0x' || substr(hex(encode(t)), 2 * i - 1, 2))::BIGINT),
    lambda c, b: xor(c // 256, of_byte[1 + xor(c % 256, b)]), 4294967295)) AS h
  FROM (SELECT *, coalesce(doc_id::VARCHAR, '') || ':' || run AS t FROM runs), crc),
words AS (
  SELECT word, sum(n)::BIGINT AS n
  FROM (SELECT n, CASE WHEN h % 199 = 0 THEN substr(run, 1, h % len(run)) || substr(run, h % len(run) + 2, len(run)) ELSE run END AS word FROM hashed)
  WHERE len(word) >= 6 GROUP BY word HAVING sum(n) >= 5),
-- one byte for each letter, since levenshtein() counts bytes
coded AS (SELECT *, translate(word, (SELECT string_agg(chr(i::INTEGER), '' ORDER BY i) FROM range(192, 256) r(i)), (SELECT string_agg(chr(i::INTEGER), '' ORDER BY i) FROM range(33, 97) r(i))) AS c FROM words),
near AS (
  SELECT a.word, b.word AS other, b.n AS other_n FROM coded a JOIN coded b
    ON a.c <> b.c AND (len(a.c) - len(b.c)) IN (-1, 0, 1) AND levenshtein(a.c, b.c) = 1),
best AS (SELECT word, count(*) AS n_near, max(other_n) AS most FROM near GROUP BY word),
formed AS (
  SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN most >= 5 * w.n THEN (SELECT min(encode(other)) FROM near x WHERE x.word = w.word AND x.other_n = most) END AS code, CASE WHEN most >= 5 * w.n THEN most END AS form_n
  FROM words w LEFT JOIN best b ON b.word = w.word),
steps AS (SELECT * EXCLUDE code, decode(code) AS form FROM formed),
follow(word, last, depth) AS (
  SELECT word, word, 0 FROM steps UNION ALL SELECT f.word, s.form, f.depth + 1 FROM follow f JOIN steps s ON s.word = f.last WHERE s.form IS NOT NULL)
SELECT s.word, form, (SELECT arg_max(last, depth) FROM follow f WHERE f.word = s.word) AS root, n, n_near, form_n FROM steps s
""",
    "op9_jaccard_join": r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws
  FROM documents),
sh AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 5 THEN [array_to_string(ws, ' ')]
    ELSE list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i+4], ' ')) END) AS s
  FROM w),
n AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id),
common AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM sh a JOIN sh b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY ALL),
links AS (
  SELECT x, y FROM common JOIN n a ON a.doc_id = x JOIN n b ON b.doc_id = y
  WHERE 100 * c >= 80 * (a.n + b.n - c)),
reach(x, y) AS (SELECT x, y FROM links UNION SELECT r.x, l.y FROM reach r JOIN links l ON l.x = r.y)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles,
  least(d.doc_id, coalesce((SELECT min(y) FROM reach r WHERE r.x = d.doc_id), d.doc_id)) AS component_id,
  (SELECT count(*) FROM links l WHERE l.x = d.doc_id) AS n_links
FROM documents d LEFT JOIN n ON n.doc_id = d.doc_id
""",
}
