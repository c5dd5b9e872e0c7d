"""One registered query for each numbered operator, with SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.tables import read_table
from . import bpe, filter_audit, mixing, packing, quality, resampling, sharding, simhash, token_counts, token_files, toxicity, vectors
from . import line_dedup as lines

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if sql:
            ORACLES[name] = sql
        return fn
    return add


def vocabulary(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def learnable(labels: DataFrame) -> DataFrame:
    """Labels that may be learned from: not those held out by the checksum of their id. A label
    without an id belongs to no document and is not learned from; a document without one is not held out."""
    return labels.filter(F.crc32(F.col("doc_id").cast("string")) % 3 != 1)


_BLANK = "' ' || chr(9) || chr(11) || chr(12) || chr(13)"


@query("op1_line_dedup", f"""
WITH parts AS (SELECT doc_id, source, text, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
lines AS (SELECT doc_id, source, unnest(list_distinct(list_filter(list_transform(ls, lambda x: trim(x, {_BLANK})), lambda x: x <> ''))) AS line FROM parts),
counts AS (SELECT source, line, count(*) AS n FROM lines GROUP BY ALL),
totals AS (SELECT source, count(*) AS pages FROM documents GROUP BY ALL),
drops AS (SELECT c.source, list(line) AS gone FROM counts c JOIN totals t ON c.source IS NOT DISTINCT FROM t.source
          WHERE n >= {lines.MIN_PAGES} AND n > pages * {lines.RATIO}::DOUBLE GROUP BY ALL),
kept AS (SELECT p.*, CASE WHEN d.gone IS NULL THEN ls ELSE list_filter(ls, lambda x: NOT list_contains(gone, trim(x, {_BLANK}))) END AS k
         FROM parts p LEFT JOIN drops d ON p.source IS NOT DISTINCT FROM d.source)
SELECT doc_id, source, CASE WHEN len(k) = len(ls) THEN text ELSE array_to_string(k, chr(10)) END AS text,
       CASE WHEN text IS NULL THEN 0 ELSE len(ls) END::BIGINT AS n_lines, (len(ls) - len(k))::BIGINT AS n_dropped FROM kept
""")
def op1(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return lines.line_dedup(docs)


@query("op2_simhash_dedup")
def op2(spark, sf_dir):
    return simhash.simhash(read_table(spark, sf_dir, "documents"))


@query("op3_best_fit_packing")
def op3(spark, sf_dir):
    pieces = packing.token_pieces(read_table(spark, sf_dir, "documents"), vocabulary("word_bpe_49k.json"))
    return packing.pack(pieces)


@query("op4_sharding", f"""
WITH rows AS (SELECT doc_id, coalesce(octet_length(encode(text)), 0) AS b,
              ('0x' || md5(coalesce(doc_id::VARCHAR, ''))[1:15])::BIGINT AS h FROM documents),
way AS (SELECT doc_id, b, h, d, h >> (60 - d) AS p FROM rows, range(0, 61) AS r(d)),
sums AS (SELECT d, p, sum(b) AS total FROM way GROUP BY ALL),
fit AS (SELECT doc_id, b, min(d) AS d FROM way JOIN sums USING (d, p) WHERE total <= {sharding.LIMIT} GROUP BY ALL)
SELECT f.doc_id, f.b::BIGINT AS n_bytes, f.d::INT AS shard_depth, w.p AS shard_prefix, s.total::BIGINT AS shard_bytes, '0' AS part
FROM fit f JOIN way w ON f.doc_id IS NOT DISTINCT FROM w.doc_id AND f.d = w.d JOIN sums s ON s.d = w.d AND s.p = w.p
""")
def op4(spark, sf_dir):
    return sharding.shard(read_table(spark, sf_dir, "documents").select("doc_id", "text")).drop("text")


@query("op5_quality_rules")
def op5(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    return quality.quality(docs, keep_text=False).drop("lang")


@query("op6_embedding_dedup")
def op6(spark, sf_dir):
    return vectors.near_vectors(read_table(spark, sf_dir, "embeddings"))


@query("op7_mixing")
def op7(spark, sf_dir):
    return mixing.mix(read_table(spark, sf_dir, "documents"))


@query("op8_token_counts")
def op8(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return token_counts.token_counts(docs, vocabulary("byte_bpe_50k.json")).drop("text")


@query("op9_token_files")
def op9(spark, sf_dir):
    return token_files.token_files(read_table(spark, sf_dir, "documents"), vocabulary("word_bpe_49k.json"))


@query("op10_toxicity")
def op10(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.train(docs, learnable(read_table(spark, sf_dir, "labels")))
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 3 == 1, F.lit(False)).alias("held_out")
    return toxicity.toxicity(docs, model).select("doc_id", held_out, "score", "predicted")


_CRC_STEP = "xor(t[(xor(a, b) & 255) + 1], a >> 8)"


@query("op11_resampling", f"""
WITH RECURSIVE bits(i, k, c) AS (
  SELECT i::BIGINT, 0, i::BIGINT FROM range(256) r(i)
  UNION ALL SELECT i, k + 1, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END FROM bits WHERE k < 8),
crc AS (SELECT list(c ORDER BY i) AS t FROM bits WHERE k = 8),
texts AS (
  SELECT 0 AS kind, row_number() OVER () AS rid, doc_id AS id, coalesce(text, '') AS text FROM documents
  UNION ALL SELECT 1, row_number() OVER (), NULL, coalesce(text, '') FROM benchmark),
words AS (SELECT kind, rid, id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                 '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM texts),
grams AS (SELECT kind, rid, unnest(list_concat(w, list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]))) AS g FROM words),
per AS (SELECT kind, rid, g, count(*) AS n FROM grams GROUP BY ALL),
codes AS (
  SELECT g, xor(list_reduce(list_concat([4294967295], list_transform(range(octet_length(encode(g))),
         lambda i: ('0x' || hex(encode(g))[2 * i + 1:2 * i + 2])::BIGINT)), lambda a, b: {_CRC_STEP}), 4294967295) % {resampling.BUCKETS} AS bucket
  FROM (SELECT DISTINCT g FROM per), crc),
feats AS (SELECT kind, rid, bucket, sum(n) AS n FROM per JOIN codes USING (g) GROUP BY ALL),
sums AS (SELECT bucket, coalesce(sum(n) FILTER (kind = 0), 0)::DOUBLE AS s, coalesce(sum(n) FILTER (kind = 1), 0)::DOUBLE AS t FROM feats GROUP BY ALL),
alls AS (SELECT sum(s) AS s_all, sum(t) AS t_all FROM sums),
gain AS (SELECT bucket, floor(1000 * ln(((t + 1) * (s_all + {resampling.BUCKETS})) / ((s + 1) * (t_all + {resampling.BUCKETS})))) AS v FROM sums, alls),
weighed AS (SELECT rid, sum(n)::BIGINT AS n_features, floor(sum(n * v) / sum(n))::BIGINT AS weight
            FROM feats JOIN gain USING (bucket) WHERE kind = 0 GROUP BY ALL),
scored AS (SELECT w.id AS doc_id, len(w) AS n_words, coalesce(n_features, 0)::BIGINT AS n_features, coalesce(weight, 0)::BIGINT AS weight,
           (coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || sha256('{resampling.SEED}:' || coalesce(w.id::VARCHAR, ''))[1:8])::BIGINT + 0.5::DOUBLE)
            / 4294967296::DOUBLE))))::BIGINT AS score
           FROM words w LEFT JOIN weighed d ON w.rid = d.rid WHERE w.kind = 0),
placed AS (SELECT *, row_number() OVER (ORDER BY score DESC, doc_id NULLS LAST) AS place, count(*) OVER () AS n
           FROM scored WHERE n_words >= {resampling.MIN_WORDS})
SELECT doc_id, n_features, weight, score, CASE WHEN place <= {resampling.PERCENT} * n // 100 THEN place END::BIGINT AS rank FROM placed
UNION ALL SELECT doc_id, n_features, weight, score, NULL FROM scored WHERE n_words < {resampling.MIN_WORDS}
""")
def op11(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return resampling.resample(docs, read_table(spark, sf_dir, "benchmark"))


_MASK = r"""
WITH texts AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text FROM documents),
marks AS (SELECT doc_id, max((quality = 1)::INT) AS good, max((toxic = 1)::INT) AS toxic FROM labels GROUP BY ALL),
words AS (SELECT *, regexp_extract_all(text, '[^ 	-
]+') AS w, min(doc_id) OVER (PARTITION BY text) AS first FROM texts),
docs AS (
  SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic,
    [len(w) < 200, 100 * len(list_distinct(w)) < 50 * len(w),
     100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 3 * length(text),
     regexp_matches(text, '[#$%&*|]'), coalesce(w1.doc_id > first, false)] AS f
  FROM words w1 LEFT JOIN marks m ON w1.doc_id = m.doc_id),
"""


@query("op12_filter_audit", _MASK + """
one AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
orders AS (SELECT a.x || b.x || c.x || d.x || e.x AS filter_order FROM one a, one b, one c, one d, one e
           WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5),
steps AS (SELECT filter_order, step::INT AS step, instr('ABCDE', filter_order[step]) AS own,
          list_transform(range(1, step), lambda j: instr('ABCDE', filter_order[j])) AS before FROM orders, range(1, 6) r(step)),
kinds AS (SELECT part, good, toxic, f, count(*) AS n FROM docs GROUP BY ALL),
fate AS (SELECT part, filter_order, step, own, n, good, toxic, f[own] AS fails,
         coalesce(list_bool_or(list_transform(before, lambda j: f[j])), false) AS gone,
         f[own] AND len(list_filter(f, lambda b: b)) = 1 AS only_one FROM kinds, steps),
report AS (SELECT part, filter_order, step, own,
  coalesce(sum(n) FILTER (NOT fails AND NOT gone), 0) AS kept, coalesce(sum(n) FILTER (fails AND NOT gone), 0) AS removed,
  coalesce(sum(n) FILTER (fails AND gone), 0) AS redundant, coalesce(sum(n) FILTER (only_one), 0) AS unique_fails,
  coalesce(sum(n) FILTER (fails AND NOT gone AND good = 1), 0) AS good_lost,
  coalesce(sum(n) FILTER (fails AND NOT gone AND toxic = 1), 0) AS toxic_lost FROM fate GROUP BY ALL)
SELECT part, filter_order, step, kept::BIGINT AS kept, removed::BIGINT AS removed, redundant::BIGINT AS redundant,
       unique_fails::BIGINT AS unique_fails, good_lost::BIGINT AS good_lost, toxic_lost::BIGINT AS toxic_lost,
       (sum(removed) OVER (PARTITION BY part, own))::BIGINT AS shapley FROM report
""")
def op12(spark, sf_dir):
    return filter_audit.filter_audit(spark, f"{sf_dir}/documents.parquet", read_table(spark, sf_dir, "labels"))


@query("op13_byte_bpe")
def op13(spark, sf_dir):
    import public_tokenizers

    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return bpe.round_trip(docs, vocabulary("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN).drop("text")
