"""One query per operator over the test tables, and its SQL where SQL can express it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortia.llm import (
    chat, html_text, licenses, minhash, mixing, packing, personal, quality, resampling, seed_extend, spelling, suffix_dedup, topk,
)

# Fixed value of the word definition, as SQL's regular expressions write it.
WORD = r"[^\x20\x09-\x0D]+"
FEATURE_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality.judge(_table(spark, sf_dir, "documents"))
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        failed.alias("base_failed"), (~failed & F.col("rejected_by").isNull()).alias("kept"),
    )


OP1_SQL = rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT r, doc_id, t, regexp_extract_all(t, '{WORD}') AS ws,
             list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '{WORD}')) AS ls FROM d),
g AS (SELECT r, unnest(range(1, len(ws) - 3)) AS i, ws FROM w WHERE len(ws) > 5),
p AS (SELECT r, i, count(*) OVER (PARTITION BY r, ws[i], ws[i + 1], ws[i + 2], ws[i + 3], ws[i + 4]) AS c FROM g),
c AS (SELECT r, count(DISTINCT i + k) AS n FROM p, range(5) AS s(k) WHERE c > 1 GROUP BY r),
a AS (SELECT doc_id, len(ws) AS n_words, list_sum(list_transform(ws, lambda x: length(x))) AS wc,
             length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS n_symbols,
             len(ls) AS n_lines, len(ls) - len(list_distinct(ls)) AS n_dup_lines, coalesce(c.n, 0) AS n_repeat_words,
             len(list_filter(ws, lambda x: regexp_matches(x, '\pL'))) AS n_letter_words,
             len(list_filter(range(2, len(ws) + 1), lambda i: ws[i] = ws[i - 1])) AS n_stutters
      FROM w LEFT JOIN c USING (r)),
f AS (SELECT *, coalesce(wc, 0) AS word_chars, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM a)
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars,
       CAST(n_symbols AS BIGINT) AS n_symbols, CAST(n_dup_lines AS BIGINT) AS n_dup_lines,
       CAST(n_repeat_words AS BIGINT) AS n_repeat_words, base_failed,
       NOT base_failed AND NOT 10 * n_symbols > n_words AND NOT 100 * n_dup_lines > 40 * n_lines
       AND NOT 100 * n_letter_words < 55 * n_words AND NOT 100 * n_stutters > 30 * n_words
       AND NOT word_chars > 20 * n_words AS kept
FROM f
"""


def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return licenses.train(docs).scan(docs)


def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = suffix_dedup.remove_repeated_bytes(_table(spark, sf_dir, "documents"))
    return kept.select(
        "doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


OP3_SQL = """
WITH d AS (SELECT row_number() OVER () AS r, coalesce(doc_id, 9223372036854775807) AS o, doc_id,
                  hex(encode(coalesce(text, ''))) AS t FROM documents),
b AS (SELECT r, o, t, unnest(range(0, length(t) // 2)) AS p FROM d),
w AS (SELECT r, o, p, substr(t, 2 * p + 1, 2) AS x,
             CASE WHEN 2 * p + 100 <= length(t) THEN substr(t, 2 * p + 1, 100) END AS h FROM b),
f AS (SELECT r, p, x, h IS NOT NULL AND o > min(o) OVER (PARTITION BY h) AS again FROM w),
g AS (SELECT r, p, x, coalesce(max(CASE WHEN again THEN p END) OVER (PARTITION BY r ORDER BY p) > p - 50, false) AS gone FROM f),
e AS (SELECT *, coalesce(lag(gone) OVER (PARTITION BY r ORDER BY p), false) AS was FROM g),
k AS (SELECT r, count_if(gone) AS n, count_if(gone AND NOT was) AS spans,
             string_agg(CASE WHEN NOT gone THEN x END, '' ORDER BY p) AS kept FROM e GROUP BY r)
SELECT doc_id, CAST(length(t) // 2 AS BIGINT) AS n_bytes, CAST(coalesce(n, 0) AS BIGINT) AS n_removed,
       CAST(coalesce(spans, 0) AS BIGINT) AS n_spans, sha256(unhex(coalesce(kept, ''))) AS kept_sha256
FROM d LEFT JOIN k USING (r)
"""


def op4_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    chats = chat.format_chats(_table(spark, sf_dir, "conversations"))
    trained = F.aggregate("loss_spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["begin"])
    return chats.select("conv_id", "n_turns", "n_copies", "text", trained.alias("loss_chars"))


OP4_SQL = """
WITH t AS (SELECT DISTINCT conv_id, turn, role, text FROM conversations WHERE conv_id IS NOT NULL),
c AS (SELECT conv_id, list({'role': role, 'text': text} ORDER BY turn NULLS FIRST, role NULLS FIRST, text NULLS FIRST) AS l
      FROM t GROUP BY conv_id),
u AS (SELECT min(conv_id) AS conv_id, count(*) AS n_copies, l FROM c GROUP BY l)
SELECT conv_id, CAST(len(l) AS BIGINT) AS n_turns, n_copies,
       array_to_string(list_transform(l, lambda x:
         '<|' || coalesce(x.role, '') || '|>' || chr(10) || coalesce(x.text, '') || chr(10)), '') AS text,
       CAST(coalesce(list_sum(list_transform(l, lambda x:
         CASE WHEN x.role = 'assistant' THEN length(coalesce(x.text, '')) ELSE 0 END)), 0) AS BIGINT) AS loss_chars
FROM u WHERE NOT EXISTS (SELECT 1 FROM u AS b WHERE len(b.l) > len(u.l) AND b.l[1:len(u.l)] = u.l)
"""


def op5_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = minhash.near_duplicates(_table(spark, sf_dir, "documents"), shingle=3, percent=85, tuples=8)
    return found.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


OP5_SQL = rf"""
WITH RECURSIVE d AS (SELECT row_number() OVER () AS r, doc_id,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{WORD}') AS ws
  FROM documents),
s AS (SELECT DISTINCT r, array_to_string(ws[i:i + 2], ' ') AS g
      FROM (SELECT r, ws, unnest(range(1, greatest(len(ws) - 2, 1) + 1)) AS i FROM d WHERE len(ws) > 0)),
n AS (SELECT r, count(*) AS n FROM s GROUP BY r),
p AS (SELECT a.r AS a, b.r AS b, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.r <> b.r GROUP BY ALL),
l AS (SELECT a, b FROM p JOIN n x ON x.r = a JOIN n y ON y.r = b WHERE 100 * c >= 85 * (x.n + y.n - c)),
t AS (SELECT r AS a, r AS b FROM d UNION SELECT t.a, l.b FROM t JOIN l ON l.a = t.b),
m AS (SELECT t.a AS r, min(d.doc_id) AS component_id FROM t JOIN d ON d.r = t.b GROUP BY t.a)
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id, doc_id IS NOT DISTINCT FROM component_id AS kept
FROM d JOIN m USING (r) LEFT JOIN n USING (r)
"""


def op6_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, k=20)


OP6_SQL = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS e
           FROM embeddings),
s AS (SELECT q.vec_id AS query_id, c.vec_id,
             CAST(list_sum(list_transform(range(1, len(q.e) + 1), lambda i: q.e[i] * c.e[i])) AS BIGINT) AS score
      FROM v q, v c WHERE q.vec_id % 20 = 0 AND c.vec_id <> q.vec_id),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS n FROM s)
SELECT query_id, CAST(n AS INT) AS rank, vec_id, score FROM r WHERE n <= 20
"""


def op7_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = html_text.extract(_table(spark, sf_dir, "pages"))
    return texts.withColumn("n_chars", F.length("text").cast("long"))


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    pieces = packing.pack(_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"))
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    sizes = mixing.word_sizes(_table(spark, sf_dir, "documents"))
    return mixing.mix(sizes).select("doc_id", "size", "source_size", "target", "taken", "source", "copies")


def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = seed_extend.remove_repeats(_table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


OP10_SQL = rf"""
WITH d AS (SELECT row_number() OVER () AS r, coalesce(doc_id, 9223372036854775807) AS o, doc_id,
                  regexp_extract_all(coalesce(text, ''), '{WORD}') AS ws FROM documents),
w AS (SELECT r, o, ws, unnest(range(1, len(ws) - 18)) AS i FROM d WHERE len(ws) >= 20),
h AS (SELECT r, o, i, array_to_string(ws[i:i + 19], ' ') AS h FROM w),
f AS (SELECT r, i, o > min(o) OVER (PARTITION BY h) OR i > min(i) OVER (PARTITION BY h, r) AS again FROM h),
c AS (SELECT DISTINCT r, i + j AS p FROM f, range(20) AS s(j) WHERE again),
n AS (SELECT r, count(*) AS n FROM c GROUP BY r),
b AS (SELECT r, unnest(ws) AS w, unnest(range(1, len(ws) + 1)) AS p FROM d),
k AS (SELECT r, string_agg(w, ' ' ORDER BY p) AS kept FROM b ANTI JOIN c USING (r, p) GROUP BY r)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(n, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN n USING (r) LEFT JOIN k USING (r)
"""


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.spelling_variants(_table(spark, sf_dir, "documents"))


# CRC-32 is linear: a text's code is the exclusive or of what each byte adds at its distance from the end,
# and of what the start value becomes after as many bytes.
CRC_SQL = """
crc_byte AS (SELECT b, list_reduce(list_prepend(b, CAST(range(8) AS BIGINT[])),
                 lambda x, y: xor(x >> 1, CASE WHEN x & 1 = 1 THEN 3988292384 ELSE 0 END)) AS t
             FROM (SELECT CAST(unnest(range(256)) AS BIGINT) AS b)),
crc_part AS (SELECT b, CAST(0 AS BIGINT) AS far, t AS part FROM crc_byte
             UNION ALL SELECT c.b, far + 1, xor(x.t, part >> 8) FROM crc_part c JOIN crc_byte x ON x.b = (part & 255)
             WHERE far < {longest}),
crc_start AS (SELECT CAST(0 AS BIGINT) AS size, CAST(4294967295 AS BIGINT) AS code
              UNION ALL SELECT size + 1, xor(x.t, code >> 8) FROM crc_start JOIN crc_byte x ON x.b = (code & 255)
              WHERE size < {longest} + 1)"""

OP11_SQL = rf"""
WITH RECURSIVE d AS (SELECT row_number() OVER () AS r, doc_id,
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
r AS (SELECT doc_id, w, count(*) AS c FROM (SELECT doc_id, unnest(regexp_extract_all(t, '[a-zÀ-ÿ]+')) AS w FROM d) GROUP BY ALL),
k AS (SELECT row_number() OVER () AS k, doc_id, w, c, hex(encode(doc_id || ':' || w)) AS h FROM r),
{CRC_SQL.format(longest="(SELECT max(length(h)) // 2 FROM k)")},
b AS (SELECT k, CAST('0x' || substr(h, 2 * p + 1, 2) AS BIGINT) AS b, length(h) // 2 - 1 - p AS far
      FROM (SELECT k, h, unnest(range(length(h) // 2)) AS p FROM k)),
x AS (SELECT k, bit_xor(part) AS x FROM b JOIN crc_part USING (b, far) GROUP BY k),
v AS (SELECT w, c, xor(xor(x, code), 4294967295) AS h FROM k LEFT JOIN x USING (k) LEFT JOIN crc_start ON size = length(k.h) // 2),
w AS (SELECT word, CAST(sum(c) AS BIGINT) AS n FROM
       (SELECT CASE WHEN h % 97 = 0 THEN substr(w, 1, h % length(w)) || substr(w, h % length(w) + 2) ELSE w END AS word, c FROM v)
      WHERE length(word) >= 5 GROUP BY word HAVING sum(c) >= 3),
e AS (SELECT word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) AS cut
      FROM (SELECT word, n, CAST(unnest(range(1, length(word) + 1)) AS BIGINT) AS i FROM w)),
p AS (SELECT a.word, b.word AS near, b.n FROM e a JOIN e b USING (cut, i) WHERE a.word <> b.word
      UNION SELECT a.word, b.word, b.n FROM e a JOIN w b ON b.word = a.cut
      UNION SELECT b.word, a.word, a.n FROM e a JOIN w b ON b.word = a.cut),
g AS (SELECT word, count(*) AS n_near, arg_min(near, (-n, near)) AS near, max(n) AS near_n FROM p GROUP BY word),
f AS (SELECT word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN near_n >= 2 * w.n THEN near END AS form,
             CASE WHEN near_n >= 2 * w.n THEN near_n END AS form_n FROM w LEFT JOIN g USING (word)),
c AS (SELECT word, word AS reached, 0 AS steps FROM f UNION ALL
      SELECT c.word, f.form, steps + 1 FROM c JOIN f ON f.word = c.reached WHERE f.form IS NOT NULL)
SELECT word, form, (SELECT arg_max(reached, steps) FROM c WHERE c.word = f.word) AS root, n, n_near, form_n FROM f
"""


def op12_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = personal.find_personal_data(_table(spark, sf_dir, "documents"))
    fixed = F.filter("spans", lambda s: s["fixed"])
    counts = [F.size(F.filter(fixed["kind"], lambda k: k == kind)).cast("long").alias(f"n_{kind}") for kind in personal.KINDS[:4]]  # noqa: B023
    return found.select(
        "doc_id", *counts, F.sha2(personal.span_list(fixed), 256).alias("base_sha256"),
        personal.span_list(F.col("spans")).alias("spans"),
    )


def op13_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    drawn = resampling.resample(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    return drawn.drop("n_words")


OP13_SQL = rf"""
WITH RECURSIVE d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{FEATURE_WORD}') AS ws FROM documents),
b AS (SELECT row_number() OVER () AS r, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{FEATURE_WORD}') AS ws FROM benchmark),
f AS (SELECT r, array_to_string(ws[i:i + k], ' ') AS f, count(*) AS c
      FROM (SELECT r, ws, unnest(range(1, len(ws) + 1)) AS i FROM d), range(3) AS s(k) WHERE i + k <= len(ws) GROUP BY ALL),
g AS (SELECT array_to_string(ws[i:i + k], ' ') AS f, count(*) AS c
      FROM (SELECT ws, unnest(range(1, len(ws) + 1)) AS i FROM b), range(3) AS s(k) WHERE i + k <= len(ws) GROUP BY ALL),
k AS (SELECT f, hex(encode(f)) AS h, row_number() OVER () AS k FROM (SELECT f FROM f UNION SELECT f FROM g)),
{CRC_SQL.format(longest="(SELECT max(length(h)) // 2 FROM k)")},
p AS (SELECT k, CAST('0x' || substr(h, 2 * p + 1, 2) AS BIGINT) AS b, length(h) // 2 - 1 - p AS far
      FROM (SELECT k, h, unnest(range(length(h) // 2)) AS p FROM k)),
x AS (SELECT k, bit_xor(part) AS x FROM p JOIN crc_part USING (b, far) GROUP BY k),
v AS (SELECT f, xor(xor(x, code), 4294967295) % 10000 AS bucket FROM k JOIN x USING (k) JOIN crc_start ON size = length(k.h) // 2),
s AS (SELECT bucket, sum(c) AS s FROM f JOIN v USING (f) GROUP BY bucket),
t AS (SELECT bucket, sum(c) AS t FROM g JOIN v USING (f) GROUP BY bucket),
a AS (SELECT bucket, floor(1000 * ln((coalesce(t, 0) + 1) * CAST((SELECT coalesce(sum(s), 0) FROM s) + 10000 AS DOUBLE)
                 / ((s + 1) * CAST((SELECT coalesce(sum(t), 0) FROM t) + 10000 AS DOUBLE)))) AS gain
      FROM s LEFT JOIN t USING (bucket)),
w AS (SELECT r, sum(c) AS n, sum(c * gain) AS weight FROM f JOIN v USING (f) JOIN a USING (bucket) GROUP BY r),
e AS (SELECT r, doc_id, len(ws) >= 20 AS able, CAST(coalesce(n, 0) AS BIGINT) AS n_features,
             CAST(coalesce(weight, 0) AS BIGINT) AS weight,
             CAST('0x' || substr(sha256('42:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 8) AS BIGINT) AS h
      FROM d LEFT JOIN w USING (r)),
o AS (SELECT *, weight + CAST(floor(-1000 * ln(-ln((h + 0.5) / 4294967296))) AS BIGINT) AS score FROM e),
q AS (SELECT *, row_number() OVER (PARTITION BY able ORDER BY score DESC, doc_id NULLS LAST) AS place FROM o)
SELECT doc_id, n_features, weight, score, CASE WHEN able AND place <= 5 * (SELECT count_if(able) FROM o) // 100 THEN place END AS rank
FROM q
"""


REGISTRY = {
    "op1_quality_rules": (op1_quality_rules, OP1_SQL),
    "op2_license_scan": (op2_license_scan, None),
    "op3_suffix_dedup": (op3_suffix_dedup, OP3_SQL),
    "op4_chat_formatting": (op4_chat_formatting, OP4_SQL),
    "op5_minhash_dedup": (op5_minhash_dedup, OP5_SQL),
    "op6_top_k": (op6_top_k, OP6_SQL),
    "op7_html_extraction": (op7_html_extraction, None),
    "op8_packing": (op8_packing, None),
    "op9_mixing": (op9_mixing, None),
    "op10_substring_dedup": (op10_substring_dedup, OP10_SQL),
    "op11_spelling_variants": (op11_spelling_variants, OP11_SQL),
    "op12_personal_data": (op12_personal_data, None),
    "op13_importance_resampling": (op13_importance_resampling, OP13_SQL),
}
