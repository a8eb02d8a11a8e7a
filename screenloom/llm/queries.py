"""The registered queries of this subpackage, and their SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import align, bpe, decontam, dom, fm, jaccard, ngram_lm, phrases, repetition, ring, substrings, tools, urls

WORD = r"[^\x20\x09-\x0D]+"
SPACES = r"[\x20\x09-\x0D]+"
#: Phrases of each language that op13 reports.
TOP = 2000
#: The rules that op5's contract lists.
URL_RULES = [urls.Rule("block", "com", "/en/"), urls.Rule("allow", "example.com", "/en/7"), urls.Rule("allow", "net", "/de/"), urls.Rule("block", "example.net", "/de/8"), urls.Rule("block", "org", "/es/")]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold(key: str, folds: int) -> Column:
    """crc32 of the key as text, modulo folds."""
    return F.crc32(F.col(key).cast("string").cast("binary")) % folds


def op1_repetition(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = repetition.rate_repetition(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "n_covered_words")


def op2_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    docs = docs.withColumn("train", F.coalesce(fold("doc_id", ngram_lm.FOLDS) != ngram_lm.HELD_OUT, F.lit(False)))
    out = ngram_lm.score_texts(docs)
    return out.select("doc_id", (~F.col("train")).alias("held_out"), "n_tokens", "n_known", "train_tokens", *[F.round(c, 6).alias(c) for c in ("base_score", "score")])


def op3_hash_ring(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = ring.shard_documents(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op4_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = bpe.round_trip(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op5_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = urls.filter_urls(table(spark, sf_dir, "pages").select("page_id", "url"), URL_RULES)
    return out.select("page_id", "host", "path", "rule", "verdict", "block_score")


def op6_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.link_documents(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op7_tool_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    calls, results = tools.conversation_calls(table(spark, sf_dir, "conversations"))
    out = tools.link_calls(calls, results, tools.CONVERSATION_TOOLS)
    return out.select(F.col("thread").alias("conv_id"), F.col("id").alias("call_id"), "name", "depth", "n_results", F.array_join("errors", "; ").alias("errors"), "json")


def op8_quality_fm(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "n_chars")
    labels = table(spark, sf_dir, "labels").where(fold("doc_id", fm.FOLDS) != fm.HELD_OUT)
    out = fm.score_quality(docs, fm.train(docs, labels))
    return out.select("doc_id", (F.coalesce(fold("doc_id", fm.FOLDS), F.lit(-1)) == fm.HELD_OUT).alias("held_out"), "score", (F.col("score") >= fm.THRESHOLD).cast("int").alias("predicted"))


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.find_leaks(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark"))


def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = substrings.remove_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    kept = F.trim(F.regexp_replace(F.coalesce("text", F.lit("")), SPACES, " "))
    return out.select("doc_id", "n_words", "n_removed", F.sha2(kept, 256).alias("kept_sha256"))


def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = align.align(table(spark, sf_dir, "documents").select("doc_id", "text"))
    digest = F.when(F.col("n_a") > 0, F.sha2("groups", 256)).otherwise("").alias("groups_sha256")
    return out.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", digest)


def op12_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    out = dom.extract(pages, dom.train(pages))
    return out.select("page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars"))


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = phrases.mine(table(spark, sf_dir, "documents").select("lang", "text"))
    return phrases.ranked(found, TOP).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


QUERIES = {
    "op1_repetition": op1_repetition,
    "op2_lm_scoring": op2_lm_scoring,
    "op3_hash_ring": op3_hash_ring,
    "op4_bpe": op4_bpe,
    "op5_url_filter": op5_url_filter,
    "op6_ngram_jaccard": op6_ngram_jaccard,
    "op7_tool_calls": op7_tool_calls,
    "op8_quality_fm": op8_quality_fm,
    "op9_decontamination": op9_decontamination,
    "op10_substring_dedup": op10_substring_dedup,
    "op11_token_alignment": op11_token_alignment,
    "op12_main_text": op12_main_text,
    "op13_collocations": op13_collocations,
}

LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

#: crc32 of a text of ASCII characters, as SQL has none: the table is made bit by bit.
CRC_TABLE = """crc_table AS (
  SELECT list(c ORDER BY n) AS crc FROM (
    SELECT n, list_reduce([n::BIGINT, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS c
    FROM range(256) r(n)))"""
CRC = "xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split({0}::VARCHAR, ''), lambda ch: ascii(ch)::BIGINT)), lambda c, b: xor(c >> 8, crc[(xor(c & 255, b) + 1)::BIGINT])), 4294967295)"

ORACLE_SQL = {
    "op1_repetition": rf"""
WITH t AS (SELECT doc_id, coalesce(text, '') AS x, coalesce(regexp_extract_all(text, '{WORD}'), []) AS ws FROM documents),
win AS (SELECT doc_id, k, p, array_to_string(ws[p:p + k - 1], ' ') AS g
        FROM (SELECT doc_id, ws, k, unnest(range(1, len(ws) - k + 2)) AS p FROM t, (VALUES (5), ({repetition.REPEAT}), ({repetition.LONGEST + 1})) s(k))),
again AS (SELECT doc_id, k, g FROM win GROUP BY doc_id, k, g HAVING count(*) > 1),
cov AS (SELECT doc_id, k, count(DISTINCT p + i)::BIGINT AS n FROM win JOIN again USING (doc_id, k, g), range({repetition.LONGEST + 1}) r(i) WHERE i < k GROUP BY doc_id, k),
lines AS (SELECT doc_id, count(*) - count(DISTINCT l) AS n FROM (SELECT doc_id, unnest(string_split(x, chr(10))) AS l FROM t) WHERE regexp_matches(l, '{WORD}') GROUP BY doc_id),
m AS (SELECT t.doc_id, len(ws)::BIGINT AS n_words, length(regexp_replace(x, '{SPACES}', '', 'g'))::BIGINT AS word_chars,
             length(regexp_replace(x, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols, coalesce(lines.n, 0)::BIGINT AS n_dup_lines,
             coalesce(a.n, 0) AS n_repeat_words, coalesce(b.n, 0) AS n_covered_words, coalesce(c.n, 0) > 0 AS long_repeat
      FROM t LEFT JOIN lines ON lines.doc_id = t.doc_id LEFT JOIN cov a ON a.doc_id = t.doc_id AND a.k = 5
           LEFT JOIN cov b ON b.doc_id = t.doc_id AND b.k = {repetition.REPEAT} LEFT JOIN cov c ON c.doc_id = t.doc_id AND c.k = {repetition.LONGEST + 1})
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
       NOT (n_words < 10 OR 100 * n_repeat_words > 20 * n_words) AND NOT long_repeat AND 100 * n_covered_words <= {repetition.COVERED} * n_words AS kept, n_covered_words
FROM m""",
    "op7_tool_calls": """
WITH asks AS (SELECT * FROM conversations WHERE role IN ('user', 'system')),
calls AS (SELECT a.conv_id, a.turn, CASE a.role WHEN 'user' THEN 'reply' ELSE 'configure' END AS name, a.text,
                 coalesce((SELECT max(b.turn) FROM asks b WHERE b.conv_id = a.conv_id AND b.turn IN (a.turn - 1, a.turn - 2)), -1) AS up
          FROM asks a),
chain AS (SELECT conv_id, turn, sum(CASE WHEN up < 0 THEN 1 ELSE 0 END) OVER w AS run FROM calls WINDOW w AS (PARTITION BY conv_id ORDER BY turn)),
d AS (SELECT conv_id, turn, row_number() OVER (PARTITION BY conv_id, run ORDER BY turn) - 1 AS depth FROM chain),
r AS (SELECT conv_id, turn - 1 AS turn, text FROM conversations WHERE role = 'assistant'),
j AS (SELECT c.*, d.depth, r.text AS result, r.turn IS NOT NULL AS has
      FROM calls c JOIN d ON d.conv_id = c.conv_id AND d.turn = c.turn LEFT JOIN r ON r.conv_id = c.conv_id AND r.turn = c.turn),
e AS (SELECT *, concat_ws('; ', CASE WHEN length(text) < 1 THEN 'text: too small' WHEN text IS NULL THEN 'text: missing' END, CASE WHEN NOT has THEN 'no result' END) AS errors FROM j)
SELECT conv_id, 'call-' || turn AS call_id, name, depth::BIGINT AS depth, has::BIGINT AS n_results, errors,
       CASE WHEN errors = '' THEN '{"arguments":{"text":' || to_json(text)::VARCHAR || ',"turn":' || turn || '},"id":"call-' || turn || '","name":"' || name || '","result":' || to_json(result)::VARCHAR || '}' END AS json
FROM e""",
    "op2_lm_scoring": rf"""
WITH {CRC_TABLE},
t AS (SELECT doc_id, {CRC.format("doc_id")} % 7 = 2 AS held_out,
             list_append(regexp_extract_all({LOWER}, '{WORD}'), '') AS ws
      FROM documents, crc_table),
tok AS (SELECT doc_id, held_out, unnest(ws) AS w, unnest(list_prepend(NULL, ws[:-2])) AS u, unnest(list_prepend(NULL, list_prepend(NULL, ws[:-3]))[:len(ws)]) AS x FROM t),
train AS (SELECT * FROM tok WHERE NOT held_out),
uni AS (SELECT w, count(*) AS c FROM train GROUP BY w),
bi AS (SELECT u, w, count(*) AS c FROM train WHERE u IS NOT NULL GROUP BY u, w),
tri AS (SELECT x, u, w, count(*) AS c FROM train WHERE x IS NOT NULL GROUP BY x, u, w),
tot AS (SELECT sum(c)::DOUBLE AS n, count(*)::DOUBLE AS v, sum(c)::BIGINT AS tokens FROM uni),
s1 AS (SELECT k.doc_id, k.held_out, a.c AS c1, h1.c AS ch1, b.c AS c2, h2.c AS ch2, t.c AS c3, tokens, (coalesce(a.c, 0) + 1) / (tot.n + tot.v + 1) AS p1
       FROM tok k LEFT JOIN uni a ON a.w = k.w LEFT JOIN uni h1 ON h1.w = k.u LEFT JOIN bi b ON b.u = k.u AND b.w = k.w
            LEFT JOIN bi h2 ON h2.u = k.x AND h2.w = k.u LEFT JOIN tri t ON t.x = k.x AND t.u = k.u AND t.w = k.w, tot),
s2 AS (SELECT *, CASE WHEN ch1 IS NULL THEN p1 ELSE (coalesce(c2, 0) + {ngram_lm.PRIOR}::DOUBLE * p1) / (ch1 + {ngram_lm.PRIOR}::DOUBLE) END AS p2 FROM s1),
s AS (SELECT *, CASE WHEN ch2 IS NULL OR ch2 < {ngram_lm.LEAST} THEN p2 ELSE (coalesce(c3, 0) + {ngram_lm.PRIOR}::DOUBLE * p2) / (ch2 + {ngram_lm.PRIOR}::DOUBLE) END AS p FROM s2)
SELECT doc_id, held_out, count(*)::BIGINT AS n_tokens, count(c1)::BIGINT AS n_known, any_value(tokens) AS train_tokens,
       round(sum(log10(p1)), 6) AS base_score, round(sum(log10(p)), 6) AS score
FROM s GROUP BY doc_id, held_out""",
    "op6_ngram_jaccard": rf"""
WITH RECURSIVE t AS (SELECT doc_id, regexp_extract_all({LOWER}, '{WORD}') AS ws FROM documents),
sh AS (SELECT DISTINCT doc_id, g FROM (
         SELECT doc_id, unnest(CASE WHEN len(ws) >= 5 THEN list_transform(range(1, len(ws) - 3), lambda p: array_to_string(ws[p:p + 4], ' '))
                                    WHEN len(ws) > 0 THEN [array_to_string(ws, ' ')] ELSE [] END) AS g FROM t)),
n AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id),
ov AS (SELECT a.doc_id AS i, b.doc_id AS j, count(*) AS o FROM sh a JOIN sh b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL),
links AS (SELECT i, j FROM ov JOIN n a ON a.doc_id = i JOIN n b ON b.doc_id = j WHERE 100 * o >= 75 * (a.n + b.n - o)),
e AS (SELECT i, j FROM links UNION ALL SELECT j, i FROM links),
r AS (SELECT doc_id AS i, doc_id AS c FROM documents UNION SELECT e.j, r.c FROM r JOIN e ON e.i = r.i)
SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, c.c AS component_id
FROM documents d LEFT JOIN n ON n.doc_id = d.doc_id JOIN (SELECT i, min(c) AS c FROM r GROUP BY i) c ON c.i = d.doc_id""",
    "op10_substring_dedup": rf"""
WITH t AS (SELECT doc_id, coalesce(regexp_extract_all(text, '{WORD}'), []) AS ws FROM documents),
win AS (SELECT doc_id, p, array_to_string(ws[p:p + 12], ' ') AS g FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 11)) AS p FROM t)),
f AS (SELECT g, min(doc_id) AS d FROM win GROUP BY g),
gone AS (SELECT DISTINCT doc_id, p + k AS p FROM win JOIN f ON f.g = win.g AND f.d < win.doc_id, range(13) r(k)),
w AS (SELECT doc_id, unnest(ws) AS w, unnest(range(1, len(ws) + 1)) AS p FROM t),
k AS (SELECT w.doc_id, count(gone.p)::BIGINT AS n_removed, string_agg(w.w, ' ' ORDER BY w.p) FILTER (gone.p IS NULL) AS kept
      FROM w LEFT JOIN gone ON gone.doc_id = w.doc_id AND gone.p = w.p GROUP BY w.doc_id)
SELECT t.doc_id, len(ws)::BIGINT AS n_words, coalesce(n_removed, 0)::BIGINT AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM t LEFT JOIN k ON k.doc_id = t.doc_id""",
    "op13_collocations": rf"""
WITH piece AS (SELECT lang, regexp_extract_all(x, '[^\x20\x09]+') AS ws FROM (
       SELECT coalesce(lang, '{phrases.UNKNOWN}') AS lang, unnest(string_split_regex({LOWER}, '[.,;:!?\x0A-\x0D]')) AS x FROM documents)),
gram AS MATERIALIZED (
  SELECT lang, k, g, count(*) AS f
  FROM (SELECT lang, k, array_to_string(ws[p:p + k - 1], ' ') AS g FROM (SELECT lang, ws, k, unnest(range(1, len(ws) - k + 2)) AS p FROM piece, range(1, {phrases.WORDS + 1}) r(k))) GROUP BY ALL
  HAVING count(*) >= {phrases.LEAST}),
c AS (SELECT lang, k AS size, g, f, string_split(g, ' ') AS ws FROM gram WHERE k > 1),
inner_part AS (SELECT lang, array_to_string(ws[p:p + k - 1], ' ') AS g, max(f) AS longer
               FROM (SELECT *, unnest(range(1, size - k + 2)) AS p FROM c, range(2, {phrases.WORDS}) r(k) WHERE k < size) GROUP BY ALL),
cut AS (SELECT lang, g, f, k, array_to_string(ws[:k], ' ') AS lg, array_to_string(ws[k + 1:], ' ') AS rg FROM c, range(1, {phrases.WORDS}) s(k) WHERE k < size),
scored AS (SELECT cut.*, a.f AS l, b.f AS r, {phrases.SCALE}::HUGEINT * cut.f // (a.f + b.f) AS score
           FROM cut JOIN gram a ON a.lang = cut.lang AND a.g = lg JOIN gram b ON b.lang = cut.lang AND b.g = rg),
best AS (SELECT *, row_number() OVER (PARTITION BY lang, g ORDER BY score, k) AS nth FROM scored),
spoken AS (SELECT lang, sum(len(ws))::BIGINT AS n FROM piece GROUP BY lang),
placed AS (SELECT b.*, row_number() OVER (PARTITION BY b.lang ORDER BY score DESC, f DESC, b.g) AS rank
           FROM best b LEFT JOIN inner_part i ON i.lang = b.lang AND i.g = b.g WHERE nth = 1 AND (longer IS NULL OR 100 * longer < {phrases.SHARE} * f))
SELECT lang, rank::BIGINT AS rank, g AS phrase, f::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n, score::BIGINT AS score FROM placed JOIN spoken USING (lang) WHERE rank <= {TOP}""",
}
