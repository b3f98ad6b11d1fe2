"""The numbered queries over the test tables, and the DuckDB statements of those that SQL can express."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aerofuse.llm import (
    collocations, decontaminate, fingerprint, jaccard, language, line_runs, packing, pfor, quality_rules, spelling, token_counts,
    tool_calls, url_filter,
)
from aerofuse.llm.deploy import prepare_tasks
from aerofuse.session import small_table

BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")

QUERIES: dict = {}
ORACLES: dict = {}


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    prepare_tasks(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def query(function):
    QUERIES[function.__name__] = function
    return function


@query
def op1_improbable_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint.fingerprints(_table(spark, sf_dir, "documents"))


# Conversations hold no tool calls, so their turns are taken for some: a user turn calls ``reply`` and takes the
# result of the call two turns earlier, a system turn calls ``setup``, an assistant turn is the result of the
# call one turn earlier; from turn 4 on, each third length takes the result four turns earlier, too. Each seventh length is
# given as text, ``setup`` lacks a parameter, and a name holds a quotation mark.
TOOLS = [("reply", "chars", "BIGINT", True), ("reply", "digest", "STRING", True),
         ("setup", "chars", "BIGINT", True), ("setup", "locale", "STRING", True), ("setup", 'a "strict" one', "BOOLEAN", False)]


def call_messages(conversations: DataFrame) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    chars = F.when(F.length(text) % 7 == 0, F.concat(F.lit('"'), F.length(text), F.lit('"'))).otherwise(F.length(text).cast("string"))
    one = F.concat(F.lit('"c'), F.col("turn") - 2, F.lit('"'))
    after = F.when((F.col("turn") >= 4) & (F.length(text) % 3 == 0), F.concat(F.lit("["), one, F.lit(',"c'), F.col("turn") - 4, F.lit('"]'))).when(
        F.col("turn") >= 2, one).otherwise("null")
    call = F.concat(
        F.lit('{"tool_calls":[{"name":"'), F.when(F.col("role") == "user", "reply").otherwise("setup"), F.lit('","id":"c'), F.col("turn"),
        F.lit('","after":'), F.when(F.col("role") == "user", after).otherwise("null"), F.lit(',"arguments":{'),
        F.when(F.col("role") == "user", F.concat(F.lit('"digest":"'), F.md5(text), F.lit('"'))).otherwise('"a \\"strict\\" one":true'),
        F.lit(',"chars":'), chars, F.lit("}}]}"))
    result = F.to_json(F.struct(F.concat(F.lit("c"), F.col("turn") - 1).alias("tool_call_id"), text.alias("content")))
    return conversations.where(F.col("role").isin("user", "system", "assistant")).select(
        "conv_id", "turn", F.when(F.col("role") == "assistant", "tool").otherwise("assistant").alias("role"),
        F.when(F.col("role") == "assistant", result).otherwise(call).alias("text"))


@query
def op2_tool_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    schemas = small_table(spark, TOOLS, "tool string, parameter string, type string, required boolean")
    linked = tool_calls.link(call_messages(_table(spark, sf_dir, "conversations")), schemas)
    return linked.select(
        "conv_id", "id", "name", F.col("turn").cast("long").alias("turn"), "depth", "order", F.col("result_turn").cast("long").alias("result_turn"),
        F.array_join("problems", ",").alias("problems"), "status", F.sha2("canonical", 256).alias("canonical_sha256"))


ORACLES["op2_tool_calls"] = r"""
WITH RECURSIVE turns AS (SELECT conv_id, CAST(turn AS BIGINT) AS turn, role, coalesce(text, '') AS text FROM conversations),
calls AS (
    SELECT conv_id, 'c' || turn AS id, turn, CASE WHEN role = 'user' THEN 'reply' ELSE 'setup' END AS name, text,
           CASE WHEN role <> 'user' OR turn < 2 THEN [] WHEN turn >= 4 AND length(text) % 3 = 0 THEN ['c' || (turn - 2), 'c' || (turn - 4)]
                ELSE ['c' || (turn - 2)] END AS preds,
           CASE WHEN length(text) % 7 = 0 THEN '"' || length(text) || '"' ELSE CAST(length(text) AS VARCHAR) END AS chars
    FROM turns WHERE role IN ('user', 'system')),
results AS (
    SELECT conv_id, 'c' || (turn - 1) AS id, turn AS result_turn, text AS content FROM turns WHERE role = 'assistant'),
missing AS (
    SELECT p.conv_id, p.id FROM (SELECT conv_id, id, unnest(preds) AS pred FROM calls) p
    LEFT JOIN calls c ON c.conv_id = p.conv_id AND c.id = p.pred WHERE c.id IS NULL),
lost AS (
    SELECT conv_id, id FROM missing
    UNION SELECT c.conv_id, c.id FROM calls c JOIN lost l ON l.conv_id = c.conv_id AND list_contains(c.preds, l.id)),
chain AS (
    SELECT conv_id, id, CAST(0 AS BIGINT) AS depth FROM calls WHERE len(preds) = 0
    UNION SELECT c.conv_id, c.id, h.depth + 1 FROM calls c JOIN chain h ON c.conv_id = h.conv_id AND list_contains(c.preds, h.id)),
deepest AS (
    SELECT h.conv_id, h.id, max(depth) AS depth FROM chain h LEFT JOIN lost l ON l.conv_id = h.conv_id AND l.id = h.id
    WHERE l.id IS NULL GROUP BY h.conv_id, h.id),
joined AS (
    SELECT c.conv_id, c.id, c.name, c.turn, c.text, c.preds, c.chars, r.result_turn, r.content, h.depth,
        row_number() OVER (PARTITION BY c.conv_id ORDER BY h.depth NULLS LAST, c.turn) AS "order", array_to_string(list_filter([
        CASE WHEN name = 'setup' THEN 'missing locale' END,
        CASE WHEN chars LIKE '"%' THEN 'type chars' END], lambda x: x IS NOT NULL), ',') AS problems
    FROM calls c LEFT JOIN results r ON r.conv_id = c.conv_id AND r.id = c.id LEFT JOIN deepest h ON h.conv_id = c.conv_id AND h.id = c.id)
SELECT conv_id, id, name, turn, depth, "order", result_turn, problems,
       CASE WHEN depth IS NULL THEN 'unordered' WHEN problems <> '' THEN 'invalid'
            WHEN result_turn IS NULL THEN 'unanswered' ELSE 'ok' END AS status,
       sha256('{' || CASE len(preds) WHEN 0 THEN '' WHEN 1 THEN '"after":"' || preds[1] || '",'
                          ELSE '"after":["' || array_to_string(preds, '","') || '"],' END
           || '"arguments":{' || CASE WHEN name = 'reply' THEN '"chars":' || chars || ',"digest":"' || md5(text) || '"'
                                      ELSE '"a \"strict\" one":true,"chars":' || chars END
           || '}' || CASE WHEN content IS NULL THEN '' ELSE ',"content":' || CAST(to_json(content) AS VARCHAR) END
           || ',"id":"' || id || '","name":"' || name || '"}') AS canonical_sha256
FROM joined
UNION ALL SELECT r.conv_id, r.id, NULL, NULL, NULL, NULL, r.result_turn, '', 'orphan',
       sha256('{"content":' || CAST(to_json(r.content) AS VARCHAR) || ',"id":"' || r.id || '"}')
FROM results r LEFT JOIN calls c ON c.conv_id = r.conv_id AND c.id = r.id WHERE c.id IS NULL"""


@query
def op3_nearest_centroid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    held = language.held_out()
    model = language.fit(docs.where(~held))
    found = docs.select("doc_id", held.alias("held_out"), language.identify("text", model).alias("found"))
    return found.select("doc_id", "held_out", "found.lang_pred", "found.score", "found.rejected")


@query
def op4_line_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = line_runs.without_copies(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return cut.select(
        "doc_id", F.col("lines_deleted").cast("long").alias("lines_deleted"), F.sha2(F.coalesce("text", F.lit("")), 256).alias("text_sha256"))


@query
def op5_bm25_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed(_table(spark, sf_dir, "documents"), BYTE_BPE)


@query
def op6_pfor_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = pfor.new_folder(spark)
    files = pfor.write_ids(_table(spark, sf_dir, "documents"), BYTE_BPE, folder)
    return pfor.read_documents(spark, files, folder)


@query
def op7_wu_manber(spark: SparkSession, sf_dir: str) -> DataFrame:
    marked = decontaminate.contamination(
        _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"), into="leak")
    # Items without id are counted as one and are not named.
    unnamed = F.col("leak.unnamed").cast("long")
    return marked.select(
        "doc_id", "leak.n_words", "leak.n_hit", (F.size("leak.items") + unnamed).alias("n_items"),
        F.sha2(F.array_join("leak.items", ","), 256).alias("items_sha256"),
        (F.col("leak.n_hit") > 0).alias("contaminated"))


ORACLES["op7_wu_manber"] = r"""
WITH doc_words AS (
    SELECT doc_id, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
item_words AS (
    SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all(
        translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark WHERE text IS NOT NULL),
sized AS (SELECT item, w, least(len(w), 10) AS m FROM item_words WHERE len(w) > 0),
patterns AS (
    SELECT DISTINCT item, m, array_to_string(w[p:p + m - 1], ' ') AS pattern
    FROM (SELECT item, w, m, unnest(range(1, len(w) - m + 2)) AS p FROM sized)),
lengths AS (SELECT DISTINCT m FROM patterns),
spots AS (
    SELECT doc_id, m, p, array_to_string(w[p:p + m - 1], ' ') AS pattern
    FROM (SELECT doc_id, w, m, unnest(range(1, len(w) - m + 2)) AS p FROM doc_words, lengths WHERE len(w) >= m)),
found AS (SELECT s.doc_id, s.m, s.p, q.item FROM spots s JOIN patterns q ON s.m = q.m AND s.pattern = q.pattern),
covered AS (
    SELECT doc_id, count(DISTINCT k) AS n_hit FROM (SELECT doc_id, unnest(range(p, p + m)) AS k FROM found) GROUP BY doc_id),
named AS (
    SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
    FROM (SELECT DISTINCT doc_id, item FROM found) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, coalesce(c.n_hit, 0) AS n_hit, coalesce(n.n_items, 0) AS n_items,
       sha256(coalesce(n.items, '')) AS items_sha256, coalesce(c.n_hit, 0) > 0 AS contaminated
FROM doc_words d LEFT JOIN covered c USING (doc_id) LEFT JOIN named n USING (doc_id)"""


URL_RULES = [
    url_filter.Rule("allow", "com", "/"), url_filter.Rule("block", "example.com", "/en/"),
    url_filter.Rule("allow", "www.example.com", "/en/"), url_filter.Rule("block", "net", "/es/"), url_filter.Rule("block", "net", "/fr/"),
]


@query
def op8_boosted_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(_table(spark, sf_dir, "pages"), URL_RULES)


@query
def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(_table(spark, sf_dir, "documents"), BYTE_BPE)


@query
def op10_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.near_join(_table(spark, sf_dir, "documents"))


ORACLES["op10_ngram_jaccard"] = r"""
WITH RECURSIVE doc_words AS (
    SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
sets AS (
    SELECT doc_id, CASE WHEN len(w) = 0 THEN ['text:' || text]
        ELSE list_sort(list_distinct(list_transform(range(1, greatest(len(w) - 4, 1) + 1),
            lambda p: array_to_string(w[p:p + 4], ' ')))) END AS s, len(w) > 0 AS worded FROM doc_words),
classes AS (SELECT s, worded, min(doc_id) AS class_id FROM sets GROUP BY s, worded),
flat AS (SELECT class_id, len(s) AS n, unnest(s) AS shingle FROM classes WHERE worded),
common AS (
    SELECT a.class_id AS a, b.class_id AS b, a.n AS na, b.n AS nb, count(*) AS k
    FROM flat a JOIN flat b ON a.shingle = b.shingle AND a.class_id <> b.class_id GROUP BY ALL),
links AS (SELECT a, b FROM common WHERE k >= 0.8 * (na + nb - k)),
reach AS (
    SELECT class_id AS a, class_id AS b FROM classes
    UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a),
roots AS (SELECT a, min(b) AS group_id FROM reach GROUP BY a),
degrees AS (SELECT a, count(*) AS n_links FROM links GROUP BY a)
SELECT t.doc_id, c.class_id, r.group_id, coalesce(d.n_links, 0) AS n_links
FROM sets t JOIN classes c ON t.s = c.s AND t.worded = c.worded JOIN roots r ON r.a = c.class_id
LEFT JOIN degrees d ON d.a = c.class_id"""


@query
def op11_trie_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.spelling_variants(_table(spark, sf_dir, "documents"))


ORACLES["op11_trie_pairs"] = r"""
WITH crc AS (
    SELECT list_transform(range(256), lambda i: list_reduce(
        range(8), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, i)) AS t),
runs AS (
    SELECT doc_id, run, count(*) AS n FROM (
        SELECT doc_id, unnest(regexp_extract_all(
            translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-zÀ-ÿ]+')) AS run FROM documents)
    WHERE length(run) >= 6 GROUP BY ALL),
hashed AS (
    SELECT run, n, length(run) AS size, xor(list_reduce(
        flatten(list_transform(string_split(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run, ''),
            lambda c: CASE WHEN ord(c) < 128 THEN [CAST(ord(c) AS BIGINT)] ELSE [195, CAST(ord(c) AS BIGINT) - 64] END)),
        lambda s, b: xor(s >> 8, t[(xor(s, b) & 255) + 1]), 4294967295), 4294967295) AS h FROM runs, crc),
shortened AS (
    SELECT CASE WHEN h % 199 = 0 THEN substr(run, 1, CAST(h % size AS BIGINT)) || substr(run, CAST(h % size AS BIGINT) + 2)
                ELSE run END AS word, n FROM hashed),
words AS (
    SELECT word, CAST(sum(n) AS BIGINT) AS n FROM shortened WHERE length(word) >= 6 GROUP BY word HAVING sum(n) >= 5),
holes AS (
    SELECT word, n, substr(word, 1, i) || '_' || substr(word, i + 2) AS hole, substr(word, 1, i) || substr(word, i + 2) AS rest
    FROM (SELECT word, n, unnest(range(length(word))) AS i FROM words)),
near AS (
    SELECT DISTINCT a.word, b.word AS other, b.n AS other_n FROM holes a JOIN holes b ON a.hole = b.hole AND a.word <> b.word
    UNION SELECT h.word, w.word, w.n FROM holes h JOIN words w ON h.rest = w.word
    UNION SELECT w.word, h.word, h.n FROM holes h JOIN words w ON h.rest = w.word),
best AS (
    SELECT word, count(*) AS n_near, max(other_n) AS best_n FROM near GROUP BY word),
named AS (
    SELECT b.word, n_near, best_n, min(x.other) AS best FROM best b JOIN near x ON x.word = b.word AND x.other_n = b.best_n
    GROUP BY ALL),
formed AS (
    SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN best_n >= 5 * w.n THEN best END AS form,
           CASE WHEN best_n >= 5 * w.n THEN best_n END AS form_n FROM words w LEFT JOIN named m ON m.word = w.word)
SELECT a.word, a.form, coalesce(f5.form, f4.form, f3.form, f2.form, f1.form, a.form, a.word) AS root, a.n, a.n_near, a.form_n
FROM formed a LEFT JOIN formed f1 ON f1.word = a.form LEFT JOIN formed f2 ON f2.word = f1.form
LEFT JOIN formed f3 ON f3.word = f2.form LEFT JOIN formed f4 ON f4.word = f3.form LEFT JOIN formed f5 ON f5.word = f4.form"""


@query
def op12_count_automata(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(_table(spark, sf_dir, "documents"))


ORACLES["op12_count_automata"] = r"""
WITH pieces AS (
    SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
    FROM documents),
spelled AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
phrases AS (
    SELECT lang, m, array_to_string(w[p:p + m - 1], ' ') AS phrase, count(*) AS f
    FROM (SELECT lang, w, m, unnest(range(1, len(w) - m + 2)) AS p FROM spelled, (SELECT unnest([1, 2, 3, 4]) AS m) WHERE len(w) >= m)
    GROUP BY ALL),
total AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM phrases WHERE m = 1 GROUP BY lang),
candidates AS (SELECT lang, m, phrase, f AS a, string_split(phrase, ' ') AS w FROM phrases WHERE m >= 2 AND f >= 30),
cuts AS (
    SELECT lang, phrase, a, k, array_to_string(w[1:k], ' ') AS head, array_to_string(w[k + 1:m], ' ') AS rest
    FROM (SELECT *, unnest(range(1, m)) AS k FROM candidates)),
scored AS (
    SELECT c.lang, c.phrase, c.a, c.k, h.f AS l, t.f AS r, CAST((CAST(2000000 AS HUGEINT) * c.a) // (h.f + t.f) AS BIGINT) AS score
    FROM cuts c JOIN phrases h ON h.lang = c.lang AND h.phrase = c.head JOIN phrases t ON t.lang = c.lang AND t.phrase = c.rest),
least_cut AS (
    SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) AS place FROM scored),
inside AS (
    SELECT lang, array_to_string(w[p:p + q - 1], ' ') AS phrase, max(a) AS longer
    FROM (SELECT lang, m, w, a, q, unnest(range(1, m - q + 2)) AS p FROM candidates, (SELECT unnest([2, 3]) AS q) WHERE q < m) GROUP BY ALL),
kept AS (
    SELECT s.* FROM least_cut s LEFT JOIN inside i ON i.lang = s.lang AND i.phrase = s.phrase
    WHERE place = 1 AND (i.longer IS NULL OR 100 * CAST(i.longer AS HUGEINT) < 80 * CAST(s.a AS HUGEINT))),
ranked AS (
    SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank FROM kept)
SELECT r.lang, r.rank, r.phrase, r.a, r.l, r.r, t.n, r.score FROM ranked r JOIN total t ON t.lang = r.lang WHERE r.rank <= 2000"""


@query
def op13_certified_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judge(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


ORACLES["op13_certified_rules"] = r"""
WITH texts AS (
    SELECT doc_id, coalesce(lang, 'und') AS stratum, md5(text) AS digest, coalesce(text, '') AS text,
           regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
           list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines,
           row_number() OVER () AS nr FROM documents),
windows AS (
    SELECT nr, p, w[p] || chr(10) || w[p + 1] || chr(10) || w[p + 2] AS three
    FROM (SELECT nr, w, unnest(range(1, len(w) - 1)) AS p FROM texts WHERE len(w) >= 3)),
again AS (SELECT nr, p, count(*) OVER (PARTITION BY nr, three) AS n FROM windows),
repeated AS (
    SELECT nr, count(DISTINCT k) AS n FROM (SELECT nr, unnest([p, p + 1, p + 2]) AS k FROM again WHERE n > 1) GROUP BY nr),
counted AS (
    SELECT doc_id, stratum, digest, CAST(len(w) AS BIGINT) AS n_words,
           CAST(length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g')) AS BIGINT) AS word_chars,
           CAST(length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
           CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines, coalesce(r.n, 0) AS n_repeat_words,
           CAST(len(lines) AS BIGINT) AS n_lines, length(text) - length(regexp_replace(text, '[.,;:!?]', '', 'g')) AS n_marks,
           length(text) - length(regexp_replace(text, '[A-Z]', '', 'g')) AS n_capitals,
           length(text) - length(regexp_replace(text, '[0-9]', '', 'g')) AS n_digits
    FROM texts t LEFT JOIN repeated r ON r.nr = t.nr),
measured AS (
    SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
           [1000 * n_symbols // greatest(word_chars, 1), 1000 * n_marks // greatest(word_chars, 1),
            1000 * n_capitals // greatest(word_chars, 1), 1000 * n_digits // greatest(word_chars, 1),
            1000 * n_dup_lines // greatest(n_lines, 1), 1000 * n_repeat_words // greatest(n_words, 1)] AS shares FROM counted),
labelled AS (
    SELECT stratum, good, digest, any_value(shares) AS shares, substr(digest, 1, 1) >= '8' AS tested
    FROM measured m JOIN (SELECT DISTINCT doc_id, quality > 0 AS good FROM labels WHERE quality IS NOT NULL) l ON l.doc_id = m.doc_id
    WHERE NOT base_failed GROUP BY stratum, good, digest),
histogram AS (
    SELECT stratum, rule, shares[rule] AS value, count(*) AS n
    FROM (SELECT stratum, shares, unnest([1, 2, 3, 4, 5, 6]) AS rule FROM labelled WHERE good AND NOT tested) GROUP BY ALL),
above AS (
    SELECT *, sum(n) OVER (PARTITION BY stratum, rule ORDER BY value DESC) - n AS above,
           sum(n) OVER (PARTITION BY stratum, rule) AS total FROM histogram),
rungs AS (SELECT unnest([0, 1, 2, 3, 4, 5, 6]) AS rung, unnest([0, 1, 2, 5, 10, 20, 50]) AS allowed),
cutoffs AS (
    SELECT stratum, rule, rung, min(value) AS cutoff FROM above, rungs WHERE above * 1000 <= allowed * total GROUP BY ALL),
wide AS (
    SELECT stratum, rung, list(cutoff ORDER BY rule) AS c FROM cutoffs GROUP BY stratum, rung),
held AS (
    SELECT l.stratum, l.good, l.digest, coalesce(min(CASE WHEN len(list_filter([1, 2, 3, 4, 5, 6], lambda r: shares[r] > c[r])) > 0
        THEN rung END), 7) AS rung FROM labelled l JOIN wide w ON w.stratum = l.stratum WHERE tested GROUP BY ALL),
strata AS (
    SELECT stratum, count(*) FILTER (good) AS n, count(*) FILTER (NOT good) AS m FROM held GROUP BY stratum),
rejected AS (
    SELECT s.stratum, r.rung, n, m, (SELECT count(*) FROM strata WHERE n > 0) AS tests,
           count(h.rung) FILTER (h.good) AS k, count(h.rung) FILTER (NOT h.good) AS caught
    FROM strata s CROSS JOIN rungs r LEFT JOIN held h ON h.stratum = s.stratum AND h.rung <= r.rung WHERE n > 0 GROUP BY ALL),
tails AS (
    SELECT stratum, rung, n, m, k, caught, tests,
           CASE WHEN k >= n THEN 1 ELSE list_sum(list_transform(range(k + 1), lambda i:
               exp(lgamma(n + 1) - CASE WHEN i = 0 THEN 0 ELSE lgamma(i + 1) END - lgamma(n - i + 1) + i * ln(0.03) + (n - i) * ln(0.97)))) END AS tail
    FROM rejected),
passed AS (
    SELECT *, CASE WHEN m > 0 THEN caught / CAST(m AS DOUBLE) ELSE 0 END - k / CAST(n AS DOUBLE) AS gain,
           bool_and(tail <= 0.05 / tests) OVER (PARTITION BY stratum ORDER BY rung) AS certain FROM tails),
chosen AS (
    SELECT stratum, arg_min(rung, rung) FILTER (gain >= best - 1e-12) AS chosen
    FROM (SELECT *, max(gain) OVER (PARTITION BY stratum) AS best FROM passed WHERE certain) WHERE best > 1e-12 GROUP BY stratum),
judged AS (
    SELECT m.doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, m.stratum,
           coalesce(list_min(list_transform(list_filter([0, 1, 2, 3, 4, 5, 6], lambda t:
               len(list_filter([1, 2, 3, 4, 5, 6], lambda r: shares[r] > ladder[t + 1][r])) > 0), lambda t: t)), 7) AS rung
    FROM measured m LEFT JOIN (SELECT stratum, list(c ORDER BY rung) AS ladder FROM wide GROUP BY stratum) w ON w.stratum = m.stratum)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND NOT rung <= coalesce(chosen, -1) AS kept, CAST(rung AS INTEGER) AS rung,
       CAST(coalesce(chosen, -1) AS INTEGER) AS chosen
FROM judged j LEFT JOIN chosen c ON c.stratum = j.stratum"""
