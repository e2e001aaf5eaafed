"""The registered queries of the training-data operators: thin wrappers over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import byte_bpe, chat, collocations, decontamination, fill_in_middle, html_text, langid, line_dedup, lm_score, minhash, sentencepiece_fst, suffix_dedup, topk


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = line_dedup.drop_repeated(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return kept.select("doc_id", F.col("line_dedup_total").alias("n_lines"), F.col("line_dedup_dropped").alias("n_dropped"), F.sha2("text", 256).alias("kept_sha256"))


def op2_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    good = _table(spark, sf_dir, "labels").where("quality = 1").select("doc_id")
    scores = lm_score.cross_entropy_difference(_table(spark, sf_dir, "documents"), good)
    return scores.withColumns({c: F.round(c, 6) for c in ("target_bits", "background_bits", "score")})


def op3_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(_table(spark, sf_dir, "pages"))


def op4_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    control = "</s>[INST] ok [/INST]"
    probe = spark.createDataFrame([(-7, 0, "user", control), (-7, 1, "assistant", control)], "conv_id bigint, turn bigint, role string, text string")
    return chat.read_back(chat.format_turns(table.unionByName(probe)))


def op5_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(_table(spark, sf_dir, "documents"), shingle=2, percent=80)


def op6_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    matches = decontamination.find_matches(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    return decontamination.contamination(matches).drop("row_key", "items")


def op7_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.remove_repeats(_table(spark, sf_dir, "documents"), length=100).drop("kept")


def op8_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentencepiece_fst.encode_decode(_table(spark, sf_dir, "documents"), sentencepiece_fst.read_model(spark))


def op9_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    held = langid.held_out(F.col("doc_id"))
    found = langid.predict(docs, langid.fit(docs, ~held))
    return found.select("doc_id", langid.held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score", "rejected")


def op10_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(_table(spark, sf_dir, "documents"))


def op12_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    ranks = byte_bpe.read_ranks(spark, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    encoded = byte_bpe.encode(_table(spark, sf_dir, "documents"), ranks, pattern=public_tokenizers.PATTERN)
    return byte_bpe.decode(encoded, ranks).select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op13_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fill_in_middle.fill_in_middle(_table(spark, sf_dir, "documents"))
    again = fill_in_middle.restored(F.col("output"), F.col("form"))
    return rows.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2(F.col("output").cast("binary"), 256).alias("output_sha256"), F.sha2(again.cast("binary"), 256).alias("restored_sha256"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_line_dedup, op2_lm_score, op3_main_text, op4_chat_format, op5_near_duplicates, op6_decontaminate, op7_suffix_dedup, op8_sentencepiece, op9_language, op10_top_k, op11_collocations, op12_byte_bpe, op13_fill_in_middle)}


_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

_LINES = f"""
WITH l AS (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line, unnest(range(len(string_split(coalesce(text, ''), chr(10))))) AS pos FROM documents),
k AS (SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), '{_UPPER}', '{_UPPER.lower()}') AS key FROM l),
s AS (SELECT key, max(doc_id) AS top FROM k WHERE length(key) >= 20 GROUP BY key HAVING count(DISTINCT doc_id) >= 3),
d AS (SELECT k.*, s.top IS NOT NULL AND k.doc_id <> s.top AS gone FROM k LEFT JOIN s USING (key))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped, sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM d GROUP BY doc_id
"""

#: Witten-Bell bigrams with add-one unigrams; '' stands before a first word, and is an entry too.
_SCORES = rf"""
WITH w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_UPPER.lower()}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w, doc_id IN (SELECT doc_id FROM labels WHERE quality = 1) AS good FROM documents),
u AS (SELECT doc_id, good, unnest(list_transform(range(0, len(w)), lambda i: {{'a': CASE WHEN i = 0 THEN '' ELSE w[i] END, 'b': w[i + 1]}})) AS p FROM w),
t AS (SELECT doc_id, good, p.a AS a, p.b AS b FROM u),
pairs AS (SELECT a, b, count(*) AS n, count(*) FILTER (good) AS m FROM t GROUP BY a, b),
f AS (SELECT a, sum(n) AS fn, sum(m) AS fm, count(*) AS kn, greatest(count(*) FILTER (m > 0), 1) AS km FROM pairs GROUP BY a),
o AS (SELECT b, sum(n) + 1 AS un, sum(m) + 1 AS um FROM pairs GROUP BY b),
e AS (SELECT sum(n) AS tn, sum(m) AS tm, count(DISTINCT b) + 1 AS entries FROM pairs),
loss AS (SELECT a, b, -log2((m + km * um / (tm + entries)) / (fm + km)) AS target, -log2((n + kn * un / (tn + entries)) / (fn + kn)) AS background FROM pairs JOIN f USING (a) JOIN o USING (b), e),
d AS (SELECT doc_id, count(*) AS n_tokens, avg(target) AS target, avg(background) AS background FROM t JOIN loss USING (a, b) GROUP BY doc_id)
SELECT doc_id, coalesce(n_tokens, 0) AS n_tokens, round(target, 6) AS target_bits, round(background, 6) AS background_bits, round(target - background, 6) AS score FROM documents LEFT JOIN d USING (doc_id)
"""

#: Sets that are linked share one of their rarest shingles, so many that fewer could not be left out of one of them.
_NEAR = rf"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_UPPER.lower()}'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, hash(unnest(CASE WHEN len(w) < 2 THEN w ELSE list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]) END)) AS h FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
r AS (SELECT doc_id, h, n, row_number() OVER (PARTITION BY doc_id ORDER BY f, h) AS place FROM s JOIN n USING (doc_id) JOIN (SELECT h, count(*) AS f FROM s GROUP BY h) USING (h)),
prefix AS (SELECT doc_id, h, n FROM r WHERE place <= n - CAST(ceil(n * 0.8) AS BIGINT) + 1),
pairs AS (SELECT DISTINCT a.doc_id AS x, b.doc_id AS y, a.n AS nx, b.n AS ny FROM prefix a JOIN prefix b USING (h) WHERE a.doc_id < b.doc_id AND 100 * least(a.n, b.n) >= 80 * greatest(a.n, b.n)),
links AS (SELECT x, y FROM pairs JOIN s a ON a.doc_id = x JOIN s b ON b.doc_id = y AND a.h = b.h GROUP BY x, y, nx, ny HAVING 100 * count(*) >= 80 * (nx + ny - count(*))),
both_ AS (SELECT x, y FROM links UNION SELECT y, x FROM links),
reach AS (SELECT x, y FROM both_ UNION SELECT r.x, b.y FROM reach r JOIN both_ b ON r.y = b.x),
c AS (SELECT x AS doc_id, least(x, min(y)) AS component_id FROM reach GROUP BY x)
SELECT doc_id, coalesce(n, 0) AS n_shingles, coalesce(component_id, doc_id) AS component_id, coalesce(component_id, doc_id) = doc_id AS kept FROM w LEFT JOIN n USING (doc_id) LEFT JOIN c USING (doc_id)
"""

#: A turn's template has 8 + 8 + 7 characters; each control string and backslash in a text gets one more.
_CHAT = r"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
e AS (SELECT *, len(regexp_extract_all(role || chr(1) || text, '\\|<\||<s>|</s>|\[INST\]|\[/INST\]|<<SYS>>|<</SYS>>')) AS more FROM t)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(23 + length(role) + length(text) + more) AS BIGINT) AS formatted_chars
FROM e GROUP BY conv_id
"""

_LEAKS = rf"""
WITH w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_UPPER.lower()}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_UPPER.lower()}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
windows AS (SELECT DISTINCT item_id, least(len(w), 10) AS n, unnest(list_transform(range(1, greatest(len(w) - 9, 1) + 1), lambda i: array_to_string(w[i:i + 9], ' '))) AS win FROM b WHERE len(w) > 0),
places AS (SELECT doc_id, n, unnest(range(1, len(w) - n + 2)) AS i, w FROM w, (SELECT DISTINCT n FROM windows) WHERE len(w) >= n),
found AS (SELECT doc_id, i, p.n, item_id FROM (SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS win FROM places) p JOIN windows USING (n, win)),
hits AS (SELECT doc_id, count(DISTINCT h) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS h FROM found) GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM found) GROUP BY doc_id)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM w LEFT JOIN hits USING (doc_id) LEFT JOIN items USING (doc_id)
"""

#: The pages' articles have the elements p, h1, b and br, and the references amp and quot.
_MAIN = r"""
WITH a AS (SELECT page_id, url, regexp_extract(coalesce(html, ''), '(?s)<article>(.*?)(</article>|$)', 1) AS body FROM pages),
b AS (SELECT page_id, url, list_transform(string_split_regex(replace(body, '<br>', ' '), '</?(p|h1)>'), lambda x: trim(regexp_replace(
  regexp_replace(regexp_replace(regexp_replace(x, '<[^>]*>', '', 'g'), '&quot;?', '"', 'g'), '&amp;?', '&', 'g'), '\s+', ' ', 'g'))) AS blocks FROM a),
t AS (SELECT page_id, url, coalesce(array_to_string(list_filter(blocks, lambda x: x <> ''), chr(10) || chr(10)), '') AS text FROM b)
SELECT page_id, url, text, length(text) AS n_chars FROM t
"""

_TOP = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v FROM embeddings WHERE embedding IS NOT NULL),
s AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score FROM v q, v c WHERE q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INT) AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
"""

#: Phrases are told by their words, joined by chr(1).
_PHRASES = rf"""
WITH p AS (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''), '{_UPPER}', '{_UPPER.lower()}'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM p),
g AS (SELECT lang, k, array_to_string(w[i:i + k - 1], chr(1)) AS g FROM (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM w, (SELECT unnest(range(1, 6)) AS k) WHERE len(w) >= k)),
f AS (SELECT lang, g, k, count(*) AS f FROM g GROUP BY lang, g, k),
n AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM f WHERE k = 1 GROUP BY lang),
c AS (SELECT lang, g, k, f AS a, string_split(g, chr(1)) AS ws FROM f WHERE k >= 2 AND f >= 100),
cuts AS (SELECT lang, g, a, ws, k, cut, array_to_string(ws[1:cut], chr(1)) AS x, array_to_string(ws[cut + 1:], chr(1)) AS y FROM (SELECT *, unnest(range(1, k)) AS cut FROM c)),
s AS (SELECT cuts.*, x.f AS l, y.f AS r, n, CAST((1000::HUGEINT * a * n) // (x.f::HUGEINT * y.f) AS BIGINT) AS score FROM cuts JOIN f x ON x.lang = cuts.lang AND x.g = cuts.x JOIN f y ON y.lang = cuts.lang AND y.g = cuts.y JOIN n ON n.lang = cuts.lang),
best AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, g ORDER BY score, cut) = 1),
gone AS (SELECT DISTINCT a.lang, a.g FROM c a JOIN c b ON a.lang = b.lang AND a.k < b.k AND 100 * b.a >= 100 * a.a AND contains(chr(1) || b.g || chr(1), chr(1) || a.g || chr(1))),
kept AS (SELECT lang, replace(g, chr(1), ' ') AS phrase, a, l, r, n, score FROM best WHERE NOT EXISTS (SELECT 1 FROM gone WHERE gone.lang = best.lang AND gone.g = best.g))
SELECT lang, CAST(row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS INT) AS rank, phrase, a, l, r, n, score FROM kept
QUALIFY row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) <= 2000
"""

_MIDDLE = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS u, sha256('1:' || CAST(doc_id AS VARCHAR)) AS h FROM documents),
n AS (SELECT doc_id, text, u, CAST(len(u) AS BIGINT) AS n, CAST('0x' || h[1:8] AS BIGINT) AS h1, CAST('0x' || h[9:16] AS BIGINT) AS h2, CAST('0x' || h[17:24] AS BIGINT) AS h3, CAST('0x' || h[25:32] AS BIGINT) AS h4 FROM d),
k AS (SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
  CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 90 THEN 'plain' WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM n),
p AS (SELECT *, array_to_string(u[1:a], '') AS pre, array_to_string(u[a + 1:b], '') AS mid, array_to_string(u[b + 1:], '') AS suf FROM k)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(pre) END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(mid) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || pre || '<S>' || suf || '<M>' || mid ELSE '<S>' || suf || '<P>' || pre || '<M>' || mid END) AS output_sha256, sha256(text) AS restored_sha256
FROM p
"""


def oracle_sql() -> dict[str, str]:
    """The others aren't expressible in SQL; tests/llm holds them to brute force, round trips or held-out rows."""
    return {"op1_line_dedup": _LINES, "op2_lm_score": _SCORES, "op5_near_duplicates": _NEAR, "op3_main_text": _MAIN, "op4_chat_format": _CHAT, "op6_decontaminate": _LEAKS, "op10_top_k": _TOP, "op11_collocations": _PHRASES, "op13_fill_in_middle": _MIDDLE}
