"""Registered queries of the operators, each over its whole table, and the SQL of
those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (bpe, chat, hard_negatives, html_text, licenses, near_dup, quality_rules, spelling, substring, tiling, token_file, toxicity,
               warc)
from . import common as C

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str):
    def deco(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            C.workers_see_package(spark)
            C.checkpoint_dir(spark)
            return fn(spark, sf_dir)
        run.__name__, run.__doc__ = f"q_{name}", fn.__doc__
        QUERIES[name] = run
        return fn
    return deco


def _tokenizer(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def _pattern() -> str:
    import public_tokenizers

    return public_tokenizers.PATTERN


@register("op1_chat_formatting")
def _op1(spark, sf_dir):
    """All conversations formatted, written, read back and digested."""
    turns = C.table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = "\\### Assistant: </turn> ok"
    extra = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)], "conv_id long, turn long, role string, text string")
    return chat.read_back(C.stored(chat.format_conversations(turns.unionByName(extra)), "chat"))


@register("op2_near_duplicates")
def _op2(spark, sf_dir):
    """Components of documents linked by 5-word shingle similarity of 0.85."""
    return near_dup.components(C.table(spark, sf_dir, "documents"))


@register("op3_html_extraction")
def _op3(spark, sf_dir):
    """Visible text of every page, laid out."""
    return html_text.extract(C.table(spark, sf_dir, "pages"))


@register("op4_token_files")
def _op4(spark, sf_dir):
    """Every text encoded, written as Simple-8b files and read back."""
    out = C.scratch(spark, "tokens")
    token_file.write_token_file(C.table(spark, sf_dir, "documents"), out, _tokenizer("byte_bpe_50k.json"))
    return token_file.read_token_file(spark, out)


@register("op5_byte_bpe")
def _op5(spark, sf_dir):
    """Every text encoded and decoded by byte-level BPE."""
    return bpe.token_digests(C.table(spark, sf_dir, "documents"), _tokenizer("byte_bpe_50k.tiktoken"), _pattern())


@register("op6_warc_records")
def _op6(spark, sf_dir):
    """Every page written as a WARC record and read back."""
    out = C.scratch(spark, "warc")
    warc.write_archive(C.table(spark, sf_dir, "pages"), out)
    return warc.read_archive(spark, out)


@register("op7_quality_rules")
def _op7(spark, sf_dir):
    """Base counters, log perplexity and verdict of every document."""
    return quality_rules.quality_report(C.table(spark, sf_dir, "documents"))


@register("op8_substring_dedup")
def _op8(spark, sf_dir):
    """Words of repeated 35-word windows removed from every document."""
    return substring.removal_report(C.table(spark, sf_dir, "documents"))


@register("op9_toxicity")
def _op9(spark, sf_dir):
    """Toxicity score of every document."""
    return toxicity.toxicity(C.table(spark, sf_dir, "documents"), C.table(spark, sf_dir, "labels"))


@register("op10_decontamination")
def _op10(spark, sf_dir):
    """Benchmark coverage of every document by greedy string tiling."""
    return tiling.decontaminate(C.table(spark, sf_dir, "documents"), C.table(spark, sf_dir, "benchmark"))


@register("op11_hard_negatives")
def _op11(spark, sf_dir):
    """Hard negatives of every anchor and positive; labels of ids divisible by 7 move on by one."""
    rows = C.table(spark, sf_dir, "embeddings")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label").cast("long") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.hard_negatives(rows.withColumn("label", moved))


@register("op12_spelling_variants")
def _op12(spark, sf_dir):
    """Near words, form and root of every word of the corpus vocabulary."""
    return spelling.variants(C.table(spark, sf_dir, "documents"))


@register("op13_license_scan")
def _op13(spark, sf_dir):
    """License phrases, labels and score of every document."""
    return licenses.scan_licenses(C.table(spark, sf_dir, "documents"))


ORACLE["op1_chat_formatting"] = r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT * FROM (VALUES (-7, 0, 'user', '\### Assistant: </turn> ok'), (-7, 1, 'assistant', '\### Assistant: </turn> ok')) v
), sized AS (
  SELECT *, lag(role) OVER w AS before, lead(role) OVER w AS after,
    length(text) + (length(text) - length(replace(text, '\', ''))) + 2 * ((length(text) - length(replace(text, '### ', ''))) // 4
      + (length(text) - length(replace(text, '</turn>', ''))) // 7 + (length(text) - length(replace(text, '<says>', ''))) // 6) AS chars
  FROM turns WINDOW w AS (PARTITION BY conv_id ORDER BY turn, role, text)
)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(chars + 9 + CASE role WHEN 'system' THEN 12 WHEN 'user' THEN 10 WHEN 'assistant' THEN 15 WHEN 'tool' THEN 10
    ELSE 9 + 8 + length(role) END) AS BIGINT) AS formatted_chars,
  count(*) FILTER (WHERE NOT coalesce(CASE role WHEN 'system' THEN before IS NULL
      WHEN 'user' THEN before IS NULL OR before IN ('system', 'assistant') WHEN 'assistant' THEN before IN ('user', 'tool')
      WHEN 'tool' THEN before IN ('assistant', 'tool') ELSE false END, false))
    + count(*) FILTER (WHERE after IS NULL AND role <> 'assistant') AS n_violations
FROM sized GROUP BY conv_id
"""

_WORDS = r"regexp_extract_all(coalesce({0}, ''), '[^\x20\x09-\x0D]+')"

ORACLE["op2_near_duplicates"] = r"""
WITH RECURSIVE docs AS (
  SELECT doc_id, """ + _WORDS.format("translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')") + r""" AS w FROM documents
), shingles AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [list_aggregate(w, 'string_agg', ' ')]
    ELSE list_transform(range(1, len(w) - 3), lambda i: list_aggregate(w[i:i + 4], 'string_agg', ' ')) END) AS s FROM docs
), sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
pairs AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY 1, 2
), links AS (
  SELECT a, b FROM pairs JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE 100 * c >= 85 * (x.n + y.n - c)
), reach(node, seen) AS (
  SELECT doc_id, doc_id FROM documents UNION SELECT links.b, reach.seen FROM reach JOIN links ON links.a = reach.node
), component AS (SELECT node, min(seen) AS component_id FROM reach GROUP BY node)
SELECT d.doc_id, coalesce(n, 0) AS n_shingles, component_id, d.doc_id = component_id AS kept
FROM documents d JOIN component ON node = d.doc_id LEFT JOIN sizes ON sizes.doc_id = d.doc_id
"""

ORACLE["op8_substring_dedup"] = r"""
WITH docs AS (SELECT doc_id, """ + _WORDS.format("text") + r""" AS w FROM documents),
words AS (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS p FROM docs),
windows AS (
  SELECT doc_id, p, sha256(list_aggregate(w[p:p + 34], 'string_agg', ' ')) AS h
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 33)) AS p FROM docs WHERE len(w) >= 35)
), repeated AS (SELECT doc_id, p FROM (SELECT *, count(*) OVER (PARTITION BY h) AS c FROM windows) WHERE c > 1),
marked AS (
  SELECT words.doc_id, words.p, word, max(r.p) OVER (PARTITION BY words.doc_id ORDER BY words.p ROWS BETWEEN 34 PRECEDING AND CURRENT ROW) IS NOT NULL AS gone
  FROM words LEFT JOIN repeated r ON r.doc_id = words.doc_id AND r.p = words.p
)
SELECT docs.doc_id, len(w) AS n_words, count(*) FILTER (WHERE gone) AS n_removed,
  sha256(coalesce(string_agg(word, ' ' ORDER BY p) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM docs LEFT JOIN marked ON marked.doc_id = docs.doc_id GROUP BY docs.doc_id, len(w)
"""

ORACLE["op11_hard_negatives"] = """
WITH pool AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS q
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS same, CAST(list_dot_product(a.q, b.q) AS BIGINT) AS score
  FROM pool a JOIN pool b ON a.vec_id <> b.vec_id WHERE a.vec_id % 50 = 0
), positives AS (
  SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5
)
SELECT p.anchor_id, positive_id, CAST(row_number() OVER w AS INTEGER) AS rank, other_id AS negative_id, positive_score, score AS negative_score
FROM positives p JOIN scored s ON s.anchor_id = p.anchor_id AND NOT same AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
WINDOW w AS (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, other_id)
QUALIFY row_number() OVER w <= 3
"""

ORACLE["op12_spelling_variants"] = r"""
WITH RECURSIVE crc AS (
  SELECT list_transform(range(256), lambda i: list_reduce(range(8), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, i)) AS t
), runs AS (
  SELECT doc_id, r, length(r) AS len, count(*) AS n FROM (
    SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[A-Za-z\x{C0}-\x{FF}]+')) AS r
    FROM documents) GROUP BY ALL HAVING length(r) >= 6
), bytes AS (
  SELECT r, len, n, list_transform(range(1, length(x), 2), lambda i: 16 * (instr('0123456789ABCDEF', x[i]) - 1) + instr('0123456789ABCDEF', x[i + 1]) - 1) AS b
  FROM (SELECT *, hex(encode(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || r)) AS x FROM runs)
), hashed AS (
  SELECT r, len, n, xor(4294967295, list_reduce(b, lambda c, x: xor(c >> 8, t[(xor(c, x) & 255) + 1]), 4294967295)) AS h FROM bytes, crc
), words AS (
  SELECT word, CAST(sum(n) AS BIGINT) AS n FROM (
    SELECT CASE WHEN h % 199 = 0 THEN substr(r, 1, h % len) || substr(r, h % len + 2) ELSE r END AS word, n FROM hashed)
  WHERE length(word) >= 6 GROUP BY word HAVING sum(n) >= 5
), gaps AS (
  SELECT word, n, i, substr(word, 1, i - 1) AS a, substr(word, i + 1) AS b FROM (SELECT *, unnest(range(1, length(word) + 1)) AS i FROM words)
), near AS (
  SELECT x.word, y.word AS near, y.n FROM gaps x JOIN gaps y ON x.i = y.i AND x.a = y.a AND x.b = y.b AND x.word <> y.word
  UNION SELECT x.word, y.word, y.n FROM gaps x JOIN words y ON x.a || x.b = y.word
  UNION SELECT y.word, x.word, x.n FROM gaps x JOIN words y ON x.a || x.b = y.word
), best AS (
  SELECT word, count(*) AS n_near, max(n) AS most, arg_min(near, {'m': -n, 'w': near}) AS near FROM near GROUP BY word
), forms AS (
  SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN most >= 5 * w.n THEN near END AS form, CASE WHEN most >= 5 * w.n THEN most END AS form_n
  FROM words w LEFT JOIN best ON best.word = w.word
), chain(word, last) AS (
  SELECT word, word FROM forms UNION ALL SELECT chain.word, form FROM chain JOIN forms ON forms.word = chain.last WHERE form IS NOT NULL
)
SELECT forms.word, n, n_near, form, form_n, last AS root
FROM forms JOIN chain ON chain.word = forms.word WHERE NOT EXISTS (SELECT 1 FROM forms f WHERE f.word = last AND f.form IS NOT NULL)
"""
