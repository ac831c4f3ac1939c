"""One registered query per operator, at production parameters over whole
tables, and the DuckDB SQL of those that SQL can express."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexicount.llm import (
    bagminhash,
    collocations,
    langid,
    line_dedup,
    merge_dropout,
    multiset_hash,
    packing,
    quality,
    secret_scan,
    spelling,
    token_counts,
    toxicity,
    warc,
)
from lexicount.sources import table


def _docs(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents")


def held_out(modulus: int, remainder: int, doc_id: str = "doc_id"):
    """Whether crc32 of the id as text leaves the remainder; a null id's text is empty."""
    text = F.coalesce(F.col(doc_id).cast("string"), F.lit(""))
    return F.crc32(text.cast("binary")) % modulus == remainder


def op1(spark: SparkSession, d: str) -> DataFrame:
    verdict, _ = quality.verdicts(_docs(spark, d))
    return verdict.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_removed_words",
        "base_failed", "kept",
    )


def op2(spark: SparkSession, d: str) -> DataFrame:
    return bagminhash.classes(_docs(spark, d)).select("doc_id", "rep_id", "class_id")


def op3(spark: SparkSession, d: str) -> DataFrame:
    return packing.packed_documents(_docs(spark, d))


def op4(spark: SparkSession, d: str) -> DataFrame:
    return multiset_hash.edited_likeness(_docs(spark, d))


def op5(spark: SparkSession, d: str) -> DataFrame:
    return merge_dropout.segmented(_docs(spark, d))


def _of_kind(no: int):
    return lambda x: x["no"] == no


def op6(spark: SparkSession, d: str) -> DataFrame:
    found = secret_scan.scanned(_docs(spark, d))
    base = F.filter("spans", lambda x: x["no"] < len(secret_scan.BASE))
    counts = [
        F.size(F.filter("spans", _of_kind(n))).cast("long").alias(f"n_{secret_scan.BASE[n][0]}")
        for n in range(len(secret_scan.BASE))
    ]
    return found.select(
        "doc_id", *counts, F.sha2(secret_scan.listed(base).cast("binary"), 256).alias("base_sha256"),
        secret_scan.listed(F.col("spans")).alias("spans"),
        F.size(F.filter("spans", lambda x: x["live"])).cast("long").alias("n_live"),
    )


def op7(spark: SparkSession, d: str) -> DataFrame:
    docs = _docs(spark, d)
    model = langid.learned(docs, where=~held_out(4, 2))
    return langid.predicted(docs, model).select(
        "doc_id", held_out(4, 2).alias("held_out"), "lang_pred", "score", "rejected"
    )


def op8(spark: SparkSession, d: str) -> DataFrame:
    return token_counts.counted(_docs(spark, d))


def op9(spark: SparkSession, d: str) -> DataFrame:
    docs = _docs(spark, d)
    model = toxicity.learned(docs, table(spark, d, "labels"), where=~held_out(3, 1))
    return toxicity.scored(docs, model).select(
        "doc_id", held_out(3, 1).alias("held_out"), "score", "predicted", F.size("passages").cast("long").alias("n_passages")
    )


def op10(spark: SparkSession, d: str) -> DataFrame:
    return warc.read_back(warc.archived(table(spark, d, "pages")))


def op11(spark: SparkSession, d: str) -> DataFrame:
    return spelling.variants(spelling.word_counts(_docs(spark, d), slip=spelling.SLIP))


def op12(spark: SparkSession, d: str) -> DataFrame:
    return collocations.collocations(_docs(spark, d))


def op13(spark: SparkSession, d: str) -> DataFrame:
    docs = _docs(spark, d)
    kept = line_dedup.applied(docs, line_dedup.keep_bitmaps(docs))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


def pipeline(spark: SparkSession, d: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, d)


QUERIES = {
    "op1_line_frequency": op1,
    "op2_bagminhash": op2,
    "op3_pattern_packing": op3,
    "op4_multiset_hash": op4,
    "op5_merge_dropout": op5,
    "op6_secret_ownership": op6,
    "op7_subword_langid": op7,
    "op8_overlap_token_counts": op8,
    "op9_toxic_segments": op9,
    "op10_seekable_warc": op10,
    "op11_spelling_variants": op11,
    "op12_phrase_collocations": op12,
    "op13_line_keep_bitmaps": op13,
    "pipeline": pipeline,
}

_W = r"[^\x20\x09-\x0D]+"
_OP1 = rf"""
WITH d AS (SELECT doc_id, source AS host, coalesce(text, '') AS text FROM documents),
w AS (SELECT *, regexp_extract_all(text, '{_W}') AS ws FROM d),
l AS (SELECT doc_id, host, text, i, ls[i] AS line FROM (SELECT *, string_split(text, chr(10)) AS ls FROM d), unnest(generate_series(1, len(ls))) t(i)),
lw AS (SELECT *, regexp_extract_all(lower(line), '{_W}') AS lws FROM l),
full_lines AS (SELECT *, array_to_string(lws, ' ') AS norm FROM lw WHERE len(lws) > 0),
dups AS (SELECT doc_id, sum(n - 1) AS n_dup_lines FROM (SELECT doc_id, line, count(*) AS n FROM full_lines GROUP BY 1, 2) GROUP BY 1),
g AS (SELECT doc_id, i, ws[i] || ' ' || ws[i+1] || ' ' || ws[i+2] AS gram FROM w, unnest(generate_series(1, len(ws) - 2)) t(i)),
r AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, gram) AS n FROM g),
covered AS (SELECT doc_id, count(DISTINCT i + k) AS n_repeat_words FROM r, unnest([0, 1, 2]) t(k) WHERE n > 1 GROUP BY 1),
texts AS (SELECT host, text, min(doc_id) AS doc_id FROM d GROUP BY 1, 2),
sizes AS (SELECT host, count(*) AS n_texts FROM texts GROUP BY 1),
held AS (SELECT x.host, x.norm, count(DISTINCT x.text) AS n_docs, min(t.doc_id) AS carrier
         FROM full_lines x JOIN texts t USING (host, text) GROUP BY 1, 2),
freq AS (SELECT host, norm, carrier FROM held JOIN sizes USING (host)
         WHERE n_docs > greatest({quality.MIN_DOCS}, {quality.MAX_SHARE} * n_texts)),
gone AS (SELECT host, text, sum(words) AS n FROM (
           SELECT x.doc_id, x.host, x.text, sum(len(x.lws)) AS words, min(f.carrier) AS carrier, min(t.doc_id) AS first_id, x.norm
           FROM full_lines x JOIN freq f USING (host, norm) JOIN texts t USING (host, text) GROUP BY x.doc_id, x.host, x.text, x.norm
         ) WHERE first_id <> carrier AND doc_id = first_id GROUP BY 1, 2),
base AS (SELECT doc_id, host, text, len(ws)::BIGINT AS n_words, coalesce(list_sum(list_transform(ws, lambda x: length(x))), 0)::BIGINT AS word_chars,
         length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols FROM w),
f AS (SELECT base.*, coalesce(n_dup_lines, 0)::BIGINT AS n_dup_lines, coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words,
      coalesce(gone.n, 0)::BIGINT AS n_removed_words
      FROM base LEFT JOIN dups USING (doc_id) LEFT JOIN covered USING (doc_id) LEFT JOIN gone USING (host, text))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_removed_words,
  (n_words < {quality.MIN_WORDS} OR 100 * n_repeat_words > {quality.MAX_REPEAT_PERCENT} * n_words) AS base_failed,
  NOT (n_words < {quality.MIN_WORDS} OR 100 * n_repeat_words > {quality.MAX_REPEAT_PERCENT} * n_words)
  AND (n_words - n_removed_words)::DOUBLE >= {quality.MIN_LEFT}::DOUBLE * n_words AS kept FROM f
"""

# RFC 4648 base32 of the 20 bytes, five bits at a time.
_BASE32 = (
    "array_to_string(list_transform(generate_series(0, 31), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', "
    "(('0b' || substr(bits, i * 5 + 1, 5))::BIGINT + 1)::BIGINT, 1)), '')"
)
_OP10 = f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
h AS (SELECT page_id, strlen(html)::BIGINT AS payload_bytes, sha1(html) AS x, max(page_id) OVER (PARTITION BY html) AS top FROM p),
b AS (SELECT *, array_to_string(list_transform(generate_series(1, 40), lambda i: lpad(bin(('0x' || substr(x, i, 1))::BIGINT), 4, '0')), '') AS bits FROM h)
SELECT page_id, payload_bytes, {_BASE32} AS payload_digest,
  CASE WHEN page_id = top THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN page_id <> top THEN top END AS refers_to FROM b
"""

_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_BLANK = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
_OP13 = f"""
WITH l AS (SELECT doc_id, i, ls[i] AS line FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents), unnest(generate_series(1, len(ls))) t(i)),
k AS (SELECT *, {_LOWER.format(f"trim(line, {_BLANK})")} AS key FROM l),
f AS (SELECT key, min(doc_id) AS first_id FROM k WHERE length(key) >= {line_dedup.LEAST_CHARS} GROUP BY key HAVING count(DISTINCT doc_id) > 1),
m AS (SELECT k.*, f.first_id IS NOT NULL AND f.first_id <> doc_id AS gone FROM k LEFT JOIN f USING (key))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE NOT gone), '')) AS kept_sha256 FROM m GROUP BY doc_id
"""

# crc32 by its table, over the UTF-8 bytes (letters above ASCII have two).
_OP11 = f"""
WITH RECURSIVE o AS MATERIALIZED (SELECT doc_id, run, count(*) AS c FROM (
       SELECT doc_id, {_LOWER.format("unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-z\u00C0-\u00FF]+'))")} AS run FROM documents)
     WHERE length(run) >= {spelling.LEAST_CHARS} GROUP BY ALL),
t AS (SELECT list_transform(range(256), lambda i: list_reduce(list_prepend(i, [0, 0, 0, 0, 0, 0, 0, 0]),
        lambda c, x: xor(c >> 1, 3988292384 * (c & 1)))) AS crc),
b AS (SELECT doc_id, run, c, flatten(list_transform(string_split(coalesce(doc_id::VARCHAR, '') || ':' || run, ''),
        lambda x: CASE WHEN unicode(x) < 128 THEN [unicode(x)::BIGINT] ELSE [195::BIGINT, unicode(x)::BIGINT - 64] END)) AS bytes FROM o),
h AS (SELECT run, c, xor(list_reduce(list_prepend(4294967295, bytes), lambda s, x: xor(crc[(xor(s, x) & 255) + 1], s >> 8)), 4294967295) AS h FROM b, t),
s AS (SELECT c, CASE WHEN h % {spelling.SLIP} <> 0 THEN run
        ELSE substr(run, 1, (h % length(run))::BIGINT) || substr(run, (h % length(run))::BIGINT + 2) END AS word FROM h),
v AS MATERIALIZED (SELECT word, sum(c)::BIGINT AS n FROM s WHERE length(word) >= {spelling.LEAST_CHARS} GROUP BY word HAVING sum(c) >= {spelling.LEAST_COUNT}),
d AS MATERIALIZED (SELECT word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) AS rest FROM v, unnest(generate_series(1, length(word))) u(i)),
p AS MATERIALIZED (SELECT x.word, x.n, y.word AS other, y.n AS m FROM d x JOIN d y ON x.i = y.i AND x.rest = y.rest AND x.word <> y.word
  UNION SELECT x.word, x.n, y.word, y.n FROM d y JOIN v x ON y.rest = x.word
  UNION SELECT y.word, y.n, x.word, x.n FROM d y JOIN v x ON y.rest = x.word),
a AS (SELECT word, n, count(*) AS n_near, min(struct_pack(m := -m, other := other)) AS best FROM p GROUP BY ALL),
f AS MATERIALIZED (SELECT v.word, v.n, coalesce(n_near, 0)::BIGINT AS n_near,
        CASE WHEN -best.m >= {spelling.RATIO} * v.n THEN best.other END AS form, CASE WHEN -best.m >= {spelling.RATIO} * v.n THEN -best.m END AS form_n
      FROM v LEFT JOIN a USING (word)),
r AS (SELECT word, word AS root, form AS onward FROM f UNION ALL SELECT r.word, f.word, f.form FROM r JOIN f ON r.onward = f.word)
SELECT f.word, f.form, r.root, f.n, f.n_near, f.form_n FROM f JOIN r ON f.word = r.word AND r.onward IS NULL
"""

_OP12 = f"""
WITH p AS (SELECT coalesce(lang, '{collocations.UNKNOWN}') AS lang, unnest(regexp_split_to_array({_LOWER.format("coalesce(text, '')")}, '[.,;:!?\\x0A-\\x0D]')) AS piece FROM documents),
w AS MATERIALIZED (SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS ws FROM p),
g AS MATERIALIZED (SELECT lang, ws[i:i+k-1] AS ws, count(*)::HUGEINT AS f FROM w, unnest(generate_series(1, {collocations.MOST_WORDS})) a(k),
      unnest(generate_series(1, len(ws) - k + 1)) b(i) GROUP BY ALL HAVING count(*) >= {collocations.LEAST}),
c AS (SELECT lang, ws, f AS a FROM g WHERE len(ws) > 1),
s AS (SELECT c.lang, c.ws, c.a, k, x.f AS l, y.f AS r, ({collocations.SCALE}::HUGEINT * c.a) // (x.f + y.f) AS score
      FROM c, unnest(generate_series(1, len(c.ws) - 1)) t(k) JOIN g x ON x.lang = c.lang AND x.ws = c.ws[1:k] JOIN g y ON y.lang = c.lang AND y.ws = c.ws[k+1:]),
m AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, ws ORDER BY score, k) = 1),
v AS (SELECT DISTINCT c.lang, c.ws FROM c JOIN (SELECT x.lang, x.ws[i:i+k-1] AS ws, x.a FROM c x, unnest(generate_series(2, len(x.ws) - 1)) t(k),
      unnest(generate_series(1, len(x.ws) - k + 1)) u(i)) z ON z.lang = c.lang AND z.ws = c.ws AND 100 * z.a >= {collocations.COVERED} * c.a),
n AS (SELECT lang, sum(len(ws))::BIGINT AS n FROM w GROUP BY lang),
o AS (SELECT lang, array_to_string(ws, ' ') AS phrase, a, l, r, score FROM m ANTI JOIN v USING (lang, ws))
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n, score::BIGINT AS score
FROM o JOIN n USING (lang) QUALIFY rank <= {collocations.TOP}
"""

ORACLE_SQL = {
    "op1_line_frequency": _OP1,
    "op10_seekable_warc": _OP10,
    "op11_spelling_variants": _OP11,
    "op12_phrase_collocations": _OP12,
    "op13_line_keep_bitmaps": _OP13,
}
