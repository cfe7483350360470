"""The registered queries opN_<name>, one per operator, and their oracle SQL.

Each runs its operator with production parameters over its whole table and
derives the digest columns from the operator's result."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import decontamination as op3
from tidemark.llm import fingerprints as op2
from tidemark.llm import importance_resampling as op13
from tidemark.llm import line_dedup as op1
from tidemark.llm import ngram_jaccard as op11
from tidemark.llm import quality as op9
from tidemark.llm import secrets as op4
from tidemark.llm import sentencepiece_fst as op8
from tidemark.llm import simhash as op6
from tidemark.llm import spelling_variants as op12
from tidemark.llm import substring_dedup as op7
from tidemark.llm import toxicity as op10
from tidemark.llm import url_filter as op5
from tidemark.llm.common import load


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = op1.line_dedup(load(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2(op1.kept_text().cast("binary"), 256).alias("kept_sha256"))


def op2_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op2.neighbour_fingerprints(load(spark, sf_dir, "documents"))


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op3.leaks(load(spark, sf_dir, "documents"), load(spark, sf_dir, "benchmark"))


def op4_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents").select("doc_id", "text", F.col("source").alias("path"))
    return op4.scan(docs)


URL_RULES = [("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"), ("allow", "com", "/fr/"), ("block", "com", "/de/")]


def op5_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(URL_RULES, op5.RULES)
    return op5.judge(load(spark, sf_dir, "pages").select("page_id", "url"), rules).drop("url")


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = op6.simhash_groups(load(spark, sf_dir, "documents"))
    return out.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op7_suffix_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op7.substring_dedup(load(spark, sf_dir, "documents"), with_text=False)


def op8_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = op8.encode(load(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", F.size("ids").cast("long").alias("n_pieces"), "ids", "round_trip")


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op9.classify(load(spark, sf_dir, "documents").select("doc_id", "text")).drop("text")


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents")
    model = op10.fit(op10.training_rows(docs, load(spark, sf_dir, "labels")))
    out = docs.select("doc_id", (~op10.train_part("doc_id")).alias("held_out"), op10.score(model, "text").alias("score"))
    return out.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def op11_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op11.jaccard_groups(load(spark, sf_dir, "documents"))


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op12.spelling_variants(load(spark, sf_dir, "documents"), drop_every=97)


def op13_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op13.resample(load(spark, sf_dir, "documents"), load(spark, sf_dir, "benchmark"))


def registry() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    every = (op1_line_dedup, op2_fingerprints, op3_decontamination, op4_secrets, op5_url_filter, op6_simhash, op7_suffix_array, op8_sentencepiece, op9_quality, op10_toxicity, op11_ngram_jaccard, op12_spelling_variants, op13_importance_resampling)
    return {f.__name__: f for f in every}


_LOWERED = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
# CRC-32 in SQL: the table of 256 entries, and a fold over a string's UTF-8 bytes
_CRC_TABLE = """(SELECT list_transform(range(256), lambda i: list_reduce(list_prepend(i::UBIGINT, list_transform(range(8), lambda z: z::UBIGINT)),
    lambda c, z: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384::UBIGINT) ELSE c >> 1 END)) AS tab)"""


def _crc(text: str, table: str = "tab") -> str:
    bytes_ = f"list_transform(range(octet_length(encode({text}))), lambda i: ('0x' || substr(hex(encode({text})), 2 * i + 1, 2))::UBIGINT)"
    return f"xor(list_reduce(list_prepend(4294967295::UBIGINT, {bytes_}), lambda c, x: xor(c >> 8, {table}[(1 + xor(c & 255, x))::BIGINT])), 4294967295::UBIGINT)"


_WHITE = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"

ORACLE = {
    "op1_line_dedup": f"""
        WITH d AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
        l AS (SELECT doc_id, unnest(ls) AS line, generate_subscripts(ls, 1) AS pos FROM d),
        k AS (SELECT doc_id, pos, line, {_LOWERED.format(f"trim(line, {_WHITE})")} AS key FROM l),
        g AS (SELECT key, max(doc_id) AS top FROM k WHERE length(key) >= 20 GROUP BY key HAVING count(DISTINCT doc_id) >= 3),
        m AS (SELECT k.*, top IS NOT NULL AND top <> doc_id AS gone FROM k LEFT JOIN g USING (key))
        SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
               sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
        FROM m GROUP BY doc_id""",
    "op5_url_filter": f"""
        WITH r(verdict, rh, rp) AS (VALUES {", ".join(f"('{a}', '{h}', '{p}')" for a, h, p in URL_RULES)}),
        u AS (SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
        h AS (SELECT row_number() OVER () AS n, page_id, {_LOWERED.format("regexp_extract(rest, '^([^/?#]*)', 1)")} AS host,
                     regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM u)
        SELECT h.page_id, host, path, arg_max(rh || rp, length(rh || rp)) AS rule,
               coalesce(arg_max(verdict, length(rh || rp)), 'allow') AS verdict
        FROM h LEFT JOIN r ON (host = rh OR ends_with(host, '.' || rh)) AND starts_with(path, rp)
        GROUP BY n, h.page_id, host, path""",
    "op11_ngram_jaccard": f"""
        WITH RECURSIVE w AS (SELECT row_number() OVER () AS r, doc_id,
                  regexp_extract_all({_LOWERED.format("coalesce(text, '')")}, '[^\\x20\\x09-\\x0D]+') AS ws FROM documents),
        s AS (SELECT DISTINCT r, unnest(CASE WHEN len(ws) IN (1, 2) THEN [array_to_string(ws, ' ')]
                  ELSE list_transform(range(1, len(ws) - 1), lambda i: ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2]) END) AS f FROM w),
        n AS (SELECT r, count(*) AS n, md5(string_agg(f, chr(10) ORDER BY f)) AS k FROM s GROUP BY r),
        c AS (SELECT k, min(r) AS rep, any_value(n) AS n FROM n GROUP BY k),
        f AS (SELECT rep, n, f FROM s JOIN c ON s.r = c.rep),
        i AS (SELECT a.rep AS u, b.rep AS v, a.n + b.n AS nn, count(*) AS i FROM f a JOIN f b ON a.f = b.f AND a.rep < b.rep AND 10 * a.n >= 9 * b.n AND 10 * b.n >= 9 * a.n GROUP BY ALL),
        e AS (SELECT u, v FROM i WHERE 100 * i >= 90 * (nn - i) UNION ALL SELECT n.r, c.rep FROM n JOIN c USING (k) WHERE n.r <> c.rep),
        b AS (SELECT u, v FROM e UNION SELECT v, u FROM e),
        t AS (SELECT r, r AS x FROM w UNION SELECT t.r, b.v FROM t JOIN b ON t.x = b.u)
        SELECT w.doc_id, coalesce(any_value(n.n), 0) AS n_shingles, min(o.doc_id) AS component_id
        FROM w LEFT JOIN n USING (r) JOIN t USING (r) JOIN w o ON o.r = t.x GROUP BY w.r, w.doc_id""",
    "op12_spelling_variants": f"""
        WITH RECURSIVE crc AS {_CRC_TABLE},
        r AS (SELECT doc_id, unnest(regexp_extract_all({_LOWERED.format("text")}, '[A-Za-z\u00C0-\u00FF]+')) AS w FROM documents),
        d AS (SELECT doc_id, w, count(*) AS n FROM r GROUP BY ALL),
        h AS (SELECT w, n, ({_crc("s")})::BIGINT AS h FROM (SELECT w, n, coalesce(doc_id::VARCHAR, '') || ':' || w AS s FROM d), crc),
        x AS (SELECT CASE WHEN h % 97 = 0 THEN substr(w, 1, h % length(w)) || substr(w, h % length(w) + 2) ELSE w END AS word, n FROM h),
        v AS (SELECT word, sum(n)::BIGINT AS n FROM x WHERE length(word) >= 5 GROUP BY word HAVING sum(n) >= 3),
        g AS (SELECT word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) AS k FROM (SELECT *, unnest(range(1, length(word) + 1)) AS i FROM v)),
        p AS (SELECT a.word, a.n, b.word AS near, b.n AS near_n FROM g a JOIN g b ON a.k = b.k AND a.i = b.i AND a.word <> b.word
              UNION SELECT v.word, v.n, g.word, g.n FROM v JOIN g ON v.word = g.k
              UNION SELECT g.word, g.n, v.word, v.n FROM v JOIN g ON v.word = g.k),
        f AS (SELECT word, any_value(n) AS own, count(*) AS n_near, max(near_n) AS top FROM p GROUP BY word),
        t AS (SELECT f.word, n_near, CASE WHEN top >= 2 * own THEN min(near) END AS form, CASE WHEN top >= 2 * own THEN top END AS form_n
              FROM f JOIN p ON f.word = p.word AND near_n = top GROUP BY f.word, n_near, own, top),
        z AS (SELECT word, word AS root, 0 AS step FROM v UNION ALL SELECT z.word, form, step + 1 FROM z JOIN t ON z.root = t.word WHERE form IS NOT NULL),
        e AS (SELECT word, arg_max(root, step) AS root FROM z GROUP BY word)
        SELECT v.word, v.n, coalesce(n_near, 0) AS n_near, form, form_n, root FROM v LEFT JOIN t USING (word) JOIN e USING (word)""",
    "op13_importance_resampling": f"""
        WITH crc AS {_CRC_TABLE},
        x AS (SELECT true AS own, row_number() OVER () AS r, doc_id, text FROM documents UNION ALL SELECT false, row_number() OVER (), NULL, text FROM benchmark),
        w AS (SELECT own, r, doc_id, regexp_extract_all({_LOWERED.format("coalesce(text, '')")}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS ws FROM x),
        g AS (SELECT own, r, unnest(ws) AS f FROM w
              UNION ALL SELECT own, r, unnest(list_transform(range(1, len(ws)), lambda i: ws[i] || ' ' || ws[i + 1])) FROM w
              UNION ALL SELECT own, r, unnest(list_transform(range(1, len(ws) - 1), lambda i: ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2])) FROM w),
        n AS (SELECT own, r, f, count(*) AS n FROM g GROUP BY ALL),
        k AS (SELECT f, {_crc("f")} % 10000 AS b FROM (SELECT DISTINCT f FROM n), crc),
        c AS (SELECT b, coalesce(sum(n) FILTER (own), 0)::BIGINT AS s, coalesce(sum(n) FILTER (NOT own), 0)::BIGINT AS t FROM n JOIN k USING (f) GROUP BY b),
        a AS (SELECT sum(s) AS ss, sum(t) AS tt FROM c),
        gain AS (SELECT b, floor(1000 * ln(((t + 1)::DOUBLE * (ss + 10000)) / ((s + 1)::DOUBLE * (tt + 10000))))::BIGINT AS gain FROM c, a),
        o AS (SELECT r, sum(n)::BIGINT AS n_features, sum(n * gain)::BIGINT AS weight FROM n JOIN k USING (f) JOIN gain USING (b) WHERE own GROUP BY r),
        d AS (SELECT w.r, doc_id, len(ws) AS words, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
                     ('0x' || substr(sha256('42:' || coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT AS h
              FROM w LEFT JOIN o USING (r) WHERE own),
        e AS (SELECT *, weight + floor(-1000 * ln(-ln((h + 0.5::DOUBLE) / 4294967296::DOUBLE)))::BIGINT AS score FROM d),
        q AS (SELECT *, CASE WHEN words >= 20 THEN row_number() OVER (PARTITION BY words >= 20 ORDER BY score DESC, doc_id, n_features DESC) END AS place,
                     count(*) FILTER (words >= 20) OVER () AS open FROM e)
        SELECT doc_id, n_features, weight, score, CASE WHEN place <= 5 * open // 100 THEN place END AS rank FROM q""",
}
