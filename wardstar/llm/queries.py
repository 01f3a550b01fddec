"""The registered queries: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardstar.llm import (
    decontam, itq, langid, lexical, licenses, lines, lmscore, mixing, secrets, sharding, simhash, toxicity,
    variants,
)
from wardstar.llm.common import read_table

Query = Callable[[SparkSession, str], DataFrame]


def op1_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan(read_table(spark, sf_dir, "documents"))


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(read_table(spark, sf_dir, "documents"))
    digits = F.lpad(F.lower(F.hex("fp")), 16, "0")
    return found.select("doc_id", digits.alias("fingerprint"), "component_id")


def op3_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(read_table(spark, sf_dir, "documents"))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op5_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shards_of(read_table(spark, sf_dir, "documents"))


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.dedup_lines(read_table(spark, sf_dir, "documents"))


def op7_itq(spark: SparkSession, sf_dir: str) -> DataFrame:
    return itq.near_duplicates(read_table(spark, sf_dir, "embeddings"))


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(read_table(spark, sf_dir, "documents"))


def op9_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.contamination(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


def op10_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(read_table(spark, sf_dir, "documents"))


def op11_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants.group_variants(read_table(spark, sf_dir, "documents"))


def op12_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.search(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


def op13_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lmscore.score(read_table(spark, sf_dir, "documents"))


def queries() -> dict[str, Query]:
    every = (
        op1_secrets, op2_simhash, op3_langid, op4_toxicity, op5_sharding, op6_line_dedup, op7_itq, op8_mixing,
        op9_decontaminate, op10_licenses, op11_variants, op12_search, op13_lm_score,
    )
    return {query.__name__: query for query in every}


def oracle_sql() -> dict[str, str]:
    """SQL for what SQL can express: windows of words and of lines, near words, ranked search."""
    return {
        "op6_line_dedup": _LINE_DEDUP,
        "op9_decontaminate": _DECONTAMINATE,
        "op11_variants": _VARIANTS,
        "op12_search": _SEARCH,
    }


_DECONTAMINATE = r"""
WITH words AS (
  SELECT doc_id, row_number() OVER () AS r, list_filter(
    regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                          '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '') AS w
  FROM documents),
items AS (
  SELECT CAST(item_id AS VARCHAR) AS item, list_filter(
    regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                          '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '') AS w
  FROM benchmark),
item_spans AS (
  SELECT DISTINCT item, least(len(w), 10) AS n,
    array_to_string(w[i : i + least(len(w), 10) - 1], ' ') AS span
  FROM (SELECT item, w, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS i FROM items WHERE len(w) > 0)),
doc_spans AS (
  SELECT r, i, n, array_to_string(w[i : i + n - 1], ' ') AS span
  FROM (SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS i
        FROM words, (SELECT DISTINCT n FROM item_spans) WHERE len(w) >= n)),
hits AS (
  SELECT r, i, d.n, item FROM doc_spans d JOIN item_spans s ON d.span = s.span AND d.n = s.n),
hit_words AS (
  SELECT r, count(DISTINCT p) AS n_hit
  FROM (SELECT r, unnest(range(i, i + n)) AS p FROM (SELECT DISTINCT r, i, n FROM hits)) GROUP BY r),
hit_items AS (
  SELECT r, count(DISTINCT item) AS n_items, sha256(string_agg(item, ',' ORDER BY item)) AS items_sha256
  FROM (SELECT DISTINCT r, item FROM hits) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, coalesce(items_sha256, sha256('')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AS contaminated
FROM words LEFT JOIN hit_words USING (r) LEFT JOIN hit_items USING (r)
"""

_LINE_DEDUP = """
WITH docs AS (
  SELECT row_number() OVER () AS r, doc_id, text, string_split(text, chr(10)) AS lines FROM documents),
windows AS (
  SELECT r, doc_id, i, trim(lines[i]) AS a, trim(lines[i + 1]) AS b, trim(lines[i + 2]) AS c
  FROM (SELECT r, doc_id, lines, unnest(range(1, len(lines) - 1)) AS i FROM docs WHERE len(lines) >= 3)),
later AS (
  SELECT r, i FROM (
    SELECT r, i, row_number() OVER (PARTITION BY a, b, c ORDER BY doc_id, i) AS nth
    FROM windows WHERE a || b || c <> '')
  WHERE nth > 1),
covered AS (SELECT DISTINCT r, i + k AS i FROM later, (SELECT unnest(range(3)) AS k)),
kept AS (
  SELECT r, count(*) FILTER (c.i IS NOT NULL) AS n_removed,
    string_agg(line, chr(10) ORDER BY l.i) FILTER (c.i IS NULL) AS text
  FROM (SELECT r, unnest(range(1, len(lines) + 1)) AS i, unnest(lines) AS line FROM docs WHERE text IS NOT NULL) l
  LEFT JOIN covered c USING (r, i) GROUP BY r)
SELECT doc_id, CAST(coalesce(len(lines), 0) AS BIGINT) AS n_lines, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
  CASE WHEN docs.text IS NULL THEN NULL ELSE coalesce(kept.text, '') END AS text
FROM docs LEFT JOIN kept USING (r)
"""

_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

# crc32 byte by byte over its table; words one edit apart leave the same text when the letter
# that differs is taken out.
_VARIANTS = f"""
WITH RECURSIVE
bits(b, k, c) AS (
  SELECT b, 0, CAST(b AS BIGINT) FROM range(256) t(b)
  UNION ALL
  SELECT b, k + 1, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END FROM bits WHERE k < 8),
crc AS (SELECT list(c ORDER BY b) AS t FROM bits WHERE k = 8),
runs AS (
  SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS id, unnest(regexp_extract_all(
    {_LOWER.format("coalesce(text, '')")}, '[a-z\\x{{00C0}}-\\x{{00FF}}]+')) AS run FROM documents),
counted AS (SELECT id, run, count(*) AS n FROM runs WHERE length(run) >= 6 GROUP BY id, run),
coded AS (
  SELECT run, n, list_transform(range(1, length(h), 2), lambda i: CAST(
    16 * (strpos('0123456789ABCDEF', h[i]) - 1) + strpos('0123456789ABCDEF', h[i + 1]) - 1 AS BIGINT)) AS bytes
  FROM (SELECT run, n, hex(encode(id || ':' || run)) AS h FROM counted)),
hashed AS (
  SELECT run, n, xor(4294967295, list_reduce(list_prepend(CAST(4294967295 AS BIGINT), bytes),
    lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]))) AS h
  FROM coded, crc),
words AS (
  SELECT word, CAST(sum(n) AS BIGINT) AS n FROM (
    SELECT n, CASE WHEN h % 199 = 0 THEN run[: h % length(run)] || run[h % length(run) + 2 :] ELSE run END AS word
    FROM hashed)
  WHERE length(word) >= 6 GROUP BY word HAVING sum(n) >= 5),
cut AS (SELECT word, i, word[: i - 1] || word[i + 1 :] AS rest
        FROM (SELECT word, unnest(range(1, length(word) + 1)) AS i FROM words)),
pairs AS (
  SELECT a.word, b.word AS near FROM cut a JOIN cut b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
  UNION SELECT c.word, w.word FROM cut c JOIN words w ON c.rest = w.word
  UNION SELECT w.word, c.word FROM cut c JOIN words w ON c.rest = w.word),
ranked AS (
  SELECT p.word, p.near, b.n AS near_n, count(*) OVER (PARTITION BY p.word) AS n_near,
    row_number() OVER (PARTITION BY p.word ORDER BY b.n DESC, encode(p.near)) AS place
  FROM pairs p JOIN words b ON p.near = b.word),
formed AS (
  SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN near_n >= 5 * w.n THEN near END AS form,
    CASE WHEN near_n >= 5 * w.n THEN near_n END AS form_n
  FROM words w LEFT JOIN ranked r ON w.word = r.word AND place = 1),
chain(word, root, form) AS (
  SELECT word, word, form FROM formed
  UNION ALL
  SELECT c.word, c.form, f.form FROM chain c JOIN formed f ON f.word = c.form)
SELECT f.word, f.form, c.root, f.n, CAST(f.n_near AS BIGINT) AS n_near, f.form_n
FROM formed f JOIN chain c ON f.word = c.word AND c.form IS NULL
"""

_SEARCH = f"""
WITH docs AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(
    {_LOWER.format("coalesce(text, '')")}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS t FROM documents),
items AS (
  SELECT row_number() OVER () AS q, item_id, list_distinct(regexp_extract_all(
    {_LOWER.format("coalesce(text, '')")}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')) AS t FROM benchmark),
size AS (SELECT count(*) FILTER (len(t) > 0) AS nn, CAST(sum(len(t)) AS BIGINT) AS l FROM docs),
asked AS (SELECT q, unnest(t) AS term FROM items),
found AS (
  SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(t) AS term FROM docs)
  WHERE term IN (SELECT term FROM asked) GROUP BY r, term),
weights AS (
  SELECT term, CAST(floor(1000 * ln((2 * nn + 2) / (2 * count(*) + 1))) AS BIGINT) AS w
  FROM found, size GROUP BY term, nn),
lengths AS (SELECT r, doc_id, 100 - 90 + (90 * CAST(len(t) AS BIGINT) * nn) // l AS m FROM docs, size WHERE len(t) > 0),
impacts AS (
  SELECT r, doc_id, term, w * ((1000000000 * tf) // (1000 * tf + 8 * m)) AS part
  FROM found JOIN lengths USING (r) JOIN weights USING (term)),
scored AS (
  SELECT q, r, doc_id, CAST(sum(part) AS BIGINT) AS score FROM asked JOIN impacts USING (term)
  GROUP BY q, r, doc_id HAVING sum(part) > 0)
SELECT item_id, CAST(place AS INTEGER) AS rank, doc_id, score FROM (
  SELECT q, doc_id, score, row_number() OVER (PARTITION BY q ORDER BY score DESC, doc_id) AS place FROM scored)
JOIN items USING (q) WHERE place <= 10
"""
