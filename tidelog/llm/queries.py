"""The registered queries of this package, each over its whole tables, and their check SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tidelog.llm.collocations import collocations
from tidelog.llm.common import new_folder, table
from tidelog.llm.decontamination import contamination_report
from tidelog.llm.jaccard_join import alike_documents
from tidelog.llm.neighbours import nearest
from tidelog.llm.packing import pack
from tidelog.llm.ppm import score_texts
from tidelog.llm.quality import quality_report
from tidelog.llm.ranked_search import best_documents
from tidelog.llm.secrets import secrets_report
from tidelog.llm.simhash import near_duplicates
from tidelog.llm.token_files import read_token_files, stored_digest, write_token_files
from tidelog.llm.toxicity import toxicity_report
from tidelog.llm.warc import read_archives, write_archives

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


OP1_SQL = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
             'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
i AS (SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all(translate(coalesce(text, ''),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
      FROM benchmark),
win AS (SELECT DISTINCT item, least(len(w), 10) AS n,
          array_to_string(w[s : s + least(len(w), 10) - 1], ' ') AS k
        FROM i, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS t(s) WHERE len(w) > 0),
sizes AS (SELECT DISTINCT n FROM win),
spots AS (SELECT doc_id, s, n, array_to_string(w[s : s + n - 1], ' ') AS k
       FROM d, sizes, unnest(range(1, len(w) - n + 2)) AS t(s)),
hit AS (SELECT doc_id, s, spots.n, item FROM spots JOIN win USING (k) WHERE spots.n = win.n),
hw AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM hit, unnest(range(s, s + n)) AS t(p) GROUP BY doc_id),
hi AS (SELECT doc_id, count(DISTINCT item) AS n_items, string_agg(DISTINCT item, ',' ORDER BY item) AS items
       FROM hit GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hw USING (doc_id) LEFT JOIN hi USING (doc_id)
"""


@query("op1_suffix_automaton", OP1_SQL)
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination_report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query("op3_orc_tokens")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_folder(spark, "tokens")
    write_token_files(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), path)
    return stored_digest(read_token_files(spark, path))


@query("op9_harmonic_packing")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    tokenizer = public_tokenizers.path("byte_bpe_50k.json")
    return pack(table(spark, sf_dir, "documents"), tokenizer, with_ids=False)


@query("op5_bk_simhash")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"))


@query("op4_nbsvm_quality")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op10_cross_polytope")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(table(spark, sf_dir, "embeddings"), "vec_id % 100 = 0")


OP7_SQL = r"""
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
d AS (SELECT page_id, CAST(octet_length(encode(h)) AS BIGINT) AS payload_bytes, unhex(sha1(h)) AS s, min(page_id) OVER (PARTITION BY h) AS first FROM p),
b AS (SELECT *, list_aggregate([lpad(bin(get_byte_), 8, '0') FOR get_byte_ IN x], 'string_agg', '') AS bits
      FROM (SELECT *, [CAST(('0x' || substr(hex(s), 2 * i + 1, 2)) AS INTEGER) FOR i IN range(20)] AS x FROM d))
SELECT page_id, payload_bytes,
  list_aggregate([substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST('0b' || substr(bits, 5 * j + 1, 5) AS INTEGER) + 1, 1)
                  FOR j IN range(32)], 'string_agg', '') AS payload_digest,
  CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> first THEN first END AS refers_to
FROM b
"""


@query("op7_warc_revisits", OP7_SQL)
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_folder(spark, "archives")
    write_archives(table(spark, sf_dir, "pages"), path)
    return read_archives(spark, path).drop("url")


@query("op2_crf_secrets")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets_report(table(spark, sf_dir, "documents"))


@query("op6_string_kernel_toxicity")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity_report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op8_ppm_scores")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_texts(table(spark, sf_dir, "documents"), across=True)


OP11_SQL = r"""
WITH d AS (SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
             'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS t FROM documents),
i AS (SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
        'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS t FROM benchmark),
tf AS (SELECT doc_id, t, count(*) AS tf FROM d GROUP BY doc_id, t),
len AS (SELECT doc_id, CAST(sum(tf) AS BIGINT) AS n FROM tf GROUP BY doc_id),
g AS (SELECT count(*) AS nn, CAST(sum(n) AS BIGINT) AS l FROM len),
m AS (SELECT doc_id, 100 - 50 + ((50 * n * nn) // l) AS m FROM len, g),
w AS (SELECT t, CAST(floor(1000 * ln((2 * nn + 2) / (2 * count(*) + 1))) AS BIGINT) AS w FROM tf, g GROUP BY t, nn),
s AS (SELECT item_id, doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 20 * m))) AS BIGINT) AS score
      FROM i JOIN tf USING (t) JOIN w USING (t) JOIN m USING (doc_id) GROUP BY item_id, doc_id),
r AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM s WHERE score > 0)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM r WHERE rank <= 50
"""


@query("op11_pair_maxscore", OP11_SQL)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return best_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


OP12_SQL = r"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
             'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT doc_id, CASE WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
          ELSE list_distinct(list_transform(range(1, len(w) - 1), lambda i : w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) END AS s
      FROM d WHERE len(w) > 0),
t AS (SELECT doc_id, CAST(len(s) AS BIGINT) AS n, unnest(s) AS t FROM s),
c AS (SELECT a.doc_id AS a, b.doc_id AS b, a.n AS an, b.n AS bn, count(*) AS i
      FROM t a JOIN t b ON a.t = b.t WHERE a.doc_id < b.doc_id GROUP BY ALL),
e AS (SELECT a, b FROM c WHERE 100 * i >= 90 * (an + bn - i) UNION ALL SELECT b, a FROM c WHERE 100 * i >= 90 * (an + bn - i)),
r AS (SELECT a AS doc_id, a AS root FROM e UNION SELECT e.b, r.root FROM r JOIN e ON e.a = r.doc_id WHERE r.root < e.b),
m AS (SELECT doc_id, min(root) AS root FROM r GROUP BY doc_id)
SELECT d.doc_id, CAST(coalesce(len(s), 0) AS BIGINT) AS n_shingles, coalesce(least(m.root, d.doc_id), d.doc_id) AS component_id
FROM d LEFT JOIN s ON s.doc_id = d.doc_id LEFT JOIN m ON m.doc_id = d.doc_id
"""


@query("op12_partition_jaccard", OP12_SQL)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alike_documents(table(spark, sf_dir, "documents").select("doc_id", "text"))


OP13_SQL = r"""
WITH p AS (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
             'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM p),
e AS (SELECT lang, 1 AS k, unnest(w) AS phrase FROM w
      UNION ALL SELECT lang, 2, unnest(list_transform(range(1, len(w)), lambda s : w[s] || ' ' || w[s + 1])) FROM w
      UNION ALL SELECT lang, 3, unnest(list_transform(range(1, len(w) - 1), lambda s : w[s] || ' ' || w[s + 1] || ' ' || w[s + 2])) FROM w),
f AS (SELECT lang, k, phrase, count(*) AS a, lang || '|' || phrase AS id FROM e GROUP BY lang, k, phrase),
n AS (SELECT lang, CAST(sum(a) AS BIGINT) AS n FROM f WHERE k = 1 GROUP BY lang),
c AS (SELECT *, string_split(phrase, ' ') AS v FROM f WHERE k > 1 AND a >= 10),
x AS (SELECT lang, k, phrase, a, cut, lang || '|' || array_to_string(v[1 : cut], ' ') AS lp,
        lang || '|' || array_to_string(v[cut + 1 : k], ' ') AS rp
      FROM c, unnest(range(1, k)) AS t(cut)),
y AS (SELECT x.lang, x.k, x.phrase, x.a, cut, l.a AS l, r.a AS r,
        CAST((1000000 * CAST(x.a AS HUGEINT) * x.a) // (CAST(l.a AS HUGEINT) * r.a) AS BIGINT) AS score
      FROM x JOIN f l ON l.id = x.lp JOIN f r ON r.id = x.rp),
z AS (SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) AS best FROM y),
o AS (SELECT lang || '|' || array_to_string(v[s : s + 1], ' ') AS id, max(a) AS longer
      FROM c, unnest([1, 2]) AS t(s) WHERE k = 3 GROUP BY ALL),
q AS (SELECT z.*, row_number() OVER (PARTITION BY z.lang ORDER BY score DESC, a DESC, encode(z.phrase)) AS rank
      FROM z LEFT JOIN o ON o.id = z.lang || '|' || z.phrase
      WHERE best = 1 AND (longer IS NULL OR 100 * longer < 50 * a))
SELECT lang, rank, phrase, a, l, r, n, score FROM q JOIN n USING (lang) WHERE rank <= 2000
"""


@query("op13_hat_trie_phrases", OP13_SQL)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents"))
