"""The queries of the training-data operators and, where SQL can express them, their DuckDB SQL."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline
from surveyspark.llm import (
    decontaminate, fingerprints, jaccard_join, language_id, merkle, periodic_runs, pii, piece_codec, substring_dedup, token_counts, token_files, topk_search, url_filters,
)
from surveyspark.llm.common import read_table

WORD_BPE, PIECE_BPE = "word_bpe_49k.json", "piece_bpe_32k.model"


def op1_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filters.filter_urls(read_table(spark, sf_dir, "pages"))


def op2_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = token_files.write_token_files(read_table(spark, sf_dir, "documents"), public_tokenizers.path(WORD_BPE))
    return token_files.read_token_files(spark, files)


def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find_pii(read_table(spark, sf_dir, "documents"))


def op4_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.near_duplicates(read_table(spark, sf_dir, "documents"))


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(read_table(spark, sf_dir, "documents"), public_tokenizers.path(PIECE_BPE))


def op6_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk_search.top_k(read_table(spark, sf_dir, "embeddings"))


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.identify(read_table(spark, sf_dir, "documents"))


def op8_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


def op9_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.remove_repeats(read_table(spark, sf_dir, "documents"))


def op10_piece_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    return piece_codec.encode_decode(read_table(spark, sf_dir, "documents"), public_tokenizers.path(PIECE_BPE), columns=("doc_id", "n_tokens", "ids_sha256", "decoded_sha256"))


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.manifest_proofs(read_table(spark, sf_dir, "documents"))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic_runs.periodic_runs(read_table(spark, sf_dir, "documents"), plant=True)


def op13_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.fingerprints(read_table(spark, sf_dir, "documents"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus_pipeline.run(spark, sf_dir)


QUERIES = {
    f.__name__: f
    for f in (op1_url_filters, op2_token_files, op3_pii, op4_jaccard_join, op5_token_counts, op6_topk_search, op7_language_id, op8_decontaminate, op9_substring_dedup, op10_piece_codec, op11_merkle_manifest, op12_periodic_runs, op13_fingerprints, pipeline)
}

_WORDS = "regexp_extract_all({text}, '[^\\x20\\x09-\\x0D]+')"

#: Unsigned crc32 of a text of ASCII characters: a list of its codes folded bit by bit.
_CRC32 = (
    "xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), list_transform(string_split(CAST({x} AS VARCHAR), ''), lambda ch: CAST(ascii(ch) AS BIGINT))), "
    "lambda c, b: list_reduce(list_prepend(xor(c, b), list_transform(range(8), lambda z: CAST(0 AS BIGINT))), lambda x, y: xor(x >> 1, 3988292384 * (x & 1)))), 4294967295)"
)


def _field(column: str) -> str:
    return f"coalesce(concat(strlen(CAST({column} AS VARCHAR)), ':', {column}), '-')"


def _leaf(text: str) -> str:
    return f"sha256(concat({', '.join(_field(c) for c in ('doc_id', 'source', 'lang', 'n_chars', text))}))"


ORACLE_SQL = {
    "op4_jaccard_join": f"""
WITH RECURSIVE w AS (
  SELECT doc_id, {_WORDS.format(text="translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} AS ws FROM documents),
s AS (
  SELECT doc_id, CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 5 THEN [array_to_string(ws, ' ')]
    ELSE list_distinct(list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' '))) END AS sh FROM w),
n AS (SELECT doc_id, len(sh) AS n FROM s),
t AS (SELECT doc_id, unnest(sh) AS sh FROM s),
p AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM t a JOIN t b ON a.sh = b.sh AND a.doc_id < b.doc_id GROUP BY ALL),
l AS (SELECT x, y FROM p JOIN n nx ON nx.doc_id = x JOIN n ny ON ny.doc_id = y WHERE 100 * c >= 75 * (nx.n + ny.n - c)),
e AS (SELECT x, y FROM l UNION ALL SELECT y, x FROM l),
r(doc_id, c) AS (SELECT doc_id, doc_id FROM n UNION SELECT e.y, r.c FROM r JOIN e ON r.doc_id = e.x)
SELECT n.doc_id, CAST(n.n AS BIGINT) AS n_shingles, min(r.c) AS component_id FROM n JOIN r ON n.doc_id = r.doc_id GROUP BY n.doc_id, n.n""",
    "op6_topk_search": """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * CAST(x AS DOUBLE))) AS v FROM embeddings),
s AS (SELECT q.vec_id AS query_id, v.vec_id, CAST(list_inner_product(q.v, v.v) AS BIGINT) AS score FROM v q JOIN v ON q.vec_id <> v.vec_id WHERE q.vec_id % 100 = 0),
r AS (SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS "rank", vec_id, score FROM s)
SELECT * FROM r WHERE "rank" <= 10""",
    "op9_substring_dedup": f"""
WITH w AS (SELECT doc_id, {_WORDS.format(text="coalesce(text, '')")} AS ws FROM documents),
win AS (SELECT doc_id, i, array_to_string(ws[i:i + 19], ' ') AS s FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 18)) AS i FROM w)),
f AS (SELECT s, min(struct_pack(d := doc_id, p := i)) AS f FROM win GROUP BY s HAVING count(*) > 1),
c AS (SELECT DISTINCT doc_id, unnest(range(i, i + 20)) AS pos FROM win JOIN f ON win.s = f.s WHERE (f.f.d, f.f.p) <> (doc_id, i)),
k AS (SELECT doc_id, unnest(ws) AS word, unnest(range(1, len(ws) + 1)) AS pos FROM w),
kept AS (SELECT k.doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY k.pos) AS kept FROM k ANTI JOIN c ON k.doc_id = c.doc_id AND k.pos = c.pos GROUP BY k.doc_id)
SELECT w.doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(len(ws) - coalesce(n, 0) AS BIGINT) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM w LEFT JOIN kept ON w.doc_id = kept.doc_id""",
    "op11_merkle_manifest": f"""
WITH RECURSIVE d AS (
  SELECT *, CASE WHEN {_CRC32.format(x="doc_id")} % 3 = 0 THEN translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') ELSE text END AS low FROM documents),
l AS (SELECT doc_id, lang, {_leaf("text")} AS leaf, {_leaf("low")} AS bad FROM d),
leaves AS (
  SELECT doc_id, leaf, bad, CASE WHEN lang IS NULL THEN '0' ELSE '1' || lang END AS tree, count(*) OVER (PARTITION BY lang) AS n,
    row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i FROM l),
nodes(tree, lvl, i, n, h) AS (
  SELECT tree, 0, i, n, leaf FROM leaves
  UNION ALL
  SELECT tree, lvl + 1, i // 8, (n + 7) // 8, sha256(string_agg(h, '' ORDER BY i)) FROM nodes WHERE n > 1 GROUP BY tree, lvl, i // 8, n),
subs AS (SELECT tree, lvl, h, count(*) OVER () AS n, row_number() OVER (ORDER BY tree) - 1 AS i FROM nodes WHERE n = 1),
above(lvl, i, n, h) AS (
  SELECT 0, i, n, h FROM subs
  UNION ALL
  SELECT lvl + 1, i // 8, (n + 7) // 8, sha256(string_agg(h, '' ORDER BY i)) FROM above WHERE n > 1 GROUP BY lvl, i // 8, n),
path AS (
  SELECT tree, lvl, i, n, h FROM nodes WHERE n > 1
  UNION ALL SELECT '', lvl, i, n, h FROM above WHERE n > 1),
runs AS (SELECT tree, lvl, i // 8 AS up, list(h ORDER BY i) AS kids FROM path GROUP BY tree, lvl, i // 8),
root AS (SELECT h FROM above WHERE n = 1),
climb(doc_id, leaf, tree, k, top, own, lvl, i, h, proof) AS (
  SELECT doc_id, leaf, tree, l.i, s.lvl, s.i, 0, CASE WHEN s.lvl = 0 THEN s.i ELSE l.i END, bad, '' FROM leaves l JOIN subs s USING (tree)
  UNION ALL
  SELECT doc_id, leaf, c.tree, k, top, own, c.lvl + 1, CASE WHEN c.lvl + 1 = top THEN own ELSE c.i // 8 END,
    sha256(array_to_string(kids[:c.i % 8] || [h] || kids[c.i % 8 + 2:], '')), proof || array_to_string(kids[:c.i % 8] || kids[c.i % 8 + 2:], '')
  FROM climb c JOIN runs r ON r.tree = CASE WHEN c.lvl < top THEN c.tree ELSE '' END AND r.lvl = CASE WHEN c.lvl < top THEN c.lvl ELSE c.lvl - top END AND r.up = c.i // 8),
done AS (SELECT tree, k, max(lvl) AS lvl FROM climb GROUP BY tree, k)
SELECT doc_id, leaf, s.h AS subroot, (SELECT h FROM root) AS root, sha256(proof) AS proof_sha256, c.h AS folded_root, c.h = (SELECT h FROM root) AS verified
FROM climb c JOIN done USING (tree, k, lvl) JOIN subs s ON s.tree = c.tree""",
    "op12_periodic_runs": f"""
WITH w0 AS (SELECT doc_id, {_WORDS.format(text="coalesce(text, '')")} AS ws, {_CRC32.format(x="doc_id")} AS h FROM documents),
w1 AS (SELECT *, len(ws) AS n, h // 10 AS g FROM w0),
w2 AS (SELECT *, CASE WHEN n > 0 THEN g % n ELSE 0 END AS a FROM w1),
w3 AS (SELECT *, 1 + (n - a) // (3 + g % 8) AS p FROM w2),
w AS (SELECT doc_id, CASE WHEN h % 10 = 0 AND n > 0 THEN list_transform(range(n), lambda i: ws[1 + CASE WHEN i < a THEN i ELSE a + (i - a) % p END]) ELSE ws END AS ws FROM w3),
six AS (SELECT doc_id, i, hash(ws[i + 1:i + 6]) AS k, ws[i + 1:i + 6] AS six FROM (SELECT doc_id, ws, unnest(range(0, len(ws) - 5)) AS i FROM w WHERE len(ws) >= 12)),
same AS (SELECT x.doc_id, x.i, y.i - x.i AS q FROM six x JOIN six y ON x.doc_id = y.doc_id AND x.k = y.k AND x.six = y.six AND x.i < y.i),
part AS (SELECT doc_id, q, i, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS grp FROM same),
long AS (SELECT doc_id, q, min(i) AS s, count(*) + 5 + q AS length FROM part GROUP BY doc_id, q, grp),
runs AS (SELECT doc_id, s, length, min(q) AS q FROM long WHERE length >= greatest(12, 2 * q) GROUP BY doc_id, s, length),
stat AS (SELECT doc_id, count(*) AS n_runs, string_agg(concat(s, ',', length, ',', q, chr(10)), '' ORDER BY s, q) AS txt, min(struct_pack(l := -length, s := s, q := q)) AS best FROM runs GROUP BY doc_id),
gone AS (SELECT DISTINCT doc_id, unnest(range(s + q, s + length)) AS i FROM runs),
kw AS (SELECT doc_id, unnest(ws) AS word, unnest(range(len(ws))) AS i FROM w),
kept AS (SELECT kw.doc_id, string_agg(word, ' ' ORDER BY kw.i) AS txt FROM kw ANTI JOIN gone ON kw.doc_id = gone.doc_id AND kw.i = gone.i GROUP BY kw.doc_id)
SELECT w.doc_id, CAST(coalesce(n_runs, 0) AS BIGINT) AS n_runs, CAST(best.s AS BIGINT) AS "start", CAST(-best.l AS BIGINT) AS length, CAST(best.q AS BIGINT) AS period,
  CAST(1000 * -best.l // best.q AS BIGINT) AS exponent_milli, sha256(coalesce(stat.txt, '')) AS runs_sha256, sha256(coalesce(kept.txt, '')) AS collapsed_sha256
FROM w LEFT JOIN stat ON w.doc_id = stat.doc_id LEFT JOIN kept ON w.doc_id = kept.doc_id""",
}
