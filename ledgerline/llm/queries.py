"""The registered queries of the operators, each over its whole table with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ledgerline.llm import (
    content_dedup,
    fm_decontamination,
    html_density,
    length_histogram,
    mixing,
    permutation_index,
    ppm_language,
    prefix_bpe,
    prefix_trie,
    simhash,
    token_files,
    url_rules,
    walsh_clusters,
)
from ledgerline.llm.common import table
from ledgerline.session import configure, work_folder

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(build):
        QUERIES[name] = lambda spark, sf_dir: build(configure(spark), sf_dir)
        if sql is not None:
            ORACLES[name] = sql
        return build

    return register


#: Target weights of the mix; sources that are not named share the rest.
WEIGHTS = {"src0": 20, "src1": 10, "src2": 8} | {f"src{i}": 3 for i in range(3, 20)}
REST_WEIGHT = 11

_SHARES = [*WEIGHTS.values(), REST_WEIGHT]
_NUMBERED = ", ".join(f"('{s}', {i})" for i, s in enumerate(WEIGHTS))

MIX_SQL = f"""
WITH RECURSIVE
weights AS (SELECT {_SHARES}::BIGINT[] AS w, {sum(_SHARES)}::BIGINT AS period, {len(_SHARES) - 1} AS rest),
turns AS (
  SELECT -1::BIGINT AS slot, list_transform(w, lambda x: 0::BIGINT) AS done, NULL::BIGINT AS pick, w, period FROM weights
  UNION ALL
  SELECT slot + 1, list_transform(done, lambda k, i: CASE WHEN i = p THEN k + 1 ELSE k END), p, w, period
  FROM (
    SELECT slot, done, w, period, (
      SELECT min_by(i, ((done[i] + 1) * period + w[i] - 1) // w[i] * 1000 + i)
      FROM (SELECT unnest(range(1, len(w) + 1)) AS i) WHERE done[i] * period // w[i] <= slot + 1
    ) AS p
    FROM turns WHERE slot + 1 < period
  )
),
plan AS (
  SELECT slot, pick - 1 AS stream, done[pick] - 1 AS nth,
         list_transform(done, lambda k, i: CASE WHEN i = pick THEN k - 1 ELSE k END) AS before
  FROM turns WHERE slot >= 0
),
named(source, stream) AS (VALUES {_NUMBERED}),
ranked AS (
  SELECT doc_id, d.source, coalesce(n.stream, rest) AS stream,
         row_number() OVER (PARTITION BY coalesce(n.stream, rest)
           ORDER BY substr(md5('mix' || chr(31) || coalesce(doc_id::VARCHAR, '')), 1, 15), doc_id NULLS FIRST) - 1 AS rank
  FROM documents d LEFT JOIN named n USING (source), weights
),
sizes AS (
  SELECT list(coalesce(c, 0) ORDER BY i) AS n
  FROM (SELECT unnest(range(0, rest + 1)) AS i FROM weights) LEFT JOIN (SELECT stream AS i, count(*) AS c FROM ranked GROUP BY 1) USING (i)
),
placed AS (
  SELECT doc_id, source, rank // {mixing.BLOCK_ROWS} AS block, rank % {mixing.BLOCK_ROWS} AS off,
         rank // {mixing.BLOCK_ROWS} // w[r.stream + 1] AS turn, slot, before, w, period, n
  FROM ranked r, weights, sizes, plan p
  WHERE p.stream = r.stream AND p.nth = rank // {mixing.BLOCK_ROWS} % w[r.stream + 1]
)
SELECT doc_id, source, block, (turn * period + slot)::BIGINT AS slot,
       (list_sum(list_transform(w, lambda x, i: least((turn * x + before[i]) * {mixing.BLOCK_ROWS}, n[i]))) + off)::BIGINT AS position
FROM placed
"""


@query("op1_mix_sources", MIX_SQL)
def mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source")
    return mixing.mix(docs, WEIGHTS, REST_WEIGHT)


@query("op2_simhash_near_copies")
def simhash_near_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_copies(table(spark, sf_dir, "documents"))


#: (host, path, verdict) as text.
URL_RULES = (
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
)

URL_SQL = f"""
WITH rules(h, p, v) AS (VALUES {", ".join(str(r) for r in URL_RULES)}),
cut AS (
  SELECT row_number() OVER () AS row, page_id,
         CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest
  FROM pages
),
parts AS (
  SELECT row, page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(substr(rest, length(regexp_extract(rest, '^[^/?#]*')) + 1), '^[^?#]*') AS path
  FROM cut
),
best AS (
  SELECT row, max_by(h || p, length(h || p) * 1000 + length(h)) AS rule, max_by(v, length(h || p) * 1000 + length(h)) AS verdict
  FROM parts JOIN rules ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p) GROUP BY row
)
SELECT page_id, host, path, rule, coalesce(verdict, '{url_rules.ALLOW}') AS verdict FROM parts LEFT JOIN best USING (row)
"""


@query("op3_url_rules", URL_SQL)
def judge_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(list(URL_RULES), "host string, path string, verdict string")
    return url_rules.judge(table(spark, sf_dir, "pages").select("page_id", "url"), rules).drop("url")


@query("op4_main_text")
def main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_density.extract(table(spark, sf_dir, "pages").select("page_id", "url", "html"))


@query("op5_language")
def language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ppm_language.predict_languages(table(spark, sf_dir, "documents"))


@query("op6_bpe_round_trip")
def bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_bpe.encode_documents(table(spark, sf_dir, "documents"))


EXACT_SQL = """
WITH texts AS (
  SELECT row_number() OVER () AS row, doc_id,
         translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t
  FROM documents
)
SELECT doc_id, first_value(doc_id) OVER w AS keep_id, count(*) OVER (PARTITION BY t) AS group_size,
       row_number() OVER w = 1 AS kept, sha256(t) AS text_sha256
FROM texts WINDOW w AS (PARTITION BY t ORDER BY doc_id DESC NULLS LAST, row)
"""


@query("op7_exact_copies", EXACT_SQL)
def exact_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return content_dedup.exact_copies(table(spark, sf_dir, "documents"), keep="largest")


@query("op8_token_counts")
def token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    by = ["source"]
    return length_histogram.report(length_histogram.lengths(table(spark, sf_dir, "documents"), by), by)


@query("op9_token_files")
def token_file_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.written_documents(table(spark, sf_dir, "documents"), work_folder(spark, "llm-token-files"))


@query("op10_nearest_vectors")
def nearest_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return permutation_index.search(table(spark, sf_dir, "embeddings"), "id % 20 = 0", k=20)


TRIE_SQL = """
WITH RECURSIVE
steps(i, v, k) AS (
  SELECT i::UBIGINT, i::UBIGINT, 0 FROM range(256) AS r(i)
  UNION ALL SELECT i, CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384::UBIGINT) ELSE v >> 1 END, k + 1 FROM steps WHERE k < 8
),
crc AS (SELECT list(v ORDER BY i) AS entry FROM steps WHERE k = 8),
own AS (
  SELECT conv_id AS c, d, t, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, d) AS p
  FROM (SELECT conv_id, turn, coalesce(text, '') AS t, md5(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS d
        FROM conversations WHERE conv_id IS NOT NULL)
),
convs AS (
  SELECT c, c - c % 20 AS base, xor(list_reduce(
    list_prepend(4294967295::UBIGINT, list_transform(string_split(c::VARCHAR, ''), lambda x: ascii(x)::UBIGINT)),
    lambda a, b: xor(a >> 8, entry[((xor(a, b) & 255) + 1)::BIGINT])), 4294967295::UBIGINT) % 4 AS h
  FROM (SELECT DISTINCT c FROM own), crc
),
rebuilt AS (
  SELECT v.c, 0 AS part, p, d, t FROM convs v JOIN own o ON o.c = v.base AND p <= h
  UNION ALL SELECT v.c, 1, p, d, t FROM convs v JOIN own o ON o.c = v.c AND p > h
),
prefixes AS (
  SELECT c, row_number() OVER w AS depth, string_agg(d, '') OVER (w ROWS UNBOUNDED PRECEDING) AS path,
         len(regexp_extract_all(t, '[^\\x20\\x09-\\x0D]+')) AS words
  FROM rebuilt WINDOW w AS (PARTITION BY c ORDER BY part, p)
  UNION ALL SELECT c, 0, '', 0 FROM convs
),
lengths AS (SELECT c, max(depth) AS depth FROM prefixes GROUP BY c),
nodes AS (SELECT path, depth, min(c) AS conv_id, count(*) AS n, max(words) AS words FROM prefixes GROUP BY path, depth),
kids AS (SELECT left(path, len(path) - 32) AS path, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY 1),
ends AS (SELECT path, string_agg(c::VARCHAR, ',' ORDER BY c) AS ids FROM prefixes JOIN lengths USING (c, depth) GROUP BY path),
below AS (
  SELECT a.path, count(*) FILTER (k.path IS NULL) AS n_leaves, sum((b.n - 1) * b.words) AS saved
  FROM nodes a JOIN nodes b ON starts_with(b.path, a.path) LEFT JOIN kids k ON k.path = b.path GROUP BY a.path
)
SELECT n.conv_id, n.depth, up.conv_id AS parent_conv_id, n.n AS n_convs, coalesce(n_children, 0) AS n_children, n_leaves,
       saved::BIGINT AS saved_tokens, sha256(coalesce(ids, '')) AS ends_sha256
FROM nodes n JOIN below USING (path) LEFT JOIN kids USING (path) LEFT JOIN ends USING (path)
LEFT JOIN nodes up ON n.depth > 0 AND up.path = left(n.path, greatest(len(n.path) - 32, 0))
"""


@query("op11_prefix_trie", TRIE_SQL)
def conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.prefix_trie(table(spark, sf_dir, "conversations"), share_heads=True)


def _clusters_sql(clusters: int, rounds: int) -> str:
    kept = """kept AS MATERIALIZED (
  SELECT row_number() OVER () AS row, vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)::BIGINT) AS v FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = 64
)"""
    start = f"""c0 AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY sha256('1:' || vec_id), v) - 1 AS c, v AS w FROM kept ORDER BY sha256('1:' || vec_id), v LIMIT {clusters}
)"""

    def nearest(i: int) -> str:
        return f"""a{i} AS MATERIALIZED (
  SELECT row, min(d * {clusters} + c) % {clusters} AS c, min(d) AS d
  FROM (SELECT row, c, list_sum(list_transform(list_zip(v, w), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT AS d FROM kept, c{i}) GROUP BY row
)"""

    def moved(i: int) -> str:
        return f"""c{i + 1} AS MATERIALIZED (
  SELECT c, coalesce(m.w, old.w) AS w FROM c{i} AS old LEFT JOIN (
    SELECT c, list(((s - ((s % n) + n) % n) // n)::BIGINT ORDER BY k) AS w
    FROM (SELECT c, k, sum(v[k]) AS s, count(*) AS n FROM a{i} JOIN kept USING (row), range(1, 65) AS r(k) GROUP BY c, k) GROUP BY c
  ) AS m USING (c)
)"""

    parts = [kept, start] + [f(i) for i in range(rounds) for f in (nearest, moved)] + [nearest(rounds)]
    return f"""WITH {", ".join(parts)}
SELECT vec_id, c::INTEGER AS cluster, d AS distance, sum(d) OVER (PARTITION BY c)::BIGINT AS cluster_inertia, sum(d) OVER ()::BIGINT AS inertia,
       sha256(array_to_string(w, ',')) AS centroid_sha256
FROM a{rounds} JOIN kept USING (row) JOIN c{rounds} USING (c)
"""


CLUSTERS, ROUNDS = 16, 3


@query("op12_centroid_clusters", _clusters_sql(CLUSTERS, ROUNDS))
def centroid_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return walsh_clusters.clusters_of(table(spark, sf_dir, "embeddings"), clusters=CLUSTERS, rounds=ROUNDS)


LEAKS_SQL = r"""
WITH
texts AS (
  SELECT row_number() OVER () AS row, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents
),
items AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark
),
windows AS MATERIALIZED (
  SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(w[i : i + least(len(w), 10) - 1], ' ') AS phrase
  FROM items, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS u(i) WHERE len(w) > 0
),
places AS (
  SELECT row, i, n, array_to_string(w[i : i + n - 1], ' ') AS phrase
  FROM texts, unnest(range(1, len(w) + 1)) AS u(i), (SELECT DISTINCT n FROM windows) AS l WHERE i + n - 1 <= len(w)
),
found AS MATERIALIZED (SELECT row, i, n, item_id FROM places JOIN windows USING (n, phrase)),
hits AS (SELECT row, count(DISTINCT k) AS n_hit FROM (SELECT row, unnest(range(i, i + n)) AS k FROM found) GROUP BY row),
who AS (
  SELECT row, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids
  FROM (SELECT DISTINCT row, item_id::VARCHAR AS item FROM found WHERE item_id IS NOT NULL) GROUP BY row
)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM texts LEFT JOIN hits USING (row) LEFT JOIN who USING (row)
"""


@query("op13_benchmark_passages", LEAKS_SQL)
def benchmark_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fm_decontamination.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
