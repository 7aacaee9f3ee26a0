"""Queries of the operators and their SQL, for the driver contract.

``queries()`` maps a name to a callable (spark, sf_dir) -> DataFrame; every query
runs over its whole table.  ``oracle_sql()`` has DuckDB SQL where SQL can express
the result; the others are held against brute force in ``tests/llm``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from landstage.llm import decontam as D
from landstage.llm import exact as E
from landstage.llm import langid as L
from landstage.llm import lm as N
from landstage.llm import merkle as K
from landstage.llm import minhash as M
from landstage.llm import mixing as X
from landstage.llm import pii as P
from landstage.llm import quality as Q
from landstage.llm import repair as G
from landstage.llm import repetition as R
from landstage.llm import suffix as S
from landstage.llm import warc as V

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.near_duplicates(table(spark, sf_dir, "documents"))


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return D.overlaps(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op3_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return P.personal_data(docs, P.train(docs))


def op4_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return Q.classify(docs, Q.train(docs, table(spark, sf_dir, "labels")))


def op5_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return X.mix(table(spark, sf_dir, "documents"))


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return L.identify(docs, L.train(docs))


def op7_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = V.resolve_revisits(V.records_of_pages(table(spark, sf_dir, "pages")))
    return found.withColumn("headers", V.header_lines(F.col("headers")))


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.quality_rules(table(spark, sf_dir, "documents")).drop("longest_repeat")


def op9_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = S.without_repeats(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_bytes", (F.col("n_bytes") - F.octet_length("kept")).cast("bigint").alias("n_removed"), "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op10_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = N.backoff_scores(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", *(F.round(c, 4).alias(c) for c in ("log10_total", "log10_mean")))


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return K.digests(K.manifest(table(spark, sf_dir, "documents")))


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return G.repaired(G.damaged(table(spark, sf_dir, "conversations")))


def op13_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return E.exact_duplicates(table(spark, sf_dir, "documents")).drop("n_bytes", "fp")


#: Words of a text, as a DuckDB expression.
SQL_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"
SQL_LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP8_SQL = rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text, {SQL_WORDS} AS w FROM documents),
lines AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM d),
dup AS (SELECT doc_id, count(*) - count(DISTINCT line) AS n FROM lines
        WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY doc_id),
win AS (SELECT doc_id, i, array_to_string(w[i:i + 4], ' ') AS s
        FROM (SELECT doc_id, w, unnest(range(1, len(w) - 3)) AS i FROM d)),
rep AS (SELECT doc_id, i FROM win QUALIFY count(*) OVER (PARTITION BY doc_id, s) > 1),
rw AS (SELECT doc_id, count(DISTINCT j) AS n FROM (SELECT doc_id, unnest(range(i, i + 5)) AS j FROM rep) GROUP BY doc_id),
pos AS (SELECT doc_id, text, unnest(range(1, length(text) - {R.MIN_REPEAT} + 2)) AS i FROM d),
short AS (SELECT doc_id, i FROM pos
          QUALIFY count(*) OVER (PARTITION BY doc_id, substr(text, i, {R.MIN_REPEAT})) > 1),
gap AS (SELECT doc_id, least({R.MIN_REPEAT}, coalesce(lead(i) OVER (PARTITION BY doc_id ORDER BY i) - i, {R.MIN_REPEAT})) AS n FROM short),
cover AS (SELECT doc_id, sum(n) AS n FROM gap GROUP BY doc_id),
long AS (SELECT DISTINCT doc_id FROM (SELECT doc_id FROM pos WHERE i + {R.MAX_REPEAT} <= length(text)
         QUALIFY count(*) OVER (PARTITION BY doc_id, substr(text, i, {R.MAX_REPEAT + 1})) > 1)),
base AS (SELECT d.doc_id, len(w)::BIGINT AS n_words,
    length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g'))::BIGINT AS word_chars,
    length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
    coalesce(dup.n, 0)::BIGINT AS n_dup_lines, coalesce(rw.n, 0)::BIGINT AS n_repeat_words,
    length(text)::BIGINT AS n_chars, coalesce(cover.n, 0)::BIGINT AS n_covered, long.doc_id IS NOT NULL AS too_long
  FROM d LEFT JOIN dup USING (doc_id) LEFT JOIN rw USING (doc_id) LEFT JOIN cover USING (doc_id)
  LEFT JOIN long ON long.doc_id = d.doc_id)
SELECT * EXCLUDE (too_long), n_words < {R.MIN_WORDS} OR 100 * n_repeat_words > {R.MAX_REPEAT_WORDS} * n_words AS base_failed,
  NOT (n_words < {R.MIN_WORDS} OR 100 * n_repeat_words > {R.MAX_REPEAT_WORDS} * n_words)
  AND 100 * n_covered <= {R.MAX_COVERED} * n_chars AND NOT too_long AS kept
FROM base
"""

OP1_SQL = rf"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all({SQL_LOWER}, '[^\x20\x09-\x0D]+') AS w FROM documents),
sh AS (SELECT DISTINCT doc_id, s FROM (
    SELECT doc_id, unnest(CASE WHEN len(w) >= {M.SHINGLE} THEN [array_to_string(w[i:i + {M.SHINGLE - 1}], ' ') FOR i IN range(1, len(w) - {M.SHINGLE - 2})]
                               ELSE [array_to_string(w, ' ')] END) AS s FROM d WHERE len(w) > 0)),
sz AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id),
pair AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM sh x JOIN sh y ON x.s = y.s AND x.doc_id < y.doc_id GROUP BY ALL),
link AS (SELECT a, b FROM pair JOIN sz p ON p.doc_id = a JOIN sz q ON q.doc_id = b WHERE 100 * c >= {M.THRESHOLD} * (p.n + q.n - c)),
edge AS (SELECT a, b FROM link UNION ALL SELECT b, a FROM link),
reach AS (SELECT a, b FROM edge UNION SELECT reach.a, edge.b FROM reach JOIN edge ON reach.b = edge.a),
comp AS (SELECT a AS doc_id, min(b) AS lo FROM reach GROUP BY a)
SELECT d.doc_id, coalesce(sz.n, 0)::BIGINT AS n_shingles, least(d.doc_id, coalesce(comp.lo, d.doc_id)) AS component_id,
  d.doc_id <= coalesce(comp.lo, d.doc_id) AS kept
FROM d LEFT JOIN sz USING (doc_id) LEFT JOIN comp USING (doc_id)
"""

#: Independent of the masks: of 13 words three differ at most (of 7 one, of 9 two), so three in a row are equal.
OP2_SQL = rf"""
WITH d AS (SELECT doc_id, regexp_extract_all({SQL_LOWER}, '[^\x20\x09-\x0D]+') AS w FROM documents WHERE doc_id IS NOT NULL),
v AS (SELECT item_id, regexp_extract_all({SQL_LOWER}, '[^\x20\x09-\x0D]+') AS v FROM benchmark WHERE item_id IS NOT NULL),
dt AS (SELECT doc_id, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS s FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM d)),
vt AS (SELECT item_id, i, v[i] || ' ' || v[i + 1] || ' ' || v[i + 2] AS s FROM (SELECT item_id, v, unnest(range(1, len(v) - 1)) AS i FROM v)),
hit AS (SELECT DISTINCT doc_id, item_id, dt.i - vt.i AS shift FROM dt JOIN vt USING (s)),
face AS (SELECT doc_id, item_id, shift, len(v) AS n, unnest(range(1, len(v) + 1)) AS j, w, v FROM hit JOIN d USING (doc_id) JOIN v USING (item_id) WHERE len(v) >= {D.SHORTEST}),
eq AS (SELECT doc_id, item_id, shift, n, j, CASE WHEN shift + j >= 1 AND w[shift + j] = v[j] THEN 1 ELSE 0 END AS e FROM face),
win AS (SELECT doc_id, item_id, shift, n, j, sum(e) OVER (PARTITION BY doc_id, item_id, shift ORDER BY j ROWS BETWEEN {D.WINDOW - 1} PRECEDING AND CURRENT ROW) AS m FROM eq),
best AS (SELECT doc_id, item_id, shift, n, max(m) AS best FROM win WHERE j >= least(n, {D.WINDOW}) GROUP BY ALL)
SELECT doc_id, item_id, count(DISTINCT shift) AS n_alignments, min(shift)::BIGINT AS first_shift, max(best)::BIGINT AS best_matches
FROM best WHERE best >= CASE WHEN n >= {D.WINDOW} THEN {D.NEED} WHEN n > {D.EXACT} THEN n - 3 * n // 13 ELSE n END GROUP BY doc_id, item_id
"""

_SQL_NUMBER = "('0x' || substr(md5({}), 1, 15))::BIGINT"
OP5_SQL = rf"""
WITH RECURSIVE counted AS (SELECT doc_id, source, n_tokens FROM (SELECT doc_id, source, len({SQL_WORDS})::BIGINT AS n_tokens FROM documents) WHERE n_tokens > 0),
each AS (SELECT source, sum(n_tokens)::BIGINT AS tokens, count(*) AS docs FROM counted GROUP BY source),
total AS (SELECT sum(tokens)::BIGINT AS total FROM each),
shares AS (SELECT list(tokens::DOUBLE / total::DOUBLE ORDER BY source NULLS FIRST) AS p FROM each, total),
bis AS (SELECT 0 AS k, 0.0::DOUBLE AS lo, 1.0::DOUBLE AS hi, p FROM shares
  UNION ALL SELECT k + 1, CASE WHEN fits THEN lo ELSE mid END, CASE WHEN fits THEN mid ELSE hi END, p FROM (
    SELECT *, (lo + hi) / 2 AS mid, list_max(list_transform(p, lambda x: pow(x, (lo + hi) / 2 - 1))) / list_sum(list_transform(p, lambda x: pow(x, (lo + hi) / 2))) <= {X.MAX_REPEATS} AS fits
    FROM bis WHERE k < {X.HALVINGS})),
last AS (SELECT hi AS a, list_sum(list_transform(p, lambda x: pow(x, hi))) AS z FROM bis WHERE k = {X.HALVINGS}),
plan AS (SELECT source, tokens, docs, floor(pow(tokens::DOUBLE / total::DOUBLE, a) / z * total + 0.5)::BIGINT AS budget FROM each, total, last),
parts AS (SELECT source, budget // tokens AS full_, budget % tokens AS rest, ceil(sqrt(docs))::BIGINT AS n_blocks FROM plan),
base AS (SELECT doc_id, c.source, n_tokens, full_, rest, {_SQL_NUMBER.format("coalesce(doc_id::VARCHAR, 'null')")} % n_blocks AS block, unnest(range(0, full_ + 1)) AS epoch
  FROM counted c JOIN parts p ON c.source IS NOT DISTINCT FROM p.source),
r AS (SELECT * FROM base WHERE epoch < full_ OR rest > 0),
b AS (SELECT source, epoch, block, sum(n_tokens) AS s FROM r GROUP BY ALL),
br AS (SELECT source, epoch, block, row_number() OVER w AS block_rank, sum(s) OVER w - s AS before FROM b
  WINDOW w AS (PARTITION BY source, epoch ORDER BY {_SQL_NUMBER.format("block || ':' || epoch")}, block ROWS UNBOUNDED PRECEDING)),
placed AS (SELECT r.*, block_rank, row_number() OVER w AS doc_rank, before + sum(n_tokens) OVER w AS upto
  FROM r JOIN br ON r.source IS NOT DISTINCT FROM br.source AND r.epoch = br.epoch AND r.block = br.block
  WINDOW w AS (PARTITION BY r.source, r.epoch, r.block ORDER BY {_SQL_NUMBER.format("coalesce(doc_id::VARCHAR, 'null') || ':' || r.epoch")}, doc_id NULLS FIRST, n_tokens ROWS UNBOUNDED PRECEDING))
SELECT doc_id, source, epoch, block_rank, doc_rank, n_tokens FROM placed WHERE epoch < full_ OR upto <= rest
"""

_SQL_HOST = "regexp_replace(regexp_replace(lower(regexp_extract(url, '^(?:[A-Za-z][A-Za-z0-9+.-]*://)?([^/?#]*)', 1)), ':(80|443)$', ''), '^www\\.', '')"
_SQL_PATH = "regexp_replace(regexp_extract(url, '^(?:[A-Za-z][A-Za-z0-9+.-]*://)?[^/?#]*([^?#]*)', 1), '/+$', '')"
_SQL_FIELDS = "list_sort(list_filter(string_split(regexp_extract(url, '^[^?#]*\\?([^#]*)', 1), '&'), lambda x: x <> '' AND NOT starts_with(x, 'utm_')))"
OP7_SQL = rf"""
WITH p AS (SELECT page_id AS i, {_SQL_HOST} || {_SQL_PATH} || CASE WHEN len({_SQL_FIELDS}) > 0 THEN '?' || array_to_string({_SQL_FIELDS}, '&') ELSE '' END AS page,
    md5(coalesce(html, '')) AS digest, strlen(coalesce(html, '')) AS size, 10 * page_id AS ts, 'day ' || (page_id // 100) AS stamp FROM pages),
v AS (SELECT i, page, 10 * i + (i * 37 % 406) * 10 - 455 AS ts, CASE WHEN i % 13 = 0 OR i % 7 = 0 THEN NULL WHEN i % 11 = 0 THEN 'other' ELSE substr(digest, 1, 16) END AS tag,
    CASE WHEN i % 13 <> 0 THEN stamp END AS stamp FROM p),
j AS (SELECT v.i, v.page, v.ts, v.tag, v.stamp, p.i AS base, p.digest, p.size, p.stamp AS base_stamp, row_number() OVER (PARTITION BY v.i ORDER BY p.ts DESC NULLS LAST, p.i DESC) AS k
  FROM v LEFT JOIN p ON p.page = v.page AND p.ts < v.ts),
o AS (SELECT *, CASE WHEN base IS NULL THEN 'orphan' WHEN tag IS NOT NULL THEN CASE WHEN tag = substr(digest, 1, 16) THEN 'resolved' ELSE 'changed' END
    WHEN stamp IS NOT NULL THEN CASE WHEN stamp = base_stamp THEN 'resolved' ELSE 'changed' END ELSE 'unverified' END AS outcome FROM j WHERE k = 1)
SELECT 2 * i + 1 AS record_id, page, ts AS "at", 2 * base AS refers_to, outcome, CASE WHEN outcome IN ('resolved', 'unverified') THEN digest END AS digest,
  CASE WHEN outcome IN ('resolved', 'unverified') THEN array_to_string(['age: 1', 'cache-control: max-age=' || (i % 9), 'content-length: ' || size, 'content-type: text/html',
    'date: t' || ts, 'x-server: s' || (base % 5)], chr(10)) END AS headers FROM o
"""

OP10_SQL = rf"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce({SQL_LOWER}, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
t AS (SELECT doc_id, i, w[i] AS w, CASE WHEN i > 1 THEN w[i - 1] END AS u FROM (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS i FROM d)),
uni AS (SELECT w, count(*) AS c FROM t GROUP BY w),
bi AS (SELECT u, w, count(*) AS c FROM t WHERE u IS NOT NULL GROUP BY u, w),
s AS (SELECT t.doc_id, CASE WHEN t.u IS NOT NULL AND bi.c >= {N.SEEN} THEN log10(bi.c / prev.c::DOUBLE)
    ELSE log10(CASE WHEN t.u IS NULL THEN 1.0::DOUBLE ELSE {N.BACKOFF}::DOUBLE END * uni.c / (SELECT count(*) FROM t)) END AS s
  FROM t JOIN uni ON uni.w = t.w LEFT JOIN bi ON bi.u = t.u AND bi.w = t.w LEFT JOIN uni prev ON prev.w = t.u),
g AS (SELECT doc_id, count(*) AS n, sum(s) AS s FROM s GROUP BY doc_id)
SELECT d.doc_id, coalesce(g.n, 0)::BIGINT AS n_words, round(g.s, 4) AS log10_total, round(g.s / g.n, 4) AS log10_mean FROM d LEFT JOIN g USING (doc_id)
"""

OP9_SQL = f"""
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
pos AS (SELECT doc_id, h, unnest(range(0, length(h) // 2)) AS i FROM d),
win AS (SELECT doc_id, i, substr(h, 2 * i + 1, {2 * S.LENGTH}) AS w FROM pos WHERE 2 * i + {2 * S.LENGTH} <= length(h)),
hit AS (SELECT doc_id, i FROM win QUALIFY min(doc_id) OVER (PARTITION BY w) < doc_id),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + {S.LENGTH})) AS i FROM hit),
span AS (SELECT doc_id, count(*) AS n, count(*) FILTER (step IS DISTINCT FROM 1) AS spans
  FROM (SELECT doc_id, i - lag(i) OVER (PARTITION BY doc_id ORDER BY i) AS step FROM gone) GROUP BY doc_id),
kept AS (SELECT doc_id, string_agg(substr(h, 2 * i + 1, 2), '' ORDER BY i) AS k FROM pos ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id)
SELECT d.doc_id, (length(h) // 2)::BIGINT AS n_bytes, coalesce(span.n, 0)::BIGINT AS n_removed, coalesce(span.spans, 0)::BIGINT AS n_spans,
  sha256(unhex(coalesce(kept.k, ''))) AS kept_sha256
FROM d LEFT JOIN span USING (doc_id) LEFT JOIN kept USING (doc_id)
"""



def sql_crc32(text: str) -> str:
    """Unsigned crc32 of an ASCII text, as a DuckDB expression."""
    byte = "list_reduce([xor(c, b)] || range(8), lambda x, i: xor(x >> 1, (x & 1) * 3988292384))"
    return f"xor(list_reduce([4294967295::BIGINT] || list_transform(string_split({text}, ''), lambda x: ascii(x)::BIGINT), lambda c, b: {byte}), 4294967295)"


def _sql_climb(name: str, first: str, levels: int) -> str:
    """Levels {name}0 .. of a forest (g, i, n, h) and what lies left and right of each node on its level."""
    out = [f"{name}0 AS ({first})"]
    for k in range(levels):
        out.append(f"""{name}{k + 1} AS (SELECT g, i // {K.RUN} AS i, max(n + {K.RUN - 1}) // {K.RUN} AS n,
            CASE WHEN max(n) = 1 THEN max(h) ELSE sha256(string_agg(h, '' ORDER BY i)) END AS h FROM {name}{k} GROUP BY g, i // {K.RUN})""")
        out.append(f"""{name}s{k} AS (SELECT a.g, a.i, a.n, coalesce(string_agg(b.h, '' ORDER BY b.i) FILTER (b.i < a.i), '') AS l,
            coalesce(string_agg(b.h, '' ORDER BY b.i) FILTER (b.i > a.i), '') AS r FROM {name}{k} a JOIN {name}{k} b ON a.g = b.g AND a.i // {K.RUN} = b.i // {K.RUN} GROUP BY ALL)""")
    return ",\n".join(out)


def _sql_fold(name: str, start: str, levels: int) -> str:
    """{name}f{levels}: every row of ``start`` (place i, group g, digest f, proof p) folded through the forest."""
    out, at = [], start
    for k in range(levels):
        out.append(f"""{name}f{k + 1} AS (SELECT x.* EXCLUDE (f, p), CASE WHEN s.n > 1 THEN sha256(s.l || x.f || s.r) ELSE x.f END AS f,
            CASE WHEN s.n > 1 THEN x.p || s.l || s.r ELSE x.p END AS p FROM {at} x JOIN {name}s{k} s ON s.g = x.g AND s.i = x.i // {K.RUN ** k})""")
        at = f"{name}f{k + 1}"
    return ",\n".join(out)


def _sql_leaf(text: str) -> str:
    return "sha256(" + " || ".join(f"coalesce(strlen({c}::VARCHAR) || ':' || {c}::VARCHAR, '-')" for c in ("doc_id", "source", "lang", "n_chars", text)) + ")"


#: Levels that the SQL unrolls: 8 ** 7 rows of a language, 8 ** 3 languages.
_DOWN, _UP = 7, 3
OP11_SQL = f"""
WITH leaves AS (SELECT doc_id, dense_rank() OVER (ORDER BY lang NULLS FIRST) - 1 AS g, {_sql_leaf("text")} AS h,
    CASE WHEN {sql_crc32("doc_id::VARCHAR")} % 3 = 0 THEN {_sql_leaf(SQL_LOWER)} END AS t FROM documents),
placed AS (SELECT *, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, h) - 1 AS i, count(*) OVER (PARTITION BY g) AS n FROM leaves),
{_sql_climb("d", "SELECT g, i, n, h FROM placed", _DOWN)},
{_sql_climb("u", f"SELECT 0 AS g, g AS i, count(*) OVER () AS n, h FROM d{_DOWN}", _UP)},
start AS (SELECT *, coalesce(t, h) AS f, '' AS p FROM placed),
{_sql_fold("d", "start", _DOWN)},
middle AS (SELECT * EXCLUDE (g, i), 0 AS g, g AS i, g AS lang_rank FROM df{_DOWN}),
{_sql_fold("u", "middle", _UP)}
SELECT f.doc_id, f.h AS leaf, s.h AS subroot, r.h AS root, sha256(f.p) AS proof_sha256, f.f AS folded_root, f.f = r.h AS verified
FROM uf{_UP} f JOIN d{_DOWN} s ON s.g = f.lang_rank CROSS JOIN u{_UP} r
"""

_SQL_BLANK = r"[\x20\x09-\x0D]"
#: Edits in ASCII order are tried as (cost, letters); a state keeps its least pair per row.
OP12_SQL = rf"""
WITH RECURSIVE ins(f, t, c, l) AS (VALUES (0, 0, 0, ''), (0, 2, 2, 'I'), (0, 3, 4, 'II'), (1, 1, 0, ''), (1, 2, 2, 'I'), (1, 3, 4, 'II'), (2, 2, 0, ''), (2, 3, 2, 'I'), (3, 3, 0, ''), (3, 2, 2, 'I')),
c AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, {sql_crc32("coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ')")} % 20 AS k FROM conversations),
dam AS (SELECT conv_id, turn, CASE WHEN k = 4 THEN 'user' ELSE role END AS role, CASE k WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text,
    unnest(CASE WHEN k = 3 THEN [0, 1] ELSE [0] END) AS copy FROM c WHERE k <> 0),
r AS (SELECT *, row_number() OVER w AS i, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) AS nth,
    regexp_replace(text, '{_SQL_BLANK}', '', 'g') AS t FROM dam WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(length(role) || ':' || role || text), copy)),
s AS (SELECT *, t = '' AS blank, t <> '' AND nth > 1 AS dup, t <> '' AND nth = 1 AND right(t, 1) NOT IN ('.', '!', '?') AS cut, left(role, 1) AS a FROM r),
pair AS (SELECT *, lag(a) OVER (PARTITION BY conv_id ORDER BY i) || a AS pr FROM s),
sums AS (SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (blank) AS blank, count(*) FILTER (dup) AS dup, count(*) FILTER (cut) AS cut,
    count(*) FILTER (pr NOT IN ('su', 'ua', 'au')) AS bad, max(i) AS n FROM pair GROUP BY conv_id),
step AS (SELECT conv_id, i, x.f, x.t, x.c, x.l FROM s, LATERAL (
    SELECT f, f AS t, 3 AS c, 'D' AS l FROM (VALUES (0), (1), (2), (3)) v(f)
    UNION ALL SELECT f, t, 2 + cut::INT, 'R' FROM (VALUES (0, 2), (1, 2), (2, 3), (3, 2)) v(f, t) WHERE NOT (blank OR dup)
    UNION ALL SELECT f, t, cut::INT, 'K' FROM (VALUES ('s', 0, 1), ('u', 0, 2), ('u', 1, 2), ('u', 3, 2), ('a', 2, 3)) v(b, f, t) WHERE NOT (blank OR dup) AND b = a) x),
way AS (SELECT conv_id, 0::BIGINT AS i, 0 AS state, {{'c': 0, 'l': ''}} AS best FROM sums
  UNION ALL SELECT w.conv_id, w.i + 1, p.t, min({{'c': best.c + ins.c + p.c, 'l': best.l || ins.l || p.l}}) FROM way w JOIN ins ON ins.f = w.state
    JOIN step p ON p.conv_id IS NOT DISTINCT FROM w.conv_id AND p.i = w.i + 1 AND p.f = ins.t GROUP BY w.conv_id, w.i + 1, p.t),
fin AS (SELECT w.conv_id, min({{'c': best.c + ins.c, 'l': best.l || ins.l}}) AS best FROM way w JOIN sums u ON u.conv_id IS NOT DISTINCT FROM w.conv_id AND u.n = w.i JOIN ins ON ins.f = w.state WHERE ins.t IN (0, 3) GROUP BY w.conv_id),
letter AS (SELECT conv_id, p, substr(best.l, p, 1) AS l FROM (SELECT conv_id, best, unnest(range(1, length(best.l) + 1)) AS p FROM fin)),
numbered AS (SELECT *, count(*) FILTER (l <> 'I') OVER (PARTITION BY conv_id ORDER BY p) AS i FROM letter),
kept AS (SELECT m.conv_id, p, l, CASE WHEN l <> 'I' THEN s.role END AS role, CASE WHEN l <> 'I' THEN s.text ELSE '' END AS text FROM numbered m LEFT JOIN s ON s.conv_id IS NOT DISTINCT FROM m.conv_id AND s.i = m.i WHERE l <> 'D'),
sides AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY p) - CASE WHEN first_value(l = 'K' AND left(role, 1) = 's') OVER (PARTITION BY conv_id ORDER BY p) THEN 1 ELSE 0 END AS q FROM kept),
line AS (SELECT conv_id, string_agg(CASE WHEN l = 'K' THEN role WHEN q % 2 = 1 THEN 'user' ELSE 'assistant' END || ':' || text, chr(10) ORDER BY p) AS body FROM sides GROUP BY conv_id)
SELECT o.conv_id, coalesce(u.gaps, 0)::BIGINT AS gaps, coalesce(u.blank, 0)::BIGINT AS blank, coalesce(u.dup, 0)::BIGINT AS duplicate, coalesce(u.cut, 0)::BIGINT AS truncated, coalesce(u.bad, 0)::BIGINT AS illegal,
  coalesce(f.best.c, 0)::BIGINT AS cost, coalesce(f.best.l, '') AS audit, sha256(coalesce(line.body, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o LEFT JOIN sums u ON u.conv_id IS NOT DISTINCT FROM o.conv_id
LEFT JOIN fin f ON f.conv_id IS NOT DISTINCT FROM o.conv_id LEFT JOIN line ON line.conv_id IS NOT DISTINCT FROM o.conv_id
"""

OP13_SQL = f"""
SELECT doc_id, max(doc_id) OVER (PARTITION BY t) AS keep_id, count(*) OVER (PARTITION BY t) AS group_size,
  row_number() OVER (PARTITION BY t ORDER BY doc_id DESC NULLS LAST) = 1 AS kept, sha256(t) AS text_sha256
FROM (SELECT doc_id, coalesce({SQL_LOWER}, '') AS t FROM documents)
"""

QUERIES: dict[str, Query] = {
    "op1_minhash_near_dedup": op1_minhash_near_dedup,
    "op2_decontamination": op2_decontamination,
    "op3_personal_data": op3_personal_data,
    "op4_quality_classifier": op4_quality_classifier,
    "op5_source_mixing": op5_source_mixing,
    "op6_language_id": op6_language_id,
    "op7_revisits": op7_revisits,
    "op8_quality_rules": op8_quality_rules,
    "op9_suffix_dedup": op9_suffix_dedup,
    "op10_lm_scores": op10_lm_scores,
    "op11_merkle_manifest": op11_merkle_manifest,
    "op12_conversation_repair": op12_conversation_repair,
    "op13_exact_dedup": op13_exact_dedup,
}

SQL: dict[str, str] = {
    "op1_minhash_near_dedup": OP1_SQL,
    "op2_decontamination": OP2_SQL,
    "op5_source_mixing": OP5_SQL,
    "op7_revisits": OP7_SQL,
    "op8_quality_rules": OP8_SQL,
    "op9_suffix_dedup": OP9_SQL,
    "op10_lm_scores": OP10_SQL,
    "op11_merkle_manifest": OP11_SQL,
    "op12_conversation_repair": OP12_SQL,
    "op13_exact_dedup": OP13_SQL,
}


def queries() -> dict[str, Query]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(SQL)
