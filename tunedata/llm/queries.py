"""The registered queries of this package and their DuckDB statements."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tunedata.llm import (bpe, conversations, imatch, jaccard_join, mixing, neighbours, pii, quality, ranked, simhash,
                          token_counts, toxicity, urls)
from tunedata.llm.common import read

# Tokenizer of the queries; the operators take any path.
TOKENIZER = "byte_bpe_50k.json"

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}
_SQL: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: Query) -> Query:
        _QUERIES[name] = fn
        if sql is not None:
            _SQL[name] = sql
        return fn
    return deco


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)


@register("op10_mixing", r"""
WITH d AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
         md5(concat_ws('|', '42', doc_id, text)) AS k
  FROM documents),
s0 AS (SELECT source, sum(size)::BIGINT AS n FROM d GROUP BY source),
s1 AS (SELECT source, n, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS src FROM s0),
s2 AS (SELECT *, CASE src % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS w, sum(n) OVER () AS total FROM s1),
s3 AS (SELECT *, total - coalesce(sum(3 * n) OVER o, 0) AS rest, sum(w) OVER () - coalesce(sum(w) OVER o, 0) AS wrest
       FROM s2 WINDOW o AS (ORDER BY n / w, src ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
lvl AS (SELECT max(total) - coalesce(sum(3 * n) FILTER (rest * w >= 3 * n * wrest), 0) AS r,
               sum(w) - coalesce(sum(w) FILTER (rest * w >= 3 * n * wrest), 0) AS rw FROM s3),
s4 AS (SELECT s3.*, CASE WHEN rest * w >= 3 * n * wrest THEN (3 * n)::DOUBLE
                         ELSE (r * w)::DOUBLE / rw::DOUBLE END AS target, (n + 31) // 32 AS blocks FROM s3, lvl),
s5 AS (SELECT *, CASE WHEN n > 0 THEN target * blocks / n ELSE 0 END AS need FROM s4),
s6 AS (SELECT *, sum(need) OVER (ORDER BY src) / sum(need) OVER () AS hi,
              coalesce(sum(need) OVER (ORDER BY src ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
              / sum(need) OVER () AS lo, sum(need) OVER () AS slots FROM s5),
pts AS (SELECT i, (i * 1327217885 % 2147483648) / 2147483648.0::DOUBLE AS u
        FROM range((SELECT round(max(slots))::BIGINT FROM s6)) t(i)),
sl AS (SELECT s6.src, blocks, row_number() OVER (PARTITION BY s6.src ORDER BY i) - 1 AS rank
       FROM pts JOIN s6 ON u >= lo AND u < hi),
tk AS (SELECT src, rank % blocks AS block, count(*) AS times FROM sl WHERE rank < 3 * blocks GROUP BY ALL),
pos AS (SELECT doc_id, size, s6.src, s6.n, target, row_number() OVER o AS seq, (sum(size) OVER o - size)::BIGINT AS start
        FROM d JOIN s6 ON d.source IS NOT DISTINCT FROM s6.source
        WINDOW o AS (PARTITION BY s6.src ORDER BY k, doc_id, size ROWS UNBOUNDED PRECEDING)),
pc AS (SELECT *, unnest(range(start // 32, (start + size - 1) // 32 + 1)) AS block FROM pos WHERE size > 0),
got AS (SELECT pc.src, seq, sum(times * (least(start + size, (pc.block + 1) * 32) - greatest(start, pc.block * 32)))
               AS taken FROM pc JOIN tk USING (src, block) GROUP BY ALL)
SELECT doc_id, size, n AS source_size, target, coalesce(taken, 0)::BIGINT AS taken
FROM pos LEFT JOIN got USING (src, seq)
""")
def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return mixing.taken_words(mixing.Mix(docs))


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


@register("op5_bpe")
def op5_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_decode(read(spark, sf_dir, "documents"), tokenizer_path())


@register("op9_token_counts")
def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(read(spark, sf_dir, "documents"), tokenizer_path())


@register("op8_simhash")
def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(read(spark, sf_dir, "documents"), shingle=4, max_bits=4)
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


@register("op3_imatch")
def op3_imatch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return imatch.edited_likeness(read(spark, sf_dir, "documents"), every_text=True)


URL_RULES = [("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"), ("org/fr/", "allow")]


@register("op4_redirects", r"""
WITH RECURSIVE p AS (
  SELECT page_id, url, html, contains(url, '://') AS ok,
         coalesce(translate(regexp_extract(url, '(?s)^(.*?)://([^/?#]*)', 2),
                            'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
         coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path
  FROM pages),
tags AS (
  SELECT DISTINCT url, path, regexp_replace(html, '(?s)<!--.*?(?:-->|\z)', '', 'g') AS html FROM p WHERE ok),
tag AS (
  SELECT url, path, unnest(regexp_extract_all(html, '(?is)<(?:link|meta)[\s/](?:[^>"'']|"[^"]*"|''[^'']*'')*>')) AS tag
  FROM tags),
attr AS (
  SELECT url, path, lower(tag[2:5]) AS name, list_transform(
           regexp_extract_all(tag, '[^\s=>"''/]+\s*=\s*(?:"[^"]*"|''[^'']*''|[^\s>"'']+)'),
           lambda a: [lower(regexp_extract(a, '^[^\s=]+')),
                      trim(regexp_replace(regexp_replace(a, '(?s)^[^=]*=\s*', ''), '(?s)^["'']|["'']$', '', 'g'))]) AS all_
  FROM tag),
named AS (
  SELECT url, path, name, coalesce(list_filter(all_, lambda a: a[1] = 'rel')[1][2], '') AS rel,
         coalesce(list_filter(all_, lambda a: a[1] = 'href')[1][2], '') AS href,
         coalesce(list_filter(all_, lambda a: a[1] = 'http-equiv')[1][2], '') AS equiv,
         coalesce(list_filter(all_, lambda a: a[1] = 'content')[1][2], '') AS content FROM attr),
raw AS (
  SELECT url, path, regexp_extract(url, '(?s)^(.*?)://', 1) AS scheme,
         regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1) AS site,
         replace(CASE WHEN name = 'link' THEN href
                      ELSE regexp_extract(content, '(?is)(?:^|[;,\s])url\s*=\s*["'']?\s*([^"''\s]+)', 1) END,
                 '&amp;', '&') AS link
  FROM named WHERE name = 'link' AND list_contains(regexp_split_to_array(lower(rel), '\s+'), 'canonical')
                OR name = 'meta' AND lower(equiv) = 'refresh'),
whole AS (
  SELECT DISTINCT url, CASE
    WHEN regexp_matches(link, '^[A-Za-z][A-Za-z0-9+.-]*://') THEN link
    WHEN starts_with(link, '//') THEN scheme || ':' || link
    WHEN starts_with(link, '/') THEN scheme || '://' || site || link
    WHEN starts_with(link, '#') THEN url
    WHEN starts_with(link, '?') THEN scheme || '://' || site || path || link
    ELSE scheme || '://' || site || regexp_replace(path, '[^/]*$', '')
         || CASE WHEN contains(path, '/') THEN '' ELSE '/' END || link END AS target
  FROM raw WHERE link <> ''),
links AS (
  SELECT DISTINCT url, regexp_extract(target, '(?s)^.*?://[^/?#]*') || CASE WHEN contains(way, '/.') THEN
           array_to_string(list_reduce([['']] || list_transform(string_split(way, '/')[2:], lambda s: [s]),
             lambda done, s: CASE s[1] WHEN '.' THEN done WHEN '..' THEN done[1:greatest(1, len(done) - 1)]
                                       ELSE done || s END), '/')
           || CASE WHEN regexp_matches(way, '/\.\.?$') THEN '/' ELSE '' END ELSE way END
         || regexp_extract(target, '(?s)^.*?://[^?#]*(.*)$', 1) AS target
  FROM (SELECT url, target, regexp_extract(target, '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS way FROM whole)),
u AS (SELECT url FROM p WHERE ok UNION SELECT target FROM links),
u2 AS (
  SELECT url, translate(regexp_extract(url, '(?s)^(.*?)://([^/?#]*)', 2),
                        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path,
         translate(regexp_extract(url, '(?s)^(.*?)://', 1),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS scheme,
         array_to_string(list_filter(string_split(regexp_extract(url, '(?s)^.*?://[^?#]*\?([^#]*)', 1), '&'),
           lambda q: q <> '' AND NOT regexp_matches(q, '(?i)^(utm_[^=]*|ref|gclid|fbclid)(=|$)')), '&') AS query
  FROM u),
u3 AS (
  SELECT url, CASE WHEN scheme = 'http' THEN 'https' ELSE scheme END || '://' || host
              || regexp_replace(path, '/+$', '') || CASE WHEN query <> '' THEN '?' || query ELSE '' END AS form,
         CASE WHEN ('.' || host) LIKE '%.example.net' AND starts_with(path, '/en/') THEN 'example.net/en/'
              WHEN ('.' || host) LIKE '%.example.com' AND starts_with(path, '/de/') THEN 'example.com/de/'
              WHEN ('.' || host) LIKE '%.org' AND starts_with(path, '/fr/') THEN 'org/fr/'
              WHEN ('.' || host) LIKE '%.net' AND starts_with(path, '/') THEN 'net/' END AS rule
  FROM u2),
edges AS (SELECT a.form AS x, b.form AS y FROM links JOIN u3 a ON links.url = a.url JOIN u3 b ON target = b.url),
sym AS (SELECT x, y FROM edges UNION SELECT y, x FROM edges),
reach AS (SELECT DISTINCT x AS a, x AS b FROM sym UNION SELECT a, y FROM reach JOIN sym ON b = x),
root AS (SELECT a AS form, min(b) AS root FROM reach GROUP BY a),
u4 AS (SELECT u3.*, coalesce(root, u3.form) AS root FROM u3 LEFT JOIN root USING (form)),
cls AS (SELECT root, coalesce(bool_or(rule IN ('example.net/en/', 'org/fr/')), false) AS allowed,
               coalesce(bool_or(rule IN ('net/', 'example.com/de/')), false) AS blocked FROM u4 GROUP BY root)
SELECT page_id, host, path, rule,
       CASE WHEN rule IN ('example.net/en/', 'org/fr/') THEN 'allow' WHEN rule IS NOT NULL THEN 'block'
            WHEN blocked AND NOT allowed THEN 'block' ELSE 'allow' END AS verdict
FROM p LEFT JOIN u4 USING (url) LEFT JOIN cls USING (root)
""")
def op4_redirects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge(read(spark, sf_dir, "pages"), URL_RULES)


@register("op2_neighbours", r"""
WITH v AS (
  SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings
  WHERE embedding IS NOT NULL AND vec_id IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
dim AS (SELECT len(e) AS n FROM v GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1),
w AS (SELECT vec_id, e FROM v WHERE len(e) = (SELECT n FROM dim)),
near AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_distance(q.e, c.e) AS score,
         row_number() OVER (PARTITION BY q.vec_id ORDER BY list_distance(q.e, c.e), c.vec_id) AS rank
  FROM w q JOIN w c ON q.vec_id <> c.vec_id WHERE q.vec_id % 100 = 0)
SELECT query_id, rank::INT AS rank, vec_id, score FROM near WHERE rank <= 10
""")
def op2_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.search(read(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, k=10)


@register("op1_toxicity")
def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    return toxicity.score_documents(docs, toxicity.train(docs, read(spark, sf_dir, "labels")), threshold=0.7)


@register("op7_quality")
def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    return quality.score_documents(docs, quality.train(docs, read(spark, sf_dir, "labels")), threshold=0.3)


@register("op6_pii")
def op6_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    return pii.find_in_documents(docs, pii.train(docs))


@register("op11_conversations", r"""
WITH RECURSIVE codes AS (
  SELECT list(list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], lambda x, k: xor(x >> 1, 3988292384 * (x & 1))) ORDER BY i) AS t
  FROM range(256) r(i)),
src AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         list_transform(string_split(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '), ''),
                        lambda c: unicode(c)::BIGINT) AS bytes
  FROM conversations),
hit AS (
  SELECT conv_id, turn, role, text,
         xor(list_reduce([4294967295] || bytes, lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) % 20 AS k
  FROM src, codes),
hurt AS (
  SELECT conv_id, turn, CASE k WHEN 4 THEN 'user' ELSE role END AS role,
         CASE k WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
         unnest(CASE k WHEN 3 THEN [0, 1] ELSE [0] END) AS copy
  FROM hit WHERE k <> 0),
convs AS (SELECT conv_id, row_number() OVER () AS c FROM (SELECT DISTINCT conv_id FROM conversations)),
placed AS (
  SELECT c, turn, role, text, row_number() OVER (PARTITION BY c ORDER BY turn NULLS FIRST, role, text, copy) AS i,
         row_number() OVER (PARTITION BY c, role, text ORDER BY turn NULLS FIRST, copy) AS seen,
         right(regexp_replace(text, '[\x20\x09-\x0D]+$', ''), 1) AS last
  FROM hurt JOIN convs ON hurt.conv_id IS NOT DISTINCT FROM convs.conv_id),
judged AS (
  SELECT c, turn, role, text, i, left(role, 1) AS u, lag(left(role, 1)) OVER (PARTITION BY c ORDER BY i) AS before,
         CASE WHEN last = '' THEN 'blank' WHEN seen > 1 THEN 'duplicate'
              WHEN last NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault
  FROM placed),
counted AS (
  SELECT c, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0)::BIGINT AS gaps,
         count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
         count(*) FILTER (fault = 'truncated') AS truncated,
         count(*) FILTER (i > 1 AND before || u NOT IN ('su', 'ua', 'au')) AS illegal, count(*) AS n
  FROM judged GROUP BY c),
edit AS (
  SELECT c, n AS i, [{'c': 0, 'a': '', 'r': []::VARCHAR[]}, {'c': 4, 'a': 'II', 'r': ['user:', 'assistant:']},
                     {'c': 2, 'a': 'I', 'r': ['assistant:']}, {'c': 0, 'a': '', 'r': []::VARCHAR[]}] AS v
  FROM counted
  UNION ALL
  SELECT c, i - 1,
         [least(b[1], {'c': x3.c + 2, 'a': 'I' || x3.a, 'r': ['user:'] || x3.r}),
          least(b[2], {'c': x3.c + 2, 'a': 'I' || x3.a, 'r': ['user:'] || x3.r}), x3,
          least(b[4], {'c': b[3].c + 2, 'a': 'I' || b[3].a, 'r': ['user:'] || b[3].r})]
  FROM (SELECT *, least(b[3], {'c': b[4].c + 2, 'a': 'I' || b[4].a, 'r': ['assistant:'] || b[4].r}) AS x3
        FROM (SELECT c, i, list_transform([1, 2, 3, 4], lambda s: list_min(
                [{'c': v[s].c + 3, 'a': 'D' || v[s].a, 'r': v[s].r}]
                || CASE WHEN fault IN ('blank', 'duplicate') THEN [] ELSE
                   [{'c': v[[3, 3, 4, 3][s]].c + 2 + (fault = 'truncated')::INT, 'a': 'R' || v[[3, 3, 4, 3][s]].a,
                     'r': [['user:', 'user:', 'assistant:', 'user:'][s] || text] || v[[3, 3, 4, 3][s]].r}] END
                || CASE WHEN fault IN ('blank', 'duplicate') OR u = '' OR NOT contains(['su', 'u', 'a', 'u'][s], u) THEN []
                   WHEN u = 's' THEN [{'c': v[2].c + (fault = 'truncated')::INT, 'a': 'K' || v[2].a,
                                       'r': [role || ':' || text] || v[2].r}]
                   ELSE [{'c': v[[3, 3, 4, 3][s]].c + (fault = 'truncated')::INT, 'a': 'K' || v[[3, 3, 4, 3][s]].a,
                          'r': [role || ':' || text] || v[[3, 3, 4, 3][s]].r}] END)) AS b
              FROM edit JOIN judged USING (c, i)))),
best AS (SELECT c, v[1] AS v FROM edit WHERE i = 0)
SELECT conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
       coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(v.c, 0)::BIGINT AS cost,
       coalesce(v.a, '') AS audit, sha256(coalesce(array_to_string(v.r, chr(10)), '')) AS repaired_sha256
FROM convs LEFT JOIN counted USING (c) LEFT JOIN best USING (c)
""")
def op11_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversations.repair(conversations.damaged(read(spark, sf_dir, "conversations")))


@register("op12_jaccard", r"""
WITH RECURSIVE w AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+'), []) AS w FROM documents),
s AS (
  SELECT r, doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')] ELSE
         list_distinct([w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] || ' ' || w[i + 3] FOR i IN range(1, len(w) - 2)]) END AS s
  FROM w),
item AS (SELECT r, unnest(s) AS x FROM s),
pairs AS (SELECT a.r AS a, b.r AS b, count(*) AS c FROM item a JOIN item b ON a.x = b.x AND a.r < b.r GROUP BY ALL),
link AS (
  SELECT a, b FROM pairs JOIN s x ON x.r = a JOIN s y ON y.r = b WHERE 100 * c >= 85 * (len(x.s) + len(y.s) - c)),
sym AS (SELECT a, b FROM link UNION SELECT b, a FROM link),
reach AS (SELECT DISTINCT a, a AS b FROM sym UNION SELECT reach.a, sym.b FROM reach JOIN sym ON sym.a = reach.b),
least AS (SELECT reach.a, min(doc_id) AS id FROM reach JOIN s ON s.r = reach.b GROUP BY reach.a)
SELECT doc_id, len(s)::BIGINT AS n_shingles, CASE WHEN a IS NULL THEN doc_id ELSE id END AS component_id
FROM s LEFT JOIN least ON a = r
""")
def op12_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.near_duplicates(read(spark, sf_dir, "documents"), words=4, percent=85)


@register("op13_ranked", r"""
WITH term AS (
  SELECT row_number() OVER () AS d, doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS t FROM documents),
total AS (SELECT count(*) AS nn, sum(len(t))::BIGINT AS ll FROM term WHERE len(t) > 0),
wanted AS (
  SELECT DISTINCT i, item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS w
  FROM (SELECT *, row_number() OVER () AS i FROM benchmark)),
held AS (
  SELECT d, doc_id, len(t)::BIGINT AS n, w, count(*) AS tf FROM (SELECT d, doc_id, t, unnest(t) AS w FROM term)
  WHERE w IN (SELECT w FROM wanted) GROUP BY ALL),
heavy AS (
  SELECT w, floor(1000 * ln((2 * nn + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS weight FROM held, total GROUP BY w, nn),
part AS (
  SELECT d, doc_id, w, weight * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * nn) // ll))) AS s
  FROM held JOIN heavy USING (w), total),
scored AS (SELECT i, item_id, d, doc_id, sum(s)::BIGINT AS score FROM wanted JOIN part USING (w) GROUP BY ALL),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id NULLS LAST, d) AS rank
  FROM scored WHERE score > 0)
SELECT item_id, rank::INT AS rank, doc_id, score FROM ranked WHERE rank <= 10
""")
def op13_ranked(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked.search(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"), k=10)
