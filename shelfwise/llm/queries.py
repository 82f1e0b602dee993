"""Registered queries of the operators, over whole tables, and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise.llm import (
    chat, decontaminate, exactdedup, licenses, linedup, minhash, pieces, pii, quality, secretscan, turnrepair, urlfilter,
    whitening,
)

#: Place of the vocabulary; a parameter of the operator.
PIECES = "/opt/tokenizers/piece_bpe_32k.model"
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(f):
    QUERIES[f.__name__] = f
    return f


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


@query
def op5_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return exactdedup.exact_duplicates(_table(spark, folder, "documents"))


ORACLE["op5_exact_dedup"] = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t,
                  regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS body FROM documents)
SELECT doc_id, first_value(doc_id) OVER (PARTITION BY body ORDER BY length(t) DESC, doc_id) AS keep_id,
       count(*) OVER (PARTITION BY body) AS group_size,
       doc_id = first_value(doc_id) OVER (PARTITION BY body ORDER BY length(t) DESC, doc_id) AS kept,
       sha256(body) AS text_sha256
FROM d
"""

@query
def op4_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    return decontaminate.contamination(_table(spark, folder, "documents"), _table(spark, folder, "benchmark"))


ORACLE["op4_decontaminate"] = r"""
WITH iw AS (SELECT item_id::VARCHAR AS id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                   'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
            FROM benchmark),
win AS (SELECT DISTINCT id, array_to_string(list_slice(w, i, i + 9), ' ') AS win, least(len(w), 10) AS n
        FROM (SELECT id, w, unnest(generate_series(1, greatest(1, len(w) - 9))) AS i FROM iw WHERE len(w) > 0)),
dw AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
              'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
pos AS (SELECT doc_id, n, i, array_to_string(list_slice(w, i, i + n - 1), ' ') AS win
        FROM (SELECT doc_id, w, n, unnest(generate_series(1, len(w) - n + 1)) AS i
              FROM dw, (SELECT DISTINCT n FROM win) WHERE len(w) >= n)),
hit AS (SELECT p.doc_id, p.i, p.n, w.id FROM pos p JOIN win w ON p.win = w.win AND p.n = w.n),
word AS (SELECT doc_id, count(DISTINCT k) AS n_hit
         FROM (SELECT doc_id, unnest(generate_series(i, i + n - 1)) AS k FROM hit) GROUP BY 1),
items AS (SELECT doc_id, count(DISTINCT id) AS n_items, string_agg(DISTINCT id, ',' ORDER BY id) AS ids
          FROM hit GROUP BY 1)
SELECT d.doc_id, len(d.w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM dw d LEFT JOIN word USING (doc_id) LEFT JOIN items USING (doc_id)
"""

#: The rules of the URL query.
URL_RULES = """
VALUES ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'),
       ('net', '/es/', 'block'), ('net', '/fr/', 'block') AS r(host, path, verdict)
"""


@query
def op8_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    return urlfilter.judge(_table(spark, folder, "pages"), spark.sql(f"SELECT * FROM {URL_RULES}"))


ORACLE["op8_url_filter"] = r"""
WITH u AS (SELECT page_id, CASE WHEN contains(url, '://') THEN regexp_extract(substr(url, instr(url, '://') + 3),
                  '^[^?#]*', 0, 's') ELSE '' END AS rest FROM pages),
p AS (SELECT row_number() OVER () AS n, page_id, translate(split_part(rest, '/', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
             'abcdefghijklmnopqrstuvwxyz') AS host, substr(rest, length(split_part(rest, '/', 1)) + 1) AS path FROM u),
r AS (SELECT * FROM (VALUES ('com', '/', 'allow'), ('example.com', '/en/', 'block'),
      ('www.example.com', '/en/', 'allow'), ('net', '/es/', 'block'), ('net', '/fr/', 'block')) AS r(h, q, verdict)),
m AS (SELECT p.n, p.page_id, p.host, p.path, r.h || r.q AS rule, r.verdict,
             row_number() OVER (PARTITION BY p.n ORDER BY length(r.h || r.q) DESC NULLS LAST) AS k
      FROM p LEFT JOIN r ON (p.host = r.h OR ends_with(p.host, '.' || r.h)) AND starts_with(p.path, r.q))
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM m WHERE k = 1
"""


@query
def op10_minhash_neardup(spark: SparkSession, folder: str) -> DataFrame:
    return minhash.near_duplicates(_table(spark, folder, "documents"), size=4, percent=80)


ORACLE["op10_minhash_neardup"] = r"""
WITH RECURSIVE t AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                     'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(list_slice(w, i, i + 3), ' ') AS sh
      FROM (SELECT doc_id, w, unnest(generate_series(1, greatest(1, len(w) - 3))) AS i FROM t WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
c AS (SELECT a.doc_id AS u, b.doc_id AS v, count(*) AS k FROM s a JOIN s b ON a.sh = b.sh AND a.doc_id < b.doc_id
      GROUP BY 1, 2),
l AS (SELECT u, v FROM c JOIN n x ON x.doc_id = u JOIN n y ON y.doc_id = v WHERE 100 * k >= 80 * (x.n + y.n - k)),
e AS (SELECT u, v FROM l UNION ALL SELECT v, u FROM l),
reach AS (SELECT u AS doc_id, v AS other FROM e UNION SELECT r.doc_id, e.v FROM reach r JOIN e ON r.other = e.u),
least_ AS (SELECT doc_id, min(other) AS m FROM reach GROUP BY 1)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, least(d.doc_id, coalesce(m, d.doc_id)) AS component_id,
       d.doc_id = least(d.doc_id, coalesce(m, d.doc_id)) AS kept
FROM documents d LEFT JOIN n USING (doc_id) LEFT JOIN least_ USING (doc_id)
"""


@query
def op6_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return linedup.line_report(_table(spark, folder, "documents"))


ORACLE["op6_line_dedup"] = r"""
WITH RECURSIVE l AS (SELECT doc_id, i - 1 AS pos, ls[i] AS line, md5(ls[i]) AS h,
                  len(regexp_extract_all(ls[i], '[^ \t\n\x0B\f\r]+')) AS w
           FROM (SELECT doc_id, string_split(text, chr(10)) AS ls,
                        unnest(generate_series(1, len(string_split(text, chr(10))))) AS i FROM documents)),
s AS (SELECT *, coalesce(sum(w) OVER before, 0)::BIGINT AS start, sum(w) OVER (PARTITION BY doc_id) AS total,
             coalesce(sum((w > 0)::INT) OVER before, 0)::BIGINT AS place FROM l
      WINDOW before AS (PARTITION BY doc_id ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
blank AS (SELECT doc_id, place, md5(string_agg(h, '.' ORDER BY pos)) AS blank FROM s WHERE w = 0 GROUP BY 1, 2),
worded AS (SELECT s.*, coalesce(blank, '') AS blank FROM s LEFT JOIN blank USING (doc_id, place) WHERE w > 0),
g AS (SELECT doc_id, pos, start, total, list({'blank': blank, 'h': h}) OVER r AS run, max(pos) OVER r - pos + 1 AS lines FROM worded
      WINDOW r AS (PARTITION BY doc_id ORDER BY start RANGE BETWEEN CURRENT ROW AND 39 FOLLOWING)),
gs AS (SELECT doc_id, pos, start, total, lines, md5(array_to_string(list_transform(run, lambda x, i:
              CASE WHEN i = 1 THEN x.h ELSE x.blank || ',' || x.h END), ';')) AS gram FROM g),
m AS (SELECT doc_id, start, total, min({'gram': gram, 'pos': pos, 'lines': lines}) OVER (
             PARTITION BY doc_id ORDER BY start RANGE BETWEEN CURRENT ROW AND 10 FOLLOWING) AS f FROM gs),
f AS (SELECT DISTINCT doc_id, f.gram AS gram, f.pos AS pos, f.lines AS lines FROM m WHERE total - start >= 50),
o AS (SELECT *, min({'d': doc_id, 'p': pos}) OVER (PARTITION BY gram) AS first FROM f),
p AS (SELECT doc_id, pos, lines, first.d AS doc0, first.p AS pos0 FROM o WHERE doc_id <> first.d OR pos <> first.p),
lefts AS (SELECT doc_id, pos, doc0, pos0, 0 AS n FROM p
  UNION ALL SELECT e.doc_id, e.pos, doc0, pos0, n + 1 FROM lefts e JOIN s a ON a.doc_id = e.doc_id AND a.pos = e.pos - n - 1
  JOIN s b ON b.doc_id = doc0 AND b.pos = pos0 - n - 1 AND a.h = b.h),
rights AS (SELECT doc_id, pos, lines, doc0, pos0, 0 AS n FROM p
  UNION ALL SELECT e.doc_id, e.pos, lines, doc0, pos0, n + 1 FROM rights e JOIN s a ON a.doc_id = e.doc_id AND a.pos = e.pos + lines + n
  JOIN s b ON b.doc_id = doc0 AND b.pos = pos0 + lines + n AND a.h = b.h),
lf AS (SELECT doc_id, pos, max(n) AS n FROM lefts GROUP BY 1, 2),
rt AS (SELECT doc_id, pos, max(n) AS n FROM rights GROUP BY 1, 2),
gone AS (SELECT DISTINCT p.doc_id, unnest(generate_series(p.pos - lf.n, p.pos + lines - 1 + rt.n)) AS pos
         FROM p JOIN lf USING (doc_id, pos) JOIN rt USING (doc_id, pos)),
isl AS (SELECT doc_id, pos, pos - row_number() OVER (PARTITION BY doc_id ORDER BY pos) AS island FROM gone),
runs AS (SELECT doc_id, min(pos) AS a, max(pos) AS b FROM isl GROUP BY doc_id, island),
rem AS (SELECT doc_id, string_agg(a || '-' || b, ',' ORDER BY a) AS removed, sum(b - a + 1) AS n FROM runs GROUP BY 1),
kept AS (SELECT doc_id, string_agg(line, chr(10) ORDER BY pos) AS text
         FROM l ANTI JOIN gone USING (doc_id, pos) GROUP BY 1)
SELECT d.doc_id, len(string_split(d.text, chr(10))) AS n_lines, coalesce(rem.n, 0)::BIGINT AS n_removed,
       coalesce(removed, '') AS removed, sha256(coalesce(kept.text, '')) AS text_sha256
FROM documents d LEFT JOIN rem USING (doc_id) LEFT JOIN kept USING (doc_id)
"""


@query
def op3_quality(spark: SparkSession, folder: str) -> DataFrame:
    return quality.quality_scores(_table(spark, folder, "documents"), _table(spark, folder, "labels"))


@query
def op1_pieces(spark: SparkSession, folder: str) -> DataFrame:
    return pieces.encode(_table(spark, folder, "documents"), PIECES)


@query
def op2_preference_chat(spark: SparkSession, folder: str) -> DataFrame:
    turns = _table(spark, folder, "conversations").select(F.col("conv_id").alias("pair_id"), "turn", "role", "text")
    found = chat.preference_rows(turns, chat.with_stale_reply(turns, "pair_id"))
    return found.select("pair_id", "n_prefix", "prompt", "chosen", "rejected",
                        chat.spans_text("chosen_mask").alias("chosen_mask"),
                        chat.spans_text("rejected_mask").alias("rejected_mask"))


def _chat_side(side: str) -> str:
    """SQL of one side's completion and mask."""
    piece = f"'<|' || role || '|>' || chr(10) || {side} || '<|end|>' || chr(10)"
    return f"""(SELECT pair_id, coalesce(string_agg(p, '' ORDER BY pos), '') AS body,
        coalesce(string_agg(CASE WHEN role = 'assistant' THEN (off + length(role) + 5) || '-' || (off + length(p) - 1) END,
                            ',' ORDER BY pos), '') AS mask
    FROM (SELECT *, coalesce(sum(length(p)) OVER (PARTITION BY pair_id ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING
                 AND 1 PRECEDING), 0)::BIGINT AS off FROM (SELECT pair_id, pos, role, {piece} AS p FROM s WHERE pos > n))
    GROUP BY pair_id)"""


ORACLE["op2_preference_chat"] = f"""
WITH t AS (SELECT conv_id AS pair_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS pos,
                  role, replace(text, '<|', '< |') AS good FROM conversations),
a AS (SELECT *, max(CASE WHEN role = 'assistant' THEN pos END) OVER (PARTITION BY pair_id) AS final,
             row_number() OVER (PARTITION BY pair_id, role ORDER BY pos) AS k FROM t),
b AS (SELECT a.*, CASE WHEN a.pos = a.final THEN coalesce(o.good, '') ELSE a.good END AS bad
      FROM a LEFT JOIN a o ON o.pair_id = a.pair_id AND o.role = 'assistant' AND a.role = 'assistant' AND o.k = a.k - 1),
s AS (SELECT b.*, coalesce(min(CASE WHEN good <> bad THEN pos END) OVER (PARTITION BY pair_id) - 1,
                           max(pos) OVER (PARTITION BY pair_id)) AS n FROM b),
p AS (SELECT pair_id, max(n) AS n_prefix, coalesce(string_agg(CASE WHEN pos <= n THEN '<|' || role || '|>' || chr(10)
             || good || '<|end|>' || chr(10) END, '' ORDER BY pos), '') AS prompt FROM s GROUP BY 1)
SELECT p.pair_id, n_prefix, prompt, coalesce(c.body, '') AS chosen, coalesce(r.body, '') AS rejected,
       coalesce(c.mask, '') AS chosen_mask, coalesce(r.mask, '') AS rejected_mask
FROM p LEFT JOIN {_chat_side("good")} c USING (pair_id) LEFT JOIN {_chat_side("bad")} r USING (pair_id)
"""


@query
def op7_personal_data(spark: SparkSession, folder: str) -> DataFrame:
    return pii.personal_data(_table(spark, folder, "documents"))


@query
def op9_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    return licenses.license_notices(_table(spark, folder, "documents"))


@query
def op11_turn_repair(spark: SparkSession, folder: str) -> DataFrame:
    return turnrepair.repair_report(turnrepair.damaged(_table(spark, folder, "conversations")), gone="gone")


ORACLE["op11_turn_repair"] = r"""
WITH RECURSIVE bits AS (SELECT i, i AS c, 0 AS k FROM (SELECT unnest(generate_series(0, 255))::BIGINT AS i) UNION ALL
    SELECT i, CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END, k + 1 FROM bits WHERE k < 8),
tab AS (SELECT list(c ORDER BY i) AS t FROM bits WHERE k = 8),
keyed AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
                 coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS key FROM conversations),
kinds AS (SELECT conv_id, turn, role, text, xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(
                 string_split(key, ''), lambda ch: ord(ch)::BIGINT)),
                 lambda c, b: xor(c // 256, t[(xor(c, b) % 256) + 1])), 4294967295) % 20 AS kind FROM keyed, tab),
hurt AS (SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role, CASE kind WHEN 1 THEN ''
                WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
                unnest(CASE WHEN kind = 3 THEN [0, 1] ELSE [0] END) AS copy FROM kinds WHERE kind <> 0),
placed AS (SELECT *, substr(role, 1, 1) AS init, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role,
                  substr(text, 1, 64), sha256(length(role) || ':' || role || text), copy) AS pos FROM hurt),
judged AS (SELECT *, CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 'blank'
                  WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY pos) > 1 THEN 'duplicate'
                  WHEN right(rtrim(text, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 1)
                       NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault,
                  init <> '' AND lag(init) OVER w || init IN ('su', 'ua', 'au') AS fine, lag(pos) OVER w AS prior
           FROM placed WINDOW w AS (PARTITION BY conv_id ORDER BY pos)),
stats AS (SELECT conv_id, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
                 count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
                 count(*) FILTER (fault = 'truncated') AS truncated,
                 count(*) FILTER (prior IS NOT NULL AND NOT fine) AS illegal FROM judged GROUP BY conv_id),
given AS (SELECT * FROM (VALUES (0, 'u', 2), (1, 'u', 2), (2, 'a', 3), (3, 'u', 2), (0, 's', 1)) AS g(p, role, q)),
step AS (SELECT p, 'D' AS op, NULL AS init, p AS q, 2 AS cost FROM (SELECT unnest([0, 1, 2, 3]) AS p) UNION ALL
         SELECT p, 'K', role, q, 0 FROM given UNION ALL SELECT p, 'R', NULL, q, 1 FROM given WHERE role <> 's'),
added AS (SELECT * FROM (VALUES (0, 0, 0, ''), (0, 2, 5, 'I'), (0, 3, 10, 'II'), (1, 1, 0, ''), (1, 2, 5, 'I'), (1, 3, 10, 'II'),
          (2, 2, 0, ''), (2, 3, 5, 'I'), (3, 3, 0, ''), (3, 2, 5, 'I')) AS c(p, q, cost, ops)),
every AS (SELECT DISTINCT conv_id FROM conversations),
best AS (SELECT conv_id, 0::BIGINT AS pos, q AS state, {'cost': cost::BIGINT, 'audit': ops} AS way FROM every, added WHERE p = 0
  UNION ALL
  SELECT b.conv_id, j.pos, a.q, min({'cost': b.way.cost + s.cost + a.cost
             + CASE WHEN j.fault = 'truncated' AND s.op <> 'D' THEN 5 ELSE 0 END, 'audit': b.way.audit || s.op || a.ops})
  FROM best b JOIN judged j ON j.conv_id IS NOT DISTINCT FROM b.conv_id AND j.pos = b.pos + 1
  JOIN step s ON s.p = b.state AND (s.init IS NULL OR s.init = j.init)
             AND (s.op = 'D' OR j.fault NOT IN ('blank', 'duplicate'))
  JOIN added a ON a.p = s.q GROUP BY b.conv_id, j.pos, a.q),
final AS (SELECT b.conv_id, min(way) AS way FROM best b LEFT JOIN stats t ON t.conv_id IS NOT DISTINCT FROM b.conv_id
          WHERE b.pos = coalesce(t.n, 0) AND state IN (0, 3) GROUP BY b.conv_id),
chars AS (SELECT conv_id, i, substr(way.audit, i, 1) AS op,
                 length(replace(substr(way.audit, 1, i), 'I', '')) AS pos,
                 length(replace(substr(way.audit, i + 1), 'D', '')) AS later
          FROM (SELECT conv_id, way, unnest(generate_series(1, length(way.audit))) AS i FROM final)),
lines AS (SELECT c.conv_id, string_agg(CASE WHEN op = 'K' THEN j.role WHEN later % 2 = 0 THEN 'assistant' ELSE 'user' END
                 || ':' || CASE WHEN op = 'I' THEN '' ELSE j.text END, chr(10) ORDER BY i) AS body
          FROM chars c LEFT JOIN judged j ON j.conv_id IS NOT DISTINCT FROM c.conv_id AND j.pos = c.pos
          WHERE op <> 'D' GROUP BY c.conv_id)
SELECT f.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
       coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, way.cost AS cost, way.audit AS audit,
       sha256(coalesce(body, '')) AS repaired_sha256
FROM final f LEFT JOIN stats s ON s.conv_id IS NOT DISTINCT FROM f.conv_id
LEFT JOIN lines l ON l.conv_id IS NOT DISTINCT FROM f.conv_id
"""


@query
def op12_whitening(spark: SparkSession, folder: str) -> DataFrame:
    return whitening.whiten(_table(spark, folder, "embeddings"))


@query
def op13_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    return secretscan.secret_report(_table(spark, folder, "documents"))
