"""The operators applied to their whole tables."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import functions as F

from opsgauge.llm import bpe, chats, hnsw, jaccard, lexical, lines, ngrams, passages, quality, repair, tiling, urls, warc
from opsgauge.llm.registry import query
from opsgauge.llm.workspace import Workspace

OP1_SQL = """
WITH p AS (
  SELECT page_id, url, CAST(strlen(COALESCE(html, '')) AS BIGINT) AS payload_bytes,
         sha256(COALESCE(html, '')) AS payload_digest
  FROM pages
), f AS (
  SELECT *, CASE WHEN payload_bytes >= 100 THEN MIN(page_id) OVER (PARTITION BY payload_digest) ELSE page_id END AS first_id
  FROM p
)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN first_id <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN first_id <> page_id THEN first_id END AS refers_to
FROM f
"""


@query("op1_warc", OP1_SQL)
def op1(spark, read):
    out = warc.archive_round_trip(spark, read("pages"))
    return out.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


OP2_SQL = """
WITH RECURSIVE v AS (
  SELECT vec_id, CASE WHEN embedding IS NULL OR len(embedding) = 0 OR list_count(embedding) < len(embedding)
                        OR len(list_filter(embedding, lambda x: NOT isfinite(x))) > 0
                        OR len(list_filter(embedding, lambda x: x <> 0)) = 0 THEN NULL
                      ELSE CAST(embedding AS DOUBLE[]) END AS e
  FROM embeddings
), n AS (SELECT vec_id, e, sqrt(list_dot_product(e, e)) AS size FROM v WHERE e IS NOT NULL),
p AS (
  SELECT a.vec_id AS a, b.vec_id AS b
  FROM n AS a JOIN n AS b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
  WHERE list_dot_product(a.e, b.e) / (a.size * b.size) >= 0.95
), r AS (SELECT vec_id, vec_id AS reached FROM v UNION SELECT r.vec_id, p.b FROM r JOIN p ON p.a = r.reached),
c AS (SELECT vec_id, MIN(reached) AS component_id FROM r GROUP BY vec_id),
l AS (SELECT a, COUNT(*) AS n FROM p GROUP BY a)
SELECT v.vec_id, COALESCE(l.n, 0) AS n_links, component_id, v.vec_id = component_id AS kept
FROM v JOIN c ON c.vec_id = v.vec_id LEFT JOIN l ON l.a = v.vec_id
"""


@query("op2_embedding_near_dups", OP2_SQL)
def op2(spark, read):
    return hnsw.near_vectors(spark, read("embeddings"))[0]


OP4_SQL = """
WITH t AS (SELECT DISTINCT conv_id, turn, role, text FROM conversations WHERE conv_id IS NOT NULL AND turn IS NOT NULL),
c AS (
  SELECT conv_id, COUNT(*) AS n_turns, list(struct_pack(r := role, x := text) ORDER BY turn, role, text) AS turns,
         string_agg('<|im_start|>' || COALESCE(role, '') || chr(10) || COALESCE(text, '') || '<|im_end|>' || chr(10), ''
                    ORDER BY turn, role, text) AS text
  FROM t GROUP BY conv_id
)
SELECT conv_id, CAST(0 AS BIGINT) AS part, n_turns, text
FROM c
WHERE NOT EXISTS (
  SELECT 1 FROM c AS d
  WHERE d.turns[1] = c.turns[1] AND list_slice(d.turns, 1, c.n_turns) = c.turns
    AND (d.n_turns > c.n_turns OR d.n_turns = c.n_turns AND d.conv_id < c.conv_id)
)
"""


@query("op4_chat_snapshots", OP4_SQL)
def op4(spark, read):
    return chats.collapse_snapshots(read("conversations"))


OP5_SQL = f"""
WITH l AS (
  SELECT doc_id, source, text, unnest(string_split(text, chr(10))) AS line, unnest(range(len(string_split(text, chr(10))))) AS place
  FROM documents
), k AS (SELECT *, trim(line, ' ' || chr(9) || chr(13)) AS key FROM l),
s AS (SELECT source, COALESCE(list_sort(list_distinct(list(key) FILTER (key <> ''))), []) AS keys FROM k GROUP BY doc_id, source),
p AS (SELECT DISTINCT source, keys FROM s),
n AS (SELECT source, COUNT(*) AS pages FROM p GROUP BY source),
o AS (SELECT source, key, COUNT(*) AS pages FROM (SELECT source, unnest(keys) AS key FROM p) GROUP BY source, key),
b AS (SELECT o.source, key FROM o JOIN n ON n.source = o.source WHERE o.pages > 1 AND o.pages > CAST({lines.RATIO} AS DOUBLE) * n.pages)
SELECT doc_id, ANY_VALUE(k.source) AS source, COUNT(*) AS n_lines, COUNT(b.key) AS n_dropped,
       COALESCE(string_agg(line, chr(10) ORDER BY place) FILTER (WHERE b.key IS NULL), '') AS text
FROM k LEFT JOIN b ON b.source = k.source AND b.key = k.key
GROUP BY doc_id
"""


@query("op5_line_dedup", OP5_SQL)
def op5(spark, read):
    out = lines.drop_boilerplate(read("documents"), Workspace(spark, "lines"), counts=("n_lines", "n_dropped"))
    return out.select("doc_id", "source", "n_lines", "n_dropped", "text")


RULES = (
    urls.Rule("allow", "org", "/"),
    urls.Rule("block", "example.org", "/es/"),
    urls.Rule("block", "example.org", "/en/1"),
    urls.Rule("allow", "com", "/fr/"),
    urls.Rule("block", "com", "/de/"),
)


def _fitting(value) -> str:
    longest = sorted(RULES, key=lambda r: -len(r.name))
    cases = " ".join(
        f"WHEN (host = '{r.host}' OR ends_with(host, '.{r.host}')) AND starts_with(path, '{r.path}') THEN '{value(r)}'"
        for r in longest
    )
    return f"CASE {cases} END"


def _order(k: int) -> str:
    """One order of the models in SQL: each class's probability of a gram's last character."""
    parts = []
    for c in ("allow", "block"):
        below = f"l.{c}_p" if k > 1 else f"{1.0 / urls.ALPHABET}"
        parts.append(
            f"CASE WHEN x.{c}_n > 0 THEN (t.{c} + x.{c}_t * {below}) / (x.{c}_n + x.{c}_t) ELSE {below} END AS {c}_p"
        )
    join = f"JOIN p{k - 1} AS l ON l.gram = right(t.gram, {k - 1})" if k > 1 else ""
    sums = ", ".join(f"SUM({c}) AS {c}_n, COUNT(*) FILTER (WHERE {c} > 0) AS {c}_t" for c in ("allow", "block"))
    return f"""
t{k} AS (SELECT right(gram, {k}) AS gram, SUM(allow) AS allow, SUM(block) AS block FROM g GROUP BY 1),
x{k} AS (SELECT left(gram, {k - 1}) AS context, {sums} FROM t{k} GROUP BY 1),
p{k} AS (SELECT t.gram, {", ".join(parts)} FROM t{k} AS t JOIN x{k} AS x ON x.context = left(t.gram, {k - 1}) {join})"""


OP7_SQL = f"""
WITH a AS (
  SELECT page_id, COALESCE(url, '') AS url,
         CASE WHEN position('://' IN url) > 0 THEN substr(url, position('://' IN url) + 3) ELSE '' END AS rest
  FROM pages
), b AS (SELECT *, regexp_extract(rest, '^[^/?#]*') AS raw_host FROM a),
c AS (
  SELECT page_id, url, translate(raw_host, '{urls.UPPER}', '{urls.LOWER}') AS host,
         regexp_extract(substr(rest, length(raw_host) + 1), '^[^?#]*') AS path
  FROM b
), d AS (
  SELECT *, {_fitting(lambda r: r.name)} AS rule, {_fitting(lambda r: r.verdict)} AS said,
         repeat(chr(2), 3) || translate(url, '{urls.UPPER}', '{urls.LOWER}') || chr(3) AS padded
  FROM c
), e AS (SELECT page_id, said, unnest(list_transform(range(1, length(padded) - 2), lambda i: substr(padded, i, 4))) AS gram FROM d),
g AS (SELECT gram, COUNT(*) FILTER (WHERE said = 'allow') AS allow, COUNT(*) FILTER (WHERE said = 'block') AS block FROM e GROUP BY gram),
{",".join(_order(k) for k in range(1, urls.ORDER + 1))},
s AS (
  SELECT e.page_id, ANY_VALUE(e.said) AS said, AVG(ln(p.allow_p) - ln(p.block_p)) AS raw
  FROM e JOIN p{urls.ORDER} AS p ON p.gram = e.gram GROUP BY e.page_id
), m AS (SELECT COALESCE((AVG(raw) FILTER (WHERE said = 'allow') + AVG(raw) FILTER (WHERE said = 'block')) / 2, 0) AS m FROM s)
SELECT d.page_id, host, path, rule,
       COALESCE(d.said, CASE WHEN round(raw - m, 9) >= 0 THEN 'allow' ELSE 'block' END) AS verdict
FROM d JOIN s ON s.page_id = d.page_id CROSS JOIN m
"""


@query("op7_url_filter", OP7_SQL)
def op7(spark, read):
    out = urls.filter_urls(read("pages"), RULES, Workspace(spark, "urls"))
    return out.select("page_id", "host", "path", "rule", "verdict")


@query("op3_quality")
def op3(spark, read):
    out = quality.classify(read("documents"), read("labels"))
    return out.select("doc_id", quality.held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")


OP8_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(COALESCE(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS words
  FROM documents
), s AS (
  SELECT doc_id, list_distinct(list_transform(range(1, greatest(len(words) - 4, 1) + 1), lambda i: array_to_string(words[i:i + 4], ' '))) AS shingles
  FROM w WHERE len(words) > 0
), t AS (SELECT doc_id, len(shingles) AS n, unnest(shingles) AS shingle FROM s),
p AS (
  SELECT a.doc_id AS a, b.doc_id AS b
  FROM t AS a JOIN t AS b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * COUNT(*) >= 80 * (a.n + b.n - COUNT(*))
), r AS (SELECT doc_id, doc_id AS reached FROM documents UNION SELECT r.doc_id, p.b FROM r JOIN p ON p.a = r.reached)
SELECT w.doc_id, CAST(COALESCE(len(s.shingles), 0) AS BIGINT) AS n_shingles, MIN(reached) AS component_id
FROM w LEFT JOIN s ON s.doc_id = w.doc_id JOIN r ON r.doc_id = w.doc_id
GROUP BY w.doc_id, s.shingles
"""


@query("op8_ngram_jaccard", OP8_SQL)
def op8(spark, read):
    return jaccard.components(spark, read("documents"))


VOCABULARY = public_tokenizers.path("word_bpe_49k.json")


@query("op9_bpe")
def op9(spark, read):
    out = bpe.encode_column(read("documents").select("doc_id", "text"), VOCABULARY)
    return out.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join("ids", " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@query("op10_ngram_lm")
def op10(spark, read):
    out = ngrams.score_held_out(spark, read("documents").select("doc_id", "text"), order=ngrams.ORDER)
    return out.select("doc_id", "held_out", *ngrams.SCORES)


@query("op6_decontaminate")
def op6(spark, read):
    return tiling.judged(spark, read("documents"), read("benchmark"))


OP13_SQL = r"""
WITH RECURSIVE n AS (
  SELECT conv_id, turn, COALESCE(role, ' ') AS role, COALESCE(text, ' ') AS text,
         COALESCE(CAST(conv_id AS VARCHAR), ' ') || ':' || COALESCE(CAST(turn AS VARCHAR), ' ') AS name
  FROM conversations
), crc AS (  -- crc32, bit by bit
  SELECT *, 4294967295 - list_reduce(
    list_prepend(CAST(4294967295 AS BIGINT), list_transform(range(1, length(name) + 1), lambda i: CAST(ascii(substr(name, i, 1)) AS BIGINT))),
    lambda c, b: list_reduce(list_prepend(xor(c, b), range(8)), lambda x, i: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END)
  ) AS sum FROM n
), d AS (
  SELECT conv_id, turn, CASE WHEN sum % 20 = 4 THEN 'user' ELSE role END AS role,
         CASE sum % 20 WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
         unnest(range(CASE sum % 20 WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) AS copy
  FROM crc
), o AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, md5(text), copy) AS i,
         regexp_extract(text, '([^\x20\x09-\x0D])[\x20\x09-\x0D]*$', 1) AS tail, left(role, 1) AS ini
  FROM d
), f AS (
  SELECT *, CASE WHEN tail = '' THEN 'blank' WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 'duplicate'
                 WHEN tail NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault,
         lag(ini) OVER (PARTITION BY conv_id ORDER BY i) || ini NOT IN ('su', 'ua', 'au') AS bad
  FROM o
), c AS (
  SELECT n.conv_id, COALESCE(MAX(f.turn) - MIN(f.turn) + 1 - COUNT(DISTINCT f.turn), 0) AS gaps,
         COUNT(*) FILTER (fault = 'blank') AS blank, COUNT(*) FILTER (fault = 'duplicate') AS duplicate,
         COUNT(*) FILTER (fault = 'truncated') AS truncated, COUNT(*) FILTER (bad) AS illegal, COUNT(f.i) AS rows
  FROM (SELECT DISTINCT conv_id FROM conversations) AS n LEFT JOIN f ON f.conv_id IS NOT DISTINCT FROM n.conv_id GROUP BY n.conv_id
), moves(q, more, letters, added, state) AS (  -- insertions before a row, from state to state
  VALUES (0, 0, '', '', 0), (1, 0, '', '', 1), (2, 0, '', '', 2), (3, 0, '', '', 3),
         (0, 5, 'I', 'user:' || chr(10), 2), (1, 5, 'I', 'user:' || chr(10), 2), (2, 5, 'I', 'assistant:' || chr(10), 3),
         (3, 5, 'I', 'user:' || chr(10), 2), (0, 10, 'II', 'user:' || chr(10) || 'assistant:' || chr(10), 3),
         (1, 10, 'II', 'user:' || chr(10) || 'assistant:' || chr(10), 3), (2, 10, 'II', 'assistant:' || chr(10) || 'user:' || chr(10), 2),
         (3, 10, 'II', 'user:' || chr(10) || 'assistant:' || chr(10), 3)
), acts(state, letter, ini, role, after) AS (
  VALUES (0, 'D', '', '', 0), (1, 'D', '', '', 1), (2, 'D', '', '', 2), (3, 'D', '', '', 3),
         (0, 'K', 's', '', 1), (0, 'K', 'u', '', 2), (1, 'K', 'u', '', 2), (3, 'K', 'u', '', 2), (2, 'K', 'a', '', 3),
         (0, 'R', '', 'user', 2), (1, 'R', '', 'user', 2), (3, 'R', '', 'user', 2), (2, 'R', '', 'assistant', 3)
), dp AS (
  SELECT conv_id, CAST(0 AS BIGINT) AS i, 0 AS q, struct_pack(cost := CAST(0 AS BIGINT), audit := '', text := '') AS best FROM c
  UNION ALL
  SELECT dp.conv_id, f.i, acts.after AS q, MIN(struct_pack(
           cost := dp.best.cost + more + CASE letter WHEN 'D' THEN 2 WHEN 'R' THEN 1 ELSE 0 END + CASE WHEN letter <> 'D' AND fault = 'truncated' THEN 5 ELSE 0 END,
           audit := dp.best.audit || letters || letter,
           text := dp.best.text || added || CASE letter WHEN 'D' THEN '' WHEN 'K' THEN f.role || ':' || f.text || chr(10) ELSE acts.role || ':' || f.text || chr(10) END)) AS best
  FROM dp JOIN f ON f.conv_id IS NOT DISTINCT FROM dp.conv_id AND f.i = dp.i + 1
  JOIN moves ON moves.q = dp.q
  JOIN acts ON acts.state = moves.state AND (letter <> 'K' OR acts.ini = f.ini) AND (letter = 'D' OR fault NOT IN ('blank', 'duplicate'))
  GROUP BY dp.conv_id, f.i, acts.after
), e AS (
  SELECT c.conv_id, MIN(struct_pack(cost := dp.best.cost + more, audit := dp.best.audit || letters, text := dp.best.text || added)) AS best
  FROM c JOIN dp ON dp.conv_id IS NOT DISTINCT FROM c.conv_id AND dp.i = c.rows
  JOIN moves ON moves.q = dp.q AND (moves.state = 3 OR moves.state = 0 AND more = 0)
  GROUP BY c.conv_id
)
SELECT c.conv_id, gaps, blank, duplicate, truncated, illegal, best.cost AS cost, best.audit AS audit,
       sha256(left(best.text, greatest(length(best.text) - 1, 0))) AS repaired_sha256
FROM c JOIN e ON e.conv_id IS NOT DISTINCT FROM c.conv_id
"""


@query("op13_conversation_repair", OP13_SQL)
def op13(spark, read):
    return repair.repair_summary(spark, repair.damage(read("conversations")))


OP12_SQL = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(COALESCE(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS words
  FROM documents
), s AS (SELECT COUNT(*) AS N, CAST(SUM(len(words)) AS BIGINT) AS L FROM d WHERE len(words) > 0),
q AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(COALESCE(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                     '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM benchmark
), t AS (SELECT doc_id, len(words) AS n, unnest(words) AS term FROM d),
f AS (SELECT doc_id, n, term, COUNT(*) AS tf FROM t WHERE term IN (SELECT term FROM q) GROUP BY doc_id, n, term),
w AS (SELECT term, CAST(floor(1000 * ln((2 * s.N + 2) / (2 * COUNT(*) + 1))) AS BIGINT) AS w FROM f, s GROUP BY term, s.N),
r AS (
  SELECT q.item_id, f.doc_id, CAST(SUM(w.w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * f.n * s.N) // s.L)))) AS BIGINT) AS score
  FROM q JOIN f ON f.term = q.term JOIN w ON w.term = q.term CROSS JOIN s
  GROUP BY q.item_id, f.doc_id
), o AS (SELECT *, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank FROM r WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM o WHERE rank <= 50
"""


@query("op12_lexical_search", OP12_SQL)
def op12(spark, read):
    return lexical.search(spark, read("documents"), read("benchmark")).select("item_id", "rank", "doc_id", "score")


OP11_SQL = f"""
WITH d AS (SELECT doc_id, hex(COALESCE(text, '')) AS h, CAST(strlen(COALESCE(text, '')) AS BIGINT) AS n FROM documents),
p AS (SELECT doc_id, h, unnest(range(n - {passages.WIDTH - 1})) AS p FROM d),
w AS (SELECT doc_id, p, substr(h, 2 * p + 1, {2 * passages.WIDTH}) AS s FROM p),
r AS (SELECT s, MIN(doc_id) AS first_id FROM w GROUP BY s HAVING MIN(doc_id) < MAX(doc_id)),
m AS (SELECT w.doc_id, w.p FROM w JOIN r ON r.s = w.s WHERE w.doc_id > r.first_id),
i AS (SELECT *, COALESCE(p > lag(p) OVER (PARTITION BY doc_id ORDER BY p) + {passages.WIDTH}, TRUE) AS new FROM m),
j AS (SELECT *, SUM(CAST(new AS INTEGER)) OVER (PARTITION BY doc_id ORDER BY p) AS span FROM i),
x AS (SELECT doc_id, MIN(p) AS a, MAX(p) + {passages.WIDTH} AS b FROM j GROUP BY doc_id, span),
c AS (
  SELECT d.doc_id, h, COALESCE(lag(b) OVER (PARTITION BY d.doc_id ORDER BY a), 0) AS a, x.a AS b FROM d JOIN x ON x.doc_id = d.doc_id
  UNION ALL
  SELECT d.doc_id, ANY_VALUE(h), COALESCE(MAX(b), 0), ANY_VALUE(n) FROM d LEFT JOIN x ON x.doc_id = d.doc_id GROUP BY d.doc_id
), k AS (SELECT doc_id, string_agg(substr(h, CAST(2 * a + 1 AS BIGINT), CAST(2 * (b - a) AS BIGINT)), '' ORDER BY a) AS kept FROM c GROUP BY doc_id),
s AS (SELECT doc_id, CAST(SUM(b - a) AS BIGINT) AS n_removed, COUNT(*) AS n_spans FROM x GROUP BY doc_id)
SELECT d.doc_id, n AS n_bytes, COALESCE(n_removed, 0) AS n_removed, COALESCE(n_spans, 0) AS n_spans, sha256(unhex(kept)) AS kept_sha256
FROM d JOIN k ON k.doc_id = d.doc_id LEFT JOIN s ON s.doc_id = d.doc_id
"""


@query("op11_suffix_array_dedup", OP11_SQL)
def op11(spark, read):
    out = passages.remove_repeats(spark, read("documents"))
    return out.select(
        "doc_id",
        "n_bytes",
        (F.col("n_bytes") - F.octet_length("kept")).alias("n_removed"),
        F.size("starts").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )
