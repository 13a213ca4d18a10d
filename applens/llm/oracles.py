"""DuckDB SQL of the corpus queries that SQL can express, written apart from the operators' code."""

from __future__ import annotations

from applens.llm import decontaminate as dc

EXACT_DEDUP = r"""
WITH d AS (
  SELECT doc_id, length(coalesce(text, '')) AS points,
         sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256
  FROM documents),
g AS (
  SELECT *, first_value(doc_id) OVER (PARTITION BY text_sha256 ORDER BY points DESC, doc_id) AS keep_id,
         count(*) OVER (PARTITION BY text_sha256) AS group_size
  FROM d)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256 FROM g"""

# Every window's hash is counted; bytes are handled as pairs of hex digits.
SUFFIX_DEDUP = """
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, hex(encode(coalesce(text, ''))) AS x FROM documents),
w AS (SELECT rid, i, hash(substr(x, CAST(2 * i + 1 AS BIGINT), 400)) AS h
      FROM (SELECT rid, x, unnest(range(CAST(length(x) // 2 - 199 AS BIGINT))) AS i FROM d WHERE length(x) >= 400)),
again AS (SELECT h FROM w GROUP BY h HAVING count(*) > 1),
hit AS (SELECT rid, i, lag(i) OVER (PARTITION BY rid ORDER BY i) AS before FROM w WHERE h IN (SELECT h FROM again)),
marked AS (SELECT rid, i, sum(CASE WHEN before IS NULL OR i - before > 200 THEN 1 ELSE 0 END)
             OVER (PARTITION BY rid ORDER BY i) AS run FROM hit),
span AS (SELECT rid, run, min(i) AS a, max(i) + 200 AS b FROM marked GROUP BY rid, run),
piece AS (SELECT rid, a, b, lag(b, 1, CAST(0 AS BIGINT)) OVER (PARTITION BY rid ORDER BY a) AS kept_from FROM span),
gone AS (SELECT p.rid, sum(b - a) AS n_removed, count(*) AS n_spans, max(b) AS last_b,
                string_agg(substr(x, 2 * kept_from + 1, 2 * (a - kept_from)), '' ORDER BY a) AS kept
         FROM piece p JOIN d USING (rid) GROUP BY p.rid)
SELECT doc_id, CAST(length(x) // 2 AS BIGINT) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
       CAST(coalesce(n_spans, 0) AS BIGINT) AS n_spans,
       sha256(unhex(coalesce(kept || substr(x, 2 * last_b + 1), x))) AS kept_sha256
FROM d LEFT JOIN gone USING (rid)"""


def _words(column: str) -> str:
    return f"list_filter(string_split_regex(lower(coalesce({column}, '')), '[^\\p{{L}}\\p{{N}}]+'), lambda t: t <> '')"


def _seeds(source: str) -> str:
    picked = [(m, ", ".join(f"w[p + {i}]" for i, bit in enumerate(m) if bit == "1")) for m in dc.MASKS]
    return " UNION ALL ".join(f"SELECT id, p, hash('{m}', {tokens}) AS seed FROM {source} WHERE p + {len(m) - 1} <= len(w)"
                              for m, tokens in picked)


# The best run on a diagonal is the largest rise of a running total over its least value so far.
DECONTAMINATION = f"""
WITH d AS (SELECT row_number() OVER () AS id, doc_id, {_words('text')} AS w FROM documents),
b AS (SELECT row_number() OVER () AS id, item_id, {_words('text')} AS w FROM benchmark),
dp AS (SELECT id, w, unnest(range(1, len(w) + 1)) AS p FROM d),
bp AS (SELECT id, w, unnest(range(1, len(w) + 1)) AS p FROM b),
ds AS ({_seeds('dp')}),
bs AS ({_seeds('bp')}),
place AS (SELECT DISTINCT ds.id AS d, bs.id AS b, ds.p - bs.p AS shift FROM ds JOIN bs USING (seed)),
same AS (SELECT doc_id, item_id, len(b.w) AS n, d.id AS d, b.id AS b, shift, unnest(range(1, len(b.w) + 1)) AS k, d.w AS dw, b.w AS bw
         FROM place JOIN d ON d.id = place.d JOIN b ON b.id = place.b),
agree AS (SELECT doc_id, item_id, n, d, b, shift, k, dw[k + shift] = bw[k] AS ok FROM same WHERE k + shift BETWEEN 1 AND len(dw)),
total AS (SELECT *, sum(CASE WHEN ok THEN 1 ELSE -{dc.MISS_COST} END) OVER o AS s, sum(CASE WHEN ok THEN 1 ELSE 0 END) OVER o AS hits
          FROM agree WINDOW o AS (PARTITION BY d, b, shift ORDER BY k)),
least_so_far AS (SELECT *, least(0, min(s) OVER (PARTITION BY d, b, shift ORDER BY k)) AS low FROM total),
runs AS (SELECT *, s - low AS score, max(CASE WHEN s <= low THEN hits END) OVER (PARTITION BY d, b, shift ORDER BY k) AS hits_before
         FROM least_so_far),
tops AS (SELECT doc_id, item_id, n, d, b, shift, arg_max(hits - coalesce(hits_before, 0), score * 100000 - k) AS n_matched
         FROM runs GROUP BY ALL)
SELECT doc_id, item_id, CAST(max(n_matched) AS INTEGER) AS n_matched FROM tops
WHERE n_matched >= least({dc.MIN_TOKENS}, CAST(ceil(n * {dc.MIN_SHARE}) AS INTEGER)) GROUP BY doc_id, item_id"""

# Every pair of distinct sets with a shingle in common is counted; sets are told apart by the shingles themselves.
NGRAM_JACCARD = r"""
WITH RECURSIVE d AS (
  SELECT row_number() OVER () AS rid, doc_id, list_filter(string_split_regex(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda t: t <> '') AS w
  FROM documents),
s AS (SELECT rid, doc_id, list_sort(list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
        ELSE list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]) END)) AS g FROM d),
k AS (SELECT min(rid) AS k, g, len(g) AS n FROM s WHERE len(g) > 0 GROUP BY g),
e AS (SELECT k, n, unnest(g) AS x FROM k),
p AS (SELECT a.k AS a, b.k AS b FROM e a JOIN e b ON a.x = b.x AND a.k < b.k AND 100 * a.n >= 90 * b.n AND 100 * b.n >= 90 * a.n
      GROUP BY a.k, b.k, a.n, b.n HAVING 100 * count(*) >= 90 * (a.n + b.n - count(*))),
l AS (SELECT a, b FROM p UNION ALL SELECT b, a FROM p),
reach AS (SELECT k AS a, k AS b FROM k UNION SELECT r.a, l.b FROM reach r JOIN l ON r.b = l.a),
least AS (SELECT k.k, min(s.doc_id) AS doc FROM s JOIN k USING (g) GROUP BY k.k),
named AS (SELECT r.a AS k, min(doc) AS component_id FROM reach r JOIN least ON least.k = r.b GROUP BY r.a)
SELECT doc_id, len(s.g) AS n_shingles, CASE WHEN len(s.g) = 0 THEN doc_id ELSE component_id END AS component_id
FROM s LEFT JOIN k USING (g) LEFT JOIN named USING (k)"""



def _crc32(text: str) -> str:
    """CRC-32 of an ASCII string, bit by bit."""
    bits = f"flatten(list_transform(string_split({text}, ''), lambda c: list_transform(range(8), lambda i: CAST((ascii(c) >> i) & 1 AS UBIGINT))))"
    step = "lambda c, b: xor(c >> 1, (xor(c, b) & 1) * CAST(3988292384 AS UBIGINT))"
    return f"xor(list_reduce(list_prepend(CAST(4294967295 AS UBIGINT), {bits}), {step}), CAST(4294967295 AS UBIGINT))"


def _way(state: str, price: str, letter: str) -> str:
    """What an edit makes of the best way to a state: cost in ten digits, then the audit, so that least is cheapest, ties ASCII-least."""
    return f"lpad(CAST(CAST(left({state}, 10) AS BIGINT) + {price} AS VARCHAR), 10, '0') || substr({state}, 11) || '{letter}'"


def _read(to: int) -> str:
    """The best way to state ``to`` (0 nothing, 1 system, 2 user, 3 assistant) once the next row is read."""
    keeps = {0: [], 1: [(0, "s")], 2: [(0, "u"), (1, "u"), (3, "u")], 3: [(2, "a")]}[to]
    writes = {0: [], 1: [], 2: [0, 1, 3], 3: [2]}[to]
    ways = [_way(f"w{to}", "2", "D")]
    ways += [f"CASE WHEN NOT must AND head = '{h}' THEN {_way(f'w{p}', 'extra', 'K')} END" for p, h in keeps]
    ways += [f"CASE WHEN NOT must THEN {_way(f'w{p}', '1 + extra', 'R')} END" for p in writes]
    return f"least({', '.join(ways)}, NULL)" if len(ways) > 1 else ways[0]


# One row at a time, the best way to each state is carried on; least() passes over ways that do not exist.
CONVERSATION_REPAIR = f"""
WITH RECURSIVE c AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
  {_crc32("coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ')")} % 20 AS code FROM conversations),
h AS (SELECT conv_id, turn, CASE WHEN code = 4 THEN 'user' ELSE role END AS role,
        CASE WHEN code = 1 THEN '' WHEN code = 2 THEN translate(text, '.!?', '') ELSE text END AS text,
        unnest(range(CASE WHEN code = 3 THEN 2 ELSE 1 END)) AS _
      FROM c WHERE code <> 0),
r AS (SELECT conv_id, turn, role, text, left(role, 1) AS head, regexp_extract(text, '([^\x20\x09-\x0D])[\x20\x09-\x0D]*$', 1) AS said,
        row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, md5(length(role) || ':' || role || text)) AS i
      FROM h),
s AS (SELECT *, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) AS copy FROM r),
f AS (SELECT *, CASE WHEN said = '' THEN 'blank' WHEN copy > 1 THEN 'duplicate' WHEN said NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault,
        lag(head) OVER (PARTITION BY conv_id ORDER BY i) || head AS pair FROM s),
t AS (SELECT conv_id, CAST(coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS BIGINT) AS gaps,
        count(*) FILTER (WHERE fault = 'blank') AS blank, count(*) FILTER (WHERE fault = 'duplicate') AS duplicate,
        count(*) FILTER (WHERE fault = 'truncated') AS truncated, count(*) FILTER (WHERE pair NOT IN ('su', 'ua', 'au')) AS illegal, count(*) AS n
      FROM f GROUP BY conv_id),
walk AS (
  SELECT conv_id, CAST(0 AS BIGINT) AS i, n, repeat('0', 10) AS w0, CAST(NULL AS VARCHAR) AS w1,
         lpad('5', 10, '0') || 'I' AS w2, lpad('10', 10, '0') || 'II' AS w3 FROM t
  UNION ALL
  SELECT conv_id, i + 1, n, r0, r1, least(r2, i0, i1, i3), least(r3, {_way('least(r2, i0, i1)', '5', 'I')})
  FROM (SELECT *, {_way('r0', '5', 'I')} AS i0, {_way('r1', '5', 'I')} AS i1, {_way('r3', '5', 'I')} AS i3
        FROM (SELECT w.conv_id, w.i, w.n, {_read(0)} AS r0, {_read(1)} AS r1, {_read(2)} AS r2, {_read(3)} AS r3
              FROM walk w JOIN (SELECT conv_id, i AS at, head, fault IN ('blank', 'duplicate') AS must,
                                       CASE WHEN fault = 'truncated' THEN 5 ELSE 0 END AS extra FROM f) f
                ON w.conv_id IS NOT DISTINCT FROM f.conv_id AND f.at = w.i + 1))),
best AS (SELECT conv_id, least(w0, w3) AS way FROM walk WHERE i = n),
edits AS (SELECT conv_id, unnest(range(1, length(way) - 9)) AS k, substr(way, 11) AS audit FROM best),
placed AS (SELECT conv_id, k, substr(audit, k, 1) AS edit, audit, length(replace(substr(audit, 1, k), 'I', '')) AS i,
             length(replace(substr(audit, 1, k), 'D', '')) AS o FROM edits),
led AS (SELECT p.*, f.role, f.text, first_value(CASE WHEN edit = 'K' AND head = 's' THEN 1 ELSE 0 END)
          OVER (PARTITION BY p.conv_id ORDER BY o, k) AS leads
        FROM placed p LEFT JOIN f ON p.conv_id IS NOT DISTINCT FROM f.conv_id AND p.i = f.i WHERE edit <> 'D'),
said AS (SELECT conv_id, string_agg(CASE WHEN edit = 'K' THEN role WHEN (o - leads) % 2 = 1 THEN 'user' ELSE 'assistant' END || ':' ||
                 CASE WHEN edit = 'I' THEN '' ELSE text END, chr(10) ORDER BY o) AS rows FROM led GROUP BY conv_id)
SELECT a.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
       coalesce(illegal, 0) AS illegal, CAST(coalesce(left(way, 10), '0') AS BIGINT) AS cost, coalesce(substr(way, 11), '') AS audit,
       sha256(coalesce(rows, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) a LEFT JOIN t ON t.conv_id IS NOT DISTINCT FROM a.conv_id
LEFT JOIN best ON best.conv_id IS NOT DISTINCT FROM a.conv_id LEFT JOIN said ON said.conv_id IS NOT DISTINCT FROM a.conv_id"""

# Nodes are the lists of turns themselves; every node adds to each of its prefixes.
PREFIX_TRIE = f"""
WITH c AS (SELECT conv_id, {_crc32("CAST(conv_id AS VARCHAR)")} % 6 AS h,
             list({{'r': coalesce(role, ''), 't': coalesce(text, '')}} ORDER BY turn NULLS FIRST,
               md5(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))) AS own
           FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id),
b AS (SELECT c.conv_id, list_concat(CASE WHEN f.own IS NULL THEN [] ELSE f.own[1:CAST(c.h AS BIGINT)] END, c.own[CAST(c.h AS BIGINT) + 1:]) AS turns
      FROM c LEFT JOIN c f ON f.conv_id = c.conv_id - c.conv_id % 100),
m AS (SELECT conv_id, turns, CAST(len(turns) AS BIGINT) AS l, unnest(range(0, len(turns) + 1)) AS depth FROM b),
p AS (SELECT conv_id, l, depth, turns[1:depth] AS node, CASE WHEN depth = 0 THEN 0 ELSE length(turns[depth].t) END AS points FROM m),
n AS (SELECT node, depth, min(conv_id) AS conv_id, count(*) AS n_convs, (count(*) - 1) * max(points) AS saved,
        string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (WHERE l = depth) AS ends
      FROM p GROUP BY node, depth),
k AS (SELECT node[1:depth - 1] AS node, depth - 1 AS depth, count(*) AS n_children FROM n WHERE depth > 0 GROUP BY 1, 2),
w AS (SELECT n.*, coalesce(n_children, 0) AS n_children FROM n LEFT JOIN k USING (node, depth)),
u AS (SELECT node, saved, n_children, unnest(range(0, depth + 1)) AS up_to FROM w),
s AS (SELECT node[1:up_to] AS node, up_to AS depth, sum(saved) AS saved_tokens, count(*) FILTER (WHERE n_children = 0) AS n_leaves FROM u GROUP BY 1, 2)
SELECT w.conv_id, w.depth, up.conv_id AS parent_conv_id, w.n_convs, CAST(w.n_children AS BIGINT) AS n_children, n_leaves,
       CAST(saved_tokens AS BIGINT) AS saved_tokens, sha256(coalesce(w.ends, '')) AS ends_sha256
FROM w JOIN s USING (node, depth) LEFT JOIN w up ON up.depth = w.depth - 1 AND up.node = w.node[1:w.depth - 1]"""

ORACLES = {
    "op3_decontamination": DECONTAMINATION,
    "op4_suffix_dedup": SUFFIX_DEDUP,
    "op8_exact_dedup": EXACT_DEDUP,
    "op11_ngram_jaccard": NGRAM_JACCARD,
    "op12_conversation_repair": CONVERSATION_REPAIR,
    "op13_prefix_trie": PREFIX_TRIE,
}
