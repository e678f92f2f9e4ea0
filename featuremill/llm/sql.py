"""DuckDB SQL with the results of the queries that SQL can express."""

from __future__ import annotations

import re

from featuremill.llm import chat, quality_rules, secrets


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def secret_scan() -> str:
    """Positions from the running lengths of the parts between the matches."""
    parts = []
    for rank, r in enumerate(secrets.RULES):
        p = _quoted(r.pattern)
        parts.append(f"""
SELECT r, '{r.kind}' AS kind, {rank} AS rank, i, length(sep[i]) AS gap, length(m[i]) AS size,
       length(g[i]) >= {r.least} AS counts
FROM (SELECT r, sep, m, g, unnest(range(1, len(m) + 1)) AS i
      FROM (SELECT r, string_split_regex(t, {p}) AS sep, regexp_extract_all(t, {p}) AS m,
                   regexp_extract_all(t, {p}, {r.group}) AS g FROM d))""")
    return f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
hits AS ({' UNION ALL '.join(parts)}),
placed AS (SELECT *, CAST(sum(gap + size) OVER (PARTITION BY r, kind ORDER BY i) AS BIGINT) AS e FROM hits),
good AS (SELECT *, e - size AS s, kind || ':' || CAST(e - size AS VARCHAR) || ':' || CAST(e AS VARCHAR) AS told
         FROM placed WHERE counts),
per AS (SELECT r, count(*) FILTER (rank = 0) AS a, count(*) FILTER (rank = 1) AS b, count(*) FILTER (rank = 2) AS c,
               string_agg(told, ',' ORDER BY s, rank) FILTER (rank < 3) AS base,
               string_agg(told, ',' ORDER BY s, rank) AS spans FROM good GROUP BY r)
SELECT doc_id, coalesce(a, 0) AS n_assign, coalesce(b, 0) AS n_access, coalesce(c, 0) AS n_hex,
       sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN per USING (r)"""


def repetition_coverage() -> str:
    """Word positions under repeated n-grams, counted per n by window functions."""
    word = r"[^\x20\x09-\x0D]+"
    grams, covers, shares = [], [], []
    for n in quality_rules.LIMITS:
        grams.append(f"CASE WHEN i + {n - 1} <= nw THEN w[i:i + {n - 1}] END AS g{n}")
        covers.append(f"max(CASE WHEN g{n} IS NOT NULL AND c{n} > 1 THEN 1 ELSE 0 END) OVER "
                      f"(PARTITION BY r ORDER BY i ROWS {n - 1} PRECEDING) AS v{n}")
        shares.append(f"coalesce(sum(sz) FILTER (v{n} = 1), 0) / nullif(max(wc), 0)::DOUBLE AS s{n}")
    counts = ", ".join(f"count(*) OVER (PARTITION BY r, g{n}) AS c{n}" for n in quality_rules.LIMITS)
    limits = " AND ".join(f"coalesce(s{n}, 0) <= {m}" for n, m in quality_rules.LIMITS.items())
    out = ", ".join(f"coalesce(s{n}, 0) AS coverage_{n}" for n in quality_rules.LIMITS)
    return f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT *, regexp_extract_all(t, '{word}') AS w FROM d),
base AS (SELECT r, doc_id, t, w, len(w) AS nw,
                CAST(coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) AS BIGINT) AS wc,
                CAST(length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols
         FROM w),
lines AS (SELECT r, line, count(*) AS n,
                 coalesce(list_sum(list_transform(regexp_extract_all(line, '{word}'), lambda x: length(x))), 0) AS lc
          FROM (SELECT r, unnest(string_split(t, chr(10))) AS line FROM d)
          WHERE regexp_matches(line, '{word}') GROUP BY r, line),
dup AS (SELECT r, CAST(sum(n - 1) AS BIGINT) AS n_dup_lines, sum(n * lc) FILTER (n > 1) AS lc FROM lines GROUP BY r),
often AS (SELECT r, max(n * length(word)) AS tc
          FROM (SELECT r, word, count(*) AS n FROM (SELECT r, unnest(w) AS word FROM base) GROUP BY r, word)
          WHERE n >= {quality_rules.WORD_TIMES} GROUP BY r),
pos AS (SELECT r, nw, w, wc, unnest(range(1, nw + 1)) AS i FROM base),
g AS (SELECT r, i, wc, length(w[i]) AS sz, {', '.join(grams)} FROM pos),
c AS (SELECT *, {counts} FROM g),
v AS (SELECT r, i, wc, sz, {', '.join(covers)} FROM c),
s AS (SELECT r, CAST(coalesce(sum(v5), 0) AS BIGINT) AS n_repeat, {', '.join(shares)} FROM v GROUP BY r),
a AS (SELECT doc_id, nw AS n_words, wc AS word_chars, n_symbols, coalesce(n_dup_lines, 0) AS n_dup_lines,
             coalesce(n_repeat, 0) AS n_repeat_words,
             nw < 10 OR 100 * coalesce(n_repeat, 0) > 20 * nw AS base_failed,
             CASE WHEN wc > 0 THEN coalesce(lc, 0) / wc::DOUBLE ELSE 0 END AS line_coverage,
             CASE WHEN wc > 0 THEN coalesce(tc, 0) / wc::DOUBLE ELSE 0 END AS word_coverage, s.*
      FROM base LEFT JOIN s USING (r) LEFT JOIN dup USING (r) LEFT JOIN often USING (r))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND line_coverage <= {quality_rules.LINE_LIMIT}
         AND word_coverage <= {quality_rules.WORD_LIMIT} AND {limits} AS kept,
       line_coverage, word_coverage, {out}
FROM a"""


def chat_format() -> str:
    t = chat.Template()
    escaped = "x"
    for head in sorted({c[0] for c in t.controls}):  # control strings never overlap
        tails = "|".join(re.escape(c[1:]) for c in t.controls if c[0] == head)
        escaped = f"regexp_replace({escaped}, '({re.escape(head)})(\\\\*)({tails})', '\\1\\2\\\\\\3', 'g')"
    around = " ".join(f"WHEN '{r}' THEN {len(a) + len(b)}" for r, (a, b, _) in t.roles.items())
    extra = sum(map(len, t.other))
    allowed = " OR ".join(f"(coalesce(before, 'start') = '{s}' AND role = '{r}')"
                          for s, own in t.turns.items() for r in own)
    return f"""
WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS x FROM conversations
           UNION ALL SELECT -7, unnest([0, 1]), unnest(['user', 'assistant']), '</s>[INST] ok [/INST]'),
o AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn, role, x) AS i,
             lag(role) OVER (PARTITION BY conv_id ORDER BY turn, role, x) AS before,
             lead(role) OVER (PARTITION BY conv_id ORDER BY turn, role, x) AS after FROM c)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || x || chr(10), '' ORDER BY i)) AS turns_sha256,
       CAST(coalesce(sum(length(x)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(x, '' ORDER BY i) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(length({escaped}) + CASE role {around} ELSE length(role) + {extra} END) AS BIGINT) AS formatted_chars,
       bool_and({allowed}) AND max(CASE WHEN after IS NULL THEN role END) = 'assistant' AS valid
FROM o GROUP BY conv_id"""


def turn_repair() -> str:
    """The damage, then all edits by a recursion over the turns of every conversation, which carries the
    cheapest (cost, audit) for each kind of what has been written last."""
    seen = r"[^\x20\x09-\x0D]"
    kind = "STRUCT(c BIGINT, a VARCHAR)"

    def plus(state: str, cost, sign: str) -> str:
        return f"CASE WHEN {state} IS NOT NULL THEN {{'c': {state}.c + {cost}, 'a': {state}.a || {sign}}}::{kind} END"

    def best(*of: str) -> str:
        return f"least({', '.join(of)})"

    insert_u = best("nu", *(plus(x, 5, "'I'") for x in ("n0", "ns", "na")))
    kept_u = (f"{{0}} + CASE WHEN initial = 'u' THEN 0 ELSE 1 END", "CASE WHEN initial = 'u' THEN 'K' ELSE 'R' END")
    kept_a = (f"{{0}} + CASE WHEN initial = 'a' THEN 0 ELSE 1 END", "CASE WHEN initial = 'a' THEN 'K' ELSE 'R' END")
    more = "(CASE WHEN cut THEN 5 ELSE 0 END)"

    def unless_gone(state: str, cost: str, sign: str, also: str = "true") -> str:
        return f"CASE WHEN NOT gone AND {also} THEN {plus(state, cost, sign)} END"

    next_u = best(plus("iu", 2, "'D'"), *(unless_gone(x, kept_u[0].format(more), kept_u[1]) for x in ("n0", "ns", "ia")))
    next_a = best(plus("ia", 2, "'D'"), unless_gone("iu", kept_a[0].format(more), kept_a[1]))
    next_s = best(plus("ns", 2, "'D'"), unless_gone("n0", more, "'K'", "initial = 's'"))
    byte_step = ("list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[], "
                 "lambda x, z: xor(x >> 1, (x & 1) * 3988292384))")
    crc = (f"xor(list_reduce([4294967295::BIGINT] || list_transform(range(1, length(s) + 1), lambda i: ord(s[i])::BIGINT), "
           f"lambda c, b: {byte_step}), 4294967295)")
    return f"""
WITH RECURSIVE src AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS s FROM conversations),
f AS (SELECT *, {crc} % 20 AS fault FROM src),
d AS (SELECT conv_id, turn, CASE WHEN fault = 4 THEN 'user' ELSE role END AS role,
             CASE fault WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
             unnest(range(CASE WHEN fault = 3 THEN 2 ELSE 1 END)) AS copy FROM f WHERE fault <> 0),
o AS (SELECT *, left(role, 1) AS initial,
             row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(text), copy) AS i,
             row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) AS times,
             lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(text), copy) AS before,
             NOT regexp_matches(text, '{seen}') AS blank,
             NOT regexp_matches(text, '[.!?][\\x20\\x09-\\x0D]*$') AS open_end FROM d),
t AS (SELECT *, blank OR times > 1 AS gone, NOT blank AND times = 1 AND open_end AS cut FROM o),
w AS (SELECT conv_id, CAST(0 AS BIGINT) AS i, {{'c': 0, 'a': ''}}::{kind} AS n0, CAST(NULL AS {kind}) AS ns,
             CAST(NULL AS {kind}) AS nu, CAST(NULL AS {kind}) AS na FROM t GROUP BY conv_id
      UNION ALL
      SELECT conv_id, i, {plus('n0', 2, "'D'")}, {next_s}, {next_u}, {next_a}
      FROM (SELECT *, {best('na', plus('iu', 5, "'I'"))} AS ia
            FROM (SELECT t.conv_id, t.i, initial, gone, cut, n0, ns, na, {insert_u} AS iu
                  FROM w JOIN t ON w.conv_id IS NOT DISTINCT FROM t.conv_id AND t.i = w.i + 1))),
facts AS (SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
                 count(*) FILTER (blank) AS blank, count(*) FILTER (NOT blank AND times > 1) AS duplicate,
                 count(*) FILTER (cut) AS truncated,
                 count(*) FILTER (before || initial NOT IN ('su', 'ua', 'au')) AS illegal, count(*) AS n FROM t GROUP BY conv_id),
done AS (SELECT w.conv_id, {best('n0', 'na', plus(f'({insert_u})', 5, "'I'"))} AS found
         FROM w JOIN facts ON w.conv_id IS NOT DISTINCT FROM facts.conv_id AND w.i = facts.n),
steps AS (SELECT conv_id, found.a AS audit, unnest(range(1, length(found.a) + 1)) AS k FROM done),
acts AS (SELECT conv_id, k, audit[k] AS sign,
                count(*) FILTER (audit[k] <> 'I') OVER (PARTITION BY conv_id ORDER BY k) AS i,
                count(*) FILTER (audit[k] <> 'D') OVER (PARTITION BY conv_id ORDER BY k) AS place FROM steps),
wrote AS (SELECT a.conv_id, sign, place, t.role, CASE WHEN sign = 'I' THEN '' ELSE t.text END AS text,
                 max(CASE WHEN place = 1 AND sign = 'K' AND initial = 's' THEN 1 ELSE 0 END) OVER (PARTITION BY a.conv_id) AS s
          FROM acts a LEFT JOIN t ON a.conv_id IS NOT DISTINCT FROM t.conv_id AND a.i = t.i WHERE sign <> 'D'),
told AS (SELECT conv_id, sha256(string_agg(CASE WHEN sign = 'K' THEN role WHEN (place - s) % 2 = 1 THEN 'user'
                                                ELSE 'assistant' END || ':' || text, chr(10) ORDER BY place)) AS digest
         FROM wrote GROUP BY conv_id)
SELECT c.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
       coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(found.c, 0) AS cost,
       coalesce(found.a, '') AS audit, coalesce(digest, sha256('')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) c
LEFT JOIN facts ON c.conv_id IS NOT DISTINCT FROM facts.conv_id
LEFT JOIN done ON c.conv_id IS NOT DISTINCT FROM done.conv_id
LEFT JOIN told ON c.conv_id IS NOT DISTINCT FROM told.conv_id"""
