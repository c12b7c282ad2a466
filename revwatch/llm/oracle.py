"""DuckDB SQL for the queries of this subpackage that SQL can express.

The others are tested against brute force: quality rules and line templates rest on
XXH64 values, fingerprints on majority bits, and extraction, packing and chaining are
algorithms.
"""

from __future__ import annotations

import re

from revwatch.llm import decontaminate, lexical, secrets, urlrules, warc


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _any_case(pattern: str) -> str:
    """The pattern with ``(?i)`` spelt out for A-Z alone, as RE2 would fold further letters."""
    if not pattern.startswith("(?i)"):
        return pattern
    parts = re.split(r"(\[[^]]*\]|\\x..|\\.)", pattern.removeprefix("(?i)"))
    fold = lambda s: re.sub(r"[a-z]", lambda m: f"[{m[0]}{m[0].upper()}]", s)
    return "".join(p if i % 2 else fold(p) for i, p in enumerate(parts))


def _found(kind: str, pattern: str, group: int = 0, keep: str = "true") -> str:
    pattern = _quoted(_any_case(pattern))
    return f"""
    SELECT rid, {secrets.KINDS.index(kind)} AS rank, '{kind}' AS kind, '{secrets.ROLE.get(kind, "b")}' AS role,
           (list_sum([length(x) for x in gaps[1:i]])
            + coalesce(list_sum([length(x) for x in ms[1:i - 1]]), 0))::BIGINT AS s, length(ms[i]) AS n
    FROM (SELECT rid, ms, vs, gaps, unnest(range(1, len(ms) + 1)) AS i
          FROM (SELECT rid, regexp_extract_all(t, {pattern}) AS ms, regexp_extract_all(t, {pattern}, {group}) AS vs,
                       string_split_regex(t, {pattern}) AS gaps
                FROM d WHERE regexp_matches(t, {pattern})))
    WHERE {keep}"""


_MIXED = "regexp_matches(vs[i], '[0-9]') AND regexp_matches(vs[i], '[A-Z]') AND regexp_matches(vs[i], '[a-z]')"
_ON = 'OVER (PARTITION BY rid, scope ORDER BY s, rank, e ROWS UNBOUNDED PRECEDING)'
_BACK = 'OVER (PARTITION BY rid, scope ORDER BY s DESC, rank DESC, e DESC ROWS UNBOUNDED PRECEDING)'


def _near(role: str, reach: int) -> str:
    return f"""(coalesce(s - max(CASE WHEN role = '{role}' THEN e END) {_ON} <= {reach}, false)
      OR coalesce(min(CASE WHEN role = '{role}' THEN s END) {_BACK} - e <= {reach}, false))"""


SECRETS = f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents),
parts AS (SELECT rid, rank, kind, role, s, s + n AS e FROM (
    {_found("assign", secrets.ASSIGN, 2, f"length(vs[i]) >= {secrets.MIN_VALUE}")}
    UNION ALL {_found("access", secrets.ACCESS)}
    UNION ALL {_found("hex", secrets.HEX)}
    UNION ALL {_found("login", secrets.LOGIN, 2, f"length(vs[i]) >= {secrets.MIN_LOGIN}")}
    UNION ALL {_found("key", secrets.KEY, 0, _MIXED)}
    UNION ALL {_found("endpoint", secrets.ENDPOINT)}
    UNION ALL {_found("break", secrets.BREAK)})),
scoped AS (SELECT *, rank < {secrets.KINDS.index("login")} AS strong,
    sum((role = 'b')::INT) OVER (PARTITION BY rid ORDER BY s, rank, e ROWS UNBOUNDED PRECEDING) AS scope FROM parts),
swept AS (SELECT *, {_near("i", 300)} AS near_i, {_near("s", 300)} AS near_s,
    coalesce(max(CASE WHEN strong THEN e END) {_ON} > s, false)
      OR coalesce(min(CASE WHEN strong THEN s END) {_BACK} < e, false) AS over FROM scoped),
listed AS (SELECT rid, kind, rank, s, e, strong FROM swept
    WHERE strong OR (NOT over AND (role = 'i' AND near_s OR role = 's' AND near_i OR role = 'e' AND near_s AND near_i))),
spans AS (SELECT rid,
    count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access,
    count(*) FILTER (kind = 'hex') AS n_hex,
    string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, rank, e) FILTER (strong) AS base,
    string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, rank, e) AS spans
    FROM listed GROUP BY rid)
SELECT doc_id, coalesce(n_assign, 0)::BIGINT AS n_assign, coalesce(n_access, 0)::BIGINT AS n_access,
    coalesce(n_hex, 0)::BIGINT AS n_hex, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN spans USING (rid)
"""

_FOLDED = """regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"""

CONTAMINATION = f"""
WITH items AS (SELECT item_id, {_FOLDED} AS w FROM benchmark),
windows AS (SELECT DISTINCT item_id, l, array_to_string(w[i:i + l - 1], ' ') AS s
    FROM (SELECT item_id, w, least(len(w), {decontaminate.WINDOW}) AS l,
                 unnest(range(1, greatest(len(w) - {decontaminate.WINDOW}, 0) + 2)) AS i FROM items WHERE len(w) > 0)),
docs AS (SELECT row_number() OVER () AS rid, doc_id, {_FOLDED} AS w FROM documents),
places AS (SELECT rid, l, i, array_to_string(w[i:i + l - 1], ' ') AS s
    FROM (SELECT rid, w, l, unnest(range(1, len(w) - l + 2)) AS i
          FROM docs CROSS JOIN (SELECT DISTINCT l FROM windows))),
found AS (SELECT rid, i, l, item_id FROM places JOIN windows USING (l, s)),
hits AS (SELECT rid, count(DISTINCT p) AS n FROM (SELECT rid, unnest(range(i, i + l)) AS p FROM found) GROUP BY rid),
named AS (SELECT rid, list_sort(list(DISTINCT item_id::VARCHAR)) AS own FROM found GROUP BY rid)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n, 0)::BIGINT AS n_hit, coalesce(len(own), 0)::BIGINT AS n_items,
    sha256(coalesce(array_to_string(own, ','), '')) AS items_sha256, coalesce(n, 0) > 0 AS contaminated
FROM docs LEFT JOIN hits USING (rid) LEFT JOIN named USING (rid)
"""

ARCHIVES = f"""
WITH p AS (SELECT page_id, strlen(coalesce(html, ''))::BIGINT AS n, sha256(coalesce(html, '')) AS digest FROM pages),
first AS (SELECT digest, min(page_id) AS least FROM p WHERE n >= {warc.MIN_PAYLOAD} GROUP BY digest)
SELECT page_id, n AS payload_bytes, digest AS payload_digest,
    CASE WHEN page_id <> least THEN 'revisit' ELSE 'response' END AS record_type,
    CASE WHEN page_id <> least THEN least END AS refers_to
FROM p LEFT JOIN first USING (digest)
"""

SEARCH = f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, {_FOLDED} AS w FROM documents),
k AS (SELECT count(*)::BIGINT AS docs, sum(len(w))::BIGINT AS total FROM d WHERE len(w) > 0),
q AS (SELECT iid, item_id, t, count(*)::BIGINT AS times
      FROM (SELECT row_number() OVER () AS iid, item_id, unnest({_FOLDED}) AS t FROM benchmark) GROUP BY ALL),
p AS (SELECT rid, doc_id, n, t, count(*)::BIGINT AS tf
      FROM (SELECT rid, doc_id, len(w)::BIGINT AS n, unnest(w) AS t FROM d)
      WHERE t IN (SELECT t FROM q) GROUP BY ALL),
w AS (SELECT t, floor(1000 * ln((2 * docs + 2) / (2 * df + 1)))::BIGINT AS weight
      FROM (SELECT t, count(*) AS df FROM p GROUP BY t), k),
s AS (SELECT iid, item_id, rid, doc_id,
             sum(times * weight * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * docs) // total))))::BIGINT AS score
      FROM p JOIN w USING (t) JOIN q USING (t), k GROUP BY ALL)
SELECT item_id, rank, doc_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY iid ORDER BY score DESC, doc_id NULLS LAST)::INT AS rank FROM s WHERE score > 0)
WHERE rank <= {lexical.TOP}
"""


def _url_rules() -> str:
    host, path = "regexp_extract(rest, '^[^/?#]*')", "regexp_extract(rest, '^[^/?#]*([^?#]*)', 1)"
    lower = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"
    fits = [
        f"(CASE WHEN starts_with(path, {_quoted(p)}) AND (host = {_quoted(h)} OR ends_with(host, {_quoted('.' + h)}))"
        f" THEN {{'size': {len(h) + len(p)}, 'rule': {_quoted(h + p)}, 'verdict': '{v}'}} END)"
        for h, p, v in urlrules.HOST_RULES
    ]

    def matches(allows: bool) -> str:
        own = [p for p in map(urlrules.Pattern, urlrules.PATTERNS) if p.allows == allows]
        tests = (f"regexp_matches(low, {_quoted('(?s)' + p.regex.pattern.replace('\\Z', '\\z'))})" for p in own)
        return f"({' OR '.join(tests)})"

    return f"""
WITH u AS (SELECT page_id, coalesce(url, '') AS url, lower(coalesce(url, '')) AS low,
    CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
h AS (SELECT page_id, low, translate({host}, {lower}) AS host, {path} AS path FROM u),
r AS (SELECT *, list_sort([x for x in [{', '.join(fits)}] if x IS NOT NULL], 'DESC')[1] AS best FROM h)
SELECT page_id, host, path, best.rule AS rule,
    coalesce(best.verdict, CASE WHEN {matches(False)} AND NOT {matches(True)} THEN 'block' ELSE 'allow' END) AS verdict
FROM r
"""


def _moves() -> str:
    """(symbol, state, next state, cost, edits): inserts, then one edit of a row."""
    follow, move = {0: "u", 1: "u", 2: "a", 3: "u"}, {"s": 1, "u": 2, "a": 3}
    rows = []
    for symbol in "SUAXsuaxD":
        for state in range(4):
            for inserts in range(3):
                at = state
                for _ in range(inserts):
                    at = move[follow[at]]
                cost, more = 3 * inserts, 3 * symbol.islower()
                rows.append((symbol, state, at, cost + 4, "I" * inserts + "D"))
                if symbol != "D":
                    rows.append((symbol, state, move[follow[at]], cost + 3 + more, "I" * inserts + "R"))
                    if symbol.lower() == follow[at] or symbol.lower() == "s" and at == 0:
                        rows.append((symbol, state, move[symbol.lower()], cost + more, "I" * inserts + "K"))
    return ", ".join(map(str, rows))


REPAIR = f"""
WITH RECURSIVE
bits AS (SELECT list_transform(range(256), lambda x: list_reduce(list_concat([x], range(8)),
             lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS crc),
given AS (SELECT row_number() OVER () AS rid, dense_rank() OVER (ORDER BY conv_id NULLS FIRST) AS c, conv_id, turn,
    coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS k FROM conversations),
marked AS (SELECT *, xor(list_reduce(list_concat([4294967295], list_transform(string_split(k, ''), lambda ch: unicode(ch)::BIGINT)),
    lambda a, b: xor(a >> 8, crc[(xor(a, b) & 255) + 1])), 4294967295) % 20 AS f FROM given, bits),
hurt AS (SELECT rid, c, turn, CASE WHEN f = 4 THEN 'user' ELSE role END AS role,
    CASE f WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text,
    unnest(range(CASE f WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) AS copy FROM marked),
placed AS (SELECT *, row_number() OVER (PARTITION BY c ORDER BY turn NULLS FIRST, md5(role || ':' || text), rid, copy) AS pos FROM hurt),
ink AS (SELECT *, regexp_extract(text, '(?s)([^\\x20\\x09-\\x0D])[\\x20\\x09-\\x0D]*\\z', 1) AS tail,
    row_number() OVER (PARTITION BY c, role, text ORDER BY pos) > 1 AS again, left(role, 1) AS r,
    lag(left(role, 1)) OVER (PARTITION BY c ORDER BY pos) AS r_before FROM placed),
faults AS (SELECT *, CASE WHEN tail = '' THEN 'blank' WHEN again THEN 'duplicate'
    WHEN tail NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault FROM ink),
symbols AS (SELECT c, pos, role, text, CASE WHEN fault IN ('blank', 'duplicate') THEN 'D'
    WHEN fault = 'truncated' THEN CASE WHEN r IN ('s', 'u', 'a') THEN r ELSE 'x' END
    ELSE CASE WHEN r IN ('s', 'u', 'a') THEN upper(r) ELSE 'X' END END AS symbol FROM faults),
counts AS (SELECT c, (coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0))::BIGINT AS gaps,
    count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
    count(*) FILTER (fault = 'truncated') AS truncated,
    count(*) FILTER (r_before IS NOT NULL AND r_before || r NOT IN ('su', 'ua', 'au')) AS illegal, max(pos) AS n
    FROM faults GROUP BY c),
moves(symbol, state, goal, cost, edits) AS (VALUES {_moves()}),
dp AS (SELECT c, 0::BIGINT AS pos, 0 AS state, 0::BIGINT AS cost, '' AS audit FROM counts
    UNION ALL
    SELECT c, pos, state, best.cost, best.audit FROM (
        SELECT dp.c, dp.pos + 1 AS pos, m.goal AS state,
               min({{'cost': dp.cost + m.cost, 'audit': dp.audit || m.edits}}) AS best
        FROM dp JOIN symbols s ON s.c = dp.c AND s.pos = dp.pos + 1 JOIN moves m ON m.symbol = s.symbol AND m.state = dp.state
        GROUP BY ALL)),
least AS (SELECT c, min({{'cost': cost + 3 * length(e), 'audit': audit || e}}) AS best
    FROM (SELECT *, CASE state WHEN 1 THEN 'II' WHEN 2 THEN 'I' ELSE '' END AS e FROM dp) JOIN counts USING (c)
    WHERE pos = n GROUP BY c),
edits AS (SELECT c, i, substr(best.audit, i, 1) AS edit, i - length(replace(substr(best.audit, 1, i), 'I', '')) AS inserted
    FROM (SELECT c, best, unnest(range(1, length(best.audit) + 1)) AS i FROM least)),
lines AS (SELECT e.c, i, edit, s.role, s.text, row_number() OVER (PARTITION BY e.c ORDER BY i) AS p
    FROM edits e LEFT JOIN symbols s ON s.c = e.c AND s.pos = i - inserted WHERE edit <> 'D'),
led AS (SELECT *, max(CASE WHEN p = 1 AND edit = 'K' AND left(role, 1) = 's' THEN 1 ELSE 0 END) OVER (PARTITION BY c) AS s FROM lines),
texts AS (SELECT c, string_agg(CASE WHEN edit = 'K' THEN role WHEN (p - s) % 2 = 1 THEN 'user' ELSE 'assistant' END || ':'
    || CASE WHEN edit = 'I' THEN '' ELSE text END, chr(10) ORDER BY p) AS t FROM led GROUP BY c)
SELECT conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0)::BIGINT AS blank, coalesce(duplicate, 0)::BIGINT AS duplicate,
    coalesce(truncated, 0)::BIGINT AS truncated, coalesce(illegal, 0)::BIGINT AS illegal, coalesce(best.cost, 0)::BIGINT AS cost,
    coalesce(best.audit, '') AS audit, sha256(coalesce(t, '')) AS repaired_sha256
FROM (SELECT DISTINCT c, conv_id FROM given) LEFT JOIN counts USING (c) LEFT JOIN least USING (c) LEFT JOIN texts USING (c)
"""


ORACLE: dict[str, str] = {
    "op1_secret_scan": SECRETS,
    "op3_benchmark_decontamination": CONTAMINATION,
    "op8_warc_archives": ARCHIVES,
    "op10_url_filters": _url_rules(),
    "op12_conversation_repair": REPAIR,
    "op13_ranked_search": SEARCH,
}
