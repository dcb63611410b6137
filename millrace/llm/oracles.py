"""DuckDB SQL for the training-data queries that SQL can express on whole tables.

Networks, trees, hashes of this library, approximate indexes and compressors have no SQL; those queries are tested against brute force.
"""

from __future__ import annotations

from millrace.llm import conversation_repair
from millrace.llm.quality_rules import RATES, SKETCH_BITS, SYMBOLS, WINDOW

_BLANKS = "[\\x20\\x09-\\x0D]+"
_TRIMMED = f"regexp_replace(l, '^{_BLANKS}|{_BLANKS}$', '', 'g')"
_WORDS = f"list_filter(regexp_split_to_array(coalesce(text, ''), '{_BLANKS}'), lambda w: w <> '')"

LINE_DEDUP = f"""
    WITH lines AS (SELECT source, {_TRIMMED} AS line FROM (SELECT source, unnest(string_split(text, chr(10))) AS l FROM documents)),
    bad AS (SELECT coalesce(list(line), []) AS found FROM (SELECT line FROM lines WHERE line <> '' GROUP BY line HAVING count(DISTINCT coalesce(source, chr(1))) >= 10)),
    cut AS (SELECT doc_id, string_split(text, chr(10)) AS a, list_filter(string_split(text, chr(10)), lambda l: NOT list_contains(found, {_TRIMMED})) AS b FROM documents, bad)
    SELECT doc_id, coalesce(len(a), 0)::BIGINT AS n_lines, coalesce(len(a) - len(b), 0)::BIGINT AS n_removed,
        sha256(array_to_string(b, chr(10))) AS text_sha256, length(array_to_string(b, chr(10)))::BIGINT AS n_chars FROM cut
"""

#: All pairs of documents that share a shingle, counted exactly; components by walking the links.
NEAR_DEDUP = f"""
    WITH RECURSIVE words AS (SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{_BLANKS}'), lambda w: w <> '') AS w FROM documents),
    shingles AS (SELECT DISTINCT doc_id, s FROM (
        SELECT doc_id, unnest(CASE WHEN len(w) >= 2 THEN list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]) ELSE w END) AS s FROM words)),
    sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
    common AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY 1, 2),
    links AS (SELECT c.a, c.b FROM common c JOIN sizes x ON x.doc_id = c.a JOIN sizes y ON y.doc_id = c.b WHERE 100 * c.n >= 80 * (x.n + y.n - c.n)),
    both_ways AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
    reach(doc_id, other) AS (SELECT doc_id, doc_id FROM documents UNION SELECT r.doc_id, l.b FROM reach r JOIN both_ways l ON r.other = l.a),
    roots AS (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id)
    SELECT d.doc_id, coalesce(n, 0)::BIGINT AS n_shingles, component_id, d.doc_id = component_id AS kept
    FROM documents d JOIN roots USING (doc_id) LEFT JOIN sizes USING (doc_id)
"""


def _fence_sql(sketch: str, by: str) -> str:
    part = f"PARTITION BY {by}rate"
    return f"""SELECT {by}rate, max(texts) AS texts, min(bucket) FILTER (4 * through >= 3 * texts) + 6 * (min(bucket) FILTER (4 * through >= 3 * texts) - min(bucket) FILTER (4 * through >= texts)) AS fence
        FROM (SELECT *, sum(n) OVER ({part} ORDER BY bucket) AS through, sum(n) OVER ({part}) AS texts FROM {sketch}) GROUP BY {by}rate"""


_SMOOTHED = " UNION ALL ".join(f"SELECT lang, source, '{k}' AS rate, (1000000 * (2 * {c} + {h})) // (2 * {s} + 2) AS v FROM measured WHERE NOT base_failed" for k, (c, s, h) in RATES.items())
_OVER = " AND ".join(f"(1000000 * {c}) // greatest({s}, 1) <= {k}" for k, (c, s, _) in RATES.items())
_LIMITS = ", ".join(f"max(fence) FILTER (rate = '{k}') AS {k}" for k in RATES)

QUALITY_RULES = f"""
    WITH split AS (SELECT doc_id, lang, source, coalesce(text, '') AS text, {_WORDS} AS w, list_filter(string_split(coalesce(text, ''), chr(10)), lambda l: regexp_matches(l, '[^\\x20\\x09-\\x0D]')) AS l FROM documents),
    windows AS (SELECT doc_id, i, array_to_string(w[i:i + {WINDOW - 1}], ' ') AS k FROM (SELECT doc_id, w, unnest(range(1, len(w) - {WINDOW - 2})) AS i FROM split WHERE len(w) >= {WINDOW})),
    again AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, k) AS n FROM windows) WHERE n > 1),
    covered AS (SELECT doc_id, count(DISTINCT p)::BIGINT AS n FROM (SELECT doc_id, unnest(range(i, i + {WINDOW})) AS p FROM again) GROUP BY doc_id),
    counted AS (SELECT s.doc_id, lang, source, len(w)::BIGINT AS n_words, coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::BIGINT AS word_chars, length(regexp_replace(text, '[^{SYMBOLS}]', '', 'g'))::BIGINT AS n_symbols,
        len(l)::BIGINT AS n_lines, (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines, coalesce(c.n, 0)::BIGINT AS n_repeat_words FROM split s LEFT JOIN covered c ON c.doc_id = s.doc_id),
    measured AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM counted),
    fine AS (SELECT lang, source, rate, v >> greatest(length(bin(v)) - {SKETCH_BITS}, 0) << greatest(length(bin(v)) - {SKETCH_BITS}, 0) AS bucket, count(*) AS n FROM ({_SMOOTHED}) GROUP BY ALL),
    coarse AS (SELECT lang, rate, bucket, sum(n) AS n FROM fine GROUP BY ALL), whole AS (SELECT rate, bucket, sum(n) AS n FROM coarse GROUP BY ALL),
    own AS ({_fence_sql('fine', 'lang, source, ')}), language AS ({_fence_sql('coarse', 'lang, ')}), everything AS ({_fence_sql('whole', '')}),
    chosen AS (SELECT o.lang, o.source, o.rate, CASE WHEN o.texts >= 200 THEN o.fence WHEN l.texts >= 200 THEN l.fence ELSE e.fence END AS fence
        FROM own o JOIN language l ON l.lang IS NOT DISTINCT FROM o.lang AND l.rate = o.rate JOIN everything e ON e.rate = o.rate),
    limits AS (SELECT lang, source, {_LIMITS} FROM chosen GROUP BY lang, source)
    SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND coalesce({_OVER}, false) AS kept
    FROM measured m LEFT JOIN limits f ON f.lang IS NOT DISTINCT FROM m.lang AND f.source IS NOT DISTINCT FROM m.source
"""

_Z = "list_sum(list_transform(ps, lambda p: pow(p, {a})))"
_ENTROPY = f"ln({_Z}) - {{a}} * list_sum(list_transform(ps, lambda p: pow(p, {{a}}) * ln(p))) / {_Z}"
_SPREAD = "pow(list_max(ps) / list_min(ps), 1 - {a})"


def _bisect_sql(name: str, start: str, holds: str, source: str) -> str:
    """32 halvings; the last low is the exponent."""
    middle = "(low + (high - low) / 2)"
    return f"""{name}(k, ps, low, high) AS (SELECT 0, ps, {start}, 1.0::DOUBLE FROM {source}
        UNION ALL SELECT k + 1, ps, CASE WHEN {holds.format(a=middle)} THEN {middle} ELSE low END, CASE WHEN {holds.format(a=middle)} THEN high ELSE {middle} END FROM {name} WHERE k < 32)"""


MIXING = f"""
    WITH RECURSIVE rows AS (SELECT doc_id, source, len({_WORDS})::BIGINT AS n, md5('42:' || coalesce(doc_id::VARCHAR, '') || ':' || coalesce(text, '')) AS d FROM documents),
    sources AS (SELECT source, sum(n)::BIGINT AS tokens, count(*) AS rows FROM rows GROUP BY source),
    shares AS (SELECT *, tokens / greatest(sum(tokens) OVER (), 1)::DOUBLE AS p FROM sources),
    flat AS (SELECT coalesce(list(p ORDER BY p) FILTER (p > 0), []) AS ps FROM shares),
    {_bisect_sql('warm', '0.0::DOUBLE', f'({_ENTROPY}) >= 0.98 * ln(len(ps))', 'flat')},
    wanted AS (SELECT ps, low AS a FROM warm WHERE k = 32),
    {_bisect_sql('limited', 'a', f'{_SPREAD} > 2.0', 'wanted')},
    exponent AS (SELECT CASE WHEN len(w.ps) < 2 OR {_ENTROPY.format(a='1.0').replace('ps', 'w.ps')} >= 0.98 * ln(len(w.ps)) THEN 1.0
        WHEN {_SPREAD.format(a='w.a').replace('ps', 'w.ps')} <= 2.0 THEN w.a ELSE least(1.0, l.low + pow(16.0, -8)) END AS a FROM wanted w, limited l WHERE l.k = 32),
    raised AS (SELECT s.*, CASE WHEN p > 0 THEN pow(p, a) ELSE 0 END AS r FROM shares s, exponent),
    plan AS (SELECT source, r / sum(r) OVER () AS weight, CASE WHEN p > 0 THEN r / p / min(CASE WHEN p > 0 THEN r / p END) OVER () ELSE 1.0 END AS epochs, ceil(rows / 1024.0)::BIGINT AS blocks FROM raised),
    dealt AS (SELECT r.*, weight, epochs, ('0x' || d[1:15])::BIGINT AS spot, ('0x' || d[16:30])::BIGINT AS place, (('0x' || d[1:15])::BIGINT % blocks)::INTEGER AS block FROM rows r JOIN plan p ON p.source IS NOT DISTINCT FROM r.source),
    placed AS (SELECT *, row_number() OVER (PARTITION BY source, block ORDER BY place, spot) AS position, sum(n) OVER (PARTITION BY source, block ORDER BY place, spot ROWS UNBOUNDED PRECEDING) AS through, sum(n) OVER (PARTITION BY source, block) AS everything FROM dealt),
    counted AS (SELECT *, floor(epochs + 1e-9)::INTEGER + CASE WHEN through <= (epochs - floor(epochs + 1e-9)) * everything AND n > 0 THEN 1 ELSE 0 END AS copies FROM placed)
    SELECT doc_id, source, n AS n_tokens, round(weight, 9) AS weight, unnest(range(copies))::INTEGER AS epoch, block, position::INTEGER AS position FROM counted
"""


def _repair_values() -> str:
    """(state, initial, next, cost, code, inserted lines, new role) of every macro edit, from the operator's own grammar."""
    out = []
    for state in range(4):
        for initial in ("s", "u", "a", ""):
            for following, cost, code in conversation_repair.macros(state, initial):
                at, lines, role = state, [], None
                for c in code:
                    before, at = at, conversation_repair.made(at)
                    if c == "I":
                        lines.append("user:" if at == 2 else "assistant:")
                    elif c == "R":
                        role = "user" if at == 2 else "assistant"
                    else:
                        at = before
                out.append(f"({state}, '{initial}', {following}, {cost}, '{code}', {lines}::VARCHAR[], {f"'{role}'" if role else 'NULL'})")
    return ", ".join(out)


_CRC32 = """xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(k, ''), lambda c: ord(c)::BIGINT)), lambda c, b:
    list_reduce(list_prepend(xor(c, b), [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]), lambda x, y: CASE WHEN x % 2 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END)), 4294967295)"""

#: The same grammar, with whole audits and texts carried along instead of ranks and pointers.
CONVERSATION_REPAIR = f"""
    WITH RECURSIVE keyed AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS k FROM conversations),
    kinds AS (SELECT *, {_CRC32} % 20 AS kind FROM keyed),
    damaged AS (SELECT conv_id, turn, CASE kind WHEN 4 THEN 'user' ELSE role END AS role, CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
        unnest(CASE kind WHEN 3 THEN [1, 2] ELSE [1] END) AS copy FROM kinds WHERE kind <> 0),
    numbered AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i,
        CASE WHEN substr(role, 1, 1) IN ('s', 'u', 'a') THEN substr(role, 1, 1) ELSE '' END AS initial FROM damaged),
    marked AS (SELECT *, CASE WHEN NOT regexp_matches(text, '[^\\x20\\x09-\\x0D]') THEN 'blank' WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 'duplicate'
        WHEN NOT regexp_matches(text, '[.!?][\\x20\\x09-\\x0D]*$') THEN 'truncated' ELSE '' END AS fault,
        lag(initial) OVER (PARTITION BY conv_id ORDER BY i) || initial AS pair FROM numbered),
    told AS (SELECT conv_id, max(i) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0)::BIGINT AS gaps, count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
        count(*) FILTER (fault = 'truncated') AS truncated, count(*) FILTER (i > 1 AND pair NOT IN ('su', 'ua', 'au')) AS illegal FROM marked GROUP BY conv_id),
    macros(state, initial, following, price, code, inserted, new_role) AS (VALUES {_repair_values()}),
    walk(conv_id, i, state, best) AS (
        SELECT conv_id, 0::BIGINT, 0, {{'cost': 0::BIGINT, 'audit': '', 'body': []::VARCHAR[]}} FROM told
        UNION ALL
        SELECT w.conv_id, w.i + 1, m.following, min({{'cost': best.cost + price + CASE WHEN fault = 'truncated' AND code <> 'D' THEN 3 ELSE 0 END, 'audit': best.audit || code,
            'body': list_concat(best.body, inserted, CASE WHEN code = 'D' THEN []::VARCHAR[] ELSE [coalesce(new_role, role) || ':' || text] END)}})
        FROM walk w JOIN marked r ON r.conv_id IS NOT DISTINCT FROM w.conv_id AND r.i = w.i + 1 JOIN macros m ON m.state = w.state AND m.initial = r.initial AND (fault IN ('', 'truncated') OR code = 'D')
        GROUP BY w.conv_id, w.i + 1, m.following),
    ends AS (SELECT w.conv_id, min({{'cost': best.cost + len(tail) * 3, 'audit': best.audit || tail, 'body': list_concat(best.body, lines)}}) AS best
        FROM walk w JOIN told t ON t.conv_id IS NOT DISTINCT FROM w.conv_id AND t.n = w.i JOIN (VALUES (0, '', []::VARCHAR[]), (1, 'II', ['user:', 'assistant:']), (2, 'I', ['assistant:']), (3, '', [])) x(state, tail, lines) ON x.state = w.state GROUP BY w.conv_id)
    SELECT c.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal,
        coalesce(best.cost, 0)::BIGINT AS cost, coalesce(best.audit, '') AS audit, sha256(coalesce(array_to_string(best.body, chr(10)), '')) AS repaired_sha256
    FROM (SELECT DISTINCT conv_id FROM conversations) c LEFT JOIN told t ON t.conv_id IS NOT DISTINCT FROM c.conv_id LEFT JOIN ends e ON e.conv_id IS NOT DISTINCT FROM c.conv_id
"""

ORACLES: dict[str, str] = {"op2_line_dedup": LINE_DEDUP, "op3_near_dedup": NEAR_DEDUP, "op7_mixing": MIXING, "op9_quality_rules": QUALITY_RULES, "op12_conversation_repair": CONVERSATION_REPAIR}
