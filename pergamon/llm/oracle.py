"""SQL for the queries that DuckDB can express in full, over the same tables."""

from pergamon.llm.chat_format import CONTROLS, END, TRAINED, TURN
from pergamon.llm.divergence import MIN_DOCUMENTS, SCALE, TOP_TERMS
from pergamon.llm.fill_middle import CUT_PERCENT, SEED, SENTINELS, SUFFIX_FIRST_PERCENT
from pergamon.llm.near_dup import LINK_PERCENT, SHINGLE
from pergamon.llm.quality import RULES, STOP_WORDS, WINDOW

_SPACE = r"[ \t\n\x0B\x0C\r]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _words(text):
    return f"list_filter(string_split_regex({text}, '{_SPACE}'), lambda x: x <> '')"


def _windows(width, words="words"):
    return (f"list_transform(range(1, len({words}) - {width - 2}), "
            f"lambda i: array_to_string({words}[i:i + {width - 1}], ' '))")


def _broken(name, measure, comparison, threshold):
    over, under = (x.strip() for x in measure.split("/"))
    return f"CASE WHEN {under} > 0 AND {over}::DOUBLE / {under} {comparison} {threshold} THEN '{name}' END"


_STOP = ", ".join(f"'{w}'" for w in sorted(set(STOP_WORDS)))

QUALITY = rf"""
WITH w AS (
  SELECT doc_id, t, {_words('t')} AS words,
    list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^ \t\n\x0B\x0C\r]')) AS lines
  FROM (SELECT doc_id, coalesce(text, '') AS t FROM documents) d),
windows AS (SELECT doc_id, unnest({_windows(WINDOW)}) AS g, generate_subscripts({_windows(WINDOW)}, 1) AS place FROM w),
repeated AS (SELECT doc_id, place FROM windows QUALIFY count(*) OVER (PARTITION BY doc_id, g) > 1),
covered AS (SELECT doc_id, count(DISTINCT place + k) AS n FROM repeated, range({WINDOW}) r(k) GROUP BY doc_id),
m AS (
  SELECT w.doc_id, CAST(len(words) AS BIGINT) AS n_words,
    CAST(length(array_to_string(words, '')) AS BIGINT) AS word_chars,
    CAST(length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
    CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
    CAST(coalesce(n, 0) AS BIGINT) AS n_repeat_words, CAST(len(lines) AS BIGINT) AS n_lines,
    CAST(length(t) - length(replace(t, '!', '')) AS BIGINT) AS n_exclamations,
    CAST(len(list_filter(words, lambda x: lower(x) IN ({_STOP}))) AS BIGINT) AS n_stop_words,
    CAST(len(list_filter(range(2, len(words) + 1), lambda i: words[i] = words[i - 1])) AS BIGINT) AS n_echo_words,
    CAST(len(list_filter(lines, lambda x: regexp_matches(x, '^[ \t]*[-*•]'))) AS BIGINT) AS n_bullet_lines,
    CAST(len(list_filter(lines, lambda x: regexp_matches(x, '(\.\.\.|…)[ \t\r]*$'))) AS BIGINT) AS n_cut_lines
  FROM w LEFT JOIN covered ON covered.doc_id = w.doc_id)
SELECT *, base_failed = FALSE AND broken_rules = '' AS kept FROM (
  SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
    concat_ws(',', {', '.join(_broken(*r) for r in RULES)}) AS broken_rules FROM m) r
"""

NEAR_DUP = f"""
WITH RECURSIVE d AS (
  SELECT doc_id, {_words(f"translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}')")} AS words FROM documents),
s AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(words) >= {SHINGLE} THEN {_windows(SHINGLE)}
    WHEN len(words) > 0 THEN [array_to_string(words, ' ')] ELSE [] END) AS g FROM d),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
links AS (
  SELECT c.x, c.y FROM (
    SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS k FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id
    GROUP BY a.doc_id, b.doc_id) c
  JOIN n p ON p.doc_id = c.x JOIN n q ON q.doc_id = c.y WHERE 100 * k >= {LINK_PERCENT} * (p.n + q.n - k)),
reach AS (
  SELECT doc_id, doc_id AS r FROM d UNION SELECT reach.doc_id, links.y FROM reach JOIN links ON links.x = reach.r)
SELECT doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, component_id, doc_id = component_id AS kept
FROM (SELECT doc_id, min(r) AS component_id FROM reach GROUP BY doc_id) c LEFT JOIN n USING (doc_id)
"""


def _broken_up(text):
    """How many characters escaping adds to a text."""
    each = [f"(length({text}) - length(replace({text}, '{c}', ''))) // {len(c)}" for c in ("\\", *CONTROLS)]
    return " + ".join(each)


CHAT = f"""
WITH m AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS t FROM conversations
  UNION ALL SELECT CAST(-7 AS BIGINT), i, ['user', 'assistant'][i + 1], '</s>[INST] ok [/INST]' FROM range(2) r(i))
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || t || chr(10), '' ORDER BY turn, role, t)) AS turns_sha256,
  CAST(coalesce(sum(length(t)) FILTER (WHERE role = '{TRAINED}'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(t, '' ORDER BY turn, role, t) FILTER (WHERE role = '{TRAINED}'), '')) AS loss_sha256,
  CAST(sum({len(TURN) + len(END) + 2} + length(role) + length(t) + {_broken_up('role')} + {_broken_up('t')}
    + length(role) - length(replace(role, chr(10), ''))) AS BIGINT) AS formatted_chars
FROM m GROUP BY conv_id
"""

_P, _S, _M = SENTINELS
_MARKED = " OR ".join(f"contains(t, '{s}')" for s in SENTINELS)
_DRAWS = ", ".join(f"CAST(concat('0x', substr(h, {8 * i + 1}, 8)) AS BIGINT) AS h{i + 1}" for i in range(4))

MIDDLE = f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, sha256(concat('{SEED}:', doc_id)) AS h FROM documents),
n AS (SELECT *, CAST(length(t) AS BIGINT) AS n, {_DRAWS} FROM d),
c AS (SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
    CASE WHEN t = '' OR {_MARKED} OR h3 % 100 >= {CUT_PERCENT} THEN 'plain'
      WHEN h4 % 100 < {SUFFIX_FIRST_PERCENT} THEN 'spm' ELSE 'psm' END AS form FROM n),
s AS (SELECT *, substr(t, 1, a) AS prefix, substr(t, a + 1, b - a) AS middle, substr(t, b + 1) AS suffix FROM c)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN a END AS prefix_chars,
  CASE WHEN form <> 'plain' THEN b - a END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN concat('{_P}', prefix, '{_S}', suffix, '{_M}', middle)
    ELSE concat('{_S}', suffix, '{_P}', prefix, '{_M}', middle) END) AS output_sha256, sha256(t) AS restored_sha256
FROM s
"""


def _share_of(count, total):
    return f"1 + (({SCALE} * (CAST({count} AS HUGEINT) + 1)) // ({total} + v))"


DIVERGENCE = rf"""
WITH d AS (
  SELECT row_number() OVER () AS row, coalesce(lang, '') AS lang, coalesce(source, '') AS source, regexp_extract_all(
    translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[a-z\x{{80}}-\x{{10FFFF}}]+') AS words FROM documents),
w AS (SELECT row, lang, source, unnest(words) AS term FROM d),
kept AS (SELECT lang, term, count(*) AS c FROM w GROUP BY lang, term HAVING count(DISTINCT row) >= {MIN_DOCUMENTS}),
langs AS (SELECT lang, count(*) AS v, sum(c) AS n FROM kept GROUP BY lang),
groups AS (SELECT DISTINCT lang, source FROM d),
seen AS (SELECT lang, source, term, count(*) AS c FROM w GROUP BY lang, source, term),
dense AS (
  SELECT g.lang, g.source, k.term, k.c AS lang_c, coalesce(s.c, 0) AS c FROM groups g JOIN kept k ON k.lang = g.lang
  LEFT JOIN seen s ON s.lang = g.lang AND s.source = g.source AND s.term = k.term),
totals AS (SELECT lang, source, sum(c) AS n FROM dense GROUP BY lang, source),
priced AS (
  SELECT e.lang, e.source, term, c, {_share_of('c', 't.n')} AS p, {_share_of('lang_c', 'l.n')} AS q FROM dense e
  JOIN totals t ON t.lang = e.lang AND t.source = e.source JOIN langs l ON l.lang = e.lang),
pairs AS (
  SELECT a.lang, a.source, b.source AS item, coalesce(sum(((x.p - y.p) * (x.p - y.p)) // y.p), 0) AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN priced x ON x.lang = a.lang AND x.source = a.source
  LEFT JOIN priced y ON y.lang = b.lang AND y.source = b.source AND y.term = x.term GROUP BY ALL),
parts AS (
  SELECT lang, source, 'pair' AS part, item, value FROM pairs UNION ALL
  SELECT lang, source, 'term', term, ((p - q) * (p - q)) // q FROM priced WHERE c > 0 AND p > q)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank FROM (
  SELECT *, row_number() OVER (
    PARTITION BY lang, source, part ORDER BY value DESC, encode(item)) AS rank FROM parts) r
WHERE part = 'pair' OR rank <= {TOP_TERMS}
"""

ORACLE_SQL = {
    "op4_near_dup": NEAR_DUP, "op5_chat_format": CHAT, "op7_quality_rules": QUALITY, "op11_fill_middle": MIDDLE,
    "op12_source_divergence": DIVERGENCE}
