"""DuckDB SQL for the registered queries that SQL can express."""

from __future__ import annotations

from cardwatch.llm.chat import PROBE_TEXT
from cardwatch.llm.mixing import MIXTURE

OP3_CHAT = f"""
WITH turns AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role NULLS FIRST, text NULLS FIRST) AS n
  FROM (SELECT conv_id, turn, role, text FROM conversations
        UNION ALL SELECT -1, 0, 'user', '{PROBE_TEXT}'
        UNION ALL SELECT -1, 1, 'assistant', '{PROBE_TEXT}')),
joined AS (
  SELECT conv_id, count(*) AS n_turns,
         string_agg(role || chr(10) || text || chr(10), '' ORDER BY n) AS said,
         coalesce(string_agg(text, '' ORDER BY n) FILTER (WHERE role = 'assistant'), '') AS loss,
         -- markers of 12 and 10 characters and two newlines; one more backslash in every '<\\...|'
         sum(24 + length(replace(replace(replace(role, '%', '%25'), chr(10), '%0A'), '<', '%3C')) + length(text)
             + length(regexp_extract_all(text, '<\\\\*\\|'))) AS formatted_chars
  FROM turns GROUP BY conv_id)
SELECT conv_id, CAST(n_turns AS BIGINT) AS n_turns, sha256(said) AS turns_sha256,
       CAST(length(loss) AS BIGINT) AS loss_chars, sha256(loss) AS loss_sha256,
       CAST(formatted_chars AS BIGINT) AS formatted_chars
FROM joined
"""

OP10_EXACT_DEDUP = r"""
WITH n AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS norm FROM documents),
g AS (SELECT norm, min(doc_id) AS keep_id, count(*) AS group_size FROM n GROUP BY norm)
SELECT n.doc_id, g.keep_id, CAST(g.group_size AS BIGINT) AS group_size,
       n.doc_id IS NOT DISTINCT FROM g.keep_id AS kept, sha256(n.norm) AS text_sha256
FROM n JOIN g ON n.norm = g.norm
"""


def _weight(level: str) -> str:
    listed = " ".join(f"WHEN '{k}' THEN {w}" for k, w in MIXTURE.weights.get(level, {}).items())
    return f"CAST(CASE {level} {listed} ELSE {MIXTURE.default_weight} END AS BIGINT)" if listed else \
        f"CAST({MIXTURE.default_weight} AS BIGINT)"


def _share_level(path: list[str], above: list[str], budgets: str) -> str:
    """Budgets of the nodes at ``path``, from the budgets of their parents."""
    level, keys = path[-1], ", ".join(path)
    parent = f"PARTITION BY {', '.join(above)}" if above else ""
    join = f"JOIN {budgets} p USING ({', '.join(above)})" if above else f"CROSS JOIN {budgets} p"
    order = f"({parent} ORDER BY c.cap / c.w, c.{level} ROWS BETWEEN"
    return f"""
      SELECT {keys}, CASE WHEN full_ THEN cap ELSE (w * (b - sum(CASE WHEN full_ THEN cap ELSE 0 END) OVER ({parent})))
               // greatest(sum(CASE WHEN full_ THEN 0 ELSE w END) OVER ({parent}), 1) END AS budget
      FROM (SELECT *, (b - used) * w >= cap * later AS full_
            FROM (SELECT {', '.join('c.' + k for k in path)}, c.cap, c.w, p.budget AS b,
                         sum(c.cap) OVER {order} UNBOUNDED PRECEDING AND CURRENT ROW) AS used,
                         coalesce(sum(c.w) OVER {order} 1 FOLLOWING AND UNBOUNDED FOLLOWING), 0) AS later
                  FROM (SELECT {keys}, sum(tokens) * {MIXTURE.max_epochs} AS cap, {_weight(level)} AS w
                        FROM leaves GROUP BY {keys}) c {join}))"""


def _passed_on(step: int, above: list[str]) -> str:
    """Budgets after the unspent tokens below each node went to one leaf, and
    what that leaf selects with them."""
    parent = f"PARTITION BY {', '.join(above)}" if above else ""
    return f"""
pooled{step} AS (
  SELECT *, CASE WHEN row_number() OVER ({parent} ORDER BY cap - selected >= whole DESC, CASE WHEN cap - selected >= whole
              THEN tokens / docs ELSE 0 END, cap - selected DESC, domain, lang, source) = 1 THEN whole ELSE 0 END AS pool
  FROM (SELECT domain, lang, source, tokens, docs, cap, selected, sum(unspent) OVER ({parent}) AS whole FROM state{step})),
budgets{step} AS (SELECT *, least(selected + pool, cap) AS budget FROM pooled{step}),
state{step + 1} AS (
  SELECT b.domain, b.lang, b.source, b.tokens, b.docs, b.cap, b.budget, s.selected, b.selected + b.pool - s.selected AS unspent
  FROM budgets{step} b JOIN ({_spent(f'budgets{step}')}) s USING (domain, lang, source))"""


def _spent(budgets: str) -> str:
    """Tokens that each leaf selects: its longest prefix within the budget."""
    return f"""SELECT b.domain, b.lang, b.source, CAST(b.budget // b.tokens * b.tokens + coalesce(max(r.upto) FILTER (
        WHERE r.epoch = b.budget // b.tokens + 1 AND r.upto <= b.budget % b.tokens), 0) AS BIGINT) AS selected
      FROM {budgets} b JOIN running r USING (domain, lang, source) GROUP BY b.domain, b.lang, b.source, b.budget, b.tokens"""


def _mixing() -> str:
    m = MIXTURE
    levels = list(m.levels)
    key = f"CAST('0x' || substr(md5(concat_ws(':', '{m.seed}', CAST(epoch AS VARCHAR), ident)), 1, 15) AS BIGINT)"
    return f"""
WITH docs AS (
  SELECT doc_id, text, lang AS raw_lang, source AS raw_source,
         coalesce(CAST(doc_id AS VARCHAR), '') || ':' || md5(coalesce(text, '')) AS ident,
         CASE WHEN regexp_matches(coalesce(source, ''), '[0-9]{{1,9}}$')
              THEN 'd' || CAST(CAST(regexp_extract(source, '([0-9]{{1,9}})$', 1) AS BIGINT) % 4 AS VARCHAR)
              ELSE 'other' END AS domain,
         coalesce(lang, '\\N') AS lang, coalesce(source, '\\N') AS source,
         CAST(len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS BIGINT) AS tokens
  FROM documents),
leaves AS (SELECT domain, lang, source, CAST(sum(tokens) AS BIGINT) AS tokens, count(*) AS docs FROM docs GROUP BY ALL),
total AS (SELECT least(CAST(sum(tokens) AS BIGINT) * {m.share_num} // {m.share_den},
                       CAST(sum(tokens) AS BIGINT) * {m.max_epochs}) AS budget FROM leaves),
by_domain AS ({_share_level(levels[:1], [], 'total')}),
by_lang AS ({_share_level(levels[:2], levels[:1], 'by_domain')}),
by_source AS ({_share_level(levels, levels[:2], 'by_lang')}),
placed AS (SELECT d.*, e.epoch, {key} AS key FROM docs d CROSS JOIN range(1, {m.max_epochs + 2}) e(epoch)),
running AS (SELECT *, CAST(sum(tokens) OVER (PARTITION BY domain, lang, source, epoch ORDER BY key
                           RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS upto FROM placed),
planned AS (SELECT domain, lang, source, l.tokens, l.docs, l.tokens * {m.max_epochs} AS cap, CAST(b.budget AS BIGINT) AS budget
            FROM leaves l JOIN by_source b USING (domain, lang, source) WHERE l.tokens > 0),
state0 AS (SELECT p.*, s.selected, p.budget - s.selected AS unspent
           FROM planned p JOIN ({_spent('planned')}) s USING (domain, lang, source)),
{",".join(_passed_on(k, levels[:len(levels) - 1 - k]) for k in range(len(levels)))},
plan AS (SELECT *, selected // tokens AS epochs, selected % tokens AS rest FROM state{len(levels)})
SELECT doc_id, domain, raw_lang AS lang, raw_source AS source, r.tokens, CAST(epoch AS BIGINT) AS epoch
FROM running r JOIN plan p USING (domain, lang, source)
WHERE epoch <= p.epochs OR (epoch = p.epochs + 1 AND p.rest > 0 AND upto <= p.rest)
"""


OP13_SPELLING = r"""
WITH RECURSIVE
crc AS (SELECT list_transform(range(256), lambda n: list_reduce([n, 0, 0, 0, 0, 0, 0, 0, 0],
          lambda c, i: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t),
said AS (SELECT doc_id, unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-z\x{C0}-\x{FF}]+')) AS run FROM documents),
runs AS (SELECT doc_id, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run, count(*) AS n
         FROM said GROUP BY ALL),
marked AS (
  SELECT run, n, xor(list_reduce(list_concat([4294967295], flatten(list_transform(
           string_split(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run, ''),
           lambda c: CASE WHEN unicode(c) < 128 THEN [CAST(unicode(c) AS BIGINT)]
                          ELSE [CAST(192 + (unicode(c) >> 6) AS BIGINT), CAST(128 + (unicode(c) & 63) AS BIGINT)] END))),
         lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) AS h
  FROM runs, crc),
words AS (
  SELECT CASE WHEN h % 97 = 0 THEN substr(run, 1, CAST(h % length(run) AS INT)) || substr(run, CAST(h % length(run) AS INT) + 2)
              ELSE run END AS word, CAST(sum(n) AS BIGINT) AS n
  FROM marked GROUP BY 1 HAVING length(word) >= 5 AND sum(n) >= 3),
less AS (SELECT word, i, substr(word, 1, i - 1) || substr(word, i + 1) AS rest
         FROM (SELECT word, unnest(range(1, length(word) + 1)) AS i FROM words)),
near AS (
  SELECT a.word, b.word AS other FROM less a JOIN less b ON a.rest = b.rest AND a.i = b.i WHERE a.word <> b.word
  UNION SELECT a.word, b.word FROM less a JOIN words b ON a.rest = b.word
  UNION SELECT b.word, a.word FROM less a JOIN words b ON a.rest = b.word),
ranked AS (
  SELECT p.word, p.other, o.n AS other_n, count(*) OVER (PARTITION BY p.word) AS n_near,
         row_number() OVER (PARTITION BY p.word ORDER BY o.n DESC, p.other) AS place
  FROM near p JOIN words o ON p.other = o.word),
formed AS (
  SELECT w.word, w.n, coalesce(r.n_near, 0) AS n_near, CASE WHEN r.other_n >= 2 * w.n THEN r.other END AS form,
         CASE WHEN r.other_n >= 2 * w.n THEN r.other_n END AS form_n
  FROM words w LEFT JOIN ranked r ON w.word = r.word AND r.place = 1),
rooted AS (SELECT word, word AS root FROM formed WHERE form IS NULL
           UNION ALL SELECT f.word, r.root FROM formed f JOIN rooted r ON f.form = r.word)
SELECT word, form, root, n, n_near, form_n FROM formed JOIN rooted USING (word)
"""

ORACLE = {"op3_chat": OP3_CHAT, "op4_mixing": _mixing(), "op10_exact_dedup": OP10_EXACT_DEDUP,
          "op13_spelling": OP13_SPELLING}
