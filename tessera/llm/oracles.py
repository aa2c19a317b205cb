"""DuckDB counterparts of the queries that SQL can express."""

from __future__ import annotations

from tessera.llm.chat import Template
from tessera.llm.quality import RULES, STOP_WORDS

_BREAK = r"[ \t\n\x0B\x0C\r]+"


def _rule_sql(rule) -> str:
    part, tests = f"{rule.part} * 100", []
    if rule.low is not None:
        tests.append(f"{part} < {rule.whole} * {rule.low}")
    if rule.high is not None:
        tests.append(f"{part} > {rule.whole} * {rule.high}")
    return f"CASE WHEN {' OR '.join(tests)} THEN '{rule.name}' END"


def quality_sql(source: str = "documents") -> str:
    """All counts and verdicts per row of ``source``."""
    stops = ", ".join(f"'{w}'" for w in STOP_WORDS)
    broken = ", ".join(_rule_sql(r) for r in RULES)
    return rf"""
WITH q_texts AS (
  SELECT doc_id, coalesce(text, '') AS text FROM {source}),
q_split AS (
  SELECT *, regexp_extract_all(text, '[^ \t\n\x0B\x0C\r]+') AS w,
    list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^ \t\n\x0B\x0C\r]')) AS l
  FROM q_texts),
q_words AS (
  SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS i FROM q_split),
q_windows AS (
  SELECT doc_id, i, word || ' ' || lead(word) OVER o || ' ' || lead(word, 2) OVER o AS t
  FROM q_words WINDOW o AS (PARTITION BY doc_id ORDER BY i)),
q_repeated AS (
  SELECT doc_id, i FROM q_windows WHERE t IS NOT NULL
  QUALIFY count(*) OVER (PARTITION BY doc_id, t) > 1),
q_covered AS (
  SELECT doc_id, count(DISTINCT i + k) AS n FROM q_repeated, (VALUES (0), (1), (2)) s(k) GROUP BY doc_id),
q_counts AS (
  SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(length(array_to_string(w, '')), 0)::BIGINT AS word_chars,
    len(regexp_extract_all(text, '[#*$%&|<>]'))::BIGINT AS n_symbols,
    (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines, len(l)::BIGINT AS n_lines,
    len(list_filter(w, lambda x: x IN ({stops})))::BIGINT AS n_stop_words,
    coalesce(n, 0)::BIGINT AS n_repeat_words
  FROM q_split LEFT JOIN q_covered USING (doc_id)),
q_judged AS (
  SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
    concat_ws(',', {broken}) AS broken FROM q_counts)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND broken = '' AS kept, broken
FROM q_judged"""


def chat_sql(source: str = "conversations") -> str:
    """Digests of what the formatted conversations of ``source`` and conversation -1 hold."""
    template = Template()
    opening, closing = (
        "CASE role " + " ".join(f"WHEN '{r[0]}' THEN '{r[k]}'" for r in template.roles) + f" ELSE {other} END"
        for k, other in (
            (1, f"'{template.other[0]}' || escaped_role || '{template.other[1]}'"), (2, f"'{template.other[2]}'")
        )
    )
    head, rest = template.inner
    escape = rf"regexp_replace({{}}, '{head}(\\*){rest}', '\1\\\2\3', 'g')"
    learned = ", ".join(f"'{r}'" for r in template.learned)
    return f"""
WITH c_rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM {source}
  UNION ALL SELECT -1, i, r, '</s>[INST] ok [/INST]' FROM (VALUES (0, 'user'), (1, 'assistant')) v(i, r)),
c_turns AS (
  SELECT *, {escape.format("text")} AS escaped, {escape.format("role")} AS escaped_role, role IN ({learned}) AS learned,
    row_number() OVER o AS n, lag(role) OVER o AS before, lead(role) OVER o AS following
  FROM c_rows WINDOW o AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)),
c_pieces AS (
  SELECT *, CASE WHEN before = role THEN '{template.between}' ELSE {opening} END || escaped
    || CASE WHEN following = role THEN '' ELSE {closing} END AS piece FROM c_turns)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY n)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (learned), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY n) FILTER (learned), '')) AS loss_sha256,
  sum(length(piece))::BIGINT AS formatted_chars
FROM c_pieces GROUP BY conv_id"""


def negatives_sql(source: str = "embeddings") -> str:
    """Every anchor against every row."""
    return f"""
WITH n_rows AS (
  SELECT vec_id, min((label, v)) AS one FROM (
    SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
      list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
    FROM {source} WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0) GROUP BY vec_id),
n_scores AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS id, a.one[1] = b.one[1] AS same,
    list_dot_product(a.one[2], b.one[2])::BIGINT AS score
  FROM n_rows a JOIN n_rows b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0),
n_positives AS (
  SELECT anchor_id, id, score FROM n_scores WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5)
SELECT p.anchor_id, p.id AS positive_id,
  row_number() OVER (PARTITION BY p.anchor_id, p.id ORDER BY s.score DESC, s.id)::INTEGER AS rank,
  s.id AS negative_id, p.score AS positive_score, s.score AS negative_score
FROM n_positives p JOIN n_scores s ON s.anchor_id = p.anchor_id AND NOT s.same
  AND 30 * p.score <= 100 * s.score AND 100 * s.score <= 90 * p.score
QUALIFY rank <= 10"""


def oracles() -> dict[str, str]:
    return {
        "op2_quality_rules": quality_sql(),
        "op11_chat_formatting": chat_sql(),
        "op13_hard_negatives": negatives_sql(),
    }
