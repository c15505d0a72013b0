"""The same results as DuckDB SQL, for the queries that SQL can express.

Fingerprints, language and toxicity models, keyed surrogates, the crc of a text and the
latent search have no SQL form; their tests compare them with plain versions.
"""

from __future__ import annotations

from reachmart.llm import mixing, quality

_WORDS = r"list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '')"


def _text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


# A word goes if a window that covers it also starts in a document with a smaller id.
OP4 = f"""
WITH docs AS (SELECT row_number() OVER () AS uid, doc_id, {_WORDS} AS words FROM documents),
starts AS (
  SELECT uid, doc_id, words, unnest(generate_series(1, len(words) - 49)) AS pos FROM docs WHERE len(words) >= 50
),
windows AS (SELECT uid, doc_id, pos, sha256(array_to_string(list_slice(words, pos, pos + 49), ' ')) AS w FROM starts),
marked AS (SELECT uid, pos, doc_id > min(doc_id) OVER (PARTITION BY w) AS later FROM windows),
covered AS (SELECT DISTINCT uid, unnest(generate_series(pos, pos + 49)) AS pos FROM marked WHERE later),
gone AS (SELECT uid, list(pos) AS gone FROM covered GROUP BY uid),
kept AS (
  SELECT doc_id, words,
    list_filter(list_zip(words, range(1, len(words) + 1)), lambda p: gone IS NULL OR NOT list_contains(gone, p[2])) AS left_over
  FROM docs LEFT JOIN gone USING (uid)
)
SELECT doc_id, len(words) AS n_words, len(words) - len(left_over) AS n_removed,
  sha256(array_to_string(list_transform(left_over, lambda p: p[1]), ' ')) AS kept_sha256
FROM kept
"""

# The digest's 40 hexadecimal digits as 160 bits, then as 32 digits of base 32.
OP7 = """
WITH pages_of AS (SELECT page_id, coalesce(html, '') AS payload FROM pages),
bits AS (
  SELECT page_id, payload, max(page_id) OVER (PARTITION BY payload) AS head,
    array_to_string(list_transform(string_split(sha1(payload), ''), lambda c: lpad(bin(instr('0123456789abcdef', c) - 1), 4, '0')), '') AS bits
  FROM pages_of
)
SELECT page_id, strlen(payload) AS payload_bytes,
  array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    1 + list_sum(list_transform(range(0, 5), lambda k: CAST(substr(bits, CAST(5 * i + k + 1 AS BIGINT), 1) AS BIGINT) << (4 - k)))::BIGINT, 1)), '')
    AS payload_digest,
  CASE WHEN page_id = head THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> head THEN head END AS refers_to, CAST(NULL AS VARCHAR) AS problem
FROM bits
"""


def op8(budget: float, power: float, sweeps: int) -> str:
    """Each scaling of one dimension is a step; so is each search for full cells."""
    topics = " ".join(
        "WHEN " + " OR ".join(f"contains(text, {_text(p)})" for p in phrases) + f" THEN '{name}'"
        for name, phrases in mixing.TOPICS
    )
    dims = ["source", "lang", "topic"]
    key = "coalesce('=' || {0}, '') AS k_{0}"
    steps = [
        f"""docs AS (SELECT doc_id, text, source, lang, CASE {topics} ELSE '{mixing.OTHER_TOPIC}' END AS topic,
          len({_WORDS}) AS n_tokens FROM documents)""",
        f"marked AS (SELECT *, {', '.join(key.format(d) for d in dims)} FROM docs)",
        "cells AS (SELECT k_source, k_lang, k_topic, sum(n_tokens)::DOUBLE AS tokens FROM marked GROUP BY ALL HAVING sum(n_tokens) > 0)",
    ]
    for d in dims:
        steps.append(
            f"""target_{d} AS (SELECT k_{d}, w / sum(w) OVER () AS target FROM (
              SELECT k_{d}, pow(sum(tokens) / (SELECT sum(tokens) FROM cells), {power}) AS w FROM cells GROUP BY 1))"""
        )
    before = "raked0"
    steps.append("raked0 AS (SELECT *, tokens / (SELECT sum(tokens) FROM cells) AS share FROM cells)")
    for i in range(sweeps):
        for d in dims:
            name = f"raked{i}_{d}"
            steps.append(
                f"""{name} AS MATERIALIZED (SELECT r.* REPLACE (share * target / sum(share) OVER (PARTITION BY r.k_{d}) AS share)
                  FROM {before} r JOIN target_{d} t ON r.k_{d} = t.k_{d})"""
            )
            before = name
    wanted = f"{budget!r} * (SELECT sum(tokens) FROM cells)"
    steps.append(f"weighted AS (SELECT *, {wanted} * share / tokens AS weight FROM {before})")
    steps.append("scale0 AS (SELECT 1.0::DOUBLE AS s)")
    for i in range(8):
        steps.append(
            f"""scale{i + 1} AS MATERIALIZED (SELECT coalesce(({wanted} - sum(CASE WHEN weight * s >= 1 THEN tokens ELSE 0 END))
              / nullif({wanted} * sum(CASE WHEN weight * s >= 1 THEN 0 ELSE share END), 0), any_value(s)) AS s
              FROM weighted, scale{i})"""
        )
    draw = "('0x' || substr(md5('mix:' || coalesce(doc_id::VARCHAR, md5(coalesce(text, '')))), 1, 13))::BIGINT / 4503599627370496.0"
    return f"""
WITH {", ".join(steps)},
chances AS (
  SELECT m.*, CASE WHEN n_tokens > 0 THEN weight ELSE 0 END AS w,
    CASE WHEN n_tokens > 0 THEN least(1.0, weight * s) ELSE 0 END AS p
  FROM marked m LEFT JOIN weighted c USING (k_source, k_lang, k_topic), scale8
)
SELECT doc_id, source, lang, topic, n_tokens, round(w, 6) AS weight, round(p, 6) AS probability, {draw} < p AS sampled
FROM chances
"""


def op9() -> str:
    forms = [f for p in quality.BOILERPLATE for f in dict.fromkeys((p, p.capitalize(), p.title(), p.upper()))]
    furniture = " OR ".join(f"contains(l, {_text(f)})" for f in forms)
    endings = ", ".join(_text(e) for e in quality.ENDINGS)
    blanks = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
    filled = r"regexp_matches(l, '[^\x20\x09-\x0D]')"
    marks = _text(quality.MARKS)
    return f"""
WITH docs AS (
  SELECT row_number() OVER () AS uid, doc_id, coalesce(text, '') AS t, {_WORDS} AS words,
    string_split(coalesce(text, ''), chr(10)) AS lines FROM documents
),
starts AS (SELECT uid, words, unnest(generate_series(1, len(words) - 7)) AS pos FROM docs WHERE len(words) >= 8),
windows AS (SELECT uid, pos, array_to_string(list_slice(words, pos, pos + 7), ' ') AS w FROM starts),
marked AS (SELECT uid, pos, count(*) OVER (PARTITION BY uid, w) AS n FROM windows),
covered AS (SELECT DISTINCT uid, unnest(generate_series(pos, pos + 7)) AS pos FROM marked WHERE n > 1),
repeats AS (SELECT uid, count(*) AS n FROM covered GROUP BY uid),
counted AS (
  SELECT doc_id, t, len(words) AS n_words, length(array_to_string(words, '')) AS word_chars,
    len(regexp_extract_all(t, '{quality.SYMBOLS}')) AS n_symbols,
    len(list_filter(lines, lambda l: {filled})) - len(list_distinct(list_filter(lines, lambda l: {filled}))) AS n_dup_lines,
    coalesce(n, 0) AS n_repeat_words,
    coalesce(list_sum(list_transform(list_filter(lines, lambda l: {filled} AND NOT (
      right(rtrim(l, {blanks}), 1) IN ({endings})
      AND NOT len(regexp_extract_all(l, {marks})) * 25 > length(l) AND NOT ({furniture}))), lambda l: length(l))), 0) AS lost_chars
  FROM docs LEFT JOIN repeats USING (uid)
),
judged AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM counted)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words::BIGINT AS n_repeat_words, base_failed,
  NOT base_failed AND lost_chars <= length(t) * 0.5 AS kept, lost_chars::BIGINT AS lost_chars
FROM judged
"""


# Every anchor against every row; windows by cross-multiplied integers.
OP11 = """
WITH vectors AS (
  SELECT row_number() OVER () AS uid, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label::BIGINT + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
scored AS (
  SELECT a.uid, a.vec_id AS anchor_id, b.uid AS other, b.vec_id AS other_id, a.label = b.label AS same,
    coalesce(list_sum(list_transform(list_zip(a.v, b.v), lambda p: p[1] * p[2])), 0)::BIGINT AS score
  FROM vectors a JOIN vectors b ON a.vec_id % 100 = 0 AND a.uid <> b.uid
),
positives AS (
  SELECT uid, anchor_id, other_id AS positive_id, score AS positive_score,
    row_number() OVER (PARTITION BY uid ORDER BY score DESC, other_id NULLS LAST) AS positive
  FROM scored WHERE same QUALIFY positive <= 5
),
ranked AS (
  SELECT p.*, n.other_id AS negative_id, n.score AS negative_score,
    row_number() OVER (PARTITION BY p.uid, positive ORDER BY n.score DESC, n.other_id NULLS LAST) AS rank
  FROM positives p JOIN scored n ON p.uid = n.uid AND NOT n.same
    AND 30 * positive_score <= 100 * n.score AND 100 * n.score <= 90 * positive_score
)
SELECT anchor_id, positive_id, rank::INTEGER AS rank, negative_id, positive_score, negative_score, positive::INTEGER AS positive
FROM ranked WHERE rank <= 10
"""

SQL: dict[str, str] = {
    "op4_repeated_windows": OP4,
    "op7_warc_segments": OP7,
    "op8_mixture": op8(budget=0.3, power=0.8, sweeps=8),
    "op9_line_quality": op9(),
    "op11_hard_negatives": OP11,
}
