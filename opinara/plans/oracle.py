"""DuckDB text of the corpus adapters, for the side-by-side check of every query."""

from __future__ import annotations

import re

from opinara.functions import text as t
from opinara.functions.lexicon import FALLBACK_SCORE, FALLBACK_TOPIC, SOURCE_RULES
from opinara.plans import corpus
from opinara.plans.vocabulary import LEXICON, TOPICS


def strip(x: str) -> str:
    return f"trim({x}, '{t.BLANK_CHARS}')"


def squeeze(x: str) -> str:
    return strip(f"regexp_replace({x}, '{t.BLANK}+', ' ', 'g')")


def quoted(words) -> str:
    return ", ".join("'" + w.replace("'", "''") + "'" for w in words)


def totals(side: dict[str, int], tokens: str = "tok") -> str:
    parts = []
    for weight in sorted(set(side.values())):
        group = quoted(w for w, n in side.items() if n == weight)
        parts.append(f"{weight} * len([w for w in {tokens} if w in ({group})])")
    return "(" + " + ".join(parts) + ")"


def tokens(x: str) -> str:
    return f"CASE WHEN length({strip(x)}) >= 10 THEN regexp_split_to_array(lower({x}), '{t.WORD_BREAK}') ELSE [] END"


def lexicon_cte(source: str, subject: str, columns: str, lexicon=LEXICON) -> str:
    """Rows of ``source`` with pos and neg totals over ``subject``."""
    return (
        f"SELECT {columns}, {totals(lexicon.positive)} AS pos, {totals(lexicon.negative)} AS neg "
        f"FROM (SELECT *, {tokens(subject)} AS tok FROM {source})"
    )


LADDER_LABEL = """CASE WHEN pos + neg = 0 THEN 'neutre'
  WHEN neg >= 3 AND neg / (pos + neg) >= 0.5 THEN 'negatif' WHEN pos >= 3 AND pos / (pos + neg) >= 0.5 THEN 'positif'
  WHEN neg / (pos + neg) > 0.6 AND neg >= 2 THEN 'negatif' WHEN pos / (pos + neg) > 0.6 AND pos >= 2 THEN 'positif'
  WHEN neg > pos THEN 'negatif' WHEN pos > neg THEN 'positif' ELSE 'neutre' END"""


def _step(side: str, start: str, slope: str, top: str) -> str:
    return f"least(0.5::DOUBLE + ({side}::DOUBLE / (pos + neg) - {start}::DOUBLE) * {slope}::DOUBLE, {top}::DOUBLE)"


LADDER_SCORE = f"""round_even(CASE WHEN pos + neg = 0 THEN 0.5::DOUBLE
  WHEN neg >= 3 AND neg / (pos + neg) >= 0.5 THEN {_step('neg', '0.5', '1.0', '0.95')}
  WHEN pos >= 3 AND pos / (pos + neg) >= 0.5 THEN {_step('pos', '0.5', '1.0', '0.95')}
  WHEN neg / (pos + neg) > 0.6 AND neg >= 2 THEN {_step('neg', '0.6', '1.25', '0.95')}
  WHEN pos / (pos + neg) > 0.6 AND pos >= 2 THEN {_step('pos', '0.6', '1.25', '0.95')}
  WHEN neg > pos THEN {_step('neg', '0.5', '0.8', '0.85')}
  WHEN pos > neg THEN {_step('pos', '0.5', '0.8', '0.85')} ELSE 0.5::DOUBLE END, 3)"""


def _topic_entries(topics=TOPICS) -> str:
    entries = []
    for place, (topic, keywords) in enumerate(topics.keywords.items()):
        hits = " + ".join(
            f"3 * contains(ft, '{k}')::INT + contains(fc, '{k}')::INT" for k in keywords
        )
        entries.append(
            f"{{'s': -least(({hits})::DOUBLE / {len(keywords)}, 1.0::DOUBLE), 'p': {place}, 't': '{topic}'}}"
        )
    return "[" + ", ".join(entries) + "]"


_RULE = "CASE " + " ".join(
    f"WHEN contains(lower(source), '{part}') THEN '{topic}'" for part, topic, _ in SOURCE_RULES
) + " END"

def topics_of(source: str, topics=TOPICS) -> str:
    """Rows of ``source`` with ``best``, their one or two best topics."""
    return f"""
SELECT *, CASE WHEN len(ranked) = 0 THEN [{{'s': -{FALLBACK_SCORE}::DOUBLE, 'p': 0, 't': '{FALLBACK_TOPIC}'}}] ELSE ranked END AS best
FROM (SELECT *, list_sort(CASE WHEN rule IS NULL THEN scored
  WHEN len([x for x in scored if x.t = rule]) > 0
  THEN [{{'s': CASE WHEN x.t = rule THEN least(x.s, -1.0::DOUBLE) ELSE x.s END, 'p': x.p, 't': x.t}} for x in scored]
  ELSE list_concat(scored, [{{'s': -1.0::DOUBLE, 'p': {len(topics.keywords)}, 't': rule}}]) END)[1:2] AS ranked
FROM (SELECT *, [x for x in {_topic_entries(topics)} if x.s < 0] AS scored, {_RULE} AS rule
FROM (SELECT *, strip_accents(lower(title)) AS ft, strip_accents(lower(content)) AS fc FROM {source})))"""


_SOURCE_NAME = "CASE source " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in corpus.SOURCE_NAMES.items()) + " ELSE source END"


def sanitized(x: str) -> str:
    return strip(f"nfc_normalize(regexp_replace({x}, '{t.REMOVED}', '', 'g'))")


def unescaped(x: str) -> str:
    """The entities that the documents' plain text holds."""
    for entity, character in (("&lt;", "<"), ("&gt;", ">"), ("&amp;", "&")):
        x = f"replace({x}, '{entity}', '{character}')"
    return x


def readable(sample: str) -> str:
    def count(pattern: str) -> str:
        return f"len(regexp_extract_all({sample}, '{pattern}'))"

    size = f"greatest(length({sample}), 1)"
    return f"""(length({sample}) >= 12 AND {count(chr(0xFFFD))} < 2
  AND (length({sample}) - {count(t.NOT_PRINTABLE)} + {count(' ')})::DOUBLE / {size} >= 0.88
  AND ({count(t.EXOTIC)} - {count(t.EXOTIC_BLANK)})::DOUBLE / {size} <= 0.12 AND {count('[^\\P{L}]')} >= 8)"""


def source_type(x: str) -> str:
    return (
        f"CASE WHEN contains(lower({x}), 'zzdb') THEN 'db_non_relational' "
        f"WHEN contains(lower({x}), 'kaggle') THEN 'flat_files' ELSE 'real_source' END"
    )


def _scored_run(run: str, day: str, where: str, subject: str) -> str:
    inner = lexicon_cte(f"(SELECT * FROM raw {where})", subject, "*")
    return f"""SELECT CAST(id AS VARCHAR) AS id, round_even(a_pos, 4) AS p_pos, round_even(a_neu, 4) AS p_neu,
  round_even(a_neg, 4) AS p_neg, round_even(greatest(a_pos, a_neu, a_neg), 4) AS confidence,
  round_even(a_pos - a_neg, 4) AS predicted_sentiment_score,
  CASE WHEN a_pos >= a_neu AND a_pos >= a_neg THEN 'POSITIVE' WHEN a_neu >= a_neg THEN 'NEUTRAL' ELSE 'NEGATIVE' END AS label_3c,
  CASE WHEN a_pos >= a_neu AND a_pos >= a_neg THEN 'positif' WHEN a_neu >= a_neg THEN 'neutre' ELSE 'negatif' END AS predicted_sentiment,
  CAST(floor(length(content) / 10) AS INTEGER) AS inference_ms, title, 'lexicon-1' AS model_version,
  '{run}' AS run, DATE '{day}' AS date FROM (SELECT *, (pos + 0.5::DOUBLE) / (pos + neg + 1.5::DOUBLE) AS a_pos,
  0.5::DOUBLE / (pos + neg + 1.5::DOUBLE) AS a_neu, (neg + 0.5::DOUBLE) / (pos + neg + 1.5::DOUBLE) AS a_neg FROM ({inner}))"""


_BOTH = "title || ' ' || content"
CTES = {
    "articles": f"""SELECT doc_id AS id, split_part(text, chr(10), 1) AS title, text AS content, {_SOURCE_NAME} AS source,
  'https://' || source || '.example/' || doc_id AS url, lang,
  TIMESTAMP '2024-01-01' + to_days(CAST(doc_id % 30 AS INTEGER)) AS collected_at,
  CAST(TIMESTAMP '2024-01-01' + to_days(CAST(doc_id % 30 AS INTEGER)) AS DATE) AS date FROM documents""",
    "sources": f"""SELECT source_id, name, {source_type('name')} AS source_type, source_id % 5 <> 4 AS active,
  lower(name) LIKE 'zzdb%' AS is_synthetic
  FROM (SELECT DISTINCT CAST(regexp_extract(source, '(\\d+)$', 1) AS BIGINT) AS source_id, {_SOURCE_NAME} AS name FROM documents)""",
    "landed": "SELECT *, sha256(lower(title || '|' || content)) AS fingerprint FROM articles",
    "raw": f"""SELECT *, CASE WHEN contains(lower(source), 'zzdb') THEN 0.3::DOUBLE ELSE 0.5::DOUBLE END AS quality_score,
  {source_type('source')} AS source_type, lower(source) LIKE 'zzdb%' AS is_synthetic FROM landed
  WHERE length({strip('title')}) > 3 AND length({strip('content')}) > 10
  QUALIFY row_number() OVER (PARTITION BY fingerprint ORDER BY id) = 1""",
    "clean": f"SELECT id, source, {sanitized('title')} AS title, {squeeze(unescaped(sanitized('content')))} AS content FROM articles",
    "clean_raw": f"""SELECT * FROM clean WHERE length({strip('title')}) > 3 AND length({strip('content')}) > 10
  QUALIFY row_number() OVER (PARTITION BY sha256(lower(title || '|' || content)) ORDER BY id) = 1""",
    "clean_topic": topics_of("clean_raw"),
    "clean_pass": lexicon_cte("clean_raw", _BOTH, "id, source"),
    "topic_of": topics_of("raw"),
    "topic_links": """SELECT id * 2 + i - 1 AS doc_topic_id, id AS raw_data_id, date, best[i].t AS topic, -best[i].s AS confidence_score,
  CASE WHEN len(ranked) = 0 THEN 'keyword_default' WHEN i = 1 AND best[1].t = rule AND best[1].s = -1 THEN 'source_rule' ELSE 'keyword' END AS tagger
  FROM (SELECT *, unnest(range(1, len(best) + 1)) AS i FROM topic_of) WHERE i = 1 OR -best[i].s >= 0.03""",
    "document_topic": f"SELECT doc_topic_id, raw_data_id, topic, confidence_score, tagger FROM topic_links WHERE date < DATE '{corpus.TAGGED_BEFORE}'",
    "topics": "SELECT * FROM (VALUES "
    + ", ".join(f"({i}, '{n}')" for i, n in enumerate([*TOPICS.keywords, FALLBACK_TOPIC], 1))
    + ") v(topic_id, name)",
    "pass_title": lexicon_cte(f"(SELECT * FROM raw WHERE date < DATE '{corpus.SCORED_BEFORE}')", "title", "id, date"),
    "pass_text": lexicon_cte(f"(SELECT * FROM raw WHERE date < DATE '{corpus.SCORED_BEFORE}')", _BOTH, "id, date"),
    "pass_all": lexicon_cte("raw", _BOTH, "id"),
    "model_output": f"""SELECT id * 2 AS output_id, id AS raw_data_id, 'sentiment_keyword' AS model_name, {LADDER_LABEL} AS label,
  {LADDER_SCORE} AS score, CAST(date AS TIMESTAMP) AS created_at FROM pass_title
  UNION ALL SELECT id * 2 + 1, id, 'sentiment_keyword', {LADDER_LABEL}, {LADDER_SCORE}, CAST(date + 1 AS TIMESTAMP) FROM pass_text
  UNION ALL SELECT CAST(id AS BIGINT) + 1000000000000, CAST(id AS BIGINT), 'sentiment_scorer', predicted_sentiment, confidence,
  CAST(date AS TIMESTAMP) FROM predictions WHERE run = '{corpus.RUN_2}'""",
    "latest_output": """SELECT raw_data_id AS id, label AS sentiment, score AS sentiment_score FROM model_output
  WHERE model_name = 'sentiment_keyword' QUALIFY row_number() OVER (PARTITION BY raw_data_id ORDER BY output_id DESC) = 1""",
    "topic_ranked": """SELECT *, row_number() OVER (PARTITION BY raw_data_id ORDER BY confidence_score DESC, doc_topic_id) AS rank
  FROM document_topic""",
    "silver": """SELECT r.*, coalesce(a.topic, '') AS topic_1, coalesce(a.confidence_score, 0.0::DOUBLE) AS topic_1_score,
  coalesce(b.topic, '') AS topic_2, coalesce(b.confidence_score, 0.0::DOUBLE) AS topic_2_score FROM raw r
  LEFT JOIN topic_ranked a ON a.raw_data_id = r.id AND a.rank = 1
  LEFT JOIN topic_ranked b ON b.raw_data_id = r.id AND b.rank = 2""",
    "gold": """SELECT s.*, coalesce(o.sentiment, 'neutre') AS sentiment, coalesce(o.sentiment_score, 0.5::DOUBLE) AS sentiment_score
  FROM silver s LEFT JOIN latest_output o USING (id)""",
    "predictions": " UNION ALL ".join(
        (
            _scored_run(corpus.RUN_1, "2024-02-01", "", "title"),
            _scored_run(corpus.RUN_2, "2024-02-02", "", _BOTH),
            _scored_run(corpus.RUN_3, "2024-02-02", "WHERE lang = 'de'", _BOTH),
        )
    ),
    "latest_run": f"SELECT * FROM predictions WHERE run = '{corpus.RUN_2}'",
    "labelled": """SELECT p.id, CASE WHEN l.toxic = 1 THEN 'negatif' WHEN l.quality = 1 THEN 'positif' ELSE 'neutre' END AS y_true,
  p.predicted_sentiment AS y_pred, p.p_neg, p.p_neu, p.p_pos FROM labels l JOIN latest_run p ON p.id = CAST(l.doc_id AS VARCHAR)""",
    "sync_log": """SELECT event_id AS sync_log_id, user_id % 20 AS source_id, ts AS sync_date, CAST(floor(value) AS BIGINT) AS rows_synced,
  CASE event_type WHEN 'error' THEN 'ERROR' WHEN 'signup' THEN 'FOUNDATION_INTEGRATED' ELSE 'OK' END AS status FROM events""",
    "audit_log": """SELECT event_id AS action_log_id, user_id AS profil_id, event_type AS action_type,
  CASE WHEN k < 50 THEN 'article' ELSE 'report' END AS resource_type, CASE WHEN k >= 20 THEN k END AS resource_id,
  ts AS action_date, CASE WHEN value < 30 THEN '10.0.0.' || user_id END AS ip_address
  FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events)""",
    "accounts": "SELECT c_custkey AS profil_id, c_name AS username, c_mktsegment AS role FROM customer",
    "runs": """SELECT *, CASE WHEN errors > 35 OR loaded < 900 THEN 'WARN' ELSE 'PASS' END AS status,
  list_filter([CASE WHEN errors > 35 THEN 'source errors' END, CASE WHEN loaded < 900 THEN 'loaded below threshold' END],
  lambda x: x IS NOT NULL) AS reasons
  FROM (SELECT time_bucket(INTERVAL 12 HOURS, ts) AS generated_at,
  CAST(sum(CASE WHEN event_type = 'purchase' THEN floor(value) ELSE 0 END) AS BIGINT) AS loaded,
  CAST(sum(CASE WHEN event_type = 'error' THEN 1 ELSE 0 END) AS BIGINT) AS errors FROM events GROUP BY 1)""",
}


def _needed(sql: str, found: dict[str, None]) -> None:
    for name, body in CTES.items():
        if name not in found and re.search(rf"\b(?:FROM|JOIN)\s*\(?\s*{name}\b", sql):
            _needed(body, found)
            found[name] = None


def with_inputs(sql: str) -> str:
    """``sql`` preceded by the adapters it reads, in dependency order."""
    found: dict[str, None] = {}
    _needed(sql, found)
    if not found:
        return sql
    ctes = ",\n".join(f"{name} AS MATERIALIZED ({CTES[name]})" for name in found)
    glue = re.match(r"\s*WITH\b", sql)
    return f"WITH {ctes}{',' if glue else ''}\n{sql[glue.end():] if glue else sql}"
