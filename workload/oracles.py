"""The same results in plain SQL, for the queries that SQL can express."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from threadlake.operators.sentiment import (
    AFTER_BUT,
    BEFORE_BUT,
    CAPITALS_STEP,
    NEGATION_FACTOR,
    NEVER_SO_FACTOR,
)
from threadlake.sources.readers import days_before
from workload import views
from workload.views import TARGET_DATE, WINDOW_DAYS

FIRST_DATE = days_before(TARGET_DATE, WINDOW_DAYS)[0]


def _words(words: Iterable[str]) -> str:
    return ", ".join("'" + word.replace("'", "''") + "'" for word in words)


def _values(table: Mapping[str, float]) -> str:
    rows = ", ".join(f"('{word}', CAST({value} AS DOUBLE))" for word, value in table.items())
    return f"(VALUES {rows})"


OBS = """
daily AS (
    SELECT user_id AS id, strftime(ts, '%Y-%m-%d') AS ingestion_date,
           CAST(sum(CAST(floor(value) AS BIGINT)) AS BIGINT) AS score,
           count(*) FILTER (WHERE event_type IN ('click', 'view')) AS descendants,
           min(ts) AS first_ts
    FROM events GROUP BY 1, 2
),
obs AS (
    SELECT id, ingestion_date, score, descendants,
           min(first_ts) OVER (PARTITION BY id) AS created
    FROM daily
)"""

ENGAGEMENT = f"""{OBS},
measured AS (
    SELECT *,
           coalesce(score - lag(score) OVER by_date, 0) AS score_velocity,
           coalesce(descendants - lag(descendants) OVER by_date, 0) AS comment_velocity,
           count(*) OVER (PARTITION BY id) AS observations_in_window,
           first_value(ingestion_date) OVER (
               PARTITION BY id ORDER BY score DESC, ingestion_date
               ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS peak
    FROM obs
    WHERE ingestion_date BETWEEN '{FIRST_DATE}' AND '{TARGET_DATE}'
    WINDOW by_date AS (PARTITION BY id ORDER BY ingestion_date)
),
engagement AS (
    SELECT id, ingestion_date, score, descendants, score_velocity, comment_velocity,
           observations_in_window,
           greatest(CAST(0 AS DOUBLE), round_even(
               (epoch_us(CAST(peak AS TIMESTAMP)) - epoch_us(created)) / CAST(3.6e9 AS DOUBLE), 2
           )) AS hours_to_peak,
           (epoch_us(CAST(ingestion_date AS TIMESTAMP)) - epoch_us(created))
               / CAST(3.6e9 AS DOUBLE) > 48 AND comment_velocity > 0 AS is_long_tail
    FROM measured
    WHERE ingestion_date = '{TARGET_DATE}'
)"""

LOOSE = """
loose AS (
    SELECT event_id AS id, 'comment' AS type, CAST(epoch(ts) AS BIGINT) AS time_s, ts,
           CASE WHEN value = floor(value) THEN CAST(value AS BIGINT) END AS whole
    FROM events
)"""

REPLIES = """
replies AS (
    SELECT -(conv_id * 1000 + turn) - 1 AS id,
           CASE WHEN turn = 0 THEN conv_id ELSE -(conv_id * 1000 + turn - 1) - 1 END AS parent,
           role, text, conv_id, turn
    FROM conversations
)"""

KNOWN = f"""{REPLIES},
known AS (SELECT doc_id AS id FROM labels UNION SELECT id FROM replies)"""

TRACKING = f"""{OBS},
state AS (
    SELECT id AS story_id, min(ingestion_date) AS first_seen,
           max(ingestion_date) AS last_updated,
           arg_max(score, ingestion_date) AS last_score,
           arg_max(descendants, ingestion_date) AS last_descendants
    FROM obs WHERE ingestion_date < '{TARGET_DATE}' GROUP BY id
),
metrics AS (
    SELECT id AS story_id, score, descendants FROM obs WHERE ingestion_date = '{TARGET_DATE}'
),
fresh AS (
    SELECT doc_id AS story_id FROM labels WHERE doc_id NOT IN (SELECT story_id FROM state)
)"""

EVENT_ITEMS = """
items AS (
    SELECT event_id AS id, CASE WHEN event_type = 'view' THEN 'story' ELSE event_type END AS type,
           ts
    FROM events
)"""

TOKEN = r"[\p{L}\p{N}_]{2,}"

TERMS = f"""
tokens AS (
    SELECT doc_id, unnest(regexp_extract_all(lower(text), '{TOKEN}')) AS term FROM documents
),
kept AS (SELECT * FROM tokens WHERE term NOT IN ({_words(views.STOP_WORDS)}))"""


def _vocabulary(source: str, count: str) -> str:
    return f"""
vocab AS (
    SELECT term, count(*) AS tf, count(DISTINCT doc_id) AS df, ({count}) AS n,
           ln((1 + ({count})) / (1 + count(DISTINCT doc_id))) + 1 AS idf
    FROM {source} GROUP BY term ORDER BY tf DESC, term LIMIT 100
),
ranked AS (
    SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY weight DESC, term DESC) AS place
    FROM (
        SELECT k.doc_id, k.term, count(*) * any_value(v.idf) AS weight
        FROM {source} k JOIN vocab v ON k.term = v.term
        GROUP BY k.doc_id, k.term
    )
),
topics AS (
    SELECT doc_id, string_agg(term, ',' ORDER BY place) AS dominant_topics
    FROM ranked WHERE place <= 3 GROUP BY doc_id
)"""


ALL_TOPICS = TERMS + "," + _vocabulary("kept", "SELECT count(*) FROM documents")

# The documents of the target day's ids only.
DAY_TOPICS = f"""{ENGAGEMENT},{TERMS},
day_terms AS (SELECT * FROM kept WHERE doc_id IN (SELECT id FROM engagement)),
{_vocabulary("day_terms", "SELECT count(*) FROM engagement JOIN documents ON id = doc_id")},
stories AS (
    SELECT e.*, d.source || ' ' || d.lang AS title, t.dominant_topics
    FROM engagement e JOIN documents d ON e.id = d.doc_id
    LEFT JOIN topics t ON e.id = t.doc_id
)"""

SPACES = r"[\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+"
# The entities that occur in the given tables; the semicolon may be missing.
ENTITIES = [("&lt;?", "<"), ("&gt;?", ">"), ("&quot;?", '"'), ("&copy;?", "©"), ("&middot;?", "·"), ("&amp;?", "&")]


def _clean(column: str) -> str:
    sql = f"regexp_replace(coalesce({column}, ''), '<[^>]+>', ' ', 'g')"
    for entity, character in ENTITIES:
        sql = f"regexp_replace({sql}, '{entity}', '{character}', 'g')"
    return f"trim(regexp_replace({sql}, '{SPACES}', ' ', 'g'))"


PUNCTUATION = r"[!-/:-@\[-`{-~]+"


def _spelled(sql: str, emoji: Mapping[str, str]) -> str:
    for symbol, name in emoji.items():
        sql = f"replace({sql}, '{symbol}', ' {name} ')"
    return f"trim(regexp_replace({sql}, ' +', ' ', 'g'))" if emoji else sql


def _phrased(key: str, phrases: Iterable[str]) -> str:
    """``phrased(key, pos, shown)``: the bare words, with phrases as single ones.

    Words stand between two control characters each; the longest phrases are joined first.
    """
    sql = "string_agg(chr(30) || shown || chr(31), '' ORDER BY pos)"
    for phrase in sorted(phrases, key=lambda p: -len(p.split())):
        parts = phrase.split()
        found = r"\x1f\x1e".join(f"({part})" for part in parts)
        joined = " ".join(rf"\{n + 1}" for n in range(len(parts)))
        sql = rf"regexp_replace({sql}, '\x1e{found}\x1f', chr(30) || '{joined}' || chr(31), 'gi')"
    return f"""
joined AS (SELECT {key}, string_split(trim({sql}, chr(30) || chr(31)), chr(31) || chr(30)) AS parts
           FROM bare_words GROUP BY {key}),
phrased AS (SELECT {key}, unnest(parts) AS shown, unnest(range(1, len(parts) + 1)) AS pos FROM joined)"""


def _sentiment(
    source: str, key: str, phrases: Mapping[str, float] | None = None, emoji: Mapping[str, str] | None = None
) -> str:
    """``scored(key, sentiment_score, sentiment_label)`` with the rules step by step.

    Words are rows here; the three before a word come from window functions.
    """
    lexicon = {**views.LEXICON, **(phrases or {})}
    merged = f",{_phrased(key, phrases)}" if phrases else ""

    def prior(column: str, default: str) -> str:
        return ", ".join(
            f"lag({column}, {back}, {default}) OVER w AS {column}{back}" for back in (1, 2, 3)
        )

    def degree(value: str, back: int, factor: float) -> str:
        return f"""CASE WHEN degree{back} = 0 THEN {value} ELSE {value} + {factor} * (
            degree{back} * CASE WHEN {value} < 0 THEN -1 ELSE 1 END
            + CASE WHEN caps{back} AND mixed
                   THEN CASE WHEN {value} > 0 THEN {CAPITALS_STEP} ELSE -{CAPITALS_STEP} END
                   ELSE 0 END) END"""

    def negates(back: int) -> str:
        return (
            f"(word{back} IN ({_words(views.NEGATIONS)}) OR contains(word{back}, 'n''t'))"
        )

    return f"""
cleaned AS (SELECT {key}, {_spelled(_clean('text'), emoji or {})} AS clean FROM {source}),
raw_words AS (
    SELECT {key}, unnest(string_split(clean, ' ')) AS raw,
           unnest(range(1, len(string_split(clean, ' ')) + 1)) AS pos
    FROM cleaned WHERE clean <> ''
),
bare_words AS (
    SELECT {key}, pos,
           CASE WHEN length(regexp_replace(raw, '^{PUNCTUATION}|{PUNCTUATION}$', '', 'g')) > 2
                THEN regexp_replace(raw, '^{PUNCTUATION}|{PUNCTUATION}$', '', 'g')
                ELSE raw END AS shown
    FROM raw_words
){merged},
facts AS (
    SELECT b.{key}, b.pos, lower(b.shown) AS word,
           b.shown = upper(b.shown) AND b.shown <> lower(b.shown) AS caps,
           l.valence, l.valence IS NOT NULL AS known, coalesce(d.degree, 0) AS degree
    FROM {"phrased" if phrases else "bare_words"} b
    LEFT JOIN {_values(lexicon)} l(term, valence) ON lower(b.shown) = l.term
    LEFT JOIN {_values(views.DEGREES)} d(term, degree) ON lower(b.shown) = d.term
),
around AS (
    SELECT *, {prior('word', "''")}, {prior('known', 'true')}, {prior('degree', '0')},
           {prior('caps', 'false')},
           lead(word, 1, '') OVER w AS next_word, lead(known, 1, false) OVER w AS next_known,
           bool_or(caps) OVER (PARTITION BY {key}) AND bool_or(NOT caps) OVER (PARTITION BY {key})
               AS mixed,
           min(CASE WHEN word = '{views.CONTRAST}' THEN pos END) OVER (PARTITION BY {key}) AS turn
    FROM facts
    WINDOW w AS (PARTITION BY {key} ORDER BY pos)
),
v0 AS (
    SELECT *,
        CASE WHEN word1 = 'no' OR word2 = 'no' OR (word3 = 'no' AND word1 IN ('or', 'nor'))
                  THEN valence * {NEGATION_FACTOR}
             WHEN word = 'no' AND next_known THEN 0
             ELSE valence END
        + CASE WHEN mixed AND caps
               THEN CASE WHEN valence > 0 THEN {CAPITALS_STEP} ELSE -{CAPITALS_STEP} END
               ELSE 0 END AS val0
    FROM around
    WHERE known AND degree = 0 AND NOT (word = 'kind' AND next_word = 'of')
),
d1 AS (SELECT *, {degree('val0', 1, 1.0)} AS s1 FROM v0),
v1 AS (
    SELECT *, CASE WHEN known1 THEN val0 WHEN {negates(1)} THEN s1 * {NEGATION_FACTOR}
                   ELSE s1 END AS val1
    FROM d1
),
d2 AS (SELECT *, {degree('val1', 2, 0.95)} AS s2 FROM v1),
v2 AS (
    SELECT *, CASE WHEN known2 THEN val1
                   WHEN word2 = 'never' AND word1 IN ('so', 'this') THEN s2 * {NEVER_SO_FACTOR}
                   WHEN word2 = 'without' AND word1 = 'doubt' THEN s2
                   WHEN {negates(2)} THEN s2 * {NEGATION_FACTOR}
                   ELSE s2 END AS val2
    FROM d2
),
d3 AS (SELECT *, {degree('val2', 3, 0.9)} AS s3 FROM v2),
v3 AS (
    SELECT *, CASE WHEN known3 THEN val2
                   WHEN word3 = 'never' AND (word2 IN ('so', 'this') OR word1 IN ('so', 'this'))
                       THEN s3 * {NEVER_SO_FACTOR}
                   WHEN word3 = 'without' AND (word2 = 'doubt' OR word1 = 'doubt') THEN s3
                   WHEN {negates(3)} THEN s3 * {NEGATION_FACTOR}
                   ELSE s3 END AS val3
    FROM d3
),
valued AS (
    SELECT {key}, sum(
        CASE WHEN word1 = 'least' AND NOT known1 AND word2 NOT IN ('at', 'very')
             THEN val3 * {NEGATION_FACTOR} ELSE val3 END
        * CASE WHEN pos < turn THEN {BEFORE_BUT} WHEN pos > turn THEN {AFTER_BUT} ELSE 1 END
    ) AS total
    FROM v3 GROUP BY {key}
),
summed AS (
    SELECT c.{key}, coalesce(v.total, 0) + sign(coalesce(v.total, 0)) * (
        least(length(clean) - length(replace(clean, '!', '')), 4) * 0.292
        + CASE WHEN length(clean) - length(replace(clean, '?', '')) <= 1 THEN 0
               WHEN length(clean) - length(replace(clean, '?', '')) <= 3
                   THEN (length(clean) - length(replace(clean, '?', ''))) * 0.18
               ELSE 0.96 END) AS total
    FROM cleaned c LEFT JOIN valued v ON c.{key} = v.{key}
),
compound AS (
    SELECT {key}, round(CAST(total / sqrt(total * total + 15) AS DOUBLE), 4) AS sentiment_score
    FROM summed
),
scored AS (
    SELECT {key}, sentiment_score,
           CASE WHEN sentiment_score >= 0.05 THEN 'positive'
                WHEN sentiment_score <= -0.05 THEN 'negative'
                ELSE 'neutral' END AS sentiment_label
    FROM compound
)"""


REPLY_SENTIMENT = f"{REPLIES},{_sentiment('replies', 'id')}"

# Conversations whose story is labelled: what is left once orphans, and replies
# to them, and so on, are gone.
KEPT_REPLIES = f"""{REPLIES},
kept_replies AS (SELECT * FROM replies WHERE conv_id IN (SELECT doc_id FROM labels))"""


def _check(name, severity, affected, sample, source):
    """One row of the check table. ``sample`` selects ``id`` in order."""
    return f"""
SELECT '{name}' AS name, affected = 0 AS passed, '{severity}' AS severity,
       affected AS affected_records, coalesce(sample, '') AS sample_ids
FROM (SELECT CAST({affected} AS BIGINT) AS affected FROM {source}),
     (SELECT string_agg(CAST(id AS VARCHAR), ',' ORDER BY id) AS sample
      FROM ({sample} ORDER BY id LIMIT 10))"""


LABELLED = "(SELECT d.doc_id AS id, quality FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)"
REPEATED = """(SELECT *, count(*) OVER (PARTITION BY l_orderkey, l_linenumber) AS n FROM lineitem)"""


def _line_check(name, severity, bad, source="lineitem"):
    return _check(
        name, severity, f"count(*) FILTER (WHERE {bad})",
        f"SELECT l_orderkey AS id FROM {source} WHERE {bad}", source,
    )


SUITE = " UNION ALL ".join(
    f"({check})"
    for check in (
        _line_check("check_not_null", "critical", "l_orderkey IS NULL OR l_linenumber IS NULL OR l_shipdate IS NULL"),
        _line_check("check_unique", "critical", "n > 1", REPEATED),
        _line_check("check_range", "warning", "l_quantity < 1 OR l_quantity > 50"),
        _line_check("check_range", "warning", "l_discount > 0.05"),
        _line_check("check_referential_integrity", "critical", "NOT EXISTS (SELECT 1 FROM orders WHERE o_orderkey = l_orderkey)"),
        _check("check_not_null", "warning", "count(*)", "SELECT l_orderkey AS id FROM lineitem WHERE false", "lineitem"),
        _check("check_volume", "warning", "greatest(0, 1 - count(*))", "SELECT l_orderkey AS id FROM lineitem WHERE false", "lineitem"),
    )
)

def _suite_of(source: str, checks: list[tuple[str, str, str]]) -> str:
    """A suite over the rows of ``source`` (with ``id``): name, severity and what is bad."""
    return " UNION ALL ".join(
        "(" + _check(name, severity, f"count(*) FILTER (WHERE {bad})", f"SELECT id FROM {source} WHERE {bad}", source) + ")"
        for name, severity, bad in checks
    )


def _nulls(*columns: str) -> str:
    return " OR ".join(f"{column} IS NULL" for column in columns)


SUITE_STORIES = """stories AS (
    SELECT doc_id AS id, source AS type, CASE WHEN n_chars > 100 THEN n_chars END AS time, n_chars - 500 AS score,
           length(text) - 200 AS descendants, lang AS ingestion_date,
           count(*) OVER (PARTITION BY doc_id, lang) AS n FROM documents)"""
SUITE_COMMENTS = """comments AS (
    SELECT conv_id AS id, role AS type, turn AS time, conv_id AS parent, role AS ingestion_date,
           count(*) OVER (PARTITION BY conv_id, role) AS n FROM conversations)"""

ORACLES = {
    "suite_of_stories": f"""WITH {SUITE_STORIES} {_suite_of("stories", [
        ("check_not_null", "critical", _nulls("id", "type", "time", "ingestion_date")),
        ("check_unique", "critical", "n > 1"),
        ("check_range", "warning", "score < 0"),
        ("check_range", "warning", "descendants < 0"),
        ("check_volume", "warning", "false"),
    ])}""",
    "suite_of_comments": f"""WITH {SUITE_COMMENTS} {_suite_of("comments", [
        ("check_not_null", "critical", _nulls("id", "type", "time", "parent", "ingestion_date")),
        ("check_unique", "critical", "n > 1"),
        ("check_referential_integrity", "critical", "parent NOT IN (SELECT doc_id FROM labels)"),
        ("check_volume", "warning", "false"),
    ])}""",
    "suite_of_enriched_stories": f"""WITH {ENGAGEMENT} {_suite_of("engagement", [
        ("check_not_null", "critical", _nulls(
            "score_velocity", "comment_velocity", "hours_to_peak", "is_long_tail", "observations_in_window")),
        ("check_range", "warning", "hours_to_peak < 0"),
        ("check_range", "warning", "observations_in_window < 1"),
        ("check_volume", "warning", "false"),
    ])}""",
    "suite_of_enriched_comments": f"""WITH {REPLY_SENTIMENT} {_suite_of("scored", [
        ("check_not_null", "critical", _nulls("sentiment_score", "sentiment_label")),
        ("check_range", "warning", "abs(sentiment_score) > 1"),
        ("check_volume", "warning", "false"),
    ])}""",
    "engagement": f"WITH {ENGAGEMENT} SELECT * FROM engagement",
    "engagement_by_state": f"WITH {ENGAGEMENT} SELECT * FROM engagement",
    "job_transform_stories": f"WITH {ENGAGEMENT} SELECT * FROM engagement",
    "observation_state": f"""
        WITH {OBS} SELECT id, ingestion_date, score, descendants FROM obs
        WHERE ingestion_date >= '{FIRST_DATE}' AND ingestion_date < '{TARGET_DATE}'""",
    "keep_last_rows": """
        SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice,
               l_discount, l_tax, l_returnflag, l_linestatus,
               strftime(l_shipdate, '%Y-%m-%d') AS l_shipdate
        FROM lineitem
        QUALIFY row_number() OVER (
            PARTITION BY l_orderkey, l_linenumber
            ORDER BY l_shipdate DESC, l_partkey DESC, l_suppkey DESC, l_quantity DESC,
                     l_extendedprice DESC, l_discount DESC, l_tax DESC, l_returnflag DESC,
                     l_linestatus DESC) = 1""",
    "merge_preferring_labels": """
        SELECT coalesce(l.doc_id, d.doc_id) AS id,
               CASE WHEN l.doc_id IS NULL THEN n_chars ELSE CAST(quality AS BIGINT) END AS value,
               CASE WHEN l.doc_id IS NULL THEN 'base' ELSE 'preferred' END AS origin
        FROM documents d FULL JOIN labels l ON d.doc_id = l.doc_id""",
    "conform_loose_stories": f"""
        WITH {LOOSE}
        SELECT id, type, CAST(NULL AS VARCHAR) AS "by", CAST(floor(epoch(ts)) AS BIGINT) AS time,
               CAST(NULL AS VARCHAR) AS title, coalesce(whole, 0) AS score,
               CAST(0 AS BIGINT) AS descendants, CAST(NULL AS BOOLEAN) AS dead,
               '{TARGET_DATE}' AS ingestion_date
        FROM loose""",
    "conform_loose_comments": f"""
        WITH {LOOSE}
        SELECT id, type, CAST(NULL AS VARCHAR) AS text, CAST(floor(epoch(ts)) AS BIGINT) AS time,
               whole AS parent, '{TARGET_DATE}' AS ingestion_date
        FROM loose WHERE whole IS NOT NULL""",
    "flag_orphans": f"""
        WITH {KNOWN}
        SELECT id, parent, parent IN (SELECT id FROM known) AS has_parent FROM replies""",
    "split_orphans_valid": f"""
        WITH {KNOWN}
        SELECT id, parent, text FROM replies WHERE parent IN (SELECT id FROM known)""",
    "split_orphans_dropped": f"""
        WITH {KNOWN}
        SELECT id, parent, text FROM replies WHERE parent NOT IN (SELECT id FROM known)""",
    "orphan_rows": """
        SELECT doc_id, lang, source, n_chars FROM documents
        WHERE doc_id NOT IN (SELECT doc_id FROM labels)""",
    "rows_not_listed": """
        SELECT doc_id, lang, source, n_chars FROM documents
        WHERE doc_id NOT IN (SELECT doc_id FROM labels)""",
    "rows_with_parent": """
        SELECT conv_id, turn, role FROM conversations
        WHERE conv_id IN (SELECT doc_id FROM labels)""",
    "active_rows": """
        SELECT doc_id, lang, source, n_chars FROM documents
        WHERE doc_id IN (SELECT doc_id FROM labels)""",
    "new_ids": """
        SELECT DISTINCT conv_id FROM conversations
        WHERE conv_id NOT IN (SELECT doc_id FROM labels)""",
    "unmatched_counts": """
        SELECT count(*) FILTER (WHERE conv_id NOT IN (SELECT doc_id FROM labels)) AS unmatched,
               count(*) AS child_rows,
               (SELECT count(DISTINCT doc_id) FROM labels) AS parents
        FROM conversations""",
    "valid_parents": f"WITH {KNOWN} SELECT id FROM known",
    "track_merge": f"""
        WITH {TRACKING}
        SELECT story_id,
               CASE WHEN updated OR same THEN first_seen ELSE '{TARGET_DATE}' END AS first_seen,
               CASE WHEN same THEN last_updated ELSE '{TARGET_DATE}' END AS last_updated,
               CASE WHEN same THEN last_score ELSE coalesce(score, 0) END AS last_score,
               CASE WHEN same THEN last_descendants ELSE coalesce(descendants, 0) END
                   AS last_descendants
        FROM (
            SELECT *, tracked AND measured AND changed AS updated,
                   tracked AND measured AND NOT changed
                   AND date_diff('day', CAST(last_updated AS DATE), DATE '{TARGET_DATE}') < 7 AS same
            FROM (
                SELECT story_id, first_seen, last_updated, last_score, last_descendants,
                       score, descendants,
                       first_seen IS NOT NULL AS tracked, score IS NOT NULL AS measured, is_new,
                       coalesce(score <> last_score OR descendants - last_descendants >= 5, false)
                           AS changed
                FROM state
                FULL JOIN metrics USING (story_id)
                FULL JOIN (SELECT story_id, true AS is_new FROM fresh) USING (story_id)
            )
        )
        WHERE updated OR same OR is_new""",
    "track_changed": f"""
        WITH {TRACKING}
        SELECT story_id, score <> last_score OR descendants - last_descendants >= 5 AS changed
        FROM state JOIN metrics USING (story_id)""",
    "track_interest": f"""
        WITH {TRACKING}
        SELECT story_id, days, days < 2 AS keep FROM (
            SELECT story_id,
                   date_diff('day', CAST(last_updated AS DATE), DATE '{TARGET_DATE}') AS days
            FROM state)""",
    "discover": f"""
        WITH {EVENT_ITEMS}
        SELECT id, type FROM items
        WHERE type = 'story' AND ts >= TIMESTAMP '2024-01-01'
          AND id IN (SELECT doc_id FROM labels WHERE doc_id + 1 <= 500)""",
    "tracked_stories": f"""
        WITH {EVENT_ITEMS}
        SELECT id, type FROM items WHERE type = 'story' AND id IN (SELECT doc_id FROM labels)""",
    "threads": f"""
        WITH RECURSIVE {REPLIES},
        walk AS (
            SELECT conv_id AS root_id, id, role, turn, CAST(0 AS BIGINT) AS depth,
                   CAST('0' AS VARCHAR) AS path
            FROM replies WHERE turn = 0
            UNION ALL
            SELECT w.root_id, r.id, r.role, r.turn, w.depth + 1, w.path || '.0'
            FROM walk w JOIN replies r ON r.conv_id = w.root_id AND r.turn = w.turn + 1
            WHERE w.depth + 1 < 5
        )
        SELECT root_id, id, role AS "by", depth, path FROM walk""",
    "check_not_null": _check(
        "check_not_null", "critical", "count(*) FILTER (WHERE quality IS NULL)",
        f"SELECT id FROM {LABELLED} WHERE quality IS NULL", LABELLED,
    ),
    "check_unique": _line_check("check_unique", "critical", "n > 1", REPEATED),
    "check_range": _check(
        "check_range", "warning", "count(*) FILTER (WHERE c_acctbal < 0 OR c_acctbal > 9000)",
        "SELECT c_custkey AS id FROM customer WHERE c_acctbal < 0 OR c_acctbal > 9000", "customer",
    ),
    "check_reference": _check(
        "check_referential_integrity", "critical",
        "count(*) FILTER (WHERE conv_id NOT IN (SELECT doc_id FROM labels))",
        "SELECT conv_id AS id FROM conversations WHERE conv_id NOT IN (SELECT doc_id FROM labels)",
        "conversations",
    ),
    "check_volume": _check(
        "check_volume", "warning", "greatest(0, 1000000000 - count(*))",
        "SELECT l_orderkey AS id FROM lineitem WHERE false", "lineitem",
    ),
    "quality_suite": SUITE.replace(
        "'check_not_null' AS name, affected = 0 AS passed, 'warning'",
        "'check_not_null' AS name, false AS passed, 'warning'",
    ),
    "quality_report": f"""
        WITH checks AS ({SUITE})
        SELECT '{TARGET_DATE}' AS ingestion_date, count(*) AS total_checks,
               count(*) FILTER (WHERE passed) AS passed_checks,
               count(*) FILTER (WHERE NOT passed) AS failed_checks,
               bool_or(NOT passed AND severity = 'critical') AS has_critical_failures,
               count(*) FILTER (WHERE passed AND name = 'check_volume') AS lineitem_passed,
               count(*) FILTER (WHERE NOT passed AND name <> 'check_volume') AS unknown_failed
        FROM checks""",
    "incomplete_counts_of_comments": f"""
        WITH {LOOSE}
        SELECT count(*) AS rows, CAST(0 AS BIGINT) AS null_id,
               count(*) FILTER (WHERE whole IS NULL) AS null_parent,
               count(*) FILTER (WHERE whole IS NULL) AS dropped
        FROM loose""",
    "clean_pages": f"SELECT page_id, {_clean('html')} AS clean FROM pages",
    "vocabulary": f"WITH {ALL_TOPICS} SELECT term, tf, df, n, round(idf, 9) AS idf FROM vocab",
    "top_terms": f"""
        WITH {ALL_TOPICS}
        SELECT d.doc_id, dominant_topics
        FROM documents d LEFT JOIN topics t ON d.doc_id = t.doc_id""",
    "lexicon_sums": f"""
        SELECT d.doc_id, coalesce(sum(valence), 0) AS valence
        FROM documents d
        LEFT JOIN (
            SELECT doc_id, unnest(regexp_extract_all(lower(text), '{TOKEN}')) AS term
            FROM documents
        ) t ON d.doc_id = t.doc_id
        LEFT JOIN {_values(views.LEXICON)} l(term, valence) ON t.term = l.term
        GROUP BY d.doc_id""",
    "sentiment_of_replies": f"""
        WITH {REPLY_SENTIMENT} SELECT id, sentiment_score, sentiment_label FROM scored""",
    "sentiment_of_phrases": f"""
        WITH {REPLIES},
        planted AS (
            SELECT id, coalesce(text, '') || CASE (conv_id + turn) % {len(views.PLANTED)}
                {" ".join(f"WHEN {n} THEN '{text}'" for n, text in enumerate(views.PLANTED))} END AS text
            FROM replies
        ),{_sentiment('planted', 'id', views.PHRASES, views.EMOJI)}
        SELECT id, sentiment_score, sentiment_label FROM scored""",
    "sentiment_of_documents": f"""
        WITH {_sentiment('documents', 'doc_id')}
        SELECT doc_id, sentiment_score, sentiment_label FROM scored""",
    "sentiment_histogram": f"""
        WITH {REPLY_SENTIMENT}
        SELECT sentiment_label, count(*) AS rows FROM scored GROUP BY sentiment_label""",
    "report_top_velocity": f"""
        WITH {DAY_TOPICS}
        SELECT id, title, score, score_velocity, comment_velocity, hours_to_peak, is_long_tail,
               dominant_topics
        FROM stories ORDER BY score_velocity DESC, id LIMIT 20""",
    "report_engagement_speed": f"""
        WITH {ENGAGEMENT}
        SELECT CASE WHEN hours_to_peak <= 6 THEN 'fast (<=6h)'
                    WHEN hours_to_peak <= 24 THEN 'medium (6-24h)'
                    ELSE 'slow (>24h)' END AS speed_category,
               count(*) AS story_count, round(avg(score), 1) AS avg_score,
               round(avg(descendants), 1) AS avg_comments
        FROM engagement GROUP BY 1""",
    "report_long_tail": f"""
        WITH {ENGAGEMENT}
        SELECT id, CAST(id AS VARCHAR) AS title, score, descendants, hours_to_peak,
               comment_velocity, observations_in_window
        FROM engagement WHERE is_long_tail""",
    "report_sentiment": f"""
        WITH {REPLY_SENTIMENT}
        SELECT d.doc_id AS id, any_value(d.source || ' ' || d.lang) AS title,
               count(*) AS total_comments,
               round(CAST(sum(CAST(round(sentiment_score * 10000) AS BIGINT)) AS DOUBLE)
                     / count(*)) / 10000.0 AS avg_sentiment,
               count(*) FILTER (WHERE sentiment_label = 'positive') AS positive,
               count(*) FILTER (WHERE sentiment_label = 'negative') AS negative,
               count(*) FILTER (WHERE sentiment_label = 'neutral') AS neutral
        FROM replies r JOIN scored s ON r.id = s.id JOIN documents d ON r.conv_id = d.doc_id
        GROUP BY d.doc_id""",
    "report_topic_trends": f"""
        WITH {DAY_TOPICS}
        SELECT topic, count(*) AS frequency, round(avg(score), 1) AS avg_score
        FROM (SELECT trim(unnest(string_split(dominant_topics, ','))) AS topic, score FROM stories)
        WHERE topic <> '' GROUP BY topic ORDER BY frequency DESC, topic LIMIT 30""",
    "job_process_day": f"""
        WITH {KEPT_REPLIES}
        SELECT id, role AS "by", CAST(1705700000 AS BIGINT) AS time, text, parent,
               '{TARGET_DATE}' AS ingestion_date
        FROM kept_replies""",
    "job_process_stats": f"""
        WITH {KEPT_REPLIES}
        SELECT (SELECT count(*) FROM documents) AS stories_raw,
               CAST(0 AS BIGINT) AS stories_bad_lines, CAST(0 AS BIGINT) AS comments_bad_lines,
               CAST(0 AS BIGINT) AS stories_dropped,
               CAST(0 AS BIGINT) AS stories_duplicates_removed,
               (SELECT count(*) FROM replies) AS comments_raw,
               CAST(0 AS BIGINT) AS comments_dropped,
               CAST(0 AS BIGINT) AS comments_duplicates_removed,
               (SELECT count(*) FROM documents) AS stories_processed,
               (SELECT count(*) FROM kept_replies) AS comments_processed,
               (SELECT count(*) FROM replies) - (SELECT count(*) FROM kept_replies)
                   AS comments_orphaned""",
    "job_process_stories": f"""
        SELECT CASE WHEN quality IS NULL THEN doc_id + 1000000000000 ELSE doc_id END AS id,
               text AS title, n_chars AS score, CAST(coalesce(quality, 0) AS BIGINT) AS descendants,
               '{TARGET_DATE}' AS ingestion_date
        FROM documents LEFT JOIN labels USING (doc_id)""",
    "discover_repeated_ranks": "SELECT doc_id AS id FROM documents WHERE doc_id % 500 + 1 <= 40",
    "state_after_all_lapse": """
        SELECT count(*) AS saved, CAST(0 AS BIGINT) AS left_over FROM documents""",
    "job_transform_day": f"""
        WITH {KEPT_REPLIES},{_sentiment('kept_replies', 'id')}
        SELECT k.id, parent, sentiment_score, sentiment_label, '{TARGET_DATE}' AS ingestion_date
        FROM kept_replies k JOIN scored s ON k.id = s.id""",
}
