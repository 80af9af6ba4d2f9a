"""The same results in DuckDB's SQL, for the operators that SQL can express."""

ORACLES = {
    "op3_url_filters": """
WITH rest AS (
    SELECT page_id,
           CASE WHEN strpos(coalesce(url, ''), '://') > 0
                THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
    FROM pages
), parts AS (
    SELECT page_id,
           translate(regexp_extract(rest, '^[^/?#]*'),
                     'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
           regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
    FROM rest
), ruled AS (
    SELECT *, CASE
        WHEN '.' || host LIKE '%.www.example.com' AND path LIKE '/en/%' THEN 'www.example.com/en/'
        WHEN '.' || host LIKE '%.example.com' AND path LIKE '/en/%' THEN 'example.com/en/'
        WHEN '.' || host LIKE '%.com' AND path LIKE '/%' THEN 'com/'
        WHEN '.' || host LIKE '%.net' AND path LIKE '/es/%' THEN 'net/es/'
        WHEN '.' || host LIKE '%.net' AND path LIKE '/fr/%' THEN 'net/fr/'
    END AS rule
    FROM parts
)
SELECT page_id, host, path, rule,
       CASE WHEN rule IN ('example.com/en/', 'net/es/', 'net/fr/') THEN 'block' ELSE 'allow' END AS verdict
FROM ruled
""",
    "op5_jaccard_join": r"""
WITH RECURSIVE words AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
    FROM documents
), sets AS (
    SELECT doc_id, CASE WHEN len(w) = 0 THEN [] ELSE list_distinct(list_transform(
        range(1, greatest(len(w) - 2, 2)), lambda i: array_to_string(w[i:i + 3], ' '))) END AS s
    FROM words
), shingles AS (
    SELECT doc_id, len(s) AS n, unnest(s) AS shingle FROM sets
), link AS (
    SELECT a.doc_id AS a, b.doc_id AS b
    FROM shingles AS a JOIN shingles AS b USING (shingle)
    WHERE a.doc_id <> b.doc_id
    GROUP BY a.doc_id, b.doc_id, a.n, b.n
    HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))
), reach AS (
    SELECT doc_id AS a, doc_id AS b FROM documents
    UNION SELECT reach.a, link.b FROM reach JOIN link ON reach.b = link.a
)
SELECT doc_id, len(s)::BIGINT AS n_shingles, component_id
FROM sets JOIN (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a) USING (doc_id)
""",
    "op7_warc_zip": """
WITH sized AS (
    SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes,
           sha1(coalesce(html, '')) AS payload_digest
    FROM pages
), largest AS (
    SELECT payload_digest, max(page_id) AS winner FROM sized
    WHERE payload_bytes >= 1000 GROUP BY 1 HAVING count(*) > 1
)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN winner <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN winner <> page_id THEN winner END AS refers_to
FROM sized LEFT JOIN largest USING (payload_digest)
""",
    "op8_chat_formatting": r"""
WITH turns AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
    UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'
), sized AS (
    SELECT *, length(role || text) + 20 + len(regexp_extract_all(role || chr(0) || text,
        '\\|<s>|</s>|<<SYS>>|<</SYS>>|<\||\[/?INST\]|\[/?ROLE\]')) AS chars
    FROM turns
)
SELECT conv_id,
       count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       sum(chars)::BIGINT AS formatted_chars
FROM sized
GROUP BY conv_id
""",
    "op11_fill_in_middle": r"""
WITH lines AS (
    SELECT doc_id, coalesce(text, '') AS text, sha256('7:' || coalesce(doc_id::VARCHAR, '')) AS h,
           regexp_extract_all(coalesce(text, ''), '[^\n]*\n|[^\n]+') AS lines
    FROM documents
), drawn AS (
    SELECT *, len(lines) AS n,
           ('0x' || h[1:8])::BIGINT % (len(lines) + 1) AS one, ('0x' || h[9:16])::BIGINT % (len(lines) + 1) AS two,
           CASE WHEN text = '' OR regexp_matches(text, '<[PSM]>') OR ('0x' || h[17:24])::BIGINT % 100 >= 100 THEN 'plain'
                WHEN ('0x' || h[25:32])::BIGINT % 100 < 50 THEN 'spm' ELSE 'psm' END AS form
    FROM lines
), parts AS (
    SELECT *, coalesce(array_to_string(lines[1:least(one, two)], ''), '') AS prefix,
           coalesce(array_to_string(lines[least(one, two) + 1:greatest(one, two)], ''), '') AS middle,
           coalesce(array_to_string(lines[greatest(one, two) + 1:], ''), '') AS suffix
    FROM drawn
)
SELECT doc_id, n::BIGINT AS n, form,
       CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text
                        WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
                        ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
       sha256(text) AS restored_sha256
FROM parts
""",
}
