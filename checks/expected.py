"""DuckDB SQL over the given tables for each query in ``queries``.

Written from the rules by which the dumps are derived; it reads no dump.
"""

from __future__ import annotations

# Page histories, as the scan must return them.
_REVISIONS = r"""
rules AS (
  SELECT conv_id, turn, role, text,
    (conv_id + turn) % 9 AS text_kind, (conv_id + 2 * turn) % 5 AS comment_kind,
    (conv_id + turn) % 11 AS who
  FROM conversations
),
revisions AS (
  SELECT conv_id, turn,
    conv_id * 1000000 + turn + 1 AS id,
    CASE WHEN turn > 0 THEN conv_id * 1000000 + turn END AS parent_id,
    'c' || conv_id || ' & <"co">' AS page_title,
    CASE WHEN role = 'system' OR who IN (0, 1, 2) THEN NULL ELSE 1 + conv_id % 97 END
      AS contributor_id,
    CASE WHEN role = 'system' OR who IN (0, 1) THEN NULL ELSE role END AS contributor_name,
    CASE WHEN role = 'system' THEN '192.0.2.' || (turn % 256) END AS contributor_ip,
    '2019-11-05T' || lpad(CAST((turn // 60) % 24 AS VARCHAR), 2, '0') || ':'
      || lpad(CAST(turn % 60 AS VARCHAR), 2, '0') || ':00Z' AS "timestamp",
    CASE text_kind WHEN 0 THEN NULL WHEN 1 THEN NULL
      WHEN 2 THEN ' ' || chr(10) || chr(9) || ' '
      WHEN 3 THEN '  ' || text || chr(10) || chr(10)
      WHEN 4 THEN text || ' <ref name="a">&amp; it''s</ref>, "",\"'
      ELSE text END AS text,
    CASE comment_kind WHEN 3 THEN 'say "<b>", it''s' WHEN 4 THEN 'turn ' || turn END AS comment,
    conv_id AS page_id,
    conv_id % 3 AS page_ns
  FROM rules
)"""

_RAW = """
SELECT CAST(id AS VARCHAR) AS id, CAST(parent_id AS VARCHAR) AS parent_id, page_title,
  CAST(contributor_id AS VARCHAR) AS contributor_id, contributor_name, contributor_ip,
  "timestamp", text, comment, CAST(page_id AS VARCHAR) AS page_id,
  CAST(page_ns AS VARCHAR) AS page_ns
FROM revisions"""

_SCAN = f"WITH {_REVISIONS} {_RAW}"

# The same turns as those of five long pages.
_LONG_SCAN = _SCAN.replace(
    "FROM conversations",
    "FROM (SELECT conv_id % 5 AS conv_id, conv_id // 5 * 1000 + turn AS turn, role, text "
    "FROM conversations)",
)

# How many files the dump of conversations has, and which one a turn is in.
_DUMP_FILES = """
files AS (
  SELECT greatest(4, CAST(ceil(sum(strlen(text)) / 16777216.0) AS BIGINT)) AS n
  FROM conversations
)"""
_DUMP_FILE = "(conv_id + turn // 1000) % (SELECT n FROM files)"

# Staged documents: name, bytes' hash and the rule's number of each file.
_STAGED = """
files AS (
  SELECT greatest(10, CAST(ceil(sum(strlen(text)) / 16777216.0) AS BIGINT)) AS n FROM documents
),
staged AS (
  SELECT k, 'pages-meta-history' || k || '.txt' AS name,
    md5(string_agg(text || chr(10), '' ORDER BY doc_id)) AS md5
  FROM (SELECT doc_id % (SELECT n FROM files) AS k, doc_id, text FROM documents)
  GROUP BY k
),
verified AS (
  SELECT k, name, md5,
    CASE k % 5 WHEN 1 THEN 'mismatch' WHEN 2 THEN 'unlisted' WHEN 3 THEN 'conflict'
      ELSE 'verified' END AS status
  FROM staged
)"""

_LINKS = """
links AS (
  SELECT page_id, unnest(regexp_extract_all(html, 'href="(.+?)"', 1)) AS url FROM pages
)"""


def _state(name: str) -> str:
    blank = r"'^[ \t\n\r\x0b\x0c]+|[ \t\n\r\x0b\x0c]+$'"
    value = f"CAST({name} AS VARCHAR)"
    stripped = f"regexp_replace({value}, {blank}, '', 'g')"
    return f"""CASE WHEN {name} IS NULL THEN 'null' WHEN {stripped} = '' THEN 'blank'
      WHEN {stripped} <> {value} THEN 'padded' ELSE 'plain' END AS {name}_state"""


def _integer(name: str, type_name: str) -> str:
    return (
        f"CASE WHEN regexp_matches({name}, '^\\s*[+-]?[0-9]+\\s*$') "
        f"THEN TRY_CAST(trim({name}) AS {type_name}) END"
    )


_TYPED = f"""WITH {_REVISIONS}
        SELECT id, parent_id, page_title, contributor_id, contributor_name, contributor_ip,
          text, comment, page_id, CAST(page_ns AS INTEGER) AS page_ns,
          CAST(epoch(CAST("timestamp" AS TIMESTAMPTZ)) AS BIGINT) AS epoch
        FROM revisions"""

_MODES = """WITH n AS (SELECT count(*) AS n FROM conversations)
        SELECT 'first load' AS step, 'loaded' AS outcome, n AS revisions, 0 AS replaced FROM n
        UNION ALL SELECT 'load over it', 'exists', n, 0 FROM n
        UNION ALL SELECT 'failing replacement', 'duplicates', n, 0 FROM n
        UNION ALL SELECT 'replacement', 'loaded', n, n FROM n"""


EXPECTED = {
    "listing_links": f"WITH {_LINKS} SELECT page_id, url FROM links",
    "link_filter": f"""WITH {_LINKS}
        SELECT DISTINCT url FROM links WHERE contains(url, 'th') AND ends_with(url, 'e')""",
    "url_resolve": f"""WITH {_LINKS},
        both_kinds AS (SELECT url FROM links UNION SELECT ltrim(url, '/') FROM links)
        SELECT url,
          CASE WHEN starts_with(url, '/') THEN 'https://dumps.wikimedia.org' || url END AS dated,
          CASE WHEN NOT starts_with(url, '/')
            THEN 'https://dumps.wikimedia.org/enwiki/latest/' || url END AS latest
        FROM both_kinds""",
    "dump_urls": """WITH days AS (
          SELECT DISTINCT strftime(o_orderdate, '%Y%m%d') AS date FROM orders)
        SELECT date, 'https://dumps.wikimedia.org/enwiki/' || date || '/' AS dump_page,
          'https://dumps.wikimedia.org/enwiki/' || date || '/enwiki-' || date || '-md5sums.txt'
            AS manifest,
          'https://dumps.wikimedia.org/enwiki/a.bz2' AS file_url
        FROM days""",
    "basename": "SELECT page_id, split_part(url, '/', -1) AS name FROM pages",
    "manifest_parse": """SELECT md5(text) AS md5, 'doc-' || doc_id || '.txt' AS name
        FROM documents""",
    "checksum_verify": f"WITH {_STAGED} SELECT name, md5, status FROM verified",
    "trusted_verify": f"""WITH {_STAGED}
        SELECT name, CASE WHEN k % 2 = 1 THEN 'trusted' ELSE status END AS status
        FROM verified""",
    "ledger_skip": """SELECT 'doc-' || doc_id || '.txt' AS name,
          CASE WHEN EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id) THEN 'trust'
            ELSE 'check' END AS action
        FROM documents d""",
    "refetch_list": f"""WITH {_STAGED},
        wanted AS (
          SELECT 'pages-meta-history' || k || '.txt' AS name
          FROM (SELECT unnest(range((SELECT n + 3 FROM files))) AS k))
        SELECT name FROM wanted w WHERE NOT EXISTS (
          SELECT 1 FROM verified v WHERE v.name = w.name AND v.status = 'verified')""",
    "refetch_rounds": f"""WITH {_STAGED},
        steps AS (
          SELECT unnest([
            {{'rule': 0, 'round': 1, 'status': 'verified'}}, {{'rule': 1, 'round': 2, 'status': 'mismatch'}},
            {{'rule': 1, 'round': 3, 'status': 'verified'}}, {{'rule': 3, 'round': 3, 'status': 'unlisted'}},
            {{'rule': 2, 'round': NULL, 'status': 'missing'}}, {{'rule': 3, 'round': NULL, 'status': 'missing'}}],
            recursive := true))
        SELECT name, CAST(round AS INTEGER) AS round, status FROM staged JOIN steps ON k % 4 = rule""",
    "live_csv": _SCAN,
    "clean_source": f"""WITH {_DUMP_FILES}, numbers AS (SELECT unnest(range((SELECT n FROM files))) AS k)
        SELECT 'whole' AS kind, CAST(k AS VARCHAR) AS dump_file, false AS stays FROM numbers
        UNION ALL SELECT 'damaged', CAST(k AS VARCHAR), EXISTS (
          SELECT 1 FROM conversations WHERE {_DUMP_FILE} = k
            AND (conv_id % 7 IN (0, 3) OR (conv_id % 7 IN (1, 2) AND turn = 1)))
        FROM numbers""",
    "provenance": f"""WITH {_REVISIONS}
        SELECT id, '20191101' AS dump_date, true AS taken_in_now FROM revisions""",
    "xml_scan": _SCAN,
    "namespace_scan": f"""WITH scan AS ({_SCAN})
        SELECT id, comment, page_id, page_ns, contributor_name FROM scan WHERE page_ns IN ('0', '2')""",
    "contributor_variants": f"""WITH {_REVISIONS}
        SELECT CASE WHEN contributor_ip IS NOT NULL THEN 'anonymous'
            WHEN contributor_id IS NOT NULL THEN 'account'
            WHEN contributor_name IS NOT NULL THEN 'name only' ELSE 'removed' END AS kind,
          count(*) AS revisions
        FROM revisions GROUP BY 1""",
    "null_rules": f"""WITH {_REVISIONS}
        SELECT CAST(id AS VARCHAR) AS id, {_state("parent_id")}, {_state("text")},
          {_state("comment")}, {_state("contributor_id")}, {_state("contributor_name")},
          length(text) AS text_length
        FROM revisions""",
    "malformed_quarantine": """SELECT CAST(conv_id AS VARCHAR) AS page_id,
          CASE WHEN conv_id % 7 IN (1, 2) AND turn = 1 THEN 'unreadable revision'
            WHEN conv_id % 7 IN (0, 3) THEN 'incomplete page header' ELSE 'none' END AS problem,
          count(*) AS revisions
        FROM conversations GROUP BY 1, 2""",
    "required_fields": """WITH lacking AS (
          SELECT conv_id, conv_id % 5 = 3 AND turn % 3 = 1 AS no_id,
            conv_id % 4 = 3 AND turn % 3 = 2 AS no_time
          FROM conversations)
        SELECT CAST(conv_id AS VARCHAR) AS page_id,
          CASE WHEN no_id OR no_time THEN 'missing id or timestamp' ELSE 'none' END AS problem,
          count(*) AS revisions, count(*) FILTER (WHERE NOT no_id) AS ids,
          count(*) FILTER (WHERE NOT no_time) AS timestamps
        FROM lacking GROUP BY 1, 2""",
    "truncated_files": f"""WITH {_DUMP_FILES}, by_file AS (
          SELECT {_DUMP_FILE} AS k, count(*) AS revisions FROM conversations GROUP BY 1)
        SELECT CAST(k AS VARCHAR) AS dump_file,
          revisions - CASE WHEN k % 4 IN (1, 3) THEN 1 ELSE 0 END AS sound,
          CAST(CASE WHEN k % 4 IN (1, 3) THEN 1 ELSE 0 END AS BIGINT) AS unreadable, revisions,
          k % 4 <> 0 AS ends_early
        FROM by_file""",
    "split_scan": _LONG_SCAN,
    "retype": f"""WITH raw AS (
          SELECT conv_id, turn,
            CASE (conv_id + turn) % 10 WHEN 0 THEN 'x' || turn WHEN 1 THEN ' ' || turn || ' '
              WHEN 2 THEN '-' || turn WHEN 3 THEN turn || '.5' ELSE '' || turn END AS id,
            CASE WHEN turn > 0 THEN '' || (turn - 1) END AS parent_id,
            CASE turn % 4 WHEN 0 THEN NULL WHEN 1 THEN NULL WHEN 2 THEN conv_id || 'a'
              ELSE '' || conv_id END AS contributor_id,
            CASE conv_id % 6 WHEN 0 THEN 'November 5 2019' WHEN 1 THEN '2019-11-05T07:41:09+02:00'
              WHEN 2 THEN NULL ELSE '2019-11-05T07:41:09Z' END AS stamp,
            '' || conv_id AS page_id,
            CASE WHEN conv_id % 8 = 0 THEN '99999999999' ELSE '' || (conv_id % 3) END AS page_ns
          FROM conversations),
        typed AS (
          SELECT conv_id, turn,
            {_integer("id", "BIGINT")} AS id, id AS raw_id,
            {_integer("parent_id", "BIGINT")} AS parent_id,
            {_integer("contributor_id", "BIGINT")} AS contributor_id,
            contributor_id AS raw_contributor_id,
            CAST(epoch(TRY_CAST(stamp AS TIMESTAMPTZ)) AS BIGINT) AS epoch,
            {_integer("page_id", "BIGINT")} AS page_id,
            {_integer("page_ns", "INTEGER")} AS page_ns
          FROM raw)
        SELECT conv_id, turn, id, parent_id, contributor_id, epoch, page_id, page_ns,
          concat_ws(',',
            CASE WHEN contributor_id IS NULL AND raw_contributor_id IS NOT NULL
              THEN 'contributor_id' END,
            CASE WHEN id IS NULL THEN 'id' END,
            CASE WHEN page_ns IS NULL THEN 'page_ns' END,
            CASE WHEN epoch IS NULL THEN 'timestamp' END) AS rejected
        FROM typed""",
    "row_size": """SELECT doc_id, coalesce(strlen(text), 0) + coalesce(strlen(source), 0) + 300
          AS size FROM documents""",
    "not_null_check": """SELECT field, violations FROM (
          SELECT count(*) FILTER (WHERE conv_id % 5 = 0) AS "timestamp",
            count(*) FILTER (WHERE (conv_id * 1000000 + turn + 1) % 4 = 0) AS page_title,
            count(*) FILTER (WHERE conv_id % 9 = 2) AS page_ns,
            count(*) FILTER (WHERE conv_id IS NULL) AS id,
            count(*) FILTER (WHERE conv_id IS NULL) AS page_id
          FROM conversations)
        UNPIVOT (violations FOR field IN ("timestamp", page_title, page_ns, id, page_id))""",
    "revisions_per_page": f"""WITH {_REVISIONS}
        SELECT CAST(page_id AS VARCHAR) AS page_id, page_title, count(*) AS revisions
        FROM revisions GROUP BY 1, 2""",
    "revision_counts": f"""WITH {_DUMP_FILES}
        SELECT CAST(k AS VARCHAR) AS file, count(*) AS revisions
        FROM (SELECT {_DUMP_FILE} AS k FROM conversations) GROUP BY ROLLUP (k)""",
    "size_batches": """WITH RECURSIVE sized AS (
          SELECT conv_id % 4 AS file, conv_id, turn, strlen(text) + 300 AS size,
            row_number() OVER (PARTITION BY conv_id % 4 ORDER BY conv_id, turn) AS n
          FROM conversations),
        steps AS (
          SELECT file, n, size, 0 AS batch, size AS filled FROM sized WHERE n = 1
          UNION ALL
          SELECT s.file, s.n, s.size,
            CASE WHEN p.filled >= 20000 THEN p.batch + 1 ELSE p.batch END,
            CASE WHEN p.filled >= 20000 THEN s.size ELSE p.filled + s.size END
          FROM steps p JOIN sized s ON s.file = p.file AND s.n = p.n + 1)
        SELECT file, CAST(batch AS BIGINT) AS batch, count(*) AS rows,
          CAST(sum(size) AS BIGINT) AS bytes
        FROM steps GROUP BY file, batch""",
    "pk_check": """SELECT id, count(*) AS copies FROM (
          SELECT conv_id * 1000000 + turn + 1 AS id,
            unnest(range(CASE WHEN conv_id % 5 = 0 THEN 2 + turn % 2 ELSE 1 END)) AS copy
          FROM conversations) GROUP BY id HAVING count(*) > 1""",
    "multi_file_union": f"""WITH {_DUMP_FILES}
        SELECT CAST({_DUMP_FILE} AS VARCHAR) AS dump_file,
          CAST(conv_id * 1000000 + turn + 1 AS VARCHAR) AS id, CAST(conv_id AS VARCHAR) AS page_id
        FROM conversations""",
    "csv_roundtrip": _SCAN,
    "csv_parallel": _SCAN,
    "jdbc_roundtrip": _TYPED,
    "database_load": _TYPED,
    "database_resume": _TYPED,
    "table_modes": _MODES,
    "database_modes": _MODES,
    "dump_partitions": f"""WITH {_REVISIONS}
        SELECT '20191101' AS dump_date, id, comment, CAST(page_ns AS INTEGER) AS page_ns FROM revisions
        UNION ALL SELECT '20191201', id, 'second', CAST(page_ns AS INTEGER) FROM revisions""",
    "stream_ingest": _SCAN,
    "dump_ingest": f"""WITH {_REVISIONS}, {_DUMP_FILES}
        SELECT page_id, count(*) AS revisions,
          CAST(sum(coalesce(strlen(text), 0) + coalesce(strlen(comment), 0) + 300) AS BIGINT)
            AS size,
          max(CAST(epoch(CAST("timestamp" AS TIMESTAMPTZ)) AS BIGINT)) AS last_epoch
        FROM revisions WHERE {_DUMP_FILE} <> 1 GROUP BY page_id""",
    "ingest_to_csv": _SCAN,
}
