"""SQL counterparts of the registered queries, for DuckDB."""

from __future__ import annotations

from feedlake.plans.briefing import Roles
from feedlake.schema import BLANKS, NO_HITS, ROLE_CHARS, STOP_WORDS
from workload.base import FEED_ROOT, FIRST_DAY, LINK_ROOT, NO_EVENT, RFC822
from workload.queries import AS_OF, DATE, LETTERS, ODD_SOURCES, SHORT_DELAY


def _strip(text: str) -> str:
    return f"trim({text}, '{BLANKS}')"


_TS = "'%Y-%m-%d %H:%M:%S.%f'"


def _shown(moment: str) -> str:
    return f"strftime({moment}, {_TS})"


ENTRIES = f"""
entries AS (
  SELECT CASE WHEN bare THEN -1 - number ELSE number END AS doc_id, source, '{FEED_ROOT}' || source AS feed_url,
    CASE WHEN bare THEN '' ELSE '{LINK_ROOT}' || md5(text) END AS link,
    '  ' || text || '　' AS title,
    CASE number % 4 WHEN 0 THEN strftime(arrived, '%Y-%m-%dT%H:%M:%S') || '+00:00'
      WHEN 2 THEN '{RFC822}' ELSE '' END AS published,
    CASE number % 4 WHEN 1 THEN strftime(arrived, '%Y-%m-%d %H:%M:%S') END AS updated,
    CASE WHEN lang <> 'fr' THEN text END AS summary,
    CASE WHEN lang = 'fr' THEN text END AS description,
    arrived AS kafka_ts, CAST(regexp_extract(source, '([0-9]+)$', 1) AS INTEGER) AS feed_no
  FROM (
    SELECT d.doc_id AS number, d.source, d.text, d.lang, coalesce(e.ts, TIMESTAMP '{NO_EVENT}') AS arrived,
      unnest(CASE WHEN d.doc_id % 10 = 0 THEN [false, true] ELSE [false] END) AS bare
    FROM documents d LEFT JOIN events e ON d.doc_id = e.event_id))
"""

EV = (
    ENTRIES
    + f""",
ev AS (
  SELECT substr(sha256(link), 1, 16) AS id, source, {_strip('title')} AS title,
    {_strip("coalesce(nullif(summary, ''), nullif(description, ''), '')")} AS summary, link,
    coalesce(nullif(published, ''), nullif(updated, ''), '') AS published_raw,
    strftime(kafka_ts, '%Y-%m-%dT%H:%M:%S.%f') || '+00:00' AS ingested_at, kafka_ts, feed_no,
    greatest(0, least(2, date_diff('day', DATE '{FIRST_DAY}', CAST(kafka_ts AS DATE)))) AS drop_no
  FROM entries WHERE link <> '')
"""
)

_LATEST = "kafka_ts DESC, source DESC, published_raw DESC, title DESC"
_ARRIVAL = "kafka_ts, source, published_raw, title"


def _plain(text: str) -> str:
    return (
        f"trim(regexp_replace(regexp_replace(coalesce({text}, ''), '<[^>]+>', '', 'g'), '\\s+', ' ', 'g'))"
    )


CLEAN = (
    EV
    + f""",
clean AS (
  SELECT *, CAST(published_at AS DATE) AS dt FROM (
    SELECT id, source, title, {_plain('summary')} AS body, link, published_raw, kafka_ts, drop_no,
      coalesce(try_cast(published_raw AS TIMESTAMP), kafka_ts) AS published_at,
      try_cast(ingested_at AS TIMESTAMP) AS ingested_at
    FROM ev WHERE title IS NOT NULL AND length(title) > 0))
"""
)


def _one(source: str, order: str, where: str = "TRUE") -> str:
    return (
        f"(SELECT * FROM {source} WHERE {where} "
        f"QUALIFY row_number() OVER (PARTITION BY id ORDER BY {order}) = 1)"
    )


SILVER = CLEAN + f", silver AS {_one('clean', _LATEST)}"

_SILVER_COLUMNS = f"""id, source, title, md5(body) AS body_md5, link, {_shown('published_at')} AS published_at,
  {_shown('ingested_at')} AS ingested_at, CAST(dt AS VARCHAR) AS dt"""

_BRONZE_COLUMNS = f"""id, source, title, md5(summary) AS summary_md5, link, published_raw, ingested_at,
  {_shown('kafka_ts')} AS kafka_ts"""

_STOP = ", ".join(f"'{w}'" for w in STOP_WORDS)


def _words(name: str, silver: str) -> str:
    return f"""{name} AS (
  SELECT dt, token, count(*) AS freq FROM (
    SELECT dt, regexp_replace(piece, '[^가-힣A-Za-z0-9]', '', 'g') AS token
    FROM (SELECT dt, unnest(regexp_split_to_array(title, '\\s+')) AS piece FROM {silver}))
  WHERE length(token) >= 2 AND token NOT IN ({_STOP}) GROUP BY dt, token)"""


def _counts(name: str, silver: str) -> str:
    return f"{name} AS (SELECT dt, source, count(*) AS article_count FROM {silver} GROUP BY dt, source)"


WORDS = SILVER + ", " + _words("words", "silver")
COUNTS = SILVER + ", " + _counts("counts", "silver")


def _digest_vector(text: str, copies: int = 1) -> str:
    """Unscaled vector of a text: its digest bytes, moved around zero."""
    one = (
        f"list_transform(range(0, 32), lambda i: "
        f"CAST('0x' || substr(sha256({text}), CAST(2 * i + 1 AS BIGINT), 2) AS INTEGER) / 255.0::DOUBLE - 0.5::DOUBLE)"
    )
    return one if copies == 1 else "list_concat(" + ", ".join([one] * copies) + ")"


def _embed_text(title: str, body: str) -> str:
    blank_cut = _strip(f"{title} || chr(10) || coalesce({body}, '')")
    return blank_cut


_HASHED = f"""
hashed AS (
  SELECT doc_id, {_digest_vector('text')} AS v FROM documents),
sized AS (
  SELECT doc_id, v, sqrt(48 * list_sum(list_transform(v, lambda x: x * x))) AS size FROM hashed)
"""


def _search(name: str, asked: str, points: str) -> str:
    """Top 6 points per (qid, text), as contexts."""
    return f"""
{name}_vectors AS (SELECT qid, {_digest_vector('text')} AS qv FROM {asked}),
{name}_hits AS (
  SELECT qid, row_number() OVER (PARTITION BY qid ORDER BY score DESC, point_id) AS rank, source, title, body, link
  FROM (SELECT q.qid, p.point_id, p.source, p.title, p.body, p.link,
          round(list_cosine_similarity(q.qv, p.v), 8) + 0.0 AS score
        FROM {name}_vectors q CROSS JOIN {points} p)
  QUALIFY rank <= 6),
{name} AS (
  SELECT q.qid, coalesce(string_agg('[' || h.rank || '] (' || h.source || ') ' || h.title || chr(10) || '    '
      || substr(h.body, 1, 200) || chr(10) || '    링크: ' || h.link, chr(10) ORDER BY h.rank), '{NO_HITS}') AS contexts
  FROM {asked} q LEFT JOIN {name}_hits h ON h.qid = q.qid GROUP BY q.qid)"""


def _points(source: str = "source", silver: str = "silver") -> str:
    return f"""points AS (
  SELECT CAST('0x' || id AS UBIGINT) AS point_id, {_digest_vector(_embed_text('title', 'body'))} AS v,
    {source} AS source, title, substr(body, 1, 2000) AS body, link FROM {silver})"""


_ROLES = Roles()


def _echo(system: str, user: str) -> str:
    start = f"[MOCK-LLM] ({system[:ROLE_CHARS]}...) 응답:"
    return f"'{start}' || chr(10) || substr(replace({_strip(user)}, chr(10), ' '), 1, 400)"


_NL2 = "chr(10) || chr(10)"


def _labelled(first: str, text: str, second: str = "[원본 기사]") -> str:
    return f"('{first}' || chr(10) || {text} || {_NL2} || '{second}' || chr(10) || contexts)"


_RESEARCH_PROMPT = "('검색 결과:' || chr(10) || contexts)"


def _round(name: str, asked: str, loops: int) -> str:
    """One pass of the review loop over `asked(qid, query, text)`."""
    return f"""{_search(name + '_found', asked, 'points')},
{name}_r AS (SELECT qid, contexts, {_echo(_ROLES.researcher, _RESEARCH_PROMPT)} AS research FROM {name}_found),
{name}_a AS (SELECT *, {_echo(_ROLES.analyst, _labelled('[정리된 이슈]', 'research'))} AS analysis FROM {name}_r),
{name}_c AS (SELECT *, {_echo(_ROLES.critic, _labelled('[분석]', 'analysis'))} AS critique FROM {name}_a),
{name} AS (
  SELECT c.*, q.query, {loops} AS loops, CASE WHEN {loops} >= 2
      OR contains(string_split(upper(critique), 'VERDICT:')[-1], 'APPROVE') THEN 'APPROVE' ELSE 'REVISE' END AS verdict
  FROM {name}_c c JOIN {asked} q ON q.qid = c.qid)"""


def _reinforced(query: str, critique: str) -> str:
    return f"{query} || ' (보강 포인트: ' || substr({critique}, 1, 200) || ')'"


_LOOP = f"""q1 AS (SELECT item_id AS qid, text AS query, text FROM benchmark),
{_round('one', 'q1', 1)},
q2 AS (SELECT qid, query, {_reinforced('query', 'critique')} AS text FROM one WHERE verdict <> 'APPROVE'),
{_round('two', 'q2', 2)},
settled AS (SELECT * FROM one WHERE verdict = 'APPROVE' UNION ALL SELECT * FROM two)"""

_BRIEFING = _echo(_ROLES.reporter, _labelled("[승인된 분석]", "analysis", "[근거 기사]"))


def _sql(ctes: str, body: str) -> str:
    return f"WITH {ctes}\n{body}"


_SOURCES_EARLY = f"early AS {_one('clean', _LATEST, 'drop_no < 2')}"

_FIRST = f"first AS {_one('ev', _ARRIVAL)}"

_BRONZE = f"bronze AS {_one('ev', 'drop_no, ' + _ARRIVAL)}"

_STREAM_SILVER = f"last AS {_one('clean', 'drop_no DESC, ' + _LATEST)}"

_COMPONENTS = ", ".join(f"round(v[{i + 1}] / size, 8) AS v{i}" for i in range(32))

_ASKED = "asked AS (SELECT item_id AS qid, text FROM benchmark)"


def _literal(value: str | None) -> str:
    return "NULL" if value is None else "'" + value.replace("'", "''") + "'"


_ODD_SOURCE = "CASE source " + " ".join(f"WHEN '{k}' THEN {_literal(v)}" for k, v in ODD_SOURCES.items()) + " ELSE source END"


# The dedupe stream over three drops that hold events of all days. `m0` to `m2` are the watermarks that the drops
# run with, `k0` to `k2` what they keep; an id is remembered while its event is not the delay behind the watermark.
_WINDOW = f"""{EV},
mixed AS (
  SELECT *, (CAST('0x' || substr(id, 1, 1) AS INTEGER) + CAST(minute(kafka_ts) AS INTEGER)) % 3 AS part FROM ev),
m0 AS (SELECT TIMESTAMP '1970-01-01' AS w),
m1 AS (SELECT date_trunc('millisecond', max(kafka_ts)) - INTERVAL {SHORT_DELAY} AS w FROM mixed WHERE part < 1),
m2 AS (SELECT date_trunc('millisecond', max(kafka_ts)) - INTERVAL {SHORT_DELAY} AS w FROM mixed WHERE part < 2),
m3 AS (SELECT date_trunc('millisecond', max(kafka_ts)) - INTERVAL {SHORT_DELAY} AS w FROM mixed),
k0 AS {_one('mixed', _ARRIVAL, 'part = 0')},
s1 AS (SELECT id FROM k0, m1 WHERE kafka_ts + INTERVAL {SHORT_DELAY} > w),
k1 AS {_one('mixed, m1', _ARRIVAL, 'part = 1 AND kafka_ts > w AND id NOT IN (SELECT id FROM s1)')},
s2 AS (SELECT id FROM (FROM k0 SELECT id, kafka_ts UNION ALL FROM k1 SELECT id, kafka_ts), m2
  WHERE kafka_ts + INTERVAL {SHORT_DELAY} > w),
k2 AS {_one('mixed, m2', _ARRIVAL, 'part = 2 AND kafka_ts > w AND id NOT IN (SELECT id FROM s2)')}"""


# Silver and both marts after each of the drops, the last drop winning.
_LIVE = CLEAN + "".join(
    f", after{n} AS {_one('clean', 'drop_no DESC, ' + _LATEST, f'drop_no <= {n}')}"
    f", {_words(f'words{n}', f'after{n}')}, {_counts(f'counts{n}', f'after{n}')}"
    for n in range(3)
)


def _marts_after(n: int) -> str:
    return f"""SELECT {n} AS drop_no, 'source' AS mart, CAST(dt AS VARCHAR) AS dt, source AS name, article_count AS n FROM counts{n}
    UNION ALL SELECT {n}, 'token', CAST(dt AS VARCHAR), token, freq FROM words{n}"""


_KNN = _sql(
    f"""asked AS (SELECT item_id AS qid, {_digest_vector('text', copies=2)} AS qv FROM benchmark)""",
    """SELECT qid, CAST(rank AS INTEGER) AS rank, vec_id, score FROM (
      SELECT qid, vec_id, score, row_number() OVER (PARTITION BY qid ORDER BY score DESC, vec_id) AS rank
      FROM (SELECT q.qid, e.vec_id,
        round(list_cosine_similarity(q.qv, CAST(e.embedding AS DOUBLE[])), 8) + 0.0 AS score
        FROM asked q CROSS JOIN embeddings e)) WHERE rank <= 6""",
)

_POLLS = """SELECT strftime(poll, '%Y-%m-%d %H:%M') AS poll_at, n AS published_count,
  CAST(sum(n) OVER (ORDER BY poll) AS BIGINT) AS seen_total
FROM (SELECT date_trunc('minute', kafka_ts) AS poll, count(*) AS n FROM first GROUP BY 1)"""


def _drop_report(n: int) -> str:
    return f"""SELECT {n} AS drop_no, count(*) AS rows_read, count(*) FILTER (kafka_ts <= m{n}.w) AS rows_late,
      count(*) FILTER (kafka_ts > m{n}.w) - (SELECT count(*) FROM k{n}) AS rows_repeated,
      strftime((SELECT w FROM m{n + 1}), '%Y-%m-%dT%H:%M:%S.%g') || 'Z' AS watermark
    FROM mixed, m{n} WHERE part = {n}"""


_FIRST_COLUMNS = f"id, source, link, md5(title) AS title_md5, published_raw, {_shown('kafka_ts')} AS kafka_ts"


def oracle_sql() -> dict[str, str]:
    silver_like = f"SELECT {_SILVER_COLUMNS} FROM"
    return {
        "feed_items_xml": _sql(
            ENTRIES,
            f"""SELECT doc_id, 0 AS entry_no, source, link, {_strip('title')} AS title, published, NULL AS updated,
              md5({_strip('coalesce(summary, description)')}) AS text_md5 FROM entries WHERE doc_id % 25 <> 3
            UNION ALL
            SELECT doc_id, 1, source, 'https://news.example/second', 'second', '', '2025-11-03T10:00:00Z', md5('more')
            FROM entries WHERE doc_id % 25 <> 3
            UNION ALL
            SELECT doc_id, NULL, source, NULL, NULL, '', NULL, NULL FROM entries WHERE doc_id % 25 = 3""",
        ),
        "feeds_to_log": _sql(
            # These documents carry no `updated`.
            EV.replace("coalesce(nullif(published, ''), nullif(updated, ''), '')", "coalesce(published, '')")
            + f", sent AS {_one('ev', 'drop_no, feed_no, title, published_raw')}",
            """SELECT id, source, md5(title) AS title_md5, md5(summary) AS summary_md5, link, published_raw,
              'now' AS ingested_at, '2025-11-0' || (drop_no + 1) || ' 00:00:00.000000' AS sent_at FROM sent""",
        ),
        "feed_events": _sql(
            EV, "SELECT id, source, title, md5(summary) AS summary_md5, link, published_raw, ingested_at FROM ev"
        ),
        "event_id": _sql(ENTRIES, "SELECT doc_id, substr(sha256(link), 1, 16) AS id FROM entries"),
        "first_seen": _sql(
            f"{EV}, {_FIRST}", f"SELECT id, source, title, published_raw, {_shown('kafka_ts')} AS kafka_ts FROM first"
        ),
        "new_since_published": _sql(
            f"{EV}, later AS {_one('ev', _ARRIVAL, 'drop_no > 0')}",
            f"""SELECT id, source, link, {_shown('kafka_ts')} AS kafka_ts FROM later
            WHERE id NOT IN (SELECT id FROM ev WHERE drop_no = 0)""",
        ),
        "ingest_counters": _sql(f"{EV}, {_FIRST}", _POLLS),
        "keyed_publish": _sql(
            EV,
            f"""SELECT id AS key, id, source, title, md5(summary) AS summary, link, published_raw, ingested_at,
            {_shown('kafka_ts')} AS sent_at FROM ev""",
        ),
        "json_events": _sql(
            EV,
            "SELECT "
            + ", ".join(
                f"CASE WHEN id < 'c' THEN {expr} END AS {name}"
                for name, expr in [
                    ("id", "id"), ("source", "source"), ("title", "title"), ("summary", "md5(summary)"),
                    ("link", "link"), ("published_raw", "published_raw"), ("ingested_at", "ingested_at"),
                ]
            )
            + f", {_shown('kafka_ts')} AS kafka_ts FROM ev",
        ),
        "json_props": "SELECT event_id, CAST(props ->> 'k' AS INTEGER) AS k FROM events",
        "html_strip": f"SELECT page_id, {_plain('html')} AS body FROM pages",
        "published_at": _sql(
            EV,
            f"""SELECT id, published_raw,
              {_shown("coalesce(try_cast(published_raw AS TIMESTAMP), kafka_ts)")} AS published_at,
              {_shown("try_cast(ingested_at AS TIMESTAMP)")} AS ingested_at,
              {_shown(f"CASE WHEN published_raw = '{RFC822}' THEN TIMESTAMP '2025-11-03 01:00:00' "
                      "ELSE coalesce(try_cast(published_raw AS TIMESTAMP), kafka_ts) END")} AS published_at_rfc822
            FROM ev""",
        ),
        "silver_clean": _sql(SILVER, f"{silver_like} silver"),
        "bronze_merge": _sql(f"{EV}, {_BRONZE}", f"SELECT {_BRONZE_COLUMNS} FROM bronze"),
        "silver_upsert": _sql(f"{CLEAN}, {_STREAM_SILVER}", f"{silver_like} last"),
        "daily_source": _sql(COUNTS, "SELECT CAST(dt AS VARCHAR) AS dt, source, article_count FROM counts"),
        "daily_keyword": _sql(WORDS, "SELECT CAST(dt AS VARCHAR) AS dt, token, freq FROM words"),
        "daily_keyword_for_date": _sql(
            WORDS, f"SELECT CAST(dt AS VARCHAR) AS dt, token, freq FROM words WHERE dt = DATE '{DATE}'"
        ),
        "gold_replace": _sql(
            f"{SILVER}, {_SOURCES_EARLY}, {_counts('c1', 'early')}, {_counts('c2', 'silver')}, "
            f"{_words('w1', 'early')}, {_words('w2', 'silver')}",
            f"""SELECT 'source' AS mart, CAST(dt AS VARCHAR) AS dt, source AS name, article_count AS n FROM (
              SELECT * FROM c1 WHERE dt <> DATE '{DATE}' UNION ALL SELECT * FROM c2 WHERE dt = DATE '{DATE}')
            UNION ALL
            SELECT 'keyword' AS mart, CAST(dt AS VARCHAR) AS dt, token AS name, freq AS n FROM (
              SELECT * FROM w1 WHERE dt <> DATE '{DATE}' UNION ALL SELECT * FROM w2 WHERE dt = DATE '{DATE}')""",
        ),
        "top_sources": _sql(
            COUNTS,
            """SELECT CAST(dt AS VARCHAR) AS dt, source, article_count FROM counts
            ORDER BY article_count DESC, counts.dt, source LIMIT 10""",
        ),
        "top_keywords": _sql(
            WORDS,
            """SELECT CAST(dt AS VARCHAR) AS dt, token, freq FROM words
            ORDER BY freq DESC, words.dt, token LIMIT 15""",
        ),
        "top_keywords_per_day": _sql(
            WORDS,
            """SELECT CAST(dt AS VARCHAR) AS dt, token, freq,
              CAST(row_number() OVER (PARTITION BY words.dt ORDER BY freq DESC, token) AS INTEGER) AS rank
            FROM words QUALIFY rank <= 15""",
        ),
        "recent_articles": _sql(SILVER, f"{silver_like} silver WHERE silver.dt >= DATE '{AS_OF}' - INTERVAL 1 DAY"),
        "embed_text": _sql(SILVER, f"SELECT id, md5({_embed_text('title', 'body')}) AS text_md5 FROM silver"),
        "hash_embedding": _sql(
            _HASHED,
            f"SELECT doc_id, 1536 AS dim, CAST(1.0 AS DOUBLE) AS length, {_COMPONENTS}, true AS repeats FROM sized",
        ),
        "point_id": _sql(
            ENTRIES,
            """SELECT doc_id, CAST(CAST('0x' || substr(sha256(link), 1, 16) AS UBIGINT) AS VARCHAR) AS point_id
            FROM entries""",
        ),
        "vector_upsert": _sql(
            f"""{CLEAN}, b0 AS {_one('clean', _LATEST, 'drop_no = 0')}, b1 AS {_one('clean', _LATEST, 'drop_no > 0')},
            merged AS (SELECT * FROM b1 UNION ALL SELECT * FROM b0 WHERE id NOT IN (SELECT id FROM b1)),
            embedded AS (SELECT *, {_digest_vector(_embed_text('title', 'body'))} AS v FROM merged),
            sized AS (SELECT *, sqrt(48 * list_sum(list_transform(v, lambda x: x * x))) AS size FROM embedded)""",
            f"""SELECT CAST(CAST('0x' || id AS UBIGINT) AS VARCHAR) AS point_id, {_COMPONENTS}, true AS repeats,
              id AS article_id, source, title, substr(body, 1, 2000) AS body, link,
              CAST(published_at AS VARCHAR) AS published_at FROM sized""",
        ),
        "knn_topk": _KNN,
        "knn_cells": _KNN,
        "rag_contexts": _sql(
            f"{SILVER}, {_points()}, {_ASKED}, {_search('found', 'asked', 'points')}", "SELECT qid, contexts FROM found"
        ),
        "briefing_prompts": _sql(
            f"""{SILVER}, {_points()}, {_ASKED}, {_search('found', 'asked', 'points')},
            r AS (SELECT f.*, q.text, {_echo(_ROLES.researcher, _RESEARCH_PROMPT)} AS research
                  FROM found f JOIN asked q ON q.qid = f.qid),
            a AS (SELECT *, {_echo(_ROLES.analyst, _labelled('[정리된 이슈]', 'research'))} AS analysis FROM r)""",
            f"""SELECT qid, CASE WHEN length(text) > 100 THEN {_reinforced('text', 'text')} ELSE text END AS search_text,
              {_RESEARCH_PROMPT} AS research_prompt, {_labelled('[정리된 이슈]', 'research')} AS analysis_prompt,
              {_labelled('[분석]', 'analysis')} AS critique_prompt,
              {_labelled('[승인된 분석]', 'analysis', '[근거 기사]')} AS report_prompt FROM a""",
        ),
        "verdict": """SELECT conv_id, turn, CASE WHEN contains(string_split(upper(answer), 'VERDICT:')[-1], 'APPROVE')
              THEN 'APPROVE' ELSE 'REVISE' END AS verdict
            FROM (SELECT conv_id, turn, CASE role WHEN 'assistant' THEN text || chr(10) || 'Verdict: approve'
              WHEN 'user' THEN 'APPROVE? ' || text || chr(10) || 'VERDICT: REVISE' ELSE text END AS answer
              FROM conversations)""",
        "briefing_loop": _sql(
            f"""{SILVER}, {_points("CASE WHEN source IN ('src3', 'src7') THEN source || ' Approved' ELSE source END")},
            {_LOOP}""",
            f"SELECT qid, contexts, research, analysis, critique, verdict, loops, {_BRIEFING} AS briefing FROM settled",
        ),
        "daily_run": _sql(
            f"""{CLEAN}, {_STREAM_SILVER},
            recent AS (SELECT * FROM last WHERE dt >= DATE '{AS_OF}' - INTERVAL 1 DAY), {_points(silver='recent')}, {_LOOP}""",
            f"SELECT qid, contexts, verdict, loops, {_BRIEFING} AS briefing, '{AS_OF}' AS dt FROM settled",
        ),
        "indexed_total": _sql(
            CLEAN,
            """SELECT CAST(drop_no AS INTEGER) AS batch, count(DISTINCT id) AS indexed FROM clean GROUP BY drop_no
            UNION ALL SELECT 3, 0""",
        ),
        "empty_inputs": _sql(
            SILVER,
            """SELECT unnest(['hits', 'contexts', 'briefings', 'points', 'published again', 'indexed', 'stored']) AS name,
              unnest([0, 0, 0, 0, 0, 0, count(*)]) AS n FROM silver""",
        ),
        "both_tables": _sql(
            f"{CLEAN}, {_BRONZE}, {_STREAM_SILVER}",
            """SELECT 'bronze' AS name, id, source, md5(title) AS title_md5, link FROM bronze
            UNION ALL SELECT 'silver', id, source, md5(title), link FROM last""",
        ),
        "replayed_batches": _sql(
            f"{CLEAN}, {_BRONZE}, {_STREAM_SILVER}",
            f"""SELECT 'bronze' AS name, id, source, published_raw AS published, md5(title) AS title_md5 FROM bronze
            UNION ALL SELECT 'silver', id, source, {_shown('published_at')}, md5(title) FROM last""",
        ),
        "silver_by_name": _sql(
            f"{CLEAN}, {_STREAM_SILVER}",
            f"SELECT {_SILVER_COLUMNS}, '9/0' AS opened FROM last WHERE last.dt = DATE '{DATE}'",
        ),
        "bronze_by_name": _sql(
            f"{EV}, {_BRONZE}",
            f"SELECT drop_no AS batch_id, id, {_ODD_SOURCE} AS source, md5(title) AS title_md5 FROM bronze",
        ),
        "stream_bronze": _sql(f"{EV}, {_BRONZE}", f"SELECT {_BRONZE_COLUMNS} FROM bronze"),
        "stream_silver": _sql(f"{CLEAN}, {_STREAM_SILVER}", f"{silver_like} last"),
        "stream_dedupe": _sql(f"{EV}, {_BRONZE}", f"SELECT {_FIRST_COLUMNS} FROM bronze"),
        "stream_dedupe_window": _sql(
            _WINDOW, " UNION ALL ".join(f"SELECT {_FIRST_COLUMNS} FROM k{n}" for n in range(3))
        ),
        "stream_counters": _sql(f"{EV}, {_FIRST}", _POLLS),
        "live_marts": _sql(_LIVE, " UNION ALL ".join(map(_marts_after, range(3)))),
        "sketched_keywords": _sql(
            WORDS,
            """SELECT token, CAST(sum(freq) AS BIGINT) AS freq, TRUE AS within_bound FROM words
            GROUP BY token ORDER BY 2 DESC, 1 LIMIT 15""",
        ),
        "seen_filter": _sql(
            f"{EV}, published AS (SELECT DISTINCT id FROM ev WHERE drop_no = 0), asked AS (SELECT DISTINCT id FROM ev WHERE drop_no > 0)",
            """SELECT (SELECT count(*) FROM published) AS published, count(*) AS asked,
              count(*) FILTER (id IN (SELECT id FROM published)) AS known, 0::BIGINT AS missed, TRUE AS few_false_alarms FROM asked""",
        ),
        "embed_once": _sql(
            f"""{SILVER}, early AS {_one('clean', _LATEST, 'drop_no = 0')},
            runs AS (SELECT 0 AS run, id, {_embed_text('title', 'body')} AS text FROM early
              UNION ALL SELECT 1, id, {_embed_text('title', 'body')} FROM silver),
            made AS (SELECT text, min(run) AS made_in FROM runs GROUP BY text)""",
            f"""SELECT r.run, r.id AS article_id,
              {', '.join(f"length(r.text) - length(replace(r.text, '{c}', '')) AS n_{c}" for c in LETTERS)}, m.made_in,
              (SELECT count(*) FROM made o WHERE o.made_in = r.run) AS embedded
            FROM runs r JOIN made m ON m.text = r.text""",
        ),
        "feed_files_split": _sql(
            ENTRIES,
            f"""SELECT source, CAST(row_number() OVER (PARTITION BY source ORDER BY doc_id) - 1 AS INTEGER) AS entry_no, link,
              {_strip('title')} AS title, published, md5({_strip('coalesce(summary, description)')}) AS text_md5 FROM entries""",
        ),
        "late_events": _sql(_WINDOW, " UNION ALL ".join(map(_drop_report, range(3)))),
    }
