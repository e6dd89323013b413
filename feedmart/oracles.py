"""The same queries as plain SQL over the test tables, to compare results with."""

from __future__ import annotations

from feedmart.queries import DAY, KEPT_SCORE, MIN_REACTIONS, MIN_SCORE, OTHER_DAY, PAGE, PAGE_ROWS, STORY_AUTHORS, THRESHOLDS
from feedmart.schemas import FEED_CAP
from feedmart.sources.tables import RUNS_APART

_RAW = """
raw_stories AS (
  SELECT event_id AS id,
         CASE WHEN event_id % 11 <> 0 THEN event_type END AS title,
         CAST(floor(value) AS INTEGER) AS score,
         CASE WHEN user_id % 13 <> 0 THEN 'user_' || user_id END AS "by",
         CAST(regexp_extract(props, '"k": *([0-9]+)', 1) AS INTEGER) AS descendants,
         CAST(epoch(date_trunc('second', ts)) AS BIGINT) AS "time",
         CASE WHEN event_id % 7 <> 0 THEN 'https://example.com/s/' || event_id END AS url,
         CAST(ts AS DATE) AS ingested_date,
         date_trunc('second', ts) AS published_at
  FROM events
),
raw_articles AS (
  SELECT p_partkey AS id,
         CASE WHEN p_partkey % 17 <> 0 THEN p_name END AS title,
         CAST(floor(p_retailprice) AS INTEGER) AS positive_reactions_count,
         p_size AS public_reactions_count,
         p_size AS comments_count,
         p_brand AS author,
         CASE WHEN p_partkey % 19 <> 0
              THEN CAST(DATE '2024-01-01' + CAST(p_partkey % 30 AS INTEGER) AS VARCHAR) || 'T12:30:15Z' END AS published_at,
         CASE WHEN p_brand = 'Brand#7' OR p_size % 7 = 0 THEN NULL
              WHEN p_size % 7 = 1 THEN ''
              ELSE replace(p_name, ' ', ', ') END AS tag_list,
         CAST(NULL AS VARCHAR) AS url,
         p_size AS reading_time_minutes,
         CAST(DATE '2024-01-01' + CAST(p_partkey % 30 AS INTEGER) AS DATE) AS ingested_date
  FROM part
)
"""

# Tags as they come out of a JSON record: joined without blanks if they were a list, and never ''.
_LANDED_ARTICLES = """
landed_articles AS (
  SELECT * REPLACE (nullif(CASE WHEN id % 2 = 0 THEN replace(tag_list, ', ', ',') ELSE tag_list END, '') AS tag_list)
  FROM raw_articles
)
"""

_STAGED = """
stg_stories AS (
  SELECT id, coalesce(title, 'Untitled') AS title, coalesce(score, 0) AS score,
         coalesce("by", 'unknown') AS author, coalesce(descendants, 0) AS num_comments,
         published_at, CAST(published_at AS DATE) AS story_date, url, ingested_date
  FROM raw_stories
),
stg_articles AS (
  SELECT id, coalesce(title, 'Untitled') AS title,
         coalesce(positive_reactions_count, 0) AS positive_reactions_count,
         coalesce(public_reactions_count, 0) AS public_reactions_count,
         coalesce(comments_count, 0) AS comments_count,
         coalesce(author, 'unknown') AS author,
         CAST(published_at AS TIMESTAMP) AS published_at,
         CAST(CAST(published_at AS TIMESTAMP) AS DATE) AS story_date,
         tag_list, url, coalesce(reading_time_minutes, 0) AS reading_time_minutes, ingested_date
  FROM raw_articles
)
"""

_MARTS = """
top_stories AS (
  SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY ingested_date ORDER BY score DESC, id) AS rank FROM stg_stories
  ) WHERE rank <= 100
),
author_stats AS (
  SELECT author, count(*) AS post_count, round(avg(score), 2) AS avg_score,
         CAST(sum(num_comments) AS BIGINT) AS total_comments,
         min(story_date) AS first_seen, max(story_date) AS last_seen
  FROM stg_stories GROUP BY author
),
article_tags AS (
  SELECT author, trim(unnest(string_split(tag_list, ','))) AS tag
  FROM stg_articles WHERE tag_list IS NOT NULL AND tag_list <> ''
),
author_tags AS (SELECT author, tag, count(*) AS tag_count FROM article_tags GROUP BY author, tag),
author_top_tags AS (
  SELECT author, string_agg(tag, ', ' ORDER BY tag_count DESC, tag) AS most_used_tags
  FROM (
    SELECT *, row_number() OVER (PARTITION BY author ORDER BY tag_count DESC, tag) AS rn FROM author_tags
  ) WHERE rn <= 3 GROUP BY author
),
article_author_stats AS (
  SELECT b.author, b.post_count, b.total_reactions, b.avg_reading_time, t.most_used_tags
  FROM (
    SELECT author, count(*) AS post_count,
           CAST(sum(positive_reactions_count + public_reactions_count) AS BIGINT) AS total_reactions,
           round(avg(reading_time_minutes), 2) AS avg_reading_time
    FROM stg_articles GROUP BY author
  ) b LEFT JOIN author_top_tags t ON b.author = t.author
)
"""

_STORY_FIELDS = 'id, title, CAST(score AS BIGINT) AS score, "by", CAST(descendants AS BIGINT) AS descendants, "time", url'
_EXPLORED = "id, title, score, author, num_comments, published_at, url, story_date"
_NAMES = ", ".join(f"'{name}'" for name in STORY_AUTHORS)


def _raw(select: str) -> str:
    return f"WITH {_RAW}, {_LANDED_ARTICLES} {select}"


def _model(select: str) -> str:
    return f"WITH {_RAW}, {_STAGED}, {_MARTS} {select}"


def _changed(select: str, changed: str = f"ingested_date = DATE '{DAY}'") -> str:
    """With the stories of one day, or of all that `changed` names, replaced by those with a high score."""
    kept = f"FROM raw_stories WHERE NOT ({changed}) OR score >= {KEPT_SCORE}"
    return f"WITH {_RAW}, {_STAGED.replace('FROM raw_stories', kept)}, {_MARTS} {select}"


def _null_check(model: str, column: str) -> str:
    return (
        f"SELECT '{model}' AS model, '{column}' AS \"column\", 'not_null' AS \"check\", "
        f"count(*) FILTER (WHERE {column} IS NULL) AS failures FROM {model}"
    )


def _threshold(at: int) -> str:
    rows = f"(SELECT * FROM top_stories WHERE score >= {at})"
    return f"""
        SELECT CAST({at} AS INTEGER) AS threshold, (SELECT count(*) FROM {rows}) AS row_count,
               (SELECT max(score) FROM {rows}) AS top_score, (SELECT author FROM {rows} ORDER BY score DESC, id LIMIT 1) AS top_author,
               (SELECT author FROM {rows} GROUP BY author ORDER BY count(*) DESC, author LIMIT 1) AS active_author,
               (SELECT max(n) FROM (SELECT count(*) AS n FROM {rows} GROUP BY author)) AS active_count,
               (SELECT min(score) FROM {rows}) AS min_score,
               (SELECT CASE WHEN min(score) = max(score) THEN max(score) + 1 ELSE max(score) END FROM {rows}) AS max_score,
               (SELECT CAST(sum(s) AS BIGINT) FROM
                 (SELECT sum(score) AS s FROM {rows} GROUP BY author ORDER BY s DESC, author LIMIT 10)) AS top_authors_score"""


def _counts(*names: str) -> str:
    return " UNION ALL ".join(f"SELECT '{name}' AS table_name, count(*) AS row_count FROM {name}" for name in names)


ORACLES: dict[str, str] = {
    "parse_stories": _raw(f"SELECT {_STORY_FIELDS} FROM raw_stories"),
    "parse_articles": _raw("""
        SELECT id, title, CAST(positive_reactions_count AS BIGINT) AS positive_reactions_count,
               CAST(public_reactions_count AS BIGINT) AS public_reactions_count,
               CAST(comments_count AS BIGINT) AS comments_count, author, published_at, tag_list, url,
               CAST(reading_time_minutes AS BIGINT) AS reading_time_minutes
        FROM landed_articles"""),
    "parse_edge_cases": """
        SELECT 'stories' AS feed, event_id AS record, k NOT IN (5, 6, 7, 8, 9, 10, 11) AS ok,
               CASE WHEN k IN (0, 1, 3, 14, 15) THEN event_id WHEN k IN (4, 12, 13) THEN 7 END AS id,
               CASE WHEN k = 12 THEN CAST(event_id AS VARCHAR) WHEN k = 15 THEN 't' END AS title,
               CASE WHEN k IN (2, 4, 13) THEN event_id WHEN k = 14 THEN 1
                    WHEN k IN (0, 1, 3, 12, 15) THEN 0 END AS score,
               CAST(NULL AS VARCHAR) AS author, CAST(NULL AS VARCHAR) AS tag_list
        FROM (SELECT event_id, event_id % 16 AS k FROM events)
        UNION ALL
        SELECT 'articles', p_partkey, k NOT IN (6, 8, 12),
               CASE WHEN k IN (2, 7, 9) THEN 7 WHEN k NOT IN (6, 8, 12) THEN p_partkey END,
               NULL, CASE WHEN k NOT IN (6, 8, 12) THEN 0 END,
               CASE WHEN k = 9 THEN 'u' || p_partkey END,
               CASE WHEN k = 2 THEN 'a, ' || p_partkey WHEN k = 7 THEN 'a,None,' || p_partkey END
        FROM (SELECT p_partkey, p_partkey % 13 AS k FROM part)""",
    "parse_quarantine": """
        SELECT 'stories' AS feed, count(*) FILTER (WHERE event_id % 13 <> 0 AND event_id % 23 <> 0) AS rows_fetched,
               count(*) FILTER (WHERE event_id % 13 = 0 OR event_id % 23 = 0) AS errors FROM events
        UNION ALL
        SELECT 'articles', count(*) FILTER (WHERE p_partkey % 13 <> 0 AND p_partkey % 23 <> 0),
               count(*) FILTER (WHERE p_partkey % 13 = 0 OR p_partkey % 23 = 0) FROM part""",
    "parse_fail_mode": """
        SELECT 'stories' AS feed, count(*) FILTER (WHERE event_id % 13 <> 0) AS rows_fetched,
               count(*) FILTER (WHERE event_id % 13 = 0) AS errors FROM events
        UNION ALL
        SELECT 'articles', count(*) FILTER (WHERE p_partkey % 13 <> 0), count(*) FILTER (WHERE p_partkey % 13 = 0) FROM part""",
    "feed_cap": _raw(f"""
        SELECT id, title, score, CAST(month AS DATE) AS ingested_date FROM (
          SELECT *, date_trunc('month', ingested_date) AS month,
                 row_number() OVER (PARTITION BY date_trunc('month', ingested_date) ORDER BY "time" DESC, id) AS pos
          FROM raw_stories
        ) WHERE pos <= {FEED_CAP}"""),
    "landing_array_files": _raw("""
        SELECT 'stories' AS feed, ingested_date, count(*) AS row_count, CAST(sum(id) AS BIGINT) AS ids, count(title) AS titles
        FROM raw_stories GROUP BY ingested_date
        UNION ALL
        SELECT 'articles', ingested_date, count(*), CAST(sum(id) AS BIGINT), count(title) FROM landed_articles GROUP BY ingested_date"""),
    "landing_large_arrays": _raw("""
        SELECT 'stories' AS feed, ingested_date, count(*) AS row_count, CAST(sum(id) AS BIGINT) AS ids, count(title) AS titles
        FROM raw_stories GROUP BY ingested_date
        UNION ALL
        SELECT 'articles', ingested_date, count(*), CAST(sum(id) AS BIGINT), count(title) FROM landed_articles GROUP BY ingested_date"""),
    "landing_roundtrip": _raw(f"SELECT {_STORY_FIELDS}, ingested_date AS landed_date FROM raw_stories"),
    "landing_latest_day": _raw("""
        SELECT 'stories' AS feed, max(ingested_date) AS latest_day FROM raw_stories
        UNION ALL SELECT 'articles', max(ingested_date) FROM raw_articles"""),
    "raw_stories": _raw("SELECT * EXCLUDE (published_at) FROM raw_stories"),
    "raw_articles": _raw("SELECT * FROM landed_articles"),
    "replace_day": _raw(f"""
        SELECT id, score, "by", ingested_date FROM raw_stories
        WHERE ingested_date <> DATE '{DAY}' OR score >= {KEPT_SCORE}"""),
    "replace_day_empty": _raw(f"""
        SELECT id, score, "by", ingested_date FROM raw_stories WHERE ingested_date <> DATE '{DAY}'"""),
    "replace_day_interrupted": _raw(f"""
        SELECT id, score, "by", ingested_date FROM raw_stories
        WHERE ingested_date <> DATE '{OTHER_DAY}' OR score >= {KEPT_SCORE}"""),
    "reload_days_empty": _raw(f"""
        SELECT id, score, "by", ingested_date FROM raw_stories WHERE ingested_date <> DATE '{DAY}'"""),
    "land_days_again": _raw(f"""
        SELECT ingested_date,
               count(*) FILTER (WHERE ingested_date <= DATE '{DAY}' OR (id % 13 <> 0 AND id % 23 <> 0)) AS good,
               count(*) FILTER (WHERE ingested_date > DATE '{DAY}' AND (id % 13 = 0 OR id % 23 = 0)) AS bad
        FROM raw_stories GROUP BY ingested_date"""),
    "run_log": """
        SELECT feed, rows_fetched, errors, true AS run_before_now, feed || '/ingested_date=%s' AS path_end FROM (
          SELECT 'stories' AS feed, count(*) FILTER (WHERE event_id % 13 <> 0 AND event_id % 23 <> 0) AS rows_fetched,
                 count(*) FILTER (WHERE event_id % 13 = 0 OR event_id % 23 = 0) AS errors FROM events
          UNION ALL
          SELECT 'articles', count(*) FILTER (WHERE p_partkey % 13 <> 0 AND p_partkey % 23 <> 0),
                 count(*) FILTER (WHERE p_partkey % 13 = 0 OR p_partkey % 23 = 0) FROM part)""".replace("%s", DAY),
    "run_log_repeated": f"""
        WITH runs AS (
          SELECT 'stories' AS feed, count(*) AS n, count(*) FILTER (WHERE event_id % 13 <> 0 AND event_id % 23 <> 0) AS good FROM events
          UNION ALL SELECT 'articles', count(*), count(*) FILTER (WHERE p_partkey % 13 <> 0 AND p_partkey % 23 <> 0) FROM part
        )
        SELECT feed, n AS rows_fetched, CAST(0 AS BIGINT) AS errors FROM runs
        UNION ALL SELECT feed || ' again', good, n - good FROM runs, range({RUNS_APART // 2})""",
    "daily_catch_up": _changed("""
        SELECT 'stg_stories' AS table_name, count(*) AS row_count, CAST(sum(id * score) AS BIGINT) AS total FROM stg_stories
        UNION ALL SELECT 'stg_articles', count(*), CAST(sum(id) AS BIGINT) FROM stg_articles
        UNION ALL SELECT 'top_stories', count(*), CAST(sum(id * rank) AS BIGINT) FROM top_stories
        UNION ALL SELECT 'author_stats', count(*), CAST(sum(post_count * total_comments) AS BIGINT) FROM author_stats
        UNION ALL SELECT 'article_author_stats', count(*), CAST(sum(post_count * total_reactions) AS BIGINT) FROM article_author_stats""",
        f"ingested_date IN (DATE '{DAY}', DATE '{OTHER_DAY}') OR ingested_date = (SELECT max(ingested_date) FROM raw_stories)"),
    "daily_author_stats_months": _changed("SELECT * FROM author_stats", f"ingested_date = DATE '{DAY}' AND id % 3 = 0"),
    "daily_author_stats": _changed("SELECT * FROM author_stats"),
    "daily_author_stats_full": _changed("SELECT * FROM author_stats"),
    "daily_article_author_stats": _changed("SELECT * FROM article_author_stats"),
    "daily_top_stories": _changed("SELECT * FROM top_stories"),
    "quality_gate": f"""
        WITH {_RAW}, {_STAGED}, s AS (
          SELECT id, CASE WHEN id % 31 <> 0 THEN author END AS author FROM stg_stories
        )
        SELECT * FROM (
          SELECT 'stg_stories' AS model, 'id' AS "column", 'not_null' AS "check", count(*) FILTER (WHERE id % 29 = 0) AS failures FROM s
          UNION ALL SELECT 'stg_stories', 'author', 'not_null', count(*) FILTER (WHERE author IS NULL) FROM s
          UNION ALL SELECT 'author_stats', 'author', 'not_null', 2 * CAST(max(author IS NULL) AS BIGINT) FROM s
          UNION ALL SELECT 'author_stats', 'author', 'unique', count(DISTINCT author) FROM s
        ) WHERE failures > 0""",
    "top_stories_of_day": _model(f"SELECT * FROM top_stories WHERE ingested_date = DATE '{DAY}'"),
    "explore_stored": _model(f"""
        SELECT (SELECT min(score) FROM top_stories WHERE score >= {MIN_SCORE}) AS min_score,
               (SELECT CASE WHEN min(score) = max(score) THEN max(score) + 1 ELSE max(score) END
                FROM top_stories WHERE score >= {MIN_SCORE}) AS max_score,
               (SELECT count(*) FROM top_stories WHERE score >= {MIN_SCORE}) AS row_count,
               (SELECT author FROM top_stories WHERE score >= {MIN_SCORE} ORDER BY score DESC, id LIMIT 1) AS top_author,
               (SELECT author FROM top_stories WHERE score >= {MIN_SCORE}
                GROUP BY author ORDER BY count(*) DESC, author LIMIT 1) AS active_author"""),
    "explore_empty": """
        SELECT CAST(0 AS BIGINT) AS row_count, CAST(NULL AS INTEGER) AS top_score, CAST(NULL AS VARCHAR) AS top_author,
               CAST(NULL AS VARCHAR) AS active_author, CAST(NULL AS BIGINT) AS active_count""",
    "author_stats_page": _model(f"""
        SELECT row_number() OVER (ORDER BY post_count DESC, author) AS place, author, post_count FROM author_stats
        ORDER BY place LIMIT {PAGE}"""),
    "explore_filtered_page": _model(f"""
        SELECT row_number() OVER (ORDER BY score DESC, id) AS place, id, score FROM top_stories WHERE score >= {MIN_SCORE}
        ORDER BY place LIMIT {PAGE}"""),
    "explore_authors_page": _model(f"""
        SELECT row_number() OVER (ORDER BY author) AS place, author FROM (SELECT DISTINCT author FROM top_stories)
        WHERE author IS NOT NULL ORDER BY place LIMIT {PAGE}"""),
    "explore_pages": _model(f"""
        SELECT CAST((place - 1) // {PAGE_ROWS} + 1 AS BIGINT) AS page, place, id, score
        FROM (SELECT row_number() OVER (ORDER BY score DESC, id) AS place, id, score FROM top_stories)"""),
    "explore_thresholds": _model(" UNION ALL ".join(_threshold(at) for at in THRESHOLDS)),
    "loaded_day_count": _raw(f"SELECT count(*) AS row_count FROM raw_stories WHERE ingested_date = DATE '{DAY}'"),
    "daily_run": _model(
        _counts("raw_stories", "raw_articles", "stg_stories", "stg_articles", "top_stories", "author_stats", "article_author_stats")
    ),
    "stg_stories": _model("SELECT * FROM stg_stories"),
    "stg_articles": _model("SELECT * FROM stg_articles"),
    "top_stories": _model("SELECT * FROM top_stories"),
    "author_stats": _model("SELECT * FROM author_stats"),
    "article_tags": _model("SELECT * FROM article_tags"),
    "author_tags": _model("SELECT * FROM author_tags"),
    "author_top_tags": _model("SELECT * FROM author_top_tags"),
    "article_author_stats": _model("SELECT * FROM article_author_stats"),
    "quality_checks": _model(
        " UNION ALL ".join([
            _null_check("stg_stories", "id"),
            _null_check("stg_stories", "title"),
            _null_check("stg_stories", "author"),
            _null_check("stg_articles", "id"),
            _null_check("stg_articles", "author"),
            _null_check("top_stories", "id"),
            _null_check("top_stories", "title"),
            _null_check("top_stories", "rank"),
            _null_check("author_stats", "author"),
            "SELECT 'author_stats', 'author', 'unique', count(*) FROM "
            "(SELECT author FROM author_stats WHERE author IS NOT NULL GROUP BY author HAVING count(*) > 1)",
            _null_check("author_stats", "post_count"),
            _null_check("article_author_stats", "author"),
        ])
    ),
    "explore_filtered": _model(
        f"SELECT {_EXPLORED} FROM top_stories WHERE score >= {MIN_SCORE} AND author IN ({_NAMES})"
    ),
    "explore_articles": _model(f"""
        SELECT id, title, positive_reactions_count AS score, author, comments_count AS num_comments,
               published_at, url, story_date, reading_time_minutes, tag_list
        FROM stg_articles WHERE positive_reactions_count >= {MIN_REACTIONS}"""),
    "explore_timeline": _model(
        f"SELECT published_at, score, num_comments, title, author FROM top_stories WHERE score >= {MIN_SCORE}"
    ),
    "explore_score_range": _model("""
        SELECT min(score) AS min_score,
               CASE WHEN min(score) = max(score) THEN max(score) + 1 ELSE max(score) END AS max_score
        FROM top_stories"""),
    "explore_authors": _model("SELECT DISTINCT author FROM top_stories WHERE author IS NOT NULL"),
    "explore_summary": _model(f"""
        SELECT (SELECT count(*) FROM top_stories WHERE score >= {MIN_SCORE}) AS row_count,
               t.score AS top_score, t.author AS top_author, a.author AS active_author, a.n AS active_count
        FROM (SELECT score, author FROM top_stories WHERE score >= {MIN_SCORE} ORDER BY score DESC, id LIMIT 1) t,
             (SELECT author, count(*) AS n FROM top_stories WHERE score >= {MIN_SCORE}
              GROUP BY author ORDER BY n DESC, author LIMIT 1) a"""),
    "explore_top_authors": _model(f"""
        SELECT author, CAST(sum(score) AS BIGINT) AS score FROM top_stories WHERE score >= {MIN_SCORE}
        GROUP BY author ORDER BY score DESC, author LIMIT 10"""),
}
