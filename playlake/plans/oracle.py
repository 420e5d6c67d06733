"""DuckDB SQL for every registered query — the independent correctness check.

The SQL restates, from scratch, the mapping of ``sources.eventmap`` and the
semantics of Silver, Gold and the reports, as plain window/aggregate SQL over
the driver's ``events`` view. Output conventions shared with ``catalog``:
dates as ``YYYY-MM-DD`` text, timestamps as ``YYYY-MM-DD HH:MM:SS.mmm`` text,
doubles rounded to 6 decimals, sums and counts as BIGINT.
"""

from __future__ import annotations

from playlake.sources.eventmap import CREATED, RUN_STAMPS, URL_PREFIX

# Fixed values of the incremental scenario (see ``catalog``).
INC_FLOOR = "2024-01-10"
INC_TODAY = "2024-01-30"
INC_STATE_TS = "2024-01-20 00:00:00"
INC_STATE_DATE = "2024-01-20"
INC_STATE_MEDIA_BELOW = 30
INC_AMBIGUOUS_BELOW = 3
INC_SPLIT = "2024-01-24"
AMBIGUOUS = "the state has several marks for one endpoint"
# An instant that cannot be placed: it does not parse, or no Z or +hh:mm follows a time of day.
UNPLACED = r"(TRY_CAST(received_at AS TIMESTAMP) IS NULL OR NOT regexp_matches(received_at, 'T[0-9:.]+(Z|[+-][0-9]{2}:?[0-9]{2})$'))"

TS_FMT = "'%Y-%m-%d %H:%M:%S.%g'"

_CTES: dict[str, str] = {}
_DEPS: dict[str, tuple[str, ...]] = {}


def _cte(name: str, body: str, *deps: str) -> None:
    _CTES[name] = body
    _DEPS[name] = deps


_cte(
    "ev",
    """SELECT event_id, ts, user_id, event_type, value,
              CAST(json_extract_string(props, '$.k') AS INTEGER) % 40 AS k,
              CAST(dayofmonth(ts) AS INTEGER) AS dom
       FROM events""",
)
_cte(
    "runs",
    f"""SELECT 1 AS f, '{RUN_STAMPS[1]}' AS ingest_timestamp, '{RUN_STAMPS[1][:10]}' AS ingest_date
        UNION ALL
        SELECT 2, '{RUN_STAMPS[2]}', '{RUN_STAMPS[2][:10]}'""",
)
_cte(
    "raw_events",
    f"""SELECT
          CASE WHEN e.event_id % 101 = 0 THEN 'bad'
               ELSE strftime(e.ts, '%Y-%m-%dT%H:%M:%S.%gZ') END AS received_at,
          CASE WHEN e.event_id % 97 = 0 THEN NULL ELSE 'e' || CAST(e.event_id AS VARCHAR) END AS event_key,
          '10.' || CAST(r.f AS VARCHAR) || '.' || CAST(e.user_id % 256 AS VARCHAR) || '.'
                || CAST(e.event_id % 256 AS VARCHAR) AS ip,
          CASE e.event_id % 3 WHEN 0 THEN 'US' WHEN 1 THEN 'DE' ELSE 'GB' END AS country,
          CASE WHEN e.event_id % 11 = 0 THEN NULL ELSE sqrt(e.value) / 25 / r.f END AS percent_viewed,
          CASE WHEN e.event_type = 'signup' OR (e.k + e.dom) % 5 = 0
                    OR (r.f = 2 AND e.event_id % 21 = 0) THEN 'form-submit'
               WHEN e.event_type = 'purchase' THEN 'purchase'
               WHEN e.event_type = 'click' THEN NULL
               ELSE '' END AS conversion_type,
          CASE WHEN e.event_id % 89 = 0 THEN NULL ELSE 'v' || CAST(e.user_id AS VARCHAR) END AS visitor_key,
          'Media ' || CAST(e.k AS VARCHAR) AS media_name,
          CASE WHEN e.k % 10 = 9 OR e.event_id % 13 = 0 THEN NULL
               ELSE '{URL_PREFIX}' || CAST(e.k AS VARCHAR) END AS media_url,
          r.ingest_timestamp, r.ingest_date, 'm' || CAST(e.k AS VARCHAR) AS media_id
        FROM ev e JOIN runs r ON r.f = 1 OR e.event_id % 7 = 0""",
    "ev", "runs",
)
_cte(
    "daily",
    """SELECT k, CAST(ts AS DATE) AS day, CAST(dayofmonth(CAST(ts AS DATE)) AS INTEGER) AS dom,
              count(*) AS c, count(*) FILTER (WHERE event_type = 'view') AS pc,
              sum(value) / 3600 AS h
       FROM ev GROUP BY k, CAST(ts AS DATE)""",
    "ev",
)
_cte(
    "raw_by_date",
    """SELECT
          CASE WHEN (d.k + d.dom) % 23 = 0 THEN 'bad' ELSE strftime(d.day, '%Y-%m-%d') END AS date,
          CAST(CASE WHEN (d.k + d.dom) % 17 = 0 THEN NULL
                    WHEN (d.k + d.dom) % 7 = 0 OR (r.f = 2 AND d.dom % 6 = 0) THEN 0
                    ELSE d.c * r.f END AS BIGINT) AS load_count,
          CAST(d.pc AS BIGINT) AS play_count,
          d.h AS hours_watched,
          r.ingest_timestamp, r.ingest_date, 'm' || CAST(d.k AS VARCHAR) AS media_id
        FROM daily d JOIN runs r ON r.f = 1 OR d.dom % 3 = 0""",
    "daily", "runs",
)
_cte(
    "raw_media_metadata",
    f"""SELECT
          CASE WHEN m.k = 38 THEN NULL ELSE 'm' || CAST(m.k AS VARCHAR) END AS hashed_id,
          CASE WHEN m.k % 4 = 0 THEN 'YouTube ad ' || CAST(m.k AS VARCHAR) || ' v' || CAST(r.f AS VARCHAR)
               WHEN m.k % 4 = 1 THEN 'FACEBOOK ' || CAST(m.k AS VARCHAR) || ' v' || CAST(r.f AS VARCHAR)
               WHEN m.k % 4 = 2 THEN 'facebook and youtube ' || CAST(m.k AS VARCHAR) || ' v' || CAST(r.f AS VARCHAR)
               WHEN m.k % 8 = 7 THEN NULL
               ELSE 'Plain ' || CAST(m.k AS VARCHAR) END AS name,
          '{CREATED}' AS created,
          r.ingest_timestamp, r.ingest_date, 'm' || CAST(m.k AS VARCHAR) AS media_id
        FROM (SELECT DISTINCT k FROM ev WHERE k <> 39) m JOIN runs r ON r.f = 1 OR m.k % 5 = 0""",
    "ev", "runs",
)
def _silver_events(raw: str) -> str:
    return f"""SELECT event_key, visitor_key, media_id, media_name, media_url, received_at, ip, country, percent_viewed
       FROM (
         SELECT *, row_number() OVER (
           PARTITION BY event_key
           ORDER BY TRY_CAST(ingest_timestamp AS TIMESTAMP) DESC NULLS LAST, ingest_timestamp DESC NULLS LAST,
                    visitor_key DESC NULLS LAST, media_id DESC NULLS LAST, media_name DESC NULLS LAST,
                    media_url DESC NULLS LAST, received_at DESC NULLS LAST, ip DESC NULLS LAST,
                    country DESC NULLS LAST, percent_viewed DESC NULLS LAST) AS rn
         FROM (
           SELECT * REPLACE (TRY_CAST(received_at AS TIMESTAMP) AS received_at)
           FROM {raw}
           WHERE event_key IS NOT NULL AND visitor_key IS NOT NULL AND media_id IS NOT NULL
             AND received_at IS NOT NULL
             AND (conversion_type IS NULL OR conversion_type = '')))
       WHERE rn = 1"""


_cte("silver_events", _silver_events("raw_events"), "raw_events")


def _silver_by_date(raw: str) -> str:
    return f"""SELECT media_id, date, load_count, play_count, hours_watched
       FROM (
         SELECT *, row_number() OVER (
           PARTITION BY media_id, date
           ORDER BY TRY_CAST(ingest_timestamp AS TIMESTAMP) DESC NULLS LAST, ingest_timestamp DESC NULLS LAST,
                    load_count DESC NULLS LAST, play_count DESC NULLS LAST,
                    hours_watched DESC NULLS LAST) AS rn
         FROM (
           SELECT * REPLACE (TRY_CAST(date AS DATE) AS date)
           FROM {raw}
           WHERE media_id IS NOT NULL AND date IS NOT NULL AND load_count IS NOT NULL
             AND load_count > 0))
       WHERE rn = 1"""


_cte("silver_by_date", _silver_by_date("raw_by_date"), "raw_by_date")
def _silver_media(raw: str) -> str:
    return f"""SELECT media_id, name, created
       FROM (
         SELECT *, row_number() OVER (
           PARTITION BY media_id
           ORDER BY TRY_CAST(ingest_timestamp AS TIMESTAMP) DESC NULLS LAST, ingest_timestamp DESC NULLS LAST,
                    name DESC NULLS LAST, created DESC NULLS LAST) AS rn
         FROM (
           SELECT hashed_id AS media_id, name, TRY_CAST(created AS TIMESTAMP) AS created, ingest_timestamp
           FROM {raw}
           WHERE hashed_id IS NOT NULL))
       WHERE rn = 1"""


_cte("silver_media", _silver_media("raw_media_metadata"), "raw_media_metadata")


def _gold_ctes(prefix: str = "") -> None:
    """dim_media, dim_visitor and fact over the Silver tables of the same prefix."""
    events, by_date, media = (f"{prefix}silver_{t}" for t in ("events", "by_date", "media"))
    _cte(
        f"{prefix}dim_media",
        f"""SELECT m.media_id, m.name AS title, u.url,
                  CASE WHEN lower(m.name) LIKE '%youtube%' THEN 'Youtube'
                       WHEN lower(m.name) LIKE '%facebook%' THEN 'Facebook'
                       ELSE 'Unknown' END AS channel,
                  m.created AS created_at
           FROM {media} m
           LEFT JOIN (
             SELECT media_id, url FROM (
               SELECT media_id, media_url AS url,
                      row_number() OVER (PARTITION BY media_id
                                         ORDER BY max(received_at) DESC NULLS LAST, media_url DESC) AS rn
               FROM {events} WHERE media_url IS NOT NULL
               GROUP BY media_id, media_url)
             WHERE rn = 1) u
             ON u.media_id = m.media_id""",
        media, events,
    )
    _cte(
        f"{prefix}dim_visitor",
        f"""SELECT visitor_key AS visitor_id, ip AS ip_address, country
           FROM (
             SELECT *, row_number() OVER (
               PARTITION BY visitor_key
               ORDER BY received_at DESC NULLS LAST, event_key DESC NULLS LAST) AS rn
             FROM {events})
           WHERE rn = 1""",
        events,
    )
    _cte(
        f"{prefix}fact",
        f"""SELECT p.media_id, p.visitor_id, p.date, p.play_count, p.watched_percent,
                  CAST(b.play_count AS DOUBLE) / CAST(b.load_count AS DOUBLE) AS play_rate,
                  b.hours_watched AS total_watch_time
           FROM (
             SELECT media_id, visitor_key AS visitor_id, CAST(received_at AS DATE) AS date,
                    count(*) AS play_count, avg(percent_viewed) AS watched_percent
             FROM {events}
             GROUP BY media_id, visitor_key, CAST(received_at AS DATE)) p
           LEFT JOIN {by_date} b ON b.media_id = p.media_id AND b.date = p.date""",
        events, by_date,
    )


_gold_ctes()
_cte("inc_events_src", f"SELECT * FROM raw_events WHERE NOT {UNPLACED}", "raw_events")
_cte(
    "inc_rejected",
    f"SELECT media_id, count(*) AS n FROM raw_events WHERE {UNPLACED} GROUP BY media_id",
    "raw_events",
)
_cte("inc_media", "SELECT DISTINCT media_id FROM raw_events", "raw_events")
_cte(
    "inc_state",
    f"""SELECT 'events' AS endpoint, media_id, TIMESTAMP '{INC_STATE_TS}' AS watermark_ts,
               CAST(NULL AS DATE) AS watermark_date
        FROM inc_media WHERE CAST(substr(media_id, 2) AS INTEGER) < {INC_STATE_MEDIA_BELOW}
        UNION ALL
        SELECT 'by_date', media_id, CAST(NULL AS TIMESTAMP), DATE '{INC_STATE_DATE}'
        FROM inc_media WHERE CAST(substr(media_id, 2) AS INTEGER) < {INC_STATE_MEDIA_BELOW}""",
    "inc_media",
)
_cte(
    "inc_events",
    f"""SELECT e.*
        FROM inc_events_src e
        JOIN (SELECT m.media_id, coalesce(s.watermark_ts, TIMESTAMP '{INC_FLOOR} 00:00:00') AS since
              FROM inc_media m LEFT JOIN inc_state s
                ON s.media_id = m.media_id AND s.endpoint = 'events') c
          ON c.media_id = e.media_id
        WHERE TRY_CAST(e.received_at AS TIMESTAMP) > c.since""",
    "inc_events_src", "inc_media", "inc_state",
)
_cte(
    "inc_by_date",
    f"""SELECT b.*
        FROM raw_by_date b
        JOIN (SELECT m.media_id, coalesce(s.watermark_date, DATE '{INC_FLOOR}') AS start
              FROM inc_media m LEFT JOIN inc_state s
                ON s.media_id = m.media_id AND s.endpoint = 'by_date') c
          ON c.media_id = b.media_id
        WHERE TRY_CAST(b.date AS DATE) >= c.start AND TRY_CAST(b.date AS DATE) <= DATE '{INC_TODAY}'""",
    "raw_by_date", "inc_media", "inc_state",
)
_cte(
    "inc_meta",
    "SELECT * FROM raw_media_metadata WHERE media_id IN (SELECT media_id FROM inc_media)",
    "raw_media_metadata", "inc_media",
)


# Two loads: the first sees what is older than the split day, the second all of it.
_cte(
    "two_first",
    f"""SELECT e.* FROM inc_events e WHERE CAST(TRY_CAST(e.received_at AS TIMESTAMP) AS DATE) < DATE '{INC_SPLIT}'""",
    "inc_events",
)
_cte(
    "two_marks",
    """SELECT m.media_id, coalesce(f.ts, s.watermark_ts) AS ts
       FROM inc_media m
       LEFT JOIN (SELECT media_id, max(TRY_CAST(received_at AS TIMESTAMP)) AS ts FROM two_first GROUP BY media_id) f
         ON f.media_id = m.media_id
       LEFT JOIN inc_state s ON s.media_id = m.media_id AND s.endpoint = 'events'""",
    "inc_media", "inc_state", "two_first",
)
_cte(
    "two_second",
    f"""SELECT e.* FROM inc_events_src e JOIN two_marks m ON m.media_id = e.media_id
        WHERE TRY_CAST(e.received_at AS TIMESTAMP) > coalesce(m.ts, TIMESTAMP '{INC_FLOOR} 00:00:00')""",
    "inc_events_src", "two_marks",
)
_cte(
    "two_events",
    f"""SELECT * REPLACE ('{INC_SPLIT}T06:00:00+00:00' AS ingest_timestamp) FROM two_first
        UNION ALL
        SELECT * REPLACE ('{INC_TODAY}T06:00:00+00:00' AS ingest_timestamp) FROM two_second""",
    "two_first", "two_second",
)
_cte(
    "two_by_date_second",
    f"""SELECT * FROM raw_by_date
        WHERE TRY_CAST(date AS DATE) >= DATE '{INC_SPLIT}' AND TRY_CAST(date AS DATE) <= DATE '{INC_TODAY}'""",
    "raw_by_date",
)
_cte(
    "two_by_date",
    f"""SELECT * REPLACE ('{INC_SPLIT}T06:00:00+00:00' AS ingest_timestamp) FROM inc_by_date
        WHERE TRY_CAST(date AS DATE) < DATE '{INC_SPLIT}'
        UNION ALL
        SELECT * REPLACE ('{INC_TODAY}T06:00:00+00:00' AS ingest_timestamp) FROM two_by_date_second""",
    "inc_by_date", "two_by_date_second",
)
_cte("two_silver_events", _silver_events("two_events"), "two_events")
_cte("two_silver_by_date", _silver_by_date("two_by_date"), "two_by_date")
_cte(
    "two_meta",
    f"""SELECT * REPLACE ('{INC_SPLIT}T06:00:00+00:00' AS ingest_timestamp) FROM inc_meta
        UNION ALL
        SELECT * REPLACE ('{INC_TODAY}T06:00:00+00:00' AS ingest_timestamp) FROM inc_meta""",
    "inc_meta",
)
_cte("two_silver_media", _silver_media("two_meta"), "two_meta")
_gold_ctes("two_")


def _resolve(needs: tuple[str, ...]) -> list[str]:
    seen: set[str] = set()

    def visit(n: str) -> None:
        if n in seen:
            return
        for d in _DEPS[n]:
            visit(d)
        seen.add(n)

    for n in needs:
        visit(n)
    return [n for n in _CTES if n in seen]


def with_ctes(select: str, *needs: str) -> str:
    names = _resolve(needs)
    body = ",\n".join(f"{n} AS (\n{_CTES[n]}\n)" for n in names)
    return f"WITH {body}\n{select}"


def r6(expr: str, alias: str) -> str:
    return f"round({expr}, 6) AS {alias}"


def day(expr: str, alias: str) -> str:
    return f"strftime({expr}, '%Y-%m-%d') AS {alias}"


def instant(expr: str, alias: str) -> str:
    return f"strftime({expr}, {TS_FMT}) AS {alias}"


def _bronze_select(table: str) -> str:
    cols = {
        "raw_events": (
            "received_at, event_key, ip, country, "
            + r6("percent_viewed", "percent_viewed")
            + ", conversion_type, visitor_key, media_name, media_url"
        ),
        "raw_by_date": "date, load_count, play_count, " + r6("hours_watched", "hours_watched"),
        "raw_media_metadata": "hashed_id, name, created",
    }[table]
    return f"SELECT {cols}, ingest_timestamp, ingest_date, media_id FROM {table}"


_ENGAGEMENT = (
    "CAST(sum(play_count) AS BIGINT) AS plays, count(DISTINCT visitor_id) AS unique_visitors, "
    "avg(watched_percent) AS avg_watched_percent"
)


def _recent(days: int) -> str:
    return with_ctes(
        f"""SELECT a.media_id, d.title, d.channel, a.plays, a.unique_visitors, a.active_days,
                   {r6('a.avg_watched_percent', 'avg_watched_percent')}
            FROM (
              SELECT media_id, CAST(sum(play_count) AS BIGINT) AS plays,
                     count(DISTINCT visitor_id) AS unique_visitors,
                     count(DISTINCT date) AS active_days,
                     avg(watched_percent) AS avg_watched_percent
              FROM fact
              WHERE media_id IS NOT NULL AND date IS NOT NULL
                AND date >= (SELECT max(date) FROM fact) - INTERVAL {days - 1} DAY
              GROUP BY media_id) a
            LEFT JOIN dim_media d ON d.media_id = a.media_id""",
        "fact", "dim_media",
    )


def _layer_counts() -> str:
    parts = [
        ("bronze", "events", "raw_events"),
        ("bronze", "by_date", "raw_by_date"),
        ("bronze", "media_metadata", "raw_media_metadata"),
        ("silver", "events", "silver_events"),
        ("silver", "by_date", "silver_by_date"),
        ("silver", "media_metadata", "silver_media"),
        ("gold", "dim_media", "dim_media"),
        ("gold", "dim_visitor", "dim_visitor"),
        ("gold", "fact_media_engagement", "fact"),
    ]
    select = "\nUNION ALL\n".join(
        f"SELECT '{layer}' AS layer, '{table}' AS table_name, count(*) AS row_count FROM {cte}"
        for layer, table, cte in parts
    )
    return with_ctes(select, *{p[2] for p in parts})


def _landed_pulls(run_day: str, **pulled: str) -> str:
    """Every loaded media lands one pull per endpoint, stamped with the run's date."""
    return " UNION ALL ".join(
        f"""SELECT '{endpoint}' AS endpoint, m.media_id, '{run_day}' AS ingest_date,
                   '{run_day}T06:00:00+00:00' AS ingest_timestamp,
                   CAST(coalesce(c.n, 0) AS BIGINT) AS records,
                   CAST(coalesce(c.n, 0) AS BIGINT) AS bronze_rows,
                   coalesce(c.n, 0) = 0 AS empty_pull
            FROM inc_media m
            LEFT JOIN (SELECT media_id, count(*) AS n FROM {cte} GROUP BY media_id) c
              ON c.media_id = m.media_id"""
        for endpoint, cte in pulled.items()
    )


def _incremental_landing() -> str:
    pulls = _landed_pulls(INC_TODAY, events="inc_events", by_date="inc_by_date", media_metadata="inc_meta")
    return with_ctes(pulls, "inc_media", "inc_events", "inc_by_date", "inc_meta")


def _landing_by_run() -> str:
    first = f"(SELECT * FROM inc_by_date WHERE TRY_CAST(date AS DATE) < DATE '{INC_SPLIT}')"
    pulls = (
        _landed_pulls(INC_SPLIT, events="two_first", by_date=first, media_metadata="inc_meta"),
        _landed_pulls(INC_TODAY, events="two_second", by_date="two_by_date_second", media_metadata="inc_meta"),
    )
    needs = ("inc_media", "two_first", "two_second", "inc_by_date", "two_by_date_second", "inc_meta")
    return with_ctes(" UNION ALL ".join(pulls), *needs)


def _summary(events: str, by_date: str, meta: str, failed: str = "FALSE") -> str:
    """Counts per media; a failed media has none, and the error."""
    counts = ", ".join(
        f"CAST(CASE WHEN {failed} THEN 0 ELSE coalesce({t}.n, 0) END AS BIGINT) AS {name}"
        for t, name in (("e", "events"), ("b", "by_date"), ("x", "media_metadata"), ("r", "rejected"))
    )
    joins = " ".join(
        f"LEFT JOIN (SELECT media_id, count(*) AS n FROM {cte} GROUP BY media_id) {t} ON {t}.media_id = m.media_id"
        for t, cte in (("e", events), ("b", by_date), ("x", meta))
    )
    return with_ctes(
        f"""SELECT m.media_id, {counts}, CASE WHEN {failed} THEN '{AMBIGUOUS}' END AS error
            FROM inc_media m {joins} LEFT JOIN inc_rejected r ON r.media_id = m.media_id""",
        "inc_media", "inc_rejected", events, by_date, meta,
    )


def oracle_sql() -> dict[str, str]:
    sql = {
        "bronze_flatten": with_ctes(_bronze_select("raw_events"), "raw_events"),
        "bronze_incremental": with_ctes(_bronze_select("raw_events"), "raw_events"),
        "landing_roundtrip": with_ctes(
            """SELECT endpoint, media_id, ingest_timestamp, ingest_date,
                      count(*) AS records, count(*) AS bronze_rows
               FROM (SELECT 'events' AS endpoint, media_id, ingest_timestamp, ingest_date FROM raw_events
                     UNION ALL
                     SELECT 'by_date', media_id, ingest_timestamp, ingest_date FROM raw_by_date
                     UNION ALL
                     SELECT 'media_metadata', media_id, ingest_timestamp, ingest_date FROM raw_media_metadata)
               GROUP BY endpoint, media_id, ingest_timestamp, ingest_date""",
            "raw_events", "raw_by_date", "raw_media_metadata",
        ),
        "silver_events": with_ctes(
            f"""SELECT event_key, visitor_key, media_id, media_name, media_url,
                       {instant('received_at', 'received_at')}, ip, country,
                       {r6('percent_viewed', 'percent_viewed')}
                FROM silver_events""",
            "silver_events",
        ),
        "silver_by_date": with_ctes(
            f"""SELECT media_id, {day('date', 'date')}, load_count, play_count,
                       {r6('hours_watched', 'hours_watched')}
                FROM silver_by_date""",
            "silver_by_date",
        ),
        "silver_media": with_ctes(
            f"SELECT media_id, name, {instant('created', 'created')} FROM silver_media",
            "silver_media",
        ),
        "dim_media": with_ctes(
            f"SELECT media_id, title, url, channel, {instant('created_at', 'created_at')} FROM dim_media",
            "dim_media",
        ),
        "dim_visitor": with_ctes("SELECT visitor_id, ip_address, country FROM dim_visitor", "dim_visitor"),
        "fact_engagement": with_ctes(
            f"""SELECT media_id, visitor_id, {day('date', 'date')}, play_count,
                       {r6('watched_percent', 'watched_percent')}, {r6('play_rate', 'play_rate')},
                       {r6('total_watch_time', 'total_watch_time')}
                FROM fact""",
            "fact",
        ),
        "kpi_summary": with_ctes(
            f"""SELECT CAST(coalesce(sum(play_count), 0) AS BIGINT) AS total_plays,
                       count(DISTINCT visitor_id) AS unique_visitors,
                       {r6('avg(watched_percent)', 'avg_watched_percent')},
                       round(coalesce((
                         SELECT sum(w) FROM (
                           SELECT max(total_watch_time) AS w FROM fact
                           WHERE media_id IS NOT NULL AND date IS NOT NULL
                           GROUP BY media_id, date)), 0.0), 6) AS total_watch_hours
                FROM fact""",
            "fact",
        ),
        "engagement_by_media": with_ctes(
            f"""SELECT a.media_id, a.plays, a.unique_visitors,
                       {r6('a.avg_watched_percent', 'avg_watched_percent')}, d.title, d.channel
                FROM (SELECT media_id, {_ENGAGEMENT} FROM fact
                      WHERE media_id IS NOT NULL GROUP BY media_id) a
                LEFT JOIN dim_media d ON d.media_id = a.media_id""",
            "fact", "dim_media",
        ),
        "daily_trends": with_ctes(
            f"""SELECT g.media_id, {day('g.date', 'date')},
                       CAST(coalesce(t.plays, 0) AS BIGINT) AS plays,
                       {r6('t.play_rate', 'play_rate')}, {r6('t.total_watch_time', 'total_watch_time')},
                       d.channel
                FROM (
                  SELECT m.media_id, CAST(s.day AS DATE) AS date
                  FROM (SELECT DISTINCT media_id FROM fact
                        WHERE media_id IS NOT NULL AND date IS NOT NULL) m,
                       (SELECT unnest(generate_series(CAST(min(date) AS TIMESTAMP),
                                                      CAST(max(date) AS TIMESTAMP),
                                                      INTERVAL 1 DAY)) AS day
                        FROM fact WHERE media_id IS NOT NULL AND date IS NOT NULL) s) g
                LEFT JOIN (
                  SELECT media_id, date, sum(play_count) AS plays, max(play_rate) AS play_rate,
                         max(total_watch_time) AS total_watch_time
                  FROM fact WHERE media_id IS NOT NULL AND date IS NOT NULL
                  GROUP BY media_id, date) t
                  ON t.media_id = g.media_id AND t.date = g.date
                LEFT JOIN dim_media d ON d.media_id = g.media_id
                ORDER BY g.media_id, g.date""",
            "fact", "dim_media",
        ),
        "monthly_engagement": with_ctes(
            f"""SELECT a.media_id, a.month, a.plays, a.unique_visitors,
                       {r6('a.avg_watched_percent', 'avg_watched_percent')}, d.title, d.channel
                FROM (SELECT media_id, strftime(date, '%Y-%m') AS month, {_ENGAGEMENT}
                      FROM fact WHERE media_id IS NOT NULL AND date IS NOT NULL
                      GROUP BY media_id, strftime(date, '%Y-%m')) a
                LEFT JOIN dim_media d ON d.media_id = a.media_id""",
            "fact", "dim_media",
        ),
        "recent_7d": _recent(7),
        "recent_30d": _recent(30),
        "top_visitors": with_ctes(
            f"""SELECT t.visitor_id, t.plays, {r6('t.avg_watched_percent', 'avg_watched_percent')},
                       v.country
                FROM (SELECT visitor_id, CAST(sum(play_count) AS BIGINT) AS plays,
                             avg(watched_percent) AS avg_watched_percent
                      FROM fact WHERE visitor_id IS NOT NULL
                      GROUP BY visitor_id
                      ORDER BY plays DESC, visitor_id ASC
                      LIMIT 10) t
                LEFT JOIN dim_visitor v ON v.visitor_id = t.visitor_id
                ORDER BY t.plays DESC, t.visitor_id ASC""",
            "fact", "dim_visitor",
        ),
        "layer_counts": _layer_counts(),
        "incremental_cutoff": with_ctes(
            f"""SELECT media_id, event_key, visitor_key, received_at,
                       {r6('percent_viewed', 'percent_viewed')}
                FROM inc_events""",
            "inc_events",
        ),
        "incremental_by_date": with_ctes(
            f"""SELECT media_id, date, load_count, play_count, {r6('hours_watched', 'hours_watched')}
                FROM inc_by_date""",
            "inc_by_date",
        ),
        "state_advance": with_ctes(
            f"""SELECT 'events' AS endpoint, coalesce(o.media_id, n.media_id) AS media_id,
                       {instant('coalesce(n.new_ts, o.watermark_ts)', 'watermark_ts')},
                       CAST(NULL AS VARCHAR) AS watermark_date
                FROM (SELECT * FROM inc_state WHERE endpoint = 'events') o
                FULL OUTER JOIN (SELECT media_id, max(TRY_CAST(received_at AS TIMESTAMP)) AS new_ts
                                 FROM inc_events GROUP BY media_id) n
                  ON n.media_id = o.media_id
                UNION ALL
                SELECT 'by_date', m.media_id, CAST(NULL AS VARCHAR), '{INC_TODAY}'
                FROM inc_media m""",
            "inc_state", "inc_events", "inc_media",
        ),
        "load_summary": _summary("inc_events", "inc_by_date", "inc_meta"),
    }
    # The end-to-end run returns the same summary and saves the same state as
    # the planned load computes.
    sql["incremental_run"] = sql["load_summary"]
    sql["incremental_state"] = sql["state_advance"]
    sql["incremental_landing"] = _incremental_landing()
    sql["landing_by_run"] = _landing_by_run()
    sql["incremental_validation"] = _summary(
        "inc_events", "inc_by_date", "inc_meta", f"CAST(substr(m.media_id, 2) AS INTEGER) < {INC_AMBIGUOUS_BELOW}"
    )
    sql["incremental_retry"] = _summary("two_second", "two_by_date_second", "inc_meta")
    sql["incremental_two_runs_silver"] = with_ctes(
        f"""SELECT event_key, visitor_key, media_id, media_name, media_url, {instant('received_at', 'received_at')},
                   ip, country, {r6('percent_viewed', 'percent_viewed')}
            FROM two_silver_events""",
        "two_silver_events",
    )
    sql["incremental_two_runs_by_date"] = with_ctes(
        f"""SELECT media_id, {day('date', 'date')}, load_count, play_count, {r6('hours_watched', 'hours_watched')}
            FROM two_silver_by_date""",
        "two_silver_by_date",
    )
    sql["incremental_two_runs_state"] = with_ctes(
        f"""SELECT 'events' AS endpoint, m.media_id, {instant('coalesce(n.ts, m.ts)', 'watermark_ts')},
                   CAST(NULL AS VARCHAR) AS watermark_date
            FROM two_marks m
            LEFT JOIN (SELECT media_id, max(TRY_CAST(received_at AS TIMESTAMP)) AS ts
                       FROM two_second GROUP BY media_id) n ON n.media_id = m.media_id
            WHERE coalesce(n.ts, m.ts) IS NOT NULL
            UNION ALL
            SELECT 'by_date', media_id, CAST(NULL AS VARCHAR), '{INC_TODAY}' FROM inc_media""",
        "two_marks", "two_second", "inc_media",
    )
    sql["incremental_failed_retry"] = sql["incremental_retry"]
    sql["incremental_failed_retry_state"] = sql["incremental_two_runs_state"]
    sql["incremental_status"] = with_ctes(
        f"""SELECT count(*) AS media,
                   count(*) FILTER (WHERE CAST(substr(media_id, 2) AS INTEGER) < {INC_AMBIGUOUS_BELOW}) AS failed,
                   coalesce(bool_or(CAST(substr(media_id, 2) AS INTEGER) < {INC_AMBIGUOUS_BELOW}), FALSE) AS had_errors
            FROM inc_media""",
        "inc_media",
    )
    for report, table in (
        ("recent_7d", "last_7_days"), ("recent_30d", "last_30_days"), ("monthly_engagement", "monthly"), ("top_visitors", "top_visitors"),
    ):
        sql[f"dashboard_{table}"] = sql[report].replace(
            "round(avg_watched_percent, 6)", "round(avg_watched_percent * 100.0, 6)"
        ).replace("round(a.avg_watched_percent, 6)", "round(a.avg_watched_percent * 100.0, 6)").replace(
            "round(t.avg_watched_percent, 6)", "round(t.avg_watched_percent * 100.0, 6)"
        )
    for report, kept in (
        ("kpi_summary", "kpi"), ("engagement_by_media", "by_media"), ("monthly_engagement", "monthly"),
        ("recent_7d", "last_7_days"), ("recent_30d", "last_30_days"),
    ):
        sql[f"reach_{kept}"] = sql[report]
    sql["copartitioned_fact"] = sql["fact_engagement"]
    sql["advanced_reach"] = with_ctes(
        f"""SELECT a.media_id, a.month, a.plays, a.unique_visitors,
                   {r6('a.avg_watched_percent', 'avg_watched_percent')}, d.title, d.channel
            FROM (SELECT media_id, strftime(date, '%Y-%m') AS month, {_ENGAGEMENT}
                  FROM two_fact WHERE media_id IS NOT NULL AND date IS NOT NULL
                  GROUP BY media_id, strftime(date, '%Y-%m')) a
            LEFT JOIN two_dim_media d ON d.media_id = a.media_id""",
        "two_fact", "two_dim_media",
    )
    sql["advanced_silver_events"] = sql["incremental_two_runs_silver"]
    sql["advanced_silver_by_date"] = sql["incremental_two_runs_by_date"]
    sql["advanced_silver_media"] = with_ctes(
        f"SELECT media_id, name, {instant('created', 'created')} FROM two_silver_media", "two_silver_media"
    )
    for kept in ("advanced", "streamed"):
        sql[f"{kept}_fact"] = with_ctes(
            f"""SELECT media_id, visitor_id, {day('date', 'date')}, play_count,
                       {r6('watched_percent', 'watched_percent')}, {r6('play_rate', 'play_rate')},
                       {r6('total_watch_time', 'total_watch_time')}
                FROM two_fact""",
            "two_fact",
        )
        sql[f"{kept}_dim_media"] = with_ctes(
            f"SELECT media_id, title, url, channel, {instant('created_at', 'created_at')} FROM two_dim_media", "two_dim_media"
        )
        sql[f"{kept}_dim_visitor"] = with_ctes("SELECT visitor_id, ip_address, country FROM two_dim_visitor", "two_dim_visitor")
    tracked = "media_id IN (SELECT media_id FROM inc_state)"
    sql["incremental_pruned"] = with_ctes(
        f"""SELECT media_id, event_key, visitor_key, received_at, {r6('percent_viewed', 'percent_viewed')}, TRUE AS taken
            FROM inc_events WHERE {tracked}
            UNION ALL
            SELECT media_id, event_key, visitor_key, received_at, {r6('percent_viewed', 'percent_viewed')}, FALSE
            FROM raw_events WHERE {UNPLACED} AND {tracked}""",
        "inc_events", "inc_state", "raw_events",
    )
    sql["landed_fact"] = sql["fact_engagement"]
    sql["landed_dim_media"] = sql["dim_media"]
    sql["landed_dim_visitor"] = sql["dim_visitor"]
    sql["landing_raw_records"] = with_ctes(
        _bronze_select("raw_events").replace(
            "media_url, ingest_timestamp",
            """media_url,
               'City ' || CAST(CAST(substr(media_id, 2) AS INTEGER) % 7 AS VARCHAR) AS city,
               CASE CAST(substr(media_id, 2) AS INTEGER) % 2 WHEN 0 THEN 'Chrome' ELSE 'Firefox' END AS browser,
               CAST(substr(media_id, 2) AS INTEGER) % 3 = 0 AS mobile,
               CAST(substr(media_id, 2) AS BIGINT) AS build, ingest_timestamp""",
        ),
        "raw_events",
    )
    sql["bronze_by_date"] = with_ctes(
        _bronze_select("raw_by_date").replace(
            "load_count,",
            """CASE WHEN (CAST(substr(media_id, 2) AS INTEGER) + dayofmonth(TRY_CAST(date AS DATE))) % 19 = 0
                    THEN NULL ELSE load_count END AS load_count,""",
        ),
        "raw_by_date",
    )
    sql["bronze_media"] = with_ctes(_bronze_select("raw_media_metadata"), "raw_media_metadata")
    sql["dashboard_by_media"] = with_ctes(
        f"""SELECT a.media_id, a.plays, a.unique_visitors,
                   {r6('a.avg_watched_percent * 100.0', 'avg_watched_percent')}, d.title, d.channel
            FROM (SELECT media_id, {_ENGAGEMENT} FROM fact
                  WHERE media_id IS NOT NULL GROUP BY media_id) a
            LEFT JOIN dim_media d ON d.media_id = a.media_id""",
        "fact", "dim_media",
    )
    return sql
