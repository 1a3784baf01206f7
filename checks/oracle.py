"""DuckDB statements for the queries, written on the flat test columns.

``EV`` restates the feed mapping of ``checks.feed`` without any JSON, so the
JSON round trip of the Spark side is what gets compared.
"""

from __future__ import annotations

EV = """
base AS (
  SELECT event_id AS e, user_id AS u, date_trunc('second', ts) AS event_at, event_type AS kind,
         CAST(json_extract_string(props, '$.k') AS BIGINT) AS k
  FROM events
),
ev AS (
  SELECT e AS event_id,
    CASE kind
      WHEN 'click' THEN 'WatchEvent'
      WHEN 'view' THEN 'PushEvent'
      WHEN 'signup' THEN CASE e % 5 WHEN 0 THEN 'ForkEvent' WHEN 1 THEN 'CreateEvent'
        WHEN 2 THEN 'ReleaseEvent' WHEN 3 THEN 'GollumEvent' ELSE 'PublicEvent' END
      WHEN 'error' THEN CASE WHEN e % 3 = 2 THEN 'IssueCommentEvent' ELSE 'IssuesEvent' END
      ELSE CASE e % 8 WHEN 3 THEN 'PullRequestReviewEvent'
        WHEN 7 THEN 'PullRequestReviewCommentEvent' ELSE 'PullRequestEvent' END
    END AS event_type,
    CASE WHEN e % 97 <> 0 THEN u END AS actor_id,
    CASE WHEN e % 97 <> 0 THEN 'user_' || u END AS actor_login,
    CASE WHEN e % 97 <> 0 THEN 'https://example.com/u/' || u END AS actor_avatar_url,
    CASE WHEN e % 89 <> 0 THEN k END AS repo_id,
    CASE WHEN e % 89 <> 0 THEN 'org/repo_' || k END AS repo_name,
    e % 10 <> 0 AS is_public,
    event_at,
    CAST(event_at AS DATE) AS event_date,
    CASE WHEN e % 2 = 0 THEN strftime(event_at, '%Y-%m-%dT%H:%M:%SZ')
         ELSE strftime(event_at, '%Y-%m-%d %H:%M:%S') END AS created_at,
    CASE WHEN e % 3 = 0 THEN CASE e % 4 WHEN 0 THEN 'Python' WHEN 1 THEN 'Go'
         WHEN 2 THEN 'C' ELSE 'TypeScript' END END AS language
  FROM base
),
issues AS (
  SELECT event_id, event_type, actor_id, repo_id,
    CASE WHEN event_id % 2 = 0 THEN 'opened' ELSE 'closed' END AS action,
    event_id AS issue_id, CAST(event_id % 1000 AS INTEGER) AS issue_number,
    CASE WHEN event_id % 2 = 0 THEN 'open' ELSE 'closed' END AS issue_state,
    event_at - to_hours(CAST(event_id % 48 AS INTEGER)) AS issue_created_at,
    CASE WHEN event_id % 2 = 1 THEN event_at END AS issue_closed_at,
    event_at
  FROM ev WHERE event_type = 'IssuesEvent'
),
prs AS (
  SELECT event_id, event_type, actor_id, repo_id,
    CASE WHEN event_id % 3 = 0 THEN 'opened' ELSE 'closed' END AS action,
    event_id AS pr_id, CAST(event_id % 1000 AS INTEGER) AS pr_number,
    CASE WHEN event_id % 3 = 0 THEN 'open' ELSE 'closed' END AS pr_state,
    CASE event_id % 3 WHEN 1 THEN true WHEN 2 THEN false END AS is_merged,
    event_at - to_hours(CAST(event_id % 72 AS INTEGER)) AS pr_created_at,
    CASE WHEN event_id % 3 <> 0 THEN event_at END AS pr_closed_at,
    CASE WHEN event_id % 3 = 1 THEN event_at END AS pr_merged_at,
    event_at
  FROM ev WHERE event_type = 'PullRequestEvent'
),
pushes AS (
  SELECT event_id, event_type, actor_id, repo_id, event_id AS push_id,
    CASE WHEN event_id % 7 <> 0 THEN CAST(event_id % 20 AS INTEGER) END AS commit_size,
    CAST(event_id % 5 AS INTEGER) AS distinct_commit_size,
    'refs/heads/main' AS branch_ref, event_at
  FROM ev WHERE event_type = 'PushEvent'
),
creates AS (
  SELECT event_id, event_type, actor_id, repo_id, 'branch' AS ref_type, 'b' || event_id AS ref_name,
    'main' AS master_branch,
    CASE WHEN event_id % 4 <> 0 THEN 'desc ' || (event_id % 13) END AS description, event_at
  FROM ev WHERE event_type = 'CreateEvent'
),
spine AS (SELECT DISTINCT repo_id FROM ev)
"""

NEWEST = "ORDER BY event_at DESC NULLS FIRST, event_id DESC"


def latest(columns: str, key: str, source: str = "ev", where: str = "true") -> str:
    return (
        f"SELECT {columns} FROM (SELECT *, row_number() OVER (PARTITION BY {key} {NEWEST}) AS rn"
        f" FROM {source} WHERE {where}) WHERE rn = 1"
    )


def over_events(body: str, ctes: str = "") -> str:
    return f"WITH {EV}{', ' + ctes if ctes else ''} {body}"


def of_type(name: str) -> str:
    return f"count(*) FILTER (event_type = '{name}')"


def view(event_type: str, columns: str = "") -> str:
    return over_events(
        f"SELECT event_id, event_type, actor_id, repo_id, {columns} event_at FROM ev"
        f" WHERE event_type IN ({event_type})"
    )


def _stamp(time: str) -> str:
    return (
        f"CASE WHEN event_id % 2 = 0 THEN strftime({time}, '%Y-%m-%dT%H:%M:%SZ')"
        f" ELSE strftime({time}, '%Y-%m-%d %H:%M:%S') END"
    )


def _members(**values: str) -> str:
    """JSON members: a value that starts with ``"`` is text, an empty SQL value a JSON null."""
    parts = []
    for name, value in values.items():
        text = f"""'"' || ({value[1:]}) || '"'""" if value.startswith('"') else f"CAST(({value}) AS VARCHAR)"
        parts.append(f"""'"{name}":' || coalesce({text}, 'null')""")
    return ", ".join(parts)


def _nested(name: str, **values: str) -> str:
    return f"""'"{name}":{{' || concat_ws(',', {_members(**values)}) || '}}'"""


_OPEN = "CASE WHEN event_id % 2 = 0 THEN 'open{0}' ELSE 'closed' END"
_OPEN3 = "CASE WHEN event_id % 3 = 0 THEN 'open{0}' ELSE 'closed' END"
_HOURS, _PR_HOURS = "event_at - to_hours(CAST(event_id % 48 AS INTEGER))", "event_at - to_hours(CAST(event_id % 72 AS INTEGER))"
_REVIEW = [_members(action="\"'created'"), _nested("pull_request", id="event_id")]
_PAYLOADS = {
    "WatchEvent": [_members(action="\"'started'")],
    "PushEvent": [_members(
        push_id="event_id", size="CASE WHEN event_id % 7 <> 0 THEN event_id % 20 END", distinct_size="event_id % 5",
        ref="\"'refs/heads/main'",
    )],
    "CreateEvent": [_members(
        ref_type="\"'branch'", ref="\"'b' || event_id", master_branch="\"'main'",
        description="\"CASE WHEN event_id % 4 <> 0 THEN 'desc ' || (event_id % 13) END",
    )],
    "ForkEvent": [_nested("forkee", id="event_id + 1000000", full_name="\"'fork/' || event_id")],
    "ReleaseEvent": [
        _members(action="\"'published'"), _nested("release", id="event_id", tag_name="\"'v' || (event_id % 30)")
    ],
    "IssuesEvent": [_members(action='"' + _OPEN.format("ed")), _nested(
        "issue", id="event_id", number="event_id % 1000", state='"' + _OPEN.format(""), created_at='"' + _stamp(_HOURS),
        closed_at=f'"CASE WHEN event_id % 2 = 1 THEN {_stamp("event_at")} END',
    )],
    "IssueCommentEvent": [
        _members(action="\"'created'"), _nested("issue", id="event_id"), _nested("comment", id="event_id")
    ],
    "PullRequestEvent": [_members(action='"' + _OPEN3.format("ed")), _nested(
        "pull_request", id="event_id", number="event_id % 1000", state='"' + _OPEN3.format(""),
        merged="CASE event_id % 3 WHEN 1 THEN 'true' WHEN 2 THEN 'false' END", created_at='"' + _stamp(_PR_HOURS),
        closed_at=f'"CASE WHEN event_id % 3 <> 0 THEN {_stamp("event_at")} END',
        merged_at=f'"CASE WHEN event_id % 3 = 1 THEN {_stamp("event_at")} END',
    )],
    "PullRequestReviewEvent": _REVIEW,
    "PullRequestReviewCommentEvent": _REVIEW,
}
_LANGUAGE = """CASE WHEN language IS NOT NULL THEN '"language":"' || language || '"' END"""
PAYLOAD = "CASE event_type " + " ".join(
    f"WHEN '{name}' THEN '{{' || concat_ws(',', {_LANGUAGE}, {', '.join(parts)}) || '}}'"
    for name, parts in _PAYLOADS.items()
) + f" ELSE '{{' || concat_ws(',', {_LANGUAGE}) || '}}' END"
ACTOR = """CASE WHEN actor_id IS NOT NULL THEN '{"id":' || actor_id || ',"login":"' || actor_login
    || '","avatar_url":"' || actor_avatar_url || '"}' END"""
REPO = """CASE WHEN repo_id IS NOT NULL THEN '{"id":' || repo_id || ',"name":"' || repo_name || '"}' END"""
LINE = (
    """'{"id":"' || event_id || '","type":"' || event_type || '","actor":' || coalesce(""" + ACTOR
    + """, 'null') || ',"repo":' || coalesce(""" + REPO + """, 'null') || ',"org":null,"payload":' || """ + PAYLOAD
    + """ || ',"public":' || is_public || ',"created_at":"' || created_at || '"}'"""
)

LANDED = f"""
SELECT event_id AS id, event_type AS type, {ACTOR} AS actor, {REPO} AS repo,
  CAST(NULL AS VARCHAR) AS org, {PAYLOAD} AS payload, is_public AS public, created_at,
  strftime(event_at, '%Y') AS year, strftime(event_at, '%m') AS month,
  strftime(event_at, '%d') AS day, strftime(event_at, '%H') AS hour
FROM ev
"""

HOUR_COUNTS = """
SELECT CAST(year(event_at) AS INTEGER) AS year, CAST(month(event_at) AS INTEGER) AS month,
  CAST(day(event_at) AS INTEGER) AS day, CAST(hour(event_at) AS INTEGER) AS hour,
  count(*) AS n, min(event_id) AS first_id, max(event_id) AS last_id
FROM ev GROUP BY ALL
"""

# The repository list left-joined to one aggregate per event type.
WATCH_STATS = """
watched AS (
  SELECT repo_id, count(*) AS stars, max(event_at) AS starred_at FROM ev
  WHERE event_type = 'WatchEvent' AND repo_id IS NOT NULL GROUP BY repo_id),
shifted AS (
  SELECT repo_id, ifnull(stars, 0) AS stars, starred_at, ifnull(stars, 0) + repo_id % 1200 AS size
  FROM spine LEFT JOIN watched USING (repo_id)),
watch_stats AS (
  SELECT repo_id, stars AS star_count, ifnull(starred_at, TIMESTAMP '2024-02-01') AS last_starred_at,
    CASE WHEN size > 1000 OR size IS NULL THEN '1000+' WHEN size > 100 THEN '101-1000'
      WHEN size > 10 THEN '11-100' ELSE '0-10' END AS star_count_bucket
  FROM shifted)"""

PUSH_STATS = """
pushed AS (
  SELECT repo_id, count(*) AS n, CAST(sum(ifnull(commit_size, 0)) AS BIGINT) AS commits,
    count(DISTINCT actor_id) AS pushers, max(event_at) AS last_pushed_at
  FROM pushes WHERE repo_id IS NOT NULL GROUP BY repo_id),
push_stats AS (
  SELECT repo_id, ifnull(n, 0) AS push_count, ifnull(commits, 0) AS commit_count,
    ifnull(pushers, 0) AS unique_pushers, last_pushed_at
  FROM spine LEFT JOIN pushed USING (repo_id))"""

ISSUE_STATS = """
issued AS (
  SELECT repo_id, count(*) FILTER (action = 'opened') AS opened, count(*) FILTER (action = 'closed') AS closed,
    avg(date_diff('microsecond', issue_created_at, issue_closed_at) / 3.6e9)
      FILTER (action = 'closed') AS hours
  FROM issues WHERE repo_id IS NOT NULL GROUP BY repo_id),
issue_stats AS (
  SELECT repo_id, ifnull(opened, 0) AS opened_issues_count, ifnull(closed, 0) AS closed_issues_count,
    ifnull(hours, 0.0) AS average_resolution_hours
  FROM spine LEFT JOIN issued USING (repo_id))"""

PR_STATS = """
requested AS (
  SELECT repo_id, count(*) FILTER (action = 'opened') AS opened,
    count(*) FILTER (action = 'closed' AND is_merged) AS merged,
    count(*) FILTER (action = 'closed' AND NOT is_merged) AS closed,
    avg(date_diff('microsecond', pr_created_at, pr_merged_at) / 3.6e9)
      FILTER (action = 'closed' AND is_merged) AS hours
  FROM prs WHERE repo_id IS NOT NULL GROUP BY repo_id),
pr_stats AS (
  SELECT repo_id, ifnull(opened, 0) AS prs_opened_count, ifnull(merged, 0) AS prs_merged_count,
    ifnull(closed, 0) AS prs_closed_count, ifnull(hours, 0.0) AS average_merge_hours
  FROM spine LEFT JOIN requested USING (repo_id))"""

FALLBACK_LANGUAGE = "ifnull(['Python', 'JavaScript', 'Go', 'Java', 'Rust'][repo_id % 5 + 1], 'Rust')"

LANGUAGES = f"""
languages AS ({latest(f"repo_id, ifnull(language, {FALLBACK_LANGUAGE}) AS primary_language,"
                      " event_at AS updated_at", "repo_id")})"""

DESCRIPTIONS = f"""
newest_name AS ({latest("repo_id, repo_name, event_at AS named_at", "repo_id")}),
newest_text AS ({latest("repo_id, description, event_at AS described_at", "repo_id", "creates",
                        "description IS NOT NULL AND repo_id IS NOT NULL")}),
descriptions AS (
  SELECT repo_id, ifnull(description, 'Description default for repository ' || repo_name) AS description,
    ifnull(described_at, named_at) AS updated_at
  FROM newest_name LEFT JOIN newest_text USING (repo_id))"""

REPOS = f"repos AS ({latest('repo_id, repo_name', 'repo_id', where='repo_id IS NOT NULL')})"

DAILY_REPO = f"""
repo_day AS (
  SELECT repo_id, event_date, count(*) AS total_events, {of_type('WatchEvent')} AS star_count,
    {of_type('PushEvent')} AS push_count, {of_type('PullRequestEvent')} AS pr_count,
    {of_type('IssuesEvent')} AS issue_count
  FROM ev GROUP BY repo_id, event_date),
daily_repo AS (SELECT repo_day.*, repo_name FROM repo_day LEFT JOIN repos USING (repo_id))"""

DAILY_ACTOR = f"""
actors AS ({latest('actor_id, actor_login, actor_avatar_url, event_at AS last_event_at', 'actor_id',
                   where='actor_id IS NOT NULL')}),
actor_day AS (
  SELECT actor_id, event_date, count(*) AS total_events, {of_type('PushEvent')} AS push_count,
    {of_type('WatchEvent')} AS watch_count, {of_type('PullRequestEvent')} AS pr_count,
    {of_type('IssuesEvent')} AS issue_count
  FROM ev WHERE actor_id IS NOT NULL GROUP BY actor_id, event_date),
daily_actor AS (SELECT actor_day.*, actor_login FROM actor_day LEFT JOIN actors USING (actor_id)),
actor_totals AS (
  SELECT actor_id, count(*) AS total_events, {of_type('PushEvent')} AS push_events_count,
    {of_type('WatchEvent')} AS watch_events_count,
    {of_type('PullRequestEvent')} AS pull_request_events_count,
    {of_type('IssuesEvent')} AS issues_events_count, max(event_at) AS last_active_at
  FROM ev WHERE actor_id IS NOT NULL GROUP BY actor_id)"""

PROFILE = ", ".join([REPOS, LANGUAGES, DESCRIPTIONS, WATCH_STATS, PUSH_STATS, ISSUE_STATS, PR_STATS]) + """,
profile AS (
  SELECT repo_id, repo_name, primary_language, description, star_count, star_count_bucket, push_count,
    commit_count, unique_pushers, opened_issues_count, closed_issues_count, average_resolution_hours,
    prs_opened_count, prs_merged_count, prs_closed_count, average_merge_hours,
    TIMESTAMP '2024-02-01' AS processed_at
  FROM repos JOIN languages USING (repo_id) JOIN descriptions USING (repo_id)
  JOIN watch_stats USING (repo_id) JOIN push_stats USING (repo_id)
  JOIN issue_stats USING (repo_id) JOIN pr_stats USING (repo_id))
"""

# Profiles as of three dates, then one version per run of equal states.
HISTORY = f"""
runs AS (SELECT * FROM (VALUES (TIMESTAMP '2024-01-11 00:00:00'), (TIMESTAMP '2024-01-21 00:00:00'),
                               (TIMESTAMP '2024-01-31 00:00:00')) v(run_at)),
seen AS (SELECT run_at, ev.* FROM ev JOIN runs ON event_at < run_at WHERE repo_id IS NOT NULL),
newest AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY run_at, repo_id {NEWEST}) AS rn FROM seen)
  WHERE rn = 1),
described AS (
  SELECT run_at, repo_id, description FROM (
    SELECT run_at, c.*, row_number() OVER (PARTITION BY run_at, repo_id {NEWEST}) AS rn
    FROM creates c JOIN runs ON event_at < run_at WHERE description IS NOT NULL) WHERE rn = 1),
stars AS (SELECT run_at, repo_id, {of_type('WatchEvent')} + repo_id % 1200 AS n FROM seen
  GROUP BY run_at, repo_id),
states AS (
  SELECT n.run_at, n.repo_id, n.repo_name,
    ifnull(n.language, ['Python', 'JavaScript', 'Go', 'Java', 'Rust'][n.repo_id % 5 + 1])
      AS primary_language,
    coalesce(d.description, 'Description default for repository ' || n.repo_name) AS description,
    CASE WHEN s.n <= 10 THEN '0-10' WHEN s.n <= 100 THEN '11-100' WHEN s.n <= 1000 THEN '101-1000'
      ELSE '1000+' END AS star_count_bucket
  FROM newest n LEFT JOIN described d ON n.run_at = d.run_at AND n.repo_id = d.repo_id
  JOIN stars s ON n.run_at = s.run_at AND n.repo_id = s.repo_id),
steps AS (
  SELECT *, row_number() OVER w AS step,
    lag(repo_name) OVER w IS DISTINCT FROM repo_name
    OR lag(primary_language) OVER w IS DISTINCT FROM primary_language
    OR lag(description) OVER w IS DISTINCT FROM description
    OR lag(star_count_bucket) OVER w IS DISTINCT FROM star_count_bucket AS differs
  FROM states WINDOW w AS (PARTITION BY repo_id ORDER BY run_at)),
history AS (
  SELECT repo_id, repo_name, primary_language, description, star_count_bucket, run_at AS valid_from,
    lead(run_at) OVER (PARTITION BY repo_id ORDER BY run_at) AS valid_to
  FROM steps WHERE step = 1 OR differs)
"""

METRICS = """
metrics AS (
  SELECT 'run_' || strftime(event_date, '%Y%m%d') AS run_id, CAST(event_date AS TIMESTAMP) AS dag_run_timestamp,
    count(*) AS rows_ingested, CAST((day(event_date) * 600) % 9000 AS INTEGER) AS freshness_lag_seconds,
    CAST(43 - day(event_date) % 4 AS INTEGER) AS dbt_tests_passed,
    CAST(day(event_date) % 4 AS INTEGER) AS dbt_tests_failed,
    CAST(day(event_date) * 7 AS INTEGER) AS duration_seconds, 'SUCCESS' AS status
  FROM ev GROUP BY event_date
)"""

SERIES = f"""{REPOS}, {DAILY_REPO},
series AS (
  SELECT repo_id, repo_name, event_date AS ds, CAST(total_events AS DOUBLE) AS y,
    CAST(date_diff('day', min(event_date) OVER (PARTITION BY repo_id), event_date) AS DOUBLE) AS x
  FROM daily_repo WHERE repo_id IS NOT NULL),
fitted AS (
  SELECT *, regr_slope(y, x) OVER (PARTITION BY repo_id) * x
    + regr_intercept(y, x) OVER (PARTITION BY repo_id) AS yhat FROM series),
banded AS (
  SELECT *, 1.96 * sqrt(avg((y - yhat) * (y - yhat)) OVER (PARTITION BY repo_id)) AS band,
    count(*) OVER (PARTITION BY repo_id) AS n FROM fitted),
trend AS (
  SELECT repo_id, repo_name, ds, y, n, round(yhat - band, 6) AS yhat_lower, round(yhat + band, 6) AS yhat_upper
  FROM banded),
trend_flags AS (
  SELECT repo_id, repo_name, ds, y, yhat_lower, yhat_upper,
    round(CASE WHEN y > yhat_upper THEN y - yhat_upper ELSE yhat_lower - y END
      / CASE WHEN yhat_upper > yhat_lower THEN yhat_upper - yhat_lower ELSE 1.0 END, 6) AS anomaly_score,
    TIMESTAMP '2024-02-01 00:00:00' AS run_timestamp
  FROM trend WHERE (y > yhat_upper OR y < yhat_lower)),
spread AS (
  SELECT repo_id, repo_name, ds, y, avg(y) OVER (PARTITION BY repo_id) AS mean,
    stddev_samp(y) OVER (PARTITION BY repo_id) AS sd, count(*) OVER (PARTITION BY repo_id) AS n FROM series),
spread2 AS (
  SELECT * REPLACE (CASE WHEN sd IS NULL OR sd = 0 THEN CASE WHEN mean > 0 THEN mean * 0.2 ELSE 1.0 END
    ELSE sd END AS sd) FROM spread),
deviation AS (
  SELECT repo_id, repo_name, ds, y, n, sd, round(greatest(mean - 1.5 * sd, 0.0), 6) AS yhat_lower,
    round(greatest(mean + 1.5 * sd, 5.0), 6) AS yhat_upper FROM spread2),
deviation_flags AS (
  SELECT repo_id, repo_name, ds, y, yhat_lower, yhat_upper, round((y - yhat_upper) / sd, 6) AS anomaly_score,
    TIMESTAMP '2024-02-01 00:00:00' AS run_timestamp
  FROM deviation WHERE y > yhat_upper)"""


TESTED = [
    ("raw_events", "id"), ("raw_events", "type"), ("raw_events", "created_at"),
    ("stg_raw_events", "event_id"), ("stg_raw_events", "event_type"),
    ("stg_watch_events", "event_id"), ("stg_watch_events", "repo_id"),
    ("stg_push_events", "event_id"), ("stg_push_events", "push_id"),
    ("stg_create_events", "event_id"), ("stg_fork_events", "event_id"),
    ("stg_issues_events", "event_id"), ("stg_issues_events", "issue_id"),
    ("stg_pull_request_events", "event_id"), ("stg_pull_request_events", "pr_id"),
    ("dim_actor", "actor_id"), ("dim_actor", "actor_login"),
    ("dim_repo", "repo_id"), ("dim_repo", "repo_name"), ("dim_repo", "is_current"),
    ("dim_date", "date_id"), ("fact_events", "event_id"), ("fact_events", "event_type"),
    ("fact_events", "actor_id"), ("fact_events", "date_id"),
    ("fct_daily_repo_metrics", "repo_id"), ("fct_daily_repo_metrics", "event_date"),
    ("fct_daily_repo_metrics", "total_events"),
]


def _nulls() -> str:
    """Not-null results: (table, column, failing rows)."""
    zero = "CAST(0 AS BIGINT)"
    null_repo_of = "(SELECT count(*) FROM ev WHERE repo_id IS NULL AND event_type = 'WatchEvent')"
    null_days = "(SELECT count(DISTINCT event_date) FROM ev WHERE repo_id IS NULL)"
    null_actor = "(SELECT count(*) FROM ev WHERE actor_id IS NULL)"
    failing = {
        ("stg_watch_events", "repo_id"): null_repo_of,
        ("fct_daily_repo_metrics", "repo_id"): null_days,
        ("fact_events", "actor_id"): null_actor,
    }
    return _results("not_null", [(t, c, failing.get((t, c), zero)) for t, c in TESTED])


def _results(test: str, rows: list[tuple[str, str, str]]) -> str:
    union = " UNION ALL ".join(
        f"SELECT '{test}' AS test, '{t}' AS \"table\", '{c}' AS \"column\", CAST({n} AS BIGINT) AS failures"
        for t, c, n in rows
    )
    return (
        f"SELECT *, CASE WHEN failures > 0 THEN 'fail' ELSE 'pass' END AS status FROM ({union})"
    )


def _repeats(table: str, key: str) -> str:
    return f"(SELECT count(*) FROM (SELECT {key} FROM {table} GROUP BY {key} HAVING count(*) > 1))"


_EVENT_REPEATS = _repeats("ev", "event_id")

# What the dirty tables are made of: rows, and the number that says what is spoilt.
DIRTY_SOURCES = {
    "raw_events": ("SELECT event_id AS id, event_type AS type, created_at FROM ev", "id"),
    "stg_raw_events": ("SELECT * FROM ev", "event_id"),
    "stg_watch_events": ("SELECT * FROM ev WHERE event_type = 'WatchEvent'", "event_id"),
    "stg_push_events": ("SELECT * FROM pushes", "event_id"),
    "stg_create_events": ("SELECT * FROM creates", "event_id"),
    "stg_fork_events": ("SELECT * FROM ev WHERE event_type = 'ForkEvent'", "event_id"),
    "stg_issues_events": ("SELECT * FROM issues", "event_id"),
    "stg_pull_request_events": ("SELECT * FROM prs", "event_id"),
    "dim_actor": ("SELECT * FROM actors", "actor_id"),
    "dim_repo": ("SELECT repo_id, repo_name, true AS is_current FROM repos", "repo_id"),
    "dim_date": (
        "SELECT CAST(unnest(generate_series(min(event_at)::DATE::TIMESTAMP, max(event_at)::DATE::TIMESTAMP,"
        " INTERVAL 1 DAY)) AS DATE) AS date_id FROM ev", "day(date_id)",
    ),
    "fact_events": ("SELECT *, event_date AS date_id FROM ev", "event_id"),
    "fct_daily_repo_metrics": ("SELECT * FROM repo_day", "repo_id"),
}


def _dirty_tables() -> str:
    ctes = []
    for table, (rows, number) in DIRTY_SOURCES.items():
        columns = [c for t, c in TESTED if t == table]
        spoilt = ", ".join(f"CASE WHEN n % {7 + 2 * i} <> 0 THEN {c} END AS {c}" for i, c in enumerate(columns))
        ctes.append(f"b_{table} AS (SELECT *, {number} AS n FROM ({rows}))")
        ctes.append(
            f"d_{table} AS (SELECT n, {spoilt} FROM"
            f" (SELECT * FROM b_{table} UNION ALL SELECT * FROM b_{table} WHERE n % 5 = 0))"
        )
    return ", ".join(ctes)


def _dirty() -> str:
    def orphans(column: str, parent: str) -> str:
        return (
            f"(SELECT count(*) FROM d_fact_events f WHERE f.{column} IS NOT NULL"
            f" AND NOT EXISTS (SELECT 1 FROM {parent} p WHERE p.{column} = f.{column}))"
        )

    def repeats(table: str, key: str, where: str = "true") -> str:
        return (
            f"(SELECT count(*) FROM (SELECT {key} FROM {table} WHERE {key} IS NOT NULL AND {where}"
            f" GROUP BY {key} HAVING count(*) > 1))"
        )

    staged = [("watch", "Watch"), ("push", "Push"), ("create", "Create"), ("fork", "Fork"),
              ("issues", "Issues"), ("pull_request", "PullRequest")]
    return " UNION ALL ".join([
        _results("not_null", [(t, c, f"(SELECT count(*) FROM d_{t} WHERE {c} IS NULL)") for t, c in TESTED]),
        _results("unique", [
            ("stg_raw_events", "event_id", repeats("d_stg_raw_events", "event_id")),
            *[(f"stg_{v}_events", "event_id",
               repeats("d_stg_raw_events", "event_id", f"event_type = '{t}Event'")) for v, t in staged],
            *[(t, c, repeats(f"d_{t}", c)) for t, c in [
                ("raw_events", "id"), ("dim_actor", "actor_id"), ("dim_date", "date_id"),
                ("fact_events", "event_id")]],
        ]),
        _results("relationships", [
            ("fact_events", "actor_id", orphans("actor_id", "d_dim_actor")),
            ("fact_events", "date_id", orphans("date_id", "d_dim_date")),
        ]),
        _results("assert_dim_repo_date_range_valid", [
            ("dim_repo", "", "(SELECT count(*) FROM d_dim_repo WHERE n % 4 = 0)")]),
        _results("assert_repo_stars_non_negative", [
            ("int_repo_watch_stats", "", "(SELECT count(*) FROM spine WHERE repo_id % 3 = 0)")]),
    ])

ORACLE: dict[str, str] = {
    "normalize_batch": over_events(LANDED),
    "json_scan": over_events(LANDED),
    "json_quarantine": over_events(
        "SELECT CASE WHEN event_id % 83 = 0 OR event_id % 79 = 0 THEN 'quarantined' ELSE 'read' END AS kind,"
        " CASE WHEN event_id % 83 = 0 THEN 'not json ' || event_id"
        " WHEN event_id % 79 = 0 THEN '[1, ' || event_id || ']'"
        " ELSE CAST(event_id AS VARCHAR) END AS value FROM ev"
    ),
    "normalize_stream": over_events(
        "SELECT event_id % 71 = 0 AS hashed, CASE WHEN event_id % 71 <> 0 THEN event_id END AS id,"
        " CASE WHEN event_id % 73 = 0 THEN 'UnknownEvent' ELSE event_type END AS type,"
        " event_id % 59 = 0 OR is_public AS public, CASE WHEN event_id % 61 = 0 THEN 'bad'"
        " WHEN event_id % 67 = 0 THEN '2024-02-01T00:00:00Z' ELSE created_at END AS created_at,"
        " strftime(routed, '%Y') AS year, strftime(routed, '%m') AS month, strftime(routed, '%d') AS day,"
        " strftime(routed, '%H') AS hour FROM (SELECT *, CASE WHEN event_id % 61 = 0 OR event_id % 67 = 0"
        " THEN TIMESTAMP '2024-02-01 00:00:00' ELSE event_at END AS routed FROM ev)"
    ),
    "land_batch": over_events(HOUR_COUNTS),
    "partition_scan": over_events(
        f"SELECT event_id AS id, event_type AS type, {PAYLOAD} AS payload, is_public AS public, created_at,"
        " CAST(5 AS INTEGER) AS day, CAST(7 AS INTEGER) AS hour FROM ev"
        " WHERE date_trunc('hour', event_at) = TIMESTAMP '2024-01-05 07:00:00'"
    ),
    "insert_if_absent": over_events(
        f"SELECT event_id AS id, event_type AS type, {PAYLOAD} AS payload, created_at FROM ev"
        " WHERE event_date >= DATE '2024-01-16'"
    ),
    "hour_grid": """
SELECT CAST(h AS DATE) AS feed_date, CAST(hour(h) AS INTEGER) AS feed_hour,
  strftime(h, '%Y-%m-%d-') || hour(h) || '.json.gz' AS file_name
FROM (SELECT unnest(generate_series(date_trunc('day', min(ts)), date_trunc('day', max(ts))
  + INTERVAL 23 HOUR, INTERVAL 1 HOUR)) AS h FROM events)""",
    "dim_date": """
SELECT d AS date_id, d AS date_day, CAST(year(d) AS INTEGER) AS year, CAST(month(d) AS INTEGER) AS month,
  CAST(day(d) AS INTEGER) AS day, CAST(dayofweek(d) AS INTEGER) AS day_of_week, dayname(d) AS day_name,
  CAST(quarter(d) AS INTEGER) AS quarter, dayofweek(d) IN (0, 6) AS is_weekend
FROM (SELECT CAST(unnest(generate_series(date_trunc('day', min(o_orderdate)),
  date_trunc('day', max(o_orderdate)), INTERVAL 1 DAY)) AS DATE) AS d FROM orders)""",
    "stg_raw_events": over_events(
        "SELECT id AS event_id, type AS event_type, actor AS raw_actor, repo AS raw_repo, org AS raw_org,"
        " payload AS raw_payload, public AS is_public, event_at, TIMESTAMP '2024-02-01 00:00:00' AS loaded_at"
        f" FROM ({LANDED.replace('created_at,', 'created_at, event_at,')})"
    ),
    "stg_watch": view("'WatchEvent'", "'started' AS action,"),
    "stg_push": over_events("SELECT * FROM pushes"),
    "stg_create": over_events("SELECT * FROM creates"),
    "stg_fork": view(
        "'ForkEvent'", "1000000 + event_id AS forkee_id, 'fork/' || event_id AS forkee_name,"
    ),
    "stg_issues": over_events("SELECT * FROM issues"),
    "stg_issue_comment": view(
        "'IssueCommentEvent'", "'created' AS action, event_id AS issue_id, event_id AS comment_id,"
    ),
    "stg_pr": over_events("SELECT * FROM prs"),
    "stg_pr_review": view(
        "'PullRequestReviewCommentEvent', 'PullRequestReviewEvent'",
        "'created' AS action, event_id AS pr_id,",
    ),
    "stg_release": view(
        "'ReleaseEvent'",
        "'published' AS action, event_id AS release_id, 'v' || (event_id % 30) AS tag_name,",
    ),
    "stg_gollum": view("'GollumEvent'"),
    "stg_public": view("'PublicEvent'"),
    "latest_repo": over_events(
        latest("repo_id, repo_name, event_at AS last_event_at", "repo_id", where="repo_id IS NOT NULL")
    ),
    "latest_actor": over_events("SELECT * FROM actors", DAILY_ACTOR),
    "repo_watch_stats": over_events("SELECT * FROM watch_stats", WATCH_STATS),
    "repo_push_stats": over_events("SELECT * FROM push_stats", PUSH_STATS),
    "repo_issue_stats": over_events("SELECT * FROM issue_stats", ISSUE_STATS),
    "repo_pr_stats": over_events("SELECT * FROM pr_stats", PR_STATS),
    "repo_languages": over_events("SELECT * FROM languages", LANGUAGES),
    "repo_descriptions": over_events("SELECT * FROM descriptions", DESCRIPTIONS),
    "actor_rollup": over_events("SELECT * FROM actor_totals", DAILY_ACTOR),
    "repo_profile": over_events("SELECT * FROM profile", PROFILE),
    "fact_events": over_events(
        "SELECT event_id, event_type, actor_id, repo_id, event_date AS date_id, event_at, is_public,"
        " TIMESTAMP '2024-02-01 00:00:00' AS loaded_at FROM ev"
    ),
    "fct_repo_stars": over_events(
        "SELECT event_id, repo_id, actor_id, event_at AS starred_at FROM ev WHERE event_type = 'WatchEvent'"
    ),
    "daily_repo": over_events("SELECT * FROM daily_repo", f"{REPOS}, {DAILY_REPO}"),
    "incremental_daily": over_events("SELECT * FROM daily_repo", f"{REPOS}, {DAILY_REPO}"),
    "actor_activity": over_events("SELECT * FROM daily_actor", DAILY_ACTOR),
    "dim_actor": over_events(
        "SELECT a.actor_id, a.actor_login, a.actor_avatar_url, t.total_events AS total_events_created,"
        " t.push_events_count AS push_events_created, t.watch_events_count AS watch_events_created,"
        " t.pull_request_events_count AS pr_events_created, t.issues_events_count AS issues_events_created,"
        " a.last_event_at FROM actors a LEFT JOIN actor_totals t ON a.actor_id = t.actor_id",
        DAILY_ACTOR,
    ),
    "trending_repos": over_events(
        "SELECT *, rank() OVER (ORDER BY total_events DESC NULLS FIRST) AS rank_total,"
        " rank() OVER (ORDER BY star_growth DESC NULLS FIRST) AS rank_stars FROM ("
        " SELECT repo_id, repo_name, CAST(sum(total_events) AS BIGINT) AS total_events,"
        " CAST(sum(star_count) AS BIGINT) AS star_growth, CAST(sum(push_count) AS BIGINT) AS push_growth,"
        " CAST(sum(pr_count) AS BIGINT) AS pr_growth FROM daily_repo GROUP BY repo_id, repo_name)",
        f"{REPOS}, {DAILY_REPO}",
    ),
    "active_contributors": over_events(
        "SELECT * FROM (SELECT *, rank() OVER (ORDER BY total_events DESC NULLS FIRST) AS rank_activity FROM ("
        " SELECT actor_id, actor_login, CAST(sum(total_events) AS BIGINT) AS total_events,"
        " CAST(sum(push_count) AS BIGINT) AS push_count, CAST(sum(watch_count) AS BIGINT) AS watch_count,"
        " CAST(sum(pr_count) AS BIGINT) AS pr_count, CAST(sum(issue_count) AS BIGINT) AS issue_count"
        " FROM daily_actor GROUP BY actor_id, actor_login)) WHERE rank_activity <= 100",
        DAILY_ACTOR,
    ),
    "language_popularity": over_events(
        "SELECT *, rank() OVER (ORDER BY total_events DESC NULLS FIRST) AS popularity_rank FROM ("
        " SELECT p.primary_language, CAST(sum(d.total_events) AS BIGINT) AS total_events,"
        " CAST(sum(d.star_count) AS BIGINT) AS star_count, CAST(sum(d.push_count) AS BIGINT) AS push_count,"
        " CAST(sum(d.pr_count) AS BIGINT) AS pr_count, count(DISTINCT p.repo_id) AS active_repos"
        " FROM daily_repo d LEFT JOIN profile p ON d.repo_id = p.repo_id GROUP BY p.primary_language)",
        f"{PROFILE}, {DAILY_REPO}",
    ),
    "scd2": over_events("SELECT *, valid_to IS NULL AS is_current FROM history", HISTORY),
    "dim_repo": over_events("SELECT *, valid_to IS NULL AS is_current FROM history", HISTORY),
    "orders_latest": """
SELECT o_custkey, o_orderkey, o_totalprice, o_orderdate FROM (
  SELECT *, row_number() OVER (PARTITION BY o_custkey
    ORDER BY o_orderdate DESC NULLS FIRST, o_orderkey DESC) AS rn FROM orders) WHERE rn = 1""",
    "customer_rank": """
SELECT *, rank() OVER (ORDER BY orders DESC) AS rank_orders, rank() OVER (ORDER BY years DESC) AS rank_years
FROM (SELECT o_custkey, count(*) AS orders, count(DISTINCT year(o_orderdate)) AS years
  FROM orders GROUP BY o_custkey)""",
    "part_top_k": """
SELECT * FROM (SELECT *, rank() OVER (ORDER BY line_count DESC) AS rank_lines FROM (
  SELECT l_partkey, count(*) AS line_count FROM lineitem GROUP BY l_partkey)) WHERE rank_lines <= 100""",
    "dq_not_null": over_events(_nulls()),
    "dq_dirty": over_events(_dirty(), f"{REPOS}, {DAILY_REPO}, {DAILY_ACTOR}, {_dirty_tables()}"),
    "dq_unique": over_events(_results("unique", [
        ("stg_raw_events", "event_id", _EVENT_REPEATS),
        *[(f"stg_{v}_events", "event_id",
           f"(SELECT count(*) FROM (SELECT event_id FROM ev WHERE event_type = '{t}'"
           " GROUP BY event_id HAVING count(*) > 1))")
          for v, t in [("watch", "WatchEvent"), ("push", "PushEvent"), ("create", "CreateEvent"),
                       ("fork", "ForkEvent"), ("issues", "IssuesEvent"),
                       ("pull_request", "PullRequestEvent")]],
        ("raw_events", "id", _EVENT_REPEATS),
        ("dim_actor", "actor_id", "0"),
        ("dim_date", "date_id", "0"),
        ("fact_events", "event_id", _EVENT_REPEATS),
        ("lineitem", "l_orderkey", _repeats("lineitem", "l_orderkey")),
        ("orders", "o_orderkey", _repeats("orders", "o_orderkey")),
    ])),
    "dq_relationships": over_events(_results("relationships", [
        ("fact_events", "actor_id", "0"),
        ("fact_events", "date_id", "0"),
        ("lineitem", "l_partkey",
         "(SELECT count(*) FROM lineitem WHERE l_partkey IS NOT NULL"
         " AND NOT EXISTS (SELECT 1 FROM part WHERE p_partkey = l_partkey))"),
        ("orders", "o_custkey",
         "(SELECT count(*) FROM orders WHERE o_custkey IS NOT NULL AND NOT EXISTS"
         " (SELECT 1 FROM customer WHERE c_custkey = o_custkey AND c_acctbal >= 0))"),
    ])),
    "dq_assertions": over_events(
        "SELECT 'assert_dim_repo_date_range_valid' AS test, 'dim_repo' AS \"table\", '' AS \"column\","
        " CAST(0 AS BIGINT) AS failures, 'pass' AS status UNION ALL"
        " SELECT 'assert_repo_stars_non_negative', 'int_repo_watch_stats', '',"
        " (SELECT count(*) FROM watch_stats WHERE star_count < 0), 'pass'",
        WATCH_STATS,
    ),
    "rows_ingested": over_events(
        "SELECT count(*) AS rows_ingested FROM ev WHERE event_date = DATE '2024-01-15'"
    ),
    "rows_ingested_hour": over_events(
        "SELECT count(*) AS rows_ingested FROM ev"
        " WHERE date_trunc('hour', event_at) = TIMESTAMP '2024-01-15 09:00:00'"
    ),
    "freshness": over_events(
        "SELECT CAST(epoch(TIMESTAMP '2024-02-01 00:00:00' - max(event_at)) AS INTEGER)"
        " AS freshness_lag_seconds FROM ev"
    ),
    "obs_latest": over_events(
        "SELECT 'total_rows' AS panel, CAST(sum(rows_ingested) AS DOUBLE) AS value FROM metrics UNION ALL"
        " SELECT 'latest_lag', CAST(freshness_lag_seconds AS DOUBLE) FROM newest_run UNION ALL"
        " SELECT 'latest_success', round(CAST(dbt_tests_passed AS DOUBLE)"
        " / (dbt_tests_passed + dbt_tests_failed + 1e-5) * 100, 6) FROM newest_run",
        METRICS + ", newest_run AS (SELECT * FROM metrics ORDER BY dag_run_timestamp DESC LIMIT 1)",
    ),
    "obs_series": over_events(
        "SELECT dag_run_timestamp AS time, freshness_lag_seconds AS freshness_lag,"
        " rows_ingested AS events_processed FROM metrics ORDER BY time", METRICS,
    ),
    "obs_log": over_events(
        "SELECT dag_run_timestamp AS run_time, run_id, rows_ingested AS rows,"
        " freshness_lag_seconds AS freshness_lag_s, duration_seconds AS duration_s, status"
        " FROM metrics ORDER BY run_time DESC", METRICS,
    ),
    "obs_status": over_events(
        "SELECT run_id, dag_run_timestamp, CASE WHEN freshness_lag_seconds >= 7200 THEN 'red'"
        " WHEN freshness_lag_seconds >= 3600 THEN 'yellow' ELSE 'green' END AS lag_status,"
        " CASE WHEN dbt_tests_failed = 0 THEN 'green' WHEN dbt_tests_passed * 100.0"
        " / (dbt_tests_passed + dbt_tests_failed) >= 90 THEN 'yellow' ELSE 'red' END AS success_status"
        " FROM metrics", METRICS,
    ),
    "anomaly_trend": over_events("SELECT * FROM trend_flags", SERIES),
    "anomaly_zscore": over_events("SELECT * FROM deviation_flags", SERIES),
    "anomaly_auto": over_events(
        "SELECT f.* FROM trend_flags f JOIN trend t USING (repo_id, ds) WHERE t.n >= 3 UNION ALL"
        " SELECT f.* FROM deviation_flags f JOIN deviation d USING (repo_id, ds) WHERE d.n < 3",
        SERIES,
    ),
    "anomaly_hook": over_events(
        "SELECT f.* FROM trend_flags f JOIN trend t USING (repo_id, ds) WHERE t.n >= 3 UNION ALL"
        " SELECT f.* FROM deviation_flags f JOIN deviation d USING (repo_id, ds) WHERE d.n < 3",
        SERIES,
    ),
    "replay": over_events(f"SELECT CAST(event_id AS VARCHAR) AS key, {LINE} AS value FROM ev"),
    "stream_land": over_events(HOUR_COUNTS),
    "stream_load": over_events(
        f"SELECT event_id AS id, event_type AS type, {ACTOR} AS actor, {REPO} AS repo, {PAYLOAD} AS payload,"
        " is_public AS public, created_at, event_date, TIMESTAMP '2024-02-01 00:00:00' AS loaded_at FROM ev"
    ),
    "stream_dedupe": over_events("SELECT event_id AS id, event_type AS type, event_at FROM ev"),
    "stream_daily": over_events(
        "SELECT repo_id, event_date, total_events, star_count, push_count, pr_count, issue_count"
        " FROM daily_repo",
        f"{REPOS}, {DAILY_REPO}",
    ),
    "message_ids": over_events(
        "SELECT count(*) AS messages, count(DISTINCT CASE WHEN event_id % 71 = 0 THEN 'x' || event_id"
        " ELSE CAST(event_id AS VARCHAR) END) AS ids, count(*) AS same_again FROM ev"
    ),
    "repo_pushers_bitmap": over_events(
        "SELECT repo_id, event_date, count(DISTINCT actor_id) AS pushers, ("
        " SELECT count(DISTINCT q.actor_id) FROM (SELECT * FROM ev WHERE event_type = 'PushEvent') q"
        " WHERE q.repo_id IS NOT DISTINCT FROM p.repo_id) AS pushers_ever"
        " FROM (SELECT * FROM ev WHERE event_type = 'PushEvent' AND actor_id IS NOT NULL) p GROUP BY repo_id, event_date"
    ),
    "incremental_profile": over_events("SELECT * FROM profile", PROFILE),
    "incremental_actors": over_events("SELECT * FROM actor_totals", DAILY_ACTOR),
    "daily_repo_pruned": over_events(
        "SELECT * FROM daily_repo WHERE event_date BETWEEN DATE '2024-01-10' AND DATE '2024-01-12'",
        f"{REPOS}, {DAILY_REPO}",
    ),
    "daily_actor_pruned": over_events(
        "SELECT * FROM daily_actor WHERE event_date BETWEEN DATE '2024-01-10' AND DATE '2024-01-12'", DAILY_ACTOR,
    ),
    "key_lookup": over_events("SELECT event_id AS id FROM ev WHERE event_id % 3 <> 0 AND event_id % 5 = 0"),
    "late_load": over_events("SELECT event_id AS id, event_type AS type, created_at, event_date FROM ev"),
    "anomaly_states": over_events(
        "SELECT 'trend' AS rule, * FROM trend_flags UNION ALL SELECT 'zscore', * FROM deviation_flags", SERIES
    ),
    "anomaly_short": over_events(
        "SELECT f.* FROM trend_flags f JOIN trend t USING (repo_id, ds) WHERE t.n >= 3 UNION ALL"
        " SELECT f.* FROM deviation_flags f JOIN deviation d USING (repo_id, ds) WHERE d.n < 3",
        SERIES.replace(
            "FROM daily_repo WHERE repo_id IS NOT NULL",
            "FROM daily_repo WHERE repo_id IS NOT NULL AND (repo_id % 2 = 0 OR event_date <= DATE '2024-01-02')",
        ),
    ),
    "stg_variant": over_events(
        "SELECT 'push' AS view, event_id, push_id AS number, branch_ref AS words, CAST(NULL AS TIMESTAMP) AS closed_at FROM pushes"
        " UNION ALL SELECT 'issues', event_id, issue_number, issue_state || ' ' || action, issue_closed_at FROM issues"
        " UNION ALL SELECT 'pull_request', event_id, pr_number, pr_state || ' ' || action, pr_closed_at FROM prs"
    ),
    "event_ranks": over_events(
        "SELECT event_id, rank() OVER (ORDER BY epoch(event_at) DESC NULLS FIRST) AS newest_rank FROM ev"
    ),
    "contract_tables": over_events(
        "SELECT kind, reason, count(*) AS n FROM ("
        " SELECT 'anomalies' AS kind, CASE WHEN repo_id IS NULL THEN 'repo_id missing'"
        " WHEN repo_id % 5 = 0 THEN 'repo_name missing' WHEN event_date IS NULL THEN 'ds missing'"
        " WHEN repo_id % 7 = 0 THEN 'repo_name longer than 255' ELSE 'kept' END AS reason FROM daily_repo"
        " UNION ALL SELECT 'metrics', CASE WHEN day(event_date) % 5 = 0 THEN 'run_id missing'"
        " WHEN day(event_date) % 7 = 0 THEN 'rows_ingested is not bigint'"
        " WHEN day(event_date) % 3 = 0 THEN 'run_id longer than 100' ELSE 'kept' END"
        " FROM (SELECT event_date FROM ev GROUP BY event_date)) GROUP BY kind, reason",
        f"{REPOS}, {DAILY_REPO}",
    ),
    "pipeline_hour": over_events(
        "SELECT event_id, event_type, actor_id, repo_id, event_at, n AS repo_day_events,"
        " CASE WHEN repo_id IS NOT NULL THEN rank_total END AS rank_total"
        " FROM (SELECT * FROM seen LEFT JOIN days USING (repo_id, event_date)) LEFT JOIN ranked USING (repo_id)",
        "seen AS (SELECT event_id, event_type, actor_id, repo_id, CASE WHEN event_id % 61 <> 0 THEN event_at END AS event_at,"
        " CASE WHEN event_id % 61 <> 0 THEN event_date END AS event_date FROM ev),"
        " days AS (SELECT repo_id, event_date, count(*) AS n FROM seen WHERE repo_id IS NOT NULL AND event_date IS NOT NULL"
        " GROUP BY ALL), ranked AS (SELECT repo_id, rank() OVER (ORDER BY total DESC) AS rank_total"
        " FROM (SELECT repo_id, count(*) AS total FROM seen GROUP BY repo_id))",
    ),
}
