"""The registered queries as SQL over the supplied tables, written independently."""

from __future__ import annotations

WS = r"[ \t\n\x0B\f\r]+"
CTRL = r"[\x00-\x08\x0b\x0c\x0e-\x1f]"
BAD = "('[removed]', '[deleted]', '', 'n/a')"
AS_OF = "DATE '2024-01-31'"

# Spark's default English stop words.
STOP_WORDS = """
i me my myself we our ours ourselves you your yours yourself yourselves he him his himself she
her hers herself it its itself they them their theirs themselves what which who whom this that
these those am is are was were be been being have has had having do does did doing a an the and
but if or because as until while of at by for with about against between into through during
before after above below to from up down in out on off over under again further then once here
there when where why how all any both each few more most other some such no nor not only own
same so than too very s t can will just don should now i'll you'll he'll she'll we'll they'll
i'd you'd he'd she'd we'd they'd i'm you're he's she's it's we're they're i've we've you've
they've isn't aren't wasn't weren't haven't hasn't hadn't don't doesn't didn't won't wouldn't
shan't shouldn't mustn't can't couldn't cannot could here's how's let's ought that's there's
what's when's where's who's why's would
"""

RAW_POSTS = """
raw_posts AS (
  SELECT 'post' AS type, CAST(d.doc_id AS VARCHAR) AS id, d.source AS channel_name,
         l.toxic = 1 AS channel_nsfw,
         CAST(1704067200 + (d.doc_id * 7919) % 2592000 AS BIGINT) AS created_utc,
         CASE WHEN coalesce(l.toxic = 1, false) AND coalesce(l.quality = 0, false) THEN NULL
              ELSE concat(d.source, '  note ', d.doc_id, CASE WHEN d.doc_id % 3 = 0 THEN '?' ELSE '' END)
         END AS title,
         CASE WHEN coalesce(l.toxic = 1, false) THEN '[removed]' ELSE d.text END AS selftext,
         concat('/d/', d.doc_id) AS permalink, d.lang AS domain,
         CASE WHEN d.doc_id % 2 = 1 THEN concat('https://e.com/', d.doc_id) END AS url,
         CASE WHEN coalesce(l.quality = 0, false) AND NOT coalesce(l.toxic = 1, false)
                   AND d.n_chars < 1000 THEN NULL
              ELSE CAST(d.n_chars % 1000 - 100 AS BIGINT) END AS score
  FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id
)"""

RAW_COMMENTS = """
raw_comments AS (
  SELECT 'comment' AS type, concat(conv_id, '_', turn) AS id, role AS channel_name,
         false AS channel_nsfw,
         CAST(1704067200 + (conv_id * 3607 + turn * 61) % 2592000 AS BIGINT) AS created_utc,
         CASE WHEN length(text) < 60 THEN '[deleted]' ELSE text END AS body,
         CASE WHEN conv_id % 7 = 0 THEN NULL WHEN conv_id % 13 = 0 THEN 'bad'
              ELSE CAST(CAST((conv_id * 7 + turn * 13) % 21 - 10 AS DOUBLE) / 10 AS VARCHAR)
         END AS sentiment,
         CAST(length(text) % 120 - 20 AS BIGINT) AS score
  FROM conversations
)"""


def normalized(posts_topic: str = "domain", comments_topic: str = "'chat'") -> str:
    return f"""
normalized AS (
  SELECT concat('post_', id) AS event_id, 'post' AS event_type, {posts_topic} AS topic,
         channel_name AS channel, channel_nsfw, created_utc, title, selftext AS body_text, score,
         permalink, domain, url, CAST(NULL AS VARCHAR) AS sentiment_source
  FROM raw_posts
  UNION ALL
  SELECT concat('comment_', id), 'comment', {comments_topic}, channel_name, channel_nsfw,
         created_utc, NULL, body, score, NULL, NULL, NULL, sentiment
  FROM raw_comments
)"""


def clean(x: str) -> str:
    return (
        f"trim(regexp_replace(regexp_replace({x}, '{WS}', ' ', 'g'), '{CTRL}', '', 'g'), ' ')"
    )


def placeholder(x: str) -> str:
    return f"({x} IS NULL OR lower(trim({x}, ' ')) IN {BAD})"


def _enriched(source: str, scrub: bool = False) -> str:
    """Cleaned and filtered rows of a normalized relation, before de-duplication."""
    title, body = clean("title"), clean("body_text")
    if scrub:
        title = f"CASE WHEN NOT {placeholder(title)} THEN {title} END"
        body = f"CASE WHEN NOT {placeholder(body)} THEN {body} END"
    return f"""
cleaned AS (
  SELECT * EXCLUDE (title, body_text), {title} AS title, {body} AS body FROM {source}
  WHERE score IS NOT NULL
),
joined AS (
  SELECT * EXCLUDE (body), trim(concat(coalesce(title, ''), ' ', coalesce(body, '')), ' ') AS text,
         make_timestamp(created_utc * 1000000) AS created_ts
  FROM cleaned
),
enriched AS (
  SELECT *, CAST(created_ts AS DATE) AS created_date,
         extract(hour FROM created_ts) AS created_hour,
         extract(dow FROM created_ts) + 1 AS created_dow,
         length(text) AS text_length,
         CASE WHEN text = '' THEN 0 ELSE len(regexp_split_to_array(text, '{WS}')) END AS word_count
  FROM joined WHERE NOT {placeholder("title")} OR NOT {placeholder("text")}
)"""


EVENT_COLUMNS = """event_id, event_type, topic, channel, channel_nsfw, created_ts, created_date,
  created_hour, created_dow, title, text, text_length, word_count, score, permalink, domain, url,
  sentiment_source"""

# Keys are unique in the supplied tables, so only the re-ingest query needs to de-duplicate.
SILVER = f"""{RAW_POSTS},{RAW_COMMENTS},{normalized()},{_enriched("normalized")},
silver AS (SELECT {EVENT_COLUMNS} FROM enriched)"""

POSTS = f"{SILVER},\nposts AS (SELECT * FROM silver WHERE event_type = 'post')"

TIMED = r"""
timed AS (
  SELECT CAST(event_id AS VARCHAR) AS event_id,
         CASE WHEN event_type IN ('signup', 'purchase') THEN 'post' ELSE 'comment' END AS event_type,
         concat('t', user_id % 3) AS topic, concat('c', user_id) AS channel,
         CASE WHEN user_id % 20 <> 7 THEN user_id % 20 = 3 END AS channel_nsfw,
         ts AS created_ts, CAST(ts AS DATE) AS created_date,
         extract(hour FROM ts) AS created_hour, extract(dow FROM ts) + 1 AS created_dow,
         length(props) AS text_length,
         len(regexp_split_to_array(props, '[ \t\n\x0B\f\r]+')) AS word_count,
         CAST(floor(value) AS BIGINT) - 20 AS score
  FROM events
)"""


def daily(source: str) -> str:
    return f"""
daily AS (
  SELECT topic, channel, created_date, count(*) AS event_count,
         count(*) FILTER (event_type = 'post') AS post_count,
         count(*) FILTER (event_type = 'comment') AS comment_count,
         avg(score) AS avg_score, quantile_disc(score, 0.5) AS median_score,
         max(score) AS max_score, CAST(sum(score) AS BIGINT) AS total_score,
         avg(text_length) AS avg_text_length, avg(word_count) AS avg_word_count,
         CAST(count(*) FILTER (event_type = 'comment') AS DOUBLE)
           / greatest(count(*) FILTER (event_type = 'post'), 1) AS comments_per_post
  FROM {source} GROUP BY topic, channel, created_date
)"""


def summary(source: str) -> str:
    return f"""
summary AS (
  SELECT topic, channel, count(*) AS event_count, count(DISTINCT created_date) AS active_days,
         avg(score) AS avg_score, quantile_disc(score, 0.9) AS p90_score, max(score) AS max_score,
         min(created_ts) AS first_seen, max(created_ts) AS last_seen,
         (array_agg(channel_nsfw ORDER BY created_ts, channel_nsfw)
            FILTER (channel_nsfw IS NOT NULL))[1] AS nsfw,
         CAST(count(*) AS DOUBLE) / greatest(count(DISTINCT created_date), 1) AS events_per_active_day
  FROM {source} GROUP BY topic, channel
)"""


HOURLY = """
hourly AS (
  SELECT topic, created_dow, created_hour, count(*) AS event_count, avg(score) AS avg_score
  FROM timed GROUP BY topic, created_dow, created_hour
)"""


def trend(frame: str) -> str:
    return f"""
trend AS (
  SELECT topic, channel, created_date, event_count, post_count, comment_count, avg_score,
         median_score, total_score, avg_word_count,
         CAST(sum(event_count) OVER last7 AS BIGINT) AS events_rolling_7d,
         avg(avg_score) OVER last7 AS avg_score_rolling_7d,
         event_count - lag(event_count) OVER (PARTITION BY topic, channel ORDER BY created_date)
           AS event_count_dod_delta
  FROM daily
  WINDOW last7 AS (PARTITION BY topic, channel ORDER BY created_date {frame})
)"""


TREND_ROWS = trend("ROWS BETWEEN 6 PRECEDING AND CURRENT ROW")
TREND_DAYS = trend("RANGE BETWEEN INTERVAL 6 DAYS PRECEDING AND CURRENT ROW")

BOARD = """
board AS (
  SELECT topic, channel, event_count, active_days, avg_score, p90_score, max_score, nsfw,
         first_seen, last_seen,
         round(CAST(event_count AS DOUBLE) / nullif(active_days, 0), 2) AS events_per_active_day,
         CAST(rank() OVER (PARTITION BY topic ORDER BY event_count DESC) AS INTEGER) AS rank_by_volume,
         CAST(rank() OVER (PARTITION BY topic ORDER BY avg_score DESC) AS INTEGER) AS rank_by_avg_score
  FROM summary
)"""

HEAT = """
heat AS (
  SELECT topic, created_dow AS day_of_week,
         CASE created_dow WHEN 1 THEN 'Sun' WHEN 2 THEN 'Mon' WHEN 3 THEN 'Tue' WHEN 4 THEN 'Wed'
              WHEN 5 THEN 'Thu' WHEN 6 THEN 'Fri' WHEN 7 THEN 'Sat' END AS day_label,
         created_hour AS hour_of_day, event_count, avg_score
  FROM hourly
)"""

_LETTERS = "aeioun"
_COUNTS = ", ".join(f"length(text) - length(replace(text, '{c}', '')) AS n_{c}" for c in _LETTERS)
_TOTAL = " + ".join(f"n_{c}" for c in _LETTERS)
_SHARES = ", ".join(f"coalesce(CAST(n_{c} AS DOUBLE) / nullif({_TOTAL}, 0), 0.0)" for c in _LETTERS)

POST_TOPICS = f"""{POSTS},
letters AS (SELECT *, {_COUNTS} FROM posts),
shares AS (SELECT *, [{_SHARES}] AS shares FROM letters),
post_topics AS (
  SELECT event_id, topic, channel, created_date, score, text,
         CAST(list_position(shares, list_max(shares)) - 1 AS INTEGER) AS dominant_topic,
         list_max(shares) AS topic_confidence
  FROM shares
)"""

TOPIC_TERMS = f"""{POST_TOPICS},
words AS (
  SELECT dominant_topic AS topic_id,
         unnest(list_filter(regexp_split_to_array(lower(text), '[^a-z]+'), lambda t: length(t) >= 3)) AS term
  FROM post_topics
),
term_counts AS (
  SELECT topic_id, term,
         row_number() OVER (PARTITION BY topic_id ORDER BY count(*) DESC, term) AS place
  FROM words GROUP BY topic_id, term
),
topic_terms AS (
  SELECT topic_id, string_agg(term, '|' ORDER BY place) FILTER (place <= 10) AS terms,
         string_agg(term, ', ' ORDER BY place) FILTER (place <= 4) AS label
  FROM term_counts WHERE place <= 10 GROUP BY topic_id
)"""

TOPIC_SHARE = f"""{TOPIC_TERMS},
per_topic AS (
  SELECT topic, created_date, dominant_topic, count(*) AS n FROM post_topics GROUP BY ALL
),
topic_share AS (
  SELECT p.topic, p.created_date, p.dominant_topic, t.label AS topic_label, p.n AS event_count,
         round(CAST(p.n AS DOUBLE) / sum(p.n) OVER (PARTITION BY p.topic, p.created_date), 4) AS topic_share
  FROM per_topic p LEFT JOIN topic_terms t ON p.dominant_topic = t.topic_id
)"""

SENTIMENT = f"""{SILVER},
sourced AS (SELECT *, try_cast(sentiment_source AS DOUBLE) AS src FROM silver),
post_sentiment AS (
  SELECT * EXCLUDE (src),
         CASE WHEN src > 0.05 THEN 'positive' WHEN src < -0.05 THEN 'negative'
              WHEN src IS NOT NULL THEN 'neutral' WHEN score > 5 THEN 'positive'
              WHEN score < 0 THEN 'negative' ELSE 'neutral' END AS sentiment_label
  FROM sourced
)"""

BREAKDOWN = f"""{SENTIMENT},
counts AS (
  SELECT topic, channel, created_date, count(*) AS total,
         count(*) FILTER (sentiment_label = 'positive') AS positive,
         count(*) FILTER (sentiment_label = 'neutral') AS neutral,
         count(*) FILTER (sentiment_label = 'negative') AS negative
  FROM post_sentiment GROUP BY topic, channel, created_date
),
breakdown AS (
  SELECT *, round(CAST(positive AS DOUBLE) / total, 4) AS positive_ratio,
         round(CAST(negative AS DOUBLE) / total, 4) AS negative_ratio,
         round(CAST(positive - negative AS DOUBLE) / total, 4) AS net_sentiment
  FROM counts
)"""

ENGAGEMENT = f"""{SILVER},
thresholds AS (SELECT topic, quantile_disc(score, 0.9) AS score_threshold FROM silver GROUP BY topic),
labelled AS (
  SELECT s.*, t.score_threshold,
         CASE WHEN s.score >= t.score_threshold THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS label
  FROM silver s LEFT JOIN thresholds t ON s.topic = t.topic
)"""

ENGAGEMENT_SUMMARY = f"""{ENGAGEMENT},
scored AS (
  SELECT topic, channel, created_date, count(*) AS scored_events,
         CAST(sum(CAST(label AS INTEGER)) AS BIGINT) AS predicted_high,
         round(avg(CAST(text_length AS DOUBLE) / (text_length + 1000.0::DOUBLE)), 4) AS avg_engagement_proba,
         round(avg(score), 2) AS avg_actual_score
  FROM labelled GROUP BY topic, channel, created_date
),
engagement_summary AS (
  SELECT *, round(CAST(predicted_high AS DOUBLE) / scored_events, 4) AS high_engagement_rate FROM scored
)"""

KPIS = f"""{SENTIMENT},{summary("post_sentiment")},
mood AS (
  SELECT topic,
         CAST(count(*) FILTER (sentiment_label = 'positive')
              - count(*) FILTER (sentiment_label = 'negative') AS DOUBLE) / count(*) AS net
  FROM post_sentiment GROUP BY topic
),
kpis AS (
  SELECT s.topic, count(DISTINCT s.channel) AS channels,
         CAST(sum(s.event_count) AS BIGINT) AS total_events,
         round(avg(s.avg_score), 2) AS avg_score,
         round(sum(s.avg_score * s.event_count) / sum(s.event_count), 2) AS avg_score_weighted,
         min(s.first_seen) AS earliest_event, max(s.last_seen) AS latest_event,
         round(avg(m.net), 4) AS avg_net_sentiment
  FROM summary s LEFT JOIN mood m ON s.topic = m.topic GROUP BY s.topic
)"""


def _rule(position: int, name: str, severity: str, passed: str, bad: str, metric: str, source: str,
          detail: str = "''") -> str:
    return f"""
SELECT {position} AS position, '{name}' AS name, '{severity}' AS severity, {passed} AS passed,
       CAST({bad} AS BIGINT) AS violating_rows, CAST({metric} AS DOUBLE) AS metric, {detail} AS detail
FROM {source}"""


def _none(position: int, name: str, severity: str, condition: str, source: str) -> str:
    n = f"count(*) FILTER ({condition})"
    return _rule(position, name, severity, f"{n} = 0", n, n, source)


def _dup(position: int, name: str, severity: str, keys: str, source: str) -> str:
    n = "coalesce(sum(n - 1), 0)"
    copies = f"(SELECT count(*) AS n FROM {source} GROUP BY {keys})"
    return _rule(position, name, severity, f"{n} = 0", n, n, copies)


def _share(position: int, column: str, threshold: str, source: str) -> str:
    n = f"count(*) FILTER ({column} IS NULL)"
    share = f"CAST({n} AS DOUBLE) / count(*)"
    return _rule(position, f"max_null_ratio({column}, {threshold})", "warning",
                 f"{share} <= {threshold}", n, share, source, f"printf('null_ratio=%.4f', {share})")


def _fresh(position: int, days: int, source: str) -> str:
    age = f"date_diff('day', CAST(max(created_ts) AS DATE), {AS_OF})"
    return _rule(position, "freshness(created_ts)", "warning", f"{age} <= {days}", "0", age, source,
                 f"concat('age_days=', {age})")


def _dq(one_by_one: bool) -> list[str]:
    at = (lambda i: 0) if one_by_one else (lambda i: i)
    return [
        _none(at(0), "not_null(event_id, channel_nsfw)", "critical",
              "event_id IS NULL OR channel_nsfw IS NULL", "timed"),
        _dup(at(1), "unique(channel, created_date)", "critical", "channel, created_date", "timed"),
        _none(at(2), "in_range(score, 0, 300)", "warning", "score < 0 OR score > 300", "timed"),
        _none(at(3), "accepted_values(event_type)", "critical", "event_type <> 'post'", "timed"),
        _rule(at(4), "min_row_count(1000000)", "critical", "count(*) >= 1000000",
              "greatest(0, 1000000 - count(*))", "count(*)", "timed"),
        _share(at(5), "channel_nsfw", "0.02", "timed"),
        _fresh(at(6), 30, "timed"),
    ]


_DQ_NAMES = ["dq_not_null", "dq_unique", "dq_in_range", "dq_accepted_values", "dq_min_rows",
             "dq_null_ratio", "dq_freshness"]

_GATE = "\nUNION ALL".join([
    _none(0, "not_null(event_id, event_type, topic, created_ts)", "critical",
          "event_id IS NULL OR event_type IS NULL OR topic IS NULL OR created_ts IS NULL", "silver"),
    _dup(1, "unique(topic, event_id)", "critical", "topic, event_id", "silver"),
    _none(2, "accepted_values(event_type)", "critical", "event_type NOT IN ('post', 'comment')", "silver"),
    _none(3, "in_range(score, -100000, 10000000)", "warning", "score < -100000 OR score > 10000000", "silver"),
    _share(4, "channel", "0.02", "silver"),
    _fresh(5, 3650, "silver"),
])



def _audited(job: str, batch: str, verdicts: str) -> str:
    return f"""
SELECT '{job}' AS job, '{batch}' AS batch, CAST(position AS INTEGER) AS position,
       * EXCLUDE (position) FROM ({verdicts})"""


def _bronze_verdicts(source: str, severity: str) -> str:
    enough = _rule(0, "min_row_count(1)", "critical", "count(*) >= 1", "greatest(0, 1 - count(*))",
                   "count(*)", source)
    return enough + "\nUNION ALL" + _none(1, "not_null(id)", severity, "id IS NULL", source)


_AUDITED = "\nUNION ALL".join([
    _audited("bronze docs/posts", "b1", _bronze_verdicts("landed", "warning")),
    _audited("bronze chat/comments", "b1", _bronze_verdicts("raw_comments", "warning")),
    _audited("silver", "r1", _GATE),
])

# A second delivery of the labelled posts, one point higher.
REDELIVERED = """
again AS (
  SELECT r.* REPLACE (r.score + 1 AS score)
  FROM raw_posts r WHERE r.id IN (SELECT CAST(doc_id AS VARCHAR) FROM labels)
)"""

DEDUP = f"""{RAW_POSTS},{REDELIVERED},
deliveries AS (SELECT *, 1 AS batch FROM raw_posts UNION ALL SELECT *, 2 FROM again),
normalized AS (
  SELECT concat('post_', id) AS event_id, 'post' AS event_type, domain AS topic,
         channel_name AS channel, channel_nsfw, created_utc, title, selftext AS body_text, score,
         permalink, domain, url, CAST(NULL AS VARCHAR) AS sentiment_source, batch
  FROM deliveries
),{_enriched("normalized")},
deduped AS (
  SELECT * FROM enriched
  QUALIFY row_number() OVER (PARTITION BY topic, event_id ORDER BY batch DESC) = 1
)"""

# Redelivered posts win over stored ones, comments are new.
UPSERT = f"""WITH {RAW_POSTS},{RAW_COMMENTS},{REDELIVERED},
normalized AS (
  SELECT concat('post_', id) AS event_id, 'post' AS event_type, domain AS topic,
         channel_name AS channel, channel_nsfw, created_utc, title, selftext AS body_text, score,
         permalink, domain, url, CAST(NULL AS VARCHAR) AS sentiment_source, 1 AS batch
  FROM raw_posts
  UNION ALL
  SELECT concat('post_', id), 'post', domain, channel_name, channel_nsfw, created_utc, title,
         selftext, score, permalink, domain, url, NULL, 2
  FROM again
  UNION ALL
  SELECT concat('comment_', id), 'comment', 'chat', channel_name, channel_nsfw, created_utc, NULL,
         body, score, NULL, NULL, NULL, sentiment, 2
  FROM raw_comments
),{_enriched("normalized")}
SELECT {EVENT_COLUMNS} FROM enriched
QUALIFY row_number() OVER (PARTITION BY topic, event_id ORDER BY batch DESC) = 1"""

LAKE = f"""{RAW_POSTS},{RAW_COMMENTS},{normalized("'docs'")},{_enriched("normalized")},
silver AS (SELECT {EVENT_COLUMNS} FROM enriched)"""

_STOPPED = "', '".join(w.replace("'", "''") for w in STOP_WORDS.split())
_TOKENS = "list_distinct(list_filter(regexp_split_to_array(lower(text), '[^a-z]+'), lambda t: length(t) >= 3))"


_ALL_TOKENS = "list_filter(regexp_split_to_array(lower(text), '[^a-z]+'), lambda t: length(t) >= 3)"


def _bucket(buckets: int, seed: int) -> str:
    return f"CAST(concat('0x', substr(md5(concat_ws('|', topic, event_id, '{seed}')), 1, 8)) AS BIGINT) % {buckets}"


def _pct(column: str, points: list[float]) -> str:
    return ", ".join(f"quantile_disc({column}, {p}) AS p{round(p * 100):02d}" for p in points)


_NUMERIC = ["text_length", "word_count", "created_hour", "created_dow", "has_url", "is_question", "is_post"]
_FLAGGED = f"""{SILVER},
flagged AS (
  SELECT topic, event_id, text_length, word_count, created_hour, created_dow,
         CASE WHEN url <> '' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS has_url,
         CASE WHEN contains(text, '?') THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS is_question,
         CASE WHEN event_type = 'post' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS is_post
  FROM silver
)"""
_SCALED = ", ".join(f"round((f.{c} - s.m_{c}) / s.d_{c}, 6) AS {c}" for c in _NUMERIC)
_MOMENTS = ", ".join(f"avg({c}) AS m_{c}, stddev_samp({c}) AS d_{c}" for c in _NUMERIC)
_NULL_COLUMNS = ["event_id", "channel", "created_ts", "text", "score", "text_length", "channel_nsfw",
                 "title", "domain", "url", "sentiment_source"]
_NULLS = ", ".join(f"round(avg(CASE WHEN {c} IS NULL THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END), 4) AS {c}"
                   for c in _NULL_COLUMNS)


def all_sql() -> dict[str, str]:
    timed_daily = f"WITH {TIMED},{daily('timed')}"
    timed_summary = f"WITH {TIMED},{summary('timed')}"
    timed_heat = f"WITH {TIMED},{HOURLY},{HEAT}"
    sql = {
        "bronze_posts": f"""WITH {RAW_POSTS}
SELECT *, 'docs' AS _topic, 'b1' AS _batch_id, TIMESTAMP '2024-02-01 00:00:00' AS _ingested_at,
       DATE '2024-02-01' AS _ingest_date FROM raw_posts""",
        "upsert": UPSERT,
        "upsert_partitions": UPSERT,
        "layout_rewrite": f"WITH {TIMED} SELECT * FROM timed",
        "silver_events": f"WITH {SILVER} SELECT * FROM silver",
        "silver_events_scrubbed": f"""WITH {RAW_POSTS},{RAW_COMMENTS},{normalized()},
posts_only AS (SELECT * FROM normalized WHERE event_type = 'post'),{_enriched("posts_only", True)}
SELECT {EVENT_COLUMNS} FROM enriched""",
        "normalize_raw": f"WITH {RAW_POSTS},{RAW_COMMENTS},{normalized()} SELECT * FROM normalized",
        "cleaned_text": f"SELECT doc_id, {clean('text')} AS cleaned FROM documents",
        "text_metrics": f"""WITH c AS (SELECT doc_id, {clean('text')} AS cleaned FROM documents)
SELECT doc_id, length(cleaned) AS text_length,
       CASE WHEN cleaned = '' THEN 0 ELSE len(regexp_split_to_array(cleaned, '{WS}')) END AS word_count
FROM c""",
        "dedup_events": f"WITH {DEDUP} SELECT {EVENT_COLUMNS} FROM deduped",
        "daily_activity": f"{timed_daily} SELECT * FROM daily",
        "daily_activity_silver": f"WITH {SILVER},{daily('silver')} SELECT * FROM daily",
        "channel_summary": f"{timed_summary} SELECT * FROM summary",
        "channel_summary_silver": f"WITH {SILVER},{summary('silver')} SELECT * FROM summary",
        "hourly_activity": f"WITH {TIMED},{HOURLY} SELECT * FROM hourly",
        "topic_trends": f"""WITH {POST_TOPICS}
SELECT topic, dominant_topic, created_date, count(*) AS event_count, avg(score) AS avg_score,
       round(avg(topic_confidence), 9) AS avg_confidence
FROM post_topics GROUP BY topic, dominant_topic, created_date""",
        "sentiment_daily": f"""WITH {BREAKDOWN}
SELECT topic, channel, created_date, total AS event_count, positive, neutral, negative,
       CAST(positive - negative AS DOUBLE) / greatest(total, 1) AS net_sentiment
FROM counts""",
        "view_daily_trend": f"{timed_daily},{TREND_ROWS} SELECT * FROM trend",
        "view_daily_trend_calendar": f"{timed_daily},{TREND_DAYS} SELECT * FROM trend",
        "view_leaderboard": f"{timed_summary},{BOARD} SELECT * FROM board",
        "view_heatmap": f"{timed_heat} SELECT * FROM heat",
        "view_topics_labeled": f"""WITH {TOPIC_TERMS}
SELECT p.event_id, p.topic, p.channel, p.created_date, p.score, p.dominant_topic, p.topic_confidence,
       t.label AS topic_label, t.terms AS topic_terms
FROM post_topics p LEFT JOIN topic_terms t ON p.dominant_topic = t.topic_id""",
        "view_topic_share": f"WITH {TOPIC_SHARE} SELECT * FROM topic_share",
        "view_sentiment_breakdown": f"WITH {BREAKDOWN} SELECT * FROM breakdown",
        "view_engagement_summary": f"WITH {ENGAGEMENT_SUMMARY} SELECT * FROM engagement_summary",
        "view_topic_kpis": f"WITH {KPIS} SELECT * FROM kpis",
        "tile_01": f"""WITH {KPIS}
SELECT topic, total_events, channels, avg_score, avg_net_sentiment FROM kpis ORDER BY total_events DESC""",
        "tile_02": f"""{timed_daily},{TREND_ROWS} SELECT topic, created_date, events_rolling_7d FROM trend
WHERE created_date >= {AS_OF} - 90""",
        "tile_03": f"""{timed_summary},{BOARD} SELECT channel, topic, event_count, avg_score FROM board
WHERE rank_by_volume <= 15""",
        "tile_04": f"""{timed_heat} SELECT day_label, hour_of_day, CAST(sum(event_count) AS BIGINT) AS events
FROM heat GROUP BY day_label, hour_of_day""",
        "tile_05": f"""WITH {TOPIC_SHARE},
per_label AS (
  SELECT created_date, topic_label, sum(topic_share) AS topic_share, sum(event_count) AS n
  FROM topic_share WHERE created_date >= {AS_OF} - 60 GROUP BY created_date, topic_label
)
SELECT created_date, topic_label, round(topic_share, 9) AS topic_share,
       round(CAST(n AS DOUBLE) / sum(n) OVER (PARTITION BY created_date), 4) AS topic_share_weighted
FROM per_label""",
        "tile_06": f"WITH {TOPIC_TERMS} SELECT topic_id, label, terms FROM topic_terms",
        "tile_07": f"""WITH {BREAKDOWN} SELECT topic, created_date, round(avg(net_sentiment), 9) AS net_sentiment
FROM breakdown WHERE created_date >= {AS_OF} - 90 GROUP BY topic, created_date""",
        "tile_08": f"""WITH {BREAKDOWN}
SELECT channel, CAST(sum(positive) AS BIGINT) AS positive, CAST(sum(neutral) AS BIGINT) AS neutral,
       CAST(sum(negative) AS BIGINT) AS negative
FROM breakdown GROUP BY channel ORDER BY sum(total) DESC, channel LIMIT 20""",
        "tile_09": f"""WITH {ENGAGEMENT_SUMMARY}
SELECT topic, CAST(sum(predicted_high) AS BIGINT) AS predicted_high_events,
       CAST(sum(scored_events) AS BIGINT) AS scored_events,
       round(CAST(sum(predicted_high) AS DOUBLE) / sum(scored_events), 4) AS high_engagement_rate
FROM engagement_summary GROUP BY topic""",
        "tile_10": f"""WITH {ENGAGEMENT_SUMMARY}
SELECT channel, avg_engagement_proba, avg_actual_score AS avg_score, scored_events
FROM engagement_summary WHERE scored_events >= 5
ORDER BY avg_engagement_proba DESC, topic, channel, created_date LIMIT 500""",
        "dq_report": f"WITH {TIMED}" + "\nUNION ALL".join(_dq(False)),
        "dq_silver_gate": f"WITH {SILVER}{_GATE}",
        "dq_quarantine": f"""WITH {TIMED},
tagged AS (
  SELECT event_id, score, concat_ws('; ',
    CASE WHEN event_id IS NULL OR channel_nsfw IS NULL THEN 'not_null(event_id, channel_nsfw)' END,
    CASE WHEN score < 0 OR score > 300 THEN 'in_range(score, 0, 300)' END,
    CASE WHEN event_type <> 'post' THEN 'accepted_values(event_type)' END) AS failed_rules
  FROM timed
)
SELECT * FROM tagged WHERE failed_rules <> ''""",
        "profile_rows": f"WITH {TIMED} SELECT count(*) AS events FROM timed",
        "profile_mix": f"""WITH {TIMED} SELECT topic, event_type, count(*) AS events, avg(score) AS avg_score
FROM timed GROUP BY topic, event_type""",
        "profile_nulls": f"WITH {SILVER} SELECT {_NULLS} FROM silver",
        "profile_score_pcts": f"""WITH {TIMED}
SELECT {_pct("score", [0.01, 0.25, 0.5, 0.75, 0.9, 0.99])}, min(score) AS min_score,
       max(score) AS max_score, avg(score) AS mean_score FROM timed""",
        "profile_word_pcts": f"""WITH {SILVER}
SELECT {_pct("word_count", [0.5, 0.9, 0.99])}, avg(word_count) AS mean_words,
       max(word_count) AS max_words FROM silver""",
        "profile_daily": f"WITH {TIMED} SELECT created_date, count(*) AS events FROM timed GROUP BY created_date",
        "profile_top": f"""WITH {TIMED} SELECT topic, channel, count(*) AS events, avg(score) AS avg_score
FROM timed GROUP BY topic, channel ORDER BY events DESC, topic, channel LIMIT 25""",
        "weak_sentiment": f"""WITH {SENTIMENT}
SELECT topic, event_id, sentiment_source, score, sentiment_label FROM post_sentiment""",
        "derived_flags": f"WITH {_FLAGGED} SELECT topic, event_id, has_url, is_question, is_post FROM flagged",
        "engagement_label": f"WITH {ENGAGEMENT} SELECT topic, event_id, score, score_threshold, label FROM labelled",
        "topic_argmax": f"WITH {POST_TOPICS} SELECT topic, event_id, dominant_topic, topic_confidence FROM post_topics",
        "tokens_docfreq": f"""WITH words AS (SELECT unnest({_TOKENS}) AS token FROM documents)
SELECT token, count(*) AS doc_freq FROM words GROUP BY token""",
        "tfidf_vocabulary": f"""WITH words AS (SELECT unnest({_TOKENS}) AS token FROM documents),
kept AS (SELECT token, count(*) AS doc_freq FROM words WHERE token NOT IN ('{_STOPPED}') GROUP BY token)
SELECT token, doc_freq,
       round(ln(((SELECT count(*) FROM documents) + 1.0::DOUBLE) / (doc_freq + 1.0::DOUBLE)), 9) AS idf
FROM kept WHERE doc_freq >= 5""",
        "class_metrics": f"""WITH {SENTIMENT},
judged AS (
  SELECT sentiment_label AS label, CASE WHEN score > 20 THEN 'positive' WHEN score < 0 THEN 'negative'
         ELSE 'neutral' END AS prediction FROM post_sentiment
),
classes AS (
  SELECT c.label, count(*) FILTER (j.label = c.label) AS has, count(*) FILTER (j.prediction = c.label) AS given,
         count(*) FILTER (j.label = c.label AND j.prediction = c.label) AS hit
  FROM (SELECT unnest(['positive', 'neutral', 'negative']) AS label) c CROSS JOIN judged j GROUP BY c.label
)
SELECT round(sum(2.0::DOUBLE * hit / (has + given) * has) / sum(has), 9) AS f1,
       round(CAST(sum(hit) AS DOUBLE) / sum(has), 9) AS accuracy FROM classes""",
        "ranking_metrics": f"""WITH {ENGAGEMENT},
judged AS (SELECT l.label, s.text_length AS x FROM labelled l JOIN silver s USING (topic, event_id)),
ranked AS (SELECT label, rank() OVER (ORDER BY x) + (count(*) OVER (PARTITION BY x) - 1) / 2.0::DOUBLE AS r FROM judged)
SELECT round((sum(r) FILTER (label = 1) - count(*) FILTER (label = 1) * (count(*) FILTER (label = 1) + 1) / 2.0::DOUBLE)
  / (count(*) FILTER (label = 1) * count(*) FILTER (label = 0)), 9) AS area_under_roc FROM ranked""",
        "split_rows": f"""WITH {SILVER}
SELECT topic, event_id, {_bucket(100, 42)} < 80 AS learns, {_bucket(3, 43)} AS fold FROM silver""",
        "vocabulary": f"""WITH words AS (SELECT rowid AS doc, unnest({_ALL_TOKENS}) AS token FROM
  (SELECT text, row_number() OVER () AS rowid FROM documents))
SELECT token, count(DISTINCT doc) AS doc_freq, count(*) AS total FROM words
WHERE token NOT IN ('{_STOPPED}') GROUP BY token HAVING count(DISTINCT doc) >= 5""",
        "term_vectors": f"""WITH {SILVER},
words AS (SELECT topic, event_id, unnest({_ALL_TOKENS}) AS token FROM silver),
kept AS (SELECT * FROM words WHERE token NOT IN ('{_STOPPED}')),
known AS (
  SELECT token FROM (SELECT token, count(*) AS n, count(DISTINCT (topic, event_id)) AS d FROM kept GROUP BY token)
  WHERE d >= 5 ORDER BY n DESC, token LIMIT 20000
),
counts AS (
  SELECT topic, event_id, count(DISTINCT token) AS d, count(*) AS n FROM kept
  WHERE token IN (SELECT token FROM known) GROUP BY topic, event_id
)
SELECT topic, event_id, CAST(coalesce(d, 0) AS INTEGER) AS n_distinct, coalesce(n, 0) AS n_words
FROM silver LEFT JOIN counts USING (topic, event_id)""",
        "scaled_features": f"""WITH {_FLAGGED}, s AS (SELECT {_MOMENTS} FROM flagged)
SELECT f.topic, f.event_id, {_SCALED} FROM flagged f CROSS JOIN s""",
        "job_silver": f"WITH {LAKE} SELECT * FROM silver",
        "job_audit": f"""WITH {LAKE},
landed AS (SELECT id FROM raw_posts UNION ALL SELECT NULL FROM raw_posts WHERE channel_nsfw){_AUDITED}""",
        "job_quarantine": f"""WITH {RAW_POSTS}
SELECT 'posts' AS kind, 'docs' AS topic, 'b1' AS batch_id, 'not_null(id)' AS failed_rules, permalink,
       selftext, created_utc FROM raw_posts WHERE channel_nsfw""",
        "job_gold": f"WITH {LAKE},{daily('silver')} SELECT * FROM daily",
        "job_gold_summary": f"WITH {LAKE},{summary('silver')} SELECT * FROM summary",
        "job_gold_hourly": f"""WITH {LAKE}
SELECT topic, created_dow, created_hour, count(*) AS event_count, avg(score) AS avg_score
FROM silver GROUP BY topic, created_dow, created_hour""",
        "job_gold_batches": f"""WITH silver AS ({UPSERT}),{summary('silver')} SELECT * FROM summary""",
    }
    # The same results by other ways.
    for name, same in {
        "upsert_named": "upsert",
        "sql_volume_trend": "tile_02",
        "sql_activity_heatmap": "tile_04",
        "sql_sentiment_trend": "tile_07",
        "sql_sentiment_mix": "tile_08",
    }.items():
        sql[name] = sql[same]
    for name, rule in zip(_DQ_NAMES, _dq(True), strict=True):
        sql[name] = f"WITH {TIMED}{rule}"
    return sql
