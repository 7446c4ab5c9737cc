"""DuckDB-side building blocks for the oracle SQL.

The fixture views are written with the same expression text the Spark side
uses (reelstats.sources.fixtures), so both engines read identical inputs.
"""

from __future__ import annotations

from reelstats.sources.fixtures import GENRES_SQL, RATING_SQL, TITLE_SQL

RATINGS_CTE = (
    "ratings AS (SELECT CAST(o.o_custkey AS INT) AS userId, CAST(l.l_partkey AS INT) AS movieId, "
    f"{RATING_SQL} AS rating, l.l_shipdate AS timestamp "
    "FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey)"
)

MOVIES_CTE = (
    "movies_base AS (SELECT CAST(p_partkey AS INT) AS movieId, "
    f"{TITLE_SQL} AS title, {GENRES_SQL} AS genres FROM part), "
    "movies AS (SELECT * FROM movies_base UNION ALL SELECT * FROM movies_base WHERE movieId % 53 = 0)"
)

# The decoded form of the rating messages (from_json with the event schema,
# session time zone UTC).
DECODED_CTE = (
    "decoded AS (SELECT event_id, "
    "CASE WHEN event_type <> 'error' THEN CAST(user_id AS INT) END AS userId, "
    "CASE WHEN event_type <> 'error' THEN CAST(event_id % 200 AS INT) END AS movieId, "
    "CASE WHEN event_type <> 'error' THEN "
    "CAST(0.5e0 + (CAST(FLOOR(value) AS BIGINT) % 10) / 2e0 AS FLOAT) END AS rating, "
    "CASE WHEN event_type <> 'error' THEN date_trunc('second', ts) END AS timestamp "
    "FROM events)"
)

YEAR_SQL = r"TRY_CAST(regexp_extract(title, '\((\d{4})\)', 1) AS INTEGER)"
GENRE_COUNT_SQL = "CAST(len(string_split(genres, '|')) AS INTEGER)"


def round2(expr: str) -> str:
    """Spark's round(x, 2) on a double: HALF_UP on the shortest decimal form."""
    return f"CAST(ROUND(CAST({expr} AS DECIMAL(38, 12)), 2) AS DOUBLE)"


def with_fixtures(body: str, decoded: bool = False) -> str:
    ctes = [RATINGS_CTE, MOVIES_CTE] + ([DECODED_CTE] if decoded else [])
    body = body.strip()
    if body[:4].upper() == "WITH":
        return "WITH " + ", ".join(ctes) + ", " + body[4:].lstrip()
    return "WITH " + ", ".join(ctes) + " " + body


# Clean-path views shared by many oracles, with the FIXTURES.md semantics.
CLEAN_RATINGS = """
cr AS (
  SELECT userId, movieId, rating, timestamp,
         CAST(timestamp AS DATE) AS rating_date, CAST(YEAR(timestamp) AS INT) AS rating_year,
         CAST(MONTH(timestamp) AS INT) AS rating_month, CAST(DAY(timestamp) AS INT) AS rating_day
  FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY userId, movieId
                                     ORDER BY timestamp DESC, rating DESC) AS rn
        FROM ratings
        WHERE rating IS NOT NULL AND NOT isnan(rating) AND userId IS NOT NULL
          AND movieId IS NOT NULL AND timestamp IS NOT NULL) t
  WHERE rn = 1 AND rating BETWEEN 0.5e0 AND 5e0)"""

CLEAN_MOVIES = f"""
cm AS (
  SELECT movieId, title, genres, year
  FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY movieId ORDER BY title, genres, year) AS rn
        FROM (SELECT movieId, title, genres, {YEAR_SQL} AS year FROM movies) m
        WHERE movieId IS NOT NULL AND title IS NOT NULL AND genres IS NOT NULL
          AND year IS NOT NULL) t
  WHERE rn = 1)"""

MOVIE_FEATURES = f"""
mf AS (SELECT movieId, title, genres, {YEAR_SQL} AS year, {GENRE_COUNT_SQL} AS genre_count FROM cm)"""


def enriched_ctes(min_movie: int, min_user: int) -> str:
    """CTEs up to `en`, the 18-column enriched ratings."""
    return f"""WITH {CLEAN_RATINGS.strip()}, {CLEAN_MOVIES.strip()}, {MOVIE_FEATURES.strip()},
mc AS (SELECT movieId, COUNT(rating) AS rating_count FROM cr GROUP BY movieId),
ms AS (SELECT mf.*, mc.rating_count FROM mf JOIN mc ON mf.movieId = mc.movieId
       WHERE rating_count >= {min_movie}),
au AS (SELECT *, COUNT(rating) OVER (PARTITION BY userId) AS user_rating_count FROM cr),
ar AS (SELECT * FROM au WHERE user_rating_count >= {min_user}),
st AS (SELECT movieId, AVG(rating) AS avg_rating, COUNT(rating) AS num_ratings FROM ar GROUP BY movieId),
us AS (SELECT userId, COUNT(rating) AS user_total_ratings, AVG(rating) AS user_avg_rating
       FROM ar GROUP BY userId),
en AS (
  SELECT ar.userId, ar.movieId, ar.rating, ar.timestamp, ar.rating_date, ar.rating_year,
         ar.rating_month, ar.rating_day, ar.user_rating_count, ms.title, ms.genres, ms.year,
         ms.genre_count, ms.rating_count, st.avg_rating, st.num_ratings,
         us.user_total_ratings, us.user_avg_rating
  FROM ar LEFT JOIN ms ON ar.movieId = ms.movieId LEFT JOIN st ON ar.movieId = st.movieId
          LEFT JOIN us ON ar.userId = us.userId)"""
