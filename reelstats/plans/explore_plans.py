"""Exploration queries (title years, genres, top-k movies, distributions, tiers)."""

from __future__ import annotations

from reelstats.operators import explore, profile
from reelstats.plans import inputs
from reelstats.plans.oracle import YEAR_SQL, round2, with_fixtures
from reelstats.plans.registry import register

TITLE_YEAR = f"SELECT movieId, title, {YEAR_SQL} AS year FROM movies"


@register("movie_title_year", with_fixtures(TITLE_YEAR))
def movie_title_year(spark, sf_dir):
    return explore.movie_title_year(inputs.movies(spark, sf_dir))


@register(
    "movies_per_year",
    with_fixtures(
        f"SELECT year, COUNT(*) AS nb_films FROM ({TITLE_YEAR}) t WHERE year IS NOT NULL GROUP BY year"
    ),
)
def movies_per_year(spark, sf_dir):
    return explore.movies_per_year(inputs.movies(spark, sf_dir))


@register(
    "movie_year_histogram",
    with_fixtures(
        f"""WITH y AS ({TITLE_YEAR}),
b AS (SELECT MIN(year) AS lo, MAX(year) AS hi FROM y),
c AS (SELECT CAST(LEAST(FLOOR((year - lo) / ((hi - lo) / 30.0)), 29) AS INTEGER) AS bin,
             COUNT(*) AS n
      FROM y, b WHERE year IS NOT NULL GROUP BY 1),
e AS (SELECT CAST(range AS INTEGER) AS bin,
             lo + CAST((hi - lo) * range AS DOUBLE) / 30.0 AS bin_start,
             lo + CAST((hi - lo) * (range + 1) AS DOUBLE) / 30.0 AS bin_end
      FROM range(30), b)
SELECT e.bin, e.bin_start, e.bin_end, CAST(COALESCE(c.n, 0) AS BIGINT) AS n
FROM e LEFT JOIN c ON e.bin = c.bin"""
    ),
)
def movie_year_histogram(spark, sf_dir):
    return explore.year_histogram(inputs.movies(spark, sf_dir), bins=30)


@register(
    "genre_counts",
    with_fixtures(
        "SELECT genre, COUNT(*) AS count FROM "
        "(SELECT UNNEST(string_split(genres, '|')) AS genre FROM movies) g GROUP BY genre"
    ),
)
def genre_counts(spark, sf_dir):
    return explore.genre_counts(inputs.movies(spark, sf_dir))


def _distinct_sql(table: str, col: str) -> str:
    return with_fixtures(f"SELECT COUNT(*) AS n_distinct FROM (SELECT DISTINCT {col} FROM {table}) d")


@register("distinct_movies", _distinct_sql("movies", "movieId"))
def distinct_movies(spark, sf_dir):
    return profile.distinct_count(inputs.movies(spark, sf_dir), "movieId")


@register("distinct_rated_movies", _distinct_sql("ratings", "movieId"))
def distinct_rated_movies(spark, sf_dir):
    return profile.distinct_count(inputs.ratings(spark, sf_dir), "movieId")


@register("distinct_users", _distinct_sql("ratings", "userId"))
def distinct_users(spark, sf_dir):
    return profile.distinct_count(inputs.ratings(spark, sf_dir), "userId")


JOINED = "FROM ratings r JOIN movies m ON r.movieId = m.movieId"


@register(
    "most_rated_movies",
    with_fixtures(
        f"SELECT r.movieId, m.title, m.genres, COUNT(*) AS nb_notes {JOINED} "
        "GROUP BY r.movieId, m.title, m.genres "
        "ORDER BY nb_notes DESC, movieId, title NULLS FIRST, genres NULLS FIRST LIMIT 10"
    ),
)
def most_rated_movies(spark, sf_dir):
    return explore.most_rated_movies(inputs.ratings(spark, sf_dir), inputs.movies(spark, sf_dir))


@register(
    "most_rated_movies_avg_rounded",
    with_fixtures(
        f"SELECT r.movieId, m.title, COUNT(*) AS nb_notes, {round2('AVG(r.rating)')} AS note_moyenne "
        f"{JOINED} GROUP BY r.movieId, m.title "
        "ORDER BY nb_notes DESC, movieId, title NULLS FIRST LIMIT 10"
    ),
)
def most_rated_movies_avg_rounded(spark, sf_dir):
    return explore.most_rated_movies_avg_rounded(
        inputs.ratings(spark, sf_dir), inputs.movies(spark, sf_dir)
    )


@register(
    "most_rated_movies_avg",
    with_fixtures(
        f"SELECT r.movieId, m.title, m.genres, COUNT(*) AS nb_notes, AVG(r.rating) AS moyenne_notes "
        f"{JOINED} GROUP BY r.movieId, m.title, m.genres "
        "ORDER BY nb_notes DESC, movieId, title NULLS FIRST, genres NULLS FIRST LIMIT 10"
    ),
)
def most_rated_movies_avg(spark, sf_dir):
    return explore.most_rated_movies_avg(inputs.ratings(spark, sf_dir), inputs.movies(spark, sf_dir))


@register(
    "best_rated_movies",
    with_fixtures(
        f"SELECT * FROM (SELECT r.movieId, m.title, COUNT(*) AS nb_notes, "
        f"{round2('AVG(r.rating)')} AS moyenne_note {JOINED} GROUP BY r.movieId, m.title) s "
        f"WHERE nb_notes >= {inputs.QUERY_MIN_VOTES} "
        "ORDER BY moyenne_note DESC NULLS LAST, nb_notes DESC, movieId, title NULLS FIRST LIMIT 10"
    ),
)
def best_rated_movies(spark, sf_dir):
    return explore.best_rated_movies(
        inputs.ratings(spark, sf_dir), inputs.movies(spark, sf_dir), min_votes=inputs.QUERY_MIN_VOTES
    )


@register(
    "rating_distribution",
    with_fixtures("SELECT rating, COUNT(*) AS count FROM ratings GROUP BY rating"),
)
def rating_distribution(spark, sf_dir):
    return explore.rating_distribution(inputs.ratings(spark, sf_dir))


@register(
    "movies_with_extreme_rating",
    with_fixtures(
        "SELECT (SELECT COUNT(*) FROM (SELECT DISTINCT movieId FROM ratings WHERE rating = 0.5e0) a) "
        "AS n_movies_low, "
        "(SELECT COUNT(*) FROM (SELECT DISTINCT movieId FROM ratings WHERE rating = 5e0) b) "
        "AS n_movies_high"
    ),
)
def movies_with_extreme_rating(spark, sf_dir):
    return explore.movies_with_extreme_rating(inputs.ratings(spark, sf_dir))


def _tiers_sql(width: int, max_ratings: int | None) -> str:
    having = f"WHERE nb_notes <= {max_ratings}" if max_ratings is not None else ""
    return with_fixtures(
        f"SELECT CAST(FLOOR(nb_notes / {width}) * {width} AS BIGINT) AS palier, COUNT(*) AS count "
        f"FROM (SELECT userId, COUNT(rating) AS nb_notes FROM ratings GROUP BY userId) u {having} "
        "GROUP BY 1"
    )


@register("user_activity_tiers_100", _tiers_sql(100, None))
def user_activity_tiers_100(spark, sf_dir):
    return explore.user_activity_tiers(inputs.ratings(spark, sf_dir), width=100)


@register("user_activity_tiers_20", _tiers_sql(20, 2000))
def user_activity_tiers_20(spark, sf_dir):
    return explore.user_activity_tiers(inputs.ratings(spark, sf_dir), width=20, max_ratings=2000)


@register(
    "ratings_per_year",
    with_fixtures(
        "SELECT CAST(YEAR(timestamp) AS INTEGER) AS year, COUNT(*) AS nb_notes FROM ratings GROUP BY 1"
    ),
)
def ratings_per_year(spark, sf_dir):
    return explore.ratings_per_year(inputs.ratings(spark, sf_dir))
