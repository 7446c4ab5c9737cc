from reelstats.functions.columns import (  # noqa: F401
    GENRE_DISPLAY_SEPARATOR,
    GENRE_SPLIT_REGEX,
    TITLE_YEAR_PATTERN,
    UNKNOWN_TITLE,
    activity_tier,
    date_parts,
    genre_array,
    genre_count,
    genre_display,
    is_missing,
    json_value,
    present,
    rating_bin,
    round_half_up,
    title_year,
)
