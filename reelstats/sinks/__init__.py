from reelstats.sinks.writers import (  # noqa: F401
    as_rating_documents,
    publish_messages,
    to_messages,
    write_csv,
    write_documents,
    write_parquet,
    write_partitioned_parquet,
    write_with_fallback,
)
