from reelstats.sources import fixtures, tables  # noqa: F401
from reelstats.sources.files import (  # noqa: F401
    DataLoadError,
    find,
    find_in,
    read_csv,
    read_documents,
    read_partitions,
    register_view,
    safe_load,
    sample_capped,
    sample_id_range,
)
from reelstats.sources.tables import read_table  # noqa: F401
