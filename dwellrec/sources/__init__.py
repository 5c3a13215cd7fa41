from dwellrec.sources.interactions import (  # noqa: F401
    clean,
    dropped_counts,
    from_tables,
    read_table,
    read_tsv,
    shift_ratings,
    table,
    typed,
)
from dwellrec.sources.sinks import write_parquet, write_text  # noqa: F401
