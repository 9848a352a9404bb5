from .fixtures import (
    EVENTS_PLAY,
    SALES_PLAY,
    adapt_events,
    embedding_factors,
    events_interactions,
    sales_interactions,
    sales_item_names,
    table,
)
from .interactions import (
    COLUMNS,
    INTERACTIONS,
    as_interactions,
    convert_to_parquet,
    preview,
    read_interactions,
    write_interactions_csv,
)
from .runs import RUN_COLUMNS, RUNS, append_runs, read_runs, runs_frame

__all__ = [
    "COLUMNS", "EVENTS_PLAY", "INTERACTIONS", "RUNS", "RUN_COLUMNS", "SALES_PLAY",
    "adapt_events", "append_runs", "embedding_factors", "as_interactions", "convert_to_parquet", "events_interactions", "preview", "read_interactions",
    "read_runs", "runs_frame", "sales_interactions", "sales_item_names", "table",
    "write_interactions_csv",
]
