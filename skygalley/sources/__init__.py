from skygalley.sources.readers import (
    read_jdbc_table,
    read_mart_since,
    read_parquet,
    read_raw,
    read_seed,
)
from skygalley.sources.schemas import RAW_DATASETS, SEEDS, RawDataset
from skygalley.sources.sinks import (
    append_or_replace,
    insert_missing,
    overwrite,
    upsert,
    write_with_sample,
)

__all__ = [
    "RAW_DATASETS",
    "SEEDS",
    "RawDataset",
    "append_or_replace",
    "insert_missing",
    "overwrite",
    "read_jdbc_table",
    "read_mart_since",
    "read_parquet",
    "read_raw",
    "read_seed",
    "upsert",
    "write_with_sample",
]
