from retain.sources.bundle import (
    INGEST_ORDER, Bundle, load_all, nullify_tokens, parse_date, read_csv, read_parquet,
    require_columns, write_table,
)

__all__ = [
    "INGEST_ORDER", "Bundle", "load_all", "nullify_tokens", "parse_date", "read_csv",
    "read_parquet", "require_columns", "write_table",
]
