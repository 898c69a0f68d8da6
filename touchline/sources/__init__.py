"""Data sources: readers for the domain inputs and the derived test views."""

from touchline.sources.png import write_pngs
from touchline.sources.readers import (
    malformed_metadata,
    read_events,
    read_images,
    read_matches,
    read_metadata,
    read_parquet,
    read_players,
    read_sales_csv,
    read_series,
    read_table,
)

__all__ = [
    "malformed_metadata",
    "read_events",
    "read_images",
    "read_matches",
    "read_metadata",
    "read_parquet",
    "read_players",
    "read_sales_csv",
    "read_series",
    "read_table",
    "write_pngs",
]
