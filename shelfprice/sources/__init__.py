from shelfprice.sources.files import (
    read_raw_csv,
    read_seed,
    read_table,
    write_bucketed,
    write_json,
    write_table,
)
from shelfprice.sources.seed import product_mapping
from shelfprice.sources.staging import shared_dir, write_layer, write_through

__all__ = [
    "product_mapping",
    "read_raw_csv",
    "read_seed",
    "read_table",
    "shared_dir",
    "write_bucketed",
    "write_json",
    "write_layer",
    "write_table",
    "write_through",
]
