from churnkit.sources.tables import TABLES, load, load_all
from churnkit.sources import fixtures
from churnkit.sources.io import (
    load_csv, read_table, select_features, replace_table, write_predictions,
    write_csv, output_name, union_all,
)

__all__ = [
    "TABLES", "load", "load_all", "fixtures", "load_csv", "read_table",
    "select_features", "replace_table", "write_predictions", "write_csv",
    "output_name", "union_all",
]
