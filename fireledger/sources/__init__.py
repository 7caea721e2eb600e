from fireledger.sources.files import malformed_fields, read_csv, split_csv, write_csv
from fireledger.sources.tables import create_tables, overwrite_table, overwrite_tables, read_tables

__all__ = [
    "create_tables",
    "malformed_fields",
    "overwrite_table",
    "overwrite_tables",
    "read_csv",
    "read_tables",
    "split_csv",
    "write_csv",
]
