from freightlake.sources.tables import (
    file_attributes,
    read_table,
    shared_folder,
    stored_once,
    write_table,
)

__all__ = [
    "file_attributes",
    "read_table",
    "shared_folder",
    "stored_once",
    "write_table",
]
