"""Reading tables, files, topics and small local data."""

from millrace.sources.files import (
    checked_files,
    damaged_files,
    enforce_schema,
    load_csv_folder,
    read_path,
    scan_partitioned,
    write_partitioned,
    write_path,
)
from millrace.sources.frames import frame_from_columns
from millrace.sources.messages import message_stream, parse_payload
from millrace.sources.tables import (
    append_table,
    create_namespace,
    import_parquet,
    layer_name,
    read_layer,
    read_model,
    replace_table,
)

__all__ = [
    "append_table",
    "checked_files",
    "create_namespace",
    "damaged_files",
    "enforce_schema",
    "frame_from_columns",
    "import_parquet",
    "layer_name",
    "load_csv_folder",
    "message_stream",
    "parse_payload",
    "read_layer",
    "read_model",
    "read_path",
    "replace_table",
    "scan_partitioned",
    "write_partitioned",
    "write_path",
]
