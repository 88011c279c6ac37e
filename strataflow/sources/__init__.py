from strataflow.sources.batch import read_layer, read_since, read_table
from strataflow.sources.jdbc import read_database
from strataflow.sources.schema import SchemaConflict, resolve_schema
from strataflow.sources.stream import stream_files, stream_table

__all__ = [
    "read_database", "read_layer", "read_since", "read_table", "resolve_schema", "SchemaConflict",
    "stream_files", "stream_table",
]
