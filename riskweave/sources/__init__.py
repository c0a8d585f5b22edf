"""Readers, writers, file schemas and the load audit."""
from .audit import audited_write, reconcile_counts  # noqa: F401
from .readers import read_csv, read_gzip_csv, read_json_messages, read_model_metadata, read_table  # noqa: F401
from .writers import replace_partitions, write_table  # noqa: F401
