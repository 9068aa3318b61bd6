"""Structured Streaming forms of the manifest and of the content-hash dedup."""

from tessera.streaming.dedup import read_survivors, run_dedup_stream
from tessera.streaming.files import changes, look, read_file_manifest, run_file_stream
from tessera.streaming.manifest import (parquet_stream, read_snapshot, run_manifest_stream,
                                        table_stream)

__all__ = ["changes", "look", "parquet_stream", "read_file_manifest", "read_snapshot", "read_survivors",
           "run_dedup_stream", "run_file_stream", "run_manifest_stream", "table_stream"]
