"""Sources: the driver's Parquet tables and JSON Lines chat corpora."""

from tessera.sources.jsonl import scan_chat, scan_chat_lines, scan_manifest
from tessera.sources.tables import TABLES, table

__all__ = ["TABLES", "scan_chat", "scan_chat_lines", "scan_manifest", "table"]
