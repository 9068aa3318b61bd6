"""Sinks: partitioned chat corpus and manifest."""

from tessera.sinks.jsonl import manifest_line, write_corpus, write_manifest

__all__ = ["manifest_line", "write_corpus", "write_manifest"]
