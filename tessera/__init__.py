"""tessera: a PySpark engine for templated chat corpora and their manifests.

Sub-packages: ``functions`` (Column expressions), ``sources`` / ``sinks``
(JSON Lines and Parquet), ``operators`` (synthesis, dedup, manifest,
reports, chat records, subsets), ``streaming`` (incremental manifest and
dedup) and ``plans`` (the named queries over the driver tables).
"""

from tessera.session import checkpoint_root, get_session, scratch_path

__all__ = ["checkpoint_root", "get_session", "scratch_path"]
