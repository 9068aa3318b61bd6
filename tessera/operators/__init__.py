"""DataFrame -> DataFrame operators."""

from tessera.operators import chat, dedup, manifest, report, subset, synth

__all__ = ["chat", "dedup", "manifest", "report", "subset", "synth"]
