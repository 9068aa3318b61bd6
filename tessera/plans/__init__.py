"""Named queries over the driver's tables, and their DuckDB oracle SQL.

Every query reads whole tables (or data Spark derives from them) and takes
``(spark, sf_dir)``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tessera.plans import chats, corpus, curation, files, streams, synthesis, training
from tessera.plans.oracle import oracle_sql

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    # manifest and reports over documents grouped by (lang, source)
    "corpus_manifest": corpus.corpus_manifest,
    "ranked_manifest": corpus.ranked_manifest,
    "corpus_totals": corpus.corpus_totals,
    "skill_rollup": corpus.skill_rollup,
    "fixed_order_report": corpus.fixed_order_report,
    "coverage_table": corpus.coverage_table,
    "subtopic_lists": corpus.subtopic_lists,
    "entry_averages": corpus.entry_averages,
    # subsets and dedup
    "subset_skill": corpus.subset_skill,
    "manifest_subset": corpus.manifest_subset,
    "dedup_first_wins": corpus.dedup_first_wins,
    "dedup_corpus": corpus.dedup_corpus,
    "cap_per_group": corpus.cap_per_group,
    # chat records from conversations
    "chat_assemble": chats.chat_assemble,
    "chat_flatten": chats.chat_flatten,
    "chat_stats": chats.chat_stats,
    "chat_manifest": chats.chat_manifest,
    # the generator over customer / nation / orders
    "synth_grid": synthesis.synth_grid,
    "synth_first_wins": synthesis.synth_first_wins,
    "synth_manifest": synthesis.synth_manifest,
    "synth_walk": synthesis.synth_walk,
    "synth_walk_manifest": synthesis.synth_walk_manifest,
    "synth_entries": synthesis.synth_entries,
    "synth_corpus_files": synthesis.synth_corpus_files,
    "section_audit": synthesis.section_audit,
    "synth_failures": synthesis.synth_failures,
    "generation_result": synthesis.generation_result,
    "diversity_audit": training.diversity_audit,
    "diversity_missing": training.diversity_missing,
    "hierarchy_lists": synthesis.hierarchy_lists,
    # planning and curation
    "manifest_round_trip": curation.manifest_round_trip,
    "token_budget_plan": curation.token_budget_plan,
    "manifest_reconcile": curation.manifest_reconcile,
    "chat_validate": curation.chat_validate,
    "hash_split": curation.hash_split,
    "release_dedup": curation.release_dedup,
    "budget_load": files.budget_load,
    # training: packing, sampling, shards, length profiles
    "pack_sequences": training.pack_sequences,
    "mixture_sample": training.mixture_sample,
    "byte_shards": training.byte_shards,
    "length_profile": training.length_profile,
    "length_bins": training.length_bins,
    "length_sketch": training.length_sketch,
    "near_copy_members": training.near_copy_members,
    "near_copy_pairs": training.near_copy_pairs,
    # files: streams and the JSON Lines round trip
    "stream_manifest": streams.stream_manifest,
    "stream_dedup": streams.stream_dedup,
    "stream_dedup_watermark": streams.stream_dedup_watermark,
    "stream_file_manifest": streams.stream_file_manifest,
    "jsonl_file_manifest": streams.jsonl_file_manifest,
    # the flat layout and its audit
    "flat_corpus_manifest": files.flat_corpus_manifest,
    "line_audit": files.line_audit,
    "odd_files": files.odd_files,
}

__all__ = ["QUERIES", "oracle_sql"]
