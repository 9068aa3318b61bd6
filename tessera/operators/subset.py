"""Subsets of a corpus: by skill, or by groups chosen from the manifest.

Both are plain predicates/semi-joins on the group columns, so on a Hive
layout they become partition filters (static or dynamic pruning) and only
the chosen folders are listed and read.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.model import GROUP_COLUMNS


def by_skill(corpus: DataFrame, skills: Iterable[str], column: str = "skill") -> DataFrame:
    return corpus.where(F.col(column).isin(list(skills)))


def by_manifest(corpus: DataFrame, chosen: DataFrame) -> DataFrame:
    """Rows of the groups present in ``chosen`` (a filtered manifest).

    A left-semi join on (skill, subtopic): the manifest side is one row per
    file, and on a partitioned corpus Spark prunes partitions at run time.
    """
    keys = chosen.select(*GROUP_COLUMNS).distinct()
    return corpus.join(keys, list(GROUP_COLUMNS), "left_semi")
