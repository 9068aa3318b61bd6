"""Conversation prefix trie by van Emde Boas recursion.

Sequences of turns are cut at half their depth, again and again. A cut prefix
is named by the name of the place its half starts at and a digest of the half,
so equal prefixes get equal names wherever they are named, and the upper trie
and the lower forests of a cut, and all cuts of one size, are named in the same
round. Digests of halves come from the smallest up. Names group conversations
to nodes. Totals go the other way: where two halves meet, the totals of the
lower trees are summed at the node they hang on and grafted onto it and onto
its ancestors in the upper half, from the smallest halves up.

Each round is a join or aggregation on (conversation, place), so a
conversation of any length is spread over tasks and takes as many rounds as
its length has binary digits; a prefix that a third of all conversations share
is one row for each task before it is summed. Turns are numbered by ranges,
without a window over a conversation. Only scalars reach the driver.

Names are 128 bits of two seeded hashes. A node is known by the smallest
conversation that starts with it and its depth.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window, functions as F

from tessera.llm.util import stored

#: Conversations share the first turns of the one whose id is the multiple of
#: it below; of these they take fewer than ``HEADS``.
FAMILY, HEADS = 5, 9
#: The name of the root.
ROOT = (0, 0)
EMPTY_SHA256 = hashlib.sha256(b"").hexdigest()


def heads(conv: Column) -> Column:
    """How many of the family's first turns a conversation starts with."""
    return F.crc32(conv.cast("string").cast("binary")) % HEADS


def _name(*parts: Column) -> list[Column]:
    return [F.xxhash64(F.lit(seed), *parts).alias(c) for seed, c in ((1, "a"), (2, "b"))]


def numbered(turns: DataFrame) -> DataFrame:
    """``turns(conv, turn, a, b, size)`` with ``pos``, from 0 in the order of
    turns (null first; of one turn by the digests), in place of ``turn``.

    Ranges are sorted and counted by themselves; conversations that go on in
    another range, two for each range at most, take what stands before from a
    broadcast. Equal turns are spread by the task that read them."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, last, seen = TaskContext.get().partitionId(), None, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            conv = batch.column(0).to_numpy()
            at = np.arange(len(conv))
            starts = np.concatenate([[conv[0] != last], conv[1:] != conv[:-1]])
            since = np.maximum.accumulate(np.where(starts, at, -1))
            local = np.where(since < 0, at + seen, at - since)
            last, seen = conv[-1], int(local[-1]) + 1
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(np.full(len(conv), part, np.int32)), pa.array(local.astype(np.int64)),
                 *[batch.column(c) for c in (1, 2, 3)]], names=["conv", "part", "local", "a", "b", "size"])

    ranged = turns.withColumn("task", F.spark_partition_id()) \
        .repartitionByRange("conv", "turn", "a", "b", "task").sortWithinPartitions("conv", "turn", "a", "b")
    rows = stored(ranged.select("conv", "a", "b", "size").mapInArrow(
        count, "conv long, part int, local long, a long, b long, size long"), "trie-turns")
    ends = rows.groupBy("part").agg(F.min("conv").alias("lo"), F.max("conv").alias("hi"))
    ends = ends.select(F.explode(F.array("lo", "hi")).alias("conv")).distinct()
    spans = rows.join(F.broadcast(ends), "conv").groupBy("conv", "part").agg(F.count(F.lit(1)).alias("n"))
    before = F.sum("n").over(Window.partitionBy("conv").orderBy("part")) - F.col("n")
    spans = spans.select("conv", "part", before.alias("before")).where("before > 0")
    return rows.join(F.broadcast(spans), ["conv", "part"], "left").select(
        "conv", (F.col("local") + F.coalesce("before", F.lit(0))).alias("pos"), "a", "b", "size")


def rebuilt(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
            text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """The rebuilt conversations ``(conv, total)`` and their turns ``(conv, pos,
    a, b, size)``: the family's first turns, then the conversation's own after
    as many."""
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in (role_col, text_col))
    rows = numbered(turns.where(F.col(conv_col).isNotNull()).select(
        F.col(conv_col).cast("bigint").alias("conv"), F.col(turn_col).alias("turn"), *_name(role, text),
        F.octet_length(text).cast("bigint").alias("size")))
    rows = stored(rows, "trie-numbered")
    family = F.col("conv") - F.col("conv") % FAMILY
    counts = stored(rows.groupBy("conv").agg((F.max("pos") + 1).alias("n")), "trie-counts")
    info = counts.select("conv", "n", family.alias("base"), heads(F.col("conv")).alias("h"))
    bases = counts.where(family == F.col("conv")).select(F.col("conv").alias("base"), F.col("n").alias("base_n"))
    info = info.join(bases, "base", "left").select(
        "conv", "base", "h", F.least("h", F.coalesce("base_n", F.lit(0))).alias("taken"),
        F.greatest(F.col("n") - F.col("h"), F.lit(0)).alias("own"))
    info = stored(info, "trie-convs")
    other = F.col("conv") != family
    less = info.where((F.col("conv") != F.col("base")) & (F.col("taken") < F.col("h"))) \
        .select("conv", (F.col("taken") - F.col("h")).alias("shift"))
    own = rows.where(~other | (F.col("pos") >= heads(F.col("conv")))).join(less, "conv", "left") \
        .select("conv", (F.col("pos") + F.coalesce("shift", F.lit(0))).alias("pos"), "a", "b", "size")
    first = rows.where(~other & (F.col("pos") < HEADS - 1)).withColumnRenamed("conv", "base")
    taken = info.where(F.col("conv") != F.col("base")).select("conv", "base", "h").join(first, "base") \
        .where("pos < h").select("conv", "pos", "a", "b", "size")
    return info.select("conv", (F.col("taken") + F.col("own")).alias("total")), \
        stored(own.unionByName(taken), "trie-rebuilt")


def named(rows: DataFrame, levels: int) -> DataFrame:
    """Rows ``(conv, depth, a, b)``: the name of every prefix of the sequences
    ``rows(conv, pos, a, b)`` of fewer than ``2 ** levels`` turns."""
    digests = [rows.select("conv", F.col("pos").alias("k"), "a", "b")]
    for j in range(1, levels):  # digests of whole runs of 2 ** j turns, from runs of half as many
        left, right = F.col("k") % 2 == 0, F.col("k") % 2 == 1
        halves = [F.max(F.when(side, F.col(c))).alias(f"{name}_{c}") for name, side in (("l", left), ("r", right))
                  for c in ("a", "b")]
        pairs = digests[-1].groupBy("conv", F.expr("k div 2").alias("half")).agg(F.count(F.lit(1)).alias("n"), *halves)
        digests.append(stored(pairs.where("n = 2").select(
            "conv", F.col("half").alias("k"), *_name(*[F.col(c) for c in ("l_a", "l_b", "r_a", "r_b")])), "trie-halves"))
    names: list[DataFrame] = []
    for j in range(levels - 1, -1, -1):  # cuts in the middle of runs of 2 ** (j + 1) turns
        half = digests[j].where("k % 2 = 0").select("conv", (F.col("k") * 2 ** j).alias("start"),
                                                    F.col("a").alias("ha"), F.col("b").alias("hb"))
        depth = (F.col("start") + 2 ** j).alias("depth")
        first = half.where("start = 0").select("conv", depth, *_name(*map(F.lit, ROOT), F.col("ha"), F.col("hb")))
        if names:
            starts = reduce(DataFrame.unionByName, names).withColumnRenamed("depth", "start")
            later = half.where("start > 0").join(starts, ["conv", "start"]).select(
                "conv", depth, *_name(*[F.col(c) for c in ("a", "b", "ha", "hb")]))
            first = first.unionByName(later)
        names.append(stored(first, "trie-names"))
    return reduce(DataFrame.unionByName, names)


def nodes_of(convs: DataFrame, rows: DataFrame, levels: int) -> tuple[DataFrame, DataFrame, int]:
    """The nodes ``(conv, depth, parent, n_convs, n_children, size)``, the stored paths
    ``(conv, depth, node)`` below the root, and the root's conversation."""
    root, n = convs.agg(F.min("conv"), F.count(F.lit(1))).first()
    spark = convs.sparkSession
    paths = None
    if levels:
        names = named(rows, levels)
        # stored, so that the join reads both sides from shuffles of its own and
        # can split the name that very many conversations share
        groups = stored(names.groupBy("a", "b").agg(F.min("conv").alias("node"), F.count(F.lit(1)).alias("n_convs")), "trie-groups")
        paths = stored(names.join(groups, ["a", "b"]).select("conv", "depth", "node", "n_convs"), "trie-paths")
    else:
        paths = spark.createDataFrame([], "conv long, depth long, node long, n_convs long")
    above = paths.select("conv", (F.col("depth") + 1).alias("depth"), F.col("node").alias("up"))
    size = rows.select("conv", (F.col("pos") + 1).alias("depth"), "size")
    nodes = paths.where("conv = node").select("conv", "depth", "n_convs").join(size, ["conv", "depth"]) \
        .join(above, ["conv", "depth"], "left") \
        .select("conv", "depth", F.coalesce("up", F.lit(root)).alias("parent"), "n_convs", "size")
    top = spark.createDataFrame([(root, 0, None, n, 0)], "conv long, depth long, parent long, n_convs long, size long")
    nodes = stored(nodes.unionByName(top), "trie-nodes")
    children = nodes.where("depth > 0").groupBy(F.col("parent").alias("conv"), (F.col("depth") - 1).alias("depth")) \
        .agg(F.count(F.lit(1)).alias("n_children"))
    nodes = nodes.join(children, ["conv", "depth"], "left").fillna({"n_children": 0})
    return stored(nodes, "trie-children"), paths.select("conv", "depth", "node"), root


def grafted(nodes: DataFrame, paths: DataFrame, root: int, levels: int, values: list[str]) -> DataFrame:
    """``nodes`` with the sums of ``values`` over their subtrees in their place."""
    for j in range(levels):  # runs of 2 ** j depths meet
        half = 2 ** j
        lower = nodes.where(F.col("depth") % (2 * half) == half)
        hung = lower.groupBy(F.col("parent").alias("conv"), (F.col("depth") - 1).alias("bottom")) \
            .agg(*[F.sum(v).alias(v) for v in values])
        onto = hung.select("conv", F.explode(F.sequence(F.col("bottom") - (half - 1), "bottom")).alias("depth"),
                           "bottom", *values)
        direct = F.col("depth") == F.col("bottom")
        at = [onto.where(direct).select("conv", "depth", *values)]
        if half > 1:
            upper = onto.where(~direct)
            at.append(upper.where("depth = 0").select(F.lit(root).alias("conv"), "depth", *values))
            at.append(upper.where("depth > 0").join(paths, ["conv", "depth"])
                      .select(F.col("node").alias("conv"), "depth", *values))
        added = reduce(DataFrame.unionByName, at).groupBy("conv", "depth").agg(*[F.sum(v).alias(f"_{v}") for v in values])
        rest = [c for c in nodes.columns if c not in values]
        nodes = stored(nodes.join(added, ["conv", "depth"], "left").select(
            *rest, *[(F.col(v) + F.coalesce(f"_{v}", F.lit(0))).alias(v) for v in values]), "trie-grafted")
    return nodes


def ends_of(members: DataFrame) -> DataFrame:
    """Rows ``(conv, depth, ends)``: the SHA-256 of the ascending members of each
    node of ``members(conv, depth, member)``, comma-joined.

    Ranges of sorted members become pieces of text in many tasks, and only the
    pieces of a node meet, in order, in a hash that holds none of them."""
    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            conv, depth, member = (batch.column(c).to_numpy() for c in range(3))
            new = np.flatnonzero((np.diff(conv) != 0) | (np.diff(depth) != 0)) + 1
            cuts = [0, *new.tolist(), len(conv)] if len(conv) else [0]
            runs = list(zip(cuts[:-1], cuts[1:]))
            yield pa.RecordBatch.from_pydict({
                "conv": pa.array([conv[a] for a, _ in runs], pa.int64()), "depth": pa.array([depth[a] for a, _ in runs], pa.int64()),
                "least": pa.array([member[a] for a, _ in runs], pa.int64()),
                "ids": pa.array([",".join(map(str, member[a:b].tolist())) for a, b in runs], pa.string())})

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, sha, done = None, None, []

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_pydict({"conv": pa.array([d[0] for d in done], pa.int64()),
                                               "depth": pa.array([d[1] for d in done], pa.int64()),
                                               "ends": pa.array([d[2] for d in done], pa.string())})
        for batch in batches:
            for c, d, ids in zip(*[batch.column(i).to_pylist() for i in (0, 1, 3)]):
                if (c, d) != node:
                    if node:
                        done.append((*node, sha.hexdigest()))
                    node, sha = (c, d), hashlib.sha256(ids.encode())
                else:
                    sha.update(b"," + ids.encode())
            yield out()
            done = []
        if node:
            done.append((*node, sha.hexdigest()))
        yield out()

    pieces = members.repartitionByRange("conv", "depth", "member").sortWithinPartitions("conv", "depth", "member") \
        .mapInArrow(join, "conv long, depth long, least long, ids string")
    return pieces.repartition("conv", "depth").sortWithinPartitions("conv", "depth", "least") \
        .mapInArrow(digest, "conv long, depth long, ends string")


def trie(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
         text_col: str = "text") -> DataFrame:
    """One row for each node: ``conv_id, depth, parent_conv_id, n_convs,
    n_children, n_leaves, saved_tokens, ends_sha256``.

    Null roles and texts are empty, null turns come first, turns of one number
    are ordered by the digests of role and text, repeated rows each are a turn;
    rows without a conversation id belong to no conversation and are left out;
    an empty table has no root and gives an empty result; other columns are not
    read. Ids must be whole numbers.
    """
    convs, rows = rebuilt(turns, conv_col, turn_col, role_col, text_col)
    convs = stored(convs, "trie-totals")
    longest = convs.agg(F.max("total")).first()[0]
    if longest is None:
        return convs.sparkSession.createDataFrame([], RESULT)
    levels = int(longest).bit_length()
    nodes, paths, root = nodes_of(convs, rows, levels)
    nodes = nodes.withColumns({"n_leaves": F.when(F.col("n_children") == 0, 1).otherwise(0).cast("bigint"),
                               "saved_tokens": (F.col("n_convs") - 1) * F.col("size")})
    nodes = grafted(nodes, paths, root, levels, ["n_leaves", "saved_tokens"])
    whole = convs.where("total > 0").select("conv", F.col("total").alias("depth")).join(paths, ["conv", "depth"]) \
        .select(F.col("node").alias("conv"), "depth", F.col("conv").alias("member"))
    none = convs.where("total = 0").select(F.lit(root).alias("conv"), F.lit(0).cast("bigint").alias("depth"),
                                           F.col("conv").alias("member"))
    ends = ends_of(whole.unionByName(none))
    return nodes.join(ends, ["conv", "depth"], "left").select(
        F.col("conv").alias("conv_id"), "depth", F.col("parent").alias("parent_conv_id"), "n_convs", "n_children",
        "n_leaves", "saved_tokens", F.coalesce("ends", F.lit(EMPTY_SHA256)).alias("ends_sha256"))


RESULT = ("conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, "
          "saved_tokens long, ends_sha256 string")


def oracle(table: str = "conversations") -> str:
    """The same rows in DuckDB SQL, with every prefix as a list."""
    return f"""
    WITH ids AS (SELECT DISTINCT conv_id AS c FROM {table} WHERE conv_id IS NOT NULL),
    crc AS (SELECT c, xor(list_reduce(list_concat([4294967295::BIGINT], flatten(list_transform(
                string_split(CAST(c AS VARCHAR), ''), lambda s: [ascii(s)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]))),
                lambda acc, o: CASE WHEN o >= 0 THEN xor(acc, o) ELSE xor(acc >> 1, (acc & 1) * 3988292384) END),
                4294967295::BIGINT) % {HEADS} AS h FROM ids),
    t AS (SELECT conv_id AS c, coalesce(role, '') AS r, coalesce(text, '') AS x,
                 row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) - 1 AS p
          FROM {table} WHERE conv_id IS NOT NULL),
    parts AS (SELECT crc.c, 0 AS own, t.p, t.r, t.x FROM crc JOIN t ON t.c = crc.c - crc.c % {FAMILY} AND t.p < h
              UNION ALL SELECT crc.c, 1, t.p, t.r, t.x FROM crc JOIN t ON t.c = crc.c AND t.p >= h),
    seqs AS (SELECT ids.c, coalesce(list({{'r': r, 'x': x}} ORDER BY own, p) FILTER (WHERE own IS NOT NULL), []) AS seq
             FROM ids LEFT JOIN parts USING (c) GROUP BY ids.c),
    prefixes AS (SELECT c, len(seq) AS total, d, list_slice(seq, 1, d) AS pre
                 FROM (SELECT c, seq, unnest(range(len(seq) + 1)) AS d FROM seqs)),
    nodes AS (SELECT pre, d, min(c) AS conv_id, count(*) AS n_convs,
                     coalesce(string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) FILTER (WHERE total = d), '') AS ends
              FROM prefixes GROUP BY pre, d),
    kids AS (SELECT list_slice(pre, 1, d - 1) AS pre, d - 1 AS d, count(*) AS n_children
             FROM nodes WHERE d > 0 GROUP BY 1, 2),
    own AS (SELECT nodes.*, coalesce(n_children, 0) AS n_children,
                   CASE WHEN d = 0 THEN 0 ELSE (n_convs - 1) * strlen(pre[d].x) END AS saved
            FROM nodes LEFT JOIN kids USING (pre, d)),
    subs AS (SELECT list_slice(pre, 1, u) AS pre, u AS d, sum(CASE WHEN n_children = 0 THEN 1 ELSE 0 END) AS n_leaves,
                    sum(saved) AS saved_tokens
             FROM (SELECT *, unnest(range(d + 1)) AS u FROM own) GROUP BY 1, 2)
    SELECT own.conv_id, CAST(own.d AS BIGINT) AS depth, up.conv_id AS parent_conv_id, own.n_convs, own.n_children,
           CAST(n_leaves AS BIGINT) AS n_leaves, CAST(saved_tokens AS BIGINT) AS saved_tokens,
           sha256(own.ends) AS ends_sha256
    FROM own JOIN subs ON subs.d = own.d AND subs.pre = own.pre
    LEFT JOIN nodes up ON up.d = own.d - 1 AND up.pre = list_slice(own.pre, 1, own.d - 1)"""
