"""Vector code compression: product quantisation in exact integers, over
Hilbert-sorted flat blocks.

Components become integers and vectors are cut into equal parts. The parts of
each position are sorted along a Hilbert curve and cut into flat blocks, and a
block holds the box and the sum of its vectors beside them. In each round the
box distances of a block give its shortlist of codebook entries: an entry that
is nowhere in the box the nearest is left out. A block with one entry left is
added whole, by its stored sum, and its vectors are not touched; the others
are told apart by a small integer kernel over their shortlist only.

Equal parts of a batch are one vector with a weight before the sort, and ties
on the curve are spread by the task that read them, so one vector that
stands in a third of all rows is a few rows for each task. A round sends the
codebooks out (some hundred vectors) and brings one sum for each of their
components back, added up by Spark. Codes come from one pass over the vectors,
which are not shuffled again: each batch is cut into such blocks in its task.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from tessera.llm.util import cut, stored

PARTS, ENTRIES, ROUNDS, SCALE = 8, 16, 6, 4096
#: Vectors of a block, and bits and axes at most of a place on the curve.
BLOCK, CURVE_BITS, CURVE_AXES = 128, 62, 31
#: Integers below it are told apart in 64 bits; above, in Python's integers.
NARROW = 2 ** 26
#: Label sums up to which they are broadcast; beyond it the join shuffles.
BROADCAST_LABELS = 500_000


def usable(vector: Column) -> Column:
    """Whether a vector is there and all its components are finite."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return vector.isNotNull() & ~F.coalesce(bad, F.lit(False))


def matrix(lists: pa.Array, width: int) -> np.ndarray:
    """The vectors as whole numbers ``floor(SCALE * x)``, exact in doubles;
    shorter ones end in zeros."""
    lists = lists.combine_chunks() if isinstance(lists, pa.ChunkedArray) else lists
    flat = np.floor(np.asarray(lists.flatten(), dtype=np.float64) * SCALE) + 0.0  # no negative zero
    sizes = np.diff(np.asarray(lists.offsets))
    if (sizes == width).all():
        return flat.reshape(len(lists), width)
    out = np.zeros((len(lists), width))
    out[np.arange(width) < sizes[:, None]] = flat
    return out


def hilbert(cells: np.ndarray, bits: int) -> np.ndarray:
    """The place of each row of ``cells`` (whole numbers below ``2 ** bits``) on
    the Hilbert curve through their grid."""
    x = [c.astype(np.int64) for c in cells.T]
    for level in range(bits - 1, 0, -1):  # turn and mirror the sub-cubes back, from the largest
        low = (1 << level) - 1
        for i in range(len(x)):
            there = (x[i] >> level) & 1 == 1
            swap = np.where(there, 0, (x[0] ^ x[i]) & low)
            x[0] = np.where(there, x[0] ^ low, x[0]) ^ swap
            x[i] = x[0] if i == 0 else x[i] ^ swap
    for i in range(1, len(x)):
        x[i] = x[i] ^ x[i - 1]
    flip = np.zeros(len(cells), np.int64)
    for level in range(bits - 1, 0, -1):
        flip ^= np.where((x[-1] >> level) & 1 == 1, (1 << level) - 1, 0)
    key = np.zeros(len(cells), np.int64)
    for level in range(bits - 1, -1, -1):
        for axis in x:
            key = (key << 1) | (((axis ^ flip) >> level) & 1)
    return key


class Curve:
    """Places of a part's vectors on the curve, from the range of each
    component; of more than ``CURVE_AXES`` the widest are taken."""

    def __init__(self, low: np.ndarray, high: np.ndarray):
        self.axes = np.sort(np.argsort(low - high, kind="stable")[:CURVE_AXES])
        self.bits = max(1, min(16, CURVE_BITS // max(1, len(self.axes))))
        self.low, self.high = low[self.axes], high[self.axes]

    def places(self, x: np.ndarray) -> np.ndarray:
        span = np.where(self.high > self.low, self.high - self.low, 1.0)
        share = (x[:, self.axes] - self.low) / span
        cells = np.clip(np.floor(share * 2 ** self.bits), 0, 2 ** self.bits - 1)
        return hilbert(cells, self.bits)


def shortlists(low: np.ndarray, high: np.ndarray, book: np.ndarray) -> np.ndarray:
    """For each box (row of ``low`` and ``high``) which entries of ``book`` can be
    the nearest of a vector in it; ties go to the lower index.

    An entry whose least distance from the box exceeds another's greatest is
    out. So is one that loses to the entry of the least greatest distance in
    every corner of the box: the difference of both distances is linear."""
    gap = np.maximum(np.maximum(low[:, None] - book, book - high[:, None]), 0)
    far = np.maximum(abs(book - low[:, None]), abs(high[:, None] - book))
    far = (far * far).sum(2)
    best = np.argmin(far, axis=1)
    rows = np.arange(len(low))
    keep = (gap * gap).sum(2) <= far[rows, best][:, None]
    toward = book[None] - book[best][:, None]
    corner = np.where(toward > 0, high[:, None], low[:, None])
    squares = (book * book).sum(1)
    lead = squares[None] - squares[best][:, None] - 2 * (corner * toward).sum(2)
    return keep & ((lead < 0) | ((lead == 0) & (np.arange(len(book)) <= best[:, None])))


def kernel(x: np.ndarray, book: np.ndarray, short: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nearest entry of the shortlist (ascending, so ties go to the lower
    index) for each vector, and its squared distance."""
    d = x[:, None] - book[short]
    d = (d * d).sum(2)
    at = np.argmin(d, axis=1)
    return short[at], d[np.arange(len(x)), at]


class Space:
    """What a table's vectors need: width of a part, their number type, and the
    curve of each part."""

    def __init__(self, low: np.ndarray, high: np.ndarray):
        self.width = -(-len(low) // PARTS)
        pad = self.width * PARTS - len(low)
        low, high = (np.concatenate([x, np.zeros(pad)]) for x in (low, high))
        bound = max(1.0, float(np.abs(np.concatenate([low, high, [0.0]])).max()))
        narrow = bound < NARROW and 4 * bound * bound * max(1, self.width) * PARTS < 2 ** 62
        self.number, self.store = (np.int64, np.int32) if narrow else (object, np.float64)
        self.curves = [Curve(low[s], high[s]) for s in self.slices()]

    def slices(self) -> list[slice]:
        return [slice(p * self.width, (p + 1) * self.width) for p in range(PARTS)]

    def exact(self, x: np.ndarray) -> np.ndarray:
        if self.number is np.int64:
            return x.astype(np.int64)
        return np.array([int(v) for v in x.ravel()], dtype=object).reshape(x.shape)

    def loaded(self, data: bytes) -> np.ndarray:
        return self.exact(np.frombuffer(data, self.store).reshape(-1, self.width))


def _measured(vectors: DataFrame) -> Space:
    """One pass for the least and the greatest of each component."""
    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        low, high = np.zeros(0), np.zeros(0)
        for batch in batches:
            if not batch.num_rows:
                continue
            width = int(np.diff(np.asarray(batch.column(0).offsets)).max())
            x = matrix(batch.column(0), width)
            pad = max(width, len(low))
            x = np.pad(x, ((0, 0), (0, pad - width)))
            low, high = (np.pad(v, (0, pad - len(v)), constant_values=c) for v, c in ((low, np.inf), (high, -np.inf)))
            low, high = np.minimum(low, x.min(0)), np.maximum(high, x.max(0))
        yield pa.RecordBatch.from_pydict({"pos": pa.array(range(len(low)), pa.int32()), "low": low, "high": high})

    got = vectors.mapInArrow(each, "pos int, low double, high double").groupBy("pos") \
        .agg(F.min("low").alias("low"), F.max("high").alias("high")).orderBy("pos").toArrow()
    return Space(got["low"].to_numpy(), got["high"].to_numpy())


def _collapsed(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct rows of ``x`` and how often each is there."""
    if not x.shape[1]:
        return x[:1], np.array([len(x)])
    whole = np.ascontiguousarray(x).view(np.dtype((np.void, x.dtype.itemsize * x.shape[1]))).ravel()
    _, first, n = np.unique(whole, return_index=True, return_counts=True)
    return x[first], n


def blocks_of(vectors: DataFrame, space: Space) -> DataFrame:
    """The stored blocks ``(part, n, low, high, total, weights, data)`` of
    ``vectors(v)``: one shuffle by ranges of the curve."""
    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = matrix(batch.column(0), space.width * PARTS)
            for part, s in enumerate(space.slices()):
                each, n = _collapsed(x[:, s])
                yield pa.RecordBatch.from_pydict({
                    "part": pa.array(np.full(len(each), part, np.int32)), "place": space.curves[part].places(each),
                    "n": n.astype(np.int64), "x": [r.tobytes() for r in each.astype(space.store)]})

    def flat(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            part, n = (batch.column(c).to_numpy() for c in (0, 1))
            data = batch.column(2).to_pylist()
            starts = np.flatnonzero(np.diff(part, prepend=-1))
            cuts = np.unique(np.concatenate([np.arange(a, b, BLOCK) for a, b in
                                             zip(starts, [*starts[1:], len(part)])] or [[]])).astype(int)
            out: dict[str, list] = {c: [] for c in ("part", "n", "low", "high", "total", "weights", "data")}
            for a, b in zip(cuts, [*cuts[1:], len(part)]):
                x, w = space.loaded(joined := b"".join(data[a:b])), n[a:b]
                total = (x * (w if space.number is np.int64 else w.astype(object))[:, None]).sum(0)
                box = x.min(0), x.max(0)
                for c, v in zip(out, (int(part[a]), int(w.sum()), *([str(i) for i in y] for y in (*box, total)),
                                      w.astype(np.int64).tobytes(), joined)):
                    out[c].append(v)
            yield pa.RecordBatch.from_pydict(out, BLOCK_ARROW)

    parts = vectors.mapInArrow(spread, "part int, place long, n long, x binary") \
        .withColumn("task", F.spark_partition_id())
    parts = parts.repartitionByRange("part", "place", "task").sortWithinPartitions("part", "place")
    return stored(parts.select("part", "n", "x").mapInArrow(flat, BLOCKS), "vector-blocks")


BLOCKS = "part int, n long, low array<string>, high array<string>, total array<string>, weights binary, data binary"
BLOCK_ARROW = pa.schema([("part", pa.int32()), ("n", pa.int64()), *[(c, pa.list_(pa.string())) for c in (
    "low", "high", "total")], ("weights", pa.binary()), ("data", pa.binary())])


def sums_of(blocks: DataFrame, space: Space, books: list[np.ndarray]) -> dict:
    """One round: ``{(part, entry): (count, component sums)}`` of the entries
    that are the nearest of any vector."""
    width, number = space.width, space.number

    def numbers(column: pa.Array) -> np.ndarray:
        flat = [int(v) for v in column.flatten().to_pylist()]
        return np.array(flat, dtype=number).reshape(-1, width)

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = [np.zeros(len(b), number) for b in books]
        totals = [np.zeros((len(b), width), number) for b in books]
        for batch in batches:
            part = batch.column(0).to_numpy()
            for p in np.unique(part):
                mine = batch.take(pa.array(np.flatnonzero(part == p)))
                n = mine.column(1).to_numpy().astype(number)
                low, high, total = (numbers(mine.column(c)) for c in (2, 3, 4))
                keep = shortlists(low, high, books[p])
                whole = keep.sum(1) == 1
                entry = np.argmax(keep, axis=1)
                np.add.at(counts[p], entry[whole], n[whole])
                np.add.at(totals[p], entry[whole], total[whole])
                for at in np.flatnonzero(~whole):
                    x = space.loaded(mine.column(6)[int(at)].as_py())
                    w = np.frombuffer(mine.column(5)[int(at)].as_py(), np.int64).astype(number)
                    near, _ = kernel(x, books[p], np.flatnonzero(keep[at]))
                    np.add.at(counts[p], near, w)
                    np.add.at(totals[p], near, x * w[:, None])
        rows = [(p, e, i, str(counts[p][e]), str(totals[p][e][i])) for p in range(len(books))
                for e in range(len(books[p])) if counts[p][e] for i in range(width)]
        yield pa.RecordBatch.from_pydict({c: [r[k] for r in rows] for k, c in enumerate(("part", "entry", "pos", "n", "s"))},
                                         SUMS_ARROW)

    exact = [F.sum(F.col(c).cast("decimal(38,0)")).alias(c) for c in ("n", "s")]
    got = blocks.mapInArrow(each, "part int, entry int, pos int, n string, s string") \
        .groupBy("part", "entry", "pos").agg(*exact).collect()  # at most PARTS * ENTRIES * width rows
    out: dict = {}
    for r in got:
        n, s = out.setdefault((r["part"], r["entry"]), (int(r["n"]), [0] * width))
        s[r["pos"]] = int(r["s"])
    return out


SUMS_ARROW = pa.schema([("part", pa.int32()), ("entry", pa.int32()), ("pos", pa.int32()), ("n", pa.string()),
                        ("s", pa.string())])


def fit(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding",
        rounds: int = ROUNDS) -> tuple[Space, list[np.ndarray]]:
    """The codebook of each part, after ``rounds`` rounds from the vectors of
    the smallest ids (of one id, by the vectors; null ids come last)."""
    rows = vectors.select(F.col(id_col).alias("id"), F.col(vec_col).cast("array<double>").alias("v")).where(usable(F.col("v")))
    space = _measured(rows.select("v"))
    first = rows.orderBy(F.col("id").asc_nulls_last(), "v").limit(ENTRIES).select("v").toArrow()["v"]
    start = space.exact(matrix(first, space.width * PARTS)) if len(first) else np.zeros((0, space.width * PARTS), space.number)
    books = [start[:, s] for s in space.slices()]
    if not len(first) or not space.width:
        return space, books
    blocks = blocks_of(rows.select("v"), space)
    for _ in range(rounds):
        moved = [b.copy() for b in books]
        for (part, entry), (n, total) in sums_of(blocks, space, books).items():
            moved[part][entry] = [t // n for t in total]
        if all((a == b).all() for a, b in zip(moved, books)):
            break  # later rounds would not move any entry either
        books = moved
    return space, books


def encode(vectors: DataFrame, space: Space, books: list[np.ndarray], id_col: str = "vec_id",
           vec_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """Rows ``(vec_id, label, code, error)`` of the usable vectors; an error
    that does not fit a long is null."""
    rows = vectors.select(F.col(id_col).alias("vec_id"), F.col(label_col).alias("label"),
                          F.col(vec_col).cast("array<double>").alias("v")).where(usable(F.col("v")))
    fields = rows.schema.fields[:2]

    def near(x: np.ndarray, part: int) -> tuple[np.ndarray, np.ndarray]:
        """Codes and distances of one batch, over blocks that are sorted here."""
        code, error = np.zeros(len(x), np.uint8), np.zeros(len(x), space.number)
        order = np.argsort(space.curves[part].places(x), kind="stable")
        whole = space.exact(x[order])
        starts = np.arange(0, len(x), BLOCK)
        keep = shortlists(np.minimum.reduceat(whole, starts), np.maximum.reduceat(whole, starts), books[part])
        for at, start in enumerate(starts):
            mine = order[start:start + BLOCK]
            code[mine], error[mine] = kernel(whole[start:start + BLOCK], books[part], np.flatnonzero(keep[at]))
        return code, error

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = matrix(batch.column(2), space.width * PARTS)
            codes, error = np.zeros((len(x), PARTS), np.uint8), np.zeros(len(x), space.number)
            if space.width and len(x):
                for part, s in enumerate(space.slices()):
                    codes[:, part], e = near(x[:, s], part)
                    error = error + e
            fits = [int(e) if e < 2 ** 63 else None for e in error]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array([c.tobytes().hex() for c in codes], pa.string()),
                 pa.array(fits, pa.int64())], names=["vec_id", "label", "code", "error"])

    return rows.mapInArrow(each, StructType([*fields, StructField("code", StringType()), StructField("error", LongType())]))


def digest(books: list[np.ndarray]) -> str:
    """SHA-256 of all entries' components, by part, entry and place, comma-joined."""
    return hashlib.sha256(",".join(str(int(v)) for b in books for entry in b for v in entry).encode()).hexdigest()


def compress(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """Rows ``(vec_id, code, error, label_error, codebooks_sha256)``, one for
    each usable row.

    Rows whose vector is null or holds a null, a NaN or an infinity are left
    out. Null ids, repeated ids and repeated rows each come back; null labels
    are one label. Vectors are filled with zeros to the longest one's length and
    that to a multiple of eight; an empty vector has code zero and no error. With
    fewer than 16 rows the codebooks are shorter. Sums that do not fit a long
    are null. An empty table gives an empty result; other columns are not read.
    """
    space, books = fit(vectors, id_col, vec_col)
    coded = stored(encode(vectors, space, books, id_col, vec_col, label_col), "vector-codes")
    sums = cut(coded.groupBy(F.col("label").alias("_label")).agg(
        F.sum(F.col("error").cast("decimal(38,0)")).try_cast("bigint").alias("label_error")))
    sums = F.broadcast(sums) if sums.count() <= BROADCAST_LABELS else sums
    return coded.join(sums, F.col("label").eqNullSafe(F.col("_label"))) \
        .select("vec_id", "code", "error", "label_error", F.lit(digest(books)).alias("codebooks_sha256"))


def oracle(table: str = "embeddings", parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> str:
    """The same rows in DuckDB SQL: every distance in every round."""
    head = f"""
    WITH kept AS (SELECT row_number() OVER (ORDER BY vec_id, embedding) AS rid, vec_id, label, embedding,
                         CAST(len(embedding) / {parts} AS BIGINT) AS width FROM {table}
                  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    v AS MATERIALIZED (SELECT rid, i // width AS part, i % width AS pos,
                 CAST(floor({SCALE} * CAST(embedding[i + 1] AS DOUBLE)) AS BIGINT) AS x
          FROM (SELECT rid, embedding, width, unnest(range(len(embedding))) AS i FROM kept)),
    c0 AS MATERIALIZED (SELECT part, rid - 1 AS entry, pos, x AS c FROM v WHERE rid <= {entries})"""
    steps = []
    for k in range(rounds + 1):
        steps.append(f"""
    a{k} AS MATERIALIZED (SELECT rid, part, entry, d FROM (
             SELECT *, row_number() OVER (PARTITION BY rid, part ORDER BY d, entry) AS rn FROM (
               SELECT rid, part, entry, sum((x - c) * (x - c)) AS d FROM v JOIN c{k} USING (part, pos)
               GROUP BY rid, part, entry)) WHERE rn = 1)""")
        if k < rounds:
            steps.append(f"""
    m{k} AS (SELECT part, entry, pos, CAST(sum(x) AS BIGINT) AS s, count(*) AS n FROM v JOIN a{k} USING (rid, part)
             GROUP BY part, entry, pos),
    c{k + 1} AS MATERIALIZED (SELECT part, entry, pos, CASE WHEN n IS NULL THEN c ELSE (s - ((s % n) + n) % n) // n END AS c
             FROM c{k} LEFT JOIN m{k} USING (part, entry, pos))""")
    return ",".join([head, *steps]) + f""",
    coded AS (SELECT rid, string_agg(printf('%02x', entry), '' ORDER BY part) AS code, CAST(sum(d) AS BIGINT) AS error
              FROM a{rounds} GROUP BY rid),
    book AS (SELECT sha256(string_agg(CAST(c AS VARCHAR), ',' ORDER BY part, entry, pos)) AS digest FROM c{rounds})
    SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
           digest AS codebooks_sha256
    FROM kept JOIN coded USING (rid) CROSS JOIN book"""
