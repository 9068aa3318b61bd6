"""Benchmark decontamination by CGK embedding and bit-sampling LSH.

A window of words is embedded by the CGK random walk: at each step the symbol
under the pointer is put out, and a random bit of (step, symbol) says whether
the pointer moves on. Walks of similar windows meet again after an edit, so
edit distance becomes Hamming distance of the outputs. A few sampled positions
of the output make a key; windows of documents whose key is that of a window
of an item are candidates. Repetitions with other bits and positions reach the
target recall. Every candidate is verified by the exact edit distance of the
item to the best matching stretch of the document around it.

Distances are in characters, so a word with a typo must not count as another
word: in each repetition a word's symbol is made of two or three of its
characters only, at places counted from its beginning or its end, which a typo
mostly leaves as they are. Windows grow with the item up to half of it (and are
16 words at most): an edited item has several windows in step with the
document's, and the shorter ones hold fewer edits.

The benchmark is the query set: it is read in blocks of ``BLOCK_ITEMS`` items,
and the tables of a block, bounded by it, are broadcast while all documents
pass. Documents are never shuffled for the search.
"""

from __future__ import annotations

import math
import re
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

BLOCK_ITEMS = 5_000
#: A stretch of a document is contaminated by an item if it is at least this
#: similar: 1 - edit distance / length of the item, in characters.
SIMILARITY = 0.8
#: Least words of an item, words of its windows, stride of the document's
#: windows, characters that make a symbol (0: the whole word), and its bits. An
#: item has a window at each of its words, so a verbatim copy always has a window
#: in step with one of them.
CLASSES = ((40, 16, 4, 3, 16), (16, 8, 4, 3, 16), (8, 4, 2, 3, 16), (4, 4, 1, 3, 16), (2, 2, 1, 3, 16), (1, 1, 1, 0, 20))
#: Repetitions, and sampled positions of each.
REPEATS, SAMPLED = 16, 5
#: Characters of a word that symbols are made of, and places from either end.
SPELLED, PLACES = 24, 4
SEED = 20240501
#: Words of texts that are searched at a time, and characters of stretches that are
#: verified at a time.
CHUNK_WORDS, STRETCHES = 300_000, 2 ** 23
WORD = re.compile(r"[^\W_]+")
#: What is no letter or digit, of ASCII, as spaces; other such characters of a text
#: up to which they are replaced one by one.
SPACED = {c: " " for c in range(128) if not chr(c).isalnum()}
FEW = 64
MIX = np.uint64(0x9E3779B97F4A7C15)
GATE_BITS = 18


def words(text: str | None) -> list[str]:
    """Lower-cased runs of letters and digits of the whole text."""
    text = (text or "").lower()
    if not text.isascii():
        others = [c for c in set(text) if not c.isalnum()]
        if len(others) > FEW:
            return WORD.findall(text)
        for c in others:
            text = text.replace(c, " ")
        return text.split()
    return text.translate(SPACED).split()


def edit_distance_within(item: str, text: str) -> int:
    """Smallest edit distance of ``item`` to any stretch of ``text``, by
    bit-parallel dynamic programming over one column for each character."""
    if not item or item in text:
        return 0
    m, at = len(item), defaultdict(int)
    for i, c in enumerate(item):
        at[c] |= 1 << i
    full, top = (1 << m) - 1, 1 << (m - 1)
    up, down, now = full, 0, m
    best = m
    for c in text:
        eq = at.get(c, 0)
        diagonal = (((eq & up) + up) ^ up) | eq | down
        right = down | ~(diagonal | up) & full
        left = up & diagonal
        now += 1 if right & top else -1 if left & top else 0
        best = min(best, now)
        right = right << 1 & full
        left = left << 1 & full
        up = left | ~(diagonal | right) & full
        down = right & diagonal
    return best


#: Bits of a limb of the vectors below, and pairs of a batch.
LIMB, BATCH = 60, 2048
#: Bits of a word, where carries beyond the last may be lost, and characters of
#: the texts of a batch of pieces.
WORD_BITS, CELLS = 64, 2 ** 21


def edit_distances_within(pairs: list[tuple[str, str]]) -> list[int]:
    """:func:`edit_distance_within` of each pair, many at a time: the bit vectors
    of a batch are rows of limbs."""
    out = [0] * len(pairs)
    rest = [i for i, (item, text) in enumerate(pairs) if item and item not in text]
    rest.sort(key=lambda i: (-(-len(pairs[i][0]) // LIMB), len(pairs[i][1])))
    at = 0
    while at < len(rest):
        limbs = -(-len(pairs[rest[at]][0]) // LIMB)
        some = [i for i in rest[at:at + BATCH] if -(-len(pairs[i][0]) // LIMB) == limbs]
        for i, v in zip(some, _distances([pairs[i] for i in some], limbs)):
            out[i] = v
        at += len(some)
    return out


def _distances(pairs: list[tuple[str, str]], limbs: int) -> list[int]:
    """Distances of pairs whose items have as many limbs."""
    n, longest = len(pairs), max(len(t) for _, t in pairs)
    letters = np.array(sorted({ord(c) for item, _ in pairs for c in item}), np.uint32)
    code = {chr(c): k for k, c in enumerate(letters, 1)}
    number = {item: k for k, item in enumerate(dict.fromkeys(item for item, _ in pairs))}
    table = np.zeros((len(number), len(code) + 1, limbs), np.int64)
    for item, k in number.items():
        for i, c in enumerate(item):
            table[k, code[c], i // LIMB] |= 1 << (i % LIMB)
    which = np.array([number[item] for item, _ in pairs])
    size = np.array([len(item) for item, _ in pairs])
    ends = np.array([len(t) for _, t in pairs])
    codes = np.zeros((longest, n), np.int64)
    for b, (_, t) in enumerate(pairs):
        points = np.frombuffer(t.encode("utf-32-le", "surrogatepass"), np.uint32)
        k = np.minimum(np.searchsorted(letters, points), len(letters) - 1)
        codes[:len(t), b] = np.where(letters[k] == points, k + 1, 0)
    bits = np.clip(size[:, None] - LIMB * np.arange(limbs), 0, LIMB)
    full = np.left_shift(1, bits) - 1
    rows, last, top, mask = np.arange(n), (size - 1) // LIMB, (size - 1) % LIMB, (1 << LIMB) - 1
    up, down = full.copy(), np.zeros((n, limbs), np.int64)
    now, best = size.copy(), size.copy()

    def moved(x: np.ndarray) -> np.ndarray:
        y = (x << 1) & mask
        y[:, 1:] |= x[:, :-1] >> (LIMB - 1)
        return y & full

    for j in range(longest):
        eq = table[which, codes[j]]
        total = (eq & up) + up
        for w in range(limbs - 1):
            total[:, w + 1] += total[:, w] >> LIMB
        diagonal = ((total & mask) ^ up) | eq | down
        right = down | ~(diagonal | up) & full
        left = up & diagonal
        now += (right[rows, last] >> top & 1) - (left[rows, last] >> top & 1)
        best = np.where((j < ends) & (now < best), now, best)
        right, left = moved(right), moved(left)
        up = left | ~(diagonal | right) & full
        down = right & diagonal
    return best.tolist()


def edit_distances_up_to(pairs: list[tuple[str, str]], limits: list[int]) -> list[int]:
    """:func:`edit_distance_within` of each pair where that is at most its limit;
    else a number above the limit. The distances of an item's pieces add up to that
    of the item at most, so pieces of one word of bits rule most pairs out."""
    out, rest = [0] * len(pairs), sorted(range(len(pairs)), key=lambda i: -len(pairs[i][1]))
    whole, start = [], 0
    while rest:
        b = 0
        while b < len(rest):
            some = rest[b:b + 4 * BATCH]
            some = some[:max(1, CELLS // max(1, len(pairs[some[0]][1])))]
            b += len(some)
            pieces = [(pairs[i][0][start:start + WORD_BITS], pairs[i][1]) for i in some]
            for i, v in zip(some, _piece_distances(pieces)):
                out[i] += v
        start += WORD_BITS
        near = [i for i in rest if out[i] <= limits[i]]
        rest = [i for i in near if len(pairs[i][0]) > start]
        whole += [i for i in near if WORD_BITS < len(pairs[i][0]) <= start]
    for i, v in zip(whole, edit_distances_within([pairs[i] for i in whole])):
        out[i] = v
    return out


def _piece_distances(pairs: list[tuple[str, str]]) -> list[int]:
    """Distances of pairs whose items have ``WORD_BITS`` characters at most, the longest
    text first, so that those with a character left at a step are the first ones."""
    number = {item: k for k, item in enumerate(dict.fromkeys(item for item, _ in pairs))}
    letters = np.array(sorted({ord(c) for c in set().union(*number)} | {0x110000}), np.uint32)
    code = {int(c): k for k, c in enumerate(letters)}
    table = np.zeros((len(number), len(letters) + 1), np.uint64)
    for item, k in number.items():
        for i, c in enumerate(item):
            table[k, code[ord(c)]] |= np.uint64(1 << i)
    flat, size = table.reshape(-1), np.array([len(item) for item, _ in pairs])
    base = np.array([number[item] for item, _ in pairs]) * (len(letters) + 1)
    ends = np.array([len(t) for _, t in pairs])
    points = np.frombuffer("".join(t for _, t in pairs).encode("utf-32-le", "surrogatepass"), np.uint32)
    place = np.full(0x110001, len(letters), np.int32)
    place[letters] = np.arange(len(letters))
    codes = np.full((len(pairs), int(ends.max(initial=0))), len(letters), np.int32)
    codes[np.arange(codes.shape[1]) < ends[:, None]] = place.take(points)
    columns = np.add(codes.T, base, dtype=np.int64, order="C")
    left_at = np.searchsorted(-ends, -np.arange(len(columns)), "left").tolist()
    one = np.uint64(1)
    top = np.maximum(size - 1, 0).astype(np.uint64)
    up, down = np.full(len(pairs), ~np.uint64(0)), np.zeros(len(pairs), np.uint64)
    now, best = size.copy(), size.copy()
    every = up, down, now, best, top
    for n, column in zip(left_at, columns):
        up, down, now, best, top = (x[:n] for x in every)
        eq = flat.take(column[:n])
        diagonal = eq & up
        diagonal += up
        diagonal ^= up
        diagonal |= eq
        diagonal |= down
        right = diagonal | up
        np.invert(right, out=right)
        right |= down
        np.bitwise_and(up, diagonal, out=up)  # what goes left
        now += (right >> top & one).view(np.int64)
        now -= (up >> top & one).view(np.int64)
        np.minimum(best, now, out=best)
        right <<= one
        up <<= one
        np.bitwise_and(right, diagonal, out=down)
        diagonal |= right
        np.invert(diagonal, out=diagonal)
        up |= diagonal
    return every[3].tolist()


def class_of(n: int) -> tuple[int, int, int, int, int]:
    """The class of an item of ``n`` words."""
    return next(c for c in CLASSES if n >= c[0])


class Spelling:
    """The characters of distinct words, as arrays."""

    def __init__(self, names: list[str]):
        self.codes = np.array(names, dtype=f"U{SPELLED}").reshape(-1).view(np.uint32).reshape(len(names), SPELLED) \
            if names else np.zeros((0, SPELLED), np.uint32)
        self.last = np.count_nonzero(self.codes, axis=1) - 1
        self.seen: dict[tuple[bool, int], np.ndarray] = {}

    def _column(self, end: bool, j: int, clipped: bool) -> np.ndarray:
        """The character of each word at a place, plus one; looked up once."""
        if (end, j) not in self.seen:
            rows = np.arange(len(self.last))
            at = np.maximum(self.last - j, 0) if end else np.minimum(j, self.last) if clipped else np.full(len(rows), j)
            self.seen[end, j] = self.codes[rows, at].astype(np.uint64) + np.uint64(1)
        return self.seen[end, j]

    def symbols(self, picks: list[tuple[bool, int]], bits: int) -> np.ndarray:
        """The symbol of each word, from 1, after 0 for no word: a hash of the
        characters at ``picks`` (from the end or the beginning, and how far in);
        without any, of all."""
        h = np.zeros(len(self.last), np.uint64)
        if not picks:
            self.seen = {}  # places beyond a word count as such here
        for end, j in picks or [(False, j) for j in range(SPELLED)]:
            h += self._column(end, j, bool(picks))
            h *= MIX
            h ^= h >> np.uint64(29)
        if not picks:
            self.seen = {}
        return np.concatenate(([0], (h >> np.uint64(64 - bits)).astype(np.int32) + 1)).astype(np.int32)


def compile_items(items: list[tuple[int, str | None]]) -> dict:
    """Search tables of a block of items ``(item_id, text)``."""
    ids_of = defaultdict(list)
    for item_id, text in items:
        ws = words(text)
        if ws:
            ids_of[tuple(ws)].append(item_id)
    texts = sorted(ids_of)
    names = sorted({w for t in texts for w in t})
    number, spelling = {w: n for n, w in enumerate(names, 1)}, Spelling(names)
    rng, classes = np.random.Generator(np.random.PCG64(SEED)), []
    for kind in CLASSES:
        _, window, stride, spelled, bits = kind
        members = [k for k, t in enumerate(texts) if class_of(len(t)) == kind]
        if not members:
            continue
        steps = 2 * window
        rows, where = [], []
        for k in members:
            s = [number[w] for w in texts[k]]
            for o in range(len(s) - window + 1):
                rows.append(s[o:o + window])
                where.append((k, o))
        flat = np.concatenate([np.array([*r, *[0] * steps]) for r in rows]).astype(np.int64)
        starts = np.arange(len(rows), dtype=np.int64) * (window + steps)
        repeats = []
        for _ in range(REPEATS if spelled else 1):
            moves = rng.integers(0, 2, (steps, (1 << bits) + 1), dtype=np.int8)
            # one position of each stratum of the output, so that no word decides alone
            n = min(SAMPLED, window)
            sampled = np.array([int(rng.integers(steps * i // n, steps * (i + 1) // n))
                                for i in range(n)]) if window > 1 else np.array([0])
            places = rng.choice(2 * PLACES, spelled, replace=False).tolist()
            picks = [(p >= PLACES, p % PLACES) for p in places]
            keys, _, gates = _walk(flat, spelling.symbols(picks, bits), starts, flat.take(starts), moves, sampled, None, window)
            order = np.argsort(keys, kind="stable")
            # of the first position the symbol alone decides
            gates[0] = gates[0][_gate(_mixed(np.zeros(1, np.uint64), np.arange((1 << bits) + 1)))]
            repeats.append({"moves": moves, "sampled": sampled, "gates": gates, "picks": picks,
                            "keys": keys[order], "rows": order})
        classes.append({"window": window, "stride": stride, "bits": bits, "repeats": repeats,
                        "where": np.array(where, np.int64)})
    return {"classes": classes, "words": texts,
            "texts": [" ".join(t) for t in texts], "ids": [ids_of[t] for t in texts]}


def _mixed(key: np.ndarray, symbols: np.ndarray) -> np.ndarray:
    key = (key + symbols.astype(np.uint64) + np.uint64(1)) * MIX
    key ^= key >> np.uint64(29)
    return key


def _gate(key: np.ndarray) -> np.ndarray:
    return (key >> np.uint64(64 - GATE_BITS)).astype(np.int64)


def _walk(numbers: np.ndarray, symbols: np.ndarray, starts: np.ndarray, first: np.ndarray, moves: np.ndarray,
          sampled: np.ndarray, gates: list[np.ndarray] | None, window: int) -> tuple:
    """Keys of the windows at ``starts``, of words ``numbers`` (there ``first``) with
    ``symbols``. With ``gates`` (tables of the items' first symbols, then hash tables of
    their part keys) a window is left as soon as its part key is none of theirs; without,
    the hash tables are built. Returns keys, the windows still there, and gates."""
    at, live = starts, np.arange(len(starts))
    end = starts + window
    key = np.zeros(len(starts), np.uint64)
    built, wanted = [], set(sampled.tolist())
    for step in range(int(sampled[-1]) + 1):
        # as a step moves by one place at most, the first ones are within the window
        word = first if not step else numbers.take(at) if step < window \
            else np.where(at < end, numbers.take(np.minimum(at, len(numbers) - 1)), 0)
        if step in wanted:
            if gates is None:
                key = _mixed(key, symbols.take(word))
                table = np.zeros(1 << GATE_BITS, bool)
                table[_gate(key)] = True
                built.append(table)
            else:
                if built:
                    key = _mixed(key, symbols.take(word))
                on = np.flatnonzero(gates[len(built)].take(_gate(key)) if built else gates[0].take(symbols).take(word))
                at, end, key, live, word = at[on], end[on], key[on], live[on], word[on]
                if not built:
                    key = _mixed(key, symbols.take(word))
                built.append(None)
                if not len(live):
                    break
        # looked up for each word while there are more windows
        at = at + (moves[step].take(symbols).take(word) if len(word) > len(symbols) else moves[step].take(symbols.take(word)))
    return key, live, built


def find(tables: dict, texts: list[str | None]) -> list[tuple[int, int, int]]:
    """``(text number, item text number, distance)`` of every text and item
    that match, with the best distance found."""
    tried: list[tuple[int, int]] = []
    pairs: list[tuple[str, str]] = []
    best: dict[tuple[int, int], int] = {}
    chunk: list[tuple[int, list[str]]] = []
    size = held = 0

    def search() -> None:
        nonlocal size, held
        for n, k, stretch in _find(tables, chunk) if chunk else []:
            tried.append((n, k))
            pairs.append((tables["texts"][k], stretch))
            held += len(stretch)
        chunk.clear()
        size = 0

    def verify() -> None:
        nonlocal held
        limits = [math.floor((1 - SIMILARITY) * len(item) + 1e-9) for item, _ in pairs]
        for at, distance, limit in zip(tried, edit_distances_up_to(pairs, limits), limits):
            if distance <= limit:
                best[at] = min(distance, best.get(at, distance))
        tried.clear()
        pairs.clear()
        held = 0

    copies = defaultdict(list)
    for n, text in enumerate(texts):
        copies[text].append(n)
    for text, (n, *_) in copies.items():
        ws = words(text)
        if ws:
            chunk.append((n, ws))
            size += len(ws)
        if size >= CHUNK_WORDS:
            search()
        if held >= STRETCHES:
            verify()
    search()
    verify()
    return [(m, k, v) for (n, k), v in best.items() for m in copies[texts[n]]]


def _find(tables: dict, chunk: list[tuple[int, list[str]]]) -> Iterator[tuple[int, int, str]]:
    """``(text number, item text number, stretch)`` of the candidates."""
    gap = 2 * CLASSES[0][1]
    lengths = np.array([len(ws) for _, ws in chunk], np.int64)
    first = np.concatenate(([0], np.cumsum(lengths + gap)[:-1]))
    numbers = np.zeros(int(lengths.sum()) + gap * len(chunk), np.int64)
    every = np.empty(int(lengths.sum()), object)
    every[:] = [w for _, ws in chunk for w in ws]
    number, names = pd.factorize(every)
    numbers[np.repeat(first - np.cumsum(lengths) + lengths, lengths) + np.arange(len(every))] = number + 1
    spelling = Spelling(names.tolist())
    seeds: set[tuple[int, int, int]] = set()
    for c in tables["classes"]:
        stride = c["stride"]
        counts = (lengths + stride - 1) // stride
        doc = np.repeat(np.arange(len(chunk)), counts)
        place = (np.arange(int(counts.sum())) - np.repeat(np.cumsum(counts) - counts, counts)) * stride
        starts = first[doc] + place
        begun = numbers.take(starts)
        for r in c["repeats"]:
            keys, live, _ = _walk(numbers, spelling.symbols(r["picks"], c["bits"]), starts, begun,
                                  r["moves"], r["sampled"], r["gates"], c["window"])
            lo = np.searchsorted(r["keys"], keys, "left")
            hi = np.searchsorted(r["keys"], keys, "right")
            n = hi - lo
            at = np.repeat(np.arange(len(n)), n)
            row = r["rows"][np.repeat(lo - np.cumsum(n) + n, n) + np.arange(len(at))]
            k, o = c["where"][row].T
            seeds.update(zip(doc[live[at]].tolist(), k.tolist(), (place[live[at]] - o).tolist()))
    reached: dict[tuple[int, int], int] = {}
    for d, k, start in sorted(seeds):
        if (d, k) in reached and start <= reached[d, k]:
            continue  # the stretch around an earlier seed takes this one in
        n, ws = len(tables["words"][k]), chunk[d][1]
        slack = n // 4 + 2
        reached[d, k] = start + slack // 2
        yield chunk[d][0], k, " ".join(ws[max(0, start - slack):max(0, start + n + 2 * slack)])


def blocks_of(benchmark: DataFrame) -> Iterator[list[tuple[int, str | None]]]:
    """The items in blocks that the driver holds one at a time."""
    items = benchmark.select(F.col("item_id"), F.col("text"))
    n = math.ceil(items.count() / BLOCK_ITEMS)
    # twice as many parts as needed keep each below the bound with its spread
    parts = 1 if n <= 1 else 2 * n
    for k in range(parts if n else 0):
        part = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(parts)) == k)
        block = [(r["item_id"], r["text"]) for r in part.toLocalIterator()]
        if block:
            yield block


def matches(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Rows ``(doc_id, item_id, distance, similarity)``: each document with each
    item that it holds a stretch of, at the best distance.

    Null and empty texts, and items without words, match nothing; null ids
    stay null; rows of one id count as one document; items of the same words
    each come back; empty tables give an empty result; other columns are not
    read.
    """
    spark = docs.sparkSession
    rows = docs.select("doc_id", "text")
    out = spark.createDataFrame([], "doc_id long, item_id long, distance int, similarity double")
    for block in blocks_of(benchmark):
        tables = spark.sparkContext.broadcast(compile_items(block))

        def search(batches: Iterator[pd.DataFrame], tables=tables) -> Iterator[pd.DataFrame]:
            for batch in batches:
                ids, found = batch["doc_id"].tolist(), find(tables.value, batch["text"].tolist())
                yield pd.DataFrame(
                    [(ids[n], i, v, 1 - v / len(tables.value["texts"][k]))
                     for n, k, v in found for i in tables.value["ids"][k]],
                    columns=["doc_id", "item_id", "distance", "similarity"]).astype(
                        {"doc_id": "Int64", "item_id": "Int64", "distance": "int32",
                         "similarity": "float64"})

        out = out.unionByName(rows.mapInPandas(search, out.schema))
    return out.groupBy("doc_id", "item_id").agg(F.min("distance").alias("distance"),
                                                F.max("similarity").alias("similarity"))


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` without the documents that match an item; all columns stay. The
    decision is taken where the text is read, so texts are not shuffled."""
    spark = docs.sparkSession
    for block in blocks_of(benchmark):
        docs = docs.where(~_holds(spark.sparkContext.broadcast(compile_items(block)))(F.col("text")))
    return docs


def _holds(tables):
    @F.pandas_udf("boolean")
    def holds(texts: pd.Series) -> pd.Series:
        found = {n for n, _, _ in find(tables.value, texts.tolist())}
        return pd.Series([n in found for n in range(len(texts))], dtype=bool)

    return holds
