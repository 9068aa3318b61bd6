"""BPE encoding and decoding by a tokenization automaton.

``compile_merges`` turns a tokenizer file into the tables of a deterministic
automaton whose states are tokens (the last token read) and whose arcs are
the tokens that may follow. It starts with one state for each byte and an arc
between any two of them. The merges then act in rank order, each as a gadget:
merge ``(u, v) -> w`` adds state ``w``, whose incoming arcs are those of ``u``
and whose outgoing arcs are those of ``v`` at that moment, and then removes
the arc ``u -> v``. A token sequence is a BPE encoding exactly if all its
steps are arcs of the final automaton.

The arcs are kept in the form in which the gadgets make them: for each state
the two it was made of and the rank at which it was made, and for each merge
the rank at which its arc went away. ``Automaton.arc`` unrolls the gadgets of
a pair and keeps the answer, so the table of transitions fills with the pairs
that texts need instead of all 50,000 x 50,000.

Pre-split words are encoded by running the automaton over their bytes: the
state after a byte is the one token that ends there and has an arc from the
state before it. Decoding emits the byte label of every arc.
"""

from __future__ import annotations

import hashlib
import json
import struct
from collections.abc import Iterator

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame, functions as F

#: Fixed value: the pre-splitting pattern of byte-level BPE.
PRE_SPLIT = (r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+"
             r"|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+")
#: Words that a task remembers the encoding of; beyond it the memory starts
#: anew, so it bounds memory only and changes no result.
REMEMBERED_WORDS = 400_000
REMEMBERED_ARCS = 1_000_000


def byte_alphabet() -> dict[str, int]:
    """The printable character that stands for each byte in the file."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + n): b for n, b in enumerate(rest)}


def compile_merges(path: str) -> dict:
    """Automaton tables of a byte-level BPE file of the tokenizers library:
    ``labels`` (bytes of each token id), ``left`` and ``right`` (the states a
    state was made of, itself for a byte), ``made`` (its rank, -1 for a byte),
    ``gone`` (rank at which the arc of a pair went away) and ``special``."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    vocab, merges = spec["model"]["vocab"], spec["model"]["merges"]
    letters = byte_alphabet()
    size = 1 + max([*vocab.values(), *(t["id"] for t in spec["added_tokens"])])
    labels: list[bytes] = [b""] * size
    for token, n in vocab.items():
        if all(c in letters for c in token):
            labels[n] = bytes(letters[c] for c in token)
    left, right, made = list(range(size)), list(range(size)), [-1] * size
    gone: dict[tuple[int, int], int] = {}
    for rank, pair in enumerate(merges):
        a, b = pair.split(" ") if isinstance(pair, str) else pair
        u, v, w = vocab[a], vocab[b], vocab[a + b]
        gone.setdefault((u, v), rank)
        if made[w] < 0 and len(labels[w]) > 1:
            left[w], right[w], made[w] = u, v, rank
    special = {t["content"]: t["id"] for t in spec["added_tokens"]}
    for text, n in special.items():
        labels[n] = text.encode()
    return {"labels": labels, "left": left, "right": right, "made": made, "gone": gone,
            "special": special}


class Automaton:
    """Runs the compiled tables."""

    def __init__(self, tables: dict):
        self.labels, self.gone = tables["labels"], tables["gone"]
        self.left, self.right, self.made = tables["left"], tables["right"], tables["made"]
        self.special = tables["special"]
        special_ids = set(self.special.values())
        self.known: dict[int, bool] = {}
        ids = {b: n for n, b in enumerate(self.labels)
               if b and n not in special_ids and self._reachable(n)}
        #: Every start of a label, with its token (-1: only a start).
        self.starts = {b[:k]: -1 for b in ids for k in range(1, len(b))} | ids
        self.arcs: dict[int, bool] = {}
        self.words: dict[str, bytes] = {}
        self.pieces = regex.compile(PRE_SPLIT)
        self.stops = regex.compile("|".join(regex.escape(s) for s in sorted(self.special, key=len,
                                   reverse=True))) if self.special else None

    def arc(self, p: int, x: int) -> bool:
        """Whether ``x`` may follow ``p``, from the table or by unrolling the
        younger of both into the state its gadget copied the arcs of."""
        key = p << 32 | x
        open_ = self.arcs.get(key)
        if open_ is None:
            if len(self.arcs) >= REMEMBERED_ARCS:
                self.arcs.clear()
            open_ = self.arcs[key] = self._open_until(p, x, 1 << 60)
        return open_

    def run(self, word: bytes) -> list[int]:
        """Token ids of one pre-split word: the one path of the automaton that
        reads all its bytes, longest labels first. A state at a position
        without a way on is not entered again, so the work is bounded by
        positions times label lengths."""
        starts, arcs, n = self.starts, self.arcs, len(word)
        at, prev, path, ends, open_, dead = 0, -1, [], [], [], set()
        while at < n:
            choices = []
            for end in range(at + 1, n + 1):
                token = starts.get(word[at:end])
                if token is None:
                    break
                if token >= 0:
                    choices.append((end, token))
            while True:
                while not choices:
                    dead.add((at, prev))
                    choices = open_.pop()
                    path.pop(), ends.pop()
                    at, prev = (ends[-1], path[-1]) if path else (0, -1)
                end, token = choices.pop()
                if prev >= 0:
                    known = arcs.get(prev << 32 | token)
                    if not (self.arc(prev, token) if known is None else known):
                        continue
                if dead and (end, token) in dead:
                    continue
                break
            path.append(token), ends.append(end), open_.append(choices)
            at, prev = end, token
        return path

    def _reachable(self, token: int) -> bool:
        """A state exists if it is a byte or its gadget found its arc."""
        known = self.known.get(token)
        if known is None:
            made = self.made[token]
            if made < 0:
                known = len(self.labels[token]) == 1
            else:
                u, v = self.left[token], self.right[token]
                known = self._reachable(u) and self._reachable(v) and self._open_until(u, v, made)
            self.known[token] = known
        return known

    def _open_until(self, a: int, b: int, now: int) -> bool:
        """Whether the arc ``a -> b`` was there just before rank ``now``.

        A state copied its outgoing arcs before its merge took the arc
        ``u -> v`` away and its incoming ones after that; it matters where
        both parts are the same token, of which the leftmost merge first."""
        made, gone = self.made, self.gone
        while True:
            if gone.get((a, b), now) < now:
                return False
            if made[a] < 0 and made[b] < 0:
                return True
            if made[a] > made[b]:    # its outgoing arcs are those of its right part
                now, a = made[a], self.right[a]
            else:                    # its incoming arcs are those of its left part
                now, b = made[b] + 1, self.left[b]

    def encode(self, text: str | None) -> np.ndarray:
        """Ids of a whole text as little-endian unsigned 32-bit integers."""
        out: list[bytes] = []
        text, at = text or "", 0
        for stop in self.stops.finditer(text) if self.stops else ():
            self._plain(text[at:stop.start()], out)
            out.append(np.array([self.special[stop[0]]], "<u4").tobytes())
            at = stop.end()
        self._plain(text[at:] if at else text, out)
        return np.frombuffer(b"".join(out), "<u4")

    def _plain(self, text: str, out: list[bytes]) -> None:
        words = self.words
        for piece in self.pieces.findall(text):
            ids = words.get(piece)
            if ids is None:
                path = self.run(piece.encode())
                ids = struct.pack(f"<{len(path)}I", *path)
                if len(piece) <= 64:
                    if len(words) >= REMEMBERED_WORDS:
                        words.clear()
                    words[piece] = ids
            out.append(ids)

    def decode(self, ids: np.ndarray) -> str:
        """The labels of the arcs, as text; bytes that are not UTF-8 give the
        replacement character."""
        labels = self.labels
        return b"".join([labels[i] for i in ids.tolist()]).decode("utf-8", "replace")


def encode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows ``(doc_id, ids array<int>, decoded)``, one for each row of ``docs``.

    Null and empty texts have no ids and decode to the empty text; null ids
    and repeated rows stay; other columns are not read. The tables are some
    megabytes whatever the input, and go to the executors once.
    """
    tables = docs.sparkSession.sparkContext.broadcast(compile_merges(path))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        automaton = Automaton(tables.value)
        for batch in batches:
            ids = [automaton.encode(t) for t in batch["text"]]
            yield pd.DataFrame({"doc_id": batch["doc_id"], "ids": ids,
                                "decoded": [automaton.decode(x) for x in ids]})

    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInPandas(run, "doc_id long, ids array<int>, decoded string")


def digests(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows ``(doc_id, n_tokens, ids_sha256, decoded_sha256)`` of the same
    encoding, digested where the ids are made so that they need not leave the
    Python worker. Same cases as :func:`encode`."""
    tables = docs.sparkSession.sparkContext.broadcast(compile_merges(path))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        automaton = Automaton(tables.value)
        for batch in batches:
            rows = []
            for t in batch["text"]:
                ids = automaton.encode(t)
                rows.append((len(ids), hashlib.sha256(ids.tobytes()).hexdigest(),
                             hashlib.sha256(automaton.decode(ids).encode()).hexdigest()))
            out = pd.DataFrame(rows, columns=["n_tokens", "ids_sha256", "decoded_sha256"])
            out.insert(0, "doc_id", batch["doc_id"].values)
            yield out

    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInPandas(run, "doc_id long, n_tokens long, ids_sha256 string, "
                                 "decoded_sha256 string")
