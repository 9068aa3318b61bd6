"""BPE against the tokenizers library, and exact round trips."""
import hashlib
import random

import numpy as np
import pytest

from llm_help import as_list, edge_docs, empty_docs  # noqa: F401
from tessera.llm import bpe
from tessera.llm.queries import tokenizer_path


@pytest.fixture(scope="module")
def automaton():
    return bpe.Automaton(bpe.compile_merges(tokenizer_path()))


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer
    return Tokenizer.from_file(tokenizer_path())


def test_every_sort_of_character(automaton, library):
    for c in [*range(0x3100), *range(0x3100, 0x110000, 97)]:
        if not 0xD800 <= c < 0xE000:
            text = f"a{chr(c)}b {chr(c)}{chr(c)}  x"
            assert automaton.encode(text).tolist() == library.encode(text, add_special_tokens=False).ids


def test_random_and_repeated_texts(automaton, library):
    rnd = random.Random(1)
    letters = "abcdefghiklmnoprstuvw etaoin  \n\t'.,0123456789\u00e9\u00fc\u4e2d\U0001F600"
    texts = ["", "a" * 500, " " * 300, "aaaa" * 7, "<|endoftext|>", "x<|endoftext|><|endoftext|> y"]
    texts += ["".join(rnd.choice(letters) for _ in range(rnd.randint(0, 60))) for _ in range(4000)]
    for text in texts:
        ids = automaton.encode(text)
        assert ids.tolist() == library.encode(text, add_special_tokens=False).ids
        assert automaton.decode(ids) == text


def test_decoding_of_broken_bytes(automaton, library):
    for ids in ([200, 201], [128, 195], [50256, 100, 199, 220]):
        assert automaton.decode(np.array(ids)) == library.decode(ids, skip_special_tokens=False)


def test_arcs_equal_merging_by_hand(tmp_path, library):
    import json
    vocab = {c: n for n, c in enumerate(["a", "b", "aa", "ab", "aab"])}
    spec = {"model": {"vocab": vocab, "merges": ["a a", "a b", "a ab"]}, "added_tokens": []}
    path = tmp_path / "small.json"
    path.write_text(json.dumps(spec))
    small = bpe.Automaton(bpe.compile_merges(str(path)))

    def merged(text):
        parts = list(text)
        for a, b in (("a", "a"), ("a", "b"), ("a", "ab")):
            i = 0
            while i < len(parts) - 1:
                if (parts[i], parts[i + 1]) == (a, b):
                    parts[i:i + 2] = [a + b]
                i += 1
        return [vocab[p] for p in parts]
    for n in range(1, 10):
        for k in range(2 ** n):
            text = "".join("ab"[k >> i & 1] for i in range(n))
            assert small.run(text.encode()) == merged(text)


def test_edge_cases(edge_docs, empty_docs, library):
    got = as_list(bpe.digests(edge_docs, tokenizer_path()), "doc_id", "n_tokens", "ids_sha256", "decoded_sha256")
    want = []
    for r in edge_docs.collect():
        ids = library.encode(r["text"] or "", add_special_tokens=False).ids
        want.append((r["doc_id"], len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
                     hashlib.sha256((r["text"] or "").encode()).hexdigest()))
    assert got == sorted(want, key=lambda t: tuple((x is None, x) for x in t))
    assert bpe.digests(empty_docs, tokenizer_path()).count() == 0
    full = bpe.encode(edge_docs, tokenizer_path()).collect()
    assert {(r["doc_id"], r["decoded"]) for r in full} == \
        {(r["doc_id"], r["text"] or "") for r in edge_docs.collect()}
