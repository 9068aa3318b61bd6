"""Quality rules against plain Python, and edge cases."""
import random
import re
from collections import Counter

from llm_help import SF001, edge_docs, empty_docs  # noqa: F401
from tessera.llm import quality

W = re.compile(r"[^\x20\x09-\x0D]+")


def plain(text):
    text = text or ""
    ws = W.findall(text)
    grams = [tuple(ws[i:i + 3]) for i in range(len(ws) - 2)]
    n, covered = Counter(grams), set()
    for i, g in enumerate(grams):
        covered |= {i, i + 1, i + 2} if n[g] > 1 else set()
    lines = [x for x in text.split("\n") if W.search(x)]
    return (len(ws), sum(map(len, ws)), sum(c in "#*$%&|<>" for c in text),
            len(lines) - len(set(lines)), len(covered))


COLUMNS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def check(docs):
    got = Counter((r["doc_id"], *[r[c] for c in COLUMNS]) for r in quality.judge(docs).collect())
    assert got == Counter((r["doc_id"], *plain(r["text"])) for r in docs.collect())


def test_measures(spark, edge_docs, empty_docs):
    check(edge_docs)
    check(spark.read.parquet(f"{SF001}/documents.parquet"))
    assert quality.judge(empty_docs).count() == 0
    rnd = random.Random(2)
    short = [(i, " ".join(rnd.choice("ab") for _ in range(rnd.randint(0, 12)))) for i in range(60)]
    check(spark.createDataFrame([(i, t, "s") for i, t in short], "doc_id long, text string, source string"))


def plain_verdicts(rows):
    """``(base_failed, removed_words, kept)`` of each row ``(text, host)``, in plain Python."""
    normal = lambda x: re.sub("[0-9]+", "0", re.sub(r"[\x20\x09-\x0D]+", " ", x.lower())).strip(" ")
    holders, hosts = {}, {}
    for text, host in rows:
        hosts.setdefault(host, set()).add(text or "")
        for x in (text or "").split("\n"):
            if normal(x):
                holders.setdefault((host, normal(x)), set()).add(text or "")
    often = {k for k, v in holders.items() if len(v) >= 20 or len(v) >= 5 and len(v) > 0.1 * len(hosts[k[0]])}
    out = []
    for text, host in rows:
        n, _, _, _, repeated = plain(text)
        gone = sum(len(normal(x).split(" ")) for x in (text or "").split("\n") if (host, normal(x)) in often)
        failed = n < 50 or 100 * repeated > 50 * n
        out.append((failed, gone, not failed and n - gone >= 0.3 * n and n - gone >= 50))
    return out


def test_verdicts_equal_plain_python_and_lines_deplete_documents_of_the_tables(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    rows = docs.select("doc_id", "text", "source").collect()
    want = {r["doc_id"]: v for r, v in zip(rows, plain_verdicts([(r["text"], r["source"]) for r in rows]))}
    got = {r["doc_id"]: (r["base_failed"], r["removed_words"], r["kept"]) for r in quality.judge(docs).collect()}
    assert got == want
    depleted = [k for k, (failed, gone, kept) in got.items() if gone and not failed and not kept]
    assert 0 < len(depleted) < 0.01 * len(got)


def test_frequent_lines_deplete_documents(spark):
    rnd = random.Random(4)
    word = lambda: "".join(rnd.choice("abcdefghij") for _ in range(6))
    line = " ".join(word() for _ in range(60))
    own = lambda n: " ".join(word() for _ in range(n))
    rows = [(i, f"{line}\n{own(5)}", "hot") for i in range(40)]             # depleted
    rows += [(100 + i, f"{line.upper()}\n{own(100)}", "hot") for i in range(5)]  # enough remains
    rows += [(200 + i, f"{line}\n{own(4)}", "other") for i in range(3)]     # rare on its host
    copy = own(80)
    rows += [(300 + i, copy, "hot") for i in range(60)]                     # copies are one document
    got = {r["doc_id"]: r["kept"] for r in quality.judge(
        spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()}
    assert not any(got[i] for i in range(40))
    assert all(v for i, v in got.items() if i >= 100)


def test_limit_acts_alike_on_large_and_small_hosts(spark):
    rnd = random.Random(6)
    own = lambda n: " ".join("".join(rnd.choice("abcdefghij") for _ in range(6)) for _ in range(n))
    templates = [own(60) for _ in range(12)]    # each in 25 of 300 documents: less than a tenth
    rows = [(i, f"{templates[i % 12]}\n{own(6)}", "large") for i in range(300)]
    rows += [(1000 + i, f"{templates[0]}\n{own(6)}" if i < 11 else own(70), "small") for i in range(50)]
    rows += [(2000 + i, f"{templates[1]}\n{own(6)}" if i < 4 else own(70), "few") for i in range(30)]
    got = {r["doc_id"]: r["kept"] for r in quality.judge(
        spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()}
    assert not any(got[i] for i in [*range(300), *range(1000, 1011)])
    assert all(got[i] for i in [*range(1011, 1050), *range(2000, 2030)])
