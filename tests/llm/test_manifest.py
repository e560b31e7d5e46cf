"""The Merkle manifest against a tree that is built whole in Python."""

import zlib
from hashlib import sha256

import pytest
from pyspark.sql import functions as F

from cellweave.llm.manifest import manifest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def digest(s):
    return sha256(s.encode()).hexdigest()


def leaf(doc_id, source, lang, n_chars, text):
    parts = ("-" if f is None else f"{len(str(f).encode())}:{f}" for f in (doc_id, source, lang, n_chars, text))
    return digest("".join(parts))


def climb(nodes):
    """Root of a tree, and the (level by level) runs of every leaf with its place in them."""
    trails = [[] for _ in nodes]
    at = list(range(len(nodes)))
    while len(nodes) > 1:
        for i, p in enumerate(at):
            first = p // 16 * 16
            trails[i].append((p - first, nodes[first : first + 16]))
        nodes = [digest("".join(nodes[i : i + 16])) for i in range(0, len(nodes), 16)]
        at = [p // 16 for p in at]
    return nodes[0], trails


def whole(rows):
    """All result rows; rows are (doc_id, text, lang, source, n_chars)."""
    sources = {}
    for doc_id, text, lang, source, n in rows:
        sources.setdefault(source, []).append((doc_id is not None, doc_id or 0, leaf(doc_id, source, lang, n, text), doc_id, text, lang, n))
    names = sorted(sources, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for s in names:
        sources[s].sort(key=lambda r: r[:3])
        trees[s] = climb([r[2] for r in sources[s]])
    root, upper = climb([trees[s][0] for s in names])
    out = []
    for s, top in zip(names, upper, strict=True):
        for (_, _, d, doc_id, text, lang, n), trail in zip(sources[s], trees[s][1], strict=True):
            x = d
            if doc_id is not None and zlib.crc32(str(doc_id).encode()) % 5 == 0 and text is not None:
                x = leaf(doc_id, s, lang, n, "".join(c.lower() if "A" <= c <= "Z" else c for c in text))
            proof = ""
            for at, run in trail + top:
                proof += "".join(run[:at] + run[at + 1 :])
                x = digest("".join(run[:at] + [x] + run[at + 1 :]))
            out.append((doc_id, d, trees[s][0], root, digest(proof), x, x == root))
    return out


def check(spark, rows):
    df = spark.createDataFrame(rows, DOCS).repartition(5)
    for c in ("tree", "pos", "part", "digest", "tie", "leaf", "path"):
        df = df.withColumn(c, F.lit(c))
    found = [tuple(r) for r in manifest(df).collect()]
    assert sorted(found, key=str) == sorted(whole(rows), key=str)


@pytest.mark.parametrize("n", [1, 2, 16, 17, 256, 257, 4099])
def test_sizes_of_one_source(spark, n):
    check(spark, [(i * 7 % n, f"Text {i} Ñ", "en", "s", i) for i in range(n)])


def test_many_sources(spark):
    check(spark, [(i, f"Text {i}", "en", f"s{i % 300}" if i % 3 else "hot", i) for i in range(1500)])


def test_nulls_repeats_and_empty_texts(spark):
    rows = [(None, None, None, None, None)] * 2 + [(5, "", "en", "", 0), (5, None, "en", "", 0), (5, "A", "en", "é", 1)]
    check(spark, rows + [(7, "Same Text", "en", "s", 9)] * 40 + [(8, "B" * 200_000, None, "s", 1), (9, "x", "en", None, 1)])


def test_empty_table(spark):
    assert manifest(spark.createDataFrame([], DOCS)).collect() == []


def test_changed_rows_fail_and_others_hold(spark):
    found = manifest(spark.createDataFrame([(i, "ABC", "en", "s", 3) for i in range(100)], DOCS)).collect()
    assert {r.doc_id for r in found if not r.verified} == {i for i in range(100) if zlib.crc32(str(i).encode()) % 5 == 0}
