"""The manifest against SQL and a tree built in plain Python."""

import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from edilake.llm import merkle


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf_of(r, text):
    values = [r.doc_id, r.source, r.lang, r.n_chars, text]
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def climb(leaves):
    """(top, path of each leaf) of one tree."""
    level, paths, at = leaves, [[] for _ in leaves], list(range(len(leaves)))
    while len(level) > 1:
        for k, p in enumerate(at):
            first = p // 16 * 16
            paths[k].append((level[first:p], level[p + 1:first + 16]))
        level = [sha("".join(level[i:i + 16])) for i in range(0, len(level), 16)]
        at = [p // 16 for p in at]
    return level[0] if level else None, paths


def expected(rows):
    tree, by_source = [], {}
    for r in rows:
        by_source.setdefault((r.source is not None, (r.source or "").encode()), []).append(r)
    for key in sorted(by_source):
        own = sorted(by_source[key], key=lambda r: (r.doc_id is not None, r.doc_id or 0, leaf_of(r, r.text)))
        tree.append((own, *climb([leaf_of(r, r.text) for r in own])))
    root, above = climb([top for _, top, _ in tree])
    out = []
    for (own, top, paths), upper in zip(tree, above, strict=True):
        for r, path in zip(own, paths, strict=True):
            tampered = r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 5 == 0 and r.text is not None
            d = leaf_of(r, r.text.translate({65 + i: 97 + i for i in range(26)}) if tampered else r.text)
            for left, right in path + upper:
                d = sha("".join([*left, d, *right]))
            proof = sha("".join(x for left, right in path + upper for x in left + right))
            out.append((r.doc_id, leaf_of(r, r.text), top, root, proof, d, d == root))
    return sorted(out, key=str)


def rows_of(df):
    got = merkle.verified(df, F.crc32(F.col("doc_id").cast("string")) % 5 == 0)
    assert got.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    return sorted(map(tuple, got.collect()), key=str)


@pytest.mark.parametrize("name", ["hard", "none"])
def test_against_plain_tree(request, name):
    docs = request.getfixturevalue(name)
    assert rows_of(docs) == expected(docs.collect())


@pytest.mark.parametrize("n", [1, 16, 17, 257, 4097])
def test_heights(make, n):
    """Trees of one to four levels beside small ones, a hot source, and a row that is there many times."""
    rows = [(i, f"Text {i}", "hot") for i in range(n)] + [(10_000 + i, "T", f"s{i}") for i in range(18)] + [(7, "Same", "many")] * 40
    docs = make(rows)
    assert rows_of(docs) == expected(docs.collect())


def test_one_source(make):
    docs = make([(i, f"Text {i}") for i in range(3)])
    got = rows_of(docs)
    assert got == expected(docs.collect()) and all(r[2] == r[3] for r in got) and not all(r[6] for r in rows_of(make([(i, "A") for i in range(30)])))
