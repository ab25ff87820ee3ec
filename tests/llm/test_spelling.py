"""Spelling variants against brute force and SQL."""

import re
import zlib
from collections import Counter

import pytest

from edilake.llm import spelling


def near(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    short, long_ = sorted((a, b), key=len)
    return any(long_[:i] + long_[i + 1:] == short for i in range(len(long_)))


def expected(counts):
    out = {}
    for w, n in counts.items():
        others = [x for x in counts if near(w, x)]
        best = min(others, key=lambda x: (-counts[x], x), default=None)
        form = best if best is not None and counts[best] >= 10 * n else None
        out[w] = (form, n, len(others), counts[form] if form else None)
    rows = []
    for w, (form, n, k, m) in out.items():
        root = w
        while out[root][0]:
            root = out[root][0]
        rows.append((w, form, root, n, k, m))
    return sorted(rows, key=str)


def words_of(rows):
    total = Counter()
    for r in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", r.text or ""):
            run = run.translate({65 + i: 97 + i for i in range(26)})
            h = zlib.crc32(f"{'' if r.doc_id is None else r.doc_id}:{run}".encode())
            total[run[:h % len(run)] + run[h % len(run) + 1:] if h % 31 == 0 else run] += 1
    return {w: n for w, n in total.items() if len(w) >= 7 and n >= 2}


def rows_of(df):
    return sorted(((r.word, r.form, r.root, r.n, r.n_near, r.form_n) for r in df.collect()), key=str)


@pytest.mark.parametrize("name", ["hard", "none"])
def test_against_brute_force(request, name):
    docs = request.getfixturevalue(name)
    assert rows_of(spelling.spelling(docs)) == expected(words_of(docs.collect()))


@pytest.mark.parametrize("block", [2, 8, 256])
def test_any_block_size(spark, block):
    """Groups are halved until they fit; chains of forms, edits at both ends, runs of one letter, non-Latin letters."""
    counts = {"reading": 10_000, "readings": 900, "readingss": 80, "readingsss": 5, "xeading": 3, "readinx": 2, "reaдing": 7,
              "aaaaaaa": 50, "aaaaaaaa": 400, "aaaaaab": 400, "baaaaaa": 3, "aaabaaa": 4, "a" * 300: 9, "a" * 299 + "b": 90, "a" * 301: 91}
    counts |= {f"common{c}{d}": 2 + ord(c) * ord(d) % 50 for c in "abcdefghijklmnop" for d in "abcdefghij"}
    got = rows_of(spelling.variants(spark.createDataFrame(list(counts.items()), "word string, n bigint"), block=block))
    assert got == expected(counts)


def test_no_large_group_is_left(spark):
    """A family of one beginning and end is dealt to groups of the block size, not compared all with all."""
    words = [("begin" + f"{i:04d}".translate({48 + k: 97 + k for k in range(10)}) + "end", 2) for i in range(3000)]
    sizes = spelling.blocks(spark.createDataFrame(words, "word string, n bigint"), 64).groupBy("key").count()
    assert sizes.agg({"count": "max"}).first()[0] <= 64
