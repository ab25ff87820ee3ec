"""SimHash fingerprints and the trie join against brute force."""

import re

import numpy as np
import pytest
import xxhash

from edilake.llm import simhash
from edilake.llm.components import components


def fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate({65 + i: 97 + i for i in range(26)}))
    hashes = [xxhash.xxh64_intdigest(" ".join(words[i:i + 4]).encode(), 42) for i in range(max(1, len(words) - 3))] if words else []
    return sum(1 << k for k in range(64) if 2 * sum(h >> k & 1 for h in hashes) > len(hashes))


def groups(values, most=4):
    """The smallest place in reach of each value."""
    v, low = np.array(values, np.uint64), np.arange(len(values))
    near = [np.flatnonzero(np.bitwise_count(v ^ x) <= most) for x in v]
    while True:
        new = np.array([low[n].min() for n in near], np.int64)
        new = new[new] if len(new) else new
        if (new == low).all():
            return low.tolist()
        low = new


def linked(rows):
    ids = [r.doc_id for r in rows]
    fps = [fingerprint(r.text) for r in rows]
    low = groups(fps)
    first = {}
    for i, g in zip(ids, low, strict=True):
        if i is not None:
            first[g] = min(i, first.get(g, i))
    return sorted((str(i), f"{f:016x}", first.get(g)) for i, f, g in zip(ids, fps, low, strict=True))


@pytest.mark.parametrize("name", ["documents", "hard", "none"])
def test_against_brute_force(request, name):
    docs = request.getfixturevalue(name)
    got = sorted((str(r.doc_id), r.fingerprint, r.component_id) for r in simhash.linked(docs).collect())
    assert got == linked(docs.collect())


def planted(seed):
    """Values with others at 1 to 6 bits, a dense ball, and the extremes; differences lie in either half or both."""
    rng = np.random.default_rng(seed)
    base = [int(x) for x in rng.integers(0, 1 << 63, 120)]
    flip = lambda v, bits: v ^ sum(1 << int(b) for b in bits)
    out = {0, (1 << 64) - 1, *base}
    for v in base:
        for k in range(1, 7):
            out.add(flip(v, rng.choice(64, k, replace=False)))
            out.add(flip(v, rng.choice(32, k, replace=False)))
            out.add(flip(v, 32 + rng.choice(32, k, replace=False)))
    out |= {flip(base[0], rng.choice(64, int(rng.integers(0, 8)), replace=False)) for _ in range(500)}
    return sorted(out)


@pytest.mark.parametrize("unit", [1 << 20, 256, 8])
def test_join_at_any_unit(spark, unit):
    """The components don't depend on how far the tables carry the traversal; small units cut the dense ball to the end."""
    values = planted(unit)[:1200] if unit == 8 else planted(unit)
    table = spark.createDataFrame([(int(np.uint64(v).view(np.int64)),) for v in values], "fp bigint")
    label = {r.node: r.label for r in components(simhash.near_links(table, 4, unit)).collect()}
    seen, back = {}, {}
    for v, g in zip(values, groups(values), strict=True):
        own = label.get(int(np.uint64(v).view(np.int64)), v)
        assert seen.setdefault(g, own) == own and back.setdefault(own, g) == g


def test_traversal_finds_every_pair():
    values = np.array(planted(3), np.uint64)
    for most in (0, 1, 3, 4):
        found = set()
        for turn in (0, 1):
            own = np.sort(values if turn == 0 else (values << np.uint64(32)) | (values >> np.uint64(32)))
            for i, j in simhash.traverse(own, own, 0, 0, turn, most, True):
                for x, y in zip(own[i].tolist(), own[j].tolist(), strict=True):
                    pair = [v if turn == 0 else (v << 32 | v >> 32) & (1 << 64) - 1 for v in (x, y)]
                    found.add((min(pair), max(pair)))
        want = {(x, y) for k, x in enumerate(values.tolist()) for y in values[k + 1:][np.bitwise_count(values[k + 1:] ^ np.uint64(x)) <= most].tolist()}
        assert found == want


def test_pieces_do_not_matter(monkeypatch):
    text = (" ".join(f"w{i * i % 997}" for i in range(5000)) + "\n" + "z" * 900 + "\t end of it").encode()
    whole = simhash.fingerprint(text)
    for size in (50, 333, 4096):
        monkeypatch.setattr(simhash, "PIECE", size)
        assert simhash.fingerprint(text) == whole == fingerprint(text.decode())
