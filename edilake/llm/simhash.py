"""SimHash near-dedup: 64-bit fingerprints, linked by a self-join of their binary trie.

A bit of a fingerprint is set if over half of the text's shingle hashes have it. Equal fingerprints are one entry. Two
fingerprints that differ in at most k bits differ in at most k div 2 of the first 32, or else in at most (k - 1) div 2 of
the last 32; so the trie is joined with itself twice, over the bits as they are and over the halves swapped, with that
smaller error budget for the first half of the way down.

The join traverses pairs of nodes together. A pair starts at the root; its children meet in pairs, add the bits in which
they differ, and are pruned when the budget is exceeded. The upper levels are tables: a node is a prefix and its count, and
a pair of nodes that together hold more than ``UNIT`` fingerprints is expanded by ``STEP`` bits with two joins, whichever
part of the trie they are in; so a dense region is cut as finely as it needs. Smaller pairs are one task's work each, on
two bounded arrays: the same traversal bit by bit, then the last few fingerprints directly. Of the links found in a pair,
a spanning forest leaves the task, which reaches the same fingerprints with fewer rows than fingerprints.

Defined results: a null or empty text, or one without words, has fingerprint zero and is linked like any other. A text of
fewer words than a shingle is one shingle. Texts of any length are hashed in pieces. Rows without a doc_id are linked like
others; a component of such rows only has no id. Repeated rows get the same values each.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from edilake.llm import tokens
from edilake.llm.components import components
from edilake.llm.io import keep, remove

BITS, HALF = 64, 32
UNIT, FIRST, STEP = 4096, 8, 4
LEAF_PAIRS, AT_ONCE = 256, 1 << 18
PIECE = 1 << 20
SEED = 42


def pieces(text: bytes) -> list[bytes]:
    """The text cut at blanks into pieces of about ``PIECE`` bytes; a longer word stays whole."""
    out, at = [], 0
    while len(text) - at > PIECE:
        cut = max(text.rfind(b, at + 1, at + PIECE) for b in (b" ", b"\n", b"\t", b"\r", b"\x0b", b"\x0c"))
        if cut <= at:
            ends = [e for b in (b" ", b"\n", b"\t", b"\r", b"\x0b", b"\x0c") if (e := text.find(b, at + PIECE)) >= 0]
            if not ends:
                break
            cut = min(ends)
        out.append(text[at:cut])
        at = cut
    return [*out, text[at:]]


def fingerprint(text: bytes, width: int = 4) -> int:
    """SimHash of the text's word shingles, repeats included."""
    ones, total, held = np.zeros(BITS, np.int64), 0, []
    for piece in pieces(text):
        words = [*held, *piece.lower().split()]
        held = words[-(width - 1):] if width > 1 else []
        if len(words) < width:
            continue
        hashes = _shingle_hashes(words, width)
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
        total += len(hashes)
    if not total and held:
        hashes = _shingle_hashes(held, len(held))
        ones, total = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64), 1
    return int.from_bytes(np.packbits(2 * ones > total).tobytes(), "big")


def _shingle_hashes(words: list[bytes], width: int) -> np.ndarray:
    """XXH64 of every run of ``width`` words, joined by spaces, as big-endian integers."""
    joined, digest = b" ".join(words), xxhash.xxh64_intdigest
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate((np.zeros(1, np.int64), ends[:-1] + 1))
    n = len(words) - width + 1
    spans = zip(starts[:n].tolist(), ends[width - 1:].tolist(), strict=True)
    return np.fromiter((digest(joined[s:e], SEED) for s, e in spans), ">u8", n)


def fingerprints(docs: DataFrame, width: int = 4, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id and ``fp``, the fingerprint as a 64-bit integer."""
    def run(batches):
        for batch in batches:
            own = [fingerprint(t, width) for t in tokens.text_column(batch)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(np.array(own, np.uint64).view(np.int64))], ["doc_id", "fp"])

    id_type = docs.schema[doc_id].dataType.simpleString()
    return docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).mapInArrow(run, f"doc_id {id_type}, fp bigint")


# ---------------------------------------------------------------------------------------------------------
# the join inside a task


def budget(depth: int, turn: int, most: int) -> int:
    """Bits that two fingerprints may differ in after ``depth`` bits: the turn's share within the first half."""
    return most if depth > HALF else (most // 2 if turn == 0 else (most - 1) // 2)


def traverse(a: np.ndarray, b: np.ndarray, depth: int, diff: int, turn: int, most: int, same: bool):
    """Pairs of places (in sorted ``a``, in sorted ``b``) of values within the error budget. All values of a side agree in
    the first ``depth`` bits, in which the sides differ by ``diff``. With ``same``, ``a`` is ``b`` and each pair comes once."""
    one = np.array
    stack = [(depth, one([0]), one([len(a)]), one([0]), one([len(b)]), one([diff]))]
    while stack:
        depth, a0, a1, b0, b1, d = stack.pop()
        if len(a0) > AT_ONCE:
            half = len(a0) // 2
            stack += [(depth, *(x[half:] for x in (a0, a1, b0, b1, d))), (depth, *(x[:half] for x in (a0, a1, b0, b1, d)))]
            continue
        small = ((a1 - a0) * (b1 - b0) <= LEAF_PAIRS) | (depth == BITS)
        if small.any():
            yield from _direct(a, b, *(x[small] for x in (a0, a1, b0, b1)), turn, most, same)
            a0, a1, b0, b1, d = (x[~small] for x in (a0, a1, b0, b1, d))
        if not len(a0):
            continue
        # the place in each node where the next bit turns to one
        bit = np.uint64(1) << np.uint64(BITS - 1 - depth)
        above = ~(bit | (bit - np.uint64(1)))
        am = np.searchsorted(a, (a[a0] & above) | bit)
        bm = am if same and a0 is b0 else np.searchsorted(b, (b[b0] & above) | bit)
        below = [(a0, am, b0, bm, d), (am, a1, bm, b1, d), (a0, am, bm, b1, d + 1), (am, a1, b0, bm, d + 1)]
        limit = budget(depth + 1, turn, most)
        keep_ = [(x1 > x0) & (y1 > y0) & (e <= limit) for x0, x1, y0, y1, e in below]
        if same:
            # a pair of a node with itself has its mixed children twice
            keep_[3] &= a0 != b0
        stack.append((depth + 1, *(np.concatenate([part[i][k] for part, k in zip(below, keep_, strict=True)]) for i in range(5))))


def _direct(a, b, a0, a1, b0, b1, turn, most, same):
    """The pairs of each small pair of nodes, compared value by value."""
    sizes = (a1 - a0) * (b1 - b0)
    total = np.cumsum(sizes)
    at = 0
    while at < len(sizes):
        to = max(at + 1, int(np.searchsorted(total, (total[at - 1] if at else 0) + 4 * AT_ONCE, side="right")))
        n = sizes[at:to]
        k = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        wide = np.repeat(b1[at:to] - b0[at:to], n)
        i, j = np.repeat(a0[at:to], n) + k // wide, np.repeat(b0[at:to], n) + k % wide
        at = to
        if same:
            i, j = i[i < j], j[i < j]
        x = a[i] ^ b[j]
        first = np.bitwise_count(x >> np.uint64(HALF))
        near = (np.bitwise_count(x) <= most) & (first <= budget(HALF, turn, most))
        if near.any():
            yield i[near], j[near]


def forest(n: int, links) -> tuple[np.ndarray, np.ndarray]:
    """Edges (place, representative) that join the same of ``n`` places as ``links`` do, fewer than ``n``."""
    label = np.arange(n)
    for i, j in links:
        while True:
            x, y = label[i], label[j]
            low, high = np.minimum(x, y), np.maximum(x, y)
            open_ = low < high
            if not open_.any():
                break
            i, j = i[open_], j[open_]
            np.minimum.at(label, high[open_], low[open_])
            while True:
                shorter = label[label]
                if (shorter == label).all():
                    break
                label = shorter
    moved = np.flatnonzero(label != np.arange(n))
    return moved, label[moved]


def unit_links(a: np.ndarray, b: np.ndarray, depth: int, diff: int, turn: int, most: int, same: bool) -> tuple[np.ndarray, np.ndarray]:
    """Links among the values of two trie nodes, as pairs of values that span what they connect."""
    a = np.sort(a)
    b = a if same else np.sort(b)
    values = a if same else np.concatenate((a, b))
    shift = 0 if same else len(a)
    x, y = forest(len(values), ((i, j + shift) for i, j in traverse(a, b, depth, diff, turn, most, same)))
    return values[x], values[y]


# ---------------------------------------------------------------------------------------------------------
# the join over the cluster


def prefix(value: Column, depth: int) -> Column:
    """The first ``depth`` bits as a number; 0 before the first."""
    return F.shiftrightunsigned(value, BITS - depth) if depth else F.lit(0).cast("bigint")


def node_pairs(entries: DataFrame, most: int, unit: int = UNIT) -> DataFrame:
    """turn, depth, a, b, diff: pairs of trie nodes (a <= b) that together hold all linked pairs of ``entries`` (turn, v),
    each with ``unit`` fingerprints at most or of full depth."""
    made = []

    def nodes(depth):
        return entries.groupBy("turn", prefix(F.col("v"), depth).alias("p")).agg(F.count("*").alias("n"))

    ready, depth, step = None, 0, FIRST
    root = nodes(0)
    pairs = root.select("turn", F.col("p").alias("a"), F.col("p").alias("b"), F.lit(0).alias("diff"),
                        F.col("n").alias("n_a"), F.col("n").alias("n_b"))
    while True:
        held = F.when(F.col("a") == F.col("b"), F.col("n_a")).otherwise(F.col("n_a") + F.col("n_b"))
        pairs = keep(pairs.withColumn("ready", (held <= unit) | F.lit(depth == BITS)), "node_pairs")
        made.append(pairs)
        done = pairs.where("ready").select("turn", F.lit(depth).alias("depth"), "a", "b", "diff")
        ready = done if ready is None else ready.unionByName(done)
        open_ = pairs.where("NOT ready")
        if depth == BITS or open_.isEmpty():
            out = keep(ready, "units")
            remove(*made)
            return out
        depth, step, before = depth + step, STEP, depth
        limit = F.lit(most) if depth > HALF else F.when(F.col("turn") == 0, budget(depth, 0, most)).otherwise(budget(depth, 1, most))
        children = keep(nodes(depth).withColumn("parent", F.shiftrightunsigned("p", depth - before) if before else F.lit(0).cast("bigint")), "nodes")
        made.append(children)
        side = lambda x: children.select("turn", F.col("parent").alias(x), F.col("p").alias(f"c_{x}"), F.col("n").alias(f"n_{x}"))
        both = open_.drop("n_a", "n_b", "ready").join(side("a"), ["turn", "a"]).join(side("b"), ["turn", "b"])
        differ = F.col("diff") + F.bit_count(F.col("c_a").bitwiseXOR(F.col("c_b")).bitwiseAND(F.lit((1 << (depth - before)) - 1)))
        pairs = (both.where((F.col("a") != F.col("b")) | (F.col("c_a") <= F.col("c_b")))
                 .select("turn", F.col("c_a").alias("a"), F.col("c_b").alias("b"), differ.cast("int").alias("diff"), "n_a", "n_b")
                 .where(F.col("diff") <= limit))


def near_links(values: DataFrame, most: int = 4, unit: int = UNIT) -> DataFrame:
    """(a, b): links that connect the distinct 64-bit ``values`` (fp) as all pairs that differ in at most ``most`` bits do."""
    swapped = F.shiftleft("fp", HALF).bitwiseOR(F.shiftrightunsigned("fp", HALF))
    entries = keep(values.select(F.inline(F.array(F.struct(F.lit(0).alias("turn"), F.col("fp").alias("v")),
                                                  F.struct(F.lit(1).alias("turn"), swapped.alias("v"))))), "entries")
    pairs = node_pairs(entries, most, unit)
    depths = sorted(r["depth"] for r in pairs.select("depth").distinct().collect())
    named = pairs.select("turn", "depth", F.explode(F.array("a", "b")).alias("p")).distinct()
    of_node = None
    for depth in depths:
        rows = entries.withColumns({"depth": F.lit(depth), "p": prefix(F.col("v"), depth)})
        of_node = rows if of_node is None else of_node.unionByName(rows)
    if of_node is None:
        return values.select(F.col("fp").alias("a"), F.col("fp").alias("b")).limit(0)
    # a node of a unit holds ``unit`` values at most, or one
    held = keep(of_node.join(named, ["turn", "depth", "p"], "left_semi").groupBy("turn", "depth", "p").agg(F.collect_list("v").alias("v")), "held")

    def run(batches):
        for batch in batches:
            column = {c: batch.column(c) for c in batch.schema.names}
            a, b = [], []
            for k in range(batch.num_rows):
                turn, depth, diff, same = (column[c][k].as_py() for c in ("turn", "depth", "diff", "same"))
                va = column["va"][k].values.to_numpy().view(np.uint64)
                vb = va if same else column["vb"][k].values.to_numpy().view(np.uint64)
                x, y = unit_links(va, vb, depth, diff, turn, most, same)
                if turn:
                    x, y = ((v << np.uint64(HALF)) | (v >> np.uint64(HALF)) for v in (x, y))
                a.append(x)
                b.append(y)
            if a:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(v).view(np.int64)) for v in (a, b)], ["a", "b"])

    same = F.col("a") == F.col("b")
    side = lambda x: held.select("turn", "depth", F.col("p").alias(x), F.col("v").alias(f"v{x}"))
    units = pairs.join(side("a"), ["turn", "depth", "a"]).join(side("b"), ["turn", "depth", "b"])
    found = units.select("turn", "depth", "diff", same.alias("same"), "va", F.when(~same, F.col("vb")).alias("vb"))
    links = keep(found.mapInArrow(run, "a bigint, b bigint").distinct(), "links")
    remove(entries, pairs, held)
    return links


def linked(docs: DataFrame, width: int = 4, most: int = 4, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id (the smallest doc_id in reach over links) of every row."""
    rows = keep(fingerprints(docs, width, doc_id, text), "fingerprints")
    classes = keep(rows.groupBy("fp").agg(F.min("doc_id").alias("first")), "classes")
    links = near_links(classes.select("fp"), most)
    labels = components(links)
    placed = classes.join(labels, F.col("fp") == F.col("node"), "left").select("fp", "first", F.coalesce("label", "fp").alias("label"))
    ids = placed.groupBy("label").agg(F.min("first").alias("component_id"))
    of_class = keep(placed.join(ids, "label").select("fp", "component_id"), "components")
    remove(classes, links, labels)
    return (rows.join(of_class, "fp")
            .select(F.col("doc_id").alias(doc_id), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"))
