"""Suffix-array dedup: bytes that a string of ``WINDOW`` bytes covers which also starts anywhere else.

1. Every window has an anchor: of the ``GRAM``-byte strings in it, the one of least hash, the leftmost if tied. Equal
   windows have equal anchors at equal places, so only windows with the same anchor need be compared. The windows of one
   anchor are a run of starts; its bytes, from the first start to the last window's end, are its context.
2. Anchors that occur once are done. Occurrences with equal contexts are counted by digest: all their bytes repeat.
3. Where an anchor has several contexts, one copy of each is sent to the anchor's task, which sorts the suffixes that
   start in them: multikey quicksort over 8-byte characters to a shallow depth, then a blind trie for each group that
   still ties. Suffixes that share ``WINDOW`` bytes end in one leaf; leaves of two or more are repeats.
4. An anchor with more than ``HOT`` contexts (a line that a third of all documents share) would fill one task. Its
   windows are dealt out by the digest of the whole window instead and counted there, which finds the same repeats.
5. Repeated windows become spans of each document that has them, and the rest of its bytes is kept.

Texts are never sent to one place: they are joined with spans by document. Digests have 64 bits each; an equal context
or window needs the anchor's digest and its own to agree.

Defined results: a null text has no bytes; one of fewer than ``WINDOW`` bytes keeps all. Rows are documents of their
own, so a repeated row of ``WINDOW`` bytes or more loses all its bytes, in each copy.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from edilake.llm import tokens
from edilake.llm.io import keep

WINDOW, GRAM, HOT = 200, 32, 2000
SHALLOW = 24
PIECE = 1 << 17
SORT_AT = 1 << 15


def anchored_runs(text: bytes, window: int = WINDOW, gram: int = GRAM):
    """For each run of window starts with one anchor: the anchor's digest, the context's digest, first and last start."""
    out = []
    reach = window - gram + 1
    for at in range(0, len(text) - window + 1, PIECE):
        buf = np.frombuffer(text, np.uint8, min(PIECE + window - 1, len(text) - at), at)
        sums, inverse = tokens.prefix_sums(buf), tokens.powers(len(buf) + 1)[1]
        m = len(buf) - gram + 1
        with np.errstate(over="ignore"):
            grams = tokens.mix((sums[gram:] - sums[:m]) * inverse[:m])
        keys = np.full(-(-m // reach) * reach, np.iinfo(np.uint64).max, np.uint64)
        keys[:m] = (grams & np.uint64(~0xFFFFF & 0xFFFFFFFFFFFFFFFF)) | np.arange(m, dtype=np.uint64)
        rows = keys.reshape(-1, reach)
        ahead = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
        behind = np.minimum.accumulate(rows, axis=1).ravel()
        n = len(buf) - window + 1
        place = (np.minimum(ahead[:n], behind[reach - 1:reach - 1 + n]) & np.uint64(0xFFFFF)).astype(np.int64)
        first = np.flatnonzero(np.concatenate((np.ones(1, bool), place[1:] != place[:-1])))
        last = np.append(first[1:], n) - 1
        with np.errstate(over="ignore"):
            context = tokens.mix((sums[last + window] - sums[first]) * inverse[first]
                                 + (last - first).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + (place[first] - first).astype(np.uint64))
        out.append((grams[place[first]], context, first + at, last + at))
    return [np.concatenate(x) for x in zip(*out, strict=True)] if out else [np.zeros(0, np.uint64)] * 2 + [np.zeros(0, np.int64)] * 2


class Node:
    __slots__ = ("depth", "kids")

    def __init__(self, depth: int, kids: dict):
        self.depth, self.kids = depth, kids


def common_prefix(data: bytes, x: int, y: int, depth: int) -> int:
    a, b = data[x:x + depth], data[y:y + depth]
    if a == b:
        return depth
    return (8 * depth - (int.from_bytes(a) ^ int.from_bytes(b)).bit_length()) // 8


def blind_trie(data: bytes, starts: list[int], depth: int) -> list[list[int]]:
    """Suffixes in order, those equal to ``depth`` together. A suffix goes down by the characters at branching depths
    only, is compared once with the leaf it comes to, and branches off where they differ."""
    root: Node | list[int] = [starts[0]]
    for x in starts[1:]:
        node = root
        while isinstance(node, Node):
            node = node.kids.get(data[x + node.depth]) or next(iter(node.kids.values()))
        y = node[0]
        shared = common_prefix(data, x, y, depth)
        if shared == depth:
            node.append(x)
            continue
        parent, node = None, root
        while isinstance(node, Node) and node.depth < shared:
            parent, node = node, node.kids[data[x + node.depth]]
        if isinstance(node, Node) and node.depth == shared:
            node.kids[data[x + shared]] = [x]
            continue
        branch = Node(shared, {data[x + shared]: [x], data[y + shared]: node})
        if parent is None:
            root = branch
        else:
            parent.kids[data[x + parent.depth]] = branch
    out, stack = [], [root]
    while stack:
        node = stack.pop()
        if isinstance(node, Node):
            stack.extend(node.kids[c] for c in sorted(node.kids, reverse=True))
        else:
            out.append(node)
    return out


def deep_shallow_sort(data: bytes, starts: np.ndarray, depth: int, shallow: int = SHALLOW) -> list[list[int]]:
    """Suffixes of ``data`` in the order of their first ``depth`` bytes, equal ones together."""
    bytes_ = np.frombuffer(data + bytes(8), np.uint8)

    def characters(at):
        return bytes_[at[:, None] + np.arange(8)].view(">u8")[:, 0].astype(np.uint64)

    out, stack = [], [(np.asarray(starts, np.int64), 0)]
    while stack:
        own, d = stack.pop()
        if len(own) == 1:
            out.append([int(own[0])])
        elif d >= min(shallow, depth - 7):
            out.extend(blind_trie(data, own.tolist(), depth))
        elif len(own) <= SORT_AT:
            # a part that fits the cache: all its groups go through a character together
            group = np.zeros(len(own), np.int64)
            for at in range(d, min(shallow, depth - 7), 8):
                key = characters(own + at)
                order = np.lexsort((key, group))
                own, key, group = own[order], key[order], group[order]
                group = np.concatenate((np.zeros(1, np.int64), np.cumsum((key[1:] != key[:-1]) | (group[1:] != group[:-1]))))
            edges = [0, *(np.flatnonzero(group[1:] != group[:-1]) + 1).tolist(), len(own)]
            members = own.tolist()
            for x, y in zip(edges, edges[1:]):
                if y - x == 1:
                    out.append(members[x:y])
                else:
                    out.extend(blind_trie(data, members[x:y], depth))
        else:
            key = characters(own + d)
            pivot = np.sort(key[[0, len(key) // 2, -1]])[1]
            for part, step in ((own[key > pivot], 0), (own[key == pivot], 8), (own[key < pivot], 0)):
                if len(part):
                    stack.append((part, d + step))
    return out


def _shared(values: np.ndarray) -> np.ndarray:
    """Whether each value is there more than once."""
    ordered = np.sort(values)
    again = ordered[1:][ordered[1:] == ordered[:-1]]
    if not len(again):
        return np.zeros(len(values), bool)
    # most values that are there once fall into a slot that no repeated one has
    slots = np.zeros(1 << 16, bool)
    slots[again >> np.uint64(48)] = True
    out = slots[values >> np.uint64(48)]
    at = np.flatnonzero(out)
    place = np.minimum(np.searchsorted(again, values[at]), len(again) - 1)
    out[at] = again[place] == values[at]
    return out


RANGES = pa.list_(pa.struct([("lo", pa.int32()), ("hi", pa.int32())]))
FOUND = "anchor bigint, context bigint, ranges array<struct<lo:int,hi:int>>"


def sorted_contexts(contexts: DataFrame, window: int) -> DataFrame:
    """The repeated ranges of each (anchor, context, bytes), by suffix sorting within each anchor."""
    def solve(rows):
        data, begins = b"".join(b for _, _, b in rows), np.cumsum([0, *(len(b) for _, _, b in rows)])
        starts = np.concatenate([np.arange(a, b - window + 1) for a, b in zip(begins[:-1], begins[1:], strict=True)])
        # most windows differ by digest from all others; the sort is for the rest
        sums, inverse = tokens.prefix_sums(np.frombuffer(data, np.uint8)), tokens.powers(len(data) + 1)[1]
        with np.errstate(over="ignore"):
            digest = (sums[starts + window] - sums[starts]) * inverse[starts]
        starts = starts[_shared(digest)]
        if not len(starts):
            return []
        # a window can only equal one of the same anchor, and those have it at the same place
        twice = np.sort(np.array([x for leaf in deep_shallow_sort(data, starts, window) if len(leaf) > 1 for x in leaf], np.int64))
        if not len(twice):
            return []
        owner = np.searchsorted(begins, twice, side="right") - 1
        cut = np.flatnonzero((np.diff(twice) > window) | (np.diff(owner) > 0)) + 1
        first, last = np.concatenate(([0], cut)), np.append(cut, len(twice)) - 1
        found: dict[int, list[dict]] = {}
        for i, lo, hi in zip(owner[first].tolist(), (twice[first] - begins[owner[first]]).tolist(), (twice[last] - begins[owner[last]] + window).tolist(), strict=True):
            found.setdefault(i, []).append({"lo": lo, "hi": hi})
        return [(rows[i][0], rows[i][1], o) for i, o in found.items()]

    def run(batches):
        held, size, last = [], 0, None

        def flush(rows):
            found = solve(rows)
            return pa.RecordBatch.from_arrays([pa.array([f[0] for f in found], pa.int64()), pa.array([f[1] for f in found], pa.int64()),
                                               pa.array([f[2] for f in found], RANGES)], ["anchor", "context", "ranges"])

        for batch in batches:
            for anchor, context, data in zip(*(batch.column(c).to_pylist() for c in ("anchor", "context", "data")), strict=True):
                if last == (anchor, context):
                    continue  # the same context, from a repeated row
                if size > 1_000_000 and last[0] != anchor:
                    yield flush(held)
                    held, size = [], 0
                held.append((anchor, context, data))
                size += len(data)
                last = (anchor, context)
        if held:
            yield flush(held)

    return contexts.repartition("anchor").sortWithinPartitions("anchor", "context").mapInArrow(run, FOUND)


def repeated_spans(docs: DataFrame, window: int = WINDOW, gram: int = GRAM, hot: int = HOT) -> DataFrame:
    """doc_id, key (digest of the text), spans (array of lo, hi): the byte ranges of each document to remove, which may
    overlap. Documents without any are left out."""
    def runs(batches):
        for batch in batches:
            found = []
            for text in tokens.text_column(batch):
                a, c, s, e = anchored_runs(text, window, gram)
                found.append(pa.StructArray.from_arrays([pa.array(a.view(np.int64)), pa.array(c.view(np.int64)), pa.array(s.astype(np.int32)),
                                                         pa.array(e.astype(np.int32))], ["anchor", "context", "s", "e"]))
            ends = np.cumsum([0, *(len(f) for f in found)])
            flat = pa.concat_arrays(found) if found else pa.array([], pa.struct([]))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("key"), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), flat)],
                                             ["doc_id", "key", "runs"])

    id_type = docs.schema["doc_id"].dataType.simpleString()
    keyed = docs.select("doc_id", "text", F.md5("text").alias("key"))
    long_ = keyed.where(F.octet_length("text") >= window)
    first = keep(long_.mapInArrow(runs, f"doc_id {id_type}, key string, runs array<struct<anchor:bigint,context:bigint,s:int,e:int>>")
                 .withColumn("row", F.monotonically_increasing_id()), "runs")
    occurs = first.select("row", F.explode("runs").alias("r")).select("row", "r.*")
    anchors = occurs.groupBy("anchor").agg(F.count("*").alias("n"), (F.min("context") != F.max("context")).alias("several")).where("n > 1").drop("n")
    occurs = keep(occurs.join(anchors, "anchor"), "occurs")
    pairs = keep(occurs.groupBy("anchor", "context").agg(F.count("*").alias("n"), F.first("several").alias("several"),
                                                         F.min(F.struct("row", "s", "e")).alias("one")), "pairs")
    whole = pairs.where("n > 1").select("anchor", "context", F.array(F.struct(F.lit(0).alias("lo"), (F.col("one.e") - F.col("one.s") + window).cast("int").alias("hi"))).alias("ranges"))
    width = pairs.where("several").groupBy("anchor").agg(F.count("*").alias("n_contexts"))
    asked = (pairs.where("several").join(width, "anchor").select(F.col("one.row").alias("row"), F.struct(
        "anchor", "context", "one.s", "one.e", (F.col("n_contexts") > hot).alias("hot"), (F.col("n") > 1).alias("whole")).alias("a"))
        .groupBy("row").agg(F.collect_list("a").alias("asked")).join(first.select("row", "doc_id", "key"), "row").drop("row"))
    source = keyed.join(asked, keyed["key"].eqNullSafe(asked["key"]) & keyed["doc_id"].eqNullSafe(asked["doc_id"])).select("text", "asked")

    def cut(batches):
        for batch in batches:
            rows = [(a["anchor"], a["context"], t[a["s"]:a["e"] + window], a["hot"], a["whole"])
                    for t, asked in zip(tokens.text_column(batch), batch.column("asked").to_pylist(), strict=True) for a in asked]
            for x in range(0, len(rows), 20_000):
                cols = list(zip(*rows[x:x + 20_000], strict=True))
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, (pa.int64(), pa.int64(), pa.binary(), pa.bool_(), pa.bool_()), strict=True)],
                                                 ["anchor", "context", "data", "hot", "whole"])

    contexts = keep(source.mapInArrow(cut, "anchor bigint, context bigint, data binary, hot boolean, whole boolean"), "contexts")

    def windows(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part, a, c, o, h = batch.slice(at, 500), [], [], [], []
                for anchor, context, data in zip(*(part.column(x).to_pylist() for x in ("anchor", "context", "data")), strict=True):
                    sums = tokens.prefix_sums(np.frombuffer(data, np.uint8))
                    n = len(data) - window + 1
                    with np.errstate(over="ignore"):
                        h.append(tokens.mix((sums[window:] - sums[:n]) * tokens.powers(n)[1][:n]))
                    a.append(np.full(n, anchor))
                    c.append(np.full(n, context))
                    o.append(np.arange(n, dtype=np.int32))
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in (a, c, o)] + [pa.array(np.concatenate(h).view(np.int64))],
                                                 ["anchor", "context", "at", "digest"])

    dealt = contexts.where("hot").drop("hot", "whole").distinct().mapInArrow(windows, "anchor bigint, context bigint, at int, digest bigint")
    twice = dealt.groupBy("anchor", "digest").agg(F.count("*").alias("n")).where("n > 1").drop("n")
    from_hot = (dealt.join(twice, ["anchor", "digest"]).groupBy("anchor", "context")
                .agg(F.collect_set(F.struct(F.col("at").alias("lo"), (F.col("at") + window).alias("hi"))).alias("ranges")))
    from_sort = sorted_contexts(contexts.where("NOT hot").select("anchor", "context", "data"), window)
    others = from_sort.unionByName(from_hot).join(whole.select("anchor", "context"), ["anchor", "context"], "left_anti")
    ranges = whole.unionByName(others).withColumn("ranges", F.col("ranges").cast("array<struct<lo:int,hi:int>>"))
    spans = (occurs.join(ranges, ["anchor", "context"]).select("row", F.explode("ranges").alias("r"), "s")
             .select("row", F.struct((F.col("s") + F.col("r.lo")).alias("lo"), (F.col("s") + F.col("r.hi")).alias("hi")).alias("span"))
             .groupBy("row").agg(F.collect_list("span").alias("spans")))
    return spans.join(first.select("row", "doc_id", "key"), "row").drop("row").dropDuplicates(["doc_id", "key"])


def merged(spans: list[dict], n: int) -> list[tuple[int, int]]:
    """Maximal runs of removed bytes."""
    out: list[list[int]] = []
    for lo, hi in sorted((s["lo"], s["hi"]) for s in spans):
        if out and lo <= out[-1][1]:
            out[-1][1] = max(out[-1][1], hi)
        else:
            out.append([lo, hi])
    return [(a, min(b, n)) for a, b in out]


def remove_repeats(docs: DataFrame, window: int = WINDOW, gram: int = GRAM, hot: int = HOT) -> DataFrame:
    """doc_id, removed (array of lo, hi: maximal removed byte runs), n_bytes, rest (the remaining bytes)."""
    spans = keep(repeated_spans(docs, window, gram, hot), "spans")
    keyed = docs.select("doc_id", "text", F.md5("text").alias("key"))
    joined = keyed.join(spans, keyed["key"].eqNullSafe(spans["key"]) & keyed["doc_id"].eqNullSafe(spans["doc_id"]), "left").select(keyed["doc_id"], "text", "spans")

    def run(batches):
        for batch in batches:
            texts = tokens.text_column(batch)
            removed = [merged(s or [], len(t)) for t, s in zip(texts, batch.column("spans").to_pylist(), strict=True)]
            rest = [b"".join(t[a:b] for a, b in zip([0, *(hi for _, hi in r)], [*(lo for lo, _ in r), len(t)], strict=True)) for t, r in zip(texts, removed, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array([len(t) for t in texts], pa.int64()),
                                              pa.array([[{"lo": a, "hi": b} for a, b in r] for r in removed], RANGES), pa.array(rest, pa.binary())],
                                             ["doc_id", "n_bytes", "removed", "rest"])

    id_type = docs.schema["doc_id"].dataType.simpleString()
    return joined.mapInArrow(run, f"doc_id {id_type}, n_bytes bigint, removed array<struct<lo:int,hi:int>>, rest binary")


def digests(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256."""
    return remove_repeats(docs).select(
        "doc_id", "n_bytes", (F.col("n_bytes") - F.octet_length("rest")).cast("bigint").alias("n_removed"),
        F.size("removed").cast("bigint").alias("n_spans"), F.sha2("rest", 256).alias("kept_sha256"))
