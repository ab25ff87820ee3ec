"""Benchmark decontamination: rare n-gram seeds, then Smith-Waterman alignment.

How many documents hold each n-gram of the test items is counted over the whole corpus. Seeds of an item are its rare
n-grams and, so that no part of an item goes without one however often it was copied, the rarest of every ``block``
consecutive n-grams. Where a document holds a seed, the words around it are aligned with the item: a match scores 1, a
replaced, missing or added word costs a half. A score of ``threshold`` times the item's words or more is a leak, so a
copy with edited, dropped or added words is found as well as an exact one.

Items go to the workers in blocks of bounded size, one pass over the documents each; no join and no shuffle of texts.
Each task sends back one count per n-gram of the block that it holds.

Defined results: words are runs of letters and digits, A-Z lower-cased. Null or empty texts match nothing, nor do items
of fewer than ``n`` words. Repeated rows of either table are judged alike; equal items are all reported.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from edilake.llm import tokens

N = 3
BLOCK = 2
RARE = 0.0005
THRESHOLD = 0.5
GAP = 0.5
BLOCK_CHARS = 64_000_000


class Lookup:
    """Positions of hashes in a sorted list; a small bit map turns most other hashes away."""

    def __init__(self, values: np.ndarray):
        self.values = np.unique(values)
        self.map = np.zeros(1 << 20, bool)
        self.map[self.values >> np.uint64(44)] = True

    def find(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Indexes into ``hashes`` that are listed, and where."""
        maybe = np.flatnonzero(self.map[hashes >> np.uint64(44)])
        if not len(maybe) or not len(self.values):
            return maybe[:0], maybe[:0]
        at = np.minimum(np.searchsorted(self.values, hashes[maybe]), len(self.values) - 1)
        same = self.values[at] == hashes[maybe]
        return maybe[same], at[same]


@dataclass
class Items:
    ids: list
    words: list[np.ndarray]
    seeds: Lookup
    places: list[list[tuple[int, int]]]  # of each seed: (item, first word)


def align(item: np.ndarray, words: np.ndarray) -> tuple[float, int]:
    """Best local alignment score and the last word of ``words`` in it."""
    slope = GAP * np.arange(len(words) + 1)
    row, best, end = np.zeros(len(words) + 1), 0.0, -1
    for w in item:
        new = np.zeros(len(words) + 1)
        new[1:] = row[:-1] + np.where(words == w, 1.0, -GAP)
        np.maximum(new, row - GAP, out=new)
        row = np.maximum(np.maximum.accumulate(new + slope) - slope, 0)
        at = int(row.argmax())
        if row[at] > best:
            best, end = float(row[at]), at - 1
    return best, end


def matches(words: np.ndarray, items: Items, n: int, threshold: float, first_only: bool = False) -> list[tuple[int, float, int, int]]:
    """(item, score as a share of its words, first and last word of the passage) of each leaked item, best passage each."""
    at, seed = items.seeds.find(tokens.combine(words, n))
    hits: dict[int, set[int]] = {}
    for p, s in zip(at.tolist(), seed.tolist(), strict=True):
        for item, q in items.places[s]:
            hits.setdefault(item, set()).add(p - q)
    out = []
    for item, starts in sorted(hits.items()):
        own = items.words[item]
        reach = len(own) // 2 + 2
        best = (0.0, -1, -1)
        low = high = None
        for start in [*sorted(starts), None]:
            if low is not None and (start is None or start - reach > high):
                a, b = max(0, low), min(len(words), high)
                score, end = align(own, words[a:b])
                if score > best[0]:
                    back, rest = align(own[::-1], words[a:a + end + 1][::-1])
                    best = (score, a + end - rest, a + end)
                low = None
            if start is not None:
                low, high = start - reach if low is None else low, start + len(own) + reach
        if best[0] >= threshold * len(own):
            out.append((item, best[0] / len(own), best[1], best[2]))
            if first_only:
                break
    return out


def _documents(batch, text):
    """Word hashes of each document of a batch."""
    for group in tokens.chunks(tokens.text_column(batch, text), len):
        h, bounds = tokens.word_hashes(group, tokens.ALNUM)
        for a, b in zip(bounds[:-1], bounds[1:], strict=True):
            yield h[a:b]


def document_counts(docs: DataFrame, grams: np.ndarray, n: int, text: str = "text") -> tuple[np.ndarray, int]:
    """In how many documents each of the sorted n-gram hashes occurs, and the number of documents."""
    lookup = Lookup(grams)

    def run(batches):
        total, seen = np.zeros(len(lookup.values), np.int64), 0
        for batch in batches:
            seen += batch.num_rows
            for words in _documents(batch, text):
                _, at = lookup.find(tokens.combine(words, n))
                if len(at):
                    total[np.unique(at)] += 1
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array([-1, *held.tolist()], pa.int64()), pa.array([seen, *total[held].tolist()], pa.int64())],
                                         ["gram", "n"])

    found = docs.select(text).mapInArrow(run, "gram bigint, n bigint").groupBy("gram").agg(F.sum("n").alias("n")).toArrow()
    counts = dict(zip(found.column("gram").to_pylist(), found.column("n").to_pylist(), strict=True))
    n_docs = counts.pop(-1, 0)
    out = np.zeros(len(lookup.values), np.int64)
    out[list(counts)] = list(counts.values())
    return out, n_docs


def item_blocks(docs: DataFrame, benchmark: DataFrame, item_id: str = "item_id", text: str = "text", n: int = N,
                block: int = BLOCK, rare: float = RARE, block_chars: int = BLOCK_CHARS):
    """The test items with their seeds, in blocks of about ``block_chars`` characters."""
    items = benchmark.select(F.col(item_id).alias("id"), F.col(text).alias("text")).where(F.length("text") > 0)
    blocks = -(-(items.agg(F.sum(F.length("text"))).first()[0] or 0) // block_chars)
    for b in range(blocks):
        rows = items.where(F.pmod(F.xxhash64("text"), F.lit(blocks)) == b).orderBy("id", "text").collect()
        h, bounds = tokens.word_hashes([r["text"].encode() for r in rows], tokens.ALNUM)
        words = [h[x:y] for x, y in zip(bounds[:-1], bounds[1:], strict=True)]
        grams = [tokens.combine(w, n) for w in words]
        every = np.unique(np.concatenate(grams)) if grams else np.zeros(0, np.uint64)
        counts, n_docs = document_counts(docs, every, n)
        places: dict[int, list[tuple[int, int]]] = {}
        for i, g in enumerate(grams):
            df = counts[np.searchsorted(every, g)]
            chosen = set(np.flatnonzero(df <= max(1, rare * n_docs)).tolist())
            chosen |= {x + int(df[x:x + block].argmin()) for x in range(0, len(g), block)}
            for x in sorted(chosen):
                places.setdefault(int(g[x]), []).append((i, x))
        seeds = Lookup(np.array(sorted(places), np.uint64))
        yield Items([r["id"] for r in rows], words, seeds, [places[int(s)] for s in seeds.values])


def leaks(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id",
          n: int = N, threshold: float = THRESHOLD, **options) -> DataFrame:
    """doc_id, item_id, score, first_word, last_word: a row for each test item that a document holds."""
    types = (docs.schema[doc_id].dataType.simpleString(), benchmark.schema[item_id].dataType.simpleString())
    schema = f"doc_id {types[0]}, item_id {types[1]}, score double, first_word bigint, last_word bigint"
    source, out = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")), None
    for items in item_blocks(source, benchmark, item_id, n=n, **options):
        shared = docs.sparkSession.sparkContext.broadcast(items)

        def run(batches, shared=shared):
            known = shared.value
            for batch in batches:
                rows = [(i, *m) for i, words in enumerate(_documents(batch, "text")) for m in matches(words, known, n, threshold)]
                if rows:
                    at, item, score, first, last = zip(*rows, strict=True)
                    yield pa.RecordBatch.from_arrays(
                        [batch.column("doc_id").take(pa.array(at)), pa.array([known.ids[i] for i in item]), pa.array(score, pa.float64()),
                         pa.array(first, pa.int64()), pa.array(last, pa.int64())], ["doc_id", "item_id", "score", "first_word", "last_word"])

        found = source.mapInArrow(run, schema)
        out = found if out is None else out.unionByName(found)
    return docs.sparkSession.createDataFrame([], schema) if out is None else out


def clean(docs: DataFrame, benchmark: DataFrame, text: str = "text", n: int = N, threshold: float = THRESHOLD, **options) -> DataFrame:
    """``docs`` without those that hold a test item."""
    for items in item_blocks(docs.select(F.col(text).alias("text")), benchmark, n=n, **options):
        shared = docs.sparkSession.sparkContext.broadcast(items)

        def run(batches, shared=shared):
            for batch in batches:
                keep = [not matches(words, shared.value, n, threshold, first_only=True) for words in _documents(batch, text)]
                yield batch.filter(pa.array(keep, pa.bool_()))

        docs = docs.mapInArrow(run, docs.schema)
    return docs
