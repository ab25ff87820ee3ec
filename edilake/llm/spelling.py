"""Spelling variants: words one edit apart, found by dense comparison of blocks of words.

Two words are one inserted, deleted or replaced code point apart if their common prefix and common suffix together reach
the longer length less one. Words are padded code-point matrices, from the left for prefixes and from the right for
suffixes, and blocks of them are compared row by row.

Which words meet is exact as well. Where the longer of two near words has length L, the edit is at some place of
[0, L); it is in one half of that range, and then the words agree before the half and after it. So each word joins the
groups of its length and of the next, under the half's left context and right context. A group above ``BLOCK`` words
halves its range again and deals its words to two groups of narrower contexts, until it is small or the range is one
place; a group of one place has one word for each code point there, and one for none. So nothing is capped, however many
words share a beginning.

Defined results: a null or empty text has no words. Rows without a doc_id count, with an empty doc_id in the hash.
Repeated rows count each time. Words that nothing is near have no form and are their own root. Texts are read whole.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from edilake.llm import tokens
from edilake.llm.io import keep, remove

LEAST, TWICE, RATIO, NOISE = 7, 2, 10, 31
BLOCK = 256
AT_ONCE = 1 << 18
FLUSH = 200_000


def noisy(doc: str, run: str, noise: int = NOISE) -> str:
    """The run, or for one of ``noise`` hashes of document and run, the run without one code point."""
    h = zlib.crc32(f"{doc}:{run}".encode())
    if h % noise:
        return run
    at = h % len(run)
    return run[:at] + run[at + 1:]


def word_counts(docs: DataFrame, least: int = LEAST, noise: int = NOISE, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(word, n): occurrences of the words of at least ``least`` code points, A-Z lower-cased. Counted in each task first."""
    runs = re.compile(f"[a-zÀ-ÿ]{{{least},}}")

    def run(batches):
        total: Counter = Counter()
        for batch in batches:
            ids = batch.column("doc_id").to_pylist()
            for doc, data in zip(ids, tokens.text_column(batch), strict=True):
                own = Counter(runs.findall(data.lower().decode("utf-8", "replace")))
                for word, n in own.items():
                    # every occurrence of a run in a document has the same hash
                    made = noisy(doc or "", word, noise)
                    if len(made) >= least:
                        total[made] += n
                if len(total) > FLUSH:
                    yield flushed(total)
                    total = Counter()
        yield flushed(total)

    def flushed(total):
        return pa.RecordBatch.from_arrays([pa.array(list(total), pa.string()), pa.array(list(total.values()), pa.int64())], ["word", "n"])

    rows = docs.select(F.col(doc_id).cast("string").alias("doc_id"), F.col(text).alias("text"))
    return rows.mapInArrow(run, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n"))


def group_key() -> Column:
    """Names a group: the longer length, the range of the edit, and what stands before and after it."""
    before = F.substr("word", F.lit(1), F.col("low"))
    after = F.substr("word", F.length("word") - F.col("longer") + F.col("high") + 1, F.col("longer") - F.col("high"))
    return F.xxhash64("longer", "low", "high", before, after)


def halves(members: DataFrame) -> DataFrame:
    """Members (word, n, longer, low, high) of a range, each in both halves of it."""
    middle = F.expr("(low + high) div 2")
    cut = members.select("word", "n", "longer", F.inline(F.array(F.struct("low", middle.alias("high")),
                                                                  F.struct(middle.alias("low"), "high"))))
    return cut.withColumn("key", group_key())


def blocks(words: DataFrame, block: int = BLOCK, made: list[DataFrame] | None = None) -> DataFrame:
    """(key, word, n): groups of words in which all near words meet, none above ``block`` unless its range is one place.
    Tables kept on the way are added to ``made``."""
    whole = words.select("word", "n", F.explode(F.array(F.length("word"), F.length("word") + 1)).alias("longer"))
    members = halves(whole.select("word", "n", "longer", F.lit(0).alias("low"), F.col("longer").alias("high")))
    out = None
    while True:
        members = keep(members, "members")
        # a group of one word, or of words of one length less only, has no pair of its own
        sizes = members.groupBy("key").agg(F.count("*").alias("size"), F.max(F.length("word") - F.col("longer")).alias("top"),
                                           F.max(F.col("high") - F.col("low")).alias("width")).where("size > 1 AND top = 0")
        done = members.join(sizes.where((F.col("size") <= block) | (F.col("width") == 1)).select("key"), "key").select("key", "word", "n")
        out = done if out is None else out.unionByName(done)
        large = keep(sizes.where((F.col("size") > block) & (F.col("width") > 1)).select("key"), "large")
        if made is not None:
            made += [members, large]
        if large.isEmpty():
            return out
        # keys are hashes: a group of two ranges (a collision) is cut where it can be, and met again where it can't
        cut = members.join(large, "key")
        out = out.unionByName(cut.where("high - low = 1").select("key", "word", "n"))
        members = halves(cut.where("high - low > 1").drop("key"))


def one_edit(left: np.ndarray, right: np.ndarray, length: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Whether rows i and j of the padded matrices (code points from the left, and from the right) are one edit apart."""
    width = left.shape[1]

    def agreed(matrix):
        differ = matrix[i] != matrix[j]
        return np.where(differ.any(axis=1), differ.argmax(axis=1), width)

    longer, shorter = np.maximum(length[i], length[j]), np.minimum(length[i], length[j])
    prefix, suffix = np.minimum(agreed(left), shorter), np.minimum(agreed(right), shorter)
    return (longer - shorter <= 1) & (prefix + suffix >= longer - 1)


def matrices(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    length = np.fromiter(map(len, words), np.int64, len(words))
    width = int(length.max())
    points = np.array([w.ljust(width, "\0") for w in words], f"<U{width}").view("<u4").reshape(len(words), width)
    at = length[:, None] - 1 - np.arange(width)
    right = np.where(at >= 0, np.take_along_axis(points, np.maximum(at, 0), axis=1), 0)
    kind = np.uint8 if points.max() < 256 else np.uint32
    return points.astype(kind), right.astype(kind), length


def near_words(grouped: DataFrame) -> DataFrame:
    """(word, near, near_n): both directions of all pairs of words of a group that are one edit apart."""
    def compare(table):
        key, word, n = table.column("key").to_numpy(), table.column("word").to_pylist(), table.column("n").to_numpy()
        left, right, length = matrices(word)
        ends = np.append(np.flatnonzero(key[1:] != key[:-1]) + 1, len(key))
        after = ends[np.searchsorted(ends, np.arange(len(key)), side="right")] - np.arange(len(key)) - 1
        total, at, step = np.cumsum(after), 0, max(1, AT_ONCE * 16 // left.shape[1])
        words = pa.array(word, pa.string())
        while at < len(key):
            to = max(at + 1, int(np.searchsorted(total, (total[at - 1] if at else 0) + step, side="right")))
            count = after[at:to]
            i = np.repeat(np.arange(at, to), count)
            j = i + 1 + np.arange(len(i)) - np.repeat(np.cumsum(count) - count, count)
            at = to
            near = one_edit(left, right, length, i, j)
            i, j = i[near], j[near]
            if len(i):
                one, two = pa.array(np.concatenate((i, j))), np.concatenate((j, i))
                yield pa.RecordBatch.from_arrays([words.take(one), words.take(pa.array(two)), pa.array(n[two])], ["word", "near", "near_n"])

    def run(batches):
        held, rows = [], 0
        for batch in batches:
            held.append(batch)
            rows += len(batch)
            if rows >= 16 * BLOCK:
                table = pa.Table.from_batches(held)
                key = table.column("key").to_numpy()
                last = np.flatnonzero(key[1:] != key[:-1]) + 1
                if len(last):
                    yield from compared(table.slice(0, last[-1]))
                    table = table.slice(last[-1])
                held, rows = table.to_batches(), len(table)
        if rows:
            yield from compared(pa.Table.from_batches(held))

    def compared(table):
        # groups of long words are compared apart, so that they don't widen the matrices of the others
        length = np.fromiter(map(len, table.column("word").to_pylist()), np.int64, len(table))
        key = table.column("key").to_numpy()
        start = np.concatenate((np.zeros(1, np.int64), np.flatnonzero(key[1:] != key[:-1]) + 1))
        widest = np.repeat(np.maximum.reduceat(length, start), np.diff(np.append(start, len(key))))
        for low, high in ((0, 16), (16, 64), (64, 1 << 40)):
            own = np.flatnonzero((widest > low) & (widest <= high))
            if len(own):
                part = table.take(pa.array(own))
                cells = np.cumsum(widest[own])
                if high < 1 << 40 or cells[-1] < 1 << 24:
                    yield from compare(part)
                else:
                    same = np.append(np.flatnonzero(np.diff(part.column("key").to_numpy())) + 1, len(part))
                    for a, b in zip(np.append(0, same[:-1]), same, strict=True):
                        yield from compare(part.slice(a, b - a))

    dealt = grouped.repartition("key").sortWithinPartitions("key", "word").select("key", "word", "n")
    # a pair may meet in two groups: an edit within a run of equal letters has several places
    return dealt.mapInArrow(run, "word string, near string, near_n bigint").distinct()


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) of words that have a form: where their forms lead. Every round doubles the way."""
    paths = held = keep(forms.select("word", F.col("form").alias("root")), "paths")
    while True:
        onward = paths.select(F.col("word").alias("root"), F.col("root").alias("next"))
        ahead = keep(paths.join(onward, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "paths")
        remove(held)
        paths, held = ahead.select("word", "root"), ahead
        if ahead.where("moved").isEmpty():
            return paths


def variants(counts: DataFrame, ratio: int = RATIO, block: int = BLOCK) -> DataFrame:
    """word, form, root, n, n_near, form_n of the distinct words of ``counts`` (word, n)."""
    words = keep(counts, "words")
    made: list[DataFrame] = []
    near = near_words(blocks(words, block, made))
    best = keep(near.groupBy("word").agg(F.count("*").alias("n_near"), F.max("near_n").alias("form_n"), F.min(F.struct((-F.col("near_n")).alias("m"), "near"))["near"].alias("form")), "best")
    remove(*made)
    joined = words.join(best, "word", "left")
    formed = F.col("form_n") >= ratio * F.col("n")
    rows = keep(joined.select("word", F.when(formed, F.col("form")).alias("form"), "n", F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"),
                              F.when(formed, F.col("form_n")).alias("form_n")), "forms")
    remove(words, best)
    root = roots(rows.where("form IS NOT NULL"))
    return rows.join(root, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def spelling(docs: DataFrame, least: int = LEAST, twice: int = TWICE, ratio: int = RATIO, noise: int = NOISE, block: int = BLOCK) -> DataFrame:
    """``variants`` of the words of ``docs`` that occur at least ``twice``."""
    return variants(word_counts(docs, least, noise).where(F.col("n") >= twice), ratio, block)


def spelling_sql(least: int = LEAST, twice: int = TWICE, ratio: int = RATIO, noise: int = NOISE) -> str:
    """The same as DuckDB SQL: near words are those that agree but for one place, or are another less one place."""
    from edilake.llm.merkle import CRC_TABLE_SQL, LOWER, UPPER

    byte = "list_transform(range(len(h) // 2), lambda i: CAST(CAST('0x' || h[2 * i + 1:2 * i + 2] AS INTEGER) AS BIGINT))"
    return f"""
WITH RECURSIVE crc AS ({CRC_TABLE_SQL}),
runs AS (SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS d, unnest(regexp_extract_all(translate(text, '{UPPER}', '{LOWER}'), '[A-Za-zÀ-ÿ]+')) AS r FROM documents),
own AS (SELECT d, r, count(*) AS n, hex(encode(d || ':' || r)) AS h FROM runs WHERE length(r) >= {least} GROUP BY d, r),
hashed AS (SELECT r, n, xor(list_reduce(list_prepend(4294967295, {byte}), lambda c, b: xor(c >> 8, crc_table[(xor(c, b) & 255) + 1])), 4294967295) AS k FROM own, crc),
made AS (SELECT CASE WHEN k % {noise} = 0 THEN r[1:k % length(r)] || r[k % length(r) + 2:] ELSE r END AS word, n FROM hashed),
words AS (SELECT word, CAST(sum(n) AS BIGINT) AS n FROM made WHERE length(word) >= {least} GROUP BY word HAVING sum(n) >= {twice}),
cut AS (SELECT word, n, p, word[1:p - 1] AS l, word[p + 1:] AS r FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS p FROM words)),
pairs AS (SELECT a.word, b.word AS near, b.n AS near_n FROM cut a JOIN cut b ON a.p = b.p AND a.l = b.l AND a.r = b.r AND a.word <> b.word
  UNION SELECT a.word, b.word, b.n FROM cut a JOIN words b ON b.word = a.l || a.r
  UNION SELECT b.word, a.word, a.n FROM cut a JOIN words b ON b.word = a.l || a.r),
best AS (SELECT word, count(*) AS n_near, max(near_n) AS m, min(near ORDER BY near) FILTER (near_n = top) AS f
  FROM (SELECT *, max(near_n) OVER (PARTITION BY word) AS top FROM pairs) GROUP BY word),
forms AS (SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN m >= {ratio} * w.n THEN f END AS form, CASE WHEN m >= {ratio} * w.n THEN m END AS form_n
  FROM words w LEFT JOIN best b ON b.word = w.word),
way AS (SELECT word, word AS root, 0 AS hops FROM forms UNION ALL SELECT w.word, f.form, hops + 1 FROM way w JOIN forms f ON f.word = w.root WHERE f.form IS NOT NULL),
ends AS (SELECT word, arg_max(root, hops) AS root FROM way GROUP BY word)
SELECT f.word, f.form, e.root, f.n, f.n_near, f.form_n FROM forms f JOIN ends e ON e.word = f.word"""
