"""LM scoring: an interpolated modified Kneser-Ney bigram model.

Counting: each task counts its words and word pairs and packs them by bucket of the pair's hash; a bucket is merged by
one task, so no task sees more than its share even if one word makes up a third of all text. How many pairs a word
begins and ends, and how often it stands first, are sums over buckets, taken by Spark. The model is three kinds of
sorted hash arrays in files in the shared folder: words with count and lower-order probability, contexts with the
weight of the lower order, and per bucket the pairs with their discounted probability. Workers memory-map them and look
up the sorted distinct pairs of a batch, bucket by bucket.

p(w | v) = max(c(vw) - D, 0) / c(v.) + g(v) * p(w); p(w) likewise from the number of different words before w, and at
last 1 / (V + 1) for each of the V known words and one unknown. D is D1, D2 or D3+ by the count. The first word's
context is a start mark, the last token is an end mark.

Defined results: a null or empty text is one end token. Rows without a doc_id are learned from. With no training text
every token has 1 / (V + 1) with V = 0, that is, a score of 0. Repeated rows count each.
"""

from __future__ import annotations

import os
import shutil
import uuid

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from edilake.llm import tokens
from edilake.llm.io import keep, new_folder

END = tokens.mix(np.array([0xE4D], np.uint64))[0]
START = tokens.mix(np.array([0x57A47], np.uint64))[0]
FLUSH = 3_000_000


def local(path: str) -> str:
    """The mounted path of the shared folder; a folder without one cannot be memory-mapped."""
    if path.startswith("file:"):
        path = "/" + path[5:].lstrip("/")
    if "://" in path:
        raise ValueError(f"{path}: the model is memory-mapped, so spark.checkpoint.dir must be a mounted folder")
    return path


def sequences(texts: list[bytes]):
    """The words of each text and an end token."""
    for group in tokens.chunks(texts, len):
        h, bounds = tokens.word_hashes(group)
        ends = np.insert(h, bounds[1:], END)
        yield len(group), ends, bounds + np.arange(len(bounds))


def pair_keys(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return tokens.mix(first * np.uint64(3) + tokens.mix(second))


def contexts(words: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    before = np.empty_like(words)
    before[1:] = words[:-1]
    before[bounds[:-1]] = START
    return before


def bucket_of(keys: np.ndarray, buckets: int) -> np.ndarray:
    return ((keys >> np.uint64(40)) * np.uint64(buckets) >> np.uint64(24)).astype(np.int64)


def _pack(first, second, counts) -> bytes:
    """Pairs with counts; words as places in a list of the distinct ones."""
    words, at = np.unique(np.concatenate((first, second)), return_inverse=True)
    at = at.astype(np.uint32)
    a, b = at[:len(first)], at[len(first):]
    order = np.lexsort((b, a))
    head = np.array([len(words), len(first)], np.int64)
    body = (np.diff(a[order], prepend=np.uint32(0)), b[order], counts[order].astype(np.uint32))
    # bytes of equal weight together: high ones are mostly zero
    planes = [x.view(np.uint8).reshape(-1, 4).T.tobytes() for x in body]
    return zstandard.compress(head.tobytes() + words.tobytes() + b"".join(planes), 3)


def _unpack(blob: bytes):
    data = zstandard.decompress(blob)
    n_words, n = np.frombuffer(data, np.int64, 2)
    words = np.frombuffer(data, np.uint64, n_words, 16)
    at = 16 + 8 * int(n_words)
    planes = [np.frombuffer(data, np.uint8, 4 * n, at + 4 * n * i).reshape(4, n).T.copy().view(np.uint32)[:, 0] for i in range(3)]
    return words[np.cumsum(planes[0], dtype=np.uint32)], words[planes[1]], planes[2].astype(np.int64)


def _sum_by(keys: np.ndarray, *values: np.ndarray):
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    starts = np.flatnonzero(np.concatenate((np.ones(min(1, len(keys)), bool), keys[1:] != keys[:-1])))
    return (keys[starts], order[starts], *(np.add.reduceat(v[order], starts) if len(starts) else v[:0] for v in values))


def count_pairs(train: DataFrame, buckets: int) -> DataFrame:
    """(bucket, pairs): packed pair counts of parts of the text."""
    def run(batches):
        held, size = [], 0

        def flush():
            first, second = (np.concatenate(x) for x in zip(*held, strict=True))
            keys, at, counts = _sum_by(pair_keys(first, second), np.ones(len(first), np.int64))
            own = bucket_of(keys, buckets)
            edges = np.searchsorted(own, np.arange(buckets + 1))
            parts = [(b, _pack(first[at[x:y]], second[at[x:y]], counts[x:y])) for b, (x, y) in enumerate(zip(edges[:-1], edges[1:], strict=True)) if y > x]
            return pa.RecordBatch.from_arrays([pa.array([b for b, _ in parts], pa.int32()), pa.array([p for _, p in parts], pa.binary())], ["bucket", "pairs"])

        for batch in batches:
            for _, words, bounds in sequences(tokens.text_column(batch)):
                held.append((contexts(words, bounds), words))
                size += len(words)
                if size >= FLUSH:
                    yield flush()
                    held, size = [], 0
        if held:
            yield flush()

    return train.select("text").mapInArrow(run, "bucket int, pairs binary")


def _write(folder: str, name: str, **arrays):
    """Files appear whole or not at all, so a task that runs again does no harm."""
    os.makedirs(folder, exist_ok=True)
    for part, values in arrays.items():
        temporary = f"{folder}/.{uuid.uuid4().hex}"
        values.tofile(temporary)
        os.replace(temporary, f"{folder}/{name}.{part}")


def _read(folder: str, name: str, part: str, kind) -> np.ndarray:
    path = f"{folder}/{name}.{part}"
    return np.memmap(path, kind, "r") if os.path.exists(path) and os.path.getsize(path) else np.zeros(0, kind)


def merge_buckets(counted: DataFrame, folder: str, buckets: int) -> DataFrame:
    """Merges each bucket's pairs into sorted arrays on file. Returns, for each word, what the bucket adds: times first,
    pairs begun by count (1, 2, more), pairs ended, and its count; words are dealt to rows by their hash."""
    def run(batches):
        open_, parts = None, []

        def close():
            first, second, counts = (np.concatenate(x) for x in zip(*parts, strict=True))
            keys, at, counts = _sum_by(pair_keys(first, second), counts)
            first, second = first[at], second[at]
            _write(folder, f"pairs{open_}", key=keys, count=counts)
            as_int = lambda x: x.astype(np.int64)
            v, _, total, n1, n2, n3 = _sum_by(first, counts, as_int(counts == 1), as_int(counts == 2), as_int(counts > 2))
            w, _, before, occurs = _sum_by(second, np.ones(len(second), np.int64), counts)
            zeros = lambda x: np.zeros(len(x), np.int64)
            columns = [np.concatenate(x) for x in ((v, w), (total, zeros(w)), (n1, zeros(w)), (n2, zeros(w)), (n3, zeros(w)), (zeros(v), before), (zeros(v), occurs))]
            some = np.bincount(np.minimum(counts, 5), minlength=5)
            columns = [np.append(c, x) for c, x in zip(columns, (np.uint64(0), *some[1:5], 0, 0), strict=True)]
            return pa.RecordBatch.from_arrays([pa.array(columns[0].view(np.int64)), *(pa.array(c) for c in columns[1:])],
                                              ["word", "total", "n1", "n2", "n3", "ended", "occurs"])

        for batch in batches:
            for b, blob in zip(batch.column("bucket").to_pylist(), batch.column("pairs").to_pylist(), strict=True):
                if b != open_ and parts:
                    yield close()
                    parts = []
                open_ = b
                parts.append(_unpack(blob))
        if parts:
            yield close()

    grouped = counted.repartition(buckets, "bucket").sortWithinPartitions("bucket")
    return grouped.mapInArrow(run, "word bigint, total bigint, n1 bigint, n2 bigint, n3 bigint, ended bigint, occurs bigint")


def discounts(n1: int, n2: int, n3: int, n4: int) -> np.ndarray:
    """D for counts 0, 1, 2, 3 and more; each between 0 and its count, also where counts of counts are missing."""
    y = n1 / (n1 + 2 * n2) if n1 + 2 * n2 else 0.0
    raw = [1 - 2 * y * n2 / n1 if n1 else 0.5, 2 - 3 * y * n3 / n2 if n2 else 1.0, 3 - 4 * y * n4 / n3 if n3 else 1.5]
    return np.array([0.0, *(min(max(d, 0.05), k * 0.95) for k, d in enumerate(raw, 1))])


def build(train: DataFrame) -> dict:
    """Counts all texts of ``train`` and leaves the model's files in the shared folder; returns its few numbers."""
    spark = train.sparkSession
    folder, buckets = local(new_folder(spark, "lm")), max(16, int(spark.conf.get("spark.sql.shuffle.partitions")))
    rows = keep(merge_buckets(count_pairs(train, buckets), folder, buckets)
                .groupBy("word").agg(*(F.sum(c).alias(c) for c in ("total", "n1", "n2", "n3", "ended", "occurs"))), "words")
    pairs = rows.where("word = 0").first()
    real = rows.where("word <> 0")
    ended = F.col("ended")
    s = real.agg(F.sum("occurs").alias("n"), F.sum((F.col("occurs") > 0).cast("int")).alias("v"), F.sum("ended").alias("types"),
                 *(F.sum((ended == k).cast("int")).alias(f"e{k}") for k in (1, 2, 3, 4)), F.sum((ended > 2).cast("int")).alias("more")).first()
    n, v, types = s["n"] or 0, s["v"] or 0, s["types"] or 0
    model = {"folder": folder, "buckets": buckets, "n": n, "v": v}
    if not n:
        return model
    model["d_pair"] = discounts(pairs["total"], pairs["n1"], pairs["n2"], pairs["n3"]).tolist()
    d = discounts(s["e1"], s["e2"], s["e3"], s["e4"])
    low = float(d[1] * s["e1"] + d[2] * s["e2"] + d[3] * s["more"]) / types
    model["unknown"] = low / (v + 1)
    parts = model["parts"] = buckets

    def run(batches):
        d_pair = np.array(model["d_pair"])
        for batch in batches:
            word, total, n1, n2, n3, end, occurs = (batch.column(c).to_numpy() for c in ("word", "total", "n1", "n2", "n3", "ended", "occurs"))
            p = (end - d[np.minimum(end, 3)]) / types + model["unknown"]
            weight = np.divide(d_pair[1] * n1 + d_pair[2] * n2 + d_pair[3] * n3, total, out=np.ones(len(word)), where=total > 0)
            yield pa.RecordBatch.from_arrays([pa.array(word), pa.array(occurs), pa.array(p.astype(np.float32)), pa.array(weight.astype(np.float32)),
                                              pa.array(total)], ["word", "occurs", "p", "weight", "total"])

    def write(batches):
        held = list(batches)
        if held:
            t = pa.Table.from_batches(held)
            word = t.column("word").to_numpy().view(np.uint64)
            order = np.argsort(word)
            part = int(bucket_of(word[order[:1]], parts)[0])
            _write(folder, f"words{part}", key=word[order], count=t.column("occurs").to_numpy()[order], p=t.column("p").to_numpy()[order],
                   weight=t.column("weight").to_numpy()[order], total=t.column("total").to_numpy()[order])
            yield pa.RecordBatch.from_arrays([pa.array([part])], ["part"])

    # a part of the words' hash range for each file
    part = F.expr(f"cast((shiftrightunsigned(word, 40) * {parts}) div {1 << 24} as int)")
    ranged = real.mapInArrow(run, "word bigint, occurs bigint, p float, weight float, total bigint").withColumn("part", part)

    def by_part(batches):
        """One file for each part, however parts are dealt to tasks."""
        own, now = [], None
        for batch in batches:
            marks = batch.column("part").to_numpy()
            edges = [0, *(np.flatnonzero(marks[1:] != marks[:-1]) + 1).tolist(), len(marks)]
            for x, y in zip(edges[:-1], edges[1:], strict=True):
                if y > x:
                    if now is not None and marks[x] != now:
                        yield from write(own)
                        own = []
                    now = marks[x]
                    own.append(batch.slice(x, y - x))
        yield from write(own)

    keep(ranged.repartition(parts, "part").sortWithinPartitions("part").mapInArrow(by_part, "part bigint"), "parts")
    return model


class Model:
    def __init__(self, numbers: dict):
        self.numbers = numbers
        self.files: dict[str, tuple] = {}

    def table(self, kind: str, part: int):
        name = f"{kind}{part}"
        if name not in self.files:
            folder = self.numbers["folder"]
            fields = (("count", np.int64), ("p", np.float32), ("weight", np.float32), ("total", np.int64)) if kind == "words" else (("count", np.int64),)
            self.files[name] = (_read(folder, name, "key", np.uint64), *(_read(folder, name, *f) for f in fields))
        return self.files[name]

    def look_up(self, kind: str, keys: np.ndarray, fields: int) -> list[np.ndarray]:
        """Values of sorted distinct keys; zero where a key is absent."""
        parts = self.numbers["buckets"]
        out = [np.zeros(len(keys)) for _ in range(fields)]
        edges = np.searchsorted(bucket_of(keys, parts), np.arange(parts + 1))
        for part in range(parts):
            x, y = edges[part], edges[part + 1]
            if y == x:
                continue
            known, *values = self.table(kind, part)
            if not len(known):
                continue
            at = np.minimum(np.searchsorted(known, keys[x:y]), len(known) - 1)
            hit = known[at] == keys[x:y]
            for o, v in zip(out, values, strict=True):
                o[x:y][hit] = v[at[hit]]
        return out

    def score(self, words: np.ndarray, bounds: np.ndarray):
        """Of each text: tokens, known tokens, base score, log10 probability."""
        numbers, starts = self.numbers, bounds[:-1]
        before = contexts(words, bounds)
        distinct, at = np.unique(np.append(words, START), return_inverse=True)
        count, p, weight, total = self.look_up("words", distinct, 4) if numbers["n"] else [np.zeros(len(distinct))] * 4
        place = at[:-1]
        context = np.concatenate(([at[-1]], place[:-1]))
        context[starts] = at[-1]
        base = np.log10((count[place] + 1) / (numbers["n"] + numbers["v"] + 1))
        if numbers["n"]:
            keys, pair_at = np.unique(pair_keys(before, words), return_inverse=True)
            pairs, = self.look_up("pairs", keys, 1)
            c, d = pairs[pair_at], np.array(numbers["d_pair"])
            lower = np.where(count > 0, p, numbers["unknown"])[place]
            seen = total[context]
            own = np.divide(c - d[np.minimum(c, 3).astype(np.int64)], seen, out=np.zeros(len(words)), where=(seen > 0) & (c > 0))
            likely = np.log10(own + np.where(seen > 0, weight[context], 1.0) * lower)
        else:
            likely = base
        sums = lambda x: np.add.reduceat(x, starts)
        return np.diff(bounds), sums((count[place] > 0).astype(np.int64)), sums(base), sums(likely)


_models: dict[str, Model] = {}


def _model(numbers: dict) -> Model:
    folder = numbers["folder"]
    if folder not in _models:
        _models.clear()
        _models[folder] = Model(numbers)
    return _models[folder]


def score(docs: DataFrame, numbers: dict) -> DataFrame:
    """``docs`` (without its text) with n_tokens, n_known, base_score, score."""
    rest = [c for c in docs.columns if c != "text"]
    schema = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in rest)

    def run(batches):
        model = _model(numbers)
        for batch in batches:
            parts = [model.score(words, bounds) for _, words, bounds in sequences(tokens.text_column(batch))]
            n, known, base, likely = (np.concatenate(x) for x in zip(*parts, strict=True)) if parts else [np.zeros(0)] * 4
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in rest), pa.array(n.astype(np.int64)), pa.array(known.astype(np.int64)), pa.array(base), pa.array(likely)],
                                             [*rest, "n_tokens", "n_known", "base_score", "score"])

    return docs.mapInArrow(run, schema + ", n_tokens bigint, n_known bigint, base_score double, score double")


def held_out(doc_id: str = "doc_id") -> Column:
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 7 == 2, F.lit(False))


def scores(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score: learned from all that is not held out."""
    rows = docs.select("doc_id", held_out().alias("held_out"), "text")
    numbers = build(rows.where(~F.col("held_out")))
    return score(rows, numbers).select("doc_id", "held_out", "n_tokens", "n_known", F.lit(numbers["n"]).cast("bigint").alias("train_tokens"),
                                       "base_score", "score")


def perplexity(scored: DataFrame) -> DataFrame:
    """Perplexity of the held-out and of the training texts."""
    return scored.groupBy("held_out").agg(F.pow(F.lit(10.0), -F.sum("score") / F.sum("n_tokens")).alias("perplexity"))


def discard(numbers: dict) -> None:
    shutil.rmtree(numbers["folder"], ignore_errors=True)
