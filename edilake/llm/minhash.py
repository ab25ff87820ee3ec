"""MinHash near-dedup: one-permutation hashing with optimal densification, banded buckets, star-shaped candidate edges.

Documents with the same words in the same order are one class, found by a 128-bit key; only classes are compared. A
class's distinct shingles are hashed once and dealt to bins; a bin keeps its minimum, and an empty bin takes that of the
bin which a hash of (bin, attempt) names. Bands of bins are buckets, and so are pairs of neighbouring bands, whose
members are closer to each other. In a bucket, edges go from centres to the other members, so their number is linear in its
size: from the member that shares most buckets and, in buckets of pairs, from one chosen by a hash. Edges whose set sizes
rule a link out are dropped, then those of long texts whose signatures are far apart; the rest is confirmed on full shingle
sets. In a bucket whose members are not in one component then, all members of different components are compared, in blocks
of at most two chunks of about ``CHUNK`` members: by set sizes, by bit maps of the shingles (maps differ in no more bits than
sets in shingles, so no link is lost by them) and by signatures. What is left is confirmed as well.

With 5 rows and 32 bands, two sets at a similarity of 0.85 share no bucket once in 10^8 pairs, at 0.8 three times in 10^6.
Signatures are compared for sets of ``bins`` shingles or more, byte by byte, at 0.15 below the threshold: five standard
deviations of the estimate.

Defined results: a null or empty text, or one without words, has no shingles and is linked with nothing. A text of fewer
words than a shingle is one shingle. Rows without a doc_id are linked with nothing, have no component and are not kept.
Rows with the same doc_id and text are one document and get the same values each.
"""

from __future__ import annotations

import functools
import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from edilake.llm import tokens
from edilake.llm.components import components, extended
from edilake.llm.io import keep, remove

BANDS, ROWS = 32, 5
SLACK = 0.15
CHUNK = 1024
MAP_BYTES = 128
AT_ONCE = 1 << 17


def shingles(words: np.ndarray, width: int) -> np.ndarray:
    """The distinct shingle hashes of a text, sorted."""
    return np.unique(tokens.combine(words, min(width, len(words)))) if len(words) else words


def one_permutation(hashes: np.ndarray, bins: int) -> np.ndarray:
    """The minimum of each bin; empty bins take another bin's (optimal densification)."""
    values = np.sort(tokens.mix(hashes))
    at = ((values >> np.uint64(32)) * np.uint64(bins)) >> np.uint64(32)
    filled, first = np.unique(at, return_index=True)
    out, empty = np.zeros(bins, np.uint64), np.ones(bins, bool)
    out[filled], empty[filled] = values[first], False
    missing = np.flatnonzero(empty)
    if len(filled) == 1:
        out[missing] = values[first[0]]
        return out
    table, attempt = attempts(bins), 0
    while len(missing):
        tries = table[attempt % len(table):attempt % len(table) + 16, missing]
        full = ~empty[tries]
        found = full.any(axis=0)
        out[missing[found]] = out[tries[full.argmax(axis=0)[found], np.flatnonzero(found)]]
        missing = missing[~found]
        attempt += 16
    return out


@functools.cache
def attempts(bins: int) -> np.ndarray:
    """Bin that a hash names for each (attempt, bin)."""
    grid = np.arange(64 * bins, dtype=np.uint64)[None] * np.uint64(bins) + np.arange(bins, dtype=np.uint64)[:, None]
    return (tokens.mix(grid.T.copy()) % np.uint64(bins)).astype(np.int64)


def band_hashes(signature: np.ndarray, bands: int, rows: int) -> np.ndarray:
    parts = signature.reshape(bands, rows)
    out = np.arange(1, bands + 1, dtype=np.uint64)
    with np.errstate(over="ignore"):
        for i in range(rows):
            out = tokens.mix(out * np.uint64(0x9E3779B97F4A7C15) + parts[:, i])
    return out.view(np.int64)


def bit_map(hashes: np.ndarray) -> bytes:
    """Of each bit, whether an odd number of the shingles fall on it."""
    counts = np.bincount((tokens.mix(hashes) % np.uint64(8 * MAP_BYTES)).astype(np.int64), minlength=8 * MAP_BYTES)
    return np.packbits((counts & 1).astype(np.uint8)).tobytes()


def sequence_key(words: np.ndarray) -> bytes:
    return hashlib.blake2b(words.tobytes(), digest_size=16).digest()


def sketches(docs: DataFrame, width: int, bands: int, rows: int, carry: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, key, n_shingles, bands, marks (the low byte of each bin) and the bit map of every document, and the string
    columns ``carry``."""
    def run(batches):
        for batch in batches:
            at = 0
            for group in tokens.chunks(tokens.text_column(batch), len):
                keys, sizes, buckets, marks, maps = [], [], [], [], []
                h, bounds = tokens.word_hashes(group)
                for a, b in zip(bounds[:-1], bounds[1:], strict=True):
                    own = shingles(h[a:b], width)
                    keys.append(sequence_key(h[a:b]))
                    sizes.append(len(own))
                    signature = one_permutation(own, bands * rows) if len(own) else None
                    buckets.append(band_hashes(signature, bands, rows) if len(own) else None)
                    marks.append(signature.astype(np.uint8).tobytes() if len(own) else None)
                    maps.append(bit_map(own) if len(own) else None)
                own = batch.slice(at, len(group))
                at += len(group)
                yield pa.RecordBatch.from_arrays([own.column("doc_id"), *(own.column(c) for c in carry), pa.array(keys, pa.binary()), pa.array(sizes, pa.int64()),
                                                  pa.array(buckets, pa.list_(pa.int64())), pa.array(marks, pa.binary()), pa.array(maps, pa.binary())],
                                                 ["doc_id", *carry, "key", "n_shingles", "bands", "marks", "map"])

    id_type = docs.schema["doc_id"].dataType.simpleString()
    carried = "".join(f", `{c}` string" for c in carry)
    return docs.select("doc_id", "text", *carry).mapInArrow(run, f"doc_id {id_type}{carried}, key binary, n_shingles bigint, bands array<bigint>, marks binary, map binary")


def class_texts(docs: DataFrame, classes: DataFrame) -> DataFrame:
    """(key, text) of ``classes`` (key, doc_id), each text taken from the document of that id."""
    def run(batches):
        for batch in batches:
            hold = []
            for group in tokens.chunks(tokens.text_column(batch), len):
                h, bounds = tokens.word_hashes(group)
                hold.extend(sequence_key(h[a:b]) for a, b in zip(bounds[:-1], bounds[1:], strict=True))
            same = [k == own for k, own in zip(batch.column("key").to_pylist(), hold, strict=True)]
            yield batch.filter(pa.array(same, pa.bool_()))

    rows = docs.select("doc_id", "text").join(classes, "doc_id").select("key", "text")
    return rows.mapInArrow(run, "key binary, text string").groupBy("key").agg(F.first("text").alias("text"))


def confirmed(edges: DataFrame, texts: DataFrame, width: int, percent: int) -> DataFrame:
    """The edges (a, b) whose full shingle sets have 100 * intersection >= percent * union."""
    def run(batches):
        name, centre = None, None
        for batch in batches:
            out = []
            a, b = tokens.text_column(batch, "text_a"), tokens.text_column(batch, "text_b")
            for key, one, two in zip(batch.column("a").to_pylist(), a, b, strict=True):
                if key != name:
                    name, centre = key, shingles(tokens.word_hashes([one])[0], width)
                member = shingles(tokens.word_hashes([two])[0], width)
                common = len(np.intersect1d(centre, member, assume_unique=True))
                out.append(100 * common >= percent * (len(centre) + len(member) - common))
            yield batch.select(["a", "b"]).filter(pa.array(out, pa.bool_()))

    both = (edges.join(texts.select(F.col("key").alias("b"), F.col("text").alias("text_b")), "b")
            .join(texts.select(F.col("key").alias("a"), F.col("text").alias("text_a")), "a"))
    return both.select("a", "b", "text_a", "text_b").mapInArrow(run, "a binary, b binary")


def star(rows: DataFrame) -> DataFrame:
    """Candidate edges between ``key`` and ``centre``, the smaller first."""
    return rows.where("key <> centre").select(F.least("key", "centre").alias("a"), F.greatest("key", "centre").alias("b"))


def likely(edges: DataFrame, signatures: DataFrame, percent: int, bins: int) -> DataFrame:
    """The distinct ``edges`` (a, b) that set sizes and signatures (key, n_shingles, marks) do not rule out."""
    def run(batches):
        for batch in batches:
            big = np.minimum(batch.column("n_a").to_numpy(), batch.column("n_b").to_numpy()) >= bins
            a, b = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint8).reshape(-1, bins) for c in ("marks_a", "marks_b"))
            near = (a == b).mean(axis=1) >= percent / 100 - SLACK
            yield batch.select(["a", "b"]).filter(pa.array(near | ~big))

    side = lambda x: signatures.select(F.col("key").alias(x), F.col("n_shingles").alias(f"n_{x}"), F.col("marks").alias(f"marks_{x}"))
    rows = edges.distinct().join(side("a"), "a").join(side("b"), "b")
    fits = 100 * F.least("n_a", "n_b") >= percent * F.greatest("n_a", "n_b")
    return rows.where(fits).select("a", "b", "n_a", "n_b", "marks_a", "marks_b").mapInArrow(run, "a binary, b binary")


def open_members(members: DataFrame, labels: DataFrame) -> DataFrame:
    """bucket, key and label of the members of buckets that are not in one component."""
    placed = members.join(labels, F.col("key") == F.col("node"), "left").select("bucket", "key", F.coalesce("label", "key").alias("label"))
    mixed = placed.groupBy("bucket").agg(F.min("label").alias("low"), F.max("label").alias("high")).where("low <> high").select("bucket")
    return keep(placed.join(mixed, "bucket"), "open")


def blocks(members: DataFrame, chunk: int = CHUNK, *, made: list[DataFrame] | None = None) -> DataFrame:
    """``members`` (bucket, key, label) dealt to blocks (bucket, x, y), so that any two of a bucket with different labels meet in
    one. Tables kept on the way are added to ``made``. A bucket of up to ``chunk`` members is a block. Larger ones are cut into chunks, which meet in pairs; a label of
    more members has chunks of its own, which do not meet each other."""
    sizes = members.groupBy("bucket", "label").agg(F.count("*").alias("n_label"))
    totals = sizes.groupBy("bucket").agg(F.sum("n_label").alias("n"))
    small = members.join(totals.where(F.col("n") <= chunk).select("bucket"), "bucket").select(
        "bucket", *[F.lit(0).cast("bigint").alias(c) for c in ("x", "y", "chunk")], "key", "label")
    large = sizes.join(totals.where(F.col("n") > chunk), "bucket")
    alone = F.col("n_label") > chunk
    at = F.when(alone, F.xxhash64("label", F.pmod(F.xxhash64("key"), F.ceil(F.col("n_label") / chunk)))).otherwise(
        F.pmod(F.xxhash64("label"), F.ceil(F.col("n") / chunk)))
    cut = keep(members.join(large, ["bucket", "label"]).select("bucket", "key", "label", at.alias("chunk"), F.when(alone, F.col("label")).alias("own")), "cut")
    chunks = cut.select("bucket", "chunk", "own").distinct()
    pairs = chunks.select("bucket", F.col("chunk").alias("x"), F.col("own").alias("own_x")).join(
        chunks.select("bucket", F.col("chunk").alias("y"), F.col("own").alias("own_y")), "bucket")
    pairs = keep(pairs.where((F.col("x") <= F.col("y")) & ~F.coalesce(F.col("own_x") == F.col("own_y"), F.lit(False))).select("bucket", "x", "y"), "pairs")
    if made is not None:
        made += [cut, pairs]
    sides = pairs.withColumn("chunk", F.col("x")).union(pairs.where("x <> y").withColumn("chunk", F.col("y")))
    return small.union(cut.join(sides, ["bucket", "chunk"]).select("bucket", "x", "y", "chunk", "key", "label"))


def linkable(members: DataFrame, signatures: DataFrame, percent: int, bins: int) -> DataFrame:
    """The distinct pairs (a, b) of members of a block with different labels, and in blocks of two chunks from different chunks,
    that set sizes, bit maps and signatures do not rule out."""
    def compare(table):
        column = lambda c: table.column(c).to_numpy()
        matrix = lambda c, kind: np.frombuffer(b"".join(table.column(c).to_pylist()), kind).reshape(len(table), -1)
        x, y, chunk, n, marks, maps = column("x"), column("y"), column("chunk"), column("n_shingles"), matrix("marks", np.uint8), matrix("map", np.uint64)
        key, label = table.column("key").combine_chunks(), np.unique(np.array(table.column("label").to_pylist(), object), return_inverse=True)[1]
        ends = np.append(np.flatnonzero(edges(table)) + 1, len(table))
        after = ends[np.searchsorted(ends, np.arange(len(table)), side="right")] - np.arange(len(table)) - 1
        total, at = np.cumsum(after), 0
        while at < len(table):
            to = max(at + 1, int(np.searchsorted(total, (total[at - 1] if at else 0) + AT_ONCE, side="right")))
            count = after[at:to]
            i = np.repeat(np.arange(at, to), count)
            j = i + 1 + np.arange(len(i)) - np.repeat(np.cumsum(count) - count, count)
            at = to
            on = (label[i] != label[j]) & ((x[i] == y[i]) | (chunk[i] != chunk[j])) & (100 * np.minimum(n[i], n[j]) >= percent * np.maximum(n[i], n[j]))
            i, j = i[on], j[on]
            on = np.bitwise_count(maps[i] ^ maps[j]).sum(axis=1, dtype=np.int64) * (100 + percent) <= (n[i] + n[j]) * (100 - percent)
            i, j = i[on], j[on]
            on = (np.minimum(n[i], n[j]) < bins) | ((marks[i] == marks[j]).mean(axis=1) >= percent / 100 - SLACK)
            if on.any():
                yield pa.RecordBatch.from_arrays([key.take(pa.array(i[on])), key.take(pa.array(j[on]))], ["a", "b"])

    def edges(table):
        block = [table.column(c).to_numpy() for c in ("bucket", "x", "y")]
        return np.any([c[1:] != c[:-1] for c in block], axis=0)

    def run(batches):
        held, rows = [], 0
        for batch in batches:
            held.append(batch)
            rows += len(batch)
            if rows >= 4 * CHUNK:
                table = pa.Table.from_batches(held)
                last = np.flatnonzero(edges(table))
                if len(last):
                    yield from compare(table.slice(0, last[-1] + 1))
                    table = table.slice(last[-1] + 1)
                held, rows = table.to_batches(), len(table)
        if rows:
            yield from compare(pa.Table.from_batches(held))

    rows = members.join(signatures, "key").repartition("bucket", "x", "y").sortWithinPartitions("bucket", "x", "y")
    pairs = rows.select("bucket", "x", "y", "chunk", "key", "label", "n_shingles", "marks", "map").mapInArrow(run, "a binary, b binary")
    return pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def near_duplicates(docs: DataFrame, width: int = 5, percent: int = 80, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """doc_id, n_shingles, component_id (the smallest doc_id in reach over links of similarity ``percent`` / 100), kept."""
    return judged(docs, width, percent, bands, rows).select("doc_id", "n_shingles", "component_id", "kept")


def judged(docs: DataFrame, width: int, percent: int, bands: int = BANDS, rows: int = ROWS, carry: tuple[str, ...] = ()) -> DataFrame:
    """``near_duplicates`` with the columns ``carry`` of ``docs`` and ``label``, equal for the texts of a component."""
    sketch = keep(sketches(docs, width, bands, rows, carry), "sketches")
    classes = keep(sketch.where("n_shingles > 0 AND doc_id IS NOT NULL").groupBy("key")
                   .agg(F.min("doc_id").alias("doc_id"), F.first(F.struct("n_shingles", "bands", "marks", "map")).alias("s"))
                   .select("key", "doc_id", "s.*"), "classes")
    known = keep(sketch.select("doc_id", *carry, "key", "n_shingles"), "known")
    remove(sketch)
    buckets = classes.select("key", F.explode("bands").alias("bucket"))
    shared = buckets.groupBy("bucket").agg(F.count("*").alias("n")).where("n > 1")
    with_sizes = keep(buckets.join(shared, "bucket"), "members")
    weights = keep(with_sizes.groupBy("key").agg(F.sum("n").alias("weight")), "weights")
    company = classes.join(weights, "key")
    texts = keep(class_texts(docs, company.select("key", "doc_id")), "texts")
    signatures = keep(company.select("key", "n_shingles", "marks", "map"), "signatures")
    members = with_sizes.select("bucket", "key")

    def links_of(edges: DataFrame) -> DataFrame:
        return keep(confirmed(likely(edges, signatures, percent, bands * rows), texts, width, percent), "links")

    # the first centre of a bucket is its member with the most company, which near copies have been made from
    hubs = keep(members.join(weights, "key").groupBy("bucket").agg(F.max(F.struct("weight", "key"))["key"].alias("centre")), "hubs")
    closer = company.select("key", F.explode(F.transform("bands", lambda x, i: F.xxhash64(x, F.element_at("bands", (i + 1) % bands + 1)))).alias("bucket"))
    nearest = closer.groupBy("bucket").agg(F.min_by("key", F.xxhash64("key", "bucket")).alias("centre"), F.count("*").alias("n")).where("n > 1").drop("n")
    links = links_of(star(members.join(hubs, "bucket")).union(star(closer.join(nearest, "bucket"))))
    remove(weights)
    starred = components(links)
    # a hub has been compared with all members of its bucket
    others = members.join(hubs, "bucket").where("key <> centre").select("bucket", "key")
    opened = open_members(others, starred)
    remove(with_sizes, hubs, links)
    made: list[DataFrame] = []
    new = keep(confirmed(linkable(blocks(opened, made=made), signatures, percent, bands * rows), texts, width, percent), "links")
    remove(texts, signatures, opened, *made)
    labels = extended(starred, new)
    remove(starred, new)
    smallest = (classes.select("key", "doc_id").join(labels, F.col("key") == F.col("node"), "left")
                .select("key", "doc_id", F.coalesce("label", "key").alias("label")))
    ids = smallest.groupBy("label").agg(F.min("doc_id").alias("component_id"))
    of_class = keep(smallest.join(ids, "label").select("key", "label", "component_id"), "components")
    remove(classes, labels)
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id"))
    return (known.join(of_class, "key", "left")
            .select("doc_id", *carry, "label", "n_shingles", component.alias("component_id"))
            .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False))))


def keep_one(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """``docs`` with one document of each component: that of the smallest doc_id, of several different texts under that
    doc_id the one of the smallest digest. Texts without words are linked with nothing, so all different ones stay. Rows
    with the same doc_id and text are one document; rows without a doc_id stay."""
    digest = "__text_digest"
    rows = docs.withColumn(digest, F.coalesce(F.sha2("text", 256), F.lit("")))
    one = (judged(rows, width, percent, carry=(digest,)).where("kept").groupBy("doc_id", F.coalesce(F.hex("label"), digest))
           .agg(F.min(digest).alias(digest)).select("doc_id", digest))
    known = rows.where(F.col("doc_id").isNotNull()).join(one, ["doc_id", digest], "left_semi").dropDuplicates(["doc_id", digest])
    return known.select(*(F.col(f"`{c}`") for c in docs.columns)).unionByName(docs.where(F.col("doc_id").isNull()))


def components_sql(width: int, percent: int) -> str:
    """The same as DuckDB SQL, by all pairs of texts that share a shingle."""
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    gram = " || ' ' || ".join(f"w[i + {k}]" for k in range(width))
    return rf"""
WITH RECURSIVE docs AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), '{upper}', '{lower}'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
sets AS (
  SELECT doc_id, array_to_string(w, ' ') AS key, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < {width} THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - {width - 2}), lambda i: {gram})) END AS s FROM docs),
classes AS (SELECT key, min(doc_id) AS id, any_value(s) AS s FROM sets WHERE key <> '' GROUP BY key),
grams AS (SELECT id, unnest(s) AS g FROM classes),
pairs AS (SELECT a.id AS a, b.id AS b, count(*) AS n FROM grams a JOIN grams b ON a.g = b.g AND a.id < b.id GROUP BY ALL),
links AS (SELECT a, b FROM pairs JOIN classes x ON x.id = a JOIN classes y ON y.id = b
  WHERE 100 * n >= {percent} * (len(x.s) + len(y.s) - n)),
both_ways AS (SELECT a, b FROM links UNION SELECT b, a FROM links),
reach AS (SELECT id AS a, id AS b FROM classes UNION SELECT r.a, e.b FROM reach r JOIN both_ways e ON r.b = e.a),
low AS (SELECT a AS id, min(b) AS component_id FROM reach GROUP BY a)
SELECT s.doc_id, CAST(len(s.s) AS BIGINT) AS n_shingles, coalesce(l.component_id, s.doc_id) AS component_id,
       s.doc_id = coalesce(l.component_id, s.doc_id) AS kept
FROM sets s LEFT JOIN classes c ON s.key = c.key LEFT JOIN low l ON l.id = c.id"""
