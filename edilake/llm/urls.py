"""URL filters: a Bloom filter cascade over listed keys.

Level 1 holds the listed keys. Level 2 holds the keys of the rest of the universe that level 1 lets through, level 3
the listed keys that level 2 lets through, and so on until a level lets nothing through wrongly. For every key of the
universe that the cascade was built over, membership is exact, and no join is needed: a key is listed if the first level
that refuses it has an even number. Bits are set by Spark (one row per 64 bits of a filter), never by a single task.

Filters are handed to the workers in shards whose size is bounded by ``SHARD_KEYS``: a longer list makes more shards,
and a key is looked up in the one that its hash names. Each shard is one pass of lookups, so no broadcast grows.

Defined results: null keys are in no list. A url that is null or has no ``://`` has an empty host and path.
"""

from __future__ import annotations

import functools

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from edilake.llm.io import keep

SHARD_KEYS = 16_000_000
BITS_PER_KEY = 10
HASHES = 5

# fixed values: (verdict, host, path)
RULES = [("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"),
         ("allow", "com", "/fr/"), ("block", "com", "/de/")]

# fixed values: parts of host names that put a host on the list
LISTED_PARTS = ["adult", "casino", "porn", "gambl", "malware", "phish"]


def host_and_path(url: Column) -> tuple[Column, Column]:
    rest = F.regexp_extract(url, r"(?s)^.*?://(.*)$", 1)
    head = F.regexp_extract(rest, r"(?s)^([^?#]*)", 1)
    host = F.regexp_extract(head, r"(?s)^([^/]*)", 1)
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return (F.coalesce(F.translate(host, upper, lower), F.lit("")),
            F.coalesce(head.substr(F.length(host) + 1, F.length(head)), F.lit("")))


def rule_for(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """The longest rule that fits and its verdict, null if none does."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for v, h, p in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        name, verdict = F.when(fits, F.lit(h + p)).otherwise(name), F.when(fits, F.lit(v)).otherwise(verdict)
    return name, verdict


def _bits(key: str, level: int, size: int) -> Column:
    """Places of a key's bits in a filter of ``size`` bits: two hashes, combined."""
    a, b = F.xxhash64(F.col(key), F.lit(level)), F.xxhash64(F.lit(level), F.col(key))
    return F.transform(F.sequence(F.lit(0), F.lit(HASHES - 1)), lambda i: F.pmod(F.shiftright(a, 2) + i * F.shiftright(b, 6), F.lit(size)))


def _filter(keys: DataFrame, key: str, level: int, size: int) -> np.ndarray:
    """The bit set of the keys, bounded by the keys of a shard."""
    words = (keys.select(F.explode(_bits(key, level, size)).alias("bit"))
             .groupBy(F.expr("bit div 32").alias("word")).agg(F.bit_or(F.expr("shiftleft(1L, cast(bit % 32 as int))")).alias("v")))
    out = np.zeros(size // 32 + 1, np.uint32)
    found = words.toArrow()
    out[found.column("word").to_numpy()] = found.column("v").to_numpy()
    return out


def _passes(keys: DataFrame, key: str, level: int, bits: np.ndarray, size: int) -> DataFrame:
    shared = keys.sparkSession.sparkContext.broadcast(bits)

    def run(batches):
        words = shared.value
        for batch in batches:
            places = np.asarray(batch.column("places").flatten()).reshape(-1, HASHES)
            hit = ((words[places >> 5] >> (places & 31).astype(np.uint32)) & 1).all(axis=1)
            yield batch.select([key]).filter(pa.array(hit))

    return keys.select(key, _bits(key, level, size).alias("places")).mapInArrow(run, keys.select(key).schema)


class Cascade:
    """Exact membership for the keys of a universe; ``shards`` holds the levels' (bits, size) of each shard."""

    def __init__(self, shards: list[list[tuple[np.ndarray, int]]]):
        self.shards = shards

    @staticmethod
    def build(listed: DataFrame, universe: DataFrame, key: str, shard_keys: int = SHARD_KEYS) -> Cascade:
        """``listed`` and ``universe`` hold the column ``key``; listed keys outside the universe are members too."""
        listed = keep(listed.select(key).where(F.col(key).isNotNull()).distinct(), "listed")
        others = keep(universe.select(key).where(F.col(key).isNotNull()).distinct().join(listed, key, "left_anti"), "others")
        n_shards = -(-listed.count() // shard_keys) or 1
        shards = []
        for s in range(n_shards):
            mine = F.pmod(F.xxhash64(F.lit(-1), F.col(key)), F.lit(n_shards)) == s
            inside, outside, levels = listed.where(mine), others.where(mine), []
            while n := inside.count():
                size = max(64, n * BITS_PER_KEY)
                bits = _filter(inside, key, len(levels), size)
                through = keep(_passes(outside, key, len(levels), bits, size), "through")
                levels.append((bits, size))
                inside, outside = through, inside
            shards.append(levels)
        return Cascade(shards)

    def mark(self, df: DataFrame, key: str, name: str) -> DataFrame:
        """``df`` with boolean column ``name``: is its key listed?"""
        n_shards = len(self.shards)
        rest = [c for c in df.columns if c != name]
        out = df.select(*(F.col(f"`{c}`") for c in rest), F.lit(False).alias(name))
        for s, levels in enumerate(self.shards):
            if not levels:
                continue
            shared = df.sparkSession.sparkContext.broadcast(levels)
            sizes = [size for _, size in levels]
            fields = [f"__{level}" for level in range(len(sizes))]
            mine = (F.pmod(F.xxhash64(F.lit(-1), F.col(key)), F.lit(n_shards)) == s) & F.col(key).isNotNull()
            schema = T.StructType([*out.schema.fields])
            run = functools.partial(_mark_batches, shared, fields, [*rest], name)
            out = out.select("*", mine.alias("__mine"), *(_bits(key, i, size).alias(f) for i, (size, f) in enumerate(zip(sizes, fields, strict=True)))
                             ).mapInArrow(run, schema)
        return out


def _mark_batches(shared, fields, rest, name, batches):
    for batch in batches:
        member = np.zeros(batch.num_rows, bool)
        going = np.asarray(batch.column("__mine").to_numpy(zero_copy_only=False), bool)
        for level, (f, (words, _)) in enumerate(zip(fields, shared.value, strict=True)):
            places = np.asarray(batch.column(f).flatten()).reshape(-1, HASHES)
            hit = ((words[places >> 5] >> (places & 31).astype(np.uint32)) & 1).all(axis=1)
            member[going & ~hit] = level % 2 == 1
            going &= hit
        member[going] = len(fields) % 2 == 1
        before = np.asarray(batch.column(name).to_numpy(zero_copy_only=False), bool)
        yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in rest), pa.array(before | member)], [*rest, name])


def judge(pages: DataFrame, listed: DataFrame | None = None, rules=RULES) -> DataFrame:
    """page_id, host, path, rule, verdict, listed. ``listed`` holds blocked hosts in column ``host``; by default they are
    the hosts of ``pages`` that contain one of ``LISTED_PARTS``."""
    host, path = host_and_path(F.col("url"))
    rows = pages.select("page_id", host.alias("host"), path.alias("path"))
    hosts = rows.select("host")
    if listed is None:
        listed = hosts.where(F.col("host").rlike("|".join(LISTED_PARTS)))
    marked = Cascade.build(listed, hosts, "host").mark(rows, "host", "listed")
    rule, verdict = rule_for(F.col("host"), F.col("path"), rules)
    return marked.select("page_id", "host", "path", rule.alias("rule"),
                         F.coalesce(verdict, F.when(F.col("listed"), "block").otherwise("allow")).alias("verdict"), "listed")


JUDGE_SQL = r"""
WITH u AS (SELECT page_id, coalesce(CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) END, '') AS rest FROM pages),
h AS (SELECT page_id, regexp_extract(rest, '^([^?#]*)', 1) AS head FROM u),
p AS (SELECT page_id, translate(regexp_extract(head, '^([^/]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
             substr(head, length(regexp_extract(head, '^([^/]*)', 1)) + 1) AS path FROM h),
r AS (SELECT *, CASE WHEN (host = 'example.org' OR host LIKE '%.example.org') AND starts_with(path, '/en/1') THEN 'example.org/en/1'
                     WHEN (host = 'example.org' OR host LIKE '%.example.org') AND starts_with(path, '/es/') THEN 'example.org/es/'
                     WHEN (host = 'com' OR host LIKE '%.com') AND starts_with(path, '/fr/') THEN 'com/fr/'
                     WHEN (host = 'com' OR host LIKE '%.com') AND starts_with(path, '/de/') THEN 'com/de/'
                     WHEN (host = 'org' OR host LIKE '%.org') AND starts_with(path, '/') THEN 'org/' END AS rule,
             regexp_matches(host, 'adult|casino|porn|gambl|malware|phish') AS listed FROM p)
SELECT page_id, host, path, rule, listed,
       CASE WHEN rule IN ('example.org/en/1', 'example.org/es/', 'com/de/') THEN 'block' WHEN rule IS NOT NULL THEN 'allow'
            WHEN listed THEN 'block' ELSE 'allow' END AS verdict
FROM r"""
