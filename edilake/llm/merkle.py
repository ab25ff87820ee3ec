"""Merkle dataset manifest: a tree of digests over each group of rows, one more over the groups, and proofs of each row.

A row's leaf is the digest of its fields. Leaves are numbered within their group; then, level by level, every ``FANOUT``
consecutive nodes are a run and become one node of the next level. One window per level, partitioned by run and ordered
by place, has fixed-offset lag and lead columns, masked by the node's slot and the length of its run: they are its
siblings. The first child of a run hashes the parent, since its leads are the rest of the run. Windows hold a run, and a
level has a sixteenth of the rows of the one below. Numbers come from a range partitioning: a row's place in its
partition plus the rows of the group in earlier partitions, so no task holds a group. Siblings are never stored for the
leaves: from the top down, a node's path is its own siblings and its parent's path.

Defined results: a null field is ``-`` in the leaf, so null and empty differ. Rows without a group value are a group of
their own, which comes first. Rows without an order value come first in their group; rows with the same order value
stand by leaf digest, so repeated rows have the same leaf and stand together. An empty table has no rows and no root.
Columns that are not fields of the leaf do not matter, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from edilake.llm.io import keep, remove

FANOUT = 16
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
PATH = "array<struct<left:string,right:string>>"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def leaf_digest(fields: list[Column]) -> Column:
    """Digest of the fields, each as its UTF-8 length and value, so that no two rows of fields read alike."""
    values = [f.cast("string") for f in fields]
    return F.sha2(F.concat(*[F.coalesce(F.concat(F.octet_length(v).cast("string"), F.lit(":"), v), F.lit("-")) for v in values]), 256)


def numbered(rows: DataFrame, group: list[str], order: list[Column]) -> DataFrame:
    """``rows`` with ``pos``, the 0-based place in the group, and ``n``, the rows of the group. Group columns hold no nulls.
    Rows that ``order`` can't tell apart are dealt out by a random number, so that many of them are many partitions."""
    keys = [*(F.col(c).asc() for c in group), *order, F.col("__tie").asc()]
    dealt = rows.withColumn("__tie", F.rand(0)).repartitionByRange(*keys).sortWithinPartitions(*keys)
    placed = keep(dealt.drop("__tie").withColumns({"__part": F.spark_partition_id(), "__at": F.monotonically_increasing_id()}), "placed")
    own = placed.groupBy("__part", *group).agg(F.min("__at").alias("__first"), F.count("*").alias("__rows"))
    of_group = Window.partitionBy(*group)
    earlier = of_group.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = own.select("__part", *group, (F.coalesce(F.sum("__rows").over(earlier), F.lit(0)) - F.col("__first")).alias("__shift"),
                         F.sum("__rows").over(of_group).alias("n"))
    return placed.join(offsets, ["__part", *group]).withColumn("pos", F.col("__at") + F.col("__shift")).drop("__part", "__at", "__shift")


def with_siblings(nodes: DataFrame, group: list[str], fanout: int = FANOUT) -> DataFrame:
    """``nodes`` with ``run``, ``slot`` and the digests of the run's other nodes, joined: ``left`` of it and ``right``."""
    slot, run = F.col("slot"), F.col("run")
    placed = nodes.withColumns({"run": F.expr(f"pos div {fanout}"), "slot": (F.col("pos") % fanout).cast("int")})
    beside = Window.partitionBy(*group, "run").orderBy("pos")
    length = F.least(F.lit(fanout), F.col("n") - run * fanout)
    left = [F.when(slot >= k, F.lag("digest", k).over(beside)) for k in range(fanout - 1, 0, -1)]
    right = [F.when(slot + k < length, F.lead("digest", k).over(beside)) for k in range(1, fanout)]
    return placed.withColumns({"left": F.concat_ws("", *left), "right": F.concat_ws("", *right)})


def parents(nodes: DataFrame, group: list[str], fanout: int = FANOUT) -> DataFrame:
    """The next level of the groups that have several nodes: the first child of each run hashes it."""
    first = with_siblings(nodes.where("n > 1"), group, fanout).where("slot = 0")
    return first.select(*group, F.col("run").alias("pos"), F.ceil(F.col("n") / fanout).alias("n"),
                        F.sha2(F.concat("digest", "right"), 256).alias("digest"))


def levels(leaves: DataFrame, group: list[str], fanout: int = FANOUT) -> list[DataFrame]:
    """``leaves`` (group, pos, n, digest, ...) and the levels above them, up to where every group has one node."""
    out, most = [leaves], leaves.agg(F.max("n")).first()[0] or 0
    while most > 1:
        out.append(keep(parents(out[-1], group, fanout), "level"))
        most = -(-most // fanout)
    return out


def tops(tree: list[DataFrame], group: list[str]) -> DataFrame:
    """(group, digest): the node that remains of each group."""
    out = None
    for nodes in tree:
        ended = nodes.where("n = 1").select(*group, "digest")
        out = ended if out is None else out.unionByName(ended)
    return out


def with_paths(tree: list[DataFrame], group: list[str], above: DataFrame | None = None, fanout: int = FANOUT) -> DataFrame:
    """The leaves with ``top``, their group's remaining node, and ``path``, the siblings level by level up to it. ``above``
    (group, path, ...) goes on from there and adds its other columns."""
    more = [] if above is None else [c for c in above.columns if c not in (*group, "path")]
    found = None
    for nodes in reversed(tree):
        ended = nodes.where("n = 1").withColumn("top", F.col("digest"))
        ended = ended.withColumn("path", F.array().cast(PATH)) if above is None else ended.join(above, group)
        if found is not None:
            upper = found.select(*group, F.col("pos").alias("run"), F.col("path").alias("__rest"), "top", *more)
            going = with_siblings(nodes.where("n > 1"), group, fanout).join(upper, [*group, "run"])
            going = going.withColumn("path", F.concat(F.array(F.struct("left", "right")).cast(PATH), "__rest"))
            ended = ended.unionByName(going.select(ended.columns))
        found = ended
    return found


def fold(digest: Column, path: Column) -> Column:
    """The top that a node and the siblings on its path give."""
    return F.aggregate(path, digest, lambda d, s: F.sha2(F.concat(s["left"], d, s["right"]), 256))


def manifest(rows: DataFrame, leaf: Column, group: str = "source", order: str = "doc_id", fanout: int = FANOUT,
             carry: tuple[Column, ...] = ()) -> DataFrame:
    """``order``, leaf, subroot (of the row's group), root (of all groups), path, and the columns ``carry``."""
    key, extra = ["__given", "__group"], [c.alias(f"__carry{i}") for i, c in enumerate(carry)]
    leaves = rows.select(F.col(group).isNotNull().alias("__given"), F.coalesce(F.col(group).cast("string"), F.lit("")).alias("__group"),
                         F.col(order).alias("__order"), leaf.alias("digest"), *extra)
    # the texts are read once: sampling for the ranges reads the digests
    leaves = keep(leaves, "leaves")
    placed = numbered(leaves, key, [F.col("__order").asc_nulls_first(), F.col("digest").asc()])
    remove(leaves)
    low = levels(placed, key, fanout)
    subroots = tops(low, key).withColumn("__all", F.lit(0))
    high = levels(numbered(subroots, ["__all"], [F.col(c).asc() for c in key]), ["__all"], fanout)
    above = keep(with_paths(high, ["__all"], fanout=fanout).select(*key, "path", F.col("top").alias("__root")), "groups")
    found = with_paths(low, key, above, fanout)
    return found.select(F.col("__order").alias(order), F.col("digest").alias("leaf"), F.col("top").alias("subroot"),
                        F.col("__root").alias("root"), "path", *(f"__carry{i}" for i in range(len(carry))))


def verified(docs: DataFrame, tampered: Column, fields: tuple[str, ...] = FIELDS, changed: str = "text", fanout: int = FANOUT) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root, verified: every document against the manifest of all, where
    ``tampered`` after the A-Z of column ``changed`` have been lower-cased."""
    original = [F.col(c) for c in fields]
    altered = [F.translate(c, UPPER, LOWER) if name == changed else F.col(name) for name, c in zip(fields, original, strict=True)]
    later = F.when(F.coalesce(tampered, F.lit(False)), leaf_digest(altered))
    rows = manifest(docs, leaf_digest(original), fanout=fanout, carry=(later,))
    proof = F.sha2(F.array_join(F.transform("path", lambda s: F.concat(s["left"], s["right"])), ""), 256)
    return (rows.select("doc_id", "leaf", "subroot", "root", proof.alias("proof_sha256"),
                        fold(F.coalesce("__carry0", "leaf"), F.col("path")).alias("folded_root"))
            .withColumn("verified", F.col("folded_root") == F.col("root")))


def crc32_sql(text: str, table: str = "crc_table") -> str:
    """Unsigned CRC-32 of an ASCII string as DuckDB SQL, given the list ``table`` of ``CRC_TABLE_SQL``."""
    return (f"xor(list_reduce(list_prepend(4294967295, list_transform(string_split({text}, ''), lambda x: CAST(ord(x) AS BIGINT))), "
            f"lambda c, b: xor(c >> 8, {table}[(xor(c, b) & 255) + 1])), 4294967295)")


# the table of CRC-32 by its rule: eight shifts of each byte
CRC_TABLE_SQL = """SELECT list(c ORDER BY i) AS crc_table FROM (SELECT i, list_reduce(list_prepend(CAST(i AS BIGINT), [0, 0, 0, 0, 0, 0, 0, 0]),
    lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS c FROM range(256) t(i))"""


def verified_sql(fanout: int = FANOUT) -> str:
    field = lambda c: f"coalesce(concat(strlen(CAST({c} AS VARCHAR)), ':', CAST({c} AS VARCHAR)), '-')"
    leaf = "sha256(" + " || ".join(field(c) for c in FIELDS[:-1]) + " || {})"
    walk = lambda name, start, runs, keys: (
        f"{name} AS ({start} UNION ALL SELECT w.id, w.level + 1, {keys[0]}, w.pos // {fanout}, "
        f"w.proof || array_to_string(r.d[1:w.pos % {fanout}], '') || array_to_string(r.d[w.pos % {fanout} + 2:], ''), "
        f"sha256(array_to_string(r.d[1:w.pos % {fanout}], '') || w.folded || array_to_string(r.d[w.pos % {fanout} + 2:], '')) "
        f"FROM {name} w JOIN {runs} r ON r.level = w.level AND {keys[1]} AND r.run = w.pos // {fanout} WHERE r.n > 1)")
    grow = lambda name, start, key: (
        f"{name} AS ({start} UNION ALL SELECT level + 1, {key}, pos // {fanout}, sha256(string_agg(digest, '' ORDER BY pos)), "
        f"(any_value(n) + {fanout - 1}) // {fanout} FROM {name} WHERE n > 1 GROUP BY level, {key}, pos // {fanout})")
    runs = lambda name, nodes, key: (
        f"{name} AS (SELECT level, {key}, pos // {fanout} AS run, any_value(n) AS n, list(digest ORDER BY pos) AS d FROM {nodes} GROUP BY ALL)")
    lower = f"translate(text, '{UPPER}', '{LOWER}')"
    return f"""
WITH RECURSIVE crc AS ({CRC_TABLE_SQL}),
leaves AS (SELECT doc_id, source, {leaf.format(field('text'))} AS leaf,
  CASE WHEN doc_id IS NOT NULL AND {crc32_sql("CAST(doc_id AS VARCHAR)")} % 5 = 0 THEN {leaf.format(field(lower))} END AS altered
  FROM documents, crc),
placed AS (SELECT *, row_number() OVER () AS id, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos,
  count(*) OVER (PARTITION BY source) AS n FROM leaves),
{grow("nodes", "SELECT 0 AS level, source, pos, leaf AS digest, n FROM placed", "source")},
{runs("runs", "nodes", "source")},
subroots AS (SELECT source, digest, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS pos, count(*) OVER () AS n FROM nodes WHERE n = 1),
{grow("high", "SELECT 0 AS level, 0 AS one, pos, digest, n FROM subroots", "one")},
{runs("high_runs", "high", "one")},
{walk("low_walk", "SELECT id, 0 AS level, source, pos, '' AS proof, coalesce(altered, leaf) AS folded FROM placed", "runs",
      ("w.source", "r.source IS NOT DISTINCT FROM w.source"))},
reached AS (SELECT id, source, proof, folded FROM low_walk QUALIFY row_number() OVER (PARTITION BY id ORDER BY level DESC) = 1),
{walk("high_walk", "SELECT id, 0 AS level, 0 AS one, s.pos, proof, folded FROM reached r JOIN subroots s ON s.source IS NOT DISTINCT FROM r.source",
      "high_runs", ("w.one", "r.one = w.one"))},
ended AS (SELECT id, proof, folded FROM high_walk QUALIFY row_number() OVER (PARTITION BY id ORDER BY level DESC) = 1)
SELECT p.doc_id, p.leaf, s.digest AS subroot, h.digest AS root, sha256(e.proof) AS proof_sha256, e.folded AS folded_root, e.folded = h.digest AS verified
FROM placed p JOIN ended e ON e.id = p.id JOIN subroots s ON s.source IS NOT DISTINCT FROM p.source JOIN high h ON h.n = 1"""
