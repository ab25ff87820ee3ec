"""Lookups (Q1-Q12): filters, ranks and joins over ``loops`` and ``located`` segments.

``within`` names the loop the search starts from; the answer has one group per instance of it (``root_inst``).
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import store
from ..specs.model import Spec
from .loops import kept, rank_in_file


def _instance_of(loop_id: str, path_ids: Column) -> Column:
    at = F.array_position(path_ids, loop_id).cast("int")
    return F.when(at > 0, F.element_at("path_inst", at))


def with_path_ids(located: DataFrame) -> DataFrame:
    return located.withColumn("path_ids", F.split("node", "/"))


def find_loops(loops: DataFrame, loop_id: str, within: str = "ISA_LOOP", include_self: bool = False) -> DataFrame:
    """Q1: all loops with the id below each ``within``; order by ``loop_inst`` for document order."""
    root = _instance_of(within, F.col("path_ids"))
    found = loops.where(F.col("loop_id") == loop_id).withColumn("root_inst", root).where(F.col("root_inst").isNotNull())
    return found if include_self else found.where(F.col("root_inst") != F.col("loop_inst"))


def nth_loop(loops: DataFrame, loop_id: str, n: int = 0, within: str = "ISA_LOOP") -> DataFrame:
    """Q2: the n-th (0-based) such loop of each ``within``; no row past the end."""
    ranked = rank_in_file(find_loops(loops, loop_id, within), ["root_inst"], "loop_inst", "rn")
    return ranked.where(F.col("rn") == n + 1).drop("rn")


def has_loop(loops: DataFrame, loop_id: str, within: str = "ISA_LOOP") -> DataFrame:
    """Q3: the ``within`` loops that hold such a loop at any depth."""
    roots = loops.where(F.col("loop_id") == within)
    held = find_loops(loops, loop_id, within).select("file_id", F.col("root_inst").alias("loop_inst")).distinct()
    return roots.join(held, ["file_id", "loop_inst"], "left_semi")


def find_segments(located: DataFrame, loop_id: str, seg_id: str) -> DataFrame:
    """Q4: the loop's own segments with the id, not those of loops below it."""
    return kept(located).where((F.col("loop_id") == loop_id) & (F.col("seg_id") == seg_id))


def nth_segment(located: DataFrame, loop_id: str, seg_id: str, n: int = 0) -> DataFrame:
    """Q4: the n-th (0-based) such segment of each loop instance."""
    ranked = rank_in_file(find_segments(located, loop_id, seg_id), ["loop_inst", "seg_id"], "pos", "rn")
    return ranked.where(F.col("rn") == n + 1).drop("rn")


@dataclass(frozen=True)
class Address:
    """Where a value is: the n-th loop of an id, in it the m-th segment of an id, in it an element."""

    name: str
    loop_id: str
    seg_id: str
    ele_seq: int
    loop_no: int = 0
    seg_no: int = 0
    sub: int | None = None


def get_element(located: DataFrame, loops: DataFrame, address: Address, within: str = "ISA_LOOP") -> DataFrame:
    """Q5 + Q6: the addressed value of each ``within`` loop; no row if a step of the chain misses."""
    return get_elements(located, loops, [address], within)


def get_elements(located: DataFrame, loops: DataFrame, addresses: Sequence[Address], within: str = "ISA_LOOP") -> DataFrame:
    """Q5 for a list of addresses, one row per address and ``within`` loop.

    The addresses are a table of steps: loops of all ids are ranked once and those that some address goes through are
    kept; the segments in them are ranked once; then each row yields the values of the addresses that end there. Three
    shuffles, however many addresses there are.
    """
    steps: dict[tuple, list] = {}
    for x in addresses:
        steps.setdefault((x.loop_id, x.loop_no + 1, x.seg_id, x.seg_no + 1), []).append((x.name, x.ele_seq, x.sub))
    spark = located.sparkSession
    ends = F.broadcast(spark.createDataFrame(
        [(*k, v) for k, v in steps.items()],
        "loop_id string, loop_rank int, seg_id string, seg_rank int, picks array<struct<address:string,ele_seq:int,sub:int>>"))
    through = F.broadcast(spark.createDataFrame(sorted({k[:2] for k in steps}), "loop_id string, loop_rank int"))

    root = _instance_of(within, F.col("path_ids"))
    below = loops.where(F.col("loop_id").isin(*{k[0] for k in steps})).withColumn("root_inst", root).where("root_inst <> loop_inst")
    chosen = (rank_in_file(below, ["root_inst", "loop_id"], "loop_inst", "loop_rank").join(through, ["loop_id", "loop_rank"])
              .select("file_id", "loop_inst", "root_inst", "loop_rank"))
    wanted = kept(located).where(F.col("loop_id").isin(*{k[0] for k in steps}) & F.col("seg_id").isin(*{k[2] for k in steps}))
    segments = rank_in_file(wanted, ["loop_inst", "seg_id"], "pos", "seg_rank").where(F.col("seg_rank") <= max(k[3] for k in steps))
    found = segments.join(chosen, ["file_id", "loop_inst"]).join(ends, ["loop_id", "loop_rank", "seg_id", "seg_rank"])
    value = F.get("elements", F.col("pick.ele_seq"))
    parts = F.split(F.rtrim(value, F.col("sep.comp")), F.concat(F.lit("\\"), F.col("sep.comp")))
    return found.select("file_id", "isa_no", "root_inst", "loop_inst", "elements", "sep", F.explode("picks").alias("pick")).select(
        "file_id", "isa_no", "root_inst", "loop_inst", F.col("pick.address").alias("address"),
        F.when(F.col("pick.sub").isNull(), value).otherwise(F.get(parts, F.col("pick.sub"))).alias("value"))


def get_sub_element(value: Column, separator: Column, index: int) -> Column:
    """Q6: the sub-value at a 0-based index, or null."""
    return F.get(F.split(F.rtrim(value, separator), F.concat(F.lit("\\"), separator)), F.lit(index))


def subtree_size(located: DataFrame, loop_id: str | None = None) -> DataFrame:
    """Q7: segments in each loop and all below it. For one loop id no path needs to be exploded."""
    rows = kept(located)
    if loop_id:
        rows = rows.withColumn("inst", _instance_of(loop_id, F.split("node", "/"))).where(F.col("inst").isNotNull())
    else:
        rows = rows.select("file_id", "isa_no", F.explode("path_inst").alias("inst"))
    return rows.groupBy("file_id", "isa_no", F.col("inst").alias("loop_inst")).agg(F.count("*").alias("n_segments"))


def ancestor(loops: DataFrame, loop_id: str) -> DataFrame:
    """Q8: each loop with its nearest strict ancestor of the id (null if none)."""
    above = F.slice("path_ids", F.lit(1), F.size("path_ids") - 1)
    return loops.withColumn("ancestor_inst", _instance_of(loop_id, above))


def children(loops: DataFrame) -> DataFrame:
    """Q9: each child loop with its 1-based place in its parent."""
    return rank_in_file(loops.where(F.col("parent_inst").isNotNull()), ["parent_inst"], "loop_inst", "child_no")


def count_children(located: DataFrame, loops: DataFrame) -> DataFrame:
    """Q9: how many child loops and own segments each loop has. Both sides are combined before one shuffle."""
    own = kept(located).select("file_id", "loop_inst", F.lit(0).alias("loops"), F.lit(1).alias("segments"))
    below = loops.where(F.col("parent_inst").isNotNull()).select(
        "file_id", F.col("parent_inst").alias("loop_inst"), F.lit(1).alias("loops"), F.lit(0).alias("segments"))
    empty = loops.select("file_id", "loop_inst", F.lit(0).alias("loops"), F.lit(0).alias("segments"))
    return (own.unionByName(below).unionByName(empty).groupBy("file_id", "loop_inst")
            .agg(F.sum("loops").alias("n_loops"), F.sum("segments").alias("n_segments")))


@dataclass(frozen=True)
class Field:
    """A column of the wide extract: the first such element of the loop, typed."""

    name: str
    loop_id: str
    seg_id: str
    ele_seq: int
    sub: int | None = None
    qualifier: str | None = None  # value that element 01 must have
    cast: str = "string"


def _typed(value: Column, kind: str) -> Column:
    if kind == "date":
        return F.to_date(value, "yyyyMMdd")
    return value.cast(kind)


def _shared(a: tuple[str, ...], b: tuple[str, ...]) -> int:
    """How many loops two paths of the spec have in common, from the root."""
    return next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))


def flatten(located: DataFrame, fields: Sequence[Field], spec: Spec, per: str | None = None) -> DataFrame:
    """Q10: one row per instance of the loop ``per`` (that of the last field), with the first values of the loops around it,
    beside it and below it; null if the document has no such value.

    A loop and ``per`` have a deepest common ancestor in the spec: the loop itself if it is around ``per``, the parent of
    both if they are siblings, ``per`` itself if the loop is below. Its instance owns the value. One scan and one
    aggregate give a row per owner; each row of ``per`` then asks its owners, one row per level, with one join, however
    many loops there are. An owner is a single row, so a subscriber with very many claims only skews the asking side,
    which adaptive execution splits. Of several instances of a loop below the owner, the first counts, for all fields.
    """
    loop_ids = list(dict.fromkeys(f.loop_id for f in fields))
    per = per or fields[-1].loop_id
    paths = [path for path, _ in spec.nodes() if path[-1] in (*loop_ids, per)]
    ends = [path for path in paths if path[-1] == per]
    # `per` may stand at several places of the spec; what it shares with another loop depends on the place
    owners = [("/".join(p), [(k, _shared(p, q)) for k, q in enumerate(ends) if p[-1] != per or p == q],
               sorted({_shared(p, q) for q in paths if q[-1] != per and _shared(p, q) < len(p)}) if p[-1] == per else []) for p in paths]
    # a loop whose parent is missing stands alone
    owners.append((per, [(-1, 1)], []))
    table = F.broadcast(located.sparkSession.createDataFrame(
        owners, "node string, owners array<struct<place:int,depth:int>>, ask array<int>"))

    seg_ids = sorted({f.seg_id for f in fields})
    wanted = F.col("loop_id").isin(*{*loop_ids, per}) & (F.col("seg_id").isin(*seg_ids) | (F.col("role") == "start"))
    rows = kept(located).where(wanted).join(table, "node").select(
        "file_id", "loop_id", "loop_inst", "pos", "seg_id", "elements", "sep.comp", "path_inst", "ask",
        ((F.col("loop_id") == per) & (F.col("role") == "start")).alias("opens"),
        F.inline(F.transform("owners", lambda d: F.struct(d["place"].alias("place"), F.get("path_inst", d["depth"] - 1).alias("owner")))))

    def first(f: Field) -> Column:
        value = F.get("elements", F.lit(f.ele_seq))
        if f.sub is not None:
            value = get_sub_element(value, F.col("comp"), f.sub)
        here = (F.col("loop_id") == f.loop_id) & (F.col("seg_id") == f.seg_id)
        if f.qualifier is not None:
            here &= F.get("elements", F.lit(1)) == f.qualifier
        # min_by takes the first in document order and, unlike a window, combines before the shuffle
        return F.min_by(F.when(here, F.struct(F.col("loop_inst").alias("inst"), value.alias("value"))),
                        F.when(here, F.struct("loop_inst", "pos")))

    held = rows.groupBy("file_id", "owner", "place").agg(
        F.max(F.when(F.col("opens"), F.struct("path_inst", "ask"))).alias("asks"),
        *[F.min(F.when(F.col("loop_id") == k, F.col("loop_inst"))).alias(f"inst_{k}") for k in loop_ids],
        *[first(f).alias(f.name) for f in fields])
    # read twice, and one shuffle does not serve both readers
    held = store(held, f"owners/{uuid.uuid4().hex}")
    values = {k: F.struct(F.col(f"inst_{k}").alias("inst"), *[
        F.when(F.col(f"{f.name}.inst") == F.col(f"inst_{k}"), F.col(f"{f.name}.value")).alias(f.name)
        for f in fields if f.loop_id == k]).alias(f"of_{k}") for k in loop_ids}
    own = held.where("asks IS NOT NULL").select("file_id", F.col("owner").alias("inst"), "place", "asks", *values.values())
    if any(ask for _, _, ask in owners):
        around = held.where("asks IS NULL").select("file_id", "owner", "place", *[v.alias(f"around_{k}") for k, v in values.items()])
        asking = own.select("file_id", "inst", "place", *[f"of_{k}" for k in loop_ids], F.explode_outer(
            F.transform("asks.ask", lambda d: F.struct(d.alias("level"), F.element_at("asks.path_inst", d).alias("owner")))).alias("q"))
        asking = asking.select("file_id", "inst", "place", *[f"of_{k}" for k in loop_ids], "q.level", "q.owner")
        nearest = [F.coalesce(F.first(F.when(F.col(f"of_{k}.inst").isNotNull(), F.col(f"of_{k}")), ignorenulls=True),
                              F.max_by(f"around_{k}", F.when(F.col(f"around_{k}.inst").isNotNull(), F.col("level")))).alias(f"of_{k}")
                   for k in loop_ids]
        own = asking.join(around, ["file_id", "owner", "place"], "left").groupBy("file_id", "inst").agg(*nearest)
    return own.select("file_id", F.col("inst").alias("row_inst"), *[F.col(f"of_{k}.inst").alias(f"inst_{k}") for k in loop_ids],
                      *[_typed(F.col(f"of_{f.loop_id}.{f.name}"), f.cast).alias(f.name) for f in fields])


# ---------------------------------------------------------------------------------------------------------
# Q11


def plain_elements() -> Column:
    """The elements with one sign for every document's own component separator, so that documents that differ in their
    delimiters only are equal."""
    return F.transform("elements", lambda e: F.replace(e, F.col("sep.comp"), F.lit("\u001d")))


def _halves(*words: Column) -> list[Column]:
    """The halves of 64-bit words as numbers whose sums can't overflow."""
    return [half for w in words for half in (F.shiftrightunsigned(w, 32), w.bitwiseAND(F.lit((1 << 32) - 1)))]


def fingerprint_documents(located: DataFrame, skip: Sequence[str] = (), within: str = "ISA_LOOP") -> DataFrame:
    """Q11: a value for each ``within`` loop that is equal for equal content (segment ids and elements, in order).

    The digest of a loop is the sum of the digests of its segments, each taken with its place in the loop. Sums
    combine before the shuffle, so no task ever holds the text of one document. ``skip`` names segments, such as
    control segments, that may differ. Delimiters are ignored.
    """
    rows = kept(located).withColumn("root_inst", _instance_of(within, F.split("node", "/")))
    rows = rows.where(F.col("root_inst").isNotNull() & ~F.col("seg_id").isin(*skip))
    place = F.col("pos") - F.floor(F.col("root_inst") / 2)
    digest = F.sha2(F.concat_ws("\u001f", place.cast("string"), F.col("node"), F.concat_ws("\u001e", plain_elements())), 256)
    rows = rows.select("file_id", "isa_no", "root_inst", digest.alias("digest"))
    words = _halves(*[F.xxhash64(F.lit(k), "digest") for k in range(2)])
    return rows.groupBy("file_id", "isa_no", "root_inst").agg(
        F.count("*").alias("n_segments"), *[F.sum(w).alias(f"digest_{k}") for k, w in enumerate(words)])


DIGEST = ["n_segments", "digest_0", "digest_1", "digest_2", "digest_3"]


def dedup_documents(fingerprints: DataFrame) -> DataFrame:
    """Q11: the first of each group of equal documents."""
    first = fingerprints.groupBy(*DIGEST).agg(
        F.min(F.struct("file_id", "isa_no", "root_inst")).alias("f"), F.count("*").alias("copies"))
    return first.select("f.file_id", "f.isa_no", "f.root_inst", "n_segments", "copies")


def same_document(left: DataFrame, right: DataFrame) -> DataFrame:
    """Q11: the segments on which two tables of documents differ; empty if they are equal. Delimiters are ignored."""
    def side(rows: DataFrame, sign: int) -> DataFrame:
        return kept(rows).select("file_id", "isa_no", "pos", "node", "elements", plain_elements().alias("plain"), F.lit(sign).alias("side"))

    columns = ["file_id", "isa_no", "pos", "node"]
    both = side(left, 1).unionByName(side(right, -1))
    surplus = both.groupBy(*columns, "plain").agg(F.sum("side").alias("side"), F.first("elements").alias("elements")).where("side <> 0")
    return surplus.select(*columns, "elements", F.when(F.col("side") > 0, "left").otherwise("right").alias("only_in"),
                          F.explode(F.sequence(F.lit(1), F.abs("side"))).alias("copy")).drop("copy")


def loop_digests(located: DataFrame) -> DataFrame:
    """Q11: one row per loop instance with the digest of all its segments, those of the loops below it included.

    A segment counts into every loop that is open at it, with its place in that loop and the loops between, so equal loops
    have equal digests wherever they stand. Its text is digested once; only numbers are hashed for each of those loops. Sums
    combine before the shuffle, in a table of numbers only: a loop of any size is no hot spot, and nothing is sorted.
    """
    # two independent words of the text's digest
    text = F.sha2(F.concat_ws("\u001e", plain_elements()), 256)
    rows = kept(located).select("file_id", "isa_no", "pos", "node", "path_inst", text.alias("text"))
    rows = rows.select("file_id", "isa_no", "pos", "node", "path_inst", *[F.xxhash64(F.lit(k), "text").alias(f"text_{k}") for k in range(2)])
    depth = F.size(F.split("node", "/"))
    rows = rows.select("file_id", "isa_no", "pos", "node", depth.alias("depth"), "path_inst", "text_0", "text_1",
                       F.posexplode("path_inst").alias("level", "loop_inst"))
    place = F.col("pos") - F.floor((F.col("loop_inst") + 1) / 2)
    below = F.call_function("substring_index", F.col("node"), F.lit("/"), F.least(F.col("level") + 1 - F.col("depth"), F.lit(0)).cast("int"))
    rows = rows.select("file_id", "isa_no", "loop_inst", F.get("path_inst", F.col("level") - 1).alias("parent_inst"), F.get(
        F.split("node", "/"), F.col("level")).alias("loop_id"), *[F.xxhash64(f"text_{k}", place, below).alias(f"hash_{k}") for k in range(2)])
    words = _halves(F.col("hash_0"), F.col("hash_1"))
    return rows.groupBy("file_id", "isa_no", "loop_inst", "loop_id").agg(
        F.min("parent_inst").alias("parent_inst"), F.count("*").alias("n_segments"), *[F.sum(w).alias(f"digest_{k}") for k, w in enumerate(words)])


def differing_loops(left: DataFrame, right: DataFrame) -> DataFrame:
    """Q11: the smallest loops in which two tables of documents differ; empty if they are equal. Delimiters are ignored.

    Within an interchange, loops of one id are compared as a multiset of contents, so a loop that is inserted or moved makes
    no others differ. ``only_in`` has ``copies`` more of a content than the other side; ``loop_inst`` is the last of them. A
    loop is left out if one below it has a content that the other side lacks altogether.
    """
    key = ["file_id", "isa_no", "loop_id", *DIGEST]
    both = loop_digests(left).withColumn("side", F.lit(1)).unionByName(loop_digests(right).withColumn("side", F.lit(-1)))
    # read three times below
    both = store(both, f"loop-digests/{uuid.uuid4().hex}")
    groups = both.groupBy(*key).agg(
        F.sum("side").alias("surplus"), F.count("*").alias("n"),
        F.max(F.when(F.col("side") > 0, F.col("loop_inst"))).alias("left"), F.max(F.when(F.col("side") < 0, F.col("loop_inst"))).alias("right"))
    groups = store(groups.where("surplus <> 0").withColumn("side", F.signum("surplus").cast("int")), f"loop-digests/{uuid.uuid4().hex}")
    lacked = groups.where(F.abs("surplus") == F.col("n")).select(*key, "side")
    parents = both.join(lacked, [*key, "side"]).select("file_id", "isa_no", F.col("parent_inst").alias("loop_inst"), "side").distinct()
    above = both.join(parents, ["file_id", "isa_no", "loop_inst", "side"], "left_semi").select(*key, "side").distinct()
    return groups.join(above, [*key, "side"], "left_anti").select(
        "file_id", "isa_no", "loop_id", F.when(F.col("side") > 0, F.col("left")).otherwise(F.col("right")).alias("loop_inst"),
        F.when(F.col("side") > 0, "left").otherwise("right").alias("only_in"), F.abs("surplus").alias("copies"))


def envelope_counts(located: DataFrame) -> DataFrame:
    """Q12: the counts that trailers claim (SE01 segments, GE01 sets, IEA01 groups) next to the real ones."""
    rows = kept(located).select("file_id", "isa_no", "gs_no", "st_no", "seg_id", F.get("elements", F.lit(1)).alias("v"))
    in_set = rows.where((F.col("st_no") > 0) & ~F.col("seg_id").isin("GE", "IEA", "GS", "ISA"))
    level = lambda name, keys, df, unit, trailer: df.groupBy("file_id", "isa_no", *keys).agg(
        F.count(F.when(unit, 1)).alias("actual"), F.max(F.when(F.col("seg_id") == trailer, F.col("v"))).alias("claimed"),
    ).select("file_id", "isa_no", *[F.col(k) if k in keys else F.lit(None).cast("bigint").alias(k) for k in ("gs_no", "st_no")],
             F.lit(name).alias("envelope"), "claimed", "actual")
    sets = level("ST", ["gs_no", "st_no"], in_set, F.lit(True), "SE")
    groups = level("GS", ["gs_no"], rows.where("gs_no > 0"), F.col("seg_id") == "ST", "GE")
    interchanges = level("ISA", [], rows, F.col("seg_id") == "GS", "IEA")
    return sets.unionByName(groups).unionByName(interchanges)
