"""Building documents from tables.

``claim_documents`` writes customers, orders and order lines as professional claims: one interchange per customer,
one claim per order, one service line per order line. Segment text is made by projection, lines are gathered per
claim and claims per interchange.

A group is gathered in one row only while it is small. Customers above ``limit`` segments are found first by counting
their keys; their claims and lines are sorted over the cluster, by the same order as in short documents, and leave in
pieces of ``ROWS_PER_CHUNK`` rows. So a document's text does not depend on the limit, however long it or one of its
claims is.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import store
from .framing import SLICE_SEGMENTS, raw_part
from .writing import assemble

ROWS_PER_CHUNK = 8192
VERSION = "005010X222A1"

# order of the parts of a long document: head, pieces of the body, trailer
HEAD_PART, TRAILER_PART = -1, (1 << 63) - 1


@dataclass(frozen=True)
class Variant:
    """What to write: ``dirty`` plants defects by key, ``providers`` adds rendering providers to claims and lines,
    ``copies`` repeats some claims, ``packs`` puts the interchanges of many customers in one file."""

    name: str
    dirty: bool = False
    providers: bool = False
    copies: bool = False
    packs: int | None = None


CLEAN = Variant("clean")
DIRTY = Variant("dirty", dirty=True)
PROVIDERS = Variant("providers", providers=True)
COPIES = Variant("copies", copies=True)
PACKED = Variant("packed", packs=16)
VARIANTS = {v.name: v for v in (CLEAN, DIRTY, PROVIDERS, COPIES, PACKED)}


def _join(separator: Column, values: list[Column]) -> Column:
    """``concat_ws`` with a separator that is a column."""
    return F.call_function("concat_ws", separator, *values)


class _Text:
    """Segment text with the delimiters of the row's file."""

    def __init__(self, file_key: Column):
        odd = file_key % 7 == 0
        self.seg = F.when(odd, "|").otherwise("~")
        self.ele = F.when(odd, "^").otherwise("*")
        self.comp = F.when(odd, ">").otherwise(":")

    def segment(self, *elements) -> Column:
        parts = [e if isinstance(e, Column) else F.lit(e) for e in elements]
        return F.concat(_join(self.ele, [F.coalesce(p.cast("string"), F.lit("")) for p in parts]), self.seg)

    def composite(self, *values) -> Column:
        return _join(self.comp, [(v if isinstance(v, Column) else F.lit(v)).cast("string") for v in values])


def documents_from_segments(rows: DataFrame, order: list[str], seg: str = "~", ele: str = "*") -> DataFrame:
    """W1 for any tables: one row per segment (``file_id``, ``elements`` starting with the segment id, and columns
    that order the segments of a document) to ``raw`` documents. Composite elements come joined already.

    Documents are counted first; those longer than a part leave as ordered pieces.
    """
    sizes = rows.groupBy("file_id").agg(F.count("*").alias("_size"))
    texts = rows.join(sizes, "file_id").select(
        "file_id", F.lit(1).alias("isa_no"), (F.col("_size") > SLICE_SEGMENTS).alias("multi"), *order,
        F.concat(F.concat_ws(ele, "elements"), F.lit(seg)).alias("text"))
    pieces = assemble(texts, order, packed=False)
    # pieces are cut anywhere, so the head comes from the first two segments themselves
    ordered = F.struct(*order, "text")
    long = texts.where("multi")
    first = long.groupBy("file_id").agg(F.min(ordered).alias("isa"))
    heads = (long.join(first, "file_id").where(ordered > F.col("isa")).groupBy("file_id", "isa").agg(F.min(ordered).alias("gs"))
             .select("file_id", F.concat("isa.text", "gs.text").alias("head")))
    return pieces.join(heads, "file_id", "left").select(
        "file_id", F.col("file_id").alias("path"), raw_part(minor=F.col("piece")).alias("part"), "multi", "head",
        F.col("text").alias("content"))


def _defect(key: Column, moduli: tuple[int, ...]) -> Column:
    """The smallest listed modulus that divides the key, else 0."""
    out = F.lit(0)
    for m in reversed(moduli):
        out = F.when(key % m == 0, m).otherwise(out)
    return out


def money(value: Column) -> Column:
    return value.cast("decimal(18,2)").cast("string")


def _line_text(t: _Text, v: Variant) -> Column:
    part_defect = _defect(F.col("l_partkey"), (29, 53)) if v.dirty else F.lit(0)
    lx = t.segment("LX", F.col("l_linenumber"))
    sv1 = t.segment("SV1", t.composite("HC", F.col("l_partkey")),
                    F.when(part_defect == 29, "").otherwise(money(F.col("l_extendedprice"))),
                    F.when(part_defect == 53, "XX").otherwise("UN"), F.col("l_quantity").cast("int"))
    dtp = t.segment("DTP", "472", "D8", F.date_format("l_shipdate", "yyyyMMdd"))
    swapped = (_defect(F.col("l_orderkey"), (11, 13, 17, 19, 23)) == 19) if v.dirty else F.lit(False)
    text = F.when(swapped, F.concat(lx, dtp, sv1)).otherwise(F.concat(lx, sv1, dtp))
    if v.providers:
        rendering = t.segment("NM1", "82", "1", "LINE", "", "", "", "", "XX", F.col("l_suppkey"))
        text = F.concat(text, F.when(F.col("l_orderkey") % 5 == 0, rendering).otherwise(""))
    return text


def _claim_text(t: _Text, v: Variant) -> Column:
    defect = _defect(F.col("o_orderkey"), (11, 13, 17, 19, 23)) if v.dirty else F.lit(0)
    clm = t.segment("CLM", F.col("o_orderkey"), money(F.col("o_totalprice")), "", "",
                    F.when(defect == 13, "").otherwise(t.composite("11", "B", "1")), "Y", "A", "Y", "Y")
    hi = t.segment("HI", t.composite("BK", F.substring("o_orderpriority", 1, 1)))
    text = F.concat(clm, F.when(defect == 11, "").when(defect == 17, F.concat(hi, hi))
                    .when(defect == 23, t.segment("ZZZ", "1")).otherwise(hi))
    if v.providers:
        rendering = t.segment("NM1", "82", "1", "CLAIM", "", "", "", "", "XX", F.col("o_orderkey"))
        text = F.concat(text, F.when(F.col("o_orderkey") % 3 == 0, rendering).otherwise(""))
    return text


def _control(key: Column) -> Column:
    return F.lpad((key % 1_000_000_000).cast("string"), 9, "0")


def _head_text(t: _Text, v: Variant) -> tuple[Column, Column]:
    """(ISA and GS, the other segments up to the first claim)."""
    key, nation, market = F.col("c_custkey"), F.col("c_nationkey"), F.col("c_mktsegment")
    defect = _defect(key, (31, 37, 41, 43, 47)) if v.dirty else F.lit(0)
    sender = F.when(defect == 31, "SENDER").otherwise(F.rpad(F.lit("SENDER"), 15, " "))
    isa = t.segment("ISA", "00", " " * 10, "00", " " * 10, "ZZ", sender, "ZZ", F.rpad(F.lit("RECEIVER"), 15, " "),
                    "230101", "1200", "U", "00501", _control(key), "0", "P", t.comp)
    gs = t.segment("GS", "HC", "SENDER", "RECEIVER", "20230101", "1200", key, "X",
                   F.when(defect == 37, "005010X999").otherwise(VERSION))
    billing = F.concat(t.segment("NM1", "85", "2", F.concat(F.lit("NATION "), nation), "", "", "", "", "XX", nation),
                       t.segment("N3", F.concat(nation, F.lit(" MAIN STREET"))),
                       t.segment("N4", F.concat(F.lit("CITY "), nation), "MD", "20705"),
                       t.segment("REF", "EI", nation))
    rest = F.concat(
        t.segment("ST", "837", "0001", VERSION),
        t.segment("BHT", "0019", "00", key, "20230101", "1200", "CH"),
        t.segment("NM1", "41", "2", "SUBMITTER", "", "", "", "", "46", "S1"),
        t.segment("PER", "IC", "DESK", "TE", "5550100"),
        t.segment("NM1", "40", "2", "RECEIVER", "", "", "", "", "46", "R1"),
        t.segment("HL", "1", "", "20", "1"),
        billing, F.when(defect == 43, billing).otherwise(""),
        t.segment("HL", "2", "1", F.when(defect == 47, "99").otherwise("22"), "0"),
        t.segment("SBR", "P", "", market, "", "", "", "", "", "CI"),
        F.when(defect == 41, "").otherwise(
            t.segment("NM1", "IL", "1", F.col("c_name"), "", "", "", "", "MI", key)),
        t.segment("NM1", "PR", "2", market, "", "", "", "", "PI", market))
    return F.concat(isa, gs), rest


def _trailer_text(t: _Text, n_orders: Column, n_lines: Column) -> Column:
    key = F.col("c_custkey")
    return F.concat(t.segment("SE", 16 + 2 * n_orders + 3 * n_lines - 1, "0001"),
                    t.segment("GE", "1", key), t.segment("IEA", "1", _control(key)))


def _joined(*order: str) -> Column:
    """The texts of a group in the given order."""
    rows = F.sort_array(F.collect_list(F.struct(*order, "text")))
    return F.array_join(F.transform(rows, lambda r: r["text"]), "")


def line_texts(lineitem: DataFrame, orders: DataFrame, variant: Variant = CLEAN) -> DataFrame:
    """W1, one row per order line: its segments as text."""
    rows = lineitem.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    return rows.withColumn("text", _line_text(_Text(_file_key(F.col("o_custkey"), variant)), variant))


def _file_key(custkey: Column, v: Variant) -> Column:
    return custkey % v.packs if v.packs else custkey


LINE_ORDER = ["l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", "l_quantity", "l_extendedprice"]


def _copies(v: Variant) -> Column:
    return F.when(F.col("o_orderkey") % 9 == 0, 2).otherwise(1) if v.copies else F.lit(1)


def claim_texts(lineitem: DataFrame, orders: DataFrame, variant: Variant = CLEAN) -> DataFrame:
    """W1, one row per order: the claim and its lines as text (``o_orderkey, o_custkey, n_lines, text``). Both
    sides are hashed on the order key once, and the grouping reuses that partitioning."""
    t = _Text(_file_key(F.col("o_custkey"), variant))
    columns = ["o_orderkey", "o_custkey", "o_totalprice", "o_orderpriority"]
    lines = (line_texts(lineitem, orders.select("o_orderkey", "o_custkey"), variant)
             .groupBy("l_orderkey").agg(_joined(*LINE_ORDER).alias("lines"), F.count("*").alias("n_lines")))
    copies = _copies(variant)
    text = F.concat(_claim_text(t, variant), F.coalesce("lines", F.lit("")))
    return (orders.select(*columns).join(lines, F.col("o_orderkey") == F.col("l_orderkey"), "left")
            .select("o_orderkey", "o_custkey", F.coalesce("n_lines", F.lit(0)).alias("n_lines"), copies.alias("copies"),
                    F.repeat(text, copies).alias("text")))


def _document(customer: DataFrame, v: Variant) -> DataFrame:
    t = _Text(_file_key(F.col("c_custkey"), v))
    first, rest = _head_text(t, v)
    name = F.format_string("%d", F.col("c_custkey"))
    return customer.select(
        "c_custkey",
        (F.concat(F.lit("pack-"), F.col("c_custkey") % v.packs) if v.packs else name).alias("file_id"),
        first.alias("first"), rest.alias("rest"))


def _part(minor: Column, v: Variant) -> Column:
    major = F.col("c_custkey") if v.packs else F.lit(0)
    return F.struct(major.cast("bigint").alias("major"), minor.cast("bigint").alias("minor"), F.lit(0).alias("slice"))


def _raw(rows: DataFrame, minor: Column, multi: bool, v: Variant, content: Column) -> DataFrame:
    return rows.select("file_id", F.col("file_id").alias("path"), _part(minor, v).alias("part"),
                       F.lit(multi).alias("multi"), (F.col("first") if multi else F.lit(None).cast("string")).alias("head"),
                       content.alias("content"))


def claim_documents(customer: DataFrame, orders: DataFrame, lineitem: DataFrame, variant: Variant = CLEAN,
                    limit: int = SLICE_SEGMENTS) -> DataFrame:
    """``raw`` documents for all customers with orders. Documents of more than ``limit`` segments leave in parts."""
    v = variant
    orders = orders.select("o_orderkey", "o_custkey", "o_totalprice", "o_orderpriority")
    sizes = customer_sizes(orders, lineitem, v).where(2 * F.col("n_orders") + 3 * F.col("n_lines") > limit)
    # a list of at most total / limit customers, read by several joins
    long_customers = store(sizes, f"long-customers/{uuid.uuid4().hex}")
    has_long = not long_customers.isEmpty()

    short_orders = orders.join(long_customers, "o_custkey", "left_anti") if has_long else orders
    bodies = claim_texts(lineitem, short_orders, v).groupBy("o_custkey").agg(
        _joined("o_orderkey").alias("body"), F.sum("copies").alias("n_orders"),
        F.sum(F.col("copies") * F.col("n_lines")).alias("n_lines"))
    documents = _document(customer, v).join(bodies, F.col("c_custkey") == F.col("o_custkey"))
    t = _Text(_file_key(F.col("c_custkey"), v))
    whole = F.concat("first", "rest", "body", _trailer_text(t, F.col("n_orders"), F.col("n_lines")))
    raw = _raw(documents, F.lit(0), v.packs is not None, v, whole)
    if has_long:
        raw = raw.unionByName(_long_documents(customer, orders, lineitem, long_customers, v))
    return raw


def customer_sizes(orders: DataFrame, lineitem: DataFrame, variant: Variant = CLEAN) -> DataFrame:
    """Claims and lines per customer; reads keys only and combines them before each shuffle."""
    lines = lineitem.groupBy("l_orderkey").agg(F.count("*").alias("n"))
    return (orders.select("o_orderkey", "o_custkey").join(lines, F.col("o_orderkey") == F.col("l_orderkey"), "left")
            .groupBy("o_custkey").agg(F.sum(_copies(variant)).alias("n_orders"), F.coalesce(F.sum(_copies(variant) * F.col("n")), F.lit(0)).alias("n_lines")))


def _long_documents(customer: DataFrame, orders: DataFrame, lineitem: DataFrame, long_customers: DataFrame, v: Variant) -> DataFrame:
    """Customers above the limit: one row per claim head and line, range partitioned by customer, order, copy and the
    order of lines, and cut every ``ROWS_PER_CHUNK`` rows. The number of a piece is the place of its rows in the global
    sort, so pieces of a document ascend; rows that the sort can't tell apart have the same text."""
    head = _document(customer, v).join(long_customers, F.col("c_custkey") == F.col("o_custkey")).drop("o_custkey")
    t = _Text(_file_key(F.col("c_custkey"), v))
    ends = (_raw(head, F.lit(HEAD_PART), True, v, F.concat("first", "rest"))
            .unionByName(_raw(head, F.lit(TRAILER_PART), True, v, _trailer_text(t, F.col("n_orders"), F.col("n_lines")))))

    orders = orders.join(long_customers.select("o_custkey"), "o_custkey", "left_semi")
    copy = F.explode(F.sequence(F.lit(1), _copies(v))).alias("copy")
    lines = line_texts(lineitem, orders.select("o_orderkey", "o_custkey"), v).select("o_custkey", "o_orderkey", copy, *LINE_ORDER, "text")
    claim_text = _claim_text(_Text(_file_key(F.col("o_custkey"), v)), v)
    # a claim comes before its lines, as its line number is null
    heads = orders.select("o_custkey", "o_orderkey", copy, *[F.lit(None).cast(lines.schema[c].dataType).alias(c) for c in LINE_ORDER],
                          claim_text.alias("text")).withColumn("is_line", F.lit(False))
    order = ["o_custkey", "o_orderkey", "copy", "is_line", *LINE_ORDER]
    rows = heads.unionByName(lines.withColumn("is_line", F.lit(True))).repartitionByRange(*order).sortWithinPartitions(*order)
    rows = rows.withColumn("at", F.monotonically_increasing_id())
    bodies = (rows.groupBy("o_custkey", F.floor(F.col("at") / ROWS_PER_CHUNK).alias("minor")).agg(_joined("at").alias("body"))
              .join(head.select("c_custkey", "file_id", "first"), F.col("o_custkey") == F.col("c_custkey")))
    return ends.unionByName(_raw(bodies, F.col("minor"), True, v, F.col("body")))
