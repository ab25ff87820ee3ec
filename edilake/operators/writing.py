"""Writing documents back as text (K1-K7).

A document is an ordered set of text fragments. ``assemble`` joins them: documents of one part in one row each,
long documents in ordered pieces of bounded size, so that no task holds a whole one.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.arrays import lookup
from ..functions.scan import exclusive_scan
from ..session import store
from ..specs.model import Spec, spec_tables
from .framing import split_trimmed
from .loops import kept

# Line breaks of the writer.
LINE_BREAKS = {"NONE": "", "LF": "\n", "CRLF": "\r\n"}

ROWS_PER_PIECE = 16384


def segment_text(elements: Column | str = "elements", separator: Column | None = None) -> Column:
    """Id and elements joined by the element separator."""
    return F.call_function("concat_ws", F.col("sep.ele") if separator is None else separator,
                           F.col(elements) if isinstance(elements, str) else elements)


def assemble(rows: DataFrame, order: list[str], end: Column | None = None, packed: bool = True) -> DataFrame:
    """Join ``text`` of the rows of each interchange in the given order: ``file_id, isa_no, multi, piece, text``.

    Pieces of a long document have ``multi`` set; put together in the order of ``piece`` they are its text. A long document
    may hold many interchanges: those of at most ``ROWS_PER_PIECE`` rows are one piece each and need no global sort. Say
    ``packed=False`` if a document is one interchange."""
    def joined() -> Column:
        sorted_rows = F.sort_array(F.collect_list(F.struct(*order, "text")))
        return F.array_join(F.transform(sorted_rows, lambda r: r["text"]), "")

    key, columns = ["file_id", "isa_no"], ["file_id", "isa_no", "multi", *order, "text"]
    short, long = rows.where(~F.col("multi")), rows.where("multi")
    if packed:
        # a list of at most total / ROWS_PER_PIECE interchanges
        above = long.groupBy(*key).agg(F.count("*").alias("n")).where(F.col("n") > ROWS_PER_PIECE).select(*key, F.lit(True).alias("is_long"))
        above = store(above, f"long-interchanges/{uuid.uuid4().hex}")
        if above.isEmpty():
            short, long = rows, None
        else:
            marked = rows.select(*columns).join(above, [*[rows[k].eqNullSafe(above[k]) for k in key], rows["multi"]], "left").select(
                *[rows[c] for c in columns], "is_long")
            short, long = marked.where("is_long IS NULL"), marked.where("is_long")
    whole = (short.select(*columns).groupBy(*key, "multi").agg(joined().alias("text"))
             .select(*key, "multi", F.lit(0).cast("bigint").alias("piece"), "text"))
    if long is None:
        return whole if end is None else whole.withColumn("text", F.concat("text", end))
    # a range partition of a global sort, cut every ROWS_PER_PIECE rows
    ranged = (long.select(*columns).repartitionByRange("file_id", "isa_no", *order)
              .sortWithinPartitions("file_id", "isa_no", *order)
              .withColumn("piece", F.floor(F.monotonically_increasing_id() / ROWS_PER_PIECE)))
    pieces = ranged.groupBy("file_id", "isa_no", "piece").agg(joined().alias("text")).withColumn("multi", F.lit(True))
    out = whole.unionByName(pieces.select(*whole.columns))
    if end is None:
        return out
    last = pieces.groupBy("file_id", "isa_no").agg(F.max("piece").alias("last"))
    long = pieces.join(last, ["file_id", "isa_no"]).withColumn(
        "text", F.when(F.col("piece") == F.col("last"), F.concat("text", end)).otherwise(F.col("text")))
    return whole.withColumn("text", F.concat("text", end)).unionByName(long.select(*whole.columns))


def write_source_order(located: DataFrame, line_break: str = "NONE") -> DataFrame:
    """K1: each loop's segments (trailers included), then the loops below it, in the order they were read."""
    rows = kept(located).withColumn("text", F.concat(segment_text(), F.col("sep.seg"), F.lit(LINE_BREAKS[line_break])))
    return assemble(rows, ["loop_inst", "pos"])


def spec_order_key(located: DataFrame, spec: Spec) -> DataFrame:
    """K2: add ``spec_key``. Children of a loop, segments and loops alike, sort by spec position as text, then id;
    equal ones keep their order. Segments the spec does not know in their loop are left out."""
    spark = located.sparkSession
    levels = {"/".join(path): [(_loop(spec, path[:i + 1]).pos, xid) for i, xid in enumerate(path)] for path, _ in spec.nodes()}
    first: dict[tuple[str, str], str] = {}
    for loop_id, node in spec.by_id().items():
        for s in node.segments:
            first[loop_id, s.xid] = min(s.pos, first.get((loop_id, s.xid), s.pos))
    # position and id as one number, so that rows carry and compare numbers only
    rank = {x: i for i, x in enumerate(sorted({x for path in levels.values() for x in path} | {(v, k[1]) for k, v in first.items()}))}
    nodes = F.broadcast(spark.createDataFrame([(k, [rank[x] for x in path]) for k, path in levels.items()], "node string, ranks array<int>"))
    segs = F.broadcast(spark.createDataFrame([(*k, rank[v, k[1]]) for k, v in first.items()], "loop_id string, seg_id string, seg_rank int"))
    return (kept(located).join(nodes, "node").join(segs, ["loop_id", "seg_id"]).withColumn("spec_key", F.arrays_zip(
        F.array_append("ranks", F.col("seg_rank")).alias("rank"), F.concat("path_inst", F.array("pos")).alias("no"))))


def _loop(spec: Spec, path: tuple[str, ...]):
    node = spec.root
    for xid in path[1:]:
        node = next(child for child in node.loops if child.xid == xid)
    return node


def write_spec_order(located: DataFrame, spec: Spec, line_break: str = "NONE") -> DataFrame:
    """K2 + K3: documents in the order of the spec; a line break follows each segment and each document."""
    end = F.lit(LINE_BREAKS[line_break])
    rows = spec_order_key(located, spec).withColumn("text", F.concat(segment_text(), F.col("sep.seg"), end))
    return assemble(rows, ["spec_key"], end if line_break != "NONE" else None)


# ---------------------------------------------------------------------------------------------------------
# K4, K5


def node_path_id(path_ids: Column) -> Column:
    """K5: the ids of a path in one string."""
    return F.array_join(path_ids, "__")


def label_nodes(located: DataFrame, loops: DataFrame, spec: Spec) -> DataFrame:
    """K4: every loop, segment, element and composite value with the name the spec gives it."""
    tables = spec_tables(located.sparkSession, spec)
    by_id = spec.by_id()
    order = list(by_id)
    at = (F.array_position(F.split(F.lit(" ".join(order)), " "), F.col("loop_id")) - 1).cast("int")
    loop_rows = loops.select(
        "file_id", "isa_no", F.col("start_pos").alias("pos"), node_path_id(F.col("path_ids")).alias("path_id"),
        F.lit("loop").alias("kind"), F.col("loop_id").alias("xid"), lookup([by_id[k].name for k in order], at).alias("name"),
        F.lit(None).cast("string").alias("value"))

    first = tables["seg"].groupBy("loop_id", "seg_id").agg(
        F.min("seg_no").alias("seg_no"), F.min_by("name", "seg_no").alias("seg_name"))
    segs = (kept(located).select("file_id", "isa_no", "pos", "loop_id", "node", "seg_id", "elements", "sep")
            .join(F.broadcast(first), ["loop_id", "seg_id"], "left")
            .withColumn("path_id", node_path_id(F.split("node", "/"))))
    seg_rows = segs.select("file_id", "isa_no", "pos", "path_id", F.lit("segment").alias("kind"), F.col("seg_id").alias("xid"),
                           F.col("seg_name").alias("name"), F.lit(None).cast("string").alias("value"))

    values = F.slice("elements", F.lit(2), F.greatest(F.size("elements") - 1, F.lit(0)))
    ele_spec = F.broadcast(tables["ele"].select(
        "loop_id", "seg_no", "ele_seq", F.col("name").alias("ele_name"), "is_composite"))
    eles = (segs.select("file_id", "isa_no", "pos", "path_id", "loop_id", "seg_id", "seg_no", "sep",
                        F.posexplode(values).alias("i", "value"))
            .withColumn("ele_seq", F.col("i") + 1)
            .join(ele_spec, ["loop_id", "seg_no", "ele_seq"], "left")
            .withColumn("ele_id", F.concat("seg_id", F.format_string("%02d", F.col("ele_seq"))))
            .withColumn("subs", split_trimmed(F.col("value"), F.col("sep.comp"))))
    composite = F.coalesce("is_composite", F.size("subs") > 1)
    ele_rows = eles.select("file_id", "isa_no", "pos", "path_id", F.when(composite, "composite").otherwise("element").alias("kind"),
                           F.col("ele_id").alias("xid"), F.col("ele_name").alias("name"), "value")

    sub_spec = F.broadcast(tables["sub"].select("loop_id", "seg_no", "ele_seq", "sub_seq", F.col("name").alias("sub_name")))
    subs = (eles.where(composite)
            .select("file_id", "isa_no", "pos", "path_id", "loop_id", "seg_no", "ele_seq", "ele_id",
                    F.posexplode("subs").alias("j", "sub"))
            .withColumn("sub_seq", F.col("j") + 1)
            .join(sub_spec, ["loop_id", "seg_no", "ele_seq", "sub_seq"], "left"))
    sub_rows = subs.select("file_id", "isa_no", "pos", "path_id", F.lit("compositeValue").alias("kind"),
                           F.concat("ele_id", F.format_string("-%02d", F.col("sub_seq"))).alias("xid"),
                           F.col("sub_name").alias("name"), F.col("sub").alias("value"))
    return loop_rows.unionByName(seg_rows).unionByName(ele_rows).unionByName(sub_rows)


# ---------------------------------------------------------------------------------------------------------
# K6, K7


def _elements_with_ids() -> Column:
    values = F.slice("elements", F.lit(2), F.greatest(F.size("elements") - 1, F.lit(0)))
    return F.transform(values, lambda v, i: F.struct(
        F.concat(F.col("seg_id"), F.format_string("%02d", i + 1)).alias("id"), v.alias("value")))


def _escape_xml(text: Column) -> Column:
    for char, name in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;")):
        text = F.replace(text, F.lit(char), F.lit(name))
    return text


def _closed_before(loops: DataFrame) -> DataFrame:
    """Add ``closed``: how many loops end right before this one, from the depth of the loop before it. That loop
    is looked up inside the part first, then as the last one of the part before."""
    inside = Window.partitionBy("file_id", "part").orderBy("loop_inst")
    rows = loops.withColumn("previous", F.lag("depth").over(inside))
    single, multi = rows.where(~F.col("multi")), rows.where("multi")
    last = loops.where("multi").groupBy("file_id", "part").agg(F.max_by("depth", "loop_inst").alias("last"))
    carried = exclusive_scan(last, ["file_id"], "part", "last", lambda a, b: b, F.lit(None).cast("int"), "int").withColumnRenamed("entry", "carried")
    multi = (multi.join(carried, ["file_id", "part"]).withColumn("previous", F.coalesce("previous", "carried"))
             .select(*single.columns))
    return single.unionByName(multi).withColumn(
        "closed", F.when(F.col("depth") > 1, F.col("previous") - F.col("depth") + 1).otherwise(0)).drop("previous")


def _nested(located: DataFrame, loops: DataFrame, segment: Column, between: str, head: Column, inner: str, tail: str,
            comma: str) -> DataFrame:
    """The text of a document as rows in its order: for each loop, what closes the loops that ended before it and opens
    it; its own segments, one row each; and what follows them. No row holds a loop, however many segments it has."""
    rank = lambda kind, pos: (F.lit(kind).alias("kind"), pos.cast("bigint").alias("nth"))
    keep = ["file_id", "isa_no", "multi"]
    opened = _closed_before(loops).select(
        *keep, F.col("loop_inst").alias("at"), *rank(0, F.lit(0)),
        F.concat(F.repeat(F.lit(tail), F.col("closed")), F.when(F.col("closed") > 0, comma).otherwise(""), head).alias("text"))
    # a loop's first segment is the one that opened it
    own = kept(located).select(*keep, F.col("loop_inst").alias("at"), *rank(1, F.col("pos")),
                               F.concat(F.when(F.col("role") == "start", "").otherwise(between), segment).alias("text"))
    followed = loops.select(*keep, F.col("loop_inst").alias("at"), *rank(2, F.lit(0)), F.lit(inner).alias("text"))
    ends = loops.groupBy(*keep).agg(F.max("loop_inst").alias("at"), F.max_by("depth", "loop_inst").alias("depth"))
    closing = ends.select(*keep, "at", *rank(3, F.lit(0)), F.repeat(F.lit(tail), F.col("depth")).alias("text"))
    return assemble(opened.unionByName(own).unionByName(followed).unionByName(closing), ["at", "kind", "nth"])


def nested_json(located: DataFrame, loops: DataFrame) -> DataFrame:
    """K6: each interchange as one nested object: id, segments, loops."""
    segment = F.to_json(F.struct(F.col("seg_id").alias("id"), _elements_with_ids().alias("elements")))
    head = F.concat(F.lit('{"id":"'), F.col("loop_id"), F.lit('","segments":['))
    return _nested(located, loops, segment, ",", head, '],"loops":[', "]}", ",")


def nested_xml(located: DataFrame, loops: DataFrame) -> DataFrame:
    """K7: the same as XML, with ids as attributes and element values as text."""
    elements = F.array_join(F.transform(_elements_with_ids(), lambda e: F.concat(
        F.lit('<element id="'), e["id"], F.lit('">'), _escape_xml(e["value"]), F.lit("</element>"))), "")
    segment = F.concat(F.lit('<segment id="'), _escape_xml(F.col("seg_id")), F.lit('"><elements>'), elements,
                       F.lit("</elements></segment>"))
    head = F.concat(F.lit('<loop id="'), F.col("loop_id"), F.lit('"><segments>'))
    return _nested(located, loops, segment, "", head, "</segments><loops>", "</loops></loop>", "")
