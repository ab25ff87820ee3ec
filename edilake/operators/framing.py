"""Framing: from raw text to segments, elements and sub-values.

``raw`` has one row per *part* of a file: ``file_id, path, part, multi, head, content``. Almost every file is one
part. A file too long for one task comes as several parts cut between segments; ``part`` orders them, ``multi``
marks them, and ``head`` repeats the first two segments so that each part can be framed alone.

All steps are projections. A file is split, framed and cut into segments inside the row that holds its text,
without a shuffle, and only ``explode`` turns a part into rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.arrays import explode_items
from ..specs.catalog import ROUTE_DDL, VERSIONS, route_rows

# Length of an ISA segment with its terminator, and the 1-based places of the delimiters in it.
ISA_LENGTH, ELEMENT_AT, COMPOSITE_AT, SEGMENT_AT = 106, 4, 105, 106

# Letters, digits and whitespace cannot be delimiters.
NOT_A_DELIMITER = r"[\p{L}\p{Nd}\s\x1c-\x1f]"

# The first four segments of a document are within its first characters.
HEAD_CHARS = 4096

BLANKS = " \t\r\n"
BLANK_RUN = r"[\x00-\x20]*+"

# A part longer than this many segments is cut further; about half a megabyte of text.
SLICE_SEGMENTS = 16384

OK, UNREADABLE, WRONG_VERSION = "ok", "unreadable", "wrong_version"


def raw_part(major: Column | None = None, minor: Column | None = None) -> Column:
    zero = F.lit(0).cast("bigint")
    return F.struct((zero if major is None else major.cast("bigint")).alias("major"),
                    (zero if minor is None else minor.cast("bigint")).alias("minor"),
                    F.lit(0).alias("slice"))


def good_delimiters(text: str) -> bool:
    """Whether a text of an ISA's length has characters that can be delimiters in their places."""
    return not any(c.isalpha() or c.isdecimal() or c.isspace() for c in (text[ELEMENT_AT - 1], text[COMPOSITE_AT - 1], text[SEGMENT_AT - 1]))


def as_raw(documents: DataFrame, file_id: str = "file_id", content: str = "content") -> DataFrame:
    """Give a table of whole documents (one row each, well under the 2 GB row limit) the ``raw`` schema."""
    return documents.select(
        F.col(file_id).alias("file_id"),
        (F.col("path") if "path" in documents.columns else F.col(file_id)).alias("path"),
        raw_part().alias("part"),
        # a segment has at least two characters, so a shorter text cannot need more than one slice
        (F.length(content) > 2 * SLICE_SEGMENTS).alias("multi"),
        F.lit(None).cast("string").alias("head"),
        F.col(content).alias("content"),
    )


def escaped(separator: Column) -> Column:
    """A delimiter as a regular expression. A delimiter is never a letter or digit, so a backslash is enough,
    and Java splits on such a pattern without compiling it."""
    return F.concat(F.lit("\\"), separator)


def split_trimmed(text: Column, separator: Column) -> Column:
    """Split so that trailing blanks vanish and inner ones stay. Trimming by a given character is slow, so only
    texts that end with the separator go through it."""
    text = F.when(F.endswith(text, separator), F.rtrim(text, separator)).otherwise(text)
    return F.split(text, escaped(separator))


# ---------------------------------------------------------------------------------------------------------
# F1, F2, F7, S4


def detect_separators(raw: DataFrame) -> DataFrame:
    """add ``sep`` (null if the delimiters cannot be found)."""
    text = F.coalesce("head", "content")
    ele, comp, seg = (F.substring(text, at, 1) for at in (ELEMENT_AT, COMPOSITE_AT, SEGMENT_AT))
    good = (F.length(text) >= ISA_LENGTH) & ~F.concat(ele, comp, seg).rlike(NOT_A_DELIMITER)
    return raw.withColumn(
        "sep",
        F.when(good, F.struct(seg.alias("seg"), ele.alias("ele"), comp.alias("comp"), F.lit("").alias("line_break"))),
    )


def read_version(separated: DataFrame) -> DataFrame:
    """Add ``icvn`` (ISA12), ``fic`` (GS01) and ``version``: the text after the last element separator of the
    second segment. Without a terminator or separator there, the version is null."""
    text = F.coalesce("head", "content")
    seg, ele = F.col("sep.seg"), F.col("sep.ele")
    rest = F.substr(text, F.lit(ISA_LENGTH + 1))
    second = F.when(F.contains(rest, seg),
                    F.expr(f"substring_index(substr(coalesce(head, content), {ISA_LENGTH + 1}), sep.seg, 1)"))
    with_second = separated.withColumn("_second", second)
    return with_second.select(
        *separated.columns,
        F.get(F.split(F.substring(text, 1, ISA_LENGTH - 1), escaped(ele)), F.lit(12)).alias("icvn"),
        F.get(F.split(F.btrim("_second", F.lit(BLANKS)), escaped(ele)), F.lit(1)).alias("fic"),
        F.when(F.contains("_second", ele), F.expr("substring_index(_second, sep.ele, -1)")).alias("version"),
    )


def routes(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(route_rows(), ROUTE_DDL)


def route_spec(versioned: DataFrame) -> DataFrame:
    """The spec a document asks for, by interchange version, functional id and version, and for some versions by the
    purpose that the fourth segment (BHT02) states; a document without it, or a later part of a long one, has no such
    route."""
    table = F.broadcast(routes(versioned.sparkSession))
    # the first four segments are within the first characters
    fourth = F.get(F.split(F.substring("content", 1, HEAD_CHARS), escaped(F.col("sep.seg"))), F.lit(3))
    named = F.split(F.btrim(fourth, F.lit(BLANKS)), escaped(F.col("sep.ele")))
    stated = versioned.withColumn("_purpose", F.when(F.get(named, F.lit(0)) == "BHT", F.get(named, F.lit(2))))
    same = [stated[c] == table[c] for c in ("icvn", "fic", "version")]
    fits = table["purpose"].isNull() | (table["purpose"] == stated["_purpose"])
    joined = stated.join(table, [*same, fits], "left")
    return joined.select(*[stated[c] for c in versioned.columns], table["route"], table["spec_id"])


def check_version(versioned: DataFrame, file_type: str) -> DataFrame:
    """the caller names the type; another version is an error. Adds ``status`` and ``spec_id``."""
    good = F.col("version") == VERSIONS[file_type]
    status = (F.when(F.col("sep").isNull(), UNREADABLE).when(good, OK).otherwise(WRONG_VERSION))
    return versioned.withColumns({"status": status, "spec_id": F.when(good, file_type)})


def check_route(routed: DataFrame) -> DataFrame:
    """Like F2, for landing zones that mix types: a document is fine if any spec covers it."""
    status = (F.when(F.col("sep").isNull(), UNREADABLE).when(F.col("spec_id").isNotNull(), OK).otherwise(WRONG_VERSION))
    return routed.withColumn("status", status)


def frame(raw: DataFrame, file_type: str | None = None) -> DataFrame:
    """F1 + F2 (or S4 when no type is named)."""
    versioned = read_version(detect_separators(raw))
    if file_type:
        return check_version(versioned, file_type)
    return check_route(route_spec(versioned)).drop("route")


def first_parts(framed: DataFrame) -> DataFrame:
    """One row per file: its first part."""
    single = framed.where(~F.col("multi"))
    rest = [c for c in framed.columns if c not in ("file_id", "part")]
    multi = (framed.where("multi").drop("content").groupBy("file_id")
             .agg(F.min_by(F.struct("part", *[c for c in rest if c != "content"]), "part").alias("f"))
             .select("file_id", "f.*"))
    return single.drop("content").unionByName(multi)


def quarantine(framed: DataFrame, file_type: str | None = None) -> DataFrame:
    """rows of ``errors`` for the files that cannot be read, one plain and one fatal each."""
    bad = first_parts(framed).where(F.col("status") != OK)
    plain = F.when(F.col("status") == UNREADABLE, F.lit("Error getting separators")).otherwise(
        F.concat(F.lit("ANSI version "), F.coalesce("version", F.lit("null")),
                 F.lit(" not consistent with version specified "), F.lit(file_type or "in the routes")))
    code = F.when(F.col("status") == UNREADABLE, F.lit("F1")).otherwise(F.lit("F2"))
    rows = F.array(
        F.struct(F.lit("error").alias("severity"), code.alias("code"), plain.alias("message")),
        F.struct(F.lit("fatal").alias("severity"), F.lit("F7").alias("code"),
                 F.lit("Unable to process transaction!").alias("message")),
    )
    return bad.select("file_id", F.inline(rows))


# ---------------------------------------------------------------------------------------------------------
# F3-F6


def cut_segments(framed: DataFrame) -> DataFrame:
    """the readable parts with ``segs``, the array of their trimmed segments; long parts become slices."""
    # blanks and line breaks around a terminator go with it, which trims every segment but the outer ends
    pieces = F.split(F.btrim("content", F.lit(BLANKS)),
                     F.concat(F.lit(BLANK_RUN), escaped(F.col("sep.seg")), F.lit(BLANK_RUN)))
    segs = F.filter(pieces, lambda s: s != "")
    cut = framed.where(F.col("status") == OK).select("file_id", "spec_id", "part", "multi", "sep", segs.alias("segs"))
    whole = cut.where(~F.col("multi"))
    starts = F.when(F.size("segs") > SLICE_SEGMENTS, F.sequence(F.lit(1), F.size("segs"), F.lit(SLICE_SEGMENTS))
                    ).otherwise(F.array(F.lit(1)))
    slices = cut.where("multi").select("*", F.posexplode_outer(starts).alias("_no", "_start")).select(
        "file_id", "spec_id",
        F.struct(F.col("part.major").alias("major"), F.col("part.minor").alias("minor"), F.col("_no").alias("slice")).alias("part"),
        "multi", "sep", F.slice("segs", F.col("_start"), F.lit(SLICE_SEGMENTS)).alias("segs"))
    return whole.unionByName(slices)


def cut_elements(cut: DataFrame) -> DataFrame:
    """F4 inside the array: ``segs`` becomes ``elems``, one element array per segment."""
    return cut.withColumn("elems", F.transform("segs", lambda s: split_trimmed(s, F.col("sep.ele")))).drop("segs")


def split_segments(framed: DataFrame) -> DataFrame:
    """F3 as rows: one row per segment with its place inside its part."""
    return explode_items(cut_segments(framed), ["file_id", "spec_id", "part", "multi", "sep"], "segs", "part_pos", "raw")


def split_elements(segments: DataFrame) -> DataFrame:
    """F4 as a column: ``elements`` (the first is the segment id) and ``seg_id``."""
    elements = split_trimmed(F.col("raw"), F.col("sep.ele"))
    return segments.withColumn("elements", elements).withColumn("seg_id", F.get("elements", F.lit(0)))


def name_elements(segments: DataFrame) -> DataFrame:
    """one row per element, named by segment id and two-digit sequence."""
    keep = [c for c in segments.columns if c != "elements"]
    values = F.slice("elements", F.lit(2), F.greatest(F.size("elements") - 1, F.lit(0)))
    return (explode_items(segments, keep, values, "_i", "value")
            .withColumn("ele_seq", F.col("_i") + 1)
            .withColumn("ele_id", F.concat("seg_id", F.format_string("%02d", F.col("ele_seq"))))
            .drop("_i"))


def split_composites(elements: DataFrame) -> DataFrame:
    """``sub_values`` of each element. An empty element has one empty sub-value; one of delimiters only, like
    ISA16, has none."""
    only_delimiters = (F.col("value") != "") & (F.rtrim("value", F.col("sep.comp")) == "")
    return elements.withColumn(
        "sub_values",
        F.when(only_delimiters, F.array().cast("array<string>"))
        .otherwise(split_trimmed(F.col("value"), F.col("sep.comp"))))


def sub_value(sub_values: Column | str, index: int) -> Column:
    """The sub-value at a 0-based index, or null."""
    return F.get(F.col(sub_values) if isinstance(sub_values, str) else sub_values, F.lit(index))
