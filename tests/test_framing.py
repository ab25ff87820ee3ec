import samples
from pyspark.sql import functions as F

from edilake.operators import framing, loops
from edilake.sources.files import decode


def test_separators_of_three_kinds_give_the_same_elements(spark):
    doc = samples.document(samples.claim(1))
    docs = {"a": samples.text(doc), "b": samples.text(doc, "_", "~", "^"), "c": samples.text(doc, "|", "^", ">")}
    framed = framing.frame(samples.raw(spark, docs), samples.SPEC.spec_id)
    seps = {r.file_id: tuple(r.sep)[:3] for r in framed.collect()}
    assert seps == {"a": ("~", "*", ":"), "b": ("_", "~", "^"), "c": ("|", "^", ">")}
    segments = framing.split_elements(framing.split_segments(framed)).where("seg_id <> 'ISA'")
    plain = segments.select("file_id", "part_pos", F.transform("elements", lambda e: F.replace(e, F.col("sep.comp"), F.lit(":"))).alias("e"))
    by_file = {}
    for r in plain.orderBy("file_id", "part_pos").collect():
        by_file.setdefault(r.file_id, []).append((r.part_pos, r.e))
    assert by_file["a"] == by_file["b"] == by_file["c"]


def test_line_breaks_and_blanks_around_segments_do_not_matter(spark):
    doc = samples.document(samples.claim(1))
    docs = {"none": samples.text(doc), "lf": samples.text(doc, line_break="\n"), "crlf": samples.text(doc, line_break="\r\n"),
            "blank": samples.text(doc).replace("~", "~ \n") + "\n\n  \n"}
    segments = framing.split_segments(framing.frame(samples.raw(spark, docs), samples.SPEC.spec_id))
    got = {r.file_id: r.segs for r in segments.groupBy("file_id").agg(
        F.sort_array(F.collect_list(F.struct("part_pos", "raw"))).alias("segs")).collect()}
    assert len(got["none"]) == len(doc)
    assert got["none"] == got["lf"] == got["crlf"] == got["blank"]


def test_unreadable_files_and_wrong_versions(spark):
    doc = samples.document(samples.claim(1))
    good = samples.text(doc)
    docs = {"good": good, "short": "ISA*00~", "shifted": good[:10] + good[11:], "letters": "A" * 200,
            "version": samples.text([samples.isa(), samples.gs("005010X223A2"), *doc[2:]]),
            "cut": good[:150], "group": "\x1d".join(["x" * 3, "y" * 101]) + "\x1d:~" + good[106:]}
    framed = framing.frame(samples.raw(spark, docs), samples.SPEC.spec_id)
    status = {r.file_id: r.status for r in framed.collect()}
    assert status == {"good": "ok", "short": "unreadable", "shifted": "unreadable", "letters": "unreadable",
                      "version": "wrong_version", "cut": "wrong_version", "group": "unreadable"}
    messages = {(r.file_id, r.message) for r in framing.quarantine(framed, samples.SPEC.spec_id).collect()}
    assert ("version", "ANSI version 005010X223A2 not consistent with version specified ANSI837_5010_X222") in messages
    assert ("cut", "ANSI version null not consistent with version specified ANSI837_5010_X222") in messages
    assert ("short", "Error getting separators") in messages
    assert sum(m == "Unable to process transaction!" for _, m in messages) == 6


def test_routing_by_version_and_functional_id(spark):
    docs = {"837": [samples.isa(), samples.gs()], "270": [samples.isa(version="00401"), samples.gs("004010X092A1", "HS")],
            "271": [samples.isa(version="00401"), samples.gs("004010X092A1", "HB")], "none": [samples.isa(), samples.gs("1", "ZZ")]}
    routed = framing.frame(samples.raw(spark, docs))
    assert {r.file_id: (r.spec_id, r.status) for r in routed.collect()} == {
        "837": ("ANSI837_5010_X222", "ok"), "270": ("ANSI270_4010_X092", "ok"), "271": ("ANSI271_4010_X092", "ok"),
        "none": (None, "wrong_version")}


def test_trailing_blanks_vanish_and_inner_ones_stay(spark):
    docs = {"a": [samples.isa(), samples.gs(), "EQ*30***", "ZZ**A**B", "***", "C*:*A:*:B*A:B:C"]}
    framed = framing.frame(samples.raw(spark, docs), samples.SPEC.spec_id)
    segments = framing.split_elements(framing.split_segments(framed)).where("part_pos >= 2")
    assert [r.elements for r in segments.orderBy("part_pos").collect()] == [
        ["EQ", "30"], ["ZZ", "", "A", "", "B"], [""], ["C", ":", "A:", ":B", "A:B:C"]]
    named = framing.split_composites(framing.name_elements(segments.where("seg_id = 'C'")))
    assert [(r.ele_id, r.sub_values) for r in named.orderBy("ele_seq").collect()] == [
        ("C01", []), ("C02", ["A"]), ("C03", ["", "B"]), ("C04", ["A", "B", "C"])]
    assert named.where("ele_seq = 4").select(framing.sub_value("sub_values", 2), framing.sub_value("sub_values", 3)).first()[:] == ("C", None)


def test_malformed_bytes_are_replaced_or_read_as_latin1(spark):
    df = spark.createDataFrame([(bytearray(b"CAF\xc9*\xc3\xa9"),)], "content binary")
    assert df.select(decode(F.col("content"))).first()[0] == "CAF�*é"
    assert df.select(decode(F.col("content"), "ISO-8859-1")).first()[0] == "CAFÉ*Ã©"


def test_no_array_of_a_text_is_made_again_to_be_filtered(spark):
    # such a filter finds the delimiters of the whole text anew for every segment: time by the square of a document
    framed = framing.frame(samples.raw(spark, {"a": samples.document(samples.claim(1))}), samples.SPEC.spec_id)
    parts, spec = framing.cut_elements(framing.cut_segments(framed)), samples.SPEC
    for rows in (framing.split_segments(framed), framing.name_elements(framing.split_elements(framing.split_segments(framed))),
                 loops.number_envelopes(parts, False), loops.assign_loops(parts, spec, False), loops.assign_loops(parts, spec)):
        plan = rows._jdf.queryExecution().optimizedPlan().toString()
        assert not [line for line in plan.splitlines() if "Filter" in line and "size(" in line]
