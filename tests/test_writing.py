import json
from xml.etree import ElementTree

import pytest
import samples
from pyspark.sql import functions as F

from edilake.operators import edits, framing, loops, lookup, writing
from edilake.operators.lookup import Address
from edilake.plans import claims, lake
from edilake.plans.spec_xml import to_xml
from edilake.specs.catalog import professional_claim
from edilake.sources import files
from edilake.specs.catalog import all_specs
from edilake.specs.model import parse_spec_xml
from edilake.streaming import landing

DOC = samples.document(samples.claim(1, 2, ["NM1*82*1*DOC"]), samples.claim(2), ["HL*3*2*23*0", "PAT*19", "NM1*QC*1*KID"], samples.claim(3))


def texts(df):
    return {r.file_id: r.text for r in df.collect()}


def test_spec_order_gives_the_input_back(spark):
    docs = {"a": samples.text(DOC), "b": samples.text(DOC, "|", "^", ">")}
    located = samples.locate(spark, docs).cache()
    assert texts(writing.write_spec_order(located, samples.SPEC)) == docs
    crlf = texts(writing.write_spec_order(located, samples.SPEC, "CRLF"))
    assert crlf["a"] == samples.text(DOC, line_break="\r\n") + "\r\n"


def test_spec_order_puts_children_in_place(spark):
    shuffled = samples.document(samples.claim(1, 0, ["REF*G1*1"]), provider=[
        "HL*1**20*1", "NM1*87*2*PAYTO", "N4*TOWN", "N3*2 ROAD", "NM1*85*2*CLINIC", "REF*EI*12", "N4*TOWN", "N3*1 ROAD"])
    out = texts(writing.write_spec_order(samples.locate(spark, {"a": shuffled}), samples.SPEC))["a"].split("~")
    at = out.index("NM1*85*2*CLINIC")
    assert out[at:at + 7] == ["NM1*85*2*CLINIC", "N3*1 ROAD", "N4*TOWN", "REF*EI*12", "NM1*87*2*PAYTO", "N3*2 ROAD", "N4*TOWN"]
    at = out.index("REF*G1*1")
    assert out[at + 1].startswith("HI")


def test_source_order_prints_segments_of_a_loop_before_its_loops(spark):
    out = texts(writing.write_source_order(samples.locate(spark, {"a": DOC})))["a"].split("~")
    assert [s.split("*")[0] for s in out[:7]] == ["ISA", "IEA", "GS", "GE", "ST", "SE", "BHT"]


def nested(df, loop_rows):
    return json.loads(texts(writing.nested_json(df, loop_rows))["a"]), ElementTree.fromstring(
        texts(writing.nested_xml(df, loop_rows))["a"])


def names(obj):
    return [obj["id"], [s["id"] for s in obj["segments"]], [names(child) for child in obj["loops"]]]


def xml_names(node):
    return [node.get("id"), [s.get("id") for s in node.find("segments")], [xml_names(c) for c in node.find("loops")]]


def test_nested_json_and_xml(spark):
    doc = [s.replace("ACME*****46", 'A "B" <C> & \\D*****46') for s in DOC]
    located = samples.locate(spark, {"a": doc}).cache()
    obj, tree = nested(located, loops.link_parents(located))
    assert names(obj) == xml_names(tree)
    assert obj["segments"][1] == {"id": "IEA", "elements": [{"id": "IEA01", "value": "1"}, {"id": "IEA02", "value": "000000001"}]}
    subscriber = obj["loops"][0]["loops"][0]["loops"][1]["loops"][0]["loops"][1]
    assert [child["id"] for child in subscriber["loops"]] == ["2010BA", "2010BB", "2300", "2300", "2000C"]
    submitter = obj["loops"][0]["loops"][0]["loops"][0]["loops"][0]
    assert submitter["segments"][0]["elements"][2]["value"] == 'A "B" <C> & \\D'
    assert [e.text for e in tree.iter("element") if e.get("id") == "NM103"][0] == 'A "B" <C> & \\D'


def test_long_documents_leave_in_ordered_pieces(spark, monkeypatch, tmp_path):
    want = samples.text(DOC)
    whole = samples.locate(spark, {"a": DOC})
    want_json = texts(writing.nested_json(whole, loops.link_parents(whole)))["a"]
    monkeypatch.setattr(framing, "SLICE_SEGMENTS", 6)
    monkeypatch.setattr(writing, "ROWS_PER_PIECE", 5)
    located = samples.locate(spark, {"a": DOC}, long_documents=True).cache()
    pieces = writing.write_spec_order(located, samples.SPEC)
    rows = pieces.orderBy("piece").collect()
    assert len(rows) > 3 and "".join(r.text for r in rows) == want
    parts = writing.nested_json(located, loops.link_parents(located)).orderBy("piece").collect()
    assert "".join(r.text for r in parts) == want_json
    files.write_edi(pieces, str(tmp_path / "out"))
    lines = [line for f in sorted((tmp_path / "out/long/file_id=a").glob("*.txt")) for line in f.read_text().split("\n") if line]
    assert "".join(lines) == want


def test_labels(spark):
    located = samples.locate(spark, {"a": DOC}).cache()
    rows = writing.label_nodes(located, loops.link_parents(located), samples.SPEC).collect()
    kinds = {}
    for r in rows:
        kinds[r.kind] = kinds.get(r.kind, 0) + 1
    assert kinds["segment"] == len(DOC)
    assert kinds["element"] + kinds["composite"] == sum(len(s.rstrip("*").split("*")) - 1 for s in DOC)
    # four lines, three claims and three diagnoses carry composites
    assert kinds["composite"] == 10
    named = {(r.kind, r.xid): r.name for r in rows}
    assert named["compositeValue", "SV101-02"] == "Procedure Code"
    assert {r.path_id for r in rows if r.xid == "PAT"} == {"ISA_LOOP__GS_LOOP__ST_LOOP__DETAIL__2000A__2000B__2000C"}


def test_edits(spark):
    located = samples.locate(spark, {"a": DOC}).cache()
    clm = F.col("seg_id") == "CLM"
    first = lambda df, seg="CLM": df.where(F.col("seg_id") == seg).orderBy("pos").first().elements
    assert first(edits.set_element(located, clm, 2, F.lit("9")))[:3] == ["CLM", "1", "9"]
    assert first(edits.set_element(located, clm, 40, F.lit("9"))) == first(located)
    assert first(edits.set_composite(located, clm, 5, [F.lit("2"), F.lit("C")]))[5] == "2:C"
    assert first(edits.append_element(located, clm, F.lit("Z")))[-1] == "Z"
    assert first(edits.insert_element(located, clm, 1, F.lit("Z")))[:3] == ["CLM", "Z", "1"]
    assert first(edits.remove_element(located, clm, 1))[:2] == ["CLM", "10.00"]
    refused = edits.reseparate(located, "!", "D", ";").where("refused")
    assert [r.seg_id for r in refused.orderBy("pos").collect()] == [s.split("*")[0] for s in DOC]
    fresh = edits.reseparate(located, "!", "/", ";").where("not refused")
    out = texts(writing.write_spec_order(fresh.drop("refused"), samples.SPEC))["a"]
    assert out == samples.text(DOC, "!", "/", ";")
    old = located.where(clm & (F.get("elements", F.lit(1)) == "2"))
    left = edits.remove_loops(located, "2300", old)
    assert located.count() - left.count() == 5
    renumbered = edits.renumber(left).orderBy("pos").collect()
    assert [r.pos for r in renumbered] == list(range(len(renumbered)))
    note = old.withColumns({"pos": F.col("pos") + F.lit(0.5), "seg_id": F.lit("NTE"), "elements": F.array(F.lit("NTE"), F.lit("A"))})
    order = [r.seg_id for r in edits.renumber(edits.insert_segments(located, note)).orderBy("pos").collect()]
    assert order[order.index("NTE") - 1] == "CLM"


NEW_LOOPS = [  # parent, node, opens, segment
    ("2000B", "2300", True, "CLM*9*10.00***11:B:1*Y*A*Y*Y"), ("2000B", "2300", False, "HI*BK:1"), ("2000B", "2300/2400", True, "LX*1"),
    ("2000B", "2300/2400", False, "SV1*HC:1*5.00*UN*1"), ("2000B", "2300/2400", False, "DTP*472*D8*20240101"),
    ("2000B", "2300/2400", True, "LX*2"), ("2000B", "2300/2400", False, "SV1*HC:2*5.00*UN*1"),
    ("2000B", "2300", True, "CLM*10*10.00***11:B:1*Y*A*Y*Y"), ("2000B", "2300", False, "HI*BK:1")]


def inserted(spark, places, rows):
    return spark.createDataFrame(
        [(f, at, parent, i, node, opens, text.split("*")) for f, at in places for i, (parent, node, opens, text) in enumerate(rows)],
        "file_id string, after long, parent string, seq int, node string, opens boolean, elements array<string>")


def test_inserted_loops_are_numbered_as_if_they_had_been_read(spark, monkeypatch):
    docs = {"a": samples.text(DOC), "b": samples.text(samples.document(samples.claim(1)), "|", "^", ">")}
    monkeypatch.setattr(framing, "SLICE_SEGMENTS", 7)
    located = samples.locate(spark, docs, long_documents=True).cache()
    first = {f: [i for i, x in enumerate(docs[f].split(seg)) if x.startswith("DTP")][line] for f, seg, line in (("a", "~", 1), ("b", "|", 0))}
    new = inserted(spark, first.items(), NEW_LOOPS).withColumn("elements", F.when(F.col("file_id") == "b", F.transform(
        "elements", lambda e: F.replace(e, F.lit(":"), F.lit(">")))).otherwise(F.col("elements")))
    out = edits.insert_loops(located, new).cache()
    want = {}
    for (f, t), (seg, ele, comp) in zip(docs.items(), ("~*:", "|^>")):
        at, parts = first[f] + 1, t.split(seg)
        want[f] = seg.join([*parts[:at], *[x.replace("*", ele).replace(":", comp) for *_, x in NEW_LOOPS], *parts[at:]])
    columns = ["file_id", "pos", "seg_id", "elements", "loop_id", "node", "role", "path_inst", "loop_inst", "wrapped", "fault",
               "isa_no", "gs_no", "st_no", "sep"]
    assert samples.rows(out, *columns) == samples.rows(samples.locate(spark, want, long_documents=True), *columns)
    pieces = writing.write_spec_order(out, samples.SPEC).orderBy("file_id", "piece").collect()
    assert {f: "".join(r.text for r in pieces if r.file_id == f) for f in want} == want
    gone = loops.link_parents(out).where("loop_id = '2300'").join(
        out.where("seg_id = 'CLM' and elements[1] in ('9', '10')").select("file_id", "loop_inst"), ["file_id", "loop_inst"])
    assert samples.rows(edits.renumber(edits.remove_loops(out, "2300", gone)), *columns) == samples.rows(located, *columns)


def test_loops_without_a_place_fail(spark):
    located = samples.locate(spark, {"a": DOC}).cache()
    at = DOC.index("HI*BK:1")
    for places, rows in (([("a", 9999)], NEW_LOOPS), ([("z", at)], NEW_LOOPS), ([("a", 1)], NEW_LOOPS), ([("a", at)], NEW_LOOPS[1:]),
                         ([("a", at)], [*NEW_LOOPS, NEW_LOOPS[3]])):
        with pytest.raises(Exception, match="no such place or parent|segment before its loop opens"):
            edits.insert_loops(located, inserted(spark, places, rows)).collect()
    none = inserted(spark, [("a", at)], NEW_LOOPS).where("false")
    assert samples.rows(edits.insert_loops(located, none), *located.columns) == samples.rows(located, *located.columns)


def test_lookups(spark):
    located = samples.locate(spark, {"a": DOC}).cache()
    loop_rows = loops.link_parents(located).cache()
    assert [r.loop_id for r in lookup.find_loops(loop_rows, "2300").orderBy("loop_inst").collect()] == ["2300"] * 3
    assert lookup.find_loops(loop_rows, "ISA_LOOP").isEmpty()
    assert lookup.find_loops(loop_rows, "ISA_LOOP", include_self=True).count() == 1
    assert lookup.find_loops(loop_rows, "2300", within="2000C").count() == 1
    assert lookup.nth_loop(loop_rows, "2300", 3).isEmpty()
    assert lookup.has_loop(loop_rows, "2310B", within="2300").count() == 1
    assert lookup.find_segments(located, "2000B", "CLM").isEmpty()
    values = {r.address: r.value for r in lookup.get_elements(located, loop_rows, [
        Address("third", "2300", "CLM", 1, loop_no=2), Address("code", "2400", "SV1", 1, loop_no=1, sub=1),
        Address("none", "2300", "CLM", 1, loop_no=9), Address("past", "2300", "CLM", 30), Address("sub", "2400", "SV1", 1, sub=7)]).collect()}
    assert values == {"third": "3", "code": "2", "past": None, "sub": None}
    sizes = {r.loop_inst: r.n_segments for r in lookup.subtree_size(located).collect()}
    one = {r.loop_inst: r.n_segments for r in lookup.subtree_size(located, "2300").collect()}
    assert sizes[0] == len(DOC) and sorted(one.values()) == [5, 5, 9] and all(sizes[k] == v for k, v in one.items())
    patient = lookup.ancestor(loop_rows.where("loop_id = '2300'"), "2000C").orderBy("loop_inst").collect()
    assert [r.ancestor_inst is None for r in patient] == [True, True, False]
    assert lookup.ancestor(loop_rows.where("loop_id = '2000C'"), "2000C").first().ancestor_inst is None
    counts = {r.loop_inst: (r.n_loops, r.n_segments) for r in lookup.count_children(located, loop_rows).collect()}
    assert counts[0] == (1, 2)
    wrapper = loop_rows.where("loop_id = 'DETAIL'").first().loop_inst
    assert counts[wrapper] == (1, 0)
    assert lookup.same_document(located, located).isEmpty()
    other = samples.locate(spark, {"a": samples.document(samples.claim(1), samples.claim(1), samples.claim(2))})
    kept = lookup.dedup_documents(lookup.fingerprint_documents(other, within="2300"))
    assert sorted(r.copies for r in kept.collect()) == [1, 2]


def test_spec_survives_xml():
    for spec in all_specs().values():
        assert parse_spec_xml(to_xml(spec), spec.spec_id, spec.version) == spec
    attributes = '''<transaction xid="T"><loop xid="A" usage="R" pos="1" repeat="1" name="Root"><segment xid="S" usage="R" pos="1"
      max_use="1" name="Seg"><element xid="S01" usage="R" seq="01" name="E"><valid_codes><code>X</code></valid_codes></element>
      </segment></loop></transaction>'''
    root = parse_spec_xml(attributes, "T", "1").root
    assert (root.name, root.segments[0].elements[0].codes) == ("Root", ("X",))


def test_no_row_holds_a_file_of_many_documents_whole(spark, tmp_path):
    text = samples.text(DOC, line_break="\n")
    n = (5 << 20) // len(text)
    (tmp_path / "0.txt").write_text(text * n)
    raw = files.read_edi(spark, str(tmp_path))
    assert raw.agg(F.max(F.length("content"))).first()[0] <= 4 << 20
    rows = framing.split_segments(framing.frame(raw, samples.SPEC.spec_id)).groupBy("file_id").agg(
        F.count("*"), F.count(F.when(F.col("raw").startswith("ISA"), 1))).collect()
    assert [tuple(r)[1:] for r in rows] == [(n * len(DOC), n)]


def test_files_and_stream(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    for i in range(3):
        (folder / f"{i}.txt").write_text(samples.text(DOC, line_break="\n") * (i + 1))
    raw = files.read_edi(spark, str(folder))
    framed = framing.frame(raw, samples.SPEC.spec_id)
    located = loops.assign_loops(framing.cut_elements(framing.cut_segments(framed)), samples.SPEC, False)
    want = sorted((r.file_id[-5:], r.isa_no, r.loop_id, r.role, r.pos) for r in located.collect())
    assert len(want) == 6 * len(DOC)

    by_block = framing.frame(files.read_edi(spark, str(folder), whole_bytes=0), samples.SPEC.spec_id)
    long = loops.assign_loops(framing.cut_elements(framing.cut_segments(by_block)), samples.SPEC)
    assert sorted((r.file_id[-5:], r.isa_no, r.loop_id, r.role, r.pos) for r in long.collect()) == want

    stream = landing.read_edi_stream(spark, str(folder), files_per_batch=2)
    assert stream.isStreaming
    landing.parse_stream(stream, samples.SPEC, str(tmp_path / "table"), str(tmp_path / "state")).awaitTermination()
    (folder / "3.txt").write_text(samples.text(DOC))
    landing.parse_stream(landing.read_edi_stream(spark, str(folder)), samples.SPEC, str(tmp_path / "table"),
                         str(tmp_path / "state")).awaitTermination()
    streamed = spark.read.parquet(str(tmp_path / "table"))
    assert streamed.count() == 7 * len(DOC) and streamed.select("batch").distinct().count() == 3

    (folder / "bad.txt").write_text("nothing to read")
    landing.parse_stream(landing.read_edi_stream(spark, str(folder)), samples.SPEC, str(tmp_path / "table"), str(tmp_path / "state"),
                         errors=str(tmp_path / "errors"), trigger={"availableNow": True}).awaitTermination()
    bad = spark.read.parquet(str(tmp_path / "errors")).collect()
    assert {(r.file_id[-7:], r.severity, r.code) for r in bad} == {("bad.txt", "error", "F1"), ("bad.txt", "fatal", "F7")}


def test_flatten_keeps_loops_without_the_values(spark):
    columns = "file_id string, loop_id string, node string, seg_id string, elements array<string>, pos long, loop_inst long, path_inst array<long>, role string, sep struct<comp:string>, fault int"
    claim = "ISA_LOOP/GS_LOOP/ST_LOOP/DETAIL/2000A/2000B/2300"
    open_ = [10, 11, 12, 13, 14, 15]
    rows = [("f", "2300", claim, "CLM", ["CLM", "c1"], 1, 2, [*open_, 2], "start", (":",), 0),
            ("f", "2400", claim + "/2400", "LX", ["LX", "1"], 2, 4, [*open_, 2, 4], "start", (":",), 0),
            ("f", "2400", claim + "/2400", "SV1", ["SV1", "x", "5"], 3, 4, [*open_, 2, 4], "body", (":",), 0),
            ("f", "2400", claim + "/2400", "LX", ["LX", "2"], 4, 8, [*open_, 2, 8], "start", (":",), 0)]
    got = lookup.flatten(spark.createDataFrame(rows, columns), [
        lookup.Field("diagnosis", "2300", "HI", 1), lookup.Field("charge", "2400", "SV1", 2)], professional_claim()).collect()
    assert sorted((r["charge"] or "", r["diagnosis"]) for r in got) == [("", None), ("5", None)]


def test_files_of_any_length_and_delimiter(spark, tmp_path, monkeypatch):
    """Byte ranges that start anywhere, every file with its own delimiters, names with blanks and signs, a folder that is
    a document, an unreadable file, and a charset."""
    long_ = samples.document(*[samples.claim(i, 3) for i in range(1, 40)])
    folder = tmp_path / "in"
    (folder / "deep er" / "file_id=big=1").mkdir(parents=True)
    texts_ = {"a b+c%20.txt": samples.text(long_), "deep er/x.txt": samples.text(long_, "|", "^", ">", line_break="\r\n"),
              "two.txt": samples.text(DOC, "!", "*", ":") * 2}
    for name, text in texts_.items():
        (folder / name).write_text(text)
    whole = samples.text(long_)
    for i, cut in enumerate(range(0, len(whole), 1000)):
        end = whole.rfind("~", 0, min(cut + 1000, len(whole))) + 1
        start = whole.rfind("~", 0, cut) + 1 if cut else 0
        (folder / "deep er" / "file_id=big=1" / f"part-{i:05d}.txt").write_text(whole[start:end] + "\n")
    (folder / "bad.txt").write_text("nothing here")

    def segments(raw):
        framed = framing.frame(raw, samples.SPEC.spec_id)
        rows = loops.assign_loops(framing.cut_elements(framing.cut_segments(framed)), samples.SPEC).collect()
        bad = {r.file_id.rsplit("/", 1)[1] for r in framing.quarantine(framed, samples.SPEC.spec_id).collect()}
        return sorted((r.file_id.rsplit("/", 1)[1], r.pos, r.isa_no, r.loop_id or "", tuple(r.path_inst), tuple(r.elements)) for r in rows), bad

    want, bad = segments(files.read_edi(spark, str(folder)))
    assert bad == {"bad.txt"} and {r[0] for r in want} == {"a b+c%20.txt", "x.txt", "two.txt", "file_id=big=1"}
    assert sum(r[0] == "file_id=big=1" for r in want) == sum(r[0] == "x.txt" for r in want) == len(long_)
    monkeypatch.setattr(files, "SLICE_SEGMENTS", 7)
    # ranges far shorter than a file, and some shorter than a segment
    for size in (700,):
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        try:
            assert segments(files.read_edi(spark, str(folder), whole_bytes=0)) == (want, bad)
            assert segments(files.read_edi(spark, str(folder), "ISO-8859-1", whole_bytes=2000)) == (want, bad)
        finally:
            spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_documents_that_differ_in_delimiters_only_are_equal(spark):
    one, two = samples.locate(spark, {"a": samples.text(DOC)}), samples.locate(spark, {"a": samples.text(DOC, "|", "^", ">")})
    assert lookup.same_document(one, two).isEmpty()
    prints = lookup.fingerprint_documents(one).unionByName(lookup.fingerprint_documents(two).withColumn("file_id", F.lit("b")))
    assert [r.copies for r in lookup.dedup_documents(prints).collect()] == [2]
    changed = edits.set_element(two, F.col("seg_id") == "CLM", 2, F.lit("0"))
    assert {r.only_in for r in lookup.same_document(one, changed).collect()} == {"left", "right"}


def test_many_addresses_at_once(spark):
    located = samples.locate(spark, {"a": samples.text(DOC), "b": samples.text(DOC, "|", "^", ">")}).cache()
    loop_rows = loops.link_parents(located)
    addresses = [Address(f"{k}-{n}-{sub}", "2300", "CLM", k, loop_no=n, sub=sub) for k in (1, 2, 5) for n in (0, 1, 7) for sub in (None, 0, 9)]
    got = {(r.file_id, r.address): r.value for r in lookup.get_elements(located, loop_rows, addresses).collect()}
    assert len(got) == 2 * 3 * 2 * 3 and not any("-7-" in a for _, a in got)
    for x in addresses:
        alone = {(r.file_id, r.address): r.value for r in lookup.get_element(located, loop_rows, x).collect()}
        assert alone == {k: v for k, v in got.items() if k[1] == x.name}
    assert got["a", "5-0-0"] == "11" and got["b", "5-0-None"] == "11>B>1" and got["a", "5-0-9"] is None


@pytest.mark.parametrize("longest", [16384, 40])
def test_interchanges_of_a_long_document_that_fit_are_one_piece_each(spark, monkeypatch, longest):
    monkeypatch.setattr(framing, "SLICE_SEGMENTS", 7)
    monkeypatch.setattr(writing, "ROWS_PER_PIECE", longest)
    interchanges = [samples.document(*[samples.claim(10 * i + j, j) for j in range(n)]) for i, n in enumerate((1, 9, 2))]
    located = samples.locate(spark, {"a": samples.text([s for d in interchanges for s in d])}, long_documents=True).cache()
    pieces = writing.write_spec_order(located, samples.SPEC, "LF").orderBy("isa_no", "piece").collect()
    got = {}
    for r in pieces:
        assert r.multi
        got.setdefault(r.isa_no, []).append(r.text)
    assert ["".join(x) for x in got.values()] == [samples.text(d, line_break="\n") + "\n" for d in interchanges]
    assert [len(x) for x in got.values()][::2] == [1, 1]
    assert [r.piece for r in pieces if r.isa_no != 2] == [0, 0]
    assert (len(got[2]) > 1) == (longest == 40)


def test_queries_of_one_pass_store_no_segments(spark, monkeypatch):
    monkeypatch.setattr(lake, "_lakes", {})
    one_pass = ("has_loop", "append_element", "find_segments")
    for name in one_pass:
        claims.QUERIES[name][0](spark, "/root/testdata/sf0.001").count()
    x = lake.lake(spark, "/root/testdata/sf0.001")
    assert "located" not in x.__dict__ and "loops" in x.__dict__
    again = loops.link_parents(x.located)
    assert x.loops.exceptAll(again).isEmpty() and again.exceptAll(x.loops).isEmpty()


def test_renumbering_stores_no_segments_of_short_documents(spark, monkeypatch):
    columns = ["file_id", "pos", "seg_id", "path_inst", "loop_inst"]
    stored, real = [], edits.store
    monkeypatch.setattr(edits, "store", lambda df, name: stored.append(df) or real(df, name))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 3)
    try:
        for longest in (16384, 7):
            monkeypatch.setattr(framing, "SLICE_SEGMENTS", longest)
            located = samples.locate(spark, {"a": DOC, "b": samples.document(samples.claim(1, 3))}, long_documents=True).cache()
            left = edits.renumber(located.where("seg_id <> 'HI'"))
            want = {k: [s for s in d if not s.startswith("HI")] for k, d in (("a", DOC), ("b", samples.document(samples.claim(1, 3))))}
            assert samples.rows(left, *columns) == samples.rows(samples.locate(spark, want, long_documents=True), *columns)
            assert all(df.isEmpty() for df in stored) == (longest > 7)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_differing_loops_are_found_without_sorting_segments(spark):
    left = samples.locate(spark, {"a": DOC, "b": samples.document(samples.claim(1, 2), samples.claim(2))}).cache()
    right = edits.set_element(left, (F.col("seg_id") == "LX") & (F.col("file_id") == "b") & (F.get("elements", F.lit(1)) == "2"), 1, F.lit("9"))
    got = sorted((r.file_id, r.loop_id, r.only_in, r.copies) for r in lookup.differing_loops(left, right).collect())
    assert got == [("b", "2400", "left", 1), ("b", "2400", "right", 1)]
    assert lookup.differing_loops(left, left).isEmpty()
    digests = lookup.loop_digests(left)
    assert "SortAggregate" not in digests._jdf.queryExecution().executedPlan().toString()
    assert digests.where("loop_id = 'ISA_LOOP'").count() == 2
    # equal loops have equal digests wherever they stand
    same = digests.where("loop_id = '2400'").groupBy(*lookup.DIGEST).agg(F.count("*").alias("n"))
    assert same.agg(F.sum("n")).first()[0] == digests.where("loop_id = '2400'").count() and same.where("n > 1").count() > 0


def test_queries_of_packed_documents_store_no_whole_segments(spark, monkeypatch):
    monkeypatch.setattr(lake, "_lakes", {})
    for name in ("link_parents", "number_loop_iterations", "flatten"):
        assert claims.QUERIES[name][0](spark, "/root/testdata/sf0.001").count()
    assert "located" not in lake.lake(spark, "/root/testdata/sf0.001", "packed").__dict__
    assert claims.QUERIES["insert_segment"][0](spark, "/root/testdata/sf0.001").count()
    assert "located" not in lake.lake(spark, "/root/testdata/sf0.001").__dict__


def test_lines_may_be_compressed(spark, tmp_path):
    rows = spark.createDataFrame([("a" * 5000,), ("b",)], "text string").repartition(1)
    files.write_lines(rows, str(tmp_path / "x"), "gzip")
    parts = list((tmp_path / "x").glob("part-*.gz"))
    assert parts and sum(p.stat().st_size for p in parts) < 500
    assert sorted(r.value for r in spark.read.text(str(tmp_path / "x")).collect()) == ["a" * 5000, "b"]
