import pytest
import samples
from test_loops import random_documents

from edilake.operators import framing, loops, reports, validation


def errors(spark, documents, compat=False, severity="error"):
    located = samples.locate(spark, documents).cache()
    unreadable = framing.quarantine(framing.frame(samples.raw(spark, documents), samples.SPEC.spec_id), samples.SPEC.spec_id)
    found = validation.collect_errors(located, samples.SPEC, unreadable, compat)
    return sorted(r.message for r in found.collect() if r.severity == severity)


def changed(old, new):
    return [s.replace(old, new) for s in samples.document(samples.claim(1))]


def without(*starts):
    return [s for s in samples.document(samples.claim(1)) if not s.startswith(starts)]


CASES = {
    "clean": (samples.document(samples.claim(1), samples.claim(2, 3)), []),
    "unknown segment": (changed("N4*TOWN", "N44*TOWN"), [
        "N4 in loop 2010AA is required but not found", "Unable to find a matching segment format in loop 2010AA"]),
    "separators only": (changed("HI*BK:1", "**"), [
        "HI in loop 2300 is required but not found", "Unable to find a matching segment format in loop 2300"]),
    "bad code": (changed("*UN*1", "*XX*1"), [
        "SV1 in loop 2400 is required but not found", "Unable to find a matching segment format in loop 2400"]),
    "order": (samples.document(samples.claim(1), provider=["HL*1**20*1", "NM1*85*2*CLINIC", "N4*TOWN", "N3*1 ROAD"]), [
        "Segment N3 in loop 2010AA is not in the correct position."]),
    "too many": (changed("HI*BK:1", "HI*BK:1~HI*BK:2"), ["HI in loop 2300 appears too many times"]),
    "blank element": (changed("NM1*40*2*PAYER", "NM1*40**PAYER"), ["NM1 in loop 1000B is missing a required element at 2"]),
    "absent element": (changed("PER*IC*DESK*TE*5550001", "PER*IC*DESK"), [
        "PER in loop 1000A element at position 3 does not exist!!!!"]),
    "blank composite": (changed("11:B:1", ""), ["CLM in loop 2300 is missing a required composite element at 5"]),
    "absent composite": (changed("***11:B:1*Y*A*Y*Y", ""), ["CLM in loop 2300 composite element at position 5 does not exist!!!!"]),
    "loop twice": (samples.document(samples.claim(1), provider=samples.PROVIDER + samples.PROVIDER[1:]), ["2010AA appears too many times"]),
    "no provider": (without("NM1*85", "N3", "N4", "REF"), ["2010AA is required but not found in 2000A iteration #1"]),
    "one of two": (samples.document(samples.claim(1), ["HL*3*1*22*0", "SBR*P", "NM1*PR*2*PLAN"], samples.claim(2)), [
        "2010BA is required but not found in 2000B iteration #2"]),
    "claims without lines": (samples.document(samples.claim(1, 0), samples.claim(2), samples.claim(3, 0)), [
        "2400 is required but not found in 2300 iteration #1", "2400 is required but not found in 2300 iteration #3"]),
    "same message twice": (samples.document(samples.claim(1, hi="ZZ*1~ZZ*2")), [
        "HI in loop 2300 is required but not found", *["Unable to find a matching segment format in loop 2300"] * 2]),
}


def test_messages(spark):
    docs = {k: samples.text(v) for k, (v, _) in CASES.items()}
    located = samples.locate(spark, docs).cache()
    found = validation.collect_errors(located, samples.SPEC).collect()
    for name, (_, want) in CASES.items():
        assert sorted(r.message for r in found if r.file_id == name) == sorted(want), name


def test_a_fatal_fault_stops_the_loop_checks_but_not_the_segment_checks(spark):
    doc = [s.replace("HL*2*1*22", "HL*2*1*99") for s in samples.document(samples.claim(1, 0))]
    assert errors(spark, {"a": doc}) == ["OI in loop 2320 is required but not found",
                                         "Unable to find a matching segment format in loop 2010AA"]
    assert errors(spark, {"a": doc}, severity="fatal") == ["Failed to store loop data for 2320",
                                                           "Parent loop 2300 is missing and should already exist"]


def segment_errors(rows, compat=False):
    """V1 and V3-V7 read off the rules, loop by loop."""
    out, nodes, held = [], samples.SPEC.by_id(), {}
    for r in sorted(rows, key=lambda r: r.pos):
        if r.role in ("start", "body") and r.loop_id:
            held.setdefault((r.file_id, r.loop_inst), []).append(r)
    for (file_id, _), segs in held.items():
        loop_id, before, hits = segs[0].loop_id, None, []
        rules = nodes[loop_id].segments
        token = lambda r, n: r.elements[n] if n < len(r.elements) else ""
        add = lambda r, code, text: out.append((file_id, r.pos, code, text))
        for r in segs:
            hit = next((s for s in rules if s.xid == r.seg_id and all(
                token(r, e.seq) in ("", *e.codes) for e in s.elements if e.codes)), None)
            hits.append(hit)
            if hit is None:
                add(r, "V1", f"Unable to find a matching segment format in loop {loop_id}")
            elif before is not None and before > int(hit.pos):
                add(r, "V3", f"Segment {r.seg_id} in loop {loop_id} is not in the correct position.")
            before = before if hit is None else int(hit.pos)
        for s in rules:
            n = sum(h is s for h in hits)
            if s.usage == validation.REQUIRED and not n and s.xid not in validation.UNCOUNTED:
                add(segs[0], "V4", f"{s.xid} in loop {loop_id} is required but not found")
            if s.max_use != ">1" and n > int(s.max_use):
                add(segs[0], "V5", f"{s.xid} in loop {loop_id} appears too many times")
            for r in segs if n else ():
                for code, noun, parts in (("V6", "element", s.elements), ("V7", "composite element", s.composites)):
                    gap = next((p.seq for p in parts if p.usage == validation.REQUIRED and token(r, p.seq) == ""), None)
                    if s.xid == r.seg_id and gap is not None:
                        text = (f"{noun} at position {gap} does not exist!!!!" if gap >= len(r.elements)
                                else f"is missing a required {noun} at {gap}")
                        add(r, code, f"{r.seg_id} in loop {loop_id} {text}")
    return sorted(out)


COLUMNS = ["file_id", "pos", "code", "message"]


@pytest.mark.parametrize("part", [16384, 5])
def test_segment_checks_equal_a_direct_reading_in_one_part_or_many(spark, monkeypatch, part):
    monkeypatch.setattr(framing, "SLICE_SEGMENTS", part)
    documents = {**random_documents(60, 5), **{f"case {k}": samples.text(v) for k, (v, _) in CASES.items()}}
    # a loop with segments of its own over many parts, some unknown, one out of order at the end
    documents["wide"] = samples.text(samples.document(samples.claim(1, 0, ["REF*G1*1", "ZZZ*1"] * 20 + ["HI*BK:2", "NTE*ADD*1", "CLM*2"])))
    located = samples.locate(spark, documents, long_documents=True).cache()
    want = segment_errors(located.collect())
    assert {code for _, _, code, _ in want} == {"V1", "V3", "V4", "V5", "V6", "V7"}
    assert len(want) > 100
    found = validation.check_segments(located, samples.SPEC).cache()
    assert samples.rows(found, *COLUMNS, order=COLUMNS) == want
    single = [validation.check_known_segment, validation.check_order, validation.check_required_segments,
              validation.check_segment_max_use, validation.check_required_elements, validation.check_required_composites]
    assert sum(check(found).count() for check in single) == len(want)


def test_compat_averages_repeats_and_reports_unused_segments(spark):
    # two in one provider, none in the other: the average passes, the count per parent does not
    provider = samples.PROVIDER + samples.PROVIDER[1:]
    doc = samples.document(samples.claim(1), ["HL*3**20*1"], samples.SUBSCRIBER, samples.claim(2), provider=provider)
    located = samples.locate(spark, {"a": doc}).cache()
    loop_rows = loops.link_parents(located)
    sound = [r.message for r in validation.check_loop_repeats(loop_rows, samples.SPEC).collect()]
    compat = [r.message for r in validation.check_loop_repeats(loop_rows, samples.SPEC, True).collect()]
    assert sound == ["2010AA appears too many times"]
    assert "2010AA appears too many times" not in compat
    assert "HEADER appears too many times" not in sound
    unused = validation.check_segment_max_use(validation.check_segments(located, samples.SPEC, True))
    assert "REF in loop 2300 appears too many times" in {r.message for r in unused.collect()}


def test_reports(spark):
    rows = [("a", "x", 5), ("a", "x", 3), ("a", "y", 1), ("b", "x", 2)]
    found = spark.createDataFrame([(f, "error", m, p) for f, m, p in rows] + [("c", "fatal", "z", 1)],
                                  "file_id string, severity string, message string, pos long")
    per_file = reports.errors_per_file(found)
    assert samples.rows(per_file, "file_id", "message", order=("file_id", "first_pos")) == [("a", "y"), ("a", "x"), ("b", "x")]
    assert [tuple(r) for r in reports.error_ranking(found).collect()] == [("x", 2), ("y", 1)]
    assert [tuple(r) for r in reports.error_ranking(found, 1).collect()] == [("x", 2)]
    files = spark.createDataFrame([(f,) for f in "abc"], "file_id string")
    rate = reports.error_rate(files, found).first()
    assert (rate.files, rate.files_with_errors, str(rate.percent)) == (3, 2, "66.67")


@pytest.mark.parametrize("seg, ele, comp", [("|", "^", ">")])
def test_delimiters_do_not_change_the_errors(spark, seg, ele, comp):
    docs = {k: samples.text(v) for k, (v, _) in CASES.items() if k not in ("too many", "separators only", "same message twice")}
    other = {k: samples.text(v, seg, ele, comp, "\r\n") for k, (v, _) in CASES.items() if k in docs}
    columns = ["file_id", "pos", "message"]
    want, got = (samples.rows(validation.collect_errors(samples.locate(spark, d).cache(), samples.SPEC), *columns, order=columns)
                 for d in (docs, other))
    assert got == want
