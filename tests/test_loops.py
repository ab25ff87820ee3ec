import random
import re

import brute
import pyarrow as pa
import pytest
import samples
from pyspark.sql import functions as F

from edilake.functions import scan
from edilake.operators import framing, loops
from edilake.plans import walk
from edilake.plans.automaton import Automaton
from edilake.specs.catalog import all_specs, claim_acknowledgement, eligibility_response


def nodes(df):
    return [(r.seg_id, (r.node or "").split("/")[-1], r.role) for r in df.orderBy("pos").collect()]


def test_qualifier_shared_by_claim_and_line_loops(spark):
    rendering = "NM1*82*1*DOC"
    doc = samples.document(samples.claim(1, 1, [rendering]) + [rendering, rendering], samples.claim(2))
    got = [n for s, n, _ in nodes(samples.locate(spark, {"a": doc})) if s == "NM1"][-3:]
    assert got == ["2310B", "2420A", "2420A"]


def test_claims_under_subscriber_and_patient(spark):
    patient = ["HL*3*2*23*0", "PAT*19", "NM1*QC*1*KID"]
    doc = samples.document(samples.claim(1), patient, samples.claim(2), ["NM1*82*1*DOC"], ["HL*4*1*22*0", "SBR*P"], samples.claim(3))
    got = samples.locate(spark, {"a": doc}).where("role = 'start' and loop_id in ('2300', '2420A')").orderBy("pos").collect()
    assert [r.node.split("/")[-2:] for r in got] == [["2000B", "2300"], ["2000C", "2300"], ["2400", "2420A"], ["2000B", "2300"]]


def test_envelopes_nest_and_restart(spark):
    inner = samples.HEAD + samples.PROVIDER + samples.SUBSCRIBER + samples.claim(1) + ["SE*1*1"]
    doc = [samples.isa(1), samples.gs(), *inner, *inner, "GE*1*1", samples.gs(control=8), *inner, "GE*1*1", "IEA*1*1",
           samples.isa(2), samples.gs(), *inner, "GE*1*1", "IEA*1*1"]
    got = samples.locate(spark, {"a": doc}).where("seg_id = 'ST'").orderBy("pos").collect()
    assert [(r.isa_no, r.gs_no, r.st_no) for r in got] == [(1, 1, 1), (1, 1, 2), (1, 2, 1), (2, 1, 1)]
    numbered = loops.number_envelopes(samples.parts(spark, {"a": doc})).where("seg_id = 'ST'").orderBy("pos").collect()
    assert [(r.isa_no, r.gs_no, r.st_no) for r in numbered] == [(1, 1, 1), (1, 1, 2), (1, 2, 1), (2, 1, 1)]
    wrappers = loops.insert_wrappers(samples.locate(spark, {"a": doc})).collect()
    assert len(wrappers) == 4 and {r.loop_id for r in wrappers} == {"DETAIL"}


def test_envelope_counters_have_no_small_limit(spark):
    big = loops._envelope(1 << 40, 1 << 23, 1 << 20)
    steps = [loops._count_envelope(big, F.lit(m)) for m in (1, 2, 3)]
    joined = [loops._join_envelopes(big, loops._envelope(*e)) for e in ((2, 1, 1), (0, 1, 1), (0, 0, 5))]
    row = spark.range(1).select(*[c.alias(f"c{i}") for i, c in enumerate(steps + joined)]).first()
    assert [tuple(e) for e in row] == [((1 << 40) + 1, 0, 0), (1 << 40, (1 << 23) + 1, 0), (1 << 40, 1 << 23, (1 << 20) + 1),
                                       ((1 << 40) + 2, 1, 1), (1 << 40, (1 << 23) + 1, 1), (1 << 40, 1 << 23, (1 << 20) + 5)]


def test_a_trailing_segment_closes_a_loop_that_is_not_an_envelope(spark):
    doc = [samples.isa(version="00401"), samples.gs("004010X092A1", "HB"), "ST*271*1", "BHT*0022*11*1*20240102*0930", "HL*1**20*1",
           "NM1*PR*2*PLAN", "HL*2*1*21*1", "NM1*1P*2*CLINIC", "HL*3*2*22*0", "NM1*IL*1*POE", "EB*1", "LS*2120", "NM1*P3*1*DOC",
           "LE*2120", "SE*1*1", "GE*1*1", "IEA*1*1"]
    got = nodes(samples.locate(spark, {"a": doc}, eligibility_response()))
    assert got[11:15] == [("LS", "2110C", "body"), ("NM1", "2120C", "start"), ("LE", "2110C", "end"), ("SE", "ST_LOOP", "end")]


@pytest.mark.parametrize("name, change, fatal", [
    ("no subscriber", lambda d: [s for s in d if not s.startswith(("HL*2", "SBR", "NM1*IL", "NM1*PR"))],
     ["Failed to store loop data for 2300", "Parent loop 2000B is missing and should already exist"]),
    ("no header", lambda d: [s for s in d if not s.startswith(("BHT", "NM1*41", "PER", "NM1*40"))],
     ["Failed to store loop data for 2000A", "Parent loop of DETAIL is not found!"]),
    ("no end", lambda d: d[:-1], ["Unable to find end of transaction"]),
    ("ends in a body segment", lambda d: d[:-3], ["Unable to find end of transaction"]),
    ("no interchange", lambda d: [d[0].replace("ISA", "IXA")] + d[1:], ["Current loop is unknown. Bad structure detected"]),
    ("only the first line", lambda d: [d[0].replace("ISA", "IXA"), "ZZ*005010X222A1"], ["Last line of data and we don't know the current loop."]),
    ("fine", lambda d: d, []),
])
def test_structural_faults(spark, name, change, fatal):
    located = samples.locate(spark, {name: change(samples.document(samples.claim(1)))})
    assert sorted(r.message for r in loops.structural_faults(located, samples.SPEC).collect()) == fatal


VOCABULARY = (samples.HEAD + samples.PROVIDER + samples.SUBSCRIBER + samples.TAIL + samples.claim(1) + [
    samples.isa(), samples.gs(), "HL*3*2*23*0", "HL*9*1*99", "NM1*82*1*D", "NM1*DN*1*D", "NM1*QC*1*K", "NM1*87*2", "SBR*S*01", "OI***Y",
    "PRV*PE*PXC", "REF*G2*1", "LIN**N4*1", "CTP****2", "SVD*1*2*HC:1", "LQ*UT*1", "FRM*1", "ZZZ*1", "NM1", "PER*XX*1", "PAT*1"])


def random_documents(n, seed):
    rng = random.Random(seed)
    base = samples.document(samples.claim(1, 2), samples.claim(2))
    out = {}
    for i in range(n):
        doc = list(base)
        for _ in range(rng.randint(0, 12)):
            at = rng.randint(2, len(doc))
            action = rng.random()
            if action < 0.6:
                doc.insert(at, rng.choice(VOCABULARY))
            elif action < 0.8 and at < len(doc):
                del doc[at]
            else:
                doc[at:at] = base[rng.randint(0, len(base) - 5):][:rng.randint(1, 20)]
        out[f"d{i:03d}"] = doc
    return out


def test_random_documents_against_a_direct_reading(spark):
    docs = random_documents(150, 1)
    located = samples.locate(spark, docs).cache()
    got = {}
    for r in located.orderBy("file_id", "pos").collect():
        got.setdefault(r.file_id, []).append((tuple(r.node.split("/")) if r.node else None, r.role, r.fault, r.path_inst))
    stopped = 0
    for name, doc in docs.items():
        want, fault = brute.walk(samples.SPEC, [s.rstrip("*").split("*") for s in doc])
        kept = [(n, role) for n, role, _, _ in got[name] if role != "dropped"]
        # a loop without its parent is alone in its path in both readings
        assert kept == want, name
        stopped += len(want) < len(doc)
    assert stopped > 10


def test_open_loops_name_the_last_instance_at_each_depth(spark):
    located = samples.locate(spark, random_documents(60, 2))
    for rows in _by_file(loops.kept(located)).values():
        opened = {}
        for r in rows:
            if r.role == "start":
                if r.wrapped:
                    opened[2 * r.pos - 1] = r.node.split("/")[-2]
                opened[2 * r.pos] = r.loop_id
            if r.fault == 0 and r.node.startswith("ISA_LOOP"):
                assert [opened[i] for i in r.path_inst] == r.node.split("/")
                assert list(r.path_inst) == sorted(r.path_inst)


def _by_file(df):
    out = {}
    for r in df.orderBy("file_id", "pos").collect():
        out.setdefault(r.file_id, []).append(r)
    return out


@pytest.mark.parametrize("slice_segments, fanout", [(2, 3), (7, 1024)])
def test_documents_in_many_parts_give_the_same_loops(spark, monkeypatch, slice_segments, fanout):
    docs = random_documents(25, 3)
    columns = ["file_id", "pos", "isa_no", "gs_no", "st_no", "seg_id", "node", "role", "path_inst", "fault", "wrapped"]
    whole = samples.rows(samples.locate(spark, docs), *columns)
    envelopes = samples.rows(loops.number_envelopes(samples.parts(spark, docs)), "file_id", "pos", "isa_no", "gs_no", "st_no", "elements")
    monkeypatch.setattr(framing, "SLICE_SEGMENTS", slice_segments)
    monkeypatch.setattr(scan, "FANOUT", fanout)
    assert framing.cut_segments(framing.frame(samples.raw(spark, docs), samples.SPEC.spec_id)).groupBy("file_id").count().agg(
        F.min("count")).first()[0] > 3
    located = samples.locate(spark, docs, long_documents=True).cache()
    assert samples.rows(located, *columns) == whole
    cut = samples.rows(loops.number_envelopes(samples.parts(spark, docs)), "file_id", "pos", "isa_no", "gs_no", "st_no", "elements")
    assert cut == envelopes
    with pytest.raises(Exception, match="several parts"):
        samples.locate(spark, docs).collect()
    iterations = loops.number_loop_iterations(loops.link_parents(located))
    seen = {}
    for r in iterations.orderBy("file_id", "loop_inst").collect():
        key = (r.file_id, r.isa_no, r.loop_id)
        seen[key] = seen.get(key, 0) + 1
        assert r.iteration == seen[key]


def test_every_spec_builds_its_table():
    for spec in all_specs().values():
        a = Automaton(spec)
        assert len(a.moves) == a.n_states * a.n_sigs
        assert max(m >> 16 for m in a.moves) < a.n_states


def test_claim_acknowledgement(spark):
    doc = [samples.isa(), samples.gs("005010X214", "HN"), "ST*277*1", "BHT*0085*08*1*20240102*0930", "HL*1**20*1", "NM1*PR*2*PLAN",
           "TRN*1*5", "HL*2*1*21*1", "NM1*41*2*ACME", "TRN*2*6", "STC*A1:20*20240102", "HL*3*2*19*1", "NM1*85*2*CLINIC", "TRN*1*7",
           "HL*4*3*PT", "NM1*QC*1*POE", "TRN*2*8", "STC*A2:20*20240102", "SE*1*1", "GE*1*1", "IEA*1*1"]
    got = [n for _, n, _ in nodes(samples.locate(spark, {"a": doc}, claim_acknowledgement()))]
    assert got[4:18] == ["2000A", "2100A", "2200A", "2000B", "2100B", "2200B", "2200B", "2000C", "2100C", "2200C", "2000D", "2100D",
                         "2200D", "2200D"]


@pytest.mark.parametrize("fanout", [2, 5, 1024])
def test_scan_in_levels(spark, fanout):
    """Up to eleven levels: sums, the last value that is there, and text, whose joining does not commute; one group holds
    most items, and its order is a struct."""
    rows = [("hot", (i // 50, i), i, f"{i}," if i % 3 else None) for i in range(1500)] + [(f"g{i % 40}", (0, i), i, str(i)) for i in range(90)]
    items = spark.createDataFrame(rows, "k string, at struct<a:int,b:int>, n long, t string").repartition(7)

    def expected(step, start):
        out, state = {}, {}
        for k, at, n, t in sorted(rows, key=lambda r: (r[0], r[1])):
            out[k, at] = state.get(k, start)
            state[k] = step(out[k, at], n, t)
        return out

    def scanned(value, compose, start, kind):
        got = scan.exclusive_scan(items.withColumn("v", F.expr(value)), ["k"], "at", "v", compose, start, kind, fanout=fanout)
        return {(r.k, tuple(r.at)): r.entry for r in got.collect()}

    assert scanned("n", lambda a, b: a + b, F.lit(0).cast("bigint"), "bigint") == expected(lambda s, n, t: s + n, 0)
    assert scanned("t", lambda a, b: F.coalesce(b, a), F.lit(None).cast("string"), "string") == expected(lambda s, n, t: t or s, None)
    assert scanned("coalesce(t, '')", lambda a, b: F.concat(a, b), F.lit(""), "string") == expected(lambda s, n, t: s + (t or ""), "")
    assert scan.exclusive_scan(items.where("n < 0"), ["k"], "at", "n", lambda a, b: a + b, F.lit(0).cast("bigint"), "bigint").count() == 0


def test_documents_of_several_types_in_one_walk(spark, monkeypatch):
    """Each document gets the loops its own spec gives it, in one part or many, in any mix."""
    claims = {f"c{i}": samples.document(*[samples.claim(j) for j in range(i + 1)]) for i in range(4)}
    ack = [samples.isa(), samples.gs("005010X214", "HN"), "ST*277*1", "BHT*0085*08*1*20240102*0930", "HL*1**20*1", "NM1*PR*2*PLAN",
           "TRN*1*5", "HL*2*1*21*1", "NM1*41*2*ACME", "TRN*2*6", "STC*A1:20*20240102", "SE*1*1", "GE*1*1", "IEA*1*1"]
    acks = {f"a{i}": ack for i in range(3)}
    columns = ["file_id", "pos", "isa_no", "gs_no", "st_no", "seg_id", "spec_id", "node", "role", "path_inst", "fault", "wrapped"]
    want = sorted(samples.rows(samples.locate(spark, claims), *columns) + samples.rows(samples.locate(spark, acks, claim_acknowledgement()), *columns))
    specs = [samples.SPEC, claim_acknowledgement()]

    def mixed(long):
        framed = framing.frame(samples.raw(spark, {**claims, **acks}).repartition(2))
        return sorted(samples.rows(loops.assign_loops(framing.cut_elements(framing.cut_segments(framed)), specs, long), *columns))

    assert mixed(False) == want
    monkeypatch.setattr(framing, "SLICE_SEGMENTS", 3)
    assert mixed(True) == want


def test_rows_through_small_batches(spark):
    """A document may go through many batches; a filter on the result does not starve the walk."""
    docs = {str(i): samples.document(*[samples.claim(j, 3) for j in range(1, 4 + i)]) for i in range(3)}
    columns = ["file_id", "pos", "isa_no", "gs_no", "st_no", "seg_id", "node", "role", "path_inst", "fault"]
    want = samples.rows(samples.locate(spark, docs), *columns)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "5")
    try:
        assert samples.rows(samples.locate(spark, docs), *columns) == want
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert samples.rows(samples.locate(spark, docs).where("seg_id = 'CLM'"), *columns) == [r for r in want if r[5] == "CLM"]


def test_the_text_of_long_documents_comes_back_whole(spark):
    elems = [["CLM", "1", "", "a b"], ["SV1"], ["", "x"], [""], ["é", "😀"]]
    sep = ("~", "*", ":", "")
    rows = spark.createDataFrame([(1, elems, len(elems), sep), (2, [], 0, sep), (3, [[""]], 1, ("|", "^", ">", ""))],
                                 "id int, elems array<array<string>>, size long, sep struct<seg:string,ele:string,comp:string,line_break:string>")
    back = rows.withColumn("text", loops._as_text()).drop("elems").withColumn("elems", loops._as_elements())
    assert [r.elems for r in back.orderBy("id").collect()] == [elems, [], [[""]]]


def test_parts_of_long_documents_are_shuffled_once(spark, monkeypatch):
    monkeypatch.setattr(framing, "SLICE_SEGMENTS", 7)
    located = samples.locate(spark, random_documents(3, 1), long_documents=True)
    plan = located._jdf.queryExecution().optimizedPlan().toString()
    # the parts, read from their table, meet one small table of what is open before each
    assert plan.count("text#") > 0 and not [x for x in plan.split("\n") if "Relation" in x and "elems#" in x]
    assert sum("Relation" in x and "text#" in x for x in plan.split("\n")) == 1


def test_scan_reads_its_items_once(spark):
    read = spark.sparkContext.accumulator(0)

    @F.udf("long")
    def counted(n):
        read.add(1)
        return n

    items = spark.range(500).select(F.lit("k").alias("k"), F.col("id").alias("at"), counted("id").alias("v")).repartition(3)
    got = scan.exclusive_scan(items, ["k"], "at", "v", lambda a, b: a + b, F.lit(0).cast("bigint"), "bigint", fanout=10)
    assert got.where("at = 499").first().entry == sum(range(499))
    assert read.value == 500


def test_short_and_long_documents_part_before_they_are_ranked(spark):
    rows = spark.range(40).select(F.format_string("f%d", F.col("id") % 2).alias("file_id"), (F.col("id") / 10).cast("int").alias("part"),
                                  (F.col("id") % 2 == 1).alias("multi"), F.col("id").alias("loop_inst"), F.lit("x").alias("k")).localCheckpoint()
    ranked = loops.rank_in_file(rows, ["k"], "loop_inst", "n")
    got = {(r.file_id, r.loop_inst): r.n for r in ranked.collect()}
    assert got == {(f, i): (i // 2 + 1 if f == "f1" else i // 2 - (i // 10 * 5) + 1) for i in range(40) for f in [f"f{i % 2}"]}
    # a filter below each window: the rows of the other side are not sorted and ranked for nothing
    plan = ranked._jdf.queryExecution().optimizedPlan().toString().splitlines()
    windows = [i for i, line in enumerate(plan) if "Window [" in line]
    assert windows and all("Filter" in "".join(plan[i + 1:i + 3]) for i in windows)


def test_only_wrapped_segments_are_exploded_for_wrappers(spark):
    located = samples.locate(spark, {"a": samples.document(samples.claim(1), samples.claim(2))}).localCheckpoint()
    wrappers = loops.insert_wrappers(located)
    assert [(r.loop_id, r.parent_id, r.is_wrapper) for r in wrappers.collect()] == [("DETAIL", "ST_LOOP", True)]
    plan = wrappers._jdf.queryExecution().optimizedPlan().toString().splitlines()
    at = next(i for i, line in enumerate(plan) if "Generate " in line)
    below = "".join(plan[at + 1:])
    assert re.search(r"Filter .*wrapped", below) and "size(" not in below


def test_parts_of_long_documents_are_walked_a_few_segments_at_a_time(spark, monkeypatch):
    union, seen, real = loops.union_of((samples.SPEC,)), [], walk._Walk.steps
    monkeypatch.setattr(walk._Walk, "steps", lambda self, sigs, *rest: seen.append(len(sigs)) or real(self, sigs, *rest))
    parts, size = 20, 16384
    sigs = pa.ListArray.from_arrays(pa.array(range(0, parts * size + 1, size), pa.int32()), pa.array([0] * parts * size, pa.int32()))
    last = walk.last_paths(union).func(
        sigs, pa.array(range(0, parts * size, size), pa.int64()), pa.array([3] * parts, pa.int32()))
    assert len(last) == parts and len(set(map(str, last.to_pylist()))) == 1
    assert max(seen) <= 1 << 16 and sum(seen) == parts * size

    doc = samples.document(*[samples.claim(n, n % 4) for n in range(12)])
    columns = ["file_id", "pos", "seg_id", "elements", "node", "role", "path_inst", "loop_inst", "isa_no", "gs_no", "st_no", "fault", "wrapped"]
    whole = samples.rows(samples.locate(spark, {"a": doc, "b": doc + doc}), *columns)
    monkeypatch.setattr(framing, "SLICE_SEGMENTS", 7)
    for batch in (3, 10):
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
        try:
            located = samples.locate(spark, {"a": doc, "b": doc + doc}, long_documents=True)
            # a worker gets segments, not parts
            assert "array<struct<move" not in located._jdf.queryExecution().toString()
            assert samples.rows(located, *columns) == whole
        finally:
            spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
