"""Validation against the spec (V1-V10). Each check returns rows of ``errors``:
``file_id, isa_no, loop_id, loop_inst, pos, severity, code, message``.

The spec side of every join is a broadcast of the spec's own tables. Segment checks (V1, V3-V7) are one pass,
``check_segments``; loop checks (V8, V9) aggregate per parent instance with map-side combine, so one parent with very
many children is no hot spot.
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scan import exclusive_scan
from ..session import store
from ..specs.model import NOT_USED, REQUIRED, Spec
from .loops import kept, link_parents, number_loop_iterations, structural_faults

# Trailers attached by E3 are never counted among a loop's own segments.
UNCOUNTED = ("IEA", "GE", "SE")
UNBOUNDED = ">1"

ERROR_COLUMNS = ["file_id", "isa_no", "loop_id", "loop_inst", "pos", "severity", "code", "message"]

RULE_DDL = ("loop_id string, seg_id string, rules array<struct<seg_no:int,spec_pos:int,"
            "codes:array<struct<seq:int,allowed:array<string>>>,elements:array<int>,composites:array<int>>>")
PROFILE_DDL = "loop_id string, expected array<struct<seg_no:int,seg_id:string,required:boolean,max_use:int>>"


def _segment_rules(spec: Spec, compat: bool) -> list[tuple]:
    rules: dict[tuple[str, str], list] = {}
    for loop_id, node in spec.by_id().items():
        for seg_no, s in enumerate(node.segments):
            coded = [(e.seq, list(e.codes)) for e in s.elements if e.codes]
            if compat:
                # elements with equal code lists share one entry, and the last one is checked
                coded = list({tuple(codes): (seq, codes) for seq, codes in coded}.values())
            rules.setdefault((loop_id, s.xid), []).append((
                seg_no, int(s.pos), coded,
                [e.seq for e in s.elements if e.usage == REQUIRED],
                [c.seq for c in s.composites if c.usage == REQUIRED]))
    return [(loop_id, seg_id, found) for (loop_id, seg_id), found in rules.items()]


def _token(elements: Column, seq: Column) -> Column:
    return F.coalesce(F.get(elements, seq), F.lit(""))


def _codes_hold(rule: Column) -> Column:
    return F.forall(rule["codes"], lambda c: (_token(F.col("elements"), c["seq"]) == "")
                    | F.array_contains(c["allowed"], _token(F.col("elements"), c["seq"])))


def _errors(rows: DataFrame, code: str, message: Column, severity: str = "error") -> DataFrame:
    return rows.select("file_id", "isa_no", "loop_id", "loop_inst", "pos", F.lit(severity).alias("severity"),
                       F.lit(code).alias("code"), message.alias("message"))


def match_segments(located: DataFrame, spec: Spec, compat: bool = False) -> DataFrame:
    """V1 + V2: each start and body segment with the first spec segment of its loop that has its id and accepts
    its codes (``seg_no``, ``spec_pos``; null if none does). ``rules`` are all spec segments with its id."""
    table = F.broadcast(located.sparkSession.createDataFrame(_segment_rules(spec, compat), RULE_DDL))
    rows = kept(located).where(F.col("role").isin("start", "body")).select(
        "file_id", "part", "multi", "isa_no", "loop_id", "loop_inst", "pos", "seg_id", "elements")
    first = F.get(F.filter("rules", _codes_hold), F.lit(0))
    return (rows.join(table, ["loop_id", "seg_id"], "left")
            .withColumn("hit", first)
            .withColumns({"seg_no": F.col("hit.seg_no"), "spec_pos": F.col("hit.spec_pos")}).drop("hit"))


def check_codes(matched: DataFrame) -> DataFrame:
    """V2: the coded elements that no spec segment of that id accepts. These decide V1 and are not errors by
    themselves, so the columns are the element's own."""
    bad = F.filter(F.flatten(F.transform("rules", lambda r: F.transform(
        r["codes"], lambda c: F.struct(r["seg_no"].alias("rule_no"), c["seq"].alias("ele_seq"),
                                       _token(F.col("elements"), c["seq"]).alias("value"),
                                       c["allowed"].alias("allowed"))))),
        lambda x: (x["value"] != "") & ~F.array_contains(x["allowed"], x["value"]))
    return matched.where(F.col("rules").isNotNull() & F.col("seg_no").isNull()).select(
        "file_id", "isa_no", "loop_id", "loop_inst", "pos", "seg_id", F.inline(bad))


def without_fatal(rows: DataFrame, fatal: DataFrame) -> DataFrame:
    """Loop checks run only for files without a fatal row."""
    return rows.join(fatal.select("file_id").distinct(), "file_id", "left_anti")


def _repeat_limits(spec: Spec, spark) -> DataFrame:
    limits = [(k, int(n.repeat), n.usage) for k, n in spec.by_id().items()
              if n.repeat.isdigit() and n.usage != NOT_USED]
    return F.broadcast(spark.createDataFrame(limits, "loop_id string, limit int, usage string"))


def check_loop_repeats(loops: DataFrame, spec: Spec, compat: bool = False) -> DataFrame:
    """V8: a loop more often in one parent than allowed. With ``compat`` the count is an average over all parents
    of the file."""
    limits = _repeat_limits(spec, loops.sparkSession)
    message = F.concat(F.col("loop_id"), F.lit(" appears too many times"))
    inner = loops.where(F.col("parent_inst").isNotNull())
    if not compat:
        counts = inner.groupBy("file_id", "isa_no", "parent_inst", "loop_id").agg(
            F.count("*").alias("n"), F.max("loop_inst").alias("loop_inst"), F.max("start_pos").alias("pos"))
        return _errors(counts.join(limits, "loop_id").where(F.col("n") > F.col("limit")), "V8", message)
    parents = [(k, v[0]) for k, v in spec.parents().items() if v]
    first_parent = F.broadcast(loops.sparkSession.createDataFrame(parents, "loop_id string, parent_id string"))
    counts = loops.groupBy("file_id", "loop_id").agg(
        F.count(F.when(~F.col("is_wrapper") & (F.col("depth") > 1), 1)).alias("n"), F.min("isa_no").alias("isa_no"),
        F.max("loop_inst").alias("loop_inst"), F.max("start_pos").alias("pos"))
    above = counts.select("file_id", F.col("loop_id").alias("parent_id"), F.col("n").alias("n_parents"))
    rows = (counts.where("n > 0").join(limits, "loop_id").join(first_parent, "loop_id")
            .join(above, ["file_id", "parent_id"], "left"))
    average = F.ceil(F.col("n") / F.col("n_parents"))
    fails = F.when(F.coalesce("n_parents", F.lit(0)) == 0, True).otherwise(average > F.col("limit"))
    return _errors(rows.where(fails), "V8", message)


def check_required_child_loops(loops: DataFrame, spec: Spec) -> DataFrame:
    """V9: each instance of a loop must hold each required child."""
    needs: dict[str, list[str]] = {}
    for _, node in spec.nodes():
        for child in node.loops:
            if child.usage == REQUIRED and child.xid not in needs.setdefault(node.xid, []):
                needs[node.xid].append(child.xid)
    table = F.broadcast(loops.sparkSession.createDataFrame(
        [(k, v) for k, v in needs.items() if v], "loop_id string, needed array<string>"))
    parents = number_loop_iterations(loops.where(F.col("loop_id").isin(*[k for k, v in needs.items() if v]))).select(
        "file_id", "isa_no", "loop_inst", "loop_id", "iteration", F.col("start_pos").alias("pos"),
        F.lit(None).cast("string").alias("child"))
    required = sorted({c for v in needs.values() for c in v})
    children = loops.where(F.col("loop_id").isin(*required) & F.col("parent_inst").isNotNull()).select(
        "file_id", "isa_no", F.col("parent_inst").alias("loop_inst"), F.lit(None).cast("string").alias("loop_id"),
        F.lit(None).cast("int").alias("iteration"), F.lit(None).cast("bigint").alias("pos"), F.col("loop_id").alias("child"))
    # the set of child ids is bounded by the spec, and combined before the shuffle
    held = parents.unionByName(children).groupBy("file_id", "isa_no", "loop_inst").agg(
        F.max("loop_id").alias("loop_id"), F.max("iteration").alias("iteration"), F.max("pos").alias("pos"),
        F.collect_set("child").alias("held"))
    rows = held.join(table, "loop_id").withColumn("child", F.explode(F.array_except("needed", "held")))
    return _errors(rows, "V9", F.concat(F.col("child"), F.lit(" is required but not found in "), F.col("loop_id"),
                                        F.lit(" iteration #"), F.col("iteration")))


def _merge_parts(long: DataFrame, width: int) -> DataFrame:
    """``before``, ``is_first`` and ``counts`` of the rows of long documents, over all parts of a loop instance."""
    key = ["file_id", "loop_inst"]
    # read three times
    long = store(long, f"long-loops/{uuid.uuid4().hex}")
    parts = long.groupBy(*key, "part").agg(
        F.max_by("spec_pos", F.when(F.col("spec_pos").isNotNull(), F.col("pos"))).alias("last"), F.first("counts").alias("own"))
    spread = parts.groupBy(*key).agg(
        F.array(*[F.sum(F.get("own", F.lit(k))) for k in range(width)]).alias("total"),
        F.min("part").alias("first_part"), F.count("*").alias("n")).where("n > 1").drop("n")
    entry = exclusive_scan(parts.join(spread.select(*key), key, "left_semi"), key, "part", "last",
                           lambda a, b: F.coalesce(b, a), F.lit(None), "int")
    merged = long.join(entry.join(spread, key), [*key, "part"], "left").withColumns({
        "before": F.coalesce("before", "entry"),
        "is_first": F.col("is_first") & F.coalesce(F.col("part") == F.col("first_part"), F.lit(True)),
        "counts": F.coalesce("total", "counts")})
    return merged.select(*long.columns)


def check_segments(located: DataFrame, spec: Spec, compat: bool = False) -> DataFrame:
    """V1 and V3-V7 together: one scan and, for documents of one part, one shuffle.

    Matching and the search for missing elements happen before the shuffle, so that only numbers travel, by loop
    instance and part. Windows over these give the spec position before each segment and the spec segments in use; the
    first row of an instance carries the checks of the whole instance. An instance with segments in several parts is
    merged from a summary for each part, so a loop of any size is checked in pieces.
    """
    width = max(len(node.segments) for node in spec.by_id().values())
    expected = [(loop_id, [(i, s.xid, s.usage == REQUIRED, -1 if s.max_use == UNBOUNDED else int(s.max_use))
                           for i, s in enumerate(node.segments)])
                for loop_id, node in spec.by_id().items() if node.segments]
    table = F.broadcast(located.sparkSession.createDataFrame(expected, PROFILE_DDL))

    def gaps(positions: str, code: str, noun: str) -> Column:
        def at(rule: Column) -> Column:
            return F.get(F.filter(rule[positions], lambda p: _token(F.col("elements"), p) == ""), F.lit(0))

        def text(x: Column) -> Column:
            return F.when(x["at"] >= F.size("elements"),
                          F.concat(F.lit(f" {noun} at position "), x["at"], F.lit(" does not exist!!!!"))
                          ).otherwise(F.concat(F.lit(f" is missing a required {noun} at "), x["at"]))

        found = F.filter(F.transform("rules", lambda r: F.struct(r["seg_no"].alias("rule_no"), at(r).alias("at"))),
                         lambda x: x["at"].isNotNull())
        return F.transform(found, lambda x: F.struct(x["rule_no"].alias("rule_no"), F.lit(code).alias("code"), text(x).alias("text")))

    matched = match_segments(located, spec, compat)
    missing = F.concat(gaps("elements", "V6", "element"), gaps("composites", "V7", "composite element"))
    rows = matched.select(
        "file_id", "part", "multi", "isa_no", "loop_id", "loop_inst", "pos", "seg_id", "seg_no", "spec_pos",
        F.coalesce(missing, F.array().cast("array<struct<rule_no:int,code:string,text:string>>")).alias("gaps"))
    whole = Window.partitionBy("file_id", "part", "loop_inst")
    so_far = whole.orderBy("pos").rowsBetween(Window.unboundedPreceding, -1)
    beside = [
        F.last("spec_pos", ignorenulls=True).over(so_far).alias("before"),
        (F.col("pos") == F.min("pos").over(whole)).alias("is_first"),
        F.array(*[F.count(F.when(F.col("seg_no") == k, 1)).over(whole) for k in range(width)]).alias("counts")]
    # documents of one part and long ones part before the shuffle: a filter on ``multi`` can't go below a window
    short, long = (rows.where(x).select("*", *beside) for x in ("not multi", "multi"))
    rows = short.unionByName(_merge_parts(long, width)).join(table, "loop_id", "left")

    def item(code: Column, message: Column) -> Column:
        return F.struct(code.alias("code"), message.alias("message"))

    none = F.array().cast("array<struct<code:string,message:string>>")
    where = F.concat(F.lit(" in loop "), F.col("loop_id"))
    unknown = F.when(F.col("seg_no").isNull(), F.array(item(
        F.lit("V1"), F.concat(F.lit("Unable to find a matching segment format in loop "), F.col("loop_id"))))).otherwise(none)
    order = F.when(F.col("before") > F.col("spec_pos"), F.array(item(F.lit("V3"), F.concat(
        F.lit("Segment "), F.col("seg_id"), where, F.lit(" is not in the correct position."))))).otherwise(none)
    absent = F.transform(
        F.filter("gaps", lambda g: F.get("counts", g["rule_no"]) > 0),
        lambda g: item(g["code"], F.concat(F.col("seg_id"), where, g["text"])))

    def over(e: Column) -> Column:
        n = F.get("counts", e["seg_no"])
        bad = (e["max_use"] >= 0) & (n > e["max_use"])
        return bad | ((e["max_use"] < 0) & (n == 0)) if compat else bad

    def lacking(e: Column) -> Column:
        return e["required"] & (F.get("counts", e["seg_no"]) == 0) & ~e["seg_id"].isin(*UNCOUNTED)

    instance = F.when(F.col("is_first"), F.concat(
        F.transform(F.filter("expected", lacking), lambda e: item(
            F.lit("V4"), F.concat(e["seg_id"], where, F.lit(" is required but not found")))),
        F.transform(F.filter("expected", over), lambda e: item(
            F.lit("V5"), F.concat(e["seg_id"], where, F.lit(" appears too many times")))))).otherwise(none)
    return rows.select("file_id", "isa_no", "loop_id", "loop_inst", "pos", F.lit("error").alias("severity"),
                       F.inline(F.concat(unknown, order, absent, F.coalesce(instance, none))))

def check_known_segment(found: DataFrame) -> DataFrame:
    """V1, of the rows of ``check_segments`` as the five below."""
    return found.where("code = 'V1'")


def check_order(found: DataFrame) -> DataFrame:
    """V3: the spec position must not fall within a loop."""
    return found.where("code = 'V3'")


def check_required_segments(found: DataFrame) -> DataFrame:
    """V4."""
    return found.where("code = 'V4'")


def check_segment_max_use(found: DataFrame) -> DataFrame:
    """V5."""
    return found.where("code = 'V5'")


def check_required_elements(found: DataFrame) -> DataFrame:
    """V6: a rule holds for the segments with its id if any segment of the loop was matched to it."""
    return found.where("code = 'V6'")


def check_required_composites(found: DataFrame) -> DataFrame:
    """V7."""
    return found.where("code = 'V7'")


def collect_errors(located: DataFrame, spec: Spec, unreadable: DataFrame | None = None, compat: bool = False,
                   loops: DataFrame | None = None) -> DataFrame:
    """Every error, duplicates kept. Sort by ``file_id, pos`` to read them in document order. Pass ``loops``
    if they are stored already."""
    loops = link_parents(located) if loops is None else loops
    fatal = structural_faults(located, spec)
    whole = without_fatal(loops, fatal)
    found = [
        fatal,
        check_segments(located, spec, compat),
        check_loop_repeats(whole, spec, compat),
        check_required_child_loops(whole, spec),
    ]
    if unreadable is not None:
        found.append(unreadable.select(
            "file_id", F.lit(None).cast("int").alias("isa_no"), F.lit(None).cast("string").alias("loop_id"),
            F.lit(None).cast("bigint").alias("loop_inst"), F.lit(0).cast("bigint").alias("pos"), "severity", "code", "message"))
    return reduce(DataFrame.unionByName, [f.select(*ERROR_COLUMNS) for f in found])
