"""Envelope numbers and loop assignment.

The loop of a segment depends on the loop before it, so this is a running state over each document. It is kept
inside the row that holds a part, not in a window over all segments: a document that is one part needs no shuffle
at all. The text is cut, split and matched to rules by Spark; only the rule numbers (one int per segment) pass
through Arrow to the state walk in ``plans.walk``. The same walk as nested ``aggregate`` calls took 5 times as long.

A document of several parts needs to know, at the start of each part, what is open there. Each part is first
reduced to a small summary (for every possible state on entry, the state on exit), the summaries are scanned in as
many levels as there need to be (``functions.scan``), and each part gets its entry state by a join on its own key. So no
task ever sees more of one document than one part, or ``scan.FANOUT`` summaries.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.arrays import explode_items, int_table, lookup, running_state
from ..functions.scan import exclusive_scan
from ..plans.automaton import (
    BODY, DROPPED, END, FAULT_GRANDPARENT_MISSING, FAULT_NEVER_OPENED, FAULT_PARENT_MISSING, FAULT_UNKNOWN_LOOP,
    START, Union, automaton_for, move_fault, move_role, move_state, move_wrapper, union_of)
from ..plans.walk import exit_states, last_paths, walk_part_rows, walk_rows
from ..session import store
from ..specs.model import Spec
from .framing import escaped, split_trimmed

# envelope counters: interchanges of the file, groups of the interchange, sets of the group
ENVELOPE = "struct<isa:bigint,gs:bigint,st:bigint>"

ROLE_NAMES = {BODY: "body", START: "start", END: "end", DROPPED: "dropped"}


def _envelope(isa: Column | int = 0, gs: Column | int = 0, st: Column | int = 0) -> Column:
    values = [(v if isinstance(v, Column) else F.lit(v)).cast("bigint") for v in (isa, gs, st)]
    return F.struct(*[v.alias(name) for v, name in zip(values, ("isa", "gs", "st"), strict=True)])


def _isa(env: Column) -> Column:
    return env["isa"]


def _gs(env: Column) -> Column:
    return env["gs"]


def _st(env: Column) -> Column:
    return env["st"]


def _mark(elements: Column) -> Column:
    """1 for an ISA, 2 for a GS, 3 for an ST, else 0: all that the envelope counters need of a segment."""
    return F.when(elements[0] == "ISA", 1).when(elements[0] == "GS", 2).when(elements[0] == "ST", 3).otherwise(0)


def _marked() -> Column:
    """(mark, place) of the segments that change an envelope counter: a handful of each part."""
    return F.filter(F.transform("elems", lambda e, i: F.struct(_mark(e).alias("mark"), i.alias("at"))), lambda x: x["mark"] > 0)


def _count_envelope(env: Column, mark: Column) -> Column:
    """An ISA starts a new interchange and resets the groups; a GS starts a group and resets the sets."""
    return (F.when(mark == 0, env)
            .when(mark == 1, _envelope(_isa(env) + 1))
            .when(mark == 2, _envelope(_isa(env), _gs(env) + 1))
            .otherwise(_envelope(_isa(env), _gs(env), _st(env) + 1)))


def _join_envelopes(before: Column, after: Column) -> Column:
    """The counters at the end of two stretches, the second one counted from zero."""
    return (F.when(_isa(after) > 0, _envelope(_isa(before) + _isa(after), _gs(after), _st(after)))
            .when(_gs(after) > 0, _envelope(_isa(before), _gs(before) + _gs(after), _st(after)))
            .otherwise(_envelope(_isa(before), _gs(before), _st(before) + _st(after))))


# ---------------------------------------------------------------------------------------------------------
# what is open at the start of each part of a long document


def _entry_states(parts: DataFrame, union: Union | None) -> DataFrame:
    """(file_id, part) -> base (segments before it), state, env (envelope counters) at the start of the part."""
    env = F.aggregate("marked", _envelope(), lambda s, x: _count_envelope(s, x["mark"]))
    # states are counted from the first of the document's spec
    exits = exit_states(union)("sigs", union.start) if union else int_table([0])
    summary = parts.select("file_id", "part", F.struct(
        F.col("size").alias("n"), exits.alias("exits"), env.alias("env")).alias("summary"))

    def compose(a: Column, b: Column) -> Column:
        return F.struct((a["n"] + b["n"]).alias("n"),
                        F.transform(a["exits"], lambda s: F.element_at(b["exits"], s + 1)).alias("exits"),
                        _join_envelopes(a["env"], b["env"]).alias("env"))

    def advance(s: Column, p: Column) -> Column:
        return F.struct((s["base"] + p["n"]).alias("base"), F.element_at(p["exits"], s["state"] + 1).alias("state"),
                        _join_envelopes(s["env"], p["env"]).alias("env"))

    start = F.struct(F.lit(0).cast("bigint").alias("base"), F.lit(0).alias("state"), _envelope().alias("env"))
    return exclusive_scan(summary, ["file_id"], "part", "summary", compose, start, f"struct<base:bigint,state:int,env:{ENVELOPE}>",
                          advance).select("file_id", "part", "entry.base", "entry.state", "entry.env")


def _only_short(parts: DataFrame) -> DataFrame:
    """Fail, rather than give wrong loops, if a part of a long document turns up after all."""
    fail = F.raise_error(F.lit("a document has several parts; use long_documents=True")).cast("boolean")
    return parts.where(F.when(F.col("multi"), fail).otherwise(F.lit(True)))


def _nothing_before(parts: DataFrame) -> DataFrame:
    return parts.select(
        "*", F.lit(0).cast("bigint").alias("base"), F.lit(0).alias("state"), _envelope().alias("env"))


def _as_text() -> Column:
    """``elems`` as text again, a fraction of the size of the arrays when written or shuffled; ``_as_elements`` undoes it."""
    segments = F.transform("elems", lambda e: F.call_function("array_join", e, F.col("sep.ele")))
    return F.call_function("array_join", segments, F.col("sep.seg"))


def _as_elements() -> Column:
    segments = F.when(F.col("size") > 0, F.split("text", escaped(F.col("sep.seg")))).otherwise(F.array().cast("array<string>"))
    return F.transform(segments, lambda s: split_trimmed(s, F.col("sep.ele")))


def _stored_parts(multi: DataFrame) -> DataFrame:
    """The parts of long documents, with ``text`` in place of ``elems``. They are visited several times, so they are written to
    the shared folder first, and the passes for the summaries read the number columns only."""
    return store(multi.withColumn("text", _as_text()).drop("elems"), f"long-documents/{uuid.uuid4().hex}")


# ---------------------------------------------------------------------------------------------------------
# E1, E2


def number_envelopes(parts: DataFrame, long_documents: bool = True) -> DataFrame:
    """E1 + E2: segments with ``pos`` (dense in the file), ``isa_no``, ``gs_no`` and ``st_no``; numbers start at 1
    and are 0 before the first such segment of the parent."""
    parts = parts.withColumns({"marked": _marked(), "size": F.size("elems").cast("bigint")})
    if long_documents:
        both = _nothing_before(parts.where(~F.col("multi")))
        multi = _stored_parts(parts.where("multi"))
        entered = multi.join(_entry_states(multi, None), ["file_id", "part"]).withColumn("elems", _as_elements())
        both = both.unionByName(entered.select(*both.columns))
    else:
        both = _nothing_before(_only_short(parts))
    # the counters change at the marked segments only; between them lies a stretch of equal counters
    counted = running_state(F.col("marked"), F.col("env"), lambda s, x: _count_envelope(s, x["mark"]), ENVELOPE)
    starts = F.concat(F.array(F.lit(0)), F.col("marked.at"))
    stretches = F.arrays_zip(starts.alias("at"), F.concat(F.array(F.col("env")), counted).alias("env"),
                             F.concat(F.col("marked.at"), F.array(F.col("size").cast("int"))).alias("end"))
    rows = both.select("file_id", "spec_id", "part", "multi", "sep", "base", "elems", F.inline_outer(stretches)).where(F.col("end") > F.col("at"))
    rows = explode_items(rows, ["file_id", "spec_id", "part", "multi", "sep", (F.col("base") + F.col("at")).alias("base"), "env"],
                         F.slice("elems", F.col("at") + 1, F.col("end") - F.col("at")), "i", "elements")
    return rows.select(
        "file_id", "spec_id", "part", "multi", "sep", (F.col("base") + F.col("i")).alias("pos"),
        F.col("env.isa").alias("isa_no"), F.col("env.gs").alias("gs_no"), F.col("env.st").alias("st_no"),
        F.get("elements", F.lit(0)).alias("seg_id"), "elements")


# ---------------------------------------------------------------------------------------------------------
# L1-L5, E3


def match_loop_rules(segments: DataFrame, spec: Spec) -> DataFrame:
    """L1 as rows: the loops each segment could start or close, judged by the segment alone."""
    a = automaton_for(spec)
    sig = segments.withColumn("sig", a.signature(F.col("elements")))
    loops = [(i + 1, sorted(s.starts), sorted(s.closes)) for i, s in enumerate(a.signatures)]
    rules = segments.sparkSession.createDataFrame(loops, "sig int, may_start array<string>, may_close array<string>")
    return sig.join(F.broadcast(rules), "sig", "left")


def assign_loops(parts: DataFrame, spec: Spec | Sequence[Spec], long_documents: bool = True) -> DataFrame:
    """Every segment with its loop, role, open loops (``path_inst``) and fault. With several specs, documents
    of all of them go through one walk, each by the spec of its ``spec_id``; text is parsed once.

    ``loop_inst`` is twice the position of the segment that opened the loop, minus one for a wrapper: unique in
    the file and in document order. ``long_documents=False`` says that no document has several parts, which makes
    the plan smaller.
    """
    specs = (spec,) if isinstance(spec, Spec) else tuple(spec)
    a = union_of(specs)
    parts = parts.where(F.col("spec_id").isin(*[x.spec_id for x in specs]))

    depth = a.max_depth

    def number(elements: Column) -> Column:
        """Rule and envelope mark of a segment."""
        return a.signature(elements) * 4 + _mark(elements)

    # a document of one part becomes rows first: its text and its rules never leave compiled code
    alone = parts.where(~F.col("multi")) if long_documents else _only_short(parts)
    # ``multi`` is constant on either side, so a filter on it leaves the other side out of the plan
    rows = explode_items(alone, ["file_id", "spec_id", "part", F.lit(False).alias("multi"), "sep", F.lit(0).cast("bigint").alias("base")],
                         "elems", "i", "elements")
    rows = rows.withColumn("sig", number(F.col("elements"))).withColumn("walk", walk_rows(a)("sig", "i", a.start)).drop("sig")
    if long_documents:
        cut = parts.where("multi").withColumns({"sigs": F.transform("elems", number), "size": F.size("elems").cast("bigint")}).withColumn(
            "marked", F.filter(F.transform("sigs", lambda x, i: F.struct((x % 4).alias("mark"), i.alias("at"))), lambda x: x["mark"] > 0))
        multi = _stored_parts(cut)
        # one row for each part, read twice
        entry = store(_entry_states(multi, a), f"entry-states/{uuid.uuid4().hex}")
        # Loops open before this part are called -1, -2, ... by depth until their real numbers are joined in:
        # the last loop that an earlier part opened at that depth. Only numbers travel until both are known.
        last = last_paths(a)("sigs", "base", F.col("state") + a.start)
        exits = multi.select("file_id", "part", "spec_id", "sigs").join(entry, ["file_id", "part"]).select("file_id", "part", last.alias("last"))
        exits = exits.select("file_id", "part", F.array(*[
            F.when(F.get("last", F.lit(k)) >= 0, F.get("last", F.lit(k))) for k in range(depth)]).alias("opened"))
        opened = exclusive_scan(exits, ["file_id"], "part", "opened", lambda a, b: F.transform(
            F.arrays_zip(a.alias("a"), b.alias("b")), lambda x: F.coalesce(x["b"], x["a"])),
            F.array_repeat(F.lit(None).cast("bigint"), depth), "array<bigint>").withColumnRenamed("entry", "before")
        # what is there before a part goes with its first segment only, as text: nested columns cost much time in each batch
        numbers = [F.col("state") + a.start, F.col("env.isa"), F.col("env.gs"), F.col("env.st")]
        there = F.array_join(F.concat(F.array(*[c.cast("bigint") for c in numbers]), "before"), ",", "")
        entered = multi.join(entry.join(opened, ["file_id", "part"]), ["file_id", "part"]).select(
            "file_id", "spec_id", "part", "multi", "sep", "base", F.arrays_zip(_as_elements().alias("elems"), "sigs", F.array(there).alias("entry")).alias("zipped"))
        walked = explode_items(entered, ["file_id", "spec_id", "part", F.lit(True).alias("multi"), "sep", "base"], "zipped", "i", "x")
        walked = walked.select("file_id", "spec_id", "part", "multi", "sep", "base", "i", F.col("x.elems").alias("elements"), F.col("x.sigs").alias("sig"),
                               F.col("x.entry").alias("entry")).where("elements IS NOT NULL")
        walked = walked.withColumn("walk", walk_part_rows(a)("sig", "i", F.col("base") + F.col("i"), "entry"))
        rows = rows.unionByName(walked.select(*rows.columns))
    move, env = F.col("walk.move"), F.col("walk")
    state = move_state(move)
    rows = rows.select(
        "file_id", "spec_id", "part", "multi", "sep",
        _isa(env).alias("isa_no"), _gs(env).alias("gs_no"), _st(env).alias("st_no"),
        (F.col("base") + F.col("i")).alias("pos"),
        F.get("elements", F.lit(0)).alias("seg_id"),
        "elements",
        lookup(a.state_loop, state).alias("loop_id"),
        lookup(a.nodes, state).alias("node"),
        lookup([ROLE_NAMES[r] for r in sorted(ROLE_NAMES)], move_role(move)).alias("role"),
        F.col("walk.path").alias("path_inst"),
        (move_wrapper(move) == 1).alias("wrapped"),
        move_fault(move).alias("fault"),
    )
    return rows.withColumn("loop_inst", F.try_element_at("path_inst", F.lit(-1)))


def kept(located: DataFrame) -> DataFrame:
    """The segments that belong to a loop: without those after a fatal fault or before the first interchange."""
    return located.where((F.col("role") != "dropped") & F.col("loop_id").isNotNull())


def link_parents(located: DataFrame) -> DataFrame:
    """L5 + L6: one row per loop instance, with its parent and ancestors, wrappers included."""
    starts = kept(located).where(F.col("role") == "start")
    base = ["file_id", "spec_id", "part", "multi", "isa_no", "gs_no", "st_no"]
    path_ids = F.split("node", "/")
    n = F.size("path_inst")
    own = F.struct(path_ids.alias("path_ids"), F.col("path_inst"), F.lit(False).alias("is_wrapper"))
    wrapper = F.struct(F.slice(path_ids, F.lit(1), n - 1).alias("path_ids"),
                       F.slice("path_inst", F.lit(1), n - 1).alias("path_inst"), F.lit(True).alias("is_wrapper"))
    # never empty; for a plain inline, Spark would build the arrays once more, for a filter on their size
    rows = starts.select(*base, "pos", "fault", F.inline_outer(
        F.when(F.col("wrapped"), F.array(wrapper, own)).otherwise(F.array(own))))
    return rows.select(
        *base,
        F.element_at("path_inst", -1).alias("loop_inst"),
        F.element_at("path_ids", -1).alias("loop_id"),
        F.try_element_at("path_inst", F.lit(-2)).alias("parent_inst"),
        F.try_element_at("path_ids", F.lit(-2)).alias("parent_id"),
        F.size("path_inst").alias("depth"),
        "path_ids", "path_inst", F.col("pos").alias("start_pos"), "is_wrapper", "fault")


def insert_wrappers(located: DataFrame) -> DataFrame:
    """The loops without segments of their own."""
    return link_parents(located.where("wrapped")).where("is_wrapper")


def close_loops(located: DataFrame) -> DataFrame:
    """The segments that close a loop opened earlier."""
    return located.where(F.col("role") == "end")


def rank_in_file(rows: DataFrame, keys: list[str], order: str, name: str) -> DataFrame:
    """1-based rank of each row among those with equal keys in its file, in document order.

    Ranked inside each part first; parts of long documents then add the rows of the parts before them. A window
    never holds more than one part, plus one small row per part and key.
    """
    rank = F.row_number().over(Window.partitionBy("file_id", "part", *keys).orderBy(order))
    # short and long documents part before the window: no filter moves below it, so each side would rank all rows
    # (rows without the mark are in no result, but what fails for them, like a place that is not there, has to)
    single = rows.where(F.coalesce(~F.col("multi"), F.lit(True))).withColumn(name, rank).where(~F.col("multi"))
    multi = rows.where("multi").withColumn(name, rank)
    counts = rows.where("multi").groupBy("file_id", "part", *keys).agg(F.count("*").alias("_n"))
    before = exclusive_scan(counts, ["file_id", *keys], "part", "_n", lambda a, b: a + b, F.lit(0).cast("bigint"), "bigint").withColumnRenamed("entry", "_before")
    multi = multi.join(before, ["file_id", "part", *keys]).withColumn(name, (F.col(name) + F.col("_before")).cast("int"))
    return single.unionByName(multi.select(*single.columns))


def number_loop_iterations(loops: DataFrame) -> DataFrame:
    """Which instance of its loop id this is within the interchange, in document order."""
    return rank_in_file(loops, ["isa_no", "loop_id"], "loop_inst", "iteration")


def count_loops(loops: DataFrame) -> DataFrame:
    """Instances per loop id."""
    return loops.groupBy("file_id", "isa_no", "loop_id").agg(F.count("*").alias("n"))


# ---------------------------------------------------------------------------------------------------------
# L8


def structural_faults(located: DataFrame, spec: Spec) -> DataFrame:
    """Rows of ``errors`` with severity fatal. A document stops at its first fault."""
    a = automaton_for(spec)
    parents = {k: (v[0] if v else "") for k, v in a.parents.items()}
    at = F.array_position(F.split(F.lit(",".join(a.order)), ","), F.col("loop_id")) - 1
    parent = lookup([parents[k] for k in a.order], at.cast("int"))
    store_failed = F.concat(F.lit("Failed to store loop data for "), F.col("loop_id"))
    texts = (
        F.when(F.col("fault") == FAULT_UNKNOWN_LOOP, F.array(F.lit("Current loop is unknown. Bad structure detected")))
        .when(F.col("fault") == FAULT_PARENT_MISSING, F.array(
            F.concat(F.lit("Parent loop "), parent, F.lit(" is missing and should already exist")), store_failed))
        .when(F.col("fault") == FAULT_GRANDPARENT_MISSING, F.array(
            F.concat(F.lit("Parent loop of "), parent, F.lit(" is not found!")), store_failed))
        .when(F.col("fault") == FAULT_NEVER_OPENED, F.array(
            F.lit("We found an ending segment but we never stored the first part of the loop!")))
    )
    stopped = located.where(F.col("fault") > 0).select(
        "file_id", "isa_no", "loop_id", "loop_inst", "pos", F.explode(texts).alias("message"))

    # the last segment of a document must close its root; only one small row per part leaves the scan
    last = located.groupBy("file_id").agg(
        F.max_by(F.struct("isa_no", "loop_id", "loop_inst", "pos", "role"), "pos").alias("l"),
        F.max("fault").alias("fault"))
    unended = last.where((F.col("fault") == 0) & ~F.coalesce(
        (F.col("l.role") == "end") & (F.col("l.loop_id") == a.root_id), F.lit(False))).select(
        "file_id", "l.isa_no", "l.loop_id", "l.loop_inst", "l.pos",
        F.when(F.col("l.loop_id").isNull(), "Last line of data and we don't know the current loop.")
        .otherwise("Unable to find end of transaction").alias("message"))
    return stopped.unionByName(unended).select(
        "file_id", "isa_no", "loop_id", "loop_inst", "pos", F.lit("fatal").alias("severity"), F.lit("L8").alias("code"), "message")
