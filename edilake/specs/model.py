"""A transaction spec as a small tree, and its flat tables.

A spec is configuration: a few hundred rows at most, fixed by the standard and independent of the data.
It is the only thing this package ever broadcasts without counting it first.
"""

from __future__ import annotations

from dataclasses import dataclass
from xml.etree import ElementTree

from pyspark.sql import DataFrame, SparkSession

REQUIRED, SITUATIONAL, NOT_USED = "REQUIRED", "SITUATIONAL", "NOT_USED"

# The usage letters of the spec files.
USAGE = {"R": REQUIRED, "S": SITUATIONAL, "N": NOT_USED}


@dataclass(frozen=True)
class Ele:
    seq: int
    name: str
    usage: str = SITUATIONAL
    codes: tuple[str, ...] = ()


@dataclass(frozen=True)
class Comp:
    seq: int
    name: str
    usage: str = SITUATIONAL
    parts: tuple[str, ...] = ()


@dataclass(frozen=True)
class Seg:
    xid: str
    name: str
    usage: str
    pos: str
    max_use: str
    elements: tuple[Ele, ...] = ()
    composites: tuple[Comp, ...] = ()


@dataclass(frozen=True)
class Loop:
    xid: str
    name: str
    usage: str
    pos: str
    repeat: str
    segments: tuple[Seg, ...] = ()
    loops: tuple["Loop", ...] = ()


@dataclass(frozen=True)
class Spec:
    spec_id: str
    version: str
    name: str
    root: Loop

    def nodes(self) -> list[tuple[tuple[str, ...], Loop]]:
        """Every tree position in document order, as (path of loop ids, loop)."""
        out: list[tuple[tuple[str, ...], Loop]] = []

        def walk(node: Loop, path: tuple[str, ...]) -> None:
            here = path + (node.xid,)
            out.append((here, node))
            for child in node.loops:
                walk(child, here)

        walk(self.root, ())
        return out

    def by_id(self) -> dict[str, Loop]:
        """Loop id to its first definition; a loop listed under two parents keeps the first one."""
        found: dict[str, Loop] = {}
        for _, node in self.nodes():
            found.setdefault(node.xid, node)
        return found

    def parents(self) -> dict[str, list[str]]:
        """Loop id to its possible parent ids, first listed first."""
        found: dict[str, list[str]] = {}
        for path, node in self.nodes():
            ids = found.setdefault(node.xid, [])
            if len(path) > 1 and path[-2] not in ids:
                ids.append(path[-2])
        return found

    @property
    def max_depth(self) -> int:
        return max(len(path) for path, _ in self.nodes())


# Short constructors, so that a spec module reads like the standard's own table of loops.


def ele(seq: int, name: str, usage: str = "S", codes: str = "") -> Ele:
    return Ele(seq, name, USAGE[usage], tuple(codes.split()))


def comp(seq: int, name: str, usage: str = "S", parts: str = "") -> Comp:
    return Comp(seq, name, USAGE[usage], tuple(p.strip() for p in parts.split(",") if p.strip()))


def seg(xid: str, name: str, usage: str, pos: str, max_use: str, *parts: Ele | Comp) -> Seg:
    return Seg(
        xid, name, USAGE[usage], pos, max_use,
        tuple(p for p in parts if isinstance(p, Ele)),
        tuple(p for p in parts if isinstance(p, Comp)),
    )


def loop(xid: str, name: str, usage: str, pos: str, repeat: str, *parts: Seg | Loop) -> Loop:
    return Loop(
        xid, name, USAGE[usage], pos, repeat,
        tuple(p for p in parts if isinstance(p, Seg)),
        tuple(p for p in parts if isinstance(p, Loop)),
    )


# ---------------------------------------------------------------------------------------------------------
# S3: spec XML to a Spec


def _text(node, tag: str, default: str = "") -> str:
    """A property is an attribute in one schema version and a child element in the other."""
    if tag in node.attrib:
        return node.attrib[tag]
    child = node.find(tag)
    return (child.text or "").strip() if child is not None else default


def _xml_loop(node) -> Loop:
    return Loop(
        node.attrib["xid"], _text(node, "name"), USAGE[_text(node, "usage", "S")], _text(node, "pos"),
        _text(node, "repeat", ">1"),
        tuple(_xml_segment(s) for s in node.findall("segment")),
        tuple(_xml_loop(child) for child in node.findall("loop")),
    )


def _xml_segment(node) -> Seg:
    elements = tuple(
        Ele(int(_text(e, "seq")), _text(e, "name"), USAGE[_text(e, "usage", "S")],
            tuple((c.text or "").strip() for c in e.findall("valid_codes/code")))
        for e in node.findall("element")
    )
    composites = tuple(
        Comp(int(_text(c, "seq")), _text(c, "name"), USAGE[_text(c, "usage", "S")],
             tuple(_text(e, "name") for e in c.findall("element")))
        for c in node.findall("composite")
    )
    return Seg(node.attrib["xid"], _text(node, "name"), USAGE[_text(node, "usage", "S")], _text(node, "pos"),
               _text(node, "max_use", "1"), elements, composites)


def parse_spec_xml(xml: str, spec_id: str, version: str) -> Spec:
    """Read one transaction spec file (a few hundred kilobytes of configuration)."""
    transaction = ElementTree.fromstring(xml)
    return Spec(spec_id, version, _text(transaction, "name"), _xml_loop(transaction.find("loop")))


# ---------------------------------------------------------------------------------------------------------
# the five spec tables

LOOP_DDL = ("spec_id string, node string, loop_id string, parent_id string, depth int, pos string, usage string, "
            "repeat string, name string, has_segments boolean, first_seg string, last_seg string, dfs_no int")
SEG_DDL = "spec_id string, loop_id string, seg_no int, seg_id string, usage string, pos string, max_use string, name string"
ELE_DDL = ("spec_id string, loop_id string, seg_no int, ele_seq int, ele_id string, usage string, name string, "
           "is_composite boolean, codes array<string>")
SUB_DDL = "spec_id string, loop_id string, seg_no int, ele_seq int, sub_seq int, sub_id string, name string"


def spec_tables(spark: SparkSession, *specs: Spec) -> dict[str, DataFrame]:
    """The specs as ``loop``, ``seg``, ``ele`` and ``sub`` DataFrames."""
    loops, segs, eles, subs = [], [], [], []
    for spec in specs:
        for no, (path, node) in enumerate(spec.nodes()):
            ids = [s.xid for s in node.segments]
            loops.append((spec.spec_id, "/".join(path), node.xid, path[-2] if len(path) > 1 else None, len(path),
                          node.pos, node.usage, node.repeat, node.name, bool(ids),
                          ids[0] if ids else None, ids[-1] if len(ids) > 1 else None, no))
        for loop_id, node in spec.by_id().items():
            for seg_no, s in enumerate(node.segments):
                segs.append((spec.spec_id, loop_id, seg_no, s.xid, s.usage, s.pos, s.max_use, s.name))
                for e in s.elements:
                    eles.append((spec.spec_id, loop_id, seg_no, e.seq, f"{s.xid}{e.seq:02d}", e.usage, e.name, False,
                                 list(e.codes) or None))
                for c in s.composites:
                    eles.append((spec.spec_id, loop_id, seg_no, c.seq, f"{s.xid}{c.seq:02d}", c.usage, c.name, True, None))
                    subs.extend((spec.spec_id, loop_id, seg_no, c.seq, i + 1, f"{s.xid}{c.seq:02d}-{i + 1:02d}", name)
                                for i, name in enumerate(c.parts))
    return {
        "loop": spark.createDataFrame(loops, LOOP_DDL),
        "seg": spark.createDataFrame(segs, SEG_DDL),
        "ele": spark.createDataFrame(eles, ELE_DDL),
        "sub": spark.createDataFrame(subs, SUB_DDL),
    }
