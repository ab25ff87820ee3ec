"""A spec as XML, in the child-element form that ``parse_spec_xml`` reads."""

from __future__ import annotations

from xml.etree.ElementTree import Element, SubElement, tostring

from ..specs.model import USAGE, Loop, Seg, Spec

LETTER = {v: k for k, v in USAGE.items()}


def _node(parent: Element, tag: str, xid: str, **children: str) -> Element:
    node = SubElement(parent, tag, xid=xid)
    for name, value in children.items():
        SubElement(node, name).text = value
    return node


def _segment(parent: Element, s: Seg) -> None:
    node = _node(parent, "segment", s.xid, name=s.name, usage=LETTER[s.usage], pos=s.pos, max_use=s.max_use)
    for e in s.elements:
        item = _node(node, "element", f"{s.xid}{e.seq:02d}", name=e.name, usage=LETTER[e.usage], seq=f"{e.seq:02d}")
        if e.codes:
            codes = SubElement(item, "valid_codes")
            for code in e.codes:
                SubElement(codes, "code").text = code
    for c in s.composites:
        item = _node(node, "composite", f"{s.xid}{c.seq:02d}", name=c.name, usage=LETTER[c.usage], seq=f"{c.seq:02d}")
        for i, name in enumerate(c.parts, 1):
            _node(item, "element", f"{s.xid}{c.seq:02d}-{i:02d}", name=name, usage="S", seq=f"{i:02d}")


def _loop(parent: Element, node: Loop) -> None:
    out = _node(parent, "loop", node.xid, name=node.name, usage=LETTER[node.usage], pos=node.pos, repeat=node.repeat)
    for s in node.segments:
        _segment(out, s)
    for child in node.loops:
        _loop(out, child)


def to_xml(spec: Spec) -> str:
    root = Element("transaction", xid=spec.spec_id)
    SubElement(root, "name").text = spec.name
    _loop(root, spec.root)
    return tostring(root, encoding="unicode")
