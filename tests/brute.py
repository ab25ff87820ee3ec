"""A slow, direct reading of the loop rules: one document, one tree of dictionaries, no tables."""


def codes_fit(spec_segment, tokens, required_only=True):
    for e in spec_segment.elements:
        if e.codes and (e.usage == "REQUIRED" or not required_only):
            value = tokens[e.seq] if e.seq < len(tokens) else ""
            if value and value not in e.codes:
                return False
    return True


def walk(spec, segments):
    """(loop path or None, role) per segment up to and including the one after which reading stops, and the fault."""
    loops, parents = spec.by_id(), spec.parents()

    def nearest(node, ids, strict):
        node = node["up"] if strict else node
        while node is not None and node["id"] not in ids:
            node = node["up"]
        return node

    def path(node):
        return (path(node["up"]) if node["up"] else ()) + (node["id"],)

    out, here, orphan = [], None, False
    for tokens in segments:
        current = here["id"] if here else None
        found = []
        for loop_id, d in loops.items():
            starts = bool(d.segments) and d.segments[0].xid == tokens[0] and codes_fit(d.segments[0], tokens)
            ends = (len(d.segments) > 1 and d.segments[-1].xid == tokens[0] and loop_id != current
                    and codes_fit(d.segments[-1], tokens))
            if starts or ends:
                if current and tokens[0] in [s.xid for s in loops[current].segments[1:]]:
                    found = []
                    break
                found.append(loop_id)
        target = found[0] if len(found) == 1 else None
        if len(found) > 1:
            found = [f for f in found if not (len(loops[f].segments) > 1 and loops[f].segments[-1].xid == tokens[0]
                                              and codes_fit(loops[f].segments[-1], tokens))]
            if len(found) == 1:
                target = found[0]
            elif found and current:
                inner = [f for f in found if f in [c.xid for c in loops[current].loops]]
                beside = [f for f in found if parents[current] and parents[f][:1] == parents[current][:1]]
                target = (inner or beside or [None])[0]
        if target is None:
            out.append((path(here) if here else None, "body"))
            continue
        if orphan:
            return out, None
        d = loops[target]
        if len(d.segments) > 1 and d.segments[-1].xid == tokens[0] and target != current:
            if here is None:
                return out, "unknown"
            up = nearest(here, [target], strict=True)
            if up is None:
                return out, "never opened"
            here = up
            out.append((path(here), "end"))
            continue
        if target == spec.root.xid:
            here = {"id": target, "up": None}
        elif here is None:
            return out, "unknown"
        else:
            up = nearest(here, parents[target], strict=False)
            if up is None:
                wrapper = parents[target][0]
                if not loops[wrapper].segments:
                    above = nearest(here, parents[wrapper][:1], strict=True)
                    if above is not None:
                        up = {"id": wrapper, "up": above}
            orphan = up is None
            here = {"id": target, "up": up}
        out.append((path(here), "start"))
    return out, None
