"""Turn a spec into lookup tables that decide a segment's loop from the loop before it.

Everything here runs once per spec on the driver and looks at the spec only. The output is two kinds of
constant for the Spark plan:

* the *signature* of a segment: which loops it may start and which it may close, as one small integer;
* the *transition table*: for every current position in the spec tree and every signature, the next position,
  the role of the segment, how many open loops stay open, and the fault if the move is illegal.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property, lru_cache
from itertools import product

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions.arrays import int_table
from ..specs.model import REQUIRED, Seg, Spec

BODY, START, END, DROPPED = 0, 1, 2, 3

FAULT_UNKNOWN_LOOP, FAULT_PARENT_MISSING, FAULT_GRANDPARENT_MISSING, FAULT_NEVER_OPENED = 1, 2, 3, 4

# Layout of a packed move: state (bits 16 and up), kept open loops (8-15), wrapper (7), fault (3-6), role (0-1).


def pack(state: int, keep: int, wrapper: bool, fault: int, role: int) -> int:
    return state << 16 | keep << 8 | int(wrapper) << 7 | fault << 3 | role


def move_state(move: Column) -> Column:
    return F.shiftright(move, 16)


def move_wrapper(move: Column) -> Column:
    return F.shiftright(move, 7).bitwiseAND(F.lit(1))


def move_fault(move: Column) -> Column:
    return F.shiftright(move, 3).bitwiseAND(F.lit(15))


def move_role(move: Column) -> Column:
    return move.bitwiseAND(F.lit(3))


def required_codes(segment: Seg) -> dict[int, frozenset[str]]:
    """Position to allowed codes, for the elements that decide whether a segment opens or closes a loop."""
    return {e.seq: frozenset(e.codes) for e in segment.elements if e.codes and e.usage == REQUIRED}


@dataclass(frozen=True)
class Signature:
    seg_id: str
    starts: frozenset[str]
    closes: frozenset[str]


class Automaton:
    def __init__(self, spec: Spec):
        self.spec = spec
        self.loops = spec.by_id()
        self.order = list(self.loops)
        self.parents = spec.parents()
        self.root_id = spec.root.xid
        self.paths = [path for path, _ in spec.nodes()]
        self.path_no = {path: i + 1 for i, path in enumerate(self.paths)}
        self.first = {k: v.segments[0] for k, v in self.loops.items() if v.segments}
        self.last = {k: v.segments[-1] for k, v in self.loops.items() if len(v.segments) > 1}
        self._signatures()
        self._states()

    # -- signatures ---------------------------------------------------------------------------------------

    def _signatures(self) -> None:
        self.signatures: list[Signature] = []
        self._selectors: list[tuple[str, list[tuple[int, list[str], list[int], int]], list[int]]] = []
        number: dict[Signature, int] = {}
        seg_ids = list(dict.fromkeys([s.xid for s in self.first.values()] + [s.xid for s in self.last.values()]))
        for seg_id in seg_ids:
            rules = [(loop_id, True, required_codes(s)) for loop_id, s in self.first.items() if s.xid == seg_id]
            rules += [(loop_id, False, required_codes(s)) for loop_id, s in self.last.items() if s.xid == seg_id]
            dims = []
            for position in sorted({p for _, _, codes in rules for p in codes}):
                # class 0: a code no rule lists; class 1: blank; then one class per set of rules that list the code
                known = sorted({c for _, _, codes in rules for c in codes.get(position, ())})
                members = {c: tuple(c in codes[position] if position in codes else None for _, _, codes in rules)
                           for c in known}
                classes = list(dict.fromkeys(members.values()))
                accepts = [tuple(False if position in codes else None for _, _, codes in rules),
                           tuple(True if position in codes else None for _, _, codes in rules)] + classes
                dims.append((position, known, [classes.index(members[c]) + 2 for c in known], accepts))
            table = []
            for combo in product(*[range(len(d[3])) for d in dims]):
                holds = [all(dims[k][3][cls][r] is not False for k, cls in enumerate(combo)) for r in range(len(rules))]
                sig = Signature(seg_id,
                                frozenset(rules[r][0] for r, ok in enumerate(holds) if ok and rules[r][1]),
                                frozenset(rules[r][0] for r, ok in enumerate(holds) if ok and not rules[r][1]))
                if not sig.starts and not sig.closes:
                    table.append(0)
                    continue
                if sig not in number:
                    number[sig] = len(number) + 1
                    self.signatures.append(sig)
                table.append(number[sig])
            self._selectors.append((seg_id, [(p, known, cls, len(acc)) for p, known, cls, acc in dims], table))
        self.n_sigs = len(self.signatures) + 1

    def signature(self, elements: Column) -> Column:
        """L1 as an expression: the signature number of a segment given as its element array; 0 meets no rule.

        The tables of all segment ids lie one after the other, and a fold over the positions that decide gives the place in them. So
        the expression is small however many rules there are: one branch for each id and position made compiled methods too long
        for the JVM to optimise.
        """
        seg_id = F.get(elements, 0)
        flat, offsets, deciding, steps = [0], [0], [""], {"": 0}
        for name, dims, table in self._selectors:
            offsets.append(len(flat))
            flat += table
            deciding.append(" ".join(str(position) for position, *_ in dims))
            stride = len(table)
            for position, known, classes, size in dims:
                stride //= size
                # a blank is class 1, a code that no rule lists class 0
                steps.update({f"{name}\x1f{position}\x1f{code}": cls * stride for code, cls in [("", 1), *zip(known, classes, strict=True)]})
        ids = [name for name, _, _ in self._selectors]
        no = F.array_position(F.split(F.lit("\n".join(ids)), "\n"), seg_id).cast("int")
        # constant: an array of positions for each segment id
        positions = F.array(*[int_table(p.split()) if p else F.array().cast("array<int>") for p in deciding])
        keys = F.split(F.lit("\n".join(list(steps)[1:])), "\n")

        def step(place: Column, position: Column) -> Column:
            key = F.concat(seg_id, F.lit("\x1f"), position.cast("string"), F.lit("\x1f"), F.coalesce(F.get(elements, position), F.lit("")))
            return place + F.get(int_table(steps.values()), F.array_position(keys, key).cast("int"))

        place = F.aggregate(F.get(positions, no), F.get(int_table(offsets), no), step)
        return F.when(seg_id.isin(*ids), F.get(int_table(flat), place)).otherwise(F.lit(0))

    # -- states -------------------------------------------------------------------------------------------
    # 0 = nothing open yet; 1..n = a position in the tree; then one "orphan" state per loop, entered when a loop
    # starts without its parent; the final state is "stopped": the document cannot be read any further.

    def _states(self) -> None:
        n = len(self.paths)
        self.orphan = {loop_id: n + 1 + i for i, loop_id in enumerate(self.order)}
        self.stopped = n + 1 + len(self.order)
        self.n_states = self.stopped + 1
        self.state_loop: list[str | None] = [None] + [p[-1] for p in self.paths] + self.order + [None]
        self.state_depth = [0] + [len(p) for p in self.paths] + [0] * len(self.order) + [0]

    def _candidates(self, current: str | None, sig: Signature) -> list[str]:
        found = [c for c in self.order if c in sig.starts or (c in sig.closes and c != current)]
        if current is not None and sig.seg_id in [s.xid for s in self.loops[current].segments[1:]]:
            return []
        return found

    def _choose(self, current: str | None, sig: Signature) -> str | None:
        found = self._candidates(current, sig)
        if len(found) <= 1:
            return found[0] if found else None
        openers = [c for c in found if c not in sig.closes]
        if len(openers) <= 1:
            return openers[0] if openers else None
        if current is None:
            return None
        children = [child.xid for child in self.loops[current].loops]
        family = [c for c in openers if c in children]
        if not family:
            above = self.parents[current][:1]
            family = [c for c in openers if above and self.parents[c][:1] == above]
        return family[0] if family else None

    def move(self, state: int, sig_no: int) -> int:
        if state == self.stopped:
            return pack(state, 0, False, 0, DROPPED)
        stay = pack(state, self.state_depth[state], False, 0, BODY)
        if sig_no == 0:
            return stay
        sig = self.signatures[sig_no - 1]
        current = self.state_loop[state]
        target = self._choose(current, sig)
        if target is None:
            return stay
        if state > len(self.paths):
            return pack(self.stopped, 0, False, 0, DROPPED)
        path = self.paths[state - 1] if state else ()
        closes = target in self.last and self.last[target].xid == sig.seg_id and target != current
        if closes:
            if state == 0:
                return pack(self.stopped, 0, False, FAULT_UNKNOWN_LOOP, DROPPED)
            above = self._nearest(path[:-1], [target])
            if above is None:
                return pack(self.stopped, 0, False, FAULT_NEVER_OPENED, DROPPED)
            return pack(self.path_no[above], len(above), False, 0, END)
        if target == self.root_id:
            return pack(self.path_no[(target,)], 0, False, 0, START)
        if state == 0:
            return pack(self.stopped, 0, False, FAULT_UNKNOWN_LOOP, DROPPED)
        parent = self._nearest(path, self.parents[target])
        if parent is not None:
            return pack(self.path_no[parent + (target,)], len(parent), False, 0, START)
        wrapper = self.parents[target][0]
        if self.loops[wrapper].segments:
            return pack(self.orphan[target], 0, False, FAULT_PARENT_MISSING, START)
        above = self._nearest(path[:-1], self.parents[wrapper][:1])
        if above is None:
            return pack(self.orphan[target], 0, False, FAULT_GRANDPARENT_MISSING, START)
        return pack(self.path_no[above + (wrapper, target)], len(above), True, 0, START)

    @staticmethod
    def _nearest(path: tuple[str, ...], ids: list[str]) -> tuple[str, ...] | None:
        for end in range(len(path), 0, -1):
            if path[end - 1] in ids:
                return path[:end]
        return None

    # -- the table ----------------------------------------------------------------------------------------

    @cached_property
    def moves(self) -> list[int]:
        """All moves, flat: index ``state * n_sigs + sig``."""
        return [self.move(s, g) for s in range(self.n_states) for g in range(self.n_sigs)]


class Union:
    """The automata of several specs side by side: one walk over documents of all of them.

    States are numbered through all specs; a document starts in state 0 of its own spec and stays among its states. Rules
    keep the numbers they have in their spec, so ``moves`` has one stretch for each spec and ``row`` says where the moves of
    a state begin.
    """

    def __init__(self, specs: tuple[Spec, ...]):
        self.automata = [automaton_for(spec) for spec in specs]
        self.max_depth = max(spec.max_depth for spec in specs)
        self.starts: list[int] = []
        self.moves: list[int] = []
        self.row: list[int] = []
        self.state_loop: list[str | None] = []
        self.state_depth: list[int] = []
        self.nodes: list[str | None] = []
        for a in self.automata:
            start = len(self.row)
            self.starts.append(start)
            self.row += [len(self.moves) + state * a.n_sigs for state in range(a.n_states)]
            self.moves += [move + (start << 16) for move in a.moves]
            self.state_loop += a.state_loop
            self.state_depth += a.state_depth
            self.nodes += [None, *["/".join(p) for p in a.paths], *a.order, None]

    def of_spec(self, values: list[Column | int]) -> Column:
        """The value for the row's spec; null for other specs."""
        out = None
        for a, value in zip(self.automata, values, strict=True):
            is_own, value = F.col("spec_id") == a.spec.spec_id, value if isinstance(value, Column) else F.lit(value)
            out = F.when(is_own, value) if out is None else out.when(is_own, value)
        return out

    def signature(self, elements: Column) -> Column:
        return self.of_spec([a.signature(elements) for a in self.automata])

    @property
    def start(self) -> Column:
        return self.of_spec(list(self.starts))


@lru_cache(maxsize=None)
def automaton_for(spec: Spec) -> Automaton:
    return Automaton(spec)


@lru_cache(maxsize=None)
def union_of(specs: tuple[Spec, ...]) -> Union:
    return Union(specs)
