"""The state walk over the rule numbers of segments, as Arrow UDFs.

Only numbers pass through Arrow. One plain loop finds the moves (a table lookup per segment); the open loops and envelope
counters of all segments of a batch then follow from the moves with running maxima and sums. ``walk_rows`` takes the
segments as rows and carries its state from batch to batch, ``walk_part_rows`` does so within the parts of long documents. So
a worker holds one batch of segments, however long parts are and however many a task has.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from .automaton import START, Union

STEP_TYPE = "struct<move:int,path:array<bigint>,isa:bigint,gs:bigint,st:bigint>"


def _flat(lists: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Values of a list array and the start of each list, counted from the first."""
    offsets = lists.offsets.to_numpy().astype(np.int64)
    values = lists.values.to_numpy(zero_copy_only=False)[offsets[0]:offsets[-1]]
    return values, offsets - offsets[0]


def _counters(mark: np.ndarray, part: np.ndarray, first: np.ndarray, entry: list[np.ndarray]) -> list[np.ndarray]:
    """E1/E2 of every segment: an ISA starts a new interchange and resets the groups; a GS starts a group and resets the
    sets. ``first`` is the place where each segment's part begins, ``entry`` the counters there."""
    n = len(mark)
    at = np.arange(n)
    out, reset = [], first - 1
    for kind, before in zip((1, 2, 3), entry, strict=True):
        seen = np.concatenate((np.zeros(1, np.int64), np.cumsum(mark == kind)))
        inside = reset >= first
        # since the last reset, or since the part began plus what was there
        out.append(seen[1:] - seen[np.maximum(reset, first - 1) + 1] + np.where(inside, 0, before[part]))
        last = np.maximum.accumulate(np.where(mark == kind, at, -1)) if n else at
        reset = np.maximum(reset, np.where(last >= first, last, first - 1))
    return out


class _Walk:
    """Steps over stretches of segments: moves, open loops and counters."""

    def __init__(self, union: Union):
        self.table, self.row = union.moves, union.row
        self.depth_of = np.array([max(d, 1) if union.state_loop[s] else 0 for s, d in enumerate(union.state_depth)])
        self.max_depth = union.max_depth

    def steps(self, sigs: np.ndarray, starts: np.ndarray, pos: np.ndarray, entry: list[int], counters: list[np.ndarray],
              opened: np.ndarray | None = None) -> pa.StructArray:
        """The step of every segment. ``starts`` says where each stretch begins (one more entry at the end); ``entry`` and
        ``counters`` are the states and counters before it; ``opened`` the loops that are open before it, by depth, for the
        first stretches. Other loops opened before a stretch are called -1, -2, ... by depth."""
        values, mark = sigs >> 2, sigs & 3
        sizes = np.diff(starts)
        part = np.repeat(np.arange(len(sizes)), sizes)
        counted = _counters(mark, part, np.repeat(starts[:-1], sizes), counters)
        table, row, rules = self.table, self.row, values.tolist()
        moves: list[int] = []
        for begin, end, now in zip(starts[:-1].tolist(), starts[1:].tolist(), entry):
            for rule in rules[begin:end]:
                move = table[row[now] + rule]
                now = move >> 16
                moves.append(move)
        move = np.array(moves, dtype=np.int64)

        # one extra place before each stretch stands for what is open on entry
        n, parts = len(move), len(sizes)
        place = np.arange(n) + part + 1
        entry_place = starts[:-1] + np.arange(parts)
        depth = self.depth_of[move >> 16]
        top = (move >> 8 & 255) + 1
        opens = (move & 3) == START
        wraps = opens & ((move >> 7 & 1) == 1)
        paths = np.zeros((n, self.max_depth), dtype=np.int64)
        for k in range(1, self.max_depth + 1):
            number = np.full(n + parts, -k, dtype=np.int64)
            if opened is not None:
                number[entry_place[:len(opened)]] = opened[:, k - 1]
            here = opens & (top == k)
            below = wraps & (top == k - 1)
            number[place[here]] = 2 * pos[here] - wraps[here]
            number[place[below]] = 2 * pos[below]
            seen = np.zeros(n + parts, dtype=np.int64)
            seen[entry_place] = entry_place
            changed = place[here | below]
            seen[changed] = changed
            paths[:, k - 1] = number[np.maximum.accumulate(seen)[place]]
        is_open = np.arange(self.max_depth) < depth[:, None]
        path_offsets = np.concatenate(([0], np.cumsum(depth))).astype(np.int32)
        path = pa.ListArray.from_arrays(pa.array(path_offsets), pa.array(paths[is_open]))
        self.after = (int(move[-1]) >> 16, [c[-1:] for c in counted], paths[-1]) if n else None
        return pa.StructArray.from_arrays([pa.array(move.astype(np.int32)), path, *(pa.array(c) for c in counted)],
                                          names=["move", "path", "isa", "gs", "st"])


# Parts of long documents are taken in groups of about so many segments.
GROUP_SEGMENTS = 1 << 16


def _groups(starts: np.ndarray) -> Iterator[tuple[int, int]]:
    """Ranges of lists with about GROUP_SEGMENTS values, one list at least."""
    begin = 0
    while begin < len(starts) - 1:
        end = max(int(np.searchsorted(starts, starts[begin] + GROUP_SEGMENTS, side="right")) - 1, begin + 1)
        yield begin, end
        begin = end


def last_paths(union: Union):
    """UDF with the first arguments of ``walk_parts`` -> the loops that are open after the last segment of a part; those that were
    open before it are called -1, -2, ... by depth."""
    walk = _Walk(union)

    @F.arrow_udf("array<bigint>")
    def last(sigs: pa.Array, base: pa.Array, state: pa.Array) -> pa.Array:
        values, starts = _flat(sigs)
        at, states, out = base.to_numpy(zero_copy_only=False).astype(np.int64), state.to_pylist(), []
        for begin, end in _groups(starts):
            own = starts[begin:end + 1] - starts[begin]
            sizes = np.diff(own)
            pos = np.arange(own[-1]) + np.repeat(at[begin:end] - own[:-1], sizes)
            steps = walk.steps(values[starts[begin]:starts[end]], own, pos, states[begin:end], [np.zeros(end - begin, np.int64)] * 3)
            out.append(steps.field("path").take(pa.array(own[1:] - 1, mask=sizes == 0)))
        return pa.concat_arrays(out) if out else pa.array([], pa.list_(pa.int64()))

    return last


def walk_rows(union: Union):
    """UDF (rule and mark number, place in the document, state at its start) over the rows of whole documents, in order -> move, open loops and
    counters. A document may go through several batches. It must see every row of its partition, so it is declared
    nondeterministic: no filter moves below it."""
    walk = _Walk(union)

    @F.arrow_udf(STEP_TYPE)
    def steps(batches: Iterator[tuple[pa.Array, pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        carried = None
        for sigs, places, states in batches:
            pos = places.to_numpy(zero_copy_only=False).astype(np.int64)
            starts = _stretches(pos)
            entry = states.take(pa.array(starts[:-1])).to_pylist()
            yield _rows(walk, sigs, starts, pos, pos, entry, [np.zeros(len(starts) - 1, np.int64) for _ in range(3)], None, carried)
            carried = walk.after or carried

    return steps.asNondeterministic()


def walk_part_rows(union: Union):
    """Like ``walk_rows`` over the rows of whole parts of long documents, with (rule and mark number, place in the part, position in the document,
    what is there at the part's start: state, envelope counters and open loops by depth, joined by commas, empty if unknown; read at place 0 only)."""
    walk = _Walk(union)
    unknown = -np.arange(1, walk.max_depth + 1)

    @F.arrow_udf(STEP_TYPE)
    def steps(batches: Iterator[tuple[pa.Array, pa.Array, pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        carried = None
        for sigs, places, positions, entries in batches:
            place = places.to_numpy(zero_copy_only=False).astype(np.int64)
            starts = _stretches(place)
            # the first stretch of a batch may go on from the batch before
            rows = [x.split(",") if x else ["0"] * 4 + [""] * walk.max_depth for x in entries.take(pa.array(starts[:-1])).to_pylist()]
            opened = np.array([[int(v) if v else u for u, v in zip(unknown, x[4:], strict=True)] for x in rows], dtype=np.int64)
            counters = [np.array([int(x[k]) for x in rows], dtype=np.int64) for k in (1, 2, 3)]
            yield _rows(walk, sigs, starts, place, positions.to_numpy(zero_copy_only=False).astype(np.int64), [int(x[0]) for x in rows],
                        counters, opened.reshape(-1, walk.max_depth), carried)
            carried = walk.after or carried

    return steps.asNondeterministic()


def _stretches(places: np.ndarray) -> np.ndarray:
    """Where the stretches of a batch begin, and its end: at every place 0, and at its first row."""
    starts = np.flatnonzero(places == 0)
    if len(places) and places[0] != 0:
        starts = np.concatenate(([0], starts))
    return np.append(starts, len(places)).astype(np.int64)


def _rows(walk: _Walk, sigs: pa.Array, starts: np.ndarray, places: np.ndarray, pos: np.ndarray, entry: list[int], counters: list[np.ndarray],
          opened: np.ndarray | None, carried: tuple | None) -> pa.StructArray:
    """The steps of a batch of rows; its first stretch goes on from what is carried unless it begins at place 0."""
    if len(places) and places[0] != 0:
        entry[0] = carried[0]
        for c, before in zip(counters, carried[1], strict=True):
            c[0] = before[0]
        opened = carried[2][None] if opened is None else np.concatenate((carried[2][None], opened[1:]))
    return walk.steps(sigs.to_numpy(zero_copy_only=False).astype(np.int64), starts, pos, entry, counters, opened)


def exit_states(union: Union):
    """UDF (rule numbers of a part, the first state of its spec) -> for every state of the spec before the part, the state
    after it, both counted from the first."""
    tables = {start: (np.array(a.moves).reshape(a.n_states, a.n_sigs) >> 16) for start, a in zip(union.starts, union.automata, strict=True)}

    @F.arrow_udf("array<int>")
    def exits(sigs: pa.Array, first: pa.Array) -> pa.Array:
        values, starts = _flat(sigs)
        out = []
        for begin, end, state in zip(starts[:-1], starts[1:], first.to_pylist()):
            rules = values[begin:end] >> 2
            out.append(composed(tables[state], rules[rules > 0]).astype(np.int32))
        offsets = np.concatenate(([0], np.cumsum([len(x) for x in out]))).astype(np.int32)
        return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(out) if out else np.zeros(0, np.int32)))

    return exits


def composed(after: np.ndarray, rules: np.ndarray) -> np.ndarray:
    """For every state, the state after all rules: tables of neighbouring rules are composed pairwise until one is left."""
    if not len(rules):
        return np.arange(after.shape[0])
    tables = np.ascontiguousarray(after.T[rules])
    while len(tables) > 1:
        odd = tables[-1:] if len(tables) % 2 else tables[:0]
        tables = np.concatenate((np.take_along_axis(tables[1::2], tables[0:len(tables) - len(odd):2], axis=1), odd))
    return tables[0]


def first_ranks():
    """UDF (rank in the part, numbers of the open loops' first segments) over the rows of whole parts, in order -> for each open loop, the rank
    of its first row in the part. A part may go through several batches; what is carried is a number for each of its loops. It must see every
    row of its partition, so it is declared nondeterministic: no filter moves below it."""

    @F.arrow_udf("array<bigint>")
    def firsts(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        carried: dict[int, int] = {}
        for ranks, openers in batches:
            rank = ranks.to_numpy(zero_copy_only=False).astype(np.int64)
            values, starts = _flat(openers)
            part = np.cumsum(rank == 1)  # 0: goes on from the batch before
            row = np.repeat(np.arange(len(rank)), np.diff(starts))
            names, name = np.unique(values, return_inverse=True)
            keys, at, back = np.unique(part[row] * max(len(names), 1) + name, return_index=True, return_inverse=True)
            first = rank[row[at]]
            own = part[row[at]]
            if carried:
                going_on = np.flatnonzero(own == 0)
                first[going_on] = [carried.get(k, v) for k, v in zip(values[at[going_on]].tolist(), first[going_on].tolist())]
            yield pa.ListArray.from_arrays(pa.array(starts.astype(np.int32)), pa.array(first[back]))
            if len(rank):
                if part[-1] > 0:
                    carried = {}
                last = np.flatnonzero(own == part[-1])
                carried.update(zip(values[at[last]].tolist(), first[last].tolist()))

    return firsts.asNondeterministic()
