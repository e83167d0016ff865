"""Lightest derivations over a weighted hypergraph, and their use for repairing role sequences.

Knuth's generalisation of shortest paths: items wait in an agenda and are popped lightest first; a
popped item is final, and rules then combine it with other final items. That is right as long as the
weight functions are superior: monotone, and never below any of their arguments. A weight here is
(cost, audit): costs add, audits are put one after the other. Two audits over the same rows with
the same cost are never prefixes of each other (the longer one would have paid for more inserts),
so ties compared in code order stay in that order whatever is appended.

Items of a repair: At(i, state), the first i rows read and the output so far in that state of the
accepted pattern; Span(state, state) over a run of rows, joined with the span of the next run.
"""

from __future__ import annotations

import heapq
from collections.abc import Callable, Hashable, Iterable, Sequence

Weight = tuple[int, str]

# States of `(s?(ua)+)?`: nothing yet, after s, after u, after a. Fixed values.
START, SYSTEM, USER, ASSISTANT = range(4)
STATES = (START, SYSTEM, USER, ASSISTANT)
ACCEPTED = (START, ASSISTANT)
STEP = {
    (START, "s"): SYSTEM,
    (START, "u"): USER,
    (SYSTEM, "u"): USER,
    (ASSISTANT, "u"): USER,
    (USER, "a"): ASSISTANT,
}
ROLES = {"u": "user", "a": "assistant"}
# What an edit costs, and a truncated row that stays.
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 3, 4, 3, 3


def lightest(
    axioms: Iterable[tuple[Hashable, Weight]],
    deduce: Callable[[Hashable, Weight, dict], Iterable[tuple[Hashable, Weight]]],
    enough: Callable[[Hashable], bool],
) -> dict[Hashable, Weight]:
    """Final weights of the items popped until `enough` says so or nothing is left.

    `deduce(item, weight, final)` gives the conclusions of all rules that have `item` among their
    premises and all other premises in `final`, which already holds `item`.
    """
    agenda = [(weight, item) for item, weight in axioms]
    heapq.heapify(agenda)
    final: dict[Hashable, Weight] = {}
    while agenda:
        weight, item = heapq.heappop(agenda)
        if item in final:
            continue
        final[item] = weight
        if enough(item):
            break
        for conclusion, total in deduce(item, weight, final):
            if conclusion not in final:
                heapq.heappush(agenda, (total, conclusion))
    return final


Row = tuple[str, bool, bool]  # role initial, must be deleted, truncated


def spans(
    rows: Sequence[Row], starts: Sequence[int], ends: Sequence[int] | None = None
) -> dict[tuple[int, int], Weight]:
    """Lightest repair of the rows for each state before and after them.

    With `ends` only the lightest of those states after the rows is wanted: the agenda stops there.
    """
    n = len(rows)

    def deduce(item, weight, _):
        (i, state), (cost, audit) = item, weight
        for initial in "ua":
            if (after := STEP.get((state, initial))) is not None:
                yield (i, after), (cost + INSERT, audit + "I")
        if i == n:
            return
        initial, must_go, cut = rows[i]
        yield (i + 1, state), (cost + DELETE, audit + "D")
        if must_go:
            return
        stays = cost + (TRUNCATED if cut else 0)
        if (after := STEP.get((state, initial))) is not None:
            yield (i + 1, after), (stays + KEEP, audit + "K")
        for given in "ua":
            if (after := STEP.get((state, given))) is not None:
                yield (i + 1, after), (stays + REROLE, audit + "R")

    out = {}
    for start in starts:
        left = {(n, s) for s in (STATES if ends is None else ends)}

        def enough(item):
            if ends is not None:
                return item in left
            left.discard(item)
            return not left

        final = lightest([((0, start), (0, ""))], deduce, enough)
        out.update({(start, s): final[n, s] for s in STATES if (n, s) in final})
    return out


def join(
    left: dict[tuple[int, int], Weight], right: dict[tuple[int, int], Weight]
) -> dict[tuple[int, int], Weight]:
    """Spans over two neighbouring runs: Span(a, b) and Span(b, c) conclude Span(a, c)."""

    def deduce(item, weight, final):
        side, a, b = item
        if side == "left":
            for c in STATES:
                if (other := final.get(("right", b, c))) is not None:
                    yield ("both", a, c), (weight[0] + other[0], weight[1] + other[1])
        elif side == "right":
            for start in STATES:
                if (other := final.get(("left", start, a))) is not None:
                    yield ("both", start, b), (other[0] + weight[0], other[1] + weight[1])

    axioms = [(("left", *k), w) for k, w in left.items()]
    axioms += [(("right", *k), w) for k, w in right.items()]
    final = lightest(axioms, deduce, lambda item: False)
    return {item[1:]: w for item, w in final.items() if item[0] == "both"}


def goal(found: dict[tuple[int, int], Weight]) -> Weight:
    """The lightest accepted repair from the start."""
    return min(found[START, s] for s in ACCEPTED if (START, s) in found)
