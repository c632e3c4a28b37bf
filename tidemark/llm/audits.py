"""The search of operator 13: cheapest edits of a run of turns by iterative-deepening A*.

Turns are reduced to two strings of a letter per turn: its fault (``-`` none, ``x`` must go, ``t`` truncated) and the
initial of its role.  Edits in ASCII order are Delete, Insert, Keep and Rerole; the roles that stay must read
``(s?(ua)+)?``.  A depth-first search tries edits in that order under a bound on the cost; the bound rises to the least
cost that a failed search has proven necessary, and a table keeps what was proven for each state, so the
first accepted path is the cheapest and, among those, the least in ASCII order.
"""

from __future__ import annotations

from collections.abc import Sequence

START, SYSTEM, USER, ASSISTANT = range(4)
ACCEPTED = (START, ASSISTANT)
DELETE, INSERT, RENAME, TRUNCATED = 3, 2, 2, 1
LEGAL = ("su", "ua", "au")
# Where an initial leads from each state, and which one an inserted or renamed turn must have there.
AFTER = {"s": {START: SYSTEM}, "u": {START: USER, SYSTEM: USER, ASSISTANT: USER}, "a": {USER: ASSISTANT}}
STATE = {"s": SYSTEM, "u": USER, "a": ASSISTANT}
WANTED = {START: "u", SYSTEM: "u", USER: "a", ASSISTANT: "u"}
ROLE = {"u": "user", "a": "assistant"}
# Longer runs are cut into segments of so many turns, whose paths between all states are put together.
SEGMENT = 48
Path = tuple[int, str]


def _least_costs(faults: str, initials: str, goals: Sequence[int]) -> list[list[int]]:
    """For each turn and state a lower bound on the cost from there on.

    Faults cost what they cost on their own.  Each pair of neighbours among the turns that may stay, the state and the goal
    included, that the grammar forbids costs at least 1 more: a rename (2) or a deletion (3, of which a truncated turn
    has paid 1) mends two at most, an insertion (2) one.
    """
    out: list[list[int]] = [[]] * (len(faults) + 1)
    out[-1] = [int(g not in goals) for g in range(4)]
    tail, forced, following = 0, 0, None
    for i in range(len(faults) - 1, -1, -1):
        if faults[i] == "x":
            forced += DELETE
        else:
            here = initials[i]
            if following is None:
                tail = int(STATE.get(here, -1) not in goals)
            else:
                tail += int(here + following not in LEGAL)
            forced += TRUNCATED if faults[i] == "t" else 0
            following = here
        if following is None:
            out[i] = [forced + int(g not in goals) for g in range(4)]
        else:
            out[i] = [forced + tail + int(g not in AFTER.get(following, ())) for g in range(4)]
    return out


def _moves(i: int, g: int, faults: str, initials: str) -> list[tuple[str, int, int, int]]:
    """Edits in ASCII order: letter, cost, next turn, next state."""
    wanted = WANTED[g]
    inserted = ("I", INSERT, i, AFTER[wanted][g])
    if i == len(faults):
        return [inserted]
    out = [("D", DELETE, i + 1, g), inserted]
    if faults[i] != "x":
        more = TRUNCATED if faults[i] == "t" else 0
        kept = AFTER.get(initials[i], {}).get(g)
        if kept is not None:
            out.append(("K", more, i + 1, kept))
        if initials[i] != wanted:  # else keeping does the same for less
            out.append(("R", RENAME + more, i + 1, AFTER[wanted][g]))
    return out


def search(faults: str, initials: str, start: int = START, goals: Sequence[int] = ACCEPTED) -> Path:
    """Cost and edits of the cheapest path from ``start`` through all turns to one of ``goals``, which must exist."""
    least = _least_costs(faults, initials, goals)
    proven: dict[int, int] = {}
    last = len(faults)
    limit = least[0][start]
    while True:
        # A frame: turn, state, what may still be spent, edits left, the least cost seen beyond that, cost of the last edit.
        stack = [[0, start, limit, iter(_moves(0, start, faults, initials)), None, 0]]
        letters: list[str] = []
        while stack:
            frame = stack[-1]
            i, g, rest = frame[0], frame[1], frame[2]
            if i == last and g in goals:
                return limit - rest, "".join(letters)
            for letter, cost, j, to in frame[3]:
                need = cost + proven.get(4 * j + to, least[j][to])
                if need <= rest:
                    stack.append([j, to, rest - cost, iter(_moves(j, to, faults, initials)), None, cost])
                    letters.append(letter)
                    break
                if frame[4] is None or need < frame[4]:
                    frame[4] = need
            else:
                proven[4 * i + g] = frame[4]
                stack.pop()
                if stack:
                    letters.pop()
                    need = frame[5] + frame[4]
                    if stack[-1][4] is None or need < stack[-1][4]:
                        stack[-1][4] = need
                else:
                    limit = frame[4]


def _possible(faults: str, initials: str, start: int, goal: int) -> bool:
    if goal == START:
        return start == START
    if goal == SYSTEM:
        return start == SYSTEM or start == START and any(f != "x" and r == "s" for f, r in zip(faults, initials))
    return True


Paths = dict[tuple[int, int], Path]


def paths(faults: str, initials: str) -> Paths:
    """The best path of a run of turns between any two states, where there is one; long runs segment by segment."""
    total: Paths | None = None
    for begin in range(0, max(1, len(faults)), SEGMENT):
        f, r = faults[begin: begin + SEGMENT], initials[begin: begin + SEGMENT]
        part = {(a, b): search(f, r, a, (b,)) for a in range(4) for b in range(4) if _possible(f, r, a, b)}
        total = part if total is None else joined(total, part)
    return total


def joined(left: Paths, right: Paths) -> Paths:
    """The best paths through two runs in a row.

    Of two paths of one cost between the same states over the same turns, neither begins with the other, so the
    least of the joined paths begins with the least of the left ones.
    """
    out: Paths = {}
    for (a, m), (cost, edits) in left.items():
        for b in range(4):
            other = right.get((m, b))
            if other is not None:
                whole = (cost + other[0], edits + other[1])
                if (a, b) not in out or whole < out[a, b]:
                    out[a, b] = whole
    return out


def best(faults: str, initials: str) -> Path:
    """Cost and edits for a whole conversation."""
    if len(faults) <= SEGMENT:
        return search(faults, initials)
    through = paths(faults, initials)
    return min(through[START, b] for b in ACCEPTED if (START, b) in through)


def apply(edits: str, turns: Sequence[tuple[str, str]], state: int = START) -> list[tuple[str, str]]:
    """(role, text) pairs after the edits, from a state of the grammar on."""
    out, i = [], 0
    for edit in edits:
        if edit == "D":
            i += 1
            continue
        letter = turns[i][0][:1] if edit == "K" else WANTED[state]
        state = AFTER[letter][state]
        if edit == "I":
            out.append((ROLE[letter], ""))
        else:
            out.append((turns[i][0] if edit == "K" else ROLE[letter], turns[i][1]))
            i += 1
    return out
