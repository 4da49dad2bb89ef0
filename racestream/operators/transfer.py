"""What a stretch of one key's events does to the neighbour state, for any state it may start in.

``Transfer`` is the composable form of ``neighbours.step``: it is learned from the
events of a stretch alone, and two of them in a row make one (``then``,
associative), so stretches can be summarised in parallel and combined as a tree.

Up to the first event of the tracked car, ``me`` keeps the unknown entry position
``m``. A car behind then becomes the follower by a closed rule (the nearest
position behind ``m`` wins, the latest event of it), so only the latest event of
each position and the record positions are kept. From the tracked car's first
event on, ``me`` is known. A car of unknown position that is still held can only
lose a range of positions at either end: those that ``me`` falls behind (the id is
cleared) and those at or behind a car that fits (it is replaced). So a table maps
ranges of entry positions to outcomes, and its size grows with the outcomes that
differ, not with the events or the positions there are.

Follower and leader are mirror images: positions count as ``u``, negated for the
leader, so that "behind" is "greater" for both.

The state after a step tells the follower id of the key's last output row: an
id changes only in steps that put out a row, and tracking starts with one. So a
stretch's outcome holds all that the next one needs. (The placeholder ids of "no
follower" and "no leader" are taken not to be ids of cars.)
"""

from __future__ import annotations

import json
from bisect import bisect_right

from racestream.operators.neighbours import NO_FOLLOWER, NO_LEADER, NeighbourState

INF = float("inf")
KEPT = (False, None, False)  # (id cleared, car taken or None for the entry car, tracking started)
NONE = (True, None, False)


class Side:
    """Follower (``sign`` 1) or leader (-1) from a known ``me`` on: ranges of entry ``u`` -> outcome."""

    __slots__ = ("sign", "none_id", "open", "live")

    def __init__(self, sign: int, none_id: str):
        self.sign, self.none_id = sign, none_id
        self.open = (-INF, INF)  # entry positions whose car is still held
        self.live = {NONE: ["none"]}  # outcome -> ranges of entry positions, "none": no car at entry

    def feed(self, m: int, car: tuple, other: bool) -> None:
        """``car``: what this event's car would become; ``other``: it may be taken at all."""
        sign = self.sign
        um = sign * m
        lo, hi = self.open
        if lo <= um and lo <= hi:
            self.live.setdefault(NONE, []).append((lo, min(hi, um)))
            self.open = lo, hi = um + 1, hi
        pos = car[1]
        u = sign * pos
        takes = other and u > um
        if takes and pos > 0 and hi >= u and lo <= hi:
            self._put((car[0] == self.none_id, car, True), [(max(lo, u), hi)])
            self.open = (lo, min(hi, u - 1))
        out: dict = {}
        for (cleared, held, tracked), ranges in self.live.items():
            if held is not None and not cleared and sign * held[1] <= um:
                cleared = True
            if takes and held is not car and (cleared or pos > 0 and u <= sign * held[1]):
                cleared, held, tracked = car[0] == self.none_id, car, tracked or pos > 0
            out.setdefault((cleared, held, tracked), []).extend(ranges)
        self.live = out

    def _put(self, outcome, ranges) -> None:
        self.live.setdefault(outcome, []).extend(ranges)

    def table(self) -> dict:
        none, pieces = None, []
        for outcome, ranges in self.live.items():
            for r in ranges:
                if r == "none":
                    none = outcome
                else:
                    pieces.append((*r, outcome))
        if self.open[0] <= self.open[1]:
            pieces.append((*self.open, KEPT))
        return {"none": none, "pieces": _joined(pieces)}


def _joined(pieces: list) -> list:
    """Pieces in order, neighbours of the same outcome as one."""
    out: list = []
    for lo, hi, outcome in sorted(pieces, key=lambda p: p[:2]):
        if out and out[-1][2] == outcome and out[-1][1] == lo - 1:
            out[-1] = (out[-1][0], hi, outcome)
        else:
            out.append((lo, hi, outcome))
    return out


class Prefix:
    """Events before the tracked car's first: the latest car of each position, and record positions."""

    __slots__ = ("latest", "records")

    def __init__(self):
        self.latest: dict[int, tuple] = {}  # positions above 0
        self.records: dict[int, list] = {1: [], -1: []}  # by side: cars in order, each with a greater u than before

    def feed(self, car: tuple) -> None:
        pos = car[1]
        if pos > 0:
            self.latest[pos] = car
        for sign, cars in self.records.items():
            if not cars or sign * pos > sign * cars[-1][1]:
                cars.append(car)

    def then(self, other: "Prefix") -> "Prefix":
        out = Prefix()
        out.latest = {**self.latest, **other.latest}
        for sign in (1, -1):
            out.records[sign] = list(self.records[sign])
            for car in other.records[sign]:
                if not out.records[sign] or sign * car[1] > sign * out.records[sign][-1][1]:
                    out.records[sign].append(car)
        return out

    def table(self, sign: int, m: int, none_id: str) -> dict:
        """The same as a table, once ``m`` is known."""
        held = {"none": NONE, "pieces": [(-INF, INF, KEPT)]}
        if m == 0:  # the tracked car has no position: nothing is taken
            return held
        um = sign * m
        cars = self.records[sign]
        first = bisect_right(cars, um, key=lambda c: sign * c[1])
        if first == len(cars):
            return held
        first_car = cars[first]
        near = min((p for p in self.latest if sign * p > um), key=lambda p: sign * p, default=None)
        none = first_car
        # a car at 0 or less stays if nothing positive is at or ahead of it
        if near is not None and (first_car[1] > 0 or sign * near <= sign * first_car[1]):
            none = self.latest[near]
        pieces = [(-INF, INF, KEPT)]
        if near is not None:
            car = self.latest[near]
            pieces = [(-INF, sign * near - 1, KEPT), (sign * near, INF, (car[0] == none_id, car, True))]
        return {"none": (none[0] == none_id, none, none[1] > 0), "pieces": pieces}


def _lookup(table: dict, sign: int, outcome: tuple) -> tuple:
    """The outcome after ``outcome`` and then ``table``, for an outcome that is no entry car still held."""
    cleared, car, tracked = outcome
    if cleared or car is None:
        after = table["none"]
    else:
        u = sign * car[1]
        after = next(o for lo, hi, o in table["pieces"] if lo <= u <= hi)
    if after[1] is None:
        return (cleared or after[0], car, tracked or after[2])
    return (after[0], after[1], tracked or after[2])


def _chain(a: dict, b: dict, sign: int) -> dict:
    pieces = []
    for lo, hi, outcome in a["pieces"]:
        if outcome == KEPT:
            pieces += [(max(lo, x), min(hi, y), o) for x, y, o in b["pieces"] if max(lo, x) <= min(hi, y)]
        else:
            pieces.append((lo, hi, _lookup(b, sign, outcome)))
    return {"none": _lookup(b, sign, a["none"]), "pieces": _joined(pieces)}


SIDES = ((1, NO_FOLLOWER), (-1, NO_LEADER))


class Transfer:
    """The effect of a stretch: ``known`` state at its end, or prefix, last own event and two tables."""

    def __init__(self):
        self.known: list | None = None
        self.prefix = Prefix()
        self.me: list | None = None  # car and details of the tracked car's last event
        self.tables: list | None = None
        self._sides: list | None = None

    # -- learning -----------------------------------------------------------------

    def feed(self, car: tuple, is_target: bool, details: tuple) -> None:
        """One event, in order."""
        if is_target:
            self.me = [*car, *details]
            if self._sides is None:
                self._sides = [Side(*s) for s in SIDES]
        elif self.me is None:
            self.prefix.feed(car)
            return
        m = self.me[1]
        other = not is_target and m != 0
        for side in self._sides:
            side.feed(m, car, other)

    def done(self) -> "Transfer":
        if self._sides is not None:
            self.tables, self._sides = [s.table() for s in self._sides], None
        return self

    # -- use ----------------------------------------------------------------------

    def apply(self, state: list) -> list:
        """``state`` and the result: [me, details, follower, leader, tracking]."""
        if self.known is not None:
            return self.known
        me, details, follower, leader, tracking = state
        cars = [list(follower), list(leader)]
        stages = [[self.prefix.table(sign, me[1], none_id) for sign, none_id in SIDES]]
        if self.tables:
            stages.append(self.tables)
        for tables in stages:
            for k, (sign, none_id) in enumerate(SIDES):
                cleared, car, tracked = _lookup(tables[k], sign, (cars[k][0] == none_id, cars[k], False))
                cars[k] = list(car)
                if cleared:
                    cars[k][0] = none_id
                tracking = tracking or tracked
        if self.me:
            me, details = self.me[:6], self.me[6:]
        return [list(me), list(details), cars[0], cars[1], tracking]

    def then(self, other: "Transfer") -> "Transfer":
        """This stretch and then ``other``, as one."""
        if other.known is not None:
            return other
        out = Transfer()
        if self.known is not None:
            out.known = other.apply(self.known)
            return out
        out.prefix = self.prefix if self.me else self.prefix.then(other.prefix)
        out.me = other.me or self.me
        if self.me:
            out.tables = [_chain(t, other.prefix.table(sign, self.me[1], none_id), sign)
                          for t, (sign, none_id) in zip(self.tables, SIDES)]
            if other.tables:
                out.tables = [_chain(t, o, sign) for t, o, (sign, _) in zip(out.tables, other.tables, SIDES)]
        else:
            out.tables = other.tables
        return out

    # -- text ---------------------------------------------------------------------

    def dump(self) -> list:
        return [self.known, list(self.prefix.latest.values()), self.prefix.records[1], self.prefix.records[-1], self.me,
                self.tables and [[t["none"], t["pieces"]] for t in self.tables]]

    @classmethod
    def load(cls, data: list) -> "Transfer":
        t = cls()
        t.known, latest, high, low, t.me, tables = data
        t.prefix.latest = {c[1]: tuple(c) for c in latest}
        t.prefix.records = {1: [tuple(c) for c in high], -1: [tuple(c) for c in low]}
        t.tables = tables and [{"none": _outcome(none), "pieces": [(lo, hi, _outcome(o)) for lo, hi, o in pieces]}
                               for none, pieces in tables]
        return t


def _outcome(o: list) -> tuple:
    return (o[0], o[1] and tuple(o[1]), o[2])


def fresh() -> list:
    return state_list(NeighbourState())


def state_list(st: NeighbourState) -> list:
    return [list(st.me), list(st.me_details), list(st.follower), list(st.leader), st.tracking]


def state_of(state: list) -> NeighbourState:
    """The state machine in this state; the previous output row's follower follows from it (see above)."""
    me, details, follower, leader, tracking = (list(x) if isinstance(x, list) else x for x in state)
    return NeighbourState(me, details, follower, leader, tracking, follower[0] if tracking else None)


class Segment:
    """Summary of a range of events in key order: its first and last key, what its first run does
    (``head``), and the state its last run ends in (``exit``; None if both are the same run)."""

    __slots__ = ("first", "last", "head", "exit")

    def __init__(self, first: list, last: list, head: Transfer, exit_state: list | None):
        self.first, self.last, self.head, self.exit = first, last, head, exit_state

    def then(self, other: "Segment") -> "Segment":
        same = self.last == other.first
        if other.exit is not None:
            exit_state = other.exit
            head = self.head.then(other.head) if same and self.exit is None else self.head
        elif same and self.exit is None:
            exit_state, head = None, self.head.then(other.head)
        else:
            exit_state, head = other.head.apply(self.exit if same else fresh()), self.head
        return Segment(self.first, other.last, head, exit_state)

    def leave(self, key: list | None, state: list | None) -> tuple[list, list]:
        """(last key, its state) after this range, entered in ``state`` of ``key``."""
        if self.exit is not None:
            return self.last, self.exit
        return self.last, self.head.apply(state if key == self.first else fresh())

    def dump(self) -> str:
        return json.dumps([self.first, self.last, self.head.dump(), self.exit])

    @classmethod
    def load(cls, text: str) -> "Segment":
        first, last, head, exit_state = json.loads(text)
        return cls(first, last, Transfer.load(head), exit_state)
