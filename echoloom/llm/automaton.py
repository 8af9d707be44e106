"""Regular expressions as one deterministic automaton over bytes.

The rules' patterns become one nondeterministic automaton; subset construction and minimisation turn it into an array
of transitions. It reads text backwards, so that one pass over the bytes tells at which places a match of each rule
begins. A second automaton per rule, anchored at its begin, tells how far a match goes.
"""

from __future__ import annotations

import re._constants as C
import re._parser

import numpy as np

LANE = 2048


class Nfa:
    """Thompson automaton: per state, moves (set of bytes, state) and empty moves."""

    def __init__(self):
        self.moves, self.empty = [], []

    def state(self):
        self.moves.append([])
        self.empty.append([])
        return len(self.moves) - 1

    def add(self, tree, begin, backwards):
        """The end state of `tree` read from `begin`."""
        for op, arg in (reversed(tree) if backwards else tree):
            begin = self._step(op, arg, begin, backwards)
        return begin

    def _step(self, op, arg, begin, backwards):
        if op in (C.LITERAL, C.NOT_LITERAL, C.IN, C.ANY):
            end = self.state()
            self.moves[begin].append((_bytes(op, arg), end))
            return end
        if op is C.SUBPATTERN:
            return self.add(arg[-1], begin, backwards)
        if op is C.BRANCH:
            end = self.state()
            for option in arg[1]:
                self.empty[self.add(option, begin, backwards)].append(end)
            return end
        if op is C.MAX_REPEAT:
            least, most, tree = arg
            for _ in range(least):
                begin = self.add(tree, begin, backwards)
            if most is C.MAXREPEAT:
                loop = self.state()
                self.empty[begin].append(loop)
                self.empty[self.add(tree, loop, backwards)].append(loop)
                return loop
            end = self.state()
            self.empty[begin].append(end)
            for _ in range(most - least):
                begin = self.add(tree, begin, backwards)
                self.empty[begin].append(end)
            return end
        raise ValueError(f"a rule can't use {op}")


def _bytes(op, arg) -> frozenset:
    if op is C.ANY:
        return frozenset(range(256)) - {10}
    if op is C.LITERAL:
        found = {arg}
    elif op is C.NOT_LITERAL:
        found = set(range(256)) - {arg}
    else:
        found, negated = set(), False
        for kind, value in arg:
            if kind is C.NEGATE:
                negated = True
            elif kind is C.LITERAL:
                found.add(value)
            elif kind is C.RANGE:
                found.update(range(value[0], value[1] + 1))
            else:
                raise ValueError(f"a rule can't use {kind}")
        found = set(range(256)) - found if negated else found
    return frozenset(found)


class Dfa:
    """`table[state * classes + class_of[byte]]` is the next state; `accepts[state]` has a bit for each rule."""

    def __init__(self, patterns: list[str], backwards: bool, anchored: bool):
        nfa = Nfa()
        start, ends = nfa.state(), {}
        for k, p in enumerate(patterns):
            tree = re._parser.parse(p.encode())
            first = nfa.state()
            nfa.empty[start].append(first)
            ends[nfa.add(list(tree), first, backwards)] = 1 << k
        if not anchored:
            nfa.moves[start].append((frozenset(range(256)), start))
        self._classes(nfa)
        self._subsets(nfa, start, ends)
        self._minimise()

    def _classes(self, nfa):
        """Bytes that no rule tells apart are one class."""
        sets = {s for moves in nfa.moves for s, _ in moves}
        signature = {}
        self.class_of = np.zeros(256, np.int64)
        for b in range(256):
            self.class_of[b] = signature.setdefault(tuple(b in s for s in sets), len(signature))
        self.classes = len(signature)
        self._example = [int(np.flatnonzero(self.class_of == c)[0]) for c in range(self.classes)]

    def _subsets(self, nfa, start, ends):
        def closure(states):
            found, todo = set(states), list(states)
            while todo:
                for e in nfa.empty[todo.pop()]:
                    if e not in found:
                        found.add(e)
                        todo.append(e)
            return frozenset(found)

        number, todo, rows = {}, [closure([start])], []
        number[todo[0]] = 0
        while todo:
            now = todo.pop(0)
            row = []
            for b in self._example:
                then = closure({to for s in now for bytes_, to in nfa.moves[s] if b in bytes_})
                if then not in number:
                    number[then] = len(number)
                    todo.append(then)
                row.append(number[then])
            rows.append(row)
        self.table = np.array(rows)
        self.accepts = np.zeros(len(number), np.int64)
        for states, k in number.items():
            for s in states:
                self.accepts[k] |= ends.get(s, 0)

    def _minimise(self):
        """Moore's refinement: states stay together while their accepts and next groups agree."""
        group = np.unique(self.accepts, return_inverse=True)[1]
        while True:
            finer = np.unique(np.column_stack([group, group[self.table]]), axis=0, return_inverse=True)[1].ravel()
            if finer.max() == group.max():
                break
            group = finer
        first = np.unique(group, return_index=True)[1]
        self.start = int(group[0])
        self.table = group[self.table[first]].astype(np.int32).ravel()
        self.accepts = self.accepts[first]
        self.dead = [s for s in range(len(first)) if not self.accepts[s]
                     and (self.table[s * self.classes:(s + 1) * self.classes] == s).all()]

    def longest(self, data: bytes, begin: int, stop: int) -> int:
        """End of the longest match that begins at `begin`, or -1."""
        state, end, classes, table = self.start, -1, self.classes, self._list
        for at in range(begin, stop):
            state = table[state * classes + self._class[data[at]]]
            if state in self._dead:
                break
            if self._accepts[state]:
                end = at + 1
        return end

    def prepare(self):
        """Plain lists for the byte walk."""
        self._list, self._class = self.table.tolist(), self.class_of.tolist()
        self._accepts, self._dead = self.accepts.tolist(), set(self.dead)
        return self

    def scan(self, data: np.ndarray, resets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(places, rule bits) where the automaton accepts after reading the byte there; state is the start at `resets`.

        The bytes are cut into lanes that step together. A lane first assumes the start state; lanes whose neighbour
        ended in another state run again until their states agree with those of the first run.
        """
        lanes = -(-len(data) // LANE)
        if not lanes:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        symbol = np.full(lanes * LANE, self.classes, np.int16)
        symbol[:len(data)] = self.class_of[data]
        symbol = np.ascontiguousarray(symbol.reshape(lanes, LANE).T)
        fresh = np.zeros(lanes * LANE, bool)
        fresh[resets[resets < len(data)]] = True
        fresh = np.ascontiguousarray(fresh.reshape(lanes, LANE).T)
        table = np.full((len(self.accepts), self.classes + 1), self.start, np.int32)
        table[:, :-1] = self.table.reshape(-1, self.classes)
        table, width = table.ravel(), self.classes + 1
        any_fresh = fresh.any(axis=1)
        states = np.empty((LANE, lanes), np.uint16 if len(self.accepts) < 1 << 16 else np.int32)
        now = np.full(lanes, self.start, np.int32)
        for k in range(LANE):
            if any_fresh[k]:
                now[fresh[k]] = self.start
            now = table[now * width + symbol[k]]
            states[k] = now
        todo = np.flatnonzero(states[-1, :-1] != self.start) + 1
        while len(todo):
            now = states[-1, todo - 1].astype(np.int32)
            lane, k = todo, 0
            ended = states[-1, todo].copy()
            while len(lane) and k < LANE:
                now = np.where(fresh[k, lane], self.start, now)
                now = table[now * width + symbol[k, lane]]
                changed = states[k, lane] != now
                states[k, lane[changed]] = now[changed]
                lane, now = lane[changed], now[changed]
                k += 1
            again = todo[(states[-1, todo] != ended)] + 1
            todo = again[again < lanes]
        states = states.T.ravel()[:len(data)]
        places = np.flatnonzero((self.accepts != 0)[states])
        return places, self.accepts[states[places]]
