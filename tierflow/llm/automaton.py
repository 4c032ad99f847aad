"""Rule patterns to one deterministic automaton over bytes.

Patterns use literals, ``\\xHH``, classes, groups, ``|`` and the repetitions
``? * + {m} {m,} {m,n}``. All rules go into one nondeterministic automaton, the
subset construction makes it deterministic and partition refinement makes it
minimal. The result is one flat transition array.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


class _Parser:
    """Recursive descent into tuples: ('set', bytes), ('cat', parts), ('alt', parts),
    ('rep', part, least, most or None)."""

    def __init__(self, pattern: str, fold: bool):
        self.text, self.at, self.fold = pattern, 0, fold

    def parse(self):
        tree = self.alternation()
        if self.at != len(self.text):
            raise ValueError(f"unexpected {self.text[self.at]!r} in {self.text!r}")
        return tree

    def peek(self) -> str:
        return self.text[self.at : self.at + 1]

    def take(self) -> str:
        char = self.peek()
        if not char:
            raise ValueError(f"{self.text!r} ends too early")
        self.at += 1
        return char

    def alternation(self):
        parts = [self.sequence()]
        while self.peek() == "|":
            self.take()
            parts.append(self.sequence())
        return parts[0] if len(parts) == 1 else ("alt", parts)

    def sequence(self):
        parts = []
        while self.peek() not in ("", "|", ")"):
            parts.append(self.repeated())
        return ("cat", parts)

    def repeated(self):
        part = self.atom()
        while (char := self.peek()) and char in "?*+{":
            self.take()
            if char == "{":
                inside = ""
                while (c := self.take()) != "}":
                    inside += c
                low, comma, high = inside.partition(",")
                least, most = int(low), (int(high) if high else None) if comma else int(low)
            else:
                least, most = {"?": (0, 1), "*": (0, None), "+": (1, None)}[char]
            part = ("rep", part, least, most)
        return part

    def atom(self):
        char = self.take()
        if char == "(":
            tree = self.alternation()
            if self.take() != ")":
                raise ValueError(f"unclosed group in {self.text!r}")
            return tree
        if char == "[":
            found: set[int] = set()
            while self.peek() != "]":
                low = self.byte(self.take())
                if self.peek() == "-" and self.text[self.at + 1 : self.at + 2] != "]":
                    self.take()
                    found |= set(range(low, self.byte(self.take()) + 1))
                else:
                    found.add(low)
            self.take()
            return ("set", self.folded(found))
        return ("set", self.folded({self.byte(char)}))

    def byte(self, char: str) -> int:
        if char == "\\":
            char = self.take()
            if char == "x":
                return int(self.take() + self.take(), 16)
        return ord(char)

    def folded(self, found: set[int]) -> frozenset[int]:
        if self.fold:
            found = found | {b ^ 32 for b in found if chr(b).isascii() and chr(b).isalpha()}
        return frozenset(found)


def _reversed(tree):
    if tree[0] == "cat":
        return ("cat", [_reversed(part) for part in reversed(tree[1])])
    if tree[0] == "alt":
        return ("alt", [_reversed(part) for part in tree[1]])
    if tree[0] == "rep":
        return ("rep", _reversed(tree[1]), *tree[2:])
    return tree


class _Nfa:
    def __init__(self):
        self.steps: list[list[tuple[frozenset[int], int]]] = []
        self.free: list[list[int]] = []

    def state(self) -> int:
        self.steps.append([])
        self.free.append([])
        return len(self.steps) - 1

    def add(self, tree, start: int) -> int:
        """Build ``tree`` from ``start``; returns its end state."""
        kind = tree[0]
        if kind == "set":
            end = self.state()
            self.steps[start].append((tree[1], end))
            return end
        if kind == "cat":
            for part in tree[1]:
                start = self.add(part, start)
            return start
        if kind == "alt":
            end = self.state()
            for part in tree[1]:
                first = self.state()
                self.free[start].append(first)
                self.free[self.add(part, first)].append(end)
            return end
        _, part, least, most = tree
        for _ in range(least):
            start = self.add(part, start)
        end = self.state()
        self.free[start].append(end)
        if most is None:
            loop = self.state()
            self.free[start].append(loop)
            back = self.add(part, loop)
            self.free[back] += [loop, end]
        else:
            for _ in range(most - least):
                start = self.add(part, start)
                self.free[start].append(end)
        return end

    def closure(self, states) -> frozenset[int]:
        seen, todo = set(states), list(states)
        while todo:
            for other in self.free[todo.pop()]:
                if other not in seen:
                    seen.add(other)
                    todo.append(other)
        return frozenset(seen)


@dataclass(frozen=True)
class Automaton:
    """``table[state + byte]`` is the next state; states are multiples of 256.
    States from ``accepting`` on have rules: bit masks in ``rules[state >> 8]``."""

    table: list[int]
    accepting: int
    rules: list[int]
    start: int
    #: The state that no input leads out of, or -1.
    dead: int
    #: Bytes after which every state is the start state.
    resets: bytes

    @property
    def n_states(self) -> int:
        return len(self.rules)


def compile_rules(
    patterns: list[tuple[str, bool]], anywhere: bool = True, backwards: bool = False
) -> Automaton:
    """One minimal automaton of all (pattern, either case) rules.

    ``anywhere`` lets a match begin at each byte; ``backwards`` builds the
    automaton of the reversed patterns.
    """
    nfa = _Nfa()
    root = nfa.state()
    final = {}
    for number, (pattern, fold) in enumerate(patterns):
        tree = _Parser(pattern, fold).parse()
        first = nfa.state()
        nfa.free[root].append(first)
        final[nfa.add(_reversed(tree) if backwards else tree, first)] = number
    begin = nfa.closure([root])
    # Bytes that no pattern tells apart share a column.
    sets = sorted({s for steps in nfa.steps for s, _ in steps}, key=sorted)
    kinds: dict[tuple[bool, ...], int] = {}
    column = np.array([kinds.setdefault(tuple(b in s for s in sets), len(kinds)) for b in range(256)])
    sample = [int(np.flatnonzero(column == k)[0]) for k in range(len(kinds))]

    found, rows = {begin: 0}, []
    todo = [begin]
    for states in todo:
        row = []
        for b in sample:
            reached = {t for s in states for bytes_, t in nfa.steps[s] if b in bytes_}
            nxt = nfa.closure(reached) | begin if anywhere else nfa.closure(reached)
            if nxt not in found:
                found[nxt] = len(found)
                todo.append(nxt)
            row.append(found[nxt])
        rows.append(row)
    moves = np.array(rows)
    masks = np.array([sum(1 << final[s] for s in states if s in final) for states in todo])
    return _minimal(moves, masks, column)


def _minimal(moves: np.ndarray, masks: np.ndarray, column: np.ndarray) -> Automaton:
    """Merge states that no input tells apart: split blocks until nothing changes."""
    block = np.unique(masks, return_inverse=True)[1]
    while True:
        signature = np.column_stack([block, block[moves]])
        finer = np.unique(signature, axis=0, return_inverse=True)[1].ravel()
        if finer.max() == block.max():
            break
        block = finer
    one = np.unique(block, return_index=True)[1]
    # Accepting states last, so that one comparison finds them.
    order = np.argsort(masks[one] != 0, kind="stable")
    place = np.empty_like(order)
    place[order] = np.arange(len(order))
    table = place[block[moves[one[order]]]][:, column] * 256
    rules = masks[one[order]].tolist()
    accepting = sum(mask == 0 for mask in rules) * 256
    stuck = (table == np.arange(len(table))[:, None] * 256).all(axis=1)
    dead = [int(s) * 256 for s in np.flatnonzero(stuck) if not rules[s]]
    start = int(place[block[0]]) * 256
    resets = bytes(np.flatnonzero((table == start).all(axis=0)).tolist())
    flat = table.ravel().tolist()
    return Automaton(flat, accepting, rules, start, dead[0] if dead else -1, resets)
