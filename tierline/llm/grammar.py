"""Probabilistic automata learnt from examples by merging compatible states of their prefix tree."""

from __future__ import annotations

import math
from collections import deque
from collections.abc import Iterable

#: Certainty at which two states differ, and texts a state must have seen to differ at all.
ALPHA, SEEN = 0.01, 20
_KINDS = ("0123456789", "abcdef", "ghijklmnopqrstuvwxyz", "ABCDEF", "GHIJKLMNOPQRSTUVWXYZ")
#: Characters that formats do not tell apart share a symbol; every other one stands for itself.
SYMBOL = {c: i for i, kind in enumerate(_KINDS) for c in kind}


class Automaton:
    """``counts[s]``, ``ends[s]`` and ``arcs[s][symbol] = [next state, times]``."""

    def __init__(self, examples: Iterable[str]):
        self.counts, self.ends, self.arcs = [0], [0], [{}]
        for text in examples:
            state = 0
            self.counts[0] += 1
            for c in text:
                symbol = SYMBOL.get(c, c)
                if symbol not in self.arcs[state]:
                    self.counts.append(0)
                    self.ends.append(0)
                    self.arcs.append({})
                    self.arcs[state][symbol] = [len(self.arcs) - 1, 0]
                arc = self.arcs[state][symbol]
                arc[1] += 1
                state = arc[0]
                self.counts[state] += 1
            self.ends[state] += 1
        self._merge()

    def _differ(self, x: int, n: int, y: int, m: int) -> bool:
        bound = math.sqrt(0.5 * math.log(2 / ALPHA)) * (1 / math.sqrt(n) + 1 / math.sqrt(m))
        return abs(x / n - y / m) > bound

    def _compatible(self, a: int, b: int) -> bool:
        todo = [(a, b)]
        while todo:
            a, b = todo.pop()
            n, m = self.counts[a], self.counts[b]
            if min(n, m) < SEEN:
                continue
            if self._differ(self.ends[a], n, self.ends[b], m):
                return False
            for symbol in {*self.arcs[a], *self.arcs[b]}:
                to_a, x = self.arcs[a].get(symbol, (None, 0))
                to_b, y = self.arcs[b].get(symbol, (None, 0))
                if self._differ(x, n, y, m):
                    return False
                if to_a is not None and to_b is not None:
                    todo.append((to_a, to_b))
        return True

    def _fold(self, a: int, b: int) -> None:
        """Add the tree below ``b`` to state ``a``."""
        todo = [(a, b)]
        while todo:
            a, b = todo.pop()
            self.counts[a] += self.counts[b]
            self.ends[a] += self.ends[b]
            for symbol, (to, times) in self.arcs[b].items():
                if symbol in self.arcs[a]:
                    self.arcs[a][symbol][1] += times
                    todo.append((self.arcs[a][symbol][0], to))
                else:
                    self.arcs[a][symbol] = [to, times]

    def _merge(self) -> None:
        settled, waiting = [0], deque((0, s) for s in sorted(self.arcs[0], key=str))
        done = set()
        while waiting:
            parent, symbol = waiting.popleft()
            state = self.arcs[parent][symbol][0]
            if state in settled or (parent, symbol) in done:
                continue
            done.add((parent, symbol))
            twin = next((s for s in settled if self._compatible(s, state)), None)
            if twin is None:
                settled.append(state)
                known = [state]
            else:
                self.arcs[parent][symbol][0] = twin
                self._fold(twin, state)
                known = settled
            for s in known:
                waiting.extend((s, x) for x in sorted(self.arcs[s], key=str) if self.arcs[s][x][0] not in settled)

    def log_likelihood(self, text: str) -> float:
        """Natural logarithm of the text's probability; unseen steps get half a count and go nowhere."""
        state, total = 0, 0.0
        for c in text:
            to, times = self.arcs[state].get(SYMBOL.get(c, c), (state, 0))
            # A symbol stands for as many characters as it has.
            width = len(_KINDS[SYMBOL[c]]) if c in SYMBOL else 1
            total += math.log((times + 0.5) / (self.counts[state] + 6) / width)
            state = to
        return total + math.log((self.ends[state] + 0.5) / (self.counts[state] + 6))
