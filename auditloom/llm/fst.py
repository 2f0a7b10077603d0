"""Small finite-state transducers and their composition."""

from __future__ import annotations

from collections.abc import Hashable, Iterable


class Transducer:
    """Deterministic letter transducer: one output symbol for each input symbol.

    ``arcs`` maps (state, symbol) to (next state, output); a missing arc keeps the state
    and copies the symbol.
    """

    def __init__(self, arcs: dict[tuple[Hashable, Hashable], tuple[Hashable, Hashable]], start: Hashable = 0):
        self.arcs, self.start = arcs, start

    def step(self, state: Hashable, symbol: Hashable) -> tuple[Hashable, Hashable]:
        return self.arcs.get((state, symbol), (state, symbol))

    def compose(self, other: "Transducer", alphabet: Iterable[Hashable]) -> "Transducer":
        """The transducer that feeds the output of this one to ``other``, with all its arcs over
        ``alphabet`` written out, from the states that can be reached."""
        alphabet, start = list(alphabet), (self.start, other.start)
        arcs, todo, seen = {}, [start], {start}
        while todo:
            state = todo.pop()
            for symbol in alphabet:
                left, middle = self.step(state[0], symbol)
                right, out = other.step(state[1], middle)
                arcs[state, symbol] = (left, right), out
                if (left, right) not in seen:
                    seen.add((left, right))
                    todo.append((left, right))
        return Transducer(arcs, start)

    def run(self, symbols: Iterable[Hashable]) -> list[Hashable]:
        state, out = self.start, []
        for symbol in symbols:
            state, made = self.step(state, symbol)
            out.append(made)
        return out
