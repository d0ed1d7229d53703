"""Generalised LR repair: the cheapest edits that make a row of symbols a sentence of a grammar.

A small LR automaton is built from the grammar. Stacks are linked nodes, one for each (state, node below), so
all stacks share what they have in common: a graph. Before each row, symbols may be inserted; a row is
kept, read as another symbol, or deleted. Each of these is a shift, with the reductions it calls for,
on every live stack. Stacks whose tops are equal merge, and the one with the smaller (cost,
audit) goes on: in the grammars this is for, what may follow depends on the top alone.

Audits are not carried along but ranked. Insertions belong to the row they come before, so all
audits after a row end with that row's edit and none is the beginning of another: the order of two
longer ones is that of their ranks, or of what was added to the same one. Live stacks with
costs less their minimum and ranks make one of few *fronts*, and a row takes one front to another; each such
step is worked out once and looked up from then on.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

END = "$"


@dataclass(frozen=True)
class Grammar:
    """Productions as (left, right); the first one's left is the start. Whatever is no left is a terminal."""

    productions: tuple[tuple[str, tuple[str, ...]], ...]
    inserted: str  # terminals that can be made up, or that a row can be read as


#: s is a system turn, u and a are a user's and an assistant's.
ROLES = Grammar(
    (("Conversation", ()), ("Conversation", ("Turns",)), ("Conversation", ("s", "Turns")), ("Turns", ("u", "a")), ("Turns", ("Turns", "u", "a"))), "ua"
)


class Automaton:
    """LR(0) states of a grammar; lookahead, by what can follow a left side, chooses between shift and reduction."""

    def __init__(self, grammar: Grammar) -> None:
        self.rules = grammar.productions
        self.lefts = {left for left, _ in self.rules}
        self.start = self.rules[0][0]
        self.follow = self._follow()
        self.states = [self._close({(i, 0) for i, (left, _) in enumerate(self.rules) if left == self.start})]
        self.goto: dict[tuple[int, str], int] = {}
        for number, items in enumerate(self.states):  # grows meanwhile
            for symbol in sorted({self.rules[i][1][dot] for i, dot in items if dot < len(self.rules[i][1])}):
                moved = self._close({(i, dot + 1) for i, dot in items if self.rules[i][1][dot : dot + 1] == (symbol,)})
                if moved not in self.states:
                    self.states.append(moved)
                self.goto[number, symbol] = self.states.index(moved)

    def _close(self, kernel: set[tuple[int, int]]) -> frozenset[tuple[int, int]]:
        items, todo = set(kernel), list(kernel)
        while todo:
            i, dot = todo.pop()
            for j, (left, _) in enumerate(self.rules):
                if self.rules[i][1][dot : dot + 1] == (left,) and (j, 0) not in items:
                    items.add((j, 0))
                    todo.append((j, 0))
        return frozenset(items)

    def _follow(self) -> dict[str, set[str]]:
        """What can come after each left side; only the start can be empty here."""
        begins = {left: set() for left in self.lefts}
        follow = {left: {END} if left == self.start else set() for left in self.lefts}
        for _ in range(len(self.rules) + 1):
            for left, right in self.rules:
                if right:
                    begins[left] |= begins.get(right[0], {right[0]})
                for a, b in zip(right, (*right[1:], None)):
                    if a in self.lefts:
                        follow[a] |= follow[left] if b is None else begins.get(b, {b})
        return follow

    def reduction(self, state: int, lookahead: str) -> int | None:
        for i, dot in self.states[state]:
            if dot == len(self.rules[i][1]) and lookahead in self.follow[self.rules[i][0]]:
                return i
        return None


@dataclass(frozen=True, eq=False)
class Stack:
    """A node of the graph: a state on top of another node."""

    number: int
    state: int
    below: Stack | None


@dataclass(frozen=True)
class Costs:
    rerole: int = 3
    delete: int = 4
    insert: int = 3
    flawed: int = 3  # added to a flawed row that stays


@dataclass(frozen=True)
class Back:
    """How a head came about: from which state, by which edits, and the symbols they made."""

    state: int
    edits: str
    symbols: str


Kind = tuple[str, bool, bool]  # a row's symbol ("" if none of the grammar's), must it go, is it flawed
Front = tuple[tuple[int, int, int, int], ...]  # of each live stack: state, cost above the least, rank, node


@dataclass
class Repairer:
    grammar: Grammar = ROLES
    costs: Costs = Costs()
    #: Heads that cost more than this above the least can never win, and go. By roles, two insertions and the
    #: deletion of a system turn take any stack to where another's future can be followed. None keeps all.
    slack: int | None = 2 * Costs.insert + Costs.delete
    nodes: list[Stack] = field(default_factory=list)

    def __post_init__(self) -> None:
        self.automaton = Automaton(self.grammar)
        self._made: dict[tuple[int, int], Stack] = {}
        self._shifted: dict[tuple[int, str], Stack | None] = {}
        self._moves: dict[tuple[int, Kind], list] = {}
        self._steps: dict[tuple[Front, Kind], tuple[Front, int, dict[int, Back]]] = {}
        self.root = self._node(0, None)
        # All stacks there are: for a start in the middle of a sentence. Numbers are the same in every task.
        for node in self.nodes:
            for symbol in sorted({s for _, s in self.automaton.goto if s not in self.automaton.lefts}):
                self.shift(node, symbol)

    def _node(self, state: int, below: Stack | None) -> Stack:
        key = (state, -1 if below is None else below.number)
        if key not in self._made:
            self._made[key] = Stack(len(self.nodes), state, below)
            self.nodes.append(self._made[key])
        return self._made[key]

    def _reduced(self, node: Stack, lookahead: str) -> Stack | None:
        """The stack after all reductions before ``lookahead``; None once the whole sentence is reduced."""
        while (rule := self.automaton.reduction(node.state, lookahead)) is not None:
            left, right = self.automaton.rules[rule]
            for _ in right:
                node = node.below
            if left == self.automaton.start:
                return None
            node = self._node(self.automaton.goto[node.state, left], node)
        return node

    def shift(self, node: Stack, symbol: str) -> Stack | None:
        key = (node.number, symbol)
        if key not in self._shifted:
            ready = self._reduced(node, symbol)
            state = self.automaton.goto.get((ready.state, symbol))
            found = None if state is None else self._node(state, ready)
            # A finished right side can only be reduced, whatever follows: do it now, so that tops are few.
            while found is not None and len(items := self.automaton.states[found.state]) == 1:
                ((rule, dot),) = items
                left, right = self.automaton.rules[rule]
                if dot < len(right):
                    break
                for _ in right:
                    found = found.below
                found = self._node(self.automaton.goto[found.state, left], found)
            self._shifted[key] = found
        return self._shifted[key]

    def accepts(self, node: Stack) -> bool:
        return self._reduced(node, END) is None

    def _insertions(self, node: Stack) -> list[tuple[Stack, str]]:
        """Stacks that insertions lead to, with the symbols inserted; the fewest for each top."""
        found, tops, edge = [(node, "")], {node.state}, [(node, "")]
        while edge:
            longer = []
            for at, symbols in edge:
                for symbol in self.grammar.inserted:
                    to = self.shift(at, symbol)
                    if to is not None and to.state not in tops:
                        tops.add(to.state)
                        longer.append((to, symbols + symbol))
            found += longer
            edge = longer
        return found

    def moves(self, node: Stack, kind: Kind) -> list[tuple[Stack, int, str, str]]:
        """(stack, cost, edits, symbols) for each way past a row."""
        key = (node.number, kind)
        if key not in self._moves:
            own, must_go, flawed = kind
            found = [(node, self.costs.delete, "D", "")]
            for at, made in [] if must_go else self._insertions(node):
                cost = self.costs.insert * len(made) + self.costs.flawed * flawed
                for symbol in {own, *self.grammar.inserted} - {""}:
                    to = self.shift(at, symbol)
                    if to is not None:
                        kept = symbol == own
                        found.append((to, cost + self.costs.rerole * (not kept), "I" * len(made) + ("K" if kept else "R"), made + symbol))
            self._moves[key] = found
        return self._moves[key]

    def front(self, node: Stack) -> Front:
        return ((node.state, 0, 0, node.number),)

    def step(self, front: Front, kind: Kind) -> tuple[Front, int, dict[int, Back]]:
        """The front after a row, what its least cost grew by, and where each head comes from."""
        key = (front, kind)
        if key not in self._steps:
            best: dict[int, tuple] = {}
            for state, cost, rank, number in front:
                for to, more, edits, symbols in self.moves(self.nodes[number], kind):
                    found = (cost + more, rank, edits, to.number, state, symbols)
                    if to.state not in best or found[:3] < best[to.state][:3]:
                        best[to.state] = found
            least = min(b[0] for b in best.values())
            if self.slack is not None:
                best = {state: b for state, b in best.items() if b[0] - least <= self.slack}
            ranks = {r: i for i, r in enumerate(sorted({b[1:3] for b in best.values()}))}
            after = tuple((state, b[0] - least, ranks[b[1:3]], b[3]) for state, b in sorted(best.items()))
            self._steps[key] = (after, least, {state: Back(b[4], b[2], b[5]) for state, b in best.items()})
        return self._steps[key]

    def run(self, front: Front, kinds: Sequence[Kind]) -> tuple[Front, int, list[dict[int, Back]]]:
        total, trail = 0, []
        for kind in kinds:
            front, cost, back = self.step(front, kind)
            total += cost
            trail.append(back)
        return front, total, trail

    def finish(self, front: Front) -> tuple[int, int, str]:
        """(state, cost above the least, symbols inserted behind the last row) of the cheapest sentence."""
        ends = []
        for state, cost, rank, number in front:
            for node, made in self._insertions(self.nodes[number]):
                if self.accepts(node):
                    ends.append((cost + self.costs.insert * len(made), rank, "I" * len(made), state, made))
        cost, _, _, state, made = min(ends)
        return state, cost, made

    @staticmethod
    def trace(trail: list[dict[int, Back]], state: int) -> list[Back]:
        """The edits of each row on the way to ``state``."""
        way = []
        for back in reversed(trail):
            way.append(back[state])
            state = way[-1].state
        return way[::-1]
