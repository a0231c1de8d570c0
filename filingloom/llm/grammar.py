"""Cheapest edits of symbol sequences, evaluated over a grammar that the sequences share.

A symbol stands for a turn of a conversation: its role's initial and its fault. Each symbol has a transfer matrix: for
each two states of the role pattern `(s?(ua)+)?`, the least cost to lead from one to the other over the turn, with the
letters of the edits. Matrices multiply by addition and minimum; a product's letters are a rope that shares the
letters of its factors. A Re-Pair rule names a frequent pair of symbols; its matrix is computed once, bottom-up, and
serves all sequences in which the pair occurs.

Inserted turns belong to the turn after them (those at the very end are added last). So the letters of one stretch of
turns always end with the letter of a turn, none is the beginning of another, and the least of two ropes stays the least
whatever follows.
"""

from __future__ import annotations

from functools import lru_cache

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from filingloom.llm.common import Stage

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5  # costs
DROP = "d"  # a turn that must go; s, u, a, o: role by initial; in upper case: truncated as well
TERMINALS = "dsuaoSUAO"
STATES = 4  # nothing yet, after s, after u, after a
ENDS = (0, 3)
ROUNDS, RULES = 8, 32  # of the grammar, and the rules that one round adds at most; they bound its size, not what is evaluated
FIRST_RULE = 0xE000

Rope = str | tuple  # letters, or two ropes one after the other
Matrix = list  # STATES * STATES entries: None, or (cost, rope)

_INSERTED = {(0, 0): 0, (1, 1): 0, (2, 2): 0, (3, 3): 0, (0, 2): 1, (0, 3): 2, (1, 2): 1, (1, 3): 2, (2, 3): 1, (3, 2): 1}


def written(rope: Rope) -> str:
    out, todo = [], [rope]
    while todo:
        r = todo.pop()
        if isinstance(r, str):
            out.append(r)
        else:
            todo += (r[1], r[0])
    return "".join(out)


def _joined(a: Rope, b: Rope) -> Rope:
    return a + b if isinstance(a, str) and isinstance(b, str) and len(a) + len(b) <= 64 else (a, b)


def _least(options: list) -> tuple | None:
    """The cheapest of (cost, rope), of equally cheap ones that with the least letters."""
    if not options:
        return None
    cost = min(o[0] for o in options)
    best = [o for o in options if o[0] == cost]
    return best[0] if len(best) == 1 else min(best, key=lambda o: written(o[1]))


def terminal(symbol: str) -> Matrix:
    edits = [(k, k, DELETE, "D") for k in range(STATES)]
    if symbol != DROP:
        extra, role = TRUNCATED * symbol.isupper(), symbol.lower()
        steps = {"s": [(0, 1)], "u": [(0, 2), (1, 2), (3, 2)], "a": [(2, 3)], "o": []}
        edits += [(k, j, KEEP + extra, "K") for k, j in steps[role]]
        edits += [(k, j, REROLE + extra, "R") for k, j in steps["u"] + steps["a"]]
    return [
        _least([(INSERT * n + cost, "I" * n + letter) for (a, k), n in _INSERTED.items() if a == i for b, j, cost, letter in edits if (b, j) == (k, to)])
        for i in range(STATES) for to in range(STATES)
    ]


def product(a: Matrix, b: Matrix) -> Matrix:
    out = []
    for i in range(STATES):
        row = a[i * STATES : (i + 1) * STATES]
        for j in range(STATES):
            out.append(_least([(x[0] + y[0], _joined(x[1], y[1])) for m, x in enumerate(row) if x and (y := b[m * STATES + j])]))
    return out


def finish(row: list) -> tuple[int, int, int]:
    """The state in which the last turn leaves, the number of turns inserted at the end, and the cost of all.

    row: the entries from the first state, as (cost, anything comparable that stands for the letters).
    """
    ends = [(x[0] + INSERT * n, x[1], n, k) for (k, end), n in _INSERTED.items() if end in ENDS and (x := row[k])]
    cost, _, n, k = min(ends)
    return k, n, cost


class Grammar:
    """Rules (symbol, left, right) in the order in which they were found, with a matrix for each."""

    def __init__(self, rules: list[tuple[str, str, str]]) -> None:
        self.rules = rules
        self.matrices = {t: terminal(t) for t in TERMINALS}
        for symbol, left, right in rules:
            self.matrices[symbol] = product(self.matrices[left], self.matrices[right])
        self.evaluate = lru_cache(50_000)(self._evaluate)

    def __reduce__(self):
        return Grammar, (self.rules,)

    def compressed(self, symbols: str) -> str:
        for symbol, left, right in self.rules:
            symbols = symbols.replace(left + right, symbol)
        return symbols

    def _evaluate(self, symbols: str) -> Matrix:
        """The matrix of a sequence that is not empty."""
        short = self.compressed(symbols)
        matrix = self.matrices[short[0]]
        for s in short[1:]:
            matrix = product(matrix, self.matrices[s])
        return matrix


def learn(symbols: DataFrame, stage: Stage, rounds: int = ROUNDS, rules: int = RULES) -> Grammar:
    """Re-Pair over the distinct sequences in column `symbols`; each round names the most frequent pairs that do not overlap.

    Pairs are counted over all sequences, in Spark; only the `rules` most frequent reach the driver. The grammar ends when
    no pair occurs twice or after the given rounds: what it leaves unnamed is evaluated symbol by symbol.
    """
    found: list[tuple[str, str, str]] = []
    rest = stage.write(symbols.select("symbols").distinct(), "sequences")
    for _ in range(rounds):
        pairs = rest.filter("length(symbols) > 1").select(F.explode(F.expr("transform(sequence(1, length(symbols) - 1), i -> substring(symbols, i, 2))")).alias("pair"))
        top = pairs.groupBy("pair").count().filter("count > 1").orderBy(F.desc("count"), "pair").limit(rules).collect()
        named: list[tuple[str, str, str]] = []
        for r in top:
            left, right = r.pair
            if all(left != b and right != a for _, a, b in named) and not (left == right and named and any(left in x[1:] for x in named)):
                named.append((chr(FIRST_RULE + len(found) + len(named)), left, right))
        if not named:
            break
        found += named
        short = F.col("symbols")
        for symbol, left, right in named:
            short = F.replace(short, F.lit(left + right), F.lit(symbol))
        rest = stage.write(rest.select(short.alias("symbols")), "sequences")
    stage.release("sequences")
    return Grammar(found)
