"""Secret scans with one combined deterministic automaton.

All rules are compiled together: each regex becomes a nondeterministic automaton of its reversed
language behind `.*`, the union is made deterministic by subset construction over byte classes and
minimised by partition refinement. One pass over the bytes of a text, from its end to its start,
then yields for every rule exactly the places where a match of that rule begins, and a small
anchored automaton per rule runs from the leftmost of them to the longest end. That gives leftmost,
non-overlapping matches per rule in linear time, whatever the text.

Defined results: a null or empty text has no spans; repeated rows each get their own spans; other
columns are kept, one named spans is replaced; an empty table gives no rows.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator
from dataclasses import dataclass
from re import _constants as K
from re import _parser as grammar

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Rule:
    """`value_min`: characters from the one that first completes a match to the match's end."""

    kind: str
    pattern: str
    value_min: int = 1


# The base kinds in their order. A match of hex is a whole run, so its length can be
# part of the pattern; the other two are matched first and dropped afterwards when too short.
BASE = (
    Rule(
        "assign",
        r"""(?:[pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|"""
        r"""[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])["']?\x20*[:=]\x20*["']?[A-Za-z0-9+/_.=-]+""",
        8,
    ),
    Rule("access", r"AKIA[A-Z0-9]+", 12),
    Rule("hex", r"[0-9a-f]{32,}"),
)
# Further kinds: well-known public key formats.
MORE = (
    Rule("private_key", r"-----BEGIN (?:[A-Z]+ )*PRIVATE KEY-----"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+", 16),
    Rule("github", r"gh[oprsu]_[A-Za-z0-9]+", 36),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]+", 20),
    Rule("google", r"AIza[A-Za-z0-9_-]+", 35),
)
RULES = BASE + MORE


class Nfa:
    """Byte automaton: `step[state]` lists (byte set, target), `free[state]` the empty moves."""

    def __init__(self) -> None:
        self.step: list[list[tuple[frozenset[int], int]]] = []
        self.free: list[list[int]] = []

    def state(self) -> int:
        self.step.append([])
        self.free.append([])
        return len(self.step) - 1

    def add(self, items, start: int, backward: bool) -> int:
        """Append the parsed items behind `start`; returns the end state."""
        for op, arg in reversed(list(items)) if backward else items:
            start = self._one(op, arg, start, backward)
        return start

    def _one(self, op, arg, start: int, backward: bool) -> int:
        if op in (K.LITERAL, K.IN):
            end = self.state()
            self.step[start].append((_byte_set(op, arg), end))
            return end
        if op is K.SUBPATTERN:
            return self.add(arg[-1], start, backward)
        if op is K.BRANCH:
            end = self.state()
            for branch in arg[1]:
                self.free[self.add(branch, start, backward)].append(end)
            return end
        if op is K.MAX_REPEAT:
            least, most, items = arg
            for _ in range(least):
                start = self.add(items, start, backward)
            if most is K.MAXREPEAT:
                loop = self.state()
                self.free[start].append(loop)
                self.free[self.add(items, loop, backward)].append(loop)
                return loop
            ends = [start]
            for _ in range(most - least):
                ends.append(self.add(items, ends[-1], backward))
            for end in ends[:-1]:
                self.free[end].append(ends[-1])
            return ends[-1]
        raise ValueError(f"not supported in a rule: {op}")

    def closure(self, states) -> frozenset[int]:
        found, todo = set(states), list(states)
        while todo:
            for s in self.free[todo.pop()]:
                if s not in found:
                    found.add(s)
                    todo.append(s)
        return frozenset(found)


def _byte_set(op, arg) -> frozenset[int]:
    if op is K.LITERAL:
        return frozenset([arg])
    found: set[int] = set()
    for kind, value in arg:
        if kind is K.LITERAL:
            found.add(value)
        elif kind is K.RANGE:
            found.update(range(value[0], value[1] + 1))
        else:
            raise ValueError(f"not supported in a class: {kind}")
    return frozenset(found)


@dataclass
class Dfa:
    """`table[state * n_classes + class]` is the next state times n_classes; states from
    `first_accept` on accept, with the bit set of their rules in `rules`."""

    classes: bytes
    n_classes: int
    table: list[int]
    start: int
    first_accept: int
    rules: list[int]
    dead: int  # the state that nothing leaves and that does not accept, or -1


def determinise(nfa: Nfa, start: list[int], accepts: dict[int, int]) -> Dfa:
    """Subset construction over byte classes, then minimisation."""
    sets = list(dict.fromkeys(s for steps in nfa.step for s, _ in steps))
    signature = [tuple(b in s for s in sets) for b in range(256)]
    numbers = {sig: n for n, sig in enumerate(dict.fromkeys(signature))}
    classes = bytes(numbers[sig] for sig in signature)
    member = [next(b for b in range(256) if classes[b] == c) for c in range(len(numbers))]
    first = nfa.closure(start)
    seen, rows, todo = {first: 0}, [], [first]
    for subset in todo:
        row = []
        for byte in member:
            to = nfa.closure({t for s in subset for allowed, t in nfa.step[s] if byte in allowed})
            if to not in seen:
                seen[to] = len(seen)
                todo.append(to)
            row.append(seen[to])
        rows.append(row)
    masks = [functools.reduce(lambda m, s: m | accepts.get(s, 0), subset, 0) for subset in todo]
    return _minimise(rows, masks, classes)


def _minimise(rows: list[list[int]], masks: list[int], classes: bytes) -> Dfa:
    """Split states by what they accept, then by the parts their moves lead to, until stable."""
    import numpy as np

    moves = np.array(rows)
    part = np.unique(masks, return_inverse=True)[1]
    while True:
        finer = np.unique(np.column_stack((part, part[moves])), axis=0, return_inverse=True)[1].ravel()
        if finer.max() == part.max():
            break
        part = finer
    n, width = int(part.max()) + 1, moves.shape[1]
    one = np.zeros(n, int)
    one[part] = np.arange(len(part))
    order = sorted(range(n), key=lambda p: bool(masks[one[p]]))
    place = {p: i for i, p in enumerate(order)}
    table = [place[int(part[t])] * width for p in order for t in moves[one[p]]]
    accept = [masks[one[p]] for p in order]
    closed = (i for i in range(n) if not accept[i] and set(table[i * width : (i + 1) * width]) == {i * width})
    dead = next(closed, -1) * width
    return Dfa(classes, width, table, place[int(part[0])] * width, accept.count(0) * width, accept, dead)


@dataclass
class Scanner:
    """The combined backward automaton and one anchored forward automaton per rule."""

    kinds: list[str]
    value_min: list[int]
    starts: Dfa
    ends: list[Dfa]

    def scan(self, data: bytes) -> list[tuple[int, int, int]]:
        """(start, rule number, end) in bytes, by start and rule order."""
        begin: list[list[int]] = [[] for _ in self.kinds]
        dfa = self.starts
        table, state, accept, width = dfa.table, dfa.start, dfa.first_accept, dfa.n_classes
        for back, c in enumerate(data.translate(dfa.classes)[::-1], 1):
            state = table[state + c]
            if state >= accept:
                mask = dfa.rules[state // width]
                for rule in range(len(begin)):
                    if mask >> rule & 1:
                        begin[rule].append(len(data) - back)
        spans = []
        for rule, places in enumerate(begin):
            behind = 0
            for start in reversed(places):
                if start >= behind:
                    first, behind = self._longest(self.ends[rule], data, start)
                    if behind - first + 1 >= self.value_min[rule]:
                        spans.append((start, rule, behind))
        return sorted(spans)

    @staticmethod
    def _longest(dfa: Dfa, data: bytes, start: int) -> tuple[int, int]:
        """Ends of the shortest and the longest match that begin at `start`."""
        state, first, last = dfa.start, 0, 0
        for at in range(start, len(data)):
            state = dfa.table[state + dfa.classes[data[at]]]
            if state >= dfa.first_accept:
                first, last = first or at + 1, at + 1
            elif state == dfa.dead:
                break
        return first, last


def compile_rules(rules: tuple[Rule, ...] = RULES) -> Scanner:
    nfa, accepts = Nfa(), {}
    root = nfa.state()
    nfa.step[root].append((frozenset(range(256)), root))
    ends = []
    for number, rule in enumerate(rules):
        parsed = grammar.parse(rule.pattern)
        accepts[nfa.add(parsed, root, True)] = 1 << number
        anchored = Nfa()
        begin = anchored.state()
        accept = {anchored.add(parsed, begin, False): 1}
        ends.append(determinise(anchored, [begin], accept))
    return Scanner(
        [r.kind for r in rules], [r.value_min for r in rules], determinise(nfa, [root], accepts), ends
    )


def find_secrets(docs: DataFrame, rules: tuple[Rule, ...] = RULES, text: str = "text") -> DataFrame:
    """Add spans, (kind, start, end) in code points by start and rule order, to every row."""
    shared = docs.sparkSession.sparkContext.broadcast(compile_rules(rules))

    @F.arrow_udf("array<struct<kind:string,start:long,end:long>>")
    def scan(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        import pyarrow as pa

        span = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])
        scanner = shared.value
        for texts in batches:
            rows = []
            for text in texts:
                data = (text.as_py() or "").encode()
                found = scanner.scan(data)
                if found and not data.isascii():
                    found = _code_points(data, found)
                rows.append([{"kind": scanner.kinds[r], "start": s, "end": e} for s, r, e in found])
            yield pa.array(rows, pa.list_(span))

    return docs.withColumn("spans", scan.asNondeterministic()(text))


def _code_points(data: bytes, spans: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Byte spans of ASCII matches to code point spans, in one pass over the text."""
    done, count, moved = 0, 0, []
    for start, rule, end in spans:
        count += len(data[done:start].decode())
        done = start
        moved.append((count, rule, count + end - start))
    return moved


def digest_of(spans: Column | str, kinds: tuple[str, ...]) -> Column:
    listed = F.filter(spans, lambda s: s["kind"].isin(*kinds))
    return F.sha2(joined(listed), 256)


def joined(spans: Column | str) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def op3_secret_dfa(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    base = tuple(r.kind for r in BASE)
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")
    return find_secrets(docs).select(
        "doc_id",
        *[count(k).alias(f"n_{k}") for k in base],
        digest_of("spans", base).alias("base_sha256"),
        joined("spans").alias("spans"),
    )
