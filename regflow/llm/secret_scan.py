"""Secret scan with one combined deterministic automaton for all rules.

The rule patterns become nondeterministic automata over bytes; subset construction joins the
mirrored automata of all rules into one deterministic automaton, which is minimised and laid
out as one flat transition array. One pass from the last byte of a text to the first feeds
that array and marks, for every rule at once, each byte where a match can start. From the
leftmost such byte that is free, the rule's own forward automaton gives the longest match.
That is leftmost-longest and non-overlapping for each kind, in time linear in the text as
long as matches do not overlap each other.
"""

from __future__ import annotations

import hashlib
from array import array
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from re import _constants as sre
from re import _parser as sre_parser

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from regflow.llm.common import ids_and_texts, pieces
from regflow.session import ship_by_value

ship_by_value(__name__)


@dataclass(frozen=True)
class Rule:
    """A match is `lead` then `value`; it fails, and its bytes stay used, when the whole is
    shorter than `least` bytes or the value shorter than `least_value`."""

    kind: str
    lead: str
    value: str
    least: int = 0
    least_value: int = 0


# The base rules. A hex match of 24 characters or more is the only kind whose
# length is part of the pattern; as runs are maximal, that finds the same spans.
BASE_RULES = (
    Rule(
        "assign",
        r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?""",
        r"[A-Za-z0-9+/_.=-]+",
        least_value=6,
    ),
    Rule("access", r"AKIA", r"[A-Z0-9]+", least=20),
    Rule("hex", r"", r"[0-9a-f]{24,}"),
)
# Further well-known credential formats, which add spans.
MORE_RULES = (
    Rule("pem", r"-----BEGIN\x20", r"[A-Z0-9\x20]*PRIVATE KEY-----"),
    Rule("github", r"gh[opsur]_", r"[A-Za-z0-9]+", least=40),
    Rule("slack", r"xox[abprs]-", r"[A-Za-z0-9-]+", least=15),
    Rule("google", r"AIza", r"[A-Za-z0-9_-]+", least=39),
    Rule("jwt", r"eyJ", r"[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+", least=40),
)
RULES = BASE_RULES + MORE_RULES


class Nfa:
    """Thompson automaton over bytes; `mirrored` reads each pattern backwards."""

    def __init__(self, mirrored: bool):
        self.mirrored = mirrored
        self.empty: list[list[int]] = []
        self.moves: list[list[tuple[frozenset[int], int]]] = []

    def state(self) -> int:
        self.empty.append([])
        self.moves.append([])
        return len(self.empty) - 1

    def add(self, pattern: str) -> tuple[int, int]:
        return self._sequence(sre_parser.parse(pattern.encode()), False)

    def _sequence(self, items, fold: bool) -> tuple[int, int]:
        first = last = self.state()
        for item in reversed(list(items)) if self.mirrored else items:
            start, end = self._item(item, fold)
            self.empty[last].append(start)
            last = end
        return first, last

    def _bytes(self, found: set[int], fold: bool) -> tuple[int, int]:
        if fold:
            found |= {b ^ 32 for b in found if chr(b & ~32).isalpha() and b < 128}
        start, end = self.state(), self.state()
        self.moves[start].append((frozenset(found), end))
        return start, end

    def _item(self, item, fold: bool) -> tuple[int, int]:
        kind, what = item
        if kind is sre.LITERAL:
            return self._bytes({what}, fold)
        if kind is sre.IN:
            found: set[int] = set()
            for inner, value in what:
                if inner is sre.LITERAL:
                    found.add(value)
                elif inner is sre.RANGE:
                    found |= set(range(value[0], value[1] + 1))
                else:
                    raise ValueError(f"a rule may not use {inner}")
            return self._bytes(found, fold)
        if kind is sre.SUBPATTERN:
            return self._sequence(what[3], fold or bool(what[1] & sre.SRE_FLAG_IGNORECASE))
        if kind is sre.BRANCH:
            start, end = self.state(), self.state()
            for branch in what[1]:
                first, last = self._sequence(branch, fold)
                self.empty[start].append(first)
                self.empty[last].append(end)
            return start, end
        if kind is sre.MAX_REPEAT:
            least, most, inner = what
            start = last = self.state()
            for _ in range(least):
                first, end = self._sequence(inner, fold)
                self.empty[last].append(first)
                last = end
            if most is sre.MAXREPEAT:
                first, end = self._sequence(inner, fold)
                after = self.state()
                self.empty[last] += [first, after]
                self.empty[end] += [first, after]
                return start, after
            after = self.state()
            for _ in range(most - least):
                first, end = self._sequence(inner, fold)
                self.empty[last] += [first, after]
                last = end
            self.empty[last].append(after)
            return start, after
        raise ValueError(f"a rule may not use {kind}")

    def closure(self, states) -> frozenset[int]:
        seen, todo = set(states), list(states)
        while todo:
            for after in self.empty[todo.pop()]:
                if after not in seen:
                    seen.add(after)
                    todo.append(after)
        return frozenset(seen)


@dataclass(frozen=True)
class Dfa:
    """Transition array: the state after `byte` in `state` is `step[state + byte]`, where
    states are multiples of 256. `accepts` maps the accepting states, which are those from
    `floor` on, to the rules they accept. State 0 is the start; `dead` (or -1) has no way on."""

    step: array
    floor: int
    accepts: dict[int, tuple[int, ...]]
    dead: int


def determinise(nfa: Nfa, starts: list[int], ends: dict[int, int], anywhere: bool) -> Dfa:
    """Subset construction over byte classes, then minimisation by partition refinement."""
    masks = {m for moves in nfa.moves for m, _ in moves}
    by_class: dict[tuple, list[int]] = defaultdict(list)
    for byte in range(256):
        by_class[tuple(byte in m for m in masks)].append(byte)
    classes = list(by_class.values())
    first = nfa.closure(starts)
    number, order, table = {first: 0}, [first], []
    for states in order:
        row = []
        for members in classes:
            after = {t for s in states for m, t in nfa.moves[s] if members[0] in m}
            target = nfa.closure(after | set(starts) if anywhere else after)
            if target not in number:
                number[target] = len(order)
                order.append(target)
            row.append(number[target])
        table.append(row)
    rules = [tuple(sorted({ends[s] for s in states if s in ends})) for states in order]
    block = [sorted(set(rules)).index(r) for r in rules]
    while True:
        signature = [(block[i], *(block[t] for t in row)) for i, row in enumerate(table)]
        names: dict[tuple, int] = {}
        refined = [names.setdefault(s, len(names)) for s in signature]
        if len(names) == len(set(block)):
            break
        block = refined
    sample = {b: i for i, b in reversed(list(enumerate(block)))}
    plain = [b for b in sample if not rules[sample[b]]]
    final = [b for b in sample if rules[sample[b]]]
    plain.sort(key=lambda b: b != block[0])
    place = {b: i * 256 for i, b in enumerate(plain + final)}
    if place[block[0]] != 0:
        raise ValueError("a rule matches the empty text")
    step = array("l", [0]) * (256 * len(place))
    for b, at in place.items():
        for members, target in zip(classes, table[sample[b]], strict=True):
            for byte in members:
                step[at + byte] = place[block[target]]
    dead = number.get(frozenset(), -1)
    return Dfa(
        step,
        256 * len(plain),
        {place[b]: rules[sample[b]] for b in final},
        place[block[dead]] if dead >= 0 else -1,
    )


@dataclass(frozen=True)
class Automaton:
    rules: tuple[Rule, ...]
    starts: Dfa
    whole: tuple[Dfa, ...]
    leads: tuple[Dfa | None, ...]


def compile_rules(rules: tuple[Rule, ...] = RULES) -> Automaton:
    mirrored, starts, ends = Nfa(True), [], {}
    for i, rule in enumerate(rules):
        first, last = mirrored.add(rule.lead + rule.value)
        starts.append(first)
        ends[last] = i

    def forward(pattern: str) -> Dfa:
        nfa = Nfa(False)
        first, last = nfa.add(pattern)
        return determinise(nfa, [first], {last: 0}, anywhere=False)

    return Automaton(
        tuple(rules),
        determinise(mirrored, starts, ends, anywhere=True),
        tuple(forward(r.lead + r.value) for r in rules),
        tuple(forward(r.lead) if r.lead and r.least_value else None for r in rules),
    )


def _longest(dfa: Dfa, data: bytes, start: int) -> int:
    """The end of the longest match from `start`, or -1."""
    state, end, at, step, floor, dead = 0, -1, start, dfa.step, dfa.floor, dfa.dead
    for at in range(start, len(data)):
        state = step[state + data[at]]
        if state == dead:
            return end
        if state >= floor:
            end = at + 1
    return end


def scanner(automaton: Automaton):
    """A function from bytes to spans (start, rule number, end), in bytes."""
    rules, dfa = automaton.rules, automaton.starts
    step, floor, accepts = list(dfa.step), dfa.floor, dfa.accepts

    def scan(data: bytes) -> list[tuple[int, int, int]]:
        marks = []
        state, at = 0, len(data)
        for byte in reversed(data):
            at -= 1
            state = step[state + byte]
            if state >= floor:
                marks.append((at, state))
        spans, free = [], [0] * len(rules)
        for start, state in reversed(marks):
            for number in accepts[state]:
                if start < free[number]:
                    continue
                rule, end = rules[number], _longest(automaton.whole[number], data, start)
                free[number] = end
                if end - start < rule.least:
                    continue
                if rule.least_value:
                    lead = automaton.leads[number]
                    begun = _longest(lead, data, start) if lead else start
                    if end - begun < rule.least_value:
                        continue
                spans.append((start, number, end))
        spans.sort()
        return spans

    return scan


def code_points(text: str, data: bytes, spans: list[tuple[int, int, int]]):
    """Byte offsets to code points, reading the text once."""
    if len(text) == len(data):
        return spans
    places, at, count = {0: 0}, 0, 0
    for offset in sorted({x for s, _, e in spans for x in (s, e)}):
        count += len(data[at:offset].decode("utf-8", "surrogatepass"))
        places[offset], at = count, offset
    return [(places[s], number, places[e]) for s, number, e in spans]


_FOUND = "id long, spans array<struct<kind:string,start:int,end:int>>"


def find_secrets(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    rules: tuple[Rule, ...] = RULES,
) -> DataFrame:
    """One row per document: id and all spans (kind, start, end) in code points, end exclusive,
    by start and then by the order of the rules.

    A null or empty text has no spans; a null id stays null; repeated rows each give a row.
    Keywords match letters A-Z in either case and no other letters. Texts of any length are
    read whole; a task holds a few MB of text and the longest text.
    """
    automaton = compile_rules(rules)
    names = [r.kind for r in rules]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scan = scanner(automaton)
        kind = pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())])
        for batch in pieces(batches):
            found = []
            for text in batch.column("text").to_pylist():
                data = text.encode("utf-8", "surrogatepass")
                spans = code_points(text, data, scan(data))
                found.append([{"kind": names[k], "start": s, "end": e} for s, k, e in spans])
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(found, pa.list_(kind))], names=["id", "spans"]
            )

    return ids_and_texts(docs, id_col, text_col).mapInArrow(run, _FOUND)


def span_text(spans):
    """Spans as kind:start:end, comma-joined."""
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ","
    )


def digest_of(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()
