"""Secret scan: one deterministic automaton over all rules, one pass over the bytes.

Each rule's regular expression becomes an automaton over bytes. Subset construction joins all
rules in one: a state is, for every rule, the set of places its expression may be in. A rule that
is inside a match takes no new start until the match has ended, which makes matches leftmost,
longest and non-overlapping per rule. The states are then minimised by partition refinement, and a
text is read byte by byte through the arrays of next states. Where a match has ended, the rule's
reversed automaton walks back to the start.

A null text counts as empty; an empty text has no spans. Rows that repeat are scanned each.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import cache

from pyspark.sql import DataFrame, functions as F

from shelfcast.llm.common import documents, per_text


@dataclass(frozen=True)
class Rule:
    """An expression over bytes: literals, \\x escapes, [classes], (groups|alternatives), ?, *, +, {n,}, {n}.

    Matches are dropped afterwards if they are shorter than `least`, counted from `after` the first
    of these signs (and blanks and quotes) where given. Expressions must tell their end without
    looking back, as all of RULES do.
    """

    kind: str
    pattern: str
    any_case: bool = False
    least: int = 0
    after: str = ""


# The first three kinds are given; the others are added by this scan.
BASE = ("assign", "access", "hex")
RULES = (
    Rule(
        "assign",
        r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?[A-Za-z0-9+/_.=-]+""",
        any_case=True,
        least=8,
        after=":=",
    ),
    Rule("access", r"AKIA[A-Z0-9]+", least=16),
    # The same matches as [0-9a-f]+ with the short ones dropped, without stopping at every short run.
    Rule("hex", r"[0-9a-f]{32,}"),
    Rule("github", r"gh[pousr]_[A-Za-z0-9]+", least=40),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]+", least=15),
    Rule("private_key", r"-----BEGIN\x20[A-Z\x20]*PRIVATE\x20KEY-----"),
)


# Expressions as trees: ("set", bytes), ("seq", parts), ("alt", parts), ("opt"|"star", part).


def _byte_class(body: str) -> frozenset[int]:
    out, at = set(), 0
    while at < len(body):
        low, at = _one(body, at)
        if at + 1 < len(body) and body[at] == "-":
            high, at = _one(body, at + 1)
            out |= set(range(low, high + 1))
        else:
            out.add(low)
    return frozenset(out)


def _one(text: str, at: int) -> tuple[int, int]:
    if text.startswith("\\x", at):
        return int(text[at + 2 : at + 4], 16), at + 4
    return ord(text[at]), at + 1


def _parse(text: str, any_case: bool) -> tuple:
    def letters(body: frozenset[int]) -> frozenset[int]:
        if not any_case:
            return body
        return body | {ord(chr(b).swapcase()) for b in body if b < 128 and chr(b).isalpha()}

    def choice(at: int):
        parts, at = sequence(at)
        options = [parts]
        while at < len(text) and text[at] == "|":
            parts, at = sequence(at + 1)
            options.append(parts)
        return (("alt", options) if len(options) > 1 else options[0]), at

    def sequence(at: int):
        parts = []
        while at < len(text) and text[at] not in "|)":
            if text[at] == "(":
                part, at = choice(at + 1)
                at += 1
            elif text[at] == "[":
                end = text.index("]", at + 1)
                part, at = ("set", letters(_byte_class(text[at + 1 : end]))), end + 1
            else:
                byte, at = _one(text, at)
                part = ("set", letters(frozenset([byte])))
            mark = text[at : at + 1]
            if mark and mark in "?*+":
                part = {"?": ("opt", part), "*": ("star", part), "+": ("seq", [part, ("star", part)])}[mark]
                at += 1
            elif mark == "{":
                end = text.index("}", at)
                count, comma, _ = text[at + 1 : end].partition(",")
                part = ("seq", [part] * int(count) + [("star", part)] * bool(comma))
                at = end + 1
            parts.append(part)
        return ("seq", parts), at

    return choice(0)[0]


def _reversed(tree: tuple) -> tuple:
    kind, body = tree
    if kind == "set":
        return tree
    if kind == "seq":
        return "seq", [_reversed(part) for part in reversed(body)]
    if kind == "alt":
        return "alt", [_reversed(part) for part in body]
    return kind, _reversed(body)


@dataclass
class Nfa:
    """Moves by bytes and free moves; state 0 starts, `end` accepts."""

    moves: list[list[tuple[frozenset[int], int]]] = field(default_factory=list)
    free: list[list[int]] = field(default_factory=list)
    end: int = 0

    def new(self) -> int:
        self.moves.append([])
        self.free.append([])
        return len(self.moves) - 1

    def add(self, tree: tuple, start: int) -> int:
        kind, body = tree
        if kind == "set":
            end = self.new()
            self.moves[start].append((body, end))
            return end
        if kind == "seq":
            for part in body:
                start = self.add(part, start)
            return start
        end = self.new()
        if kind == "alt":
            for part in body:
                self.free[self.add(part, start)].append(end)
            return end
        inner = self.new()
        self.free[start] += [inner, end]
        last = self.add(body, inner)
        self.free[last] += [inner, end] if kind == "star" else [end]
        return end

    def closed(self, states) -> frozenset[int]:
        seen, todo = set(), list(states)
        while todo:
            state = todo.pop()
            if state not in seen:
                seen.add(state)
                todo += self.free[state]
        return frozenset(seen)

    def step(self, states: frozenset[int], byte: int) -> frozenset[int]:
        return self.closed(to for s in states for body, to in self.moves[s] if byte in body)


def _nfa(tree: tuple) -> Nfa:
    nfa = Nfa()
    nfa.end = nfa.add(tree, nfa.new())
    return nfa


def _byte_groups(nfas: list[Nfa]) -> list[list[int]]:
    """Bytes that no rule tells apart."""
    bodies = {body for nfa in nfas for moves in nfa.moves for body, _ in moves}
    groups: dict[tuple, list[int]] = {}
    for byte in range(256):
        groups.setdefault(tuple(byte in body for body in bodies), []).append(byte)
    return list(groups.values())


@dataclass
class Automaton:
    """next[state][byte]; ends[state]: numbers of the rules with a match that ends here."""

    next: list[list[int]]
    ends: list[tuple[int, ...]]
    start: int
    quiet: int  # states below this number end no match


def _subsets(start, step, ends, groups) -> Automaton:
    numbers, order, rows = {start: 0}, [start], []
    while len(rows) < len(order):
        row = []
        for group in groups:
            to = step(order[len(rows)], group[0])
            if to not in numbers:
                numbers[to] = len(order)
                order.append(to)
            row.append(numbers[to])
        rows.append(row)
    return _minimal(rows, [ends(state) for state in order], groups)


def _minimal(rows: list[list[int]], ends: list[tuple[int, ...]], groups) -> Automaton:
    """Joins states that end the same rules and go to joined states, until nothing splits."""
    block = {e: i for i, e in enumerate(sorted(set(ends)))}
    part = [block[e] for e in ends]
    while True:
        keys: dict[tuple, int] = {}
        finer = [keys.setdefault((part[s], *(part[t] for t in rows[s])), len(keys)) for s in range(len(rows))]
        if len(keys) == len(set(part)):
            break
        part = finer
    first = {p: s for s, p in reversed(list(enumerate(part)))}
    order = sorted(first, key=lambda p: (bool(ends[first[p]]), first[p]))
    name = {p: i for i, p in enumerate(order)}
    table = []
    for p in order:
        row = [0] * 256
        for group, to in zip(groups, rows[first[p]], strict=True):
            for byte in group:
                row[byte] = name[part[to]]
        table.append(row)
    found = [ends[first[p]] for p in order]
    return Automaton(table, found, name[part[0]], sum(not e for e in found))


@dataclass
class Scanner:
    rules: tuple[Rule, ...]
    forward: Automaton
    backward: list[Automaton]

    def spans(self, data: bytes) -> list[tuple[int, int, int]]:
        """(start, end, rule number) of all matches, in bytes, by start and rule."""
        table, ends, quiet = self.forward.next, self.forward.ends, self.forward.quiet
        state, running, found, since = self.forward.start, {}, [], [0] * len(self.rules)
        for at, byte in enumerate(data, 1):
            state = table[state][byte]
            if running or state >= quiet:
                now = ends[state]
                for rule in [r for r in running if r not in now]:
                    self._close(data, rule, running.pop(rule), since, found)
                for rule in now:
                    running[rule] = at
        for rule, end in running.items():
            self._close(data, rule, end, since, found)
        return sorted(found, key=lambda span: (span[0], span[2]))

    def _close(self, data: bytes, rule: int, end: int, since: list[int], found: list) -> None:
        """Walks back from the end of a match, no further than the rule's last match."""
        back = self.backward[rule]
        state, start, at = back.start, end, end
        while at > since[rule]:
            at -= 1
            state = back.next[state][data[at]]
            if back.ends[state] == (0,):
                start = at
            elif back.ends[state] == (-1,):
                break
        since[rule] = end
        if self._long_enough(data[start:end], self.rules[rule]):
            found.append((start, end, rule))

    @staticmethod
    def _long_enough(match: bytes, rule: Rule) -> bool:
        if rule.after:
            first = min(i for i in (match.find(sign.encode()) for sign in rule.after) if i >= 0)
            match = match[first + 1 :].lstrip(b" ").lstrip(b"\"'")
        return len(match) >= rule.least


@cache
def compiled(rules: tuple[Rule, ...] = RULES) -> Scanner:
    trees = [_parse(rule.pattern, rule.any_case) for rule in rules]
    nfas = [_nfa(tree) for tree in trees]
    starts = [nfa.closed([0]) for nfa in nfas]

    def one_step(nfa, start, threads, byte):
        """Threads are sets of places in order of their starts; a match ends all later ones."""
        searching = not any(nfa.end in places for places in threads)
        out, seen = [], set()
        for places in threads:
            on = nfa.step(places, byte) - seen
            if on:
                out.append(on)
                seen |= on
            if nfa.end in on:
                return tuple(out)
        if not searching and not out:  # the match has ended before this byte
            return one_step(nfa, start, (start,), byte)
        return (*out, start - seen) if start - seen else tuple(out)

    def forward_step(state, byte):
        return tuple(one_step(n, s, t, byte) for n, s, t in zip(nfas, starts, state, strict=True))

    def forward_ends(state):
        return tuple(
            i
            for i, (nfa, threads) in enumerate(zip(nfas, state, strict=True))
            if any(nfa.end in places for places in threads)
        )

    groups = _byte_groups(nfas)
    forward = _subsets(tuple((s,) for s in starts), forward_step, forward_ends, groups)
    backward = []
    for tree in trees:
        nfa = _nfa(_reversed(tree))
        backward.append(
            _subsets(
                nfa.closed([0]),
                nfa.step,
                lambda state, nfa=nfa: (0,) if nfa.end in state else () if state else (-1,),
                _byte_groups([nfa]),
            )
        )
    return Scanner(tuple(rules), forward, backward)


def _code_points(data: bytes, spans: list[tuple[int, int, int]]) -> dict[int, int]:
    """Code points before each place where a span begins or ends, counted in one walk over the text."""
    out, last, count = {}, 0, 0
    for at in sorted({place for start, end, _ in spans for place in (start, end)}):
        count += len(data[last:at].decode())
        out[at], last = count, at
    return out


def secret_spans(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """doc_id and spans: array of (kind, start, end) in code points, by start, then by rule."""
    scanner = compiled(rules)

    def rows_of(batches):
        for batch in batches:
            out = []
            for text in batch["text"]:
                data = (text or "").encode()
                found = scanner.spans(data)
                place = _code_points(data, found)
                out.append(
                    [
                        {"kind": scanner.rules[rule].kind, "start": place[start], "end": place[end]}
                        for start, end, rule in found
                    ]
                )
            yield {"doc_id": batch["doc_id"], "spans": out}

    schema = "doc_id bigint, spans array<struct<kind:string,start:bigint,end:bigint>>"
    return per_text(docs, ["doc_id", "text"], rows_of, schema)


def redacted(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """The documents with every secret in their texts replaced by its kind in brackets.

    Spans that overlap are replaced as one, named after the first. A null text stays null;
    `n_chars` follows the new text where the table has that column. Columns keep their order.
    """
    scanner = compiled(rules)
    names = docs.columns

    def clean(text: str) -> str:
        data, out, at = text.encode(), [], 0
        for start, end, rule in scanner.spans(data):
            if start >= at:
                out += [data[at:start], f"[{scanner.rules[rule].kind}]".encode()]
            at = max(at, end)
        return b"".join([*out, data[at:]]).decode() if at else text

    def rows_of(batches):
        for batch in batches:
            yield batch | {"text": [None if t is None else clean(t) for t in batch["text"]]}

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in docs.schema)
    out = per_text(docs, names, rows_of, schema)
    if "n_chars" in names:
        length = F.length("text").cast(docs.schema["n_chars"].dataType)
        out = out.withColumn("n_chars", F.coalesce(length, "n_chars"))
    return out.select(*names)


def op2_secret_scan(spark, sf_dir: str) -> DataFrame:
    """Counts and digests of the spans in every whole text."""
    spans = secret_spans(documents(spark, sf_dir))
    base = ", ".join(f"'{kind}'" for kind in BASE)
    line = "concat(s.kind, ':', s.start, ':', s.end)"
    chosen = f"array_join(transform(filter(spans, s -> s.kind IN ({base})), s -> {line}), ',')"
    counts = [F.expr(f"cast(size(filter(spans, s -> s.kind = '{k}')) AS bigint)").alias(f"n_{k}") for k in BASE]
    return spans.select(
        "doc_id",
        *counts,
        F.sha2(F.expr(chosen), 256).alias("base_sha256"),
        F.expr(f"array_join(transform(spans, s -> {line}), ',')").alias("spans"),
    )
