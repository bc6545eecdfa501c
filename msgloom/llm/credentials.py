"""Secret scans by grammar inference.

Credentials that the base patterns find are labelled by their pattern. Spark counts the prefixes
of all different values of a label, written as character classes. From the most frequent ones a
prefix tree is built, and states whose statistics agree are merged (Hoeffding test) into an
automaton; its probabilities are counted over all values. One more automaton learns ordinary
tokens in the same way, without those that a format explains better: at first better than a chain of
character classes, then better than the ordinary automaton of the round before. So bare values of a format
don't teach it to the ordinary automaton. Every run of credential characters in every text is scored: bits per
character by which the best format is likelier than ordinary tokens. Runs above the format's threshold are added.

Null texts are empty. A corpus without labelled credentials has base spans only (none). Rows
are scanned one by one, so repeated rows give repeated results.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from msgloom.llm.common import stored

# fixed values: the base patterns, in the order in which their kinds are listed
ASSIGN = r"(?ai)(?:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"(?<![0-9a-f])[0-9a-f]{16,}"
KINDS = ("assign", "access", "hex", "likely")
MIN_VALUE, MIN_ACCESS = 12, 18
RUN = r"[A-Za-z0-9+/_.=-]{12,}"
#: Inner nodes of a label's prefix tree, the most frequent prefixes; their other continuations are leaves.
NODES = 3_000
#: Longer prefixes are not in the tree.
TRAIN_LENGTH = 200
CONFIDENCE = 0.05
#: Leaves of the cut tree with so many visits stay states of their own, as nothing is known of their moves.
MIN_VISITS = 20
#: Share of a label's own values that may score below its threshold, and the least threshold in bits.
MISSED, LEAST_BITS = 0.05, 0.5
#: Rounds in which ordinary tokens are told from bare values; bits by which a format must beat the ordinary
#: automaton for one (the chain: at all, as the next round takes back what ordinary tokens explain).
ROUNDS, ODDS = 2, 6.0
#: Gains are counted in bins of 1 / BINS bits.
BINS = 256
UNSEEN = 1e-4
MEMO = 100_000

Span = tuple[int, int, str]


def symbol(char: str) -> str:
    """Character class: digits, letters by case with a-f apart, other characters as they are."""
    if "0" <= char <= "9":
        return "0"
    if "a" <= char <= "z":
        return "a" if char <= "f" else "g"
    if "A" <= char <= "Z":
        return "A" if char <= "F" else "G"
    return char


CLASSES = {ord(c): symbol(c) for c in map(chr, range(128))}


class Base:
    """The base patterns, compiled once in a task."""

    def __init__(self):
        self.assign, self.access, self.hex = re.compile(ASSIGN), re.compile(ACCESS), re.compile(HEX)

    def __call__(self, text: str) -> list[tuple[int, int, str, str]]:
        """(start, end, kind, value), by start, then kind as listed."""
        found = [
            (m.start(), 0, m.end(), m[1])
            for m in self.assign.finditer(text)
            if len(m[1]) >= MIN_VALUE
        ]
        if "AKIA" in text:
            found += [(m.start(), 1, m.end(), m[0]) for m in self.access.finditer(text) if m.end() - m.start() >= MIN_ACCESS]
        found += [(m.start(), 2, m.end(), m[0]) for m in self.hex.finditer(text)]
        return [(start, end, KINDS[kind], value) for start, kind, end, value in sorted(found)]


def runs(text: str, taken: list[tuple[int, int]], pattern: re.Pattern) -> Iterator[tuple[int, int, str]]:
    """Runs of credential characters that no base span (sorted) touches, without end punctuation."""
    at = 0
    for m in pattern.finditer(text):
        while at < len(taken) and taken[at][1] <= m.start():
            at += 1
        value = m[0].rstrip("./-_+=")
        touched = any(a < m.end() and b > m.start() for a, b in taken[at : at + 8])
        if not touched and len(value) >= MIN_VALUE:
            yield m.start(), m.start() + len(value), value


class Automaton:
    """A probabilistic automaton inferred by merging the compatible states of a prefix tree.

    visits, ends: by state. moves: by state, symbol -> (state, times).
    """

    def __init__(self, words: list[str]):
        prefixes, ends = Counter(), Counter(words)
        for word, times in ends.items():
            for n in range(len(word) + 1):
                prefixes[word[:n]] += times
        self._build([(prefix, n, ends[prefix], True) for prefix, n in prefixes.items()])

    @classmethod
    def of_nodes(cls, nodes: list[tuple[str, int, int, bool]]) -> Automaton:
        """From (prefix, visits, ends, whether its moves are known); parents of nodes are nodes."""
        made = cls.__new__(cls)
        made._build(nodes)
        return made

    @classmethod
    def chain(cls, symbols: list[str]) -> Automaton:
        """A state for each symbol, reached by it from everywhere; it can't hold a format by heart."""
        made = cls.of_nodes([("", 0, 0, True)])
        to = {s: i + 1 for i, s in enumerate(symbols)}
        made.states = list(range(len(symbols) + 1))
        made.visits, made.ends = [0] * len(made.states), [0] * len(made.states)
        made.moves = [{s: [i, 0] for s, i in to.items()} for _ in made.states]
        made._settle()
        return made

    def _build(self, nodes: list[tuple[str, int, int, bool]]) -> None:
        self.visits, self.ends = [0], [0]
        self.moves: list[dict[str, list[int]]] = [{}]
        self.open, number = set(), {"": 0}
        for prefix, n, ends, known in sorted(nodes, key=lambda x: (len(x[0]), x[0])):
            state = number.get(prefix)
            if state is None:
                state = number[prefix] = len(self.visits)
                self.visits.append(0)
                self.ends.append(0)
                self.moves.append({})
                self.moves[number[prefix[:-1]]][prefix[-1]] = [state, n]
            self.visits[state], self.ends[state] = n, ends
            if not known and n > ends:
                self.open.add(state)
        self._merge()
        self._settle()

    def _apart(self, a: int, n: int, b: int, m: int) -> bool:
        bound = math.sqrt(0.5 * math.log(2 / CONFIDENCE)) * (1 / math.sqrt(n) + 1 / math.sqrt(m))
        return abs(a / n - b / m) > bound

    def _compatible(self, red: int, blue: int) -> bool:
        todo = [(red, blue)]
        while todo:
            a, b = todo.pop()
            n, m = self.visits[a], self.visits[b]
            if self._apart(self.ends[a], n, self.ends[b], m):
                return False
            if a in self.open or b in self.open:
                continue
            for s in self.moves[a].keys() | self.moves[b].keys():
                x, y = self.moves[a].get(s), self.moves[b].get(s)
                if self._apart(x[1] if x else 0, n, y[1] if y else 0, m):
                    return False
                if x and y:
                    todo.append((x[0], y[0]))
        return True

    def _fold(self, red: int, blue: int) -> None:
        todo = [(red, blue)]
        while todo:
            a, b = todo.pop()
            if a == b:
                continue
            self.visits[a] += self.visits[b]
            self.ends[a] += self.ends[b]
            if self.moves[b]:
                self.open.discard(a)
            for s, (to, times) in self.moves[b].items():
                if s in self.moves[a]:
                    self.moves[a][s][1] += times
                    todo.append((self.moves[a][s][0], to))
                else:
                    self.moves[a][s] = [to, times]

    def _merge(self) -> None:
        red, alone = [0], []
        while True:
            settled = {*red, *alone}
            border = [(self.visits[m[0]], r, s) for r in [*red, *alone] for s, m in self.moves[r].items() if m[0] not in settled]
            if not border:
                break
            _, parent, s = max(border, key=lambda x: (x[0], -x[1], x[2]))
            blue = self.moves[parent][s][0]
            if blue in self.open and self.visits[blue] >= MIN_VISITS:
                alone.append(blue)
                continue
            for r in red:
                if self._compatible(r, blue):
                    self.moves[parent][s][0] = r
                    self._fold(r, blue)
                    break
            else:
                red.append(blue)
        self.states = red + alone

    def count(self, word: str, times: int, counts: Counter) -> None:
        """Add the moves of a word, (state, symbol), and its end, (state, ""); a move that is missing stays."""
        state = 0
        for s in word:
            counts[state, s] += times
            move = self.moves[state].get(s)
            state = move[0] if move else state
        counts[state, ""] += times

    def recount(self, counts: dict[tuple[int, str], int]) -> None:
        """Take the probabilities from the counts of all words."""
        for state in self.states:
            to = {s: m[0] for s, m in self.moves[state].items()}
            self.moves[state], self.visits[state], self.ends[state] = {s: [t, 0] for s, t in to.items()}, 0, 0
        for (state, s), times in counts.items():
            self.visits[state] += times
            if s:
                self.moves[state].setdefault(s, [state, 0])[1] += times
            else:
                self.ends[state] += times
        self._settle()

    def _settle(self) -> None:
        """Bits of each move and end, for scoring."""
        self.bits: dict[int, dict[str, tuple[int, float]]] = {}
        self.stop: dict[int, float] = {}
        for state in self.states:
            n = max(1, self.visits[state])
            self.bits[state] = {s: (to, math.log2(max(times / n, UNSEEN))) for s, (to, times) in self.moves[state].items()}
            self.stop[state] = math.log2(max(self.ends[state] / n, UNSEEN))

    def score(self, word: str) -> float:
        """log2 of the word's probability; a move that was never seen costs UNSEEN and stays."""
        state, total, unseen = 0, 0.0, math.log2(UNSEEN)
        bits = self.bits
        for s in word:
            move = bits[state].get(s)
            if move is None:
                total += unseen
            else:
                state, cost = move
                total += cost
        return total + self.stop[state]


class Grammar:
    """Automata of the labels and of ordinary tokens, with a threshold for each label."""

    def __init__(self, formats: dict[str, Automaton], ordinary: Automaton):
        self.formats, self.ordinary, self.least = formats, ordinary, dict.fromkeys(formats, LEAST_BITS)

    def gain(self, format: Automaton, word: str) -> float:
        return (format.score(word) - self.ordinary.score(word)) / (len(word) + 1)

    def likely(self, value: str) -> bool:
        """Whether the value is a word of one of the formats rather than an ordinary token."""
        word = value.translate(CLASSES)
        return any(self.gain(format, word) >= self.least[kind] for kind, format in self.formats.items())


def shapes(docs: DataFrame) -> DataFrame:
    """Stored (kind, shape, n): how many different values of a label, or ordinary tokens (kind ""), have a shape."""

    def collect(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        find, pattern = Base(), re.compile(RUN)
        for batch in batches:
            rows = set()
            for text in batch["text"]:
                base = find(text or "")
                rows.update((kind, value) for _, _, kind, value in base)
                rows.update(("", v) for _, _, v in runs(text or "", [s[:2] for s in base], pattern))
            yield pd.DataFrame(sorted(rows), columns=["kind", "value"])

    values = docs.select("text").mapInPandas(collect, "kind string, value string").distinct()
    chars = [chr(c) for c in CLASSES if symbol(chr(c)) != chr(c)]
    shape = F.translate("value", "".join(chars), "".join(map(symbol, chars))).alias("shape")
    return stored(values.select("kind", shape).groupBy("kind", "shape").agg(F.count("*").alias("n")), "shapes")


def _tree(nodes: DataFrame, size: int) -> list[tuple[str, int, int, bool]]:
    """The `size` most frequent prefixes and the prefixes that are one symbol longer."""
    top = nodes.orderBy(F.desc("n"), F.length("prefix"), "prefix").limit(size)
    inner = {r["prefix"]: (r["n"], r["ends"]) for r in top.collect()}
    parent = F.left("prefix", F.length("prefix") - 1)
    below = nodes.filter("prefix <> ''").join(F.broadcast(top.select(F.col("prefix").alias("_up"))), parent == F.col("_up"))
    leaves = {r["prefix"]: (r["n"], r["ends"]) for r in below.select("prefix", "n", "ends").collect()}
    return [(prefix, n, ends, prefix in inner) for prefix, (n, ends) in (leaves | inner).items()]


def _counted(found: DataFrame, machines: dict[str, Automaton]) -> dict[str, Automaton]:
    """The machines with probabilities from all shapes of their kind."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counts = {kind: Counter() for kind in machines}
        for batch in batches:
            for kind, shape, n in zip(batch["kind"], batch["shape"], batch["n"].tolist(), strict=True):
                machines[kind].count(shape, n, counts[kind])
        rows = [(kind, state, s, n) for kind, own in counts.items() for (state, s), n in own.items()]
        yield pd.DataFrame(rows, columns=["kind", "state", "symbol", "n"])

    counted = found.mapInPandas(count, "kind string, state int, symbol string, n long").groupBy("kind", "state", "symbol")
    every = {kind: {} for kind in machines}
    for r in counted.agg(F.sum("n").alias("n")).orderBy("kind", "state", "symbol").collect():
        every[r["kind"]][r["state"], r["symbol"]] = r["n"]
    for kind, machine in machines.items():
        machine.recount(every[kind])
    return machines


def _inferred(found: DataFrame, kinds: tuple[str, ...], size: int, length: int) -> dict[str, Automaton]:
    """The automaton of each kind that has shapes."""
    cut = F.left("shape", F.lit(length))
    each = found.select("kind", "shape", "n", F.explode(F.sequence(F.lit(0), F.length(cut))).alias("d"))
    ends = F.sum(F.when(F.col("d") == F.length("shape"), F.col("n")).otherwise(0)).alias("ends")
    nodes = each.groupBy("kind", F.left("shape", F.col("d")).alias("prefix")).agg(F.sum("n").alias("n"), ends)
    nodes = stored(nodes, "prefixes")
    machines = {kind: Automaton.of_nodes(tree) for kind in kinds if (tree := _tree(nodes.filter(F.col("kind") == kind), size))}
    return _counted(found, machines)


def _kept(plain: DataFrame, formats: dict[str, Automaton], ordinary: Automaton, odds: float) -> DataFrame:
    """Stored shapes that no format explains better by `odds` bits than ordinary tokens do."""

    def keep(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            fits = [max(f.score(w) for f in formats.values()) <= ordinary.score(w) + odds for w in batch["shape"]]
            yield batch[pd.Series(fits, index=batch.index, dtype=bool)]

    return stored(plain.mapInPandas(keep, plain.schema), "ordinary")


def train(docs: DataFrame, size: int = NODES, length: int = TRAIN_LENGTH, rounds: int = ROUNDS) -> Grammar | None:
    """Infer from the labelled credentials and ordinary tokens of all texts.

    size: inner nodes of a prefix tree; length: longest prefix in it; rounds: how often the
    ordinary tokens are told from bare values of a format (0: all unlabelled tokens are ordinary).
    """
    found = shapes(docs)
    labelled, plain = found.filter("kind <> ''"), found.filter("kind = ''")
    machines = _inferred(labelled, KINDS[:3], size, length)
    if not machines:
        return None
    kept, symbols = plain, sorted({symbol(chr(c)) for c in CLASSES if re.match(r"[A-Za-z0-9+/_.=-]", chr(c))})
    ordinary = _counted(plain, {"": Automaton.chain(symbols)})[""]
    for turn in range(max(1, rounds)):
        if rounds:
            kept = _kept(plain, machines, ordinary, ODDS if turn else 0.0)
        ordinary = _inferred(kept, ("",), size, length).get("") or Automaton([])
    grammar = Grammar(machines, ordinary)

    def gains(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            made = [math.floor(grammar.gain(grammar.formats[k], w) * BINS) for k, w in zip(batch["kind"], batch["shape"], strict=True)]
            yield pd.DataFrame({"kind": batch["kind"], "gain": made, "n": batch["n"]})

    gained = labelled.mapInPandas(gains, "kind string, gain long, n long")
    bins = gained.groupBy("kind", "gain").agg(F.sum("n").alias("n")).orderBy("kind", "gain").collect()
    for kind in machines:
        own = [(r["gain"], r["n"]) for r in bins if r["kind"] == kind]
        total, until = sum(n for _, n in own), 0
        for gain, n in own:
            until += n
            if until > MISSED * total:
                grammar.least[kind] = max(LEAST_BITS, gain / BINS)
                break
    return grammar


def _joined(spans: list[Span]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for start, end, kind in spans)


def secrets(docs: DataFrame, size: int = NODES, length: int = TRAIN_LENGTH, rounds: int = ROUNDS) -> DataFrame:
    """(doc_id, n_assign, n_access, n_hex, base_sha256, spans) of every row of docs (doc_id, text)."""
    grammar = train(docs, size, length, rounds)
    names = ["n_assign", "n_access", "n_hex", "base_sha256", "spans"]

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        find, pattern, memo = Base(), re.compile(RUN), {}
        for batch in batches:
            rows = []
            for text in batch["text"]:
                text = text or ""
                base = [s[:3] for s in find(text)]
                every = list(base)
                if grammar is not None:
                    for start, end, value in runs(text, [s[:2] for s in base], pattern):
                        known = memo.get(value)
                        if known is None:
                            if len(memo) >= MEMO:
                                memo.clear()
                            known = memo[value] = grammar.likely(value)
                        if known:
                            every.append((start, end, "likely"))
                every.sort(key=lambda s: (s[0], KINDS.index(s[2])))
                kinds = [kind for _, _, kind in base]
                digest = hashlib.sha256(_joined(base).encode()).hexdigest()
                rows.append((*(kinds.count(k) for k in KINDS[:3]), digest, _joined(every)))
            made = pd.DataFrame(rows, columns=names)
            made.insert(0, "doc_id", batch["doc_id"].to_numpy())
            yield made

    schema = "doc_id string, n_assign long, n_access long, n_hex long, base_sha256 string, spans string"
    made = docs.select(F.col("doc_id").cast("string").alias("doc_id"), "text").mapInPandas(scan, schema)
    return made.withColumn("doc_id", F.col("doc_id").cast(docs.schema["doc_id"].dataType))
