"""Secret scans by grammar inference.

Base patterns find labelled credentials. From a bounded sample of them (FIT_VALUES distinct values) a prefix tree of
character classes is built for each kind, statistically compatible states are merged (Hoeffding bound), and the result is a
probabilistic automaton of that credential format. Every candidate token of every text is scored by all automata: it is a
secret if its likelihood per symbol under the best format exceeds that under an automaton of ordinary tokens by MARGIN.
Such tokens are added as spans of kind ``format``; spans of the base patterns stay.

Defined results: null text is empty text and has no span; repeated rows are scanned one by one; without labelled credentials
no span is added; an empty table gives no rows; texts of any length are scanned whole; further columns are ignored.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandlake.llm.common import materialize, text_or_empty

ASSIGN = re.compile(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
KINDS = ("assign", "access", "hex", "format")
#: Tokens that the automata score: those of 16 characters or more with a digit and a letter.
TOKEN, DIGIT, LETTER = re.compile(r"[A-Za-z0-9+/_.=-]{16,}"), re.compile(r"[0-9]"), re.compile(r"[A-Za-z]")
#: The automata are fitted on at most so many distinct texts' credentials and ordinary tokens of each kind.
FIT_ROWS, FIT_VALUES = 20_000, 3_000
ALPHA, MARGIN, MIN_COUNT = 0.05, 0.7, 8


def symbols(value: str) -> str:
    """One class for each character: digits 0, a-f a, g-z g, A-F A, G-Z G; others stand for themselves."""
    return value.translate(CLASSES)


CLASSES = str.maketrans({**{str(d): "0" for d in range(10)}, **{c: "a" if c < "g" else "g" for c in map(chr, range(97, 123))}, **{c: "A" if c < "G" else "G" for c in map(chr, range(65, 91))}})


class Automaton:
    """A probabilistic automaton: per state the number of values that pass, end, and go on with each symbol."""

    def __init__(self, values: Counter):
        self.through, self.ends, self.next = [0], [0], [{}]
        for value, n in values.items():
            state = 0
            self.through[0] += n
            for symbol in symbols(value):
                if symbol not in self.next[state]:
                    self.through.append(0)
                    self.ends.append(0)
                    self.next.append({})
                    self.next[state][symbol] = len(self.next) - 1
                state = self.next[state][symbol]
                self.through[state] += n
            self.ends[state] += n
        self.arcs = [{s: self.through[t] for s, t in arcs.items()} for arcs in self.next]
        self._merge()
        used = sorted(self._reached())
        self.size = len(used)
        alphabet = len({s for q in used for s in self.arcs[q]}) + 1
        self.logs = [None] * len(self.next)
        for q in used:
            total = self.ends[q] + sum(self.arcs[q].values()) + 0.1 * (alphabet + 1)
            self.logs[q] = ({s: math.log((n + 0.1) / total) for s, n in self.arcs[q].items()}, math.log((self.ends[q] + 0.1) / total), math.log(0.1 / total))

    def _reached(self) -> set[int]:
        seen, todo = {0}, [0]
        while todo:
            for t in self.next[todo.pop()].values():
                if t not in seen:
                    seen.add(t)
                    todo.append(t)
        return seen

    def _differs(self, n1: int, of1: int, n2: int, of2: int) -> bool:
        return abs(n1 / of1 - n2 / of2) > math.sqrt(0.5 * math.log(2 / ALPHA)) * (1 / math.sqrt(of1) + 1 / math.sqrt(of2))

    def _compatible(self, a: int, b: int) -> bool:
        """Whether the ends and arcs of two states, and of all states behind them, may come from one distribution.

        Pairs that lead to a difference are remembered until counts change, so that long formats aren't walked for every pair.
        """
        todo, seen = [(a, b)], {(a, b): None}
        while todo:
            pair = a, b = todo.pop()
            if a == b:
                continue
            of_a, of_b = (self.ends[q] + sum(self.arcs[q].values()) for q in (a, b))
            if min(of_a, of_b) < MIN_COUNT:
                continue
            if pair in self.differ or self._differs(self.ends[a], of_a, self.ends[b], of_b) or any(self._differs(self.arcs[a].get(s, 0), of_a, self.arcs[b].get(s, 0), of_b) for s in self.arcs[a].keys() | self.arcs[b].keys()):
                while pair:
                    self.differ.add(pair)
                    pair = seen[pair]
                return False
            for s in self.next[a].keys() & self.next[b].keys():
                after = self.next[a][s], self.next[b][s]
                if after not in seen:
                    seen[after] = pair
                    todo.append(after)
        return True

    def _fold(self, a: int, b: int) -> None:
        """Add the subtree b to state a."""
        self.differ.clear()
        todo = [(a, b)]
        while todo:
            a, b = todo.pop()
            self.ends[a] += self.ends[b]
            for symbol, t in self.next[b].items():
                self.arcs[a][symbol] = self.arcs[a].get(symbol, 0) + self.arcs[b][symbol]
                if symbol in self.next[a]:
                    todo.append((self.next[a][symbol], t))
                else:
                    self.next[a][symbol] = t

    def _merge(self) -> None:
        self.differ: set[tuple[int, int]] = set()
        red, known = [0], {0}
        blue = [(0, s, t) for s, t in sorted(self.next[0].items())]
        while blue:
            source, symbol, state = blue.pop(0)
            if self.next[source].get(symbol) != state or state in known:
                continue
            for q in red:
                if self._compatible(q, state):
                    self.next[source][symbol] = q
                    self._fold(q, state)
                    break
            else:
                red.append(state)
                known.add(state)
            blue = [(q, s, t) for q in red for s, t in sorted(self.next[q].items()) if t not in known]

    def likelihood(self, value: str) -> float:
        """Log likelihood of the value with its end, per symbol."""
        state, total, other = 0, 0.0, 0
        for symbol in symbols(value):
            arcs, _, unseen = self.logs[state]
            total += arcs.get(symbol, unseen)
            state = self.next[state].get(symbol)
            if state is None:  # off the automaton: every further symbol is unseen
                other = 1
                break
        if other:
            return -99.0
        return (total + self.logs[state][1]) / (len(value) + 1)


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind number, end) of the base patterns, in order."""
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6] if ("=" in text or ":" in text) else []
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 20]
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(found)


def outside(text: str, spans: list[tuple[int, int, int]]) -> Iterator[re.Match]:
    """Tokens that meet no span; spans come in order, so both are walked once."""
    at = reach = 0
    for m in TOKEN.finditer(text):
        while at < len(spans) and spans[at][0] < m.end():
            reach = max(reach, spans[at][2])
            at += 1
        if reach <= m.start():
            yield m


def credential(text: str, start: int, kind: int, end: int) -> str:
    """The part of a base span that is the credential itself."""
    return ASSIGN.match(text, start)[2] if kind == 0 else text[start:end]


class Formats:
    """Automata of each kind of credential, and one of ordinary tokens."""

    def __init__(self, credentials: dict[int, Counter], ordinary: Counter):
        self.credentials = [Automaton(values) for _, values in sorted(credentials.items())]
        self.ordinary = Automaton(ordinary)
        self.known: dict[str, bool] = {}

    def secret(self, value: str) -> bool:
        if not self.credentials:
            return False
        return max(a.likelihood(value) for a in self.credentials) - max(self.ordinary.likelihood(value), math.log(1 / 64)) > MARGIN

    def spans(self, text: str) -> list[tuple[int, int, int]]:
        """Base spans and the tokens outside them that have the format of a credential."""
        found = base_spans(text)
        added = []
        for m in outside(text, found):
            if DIGIT.search(m[0]) and LETTER.search(m[0]) and self.secret(m[0]):
                added.append((m.start(), 3, m.end()))
        return sorted(found + added)


def fit(docs: DataFrame, fit_rows: int = FIT_ROWS, fit_values: int = FIT_VALUES) -> Formats:
    """Formats of the credentials in about fit_rows distinct texts (those of the smallest hashes)."""
    texts = docs.select(text_or_empty().alias("text"))
    share = min(1.0, fit_rows / max(1, texts.agg(F.approx_count_distinct(F.xxhash64("text"))).first()[0]))
    sample = texts.filter(F.pmod(F.xxhash64("text"), F.lit(1_000_000)) < F.lit(int(share * 1_000_000) or 1))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text in batch.column(0).to_pylist():
                base = base_spans(text)
                rows += [(kind, credential(text, a, kind, b)) for a, kind, b in base]
                rows += [(3, m[0]) for m in outside(text, base)]
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], "int32"), pa.array([r[1] for r in rows], "string")], ["kind", "value"])

    distinct = materialize(sample.mapInArrow(run, "kind int, value string").distinct(), "labelled-credentials")
    values: dict[int, Counter] = {}
    for kind in range(4):  # fit_values rows of each kind at most
        got = distinct.filter(F.col("kind") == kind).orderBy(F.xxhash64("value"), "value").limit(fit_values).collect()
        values[kind] = Counter(r["value"] for r in got)
    ordinary = values.pop(3)
    return Formats({k: v for k, v in values.items() if v}, ordinary)


def scan(docs: DataFrame, formats: Formats) -> DataFrame:
    """(doc_id, spans) for each row: spans are structs of kind, start, end and value, in code points, end exclusive."""
    shared = docs.sparkSession.sparkContext.broadcast(formats)
    kind = docs.schema["doc_id"].dataType.simpleString()
    item = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("value", pa.string())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [[{"kind": KINDS[k], "start": a, "end": b, "value": text[a:b]} for a, k, b in shared.value.spans(text)] for text in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, item)], ["doc_id", "spans"])

    return docs.select("doc_id", text_or_empty().alias("text")).mapInArrow(run, f"doc_id {kind}, spans array<struct<kind:string,start:long,end:long,value:string>>")


def digest(spans: DataFrame) -> DataFrame:
    """Counts and digests of the spans that scan() gives."""
    text = lambda kept: F.array_join(F.transform(kept, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    base = F.filter("spans", lambda s: s["kind"] != "format")
    return spans.select("doc_id", count("assign"), count("access"), count("hex"), F.sha2(text(base), 256).alias("base_sha256"), text(F.col("spans")).alias("spans"))


def spans_digest(docs: DataFrame) -> DataFrame:
    return digest(scan(docs, fit(docs)))
