"""Secret scans: base patterns, and formats learned by grammar inference.

Base patterns (assignments, access keys, hex) give labelled credentials: what stands behind
a keyword, or has a known shape.  Of a bounded sample (``sample_docs`` rows by hash) up to
``examples`` distinct strings of each kind, of at most ``longest`` characters, are put into
a prefix tree.  Its signs are letters as they are while ``COMMON`` of the strings begin
alike (literal prefixes), and character classes from there on.  States whose continuations
differ by no more than chance allows (Hoeffding's bound, applied to ends and to each sign,
and on to their successors) are merged, which leaves a probabilistic automaton for each
kind.  The same inference on up to ``BACKGROUND`` distinct strings that are no credentials
gives the automaton of plain text; left out are strings that hold what looks like a format
which at most ``SPECIFIC`` of them do, for these are credentials without a label.

All candidates of all texts are scored: whatever a run of credential characters outside
base spans holds between its ends and its separators (``=``, ``/``, ``.``, ``+``, ``-``,
``_``), from left to right, the longest first.  A candidate is a secret if its length is one
that labelled strings of its prefix have, its log-likelihood a sign under the kind's automaton
lies within the range that these show, give or take a margin, and it is ``BITS`` binary
digits likelier as such a credential than as plain text.  It becomes a span of kind
``grammar``.  So a credential of a known format is found bare, in a path or behind a name.

A scan is one pass over the texts without a shuffle; the automata travel with the code, and
a worker remembers what it found in up to ``KNOWN`` runs.

Cases: a null text is the empty text; very long texts are scanned whole, by linear
patterns; without labelled strings no automaton is learned and only base spans come;
repeated strings are learned from once; repeated rows are repeated; null doc_ids are kept;
an empty table gives an empty result; extra columns are dropped.
"""

from __future__ import annotations

import hashlib
import heapq
import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lanternflow.llm._shared import bounded_batches, read_table, staged

KINDS = ("assign", "access", "hex")
LEARNED, PLAIN = "grammar", "plain"
SAMPLE_DOCS, EXAMPLES, LONGEST, BACKGROUND = 20_000, 400, 256, 2000
CONFIDENCE, MARGIN, COMMON, FEWEST, BITS, SPECIFIC, KNOWN = 0.05, 0.1, 0.2, 8, 12.0, 0.1, 500_000
#: Fixed patterns.  Keywords stand in either case, ASCII only.
ASSIGN = re.compile(r"""([pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"[0-9a-f]{24,}")
#: All access keys, hex runs and candidates lie in such runs; a candidate has 6 characters, as a credential has.
RUN = re.compile(r"[A-Za-z0-9+/_.=-]{6,}")
SEPARATOR = re.compile(r"[+/_.=-]")
CLASSES = {**dict.fromkeys("0123456789", "d"), **dict.fromkeys("abcdef", "h"), **dict.fromkeys("ghijklmnopqrstuvwxyz", "l"), **dict.fromkeys("ABCDEF", "H"), **dict.fromkeys("GHIJKLMNOPQRSTUVWXYZ", "U"), **{c: c for c in "+/_.=-"}}

Span = tuple[int, int, int]


def base_spans(text: str) -> tuple[list[Span], list[tuple[int, int]], list[tuple[str, str]]]:
    """Spans (start, kind's place, end) in order; runs; and the credentials themselves (kind, string)."""
    spans, values = [], []
    if ":" in text or "=" in text:
        for m in ASSIGN.finditer(text):
            if m.end(2) - m.start(2) >= 6:
                spans.append((m.start(), 0, m.end()))
                values.append((KINDS[0], m[2]))
    runs = [m.span() for m in RUN.finditer(text)]
    for a, b in runs:
        if b - a >= 20:
            for k, pattern in ((1, ACCESS), (2, HEX)):
                for m in pattern.finditer(text, a, b):
                    spans.append((m.start(), k, m.end()))
                    values.append((KINDS[k], m[0]))
    return sorted(spans), runs, values


def left_over(runs: list[tuple[int, int]], spans: list[Span]) -> Iterator[tuple[int, int]]:
    """What runs hold outside spans, 6 characters at least."""
    k = 0
    for a, b in runs:
        while k < len(spans) and spans[k][2] <= a:
            k += 1
        at, j = a, k
        while j < len(spans) and spans[j][0] < b:
            if spans[j][0] - at >= 6:
                yield at, spans[j][0]
            at = max(at, spans[j][2])
            j += 1
        if b - at >= 6:
            yield at, b


class Automaton:
    """A probabilistic automaton: for each state its visits, ends, and (sign -> [visits, next state])."""

    def __init__(self, strings: list[str], confidence: float = CONFIDENCE, margin: float = MARGIN, common: float = COMMON, fewest: int = FEWEST):
        strings = sorted(set(strings))
        shared = Counter(s[:k] for s in strings for k in range(1, len(s) + 1))
        self.prefixes = {p for p, n in shared.items() if n >= max(fewest, common * len(strings))}
        self.lengths: dict[str, tuple[int, int]] = {}
        for s in strings:
            p = self.prefix(s)
            low, high = self.lengths.get(p, (len(s), len(s)))
            self.lengths[p] = (min(low, len(s)), max(high, len(s)))
        self.longest = max((high for _, high in self.lengths.values()), default=0)
        self.visits, self.ends, self.next = [0], [0], [{}]
        for s in strings:
            self._grow(s)
        self.classes = Counter(CLASSES[c] for s in strings for c in s)
        self.size, self.strings = sum(self.classes.values()), len(strings)
        self._infer(confidence)
        scores = [x / (len(s) + 1) for s in strings if (x := self.bits(s)) is not None]
        self.low, self.high = (min(scores) - margin, max(scores) + margin) if scores else (0.0, -1.0)

    def prefix(self, string: str) -> str:
        """The literal prefix of a string: as far as many labelled strings begin like it."""
        k = 0
        while k < len(string) and string[: k + 1] in self.prefixes:
            k += 1
        return string[:k]

    def signs(self, string: str) -> list[str]:
        p = len(self.prefix(string))
        return ["=" + c for c in string[:p]] + [CLASSES[c] for c in string[p:]]

    def _grow(self, string: str) -> None:
        at = 0
        self.visits[0] += 1
        for sign in self.signs(string):
            if sign not in self.next[at]:
                self.next[at][sign] = [0, len(self.visits)]
                self.visits.append(0)
                self.ends.append(0)
                self.next.append({})
            edge = self.next[at][sign]
            edge[0] += 1
            at = edge[1]
            self.visits[at] += 1
        self.ends[at] += 1

    def _alike(self, a: int, b: int, confidence: float) -> bool:
        todo = [(a, b)]
        while todo:
            a, b = todo.pop()
            n, m = self.visits[a], self.visits[b]
            bound = math.sqrt(0.5 * math.log(2 / confidence)) * (1 / math.sqrt(n) + 1 / math.sqrt(m))
            if abs(self.ends[a] / n - self.ends[b] / m) > bound:
                return False
            for sign in self.next[a].keys() | self.next[b].keys():
                x, y = self.next[a].get(sign), self.next[b].get(sign)
                if abs((x[0] if x else 0) / n - (y[0] if y else 0) / m) > bound:
                    return False
                if x and y:
                    todo.append((x[1], y[1]))
        return True

    def _fold(self, into: int, state: int) -> None:
        todo = [(into, state)]
        while todo:
            a, b = todo.pop()
            self.visits[a] += self.visits[b]
            self.ends[a] += self.ends[b]
            for sign, (count, target) in self.next[b].items():
                if sign in self.next[a]:
                    self.next[a][sign][0] += count
                    todo.append((self.next[a][sign][1], target))
                else:
                    self.next[a][sign] = [count, target]

    def _infer(self, confidence: float) -> None:
        """Keeps a core of states; each state at its border is merged into the core or joins it."""
        core = [0]
        while True:
            border = [(q, sign) for q in core for sign in sorted(self.next[q]) if self.next[q][sign][1] not in core]
            if not border:
                return
            q, sign = max(border, key=lambda x: (self.next[x[0]][x[1]][0], -x[0], x[1]))
            state = self.next[q][sign][1]
            like = next((r for r in core if self._alike(r, state, confidence)), None)
            if like is None:
                core.append(state)
            else:
                self.next[q][sign][1] = like
                self._fold(like, state)

    def bits(self, string: str) -> float | None:
        """Log2-likelihood of a string and its end; None if the automaton can't make it."""
        at, total = 0, 0.0
        for sign in self.signs(string):
            edge = self.next[at].get(sign)
            if edge is None:
                return None
            total += math.log2(edge[0] / self.visits[at])
            at = edge[1]
        return total + math.log2(self.ends[at] / self.visits[at]) if self.ends[at] else None

    def plain_bits(self, string: str) -> float:
        """The same for plain text, which can be anything: at least what its classes alone make likely."""
        n, each = len(string), self.size + len(set(CLASSES.values()))
        stop = (self.strings + 1) / (self.size + self.strings + 2)
        free = sum(math.log2((self.classes[CLASSES[c]] + 1) / each) for c in string) + n * math.log2(1 - stop) + math.log2(stop)
        own = self.bits(string)
        return free if own is None else max(free, own)

    def accepts(self, string: str, plain: Automaton | None = None, least: float = BITS) -> bool:
        span = self.lengths.get(self.prefix(string))
        if span is None or not span[0] <= len(string) <= span[1] or (bits := self.bits(string)) is None:
            return False
        return self.low <= bits / (len(string) + 1) <= self.high and (plain is None or bits - plain.plain_bits(string) >= least)


class Scanner:
    """Finds what the automata accept in a run."""

    def __init__(self, automata: list[Automaton], plain: Automaton | None):
        self.automata, self.plain, self.known = automata, plain, {}
        self.longest = max((m.longest for m in automata), default=0)
        self.shortest = min((low for m in automata for low, _ in m.lengths.values()), default=1)

    def __call__(self, run: str) -> tuple[tuple[int, int], ...]:
        found = self.known.get(run)
        if found is None:
            found = tuple(self._search(run))
            if len(run) <= 64:
                if len(self.known) >= KNOWN:
                    self.known.clear()
                self.known[run] = found
        return found

    def _search(self, run: str) -> Iterator[tuple[int, int]]:
        if len(run) < self.shortest or not self.automata:
            return
        marks = [m.start() for m in SEPARATOR.finditer(run)]
        starts, ends, at, first = [0, *(k + 1 for k in marks)], [*marks, len(run)], 0, 0
        for a in starts:
            if a < at:
                continue
            while first < len(ends) and ends[first] < a + self.shortest:
                first += 1
            last = first
            while last < len(ends) and ends[last] <= a + self.longest:
                last += 1
            for b in reversed(ends[first:last]):
                if any(m.accepts(run[a:b], self.plain) for m in self.automata):
                    yield a, b
                    at = b
                    break


def _sampled(background: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found, plain = set(), set()
            for text in batch.column(0).to_pylist():
                spans, runs, values = base_spans(text or "")
                found.update(values)
                plain.update(text[a:b].strip("+/_.=-") for a, b in left_over(runs, spans))
            rows = [(k, v) for k, v in found] + [(PLAIN, v) for v in heapq.nsmallest(background, (p for p in plain if p), key=lambda v: (zlib.crc32(v.encode()), v))]
            k, v = zip(*rows) if rows else ((), ())
            yield pa.RecordBatch.from_arrays([pa.array(k, pa.string()), pa.array(v, pa.string())], names=["kind", "value"])

    return run


def fit(docs: DataFrame, sample_docs: int = SAMPLE_DOCS, examples: int = EXAMPLES, longest: int = LONGEST, background: int = BACKGROUND) -> Scanner:
    """An automaton for each kind that the sample has, and that of plain text.

    The sample is bounded: about sample_docs rows, of these examples distinct strings a kind and background plain ones, by hash; credentials longer than longest are not learned from."""
    bounded_batches(docs.sparkSession)
    share = min(1.0, sample_docs / max(1, docs.count()))
    sample = docs.where(F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 20)) < int(share * (1 << 20))).select("text")
    found = staged(sample.mapInArrow(_sampled(background), "kind string, value string").where(F.length("value") <= longest).distinct(), "credentials")
    some = lambda kind, n: [r["value"] for r in found.where(F.col("kind") == kind).orderBy(F.crc32(F.col("value").cast("binary")), "value").limit(n).collect()]
    return learned([values for kind in KINDS if (values := some(kind, examples))], some(PLAIN, background))


def learned(credentials: list[list[str]], plain: list[str]) -> Scanner:
    """A scanner from the strings of each kind, and plain ones."""
    automata = [Automaton(values) for values in credentials]
    look = Scanner(automata, None)
    formats = [{(k, m.prefix(v[a:b])) for a, b in look(v) for k, m in enumerate(automata) if m.accepts(v[a:b])} for v in plain]
    often = {f for f, n in Counter(f for fs in formats for f in fs).items() if n > SPECIFIC * len(plain)}
    return Scanner(automata, Automaton([v for v, fs in zip(plain, formats) if not fs - often]))


def named(spans: list[tuple[int, str, int]]) -> str:
    return ",".join(f"{kind}:{a}:{b}" for a, kind, b in spans)


def _scan(scanner: Scanner):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        empty = hashlib.sha256(b"").hexdigest()
        for batch in batches:
            out: list[list] = [[], [], [], [], []]
            for text in batch.column(1).to_pylist():
                spans, runs, _ = base_spans(text) if text else ([], [], [])
                base = [(a, KINDS[k], b) for a, k, b in spans]
                more = [(a + x, LEARNED, a + y) for a, b in left_over(runs, spans) for x, y in scanner(text[a:b])]
                for k in range(3):
                    out[k].append(sum(x[1] == k for x in spans))
                out[3].append(hashlib.sha256(named(base).encode()).hexdigest() if base else empty)
                out[4].append(named(sorted(base + more, key=lambda x: (x[0], (*KINDS, LEARNED).index(x[1])))))
            types = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string())
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, t) for c, t in zip(out, types))], names=["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"])

    return run


def scanned(docs: DataFrame, scanner: Scanner) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans (kind:start:end of all, comma-joined, in code points)."""
    bounded_batches(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(_scan(scanner), "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string")


def op6_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return scanned(docs, fit(docs))


QUERIES = {"op6_secret_scan": op6_secret_scan}
SQL: dict[str, str] = {}
