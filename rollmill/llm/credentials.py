"""Secret scans: probabilistic automata inferred from labelled credentials score every candidate."""

from __future__ import annotations

import math
import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field
from statistics import NormalDist

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollmill.llm.common import clear_of, hash_sample, join_spans, map_texts, texts

Span = tuple[int, int, str]

# The base patterns and their kinds, in order.
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
KINDS = ("assign", "access", "hex")
#: Spans that the automata add.
ADDED = "format"
ORDER = {k: i for i, k in enumerate((*KINDS, ADDED))}
# A run of 24 or more is a maximal run that passes; shorter ones fail. It starts where no hex digit precedes.
HEX = re.compile(r"(?<![0-9a-f])[0-9a-f]{24,}")
HINTS = ("passw", "secret", "token", "api")

#: Characters that can be part of a credential. Ordinary candidates are learned from runs of at least LEAST of them.
LEAST = 6
CANDIDATE = r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{%d,}"

# Character classes, the symbols of the automata, and how many characters each holds.
CLASSES = {"0": "0123456789", "a": "abcdef", "z": "ghijklmnopqrstuvwxyz", "A": "ABCDEF", "Z": "GHIJKLMNOPQRSTUVWXYZ"}
SYMBOLS = str.maketrans({c: k for k, group in CLASSES.items() for c in group})
#: Added to every count of a state.
FAINT = 0.1
LOG_SIZE = {k: math.log(len(group)) for k, group in CLASSES.items()}


def base_spans(text: str) -> list[Span]:
    """Leftmost non-overlapping matches of each kind; failing ones are dropped."""
    found: list[Span] = []
    lowered = text.lower()
    if any(hint in lowered for hint in HINTS):
        found += [(m.start(), m.end(), "assign") for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    if "AKIA" in text:
        found += [(m.start(), m.end(), "access") for m in ACCESS.finditer(text) if m.end() - m.start() >= 20]
    found += [(m.start(), m.end(), "hex") for m in HEX.finditer(text)]
    return found


def credential(text: str, span: Span) -> str:
    """The credential inside a base span: of an assignment, its value."""
    start, end, kind = span
    return ASSIGN.match(text, start, end)[2] if kind == "assign" else text[start:end]


@dataclass
class State:
    ends: int = 0
    counts: dict[str, int] = field(default_factory=lambda: defaultdict(int))
    to: dict[str, int] = field(default_factory=dict)
    lengths: Counter = field(default_factory=Counter)  # how many symbols follow here, per example
    letters: dict[str, Counter] = field(default_factory=lambda: defaultdict(Counter))  # the characters behind each symbol

    @property
    def total(self) -> int:
        return self.ends + sum(self.counts.values())


def furthest(x: Counter, y: Counter) -> float:
    """Kolmogorov-Smirnov distance of two counts over lengths."""
    n, m, far, ahead = sum(x.values()), sum(y.values()), 0.0, 0.0
    for length in sorted({**x, **y}):
        ahead += x[length] / n - y[length] / m
        far = max(far, abs(ahead))
    return far


def likelihood_ratio(rows: list[list[int]]) -> float:
    """G statistic of a table of counts: twice the log-likelihood that separate distributions gain over a common one."""

    def entropy(counts):
        total = sum(counts)
        return sum(c * math.log(c / total) for c in counts if c)

    return 2 * (sum(map(entropy, rows)) - entropy([sum(c) for c in zip(*rows, strict=True)]))


def chi_square_bound(freedom: int, z: float) -> float:
    """Quantile of chi-square at z standard deviations (Wilson and Hilferty's approximation)."""
    return freedom * (1 - 2 / (9 * freedom) + z * math.sqrt(2 / (9 * freedom))) ** 3


class Automaton:
    """A probabilistic deterministic automaton, inferred by merging states of a prefix tree.

    States are visited from the root outwards. A state joins the closest accepted state with which it is
    statistically compatible, else it is accepted. Two states are compatible if, in them and in all states that follow both, the next
    symbols and endings pass a likelihood-ratio test (both seen `least` times) and the numbers of symbols still to come pass a
    Kolmogorov-Smirnov test, each at confidence `alpha`. So places of a format of fixed length stay apart, whatever its letters are.
    A symbol is a class of characters; where one state's characters are no even draw from the class, it tells them apart.
    """

    def __init__(self, strings: list[str], alpha: float = 0.001, least: int = 8):
        self.states: dict[int, State] = {0: State()}
        self.least, self.z = least, NormalDist().inv_cdf(1 - alpha)
        self.far = math.sqrt(-0.5 * math.log(alpha / 2))
        for s in strings:
            at = 0
            for i, (char, symbol) in enumerate(zip(s, s.translate(SYMBOLS), strict=True)):
                here = self.states[at]
                here.lengths[len(s) - i] += 1
                here.counts[symbol] += 1
                here.letters[symbol][char] += 1
                if symbol not in here.to:
                    here.to[symbol] = len(self.states)
                    self.states[len(self.states)] = State()
                at = here.to[symbol]
            self.states[at].ends += 1
            self.states[at].lengths[0] += 1
        self.infer()
        self.finish()

    def infer(self) -> None:
        accepted = [0]
        while True:
            known = set(accepted)
            fringe = [(a, symbol) for a in accepted for symbol in self.states[a].to if self.states[a].to[symbol] not in known]
            if not fringe:
                break
            parent, symbol = max(fringe, key=lambda x: (self.states[self.states[x[0]].to[x[1]]].total, -x[0], x[1]))
            blue = self.states[parent].to[symbol]
            near = [(furthest(self.states[red].lengths, self.states[blue].lengths), i, red) for i, red in enumerate(accepted)]
            for _, _, red in sorted(near):
                if self.compatible(red, blue):
                    self.states[parent].to[symbol] = red
                    self.fold(red, blue)
                    break
            else:
                accepted.append(blue)
        self.states = {k: self.states[k] for k in accepted}

    def compatible(self, a: int, b: int) -> bool:
        stack, seen = [(a, b)], set()
        while stack:
            pair = stack.pop()
            if pair in seen:
                continue
            seen.add(pair)
            x, y = self.states[pair[0]], self.states[pair[1]]
            n, m = x.total, y.total
            if furthest(x.lengths, y.lengths) > self.far * math.sqrt((n + m) / (n * m)):
                return False
            symbols = sorted({**x.counts, **y.counts})
            if min(n, m) >= self.least:
                rows = [[s.ends, *(s.counts.get(c, 0) for c in symbols)] for s in (x, y)]
                freedom = sum(map(any, zip(*rows, strict=True))) - 1
                if freedom and likelihood_ratio(rows) > chi_square_bound(freedom, self.z):
                    return False
            stack += [(x.to[c], y.to[c]) for c in symbols if c in x.to and c in y.to]
        return True

    def fold(self, into: int, tree: int) -> None:
        """Adds the counts of the prefix tree below `tree` to the states reached from `into`."""
        stack = [(into, tree)]
        while stack:
            a, b = stack.pop()
            x, y = self.states[a], self.states[b]
            x.ends += y.ends
            x.lengths.update(y.lengths)
            for symbol, n in y.counts.items():
                x.counts[symbol] += n
                x.letters[symbol].update(y.letters[symbol])
            for symbol, below in y.to.items():
                if symbol in x.to:
                    stack.append((x.to[symbol], below))
                else:
                    x.to[symbol] = below

    def finish(self) -> None:
        """Log-probabilities with a tenth of a count added, so that an ending never seen stays surprising; unseen symbols stay in the same state. Entropies are over seen characters and the ending."""
        self.table: dict[int, tuple[dict[str, tuple[float, int]], float, float, float]] = {}
        kinds = len(CLASSES) + 8  # classes, the punctuation of candidates, the ending
        for k, s in self.states.items():
            total = s.total + FAINT * kinds
            moves, entropy, mass = {}, 0.0, 0.0
            for symbol, n in s.counts.items():
                p = (n + FAINT) / total
                group = CLASSES.get(symbol, symbol)
                drawn = [s.letters[symbol][c] for c in group]
                uneven = 2 * sum(c * math.log(c * len(group) / n) for c in drawn if c)
                even = len(group) == 1 or n < self.least or uneven <= chi_square_bound(len(group) - 1, self.z)
                for char, seen in zip(group, drawn, strict=True):
                    q = p / len(group) if even else p * (seen + 0.5) / (n + 0.5 * len(group))
                    moves[char] = math.log(q), s.to[symbol]
                    entropy, mass = entropy - q * math.log(q), mass + q
            end = (s.ends + FAINT) / total
            entropy = (entropy - end * math.log(end)) / (mass + end)
            self.table[k] = moves, math.log(FAINT / total), math.log(end), entropy

    def read(self, s: str) -> tuple[float, float]:
        """Log-likelihood of a string, and how far that is above what the states on its way lead one to expect."""
        at, total, expected = 0, 0.0, 0.0
        for char in s:
            moves, rare, _, entropy = self.table[at]
            expected -= entropy
            if char in moves:
                step, at = moves[char]
                total += step
            else:
                total += rare - LOG_SIZE.get(char.translate(SYMBOLS), 0.0)
        _, _, end, entropy = self.table[at]
        return total + end, total + end - expected + entropy

    def log_likelihood(self, s: str) -> float:
        return self.read(s)[0]


@dataclass
class Scorer:
    """One automaton per kind of credential and one of ordinary candidates.

    A candidate is a credential if a kind explains it by `evidence` nats better than ordinary text, and it is no less typical of
    that kind, by `slack` nats at most, than all but a twentieth of the kind's own examples were for an automaton that had not seen them.
    """

    kinds: dict[str, Automaton]
    ordinary: Automaton
    floors: dict[str, float]
    shortest: int
    evidence: float = 12.0
    slack: float = 1.0

    def is_credential(self, s: str) -> bool:
        plain = self.ordinary.log_likelihood(s)
        for kind, automaton in self.kinds.items():
            found, typical = automaton.read(s)
            if found >= plain + self.evidence and typical >= self.floors[kind] - self.slack:
                return True
        return False


def fit(credentials: dict[str, list[str]], ordinary: list[str], evidence: float = 12.0, folds: int = 5) -> Scorer | None:
    """None if there is nothing to learn from: no credentials, or no ordinary candidates."""
    kinds = {k: Automaton(v) for k, v in credentials.items() if v}
    if not kinds or not ordinary:
        return None
    floors = {}
    for k in kinds:
        strings = credentials[k]
        if len(strings) < folds:
            floors[k] = min(kinds[k].read(s)[1] for s in strings)
            continue
        parts = [(Automaton([s for j, s in enumerate(strings) if j % folds != i]), strings[i::folds]) for i in range(folds)]
        typical = sorted(unseen.read(s)[1] for unseen, left_out in parts for s in left_out)
        floors[k] = typical[len(typical) // 20]
    shortest = min(len(s) for k in kinds for s in credentials[k])
    return Scorer(kinds, Automaton(ordinary), floors, shortest, evidence)


def candidates(text: str, base: list[Span], shortest: int = LEAST) -> Iterator[Span]:
    return iter(clear_of([(m.start(), m.end(), ADDED) for m in re.finditer(CANDIDATE % shortest, text)], base))


def examples(
    docs: DataFrame, per_kind: int, ordinary: int, docs_read: int, longest: int = 1024
) -> tuple[dict[str, list[str]], list[str]]:
    """Credentials of base spans (`per_kind` distinct ones each) and `ordinary` other candidates, from about `docs_read` documents.

    Whole strings; those above `longest` code points are not learned from.
    """

    def work(batches):
        for _, found in batches:
            seen = set()
            for text in found:
                base = base_spans(text or "")
                seen.update((span[2], credential(text, span)) for span in base)
                seen.update((k, text[s:e]) for s, e, k in candidates(text or "", base))
            some = sorted(x for x in seen if len(x[1]) <= longest)
            yield {"kind": [k for k, _ in some], "s": [s for _, s in some]}

    rows = map_texts(hash_sample(docs, docs_read), work, "kind string, s string")
    got: dict[str, list[str]] = {}
    rank = F.expr("row_number() over (partition by kind order by xxhash64(s), s)")
    most = F.when(F.col("kind") == ADDED, ordinary).otherwise(per_kind)
    for r in rows.distinct().withColumn("rank", rank).where(F.col("rank") <= most).collect():
        got.setdefault(r.kind, []).append(r.s)
    return {k: sorted(got.get(k, [])) for k in KINDS}, sorted(got.get(ADDED, []))


class Judge:
    """Remembers verdicts on short candidates, which repeat; the memory of a task is bounded in characters."""

    MEMORY = 4_000_000

    def __init__(self, scorer: Scorer):
        self.scorer, self.known, self.size = scorer, {}, 0

    def __call__(self, s: str) -> bool:
        if len(s) > 64:
            return self.scorer.is_credential(s)
        found = self.known.get(s)
        if found is None:
            if self.size > self.MEMORY:
                self.known, self.size = {}, 0
            found = self.known[s] = self.scorer.is_credential(s)
            self.size += len(s)
        return found


def find_secrets(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    per_kind: int = 400,
    ordinary: int = 1500,
    docs_read: int = 20_000,
    evidence: float = 12.0,
) -> DataFrame:
    """Columns doc_id, n_assign, n_access, n_hex, base (kind:start:end, joined), spans (the same with `format` spans added).

    Base spans are labelled credentials. Automata inferred from a bounded sample of them score every other candidate of every
    text: a run of credential characters clear of base spans, from the length of the shortest labelled credential on. Offsets are code points, end exclusive.

    NULL texts are empty and have no spans. Without credentials or ordinary candidates in the sample nothing is added.
    Repeated rows get the same result; other columns are not read; empty tables give no rows.
    """
    base = texts(docs, id_col, text_col)
    scorer = fit(*examples(base, per_kind, ordinary, docs_read), evidence)

    def work(batches):
        judge = Judge(scorer) if scorer else None
        for ids, found in batches:
            out: dict[str, list] = {k: [] for k in ("n_assign", "n_access", "n_hex", "base", "spans")}
            for text in found:
                text = text or ""
                spans = base_spans(text)
                for k in KINDS:
                    out[f"n_{k}"].append(sum(x[2] == k for x in spans))
                more = [x for x in candidates(text, spans, scorer.shortest) if judge(text[x[0] : x[1]])] if scorer else []
                out["base"].append(join_spans(spans, ORDER))
                out["spans"].append(join_spans(spans + more, ORDER))
            yield {"doc_id": ids, **out}

    return map_texts(
        base, work, "doc_id bigint, n_assign bigint, n_access bigint, n_hex bigint, base string, spans string"
    )
