"""Personal data: a character-level bidirectional LSTM with CRF transitions, beside exact base patterns."""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollmill.llm.common import clear_of, hash_sample, join_spans, map_texts, texts
from rollmill.llm.langid import Adam

Span = tuple[int, int, str]

# The base patterns and their kinds, in order.
KINDS = ("email", "ip", "card", "phone")
ORDER = {k: i for i, k in enumerate(KINDS)}
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]+")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
CLUE = re.compile(r"[0-9@]")

OTHER = 128  # every character beyond ASCII
PAD = 129
TAGS = ["O", *(f"{b}-{k}" for k in KINDS for b in "BI")]


def digits(s: str) -> list[int]:
    return [ord(c) - 48 for c in s if "0" <= c <= "9"]


def luhn(d: list[int]) -> bool:
    return (sum(d[-1::-2]) + sum(x * 2 - 9 * (x > 4) for x in d[-2::-2])) % 10 == 0


def emails(text: str) -> list[Span]:
    """As the pattern would, but led by the @ signs: its first part is the run before one, in linear time."""
    found, last, at = [], 0, text.find("@")
    while at >= 0:
        domain = DOMAIN.match(text, at + 1)
        start = at
        while start > last and text[start - 1] in LOCAL:
            start -= 1
        if domain and start < at:
            last = domain.end()
            found.append((start, last, "email"))
        at = text.find("@", max(last, at + 1))
    return found


def base_spans(text: str) -> list[Span]:
    """Leftmost non-overlapping matches of each kind; failing ones are dropped."""
    if not CLUE.search(text):
        return []
    found = emails(text)
    for m in IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p) <= 255 for p in m.group().split(".")):
            found.append((m.start(), m.end(), "ip"))
    for m in CARD.finditer(text):
        d = digits(m.group())
        if 12 <= len(d) <= 19 and luhn(d):
            found.append((m.start(), m.end(), "card"))
    for m in PHONE.finditer(text):
        if 9 <= len(digits(m.group())) <= 15:
            found.append((m.start(), m.end(), "phone"))
    return found


@dataclass
class Settings:
    """Bounds of the training sample, and the network's shape."""

    docs_read: int = 20_000  # documents searched for labelled windows
    windows: int = 3000  # windows learned from
    width: int = 96
    hidden: int = 14
    steps: int = 220
    batch: int = 48
    rate: float = 0.02
    seed: int = 5


def codes_of(text: str) -> np.ndarray:
    return np.minimum(np.frombuffer(text.encode("utf-32-le"), np.uint32), OTHER).astype(np.int64)


def window_starts(text: str, width: int) -> list[int]:
    """Starts, half a width apart, of the windows that hold a digit or an @: all kinds need one of them."""
    half = width // 2
    steps = sorted({m.start() // half for m in CLUE.finditer(text)})
    return sorted({max(0, s - k) * half for s in steps for k in (0, 1)})


def tag_row(spans: list[Span], start: int, width: int) -> list[int]:
    row = [0] * width
    for s, e, k in sorted(spans, key=lambda x: -ORDER[x[2]]):  # the kind listed first wins where kinds overlap
        for p in range(max(s, start), min(e, start + width)):
            row[p - start] = 1 + 2 * ORDER[k] + (p > s)
    return row


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + 0.5


def log_sum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return (top + np.log(np.exp(x - top).sum(axis=axis, keepdims=True))).squeeze(axis)


class Tagger:
    """Two LSTM layers, one per direction, and a linear chain over tags. Arrays are (direction, feature, window)."""

    def __init__(self, hidden: int, seed: int):
        draw, h, k = np.random.default_rng(seed).normal, hidden, len(TAGS)
        self.hidden = h
        self.p = {
            "table": draw(0, 0.3, (2, 4 * h, PAD + 1)),
            "u": draw(0, 1 / np.sqrt(h), (2, 4 * h, h)),
            "out": draw(0, 0.3, (k, 2 * h)),
            "bias": np.zeros((k, 1)),
            "move": draw(0, 0.1, (k, k)),  # from, to
            "first": np.zeros((k, 1)),
        }
        self.p["table"][:, h : 2 * h] += 1.0  # forget little at first
        self.p = {name: v.astype(np.float32) for name, v in self.p.items()}

    def states(self, codes: np.ndarray, tape: list | None = None) -> np.ndarray:
        """codes: (n, width). Gives (width, 2h, n)."""
        n, width = codes.shape
        h, p = self.hidden, self.p
        dtype = p["u"].dtype
        out, cell = np.zeros((2, h, n), dtype), np.zeros((2, h, n), dtype)
        found = np.empty((width, 2 * h, n), dtype)
        for t in range(width):
            x = np.stack([p["table"][0][:, codes[:, t]], p["table"][1][:, codes[:, width - 1 - t]]])
            x += np.matmul(p["u"], out)
            gates, new = sigmoid(x[:, : 3 * h]), np.tanh(x[:, 3 * h :])
            enter, keep, show = gates[:, :h], gates[:, h : 2 * h], gates[:, 2 * h :]
            before, cell = cell, keep * cell + enter * new
            squashed = np.tanh(cell)
            if tape is not None:
                tape.append((gates, new, before, squashed, out))
            out = show * squashed
            found[t, :h], found[width - 1 - t, h:] = out
        return found

    def emissions(self, states: np.ndarray) -> np.ndarray:
        return np.matmul(self.p["out"], states) + self.p["bias"]

    def gradient(self, codes: np.ndarray, tags: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        """Mean negative log-likelihood of the tag rows, and its gradient.

        Padding is tagged O like any text. The chain's part comes from forward and backward sums, the
        networks' part by backpropagation through time.
        """
        h, p, (n, width), k, tape = self.hidden, self.p, codes.shape, len(TAGS), []
        states = self.states(codes, tape)
        e = self.emissions(states)
        ahead, back = np.empty_like(e), np.zeros_like(e)
        ahead[0] = e[0] + p["first"]
        for t in range(1, width):
            ahead[t] = e[t] + log_sum(ahead[t - 1][:, None, :] + p["move"][:, :, None], 0)
        for t in range(width - 2, -1, -1):
            back[t] = log_sum(p["move"][:, :, None] + (e[t + 1] + back[t + 1])[None], 1)
        z = log_sum(ahead[-1], 0)
        one_hot = (np.arange(k)[None, :, None] == tags.T[:, None, :]).astype(e.dtype)
        moves = p["move"][tags[:, :-1], tags[:, 1:]].sum(axis=1)
        gold = (e * one_hot).sum(axis=(0, 1)) + p["first"][tags[:, 0], 0] + moves
        scale = 1 / e.dtype.type(n)
        d_e = (np.exp(ahead + back - z) - one_hot) * scale
        g = {name: np.zeros_like(v) for name, v in p.items()}
        g["first"] = d_e[0].sum(axis=1, keepdims=True)
        for t in range(1, width):
            pair = ahead[t - 1][:, None, :] + p["move"][:, :, None] + (e[t] + back[t])[None] - z
            g["move"] += np.exp(pair).sum(axis=2) * scale
        np.subtract.at(g["move"], (tags[:, :-1].ravel(), tags[:, 1:].ravel()), scale)
        g["out"] = np.einsum("tkn,thn->kh", d_e, states, optimize=True)
        g["bias"] = d_e.sum(axis=(0, 2))[:, None]
        d_states = np.matmul(p["out"].T, d_e)
        d_x = np.empty((2, width, 4 * h, n), e.dtype)
        d_out, d_cell = np.zeros((2, h, n), e.dtype), np.zeros((2, h, n), e.dtype)
        for t in range(width - 1, -1, -1):
            gates, new, before, squashed, out = tape[t]
            enter, keep, show = gates[:, :h], gates[:, h : 2 * h], gates[:, 2 * h :]
            d = d_out + np.stack([d_states[t, :h], d_states[width - 1 - t, h:]])
            d_cell = d_cell + d * show * (1 - squashed**2)
            d_gates = np.concatenate([d_cell * new, d_cell * before, d * squashed], axis=1) * gates * (1 - gates)
            x = np.concatenate([d_gates, d_cell * enter * (1 - new**2)], axis=1)
            d_cell = d_cell * keep
            d_out = np.matmul(p["u"].transpose(0, 2, 1), x)
            g["u"] += np.matmul(x, out.transpose(0, 2, 1))
            d_x[:, t] = x
        for d, column in ((0, codes), (1, codes[:, ::-1])):
            rows = np.zeros((width * n, PAD + 1), e.dtype)
            rows[np.arange(width * n), column.T.ravel()] = 1
            g["table"][d] = d_x[d].transpose(1, 0, 2).reshape(4 * h, -1) @ rows
        return float((z - gold).mean()), g

    def decode(self, codes: np.ndarray) -> np.ndarray:
        """The best tag row of each window, (n, width)."""
        e, move = self.emissions(self.states(codes)), self.p["move"]
        width, _, n = e.shape
        best, came = e[0] + self.p["first"], np.empty((width, len(TAGS), n), np.int8)
        for t in range(1, width):
            scores = best[:, None, :] + move[:, :, None]
            came[t] = scores.argmax(axis=0)
            best = scores.max(axis=0) + e[t]
        tags = np.empty((n, width), np.int8)
        tags[:, -1] = best.argmax(axis=0)
        for t in range(width - 1, 0, -1):
            tags[:, t - 1] = came[t, tags[:, t], np.arange(n)]
        return tags


def examples(docs: DataFrame, s: Settings) -> list[tuple[str, list[int]]]:
    """(window, its tags): at most s.windows, chosen by hash, from about s.docs_read documents."""

    def work(batches):
        for _, found in batches:
            pieces, tags = [], []
            for text in found:
                spans = base_spans(text or "")
                for start in window_starts(text or "", s.width):
                    piece = text[start : start + s.width]
                    pieces.append(piece)
                    tags.append(tag_row(spans, start, len(piece)))
            yield {"piece": pieces, "tags": tags}

    rows = map_texts(hash_sample(docs, s.docs_read), work, "piece string, tags array<int>").distinct()
    chosen = rows.orderBy(F.xxhash64("piece"), "piece", "tags").limit(s.windows)
    return sorted((r.piece, list(r.tags)) for r in chosen.collect())


def train(rows: list[tuple[str, list[int]]], s: Settings) -> Tagger | None:
    if not any(any(tags) for _, tags in rows):
        return None
    codes, tags = np.full((len(rows), s.width), PAD), np.zeros((len(rows), s.width), np.int64)
    for i, (piece, row) in enumerate(rows):
        codes[i, : len(piece)], tags[i, : len(row)] = codes_of(piece), row
    rng, net = np.random.default_rng(s.seed), Tagger(s.hidden, s.seed)
    adam = Adam(net.p, s.rate, s.steps)
    for _ in range(s.steps):
        some = rng.integers(0, len(rows), s.batch)
        adam.update(net.gradient(codes[some], tags[some])[1])
    return net


def spans_of(tags: np.ndarray, places: np.ndarray) -> list[Span]:
    """Spans of a document's tags at `places` (sorted positions): B opens, I of the same kind goes on."""
    found: list[list] = []
    for tag, p in zip(tags.tolist(), places.tolist(), strict=True):
        if not tag:
            continue
        kind = KINDS[(tag - 1) // 2]
        if tag % 2 == 0 and found and found[-1][1] == p and found[-1][2] == kind:
            found[-1][1] = p + 1
        else:
            found.append([p, p + 1, kind])
    return [tuple(x) for x in found]


def shortest(rows: list[tuple[str, list[int]]], share: float = 0.7) -> dict[str, float]:
    """Per kind, `share` of the length of its shortest labelled span that a window holds whole."""
    found: dict[str, list[int]] = {}
    for piece, tags in rows:
        for s, e, k in spans_of(np.array(tags), np.arange(len(tags))):
            if 0 < s and e < len(piece):
                found.setdefault(k, []).append(e - s)
    return {k: share * min(v) for k, v in found.items()}


def tagged_spans(
    net: Tagger, batch: list[str], width: int, least: dict[str, float], rows: int = 512
) -> list[list[Span]]:
    """What the network finds in each whole text.

    Overlapping windows meet again by position: each takes its tag from the window in which it lies
    farthest from an edge (the text's own ends are no edges). Spans without a digit or @ go, and those much
    shorter than any labelled one of their kind (`least`).
    """
    half, where = width // 2, []
    for i, text in enumerate(batch):
        where += [(i, start) for start in window_starts(text, width)]
    at = np.array(where, np.int64).reshape(-1, 2)
    result: list[list[Span]] = [[] for _ in batch]
    tags = np.zeros((len(at), width), np.int8)
    coded = {i: codes_of(batch[i]) for i in set(at[:, 0].tolist())}
    for lo in range(0, len(at), rows):
        some = np.full((len(at[lo : lo + rows]), width), PAD)
        for j, (i, start) in enumerate(at[lo : lo + rows].tolist()):
            piece = coded[i][start : start + width]
            some[j, : len(piece)] = piece
        tags[lo : lo + rows] = net.decode(some)
    inner = np.minimum(np.arange(width), np.arange(width)[::-1])
    bounds = np.searchsorted(at[:, 0], np.arange(len(batch) + 1))
    for i, text in enumerate(batch):
        mine = slice(bounds[i], bounds[i + 1])
        if mine.start == mine.stop:
            continue
        starts = at[mine, 1]
        places = (starts[:, None] + np.arange(width)).ravel()
        depth = np.tile(inner, (len(starts), 1))
        depth[starts == 0, :half] = width
        depth[starts + width >= len(text), half:] = width
        order = np.lexsort((-depth.ravel(), places))
        places = places[order]
        first = np.concatenate([[True], places[1:] != places[:-1]]) & (places < len(text))
        found = spans_of(tags[mine].ravel()[order][first], places[first])
        result[i] = [x for x in found if CLUE.search(text, x[0], x[1]) and x[1] - x[0] >= least.get(x[2], 1)]
    return result


def find_personal_data(
    docs: DataFrame, settings: Settings | None = None, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Columns doc_id, n_email, n_ip, n_card, n_phone, base (kind:start:end, joined), spans (the same with added ones).

    Base spans are the labels of a bounded sample of windows; the network learns them in context and
    reads, in overlapping windows, all text around digits and @ signs. What it finds clear of base spans is added
    under its kind. Offsets are code points, end exclusive.

    NULL texts are empty and have no spans. If no sampled window has a base span, nothing is added. Repeated rows get the
    same result; other columns are not read; empty tables give no rows.
    """
    s = settings or Settings()
    base = texts(docs, id_col, text_col)
    rows = examples(base, s)
    net, least = train(rows, s), shortest(rows)

    def work(batches):
        for ids, found in batches:
            found = [t or "" for t in found]
            more = tagged_spans(net, found, s.width, least) if net else [[] for _ in found]
            out: dict[str, list] = {k: [] for k in (*(f"n_{k}" for k in KINDS), "base", "spans")}
            for text, added in zip(found, more, strict=True):
                spans = base_spans(text)
                for k in KINDS:
                    out[f"n_{k}"].append(sum(x[2] == k for x in spans))
                out["base"].append(join_spans(spans, ORDER))
                out["spans"].append(join_spans(spans + clear_of(added, spans), ORDER))
            yield {"doc_id": ids, **out}

    counts = ", ".join(f"n_{k} bigint" for k in KINDS)
    return map_texts(base, work, f"doc_id bigint, {counts}, base string, spans string")
