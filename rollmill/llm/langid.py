"""Language identification with a bidirectional gated recurrent network over bytes, trained by backpropagation through time."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollmill.llm.common import map_texts, named, texts

PAD = 256


def has_letter(text: str) -> bool:
    """A letter of any script; number signs such as a half or a circled one are none."""
    return any(map(str.isalpha, text))


def softsign(x: np.ndarray) -> np.ndarray:
    return x / (1 + np.abs(x))


@dataclass
class Settings:
    """Bounds of the training sample, and the network's shape."""

    docs: int = 800  # labelled documents per language, of every language
    most: int = 200_000  # documents in all: fewer per language where languages are many, one at least
    pieces: int = 3  # texts are sampled at so many places
    length: int = 96  # code points of a piece
    window: int = 64  # bytes after which the state starts anew
    hidden: int = 8
    steps: int = 260
    batch: int = 192
    rate: float = 0.01
    seed: int = 11


class Network:
    """Two gated recurrent layers, one per direction, with softsign gates; a softmax at every position.

    Arrays are (direction, feature, window) so that every step works on whole windows at once.
    The backward layer reads each window from its end. table: what a byte adds to the three gates.
    """

    def __init__(self, classes: int, hidden: int, seed: int):
        draw = np.random.default_rng(seed).normal
        self.hidden = h = hidden
        self.p = {
            "table": draw(0, 0.3, (2, 3 * h, PAD + 1)),
            "u": draw(0, 1 / np.sqrt(h), (2, 3 * h, h)),
            "c": np.zeros((2, h, 1)),
            "out": draw(0, 0.3, (classes, 2 * h)),
            "bias": np.zeros((classes, 1)),
        }
        self.p = {k: v.astype(np.float32) for k, v in self.p.items()}

    def step(self, x, state):
        """x: (2, 3h, n) from the table. Gives the new state and what backpropagation needs."""
        h, u = self.hidden, np.matmul(self.p["u"], state)
        gates = softsign(x[:, : 2 * h] + u[:, : 2 * h]) * 0.5 + 0.5
        keep, reset = gates[:, :h], gates[:, h:]
        q = u[:, 2 * h :] + self.p["c"]
        new = softsign(x[:, 2 * h :] + reset * q)
        return new + keep * (state - new), (gates, q, new, state)

    def states(self, codes: np.ndarray, tape: list | None = None) -> np.ndarray:
        """codes: (n, window). Gives (window, 2h, n): both directions' states at every position."""
        n, width = codes.shape
        h, table, dtype = self.hidden, self.p["table"], self.p["u"].dtype
        state, x = np.zeros((2, h, n), dtype), np.empty((2, 3 * h, n), dtype)
        found = np.empty((width, 2 * h, n), dtype)
        for t in range(width):
            for d, column in ((0, codes[:, t]), (1, codes[:, width - 1 - t])):
                np.take(table[d], column, axis=1, out=x[d], mode="clip")
            state, kept = self.step(x, state)
            found[t, :h], found[width - 1 - t, h:] = state
            if tape is not None:
                tape.append(kept)
        return found

    def read(self, codes: np.ndarray) -> np.ndarray:
        """The same states as `states`, in place and without a tape.

        With gates as (1 + g) / 2, reset * q is q/2 + g * q/2 and the new state half of (new + state) + g * (state - new).
        """
        n, width = codes.shape
        h = self.hidden
        u = self.p["u"].copy()
        u[:, 2 * h :] *= 0.5
        half_c = self.p["c"] * np.float32(0.5)
        state, x, m = np.zeros((2, h, n), np.float32), np.empty((2, 3 * h, n), np.float32), np.empty((2, 3 * h, n), np.float32)
        low, found = np.empty((2, 2 * h, n), np.float32), np.empty((width, 2 * h, n), np.float32)
        columns = np.ascontiguousarray(codes.T)
        for t in range(width):
            np.take(self.p["table"][0], columns[t], axis=1, out=x[0], mode="clip")
            np.take(self.p["table"][1], columns[width - 1 - t], axis=1, out=x[1], mode="clip")
            np.matmul(u, state, out=m)
            gates, new, q, side = x[:, : 2 * h], x[:, 2 * h :], m[:, 2 * h :], low[:, :h]
            gates += m[:, : 2 * h]
            np.abs(gates, out=low)
            low += 1
            gates /= low
            q += half_c
            new += q
            q *= gates[:, h:]
            new += q
            np.abs(new, out=side)
            side += 1
            new /= side
            np.subtract(state, new, out=side)
            side *= gates[:, :h]
            state += new
            state += side
            state *= 0.5
            found[t, :h], found[width - 1 - t, h:] = state
        return found

    def log_probabilities(self, states: np.ndarray) -> np.ndarray:
        """(window, classes, n)"""
        logits = np.matmul(self.p["out"], states) + self.p["bias"]
        logits -= logits.max(axis=1, keepdims=True)
        return logits - np.log(np.exp(logits).sum(axis=1, keepdims=True))

    def gradient(self, codes: np.ndarray, labels: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        """Mean loss over all real positions, and its gradient by backpropagation through time."""
        h, (n, width), tape = self.hidden, codes.shape, []
        states = self.states(codes, tape)
        logp = self.log_probabilities(states)
        real = (codes != PAD).T[:, None, :] / states.dtype.type(max(1, (codes != PAD).sum()))
        loss = -float((np.take_along_axis(logp, labels[None, None, :], axis=1) * real).sum())
        d_logits = np.exp(logp)
        d_logits[:, labels, np.arange(n)] -= 1
        d_logits *= real
        d_states = np.matmul(self.p["out"].T, d_logits)
        g = {k: np.zeros_like(v) for k, v in self.p.items()}
        g["out"] = np.einsum("tkn,thn->kh", d_logits, states, optimize=True)
        g["bias"] = d_logits.sum(axis=(0, 2))[:, None]
        d_x = np.empty((2, width, 3 * h, n), states.dtype)
        carry = np.zeros((2, h, n), states.dtype)
        for t in range(width - 1, -1, -1):
            gates, q, new, before = tape[t]
            keep, reset = gates[:, :h], gates[:, h:]
            d = carry + np.stack([d_states[t, :h], d_states[width - 1 - t, h:]])
            d_new = d * (1 - keep) * (1 - np.abs(new)) ** 2
            d_gates = np.concatenate([d * (before - new), d_new * q], axis=1)
            d_gates *= 0.5 * (1 - np.abs(2 * gates - 1)) ** 2
            d_q = d_new * reset
            d_u = np.concatenate([d_gates, d_q], axis=1)
            carry = d * keep + np.matmul(self.p["u"].transpose(0, 2, 1), d_u)
            g["u"] += np.matmul(d_u, before.transpose(0, 2, 1))
            g["c"] += d_q.sum(axis=2, keepdims=True)
            d_x[:, t, : 2 * h], d_x[:, t, 2 * h :] = d_gates, d_new
        for d, column in ((0, codes), (1, codes[:, ::-1])):
            one_hot = np.zeros((width * n, PAD + 1), np.float32)
            one_hot[np.arange(width * n), column.T.ravel()] = 1
            g["table"][d] = d_x[d].transpose(1, 0, 2).reshape(3 * h, -1) @ one_hot
        return loss, g


class Adam:
    def __init__(self, p: dict[str, np.ndarray], rate: float, steps: int):
        self.p, self.rate, self.steps, self.t = p, rate, steps, 0
        self.m = {k: np.zeros_like(v) for k, v in p.items()}
        self.v = {k: np.zeros_like(v) for k, v in p.items()}

    def update(self, g: dict[str, np.ndarray]) -> None:
        self.t += 1
        norm = float(np.sqrt(sum(float((x * x).sum()) for x in g.values())))
        rate = self.rate * min(1.0, 2 * (1 - self.t / (self.steps + 1)))
        for k, x in g.items():
            x = x * np.float32(min(1.0, 1 / (norm + 1e-9)))
            self.m[k] += 0.1 * (x - self.m[k])
            self.v[k] += 0.01 * (x * x - self.v[k])
            m, v = self.m[k] / (1 - 0.9**self.t), self.v[k] / (1 - 0.99**self.t)
            self.p[k] -= (rate * m / (np.sqrt(v) + 1e-7)).astype(np.float32)


def windows(data: list[bytes], width: int) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of all texts, cut into padded rows of `width`; and the number of rows of each text."""
    counts = np.array([-(-len(x) // width) for x in data], np.int64)
    codes = np.full((int(counts.sum()), width), PAD, np.int16)
    at = 0
    for x, n in zip(data, counts.tolist(), strict=True):
        codes[at : at + n].reshape(-1)[: len(x)] = np.frombuffer(x, np.uint8)
        at += n
    return codes, counts


@dataclass
class Model:
    names: list[str]
    network: Network | None
    window: int

    def predict(self, batch: list[str | None], rows: int = 1024) -> tuple[list[str], list[float]]:
        """The likeliest language after pooling all positions, and its pooled probability.

        The pool is the geometric mean of the positions' distributions, normalised, so that the score is the highest one.
        """
        data = [t.encode() if t is not None and has_letter(t) else b"" for t in batch]
        if self.network is None:
            return ["und"] * len(data), [0.0] * len(data)
        codes, counts = windows(data, self.window)
        pooled = np.zeros((len(data), len(self.names)))
        owner = np.repeat(np.arange(len(data)), counts)
        for at in range(0, len(codes), rows):
            some = codes[at : at + rows]
            logp = self.network.log_probabilities(self.network.read(some))
            real = (some != PAD).T[:, None, :]
            np.add.at(pooled, owner[at : at + rows], (logp * real).sum(axis=0, dtype=np.float64).T)
        pooled /= np.maximum(1, [len(x) for x in data])[:, None]
        pooled = np.exp(pooled - pooled.max(axis=1, keepdims=True))
        best = pooled.argmax(axis=1)
        score = (pooled.max(axis=1) / pooled.sum(axis=1)).clip(0, 1)
        return (
            [self.names[b] if x else "und" for b, x in zip(best, data, strict=True)],
            [round(float(s), 6) if x else 0.0 for s, x in zip(score, data, strict=True)],
        )


def held_out(id_col: str = "doc_id") -> Column:
    return F.coalesce(F.pmod(F.crc32(F.col(id_col).cast("string").cast("binary")), F.lit(5)) == 0, F.lit(False))


def sample(docs: DataFrame, s: Settings, id_col: str, text_col: str, lang_col: str) -> list[tuple[str, str]]:
    """(text piece, language) from at most `docs` documents of every language, chosen by the hash of their id.

    Languages are counted first, so that a scan keeps about twice as many rows of each as are wanted, all of a rare one; only
    those are cut into pieces, shuffled and ranked. The driver holds the languages' names, as the network does.
    """
    rows = docs.select(
        F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang")
    ).where(F.col("lang").isNotNull() & F.col("text").isNotNull() & F.col("doc_id").isNotNull() & ~held_out("doc_id"))
    counts = {r.lang: r["count"] for r in rows.groupBy("lang").count().collect()}
    if len(counts) > s.most:
        raise ValueError(f"{len(counts)} languages, more than {s.most} documents to learn from")
    docs_each = max(1, min(s.docs, s.most // max(1, len(counts))))
    wanted = 2 * max(docs_each, 50)  # of so many drawn by hash, enough are left whatever the hash does
    crowded = {lang: wanted / n for lang, n in counts.items() if n > wanted}
    if crowded:
        share = F.create_map(*[F.lit(x) for pair in sorted(crowded.items()) for x in pair])[F.col("lang")]
        drawn = F.pmod(F.xxhash64(F.lit(5), "doc_id"), F.lit(1 << 30)) / float(1 << 30)
        rows = rows.where(F.coalesce(drawn < share, F.lit(True)))
    place = [
        F.substring("text", F.pmod(F.xxhash64(F.lit(i), "doc_id"), F.greatest(F.char_length("text") - s.length, F.lit(1))).cast("int") + 1, F.lit(s.length))
        for i in range(s.pieces)
    ]
    cut = rows.select("lang", "doc_id", F.array(*place).alias("pieces"))
    cut = cut.withColumn("rank", F.expr("row_number() over (partition by lang order by xxhash64(doc_id), doc_id, pieces)"))
    found = cut.where(F.col("rank") <= docs_each).select("lang", F.explode("pieces").alias("piece"))
    return sorted((r.piece, r.lang) for r in found.collect() if has_letter(r.piece))


def train(examples: list[tuple[str, str]], s: Settings) -> Model:
    names = sorted({lang for _, lang in examples})
    if not names:
        return Model([], None, s.window)
    codes, counts = windows([piece.encode() for piece, _ in examples], s.window)
    labels = np.repeat([names.index(lang) for _, lang in examples], counts)
    rng, network = np.random.default_rng(s.seed), Network(len(names), s.hidden, s.seed)
    by_class = [np.flatnonzero(labels == k) for k in range(len(names))]
    adam = Adam(network.p, s.rate, s.steps)
    for _ in range(s.steps):  # every language as often as any other
        picked = np.concatenate([rng.choice(some, -(-s.batch // len(names))) for some in by_class])
        adam.update(network.gradient(codes[picked].astype(np.int64), labels[picked])[1])
    return Model(names, network, s.window)


def identify(
    docs: DataFrame,
    settings: Settings | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    rows: bool = False,
) -> DataFrame:
    """Columns doc_id, held_out, lang_pred, score (with `rows`, also row: the input row); one row per input row.

    Fits a network on a bounded sample of labelled pieces (see Settings) of documents that are not held out, then reads
    every byte of every text in windows; each position is labelled, the document takes the language with the highest
    geometric mean over all positions, and its share of all languages' as score.

    NULL texts and texts without a letter are 'und' with score 0, and so is everything if no label
    is there to learn from. NULL ids are neither held out nor learned from. Ties go to the
    first language by name; repeated rows get the same result. Other columns are not read.
    """
    s = settings or Settings()
    model = train(sample(docs, s, id_col, text_col, lang_col), s)

    def work(batches):
        for ids, found in batches:
            lang, score = model.predict(found)
            yield {"doc_id": ids, "lang_pred": lang, "score": score}

    base = docs.select(F.struct("*").alias("row"), *named(id_col, text_col)) if rows else texts(docs, id_col, text_col)
    found = map_texts(base, work, "doc_id bigint, lang_pred string, score double")
    return found.select("doc_id", held_out().alias("held_out"), "lang_pred", "score", *["row"] * rows)
