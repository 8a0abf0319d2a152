"""Byte-level BPE with the tokenizers library: ids, byte offsets and back."""

from __future__ import annotations

import base64
import codecs
import os
from array import array
from collections.abc import Iterable, Iterator
from itertools import chain

import numpy as np
import regex
from pyspark.sql import DataFrame
from tokenizers import Regex, Tokenizer, decoders, models, pre_tokenizers

from rollmill.llm.common import map_texts, texts


def byte_characters() -> dict[int, str]:
    """The character that stands for each byte in a byte-level vocabulary: itself if printable, else from 256 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}


def read_ranks(lines: bytes) -> dict[bytes, int]:
    return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines.splitlines())}


def merge_parts(token: bytes, ranks: dict[bytes, int]) -> tuple[bytes, bytes] | None:
    """The two parts from which `token` is merged, by merging lower ranks first; None for bytes."""
    parts, limit = [bytes([b]) for b in token], ranks[token]
    while len(parts) > 2:
        low, at = min((ranks.get(a + b, limit), i) for i, (a, b) in enumerate(zip(parts, parts[1:], strict=False)))
        if low >= limit:
            return None
        parts[at : at + 2] = [parts[at] + parts[at + 1]]
    return (parts[0], parts[1]) if len(parts) == 2 else None


def build_tokenizer(ranks: dict[bytes, int], pattern: str) -> Tokenizer:
    """A byte-level BPE tokenizer that gives the ids of `ranks`.

    A match of the pattern that is itself a token stays whole; others are merged by rank.
    """
    shown = byte_characters()
    name = {token: "".join(shown[b] for b in token) for token in ranks}
    pairs = ((merge_parts(token, ranks), rank) for token, rank in ranks.items())
    merges = [(name[p[0]], name[p[1]]) for p, _ in sorted((x for x in pairs if x[0]), key=lambda x: x[1])]
    model = models.BPE(vocab={name[t]: r for t, r in ranks.items()}, merges=merges, ignore_merges=True)
    tokenizer = Tokenizer(model)
    tokenizer.pre_tokenizer = pre_tokenizers.Sequence(
        [pre_tokenizers.Split(Regex(pattern), "isolated"), pre_tokenizers.ByteLevel(False, use_regex=False)]
    )
    tokenizer.decoder = decoders.ByteLevel()
    tokenizer.encode_special_tokens = True
    return tokenizer


class Coder:
    """Encodes and decodes whole texts; made inside a task from the tokenizer's JSON and the pattern."""

    #: matches remembered with their ids; beyond it the memory starts anew
    MEMORY = 300_000

    def __init__(self, tokenizer: Tokenizer, pattern: str):
        self.split = regex.compile(pattern)
        self.model = tokenizer.model
        shown = byte_characters()
        self.as_characters = str.maketrans({chr(b): c for b, c in shown.items()})
        back = {c: b for b, c in shown.items()}
        vocab = sorted(tokenizer.get_vocab().items(), key=lambda x: x[1])
        self.bytes_of = {i: bytes(map(back.__getitem__, token)) for token, i in vocab}
        self.known: dict[str, bytes] = {}

    def encode(self, batch: list[str]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers.

        Each distinct match of the pattern goes through the model once, its bytes shown as characters.
        """
        pieces = [self.split.findall(text) for text in batch]
        if len(self.known) > self.MEMORY:
            self.known.clear()
        for piece in set(chain.from_iterable(pieces)).difference(self.known):
            shown = piece.encode().decode("latin-1").translate(self.as_characters)
            self.known[piece] = array("I", [token.id for token in self.model.tokenize(shown)]).tobytes()
        return [b"".join(map(self.known.__getitem__, some)) for some in pieces]

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, memoryview(ids).cast("I")))

    def offsets(self, ids: bytes) -> list[tuple[int, int]]:
        """(start, end) of each token in code points of the decoded text.

        A token that holds a part of a character spans the whole of it, so tokens that share one overlap.
        """
        tokens = [self.bytes_of[i] for i in memoryview(ids).cast("I")]
        first = np.frombuffer(b"".join(tokens), np.uint8) & 0xC0 != 0x80
        before = np.concatenate([[0], np.cumsum(first)])  # characters begun before each byte
        ends = np.cumsum([len(t) for t in tokens], dtype=np.int64)
        starts = ends - [len(t) for t in tokens]
        inside = [s < len(first) and not first[s] for s in starts]
        return list(zip((before[starts] - inside).tolist(), before[ends].tolist(), strict=True))


def stream_text(chunks: Iterable[bytes]) -> Iterator[str]:
    """Decoded text chunk by chunk; a character split over tokens comes with its last byte, a broken one as U+FFFD."""
    decoder = codecs.getincrementaldecoder("utf-8")("replace")
    for chunk in chunks:
        yield decoder.decode(chunk)
    yield decoder.decode(b"", final=True)


def encode_documents(
    docs: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Columns doc_id, ids (binary, little-endian unsigned 32-bit), decoded (binary); one row per input row.

    NULL and empty texts have no ids. Texts are encoded whole, whatever their length; repeated rows alike. Other columns
    are not read. Empty tables give no rows. The vocabulary is read by the driver and sent with the tasks.
    """
    with open(ranks_path, "rb") as f:
        tokenizer = build_tokenizer(read_ranks(f.read()), pattern)
    sent = docs.sparkSession.sparkContext.broadcast(tokenizer.to_str())

    def work(batches):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        coder = Coder(Tokenizer.from_str(sent.value), pattern)
        for doc_ids, found in batches:
            ids = coder.encode([t or "" for t in found])
            yield {"doc_id": doc_ids, "ids": ids, "decoded": [coder.decode(x) for x in ids]}

    return map_texts(texts(docs, id_col, text_col), work, "doc_id bigint, ids binary, decoded binary")
