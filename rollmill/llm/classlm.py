"""Class-based n-gram scoring: exchange clustering, class transitions, word emissions."""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollmill.llm.common import arrow_schema, small, texts, written

CHUNK_BYTES = 8 << 20
CHUNK_DOCS = 50_000
#: Words with more than this share of the training tokens are frequent; fewer than SHARE_BOUND words can have it.
SHARE_BOUND = 20_000
#: Rarer words are clustered from this count on. Words met once, like words never met, are classed by shape: the model of unknown words.
LEAST_COUNT = 2
CLASSES = 48
DISCOUNT = 0.75
SMOOTH = 0.1
# Shapes: length, characters beyond ASCII, punctuation at the end.
LENGTHS = 5
SHAPES = 4 * LENGTHS
PUNCTUATED = r"""[.,;:!?|)\]}"']$"""
K = CLASSES + SHAPES + 1
FIRST = 256  # added to the class on one row of every word
#: Units of the bigram table: frequent words from 0, then shapes, then the end, which also stands before a text.
END = SHARE_BOUND + SHAPES

CHUNK_SCHEMA = (
    "chunk bigint, words array<string>, n array<bigint>, doc_ids array<bigint>, held array<boolean>, "
    "lengths array<int>, codes binary, tokens bigint, learned bigint"
)
#: A chunk without its words: their number, and places and units of the frequent ones.
LIGHT_SCHEMA = (
    "chunk bigint, words int, doc_ids array<bigint>, held array<boolean>, lengths array<int>, codes binary, places array<int>, units array<int>"
)
PLACED_SCHEMA = "of bigint, at int, n bigint, class smallint"
CODED_SCHEMA = (
    "doc_ids array<bigint>, held array<boolean>, lengths array<int>, codes binary, counts array<bigint>, classes binary, "
    "kinds array<bigint>, mass array<bigint>"
)
SCORE_SCHEMA = "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, base_score double, score double"


def held_out(id_col: str = "doc_id"):
    return F.coalesce(F.pmod(F.crc32(F.col(id_col).cast("string").cast("binary")), F.lit(7)) == 2, F.lit(False))


def tokenised(found: pa.Array) -> tuple[pa.DictionaryArray, np.ndarray]:
    """All words of all texts, lower case, as a dictionary array; and the number of words of each text."""
    split = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(found.cast(pa.large_string()), "")))
    owner, words = pc.list_parent_indices(split), pc.list_flatten(split)
    real = pc.greater(pc.binary_length(words), 0)
    counts = np.bincount(owner.filter(real).to_numpy(), minlength=len(found))
    return words.filter(real).dictionary_encode(), counts


def shape_codes(words: pa.Array) -> np.ndarray:
    length = pc.utf8_length(words).to_numpy(zero_copy_only=False)
    beyond = pc.binary_length(words).to_numpy(zero_copy_only=False) != length
    ended = pc.match_substring_regex(words, PUNCTUATED).to_numpy(zero_copy_only=False)
    return np.minimum((length - 1) // 3, LENGTHS - 1) + LENGTHS * (beyond + 2 * ended.astype(np.int64))


def squeeze(codes: np.ndarray) -> bytes:
    """32-bit codes, mostly small, byte plane by byte plane."""
    planes = codes.astype("<i4").view(np.uint8).reshape(-1, 4).T
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(planes).tobytes())


def unsqueeze(data: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8).reshape(4, -1)
    return np.ascontiguousarray(planes.T).view("<i4").ravel()


def chunks(docs: DataFrame) -> DataFrame:
    """One row for every CHUNK_BYTES of text: its words, each document's words as indices into them, training counts `n`,
    training tokens without ends, and training documents."""
    frame = docs.select("doc_id", "text", held_out().alias("held"))
    schema = arrow_schema(frame.sparkSession, CHUNK_SCHEMA)

    def packed(some: list[pa.RecordBatch], number: int) -> pa.RecordBatch:
        whole = pa.Table.from_batches(some).combine_chunks()
        ids, found, held = (whole.column(i).combine_chunks() for i in range(3))
        words, lengths = tokenised(found)
        codes = words.indices.to_numpy()
        order = np.argsort(-np.bincount(codes, minlength=len(words.dictionary)), kind="stable")
        codes = np.argsort(order)[codes]  # frequent words have small codes
        learned = np.repeat(~held.to_numpy(zero_copy_only=False).astype(bool), lengths)
        n = np.bincount(codes[learned], minlength=len(order))
        row = {
            "chunk": [(TaskContext.get().partitionId() << 32) + number],
            "words": one_list(words.dictionary.take(pa.array(order)).cast(pa.string())),
            "n": one_list(pa.array(n, pa.int64())),
            "doc_ids": one_list(ids),
            "held": one_list(held),
            "lengths": one_list(pa.array(lengths, pa.int32())),
            "codes": [squeeze(codes)],
            "tokens": [int(n.sum())],
            "learned": [len(held) - held.true_count],
        }
        return pa.RecordBatch.from_arrays([pa.array(v) if isinstance(v, list) else v for v in row.values()], schema=schema)

    def run(batches):
        some, size, number = [], 0, 0
        for b in small(batches, 64):
            some.append(b)
            size += b.nbytes + b.num_rows * CHUNK_BYTES // CHUNK_DOCS
            if size >= CHUNK_BYTES:
                yield packed(some, number)
                some, size, number = [], 0, number + 1
        if some:
            yield packed(some, number)

    return frame.mapInArrow(run, CHUNK_SCHEMA)


def one_list(values: pa.Array) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)


def pair_counts(table: DataFrame, index: dict[str, int]) -> DataFrame:
    """a, b, n: how often unit b follows unit a in the training documents."""
    names = pa.array(list(index), pa.string())

    def pairs(row) -> tuple[np.ndarray, np.ndarray]:
        lengths = np.asarray(row["lengths"].values.to_numpy(), np.int64)
        units = units_of(row["words"].values, names)[unsqueeze(row["codes"].as_py())]
        sequence, ends = with_ends(units, lengths, END)
        learned = np.repeat(~row["held"].values.to_numpy(zero_copy_only=False).astype(bool), lengths + 1)
        before = np.concatenate([[END], sequence[:-1]])  # an end precedes every text
        return np.unique((before * (END + 1) + sequence)[learned], return_counts=True)

    def run(batches):
        for b in batches:
            for i in range(b.num_rows):
                keys, n = pairs({name: b.column(name)[i] for name in b.schema.names})
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys // (END + 1), pa.int32()), pa.array(keys % (END + 1), pa.int32()), pa.array(n, pa.int64())],
                    names=["a", "b", "n"],
                )

    counted = table.select("words", "held", "lengths", "codes").mapInArrow(run, "a int, b int, n bigint")
    return counted.groupBy("a", "b").agg(F.sum("n").alias("n"))


def units_of(words: pa.Array, names: pa.Array) -> np.ndarray:
    at = pc.index_in(words, names)
    known = pc.fill_null(at, -1).to_numpy(zero_copy_only=False).astype(np.int64)
    return np.where(known >= 0, known, SHARE_BOUND + shape_codes(words))


def with_ends(values: np.ndarray, lengths: np.ndarray, end) -> tuple[np.ndarray, np.ndarray]:
    """The texts' values with `end` after each text, and the places of the ends."""
    places = np.cumsum(lengths + 1) - 1
    out = np.empty(len(values) + len(lengths), values.dtype)
    inner = np.ones(len(out), bool)
    inner[places] = False
    out[inner], out[places] = values, end
    return out, places


def exchange(pairs: DataFrame, frequent: int, gain: float) -> np.ndarray:
    """Class of each unit (array of END + 1). Frequent words start spread by rank and change classes, all those of one parity
    at a time, to where their neighbours' classes make the training text likeliest; shapes and the end keep their own.

    Every turn is a few aggregations of the bigram table; the driver gets one class per frequent word
    (fewer than SHARE_BOUND) and the class bigrams. It ends once a pass over both parities raises the log-likelihood by less than
    `gain` of its size; the likeliest classes met are returned.
    """
    spark, k = pairs.sparkSession, K
    classes = np.full(END + 1, -1, np.int64)
    classes[:frequent] = np.arange(frequent) % CLASSES
    classes[SHARE_BOUND : END + 1] = CLASSES + np.arange(SHAPES + 1)
    mapped = class_frame(spark, classes, frequent)
    matrix = class_bigrams(pairs, mapped, k)
    best, kept = likelihood(matrix), classes.copy()
    while frequent:
        before = best
        for parity in (0, 1):
            right = pairs.where(f"a < {frequent}").join(F.broadcast(mapped), pairs.b == mapped.unit)
            left = pairs.where(f"b < {frequent}").join(F.broadcast(mapped), pairs.a == mapped.unit)
            context = right.groupBy(F.col("a").alias("word"), F.lit(0).alias("side"), "class").agg(F.sum("n").alias("n"))
            context = context.union(left.groupBy(F.col("b").alias("word"), F.lit(1).alias("side"), "class").agg(F.sum("n")))
            chosen = context.where(F.pmod(F.col("word").bitwiseXOR(F.shiftright("word", 3)), F.lit(2)) == parity)
            for r in chosen.groupBy(F.pmod("word", F.lit(64))).applyInPandas(mover(matrix), "word int, class int").collect():
                classes[r["word"]] = r["class"]
            mapped = class_frame(spark, classes, frequent)
            matrix = class_bigrams(pairs, mapped, k)
            total = likelihood(matrix)
            if total > best:
                best, kept = total, classes.copy()
        if best - before <= gain * abs(before):
            return kept
    return kept


def gains(matrix: np.ndarray, after: np.ndarray, before: np.ndarray) -> np.ndarray:
    """Per word and class: what the word's neighbours add to the log-likelihood if the word is in the class.

    after, before: how often each class stands after and before the words.
    """
    log, log_n = np.log(matrix + 0.5), np.log(matrix.sum(axis=1) + 0.5 * len(matrix))
    return np.round(after @ log.T + before @ log - 2 * after.sum(axis=1)[:, None] * log_n, 6)[:, :CLASSES]


def mover(matrix: np.ndarray):
    """The best class of each word of a group, from how often it meets each class on either side."""

    def moved(pdf: pd.DataFrame) -> pd.DataFrame:
        words, at = np.unique(pdf["word"].to_numpy(), return_inverse=True)
        sides = np.zeros((2, len(words), len(matrix)))
        np.add.at(sides, (pdf["side"].to_numpy(), at, pdf["class"].to_numpy()), pdf["n"].to_numpy())
        return pd.DataFrame({"word": words, "class": gains(matrix, *sides).argmax(axis=1)})

    return moved


def class_frame(spark, classes: np.ndarray, frequent: int) -> DataFrame:
    units = [*range(frequent), *range(SHARE_BOUND, END + 1)]
    return spark.createDataFrame([(u, int(classes[u])) for u in units], "unit int, class int")


def class_bigrams(pairs: DataFrame, mapped: DataFrame, k: int) -> np.ndarray:
    first, second = F.broadcast(mapped.toDF("a", "ca")), F.broadcast(mapped.toDF("b", "cb"))
    matrix = np.zeros((k, k))
    for r in pairs.join(first, "a").join(second, "b").groupBy("ca", "cb").agg(F.sum("n").alias("n")).collect():
        matrix[r.ca, r.cb] = r.n
    return matrix


def likelihood(matrix: np.ndarray) -> float:
    """Log-likelihood of the class sequence's training text, up to a constant."""

    def x_log_x(x):
        return float((x * np.log(np.maximum(x, 1))).sum())

    return x_log_x(matrix) - x_log_x(matrix.sum(axis=0)) - x_log_x(matrix.sum(axis=1))


@dataclass
class Frequent:
    tokens: int  # N: training tokens, ends included
    docs: int  # training documents: the count of the end
    names: list[str]  # frequent words, by rank
    n: np.ndarray  # their counts
    classes: np.ndarray  # class of each unit
    matrix: np.ndarray  # class bigrams, rarer words classed by shape

    def index(self) -> pa.Array:
        return pa.array(self.names, pa.string())


def cluster_frequent(table: DataFrame, gain: float, share: int = SHARE_BOUND) -> Frequent:
    """Exchange clustering of the words with more than 1 / share of the training tokens.

    Counts that make up a tenth of that share of their own chunk are summed first: what they leave out of a word is at most a tenth of the share
    of all tokens, so every frequent word sums to nine tenths of it. Only those words are then counted exactly.
    """
    facts = table.agg(F.sum("tokens").alias("t"), F.sum("learned").alias("d")).first()
    docs = int(facts.d or 0)
    tokens = int(facts.t or 0) + docs
    often = table.select(F.expr(f"inline(filter(arrays_zip(words, n), x -> x.n * {10 * share} > tokens))").alias("word", "n"))
    likely = often.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") * F.lit(10 * share) > F.lit(9 * tokens)).select("word")
    counted = table.select(F.expr("inline(arrays_zip(words, n))").alias("word", "n"))
    counted = counted.join(F.broadcast(written(likely, "likely")), "word", "left_semi")  # at most share / 0.9 words
    counted = counted.groupBy("word").agg(F.sum("n").alias("n"))
    # fewer than SHARE_BOUND words can have more than 1 / SHARE_BOUND of all tokens
    rows = counted.where(F.col("n") * F.lit(share) > F.lit(tokens)).orderBy(F.desc("n"), "word").collect()
    names = [r.word for r in rows]
    pairs = written(pair_counts(table, {w: i for i, w in enumerate(names)}), "pairs")
    classes = exchange(pairs, len(names), gain)
    matrix = class_bigrams(pairs, class_frame(table.sparkSession, classes, len(names)), K)
    return Frequent(tokens, docs, names, np.array([r.n for r in rows], np.int64), classes, matrix)


def neighbours(table: DataFrame, known: Frequent) -> DataFrame:
    """word, of, at, seen: every rarer word of every chunk, with one byte for each class after (c) and before (K + c) it in training."""

    names, classes = known.index(), known.classes

    def of_chunk(row) -> pa.RecordBatch:
        words, codes = row["words"].values, unsqueeze(row["codes"].as_py())
        lengths = np.asarray(row["lengths"].values.to_numpy(), np.int64)
        units = units_of(words, names)
        sequence, _ = with_ends(codes, lengths, len(words))
        path = np.append(classes[units], classes[END])[sequence]
        learned = np.repeat(~row["held"].values.to_numpy(zero_copy_only=False).astype(bool), lengths + 1)
        rarer = np.append(units >= SHARE_BOUND, False)
        places = np.flatnonzero(rarer[sequence] & learned)
        places = places[np.argsort(sequence[places], kind="stable")]
        end = classes[END]
        before = np.concatenate([[end], path[:-1]])
        after = np.concatenate([path[1:], [end]])
        seen = np.stack([after[places], before[places] + K], axis=1).astype(np.uint8)
        at = np.flatnonzero(rarer)
        ends = np.cumsum(2 * np.bincount(sequence[places], minlength=len(words) + 1)[at])
        offsets = pa.py_buffer(np.concatenate([[0], ends]).astype(np.int32).tobytes())
        packed = pa.Array.from_buffers(pa.binary(), len(at), [None, offsets, pa.py_buffer(seen.tobytes())])
        of = pa.array(np.full(len(at), row["chunk"].as_py(), np.int64))
        return pa.RecordBatch.from_arrays([words.take(pa.array(at)), of, pa.array(at, pa.int32()), packed], ["word", "of", "at", "seen"])

    def run(batches):
        for b in batches:
            for i in range(b.num_rows):
                yield of_chunk({name: b.column(name)[i] for name in b.schema.names})

    read = table.select("chunk", "words", "held", "lengths", "codes")
    return read.mapInArrow(run, "word string, of bigint, at int, seen binary")


def histograms(seen: pa.BinaryArray, runs: np.ndarray) -> np.ndarray:
    """How often each byte below 2 * K occurs in each run of rows."""
    offsets = np.frombuffer(seen.buffers()[1], np.int32)[seen.offset : seen.offset + len(seen) + 1]
    data = np.frombuffer(seen.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]]
    keys = np.repeat(runs, np.diff(offsets)) * (2 * K) + data
    return np.bincount(keys, minlength=(runs[-1] + 1) * 2 * K).reshape(-1, 2 * K)


def placing(matrix: np.ndarray):
    """Batches of neighbours, sorted by word, to rows (of, at, n, class)."""

    def run(batches):
        word, held, seen = None, [], np.zeros((1, 2 * K), np.int64)  # of the last word so far

        def finished(names, hist, runs):
            of, at = (np.concatenate(x) for x in zip(*held, strict=True))
            n = hist.sum(axis=1) // 2
            best = gains(matrix, hist[:, :K], hist[:, K:]).argmax(axis=1)
            classes = np.where(n >= LEAST_COUNT, best, CLASSES + shape_codes(names))
            first = np.concatenate([[True], runs[1:] != runs[:-1]])
            arrays = [pa.array(of), pa.array(at), pa.array(n[runs]), pa.array((classes[runs] + FIRST * first).astype(np.int16))]
            return pa.RecordBatch.from_arrays(arrays, ["of", "at", "n", "class"])

        for b in batches:
            if not b.num_rows:
                continue
            names, of, at = b.column(0), b.column(1).to_numpy(), b.column(2).to_numpy()
            new = pc.not_equal(names.slice(1), names.slice(0, len(names) - 1)).to_numpy(zero_copy_only=False)
            runs = np.concatenate([[0], np.cumsum(new)]).astype(np.int64)
            hist = histograms(b.column(3), runs)
            if word is not None and names[0].as_py() == word:
                hist[0] += seen[0]
            elif word is not None:
                yield finished(pa.array([word]), seen, np.zeros(sum(len(x[0]) for x in held), np.int64))
                held = []
            last = int(np.searchsorted(runs, runs[-1]))  # the last word may go on in the next batch
            if last:
                every = np.concatenate([np.zeros(sum(len(x[0]) for x in held), np.int64), runs[:last]])
                held.append((of[:last], at[:last]))
                yield finished(names.take(pa.array(np.flatnonzero(np.concatenate([[True], new]))[:-1])), hist[:-1], every)
                held = []
            held.append((of[last:], at[last:]))
            word, seen = names[len(names) - 1].as_py(), hist[-1:]
        if word is not None:
            yield finished(pa.array([word]), seen, np.zeros(sum(len(x[0]) for x in held), np.int64))

    return run


def place(met: DataFrame, matrix: np.ndarray) -> DataFrame:
    """of, at, n, class: count and class of every rarer word, on each of its rows; one row of each word has FIRST added.

    Words lie sorted in a partition. A word's rows are at most one per chunk and none is a large share of all; its neighbours are
    summed as they come, and only its places are held until its last row.
    """
    sorted_words = met.repartition("word").sortWithinPartitions("word")
    return sorted_words.mapInArrow(placing(matrix), PLACED_SCHEMA)


def coded(table: DataFrame, placed: DataFrame, known: Frequent) -> DataFrame:
    """Chunks with count and class of each word; kinds and mass: new words by class, and their training tokens."""
    schema = arrow_schema(table.sparkSession, CODED_SCHEMA)
    light_schema = arrow_schema(table.sparkSession, LIGHT_SCHEMA)
    names, counts_of, classes_of = known.index(), known.n, known.classes

    def without_words(batches):
        for b in batches:
            for i in range(b.num_rows):
                row = {name: b.column(name)[i] for name in b.schema.names}
                units = pc.index_in(row["words"].values, names)
                often = pc.is_valid(units)
                places = pa.array(np.flatnonzero(often.to_numpy(zero_copy_only=False)).astype(np.int32))
                lists = [one_list(x) for x in (row["doc_ids"].values, row["held"].values, row["lengths"].values)]
                arrays = [pa.array([row["chunk"].as_py()]), pa.array([len(units)], pa.int32()), *lists]
                arrays += [pa.array([row["codes"].as_py()]), one_list(places), one_list(units.filter(often))]
                yield pa.RecordBatch.from_arrays(arrays, schema=light_schema)

    def one(chunk: pa.Table, facts: pa.Table) -> pa.Table:
        if not chunk.num_rows:
            return schema.empty_table()
        row = {name: chunk.column(name)[0] for name in chunk.column_names}
        counts, classes = np.zeros((2, row["words"].as_py()), np.int64)
        places, units = row["places"].values.to_numpy(), row["units"].values.to_numpy()
        counts[places], classes[places] = counts_of[units], classes_of[units]
        at, n = facts.column("at").to_numpy(), facts.column("n").to_numpy()
        found = facts.column("class").to_numpy().astype(np.int64)
        counts[at], classes[at] = n, found % FIRST
        new = (found >= FIRST) & (n > 0)
        kinds = np.bincount(found[new] % FIRST, minlength=K)
        mass = np.bincount(found[new] % FIRST, weights=n[new], minlength=K).astype(np.int64)
        out = {
            "doc_ids": one_list(row["doc_ids"].values),
            "held": one_list(row["held"].values),
            "lengths": one_list(row["lengths"].values),
            "codes": [row["codes"].as_py()],
            "counts": one_list(pa.array(counts)),
            "classes": [classes.astype(np.uint8).tobytes()],
            "kinds": one_list(pa.array(kinds)),
            "mass": one_list(pa.array(mass)),
        }
        return pa.Table.from_arrays([pa.array(v) if isinstance(v, list) else v for v in out.values()], schema=schema)

    light = table.select("chunk", "words", "doc_ids", "held", "lengths", "codes").mapInArrow(without_words, LIGHT_SCHEMA)
    return light.groupBy("chunk").cogroup(placed.groupBy("of")).applyInArrow(one, CODED_SCHEMA)


def transitions(table: DataFrame) -> np.ndarray:
    """Class bigrams of the training documents of coded chunks."""

    def run(batches):
        matrix = np.zeros(K * K, np.int64)
        for b in batches:
            for i in range(b.num_rows):
                lengths = np.asarray(b.column("lengths")[i].values.to_numpy(), np.int64)
                classes = np.frombuffer(b.column("classes")[i].as_py(), np.uint8).astype(np.int64)
                sequence, _ = with_ends(classes[unsqueeze(b.column("codes")[i].as_py())], lengths, K - 1)
                held = b.column("held")[i].values.to_numpy(zero_copy_only=False).astype(bool)
                before = np.concatenate([[K - 1], sequence[:-1]])
                matrix += np.bincount((before * K + sequence)[np.repeat(~held, lengths + 1)], minlength=K * K)
        cells = np.flatnonzero(matrix)
        yield pa.RecordBatch.from_arrays([pa.array(cells, pa.int32()), pa.array(matrix[cells])], ["cell", "n"])

    matrix = np.zeros(K * K)
    parts = table.select("lengths", "held", "classes", "codes").mapInArrow(run, "cell int, n bigint")
    for r in parts.groupBy("cell").agg(F.sum("n").alias("n")).collect():  # K * K rows at most
        matrix[r.cell] = r.n
    return matrix.reshape(K, K)


@dataclass
class Model:
    tokens: int  # N: training tokens, ends included
    words: int  # V: distinct ones, the end included
    docs: int  # training documents: the count of the end
    moves: np.ndarray  # log10 probability of class to class
    total: np.ndarray  # training tokens of each class
    kinds: np.ndarray  # distinct training words of each class

    def score(self, of_word: np.ndarray, counts: np.ndarray, codes: np.ndarray, lengths: np.ndarray) -> dict[str, np.ndarray]:
        """Per text: tokens, known tokens, log10 of the unigram base and of the class model. of_word, counts: by word; codes: words in order."""
        total, kinds = self.total[of_word], self.kinds[of_word]
        rest = DISCOUNT * kinds / np.maximum(total, 1) / (kinds + 1)
        emit = np.where(total > 0, np.maximum(counts - DISCOUNT, 0) / np.maximum(total, 1) + rest, 1 / (self.words + 1))
        base = np.log10((counts + 1) / (self.tokens + self.words + 1))
        sequence, places = with_ends(of_word[codes], lengths, K - 1)
        before = np.concatenate([[K - 1], sequence[:-1]])
        emitted, _ = with_ends(np.log10(emit)[codes], lengths, 0.0)
        based, _ = with_ends(base[codes], lengths, math.log10((self.docs + 1) / (self.tokens + self.words + 1)))
        known, _ = with_ends((counts[codes] > 0).astype(np.int64), lengths, int(self.docs > 0))
        starts = places - lengths

        def per_text(x):
            return np.add.reduceat(x, starts) if len(starts) else x

        return {
            "n_tokens": lengths + 1,
            "n_known": per_text(known),
            "base_score": per_text(based),
            "score": per_text(emitted + self.moves[before, sequence]),
        }


def fit(table: DataFrame, known: Frequent) -> Model:
    """The model of coded chunks."""
    kinds, total = np.bincount(known.classes[: len(known.names)], minlength=K).astype(float), np.zeros(K)
    np.add.at(total, known.classes[: len(known.names)], known.n)
    rows = table.select(F.expr("posexplode(arrays_zip(kinds, mass))").alias("class", "x")).groupBy("class")
    for r in rows.agg(F.sum("x.kinds").alias("kinds"), F.sum("x.mass").alias("mass")).collect():  # K rows
        kinds[r["class"]] += r.kinds
        total[r["class"]] += r.mass
    distinct = int(kinds.sum()) + (known.docs > 0)
    total[K - 1], kinds[K - 1] = known.docs, 1
    matrix = transitions(table)
    moves = np.log10((matrix + SMOOTH) / (matrix.sum(axis=1, keepdims=True) + SMOOTH * K))
    return Model(known.tokens, distinct, known.docs, moves, total, kinds)


def score_texts(
    docs: DataFrame, gain: float = 1e-3, id_col: str = "doc_id", text_col: str = "text", share: int = SHARE_BOUND
) -> DataFrame:
    """Columns doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score; one row per input row.

    Brown class model: P(text) is the product over its tokens of P(class | class before) P(token | class). Transitions are
    smoothed by SMOOTH; emissions take DISCOUNT off each training count and give it to all the class's words
    and one unknown word alike. base_score is the add-one unigram score.

    1. Texts are tokenised once, into chunks of bounded size that hold each distinct word once; written.
    2. Words with more than 1 / share (at least 1 / SHARE_BOUND) of the training tokens: their bigrams, with all other words by shape,
       are counted, and exchange clustering runs over them until a pass gains less than `gain`.
    3. Every other word met LEAST_COUNT times or more in training then takes its exchange step: one row per chunk brings the classes of its neighbours together,
       and the word goes to the class that makes them likeliest. Words met once, and those only met when scoring, keep the class of their shape.
    4. Counts and classes go back to the chunks, by their places; class bigrams are counted anew, and each chunk scores its texts.

    NULL and empty texts have one token, the end. Documents with a NULL id are not held out. Without training
    documents all counts are 0 and every class is as likely as any other. Repeated rows count as often
    as they occur and get the same scores. Other columns are not read; empty tables give no rows.
    """
    if share > SHARE_BOUND:
        raise ValueError(f"share must be at most {SHARE_BOUND}")
    table = written(chunks(texts(docs, id_col, text_col)), "chunks")
    known = cluster_frequent(table, gain, share)
    placed = place(neighbours(table, known), known.matrix)
    whole = written(coded(table, placed, known), "coded")
    model = fit(whole, known)
    schema = arrow_schema(docs.sparkSession, SCORE_SCHEMA)

    def run(batches):
        for b in batches:
            for i in range(b.num_rows):
                row = {name: b.column(name)[i] for name in b.schema.names}
                lengths = np.asarray(row["lengths"].values.to_numpy(), np.int64)
                classes = np.frombuffer(row["classes"].as_py(), np.uint8).astype(np.int64)
                out = model.score(classes, row["counts"].values.to_numpy(), unsqueeze(row["codes"].as_py()), lengths)
                yield pa.RecordBatch.from_pydict({"doc_id": row["doc_ids"].values, "held_out": row["held"].values, **out}, schema=schema)

    scored = whole.drop("kinds", "mass").mapInArrow(run, SCORE_SCHEMA)
    return scored.select(
        "doc_id", "held_out", "n_tokens", "n_known", F.lit(model.tokens).cast("bigint").alias("train_tokens"), "base_score", "score"
    )
