"""Count-based n-gram language models and log-likelihood scoring.

Several models are fitted in one pass: every n-gram carries one count column
per model, so all log-probs of a token come out of the same join.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rollmill.functions.numerics import words
from rollmill.plans.scale import attach, hot_and_rows, task_parts
from rollmill.plans.session import written

# Fixed value: context before the first token.
START = "<s>"

#: Bits of a filter over needed keys: 2^18 rows of 64 bits at most, whatever the input.
FILTER_BITS = 1 << 24

#: Where a model's documents are scored, and their tokens meet by context: rows of a task, about, and of a context that a task holds whole.
GATHER_ROWS = 1 << 21
GATHER_HOT = 1 << 20


@dataclass(frozen=True)
class NgramLM:
    """Models over one vocabulary of n-grams.

    ngrams:   (ctx, w, n_<model>...)  one row per distinct n-gram
    contexts: (ctx, n_<model>, seen_<model>, s_<model>...)  one row per context
    sizes:    one row, v_<model>: distinct words + 1 for unknown ones
    stored:   whether the n-grams are read from files
    rows:     (ctx, w, n_<model>...) before counting, one row per token, if the n-grams are counted from it
    ids:      further columns of `rows`, with pos, of the documents that are scored too; NULL in all others
    """

    models: tuple[str, ...]
    n: int
    add_k: float
    ngrams: DataFrame
    contexts: DataFrame
    sizes: DataFrame
    stored: bool = False
    rows: DataFrame | None = None
    ids: tuple[str, ...] = ()

    def save(self, path: str) -> NgramLM:
        """Write the count tables so later scoring starts from them."""
        self.ngrams.write.parquet(f"{path}/ngrams")
        return load_ngram_lm(self.ngrams.sparkSession, path, self.models, self.n, self.add_k)


def _context_and_words(df: DataFrame, text: str, prompt: str | None, n: int) -> DataFrame:
    """`_ctx` and `_w`: parallel arrays, built inside the row, for the words of `text` only.

    Prompt and answer are tokenised apart, so no token spans their boundary.
    """
    head = words(F.coalesce(F.col(prompt), F.lit(""))) if prompt else F.array().cast("array<string>")
    df = df.withColumn("_w", words(F.col(text))).withColumn("_p", head)
    df = df.withColumn("_all", F.concat(F.array_repeat(F.lit(START), n - 1), F.col("_p"), F.col("_w")))
    if n == 1:
        ctx = F.transform("_w", lambda t: F.lit(""))
    elif n == 2:
        ctx = F.slice("_all", F.size("_p") + 1, F.size("_w"))
    else:
        ctx = F.transform(
            "_w", lambda t, i: F.array_join(F.slice(F.col("_all"), F.size("_p") + i + 1, F.lit(n - 1)), " ")
        )
    return df.withColumn("_ctx", ctx).drop("_p", "_all")


def _zipped() -> Column:
    return F.arrays_zip(F.col("_ctx").alias("ctx"), F.col("_w").alias("w"))


def fit_ngram_lm(
    docs: DataFrame,
    text: str = "text",
    models: Mapping[str, Column] | None = None,
    n: int = 2,
    add_k: float = 0.5,
    weight: Column | None = None,
    prompt: str | None = None,
    ids: Sequence[str] = (),
    scored: Column | None = None,
) -> NgramLM:
    """L1: maximum-likelihood counts; `models` maps a name to the rows it is fitted on.

    Documents where `scored` holds are answers too, known by `ids`: `token_logp` may score them without splitting them again.
    """
    if add_k <= 0:
        raise ValueError("add_k must be positive: unseen words need some probability")
    models = dict(models or {"lm": F.lit(True)})
    weight = F.lit(1) if weight is None else weight
    flags = [F.when(cond, weight).otherwise(0).alias(f"n_{m}") for m, cond in models.items()]
    used = [*models.values(), *([scored] if ids else [])]
    rows = _context_and_words(docs.where(reduce(lambda a, b: a | b, used)), text, prompt, n)
    # stated once here, or Spark infers it in some readers of the counts only and cannot share their shuffle
    known = "ctx is not null and w is not null"
    if ids:
        kept = [F.when(scored, F.col(i)).alias(i) for i in ids]
        cells = rows.select(*flags, *kept, F.coalesce(scored, F.lit(False)).alias("_asked"), F.posexplode(_zipped()).alias("pos", "_t"))
        pos = F.when(F.col("_asked"), F.col("pos").cast("bigint")).alias("pos")
        tokens = cells.select(*[f"n_{m}" for m in models], *ids, pos, F.col("_t.ctx").alias("ctx"), F.col("_t.w").alias("w")).where(known)
    else:
        tokens = rows.select(*flags, F.inline(_zipped())).where(known)
    ngrams = tokens.groupBy("ctx", "w").agg(*[F.sum(f"n_{m}").alias(f"n_{m}") for m in models])
    return replace(counted(ngrams, tuple(models), n, add_k), rows=tokens, ids=tuple(ids))


def counted(ngrams: DataFrame, models: Sequence[str], n: int, add_k: float) -> NgramLM:
    per_word = [F.max(f"n_{m}").alias(f"n_{m}") for m in models]
    sizes = [(F.count_if(F.col(f"n_{m}") > 0) + 1).alias(f"v_{m}") for m in models]
    vocabulary = ngrams.groupBy("w").agg(*per_word)
    return NgramLM(tuple(models), n, add_k, ngrams, by_context(ngrams, models, add_k), vocabulary.agg(*sizes))


def by_context(ngrams: DataFrame, models: Sequence[str], add_k: float) -> DataFrame:
    facts = []
    for m in models:
        c = F.col(f"n_{m}")
        smooth = c + F.lit(float(add_k))
        facts += [
            F.sum(c).alias(f"n_{m}"),
            F.count_if(c > 0).alias(f"seen_{m}"),
            F.sum(F.when(c > 0, smooth * F.ln(smooth)).otherwise(0.0)).alias(f"s_{m}"),
        ]
    return ngrams.groupBy("ctx").agg(*facts)


def marked(table: DataFrame, needed: DataFrame, keys: Sequence[str], bits: int = FILTER_BITS) -> DataFrame:
    """The rows of `table` whose `keys` are in `needed`, and a few others; the keys are not NULL.

    The hashes of the needed keys set bits, 64 to a row. These rows, `bits` / 64 at most, are broadcast to the table, so that the
    others go before a shuffle. A key that shares its bit with a needed one stays.
    """
    if bits % 64:
        raise ValueError("bits come in rows of 64")
    at = F.pmod(F.xxhash64(*keys), F.lit(bits))
    places = needed.select(at.alias("at")).select(F.expr("at div 64").alias("_row"), F.expr("shiftleft(1L, int(at % 64))").alias("bit"))
    marks = places.groupBy("_row").agg(F.bit_or("bit").alias("_bits"))
    met = (F.floor(at / 64) == F.col("_row")) & (F.getbit("_bits", F.pmod(at, F.lit(64)).cast("int")) == 1)
    return table.join(F.broadcast(marks), met, "left_semi")


def narrowed(lm: NgramLM, needed: DataFrame, bits: int = FILTER_BITS) -> NgramLM:
    """A stored `lm` without most n-grams and contexts that `needed` (ctx, w) does not hold; the counts of those left are whole."""
    of_contexts = marked(lm.ngrams, needed, ["ctx"], bits)
    return replace(lm, ngrams=marked(lm.ngrams, needed, ["ctx", "w"], bits), contexts=by_context(of_contexts, lm.models, lm.add_k))


def counted_with(lm: NgramLM, needed: DataFrame) -> tuple[NgramLM, DataFrame]:
    """`lm` and the counts of the pairs `needed` (ctx, w), out of one count: needed pairs enter it as tokens of weight 0.

    They are counted like any other n-gram, where a join would sort them and all n-grams by their texts. The counts are written once:
    pairs, contexts and sizes read them, without counting again where Spark cannot share the shuffle. A context without tokens
    has sums of 0, as if it were missing.
    """
    ns = [f"n_{m}" for m in lm.models]
    known = lm.rows.select("ctx", "w", *ns, F.lit(0).alias("_asked"))
    asked = needed.select("ctx", "w", *[F.lit(0).alias(n) for n in ns], F.lit(1).alias("_asked"))
    sums = [F.sum(n).alias(n) for n in ns]
    both = known.unionByName(asked).groupBy("ctx", "w").agg(*sums, F.max("_asked").alias("_asked"))
    both = written(both, "ngrams", "zstd")
    return replace(counted(both, lm.models, lm.n, lm.add_k), rows=lm.rows), both.where("_asked = 1").drop("_asked")


def _per_model(lm: NgramLM, sizes: Column, entropy: bool) -> list[Column]:
    """ln P and, if asked, the entropy of the context, per model.

    A word or context a model never saw counts 0, which is also what its
    unknown-word entry would give.
    """
    k = F.lit(float(lm.add_k))
    out = []
    for m in lm.models:
        v = sizes[f"v_{m}"].cast("double")
        seen_n = F.coalesce(F.col(f"n_{m}"), F.lit(0))
        total = F.coalesce(F.col(f"ctx_n_{m}"), F.lit(0)) + k * v
        out.append(F.ln((seen_n + k) / total).alias(f"lp_{m}"))
        if entropy:
            n_ctx = F.coalesce(F.col(f"ctx_n_{m}"), F.lit(0))
            seen = F.coalesce(F.col(f"seen_{m}"), F.lit(0)).cast("double")
            s = F.coalesce(F.col(f"s_{m}"), F.lit(0.0))
            p0 = k / total
            of_seen = -(s - (n_ctx + k * seen) * F.ln(total)) / total
            out.append((of_seen - (v - seen) * p0 * F.ln(p0)).alias(f"h_{m}"))
    return out


def score_ngrams(lm: NgramLM, needed: DataFrame, entropy: bool = False, sizes: Column | None = None) -> DataFrame:
    """Log-probs of the distinct pairs among `needed` (ctx, w), which are not NULL; `sizes`: a struct, if not the model's own.

    A stored model's n-grams are filtered as they are read, and joined. Those still to be counted are counted together with the pairs.
    """
    if lm.rows is not None:
        lm, counts = counted_with(lm, needed)
    else:
        needed = needed.select("ctx", "w").distinct()
        lm = narrowed(lm, needed) if lm.stored else lm
        counts = needed.join(lm.ngrams, ["ctx", "w"], "left")
    contexts = lm.contexts.select(
        "ctx",
        *[F.col(f"n_{m}").alias(f"ctx_n_{m}") for m in lm.models],
        *[f"seen_{m}" for m in lm.models],
        *[f"s_{m}" for m in lm.models],
    )
    sizes = lm.sizes.select(F.struct("*")).scalar() if sizes is None else sizes
    return attach(counts, contexts, ["ctx"]).select("ctx", "w", *_per_model(lm, sizes, entropy))


def token_rows(samples: DataFrame, ids: Sequence[str], answer: str, prompt: str | None, n: int) -> DataFrame:
    """(ids, pos, ctx, w) of the answer's words; one row with NULLs for an empty answer."""
    arrays = _context_and_words(samples, answer, prompt, n).select(*ids, _zipped().alias("_z"))
    return arrays.select(*ids, F.posexplode_outer("_z").alias("pos", "_t")).select(
        *ids, F.col("pos").cast("bigint").alias("pos"), F.col("_t.ctx").alias("ctx"), F.col("_t.w").alias("w")
    )


def gathered(lm: NgramLM) -> DataFrame:
    """Tokens (ids, pos, ctx, w, lp_<model>) of the documents that a model still to be counted is to score, by one shuffle of its rows.

    Rows meet by context, where the counts of pairs and contexts are windows over the rows that lie together: pairs go neither
    to their contexts and back, nor to the tokens. Contexts of more than GATHER_HOT rows are counted in parts and joined.
    """
    ns, kept = [f"n_{m}" for m in lm.models], [*lm.ids, "pos"]
    hot, n_rows = hot_and_rows(lm.rows, ["ctx"], GATHER_HOT)
    is_hot = F.xxhash64("ctx").isin(hot)
    words = lm.rows.groupBy("w").agg(*[F.max(n).alias(n) for n in ns])
    found = words.agg(*[(F.count_if(F.col(n) > 0) + 1).alias(f"v_{m}") for n, m in zip(ns, lm.models, strict=True)]).first()
    sizes = F.struct(*[F.lit(v).alias(c) for c, v in found.asDict().items()])

    # one text a row takes less room than two, and behind the numbers, which change little; words hold no space
    pair, ctx = F.concat_ws(" ", "w", "ctx").alias("_pair"), F.expr("substring(_pair, instr(_pair, ' ') + 1)")
    near = (lm.rows.where(~is_hot) if hot else lm.rows).select(*ns, *kept, pair)
    parts = task_parts(lm.rows.sparkSession, n_rows, GATHER_ROWS)
    met = (near.repartition(parts, ctx) if parts else near.repartition(ctx)).withColumn("ctx", ctx)
    met = met.withColumns({f"_{n}": F.sum(n).over(Window.partitionBy("ctx", "_pair")) for n in ns})  # its sort serves both
    met = met.withColumns({f"ctx_{n}": F.sum(n).over(Window.partitionBy("ctx")) for n in ns}).where("pos is not null")
    met = met.drop(*ns).withColumnsRenamed({f"_{n}": n for n in ns}).withColumn("w", F.substring_index("_pair", " ", 1))
    scored = met.select(*kept, "ctx", "w", *_per_model(lm, sizes, False))
    if not hot:
        return scored
    known = lm.rows.where(is_hot)
    far = known.where("pos is not null").select(*kept, "ctx", "w")
    pairs = score_ngrams(replace(lm, rows=known), far.select("ctx", "w"), sizes=sizes)
    return scored.unionByName(attach(far, pairs, ["ctx", "w"]))


def token_logp(
    lm: NgramLM,
    samples: DataFrame | None,
    ids: Sequence[str],
    answer: str = "response",
    prompt: str | None = "prompt",
    entropy: bool = False,
    keep_empty: bool = False,
) -> DataFrame:
    """(ids, pos, token, lp_<model>, [h_<model>]) for answer tokens.

    Every distinct n-gram is looked up once; the token table itself moves in
    a single shuffle. `keep_empty` keeps one NULL token for an empty answer. Without `samples`
    the model's own documents are scored, those that it was told to; their tokens are split and moved once, for counts and scores.
    """
    if samples is None:
        if entropy or keep_empty or lm.rows is None or tuple(ids) != lm.ids:
            raise ValueError("a model still to be counted scores its documents by their ids, without entropy or empty answers")
        return gathered(lm).drop("ctx").withColumnRenamed("w", "token")
    tokens = token_rows(samples, ids, answer, prompt, lm.n)
    if not keep_empty:
        tokens = tokens.where("w is not null")
    needed = tokens.where("w is not null").select("ctx", "w")
    scored = attach(tokens, score_ngrams(lm, needed, entropy), ["ctx", "w"])
    return scored.drop("ctx").withColumnRenamed("w", "token")


def summarise_tokens(tokens: DataFrame, ids: Sequence[str], models: Sequence[str], entropy: bool = False) -> DataFrame:
    """L4: sum, mean and length per sample; an empty answer has length 1, sum 0 and 0 tokens."""
    aggs = [F.greatest(F.count("token"), F.lit(1)).alias("n_tok"), F.count("token").alias("tokens")]
    for m in models:
        aggs.append(F.coalesce(F.sum(f"lp_{m}"), F.lit(0.0)).alias(f"sum_lp_{m}"))
        if entropy:
            aggs.append(F.coalesce(F.avg(f"h_{m}"), F.lit(0.0)).alias(f"mean_h_{m}"))
    out = tokens.groupBy(*ids).agg(*aggs)
    for m in models:
        out = out.withColumn(f"mean_lp_{m}", F.col(f"sum_lp_{m}") / F.col("n_tok"))
    return out


def seq_logp_with_lengths(
    lm: NgramLM,
    samples: DataFrame,
    ids: Sequence[str],
    answer: str = "response",
    prompt: str | None = "prompt",
    entropy: bool = False,
) -> DataFrame:
    """L4 over all samples, empty answers included."""
    tokens = token_logp(lm, samples, ids, answer, prompt, entropy, keep_empty=True)
    return summarise_tokens(tokens, ids, lm.models, entropy)


def seq_logp(
    lm: NgramLM, samples: DataFrame, ids: Sequence[str], answer: str = "response", prompt: str | None = "prompt"
) -> DataFrame:
    """L3: total answer log-prob per sample, one `lp_<model>` column per model."""
    full = seq_logp_with_lengths(lm, samples, ids, answer, prompt)
    return full.select(*ids, *[F.col(f"sum_lp_{m}").alias(f"lp_{m}") for m in lm.models])


def perplexity_by(scored: DataFrame, by: Sequence[str], sum_lp: str, tokens: str = "tokens") -> DataFrame:
    """Exp of the mean negative log-prob per token; NULL if there is no token."""
    return scored.groupBy(*by).agg(
        F.sum(tokens).alias("tokens"), F.exp(-F.sum(sum_lp) / F.nullif(F.sum(tokens), F.lit(0))).alias("perplexity")
    )


def load_ngram_lm(spark: SparkSession, path: str, models: Sequence[str], n: int = 2, add_k: float = 0.5) -> NgramLM:
    return replace(counted(spark.read.parquet(f"{path}/ngrams"), models, n, add_k), stored=True)
