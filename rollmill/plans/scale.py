"""Plan shapes that hold when one key owns a large share of the rows.

* `attach` puts per-key facts back on rows through a join whose hot
  partitions AQE can split.
* `task_parts` and `dealt` hash rows over so many partitions that no task holds much more than TASK_ROWS of them.
* `hot_hashes` names the few keys that own most rows, by a sketch of bounded size; `row_index` cuts only those into blocks.
* `running_total`, `dense_index`, `row_index`, `next_row` and `linear_scan`
  replace ordered windows over a whole key: the key is cut into blocks of
  bounded size, each block is one small window, and only one row per block
  travels to the next level.

NULL is a key like any other. A NULL in an `order` column is an error.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bits of a 64-bit order that each level takes off. A window then holds at most 2**16 rows of a key,
#: or, one row per block, 2**24 numbers: whatever the span and spacing of the orders.
CUTS = (16, 24)
SCAN_BITS = 12
#: Rows that a task sorts in memory, about; plans that sort whole rows ask for partitions by their number of rows.
TASK_ROWS = 1 << 19
#: A key is hot from HOT_ROWS rows on. HOT_KEYS of them are named at most, out of TRACKED that a sketch follows.
HOT_ROWS = 1 << 16
HOT_KEYS = 1 << 10
TRACKED = 1 << 16


def block_of(order: str, bits: int) -> str:
    """Block number of an integer: floor division by 2**bits; NULL raises."""
    return f"shiftright(coalesce(cast({order} as bigint), raise_error('the order column holds NULL')), {bits})"


def _over(keys: Sequence[str], order: Sequence[str], rows: str = "") -> str:
    """An OVER clause; `rows` is the frame before the current row, if any."""
    by = f"partition by {', '.join(keys)} " if keys else ""
    frame = f" rows between unbounded preceding and {rows}" if rows else ""
    return f"over ({by}order by {', '.join(order)}{frame})"


def _packed(df: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, list[str]]:
    """The keys as one struct: in it NULL equals NULL, so that equal keys meet in plain joins and share a shuffle."""
    if not keys:
        return df, []
    return df.select(F.struct(*keys).alias("_key"), *[c for c in df.columns if c not in keys]), ["_key"]


def _unpacked(df: DataFrame, columns: Sequence[str], keys: Sequence[str]) -> DataFrame:
    return df.select(*[F.col("_key")[c].alias(c) if c in keys else F.col(c) for c in columns])


def attach(rows: DataFrame, facts: DataFrame, keys: Sequence[str], how: str = "left") -> DataFrame:
    """Join `facts` (at most one row per key) onto `rows`; NULL is a key like any other.

    The facts usually come out of a groupBy on the same keys, and Spark would
    reuse that partitioning for the join. AQE splits a skewed join partition
    only when both inputs are plain shuffles, so the extra key `_h` asks for
    a shuffle of the (small) facts: a hot key's rows are then
    read by many tasks instead of one.
    """
    keys = list(keys)
    right = {k: f"_r_{k}" for k in keys}
    tagged = facts.withColumn("_rh", F.xxhash64(*keys)).withColumnsRenamed(right)
    met = F.col("_h") == F.col("_rh")
    for k, r in right.items():
        met = met & F.col(k).eqNullSafe(F.col(r))
    return rows.withColumn("_h", F.xxhash64(*keys)).join(tagged, met, how).drop("_h", "_rh", *right.values())


def task_parts(spark: SparkSession, rows: int, task_rows: int | None = None) -> int | None:
    """Partitions for `rows` rows, at least the session's; None if the cluster's cores hold them in one round anyway."""
    parts = math.ceil(rows / (task_rows or TASK_ROWS))
    if parts <= spark.sparkContext.defaultParallelism:
        return None
    return max(parts, int(spark.conf.get("spark.sql.shuffle.partitions")))


def dealt(df: DataFrame, parts: int | None, keys: Sequence[str]) -> DataFrame:
    """`df` hashed by `keys` over `parts` partitions, which AQE does not merge; left to Spark if None."""
    return df.repartition(parts, *keys) if parts else df


def running_total(
    df: DataFrame, keys: Sequence[str], order: str, value: str, out: str, cuts: Sequence[int] = CUTS
) -> DataFrame:
    """Inclusive running sum of `value` per key in integer `order`, which is unique per key."""
    packed, by = _packed(df, keys)
    return _unpacked(_total(packed, by, order, value, out, cuts), [*df.columns, out], keys)


def _total(df: DataFrame, keys: list[str], order: str, value: str, out: str, cuts: Sequence[int]) -> DataFrame:
    if not cuts:
        return df.withColumn(out, F.expr(f"sum({value}) {_over(keys, [order], 'current row')}"))
    b, t, c = (f"_{x}{len(cuts)}" for x in "btc")
    blocked = df.withColumn(b, F.expr(block_of(order, cuts[0])))
    totals = blocked.groupBy(*keys, b).agg(F.sum(value).alias(t))
    carry = _total(totals, keys, b, t, c, cuts[1:]).selectExpr(*keys, b, f"{c} - {t} as {c}")
    inside = F.expr(f"sum({value}) {_over([*keys, b], [order], 'current row')}")
    joined = blocked.withColumn(out, inside).join(carry, [*keys, b])
    return joined.withColumn(out, F.expr(f"{out} + {c}")).drop(b, c)


def dense_index(df: DataFrame, keys: Sequence[str], order: str, out: str, cuts: Sequence[int] = CUTS) -> DataFrame:
    """0-based position of each row per key; `order` is an integer, unique per key."""
    one = df.withColumn("_one", F.lit(1).cast("bigint"))
    counted = running_total(one, keys, order, "_one", out, cuts)
    return counted.withColumn(out, F.expr(f"cast({out} - 1 as bigint)")).drop("_one")


def hot_hashes(df: DataFrame, keys: Sequence[str], hot_rows: int = HOT_ROWS) -> list[int]:
    """`xxhash64` of the keys that own more than `hot_rows` rows, the HOT_KEYS largest at most.

    One pass over the key columns into a sketch per task, whatever the number of keys. A key that a sketch
    misses owns less than about 1/TRACKED of all rows: plans may rely on this list for speed, never for their results.
    """
    return hot_and_rows(df, keys, hot_rows)[0]


def hot_and_rows(df: DataFrame, keys: Sequence[str], hot_rows: int = HOT_ROWS) -> tuple[list[int], int]:
    """`hot_hashes` and the number of rows, in the same pass."""
    top = F.expr(f"approx_top_k(xxhash64({', '.join(keys)}), {HOT_KEYS}, {TRACKED})")
    found = df.agg(top.alias("top"), F.count(F.lit(1)).alias("n")).first()
    return [x["item"] for x in found.top or [] if x["count"] > hot_rows], found.n


def row_index(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], coarse: str, out: str, hot: Sequence[int] | None = None
) -> DataFrame:
    """0-based row_number per key over arbitrary `order` columns.

    A key's rows are numbered in one window. Those of hot keys, if there are any, are cut by `coarse`, which rounds the
    leading order columns down to one integer: rows that share it are numbered by themselves, after the rows of lower
    numbers, which a running total counts. Without keys all rows are cut. `hot` has the `hot_hashes` of the
    keys, if they are known already.
    """
    if keys and hot is None:
        hot = hot_hashes(df, keys)
    if keys and not hot:
        # by the keys themselves, so that joins and windows on them need no further shuffle
        return df.withColumn(out, F.expr(f"cast(row_number() {_over(keys, order)} - 1 as bigint)"))
    packed, by = _packed(df, keys)
    is_hot = F.xxhash64(*[F.col("_key")[k] for k in keys]).isin(list(hot)) if by else F.lit(True)
    tagged = packed.withColumn("_part", F.when(is_hot, F.expr(coarse)))
    counts = tagged.where(is_hot).groupBy(*by, "_part").agg(F.count(F.lit(1)).alias("_n"))
    offsets = _total(counts, by, "_part", "_n", "_off", CUTS).selectExpr(*by, "_part", "_off - _n as _off")
    local = tagged.withColumn(out, F.expr(f"row_number() {_over([*by, '_part'], order)}"))
    numbered = local.join(offsets, [*by, "_part"], "left")
    numbered = numbered.withColumn(out, F.expr(f"cast({out} - 1 + coalesce(_off, 0) as bigint)"))
    return _unpacked(numbered, [*df.columns, out], keys)


def _previous(df: DataFrame, keys: list[str], order: str, value: str, out: str, cuts: Sequence[int]) -> DataFrame:
    """The number `value`, never NULL, of the row before in `order`; NULL on a key's first row."""
    inside = f"lag({value}) {_over(keys, [order])}"
    if not cuts:
        return df.withColumn(out, F.expr(inside))
    b, c = (f"_{x}{len(cuts)}" for x in "bc")
    blocked = df.withColumn(b, F.expr(block_of(order, cuts[0])))
    lasts = blocked.groupBy(*keys, b).agg(F.max_by(value, order).alias(c))
    before = _previous(lasts, keys, b, c, f"{c}p", cuts[1:]).drop(c)
    inside = f"lag({value}) {_over([*keys, b], [order])}"
    joined = blocked.withColumn(out, F.expr(inside)).join(before, [*keys, b])
    return joined.withColumn(out, F.expr(f"coalesce({out}, {c}p)")).drop(b, f"{c}p")


def next_row(
    df: DataFrame,
    keys: Sequence[str],
    order: str,
    cols: Sequence[str],
    prefix: str = "next_",
    cuts: Sequence[int] = CUTS,
) -> DataFrame:
    """Values of `cols` in the following row per key (NULL on the last row).

    Inside a block this is lead(); a block's last row takes the first row of
    the next block. Which block comes next is found with block numbers alone:
    the values move with their own row, and one row per block moves to the block before.
    """
    rows, by = _packed(df, keys)
    values = f"struct({', '.join(cols)})"
    if not cuts:
        joined = rows.withColumn("_next", F.expr(f"lead({values}) {_over(by, [order])}"))
    else:
        blocked = rows.withColumn("_b", F.expr(block_of(order, cuts[0])))
        links = _previous(blocked.select(*by, "_b").distinct(), by, "_b", "_b", "_to", cuts[1:])
        place = F.expr(f"row_number() {_over([*by, '_b'], [order])}")
        heads = blocked.withColumn("_place", place).where("_place = 1").selectExpr(*by, "_b", f"{values} as _head")
        heads = heads.join(links.where("_to is not null"), [*by, "_b"]).selectExpr(*by, "_to as _b", "_head")
        inside = F.expr(f"lead({values}) {_over([*by, '_b'], [order])}")
        joined = blocked.withColumn("_next", inside).join(heads, [*by, "_b"], "left")
        joined = joined.withColumn("_next", F.coalesce("_next", "_head"))
    joined = joined.withColumns({f"{prefix}{c}": F.col("_next")[c] for c in cols})
    return _unpacked(joined, [*df.columns, *[f"{prefix}{c}" for c in cols]], keys)


def linear_scan(
    df: DataFrame,
    keys: Sequence[str],
    order: str,
    coef: float,
    term: str | Sequence[str],
    out: str | Sequence[str],
    bits: int = SCAN_BITS,
    dense: bool = False,
    cuts: Sequence[int] = CUTS,
    parts: int | None = None,
) -> DataFrame:
    """x_t = coef * x_(t-1) + term_t per key in integer `order`, x before the first row = 0.

    Adds `out` (x_t) and `out`_prev (x_(t-1)); several terms share one pass. 0 <= coef <= 1. `dense` promises
    that `order` holds consecutive integers per key, from any start; `parts` are the partitions of the rows' shuffle
    (default: Spark's choice). Terms above 1e100 may overflow.
    """
    if not 0.0 <= coef <= 1.0:
        raise ValueError(f"coef must lie between 0 and 1, not {coef}")
    pairs = [(term, out)] if isinstance(term, str) else list(zip(term, out, strict=True))
    columns = [*df.columns, *[c for _, o in pairs for c in (f"{o}_prev", o)]]
    if coef == 1.0:
        for t, o in pairs:
            df = running_total(df, keys, order, t, o, cuts).withColumn(f"{o}_prev", F.expr(f"{o} - {t}"))
        return df.select(*columns)
    df = df.withColumn("_p", F.col(order).cast("bigint")) if dense else dense_index(df, keys, order, "_p", cuts)
    packed, by = _packed(df, keys)
    return _unpacked(_scan(packed, by, "_p", coef, pairs, bits, parts), columns, keys)


def _scan(
    df: DataFrame, keys: list[str], at: str, coef: float, pairs: list[tuple[str, str]], bits: int, parts: int | None = None
) -> DataFrame:
    """`linear_scan` over consecutive positions `at`.

    A block of L rows needs one number from outside, the x it starts from;
    inside, x is a running sum of terms scaled by coef**-i, and blocks are
    short enough for coef**-L to stay a plain double. The x at the block ends
    follow the same recurrence with coefficient q = coef**L: one row per block
    goes up a level, until q < 1e-40. There a block reaches only a few blocks
    on, as q**k times the largest double is soon below the smallest.
    """
    decay = -math.log10(coef) if coef else math.inf
    bits = min(bits, int(math.log2(200.0 / decay))) if decay <= 200.0 else 0
    last = (1 << bits) - 1
    span, q = decay * (last + 1), coef ** (last + 1)
    c = f"{coef!r}D"
    blocked = df.selectExpr("*", f"{block_of(at, bits)} as _b", f"{at} & {last} as _i")
    # only full blocks have a successor, hence the fixed exponent
    sums = [F.expr(f"sum({term} * pow({c}, {last} - _i)) as _t{n}") for n, (term, _) in enumerate(pairs)]
    # no key has a block after the table's last one
    top = df.select(F.expr(f"max({block_of(at, bits)})").alias("top")).scalar()
    ends = blocked.where(F.col("_b") < top).groupBy(*keys, F.expr("_b + 1 as _e")).agg(*sums)
    if span < 40.0:
        carry = _scan(ends, keys, "_e", q, [(f"_t{n}", f"_x{n}") for n in range(len(pairs))], SCAN_BITS)
    else:
        reach = math.ceil(650.0 / span) if coef else 1
        # in two factors, either of which stays a double
        weight = f"pow({q!r}D, _n div 2) * pow({q!r}D, _n - _n div 2)"
        ahead = F.least(F.lit(max(reach, 1) - 1).cast("bigint"), top - F.col("_e"))
        later = ends.select("*", F.explode(F.sequence(F.lit(0).cast("bigint"), ahead)).alias("_n"))
        shares = [F.expr(f"sum(_t{n} * {weight}) as _x{n}") for n in range(len(pairs))]
        carry = later.groupBy(*keys, F.expr("_e + _n as _e")).agg(*shares)
    carry = carry.selectExpr(*keys, "_e as _b", *[f"_x{n} as _in{n}" for n in range(len(pairs))])
    window = _over([*keys, "_b"], [at], "1 preceding")
    inside = {f"_s{n}": F.expr(f"sum({term} * pow({c}, -_i)) {window}") for n, (term, _) in enumerate(pairs)}
    joined = dealt(blocked, parts, [*keys, "_b"]).withColumns(inside).join(carry, [*keys, "_b"], "left")
    for n, (term, out) in enumerate(pairs):
        own = f"case when _i = 0 then 0D else pow({c}, _i - 1) * coalesce(_s{n}, 0D) end"
        joined = joined.withColumn(f"{out}_prev", F.expr(f"{own} + pow({c}, _i) * coalesce(_in{n}, 0D)"))
        joined = joined.withColumn(out, F.expr(f"{c} * {out}_prev + {term}")).drop(f"_s{n}", f"_in{n}")
    return joined.drop("_b", "_i")
