"""What a registered query is, and the SQL fragments the oracles share."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rollmill.functions.numerics import rounded


@dataclass(frozen=True)
class Entry:
    build: Callable[[SparkSession, str], DataFrame]
    sql: str | None = None


def rounded_cols(df: DataFrame, names: Sequence[str], digits: int = 6) -> DataFrame:
    return df.withColumns({n: rounded(F.col(n), digits) for n in names})


def r(expr: str, digits: int = 6) -> str:
    """SQL twin of `rounded`."""
    return f"(round(({expr})::double + 1.7e-9, {digits}) + 0.0::double)"


def r_as(exprs: dict[str, str], digits: int = 6) -> str:
    return ", ".join(f"{r(e, digits)} as {n}" for n, e in exprs.items())


def nls(x: str) -> str:
    """-ln(sigmoid(x)) in SQL."""
    return f"(greatest(-({x}), 0::double) + ln(1 + exp(-abs({x}))))"


def sigmoid(x: str) -> str:
    return f"(1 / (1 + exp(-({x}))))"


def clip(x: str, lo: float, hi: float) -> str:
    return f"greatest(least({x}, {hi}::double), {lo}::double)"


ARITH_ROLLOUTS = """arith_rollouts as (
select o_orderpriority as run_id,
       cast(dense_rank() over (partition by o_orderpriority order by o_orderkey) - 1 as bigint) as step,
       o_orderkey as prompt_id,
       concat(cast(o_orderkey % 10 as string), '+', cast(o_custkey % 10 as string), '=?') as prompt,
       cast(o_orderkey % 10 + o_custkey % 10 as bigint) as gold,
       cast(row_number() over (partition by l_orderkey order by l_linenumber, l_partkey, l_suppkey, l_quantity,
            l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate) - 1 as bigint) as sample_id,
       case when l_returnflag = 'N' then concat('答案是', cast(o_orderkey % 10 + o_custkey % 10 as string))
            when l_returnflag = 'A' then cast(o_orderkey % 10 + o_custkey % 10 + 1 + l_linenumber % 3 as string)
            when l_quantity < 25 then '不知道。'
            else concat(cast(o_orderkey % 10 + o_custkey % 10 as string), repeat(' ok', cast(l_linenumber as int))) end
            as response,
       case when l_returnflag = 'R' and l_quantity >= 25 then cast(1 + l_linenumber as bigint)
            else cast(1 as bigint) end as n_tok,
       -(l_extendedprice / 10000) as lp_new,
       -(l_extendedprice / 10000) + (l_discount - cast(0.05 as double)) as lp_old,
       -(l_extendedprice / 10000) + (l_tax - cast(0.04 as double)) as lp_ref
from orders join lineitem on o_orderkey = l_orderkey)"""

VERIFIED = (
    ARITH_ROLLOUTS
    + """,
v as (select *, case when try_cast(nullif(regexp_extract(response, '-?[0-9]+', 0), '') as decimal(38,0)) = gold
                     then 1::double else 0::double end as reward
      from arith_rollouts)"""
)

SCORED_PAIRS = (
    VERIFIED
    + """,
p as (select run_id, step, prompt_id,
             min(case when reward = 1 then sample_id end) as c_id,
             max(case when reward = 0 then sample_id end) as r_id
      from v group by run_id, step, prompt_id),
scored_pairs as (
  select p.run_id, p.step, p.prompt_id, c.prompt, c.response as chosen, x.response as rejected,
         c.lp_new as lp_c, x.lp_new as lp_r, c.lp_ref as lpref_c, x.lp_ref as lpref_r,
         c.n_tok as n_c, x.n_tok as n_r
  from p join v c on c.prompt_id = p.prompt_id and c.sample_id = p.c_id
         join v x on x.prompt_id = p.prompt_id and x.sample_id = p.r_id)"""
)

STATS = (
    VERIFIED
    + """,
s as (select run_id, step, prompt_id, count(*) as k, sum(reward) as r_sum, avg(reward) as mu,
             var_pop(reward) as var, sqrt(var_pop(reward)) + 1e-6 as sigma,
             min(reward) as r_min, max(reward) as r_max,
             count(*) filter (reward = 1) as n_correct
      from v group by run_id, step, prompt_id),
g as (select * from v join s using (run_id, step, prompt_id))"""
)

SFT_TURNS = """sft_turns as (
select conv_id, turn, text as prompt, response from (
  select conv_id, turn, role, text,
         lead(role) over (partition by conv_id order by turn) as next_role,
         lead(text) over (partition by conv_id order by turn) as response
  from conversations) t
where role = 'user' and next_role = 'assistant')"""

SPIN_GENERATIONS = (
    SFT_TURNS
    + """,
spin_generations as (
select conv_id, turn, coalesce(lead(response) over (order by conv_id, turn), '  ') as generation from sft_turns)"""
)

DOC_ROLLOUTS = """doc_rollouts as (
select d.source as prompt_id, d.doc_id as sample_id, d.lang, d.text as response,
       cast(l.quality as double) as reward, l.toxic
from documents d join labels l on d.doc_id = l.doc_id)"""

KEYS = ("run_id", "step", "prompt_id")
ROW = "run_id, step, prompt_id, sample_id"


def words_sql(text: str) -> str:
    return rf"list_filter(string_split_regex(lower({text}), '\s+'), lambda t: t <> '')"


# Which documents each model is fitted on, over documents d left join labels l.
MODEL_SQL = {
    "policy": "coalesce(l.quality = 1 and l.toxic = 0, false)",
    "ref": "true",
    "old": "d.doc_id % 2 = 0",
    "teacher": "coalesce(l.quality = 1, false)",
}


def lm_sql(models: Sequence[str]) -> str:
    """CTEs ng (ctx, w, n_*), cx (ctx, n_*, seen_*, e_*) and sz (v_*) for the document models."""
    flags = ", ".join(f"case when {MODEL_SQL[m]} then 1 else 0 end as f_{m}" for m in models)
    sums = ", ".join(f"sum(f_{m})::bigint as n_{m}" for m in models)
    any_model = " or ".join(f"f_{m} = 1" for m in models)
    sizes = ", ".join(f"count(distinct case when n_{m} > 0 then w end) + 1 as v_{m}" for m in models)
    totals = ", ".join(
        f"sum(n_{m})::bigint as n_{m}, count(*) filter (n_{m} > 0) as seen_{m}" for m in models
    )
    ents = ", ".join(f"-sum(case when ng.n_{m} > 0 then {_p('ng', 'c0', m)} * ln({_p('ng', 'c0', m)}) else 0 end) as e_{m}" for m in models)
    per = ", ".join(f"any_value(c0.n_{m}) as n_{m}, any_value(c0.seen_{m}) as seen_{m}" for m in models)
    return f"""dt as (select doc_id, {words_sql('text')} as ws from documents),
dw as (select d.doc_id, {flags}, unnest(d.ws) as w, generate_subscripts(d.ws, 1) as pos
       from dt d left join labels l on l.doc_id = d.doc_id),
db as (select *, coalesce(lag(w) over (partition by doc_id order by pos), '<s>') as ctx from dw where {any_model}),
ng as (select ctx, w, {sums} from db group by ctx, w),
sz as (select {sizes} from ng),
c0 as (select ctx, {totals} from ng group by ctx),
cx as (select c0.ctx, {per}, {ents} from c0 join ng on ng.ctx = c0.ctx, sz group by c0.ctx)"""


def _p(pair: str, ctx: str, m: str) -> str:
    """Add-k probability with k = 0.5; needs ng, the context row and sz in scope."""
    return f"((coalesce({pair}.n_{m}, 0) + 0.5::double) / (coalesce({ctx}.n_{m}, 0) + 0.5::double * sz.v_{m}))"


def entropy_sql(m: str) -> str:
    p0 = f"(0.5::double / (coalesce(cx.n_{m}, 0) + 0.5::double * sz.v_{m}))"
    return f"(coalesce(cx.e_{m}, 0) - (sz.v_{m} - coalesce(cx.seen_{m}, 0)) * {p0} * ln({p0}))"


def tokens_sql(models: Sequence[str], source: str, ids: str, prompt: str | None = "prompt", entropy: bool = False) -> str:
    """CTE tk (ids, pos, token, lp_*, h_*) scoring `response` of `source` after `prompt`."""
    head = f"list_last({words_sql(prompt)})" if prompt else "null"
    lps = ", ".join(f"ln({_p('ng', 'cx', m)}) as lp_{m}" for m in models)
    if entropy:
        lps += ", " + ", ".join(f"{entropy_sql(m)} as h_{m}" for m in models)
    return f"""qw as (select {ids}, {head} as p_last, {words_sql('response')} as ws from {source}),
qt as (select {ids}, p_last, unnest(ws) as w, generate_subscripts(ws, 1) - 1 as pos from qw),
qc as (select *, coalesce(lag(w) over (partition by {ids} order by pos), p_last, '<s>') as ctx from qt),
tk as (select {ids}, pos, qc.w as token, {lps}
       from qc left join ng on ng.ctx = qc.ctx and ng.w = qc.w left join cx on cx.ctx = qc.ctx, sz)"""
