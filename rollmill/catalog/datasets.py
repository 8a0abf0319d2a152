"""Queries over dataset builders and sources."""

from __future__ import annotations

from pyspark.sql import functions as F

from rollmill.catalog.entries import SCORED_PAIRS, SFT_TURNS, VERIFIED, Entry, r, rounded_cols
from rollmill.functions.numerics import rounded
from rollmill.operators import datasets as D
from rollmill.sources import fixtures as fx
from rollmill.plans.session import shared_dir
from rollmill.sources.tables import arrays_to_long, quarantine_log, read_log, table, write_dataset


def prompts(spark, root):
    orders = table(spark, root, "orders").select(
        F.col("o_orderkey").alias("prompt_id"),
        (F.col("o_orderkey") % 10).alias("a"),
        (F.col("o_custkey") % 10).alias("b"),
    )
    return D.arith_prompts(orders).select("prompt_id", "prompt", "gold")


def s1(spark, root):
    return D.sft_examples(table(spark, root, "conversations"))


def s2(spark, root):
    rendered = D.render_chat(D.messages(F.col("system"), F.col("prompt")))
    return s1(spark, root).select("conv_id", "turn", rendered.alias("rendered"))


def s3(spark, root):
    docs = table(spark, root, "documents").select(
        F.col("doc_id").alias("prompt_id"), F.split("text", "\n").alias("candidates")
    )
    return D.explode_candidates(docs)


def s5(spark, root):
    samples = fx.arith_rollouts(spark, root).select("prompt_id", "sample_id", "response")
    return D.attach_prompts(samples, prompts(spark, root))


def s6(spark, root):
    return D.validate_pairs(fx.scored_pairs(spark, root), "prompt_id").select("prompt_id", "reason")


def s7(spark, root):
    unpaired = D.pairs_to_unpaired(fx.scored_pairs(spark, root), ("prompt_id",))
    return unpaired.withColumn("label", F.col("label").cast("bigint"))


def s8(spark, root):
    rows = D.kto_from_labels(
        table(spark, root, "documents").select("doc_id", "source", "text"),
        table(spark, root, "labels").select("doc_id", "quality"),
        "doc_id",
        "source",
        "text",
        "quality",
    )
    return rows.withColumn("label", F.col("label").cast("bigint"))


def s9(spark, root):
    return D.step_schedule(prompts(spark, root), "prompt_id", ("prompt", "gold"), epochs=2)


def s10(spark, root):
    """Written as JSON, a folder per run, and read again."""
    home = shared_dir(spark, "unpaired")
    write_dataset(D.pairs_to_unpaired(fx.scored_pairs(spark, root), ("run_id", "prompt_id")), "unpaired", home, by=("run_id",))
    return read_log(spark, home, "prompt string, completion string, label boolean, run_id string", "json")


def s11(spark, root):
    rows = arrays_to_long(table(spark, root, "embeddings"), ["vec_id"], {"embedding": "lp"})
    return rounded_cols(rows.withColumn("lp", F.col("lp").cast("double")), ["lp"])


def s11_quarantine(spark, root):
    """A token log with broken lines, written from the vectors and read again: good samples, and per defect what was set apart."""
    e = table(spark, root, "embeddings").select(F.col("vec_id").alias("sample_id"), F.col("embedding").cast("array<double>").alias("lp"))
    last = F.col("sample_id") % 10
    shorter = F.when(last == 5, F.slice("lp", 1, F.greatest(F.size("lp") - 1, F.lit(0)))).otherwise(F.col("lp"))
    whole = F.to_json(F.struct("sample_id", "lp", shorter.alias("entropy")))
    as_text = F.to_json(F.struct(F.concat(F.lit("no "), "sample_id").alias("sample_id"), "lp", F.col("lp").alias("entropy")))
    line = F.when(last == 3, F.expr("left(_line, length(_line) - 2)")).when(last == 7, as_text).otherwise(F.col("_line"))
    path = shared_dir(spark, "log")
    e.withColumn("_line", whole).select(line.alias("value")).write.text(path)
    schema = "sample_id bigint, lp array<double>, entropy array<double>"
    good, bad = quarantine_log(spark, path, shared_dir(spark, "checked"), schema, ["lp", "entropy"])
    total = F.aggregate("lp", F.lit(0.0), lambda a, x: a + x)
    kept = good.select(
        F.lit("none").alias("defect"), "sample_id", F.lit(1).cast("bigint").alias("n_rows"),
        F.size("lp").cast("bigint").alias("n_values"), rounded(total, 4).alias("lp_sum"),
    )
    none = [F.lit(None).cast(t).alias(n) for n, t in (("sample_id", "bigint"), ("n_values", "bigint"), ("lp_sum", "double"))]
    apart = bad.groupBy("defect").agg(F.count(F.lit(1)).alias("n_rows")).select("defect", "n_rows", *none)
    return kept.unionByName(apart)


PROMPTS = """prompts as (
select o_orderkey as prompt_id, concat((o_orderkey % 10)::varchar, '+', (o_custkey % 10)::varchar, '=?') as prompt,
       (o_orderkey % 10 + o_custkey % 10)::bigint as gold from orders)"""

EXAMPLES = (
    SFT_TURNS
    + """,
ex as (select t.*, s.system from sft_turns t left join
       (select conv_id, arg_min(text, turn) as system from conversations where role = 'system' group by conv_id) s
       using (conv_id))"""
)

UNPAIRED = """u as (select run_id, prompt_id, prompt, chosen as completion, 1::bigint as label from scored_pairs
       union all select run_id, prompt_id, prompt, rejected, 0::bigint from scored_pairs)"""

ENTRIES = {
    "s1_sft_examples": Entry(s1, f"with {EXAMPLES} select conv_id, turn, prompt, response, system from ex"),
    "s2_render_chat": Entry(
        s2,
        f"""with {EXAMPLES} select conv_id, turn,
        concat(case when coalesce(system, '') = '' then ''
                    else concat('<|im_start|>system', chr(10), system, '<|im_end|>', chr(10)) end,
               '<|im_start|>user', chr(10), prompt, '<|im_end|>', chr(10), '<|im_start|>assistant', chr(10)) as rendered
        from ex""",
    ),
    "s3_explode_candidates": Entry(
        s3,
        """with c as (select doc_id, string_split(text, chr(10)) as cs from documents)
        select doc_id as prompt_id, (generate_subscripts(cs, 1) - 1)::bigint as sample_id, unnest(cs) as response from c""",
    ),
    "s4_arith_prompts": Entry(prompts, f"with {PROMPTS} select * from prompts"),
    "s5_attach_prompts": Entry(
        s5,
        f"with {VERIFIED}, {PROMPTS} select v.prompt_id, v.sample_id, v.response, p.prompt, p.gold "
        "from v join prompts p on p.prompt_id = v.prompt_id",
    ),
    "s6_validate_pairs": Entry(
        s6,
        f"""with {SCORED_PAIRS},
        d as (select *, case when prompt is null or chosen is null or rejected is null then 'null'
                             when not regexp_matches(prompt, '[^[:space:]]') or not regexp_matches(chosen, '[^[:space:]]') or not regexp_matches(rejected, '[^[:space:]]') then 'blank'
                             when chosen = rejected then 'identical' end as defect from scored_pairs)
        select prompt_id, coalesce(defect, case when row_number() over
               (partition by defect is null, prompt, chosen, rejected order by prompt_id) > 1 then 'duplicate' end) as reason
        from d""",
    ),
    "s7_pairs_to_unpaired": Entry(
        s7, f"with {SCORED_PAIRS}, {UNPAIRED} select prompt_id, prompt, completion, label from u"
    ),
    "s8_kto_from_labels": Entry(
        s8,
        "select d.doc_id, d.source as prompt, d.text as completion, l.quality::bigint as label "
        "from documents d join labels l on d.doc_id = l.doc_id",
    ),
    "s9_step_schedule": Entry(
        s9,
        f"""with {PROMPTS}, i as (select *, row_number() over (order by prompt_id) - 1 as i, count(*) over () as n from prompts)
        select prompt_id, prompt, gold, (i + e * n)::bigint as step from i, (values (0), (1)) t(e)""",
    ),
    "s10_write_trl": Entry(
        s10,
        f"with {SCORED_PAIRS}, {UNPAIRED} select run_id, prompt, completion, label = 1 as label from u",
    ),
    "s11_arrays_to_long": Entry(
        s11,
        f"""with e as (select vec_id, (generate_subscripts(embedding, 1) - 1)::bigint as pos, unnest(embedding) as x
        from embeddings) select vec_id, pos, {r('x')} as lp from e""",
    ),
    "s11_quarantine": Entry(
        s11_quarantine,
        f"""select 'none' as defect, vec_id as sample_id, 1::bigint as n_rows, len(embedding)::bigint as n_values,
               {r('coalesce(list_sum(embedding::double[]), 0)', 4)} as lp_sum
        from embeddings where vec_id % 10 not in (3, 5, 7)
        union all
        select defect, null, count(*), null, null
        from (select case when vec_id % 10 = 5 then 'ragged' else 'malformed' end as defect
              from embeddings where vec_id % 10 in (3, 5, 7)) group by defect""",
    ),
}
