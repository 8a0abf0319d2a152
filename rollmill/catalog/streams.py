"""Streaming queries over the events table, drained into a table."""

from __future__ import annotations

from pyspark.sql import functions as F

from rollmill.catalog.entries import Entry, r, rounded_cols
from rollmill.streaming import rollout_stream as T


def events(spark, root):
    stream = T.parquet_stream(spark, root, "events.parquet")
    return stream.withColumn("ts", F.col("ts").cast("timestamp")).withColumn("reward", F.col("value"))


def windows(**how):
    """Windows that the watermark has passed; later ones stay open, as in any stream."""

    def build(spark, root):
        out = T.drain(T.reward_windows(events(spark, root), by=["event_type"], **how), "reward_windows")
        for edge in ("start", "end"):
            out = out.withColumn(edge, F.col(edge).cast("timestamp_ntz"))
        return rounded_cols(out, ["mean_reward"])

    return build


def t2(spark, root):
    """A step is a microsecond of a run (an event type): the events of one share it."""
    stream = events(spark, root).withColumn("step", F.unix_micros("ts"))
    rows, _ = T.drain_batches(stream, "ema_baseline", T.ema_baseline_step(["event_type"], "step"))
    return rounded_cols(rows, ["step_mean", "baseline", "baseline_next"])


def t3(spark, root):
    """All events: groups still short at the end of the table come with complete = false."""
    step = T.group_advantage_step(["event_type", "user_id"], "ts", sample="event_id", wait="3650 days")
    done, held = T.drain_batches(events(spark, root), "group_advantage", step)
    short, _ = T.group_advantage_step(["event_type", "user_id"], "ts", sample="event_id", wait="0 days")(held, None)
    rows = done.unionByName(short).select("event_type", "user_id", "event_id", "k", "adv", "signal", "complete")
    return rounded_cols(rows, ["adv"])


def t4(spark, root):
    kept = T.rejection_stream(events(spark, root), F.col("props"), F.col("user_id") % 100, ["event_id"])
    return T.drain(kept, "rejection").select("event_id", "event_type", "user_id", "props")


STATS = "count(*) as n, avg(value) as m, min(value) = max(value) as no_signal"
COLS = f"event_type, n, {r('m')} as mean_reward, no_signal"
MARK = "(select max(ts) - interval 10 minute from events)"

ENTRIES = {
    "t1_stream_reward_windows": Entry(
        windows(),
        f"""with w as (select date_trunc('hour', ts) as start, event_type, {STATS} from events group by 1, 2)
        select start::timestamp as start, (start + interval 1 hour)::timestamp as "end", {COLS}
        from w where start + interval 1 hour <= {MARK}""",
    ),
    "t1_stream_sliding_windows": Entry(
        windows(slide="30 minutes"),
        f"""with s as (select time_bucket(interval 30 minute, ts) - i * interval 30 minute as start, event_type, value
                   from events, (values (0), (1)) x(i)),
        w as (select start, event_type, {STATS} from s group by 1, 2)
        select start::timestamp as start, (start + interval 1 hour)::timestamp as "end", {COLS}
        from w where start + interval 1 hour <= {MARK}""",
    ),
    "t1_stream_session_windows": Entry(
        windows(gap="5 minutes"),
        f"""with e as (select *, ts >= lag(ts) over (partition by event_type order by ts, event_id) + interval 5 minute as cut from events),
        s as (select *, count(*) filter (cut) over (partition by event_type order by ts, event_id) as session from e),
        w as (select event_type, min(ts) as start, max(ts) + interval 5 minute as stop, {STATS} from s group by event_type, session)
        select start::timestamp as start, stop::timestamp as "end", {COLS} from w where stop <= {MARK}""",
    ),
    "t2_stream_ema_baseline": Entry(
        t2,
        f"""with e as (select event_type, epoch_us(ts) as step, avg(value) as m from events group by all),
        p as (select *, count(*) over w as seen, coalesce(list(m) over (w rows between unbounded preceding and 1 preceding), []) as past
              from e window w as (partition by event_type order by step)),
        b as (select *, list_reduce(list_prepend(0::double, past), lambda a, x: 0.9::double * a + 0.1::double * x) as base from p)
        select event_type, step, seen, {r('m')} as step_mean, {r('base')} as baseline,
               {r('0.9::double * base + 0.1::double * m')} as baseline_next from b""",
    ),
    "t3_stream_group_advantage": Entry(
        t3,
        f"""with n as (select *, (row_number() over (partition by event_type, user_id order by event_id) - 1) // 4 as chunk
        from events),
        c as (select event_type, user_id, chunk, count(*) as k, avg(value) as mu, var_pop(value) as v from n group by all)
        select n.event_type, n.user_id, event_id, k, {r('(value - mu) / (sqrt(v) + 1e-6)')} as adv, v >= 1e-12 as signal, k = 4 as complete
        from n join c on n.chunk = c.chunk and n.user_id is not distinct from c.user_id and n.event_type is not distinct from c.event_type""",
    ),
    "t4_stream_rejection_filter": Entry(
        t4,
        """select distinct event_id, event_type, user_id, props from events
        where try_cast(nullif(regexp_extract(props, '-?[0-9]+', 0), '') as decimal(38,0)) = user_id % 100""",
    ),
}
