import datetime as dt

import pytest
from pyspark.sql import functions as F

from rollmill.catalog import streams
from rollmill.operators import advantages as A
from rollmill.streaming import rollout_stream as T

T0 = dt.datetime(2024, 1, 1, tzinfo=dt.UTC)


def at(minutes):
    return T0 + dt.timedelta(minutes=minutes)


def stream_of(spark, folder, batches, schema):
    """One file per micro-batch, in order."""
    for i, rows in enumerate(batches):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(f"{folder}/b{i}")
    return (
        spark.readStream.schema(schema)
        .option("maxFilesPerTrigger", 1)
        .option("recursiveFileLookup", "true")
        .parquet(str(folder))
    )


EVENTS = "id bigint, run string, ts timestamp, reward double"


def test_tumbling_windows_drop_late_rows(spark, tmp_path):
    batches = [
        [(1, "a", at(5), 1.0), (2, "a", at(50), 0.0)],
        [(3, "a", at(200), 1.0)],  # moves the watermark past the first hour
        [(6, "a", at(201), 1.0)],  # a batch is judged by the watermark of the batch before it
        [(4, "a", at(10), 1.0)],  # late
        [(5, "a", at(400), 1.0)],
    ]
    rows = T.drain(T.reward_windows(stream_of(spark, tmp_path, batches, EVENTS)), "t").orderBy("start").collect()
    assert [(r.n, r.mean_reward, r.no_signal) for r in rows] == [(2, 0.5, False), (2, 1.0, True)]


def test_session_and_sliding_windows(spark, tmp_path):
    batches = [[(1, "a", at(0), 1.0), (2, "a", at(20), 1.0), (3, "a", at(90), 0.0)], [(4, "a", at(900), 1.0)]]
    stream = stream_of(spark, tmp_path, batches, EVENTS)
    sessions = T.drain(T.reward_windows(stream, by=["run"], gap="30 minutes"), "t").orderBy("start").collect()
    assert [r.n for r in sessions] == [2, 1]
    sliding = T.drain(T.reward_windows(stream, slide="30 minutes"), "t")
    assert sliding.agg(F.sum("n")).first()[0] == 6  # each closed row is in two windows


def test_running_baseline_equals_the_batch_scan(spark, tmp_path):
    """Several rewards a step, a NULL run, runs that start late or skip a batch."""
    run = lambda i: [None, "a", "b"][i % 3] if i < 40 else "a"
    rows = [(i, run(i // 2), at(i // 2), (i * 37 % 11) / 10) for i in range(60)]
    stream = stream_of(spark, tmp_path, [rows[:8], rows[8:32], rows[32:]], EVENTS)
    stream = stream.withColumn("step", F.unix_micros("ts"))
    got, state = T.drain_batches(stream, "t", T.ema_baseline_step(["run"], "step"))
    batch = spark.createDataFrame(rows, EVENTS).withColumn("step", F.unix_micros("ts"))
    want = {(r.run, r.step): (r.baseline, r.baseline_next) for r in A.ema_baseline(batch, ["run"]).collect()}
    got = got.collect()
    assert len(got) == len(want) == 30
    for r in got:
        assert (r.baseline, r.baseline_next) == pytest.approx(want[r.run, r.step], abs=1e-12)
    assert {(r.run, r.seen) for r in state.collect()} == {(k, sum(r.run == k for r in got)) for k in (None, "a", "b")}


def test_steps_out_of_order_are_an_error(spark, tmp_path):
    rows = [(1, "a", at(1), 1.0), (2, "a", at(0), 1.0)]
    stream = stream_of(spark, tmp_path, [rows[:1], rows[1:]], EVENTS).withColumn("step", F.unix_micros("ts"))
    with pytest.raises(Exception, match="after a later step"):
        T.drain_batches(stream, "t", T.ema_baseline_step(["run"], "step"))


GROUPS = "run string, prompt_id bigint, sample_id bigint, ts timestamp, reward double"


def test_group_advantages_equal_the_batch_and_short_groups_flush(spark, tmp_path):
    full = [("r", 1, i, at(i), float(i % 2)) for i in range(4)] + [(None, 2, i, at(i), float(i == 0)) for i in range(4)]
    full += [("r", 4, i, at(i), 1.0) for i in range(4)]  # no signal
    short = [("r", 3, i, at(i), float(i)) for i in range(2)]
    batches = [full[:3] + short[:1], full[3:6], full[6:] + short[1:], [("r", 9, 0, at(600), 1.0)]]
    stream = stream_of(spark, tmp_path, batches, GROUPS)
    for kind, batch_fn in (("grpo", A.adv_grpo), ("rloo", A.adv_rloo)):
        step = T.group_advantage_step(["run", "prompt_id"], "ts", k=4, kind=kind)
        done, held = T.drain_batches(stream, "t", step)
        got = done.collect()
        adv = {(r.run, r.prompt_id, r.sample_id): r.adv for r in got if r.complete and r.signal and (kind == "grpo" or r.adv)}
        want = batch_fn(spark.createDataFrame(full, GROUPS), ["run", "prompt_id"]).collect()
        assert adv == pytest.approx({(r.run, r.prompt_id, r.sample_id): r.adv for r in want})
        assert [(r.signal, r.complete, r.adv) for r in got if r.prompt_id == 4] == [(False, True, 0.0)] * 4
        assert [(r.prompt_id, r.k) for r in got if not r.complete] == [(3, 2), (3, 2)]
        assert [r.prompt_id for r in held.collect()] == [9]


class Stopped(Exception):
    pass


def test_a_restart_goes_on_where_the_last_session_stopped(spark, tmp_path):
    """A session ends between batches, another one dies inside a batch, a third finishes: rows and state of one run."""
    rows = [("r", g, i, at(10 * g + i), float((g * i) % 3)) for g in range(6) for i in range(3 + g % 3)]
    parts = [rows[:5], rows[5:11], rows[11:16], rows[16:]]
    step = T.group_advantage_step(["run", "prompt_id"], "ts", k=4, wait="20 minutes")
    whole, left = T.drain_batches(stream_of(spark, tmp_path / "whole", parts, GROUPS), "t", step)
    home = str(tmp_path / "home")

    T.drain_batches(stream_of(spark, tmp_path / "part", parts[:2], GROUPS), "t", step, home)

    def dies(batch, state):
        out, after = step(batch, state)
        return out, after.withColumn("reward", F.raise_error(F.lit("lost")).cast("double"))

    second = spark.newSession()
    for i, some in enumerate(parts[2:]):
        second.createDataFrame(some, GROUPS).coalesce(1).write.parquet(f"{tmp_path}/part/b{2 + i}")
    with pytest.raises(Exception, match="lost"):
        T.drain_batches(stream_of(second, tmp_path / "part", [], GROUPS), "t", dies, home)

    third = spark.newSession()
    got, held = T.drain_batches(stream_of(third, tmp_path / "part", [], GROUPS), "t", step, home)
    key = lambda df: sorted(map(str, df.collect()))
    assert key(got) == key(whole) and key(held) == key(left)
    again, held = T.drain_batches(stream_of(spark.newSession(), tmp_path / "part", [], GROUPS), "t", step, home)  # nothing new
    assert key(again) == key(whole) and key(held) == key(left)
    assert len(list((tmp_path / "home" / "state").iterdir())) == 2  # older states are gone


def test_a_baseline_goes_on_after_a_restart(spark, tmp_path):
    rows = [(i, "ab"[i % 2], at(i), (i * 37 % 11) / 10) for i in range(30)]
    step = T.ema_baseline_step(["run"], "step")
    home = str(tmp_path / "home")
    for n in (10, 20, 30):
        spark.createDataFrame(rows[n - 10 : n], EVENTS).coalesce(1).write.parquet(f"{tmp_path}/in/b{n}")
        stream = stream_of(spark.newSession(), tmp_path / "in", [], EVENTS)
        got, _ = T.drain_batches(stream.withColumn("step", F.unix_micros("ts")), "t", step, home)
    batch = spark.createDataFrame(rows, EVENTS).withColumn("step", F.unix_micros("ts"))
    want = {(r.run, r.step): (r.baseline, r.baseline_next) for r in A.ema_baseline(batch, ["run"]).collect()}
    found = {(r.run, r.step): (r.baseline, r.baseline_next) for r in got.collect()}
    assert found.keys() == want.keys() and all(found[k] == pytest.approx(want[k], abs=1e-12) for k in want)


def test_oversized_groups_are_emitted_in_groups_of_k(spark, tmp_path):
    rows = [("r", 1, i, at(i), float(i % 3 == 0)) for i in range(11)]
    stream = stream_of(spark, tmp_path, [rows], GROUPS)
    done, held = T.drain_batches(stream, "t", T.group_advantage_step(["prompt_id"], "ts", k=4))
    assert sorted(r.sample_id for r in done.where("complete").collect()) == list(range(8))
    assert sorted(r.sample_id for r in held.collect()) == [8, 9, 10]


@pytest.mark.parametrize("name", sorted(streams.ENTRIES))
def test_queries_read_folder_tables(spark, root, tmp_path, name):
    """A table of three files, as a cluster writes it, gives the rows of the single file."""
    spark.read.parquet(f"{root}/events.parquet").repartition(3).write.parquet(f"{tmp_path}/events.parquet")
    one, three = (streams.ENTRIES[name].build(spark, str(r)) for r in (root, tmp_path))
    assert one.exceptAll(three).isEmpty() and one.count() == three.count()


def test_verified_rows_arrive_once(spark, tmp_path):
    schema = "id bigint, ts timestamp, text string, gold bigint"
    batches = [[(1, at(0), "7", 7), (2, at(1), "8", 7)], [(1, at(2), "7", 7), (3, at(3), "7 ok", 7)]]
    kept = T.rejection_stream(stream_of(spark, tmp_path, batches, schema), F.col("text"), F.col("gold"), ["id"])
    assert sorted(r.id for r in T.drain(kept, "t").collect()) == [1, 3]
