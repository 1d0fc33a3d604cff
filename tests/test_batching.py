import math

from pyspark.sql import functions as F

from tessera.functions.schedule import learning_rate
from tessera.operators import batching as B
from tessera.options import RunOptions


def test_batches_1000_rows(spark):
    df = spark.range(1000).withColumnRenamed("id", "sid")
    b = B.assign_batches(df, ["sid"], batch=48, epochs=2, seed=42)
    rows = b.collect()
    for e in (0, 1):
        er = [r for r in rows if r.epoch == e]
        sizes = {}
        for r in er:
            sizes[r.batch_id] = sizes.get(r.batch_id, 0) + 1
        assert len(sizes) == 21 and sizes[20] == 40 and all(v == 48 for k, v in sizes.items() if k < 20)
        assert sorted(r.sample_idx for r in er) == list(range(1000))
        assert len({r.sid for r in er}) == 1000
    o0 = [r.sid for r in sorted([r for r in rows if r.epoch == 0], key=lambda r: r.sample_idx)]
    o1 = [r.sid for r in sorted([r for r in rows if r.epoch == 1], key=lambda r: r.sample_idx)]
    assert o0 != o1
    again = B.assign_batches(df, ["sid"], batch=48, epochs=2, seed=42).collect()
    assert {(r.sid, r.epoch, r.sample_idx) for r in again} == {(r.sid, r.epoch, r.sample_idx) for r in rows}
    other = B.assign_batches(df, ["sid"], batch=48, epochs=1, seed=7).collect()
    assert [r.sid for r in sorted(other, key=lambda r: r.sample_idx)] != o0


def test_data_window_is_bucketed(spark):
    """The per-row window runs per (epoch, bucket); only the bucket-count
    summary (buckets x epochs rows) may meet in one partition."""
    import re
    df = spark.range(100).withColumnRenamed("id", "sid")
    plan = B.assign_batches(df, ["sid"])._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"row_number\(\) windowspecdefinition\([^)]*bkt_", plan)
    assert "rangepartitioning" not in plan


def _lr(spark, step, total, warmup, base=2e-4):
    return spark.range(1).select(learning_rate(F.lit(step), total, base, warmup).alias("lr")).first().lr


def test_schedule_cases(spark):
    assert math.isclose(_lr(spark, 0, 100, 0), 2e-4)
    assert math.isclose(_lr(spark, 100, 100, 0), 2e-5)
    assert math.isclose(_lr(spark, 150, 100, 0), 2e-5)
    assert math.isclose(_lr(spark, 5, 100, 10), 1e-4)
    assert math.isclose(_lr(spark, 10, 10, 10), 2e-5)  # warm-up = total: guarded


def test_run_plan(spark):
    p = B.run_plan(spark, 1000, RunOptions(epochs=2)).collect()
    assert len(p) == 42 and p[21].epoch == 1 and p[21].step == 0 and p[21].global_step == 21
    assert [r.step for r in p if r.is_update and r.epoch == 0] == [7, 15]
    assert all(r.carries_over == (r.step >= 16) for r in p)


def test_update_numbers_carry_over_epochs(spark):
    from pyspark.sql import functions as F

    for per, epochs, acc in ((11, 3, 4), (3, 2, 4), (8, 2, 4), (1, 1, 1)):
        opts = B.RunOptions(epochs=epochs, accumulation_steps=acc)
        steps = spark.range(per * epochs).select((F.col("id") / per).cast("int").alias("epoch"), (F.col("id") % per).alias("step"))
        got = {(r.epoch, r.step): r.update_no for r in B.update_numbers(steps, per, opts).collect()}
        pending, n = [], 0
        for e in range(epochs):
            for s in range(per):
                pending.append((e, s))
                if (s + 1) % acc == 0:
                    assert all(got[x] == n for x in pending)
                    pending, n = [], n + 1
        assert all(got[x] is None for x in pending)


def test_rows_come_once_an_epoch_without_a_join(spark):
    from tessera.functions.arrays import first_numbers
    from tessera.operators.scoring import draw

    for n in (0, 1, 5):
        assert [r.i for r in spark.range(1).select(F.explode(first_numbers(n)).alias("i")).collect()] == list(range(n))
    rows = spark.range(10).withColumnRenamed("id", "k")
    twice = B.assign_batches(rows, ["k"], batch=4, epochs=2)
    assert sorted((r.epoch, r.k) for r in twice.collect()) == [(e, k) for e in range(2) for k in range(10)]
    drawn = draw(rows.selectExpr("k % 2 as g", "k as c", "0D as s"), "g", "c", "s", n=3)
    assert sorted((r.g, r.draw) for r in drawn.collect()) == [(g, d) for g in range(2) for d in range(3)]
    plan = drawn._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
