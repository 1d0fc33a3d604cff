"""Prompt reader, vocabulary table, sample sink, progress, lookups."""

import os
import tempfile

from pyspark.sql import functions as F

from tessera.operators import batching as B
from tessera.operators import lookup as L
from tessera.plans import samples as SP
from tessera.sinks import write_samples
from tessera.sources import byte_vocab, prompts_from_list, read_prompts, special_tokens
from tessera.plans import jobs as JB


def test_read_prompts_lines_and_whole_file(spark):
    d = tempfile.mkdtemp(prefix="tessera-prompts-")
    with open(os.path.join(d, "p.txt"), "w", encoding="utf-8") as f:
        f.write("first\nsecond\n")
    lines = read_prompts(spark, d).collect()
    assert sorted(r.prompt for r in lines) == ["first", "second"]
    assert len({r.prompt_id for r in lines}) == 2
    whole = read_prompts(spark, d, whole_file=True).collect()
    assert [r.prompt for r in whole] == ["first\nsecond\n"]


def test_vocab_tables(spark):
    v = byte_vocab(spark).collect()
    assert len(v) == 261 and {r.kind for r in v} == {"special", "byte"}
    by = {r.token_id: r.piece for r in v}
    assert by[3] == "<|im_start|>" and by[203] == "\n"
    assert [r.token for r in special_tokens(spark).orderBy("token_id").collect()][3:] == ["<|im_start|>", "<|im_end|>"]


def test_render_prompts_chat_and_plain(spark):
    p = prompts_from_list(spark, ["hi"])
    chat = JB.render_prompts(p, chat=True).first()
    assert chat.rendered.endswith("<|im_start|>assistant\n") and chat.ids[0] == 3 and chat.ids[-1] == 203
    plain = JB.render_prompts(p, chat=False).first()
    assert plain.rendered == "hi" and len(plain.ids) == 2


def test_write_samples_partitioned(spark):
    df = spark.createDataFrame([(i, f"text {i} " * 30) for i in range(100)], "sid long, text string")
    smp = SP.pretrain_samples(df, "text", ["sid"])
    batches, plan = JB.plan_run(smp, ["sid"], B.RunOptions(epochs=2, batch_size=16))
    d = tempfile.mkdtemp(prefix="tessera-samples-")
    write_samples(batches.select("sid", "epoch", "batch_id", "x", "y", "loss_mask"), os.path.join(d, "s"))
    back = spark.read.parquet(os.path.join(d, "s"))
    assert back.count() == 200 and sorted(r.epoch for r in back.select("epoch").distinct().collect()) == [0, 1]
    assert all(len(r.x) == 511 for r in back.select("x").limit(5).collect())
    assert plan.count() == 14 and plan.filter("is_log").count() == 2


def test_progress(spark):
    m = spark.createDataFrame([(0, 100, 6.0), (9, 100, 60.0)], "step long, steps_per_epoch long, spent_sec double")
    got = [r.minutes_left for r in B.progress(m).orderBy("step").collect()]
    assert got == [10 - 0, 10 - 1]


def test_vector_lookup_and_checked_broadcast(spark, monkeypatch):
    vec = spark.createDataFrame([(i, [float(i)], i % 3) for i in range(10)], "vec_id long, embedding array<float>, label int")
    df = spark.createDataFrame([(1, [1, 2, 99])], "k long, ids array<int>")
    got = L.vector_lookup(df, "ids", ["k"], vec, cols=("embedding", "label"))
    assert sorted((r.pos, r.label) for r in got.collect()) == [(0, 1), (1, 2), (2, None)]
    hinted = lambda t: "strategy=broadcast" in t._jdf.queryExecution().analyzed().toString()
    assert hinted(L.checked_broadcast(vec, row_bytes=64))
    monkeypatch.setattr(L, "BROADCAST_BYTES", 100)
    assert not hinted(L.checked_broadcast(vec, row_bytes=64))


def test_scan_reads_only_needed_columns(spark):
    from tessera.sources.lines import read_table
    d = read_table(spark, "/root/testdata/sf0.001", "documents").select("doc_id")
    plan = d._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "ReadSchema: struct<doc_id:bigint>" in plan


def test_missing_input_fails_early(spark):
    import pytest
    from pyspark.errors import AnalysisException
    with pytest.raises(AnalysisException):
        JB.prepare_corpus_files(spark, "/nonexistent/corpus.jsonl", tempfile.mkdtemp() + "/o")


def test_metrics_and_generation_sinks(spark):
    from tessera.operators import beam as BM
    from tessera.sinks import append_metrics, write_generations
    scores = spark.createDataFrame([(1, 2, 0.0), (2, 1, 0.0)], "prev_id int, next_id int, score double")
    prompts = spark.createDataFrame([(7, [1])], "prompt_id long, ids array<int>")
    gen = BM.generate(prompts, scores, 3, greedy=True)
    d = tempfile.mkdtemp(prefix="tessera-sinks-")
    write_generations(gen, os.path.join(d, "gen"))
    back = spark.read.json(os.path.join(d, "gen")).first()
    assert back.prompt_id == 7 and back.new_ids == [2, 1, 2]
    m = spark.createDataFrame([(0, 0, 1.5, 2e-4)], "epoch int, step long, loss double, lr double")
    append_metrics(m, os.path.join(d, "metrics"))
    append_metrics(m.withColumn("step", F.lit(100).cast("long")), os.path.join(d, "metrics"))
    assert spark.read.parquet(os.path.join(d, "metrics")).count() == 2


def test_file_prompts(spark):
    import pytest

    from tessera.sources import expand_file_prompts
    d = tempfile.mkdtemp(prefix="tessera-fileprompt-")
    files = {"a.txt": "short", "data.txt": "<|im_start|>long\nstart", "with space [1].txt": "third"}
    for name, text in files.items():
        with open(os.path.join(d, name), "w", encoding="utf-8") as f:
            f.write(text)
    p = prompts_from_list(spark, ["plain", *("FILE:" + os.path.join(d, n) for n in files), "FILE:" + os.path.join(d, "a.txt")])
    df = expand_file_prompts(spark, p)
    assert "NestedLoopJoin" not in df._jdf.queryExecution().executedPlan().toString()
    assert {r.prompt_id: r.prompt for r in df.collect()} == dict(enumerate(["plain", *files.values(), "short"]))
    assert df.count() == 5 and df.columns == p.columns
    with pytest.raises(FileNotFoundError):
        expand_file_prompts(spark, prompts_from_list(spark, ["FILE:" + os.path.join(d, "ta.txt")]))


def test_one_file_holds_a_whole_batch(spark, tmp_path):
    from tessera.sinks.writers import read_batch, write_batch_files

    df = spark.createDataFrame([(i, f"text {i} " * 5) for i in range(200)], "sid long, text string")
    batches, _ = JB.plan_run(SP.pretrain_samples(df, "text", ["sid"]), ["sid"], B.RunOptions(epochs=2, batch_size=16))
    index = write_batch_files(batches.select("sid", "epoch", "batch_id", "batch_pos", "x"), str(tmp_path), 4)
    rows = index.collect()
    assert len(rows) == len({(r.epoch, r.batch_id) for r in rows}) == 2 * 13 and len({r.file for r in rows}) == 2 * 4
    want = [r.sid for r in batches.where("epoch = 1 and batch_id = 12").orderBy("batch_pos").collect()]
    got = read_batch(spark, str(tmp_path), 1, 12)
    assert [r.sid for r in got.collect()] == want and len(got.inputFiles()) == 1
    assert read_batch(spark, str(tmp_path), 1, 13).count() == 0


def test_batch_files_are_built_behind_the_shuffle(spark, tmp_path):
    import pyarrow.parquet as pq

    from tessera.sinks.writers import read_batch, write_batch_files

    df = spark.createDataFrame([(i, f"text {i} " * 5) for i in range(200)], "sid long, text string")
    texts, _ = JB.plan_run(df, ["sid"], B.RunOptions(epochs=2, batch_size=4))
    made = []

    def build(laid):
        made.append(SP.pretrain_samples(laid, "text").drop("n_real"))
        return made[0]

    index = write_batch_files(texts.select("sid", "text", "epoch", "batch_id", "batch_pos"), str(tmp_path / "built"), 1, build=build)
    rows = index.collect()
    assert len(rows) == len({(r.epoch, r.batch_id) for r in rows}) == len({r.file for r in rows}) == 2 * 50
    plan = made[0]._jdf.queryExecution().executedPlan().toString()
    assert plan.index("ArrowEvalPython") < plan.index("Exchange") and plan.count("ArrowEvalPython") == 1
    # the same files as of samples made first, and each in order as it lies on disk
    batches, _ = JB.plan_run(SP.pretrain_samples(df, "text", ["sid"]), ["sid"], B.RunOptions(epochs=2, batch_size=4))
    write_batch_files(batches.select("sid", "epoch", "batch_id", "batch_pos", "x", "y", "loss_mask"), str(tmp_path / "first"), 1)
    for epoch, batch in ((0, 0), (1, 49), (1, 7)):
        got, want = (read_batch(spark, str(tmp_path / k), epoch, batch) for k in ("built", "first"))
        assert got.collect() == want.collect() and got.columns == want.columns and got.count() == 4
    big = write_batch_files(texts.select("sid", "text", "epoch", "batch_id", "batch_pos"), str(tmp_path / "big"), 7,
                            build=lambda d: SP.pretrain_samples(d, "text").drop("n_real"))
    for name in {r.file for r in big.collect()}:
        t = pq.ParquetFile(name.removeprefix("file:")).read(["batch_id", "batch_pos"])
        places = list(zip(t["batch_id"].to_pylist(), t["batch_pos"].to_pylist()))
        assert places == sorted(places) and len(places) in (28, 4)


def test_batch_files_query_shuffles_texts(spark, tmp_path, monkeypatch):
    from tessera.plans import catalog_more as KM

    docs = [(i, f"text {i} " * 200, "en", "web", 0) for i in range(40)] + [(40, None, "en", "web", 0), (41, " ", "en", "web", 0)]
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(
        str(tmp_path / "documents.parquet"))
    laid, whole = [], KM.write_batch_files
    monkeypatch.setattr(KM, "write_batch_files", lambda df, *a, **k: laid.append(df) or whole(df, *a, **k))
    n = sum(-(-len(t) // 512) for _, t, *_ in docs[:40])
    got = {r.batch_id: r for r in KM.q_batch_files(spark, str(tmp_path)).collect()}
    assert sum(r.n_samples for r in got.values()) == n and len(got) == -(-n // 48)
    assert all(r.n_files == 1 and r.last_pos == r.n_samples - 1 for r in got.values())
    assert "ArrowEvalPython" not in laid[0]._jdf.queryExecution().executedPlan().toString()


def test_many_folders_are_listed_by_few_tasks(spark, tmp_path):
    from tessera.session import LISTING_TASKS
    from tessera.sinks.writers import read_batch_files, write_batch_files

    df = spark.range(80).selectExpr("0 AS epoch", "id AS batch_id", "0 AS batch_pos")
    write_batch_files(df, str(tmp_path), 1)
    before = spark.conf.get(LISTING_TASKS)
    spark.sparkContext.setJobGroup("listing", "")
    try:
        assert read_batch_files(spark, str(tmp_path)).count() == 80
        tracker = spark.sparkContext.statusTracker()
        stages = [tracker.getStageInfo(s) for j in tracker.getJobIdsForGroup("listing") for s in tracker.getJobInfo(j).stageIds]
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert max(s.numTasks for s in stages if s) <= 4 * spark.sparkContext.defaultParallelism
    assert spark.conf.get(LISTING_TASKS) == before


def test_counted_lookup_equals_the_plain_one(spark):
    df = spark.createDataFrame([(1, [3, 0, 3, 9, 0, 0]), (2, [0, 0]), (3, []), (4, [9])], "sid long, ids array<int>")
    vec = spark.createDataFrame([(0, 10.0), (3, 2.0)], "vec_id long, v double")
    plain = {}
    for r in L.vector_lookup(df, "ids", ["sid"], vec, "vec_id", ("v",)).collect():
        n, v = plain.get((r.sid, r.id), (0, None))
        plain[r.sid, r.id] = (n + 1, r.v)
    for pad in (None, 0, 77):
        got = {(r.sid, r.id): (r.n, r.v) for r in L.counted_lookup(df, "ids", ["sid"], vec, "vec_id", ("v",), pad=pad).collect()}
        assert got == plain


def test_counted_lookup_counts_inside_the_sample(spark):
    rows = [(1, [3, None, 3, 9, None, 2**62, -2**62]), (2, None), (3, []), (1, [3])]
    df = spark.createDataFrame(rows, "sid long, ids array<long>")
    vec = spark.createDataFrame([(3, 2.0), (2**62, 5.0), (3, 4.0)], "vec_id long, v double")
    out = L.counted_lookup(df, "ids", ["sid"], vec, "vec_id", ("v",), pad=3)
    assert sorted((r.sid, str(r.id), r.n, str(r.v)) for r in out.collect()) == sorted([
        (1, "3", 2, "2.0"), (1, "3", 2, "4.0"), (1, "None", 2, "None"), (1, "9", 1, "None"), (1, str(2**62), 1, "5.0"),
        (1, str(-2**62), 1, "None"), (1, "3", 1, "2.0"), (1, "3", 1, "4.0")])
    # no table of all samples' ids in a task, and the samples are made once
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Aggregate" not in plan and "Union" not in plan
