"""Corpus and chat line classification on the edge rows of FIXTURES §3."""

from pyspark.sql import functions as F

from tessera.operators import quality as Q
from tessera.operators.chat import to_messages

CORPUS = [
    ("", "blank"), ("   ", "blank"), ("　", "blank"), ("\u001c", "blank"),
    ('{"text":"ok"}', "ok"),
    ('{"nt":1}', "skip"), ('{"text":""}', "skip"), ('{"text":"  "}', "skip"),
    ('{"text":null}', "error"), ('{"text":5}', "error"), ('{"text":true}', "error"),
    ('{"text":["q"]}', "error"),
    ("[1]", "error"), ('"s"', "error"), ("5", "error"), ("{bad", "error"),
    ("{'text':'x'}", "error"), ('{"text":NaN}', "error"),
    (' 　{"text":"padded"}　 ', "ok"),
]


def test_corpus_classes(spark):
    df = spark.createDataFrame([(i, v) for i, (v, _) in enumerate(CORPUS)], "line_id long, value string")
    got = {r.line_id: r.outcome for r in Q.classify_corpus(df).collect()}
    for i, (v, want) in enumerate(CORPUS):
        assert got[i] == want, (v, got[i], want)


STRICT = [
    ('{"text":"a"} junk', "error", "json"), ('{"text":"a"}{"text":"b"}', "error", "json"), ('{"text":"a"}, {"text":"b"}', "error", "json"),
    ('{"text":"a"}] [', "error", "json"), ('{"text":"a"},1] x', "error", "json"), ('{"text":"d1","text":"d2"}', "ok", "d2"),
    ('{"text":"d1","text":5}', "error", "type:BIGINT"), ('{"x":NaN,"text":"t"}', "ok", "t"), ('{"x":{"y":1,"y":2},"text":" "}', "skip", None),
    ('{"x":-Infinity}', "skip", None), ('{"text":NaN}', "error", "type:DOUBLE"), ('"s" junk', "error", "json"), ("[1] [2]", "error", "json"),
    ('{"text":"a","text":"\\ud800b"}', "ok", "\ufffdb"), ("{" * 5000, "error", "json"), ('{"a":1,}', "error", "json"),
]


def test_strict_route(spark):
    df = spark.createDataFrame([(i, v) for i, (v, _, _) in enumerate(STRICT)], "line_id long, value string")
    got = {r.line_id: (r.outcome, r.text if r.outcome == "ok" else r.reason) for r in Q.classify_corpus(df).collect()}
    for i, (v, outcome, what) in enumerate(STRICT):
        assert got[i] == (outcome, what), (v[:40], got[i])


def test_strict_chat_route(spark):
    chat = '{"conversations":[{"from":"human","value":"x","value":"h"},{"from":"assistant","value":null},{"from":"human"}%s],"n":NaN}%s'
    lines = [(chat % ("", ""), "ok"), (chat % (',"s"', ""), "item"), (chat % ("", " x"), "json"), ('{"conversations":1,"conversations":{}}', "type:OBJECT"),
             ('{"a":1,"a":2}', "missing")]
    df = spark.createDataFrame([(i, v) for i, (v, _) in enumerate(lines)], "line_id long, value string")
    c = Q.classify_chats(df)
    assert {r.line_id: r.reason or r.outcome for r in c.collect()} == {i: w for i, (_, w) in enumerate(lines)}
    (m,) = to_messages(c.filter(F.col("outcome") == "ok"), "items", system_prompt="S").collect()
    assert [(x.role, x.content) for x in m.messages] == [("system", "S"), ("user", "h"), ("assistant", None), ("user", "")]


def test_a_line_beyond_the_variant_limit_is_kept(spark, tmp_path):
    n = 135_000_000
    with open(tmp_path / "long.jsonl", "w") as f:
        f.write('{"text":"' + "x" * n + '"}\n{"text":"short"}\n')
    lines = spark.read.text(str(tmp_path / "long.jsonl"))
    c = Q.classify_corpus(lines).select("outcome", "reason", F.length("text").alias("n"))
    assert sorted(tuple(r) for r in c.collect()) == [("ok", None, 5), ("ok", None, n)]


def test_counters_and_rejects(spark):
    df = spark.createDataFrame([(i + 1, v) for i, (v, _) in enumerate(CORPUS)], "line_id long, value string")
    c = Q.classify_corpus(df)
    counts = {r.outcome: r.n for r in Q.run_counters(c).collect()}
    assert counts["ok"] == 2 and counts["error"] == 10 and counts["skip"] == 3 and counts["blank"] == 4
    rej = Q.reject_samples(c, 3).collect()
    assert [r.line_id for r in rej] == [9, 10, 11]
    assert all(len(r.excerpt) <= 50 for r in rej)


CHATS = [
    ('{"conversations":[{"from":"human","value":"h"},{"from":"assistant","value":"a"}]}', "ok",
     [("system", "S"), ("user", "h"), ("assistant", "a")]),
    ('{"conversations":[{"from":"human","value":"h"},{"from":"x","value":"z"},{"from":"assistant","value":"a"}]}',
     "ok", [("system", "S"), ("user", "h"), ("assistant", "a")]),
    ('{"conversations":[{"from":"human"},{"from":"assistant","value":null}]}', "ok",
     [("system", "S"), ("user", ""), ("assistant", None)]),
    ('{"conversations":[]}', "ok", [("system", "S")]),
    ('{"other":1}', "error", None),
    ('{"conversations":null}', "error", None),
    ('{"conversations":["s"]}', "error", None),
    ("{bad", "error", None),
    ('{"conversations":{}}', "error", None),
    ('{"conversations":""}', "error", None),
    ("   ", "blank", None),
]


def test_chat_classes_and_messages(spark):
    df = spark.createDataFrame([(i, v) for i, (v, _, _) in enumerate(CHATS)], "line_id long, value string")
    c = Q.classify_chats(df)
    m = to_messages(c.filter(F.col("outcome") == "ok"), "items", system_prompt="S")
    got = {r.line_id: r.outcome for r in c.collect()}
    msgs = {r.line_id: [(x.role, x.content) for x in r.messages] for r in m.collect()}
    for i, (_, want, want_msgs) in enumerate(CHATS):
        assert got[i] == want, (i, got[i], want)
        if want_msgs is not None:
            assert msgs[i] == want_msgs


def test_rejects_of_several_files_and_job_counters(spark, tmp_path):
    from tessera.plans import jobs as JB

    (tmp_path / "in").mkdir()
    for name in ("a", "b"):
        (tmp_path / "in" / f"{name}.jsonl").write_text('{bad\n{"text":"' + "x" * 600 + '"}\n[1]\n\n{"nt":1}\n')
    r = JB.prepare_corpus_files(spark, str(tmp_path / "in"), str(tmp_path / "out"))
    assert r["counters"] == {"ok": 2, "skip": 2, "error": 4, "blank": 2, "chunks": 4}
    assert [(x["file"][-7:], x["line_id"], x["reason"]) for x in r["rejects"]] == [
        ("a.jsonl", 1, "json"), ("a.jsonl", 3, "not_object"), ("b.jsonl", 1, "json"), ("b.jsonl", 3, "not_object")]
    assert spark.read.json(str(tmp_path / "out")).count() == 4


def test_strip_is_linear_and_full(spark):
    import time

    df = spark.createDataFrame([(" \u3000a" + " " * 200_000 + "b\u001c\n",)], "value string")
    t = time.time()
    got = df.select(Q.strip_blank(F.col("value")).alias("v")).first().v
    assert got == "a" + " " * 200_000 + "b" and time.time() - t < 10
