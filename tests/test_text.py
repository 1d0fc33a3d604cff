from hypothesis import given, settings, strategies as st

from tessera.operators.text import chunk_text


def _chunks(spark, texts, width=512):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    rows = chunk_text(df, "text", width).collect()
    out = {}
    for r in sorted(rows, key=lambda r: (r.doc_id, r.chunk_no)):
        out.setdefault(r.doc_id, []).append(r.chunk)
    return out


def test_chunk_edges(spark):
    emoji = ("ab😀" * 200)[:600]
    texts = ["ok", "x" * 512, "x" * 513, "x" * 1024, "y" * 512 + " " * 512, emoji, "   ", ""]
    got = _chunks(spark, texts)
    assert [len(got.get(i, [])) for i in range(len(texts))] == [1, 1, 2, 2, 1, 2, 0, 0]
    assert got[5] == [emoji[:512], emoji[512:]]  # cut by code point
    assert got[4] == ["y" * 512]


@settings(max_examples=20, deadline=None)
@given(st.lists(st.text(min_size=1, max_size=60), min_size=1, max_size=5))
def test_chunks_concatenate_to_text(spark, texts):
    texts = [t for t in texts if t.strip()]
    if not texts:
        return
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    from pyspark.sql import functions as F
    from tessera.functions.text import pieces
    rows = df.select("doc_id", pieces("text", 7).alias("p")).collect()
    for r in rows:
        assert "".join(r.p) == texts[r.doc_id]
        assert all(len(x) <= 7 for x in r.p)
