from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from tessera.functions.bytes import byte_to_id_table, decode_sql, encode_sql
from tessera.operators import tokens as TK


def test_byte_table_rule():
    t = byte_to_id_table()
    assert sorted(t) == list(range(5, 261))
    assert t[ord("\n")] == 203
    assert t[ord("!")] == 5


def test_special_split_and_roundtrip(spark):
    texts = ["a<|im_end|>b<s>é😀", "<|im_start|>assistant\n", "plain", "", "x<unk></s>y"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "k long, text string")
    a = TK.encode(df, "text", "ids").orderBy("k").collect()
    b = TK.encode(df, "text", "ids", impl="sql").orderBy("k").collect()
    assert [r.ids for r in a] == [r.ids for r in b]
    assert a[0].ids[1] == 4 and a[1].ids[0] == 3
    assert a[4].ids[1:3] == [0, 2]
    back = TK.decode(TK.encode(df, "text", "ids"), "ids", "back").orderBy("k").collect()
    assert [r.back for r in back] == texts
    back2 = TK.decode(TK.encode(df, "text", "ids"), "ids", "back", impl="sql").orderBy("k").collect()
    assert [r.back for r in back2] == texts


@settings(max_examples=15, deadline=None)
@given(st.lists(st.text(max_size=40), min_size=1, max_size=6))
def test_roundtrip_property(spark, texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "k long, text string")
    rows = TK.decode(TK.encode(df, "text", "ids"), "ids", "back").orderBy("k").collect()
    assert [r.back for r in rows] == texts


def test_cut_inside_character_gives_replacement(spark):
    df = spark.createDataFrame([(1, "é")], "k long, text string")
    d = TK.encode(df, "text", "ids").withColumn("ids", F.slice("ids", 1, 1))
    assert TK.decode(d, "ids", "t").first().t == "�"
    assert d.select(F.expr(decode_sql("ids")).alias("t")).first().t == "�"


def test_fit_length(spark):
    df = spark.createDataFrame([(1, list(range(1, 8))), (2, [])], "k long, ids array<int>")
    rows = {r.k: r for r in TK.fit_length(df, "ids", 5, 0).collect()}
    assert rows[1].ids == [1, 2, 3, 4, 5] and rows[1].n_real == 5
    assert rows[2].ids == [0] * 5 and rows[2].n_real == 0


def test_special_strings_in_a_batch_match_the_sql_form(spark):
    texts = ["<|im_start|>a<s>b</s>", "<", "|im_end|>", "x<|im_end|>", "é<unk>é", None, "", "a < b <html> <|im_", "end|>",
             "<|im_end|><|im_end|>"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "k long, text string").coalesce(1)
    fast = {r.k: r.ids for r in TK.encode(df, "text", "ids").collect()}
    slow = {r.k: r.ids for r in TK.encode(df, "text", "ids", impl="sql").collect()}
    assert fast == slow and fast[3][-1] == 4


def test_batches_of_the_codec_stay_small(spark):
    import pyarrow as pa
    from pyspark.sql.functions import arrow_udf

    from tessera.operators import bpe as B
    from tessera.session import ARROW_BATCH

    size = arrow_udf(lambda a: pa.array([a.nbytes] * len(a), pa.int64()), "long").asNondeterministic()
    df = spark.range(0, 120, 1, 1).select(F.col("id").alias("k"), F.repeat(F.lit("word and "), 12_000).alias("text"))
    merges = [(0, 5, 6, 261, 1, "!\"")]
    merges = B.merge_rows(spark.createDataFrame(merges, B.MERGES_SCHEMA))
    said = spark.conf.get(ARROW_BATCH)
    try:
        for make in (lambda: TK.encode(df, "text", "ids"), lambda: TK.decode(df.withColumn("ids", F.array(F.lit(9))), "ids", "t"),
                     lambda: TK.encode(df, "text", "ids", merges=merges), lambda: B.encode_by_units(df, ["k"], "text", merges)):
            spark.conf.set(ARROW_BATCH, str(64 << 20))
            make()
            most = df.select(size("text").alias("n")).agg(F.max("n")).first()[0]  # 13 MB of texts in one task
            assert most <= TK.BATCH_BYTES + 300_000
            spark.conf.set(ARROW_BATCH, "100000")
            make()
            assert spark.conf.get(ARROW_BATCH).rstrip("b") == "100000"  # smaller ones are kept
    finally:
        spark.conf.set(ARROW_BATCH, said)
