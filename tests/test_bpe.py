"""BPE training equals a plain-Python trainer on a small fixture."""

import collections

import regex

from tessera.functions.bytes import byte_to_id_table
from tessera.operators import bpe, tokens as TK
from tessera.options import PRETOKEN_PATTERN

N = 60


def _python_merges(texts, n):
    lut = byte_to_id_table()
    cnt = collections.Counter()
    for t in texts:
        for w in regex.findall(PRETOKEN_PATTERN, t):
            cnt[tuple(lut[b] for b in w.encode())] += 1
    words, out = dict(cnt), []
    for k in range(n):
        pc = collections.Counter()
        for w, c in words.items():
            for i in range(len(w) - 1):
                pc[(w[i], w[i + 1])] += c
        (a, b), c = max(pc.items(), key=lambda kv: (kv[1], -kv[0][0], -kv[0][1]))
        out.append((a, b, c))
        new, nw = 261 + k, {}
        for w, cc in words.items():
            o, i = [], 0
            while i < len(w):
                if i < len(w) - 1 and w[i] == a and w[i + 1] == b:
                    o.append(new)
                    i += 2
                else:
                    o.append(w[i])
                    i += 1
            nw[tuple(o)] = nw.get(tuple(o), 0) + cc
        words = nw
    return out, cnt


def test_train_matches_python(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    texts = [r.text for r in docs.collect()]
    want, cnt = _python_merges(texts, N)
    m = bpe.train_bpe(docs, "text", n_merges=N, checkpoint_every=3)
    got = [(r.a, r.b, r.n) for r in m.orderBy("rank").collect()]
    assert got == want
    # first-round pair counts equal too
    pc = collections.Counter()
    for w, c in cnt.items():
        for i in range(len(w) - 1):
            pc[(w[i], w[i + 1])] += c
    rows = bpe.pair_counts(bpe.word_table(docs, "text")).collect()
    assert {(r.a, r.b): r.n for r in rows} == dict(pc)
    # merge-aware round trip, fewer ids than bytes
    e = TK.encode(docs, "text", "ids", merges=m)
    back = TK.decode(e, "ids", "back", merges=m)
    assert back.filter("back <> text").count() == 0
    assert e.selectExpr("sum(size(ids))").first()[0] < TK.encode(docs, "text", "b").selectExpr("sum(size(b))").first()[0]


def test_java_pretokens_match_python(spark):
    from pyspark.sql import functions as F
    texts = ["a　b\xa0c\x1cd  e f 12 x's  \xa0\xa0g", "Hello  world's  \n x 12!!", "  lead", "tail  ",
             "<|im_start|>user\nhi <s> there</s><|im_end|>\n"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "k long, text string")
    got = {r.k: r.w for r in df.select("k", F.regexp_extract_all("text", F.lit(bpe.JAVA_PRETOKEN), F.lit(0)).alias("w")).collect()}
    for i, t in enumerate(texts):
        assert got[i] == regex.findall(PRETOKEN_PATTERN, t), t
    u = {r.k: r.u for r in df.select("k", bpe.units("text").alias("u")).collect()}
    assert u[4][0] == "<|im_start|>" and "<s>" in u[4] and u[4][-2:] == ["<|im_end|>", "\n"]


def test_chat_samples_with_merges_mark_answers(spark):
    """With merges the header is encoded with the same merges, and the marked
    targets decode to exactly the assistant content plus the end token."""
    from pyspark.sql import functions as F

    from tessera.operators import chat as C, masks as M
    from tessera.plans import samples as SP
    turns = spark.createDataFrame(
        [(1, 0, "user", "hi there"), (1, 1, "assistant", "assistant answers assistant"),
         (2, 0, "user", "q"), (2, 1, "assistant", "ok"), (2, 2, "user", "more"), (2, 3, "assistant", "yes")],
        "conv_id long, turn long, role string, text string")
    chats = C.render_turns(turns)
    m = bpe.train_bpe(chats, "text", n_merges=12)
    header = M.answer_header("assistant", m)
    assert header[0] == 3 and len(header) < 11  # merged, shorter than bytes
    s = SP.chat_samples(chats, messages=None, text="text", keys=["conv_id"], merges=m)
    marked = s.select("conv_id", F.expr("filter(zip_with(y, loss_mask, (a, b) -> IF(b = 1, a, -1)), v -> v >= 0)").alias("ids"))
    got = {r.conv_id: r.back for r in TK.decode(marked, "ids", "back", merges=m).collect()}
    assert got[1] == "assistant answers assistant<|im_end|>"
    assert got[2] == "ok<|im_end|>yes<|im_end|>"


def test_vocab_with_merges(spark):
    from tessera.sources import byte_vocab
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("text")
    m = bpe.train_bpe(docs, "text", n_merges=3)
    v = {r.token_id: (r.piece, r.kind) for r in byte_vocab(spark, m).collect()}
    assert len(v) == 264 and v[263][1] == "merge"
    for r in m.collect():
        assert v[r.new_id][0] == v[r.a][0] + v[r.b][0]


def test_certain_merges_rules():
    pick = lambda best, complete=True: [p for p, _ in bpe.certain_merges(best, complete)]
    assert pick([]) == []
    assert pick([("ab", 9), ("cd", 8), ("ef", 7)]) == ["ab", "cd", "ef"]
    assert pick([("ab", 9), ("bc", 8), ("ef", 7)]) == ["ab"]  # shares b: its count falls, and it may beat ef
    assert pick([("ab", 9), ("cd", 8), ("da", 8)]) == ["ab"]  # a tie that shares a symbol
    assert pick([("ab", 9), ("cd", 8)], complete=False) == ["ab"]  # more ties may follow the list


def test_long_unit_is_merged_in_reasonable_time():
    import time

    ranks = {(1, 1): (0, 2), (2, 2): (1, 3)}
    t = time.time()
    assert bpe._bpe_word([1] * 100_000, ranks) == [3] * 25_000
    assert time.time() - t < 5


def test_all_merges_are_used_and_oversized_tables_refused(spark, monkeypatch):
    import pytest

    m = spark.createDataFrame([(0, 69, 69, 261, 5, "aa"), (1, 261, 261, 262, 4, "aaaa")], bpe.MERGES_SCHEMA)
    df = spark.createDataFrame([("aaaa",)], "text string")
    assert TK.encode(df, "text", "ids", merges=m).first().ids == [262]
    monkeypatch.setattr(bpe, "MAX_VOCABULARY", 1)
    with pytest.raises(ValueError):
        TK.encode(df, "text", "ids", merges=m)


def test_runs_of_equal_symbols_match_python(spark):
    """The pair (X,X) of a merged run grows from the merged pair itself and can beat the next pairs."""
    assert [p for p, _ in bpe.certain_merges([("cd", 9), ("aa", 8), ("ef", 7)], True)] == ["cd", "aa"]
    texts = [" " * 8] * 100 + ["cd"] * 250 + ["ef"] * 90
    for t, n in (("=" * 40, 60), ("-" * 33, 45), ("." * 7, 300), (" " * 17 + "x", 80), ("=-" * 9, 70), ("gh", 333)):
        texts += [t] * n
    docs = spark.createDataFrame([(t,) for t in texts], "text string")
    first = bpe.train_bpe(docs.limit(440), "text", n_merges=4).orderBy("rank").collect()
    assert [(r.a, r.b, r.n) for r in first] == _python_merges(texts[:440], 4)[0]
    want, _ = _python_merges(texts, 24)
    got = [(r.a, r.b, r.n) for r in bpe.train_bpe(docs, "text", n_merges=24).orderBy("rank").collect()]
    assert got == want


def _public_merges(spark):
    """The 50,000 merges of a public byte-level file in this library's ids."""
    import json

    import public_tokenizers

    with open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as f:
        model = json.load(f)["model"]
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    letters = {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in set(plain))}
    lut = byte_to_id_table()
    ids, piece = {c: lut[b] for c, b in letters.items()}, {c: chr(b) for c, b in letters.items()}
    rows = []
    for r, m in enumerate(model["merges"]):
        a, b = m.split(" ") if isinstance(m, str) else m
        ids[a + b], piece[a + b] = 261 + r, piece[a] + piece[b]
        rows.append((r, ids[a], ids[b], 261 + r, 0, piece[a + b]))
    return spark.createDataFrame(rows, bpe.MERGES_SCHEMA), {ids[t]: i for t, i in model["vocab"].items() if t in ids}


def test_ids_of_a_large_merge_table_equal_the_library(spark):
    """50,000 merges: per batch and by the join of distinct units, against the tokenizers library."""
    import public_tokenizers
    from tokenizers import Tokenizer

    merges, theirs = _public_merges(spark)
    merges = bpe.merge_rows(merges)
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    docs = docs.unionAll(spark.createDataFrame([(-1, None), (-2, ""), (-3, "  \n\n x's \u3000\u00e9\U0001f600 " * 3)], docs.schema))
    lib = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = {r.doc_id: lib.encode(r.text, add_special_tokens=False).ids for r in docs.collect() if r.text is not None}
    batch = {r.doc_id: r.ids for r in TK.encode(docs, "text", "ids", merges=merges).collect()}
    joined = {r.doc_id: r.ids for r in bpe.encode_by_units(docs, ["doc_id"], "text", merges).collect()}
    assert batch == joined and batch[-1] is None and batch[-2] == []
    assert {d: [theirs[i] for i in ids] for d, ids in batch.items() if ids is not None} == want


def test_list_of_pairs_runs_out_and_is_counted_again(spark, monkeypatch):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("text")
    want, _ = _python_merges([r.text for r in docs.collect()], 120)
    for listed, best in ((40, 256), (3, 2), (1, 1)):
        monkeypatch.setattr(bpe, "LISTED", listed)
        monkeypatch.setattr(bpe, "ROUND_PAIRS", best)
        n = 120 if listed == 40 else 12
        got = [(r.a, r.b, r.n) for r in bpe.train_bpe(docs, "text", n_merges=n).orderBy("rank").collect()]
        assert got == want[:n], listed
    ties = spark.createDataFrame([(w,) for w in ("ab", "cd", "ef", "gh", "ij", "kl")], "text string")
    assert [r.a for r in bpe.train_bpe(ties, "text", n_merges=9).orderBy("rank").collect()] == [byte_to_id_table()[ord(c)] for c in "acegik"]


def test_unit_join_meets_the_units_once_a_block(spark):
    """Not once a text: what is shuffled to the encoded units follows a block's distinct units."""
    from tessera.operators import bpe as m

    merges = m.merge_rows(spark.createDataFrame([(0, 36 + 32, 36 + 40, 261, 1, "ab")], m.MERGES_SCHEMA))
    rows = [(i, "the same words in every text <|im_end|> and more") for i in range(400)] + [(400, None), (401, ""), (None, "lost key")]
    df = spark.createDataFrame(rows, "k long, text string")
    joined = m.encode_by_units(df, ["k"], "text", merges)
    assert {r.k: r.ids for r in joined.collect() if r.k is not None} == {
        r.k: r.ids for r in m.encode_with_merges(df, "text", merges).collect() if r.k is not None}
    plan = joined._jdf.queryExecution().optimizedPlan().toString()
    assert "collect_list" not in plan and "FlatMapCoGroupsInArrow" in plan

    twice = spark.createDataFrame([(1, "a b"), (1, "a c"), (1, None), (None, "a")], "k long, text string")
    got = sorted((r.k is None, r.k, r.ids) for r in m.encode_by_units(twice, ["k"], "text", merges).collect())
    one = m.encode_with_merges(spark.createDataFrame([(1, "aa b c")], "k long, text string"), "text", merges).first().ids
    assert got == [(False, 1, one)] * 3 + [(True, None, [])]  # rows of one key by place, as the key names a row
