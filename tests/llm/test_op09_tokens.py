import zlib

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tessera.llm import op09_token_ids as T

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def whole():
    t = Tokenizer.from_file(PATH)
    return lambda x: t.encode(x or "", add_special_tokens=False).ids


@pytest.fixture(scope="module")
def encoder():
    with open(PATH, encoding="utf-8") as f:
        return T.Encoder(f.read())


@settings(max_examples=400, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(alphabet="ab 'stre9\n\t.,é  漢Ñ\x1c\x7f\x85|<>\u2003\xa0à\n\n\"", max_size=40)), max_size=5))
def test_chunked_ids_equal_whole_text_ids(whole, encoder, texts):
    got = [x.tolist() for x in encoder.documents(pa.array(texts, pa.string()), 2)]
    assert got == [whole(t) + [2] for t in texts]


def test_special_strings_are_encoded_as_the_library_does(whole, encoder):
    t = "a <|endoftext|> b  don't   <|endoftext|>"
    (got,) = encoder.documents(pa.array([t]), 2)
    assert got.tolist() == whole(t) + [2] and got.tolist().count(50256) == 2


def test_round_trip_and_single_document_access(spark, whole, edge):
    rows = sorted(((r.doc_id is not None, r.doc_id or 0, r.text is not None, r.text or "") for r in edge.collect()))
    manifest, job = T.write_shards(edge)
    got = T.read_shards(manifest, job).collect()
    start = 0
    assert len(got) == len(rows)
    for r, (has, doc_id, _, text) in zip(sorted(got, key=lambda r: r.start), rows):
        ids = np.array(whole(text) + [2], "<u4")
        assert (r.doc_id, r.start, r.n_tokens, r.ids_crc32) == (doc_id if has else None, start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)
    files = sorted((r for r in manifest.collect() if r.docs), key=lambda r: r.shard)
    store, _ = T.open_store(job.value["folder"])
    shard = T.Shard(store, files[-1].path, job.value["dictionary"])
    last = np.flatnonzero(shard.index["doc_id"] == 12)[0]
    assert shard.document(int(last)).tolist() == whole("漢字 тест слово") + [2]
    with pytest.raises(ValueError, match="dictionary"):
        T.Shard(store, files[0].path, b"another")


def test_dictionary_is_trained_and_used(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    manifest, job = T.write_shards(docs)
    assert len(job.value["dictionary"]) > 10_000
    assert T.read_shards(manifest, job).count() == docs.count()


def test_empty_table(nothing):
    assert T.token_ids(nothing).count() == 0


@settings(max_examples=300, deadline=None)
@given(st.lists(st.lists(st.sampled_from(["<|endoftext|>", "<|endof", "text|>", "a", " b", "  ", " ", "\n", "'s", "9", "!", "é", "漢", "\t"]),
                         max_size=9).map("".join), max_size=5))
def test_ids_equal_those_of_the_unmodified_file(encoder, texts):
    plain = Tokenizer.from_file(PATH)
    got = [x.tolist() for x in encoder.documents(pa.array(texts, pa.string()), 2)]
    assert got == [plain.encode(t, add_special_tokens=False).ids + [2] for t in texts]


def test_added_tokens_with_and_without_flags(encoder):
    from tokenizers import AddedToken

    (got,) = encoder.documents(pa.array(["a <|endoftext|> b"]), 2)
    assert got.tolist() == [64, 220, 50256, 275, 2]
    texts = ["x <sp>  y", "x <sp>", "<sp><long", "a<long>b <long", "one\n<nl>two", "word in words", "a<|endoftext|>b"]
    plain = Tokenizer.from_file(PATH)
    plain.add_tokens([AddedToken("<long", normalized=False), AddedToken("<long>", normalized=False), AddedToken("n<nl", normalized=False)])
    for extra in ([], [AddedToken("<sp>", lstrip=True, rstrip=True, normalized=False), AddedToken("word", single_word=True)],
                  [AddedToken("\n<nl>", normalized=False)]):
        plain.add_tokens(extra)
        got = [x.tolist() for x in T.Encoder(plain.to_str()).documents(pa.array(texts), 2)]
        assert got == [plain.encode(t, add_special_tokens=False).ids + [2] for t in texts]


def test_query_keeps_added_tokens(spark):
    plain = Tokenizer.from_file(PATH)
    texts = ["a <|endoftext|> b", "next text"]
    rows = sorted(T.token_ids(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect())
    ids = [np.array(plain.encode(t, add_special_tokens=False).ids + [2], "<u4") for t in texts]
    assert [(r.start, r.n_tokens, r.ids_crc32) for r in rows] == [
        (0, 5, zlib.crc32(ids[0].tobytes())), (5, len(ids[1]), zlib.crc32(ids[1].tobytes()))]


def test_rows_without_id_go_to_several_shards(spark, whole):
    rows = [(None, f"text {i % 700} of a row") for i in range(20_000)] + [(1, "one")] * 20_000
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    manifest, job = T.write_shards(df)
    full = [r.docs for r in manifest.collect() if r.docs]
    assert len(full) >= 4 and max(full) < 20_000 and sum(full) == 40_000
    got = T.read_shards(manifest, job).orderBy("start").collect()
    assert [r.doc_id for r in got] == [None] * 20_000 + [1] * 20_000
    assert sum(r.n_tokens for r in got) == sum(len(whole(t)) + 1 for _, t in rows)


def test_sample_is_bounded_by_a_threshold(spark):
    """What reaches the task that sorts the sample does not grow with the table."""
    df = spark.range(300_000).selectExpr("id as doc_id", "concat('text ', id) as text")
    most = int(((1 << 64) * 2 * T.SAMPLE_ROWS) // 300_000) - (1 << 63)
    n = df.where(f"xxhash64(doc_id, text) <= {most}").count()
    assert 1.5 * T.SAMPLE_ROWS < n < 2.5 * T.SAMPLE_ROWS
