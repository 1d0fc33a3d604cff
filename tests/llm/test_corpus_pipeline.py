import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

import __spark_entry__ as entry
import corpus_pipeline
from tessera.llm import op03_mixing, registry
from tessera.llm.shared import written

from test_op07_jaccard import brute

SF = "/root/testdata/sf0.001"


def test_stages_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    kept = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = written(stage(spark, docs, SF), name)
        assert docs.columns == columns
        kept[name] = docs.collect()
    all_ = spark.read.parquet(f"{SF}/documents.parquet").collect()
    assert len(kept["language_id"]) == sum(any(c.isalpha() for c in r.text) for r in all_)
    groups = brute([(r.doc_id, r.text) for r in kept["language_id"]])
    assert {r.doc_id for r in kept["near_duplicates"]} == {c for _, c in groups.values()}
    flat = lambda x: " " + " ".join(re.findall(r"[^\W_]+", x.lower())) + " "
    bench = [flat(r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    clean = [r for r in kept["near_duplicates"] if not any(b in flat(r.text) for b in bench)]
    assert sorted(r.doc_id for r in kept["decontamination"]) == sorted(r.doc_id for r in clean)
    words = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t))
    taken, size = Counter(), Counter()
    for r in kept["mixing"]:
        taken[r.source] += words(r.text)
    for r in clean:
        size[r.source] += words(r.text)
    targets = {r.source: r.target for r in op03_mixing.targets(spark.createDataFrame(list(size.items()), "source string, size long")).collect()}
    assert all(abs(taken[s] - targets[s]) <= 1 for s in size)
    assert max(Counter((r.doc_id) for r in kept["mixing"]).values()) <= 2
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = Counter()
    for r in kept["mixing"]:
        ids = np.array(tokenizer.encode(r.text, add_special_tokens=False).ids + [2], "<u4")
        want[r.doc_id, len(ids), zlib.crc32(ids.tobytes())] += 1
    rows = corpus_pipeline.run(spark, SF).collect()
    assert Counter((r.doc_id, r.n_tokens, r.ids_crc32) for r in rows) == want
    start = 0
    for r in sorted(rows, key=lambda r: r.start):
        assert r.start == start
        start += r.n_tokens


def test_edge_rows_and_empty_tables_run_through(spark, edge, nothing, tmp_path):
    plain = edge.select(*nothing.columns)
    for name, docs in (("edge", plain), ("none", nothing)):
        docs.write.parquet(f"{tmp_path}/{name}/documents.parquet")
        spark.read.parquet(f"{SF}/benchmark.parquet").write.parquet(f"{tmp_path}/{name}/benchmark.parquet")
        rows = corpus_pipeline.run(spark, f"{tmp_path}/{name}").collect()
        assert bool(rows) == (name == "edge") and all(r.n_tokens > 1 for r in rows)
        start = 0
        for r in sorted(rows, key=lambda r: r.start):
            assert r.start == start
            start += r.n_tokens


def test_all_operators_are_registered():
    names = entry.queries()
    assert [sum(n.startswith(f"op{i}_") for n in names) for i in range(1, 14)] == [1] * 13
    assert "pipeline" in names and set(registry.ORACLE) <= set(registry.QUERIES)
