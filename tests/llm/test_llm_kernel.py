import random
import re

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from tessera.llm import textkernel as tk
from tessera.llm.shared import components

PATTERNS = {"SPACED": r"[^\x20\x09-\x0D]+", "ALNUM": r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "LETTERS": r"[^\x00-\x60\x7B-\x7F]+"}


def ascii_lower(x):
    return re.sub("[A-Z]", lambda m: m.group().lower(), x)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(alphabet="aB z9\n\t\x00é漢.-", max_size=30)), max_size=8))
def test_words_and_hashes_match_the_pattern(texts):
    for name, pattern in PATTERNS.items():
        want = [re.findall(pattern, ascii_lower(t or "")) for t in texts]
        got, hashes = [], {}
        for _, w in tk.scan(pa.array(texts, pa.string()), getattr(tk, name)):
            raw = w.data.tobytes()
            for d in range(len(w.bounds) - 1):
                some = range(w.bounds[d], w.bounds[d + 1])
                got.append([ascii_lower(raw[w.start[i]:w.end[i]].decode()) for i in some])
                for i, word in zip(some, got[-1]):
                    assert hashes.setdefault(word, int(w.hash[i])) == int(w.hash[i])
        assert got == want
        assert len(set(hashes.values())) == len(hashes)


def test_segments_cover_documents_in_order():
    texts = pa.array(["a" * n for n in (5, 0, 9, 1, 30, 0)])
    _, offs = tk.text_buffers(texts)
    assert [x for s in tk.segments(offs, 10) for x in range(*s)] == list(range(6))


def test_lowered_keeps_length():
    raw = "ÀÉ Ñoß ЖЯ Ω漢 İx".encode()
    assert bytes(tk.lowered(np.frombuffer(raw, np.uint8))).decode() == "àé ñoß жя ω漢 İx"


def test_components_against_union_find(spark):
    rng = random.Random(3)
    edges = [(rng.randrange(200), rng.randrange(200)) for _ in range(120)] + [(i, i + 1) for i in range(300, 340)] + [(7, 7)]
    root = {}

    def find(x):
        root.setdefault(x, x)
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        if a != b:
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {x: find(x) for x in root}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_caches_of_other_operators_go_when_a_task_begins():
    mine, other = {"a": 1}, {"b": 2}
    tk.keep("mine", mine)
    tk.keep("other", other)
    assert list(tk.tidy(lambda batches: batches, "mine")([1, 2])) == [1, 2]
    assert mine and not other
    assert list(tk.tidy(lambda batches: batches)([])) == [] and not mine
