import zlib

import numpy as np
from pyspark.sql import functions as F

from tessera.llm import op08_langid as L


def model():
    pieces = [b"\x01a", b"ab", b"abc", b"bc", b"\x01", *(bytes([c]) for c in b"abcd")]
    prob = np.vstack([np.random.default_rng(1).random((len(pieces), 2)) / 10, np.zeros(2)])
    return pieces, prob


def segmentations(raw, pieces):
    if not raw:
        yield []
    for p in pieces:
        if raw.startswith(p):
            for rest in segmentations(raw[len(p):], pieces):
                yield [p, *rest]


def buffers(words):
    ends = np.cumsum([len(w) for w in words])
    return np.frombuffer(b"".join(words), np.uint8), ends - [len(w) for w in words], ends


def test_forward_sums_all_segmentations():
    pieces, prob = model()
    words = [b"a", b"abc", b"abcabcd", b"dddd"]
    got = L.word_scores(L.Pieces(pieces), prob, *buffers(words))
    for w, s in zip(words, got):
        for lang in (0, 1):
            total = sum(np.prod([prob[pieces.index(p), lang] for p in seg]) for seg in segmentations(b"\x01" + w, pieces))
            assert abs(np.log(total) - s[lang]) < 1e-9


def test_expected_counts_by_enumeration():
    pieces, prob = model()
    words, langs, weight = [b"abc", b"abcd", b"ab"], np.array([0, 1, 0]), np.array([3.0, 2.0, 1.0])
    got = L.expected_counts(L.Pieces(pieces), prob, langs, weight, *buffers(words))
    want = np.zeros((2, len(pieces) + 1))
    for w, lang, n in zip(words, langs, weight):
        segs = list(segmentations(b"\x01" + w, pieces))
        mass = np.array([np.prod([prob[pieces.index(p), lang] for p in s]) for s in segs])
        for s, m in zip(segs, mass / mass.sum()):
            for p in s:
                want[lang, pieces.index(p)] += n * m
    assert np.allclose(got, want.ravel())


def plain_forward(pieces, prob, raw, lang):
    """Log sum over all segmentations, by exact fractions of a plain loop."""
    from fractions import Fraction

    p = {x: Fraction(float(prob[i, lang])) for i, x in enumerate(pieces)}
    longest = max(map(len, pieces))
    alpha = [Fraction(1)]
    for j in range(1, len(raw) + 1):
        value = sum((alpha[j - k] * p[raw[j - k:j]] for k in range(1, min(longest, j) + 1) if raw[j - k:j] in p), Fraction(0))
        alpha.append(value.limit_denominator(10 ** 40) if value > 1 else value)
    value = alpha[-1]
    shift = value.denominator.bit_length() - value.numerator.bit_length()
    return float(np.log(float(value * (1 << shift) if shift > 0 else value))) - shift * np.log(2)


def long_words():
    rng = np.random.default_rng(4)
    return [bytes(rng.choice(list(b"abcd"), n).astype(np.uint8)) for n in (47, 48, 49, 50, 95, 96, 97, 300, 300)]


def test_long_runs_sum_across_windows():
    pieces, prob = model()
    words = long_words()
    got = L.word_scores(L.Pieces(pieces), prob, *buffers(words))
    for w, s in zip(words, got):
        for lang in (0, 1):
            assert abs(plain_forward(pieces, prob, b"\x01" + w, lang) - s[lang]) < 1e-8 * len(w)


def test_five_thousand_bytes_and_chinese_text_with_the_public_vocabulary():
    pieces = L.vocabulary()
    prob = np.vstack([np.random.default_rng(2).random((len(pieces), 1)) / 1000, np.zeros(1)])
    chinese = "的一是不了人我在有他这为之大来以个中上们到说国和地也子时道出而要于就下得可你年生".encode() * 2
    for raw in (b"internationalization" * 250, chinese):
        at = {x: float(prob[i, 0]) for i, x in enumerate(pieces)}
        longest = max(map(len, pieces))
        text, alpha, scale = b"\x01" + raw, [1.0], 0.0
        for j in range(1, len(text) + 1):  # a plain loop, scaled at every byte
            alpha.append(sum(alpha[-k] * at.get(text[j - k:j], 0.0) for k in range(1, min(longest, j) + 1)))
            alpha, scale = [x / alpha[-1] for x in alpha[-longest:]], scale + np.log(alpha[-1])
        (got,) = L.word_scores(L.Pieces(pieces), prob, *buffers([raw]))
        assert abs(got[0] - scale) < 1e-6 * len(raw)


def test_expected_counts_of_long_runs():
    """Against the derivative of the log likelihood: the count of a piece is p * d log Z / d p."""
    pieces, prob = model()
    prob[:-1, 1] = prob[:-1, 0]
    for w in (b"abcd" * 13, b"abca" * 40):
        got = L.expected_counts(L.Pieces(pieces), prob, np.array([0]), np.array([2.0]), *buffers([w]))
        for i in range(len(pieces)):
            up, down = prob.copy(), prob.copy()
            up[i, 0] *= 1 + 1e-5
            down[i, 0] *= 1 - 1e-5
            a, b = (L.word_scores(L.Pieces(pieces), x, *buffers([w]))[0, 0] for x in (up, down))
            assert abs(got[i] - 2 * (a - b) / 2e-5) < 1e-3 * max(1, got[i])


def test_no_piece_is_left_out():
    import public_tokenizers
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    have = set(L.vocabulary())
    for i in range(sp.get_piece_size()):
        t = sp.id_to_piece(i).replace("\u2581", "", 1)
        if not sp.is_byte(i) and not sp.is_control(i) and t.isalpha() and t == t.lower():
            assert (b"\x01" if t != sp.id_to_piece(i) else b"") + t.encode() in have


def test_held_out_accuracy_and_columns(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = {r.doc_id: r for r in L.identify(df).collect()}
    rows = df.select("doc_id", "lang").collect()
    assert len(got) == len(rows)
    assert all(got[r.doc_id].held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    held = [r for r in rows if got[r.doc_id].held_out]
    assert sum(got[r.doc_id].lang_pred == r.lang for r in held) >= 0.98 * len(held)
    assert all(0 <= r.score <= 1 for r in got.values())


def test_labels_of_held_out_rows_change_nothing(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2
    other = df.withColumn("lang", F.when(out, "zz").otherwise(F.col("lang"))).withColumn("source", F.lit("s"))
    a, b = (sorted((r.doc_id, r.lang_pred, round(r.score, 9)) for r in L.identify(d).collect()) for d in (df, other))
    assert a == b


def test_edges(spark, edge, nothing):
    rows = L.identify(edge).collect()
    assert len(rows) == edge.count()
    said = {r.doc_id: r.lang_pred for r in rows if r.doc_id is not None}
    assert [said[i] for i in (0, 1, 2, 3)] == ["und"] * 4 and said[4] == said[5] == "en"
    assert all(r.score == 0 for r in rows if r.lang_pred == "und")
    assert L.identify(nothing).count() == 0
    unlearned = L.identify(edge.withColumn("lang", F.lit(None).cast("string")))
    assert {r.lang_pred for r in unlearned.collect()} == {"und"}
    kept = L.known_language(spark, edge, "")
    assert kept.columns == edge.columns
    ids = [r.doc_id for r in kept.collect()]
    assert {4, 5, 6, 7}.issubset(ids) and not {0, 1, 2, 3} & set(ids)


def test_the_stage_has_one_predictor_a_task(spark, monkeypatch):
    """The piece tables and the word cache are made once, not anew for every batch."""
    from tessera.llm import op08_langid as m

    made = spark.sparkContext.accumulator(0)
    real = m._predict

    def counted(model):
        def run(batches):
            made.add(1)
            yield from real(model)(batches)
        return run

    monkeypatch.setattr(m, "_predict", counted)
    rows = [(i, f"some english words here {i} and more" if i % 2 else f"quelques mots ici {i} et encore", "en" if i % 2 else "fr")
            for i in range(40)] + [(40, "12 34", "en")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").coalesce(1)
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    said = spark.conf.get(key)
    spark.conf.set(key, "5")
    try:
        got = m.known_language(spark, docs, "").collect()
    finally:
        spark.conf.set(key, said)
    assert {r.doc_id: r.text for r in got} == {i: t for i, t, _ in rows if i != 40}
    assert made.value == 1
