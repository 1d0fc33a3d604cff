import pytest

from tessera.llm import op01_decontamination as D

LONG = " ".join(f"word{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(60))
ITEMS = [
    (0, "Tom has 3 red apples and Anna gives Tom 12 more apples, so how many red apples does Tom have now?"),
    (1, "A train travels 120 km in 2 hours; what is the average speed of that train in km per hour?"),
    (2, "What is 3 plus 4"), (3, "hi"), (4, None), (5, "1 2 3 4 5 6 7 8 9 10"), (0, "Tom has 3 red apples and Anna gives Tom 12 more apples, so how many red apples does Tom have now?"), (6, LONG),
]
FILL = "some other words stand here before and behind the passage in this long enough document"
DOCS = [
    (1, f"{FILL}. {ITEMS[0][1]} {FILL}"),
    (2, f"{FILL}. " + ITEMS[0][1].upper() + f" {FILL}"),
    (3, "Later Peter has 7 red apples and Maria gives Peter 25 more apples, so how many red apples does Peter have now? " + FILL),
    (4, "Later Peter has 7 red apples and Maria gives John 25 more apples, so how many red apples does Paul have now? " + FILL),
    (5, f"{FILL} a train travels 3,500.5 miles in 9 hours; what is the average speed of that train in miles per hour {FILL}"),
    (6, f"{FILL} what is 5 plus 9 {FILL}"), (7, FILL), (8, "1 2 3 4 5 6 7 8 9 10 11 12 13 14"),
    (12, FILL + " " + LONG[70:190] + " " + FILL), (13, FILL + " " + LONG[70:120] + " " + FILL),
    (None, ITEMS[1][1]), (None, ITEMS[1][1]), (9, None), (10, ""), (11, "train travels in hours what is the speed"),
]


@pytest.fixture(scope="module")
def found(spark):
    docs = spark.createDataFrame(DOCS, "doc_id long, text string").selectExpr("*", "'x' as h", "1 as k", "2 as item_id")
    items = spark.createDataFrame(ITEMS, "item_id long, text string").selectExpr("*", "'y' as pos")
    return {(r.doc_id, r.item_id): r for r in D.leaks(docs.repartition(3), items).collect()}


def test_copies_and_reworded_questions(found):
    assert set(found) == {(1, 0), (2, 0), (3, 0), (5, 1), (6, 2), (8, 5), (12, 6), (None, 1)}
    assert not found[1, 0].reworded and found[1, 0].coverage == 1.0
    assert found[3, 0].reworded and found[3, 0].consistency == 1.0


def test_stage_and_edges(spark, edge, nothing, tmp_path):
    spark.createDataFrame(ITEMS, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = spark.createDataFrame(DOCS, "doc_id long, text string")
    assert sorted(r.doc_id for r in D.without_benchmark(spark, docs, str(tmp_path)).collect()) == [4, 7, 9, 10, 11, 13]
    items = spark.read.parquet(f"{tmp_path}/benchmark.parquet")
    assert D.leaks(edge, items).count() == 0
    assert D.leaks(nothing, items).count() == 0
    assert D.leaks(docs, items.limit(0)).count() == 0


def test_against_substring_search(spark):
    import re

    d = "/root/testdata/sf0.01"
    docs, items = (spark.read.parquet(f"{d}/{t}.parquet") for t in ("documents", "benchmark"))
    flat = lambda x: " " + " ".join(re.findall(r"[^\W_]+", x.lower())) + " "
    bench = [(r.item_id, flat(r.text)) for r in items.collect()]
    want = {(r.doc_id, i) for r in docs.collect() for i, t in bench if t in flat(r.text)}
    assert want and {(r.doc_id, r.item_id) for r in D.leaks(docs, items).collect()} == want


def test_equal_windows_count_beside_an_inconsistent_value(spark):
    text = ("The farmer keeps 12 brown cows behind the old wooden barn near the river and every single morning his "
            "younger brother walks along the muddy path to bring 12 fresh buckets of water for all of them")
    pears = "Each basket holds 3 apples and 5 pears that were picked this very morning in the garden behind the house"
    docs = [(1, text), (2, text.replace("bring 12", "bring 15")), (3, text.replace("12", "15")),
            (4, pears.replace("3", "7").replace("5", "7")), (5, "keeps 12 brown cows behind the old wooden barn")]
    found = {(r.doc_id, r.item_id): r for r in D.leaks(
        spark.createDataFrame(docs, "doc_id long, text string"),
        spark.createDataFrame([(0, text), (1, pears)], "item_id long, text string")).collect()}
    assert set(found) == {(1, 0), (2, 0), (3, 0), (4, 1)}
    assert found[2, 0].coverage < 1 and found[2, 0].consistency == 1.0 and not found[2, 0].reworded
    assert found[3, 0].reworded and found[3, 0].coverage == 1.0


def test_copies_full_of_numbers_are_found(spark):
    total, table = "What is 15 + 27 + 33 + 48 + 52?", "seconds 4 8 15 16 23 42 are the numbers that open the old hatch"
    mixed = ("Sort the values 9 4 7 1 3 8 2 6 5 14 12 19 18 then write the middle value of the sorted list on the "
             "line below")
    items = [(0, total), (1, "1 2 3 4 5 6 7 8 9 10"), (2, table), (3, mixed)]
    docs = [(1, f"{FILL} {total} {FILL}"), (2, total.replace("48", "49")), (3, "0 1 2 3 4 5 6 7 8 9 10 11 12"),
            (4, "10 9 8 7 6 5 4 3 2 1"), (5, f"Wait 7 {table}"), (6, mixed), (7, FILL + " 1 2 3")]
    found = {(r.doc_id, r.item_id): r for r in D.leaks(
        spark.createDataFrame(docs, "doc_id long, text string").repartition(3),
        spark.createDataFrame(items, "item_id long, text string")).collect()}
    assert set(found) == {(1, 0), (3, 1), (5, 2), (6, 3)}
    assert all(r.coverage == 1.0 and r.consistency == 1.0 and not r.reworded for r in found.values())


def test_rows_without_id_are_judged_alone(spark):
    words = LONG.split()
    docs = spark.createDataFrame([(None, " ".join(words[:12])), (None, " ".join(words[12:24])), (3, " ".join(words[:12])),
                                  (3, " ".join(words[12:]))], "doc_id long, text string")
    items = spark.createDataFrame([(6, " ".join(words[:24]))], "item_id long, text string")
    assert [r.doc_id for r in D.leaks(docs, items).collect()] == []
    whole = docs.unionAll(spark.createDataFrame([(None, LONG)], docs.schema))
    assert [r.doc_id for r in D.leaks(whole, items).collect()] == [None]
