"""Items of the same words cost one search, and clashing columns are left out."""

import time

from riskloom.llm import decontaminate

ITEM = "the quick brown fox jumps over one lazy dog while nobody at all is looking on"


def test_repeated_items_take_no_longer(spark):
    text = " filler words between the places ".join([ITEM] * 20)
    docs = spark.createDataFrame([(i, text, 5, "x") for i in range(10)], "doc_id long, text string, item_id int, distance string")
    one = spark.createDataFrame([(0, ITEM)], "item_id long, text string")
    many = spark.createDataFrame([(i, ITEM) for i in range(400)], "item_id long, text string")
    assert decontaminate.find_leaks(docs, one).count() == 10
    start = time.perf_counter()
    found = decontaminate.find_leaks(docs, many)
    assert found.columns == ["doc_id", "item_id", "item_words", "distance", "end_word"]
    assert found.count() == 4_000 and found.select("doc_id", "item_id").distinct().count() == 4_000
    assert time.perf_counter() - start < 20
