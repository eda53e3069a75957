"""Short items, scripts without spaces, and items whose id is null."""

from ordertide.llm import decontam

SENTENCE = "机器学习模型需要大量的训练数据才能得到好的结果"
ROWS = [(1, "It is a Blue, Whale song."), (2, "a blue big whale song"), (3, "第一章。" + SENTENCE + "。结束"),
        (4, "第一章。" + SENTENCE.replace("训练", "测试") + "。"), (5, "完全不同的句子没有关系"),
        (6, "สวัสดีครับ ยินดีต้อนรับ"), (7, None), (8, "one yes two"), (9, "plain text of nobody at all here")]
ITEMS = [(1, "blue whale song"), (2, SENTENCE), (3, "ยินดีต้อนรับ"), (4, "Yes!"), (5, "?!"), (6, ""),
         (None, "Plain text of nobody at all")]


def tables(spark):
    return (spark.createDataFrame(ROWS, "doc_id long, text string"),
            spark.createDataFrame(ITEMS, "item_id long, text string"))


def test_short_items_and_characters(spark):
    got = {(r.doc_id, r.item_id): r for r in decontam.find_items(*tables(spark)).collect()}
    assert {p: r.edits for p, r in got.items()} == {(1, 1): 0, (3, 2): 0, (4, 2): 2, (6, 3): 0, (8, 4): 0}
    texts, items = dict(ROWS), dict(ITEMS)
    spans = {p: texts[p[0]][r.start:r.end] for p, r in got.items()}
    assert spans[1, 1] == "Blue, Whale song" and spans[8, 4] == "yes"
    assert spans[3, 2] == SENTENCE and spans[6, 3] == items[3]


def test_items_without_an_id_are_dropped_too(spark):
    kept = decontam.drop_contaminated(*tables(spark)).collect()
    assert sorted(r.doc_id for r in kept) == [2, 5, 7]
