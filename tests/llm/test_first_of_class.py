from postmill.llm import bagminhash


def test_unlike_texts_of_one_doc_id_both_stay(spark):
    rows = [(1, "a b c d e f g"), (1, "h i j k l m n"), (2, "a b c d e f g"), (3, "h i j k l m n")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((r.doc_id, r.text) for r in bagminhash.first_of_class(df).collect())
    assert got == rows[:2]


def test_near_copies_without_doc_id_leave_one(spark):
    words = [f"w{i}" for i in range(200)]
    near = [" ".join(words), " ".join([*words[:-1], "other"])]
    df = spark.createDataFrame([(None, t) for t in near] + [(None, "alone in its class")], "doc_id long, text string")
    got = [r.text for r in bagminhash.first_of_class(df).collect()]
    assert len(got) == 2 and "alone in its class" in got
