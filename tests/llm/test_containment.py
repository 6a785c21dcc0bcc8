import random
import re

import pytest

from postmill.llm import containment


def grams(text):
    words = [w.encode() for w in re.findall(r"(?:[^\x00-\x7f]|[a-zA-Z0-9])+", (text or "").lower())]
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)}


def brute(docs, items):
    out = []
    for d, t in docs:
        have = grams(t)
        for i, x in items:
            own = grams(x)
            if own and len(own & have) >= 0.8 * len(own):
                out.append((d, i))
    return sorted(out, key=repr)


def tables():
    rng = random.Random(4)
    words = [f"wörd{i}" for i in range(300)]
    text = lambda n: " ".join(rng.choice(words) for _ in range(n))
    items = [(i, text(rng.choice([5, 8, 20, 60, 400]))) for i in range(40)] + [(90, None), (91, ""), (92, "too short"), (3, text(9)), (None, text(12))]
    docs = []
    for i in range(120):
        own = text(rng.choice([0, 3, 40, 3000]))
        item = rng.choice(items)[1] or ""
        if i % 3 == 0:
            own = f'{own} "{item.upper()}!" {text(30)}'
        elif i % 3 == 1:
            parts = item.split()
            for _ in range(rng.randint(0, 4)):
                if parts:
                    parts[rng.randrange(len(parts))] = "other"
            own = own + ", " + "\n".join(parts)
        docs.append((i, own))
    docs += [(1, None), (None, items[0][1]), (5, items[2][1]), (5, items[2][1])]
    return docs, items


@pytest.mark.parametrize("block_bytes", [1 << 20, 3000])
def test_pairs_equal_brute_force(spark, block_bytes):
    docs, items = tables()
    d = spark.createDataFrame([(*r, 1) for r in docs], "doc_id long, text string, item_id int")
    b = spark.createDataFrame(items, "item_id long, text string")
    got = containment.contained_items(d, b, block_bytes)
    want = brute(docs, items)
    assert sorted([(r.doc_id, r.item_id) for r in got.collect()], key=repr) == want
    assert len(want) > 40
    bad = {x for x, _ in want}
    clean = containment.without_items(d, b, block_bytes)
    assert clean.columns == d.columns
    rows = sorted([(r.doc_id, r.text) for r in clean.collect()], key=repr)
    whole = [(x, t) for x, t in docs if not any(brute([(x, t)], items))]
    assert rows == sorted(whole, key=repr)
    assert bad


def test_empty_tables(spark):
    d = spark.createDataFrame([], "doc_id long, text string")
    b = spark.createDataFrame([(1, "a b c d e f")], "item_id long, text string")
    assert containment.contained_items(d, b).collect() == []
    assert containment.contained_items(b.withColumnRenamed("item_id", "doc_id"), b.limit(0)).collect() == []
    assert containment.without_items(d, b).collect() == []
