import random
import re
from collections import Counter

import pytest
from plans import plan
from pyspark.sql import functions as F

from postmill.fixed import RAW_COLUMNS
from postmill.operators import keys
from postmill.operators.keys import picked_rows
from postmill.plans import ledger
from postmill.session import written
from postmill.sources import files


@pytest.mark.parametrize("limit", [1 << 26, 1])
@pytest.mark.parametrize(("share", "several"), [(0.5, 0.2), (0.002, 0.5), (1.0, 0.0), (0.0, 0.0)])
def test_picked_rows_are_numbered_in_order_of_place(spark, limit, share, several):
    chance = random.Random(7)
    last = 20_000
    copies = {p: chance.choice((2, 3, 70)) if chance.random() < several else 1 for p in range(1, last + 1) if chance.random() < share}
    if share == 0.5:  # the ends of a word and of a block
        copies |= {62: 2, 63: 3, 64: 1, 65: 2, 4095: 1, 4096: 5}
    rows = written(spark.range(1, last + 1).select(F.col("id").alias("_row"), F.concat(F.lit("t"), "id").alias("text")).repartition(5), "rows")
    picked = written(spark.createDataFrame(list(copies.items()), "_row long, copies long"), "picked")
    got = picked_rows(rows, picked, "_row", "id", 100, limit)
    want = [f"t{p}" for p in sorted(copies) for _ in range(copies[p])]
    assert sorted(map(tuple, got.collect())) == list(enumerate(want, 101))


def line(title):
    return ",".join([f'"{title}"' if c == "job_title" else "here" if c in ("company_name", "job_location") else "" for c in RAW_COLUMNS])


@pytest.mark.parametrize("broadcast", [True, False])
def test_new_records_keep_file_order_and_are_not_shuffled(spark, tmp_path, monkeypatch, broadcast):
    chance = random.Random(3)
    if not broadcast:
        monkeypatch.setattr(ledger, "fits_broadcast", lambda df: False)
    shuffled = []

    def watched(df, label):
        if "job_title" in df.columns and re.search("Exchange (hash|range|Round)", plan(df)):
            shuffled.append(label)
        return written(df, label)

    monkeypatch.setattr(keys, "written", watched)
    known, want = Counter(), []
    for n in range(2):
        parts = [[f"r{chance.randrange(40)}" for _ in range(60)] for _ in range(3)]
        folder = tmp_path / str(n)
        folder.mkdir()
        for i, part in enumerate(parts):
            broken = ["ragged,record"] * (i == 1)
            (folder / f"{i}.csv").write_text("\n".join([",".join(RAW_COLUMNS), *broken, *map(line, part)]) + "\n")
        given, seen = sum(parts, []), Counter()
        counts = Counter(given)
        for title in given:
            new = max(0, counts[title] - known[title]) * (not seen[title]) if known[title] else 1
            want += [title] * new
            seen[title] += 1
        known |= counts
        state = ledger.append_csv(spark, str(folder), str(tmp_path / "w"))
    got = ledger.table(spark, state, "core.jobs").select("job_id", "job_title").collect()
    assert sorted(map(tuple, got)) == list(enumerate(want, 1))
    assert shuffled == []


def test_gzip_files_give_the_same_postings(spark, tmp_path):
    rows = spark.createDataFrame([tuple(f' "{c}", {i} ' if i else None for c in RAW_COLUMNS) for i in range(9)], ", ".join(f"{c} string" for c in RAW_COLUMNS))
    read = {}
    for gzip in (False, True):
        path = str(tmp_path / str(gzip))
        files.write_csv(rows, path, gzip=gzip)
        read[gzip] = Counter(map(tuple, files.read_postings(spark, path).select(RAW_COLUMNS).collect()))
    assert read[True] == read[False]
    assert all(f.suffix == ".gz" for f in (tmp_path / "True").glob("part-*"))
