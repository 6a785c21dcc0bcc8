import heapq
import random
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from postmill.llm import huffman_ids as hi

SCHEMA = "doc_id long, text string, shard string, segment string"

ODD = [None, "", " ", "a", "A b", "don't", "I'LL we've", "a  b\n c\t\x0bd", "<|endoftext|>", "a<|startoftext|>b", "x<|END|>y", "naïve café", "é é"]
ODD += [" a b", "a　b   c", "日本語 テスト", "😀😀 😀", "123 4,5 6.7", "x" * 200, "ab " * 700, "\x1ca \x85b", "İ ǅ ß", "'s's 's", "#$% ^&*", "​ a"]


def path():
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def texts(seed, n):
    rng = random.Random(seed)
    alphabet = ["a", "be", "cé", "TH", " ", " ", " ", "\n", ".", "'s", "1", " ", "é", "<|endoftext|>", "ß"]
    return ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 50))) for _ in range(n)]


def plain_ids(rows):
    from tokenizers import Tokenizer

    return [e.ids + [2] for e in Tokenizer.from_file(path()).encode_batch([t or "" for t in rows], add_special_tokens=False)]


@pytest.mark.parametrize("whole", [False, True])
def test_ids_equal_the_tokenizer(whole):
    rows = ODD + texts(1, 3000)
    encoder = hi.Encoder(path(), 2, whole)
    for at in range(0, len(rows), 700):
        encoder.known.most = 40
        batch = rows[at : at + 700]
        ids, counts = encoder.encode(pa.array([t or "" for t in batch]))
        assert [x.tolist() for x in np.split(ids, np.cumsum(counts)[:-1])] == plain_ids(batch)


def huffman_bits(counts):
    """Bits of the best code without a limit."""
    heap, total = list(counts), 0
    heapq.heapify(heap)
    while len(heap) > 1:
        two = heapq.heappop(heap) + heapq.heappop(heap)
        total += two
        heapq.heappush(heap, two)
    return total


def limited_bits(counts, longest):
    """Bits of the best code of limited length: counts in descending order, lengths never shorter."""
    counts = sorted(counts, reverse=True)
    best = {0: {1 << longest: 0}}
    for i, n in enumerate(counts):
        best[i + 1] = {}
        for room, bits in best[i].items():
            for size in range(1, longest + 1):
                left = room - (1 << (longest - size))
                if left >= 0 and (left not in best[i + 1] or bits + n * size < best[i + 1][left]):
                    best[i + 1][left] = bits + n * size
    return min(best[len(counts)].values())


def test_code_lengths_are_the_least():
    rng = random.Random(2)
    for _ in range(40):
        counts = {i: rng.choice([1, 2, 3, 10, 1000, 10**6]) * rng.randint(1, 9) for i in rng.sample(range(1000), rng.randint(2, 14))}
        bits = lambda lengths: sum(counts[i] * n for i, n in lengths.items())  # noqa: E731, B023
        assert bits(hi.code_lengths(counts, 30)) == huffman_bits(counts.values())
        limited = hi.code_lengths(counts, 4)
        assert max(limited.values()) <= 4 and bits(limited) == limited_bits(counts.values(), 4)
        assert sum(2.0**-n for n in limited.values()) <= 1
    assert hi.code_lengths({}) == {} and hi.code_lengths({7: 3}) == {7: 1}


@pytest.mark.parametrize("count", [0, 1, 3, 4, 5, 8, 1000])
def test_blocks_decode_on_their_own(count):
    rng = np.random.default_rng(count)
    ids = np.minimum(rng.geometric(0.05, count), 300).astype(np.uint32)
    lengths = hi.code_lengths(Counter(ids.tolist()), 12)
    payload, checkpoints = hi.pack(ids, *hi.canonical(lengths), stride=4)
    table = hi.decoding_table(lengths, 12)
    assert (hi.unpack(payload, checkpoints, count, *table, longest=12, stride=4) == ids).all()
    for block in range(len(checkpoints)):
        size = min(4, count - 4 * block)
        assert (hi.unpack(payload, checkpoints[block : block + 1], size, *table, longest=12, stride=4) == ids[4 * block :][:size]).all()


def brute(rows):
    """doc_id, start, n_tokens, ids_crc32 where rows are in file order."""
    out, start = [], 0
    for (doc, _), ids in zip(rows, plain_ids([t for _, t in rows]), strict=True):
        out.append((doc, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def test_files_hold_every_document(spark, monkeypatch):
    monkeypatch.setattr(hi, "SEGMENT_IDS", 300)
    rows = list(enumerate(ODD + texts(3, 400))) + [(None, "no id"), (None, None), (7, "again"), (7, "again"), (-5, "first id")]
    random.Random(4).shuffle(rows)
    df = spark.createDataFrame([(*r, "x", "y") for r in rows], SCHEMA).repartition(4)
    hashed = {r.text: r.h for r in df.select("text", F.xxhash64(F.coalesce("text", F.lit(""))).alias("h")).distinct().collect()}
    rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, hashed[r[1]]))
    got = hi.encoded(df, path()).collect()
    assert Counter(map(tuple, got)) == Counter(brute(rows))


def test_empty_table(spark):
    assert hi.encoded(spark.createDataFrame([], "doc_id long, text string"), path()).collect() == []
