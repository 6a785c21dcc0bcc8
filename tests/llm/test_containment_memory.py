import tracemalloc

import numpy as np
import pyarrow as pa

from postmill.llm.containment import shingled


def test_memory_of_a_batch_is_that_of_a_piece():
    words = np.random.default_rng(5).integers(0, 50_000, (4_000, 350))
    texts = [" ".join(f"w{n}" for n in row) for row in words.tolist()]
    batch = pa.record_batch([pa.array(range(len(texts))), pa.array(texts)], ["doc_id", "text"])
    tracemalloc.start()
    try:
        found = [(b.num_rows, len(np.unique(owner)), len(values)) for b, values, owner in shingled(iter([batch]))]
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert batch.nbytes > 8 << 20 and sum(rows for rows, _, _ in found) == len(texts)
    assert all(rows == owners for rows, owners, _ in found) and sum(n for _, _, n in found) == 346 * len(texts)
    assert peak < 120 << 20, peak
