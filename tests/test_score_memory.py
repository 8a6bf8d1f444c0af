"""Memory of one pair of blocks of the vector search."""

import tracemalloc

import numpy as np
import pyarrow as pa

from marquee.operators import vector


def test_a_pair_of_blocks_stays_small():
    r = np.random.default_rng(3)

    def side(name, n):
        return pa.table({name: np.arange(n), "vec": pa.array(list(r.normal(size=(n, 16)))), "_not": pa.nulls(n, pa.int64())})

    left, right = side("query_id", 4000), side("chunk_id", 3000)
    tracemalloc.start()
    got = vector._score_block(5, "cosine", "query_id", "chunk_id")(left, right)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert got.num_rows == 5 * 4000 and peak < 64 << 20, peak
