"""What the near-duplicate join holds at once in a Python worker."""

import numpy as np
import pyarrow as pa

from haulgrain.llm import jaccard_join, shingle_hash


def test_prefixes_are_packed_in_small_parts():
    class Sketch:
        value = np.ones(1 << jaccard_join.SKETCH_BITS, dtype=np.int64)

    texts = [" ".join(f"w{i}x{j}" for j in range(4_000)) for i in range(600)]
    batch = pa.RecordBatch.from_arrays([pa.array(texts)], names=["text"])
    packed = list(jaccard_join._prefixes(5, jaccard_join.SIMILAR, Sketch(), 1, 1, 10**9)(iter([batch])))
    shingles = [len(v) // 8 for b in packed for v in b.column(1).to_pylist()]
    assert sum(shingles) == 600 * 1_000
    assert max(shingles) <= 400_000


def test_chunks_of_half_a_megabyte_hash_as_before(monkeypatch):
    texts = pa.array([" ".join(f"Word{i * j % 977}" for j in range(1, 3_000)) for i in range(1, 60)])

    def sets(chunk):
        monkeypatch.setattr(shingle_hash, "CHUNK_BYTES", chunk)
        monkeypatch.setattr(shingle_hash, "_powers", {})
        return [values[a:b].tolist() for _, values, at in shingle_hash.shingle_sets(texts) for a, b in zip(at[:-1], at[1:])]

    assert shingle_hash.CHUNK_BYTES <= 1 << 19
    assert sets(1 << 19) == sets(2 << 20)
