"""How much plain text the near-duplicate join hashes at once, however well its frames are compressed."""

import numpy as np
import pyarrow as pa
import pytest
import zstandard

from lonja.llm import near_join

#: Texts that compress to a hundredth and less, a few of them larger than a slice.
TEXTS = [" ".join(f"w{(i * 7 + k) % 40}" for k in range(9000 + 40 * i)) for i in range(40)] + ["a b c d e f " * 60_000]
LARGEST = max(map(len, TEXTS))


class Rows:
    def select(self, *_):
        return self

    def mapInArrow(self, run, _):
        return run


@pytest.fixture
def hashed(monkeypatch):
    sizes = []

    class Hasher(near_join.Hasher):
        def words(self, data, at):
            sizes.append(len(data))
            return super().words(data, at)

    monkeypatch.setattr(near_join, "Hasher", Hasher)
    return sizes


def test_pairs_are_cut_by_their_plain_bytes(hashed):
    frames = [zstandard.ZstdCompressor().compress(text.encode()) for text in TEXTS]
    ids = list(range(len(TEXTS)))
    batch = pa.RecordBatch.from_arrays(
        [pa.array(ids), pa.array(ids[1:] + ids[:1]), pa.array(frames), pa.array(frames[1:] + frames[:1])], ["a", "b", "frame_a", "frame_b"])
    found = pa.Table.from_batches(near_join._similarities(Rows(), 5, 0.8)(iter([batch]))).to_pylist()
    assert [(row["a"], row["b"]) for row in found] == [(i, i + 1) for i in range(39)]
    assert max(hashed) <= 2 * LARGEST and sum(hashed) == 2 * sum(map(len, TEXTS))


def test_blocks_are_hashed_in_slices(hashed):
    block = [{"frame": zstandard.ZstdCompressor().compress(text.encode())} for text in TEXTS]
    linked = near_join._compared(5, 0.8)(block, None)
    assert max(hashed) <= LARGEST and sum(hashed) == sum(map(len, TEXTS))
    assert linked[:40, :40].sum() == 40 * 39 and not linked[40].any() and not np.diag(linked).any()
