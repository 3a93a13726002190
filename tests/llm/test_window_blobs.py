"""What op11 shuffles: ids and indexes in as few bytes as they need."""

import numpy as np
import pytest

from loadmason.llm.substring_dedup import NO_ID, narrow_ids, packed, unpacked, wide_ids


@pytest.mark.parametrize("ids", [[7], [-(2**63), -5, -5, 0, 3, NO_ID], list(range(10**12, 10**12 + 3000, 3))])
def test_ids_come_back(ids):
    blob = narrow_ids(np.array(ids, np.int64))
    assert wide_ids(blob).tolist() == ids
    assert len(ids) < 100 or len(blob) < 2 * len(ids)


@pytest.mark.parametrize("count", [1, 2, 3, 256, 257, 1000, 1 << 16])
def test_indexes_come_back_in_few_bits(count):
    numbers = np.random.default_rng(1).integers(0, count, 999)
    numbers[0] = count - 1
    blob = packed(numbers, count)
    assert unpacked(blob, count, 999).tolist() == numbers.tolist()
    assert len(blob) <= 999 * max(1, (count - 1).bit_length()) / 8 + 1
