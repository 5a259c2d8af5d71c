"""The sketches' limit against the exact chance of going beyond it."""

from math import comb

import pytest

from rungworks.llm import minhash
from rungworks.llm import shingles as S


def _beyond(percent, limit):
    """Of d coordinates that differ, 2 d bits are fair coins."""
    q, n = 1 - percent / 100, S.COORDINATES
    more = lambda d: sum(comb(2 * d, k) for k in range(limit + 1, 2 * d + 1)) / 4**d
    return sum(comb(n, d) * q**d * (1 - q) ** (n - d) * more(d) for d in range(n + 1))


@pytest.mark.parametrize("percent", [80, 85])
def test_a_pair_at_the_threshold_is_missed_as_seldom_as_stated(percent):
    limit = minhash.furthest(percent)
    assert _beyond(percent, limit) <= minhash.MISS < _beyond(percent, limit - 1)
