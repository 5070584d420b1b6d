"""Loss of the filter by marks at similarity 0.8."""

from math import comb

from driftwell.llm.bagminhash import LEAST_AGREE, SIGNATURE


def test_loss_of_the_mark_filter():
    p = 0.8 + 0.2 / 16  # equal components, and others whose four bits agree
    loss = sum(comb(SIGNATURE, k) * p**k * (1 - p) ** (SIGNATURE - k) for k in range(LEAST_AGREE))
    assert loss < 3e-8
