import numpy as np
import pytest

from addrflow.llm import quality as Q


@pytest.mark.parametrize("ratings", [2_000, 4_000, 8_000])
def test_the_same_evidence_counts_at_every_number_of_ratings(ratings):
    """A word in 15 documents rated toxic and in no other, 76 % of the ratings being of grade 2."""
    rng = np.random.default_rng(1)
    grades = np.where(np.arange(ratings) % 100 < 76, 2, np.where(np.arange(ratings) % 100 < 88, 1, 0))
    toxic = np.flatnonzero(grades == 1)[:15]
    word, common = np.uint64(1 << 40), np.arange(1, 40, dtype=np.uint64)
    rows = [np.sort(rng.choice(common, 8, replace=False)) for _ in grades]
    for i in toxic:
        rows[i] = np.append(rows[i], word)
    assert word in Q.fit(grades, rows).keys
