import math
import random

import pytest

from keepsight.operators.hypothesis import (
    churn_by_ticket_group,
    mann_whitney,
    normality_screen,
)
from tests.helpers import rows


def wins(high, low):
    return sum((a > b) + 0.5 * (a == b) for a in high for b in low)


@pytest.mark.parametrize("seed", range(3))
def test_u_counts_pairs(table, seed):
    rng = random.Random(seed)
    data = [(rng.random() < 0.4, rng.randint(0, 6)) for _ in range(60)]
    high, low = ([v for g, v in data if g is side] for side in (True, False))
    ((n1, n2, u, z, p, _),) = rows(mann_whitney(table(data, "g boolean, v int"), "v", "g"))
    assert (n1, n2, u) == (len(high), len(low), wins(high, low))
    flipped = table([(not g, v) for g, v in data], "g boolean, v int")
    assert rows(mann_whitney(flipped, "v", "g"))[0][2] == n1 * n2 - u
    assert p == pytest.approx(0.5 * math.erfc(z / math.sqrt(2)), abs=1e-6)


def test_worked_example(table):
    # values 1 1 | 0 0 1: U = 2 * (1 + 1 + 0.5), ties of 2 and 3
    data = [(True, 1), (True, 1), (False, 0), (False, 0), (False, 1)]
    ((_, _, u, z, _, reject),) = rows(mann_whitney(table(data, "g boolean, v int"), "v", "g"))
    sigma = math.sqrt(2 * 3 / 12 * (6 - (6 + 24) / 20))
    assert u == 5.0
    assert z == pytest.approx((5 - 3 - 0.5) / sigma)
    assert reject is False


def test_no_p_without_variance_or_group(table):
    equal = table([(True, 1), (False, 1)], "g boolean, v int")
    assert rows(mann_whitney(equal, "v", "g")) == [(1, 1, 0.5, None, None, None)]
    alone = table([(True, 1), (True, 2)], "g boolean, v int")
    assert rows(mann_whitney(alone, "v", "g"))[0][3:] == (None, None, None)


def test_normality(table):
    data = [(True, 1.0), (True, 2.0), (False, 3.0), (False, 3.0), (False, 3.0)]
    data += [(None, float(x)) for x in (1, 2, 2, 3, 3, 3, 4, 4, 5)]
    got = {r[0]: r[1:] for r in rows(normality_screen(table(data, "g boolean, v double"), "v", "g"))}
    assert got[True][-1] == got[False][-1] == "insufficient data"
    assert got[None][-1] == "NORMAL"
    n, skew, excess, jb, p, _ = got[None]
    assert jb == pytest.approx(n / 6 * (skew**2 + excess**2 / 4))
    assert p == pytest.approx(math.exp(-jb / 2))


def test_groups(table):
    df = table([(True, True), (True, False), (False, False)], "high_ticket boolean, is_churned boolean")
    assert rows(churn_by_ticket_group(df)) == [(True, 2, 0.5), (False, 1, 0.0)]
