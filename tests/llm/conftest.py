import re

import pytest

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOW = {i: i + 32 for i in range(65, 91)}


@pytest.fixture(scope="session")
def words():
    """The words of a text, the plain way."""
    return lambda text: WORD.findall((text or "").translate(LOW))


def roots(nodes, links):
    """Smallest node that each node reaches."""
    up = {n: n for n in nodes}

    def top(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in links:
        a, b = top(a), top(b)
        up[max(a, b)] = min(a, b)
    return {n: top(n) for n in nodes}


@pytest.fixture(scope="session")
def reach():
    return roots
