import math
import random

import pytest

from orderlens.plans import modeling as md
from orderlens.plans import parzen

SPACE = md.SearchSpace().ranges()


def hill(s):
    """Largest at a learning rate of 0.05 and depth 6, with 700 rounds mattering less."""
    return -((math.log(s["learning_rate"] / 0.05)) ** 2) - ((s["depth"] - 6) / 2) ** 2 - ((s["rounds"] - 700) / 800) ** 2


def run(trials, seed, start=parzen.START, done=None):
    done = list(done or [])
    while len(done) < trials:
        done.append(parzen.suggest(SPACE, done, [hill(d) for d in done], len(done), seed, start))
    return done


def test_learning_beats_drawing_at_random():
    guided = [max(map(hill, run(60, seed))) for seed in range(12)]
    blind = [max(map(hill, run(60, seed, start=10**6))) for seed in range(12)]
    assert sum(guided) / 12 > sum(blind) / 12
    late = [hill(d) for seed in range(12) for d in run(60, seed)[40:]]
    early = [hill(d) for seed in range(12) for d in run(60, seed)[:10]]
    assert sum(late) / len(late) > sum(early) / len(early) / 2


def test_a_stopped_search_goes_on_as_if_it_had_not():
    whole = run(30, 5)
    assert run(30, 5, done=whole[:17]) == whole
    assert run(30, 6) != whole


def test_values_stay_in_their_ranges():
    for s in run(40, 1):
        for name, r in SPACE.items():
            assert r.low <= s[name] <= r.high and (not r.whole or isinstance(s[name], int))
    whole = parzen.Range(4, 10, whole=True)
    assert {whole.value(u / 100) for u in range(101)} == set(range(4, 11))
    assert all(whole.value(whole.unit(v)) == v for v in range(4, 11))


def test_mixtures_are_densities():
    r = random.Random(2)
    for points in ([], [0.5], [0.0, 1.0, 1.0], [r.random() for _ in range(20)]):
        m = parzen.Mixture(points)
        area = sum(math.exp(m.log_density((k + 0.5) / 4000)) for k in range(4000)) / 4000
        assert area == pytest.approx(1, abs=1e-3)
        assert all(0 <= m.draw(r) <= 1 for _ in range(50))


def test_failed_trials_count_as_the_worst():
    done = run(12, 3)
    scores = [hill(d) for d in done]
    assert parzen.suggest(SPACE, done, [math.nan, *scores[1:]], 12, 3) == parzen.suggest(SPACE, done, [None, *scores[1:]], 12, 3)
