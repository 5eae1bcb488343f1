import numpy as np

from orderlens.llm import embedding_dedup as ed


def brute(rows):
    ok = [(i, np.array(v, float) / np.abs(v).max()) for i, v in rows if v and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    links = {i: set() for i, _ in rows}
    for a, x in ok:
        for b, y in ok:
            if a != b and len(x) == len(y) and x @ y / np.linalg.norm(x) / np.linalg.norm(y) >= 0.9:
                links[a].add(b)
    out = {}
    for i in links:
        seen, todo = {i}, [i]
        while todo:
            for j in links[todo.pop()] - seen:
                seen.add(j)
                todo.append(j)
        out[i] = (len(links[i]), min(seen), i == min(seen))
    return out


def test_same_as_brute_force(spark):
    rng = np.random.default_rng(2)
    base = rng.normal(size=(40, 8))
    rows = [(int(i * 7 % 401), [float(x) for x in base[rng.integers(40)] + rng.normal(size=8) * rng.choice([0, 0.1, 0.4])]) for i in range(400)]
    rows += [(1000, None), (1001, []), (1002, [0.0] * 8), (1003, [None] + [1.0] * 7), (1004, [float("nan")] * 8), (1005, [1e200] * 8)]
    rows += [(1006, [1.0, 2.0]), (1007, [2.0, 4.0]), (1008, [1.0, 2.0]), (1009, [float("inf")] + [0.0] * 7), (1010, [1e-200] * 8)]
    df = spark.createDataFrame([(i, v, "x") for i, v in rows], "vec_id long, embedding array<double>, n string")
    want = brute(rows)
    for tile in (4096, 64):
        got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in ed.near_vectors(df, tile=tile).collect()}
        assert got == want
    assert ed.near_vectors(df.limit(0)).collect() == []


def test_bounds_hold():
    rng = np.random.default_rng(3)
    u = rng.normal(size=(200, 33))
    u /= np.linalg.norm(u, axis=1, keepdims=True)
    q, s, err = ed.quantise(u)
    assert (np.linalg.norm(u - q * s[:, None], axis=1) <= err).all() and np.abs(q).max() <= 127
    exact = u @ u.T
    bound = (1 + err)[:, None] * err + err[:, None]
    assert (np.abs(exact - ed._products(q, q) * s[:, None] * s) <= bound).all()
