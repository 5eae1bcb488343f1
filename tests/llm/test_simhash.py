import random

import numpy as np
import pytest
import xxhash

from orderlens.llm import simhash as sh
from tests.llm.conftest import LONG


def plain(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words, word = [], ""
    for c in low:
        if c == " " or "\t" <= c <= "\r":
            words, word = words + [word] * bool(word), ""
        else:
            word += c
    words += [word] * bool(word)
    if not words:
        return 0
    n = max(1, len(words) - 2)
    h = [xxhash.xxh64_intdigest(" ".join(words[i : i + 3]).encode(), 42) for i in range(n)]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > n)


def test_fingerprints(docs):
    texts = [None, "", " \t\n", "a", "A b", "Ä b c", "one two\u00a0x three\x0bfour", "a b c d a b c d", "x " * 500]
    got = {r.doc_id: r.fp % 2**64 for r in sh.fingerprints(docs(list(enumerate(texts)))).collect()}
    assert got == {i: plain(t) for i, t in enumerate(texts)}
    assert sh.fingerprint(LONG) == plain(LONG)


def near(rng, n):
    fps = [rng.getrandbits(64) for _ in range(n)]
    for _ in range(n):
        f = rng.choice(fps)
        for _ in range(rng.randint(1, 3)):
            f ^= 1 << rng.randrange(64)
        fps.append(f)
    return sorted(set(fps))


def groups_of(fps, radius=2):
    up = {f: f for f in fps}

    def root(f):
        while up[f] != f:
            f = up[f]
        return f

    for i, a in enumerate(fps):
        for b in fps[:i]:
            if (a ^ b).bit_count() <= radius:
                up[root(a)] = root(b)
    return {f: root(f) for f in fps}


def test_bit_sliced_pairs():
    rng = random.Random(3)
    fps = np.array(near(rng, 150), np.uint64)
    key = np.sort(np.array([rng.randrange(3) for _ in fps]))
    got = {(int(a), int(b)) for x, y in sh.near_pairs(key, fps) for a, b in zip(x, y)}
    want = {
        (i, j) for i in range(len(fps)) for j in range(i + 1, len(fps))
        if key[i] == key[j] and int(fps[i] ^ fps[j]).bit_count() <= 2
    }
    assert got == want


def test_links_connect_what_pairs_connect(spark):
    fps = near(random.Random(5), 200)
    fps += [f ^ 1 << b for f in fps[:1] for b in range(40)]
    fps = sorted(set(fps))
    rows = [(f - 2**64 if f >> 63 else f, i) for i, f in enumerate(fps)]
    want = groups_of(fps)
    for most in (4096, 2):  # the second refines every shared key
        got = list(range(len(fps)))

        def root(i, got=got):
            while got[i] != i:
                i = got[i]
            return i

        for r in sh.links(spark.createDataFrame(rows, "fp long, rep long"), 2, most).collect():
            assert want[fps[r.a]] == want[fps[r.b]]
            got[root(r.a)] = root(r.b)
        pairs = {(root(i), want[f]) for i, f in enumerate(fps)}
        assert len(pairs) == len({p[0] for p in pairs}) == len({p[1] for p in pairs})


def test_components_and_kept_rows(docs):
    base = " ".join(f"w{i}" for i in range(400))
    rows = [(7, base), (3, base), (5, None), (4, ""), (9, "other words here"), (9, "other words here"), (None, base)]
    got = sorted(((r.doc_id, r.component_id) for r in sh.near_duplicates(docs(rows)).collect()), key=str)
    assert got == sorted([(7, 3), (3, 3), (5, 4), (4, 4), (9, 9), (9, 9), (None, 3)], key=str)
    kept = sh.dedup_near(docs(rows))
    assert sorted(r.doc_id or 0 for r in kept.collect()) == [0, 3, 4, 9, 9]
    assert len(kept.columns) == 5
    assert sh.near_duplicates(docs([])).collect() == []


@pytest.mark.parametrize("radius", [-1, 3])
def test_a_radius_the_blocks_cannot_serve_is_refused(spark, radius):
    with pytest.raises(ValueError, match="radius"):
        sh.links(spark.createDataFrame([(0, 0), (1 | 1 << 16 | 1 << 32, 1)], "fp long, rep long"), radius)
