import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from orderlens.llm import lexical_search
from tests.llm.conftest import LONG

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def terms(text):
    return TERM.findall((text or "").translate(LOWER))


def brute(docs, items, best=10):
    """Rankings (item index, rank, doc_id, score) from the definition."""
    bags = [(i, Counter(terms(t))) for i, t in docs]
    sizes = [sum(b.values()) for _, b in bags]
    N, L = sum(n > 0 for n in sizes), sum(sizes)
    df = Counter(t for _, b in bags for t in b)
    out = []
    for q, (_, text) in enumerate(items):
        scored = []
        for (doc, bag), n in zip(bags, sizes, strict=True):
            score = 0
            for t in terms(text):
                if bag[t]:
                    w = math.floor(1000 * math.log((2 * N + 2) / (2 * df[t] + 1)))
                    m = 100 - 75 + 75 * n * N // L
                    score += w * (1000000000 * bag[t] // (1000 * bag[t] + 8 * m))
            if score:
                scored.append((-score, math.inf if doc is None else doc))
        out += [(q, k, None if d == math.inf else d, -s) for k, (s, d) in enumerate(sorted(scored)[:best], 1)]
    return out


def mine(docs, items, **more):
    rows = lexical_search.search(docs, items, **more).collect()
    queries = sorted({r["query"] for r in rows})
    return sorted((queries.index(r["query"]), r["rank"], r.doc_id, r.score) for r in rows), [r.item_id for r in rows]


def frames(spark, docs, items):
    d = spark.createDataFrame([(i, t, 1, 2) for i, t in docs], "doc_id long, text string, score long, rank int")
    return d, spark.createDataFrame([(i, t, 5) for i, t in items], "item_id int, text string, doc_id int")


def by_query(rows):
    out = {}
    for q, *rest in rows:
        out.setdefault(q, []).append(tuple(rest))
    return sorted(sorted(v, key=str) for v in out.values())


def test_random_documents_meet_brute_force(spark):
    rng = random.Random(3)
    words = [f"w{int(rng.paretovariate(0.7)) % 300}" for _ in range(4000)]
    docs = [(i, rng.choice([" ", "-", "\n"]).join(rng.choices(words, k=int(rng.paretovariate(0.8)) % 200))) for i in range(700)]
    docs += [(1000 + i, docs[i][1]) for i in range(50)] + [(2000, LONG + " w1 w2"), (None, "w5 w7 W9"), (7, "w5")]
    items = [(i, " ".join(rng.choices(words, k=rng.choice([1, 3, 20, 90])))) for i in range(25)]
    got, ids = mine(*frames(spark, docs, items))
    assert by_query(got) == by_query(brute(docs, items))
    assert set(ids) <= {i for i, _ in items}


def test_more_blocks_and_parts_give_the_same(spark, monkeypatch):
    rng = random.Random(4)
    words = [f"t{int(rng.paretovariate(0.8)) % 90}" for _ in range(900)]
    docs = [(i, " ".join(rng.choices(words, k=rng.randrange(60)))) for i in range(400)]
    items = [(i, " ".join(rng.choices(words, k=12))) for i in range(12)]
    for name, value in (("HELD_DOCS", 37), ("BLOCK_DOCS", 5), ("ITEM_BYTES", 200), ("CHUNK", 16)):
        monkeypatch.setattr(lexical_search, name, value)
    got, _ = mine(*frames(spark, docs, items), best=4)
    assert by_query(got) == by_query(brute(docs, items, 4))


def test_nulls_ties_repeats_and_empty_tables(spark):
    docs = [(3, "Äb c1"), (1, "Äb c1"), (2, None), (None, "Äb c1"), (5, ""), (5, "äb"), (1, "Äb c1"), (9, "x" * 3000 + "?!")]
    items = [(1, "äb Äb"), (1, "c1 C1 c1"), (None, "c1"), (2, None), (3, ""), (4, "none at all"), (5, "X" * 3000)]
    got, ids = mine(*frames(spark, docs, items))
    assert by_query(got) == by_query(brute(docs, items))
    assert set(ids) == {1, None, 5}
    assert mine(*frames(spark, [], items))[0] == [] == mine(*frames(spark, docs, []))[0]


def test_the_fixture(spark, sf):
    docs, items = (spark.read.parquet(f"{sf}/{n}.parquet") for n in ("documents", "benchmark"))
    got, _ = mine(docs, items)
    expected = brute([(r.doc_id, r.text) for r in docs.collect()], [(r.item_id, r.text) for r in items.collect()])
    assert by_query(got) == by_query(expected)


@pytest.mark.parametrize("chunk", [1, 3, 7, 1000])
def test_chunks_cut_no_term(monkeypatch, chunk):
    monkeypatch.setattr(lexical_search, "CHUNK", chunk)
    for text in ("", "  ", "a", "one TWO-three äöü 日本 x_y", "a" * 50 + " b"):
        cut = [t.decode() for c in lexical_search.term_chunks(text.encode()) for t in c]
        assert cut == terms(text)


@pytest.mark.parametrize("n_bits", [1, 5, 64, 65, 200])
def test_masks_are_the_documents_bits(n_bits):
    rng = np.random.default_rng(n_bits)
    table = rng.random((60, n_bits)) < 0.2
    shown, docs, group = lexical_search.presence_masks([np.flatnonzero(table[:, k]) for k in range(n_bits)], 60)
    assert (shown[group] == table[docs]).all() and set(docs) == set(np.flatnonzero(table.any(axis=1)))
    assert len({tuple(x) for x in shown.tolist()}) == len(shown)
