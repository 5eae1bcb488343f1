import hashlib
import random

from orderlens.llm.exact_dedup import block_identity, dedup_exact, exact_groups
from tests.llm.conftest import LONG


def found(df):
    return sorted(
        ((r._id, r._keep_id, r._group_size, r._kept, r._sha256) for r in exact_groups(df).collect()),
        key=str,
    )


def brute(rows):
    groups = {}
    for i, t in rows:
        groups.setdefault(t or "", []).append(i)
    return sorted(
        (
            (i, max(groups[t or ""]), len(groups[t or ""]), i == max(groups[t or ""]), hashlib.sha256((t or "").encode()).hexdigest())
            for i, t in rows
        ),
        key=str,
    )


def test_groups_equal_brute_force(docs):
    random.seed(1)
    texts = [None, "", "a", "a ", "é", LONG, LONG + "x", "b" * 1024, "b" * 1025, "b" * 2048, "b" * 5000, "c"]
    rows = [(i, random.choice(texts)) for i in range(80)]
    assert found(docs(rows)) == brute(rows)


def test_repeated_rows_leave_one(docs):
    rows = [(1, "a"), (1, "a"), (2, "a"), (2, "a"), (None, "z"), (None, "z")]
    kept = dedup_exact(docs(rows))
    assert sorted((r.doc_id or 0, r.text) for r in kept.collect()) == [(0, "z"), (2, "a")]
    assert kept.columns == ["doc_id", "text", "component_id", "length", "kept"]


def test_empty_table(docs):
    assert found(docs([])) == []


def test_names_do_not_collide_where_hashes_would(spark):
    rows = [(i, ("p" * 1024) * (i % 3) + chr(97 + i % 4)) for i in range(40)]
    names = {r._row: (r._size, r._name) for r in block_identity(spark.createDataFrame(rows, "_row long, _text string")).collect()}
    for a, s in rows:
        for b, t in rows:
            assert (names[a] == names[b]) == (s == t)
