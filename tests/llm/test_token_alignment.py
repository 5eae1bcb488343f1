import hashlib
import random
from collections import Counter
from functools import cache

import numpy as np
import public_tokenizers
import pytest

from orderlens.llm import token_alignment
from orderlens.llm.bpe import byte_symbols
from tests.llm.conftest import LONG

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


@cache
def libraries():
    import sentencepiece
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(A)
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=B)


def tokens(text):
    """(ids, bytes of each) of both tokenizers over the whole text."""
    a, b = libraries()
    byte = {s: i for i, s in enumerate(byte_symbols())}
    ids_a, ids_b = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
    of_b = [b.id_to_piece(i) for i in ids_b]
    return (
        (ids_a, [bytes(byte[c] for c in a.id_to_token(i)) for i in ids_a]),
        (ids_b, [bytes([int(p[3:5], 16)]) if len(p) == 6 and p[:3] == "<0x" else p.replace("▁", " ").encode() for p in of_b]),
    )


def brute(rows):
    aligned, counts = [], Counter()
    for doc, text in rows:
        links, parts = Counter(), []
        if text:
            (a, raw_a), (b, raw_b) = tokens(text)
            whole = (" " + text).encode()
            if b"".join(raw_a) == whole == b"".join(raw_b):
                ends = [[sum(map(len, raw[: k + 1])) for k in range(len(raw))] for raw in (raw_a, raw_b)]
                start = 0
                for end in sorted(set(ends[0]) & set(ends[1])):
                    x, y = ([i for i, e in zip(ids, at, strict=True) if start < e <= end] for ids, at in zip((a, b), ends, strict=True))
                    parts.append(",".join(map(str, x)) + "|" + ",".join(map(str, y)))
                    links.update((p, q) for p in x for q in y)
                    start = end
        aligned.append((doc, len(a) if parts else 0, len(b) if parts else 0, parts, links))
        counts.update(links.keys())
    top = Counter()
    for (p, _), n in counts.items():
        top[p] = max(top[p], n)
    return sorted(
        (
            (doc, n_a, n_b, len(parts), links.total(), sum(k for (p, q), k in links.items() if counts[p, q] == top[p]),
             sum(k * counts[x] for x, k in links.items()), hashlib.sha256(";".join(parts).encode()).hexdigest() if parts else "")
            for doc, n_a, n_b, parts, links in aligned
        ),
        key=str,
    )


def mine(docs):
    of_docs, pairs = token_alignment.align(docs, A, B)
    return sorted(map(tuple, of_docs.collect()), key=str), pairs


def test_random_texts_meet_brute_force(docs):
    rng = random.Random(8)
    letters = list("   \t\n\x85abcSs'Eéİıẞ12²日本語.-_<| 　́​") + ["<|endoftext|>", "</s>", "▁", " the", " 🙂", "ﬁ", "    "]
    texts = ["".join(rng.choices(letters, k=rng.randrange(30))) for _ in range(300)]
    rows = [(i, t) for i, t in enumerate(texts)]
    assert mine(docs(rows))[0] == brute(rows)


def test_copies_nulls_and_odd_texts(docs):
    rows = [(1, None), (2, ""), (3, "x ▁ y"), (4, "a b a"), (5, "a b a"), (5, "a b a"), (None, "a c"), (None, "a c"), (7, " "), (8, "z" * 400), (9, "\n\n a  b"), (10, "日本 " * 60)]
    got, pairs = mine(docs(rows))
    assert got == brute(rows)
    assert pairs.where("best").count() >= pairs.select("a").distinct().count()
    assert mine(docs([]))[0] == []
    assert mine(docs([(1, None)]))[0] == [(1, 0, 0, 0, 0, 0, 0, "")]


def test_windows_and_blocks_change_nothing(docs, monkeypatch):
    rng = random.Random(9)
    texts = [" ".join(rng.choices(["the", "of", "Apfel", "1,234", "naïve", "日本", "\n", "", "e" * 40], k=rng.randrange(200))) for _ in range(40)]
    rows = [(i, t) for i, t in enumerate(texts)]
    expected = {x[0]: x for x in brute(rows)}
    for name, value in (("WINDOW", 11), ("BLOCK_BYTES", 100), ("WIDE", 1)):
        monkeypatch.setattr(token_alignment, name, value)  # in this process; workers have the usual sizes
    for i, found in enumerate(token_alignment.Aligner(A, B).measure(texts)):
        n_a, n_b, n_groups, n_links, digest, _, links = found or (0, 0, 0, 0, b"", [], [])
        assert (n_a, n_b, n_groups, n_links, digest.hex()) == (*expected[i][1:5], expected[i][7])
        assert sum(links) == n_links
    assert {x[0]: x for x in mine(docs(rows))[0]} == expected


def test_a_very_long_text(docs):
    (row,) = mine(docs([(1, LONG * 5)]))[0]
    (unit,) = mine(docs([(1, "word " * 10)]))[0]
    assert row[3] == 150_000 + (unit[3] - 10) and row[4] >= row[3]


@pytest.mark.parametrize(
    "a, b, of_a, of_b", [([1, 2], [2], [False, True], [True]), ([2, 3], [1, 2, 3], [True, True], [False, True, True]), ([3], [3], [True], [True])]
)
def test_groups_end_where_both_end(a, b, of_a, of_b):
    got = token_alignment.group_ends(np.array(a), np.array(b), 3)
    assert [x.tolist() for x in got] == [of_a, of_b]
