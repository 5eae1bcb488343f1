import hashlib
import random

import numpy as np
import pytest

from orderlens.llm import suffix_dedup as sd


def brute(rows, width=50):
    first = {}
    for i, t in rows:
        raw = (t or "").encode()
        for k in range(len(raw) - width + 1):
            s = raw[k : k + width]
            first[s] = min(first.get(s, i), i)
    out = {}
    for i, t in rows:
        raw = (t or "").encode()
        gone = bytearray(len(raw))
        for k in range(len(raw) - width + 1):
            if first[raw[k : k + width]] < i:
                gone[k : k + width] = b"\1" * width
        kept = bytes(b for b, g in zip(raw, gone) if not g)
        runs = sum(1 for k, g in enumerate(gone) if g and not (k and gone[k - 1]))
        out[i] = (len(raw), sum(gone), runs, hashlib.sha256(kept).hexdigest())
    return out


def corpus(seed):
    rng = random.Random(seed)
    words = ["Thonä", "and", "of the", "zé", "La", "x" * 7, "\0\0", "."]
    words += ["".join(rng.choice("abcdé") for _ in range(6)) for _ in range(60)]
    text = lambda n: " ".join(rng.choice(words) for _ in range(n))
    base = [text(rng.randrange(80)) for _ in range(30)]
    rows = [(500, None), (501, ""), (502, "é" * 24), (503, "é" * 25), (504, "é" * 25), (505, "short")]
    for i in range(150):
        kind = rng.random()
        if kind < 0.2:
            t = text(rng.randrange(60))
        elif kind < 0.4:
            t = rng.choice(base)
        elif kind < 0.7:
            b = rng.choice(base)
            at = rng.randrange(len(b) + 1)
            t = text(rng.randrange(20)) + b[at : at + rng.randrange(200)] + text(5) + rng.choice(base)[:90]
        elif kind < 0.8:
            t = "La " * rng.randrange(80)
        else:
            b = list(rng.choice(base))
            for _ in range(rng.randrange(4)):
                if b:
                    b[rng.randrange(len(b))] = "é"
            t = "".join(b)
        rows.append((i * 3 % 307, t))
    return rows


@pytest.mark.parametrize("most", [20_000, 3])
def test_same_as_brute_force(docs, monkeypatch, most):
    monkeypatch.setattr(sd, "MOST_CONTEXTS", most)
    rows = corpus(most)
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in sd.passages(docs(rows)).collect()}
    assert got == brute(rows)


def test_multikey_order():
    rng = np.random.default_rng(1)
    rows = rng.integers(0, 2, (300, 21), dtype=np.uint8)
    order, shared = sd.multikey_order(rows)
    listed = [bytes(r) for r in rows[order]]
    assert listed == sorted(listed)
    for k in range(1, len(listed)):
        want = next((i for i, (a, b) in enumerate(zip(listed[k - 1], listed[k])) if a != b), 21)
        assert shared[k] == want


def test_cut_texts_stay_valid(docs):
    same = "é" * 60
    rows = [(1, same), (2, "b" + same), (3, None), (4, "Ã" + same[1:]), (None, same), (2, "b" + same)]
    cut = sd.without_passages(docs(rows))
    got = {(r.doc_id, r.text) for r in cut.collect()}
    assert {t for i, t in got if i == 2} == {"b"} and (3, None) in got and (None, same) in got
    assert cut.columns == docs(rows).columns and cut.count() == 6
    assert sd.passages(docs([])).collect() == []


def test_wide_windows_hash_their_whole_context(docs):
    rng = random.Random(5)
    text = lambda n: "".join(rng.choice("abcdefgh ") for _ in range(n))
    shared = text(400)
    rows = [(1, shared), (2, text(90) + shared[30:260] + text(70)), (3, shared[:330] + "#" + shared[331:]), (4, shared[:119])]
    got = {r["doc_id"]: tuple(r)[1:5] for r in sd.passages(docs(rows), width=120).collect()}
    assert got == brute(rows, 120)
