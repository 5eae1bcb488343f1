import random
import zlib

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from orderlens.llm import packing
from tests.llm.conftest import LONG

PATH = public_tokenizers.path("byte_bpe_50k.json")


def test_plan_fills_without_overlap():
    random.seed(4)
    histogram = {k: random.randrange(1, 40) for k in random.sample(range(1, 65), 40)}
    plan = packing.plan(histogram, 64)
    used = {}
    for p in plan.itertuples():
        for k in range(p.n):
            used.setdefault(p.sequence + k, []).append((p.offset, p.length))
    assert plan.groupby("length").n.sum().to_dict() == histogram
    for slots in used.values():
        at = 0
        for offset, length in sorted(slots):
            assert offset == at
            at += length
        assert at <= 64
    bins = []  # best-fit decreasing, piece by piece
    for size in sorted((k for k, n in histogram.items() for _ in range(n)), reverse=True):
        fits = [i for i, r in enumerate(bins) if r >= size]
        if fits:
            bins[min(fits, key=bins.__getitem__)] -= size
        else:
            bins.append(64 - size)
    assert len(used) == len(bins)


def test_chunks_encode_like_the_text():
    library = Tokenizer.from_file(PATH)
    random.seed(5)
    letters = list(" \t\n \x1c\x85abcSs'Eé\u0301ΣİI1²日.-_<| \u00a0\u3000") + ["<|endoftext|>"]
    texts = ["".join(random.choice(letters) for _ in range(random.randrange(25))) for _ in range(1500)]
    for t, raw in zip(texts, packing.encoder(PATH)(texts), strict=True):
        assert np.frombuffer(raw, "<u4").tolist() == library.encode(t, add_special_tokens=False).ids


def test_documents_are_whole_and_gapless(docs):
    library = Tokenizer.from_file(PATH)
    texts = [None, "", "a b c", LONG, "x y " * 700, "dup", "dup", "q " * 1023, "Zoë 12"]
    rows = [(i, t) for i, t in enumerate(texts)] + [(5, "dup")]
    got = packing.pack_documents(docs(rows), PATH, with_ids=True).collect()
    space = {}
    for r in got:
        space.setdefault(r.sequence_id, []).append((r.offset, r.length))
        assert zlib.crc32(np.array(r.ids, "<u4").tobytes()) == r.ids_crc32 and len(r.ids) == r.length
    for slots in space.values():
        at = 0
        for offset, length in sorted(slots):
            assert offset == at
            at += length
        assert at <= 1024
    for i, t in enumerate(texts):
        ids = library.encode(t or "", add_special_tokens=False).ids + [2]
        mine = sorted((r.piece, r.start, r.ids) for r in got if r.doc_id == i)
        pieces = {p for p, _, _ in mine}
        assert pieces == set(range(-(-len(ids) // 1024)))
        assert [x for p in sorted(pieces) for x in next(m[2] for m in mine if m[0] == p)] == ids
        assert all(s == sum(len(next(m[2] for m in mine if m[0] == q)) for q in range(p)) for p, s, _ in mine)
        assert all(len(x) == 1024 for p, _, x in mine if p)
    assert packing.pack_documents(docs([]), PATH).collect() == []
