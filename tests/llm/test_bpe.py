import hashlib
import random

import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from orderlens.llm import bpe
from tests.llm.conftest import LONG

PATH = public_tokenizers.path("word_bpe_49k.json")
ODD = [
    "", " ", "a  b", "\ta b\n c", "<|endoftext|> a", "a<|startoftext|>b", "ÉéΑΣ Σ", "don't I'LL 12", "a\x1cb\x85c\u200bd",
    "日本語 テスト", "e\u0301 \u0301x", "İstanbul ǅ ß", "😀🏽a", "½ Ⅷ ²", "<|ENDOFTEXT|>", "x" * 3000,
]


@pytest.fixture(scope="module")
def peer():
    return Tokenizer.from_file(PATH)


@given(st.lists(st.text(st.characters(codec="utf-8"), max_size=30), max_size=5))
@settings(max_examples=60, deadline=None)
def test_same_as_the_library(texts):
    library = Tokenizer.from_file(PATH)
    for t, (n, ids, decoded) in zip(texts, bpe.load(PATH).texts(texts), strict=True):
        e = library.encode(t, add_special_tokens=False).ids
        assert (n, ids, decoded) == (len(e), " ".join(map(str, e)), library.decode(e, skip_special_tokens=False))


def test_forgetting_changes_nothing(peer, monkeypatch):
    monkeypatch.setattr(bpe, "MOST_CHUNKS", 10)
    random.seed(2)
    texts = [" ".join(random.choice(["an", "ther", "thing", "Zoë", "x1"]) + str(random.randrange(9)) for _ in range(30)) for _ in range(50)]
    small = bpe.WordBpe(PATH)
    for t in texts:
        (_, ids, _), = small.texts([t])
        assert ids == " ".join(map(str, peer.encode(t, add_special_tokens=False).ids))


def test_rows(docs, peer):
    texts = [None, *ODD, LONG]
    got = {r.doc_id: r for r in bpe.encode_texts(docs(list(enumerate(texts))), PATH, with_ids=True).collect()}
    for i, t in enumerate(texts):
        ids = peer.encode(t or "", add_special_tokens=False).ids
        assert got[i].ids == ids and got[i].n_tokens == len(ids)
        assert got[i].ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert got[i].decoded_sha256 == hashlib.sha256(peer.decode(ids, skip_special_tokens=False).encode()).hexdigest()
    assert bpe.encode_texts(docs([]), PATH).collect() == []
    assert len(bpe.encode_texts(docs([(1, "a"), (1, "a")]), PATH).collect()) == 2
