"""Code points that are assigned in one library's Unicode version and not in another's."""

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from orderlens.llm import bpe

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.mark.parametrize("c", ["\U0003d000", "\U000323b0", "͸", "\U00010d50", "Ɤ", "\U0001ccf0"])
def test_code_points_of_other_unicode_versions(c):
    library = Tokenizer.from_file(PATH)
    texts = [f":{c}", f"{c}", f"a{c}1 é{c}! B{c}", f"<|endoftext|>{c}x"]
    for t, (n, ids, decoded) in zip(texts, bpe.load(PATH).texts(texts), strict=True):
        e = library.encode(t, add_special_tokens=False).ids
        assert (n, ids, decoded) == (len(e), " ".join(map(str, e)), library.decode(e, skip_special_tokens=False))
