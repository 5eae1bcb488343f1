import hashlib
import time

from orderlens.llm import chat_format as cf
from tests.llm.conftest import LONG

TEXTS = [
    None, "", "plain", "</s>", "<s>[INST] x</s>", "[/INST] ]", "&lt; &amp;lt; < & [", "<s", "</s", "a] b", "&", LONG, "日本 </s> 😀", "\n",
]


def test_round_trip(spark):
    rows = [(k // 3, k % 5, ["user", "assistant", "system", None, "INST", "a] </s>&", "ROLE=x"][k % 7], t, "c") for k, t in enumerate(TEXTS * 4)]
    rows += [(99, 1, "user", "s", "c"), (99, 1, "user", "s", "c")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, turns string")
    want = {}
    for c, n, r, t, _ in rows:
        want.setdefault(c, []).append((n is not None, n, r or "", t or ""))
    formatted = cf.format_conversations(df)
    back = {r.conv_id: r for r in cf.read_back(formatted).collect()}
    digests = {r.conv_id: r for r in cf.digest(formatted).collect()}
    assert set(back) == set(want)
    for c, turns in want.items():
        turns.sort(key=lambda t: (t[0], t[1] or 0, t[2], t[3]))
        assert [(t.role, t.text) for t in back[c].recovered] == [(r, t) for _, _, r, t in turns]
        loss = "".join(t for _, _, r, t in turns if r == "assistant")
        assert back[c].loss_text == loss
        assert digests[c].loss_chars == len(loss) and digests[c].n_turns == len(turns)
        said = "".join(f"{r}\n{t}\n" for _, _, r, t in turns)
        assert digests[c].turns_sha256 == hashlib.sha256(said.encode()).hexdigest()
        inner = back[c].formatted.replace("<s>[", "").count("<s>")
        assert inner == 0 and back[c].formatted.count("</s>") == len(turns)
    assert cf.digest(cf.format_conversations(df.limit(0))).collect() == []


def test_rows_without_an_id_are_conversations_of_their_own(spark):
    rows = [(None, None, "assistant", "n"), (None, 1, "user", "m</s>"), (None, 1, "user", "m</s>")]
    formatted = cf.format_conversations(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    back = cf.read_back(formatted).collect()
    assert sorted([(t.role, t.text) for t in r.recovered] for r in back) == [[("assistant", "n")], [("user", "m</s>")], [("user", "m</s>")]]


def test_ten_thousand_turns(spark):
    """Work grows with the turns, not with a power of them."""
    turns = spark.range(10_000).selectExpr("1L AS conv_id", "id AS turn", "IF(id % 2 = 0, 'user', 'assistant') AS role", "IF(id % 7 = 0, '</s>[INST]', concat('t', id)) AS text")
    started = time.perf_counter()
    (row,) = cf.digest(cf.format_conversations(turns)).collect()
    assert time.perf_counter() - started < 60
    said = [("</s>[INST]" if i % 7 == 0 else f"t{i}") for i in range(10_000)]
    assert row.n_turns == 10_000 and row.loss_sha256 == hashlib.sha256("".join(said[1::2]).encode()).hexdigest()
    assert row.turns_sha256 == hashlib.sha256("".join(f"{['user', 'assistant'][i % 2]}\n{t}\n" for i, t in enumerate(said)).encode()).hexdigest()
