import zlib

import corpus_pipeline
import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from __spark_entry__ import oracle_sql, queries
from tests.compare import assert_same, oracle
from tests.llm.test_simhash import groups_of, plain


def test_stages_and_order():
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "quality_classifier", "exact_dedup", "simhash_dedup", "suffix_dedup", "best_fit_packing",
    ]


def test_each_stage_keeps_columns_and_takes_effect(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    before = docs
    for _, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, before, sf)
        assert after.columns == docs.columns and after.dtypes == docs.dtypes
        kept = spark.createDataFrame(after.collect(), after.schema)
        assert 0 < kept.count() <= before.count()
        before = kept
    labels = spark.read.parquet(f"{sf}/labels.parquet").where("quality = 1")
    packed = corpus_pipeline.STAGES[-1][1](spark, before, sf)
    assert packed.select("doc_id").distinct().count() == before.count()
    assert labels.count() > 0


def test_empty_documents(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, sf).count() == 0


@pytest.mark.parametrize("name", ["op7_embedding_dedup", "op9_chat_format", "op10_exact_dedup"])
def test_oracles(spark, sf, name):
    assert_same(queries()[name](spark, sf), oracle(sf), oracle_sql()[name])


def without_repeats(texts, width=50):
    """doc_id -> text less the bytes that a string of ``width`` bytes of an earlier document covers; cuts move inwards to characters."""
    first = {}
    for i, t in texts.items():
        raw = (t or "").encode()
        for k in range(len(raw) - width + 1):
            s = raw[k : k + width]
            first[s] = min(first.get(s, i), i)
    out = {}
    for i, t in texts.items():
        raw = (t or "").encode()
        gone = np.zeros(len(raw) + 1, bool)
        for k in range(len(raw) - width + 1):
            if first[raw[k : k + width]] < i:
                gone[k : k + width] = True
        kept, at = [], 0
        edges = np.flatnonzero(np.diff(np.concatenate([[False], gone]).astype(int))).tolist()
        for a, b in zip(edges[::2], edges[1::2], strict=True):
            while a < b and raw[a] & 0xC0 == 0x80:
                a += 1
            while b > a and b < len(raw) and raw[b] & 0xC0 == 0x80:
                b -= 1
            kept.append(raw[at:a])
            at = max(at, b)
        out[i] = b"".join([*kept, raw[at:]]).decode()
    return out


def test_run_equals_plain_python(spark, sf, tmp_path):
    """Planted bad, equal, near-equal and overlapping documents; the classifier's own decisions are taken from its query."""
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    rows = [r.asDict() for r in docs.collect()]
    long = max((r for r in rows if r["text"] and len(r["text"]) > 400), key=lambda r: r["doc_id"])
    more = [long["text"], long["text"] + " Zusatz", "Ein neuer Anfang. " + long["text"][:300], None, "", "é" * 60 + long["text"][100:290]]
    rows += [{**long, "doc_id": 10_000 + i, "text": t} for i, t in enumerate(more)]
    home = str(tmp_path)
    spark.createDataFrame(rows, docs.schema).write.parquet(f"{home}/documents.parquet")
    spark.read.parquet(f"{sf}/labels.parquet").write.parquet(f"{home}/labels.parquet")
    good = {r.doc_id for r in queries()["op6_quality_classifier"](spark, home).collect() if r.predicted}
    best = {}
    for r in rows:
        if r["doc_id"] in good:
            best[r["text"] or ""] = max(best.get(r["text"] or "", -1), r["doc_id"])
    prints = {i: plain(t) for t, i in best.items()}
    component = groups_of(sorted(set(prints.values())))
    least = {}
    for i, f in prints.items():
        least[component[f]] = min(least.get(component[f], i), i)
    texts = {i: t for t, i in best.items() if i in least.values()}
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    expected = set()
    for i, t in without_repeats(texts).items():
        ids = library.encode(t, add_special_tokens=False).ids + [2]
        first = len(ids) % 1024 or 1024
        for k, start in enumerate([0, *range(first, len(ids), 1024)]):
            part = ids[start : start + (first if k == 0 else 1024)]
            expected.add((i, k, start, len(part), zlib.crc32(np.array(part, "<u4").tobytes())))
    got = corpus_pipeline.run(spark, home).collect()
    assert {(r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got} == expected and len(got) == len(expected)
    assert 0 < len(texts) < len(good) < len(rows)
    places = {}
    for r in got:
        places.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for slots in places.values():
        assert sum(n for _, n in slots) <= 1024 and all(a == sum(n for _, n in sorted(slots)[:k]) for k, (a, _) in enumerate(sorted(slots)))
