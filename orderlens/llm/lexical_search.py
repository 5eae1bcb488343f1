"""The best documents of each item of a query set by a whole-number BM25.

Documents are read once: each becomes a row of its postings, the terms that some item asks for, with their counts. The
same pass counts documents, terms and document frequencies, so the statistics cover every document.

Scoring goes over blocks of documents against all items. A block holds for each term the bitmap of the documents that have it. For
an item, the bits of its terms side by side make each document's presence mask; documents of one mask form a group, and what a term
adds at most in this block bounds the score of the whole group. Groups are scored in the order of that bound until it falls below
the item's worst score so far among its best; nothing that could still enter is left out. A task keeps its best across its blocks,
which tightens the bound, and sends only those on; the last step ranks them per item.

The items go in parts of ``ITEM_BYTES`` of text, so that what a task holds of them is bounded however many there are.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from orderlens.llm.common import bounded_batches, utf8
from orderlens.sources.staging import discard, staged

BEST = 10
ITEM_BYTES = 1 << 20
CHUNK = 1 << 20  # bytes of a text that are cut into terms at a time
HELD_DOCS, HELD_POSTINGS = 1 << 14, 1 << 20  # documents that a task sorts by length at a time
BLOCK_DOCS = 1 << 11

_NO_ID = (1 << 63) - 1  # stands for a null id, ranked last among equal scores
# Every byte that no term holds becomes a space, A-Z become a-z; bytes from 0x80 on belong to terms.
_TERM_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))


def term_chunks(raw: bytes) -> Iterator[list[bytes]]:
    """The terms of a text in order, in lists of about CHUNK bytes; no term is cut."""
    start = 0
    while start < len(raw):
        end = min(len(raw), start + CHUNK)
        piece = raw[start:end].translate(_TERM_BYTES)
        if end < len(raw):
            last = piece.rfind(b" ")
            if last < 0:  # one term longer than a chunk: up to its end
                while end < len(raw) and _TERM_BYTES[raw[end]] != 32:
                    end += 1
                piece = raw[start:end].translate(_TERM_BYTES)
            else:
                piece, end = piece[:last], start + last + 1
        yield piece.split()
        start = end


def _items(items: DataFrame, item_col: str, text_col: str) -> tuple[DataFrame, int]:
    """(_part, query, item, text): rows of the query set, numbered, in parts of about ITEM_BYTES, and how many parts."""
    rows = items.select(F.col(item_col).alias("item"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    size = rows.agg(F.sum(F.octet_length("text") + 16)).first()[0] or 0
    n = max(1, -(-size // ITEM_BYTES))
    dealt = rows.repartition(n) if n > 1 else rows.coalesce(1)
    return staged(dealt.withColumns({"_part": F.spark_partition_id(), "query": F.monotonically_increasing_id()}), "search_items"), n


def _vocabulary(rows: list) -> tuple[dict[bytes, int], list[tuple[np.ndarray, np.ndarray]]]:
    """Numbers of all terms, and for each item its different terms with how often it has them."""
    number: dict[bytes, int] = {}
    asked = []
    for r in rows:
        counts = Counter(t for c in term_chunks(r.text.encode("utf-8", "surrogatepass")) for t in c)
        terms = [number.setdefault(t, len(number)) for t in counts]
        asked.append((np.array(terms, np.int64), np.array(list(counts.values()), np.int64)))
    return number, asked


_POSTINGS = "kind int, doc long, n long, terms binary, counts binary"


def _postings(number: dict[bytes, int]):
    """Kind 0, a document: its length and its postings. Kind 1, once a task: documents, terms, and document frequencies."""
    schema = [("kind", pa.int32()), ("doc", pa.int64()), ("n", pa.int64()), ("terms", pa.binary()), ("counts", pa.binary())]

    def batch(rows: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*rows, strict=True))
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(columns, schema, strict=True)], [c for c, _ in schema])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frequency, documents, length = np.zeros(len(number), np.int64), 0, 0
        known = number.keys()
        for b in batches:
            raw, at = utf8(b.column(1))
            whole, rows = memoryview(raw), []
            for i, doc in enumerate(b.column(0).to_pylist()):
                counts, n = Counter(), 0
                for terms in term_chunks(bytes(whole[at[i] : at[i + 1]])):
                    n += len(terms)
                    counts.update(terms)
                documents, length = documents + (n > 0), length + n
                met = sorted((number[t], counts[t]) for t in counts.keys() & known)
                if met:
                    pairs = np.array(met, np.int64)
                    frequency[pairs[:, 0]] += 1
                    rows.append((0, doc, n, pairs[:, 0].astype(np.int32).tobytes(), pairs[:, 1].tobytes()))
            if rows:
                yield batch(rows)
        some = np.flatnonzero(frequency)
        yield batch([(1, documents, length, some.astype(np.int32).tobytes(), frequency[some].tobytes())])

    return run


def presence_masks(docs_of: list[np.ndarray], n_docs: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Different presence masks as rows of 0 and 1 (a column for each list of documents), the documents that have any
    bit, and the number of each one's mask."""
    planes = np.zeros((n_docs, -(-len(docs_of) // 64)), np.uint64)
    for bit, docs in enumerate(docs_of):
        planes[docs, bit >> 6] |= np.uint64(1 << (bit & 63))
    some = np.flatnonzero(planes.any(axis=1))
    kinds, group = np.unique(planes[some], axis=0, return_inverse=True) if planes.shape[1] > 1 else np.unique(planes[some, 0], return_inverse=True)
    kinds = kinds.reshape(len(kinds), -1)
    bits = np.arange(len(docs_of))
    shown = (kinds[:, bits >> 6] >> (bits & 63).astype(np.uint64)) & np.uint64(1)
    return shown.astype(np.int64), some, group.reshape(-1)


class _Best:
    """Of one item: the best (score, doc) of a task so far."""

    def __init__(self, most: int):
        self.most, self.score, self.doc = most, np.zeros(0, np.int64), np.zeros(0, np.int64)

    @property
    def least(self) -> int:
        """A lower score cannot enter; an equal one can, by a smaller id."""
        return int(self.score[-1]) if len(self.score) == self.most else 1

    def add(self, score: np.ndarray, doc: np.ndarray) -> None:
        able = score >= self.least
        score, doc = np.concatenate([self.score, score[able]]), np.concatenate([self.doc, doc[able]])
        order = np.lexsort((doc, -score))[: self.most]
        self.score, self.doc = score[order], doc[order]


def _score_block(doc, n, ptr, term, tf, asked, weight, N, L, best: list[_Best]) -> None:
    """Bring every item's best up to date with a block of documents (``ptr`` marks each one's postings)."""
    m = 25 + (75 * n * N) // L
    row = np.repeat(np.arange(len(doc)), np.diff(ptr))
    impact = (1_000_000_000 * tf) // (1000 * tf + 8 * m[row])
    by_term = np.argsort(term, kind="stable")
    rows_by_term = row[by_term]
    edge = np.searchsorted(term[by_term], np.arange(len(weight) + 1))
    most = np.zeros(len(weight), np.int64)
    np.maximum.at(most, term, impact)
    value = np.zeros(len(weight), np.int64)
    for (terms, times), mine in zip(asked, best, strict=True):
        use = (edge[terms + 1] > edge[terms]) & (weight[terms] > 0)
        terms, worth = terms[use], (weight[terms] * times)[use]
        reach = worth * most[terms]
        if not len(terms) or int(reach.sum()) < mine.least:
            continue
        shown, docs, group = presence_masks([rows_by_term[edge[t] : edge[t + 1]] for t in terms], len(doc))
        bound = (shown @ reach)[group]
        order = np.argsort(-bound, kind="stable")
        docs, bound = docs[order], bound[order]
        value[terms] = worth
        at, step = 0, 4 * mine.most
        while at < len(docs) and bound[at] >= mine.least:
            reached = docs[at : at + step][bound[at : at + step] >= mine.least]
            lengths = ptr[reached + 1] - ptr[reached]
            begin = np.cumsum(lengths) - lengths
            pick = np.repeat(ptr[reached] - begin, lengths) + np.arange(int(lengths.sum()))
            mine.add(np.add.reduceat(value[term[pick]] * impact[pick], begin), doc[reached])
            at, step = at + step, step * 2
        value[terms] = 0


def _search(queries, asked, weight: np.ndarray, N: int, L: int, best: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept = [_Best(best) for _ in asked]
        held: list[tuple] = []
        postings = 0

        def flush() -> None:
            # Documents of like length together: their bounds are closer.
            held.sort(key=lambda x: x[1])
            for i in range(0, len(held), BLOCK_DOCS):
                doc, n, terms, counts = zip(*held[i : i + BLOCK_DOCS], strict=True)
                ptr = np.concatenate([[0], np.cumsum([len(t) for t in terms])])
                columns = np.array(doc, np.int64), np.array(n, np.int64), ptr, np.concatenate(terms).astype(np.int64), np.concatenate(counts)
                _score_block(*columns, asked, weight, N, L, kept)
            held.clear()

        for b in batches:
            for d, n, t, c in zip(*(b.column(i).to_pylist() for i in range(4)), strict=True):
                held.append((_NO_ID if d is None else d, n, np.frombuffer(t, np.int32), np.frombuffer(c, np.int64)))
                postings += len(held[-1][2])
                if len(held) >= HELD_DOCS or postings >= HELD_POSTINGS:
                    flush()
                    postings = 0
        flush()
        which = np.repeat(np.array(queries, np.int64), [len(k.score) for k in kept])
        if len(which):
            docs = np.concatenate([k.doc for k in kept])
            arrays = [pa.array(which), pa.array(docs, mask=docs == _NO_ID), pa.array(np.concatenate([k.score for k in kept]))]
            yield pa.RecordBatch.from_arrays(arrays, ["query", "doc", "score"])

    return run


def term_weights(frequency: np.ndarray, N: int) -> np.ndarray:
    return np.array([math.floor(1000 * math.log((2 * N + 2) / (2 * int(f) + 1))) for f in frequency], np.int64)


def _frequencies(read: DataFrame) -> DataFrame:
    """(term, df) over all tasks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for t, c in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                yield pa.RecordBatch.from_arrays([pa.array(np.frombuffer(t, np.int32)), pa.array(np.frombuffer(c, np.int64))], ["term", "df"])

    rows = read.where("kind = 1").select("terms", "counts").mapInArrow(run, "term int, df long")
    return rows.groupBy("term").agg(F.sum("df").alias("df"))


def search(
    docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
    item_text_col: str = "text", best: int = BEST,
) -> DataFrame:
    """(item_id, rank, doc_id, score, query): each item's ``best`` highest-scoring documents with a score above 0, ranked from 1.

    Equal scores by ascending id, a null id last. Terms are the runs of ASCII letters and digits and of all characters
    beyond ASCII, A-Z in lower case, of whole texts; a null text has none. Every row of ``items`` is a query of its own
    (``query`` tells rows that repeat an id apart) and every row of ``docs`` a document of its own. Items without terms
    and empty tables give no rows. Other columns are not looked at.
    """
    bounded_batches(docs.sparkSession)
    parts, n = _items(items, item_col, item_text_col)
    texts = docs.select(F.col(id_col).cast("long").alias("doc"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    hits = []
    for part in range(n):
        rows = parts.where(F.col("_part") == part).collect()  # about ITEM_BYTES
        number, asked = _vocabulary(rows)
        read = staged(texts.mapInArrow(_postings(number), _POSTINGS), "search_postings", "zstd")
        counted = read.where("kind = 1").agg(F.sum("doc"), F.sum("n")).first()
        N, L = int(counted[0] or 0), int(counted[1] or 0)
        frequency = np.zeros(len(number), np.int64)
        for r in _frequencies(read).collect():  # a row for each term of the part's items
            frequency[r.term] = r.df
        able = read.where("kind = 0").select("doc", "n", "terms", "counts")
        scored = _search([r.query for r in rows], asked, term_weights(frequency, N), N, max(L, 1), best)
        hits.append(staged(able.mapInArrow(scored, "query long, doc_id long, score long"), "search_hits"))
        discard(read)
    order = Window.partitionBy("query").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    ranked = reduce(DataFrame.unionByName, hits).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= best)
    return ranked.join(parts.select("query", "item"), "query").select(F.col("item").alias("item_id"), "rank", "doc_id", "score", "query")
