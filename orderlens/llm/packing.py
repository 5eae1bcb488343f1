"""Best-fit packing planned over a length histogram.

The plan never sees documents: best-fit decreasing places counts of equal lengths in groups of equal sequences.
One step places as many pieces of one length as one group of sequences takes, so the plan's size depends on the
sequence length alone. Pieces then take their slots: the rank of a piece within its length, found by counting in
salted parts, is looked up in the plan.
"""

from __future__ import annotations

import heapq
import json
import zlib
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from orderlens.llm.bpe import byte_symbols
from orderlens.llm.common import bounded_batches, settle, slices

SEQUENCE = 1024
END_ID = 2
MOST_CHUNKS = 120_000
# Fixed value: the pre-token pattern of byte-level vocabularies of this kind.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
SALTS = 256


class _Encoder:
    """Ids of whole texts. What stands between single spaces is encoded once and kept in a bounded store.

    A single space between two other characters always begins a pre-token, so chunks that begin there encode alike
    alone and in their text. Chunks of Latin letters without an added token go to tiktoken with the same vocabulary,
    which gives the same ids in a tenth of the time; all others go to tokenizers.
    """

    def __init__(self, path: str):
        import tiktoken
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.added = [t["content"][:2] for t in spec["added_tokens"]]
        byte = {s: b for b, s in enumerate(byte_symbols())}
        special = {t["content"] for t in spec["added_tokens"]}
        ranks = {bytes(byte[c] for c in t): i for t, i in spec["model"]["vocab"].items() if t not in special}
        merges = (m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"])
        made = [spec["model"]["vocab"][a + b] for a, b in merges]
        # Ranks stand for merge order only where the file numbers its tokens so.
        in_order = made == sorted(made) and len(made) + 256 == len(ranks)
        self.latin = (
            tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={}) if in_order else None
        )
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    @staticmethod
    def chunks(text: str) -> list[str]:
        first, *rest = text.split(" ")
        out = [first] if first else []
        for part in rest:
            # Space runs and other white space beside the space stay with what stands before them.
            if out and part and not part[0].isspace() and not out[-1][-1].isspace():
                out.append(" " + part)
            elif out:
                out[-1] += " " + part
            else:
                out.append(" " + part)
        return out

    def __call__(self, texts: list[str]) -> list[bytes]:
        cut = [self.chunks(t) for t in texts]
        if len(self.known) > MOST_CHUNKS:
            self.known, self.older = {}, self.known
        known, older, fresh = self.known, self.older, []
        for c in {c for chunks in cut for c in chunks}:
            if c not in known:
                if c in older:
                    known[c] = older[c]
                else:
                    fresh.append(c)
        if self.latin:
            plain = [c for c in fresh if max(c) < "\u0250" and not any(a in c for a in self.added)]
            encode = self.latin.encode_ordinary
            for c in plain:
                known[c] = array("I", encode(c)).tobytes()
            fresh = [c for c in fresh if c not in known]
        for i in range(0, len(fresh), 20_000):
            part = fresh[i : i + 20_000]
            for c, e in zip(part, self.tokenizer.encode_batch_fast(part, add_special_tokens=False), strict=True):
                known[c] = np.array(e.ids, "<u4").tobytes()
        return [b"".join([known[c] for c in chunks]) for chunks in cut]


@lru_cache(2)
def encoder(path: str) -> _Encoder:
    return _Encoder(path)


def pieces(
    docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", length: int = SEQUENCE,
    end_id: int = END_ID, with_ids: bool = False,
) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32[, ids]): a document's ids, ``end_id`` last, in pieces of ``length``.

    Only a longer document has several pieces; its first one takes what is left over.
    """
    bounded_batches(docs.sparkSession)
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long" + ", ids array<long>" * with_ids

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        encode = encoder(path)
        tail = np.array([end_id], "<u4").tobytes()
        for whole in batches:
            for batch in slices(whole, "text", 4 << 20):
                ids = encode([t or "" for t in batch.column(1).to_pylist()])
                out: list[tuple] = []
                for doc, raw in zip(batch.column(0).to_pylist(), ids, strict=True):
                    raw += tail
                    n = len(raw) // 4
                    first = n % length or length
                    for k, start in enumerate([0, *range(first, n, length)]):
                        stop = first if k == 0 else start + length
                        part = raw[4 * start : 4 * stop]
                        more = (np.frombuffer(part, "<u4").tolist(),) if with_ids else ()
                        out.append((doc, k, start, stop - start, zlib.crc32(part), *more))
                kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64())]
                columns = zip(*out, strict=True)
                names = ["doc_id", "piece", "start", "length", "ids_crc32", "ids"]
                arrays = [pa.array(c, t) for c, t in zip(columns, kinds, strict=False)]
                yield pa.RecordBatch.from_arrays(arrays, names[: len(arrays)])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, schema)


def plan(histogram: dict[int, int], capacity: int = SEQUENCE) -> pd.DataFrame:
    """Best-fit decreasing over counts: rows (length, rank, n, sequence, offset).

    Pieces of ``length`` with ranks rank … rank+n-1 go to sequences sequence … sequence+n-1, each at ``offset``.
    Groups of sequences with the same room are ranges of numbers; a step splits one range at most.
    """
    rooms: dict[int, list[tuple[int, int]]] = {}  # room -> heap of (first sequence, sequences)
    rows: list[tuple[int, int, int, int, int]] = []
    sequences = 0
    for size in sorted(histogram, reverse=True):
        rank, left = 0, histogram[size]
        while left:
            room = min((r for r in rooms if r >= size), default=None)
            if room is None:
                # New sequences, each filled with as many of this length as it takes.
                per = capacity // size
                full, rest = divmod(left, per)
                for k in range(per if full else 0):
                    rows.append((size, rank, full, sequences, k * size))
                    rank += full
                if full and capacity - per * size:
                    heapq.heappush(rooms.setdefault(capacity - per * size, []), (sequences, full))
                sequences += full
                for k in range(rest):
                    rows.append((size, rank, 1, sequences, k * size))
                    rank += 1
                if rest:
                    heapq.heappush(rooms.setdefault(capacity - rest * size, []), (sequences, 1))
                    sequences += 1
                break
            first, many = heapq.heappop(rooms[room])
            taken = min(many, left)
            if taken < many:
                heapq.heappush(rooms[room], (first + taken, many - taken))
            if not rooms[room]:
                del rooms[room]
            rows.append((size, rank, taken, first, capacity - room))
            if room > size:
                heapq.heappush(rooms.setdefault(room - size, []), (first, taken))
            rank, left = rank + taken, left - taken
    return pd.DataFrame(rows, columns=["length", "rank", "n", "sequence", "offset"], dtype="int64")


def pack(cut: DataFrame, length: int = SEQUENCE, salts: int = SALTS) -> DataFrame:
    """The rows of ``cut`` (see ``pieces``) with sequence_id and offset.

    A full piece, by far the commonest one of long texts, is a sequence of its own, numbered where it is read (below
    zero); all others are planned and take their slots by rank.
    """
    every = settle(cut, "pieces")
    full = every.where(F.col("length") == length)
    full = full.withColumns({"sequence_id": -1 - F.monotonically_increasing_id(), "offset": F.lit(0).cast("long")})
    cut = every.where(F.col("length") < length)
    salted = cut.withColumn("_salt", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(salts)))
    counts = settle(salted.groupBy("length", "_salt").count(), "lengths")
    # At most one row for each length up to the sequence length comes to the driver.
    histogram = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("count").alias("n")).collect()}
    slots = plan(histogram, length)
    before = Window.partitionBy("length").orderBy("_salt").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("length", "_salt", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("_before"))
    within = Window.partitionBy("length", "_salt").orderBy("doc_id", "piece", "start", "ids_crc32")
    ranked = (
        salted.withColumn("_within", F.row_number().over(within) - 1)
        .join(F.broadcast(offsets), ["length", "_salt"])  # at most length x salts rows
        .withColumn("_rank", F.col("_before") + F.col("_within"))
        .drop("_within", "_before", "_salt")
    )
    slots = slots.sort_values(["length", "rank"])
    key = slots["length"].to_numpy() * (1 << 48) + slots["rank"].to_numpy()
    rank, sequence, offset = (slots[c].to_numpy() for c in ("rank", "sequence", "offset"))

    @F.pandas_udf("struct<sequence_id: long, offset: long>")
    def slot(size: pd.Series, at: pd.Series) -> pd.DataFrame:
        i = np.searchsorted(key, size.to_numpy() * (1 << 48) + at.to_numpy(), "right") - 1
        return pd.DataFrame({"sequence_id": sequence[i] + at.to_numpy() - rank[i], "offset": offset[i]})

    placed = ranked.withColumn("_slot", slot("length", "_rank"))
    return placed.select("*", "_slot.sequence_id", "_slot.offset").drop("_slot", "_rank").unionByName(full)


def pack_documents(docs: DataFrame, path: str, with_ids: bool = False, length: int = SEQUENCE) -> DataFrame:
    """One row per piece of each document with its place; see ``pieces`` and ``pack``.

    A null or empty text is one piece that holds only the end id; repeated rows are packed each; rows without an id
    are packed like others; extra columns do not matter; an empty table gives no rows.
    """
    return pack(pieces(docs, path, length=length, with_ids=with_ids), length)
