"""SimHash near-duplicates with a bit-sliced comparison.

Fingerprints are distinct first, so copies cost one row. Two fingerprints at distance 2 or less agree on two
of four 16-bit blocks at least; they meet in one of six tables keyed by two blocks. A key that very many
fingerprints share is refined: what is left of the bits is cut in four again, which bounds a key to 65,536 and
then to 256 fingerprints, so no group outgrows a task and no pair is lost.

Within a task the fingerprints of a partition lie as bit planes: bit k of 64 fingerprints is one word. A word of
distances takes two carry-save counters and an overflow word; a block is abandoned once its overflow covers it.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlens.llm.common import bounded_batches, merge_labels, settle
from orderlens.llm.components import components
from orderlens.sources.staging import broadcast_if_small

RADIUS = 2
SEED = 42
MOST_PER_KEY = 4096
_UPPER_TO_LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))


def fingerprint(text: str | None, width: int = 3, seed: int = SEED) -> int:
    """64-bit SimHash of the ``width``-word shingles of the whole text, as an unsigned integer."""
    words = (text or "").encode("utf-8", "surrogatepass").translate(_UPPER_TO_LOWER).split()
    if not words:
        return 0
    joined = b" ".join(words)
    n = max(1, len(words) - width + 1)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])[:n].tolist()
    stops = ends[len(words) - n :].tolist()
    digest = xxhash.xxh64_intdigest
    set_bits = np.zeros(64, np.int64)
    for i in range(0, n, 65536):
        part = zip(starts[i : i + 65536], stops[i : i + 65536], strict=True)
        h = np.array([digest(joined[s:e], seed) for s, e in part], np.uint64)
        set_bits += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(set_bits * 2 > n, bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, fp): fp holds the 64 bits as a signed long. A text without words gets 0, like a null one."""
    bounded_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = np.fromiter((fingerprint(t.as_py()) for t in batch.column(1)), np.uint64, batch.num_rows)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fps.view(np.int64))], ["doc_id", "fp"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, fp long")


def _masks(bits: tuple[int, ...]) -> list[tuple[int, tuple[int, ...]]]:
    """Cut ``bits`` in four blocks; for each two of them the mask they make and the bits that are left."""
    size = len(bits) // 4
    blocks = [bits[i * size : (i + 1) * size] for i in range(4)]
    found = []
    for two in combinations(range(4), 2):
        same = [b for i in two for b in blocks[i]]
        left = tuple(b for i in range(4) if i not in two for b in blocks[i])
        found.append((sum(1 << b for b in same), left))
    return found


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def _keyed(rows: DataFrame, masks: list[int]) -> DataFrame:
    keys = F.array(*[
        F.struct(F.lit(i).alias("table"), F.col("fp").bitwiseAND(F.lit(_signed(m))).alias("key"))
        for i, m in enumerate(masks)
    ])
    return rows.select("fp", "rep", F.explode(keys).alias("k")).select("k.table", "k.key", "fp", "rep")


def near_pairs(key: np.ndarray, fp: np.ndarray, radius: int = RADIUS) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs (i < j) of rows with the same key whose fingerprints differ in ``radius`` bits or fewer.

    ``key`` is sorted: equal keys stand together. Bit-sliced: see the module's text. Pairs come in parts.
    """
    m = len(fp)
    if m < 2:
        return
    new = np.concatenate([[True], key[1:] != key[:-1]])
    last = np.append(np.flatnonzero(new)[1:], m)[np.cumsum(new) - 1]
    words = -(-m // 64)
    bits = np.zeros((words * 64, 64), np.uint8)
    bits[:m] = np.unpackbits(fp.view(np.uint8).reshape(m, 8), axis=1, bitorder="little")
    packed = np.packbits(bits.T.reshape(64, words, 64), axis=2, bitorder="little")
    planes = np.ascontiguousarray(packed).view(np.uint64)[:, :, 0]
    ones, none = np.uint64(0xFFFFFFFFFFFFFFFF), np.uint64(0)
    for begin in range(0, m, 16384):
        asking = np.arange(begin, min(m, begin + 16384))
        asking = asking[last[asking] > asking + 1]
        ahead = 0
        while len(asking):
            word = asking // 64 + ahead
            low = np.maximum(asking + 1 - word * 64, 0)
            high = np.minimum(last[asking] - word * 64, 64)
            open_ = (low < high) & (low < 64)
            alive = np.where(open_, ones << np.minimum(low, 63).astype(np.uint64), none)
            alive &= np.where(high >= 64, ones, (np.uint64(1) << np.clip(high, 0, 63).astype(np.uint64)) - np.uint64(1))
            rows, at = asking, word
            c0, c1 = np.zeros(len(rows), np.uint64), np.zeros(len(rows), np.uint64)
            for k in range(64):
                mine = none - ((fp[rows] >> np.uint64(k)) & np.uint64(1))
                carry = planes[k, at] ^ mine
                c0, carry = c0 ^ carry, c0 & carry
                c1, carry = c1 ^ carry, c1 & carry
                over = carry | (c0 & c1) if radius == 2 else carry | _above(c0, c1, radius)
                alive = alive & ~over
                if k % 8 == 7:
                    keep = alive != 0
                    if not keep.all():
                        rows, at, c0, c1, alive = rows[keep], at[keep], c0[keep], c1[keep], alive[keep]
                    if not len(rows):
                        break
            if len(rows):
                hit = np.unpackbits(alive.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
                q, j = np.nonzero(hit)
                yield rows[q], at[q] * 64 + j
            ahead += 1
            asking = asking[last[asking] > (asking // 64 + ahead) * 64]


def _above(c0: np.ndarray, c1: np.ndarray, radius: int) -> np.ndarray:
    return {0: c0 | c1, 1: c1, 3: np.zeros_like(c0)}[radius]


def _compare(radius: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got = [[b.column(i).to_numpy(zero_copy_only=False) for i in range(4)] for b in batches]
        if not got:
            return
        tab, key, fp, rep = (np.concatenate(c) for c in zip(*got, strict=True))
        order = np.lexsort((fp, key, tab))
        tab, key, fp, rep = tab[order], key[order], fp[order].view(np.uint64), rep[order]
        run_id = np.cumsum(np.concatenate([[True], (tab[1:] != tab[:-1]) | (key[1:] != key[:-1])]))
        many = np.bincount(run_id)[run_id] > 1
        run_id, fp, rep = run_id[many], fp[many], rep[many]
        # One link per joined fingerprint says what all pairs of a group say.
        labels = np.arange(len(fp))
        for a, b in near_pairs(run_id, fp, radius):
            labels = merge_labels(labels, a, b)
        joined = np.flatnonzero(labels != np.arange(len(fp)))
        yield pa.RecordBatch.from_arrays([pa.array(rep[joined]), pa.array(rep[labels[joined]])], ["a", "b"])

    return run


def links(reps: DataFrame, radius: int = RADIUS, most_per_key: int = MOST_PER_KEY) -> DataFrame:
    """Links (a, b) between representatives (fp, rep) whose fingerprints differ in ``radius`` bits or fewer.

    The links of a group of fingerprints are a forest that connects what its pairs connect. Two of four equal blocks
    are certain only up to 2 bits; a larger radius is refused.
    """
    if not 0 <= radius <= RADIUS:
        raise ValueError(f"radius is 0 to {RADIUS}; two of four blocks miss pairs of {radius} bits")
    tables = [(m, left) for m, left in _masks(tuple(range(64)))]
    rows, found = reps, None
    while True:
        keyed = _keyed(rows, [m for m, _ in tables])
        wide = len(tables[0][1]) > 8
        if wide:
            counts = keyed.groupBy("table", "key").count().where(F.col("count") > most_per_key)
            hot = settle(counts.select("table", "key"), "hot")
            wide = not hot.isEmpty()
        cold = keyed.join(hot, ["table", "key"], "left_anti") if wide else keyed
        part = cold.repartition("table", "key").select("table", "key", "fp", "rep").mapInArrow(
            _compare(radius), "a long, b long"
        )
        found = part if found is None else found.unionByName(part)
        if not wide:
            return found
        rows = keyed.join(hot, ["table", "key"], "left_semi").select("fp", "rep").distinct()
        tables = [(m | m2, left2) for m, left in tables for m2, left2 in _masks(left)]


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", radius: int = RADIUS
) -> DataFrame:
    """(doc_id, fp, component_id) per row: component_id is the smallest doc_id that links of ``radius`` bits reach.

    Texts without words (null, empty, white space) have fingerprint 0 and link like any other. Repeated ids keep a row
    each; a row without an id belongs to its fingerprint's component and is never its smallest id; a component
    of such rows alone has a null id. Extra columns do not matter; an empty table gives no rows.
    """
    prints = settle(fingerprints(docs, id_col, text_col), "prints")
    reps = settle(prints.groupBy("fp").agg(F.min("doc_id").alias("rep")), "reps")
    groups = components(links(reps.where("rep IS NOT NULL"), radius))
    labelled = reps.join(groups, reps.rep == groups.node, "left").select(
        "fp", F.coalesce("component", "rep").alias("component_id")
    )
    return prints.join(labelled, "fp").select("doc_id", "fp", "component_id")


def dedup_near(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with the document of the smallest id of each component, all columns as they were.

    Rows that share an id stay or go together; rows without an id stay.
    """
    gone = near_duplicates(docs, id_col, text_col).where("doc_id <> component_id").select("doc_id").distinct()
    gone = broadcast_if_small(gone, "gone").withColumnRenamed("doc_id", "_gone")
    return docs.join(gone, docs[id_col] == F.col("_gone"), "left_anti")
