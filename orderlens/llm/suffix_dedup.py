"""Removal of passages that an earlier document holds as well, by sorted suffixes.

A byte goes if a string of ``width`` bytes that covers it also starts in a document with a smaller id. Sorting every
suffix would multiply the corpus by the width, so the work narrows in exact steps:

0. Copies. A whole text that a smaller id has too goes as a whole; only the first document of equal texts goes on.
1. Anchors. In each window of ``width`` bytes one position is chosen by its next 24 bytes alone (a minimizer), so two
   equal windows hold the same anchor. Each batch of documents sends its distinct anchor hashes once; hashes that
   two documents have survive. Equal strings have equal hashes: nothing is lost here.
2. Interior. The context of an anchor (all bytes that a window around it can reach) is named by two hashes of 64
   bits. An anchor whose whole context an earlier document has is covered; no bytes are moved for it.
3. Edges. Where an anchor's bytes occur with different contexts, one context of each kind is kept with its smallest
   document. The suffixes that begin at the anchors are dealt out by range: sampled splitters cut the order of their leading bytes,
   and suffixes with equal leading bytes fall in one range, so none has to be compared across a border. Each range is sorted by multikey
   quicksort, once by what follows and once by what precedes the anchor; lengths of common prefixes of neighbours
   then tell which windows are equal, and the smallest document of each.
4. The covered stretches of each document are merged and cut out of its bytes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlens.llm.common import bounded_batches, parts_for, settle, utf8
from orderlens.sources.staging import broadcast_if_small, discard

WIDTH = 50
GRAM = 24
BATCH_BYTES = 1 << 20
BUCKET_BYTES = 8 << 20  # of text, whose anchors' hashes one task brings together at a time
MOST_CONTEXTS = 20_000

_NO_ID = -(1 << 63)  # stands for a null id
_M1, _M2 = 0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F
_MASK = (1 << 64) - 1


def _powers(base: int, steps: int) -> list[np.uint64]:
    """base, base**2, base**4, … modulo 2**64."""
    out = []
    for _ in range(steps):
        out.append(np.uint64(base))
        base = base * base & _MASK
    return out


_POW1, _POW2 = _powers(_M1, 12), _powers(_M2, 12)


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(32))


def _doubling(raw: np.ndarray, upto: int, powers: list[np.uint64]) -> Iterator[tuple[int, np.ndarray]]:
    """For k = 0, 1, … with 2**k up to ``upto``: k and the hashes of all strings of 2**k bytes, by where they start.

    Only the last level is held: a level costs eight bytes for each byte of text.
    """
    h, step = raw.astype(np.uint64), 1
    h += np.uint64(1)
    yield 0, h
    for k in range(upto.bit_length() - 1):
        if len(h) > step:
            longer = h[: len(h) - step] * powers[k]
            longer += h[step:]
            h = longer
        else:
            h = h[:0]
        step *= 2
        yield k + 1, h


def _slide(values: np.ndarray, width: int, take) -> np.ndarray:
    """``take`` (minimum or maximum) over each run of ``width`` values."""
    step = 1
    while step * 2 <= width:
        values = take(values[:-step], values[step:])
        step *= 2
    return take(values[: -(width - step)], values[width - step :]) if width > step else values


def anchors(raw: np.ndarray, at: np.ndarray, width: int, gram: int = GRAM) -> tuple[np.ndarray, np.ndarray]:
    """Positions in ``raw`` of the anchors of all documents (offsets ``at``) and the hash of the bytes there.

    Equal smallest values in a window are all chosen.
    """
    span = width - gram + 1
    if len(raw) < width:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    grams, have = None, 0
    for k, level in _doubling(raw, gram, _POW1):  # a gram is put together from pieces of 2**k bytes
        if not gram >> k & 1:
            continue
        if grams is None:
            grams, have = level, 1 << k
        else:
            n = len(raw) - have - (1 << k) + 1
            grams = grams[:n] * _POW1[k]
            grams += level[have : have + n]
            have += 1 << k
    del level
    grams = _mix(grams)
    value = (grams >> np.uint64(33)).astype(np.uint32) + np.uint32(1)
    least = _slide(value, span, np.minimum)  # one for each window of width bytes
    # Windows that run from one document into the next do not count.
    size = np.diff(at)
    inside = np.zeros(len(raw) + 1, np.int32)
    long = size >= width
    np.add.at(inside, at[:-1][long], 1)
    np.add.at(inside, at[1:][long] - width + 1, -1)
    least[np.cumsum(inside)[: len(least)] == 0] = 0
    pad = np.zeros(span - 1, np.uint32)
    chosen = _slide(np.concatenate([pad, least, pad]), span, np.maximum) == value
    place = np.flatnonzero(chosen)
    return place, grams[place]


def _context_hash(raw: np.ndarray, place: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """64-bit hash of raw[place-left : place+right] and of left: binary pieces of the length, shortest first."""
    start, length = place - left, left + right
    h = left.astype(np.uint64) * np.uint64(_M2) + right.astype(np.uint64)
    at = start.copy()
    for k, level in _doubling(raw, int(length.max(initial=1)), _POW2):
        take = (length >> k) & 1 == 1
        h[take] = _mix(h[take] * np.uint64(_M1) + level[at[take]])
        at[take] += 1 << k
    return _mix(h)


def _batches_by_key(docs: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, DataFrame, int]:
    """Documents (_b, _id, _raw) dealt by a hash of their id into batches of about BATCH_BYTES, copies left out; the
    copies (doc, n_bytes), whole texts that a smaller id has too; and all bytes."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(
        F.coalesce(F.col(id_col).cast("long"), F.lit(_NO_ID)).alias("_id"), text.cast("binary").alias("_raw"),
        F.octet_length(text).alias("_n"), F.sha2(text, 256).alias("_sha"),
    )
    kinds = rows.groupBy("_n", "_sha").agg(F.min("_id").alias("_least"), F.count("*").alias("_rows"))
    kinds = settle(kinds, "texts")
    total = kinds.agg(F.sum("_n")).first()[0] or 0
    several = broadcast_if_small(kinds.where("_rows > 1").select("_n", "_sha", "_least"), "copies")
    marked = rows.join(several, ["_n", "_sha"], "left")
    copies = marked.where("_id > _least").select(F.col("_id").alias("doc"), F.col("_n").alias("n_bytes"))
    n = max(1, -(-int(total) // BATCH_BYTES))
    batch = F.pmod(F.xxhash64("_id", "_n"), F.lit(n)).cast("int")
    firsts = marked.where("_least IS NULL OR _id <= _least").select(batch.alias("_b"), "_id", "_raw")
    discard(kinds)
    return firsts, copies, int(total)


def _binary(arrays) -> pa.Array:
    return pa.array([a.tobytes() for a in arrays], pa.binary())


def _turned(h: np.ndarray) -> np.ndarray:
    """The hash with its halves changed over; doing it twice gives the hash. Anchors are small in their high bits, so ranges
    of hashes as they are would put most of them into the first bucket."""
    return (h << np.uint64(32)) | (h >> np.uint64(32))


def _send_anchors(width: int, buckets: int):
    """Distinct anchor hashes (turned) of a batch by bucket, and which of them two of its documents have."""

    def run(table: pa.Table) -> pa.Table:
        raw, at = utf8(table.column("_raw"))
        ids = table.column("_id").combine_chunks().fill_null(_NO_ID).to_numpy()
        place, h = anchors(raw, at, width)
        h = _turned(h)
        doc = ids[np.searchsorted(at, place, "right") - 1]
        order = np.lexsort((doc, h))
        h, doc = h[order], doc[order]
        new = np.concatenate([[True], h[1:] != h[:-1]]) if len(h) else np.zeros(0, bool)
        first = np.flatnonzero(new)
        last = np.append(first[1:], len(h))[: len(first)] - 1
        several = doc[first] != doc[last]
        h = h[first]
        cut = np.searchsorted(h, _bucket_edges(buckets))
        pieces = [(h[a:b], several[a:b]) for a, b in zip(cut[:-1], cut[1:], strict=True)]
        some = [i for i, p in enumerate(pieces) if len(p[0])]
        batch = table.column("_b")[0].as_py()
        return pa.table({
            "bucket": pa.array(some, pa.int32()),
            "batch": pa.array([batch] * len(some), pa.int32()),
            "h": _binary(pieces[i][0] for i in some),
            "several": _binary(np.packbits(pieces[i][1]) for i in some),
        })

    return run


def _bucket_edges(buckets: int) -> np.ndarray:
    edges = [i * (1 << 64) // buckets for i in range(buckets)]
    return np.array([*edges, _MASK], np.uint64)


def _shared(table: pa.Table) -> pa.Table:
    """Of a bucket: for each batch the hashes that two documents of the corpus have."""
    hs = [np.frombuffer(b, np.uint64) for b in table.column("h").to_pylist()]
    several = [
        np.unpackbits(np.frombuffer(b, np.uint8), count=len(h)).astype(bool)
        for b, h in zip(table.column("several").to_pylist(), hs, strict=True)
    ]
    all_h, which = np.concatenate(hs), np.repeat(np.arange(len(hs)), [len(h) for h in hs])
    order = np.argsort(all_h, kind="stable")
    h = all_h[order]
    new = np.concatenate([[True], h[1:] != h[:-1]])
    group = np.cumsum(new) - 1
    good = np.bincount(group) > 1
    np.logical_or.at(good, group, np.concatenate(several)[order])
    kept = order[good[group]]
    kept.sort()
    cut = np.searchsorted(which[kept], np.arange(len(hs) + 1))
    out = [all_h[kept[a:b]] for a, b in zip(cut[:-1], cut[1:], strict=True)]
    some = [i for i, o in enumerate(out) if len(o)]
    batch = table.column("batch").to_pylist()
    return pa.table({"_b": pa.array([batch[i] for i in some], pa.int32()), "h": _binary(out[i] for i in some)})


def _batch(docs: pa.Table, width: int, keep) -> tuple:
    """Of a batch: its bytes and, for the anchors whose hash ``keep`` accepts, h, x, document, place, left, right."""
    reach = width - GRAM
    raw, at = utf8(docs.column("_raw"))
    ids = docs.column("_id").combine_chunks().fill_null(_NO_ID).to_numpy()
    place, h = anchors(raw, at, width)
    kept = keep(h)
    place, h = place[kept], h[kept]
    row = np.searchsorted(at, place, "right") - 1
    left = np.minimum(place - at[row], reach)
    right = np.minimum(at[row + 1] - place, width)
    x = _context_hash(raw, place, left, right)
    return raw, at, h.view(np.int64), x.view(np.int64), ids[row] if len(row) else ids[:0], row, place, left, right


def _survivors(width: int):
    """Anchors of a batch whose hash is shared: (h, x, b, doc, spot).

    spot holds the place in the document and, a byte each, how many bytes before and from there count.
    """

    def run(docs: pa.Table, shared: pa.Table) -> pa.Table:
        known = [np.frombuffer(b, np.uint64) for b in shared.column("h").to_pylist()]
        known = _turned(np.concatenate(known)) if known else np.zeros(0, np.uint64)
        raw, at, h, x, doc, row, place, left, right = _batch(docs, width, lambda found: np.isin(found, known))
        batch = docs.column("_b")[0].as_py() if docs.num_rows else 0
        return pa.table({
            "h": h, "x": x, "b": pa.array(np.full(len(h), batch, np.int32)), "doc": doc,
            "spot": ((place - at[row]) << 16) | (left << 8) | right,
        })

    return run


def _contexts(width: int):
    """The bytes around the wanted (h, x) of a batch, each once."""
    reach = width - GRAM

    def run(docs: pa.Table, wanted: pa.Table) -> pa.Table:
        want_h, want_x, want_doc = (wanted.column(c).combine_chunks().to_numpy() for c in ("h", "x", "doc"))
        hashes = np.unique(want_h).view(np.uint64)
        raw, at, h, x, doc, row, place, left, right = _batch(docs, width, lambda found: np.isin(found, hashes))
        # One place for each wanted (h, x) of a document.
        order = np.lexsort((place, doc, x, h))
        if len(order):
            same = (h[order][1:] == h[order][:-1]) & (x[order][1:] == x[order][:-1]) & (doc[order][1:] == doc[order][:-1])
            order = order[np.concatenate([[True], ~same])]
        have = pa.table({"h": h[order], "x": x[order], "doc": doc[order], "i": order})
        want = pa.table({"h": want_h, "x": want_x, "doc": want_doc})
        pick = want.join(have, ["h", "x", "doc"], join_type="inner").column("i").combine_chunks().to_numpy()
        padded = np.concatenate([np.zeros(reach, np.uint8), raw, np.zeros(width, np.uint8)])
        step = np.arange(reach + width)
        window = padded[place[pick][:, None] + step]
        window[(step < reach - left[pick][:, None]) | (step >= reach + right[pick][:, None])] = 0
        return pa.table({
            "h": h[pick], "x": x[pick], "doc": doc[pick],
            "context": pa.array([w.tobytes() for w in window], pa.binary()),
            "left": left[pick].astype(np.int32), "right": right[pick].astype(np.int32),
        })

    return run


def multikey_order(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order of equally long byte rows and, for each in that order, how many bytes it shares with the one before.

    Multikey quicksort by words of eight bytes: sort by a word, then only runs of ties by the next one.
    """
    n, width = rows.shape
    pad = -width % 8
    words = np.ascontiguousarray(np.pad(rows, ((0, 0), (0, pad)))).view(">u8").astype(np.uint64).reshape(n, -1)
    order = np.argsort(words[:, 0], kind="stable") if n else np.zeros(0, np.int64)
    tied = np.zeros(n, bool)
    if n:
        tied[1:] = words[order[1:], 0] == words[order[:-1], 0]
    for k in range(1, words.shape[1]):
        if not tied.any():
            break
        # Runs of ties: number them, and sort those rows by (run, next word).
        run = np.cumsum(~tied)
        open_ = tied.copy()
        open_[:-1] |= tied[1:]
        at = np.flatnonzero(open_)
        inner = np.lexsort((words[order[at], k], run[at]))
        order[at] = order[at[inner]]
        still = np.zeros(n, bool)
        still[1:] = tied[1:] & (words[order[1:], k] == words[order[:-1], k])
        tied = still
    shared = np.zeros(n, np.int64)
    if n > 1:
        differ = rows[order[1:]] != rows[order[:-1]]
        shared[1:] = np.where(differ.any(axis=1), differ.argmax(axis=1), width)
    return order, shared


def equal_windows(
    group: np.ndarray, context: np.ndarray, left: np.ndarray, right: np.ndarray, doc: np.ndarray, width: int, reach: int
) -> tuple[np.ndarray, np.ndarray]:
    """Per row the union [low, high) around the anchor of its windows that a row of its group with a smaller doc has.

    Windows that a row has overlap in the anchor, so their union is one stretch; low = high = 0 where there are none.
    ``context`` holds ``reach`` bytes before and ``width`` bytes from the anchor on; left and right say how many count.
    """
    n = len(group)
    suffix_order, suffix_shared = multikey_order(context[:, reach:])
    prefix_order, prefix_shared = multikey_order(context[:, :reach][:, ::-1])
    low, high = np.zeros(n, np.int64), np.zeros(n, np.int64)
    suffix_class, prefix_class = np.zeros(n, np.int64), np.zeros(n, np.int64)
    for before in range(reach + 1):
        after = width - before
        valid = np.flatnonzero((left >= before) & (right >= after))
        if len(valid) < 2:
            continue
        # Rows with the same next ``after`` bytes stand together in the order of suffixes, and likewise before.
        suffix_class[suffix_order] = np.cumsum(suffix_shared < after)
        prefix_class[prefix_order] = np.cumsum(prefix_shared < before) if before else 0
        key = suffix_class[valid] * (n + 1) + prefix_class[valid]
        order = np.lexsort((doc[valid], key))
        k, d = key[order], doc[valid][order]
        new = np.concatenate([[True], k[1:] != k[:-1]])
        first = d[np.flatnonzero(new)][np.cumsum(new) - 1]
        hit = valid[order[d > first]]
        high[hit] = np.maximum(high[hit], after)
        low[hit] = np.minimum(low[hit], -before)
    return low, high


def _compare_ranges(width: int):
    reach = width - GRAM

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got = list(batches)
        if not got or not sum(b.num_rows for b in got):
            return
        table = pa.Table.from_batches(got)
        column = {c: table.column(c).combine_chunks() for c in table.column_names}
        raw, _ = utf8(column["context"])
        context = raw.reshape(-1, reach + width)
        left, right, doc = (column[c].to_numpy().astype(np.int64) for c in ("left", "right", "doc"))
        h = column["h"].to_numpy()
        # A hash's rows are consecutive pieces of work that fit the caches.
        order = np.argsort(h, kind="stable")
        edges = np.append(np.flatnonzero(np.concatenate([[True], h[order][1:] != h[order][:-1]])), len(h))
        begin = 0
        low, high = np.zeros(len(h), np.int64), np.zeros(len(h), np.int64)
        while begin < len(edges) - 1:
            end = max(begin + 1, int(np.searchsorted(edges, edges[begin] + 50_000, "right")) - 1)
            part = order[edges[begin] : edges[end]]
            low[part], high[part] = equal_windows(h[part], context[part], left[part], right[part], doc[part], width, reach)
            begin = end
        some = np.flatnonzero(high > low)
        yield pa.RecordBatch.from_arrays(
            [column["h"].take(pa.array(some)), column["x"].take(pa.array(some)), pa.array(low[some].astype(np.int32)), pa.array(high[some].astype(np.int32))],
            ["h", "x", "low", "high"],
        )

    return run


def _hot_windows(width: int):
    """Every valid window of contexts of very common anchors, as (h, x, before, window, doc)."""
    reach = width - GRAM

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, 2000):
                part = batch.slice(i, 2000).to_pydict()
                out: dict[str, list] = {"h": [], "x": [], "before": [], "window": [], "doc": []}
                for h, x, c, lo, hi, d in zip(*(part[k] for k in ("h", "x", "context", "left", "right", "doc")), strict=True):
                    for before in range(max(0, width - hi), min(reach, lo) + 1):
                        row = (h, x, before, c[reach - before : reach - before + width], d)
                        for k, v in zip(out, row, strict=True):
                            out[k].append(v)
                kinds = [pa.int64(), pa.int64(), pa.int32(), pa.binary(), pa.int64()]
                yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(out.values(), kinds, strict=True)], list(out))

    return run


def covered(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH) -> DataFrame:
    """(doc, spans): each document's stretches of bytes to remove, flat [from, to, from, to, …], merged and in order."""
    if not GRAM < width < 256:
        raise ValueError(f"width must lie between {GRAM} and 256")
    spark = docs.sparkSession
    bounded_batches(spark)
    dealt, copies, total = _batches_by_key(docs, id_col, text_col)
    reach = width - GRAM
    n = parts_for(spark, total)
    buckets = max(1, -(-total // BUCKET_BYTES))
    sent = dealt.groupBy("_b").applyInArrow(
        _send_anchors(width, buckets), "bucket int, batch int, h binary, several binary"
    )
    shared = settle(sent.groupBy("bucket").applyInArrow(_shared, "_b int, h binary"), "shared")
    schema = "h long, x long, b int, doc long, spot long"
    both = dealt.groupBy("_b").cogroup(shared.groupBy("_b"))
    seen = settle(both.applyInArrow(_survivors(width), schema), "anchors")
    discard(shared)
    # One row for each anchor and context: its smallest document and where its bytes are.
    least = F.min(F.struct("doc", "b")).alias("m")
    kinds = settle(seen.groupBy("h", "x").agg(least).select("h", "x", "m.doc", F.col("m.b").alias("_b")), "contexts")
    open_ = kinds.groupBy("h").agg(F.count("*").alias("kinds")).where("kinds > 1")
    open_ = settle(open_, "open")
    wanted = settle(kinds.join(open_.select("h"), "h", "left_semi").select("h", "x", "doc", "_b"), "wanted")
    both = dealt.groupBy("_b").cogroup(wanted.groupBy("_b"))
    schema = "h long, x long, doc long, context binary, left int, right int"
    found = settle(both.applyInArrow(_contexts(width), schema), "edges")
    discard(wanted)
    usual = found.join(open_.where(F.col("kinds") <= MOST_CONTEXTS).select("h"), "h", "left_semi")
    ranged = usual.repartitionByRange(n, F.substring("context", reach + 1, GRAM))
    stretch = ranged.mapInArrow(_compare_ranges(width), "h long, x long, low int, high int")
    hot = open_.where(F.col("kinds") > MOST_CONTEXTS).select("h")
    if not hot.isEmpty():
        # Anchors in very many different contexts: their windows are counted by aggregation, over many tasks.
        windows = settle(
            found.join(hot, "h", "left_semi").mapInArrow(_hot_windows(width), "h long, x long, before int, window binary, doc long"),
            "windows",
        )
        least = windows.groupBy("h", "before", "window").agg(F.min("doc").alias("least"))
        hits = windows.join(least, ["h", "before", "window"]).where("doc > least")
        stretch = stretch.unionByName(
            hits.groupBy("h", "x").agg(
                (-F.max("before")).cast("int").alias("low"), (F.lit(width) - F.min("before")).cast("int").alias("high")
            )
        )
    stretch = settle(stretch, "stretches")
    discard(found, open_)
    firsts = kinds.select("h", "x", F.col("doc").alias("least")).join(stretch, ["h", "x"], "left")
    met = seen.select("h", "x", "doc", "spot").join(firsts, ["h", "x"])
    place, left, right = F.shiftright("spot", 16), F.shiftright("spot", 8).bitwiseAND(255), F.col("spot").bitwiseAND(255)
    whole = (F.col("doc") > F.col("least")) & (left + right >= width)
    spans = met.select(
        "doc",
        (place + F.when(whole, -left).otherwise(F.col("low"))).alias("a"),
        (place + F.when(whole, right).otherwise(F.col("high"))).alias("b"),
    ).where("a IS NOT NULL AND b IS NOT NULL")
    gone = copies.where(F.col("n_bytes") >= width).selectExpr("doc", "0L AS a", "CAST(n_bytes AS long) AS b")
    merged = spans.unionByName(gone).groupBy("doc").applyInArrow(_merge, "doc long, spans binary")
    merged = settle(merged, "spans")
    discard(seen, kinds, stretch)
    return merged


def _merge(table: pa.Table) -> pa.Table:
    a, b = (table.column(c).combine_chunks().to_numpy() for c in ("a", "b"))
    order = np.argsort(a, kind="stable")
    a, end = a[order], np.maximum.accumulate(b[order])
    new = np.concatenate([[True], a[1:] > end[:-1]])
    first = np.flatnonzero(new)
    flat = np.column_stack([a[first], end[np.append(first[1:], len(a)) - 1]]).astype("<i8")
    return pa.table({"doc": table.column("doc")[:1], "spans": pa.array([flat.tobytes()], pa.binary())})


def _spans(blob: bytes | None) -> np.ndarray:
    return np.frombuffer(blob or b"", "<i8").reshape(-1, 2)


def _cut(raw: bytes, spans: np.ndarray) -> bytes:
    out, at = [], 0
    for a, b in spans.tolist():
        out.append(raw[at:a])
        at = b
    return b"".join([*out, raw[at:]])


def passages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_bytes, n_removed, n_spans, kept_sha256, spans (flat array<long>).

    Matches are judged on the input and never cross documents; a null text is empty; rows that repeat an id are
    one document to each other and take nothing from each other, and each loses what any of them would lose there; a
    null id is the smallest. Texts shorter than ``width`` bytes stay whole; an empty table gives no rows.
    """
    spans = covered(docs, id_col, text_col, width)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("raw"))
    key = F.coalesce("doc_id", F.lit(_NO_ID))
    joined = rows.join(spans, key == F.col("doc"), "left").select("doc_id", "raw", "spans")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for raw, blob in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                s = np.minimum(_spans(blob), len(raw))
                s = s[s[:, 0] < s[:, 1]]
                out.append((len(raw), int((s[:, 1] - s[:, 0]).sum()), len(s), hashlib.sha256(_cut(raw, s)).hexdigest(), s.ravel().tolist()))
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.list_(pa.int64())]
            columns = list(zip(*out, strict=True)) or [[]] * 5
            arrays = [pa.array(c, t) for c, t in zip(columns, kinds, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *arrays], ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "spans"])

    return joined.mapInArrow(run, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, spans array<long>")


def without_passages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH) -> DataFrame:
    """``docs`` with the repeated passages cut out of the text, all other columns as they were.

    A cut inside a character moves inwards to its border, so texts stay valid. Documents that lose all their text stay, empty.
    """
    spans = covered(docs, id_col, text_col, width).withColumnsRenamed({"doc": "_span_doc", "spans": "_spans"})
    key = F.coalesce(docs[id_col].cast("long"), F.lit(_NO_ID))
    joined = docs.join(spans, key == F.col("_span_doc"), "left")

    @F.pandas_udf("string")
    def cut(texts, blobs):
        out = []
        for text, blob in zip(texts, blobs, strict=True):
            if text is None or blob is None:
                out.append(text)
                continue
            raw = text.encode("utf-8", "surrogatepass")
            inside = []
            for a, b in np.minimum(_spans(blob), len(raw)).tolist():
                while a < b and a < len(raw) and raw[a] & 0xC0 == 0x80:
                    a += 1
                while b > a and b < len(raw) and raw[b] & 0xC0 == 0x80:
                    b -= 1
                if a < b:
                    inside.append((a, b))
            out.append(_cut(raw, np.array(inside, np.int64).reshape(-1, 2)).decode("utf-8", "surrogatepass"))
        return texts.__class__(out, dtype=object)

    changed = joined.withColumn(text_col, F.when(F.col("_spans").isNotNull(), cut(text_col, "_spans")).otherwise(F.col(text_col)))
    return changed.select(*docs.columns)
