"""Which tokens of one tokenizer stand where which tokens of another do, text by text and over the corpus.

1. Documents are brought together by their full text, and each different text is encoded and aligned once, however many
   documents have it. A single space between two other characters begins a token in both vocabularies, so long texts are
   encoded in windows that begin there. Windows are aligned together, as arrays: offsets of token ends, the ends that both have, groups, links.
2. Texts leave the tasks in slices: their own measures, and which pairs of ids they link how often, packed. A slice lists
   each of its pairs once, with the number of documents that hold it: texts weighted by how many documents have them.
3. Pairs are counted over all slices; each count, and whether it is the highest of its A id, goes back to the slices that
   asked, which add up their texts' links.
4. The measures of a text go to its documents by length and SHA-256 of the text.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlens.llm.bpe import byte_symbols
from orderlens.llm.common import bounded_batches
from orderlens.llm.packing import _Encoder
from orderlens.sources.staging import discard, staged

SLICE_BYTES = 8 << 20
BLOCK_BYTES = 1 << 20  # texts that are aligned together
WINDOW = 1 << 18  # characters that are encoded at a time
WIDE = 256  # links of a group that is counted by itself

_SPACE = "▁"


def group_ends(end_a: np.ndarray, end_b: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Which A and which B tokens end where a token of the other ends as well; ends are offsets up to ``size``."""
    of_a, of_b = np.zeros(size + 1, bool), np.zeros(size + 1, bool)
    of_a[end_a], of_b[end_b] = True, True
    return of_b[end_a], of_a[end_b]


def _places(first: np.ndarray, count: np.ndarray) -> np.ndarray:
    """first[i], first[i] + 1, … for count[i] places, one i after the other."""
    start = np.cumsum(count) - count
    return np.repeat(first - start, count) + np.arange(int(count.sum()))


def _summed(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Each key once, sorted, with the sum of its counts."""
    if len(keys) == 1:
        return keys[0], counts[0]
    if not keys:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    key, at = np.unique(np.concatenate(keys), return_inverse=True)
    total = np.zeros(len(key), np.int64)
    np.add.at(total, at, np.concatenate(counts))
    return key, total


class Aligner:
    def __init__(self, path_a: str, path_b: str):
        import sentencepiece

        self.a = _Encoder(path_a)
        self.a.tokenizer.encode_special_tokens = True  # their strings are plain text here
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        byte = {s: i for i, s in enumerate(byte_symbols())}
        tokens = self.a.tokenizer.get_vocab(with_added_tokens=True)
        bytes_a = [b""] * (max(tokens.values()) + 1)
        for t, i in tokens.items():
            bytes_a[i] = bytes(byte[c] for c in t) if all(c in byte for c in t) else t.encode()
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        bytes_b = [
            bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace(_SPACE, " ").encode() for i, p in enumerate(pieces)
        ]
        self.bytes = [np.array([*x, None], object)[:-1] for x in (bytes_a, bytes_b)]
        self.size = [np.array([len(x) for x in y], np.int64) for y in (bytes_a, bytes_b)]
        # Each id as text with what follows it: inside a group, at the end of its A side, at the end of the group.
        self.inner, self.middle, self.last = (
            np.array([f"{i}{mark}" for i in range(max(map(len, self.size)))], object) for mark in ",|;"
        )
        # A space begins a piece unless some piece goes on behind one, so texts can be cut there.
        self.cuts = not any(_SPACE in p.lstrip(_SPACE) for p in pieces)

    def windows(self, text: str) -> Iterator[str]:
        """The text, a space put before it, cut where both tokenizers begin a token."""
        text = " " + text
        start = 0
        while start < len(text):
            end = start + WINDOW if self.cuts else -1
            while 0 <= (end := text.find(" ", end) if end >= 0 else -1) < len(text) - 1:
                if not text[end - 1].isspace() and not text[end + 1].isspace():
                    break
                end += 1
            end = end if 0 <= end < len(text) - 1 else len(text)
            yield text[start:end]
            start = end

    def _encode_a(self, window: str) -> list[int]:
        """tiktoken with the same vocabulary where a window is of Latin letters, else only for its runs of such chunks."""
        if not self.a.latin:
            return self.a.tokenizer.encode(window, add_special_tokens=False).ids
        if max(window) < "ɐ":
            return self.a.latin.encode_ordinary(window)
        out: list[int] = []
        for plain, run in groupby(_Encoder.chunks(window), lambda c: max(c) < "ɐ"):
            part = "".join(run)
            out += self.a.latin.encode_ordinary(part) if plain else self.a.tokenizer.encode(part, add_special_tokens=False).ids
        return out

    def tokens(self, windows: list[str]) -> tuple[list[np.ndarray], list[np.ndarray], np.ndarray]:
        """Ids of both tokenizers for each window, and whether their bytes are the window's."""
        raw = [w.encode("utf-8", "surrogatepass") for w in windows]
        ids = [[np.array(x, np.int64) for x in (map(self._encode_a, windows) if not k else self.b.encode([w[1:] for w in windows], num_threads=1))] for k in (0, 1)]
        same = np.ones(len(windows), bool)
        for mine, spelled, size in zip(ids, self.bytes, self.size, strict=True):
            same &= [int(size[x].sum()) == len(r) for x, r in zip(mine, raw, strict=True)]
            if b"".join(spelled[np.concatenate(mine)].tolist()) != b"".join(raw) or not same.all():
                same &= [b"".join(spelled[x].tolist()) == r for x, r in zip(mine, raw, strict=True)]
        return ids[0], ids[1], same

    def _links(self, a, b, group_a, group_b, p, q, text) -> tuple[np.ndarray, np.ndarray]:
        """Sorted (text << 32 | pair) and how many links each has; p and q are the groups' sizes, text their texts."""
        n_b = len(self.size[1])
        first_a, first_b = np.cumsum(p) - p, np.cumsum(q) - q
        usual = np.flatnonzero(p * q <= WIDE)
        times = q[group_a] * (p * q <= WIDE)[group_a]  # each A token meets all B tokens of its group
        left = np.repeat(np.arange(len(a)), times)
        right = _places(first_b[group_a], times)
        key = np.sort((text[group_a[left]] << 32) | (a[left] * n_b + b[right]))
        new = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, np.int64)
        count = np.diff(np.append(new, len(key)))
        key = key[new]
        if len(usual) < len(p):
            more: Counter = Counter()
            for g in np.flatnonzero(p * q > WIDE).tolist():
                mine = np.unique(a[first_a[g] : first_a[g] + p[g]], return_counts=True)
                other = np.unique(b[first_b[g] : first_b[g] + q[g]], return_counts=True)
                for i, k in zip(*(x.tolist() for x in mine), strict=True):
                    for j, m in zip(*(x.tolist() for x in other), strict=True):
                        more[int(text[g]) << 32 | (i * n_b + j)] += k * m
            wide = np.fromiter(more.keys(), np.int64, len(more)), np.fromiter(more.values(), np.int64, len(more))
            return _summed([key, wide[0]], [count, wide[1]])
        return key, count

    def measure(self, texts: list[str]) -> list[tuple | None]:
        """For each text (n_a, n_b, n_groups, n_links), the digest of its groups, its pairs (a * |B| + b, sorted) and their
        links; None for a text that has no tokens. Windows go a few at a time; the parts of a long text are added up."""
        sums = np.zeros((len(texts), 4), np.int64)
        digests, keys, counts, good = [hashlib.sha256() for _ in texts], [], [], np.ones(len(texts), bool)
        begun = np.zeros(len(texts), bool)
        windows = ((i, w) for i, t in enumerate(texts) for w in self.windows(t))
        while True:
            held, size = [], 0
            for i, w in windows:
                held.append((i, w))
                size += len(w)
                if size >= BLOCK_BYTES:
                    break
            if not held:
                break
            a, b, same = self.tokens([w for _, w in held])
            good[[i for (i, _), s in zip(held, same, strict=True) if not s]] = False
            use = [k for k, (i, _) in enumerate(held) if good[i] and same[k]]
            if not use:
                continue
            of = np.array([held[k][0] for k in use], np.int64)
            n_a, n_b = (np.array([len(x[k]) for k in use]) for x in (a, b))
            a, b = (np.concatenate([x[k] for k in use]) for x in (a, b))
            end_a, end_b = np.cumsum(self.size[0][a]), np.cumsum(self.size[1][b])
            last_a, last_b = group_ends(end_a, end_b, int(end_a[-1]))
            group_a, group_b = np.cumsum(last_a) - last_a, np.cumsum(last_b) - last_b
            p, q = np.bincount(group_a), np.bincount(group_b)
            window = np.repeat(np.arange(len(use)), n_a)[last_a]  # of each group
            np.add.at(sums, of, np.column_stack([n_a, n_b, np.bincount(window, minlength=len(use)), np.zeros(len(use), np.int64)]))
            np.add.at(sums[:, 3], of[window], p * q)
            key, count = self._links(a, b, group_a, group_b, p, q, of[window])
            keys.append(key)
            counts.append(count)
            # A and B tokens in the order in which the groups spell them.
            spelled = np.empty(len(a) + len(b), object)
            first_a, first_b = np.cumsum(p) - p, np.cumsum(q) - q
            spelled[np.arange(len(a)) + first_b[group_a]] = np.where(last_a, self.middle[a], self.inner[a])
            spelled[np.arange(len(b)) + (first_a + p)[group_b]] = np.where(last_b, self.last[b], self.inner[b])
            at = 0
            for i, k in zip(of.tolist(), (n_a + n_b).tolist(), strict=True):
                part = "".join(spelled[at : at + k].tolist())[:-1]  # without the last semicolon
                digests[i].update((";" * bool(begun[i]) + part).encode())
                begun[i] = True
                at += k
        key, count = _summed(keys, counts)
        edge = np.searchsorted(key >> 32, np.arange(len(texts) + 1))
        pairs = key & ((1 << 32) - 1)
        return [
            (*sums[i].tolist(), digests[i].digest(), pairs[edge[i] : edge[i + 1]], count[edge[i] : edge[i + 1]]) if good[i] and begun[i] else None
            for i in range(len(texts))
        ]


@lru_cache(1)
def aligner(path_a: str, path_b: str) -> Aligner:
    return Aligner(path_a, path_b)


_SLICE = "slice long, sha binary, size binary, measures binary, digests binary, first binary, local binary, links binary, pairs array<long>, docs array<long>"
_MEASURE = "sha binary, size long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"


def _slices(path_a: str, path_b: str):
    """Texts (text, copies) to rows of _SLICE."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import os

        from pyspark import TaskContext

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        find = aligner(path_a, path_b)
        base = TaskContext.get().partitionId() << 32
        made, held = 0, 0
        sha, size, measures, digests, count, pairs, links, copies = ([] for _ in range(8))

        def flush() -> pa.RecordBatch:
            code = np.concatenate(pairs)
            kinds = np.unique(code)
            local = np.searchsorted(kinds, code).astype(np.int32)
            docs = np.zeros(len(kinds), np.int64)
            np.add.at(docs, local, np.repeat(copies, count))
            first = np.concatenate([[0], np.cumsum(count)])
            blobs = [b"".join(sha), np.array(size, np.int64), np.array(measures, np.int64), b"".join(digests), first, local, np.concatenate(links)]
            arrays = [pa.array([base + made], pa.int64())]
            arrays += [pa.array([b if isinstance(b, bytes) else b.tobytes()], pa.binary()) for b in blobs]
            arrays += [pa.ListArray.from_arrays([0, len(x)], x) for x in (kinds, docs)]
            for x in (sha, size, measures, digests, count, pairs, links, copies):
                x.clear()
            return pa.RecordBatch.from_arrays(arrays, [c.split()[0] for c in _SLICE.split(", ")])

        def blocks() -> Iterator[list[tuple[str, int]]]:
            block, n = [], 0
            for b in batches:
                for text, times in zip(b.column(0), b.column(1), strict=True):
                    block.append((text.as_py(), times.as_py()))
                    n += len(block[-1][0])
                    if n >= BLOCK_BYTES:
                        yield block
                        block, n = [], 0
            if block:
                yield block

        for block in blocks():
            for (text, times), got in zip(block, find.measure([t for t, _ in block]), strict=True):
                if got is None:
                    continue
                *numbers, digest, mine, times_linked = got
                raw = text.encode("utf-8", "surrogatepass")
                sha.append(hashlib.sha256(raw).digest())
                size.append(len(raw))
                pairs.append(mine)
                links.append(times_linked)
                measures.append(numbers)
                digests.append(digest)
                count.append(len(mine))
                copies.append(times)
                held += len(raw)
            if held >= SLICE_BYTES:
                yield flush()
                made, held = made + 1, 0
        if sha:
            yield flush()

    return run


def _measured(packed: pa.Table, answers: pa.Table) -> pa.Table:
    """Texts of a slice with the sums over their links; ``answers``: pair, count, best of all its pairs."""
    if not packed.num_rows:
        return pa.table({c.split()[0]: pa.array([], pa.string() if "string" in c else pa.binary() if "binary" in c else pa.int64()) for c in _MEASURE.split(", ")})
    row = packed.to_pylist()[0]
    number = {c: np.frombuffer(row[c], np.int64) for c in ("size", "measures", "first", "links")}
    local = np.frombuffer(row["local"], np.int32)
    order = np.argsort(answers.column("pair").combine_chunks().to_numpy(), kind="stable")
    count = answers.column("count").combine_chunks().to_numpy()[order][local]
    best = answers.column("best").combine_chunks().to_numpy(zero_copy_only=False)[order][local]
    starts = number["first"][:-1]  # every text has links
    n = len(starts)
    measures = number["measures"].reshape(n, 4)
    cut = lambda blob: pa.array([blob[32 * i : 32 * i + 32] for i in range(n)], pa.binary())
    return pa.table({
        "sha": cut(row["sha"]), "size": number["size"],
        "n_a": measures[:, 0], "n_b": measures[:, 1], "n_groups": measures[:, 2], "n_links": measures[:, 3],
        "n_best": np.add.reduceat(number["links"] * best, starts), "count_sum": np.add.reduceat(number["links"] * count, starts),
        "groups_sha256": pa.array([row["digests"][32 * i : 32 * i + 32].hex() for i in range(n)], pa.string()),
    })


def align(docs: DataFrame, path_a: str, path_b: str, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """Two tables: the documents' measures, and the pairs' counts over the corpus (a, b, count, best).

    Measures, one row per row of ``docs``: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum (longs), groups_sha256. A null or empty
    text, or one whose bytes either tokenizer changes, has no tokens: zeros and ''. Rows that repeat an id, or have none, are documents of
    their own. Ties for an A id's highest count are all best. An empty table gives no rows. Other columns are not looked at.

    A task holds one slice of texts and the longest of them; a stretch without single spaces is encoded as a whole.
    """
    bounded_batches(docs.sparkSession)
    n_b = len(aligner(path_a, path_b).size[1])
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    texts = rows.where("text <> ''").groupBy("text").agg(F.count("*").alias("copies"))
    slices = staged(texts.mapInArrow(_slices(path_a, path_b), _SLICE), "align_slices", "zstd")
    asked = slices.select("slice", F.explode(F.arrays_zip("pairs", "docs")).alias("p")).select("slice", F.col("p.pairs").alias("pair"), F.col("p.docs").alias("docs"))
    counts = asked.groupBy("pair").agg(F.sum("docs").alias("count")).withColumn("a", F.expr(f"pair div {n_b}"))
    counts = staged(counts, "align_counts")
    highest = counts.groupBy("a").agg(F.max("count").alias("highest"))
    counts = counts.join(highest, "a").select("a", "pair", "count", (F.col("count") == F.col("highest")).alias("best"))
    known = staged(counts, "align_best")
    answers = asked.select(F.col("slice").alias("asker"), "pair").join(known.select("pair", "count", "best"), "pair")
    packed = slices.select("slice", "sha", "size", "measures", "digests", "first", "local", "links")
    measured = packed.groupBy("slice").cogroup(answers.groupBy("asker")).applyInArrow(_measured, _MEASURE)
    measured = staged(measured, "align_measures")
    discard(slices)
    keyed = rows.withColumns({"_sha": F.unhex(F.sha2("text", 256)), "_size": F.octet_length("text").cast("long")})
    joined = keyed.drop("text").join(measured, (F.col("_sha") == F.col("sha")) & (F.col("_size") == F.col("size")), "left")
    names = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum"]
    of_docs = joined.select("doc_id", *[F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in names], F.coalesce("groups_sha256", F.lit("")).alias("groups_sha256"))
    pairs = known.select(F.col("a").cast("int").alias("a"), (F.col("pair") % n_b).cast("int").alias("b"), "count", "best")
    return of_docs, pairs
