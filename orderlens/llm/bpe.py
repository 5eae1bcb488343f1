"""BPE encoding and decoding by a prefix-sharing trie.

A text is cut at its spaces into chunks and each distinct chunk, normalised as the vocabulary asks, into words.
The distinct words of a batch go into one trie, so a prefix that words share is one path. Every node holds the
last token of the encoding of its path. That token is the only suffix token that may follow the last token of
what stands before it, where "may follow" means: the merges turn the two tokens' symbols into just these two
tokens. A depth-first walk thus finds each shared prefix's encoding once, and a word's tokens by going back along
the last tokens from its end.
"""

from __future__ import annotations

import gc
import hashlib
import json
import re
import unicodedata
from collections.abc import Iterable, Iterator
from functools import lru_cache

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from orderlens.llm.common import bounded_batches, slices

END = "</w>"
MOST_CHUNKS = 200_000


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = (b for b in range(256) if b not in plain)
    shifted = {b: chr(256 + i) for i, b in enumerate(others)}
    return [chr(b) if b in plain else shifted[b] for b in range(256)]


class WordTrie:
    """Encodes words with the vocabulary and merges of a BPE whose words end in a marked symbol.

    A word is a sequence of symbols, the last of them with the end mark. ``encode`` takes many words at once.
    """

    def __init__(self, vocab: dict[str, int], merges: list[tuple[str, str]], end: str = END):
        self.end = end
        self.rank = {pair: i for i, pair in enumerate(merges)}
        self.ids = vocab
        tokens = {a + b for a, b in merges} | {a for pair in merges for a in pair}
        tokens |= {t for t in vocab if len(t.removesuffix(end)) == 1}
        self.tokens = {t for t in tokens if t in vocab and self._merged(self._symbols(t)) == [t]}
        self.longest = max(len(t.removesuffix(end)) for t in self.tokens)
        # Age of a token: symbols first, then merged ones in the order of their merges; halves: what it merges.
        self.age = {t: i for i, t in enumerate(sorted({s for t in self.tokens for s in self._symbols(t)}))}
        symbols = len(self.age)
        self.halves = {t: (t, t) for t in self.age}
        for i, (a, b) in enumerate(merges):
            self.age.setdefault(a + b, symbols + i)
            self.halves.setdefault(a + b, (a, b))
        self.made = {(a, b): self.age[a + b] for a, b in merges}
        self.may_follow = lru_cache(1 << 18)(self._may_follow)

    def _symbols(self, token: str) -> list[str]:
        body = token.removesuffix(self.end) or token
        return list(body) if body == token else [*body[:-1], body[-1] + self.end]

    def _merged(self, parts: list[str]) -> list[str]:
        """Apply the merges to a few symbols, best rank first, leftmost first."""
        parts = list(parts)
        while len(parts) > 1:
            best = min((self.rank.get(p, len(self.rank)), i) for i, p in enumerate(zip(parts, parts[1:], strict=False)))
            if best[0] == len(self.rank):
                break
            i = best[1]
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
        return parts

    def _may_follow(self, left: str, right: str) -> bool:
        """Whether no merge joins symbols across the border of two adjacent tokens.

        Takes back the two tokens' merges, youngest first. A pair that meets at the border on the way would have
        been merged if that merge is older than the one just taken back.
        """
        age, halves, made = self.age, self.halves, self.made
        limit = len(age) + len(self.rank)
        while True:
            joined = made.get((left, right))
            if joined is not None and joined < limit:
                return False
            old_left, old_right = halves[left][0] is left, halves[right][0] is right
            if old_left and old_right:
                return True
            if not old_left and (old_right or age[left] > age[right]):
                limit, left = age[left], halves[left][1]
            else:
                # The right token's own merge comes after an equal one further left.
                limit, right = age[right] + 1, halves[right][0]

    def _start(self, path: str, end: str, states: list[str]) -> int:
        """Where the last token of ``path`` begins; ``states[k]`` is the last token of its first k symbols."""
        tokens, may_follow = self.tokens, self.may_follow
        start = max(0, len(path) - self.longest)
        while start < len(path):
            token = path[start:] + end
            if token in tokens and (start == 0 or may_follow(states[start], token)):
                return start
            start += 1
        raise KeyError(path)

    def encode(self, words: Iterable[str]) -> dict[str, list[str]]:
        """Tokens of each distinct word (strings of one or more byte symbols)."""
        root: dict = {}
        longest = 0
        for word in words:
            node = root
            for c in word[:-1]:
                child = node.get(c)
                if child is None:
                    child = node[c] = {}
                node = child
            node.setdefault("", []).append(word)  # words that end one symbol after this path
            longest = max(longest, len(word))
        found: dict[str, list[str]] = {}
        states = [""] * (longest + 1)
        stack: list[tuple[dict, str]] = [(root, "")]
        while stack:
            # Whoever is popped next is a child of this path or of one of its ancestors, whose states still stand.
            node, path = stack.pop()
            if path:
                states[len(path)] = path[self._start(path, "", states) :]
            for c, child in node.items():
                if c:
                    stack.append((child, path + c))
                    continue
                for word in child:
                    at = self._start(word, self.end, states)
                    tokens = [word[at:] + self.end]
                    while at:
                        token = states[at]
                        tokens.append(token)
                        at -= len(token)
                    found[word] = tokens[::-1]
        return found


class WordBpe:
    """A word-level BPE file: normaliser, word pattern, added tokens and the trie over its merges.

    Text goes through NFC, white space to a space, lower case letter by letter; words are what the pattern matches.
    """

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        kinds = [n["type"] for n in spec["normalizer"]["normalizers"]]
        if kinds != ["NFC", "Replace", "Lowercase"] or model["end_of_word_suffix"] != END or spec.get("decoder"):
            raise ValueError("this is not the kind of vocabulary that this operator reads")
        pairs = (m.split(" ") if isinstance(m, str) else m for m in model["merges"])
        merges = [(a, b) for a, b in pairs]
        self.trie = WordTrie(model["vocab"], merges)
        added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.ids = {**model["vocab"], **added}
        self.added = re.compile("(" + "|".join(map(re.escape, added)) + ")") if added else None
        pattern = spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        # The file means Unicode white space; regex would count four control characters as well.
        self.words = regex.compile(pattern.replace(r"[^\s", r"[^\p{White_Space}"))
        self.symbol = byte_symbols()
        self.library = Tokenizer.from_file(path)
        self.chunks: list[dict[str, tuple[str, str]]] = [{}, {}]
        self.encoded: list[dict[str, tuple[str, str]]] = [{}, {}]

    def _words(self, piece: str) -> list[str]:
        if piece.isascii() and piece.isprintable():
            if piece.isalpha():
                return [piece.lower()]
            return self.words.findall(piece.lower())
        if not (piece.isascii() or piece.isprintable()) and any([unicodedata.category(c) == "Cn" for c in piece]):
            # Whether these are letters yet depends on the Unicode version that a library knows.
            text = self.library.normalizer.normalize_str(piece.encode("utf-8", "replace").decode("utf-8"))
            return [w for w, _ in self.library.pre_tokenizer.pre_tokenize_str(text)]
        text = "".join([c.lower() for c in unicodedata.normalize("NFC", piece)])
        symbol = self.symbol
        return ["".join([symbol[b] for b in w.encode("utf-8", "replace")]) for w in self.words.findall(text)]

    def learn(self, chunks: Iterable[str]) -> None:
        """Encode chunks that are not known yet. What is known stays bounded: what was not used for long is forgotten."""
        cut = {}
        for chunk in _unknown(self.chunks, chunks):
            if self.added and "<" in chunk and len(pieces := self.added.split(chunk)) > 1:
                # Every second piece is an added token.
                cut[chunk] = [
                    x
                    for i, p in enumerate(pieces)
                    for x in ([(p,)] if i % 2 else self._words(p))
                ]
            else:
                cut[chunk] = self._words(chunk)
        wanted = {w for words in cut.values() for w in words if type(w) is str}
        fresh = self.trie.encode(_unknown(self.encoded, wanted))
        encoded, ids, known = self.encoded[0], self.ids, self.chunks[0]
        for word, tokens in fresh.items():
            encoded[word] = (" ".join([str(ids[t]) for t in tokens]), " ".join(tokens))
        for chunk, words in cut.items():
            if len(words) == 1 and type(words[0]) is str:
                known[chunk] = encoded[words[0]]
            else:
                got = [encoded[w] if type(w) is str else (str(ids[w[0]]), w[0]) for w in words]
                known[chunk] = (" ".join([g[0] for g in got]), " ".join([g[1] for g in got]))

    def texts(self, texts: list[str]) -> Iterator[tuple[int, str, str]]:
        """(number of tokens, decimal ids joined by a space, decoded text) of each whole text."""
        split = [t.split(" ") for t in texts]
        self.learn({c for s in split for c in s})
        known = self.chunks[0]
        for s in split:
            got = [known[c] for c in s]
            ids = " ".join(filter(None, [g[0] for g in got]))
            yield (ids.count(" ") + 1 if ids else 0, ids, " ".join(filter(None, [g[1] for g in got])))


def _unknown(store: list[dict], keys: Iterable[str]) -> list[str]:
    """Keys that the store lacks; those of its older half that are asked for move to the younger one."""
    if len(store[0]) > MOST_CHUNKS:
        store[:] = [{}, store[0]]
    young, old = store
    fresh = []
    for k in keys:
        if k not in young:
            if k in old:
                young[k] = old[k]
            else:
                fresh.append(k)
    return fresh


@lru_cache(2)
def load(path: str) -> WordBpe:
    return WordBpe(path)


def encode_texts(
    docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False
) -> DataFrame:
    """Per row: doc_id, n_tokens, ids_sha256, decoded_sha256 and, if asked for, ids and decoded.

    ``path`` names the vocabulary file on every executor. A null text counts as empty and has no tokens; repeated rows
    are encoded each; extra columns do not matter; an empty table gives no rows.
    """
    bounded_batches(docs.sparkSession)
    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    schema += ", ids array<int>, decoded string" if with_ids else ""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gc.disable()  # the stores hold many small objects and no cycles
        bpe = load(path)
        for whole in batches:
            for batch in slices(whole, "text", 4 << 20):
                got = list(bpe.texts([t or "" for t in batch.column(1).to_pylist()]))
                columns = [
                    batch.column(0),
                    pa.array([g[0] for g in got], pa.int64()),
                    pa.array([hashlib.sha256(g[1].encode()).hexdigest() for g in got]),
                    pa.array([hashlib.sha256(g[2].encode()).hexdigest() for g in got]),
                ]
                names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
                if with_ids:
                    columns += [
                        pa.array([[int(i) for i in g[1].split()] for g in got], pa.list_(pa.int32())),
                        pa.array([g[2] for g in got], pa.string()),
                    ]
                    names += ["ids", "decoded"]
                yield pa.RecordBatch.from_arrays(columns, names)

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, schema)
