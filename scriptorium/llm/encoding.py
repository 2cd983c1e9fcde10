"""Encoding of a corpus with a byte-level BPE vocabulary.

Frequent words of all documents are encoded once and compiled into a transducer that every worker maps into memory;
words outside it are merged exactly by the vocabulary's ranks. The result equals the tokenizer's own encoding.
"""

from __future__ import annotations

import base64
import re
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scriptorium.llm.lexicon import Lexicon, compile_lexicon
from scriptorium.session import fresh_path, local_path

#: Where the files of the public tokenizers are, and the vocabulary used (parameters of the operator).
VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: How many of the most frequent words go into the transducer; all others are merged exactly.
LEXICON_WORDS = 65_536
# fixed values: the white space of Unicode, and the vocabulary's pattern for pieces of a text
_WS = r"\t-\r \x85\xa0  -     　"
_RARE_WS = ("\t", "\x0b", "\x0c", "\r", "\x85", "\xa0", " ", *map(chr, range(0x2000, 0x200B)), " ", " ", " ", " ", "　")
PIECES = rf"'(?:[sdmt]|ll|ve|re)| ?\p{{L}}+| ?\p{{N}}+| ?[^{_WS}\p{{L}}\p{{N}}]+|[{_WS}]+(?![^{_WS}])|[{_WS}]+"
_SEGMENT = re.compile(rf"[{_WS}]*[^{_WS}]+|[{_WS}]+")


def words_of(text: str) -> list[str] | None:
    """The words of an evenly spaced text: the first as it is, others stand for blank + word, or begin with a line end. None if spacing is uneven."""
    if "  " in text or " \n" in text or "\n " in text or "\n\n\n" in text or text[-1] in " \n":
        return None
    for c in _RARE_WS:
        if c in text:
            return None
    return text.replace("\n", " \n").split(" ")


def _whole(word: str) -> str:
    return word if word.startswith("\n") else " " + word


class Merger:
    """Exact byte-pair merges by rank."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks, self.pattern, self.seen = ranks, regex.compile(PIECES), {}

    @classmethod
    @lru_cache(2)
    def load(cls, path: str) -> Merger:
        with open(path, "rb") as f:
            return cls({base64.b64decode(a): int(b) for a, b in map(bytes.split, f)})

    def piece(self, raw: bytes) -> list[int]:
        whole = self.ranks.get(raw)
        if whole is not None:
            return [whole]
        parts, ranks = [raw[i : i + 1] for i in range(len(raw))], self.ranks
        if len(parts) > 400:
            return self._long(parts)
        while len(parts) > 1:
            best, at = None, -1
            for i in range(len(parts) - 1):
                r = ranks.get(parts[i] + parts[i + 1])
                if r is not None and (best is None or r < best):
                    best, at = r, i
            if best is None:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return [ranks[p] for p in parts]

    def _long(self, parts: list[bytes]) -> list[int]:
        """The same merges with a heap, for pieces of any length."""
        import heapq

        n, ranks = len(parts), self.ranks
        nxt, prev, alive = list(range(1, n + 1)), list(range(-1, n - 1)), [True] * n
        heap = [(r, i, parts[i] + parts[i + 1]) for i in range(n - 1) if (r := ranks.get(parts[i] + parts[i + 1])) is not None]
        heapq.heapify(heap)
        while heap:
            r, i, both = heapq.heappop(heap)
            j = nxt[i] if alive[i] else n
            if j >= n or parts[i] + parts[j] != both:
                continue
            parts[i], alive[j], nxt[i] = both, False, nxt[j]
            if nxt[j] < n:
                prev[nxt[j]] = i
            for a in (prev[i], i):
                b = nxt[a] if a >= 0 else n
                if a >= 0 and b < n and (q := ranks.get(parts[a] + parts[b])) is not None:
                    heapq.heappush(heap, (q, a, parts[a] + parts[b]))
        return [ranks[p] for p, ok in zip(parts, alive) if ok]

    def ids(self, text: str) -> list[int]:
        out: list[int] = []
        for p in self.pattern.findall(text):
            known = self.seen.get(p)
            if known is None:
                if len(self.seen) > 500_000:
                    self.seen.clear()
                known = self.seen[p] = self.piece(p.encode("utf-8", "surrogatepass"))
            out += known
        return out


class _Words(dict):
    """Word -> packed ids: transducer first, exact merges otherwise. A bounded cache of its answers."""

    def __init__(self, lexicon: Lexicon, merger: Merger):
        self.lexicon, self.merger = lexicon, merger
        self.segments: dict[str, bytes] = {}

    def segment(self, text: str) -> bytes:
        """Ids of blanks of any kind and the word after them."""
        got = self.segments.get(text)
        if got is None:
            if len(self.segments) > 200_000:
                self.segments.clear()
            got = self.segments[text] = self.exact(text)
        return got

    def exact(self, text: str) -> bytes:
        return np.array(self.merger.ids(text), "<i4").tobytes()

    def __missing__(self, word: str) -> bytes:
        if len(self) > 400_000:
            self.clear()
        whole = _whole(word)
        got = self.lexicon.packed(whole.encode("utf-8", "surrogatepass"))
        self[word] = got = got if got is not None else self.exact(whole)
        return got


@lru_cache(2)
def _ready(source: str | bytes, vocabulary: str) -> _Words:
    return _Words(Lexicon.open(source), Merger.load(vocabulary))


def word_counts(texts: DataFrame, column: str = "text") -> DataFrame:
    """(parola, n) over all documents; counted in batches before anything is shuffled."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()

        def flush():
            out = pa.RecordBatch.from_arrays([pa.array(list(seen), pa.string()), pa.array(list(seen.values()), pa.int64())], ["parola", "n"])
            seen.clear()
            return out

        for b in batches:
            for text in b.column(0).to_pylist():
                if text:
                    words = words_of(text)
                    if words:
                        seen.update(words[1:])
                    elif words is None:
                        seen.update(x[1:] for x in _SEGMENT.findall(text) if x[0] == " " and len(x) > 1 and x[1] not in " \n")
            if len(seen) > 300_000:
                yield flush()
        if seen:
            yield flush()

    return texts.select(column).mapInArrow(count, "parola string, n long").groupBy("parola").agg(F.sum("n").alias("n"))


def build_lexicon(spark: SparkSession, texts: DataFrame, column: str = "text", vocabulary: str = VOCABULARY, size: int = LEXICON_WORDS) -> str | bytes:
    """Compile the `size` most frequent words; gives a path in the shared folder, or the blob where no path can be mapped."""
    top = word_counts(texts, column).where(F.length("parola") <= 64).orderBy(F.desc("n"), "parola").limit(size)
    merger = Merger.load(vocabulary)
    blob = compile_lexicon({_whole(r[0]).encode(): tuple(merger.ids(_whole(r[0]))) for r in top.select("parola").toLocalIterator()})
    path = fresh_path(spark, "lessico")
    if not path.startswith("file:"):
        return blob
    import os

    os.makedirs(os.path.dirname(local_path(path)), exist_ok=True)
    with open(local_path(path) + ".tmp", "wb") as f:
        f.write(blob)
    os.rename(local_path(path) + ".tmp", local_path(path))
    return local_path(path)


def packed(text: str | None, words: _Words) -> bytes:
    """The ids of a text as little-endian int32."""
    if not text:
        return b""
    parts = words_of(text)
    if parts is None:
        return b"".join(words[s[1:]] if s[0] == " " and len(s) > 1 and s[1] not in " \n" else words.segment(s) for s in _SEGMENT.findall(text))
    return words.exact(parts[0]) + b"".join(map(words.__getitem__, parts[1:]))


def encoded(docs: DataFrame, key: str = "doc_id", column: str = "text", vocabulary: str = VOCABULARY, size: int = LEXICON_WORDS, ids: bool = True) -> DataFrame:
    """(key, ids ARRAY<INT>) of every row, or (key, n_token BIGINT) with ids=False.

    Null and empty texts have the empty list (0 tokens); texts of special tokens are ordinary text; repeated rows are kept.
    """
    source = build_lexicon(docs.sparkSession, docs, column, vocabulary, size)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = _ready(source, vocabulary)
        for b in batches:
            out = [packed(t, words) for t in b.column(1).to_pylist()]
            lengths = np.fromiter((len(x) >> 2 for x in out), np.int64, len(out))
            if ids:
                offsets = np.zeros(len(out) + 1, np.int32)
                np.cumsum(lengths, out=offsets[1:])
                values = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.frombuffer(b"".join(out), "<i4")))
            else:
                values = pa.array(lengths)
            yield pa.RecordBatch.from_arrays([b.column(0), values], [key, "ids" if ids else "n_token"])

    return docs.select(key, column).mapInArrow(encode, f"{key} {dict(docs.dtypes)[key]}, " + ("ids array<int>" if ids else "n_token bigint"))
