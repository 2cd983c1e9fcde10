"""Subject areas of documents: term weighting, truncated SVD, cosine to refined seed centroids.

Document frequencies come from all documents. Weights, the SVD and the centroids are fitted on a bounded sample of
hand-labelled documents. A document is embedded passage by passage (sentences), since a document may deal with several
areas; each passage goes to the area of its nearest centroid, and an area counts if a good part of the passages has it.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

#: Bounds of the model: labelled documents used for the fit (by hash of their id, none longer than FIT_CHARS), terms, dimensions.
FIT_DOCS, FIT_CHARS, TERMS, DIMENSIONS, ROUNDS, FIT_COSINE = 2400, 20_000, 6000, 40, 3, 0.35
#: Documents without labels in the fit (by hash of their id): they shape the SVD, and passages at this cosine and this far from the next area refine the centroids.
FIT_FREE, FREE_COSINE, FREE_MARGIN = 1200, 0.5, 0.15
#: Terms lighter than this part of the heaviest say nothing about areas and are left out of the model.
LIGHT = 0.02
#: A passage has an area at this cosine. A document has its commonest area, and each other one with so many passages and that share of those with an area.
COSINE, LEAST, SHARE = 0.4, 3, 0.12
#: Fewer terms of the model in a passage say nothing.
TERMS_LEAST = 2
NONE = "nessuna"

_CUT = re.compile("[-¬‐\xad]\\s*\\n\\s*")
_TOKEN = re.compile(r"[a-zà-öø-ÿœ]+|[.!?]")
_END, _OTHER = -2, -1


def tokens(text: str | None) -> list[str]:
    """Lower-case words, and the signs that end passages; words cut at line ends are whole again."""
    if not text:
        return []
    return _TOKEN.findall((_CUT.sub("", text) if "\n" in text else text).lower())


def _pieces(text: str | None) -> list[str]:
    """What stands between blanks, in lower case: tokens of a text are those of its pieces in turn."""
    if not text:
        return []
    return (_CUT.sub("", text) if "\n" in text else text).lower().split()


class _Tokens(dict):
    """Piece -> its tokens. A bounded cache, since pieces recur."""

    def __missing__(self, piece: str) -> tuple[str, ...]:
        if len(self) > 300_000:
            self.clear()
        self[piece] = got = tuple(_TOKEN.findall(piece))
        return got


class _Codes(dict):
    """Piece -> packed codes of its tokens by a vocabulary."""

    def __init__(self, vocabulary: dict[str, int]):
        self.vocabulary = vocabulary

    def __missing__(self, piece: str) -> bytes:
        if len(self) > 300_000:
            self.clear()
        self[piece] = got = np.array([self.vocabulary.get(t, _OTHER) for t in _TOKEN.findall(piece)], np.int32).tobytes()
        return got


def document_frequencies(docs: DataFrame, column: str = "text") -> DataFrame:
    """(termine, n): in how many documents a term occurs, over all documents."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()
        known = _Tokens()
        for b in batches:
            for t in b.column(0).to_pylist():
                seen.update(set().union(*map(known.__getitem__, set(_pieces(t)))))
            if len(seen) > 300_000:
                yield pa.RecordBatch.from_arrays([pa.array(list(seen), pa.string()), pa.array(list(seen.values()), pa.int64())], ["termine", "n"])
                seen.clear()
        if seen:
            yield pa.RecordBatch.from_arrays([pa.array(list(seen), pa.string()), pa.array(list(seen.values()), pa.int64())], ["termine", "n"])

    return docs.select(column).mapInArrow(count, "termine string, n long").groupBy("termine").agg(F.sum("n").alias("n"))


def _passages(texts: list[str | None], known: _Codes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Term ids, the passage of each, and the document of each passage."""
    mark = np.array([_END], np.int32).tobytes()
    codes = [b"".join(map(known.__getitem__, _pieces(t))) + mark for t in texts]
    flat = np.frombuffer(b"".join(codes), np.int32)
    doc = np.repeat(np.arange(len(texts), dtype=np.int32), [len(c) >> 2 for c in codes])
    end = flat == _END
    passage = np.cumsum(end) - end
    keep = flat >= 0
    return flat[keep], passage[keep], doc[end]


def _embed(terms: np.ndarray, passage: np.ndarray, n: int, weights: np.ndarray) -> np.ndarray:
    """Sums of the terms' vectors by passage, in blocks that fit memory."""
    out = np.zeros((n, weights.shape[1]), np.float32)
    if not len(terms):
        return out
    cuts = np.flatnonzero(np.diff(passage)) + 1
    starts = np.concatenate([[0], cuts])
    for lo in range(0, len(starts), 20_000):
        s = starts[lo : lo + 20_000]
        stop = starts[lo + 20_000] if lo + 20_000 < len(starts) else len(terms)
        out[passage[s]] = np.add.reduceat(weights[terms[s[0] : stop]], s - s[0], axis=0)
    return out


def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.maximum(np.linalg.norm(x, axis=-1, keepdims=True), 1e-9)


def truncated_svd(terms: np.ndarray, passage: np.ndarray, weights: np.ndarray, k: int, rounds: int = 3) -> np.ndarray:
    """Right singular vectors (terms x k) of the weighted passage-term matrix, by subspace iteration."""
    v = len(weights)
    k = min(k, v)
    order = np.argsort(terms, kind="stable")
    q = np.linalg.qr(np.random.default_rng(7).standard_normal((v, k)).astype(np.float32))[0]
    n = int(passage.max()) + 1 if len(passage) else 0
    back_terms, back_passage = terms[order], passage[order]
    for _ in range(rounds):
        y = _embed(terms, passage, n, (q * weights[:, None]).astype(np.float32))
        q = np.linalg.qr(_scatter(back_terms, back_passage, v, y) * weights[:, None])[0]
    return q.astype(np.float32)


def _scatter(terms: np.ndarray, passage: np.ndarray, v: int, y: np.ndarray) -> np.ndarray:
    """Sums of passage rows by term; terms are sorted."""
    out = np.zeros((v, y.shape[1]), np.float32)
    if len(terms):
        starts = np.concatenate([[0], np.flatnonzero(np.diff(terms)) + 1])
        for lo in range(0, len(starts), 200):
            s = starts[lo : lo + 200]
            stop = starts[lo + 200] if lo + 200 < len(starts) else len(terms)
            out[terms[s]] = np.add.reduceat(y[passage[s[0] : stop]], s - s[0], axis=0)
    return out


class TopicModel:
    """vocabulary: term -> row; vectors: weighted terms in the space of the SVD; centroids with the area of each."""

    def __init__(self, vocabulary: dict[str, int], vectors: np.ndarray, centroids: np.ndarray, areas: list[str]):
        self.vocabulary, self.vectors, self.centroids, self.areas = vocabulary, vectors, centroids, areas
        self._codes: _Codes | None = None

    def __getstate__(self) -> dict:
        return self.__dict__ | {"_codes": None}

    def areas_of(self, texts: list[str | None]) -> list[list[tuple[str, float]]]:
        """(area, share of passages) of each text, largest first."""
        self._codes = self._codes or _Codes(self.vocabulary)
        terms, passage, doc = _passages(texts, self._codes)
        out: list[list[tuple[str, float]]] = [[] for _ in texts]
        if not len(terms) or not len(self.centroids):
            return out
        e = _embed(terms, passage, len(doc), self.vectors)
        near = _unit(e) @ self.centroids.T
        best = near.argmax(1)
        names = sorted(set(self.areas))
        code = np.array([names.index(a) for a in self.areas])
        has = (near[np.arange(len(best)), best] >= COSINE) & (np.bincount(passage, minlength=len(best)) >= TERMS_LEAST) & (np.array([a != NONE for a in self.areas])[best])
        counts = np.zeros((len(texts), len(names)), np.int64)
        np.add.at(counts, (doc[has], code[best[has]]), 1)
        total = counts.sum(1)
        for d in np.flatnonzero(total):
            row, t = counts[d], total[d]
            ranked = np.argsort(-row, kind="stable")
            out[d] = [(names[a], row[a] / t) for k, a in enumerate(ranked) if k == 0 or (row[a] >= LEAST and row[a] / t >= SHARE)]
        return out


def fit(docs: DataFrame, labels: DataFrame, areas: DataFrame, key: str = "doc_id", column: str = "text") -> TopicModel:
    """Fit on at most FIT_DOCS labelled documents; term statistics are those of all documents.

    labels: doc_id, area, annotatore; an area of a document counts if at least half of its annotators gave it. Areas
    that aren't in `areas` are ignored. Without labels the model gives no areas.
    """
    top = document_frequencies(docs, column).where("n > 1").orderBy(F.desc("n"), "termine").limit(TERMS).toPandas()
    n_docs = docs.count()
    known = [r.area for r in areas.select("area").distinct().collect() if r.area] + [NONE]
    votes = labels.select(key, "area", "annotatore").dropna(subset=[key, "area"]).distinct()
    given = votes.groupBy(key, "area").agg(F.countDistinct("annotatore").alias("v")).join(votes.groupBy(key).agg(F.countDistinct("annotatore").alias("a")), key).where("2 * v >= a")
    sets = given.where(F.col("area").isin(known)).groupBy(key).agg(F.sort_array(F.collect_set("area")).alias("aree"))
    texts = docs.select(key, F.col(column).alias("_t"), F.coalesce(F.lower("lang"), F.lit("?")).alias("_l") if "lang" in docs.columns else F.lit("?").alias("_l"))
    sample = texts.where(F.col("_t").isNotNull() & (F.length("_t") <= FIT_CHARS)).join(sets, key).select("_t", "_l", "aree").orderBy(F.xxhash64(key), key).limit(FIT_DOCS).collect()
    free = texts.where(F.col("_t").isNotNull() & F.length("_t").between(1, FIT_CHARS)).join(sets.select(key), key, "left_anti").orderBy(F.xxhash64(key), key).limit(FIT_FREE).select("_t", "_l").collect() if sample else []
    if "descrizione" in areas.columns:  # what an area is said to be is its first seed
        sample += [Row(_t=r.descrizione, _l="?", aree=[r.area]) for r in areas.dropDuplicates(["area"]).collect() if r.area and r.descrizione]

    free_from = len(sample)
    sample += [Row(_t=r._t, _l=r._l, aree=[]) for r in free]
    vocabulary = {t: i for i, t in enumerate(top.termine)} | dict.fromkeys(".!?", _END)
    names = sorted(known)
    terms, passage, doc = _passages([r._t for r in sample], _Codes(vocabulary))
    if not len(terms):
        return TopicModel(vocabulary, np.zeros((TERMS, 1), np.float32), np.zeros((0, 1), np.float32), [])
    allowed = np.zeros((len(sample), len(names)), bool)
    for i, r in enumerate(sample):
        allowed[i, [names.index(a) for a in r.aree]] = True
    tongues = sorted({r._l for r in sample})
    tongue = np.array([tongues.index(r._l) for r in sample])
    idf = np.log1p(n_docs / np.maximum(1, top.n.to_numpy(np.float64)))
    member = (allowed / np.maximum(allowed.sum(1, keepdims=True), 1))[doc]  # passage -> areas; none yet without labels
    unlabelled = doc >= free_from
    allowed[free_from:] = True
    cells = [(t, a) for t in range(len(tongues)) for a in range(len(names))]
    for turn in range(ROUNDS):
        spread = np.zeros((len(vocabulary) + 8, len(names)))
        for a in range(len(names)):
            spread[:, a] = np.bincount(terms, member[passage, a], len(spread))[: len(spread)]
        spread = spread / np.maximum(member.sum(0), 1) + 1e-6
        p = spread / spread.sum(1, keepdims=True)
        focus = 1 + (p * np.log(p)).sum(1) / np.log(len(names))
        weights = (np.resize(idf, len(spread)) * np.maximum(focus, 0) ** 2).astype(np.float32)
        q = truncated_svd(terms, passage, weights, DIMENSIONS)
        vectors = q * weights[:, None]
        e = _embed(terms, passage, len(doc), vectors)
        u = _unit(e)
        for _ in range(4):  # seeds are the labels' members; then centroids and members in turn
            heads, at = [], []
            for t, a in cells:
                w = member[:, a] * (tongue[doc] == t)
                if (w > 0).sum() >= 5:
                    heads.append(_unit((u * w[:, None]).sum(0)))
                    at.append(a)
            for a in sorted(set(range(len(names))) - set(at)):  # too few passages in any language: one centroid of them all
                if (member[:, a] > 0).any():
                    heads.append(_unit((u * member[:, a, None]).sum(0)))
                    at.append(a)
            heads, at = np.array(heads, np.float32), np.array(at)
            near = u @ heads.T
            per_area = np.full((len(doc), len(names)), -1.0, np.float32)
            for h, a in enumerate(at):
                per_area[:, a] = np.maximum(per_area[:, a], near[:, h])
            fits = np.where(allowed[doc], per_area, -1.0)
            best = fits.argmax(1)
            overall = per_area.max(1)
            second = np.partition(per_area, -2, axis=1)[:, -2] if per_area.shape[1] > 1 else np.full(len(doc), -1.0)
            sure = np.where(unlabelled, (overall >= FREE_COSINE) & (overall - second >= FREE_MARGIN), (fits.max(1) >= FIT_COSINE) & (fits.max(1) >= overall - 0.1))
            member = np.zeros_like(member)
            member[np.flatnonzero(sure), best[sure]] = 1.0
    heavy = {t: i for t, i in vocabulary.items() if i < 0 or weights[i] >= LIGHT * weights.max()}
    return TopicModel(heavy, vectors.astype(np.float32), heads, [names[a] for a in at])


def assigned(docs: DataFrame, model: TopicModel, key: str = "doc_id", column: str = "text") -> DataFrame:
    """(key, area, quota) for each area of each document; texts that are null, blank or without an area give no row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # TERMS x DIMENSIONS floats and the centroids

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for b in batches:
            found = m.areas_of(b.column(1).to_pylist())
            rows = np.repeat(np.arange(len(found)), [len(f) for f in found])
            flat = [x for f in found for x in f]
            yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(rows)), pa.array([a for a, _ in flat], pa.string()), pa.array([float(s) for _, s in flat], pa.float64())], [key, "area", "quota"])

    return docs.select(key, column).mapInArrow(assign, f"{key} {dict(docs.dtypes)[key]}, area string, quota double")
