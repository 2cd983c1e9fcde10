"""Pairs of names that can share so much of their grams, for an exact test afterwards.

Grams fall into CODES codes, ordered by how many names have them. If two names share o of n grams each, their first
common code is among the first n - o + 1 codes of either, whatever grams fell together; so a name is posted under its
first codes only. Within a code all posted pairs are compared, first by sizes and places, then by 128 and by
SIGNS bits of their codes, then by the codes themselves; none of these leaves out a pair that is alike. A pair comes out at its first
common code only. Codes of many names are cut into blocks, and each pair of blocks is a group of its own.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scriptorium.session import slot_count

# fixed values: codes of two bytes, bits that stand for a name's codes, names of a code in one block, rows and columns compared at once, pairs tested at once
CODES = 1 << 16
SIGNS = 512
BLOCK = 1 << 15
ROWS, COLUMNS = 32, 2048
PAIRS = 1 << 14

_LEFT, _RIGHT = 1, 2
_POSTED = pa.schema([("_k", pa.int64()), ("_own", pa.int32()), ("_s", pa.string()), ("_side", pa.int32()), ("_n", pa.int32()), ("_m", pa.int32()), ("_c", pa.binary())])
_DDL = "_k bigint, _own int, _s string, _side int, _n int, _m int, _c binary"


def _needed(least: float) -> float:
    """The part of both sizes together that alike names share; likeness is rounded to four digits afterwards."""
    t = max(least - 6e-5, 1e-9)
    return t / (1 + t)


def _coded(names: DataFrame, name: str, grams: Column, side: int) -> DataFrame:
    """(_s, _side, _c): distinct names with a code for each of their different grams."""
    codes = F.transform(F.array_distinct(grams), lambda g: F.xxhash64(g).bitwiseAND(CODES - 1))
    return names.select(name).where(F.col(name).isNotNull()).distinct().select(F.col(name).alias("_s"), F.lit(side).alias("_side"), codes.alias("_c"))


def _posted(coded: DataFrame, needed: float) -> DataFrame:
    """Names under their first codes (_k: code and pair of blocks), with their size, the size of partners at most and all codes."""
    count = np.zeros(CODES, np.int64)
    for code, n in coded.select(F.explode("_c").alias("c")).groupBy("c").count().collect():  # CODES rows at most
        count[code] = n
    order = np.argsort(count, kind="stable")
    order = np.concatenate([order[count[order] > 0], order[count[order] == 0]])
    rank = np.empty(CODES, np.int64)
    rank[order] = np.arange(CODES)
    blocks = np.maximum(1, -(-count[order] // BLOCK))
    least = needed / (1 - needed)

    def post(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for x in batches:
            if not x.num_rows:
                continue
            names, side, codes, h = (x.column(i) for i in range(4))
            n = pc.list_value_length(codes).fill_null(0).to_numpy()
            key = np.unique(np.repeat(np.arange(len(n)), n) << 16 | rank[codes.flatten().to_numpy()])
            row, code = key >> 16, key & (CODES - 1)
            ends = np.concatenate([[0], np.cumsum(np.bincount(row, minlength=len(n)))])
            kept = n[row] - (np.arange(len(row)) - ends[row])  # grams from here on, at most
            most = np.floor(kept / needed + 1e-9).clip(max=1 << 30).astype(np.int64) - n[row]
            at = np.flatnonzero(most >= np.ceil(least * n[row] - 1e-9))
            packed = pa.Array.from_buffers(pa.binary(), len(n), [None, pa.py_buffer((ends * 2).astype(np.int32)), pa.py_buffer(code.astype("<u2"))])
            k = blocks[code[at]]
            own = h.to_numpy()[row[at]] % k
            again = np.repeat(np.arange(len(at)), k)
            other = np.arange(len(again)) - np.repeat(np.cumsum(k) - k, k)
            at, own = at[again], own[again]
            for i in range(0, len(at), 1 << 15):
                p, q, o = at[i : i + (1 << 15)], own[i : i + (1 << 15)], other[i : i + (1 << 15)]
                r = pa.array(row[p])
                keys = code[p] << 32 | np.minimum(q, o) << 16 | np.maximum(q, o)
                yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(q.astype(np.int32)), names.take(r), side.take(r), pa.array(n[row[p]].astype(np.int32)), pa.array(most[p].astype(np.int32)), packed.take(r)], schema=_POSTED)

    return coded.select("_s", "_side", "_c", F.xxhash64("_s").bitwiseAND((1 << 62) - 1).alias("_h")).mapInArrow(post, _DDL)


def _signs(flat: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """SIGNS bits of the codes of each row, as whole words."""
    out = np.empty((len(starts), SIGNS // 64), np.uint64)
    for i in range(0, len(starts), PAIRS):
        n = lengths[i : i + PAIRS]
        bits = np.zeros((len(n), SIGNS), bool)
        bits[np.repeat(np.arange(len(n)), n), flat[starts[i] : starts[i] + n.sum()] & (SIGNS - 1)] = True
        out[i : i + PAIRS] = np.packbits(bits, axis=1, bitorder="little").view(np.uint64)
    return out


class _Group:
    """Rows of one group in order of size, then of partners' size."""

    def __init__(self, at: np.ndarray, n: np.ndarray, m: np.ndarray, signs: np.ndarray):
        self.at = at[np.lexsort((m[at], n[at]))]
        self.n, self.m, self.signs = n[self.at], m[self.at], signs[self.at]
        self.short = np.stack([np.bitwise_or.reduce(self.signs[:, half::2], axis=1) for half in (0, 1)])  # 128 bits

    def near(self, other: _Group, limit: np.ndarray, room: tuple[np.ndarray, ...]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Rows of self and of other that may be alike; of a group with itself, each pair once."""
        size = len(self.n)
        starts = np.flatnonzero(np.diff(self.n, prepend=-1)) if size > 2 * ROWS else np.array([0])
        for lo, hi in zip(starts, [*starts[1:], size]):
            cols = np.flatnonzero(other.m >= self.n[lo])
            yn, ys = other.n[cols], other.short[:, cols]
            for i in range(lo, hi, ROWS):
                j = min(i + ROWS, hi)
                end = np.searchsorted(yn, self.m[i:j].max(), "right")
                if other is self:
                    end = min(end, np.searchsorted(cols, j))
                xn = self.n[i:j, None] if len(starts) == 1 else self.n[i : i + 1, None]
                for k in range(0, end, COLUMNS):
                    s = slice(k, min(k + COLUMNS, end))
                    wide = s.stop - k
                    words, apart, more, fits = (x[: (j - i) * wide].reshape(j - i, wide) for x in room)
                    np.bitwise_count(np.bitwise_xor(self.short[0, i:j, None], ys[0, s], out=words), out=apart)
                    np.bitwise_count(np.bitwise_xor(self.short[1, i:j, None], ys[1, s], out=words), out=more)
                    np.add(apart, more, out=apart)
                    r, c = np.divmod(np.flatnonzero(np.less_equal(apart, limit[xn + yn[s]], out=fits)), wide)
                    if len(r):
                        r, c = r + i, cols[c + k]
                        ok = (other.n[c] <= self.m[r]) & (self.n[r] <= other.m[c])
                        if other is self:
                            ok &= c < r
                        r, c = r[ok], c[ok]
                        ok = np.bitwise_count(self.signs[r] ^ other.signs[c]).sum(1) <= limit[self.n[r] + other.n[c]]
                        yield self.at[r[ok]], other.at[c[ok]]


def _padded(flat: np.ndarray, starts: np.ndarray, lengths: np.ndarray, none: int) -> np.ndarray:
    place = np.arange(lengths.max())
    inside = place < lengths[:, None]
    return np.where(inside, flat[np.where(inside, starts[:, None] + place, 0)], none)


def _pairs(batches: Iterator[pa.RecordBatch], needed: float) -> Iterator[pa.RecordBatch]:
    """(a, b) from postings in order of their groups."""

    def compared(x: pa.Table) -> Iterator[pa.RecordBatch]:
        keys, own, side, n, m = (x.column(c).to_numpy() for c in ("_k", "_own", "_side", "_n", "_m"))
        names, packed = x.column("_s"), x.column("_c").to_pylist()
        flat = np.frombuffer(b"".join(packed), "<u2").astype(np.int32)
        lengths = np.fromiter(map(len, packed), np.int64, len(packed)) // 2
        starts = np.cumsum(lengths) - lengths
        signs = _signs(flat, starts, lengths)
        both = np.arange(2 * int(n.max()) + 1)
        apart = (both - 2 * np.ceil(both * needed - 1e-9)).clip(min=0).astype(np.int64)  # grams that only one of the two has, at most
        limit = apart.clip(max=255).astype(np.uint8)

        def tested(r: np.ndarray, c: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            """Pairs that share enough codes, of which their group's is the first."""
            some = max(1, (1 << 20) // int(lengths[r].max() + lengths[c].max()))
            good = []
            for i in range(0, len(r), some):
                p, q = r[i : i + some], c[i : i + some]
                z = np.concatenate([_padded(flat, starts[p], lengths[p], -1), _padded(flat, starts[q], lengths[q], -2)], 1)
                z.sort(1)
                twice = (z[:, 1:] == z[:, :-1]) & (z[:, 1:] >= 0)
                first = z[np.arange(len(p)), twice.argmax(1)]
                good.append((first == keys[p] >> 32) & (lengths[p] + lengths[q] - 2 * twice.sum(1) <= apart[n[p] + n[q]]))
            ok = np.concatenate(good)
            return r[ok], c[ok]

        def named(r: np.ndarray, c: np.ndarray) -> pa.RecordBatch:
            there, back = (side[r] & _LEFT > 0) & (side[c] & _RIGHT > 0), (side[c] & _LEFT > 0) & (side[r] & _RIGHT > 0) & (r != c)
            one, two = np.concatenate([r[there], c[back]]), np.concatenate([c[there], r[back]])
            return pa.RecordBatch.from_arrays([names.take(pa.array(i)).combine_chunks() for i in (one, two)], ["a", "b"])

        code, block, last = keys >> 32, keys >> 16 & 0xFFFF, keys & 0xFFFF
        itself = np.flatnonzero((block == last) & (side == _LEFT | _RIGHT) & (flat[starts] == code))
        if len(itself):
            yield named(itself, itself)
        some: list[tuple[np.ndarray, np.ndarray]] = []
        waiting = 0
        edges = np.flatnonzero(np.diff(keys, prepend=-1))
        for lo, hi in zip(edges, [*edges[1:], len(keys)]):
            if hi - lo < 2:
                continue
            rows = np.arange(lo, hi)
            if block[lo] == last[lo]:
                group = other = _Group(rows, n, m, signs)
            else:
                group, other = (_Group(rows[own[lo:hi] == k], n, m, signs) for k in (block[lo], last[lo]))
            for pair in group.near(other, limit, room) if len(group.n) and len(other.n) else ():
                some.append(pair)
                waiting += len(pair[0])
                if waiting >= PAIRS:
                    yield named(*tested(*map(np.concatenate, zip(*some))))
                    some, waiting = [], 0
        if waiting:
            yield named(*tested(*map(np.concatenate, zip(*some))))

    room = tuple(np.empty(ROWS * COLUMNS, t) for t in (np.uint64, np.uint8, np.uint8, bool))
    held: list[pa.RecordBatch] = []
    for b in batches:
        if not b.num_rows:
            continue
        held.append(b)
        if (last := b.column(0)[-1].as_py()) != held[0].column(0)[0].as_py():
            x = pa.Table.from_batches(held)
            end = int(np.searchsorted(x.column("_k").to_numpy(), last))
            yield from compared(x.slice(0, end).combine_chunks())
            held = x.slice(end).to_batches()
    if held:
        yield from compared(pa.Table.from_batches(held).combine_chunks())


def _compared(coded: DataFrame, a: str, b: str, least: float) -> DataFrame:
    needed = _needed(least)
    grouped = _posted(coded, needed).repartition(slot_count(coded.sparkSession), "_k").sortWithinPartitions("_k")
    return grouped.mapInArrow(lambda batches: _pairs(batches, needed), "a string, b string").select(F.col("a").alias(a), F.col("b").alias(b))


def candidates(left: DataFrame, right: DataFrame, a: str, b: str, grams_a: Column, grams_b: Column, least: float) -> DataFrame:
    """(a, b): each pair of names once, with all pairs whose grams have a Jaccard likeness of `least` (and few others)."""
    sides = _coded(left, a, grams_a, _LEFT).union(_coded(right, b, grams_b, _RIGHT))
    return _compared(sides.groupBy("_s", "_c").agg(F.bit_or("_side").alias("_side")).select("_s", "_side", "_c"), a, b, least)


def candidates_within(names: DataFrame, a: str, b: str, grams: Column, least: float) -> DataFrame:
    """The same for the names of one table, in column a, with a < b."""
    return _compared(_coded(names, a, grams, _LEFT | _RIGHT), a, b, least).where(F.col(a) < F.col(b))
