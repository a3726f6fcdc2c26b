"""Periodic runs of words, found with a run-length grammar made by recompression.

A run with period q and four periods or more meets at least four multiples of q, and the words there are
the same. So for each q only the multiples of q (a harmonic grid: n/1 + n/2 + ... places) are compared, four equal
words in a row are a candidate, and the run's exact bounds are the longest common extensions of two
places q apart, to the right and to the left.

Extensions are answered by a grammar of the words and one of the words in reverse. Recompression
builds it level by level: first every stretch of one symbol becomes a block symbol, then pairs of a
left and a right symbol, told apart by a hash, become pair symbols. Equal stretches are parsed
equally but for a few symbols at their ends, so an extension climbs the levels while symbols agree and
comes down where they differ: a few steps a level, no suffix array. Many are answered together, as arrays.

A batch of texts is one sequence with a separator of its own after each text. Runs with a multiple of
their smallest period have the same bounds, so the first period that gives bounds is the smallest. Places inside a run
whose period divides q cannot give others and are left out.

Defined results: a null, empty or blank text has no runs, and nulls and the digest of nothing; ids may
be repeated or null (a null id's words are never replaced); repeated rows each give a row; an empty table gives no rows; extra
columns are ignored. Very long texts are one sequence each; memory is a few numbers for each of its
words. The one pass over the table shuffles nothing; a lost executor repeats its own partitions.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyferry.llm.bpe import blocks_of
from tallyferry.llm.shared import in_python, text_or_empty


def mixed(symbols: np.ndarray, level: int) -> np.ndarray:
    """A hash bit of each symbol, another one at each level."""
    x = (symbols.astype(np.uint64) + np.uint64(level + 1)) * np.uint64(0x9E3779B97F4A7C15)
    x ^= x >> np.uint64(29)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    return (x >> np.uint64(60)) & np.uint64(1) == 1


class Level:
    """Symbols of one level and the places of their first children in the level below."""

    def __init__(self, symbols: np.ndarray, first: np.ndarray) -> None:
        self.symbols, self.first = symbols, first
        self.parents = self.rest = None  # places in the level above; symbols left in the block, where that holds blocks


class Grammar:
    """Run-length grammar of a sequence whose last symbol occurs once."""

    def __init__(self, sequence: np.ndarray, least: int = 32) -> None:
        sequence = sequence.astype(np.int32)
        self.levels = [Level(sequence, np.arange(len(sequence), dtype=np.int32))]
        fresh, flat = int(sequence.max()) + 1, 0
        while len(sequence) > least and flat < 8:
            n = len(sequence)
            for pairs in (False, True):
                symbols, first, fresh = self._joined(sequence, pairs, fresh)
                if len(symbols) == len(sequence):
                    continue
                starts = np.zeros(len(sequence), np.int32)
                starts[first[1:]] = 1
                below = self.levels[-1]
                below.parents = np.cumsum(starts, dtype=np.int32)
                if not pairs:
                    below.rest = np.append(first[1:], np.int32(len(sequence)))[below.parents] - np.arange(len(sequence), dtype=np.int32)
                self.levels.append(Level(symbols, first))
                sequence = symbols
            flat = flat + 1 if len(sequence) == n else 0  # no pair fell on the two sides: other bits next time

    def _joined(self, s: np.ndarray, pairs: bool, fresh: int) -> tuple[np.ndarray, np.ndarray, int]:
        """The next level: blocks of one symbol, or pairs of a left and a right symbol."""
        inside = np.zeros(len(s), bool)
        if pairs:
            right = mixed(s, len(self.levels))
            inside[1:] = right[1:] & ~right[:-1]
        else:
            inside[1:] = s[1:] == s[:-1]
        first = np.flatnonzero(~inside).astype(np.int32)
        widths = np.diff(np.append(first, np.int32(len(s))))
        symbols = s[first].copy()
        many = np.flatnonzero(widths > 1)
        if len(many):
            mate = s[first[many] + 1] if pairs else widths[many]
            # symbols and lengths stay below 2^31: a sequence has fewer places, and all levels together few times as many symbols
            names, named = np.unique(symbols[many].astype(np.int64) << 32 | mate, return_inverse=True)
            symbols[many] = fresh + named
            fresh += len(names)
        return symbols, first, fresh

    def common(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Length of the longest common extension to the right of places ``a`` < ``b``."""
        start, last = a.copy(), len(self.levels) - 1
        a, b = a.copy(), b.copy()
        top = np.full(len(a), -1)  # the level at which a query met a difference
        rising = np.arange(len(a))
        for k in range(last + 1):
            rising = self._agree(k, a, b, rising, top, k < last)
            if k < last:
                a[rising], b[rising] = self.levels[k].parents[a[rising]], self.levels[k].parents[b[rising]]
        for k in range(last, 0, -1):
            here = np.flatnonzero(top == k)
            a[here], b[here] = self.levels[k].first[a[here]], self.levels[k].first[b[here]]
            top[here] = -1
            self._agree(k - 1, a, b, here, top, False)
        return a - start

    def _agree(self, k: int, a: np.ndarray, b: np.ndarray, queries: np.ndarray, top: np.ndarray, climb: bool) -> np.ndarray:
        """Step over equal symbols of level k until a difference (noted in ``top``) or, to climb, the starts of two parents."""
        s, rest, done = self.levels[k].symbols, self.levels[k].rest, []
        if climb:
            parents, first = self.levels[k].parents, self.levels[k + 1].first
        while len(queries):
            if climb:
                at_start = (first[parents[a[queries]]] == a[queries]) & (first[parents[b[queries]]] == b[queries])
                done.append(queries[at_start])
                queries = queries[~at_start]
            same = s[a[queries]] == s[b[queries]]
            top[queries[~same]] = k
            queries = queries[same]
            # two blocks of one symbol agree as far as the shorter goes
            step = 1 if rest is None else np.minimum(rest[a[queries]], rest[b[queries]])
            a[queries], b[queries] = a[queries] + step, b[queries] + step
        return np.concatenate(done) if done else queries


def find_runs(words: np.ndarray, lengths: np.ndarray, least_exponent: int = 4, least_length: int = 6) -> list[tuple[int, int, int]]:
    """All runs (start, length, period) of sequences laid end to end; no run crosses from one to the next.

    ``words`` holds non-negative integers.
    """
    n = len(lengths)
    ends = np.cumsum(lengths)
    sequence = np.insert(words, ends, int(words.max(initial=0)) + 1 + np.arange(n)) if n else words
    total = len(sequence)
    inside = np.zeros(total, np.int64)  # the end of a known run with this place, and its period
    period = np.ones(total, np.int64)
    found: dict[tuple[int, int], int] = {}
    right = left = None
    for q in range(1, int(lengths.max(initial=0)) // least_exponent + 1):
        grid = sequence[::q]
        same = grid[1:] == grid[:-1]
        at = q * np.flatnonzero(same[:-2] & same[1:-1] & same[2:])
        if len(at):
            at = at[(inside[at] <= at + 3 * q) | (q % period[at] != 0)]
        if not len(at):
            continue
        if right is None:
            right, left = Grammar(sequence), Grammar(np.append(sequence[::-1], int(sequence.max()) + 1))
        after = right.common(at, at + q)
        before = left.common(total - at - q, total - at)
        starts, stops = at - before, at + q + after
        long = stops - starts >= max(least_length, least_exponent * q)
        for start, stop in sorted({*zip(starts[long].tolist(), stops[long].tolist(), strict=True)}):
            if (start, stop) not in found:
                found[start, stop] = q
                inside[start:stop], period[start:stop] = stop, q
    return sorted((start, stop - start, q) for (start, stop), q in found.items())


def planted(words: list[bytes], doc_id) -> list[bytes]:
    """The words of a document, made periodic from a place on for one id in ten."""
    h = zlib.crc32(str(doc_id).encode())
    n, g = len(words), h // 10
    if doc_id is None or h % 10 or not n:
        return words
    a = g % n
    unit = words[a : a + 1 + (n - a) // (3 + g % 8)]
    return words[:a] + (unit * (-(-(n - a) // len(unit))))[: n - a]


def sha(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


def row_of(words: list[bytes], runs: list[tuple[int, int, int]]) -> tuple:
    """n_runs, the run of the greatest exponent, and the digests of a document."""
    if not runs:
        return 0, None, None, None, None, sha(b""), sha(b" ".join(words))
    best = runs[0]
    for run in runs[1:]:
        if run[1] * best[2] > best[1] * run[2]:  # exact; ties stay with the earlier start, then the shorter period
            best = run
    drop = np.zeros(len(words) + 1, np.int64)
    for start, length, q in runs:
        drop[start + q] += 1
        drop[start + length] -= 1
    kept = np.flatnonzero(np.cumsum(drop[:-1]) == 0)
    lines = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
    return len(runs), *best, 1000 * best[1] // best[2], sha(lines.encode()), sha(b" ".join([words[k] for k in kept.tolist()]))


COLUMNS = "n_runs long, start long, length long, period long, exponent_milli long, runs_sha256 string, collapsed_sha256 string"
TYPES = [pa.int64()] * 5 + [pa.string()] * 2


def rows_of(ids: list, texts: list[str], plant: bool) -> list[tuple]:
    docs = [planted(t.encode().split(), i) if plant else t.encode().split() for i, t in zip(ids, texts, strict=True)]
    known: dict[bytes, int] = {}
    for words in docs:
        for w in set(words):
            known.setdefault(w, len(known))
    lengths = np.array([len(words) for words in docs], np.int64)
    coded = np.fromiter((known[w] for words in docs for w in words), np.int64, int(lengths.sum()))
    starts = np.cumsum(lengths + 1) - lengths - 1  # each with a separator behind it
    runs: list[list] = [[] for _ in docs]
    for start, length, q in find_runs(coded, lengths):
        doc = int(np.searchsorted(starts, start, "right")) - 1
        runs[doc].append((start - int(starts[doc]), length, q))
    return [row_of(words, own) for words, own in zip(docs, runs, strict=True)]


def word_runs(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", plant: bool = False, batch_bytes: int = 2_000_000) -> DataFrame:
    """One row per document: its runs of words in digests, its run of the greatest exponent, and its text without repeats.

    With ``plant`` one document in ten is made periodic first, by its id.
    """
    rows = docs.select(F.col(doc_id).alias("doc_id"), text_or_empty(text).alias("text"))
    id_type = rows.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1)
            for a, b in blocks_of(texts, batch_bytes):
                ids = batch.column(0).slice(a, b - a)
                out = zip(*rows_of(ids.to_pylist(), texts.slice(a, b - a).to_pylist(), plant), strict=True)
                columns = [ids, *[pa.array(c, t) for c, t in zip(out, TYPES, strict=True)]]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", *[c.split()[0] for c in COLUMNS.split(", ")]])

    return in_python(rows, run, f"doc_id {id_type}, {COLUMNS}")
