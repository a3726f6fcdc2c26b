"""Byte-level BPE encoding and decoding with a pair occurrence index.

Every partition gathers the distinct words of a block of texts, lays their bytes out in one
sequence, and indexes each mergeable pair to all its positions. Ranks are applied in ascending
order: a merge rewrites all positions of its pair and enters the pairs that this makes into the
index. A frequent pair's positions are rewritten together, as arrays. A later merge never has a lower rank than the pair that made it possible, so the order over
all words at once gives each word what it would get alone. Finished pieces and words are kept in two
generations of bounded size each, which all tasks of a Python worker share: a full younger one becomes
the older, and what is met again moves up, so frequent pieces stay and memory does not grow.

Texts are cut before every blank that is followed by a non-blank: there every word of the
tokenizer's pattern ends, so pieces can be encoded on their own, whatever the text's length.

The output has one row per row of the input. A null text counts as empty and gives no tokens; ids
may be null or repeated; an empty table gives no rows; only the id and text columns are read. The
one shuffle-free pass reads the table once; a lost executor repeats its own partitions.
"""

from __future__ import annotations

import functools
import hashlib
import heapq
import json
import re
from array import array
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyferry.llm.shared import in_python

#: Fixed pattern of the byte-level pre-tokenizer.
WORDS = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
ODD_BLANK = re.compile(r" (?:\s|\Z)")
CUT = re.compile(r" (?=\S)")


def byte_signs() -> dict[str, int]:
    """Printable sign -> byte: printable Latin-1 bytes stand for themselves, others from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(others)}


class Generations:
    """Values by key: at most ``most`` young ones and as many old ones."""

    def __init__(self, most: int) -> None:
        self.most = most
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def age(self) -> None:
        if len(self.young) >= self.most:
            self.old, self.young = self.young, {}

    def missing(self, keys: Iterable[str]) -> list[str]:
        """The keys without a value; those that only the old generation has move up."""
        young, old, out = self.young, self.old, []
        for k in keys:
            if k not in young:
                if (v := old.get(k)) is None:
                    out.append(k)
                else:
                    young[k] = v
        return out


class PairIndexCodec:
    """Encoder and decoder for one vocabulary file; texts in, little-endian 32-bit ids out."""

    def __init__(self, path: str, cache_entries: int = 50_000, block_words: int = 50_000) -> None:
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        signs = byte_signs()
        vocab = spec["model"]["vocab"]
        self.bytes_of = {i: bytes(signs[c] for c in t) for t, i in vocab.items()}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.bytes_of |= {i: t.encode() for t, i in self.special.items()}
        self.find_special = re.compile("|".join(map(re.escape, sorted(self.special, key=len, reverse=True)))) if self.special else None
        self.byte_id = [0] * 256
        for c, b in signs.items():
            self.byte_id[b] = vocab[c]
        self.rank, self.merges = {}, []
        for pair in spec["model"]["merges"]:
            a, b = pair.split(" ") if isinstance(pair, str) else pair
            left, right = vocab[a], vocab[b]
            self.rank[left << 32 | right] = len(self.merges)
            self.merges.append((left, right, vocab[a + b]))
        keys = np.fromiter(self.rank, np.int64, len(self.rank))
        order = np.argsort(keys)
        self.pair_keys, self.pair_ranks = keys[order], np.fromiter(self.rank.values(), np.int64, len(keys))[order]
        self.byte_ids = np.array([*self.byte_id, -1], np.int64)
        # rank of each pair of bytes; row and column 256 stand for the end of a word
        self.byte_rank = np.full((257, 257), -1, np.int64)
        for a in range(256):
            for b in range(256):
                self.byte_rank[a, b] = self.rank.get(self.byte_id[a] << 32 | self.byte_id[b], -1)
        self.pieces, self.words = Generations(cache_entries), Generations(cache_entries)
        self.block_words = block_words

    def _merge_block(self, words: list[str]) -> list[bytes]:
        """The ids of each word, by the pair occurrence index over all of them."""
        rank, merges = self.rank, self.merges
        coded = [w.encode() for w in words]
        lengths = np.array([len(w) + 1 for w in coded], np.int64)
        ends = np.cumsum(lengths)
        starts = (ends - lengths).tolist()
        laid = np.frombuffer(b"\0".join([*coded, b""]), np.uint8).astype(np.int64)
        laid[ends - 1] = 256
        tokens = self.byte_ids[laid]
        nexts, lasts = np.arange(1, len(tokens) + 1), np.arange(-1, len(tokens) - 1)
        # the same memory, read and written one by one
        ids, after, before = memoryview(tokens), memoryview(nexts), memoryview(lasts)
        ranks = self.byte_rank[laid[:-1], laid[1:]]
        at = np.nonzero(ranks >= 0)[0]
        at = at[np.argsort(ranks[at], kind="stable")]
        firsts, edges = np.unique(ranks[at], return_index=True)
        where: dict[int, list[int]] = dict(zip(firsts.tolist(), (x.tolist() for x in np.split(at, edges[1:])), strict=False))
        active = list(where)
        heapq.heapify(active)
        while active:
            r = heapq.heappop(active)
            left, right, new = merges[r]
            places = where.pop(r)
            if len(places) >= 48 and left != right:
                for q, found in self._merge_places(np.array(places), r, tokens, nexts, lasts):
                    if q in where:
                        where[q] += found
                    else:
                        where[q] = found
                        heapq.heappush(active, q)
                continue
            for i in sorted(places):
                j = after[i]
                if ids[i] != left or ids[j] != right:
                    continue
                ids[i], ids[j] = new, -2
                k, p = after[j], before[i]
                after[i], before[k] = k, i
                for q, at in ((rank.get(ids[p] << 32 | new) if ids[p] >= 0 else None, p), (rank.get(new << 32 | ids[k]) if ids[k] >= 0 else None, i)):
                    if q is None:
                        continue
                    if q in where:
                        where[q].append(at)
                    else:
                        where[q] = [at]
                        heapq.heappush(active, q)
        ids, after = tokens.tolist(), nexts.tolist()
        out = []
        for i in starts:
            own = array("I")
            while ids[i] >= 0:
                own.append(ids[i])
                i = after[i]
            out.append(own.tobytes())
        return out

    def _merge_places(self, at: np.ndarray, r: int, ids: np.ndarray, after: np.ndarray, before: np.ndarray) -> Iterator[tuple[int, list[int]]]:
        """Merge all places of a pair of two different tokens, which cannot overlap; the new pairs' ranks and places."""
        left, right, new = self.merges[r]
        j = after[at]
        real = (ids[at] == left) & (ids[j] == right)
        at, j = at[real], j[real]
        k = after[j]
        ids[at], ids[j] = new, -2
        after[at], before[k] = k, at
        p = before[at]
        own, then = ids[p], ids[k]
        # a new token before a new token is found from the second one's side
        has_left, has_right = own >= 0, (then >= 0) & (then != new)
        keys = np.concatenate((own[has_left] << 32 | new, new << 32 | then[has_right]))
        places = np.concatenate((p[has_left], at[has_right]))
        slot = np.minimum(np.searchsorted(self.pair_keys, keys), len(self.pair_keys) - 1)
        known = self.pair_keys[slot] == keys
        ranks, places = self.pair_ranks[slot[known]], places[known]
        order = np.argsort(ranks, kind="stable")
        firsts, edges = np.unique(ranks[order], return_index=True)
        places, bounds = places[order].tolist(), [*edges.tolist(), len(order)]
        for n, q in enumerate(firsts.tolist()):
            yield q, places[bounds[n] : bounds[n + 1]]

    def _learn(self, pieces: Iterable[str]) -> None:
        """Encode the pieces that are not known yet."""
        split = {p: WORDS.findall(p) for p in pieces}
        self.words.age()
        known = self.words.young
        words = self.words.missing(dict.fromkeys(w for ws in split.values() for w in ws))
        for k in range(0, len(words), self.block_words):
            block = words[k : k + self.block_words]
            known.update(zip(block, self._merge_block(block), strict=True))
        done = self.pieces.young
        for p, ws in split.items():
            done[p] = known[ws[0]] if len(ws) == 1 else b"".join([known[w] for w in ws])

    @staticmethod
    def _cut(text: str) -> list[str]:
        parts = CUT.split(text) if ODD_BLANK.search(text) else text.split(" ")
        return [parts[0], *[" " + p for p in parts[1:]]]

    def encode_batch(self, texts: list[str]) -> list[bytes]:
        segments: list[list[str]] = []
        breaks: list[list[tuple[int, bytes]]] = []  # special tokens: how many pieces come before, ids
        for text in texts:
            own: list[str] = []
            special = []
            at = 0
            if self.find_special is not None and any(s in text for s in self.special):
                for m in self.find_special.finditer(text):
                    own += self._cut(text[at : m.start()])
                    special.append((len(own), array("I", [self.special[m[0]]]).tobytes()))
                    at = m.end()
            segments.append(own + self._cut(text[at:]))
            breaks.append(special)
        self.pieces.age()
        self._learn(self.pieces.missing(set().union(*segments)))
        known = self.pieces.young.__getitem__
        out = []
        for own, special in zip(segments, breaks, strict=True):
            coded = list(map(known, own))
            for k, ids in reversed(special):
                coded.insert(k, ids)
            out.append(b"".join(coded))
        return out

    def decode(self, ids: bytes) -> str:
        return b"".join(map(self.bytes_of.__getitem__, memoryview(ids).cast("I").tolist())).decode("utf-8", errors="replace")


@functools.lru_cache(maxsize=2)
def codec_of(path: str) -> PairIndexCodec:
    """One codec for all tasks of a Python worker."""
    return PairIndexCodec(path)


def blocks_of(texts: pa.Array, max_bytes: int = 1_000_000) -> Iterator[tuple[int, int]]:
    """Ranges of rows of about ``max_bytes`` of text."""
    start = held = 0
    for i, n in enumerate(pc.binary_length(texts).to_pylist()):
        held += n or 0
        if held >= max_bytes:
            yield start, i + 1
            start, held = i + 1, 0
    if start < len(texts):
        yield start, len(texts)


def bpe_round_trip(docs: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text", with_ids: bool = False) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256, and with ``with_ids`` ids and decoded."""
    fields = [pa.field("n_tokens", pa.int64()), pa.field("ids_sha256", pa.string()), pa.field("decoded_sha256", pa.string())]
    slim = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    id_type = slim.schema["doc_id"].dataType.simpleString()
    more = ", ids array<int>, decoded string" if with_ids else ""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = codec_of(path)
        for batch in batches:
            texts = batch.column(1)
            for a, b in blocks_of(texts):
                encoded = codec.encode_batch(texts.slice(a, b - a).to_pylist())
                decoded = [codec.decode(ids) for ids in encoded]
                columns = [batch.column(0).slice(a, b - a), pa.array([len(ids) // 4 for ids in encoded], pa.int64())]
                columns += [pa.array([hashlib.sha256(ids).hexdigest() for ids in encoded]), pa.array([hashlib.sha256(d.encode()).hexdigest() for d in decoded])]
                if with_ids:
                    columns += [pa.array([memoryview(ids).cast("i").tolist() for ids in encoded], pa.list_(pa.int32())), pa.array(decoded)]
                names = ["doc_id", *[f.name for f in fields], *(["ids", "decoded"] if with_ids else [])]
                yield pa.RecordBatch.from_arrays(columns, names=names)

    return in_python(slim, encode, f"doc_id {id_type}, n_tokens long, ids_sha256 string, decoded_sha256 string{more}")
