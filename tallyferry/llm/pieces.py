"""Texts cut where no token can reach across, and the tokenizer libraries' ids of the pieces.

A text is cut before every blank that stands between a non-blank and a character that is no white
space. The byte-level pre-tokenizer ends a word there, and a vocabulary of sentencepiece has no token
across it if no entry holds a word mark behind another character (:func:`marks_lead`). So the
libraries encode each distinct piece once per worker, whatever the number and length of the texts.
"""

from __future__ import annotations

import functools
import gc
import os
import re
from array import array
from collections.abc import Callable, Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from tallyferry.llm.bpe import WORDS, byte_signs

BLANK_BETWEEN = re.compile(r"(?<! ) (?=\S)")
WORDS_BETWEEN = re.compile(r"(?<=\w) (?=\w)")
OTHER_BLANK = re.compile(r" (?:\s|\Z)")
MARK = "▁"
END_SIGNS = {".", ",", ";", ":", "!", "?"}


def cut(text: str) -> list[str]:
    """The first piece, and all later ones without the blank before them."""
    return BLANK_BETWEEN.split(text) if OTHER_BLANK.search(text) else text.split(" ")


def cut_after_blank(text: str) -> list[str]:
    """The pieces of a blank and ``text``, each without the blank before it."""
    if text[:1].isspace():
        return [p[1:] if k == 0 else p for k, p in enumerate(BLANK_BETWEEN.split(" " + text))]
    return cut(text)


def segments(text: str, most: int = 1_000_000) -> Iterator[str]:
    """``text`` in parts of about ``most`` characters; the blank between two words at which it is cut is left out."""
    start = 0
    while len(text) - start > most and (m := WORDS_BETWEEN.search(text, start + most)):
        yield text[start : m.start()]
        start = m.end()
    yield text[start:]


def ids_bytes(ids: Iterable[int]) -> bytes:
    return array("I", ids).tobytes()


@functools.lru_cache(maxsize=4)
def byte_level(path: str, special_as_text: bool = False):
    """The tokenizer of a file, without truncation and padding."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    model = Tokenizer.from_file(path)
    model.no_truncation()
    model.no_padding()
    model.encode_special_tokens = special_as_text
    return model


@functools.lru_cache(maxsize=2)
def word_marked(path: str):
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=path)


def marks_lead(model) -> bool:
    """Whether no entry of a sentencepiece vocabulary holds a word mark behind another character."""
    return not any(MARK in model.id_to_piece(i).lstrip(MARK) for i in range(model.get_piece_size()))


class PieceCache:
    """Values by piece in two generations: at most ``most`` young ones and as many old ones; pieces of over ``longest`` characters are not kept."""

    def __init__(self, most: int, longest: int = 64) -> None:
        self.most, self.longest = most, longest
        self.young: dict = {}
        self.old: dict = {}

    def values(self, keys: list[str], make: Callable[[list[str]], Iterable], at_once: int = 20_000) -> list:
        """The values of ``keys``; ``make`` gives those that are lacking."""
        if len(self.young) >= self.most:
            self.old, self.young = self.young, {}
        young, old = self.young, self.old
        found = list(map(young.get, keys))
        gaps = [i for i, v in enumerate(found) if v is None]
        asked: dict = {}
        for i in gaps:
            k = keys[i]
            if (v := old.get(k)) is None:
                asked[k] = None
            else:
                young[k] = found[i] = v
        new = list(asked)
        for k in range(0, len(new), at_once):
            part = new[k : k + at_once]
            asked.update(zip(part, make(part), strict=True))
        young.update(asked if all(len(k) <= self.longest for k in new) else {k: v for k, v in asked.items() if len(k) <= self.longest})
        for i in gaps:
            if found[i] is None:
                found[i] = asked[keys[i]]
        return found


class PiecePool:
    """Ids by piece as Arrow columns: at most ``most`` pieces and those of one call; beyond that, pieces that one call alone has used go.

    Should more than half of ``most`` be left, only those of the last call stay.
    """

    def __init__(self, most: int) -> None:
        self.most = most
        self.pieces = pa.array([], pa.large_string())
        self.ids = pa.array([], pa.large_list(pa.uint32()))
        self.uses = np.zeros(0, np.int64)

    def places(self, pieces: pa.Array, make: Callable[[list[str]], tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
        """The place of each of ``pieces``; ``make`` gives the ids of those that are new, end to end, and how many each has."""
        at = pc.index_in(pieces, value_set=self.pieces)
        gaps = pc.is_null(at)
        places = pc.fill_null(at, 0).to_numpy().copy()
        new = pieces.filter(gaps).dictionary_encode()
        places[gaps.to_numpy(zero_copy_only=False)] = len(self.pieces) + new.indices.to_numpy()
        if len(new.dictionary):
            ids = listed(*make(new.dictionary.to_pylist()))
            self.pieces, self.ids = pa.concat_arrays([self.pieces, new.dictionary]), pa.concat_arrays([self.ids, ids])
        used = np.bincount(places, minlength=len(self.pieces)) > 0
        self.uses = used + np.pad(self.uses, (0, len(used) - len(self.uses)))
        if len(self.pieces) > self.most:
            kept = np.flatnonzero(used | (self.uses > 1))
            if len(kept) > self.most // 2:
                kept = np.flatnonzero(used)
            moved = np.zeros(len(self.pieces), places.dtype)
            moved[kept] = np.arange(len(kept))
            self.pieces, self.ids, places = self.pieces.take(pa.array(kept)), self.ids.take(pa.array(kept)), moved[places]
            self.uses = np.zeros(len(kept), np.int64) + used[kept]
        return places

    def joined(self, places: np.ndarray, heads: np.ndarray, own: tuple[np.ndarray, np.ndarray]) -> tuple[bytes, np.ndarray]:
        """The ids at ``places`` end to end, and how many each has; those at ``heads`` are given as ``own``."""
        places[heads] = len(self.ids) + np.arange(len(heads))
        found = pa.concat_arrays([self.ids, listed(*own)]).take(pa.array(places))
        return found.flatten().to_numpy().tobytes(), np.diff(found.offsets.to_numpy())


def listed(ids: np.ndarray, widths: np.ndarray) -> pa.Array:
    return pa.LargeListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(widths)))), pa.array(ids))


def token_bytes(model) -> dict[int, bytes]:
    """Each id's bytes in a byte-level vocabulary."""
    signs = byte_signs()
    special = {i: t.content.encode() for i, t in model.get_added_tokens_decoder().items()}
    return {i: special.get(i) or bytes(signs[c] for c in t) for t, i in model.get_vocab().items()}


def words_after_blank(piece: str) -> Sequence[str]:
    """The words of the byte-level pattern in a blank and ``piece``."""
    if piece.isalpha():  # letters are one word, a point or comma behind them another
        return (" " + piece,)
    if piece[-1:] in END_SIGNS and piece[:-1].isalpha():
        return (" " + piece[:-1], piece[-1])
    return WORDS.findall(" " + piece)


class PieceEncoder:
    """The ids that the library gives whole texts, as little-endian unsigned 32-bit integers.

    Pieces are split by the vocabulary's own pattern; the library's model encodes the distinct words that are new to
    the worker, many in one call, and they are told apart by the lengths of their bytes. Without ``plain``
    special strings inside texts are special tokens, as is the library's default.
    """

    def __init__(self, path: str, cache_entries: int = 300_000, plain: bool = False) -> None:
        from tokenizers import Tokenizer

        self.model = byte_level(path, plain)
        self.bare = Tokenizer(self.model.model)
        self.signs = str.maketrans({chr(b): c for c, b in byte_signs().items()})
        self.bytes_of = token_bytes(self.model)
        self.widths = np.zeros(max(self.bytes_of) + 1, np.int64)
        for i, b in self.bytes_of.items():
            self.widths[i] = len(b)
        self.special = [] if plain else [t.content for t in self.model.get_added_tokens_decoder().values()]
        self.words = PieceCache(cache_entries)
        self.known = PiecePool(2 * cache_entries)

    def encode_words(self, words: list[str]) -> list[bytes]:
        """The ids of words of the pattern, each on its own."""
        laid = "".join(words).encode().decode("latin-1").translate(self.signs)
        ends = np.cumsum([len(w) if w.isascii() else len(w.encode()) for w in words])
        cuts = [0, *ends.tolist()]
        ids = np.array(self.bare.encode_batch_fast([[laid[a:b] for a, b in zip(cuts, cuts[1:], strict=False)]], is_pretokenized=True, add_special_tokens=False)[0].ids, "<u4")
        bounds = [0, *(4 * (np.searchsorted(np.cumsum(self.widths[ids]), ends) + 1)).tolist()]
        coded = ids.tobytes()
        return [coded[a:b] for a, b in zip(bounds, bounds[1:], strict=False)]

    def pooled(self, split: list[Sequence[str]]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of pieces (given as lists of words) end to end, and how many each has."""
        values = self.words.values([w for own in split for w in own], self.encode_words, 2000)
        lengths = np.fromiter(map(len, values), np.int64, len(values)) // 4
        last = np.cumsum([len(own) for own in split])
        upto = np.concatenate(([0], np.cumsum(lengths)))[np.concatenate(([0], last))]
        return np.frombuffer(b"".join(values), "<u4"), np.diff(upto)

    def together(self, pieces: list[str]) -> list[bytes]:
        """The ids of each piece after a blank."""
        ids, widths = self.pooled([words_after_blank(p) for p in pieces])
        bounds, coded = [0, *(4 * np.cumsum(widths)).tolist()], ids.tobytes()
        return [coded[a:b] for a, b in zip(bounds, bounds[1:], strict=False)]

    def encode(self, texts: list[str]) -> list[bytes]:
        out: list[bytes] = [b""] * len(texts)
        # a special token ends the white space before it: such texts go to the library as they are
        special = [i for i, t in enumerate(texts) if any(s in t for s in self.special)]
        if special:
            for i, e in zip(special, self.model.encode_batch_fast([texts[i] for i in special], add_special_tokens=False), strict=True):
                out[i] = ids_bytes(e.ids)
        rest = sorted({*range(len(texts))} - {*special})
        odd = [i for i in rest if OTHER_BLANK.search(texts[i])]
        for i in odd:
            first, *later = BLANK_BETWEEN.split(texts[i])
            out[i] = self.pooled([WORDS.findall(first), *map(words_after_blank, later)])[0].tobytes()
        plain = sorted({*rest} - {*odd})
        for i, ids in zip(plain, self._at_each_blank([texts[i] for i in plain]), strict=True):
            out[i] = ids
        return out

    def _at_each_blank(self, texts: list[str]) -> Iterator[bytes]:
        """The ids of texts whose every blank is a cut: split, looked up and put together as Arrow columns."""
        if not texts:
            return
        split = pc.split_pattern(pa.array(texts, pa.large_string()), " ")
        offsets = split.offsets.to_numpy()
        used = self.known.places(split.flatten(), lambda new: self.pooled([*map(words_after_blank, new)]))
        # a text's first piece has no blank before it
        heads = self.pooled([WORDS.findall(t[: t.index(" ")] if " " in t else t) for t in texts])
        first = offsets[:-1]
        coded, widths = self.known.joined(used, first, heads)
        bounds = [0, *(4 * np.cumsum(widths)[offsets[1:] - 1]).tolist()]
        for a, b in zip(bounds, bounds[1:], strict=False):
            yield coded[a:b]

    def parts(self, texts: list[str], most: int = 1_000_000) -> Iterator[tuple[int, bytes]]:
        """Index and ids of each text in turn; those of a long text come in several parts."""
        coded = self.encode([t if len(t) <= most else "" for t in texts])
        for i, text in enumerate(texts):
            if len(text) <= most:
                yield i, coded[i]
            else:
                for k, part in enumerate(segments(text, most)):
                    yield i, self.encode([" " + part if k else part])[0]


@functools.lru_cache(maxsize=2)
def encoder_of(path: str) -> PieceEncoder:
    """One encoder for all tasks of a Python worker; its caches hold no cycles, so collections pass them by."""
    encoder = PieceEncoder(path)
    gc.freeze()
    return encoder
