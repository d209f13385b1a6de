"""Encoding of whole texts with a public tokenizer, each distinct piece once per worker.

A text is cut at places where the tokenizer's own pre-tokenizer always cuts, so the ids of
the pieces, joined, are the ids of the text.  A block of texts is cut and its pieces are made distinct by
Arrow; only distinct pieces are looked up, and numpy lays their ids out again.  Pieces are encoded by the ``tokenizers``
library when first met and remembered; a worker's memory of them is bounded by ``CACHE`` pieces.
"""

from __future__ import annotations

import functools
import gc
import json
import os
import re
from array import array
from codecs import charmap_decode
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from typing import Any

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc

#: Most pieces that a worker remembers; beyond it those not in use are forgotten (results are the same).
CACHE = 1_200_000
#: Most bytes of texts that are encoded at once (a longer text is alone), and characters of a text that are cut into pieces at once.
BLOCK, STRETCH = 8 << 20, 1 << 22

#: White space other than blanks and line feeds.
_RARE = r"\t\x0B\x0C\r\x1C-\x1F\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}"
#: White space other than single blanks or line feeds between visible characters.
_ODD = f"[{_RARE}]|[ \\n][ \\n]|^[ \\n]|[ \\n]$"
_BORDER = re.compile(r"\S(?= \S)")
#: Letters below this one are letters to every version of Unicode and are not changed by composition.
_SETTLED = "ɐ"
MARKS = frozenset(".,;:!?")


def load(name: str):
    """The tokenizer of that file, without truncation or padding."""
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(public_tokenizers.path(name))
    tok.no_truncation()
    tok.no_padding()
    return tok


def model_of(name: str) -> dict:
    with open(public_tokenizers.path(name), encoding="utf-8") as f:
        return json.load(f)


def byte_letters() -> list[str]:
    """The letter that byte-level vocabularies write for each byte: printable ones stand for
    themselves, the others take code points from 256 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return [chr(b) if b in shown else chr(256 + hidden.index(b)) for b in range(256)]


_LETTERS = "".join(byte_letters())


@dataclass(frozen=True)
class Cut:
    """How a tokenizer's texts are cut: ``byte_level`` with the usual pattern (a word takes the blank before it), or
    ``words`` (white space is dropped, lower case).

    Pieces are strings that stand between blanks.  To a byte-level tokenizer one stands for itself with a blank before it or, if it begins
    with a line feed, for itself alone; a tuple holds a piece as it is, such as a text's first.
    """

    byte_level: bool

    def text(self, piece: str | tuple[str]) -> str:
        if type(piece) is tuple:
            return piece[0]
        return " " + piece if self.byte_level and piece[:1] != "\n" else piece

    def plain(self, piece: str) -> list[str] | None:
        """The pre-tokens, in the vocabulary's letters, of a piece of letters only, with a line feed before it or none; None for others."""
        if self.byte_level:
            if piece.isascii():
                return ["Ġ" + piece] if piece.isalpha() else ["Ċ", piece[1:]] if piece[:1] == "\n" and piece[1:].isalpha() else None
            lead, word = (["Ċ"], piece[1:]) if piece[0] == "\n" else ([], " " + piece)
        else:
            lead, word = [], piece.lower()
            if word.isascii():
                return [word] if word.isalpha() else None
        if not word.strip(" ").isalpha() or max(word) >= _SETTLED:
            return None
        return [*lead, charmap_decode(word.encode(), "strict", _LETTERS)[0]]


BYTE_LEVEL, WORDS = Cut(True), Cut(False)


def is_odd(text: str) -> bool:
    return pc.match_substring_regex(pa.array([text], pa.string()), _ODD)[0].as_py()


def stretches(text: str) -> Iterator[tuple[str, bool]]:
    """Parts of a text, divided at single blanks about every ``STRETCH`` characters, and whether each is its beginning."""
    at = 0
    while len(text) - at > 2 * STRETCH:
        m = _BORDER.search(text, at + STRETCH)
        if not m:
            break
        yield text[at : m.end()], at == 0
        at = m.end() + 1
    yield text[at:], at == 0


def odd_pieces(text: str) -> Iterator[tuple[str]]:
    """Pieces, as they are, of a text with odd white space: cut only where a single blank stands between two visible characters."""
    at = 0
    for m in _BORDER.finditer(text):
        yield (text[at : m.end()],)
        at = m.end()
    if at < len(text):
        yield (text[at:],)


@dataclass
class Pieces:
    """Pieces of a block of texts: the distinct ones, the number of each piece in order, and where each text begins.

    Every text has one piece at least.
    """

    distinct: list
    number: np.ndarray
    starts: np.ndarray

    @classmethod
    def of(cls, texts: pa.Array, cut: Cut, begins: np.ndarray | None = None) -> Pieces:
        """``texts`` have no null and, to a byte-level tokenizer, no odd white space; ``begins`` tells the beginnings of texts."""
        spaced = pc.replace_substring(texts, "\n", " \n" if cut.byte_level else " ")
        lists = pc.split_pattern(spaced, " ")
        coded = lists.flatten().dictionary_encode()
        distinct, number, starts = coded.dictionary.to_numpy(zero_copy_only=False).tolist(), coded.indices.to_numpy(), lists.offsets.to_numpy()[:-1].astype(np.int64)
        if cut.byte_level:  # a text's first piece has no blank before it
            number = number.copy()
            own = starts if begins is None else starts[begins]
            first = [(distinct[k],) for k in number[own].tolist()]
            number[own] = np.arange(len(distinct), len(distinct) + len(first))
            distinct += first
        return cls(distinct, number, starts)

    def sums(self, values: np.ndarray) -> np.ndarray:
        """For each text the sum of its pieces' values."""
        return np.add.reduceat(values[self.number], self.starts) if len(self.starts) else np.zeros(0, np.int64)


def sorted_out(texts: pa.Array, cut: Cut, special: list[str]) -> tuple[pa.Array, np.ndarray]:
    """The texts with nulls as empty ones, and which of them can be cut at blanks and line feeds just so."""
    texts = pc.fill_null(texts, "")
    plain = np.ones(len(texts), np.bool_)
    for s in special:
        plain &= ~pc.match_substring(texts, s).to_numpy(zero_copy_only=False)
    if cut.byte_level:
        plain &= ~pc.match_substring_regex(texts, _ODD).to_numpy(zero_copy_only=False)
    lengths = pc.binary_length(texts).to_numpy(zero_copy_only=False)
    return texts, plain & (lengths <= 2 * STRETCH)


class Known(dict):
    """Ids of pieces, learned when first asked for.  When ``most`` are held they become the older half
    of the memory, from which pieces in use return; the rest of that half is forgotten at the next turn."""

    def __init__(self, learn: Callable[[Any], bytes], most: int) -> None:
        super().__init__()
        self.learn, self.most, self.older = learn, most, {}

    def __missing__(self, piece: Any) -> bytes:
        ids = self.older.get(piece)
        if ids is None:
            ids = self.learn(piece)
        if len(self) >= self.most:
            self.older = dict(self)
            self.clear()
        self[piece] = ids
        return ids


class Encoder:
    """``encode(texts)``: the ids of all texts, and how many each has.

    Normaliser, pre-tokenizer and model are the library's; special strings become their ids, as its default is.
    """

    def __init__(self, name: str, cut: Cut, cache: int = CACHE) -> None:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark has a task for every core
        self.tok, self.cut = load(name), cut
        self.model, self.before, self.normal = self.tok.model.tokenize, self.tok.pre_tokenizer.pre_tokenize_str, self.tok.normalizer
        self.special = {t["content"]: t["id"] for t in model_of(name)["added_tokens"]}
        self.split = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")")
        self.known = Known(self._learn, max(1, cache // 2))

    def _learn(self, piece: Any) -> bytes:
        if type(piece) is str:
            words = self.cut.plain(piece) if piece else []
            if words is not None:
                return array("I", [t.id for w in words for t in self.model(w)]).tobytes()
            if piece[-1] in MARKS and len(piece) > 1 and self.cut.plain(piece[:-1]):
                return self.known[piece[:-1]] + array("I", [t.id for t in self.model(piece[-1])]).tobytes()
        text = self.cut.text(piece)
        text = self.normal.normalize_str(text) if self.normal else text
        return array("I", [t.id for w, _ in self.before(text) for t in self.model(w)] if text else []).tobytes()

    def _plain(self, texts: pa.Array, begins: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        own = Pieces.of(texts, self.cut, begins)
        held = list(map(self.known.__getitem__, own.distinct))
        sizes = np.fromiter(map(len, held), np.int64, len(held)) // 4
        flat = np.frombuffer(b"".join(held), "<u4")
        each = sizes[own.number]
        ends = np.cumsum(each)
        total = int(ends[-1]) if len(ends) else 0
        at = np.repeat((np.cumsum(sizes) - sizes)[own.number] - (ends - each), each) + np.arange(total)
        return flat[at], own.sums(sizes)

    def _other(self, text: str) -> np.ndarray:
        """The ids of one text with special strings, odd white space or great length."""
        out = []
        for k, part in enumerate(self.split.split(text)):
            if k % 2:
                out.append(np.array([self.special[part]], "<u4"))
                continue
            for stretch, begins in stretches(part):
                if self.cut.byte_level and is_odd(stretch):
                    whole = stretch if begins else " " + stretch
                    out.append(np.frombuffer(b"".join(map(self.known.__getitem__, odd_pieces(whole))), "<u4"))
                else:
                    out.append(self._plain(pa.array([stretch], pa.string()), np.array([begins]))[0])
        return np.concatenate(out)

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids, as unsigned 32-bit integers, and the number of each text's; a null text is empty."""
        texts, plain = sorted_out(texts, self.cut, list(self.special))
        if plain.all():
            return self._plain(texts)
        ids, sizes = self._plain(texts.filter(pa.array(plain)))
        others = [self._other(t) for t in texts.filter(pa.array(~plain)).to_pylist()]
        counts = np.zeros(len(texts), np.int64)
        counts[plain], counts[~plain] = sizes, [len(x) for x in others]
        own = np.repeat(plain, counts)
        out = np.zeros(len(own), "<u4")
        out[own], out[~own] = ids, np.concatenate(others)
        return out, counts


@functools.lru_cache(maxsize=2)
def encoder(name: str, words: bool) -> Encoder:
    """This worker's encoder: what it has learned serves its later tasks too."""
    return Encoder(name, WORDS if words else BYTE_LEVEL)


def forget() -> None:
    """Give back what this worker's encoders hold: for maps of other operators that run in the same worker later."""
    if encoder.cache_info().currsize:
        encoder.cache_clear()
        gc.collect()
        pa.default_memory_pool().release_unused()
