"""Token ids of whole texts by the tokenizers library, with a bounded cache of pieces.

A text is cut where every pre-tokenizer of these vocabularies cuts as well, so the
ids of the pieces, put together, are the ids of the text. Most pieces repeat, and a
piece that was seen before is not encoded again. A text with special-token strings
or with white space beyond ASCII is encoded in one go. Where many texts come at
once, they are cut by array arithmetic on their bytes, and each of their pieces is
looked up once for all its occurrences.
"""

from __future__ import annotations

import os
import re
import sys
from array import array
from collections.abc import Callable, Iterable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa

CACHE_PIECES = 500_000
LONGEST_CACHED = 64
GROUP_CHARACTERS = 1 << 21

_LETTERS = "A-Za-zÀ-ÖØ-öø-ÿ"
_BLANK = " \t\n\r\x0b\x0c"
# A run of letters with its one leading blank, if a character follows that no
# pre-token can share with letters; closing punctuation before a blank; a line
# break before a letter; else all up to the next blank.
_PIECES = re.compile(
    rf" ?[{_LETTERS}]+(?=[ \n.,;:!?|*$%#&]|\Z)"
    rf"|[.,;:!?]+(?=[ \n]|\Z)"
    rf"|\n(?=[{_LETTERS}])"
    rf"|[{_BLANK}]*[^{_BLANK}]+"
    rf"|[{_BLANK}]+"
)
_WORD = re.compile(rf" ?[{_LETTERS}]+")
_ODD_BLANKS = re.compile("[\x1c-\x1f\x85\xa0\u1680\u180e\u2000-\u200f\u2028\u2029\u202f\u205f\u3000\ufeff]")

# What a byte of UTF-8 can be for a cut, as bits.
_SPACE, _NO_CUT, _LETTER, _CLOSING, _BREAK, _VISIBLE, _LATIN, _LATIN_REST = (1 << k for k in range(8))


def _byte_kinds() -> bytes:
    kinds = np.zeros(256, dtype=np.uint8)

    def mark(kind: int, members: Iterable[int]) -> None:
        kinds[list(members)] |= kind

    mark(_SPACE, b" ")
    # White space, and all bytes that white space beyond ASCII starts with.
    mark(_NO_CUT, [*range(0x21), 0xC2, 0xE1, 0xE2, 0xE3, 0xEF])
    mark(_LETTER, [*range(0x41, 0x5B), *range(0x61, 0x7B)])
    mark(_CLOSING, b".,;:!?|*$%#&\n")
    mark(_BREAK, b"\n")
    mark(_VISIBLE, range(0x21, 0x7F))
    mark(_LATIN, [0xC3])  # À to ÿ without × and ÷
    mark(_LATIN_REST, {*range(0x80, 0xC0)} - {0x97, 0xB7})
    return kinds.tobytes()


_KINDS = _byte_kinds()


def _cuts(raw: bytes) -> np.ndarray:
    """For each byte, whether a piece starts there: at a blank before something
    visible, at closing punctuation or a line break after a letter, and at a letter
    after a lone line break."""
    kinds = np.frombuffer(raw.translate(_KINDS), dtype=np.uint8)
    cut = np.zeros(len(kinds), dtype=bool)
    cut[:-1] = (kinds[:-1] & _SPACE) > (kinds[1:] & _NO_CUT)
    word = kinds & _LETTER
    word[1:] |= (kinds[:-1] & _LATIN) & ((kinds[1:] & _LATIN_REST) >> 1)
    cut[1:] |= (word[:-1] != 0) & (kinds[1:] & _CLOSING != 0)
    cut[2:] |= (
        (kinds[2:] & _LETTER != 0) & (kinds[1:-1] & _BREAK != 0) & (kinds[:-2] & _VISIBLE != 0)
    )
    return cut


class TextEncoder:
    """Encodes texts to little-endian unsigned 32-bit ids."""

    def __init__(self, vocabulary: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(vocabulary)
        self._encode = tokenizer.encode
        self._special = [t.content for t in tokenizer.get_added_tokens_decoder().values()]
        self._cache = _Cache(tokenizer)
        self._pieces = _Pieces(self._cache.worked_out)

    def encode(self, text: str) -> bytes:
        if _ODD_BLANKS.search(text) or any(token in text for token in self._special):
            return self._whole(text)
        cache = self._cache
        return b"".join([cache[piece] for piece in _PIECES.findall(text)])

    def encode_all(self, texts: Iterable[str]) -> Iterator[np.ndarray]:
        """The ids of each text in turn, worked out for groups of texts."""
        group: list[str] = []
        characters = 0
        for text in texts:
            group.append(text)
            characters += len(text) + 1
            if characters >= GROUP_CHARACTERS:
                yield from self._encode_group(group)
                group, characters = [], 0
        if group:
            yield from self._encode_group(group)

    def _encode_group(self, texts: list[str]) -> Iterator[np.ndarray]:
        special = [any(token in text for token in self._special) for text in texts]
        raw = [b"" if odd else text.encode() for text, odd in zip(texts, special)]
        ends = np.cumsum([len(r) + 1 for r in raw]) - 1  # a line break stands after each text
        joined = b"\n".join([*raw, b""])
        cut = _cuts(joined)
        cut[0] = cut[ends] = cut[ends[:-1] + 1] = True
        at = np.append(np.flatnonzero(cut), len(joined)).astype(np.int32)
        pieces = pa.StringArray.from_buffers(
            len(at) - 1, pa.py_buffer(at), pa.py_buffer(joined)
        ).dictionary_encode()
        ids = self._pieces.ids(pieces.dictionary.to_numpy(zero_copy_only=False))
        which = pieces.indices.to_numpy().copy()
        breaks = np.searchsorted(at, ends)
        which[breaks] = len(ids)
        ids.append(b"")

        sizes = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
        starts = np.cumsum(sizes) - sizes
        n = sizes[which]
        until = np.cumsum(n)
        source = np.repeat(starts[which] - until + n, n) + np.arange(until[-1])
        found = np.frombuffer(b"".join(ids), dtype="<u4")[source]
        for text, odd, own in zip(texts, special, np.split(found, until[breaks][:-1])):
            yield np.frombuffer(self._whole(text), dtype="<u4") if odd else own

    def _whole(self, text: str) -> bytes:
        return _packed(self._encode(text, add_special_tokens=False).ids)


class _Cache(dict):
    """Ids by piece. A plain word goes straight to the vocabulary's merges."""

    def __init__(self, tokenizer):
        self._encode = tokenizer.encode
        self._merge = tokenizer.model.tokenize
        self._letters = str.maketrans(_as_merges_see_it(tokenizer))

    def __missing__(self, piece: str) -> bytes:
        ids = self.worked_out(piece)
        if len(piece) <= LONGEST_CACHED:
            if len(self) >= CACHE_PIECES:
                self.clear()
            self[piece] = ids
        return ids

    def worked_out(self, piece: str) -> bytes:
        if _WORD.fullmatch(piece):
            return _packed([token.id for token in self._merge(piece.translate(self._letters))])
        return _packed(self._encode(piece, add_special_tokens=False).ids)


class _Pieces:
    """Ids of many pieces at once. What was seen is kept for two generations, so that
    a piece in use outlives the rare ones."""

    def __init__(self, worked_out: Callable[[str], bytes]):
        self._worked_out = worked_out
        self._young: dict[str, bytes] = {}
        self._old: dict[str, bytes] = {}

    def ids(self, pieces: Iterable[str]) -> list[bytes]:
        if len(self._young) >= CACHE_PIECES // 2:
            self._old, self._young = self._young, {}
        young, old = self._young, self._old
        found = list(map(young.get, pieces))
        for k, piece in enumerate(pieces):
            if found[k] is None:
                ids = old.get(piece)
                found[k] = ids = self._worked_out(piece) if ids is None else ids
                if len(piece) <= LONGEST_CACHED:
                    young[piece] = ids
        return found


def _as_merges_see_it(tokenizer) -> dict[str, str]:
    """What the tokenizer makes of each letter, and of the blank before a word."""

    def seen(text: str) -> str:
        normal = tokenizer.normalizer.normalize_str(text) if tokenizer.normalizer else text
        return "".join(part for part, _ in tokenizer.pre_tokenizer.pre_tokenize_str(normal))

    letters = [chr(c) for c in range(0x41, 0x100) if _WORD.fullmatch(chr(c))]
    return {letter: seen(letter) for letter in letters} | {" ": seen(" a").removesuffix(seen("a"))}


def _packed(ids: list[int]) -> bytes:
    packed = array("I", ids)
    if sys.byteorder == "big":
        packed.byteswap()
    return packed.tobytes()


@cache
def shared_encoder(vocabulary: str) -> TextEncoder:
    """One encoder per Python worker, so that its cache outlives a task."""
    return TextEncoder(vocabulary)


def vocabulary_path(name: str) -> str:
    """Where a public vocabulary lies on this machine; executors have it at the same place."""
    import public_tokenizers

    return public_tokenizers.path(name)
