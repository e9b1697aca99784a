"""Token ids of a public tokenizer, each different word encoded once per task."""

from __future__ import annotations

import json
from array import array
from collections.abc import Sequence
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Words one task remembers in each of two generations; bounds its memory, never changes an id.
REMEMBERED = 500_000
#: Texts whose different words are looked up together.
TOGETHER = 256

# Fixed value: how byte-level pre-tokenizers cut a text that names no pattern of its own.
BYTE_LEVEL_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
# Fixed value: the same of tokenizers whose words end with a mark.
WORD_END_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
#: Marks that both patterns cut off a word that ends with one.
_MARKS = frozenset(",.;:!?")


def _byte_letters() -> dict[int, str]:
    """The printable letter that stands for each byte in byte-level vocabularies."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in printable]
    return {b: chr(b) for b in printable} | {b: chr(256 + i) for i, b in enumerate(others)}


class _Remembered(dict):
    """Word or piece -> its ids as little-endian uint32, asked of the model when first seen.

    Pieces not used for a generation are forgotten.
    """

    def __init__(self, encode, share: int = 1):
        super().__init__()
        self._encode, self._older, self._share = encode, {}, share

    def __missing__(self, piece):
        if len(self) >= REMEMBERED // self._share:
            self._older = dict(self)
            self.clear()
        ids = self[piece] = self._older[piece] if piece in self._older else self._encode(piece)
        return ids


class WordEncoder:
    """Encodes whole texts word by word; equal to encoding each text at once.

    For tokenizers of the byte-level kind. What stands between two single spaces
    is cut and encoded without regard to the rest, so only words not seen before
    are normalized, cut by the tokenizer's own pattern and given to the library's
    model. Strings of control tokens inside a text are ordinary text.
    """

    def __init__(self, path: str):
        import regex
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            described = json.load(file)
        steps = described["pre_tokenizer"].get("pretokenizers", [described["pre_tokenizer"]])
        normalizers = described["normalizer"] or {}
        kinds = {n["type"] for n in normalizers.get("normalizers", [normalizers]) if n}
        patterns = [s["pattern"]["Regex"] for s in steps if "pattern" in s]
        pattern = patterns[0] if patterns else BYTE_LEVEL_PATTERN
        self._cut = regex.compile(pattern).findall
        # These patterns leave a run of ASCII letters, and one mark after it, in one piece each.
        self._simple = pattern in (BYTE_LEVEL_PATTERN, WORD_END_PATTERN)
        self._normalizer, self._model = tokenizer.normalizer, tokenizer.model
        # Some tokenizers keep what the pattern finds and drop all white space.
        self._spaceless = any(s.get("invert") and s.get("behavior") == "Removed" for s in steps)
        # In ASCII words these normalizers do no more than lower-case.
        self._lowers = "Lowercase" in kinds and kinds <= {"NFC", "Replace", "Lowercase"} and self._spaceless
        self._letters = _byte_letters()
        # Pieces that are a word with the space before it are remembered as that word.
        self._pieces = _Remembered(self._piece, share=4)
        self._words = _Remembered(self._word)

    def _piece(self, piece: str) -> bytes:
        letters = piece.encode().decode("latin-1").translate(self._letters)
        return array("I", [token.id for token in self._model.tokenize(letters)]).tobytes()

    def _whole(self, text: str) -> bytes:
        if self._lowers and text.isascii():
            text = text.lower()
        elif self._normalizer:
            text = self._normalizer.normalize_str(text)
        return b"".join(map(self._pieces.__getitem__, self._cut(text)))

    def _word(self, word: str) -> bytes | None:
        """Ids of a word, with the space before it where spaces count; None where white space runs on beside that space."""
        if self._simple and word.isascii() and (self._lowers or not self._normalizer):
            if word.isalpha():
                return self._piece(word.lower() if self._lowers else word if self._spaceless else " " + word)
            if word[-1:] in _MARKS and word[:-1].isalpha():
                return self._words[word[:-1]] + self._pieces[word[-1]]
        if self._spaceless:
            return self._whole(word)
        if not word or word[0].isspace() or word[-1].isspace():
            return None
        if not self._simple or self._normalizer:
            return self._whole(" " + word)
        pieces = self._cut(" " + word)
        return self._piece(pieces[0]) if len(pieces) == 1 else b"".join(map(self._inner, pieces))

    def _inner(self, piece: str) -> bytes:
        """Ids of a piece of a word; one that begins with a space is remembered as a word."""
        ids = self._words[piece[1:]] if piece[0] == " " else None
        return self._pieces[piece] if ids is None else ids

    def encode(self, text: str | None) -> bytes:
        """Ids of one text as little-endian uint32; null and empty give none."""
        if not text:
            return b""
        if self._spaceless:
            for space in "\n\t\r":
                text = text.replace(space, " ")
            return b"".join(map(self._words.__getitem__, text.split(" ")))
        first, *others = text.split(" ")
        ids = list(map(self._words.__getitem__, others))
        if None in ids or not first or first[-1].isspace():
            return self._whole(text)
        return self._whole(first) + b"".join(ids)

    def encode_all(self, texts: pa.Array | Sequence[str | None]) -> list[bytes]:
        """``encode`` of every text; a word is looked up once for all texts given together."""
        texts = texts if isinstance(texts, pa.Array) else pa.array(texts, pa.string())
        found: list[bytes] = []
        for at in range(0, len(texts), TOGETHER):
            found += self._together(pc.fill_null(texts.slice(at, TOGETHER), ""))
        return found

    def _together(self, texts: pa.Array) -> list[bytes]:
        if self._spaceless:
            for space in "\n\t\r":
                texts = pc.replace_substring(texts, space, " ")
        words = pc.split_pattern(texts, " ")
        n_words = pc.list_value_length(words).to_numpy(zero_copy_only=False)
        ends = np.cumsum(n_words)
        coded = pc.list_flatten(words).dictionary_encode()
        codes = coded.indices.to_numpy().astype(np.int64)
        ids = list(map(self._words.__getitem__, coded.dictionary.to_numpy(zero_copy_only=False)))
        whole: dict[int, bytes] = {}
        if not self._spaceless:
            # No space stands before the first word of a text.
            heads = coded.take(pa.array(ends - n_words)).to_pylist()
            codes[ends - n_words] = len(ids) + np.arange(len(heads))
            ids += [self._whole(head) if head and not head[-1].isspace() else None for head in heads]
            missing = np.array([each is None for each in ids])
            if missing.any():
                for row in np.unique(np.searchsorted(ends, np.flatnonzero(missing[codes]), "right")).tolist():
                    text = texts[row].as_py()
                    whole[row] = self._whole(text) if text else b""
                ids = [each or b"" for each in ids]
        sizes = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
        starts, n_ids = (np.cumsum(sizes) - sizes)[codes], sizes[codes]
        stops = np.cumsum(n_ids)
        at = np.repeat(starts - (stops - n_ids), n_ids) + np.arange(n_ids.sum())
        joined = np.frombuffer(b"".join(ids), "<u4")[at].tobytes()
        cuts = [0, *(4 * stops[ends - 1]).tolist()]
        return [whole.get(row, joined[a:b]) for row, (a, b) in enumerate(zip(cuts, cuts[1:]))]


@lru_cache(maxsize=2)
def encoder(path: str) -> WordEncoder:
    """One encoder per worker process and file."""
    return WordEncoder(path)
