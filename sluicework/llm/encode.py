"""Token ids of whole texts, equal to the tokenizers library's, with a bounded cache of words.

Both vocabularies split a text into words before merging, so a word's ids do
not depend on its neighbours. A text is cut only where that holds: at white
space for the vocabulary that drops it, before a space otherwise. A piece that
the cache lacks is encoded by the library: a run of Latin letters, which is one
word under either vocabulary's rules, by its merge model alone, anything else
by the whole of it. Texts with a special token's opening or an ambiguous run of
white space go to the library whole, and so does every text of a vocabulary
whose rules are not one of the two.
"""

from __future__ import annotations

import json
import re
import struct
from collections.abc import Callable
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from . import common

#: Memory of a worker's cached pieces, about: half for the recent ones, half for those before.
CACHE_BYTES = 40 << 20
#: Texts that are cut at once: more of them share more pieces, and take more room.
TEXTS = 512
#: What an entry costs besides its characters and ids, about, and the longest piece that is kept.
ENTRY_BYTES, PIECE_BYTES = 170, 64

_WORD = re.compile(rb"([a-zA-Z\xc3\x80-\xbf]+)([!-&(-/:-;=-@\[-`{}~]+)")
_PIECE = re.compile(r"([a-zA-ZÀ-ÖØ-öø-ɏ]+)([!-&(-/:-;=-@\[-`{}~]+)")
_LATIN = re.compile(r"[a-zA-ZÀ-ÖØ-öø-ɏ]+")
_AMBIGUOUS = r"[\x09-\x0d\x1c-\x1f \x{85}\p{Z}] [\x09-\x0d\x1c-\x1f \x{85}\p{Z}]"
_PRINTABLE = [*range(33, 127), *range(161, 173), *range(174, 256)]
#: The letter for each byte in byte-level vocabularies: printable ones as they are, the others from 256 on.
_LETTERS = {b: b for b in _PRINTABLE} | {b: 256 + i for i, b in enumerate(sorted(set(range(256)) - set(_PRINTABLE)))}
# Fixed value: the pattern of words of the vocabulary that drops white space.
_DROPPING = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


class Pieces(dict):
    """Ids by piece, computed when missing: recent ones here, those of the time before in old, within a budget of bytes."""

    def __init__(self, make: Callable[[bytes | str], bytes], budget: int):
        super().__init__()
        self.make, self.half, self.room = make, budget // 2, budget // 2
        self.old: dict = {}

    def __missing__(self, key):
        value = self.old.pop(key, None) or self.make(key)
        if len(key) > PIECE_BYTES:
            return value
        self.room -= ENTRY_BYTES + len(key) + len(value)
        if self.room < 0:
            self.old = dict(self)
            self.clear()
            self.room = self.half
        self[key] = value
        return value


_SHORT = [struct.Struct(f"<{n}I").pack for n in range(17)]


def _little(ids: list[int]) -> bytes:
    return _SHORT[len(ids)](*ids) if len(ids) < 17 else struct.pack(f"<{len(ids)}I", *ids)


class Encoder:
    """encode(text) gives the ids as little-endian unsigned 32-bit bytes."""

    def __init__(self, path: str, budget: int = CACHE_BYTES, texts: int | None = None):
        from tokenizers import Tokenizer

        self.at_once = texts or TEXTS
        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        with open(path, encoding="utf-8") as f:
            rules = json.load(f)
        self.rule = self._rule(rules)
        self.words = Pieces(self._word, budget)
        self.spaced = Pieces(self._spaced, budget * 7 // 8)
        self.plain = Pieces(self._plain, budget // 8)

    @staticmethod
    def _rule(rules: dict) -> str:
        """How texts may be cut: at dropped white space, before spaces, or not at all."""
        model, cutter, normalizer = rules["model"], rules.get("pre_tokenizer") or {}, rules.get("normalizer")
        if model.get("type") != "BPE" or model.get("dropout") or any("<|" not in t["content"] for t in rules.get("added_tokens") or ()):
            return "none"
        if normalizer is None and cutter.get("type") == "ByteLevel" and cutter.get("use_regex") and not cutter.get("add_prefix_space"):
            return "spaces"
        steps = [s["type"] for s in (normalizer or {}).get("normalizers", [])]
        cutters = cutter.get("pretokenizers", [])
        if steps == ["NFC", "Replace", "Lowercase"] and [c["type"] for c in cutters] == ["Split", "ByteLevel"] and cutters[0]["pattern"].get("Regex") == _DROPPING:
            return "words"
        return "none"

    def _library(self, text: str) -> bytes:
        return _little(self.tokenizer.encode(text, add_special_tokens=False).ids)

    def _letters(self, text: str, lead: str = "") -> bytes:
        """Of one run of letters."""
        if not text.isascii():
            text = text.encode().decode("latin-1").translate(_LETTERS)
        return _little([t.id for t in self.model.tokenize(lead + text)])

    def _word(self, key: bytes) -> bytes:
        if key.isalpha() and key.islower():  # ASCII only
            return _little([t.id for t in self.model.tokenize(key.decode())])
        m = _WORD.fullmatch(key)
        if m and _LATIN.fullmatch(m[1].decode()):
            return self.words[m[1]] + self.words[m[2]]
        text = key.decode()
        if _LATIN.fullmatch(text) and len(low := text.lower()) == len(text):
            return self._letters(text) if low == text else self.words[low.encode()]
        return self._library(text)

    def _split(self, piece: str, first: Pieces, lead: str) -> bytes:
        if piece.isalpha() and (piece.isascii() or _LATIN.fullmatch(piece)):
            return self._letters(piece, "Ġ" if lead else "")
        if m := _PIECE.fullmatch(piece):
            return first[m[1]] + self.plain[m[2]]
        lines = piece.split("\n")
        if len(lines) > 1 and not any(not x or x[0].isspace() or x[-1].isspace() for x in lines):
            return first[lines[0]] + b"".join(self.plain["\n"] + self.plain[x] for x in lines[1:])
        return self._library(lead + piece)

    def _spaced(self, piece: str) -> bytes:
        return self._split(piece, self.spaced, " ")

    def _plain(self, piece: str) -> bytes:
        return self._split(piece, self.plain, "")

    def encode(self, text: str) -> bytes:
        return bytes(self.encode_all(pa.array([text]))[0])

    def encode_all(self, texts: pa.Array) -> list[bytes | memoryview]:
        """Of every text its ids; null is the empty text.

        The texts are cut by Arrow, each distinct piece is looked up once, and
        the pieces' ids are put together by their places.
        """
        if len(texts) > self.at_once:
            return [x for at in range(0, len(texts), self.at_once) for x in self.encode_all(texts.slice(at, self.at_once))]
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        whole = pc.match_substring(texts, "<|")
        if self.rule == "spaces":
            whole = pc.or_(whole, pc.match_substring_regex(texts, _AMBIGUOUS))
        if self.rule == "none":
            whole = pa.array([True] * len(texts), pa.bool_())
        cut = pc.if_else(whole, "", texts)
        lists = pc.split_pattern(cut, " ") if self.rule == "spaces" else pc.ascii_split_whitespace(cut)
        pieces = lists.flatten().dictionary_encode()
        codes, first = pieces.indices.to_numpy(zero_copy_only=False), np.asarray(lists.offsets)
        if self.rule == "spaces":
            names = pieces.dictionary.to_pylist()
            known = list(map(self.spaced.__getitem__, names))
            codes, heads = codes.astype(np.int64), first[:-1]
            known += [self.plain[names[c]] if names[c] else b"" for c in codes[heads].tolist()]
            codes[heads] = len(names) + np.arange(heads.size)
        else:
            names = (w.lower() if w.isascii() else w for w in pieces.dictionary.cast(pa.large_binary()).to_pylist())
            known = [self.words[w] if w else b"" for w in names]
        put = pa.array(known, pa.large_binary()).take(pa.array(codes))
        _, offsets, data = put.buffers()
        at = np.frombuffer(offsets, np.int64, len(put) + 1)[first] if len(put) else np.zeros(len(texts) + 1, np.int64)
        view = memoryview(data or b"")
        out = [view[a:b] for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)]
        for i in np.flatnonzero(whole.to_numpy(zero_copy_only=False)).tolist():
            out[i] = self._library(texts[i].as_py())
        return out


@cache
def _encoder(path: str, budget: int, texts: int | None) -> Encoder:
    return Encoder(path, budget, texts)


def encoder(path: str, budget: int = CACHE_BYTES, texts: int | None = None) -> Encoder:
    """This worker's encoder of a vocabulary, which cuts so many texts at once, or TEXTS."""
    common.alone(f"encoder {path} {budget}", _encoder.cache_clear)
    return _encoder(path, budget, texts)
