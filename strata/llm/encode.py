"""Whole texts to the token ids that the ``tokenizers`` library gives with ``add_special_tokens=False``.

The library builds objects of its own for every token, which costs most of its time.  Where a vocabulary file is a plain
byte-pair model whose merges are listed in the order of their ids, the same ids come from ``tiktoken`` over the file's
own entries, and a call gives just the ids:

* ``keep_space=True`` (byte-level vocabularies, nothing normalised): the whole text, split by the byte-level pattern.
* ``keep_space=False`` (vocabularies of words with an end mark, lower case, white space dropped): the words that the
  file's split pattern finds, each followed by one space, which stands for the end mark; words hold none of their own.

That is checked once per worker: the file's settings, the order of the merges, and probe strings.  Three kinds of text go
through the whole library: texts with characters whose class has changed since Unicode 3.2 (libraries may differ
in them), texts with very long white space (the splitter's stack), and texts that hold the string of an added token
(the library gives it the token's id unless ``special_as_text``).
"""

from __future__ import annotations

import json
import os
import re
import sys
import unicodedata
from array import array

import numpy as np
import regex

# The split patterns of the two kinds of vocabulary, and the added strings' common start.
_BYTE_LEVEL = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
_WORDS = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
_END = "</w>"
_LONG_SPACE = re.compile(r"\s{4096}")
_PROBES = ("", " ", "a", "The quick brown fox's 12 tails, isn't it?", "  two  spaces\n\n\tand lines \r\n x ", "é ÿ ñandú ß",
           "don't DON'T we'LL I'm", "a1b22c333", "==== --- !!!\n", "日本 你好", "x" * 70, "нет да ελα")


def _settled() -> str:
    """The inside of a character class: characters whose class is the same in Unicode 3.2 and now."""
    out, start, last = [], None, None
    for i in [9, 10, 13, *range(32, 0xD800), *range(0xE000, 0x10000)]:
        c = chr(i)
        old = unicodedata.ucd_3_2_0.category(c)
        same = old == unicodedata.category(c) and old != "Cn" and (i < 127 or old != "Cc") and c not in "Σİ"
        if same and start is not None and i == last + 1:
            last = i
        else:
            if start is not None:
                out.append(f"\\u{start:04x}-\\u{last:04x}")
            start = last = i if same else None
    return "".join(out) + (f"\\u{start:04x}-\\u{last:04x}" if start is not None else "")


def byte_letters() -> dict[int, str]:
    """The letter that byte-level vocabularies write for each byte: itself if printable, else the next from U+0100."""
    printable = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    rest = [b for b in range(256) if b not in printable]
    return {b: chr(b) for b in printable} | {b: chr(0x100 + i) for i, b in enumerate(rest)}


def token_bytes(path: str) -> list[bytes]:
    """Of a byte-level vocabulary file: the bytes of every id; added tokens are the bytes of their string."""
    spec, byte_of = json.load(open(path, encoding="utf-8")), {c: b for b, c in byte_letters().items()}
    of = {i: bytes(map(byte_of.__getitem__, token)) for token, i in spec["model"]["vocab"].items()}
    of |= {t["id"]: t["content"].encode() for t in spec["added_tokens"]}
    return [of.get(i, b"") for i in range(max(of) + 1)]


def _packed(ids: list[int]) -> bytes:
    own = array("I", ids)
    return own.tobytes() if own.itemsize == 4 and sys.byteorder == "little" else np.array(ids, "<u4").tobytes()


class Encoder:
    """``encode(text)`` gives the ids as little-endian unsigned 32-bit integers in one ``bytes``."""

    def __init__(self, path: str, keep_space: bool, special_as_text: bool = False):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(path)
        self._tokenizer.encode_special_tokens = special_as_text
        self._keep_space = keep_space
        self._plain = re.compile(f"[{_settled()}]*").fullmatch
        self._words = regex.compile(_WORDS).findall
        spec = json.load(open(path, encoding="utf-8"))
        added = [re.escape(t["content"]) for t in spec["added_tokens"]]
        self._added = re.compile("|".join(added)).search if added and not special_as_text else lambda text: None
        self._fast = self._bytes_model(spec)
        if self._fast and any(self._ids(t) != self._library(t) for t in _PROBES):
            self._fast = None

    def _bytes_model(self, spec):
        """The file's entries as a model over bytes, or None where the file says anything else than expected."""
        import tiktoken

        model, split = spec["model"], spec["pre_tokenizer"] or {}
        settings = {k: v for k, v in model.items() if k not in ("type", "vocab", "merges", "end_of_word_suffix") and v}
        end = model.get("end_of_word_suffix")
        if self._keep_space:
            known = (spec["normalizer"] is None and end is None and split.get("type") == "ByteLevel"
                     and split["use_regex"] and not split["add_prefix_space"])
        else:
            parts = split.get("pretokenizers", [])
            steps = [(n["type"], n.get("content")) for n in (spec["normalizer"] or {}).get("normalizers", [])]
            known = (end == _END and steps == [("NFC", None), ("Replace", " "), ("Lowercase", None)]
                     and [p["type"] for p in parts] == ["Split", "ByteLevel"]
                     and parts[0]["pattern"] == {"Regex": _WORDS} and parts[0]["behavior"] == "Removed"
                     and parts[0]["invert"] and not parts[1]["use_regex"] and not parts[1]["add_prefix_space"])
        if model["type"] != "BPE" or settings or not known:
            return None
        byte_of = {c: b for b, c in byte_letters().items()}

        def raw(token):
            word = token.removesuffix(_END) if end else token
            return bytes(map(byte_of.__getitem__, word)) + (b" " if word != token else b"")

        vocab = model["vocab"]
        merged = [vocab["".join(m if isinstance(m, list) else m.split(" "))] for m in model["merges"]]
        ranks = {raw(token): i for token, i in vocab.items()}
        if merged != sorted(merged) or len(ranks) != len(vocab):
            return None
        return tiktoken.Encoding("file", pat_str=_BYTE_LEVEL if self._keep_space else "[^ ]+ ", mergeable_ranks=ranks,
                                 special_tokens={})

    def _library(self, text: str) -> list[int]:
        return self._tokenizer.encode(text, add_special_tokens=False).ids

    def _ids(self, text: str) -> list[int]:
        if self._keep_space:
            return self._fast.encode_ordinary(text)
        return self._fast.encode_ordinary(" ".join(self._split(text.lower())))

    def _split(self, text: str) -> list[str]:
        """The pieces of the split pattern; white space is in none, so most are told without the pattern."""
        out = []
        for chunk in text.split():
            if chunk.isalpha():
                out.append(chunk)
            elif chunk[:-1].isalpha():
                out += (chunk[:-1], chunk[-1])
            else:
                out += self._words(chunk)
        out.append("")
        return out

    def ids(self, text: str | None) -> list[int]:
        if not text:
            return []
        if self._fast is None or not self._plain(text) or _LONG_SPACE.search(text) or self._added(text) or not (
                self._keep_space or unicodedata.is_normalized("NFC", text)):
            return self._library(text)
        return self._ids(text)

    def encode(self, text: str | None) -> bytes:
        return _packed(self.ids(text))


_ENCODERS: dict[tuple[str, bool, bool], Encoder] = {}


def encoder(path: str, keep_space: bool, special_as_text: bool = False) -> Encoder:
    """The worker's encoder for this vocabulary; loaded once per Python worker."""
    key = (path, keep_space, special_as_text)
    if key not in _ENCODERS:
        _ENCODERS[key] = Encoder(*key)
    return _ENCODERS[key]
