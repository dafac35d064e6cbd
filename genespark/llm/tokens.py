"""Tokenizing whole texts with the public ``tokenizers`` files, fast and exactly.

The library encodes about 3 MB of text a second.  Words repeat, so a text is cut
into the words of the tokenizer's own pre-tokenizer, and each distinct word is
encoded once per Python worker and kept as the bytes of its ids.  The cut is done
here only for texts of characters whose classes are beyond doubt (up to U+017F,
with a few exceptions) that hold none of the tokenizer's added tokens; any other
text goes to the tokenizer as it is.
"""

from __future__ import annotations

import json
import os
import re
import struct
from functools import lru_cache

import numpy as np

#: Words kept by a worker, the longest that is kept, and characters handled at once.
CACHE_WORDS = 400_000
CACHE_LENGTH = 48
CHUNK = 1 << 20
#: Characters on whose class regular expressions of different libraries may differ.
ODD = re.compile("[\x1c-\x1f\x85\xa0\xb2\xb3\xb9\xbc-\xbe\u0130]|[^\x00-\u017f]")
ODD_LATIN = bytes([*range(0x1C, 0x20), 0x85, 0xA0, 0xB2, 0xB3, 0xB9, 0xBC, 0xBD, 0xBE])
#: The letters among all other characters, and the pre-tokenizers' patterns for them.
LETTERS = "A-Za-z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-\u017f"
SPACE = re.compile(rf" [{LETTERS}]+|[{LETTERS}]+| ?[0-9]+|'(?:[stmd]|re|ve|ll)| ?[^\s{LETTERS}0-9]+|\s+(?!\S)|\s+")
WORDS = re.compile(rf"[{LETTERS}]+|[0-9]|'(?:[stmd]|re|ve|ll)|[^\s{LETTERS}0-9]+")
#: Words that are encoded as one text.
JOINED = 1000


def is_odd(text: str) -> bool:
    """Whether a character stands in the text whose class is in doubt."""
    try:
        data = text.encode("latin-1")
    except UnicodeEncodeError:
        return ODD.search(text) is not None
    return len(data.translate(None, ODD_LATIN)) != len(data)


class Encoder:
    """Ids of texts, as little-endian unsigned 32-bit integers in ``bytes``.

    Two kinds of tokenizer files are known: byte-level ones whose pattern binds one
    space to the following word ("space"), and lower-casing ones that drop white
    space ("words").  Any other kind gets whole texts.
    """

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark runs a worker for each core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        if hasattr(self.tokenizer.model, "_resize_cache"):
            self.tokenizer.model._resize_cache(0)  # ours does that
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        self.added = added_of(spec)
        self.cut = "whole" if self.added is None else cut_of(spec)
        self.cache = Cache()
        vocab = self.tokenizer.get_vocab()
        self.size = max(vocab.values()) + 1
        # Where a word begins ("space") or ends ("words"), told by the token.
        self.marks = np.zeros(self.size, dtype=bool)
        if self.cut == "space":
            self.marks[[i for token, i in vocab.items() if token.startswith("\u0120")]] = True
        elif self.cut == "words":
            self.marks[[i for token, i in vocab.items() if token.endswith("</w>")]] = True

    def ids(self, text: str) -> np.ndarray:
        found = self.tokenizer.encode_batch_fast([text], add_special_tokens=False)
        return np.asarray(found[0].ids, dtype="<u4")

    def has_added(self, text: str) -> bool:
        """Whether an added token may stand in the text, in whatever case."""
        for plain, content in self.added:
            if plain in text and content in text.lower():
                return True
        return False

    def width(self, end_id: int) -> int:
        """Bytes that hold any id."""
        return 2 if max(self.size, end_id + 1) <= 1 << 16 else 4

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """Ids of each text; None counts as an empty text."""
        out: list[bytes] = []
        chunk, held = [], 0
        for text in texts:
            chunk.append(text or "")
            held += len(chunk[-1])
            if held >= CHUNK:
                out += self._chunk(chunk)
                chunk, held = [], 0
        return out + self._chunk(chunk)

    def _chunk(self, texts: list[str]) -> list[bytes]:
        find = SPACE.findall if self.cut == "space" else WORDS.findall
        split: list[list[str] | None] = []
        for text in texts:
            if self.cut == "whole" or is_odd(text) or self.has_added(text):
                split.append(None)
            else:
                split.append(find(text if self.cut == "space" else text.lower()))
        found = [words and list(map(self.cache.__getitem__, words)) for words in split]
        learned = self._learn(list(self.cache.pending))
        self.cache.pending.clear()
        out = []
        for text, words, got in zip(texts, split, found, strict=True):
            if words is None:
                out.append(self.ids(text).tobytes())
                continue
            at = -1
            while True:
                try:
                    at = got.index(None, at + 1)
                except ValueError:
                    break
                got[at] = learned[words[at]]
            out.append(b"".join(got))
        if len(self.cache) < CACHE_WORDS:
            self.cache.update((w, i) for w, i in learned.items() if len(w) <= CACHE_LENGTH)
        return out

    def _learn(self, words: list[str]) -> dict[str, bytes]:
        """Encode words; those of letters go many in a text, in which their bounds are found again."""
        out: dict[str, bytes] = {}
        if self.cut == "space":
            plain, gap = [w for w in words if w[0] == " " and w[1:].isalpha()], ""
        else:
            plain, gap = [w for w in words if w.isalpha()], " "
        groups = [plain[k : k + JOINED] for k in range(0, len(plain), JOINED)]
        for group, found in zip(groups, self.tokenizer.encode_batch_fast([gap.join(g) for g in groups], add_special_tokens=False), strict=True):
            ids = np.asarray(found.ids, dtype="<u4")
            marks = np.flatnonzero(self.marks[ids])
            if len(marks) == len(group):
                cuts = [*(4 * marks).tolist(), 4 * len(ids)] if self.cut == "space" else [0, *(4 * marks + 4).tolist()]
                data = ids.tobytes()
                out.update(zip(group, [data[a:b] for a, b in zip(cuts, cuts[1:], strict=False)], strict=True))
        out.update((w, self.ids(w).tobytes()) for w in words if w not in out)
        return out


class Cache(dict):
    """Ids of words; a missing word gives None and is noted in ``pending``."""

    def __init__(self):
        self.pending: set[str] = set()

    def __missing__(self, word: str) -> None:
        self.pending.add(word)


def added_of(spec: dict) -> list[tuple[str, str]] | None:
    """Added tokens in lower case, each after its longest part without letters; None if one could arise between joined words."""
    out = []
    for token in spec.get("added_tokens") or []:
        content = token["content"].lower()
        plain = max(re.split(r"[^\W_]|\s", content), key=len)
        if not plain or re.search(r"\s", content):
            return None
        out.append((plain, content))
    return out


def cut_of(spec: dict) -> str:
    """Where texts may be cut for this tokenizer file; see Encoder."""
    normalizer, split = spec.get("normalizer"), spec.get("pre_tokenizer") or {}
    if normalizer is None and split.get("type") == "ByteLevel" and split.get("use_regex") and not split.get("add_prefix_space"):
        return "space"
    kinds = [x["type"] for x in (normalizer or {}).get("normalizers", [])]
    parts = split.get("pretokenizers", [])
    if kinds == ["NFC", "Replace", "Lowercase"] and [x["type"] for x in parts] == ["Split", "ByteLevel"] and parts[0]["behavior"] == "Removed" and r"[^\s\p{L}\p{N}]+" in parts[0]["pattern"].get("Regex", ""):
        return "words"
    return "whole"


@lru_cache(maxsize=4)
def encoder(path: str) -> Encoder:
    """One encoder per worker and file, so that the piece cache outlives a task."""
    return Encoder(path)


def id_bytes(token_id: int) -> bytes:
    return struct.pack("<I", token_id)


def packed(ids: bytes, width: int) -> bytes:
    """32-bit ids as ids of ``width`` bytes."""
    return ids if width == 4 else np.frombuffer(ids, "<u4").astype("<u2").tobytes()


def unpacked(data: bytes, n: int) -> np.ndarray:
    """``n`` ids, 16 or 32 bits wide, as 32-bit ids."""
    return np.frombuffer(data, "<u4" if len(data) == 4 * n else "<u2").astype("<u4")
