"""Token ids of whole texts by the tokenizers library, with one library call per distinct blank-free run."""

from __future__ import annotations

import functools
import json
import sys
import unicodedata
from array import array

import numpy as np

#: Runs kept per Python worker; the memory is given back and collected anew beyond it. Results don't depend on it.
KEPT_RUNS = 1_000_000
#: ASCII marks, which a tokenizer of words never joins to letters before them.
MARKS = b"!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"
#: Letters up to here have long been letters to every library; runs with later ones take the whole way.
KNOWN_LETTERS = "\u2500"


def byte_letters() -> dict[int, str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in plain]
    return {**{b: chr(b) for b in plain}, **{b: chr(256 + i) for i, b in enumerate(others)}}


class TextEncoder(dict):
    """Maps text to its ids as little-endian unsigned 32-bit integers, exactly as the library encodes it whole.

    A tokenizer that lower-cases and whose splitting pattern only matches text without white space never joins
    anything over an ASCII blank, so a text is the concatenation of its blank-free runs. The runs repeat, so
    their ids are looked up. A new run of letters only is one word to the tokenizer, so the library's model gets
    it at once; other runs take the whole way. Other tokenizers, and texts that spell one of the special tokens, go
    whole through the library.
    """

    def __init__(self, path: str) -> None:
        super().__init__()
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        kinds = [x["type"] for x in (spec.get("normalizer") or {}).get("normalizers", [])]
        steps = (spec.get("pre_tokenizer") or {}).get("pretokenizers", [])
        pattern = steps[0].get("pattern", {}).get("Regex", "") if steps else ""
        self.by_run = (
            kinds == ["NFC", "Replace", "Lowercase"] and steps[0]["behavior"] == "Removed" and steps[0]["invert"]
            and pattern.endswith(r"|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+") and not spec.get("post_processor")
            and len(steps) == 2 and steps[1]["type"] == "ByteLevel" and not steps[1]["add_prefix_space"]
            and not steps[1]["use_regex"] and spec["model"]["type"] == "BPE"
        )
        self.by_run = self.by_run and sys.byteorder == "little" and array("I").itemsize == 4
        self.model, self.letters = self.tokenizer.model, byte_letters()
        self.special = [x["content"].lower().encode() for x in spec.get("added_tokens", [])]

    def whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def word(self, text: str) -> bytes | None:
        """Ids of a run of letters; None where lower case or composition might change more than single letters."""
        if not text.isalpha() or max(text) >= KNOWN_LETTERS:
            return None
        lower = text.lower()
        if not lower.isalpha() or "\u03a3" in text or not unicodedata.is_normalized("NFC", text):
            return None
        return self.letters_only(lower.encode().decode("latin-1").translate(self.letters))

    def letters_only(self, word: str) -> bytes:
        return array("I", [t.id for t in self.model.tokenize(word)]).tobytes()

    def __missing__(self, run: bytes) -> bytes:
        if len(self) >= KEPT_RUNS:
            self.clear()
        word = run.rstrip(MARKS)
        if word.isalpha():  # ASCII letters, in lower case already
            ids = self.letters_only(word.decode()) if len(word) == len(run) else self[word] + self[run[len(word):]]
        else:
            # Marks behind letters are split off, but not from a lower form that ends in a mark of its own.
            ids = self.word(word.decode()) if word else None
            if ids is None:
                ids = self.whole(run.decode())
            elif len(word) < len(run):
                ids += self[run[len(word):]]
        self[run] = ids
        return ids

    def encode(self, text: str | None) -> bytes:
        if not text:
            return b""
        if not self.by_run:
            return self.whole(text)
        raw = text.encode().lower()  # bytes: ASCII letters only, the library does the others
        if any(mark in raw for mark in self.special):
            return self.whole(text)
        return b"".join(map(self.__getitem__, raw.split()))


@functools.lru_cache(maxsize=2)
def encoder(path: str) -> TextEncoder:
    """One per Python worker, kept between tasks."""
    return TextEncoder(path)
