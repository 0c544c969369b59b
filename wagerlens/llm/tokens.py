"""Token ids of whole texts with the `tokenizers` library, one merge run per distinct word.

The library spends nearly all of its time on words it has seen before. Both vocabularies used here
are byte-level BPE models whose pre-tokenizer cuts a text into words that are merged on their own,
so the ids of a text are the ids of its words in a row. `Encoder` cuts texts by the same rule and
keeps the ids of words it has met; new words go to the library's own model. Texts with characters
beyond Latin-1, where rules depend on the version of the character tables, texts that may hold one of
the vocabulary's added tokens, such as `<|endoftext|>`, and vocabularies with other pre-tokenizers go
to the library whole. Ids are those of the library's plain call: an added token in a text gets its id.
"""

from __future__ import annotations

import json
import os
import re

import numpy as np

# Character classes of Latin-1 and the two word patterns of the vocabularies.
SPACE = r"\t\n\x0b\x0c\r \x85\xa0"
LETTER = r"A-Za-z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-\xff"
DIGIT = r"0-9\xb2\xb3\xb9\xbc-\xbe"
SHORT = r"'(?:s|t|re|ve|m|ll|d)"
SPACED_WORDS = re.compile(
    rf"{SHORT}| ?[{LETTER}]+| ?[{DIGIT}]+| ?[^{SPACE}{LETTER}{DIGIT}]+"
    rf"|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+"
)
BARE_WORDS = re.compile(rf"{SHORT}|[{LETTER}]+|[{DIGIT}]|[^{SPACE}{LETTER}{DIGIT}]+")

KEPT_WORDS = 400_000


def byte_letters() -> dict[int, str]:
    """The printable letter that byte-level vocabularies write for each byte."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters = {b: chr(b) for b in printable}
    for b in range(256):
        letters.setdefault(b, chr(256 + len(letters) - len(printable)))
    return letters


class Encoder(dict):
    """Maps words to their ids as little-endian unsigned 32-bit bytes; see `encode`."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        super().__init__()
        self.tokenizer = Tokenizer.from_file(path)
        added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        # What all added tokens begin with, up to the first letter; None if there are none.
        self._sign = re.match(r"[^A-Za-z]*", os.path.commonprefix(added))[0] if added else None
        self._model = self.tokenizer.model
        self._letters = byte_letters()
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self._words, self._lower = self._rule(spec)

    @staticmethod
    def _rule(spec: dict) -> tuple[re.Pattern | None, bool]:
        pre, norm = spec.get("pre_tokenizer") or {}, spec.get("normalizer") or {}
        if spec["model"].get("type") != "BPE":
            return None, False
        if pre.get("type") == "ByteLevel" and pre.get("use_regex", True) and not norm:
            return (None if pre.get("add_prefix_space") else SPACED_WORDS), False
        steps = [x.get("type") for x in pre.get("pretokenizers", [])]
        changes = [x.get("type") for x in norm.get("normalizers", [])]
        if steps == ["Split", "ByteLevel"] and changes == ["NFC", "Replace", "Lowercase"]:
            return BARE_WORDS, True
        return None, False

    def __missing__(self, word: str) -> bytes:
        letters = word.encode("utf-8").decode("latin-1").translate(self._letters)
        ids = np.array([t.id for t in self._model.tokenize(letters)], dtype="<u4").tobytes()
        if len(self) < KEPT_WORDS and len(word) <= 64:
            self[word] = ids
        return ids

    def encode(self, text: str | None) -> bytes:
        """Ids of the whole text, without special tokens; a null text is an empty one."""
        if not text:
            return b""
        if self._words is None or not _latin(text) or (self._sign is not None and self._sign in text):
            return self.whole(text)
        words = self._words.findall(text.lower() if self._lower else text)
        return b"".join(map(self.__getitem__, words))

    def whole(self, text: str) -> bytes:
        """The library's own answer for the whole text at once."""
        found = self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0]
        return np.array(found.ids, dtype="<u4").tobytes()


def _latin(text: str) -> bool:
    if text.isascii():
        return True
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return False
    return True


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """One encoder per worker process and vocabulary."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def vocabulary(name: str) -> str:
    """Path of an installed vocabulary file, on the machine that asks."""
    import public_tokenizers

    return public_tokenizers.path(name)
