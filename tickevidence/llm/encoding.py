"""Token ids of whole texts by the tokenizers library, with a bounded memory of words already seen."""

from __future__ import annotations

import json
import os
import re
import zlib
from array import array
from collections.abc import Callable, Iterator

import numpy as np

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

#: A blank next to other white space or at an edge: such a text is not cut at its blanks.
_UNEVEN = re.compile(r"\s | \s|^ | $")
#: White space besides the blank and the line feed.
_RARE = [chr(c) for c in range(128, 0x3001) if chr(c).isspace()] + [*"\t\r\x0b\x0c\x1c\x1d\x1e\x1f"]
#: Words remembered per worker, about 200 bytes each; beyond that a new memory begins, and the last one is kept beside it.
MEMORY = 400_000


def _byte_letters() -> dict[int, int]:
    """The letter by which byte-level vocabularies write each byte: printable ones stay, the others follow U+0100."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {b: b for b in plain} | {b: 256 + k for k, b in enumerate(rest)}


def _uneven(text: str) -> bool:
    """Whether _UNEVEN occurs; plain substring tests decide for almost every text."""
    if "  " in text or " \n" in text or "\n " in text or text[:1] == " " or text[-1:] == " ":
        return True
    return any(c in text for c in _RARE) and _UNEVEN.search(text) is not None


class _Words(dict):
    """Ids of blank-led words, made when first asked for, or taken over from an ``older`` memory."""

    def __init__(self, make: Callable[[str], bytes], older: dict | None = None):
        super().__init__()
        self.make = make
        self.older = older or {}

    def __missing__(self, word: str) -> bytes:
        made = self.older.get(word)
        if made is None:
            made = self.make(word)
        self[word] = made
        return made

    def renewed(self) -> _Words:
        """An empty memory that still knows what this one holds."""
        self.older = {}
        return _Words(self.make, self)


class Encoder:
    """Ids of texts as little-endian bytes, two per id for vocabularies up to 65,536 and four beyond.

    With a byte-level vocabulary no token spans the place before a single blank
    between two other characters. There a text is cut, and each distinct piece is
    encoded once. Other vocabularies encode each text as a whole. Strings of special
    tokens inside a text are ordinary text.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.full = Tokenizer.from_file(path)
        self.full.encode_special_tokens = True
        size = self.full.get_vocab_size(with_added_tokens=True)
        self.code = "H" if size <= 65_536 else "I"
        self.dtype = np.dtype("<u2" if size <= 65_536 else "<u4")
        settings = json.loads(self.full.to_str())
        split = settings.get("pre_tokenizer") or {}
        self.by_word = (
            split.get("type") == "ByteLevel"
            and split.get("use_regex", True)
            and not split.get("add_prefix_space")
            and settings.get("normalizer") is None
            and settings["model"]["type"] == "BPE"
        )
        self.tokens = self.full.model.tokenize
        self.letters = _byte_letters()
        self.line = self._whole("\n")
        self.marks = {m: self._whole(m) for m in ",.;:!?"}
        self.words = _Words(self._word)
        self.memory = MEMORY

    def _whole(self, text: str) -> bytes:
        return array(self.code, self.full.encode(text, add_special_tokens=False).ids).tobytes()

    def _letters(self, word: str, before: str = "\u0120") -> bytes:
        """A blank (unless ``before`` is empty) and a word of letters only."""
        spelled = before + (word if word.isascii() else word.encode().decode("latin-1").translate(self.letters))
        return array(self.code, [t.id for t in self.tokens(spelled)]).tobytes()

    def _word(self, word: str) -> bytes:
        """A blank and the characters up to the next blank."""
        if word.isalpha():
            return self._letters(word)
        mark = self.marks.get(word[-1])
        if mark is not None and word[:-1].isalpha():
            return self.words[word[:-1]] + mark
        head, line, tail = word.partition("\n")
        if head and line and tail.isalpha():  # the end of a line, and a first word
            return self.words[head] + self.line + self._letters(tail, "")
        return self._whole(" " + word)

    def encode(self, texts: list[str]) -> list[bytes]:
        if not self.by_word:
            return [self._whole(t) for t in texts]
        out = []
        for text in texts:
            if _uneven(text):
                out.append(self._whole(text))
                continue
            first, *rest = text.split(" ")
            out.append(self._whole(first) + b"".join(map(self.words.__getitem__, rest)))
        self._forget()
        return out

    def encode_led(self, texts: list[str]) -> list[bytes]:
        """Ids of a blank followed by each text."""
        out = []
        for text in texts:
            if not self.by_word or not text or text[0].isspace() or _uneven(text):
                out.append(self._whole(" " + text))
            else:
                out.append(b"".join(map(self.words.__getitem__, text.split(" "))))
        self._forget()
        return out

    def forget_older(self) -> None:
        self.words.older = {}

    def _forget(self) -> None:
        if len(self.words) > self.memory:
            self.words = self.words.renewed()


_LOADED: dict = {}


def encoder(path: str) -> Encoder:
    """One encoder per worker process and vocabulary."""
    if path not in _LOADED:
        _LOADED[path] = Encoder(path)
    return _LOADED[path]


#: Fixed value: the words and signs of the vocabulary with word ends; none holds white space.
WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
#: Signs that never begin a contraction.
_SIGNS = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"


class WordEndEncoder:
    """Ids under a lower-case vocabulary with word ends that drops white space.

    No token reaches over white space, so a text is cut at blanks and line feeds, and
    each distinct word is encoded once. Vocabularies of other kinds encode each text as a
    whole. Strings of special tokens in a text are special tokens, as the library has it.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.full = Tokenizer.from_file(path)
        size = self.full.get_vocab_size(with_added_tokens=True)
        self.code = "H" if size <= 65_536 else "I"
        self.dtype = np.dtype("<u2" if size <= 65_536 else "<u4")
        settings = json.loads(self.full.to_str())
        steps = [s.get("type") for s in (settings.get("normalizer") or {}).get("normalizers", [])]
        split = ((settings.get("pre_tokenizer") or {}).get("pretokenizers") or [{}])[0]
        self.by_word = (
            settings["model"]["type"] == "BPE"
            and bool(settings["model"].get("end_of_word_suffix"))
            and steps == ["NFC", "Replace", "Lowercase"]
            and split.get("pattern") == {"Regex": WORD_PATTERN}
            and (split.get("behavior"), split.get("invert")) == ("Removed", True)
            and not any(c.isspace() for t in settings["added_tokens"] for c in t["content"])
        )
        self.tokens = self.full.model.tokenize
        self.letters = _byte_letters()
        self.words = _Words(self._word)

    def _whole(self, text: str) -> bytes:
        return array(self.code, self.full.encode(text, add_special_tokens=False).ids).tobytes()

    def _word(self, word: str) -> bytes:
        if not word.isalpha():
            head = word.rstrip(_SIGNS)
            if head.isalpha():  # signs behind a word are one piece of their own
                return self.words[head] + self.words[word[len(head) :]]
            return self._whole(word) if word else b""
        try:
            low = word.lower() if word.isascii() else word.encode("latin-1").decode("latin-1").lower()
        except UnicodeEncodeError:  # other letters may need the library's normalising
            return self._whole(word)
        spelled = low if low.isascii() else low.encode().decode("latin-1").translate(self.letters)
        return array(self.code, [t.id for t in self.tokens(spelled)]).tobytes()

    def encode(self, texts: list[str]) -> list[bytes]:
        if not self.by_word:
            return [self._whole(t) for t in texts]
        out = [b"".join(map(self.words.__getitem__, t.replace("\n", " ").split(" "))) for t in texts]
        if len(self.words) > MEMORY:
            self.words = self.words.renewed()
        return out


class PieceEncoder:
    """Ids under a sentencepiece model, which puts a blank before each text.

    Where no piece holds a blank behind another character, texts are cut at single
    blanks and each distinct word is encoded once.
    """

    def __init__(self, path: str, memory: int = MEMORY):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        self.code = "H" if len(pieces) <= 65_536 else "I"
        self.dtype = np.dtype("<u2" if len(pieces) <= 65_536 else "<u4")
        self.by_word = not any("\u2581" in p.lstrip("\u2581") for p in pieces)
        self.words: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.memory = memory

    def _encode(self, texts: list[str]) -> list[bytes]:
        return [array(self.code, ids).tobytes() for ids in self.model.encode(texts, num_threads=1)]

    def encode(self, texts: list[str]) -> list[bytes]:
        cut = [t.split(" ") if self.by_word and t and "  " not in t and t[0] != " " != t[-1] else None for t in texts]
        if len(self.words) > self.memory:
            self.words, self.older = {}, self.words
        found = [list(map(self.words.get, words)) if words else [] for words in cut]
        gaps = [[n for n, ids in enumerate(known) if ids is None] if None in known else [] for known in found]
        new = {words[n] for words, missing in zip(cut, gaps, strict=True) for n in missing}
        self.words.update((w, self.older[w]) for w in new if w in self.older)
        new = [w for w in new if w not in self.older]
        self.words.update(zip(new, self._encode(new), strict=True))
        for words, known, missing in zip(cut, found, gaps, strict=True):
            for n in missing:
                known[n] = self.words[words[n]]
        whole = iter(self._encode([t for t, words in zip(texts, cut, strict=True) if words is None]))
        return [next(whole) if words is None else b"".join(known) for words, known in zip(cut, found, strict=True)]

    def forget_older(self) -> None:
        self.older = {}


def word_end_encoder(path: str) -> WordEndEncoder:
    """One encoder per worker process and vocabulary."""
    key = "word ends: " + path
    if key not in _LOADED:
        _LOADED[key] = WordEndEncoder(path)
    return _LOADED[key]


def groups(texts: Iterator, limit: int = 500, chars: int = 4_000_000) -> Iterator[list]:
    """Lists of (key, text) of at most ``limit`` items and about ``chars`` characters."""
    got, size = [], 0
    for item in texts:
        got.append(item)
        size += len(item[1])
        if len(got) >= limit or size >= chars:
            yield got
            got, size = [], 0
    if got:
        yield got


def id_bytes(dtype: np.dtype, value: int) -> bytes:
    return np.array([value], dtype).tobytes()


def ids_crc32(ids: np.ndarray) -> int:
    """Unsigned crc32 of ids written as little-endian unsigned 32-bit integers."""
    return zlib.crc32(ids.astype("<u4").tobytes())
