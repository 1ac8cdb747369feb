"""Words of a text as a tokenizer file with word ends cuts them."""

from __future__ import annotations

import json
import re
from functools import lru_cache

# The characters whose class no Unicode version disputes, and the word pattern of the
# file restricted to them. Any other character sends the text through the library itself.
_OTHER = re.compile(r"[^\t\n\r\x20-\x7eÀ-ÖØ-öø-ÿ¡¿«»‘’“”–—…€]")
_PATTERN = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^\sa-z0-9ß-öø-ÿ]+")
_FILE_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"

#: Where a text can be cut: no word of the file's pattern crosses these, and no composed character does.
SPACES = " \t\n\r"


def byte_letters() -> list[str]:
    """The printable letter that stands for each byte in byte-level vocabularies."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in plain]
    return [chr(b) if b in plain else chr(256 + rest.index(b)) for b in range(256)]


class WordTokenizer:
    """Cuts texts into words exactly as the library does; words are encoded one by one.

    Only files whose words cannot cross white space are taken (lower case, words removed from
    their surroundings by a pattern, an end-of-word suffix); others are refused.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as file:
            data = json.load(file)
        cut = (data.get("pre_tokenizer") or {}).get("pretokenizers", [{}])[0]
        if cut.get("pattern", {}).get("Regex") != _FILE_PATTERN or not data["model"].get("end_of_word_suffix"):
            raise ValueError("this tokenizer file does not cut words at white space")
        self.library = Tokenizer.from_file(path)
        self.model = data["model"]
        self.letters = byte_letters()
        self._bytes = {letter: byte for byte, letter in enumerate(self.letters)}
        self.special = {t["content"]: t["id"] for t in data["added_tokens"]}
        self._special = re.compile("(" + "|".join(map(re.escape, self.special)) + ")")
        self._open = {s[:2] for s in self.special}

    def plain(self, text: str) -> bool:
        """Whether the fast pattern gives the library's words."""
        return _OTHER.search(text) is None and not any(s in text for s in self._open)

    def words(self, text: str) -> list[str]:
        if self.plain(text):
            return _PATTERN.findall(text.lower())
        return [word for word, _ in self._by_library(text)]

    def words_with_starts(self, text: str) -> list[tuple[str, int]]:
        """Words and where they start in ``text``; -1 where normalisation hides the place."""
        if self.plain(text):
            return [(m[0], m.start()) for m in _PATTERN.finditer(text.lower())]
        return self._by_library(text)

    def _by_library(self, text: str) -> list[tuple[str, int]]:
        """Piece by piece between spaces, so that every first word of a piece has a known start."""
        found: list[tuple[str, int]] = []
        at = 0
        for part in self._special.split(text):
            if part in self.special:
                found.append((part, at))
            else:
                for piece in re.finditer(f"[^{SPACES}]+", part):
                    shown = self.library.normalizer.normalize_str(piece[0])
                    for k, (word, _) in enumerate(self.library.pre_tokenizer.pre_tokenize_str(shown)):
                        found.append((bytes(self._bytes[c] for c in word).decode("utf-8"), -1 if k else at + piece.start()))
            at += len(part)
        return found


@lru_cache(maxsize=2)
def loaded(path: str) -> WordTokenizer:
    """One instance for each worker process."""
    return WordTokenizer(path)
