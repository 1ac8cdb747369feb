"""BPE encoding of distinct words along a prefix trie, and decoding."""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyforge.llm.batches import REMEMBERED, mapped
from tallyforge.llm.tokenizer import WordTokenizer, loaded


class PrefixTrie:
    """Encodes sorted words depth first along the trie that their prefixes form.

    The state of a prefix is its last token. Every prefix of an encoding encodes its own text, and a
    row of tokens is an encoding when each neighbouring pair is one; so the last token of a longer prefix
    is the one suffix token whose pair with the last token before it survives merging. A state is worked
    out once for all words below it: only the path to the current word is held, and moving on to the
    next word drops what the two do not share.
    """

    def __init__(self, tokenizer: WordTokenizer):
        model, suffix = tokenizer.model, tokenizer.model["end_of_word_suffix"]
        self.tokenizer, self.suffix = tokenizer, suffix
        pairs = (m.split(" ") if isinstance(m, str) else m for m in model["merges"])
        self.rank = {tuple(pair): k for k, pair in enumerate(pairs)}
        self.vocabulary: dict[str, int] = model["vocab"]
        self.text = {i: token for token, i in self.vocabulary.items()}
        self.inner = {t: i for t, i in self.vocabulary.items() if not t.endswith(suffix)}
        self.final = {t[: -len(suffix)]: i for t, i in self.vocabulary.items() if t.endswith(suffix)}
        self.length = {i: len(t.removesuffix(suffix)) for t, i in self.vocabulary.items()}
        self.packed = {i: np.array([i], "<u4").tobytes() for i in self.text}
        self.spelling = dict(enumerate(tokenizer.letters))
        self.longest_inner = max(map(len, self.inner))
        self.longest_final = max(map(len, self.final))
        self.pairs: dict[tuple[int, int], bool] = {}
        self.alone: dict[int, bool] = {}
        self.states = 0

    def _symbols(self, token: int) -> list[str]:
        text = self.text[token]
        if not text.endswith(self.suffix):
            return list(text)
        body = text[: -len(self.suffix)]
        return [*body[:-1], body[-1] + self.suffix]

    def _merged(self, parts: list[str]) -> list[str]:
        """Plain merging, lowest rank first and leftmost among equals; only for the symbols of two tokens."""
        while len(parts) > 1:
            ranks = [self.rank.get(pair, len(self.rank)) for pair in zip(parts, parts[1:])]
            best = min(ranks)
            if best == len(self.rank):
                break
            k = ranks.index(best)
            parts[k : k + 2] = [parts[k] + parts[k + 1]]
        return parts

    def _stands(self, before: int, token: int) -> bool:
        """Whether ``token`` stays whole after the token ``before`` (-1: at the start of a word)."""
        if before < 0:
            if token not in self.alone:
                self.alone[token] = self._merged(self._symbols(token)) == [self.text[token]]
            return self.alone[token]
        known = self.pairs.get((before, token))
        if known is None:
            if len(self.pairs) >= 4 * REMEMBERED:
                self.pairs.clear()
            made = self._merged(self._symbols(before) + self._symbols(token))
            known = self.pairs[before, token] = made == [self.text[before], self.text[token]]
        return known

    def _last(self, path: str, stop: int, last: list[int], tokens: dict[str, int], longest: int) -> int:
        """The last token of ``path[:stop]``; ``last[k]`` is that of ``path[:k]``."""
        for start in range(max(0, stop - longest), stop):
            token = tokens.get(path[start:stop])
            if token is not None and self._stands(last[start], token):
                return token
        raise ValueError("the vocabulary does not cover a symbol")

    def encode(self, words: list[str]) -> dict[str, bytes]:
        """Words to their ids as little-endian unsigned 32-bit numbers."""
        spelling, length, packed = self.spelling, self.length, self.packed
        spelled = sorted((w if w.isascii() and w.isprintable() else w.encode().decode("latin-1").translate(spelling), w) for w in words)
        found, path, last = {}, "", [-1]
        for letters, word in spelled:
            stem = letters[:-1]
            shared, most = 0, min(len(path), len(stem))
            while shared < most and path[shared] == stem[shared]:
                shared += 1
            del last[shared + 1 :]
            for stop in range(shared + 1, len(stem) + 1):
                last.append(self._last(stem, stop, last, self.inner, self.longest_inner))
            self.states += len(stem) - shared
            path = stem
            token = self._last(letters, len(letters), last, self.final, self.longest_final)
            ids = [packed[token]]
            at = len(letters) - length[token]
            while at > 0:
                token = last[at]
                ids.append(packed[token])
                at -= length[token]
            found[word] = b"".join(ids[::-1])
        return found


class Encoder:
    """Encodes texts of one worker; remembers words up to a bound."""

    def __init__(self, path: str):
        self.tokenizer = loaded(path)
        self.trie = PrefixTrie(self.tokenizer)
        library = self.tokenizer.library
        size = library.get_vocab_size(with_added_tokens=True)
        self.shown = [library.id_to_token(i) or "" for i in range(size)]
        self.known = self._start()

    def _start(self) -> dict[str, bytes]:
        return {text: np.array([i], "<u4").tobytes() for text, i in self.tokenizer.special.items()}

    def encode(self, texts: list[str | None]) -> list[bytes]:
        words = [self.tokenizer.words(text) if text else [] for text in texts]
        used = set().union(*words)
        missing = used.difference(self.known)
        if missing:
            if len(self.known) + len(missing) > REMEMBERED:  # keep what is in use
                self.known = self._start() | {w: self.known[w] for w in used - missing}
            self.known.update(self.trie.encode(list(missing)))
        return [b"".join(map(self.known.__getitem__, each)) for each in words]

    def decode(self, ids: bytes | None) -> str:
        numbers = np.frombuffer(ids or b"", "<u4").tolist()
        if self.tokenizer.library.decoder is None:
            return " ".join([self.shown[i] for i in numbers])
        return self.tokenizer.library.decode(numbers, skip_special_tokens=False)


@lru_cache(maxsize=2)
def _encoder(path: str) -> Encoder:
    return Encoder(path)


def encode_and_decode(docs: DataFrame, tokenizer: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key``, ``ids binary`` (little-endian unsigned 32-bit) and ``decoded string`` of every whole text.

    One pass without a shuffle: each slice of texts gives its distinct words, those not yet known to the
    worker go through the trie, and texts are put together from the words. Null and empty texts have no ids
    and decode to the empty string; null and repeated keys are passed on; other columns are not read.
    ``tokenizer`` is a path that every executor can open.
    """
    kind = docs.schema[key].dataType
    schema = pa.schema([("key", pa.int64()), ("ids", pa.binary()), ("decoded", pa.string())])

    def work(piece: pa.RecordBatch) -> dict:
        coder = _encoder(tokenizer)
        ids = coder.encode(piece.column("text").to_pylist())
        return {"key": piece.column("key"), "ids": ids, "decoded": [coder.decode(i) for i in ids]}

    rows = docs.select(F.col(key).cast("long").alias("key"), F.col(text).alias("text"))
    made = rows.mapInArrow(mapped(work, "text", schema), "key long, ids binary, decoded string")
    return made.select(F.col("key").cast(kind).alias(key), "ids", "decoded")


def decode(encoded: DataFrame, tokenizer: str, key: str = "doc_id", ids: str = "ids") -> DataFrame:
    """``key`` and ``decoded string`` from packed ids; null ids decode to the empty string."""
    schema = pa.schema([("key", pa.int64()), ("decoded", pa.string())])

    def work(piece: pa.RecordBatch) -> dict:
        coder = _encoder(tokenizer)
        return {"key": piece.column("key"), "decoded": [coder.decode(i) for i in piece.column("ids").to_pylist()]}

    rows = encoded.select(F.col(key).cast("long").alias("key"), F.col(ids).alias("ids"))
    return rows.mapInArrow(mapped(work, "ids", schema), "key long, decoded string").withColumnRenamed("key", key)
