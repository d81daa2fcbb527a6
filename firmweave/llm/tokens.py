"""Token ids of whole texts by the tokenizers library, each distinct word encoded once per worker.

White space separates words in this vocabulary's rules, so a text's ids are its words' ids one after the
other. Words repeat, so a worker process keeps the ids of the words it has met lately, about CACHE_WORDS of them at most.
A word of plain Latin letters with trailing punctuation is looked up as its lower-case letters and its
punctuation; any other word goes to the library as it is. All that holds for vocabularies that lower-case, drop white space and mark
the ends of words; with any other one whole texts go to the library.
"""

from __future__ import annotations

import gc
import json
import os
import re
import sys
import types
import zlib

import numpy as np

CACHE_WORDS = 1_000_000

_PLAIN = re.compile("([A-Za-zÀ-ÖØ-öø-ÿ]+)([.,;:!?#*$%&|]*)")


class _Known(dict):
    """Ids by word; a word of the generation before comes over, one that isn't there either is noted, in order."""

    missed: list[bytes]

    def __init__(self, before: dict[bytes, bytes]) -> None:
        super().__init__()
        self.before = before

    def __missing__(self, word: bytes) -> bytes | None:
        ids = self.before.get(word)
        if ids is None:
            self.missed.append(word)
        else:
            self[word] = ids
        return ids


def splits_words(rules: dict) -> bool:
    """Whether a tokenizer's rules (its file) give a text's ids as those of its lower-cased words, one after the other."""
    normal, cut, model = rules.get("normalizer") or {}, rules.get("pre_tokenizer") or {}, rules.get("model") or {}
    first = (cut.get("pretokenizers") or [cut])[0]
    pattern = (first.get("pattern") or {}).get("Regex", "")
    return (
        any(x.get("type") == "Lowercase" for x in normal.get("normalizers") or [normal])
        and first.get("type") == "Split" and first.get("behavior") == "Removed" and first.get("invert") is True
        and pattern.endswith(r"|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")
        and model.get("end_of_word_suffix") == "</w>" and model.get("dropout") is None
    )


class WordEncoder:
    """Encodes texts word by word; ``encode(text)`` gives the ids as little-endian unsigned 16-bit bytes."""

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        if self.tokenizer.get_vocab_size() > 65536:
            raise ValueError("ids beyond 16 bits")
        self.last = np.zeros(65536, bool)  # ids that end a word
        for token, i in self.tokenizer.get_vocab().items():
            self.last[i] = token.endswith("</w>")
        self.by_word = splits_words(json.loads(self.tokenizer.to_str()))
        self.words = _Known({})
        self.parts: dict[str, bytes] = {}

    @classmethod
    def of_worker(cls, path: str) -> WordEncoder:
        """The encoder of this process: it outlives a task, so its words serve the next one."""
        held = sys.modules.setdefault("_word_encoders", types.ModuleType("_word_encoders"))
        return held.__dict__.setdefault(path, cls(path) if path not in held.__dict__ else None)

    def _library(self, texts: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(x.ids, "<u2").tobytes() for x in found]

    def _single(self, parts: list[str]) -> list[bytes]:
        """Ids of parts that are one word each to the library, many in one text; the ids that end a word split them."""
        out = []
        for i in range(0, len(parts), 256):
            own = parts[i : i + 256]
            ids = np.frombuffer(self._library([" ".join(own)])[0], "<u2")
            ends = np.flatnonzero(self.last[ids]) + 1
            if len(ends) != len(own) or ends[-1] != len(ids):
                out += self._library(own)
            else:
                data, at = ids.tobytes(), [0, *(2 * ends).tolist()]
                out += [data[a:b] for a, b in zip(at[:-1], at[1:], strict=True)]
        return out

    def _learn(self, missing: list[bytes]) -> None:
        if len(self.words) + len(missing) > CACHE_WORDS // 2:
            self.words.before = {}
            self.words = _Known(self.words)
        if len(self.parts) > CACHE_WORDS:
            self.parts.clear()
        split, other, parts = [], [], set()
        for word in missing:
            if word.isalpha():  # of ASCII letters, as most are
                split.append((word, letters := word.lower().decode(), ""))
                parts.add(letters)
                continue
            text = word.decode()
            plain = _PLAIN.fullmatch(text)
            if plain:
                split.append((word, letters := plain[1].lower(), plain[2]))
                parts.add(letters)
                if plain[2]:
                    parts.add(plain[2])
            else:
                other.append((word, text))
        fresh = [p for p in parts if p not in self.parts]
        self.parts.update(zip(fresh, self._single(fresh), strict=True))
        for word, letters, marks in split:
            self.words[word] = self.parts[letters] + (self.parts[marks] if marks else b"")
        self.words.update(zip([w for w, _ in other], self._library([t for _, t in other]), strict=True))

    def encode_all(self, texts: list[str | bytes | None]) -> list[bytes]:
        """Ids of each text (or its UTF-8 bytes) as little-endian unsigned 16-bit values; a null text is empty."""
        if not self.by_word:
            return self._library([(t.decode() if isinstance(t, bytes) else t) or "" for t in texts])
        gc.disable()  # the many small objects here are freed by count
        self.words.missed = missed = []
        split, misses = [], [0]
        for t in texts:
            split.append(list(map(self.words.__getitem__, (t if isinstance(t, bytes) else t.encode()).split())) if t else [])
            misses.append(len(missed))
        if missed:
            fresh = set(missed)
            self._learn(list(fresh))
            known = self.words
            for ids, first, end in zip(split, misses[:-1], misses[1:], strict=True):
                at = -1
                for word in missed[first:end]:
                    at = ids.index(None, at + 1)
                    ids[at] = known[word]
        out = [b"".join(ids) for ids in split]
        gc.enable()
        return out


def crc32_of(ids: np.ndarray) -> int:
    """Unsigned crc32 of ids as little-endian unsigned 32-bit integers."""
    return zlib.crc32(ids.astype("<u4").tobytes())
