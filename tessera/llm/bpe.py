"""Whole-text encoding by a tokenizers file, exactly as that library encodes, made quick.

Byte-level files whose merges follow their ids are run as ranks by tiktoken. So are files that
lower-case and mark the ends of words, for Latin-1 text: a capital, which such text no longer has,
stands for the mark. Anything else, and any text that the quick way refuses, goes through the library
itself. So does a text that holds the content of an added token, which the library gives its own id.
"""

from __future__ import annotations

import json
import os
import re
import unicodedata
from functools import cached_property, lru_cache

import numpy as np

#: Stands for the end of a word in lower-cased text.
MARK = "A"
#: Unicode white space of Latin-1: fixed values.
SPACES = "\t\n\x0b\x0c\r \x85\xa0"


def _byte_letters() -> dict[str, int]:
    """The letters that byte-level files write for the 256 bytes."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(rest)}


@lru_cache(2)
def codec(path: str) -> Bpe:
    """One Bpe for all tasks of a worker."""
    return Bpe(path)


class Bpe:
    """encode(texts) gives an array of ids for each text."""

    def __init__(self, path: str):
        self.path = path
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.size = len({*spec["model"]["vocab"].values(), *(t["id"] for t in spec.get("added_tokens", []))})
        #: Contents of added tokens, in lower case: where files lower-case, such text is matched too.
        self.added = [t["content"].lower() for t in spec.get("added_tokens", [])]
        self.ranks = self._ranks(spec)
        self.marked = None if self.ranks is not None else self._marked(spec)

    @cached_property
    def library(self):
        """The library's own tokenizer, loaded where the quick way can't serve."""
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        return Tokenizer.from_file(self.path)

    @staticmethod
    def _ranks(spec: dict):
        """A tiktoken encoding equal to the file, if there is one."""
        model, split = spec["model"], spec.get("pre_tokenizer") or {}
        if spec.get("normalizer") or split.get("type") != "ByteLevel" or split.get("add_prefix_space") or not split.get("use_regex"):
            return None
        if any(model.get(k) for k in ("continuing_subword_prefix", "end_of_word_suffix", "ignore_merges", "byte_fallback", "dropout")):
            return None
        letters, vocab = _byte_letters(), model["vocab"]
        special = {t["content"] for t in spec.get("added_tokens", [])}
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        if [vocab.get(a + b) for a, b in merges] != list(range(256, 256 + len(merges))):
            return None
        ranks = {bytes(letters[c] for c in piece): i for piece, i in vocab.items() if piece not in special}
        if len(ranks) != 256 + len(merges):
            return None
        import tiktoken
        from public_tokenizers import PATTERN

        return tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})

    @staticmethod
    def _marked(spec: dict):
        """(encoding, its ids as the file's, pattern) for files that mark ends of lower-cased words."""
        model = spec["model"]
        end = model.get("end_of_word_suffix")
        steps = (spec.get("pre_tokenizer") or {}).get("pretokenizers") or [{}]
        first, norm = steps[0], [n.get("type") for n in (spec.get("normalizer") or {}).get("normalizers", [])]
        words = first.get("type") == "Split" and first.get("behavior") == "Removed" and first.get("invert") and "Regex" in first.get("pattern", {})
        plain = all(s.get("type") == "ByteLevel" and not s.get("add_prefix_space") and not s.get("use_regex") for s in steps[1:])
        if not (end and words and plain and norm == ["NFC", "Replace", "Lowercase"]) or any(model.get(k) for k in ("continuing_subword_prefix", "ignore_merges", "byte_fallback", "dropout")):
            return None
        letters, vocab = _byte_letters(), model["vocab"]
        raw = lambda piece: bytes(letters[c] for c in piece.removesuffix(end)) + (MARK.encode() if piece.endswith(end) else b"")
        order = [*letters, *(c + end for c in letters), *("".join(m.split(" ") if isinstance(m, str) else m) for m in model["merges"])]
        ranks = {raw(piece): i for i, piece in reversed([*enumerate(order)])}
        if any(p not in vocab for p in order):
            return None
        # Two-letter pieces with the mark itself as a letter never occur: the text has no capital.
        import tiktoken

        encoding = tiktoken.Encoding("marked", pat_str=f"[^{MARK}]*{MARK}", mergeable_ranks={k: i for i, k in enumerate(sorted(ranks, key=ranks.get))}, special_tokens={})
        ids = np.array([vocab[order[ranks[k]]] for k in sorted(ranks, key=ranks.get)], "<u4")
        pattern = first["pattern"]["Regex"]
        latin = [chr(c) for c in range(256)]
        for name, own in ((r"\s", SPACES), (r"\p{L}", [c for c in latin if unicodedata.category(c)[0] == "L"]), (r"\p{N}", [c for c in latin if unicodedata.category(c)[0] == "N"])):
            pattern = pattern.replace(name, "".join(map(re.escape, own)))
        return encoding, ids, re.compile(pattern)

    def _plain(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, "<u4") for e in self.library.encode_batch_fast(texts, add_special_tokens=False)]

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        if self.ranks is None and self.marked is None:
            return self._plain(texts)
        quick = self._ended if self.ranks is None else self._ranked
        return [self._plain([t])[0] if self._adds(t) else quick(t) for t in texts]

    def _adds(self, text: str) -> bool:
        lower = text.lower()
        return any(c in lower for c in self.added)

    def _ranked(self, text: str) -> np.ndarray:
        try:
            return np.array(self.ranks.encode_ordinary(text), "<u4")
        except BaseException as e:  # a panic of the quick library is no Exception
            if isinstance(e, (KeyboardInterrupt, SystemExit)):
                raise
            return self._plain([text])[0]

    def _ended(self, text: str) -> np.ndarray:
        encoding, ids, pattern = self.marked
        try:
            text.encode("latin-1")
        except UnicodeEncodeError:
            return self._plain([text])[0]
        words = pattern.findall(text.lower())
        if not words:
            return np.empty(0, "<u4")
        try:
            return ids[np.array(encoding.encode_ordinary(MARK.join(words) + MARK), np.int64)]
        except BaseException as e:
            if isinstance(e, (KeyboardInterrupt, SystemExit)):
                raise
            return self._plain([text])[0]
