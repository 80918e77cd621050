"""Ids of byte-level pair vocabularies by ranks.

A vocabulary file whose merges come in the order of their tokens' ids says no more than a table of ranks, which the rank
library encodes without building offsets and masks.  Texts that the two libraries might cut differently (letters beyond the extended
Latin ones, whose classes change between editions of the character tables; long runs of white space; names of added tokens) go
to the file's own library, as do all texts of a file that isn't of this kind.
"""

from __future__ import annotations

import json
import re
from functools import lru_cache

import numpy as np
import tiktoken

from .token_counts import load

#: Fixed value: how byte-level vocabularies cut a text before pairs are merged.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
OTHER_LETTERS, SPACES = re.compile(r"[^\x00-\u024f\u2010-\u2027\u2030-\u203a\u20ac]"), re.compile(r"\s{200}")
#: Only runs that are far longer than this could be too deep for the rank library.
LONG_TEXT = 20_000


def byte_symbols() -> dict[str, int]:
    """Byte-level files write printable bytes as themselves and the others as code points from 256 on."""
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


def ranks_of(path: str) -> dict[bytes, int] | None:
    """Token to rank, if ranks say all that the file does; else null."""
    with open(path, encoding="utf-8") as f:
        file = json.load(f)
    model, cut = file["model"], file["pre_tokenizer"] or {}
    plain = model["type"] == "BPE" and cut.get("type") == "ByteLevel" and cut.get("use_regex", True) and not cut.get("add_prefix_space") and file["normalizer"] is None
    if not plain or any(model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges")):
        return None
    added, symbols = {a["content"] for a in file["added_tokens"]}, byte_symbols()
    merged = ["".join(m if isinstance(m, list) else m.split(" ")) for m in model["merges"]]
    ids = [model["vocab"].get(m) for m in merged]
    tokens = {t: i for t, i in model["vocab"].items() if t not in added}
    if ids != list(range(256, 256 + len(ids))) or len(tokens) != 256 + len(ids):
        return None
    return {bytes(symbols[c] for c in t): i for t, i in tokens.items()}


class RankEncoder:
    """Ids of texts as the file's library gives them, without special tokens added."""

    def __init__(self, path: str):
        self.library, ranks = load(path), ranks_of(path)
        self.by_rank = tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={}) if ranks else None
        self.names = [a.content for a in self.library.get_added_tokens_decoder().values()]

    def is_doubtful(self, text: str) -> bool:
        return bool(OTHER_LETTERS.search(text)) or any(n in text for n in self.names) or len(text) > LONG_TEXT and bool(SPACES.search(text))

    def encode(self, text: str) -> np.ndarray:
        if self.by_rank is None or self.is_doubtful(text):
            return np.array(self.library.encode(text, add_special_tokens=False).ids, "<u4")
        return self.by_rank.encode_to_numpy(text, disallowed_special=()).astype("<u4", copy=False)


@lru_cache(maxsize=2)
def rank_encoder(path: str) -> RankEncoder:
    """The worker's encoder, for all its tasks."""
    return RankEncoder(path)
