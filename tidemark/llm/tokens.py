"""Byte-level BPE ids, as the tokenizers library gives them for a tokenizer file.

Cases.  The empty text has no ids.  Texts of any length are encoded whole; runs of white space beyond LONG_RUN, for which
the fast encoder's matcher would run out of its stack (at about a million characters), go through tokenizers.
"""

from __future__ import annotations

import functools
import json
import os
import re
from collections.abc import Callable


LONG_RUN = 50_000
_LONG_SPACE = re.compile(r"\s{%d}" % LONG_RUN)


def _printable_bytes() -> dict[str, int]:
    """The usual byte-level alphabet: printable Latin-1 stands for itself, other bytes for U+0100 onwards."""
    own = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    shifted = {chr(256 + k): b for k, b in enumerate(b for b in range(256) if b not in own)}
    return {chr(b): b for b in own} | shifted


def _fast_encoder(spec: dict):
    """A tiktoken encoder with the same ids, or None if the file is not plain byte-level BPE in rank order."""
    model, split = spec["model"], spec.get("pre_tokenizer") or {}
    plain = model.get("type", "BPE") == "BPE" and split.get("type") == "ByteLevel" and not split.get("add_prefix_space") and split.get("use_regex", True)
    if not plain or spec.get("normalizer") or model.get("dropout") or model.get("ignore_merges"):
        return None
    import public_tokenizers
    import tiktoken

    special = {x["content"] for x in spec.get("added_tokens", [])}
    alphabet = _printable_bytes()
    ranks = {bytes(alphabet[c] for c in piece): k for piece, k in model["vocab"].items() if piece not in special}
    merged = [model["vocab"]["".join(m if isinstance(m, list) else m.split(" "))] for m in model["merges"]]
    if merged != sorted(merged):
        return None
    return tiktoken.Encoding("byte-level", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


@functools.lru_cache(maxsize=2)
def encoder(path: str) -> Callable[[str], list[int]]:
    """text -> ids, equal to Tokenizer.from_file(path).encode(text, add_special_tokens=False).ids.

    Byte-level BPE files go through tiktoken, which is about four times as fast; texts that hold an added token's
    string or a very long run of white space, and other kinds of file, go through tokenizers.
    """
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    from tokenizers import Tokenizer

    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    exact = Tokenizer.from_file(path)
    fast = _fast_encoder(spec)
    added = [x["content"] for x in spec.get("added_tokens", [])]

    def slow(text: str) -> list[int]:
        return exact.encode(text, add_special_tokens=False).ids

    if fast is None:
        return slow

    def encode(text: str) -> list[int]:
        if any(a in text for a in added) or (len(text) >= LONG_RUN and _LONG_SPACE.search(text)):
            return slow(text)
        return fast.encode_ordinary(text)

    return encode
