"""Token ids of texts inside tasks, by a tokenizer file of the `tokenizers` library.

Byte-level files with the usual word pattern have a fast path: for Latin-1 texts without special tokens, `tiktoken`
merges by the same file's vocabulary, which gives the ids that `tokenizers` gives, several times as fast. In the usual
word pattern the last character of a run of white space goes with the word after it, which takes a lookahead; cutting
the texts there first lets the pattern do without, and the search for words takes a third less time. All other texts
and files go through `tokenizers`. Tests compare both.
"""

from __future__ import annotations

import json
import os
from array import array
from functools import cached_property

import numpy as np

# The word pattern of byte-level tokenizers without the lookahead of its white space, the Latin-1 white
# space of that pattern, and the bytes that stand for themselves in their vocabulary.
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+"
SPACE = np.isin(np.arange(256), [*range(9, 14), 32, 0x85, 0xA0])
UNUSED = "\uffff"  # tiktoken looks for special tokens in every text; this one is in no Latin-1 text
VISIBLE = [*range(33, 127), *range(161, 173), *range(174, 256)]
_ENCODERS: dict = {}


def byte_of() -> dict[str, int]:
    """The vocabulary's character for every byte: itself if visible, else the next free one from 256 on."""
    hidden = [b for b in range(256) if b not in VISIBLE]
    return {chr(b): b for b in VISIBLE} | {chr(256 + n): b for n, b in enumerate(hidden)}


def _merger(path: str):
    """A tiktoken encoding of the file, and its special tokens; None if the file has other rules."""
    with open(path, encoding="utf-8") as file:
        told = json.load(file)
    model, before = told["model"], told.get("pre_tokenizer") or {}
    plain = before.get("type") == "ByteLevel" and before.get("use_regex", True) and not before.get("add_prefix_space")
    if model.get("type") != "BPE" or not plain or told.get("normalizer"):
        return None
    special = [t["content"] for t in told.get("added_tokens", [])]
    byte = byte_of()
    ranks = {bytes(byte[c] for c in w): i for w, i in model["vocab"].items() if w not in special}
    merges = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
    made = [model["vocab"][a + b] for a, b in merges]
    if made != sorted(made):  # ids must follow the order of the merges
        return None
    import tiktoken

    unused = {UNUSED: max(model["vocab"].values(), default=0) + 1}
    return tiktoken.Encoding("own", pat_str=WORDS, mergeable_ranks=ranks, special_tokens=unused), special


def stretches(text: str, latin: bytes) -> list[str]:
    """The text, of these Latin-1 bytes, cut before the last character of each run of white space inside it."""
    space = SPACE[np.frombuffer(latin, np.uint8)]
    run = space[1:] & space[:-1]
    if not run.any():
        return [text]
    cuts = np.flatnonzero(run[:-1] & ~space[2:]) + 1
    return [text[i:j] for i, j in zip([0, *cuts.tolist()], [*cuts.tolist(), len(text)], strict=True)]


class Encoder:
    """Ids of texts, as arrays or as bytes in the byte order of the machine (little-endian where Spark runs)."""

    def __init__(self, path: str):
        self.path = path
        self.fast, self.special = _merger(path) or (None, [])

    @cached_property
    def tokenizer(self):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        return Tokenizer.from_file(self.path)

    def _latin(self, text: str) -> bytes | None:
        """The text's Latin-1 bytes if both libraries give it the same ids."""
        if self.fast is None or any(s in text for s in self.special):
            return None
        try:
            return text.encode("latin-1")
        except UnicodeEncodeError:
            return None

    def ids(self, text: str) -> np.ndarray:
        """Unsigned 32-bit ids."""
        latin = self._latin(text)
        if latin is None:
            return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, np.uint32)
        found = [self.fast.encode_to_numpy(part, disallowed_special=()) for part in stretches(text, latin)]
        return found[0] if len(found) == 1 else np.concatenate(found)

    def plain(self, texts: list[str]) -> list[bytes]:
        return [array("I", self.tokenizer.encode(t, add_special_tokens=False).ids).tobytes() for t in texts]

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids' bytes."""
        return [self.ids(t).tobytes() for t in texts]


def encoder(path: str) -> Encoder:
    """The worker's encoder for this file."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def default_tokenizer() -> str:
    """The 50k byte-level vocabulary of the public tokenizer files."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def word_tokenizer() -> str:
    """The 49k vocabulary with word ends of the public tokenizer files."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")
