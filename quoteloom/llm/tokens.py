"""Token ids and character spans of whole texts, by a ``tokenizers`` file.

Where the file is a plain byte-level BPE whose ids follow its merges, ``tiktoken`` encodes
with ranks read out of that very file: the same ids, in a fifth of the time.  Any other file,
and any text with white space beyond blank, tab, line feed and carriage return (on which the
two libraries' patterns differ), is left to ``tokenizers``.
"""

from __future__ import annotations

import json
import os
import re
from functools import lru_cache

import numpy as np

ODD_SPACE = re.compile("[\\x0b\\x0c\\x1c-\\x1f\\x85\\xa0\\u1680\\u180e\\u2000-\\u200b\\u2028\\u2029\\u202f\\u205f\\u3000\\ufeff]")
PLAIN = {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": True}
# Fixed value: the split pattern of the byte-level pre-tokenizer.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def byte_alphabet() -> dict[str, int]:
    """The printable stand-ins of byte-level vocabularies, back to bytes."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


def ranks_of(path: str) -> dict[bytes, int] | None:
    """Byte ranks of a plain byte-level BPE file; None if its ids don't follow its merges."""
    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    model, to_byte = spec["model"], byte_alphabet()
    plain = (
        model.get("type") == "BPE" and spec.get("normalizer") is None and spec.get("post_processor") is None
        and spec.get("pre_tokenizer") == PLAIN and not model.get("ignore_merges") and not model.get("dropout")
        and not model.get("continuing_subword_prefix") and not model.get("end_of_word_suffix")
    )
    if not plain:
        return None
    special = {t["content"] for t in spec["added_tokens"]}
    vocab, merges = model["vocab"], model["merges"]
    for k, merge in enumerate(merges):
        a, b = merge.split(" ") if isinstance(merge, str) else merge
        if vocab.get(a + b) != 256 + k:
            return None
    words = {t: i for t, i in vocab.items() if t not in special}
    if len(words) != 256 + len(merges):
        return None
    return {bytes(to_byte[c] for c in t): i for t, i in words.items()}


class Encoder:
    """Token ids and spans by the file at ``path``; strings of special tokens inside a text
    are ordinary text."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self.dtype = np.dtype("<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4")
        self._fast, ranks = None, ranks_of(path)
        if ranks:
            import tiktoken

            self._fast = tiktoken.Encoding("file", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
            self._n_bytes = np.zeros(max(ranks.values()) + 1, np.int64)
            for token, i in ranks.items():
                self._n_bytes[i] = len(token)

    def ids(self, text: str) -> bytes:
        """The text's ids as little-endian integers of ``dtype``."""
        if self._fast is None or ODD_SPACE.search(text):
            ids = self.tokenizer.encode(text, add_special_tokens=False).ids
        else:
            ids = self._fast.encode_ordinary(text)
        return np.array(ids, self.dtype).tobytes()

    def spans(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """First and past-the-last character of each token; a character that is cut into
        several tokens belongs to each of them."""
        if self._fast is None or ODD_SPACE.search(text):
            offsets = self.tokenizer.encode(text, add_special_tokens=False).offsets
            both = np.array(offsets, np.int64).reshape(-1, 2)
            return both[:, 0], both[:, 1]
        ends = np.cumsum(self._n_bytes[np.frombuffer(self.ids(text), self.dtype)])
        starts = np.concatenate([np.zeros(1, np.int64), ends[:-1]]) if len(ends) else ends
        if text.isascii():
            return starts, ends
        first_bytes = (np.frombuffer(text.encode(), np.uint8) & 0xC0) != 0x80
        char_of = np.cumsum(first_bytes) - 1
        return char_of[starts], char_of[ends - 1] + 1


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """One encoder for each worker process and file."""
    return Encoder(path)


def default_path() -> str:
    """The vocabulary file that the queries use; operators take any path."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")
