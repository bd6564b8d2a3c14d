"""Token ids of a public byte-level BPE vocabulary, as the ``tokenizers`` library gives them.

The merges of the vocabulary file are run by ``tiktoken``, whose ids are in the order of the
merges and which is several times faster; a text that holds a special token goes to ``tokenizers``
itself. The vocabulary file is a parameter: a path that every executor has, or by
default the file of the installed ``public_tokenizers``.
"""

from __future__ import annotations

import json

import numpy as np

VOCABULARY = "byte_bpe_50k.json"
END = 0  # the id that closes every document
_LOADED: dict[str, TokenIds] = {}


def vocabulary_path(name: str) -> str:
    if "/" in name:
        return name
    import public_tokenizers

    return public_tokenizers.path(name)


def _byte_of() -> dict[str, int]:
    """Byte-level vocabularies write visible Latin-1 characters as they are and the other bytes from U+0100 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class TokenIds:
    """Ids of texts, as little-endian unsigned 16 bit numbers."""

    def __init__(self, name: str):
        import public_tokenizers
        import tiktoken
        from tokenizers import Tokenizer

        path = vocabulary_path(name)
        self.tokenizer = Tokenizer.from_file(path)
        if self.tokenizer.get_vocab_size() > 1 << 16:
            raise ValueError("ids are kept in 16 bits")
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        with open(path, encoding="utf-8") as f:
            vocab = json.load(f)["model"]["vocab"]
        byte = _byte_of()
        ranks = {bytes(byte[c] for c in token): i for token, i in vocab.items() if token not in self.special}
        self.merge = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary

    def document(self, text: str | None) -> bytes:
        """Ids of a text and the closing id."""
        text = text or ""
        if any(s in text for s in self.special):
            ids = self.tokenizer.encode(text, add_special_tokens=False).ids
        else:
            ids = self.merge(text)
        return np.array([*ids, END], np.uint16).tobytes()


def token_ids(name: str = VOCABULARY) -> TokenIds:
    """The ids of a vocabulary, loaded once in a Python worker."""
    if name not in _LOADED:
        _LOADED[name] = TokenIds(name)
    return _LOADED[name]
