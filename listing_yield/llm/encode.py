"""Byte-level BPE ids of whole texts, from a public vocabulary file named by a parameter.

``VOCABULARY`` names a rank file (``.tiktoken``); its ids equal those of the ``tokenizers`` JSON file of the same
vocabulary (tests compare the two). Files are opened on each worker through the installed ``public_tokenizers``
package; they are part of the Python environment, not data, and are never copied.
"""

from __future__ import annotations

import base64
from array import array

VOCABULARY = "byte_bpe_50k.tiktoken"

_encoders: dict[str, "Encoder"] = {}


class Encoder:
    def __init__(self, vocabulary: str = VOCABULARY):
        import public_tokenizers
        import tiktoken

        with open(public_tokenizers.path(vocabulary), "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.tokens = ranks
        self._encode = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks,
                                         special_tokens={}).encode_ordinary

    def ids(self, text: str) -> bytes:
        """The text's ids as little-endian unsigned 32-bit numbers."""
        return array("I", self._encode(text)).tobytes()


def encoder(vocabulary: str = VOCABULARY) -> Encoder:
    """One encoder for each worker process and vocabulary."""
    if vocabulary not in _encoders:
        _encoders[vocabulary] = Encoder(vocabulary)
    return _encoders[vocabulary]
