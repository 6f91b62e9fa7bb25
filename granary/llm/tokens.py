"""Token ids of many texts, as the tokenizers library gives them for a file.

Files of a kind that :mod:`granary.llm.transducer` understands go through its table; the first texts that a worker meets
are encoded by the library as well and must agree. Any other file is left to the library.
"""

from __future__ import annotations

import os

import numpy as np

from granary.llm.transducer import transducer

#: Texts of a worker that the library encodes again.
HELD_AGAINST = 50
_encoders: dict[str, "Encoder"] = {}


def encoder(path: str) -> "Encoder":
    """The worker's encoder for a file; it stays from task to task."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


class Encoder:
    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # the tasks of an executor share its cores already
        from tokenizers import Tokenizer

        try:
            self.table = transducer(path)
            self.library = self.table.library
        except ValueError:
            self.table = None
            self.library = Tokenizer.from_file(path)
            self.library.no_truncation()
            self.library.no_padding()
        self.compared = 0

    def _by_library(self, texts: list[str]) -> list[bytes]:
        found = self.library.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, np.uint32).tobytes() for e in found]

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        if self.table is None:
            return self._by_library(texts)
        out = self.table.encode(texts)
        if self.compared < HELD_AGAINST:
            some = texts[: HELD_AGAINST - self.compared]
            if self._by_library(some) != out[: len(some)]:
                raise AssertionError("the compiled table disagrees with the tokenizers library")
            self.compared += len(some)
        return out
