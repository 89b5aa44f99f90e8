"""Offline stand-ins for model services: deterministic, so results can be tested.

A provider is a callable that executors can load. Real services implement the
same calls; nothing else of the engine knows about them.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np

from .batching import ProviderError


@dataclass(frozen=True)
class HashEmbedder:
    """Unit vectors of hashed words: similar texts have similar vectors."""

    dimensions: int = 64

    def __call__(self, texts: list[str]) -> list[list[float]]:
        return [self._one(t) for t in texts]

    def _one(self, text: str) -> list[float]:
        out = np.zeros(self.dimensions)
        for word in text.lower().split() or [""]:
            h = int.from_bytes(hashlib.blake2b(word.encode(), digest_size=8).digest(), "little")
            out[h % self.dimensions] += 1.0 if h >> 63 else -1.0
        if not out.any():
            out[0] = 1.0
        return (out / np.linalg.norm(out)).tolist()


@dataclass(frozen=True)
class EchoChat:
    """Answers with the first line of the context that the messages hold."""

    def __call__(self, messages: list[dict]) -> str:
        text = messages[-1]["content"]
        return next((line for line in text.split("CONTEXT CHUNKS:\n")[-1].splitlines() if line.strip()), "NO_CONTEXT")


@dataclass(frozen=True)
class StoredOcr:
    """Looks images up by their hash, as a recogniser would return them."""

    known: dict[str, tuple[str, float]]

    def __call__(self, images: list[bytes]) -> list[tuple[str, float]]:
        return [self.known.get(hashlib.sha256(i).hexdigest(), ("", 0.0)) for i in images]


@dataclass(frozen=True)
class Refusing:
    """Embeds as HashEmbedder does, but refuses requests with a text that holds a word."""

    word: str
    reason: str
    dimensions: int = 8

    def __call__(self, texts: list[str]) -> list[list[float]]:
        if any(self.word in t for t in texts):
            raise ProviderError(self.reason, 400)
        return HashEmbedder(self.dimensions)(texts)


@dataclass(frozen=True)
class FirstWords:
    """Summarises by the first words."""

    words: int = 12

    def __call__(self, texts: list[str]) -> list[str]:
        return [" ".join(t.split()[: self.words]) for t in texts]


@dataclass(frozen=True)
class PlainTextParser:
    """Reads UTF-8 text as a file: form feeds part pages, of one text element each."""

    def __call__(self, content: bytes) -> tuple[list, list[dict]]:
        if not content:
            raise ValueError("broken file")
        pages = enumerate(content.decode("utf-8").split("\f"), 1)
        return [], [{"page": n, "kind": "text", "x0": 0.0, "y0": 0.0, "x1": 1.0, "y1": 1.0, "text": text} for n, text in pages]
