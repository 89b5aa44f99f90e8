"""Providers that ask a service over HTTP.

The transport is a callable (url, headers, body, timeout) -> (status, headers,
body), so that services can be stood in for; by default it is urllib.
"""

from __future__ import annotations

import json
import urllib.error
import urllib.request
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np

from .batching import BAD_INPUT, FatalProviderError, ProviderError, retry_after

Transport = Callable[[str, dict, bytes, float], tuple[int, dict, bytes]]
#: Statuses, and faults of a request, that no other input mends.
REFUSED = (401, 403, 404)
CONFIGURED = {"model", "dimensions", "deployment", "deploymentnotfound", "invalidmodel", "invaliddeployment"}


def urllib_transport(url: str, headers: dict, body: bytes, timeout: float) -> tuple[int, dict, bytes]:
    request = urllib.request.Request(url, body, headers)
    try:
        with urllib.request.urlopen(request, timeout=timeout) as answer:
            return answer.status, dict(answer.headers), answer.read()
    except urllib.error.HTTPError as e:
        return e.code, dict(e.headers), e.read()
    except OSError as e:
        raise ProviderError(f"{type(e).__name__}: {e}"[:250]) from e


def _faults(body: bytes) -> set[str]:
    """What an answer says is wrong with a request."""
    try:
        error = json.loads(body).get("error") or {}
        return {str(error.get(k, "")).lower() for k in ("param", "code")}
    except (ValueError, AttributeError):
        return set()


@dataclass(frozen=True)
class Client:
    url: str
    headers: tuple[tuple[str, str], ...] = ()
    timeout: float = 90.0
    transport: Transport = urllib_transport

    def ask(self, body: dict) -> dict:
        status, headers, answer = self.transport(self.url, {"Content-Type": "application/json"} | dict(self.headers), json.dumps(body).encode(), self.timeout)
        if status in REFUSED or (status in BAD_INPUT and _faults(answer) & CONFIGURED):
            raise FatalProviderError(f"HTTP {status}: {answer[:300].decode('utf-8', 'replace')}", status)
        if not 200 <= status < 300:
            raise ProviderError(f"HTTP {status}: {answer[:500].decode('utf-8', 'replace')}", status, retry_after(headers))
        try:
            return json.loads(answer)
        except ValueError as e:
            raise ProviderError(f"no JSON: {e}") from e


@dataclass(frozen=True)
class HttpEmbedder:
    client: Client
    model: str
    dimensions: int

    def __call__(self, texts: list[str]) -> list[list[float]]:
        found = self.client.ask({"model": self.model, "input": texts, "dimensions": self.dimensions})
        try:
            by_place = {int(x["index"]): x["embedding"] for x in found["data"]}
            vectors = [np.asarray(by_place[i], float) for i in range(len(texts))]
        except (KeyError, TypeError, ValueError) as e:
            raise ProviderError(f"the answer does not fit the inputs: {e!r}") from e
        if len(by_place) != len(texts) or any(v.shape != (self.dimensions,) or not np.isfinite(v).all() or not v.any() for v in vectors):
            raise ProviderError("the answer has vectors that are not valid")
        return [v.tolist() for v in vectors]


@dataclass(frozen=True)
class HttpChat:
    client: Client
    model: str

    def __call__(self, messages: list[dict]) -> str:
        try:
            return self.client.ask({"model": self.model, "messages": messages})["choices"][0]["message"]["content"]
        except (KeyError, IndexError, TypeError) as e:
            raise ProviderError(f"the answer has no message: {e!r}") from e


def limits(client: Client, model: str) -> dict[str, str]:
    """What the service says of its rate limits, by one small request."""
    _, headers, _ = client.transport(client.url, {"Content-Type": "application/json"} | dict(client.headers), json.dumps({"model": model, "input": ["x"]}).encode(), client.timeout)
    return {k.lower(): v for k, v in headers.items() if "ratelimit" in k.lower()}
