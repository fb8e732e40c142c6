"""JSON over HTTP for remote tables, sinks and embedding services, with bounded retries."""

from __future__ import annotations

import json
import random
import time
import urllib.error
import urllib.request
from collections.abc import Callable
from dataclasses import dataclass
from typing import Any


class TooLong(Exception):
    """A text is longer than the embedder takes."""


class Unavailable(Exception):
    """Worth another attempt. ``status``: 408, 429 or 5xx where the service gave one."""

    def __init__(self, status: int | None = None):
        super().__init__(f"status {status}")
        self.status = status


@dataclass(frozen=True)
class Retry:
    """Doubling delays with a little jitter; a service that is told to slow down waits longer."""

    attempts: int = 8
    base_s: float = 2.0
    busy_s: float = 5.0
    most_s: float = 60.0
    jitter_s: float = 1.0

    def delay(self, attempt: int, status: int | None) -> float:
        base = self.busy_s if status == 429 else self.base_s
        return min(base * 2 ** (attempt - 1), self.most_s) + random.random() * self.jitter_s

    def run(self, f: Callable[[], Any]) -> Any:
        """``f()``, again after each ``Unavailable`` until the attempts are used up."""
        for attempt in range(1, self.attempts + 1):
            try:
                return f()
            except Unavailable as e:
                time.sleep(self.delay(attempt, e.status))
        return f()

    def call(self, f: Callable[[list[str]], list], texts: list[str]) -> list:
        found = self.run(lambda: f(texts))
        if len(found) != len(texts):
            raise ValueError(f"{len(found)} vectors for {len(texts)} texts")
        return found


#: Of a source's pages: no jitter, half a minute at most.
PAGES = Retry(base_s=2, busy_s=2, most_s=30, jitter_s=0)


def request(url: str, body: Any = None, method: str | None = None, token: str | None = None, timeout_s: float = 90) -> Any:
    """The answer's JSON (None for an empty one). Timeouts, lost connections, 408, 429 and 5xx are ``Unavailable``, a text
    over the service's limit is ``TooLong``, other refusals are errors with the answer's beginning."""
    head = {"content-type": "application/json"} | ({"authorization": f"Bearer {token}"} if token else {})
    asked = urllib.request.Request(url, None if body is None else json.dumps(body, ensure_ascii=False).encode(), head, method=method)
    try:
        with urllib.request.urlopen(asked, timeout=timeout_s) as answer:
            raw = answer.read()
    except urllib.error.HTTPError as e:
        told = e.read()[:2000].decode("utf-8", "replace")
        if e.code in (408, 429) or e.code >= 500:
            raise Unavailable(e.code) from None
        if e.code == 400 and "maximum context length" in told:
            raise TooLong(told) from None
        raise RuntimeError(f"{e.code}: {told}") from None
    except TimeoutError:
        raise Unavailable(408) from None
    except (urllib.error.URLError, ConnectionError) as e:
        raise Unavailable(408 if isinstance(getattr(e, "reason", None), TimeoutError) else None) from None
    return json.loads(raw) if raw else None
