"""Polite fetching at the engine's edge: robots rules, a pause a host, retries, and an error for each way to fail.

The transport is a callable (url) -> (status, headers, text), so that it can be any client and, in tests, none.
"""

from __future__ import annotations

import random
import time
from collections.abc import Callable
from dataclasses import dataclass, field
from urllib.parse import urlsplit
from urllib.robotparser import RobotFileParser

Transport = Callable[[str], tuple[int, dict[str, str], str]]


class FetchError(Exception):
    kind = "fetch_failed"


class Disallowed(FetchError):
    kind = "robots_disallowed"


class Blocked(FetchError):
    """The host refuses; the run must stop asking it."""

    kind = "blocked"


@dataclass
class Fetcher:
    transport: Transport
    agent: str = "tessera"
    pause: tuple[float, float] = (2.0, 5.0)
    attempts: int = 3
    backoff: float = 2.0
    sleep: Callable[[float], None] = time.sleep
    clock: Callable[[], float] = time.monotonic
    _robots: dict[str, RobotFileParser] = field(default_factory=dict)
    _last: dict[str, float] = field(default_factory=dict)

    def allowed(self, url: str) -> bool:
        """By the host's robots file: none (4xx) allows all, one that can't be had (5xx) nothing."""
        parts = urlsplit(url)
        host = f"{parts.scheme}://{parts.netloc}"
        if host not in self._robots:
            rules = RobotFileParser()
            try:
                status, _, text = self.transport(f"{host}/robots.txt")
            except OSError:
                status, text = 503, ""
            if status >= 500:
                rules.disallow_all = True
            elif status >= 400:
                rules.allow_all = True
            else:
                rules.parse(text.splitlines())
            self._robots[host] = rules
        return self._robots[host].can_fetch(self.agent, url)

    def get(self, url: str) -> str:
        if not self.allowed(url):
            raise Disallowed(url)
        host = urlsplit(url).netloc
        for attempt in range(self.attempts):
            if host in self._last:
                self.sleep(max(0.0, self._last[host] + random.uniform(*self.pause) - self.clock()))
            self._last[host] = self.clock()
            try:
                status, headers, text = self.transport(url)
            except OSError:
                status, headers, text = 503, {}, ""
            if status < 400:
                return text
            if status == 403:
                raise Blocked(f"{status} {url}")
            if status not in (429, 500, 502, 503, 504):
                raise FetchError(f"{status} {url}")
            if attempt + 1 < self.attempts:
                after = {k.lower(): v for k, v in headers.items()}.get("retry-after", "")
                self.sleep(float(after) if after.isdigit() else self.backoff * 2**attempt)
        raise (Blocked if status == 429 else FetchError)(f"{status} {url}")
