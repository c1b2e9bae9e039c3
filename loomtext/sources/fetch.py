"""Polite fetching: a pause between requests, robots rules, retries with backoff."""

from __future__ import annotations

import random
import time
import urllib.error
import urllib.request
from collections.abc import Callable
from dataclasses import dataclass, field
from urllib.parse import urlsplit
from urllib.robotparser import RobotFileParser

from ..config import CrawlConfig

#: (status, body) of an address; raises OSError if there is no answer.
Opener = Callable[[str, dict, float], tuple[int, bytes]]


class FetchError(Exception):
    """The address can't be had: no answer, refused, or forbidden by robots rules."""


def open_url(url: str, headers: dict, timeout: float) -> tuple[int, bytes]:
    try:
        with urllib.request.urlopen(urllib.request.Request(url, headers=headers), timeout=timeout) as r:
            return r.status, r.read()
    except urllib.error.HTTPError as e:
        return e.code, e.read()


@dataclass
class Fetcher:
    """One for each host; requests of one fetcher keep the delay among themselves."""

    config: CrawlConfig
    delay: float | None = None
    opener: Opener = open_url
    sleep: Callable[[float], None] = time.sleep
    clock: Callable[[], float] = time.monotonic
    _last: float | None = None
    _robots: dict[str, RobotFileParser] = field(default_factory=dict)

    @property
    def headers(self) -> dict:
        return {"User-Agent": self.config.user_agent, "Accept-Language": self.config.accept_language, "Accept": "text/html,application/xhtml+xml,application/json;q=0.9,*/*;q=0.8"}

    def _pause(self) -> None:
        pause = (self.delay or self.config.delay) * random.uniform(0.9, 1.2)
        if self._last is not None and (left := pause - (self.clock() - self._last)) > 0:
            self.sleep(left)
        self._last = self.clock()

    def allowed(self, url: str) -> bool:
        """By the host's robots.txt; a missing or unreadable one allows everything."""
        if not self.config.respect_robots:
            return True
        host = urlsplit(url)
        key = f"{host.scheme}://{host.netloc}"
        if key not in self._robots:
            rules = RobotFileParser()
            try:
                status, body = self.opener(f"{key}/robots.txt", self.headers, self.config.timeout)
                rules.parse((body.decode("utf-8", "replace") if status == 200 else "").splitlines())
            except OSError:
                rules.parse([])
            self._robots[key] = rules
        return self._robots[key].can_fetch(self.config.user_agent, url)

    def get(self, url: str) -> bytes:
        """The body. 429 and 5xx and no answer are tried again, max_retries times; any other refusal fails at once."""
        if not self.allowed(url):
            raise FetchError(f"robots rules forbid {url}")
        reason = ""
        for attempt in range(self.config.max_retries + 1):
            self._pause()
            try:
                status, body = self.opener(url, self.headers, self.config.timeout)
            except OSError as e:
                reason, wait = str(e), 1.0
            else:
                if status < 400:
                    return body
                reason, wait = f"HTTP {status}", 1.5
                if status != 429 and status < 500:
                    break
            if attempt < self.config.max_retries:
                self.sleep(wait * (attempt + 1))
        raise FetchError(f"{reason} for {url}")
