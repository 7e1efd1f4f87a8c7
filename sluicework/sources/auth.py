"""Authorization headers: a constant pair of name and password, or OAuth tokens that are fetched once and refreshed."""

from __future__ import annotations

import base64
import json
import threading
import time
import urllib.parse
import urllib.request
from collections.abc import Callable
from dataclasses import dataclass, field


class AuthError(RuntimeError):
    """The token endpoint refused."""


@dataclass(frozen=True)
class Basic:
    user: str
    password: str = field(repr=False)

    def header(self) -> str:
        return "Basic " + base64.b64encode(f"{self.user}:{self.password}".encode()).decode()

    def invalidate(self) -> None:
        """Nothing is cached."""


def _post(url: str, form: dict[str, str]) -> dict:
    request = urllib.request.Request(url, urllib.parse.urlencode(form).encode(), {"Accept": "application/json"})
    try:
        with urllib.request.urlopen(request, timeout=30) as answer:
            return json.load(answer)
    except OSError as e:
        raise AuthError(f"token request failed: {e}") from e


@dataclass
class OAuth:
    """client_credentials or password grant. One caller fetches while others wait; a refresh token is tried first."""

    url: str
    client_id: str
    client_secret: str = field(repr=False)
    user: str | None = None
    password: str | None = field(default=None, repr=False)
    skew: float = 30.0
    post: Callable[[str, dict[str, str]], dict] = field(default=_post, repr=False)
    clock: Callable[[], float] = field(default=time.time, repr=False)

    def __post_init__(self) -> None:
        self._lock = threading.Lock()
        self._token: str | None = None
        self._refresh: str | None = None
        self._until = 0.0

    def __getstate__(self) -> dict:
        return {k: v for k, v in self.__dict__.items() if k != "_lock"}

    def __setstate__(self, state: dict) -> None:
        self.__dict__ |= state
        self._lock = threading.Lock()

    def header(self) -> str:
        with self._lock:
            if self._token is None or self.clock() >= self._until - self.skew:
                self._fetch()
            return f"Bearer {self._token}"

    def invalidate(self) -> None:
        with self._lock:
            self._token = None

    def _fetch(self) -> None:
        client = {"client_id": self.client_id, "client_secret": self.client_secret}
        answer = None
        if self._refresh:
            try:
                answer = self.post(self.url, client | {"grant_type": "refresh_token", "refresh_token": self._refresh})
            except AuthError:
                self._refresh = None
        if answer is None:
            grant = {"grant_type": "password", "username": self.user, "password": self.password or ""} if self.user else {"grant_type": "client_credentials"}
            answer = self.post(self.url, client | grant)
        if not answer.get("access_token"):
            raise AuthError("the answer has no access_token")
        self._token, self._refresh = answer["access_token"], answer.get("refresh_token", self._refresh)
        self._until = self.clock() + float(answer.get("expires_in", 1800))


def from_options(o: dict[str, str]) -> Basic | OAuth:
    """What a source's or sink's options say."""
    if "oauth.url" in o:
        return OAuth(o["oauth.url"], o["oauth.client.id"], o["oauth.client.secret"], o.get("user"), o.get("password"))
    return Basic(o.get("user", ""), o.get("password", ""))
