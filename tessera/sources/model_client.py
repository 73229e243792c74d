"""A client for a chat model behind an HTTP endpoint: what is worth another attempt waits longer each time."""

from __future__ import annotations

import json
import time
from collections.abc import Callable

from tessera.operators.classify import Filtered, Reply


class ModelError(Exception):
    """The endpoint refused, or failed at every attempt."""


# Attempts and the first wait in seconds; each further wait is twice the one before.
ATTEMPTS, FIRST_WAIT = 4, 5.0


class ModelClient:
    """Callable as (step, system, items) -> Reply. `send` takes a request and gives (HTTP status, decoded body); it raises OSError where the line fails."""

    def __init__(self, send: Callable[[dict], tuple[int, dict]], model: str, attempts: int = ATTEMPTS, first_wait: float = FIRST_WAIT, sleep: Callable[[float], None] = time.sleep):
        self.send, self.model, self.sleep = send, model, sleep
        self.waits = [first_wait * 2**k for k in range(attempts - 1)]

    def __call__(self, step: str, system: str, items: list[dict]) -> Reply:
        request = {"model": self.model, "temperature": 0, "messages": [{"role": "system", "content": system}, {"role": "user", "content": json.dumps(items, ensure_ascii=False)}]}
        trouble = ""
        for wait in [*self.waits, None]:
            try:
                status, body = self.send(request)
            except OSError as e:
                status, body = 0, {"error": {"message": str(e)}}
            if filtered(body):
                raise Filtered(step)
            if status == 200 and (text := content(body)):
                told = body.get("usage") or {}
                return Reply(text, told.get("prompt_tokens"), told.get("completion_tokens"))
            trouble = f"{status}: {str(body)[:200]}"
            if status not in (0, 200, 429) and status < 500:
                break
            if wait is not None:
                self.sleep(wait)
        raise ModelError(trouble)


def choice(body: dict) -> dict:
    return (body.get("choices") or [{}])[0]


def content(body: dict) -> str:
    return ((choice(body).get("message") or {}).get("content") or "").strip()


def filtered(body: dict) -> bool:
    return "content_filter" in (choice(body).get("finish_reason"), (body.get("error") or {}).get("code"))
