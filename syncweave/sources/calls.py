"""Calls of a rate-limited writer, for a target behind a REST interface."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterable, Iterator, Sequence
from typing import TypeVar

R = TypeVar("R")
#: Answer codes that ask for another try.
RETRYABLE = (1254291, 800004135, 1254290)
ATTEMPTS = 5
STEP_SECONDS = 0.5
CREATE_BATCH, DELETE_BATCH = 1000, 500


class CallError(RuntimeError):
    def __init__(self, code: int, text: str = "") -> None:
        super().__init__(f"code {code}: {text}")
        self.code = code


def retrying(call: Callable[[], R], codes: Sequence[int] = RETRYABLE, attempts: int = ATTEMPTS, step: float = STEP_SECONDS, sleep: Callable[[float], object] = time.sleep) -> R:
    """The call's result; codes of a rate limit are tried again after a pause that grows by a step each time."""
    for n in range(attempts + 1):
        try:
            return call()
        except CallError as e:
            if e.code not in codes or n == attempts:
                raise
            sleep(step * (n + 1))
    raise AssertionError


def batches(items: Iterable[R], size: int) -> Iterator[list[R]]:
    held: list[R] = []
    for x in items:
        held.append(x)
        if len(held) == size:
            yield held
            held = []
    if held:
        yield held


def pages(fetch: Callable[[str | None], tuple[list[R], str | None]]) -> Iterator[R]:
    """All items of a paged listing; fetch(token) gives a page and the next token, or None at the end."""
    token: str | None = None
    while True:
        items, token = fetch(token)
        yield from items
        if token is None:
            return
