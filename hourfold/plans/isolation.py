"""Finding the work that cannot be done, by halves."""

from __future__ import annotations

from collections.abc import Callable, Collection, Sequence
from typing import TypeVar

from ..functions.failures import FAILURES, is_transient

Unit = TypeVar("Unit")


def failing(units: Sequence[Unit], attempt: Callable[[Sequence[Unit]], None], alone: Collection[Unit] = ()) -> list[Unit]:
    """The units for which ``attempt`` fails however small the part they are in; the others are done.

    A part that fails is halved until single units fail: p bad ones of n cost about 2 p log2(n / p) attempts.
    Units in ``alone``, as those that failed before, are tried on their own from the start, so that they
    don't fail the others again. A failure of the cluster is tried once more and then raised.
    """
    known = [u for u in units if u in alone]
    parts = [[u] for u in reversed(known)] + [[u for u in units if u not in alone]]
    failed = []
    while parts:
        part = parts.pop()
        if not part:
            continue
        try:
            try:
                attempt(part)
            except FAILURES as err:
                if not is_transient(err):
                    raise
                attempt(part)
        except FAILURES as err:
            if is_transient(err):
                raise
            if len(part) == 1:
                failed.append(part[0])
            else:
                half = len(part) // 2
                parts += [part[half:], part[:half]]
    return failed
