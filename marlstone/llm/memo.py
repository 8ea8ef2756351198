"""What a Python worker remembers of strings it has met, within a bound of bytes."""

from __future__ import annotations

from collections.abc import Callable, Hashable, Sequence
from typing import Any

# About what a dictionary entry takes besides the characters of its key and its record.
ENTRY_BYTES = 200


class Memo:
    """Records of strings, made by ``learn`` (strings to records) when they are not known.

    Records are kept in two generations of bounded size: when the younger is full it becomes the older, and what is
    met again moves to the younger. So common strings stay, strings met once go, and memory does not grow with
    the input.
    """

    def __init__(self, learn: Callable[[list[str]], Sequence[bytes]], most_bytes: int):
        self.learn, self.most_bytes = learn, most_bytes
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        self.held = 0

    def _keep(self, keys: Sequence[str], records: Sequence[bytes]) -> None:
        self.young.update(zip(keys, records, strict=True))
        self.held += sum(map(len, keys)) + sum(map(len, records)) + ENTRY_BYTES * len(keys)

    def __call__(self, keys: Sequence[str]) -> list[bytes]:
        """The record of each key; of one call none is forgotten before it ends."""
        if self.held > self.most_bytes // 2:
            self.old, self.young, self.held = self.young, {}, 0
        records = list(map(self.young.get, keys))
        if None in records:
            missing = dict.fromkeys(k for k, r in zip(keys, records, strict=True) if r is None)
            again = [k for k in missing if k in self.old]
            self._keep(again, [self.old[k] for k in again])
            new = [k for k in missing if k not in self.old]
            if new:
                self._keep(new, self.learn(new))
            records = list(map(self.young.__getitem__, keys))
        return records


_kept: dict[Hashable, Any] = {}


def turn_to(work: Hashable, make: Callable[[], Any] | None = None) -> Any:
    """What this Python worker keeps for ``work``, made when it turns to it.

    Workers outlive their stage. One that turns to other work drops what it kept for the work before, so that the
    stages of a pipeline do not add up in it.
    """
    if work not in _kept:
        _kept.clear()
        _kept[work] = make() if make else None
    return _kept[work]
