"""Pre-tokens of a text, a stretch at a time, so that very long texts need no long list."""

from __future__ import annotations

from collections.abc import Iterator

#: Characters matched at a time.
STRETCH = 1 << 18
#: A match is decided by the character behind it, and by as many from its start on as the longest
#: alternative with a fixed length has: a contraction such as 'll.
DECIDING = 3


def pretokens(find, text: str, stretch: int = STRETCH) -> Iterator[list[str]]:
    """Lists of the matches that cover ``text``, as ``find`` (a findall whose matches leave no gap) gives them.

    Matches near the end of a stretch might be others if they saw what follows, so they
    are found again with the next one.
    """
    at = 0
    while at < len(text):
        size = stretch
        while True:
            found = find(text[at : at + size] if at or size < len(text) else text)
            if at + size >= len(text):
                yield found
                return
            if sure := _sure(found, size):
                break
            size *= 2  # one match fills the stretch
        at += sum(map(len, found[:sure]))
        yield found[:sure]


def _sure(found: list[str], size: int) -> int:
    """How many of the matches that cover a text of some size can't change with what follows it."""
    n, start = len(found) - 1, size - len(found[-1])
    while n > 0 and start - len(found[n - 1]) > size - DECIDING:
        n -= 1
        start -= len(found[n])
    return n


def boundaries(find, text: str, last: bool) -> Iterator[int]:
    """Where matches end; for a text that isn't the ``last`` part of one, only where they surely do."""
    ends, starts = [], []
    end = 0
    for found in pretokens(find, text):
        for match in found:
            starts.append(end)
            end += len(match)
            ends.append(end)
    for start, end in zip(starts, ends):
        if last or (end < len(text) and start <= len(text) - DECIDING):
            yield end
