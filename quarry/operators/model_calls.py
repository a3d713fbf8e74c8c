"""Calls of a model that takes many texts: bounded, and isolated on failure.

A call holds at most a number of texts and of characters, whatever the size of
an Arrow batch.  When a call of several texts raises, or answers with another
number of items, its halves are called on their own, down to single texts, so a
text that the model cannot take costs its neighbours nothing.  If both halves
of a failing call succeed, its size was the fault: later calls are no larger,
until a run of good calls lets them grow again.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

MAX_TEXTS = 256
MAX_CHARS = 1 << 20
#: Good calls in a row after which a lowered size is doubled.
GROW_AFTER = 16


class Calls:
    """A model call as an isolating, size-adapting one; kept over batches."""

    def __init__(self, call: Callable[[list[str]], list], what: str, max_texts: int = MAX_TEXTS, max_chars: int = MAX_CHARS):
        self.call, self.what = call, what
        self.max_texts, self.max_chars = max(1, max_texts), max_chars
        self.most, self.good = self.max_texts, 0

    def once(self, texts: list[str]) -> tuple[list | None, str | None]:
        """(answers, None), or (None, error)."""
        try:
            answers = list(self.call(texts))
        except Exception as exc:  # noqa: BLE001 - recorded as data
            return None, f"{type(exc).__name__}: {exc}"
        if len(answers) != len(texts):
            return None, f"RuntimeError: {len(answers)} {self.what} for {len(texts)} {'prompts' if self.what == 'answers' else 'texts'}"
        return answers, None

    def each(self, texts: list[str]) -> Iterator[tuple[int, object, str | None]]:
        """(place, answer, error) of every text, in order; only a call of one
        text makes an error."""
        start = 0
        while start < len(texts):
            stop, chars = start, 0
            while stop < len(texts) and stop - start < self.most and (stop == start or chars + len(texts[stop]) <= self.max_chars):
                chars += len(texts[stop])
                stop += 1
            out: list = []
            self._halve(texts, start, stop, out)
            yield from out
            start = stop

    def _halve(self, texts: list[str], start: int, stop: int, out: list) -> bool:
        """Answers of a range; true if no single text failed."""
        answers, error = self.once(texts[start:stop])
        if error is None:
            self.good += 1
            if self.good >= GROW_AFTER and self.most < self.max_texts:
                self.most, self.good = min(self.max_texts, 2 * self.most), 0
            out.extend((i, a, None) for i, a in zip(range(start, stop), answers))
            return True
        self.good = 0
        if stop - start == 1:
            out.append((start, None, error))
            return False
        middle = (start + stop + 1) // 2
        sound = self._halve(texts, start, middle, out) & self._halve(texts, middle, stop, out)
        if sound:
            self.most = max(1, min(self.most, middle - start))
        return sound

    def settled(self, texts: list[str], attempts: int) -> list[tuple[object, str | None]]:
        """(answer, error) of every text; one that fails alone is tried again
        alone, ``attempts`` times in all."""
        out = []
        for i, answer, error in self.each(texts):
            for _ in range(attempts - 1):
                if error is None:
                    break
                got, error = self.once([texts[i]])
                answer = got[0] if error is None else None
            out.append((answer, error))
        return out
