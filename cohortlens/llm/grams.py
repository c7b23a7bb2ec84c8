"""Variable-length grams of words and how many of them one edit can change.

A word is framed by two marks.  At every place the longest gram of a dictionary
that starts there is taken (``shortest`` characters where none does), and a
gram that lies inside an earlier one is left out.  The dictionary holds the
grams of ``shortest + 1`` to ``longest`` characters whose beginning, without
the last character, is frequent: a gram is only made longer where its list of
words would be long.

``affected`` bounds how many grams of a word one edit can change, for the
worst place of the edit.  An edit changes the grams that hold its place; a gram
before it only if a longer gram could now reach over the edit from that gram's
start or before; a gram after it only if a gram that starts at or before the
edit could now cover it.  Two words that differ by one edit therefore share
all but ``affected`` grams of either, in order, at places that differ by no
more than their lengths.
"""

from __future__ import annotations

from collections.abc import Iterable

BEGIN, END = "<", ">"


class GramDictionary:
    """``counts`` gives the frequency of the grams of ``shortest`` to
    ``longest`` characters that may be wanted."""

    def __init__(self, counts: dict[str, int], frequent: int, shortest: int = 2, longest: int = 3):
        self.shortest, self.longest, self.counts = shortest, longest, counts
        longer = [g for g in counts if len(g) > shortest and counts.get(g[:-1], 0) > frequent]
        self.members = set(longer)
        self.beginnings = {g[:k] for g in longer for k in range(1, len(g))}
        self.inner = {g[i:j] for g in longer for i in range(1, len(g)) for j in range(i + 1, len(g) + 1)}

    def decompose(self, framed: str) -> list[tuple[int, int]]:
        """(start, end) of the grams of a framed word, by start."""
        out, reach = [], 0
        for p in range(len(framed) - self.shortest + 1):
            end = p + self.shortest
            for to in range(min(len(framed), p + self.longest), end, -1):
                if framed[p:to] in self.members:
                    end = to
                    break
            if end > reach:
                out.append((p, end))
                reach = end
        return out

    def affected(self, framed: str, grams: list[tuple[int, int]]) -> int:
        """Most grams that one inserted, deleted or replaced character changes."""
        worst, last = 0, len(framed) - 1
        for i in range(1, last + 1):
            low = max(0, i - self.longest + 1)
            # The first place from which a longer gram could reach over the edit.
            first = next((p for p in range(low, i) if framed[p:i] in self.beginnings), i)
            before = sum(1 for p, e in grams if e <= i and p >= first)
            # An insertion before character i.
            new = before + sum(1 for p, e in grams if p < i < e or (p >= i and e - i < self.longest and framed[i:e] in self.inner))
            worst = max(worst, new)
            if i < last:  # character i is replaced or deleted
                new = before + sum(1 for p, e in grams if p <= i < e or (p > i and e - i - 1 < self.longest and framed[i + 1 : e] in self.inner))
                worst = max(worst, new)
        return worst

    def rarest(self, framed: str, grams: Iterable[tuple[int, int]]) -> list[tuple[str, int]]:
        """(gram, start) in the global order: rare first, then by characters,
        then by place."""
        named = [(framed[p:e], p) for p, e in grams]
        return sorted(named, key=lambda x: (self.counts.get(x[0], 0), x[0], x[1]))
