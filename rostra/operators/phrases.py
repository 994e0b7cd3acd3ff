"""Many phrases found in one walk over the words of a text.

Phrases share a trie keyed by words: from the first word to those that may follow it, each
with the characters in between. A text is cut into its words once; at each word the walk
goes down the trie as far as the text agrees. The work depends on the words of the text
and the matches in it, and not on the number of phrases.
"""

from __future__ import annotations

import regex

# A letter, digit or underscore; a phrase may not touch another one on either side.
WORD = regex.compile(r"[\p{L}\p{N}_]+")


class Phrases:
    """A trie of phrases, which are known by their places in the list given.

    Nodes are pairs: next (gap, word) to node, and the phrases that end there with the
    characters that stand before their first and after their last word.
    """

    def __init__(self, phrases: list[str]):
        self.first: dict[str, tuple[dict, list]] = {}
        # Phrases without a word, such as an ampersand.
        self.signs: list[tuple[str, int]] = []
        for number, phrase in enumerate(phrases):
            spans = [m.span() for m in WORD.finditer(phrase)]
            if not spans:
                if phrase:
                    self.signs.append((phrase, number))
                continue
            (start, end), *others = spans
            node = self.first.setdefault(phrase[start:end], ({}, []))
            for a, b in others:
                node = node[0].setdefault((phrase[end:a], phrase[a:b]), ({}, []))
                end = b
            node[1].append((number, phrase[:start], phrase[end:]))

    def find(self, text: str) -> list[tuple[int, int, int]]:
        """(start, end, phrase) of all whole-word matches; those of one phrase do not overlap."""
        found: list[tuple[int, int, int]] = []
        # Few words of a text begin a phrase, and most texts of a small slice have none.
        words = WORD.findall(text)
        if not self.first.keys().isdisjoint(words):
            self._walk(text, words, found)
        for sign, number in self.signs:
            at = text.find(sign)
            while at >= 0:
                end = at + len(sign)
                alone = not (at and WORD.match(text[at - 1])) and not WORD.match(text[end : end + 1])
                if alone:
                    found.append((at, end, number))
                at = text.find(sign, end if alone else at + 1)
        return sorted(found)

    def _walk(self, text: str, words: list[str], found: list[tuple[int, int, int]]) -> None:
        spans = [m.span() for m in WORD.finditer(text)]
        ended: dict[int, int] = {}
        for i in [i for i, word in enumerate(words) if word in self.first]:
            start, end = spans[i]
            node = self.first[words[i]]
            at = i
            while node:
                following, phrases = node
                for number, before, after in phrases:
                    a, b = start - len(before), end + len(after)
                    if before and not self._free(text, before, spans[i - 1][1] if i else None, start, True):
                        continue
                    if after and not self._free(text, after, spans[at + 1][0] if at + 1 < len(spans) else None, end, False):
                        continue
                    if a >= ended.get(number, 0):
                        ended[number] = b
                        found.append((a, b, number))
                at += 1
                if not following or at == len(spans):
                    break
                a, b = spans[at]
                node = following.get((text[end:a], text[a:b]))
                end = b

    @staticmethod
    def _free(text: str, edge: str, other: int | None, at: int, leads: bool) -> bool:
        """Whether ``edge`` stands before or after ``at`` and does not touch the other word there."""
        if leads:
            gap = text[other or 0 : at]
            return gap.endswith(edge) and (other is None or len(gap) > len(edge))
        gap = text[at : len(text) if other is None else other]
        return gap.startswith(edge) and (other is None or len(gap) > len(edge))
