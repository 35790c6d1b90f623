"""Byte-pair encoding by forward states that words with a common prefix share.

A byte-pair encoding is a left-to-right dynamic program: a sequence of tokens is the encoding of its text exactly when
each neighbouring pair is the encoding of the pair's text. So the encoding of every prefix is known from its last token
(the forward state), and one token at most fits behind each state. Sorted words are a trie walked depth-first: the
states of the prefix that a word shares with the one before it stay.

Merge order: of all neighbouring tokens whose concatenation is a token, the one with the lowest rank merges first, and of
equal ones the leftmost. That is the rule of the public byte-level vocabularies and of SentencePiece's BPE models.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

#: Checked pairs that one worker remembers before it starts afresh.
PAIRS = 300_000


class TrieBpe:
    """ranks: token (str or bytes) -> rank. A single item that is no token stands alone and merges with nothing."""

    def __init__(self, ranks: dict, pairs: int = PAIRS):
        self.ranks = ranks
        self.pairs = pairs
        self._fits: dict = {}
        self._own = {token: token for token in ranks}
        lengths: dict = {}
        for token in ranks:
            lengths.setdefault(token[-2:], set()).add(len(token))
        #: Lengths of the tokens with these last two items, longest first.
        self._lengths = {end: sorted(found - {1}, reverse=True) for end, found in lengths.items()}

    def merged(self, text) -> list:
        """The encoding of a short text, by merging as the rule says."""
        parts = [text[i : i + 1] for i in range(len(text))]
        ranks = self.ranks
        while True:
            best, at = None, -1
            for i in range(len(parts) - 1):
                rank = ranks.get(parts[i] + parts[i + 1])
                if rank is not None and (best is None or rank < best):
                    best, at = rank, i
            if best is None:
                return parts
            parts[at : at + 2] = [parts[at] + parts[at + 1]]

    def fits(self, left, right) -> bool:
        """Whether the two tokens are the encoding of their text (left may be empty)."""
        key = (left, right)
        found = self._fits.get(key)
        if found is None:
            if len(self._fits) >= self.pairs:
                self._fits.clear()
            # The pairs that stay hold the tokens of ranks, not the pieces of words just met: half the memory.
            key = (self._own.get(left, left), self._own.get(right, right))
            found = self._fits[key] = self.merged(left + right) == ([left, right] if left else [right])
        return found

    def walk(self, words: Iterable) -> Iterator[tuple]:
        """(word, last tokens, token counts) of each of the sorted distinct words; index i holds the state after i items.

        The two lists are reused: read them before the next word.
        """
        last, count, before = [None], [0], None
        ranks, fits, lengths, cached = self.ranks, self.fits, self._lengths.get, self._fits.get
        for word in words:
            shared = 0
            if before is not None:
                for a, b in zip(before, word):  # noqa: B905
                    if a != b:
                        break
                    shared += 1
                del last[shared + 1 :], count[shared + 1 :]
            for i in range(shared + 1, len(word) + 1):
                for n in lengths(word[i - 2 : i], ()) if i > 1 else ():
                    if n < i:
                        token = word[i - n : i]
                        if token in ranks:
                            left = last[i - n]
                            ok = cached((left, token))
                            if ok or ok is None and fits(left, token):
                                break
                    elif n == i:
                        token = word[:i]
                        if token in ranks and fits(token[:0], token):
                            break
                else:
                    n, token = 1, word[i - 1 : i]
                last.append(token)
                count.append(count[i - n] + 1)
            before = word
            yield word, last, count

    def tokens(self, words: Iterable) -> Iterator[tuple]:
        """(word, its tokens) of each of the sorted distinct words."""
        for word, last, _ in self.walk(words):
            found, i = [], len(word)
            while i:
                token = last[i]
                found.append(token)
                i -= len(token)
            found.reverse()
            yield word, found

    def counts(self, words: Iterable) -> dict:
        """word -> number of its tokens (the count at its node of the trie), for sorted distinct words."""
        return {word: count[-1] for word, _, count in self.walk(words)}
