"""Splitting a text before byte-pair merges."""

import re

import regex

from sonomere.llm.caches import kept_by_worker

# Contractions before words: no word begins with an apostrophe, so words may be tried first.
_CONTRACTIONS = re.compile(re.escape(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+"))


def _plain_and_odd(pattern: str) -> tuple:
    """The pattern for ``re``, the characters on which it would differ, and the pattern itself.

    ``re`` has no letter and number classes, but its word class without decimal digits is the
    letters except for a few hundred characters; texts that hold one of those take the slow way.
    """
    every = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))
    wanted = {r"\p{L}": r"[^\W\d_]", r"\p{N}": r"\d", r"\s": r"\s"}
    odd = set()
    for unicode_class, plain in wanted.items():
        odd |= set(regex.findall(unicode_class, every)) ^ set(re.findall(plain, every))
    # One range beyond the basic plane: many small ones there make the search slow.
    basic = _character_class({c for c in odd if ord(c) < 0x10000})
    translated = _CONTRACTIONS.sub(r" ?[^\\W\\d_]+|'(?:[stmd]|re|ve|ll)", pattern)
    translated = (
        translated.replace(r"[^\s\p{L}\p{N}]+", r"(?:[^\s\w]|_)+")
        .replace(r"\p{L}", r"[^\W\d_]")
        .replace(r"\p{N}", r"\d")
    )
    beyond = r"\U00010000-\U0010ffff]"
    return re.compile(translated), re.compile(basic[:-1] + beyond), regex.compile(pattern)


def _character_class(characters: set[str]) -> str:
    points, ranges = sorted(map(ord, characters)), []
    for p in points:
        if ranges and ranges[-1][1] == p - 1:
            ranges[-1][1] = p
        else:
            ranges.append([p, p])
    return "[" + "".join(f"\\U{a:08x}-\\U{b:08x}" for a, b in ranges) + "]"


def splitter(pattern: str):
    """A function from text to its pre-tokens, as ``regex`` finds them."""
    plain, odd, slow = kept_by_worker(f"patterns {pattern}", lambda: _plain_and_odd(pattern))

    def split(text: str) -> list[str]:
        return (slow if odd.search(text) else plain).findall(text)

    return split
