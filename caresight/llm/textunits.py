"""Cutting texts where byte-level BPE pre-tokenisation always cuts too.

A single space between two characters that are certainly no white space begins a new match of the
byte-level pattern whatever stands around it: no alternative goes on over a space after such a
character, and the optional leading space takes the space into the match that follows. Texts may
be cut before such a space, and the tokens of the parts add up to those of the whole.
"""
from __future__ import annotations

import re
from collections.abc import Iterator

#: Characters that no version of Unicode counts as white space (fixed ranges: ASCII, Latin, Greek,
#: Cyrillic, kana, CJK ideographs, Hangul syllables).
SOLID = "!-~¡-¬®-ɏͰ-ϿЀ-ԯぁ-ゖァ-ヺ一-龥가-힣"
CUT = re.compile(f" (?<=[{SOLID}] )(?=[{SOLID}])")
#: Characters of a text that are cut into units at a time.
SPAN = 1 << 20


def spans(text: str, span: int = SPAN) -> Iterator[str]:
    """The text in parts of about ``span`` characters; the space at each cut is left out."""
    at = 0
    while len(text) - at > span:
        m = CUT.search(text, at + span)
        if m is None:
            break
        yield text[at:m.start()]
        at = m.end()
    yield text[at:] if at else text


def units(part: str) -> list[str]:
    """A part's units; each but the first follows a space that is left out."""
    return CUT.split(part)
