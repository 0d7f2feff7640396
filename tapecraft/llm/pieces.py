"""Cutting a text where byte-level BPE pre-tokens always end, so that repeated pieces are encoded once.

The pre-token pattern never matches across a space that follows a
non-white-space character: whatever precedes ends there and the next match
begins with that space. Pieces cut at such spaces therefore encode on their own
exactly as they do inside the text, and a dictionary of distinct pieces can
stand in for repeated work.

Where no white space follows white space, a match also ends before and after
each newline; and one ends before a full stop or comma that follows a Latin
letter or an ASCII digit. Most texts are cut at these places too: their pieces
are mostly words alone, far fewer distinct ones than words with what follows
them.
"""

from __future__ import annotations

import re

#: Stands at the cuts; of one byte, so that texts keep their width.
_MARK = "\0"
_AFTER_SPACE = re.compile(r"\s ")
_CUT = re.compile(r"(?<=\S)(?= )")
_SPACES = re.compile(r"\s\s")
#: White space other than the space and the newline, as Python's pattern has it.
_OTHER_SPACE = [c for c in map(chr, range(0x3001)) if c.isspace() and c not in " \n"]
#: A full stop or comma that may be in one match with what precedes it.
_JOINED_STOP = re.compile("[.,](?<![0-9A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f][.,])")


def _single_spaces(text: str) -> bool:
    """Whether no white space follows white space."""
    if any(c in text for c in _OTHER_SPACE):
        return _SPACES.search(text) is None
    return not ("  " in text or "\n" in text and ("\n\n" in text or " \n" in text or "\n " in text))


def split_pieces(text: str) -> list[str]:
    """The text cut where a match always ends; joins back to the text. Pieces may be empty."""
    if not text:
        return []
    if _MARK not in text and text[0] != " ":
        if _single_spaces(text) and _JOINED_STOP.search(text) is None:
            return (text.replace(" ", _MARK + " ").replace(".", _MARK + ".").replace(",", _MARK + ",")
                    .replace("\n", _MARK + "\n" + _MARK).split(_MARK))
        if not _AFTER_SPACE.search(text):
            return text.replace(" ", _MARK + " ").split(_MARK)
    return _CUT.split(text)
