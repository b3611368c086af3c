"""Character classes that mean the same in Java regular expressions and RE2.

Plain ``\\w``, ``\\s`` and ``\\b`` are ASCII-only on the JVM, so every operator spells
the Unicode classes out.
"""

import unicodedata
from functools import lru_cache

WS = r"[\x09-\x0d\x1c-\x20\x{85}\p{Z}]"
NOT_WS = r"[^\x09-\x0d\x1c-\x20\x{85}\p{Z}]"
WORD = r"[\p{L}\p{N}_]"
WORDS = WORD + "+"
# Word edges: nothing of class WORD before / after.
WORD_START = rf"(?<!{WORD})"
WORD_END = rf"(?!{WORD})"

# The whitespace comes first, the look back second: few places get as far as the look.
SENTENCE_GAP = rf"{WS}(?<=[.!?]{WS}){WS}*"
# Whitespace that is not one plain space already (Java only).
UNCOLLAPSED = rf"[{WS}&&[^ ]]{WS}*+| {WS}++"
URL = rf"https?://{NOT_WS}+|www\.{NOT_WS}+"
BLOB = rf"{WORD_START}(?=[A-Za-z0-9]{{40,}})(?=[A-Za-z0-9]*[0-9])[A-Za-z0-9]++{WORD_END}"
STUTTER = rf"(?iu){WORD_START}({WORD})(?:-\1){{5,}}{WORD}?{WORD_END}"
DASH_RUN = r"[-_=]{5,}"
ZERO_WIDTH = r"[\x{200b}\x{200c}\x{200d}\x{2060}\x{feff}]"
CONTROL_EXCEPT_NEWLINE_TAB = r"[\x00-\x08\x0b-\x1f\x7f-\x{9f}]"
CONTROL_EXCEPT_NEWLINE_RETURN_TAB = r"[\x00-\x08\x0b\x0c\x0e-\x1f\x7f-\x{9f}]"

# Blocks scanned for characters NFKC can never alter: Latin, IPA, Greek, Cyrillic,
# general punctuation, kana, CJK ideographs and Hangul syllables.
_SCANNED_BLOCKS = ((0x0000, 0x052F), (0x2010, 0x206F), (0x3041, 0x30FF),
                   (0x4E00, 0x9FFF), (0xAC00, 0xD7A3))


def _class_of(codepoints, least: int = 1) -> str:
    """Regex class body covering sorted code points, as ranges of ``least`` characters and more."""
    spans: list[list[int]] = []
    for cp in codepoints:
        if spans and cp == spans[-1][1] + 1:
            spans[-1][1] = cp
        else:
            spans.append([cp, cp])
    return "".join(rf"\x{{{a:x}}}-\x{{{b:x}}}" for a, b in spans if b - a + 1 >= least)


@lru_cache(maxsize=1)
def maybe_unnormalised() -> str:
    """Pattern of a character whose presence means NFKC might change the text.

    A text made only of characters that normalise to themselves and are not combining
    marks is already in NFKC, so it never has to leave the JVM. The long class is tested
    behind cheap ones: neither ASCII characters nor those of long stable ranges, such as the
    letters of Cyrillic, reach it.
    """
    stable = [
        cp
        for first, last in _SCANNED_BLOCKS
        for cp in range(first, last + 1)
        if unicodedata.combining(chr(cp)) == 0
        and unicodedata.normalize("NFKC", chr(cp)) == chr(cp)
    ]
    return rf"[^\x00-\x7f](?<=[^{_class_of([cp for cp in stable if cp > 0x7f], 32)}])(?<=[^{_class_of(stable)}])"


@lru_cache(maxsize=1)
def digit_class() -> str:
    """Decimal digits plus the superscript and enclosed digits ``str.isdigit`` accepts."""
    extra = (
        cp for cp in range(0x3000)
        if chr(cp).isdigit() and unicodedata.category(chr(cp)) != "Nd"
    )
    return rf"[\p{{Nd}}{_class_of(extra)}]"
