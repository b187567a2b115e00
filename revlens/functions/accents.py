"""Accent folding tables generated from Unicode data.

The fold of a character is its NFKD decomposition with every non-ASCII code point removed.
Because decomposition is per character, folding a string equals folding each character,
so the fold is a character map: one-letter results become a ``translate`` table and the
rest a small map applied only to rows that contain such a character.
"""

from __future__ import annotations

import functools
import sys
import unicodedata


@functools.lru_cache(maxsize=None)
def fold_tables() -> tuple[str, str, dict[str, str]]:
    """(src, dst, multi): src[i] folds to dst[i]; multi maps chars folding to >1 letters."""
    src, dst, multi = [], [], {}
    for cp in range(0x80, sys.maxunicode + 1):
        if 0xD800 <= cp <= 0xDFFF:
            continue
        ch = chr(cp)
        folded = unicodedata.normalize("NFKD", ch).encode("ascii", "ignore").decode("ascii")
        if not folded:
            continue  # removed by the final non-ASCII strip
        if len(folded) == 1:
            src.append(ch)
            dst.append(folded)
        else:
            multi[ch] = folded
    return "".join(src), "".join(dst), multi


def fold_text_python(text: str) -> str:
    """Plain-Python fold used by tests as the brute-force reference."""
    return unicodedata.normalize("NFKD", text).encode("ascii", "ignore").decode("ascii")
