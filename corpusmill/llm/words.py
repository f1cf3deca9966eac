"""Words of a text for exact comparison, for use inside Arrow batches."""

from __future__ import annotations

import re
import unicodedata

from corpusmill.operators.layers import parts

__all__ = ["parts", "words"]
_ASCII = re.compile(r"[a-z0-9]+")


class _Unicode:
    """Patterns compiled when a text first needs them."""

    cf = word = None


def words(text: str | None) -> list[str]:
    """Runs of letters and digits of the text in form NFKC without characters of category Cf, lower-cased.

    Null, empty and blank texts have none.
    """
    if not text:
        return []
    if text.isascii():
        return _ASCII.findall(text.lower())
    if _Unicode.cf is None:
        import regex

        _Unicode.cf, _Unicode.word = regex.compile(r"\p{Cf}+"), regex.compile(r"[\p{L}\p{Nd}]+")
    text = _Unicode.cf.sub("", unicodedata.normalize("NFKC", text))
    found = _ASCII.findall(text.lower()) if text.isascii() else _Unicode.word.findall(text)
    return found if text.isascii() else [w.lower() for w in found]
