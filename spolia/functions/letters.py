"""Folding of letters that are written in several ways: presentation forms, marks, letters of other Arabic alphabets."""

from __future__ import annotations

import unicodedata
from functools import lru_cache

from pyspark.sql import Column, functions as F

# Blocks of presentation forms (first, last), and letters of Persian and Urdu with their Arabic counterparts.
PRESENTATION = ((0xFB50, 0xFDFF), (0xFE70, 0xFEFF))
SIBLINGS, ARABIC = "یکہھەۀۂۃےۓ", "يكهههههةيي"
# Content of classes: marks and joiners without a sound of their own (the tatweel among them).
SILENT = r"\p{Mn}\x{0640}\x{200C}\x{200D}"


@lru_cache(maxsize=1)
def presentation_forms() -> tuple[dict[str, str], dict[str, str]]:
    """Presentation forms of one letter, and those of several, with the letters that they stand for.

    Taken from the compatibility decompositions of the Unicode tables; the blanks that carry isolated marks are left out.
    """
    single, several = {}, {}
    for first, last in PRESENTATION:
        for code in range(first, last + 1):
            form = chr(code)
            letters = unicodedata.normalize("NFKC", form)
            if letters == form:
                continue
            if letters[0] == " " and unicodedata.category(letters[-1]) == "Mn":
                letters = letters.lstrip()
            (single if len(letters) == 1 else several)[form] = letters
    return single, several


def fold_presentation(text: Column) -> Column:
    """Presentation forms as the letters that they stand for.

    Forms of one letter are translated in one pass.  What then lies in the blocks is cut out letter by letter and looked up
    by its code point, in constant time for each; stretches without such letters stay whole.
    """
    single, several = presentation_forms()
    text = F.translate(text, "".join(single), "".join(single.values()))
    block = "".join(f"\\x{{{first:X}}}-\\x{{{last:X}}}" for first, last in PRESENTATION)
    pieces = F.regexp_extract_all(text, F.lit(f"[{block}]|[^{block}]++"), 0)
    least, most = PRESENTATION[0][0], PRESENTATION[-1][-1]
    known = F.array(*[F.lit(several.get(chr(code))) for code in range(least, most + 1)])
    return F.array_join(F.transform(pieces, lambda p: F.coalesce(F.get(known, F.ascii(p) - least), p)), "")


def fold_letters(text: Column) -> Column:
    """Presentation forms resolved, marks, tatweel and joiners dropped, Persian and Urdu letters as their counterparts.

    Letters that Arabic has no counterpart for (such as those for p, ch, zh and g) stay.  Null stays null.
    """
    return F.translate(F.regexp_replace(fold_presentation(text), f"[{SILENT}]+", ""), SIBLINGS, ARABIC)
