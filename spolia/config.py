"""Defaults and fixed values shared by the operators."""

from __future__ import annotations

from dataclasses import dataclass

# ---------------------------------------------------------------------------
# Fixed values.  File layout, tag format and character classes are properties
# of the data, so they are stated here once, as text.  `\w` and `\d` are spelt
# out as Unicode classes: the JVM's own shorthands cover ASCII only.
# ---------------------------------------------------------------------------
WORD_CLASS = r"\p{L}\p{N}_"
EXTENSIONS = ("mARkdown", "completed", "inProgress")  # best first; no extension comes last
FILE_NAME = (
    r"^\p{Nd}{4}[\p{L}\p{N}_]+\.[\p{L}\p{N}_]+\.[\p{L}\p{N}_]+-[\p{L}\p{N}_]{3}\p{Nd}"
    r"(\.(mARkdown|completed|inProgress))?$"
)
FILE_NAME_LOWER_LANG = (
    r"^\p{Nd}{4}[\p{L}\p{N}_]+\.[\p{L}\p{N}_]+\.[\p{L}\p{N}_]+-[a-z]{3}\p{Nd}"
    r"(\.(mARkdown|completed|inProgress))?$"
)
SPLITTER = "#META#Header#End#"
MS_TAG = r"ms[A-Z]?\p{Nd}+"
# The look-behind only keeps long runs of blanks from being searched again and again.
MS_TAG_SPACED = r"(?<! ) *+ms[A-Z]?\p{Nd}+"
MS_TAG_FALLBACK = r"(?<! ) *+(?:Milestone300|ms[A-Z]?\p{Nd}+)"
LEGACY_TAG = "Milestone300"
# Characters that make a piece of text a countable token (content of a class).
TOKEN_CLASS = "ء-غـ-ْٰ-ۓ"
# Everything that counts as white space at the end of a text.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
MS_LEN = 300
CHUNK_ROWS = 1000
# ---------------------------------------------------------------------------


@dataclass(frozen=True)
class CorpusConfig:
    """Settings of one corpus run; every operator also takes them as arguments."""

    file_name_regex: str = FILE_NAME
    ms_regex: str = MS_TAG
    splitter: str = SPLITTER
    token_class: str = TOKEN_CLASS
    ms_len: int = MS_LEN
    chunk_rows: int = CHUNK_ROWS
    primary_only: bool = True
    include_book_uri: bool = False
    fold: bool = False  # whether vowel marks and Persian letters are folded in records (by default marks become blanks)
    by_folder: bool = False  # whether versions and the parts of books belong together within one folder only
    overwrite: bool = False
