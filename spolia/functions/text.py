"""Text-level expressions: headers, tags, tokens, milestones, normalisation."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from spolia import config


def right_trim(text: Column) -> Column:
    """Drop trailing white space of any kind (`rtrim` alone knows only the blank)."""
    return F.rtrim(text, F.lit(config.WHITESPACE))


def split_header(value: Column, splitter: str = config.SPLITTER) -> Column:
    """Cut a file at the first splitter line.

    Returns `struct(header, marker, body)`; the newlines around the splitter belong to
    `marker`.  All three are null when the file has no splitter.
    """
    found = F.instr(value, F.lit(splitter))
    raw_header = F.left(value, found - 1)
    raw_body = F.substring(value, found + len(splitter), F.length(value))
    header = F.rtrim(raw_header, F.lit("\n"))
    body = F.ltrim(raw_body, F.lit("\n"))
    marker = F.substring(
        value, F.length(header) + 1, F.length(value) - F.length(header) - F.length(body)
    )
    present = found > 0
    return F.struct(
        F.when(present, header).alias("header"),
        F.when(present, marker).alias("marker"),
        F.when(present, body).alias("body"),
    )


def body_after(value: Column, splitter: str = config.SPLITTER) -> Column:
    """Text between the first and the second splitter, untrimmed; null without splitter."""
    found = F.instr(value, F.lit(splitter))
    rest = F.substring(value, found + len(splitter), F.length(value))
    return F.when(found > 0, F.substring_index(rest, splitter, 1))


def strip_milestones(body: Column, ms_regex: str | None = config.MS_TAG_SPACED) -> Column:
    """Right-trim a body and remove every earlier milestone tag."""
    return F.regexp_replace(right_trim(body), ms_regex or config.MS_TAG_FALLBACK, "")


def residual_tags(text: Column, ms_regex: str | None = config.MS_TAG_SPACED) -> Column:
    """Largest number of tags of one kind that are left in a stripped text."""
    kinds = [config.MS_TAG, config.LEGACY_TAG] + ([ms_regex] if ms_regex else [])
    return F.greatest(*[F.regexp_count(text, F.lit(kind)) for kind in kinds])


def _outside(char_class: str) -> str:
    """Pattern for one character that is not in a class.

    The JVM evaluates a negated class of several ranges much more slowly than this.
    """
    return f"(?:(?![{char_class}])(?s:.))"


def tokenize(text: Column) -> Column:
    """Alternating word and non-word pieces; joined they give the text again."""
    return F.regexp_extract_all(text, F.lit(f"[{config.WORD_CLASS}]+|{_outside(config.WORD_CLASS)}++"), 0)


def token_flag(piece: Column, token_class: str = config.TOKEN_CLASS) -> Column:
    """Whether a piece counts as a token."""
    return piece.rlike(f"[{token_class}]")


def token_count(text: Column, token_class: str = config.TOKEN_CLASS) -> Column:
    """Number of unbroken stretches of token characters."""
    return F.regexp_count(text, F.lit(f"[{token_class}]+"))


def _relevant_piece(token_class: str) -> str:
    """Pattern for a relevant piece from its first token character to its end.

    A word is finished as a word, anything else as a non-word piece.  The loops are
    possessive: no backtracking, constant stack.
    """
    w = config.WORD_CLASS
    word = f"(?=[{w}])[{token_class}][{w}]*+"
    other = f"(?![{w}])[{token_class}]{_outside(w)}*+"
    return f"(?:{word}|{other})"


def relevant_pieces(text: Column, token_class: str = config.TOKEN_CLASS) -> Column:
    """Number of pieces of `tokenize` for which `token_flag` holds."""
    return F.regexp_count(text, F.lit(_relevant_piece(token_class)))


def cut_milestones(
    text: Column, ms_len: int = config.MS_LEN, token_class: str = config.TOKEN_CLASS
) -> Column:
    """Cut a text after every `ms_len` relevant pieces, as `array<string>`.

    What follows the last full milestone, if anything, forms a shorter last one.  One
    linear regular-expression pass per text: no token rows and no shuffle.
    """
    full = f"(?:{_outside(token_class)}*+{_relevant_piece(token_class)}){{{ms_len}}}+"
    return F.regexp_extract_all(text, F.lit(f"{full}|(?s:.++)"), 0)


def label_width(text: Column, ms_len: int = config.MS_LEN, token_class: str = config.TOKEN_CLASS) -> Column:
    """Digits of the whole number of milestones in a text."""
    full = F.floor(token_count(text, token_class) / F.lit(ms_len))
    return F.length(full.cast("string"))


def milestone_label(part: Column, number: Column, width: Column) -> Column:
    """`ms`, part letter if any, number padded with zeros but never cut."""
    digits = number.cast("string")
    padded = F.lpad(digits, F.greatest(width, F.length(digits)), F.lit("0"))
    return F.concat(F.lit("ms"), F.coalesce(part, F.lit("")), padded)


def tagged_body(milestones: Column, part: Column, start: Column, width: Column) -> Column:
    """Milestone texts, each followed by its tag, as one string."""
    return F.array_join(
        F.transform(
            milestones,
            lambda text, i: F.concat(
                text, F.lit(" "), milestone_label(part, start + i.cast("long") + 1, width)
            ),
        ),
        "",
    )


def clean_text(text: Column, extra_map: dict[str, str] | None = None) -> Column:
    """Normalise letter variants and reduce everything that is no letter to one blank.

    `extra_map` replaces single characters before the built-in rules.
    """
    # Letter variants and what they become, in order of application.
    alif_forms, alif = "إأٱآ", "ا"
    ya_hamza, seated_hamza = "[يى]ء", "ئ"
    final_forms, final_values = "ىؤئ", "يءء"
    dropped = f"[a-zA-Z0-9[^{config.WORD_CLASS}]]+"
    for source, target in (extra_map or {}).items():
        text = F.replace(text, F.lit(source), F.lit(target))
    text = F.translate(text, alif_forms, alif * len(alif_forms))
    text = F.regexp_replace(text, ya_hamza, seated_hamza)
    text = F.translate(text, final_forms, final_values)
    return F.regexp_replace(text, dropped, " ")


def milestone_seq(label: Column) -> Column:
    """Number in a milestone label; null when it has no plain digits."""
    return F.regexp_replace(label, "[^0-9]", "").try_cast("bigint")
