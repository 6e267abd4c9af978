"""Column expressions for lines, tokens and words. All of them stay in the JVM."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from lexibid import fixed

# A line ends at CR LF, LF or CR, and at nothing else.
LINE_BREAK = r"\r\n|[\r\n]"



def _none_of(kept: str) -> str:
    """A run of characters outside a set that is given by its ranges.

    ``\\p{Alnum}`` is exactly ``A-Za-z0-9`` in Java, but a negated set tests it by one table
    lookup instead of nested range checks: about a fifth of the time.
    """
    ranges = kept.replace("A-Za-z0-9", r"\p{Alnum}")
    return f"[^{ranges}]+"


def line_array(breaks: Column) -> Column:
    """The lines of a text already split on LINE_BREAK.

    The piece after a final line break is not a line, and an empty text has none.
    """
    last_is_empty = F.element_at(breaks, -1) == ""
    return F.when(last_is_empty, F.slice(breaks, 1, F.size(breaks) - 1)).otherwise(breaks)


def token_array(line: Column) -> Column:
    """Tokens of one line: split at every single space, without trailing blanks.

    Leading and inner blanks count as empty tokens; an empty line is one empty token
    and a line of spaces only has no tokens.
    """
    body = F.rtrim(line)
    only_spaces = (line != "") & (body == "")
    return F.when(only_spaces, F.array().cast("array<string>")).otherwise(
        F.split(body, fixed.TOKEN_SEPARATOR)
    )


def _bounded_run(pattern: str) -> str:
    """Regex for whole tokens of a text, given "one or more of a set without separators".

    Such a token is a run with a separator or an end of the text on either side. The added
    plus makes the run possessive, so one that goes on with another character is given up
    at once.
    """
    return rf"(?<![^ \r\n]){pattern}+(?![^ \r\n])"


def matching_token_array(text: Column, pattern: str) -> Column:
    """The tokens of a line or a whole text that match ``pattern`` fully.

    One search of the text finds them all and never builds the other tokens.
    """
    return F.regexp_extract_all(text, F.lit(_bounded_run(pattern)), F.lit(0))


def matches_fully(token: Column, pattern: str) -> Column:
    return token.rlike(rf"\A{pattern}\z")


def _without(token: Column, characters: str) -> Column:
    for character in characters:
        token = F.replace(token, F.lit(character), F.lit(""))
    return token


def word_form(token: Column) -> Column:
    """Lower-case, then strip WORD_STRIP; '.' becomes the empty word."""
    return _without(F.lower(token), fixed.WORD_STRIP)


def alpha_form(token: Column) -> Column:
    """Strip all but letters and digits, of which an ALPHA_TOKEN has ALPHA_STRIP only."""
    return _without(token, fixed.ALPHA_STRIP)


def clean_token_array(text: Column) -> Column:
    """All tokens stripped to CLEAN_KEPT and lower-cased, the text being stripped at once.

    Spaces and line breaks stay, so token borders survive. Tokens that keep nothing and
    neighbouring borders leave blanks, which are the caller's to drop.
    """
    stripped = F.lower(F.regexp_replace(text, _none_of(f"{fixed.CLEAN_KEPT} \r\n"), ""))
    separator = F.lit(fixed.TOKEN_SEPARATOR)
    one_line = F.replace(F.replace(stripped, F.lit("\r"), separator), F.lit("\n"), separator)
    return F.split(one_line, fixed.TOKEN_SEPARATOR)


def contains_token(text: Column, pattern: str) -> Column:
    """Whether matching_token_array would find any token; stops at the first one."""
    return text.rlike(_bounded_run(pattern))
