"""Token and word streams. Each operator returns one string column."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexibid import fixed
from lexibid.functions import text as X
from lexibid.sources.text import split_numbered_lines


def tokens(lines: DataFrame, line: str = "line") -> DataFrame:
    """All tokens of each line, empty ones included: ``tok``."""
    return lines.select(F.explode(X.token_array(F.col(line))).alias("tok"))


def words(texts: DataFrame, text: str = "text") -> DataFrame:
    """Tokens of letters, digits, points and commas only, in word form: ``word``."""
    toks = texts.select(F.explode(X.matching_token_array(F.col(text), fixed.WORD_TOKEN)).alias("tok"))
    return toks.select(X.word_form(F.col("tok")).alias("word"))


def alpha_tokens(texts: DataFrame, text: str = "text") -> DataFrame:
    """Tokens of letters and points only, stripped of the points, case kept: ``word``."""
    toks = texts.select(F.explode(X.matching_token_array(F.col(text), fixed.ALPHA_TOKEN)).alias("tok"))
    return toks.select(X.alpha_form(F.col("tok")).alias("word"))


def clean_words(texts: DataFrame, text: str = "text") -> DataFrame:
    """Every token stripped to letters and digits and lower-cased, blanks dropped: ``word``."""
    cleaned = texts.select(F.explode(X.clean_token_array(F.col(text))).alias("word"))
    return cleaned.where(F.col("word") != "")


def token_count(line: str = "line") -> Column:
    """How many tokens a line has; null for a null line."""
    return _size(X.token_array(F.col(line)))


def token_total(lines: DataFrame, name: str, line: str = "line") -> DataFrame:
    """One row, one column ``name``: how many rows ``tokens`` has, without making them."""
    return _total(lines, X.token_array(F.col(line)), name)


def word_total(texts: DataFrame, name: str, text: str = "text") -> DataFrame:
    """One row, one column ``name``: how many rows ``words`` has, without making them."""
    return _total(texts, X.matching_token_array(F.col(text), fixed.WORD_TOKEN), name)


def _size(array: Column) -> Column:
    return F.when(array.isNotNull(), F.size(array)).cast("bigint")


def _total(df: DataFrame, arrays: Column, name: str) -> DataFrame:
    sizes = df.select(_size(arrays).alias("n"))
    return sizes.agg(F.coalesce(F.sum("n"), F.lit(0).cast("bigint")).alias(name))


def first_words(texts: DataFrame, key: str, text: str = "text", n: int = fixed.HEAD_ROWS) -> DataFrame:
    """The first ``n`` words in text order: ``key, ln, pos, word``.

    The first ``n`` texts that have a word at all hold the first ``n`` words. Finding the last
    of them needs one look per text up to its first word. Only texts up to that key are then
    split; the bound reaches the scan, so files or row groups beyond it are skipped. Texts
    without a key have no place in the order and are left out.
    """
    keyed = texts.where(F.col(key).isNotNull())
    starts = keyed.where(X.contains_token(F.col(text), fixed.WORD_TOKEN)).select(key).orderBy(key).limit(n)
    opening = keyed.where(F.col(key) <= starts.agg(F.max(key)).scalar())
    toks = split_numbered_lines(opening, key, text).select(
        key, "ln", F.posexplode(X.token_array(F.col("line"))).alias("pos", "tok")
    )
    return _first_word_tokens(toks, [key, "ln", "pos"], n)


def first_words_of_lines(
    lines: DataFrame, order: list[str], line: str = "line", n: int = fixed.HEAD_ROWS
) -> DataFrame:
    """The first ``n`` words of lines sorted by the columns ``order``: ``*order, pos, word``.

    The first ``n`` lines that have a word hold them; only those are split.
    """
    opening = lines.where(X.contains_token(F.col(line), fixed.WORD_TOKEN)).orderBy(*order).limit(n)
    toks = opening.select(*order, F.posexplode(X.token_array(F.col(line))).alias("pos", "tok"))
    return _first_word_tokens(toks, [*order, "pos"], n)


def _first_word_tokens(toks: DataFrame, order: list[str], n: int) -> DataFrame:
    found = toks.where(X.matches_fully(F.col("tok"), fixed.WORD_TOKEN))
    return found.select(*order, X.word_form(F.col("tok")).alias("word")).orderBy(*order).limit(n)
