"""Text columns: folding, titles, bullet lines, tags."""

from __future__ import annotations

import string
from collections.abc import Iterable, Iterator
from functools import cache

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import pandas_udf

# How titles and lines swap characters.
TITLE_SWAPS = ((":", " -"), ("/", "-"), ("\\", "-"), ("|", "-"), ("?", ""), ("*", ""), ('"', "’"), ("'", "’"), ("<", "("), (">", ")"))
TITLE_MOST, TITLE_MOST_BYTES = 120, 200
LINE_SWAPS = (("<", "‹"), (">", "›"), ("—", "-"), ("*", "∗"), ("|", "¦"), ("://", ":∕∕"))


def fold(text: Column) -> Column:
    """One line: controls, separators and runs of these are one space; trimmed. Null is empty."""
    return F.trim(F.regexp_replace(F.coalesce(text, F.lit("")), r"[\p{C}\p{Z}]+", " "))


def cut_bytes(text: Column, most: int) -> Column:
    """The longest prefix of at most ``most`` UTF-8 bytes that ends between characters."""
    lengths = F.transform(F.sequence(F.lit(0), F.least(F.char_length(text), F.lit(most))), lambda i: F.octet_length(F.left(text, i)))
    return F.when(F.octet_length(text) <= most, text).otherwise(F.left(text, F.size(F.filter(lengths, lambda n: n <= most)) - 1))


def safe_title(text: Column, fallback: str = "Untitled") -> Column:
    """A title that can name a file: characters swapped, one line, without dots and spaces at the ends, at most 120 characters
    and 200 bytes; what is cut ends with …; index is set apart."""
    swapped = F.coalesce(text, F.lit(""))
    for bad, good in TITLE_SWAPS:
        swapped = F.replace(swapped, F.lit(bad), F.lit(good))
    whole = F.regexp_replace(F.regexp_replace(fold(swapped), r"^[. ]+", ""), r"[ .]+$", "")
    cut = cut_bytes(F.left(whole, F.lit(TITLE_MOST)), TITLE_MOST_BYTES)
    titled = F.when(cut == whole, whole).otherwise(F.concat(F.regexp_replace(cut, r"[ .-]+$", ""), F.lit("…")))
    titled = F.when(F.lower(titled) == "index", F.concat(titled, F.lit(" (page)"))).otherwise(titled)
    return F.when(titled == "", F.lit(fallback)).otherwise(titled)


def strip_suffix(title: Column, suffix: str) -> Column:
    """The text before the first suffix, the whole title if nothing is before it."""
    before = F.trim(F.substring_index(title, suffix, 1))
    return F.when(before == "", title).otherwise(before)


def name_stem(name: Column) -> Column:
    return F.regexp_replace(name, r"[.][A-Za-z0-9]{1,5}$", "")


def qualifier(text: Column) -> Column:
    """A few words that can tell titles apart: refused and control characters as -, one line, 60 characters."""
    return F.regexp_replace(F.left(fold(F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x00-\x1f\\/:*?\"<>|]", "-")), F.lit(60)), r"^[ .-]+|[ .-]+$", "")


def _swapped(text: Column) -> Column:
    for bad, good in LINE_SWAPS:
        text = F.replace(text, F.lit(bad), F.lit(good))
    return F.regexp_replace(text, r"(?i)\bwww[.]", "www․")


def host_line(text: Column) -> Column:
    """Text in which nothing reads as a link, a rule or emphasis."""
    return _swapped(fold(text))


def capped(text: Column, most: int = 200) -> Column:
    return F.when(F.char_length(text) <= most, text).otherwise(F.concat(F.left(text, F.lit(most - 1)), F.lit("…")))


def bullet_line(text: Column) -> Column:
    """The mail form: folded, quotes and brackets translated, then host_line, then cut."""
    return capped(_swapped(F.translate(fold(text), "`[]", "'()")))


def bullet_line_task(text: Column) -> Column:
    """The task form: host_line first, then folded and translated, then cut."""
    return capped(F.translate(fold(_swapped(F.coalesce(text, F.lit("")))), "`[]", "'()"))


def video_plain(text: Column) -> Column:
    """Prose that cannot open markup: <, [[, %% and $$ are escaped, and a link whose target is not http(s) is none."""
    for mark, instead in (("<", "&lt;"), ("[[", "\\[\\["), ("%%", "\\%\\%"), ("$$", "\\$\\$")):
        text = F.replace(text, F.lit(mark), F.lit(instead))
    return F.regexp_replace(text, r"\]\((?!https?://)", r"]\\(")


def unblocked(line: Column) -> Column:
    """A backslash before what would open a block."""
    return F.when(line.rlike(r"^\s*([#>+*-]|[0-9]+[.)]|```|~~~|\|)"), F.concat(F.lit("\\"), line)).otherwise(line)


def table_cell(text: Column) -> Column:
    return F.replace(F.replace(fold(text), F.lit("\\"), F.lit("\\\\")), F.lit("|"), F.lit("\\|"))


def plain_quotes(text: Column) -> Column:
    return F.replace(fold(text), F.lit("`"), F.lit("'"))


def quoted(text: Column) -> Column:
    """A block quote of the text's lines, openers and < escaped, no blank lines at the end."""
    lines = F.split(F.regexp_replace(F.coalesce(text, F.lit("")), r"\s+$", ""), "\r?\n", -1)
    return F.array_join(F.transform(lines, lambda x: F.rtrim(F.concat(F.lit("> "), unblocked(F.replace(fold(x), F.lit("<"), F.lit("&lt;")))))), "\n")


def safe_id(text: Column) -> Column:
    """Letters, digits, _ and -; other runs are one _; 120 characters; null if nothing is left."""
    return F.nullif(F.left(F.regexp_replace(F.regexp_replace(text.cast("string"), "[^A-Za-z0-9_-]+", "_"), "^_+|_+$", ""), F.lit(120)), F.lit(""))


def mail_pointer(ident: Column) -> Column:
    return F.concat(F.lit("gmail:"), ident)


def task_pointer(ident: Column, origin: str = "https://www.notion.so/") -> Column:
    """A short page address for 32 hex digits (dashes aside), else a plain pointer."""
    bare = F.lower(F.replace(ident, F.lit("-"), F.lit("")))
    return F.when(bare.rlike("^[0-9a-f]{32}$"), F.concat(F.lit(origin), bare)).otherwise(F.concat(F.lit("notion:"), ident))


def id_in_name(name: Column) -> Column:
    """The id of a file named stamp--id.json."""
    return F.nullif(F.regexp_extract(name, r"^.*?--(.*)[.]json$", 1), F.lit(""))


def tags(values: Column) -> Column:
    """Lower-kebab tags, / kept between levels, each once in its first place."""
    made = F.transform(values, lambda t: F.regexp_replace(F.regexp_replace(F.regexp_replace(F.lower(t), "[^a-z0-9/]+", "-"), "-*/-*", "/"), "^[-/]+|[-/]+$", ""))
    return F.array_distinct(F.filter(made, lambda t: t != ""))


def first_lines(text: Column) -> Column:
    """The folded lines of a text that are not empty."""
    return F.filter(F.transform(F.split(F.coalesce(text, F.lit("")), r"\r\n|[\n\r\x0b\x0c\x1c-\x1e\x85\u2028\u2029]", -1), fold), lambda x: x != "")


CLOCK = r"^(?:[0-9]{1,2}:)?[0-9]{1,2}:[0-9]{2}$"


def link_title(text: Column, cap: int = 80) -> Column:
    """The first line that is no duration; none for a text that fills the cap, as it may be cut."""
    line = F.get(F.filter(first_lines(text), lambda x: ~x.rlike(CLOCK)), 0)
    return F.when(F.char_length(F.coalesce(text, F.lit(""))) < cap, line)


def link_duration(text: Column) -> Column:
    return F.get(F.filter(first_lines(text), lambda x: x.rlike(CLOCK)), 0)


def card_name(text: Column) -> Column:
    """A card's name: its first line that ends in an extension, else its first that is no badge, else its first."""
    lines = first_lines(text)
    named = F.get(F.filter(lines, lambda x: x.rlike(r"[.][A-Za-z0-9]{1,5}$")), 0)
    worded = F.get(F.filter(lines, lambda x: ~x.rlike(r"^[A-Z0-9 :.]{1,8}$")), 0)
    return F.coalesce(named, worded, F.get(lines, 0))


@pandas_udf(T.StringType())
def page_key(titles: Iterator[pd.Series]) -> Iterator[pd.Series]:
    """What two titles share that make one file: composed, case-folded. Spark has no normaliser."""
    import unicodedata

    for s in titles:
        yield s.map(lambda t: None if t is None else unicodedata.normalize("NFC", t.strip()).casefold())


@cache
def _ascii_letters() -> tuple[str, str, str, dict[str, str]]:
    """From the decompositions of all characters: those that are one ASCII letter or digit, these, those of them with marks behind it, and what else holds any."""
    import re
    import unicodedata

    plain, to, marked, odd = [], [], [], {}
    for c in map(chr, (*range(128, 0xD800), *range(0xE000, 0x110000))):
        folded = re.sub("[^a-z0-9]+", " ", unicodedata.normalize("NFKD", c).lower())
        if len(folded.strip()) == 1 and not folded.startswith(" "):
            plain.append(c)
            to.append(folded[0])
            if len(folded) > 1:
                marked.append(c)
        elif folded.strip():
            odd[c] = folded
    return "".join(plain), "".join(to), "".join(marked), odd


def _ranges(characters: Iterable[str]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for c in sorted(map(ord, characters)):
        if out and c == out[-1][1] + 1:
            out[-1] = (out[-1][0], c)
        else:
            out.append((c, c))
    return out


def match_title(title: Column) -> Column:
    """Decomposed (compatibility) lower ASCII letters and digits, other runs one space: what two titles of a show must share to be compared.

    Spark has no normaliser: letters are translated by a table from the characters' decompositions, a mark is a space behind its letter, and characters of
    several letters, as ligatures, are looked up in a map where a title has any."""
    plain, to, marked, odd = _ascii_letters()
    # ASCII is turned away first, the rest goes by ranges
    among = lambda cs: "[[^\\x00-\\x7f]&&[" + "".join(f"\\x{{{a:x}}}-\\x{{{b:x}}}" for a, b in _ranges(cs)) + "]]"
    table = F.str_to_map(F.lit(",".join(f"{c}:{said}" for c, said in odd.items())), F.lit(","), F.lit(":"))  # folded to one literal
    spelt = F.when(title.rlike(among(odd)), F.array_join(F.transform(F.split(title, ""), lambda c: F.coalesce(F.element_at(table, c), c)), "")).otherwise(title)
    letters = F.when(spelt.rlike(r"[^\x00-\x7f]"), F.translate(F.regexp_replace(spelt, f"({among(marked)})", "$1 "), plain, to)).otherwise(spelt)
    # only ASCII letters are lowered from here on: others are signs
    return F.trim(F.regexp_replace(F.translate(letters, string.ascii_uppercase, string.ascii_lowercase), "[^a-z0-9]+", " "))
