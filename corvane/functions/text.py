"""Text functions as column expressions; Unicode repair, HTML parsing and sentence splitting go through an Arrow UDF."""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Callable
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from ..sources.batches import bounded
from . import cleaning

# Patterns, bounds and words that decide results.
URL_PATTERNS = (r"https?://\S+", r"www\.\S+")
URL_SIGNS = ("://", "www.")
CONTROL = r"[\x00-\x08\x0b\x0c\x0e-\x1f\x7f]"
INVALID = r"[\p{C}&&[^\t\n\r]]"
INVALID_PAIRS = r"[\p{C}&\[\^\t\n\r]\]"
BLOCK_CLOSE = r"(?i)(</p>|<br>|<br/>|</tr>|</div>|</li>)"
BLOCK_OPEN = r"(?i)(<p>|<div>|<tr>|<li>)"
HTML_MARKS = ("<table", "<div", "<p")
TITLE_GARBAGE = (r"^file[_-]\d+", r"^doc[_-]\d+", r"^id[_-]\d+$", r"^img[_-]\d+$", r"^untitled\s*\d*$", r"^\d{4}-\d{2}-\d{2}$", r"^\d+$", r"^[\W_]+$")
TITLE_SUFFIX = r"(?i)\.(pdf|docx|txt|md|json|html)$"
STOPWORDS = (
    "the", "be", "to", "of", "and", "a", "in", "that", "have", "i", "it", "for", "not", "on", "with", "he", "as", "you", "do", "at",
    "this", "but", "his", "by", "from", "they", "we", "say", "her", "she", "or", "an", "will", "my", "one", "all", "would", "there", "their",
)
def strip(c: Column) -> Column:
    """Without Unicode white space at both ends (trim takes spaces only)."""
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")


def remove_urls(c: Column) -> Column:
    for pattern in URL_PATTERNS:
        c = F.regexp_replace(c, pattern, "")
    return c


def remove_control_chars(c: Column) -> Column:
    return F.regexp_replace(c, CONTROL, "")


def keep_valid_unicode(c: Column, compat: bool = False) -> Column:
    """Without control, format, private and unassigned characters but tab and line ends; compat: only what a set misread by one regex dialect removes, such as the pair &]."""
    return F.regexp_replace(c, INVALID_PAIRS if compat else INVALID, "")


def clean_whitespace(c: Column) -> Column:
    """One space for runs of horizontal space, one line end for runs that begin with one."""
    c = F.regexp_replace(c, r"[ \t\r\f\x0b]+", " ")
    c = F.regexp_replace(c, r"(?U)\n\s+", "\n")
    return F.regexp_replace(c, r"\n{3,}", "\n\n")


def detect_language(c: Column) -> Column:
    """en if over 80 % of the characters are ASCII, else other; null and empty are other."""
    share = F.length(F.regexp_replace(c, r"[^\x00-\x7F]", "")) / F.length(c)
    return F.when((F.length(c) > 0) & (share > 0.8), "en").otherwise("other")


def looks_like_html(c: Column) -> Column:
    low = F.lower(c)
    found = low.contains(HTML_MARKS[0])
    for mark in HTML_MARKS[1:]:
        found = found | low.contains(mark)
    return found


def break_blocks(c: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(c, BLOCK_CLOSE, "\n"), BLOCK_OPEN, "\n")


def strip_tags(c: Column) -> Column:
    """What is left of text in which the parser fails: tags become spaces."""
    return F.when(looks_like_html(c), F.regexp_replace(break_blocks(c), r"<[^>]+>", " ")).otherwise(c)


class _Text(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.parts, self.hidden = [], 0

    def handle_starttag(self, tag, attrs):
        self.hidden += tag in ("script", "style")

    def handle_endtag(self, tag):
        self.hidden -= tag in ("script", "style") and self.hidden > 0

    def handle_data(self, data):
        if not self.hidden:
            self.parts.append(data)


def _html_text(text: str) -> str:
    parser = _Text()
    parser.feed(text)
    parser.close()
    return "\n".join(parser.parts)


def _over(f: Callable[[str], str], c: Column) -> Column:
    """f over Arrow batches of c, bounded by bytes; null stays null."""
    bounded()

    def each(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: None if t is None else f(t))

    return F.pandas_udf(each, "string")(c)


def _nfkc(text: str) -> str:
    return text if text.isascii() else unicodedata.normalize("NFKC", text)


def normalize_unicode(c: Column) -> Column:
    """NFKC."""
    return _over(_nfkc, c)


def _has_html(text: str) -> bool:
    low = text.lower()
    return any(mark in low for mark in HTML_MARKS)


def _plain(text: str) -> str:
    return _html_text(re.sub(BLOCK_OPEN, "\n", re.sub(BLOCK_CLOSE, "\n", text))) if _has_html(text) else text


def html_to_text(c: Column) -> Column:
    """The text of HTML, block ends as line ends; other text stays. Script and style hold no text."""
    return _over(_plain, c)


def _misread() -> tuple[dict[str, int], re.Pattern]:
    """The byte that each character stands for which Windows-1252 or Latin-1 makes of a byte over 127, undefined ones included, and stretches of such that are UTF-8 by their form."""
    byte = {chr(b): b for b in range(0x80, 0x100)}
    for b in range(0x80, 0xA0):
        try:
            byte[bytes([b]).decode("cp1252")] = b
        except UnicodeDecodeError:  # left undefined
            pass
    of = lambda low, high: "[" + "".join(c for c, b in byte.items() if low <= b <= high) + "]"
    more = of(0x80, 0xBF)
    return byte, re.compile(f"(?:{of(0xC2, 0xDF)}{more}|{of(0xE0, 0xEF)}{more}{{2}}|{of(0xF0, 0xF4)}{more}{{3}})+")


BYTES, STRETCHES = _misread()


def _reread(m: re.Match) -> str:
    """A stretch read as UTF-8; it stays if it is none, or gives a lone sign of a script that Western text has no use for, or a control character from one that is none."""
    try:
        out = bytes(map(BYTES.__getitem__, m[0])).decode("utf-8")
    except UnicodeDecodeError:
        return m[0]
    if any("\x80" <= c < "\xa0" for c in out) and not any("\x80" <= c < "\xa0" for c in m[0]):
        return m[0]
    return out if all(c < "\u0180" or c >= "\u2000" or c in BYTES or (len(out) > 1 and not "\u0250" <= c < "\u0370") for c in out) else m[0]


def repaired(text: str) -> str:
    """Text in which stretches of UTF-8 were read as Windows-1252 or Latin-1, any number of times, read rightly.

    Each stretch takes the shortest chain of re-readings after which nothing in it looks misread. Bytes that the code page
    leaves undefined and no-break spaces are part of stretches. All other text stays as it is.
    """
    while not text.isascii() and (after := STRETCHES.sub(_reread, text)) != text:
        text = after  # shorter each time
    return text


def repair_mojibake(c: Column) -> Column:
    """Repair of wrongly decoded text: by ftfy where it is installed, else of stretches in which UTF-8 was read as a Western code page."""
    return _over(_repair(), c)


def _repair() -> Callable[[str], str]:
    try:
        import ftfy
    except ImportError:
        return repaired
    return ftfy.fix_text


def _python_steps(c: Column) -> Column:
    """Repair, NFKC and HTML in one Arrow UDF."""
    fix = _repair()
    return _over(lambda t: _plain(_nfkc(fix(t))), c)


def _once(c: Column, then: Callable[[Column], Column]) -> Column:
    """then(c) with c evaluated once, however often `then` names it."""
    return F.get(F.transform(F.array(c), then), F.lit(0))


def is_clean_enough(c: Column) -> Column:
    """At least 15 characters, and a stop word among the first 100 words if there are more than 50."""
    ws = F.slice(F.filter(F.split(F.lower(c), r"(?U)\s+"), lambda w: w != ""), 1, 100)
    stop = F.exists(ws, lambda w: w.isin(*STOPWORDS))
    return (F.length(c) >= 15) & ~((F.size(ws) > 50) & ~stop)


def full_text_cleaning(c: Column, compat: bool = False, python_steps: bool = True) -> Column:
    """The cleaned text, or null for blank or poor text. python_steps: mojibake repair, NFKC and HTML, which need a UDF.

    With those steps all of the chain is one pass in that UDF; without them, or with compat, it is the chain of columns,
    which gives the same.
    """
    if python_steps and not compat:
        fix = _repair()
        urls = tuple((sign, p.replace(r"\S", r"[^ \t\n\x0b\f\r]")) for sign, p in zip(URL_SIGNS, URL_PATTERNS))
        return cleaning.cleaning_column(c, lambda t: t if t.isascii() and "<" not in t else _plain(_nfkc(fix(t))), cleaning.class_runs((CONTROL, INVALID)), urls, STOPWORDS)
    return chain_of_columns(c, compat, python_steps)


def chain_of_columns(c: Column, compat: bool = False, python_steps: bool = True) -> Column:
    """full_text_cleaning step by step, each a column function."""
    steps = lambda t: strip(clean_whitespace(keep_valid_unicode(remove_control_chars(remove_urls(t)), compat)))
    cleaned = _once(_python_steps(c) if python_steps else c, steps)
    return F.when(strip(c) != "", _once(cleaned, lambda t: F.when(is_clean_enough(t), t)))


def cleaned_at_least(c: Column, least: int, **options) -> Column:
    """full_text_cleaning as an array: the text if it has `least` characters, else nothing. To be exploded, so that each text is cleaned once, filter included."""
    return F.filter(F.array(full_text_cleaning(c, **options)), lambda t: F.length(t) >= least)


def count_tokens(c: Column) -> Column:
    """The estimate that stands in for a tokenizer: a quarter of the characters."""
    return F.floor(F.length(c) / 4).cast("int")


def is_long_enough(c: Column, least: int = 32) -> Column:
    return F.coalesce(count_tokens(c) >= least, F.lit(False))


def is_good_title(c: Column) -> Column:
    """2 to 200 characters, none of the machine-made patterns, at least one letter."""
    t = strip(c)
    ok = F.length(t).between(2, 200) & t.rlike(r"[\p{L}\p{N}]") & t.rlike(r"\p{L}")
    for pattern in TITLE_GARBAGE:
        ok = ok & ~F.lower(t).rlike(f"(?U){pattern}")
    return F.coalesce(ok, F.lit(False))


def clean_title(c: Column) -> Column:
    """Without URLs if there is a space, without a file suffix, single spaces, without -_:;,. at the ends."""
    t = F.when(c.contains(" "), remove_urls(c)).otherwise(c)
    t = F.regexp_replace(F.regexp_replace(t, TITLE_SUFFIX, ""), r"(?U)\s+", " ")
    return strip(F.btrim(t, F.lit(" -_:;,.")))


def title_words(c: Column, most: int = 16) -> Column:
    """The first words of a good title's clean form; null if there are none. A tokenizer's ids go the same way."""
    found = F.slice(F.filter(F.split(clean_title(c), " "), lambda w: w != ""), 1, most)
    return F.when(is_good_title(c) & (F.size(found) > 0), found)


def split_sentences(text: str, breaks: str = r".!?\n。！？;；\r") -> list[tuple[str, int, int]]:
    """(stripped text, start, end) of each sentence with its end; runs of breaks without one before them are passed over."""
    out = [(m[0].strip(), m.start(), m.end()) for m in re.finditer(f"[^{breaks}]+(?:[{breaks}]+\\s*)?|[{breaks}]+\\s*", text) if not re.match(f"[{breaks}]", m[0]) and m[0].strip()]
    return out or ([(text.strip(), 0, len(text))] if text.strip() else [])


def sentences(c: Column, breaks: str = r".!?\n。！？;；\r") -> Column:
    """array<struct<text, start, end>>: sentences with their ends glued on, in code points of the text.

    A run of break characters with the white space after it ends a sentence; such runs without a sentence before them are
    passed over, offsets going on. Text without sentences is one. Linear in the text, over Arrow batches.
    """

    def each(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: None if t is None else [{"text": s, "start": a, "end": b} for s, a, b in split_sentences(t, breaks)])

    return F.pandas_udf(each, "array<struct<text:string,start:int,end:int>>")(c)


def first_break(text: Column, start: Column, end: Column) -> Column:
    """The position after the first break character in [start, end); end if there is none."""
    at = F.regexp_instr(F.substring(text, start + 1, F.greatest(end - start, F.lit(0))), F.lit(r"[.!?\n。！？;；]"))
    return F.when(at > 0, start + at).otherwise(end)


def last_break(text: Column, start: Column, end: Column) -> Column:
    """The position after the last break character in [start, end); start if there is none."""
    at = F.regexp_instr(F.reverse(F.substring(text, start + 1, F.greatest(end - start, F.lit(0)))), F.lit(r"[.!?\n。！？;；]"))
    return F.when(at > 0, F.least(end, F.length(text)) - at + 1).otherwise(start)


def preview(c: Column, most: int = 500) -> Column:
    return F.when(F.length(c) > most, F.concat(F.left(c, F.lit(most)), F.lit("..."))).otherwise(c)


def hms(seconds: Column) -> Column:
    s = F.floor(seconds).cast("long")
    return F.format_string("%02d:%02d:%02d", F.floor(s / 3600), F.floor(s % 3600 / 60), s % 60)
