"""Text column functions for scraped listing and article fields (STR-*, DT-6..8).

Every function is a Column -> Column builder over built-in expressions (no Python UDF). Java regex ``\\w`` and
``\\s`` are ASCII-only, so Cyrillic is spelled as ``[А-Яа-я]`` and NBSP is replaced before matching.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from snapmetrics.functions.common import as_col, bound, nonempty

# Bulgarian month names in calendar order (a text's month word is a prefix of one of them).
BG_MONTHS = [
    "януари", "февруари", "март", "април", "май", "юни",
    "юли", "август", "септември", "октомври", "ноември", "декември",
]
# Listing type rewrites, applied in this order after lower + strip.
TYPE_REWRITES = [("1-", "едно"), ("2-", "дву"), ("3-", "три"), ("4-", "четири"), (" апартамент", "")]
# Literals removed from a listing place, in this order, after lower + strip.
PLACE_DROPS = ["гр. софия", "софийска област", "българия", "/", ",", "близо до"]
# Apartment-type pattern, Finnish listing hosts, the on-request price text and ground-floor words.
APARTMENT_PATTERN = "(?:стаен|мезонет|ателие)"
FI_HOSTS = ["etuovi.com", "www.vuokraovi.com"]
ON_REQUEST = "при запитване"
GROUND_FLOORS = ["партер", "сутерен"]
CYRILLIC_WORD = "[А-Яа-я]+"  # the reference's Cyrillic letter class (fixed value)


# Whitespace removed from both ends by ``strip`` (Python's ``str.strip()`` for the characters scraped text holds).
STRIP_CHARS = " \t\n\r\x0b\x0c\xa0"


def strip(c) -> Column:
    """Python ``str.strip()`` for the whitespace that occurs in scraped text (incl. NBSP); ``btrim`` touches only
    the ends, so long texts are not rescanned."""
    return F.btrim(as_col(c), F.lit(STRIP_CHARS))


def clean_text(c) -> Column:
    """STR-1: newlines/tabs/NBSP (and the literal ``\\xa0`` text) -> space; ``"`` ``„`` ``“`` -> ``'``; strip."""
    s = F.replace(as_col(c), F.lit("\\xa0"), F.lit(" "))
    s = F.replace(s, F.lit("&nbsp;"), F.lit(" "))
    s = F.translate(s, "\n\r\t \"„“", "    '''")
    return strip(s)


def replace_chain(c, pairs) -> Column:
    s = as_col(c)
    for a, b in pairs:
        s = F.replace(s, F.lit(a), F.lit(b))
    return s


def listing_type(c) -> Column:
    """STR-3: canonical room type."""
    return replace_chain(strip(F.lower(as_col(c))), TYPE_REWRITES)


def listing_place(c) -> Column:
    """STR-4: lower, strip, drop the fixed literals (no final trim, as in the reference)."""
    return replace_chain(strip(F.lower(as_col(c))), [(x, "") for x in PLACE_DROPS])


def is_apartment(type_col) -> Column:
    """STR-5."""
    return F.coalesce(as_col(type_col).rlike(APARTMENT_PATTERN), F.lit(False))


def country(link) -> Column:
    """STR-6: ``fi`` for the Finnish hosts, else ``bg``."""
    l_ = as_col(link)
    cond = F.lit(False)
    for h in FI_HOSTS:
        cond = cond | F.coalesce(l_.contains(h), F.lit(False))
    return F.when(cond, F.lit("fi")).otherwise(F.lit("bg"))


def after_place(addr, place) -> Column:
    """STR-16: everything after the first occurrence of the (trimmed) place; null when absent or nothing follows."""
    a, p = as_col(addr), F.trim(as_col(place))
    pos = F.call_function("instr", a, p)
    return F.when(pos > 0, nonempty(F.call_function("substr", a, pos + F.length(p))))


def short_title(c) -> Column:
    """STR-21: title cut at three spaces, lower-cased."""
    return F.lower(F.split_part(as_col(c), F.lit("   "), F.lit(1)))


def strip_literals(c, literals: list[str]) -> Column:
    """STR-29: drop fixed prefixes/literals in order."""
    return replace_chain(c, [(x, "") for x in literals])


def tidy_place(c) -> Column:
    """STR-28: collapse whitespace, ``-`` -> ``,``, strip trailing commas."""
    s = F.regexp_replace(as_col(c), r"\s+", " ")
    s = F.replace(s, F.lit("-"), F.lit(","))
    return F.regexp_replace(F.trim(s), r",+$", "")


def between(c, start: str, end: str) -> Column:
    """STR-15: text between the first ``start`` and the next ``end``; null when absent."""
    return nonempty(
        F.regexp_extract(as_col(c), "(?s)" + _quote(start) + "(.*?)" + _quote(end), 1)
    )


def cut_before(c, marker: str) -> Column:
    """STR-33: text before the first ``marker``."""
    return F.substring_index(as_col(c), marker, 1)


def cut_after(c, marker: str) -> Column:
    """STR-33: text after the first ``marker`` (whole text when absent)."""
    s = as_col(c)
    pos = F.instr(s, marker)
    return F.when(pos > 0, F.call_function("substr", s, pos + F.lit(len(marker)))).otherwise(s)


def _quote(s: str) -> str:
    return "\\Q" + s + "\\E"


def month_number(word) -> Column:
    """JN-9: month word -> ``01``..``12``: the first month (calendar order) whose name starts with the word."""
    w = F.lower(as_col(word))
    out = None
    for i, name in enumerate(BG_MONTHS, start=1):
        cond = (F.length(w) > 0) & F.lit(name).startswith(w)
        out = F.when(cond, F.lit(f"{i:02d}")) if out is None else out.when(cond, F.lit(f"{i:02d}"))
    return out


NUMERIC_DATE = r"(\d{1,2})\.(\d{1,2})\.(\d{4})"
CLOCK_TIME = r"(\d{1,2}):(\d{2})(?::(\d{2}))?"


def parse_bg_datetime(c) -> Column:
    """DT-6/DT-7: Bulgarian date text -> TIMESTAMP_NTZ; null when it cannot be read.

    Numeric ``dd.MM.yyyy`` first; otherwise the first Cyrillic word that names a month (prefix match, ``Дек.`` and
    ``дек`` included), the day is the first number and the year the last 2–4 digit number (``19`` -> 2019) once
    the time is taken out. The time is the first ``HH:mm[:ss]`` (midnight when absent). The parts are read with
    regex groups and assembled with ``try_make_timestamp_ntz`` — no formatter attempts that fail row by row — and
    the month-word work runs only for rows without a numeric date.
    """
    s = as_col(c)

    def grp(src, pattern, i):
        return F.nullif(F.regexp_extract(src, pattern, i), F.lit(""))

    hh = F.coalesce(grp(s, CLOCK_TIME, 1).try_cast("int"), F.lit(0))
    mi = F.coalesce(grp(s, CLOCK_TIME, 2).try_cast("int"), F.lit(0))
    sec = F.coalesce(grp(s, CLOCK_TIME, 3).try_cast("decimal(8,6)"), F.lit(0).cast("decimal(8,6)"))
    num_y = grp(s, NUMERIC_DATE, 3)
    numeric = F.try_make_timestamp_ntz(
        num_y.try_cast("int"), grp(s, NUMERIC_DATE, 2).try_cast("int"), grp(s, NUMERIC_DATE, 1).try_cast("int"),
        hh, mi, sec,
    )
    words = F.regexp_extract_all(s, F.lit(f"({CYRILLIC_WORD})"), 1)
    word_month = F.try_element_at(F.filter(F.transform(words, month_number), lambda m: m.isNotNull()), F.lit(1))
    rest = F.regexp_replace(s, CLOCK_TIME, " ")
    word_day = grp(rest, r"^\D*?(\d{1,2})(?!\d)", 1)
    word_year = grp(rest, r"(\d{2,4})\D*$", 1)
    yi = word_year.try_cast("int")
    word_y = F.when(F.length(word_year) == 2, F.lit(2000) + yi).otherwise(yi)
    worded = F.try_make_timestamp_ntz(word_y, word_month.try_cast("int"), word_day.try_cast("int"), hh, mi, sec)
    # the month-word branch is only evaluated for rows without a numeric date
    return F.when(num_y.isNotNull(), numeric).otherwise(F.when(word_month.isNotNull(), worded))


def term_range(c, which: str) -> Column:
    """DT-8: ``от <date>`` / ``до <date>`` -> the date text after the marker."""
    marker = "от" if which == "start" else "до"
    return nonempty(F.regexp_extract(as_col(c), marker + r"\s+(\d{1,2}\.\d{1,2}\.\d{4})", 1))


HTML_NOISE = r"(?s)<script.*?</script>|<style.*?</style>|<!--.*?-->"


def strip_noise(html) -> Column:
    """Remove scripts, styles and comments before any extraction (pages hide ``</p>`` inside scripts)."""
    return F.regexp_replace(as_col(html), HTML_NOISE, "")


def strip_tags(c) -> Column:
    return F.regexp_replace(as_col(c), r"<[^>]*>", "")


def paragraphs(html, exclude: list[str] | None = None) -> Column:
    """HTM-1/FLT-16: cleaned, non-empty paragraph texts in page order (unclosed ``<p>`` tolerated); paragraphs
    containing any ``exclude`` phrase are dropped."""
    split = F.split(as_col(html), r"<p(?:\s[^>]*)?>")
    pieces = F.slice(split, F.lit(2), F.size(split))
    texts = F.transform(
        pieces,
        lambda p: clean_text(strip_tags(F.substring_index(F.substring_index(p, "</p>", 1), "</article>", 1))),
    )
    phrases = list(exclude or [])

    def keep(t):
        cond = F.length(t) > 0
        for ph in phrases:
            cond = cond & ~t.contains(ph)
        return cond

    return F.filter(texts, keep)


def tag_text(html, tag: str) -> Column:
    """Text of the first ``<tag>…</tag>`` (cleaned); null when absent."""
    return nonempty(clean_text(strip_tags(F.regexp_extract(as_col(html), rf"(?s)<{tag}(?:\s[^>]*)?>(.*?)</{tag}>", 1))))


def inner_html(rest: Column, tag: Column) -> Column:
    """What of ``rest`` (the page after a start tag of kind ``tag``) lies inside that element: up to the end tag that brings the
    running depth of this kind to zero; null if there is none. Mostly the first tag of this kind that follows is that end tag. Else
    the depth is a fold over the pieces between tags that keeps two numbers, so nested elements of any depth take one pass."""
    def step(pieces: Column, kind: Column) -> Column:
        def move(acc: Column, piece: Column) -> Column:
            same = F.lower(F.regexp_extract(piece, "^</?([a-zA-Z][a-zA-Z0-9]*)", 1)) == kind
            depth = acc["depth"] + F.when(same, F.when(piece.startswith("</"), -1).otherwise(1)).otherwise(0)
            return F.when(acc["depth"] == 0, acc).otherwise(F.struct(depth.alias("depth"), (acc["n"] + F.when(depth > 0, 1).otherwise(0)).alias("n")))

        end = F.aggregate(pieces, F.struct(F.lit(1).alias("depth"), F.lit(0).alias("n")), move)
        return bound(end, lambda e: F.when(e["depth"] == 0, F.array_join(F.slice(pieces, F.lit(1), e["n"]), "")))

    def folded(page: Column, kind: Column) -> Column:
        parts = F.struct(F.split(page, "(?=</?[a-zA-Z])").alias("pieces"), F.lower(kind).alias("kind"))
        return bound(parts, lambda p: step(p["pieces"], p["kind"]))

    def of(p: Column) -> Column:
        cut = F.split(p["rest"], F.concat(F.lit("(?i)</?"), p["kind"], F.lit("(?![a-zA-Z0-9])")), 2)
        closes = lambda c: p["rest"].substr(F.length(c[0]) + 1, F.lit(2)) == "</"
        return bound(cut, lambda c: F.when(F.size(c) == 2, F.when(closes(c), c[0]).otherwise(folded(p["rest"], p["kind"]))))

    return bound(F.struct(rest.alias("rest"), tag.alias("kind")), of)


def class_text(html, name: str) -> Column:
    """Text of the first element whose class holds the word ``name``, elements inside it included; null when absent, empty or not
    closed."""
    start = rf"""<([a-z][a-z0-9]*)\s(?:[^>]*?\s)?class\s*=\s*["'](?:[^"'>]*\s)?{_quote(name)}(?:\s[^"'>]*)?["'][^>]*>"""
    page = as_col(html)

    def inner(tag: Column) -> Column:
        # the tag's text holds one ">", at its end: where it occurs first is where the pattern matches first (bytes that are
        # no UTF-8 are other text after matching, and found nowhere)
        cut = F.call_function("substr", page, F.call_function("instr", page, tag) + F.length(tag))
        rest = F.when(F.call_function("instr", page, tag) > 0, cut).otherwise(F.regexp_extract(page, f"(?s){start}(.*)", 2))
        return inner_html(rest, F.regexp_extract(tag, "^<([a-z][a-z0-9]*)", 1))

    found = bound(F.regexp_extract(page, start, 0), lambda tag: F.when(F.length(tag) > 0, inner(tag)))
    return bound(strip_tags(found), lambda text: nonempty(clean_text(text)))


def attribute_value(html, tag: str, attribute: str) -> Column:
    """Value of an attribute in the first ``tag`` that has it; null when absent or empty."""
    return nonempty(F.regexp_extract(as_col(html), rf"""(?s)<{tag}\s(?:[^>]*?\s)?{attribute}\s*=\s*["']([^"'>]*)["']""", 1))


def text_after(html, label: str) -> Column:
    """Text of the next element after the one whose text is ``label`` (label -> value tables and lists); null when absent."""
    pattern = rf"(?s)>\s*{_quote(label)}\s*:?\s*(?:<[^>]*>\s*)+([^<]+)"
    return nonempty(clean_text(F.regexp_extract(as_col(html), pattern, 1)))


def place_from_title(c, city: str = "София") -> Column:
    """STR-17: place between the city name and the price (``По договаряне`` or digits), dashes removed, stripped;
    '' when absent (as the reference)."""
    m = F.regexp_extract(as_col(c), _quote(city) + r"(.+?)(?=По договаряне|[\d]+)", 1)
    return F.trim(F.replace(m, F.lit("-"), F.lit("")))


# State words moved from a listing type into its labels, in this order.
STATE_WORDS = ["В процес на строителство", "Предварителни продажби"]
MULTI_UNIT_WORD = "апартаменти"
MULTI_UNIT_LABEL = "Множество апартаменти"
RECENT_MARK = "(публикувана"
RECENT_LABEL = "published recently"


def place_and_label(c) -> tuple[Column, Column]:
    """STR-24: text before ``(публикувана`` and a recently-published label ('' when absent)."""
    s = as_col(c)
    pos = F.instr(s, RECENT_MARK)
    place = F.when(pos > 0, F.substring(s, F.lit(1), pos - 1)).otherwise(s)
    label = F.when(pos > 0, F.lit(RECENT_LABEL)).otherwise(F.lit(""))
    return place, label


def _append_label(label: Column, word: str) -> Column:
    return F.when(F.length(label) > 0, F.concat(label, F.lit(", " + word))).otherwise(F.lit(word))


def extend_labels(type_col, label_col) -> tuple[Column, Column]:
    """STR-25: move state words from the type into the labels (parentheses dropped, type stripped); a multi-unit
    type adds its own label."""
    t, lab = as_col(type_col), as_col(label_col)
    # construction state
    has1 = t.contains(STATE_WORDS[0])
    t = F.when(has1, F.trim(F.translate(F.replace(t, F.lit(STATE_WORDS[0]), F.lit("")), "()", ""))).otherwise(t)
    lab = F.when(has1, _append_label(lab, STATE_WORDS[0])).otherwise(lab)
    # several units
    lab = F.when(F.lower(t).contains(MULTI_UNIT_WORD), _append_label(lab, MULTI_UNIT_LABEL)).otherwise(lab)
    # pre-sales
    has2 = t.contains(STATE_WORDS[1])
    t = F.when(has2, F.trim(F.translate(F.replace(t, F.lit(STATE_WORDS[1]), F.lit("")), "()", ""))).otherwise(t)
    lab = F.when(has2, _append_label(lab, STATE_WORDS[1])).otherwise(lab)
    return t, lab


def author_after_colon(c) -> Column:
    """STR-23: author as the Cyrillic words after the last ``:`` at the end of a meta line; null when absent."""
    return F.trim(nonempty(F.regexp_extract(as_col(c), r":([А-Яа-я\s]+$)", 1)))


def author_after_semicolon(c) -> Column:
    """STR-23: second ``;`` part of an info line; null when there is no ``;``."""
    s = as_col(c)
    return F.when(s.contains(";"), F.split_part(s, F.lit(";"), F.lit(2)))


def drop_control_chars(c) -> Column:
    """STR-26: remove stray control characters."""
    return F.regexp_replace(as_col(c), r"[\x00-\x08\x0B\x0C\x0E-\x1F\x7F]", "")


def leading_token(c, char_class: str = r"[\d\.\s]") -> Column:
    """STR-31: leading run of ``char_class`` (after an optional blank), stripped; null when absent."""
    return F.trim(nonempty(F.regexp_extract(as_col(c), rf"^(?:\s)?({char_class}+).*", 1)))


def all_words(c, pattern: str = CYRILLIC_WORD, sep: str = " - ") -> Column:
    """ARR-3: every match of ``pattern`` joined with ``sep``; null when none."""
    m = F.regexp_extract_all(as_col(c), F.lit(f"({pattern})"), 1)
    return F.when(F.size(m) > 0, F.array_join(m, sep))


def join_except(arr, excluded: list[str], sep: str = ", ") -> Column:
    """ARR-4: drop listed values (after strip) from an array, keep order and repeats, join."""
    kept = F.filter(as_col(arr), lambda x: ~F.trim(x).isin(*excluded))
    return F.array_join(kept, sep)
