"""Dates as ISO strings: on head lines, in URLs, of captures, in the Solar Hijri calendar, and the choice among them."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import lru_cache

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from tesserae.functions.languages import ISO_BY_NAME
from tesserae.functions.text import head_lines, nz, strip

# Month names, and what a date line may hold besides its date.
MONTHS = {
    "january": 1, "february": 2, "march": 3, "april": 4, "may": 5, "june": 6, "july": 7, "august": 8, "september": 9, "october": 10, "november": 11, "december": 12,
    "jan": 1, "feb": 2, "mar": 3, "apr": 4, "jun": 6, "jul": 7, "aug": 8, "sep": 9, "sept": 9, "oct": 10, "nov": 11, "dec": 12,
}
NOISE_SIGNS = r"|/\\\-–—,.:;()\[\]*«»\"'#"
NOISE_WORDS = ["published", "posted", "updated", "last", "modified", "date", "dated", "on", "at", "time", "print", "monday", "tuesday", "wednesday", "thursday", "friday", "saturday", "sunday"]
HIJRI_MONTHS = {
    "حمل": 1, "ثور": 2, "جوزا": 3, "سرطان": 4, "اسد": 5, "سنبله": 6, "سنبلة": 6, "میزان": 7, "عقرب": 8, "قوس": 9, "جدی": 10, "دلو": 11, "حوت": 12,
    "فروردین": 1, "اردیبهشت": 2, "خرداد": 3, "تیر": 4, "مرداد": 5, "شهریور": 6, "مهر": 7, "آبان": 8, "آذر": 9, "دی": 10, "بهمن": 11, "اسفند": 12,
}
HIJRI_YEARS = (1300, 1420)
#: Years of 33 in a row, counted from 0, that have a leap day in the Solar Hijri calendar; its first day in ours.
HIJRI_LEAPS, HIJRI_START = (1, 5, 9, 13, 17, 22, 26, 30), "0622-03-21"
OTHER_DIGITS, DIGITS = "۰۱۲۳۴۵۶۷۸۹٠١٢٣٤٥٦٧٨٩", "01234567890123456789"


@lru_cache(64)
def month_names(languages: tuple[str, ...] = tuple(sorted(set(ISO_BY_NAME.values()) - {"en"}))) -> dict[str, int]:
    """Month names of languages, long and short, as the Java runtime knows them.

    A name that means different months in two of the languages is left out, and
    so is one of fewer than three letters.
    """
    jvm = SparkSession.getActiveSession()._jvm
    found: dict[str, set[int]] = {}
    for code in languages:
        locale = jvm.java.util.Locale.forLanguageTag(code)
        for style in ("FULL", "FULL_STANDALONE", "SHORT", "SHORT_STANDALONE"):
            for k in range(1, 13):
                name = jvm.java.time.Month.of(k).getDisplayName(getattr(jvm.java.time.format.TextStyle, style), locale).lower().rstrip(".")
                if len(name) > 2 and name.isalpha():
                    found.setdefault(name, set()).add(k)
    return {name: next(iter(ks)) for name, ks in sorted(found.items()) if len(ks) == 1}


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once for each row."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def one_of(names) -> str:
    return "|".join(sorted(names, key=len, reverse=True))


def looked_up(name: Column, numbers: dict[str, int]) -> Column:
    return F.element_at(F.create_map(*[F.lit(x) for pair in numbers.items() for x in pair]), name)


def iso(y: Column, m: Column, d: Column) -> Column:
    """``YYYY-MM-DD`` of a date that exists, else null."""
    day = F.to_date(F.try_make_timestamp(y, m, d, F.lit(0), F.lit(0), F.lit(0)))
    return F.date_format(day, "yyyy-MM-dd")


def number(line: Column, pattern: str, group: int) -> Column:
    return F.regexp_extract(line, pattern, group).try_cast("int")


def year_of(c: Column) -> Column:
    s = strip(nz(c))
    return F.when(s.rlike(r"^\d{4}"), F.substring(s, 1, 4).cast("int"))


# A line is cut into tokens: numbers, words, single signs.  A letter stands for the
# kind of each, so that shapes are patterns over those letters and the place of a
# match is the place of its first token:
#   n number of one or two digits, y of four, x other; m month in English, M in another
#   language; s ending of an ordinal, f "of", l label or weekday, c character after a year,
#   month or day in East Asia; blanks are blanks and signs are themselves.
TOKEN = r"(?s)\d+|[\p{L}\p{M}]+|."
ORDINALS, OF = ["st", "nd", "rd", "th", "º", "ª"], ["of", "de", "del", "da", "do"]
AFTER = ["年", "月", "日", "년", "월", "일"]
NUMERIC = {"ymd": "y-n-n", "dmy": r"n\.n\.y", "slash": "n/n/y", "asia": "y ?c ?n ?c ?n ?c?"}
NAMED = r"n\.?s? *(?:f +)?[mM]\.?,? *(?:f +)?y|[mM]\.? +ns?,? +y"
DECORATION = rf"[l\s{NOISE_SIGNS}]*"
#: As in slugs, a slash or dash beside it makes an ISO date part of something else.
WHOLE_ISO = rf"^(?:{DECORATION}[l\s|\\–—,.:;()\[\]*«»\"'#])?y-n-n(?:[l\s|\\–—,.:;()\[\]*«»\"'#]{DECORATION})?$"


def kinds(ts: Column, others: dict[str, int]) -> Column:
    """The letters of tokens, one each."""
    n = lambda t: F.length(t)
    kind = lambda t: (
        F.when(t.rlike(r"^\d"), F.when(n(t) <= 2, "n").when(n(t) == 4, "y").otherwise("x")).when(t.isin(*MONTHS), "m").when(t.isin(*ORDINALS), "s").when(t.isin(*OF), "f")
        .when(t.isin(*NOISE_WORDS), "l").when(t.isin(*AFTER), "c").when(t.isin(*others) if others else F.lit(False), "M").when(t.rlike(r"^[\p{L}\p{M}]"), "x").when(t.rlike(r"^\s"), " ").otherwise(t)
    )
    return F.array_join(F.transform(ts, kind), "")


def tokens(line: Column) -> Column:
    return F.regexp_extract_all(F.lower(line), F.lit(TOKEN), 0)


def spelled(ts: Column, shape: Column, others: dict[str, int], month_first: bool | None) -> Column:
    """The ISO date of the tokens from a date on, given its shape (a key of ``NUMERIC``, else named).

    Of two numbers before a slash the one over 12 is the day; ``month_first``
    settles the rest, None leaves them unread.
    """
    numbers = F.transform(F.filter(ts, lambda t: t.rlike(r"^\d")), lambda t: t.try_cast("int"))

    def read(ns: Column) -> Column:
        a, b, z = (F.get(ns, F.lit(k)) for k in range(3))
        name = F.get(F.filter(ts, lambda t: t.isin(*MONTHS, *others)), F.lit(0))
        day_first, month_is_first = (a > 12) & (b <= 12), (b > 12) & (a <= 12)
        if month_first is not None:
            month_is_first = month_is_first | ((a <= 12) & (b <= 12) & F.lit(month_first))
            day_first = day_first | ((a <= 12) & (b <= 12) & F.lit(not month_first))
        return (
            F.when(shape.isin("ymd", "asia"), F.struct(a.alias("y"), b.alias("m"), z.alias("d"))).when(shape == "dmy", F.struct(z.alias("y"), b.alias("m"), a.alias("d")))
            .when((shape == "slash") & day_first, F.struct(z.alias("y"), b.alias("m"), a.alias("d"))).when((shape == "slash") & month_is_first, F.struct(z.alias("y"), a.alias("m"), b.alias("d")))
            .when(shape == "named", F.struct(b.alias("y"), looked_up(name, MONTHS | others).alias("m"), a.alias("d")))
        )

    return let(let(numbers, read), lambda x: F.when(x.isNotNull(), F.struct(x["y"].alias("y"), iso(x["y"], x["m"], x["d"]).alias("date"))))


def line_date(line: Column, min_year: int, max_year: Column, languages: Sequence[str] | None = None) -> Column:
    """The date that a line consists of, apart from decoration; null if it is prose."""
    others = month_names(tuple(languages)) if languages is not None else month_names()
    whole = lambda shape: rf"^{DECORATION}(?:{shape}){DECORATION}$"

    def judged(x: Column) -> Column:
        k = x["k"]
        shape = F.when(k.rlike(WHOLE_ISO), "ymd").when(k.rlike(whole(NUMERIC["dmy"])), "dmy").when(k.rlike(whole(NUMERIC["slash"])), "slash").when(k.rlike(whole(NAMED)), "named").when(k.rlike(whole(NUMERIC["asia"])), "asia")
        return let(shape, lambda sh: F.when(sh.isNotNull(), let(spelled(x["t"], sh, others, None), lambda d: F.when(d["y"].between(F.lit(min_year), max_year), d["date"]))))

    parts = let(tokens(line), lambda ts: F.struct(ts.alias("t"), kinds(ts, others).alias("k")))
    return F.when(line.rlike(r"\d"), let(parts, judged))


def head_date(text: Column, lines: int = 4, max_chars: int = 60, min_year: int = 1990, max_year: Column | None = None, languages: Sequence[str] | None = None) -> Column:
    """The first date that fills one of the first lines."""
    top = max_year if max_year is not None else F.year(F.current_date()) + 1
    dates = F.transform(head_lines(text, lines), lambda x: F.when(F.length(x) <= max_chars, line_date(x, min_year, top, languages)))
    return F.get(F.filter(dates, lambda d: d.isNotNull()), F.lit(0))


def parse_date(raw: Column, languages: Sequence[str] | None = None, today: Column | None = None, min_year: int = 1900, max_year: Column | None = None) -> Column:
    """The first date within a string as ISO, null without one or out of the plausible years.

    A leading ISO date counts at once.  ``languages`` names those whose month
    names count, all if None.  Of a slashed date that could be either, the
    month comes first if English is the only or first language, else the day.
    ``today`` lets "yesterday" and "3 days ago" count.
    """
    others = month_names(tuple(x for x in languages if x != "en")) if languages is not None else month_names()
    top = max_year if max_year is not None else F.year(F.current_date()) + 1
    month_first = bool(languages) and languages[0] == "en"
    s = strip(nz(raw))
    shapes = {**NUMERIC, "named": NAMED}

    def found(x: Column) -> Column:
        places = F.array_sort(F.filter(F.array(*[F.struct(F.regexp_instr(x["k"], F.lit(rf"(?<![yn/-])(?<![yn]\.)(?:{p})(?!\.?[yn]|[/-])")).alias("at"), F.lit(n).alias("n")) for n, p in shapes.items()]), lambda y: y["at"] > 0))
        first = F.get(places, F.lit(0))
        return F.when(F.size(places) > 0, spelled(F.slice(x["t"], first["at"], 40), first["n"], others, month_first))

    parts = let(tokens(s), lambda ts: F.struct(ts.alias("t"), kinds(ts, others).alias("k")))
    stamp = F.when(s.rlike(r"^\d{4}-\d{2}-\d{2}(?:$|[T ]\d)"), F.substring(s, 1, 10))
    leading = F.when(stamp.isNotNull(), F.date_format(F.try_to_date(stamp), "yyyy-MM-dd"))
    said = F.when(s.rlike(r"\d"), let(parts, found)["date"])
    if today is not None:
        low, n = F.lower(s), F.regexp_extract(F.lower(s), r"(\d+) (day|week|month|year)s? ago", 1).try_cast("int")
        unit = F.regexp_extract(low, r"(\d+) (day|week|month|year)s? ago", 2)
        day = today.cast("date")
        ago = F.when(unit == "day", F.date_sub(day, n)).when(unit == "week", F.date_sub(day, 7 * n)).when(unit == "month", F.add_months(day, -n)).when(unit == "year", F.add_months(day, -12 * n))
        ago = F.when(low.rlike(r"\byesterday\b"), F.date_sub(day, 1)).when(low.rlike(r"\btoday\b"), day).otherwise(ago)
        said = F.coalesce(said, F.date_format(ago, "yyyy-MM-dd"))
    return let(F.coalesce(leading, said), lambda d: F.when(F.substring(d, 1, 4).cast("int").between(F.lit(min_year), top), d))


def from_hijri(y: Column, m: Column, d: Column) -> Column:
    """The ISO date of a Solar Hijri one, null out of range: six months of 31 days, then of 30, over years of 365 or 366."""
    fits = y.between(*HIJRI_YEARS) & m.between(1, 12) & d.between(1, 31)
    leaps = F.floor((y - 1) / 33) * len(HIJRI_LEAPS) + sum(F.when((y - 1) % 33 >= k, 1).otherwise(0) for k in HIJRI_LEAPS)
    days = 365 * (y - 1) + leaps + 30 * (m - 1) + F.least(m - 1, F.lit(6)) + d - 1
    return F.when(fits, F.date_format(F.date_add(F.lit(HIJRI_START).cast("date"), days.cast("int")), "yyyy-MM-dd"))


def hijri_date(text: Column) -> Column:
    """struct<date, precision> of the first Solar Hijri date of a text in Arabic script.

    A day, month name and year go before a date in numbers, that before a year
    with month name and day, and a bare year is what is left.
    """
    year, month = r"1[34]\d{2}", one_of(HIJRI_MONTHS)
    shapes = [rf"\d{{1,2}}\s*(?:{month})\s*{year}", rf"(?<!\d){year}[-/.]\d{{1,2}}[-/.]\d{{1,2}}(?!\d)", rf"{year}\s*(?:{month})\s*\d{{1,2}}", rf"(?<!\d){year}(?!\d)"]
    years = rf"^{year}"

    def read(got: Column) -> Column:
        """Of a match: its numbers, of which the one with four digits is the year, and its month name if it has one."""
        numbers = F.transform(F.regexp_extract_all(got, F.lit(r"\d+"), 0), lambda t: t.cast("int"))
        name = looked_up(F.regexp_extract(got, month, 0), HIJRI_MONTHS)

        def date(ns: Column) -> Column:
            early = got.rlike(years)
            y, d = F.when(early, F.get(ns, F.lit(0))).otherwise(F.get(ns, F.lit(1))), F.when(F.size(ns) == 3, F.get(ns, F.lit(2))).when(early, F.get(ns, F.lit(1))).otherwise(F.get(ns, F.lit(0)))
            return from_hijri(y, F.when(F.size(ns) == 3, F.get(ns, F.lit(1))).otherwise(name), d)

        return let(numbers, date)

    def first(t: Column) -> Column:
        full = [F.regexp_extract(t, p, 0) for p in shapes[:3]]
        day = F.coalesce(*[F.when(x != "", read(x)) for x in full])
        bare = F.regexp_extract(t, shapes[3], 0).try_cast("int")
        only = F.when(bare.between(*HIJRI_YEARS), (bare + 621).cast("string"))
        return F.struct(day.alias("day"), only.alias("year"))

    script = nz(text).rlike("[؀-ۿ]")
    got = F.when(script, let(F.translate(nz(text), OTHER_DIGITS, DIGITS), first))
    return let(got, lambda x: F.struct(F.coalesce(x["day"], x["year"]).alias("date"), F.when(x["day"].isNotNull(), "day").when(x["year"].isNotNull(), "year").alias("precision")))


def capture_date(timestamp: Column) -> Column:
    """ISO form of an archive's time stamp, zero months and days counted as one; ``''`` if it is none."""
    s = nz(timestamp.cast("string"))
    y, m, d = (F.substring(s, a, n).try_cast("int") for a, n in ((1, 4), (5, 2), (7, 2)))
    m, d = F.when(m == 0, 1).otherwise(m), F.when(d == 0, 1).otherwise(d)
    fits = s.rlike(r"^\d{8}") & y.between(1990, 2100) & m.between(1, 12) & d.between(1, 31)
    return F.when(fits, F.concat_ws("-", F.lpad(y.cast("string"), 4, "0"), F.lpad(m.cast("string"), 2, "0"), F.lpad(d.cast("string"), 2, "0"))).otherwise("")


def full_year(c: Column, pivot: int = 69) -> Column:
    """A year of two digits in its century."""
    return F.when(c < 100, F.when(c < pivot, c + 2000).otherwise(c + 1900)).otherwise(c)


def url_date(url: Column, pattern: str, year: int = 1, month: int = 2, day: int = 3) -> Column:
    """The date that a URL's groups spell; null if there is none or it doesn't exist."""
    return iso(full_year(number(nz(url), pattern, year)), number(nz(url), pattern, month), number(nz(url), pattern, day))


def resolved(
    selector: Column, capture: Column, model: Column, model_agrees: Column, hijri: Column, head: Column,
    flag_years: int = 5, text_first: bool = False,
) -> Column:
    """The date of a document among its candidates, how it was chosen, and whether a person should look.

    ``hijri`` is a struct<date, precision>; all others are strings.  The site's
    own field stands first, after a credible Solar Hijri date; then the model,
    unless it repeats the capture or comes after it; then the text; the day of
    the capture is an upper bound and marked as such.
    """
    given = F.struct(strip(nz(selector)).alias("s"), strip(nz(capture)).alias("c"), strip(nz(model)).alias("m"), (F.lower(strip(nz(model_agrees))) == "no").alias("no"), hijri.alias("h"), head.alias("t"))
    return let(given, lambda x: adjudicated(x["s"], x["c"], x["m"], x["no"], x["h"], x["t"], flag_years, text_first))


def adjudicated(selector: Column, capture: Column, model: Column, no: Column, hijri: Column, head: Column, flag_years: int, text_first: bool) -> Column:
    has_hijri = hijri["date"].isNotNull()
    text = F.coalesce(hijri["date"], head, F.lit(""))
    how = F.when(has_hijri, hijri["precision"]).when(head.isNotNull(), F.lit("regex_text"))
    cap, sel, cand, mod = year_of(capture), year_of(selector), year_of(text), year_of(model)
    bounded = lambda y: y.isNotNull() & (cap.isNull() | (y <= cap))
    credible = F.coalesce((text != "") & bounded(cand) & (~has_hijri | cap.isNull() | (F.abs(cand - cap) <= flag_years)), F.lit(False))
    model_fits = F.coalesce((model != "") & bounded(mod), F.lit(False))
    model_counts = model_fits & (model != capture)
    doubt = no | ((text != "") & ~credible) | ((model != "") & ~model_fits) | F.coalesce(F.abs(mod - sel) > flag_years, F.lit(False))
    top = F.struct
    pick = lambda d, p, late=False: top(d.alias("date"), p.alias("precision"), F.lit(late).alias("is_fallback"))
    choice = F.when(has_hijri & credible & ~no, pick(hijri["date"], hijri["precision"]))
    if not text_first:
        choice = choice.when(selector != "", pick(selector, F.lit("scraped")))
    choice = (
        choice.when(model_counts, pick(model, F.lit("model"))).when(credible, pick(text, how))
        .when(selector != "", pick(selector, F.lit("scraped"))).when(capture != "", pick(capture, F.lit("wayback_capture"), True))
        .otherwise(pick(F.lit(""), F.lit(None).cast("string")))
    )
    return F.struct(
        choice["date"].alias("date"), choice["precision"].alias("precision"), F.when(model != "", model).alias("model_date"),
        doubt.alias("disagreement"), F.when(text != "", text).alias("parsed"), head.alias("regex"), choice["is_fallback"].alias("is_fallback"),
    )


def upload_date(c: Column) -> Column:
    """``YYYYMMDD`` as ISO; other dates that read as ISO stay."""
    s = strip(nz(c))
    return F.when(s.rlike(r"^\d{8}$"), F.date_format(F.try_to_date(s, "yyyyMMdd"), "yyyy-MM-dd")).when(s.rlike(r"^\d{4}-\d{2}-\d{2}"), F.date_format(F.try_to_date(F.substring(s, 1, 10)), "yyyy-MM-dd"))


def plausible(c: Column) -> Column:
    """The date of an ISO string whose year is believable, else null."""
    d = F.when(nz(c).rlike(r"^\d{4}-\d{2}-\d{2}$"), F.try_to_date(c))
    return F.when(F.year(d).between(F.lit(1900), F.year(F.current_date()) + 1), d)


