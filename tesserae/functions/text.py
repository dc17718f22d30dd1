"""Text expressions over string columns.  ``''`` and null both mean missing."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Line ends as a text's lines are counted.
LINE_END = r"\r\n|[\n\r\x0B\f\x1C-\x1E\x85  ]"


def nz(c: Column) -> Column:
    return F.coalesce(c, F.lit(""))


def strip(c: Column) -> Column:
    """Without white space of any kind at either end."""
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")


def blank(c: Column) -> Column:
    return strip(nz(c)) == ""


def first_filled(*cs: Column) -> Column:
    """The first that isn't blank, else ``''``."""
    return F.coalesce(*[F.when(~blank(c), c) for c in cs], F.lit(""))


def tidy(c: Column) -> Column:
    """Lines with single blanks and no margins; empty lines go."""
    lines = F.split(F.replace(nz(c), F.lit("\r"), F.lit("\n")), "\n")
    return F.array_join(F.filter(F.transform(lines, lambda x: strip(F.regexp_replace(x, r"[ \t\f\x0B]+", " "))), lambda x: x != ""), "\n")


def normal_form(c: Column) -> Column:
    """Lower case with single blanks: what a text is compared by."""
    return F.regexp_replace(F.lower(strip(nz(c))), r"(?U)\s+", " ")


def text_key(c: Column) -> Column:
    return F.sha1(normal_form(c))


def words(c: Column) -> Column:
    return F.filter(F.split(nz(c), r"(?U)\s+"), lambda w: w != "")


def truncated(c: Column, n: int) -> Column:
    """At most ``n`` words; a longer text loses its spacing and gains a mark."""
    return F.when(F.size(words(c)) > n, F.concat(F.array_join(F.slice(words(c), 1, n), " "), F.lit(" [...]"))).otherwise(nz(c))


def filled_lines(c: Column) -> Column:
    return F.filter(F.transform(F.split(nz(c), LINE_END), strip), lambda x: x != "")


def head_lines(c: Column, n: int = 4) -> Column:
    return F.slice(filled_lines(c), 1, n)


def first_line(c: Column, limit: int = 200) -> Column:
    return F.substring(F.coalesce(F.get(filled_lines(c), F.lit(0)), F.lit("")), 1, limit)


def sentences(c: Column) -> Column:
    return F.filter(F.split(strip(nz(c)), r"(?U)(?<=[.!?。！？])\s+"), lambda x: ~blank(x))


def slug(c: Column, cap: int = 60) -> Column:
    dashed = F.regexp_replace(F.lower(nz(c)), "[^a-z0-9]+", "-")
    return F.regexp_replace(F.substring(F.regexp_replace(dashed, "^-+|-+$", ""), 1, cap), "-+$", "")


def clipped_cell(c: Column, limit: int = 120) -> Column:
    """Long cells shrink to their first sentence."""
    return F.when(F.length(c) > limit, F.substring(F.get(F.split(c, r"\.\s|\n", 2), F.lit(0)), 1, limit)).otherwise(c)


def id_prefix(c: Column) -> Column:
    return F.regexp_extract(nz(c), r"^(.*?)(\d*)$", 1)


def id_number(c: Column) -> Column:
    """The number that an id ends in, -1 if it ends in none."""
    return F.coalesce(F.regexp_extract(nz(c), r"(\d+)$", 1).try_cast("long"), F.lit(-1))


def document_id(iso3: Column, number: Column) -> Column:
    """At least four digits after the country's code."""
    n = number.cast("string")
    return F.concat(F.coalesce(iso3, F.lit("XXX")), F.lpad(n, F.greatest(F.lit(4), F.length(n)), F.lit("0")))


def truthy(c: Column) -> Column:
    return F.lower(strip(nz(c.cast("string")))).isin("1", "true", "t", "yes", "y")
