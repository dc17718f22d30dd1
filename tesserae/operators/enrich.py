"""Stages that call models: extraction, classification, translation and transcription.

A model is any callable that a task can import; without one a stage runs a
stub, so that plans and checks need no network.  Rows that need no call are
split off before the Python stage.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tesserae.functions.text import blank, nz, strip, truncated

# The fields of a model's reply, of the reply about a date, and where texts are best cut.
REPLY_FIELDS = [
    "document_type", "is_first_person", "is_substantive", "speaker", "speaker_attributed_correct", "speaker_type", "position", "date", "date_matches_metadata", "language",
    "audience", "speech_type", "venue", "confidence", "reasoning",
]
DATE_FIELDS = ["date", "date_confidence", "date_basis"]
CLAUSE_ENDS = ["?", "!", ";", ","]


def prompt(text: Column, words: int = 500, **labels: Column) -> Column:
    """Labelled lines, then the text cut to ``words``."""
    lines = [F.concat(F.lit(f"{n}: "), F.when(blank(c), "not available").otherwise(nz(c))) for n, c in labels.items()]
    return F.concat_ws("\n", *lines, F.lit("text:"), truncated(text, words))


def reply(raw: Column, fields: Sequence[str] = REPLY_FIELDS) -> Column:
    """A struct of strings from a model's JSON; what can't be read is null, and so is what's blank."""
    got = F.from_json(raw, "map<string,string>")
    value = lambda n: strip(F.try_element_at(got, F.lit(n)))
    return F.struct(*[F.when(value(n) != "", value(n)).alias(n) for n in fields])


def empty_reply(r: Column, fields: Sequence[str] = REPLY_FIELDS) -> Column:
    return F.coalesce(*[r[n] for n in fields]).isNull()


def called(rows: DataFrame, model: Callable[[str], str], column: str = "prompt", out: str = "reply") -> DataFrame:
    """``rows`` with the model's answer and an error text; a failed call spoils its own row only."""

    @F.pandas_udf(f"{out} string, error string")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            got = []
            for x in batch:
                try:
                    got.append((model(x), None))
                except Exception as e:  # noqa: BLE001  a model's failure is a value here
                    got.append((None, f"{type(e).__name__}: {e}"))
            yield pd.DataFrame(got, columns=[out, "error"])

    return rows.withColumn("_m", run(column)).select(*rows.columns, f"_m.{out}", "_m.error")


def chunks(text: Column, most: int) -> Column:
    """Pieces of ``most`` characters or fewer, in order and without a gap.

    One pattern, matched over and over, whose alternatives are the choices by
    rank: what is left if it fits; the longest piece that ends with a sentence;
    with a clause, by kind; with a line; with a word; as much as fits.  A sign
    counts as an end if the blank after it lies within the limit too.
    """
    head = lambda n: f".{{0,{n}}}"
    choices = [f".{{1,{most}}}\\z", f".{{{most - 1}}}。"]
    if most > 1:
        choices.append(rf".{{1,{most - 1}}}(?:(?<=。)|(?<=\.)(?=[ \n]))")
        choices += [rf"{head(most - 2)}\{mark}(?= )" for mark in CLAUSE_ENDS]
    choices += [rf"{head(most - 1)}\n", f"{head(most - 1)} ", f".{{1,{most}}}"]
    return F.regexp_extract_all(nz(text), F.lit(f"(?s){'|'.join(choices)}"), 0)


def packed(sentences: Sequence[str], sizes: Sequence[int], budget: int) -> list[list[str]]:
    """Sentences in order, as many to a group as the budget of tokens holds; one over it stands alone."""
    out, used = [], budget + 1
    for s, n in zip(sentences, sizes, strict=True):
        if used + n > budget:
            out.append([])
            used = 0
        out[-1].append(s)
        used += n
    return out


def translated(rows: DataFrame, fields: Sequence[str], translate: Callable[[str, str], str], most: int = 4500, lang: str = "lang") -> DataFrame:
    """Fill each field from its ``_originlanguage`` twin where it is blank."""
    for f in fields:
        origin = f"{f}_originlanguage"

        @F.pandas_udf("string")
        def run(parts: pd.Series, code: pd.Series) -> pd.Series:
            return pd.Series(["".join(translate(c, k) for c in some) for some, k in zip(parts, code, strict=True)], dtype=object)

        need = ~blank(F.col(origin)) & blank(F.col(f))
        done = rows.where(need).withColumn(f, run(chunks(F.col(origin), most), lang))
        rows = done.unionByName(rows.where(~need | need.isNull()))
    return rows


def transcribed(media: DataFrame, transcribe: Callable[[str], tuple[str, str]]) -> DataFrame:
    """``media`` (path, …) with text and language."""

    @F.pandas_udf("text string, language string")
    def run(paths: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([transcribe(p) for p in paths], columns=["text", "language"])

    return media.withColumn("_t", run("path")).select(*media.columns, "_t.text", "_t.language")
