"""Which documents count: acceptance, review, tiers, corrections, positions and approvals."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from tesserae.functions.text import blank, nz, strip

KEPT_TYPES = ("speech", "interview", "official_statement")
LEADERS, OTHERS = ("head_of_state", "head_of_government", "both"), ("other_minister", "other")

# Patterns of positions, in order; what excludes goes first.
EXCLUDED = [
    r"\bminister\s+of\b", r"\bminister\s+for\b", r"\bdeputy\s+(prime\s+)?minister\b", r"\bforeign\s+minister\b", r"\bdefen[cs]e\s+minister\b",
    r"\bfinance\s+minister\b", r"\binterior\s+minister\b", r"\bambassador\b", r"\bsecretary[\s-]general\b", r"\bdirector\b", r"\bcommissioner\b",
    r"\bgovernor[\s-]*general\b", r"\bgovernor\b", r"\bmayor\b", r"\bsenator\b", r"\bmember\s+of\s+parliament\b", r"\b(mp|m\.p\.)\b",
    r"\bgeneral\b(?!.*\b(secretary|assembly)\b)", r"\bcolonel\b", r"\badmiral\b", r"\bmarshal\b", r"\bchief\s+of\s+(staff|defense|defence)\b",
    r"\battorney\s+general\b", r"\bchief\s+justice\b", r"\bjudge\b", r"\bspeaker\b", r"\bchairman\b(?!.*\bstate\b)", r"\bchairperson\b",
    r"\bchairwoman\b", r"\bsecretary\s+of\s+state\b", r"\bvice[\s-]president\b", r"\bdeputy\b", r"\benvoy\b", r"\bconsul\b", r"\bdiplomat\b",
    r"\brepresentative\b", r"\bdelegate\b", r"\bcoach\b", r"\bathlete\b", r"\bchief\s+executive\b(?!.*\bgovernment\b)", r"\bcounsel\s+to\b",
    r"\bmunicipal\s+president\b", r"\bcop\d+\s+president\b",
    r"\bpresident\s+of\s+(the\s+)?(european|commission|council|assembly|senate|parliament|committee|court|corporation|company|bank|university|federation|foundation|association|olympic)",
    r"\bqueen\s+consort\b", r"\bprincess\b", r"\blady\b", r"\bduchess\b", r"\bcountess\b", r"\bprince\b(?!\s*(regent|crown|regnant))",
]
INCLUDED = [
    r"\bprime\s+minister\b", r"\bpresident\b", r"\bchancellor\b(?!.*\b(exchequer)\b)", r"\bsupreme\s+leader\b", r"\bemir\b", r"\bsultan\b",
    r"^king$", r"^king\b", r"\bking\s+of\b", r"\bcrown\s+prince\b", r"\bruler\b",
]


def norm(c: Column) -> Column:
    return F.lower(strip(nz(c)))


def decide(doc_type: Column, speaker: Column, speaker_type: Column, tenure: Column, keep: Sequence[str] = KEPT_TYPES, leaders_only: bool = True) -> Column:
    """struct<clean_status, gate_reason>; a speaker whom the tenure table places exactly is a leader whatever the type says."""
    kind, who = norm(doc_type), norm(speaker_type)
    verdict = lambda s, r: F.struct(F.lit(s).alias("clean_status"), r.alias("gate_reason"))
    label = F.when(kind == "", "unknown").otherwise(kind)
    out = F.when(~kind.isin([k.lower() for k in keep]), verdict("rejected_not_representative", F.concat(F.lit("document_type="), label, F.lit(" does not represent the leader"))))
    out = out.when(blank(speaker), verdict("rejected_no_speaker", F.lit("no speaker could be identified")))
    if leaders_only:
        doubted = norm(tenure) != "exact"
        out = out.when(doubted & (who == "foreign_visitor"), verdict("rejected_foreign", F.lit("speaker is a foreign visitor, not this country's leader")))
        out = out.when(doubted & who.isin(*OTHERS), verdict("rejected_non_leader", F.concat(F.lit("speaker_type="), who, F.lit(" (not a head of state/government)"))))
    return out.otherwise(verdict("accepted", F.lit("")))


def needs_review(status: Column, tenure: Column, speaker_type: Column, first_person: Column, substantive: Column) -> Column:
    """Whether a row may show a leader whom the tenure table lacks."""
    own_words = (norm(first_person) == "yes") & (norm(substantive) == "yes")
    return status.isin("accepted", "rejected_non_leader", "rejected_foreign") & (norm(tenure) == "none") & (norm(speaker_type).isin(*LEADERS) | own_words)


def tier(doc_type: Column, first_person: Column, substantive: Column) -> Column:
    kind = norm(doc_type)
    return F.when(kind.isin(*KEPT_TYPES), F.when(norm(substantive) == "no", "4_courtesy").when(kind != "official_statement", "1_speech").when(norm(first_person) == "yes", "2_first_person_statement").otherwise("3_third_person_statement"))


def corrected(scraped: Column, model: Column, agrees: Column) -> Column:
    """The model's value where the scraped one is blank or the model says that it's wrong."""
    return F.when(~blank(model) & (blank(scraped) | (norm(agrees) == "no")), model).otherwise(scraped)


def from_entry(page: Column, carried: Column) -> Column:
    return F.when(blank(page), nz(carried)).otherwise(page)


def filled_names(**pairs: tuple[Column, Column]) -> Column:
    """The names of the fields that the carried values filled."""
    return F.array_compact(F.array(*[F.when(blank(page) & ~blank(carried), F.lit(n)) for n, (page, carried) in pairs.items()]))


def by_position(position: Column) -> Column:
    """struct<is_leader, role, method>; ``gpt`` leaves the case to the model."""
    pos = F.lower(strip(nz(position)))
    hit = lambda some: pos.rlike("|".join(f"(?:{p})" for p in some))
    answer = lambda x, how: F.struct(F.lit(x).cast("boolean").alias("is_leader"), (strip(nz(position)) if x is not None else F.lit(None).cast("string")).alias("role"), F.lit(how).alias("method"))
    return F.when(pos == "", answer(None, "gpt")).when(hit(EXCLUDED), answer(False, "auto_exclude")).when(hit(INCLUDED), answer(True, "auto_include")).otherwise(answer(None, "gpt"))


def approved(word: Column, model_says: Column, confidence: Column, enough: Sequence[str] = ("high", "medium")) -> Column:
    """A person's word, else the model's if it is sure enough."""
    said = norm(word)
    return F.when(said.isin("yes", "y", "true", "1"), True).when(said.isin("no", "n", "false", "0"), False).otherwise(F.coalesce(model_says, F.lit(False)) & norm(confidence).isin(*enough))
