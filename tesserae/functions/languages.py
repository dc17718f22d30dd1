"""Languages of documents."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tesserae.functions.text import nz, strip

# Languages by name.
ISO_BY_NAME = {
    "english": "en", "spanish": "es", "french": "fr", "portuguese": "pt", "german": "de", "italian": "it", "dutch": "nl", "russian": "ru",
    "ukrainian": "uk", "polish": "pl", "czech": "cs", "slovak": "sk", "romanian": "ro", "hungarian": "hu", "bulgarian": "bg", "croatian": "hr",
    "serbian": "sr", "slovenian": "sl", "greek": "el", "turkish": "tr", "arabic": "ar", "persian": "fa", "farsi": "fa", "hebrew": "he",
    "chinese": "zh", "japanese": "ja", "korean": "ko", "hindi": "hi", "urdu": "ur", "indonesian": "id", "malay": "ms", "vietnamese": "vi",
    "thai": "th", "swahili": "sw", "afrikaans": "af", "amharic": "am", "albanian": "sq", "armenian": "hy", "azerbaijani": "az", "belarusian": "be",
    "bosnian": "bs", "catalan": "ca", "danish": "da", "estonian": "et", "finnish": "fi", "georgian": "ka", "icelandic": "is", "irish": "ga",
    "kazakh": "kk", "latvian": "lv", "lithuanian": "lt", "macedonian": "mk", "norwegian": "no", "swedish": "sv",
}


# The codes of a translation model by ISO code.
TRANSLATOR_CODES = {
    "af": "afr_Latn", "am": "amh_Ethi", "ar": "arb_Arab", "az": "azj_Latn", "be": "bel_Cyrl", "bg": "bul_Cyrl", "bs": "bos_Latn", "ca": "cat_Latn", "cs": "ces_Latn",
    "da": "dan_Latn", "de": "deu_Latn", "el": "ell_Grek", "en": "eng_Latn", "es": "spa_Latn", "et": "est_Latn", "fa": "pes_Arab", "fi": "fin_Latn", "fr": "fra_Latn",
    "ga": "gle_Latn", "he": "heb_Hebr", "hi": "hin_Deva", "hr": "hrv_Latn", "hu": "hun_Latn", "hy": "hye_Armn", "id": "ind_Latn", "is": "isl_Latn", "it": "ita_Latn",
    "ja": "jpn_Jpan", "ka": "kat_Geor", "kk": "kaz_Cyrl", "ko": "kor_Hang", "lt": "lit_Latn", "lv": "lvs_Latn", "mk": "mkd_Cyrl", "ms": "zsm_Latn", "nl": "nld_Latn",
    "no": "nob_Latn", "pl": "pol_Latn", "ps": "pbt_Arab", "pt": "por_Latn", "ro": "ron_Latn", "ru": "rus_Cyrl", "sk": "slk_Latn", "sl": "slv_Latn", "sq": "als_Latn",
    "sr": "srp_Cyrl", "sv": "swe_Latn", "sw": "swh_Latn", "th": "tha_Thai", "tr": "tur_Latn", "uk": "ukr_Cyrl", "ur": "urd_Arab", "vi": "vie_Latn", "zh": "zho_Hans",
}


def translator_code(iso: Column) -> Column:
    """The translation model's code of an ISO code, null if it has none."""
    return F.element_at(F.create_map(*[F.lit(x) for pair in TRANSLATOR_CODES.items() for x in pair]), iso)


def date_hint(detected: Column, name: Column) -> Column:
    """The language whose month names a document's dates may have; null on any doubt, as a wrong one is worse than none."""
    code = source_language(detected, name)
    return F.when(code.rlike(r"^\p{L}{2}$"), F.lower(code))


def source_language(detected: Column, name: Column) -> Column:
    """ISO code: the detected one, else that of the name, else a name that is a code; null if unknown."""
    d, n = F.lower(strip(nz(detected))), F.lower(strip(nz(name)))
    known = F.element_at(F.create_map(*[F.lit(x) for pair in ISO_BY_NAME.items() for x in pair]), n)
    return F.when(d.rlike(r"^\p{L}+$") & ~d.isin("nan", "none"), F.substring(d, 1, 2)).otherwise(F.coalesce(known, F.when(n.rlike(r"^\p{L}{2}$"), n)))


def is_english(c: Column) -> Column:
    n = F.lower(strip(nz(c)))
    return n.startswith("english") | (n == "en")


def needs_translation(original: Column, target: Column, force: bool = False) -> Column:
    return (strip(nz(original)) != "") & (F.lit(force) | (strip(nz(target)) == ""))
