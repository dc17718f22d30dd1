"""Keys that say which URLs mean the same.  There are four, for four questions; they are never mixed.

``page_identity`` asks whether two URLs serve one document, ``link_key``
whether two lists hold one link, ``canonical`` whether two places differ in
more than their spelling, ``path`` where a page lies in its site.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from tesserae.functions.text import nz, strip

# Query parameters that never change which document is served.
NOISE_PARAMS = [
    "fbclid", "gclid", "msclkid", "yclid", "igshid", "mc_cid", "mc_eid",
    "ref", "referrer", "source", "_hsenc", "_hsmi", "env", "rid", "clckid",
    "comment", "replytocom", "openvideo", "openphoto", "opengallery",
    "amp", "output", "print", "sphrase_id",
]
NOISE_PREFIXES = ["utm_", "at_", "pk_", "piwik_", "tspd_", "__cf"]

AUTHORITY = r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//([^/?#]*)"


def host(url: Column) -> Column:
    """Lower case, without user, port and leading ``www.``."""
    name = F.regexp_replace(F.lower(F.regexp_extract(nz(url), AUTHORITY, 1)), r"^[^@]*@|:\d*$", "")
    return F.regexp_replace(name, r"^www\.", "")


def raw_path(url: Column) -> Column:
    return F.regexp_extract(nz(url), r"^(?:(?:[A-Za-z][A-Za-z0-9+.-]*:)?//[^/?#]*)?([^?#]*)", 1)


def query(url: Column) -> Column:
    return F.regexp_extract(nz(url), r"^[^?#]*\?([^#]*)", 1)


def path(url: Column) -> Column:
    return F.regexp_replace(raw_path(url), "/+$", "")


def canonical(url: Column) -> Column:
    """struct<host, path, url> without scheme, port, query and trailing slashes."""
    u = strip(nz(url))
    return F.struct(host(u).alias("host"), path(u).alias("path"), F.concat(host(u), path(u)).alias("url"))


def link_key(url: Column) -> Column:
    """Lower case without scheme, ``www.``, the first ``:80`` and doubled slashes; the query stays."""
    u = F.regexp_replace(F.regexp_replace(F.lower(strip(nz(url))), "^https?://", ""), r"^www\.", "")
    u = F.regexp_replace(u, "^(.*?):80/", "$1/")
    return F.regexp_replace(F.regexp_replace(u, "/{2,}", "/"), "/+$", "")


def decoded(c: Column) -> Column:
    """Percent escapes undone; a plus sign stays, and so does what isn't an escape."""
    kept = F.regexp_replace(F.regexp_replace(c, r"\+", "%2B"), "%(?![0-9A-Fa-f]{2})", "%25")
    return F.coalesce(F.try_url_decode(kept), c)


def form_encoded(c: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(F.url_encode(c), "%7E", "~"), r"\*", "%2A")


def page_identity(url: Column, extra_noise: Sequence[str] = ()) -> Column:
    """Host, path and those parameters, sorted, that say which document is served."""
    place = F.lower(F.regexp_replace(decoded(raw_path(url)), "/+$", ""))
    place = F.regexp_replace(place, r"/comment-page-\d+$", "")
    noise = [*NOISE_PARAMS, *(x.lower() for x in extra_noise)]

    def meaningful(p: Column) -> Column:
        name = F.lower(p["k"])
        quiet = name.isin(noise)
        for prefix in NOISE_PREFIXES:
            quiet |= name.startswith(prefix)
        return ~quiet

    def pair(part: Column) -> Column:
        plus = F.regexp_replace(part, r"\+", " ")
        return F.struct(decoded(F.regexp_extract(plus, "^([^=]*)", 1)).alias("k"), decoded(F.regexp_extract(plus, "^[^=]*=(.*)$", 1)).alias("v"))

    pairs = F.transform(F.filter(F.split(query(url), "&"), lambda x: x != ""), pair)
    kept = F.transform(F.array_sort(F.filter(pairs, meaningful)), lambda p: F.concat(form_encoded(p["k"]), F.lit("="), form_encoded(p["v"])))
    return F.concat(host(url), place, F.when(F.size(kept) > 0, F.concat(F.lit("?"), F.array_join(kept, "&"))).otherwise(""))


def url_match(url: Column, pattern: str, group: int) -> Column:
    """The pattern's group in the URL, null without a match."""
    p = pattern.replace("(?P<", "(?<")
    return F.when(nz(url).rlike(p), F.regexp_extract(nz(url), p, group))


def with_param(url: Column, name: str, value: Column) -> Column:
    """``url`` with a query parameter set, in its place if it is there and at the end if not."""
    there = rf"([?&]{name}=)[^&#]*"
    joint = F.when(F.instr(url, "?") > 0, F.lit("&")).otherwise(F.lit("?"))
    return F.when(url.rlike(there), F.regexp_replace(url, F.lit(there), F.concat(F.lit("$1"), value.cast("string")))).otherwise(F.concat(url, joint, F.lit(f"{name}="), value.cast("string")))


def archive_prefix(domain: Column) -> Column:
    return F.concat(F.regexp_replace(domain, "/+$", ""), F.lit("/*"))


def snapshot_url(timestamp: Column, original: Column, base: str = "https://web.archive.org/web") -> Column:
    return F.concat(F.lit(f"{base}/"), timestamp, F.lit("id_/"), original)
