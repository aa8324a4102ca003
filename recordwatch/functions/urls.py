"""URL functions as regular expressions and array functions; no Python per row."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Query parameters that only track where a visitor came from.
TRACKING = ("utm_source", "utm_medium", "utm_campaign", "utm_term", "utm_content", "fbclid", "gclid")
# Ends of paths that are no pages.
MEDIA_SUFFIXES = ("avif", "css", "gif", "ico", "jpeg", "jpg", "js", "json", "m3u8", "mov", "mp3", "mp4", "pdf", "png", "svg", "webm", "webp")
MEDIA = rf"(?i)\.({'|'.join(MEDIA_SUFFIXES)})$"

_PARTS = r"^([A-Za-z][A-Za-z0-9+.\-]*)://([^/?#]*)([^?#]*)(?:\?([^#]*))?(?:#.*)?$"


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, which is worked out once however often the body refers to it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def scheme(url: Column) -> Column:
    return F.lower(F.regexp_extract(url, _PARTS, 1))


def authority(url: Column) -> Column:
    return F.regexp_extract(url, _PARTS, 2)


def path(url: Column) -> Column:
    return F.regexp_extract(url, _PARTS, 3)


def query(url: Column) -> Column:
    return F.regexp_extract(url, _PARTS, 4)


def host(url: Column) -> Column:
    """Host in lower case, without user and port."""
    return F.lower(F.regexp_replace(F.regexp_replace(authority(url), r"^.*@", ""), r":\d*$", ""))


def host_root(name: Column) -> Column:
    """Host without port and without a leading www."""
    return F.regexp_replace(F.regexp_replace(F.lower(name), r":\d+$", ""), r"^www\.", "")


def _decoded(text: Column) -> Column:
    """Percent escapes and plus signs read; a percent sign that is no escape stays."""
    return F.url_decode(F.regexp_replace(text, r"%(?![0-9A-Fa-f]{2})", "%25"))


def _encoded(text: Column) -> Column:
    return F.replace(F.replace(F.url_encode(text), F.lit("*"), F.lit("%2A")), F.lit("%7E"), F.lit("~"))


def _site(whole: Column) -> Column:
    """An authority with user name and password as they are, host in lower case, port as a number; null for what can't be one."""
    user = F.regexp_extract(whole, r"^(.*)@", 1)
    name, password = F.substring_index(user, ":", 1), F.regexp_extract(user, r":(.*)$", 1)
    place = F.lower(F.regexp_replace(whole, r"^.*@", ""))
    port = F.regexp_extract(place, r":([^:\]]*)$", 1)
    number = F.when(port.rlike(r"^\d{1,5}$"), port.cast("int"))
    bare = F.regexp_replace(place, r":[^:\]]*$", "")
    told = F.when(name == "", F.lit("")).otherwise(F.concat(name, F.when(password == "", "").otherwise(F.concat(F.lit(":"), password)), F.lit("@")))
    wrong = (bare == "") | ((port != "") & (number.isNull() | (number > 65_535)))
    return F.when(~wrong, F.concat(told, bare, F.when(number.isNull(), "").otherwise(F.concat(F.lit(":"), number.cast("string")))))


def normalized_query(text: Column) -> Column:
    """A query's parameters without those that only track, sorted by key and then value, encoded anew; blank values stay."""
    pairs = F.transform(
        F.filter(F.split(text, "&"), lambda p: p != ""),
        lambda p: F.struct(_decoded(F.substring_index(p, "=", 1)).alias("k"), _decoded(F.when(F.contains(p, F.lit("=")), F.regexp_extract(p, r"(?s)^[^=]*=(.*)$", 1)).otherwise("")).alias("v")),
    )
    kept = F.array_sort(F.filter(pairs, lambda p: ~F.lower(p["k"]).isin(*TRACKING)))
    return F.array_join(F.transform(kept, lambda p: F.concat(_encoded(p["k"]), F.lit("="), _encoded(p["v"]))), "&")


def normalize(url: Column) -> Column:
    """One spelling per address: scheme and host in lower case, no end slash but the root's, no fragment or tracking; sorted query.

    What isn't an absolute address with a host is returned trimmed.
    """


    def spelled(raw: Column) -> Column:
        place = _let(path(raw), lambda p: F.when(p == "/", p).otherwise(F.regexp_replace(p, r"/+$", "")))
        asked = _let(normalized_query(query(raw)), lambda q: F.when(q == "", q).otherwise(F.concat(F.lit("?"), q)))
        # Null where there is no host; without a scheme nothing else is found either.
        return F.coalesce(F.concat(scheme(raw), F.lit("://"), _let(authority(raw), _site), place, asked), raw)

    return _let(F.trim(F.coalesce(url, F.lit(""))), spelled)


def resolve(url: Column, base: str) -> Column:
    """Absolute address of a reference found on the page ``base``; what has a scheme of its own stays."""
    root = re.match(r"^([a-z][a-z0-9+.\-]*):(//[^/?#]*)([^?#]*)", base, re.I)
    if root is None:
        raise ValueError(f"no absolute address: {base}")
    site, here = f"{root[1]}:{root[2]}", root[3] or "/"
    none = F.array().cast("array<string>")

    def step(done: Column, part: Column) -> Column:
        up = F.slice(done, F.lit(1), F.greatest(F.size(done) - 1, F.lit(0)))
        return F.when(part == "..", up).when(part == ".", done).otherwise(F.concat(done, F.array(part)))

    def placed(at: Column) -> Column:
        steps = F.aggregate(F.slice(F.split(at, "/"), 2, 1_000_000), none, step)
        return F.concat(F.lit(site + "/"), F.array_join(steps, "/"), F.when(at.rlike(r"(^|/)\.{1,2}$"), "/").otherwise(""))

    def absolute(ref: Column) -> Column:
        bare = F.regexp_extract(ref, r"^([^?#]*)", 1)
        at = F.when(bare == "", F.lit(here)).when(bare.startswith("/"), bare).otherwise(F.concat(F.lit(here.rsplit("/", 1)[0] + "/"), bare))
        own, same_scheme = ref.rlike(r"^[A-Za-z][A-Za-z0-9+.\-]*:"), ref.startswith("//")
        return F.when(own, ref).when(same_scheme, F.concat(F.lit(root[1] + ":"), ref)).otherwise(F.concat(_let(at, placed), F.regexp_extract(ref, r"^[^?#]*(.*)$", 1)))

    return _let(url, absolute)


def candidate_url(url: Column, base: str, root: str, prefix: str, canonical_host: str) -> Column:
    """The one address of a candidate found on ``base``, null for what isn't one.

    It must be on the host ``root`` (with or without www) and below ``prefix``, and be neither the prefix itself nor a media file.
    """

    def told(whole: Column) -> Column:
        place = F.lower(F.regexp_replace(path(whole), r"/+$", ""))
        fits = scheme(whole).isin("http", "https") & (host_root(host(whole)) == root) & place.startswith(prefix) & (place != prefix.rstrip("/")) & ~place.rlike(MEDIA)
        return F.when(fits, F.regexp_replace(whole, r"^([^:]+)://[^/?#]*", f"$1://{canonical_host}"))

    raw = F.trim(F.regexp_replace(F.coalesce(url, F.lit("")), r"\s+", " "))
    given = _let(raw, lambda r: F.when((r != "") & ~r.rlike("^(mailto|tel|javascript|data):"), r))
    return _let(normalize(resolve(given, base)), told)


def strip_query(url: Column, base: str | None = None) -> Column:
    """Absolute address without query, fragment and end slash; ``/x`` is resolved against ``base``."""
    raw = F.trim(F.coalesce(url, F.lit("")))
    if base:
        root = F.regexp_extract(F.lit(base), r"^([a-z]+://[^/]+)", 1)
        raw = F.when(raw.startswith("/"), F.concat(root, raw)).otherwise(raw)
    bare = F.regexp_replace(path(raw), r"/+$", "")
    return F.when(scheme(raw) == "", F.lit(None).cast("string")).otherwise(F.concat(scheme(raw), F.lit("://"), F.lower(authority(raw)), bare))


def allowed(url: Column, roots: list[str], prefixes: list[str], index_paths: list[str]) -> Column:
    """Whether a candidate belongs to a watched site: its host, below a prefix, no media file, not the index itself."""
    place = F.regexp_replace(path(url), r"/+$", "")
    below = F.lit(False)
    for p in prefixes:
        below = below | place.startswith(p)
    return scheme(url).isin("http", "https") & host_root(host(url)).isin(*roots) & below & ~place.rlike(MEDIA) & ~place.isin(*index_paths)


def under_host(url: Column, suffix: str) -> Column:
    return (host_root(host(url)) == suffix) | host(url).endswith("." + suffix)


def excluded(url: Column, parts: list[str]) -> Column:
    """Whether a step of the path is one of ``parts``."""
    return F.arrays_overlap(F.split(F.lower(path(url)), "/"), F.array(*[F.lit(p) for p in parts]))
