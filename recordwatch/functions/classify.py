"""Classifications as chains of conditions: levels, quality, step outcomes, health, fetch errors."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from recordwatch.functions.text import clean_text

QUALITY = ("unknown", "low", "medium", "high")
SEVERITY = ("info", "warning", "high", "critical")


def one_of(value: Column, **groups: tuple[str, ...]) -> Column:
    """The name of the group that holds ``value``; null if none does."""
    out = F.lit(None).cast("string")
    for name, members in groups.items():
        out = F.when(value.isin(*members), F.lit(name)).otherwise(out)
    return out


def rank(value: Column, order: tuple[str, ...]) -> Column:
    """Place of ``value`` in ``order``; 0 for what isn't there."""
    known = F.array(*[F.lit(o) for o in order])
    return F.greatest(F.coalesce(F.array_position(known, F.lower(value)).cast("int") - 1, F.lit(0)), F.lit(0))


def label(place: Column, order: tuple[str, ...]) -> Column:
    return F.element_at(F.array(*[F.lit(o) for o in order]), (place + 1).cast("int"))


def level_confidence(level: Column) -> Column:
    return F.when(level == "item_level", 0.82).when(level == "link_level", 0.62).otherwise(0.35)


def level_quality(level: Column) -> Column:
    return F.when(level == "item_level", "high").when(level == "link_level", "medium").otherwise("low")


def step_outcome(status: Column) -> Column:
    """Spellings of a step's result, as one of six words."""
    text = F.lower(F.trim(F.coalesce(status.cast("string"), F.lit(""))))
    found = one_of(
        text,
        success=("success", "passed", "healthy"),
        failure=("failure", "failed", "error", "unhealthy"),
        cancelled=("cancelled", "canceled"),
        skipped=("skipped", "disabled", "not_applicable"),
        pending=("pending", "pending_at_render_time"),
    )
    return F.coalesce(found, F.lit("unknown"))


def component_health(outcome: Column, critical: Column) -> Column:
    """Health of a step with that outcome; what fails is worse if it is critical."""
    return (
        F.when(outcome == "success", "healthy")
        .when(outcome.isin("failure", "cancelled"), F.when(critical, "unhealthy").otherwise("degraded"))
        .when(outcome == "skipped", "not_applicable")
        .when(outcome == "pending", "pending")
        .otherwise("unknown")
    )


def parser_quality(traced: Column, evidences: Column, has_date: Column, evidence_length: Column, warnings: Column) -> tuple[Column, Column]:
    """(quality, confidence) of a record: whether it can be traced, and how many of its fields say where they come from."""
    high = has_date & (evidence_length >= 80) & (evidences >= 3) & (warnings == 0)
    middle = F.least(F.lit(0.84), F.lit(0.65) + F.least(evidences, F.lit(3)) * 0.05 + F.when(has_date, 0.04).otherwise(0.0))
    return (
        F.when(~traced, "low").when(high, "high").otherwise("medium"),
        F.when(~traced, 0.35).when(high, 0.9).otherwise(F.round(middle, 2)),
    )


# Origins of candidates that come with structured data.
STRUCTURED_ORIGINS = ("json_ld", "next_data")


def candidate_level(origin: Column, generic_path: Column, title: Column, evidence: Column) -> Column:
    """item_level for what structured data describes well enough; a generic path or a lack of evidence makes it link_level."""
    full = origin.isin(*STRUCTURED_ORIGINS) & ~generic_path & (F.length(title) > 0) & (F.length(evidence) >= 60)
    return F.when(F.coalesce(full, F.lit(False)), "item_level").otherwise("link_level")


# What can be wrong with a page, in the order in which it is found out; the second tuple can't be mended by rendering, the third can.
FETCH_ERRORS = ("invalid_candidate_url", "request_timeout", "request_error", "redirect_to_index_page", "redirect_outside_allowed_domain", "http_4xx", "http_5xx", "invalid_content_type", "response_too_large", "empty_response")
NOT_RENDERABLE = ("invalid_candidate_url", "redirect_outside_allowed_domain", "redirect_to_index_page", "http_4xx", "invalid_content_type", "response_too_large")
RENDERABLE = ("empty_response", "javascript_shell", "missing_title", "missing_evidence", "missing_required_fields")


def fetch_error(valid: Column, failure: Column, landed: Column, status: Column, content_type: Column, size: Column, blank: Column, cap: int = 2_000_000) -> Column:
    """The first of ``FETCH_ERRORS`` that holds, null if none does.

    ``valid``: the address may be a candidate; ``failure``: timeout, other or null; ``landed``: inside, index or
    outside, by where redirects ended; ``blank``: the page has no text at all.
    """
    kind = F.lower(F.coalesce(content_type, F.lit("")))
    holds = (
        ~valid, failure == "timeout", failure.isNotNull(), landed == "index", landed == "outside", (status >= 400) & (status < 500), status >= 500,
        ~F.contains(kind, F.lit("html")), size > cap, blank,
    )
    return F.coalesce(*[F.when(on, F.lit(name)) for name, on in zip(FETCH_ERRORS, holds)])


def render_decision(mode: Column, error: Column, has_static: Column) -> Column:
    """Whether a page is to be rendered: never or always, if the mode says so, but not what rendering can't mend; else where reading it as it is failed for want of scripts."""
    hopeless, curable = F.coalesce(error.isin(*NOT_RENDERABLE), F.lit(False)), F.coalesce(error.isin(*RENDERABLE), F.lit(False))
    return (mode != "never") & ~hopeless & ((mode == "always") | (~has_static & curable))


def warning_category(text: Column) -> Column:
    """Class of a parser's warning; a conflict of fields keeps its own name."""
    low = F.lower(F.coalesce(text, F.lit("")))
    # What the texts of warnings about dates hold.
    dated = F.contains(low, F.lit("date")) | F.contains(low, F.lit("日期")) | F.contains(low, F.lit("时间"))
    return F.when(dated, "unparsed_date").when(low.startswith("field_conflict:"), low).otherwise("parser_warning")


def warning_categories(texts: Column, most: int = 10) -> Column:
    """The first different categories of a list of warnings."""
    return F.slice(F.array_distinct(F.transform(texts, warning_category)), 1, most)


def method_rank(method: Column) -> Column:
    """How far a way of extraction is to be trusted, 1 to 5."""
    low = F.lower(F.trim(F.coalesce(method, F.lit(""))))
    # Parts of the names of methods, best first.
    ranks = {5: ("json_ld", "json-ld", "datepublished"), 4: ("h1", "time", "article"), 3: ("main",), 2: ("meta",)}
    return F.coalesce(*[F.when(low.rlike("|".join(parts)), F.lit(n)) for n, parts in ranks.items()], F.lit(1))


def relevance(title: Column, blocks: Column, word: str, incidental: tuple[str, ...], direct: str) -> Column:
    """Whether a text is about ``word``: direct, incidental, not_direct or unknown.

    Its title decides; then whether every block that mentions the word does so in passing (one of the phrases ``incidental``),
    whether title and first three blocks fit the pattern ``direct``, and whether anything is in passing at all.
    """
    low, name = F.transform(blocks, F.lower), F.lower(F.trim(F.regexp_replace(F.coalesce(title, F.lit("")), r"\s+", " ")))
    passing = lambda text: F.lit(False) if not incidental else F.greatest(*[F.contains(text, F.lit(p)) for p in incidental], F.lit(False))
    mentions = F.filter(low, lambda b: F.contains(b, F.lit(word)))
    whole, start = F.array_join(low, " "), F.concat(name, F.lit(" "), F.array_join(F.slice(low, 1, 3), " "))
    return (
        F.when(name.rlike(rf"\b{word}\b"), "direct")
        .when((F.size(mentions) > 0) & F.forall(mentions, passing), "incidental")
        .when(start.rlike(direct), "direct")
        .when(F.contains(whole, F.lit(word)) & passing(whole), "incidental")
        .when((F.coalesce(title, F.lit("")) != "") & (F.size(blocks) > 0) & ~F.contains(start, F.lit(word)), "not_direct")
        .otherwise("unknown")
    )


def first_sentence(blocks: Column, phrase: str, excluded: tuple[str, ...] = ()) -> Column:
    """The first sentence of any block that holds ``phrase`` and none of ``excluded``, up to 600 characters; empty if there is none."""
    sentences = F.flatten(F.transform(blocks, lambda b: F.split(b, r"(?<=[.!?])\s+")))

    def fits(sentence: Column) -> Column:
        low = F.lower(sentence)
        out = F.contains(low, F.lit(phrase))
        for text in excluded:
            out = out & ~F.contains(low, F.lit(text))
        return out

    return F.coalesce(clean_text(F.get(F.filter(sentences, fits), F.lit(0)), 600), F.lit(""))


def step_status(blocks: Column, ahead: str, done: str, not_done: tuple[str, ...]) -> tuple[Column, Column]:
    """(status, sentence): targeting if a sentence holds ``ahead``, else completed if one holds ``done``, else unknown."""
    first, second = first_sentence(blocks, ahead), first_sentence(blocks, done, not_done)
    return F.when(first != "", "targeting").when(second != "", "completed").otherwise("unknown"), F.when(first != "", first).otherwise(second)


def counted(blocks: Column, of: str, when: Column) -> Column:
    """The number of up to three digits before the words ``of``, where ``when`` holds; else null."""
    found = F.regexp_extract(F.array_join(blocks, " "), rf"(?i)\b(\d{{1,3}})\s+{of}\b", 1)
    return F.when(when & (found != ""), found.cast("int"))


def safe_positive(value: Column, default: int) -> tuple[Column, Column]:
    """(number, warned): a whole number from 1, else the default; warned where something was given that isn't used as it is."""
    text = F.trim(F.coalesce(value.cast("string"), F.lit("")))
    number = F.when(text.rlike(r"^[+-]?\d+$"), text.try_cast("bigint"))
    used = F.when(number >= 1, number).otherwise(F.lit(default).cast("bigint"))
    return used, (text != "") & (used == default) & (text != str(default))


def safe_ratio(value: Column, default: float) -> tuple[Column, Column]:
    """(number, warned): a number above 0 up to 1, else the default."""
    text = F.trim(F.coalesce(value.cast("string"), F.lit("")))
    number = text.try_cast("double")
    used = F.when((number > 0) & (number <= 1), number).otherwise(F.lit(default))
    return used, (text != "") & ~number.eqNullSafe(used)


def source_tags(source: Column, of_source: dict[str, tuple[str, ...]], keywords: Column, extra: str) -> Column:
    """``official``, the tags of the source, and ``extra`` if it is among the keywords and not yet a tag."""
    base = F.array(F.lit("official"))
    for name, tags in of_source.items():
        base = F.when(source == name, F.array(*[F.lit(t) for t in ("official", *tags)])).otherwise(base)
    return F.when(F.array_contains(keywords, extra), F.array_distinct(F.concat(base, F.array(F.lit(extra))))).otherwise(base)


def tokens_used(prompt: Column, completion: Column, total: Column) -> Column:
    """Total of a usage record, from its parts where it isn't given."""
    return F.coalesce(total.cast("long"), prompt.cast("long") + completion.cast("long"))


def valid_email(text: Column) -> Column:
    return F.coalesce(text, F.lit("")).rlike(r"^[^@\s]+@[^@\s]+\.[^@\s]+$")


def valid_port(text: Column) -> Column:
    n = text.try_cast("int")
    return F.coalesce((n >= 1) & (n <= 65_535), F.lit(False))
