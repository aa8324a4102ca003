"""HTML: one small event parser on the standard library, as Arrow UDFs and as a table function's rows.

Caps guard executors against hostile pages: so many levels and children of embedded JSON. Links and blocks have none.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from datetime import datetime, timezone
from html.parser import HTMLParser

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

#: Texts that are never shown, and parts around the content.
UNSEEN, SKIPPED = {"script", "style", "template"}, {"script", "style", "noscript", "svg"}
CHROME = {"nav", "footer", "form"}
BLOCKS = {"p", "h1", "h2", "h3", "time", "li"}
CONTAINERS = {"article", "section", "li"}
AREAS, HEADINGS = CONTAINERS | {"div"}, {"h1", "h2", "h3", "h4"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
DEPTH, CHILDREN, BLOCK_CHARS, LEAST_CHARS = 8, 200, 1200, 20
TITLE_CHARS, SUMMARY_CHARS, CONTEXT_CHARS, LEAST_EVIDENCE = 240, 500, 800, 80
# What pages show instead of their content, ids of the root elements of pages that scripts fill, and what asks for scripts.
CHALLENGES = ("attention required", "checking your browser", "enable javascript and cookies to continue", "verify you are human")
SHELL_ROOTS = {"root", "app", "__next"}
NOTICE = re.compile(r"javascript\s+(?:is\s+)?(?:required|disabled)|enable\s+javascript", re.I)
# Scripts that hold data, by type and by id, and the keys of addresses, titles and texts in them.
JSON_TYPES, JSON_IDS = {"application/ld+json", "application/json"}, {"__next_data__", "__nuxt_data__"}
URL_KEYS, TITLE_KEYS, TEXT_KEYS = ("url", "@id", "href", "path"), ("headline", "title", "name"), ("description", "summary", "abstract")
# Texts of links that say nothing of what they lead to.
EMPTY_TITLES = ("read more", "watch", "learn more")
MONTHS = "January|February|March|April|May|June|July|August|September|October|November|December"
DATE_IN_PROSE = re.compile(rf"\b(?:{MONTHS})\s+\d{{1,2}},\s+\d{{4}}\b", re.I)
#: What every date in prose ends in; found much faster, since it has few places to begin.
DATE_END = re.compile(r"\d,\s+\d{4}")


def _flat(parts: list[str], limit: int | None = None) -> str:
    text = " ".join(" ".join(parts).split())
    return text[:limit].rstrip() if limit else text


class Page(HTMLParser):
    """Everything that is read from a page, in one pass over it."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.stack: list[str] = []
        #: Depth of the first main and the first article while they are open; -1 once they are closed.
        self.first: dict[str, int | None] = {"main": None, "article": None}
        self.text: dict[str, list[str]] = {"shown": [], "visible": [], "main": [], "title": [], "h1": []}
        self.links: list[tuple[str, list[str], list[str] | None]] = []
        self.meta: dict[tuple[str, str], str] = {}
        self.time: str | None = None
        self.scripts: list[tuple[str, str, list[str]]] = []
        self.seen: set[str] = set()
        self.shell_root = False
        self._h1: int | None = None
        self._title: int | None = None
        self._blocks: list[tuple[list[str], bool, bool]] = []
        self._open: list[tuple[int, list[str]]] = []
        self._containers: list[tuple[int, list[str]]] = []
        self._link: list[tuple[int, list[str]]] = []
        #: Open areas, each with the text of its first heading once that has begun; the areas of the links; the open headings.
        self._areas: list[tuple[int, list[list[str]]]] = []
        self._link_areas: list[list[list[str]] | None] = []
        self._headings: list[tuple[int, list[str]]] = []
        #: What was worked out of the whole page, once it was read.
        self._told: dict[str, object] = {}

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        has = {k: v or "" for k, v in attrs}
        depth = len(self.stack)
        removed = bool((SKIPPED | CHROME) & set(self.stack)) or tag in SKIPPED | CHROME
        if has.get("id", "").lower() in SHELL_ROOTS:
            self.shell_root = True
        if tag in ("h1", "article", "main") and not removed:
            self.seen.add(tag)
        if tag == "meta":
            for kind in ("property", "name", "itemprop"):
                if kind in has:
                    self.meta.setdefault((kind, has[kind]), has.get("content", ""))
        if tag == "time" and "datetime" in has and self.time is None:
            self.time = has["datetime"]
        if tag == "script":
            self.scripts.append((has.get("type", "").strip().lower(), has.get("id", "").strip().lower(), []))
        if tag == "h1" and self._h1 is None:
            self._h1 = depth
        if tag == "title" and self._title is None:
            self._title = depth
        if tag in self.first and self.first[tag] is None and not removed:
            self.first[tag] = depth
        if tag in CONTAINERS:
            self._containers.append((depth, []))
        if tag in HEADINGS:
            heading: list[str] = []
            self._headings.append((depth, heading))
            for _, first in self._areas:
                if not first:
                    first.append(heading)
        if tag in AREAS:
            self._areas.append((depth, []))
        if tag == "a" and any(k == "href" for k, _ in attrs):
            self._link_areas.append(self._areas[-1][1] if self._areas else None)
            said: list[str] = []
            self.links.append((has["href"], said, self._containers[-1][1] if self._containers else None))
            self._link.append((depth, said))
        if tag in BLOCKS and not removed:
            block: list[str] = []
            self._blocks.append((block, self._within("main"), self._within("article")))
            self._open.append((depth, block))
        if tag not in VOID:
            self.stack.append(tag)

    def _within(self, root: str) -> bool:
        return (self.first[root] or 0) >= 0 and self.first[root] is not None and len(self.stack) > self.first[root]

    def handle_endtag(self, tag: str) -> None:
        if tag not in self.stack:
            return
        while self.stack.pop() != tag:
            pass
        depth = len(self.stack)
        for parts in (self._open, self._containers, self._link, self._areas, self._headings):
            while parts and parts[-1][0] >= depth:
                parts.pop()
        for root, at in self.first.items():
            if at is not None and at >= depth:
                self.first[root] = -1
        if self._h1 is not None and self._h1 >= depth:
            self._h1 = -1
        if self._title is not None and self._title >= depth:
            self._title = -1

    def handle_data(self, data: str) -> None:
        inside = set(self.stack)
        if "script" in inside and self.scripts:
            self.scripts[-1][2].append(data)
        if inside & UNSEEN:
            return
        self.text["shown"].append(data)
        if self._title is not None and self._title >= 0:
            self.text["title"].append(data)
        if self._h1 is not None and self._h1 >= 0:
            self.text["h1"].append(data)
        for _, parts in (*self._containers, *self._link, *self._headings):
            parts.append(data)
        if not inside & SKIPPED and self._within("main"):
            self.text["main"].append(data)
        if not inside & (SKIPPED | CHROME):
            self.text["visible"].append(data)
            for _, parts in self._open:
                parts.append(data)

    def main_text(self) -> str:
        return _flat(self.text["main"] or self.text["shown"])

    def title(self, fallback: str = "") -> str:
        return _flat(self.text["title"]) or _flat(self.text["h1"]) or fallback

    def _once(self, name: str, of: Callable[[], object]) -> object:
        if name not in self._told:
            self._told[name] = of()
        return self._told[name]

    def text_blocks(self) -> list[str]:
        """Different texts of the blocks of the first main, else the first article, else the page, in the order in which they begin."""
        return self._once("blocks", self._text_blocks)

    def _text_blocks(self) -> list[str]:
        for root in (1, 2, None):
            if root is None or ("main", "article")[root - 1] in self.seen:
                found = [_flat(b[0], BLOCK_CHARS) for b in self._blocks if root is None or b[root]]
                return list(dict.fromkeys(t for t in found if len(t) >= LEAST_CHARS))
        return []

    def visible(self) -> str:
        return self._once("visible", lambda: _flat(self.text["visible"]))

    def first_meta(self, *selectors: tuple[str, str]) -> str:
        return next((text for text in (_flat([self.meta.get(s, "")]) for s in selectors) if text), "")

    def headed_links(self) -> list[tuple[str, str, str]]:
        """(address, text, first heading of the nearest area around it) of every link."""
        return [(href, _flat(text), _flat(area[0]) if area else "") for (href, text, _), area in zip(self.links, self._link_areas)]

    def contexts(self) -> list[tuple[str, str, str]]:
        """(address, text, text of the part of the page around it) of every link."""
        said = [(href, _flat(text, TITLE_CHARS), around) for href, text, around in self.links]
        return [(href, text, text if around is None else _flat(around, CONTEXT_CHARS)) for href, text, around in said]


def read(html: str | None) -> Page:
    page = Page()
    page.feed(html or "")
    page.close()
    return page


def json_nodes(value: object, depth: int = 0) -> Iterator[object]:
    """A JSON value and all in it, each before what it holds, down to the caps."""
    if depth > DEPTH:
        return
    yield value
    children = list(value.values()) if isinstance(value, dict) else value if isinstance(value, list) else []
    for child in children[:CHILDREN]:
        yield from json_nodes(child, depth + 1)


def _first(node: dict, keys: tuple[str, ...], limit: int) -> str:
    return next((_flat([node[k]], limit) for k in keys if isinstance(node.get(k), str) and node[k].strip()), "")


def json_candidates(page: Page) -> list[tuple[str, str, str, str]]:
    """(address, title, text, origin) of whatever may be an address in embedded JSON: texts with a slash, and what objects have under ``URL_KEYS``."""
    out: list[tuple[str, str, str, str]] = []
    for kind, name, text in page.scripts:
        if kind not in JSON_TYPES and name not in JSON_IDS:
            continue
        try:
            value = json.loads("".join(text))
        except ValueError:
            continue
        origin = "json_ld" if "ld+json" in kind else "embedded_json"
        for node in json_nodes(value):
            if isinstance(node, str) and "/" in node:
                out.append((node.strip(), "", "", origin))
            elif isinstance(node, dict):
                for key in URL_KEYS:
                    if isinstance(node.get(key), str) and node[key].strip():
                        out.append((node[key].strip(), _first(node, TITLE_KEYS, TITLE_CHARS), _first(node, TEXT_KEYS, CONTEXT_CHARS), origin))
    return out


# Keys that may hold an address, and those of a title within another object.
NESTED_URL_KEYS, NESTED_TITLE_KEYS = ("url", "@id", "href", "path", "slug", "mainEntityOfPage"), ("name", "headline", "title", "@id", "url")


def nested_text(node: dict, keys: tuple[str, ...], within: tuple[str, ...]) -> str:
    """The first text that isn't blank under ``keys``; an object there is asked for ``within`` in turn."""
    for value in map(node.get, keys):
        found = _flat([value]) if isinstance(value, str) else nested_text(value, within, within) if isinstance(value, dict) else ""
        if found:
            return found
    return ""


def all_objects(value: object, depth: int = 0) -> Iterator[dict]:
    """The objects of a JSON value, each before what it holds; of lists the first ``CHILDREN``, of objects all."""
    if depth > DEPTH:
        return
    if isinstance(value, dict):
        yield value
    for child in value.values() if isinstance(value, dict) else value[:CHILDREN] if isinstance(value, list) else ():
        yield from all_objects(child, depth + 1)


def described(page: Page) -> list[tuple[str, str, str, str]]:
    """(address, title, title and description, origin) of the objects with an address and a title in linked data and in the data of the page's framework."""
    out: list[tuple[str, str, str, str]] = []
    framework = next((x for x in page.scripts if x[1] == "__next_data__"), None)
    for kind, name, text in [x for x in page.scripts if "ld+json" in x[0]] + [framework] * (framework is not None):
        try:
            value = json.loads("".join(text))
        except ValueError:
            continue
        origin = "json_ld" if "ld+json" in kind else "next_data"
        for node in all_objects(value):
            address, title = nested_text(node, NESTED_URL_KEYS, NESTED_URL_KEYS), nested_text(node, TITLE_KEYS, NESTED_TITLE_KEYS)
            if address and title:
                out.append((address, title, _flat([title, nested_text(node, TEXT_KEYS, NESTED_TITLE_KEYS)], SUMMARY_CHARS), origin))
    return out


def linked_data(page: Page) -> list[dict]:
    """The objects of a page's JSON-LD."""
    out: list[dict] = []
    for kind, _, text in page.scripts:
        if "ld+json" in kind:
            try:
                out += [node for node in json_nodes(json.loads("".join(text))) if isinstance(node, dict)]
            except ValueError:
                continue
    return out


def iso_time(text: str) -> str | None:
    """ISO spelling of a time or date, in UTC where it has no offset; None for anything else."""
    try:
        found = datetime.fromisoformat(re.sub("[Zz]$", "+00:00", text.strip()))
    except ValueError:
        return None
    return (found if found.tzinfo else found.replace(tzinfo=timezone.utc)).isoformat()


def prose_date(text: str) -> tuple[str, str | None]:
    """The first ``Month d, yyyy`` of a text as it stands, and as ISO time if the calendar has it."""
    found = DATE_END.search(text) and DATE_IN_PROSE.search(text)
    if not found:
        return "", None
    try:
        return found[0], datetime.strptime(" ".join(found[0].title().split()), "%B %d, %Y").replace(tzinfo=timezone.utc).isoformat()
    except ValueError:
        return found[0], None


@dataclass(frozen=True)
class Site:
    """What is particular to the pages of a source: titles that say nothing, the part of a document's title after which the site's name follows, and a summary that all pages share."""

    generic_titles: tuple[str, ...] = ()
    title_end: str = ""
    boilerplate: str = ""


@dataclass
class Record:
    """A record read from a page, and where each field comes from."""

    title: str = ""
    date_text: str = ""
    published_at: str | None = None
    modified_text: str = ""
    modified_at: str | None = None
    summary: str = ""
    evidence: str = ""
    sources: dict[str, str] | None = None

    @property
    def complete(self) -> bool:
        return bool(self.title) and len(self.evidence) >= LEAST_EVIDENCE


def _cascade(*choices: tuple[str, str]) -> tuple[str, str]:
    """The first (method, text) with a text; nothing if none has one."""
    return next(((m, t) for m, t in choices if t), ("", ""))


def record(page: Page, site: Site = Site(), way: str = "static") -> Record:
    """Title, dates, summary and evidence, each from the best place that has it."""
    data, blocks = linked_data(page), page.text_blocks()
    said = lambda key, limit=None: next((t for t in (_flat([str(d.get(key) or "")], limit) for d in data) if t), "")
    document = _flat(page.text["title"], TITLE_CHARS)
    method, title = _cascade(
        ("json_ld_headline", said("headline", TITLE_CHARS)), ("json_ld_name", said("name", TITLE_CHARS)), ("h1", _flat(page.text["h1"], TITLE_CHARS)),
        ("og_title", page.first_meta(("property", "og:title"))), ("twitter_title", page.first_meta(("name", "twitter:title"))),
        ("document_title", re.sub(rf"\s*[|\-]\s*{site.title_end}.*$", "", document, flags=re.I) if site.title_end else document),
    )
    out, sources = Record(), {}
    if title and title.lower() not in site.generic_titles:
        out.title, sources["title"] = title, method
    out.modified_text = said("dateModified")
    out.modified_at = iso_time(out.modified_text)
    if out.modified_at:
        sources["modified_at"] = "json_ld_dateModified"
    prose, prose_time = prose_date(" ".join(blocks))
    method, out.date_text = _cascade(
        ("json_ld_datePublished", said("datePublished")), ("time", _flat([page.time or ""])), ("explicit_date", prose),
        ("article_published_time", page.first_meta(("property", "article:published_time"), ("name", "date"), ("itemprop", "datePublished"))),
    )
    out.published_at = prose_time if method == "explicit_date" else iso_time(out.date_text)
    if out.published_at:
        sources["published_at"] = method
    found = next((b for b in blocks if b != title and len(b) >= LEAST_EVIDENCE), "")
    place = "article" if page.first["article"] is not None else "main" if page.first["main"] is not None else "meaningful_paragraph"
    method, summary = _cascade(
        ("json_ld_description", said("description", SUMMARY_CHARS)), ("meta_description", page.first_meta(("name", "description"))), ("og_description", page.first_meta(("property", "og:description")))
    )
    if site.boilerplate and not blocks and summary.lower().startswith(site.boilerplate):
        method, summary = "", ""
    evidence_from, evidence = (place, found) if found else (method, summary) if len(summary) >= LEAST_EVIDENCE else ("", "")
    if not summary and evidence:
        method, summary = evidence_from, evidence
    out.summary, out.evidence = summary[:SUMMARY_CHARS], evidence[:BLOCK_CHARS]
    sources |= {k: v for k, v in (("summary", method if summary else ""), ("evidence", evidence_from)) if v}
    out.sources = {k: f"{way}_{v}" for k, v in sources.items()}
    return out


def _asks_for_scripts(text: str) -> bool:
    """Whether :data:`NOTICE` is in a text; its word is looked for first, in any spelling that the pattern takes for it."""
    return ("javascript" in text.casefold() or "ı" in text or "İ" in text) and bool(NOTICE.search(text))


def page_error(html: str | None, page: Page, found: Record, site: Site = Site(), rendered: bool = False) -> str | None:
    """The first thing that keeps a page from being used; names as in the reference vocabulary of errors."""
    prefix = "rendered_" if rendered else ""
    empty, visible, blocks = not (html or "").strip(), page.visible(), page.text_blocks()
    shown = _flat(page.text["shown"]).lower()
    blocked = not empty and any(c in shown for c in CHALLENGES)
    bare = len(visible) < LEAST_EVIDENCE and not page.seen and bool(page.scripts)
    shell = _asks_for_scripts(visible) or (page.shell_root and not any(len(b) >= 40 for b in blocks)) or bare
    title = _flat(page.text["h1"]) or page.first_meta(("property", "og:title"), ("name", "twitter:title"))
    untitled = not title or title.lower() in site.generic_titles
    holds = (
        ("rendered_missing_required_fields" if rendered else "empty_response", empty),
        ("blocked_or_challenge_page", blocked),
        ("rendered_missing_required_fields" if rendered else "javascript_shell", shell),
        (None, found.complete),
        (f"{prefix}missing_title", untitled),
        (f"{prefix}missing_evidence", not any(len(b) >= LEAST_EVIDENCE for b in blocks)),
    )
    return next((name for name, on in holds if on), f"{prefix}missing_required_fields")


def text_hash(visible: str) -> str | None:
    """Hash of a page's visible text, as of a JSON object; None without text."""
    told = json.dumps({"visible_text": visible}, ensure_ascii=False, separators=(",", ":"))
    return hashlib.sha256(told.encode()).hexdigest()[:16] if visible else None


#: Pages that are read before their rows are handed on; a batch of Spark's may hold thousands.
AT_ONCE = 64


def few_at_a_time(batches: Iterator[pa.RecordBatch], rows: int = AT_ONCE) -> Iterator[pa.RecordBatch]:
    """``batches`` in parts of so many rows, without copies: what is made of a part is all that a worker holds of results."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


FEATURES = (
    "title string, date_text string, published_at string, modified_at string, summary string, evidence string, sources map<string,string>, complete boolean, unparsed_date boolean, "
    "error string, text_hash string, blocks array<string>, n_links int, n_blocks int"
)


def features(html: str | None, site: Site = Site(), way: str = "static") -> tuple:
    """A row of ``FEATURES``."""
    page = read(html)
    found = record(page, site, way)
    blocks = page.text_blocks()
    return (
        found.title, found.date_text or None, found.published_at, found.modified_at, found.summary, found.evidence, found.sources, found.complete, bool(found.date_text and not found.published_at),
        page_error(html, page, found, site, way == "rendered"), text_hash(page.visible()), blocks, len(page.links), len(blocks),
    )


def page_features(pages: DataFrame, key: str, html: str = "html", sites: dict[str, Site] | None = None, source: str | None = None, way: str = "static") -> DataFrame:
    """One row per page: its record and whether it can be used. Pages don't move.

    ``sites`` is the registry of sources: the column ``source`` names the one whose rules a page is read by.
    """
    known = sites or {}
    keys = [key, *([source] if source else [])]
    kinds = {"string": pa.string(), "int": pa.int32(), "boolean": pa.bool_(), "map<string,string>": pa.map_(pa.string(), pa.string()), "array<string>": pa.list_(pa.string())}
    columns = [(name, kinds[kind]) for name, kind in (c.split() for c in FEATURES.split(", "))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in few_at_a_time(batches):
            rules = [known.get(s, Site()) for s in batch.column(source).to_pylist()] if source else [Site()] * batch.num_rows
            found = zip(*[features(h, site, way) for h, site in zip(batch.column(html).to_pylist(), rules)])
            made = [pa.array([x and list(x.items()) for x in c] if pa.types.is_map(kind) else c, kind) for c, (_, kind) in zip(found, columns)]
            yield pa.RecordBatch.from_arrays([*(batch.column(k) for k in keys), *made], names=[*keys, *(name for name, _ in columns)])

    told = ", ".join(f"{k} {pages.schema[k].dataType.simpleString()}" for k in keys)
    return pages.select(*keys, html).mapInArrow(run, f"{told}, {FEATURES}")


def page_rows(pages: DataFrame, key: str, what: str, html: str = "html") -> DataFrame:
    """Rows of each page by place, as ``key, pos, a, b, c, d``: ``blocks`` (text), ``links`` (url, text, context), ``json`` (url, title, text, origin), or ``both`` of these, each by its own places."""

    def rows_of(page: Page) -> list[tuple]:
        if what == "blocks":
            return [(pos, b, "", "", "") for pos, b in enumerate(page.text_blocks())]
        links = [(pos, *x, "anchor") for pos, x in enumerate(page.contexts())] if what in ("links", "both") else []
        return links + ([(pos, *x) for pos, x in enumerate(json_candidates(page))] if what in ("json", "both") else [])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in few_at_a_time(batches):
            kinds = [batch.schema.field(key).type, pa.int32(), *[pa.string()] * 4]
            out = [(k, *row) for k, h in zip(batch.column(key).to_pylist(), batch.column(html).to_pylist()) for row in rows_of(read(h))]
            columns = zip(*out) if out else [[]] * len(kinds)
            yield pa.RecordBatch.from_arrays([pa.array(list(c), kind) for c, kind in zip(columns, kinds)], names=[key, "pos", "a", "b", "c", "d"])

    return pages.select(key, html).mapInArrow(run, f"{key} {pages.schema[key].dataType.simpleString()}, pos int, a string, b string, c string, d string")


def dom_title(heading: Column, text: Column) -> Column:
    """Title of a link that a rendered page shows: its heading, else its text unless that says nothing."""
    said = F.trim(F.substring(F.regexp_replace(F.coalesce(text, F.lit("")), r"\s+", " "), 1, TITLE_CHARS))
    named = F.trim(F.substring(F.regexp_replace(F.coalesce(heading, F.lit("")), r"\s+", " "), 1, TITLE_CHARS))
    return F.when(named != "", named).when(F.lower(said).isin(*EMPTY_TITLES), F.lit("")).otherwise(said)


@F.pandas_udf(StringType())
def _main(pages: pd.Series) -> pd.Series:
    return pages.map(lambda h: read(h).main_text())


def main_text(html: Column) -> Column:
    return _main(html)


def title_native(html: Column) -> Column:
    """Title by regular expression, for pages without markup in it; stays in the JVM."""
    found = F.regexp_extract(html, r"(?is)<title[^>]*>(.*?)</title>", 1)
    return F.trim(F.regexp_replace(found, r"\s+", " "))
