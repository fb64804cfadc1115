"""Page markup: one Arrow pass parses a page once, into a struct that all extractors read."""

from __future__ import annotations

import json
from collections.abc import Iterable, Iterator
from html.parser import HTMLParser
from urllib.parse import urljoin
from xml.etree import ElementTree

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import ArrayType, DataType, StringType

PAGE = (
    "struct<title_h1:string, nav:string, text:string, links:array<struct<href:string,url:string,text:string>>,"
    " images:array<struct<src:string,url:string,hint:string,header:boolean,width:string,height:string>>,"
    " meta_description:string, og_description:string, og_image:string,"
    " jsonld:array<string>, jsonld_description:array<string>, jsonld_address:string, jsonld_contacts:array<string>, jsonld_logos:array<string>,"
    " hero:array<string>, main_text:string>"
)
FIELDS = ("title_h1", "nav", "text", "links", "images", "meta_description", "og_description", "og_image", "jsonld", "jsonld_description", "jsonld_address", "jsonld_contacts", "jsonld_logos", "hero", "main_text")
VOID = frozenset(("area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"))
HIDDEN = frozenset(("script", "style", "noscript", "svg"))
ADDRESS = ("streetAddress", "addressLocality", "addressRegion", "postalCode", "addressCountry")


def resolved(base: str, href: str) -> str:
    """Per link: a malformed one stays alone with its trouble."""
    try:
        return urljoin(base, href)
    except ValueError:
        return href


class _Page(HTMLParser):
    def __init__(self, base: str):
        super().__init__(convert_charrefs=True)
        self.base, self.stack = base, []
        self.text: list[str] = []
        self.headlines: list[list[str]] = []
        self.navs: list[list[str]] = []
        self.mains: list[list[str]] = []
        self.links: list[dict] = []
        self.images: list[dict] = []
        self.meta: dict[str, str] = {}
        self.scripts: list[str] = []
        self.heroes: dict[str, list[str]] = {}
        self.after_h1 = False

    def _inside(self, *names: str) -> bool:
        return any(t in names for t, _, _ in self.stack)

    def handle_starttag(self, tag, attrs):
        a = {k: v or "" for k, v in attrs}
        if tag == "p" and self.stack and self.stack[-1][0] == "p":
            self.handle_endtag("p")
        sinks = []
        if tag in ("title", "h1") and len(self.headlines) < 8:
            self.headlines.append([])
            sinks.append(self.headlines[-1])
        if (tag == "nav" or "collection" in a.get("class", "")) and len(self.navs) < 30:
            self.navs.append([])
            sinks.append(self.navs[-1])
        if tag in ("main", "article"):
            self.mains.append([])
            sinks.append(self.mains[-1])
        if tag == "a" and "href" in a:
            link = {"href": a["href"], "url": resolved(self.base, a["href"].strip()), "text": []}
            self.links.append(link)
            sinks.append(link["text"])
        if tag == "img" and (a.get("src") or a.get("data-src")):
            raw = a.get("src") or a["data-src"]
            hint = " ".join((a.get("alt", ""), a.get("class", ""), a.get("id", ""), raw)).lower()
            self.images.append({"src": raw, "url": resolved(self.base, raw), "hint": hint, "header": self._inside("header"), "width": a.get("width", "0"), "height": a.get("height", "0")})
        if tag == "meta":
            key = a.get("name") if a.get("name") == "description" else a.get("property")
            if key in ("description", "og:description", "og:image") and "content" in a:
                self.meta.setdefault(key, a["content"])
        if tag == "p":
            in_main = self._inside("main")
            if in_main and self.after_h1:
                sinks.append(self.heroes.setdefault("main h1 + p", []) if "main h1 + p" not in self.heroes else [])
            if any(t == "section" and "hero" in c for t, c, _ in self.stack):
                sinks.append(self.heroes.setdefault("hero p", []) if "hero p" not in self.heroes else [])
            if in_main:
                sinks.append(self.heroes.setdefault("main p", []) if "main p" not in self.heroes else [])
        if tag != "h1":
            self.after_h1 = False
        if tag == "script" and a.get("type") == "application/ld+json":
            self.scripts.append("")
        if tag not in VOID:
            self.stack.append((tag, a.get("class", ""), (sinks, a.get("type") == "application/ld+json")))

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.handle_endtag(tag)

    def handle_endtag(self, tag):
        for k in range(len(self.stack) - 1, -1, -1):
            if self.stack[k][0] == tag:
                del self.stack[k:]
                break
        self.after_h1 = tag == "h1"

    def handle_data(self, data):
        if self.stack and self.stack[-1][0] == "script" and self.stack[-1][2][1]:
            self.scripts[-1] += data
        if not data.strip():
            return
        for t, _, (sinks, _) in self.stack:
            for sink in sinks:
                sink.append(data.strip())
        if not self._inside(*HIDDEN):
            self.text.append(data.strip())


def json_items(scripts: list[str]) -> list[dict]:
    """Objects of JSON-LD scripts; a graph's items come before the object that holds them; bad JSON is skipped."""
    out = []
    for raw in scripts:
        try:
            parsed = json.loads(raw)
        except (ValueError, RecursionError):
            continue
        for value in parsed if isinstance(parsed, list) else [parsed]:
            if isinstance(value, dict):
                graph = value.get("@graph")
                out += [x for x in graph if isinstance(x, dict)] if isinstance(graph, list) else []
                out.append(value)
    return out


def _walk(value) -> Iterator[dict]:
    """Objects at any depth, outer ones first, without recursion."""
    todo = [value]
    while todo:
        x = todo.pop()
        if isinstance(x, dict):
            yield x
            todo += list(x.values())[::-1]
        elif isinstance(x, list):
            todo += x[::-1]


def _logo(item: dict, base: str, kinds: tuple[str, ...]) -> str | None:
    kind = item.get("@type", "")
    if not any(k in kinds for k in (kind if isinstance(kind, list) else [kind]) if isinstance(k, str)):
        return None
    logo = item.get("logo")
    if isinstance(logo, dict):
        logo = logo.get("url") or logo.get("contentUrl")
    return resolved(base, logo) if isinstance(logo, str) and logo else None


def parse(html: str | None, base: str | None, logo_types: tuple[str, ...]) -> dict | None:
    if not html:
        return None
    page = _Page(base or "")
    try:
        page.feed(html)
        page.close()
    except Exception:  # what was read up to there stays
        pass
    spaced = lambda parts: " ".join(" ".join(parts).split())
    items = _safe(lambda: json_items(page.scripts), [])
    objects = _safe(lambda: [o for item in items for o in _walk(item)], [])
    fields = {
        "title_h1": lambda: spaced(x for h in page.headlines for x in h),
        "nav": lambda: spaced(x for n in page.navs for x in n),
        "text": lambda: spaced(page.text),
        "links": lambda: [{**x, "text": spaced(x["text"])} for x in page.links],
        "images": lambda: page.images,
        "meta_description": lambda: page.meta.get("description"),
        "og_description": lambda: page.meta.get("og:description"),
        "og_image": lambda: resolved(base or "", page.meta["og:image"]) if page.meta.get("og:image") else None,
        "jsonld": lambda: [json.dumps(x, ensure_ascii=False) for x in items],
        "jsonld_description": lambda: [x["description"] for x in items if isinstance(x.get("description"), str)],
        "jsonld_address": lambda: " ".join(o[k] for o in objects if any(k in o for k in ADDRESS[:4]) for k in ADDRESS if isinstance(o.get(k), str)),
        "jsonld_contacts": lambda: [str(v) for o in objects for k, v in o.items() if k.lower() in ("email", "telephone", "phone") and isinstance(v, str | int)],
        "jsonld_logos": lambda: [u for x in items if (u := _logo(x, base or "", logo_types))],
        "hero": lambda: [spaced(page.heroes[k]) for k in ("main h1 + p", "hero p", "main p") if k in page.heroes],
        "main_text": lambda: spaced(page.mains[0]) if page.mains else None,
    }
    return {k: _safe(f, EMPTY.get(k)) for k, f in fields.items()}


#: What a field is where it could not be read.
EMPTY = {"title_h1": "", "nav": "", "text": "", "jsonld_address": "", **dict.fromkeys(("links", "images", "jsonld", "jsonld_description", "jsonld_contacts", "jsonld_logos", "hero"), [])}


def _safe(read, otherwise):
    """A field's trouble stays its own: neither the page's other fields nor the task are lost."""
    try:
        return read()
    except Exception:
        return otherwise


#: Characters of markup after which parsed pages are handed on: a parsed page takes several times its markup, so a whole batch of them is never held.
PORTION = 1 << 18


def parsed_portions(pages: Iterable[tuple[str | None, str | None]], logo_types: tuple[str, ...], most: int = PORTION) -> Iterator[list[dict]]:
    """The pages' structs in order, in lists of about ``most`` characters of markup."""
    empty = dict.fromkeys(FIELDS)
    part, held = [], 0
    for html, url in pages:
        part.append(parse(html, url, logo_types) or empty)
        held += len(html or "")
        if held >= most:
            yield part
            part, held = [], 0
    if part:
        yield part


def parsed_page(html: Column, url: Column, logo_types: tuple[str, ...] = ("Organization", "Brand", "LocalBusiness", "Store")) -> Column:
    """The struct PAGE of a page; null fields for a page without markup.

    To Spark it is not deterministic: else a filter that it infers from a field would parse the pages once more."""
    kind = to_arrow_type(DataType.fromDDL(PAGE))

    @F.arrow_udf(PAGE)
    def run(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for htmls, urls in batches:
            for part in parsed_portions(((h.as_py(), u.as_py()) for h, u in zip(htmls, urls)), logo_types):
                yield pa.array(part, kind)

    return run.asNondeterministic()(html, url)


#: Entities that plain headlines have, in the order in which they are resolved.
NAMED = {"&copy;": "©", "&middot;": "·", "&quot;": '"', "&amp;": "&"}


def plain_headlines(html: Column) -> Column:
    """The first title and h1 without attributes or markup within, without a parse; only whole entities of NAMED are resolved; null without markup."""
    text = F.concat_ws(" ", *[F.regexp_extract(html, f"<{t}>([^<]*)</{t}>", 1) for t in ("title", "h1")])
    for entity, plain in NAMED.items():
        text = F.replace(text, F.lit(entity), F.lit(plain))
    spaced = F.regexp_replace(text, r"[\t\n\f\r ]+", " ")
    return F.when(html.isNotNull(), F.regexp_replace(spaced, r"^\p{Zs}+|\p{Zs}+\z", ""))


def locations(xml: str | None) -> list[str]:
    """Texts of <loc> elements of any namespace, in order; none for what is no well-formed XML."""
    try:
        found = [e.text for e in ElementTree.fromstring((xml or "").strip()).iter() if isinstance(e.tag, str) and e.tag.rsplit("}", 1)[-1] == "loc"]
    except (ElementTree.ParseError, ValueError):
        return []
    return [t.strip() for t in found if t and t.strip()]


@F.arrow_udf(ArrayType(StringType()))
def _locations(xml: pa.Array) -> pa.Array:
    return pa.array([locations(x) for x in xml.to_pylist()], pa.list_(pa.string()))


def sitemap_urls(xml: Column) -> Column:
    """``locations`` of each sitemap."""
    return _locations(xml)
