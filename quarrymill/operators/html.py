"""Web pages: metadata, links, visible text, cleaned markdown; one pass with the standard parser, Arrow batch by batch."""

from __future__ import annotations

import re
from collections.abc import Iterator
from html.parser import HTMLParser
from urllib.parse import urljoin, urlsplit

import pyarrow as pa
from pyspark.sql import DataFrame

_SILENT = {"script", "style", "noscript", "template", "svg", "head"}
_CHROME = {"nav", "header", "footer", "aside", "form", "button"}
_NOISE = re.compile(r"(?:^|[\s_-])(?:ad|ads|advert|banner|cookie|cookies|sidebar|social|share|breadcrumb|popup|newsletter)(?:$|[\s_-])", re.I)
_VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
_BLOCK = {"p", "div", "section", "article", "main", "ul", "ol", "table", "tr", "blockquote", "pre", "figure", "h1", "h2", "h3", "h4", "h5", "h6", "li", "br", "hr"}


class Page(HTMLParser):
    """What a page's markup says; unclosed tags end with the element around them."""

    def __init__(self, html: str, url: str = ""):
        super().__init__(convert_charrefs=True)
        self.url, self.title, self.language = url, "", ""
        self.meta: dict[str, str] = {}
        self.canonical = ""
        self.alternates: list[tuple[str, str]] = []
        self.links: list[tuple[str, str, str]] = []
        self.visible: list[str] = []
        self.body: list[str] = []
        self.media: list[tuple[str, str, str]] = []
        self.password = False
        self._open: list[tuple[str, bool, bool]] = []
        self._link: tuple[str, str, list[str]] | None = None
        self.feed(html or "")
        self.close()

    def handle_starttag(self, tag, attrs):
        a = {k: v or "" for k, v in attrs}
        if tag == "html":
            self.language = a.get("lang", "").strip()
        if tag == "meta":
            name = (a.get("name") or a.get("property") or "").lower()
            if name and name not in self.meta:
                self.meta[name] = a.get("content", "").strip()
        if tag == "link":
            rel = a.get("rel", "").lower().split()
            if "canonical" in rel and not self.canonical:
                self.canonical = urljoin(self.url, a.get("href", "").strip())
            if "alternate" in rel and a.get("hreflang"):
                self.alternates.append((a["hreflang"], urljoin(self.url, a.get("href", "").strip())))
        if tag == "a" and a.get("href"):
            self._link = (urljoin(self.url, a["href"].strip()), a.get("rel", ""), [])
        if tag in ("img", "video", "iframe") and a.get("src"):
            self.media.append(({"img": "image"}.get(tag, "video"), urljoin(self.url, a["src"].strip()), a.get("alt", "").strip()))
            if tag == "img" and a.get("alt", "").strip():
                self._say(a["alt"].strip(), markup=True)
        if tag == "input" and a.get("type", "").lower() == "password":
            self.password = True
        silent = tag in _SILENT or "hidden" in a or a.get("aria-hidden") == "true" or "display:none" in a.get("style", "").replace(" ", "").lower()
        chrome = tag in _CHROME or bool(_NOISE.search(f"{a.get('class', '')} {a.get('id', '')}"))
        if tag not in _VOID:
            before = self._open[-1] if self._open else ("", False, False)
            self._open.append((tag, before[1] or silent, before[2] or chrome))
        if tag in _BLOCK:
            self._break()
            if re.fullmatch("h[1-6]", tag):
                self._say("#" * int(tag[1]) + " ", markup=True)
            if tag == "li":
                self._say("- ", markup=True)

    def handle_endtag(self, tag):
        if tag == "a" and self._link:
            self.links.append((self._link[0], self._link[1], " ".join("".join(self._link[2]).split())))
            self._link = None
        names = [t for t, _, _ in self._open]
        if tag in names:
            del self._open[len(names) - 1 - names[::-1].index(tag) :]
        if tag in _BLOCK:
            self._break()

    def handle_data(self, data):
        if any(t == "title" for t, _, _ in self._open):
            self.title += data
            return
        if self._link:
            self._link[2].append(data)
        self._say(data)

    def _say(self, data: str, markup: bool = False) -> None:
        _, silent, chrome = self._open[-1] if self._open else ("", False, False)
        if not silent:
            if not markup:
                self.visible.append(data)
            if not chrome:
                self.body.append(data)

    def _break(self) -> None:
        self.visible.append(" ")
        self.body.append("\n")

    @property
    def visible_text(self) -> str:
        return " ".join("".join(self.visible).split())

    @property
    def markdown(self) -> str:
        lines = (" ".join(x.split()) for x in "".join(self.body).split("\n"))
        return "\n\n".join(x for x in lines if x and not re.fullmatch(r"#+|-", x))

    @property
    def noindex(self) -> bool:
        said = re.split(r"[\s,;]+", " ".join(v for k, v in self.meta.items() if k.endswith(("robots", "bot"))).lower())
        return bool({"noindex", "none"} & set(said))


def page_records(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """(url, title, language, canonical, description, noindex, login_form, visible_text, markdown, n_links): one row a page; null markup counts as empty."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["url", "title", "language", "canonical", "description", "noindex", "login_form", "visible_text", "markdown", "n_links"]
        kinds = [pa.string()] * 5 + [pa.bool_()] * 2 + [pa.string()] * 2 + [pa.int32()]
        for batch in batches:
            rows = []
            for u, h in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                p = Page(h or "", u or "")
                rows.append((u, " ".join(p.title.split()), p.language, p.canonical, p.meta.get("description", ""), p.noindex, p.password, p.visible_text, p.markdown, len(p.links)))
            yield pa.RecordBatch.from_arrays([pa.array([r[c] for r in rows], k) for c, k in enumerate(kinds)], names)

    return pages.select(url, html).mapInArrow(run, "url string, title string, language string, canonical string, description string, noindex boolean, login_form boolean, visible_text string, markdown string, n_links int")


def link_edges(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """(source_url, target_url, link_type, anchor): links to http addresses; a type is internal, external or document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for u, h in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                for target, _, anchor in Page(h or "", u or "").links:
                    parts = urlsplit(target)
                    if parts.scheme in ("http", "https"):
                        kind = "document" if re.search(r"\.(?:pdf|docx?|pptx?|xlsx?)$", parts.path, re.I) else "internal" if parts.netloc.lower() == urlsplit(u or "").netloc.lower() else "external"
                        rows.append((u, target.split("#")[0], kind, anchor))
            yield pa.RecordBatch.from_arrays([pa.array([r[c] for r in rows], pa.string()) for c in range(4)], ["source_url", "target_url", "link_type", "anchor"])

    return pages.select(url, html).mapInArrow(run, "source_url string, target_url string, link_type string, anchor string")
