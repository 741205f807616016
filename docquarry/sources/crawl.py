"""Crawling: sitemaps, link frontiers and page fetching behind a pluggable fetcher, as DataFrame steps."""

from __future__ import annotations

import html.parser
import re
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docquarry import scratch
from docquarry.functions import text as T

Fetcher = Callable[[str], str | None]


def no_network(url: str) -> str | None:
    """The default fetcher: this engine opens no connection of its own accord."""
    return None


def http_get(url: str, timeout: float = 20.0, attempts: int = 3) -> str | None:
    """A page by HTTP, gunzipped if need be, after at most ``attempts`` tries; None if it can't be had."""
    import gzip
    import time
    import urllib.request

    for k in range(attempts):
        try:
            with urllib.request.urlopen(url, timeout=timeout) as r:  # noqa: S310
                body = r.read()
            return (gzip.decompress(body) if body[:2] == b"\x1f\x8b" else body).decode("utf-8", "replace")
        except (OSError, ValueError):
            time.sleep(2.0**k)
    return None


def fetched(urls: DataFrame, fetch: Fetcher = no_network, per_task: int = 50) -> DataFrame:
    """(url, success, html, error) for each URL (url); a task keeps one session for its URLs."""
    scratch.ship(urls.sparkSession)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            got = [fetch(u) for u in f["url"]]
            yield pd.DataFrame({"url": f["url"], "success": [g is not None for g in got], "html": got, "error": [None if g is not None else "not fetched" for g in got]})

    return urls.select("url").mapInPandas(run, "url string, success boolean, html string, error string")


def parsed_sitemaps(maps: DataFrame, xml: str = "xml") -> DataFrame:
    """Sitemaps with their kind (index, urlset) and locations, whatever their namespace."""
    return maps.withColumns({"kind": T.sitemap_kind(F.col(xml)), "locs": T.sitemap_locations(F.col(xml))}).drop(xml)


def discover(spark: SparkSession, seed: str, fetch: Fetcher = no_network, extra: tuple[str, ...] = (), most_rounds: int = 1_000) -> DataFrame:
    """URLs under a seed that its sitemaps name, each once; indexes are followed round by round.

    A round fetches the sitemaps not seen yet (an anti-join), writes what it
    found to the shared folder, and the last is the one without a new one. Indexes
    nested deeper than ``most_rounds`` are an error, not an end.
    """
    root = seed.rstrip("/")
    candidates = [f"{root}/sitemap.xml", f"{root}/sitemap_index.xml", *extra]
    robots = fetch(f"{root}/robots.txt") or ""
    candidates += re.findall(r"(?im)^sitemap:\s*(\S+)", robots)
    frontier = spark.createDataFrame([(u,) for u in dict.fromkeys(candidates)], "url string")
    seen, pages = frontier, None
    for _ in range(most_rounds):
        maps = fetched(frontier, fetch).where("success").select(F.col("url").alias("sitemap"), F.col("html").alias("xml"))
        found = scratch.materialize(parsed_sitemaps(maps).select("kind", F.explode("locs").alias("url")).distinct(), "sitemaps")
        own = found.where(F.col("kind") == "urlset").select("url")
        pages = own if pages is None else pages.union(own)
        frontier = scratch.materialize(found.where(F.col("kind") == "index").select("url").join(seen, "url", "left_anti"), "frontier")
        if frontier.isEmpty():
            break
        seen = seen.union(frontier)
    else:
        raise RuntimeError(f"sitemap indexes are nested deeper than {most_rounds}")
    return pages.where(F.startswith("url", F.lit(root + "/")) | (F.col("url") == root)).distinct()


LINK = r"(?is)<a\b[^>]*\bhref\s*=\s*[\"']([^\"'#]+)"


def resolved(url: Column, href: Column) -> Column:
    """The absolute target of a link on a page: as it is, on the page's scheme, host, folder or path; null where it is no address of a page (mailto and the like)."""
    href = F.trim(href)
    scheme = F.regexp_extract(url, r"^([A-Za-z][A-Za-z0-9+.-]*:)", 1)
    host = F.regexp_extract(url, r"^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)", 1)
    path = T.url_path(url)
    folder = F.regexp_replace(F.when(path == "", "/").otherwise(path), "[^/]*$", "")
    own = F.regexp_extract(href, "^([^?]*)", 1)
    place = F.when(F.startswith(own, F.lit("/")), own).when(own == "", path).otherwise(F.concat(folder, own))
    query = F.regexp_extract(href, r"(\?.*)$", 1)

    def climb(kept: Column, part: Column) -> Column:
        return F.when(part == ".", kept).when(part == "..", F.slice(kept, F.lit(1), F.greatest(F.size(kept) - 1, F.lit(0)))).otherwise(F.concat(kept, F.array(part)))

    every = F.split(place, "/")
    parts = F.slice(every, F.lit(2), F.size(every))
    steps = F.aggregate(parts, F.array().cast("array<string>"), climb)
    ends_in_dots = place.rlike(r"/\.\.?$")
    walked = F.when(place.rlike(r"(^|/)\.\.?(/|$)"), F.concat(F.lit("/"), F.array_join(steps, "/"), F.when(ends_in_dots & (F.size(steps) > 0), "/").otherwise(""))).otherwise(place)
    return (
        F.when(href.rlike("^[A-Za-z][A-Za-z0-9+.-]*://"), href).when(href.rlike("^[A-Za-z][A-Za-z0-9+.-]*:"), F.lit(None).cast("string"))
        .when(F.startswith(href, F.lit("//")), F.concat(scheme, href)).otherwise(F.concat(host, walked, query))
    )


def links(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """(url, target): the absolute targets of a page's links, each once."""
    out = pages.select(F.col(url).alias("url"), F.explode(F.array_distinct(F.regexp_extract_all(F.col(html), F.lit(LINK), 1))).alias("href"))
    return out.select("url", resolved(F.col("url"), T.decode_entities(F.col("href"))).alias("target")).where("target is not null").distinct()


def deep_crawl(spark: SparkSession, seeds: list[str], fetch: Fetcher = no_network, domains: list[str] | None = None, depth: int = 2, most_pages: int = 50_000) -> DataFrame:
    """(url, depth, success, html, error) breadth first: each round fetches the links not seen yet within the domains, down to ``depth``."""
    from docquarry.operators.filters import in_domains

    frontier, seen, out, total = spark.createDataFrame([(u,) for u in dict.fromkeys(seeds)], "url string"), None, None, 0
    for level in range(depth + 1):
        got = scratch.materialize(fetched(frontier, fetch).withColumn("depth", F.lit(level)), "crawl")
        out = got if out is None else out.union(got)
        seen = frontier if seen is None else seen.union(frontier)
        total += got.count()
        if level == depth or total >= most_pages:
            break
        targets = links(got.where("success")).select(F.col("target").alias("url")).distinct()
        frontier = scratch.materialize(in_domains(targets, domains).join(seen, "url", "left_anti").orderBy("url").limit(most_pages - total), "frontier")
        if frontier.isEmpty():
            break
    return out.select("url", "depth", "success", "html", "error")


class _Markdown(html.parser.HTMLParser):
    """HTML to markdown: ATX headings, dash bullets, fences for preformatted text; images and dropped elements leave nothing.

    drop, keep: selectors of elements to leave out and, if there are any, of those
    that alone are read: a tag, .class, #id, or a tag with either.
    """

    DROP = frozenset(("script", "style", "nav", "footer", "header", "aside", "noscript", "template", "svg"))
    VOID = frozenset(("img", "br", "hr", "input", "meta", "link"))

    def __init__(self, drop: frozenset[str], keep: tuple[str, ...] = ()):
        super().__init__(convert_charrefs=True)
        self.drop, self.keep, self.out, self.href, self.pre, self.lists = tuple(drop), keep, [], [], 0, []
        self.open: list[tuple[str, bool, bool]] = []  # of each open element: its tag, whether it hides, whether it shows

    @property
    def hidden(self) -> bool:
        return any(h for _, h, _ in self.open) or bool(self.keep) and not any(s for *_, s in self.open)

    @staticmethod
    def selects(selectors: tuple[str, ...], tag: str, attrs: dict[str, str | None]) -> bool:
        classes = (attrs.get("class") or "").split()
        for s in selectors:
            name, sign, value = re.match(r"([\w-]*)([.#]?)(.*)", s).groups()
            if (not name or name == tag) and (not sign or (value in classes if sign == "." else value == attrs.get("id"))):
                return True
        return False

    def handle_starttag(self, tag, attrs):
        named = dict(attrs)
        hides = self.selects(self.drop, tag, named)
        if tag not in self.VOID:
            self.open.append((tag, hides, self.selects(self.keep, tag, named)))
        if self.hidden or hides:
            return
        if re.fullmatch("h[1-6]", tag):
            self.out.append("\n\n" + "#" * int(tag[1]) + " ")
        elif tag in ("p", "div", "section", "article", "table", "tr", "blockquote"):
            self.out.append("\n\n" if tag != "tr" else "\n")
        elif tag == "br":
            self.out.append("\n")
        elif tag in ("ul", "ol"):
            self.lists.append([tag, 0])
            self.out.append("\n")
        elif tag == "li":
            kind = self.lists[-1] if self.lists else ["ul", 0]
            kind[1] += 1
            self.out.append("\n" + "  " * max(0, len(self.lists) - 1) + ("- " if kind[0] == "ul" else f"{kind[1]}. "))
        elif tag in ("b", "strong"):
            self.out.append("**")
        elif tag in ("i", "em"):
            self.out.append("*")
        elif tag == "pre":
            self.pre += 1
            self.out.append("\n\n```\n")
        elif tag == "code" and not self.pre:
            self.out.append("`")
        elif tag in ("td", "th"):
            self.out.append("| ")
        elif tag == "a":
            self.href.append(dict(attrs).get("href") or "")
            self.out.append("[")

    def handle_endtag(self, tag):
        hidden = self.hidden
        at = next((i for i in range(len(self.open) - 1, -1, -1) if self.open[i][0] == tag), None)
        if at is not None:
            del self.open[at:]  # what was left open within it ends too
        if hidden:
            return
        if re.fullmatch("h[1-6]", tag) or tag in ("p", "div", "section", "article", "table", "blockquote"):
            self.out.append("\n\n")
        elif tag in ("ul", "ol"):
            if self.lists:
                self.lists.pop()
            self.out.append("\n")
        elif tag in ("b", "strong"):
            self.out.append("**")
        elif tag in ("i", "em"):
            self.out.append("*")
        elif tag == "pre":
            self.pre = max(0, self.pre - 1)
            self.out.append("\n```\n\n")
        elif tag == "code" and not self.pre:
            self.out.append("`")
        elif tag in ("td", "th"):
            self.out.append(" ")
        elif tag == "tr":
            self.out.append("|")
        elif tag == "a" and self.href:
            self.out.append(f"]({self.href.pop()})")

    def handle_data(self, data):
        if not self.hidden:
            self.out.append(data if self.pre else re.sub(r"\s+", " ", data))


def html_to_markdown(page: str, drop: tuple[str, ...] = (), keep: tuple[str, ...] = ()) -> str:
    parser = _Markdown(_Markdown.DROP | frozenset(drop), keep)
    parser.feed(page)
    parser.close()
    text = "\n".join(x.rstrip() for x in "".join(parser.out).split("\n"))
    return re.sub(r"\n{3,}", "\n\n", text).strip()


def as_markdown(pages: DataFrame, html: str = "html") -> DataFrame:
    """The pages with a column ``markdown``; null stays null."""
    scratch.ship(pages.sparkSession)

    @F.pandas_udf("string")
    def convert(batch: pd.Series) -> pd.Series:
        return batch.map(lambda h: None if h is None else html_to_markdown(h))

    return pages.withColumn("markdown", convert(F.col(html)))
