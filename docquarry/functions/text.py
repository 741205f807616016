"""Column functions on strings: tokens, titles, URLs, names, hashes, front matter and report lines."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from docquarry.functions.by_row import by_row

#: White space as Python's str.strip() sees it, for Java patterns.
SPACE = r"[\s\x0B\x1c-\x1f\x85\xA0  -     　]"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` evaluated once a row, also where lambdas would repeat it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def strip(text: Column) -> Column:
    """Leading and trailing white space goes, tabs and newlines included."""
    return F.regexp_replace(text, r"^\s+|(?<!\s)\s+\z", "")


def token_count(text: Column) -> Column:
    """Tokens as runs without white space; a byte-pair counter can be plugged in elsewhere."""
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(r"\S+")).cast("int")


def counted_tokens(text: Column, counter: Callable[[str], int]) -> Column:
    """Tokens by a counter of one's own, a byte-pair encoder for one. Null has none."""
    return by_row(lambda t: 0 if t is None else counter(t), "int", text)


#: Short words that tell languages apart; none stands for two of them.
MARKERS = {"en": ("the", "and", "of", "is", "that"), "de": ("der", "und", "die", "nicht", "ist"), "fr": ("les", "est", "une", "dans", "pour"), "es": ("el", "los", "por", "una", "con")}


def detected_language(text: Column) -> Column:
    """The language whose marker words occur most often, the first of equals; "und" where none does."""

    def best(words: Column) -> Column:
        counts = [F.struct(F.size(F.filter(words, lambda w: w.isin(*own))).alias("n"), F.lit(-i).alias("i"), F.lit(lang).alias("lang")) for i, (lang, own) in enumerate(MARKERS.items())]
        return let(F.greatest(*counts), lambda b: F.when(b["n"] > 0, b["lang"]).otherwise("und"))

    return let(F.split(F.lower(text), r"[^\p{L}]+"), best)


def collapse_space(text: Column) -> Column:
    """Every run of white space, thin and no-break ones included, becomes a space."""
    return F.trim(F.regexp_replace(text, SPACE + "+", " "))


def slug(text: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(F.lower(text), "[^a-z0-9]+", "-"), "^-+|-+$", "")


def short_hash(text: Column, kind: str = "sha1", size: int = 8) -> Column:
    made = {"sha1": F.sha1, "md5": F.md5, "sha256": lambda c: F.sha2(c, 256)}[kind]
    return F.substring(made(text.cast("binary") if kind != "sha256" else text), 1, size)


def chunk_id(filename: Column, ord_: Column, level: Column, sub: Column | None = None, kind: Column | None = None) -> Column:
    """h<level>_<8 hex>, with _exa or _tab for peeled parts; made from the place in the file, so runs agree."""
    sub = F.lit(0) if sub is None else sub
    digest = short_hash(F.concat_ws("|", filename, ord_.cast("string"), sub.cast("string")), "sha256")
    suffix = F.lit("") if kind is None else F.when(kind == "example", "_exa").when(kind == "table", "_tab").otherwise("")
    return F.concat(F.lit("h"), level.cast("string"), F.lit("_"), digest, suffix)


def chunk_kind(content: Column) -> Column:
    head = F.regexp_replace(content, r"^\s+", "")
    return F.when(F.startswith(head, F.lit("```")), "example").when(F.startswith(head, F.lit("Table:")), "table").otherwise("heading")


# --- HTML and URLs


def decode_entities(text: Column) -> Column:
    for name, char in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&nbsp;", " "), ("&amp;", "&")):
        text = F.replace(text, F.lit(name), F.lit(char))
    return text


def strip_tags(html: Column) -> Column:
    return F.regexp_replace(html, "<[^>]*>", "")


def html_title(html: Column) -> Column:
    """The page's title: an H1 of class page-title, else the first H1; tags go, entities are decoded, white space collapses; null if none."""
    marked = F.regexp_extract(html, r"(?is)<h1[^>]*class=[\"'][^\"']*page-title[^\"']*[\"'][^>]*>(.*?)</h1>", 1)
    first = F.regexp_extract(html, r"(?is)<h1[^>]*>(.*?)</h1>", 1)
    raw = F.when(marked != "", marked).otherwise(first)
    title = F.trim(F.regexp_replace(decode_entities(strip_tags(raw)), r"\s+", " "))
    return F.when(title != "", title)


def html_without(html: Column, tags: tuple[str, ...] = ("script", "style", "nav", "footer", "header", "aside")) -> Column:
    """The page without the elements named (not nested in their own kind) and without comments."""
    for tag in tags:
        html = F.regexp_replace(html, rf"(?is)<{tag}\b[^>]*>.*?</{tag}>", "")
    return F.regexp_replace(html, r"(?s)<!--.*?-->", "")


def force_h1(markdown: Column, title: Column) -> Column:
    """``# title`` on top: an H1 that leads is replaced, else one is put before."""
    body = F.regexp_replace(markdown, r"^\s+", "")
    return F.when(title.isNull(), markdown).when(body.rlike(r"^# "), F.concat(F.lit("# "), title, F.regexp_replace(body, r"^# [^\n]*", ""))).otherwise(F.concat(F.lit("# "), title, F.lit("\n\n"), body))


def without_fragment(url: Column) -> Column:
    return F.regexp_replace(url, "#.*$", "")


def authority(url: Column) -> Column:
    """Host with port and user, as it stands between // and the next /, ? or #."""
    return F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1)


def url_path(url: Column) -> Column:
    return F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)", 1)


def page_stem(url: Column) -> Column:
    """The last path segment without its extension, or index."""
    last = F.regexp_extract(F.regexp_replace(url_path(url), "/+$", ""), "([^/]*)$", 1)
    stem = F.when(last.rlike(r"^.+\.[^.]+$"), F.regexp_replace(last, r"\.[^.]*$", "")).otherwise(last)
    return F.when(stem == "", "index").otherwise(stem)


def git_location(url: Column) -> Column:
    """(owner, repo, branch, subpath) of a repository URL; null where the path has fewer than two parts."""
    parts = F.filter(F.split(url_path(url), "/"), lambda p: p != "")

    def fields(p: Column) -> Column:
        tree = F.coalesce(F.get(p, F.lit(2)).isin("tree", "blob"), F.lit(False))
        rest = F.when(F.size(p) > 4, F.array_join(F.slice(p, F.lit(5), F.greatest(F.size(p) - 4, F.lit(0))), "/")).otherwise("")
        return F.when(F.size(p) >= 2, F.struct(
            F.get(p, F.lit(0)).alias("owner"), F.regexp_replace(F.get(p, F.lit(1)), r"\.git$", "").alias("repo"),
            F.when(tree, F.coalesce(F.get(p, F.lit(3)), F.lit("main"))).otherwise("main").alias("branch"), F.when(tree, rest).otherwise("").alias("subpath")))

    return let(parts, fields)


def sitemap_locations(xml: Column) -> Column:
    return F.transform(F.xpath(xml, F.lit("//*[local-name()='loc']/text()")), lambda x: F.trim(x))


def sitemap_kind(xml: Column) -> Column:
    return F.when(F.xpath_boolean(xml, F.lit("/*[local-name()='sitemapindex']")), "index").when(F.xpath_boolean(xml, F.lit("/*[local-name()='urlset']")), "urlset").otherwise("unknown")


# --- metadata


def front_matter(fields: dict[str, Column]) -> Column:
    """A block between lines of dashes; fields that are null or empty are left out."""
    lines = [F.when(F.coalesce(v.cast("string"), F.lit("")) != "", F.concat(F.lit(f"{k}: "), v.cast("string"))) for k, v in fields.items()]
    return F.concat(F.lit("---\n"), F.concat_ws("\n", *lines), F.lit("\n---\n"))


def parse_front_matter(text: Column) -> Column:
    """(meta map, body): flat ``key: value`` lines of a leading block; the body is what follows it."""
    block = F.regexp_extract(text, r"(?s)\A---[ \t]*\n(.*?)\n---[ \t]*(?:\n|\z)", 1)
    body = F.regexp_replace(text, r"(?s)\A---[ \t]*\n.*?\n---[ \t]*(?:\n|\z)", "")
    lines = F.filter(F.split(block, "\n"), lambda x: x.rlike(r"^[^:#\s][^:]*:"))
    pairs = F.transform(lines, lambda x: F.struct(F.trim(F.substring_index(x, ":", 1)).alias("key"), F.regexp_replace(F.trim(F.regexp_replace(x, r"^[^:]*:", "")), r"^[\"'](.*)[\"']$", "$1").alias("value")))
    last_wins = F.aggregate(pairs, F.create_map().cast("map<string,string>"), lambda acc, p: F.map_concat(F.map_filter(acc, lambda k, _: k != p["key"]), F.map_from_arrays(F.array(p["key"]), F.array(p["value"]))))
    return F.struct(last_wins.alias("meta"), body.alias("body"))


def merged_title(old: Column, extra: Column) -> Column:
    """``old - extra`` unless there is nothing to add or it is there."""
    return F.when(F.coalesce(old, F.lit("")) == "", extra).when((F.coalesce(extra, F.lit("")) == "") | F.contains(old, extra), old).otherwise(F.concat(old, F.lit(" - "), extra))


def merged_tags(*tags: Column) -> Column:
    """Union of comma-separated tags, order kept, without blanks and repeats."""
    every = F.concat(*(F.split(F.coalesce(t, F.lit("")), ",") for t in tags))
    return F.array_distinct(F.filter(F.transform(every, lambda t: F.trim(t)), lambda t: t != ""))


def merged_metadata(text: Column, title: Column, description: Column, tags: Column) -> Column:
    """(title, description, tags, body): a page's own front matter merged into the run's.

    Its title is added to the run's, its description replaces the run's, and all
    other fields become tags "key=value" after those that are there (given with
    commas, semicolons or bars); commas in values are spaces.
    """

    def merge(parsed: Column) -> Column:
        meta = parsed["meta"]
        of = lambda k: F.coalesce(F.try_element_at(meta, F.lit(k)), F.try_element_at(meta, F.lit(k.capitalize())), F.lit(""))
        others = F.filter(F.map_entries(meta), lambda e: ~F.lower(e["key"]).isin("title", "description") & (e["value"] != ""))
        pairs = F.transform(others, lambda e: F.concat(e["key"], F.lit("="), F.trim(F.replace(e["value"], F.lit(","), F.lit(" ")))))
        given = F.filter(F.transform(F.split(F.coalesce(tags, F.lit("")), "[|;,]"), lambda t: F.trim(t)), lambda t: t != "")
        held = F.split(F.coalesce(title, F.lit("")), " - ")
        named = F.when((of("title") == "") | F.array_contains(held, of("title")), F.coalesce(title, F.lit(""))).when(F.coalesce(title, F.lit("")) == "", of("title")).otherwise(F.concat(title, F.lit(" - "), of("title")))
        said = F.when(of("description") != "", of("description")).otherwise(F.coalesce(description, F.lit("")))
        return F.struct(named.alias("title"), said.alias("description"), F.array_join(F.array_distinct(F.concat(given, pairs)), ", ").alias("tags"), parsed["body"].alias("body"))

    return let(parse_front_matter(F.coalesce(text, F.lit(""))), merge)


# --- report lines and small formats


def tree_line(level: Column, title: Column, tokens: Column) -> Column:
    """A report line: the count to six places, indented by the level, with as many signs as the level."""
    indent = F.repeat(F.lit(" "), F.greatest(2 * (level - 2), F.lit(0)))
    return F.concat(F.lpad(tokens.cast("string"), 6, " "), F.lit("  "), indent, F.repeat(F.lit("#"), level), F.lit(" "), title)


def human_size(n: Column) -> Column:
    out = F.concat(F.round(n / F.lit(1024.0**3), 1).cast("string"), F.lit(" GB"))
    for power, name in ((2, "MB"), (1, "KB")):
        out = F.when(n < 1024 ** (power + 1), F.concat(F.round(n / F.lit(1024.0**power), 1).cast("string"), F.lit(f" {name}"))).otherwise(out)
    return F.when(n < 1024, F.concat(n.cast("string"), F.lit(" B"))).otherwise(out)


def csv_field(value: Column) -> Column:
    """Quoted if it holds a comma, quote or newline; quotes are doubled."""
    return F.when(value.rlike('[,"\n\r]'), F.concat(F.lit('"'), F.replace(value, F.lit('"'), F.lit('""')), F.lit('"'))).otherwise(value)


def safe_int(value: Column) -> Column:
    return F.trim(value.cast("string")).try_cast("int")


def title_key(title: Column) -> Column:
    """A heading's key for matching: leading numbering goes, lower case, whatever is no letter or digit is one space."""
    bare = F.regexp_replace(F.trim(title), r"(?i)^(?:(?:chapter|section|appendix)\s+)?(?:\d+(?:\.\d+)*[.):]?|[A-Za-z][.):]|[IVXLC]+[.):])\s+", "")
    return F.trim(F.regexp_replace(F.lower(bare), r"[^\p{L}\p{N}]+", " "))
