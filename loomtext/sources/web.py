"""Web sources: HTML to text and links, search pages, feeds, listings, and bounded crawls over link tables."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from loomtext.functions import lexicons as L
from loomtext.functions.udf import arrow_udf
from loomtext.operators.extract import clean_lines, links
from loomtext.operators.filters import case_url
from loomtext.operators.graph import reachable
from loomtext.operators.rank import keep_first
from loomtext.sources.limits import RateLimiter, with_retries
from loomtext.sources.scratch import durable as written

#: Elements whose text is page furniture.
SKIPPED = ("script", "style", "nav", "footer", "aside")
VOID = ("br", "img", "meta", "link", "input", "hr", "source", "area", "base", "col", "embed", "track", "wbr")


def _parse(html: str | None, skipped: tuple[str, ...], main: tuple[str, ...]) -> tuple[str, str]:
    """(title, text): text of the first main element that occurs, else of the page."""
    from html.parser import HTMLParser

    class Reader(HTMLParser):
        def __init__(self) -> None:
            super().__init__(convert_charrefs=True)
            self.open: list[str] = []
            self.page: list[str] = []
            self.inside: dict[str, list[str]] = {}
            self.titles: dict[str, list[str]] = {"h1": [], "title": []}

        def handle_starttag(self, tag, attrs):
            if tag not in VOID:
                self.open.append(tag)

        def handle_endtag(self, tag):
            if tag in self.open:
                while self.open.pop() != tag:
                    pass

        def handle_data(self, data):
            data = data.strip()
            if not data:
                return
            for t in self.titles:
                if t in self.open:
                    self.titles[t].append(data)
            if any(t in self.open for t in skipped) or "title" in self.open:
                return
            self.page.append(data)
            for t in main:
                if t in self.open:
                    self.inside.setdefault(t, []).append(data)

    r = Reader()
    r.feed(html or "")
    body = next((r.inside[t] for t in main if r.inside.get(t)), r.page)
    title = " ".join(r.titles["h1"] or r.titles["title"])
    return title, "\n".join(body)


@arrow_udf("struct<title:string,text:string>")
def page_content(htmls: pd.Series) -> pd.DataFrame:
    """Title (h1, else title) and main text without page furniture."""
    rows = [_parse(h, SKIPPED, ("main", "article", "section")) for h in htmls]
    return pd.DataFrame(rows, columns=["title", "text"])


@arrow_udf("string")
def html_text(htmls: pd.Series) -> pd.Series:
    """All text outside scripts and styles, by line feeds."""
    return htmls.map(lambda h: _parse(h, ("script", "style"), ())[1])


def content_type(url: Column, title: Column) -> Column:
    """By path; a form by title."""
    path = F.coalesce(F.try_parse_url(url, F.lit("PATH")), F.lit(""))
    return (
        F.when(F.contains(path, F.lit("/guidance/")), "guidance").when(F.contains(path, F.lit("-manuals/")), "manual")
        .when(F.contains(path, F.lit("/publications/")), "publication").when(F.contains(F.lower(title), F.lit("form")), "form").otherwise("page")
    )


def pages(df: DataFrame) -> DataFrame:
    """page_id, url, html in; host, title, content, content_type out."""
    read = df.select("page_id", "url", page_content("html").alias("p"))
    return read.select("page_id", "url", F.try_parse_url("url", F.lit("HOST")).alias("host"), F.col("p")["title"].alias("title"), F.col("p")["text"].alias("content"), content_type(F.col("url"), F.col("p")["title"]).alias("content_type"))


def case_page(df: DataFrame) -> DataFrame:
    """url, html in; title (first line), content and summary (lines two to five) out."""
    text = df.select("url", html_text("html").alias("content")).withColumn("_l", F.split("content", "\n"))
    return text.select("url", F.get("_l", 0).alias("title"), F.trim("content").alias("content"), F.array_join(F.slice("_l", 2, 4), " ").alias("summary"))


def link_table(df: DataFrame) -> DataFrame:
    """(page_id, seq, href) of all anchors."""
    return df.select("page_id", F.posexplode(links(F.col("html"))).alias("seq", "href"))


def discovered(df: DataFrame, *, prefix: str, title_terms: list[str], title: str = "title", link: str = "link") -> DataFrame:
    """Distinct links with a prefix and a title that has one of the terms."""
    low = F.lower(F.col(title))
    hit = F.exists(F.array(*[F.lit(t) for t in title_terms]), lambda t: F.contains(low, t))
    return df.where(F.startswith(F.col(link), F.lit(prefix)) & hit).select(F.col(link).alias("link")).distinct()


def feed_links(df: DataFrame, xml: str = "xml") -> DataFrame:
    """Alternate links of Atom entries."""
    plain = F.regexp_replace(F.col(xml), r'xmlns="[^"]*"', "")
    return df.select(F.explode(F.xpath(plain, F.lit("//entry/link[@rel='alternate']/@href"))).alias("url")).distinct()


def document_properties(df: DataFrame, *, xml: str = "xml", url: str = "url") -> DataFrame:
    """Title and type of a legislation file; type, year and number from the address win."""
    path = F.split(F.try_parse_url(F.col(url), F.lit("PATH")), "/")
    named = lambda n: F.nullif(F.xpath_string(F.col(xml), F.lit(f"//*[local-name()='{n}']")), F.lit(""))
    return df.select(F.col(url), named("title").alias("title"), F.coalesce(F.get(path, 1), named("type")).alias("type"), F.get(path, 2).alias("year"), F.get(path, 3).alias("number"))


def listing_items(df: DataFrame, *, kind: str = "type", year: str = "year", html: str = "html") -> DataFrame:
    """Items of year pages: links that name the type and year, once a page: id ``type_year_number``."""
    href = df.select(kind, year, F.posexplode(links(F.col(html))).alias("seq", "href"))
    fits = href.where(F.contains("href", F.concat(F.lit("/"), F.col(kind), F.lit("/"))) & F.contains("href", F.concat(F.lit("/"), F.col(year).cast("string"), F.lit("/"))))
    number = F.regexp_extract("href", r"/(\d+)(?:/|$)", 1)
    last = F.regexp_extract("href", r"/\d{4}/(\d+)", 1)
    named = fits.withColumn("number", F.when(last != "", last).otherwise(number)).where("number <> ''")
    out = named.withColumn("id", F.concat_ws("_", F.col(kind), F.col(year).cast("string"), "number"))
    return keep_first(out.select("id", F.col(kind), F.col(year), "number", "href", "seq"), "id", "seq")


def search_items(df: DataFrame, *, base: str, html: str = "html") -> DataFrame:
    """Results of a search page by their links: id ``search_{type}_{year}``, type and url, the first of each url."""
    href = df.select(F.posexplode(links(F.col(html))).alias("seq", "href"))
    parts = F.split(F.regexp_replace("href", "^/+|/+$", ""), "/")
    named = href.select("seq", "href", parts.alias("p")).where((F.size("p") >= 2) & F.startswith("href", F.lit("/uk")))
    url = F.concat(F.lit(base.rstrip("/")), "href")
    found = named.select(F.concat_ws("_", F.lit("search"), F.get("p", 0), F.get("p", 1)).alias("id"), F.get("p", 0).alias("type"), url.alias("url"), "seq")
    return keep_first(found, "url", "seq").drop("seq")


def case_databases(spark: SparkSession, paths: list[str] | tuple[str, ...]) -> DataFrame:
    """Seeds of a crawl: one row (id) for each database path."""
    return spark.createDataFrame([(p,) for p in paths], "id string")


def crawl_databases(link_pairs: DataFrame, paths: tuple[str, ...] = L.CASE_DATABASES, *, max_depth: int = 3, durable=None) -> DataFrame:
    """Case addresses within ``max_depth`` links of any of the databases; case pages are leaves."""
    seeds = case_databases(link_pairs.sparkSession, paths)
    met = crawl(link_pairs, seeds, max_depth=max_depth, is_leaf=case_url(F.col("src"), list(paths)), durable=durable)
    return met.where(case_url(F.col("id"), list(paths))).select(F.col("id").alias("url"), "depth")


def seed_items(spark: SparkSession, base: str, acts=L.HOUSING_ACTS_BY_NUMBER) -> DataFrame:
    """(id, type, year, number, url) of fixed acts and instruments."""
    rows = spark.createDataFrame(list(acts), "type string, year int, number int")
    at = F.concat_ws("/", F.lit(base.rstrip("/")), "type", F.col("year").cast("string"), F.col("number").cast("string"))
    return rows.select(F.concat_ws("_", "type", F.col("year").cast("string"), F.col("number").cast("string")).alias("id"), "type", "year", "number", at.alias("url"))


def court_searches(spark: SparkSession, courts: list[str], terms=L.HOUSING_SEARCH_TERMS) -> DataFrame:
    """One search (court, term) for each pair."""
    return spark.createDataFrame([(c,) for c in courts], "court string").crossJoin(spark.createDataFrame([(t,) for t in terms], "term string"))


def api_or_search(api: DataFrame, fallback: DataFrame) -> DataFrame:
    """What the listing gave, or the keyword search's rows where it gave nothing."""
    empty = api.limit(1).agg((F.count("*") == 0).alias("none"))
    return api.unionByName(fallback.join(F.broadcast(empty.where("none")), how="cross").drop("none"))  # a table of one row or none


#: (format, what is added to an item's address) of item downloads.
ITEM_FORMATS = (("xml", "/data.xml"), ("html", ""))


def download_items(
    items: DataFrame, fetch, *, formats=ITEM_FORMATS, calls: int = 0, per_seconds: float = 60.0, gap: float = 0.0, tries: int = 3, pause: float = 1.0, durable=None
) -> DataFrame:
    """(id, format, content) of items (id, url): what an injected ``fetch(url) -> (status, text)`` gives with status 200,
    the text of the page, and a metadata record of what is there. Items without an address, or of which nothing is there, give none.

    What is fetched is written once, when the function is called, and everything else is worked out from that, so each
    address is asked once for each format. A task makes at most ``calls`` calls in ``per_seconds`` (0: no limit) with
    ``gap`` seconds between them, and asks again after an OSError, ``tries`` times in all; then the task fails.
    """
    asked = items.where(F.coalesce("url", F.lit("")) != "").select(
        "id", "url", F.explode(F.array(*[F.struct(F.lit(f).alias("format"), F.concat("url", F.lit(tail)).alias("address")) for f, tail in formats])).alias("f")
    ).select("id", "url", "f.*")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        limiter = RateLimiter(calls, per_seconds, gap) if calls else None

        def ask(address: str):
            if limiter:
                limiter.wait()
            return with_retries(lambda: fetch(address), tries=tries, pause=pause)

        for b in batches:
            got = [ask(a) for a in b["address"]]
            kept = b.assign(content=[text if status == 200 else None for status, text in got]).dropna(subset=["content"])
            yield kept[["id", "url", "format", "content"]]

    found = asked.mapInPandas(run, f"id {items.schema['id'].dataType.simpleString()}, url string, format string, content string")
    found = (durable or written(items.sparkSession))(found)
    texts = found.where("format = 'html'").withColumn("format", F.lit("text")).withColumn("content", clean_lines(html_text("content")))
    both = found.unionByName(texts)
    records = both.groupBy("id", "url").agg(F.sort_array(F.collect_set("format")).alias("formats"))
    about = records.select("id", "url", F.lit("metadata").alias("format"), F.to_json(F.struct("id", "url", "formats")).alias("content"))
    return both.unionByName(about).select("id", "format", "content")


def merged_discovery(*found: DataFrame) -> DataFrame:
    """Several discoveries (url, ...) in order, one row for each url, the first kept."""
    out = None
    for n, df in enumerate(found):
        one = df.withColumn("_seq", F.struct(F.lit(n).alias("n"), F.col("url").alias("u")))
        out = one if out is None else out.unionByName(one, allowMissingColumns=True)
    return keep_first(out, "url", "_seq").drop("_seq")


def requests(kinds: list[str], first_year: int, last_year: int, spark: SparkSession) -> DataFrame:
    """One row for each kind and year to be listed."""
    return spark.createDataFrame([(k,) for k in kinds], "type string").select("type", F.explode(F.sequence(F.lit(first_year), F.lit(last_year))).alias("year"))


def searches(categories: list[str], terms: list[str], spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(c, t) for c in categories for t in terms], "category string, term string")


def crawl(link_pairs: DataFrame, seeds: DataFrame, *, max_depth: int = 3, is_leaf: Column | None = None, durable=None) -> DataFrame:
    """Pages within ``max_depth`` links of the seeds; pages that ``is_leaf`` (on column src) are not followed."""
    followed = link_pairs if is_leaf is None else link_pairs.where(~is_leaf)
    return reachable(followed, seeds, max_depth=max_depth, durable=durable)


def capped_per_court(cases: DataFrame, n: int, *, first_court: str, seq: str = "seq") -> DataFrame:
    """At most n cases of the first court and n // 4 of each other (0: all); then one row for each url."""
    from pyspark.sql import Window as W

    if n:
        rank = F.row_number().over(W.partitionBy("court").orderBy(seq))
        cap = F.when(F.col("court") == first_court, n).otherwise(n // 4)
        cases = cases.withColumn("_n", rank).where(F.col("_n") <= cap).drop("_n")
    return keep_first(cases, "url", seq)


def api_first(api: Column, html: Column) -> Column:
    return F.coalesce(api, html)


class SearchPages(DataSource):
    """A paginated search as a table: ``spark.dataSource.register(SearchPages.with_fetch(fn))``, then
    ``spark.read.format("search_pages").option("pages", 50).load()``. ``fetch(start, count)`` returns a list of
    (title, link, description, format); an empty page ends a range, and an OSError is tried again, ``tries`` times in all
    with growing pauses from ``pause`` seconds on, and then fails the task. One partition reads one range."""

    fetch: Callable[[int, int], list[tuple]] | None = None

    @classmethod
    def with_fetch(cls, fetch: Callable[[int, int], list[tuple]]) -> type:
        return type("BoundSearchPages", (cls,), {"fetch": staticmethod(fetch)})

    @classmethod
    def name(cls) -> str:
        return "search_pages"

    def schema(self) -> str:
        return "title string, link string, description string, format string"

    def reader(self, schema) -> DataSourceReader:
        return _SearchReader(type(self).fetch, int(self.options.get("pages", 10)), int(self.options.get("count", 100)), int(self.options.get("partitions", 4)), int(self.options.get("tries", 3)), float(self.options.get("pause", 1.0)))


class _Range(InputPartition):
    def __init__(self, first: int, last: int):
        super().__init__((first, last))
        self.first, self.last = first, last


class _SearchReader(DataSourceReader):
    def __init__(self, fetch, pages: int, count: int, partitions: int, tries: int, pause: float):
        self.fetch, self.pages, self.count, self.n, self.tries, self.pause = fetch, pages, count, partitions, tries, pause

    def partitions(self):
        step = max(1, -(-self.pages // self.n))
        return [_Range(a, min(a + step, self.pages)) for a in range(0, self.pages, step)]

    def read(self, partition: _Range) -> Iterator[tuple]:
        for page in range(partition.first, partition.last):
            rows = with_retries(lambda at=page * self.count: self.fetch(at, self.count), tries=self.tries, pause=self.pause)
            if not rows:
                return
            yield from rows
