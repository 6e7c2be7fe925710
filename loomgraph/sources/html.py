"""Web pages to links and text sections.

Spark has no HTML parser, so pages go through the standard library's parser in Arrow batches. An element's text
includes that of its descendants, so nested matches repeat text; the container, link rule and excluded classes are
parameters whose defaults are a tutorial site's.
"""

from __future__ import annotations

from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loomgraph.functions import text as T

TEXT_TAGS = frozenset(("p", "h1", "h2", "h3", "h4", "li", "div"))
CODE_TAGS = frozenset(("pre", "code"))
SKIPPED_CLASSES = frozenset(("tryit", "w3-btn", "w3-bar"))
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
BATCH_CHARS = 1 << 20  # of texts, above which a batch goes out
SCRAPED = "page_pos long, url string, title string, text_content array<string>, code_examples array<string>, error string"


class Sections(HTMLParser):
    """Texts of wanted elements inside the first container, in document order."""

    def __init__(self, container: tuple[str, str | None]):
        super().__init__(convert_charrefs=True)
        self.container, self.stack, self.inside, self.seen = container, [], 0, False
        self.elements: list[tuple[str, list[str]]] = []

    def handle_starttag(self, tag, attrs):
        if tag in VOID:
            return
        a = dict(attrs)
        opens = not self.seen and tag == self.container[0] and self.container[1] in (None, a.get("id"))
        parts = None
        if self.inside and (tag in CODE_TAGS or tag in TEXT_TAGS and (a.get("class") or "") not in SKIPPED_CLASSES):
            parts = []
            self.elements.append((tag, parts))
        if opens:
            self.seen, self.inside = True, 1
        self.stack.append((tag, parts, opens))

    def handle_endtag(self, tag):
        if not any(x[0] == tag for x in self.stack):
            return
        while self.stack:
            name, _, opens = self.stack.pop()
            if opens:
                self.inside = 0
            if name == tag:
                return

    def handle_data(self, data):
        for _, parts, _ in self.stack:
            if parts is not None:
                parts.append(data)


def sections(html: str | None, container: tuple[str, str | None] = ("div", "main")) -> tuple[list[str], list[str], str | None]:
    """Texts of more than 10 and codes of more than 20 characters, or an error."""
    try:
        p = Sections(container)
        p.feed(html or "")
        p.close()
    except Exception as e:  # one bad page is a row, not a failed job
        return [], [], str(e)
    if not p.seen:
        return [], [], "No main content found"
    whole = [(tag, "".join(parts).strip()) for tag, parts in p.elements]
    return [t for tag, t in whole if tag in TEXT_TAGS and len(t) > 10], [t for tag, t in whole if tag in CODE_TAGS and len(t) > 20], None


def scraped(batches, container: tuple[str, str | None]):
    """Arrow batches (page_pos, url, title, html) -> batches of SCRAPED, of BATCH_CHARS and one page at most: a batch of pages can have texts of many times its size."""
    for b in batches:
        rows, size = [], 0
        for i, x in enumerate(b.column(3), 1):
            rows.append(sections(x.as_py(), container))
            size += sum(len(t) for texts in rows[-1][:2] for t in texts)
            if size < BATCH_CHARS and i < b.num_rows:
                continue
            yield pa.RecordBatch.from_arrays(
                [
                    *(b.column(k).slice(i - len(rows), len(rows)) for k in range(3)),
                    *(pa.array([r[k] for r in rows], kind) for k, kind in enumerate((pa.list_(pa.string()), pa.list_(pa.string()), pa.string()))),
                ],
                names=["page_pos", "url", "title", "text_content", "code_examples", "error"],
            )
            rows, size = [], 0


def scrape(pages: DataFrame, container: tuple[str, str | None] = ("div", "main")) -> DataFrame:
    """pages (page_id, url, html) -> one row a page with its sections or error."""

    def run(batches):
        yield from scraped(batches, container)

    title = F.nullif(T.strip(F.regexp_extract("html", r"(?is)<title[^>]*>(.*?)</title>", 1)), F.lit(""))
    return pages.select(F.col("page_id").alias("page_pos"), "url", title.alias("title"), "html").mapInArrow(run, SCRAPED)


def last_per_url(scraped: DataFrame) -> DataFrame:
    """Of pages with one url the last stays, as a corpus keyed by url would have it; one aggregate."""
    return scraped.groupBy("url").agg(F.max_by(F.struct(*scraped.columns), "page_pos").alias("last")).select("last.*")


def links(pages: DataFrame, base: str = "", starts: str = "java_", ends: str = ".asp") -> DataFrame:
    """url, title, filename of wanted links; of equal urls the first stays."""
    found = F.arrays_zip(
        *(F.regexp_extract_all("html", F.lit(r'(?is)<a\b[^>]*?href="([^"]*)"[^>]*>(.*?)</a>'), F.lit(k)).alias(n) for k, n in ((1, "href"), (2, "label")))
    )
    rows = pages.select("page_id", F.posexplode(found).alias("n", "a")).where(F.col("a.href").startswith(starts) & F.col("a.href").endswith(ends))
    rows = rows.select("page_id", "n", F.concat(F.lit(base), "a.href").alias("url"), T.strip(F.col("a.label")).alias("title"), F.col("a.href").alias("filename"))
    w = Window.partitionBy("url").orderBy("page_id", "n")
    return rows.withColumn("_n", F.row_number().over(w)).where("_n = 1").select("url", "title", "filename")
