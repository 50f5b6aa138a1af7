"""Jobs over fetched pages."""

from __future__ import annotations

from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gazette.functions.text import falsy
from gazette.operators.filters import url_class

#: Tags whose content isn't text, tags around a page's frame, and tags that hold blocks.
SILENT, FRAME, BLOCKS = {"script", "style", "noscript", "iframe", "form"}, {"header", "nav", "footer", "aside"}, {"article", "main", "section", "div"}


def absolute(base: Column, href: Column) -> Column:
    scheme, host = F.coalesce(F.try_parse_url(base, F.lit("PROTOCOL")), F.lit("https")), F.coalesce(F.try_parse_url(base, F.lit("HOST")), F.lit(""))
    return F.when(href.rlike("^[a-zA-Z][a-zA-Z0-9+.-]*:"), href).when(href.startswith("//"), F.concat(scheme, F.lit(":"), href)).when(href.startswith("/"), F.concat(scheme, F.lit("://"), host, href)).otherwise(F.concat(F.regexp_replace(F.regexp_replace(base, "[?#].*$", ""), "(?<=[^/:])/[^/]*$", ""), F.lit("/"), href))


def canonical(html: Column, base: Column) -> Column:
    """link rel=canonical, else og:url, else meta refresh; made absolute."""
    found = F.coalesce(
        falsy(F.regexp_extract(html, r"""(?i)<link[^>]*rel=["']canonical["'][^>]*href=["']([^"']+)""", 1)),
        falsy(F.regexp_extract(html, r"""(?i)<meta[^>]*property=["']og:url["'][^>]*content=["']([^"']+)""", 1)),
        falsy(F.regexp_extract(html, r"""(?i)<meta[^>]*http-equiv=["']refresh["'][^>]*url=([^"'>\s]+)""", 1)),
    )
    return F.when(found.isNotNull(), absolute(base, found))


def outlinks(pages: DataFrame, most: int = 20) -> DataFrame:
    """(page_id, pos, url): a page's first `most` different links that look like articles; anchors first, then bare urls."""
    hrefs = F.transform(F.regexp_extract_all("html", F.lit(r"""(?i)<a\b[^>]*href=["']([^"'#]+)"""), F.lit(1)), lambda h: absolute(F.col("url"), h))
    bare = F.regexp_extract_all("html", F.lit(r"""(https?://[^\s"'<>]+)"""), F.lit(1))
    df = pages.select("page_id", F.posexplode(F.array_distinct(F.concat(hrefs, bare))).alias("at", "url")).where(url_class(F.col("url")) == "article")
    return df.withColumn("pos", F.row_number().over(Window.partitionBy("page_id").orderBy("at"))).where(F.col("pos") <= most).select("page_id", "pos", "url")


def redirect_target(hops: Column, final: Column) -> Column:
    return F.coalesce(F.get(F.filter(hops, lambda u: url_class(u) == "article"), F.lit(0)), final)


class _Blocks(HTMLParser):
    """Text and link characters of each block; what stands in the frame or in silent tags is left out."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.open: list[tuple[str, list]] = []
        self.found: list[list] = []
        self.body: list[str] = []
        self.muted = self.link = 0

    def handle_starttag(self, tag, attrs):
        self.muted += tag in SILENT or tag in FRAME
        self.link += tag == "a"
        if tag in BLOCKS:
            block = [tag, [], 0]
            self.found.append(block)
            self.open.append((tag, block))

    def handle_endtag(self, tag):
        if tag in SILENT or tag in FRAME:
            self.muted = max(0, self.muted - 1)
        if tag == "a":
            self.link = max(0, self.link - 1)
        if tag in BLOCKS:
            for k in range(len(self.open) - 1, -1, -1):
                if self.open[k][0] == tag:
                    del self.open[k:]
                    break

    def handle_data(self, data):
        if not self.muted:
            self.body.append(data)
            for _, block in self.open:
                block[1].append(data)
                block[2] += len(data.strip()) if self.link else 0


def blocks(pages: DataFrame) -> DataFrame:
    """(page_id, pos, tag, text, link_chars): one row per block; pos -1 is the whole body."""

    def run(batches):
        for batch in batches:
            out = []
            for page, html in zip(batch.column("page_id").to_pylist(), batch.column("html").to_pylist()):
                parser = _Blocks()
                parser.feed(html or "")
                parser.close()
                out.append((page, -1, "body", " ".join(" ".join(parser.body).split()), 0))
                out += [(page, k, tag, " ".join(" ".join(text).split()), links) for k, (tag, text, links) in enumerate(parser.found)]
            columns = list(zip(*out)) or [()] * 5
            kinds = (pa.int64(), pa.int32(), pa.string(), pa.string(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], ["page_id", "pos", "tag", "text", "link_chars"])

    return pages.select("page_id", "html").mapInArrow(run, "page_id long, pos int, tag string, text string, link_chars long")


def block_score(text: Column, link_chars: Column) -> Column:
    """ln(length) + min(0.8, 50 * punctuation per character) - 3.5 * link share, 2 less beyond 0.35; -1 under 120 characters."""
    n = F.length(text)
    some = F.greatest(n, F.lit(1))
    marks = F.regexp_count(text, F.lit("[.,!?;:。]")) / some
    share = link_chars / some
    return F.when(n < 120, -1.0).otherwise(F.log(some.cast("double")) + F.least(F.lit(0.8), 50 * marks) - 3.5 * share - F.when(share > 0.35, 2.0).otherwise(0.0))


def main_text(pages: DataFrame, most: int = 12_000) -> DataFrame:
    """(page_id, extractor, body): the best positive block, else the whole body; the extractor cuts at `most` characters."""
    scored = blocks(pages).withColumn("score", block_score(F.col("text"), F.col("link_chars")))
    best = scored.groupBy("page_id").agg(F.max_by(F.when((F.col("pos") >= 0) & (F.col("score") > 0), F.struct("text")), F.when((F.col("pos") >= 0) & (F.col("score") > 0), F.struct("score", -F.col("pos")))).alias("b"), F.max(F.when(F.col("pos") == -1, F.col("text"))).alias("whole"))
    body = F.coalesce("b.text", "whole")
    return best.select("page_id", F.when(F.length(body) >= 50, "heuristic").otherwise("none").alias("extractor"), F.substring(body, 1, most).alias("body"))


def page_bodies(pages: DataFrame) -> DataFrame:
    """One row per url: body and meta(requested_url, final_url, status, html_len, extractor, notes)."""
    one = pages.dropDuplicates(["url"])
    text = main_text(one)
    final = F.coalesce(canonical(F.col("html"), F.col("url")), F.col("url"))
    meta = F.struct(F.col("url").alias("requested_url"), final.alias("final_url"), F.lit(200).alias("status"), F.length("html").alias("html_len"), "extractor", F.array_compact(F.array(F.when(final != F.col("url"), "canonical"), F.when(F.col("extractor") == "none", "no_text"))).alias("notes"))
    return one.join(text, "page_id").select("url", "body", meta.alias("meta"))
