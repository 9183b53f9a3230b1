"""Documents from HTML and bytes: index links, text, character sets."""

from __future__ import annotations

import codecs
import re
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


#: Byte order marks and what they announce.
MARKS = {codecs.BOM_UTF8: "utf-8", codecs.BOM_UTF16_LE: "utf-16-le", codecs.BOM_UTF16_BE: "utf-16-be"}


def _fitting(data: bytes, encoding: str | None) -> str | None:
    """The text if the encoding is known and every byte fits it, else None."""
    try:
        return codecs.decode(data, encoding) if encoding else None
    except (LookupError, ValueError, TypeError):
        return None


def decoded_bytes(data: bytes | None, declared: str | None = None) -> str | None:
    """Bytes as text: by byte order mark, else the declared character set if the bytes fit it, else UTF-8, else windows-1252.

    Bytes that windows-1252 does not have become replacement characters. None for None.
    """
    if data is None:
        return None
    mark = next(filter(data.startswith, MARKS), b"")
    body = data.removeprefix(mark)
    fits = [t for t in (_fitting(body, e) for e in ([MARKS[mark]] if mark else [declared, "utf-8"])) if t is not None]
    return fits[0] if fits else body.decode(MARKS.get(mark, "windows-1252"), "replace")


class _Index(HTMLParser):
    """Links with the last bold heading before each."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.section, self.links, self._bold, self._href, self._said = None, [], False, None, []

    def handle_starttag(self, tag, attrs):
        if tag == "b":
            self._bold, self._said = True, []
        elif tag == "a" and (href := dict(attrs).get("href")):
            self._href, self._said = href, []

    def handle_data(self, data):
        if self._bold or self._href:
            self._said.append(data)

    def handle_endtag(self, tag):
        said = " ".join("".join(self._said).split())
        if tag == "b" and self._bold:
            self._bold, self.section = False, said or self.section
        elif tag == "a" and self._href:
            self.links.append((self._href, said, self.section))
            self._href = None


class _Text(HTMLParser):
    """The text of a page, a line a block, without scripts and styles."""

    BLOCKS = frozenset("p div br li ul ol table tr h1 h2 h3 h4 h5 h6 section article header footer blockquote pre".split())

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.parts, self._hidden = [], 0

    def handle_starttag(self, tag, attrs):
        self._hidden += tag in ("script", "style")
        if tag in self.BLOCKS:
            self.parts.append("\n")

    def handle_endtag(self, tag):
        self._hidden -= tag in ("script", "style") and self._hidden > 0
        if tag in self.BLOCKS:
            self.parts.append("\n")

    def handle_data(self, data):
        if not self._hidden:
            self.parts.append(data)


def page_links(html: str | None) -> list[tuple[str, str, str | None]]:
    """(url, title, section) of the links of an index page, in order."""
    p = _Index()
    p.feed(html or "")
    p.close()
    return p.links


def page_text(html: str | None) -> str:
    """The readable lines of a page."""
    p = _Text()
    p.feed(html or "")
    p.close()
    lines = (" ".join(line.split()) for line in "".join(p.parts).split("\n"))
    return "\n".join(line for line in lines if line)


def html_links(pages: DataFrame, key: str, html: str) -> DataFrame:
    """(key, place, url, title, section) of all links of pages; null and empty pages have none."""
    kind = pages.schema[key].dataType.simpleString()

    def run(batches):
        for b in batches:
            rows = [(k, i, *link) for k, h in zip(b[key], b[html]) for i, link in enumerate(page_links(h))]
            yield pd.DataFrame(rows, columns=[key, "place", "url", "title", "section"])

    return pages.select(key, html).mapInPandas(run, f"`{key}` {kind}, place int, url string, title string, section string")


def linked_documents(links: DataFrame, organs: dict[str, str], by_url: dict[str, str], skip: str) -> DataFrame:
    """(url, title, organ): the documents that index links lead to, the first link of each url.

    The organ is that of the heading above the link; an unknown heading gives its own slug; a link under none (of a menu) has the organ of the first part of
    ``by_url`` that its url holds, or drops out. Links whose title begins with ``skip`` drop out.
    """
    heading = F.lower("section")
    known = F.coalesce(*[F.when(heading == h.lower(), o) for h, o in organs.items()])
    slug = F.trim(F.regexp_replace(heading, r"[^\p{L}\p{N}_]+", "-"), F.lit("-"))
    menu = F.coalesce(*[F.when(F.col("url").contains(part), o) for part, o in by_url.items()])
    organ = F.when(F.col("section").isNull(), menu).otherwise(F.coalesce(known, slug))
    rows = links.where(~F.col("title").startswith(skip)).withColumn("organ", organ).where("organ is not null")
    return rows.groupBy("url").agg(F.min(F.struct("place", "title", "organ")).alias("x")).select("url", "x.title", "x.organ")


def html_texts(pages: DataFrame, key: str, content: str, declared: str | None = None) -> DataFrame:
    """(key, text) of pages given as bytes or text; ``declared`` names a column with the character set that came with each."""
    kind = pages.schema[key].dataType.simpleString()
    keep = [key, content, *([declared] if declared else [])]

    def run(batches):
        for b in batches:
            sets = b[declared] if declared else [None] * len(b)
            texts = [page_text(c if isinstance(c, str) else decoded_bytes(None if c is None else bytes(c), s)) for c, s in zip(b[content], sets)]
            yield pd.DataFrame({key: b[key], "text": texts})

    return pages.select(*keep).mapInPandas(run, f"`{key}` {kind}, text string")


def synced(linked: DataFrame, local: DataFrame, key: str = "name") -> DataFrame:
    """What is linked and what is only kept locally, names compared without case, the first of the links of one name: (key, source, fresh).

    ``linked`` has key, ``place`` and ``size``; ``local`` key and ``size``. ``fresh`` tells that the local copy has the linked size.
    """
    a = linked.groupBy(F.lower(key).alias("_l")).agg(F.min(F.struct("place", F.col(key).alias("n"), "size")).alias("a"))
    b = local.groupBy(F.lower(key).alias("_l")).agg(F.min(F.struct(F.col(key).alias("n"), "size")).alias("b"))
    j = a.join(b, "_l", "full")
    source = F.when(F.col("a").isNull(), "local").when(F.col("b").isNull(), "linked").otherwise("both")
    return j.select(F.coalesce("a.n", "b.n").alias(key), source.alias("source"), (F.col("a.size").eqNullSafe(F.col("b.size")) & F.col("a").isNotNull()).alias("fresh"))


def page_words(df: DataFrame, key: str, text: str) -> DataFrame:
    """(key, pos, word, start, page): every word of a text with its place among the words, its first character and its page.

    Pages begin at marks of the form [Side n], which are no words themselves; words before the first mark have no page.
    """
    kind = df.schema[key].dataType.simpleString()
    mark, word = re.compile(r"\[Side (\d+)\]"), re.compile(r"\w+")

    def run(batches):
        for b in batches:
            rows = []
            for k, t in zip(b[key], b[text]):
                if t is None:
                    continue
                marks = [(m.start(), m.end(), int(m[1])) for m in mark.finditer(t)]
                at, page, pos = 0, None, 0
                for m in word.finditer(t):
                    while at < len(marks) and marks[at][1] <= m.start():
                        page, at = marks[at][2], at + 1
                    if at < len(marks) and marks[at][0] <= m.start() < marks[at][1]:
                        continue
                    rows.append((k, pos, m[0].lower(), m.start(), page))
                    pos += 1
            yield pd.DataFrame(rows, columns=[key, "pos", "word", "start", "page"]).astype({"page": "Int64"})

    return df.select(key, text).mapInPandas(run, f"`{key}` {kind}, pos int, word string, start int, page int")
