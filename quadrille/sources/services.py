"""Paged services and workbooks as Spark data sources."""

from __future__ import annotations

import io
import itertools
import re
import time
import urllib.error
import urllib.parse
import urllib.request
import zipfile
import xml.etree.ElementTree as ET
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

_MAIN = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
_REL = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}"


#: Answers that may be better later: time-outs, too many requests, trouble of the server. Others are final.
PASSING = frozenset([408, 425, 429, *range(500, 600)])


def fetch(url: str, spacing: float = 0.125, retries: int = 10, wait: float = 4.0, get: Callable[[str], str] | None = None, body: str | None = None) -> str:
    """The answer of a URL, no sooner than ``spacing`` seconds later; with ``body`` it is sent there (POST). A failure that may pass is tried again after 2, then ``wait`` seconds; others, such as 404, are raised at once."""
    time.sleep(spacing)
    for attempt in range(retries + 1):
        try:
            return get(url) if get else urllib.request.urlopen(url, None if body is None else body.encode(), timeout=60).read().decode()
        except (urllib.error.URLError, TimeoutError) as e:
            if attempt == retries or isinstance(e, urllib.error.HTTPError) and e.code not in PASSING:
                raise
            time.sleep(wait if attempt else 2.0)
    raise AssertionError("unreachable")


def next_token(token: str, step: int) -> str | None:
    """The token after one of the form 'id!cursor!...', ``step`` records further; none for others."""
    head, cursor, *rest = [*token.split("!"), ""]
    return "!".join([head, str(int(cursor) + step), *rest[:-1]]) if cursor.isdigit() else None


def token_pages(url: str, token_url: str, pattern: str, step: int = 0, limit: int | None = None, get: Callable[[str], str] | None = None, **how) -> Iterator[tuple[int, str | None, str | None]]:
    """(page, token, body) of a service whose pages name the next one's token, in the first group of ``pattern``; it goes to '{token}' of ``token_url``.

    A page that can't be read has no body; with ``step`` the token after it is guessed (:func:`next_token`), else the pages end there with the error. ``limit`` ends after so many pages.
    """
    token: str | None = None
    for page in itertools.count():
        if limit is not None and page >= limit:
            return
        try:
            body = fetch(url if token is None else token_url.replace("{token}", urllib.parse.quote(token)), get=get, **how)
        except OSError:
            after = next_token(token, step) if token and step else None
            if after is None:
                raise
            yield page, token, None
            token = after
            continue
        yield page, token, body
        found = re.search(pattern, body)
        if not found or not found[1].strip():
            return
        token = found[1].strip()


class TokenSource(DataSource):
    """``spark.read.format("tokens")``: pages that name the next one, one after the other in one task, as each is known only from the one before. Options: url, token_url, pattern, step, limit, spacing, retries. Rows: page, token, body."""

    @classmethod
    def name(cls) -> str:
        return "tokens"

    def schema(self) -> str:
        return "page int, token string, body string"

    def reader(self, schema) -> DataSourceReader:
        return _TokenReader(self.options)


class _TokenReader(DataSourceReader):
    def __init__(self, options):
        self.options = dict(options)

    def read(self, partition) -> Iterator[tuple]:
        o = self.options
        yield from token_pages(o["url"], o["token_url"], o["pattern"], int(o.get("step", 0)), int(o["limit"]) if "limit" in o else None, spacing=float(o.get("spacing", 0.125)), retries=int(o.get("retries", 10)))


def hits(pages: DataFrame, pattern: str, url: str, spacing: float = 0.125, retries: int = 10) -> DataFrame:
    """(hit, body): of the bodies of ``pages``, every different match of ``pattern``'s first group, read from '{hit}' of ``url``. Hits are dealt over tasks; one that can't be read has no body."""
    found = pages.select(F.explode(F.regexp_extract_all("body", F.lit(pattern), F.lit(1))).alias("hit")).distinct()

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rows = []
            for hit in frame["hit"]:
                try:
                    rows.append((hit, fetch(url.replace("{hit}", urllib.parse.quote(hit)), spacing, retries)))
                except OSError:
                    rows.append((hit, None))
            yield pd.DataFrame(rows, columns=["hit", "body"])

    return found.mapInPandas(run, "hit string, body string")


def limited(records: DataFrame, most: int | None) -> DataFrame:
    """At most so many records, for a trial run of a source; all without a number."""
    return records if most is None else records.limit(most)


class _Page(InputPartition):
    def __init__(self, number: int):
        self.number = number


class PagedSource(DataSource):
    """``spark.read.format("paged")``: one partition a page of a service. Options: url with '{page}', first, pages, spacing. Rows: page, body."""

    @classmethod
    def name(cls) -> str:
        return "paged"

    def schema(self) -> str:
        return "page int, body string"

    def reader(self, schema) -> DataSourceReader:
        return _PagedReader(self.options)


class _PagedReader(DataSourceReader):
    def __init__(self, options):
        self.options = dict(options)

    def partitions(self) -> list[InputPartition]:
        first = int(self.options.get("first", 1))
        return [_Page(k) for k in range(first, first + int(self.options.get("pages", 1)))]

    def read(self, partition) -> Iterator[tuple]:
        yield partition.number, fetch(self.options["url"].replace("{page}", str(partition.number)), float(self.options.get("spacing", 0.125)))


def sheet_rows(data: bytes, header: int = 1, max_columns: int = 13) -> Iterator[tuple[str, int, str, str]]:
    """(sheet, row, column, value) of the visible sheets of an XLSX workbook: column names from row ``header``; hyperlinks as a further column name + '_url'.

    No-break spaces are spaces, values are trimmed, blank ones left out.
    """
    book = zipfile.ZipFile(io.BytesIO(data))
    shared = []
    if "xl/sharedStrings.xml" in book.namelist():
        shared = ["".join(t.text or "" for t in si.iter(_MAIN + "t")) for si in ET.fromstring(book.read("xl/sharedStrings.xml")).iter(_MAIN + "si")]

    def targets(part: str) -> dict[str, str]:
        return {r.get("Id"): r.get("Target") for r in ET.fromstring(book.read(part))} if part in book.namelist() else {}

    paths = targets("xl/_rels/workbook.xml.rels")
    for sheet in ET.fromstring(book.read("xl/workbook.xml")).iter(_MAIN + "sheet"):
        if sheet.get("state", "visible") != "visible":
            continue
        path = "xl/" + paths[sheet.get(_REL + "id")].removeprefix("/xl/")
        root = ET.fromstring(book.read(path))
        rels = targets(re.sub(r"([^/]+)$", r"_rels/\1.rels", path))
        urls = {h.get("ref"): rels.get(h.get(_REL + "id")) for h in root.iter(_MAIN + "hyperlink")}
        names: dict[str, str] = {}
        for row in root.iter(_MAIN + "row"):
            number = int(row.get("r"))
            for k, cell in enumerate(row.iter(_MAIN + "c")):
                column = re.match("[A-Z]+", cell.get("r", "")) or [chr(65 + k)]
                if number < header or len(names) >= max_columns and column[0] not in names:
                    continue
                raw = cell.findtext(_MAIN + "v") or "".join(t.text or "" for t in cell.iter(_MAIN + "t"))
                value = (shared[int(raw)] if cell.get("t") == "s" and raw else raw).replace(" ", " ").strip()
                if number == header:
                    if value:
                        names[column[0]] = re.sub(r"\W+", "_", value)
                elif column[0] in names:
                    if value:
                        yield sheet.get("name"), number, names[column[0]], value
                    if urls.get(cell.get("r")):
                        yield sheet.get("name"), number, names[column[0]] + "_url", urls[cell.get("r")]


def read_workbooks(spark: SparkSession, path: str, header: int = 1, max_columns: int = 13) -> DataFrame:
    """(file, sheet, row, column, value) of all workbooks under ``path``, read by Spark, so any store will do; one workbook is one row of one task."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.xlsx").load(path).select("path", "content")

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            found = [(p, *cell) for p, data in zip(frame["path"], frame["content"], strict=True) for cell in sheet_rows(data, header, max_columns)]
            yield pd.DataFrame(found, columns=["file", "sheet", "row", "column", "value"])

    return files.mapInPandas(run, "file string, sheet string, row int, column string, value string")


def crawl(frontier: DataFrame, fetch_links: Callable[[DataFrame], DataFrame], max_rounds: int | None = None) -> DataFrame:
    """Everything reachable from ``frontier`` (column id): rounds of fetching new ids' links, against those visited, until none is new.

    With ``max_rounds``, links that still lead on after so many rounds are an error.
    """
    from quadrille.store import written

    seen = written(frontier.select("id").distinct(), "crawl")
    new = seen
    for done in itertools.count(1):
        new = written(fetch_links(new).select("id").where(F.col("id").isNotNull()).distinct().join(seen, "id", "left_anti"), "crawl")
        if new.isEmpty():
            return seen
        if max_rounds is not None and done >= max_rounds:
            raise RuntimeError(f"links lead on after {max_rounds} rounds")
        seen = seen.unionByName(new)
        if done % 16 == 0:  # long chains: one table again, as plans grow with their number
            seen = written(seen, "crawl")
