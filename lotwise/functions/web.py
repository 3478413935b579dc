"""URLs, pages and payloads of listings."""

from __future__ import annotations

from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F


def query_value(url: Column, name: str) -> Column:
    """A parameter of the query, its name in any case, decoded."""
    raw = F.nullif(F.regexp_extract(url, f"(?i)[?&]{name}=([^&#]*)", 1), F.lit(""))
    return F.coalesce(F.try_url_decode(raw), raw)


def lot_url(url: Column) -> Column:
    """Canonical lot address: scheme and host in lower case, path /Lot, the parameters id, ItemId and SourceSystem."""
    host = F.lower(F.regexp_extract(url, "(?i)^(?:https?://)?([^/?#]+)", 1))
    pairs = [F.when(query_value(url, k).isNotNull(), F.concat(F.lit(f"{k}="), query_value(url, k))) for k in ("id", "ItemId", "SourceSystem")]
    query = F.concat_ws("&", *pairs)
    return F.when(host != "", F.concat(F.lit("https://"), host, F.lit("/Lot"), F.when(query != "", F.concat(F.lit("?"), query)).otherwise("")))


def sorted_url(url: Column) -> Column:
    """Without the fragment, query pairs in lower case and sorted, no slash at the end."""
    plain = F.regexp_replace(F.trim(url), "#.*$", "")
    base = F.regexp_replace(F.lower(F.substring_index(plain, "?", 1)), "/+$", "")
    query = F.when(plain.contains("?"), F.regexp_extract(plain, "\\?(.*)$", 1)).otherwise("")
    pairs = F.array_sort(F.filter(F.split(F.lower(query), "&"), lambda p: p != ""))
    return F.when(F.size(pairs) > 0, F.concat(base, F.lit("?"), F.array_join(pairs, "&"))).otherwise(base)


def stable_key(url: Column) -> Column:
    """item:<ItemId>, lot:<id> or raw:<sorted address>."""
    return F.coalesce(
        F.concat(F.lit("item:"), F.lower(query_value(url, "ItemId"))),
        F.concat(F.lit("lot:"), F.lower(query_value(url, "id"))),
        F.concat(F.lit("raw:"), sorted_url(url)),
    )


def host(url: Column) -> Column:
    return F.lower(F.try_parse_url(url, F.lit("HOST")))


def with_query(url: Column, name: str, value: Column) -> Column:
    """The address with that parameter set, in place of an older value or at the end."""
    bare = F.regexp_replace(url, "#.*$", "")
    set_ = F.concat(F.lit(f"{name}="), value.cast("string"))
    old = F.regexp_replace(bare, f"([?&]){name}=[^&]*", F.concat(F.lit("$1"), set_))
    new = F.concat(bare, F.when(bare.contains("?"), F.lit("&")).otherwise("?"), set_)
    return F.when(bare.rlike(f"[?&]{name}="), old).otherwise(new)


def page_numbers(html: Column) -> Column:
    """1 up to the greatest page number that the links name."""
    found = F.regexp_extract_all(html, F.lit("(?i)[?&;]page=(\\d{1,6})"), F.lit(1))
    most = F.coalesce(F.array_max(F.transform(found, lambda x: x.cast("int"))), F.lit(1))
    return F.sequence(F.lit(1), F.greatest(most, F.lit(1)))


def links(html: Column) -> Column:
    return F.array_distinct(F.regexp_extract_all(html, F.lit("(?i)<a\\s[^>]*href=[\"']([^\"']+)[\"']"), F.lit(1)))


def title(html: Column) -> Column:
    return F.nullif(F.trim(F.regexp_extract(html, "(?is)<title[^>]*>(.*?)</title>", 1)), F.lit(""))


def strip_tags(c: Column) -> Column:
    return F.trim(F.regexp_replace(F.regexp_replace(c, "(?s)<[^>]*>", " "), "\\s+", " "))


def two_column_table(html: Column) -> Column:
    """Map of first to second cell of each table row; the last of equal labels stays."""
    rows = F.regexp_extract_all(html, F.lit("(?is)<tr[^>]*>(.*?)</tr>"), F.lit(1))
    cell = "(?is)^.*?<t[dh][^>]*>(.*?)</t[dh]>\\s*<t[dh][^>]*>(.*?)</t[dh]>"
    pairs = F.transform(F.filter(rows, lambda r: r.rlike(cell)), lambda r: F.struct(strip_tags(F.regexp_extract(r, cell, 1)).alias("k"), strip_tags(F.regexp_extract(r, cell, 2)).alias("v")))
    # map_from_entries refuses equal keys, so earlier ones go first
    last = F.filter(pairs, lambda p, i: ~F.exists(F.slice(pairs, i + 2, F.greatest(F.size(pairs) - i - 1, F.lit(0))), lambda q: q["k"] == p["k"]))
    return F.map_from_entries(last)


def pushed_json(html: Column, name: str = "digitalData") -> Column:
    """The objects pushed on a script's array, as JSON texts."""
    return F.regexp_extract_all(html, F.lit(f"(?s){name}\\.push\\(\\s*(\\{{.*?\\}})\\s*\\)\\s*;"), F.lit(1))


def mileage(c: Column) -> Column:
    return F.regexp_replace(F.nullif(F.regexp_extract(c, "(?i)([\\d.,\\u00A0 ]*\\d)\\s*km\\b", 1), F.lit("")), "[^\\d]", "").try_cast("long")


def horsepower(c: Column) -> Column:
    return F.nullif(F.regexp_extract(c, "(?i)(\\d{2,4})\\s*(?:cv|hp|ch|ps)\\b", 1), F.lit("")).try_cast("int")


def co2(c: Column) -> Column:
    return F.nullif(F.regexp_extract(c, "(?i)(\\d{1,3})\\s*g\\s*/\\s*km", 1), F.lit("")).try_cast("int")


class _Pairs(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.cells, self.rows, self.open = [], [], 0

    def handle_starttag(self, tag, attrs):
        if tag == "tr":
            self.cells = []
        elif tag in ("td", "th"):
            self.open += 1
            self.cells.append("")

    def handle_endtag(self, tag):
        if tag in ("td", "th"):
            self.open = max(0, self.open - 1)
        elif tag == "tr" and len(self.cells) >= 2:
            self.rows.append((" ".join(self.cells[0].split()), " ".join(self.cells[1].split())))

    def handle_data(self, data):
        if self.open and self.cells:
            self.cells[-1] += data


def table_pairs(html: Column) -> Column:
    """First two cells of each table row by a real parser, for markup that patterns can't follow."""
    return F.pandas_udf(_pairs_series, "array<struct<label: string, value: string>>")(html)


def _pairs_series(html: pd.Series) -> pd.Series:

    def one(text):
        parser = _Pairs()
        parser.feed(text or "")
        return [{"label": a, "value": b} for a, b in parser.rows]

    return html.map(one)


def payload_fields(json: Column, schema: str, fields: dict[str, tuple[str, ...]]) -> list[Column]:
    """Named fields of a JSON payload, each the first of its dotted paths that is neither null nor blank."""
    data = F.from_json(json, schema)

    def at(path: str) -> Column:
        value = data
        for part in path.split("."):
            value = value[part]
        return F.when(F.trim(value.cast("string")) != "", value)

    return [F.coalesce(*map(at, paths)).alias(name) for name, paths in fields.items()]


def cell_text(c: Column, kind: str) -> Column:
    """Any cell as text: bytes as UTF-8, structures as JSON, null as empty."""
    if kind == "binary":
        return F.coalesce(F.decode(c, "UTF-8"), F.lit(""))
    if kind.startswith(("struct", "array", "map")):
        return F.coalesce(F.to_json(c), F.lit(""))
    return F.coalesce(c.cast("string"), F.lit(""))
