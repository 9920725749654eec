"""Text functions on columns: HTML and Markdown cleaning, notices, rendering, JSON salvage."""

from __future__ import annotations

import json
from functools import reduce

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Inline-XBRL and hidden markup, removed in this order (fixed values).
MARKUP = [
    (r"(?s)<ix:header>.*?</ix:header>", ""),
    (r"(?s)<ix:references>.*?</ix:references>", ""),
    (r"(?s)<ix:resources>.*?</ix:resources>", ""),
    (r"(?is)<style[^>]*>.*?</style>", ""),
    (r"(?is)<script[^>]*>.*?</script>", ""),
    (r"(?s)<ix:nonNumeric[^>]*>(.*?)</ix:nonNumeric>", "$1"),
    (r"(?s)<ix:nonFraction[^>]*>(.*?)</ix:nonFraction>", "$1"),
    (r"<ix:[^>]+>", ""),
    (r"</ix:[^>]+>", ""),
    (r"(?s)<xbrli:[^>]+>.*?</xbrli:[^>]+>", ""),
    (r"</?xbrli:[^>]*>", ""),
    (r"<link:[^>]+/>", ""),
    (r"</?link:[^>]*>", ""),
]
ENTITIES = [("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&amp;", "&")]


def strip_markup(html: Column) -> Column:
    return reduce(lambda c, p: F.regexp_replace(c, F.lit(p[0]), F.lit(p[1])), MARKUP, html)


def stripped(text: Column) -> Column:
    """Without any white space at the ends, Unicode's included."""
    return F.regexp_replace(text, F.lit(r"(?U)\A\s+|\s+\z"), F.lit(""))


def clean_lines(text: Column) -> Column:
    """Trimmed, non-blank lines with an empty line between."""
    return F.array_join(F.filter(F.transform(F.split(text, "\n"), stripped), lambda x: x != ""), "\n\n")


def html_text(html: Column) -> Column:
    """Visible text, a line per text node; all in the JVM (common entities only)."""
    bare = F.regexp_replace(strip_markup(html), F.lit(r"(?is)<head[^>]*>.*?</head>"), F.lit(""))
    bare = F.regexp_replace(F.regexp_replace(bare, F.lit(r"(?s)<!--.*?-->"), F.lit("")), F.lit(r"(?s)<[^>]*>"), F.lit("\n"))
    return clean_lines(reduce(lambda c, e: F.replace(c, F.lit(e[0]), F.lit(e[1])), ENTITIES, bare))


@F.pandas_udf(T.StringType())
def parsed_html_text(html: pd.Series) -> pd.Series:
    """Visible text by a real parser, with all entities; for pages that ``html_text`` can't be trusted with."""
    from html.parser import HTMLParser

    class Text(HTMLParser):
        def __init__(self):
            super().__init__(convert_charrefs=True)
            self.out, self.hidden = [], 0

        def handle_starttag(self, tag, attrs):
            self.hidden += tag in ("style", "script", "head")

        def handle_endtag(self, tag):
            self.hidden -= tag in ("style", "script", "head") and self.hidden > 0

        def handle_data(self, data):
            if not self.hidden:
                self.out.append(data)

    def text(x):
        if x is None:
            return None
        p = Text()
        p.feed(x)
        p.close()
        return "\n\n".join(s for s in (y.strip() for y in "\n".join(p.out).splitlines()) if s)

    return html.map(text)


def item_count(text: Column) -> Column:
    return F.regexp_count(text, F.lit(r"(?i)item\s+\d")).cast("long")


def accepted_text(html: Column, fallback: Column) -> Column:
    """Text with at least two item headers, else the fallback."""
    text = html_text(html)
    return F.when(item_count(text) >= 2, text).otherwise(fallback)


def inject_anchors(html: Column) -> Column:
    """Empty div, span and a elements with an id keep a visible [anchor:id]."""
    return F.regexp_replace(html, F.lit(r'<(div|span|a)\s+id="([^"]+)">\s*</\1>'), F.lit(r'<$1 id="$2">[anchor:$2]</$1>'))


def strip_md(text: Column) -> Column:
    """Markdown links to their text, pipes to blanks, white space squeezed."""
    x = F.regexp_replace(text, F.lit(r"\[([^\]]*)\]\([^)]*\)"), F.lit("$1"))
    return F.trim(F.regexp_replace(F.regexp_replace(x, F.lit(r"[|]"), F.lit(" ")), F.lit(r"\s+"), F.lit(" ")))


def truncated(text: Column, n: int, notice: str = "\n\n[first {n} of {total} characters; the rest is not included]") -> Column:
    """The first ``n`` characters with a notice of n and the whole length, where there are more."""
    head, rest = notice.replace("{n}", str(n)).split("{total}")
    return F.when(F.char_length(text) > n, F.concat(F.substring(text, 1, n), F.lit(head), F.char_length(text).cast("string"), F.lit(rest))).otherwise(text)


def table_cell(text: Column) -> Column:
    """A Markdown table cell: pipes escaped, line breaks to blanks, nothing for null."""
    x = F.replace(F.coalesce(text, F.lit("")), F.lit("|"), F.lit("\\|"))
    return F.translate(x, "\n\r", "  ")


def blockquote(text: Column) -> Column:
    """Each line behind '> ', blank lines as '>'; nothing for null or empty."""
    quoted = F.array_join(F.transform(F.split(F.trim(text), "\n"), lambda x: F.when(x == "", F.lit(">")).otherwise(F.concat(F.lit("> "), x))), "\n")
    return F.when(F.coalesce(text, F.lit("")) == "", F.lit("")).otherwise(quoted)


def safe_label(label: Column) -> Column:
    """Characters that aren't letters, digits, '_', '-' or '.' become '_'."""
    return F.regexp_replace(label, F.lit(r"(?U)[^\w\-.]"), F.lit("_"))


def substituted(text: Column, pairs: list[tuple[str, str]]) -> Column:
    return reduce(lambda c, p: F.replace(c, F.lit(p[0]), F.lit(p[1])), pairs, text)


def joined(parts: list[Column], separator: str = " / ") -> Column:
    """The parts that aren't null or empty."""
    return F.concat_ws(separator, *[F.nullif(p, F.lit("")) for p in parts])


def prompt(blocks: list[tuple[str, Column]]) -> Column:
    """'## key' blocks of the values that aren't null; empty ones stay."""
    return F.concat_ws("\n\n", *[F.when(v.isNotNull(), F.concat(F.lit(f"## {k}\n"), v)) for k, v in blocks])


def unfenced(raw: Column) -> Column:
    x = F.regexp_replace(raw, F.lit(r"\A```(?:json)?\s*"), F.lit(""))
    return F.regexp_replace(x, F.lit(r"\s*```\n?\z"), F.lit(""))


def salvage(raw: str, skill: str | None = None) -> str:
    """The first whole JSON object of a reply as JSON text, or an error object with the reply's first 500 characters."""
    try:
        return json.dumps(json.loads(raw), ensure_ascii=False)
    except ValueError:
        start, depth = raw.find("{"), 0
        for at in range(max(start, 0), len(raw) if start >= 0 else 0):
            depth += (raw[at] == "{") - (raw[at] == "}")
            if depth == 0:
                try:
                    return json.dumps(json.loads(raw[start : at + 1]), ensure_ascii=False)
                except ValueError:
                    break
    return json.dumps({"error": "JSON parse failed", "raw": raw[:500], "skill": skill}, ensure_ascii=False)


@F.pandas_udf(T.StringType())
def salvaged(raw: pd.Series) -> pd.Series:
    """``salvage`` of replies; apply it to those alone that ``F.try_parse_json`` refuses."""
    return raw.map(lambda x: None if x is None else salvage(x))


def parsed_reply(raw: Column) -> Column:
    """A reply's JSON text: as it is where it parses once unfenced, else salvaged."""
    x = unfenced(raw)
    return F.when(F.try_parse_json(x).isNotNull(), x).otherwise(salvaged(x))
