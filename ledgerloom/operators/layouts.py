"""Nested results to report lines by templates: a section is data, and a report of any number of entities is one projection.

A template is text with fields: ``{name}`` is the item's field, ``{#}`` its number from 1 and ``{@}`` the item itself, where it
is plain text; ``{name=x}`` is x where the field is missing; ``!s`` softens it, ``!c`` makes it a table cell, ``!l`` joins a
list with commas, ``!p`` shows a share as whole percent, and ``:table`` decodes it. ``{a+b+~c}`` joins those that aren't empty by
slashes, c softened. ``[name|..]`` is there only where the field isn't empty or false, ``[!name|..]`` only where it is, and
``[a+b|..]`` where either isn't."""

from __future__ import annotations

import re
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import substituted, table_cell
from ..plans import dims

_BODY = r"(?:[^\[\]]|\[(?:[^\[\]]|\[[^\[\]]*\])*\])*"
_PART = re.compile(r"\[(?P<none>!?)(?P<opt>[\w+]+)\|(?P<body>" + _BODY + r")\]|\{(?P<name>[\w@#+~]+)(?:=(?P<missing>[^!:}]*))?(?::(?P<table>\w+))?(?:!(?P<how>\w+))?\}|(?P<text>[^\[{]+|.)", re.S)
_EMPTY = ("", "[]", "{}", "null", "false")


@dataclass(frozen=True)
class Section:
    """heading: shown where there are items, or where one of the paths ``shown`` has anything. kind: "list" (an array of
    objects or texts), "pairs" (an object's {key} and {value}), "one" (an object, or a scalar as @) or "markets" (competitors,
    by {market} with their {names}, markets in order of first appearance). empty: the line of a
    section without items. by: the field by whose rank items are sorted. where: a field and the value that it has, or with
    ! before it hasn't. unless: a path that mustn't be true; needs: paths of which one must have something."""

    path: str
    template: str
    heading: str | None = None
    kind: str = "list"
    empty: str | None = None
    plain: str = "- {@!s}"
    shown: tuple[str, ...] = ()
    by: str | None = None
    where: tuple[str, str] | None = None
    unless: str | None = None
    needs: tuple[str, ...] = ()


def _soft(x: Column) -> Column:
    return substituted(x, dims.TERM_SUBSTITUTES)


def _table(name: str) -> Column:
    return F.create_map(*[F.lit(x) for kv in dims.DISPLAY[name].items() for x in kv])


def template(text: str, raw: Column, item: Column, pos: Column) -> Column:
    """The template over an item: a map of texts, or null where ``raw`` is plain text."""
    get = lambda n: raw if n == "@" else (pos + 1).cast("string") if n == "#" else F.element_at(item, n)
    some = lambda n: ~F.coalesce(get(n), F.lit("")).isin(*_EMPTY)
    parts = []
    for m in _PART.finditer(text):
        if m["opt"]:
            shown = reduce(Column.__or__, [some(n) for n in m["opt"].split("+")])
            parts.append(F.when(~shown if m["none"] else shown, template(m["body"], raw, item, pos)).otherwise(""))
        elif m["name"] and "+" in m["name"]:
            bits = [F.when(some(n.strip("~")), _soft(get(n.strip("~"))) if n.startswith("~") else get(n)) for n in m["name"].split("+")]
            parts.append(F.concat_ws(" / ", *bits))
        elif m["name"]:
            x = F.coalesce(get(m["name"]), F.lit(m["missing"] or ""))
            if m["table"]:
                x = F.coalesce(F.element_at(_table(m["table"]), x), F.lit(dims.DISPLAY_ELSE[m["table"]]) if m["table"] in dims.DISPLAY_ELSE else x)
            for how in m["how"] or "":
                if how == "s":
                    x = _soft(x)
                elif how == "c":
                    x = table_cell(x)
                elif how == "p":
                    x = F.concat(F.round(x.cast("double") * 100).cast("long").cast("string"), F.lit("%"))
                else:
                    x = F.array_join(F.from_json(x, "array<string>"), ", ")
            parts.append(x)
        else:
            parts.append(F.lit(m["text"]))
    return F.concat(*parts) if parts else F.lit("")


def _map(x: Column) -> Column:
    return F.when(x.startswith("{"), F.from_json(x, "map<string,string>"))


def _at(path: str) -> Column:
    """What is at a path of the result, from column ``top``, its parts by key: a result is parsed once, not for each path."""
    first, _, rest = path[2:].partition(".")
    if not first:
        return F.col("result")
    part = F.element_at("top", first)
    return F.get_json_object(part, f"$.{rest}") if rest else part


def _has(path: str) -> Column:
    return ~F.coalesce(_at(path), F.lit("")).isin(*_EMPTY)


def _items(s: Section) -> Column:
    """Items as array of (pos, raw, item), null where there are none."""
    found = _at(s.path)
    if s.kind == "list":
        out = F.transform(F.from_json(found, "array<string>"), lambda x, i: F.struct(i.alias("pos"), x.alias("raw"), _map(x).alias("item")))
    elif s.kind == "pairs":
        none = F.lit(None).cast("string")
        out = F.transform(F.map_entries(F.from_json(found, "map<string,string>")), lambda e, i: F.struct(i.alias("pos"), none.alias("raw"), F.create_map(F.lit("key"), e["key"], F.lit("value"), e["value"]).alias("item")))
    elif s.kind == "markets":
        who = F.from_json(found, "array<struct<name:string,markets:array<string>>>")
        names = F.array_distinct(F.flatten(F.transform(who, lambda w: F.coalesce(w["markets"], F.array()))))
        held = lambda m: F.array_join(F.transform(F.filter(who, lambda w: F.array_contains(w["markets"], m)), lambda w: F.coalesce(w["name"], F.lit(""))), "、")
        out = F.transform(names, lambda m, i: F.struct(i.alias("pos"), F.lit(None).cast("string").alias("raw"), F.create_map(F.lit("market"), m, F.lit("names"), held(m)).alias("item")))
    else:
        out = F.when(_has(s.path), F.array(F.struct(F.lit(0).alias("pos"), found.alias("raw"), _map(found).alias("item"))))
    if s.where:
        name, want = s.where
        is_it = lambda x: F.coalesce(F.element_at(x["item"], name), F.lit("")) == want.lstrip("!")
        out = F.filter(out, lambda x: ~is_it(x) if want.startswith("!") else is_it(x))
    if s.by:
        rank = lambda x: F.coalesce(F.element_at(_table(s.by), F.element_at(x["item"], s.by)), F.lit("2"))
        out = F.transform(F.array_sort(F.transform(out, lambda x: F.struct(rank(x).alias("rank"), x["pos"].alias("pos"), x["raw"].alias("raw"))), lambda a, b: F.when(a["rank"] != b["rank"], F.when(a["rank"] < b["rank"], -1).otherwise(1)).otherwise(a["pos"] - b["pos"])), lambda x: F.struct(x["pos"].alias("pos"), x["raw"].alias("raw"), _map(x["raw"]).alias("item")))
    return out


def section_lines(s: Section, number: int) -> Column:
    """Array of (section_no, line_no, text): the heading is line 0, items follow from 1."""
    line = lambda n, t: F.struct(F.lit(number).alias("section_no"), n.cast("long").alias("line_no"), t.alias("text"))
    none = F.array().cast("array<struct<section_no:int,line_no:bigint,text:string>>")
    items = _items(s)
    if s.unless or s.needs:
        fit = ~F.coalesce(_at(s.unless) == "true", F.lit(False)) if s.unless else F.lit(True)
        items = F.when(fit & (reduce(Column.__or__, [_has(p) for p in s.needs]) if s.needs else F.lit(True)), items)

    def shown(x: Column) -> Column:
        of = template(s.template, x["raw"], x["item"], x["pos"])
        return F.when(x["item"].isNull(), template(s.plain, x["raw"], x["item"], x["pos"])).otherwise(of) if s.kind == "list" else of

    lines = F.filter(F.transform(items, lambda x, i: line(i + 1, shown(x))), lambda x: x["text"] != "")
    lines = F.coalesce(lines, none)
    out = [lines]
    there = reduce(Column.__or__, [_has(p) for p in s.shown]) if s.shown else F.size(lines) > 0
    if s.heading is not None:
        out.insert(0, F.when(there, F.array(line(F.lit(0), F.lit(s.heading)))).otherwise(none))
    if s.empty is not None:
        out.append(F.when((F.size(lines) == 0) & (there if s.shown else F.lit(True)), F.array(line(F.lit(1), F.lit(s.empty)))).otherwise(none))
    return F.concat(*out)


def rendered(results: DataFrame, sections: list[Section]) -> DataFrame:
    """(entity, section_no, line_no, text) of results (entity, result as JSON text); sections that have nothing are left out.

    One scan and no shuffle, whatever the number of sections."""
    rows = results.select("entity", "result", F.from_json("result", "map<string,string>").alias("top"))
    lines = F.flatten(F.array(*[section_lines(s, k) for k, s in enumerate(sections)]))
    return rows.select("entity", F.explode(lines).alias("l")).select("entity", "l.*")


def combined(results: DataFrame) -> DataFrame:
    """(entity, result): an entity's results (entity, task_id, result as JSON text) as one JSON object by task."""
    pair = F.concat(F.lit('"'), "task_id", F.lit('": '), F.coalesce("result", F.lit("null")))
    return results.groupBy("entity").agg(F.concat(F.lit("{"), F.array_join(F.array_sort(F.collect_list(pair)), ", "), F.lit("}")).alias("result"))
