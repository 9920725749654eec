"""Scraped transcripts as a batch data source: validated requests, and failures routed to a column.

The fetcher is the connector; it is given (ticker, quarter, year) and returns one JSON line, or raises. What it raises
decides: wrong requests fail the read, missing transcripts give a row with an error, anything else is tried again."""

from __future__ import annotations

import json
import re
import time
from collections.abc import Callable, Iterator

from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

Fetcher = Callable[[str, str, str], str]
RULES = (("ticker", r"[A-Z]{1,5}"), ("quarter", r"Q[1-4]"), ("year", r"\d{4}"))
ATTEMPTS, FIRST_WAIT, LONGEST_WAIT = 3, 2.0, 30.0
SCHEMA = "ticker STRING, quarter STRING, year STRING, raw_text STRING, participants STRING, error STRING"


class NotFound(Exception):
    """There is no such transcript; final."""


class Request(InputPartition):
    def __init__(self, ticker: str, quarter: str, year: str):
        super().__init__(0)
        self.asked = (ticker, quarter, year)


def requests(text: str) -> list[tuple[str, str, str]]:
    """'MSFT Q1 2024, INTC q2 2023' as checked requests; a bad one is an error of the caller."""
    out = []
    for part in filter(None, (x.strip() for x in text.split(","))):
        words = part.upper().split()
        for (name, rule), value in zip(RULES, [*words, "", "", ""], strict=False):
            if not re.fullmatch(rule, value):
                raise ValueError(f"{name} is not valid in {part!r}")
        out.append(tuple(words[:3]))
    return out


def fetched(fetch: Fetcher, asked: tuple[str, str, str], wait: float = FIRST_WAIT) -> tuple:
    """One row; transient errors are tried again after waits that double."""
    for attempt in range(ATTEMPTS):
        try:
            got = json.loads(fetch(*asked))
            people = [p for p in got.get("participants") or [] if p.get("name")]
            text = got.get("raw_text") or ""
            error = "short_text" if len(text) < 1000 else "no_participants" if not people else None
            return (*asked, text, json.dumps(people), error)
        except NotFound as e:
            return (*asked, None, None, f"not_found: {e}")
        except Exception as e:  # noqa: BLE001
            if attempt + 1 == ATTEMPTS:
                return (*asked, None, None, f"failed: {e}"[:500])
            time.sleep(min(wait * 2**attempt, LONGEST_WAIT))
    raise AssertionError


class TranscriptReader(DataSourceReader):
    def __init__(self, fetch: Fetcher, asked: list[tuple[str, str, str]], wait: float):
        self.fetch, self.asked, self.wait = fetch, asked, wait

    def partitions(self) -> list[Request]:
        return [Request(*a) for a in self.asked]

    def read(self, partition: Request) -> Iterator[tuple]:
        yield fetched(self.fetch, partition.asked, self.wait)


def transcript_source(fetch: Fetcher, name: str = "transcripts") -> type[DataSource]:
    """A data source to register; option ``requests`` lists what to fetch, one task each."""

    class Transcripts(DataSource):
        @classmethod
        def name(cls) -> str:
            return name

        def schema(self) -> str:
            return SCHEMA

        def reader(self, schema) -> DataSourceReader:
            return TranscriptReader(fetch, requests(self.options.get("requests", "")), float(self.options.get("wait", FIRST_WAIT)))

    return Transcripts
