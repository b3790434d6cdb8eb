"""A data source of HTTP bodies: one partition per host, with retries, back-off, a response cache and a circuit breaker."""

from __future__ import annotations

import gzip
import hashlib
import json
import os
import time
import urllib.error
import urllib.request
import uuid
from collections.abc import Iterator
from pathlib import Path
from urllib.parse import urlsplit

from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

SCHEMA = "url string, status int, corpo string, erro string, tentativas int, segundos double"


class HostPartition(InputPartition):
    def __init__(self, host: str, urls: list[str]):
        self.host, self.urls = host, urls


class HttpBodies(DataSource):
    """``spark.read.format("http_bodies").option("urls", json_list)``: a row per address, in error as well as in success.

    Options: attempts (2), timeout in seconds (8), pause between attempts (1, doubled each time), breaker (5 failures in a row after which
    a host is not asked again), budget in seconds per host (900), agent, cache (a folder all executors
    share; without it nothing is kept), fresh (3600 seconds for which a kept response is used instead of asking again; such rows have no attempts). Only
    successful responses are kept. Addresses of file: are read from disk. A host that fails never
    fails the job: its rows carry ``erro``.
    """

    @classmethod
    def name(cls) -> str:
        return "http_bodies"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return HttpReader(dict(self.options))


class HttpReader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.urls = list(dict.fromkeys(json.loads(options.get("urls", "[]"))))
        number = lambda k, d: float(options.get(k, d))
        self.attempts, self.breaker = int(number("attempts", 2)), int(number("breaker", 5))
        self.timeout, self.pause, self.budget = number("timeout", 8), number("pause", 1), number("budget", 900)
        self.agent = options.get("agent", "civicspark")
        self.cache, self.fresh = options.get("cache", ""), number("fresh", 3600)

    def partitions(self) -> list[InputPartition]:
        hosts: dict[str, list[str]] = {}
        for u in self.urls:
            hosts.setdefault(urlsplit(u).netloc, []).append(u)
        return [HostPartition(h, us) for h, us in sorted(hosts.items())] or [HostPartition("", [])]

    def _get(self, url: str) -> tuple[int, str]:
        ask = urllib.request.Request(url, headers={"User-Agent": self.agent, "Accept-Encoding": "gzip"})
        with urllib.request.urlopen(ask, timeout=self.timeout) as r:
            raw = r.read()
            if r.headers.get("Content-Encoding") == "gzip":
                raw = gzip.decompress(raw)
            return getattr(r, "status", None) or 200, raw.decode(r.headers.get_content_charset() or "utf-8", "replace")

    def _place(self, url: str) -> Path:
        return Path(self.cache.removeprefix("file://")) / f"{hashlib.sha256(url.encode()).hexdigest()}.json"

    def _kept(self, url: str) -> tuple[int, str] | None:
        """A response kept before, if it is fresh; one that can't be read is none."""
        try:
            place = self._place(url)
            if not self.cache or time.time() - place.stat().st_mtime > self.fresh:
                return None
            status, body = json.loads(place.read_text("utf-8"))
            return status, body
        except (OSError, ValueError):
            return None

    def _keep(self, url: str, status: int, body: str) -> None:
        if not self.cache:
            return
        try:  # a cache that can't be written never fails the job
            place = self._place(url)
            place.parent.mkdir(parents=True, exist_ok=True)
            part = place.with_suffix(f".{uuid.uuid4().hex}")
            part.write_text(json.dumps([status, body]), "utf-8")
            os.replace(part, place)
        except OSError:
            pass

    def read(self, partition: HostPartition) -> Iterator[tuple]:
        failures, began = 0, time.monotonic()
        for url in partition.urls:
            if kept := self._kept(url):
                yield url, *kept, None, 0, 0.0
                continue
            if failures >= self.breaker or time.monotonic() - began > self.budget:
                yield url, None, None, "circuito aberto" if failures >= self.breaker else "tempo esgotado", 0, 0.0
                continue
            start, tries, status, body, error = time.monotonic(), 0, None, None, None
            while tries < max(1, self.attempts):
                tries += 1
                try:
                    status, body = self._get(url)
                    error = None
                    self._keep(url, status, body)
                    break
                except urllib.error.HTTPError as e:
                    status, error = e.code, f"http {e.code}"
                    if e.code not in (403, 408, 425, 429) and e.code < 500:
                        break
                except Exception as e:
                    error = type(e).__name__
                if tries < self.attempts:
                    time.sleep(self.pause * 2 ** (tries - 1))
            failures = failures + 1 if error else 0
            yield url, status, body, error, tries, round(time.monotonic() - start, 3)
