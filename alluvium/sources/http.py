"""GET requests in the tasks: one task a host, connections kept alive, one clock a host; every outcome is a row, a transport
error with status 0 and its text as the body.

A table of requests is fetched by fetch_all(); a short list is a data source of its own, spark.read.format("alluvium_http").
"""

from __future__ import annotations

import datetime as dt
import http.client
import json
import ssl
import threading
import time
import urllib.parse
from collections import defaultdict, deque
from collections.abc import Callable, Iterable, Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition


@dataclass(frozen=True)
class Response:
    status: int
    body: str
    headers: dict[str, str] = field(default_factory=dict)  # names in lower case
    url: str = ""


#: (url, params, headers) -> Response
Fetcher = Callable[[str, dict[str, str], dict[str, str]], Response]

# Fixed value: ciphers for a server that only offers an old key exchange; certificates are still checked.
OLD_CIPHERS = "DEFAULT@SECLEVEL=1"


REDIRECTS = (301, 302, 303, 307, 308)
MOST_REDIRECTS = 10


class Getter:
    """A fetcher over the network. Connections stay open and are used again by whichever thread asks their host next; the
    TLS context is made once. A copy in another process starts without connections."""

    def __init__(self, timeout: float = 30.0, follow_redirects: bool = True, ciphers: str | None = None):
        self.timeout, self.follow_redirects, self.ciphers = timeout, follow_redirects, ciphers
        self._start()

    def _start(self) -> None:
        self._idle: dict[tuple[str, str], list[http.client.HTTPConnection]] = defaultdict(list)
        self._lock, self._context = threading.Lock(), None

    def __getstate__(self):
        return {k: self.__dict__[k] for k in ("timeout", "follow_redirects", "ciphers")}

    def __setstate__(self, state) -> None:
        self.__dict__.update(state)
        self._start()

    def __call__(self, url: str, params: dict[str, str], headers: dict[str, str]) -> Response:
        full = url + (("&" if "?" in url else "?") + urllib.parse.urlencode(params) if params else "")
        try:
            for _ in range(MOST_REDIRECTS + 1):
                status, found, raw = self._once(full, headers)
                to = found.get("location")
                if not (self.follow_redirects and status in REDIRECTS and to):
                    break
                full = urllib.parse.urljoin(full, to)
            else:
                return Response(0, f"more than {MOST_REDIRECTS} redirects", {}, full)
            charset = found.get_content_charset() or "utf-8"
            try:
                body = raw.decode(charset, "replace")
            except LookupError:
                body = raw.decode("utf-8", "replace")
            return Response(status, body, {k.lower(): v for k, v in found.items()}, full)
        except (OSError, ValueError, http.client.HTTPException) as e:
            return Response(0, str(e) or type(e).__name__, {}, full)

    def _once(self, full: str, headers: dict[str, str]):
        parts = urllib.parse.urlsplit(full)
        if parts.scheme not in ("http", "https") or not parts.netloc:
            raise ValueError(f"no address to fetch: {full}")
        path = urllib.parse.quote((parts.path or "/") + (f"?{parts.query}" if parts.query else ""), safe="%/:=&?~#+!$,;'@()*[]")
        key = (parts.scheme, parts.netloc)
        while True:
            with self._lock:
                used = self._idle[key].pop() if self._idle[key] else None
            connection = used or self._opened(parts)
            try:
                connection.request("GET", path, headers=headers)
                answer = connection.getresponse()
                raw = answer.read()
            except (http.client.RemoteDisconnected, ConnectionResetError, BrokenPipeError):
                connection.close()
                if used is None:
                    raise
                continue  # the host had closed it meanwhile; nothing was answered
            except BaseException:
                connection.close()
                raise
            if answer.will_close:
                connection.close()
            else:
                with self._lock:
                    self._idle[key].append(connection)
            return answer.status, answer.headers, raw

    def _opened(self, parts) -> http.client.HTTPConnection:
        if parts.scheme == "http":
            return http.client.HTTPConnection(parts.netloc, timeout=self.timeout)
        with self._lock:
            if self._context is None:
                self._context = ssl.create_default_context()
                if self.ciphers:
                    self._context.set_ciphers(self.ciphers)
        return http.client.HTTPSConnection(parts.netloc, timeout=self.timeout, context=self._context)


def getter(timeout: float = 30.0, follow_redirects: bool = True, ciphers: str | None = None) -> Fetcher:
    return Getter(timeout, follow_redirects, ciphers)


FETCHED = (
    "key string, url string, params map<string,string>, request_headers map<string,string>, status_code int, "
    "response_headers map<string,string>, content_type string, body string, final_url string, fetched_at timestamp"
)


class _Clock:
    """The times at which a host may be asked: `gap` seconds apart, whichever thread asks."""

    def __init__(self, gap: float):
        self.gap, self.next, self.lock = gap, 0.0, threading.Lock()

    def wait(self) -> None:
        with self.lock:
            at = max(self.next, time.monotonic())
            self.next = at + self.gap
        time.sleep(max(0.0, at - time.monotonic()))


def host_of(url: str) -> str:
    return urllib.parse.urlsplit(url).netloc.lower() if "[" not in url else url


def answers(requests: Iterable[tuple], fetcher: Fetcher, headers: dict[str, str], concurrency: int, delay: float) -> Iterator[tuple]:
    """A row of FETCHED for each (key, url, params), in their order; at most `concurrency` are asked at once, and a host at
    most so many times in `delay` seconds, evenly spaced."""
    clocks: dict[str, _Clock] = defaultdict(lambda: _Clock(delay / concurrency))

    def ask(key, url, params, clock):
        clock.wait()
        got = fetcher(url, params, headers)
        kind = got.headers.get("content-type", "")
        return key, url, params, headers, got.status, got.headers, kind, got.body, got.url or url, dt.datetime.now(dt.timezone.utc)

    with ThreadPoolExecutor(concurrency) as pool:
        under_way: deque = deque()
        for key, url, params in requests:
            under_way.append(pool.submit(ask, key, url, dict(params or {}), clocks[host_of(url)]))
            if len(under_way) >= 2 * concurrency:
                yield under_way.popleft().result()
        while under_way:
            yield under_way.popleft().result()


def fetch_all(requests: DataFrame, fetcher: Fetcher, headers: dict[str, str], concurrency: int, delay: float = 0.0) -> DataFrame:
    """requests: key, url, params, and maybe rank, by which those of a host are asked. A host's requests go to one task, so
    its clock and its connections hold for all of them; `concurrency` threads ask there."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows = ((key, url, params) for f in frames for key, url, params in zip(f["key"], f["url"], f["params"]))
        for row in answers(rows, fetcher, headers, concurrency, delay):
            yield pd.DataFrame([row], columns=[c.split()[0] for c in FETCHED.split(", ")])

    host = F.lower(F.regexp_extract("url", "^[^:]*://([^/?#]*)", 1))
    rank = [F.col("rank")] if "rank" in requests.columns else []
    dealt = requests.select("key", "url", "params", *rank).repartition(host).sortWithinPartitions(*rank or ["key"])
    return dealt.select("key", "url", "params").mapInPandas(run, FETCHED)


@dataclass
class _Host(InputPartition):
    host: str
    requests: list[tuple]


class HttpReader(DataSourceReader):
    def __init__(self, options):
        self.requests = [(str(i), url, params or {}) for i, (url, params) in enumerate(json.loads(options.get("requests", "[]")))]
        self.headers = json.loads(options.get("headers", "{}"))
        self.concurrency, self.delay = int(options.get("concurrency", 5)), float(options.get("delay", 0))
        self.fetcher = Getter(float(options.get("timeout", 30)), options.get("followRedirects", "true").lower() == "true", options.get("ciphers"))

    def partitions(self) -> list[InputPartition]:
        by_host = defaultdict(list)
        for r in self.requests:
            by_host[host_of(r[1])].append(r)
        return [_Host(h, rows) for h, rows in sorted(by_host.items())]

    def read(self, partition: _Host) -> Iterator[tuple]:
        yield from answers(partition.requests, self.fetcher, self.headers, self.concurrency, self.delay)


class HttpSource(DataSource):
    """Options: requests (JSON, a list of [address, parameters or null]), headers (JSON), concurrency and delay (of a host),
    timeout, followRedirects, ciphers. A partition is a host. Key is the request's place in the list."""

    @classmethod
    def name(cls) -> str:
        return "alluvium_http"

    def schema(self) -> str:
        return FETCHED

    def reader(self, schema) -> HttpReader:
        return HttpReader(self.options)
