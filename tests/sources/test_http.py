"""The fetcher against a server on this machine, and the selectors' corner cases."""

import json
import pickle
import threading
import time
from http.server import BaseHTTPRequestHandler, HTTPServer, ThreadingHTTPServer

import pytest

from alluvium.functions.select import Pick, clean, compile_selector, read, tree
from alluvium.sources.http import HttpSource, fetch_all, getter


class Handler(BaseHTTPRequestHandler):
    def do_GET(self):
        moved = self.path.startswith("/moved")
        self.send_response(302 if moved else 503 if self.path.startswith("/down") else 200)
        self.send_header("Content-Type", "text/plain; charset=latin-1")
        if moved:
            self.send_header("Location", "/there")
        self.end_headers()
        self.wfile.write(f"ñ {self.path} {self.headers.get('X-A')}".encode("latin-1"))

    def log_message(self, *args):
        pass


@pytest.fixture(scope="module")
def site():
    server = HTTPServer(("127.0.0.1", 0), Handler)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    yield f"http://127.0.0.1:{server.server_port}"
    server.shutdown()


def test_get(site):
    got = getter(5)(f"{site}/x?y=1", {"a": "b c"}, {"X-A": "h"})
    assert (got.status, got.body, got.headers["content-type"]) == (200, "ñ /x?y=1&a=b+c h", "text/plain; charset=latin-1")
    assert getter(5)(f"{site}/down", {}, {}).status == 503
    assert getter(5)(f"{site}/moved", {}, {}).url == f"{site}/there"
    assert getter(5, follow_redirects=False)(f"{site}/moved", {}, {}).status == 302


def test_transport_errors_are_answers():
    for url in ("http://127.0.0.1:9/", "nothing", "http://[bad"):
        got = getter(2)(url, {}, {})
        assert got.status == 0 and got.body


def test_selectors():
    html = "<div class='a b' id=x><p data-k='one-two'>1</p><section><p>2</p></section></div><P>3<p>4"
    texts = lambda **p: read(html, {"t": Pick(**p)})["t"]
    assert texts(selector="p") == ["1", "2", "3", "4"]
    assert texts(selector="div.a.b#x p, .none") == ["1", "2"]
    assert texts(selector="[data-k*='e-t']") == texts(selector="p[data-k$='two']") == texts(selector="[data-k=one-two]") == ["1"]
    assert texts(selector="p", within="section") == ["2"] and texts(selector="p", within=".none") == []
    assert texts(selector="p", first=True) == ["1"] and texts(selector=".none", first=True) == []
    assert texts(selector="p", attr="data-k") == ["one-two"]
    for bad in ("a > b", "a:first", "", "a,,b"):
        with pytest.raises(ValueError):
            compile_selector(bad)


def test_deep_and_empty_pages():
    assert read(None, {"t": Pick()}) == {"t": [""]}
    assert tree("<b>" * 50_000 + "x").text("") == "x"


def test_clean():
    html = "<!-- c --><p onclick='x' class='k'>a &amp; b<script>s</script></p><script type='application/ld+json'>{\"a\": \"<\"}</script><br><nav>n</nav>"
    assert clean(html) == "<p onclick=\"x\" class=\"k\">a &amp; b</p><script type=\"application/ld+json\">{\"a\": \"<\"}</script><br><nav>n</nav>"
    assert clean(html, ("nav",), ("onclick",)).startswith("<p class=\"k\">") and "nav" not in clean(html, ("nav",))


class Kept(BaseHTTPRequestHandler):
    """Counts connections and the times of requests."""

    protocol_version = "HTTP/1.1"

    def setup(self):
        super().setup()
        self.server.connections.append(1)

    def do_GET(self):
        self.server.asked.append((time.monotonic(), self.path))
        body = b"x" * 1000
        self.send_response(302 if self.path.startswith("/round") else 200)
        if self.path.startswith("/round"):
            self.send_header("Location", "/round")
        if self.path.startswith("/last"):
            self.send_header("Connection", "close")
        self.send_header("Content-Length", str(len(body)))
        self.end_headers()
        self.wfile.write(body)

    def log_message(self, *args):
        pass


@pytest.fixture
def hosts():
    made = []
    for _ in range(2):
        server = ThreadingHTTPServer(("127.0.0.1", 0), Kept)
        server.daemon_threads, server.connections, server.asked = True, [], []
        threading.Thread(target=server.serve_forever, daemon=True).start()
        made.append(server)
    yield made
    for server in made:
        server.shutdown()


def test_connections_are_kept(hosts):
    get, at = getter(5), f"http://127.0.0.1:{hosts[0].server_port}"
    assert all(get(f"{at}/{i}", {}, {}).status == 200 for i in range(20)) and len(hosts[0].connections) == 1
    assert get(f"{at}/last", {}, {}).status == 200 and get(f"{at}/next", {}, {}).status == 200 and len(hosts[0].connections) == 2
    assert get(f"{at}/round", {}, {}).status == 0
    copy = pickle.loads(pickle.dumps(get))
    assert copy(f"{at}/copy", {}, {}).status == 200 and len(hosts[0].connections) == 3


def test_one_clock_a_host_over_all_tasks(spark, hosts):
    """Two hosts, ten requests each: at most three at once and three in 0.6 s, so 0.2 s apart; hosts don't wait for each other."""
    asked = [(f"{i}-{k}", f"http://127.0.0.1:{h.server_port}/{k:02d}", {"a": "b"}, k) for i, h in enumerate(hosts) for k in range(10)]
    requests = spark.createDataFrame(asked, "key string, url string, params map<string,string>, rank long").repartition(6)
    out = fetch_all(requests, getter(5), {"X": "y"}, 3, 0.6).collect()
    assert sorted(r["key"] for r in out) == sorted(a[0] for a in asked) and all(r["status_code"] == 200 and len(r["body"]) == 1000 for r in out)
    for h in hosts:
        times = [t for t, _ in h.asked]
        assert all(b - a > 0.12 for a, b in zip(times, times[1:])) and [p for _, p in h.asked] == [f"/{k:02d}?a=b" for k in range(10)]
        assert len(h.connections) <= 3
    assert max(t for h in hosts for t, _ in h.asked) - min(t for h in hosts for t, _ in h.asked) < 20


def test_the_data_source(spark, hosts):
    spark.dataSource.register(HttpSource)
    asked = [[f"http://127.0.0.1:{hosts[k % 2].server_port}/{k}", {"p": "1"} if k % 3 else None] for k in range(9)] + [["nothing", None]]
    rows = spark.read.format("alluvium_http").option("requests", json.dumps(asked)).option("concurrency", 2).option("delay", 0.1).load()
    assert rows.rdd.getNumPartitions() == 3  # a host each, and what has none
    got = {int(r["key"]): r for r in rows.collect()}
    assert sorted(got) == list(range(10)) and got[9]["status_code"] == 0 and all(got[k]["status_code"] == 200 for k in range(9))
    assert got[1]["final_url"].endswith("/1?p=1") and got[0]["params"] == {} and got[1]["params"] == {"p": "1"}
    assert all(len(h.connections) <= 2 for h in hosts)
