"""The web source against servers of this process: what is asked, when, and what a restart asks again."""

import json
import threading
import time
from http.server import BaseHTTPRequestHandler, ThreadingHTTPServer

import pytest

from tessera.sources import web


class Site:
    """A host of its own port: /p/<n> are pages up to `last`; it notes each request and when it came."""

    def __init__(self, last=3, robots="", answers={}):
        self.seen = []
        site = self

        class Handler(BaseHTTPRequestHandler):
            def do_GET(self):
                site.seen.append((self.path, time.monotonic()))
                n = self.path.rpartition("/")[2]
                status = answers.get(self.path, 200)
                text = robots if self.path == "/robots.txt" else f"job {n}" if n.isdigit() and int(n) <= last else "nothing"
                self.send_response(status)
                self.end_headers()
                self.wfile.write(text.encode())

            def log_message(self, *_):
                pass

        self.server = ThreadingHTTPServer(("127.0.0.1", 0), Handler)
        self.host = f"127.0.0.1:{self.server.server_address[1]}"
        self.template = f"http://{self.host}/p/{{page}}"
        threading.Thread(target=self.server.serve_forever, daemon=True).start()

    def pages(self):
        return [p for p, _ in self.seen if p != "/robots.txt"]


@pytest.fixture
def site():
    made = []

    def make(**how):
        made.append(Site(**how))
        return made[-1]

    yield make
    for s in made:
        s.server.shutdown()


def options(sites, **more):
    return {"templates": json.dumps([s.template for s in sites]), "last": "5", "minPause": "0.2", "maxPause": "0.2", "attempts": "1"} | more


def test_hosts_are_partitions_with_their_own_pauses_and_rules(spark, site):
    spark.dataSource.register(web.WebPages)
    good, rules, blocks, broken = site(last=9), site(robots="User-agent: *\nDisallow: /p/2"), site(answers={"/p/2": 403}), site(answers={"/p/1": 404})
    df = spark.read.format("web_pages").options(**options([good, rules, blocks, broken], until=r"job \d")).load()
    assert df.rdd.getNumPartitions() == 4
    rows = sorted(df.collect())
    got = {s: [(r["page"], r["body"], (r["error"] or "").partition(":")[0]) for r in rows if r["host"] == s.host] for s in (good, rules, blocks, broken)}
    assert got[good] == [(n, f"job {n}", "") for n in range(1, 6)]
    # page 4 is the first without a job and ends the listing; what robots forbid is not asked
    assert got[rules] == [(1, "job 1", ""), (2, None, "robots_disallowed"), (3, "job 3", ""), (4, "nothing", "")]
    assert rules.pages() == ["/p/1", "/p/3", "/p/4"]
    assert got[blocks] == [(1, "job 1", ""), (2, None, "blocked")] and blocks.pages() == ["/p/1", "/p/2"]
    assert got[broken][0] == (1, None, "fetch_failed") and len(got[broken]) == 4
    times = [t for p, t in good.seen if p != "/robots.txt"]
    assert all(b - a >= 0.19 for a, b in zip(times, times[1:], strict=False))


def test_a_sweep_is_read_once_over_restarts(spark, site, tmp_path):
    spark.dataSource.register(web.WebPages)
    a, b = site(last=2), site(last=1)

    def run(seconds):
        stream = spark.readStream.format("web_pages").options(**options([a, b], last="2", minPause="0", maxPause="0", sweepSeconds=str(seconds))).load()
        stream.writeStream.format("parquet").option("path", f"{tmp_path}/out").option("checkpointLocation", f"{tmp_path}/cp").trigger(availableNow=True).start().awaitTermination()
        return spark.read.parquet(f"{tmp_path}/out").count()

    assert run(10**9) == 4
    assert run(10**9) == 4 and len(a.pages()) == len(b.pages()) == 2
    # a later sweep; those between are not made up for
    assert run(10**6) == 8 and len(a.pages()) == 4


def test_tables_of_urls(spark, site):
    a, b = site(last=9), site(last=9, answers={"/p/3": 403})
    urls = [(n, f"http://{s.host}/p/{n}") for n in range(6) for s in (a, b)]
    df = spark.createDataFrame([*urls, (9, None), (10, "no url at all"), (11, "http://[x/1")], "nth int, url string").repartition(5)
    rows = {r["url"]: (r["body"], r["error"]) for r in web.fetched(df, {"minPause": "0", "maxPause": "0", "attempts": "1"}).collect()}
    assert a.pages() == [f"/p/{n}" for n in range(6)] and b.pages() == [f"/p/{n}" for n in range(4)]
    assert rows[f"http://{a.host}/p/5"] == ("job 5", None) and rows[f"http://{b.host}/p/3"][1].startswith("blocked: 403")
    assert f"http://{b.host}/p/4" not in rows and rows[None] == (None, "fetch_failed: no host") and rows["no url at all"] == rows["http://[x/1"] == rows[None]
    assert web.fetched(df.limit(0), {}).count() == 0


def test_faulty_options(spark):
    spark.dataSource.register(web.WebPages)
    for templates in ('["http://h/p"]', '["{page}"]'):
        with pytest.raises(Exception, match="no URLs with"):
            spark.read.format("web_pages").option("templates", templates).load().collect()
