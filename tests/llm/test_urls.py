import random

from quillgrid.llm.url_filters import RULES, rules_frame, url_verdicts


def spec(url, rules=RULES):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
        host, tail = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:cut]), rest[cut:]
        path = tail[: min([tail.find(c) for c in "?#" if c in tail], default=len(tail))]
    best = None
    for verdict, rule in rules:
        h, p = rule.split("/", 1)
        if (host == h or host.endswith("." + h)) and path.startswith("/" + p) and (best is None or len(rule) > len(best[1])):
            best = (verdict, rule)
    return host, path, best[1] if best else None, best[0] if best else "allow"


def urls():
    rng = random.Random(5)
    hosts = ["net", "a.net", "x.example.net", "example.net", "EXAMPLE.com", "b.org", "anet", "example.net:80", ".net", "a..net", "org.", ""]
    paths = ["", "/", "/en/", "/en/x", "/de/1?x#y", "/fr", "/fr/?a=://b/", "#f/en/", "?q=/en/", "/en"]
    return [f"http://{rng.choice(hosts)}{rng.choice(paths)}" for _ in range(300)] + [None, "", "nothing", "://net/", "a://b://net/"]


def test_same_as_the_definition_broadcast_and_shuffled(spark):
    rows = list(enumerate(urls())) + [(None, "http://a.net/"), (3, "http://a.net/"), (3, "http://a.net/")]
    pages = spark.createDataFrame([(*r, "x", 1) for r in rows], "page_id bigint, url string, digest string, row int")
    want = sorted((str(k), *map(str, spec(u))) for k, u in rows)
    for most in (1000, 0):
        got = sorted(tuple(map(str, r)) for r in url_verdicts(pages, rules_frame(spark), broadcast_rules=most).collect())
        assert got == want
    assert url_verdicts(pages.limit(0), rules_frame(spark)).count() == 0
    assert {r.verdict for r in url_verdicts(pages, rules_frame(spark).limit(0)).collect()} == {"allow"}
