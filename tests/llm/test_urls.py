import random
import re

from ledgerloom.llm import urls
from ledgerloom.llm.queries import URL_RULES

ODD = [
    None, "", "no scheme", "://", "http://", "http://HOST.Example.ORG", "http://a.org?x=/en/", "http://a.org#/y", "https://Ä.COM/De/ß?q#f", "x://y://z/en/",
    "http://shop.example.org/es/1", "http://example.org/en/12/", "http://notexample.org/es/", "http://a.com/de/5.html", "http://a.com/fr/", "http://com/fr/x",
    "http://b.net//a//b/", "http://b.net/" + "s/" * 40, "http://b.net/" + "x" * 5000, "http://a.com/de/5.html",
]


def parsed(url):
    if not url or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match("[^/?#]*", rest)[0]
    path = re.match("[^?#]*", rest[len(host) :])[0]
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host), path


def ruled(host, path):
    fits = [(len(h + p), h + p, v) for v, h, p in URL_RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return max(fits)[1:] if fits else (None, None)


def test_hosts_paths_and_rules(table):
    rows = list(enumerate(ODD)) + [(None, "http://a.org/"), (3, "http://a.org/")]
    found = urls.judge(table(rows, "page_id long, url string"), URL_RULES).collect()
    assert len(found) == len(rows)
    want = {(i, *parsed(u), ruled(*parsed(u))[0]) for i, u in rows}
    assert {(r.page_id, r.host, r.path, r.rule) for r in found} == want
    for r in found:
        assert r.verdict in ("allow", "block")
        assert r.rule is None or r.verdict == ruled(r.host, r.path)[1]


def test_templates_learn_from_labels(table):
    rows = [(i, f"http://h.net/bad/{i}.html", 1) for i in range(40)] + [(100 + i, f"http://h.net/good/{i}.html", 0) for i in range(40)]
    rows += [(200, "http://h.net/bad/999.html", None), (201, "http://h.net/good/999.html", None), (202, "http://h.net/new/1.html", None), (203, "http://other.net/bad/1.html", None)]
    frame = table(rows, "page_id long, url string, blocked int")
    found = {r.page_id: r for r in urls.judge(frame, [], labels=urls.F.col("blocked")).collect()}
    assert found[200].verdict == "block" and found[200].template == "/bad/*.html"
    assert found[201].verdict == "allow" and found[201].template == "/good/*.html"
    # An unseen branch falls back to its host, an unseen host to all.
    assert found[202].template == "/*/*.html" and found[202].verdict == "allow"
    assert found[203].template == "/*/*.html"


def test_like_branches_merge(table):
    rows = [(i, f"http://h.net/s{'abcdef'[i % 6]}/x", i // 6 % 2) for i in range(120)]
    found = urls.judge(table(rows, "page_id long, url string, blocked int"), [], labels=urls.F.col("blocked")).collect()
    assert {r.template for r in found} == {"/*/*"}


def test_empty_table(table):
    assert urls.judge(table([], "page_id long, url string"), URL_RULES).count() == 0


def test_paths_that_part_deep_down(table):
    """Good and bad pages of a host part at segment 10; one path is much longer."""
    start = "https://deep.example/" + "/".join("abcdefghi")
    rows = [(i, f"{start}/{'bad' if i % 2 else 'good'}/{'xyz'[i % 3]}{i}", i % 2) for i in range(80)]
    rows.append((1000, f"{start}/good/" + "/".join(["q"] * 60) + "/a.html", 0))
    pages = table(rows, "page_id long, url string, spam int")
    found = {r.page_id: r for r in urls.judge(pages, [], labels=urls.F.col("spam")).collect()}
    assert len(found) == len(rows)
    assert all(found[i].verdict == ("block" if bad else "allow") for i, _, bad in rows)
    assert found[1000].template.endswith("/good/" + "/".join(["*"] * 61))


def brute_templates(paths):
    """{(host, path): template} of {(host, path): (labelled, blocked)}, level by level."""

    def shaped(segment):
        stem = segment.split(".", 1)[0]
        return "*" + segment[len(stem) :] if re.search("[0-9]", stem) or len(stem) >= urls.LONG else segment

    def merged(part):
        return part if part.startswith("*") else "*"

    out = {}
    live = {key: ("", [shaped(s) for s in key[1].removeprefix("/").split("/")] if key[1] else []) for key in paths}
    while live:
        nodes = {}
        for key, (template, rest) in live.items():
            if not rest:
                out[key] = template
            else:
                nodes.setdefault((key[0], template), []).append(key)
        moved = {}
        for (_, template), keys in nodes.items():
            sums = {}
            for key in keys:
                seen, bad = sums.get(live[key][1][0], (0, 0))
                sums[live[key][1][0]] = seen + paths[key][0], bad + paths[key][1]
            seen, bad = (sum(x) for x in zip(*sums.values()))
            share = (bad + 0.5) / (seen + 1)
            for key in keys:
                part, *rest = live[key][1]
                own, own_bad = sums[part]
                far = (own_bad - own * share) ** 2 / (max(own, 1) * share * (1 - share))
                moved[key] = f"{template}/{part if far > urls.DIFFERS else merged(part)}", rest
        live = moved
    return out


def test_templates_equal_brute_force(spark):
    draw = random.Random(6)
    words = ["a", "bad", "c7", "d.html", "e12.html", "f" * 30, "", "good", "*"]
    paths = {}
    for _ in range(1500):
        host = draw.choice(["h.net", "h.org", "k.org"])
        path = "".join("/" + draw.choice(words[: draw.randint(1, 9)]) for _ in range(draw.randint(0, 6)))
        bad = "bad" in path
        n = draw.randint(0, 9)
        paths[host, path] = n, sum(draw.random() < (0.9 if bad else 0.1) for _ in range(n))
    trap = "/trap" + "/a" * 50
    for i in range(0, 100, 2):
        paths["h.net", trap[: 5 + i]] = 1, i % 4 // 2
    frame = spark.createDataFrame([(h, p, n, bad) for (h, p), (n, bad) in paths.items()], "host string, path string, labelled long, blocked long")
    found = {(r.host, r.path): r.template for r in urls.templates(frame).collect()}
    want = brute_templates(paths)
    assert found == want and len(set(want.values())) > 30


def test_rounds_do_not_grow_with_the_depth(table, monkeypatch):
    rounds, parted = [], urls._parted
    monkeypatch.setattr(urls, "_parted", lambda *x: rounds.append(1) or parted(*x))
    rows = [(i, f"http://a.net{'/same' * 2000}/{i}", i % 2) for i in range(6)] + [(100 + i, f"http://b.net{'/trap' * (40 * i)}", 0) for i in range(30)]
    found = urls.judge(table(rows, "page_id long, url string, spam int"), [], labels=urls.F.col("spam")).collect()
    assert {r.template.count("/") for r in found if r.page_id < 6} == {2001} and sum(rounds) <= 3
