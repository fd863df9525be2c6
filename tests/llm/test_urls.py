import itertools
import random
import re
import time

import pytest
from pyspark.sql import functions as F

from punctual.llm import urls

PAGES, LABELS = "page_id long, url string, html string, rule string", "url string, label string"


def parts(url):
    if url is None or "://" not in url:
        return "", ""
    m = re.match(r"([^/?#]*)([^?#]*)", url.split("://", 1)[1], re.S)
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in m[1]), m[2]


def test_hosts_paths_and_listed_rules(spark):
    given = ["http://a.example.net/en/1", "http://A.Example.NET/x?/en/", "https://example.com/de/1", "https://x.example.com/den", "http://b.org/fr/#top", "http://b.org/fr", "http://net/", "http://net", "http://internet/x", "http://É.net/", "no scheme", "", None, "a://b://c.net/", "http://x.net?q=/", "http://y.net/" + "p" * 50_000]
    pages = spark.createDataFrame([(i, u, "", "") for i, u in enumerate(given)] + [(0, given[0], "", "")], PAGES)
    got = urls.judge(pages, spark.createDataFrame([], LABELS)).orderBy("page_id").collect()
    assert len(got) == 17
    by = {r.page_id: r for r in got}
    for i, u in enumerate(given):
        host, path = parts(u)
        fit = [(f"{h}{p}", v) for v, h, p in urls.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
        rule, verdict = max(fit, key=lambda x: len(x[0]), default=(None, "allow"))
        assert (by[i].host, by[i].path, by[i].rule, by[i].verdict) == (host, path, rule, verdict)


def test_mined_rules_judge_the_rest(spark):
    bad = [f"http://cheap.h{i % 7}.io/buy/{i}" for i in range(60)]
    good = [f"http://news.h{i % 7}.io/{w}/{i}" for i in range(60) for w in ("read", "buy")]
    labels = spark.createDataFrame([(u, "block") for u in bad] + [(u, "allow") for u in good] + [(None, "block"), ("x", None)], LABELS)
    new = ["http://cheap.zz.io/buy/9999", "http://news.zz.io/buy/1", "http://other.example/"]
    got = {r.page_id: r.verdict for r in urls.judge(spark.createDataFrame([(i, u, "", "") for i, u in enumerate(new)], PAGES), labels, support=0.05).collect()}
    assert got == {0: "block", 1: "allow", 2: "allow"}
    # Held-out urls of both kinds; the words alone tell nothing on "buy" pages.
    held = [(i, f"http://{kind}.h{i % 9}.io/buy/x{i}", "", "") for i, kind in enumerate(["cheap", "news"] * 40)]
    found = urls.judge(spark.createDataFrame(held, PAGES), labels).collect()
    assert [r.verdict for r in sorted(found, key=lambda r: r.page_id)] == ["block", "allow"] * 40


def plain_rules(sets, floor, confidence, lift, sure, most):
    """All antecedents up to ``most`` tokens, by counting."""
    n, out = len(sets), {}
    every = sorted({t for own, _ in sets for t in own})
    for size in range(1, most + 1):
        for a in itertools.combinations(every, size):
            own = [label for t, label in sets if set(a) <= t]
            for verdict in set(own):
                both, base = own.count(verdict), sum(x == verdict for _, x in sets) / n
                p, m = both / len(own), len(own)
                low = (p + sure**2 / (2 * m) - sure * (p * (1 - p) / m + sure**2 / (4 * m * m)) ** 0.5) / (1 + sure**2 / m)
                if both >= floor and p >= confidence and p >= lift * base and low >= base:
                    out[a, verdict] = (p, both / n)
    return out


def test_rules_agree_with_counting(spark):
    rng = random.Random(4)
    given = []
    for _ in range(400):
        a, b, c = rng.randrange(3), rng.randrange(2), rng.randrange(4)
        given.append((f"http://a{a}.b{b}.io/p{c}/same", "block" if (a == 0 and b == 1) or rng.random() < 0.1 else "allow"))
    df = spark.createDataFrame(given, LABELS)
    sets = [(set(r.t), label) for r, (_, label) in zip(df.select(urls.tokens(F.col("url")).alias("t")).collect(), given, strict=True)]
    want = plain_rules(sets, 20, 0.6, 1.1, 2.0, 6)
    mined = urls.mine(df, sure=2.0).collect()
    got = {(tuple(r.antecedent), r.verdict): (r.confidence, r.support) for r in mined}
    assert got and any(len(a) > 1 for a, _ in got)
    for k, v in got.items():
        assert v == pytest.approx(want[k])
    # A rule that is missing says what a found one says: tokens that always come together are one.
    alike = {}
    for t in {x for own, _ in sets for x in own}:
        alike.setdefault(tuple(t in own for own, _ in sets), []).append(t)
    rep = {t: min(g) for g in alike.values() for t in g}
    assert {(tuple(sorted({rep[t] for t in a})), v) for a, v in want} == {(tuple(sorted({rep[t] for t in a})), v) for a, v in got}
    for r in mined:
        assert min(sum(x in t for t, _ in sets) for x in r.antecedent) == sum(r.token in t for t, _ in sets)


def test_labels_that_urls_do_not_tell_give_no_rules(spark):
    rng = random.Random(9)
    given = [(f"http://h{rng.randrange(30)}.io/{rng.choice('abc')}/{rng.choice('xyz')}", rng.choice(["block", "allow", "allow"])) for _ in range(1000)]
    assert urls.mine(spark.createDataFrame(given, LABELS)).count() == 0


def test_long_urls_finish(spark):
    rng = random.Random(1)
    long = "http://h.io/" + "/".join(f"part{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(60))
    mixed = ["http://h.io/" + "/".join(f"q{chr(97 + i)}" for i in range(20) if rng.random() < 0.7) for _ in range(300)]
    given = [(long, "block")] * 40 + [(u, "allow") for u in mixed]
    pages = spark.createDataFrame([(1, long, "", ""), (2, mixed[0], "", "")], PAGES)
    began = time.time()
    got = {r.page_id: r.verdict for r in urls.judge(pages, spark.createDataFrame(given, LABELS)).collect()}
    assert got == {1: "block", 2: "allow"} and time.time() - began < 90


def test_rules_among_more_than_eight_telling_tokens(spark):
    # Each of a.c and b.d is blocked, a.d and b.c are not; ten other tokens of nearly all urls tell a little more than a to d alone.
    pairs = [(h, v) for h, v in (("xa.yc", "block"), ("xb.yd", "block"), ("xa.yd", "allow"), ("xb.yc", "allow")) for _ in range(40)]
    own = [i for i, (_, v) in enumerate(pairs) if v == "block"]
    given = [(f"http://{h}.io/" + "/".join(f"t{chr(97 + k)}" for k in range(10) if i != own[k]), v) for i, (h, v) in enumerate(pairs)]
    labels = spark.createDataFrame(given, LABELS)
    mined = {(tuple(r.antecedent), r.verdict): (r.confidence, r.support) for r in urls.mine(labels).collect()}
    assert mined[("host:xa", "host:yc"), "block"] == mined[("host:xa", "host:yd"), "allow"] == (1.0, 0.25)
    pages = spark.createDataFrame([(i, f"https://{h}.zz/", "", "") for i, h in enumerate(["xa.yc", "xb.yd", "xa.yd", "xb.yc"])], PAGES)
    assert {r.page_id: r.verdict for r in urls.judge(pages, labels).collect()} == {0: "block", 1: "block", 2: "allow", 3: "allow"}


def test_rules_of_several_tokens_hold_for_each_of_tokens_alike(spark):
    given = [(f"http://{a}.{a}x.{b}.io/", v) for a, b, v in (("a", "c", "block"), ("b", "d", "block"), ("a", "d", "allow"), ("b", "c", "allow")) for _ in range(40)]
    pages = spark.createDataFrame([(1, "http://a.c.zz/", "", ""), (2, "http://ax.c.zz/", "", ""), (3, "http://ax.d.zz/", "", "")], PAGES)
    assert {r.page_id: r.verdict for r in urls.judge(pages, spark.createDataFrame(given, LABELS)).collect()} == {1: "block", 2: "block", 3: "allow"}


def test_rules_at_the_least_number_of_urls(spark):
    # Shares of so many urls, multiplied out again, come to more than the least number.
    for total in (340, 147, 98):
        given = [(f"http://{h}.io/", v) for h, v in [("a.c", "block")] * 20 + [("b.d", "block")] * 3] + [(f"http://{('a.d', 'b.c')[i % 2]}.io/", "allow") for i in range(total - 23)]
        mined = urls.mine(spark.createDataFrame(given, LABELS))
        assert [r.support for r in mined.where("antecedent = array('host:a', 'host:c')").collect()] == [20 / total]


def test_ties_between_rules_block(spark):
    given = [(f"http://x{i}.left.io/a", "block") for i in range(40)] + [(f"http://x{i}.right.io/b", "allow") for i in range(40)]
    page = spark.createDataFrame([(1, "http://left.right.com/", "", "")], PAGES)
    assert [r.verdict for r in urls.judge(page, spark.createDataFrame(given, LABELS)).collect()] == ["block"]


def test_empty_tables(spark):
    assert urls.judge(spark.createDataFrame([], PAGES), spark.createDataFrame([], LABELS)).count() == 0


def test_labels_join_pages_by_id(spark):
    pages = spark.createDataFrame([(1, "u1", "", ""), (2, "u2", "", ""), (None, "u3", "", "")], PAGES)
    labels = spark.createDataFrame([(1, 1, 1), (2, 1, 0), (None, 0, 0)], "doc_id long, quality int, toxic int")
    assert sorted(map(tuple, urls.labels_of(pages, labels).collect())) == [("u1", "block"), ("u2", "allow")]
