from collections import Counter
from itertools import combinations

from llm_fixtures import documents, edges, prose, table, tuples  # noqa: F401
from pyspark.sql import functions as F

from tillwork.llm.url_rules import RULES, judge, labelled_urls, mine, tokens_of

SCHEMA = "page_id long, url string"
FIXED = [(r.verdict, r.host, r.path) for r in RULES]


def parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    end = min([rest.index(c) for c in "/?#" if c in rest], default=len(rest))
    host, path = rest[:end], rest[end:]
    path = path[: min([path.index(c) for c in "?#" if c in path], default=len(path))]
    return "".join(c.lower() if c.isascii() else c for c in host), path


def ruled(url):
    host, path = parts(url)
    fits = [
        (len(h + p), h + p, v)
        for v, h, p in FIXED
        if (host == h or host.endswith("." + h)) and path.startswith(p)
    ]
    return max(fits)[1:] if fits else (None, None)


def mined_by_counting(labelled, support, count, confidence):
    total = len(labelled)
    every, blocked = Counter(), Counter()
    for tokens, b in labelled:
        for n in range(1, len(tokens) + 1):
            for c in combinations(tokens, n):
                every[c] += 1
                blocked[c] += b
    least = max(support, count / total) * total
    return {
        c: (blocked[c] / every[c])
        for c in every
        if blocked[c] >= least - 1e-9 and blocked[c] >= confidence * every[c]
    }


def urls(draw, n):
    return [
        f"http{'s' * draw.randint(0, 1)}://{draw.choice(['', 'www.', 'Spam-farm.'])}"
        f"{draw.choice(['a', 'b', 'example'])}.{draw.choice(['com', 'org', 'net'])}"
        f"/{draw.choice(['en', 'fr', 'de', 'es'])}/{draw.randint(1, 300)}"
        f"{draw.choice(['', '/', '.html', '?x=1&y=2', '#top'])}"
        for _ in range(n)
    ]


def test_mining_and_verdicts(spark, table, prose):
    draw = prose.draw
    seen = urls(draw, 400)
    labelled = [(u, ("farm" in u.lower()) != (draw.random() < 0.1)) for u in seen]
    df = table([(1, u, b) for u, b in labelled] + [(1, None, True), (1, seen[0], None)], "id long, url string, blocked boolean")
    rules = mine(df, 0.01, 5, 0.7)
    token_lists = {
        r["url"]: tuple(r["t"])
        for r in df.select("url", tokens_of(F.col("url")).alias("t")).distinct().collect()
        if r["url"] is not None
    }
    want = mined_by_counting([(token_lists[u], b) for u, b in labelled], 0.01, 5, 0.7)
    got = {tuple(r["tokens"]): r["confidence"] for r in rules.collect()}
    assert want and got.keys() == want.keys()
    assert all(abs(got[c] - want[c]) < 1e-12 for c in want)

    asked = seen + urls(draw, 200) + [None, "", "no scheme", "://", "x://", "a://ORG/", "a://org", "http://Ünï.com/de/"]
    asked += ["http://example.org/es/1?a://b", "http://x.example.org/en/1", "http://notexample.org/es/", seen[0]]
    rows = list(enumerate(asked)) + [(None, seen[3])]
    pages = table(rows, SCHEMA)
    lists = {
        r["url"]: set(r["t"] or ())
        for r in pages.select("url", tokens_of(F.col("url")).alias("t")).collect()
    }
    expected = Counter()
    for i, u in rows:
        rule, verdict = ruled(u)
        hit = any(set(c) <= lists[u] for c in want)
        expected[(i, *parts(u), rule, verdict or ("block" if hit else "allow"))] += 1
    assert Counter(tuples(judge(pages, rules))) == expected
    assert {k[4] for k in expected if k[3] is None} == {"allow", "block"}


def test_tokens(spark):
    df = spark.createDataFrame(
        [("https://WWW.spam-farm.org/en/12-a.HTML?b=1&c#d",)], "url string"
    ).select(tokens_of(F.col("url")))
    assert set(df.first()[0]) == {
        "host:www.spam-farm.org", "label:www", "label:spam-farm", "label:org", "word:spam",
        "word:farm", "path:en", "path:#-a", "type:html", "query:b", "query:c", "fragment:yes",
    }


def test_labels(table):
    pages = table(
        [(1, "http://a.b/en/7"), (2, "http://a.b/en/8.html?q=9"), (3, "http://a.b/"), (4, None), (5, "x://y/9/")],
        SCHEMA,
    )
    labels = table(
        [(7, 1, 0), (8, 0, None), (9, None, None), (None, 0, 1), (7, 1, 1)],
        "doc_id long, quality int, toxic int",
    )
    assert sorted(tuples(labelled_urls(pages, labels))) == [
        ("http://a.b/en/7", True),
        ("http://a.b/en/8.html?q=9", True),
    ]


def test_empty_tables(table):
    none = mine(table([], "url string, blocked boolean"))
    assert none.count() == 0
    assert tuples(judge(table([], SCHEMA), none)) == []
    rows = [(1, "http://a.net/"), (2, "http://a.org/"), (3, "x" * 100_000)]
    assert [r[3:] for r in sorted(tuples(judge(table(rows, SCHEMA), none)))] == [
        (None, "allow"),
        ("org/", "allow"),
        (None, "allow"),
    ]


def test_no_python(table):
    rules = table([(["label:a"], 1.0, 1.0)], "tokens array<string>, confidence double, support double")
    plan = judge(table([(1, "u")], SCHEMA), rules)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
