"""URL filter and filter audit against plain Python and against their SQL on planted tables."""

import random
import re
from collections import Counter, defaultdict
from itertools import permutations

import duckdb
import numpy as np
from pyspark.sql import functions as F

from ledgerlens.llm import filteraudit, redirects
from tests.llm.conftest import ODD
from tools.check import compare

CANONICAL, REFRESH = '<link rel="canonical" href="{}">', '<meta http-equiv="refresh" content="0; url={}">'


def verdicts(df, **more):
    return {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"], r["cause"]) for r in redirects.judge(df, **more).collect()}


def pages_of(spark, rows):
    return spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("host", F.lit("x")).withColumn("v", F.lit(1)).withColumn("c", F.lit(2))


PLANTED = [
    (1, "http://a.example.com/en/1", CANONICAL.format("https://spam.net/x")),
    (2, "https://a.example.com/en/1#top", ""),
    (3, "http://b.example.com/en/2?q=1", REFRESH.format("http://a.example.com/en/1")),
    (4, "http://c.example.org/fr/1", CANONICAL.format("http://spam.net/x")),
    (5, "http://d.example.org/en/1", CANONICAL.format("http://c.example.org/fr/1")),
    (6, "http://E.Example.Org/en/", "<LINK HREF='9.html?a=1&amp;b=2' REL='shortlink canonical'/>"),
    (7, "https://e.example.org/en/9.html?a=1&b=2", '<meta content="5;URL=\'//a.example.com/en/1\'" http-equiv=refresh>'),
    (8, "http://f.example.com/en/1", "<!-- " + CANONICAL.format("http://spam.net/x") + " --><script>var t='" + REFRESH.format("http://spam.net/") + "'</script>"),
    (9, "http://g.example.com/en/1", '<link rel="noncanonical" href="http://spam.net/"><link rel="canonical-x" href="http://spam.net/">'),
    (10, None, CANONICAL.format("http://spam.net/x")), (11, "spam.net/x", CANONICAL.format("http://spam.net/x")), (12, "http://i.example.com", None), (12, "http://i.example.com", None),
    (13, "http://spam.net", ""), (14, "http://spam.net/y", CANONICAL.format("http://j.example.com/en/1")), (15, "http://j.example.com/en/1", ""),
    (16, "http://notexample.com/de/x", CANONICAL.format("#x")), (17, "http://k.example.com/de/1", ""), (18, "http://x.example.net/en/1", CANONICAL.format("/de/")),
    (19, "http://x.example.net:80/en/1", ""), (20, "http://l.example.com/en/a/b", CANONICAL.format("?z")), (21, "http://l.example.com/en/a/b?z", CANONICAL.format("mailto:x@spam.net")),
    (None, "http://m.example.com/en/1", CANONICAL.format("http://spam.net/x")),
]


def test_planted_aliases(spark):
    got = verdicts(pages_of(spark, PLANTED))
    blocked_as_alias = {1, 2, 3, 5, 6, 7, 15, None}
    assert {k for k, v in got.items() if v[4] == "alias"} == blocked_as_alias
    assert all(got[k][3] == "block" for k in blocked_as_alias)
    assert got[4] == ("c.example.org", "/fr/1", "org/fr/", "allow", "rule") and got[14][2:] == ("net/", "block", "rule")
    assert got[10] == got[11] == ("", "", None, "allow", "default") and got[12] == ("i.example.com", "", None, "allow", "default")
    assert got[13] == ("spam.net", "", None, "allow", "default") and got[16] == ("notexample.com", "/de/x", None, "allow", "default")
    assert got[17][2:] == ("example.com/de/", "block", "rule") and got[18][2:] == ("example.net/en/", "allow", "rule") and got[19][0] == "x.example.net:80"
    assert got[6][:2] == ("e.example.org", "/en/") and got[8][3] == got[9][3] == got[20][3] == "allow"


def test_aliases_as_sql_has_them(spark):
    con = duckdb.connect()
    df = pages_of(spark, PLANTED).select("page_id", "url", "html")
    con.register("pages", df.toPandas().convert_dtypes())
    con.execute("CREATE TABLE p AS SELECT CAST(page_id AS BIGINT) AS page_id, url, html FROM pages")
    assert compare(redirects.judge(df), con, redirects.ORACLE.replace("FROM pages", "FROM p")) == ""


def test_random_redirects_against_brute_force(spark):
    rng = random.Random(11)
    sites = [f"http://{h}/{d}/{k}" for h in ("a.com", "b.org", "example.com", "c.net", "example.net") for d in ("en", "de", "fr") for k in range(40)]
    hub = "http://hub.com/en/0"
    edges = [(rng.choice(sites), rng.choice(sites)) for _ in range(110)] + [(s, hub) for s in sites[:70]] + [(None, hub), ("x", None)]
    root = {u: u for u in [*sites, hub]}

    def find(u):
        while root[u] != u:
            u = root[u]
        return u

    def rule(u):
        host, path = re.match(r"http://([^/]*)(.*)", u).groups()
        best = max((len(r.host + r.path), r) for r in [*redirects.RULES, redirects.Rule(None, "", "")] if (("." + host).endswith("." + r.host) or not r.host) and path.startswith(r.path))[1]
        return best.verdict

    for a, b in edges[:-2]:
        root[find(a)] = find(b)
    bad = {find(u) for u in root if rule(u) == "block" and any(u in e for e in edges)}
    rows = [(k, u, "") for k, u in enumerate([*sites, hub])]
    got = verdicts(pages_of(spark, rows), redirects=spark.createDataFrame(edges, "from_url string, to_url string"))
    expected = {k: rule(u) or ("block" if find(u) in bad else "allow") for k, u, _ in rows}
    assert {k: v[3] for k, v in got.items()} == expected and len(set(expected.values())) == 2


def test_pages_without_links(spark):
    assert verdicts(pages_of(spark, [])) == {}
    assert verdicts(pages_of(spark, [(1, "http://a.com/" + "x" * 50000, "<p>" * 50000)]))[1][2:] == (None, "allow", "default")


def fails(text, copy):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    found = {"A": len(words) < 200, "B": 100 * len(set(words)) < 50 * len(words), "C": 100 * len(re.findall("[A-Z]", text)) > 3 * len(text)}
    return {k for k, v in (found | {"D": bool(re.search(r"[#$%&*|]", text)), "E": copy}).items() if v}


def brute_audit(rows, labels):
    first, parts = {}, defaultdict(list)
    for doc_id, text, _ in rows:
        if doc_id is not None:
            first[text or ""] = min(first.get(text or "", doc_id), doc_id)
    good = {d for d, q, _ in labels if q == 1}
    toxic = {d for d, _, t in labels if t == 1}
    for doc_id, text, lang in rows:
        copy = (text or "") in first and (doc_id is None or first[text or ""] < doc_id)
        parts[lang or ""].append((fails(text or "", copy), doc_id is not None and doc_id in good, doc_id is not None and doc_id in toxic))
    out = {}
    for part, held in parts.items():
        worth = Counter()
        for order in permutations("ABCDE"):
            left = list(held)
            for step, k in enumerate(order, 1):
                gone = [x for x in left if k in x[0]]
                left = [x for x in left if k not in x[0]]
                worth[k] += len(gone)
                failing = sum(k in x[0] for x in held)
                out[part, "".join(order), step] = [len(left), len(gone), failing - len(gone), sum(x[0] == {k} for x in held), sum(x[1] for x in gone), sum(x[2] for x in gone)]
        for (p, order, step), row in out.items():
            if p == part:
                row.append(worth[order[step - 1]])
    return out


def audited(docs, labels):
    return {(r[0], r[1], r[2]): list(r)[3:] for r in filteraudit.audit(docs, labels).collect()}


def test_audit_against_brute_force(spark, monkeypatch):
    rng = random.Random(3)
    words = [f"w{k}" for k in range(400)] + ["Abc", "X#", "Äö"]
    texts = [" ".join(rng.choices(words[: rng.choice([20, 403])], k=rng.choice([0, 5, 199, 200, 300]))) for _ in range(60)] + [None, "", " \t ", "A b", "é" * 100 + "AAA", "é" * 97 + "AAA"]
    rows = [(rng.choice([None, *range(150)]), rng.choice(texts), rng.choice(["en", "de", None, ""])) for _ in range(400)]
    labels = [(rng.choice([None, *range(150)]), rng.choice([0, 1, None]), rng.choice([0, 1, None])) for _ in range(120)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").withColumn("part", F.lit(1)).withColumn("id", F.lit(1)).withColumn("good", F.lit(1)).repartition(5)
    got = audited(docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    assert got == brute_audit(rows, labels) and len(got) == 3 * 600


def test_audit_of_odd_tables(spark, frame):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    df = frame(ODD).withColumn("lang", F.lit(None).cast("string"))
    assert audited(df, none) == brute_audit([(*r, None) for r in ODD], [])
    assert audited(df.limit(0), none) == {}


def test_galloping():
    rng = np.random.default_rng(1)
    for _ in range(100):
        a, b = (np.sort(rng.choice(60, rng.integers(0, 50), replace=False)) for _ in range(2))
        assert filteraudit.union(a, b).tolist() == sorted({*a, *b}) and filteraudit.shared(a, b) == len({*a} & {*b})
