import random

import oracle
from pyspark.sql import functions as F

from chunkloom.llm import url_templates as ut
from chunkloom.llm.oracles import ORACLES
from chunkloom.llm.queries import QUERIES

PAGES = "page_id bigint, url string, html string, host string"
LABELS = "doc_id bigint, quality int, toxic int"


def judged(spark, urls, labels=()):
    pages = spark.createDataFrame([(i, u, None, "clash") for i, u in urls], PAGES)
    given = spark.createDataFrame(list(labels), LABELS)
    return {r["page_id"]: r for r in ut.judged_urls(pages, given).collect()}


def test_hosts_paths_and_rules(spark):
    urls = [
        "https://WWW.Example.ORG/es/1?x#y", "http://a.example.org/en/12", "http://b.org/x", "http://x.com/fr/1", "http://com/de/",
        "http://a.net", "http://org?x", "no scheme", None, "", "a://b://c/d", "http://notexample.org/es/1", "http://É.com/FR/\n",
    ]
    rows = judged(spark, list(enumerate(urls)))
    assert [(rows[i]["host"], rows[i]["path"], rows[i]["rule"], rows[i]["verdict"]) for i in range(len(urls))] == [
        ("www.example.org", "/es/1", "example.org/es/", "block"),
        ("a.example.org", "/en/12", "example.org/en/1", "block"),
        ("b.org", "/x", "org/", "allow"),
        ("x.com", "/fr/1", "com/fr/", "allow"),
        ("com", "/de/", "com/de/", "block"),
        ("a.net", "", None, "allow"),
        ("org", "", None, "allow"),
        ("", "", None, "allow"),
        ("", "", None, "allow"),
        ("", "", None, "allow"),
        ("b:", "//c/d", None, "allow"),
        ("notexample.org", "/es/1", "org/", "allow"),
        ("É.com", "/FR/\n", None, "allow"),
    ]


def test_bad_branch_is_rejected_and_like_ones_merge(spark):
    urls, labels = [], []
    for i in range(240):
        part = ("ads", "news", "blog")[i % 3]
        urls.append((i, f"http://h.net/{part}/{i}"))
        labels.append((i, 0 if part == "ads" else 1, 0))
    urls += [(1000 + i, f"http://h.net/{part}/x{i}") for i, part in enumerate(("ads", "news", "blog"))]
    rows = judged(spark, urls, labels)
    assert {r["verdict"] for i, r in rows.items() if i < 240 and i % 3 == 0} == {"block"}
    assert {r["verdict"] for i, r in rows.items() if i < 240 and i % 3} == {"allow"}
    assert rows[1000]["template"].startswith("/ads/")


def test_variable_segments_become_wildcards(spark):
    urls = [(i, f"http://h.net/item/name{chr(97 + i % 26)}{chr(97 + i // 26)}/view") for i in range(60)]
    urls += [(100, "http://h.net/a/0f9c2d1e-77aa"), (101, "http://h.net/" + "/".join("abcdefghijkl"))]
    rows = judged(spark, urls)
    assert len({rows[i]["template"] for i in range(60)}) == 1
    assert "*" in rows[0]["template"]
    assert rows[101]["template"].endswith("/**")


def test_repeats_and_no_pages(spark):
    pages = spark.createDataFrame([(1, "http://h.net/a", None, ""), (1, "http://h.net/a", None, ""), (None, None, None, None)], PAGES)
    labels = spark.createDataFrame([(1, 0, 0), (1, 1, 0), (None, 1, 1), (5, None, None)], LABELS)
    assert ut.judged_urls(pages, labels).count() == 3
    assert ut.judged_urls(pages.where(F.lit(False)), labels).count() == 0
    assert ut.judged_urls(pages, labels.where(F.lit(False))).where("verdict = 'allow'").count() == 3


def test_hot_branch_beside_a_long_tail_is_judged_by_itself(spark):
    letters = [f"{a}{b}{c}" for a in "abcdefghij" for b in "abcdefghij" for c in "abcdefghij"]
    urls = [(i, f"http://h.net/{name}") for i, name in enumerate(letters)]
    urls += [(10_000 + i, f"http://h.net/spam/{chr(97 + i % 3)}") for i in range(1500)]
    labels = [(i, 1 if i < 10_000 else 0, 0) for i, _ in urls]
    rows = judged(spark, urls, labels)
    assert {r["verdict"] for i, r in rows.items() if i >= 10_000} == {"block"}
    assert {(r["template"], r["verdict"]) for i, r in rows.items() if i < 10_000} == {("/*", "allow")}
    # the other way round: a clean branch in a bad tail
    rows = judged(spark, urls, [(i, 1 - quality, 0) for i, quality, _ in labels])
    assert {r["verdict"] for i, r in rows.items() if i >= 10_000} == {"allow"}
    assert {r["verdict"] for i, r in rows.items() if i < 10_000} == {"block"}


def test_branches_that_part_far_below(spark):
    """Good and bad pages that part at the twelfth segment are told apart there."""
    start = "http://h.net/" + "/".join("abcdefghijk")
    urls, labels = [], []
    for i in range(120):
        part = "good" if i % 2 else "bad"
        urls.append((i, f"{start}/{part}/page{i}"))
        labels.append((i, i % 2, 0))
    urls += [(500, f"{start}/bad/new"), (501, f"{start}/good/new"), (502, "http://k.net/" + "/".join("abcdefghijkl"))]
    rows = judged(spark, urls, labels)
    assert {r["verdict"] for i, r in rows.items() if i < 120 and i % 2 == 0} == {"block"}
    assert {r["verdict"] for i, r in rows.items() if i < 120 and i % 2} == {"allow"}
    assert (rows[500]["verdict"], rows[501]["verdict"]) == ("block", "allow")
    assert rows[502]["template"] == "/a/b/c/d/e/f/g/h/**"


def test_sql_is_the_operator_beside_a_long_tail(spark, tmp_path):
    """A hot bad branch beside very many small ones."""
    rng = random.Random(8)
    tail = ["".join(rng.choice("abcdef") for _ in range(7)) for _ in range(400)]
    urls = [(i, f"http://h.net/{t}/x") for i, t in enumerate(tail)]
    urls += [(1000 + i, f"http://h.net/spam/{rng.choice('pqrs')}/p{i}") for i in range(600)]
    urls += [(2000 + i, f"http://k.net/{rng.choice(['a', 'b', 'c'])}/{i}") for i in range(90)]
    labels = [(i, int(i < 1000 or i >= 2000 and rng.random() < 0.7), 0) for i, _ in urls if i % 3 == 0]
    pages = spark.createDataFrame([(i, u, "", "") for i, u in urls], PAGES)
    given = spark.createDataFrame(labels, LABELS)
    for name, frame in (("pages", pages), ("labels", given)):
        frame.toPandas().to_parquet(tmp_path / f"{name}.parquet")
    names, expected = oracle.oracle_rows(oracle.connect(str(tmp_path)), ORACLES["op8_url_templates"])
    found = QUERIES["op8_url_templates"](spark, str(tmp_path))
    rows = [tuple(r) for r in found.collect()]
    assert oracle.bag(found.columns, rows) == oracle.bag(names, expected)
    verdicts = {r["page_id"]: r["verdict"] for r in found.collect()}
    assert {verdicts[1000 + i] for i in range(600)} == {"block"} and {verdicts[i] for i in range(400)} == {"allow"}
