"""URL rules against plain Python, and the model on what the rules say."""

import random
import re

from rankloom.llm.q_urls import RULES
from rankloom.llm.url_filter import Rule, judge_urls, labelled_by_rules, labelled_urls, precision_recall, train_judge

SCHEMA = "page_id bigint, url string, host string, score string"


def parsed(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host) :])[0]
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in host), path


def fitting(host, path, rules):
    fits = [r for r in rules if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    return max(fits, key=lambda r: len(r.place), default=None)


def urls():
    rng = random.Random(2)
    out = [None, "", "no scheme", "http://", "://", "https://WWW.Example.COM/en/", "http://example.com", "http://example.com?x=/en/", "http://a.example.com/en",
           "http://xexample.com/en/x", "http://net/es/", "http://a.net/ES/", "http://É.net/fr/\nx", "a://b://c.com/d", "http://com/", "http://😀.org/" + "y" * 20000]
    for _ in range(300):
        host = ".".join(rng.choice(["www", "m", "example", "abc", "com", "net", "org", "COM"]) for _ in range(rng.randint(1, 4)))
        out.append(f"{rng.choice(['http', 'https', ''])}://{host}{rng.choice(['', '/', '/en/', '/es/x', '/fr', '/fr/'])}{rng.choice(['', '?a=b/c', '#t'])}")
    return out


def test_rules_like_plain_python(spark):
    rows = [(i, u, "clash", "clash") for i, u in enumerate(urls())] + [(None, "http://a.net/es/", "", ""), (0, None, "", "")]
    pages = spark.createDataFrame(rows, SCHEMA)
    judge = train_judge(labelled_by_rules(pages, RULES))
    got = judge_urls(pages, RULES, judge).collect()
    assert len(got) == len(rows)
    by_id = {i: u for i, u, _, _ in rows}
    for r in got:
        host, path = parsed(by_id[r["page_id"]])
        rule = fitting(host, path, RULES)
        assert (r["host"], r["path"], r["rule"]) == (host, path, rule and rule.place)
        assert r["verdict"] == (rule.verdict if rule else "block" if r["score"] >= 0.5 else "allow")
        assert 0.0 <= r["score"] <= 1.0


def test_model_learns_words_of_hosts(spark):
    rng = random.Random(5)
    good, bad = ["garden", "school", "library"], ["casino", "pills", "jackpot"]
    rows = [(i, f"http://{rng.choice(good if i % 2 else bad)}{rng.randint(1, 999)}.org/{rng.randint(1, 99)}") for i in range(400)]
    table = spark.createDataFrame(rows, "page_id int, url string")
    from pyspark.sql import functions as F

    from rankloom.llm.url_filter import host_of, path_of

    labelled = table.select(host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"), F.when(F.col("page_id") % 2 == 1, "allow").otherwise("block").alias("verdict"))
    judge = train_judge(labelled.filter("host not like '%9.org'"), max_rows=200)
    got = judge_urls(table.filter("url like '%9.org%'"), (), judge).collect()
    assert got and all((r["verdict"] == "allow") == (r["page_id"] % 2 == 1) for r in got)


def test_one_verdict_or_none(spark):
    pages = spark.createDataFrame([(1, "http://a.org/"), (2, None)], "page_id int, url string")
    nothing = train_judge(labelled_by_rules(pages, ()))
    assert [r["verdict"] for r in judge_urls(pages, (), nothing).collect()] == ["allow", "allow"]
    only = (Rule("block", "org/"),)
    assert {r["verdict"] for r in judge_urls(pages, (), train_judge(labelled_by_rules(pages, only))).collect()} == {"block"}
    assert judge_urls(pages.limit(0), RULES, nothing).count() == 0


def test_labelled_table_is_not_the_rules(spark):
    """A held-out fifth, and pages of ordinary hosts that no rule decides."""
    from pyspark.sql import functions as F

    labelled = labelled_urls(spark)
    assert labelled.count() < 2000 and labelled.select("host", "path").distinct().count() == labelled.count()
    held = F.crc32(F.concat("host", "path")) % 5 == 0
    precision, recall = precision_recall(train_judge(labelled.filter(~held)), labelled.filter(held))
    assert precision >= 0.95 and recall >= 0.8
    judge = train_judge(labelled)
    ordinary = [f"https://{s}{n}.example.org/{p}/{i}" for s in ("", "www.", "blog.") for n in ("therwh", "ththly", "tionsh", "anders-verlag", "green") for i, p in enumerate(("en", "de"))]
    spam = [f"http://{s}{n}.example.org/en/7" for s in ("", "www.", "m.") for n in ("casino-win", "cheap-pills", "free-bets")]
    pages = spark.createDataFrame(list(enumerate(ordinary + spam)), "page_id int, url string")
    got = {r["page_id"]: r["verdict"] for r in judge_urls(pages, RULES, judge).collect()}
    said = [got[i] for i in range(len(got))]
    assert said[: len(ordinary)].count("block") == 0 and set(said[len(ordinary) :]) == {"block"}
