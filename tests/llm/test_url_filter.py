from __future__ import annotations

import math

import pytest

from subscope.llm import url_filter as u


def parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    cut = next((i for i, c in enumerate(rest) if c in "/?#"), len(rest))
    tail = rest[cut:]
    end = next((i for i, c in enumerate(tail) if c in "?#"), len(tail))
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:cut]), tail[:end]


def rule_of(host, path):
    fits = [r for r in u.RULES if (host == r[0] or host.endswith("." + r[0])) and path.startswith(r[1])]
    return max(fits, key=lambda r: len(r[0] + r[1]), default=None)


ODD = [None, "", "no scheme", "http://", "HTTP://A.Example.ORG/es/x?y", "x://y://z.org/q", "http://org/", "http://org", "http://ÄÖ.com/fr/é",
       "http://a.com?x=/fr/", "http://a.com/fr/#x", "http://example.org/en/1", "http://notexample.org/es/", "http://a\n.org/\nb",
       "http://xorg/", "http://" + "a" * 5000 + ".net/" + "b" * 5000]


def test_parts_and_rules(spark, sf_dir):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url")
    odd = spark.createDataFrame([(10_000 + i, x) for i, x in enumerate(ODD)] + [(None, "http://a.com/fr/")], "page_id long, url string")
    frame = pages.union(odd)
    url = {r.page_id: r.url for r in frame.collect()}
    got = u.judge(frame).collect()
    assert len(got) == frame.count()
    for r in got:
        host, path = parts(url[r.page_id])
        rule = rule_of(host, path)
        assert (r.host, r.path, r.rule) == (host, path, rule and rule[0] + rule[1])
        assert r.verdict in ("allow", "block") and (rule is None or r.verdict == rule[2])


def test_nothing_to_learn_from(spark):
    frame = spark.createDataFrame([(1, "http://a.net/x", "v"), (2, None, "w")], "page_id long, url string, verdict string")
    assert {r.verdict for r in u.judge(frame).collect()} == {"allow"}
    assert u.judge(frame.limit(0)).count() == 0


def test_model_is_a_distribution_and_prefers_what_it_saw():
    from collections import Counter, defaultdict
    counts = defaultdict(Counter)
    for text in ("abab", "abba", "caab"):
        padded = u.START * u.ORDER + text
        for i in range(u.ORDER, len(padded)):
            for k in range(u.ORDER + 1):
                counts[padded[i - k : i]][padded[i]] += 1
    model = u.Markov(counts)
    for context in ("", "a", "ab", u.START * 5, "zzzzz"):
        total = sum(model.probability(context, chr(c)) for c in range(u.ALPHABET))
        assert math.isclose(total, 1.0, rel_tol=1e-9)
    assert model.log_likelihood("abab") > model.log_likelihood("bcbc")


def test_held_out_urls_are_judged(spark):
    rows = [(f"good.{i % 50}.org/story/{i}", "allow") for i in range(600)] + [(f"cheap-pills{i % 50}.com/buy/{i}", "block") for i in range(600)]
    models, cut = u.fit(spark.createDataFrame(rows, "text string, verdict string"))
    new_good = [u.ratio(models, f"good.7.org/story/{i}") for i in range(1000, 1100)]
    new_bad = [u.ratio(models, f"cheap-pills9.com/buy/{i}") for i in range(1000, 1100)]
    assert sum(x >= cut for x in new_good) >= 97 and sum(x < cut for x in new_bad) >= 97


@pytest.mark.parametrize(("accepted", "rejected"), [([], [1.0]), ([1.0], []), ([1.0, 2.0], [3.0])])
def test_cut_without_separation_blocks_nothing_accepted(accepted, rejected):
    cut = u.calibrated_cut(accepted, rejected)
    assert all(x >= cut for x in accepted)


def labelled_rows():
    good = [(f"good.{i % 7}.org/story/{i}", "allow") for i in range(60)]
    return good + [(f"cheap-pills{i % 5}.com/buy/{i * 37}", "block") for i in range(60)] + [("long.org/" + "xyzw" * 700, "allow")]


def plain_models(rows):
    from collections import Counter, defaultdict
    pair = []
    for side in ("allow", "block"):
        counts = defaultdict(Counter)
        for text in {t for t, said in rows if said == side}:
            padded = u.START * u.ORDER + text
            for i in range(u.ORDER, len(padded)):
                for k in range(u.ORDER + 1):
                    counts[padded[i - k : i]][padded[i]] += 1
        pair.append(u.Markov(counts))
    return tuple(pair)


@pytest.mark.parametrize("listed", [1 << 18, 40, 0])
def test_models_and_cut_come_from_every_labelled_url(spark, monkeypatch, listed):
    from pyspark.sql import functions as F
    monkeypatch.setattr(u, "LISTED", listed)
    monkeypatch.setattr(u, "SORTED", 8)
    monkeypatch.setattr(u, "BINS", 4)
    rows, new = labelled_rows(), ["fresh.net/story/5", "pills.net/buy/9", "ü€.net/x"]
    frame = spark.createDataFrame(rows * 2 + [(t, None) for t in new], "text string, verdict string")
    models, cut = u.fit(frame)
    fold = {r.text: r.f for r in frame.select("text", F.pmod(F.xxhash64(F.lit("held"), "text"), F.lit(u.FOLDS)).alias("f")).collect()}
    held = {f: plain_models([r for r in rows if fold[r[0]] != f]) for f in range(u.FOLDS)}
    scores = [[u.ratio(held[fold[t]], t) for t, said in rows if said == side] for side in ("allow", "block")]
    assert math.isclose(cut, u.calibrated_cut(*scores), rel_tol=1e-9)
    whole = plain_models(rows)
    asked = spark.createDataFrame([(t, u.FOLDS) for t in new], "text string, model int")
    got = {r.text: r.score for r in models.scores(asked).collect()}
    assert set(got) == set(new)
    for t in new:
        assert math.isclose(got[t], u.ratio(whole, t), rel_tol=1e-9) and math.isclose(got[t], u.ratio(models, t), rel_tol=1e-9)


@pytest.mark.parametrize("listed", [1 << 18, 40])
def test_every_row_is_scored_with_and_without_the_list(spark, monkeypatch, listed):
    monkeypatch.setattr(u, "LISTED", listed)
    urls = ["http://a.org/x", "http://b.com/de/1", "http://q.net/z/1", "http://q.net/z/1", "http://r.net/w?x=1", None]
    frame = spark.createDataFrame([(i, x) for i, x in enumerate(urls)], "page_id long, url string")
    whole = plain_models([("a.org/x", "allow"), ("b.com/de/1", "block")])
    got = {r.page_id: r for r in u.judge(frame).collect()}
    assert len(got) == len(urls) and got[0].score is None and got[5].score == 0
    for i in (2, 3, 4):
        assert math.isclose(got[i].score, u.ratio(whole, got[i].host + got[i].path), rel_tol=1e-9)
