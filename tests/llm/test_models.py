"""Classifiers: held-out accuracy, what they may see, and rows without labels."""

import random
import re
from collections import Counter, defaultdict
from math import exp, log

import pytest
from pyspark.sql import functions as F

from encore.llm.common import one_label
from encore.llm.language import identify
from encore.llm.quality import score_quality
from encore.llm.toxicity import score_toxicity

SF_DIR = "/root/testdata/sf0.1"


def table(spark, name, sf_dir=SF_DIR):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def figures(scored, labels, column):
    rows = scored.filter("held_out").join(one_label(labels, column), "doc_id").select("predicted", "y").collect()
    hit = lambda p, y: sum(r.predicted == p and r.y == y for r in rows)
    return hit(1, 1), hit(1, 0), hit(0, 1), hit(0, 0)


def test_quality_on_held_out_rows(spark):
    docs, labels = table(spark, "documents"), table(spark, "labels")
    scored = score_quality(docs, labels)
    assert scored.columns == [*docs.columns, "held_out", "score", "predicted"]
    assert scored.filter("score < 0 or score > 1 or score is null").count() == 0
    good, kept_bad, lost_good, bad = figures(scored, labels, "quality")
    assert lost_good <= 0.01 * (good + lost_good) and kept_bad <= 0.1 * (bad + kept_bad)


def test_toxicity_on_held_out_rows(spark):
    docs, labels = table(spark, "documents"), table(spark, "labels")
    found, wrong, missed, right = figures(score_toxicity(docs, labels), labels, "toxic")
    assert found >= 0.8 * (found + missed) and wrong <= 0.03 * (wrong + right)


def test_values_by_broadcast_and_by_join_agree(spark):
    small = "/root/testdata/sf0.01"
    docs, labels = table(spark, "documents", small), table(spark, "labels", small)
    one = score_toxicity(docs, labels).orderBy("doc_id").collect()
    other = score_toxicity(docs, labels, model_rows=0).orderBy("doc_id").collect()
    for a, b in zip(one, other, strict=True):
        assert (a.doc_id, a.n_expressions, a.predicted) == (b.doc_id, b.n_expressions, b.predicted)
        assert a.score == pytest.approx(b.score, abs=1e-9)


def plain_differences(rows, learned):
    """By doc_id the difference of the two models' log-likelihoods, straight from their formulas."""
    words = {d: text.split() for d, text in rows}
    holds = {d: ({(w,) for w in ws}, set(zip(ws, ws[1:], strict=False))) for d, ws in words.items()}
    counts = [Counter(), Counter()]
    for d, y in learned.items():
        counts[y].update(holds[d][0] | holds[d][1])
    grams = set(counts[0]) | set(counts[1])
    kept = {g for g in grams if max(c[g] for c in counts) > 2}
    contexts = Counter(g[1] for g in grams if len(g) == 2)
    vocabulary = {w for ws in words.values() for w in ws}
    total = sum(contexts[w] + 1 for w in vocabulary)

    def model(c):
        ones = {k: Counter(n for g, n in c.items() if len(g) == k) for k in (1, 2)}
        d = {k: of[1] / (of[1] + 2 * of[2]) if of[1] and of[2] else 0.5 for k, of in ones.items()}
        n = sum(v for g, v in c.items() if len(g) == 1)
        after = Counter()
        for g, v in c.items():
            after[g[0]] += v if len(g) == 2 else 0
        over = lambda gs, k: sum(max(c[g] - d[k], 0) for g in gs)
        left = 1 - over([g for g in kept if len(g) == 1], 1) / n
        left_of = {h: 1 - over([g for g in kept if len(g) == 2 and g[0] == h], 2) / after[h] for h in after if after[h]}

        def one(w):
            return (max(c[w,] - d[1], 0) / n if (w,) in kept else 0) + left * (contexts[w] + 1) / total

        def two(h, w):
            own = max(c[h, w] - d[2], 0) / after[h] if (h, w) in kept and after[h] else 0
            return own + left_of.get(h, 1) * one(w)

        return one, two

    (one_0, two_0), (one_1, two_1) = map(model, counts)
    alone = lambda w: log(one_1(w)) - log(one_0(w))
    return {
        d: sum(alone(w) for (w,) in a) + sum(log(two_1(*g)) - log(two_0(*g)) - alone(g[1]) for g in b)
        for d, (a, b) in holds.items()
    }


def test_toxicity_against_its_formulas(spark):
    dice = random.Random(4)
    pick = lambda words, k: [words[min(int(dice.expovariate(0.15)), len(words) - 1)] for _ in range(k)]
    plain, foul = [f"w{k}" for k in range(60)], [f"f{k}" for k in range(30)]
    rows = [(k, " ".join(pick(plain, dice.randint(0, 30)) + (pick(foul, 6) + pick(plain, 5) if k % 4 == 0 else []))) for k in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    labels = spark.createDataFrame([(k, int(k % 4 == 0)) for k in range(300)], "doc_id long, toxic int")
    aside = {r.doc_id for r in docs.filter("pmod(xxhash64(doc_id), 5) = 0").collect()}
    learned = {k: int(k % 4 == 0) for k in range(300) if k not in aside}
    want = plain_differences(rows, learned)
    for model_rows in (10**6, 0):
        got = score_toxicity(docs, labels, learn=F.lit(True), model_rows=model_rows).collect()
        assert {r.doc_id: r.difference for r in got} == pytest.approx(want, rel=1e-5, abs=1e-4)


@pytest.mark.parametrize("score, column", [(score_quality, "quality"), (score_toxicity, "toxic")])
def test_odd_rows(spark, score, column):
    good, bad = "the plain words of a text number {}", "IDIOT!! worthless### clown&&& {}"
    rows = [(k, (bad if k % 3 == 0 else good).format(k)) for k in range(200)]
    rows += [(200, None), (201, ""), (202, "x " * 50000), (None, "no id"), (7, good.format(7))]
    docs = spark.createDataFrame([(*r, "s") for r in rows], "doc_id long, text string, score string")
    known = [(k, int(k % 3 != 0), int(k % 3 == 0)) for k in range(0, 200, 2)] + [(2, 1, 1), (4, None, None), (None, 1, 1), (999, 1, 1)]
    labels = spark.createDataFrame(known, "doc_id long, quality int, toxic int")
    scored = score(docs, labels).collect()
    assert len(scored) == len(rows) and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in scored)
    assert not next(r for r in scored if r.doc_id is None).held_out
    same = [r.score for r in scored if r.doc_id == 7]
    assert len(same) == 2 and same[0] == same[1]
    for few in (labels.limit(0), labels.filter(f"{column} = 1")):
        assert score(docs, few).filter("score is null").count() == 0
    assert score(docs.limit(0), labels).collect() == []


def test_scores_see_the_text_only(spark):
    """Other ids, sources and languages, and labels of rows that are not learned from, change nothing."""
    small = "/root/testdata/sf0.01"
    docs, labels = table(spark, "documents", small), table(spark, "labels", small)
    for score, column in ((score_quality, "quality"), (score_toxicity, "toxic")):
        folds = 5 if column == "quality" else 4
        held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % folds == (0 if folds == 5 else 2)
        turned = labels.withColumn(column, F.when(held, 1 - F.col(column)).otherwise(F.col(column)))
        one = score(docs, labels).orderBy("doc_id").select("score").collect()
        other = score(docs.withColumn("lang", F.lit("x")).withColumn("source", F.lit("y")), turned)
        assert [r.score for r in other.orderBy("doc_id").select("score").collect()] == pytest.approx([r.score for r in one])


def test_language_of_pages(spark):
    found = identify(table(spark, "pages"), table(spark, "documents"))
    rows = found.select("lang", "declared", "probability").collect()
    assert len(rows) == table(spark, "pages").count()
    assert sum(r.lang == r.declared for r in rows) >= 0.95 * len(rows)
    assert all(0 < r.probability <= 1.0001 for r in rows)


def plain_languages(pages, docs):
    """page_id -> (lang, probability), from the formulas."""
    langs = sorted({lang for _, lang in docs})
    n = len(langs)

    def slots(text):
        data = re.sub("[\x00-\x20]", " ", text.lower()).encode()
        codes = [data[k] << 16 | data[k + 1] << 8 | data[k + 2] for k in range(len(data) - 2)]
        return [(c * 2654435761 & 0xFFFFFFFF) >> 16 for c in codes]

    counts = [Counter() for _ in langs]
    for text, lang in docs:
        counts[langs.index(lang)].update(slots(text))
    size = [sum(c.values()) + (1 << 16) for c in counts]

    def text_logs(text):
        got = slots(text)
        scale = min(len(got), 60) / max(len(got), 1)
        logs = [scale * sum(log((counts[k][g] + 1) / size[k]) for g in got) for k in range(n)]
        return [v - max(logs) for v in logs], len(got)

    def soft(logs):
        e = [exp(v - max(logs)) for v in logs]
        return [v / sum(e) for v in e]

    rows, sums = [], defaultdict(lambda: [0.0] * n)
    for page, url, html in pages:
        text = re.sub("&[#A-Za-z0-9]+;", " ", re.sub("<[^>]*>", " ", re.sub("(?is)<script[^>]*>.*?</script>", " ", html or "")))
        host = (re.match("[a-z]+://([^/?#:@]+)", url or "") or [None, ""])[1].lower()
        code = (re.match("[a-z]+://[^/]*/([A-Za-z]{2})(?:[/?#-]|$)", url or "") or [None, ""])[1].lower()
        declared = (re.search("(?is)<html[^<>]*? lang=[\"']?([a-z]+)", html or "") or [None, ""])[1].lower()
        labels = host.split(".")
        top, domain = labels[-1], ".".join(labels[-2:])
        suffix = "/".join(filter(None, (top, code)))
        logs, many = text_logs(text)
        share = soft(logs) if many else [0.0] * n
        keys = [("all", "")] + [("declared", declared)] * bool(declared) + [("suffix", suffix)] * bool(suffix)
        keys += [("top", top), ("domain", domain), ("host", host)] * bool(host)
        for key in keys:
            sums[key] = [a + b for a, b in zip(sums[key], share, strict=True)]
        rows.append((page, logs, share, host, domain, top, declared, suffix))
    total = sum(sums["all", ""]) + 0.5 * n
    everywhere = [(v + 0.5) / total for v in sums["all", ""]]
    shrunk = lambda c, above: [(v + 5 * a) / (sum(c) + 5) for v, a in zip(c, above, strict=True)]
    out = {}
    for page, logs, share, host, domain, top, declared, suffix in rows:
        prior = everywhere
        if host:
            prior = shrunk(sums["domain", domain], shrunk(sums["top", top], everywhere))
        own = [max(a - b, 0) for a, b in zip(sums["host", host], share, strict=True)] if host else [0.0] * n
        logs = [a + log(b) for a, b in zip(logs, shrunk(own, prior), strict=True)]
        for key in (("declared", declared), ("suffix", suffix)):
            if key[1]:
                logs = [v + log((c + 0.5 * a) / a) for v, c, a in zip(logs, sums[key], everywhere, strict=True)]
        shares = soft(logs)
        out[page] = (langs[shares.index(max(shares))], max(shares))
    return out


def test_language_against_its_formulas(spark):
    dice = random.Random(8)
    words = {lang: ["".join(dice.choice(signs) for _ in range(5)) for _ in range(30)] for lang, signs in
             (("de", "aeinrst"), ("en", "aehotns"), ("fr", "aeilsuv"))}
    say = lambda lang, k: " ".join(dice.choice(words[lang]) for _ in range(k))
    docs = [(say(lang, 12), lang) for lang in words for _ in range(8)]
    hosts = {"de": ["www.a.de", "b.de", "x.org"], "en": ["a.com", "news.a.com", "x.org"], "fr": ["c.fr", "a.com"]}
    pages = []
    for k in range(150):
        lang = dice.choice(list(words))
        declared = dice.choice(["<html>", f"<html lang='{lang}'>", "<HTML class=x lang=en>"])
        url = dice.choice([None, f"http://{dice.choice(hosts[lang])}/{dice.choice(['', 'de/x', 'fr', 'page'])}"])
        text = say(lang, dice.choice([0, 1, 3, 40]))
        pages.append((k, url, dice.choice([f"{declared}<script>{say('en', 9)}</script><p>{text}&amp;</p>", f"{declared}{text}", None, ""])))
    found = identify(
        spark.createDataFrame(pages, "page_id long, url string, html string").repartition(4),
        spark.createDataFrame(docs, "text string, lang string"),
    ).collect()
    want = plain_languages(pages, docs)
    assert {r.page_id: r.lang for r in found} == {k: lang for k, (lang, _) in want.items()}
    assert {r.page_id: r.probability for r in found} == pytest.approx({k: p for k, (_, p) in want.items()}, rel=1e-6)


def test_clues_decide_where_the_text_does_not(spark):
    docs = spark.createDataFrame(
        [("the house and the garden of the town", "en"), ("das haus und der garten der stadt", "de")] * 5, "text string, lang string"
    )
    german = [(k, f"http://www.zeitung.de/{k}", "<html lang='de'><p>das haus und der garten der stadt</p></html>") for k in range(30)]
    english = [(100 + k, f"http://paper.com/{k}", "<html lang=en><p>the house and the garden of the town</p></html>") for k in range(30)]
    odd = [
        (200, "http://www.zeitung.de/x", "<p>42</p>"), (201, None, "<HTML LANG=\"en-US\"><script>das haus und der garten</script></HTML>"),
        (202, None, None), (203, "not an address", ""), (204, "http://paper.com", None), (205, None, "<p>" + "das haus " * 20000 + "</p>"),
    ]
    pages = spark.createDataFrame(german + english + odd, "page_id long, url string, html string")
    got = {r.page_id: r for r in identify(pages, docs).collect()}
    assert len(got) == 66
    assert [got[k].lang for k in (0, 100, 200, 201, 204, 205)] == ["de", "en", "de", "en", "en", "de"]
    assert got[202].probability < 0.6
    assert identify(pages.limit(0), docs).collect() == []
    assert {r.lang for r in identify(pages, docs.limit(0)).collect()} == {None}
