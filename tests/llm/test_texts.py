"""Operators 1, 4, 7, 8, 9 and 10 on small tables with awkward rows."""

import hashlib
import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from helpers import SF001, documents, plain_words, ascii_lower
from pyspark.sql import functions as F

from faultscore.llm import decontamination, html_text, language_id, mixing, ngram_scores, secrets_scan

# ---------------------------------------------------------------- operator 1


def brute_base(text):
    spans = []
    for m in re.finditer(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text or "", re.IGNORECASE | re.ASCII):
        if len(m.group(2)) >= 6:
            spans.append((m.start(), 0, m.end()))
    spans += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text or "") if len(m.group()) >= 20]
    spans += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text or "") if len(m.group()) >= 24]
    return sorted(spans)


def random_token(seed, n, alphabet="ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"):
    rnd = random.Random(seed)
    return "".join(rnd.choice(alphabet) for _ in range(n))


PROSE = "é the quick brown fox jumps over thirteen lazy dogs while internationalizationism_continues_everywhere and so on. " * 3


def secret_rows():
    return [
        (1, PROSE), (2, None), (3, ""), (4, f"{PROSE} key {random_token(1, 40)} end"), (5, "é Password: 'hunter2hunter' and TOKEN=abc"),
        (6, "AKIA" + "Z" * 16 + " AKIAshort " + "0" * 24), (7, f"ΑΒ api_key = {random_token(2, 32)}"), (8, "secret = deadbeefdeadbeefdeadbeef01"),
        (9, "x" * 50_000), (10, "a-" * 20_000), (4, f"{PROSE} key {random_token(1, 40)} end"), (None, "token=abcdef"), (11, f"{random_token(3, 64)}== tail"), (12, "AKIAAKIA" + "9" * 20),
    ]


def test_base_spans_stay_and_random_tokens_are_added(spark):
    rows = secret_rows()
    df = documents(spark, rows).withColumnRenamed("spans", "base")
    found = secrets_scan.secrets(df).select("doc_id", secrets_scan.joined_spans(F.col("base")).alias("b"), secrets_scan.joined_spans(F.col("spans")).alias("s")).collect()
    want = sorted((str(d), ",".join(f"{secrets_scan.KINDS[k]}:{s}:{e}" for s, k, e in brute_base(t))) for d, t in rows)
    assert sorted((str(r.doc_id), r.b) for r in found) == want
    added = {r.doc_id: [x for x in r.s.split(",") if x.startswith("random")] for r in found}
    assert {d for d, x in added.items() if x} == {4, 11}
    text = dict(rows)[4]
    start = text.index(random_token(1, 40))
    assert added[4] == [f"random:{start}:{start + 40}"]
    assert all(set(filter(None, r.b.split(","))) <= set(r.s.split(",")) for r in found)


def test_the_query_counts_each_kind_of_base_span(spark, tmp_path):
    rows = [(i, t) for i, (_, t) in enumerate(secret_rows())] + [(99, "token=abcdef " * 3 + "AKIA" + "Z" * 16 + " " + "0a" * 12 + " secret: 123456")]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    got = {r.doc_id: (r.n_assign, r.n_access, r.n_hex, r.base_sha256) for r in secrets_scan.q_secrets(spark, str(tmp_path)).collect()}
    want = {}
    for d, text in rows:
        base = brute_base(text)
        joined = ",".join(f"{secrets_scan.KINDS[k]}:{s}:{e}" for s, k, e in base)
        want[d] = (*(sum(k == kind for _, k, _ in base) for kind in range(3)), hashlib.sha256(joined.encode()).hexdigest())
    assert got == want and want[99][:3] == (4, 1, 1)


def test_a_long_list_of_checksums_takes_time_by_its_length():
    line = "0123456789abcdef0123456789abcdef01234567  file\n"
    text = line * 350_000  # 16 MB, a base span a line
    base = secrets_scan.base_spans(text)
    assert len(base) == 350_000 and secrets_scan.tokens_of(text, base) == []


@pytest.mark.parametrize("seed", range(6))
def test_tokens_inside_base_spans_equal_brute_force(seed):
    rnd = random.Random(seed)
    pieces = ["token=", " ", "\n", "secret: ", random_token(seed, 24), "0123456789abcdef01234567", "AKIA" + "Q" * 18, "==", "word", "_-" * 12]
    for _ in range(60):
        text = "".join(rnd.choice(pieces) for _ in range(12))
        base = secrets_scan.base_spans(text)
        got = {(s, e) for s, e, *_ in secrets_scan.tokens_of(text, base)}
        assert got == {m.span() for m in secrets_scan.TOKEN.finditer(text) if not any(s <= m.start() and m.end() <= e for s, _, e in base)}


def test_battery_accepts_random_and_rejects_regular_tokens():
    k = 64
    rng = np.random.default_rng(0)
    passed = sum(secrets_scan.battery(rng.integers(0, k, size=40), k)[3] >= secrets_scan.BATTERY_P for _ in range(300))
    assert passed >= 290
    for regular in (np.arange(40) % k, np.zeros(40, dtype=int), np.tile([1, 60], 20), np.repeat([3, 40], 20)):
        assert secrets_scan.battery(regular, k)[3] < secrets_scan.BATTERY_P


def test_e_bh_cuts_where_brute_force_does():
    rnd = random.Random(3)
    for _ in range(50):
        values = [round(rnd.uniform(0, 14) * 4) / 4 for _ in range(30)]
        got = secrets_scan.e_bh_threshold(Counter(int(v / 0.25) for v in values), 30, 0.05, 0.25)
        ranked = sorted(values, reverse=True)
        k = max([i + 1 for i, v in enumerate(ranked) if v >= math.log(30 / ((i + 1) * 0.05))], default=0)
        assert sum(v >= got for v in values) >= k
        assert got == math.inf or got >= math.log(30 / (sum(v >= got for v in values) * 0.05))


def test_redaction_masks_spans_and_keeps_rows(spark):
    rows = secret_rows()
    df = documents(spark, rows)
    out = secrets_scan.redact(df)
    assert out.columns == df.columns
    got = out.collect()
    assert len(got) == len(rows)
    by_id = {r.doc_id: r for r in got}
    assert by_id[1].text == PROSE and by_id[2].text is None and by_id[3].text == ""
    assert by_id[4].text == f"{PROSE} key <secret> end" and by_id[4].n_chars == len(by_id[4].text)
    assert by_id[6].text == "<secret> AKIAshort <secret>"
    assert by_id[5].text == "é <secret>' and TOKEN=abc"


@pytest.mark.parametrize("before,after", [("auth=", ""), ("AWS_SECRET_ACCESS_KEY=", ""), ("x := ", ""), ("x:=", ""), ("https://h.example/a?b=1&sig=", "&c=2"), ("key='", "'"), ('key="', '"'), ("a==", "=="), (" ", "")])
def test_random_tokens_behind_signs_are_found(spark, before, after):
    token = random_token(12, 40)
    text = f"{PROSE} {before}{token}{after} {PROSE}"
    df = documents(spark, [(1, PROSE), (2, text)])
    assert {r.doc_id: r.text for r in secrets_scan.redact(df).collect()}[2] in (text.replace(token, "<secret>"), text.replace(token + "==", "<secret>"))
    spans = {r.doc_id: [tuple(x) for x in r.spans] for r in secrets_scan.secrets(df.drop("spans")).collect()}
    start = text.index(token)
    assert spans[2] == [(start, 3, start + 40 + 2 * (after == "=="))]


def test_secrets_of_an_empty_table(spark):
    empty = documents(spark, [(1, "a")]).limit(0)
    assert secrets_scan.secrets(empty.drop("spans")).collect() == []
    assert secrets_scan.redact(empty).collect() == []


# ---------------------------------------------------------------- operator 4


def brute_scores(rows, orders):
    texts = [plain_words(ascii_lower(t or "")) for _, t in rows]
    grams = [Counter(tuple(w[i : i + n]) for n in range(1, orders + 1) for i in range(len(w) - n + 1)) for w in texts]
    total = sum(grams, Counter())
    words = sum(map(len, texts))
    out = []
    for (d, _), w, own in zip(rows, texts, grams):
        c = lambda g: total[g] - own[g] if g else words - len(w)  # noqa: B023, E731
        score = 0.0
        for i in range(len(w)):
            m = min(orders, i + 1)
            for n in range(m, 0, -1):
                g = tuple(w[i - n + 1 : i + 1])
                if c(g) > 0:
                    score += (m - n) * math.log(0.4) + math.log(c(g) / c(g[:-1]))
                    break
            else:
                score += m * math.log(0.4) - math.log(words - len(w) + 1)
        out.append((str(d), len(w), round(score, 6)))
    return sorted(out)


@pytest.mark.parametrize("orders", [2, 3, 4])
def test_backoff_scores_equal_brute_force(spark, orders):
    rnd = random.Random(orders)
    rows = [(i, " ".join(rnd.choice("a b c d E é ff g".split()) for _ in range(rnd.randint(1, 60)))) for i in range(25)]
    rows += [(30, None), (31, ""), (32, "alone"), rows[0], rows[0], (None, rows[1][1]), (33, "a " * 5000)]
    got = sorted((str(r.doc_id), r.n_words, round(r.log_score, 6)) for r in ngram_scores.score(documents(spark, rows), orders).collect())
    want = brute_scores(rows, orders)
    assert [x[:2] for x in got] == [x[:2] for x in want]
    assert [x[2] for x in got] == pytest.approx([x[2] for x in want], abs=1e-3)


def test_scores_of_one_document_and_of_none(spark):
    (one,) = ngram_scores.score(documents(spark, [(1, "a b a")])).collect()
    assert one.log_score == pytest.approx(6 * math.log(0.4))
    assert ngram_scores.score(documents(spark, [(1, "a")]).limit(0)).collect() == []


# ---------------------------------------------------------------- operator 7


def naive_phrases(model, text):
    count = at = 0
    while at < len(text):
        n = 1
        while at + n < len(text) and text[at : at + n + 1] in model:
            n += 1
        at += n
        count += 1
    return count


@pytest.mark.parametrize("seed", range(8))
def test_suffix_automaton_gives_longest_match_phrases(seed):
    rnd = random.Random(seed)
    model = "".join(rnd.choice("abc ") for _ in range(200))
    automaton = language_id.SuffixAutomaton(model)
    for _ in range(30):
        text = "".join(rnd.choice("abcx ") for _ in range(rnd.randint(0, 50)))
        assert automaton.phrases(text) == naive_phrases(model, text)


@pytest.mark.parametrize("text", ["5² ½ Ⅷ", "x²y", "a½b Ⅻc", "_²_", "é٣ß", "ABC١٢", ""])
def test_words_are_runs_of_letters(text):
    want, run = [], ""
    for c in text.lower() + " ":
        if c.isalpha():
            run += c
        elif run:
            want, run = want + [run], ""
    assert language_id.words(text) == want


def test_held_out_accuracy_on_the_test_table(spark):
    truth = {r.doc_id: r.lang for r in spark.read.parquet(f"{SF001}/documents.parquet").collect()}
    got = language_id.q_identify(spark, SF001).collect()
    held = [r for r in got if r.held_out]
    assert len(got) == len(truth) and len(held) > 20
    assert sum(truth[r.doc_id] == r.lang_pred for r in held) >= 0.95 * len(held)
    assert all(0 <= r.score <= 1 for r in got)


def test_awkward_texts_of_unknown_language(spark):
    en, fr = "the quick brown fox and the lazy dog " * 3, "le renard brun saute par dessus le chien paresseux " * 3
    rows = [(i, en, "en") for i in range(1, 12)] + [(i, fr, "fr") for i in range(20, 32)]
    rows += [(40, None, "en"), (41, "", "en"), (42, "123 ++ 4", "fr"), (43, "fox " * 20_000, None), (44, "zzz", None), (45, None, None), (46, "5² ½ Ⅷ", "fr"), (None, fr, "xx"), (1, en, "en")]
    df = documents(spark, rows).withColumn("lang_pred", F.lit("clash")).withColumn("score", F.lit(2.0))
    got = {}
    for r in language_id.identify(df).collect():
        got.setdefault(r.doc_id, []).append(r)
    assert sum(map(len, got.values())) == len(rows)
    assert [got[i][0].lang_pred for i in (40, 41, 42, 43, 45, 46)] == ["und", "und", "und", "en", "und", "und"]
    assert got[None][0].held_out and got[None][0].lang_pred == "fr"  # xx is never learned from
    empty = df.limit(0)
    assert language_id.identify(empty).collect() == []
    one = language_id.identify(documents(spark, [(i, en, "en") for i in range(12)])).collect()
    assert {(r.lang_pred, r.score) for r in one} == {("en", 1.0)}
    none = language_id.identify(documents(spark, [(i, en, None) for i in range(4)])).collect()
    assert {(r.lang_pred, r.score) for r in none} == {("und", 0.0)}


# ---------------------------------------------------------------- operator 8


def test_mixture_rates_follow_the_weights(spark):
    rows = [(i, f"t{i}", "en", "big" if i % 3 else None) for i in range(9000)]
    df = documents(spark, rows, clash=False).withColumn("copy_no", F.lit("clash")).withColumn("n", F.lit(7))
    out = mixing.mix(df, {"big": 0.25, None: 0.75})
    assert out.columns == [c for c in df.columns if c != "copy_no"] + ["copy_no", "shuffle_key"]
    got = Counter(r.source for r in out.select("source").collect())
    assert got["big"] == pytest.approx(2250, abs=5 * math.sqrt(2250)) and got[None] == pytest.approx(6750, abs=5 * math.sqrt(6750))
    copies = Counter(r.doc_id for r in out.where("source IS NULL").select("doc_id").collect())
    counts = Counter(copies.get(i, 0) for i in range(0, 9000, 3))
    for k in range(5):  # rate 2.25
        want = 3000 * math.exp(-2.25) * 2.25**k / math.factorial(k)
        assert counts[k] == pytest.approx(want, abs=5 * math.sqrt(want))
    keys = [r.shuffle_key for r in out.select("shuffle_key").collect()]
    assert keys == sorted(keys)
    assert [tuple(r) for r in out.collect()] == [tuple(r) for r in mixing.mix(df.repartition(5), {"big": 0.25, None: 0.75}).collect()]


def test_mixture_of_awkward_rows(spark):
    rows = [(1, None, "en", "a"), (None, "x", "en", "b"), (2, "", "en", "c"), (2, "", "en", "c"), (3, "y", "en", "unweighted")]
    got = mixing.mix(documents(spark, rows), {"a": 1.0, "b": 1.0, "c": 1.0}, rows_out=30).collect()
    ids = Counter(r.doc_id for r in got)
    assert 3 not in ids and ids[2] % 2 == 0 and ids[1] > 0
    assert mixing.mix(documents(spark, rows).limit(0)).collect() == []
    with pytest.raises(ValueError):
        mixing.mix(documents(spark, rows), {"a": 1.0}, rows_out=10**6)


def test_steps_of_any_rate_are_the_poisson_distribution():
    first, cdf = mixing.steps_from_mode(400.0)
    whole = mixing.poisson_cdf(400.0)
    assert len(cdf) > 300 and cdf == pytest.approx((whole + [1.0] * 99)[first : first + len(cdf)], abs=1e-12)
    for rate in (501.5, 3162.0, 250_000.0, 3e6):
        first, cdf = mixing.poisson_steps(rate)
        k = np.arange(first, first + len(cdf))
        assert (np.diff(cdf) >= 0).all() and cdf[0] < 1e-14 and cdf[-1] > 1 - 1e-12
        p = np.diff(cdf)
        assert (k[1:] * p).sum() == pytest.approx(rate, rel=1e-9)
        assert ((k[1:] - rate) ** 2 * p).sum() == pytest.approx(rate, rel=1e-6)


def test_a_rare_source_has_any_rate(spark):
    """One single-document source beside large ones; the null source is another."""
    n, large = 400_000, 3
    ids = spark.range(large * n + 2)
    source = F.when(F.col("id") == 0, "rare").when(F.col("id") == 1, F.lit(None)).otherwise(F.concat(F.lit("s"), (F.col("id") % large).cast("string")))
    docs = ids.select(F.col("id").alias("doc_id"), F.lit("t").alias("text"), source.alias("source"))
    rate = (large * n + 2) / (large * math.sqrt(n) + 2)
    assert rate > 500
    got = {r["source"]: r["n"] for r in mixing.mix(docs).groupBy("source").agg(F.count("*").alias("n")).collect()}
    u = lambda i: int(hashlib.md5(f"poisson11:{i}".encode()).hexdigest()[:13], 16) / (1 << 52)
    log_p = lambda k: -rate + k * math.log(rate) - math.lgamma(k + 1)
    for i, s in ((0, "rare"), (1, None)):
        acc = k = 0
        while (acc := acc + math.exp(log_p(k))) <= u(i):
            k += 1
        assert got[s] == k
    assert sum(got.values()) == pytest.approx(large * n, rel=0.01)


def test_more_sources_than_a_list_would_hold(spark):
    docs = spark.range(120_000).select(F.col("id").alias("doc_id"), F.lit("t").alias("text"), F.concat(F.lit("s"), F.col("id").cast("string")).alias("source"))
    assert mixing.mix(docs).count() == pytest.approx(120_000, rel=0.02)


# ---------------------------------------------------------------- operator 9

ARTICLE = "The first paragraph of the story has a good number of words in it, &amp; more."


def page(body):
    return f"<!DOCTYPE html><html><head><title>T</title><style>p{{}}</style><script>var a='</p>';</script></head><body>{body}</body></html>"


@pytest.mark.parametrize(
    "html,text",
    [
        (None, ""),
        ("", ""),
        ("plain text only", "plain text only"),
        ("<p>a\n <b>b</b>&nbsp;c<br>d</p>", "a b c d"),
        (page(f"<nav><a href=x>Home</a></nav><article><h1>Title</h1><p>{ARTICLE}<p>Short.</article><footer>foot</footer>"), "Title\nThe first paragraph of the story has a good number of words in it, & more.\nShort."),
        (page(f"<div class='cookie-notice'>We use cookies</div><main><p>{ARTICLE}</p><form>Subscribe <input></form><div id=comments><p>{ARTICLE}</p></div></main>"), ARTICLE.replace("&amp;", "&")),
        (page(f"<ul class=menu><li><a href=1>One</a><li><a href=2>Two</a></ul><div><p>{ARTICLE}</p><p>{ARTICLE}</p><p>End.</p></div><div><a href=3>More</a> <a href=4>Links</a></div>"), "\n".join([ARTICLE.replace("&amp;", "&")] * 2 + ["End."])),
        (page(f"<header>Site</header><article><header><h1>Head</h1></header><p>{ARTICLE}</p><aside>Side</aside></article>"), "Head\n" + ARTICLE.replace("&amp;", "&")),
        (page("<article><p>Tiny</article>"), "Tiny"),
        (page(f"<article class='post comments-open'><p>{ARTICLE}</article>"), ARTICLE.replace("&amp;", "&")),
        (page(f"<div class='content-with-sidebar'><article><p>{ARTICLE}</article></div>"), ARTICLE.replace("&amp;", "&")),
        (page(f"<div class='two-column-sidebar'><div><p>{ARTICLE}</div></div>"), ARTICLE.replace("&amp;", "&")),
        (page(f"<div class='sidebar-wrapper'><p>Side</p><article><p>{ARTICLE}</article></div>"), ARTICLE.replace("&amp;", "&")),
        (page(f"<article><h2 id='related-work'>Related work</h2><p>{ARTICLE}</p><section id='binary-search'><p>Halves.</section><section id='search'><p>Finds.</section><p class='copyright-law'>Law.</article>"), f"Related work\n{ARTICLE}\nHalves.\nFinds.\nLaw.".replace("&amp;", "&")),
        (page(f"<main><h2 id='search'>Search</h2><p>{ARTICLE}</p><div class='related-posts'><p>{ARTICLE}</div><div class='left-sidebar'><p>{ARTICLE}</div></main>"), f"Search\n{ARTICLE}".replace("&amp;", "&")),
        (page(f"<div class='sidebar'><p>{ARTICLE}</p></div>"), ARTICLE.replace("&amp;", "&")),
        (page(f"<article><p>{ARTICLE}</p><div class='ad'>Buy</div></article><div class='site-footer'>{ARTICLE}</div>"), ARTICLE.replace("&amp;", "&")),
        ("<article><p>Cut off <b>here", "Cut off here"),
        (page(f"<form id=aspnetForm><nav><a href=x>Home</a></nav><article><h1>Title</h1><p>{ARTICLE}</article><label>Name <input></label></form>"), f"Title\n{ARTICLE}".replace("&amp;", "&")),
        (page(f"<form id=aspnetForm><div class=menu><a href=x>Home</a></div><div><p>{ARTICLE}</p><p>{ARTICLE}</p></div><label>Name <input></label><button>Go</button></form>"), "\n".join([ARTICLE.replace("&amp;", "&")] * 2)),
        (page(f"<div class=headline><h1>Big news today</h1></div><div class=story><p>{ARTICLE}</p><p>{ARTICLE}</p></div><div><p>He died in 1999.</p></div><div><a href=3>More</a></div>"), "\n".join(["Big news today"] + [ARTICLE.replace("&amp;", "&")] * 2 + ["He died in 1999."])),
        (page(f"<article><p>{ARTICLE}</p><p>{ARTICLE}</p></article><article><p>Short one.</p></article><article><a href=1>A teaser that is all link</a></article>"), "\n".join([ARTICLE.replace("&amp;", "&")] * 2 + ["Short one."])),
        (page(f"<article><p>{ARTICLE}</p><section><h2>Sources</h2><ul><li><a href=1>First source</a><li><a href=2>Second source</a></ul></section><section><h2>Read more</h2><ul><li><a href=1>First story</a><li><a href=2>Second story</a></ul></section></article>"), f"{ARTICLE}\nSources\nFirst source\nSecond source".replace("&amp;", "&")),
        (page(f"<article><p>{ARTICLE} So <math><mi>x</mi><mo>=</mo><mn>2</mn></math> holds.</p></article>"), f"{ARTICLE} So x=2 holds.".replace("&amp;", "&")),
        (page(f"<article><p>{ARTICLE}</p><form><p>{ARTICLE} {ARTICLE}</p></form></article><p>Outside.</p>"), None),
        ("<p>1 < 2 &lt; 3 &#233; &eacute; <![if x]> y</p>", None),
    ],
)
def test_main_text(html, text):
    got = html_text.main_text(html)
    assert isinstance(got, str)
    if text is not None:
        assert got == text


def test_a_page_of_many_regions_takes_time_by_its_length():
    body = "".join(f"<div><p>{ARTICLE} {i}</p><a href={i}>x</a></div>" for i in range(20_000))
    assert html_text.main_text(page(f"<article>{body}</article>")).count("\n") >= 19_999


def test_pages_with_awkward_rows(spark):
    rows = [(1, "u", page(f"<article><p>{ARTICLE}</article>")), (2, None, None), (None, "v", ""), (3, "w", "<div>" * 3000 + "deep" + "</div>" * 3000), (1, "u", page(f"<article><p>{ARTICLE}</article>")), (4, "x", "<p>" + "word " * 50_000)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("text", F.lit("clash"))
    got = html_text.extract(df).collect()
    assert len(got) == 6 and all(r.n_chars == len(r.text) for r in got)
    assert {(r.page_id, r.n_chars) for r in got} >= {(2, 0), (None, 0), (3, 4), (4, 249_999)}
    assert html_text.extract(df.limit(0)).collect() == []


def test_pages_of_the_test_table_hold_their_article(spark):
    html = {r.page_id: r.html for r in spark.read.parquet(f"{SF001}/pages.parquet").collect()}
    for r in html_text.q_extract(spark, SF001).collect():
        article = html[r.page_id].split("<article>")[1].split("</article>")[0]
        blocks = [" ".join(re.sub("<[^>]*>", "", b).split()) for b in re.split(r"</?(?:p|h1)>", article)]
        import html as entities

        assert r.text == "\n".join(b for b in map(entities.unescape, blocks) if b)


# --------------------------------------------------------------- operator 10


def brute_contained(docs, items, n=5, t=0.8):
    grams = lambda s: {tuple(w[i : i + n]) for w in [re.findall(r"[^\W_]+", (s or "").lower())] for i in range(len(w) - n + 1)}
    out = set()
    for d, text in docs:
        have = grams(text)
        for i, item in items:
            want = grams(item)
            if want and d is not None and i is not None and len(want & have) >= t * len(want):
                out.add((d, i, len(want), len(want & have)))
    return out


def test_contained_items_equal_brute_force(spark):
    rnd = random.Random(4)
    vocab = ["".join(rnd.choice("abcdefé") for _ in range(rnd.randint(1, 5))) for _ in range(200)]
    words = lambda n: [rnd.choice(vocab) for _ in range(n)]
    items = [(i, words(rnd.randint(5, 60))) for i in range(20)]
    docs = [(i, " ".join(words(rnd.randint(0, 300)))) for i in range(20)]
    for i, w in items:
        changed = list(w)
        for _ in range(rnd.randint(0, 3)):
            changed[rnd.randrange(len(w))] = "zzz"
        docs.append((100 + i, " ".join(words(40) + changed + words(500))))
    texts = [(i, " ".join(w).title()) for i, w in items] + [(50, "too short text"), (51, None), (52, ""), (None, docs[0][1]), (53, docs[25][1]), (0, texts_of(items[0]))]
    docs += [(200, None), (201, ""), (None, docs[25][1]), (202, "one two"), docs[25], docs[25], (203, " ".join(words(20_000) + items[3][1]))]
    items_df = spark.createDataFrame([(i, t) for i, t in texts], "item_id long, text string").withColumn("h", F.lit("clash")).withColumn("n", F.lit("clash"))
    got = {(r.doc_id, r.item_id, r.n_shingles, r.n_shared) for r in decontamination.contained(documents(spark, docs), items_df).collect()}
    want = brute_contained(docs, texts)
    assert len(want) > 10
    assert got == want
    assert decontamination.contained(documents(spark, docs).limit(0), items_df).collect() == []
    assert decontamination.contained(documents(spark, docs), items_df.limit(0)).collect() == []


def texts_of(item):
    return " ".join(item[1])


def test_short_items_equal_brute_force(spark):
    rnd = random.Random(9)
    vocab = [c * n for c in "abcdé" for n in (1, 2)]
    words = lambda n: " ".join(rnd.choice(vocab) for _ in range(n))
    items = [(i, words(rnd.randint(0, 7))) for i in range(40)] + [(50, None), (None, "a bb"), (51, "A, bb!"), (51, "a bb")]
    # a hot word in a third of the documents, short documents, a very long one, repeated rows
    docs = [(i, ("hot " if i % 3 == 0 else "") + words(rnd.randint(0, 12))) for i in range(60)] + [(90, words(20_000)), (91, None), (92, "a"), (92, "a"), (None, "a bb")]
    items.append((60, "hot"))
    tokens = lambda t: re.findall(r"[^\W_]+", (t or "").lower())
    want = {}
    for d, text in docs:
        for i, item in items:
            w, have = tokens(item), tokens(text)
            k = min(5, len(w))
            if d is None or i is None or not w:
                continue
            grams = {tuple(w[j : j + k]) for j in range(len(w) - k + 1)}
            shared = grams & {tuple(have[j : j + k]) for j in range(len(have) - k + 1)}
            if len(shared) >= 0.8 * len(grams):
                want[d, i] = (len(grams), len(shared))
    df = documents(spark, docs).withColumn("item_id", F.lit(1)).withColumn("h", F.lit(2))
    table = spark.createDataFrame(items, "item_id long, text string").withColumn("doc_id", F.lit(7))
    got = decontamination.contained(df, table, short_items=True).collect()
    assert {(r.doc_id, r.item_id): (r.n_shingles, r.n_shared) for r in got} == want and len(got) == len(want)
    assert {(r.doc_id, r.item_id) for r in decontamination.contained(df, table).collect()} <= set(want)
    assert decontamination.contained(df, table.limit(0), short_items=True).collect() == []


def test_decontamination_runs_no_python(spark):
    plan = decontamination.contained(documents(spark, [(1, "a b c d e f")]), spark.createDataFrame([(1, "a b c d e f")], "item_id long, text string"))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Pandas" not in plan and "CartesianProduct" not in plan


def test_wide_ids_stay_exact_beside_nulls(spark):
    wide = [(1 << 62) + 1, None, -(1 << 61) - 3]
    docs = documents(spark, [(i, "some words in a text") for i in wide])
    from faultscore.llm import simhash

    for got in (language_id.identify(docs), secrets_scan.secrets(docs.drop("spans")), simhash.near_duplicates(docs)):
        assert sorted((r.doc_id for r in got.collect()), key=str) == sorted(wide, key=str)
    pages = spark.createDataFrame([(i, "u", "<p>x</p>") for i in wide], "page_id long, url string, html string")
    assert sorted((r.page_id for r in html_text.extract(pages).collect()), key=str) == sorted(wide, key=str)
