"""Secret scan, language, HTML, licenses and URLs against plain versions and small odd inputs."""

import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from barloom.llm import html_text, language, license_scan, secret_scan, url_filter
from barloom.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
TEXT = "doc_id long, text string, lang string, source string, n_chars long"


def docs(spark, texts, **extra):
    rows = [(i, t, extra.get("lang", "en"), "s", len(t or "")) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, TEXT)


@pytest.fixture(scope="module")
def ratio(spark):
    table = spark.read.parquet(f"{SF}/documents.parquet")
    samples = secret_scan.identifiers(table).unionByName(secret_scan.random_strings(spark, 3000))
    return secret_scan.train(samples)


def plain_base(text):
    """The fixed patterns, written as the contract states them."""
    found = []
    word = r"([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])"
    for m in re.finditer(word + r"[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", text):
        if len(m[2]) >= 8:
            found.append((m.start(), 0, "assign", m.end()))
    for m in re.finditer(r"AKIA[A-Z0-9]+", text):
        if len(m[0]) >= 16:
            found.append((m.start(), 1, "access", m.end()))
    for m in re.finditer(r"[0-9a-f]+", text):
        if len(m[0]) >= 32:
            found.append((m.start(), 2, "hex", m.end()))
    return ",".join(f"{k}:{a}:{b}" for a, _, k, b in sorted(found))


SECRETS = [
    "token=secret: abcdefgh12", 'API_KEY = "abcdefgh"', "PassWd:x", "é password==longenough", "x" * 50,
    "AKIA" + "Z9" * 6 + " AKIAshort", "a" * 31 + " " + "0f" * 16 + "g", "ſecret=abcdefghij toKen='12345678'", "", None,
    "token=ab token=abcdefgh", "api_key:AKIA" + "A" * 20,
]


def test_base_spans_are_those_of_the_patterns(spark, ratio):
    for row in secret_scan.scan(docs(spark, SECRETS), ratio).collect():
        want = plain_base(row.text or "")
        assert row.base_sha256 == hashlib.sha256(want.encode()).hexdigest(), row.text
        base = [s for s in row.spans.split(",") if s and not s.startswith("random")]
        assert ",".join(base) == want
        assert (row.n_assign, row.n_access, row.n_hex) == tuple(want.count(k) for k in ("assign", "access", "hex"))


def test_models_find_random_strings_and_leave_words_alone(spark, ratio):
    texts = [
        "see kQ7vXz2LpW9sRt4YbN8mHc3F here", "the internationalisation_of_everything_here was good",
        "https://example.com/en/some-long-readable-address/of/words", "JBSWY3DPEHPK3PXPJBSWY3DPEHPK3PXP",
    ]
    got = [r.n_random for r in secret_scan.scan(docs(spark, texts), ratio).orderBy("doc_id").collect()]
    assert got == [1, 0, 0, 1]


def test_short_random_strings_are_found_and_identifiers_are_not(spark, ratio):
    draw = random.Random(12)
    strings = ["".join(draw.choices(a, k=k)) for a in secret_scan.ALPHABETS for k in (16, 17, 18, 19) for _ in range(25)]
    found = [r.n_random for r in secret_scan.scan(docs(spark, [f"see {s} here" for s in strings]), ratio).collect()]
    assert sum(found) >= 0.97 * len(strings)
    plain = (
        "internationalization getElementById user_account_name 2024-01-01T12 2024-12-01/2025-01-31 20240131123000"
        " MAX_RETRY_COUNT CONSTANT_VALUE_NAME NullPointerException HTTPServerRequest ---------------- ================"
        " +49-170-1234567 978-3-16-148410-0 4737097684299439 Rindfleischetikettierung"
    )
    assert secret_scan.scan(docs(spark, [plain]), ratio).first().n_random == 0
    assert secret_scan.spans("see kQ7vXz2LpW9s here", ratio, 14.0) == [(4, 3, 16)]


def test_recall_by_length_and_false_alarms_on_the_words_of_a_table(spark, ratio):
    draw = random.Random(13)
    least = {8: 0.7, 9: 0.8, 10: 0.85, 11: 0.88, 12: 0.92, 13: 0.94, 14: 0.95, 15: 0.96, 16: 0.97, 17: 0.97, 18: 0.98, 19: 0.98}
    for size, share in least.items():
        made = ["".join(draw.choices(draw.choice(secret_scan.ALPHABETS), k=size)) for _ in range(400)]
        text = " ".join(made)
        found = [x for x in secret_scan.spans(text, ratio, 14.0) if x[1] == 3]
        assert len(found) >= share * len(made), (size, len(found))
        assert all(text[a:b] in made for a, _, b in found)
    texts = [r.text for r in spark.read.parquet(f"{SF}/documents.parquet").select("text").collect()]
    words = {w for t in texts for w in re.findall(r"[^\W\d_]{8,}", t) if w.isascii()}
    assert len(words) > 500
    alarms = [w for w in words if secret_scan.spans(w, ratio, 14.0)]
    # Letters alone that look like hex or keys may be such; ordinary words may not.
    assert len(alarms) <= 0.002 * len(words), alarms


def test_models_overlap_no_base_span(ratio):
    long = "kQ7vXz2LpW9sRt4YbN8mHc3F"
    text = " ".join([f"token={long}"] * 20 + [long] + ["0f" * 20, f"x={long}"])
    found = secret_scan.spans(text, ratio, 14.0)
    assert [x[1] for x in found] == [0] * 20 + [3, 2, 3]
    for (a, _, b), (c, _, _) in zip(found, found[1:]):
        assert b <= c


def test_whole_table_keeps_rows_and_clean_texts(spark):
    found = QUERIES["op1_secrets"](spark, SF)
    assert found.columns == ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_random"]
    found = found.collect()
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    assert len(found) == len(texts)
    for row in found:
        assert row.base_sha256 == hashlib.sha256(plain_base(texts[row.doc_id]).encode()).hexdigest()
        added = [s.split(":") for s in row.spans.split(",") if s.startswith("random")]
        assert row.n_random == len(added)
        # What the models add there is hex of 8 characters or more, cut off or alone.
        for _, a, b in added:
            assert re.fullmatch(r"[0-9a-fA-F]+", texts[row.doc_id][int(a) : int(b)])


def test_redaction_replaces_spans_only(spark, ratio):
    rows = secret_scan.redacted(docs(spark, ["a token=abcdefgh12 b", "plain", None, ""]), ratio).orderBy("doc_id").collect()
    assert [r.text for r in rows] == ["a [SECRET] b", "plain", None, ""]
    assert [r.n_chars for r in rows] == [12, 5, None, 0]


def test_untrained_models_add_nothing(spark):
    none = spark.createDataFrame([], "token string, secret boolean")
    flat = secret_scan.train(none)
    assert abs(flat).max() == 0
    row = secret_scan.scan(docs(spark, ["kQ7vXz2LpW9sRt4YbN8mHc3F"]), flat).first()
    assert row.n_random == 0


def test_language_held_out_accuracy(spark):
    got = QUERIES["op3_language"](spark, "/root/testdata/sf0.01").toPandas()
    table = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").toPandas()
    both = got.merge(table, on="doc_id")
    held = both[both.held_out]
    assert len(got) == len(table) and len(held) > 100
    assert (held.lang_pred == held.lang).mean() > 0.98
    assert got.score.between(0, 1).all()


def test_language_of_odd_texts(spark):
    texts = ["the and of that", "", None, "123 !! ½²_", "the and of " * 200_000]
    model = language.train(docs(spark, ["the and of"] * 4 + ["le la de des"] * 4).withColumn(
        "lang", F.when(F.col("doc_id") < 4, "en").otherwise("fr")), F.lit(False))
    rows = language.identify(docs(spark, texts).withColumn("score", F.lit("clash")), model).orderBy("doc_id").collect()
    assert [r.lang_pred for r in rows] == ["en", "und", "und", "und", "en"]
    assert rows[1].score == 0.0
    assert language.accepted(docs(spark, texts), model).count() == 2
    nothing = language.train(docs(spark, []), F.lit(False))
    assert language.identify(docs(spark, ["text"]), nothing).first().lang_pred == "und"


def test_codewords_differ():
    for n in (2, 3, 5, 12, 40):
        codes = language.codewords(n)
        gaps = (codes[:, None] != codes[None]).sum(axis=2)
        assert gaps[~(gaps == 0)].min() >= 1 and (gaps == 0).sum() == n


PAGE = (
    "<html><body><nav><ul><li><a href='/'>Home</a></li></ul></nav><div class='ad'>Buy it</div>"
    "<article><h1>On  &amp; off</h1><p><b>One<br>two\n three<p>Sh is.</p></article>"
    "<div class='comments'><p>First!</p></div><footer>&copy; me</footer></body></html>"
)


def test_pages(spark):
    pages = [PAGE, None, "", "plain", PAGE[:150], "<p>un<closed", "<article>" * 300 + "deep", PAGE.replace("Sh is.", "x " * 100_000)]
    rows = [(i, "u", p, "clash") for i, p in enumerate(pages)]
    table = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = html_text.extract(table, html_text.train()).orderBy("page_id").collect()
    assert got[0].text == "On & off\n\nOne two three\n\nSh is."
    assert got[1].text == got[2].text == "" and got[1].n_chars == 0
    assert got[3].text == "plain"
    assert got[7].n_chars > 199_000
    assert html_text.extract(table.limit(0), html_text.train()).count() == 0


def test_letters_that_grow_when_lowered_move_no_end():
    first = "It was a long day, and the boats came home late. " * 3
    page = f"<article><p>{chr(0x130) * 40}</p><SCRIPT>x</Script><p>{first}</p><p>tail</p></article>"
    texts = [text for _, text in html_text.Page(page).texts]
    assert texts == [chr(0x130) * 40, first.strip(), "tail"]


STORY = "These words of the story are many, and they go on for a while until it is told."
FAULTY = {
    f"<p title=it's>FIRST {STORY}</p><p>SECOND don't {STORY}</p><p>THIRD {STORY}</p>": ["FIRST", "SECOND don't", "THIRD"],
    f'<p class="x"">FIRST {STORY}</p><p>SECOND {STORY}': ["FIRST", "SECOND"],
    f'<p title="oops>FIRST {STORY}</p><p>SECOND {STORY}</p>': ["FIRST", "SECOND"],
    f"<p title='a>b' x = \"c>d\" y=e/>FIRST {STORY}</p>": ["FIRST"],
    f"<p>FIRST {STORY}</p><p>SECOND {STORY}</p><a href='x>": ["FIRST", "SECOND"],
}


@pytest.mark.parametrize("page", FAULTY)
def test_quotes_swallow_no_paragraph(page):
    assert html_text.main_texts([page], html_text.train()) == ["\n\n".join(f"{x} {STORY}" for x in FAULTY[page])]


def test_loose_text_formulas_and_fallbacks_stay():
    pages = {
        STORY: STORY, f"<b>{STORY}</b><br>{STORY}": f"{STORY} {STORY}", f"a < b {STORY} c > d": f"a < b {STORY} c > d",
        f"<html><head><title>t</title></head>{STORY}<p>{STORY}</p></html>": f"{STORY}\n\n{STORY}",
        f"<p>{STORY}</p>loose {STORY}<div>in {STORY}</div>": f"{STORY}\n\nloose {STORY}\n\nin {STORY}",
        f"<article><p>If <math><mi>x</mi><mo>=</mo><mn>1</mn></math> {STORY}</p></article>": f"If x=1 {STORY}",
        f"<article><p>{STORY} <svg><style>x</style><text>drawn</text></svg> <video>no film</video></p></article>": f"{STORY} drawn no film",
        f"<article><p>{STORY}</p><script>if (a<b) '</p>'</script><style>p</style></article>": STORY,
    }
    assert html_text.main_texts(list(pages), html_text.train()) == list(pages.values())


def test_decoding_is_the_best_of_all_choices():
    """Every choice of kept and dropped nodes of small trees, without a kept node below a dropped one."""
    draw = random.Random(6)
    for _ in range(60):
        n = draw.randint(2, 11)
        page = html_text.Page("")
        page.tag, page.parent = ["#page"] + ["p"] * (n - 1), [-1] + [draw.randrange(i) for i in range(1, n)]
        margin = np.array([draw.uniform(-12, 12) for _ in range(n)])
        clipped = np.clip(margin, -8, 8)
        best = max(
            sum(clipped[i] for i in range(1, n) if bits >> i & 1)
            for bits in range(1, 1 << n, 2)
            if all(bits >> page.parent[i] & 1 for i in range(1, n) if bits >> i & 1)
        )
        keep = page.kept(margin)
        assert all(keep[page.parent[i]] for i in range(1, n) if keep[i])
        assert abs(clipped[1:][keep[1:]].sum() - best) < 1e-9


def test_held_out_pages_and_hierarchy():
    trees = html_text.train()
    good = 0
    for page, label in html_text.labelled(60, seed=991):
        keep = page.kept(trees.margin(page.features()))
        for i in range(1, len(keep)):
            assert not keep[i] or keep[page.parent[i]]
        good += all(bool(keep[n]) == (label[n] == 1) for n, _ in page.texts if n)
    assert good >= 57


def plain_licenses(texts):
    split = lambda t: [w for w in re.split(r"[^\w]|_", (t or "").lower()) if w]
    grams = lambda w: [tuple(w[i : i + 5]) for i in range(len(w) - 4)]
    out = set()
    for i, text in enumerate(texts):
        own = grams(split(text))
        for name, known in license_scan.TEMPLATES:
            t = set(grams(split(known)))
            step = max(8, 1 << (len(t) - 1).bit_length())
            for at in range(0, len(own), step):
                share = len(t & set(own[at : at + 2 * step])) / len(t)
                if share >= 0.8:
                    out.add((i, name))
    return out


def test_licenses_against_all_windows(spark):
    mit = license_scan.TEMPLATES[2][1]
    texts = [
        "x " * 50 + "Released under the MIT License. " + "y " * 50, mit, mit.replace("charge", "cost"), mit[: len(mit) // 2],
        None, "", "one two", "word " * 30_000 + license_scan.TEMPLATES[5][1], ("Licensed under CC BY-NC 4.0. " * 40),
    ]
    got = license_scan.licenses(docs(spark, texts), license_scan.templates(spark)).collect()
    assert {(r.doc_id, r.license) for r in got} == plain_licenses(texts)
    assert license_scan.licenses(docs(spark, []), license_scan.templates(spark)).count() == 0
    assert license_scan.licenses(docs(spark, texts), license_scan.templates(spark).limit(0)).count() == 0


URLS = [
    ("http://A.Example.NET/en/1?x=1#y", "a.example.net", "/en/1", "example.net/en/"), ("https://x.net", "x.net", "", None),
    ("http://x.net/", "x.net", "/", "net/"), ("http://notexample.com/de/", "notexample.com", "/de/", None),
    ("s://example.com/de/a?b=/fr/", "example.com", "/de/a", "example.com/de/"), ("http://b.org/fr", "b.org", "/fr", None),
    ("http://b.org/fr/", "b.org", "/fr/", "org/fr/"), ("no scheme", "", "", None), (None, "", "", None), ("", "", "", None),
    ("http://É.net/x", "É.net", "/x", "net/"), ("http://x.com#/net/", "x.com", "", None), ("x" * 50_000, "", "", None),
]


def test_url_parts_and_rules(spark):
    rows = [(i, u, "clash") for i, (u, *_) in enumerate(URLS)]
    table = spark.createDataFrame(rows, "page_id long, url string, host string")
    model = url_filter.train(url_filter.by_terms(table).limit(0))
    got = url_filter.judge(table, model, url_filter.RULES).orderBy("page_id").collect()
    assert [(r.host, r.path, r.rule) for r in got] == [u[1:] for u in URLS]
    assert all(r.verdict == ("block" if r.rule in ("net/", "example.com/de/") else "allow") for r in got)


def test_url_trees_learn_the_labels(spark):
    got = QUERIES["op4_urls"](spark, "/root/testdata/sf0.01").where("rule is null").toPandas()
    listed = got.host.str.contains("casino|bets|pills|ads-track")
    assert ((got.verdict == "block") == listed).mean() > 0.97


def test_suffix_statistics_cover_all_urls(spark):
    rows = [(f"https://h{i}.site{i % 300}.org/a/{i}", i % 300 < 30) for i in range(3000)]
    table = spark.createDataFrame([*rows, (None, True), ("https://x.org/", None)], "url string, block boolean")
    model = url_filter.train(table, rows=200, rounds=3)
    counts = {r.end_2: (r.n_2, r.sum_2) for r in model.suffixes[2].collect()}
    assert counts == {f"site{k}.org": (10, 10.0 if k < 30 else 0.0) for k in range(300)}
    assert model.share == 0.1
    fresh = spark.createDataFrame([(f"https://new.site{k}.org/b", k) for k in range(300)], "url string, k int")
    got = {r.k: r.verdict for r in url_filter.judge(fresh, model, []).collect()}
    assert got == {k: "block" if k < 30 else "allow" for k in range(300)}


def test_languages_are_the_most_frequent_ones_and_decoding_is_the_plain_sum(spark):
    words = {"aa": "alpha beta gamma", "bb": "uno dos tres", "cc": "wir sind hier", "dd": "seldom seen"}
    rows = [(i, words[k], k, "s", 1) for i, k in enumerate(["aa"] * 9 + ["bb"] * 7 + ["cc"] * 7 + ["dd"])]
    rows += [(900 + i, "noise of names", f"x{i}", "s", 1) for i in range(40)]
    model = language.train(spark.createDataFrame(rows, TEXT), F.lit(False), most=3)
    assert model.names == ["aa", "bb", "cc"]
    for text in (*words.values(), "alpha uno", "Hier sind TRES", "q"):
        grams = [int(g) for part in language._grams(text) for g in part]
        sums = [sum(float(model.weights[g][b]) for g in grams) / len(grams) for b in range(model.codes.shape[1])]
        losses = []
        for code in model.codes:
            margins = [c * s / scale for c, s, scale in zip(code, sums, model.scale)]
            losses.append(sum(t * np.log1p(np.exp(-4 * m)) for t, m in zip(model.trust, margins)))
        chances = [np.exp(-4 * (x - min(losses))) for x in losses]
        best = max(range(3), key=lambda i: chances[i])
        name, score, _ = language.judge(text, model)
        assert name == model.names[best] and abs(score - chances[best] / sum(chances)) < 1e-6
