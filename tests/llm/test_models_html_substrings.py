"""Language identification, language model, HTML extraction, substring dedup, the pipeline."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from sparksweep.llm import html_extraction, language_id, language_model, queries, substring_dedup
from sparksweep.llm.batch import RollingHash
from tests.llm.helpers import alnum_words, crc, docs, near_groups, repeated_bytes


def test_languages_on_held_out_documents(spark, sf_dir):
    got = queries.QUERIES["op7_language_id"](spark, sf_dir).join(
        spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "lang"), "doc_id").collect()
    held = [r for r in got if r["held_out"]]
    assert all(r["held_out"] == (crc(r["doc_id"], 3) == 1) and 0 <= r["score"] <= 1 for r in got)
    assert sum(r["lang"] == r["lang_pred"] for r in held) >= 0.97 * len(held) > 0


def test_languages_of_odd_texts(spark):
    texts = [None, "", "123 !? 45", "The cat and a dog sat there!", "THE CAT", "der Hund und die Katze", "é", "x" * 200000, "The cat and a dog sat there!"]
    train = docs(spark, [(i, "the cat and a dog sat there", "s", "en") for i in range(5)] +
                 [(10 + i, "der Hund und eine Katze saß dort", "s", "de") for i in range(5)] + [(20, None, "s", "en"), (21, "quoi", "s", None), (22, "12", "s", "fr")])
    model = language_id.fit(train)
    assert set(model.langs) == {"en", "de"}
    df = spark.createDataFrame([(i, t, "old") for i, t in enumerate(texts)], "doc_id int, text string, SCORE string")
    rows = language_id.predict(df, model).orderBy("doc_id").collect()
    assert [r["lang_pred"] for r in rows[:3]] == ["und"] * 3 and {r["score"] for r in rows[:3]} == {0.0}
    assert [r["lang_pred"] for r in rows[3:6]] == ["en", "en", "de"] and not rows[3]["rejected"] and rows[7]["rejected"]
    assert rows[8]["score"] == rows[3]["score"]
    nothing = language_id.fit(train.where("false"))
    assert {r["lang_pred"] for r in language_id.predict(df, nothing).collect()} == {"und"}
    assert language_id.predict(df.where("false"), model).count() == 0


def test_more_languages_than_fit_one_block(spark, monkeypatch):
    rng = random.Random(31)
    names = [f"l{i}" for i in range(5)]
    words = {x: ["".join(rng.choice("abcdefghijklmnop") for _ in range(6)) for _ in range(20)] for x in names}
    text = lambda x: " ".join(rng.choice(words[x]) for _ in range(12))
    train = docs(spark, [(10 * i + j, text(x), "s", x) for i, x in enumerate(names) for j in range(6)])
    df = spark.createDataFrame([(i, text(names[i % 5]) if i else None, "old") for i in range(20)], "doc_id int, text string, SCORE string")
    whole = language_id.fit(train)
    expected = language_id.predict(df, whole).orderBy("doc_id").collect()
    monkeypatch.setattr(language_id, "MODEL_BYTES", 8 * language_id.DIMS * 4)
    model = language_id.fit(train)
    assert len(model.later) >= 1 and len(model.langs) <= 8 and set(whole.langs) == set(names)
    got = language_id.predict(df, model).orderBy("doc_id").collect()
    assert [r["lang_pred"] for r in got] == ["und"] + [names[i % 5] for i in range(1, 20)]
    for a, b in zip(got, expected, strict=True):
        assert (a["lang_pred"], a["rejected"], a["text"]) == (b["lang_pred"], b["rejected"], b["text"]) and abs(a["score"] - b["score"]) < 1e-6


def plain_scores(rows, order_two=True):
    end = b"\x00end"
    tokens = [re.findall(rb"[^\x20\x09-\x0D]+", (t or "").encode().lower()) + [end] for _, t, _ in rows]
    one, two = Counter(), Counter()
    for (_, _, held), ts in zip(rows, tokens, strict=True):
        if not held:
            one.update(ts)
            two.update(zip([end, *ts[:-1]], ts, strict=True))
    n, v = sum(one.values()), len(one)
    typical = lambda c: 0.0 if not c else ((lo := 2.0 ** int(math.log2(c))) + max(lo, 2 * lo - 1)) / 2
    out = []
    for ts in tokens:
        base = sum(math.log10((one[t] + 0.5) / (n + 0.5 * (v + 1))) for t in ts)
        s, before = 0.0, end
        for t in ts:
            p = (typical(one[t]) + 0.5) / (n + 0.5 * (v + 1))
            both = typical(two[before, t])
            s += math.log10(min(1.0, (both + 20 * p) / (max(typical(one[before]), both) + 20)))
            before = t
        out.append((len(ts), sum(one[t] > 0 for t in ts), n, base, s))
    return out


@pytest.mark.parametrize("top", [1 << 18, 3])
def test_language_model_scores(spark, top):
    rng = random.Random(17)
    rows = [(i, " ".join(f"W{int(rng.paretovariate(0.7)) % 900}" for _ in range(rng.randrange(1, 80))), i % 5 == 1) for i in range(200)]
    rows += [(300, None, False), (301, "", True), (302, "\t \n", False), (303, "unseen Words", True), (304, "w1 " * 30000, False), (305, "É é", True), rows[0], rows[0]]
    df = spark.createDataFrame([(*r, 0) for r in rows], "doc_id int, text string, held boolean, SCORE int").repartition(3)
    model = language_model.train(df.where("not held"), top=top)
    got = language_model.score(df, model)
    assert sorted(got.columns) == sorted(["doc_id", "held", *language_model.ADDED])
    by = sorted(got.collect(), key=lambda r: (r["doc_id"], r["base_score"]))
    expected = sorted(zip([r[0] for r in rows], plain_scores(rows), strict=True))
    off = 0
    for r, (d, (n, known, all_tokens, base, s)) in zip(by, expected, strict=True):
        assert (r["doc_id"], r["n_tokens"], r["n_known"], r["train_tokens"]) == (d, n, known, all_tokens)
        assert abs(r["base_score"] - base) < 1e-6 * max(1, abs(base)) and r["score"] <= 0
        off += abs(r["score"] - s) > 1e-6 * max(1, abs(s))
    assert off <= len(rows) // 20  # texts that met a false positive of the filter


def test_language_model_of_nothing(spark):
    df = docs(spark, [(1, "a b"), (2, None)])
    model = language_model.train(df.where("false"))
    rows = language_model.score(df, model).orderBy("doc_id").collect()
    assert [(r["n_tokens"], r["n_known"], r["train_tokens"], r["base_score"]) for r in rows] == [(3, 0, 0, 0.0), (1, 0, 0, 0.0)]
    assert language_model.score(df.where("false"), model).count() == 0


def test_language_model_in_many_blocks(spark, monkeypatch):
    rng = random.Random(41)
    rows = [(i, " ".join(f"w{int(rng.paretovariate(0.5)) % 3000}" for _ in range(60)), i % 5 == 1, i) for i in range(120)]
    df = spark.createDataFrame(rows, "doc_id int, text string, held boolean, row int").withColumns({"_row": F.lit("a"), "unit": F.lit("b"), "ID": F.lit("c")})
    model = language_model.train(df.where("not held"), top=50)
    whole = language_model.score(df, model)
    assert whole.columns == ["doc_id", "held", "row", "_row", "unit", "ID", *language_model.ADDED]
    monkeypatch.setattr(language_model, "BLOCK_BYTES", 1)  # each of the 8 segments is a block
    monkeypatch.setattr(language_model, "UNIT_BYTES", 2000)
    assert sorted(language_model.score(df.repartition(5), model).collect()) == sorted(whole.collect())
    by = sorted(whole.collect())
    assert [(r["row"], r["_row"], r["unit"], r["ID"]) for r in by] == [(i, "a", "b", "c") for i in range(120)]


def test_filter_never_forgets_and_seldom_invents():
    rng = np.random.default_rng(1)
    keys = rng.integers(0, 1 << 63, 4000, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    counts = rng.integers(1, 3000, 4000)
    parts = language_model.fill(keys, counts, 64 << 10, 2.0)[None, :]
    got = language_model.probe(parts, keys, 2.0)
    assert (got >= language_model.typical(language_model.levels(counts, 2.0), 2.0)).all()
    others = rng.integers(0, 1 << 63, 4000, dtype=np.uint64) * np.uint64(2)
    assert (language_model.probe(parts, others, 2.0) > 0).mean() < 0.1


def test_filter_keeps_its_density_as_the_input_grows(spark, monkeypatch):
    monkeypatch.setattr(language_model, "SEGMENT_BYTES", 1 << 14)  # more segments with more input
    rng, seen = random.Random(23), []
    for n in (100, 1000):
        rows = [(i, " ".join(f"w{int(rng.paretovariate(0.5)) % 50_000}" for _ in range(60)), i % 5 == 1) for i in range(n)]
        df = spark.createDataFrame(rows, "doc_id int, text string, held boolean").repartition(3)
        model = language_model.train(df.where("not held"))
        parts = [np.frombuffer(r["filter"], np.uint8) for r in spark.read.parquet(model.path).select("filter").collect()]
        got = {r["doc_id"]: r["score"] for r in language_model.score(df, model).collect()}
        off = [abs(got[d] - s) / -s for (d, _, _), (*_, s) in zip(rows, plain_scores(rows), strict=True)]
        seen.append((np.unpackbits(np.concatenate(parts)).mean(), sum(map(len, parts)), sum(off) / n, model.segments))
    (density, size, error, segments), (density10, size10, error10, segments10) = seen
    assert 0.1 < density < 0.25 and abs(density - density10) < 0.02 and segments10 > segments
    assert size10 > 5 * size and error < 1e-3 and error10 < 1e-3


PAGE = """<!DOCTYPE html><html lang=en><head><title>No</title><style>p{x:"</p>"}</style><script>var t="<p>no</p>";</script></head>
<body class="with-sidebar"><header><div>Site name</div></header><div id="cookie-notice"><p>We use cookies a lot here</p></div>
<nav><ul><li><a href="/a">Home page</a></li></ul></nav><!-- <p>no</p> --><div class="ad">Buy it now today</div>
%s<h1>Title &amp; caf&eacute;</h1><p>First <b>bold</b>er para&#8217;s   text<br>goes
on.<p>Second, with a <a href="x">linked word</a> inside.</p><aside>Not this one</aside><div class="social-share">Share this now</div><ul><li>one<li>two</ul>%s
<section id="comments"><div class="comment"><p>I like this very much indeed dear friends</p></div></section>
<form><label>Your mail</label><input name=q></form><footer>All rights reserved by us</footer></body></html>"""
EXPECTED = "Title & café\n\nFirst bolder para’s text goes on.\n\nSecond, with a linked word inside.\n\none\n\ntwo"


@pytest.mark.parametrize("box", [("<article>", "</article>"), ("<main>", "</main>"), ('<div class="content">', "</div>"), ("", ""), ("<article>", "")])
def test_article_of_many_layouts(box):
    page = PAGE % box
    weights = html_extraction.weights_from(html_extraction.count_features(PAGE % ("<article>", "</article>")))
    for w in (weights, html_extraction.DEFAULT):
        assert html_extraction.extract(page, w) == EXPECTED
    assert html_extraction.extract(page.replace("<nav>", "<nav><div>").replace("</nav>", ""), weights).endswith("two") or box[0] not in ("<article>", "<main>")


@pytest.mark.parametrize(("start", "end"), [
    ("<article>", "</article>"), ('<article class="post tag-social">', "</article>"), ('<main class="search-open">', "</main>"),
    ('<div id="page" class="has-sidebar"><div>', "</div></div>")])
def test_names_made_from_titles_lose_nothing(start, end):
    words = "It says here what others found out before. " * 4
    parts = [("h1", "", "Title"), ("p", "", words), ("section", ' id="related-work"', words), ("h2", ' id="search-results"', "Results"),
             ("section", ' id="how-to-share-data"', words), ("p", "", words)]
    inner = "".join(f"<{n}{a}>{t}</{n}>" for n, a, t in parts)
    page = f'<html><body><nav>Home</nav><div class="site-menu">Home</div>{start}{inner}<div class="social-share">Share</div>{end}<footer>Us</footer></body></html>'
    weights = html_extraction.weights_from(html_extraction.count_features(PAGE % ("<article>", "</article>")))
    for w in (weights, html_extraction.DEFAULT):
        assert html_extraction.extract(page, w) == "\n\n".join(t.strip() for _, _, t in parts)


def test_the_scan_finds_the_text_without_any_names(spark, sf_dir):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    weights = html_extraction.fit(pages)
    assert weights != html_extraction.DEFAULT and not {"article", "main"} & set(weights)
    htmls = [r["html"] for r in pages.select("html").collect()]
    bare = [re.sub(r' (?:class|id|role)="[^"]*"', "", re.sub(r"(</?)(?:article|main|nav|footer|header|aside)\b", r"\1div", h)) for h in htmls]
    same = sum(html_extraction.extract(b, weights) == html_extraction.extract(h, weights) for b, h in zip(bare, htmls, strict=True))
    assert same >= 0.9 * len(htmls) > 0


def test_nothing_of_the_main_text_is_lost(spark, sf_dir):
    words = ("It says here what others found out before. " * 50).strip()
    fitted = html_extraction.fit(spark.read.parquet(f"{sf_dir}/pages.parquet"))
    box = f'<aside>{"<p>Not this one at all</p>" * 20}</aside><div class="share">Share</div>'
    for w in (fitted, html_extraction.DEFAULT):
        teaser = html_extraction.extract(f"<body><div>{words}</div><article>Read more of this</article></body>", w)
        assert teaser.startswith(words)
        assert html_extraction.extract(f"<body><article><p>{words}</p>{box}<p>End.</p></article><nav>Home</nav></body>", w) == f"{words}\n\nEnd."
        assert html_extraction.extract(f"<body><article>{box}<p>One.</p>{box}<p>{words}</p></article></body>", w) == f"One.\n\n{words}"
        assert html_extraction.extract("<body><article><p>We see <math><mi>a</mi><mo>+</mo><mi>b</mi></math> here</p></article></body>", w) == "We see a+b here"
    hidden = f"<body><article><p>{words}</p><p hidden>no</p><div aria-hidden='true'><p>no</p></div><span style='display: none'>no</span></article></body>"
    assert html_extraction.extract(hidden, fitted) == words


def test_region_is_the_best_run():
    rng = random.Random(19)
    for _ in range(200):
        s = [rng.choice([-3, -1, -0.5, 1, 2]) for _ in range(rng.randrange(12))]
        a, b = html_extraction.region(s)
        best = max([sum(s[i:j]) for i in range(len(s)) for j in range(i + 1, len(s) + 1)] or [0])
        assert sum(s[a:b]) == max(0, best) and (a < b) == (best > 0)


def test_pages_of_all_kinds(spark, sf_dir):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    weights = html_extraction.fit(pages)
    odd = [None, "", "plain text only", "<p>unclosed", "<<<>>> & &bogus; <p", "<script>never closed <p>x</p>", "<p>" + "word " * 100000, "<div>" * 3000 + "deep", "plain text only"]
    df = spark.createDataFrame([(i, "u", h, "old") for i, h in enumerate(odd)], "page_id long, url string, html string, TEXT string")
    rows = html_extraction.extract_pages(df, weights).orderBy("page_id").collect()
    assert [r["text"] for r in rows[:3]] == ["", "", "plain text only"] and rows[3]["text"] == "unclosed" and rows[5]["text"] == ""
    assert rows[6]["n_chars"] == len("word " * 100000) - 1 and rows[7]["text"] == "deep" and rows[8]["text"] == rows[2]["text"]
    assert all(r["n_chars"] == len(r["text"]) for r in rows)
    assert html_extraction.extract_pages(df.where("false"), weights).count() == 0
    assert html_extraction.fit(pages.where("false")) == html_extraction.DEFAULT
    # the tables' pages: headings and paragraphs of the article
    got = {r["page_id"]: r["text"] for r in queries.QUERIES["op8_html_extraction"](spark, sf_dir).collect()}
    import html as entities
    for r in pages.collect():
        inner = re.search(r"<article>(.*?)</article>", r["html"], re.S)[1]
        parts = [" ".join(entities.unescape(re.sub(r"</?b>", "", x.replace("<br>", " "))).split()) for x in re.split(r"</?(?:h1|p)>", inner)]
        assert got[r["page_id"]] == "\n\n".join(x for x in parts if x)


def substring_texts():
    rng = random.Random(23)
    text = lambda n: "".join(rng.choice("abcdefgh éß\n") for _ in range(n))
    shared, third = text(700), text(199)
    texts = [None, "", "short", text(199), third, third, text(2000), text(300) + shared + text(300), shared[100:500], text(50) + shared[333:533],
             "a" * 1500, "ab" * 700, "period of seven " * 60, shared + "x" + shared, text(210) * 2, "é" * 300, text(100000)]
    copy = text(900)
    texts += [copy, copy, copy[:450] + "#" + copy[450:]]
    for _ in range(25):  # near copies of one text, and a common passage
        w = list(copy)
        for _ in range(rng.randrange(5)):
            w[rng.randrange(len(w))] = rng.choice("XYZ")
        texts.append("".join(w))
        texts.append(text(rng.randrange(260)) + shared[:260] + text(rng.randrange(260)))
    return texts


@pytest.mark.parametrize("hot", [20_000, 3])
def test_repeated_bytes(spark, hot):
    texts = substring_texts()
    rows = [(i, t, "x") for i, t in enumerate(texts)] + [(None, texts[9], "x"), (3, texts[3], "x"), (3, texts[3], "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, N_SPANS string").repartition(3)
    got = substring_dedup.remove_repeats(df, hot=hot, keep_text=False)
    assert sorted(got.columns) == sorted(["doc_id", *substring_dedup.ADDED])
    found = sorted(((r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in got.collect()), key=repr)
    plain = repeated_bytes([r[1] for r in rows])
    assert found == sorted(((r[0], *p) for r, p in zip(rows, plain, strict=True)), key=repr)
    assert substring_dedup.remove_repeats(df.where("false")).count() == 0


def test_columns_find_equal_windows():
    rng = random.Random(29)
    for _ in range(20):
        strings, rel = [], []
        base = bytes(rng.choice(b"ab") for _ in range(60))
        for _ in range(rng.randrange(1, 12)):
            a, b = rng.randrange(0, 20), rng.randrange(40, 60)
            s = bytearray(base[a:b])
            s[rng.randrange(len(s))] = rng.choice(b"abc")
            strings.append(bytes(s))
            rel.append(20 - a)
        got = substring_dedup.repeated_windows(strings, np.array(rel), size=10)
        seen = Counter((s[p: p + 10], p - r) for s, r in zip(strings, rel, strict=True) for p in range(len(s) - 9))
        for s, r, f in zip(strings, rel, got, strict=True):
            assert f.tolist() == [seen[s[p: p + 10], p - r] > 1 for p in range(len(s) - 9)]


def test_pieces_cover_all_windows():
    rng = np.random.default_rng(3)
    rows = [rng.integers(97, 100, n).astype(np.uint8) for n in (0, 10, 199, 200, 201, 5000, 0, 900)] + [np.full(1000, 97, np.uint8)]
    buf, offs = np.concatenate(rows), np.cumsum([0, *map(len, rows)])
    row, p1, p2, a, _ = substring_dedup.pieces(buf, offs, RollingHash())
    windows = [p for x, y in zip(p1, p2, strict=True) for p in range(x, y)]
    assert windows == [p for s, e in zip(offs[:-1], offs[1:], strict=True) for p in range(s, max(s, e - 199))]
    assert ((a >= p2 - 1) & (a + 64 <= p1 + 200)).all() and (offs[row] <= p1).all()


def test_pipeline_stages_take_effect(spark, sf_dir):
    table = spark.read.parquet(f"{sf_dir}/documents.parquet")
    names = ["doc_id", "text", "lang", "source", "n_chars"]
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality rules", "line dedup", "n-gram jaccard join", "benchmark decontamination", "mixing to target weights"]
    stage = dict(corpus_pipeline.STAGES)
    odd = docs(spark, [(10**6, None), (10**6 + 1, ""), (None, "no id " * 40), (10**6 + 2, " ".join(f"word{i}" for i in range(90)), None)])
    both = table.select(*names).unionByName(odd).withColumn("extra", F.lit(1))
    kept = stage["quality rules"](spark, both, sf_dir)
    assert kept.columns == names and 10**6 + 2 in {r["doc_id"] for r in kept.collect()}
    lines = stage["line dedup"](spark, both, sf_dir)
    assert lines.columns == names and lines.count() == both.count()
    assert lines.where("length(text) != n_chars").count() == 0
    near = stage["n-gram jaccard join"](spark, both, sf_dir)
    rows = [(r["doc_id"] if r["doc_id"] is not None else -1, r["text"]) for r in both.collect()]
    assert near.columns == names and near.count() == len({g for g, _ in near_groups(rows).values()})
    clean = stage["benchmark decontamination"](spark, both, sf_dir)
    items = [alnum_words(r["text"]) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    grams = {tuple(w[i: i + 10]) for w in items for i in range(max(0, len(w) - 9))}
    leaked = sum(any(tuple(w[i: i + 10]) in grams for i in range(len(w))) for w in (alnum_words(t) for _, t in rows))
    assert clean.columns == names and both.count() - clean.count() == leaked > 0
    for name, fn in corpus_pipeline.STAGES:
        assert fn(spark, both.where("false"), sf_dir).count() == 0, name


@pytest.mark.parametrize("page", [
    "<p class=\"a>" * 80_001, "<p class='a \">" * 70_001, "<a b='c>" * 100_001 + "\"", "<b>" * 200_000 + "</i>" * 100_000, "<!-- x " * 100_000, "<" * 900_000],
    ids=["double", "both", "single", "unclosed", "comments", "brackets"])
def test_odd_markup_of_a_megabyte_takes_seconds_at_most(page):
    import time
    start = time.process_time()
    assert isinstance(html_extraction.extract(page, html_extraction.DEFAULT), str)
    assert time.process_time() - start < 5


def test_a_quote_without_a_partner_ends_with_its_tag():
    page = "<html><body><article><p title=\"x>one two three four</p><p>five six seven eight</p></article></body></html>"
    assert html_extraction.extract(page, html_extraction.DEFAULT) == "one two three four\n\nfive six seven eight"
