"""Quality rules, line dedup, URL filters."""

import fnmatch
import random
import re

import numpy as np

from sparksweep.llm import line_dedup, quality_rules, url_filters
from tests.llm.helpers import docs


def measured(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    grams = [tuple(words[i: i + 3]) for i in range(len(words) - 2)]
    hit = {p for i, g in enumerate(grams) if grams.count(g) > 1 for p in (i, i + 1, i + 2)}
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return {"n_words": len(words), "word_chars": sum(map(len, words)), "n_symbols": len(re.findall(r"[#*$%&|<>]", text or "")),
            "n_lines": len(lines), "n_dup_lines": len(lines) - len(set(lines)), "n_repeat_words": len(hit)}


def test_rules_match_their_definition(spark):
    rng = random.Random(3)
    texts = [None, "", " \t\n ", "one", "a b a b a b a", "x\nx\n\n x\nx", "é#ü *ß*\u00a0z", "\u2003wide\x0bspace",
             "same line\n" * 40, "w " * 30000, " ".join(rng.choice("abcd") for _ in range(300)),
             " ".join(f"word{rng.randrange(60)}" for _ in range(400)), "word " * 49, "alpha beta gamma delta " * 13]
    texts += [texts[4], texts[4]]
    # an extra column with a clashing name is replaced, another one stays
    df = spark.createDataFrame([(i, t, -1, "x") for i, t in enumerate(texts)], "doc_id int, text string, N_WORDS int, other string")
    rows = {r["doc_id"]: r for r in quality_rules.apply_policy(quality_rules.ledger(df)).collect()}
    assert len(rows) == len(texts)
    for i, t in enumerate(texts):
        m = measured(t)
        assert {k: rows[i][k] for k in m} == m, (i, t and t[:40])
        failed = m["n_words"] < 50 or 100 * m["n_repeat_words"] > 50 * m["n_words"]
        assert rows[i]["base_failed"] == failed and rows[i]["other"] == "x"
        assert not (failed and rows[i]["kept"])
        for bit, (_, rule) in enumerate(quality_rules.RULES):
            assert bool(rows[i]["fail_bits"] >> bit & 1) == eval(rule.replace("=", "==").replace("<==", "<="), {}, m), rule


def test_ablation_counts_from_bits(spark):
    bits = [0, 0, 1, 2, 3, 4, 5, 64, 8]
    led = spark.createDataFrame([(b,) for b in bits], "fail_bits long")
    for r in quality_rules.ablation(led).collect():
        p, one = quality_rules.mask(quality_rules.POLICIES[r["policy"]]), quality_rules.mask([r["rule"]])
        assert (r["n_docs"], r["n_failed"], r["n_only"], r["n_kept_without"]) == (
            len(bits), sum(bool(b & p & one) for b in bits), sum(b & p == one for b in bits), sum(b & p & ~one == 0 for b in bits))
    assert quality_rules.ablation(led.where("false")).count() == 0


def test_keep_equals_policy_and_empty_table(spark):
    df = docs(spark, [(1, "clean words here and there " * 3 + " ".join(f"w{i}" for i in range(60))), (2, "short"), (3, None), (4, "")])
    assert [r["doc_id"] for r in quality_rules.keep(df).collect()] == [1]
    assert quality_rules.keep(df).columns == df.columns
    assert quality_rules.ledger(df.where("false")).count() == 0


def plain_lines(rows, min_sites, min_chars=12):
    norm = lambda x: re.sub(r"[ \t\r\f\x0b]+", " ", re.sub("[A-Z]", lambda m: m[0].lower(), x)).strip(" ")
    sites, first = {}, {}
    for d, t, s in rows:
        for x in (t or "").split("\n"):
            k = norm(x)
            if len(k) >= min_chars:
                sites.setdefault(k, set()).add(s)
                if d is not None:
                    first[k] = min(first.get(k, d), d)
    bad = {k for k, v in sites.items() if len(v) >= min_sites}
    out = []
    for d, t, s in rows:
        if t is None:
            out.append((d, 0, 0, None))
            continue
        ls = t.split("\n")
        kept = [x for x in ls if norm(x) not in bad or d is not None and first.get(norm(x)) == d]
        out.append((d, len(ls), len(ls) - len(kept), "\n".join(kept)))
    return sorted(out, key=repr)


def test_lines_by_spread(spark):
    rng = random.Random(5)
    lines = [f"Shared   Line number {i}\tof the site" for i in range(12)] + ["short", "", "   "]
    rows = [(i, "\n".join([*rng.sample(lines, 6), f"own line of document {i}"]), f"site{i % 7}") for i in range(60)]
    rows += [(200, None, "site1"), (201, "", "site2"), (None, rows[0][1], None), rows[5], rows[5], (202, "x" * 300000 + "\n" + lines[0], "site3")]
    df = spark.createDataFrame([(d, t, s, 1, "keep") for d, t, s in rows], "doc_id long, text string, source string, n_removed int, other string")
    for sites in (2, 5, 7, 8):
        got = line_dedup.remove_boilerplate(df, min_sites=sites)
        assert got.columns.count("n_removed") == 1 and "other" in got.columns
        found = sorted([(r["doc_id"], r["n_lines"], r["n_removed"], r["clean_text"]) for r in got.collect()], key=repr)
        assert found == plain_lines(rows, sites), sites
    assert line_dedup.remove_boilerplate(df.where("false")).count() == 0


def test_sketches_agree_with_exact_counts_for_many_sites(spark):
    n = 3000
    df = spark.range(n).selectExpr("id as doc_id", "concat('a line on every site', char(10), 'a line on some sites ', cast(id % 3 as string)) as text",
                                   "cast(id as string) as source")
    lines = line_dedup.line_table(df)
    for least, expected in ((900, 4), (1100, 1), (n, 1), (n + 1, 0), (1000, 4), (1001, 1)):
        assert line_dedup.boilerplate(lines, min_sites=least).count() == expected, least


def test_automaton_agrees_with_patterns():
    rng = random.Random(7)
    globs = ["*.com/**", "**a**b", "*a*b*", "ab/**", "*", "**", ".x/y", "**/c", "long" * 30 + "**", "a*/b*/**"]
    urls = ["", "a", "ab", "ab/", ".x/y", "x.com/q", "x/y.com/q", "a/b/c", "aab", "ab/c", "long" * 30, "long" * 30 + "/x", "/" * 200]
    urls += ["".join(rng.choice("ab/c.") for _ in range(rng.randrange(9))) for _ in range(300)]
    raw = [u.encode() for u in urls]
    buf = np.frombuffer(b"".join(raw), np.uint8)
    hits = url_filters.WildcardAutomaton(globs).match(buf, np.cumsum([0, *map(len, raw)]))
    for j, g in enumerate(globs):
        rule = "".join(".*" if p == "**" else "[^/]*" if p == "*" else re.escape(p) for p in re.findall(r"\*\*|\*|[^*]+", g))
        assert [bool(h) for h in hits[:, j]] == [re.fullmatch(rule, u, re.S) is not None for u in urls], g
    assert fnmatch.fnmatch("ab", "a*")  # the single-star form agrees where there is no slash
    assert url_filters.WildcardAutomaton([]).match(buf, np.array([0, 3])).shape == (1, 0)


def test_urls_beside_columns_named_like_helpers(spark):
    df = spark.createDataFrame([(1, "http://example.com/en/x", "a", "b", "c")], "page_id long, url string, canonical string, _canonical string, HOST string")
    row = url_filters.judge(df).first().asDict()
    assert list(row)[:4] == ["page_id", "url", "canonical", "_canonical"] and (row["canonical"], row["_canonical"], row["host"]) == ("a", "b", "example.com")
    assert row["verdict"] == "block"


def test_urls_of_all_kinds(spark):
    rows = [(None, "", "", None, "allow"), ("no scheme", "", "", None, "allow"), ("http://A.COM/En/?x", "a.com", "/En/", "com/", "allow"),
            ("http://com/", "com", "/", "com/", "allow"), ("http://xcom/", "xcom", "/", None, "allow"),
            ("http://example.com/en/1", "example.com", "/en/1", "example.com/en/", "block"),
            ("https://m.example.com/en/#t", "m.example.com", "/en/", "example.com/en/", "block"),
            ("https://www.example.com/en/a?b=/en/", "www.example.com", "/en/a", "www.example.com/en/", "allow"),
            ("https://b.www.example.com/en/a", "b.www.example.com", "/en/a", "www.example.com/en/", "allow"),
            ("x://net/es/", "net", "/es/", "net/es/", "block"), ("x://a.net/fr/q", "a.net", "/fr/q", "net/fr/", "block"),
            ("x://a.net/es", "a.net", "/es", None, "allow"), ("x://a.com", "a.com", "", None, "allow"),
            ("x://a.com?u=http://b/", "a.com", "", None, "allow"), ("x://q/a.com/", "q", "/a.com/", None, "allow"),
            ("x://cheap-pills.org/a", "cheap-pills.org", "/a", None, "block"), ("x://a.org/cheap-pills.x", "a.org", "/cheap-pills.x", None, "allow"),
            ("x://a.org/x/wp-login.php", "a.org", "/x/wp-login.php", None, "block"), ("x://É.Com/é", "É.com", "/é", "com/", "allow"),
            ("x://h.org/" + "a" * 100000, "h.org", "/" + "a" * 100000, None, "allow")]
    rows += rows[3:5]
    df = spark.createDataFrame([(i, r[0], "old", 7) for i, r in enumerate(rows)], "page_id int, url string, HOST string, other int")
    got = url_filters.judge(df)
    assert sorted(got.columns) == sorted(["page_id", "url", "other", "host", "path", "rule", "globs", "verdict"])
    assert [(r["host"], r["path"], r["rule"], r["verdict"]) for r in got.orderBy("page_id").collect()] == [r[1:] for r in rows]
    assert url_filters.judge(df.where("false")).count() == 0
