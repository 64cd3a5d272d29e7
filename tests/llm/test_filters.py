"""Quality rules, secret scan, licence scan, classifier and text extraction."""

import hashlib
import random
import re
import string
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import make_docs
from moodlens.llm import classifier, quality, secret_scan
from moodlens.llm.extraction import extract_main_text, main_text
from moodlens.llm.licences import FILE_COSINE, HEADER_COSINE, TEMPLATES, Templates, scan_licences, term_weights

WORD = re.compile(r"[^\x20\x09-\x0D]+")


# quality


def measures(text):
    text = text or ""
    words = WORD.findall(text)
    seen, dup = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    windows = Counter(tuple(words[i : i + 8]) for i in range(len(words) - 7))
    covered = {k for i in range(len(words) - 7) if windows[tuple(words[i : i + 8])] > 1 for k in range(i, i + 8)}
    n = len(words)
    failed = n < 20 or 100 * len(covered) > 30 * n
    return n, sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(covered), failed


def check_report(docs):
    report = quality.quality_report(docs)
    got = Counter(tuple(r)[:7] for r in report.collect())
    assert got == Counter((r["doc_id"], *measures(r["text"])) for r in docs.select("doc_id", "text").collect())
    return report


def test_measures(odd, empty):
    report = check_report(odd)
    assert report.filter("base_failed and kept").isEmpty()
    assert quality.quality_report(empty).count() == 0 and quality.keep_good(empty).count() == 0


def test_measures_of_repeating_texts(spark):
    random.seed(1)
    rows = [(k, " ".join(random.choices("ab", k=random.randrange(60))) + "\n" * (k % 3) + random.choice(["", "a b\na b\n \n"]), "s") for k in range(150)]
    check_report(make_docs(spark, rows))


def test_stage_and_report_agree(documents):
    kept = {r["doc_id"] for r in quality.quality_report(documents).filter("kept").collect()}
    left = quality.keep_good(documents)
    assert left.columns == documents.columns and {r["doc_id"] for r in left.collect()} == kept


def test_clean_documents_stay(spark, documents, sf_dir):
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").filter("quality = 1").select("doc_id")
    report = quality.quality_report(documents).join(labels, "doc_id")
    assert report.filter("not base_failed and not kept").isEmpty()


def test_cascade_order_and_short_circuit():
    statistics = [{"rule": "slow", "cost": 10.0, "rejects": 0.5}, {"rule": "fast", "cost": 1.0, "rejects": 0.2}, {"rule": "never", "cost": 0.1, "rejects": 0.0}]
    assert quality.cascade_order(statistics) == ["fast", "slow", "never"]


# secrets

ASSIGN = re.compile(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")


def base_of(text):
    text = text or ""
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 12]
    found += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 18]
    found += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 16]
    joined = ",".join(f"{('assign', 'access', 'hex')[k]}:{s}:{e}" for s, k, e in sorted(found))
    kinds = [k for _, k, _ in found]
    return kinds.count(0), kinds.count(1), kinds.count(2), hashlib.sha256(joined.encode()).hexdigest(), joined


def secret_rows():
    random.seed(3)
    key = lambda letters, n: "".join(random.choices(letters, k=n))
    rows = [(1, None, "s"), (2, "", "s")]
    for k in range(10, 50):
        planted = key(string.ascii_letters + string.digits, 44)
        rows.append((k, f"é token=secret: {key('abcdef0123', 16)} 😀 AKIA{key(string.ascii_uppercase, 13 + k % 3)} api-key API_KEY = \"{key(string.ascii_letters, 10 + k % 5)}\" x {planted} y", "s"))
    plain = "the-quick-brown-fox-jumps-1 internationalization2 aaaaaaaaaaaaaaaaaaaaaaaaaa1 1111111111111111111111111 abcabcabcabcabcabcabcabcabc1"
    return rows + [(900 + k, plain, "s") for k in range(5)]


def test_secret_spans(spark, odd, documents):
    for docs in (make_docs(spark, secret_rows()), odd, documents):
        got = secret_scan.find_secrets(docs).collect()
        texts = docs.select("doc_id", "text").collect()
        assert Counter(tuple(r)[:5] for r in got) == Counter((r["doc_id"], *base_of(r["text"])[:4]) for r in texts)
        base = Counter((r["doc_id"], base_of(r["text"])[4]) for r in texts)
        kept = Counter((r["doc_id"], ",".join(s for s in r["spans"].split(",") if not s.startswith("random"))) for r in got)
        assert kept == base


def test_random_keys_are_found_and_text_is_not(spark, documents):
    docs = make_docs(spark, secret_rows())
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    added = [(r["doc_id"], s.split(":")) for r in secret_scan.find_secrets(docs).collect() for s in r["spans"].split(",") if s.startswith("random")]
    found = {(d, texts[d][int(s[1]) : int(s[2])]) for d, s in added}
    assert all(d < 900 for d, _ in found)
    assert len({d for d, token in found if len(token) == 44}) >= 36
    plain = secret_scan.find_secrets(documents).filter("spans like '%random%'")
    assert plain.count() <= 0.01 * documents.count()


def test_every_encoding_at_every_length(spark):
    rng = random.Random(8)
    url, upper = string.ascii_letters + string.digits, string.ascii_uppercase
    letters = {"upper_hex": "0123456789ABCDEF", "base32": upper + "234567", "letters": string.ascii_letters, "lower": string.ascii_lowercase, "base64": url + "+/", "base64url": url + "-_"}
    rows = [(f"{name} {n}", "".join(rng.choices(a, k=n)) + "=" * (name == "base64")) for name, a in letters.items() for n in (20, 64, 400, 3000) for _ in range(20)]
    for form in (str.lower, str.upper):
        rows += [("uuid", form("-".join("".join(rng.choices("0123456789abcdef", k=k)) for k in (8, 4, 4, 4, 12)))) for _ in range(20)]
    plain = ["internationalization", "usr/share/doc/python/examples/readme", "getElementsByTagNameAndClass", "=" * 30, "-" * 30, "-----BEGIN-----------"]
    frame = spark.createDataFrame(rows + [("plain", p) for p in plain], "kind string, token string").select("kind", secret_scan.evidence(F.col("token")).alias("e"))
    found = {r["kind"]: (r["share"], r["most"]) for r in frame.groupBy("kind").agg(F.avg((F.col("e") > 2).cast("int")).alias("share"), F.max("e").alias("most")).collect()}
    assert found.pop("plain")[1] <= 1
    assert {k: share for k, (share, _) in found.items() if share < 0.9} == {}


def test_secrets_of_an_empty_table(empty):
    assert secret_scan.find_secrets(empty).count() == 0


# licences


def brute_licence(text, templates):
    lines = (text or "").lower().split("\n")
    terms = re.compile(r"[a-z0-9]+(?:[.-][a-z0-9]+)*")
    best, name = max((( -templates.best(terms.findall(x))[0], templates.best(terms.findall(x))[1]) for x in lines), key=lambda b: b[0])
    return name if best >= HEADER_COSINE else None


def test_headers_against_every_line(documents):
    templates = Templates(*term_weights(documents), min(HEADER_COSINE, FILE_COSINE))
    got = {r["doc_id"]: r["licence"] if r["basis"] in ("header", "file") else None for r in scan_licences(documents, F.col("doc_id").cast("string")).collect()}
    want = {r["doc_id"]: brute_licence(r["text"], templates) for r in documents.collect()}
    assert got == want and any(want.values())


def test_nearest_folder_counts(spark):
    filler = "some code of no matter. " * 40
    texts = {
        "LICENSE": TEMPLATES["MIT"][0], "a/COPYING": TEMPLATES["Apache-2.0"][1], "a/b/c/x.py": filler, "a/b/own.py": TEMPLATES["GPL-3.0"][0] + "\n" + filler, "z.py": filler,
        "d/e/y.py": None, "a/w.py": "", "a/b/c/d/LICENSE": TEMPLATES["BSD-3-Clause"][1], "a/b/c/d/e/f.py": filler, "ab/q.py": filler,
    }
    rows = [(k, t, p) for k, (p, t) in enumerate(texts.items())] + [(99, filler, None)]
    got = {r["path"]: (r["licence"], r["basis"]) for r in scan_licences(make_docs(spark, rows), F.col("source")).collect()}
    assert got == {
        "LICENSE": ("MIT", "file"), "a/COPYING": ("Apache-2.0", "file"), "a/b/c/x.py": ("Apache-2.0", "inherited"), "a/b/own.py": ("GPL-3.0", "header"), "z.py": ("MIT", "inherited"),
        "d/e/y.py": ("MIT", "inherited"), "a/w.py": ("Apache-2.0", "inherited"), "a/b/c/d/LICENSE": ("BSD-3-Clause", "file"), "a/b/c/d/e/f.py": ("BSD-3-Clause", "inherited"),
        "ab/q.py": ("MIT", "inherited"), None: (None, None),
    }


def test_real_licence_files(spark, documents):
    folder, names = "/usr/share/common-licenses", {"Apache-2.0": "Apache-2.0", "BSD": "BSD-3-Clause", "CC0-1.0": "CC0-1.0", "GPL-2": "GPL-2.0", "GPL-3": "GPL-3.0", "LGPL-2.1": "LGPL-2.1", "LGPL-3": "LGPL-3.0", "MPL-2.0": "MPL-2.0"}
    texts = {name: open(f"{folder}/{name}").read() for name in names}
    rows = [(k, "Copyright (c) 2019 Someone Else\n\n" + " ".join(t.split()), f"{name}/LICENSE") for k, (name, t) in enumerate(texts.items())]
    rows += [(100 + k, "some code of no matter.", f"{name}/src/a.py") for k, name in enumerate(names)]
    docs = make_docs(spark, rows).unionByName(documents.limit(50), allowMissingColumns=True)
    got = {r["path"]: (r["licence"], r["basis"]) for r in scan_licences(docs, F.col("source")).collect()}
    for name, licence in names.items():
        assert got[f"{name}/LICENSE"] == (licence, "file") and got[f"{name}/src/a.py"] == (licence, "inherited")


def test_wrapped_and_embedded_headers(spark):
    words = {
        "GPL-3.0": "/*\n * This file is part of Foo.\n *\n * Foo is free software: you can redistribute it and/or\n * modify it under the terms of the GNU General Public\n * License as published by the Free Software Foundation,\n * either version 3 of the License, or (at your option)\n * any later version.\n */\nint x;\n",
        "LGPL-2.1": "# Foo is free software; you can redistribute it and/or modify it\n# under the terms of the GNU Lesser General Public License as\n# published by the Free Software Foundation; either version 2.1\n# of the License.\nx = 1\n",
        "MIT": "Foo draws maps of all kinds of lands and seas for you. Released under the MIT License. It was written in a long winter by people who like maps, and lands, and seas.",
        "Apache-2.0": "licensed under the apache license version 2.0 " + "var a b c d e f g " * 100,
    }
    docs = make_docs(spark, [(k, "y = 2\n" * 30 + t + "y = 2\n" * 30, f"{k}/{name}") for k, (name, t) in enumerate(words.items())])
    got = {r["path"].split("/")[1]: (r["licence"], r["basis"]) for r in scan_licences(docs, F.col("source")).collect()}
    assert got == {name: (name, "header") for name in words}


def test_terms_of_no_notice_meet_no_notice():
    """Each term of a text is looked up once for all notices, not in every notice."""
    looked_up = []

    class Watched(dict):
        def get(self, term, other=None):
            looked_up.append(term)
            return super().get(term, other)

    templates = Templates({}, 1.0, FILE_COSINE)
    notice = "licensed under cc by 4.0".split()
    want = {name: 0.0 for name, _ in templates.vectors}
    unit = templates.unit(notice + ["map"] * 3)
    for name, vector in templates.vectors:
        want[name] = max(want[name], sum(w * vector.get(t, 0.0) for t, w in unit.items()))
    templates.vectors = [(name, Watched(vector)) for name, vector in templates.vectors]
    templates.full = [(name, Watched(vector)) for name, vector in templates.full]
    cosine, name = templates.best(notice + ["map"] * 3)
    assert -cosine == max(want.values()) and want[name] == -cosine
    unknown = [f"word{k}" for k in range(1000)]
    first = min(name for name, _ in templates.vectors)
    assert templates.best(unknown) == (0.0, first) and templates.best([]) == (0.0, None)
    assert templates.best_full(unknown)[0] == 0.0 and not looked_up


def test_licences_of_odd_rows(odd, empty):
    assert scan_licences(odd, F.col("source")).count() == odd.count()
    assert scan_licences(empty, F.col("source")).count() == 0


# classifier


def test_held_out_labels(spark):
    base = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{base}/documents.parquet")
    labels = spark.read.parquet(f"{base}/labels.parquet").select("doc_id", "quality")
    rows = classifier.classify_quality(docs).join(labels, "doc_id").collect()
    good = [r["kept"] for r in rows if r["quality"] == 1]
    bad = [r["kept"] for r in rows if r["quality"] == 0]
    assert np.mean(good) >= 0.98 and np.mean(bad) <= 0.1


def test_accuracies_of_planted_labellers():
    rng = np.random.default_rng(3)
    truth = rng.random(20_000) < 0.7
    votes = np.stack([np.where(rng.random(20_000) < acc, np.where(truth, 1, -1), np.where(truth, -1, 1)) * (rng.random(20_000) < 0.6) for acc in (0.9, 0.8, 0.75)], 1)
    patterns = Counter(map(tuple, votes.tolist()))
    share, chances = classifier.estimate_labellers(sorted(patterns.items()), rounds=2000)
    assert abs(share - 0.7) < 0.05
    for j, acc in enumerate((0.9, 0.8, 0.75)):
        assert abs(chances[j, 1, 2] / (chances[j, 1, 2] + chances[j, 1, 0]) - acc) < 0.05


def test_classifier_on_odd_rows(odd, empty):
    assert classifier.classify_quality(odd).count() == odd.count()
    assert classifier.classify_quality(empty).count() == 0


# extraction


def test_article_of_the_given_pages(spark, sf_dir):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    rows = {r["page_id"]: r for r in extract_main_text(pages).collect()}
    for p in pages.collect():
        inner = p["html"][p["html"].index("<article>") + 9 : p["html"].index("</article>")]
        blocks = [" ".join(re.sub(r"<[^>]*>", "", x.replace("<br>", " ")).replace("&quot;", '"').replace("&amp;", "&").split()) for x in re.split(r"</?(?:p|h1)>", inner)]
        want = "\n\n".join(b for b in blocks if b)
        assert rows[p["page_id"]]["text"] == want and rows[p["page_id"]]["n_chars"] == len(want)


BODY = "<p>A long paragraph, with <b>bold</b> words; and some more of it.</p><p>Short.</p><p>Another long paragraph, which ends here &amp; now.</p>"
KEPT = "A long paragraph, with bold words; and some more of it.\n\nShort.\n\nAnother long paragraph, which ends here & now."


@pytest.mark.parametrize(
    "around",
    [
        "<header><h1>Site</h1></header><article>{}</article><aside><p>Read this too, it is good.</p></aside>",
        "<div id='cookie-notice'><p>We use cookies, do you agree?</p></div><main>{}</main><footer><p>All rights, always, reserved.</p></footer>",
        "<article>{}<section class='comments'><p>Great text, thank you, dear author.</p></section></article>",
        "<nav><ul><li><a href=/>Home</a><li><a href=/x>News</a></ul></nav><div class=story>{}</div><form><p>Subscribe, now.</p><input></form>",
        "<article>{}<div class='ad banner'>Buy things, now, cheap.</div><div style='display: none'>Not seen, ever.</div></article>",
        "<div class='wrap has-sidebar'><article class='post comments-open'>{}</article><div class='left-sidebar'><p>See also, dear reader.</p></div></div>",
        "<script>var a = '<p>no</p>';</script><style>p > a {{}}</style><article>{}</article><!-- <p>gone</p> -->",
    ],
)
def test_what_is_around_the_article_goes(around):
    assert main_text(f"<!doctype html><html><head><title>T</title></head><body>{around.format(BODY)}</body></html>") == KEPT


@pytest.mark.parametrize("name", ["search-results", "social-history", "related-work", "header-files", "notice"])
def test_slugs_of_an_article_stay(name):
    page = f"<body><article><h2 id={name}>Found things</h2>{BODY}<section id={name}><h3>More</h3>{BODY}</section></article></body>"
    assert main_text(page) == f"Found things\n\n{KEPT}\n\nMore\n\n{KEPT}"
    assert main_text(f"<body><article>{BODY}<section id=comments><p>Great, thanks.</p></section><div id=related-posts><p>Read this, too.</p></div></article></body>") == KEPT


def test_lists_and_tables_of_a_story_without_article():
    story = "A long story, told by someone; it goes on and on. " * 8
    items = "".join(f"<li>Item {k}</li>" for k in range(8))
    cells = "".join(f"<tr><td>Cell {k}</td><td>{k}</td></tr>" for k in range(6))
    page = f"<body><div class=top><ul><li><a href=/>Home</a><li><a href=/x>News</a></ul></div><div class=story><p>{story}</p><ul>{items}</ul><p>{story}</p><table>{cells}</table><p>{story}</p></div><div class=end><p>Made here</p></div></body>"
    got = main_text(page).split("\n\n")
    assert got[0] == story.strip() and got[-1] != "Home"
    assert [x for x in got if x.startswith("Item")] == [f"Item {k}" for k in range(8)]
    assert [x for x in got if x.startswith("Cell")] == [f"Cell {k}" for k in range(6)] and "Home" not in got and "News" not in got


@pytest.mark.parametrize("source", [None, "", "   ", "<", "<html", "<p", "<!-- open", "<script>x", "<nav>only menu</nav>"])
def test_pages_without_text(source):
    assert main_text(source) == ""


def test_broken_pages():
    assert main_text("<article><p>One, two.<p>a < b &lt; c<br>d</b></article>") == "One, two.\n\na < b < c d"
    assert main_text('<article><p title="a > b">x, y.</p><p title="open>z, w.</p></article>').startswith("x, y.")


def test_extraction_of_odd_rows(spark):
    rows = [(1, "u", None, 1), (1, "u", None, 1), (2, None, "<article><p>" + "word, " * 50_000 + "</article>", 2), (None, "v", "", 3)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text int")
    got = extract_main_text(pages).collect()
    assert sorted(r["n_chars"] for r in got) == [0, 0, 0, 299_999]
    assert extract_main_text(pages.limit(0)).count() == 0


def test_deep_pages_take_linear_time():
    """Pages of tens of thousands of open elements, as broken templates make them."""
    import time

    from moodlens.llm.extraction import main_text

    start = time.perf_counter()
    n = 32_000
    for page in ("<div>text" * n, "<b>text" * n + "</i>" * n, "<div>" * n + "<p>text</p>" * n, "<b><div>text</b>" * n, "<b>" * n + "<hr>text" * n):
        assert len(main_text(page)) >= 4 * n
    assert time.perf_counter() - start < 30
