"""Secrets, token files, HTML, licences, language and the pipeline."""

import re
import struct
import zlib
from html import unescape

import numpy as np
import pytest

from haulgrain.llm import html_extraction, language_id, license_scan, license_texts, secret_scan, token_files

public_tokenizers = pytest.importorskip("public_tokenizers")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, id string, h long"


def frame(spark, rows):
    return spark.createDataFrame([(k, t, g, "s", 0, "x", 1) for k, t, g in rows], SCHEMA)


# --- secrets ---------------------------------------------------------------------------------

def base_spans(text):
    found = []
    assign = r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
    for k, (pattern, group, least) in enumerate([(assign, 2, 8), (r"AKIA[A-Z0-9]+", 0, 16), (r"[0-9a-f]+", 0, 32)]):
        found += [(m.start(), k, m.end()) for m in re.finditer(pattern, text or "") if len(m[group]) >= least]
    return ",".join(f"{secret_scan.KINDS[k]}:{a}:{b}" for a, k, b in sorted(found))


def test_secrets(spark):
    key = "0123456789abcdef" * 2
    rows = [(1, f"é PASSWORD = 'hunter2secret' token: secret: \"abcdefgh123\" {key}f", "en"), (2, None, None), (3, "", "en"),
            (4, "AKIAABCDEFGHIJKL AKIAABCDEFGHIJ akiaABCDEFGHIJKLMNO", "en"), (5, "apiKey=" + "a1" * 30_000, "en"),
            (6, "pwd=password1 pwd=Xk9#mQ2$vLp7 https://u:Zk3pQ9wmX2@host/", "en"), (6, "ſecret=abcdefgh1 tokEn='abc=defgh", "en"),
            (None, "passwd:" + key, None), (8, "x" * 50_000 + " secret=12345678", "en")]
    got = secret_scan.scan_secrets(frame(spark, rows)).collect()
    assert sorted((str(r["doc_id"]), r["base"]) for r in got) == sorted((str(k), base_spans(t)) for k, t, _ in rows)
    for r in got:
        assert set(filter(None, r["base"].split(","))) <= set(r["spans"].split(","))
    guessed = next(r for r in got if r["n_guess"])
    assert guessed["n_guess"] == 2 and guessed["spans"] == "guess:18:30,guess:41:51"
    assert secret_scan.scan_secrets(frame(spark, [])).count() == 0


def test_guess_cost_orders_values():
    cheap = ["password123", "qwertyuiop", "aaaaaaaaaaaa", "19840512", "abcabcabcabc", "P@ssw0rd", "monkeydragon"]
    assert all(secret_scan.guess_bits(v) < 30 for v in cheap)
    assert all(secret_scan.guess_bits(v) > 45 for v in ("Xk9#mQ2$vLp7", "b7db7aa4a5fcc78305", "aB3dE6gH9jKq"))


def test_short_and_quoted_values():
    easy = ["required", "Settings", "Summer24", "Welcome1", "12345678", "qwerty12", "P@ssw0rd", "Dolphin9", "changeme", "trustno1", "disabled", "19840512"]
    hard = ["xKqmQvLz", "k7Qz9vXw", "q8w3zt5k", "Tq4$kZ8m", "ZR5T8QMX", "hV2mXc9e"]
    least = 40.0  # the default of scan_secrets
    assert max(map(secret_scan.guess_bits, easy)) < least < min(map(secret_scan.guess_bits, hard))

    def values(text):
        return [text[a:b] for a, kind, b in secret_scan.find_spans(text) if kind == 3]

    assert values("pwd=xKqmQvLz") == ["xKqmQvLz"] and values("client credentials: k7Qz9vXw") == ["k7Qz9vXw"]
    assert values('passphrase = "correct horse battery staple" # old') == ["correct horse battery staple"]
    assert values("password = 'hunterlike horse battery staple'") == ["hunterlike horse battery staple"]
    assert values('auth: "unclosed xKqmQvLz') == [] and values("pwd = 'Summer24' or so") == []


# --- token files -----------------------------------------------------------------------------

def test_token_files_round_trip(spark, tmp_path):
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    plain = Tokenizer.from_file(path)
    texts = ["Hello  wörld\n", None, "", "a\x1cb\x85c <|endoftext|>x", "long " * 4_000, "Ünï ΣΑΣ 漢字 it's 42", "same", "same"]
    rows = [(k, t, "en") for k, t in zip([5, 9, None, 1, 7, 3, 4, 4], texts)]
    docs = frame(spark, rows).repartition(3)
    folder = str(tmp_path / "tokens")
    got = token_files.token_digests(docs, path, folder, frame_tokens=50, shard_bytes=60)
    want, at = [], 0
    for k, t, _ in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = [*plain.encode(t or "", add_special_tokens=False).ids, 1]
        want.append((k, at, len(ids), zlib.crc32(struct.pack(f"<{len(ids)}I", *ids))))
        at += len(ids)
    assert sorted(map(tuple, got.collect()), key=str) == sorted(want, key=str)
    assert token_files.token_digests(frame(spark, []), path).count() == 0


def test_words_have_the_ids_of_the_whole_text():
    import random

    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    plain, encode, r = Tokenizer.from_file(path), token_files.WordEncoder(path), random.Random(1)
    parts = [*" \t\n\r\x0b\x0c\x1c\x1f\x85\xa0\u2003\u3000abABst'_-#$.,<>|1é٣ßΣςσİIŉſǅ漢😀", "e\u0301", "\u0338", "\u0958", "'s", "<|endoftext|>", "<|"]
    texts = ["".join(r.choice(parts) for _ in range(r.randrange(50))) for _ in range(2_000)] + [""]
    for text, ids in zip(texts, encode(texts)):
        assert ids.tolist() == plain.encode(text, add_special_tokens=False).ids, text


def test_a_reader_sees_damage(tmp_path):
    import zstandard

    content = np.arange(10, dtype="<u4").tobytes()
    packed = zstandard.ZstdCompressor().compress(content)
    whole = packed + packed + token_files.seek_table([(len(packed), 40, token_files.frame_checksum(content))] * 2)
    path = tmp_path / "x.zst"
    path.write_bytes(whole)
    with path.open("rb") as f:
        assert token_files.ShardReader(f, len(whole)).frame(1).tolist() == list(range(10))
    # Any zstandard reader passes over the table.
    with path.open("rb") as f:
        assert zstandard.ZstdDecompressor().stream_reader(f, read_across_frames=True).read() == content * 2
    wrong = packed + packed + token_files.seek_table([(len(packed), 40, 7)] * 2)
    for bad in (wrong, whole[:-1], b"", whole[len(packed):]):
        path.write_bytes(bad)
        with path.open("rb") as f, pytest.raises((token_files.SeekTableError, zstandard.ZstdError)):
            token_files.ShardReader(f, len(bad)).frame(1)


# --- HTML ------------------------------------------------------------------------------------

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p>";</script></head><body class="sidebar-left">
<header><h1>Site</h1></header><nav><ul><li><a href=/x>Home</a><li><a href=/y>News</a></ul></nav><!-- <p>no</p> -->
<div class="cookie-notice"><p>We use cookies. Accept them, please.</p></div><main><article><h1>Title &amp; more</h1>
<p>First   paragraph, with some <b>bold</b> and a <a href=/z>link</a>.<br>Next line.<p>Second&nbsp;one &lt;here&gt;, unclosed
<div class=ad>Buy now. Cheap offers, today only.</div><ul><li>An item of the list, with words.</li></ul></article></main>
<section id="comments"><p>Nice article, thanks. I liked it a lot, really.</p></section>
<aside><p>Related stories, and more.</p></aside><form><p>Your name, please.</p><input></form>
<footer>&copy; Site. All rights reserved.</footer></body>"""


def test_article_without_boilerplate():
    assert html_extraction.extract_text(PAGE).split("\n") == [
        "Title & more", "First paragraph, with some bold and a link. Next line.", "Second one <here>, unclosed",
        "An item of the list, with words."]


STORY = "".join(f"<p>Paragraph {i} of the story has a few words, some commas, and an end. It goes on for a while, as they do.</p>" for i in range(6))


def test_open_heads_forms_and_formulas():
    whole = re.sub(r"</p>", "\n", STORY.replace("<p>", "")).strip()
    nav, foot = "<nav><a href=/>Home</a></nav>", "<footer>&copy; Site, all rights reserved.</footer>"
    for page in (f"<html><head><title>T</title><meta charset=utf-8><body>{nav}{STORY}{foot}", f"<head><title>T</title><style>p{{}}</style>{nav}{STORY}",
                 f"<head><noscript><p>Please enable scripts, friend.</p></noscript><title>T</title></head>{STORY}",
                 f"<body><form id=aspnetForm><input type=hidden>{nav}<div>{STORY}</div>{foot}</form>", f"<body><form><input>{STORY}{foot}",
                 f"<body>{STORY}<form><label>Mail</label><p>Your name, please.</p><button>Send it, now.</button></form>"):
        assert html_extraction.extract_text(page) == whole, page[:60]
    formula = "<math><semantics><mi>E</mi><mo>=</mo><mi>m</mi><annotation>E=m</annotation></semantics></math>"
    assert "words, E=m some" in html_extraction.extract_text(STORY.replace("some", formula + " some"))


def test_wrappers_that_hide_nothing():
    whole = re.sub(r"</p>", "\n", STORY.replace("<p>", "")).strip()
    for attributes in ('style="overflow: hidden"', 'title="Hidden gems"', 'class="wrap overflow-hidden"', 'class="no-sidebar"', 'class="has-sidebar"',
                       'class="comments-open"', 'class="content share-enabled"', 'data-x="display: none"'):
        assert html_extraction.extract_text(f"<div {attributes}>{STORY}</div>") == whole, attributes
    for attributes in ('class="layout sidebar-left"', 'id=widget-area'):
        for name in ("article", "main"):
            assert html_extraction.extract_text(f"<div {attributes}><{name}>{STORY}</{name}></div>") == whole, attributes
    for attributes in ("hidden", 'style="color: red; display:none"', 'style="visibility: hidden"', 'aria-hidden="true"', 'class="hidden"', 'class="sidebar"',
                       'id="comments"', 'class="cookie-notice"'):
        assert html_extraction.extract_text(f"<div {attributes}><p>Something else, in a place apart.</p></div><article>{STORY}</article>") == whole, attributes


def test_names_count_as_whole_words():
    whole = re.sub(r"</p>", "\n", STORY.replace("<p>", "")).strip()
    for name in ("shared-content", "social-science", "menu-page", "legal-article", "search-results", "ad-free", "news-header-wrap",
                 "entry-content post-share", "navy-blue", "headers2", "recommended-reading-room"):
        for tag in ("div", "section", "article"):
            assert html_extraction.extract_text(f'<body><{tag} class="{name}">{STORY}</{tag}></body>') == whole, name
    for name in ("site-footer", "share-box", "nav_menu", "main-nav", "Sidebar-Right", "cookie-banner", "related-links", "comment-list"):
        page = f'<body><article>{STORY}</article><div class="{name}"><p>Something else, in a place apart.</p></div></body>'
        assert html_extraction.extract_text(page) == whole, name


def test_links_of_an_article_stay():
    links = "<ul><li><a href=/a>Read the paper in full here</a><li><a href=/b>The first report of the year</a></ul><p><a href=/c>All data</a></p>"
    text = html_extraction.extract_text(f"<nav><ul><li><a href=/>Home</a></ul></nav><article>{STORY}{links}{STORY}</article><ul><li><a href=/d>Imprint</a></ul>")
    assert "Read the paper in full here\nThe first report of the year\nAll data\n" in text and "Home" not in text and "Imprint" not in text


def test_broken_pages_in_linear_time():
    import time

    pages = {"nested": "".join(f"<div>t{i} " for i in range(60_000)), "unclosed tags": "<a " * 300_000, "open quotes": '<a href="x ' * 90_000 + ">",
             "odd quotes": "<p title='a>text " * 60_000, "titles": "<title>x" * 120_000, "rules": "<p>x" + "<b>y" * 100_000 + "<hr>z" * 100_000,
             "items": "<li><b>word" * 90_000, "brackets": "<" * 1_000_000, "comments": "<!--" * 250_000, "scripts": "<script>" * 120_000,
             "whole": "".join(f"<div><p>word {i} of the text, and more.</p>" for i in range(22_000))}
    for name, page in pages.items():
        start = time.process_time()
        html_extraction.extract_text(page)
        assert time.process_time() - start < 6, name
    assert html_extraction.extract_text("<script></script><title></title><style></style>" + STORY) == html_extraction.extract_text(STORY)
    assert html_extraction.extract_text('<p class="x>' + "One sentence, of words. " * 9 + "</p>" + STORY).endswith(html_extraction.extract_text(STORY))


def test_pages_edge_cases(spark):
    deep = "<div>" * 3_000 + "Words, in a deep place. " * 40
    pages = [(1, "u", None), (2, None, ""), (None, "u", PAGE), (3, "u", "<p>"), (3, "u", "<p"), (4, "u", deep), (5, "u", "a < b > c &bogus; &#x41;" * 30)]
    got = html_extraction.extract_pages(spark.createDataFrame(pages, "page_id long, url string, html string")).collect()
    assert len(got) == len(pages) and all(r["n_chars"] == len(r["text"]) for r in got)
    text = {str(r["page_id"]): r["text"] for r in got}
    assert text["1"] == text["2"] == text["3"] == "" and text["4"].startswith("Words, in a deep place.")
    assert html_extraction.extract_pages(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def test_minimum_cut_as_brute_force():
    import itertools
    import random

    r = random.Random(2)
    for _ in range(60):
        n = r.randint(1, 8)
        content, boiler = ([r.random() * 3 for _ in range(n)] for _ in range(2))
        edges = [(i, j, r.random()) for i in range(n) for j in range(i) if r.random() < 0.5]

        def cost(labels):
            return sum(c if x else b for x, c, b in zip(labels, content, boiler)) + sum(
                w for i, j, w in edges if labels[i] != labels[j])

        best = min(map(cost, itertools.product([False, True], repeat=n)))
        assert cost(html_extraction.minimum_cut(content, boiler, edges)) == pytest.approx(best)


def test_pages_of_the_test_data():
    import os

    import pyarrow.parquet as pq

    path = "/root/testdata/sf0.001/pages.parquet"
    if not os.path.exists(path):
        pytest.skip("no test data here")
    for html in pq.read_table(path).column("html").to_pylist():
        inside = re.search(r"<article>(.*?)(</article>|$)", html, re.DOTALL)[1]
        blocks = (re.sub(r"\s+", " ", unescape(re.sub(r"<[^>]*>", " ", x))).strip() for x in re.split(r"</?(?:p|h1)>", inside))
        assert html_extraction.extract_text(html) == "\n".join(filter(None, blocks))


# --- licences --------------------------------------------------------------------------------

def test_licenses_and_inheritance(spark):
    mit, apache = "Released under the MIT License.", "Licensed under the Apache License, Version 2.0."
    files = [(1, "a/LICENSE", mit), (2, "a/b/c/code.py", "print the thing"), (3, "a/b/LICENSE", apache), (4, "a/b/c/x.py", "code here\n" + mit),
             (5, "z/file", "no licence is near this"), (6, None, "no path"), (7, "a/empty", None), (7, "a/empty", ""), (8, "a/d.py", "word " * 20_000),
             (9, "top", "All rights reserved."), (None, "q/r/s", "x"), (10, "a/b/c/code.py", "print the thing"), (11, "a/e", "the license of the work is not said")]
    frame_ = spark.createDataFrame([(*f, 1) for f in files], "id long, path string, text string, dir long")
    got = {(r["id"], r["license"], r["line"], r["inherited_from"]) for r in license_scan.scan_licenses(frame_).collect()}
    assert got == {
        (1, "MIT", -1, None), (2, "Apache-2.0", None, "a/b"), (3, "Apache-2.0", -1, None), (4, "MIT", 1, None),
        (5, "proprietary", None, ""), (6, None, None, None), (7, "MIT", None, "a"), (8, "MIT", None, "a"), (9, "proprietary", -1, None),
        (None, "proprietary", None, ""), (10, "Apache-2.0", None, "a/b"), (11, "MIT", None, "a")}
    assert license_scan.scan_licenses(frame_.limit(0)).count() == 0


def test_whole_licences_and_versions(spark):
    from pathlib import Path

    folder = Path(license_scan.__file__).parent / "licenses"
    texts = {f.name.removesuffix(".txt"): f.read_text() for f in folder.iterdir()}
    bsd3 = texts["BSD-3-Clause"]
    texts["BSD-2-Clause"] = bsd3[:bsd3.index("3. Neither")] + bsd3[bsd3.index("THIS SOFTWARE"):]
    texts["MIT"] = "Copyright (c) 2021 Somebody Else\n" + texts["MIT"]
    files = [(f"full {k}", f"full/{k}/LICENSE", t) for k, t in texts.items()]
    files += [(f"below {k}", f"full/{k}/src/x.py", "value = 1") for k in texts]
    sentences = {"GNU General Public License, version 2.": "GPL-2.0", "This work is licensed under the GNU General Public License, version 3.": "GPL-3.0",
                 "CC BY-ND 4.0": "CC-BY-ND-4.0", "Licensed under CC BY 3.0.": "CC-BY-3.0", "Licensed under CC BY-NC 4.0.": "CC-BY-NC-4.0",
                 "GNU General Public License, version 7.": None, "GNU Lesser General Public License, version 2.1.": "LGPL-2.1"}
    files += [(f"notice {k}", f"notice/{i}/x", k) for i, k in enumerate(sentences)]
    got = {r["id"]: r for r in license_scan.scan_licenses(spark.createDataFrame(files, "id string, path string, text string")).collect()}
    assert {k: got[f"full {k}"]["license"] for k in texts} == {k: k for k in texts}
    assert all(got[f"full {k}"]["line"] == -1 for k in texts)
    assert {k: (got[f"below {k}"]["license"], got[f"below {k}"]["inherited_from"]) for k in texts} == {k: (k, f"full/{k}") for k in texts}
    assert {k: got[f"notice {k}"]["license"] for k in sentences} == sentences


def test_wrapped_headers(spark):
    texts = {t.license: t for t in license_texts.standard() if t.full}
    code = "\n".join(f"alpha{i} = beta{i}(gamma{i}, delta{i})" for i in range(300))
    headers = {
        "BSD-3-Clause": "# Redistribution and use in source and binary forms, with or without\n# modification, are permitted provided that the "
                        "following conditions are met:",
        "GPL-3.0": " * This program is free software: you can redistribute it and/or modify\n * it under the terms of the GNU General Public License as\n"
                   " * published by the Free Software Foundation, either version 3 of the\n * License, or (at your option) any later version.",
        "MIT": "\n".join("// " + x for x in texts["MIT"].text.splitlines()), "BSD-2-Clause": "\n".join("# " + x for x in texts["BSD-2-Clause"].text.splitlines())}
    files = [(f"header {k}", f"header/{k}/x.py", f"import os\n\n{t}\n{code}") for k, t in headers.items()]
    got = {r["id"]: r for r in license_scan.scan_licenses(spark.createDataFrame(files, "id string, path string, text string")).collect()}
    assert {k: got[f"header {k}"]["license"] for k in headers} == {k: k for k in headers}
    assert all(got[f"header {k}"]["line"] >= 2 for k in headers)


# --- language --------------------------------------------------------------------------------

def test_language(spark):
    import random

    r = random.Random(1)
    words = {"en": "the of and that with from this have are which".split(), "fr": "les des une est dans pour que avec sur être".split()}
    rows = [(i, " ".join(r.choice(words[g]) for _ in range(r.randint(3, 30))), g) for i in range(200) for g in [r.choice(["en", "fr"])]]
    odd = [(None, "the THE of", None), (301, None, "fr"), (302, "", "fr"), (303, "123 ??? 4", "en"), (7, "dans les une", None), (304, "être " * 30_000, None)]
    got = language_id.identify(frame(spark, rows + odd)).collect()
    assert len(got) == len(rows) + len(odd) and all(0 <= x["score"] <= 1 for x in got)
    for x in got:
        assert x["held_out"] == (x["doc_id"] is not None and zlib.crc32(str(x["doc_id"]).encode()) % 4 == 2)
    truth = {k: g for k, _, g in rows}
    held = [x["lang_pred"] == truth[x["doc_id"]] for x in got if x["held_out"] and x["doc_id"] in truth and x["doc_id"] != 7]
    assert len(held) > 20 and sum(held) >= 0.97 * len(held)
    assert {x["doc_id"]: x["lang_pred"] for x in got if x["doc_id"] in (301, 302, 303, 304)} == {301: "und", 302: "und", 303: "und", 304: "fr"}
    assert language_id.identify(frame(spark, [])).count() == 0
    assert [x["lang_pred"] for x in language_id.identify(frame(spark, [(1, "abc", None)])).collect()] == ["und"]
