"""Broken pages and responses, and texts without ids of their own."""

import gzip
import random
import re
import sys
import time
import zlib
from collections import Counter
from pathlib import Path

import pytest
import xxhash

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))

from fieldgauge.llm.decontamination import contamination  # noqa: E402
from fieldgauge.llm.html_blocks import blocks  # noqa: E402
from fieldgauge.llm.html_text import extract_text, shared_lines  # noqa: E402
from fieldgauge.llm.licences import scan, training_rows  # noqa: E402
from fieldgauge.llm.substrings import remove_repeats  # noqa: E402
from fieldgauge.llm.warc import build_derivatives, derive  # noqa: E402

DOCS = "doc_id long, text string"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
MEGABYTE = 1 << 20


@pytest.mark.parametrize(
    "piece",
    ["<a", "<a ", '<a "', '<a b="', "<a b='\">", '<a b=">" ', "</ ", "<!", "<!--", "<script", "<script>", "</script ", "<title-x", "<div>",
     "<p>", "</section>", "<div></section>", "<b></i>", "< <<", "&#", "&amp", "class ", "<a class    ", "<a =\"'", "\"'=>"],
)
def test_a_megabyte_of_broken_markup_takes_seconds(piece):
    started = time.process_time()
    for page in (piece * (MEGABYTE // len(piece)), "<p>text " + piece * (MEGABYTE // len(piece)) + "</p>"):
        blocks(page)
    assert time.process_time() - started < 20


def test_a_tag_left_open_takes_the_rest():
    assert [b.text for b in blocks("<p>one</p><p>two <a href='x' <b three")] == ["one", "two"]
    assert [b.text for b in blocks("<p>one < two</p> 3 <4 <p title='a>b'>five</p>")] == ["one < two", "3 <4", "five"]
    assert [b.text for b in blocks('<p a="unclosed>six</p>')] == ["six"]


def page(body):
    return f"<html><body><nav>menu</nav>{body}<footer>end</footer></body></html>"


@pytest.mark.parametrize(
    "body, text",
    [
        ('<article><p>story</p></article><article class="comment"><p>me too</p></article>', "story"),
        ('<article><p>story</p><article class="related-posts"><p>teaser</p></article></article>', "story"),
        ('<article><section id="search-for-meaning"><p>story</p></section></article>', "story"),
        ('<article><div class="social-form-essay"><p>story</p></div></article>', "story"),
        ('<article><div data-hidden="no" title="hidden"><p>story</p></div></article>', "story"),
        ('<article><p>story</p><div class="mainSidebar"><p>aside</p></div><div class="cookie-banner">yes?</div></article>', "story"),
        ('<article><p>story</p><div hidden><p>no</p></div><div aria-hidden="true">no</div></article>', "story"),
    ],
)
def test_names_of_furniture(spark, body, text):
    pages = spark.createDataFrame([(1, "http://a.example/x", page(body))], "page_id long, url string, html string")
    assert [r.text for r in extract_text(pages).collect()] == [text]


def response(body, *headers):
    return ("HTTP/1.1 200 OK\r\n" + "".join(f"{h}\r\n" for h in headers) + "\r\n").encode("latin-1") + body


@pytest.mark.parametrize(
    "charset",
    ["hex", "idna", "undefined", "a\0b", "unicode_escape", "utf-7", "utf-16", "base64", "zip", "rot13", "punycode", "x" * 5000, "", "mbcs", "utf_8_sig",
     "raw_unicode_escape", "palmos", "none"],
)
def test_no_charset_raises(charset):
    for body in (b"<p>caf\xe9 \\ud800 +2AA- </p>", b"\xff\xfe\x00\xd8", b"", bytes(range(256))):
        rows = derive("<id>", "u", "d", response(body, f"Content-Type: text/html; charset={charset}"))
        assert [r[0] for r in rows] == ["metadata", "conversion"]
        for row in rows:
            assert row[6] == len(row[11].encode())


def test_encodings_are_undone():
    text = "<p>café 中</p>".encode()
    chunked = b"".join(b"%x;x=1\r\n%s\r\n" % (len(part), part) for part in (text[:5], text[5:])) + b"0\r\n\r\n"
    raw = zlib.compressobj(wbits=-15)
    deflated = raw.compress(text) + raw.flush()
    for body, headers in (
        (text, []),
        (chunked, ["Transfer-Encoding: chunked"]),
        (gzip.compress(text), ["Content-Encoding: gzip"]),
        (zlib.compress(text), ["content-encoding:  deflate "]),
        (deflated, ["Content-Encoding: deflate"]),
        (gzip.compress(text)[:-6], ["Content-Encoding: gzip"]),
    ):
        assert derive("<id>", "u", "d", response(body, *headers))[1][11] == "café 中"
    assert derive("<id>", "u", "d", response(text, "Content-Encoding: gzip"))[1][11] == "café 中"
    assert derive("<id>", "u", "d", response(b"zz\r\n<p>no size</p>", "Transfer-Encoding: chunked"))[1][11] == ""


def test_odd_responses_through_spark(spark):
    rows = [(f"<{c}>", "u", "d", response(b"<p>x\xff</p>", f"Content-Type: text/html; charset={c}")) for c in ("hex", "utf-7", "nope")]
    rows += [(None, None, None, None), ("<page>", "u", "d", b"<a" * 100_000)]
    got = build_derivatives(spark.createDataFrame(rows, "warc_record_id string, warc_target_uri string, warc_date string, block binary"))
    assert Counter(r.warc_type for r in got.collect()) == {"metadata": 5, "conversion": 5}


def kept_words(rows, width):
    """Brute force: texts in the order of ids, null last, then of their hashes; a window counts as removed if it starts earlier."""

    def place(doc_id, text):
        digest = xxhash.xxh64_intdigest((text or "").encode(), 42)
        return (doc_id is None, doc_id or 0, digest - (1 << 64) if digest >> 63 else digest)

    texts = {}
    for doc_id, text in rows:
        if text is not None:
            texts[place(doc_id, text)] = WORD.findall(text)
    first = {}
    for key in sorted(texts):
        for at in range(len(texts[key]) - width + 1):
            first.setdefault(tuple(texts[key][at : at + width]), (key, at))
    found = Counter()
    for doc_id, text in rows:
        words, gone = WORD.findall(text or ""), set()
        for at in range(len(words) - width + 1):
            if first[tuple(words[at : at + width])] != (place(doc_id, text), at):
                gone.update(range(at, at + width))
        found[doc_id, text, len(gone), " ".join(w for i, w in enumerate(words) if i not in gone)] += 1
    return found


@pytest.mark.parametrize("width", [3, 20])
def test_texts_without_ids_of_their_own_keep_their_words(spark, width):
    rng = random.Random(width)
    passages = [" ".join(f"p{rng.randrange(10**6)}" for _ in range(30)) for _ in range(40)]

    def text():
        words = " ".join(f"w{rng.randrange(10**6)}" for _ in range(rng.randrange(12)))
        return f"{words} {rng.choice(passages)} {words}" if rng.random() < 0.1 else words

    rows = [(None, text()) for _ in range(5000)] + [(7, text()) for _ in range(1500)] + [(i, text()) for i in range(1500)]
    rows += rows[:40] + rows[5000:5040] + [(None, None), (7, None), (None, ""), (8, " ")]
    rng.shuffle(rows)
    docs = spark.createDataFrame(rows, DOCS).selectExpr("doc_id", "text", "doc_id as doc", "text as content", "1 as number")
    got = remove_repeats(docs, width=width, one_space=True)
    assert got.columns == [*docs.columns, "n_words", "n_removed"]
    assert Counter((r.doc_id, r.content, r.n_removed, r.text) for r in got.collect()) == kept_words(rows, width)


ITEMS = "item_id long, text string"


def matches(spark, texts, items):
    docs = spark.createDataFrame(list(enumerate(texts)), DOCS).coalesce(1)
    found = contamination(docs, spark.createDataFrame(list(enumerate(items)), ITEMS)).collect()
    return {(r.doc_id, r.item_id): r.distance for r in found}


def least_distance(item, words):
    """Least edit distance of the item and any window, by dynamic programming."""
    row = [0] * (len(words) + 1)
    for i, word in enumerate(item, 1):
        before, row = row, [i]
        for j, other in enumerate(words, 1):
            row.append(min(before[j] + 1, row[-1] + 1, before[j - 1] + (word != other)))
    return min(row)


def test_matches_at_the_edges_of_texts_do_not_depend_on_neighbours(spark):
    rng = random.Random(7)
    items = [" ".join(f"w{rng.randrange(10**5)}" for _ in range(20)) for _ in range(13)]
    cut = [" ".join(i.split()[2:]) for i in items]  # without their first two words
    ends = [" ".join(i.split()[:-2]) for i in items]
    texts = [cut[0], *(t for i in range(1, 13) for t in (" ".join(items[i].split()[:2]), cut[i], ends[i]))]
    wanted = {(t, i): 2 for t, text in enumerate(texts) for i in range(13) if text in (cut[i], ends[i])}
    assert matches(spark, texts, items) == wanted
    assert matches(spark, texts[::-1], items) == {(len(texts) - 1 - t, i): d for (t, i), d in wanted.items()}


def test_matches_against_dynamic_programming(spark):
    rng = random.Random(8)
    vocabulary = [f"w{i}" for i in range(400)]
    items = [" ".join(rng.choices(vocabulary, k=rng.randint(10, 40))) for _ in range(12)]
    texts = []
    for n in range(120):
        words = rng.choices(vocabulary, k=rng.randrange(60))
        part = rng.choice(items).split()
        for _ in range(rng.randrange(1 + len(part) // 4)):
            at = rng.randrange(len(part))
            part[at : at + rng.randrange(2)] = rng.choices(vocabulary, k=rng.randrange(2))
        at = rng.randrange(len(words) + 1)
        texts.append(" ".join([*words[:at], *part, *words[at:]]))
    wanted = {}
    for t, text in enumerate(texts):
        for i, item in enumerate(items):
            distance = least_distance(item.split(), text.split())
            if distance <= len(item.split()) // 5:
                wanted[t, i] = distance
    found = matches(spark, texts, items)
    assert set(found) <= set(wanted) and len(found) >= 0.95 * len(wanted) > 80
    assert all(d == wanted[k] for k, d in found.items())


def test_shared_openings_take_time_in_proportion(spark):
    opening = " ".join(f"o{i}" for i in range(12))
    rng = random.Random(9)
    items = [f"{opening} " + " ".join(f"w{rng.randrange(10**5)}" for _ in range(12)) for _ in range(200)]
    text = " ".join(f"{opening} x{i} y{i}" for i in range(200)) + " " + items[17]
    started = time.monotonic()
    assert matches(spark, [text], items) == {(0, 17): 0}
    assert time.monotonic() - started < 30


def longest_common(one, two):
    lengths = [0] * (len(two) + 1)
    for x in one:
        above, lengths = lengths, [0]
        for j, y in enumerate(two):
            lengths.append(above[j] + 1 if x == y else max(above[j + 1], lengths[j]))
    return lengths[-1]


@pytest.mark.parametrize("kinds", [1, 2, 3, 30])
def test_shared_lines_of_repeated_lines_are_a_longest_common_subsequence(kinds):
    assert shared_lines(["a", "-"], ["-"] * 17 + ["a", "-"]) == {0, 1}
    rng = random.Random(kinds)
    for _ in range(60):
        one, two = ([str(rng.randrange(kinds)) for _ in range(rng.randrange(90))] for _ in range(2))
        kept, rest = shared_lines(one, two), iter(two)
        assert len(kept) == longest_common(one, two) and all(one[i] in rest for i in sorted(kept))


def test_furniture_between_repeated_lines_goes(spark):
    def html(i, rows):
        return f"<body>{'<p>-' * rows}<p>Site name<p>own text of page {i}, long enough to stay{'<p>-' * 3}</body>"

    rows = [(i, f"http://h.org/{i}", html(i, n)) for i, n in enumerate([20, 2])]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1)
    got = {r.page_id: r.text for r in extract_text(pages).collect()}
    assert got[1] == "own text of page 1, long enough to stay"


def extracted(spark, bodies):
    rows = [(i, f"http://h.org/{i}", f"<body>{body}</body>") for i, body in enumerate(bodies)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1)
    return [r.text for r in extract_text(pages).orderBy("page_id").collect()]


def test_text_beside_an_article_is_differenced(spark):
    body = "<p>Site name<article><h1>Title {0}</h1><p>More news</article><p>Story of page {0}, beside it.<p>All rights"
    bodies = [body.format(i) for i in range(3)]
    assert extracted(spark, bodies) == [f"Title {i}\nMore news\nStory of page {i}, beside it." for i in range(3)]
    copies = [bodies[0], bodies[0].replace("rights", "wrongs"), bodies[1]]  # the first has a copy beside it only
    assert extracted(spark, copies)[0] == "Site name\nTitle 0\nMore news\nStory of page 0, beside it.\nAll rights"
    assert extracted(spark, copies)[1] == "Title 0\nMore news\nStory of page 0, beside it.\nAll wrongs"
    assert extracted(spark, bodies[:1])[0].split("\n")[0] == "Site name"  # nothing to compare with


def test_short_stories_under_one_long_menu_are_no_copies(spark):
    menu = "".join(f"<p>topic {i}" for i in range(30))
    stories = [f"Story of page {i}, shorter than the menu above it." for i in range(3)]
    assert extracted(spark, [f"{menu}<p>{story}<p>All rights" for story in stories]) == stories
    copies = [f"{menu}<p>{stories[0]}<p>Seen {i} times" for i in range(2)]
    assert all(stories[0] in text for text in extracted(spark, copies))


def test_equal_pages_in_a_row_have_the_text_of_one(spark):
    def body(i):
        return f"<p>Site name<p>Story of page {i}, which has its own words.<p>All rights<script>{i}</script>"

    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 2)
    try:
        found = extracted(spark, [body(0), *[body(1)] * 5, body(2), *[body(3)] * 4])
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert found == [f"Story of page {i}, which has its own words." for i in [0, 1, 1, 1, 1, 1, 2, 3, 3, 3, 3]]


NOTICES = [
    ("GPL", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public"),
    ("BSD", "Redistribution and use in source and binary forms, with or without modification, are"),
]  # notices cut short, without any of the words of licences


def test_notices_without_licence_words_are_found(spark):
    texts = [f"Prose of town number {i}.\nThe rain fell on the roofs of the old station and the river rose.\nEnd." for i in range(20)]
    texts += [f"Prose of another town.\n\n{notice}" for _, notice in NOTICES] + [None, ""]
    rows = scan(spark.createDataFrame(list(enumerate(texts)), DOCS)).where("family <> 'unknown'").collect()
    assert {(r.doc_id, r.paragraph, r.family) for r in rows if r.confirmed} == {(20 + i, 2, family) for i, (family, _) in enumerate(NOTICES)}


def test_unknown_class_learns_from_whole_texts(spark):
    docs = spark.createDataFrame([(i, f"same first line\nword{i} beside\n\nlast") for i in range(9)], DOCS)
    unknown = {" ".join(r.tokens) for r in training_rows(docs).where("family = 'unknown'").collect()}
    assert unknown == {"same first line", "last", *(f"word{i} beside" for i in range(9))}
