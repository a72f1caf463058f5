"""Each operator against brute force or an exact property, and on empty, null and repeated rows."""

import hashlib
import random
import re
import sys
from collections import Counter, defaultdict
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))

from fieldgauge.llm.components import components  # noqa: E402
from fieldgauge.llm.decontamination import contamination, without_contamination  # noqa: E402
from fieldgauge.llm.html_blocks import blocks  # noqa: E402
from fieldgauge.llm.html_text import extract_text, main_text, shared_lines  # noqa: E402
from fieldgauge.llm.licences import scan  # noqa: E402
from fieldgauge.llm.merkle import edits, fingerprints, with_tree  # noqa: E402
from fieldgauge.llm.mixing import mix, mixed, schedule, source_targets  # noqa: E402
from fieldgauge.llm.simhash import links, near_duplicates, one_of_each  # noqa: E402
from fieldgauge.llm.substrings import remove_repeats  # noqa: E402
from fieldgauge.llm.token_counts import encoded_lengths, length_histogram, length_quantile, truncated_total  # noqa: E402
from fieldgauge.llm.toxicity import Grammar, Model, score, train, without_toxic  # noqa: E402
from fieldgauge.llm.warc import build_derivatives, digest  # noqa: E402

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
ODD = [None, "", " \n\t ", "one", "One one ONE", "ünï cödé 🎈 wörds", "x" * 30_000, "a b " * 4000]


@pytest.fixture(scope="module")
def odd(spark):
    """Odd texts, with repeated rows, null ids and sources, and columns with clashing names."""
    rows = [(i, t, None, None if i % 2 else "s", 0) for i, t in enumerate(ODD)]
    rows += [rows[4], rows[6], (None, "no id at all", "en", "t", 1), (None, None, None, None, None)]
    more = {"doc": F.lit(1), "tag": F.lit("t"), "size": F.lit(2), "bucket": F.lit(3), "c0": F.lit(4), "n_words": F.lit(5)}
    return spark.createDataFrame(rows, DOCS).withColumns(more)


def frame(spark, texts):
    return spark.createDataFrame([(i, t, "en", f"s{i % 3}", len(t or "")) for i, t in enumerate(texts)], DOCS)


def some_texts(seed, n=60, vocabulary=40):
    rng = random.Random(seed)
    names = [rng.choice("abcdefg") * rng.randint(1, 3) + str(i) for i in range(vocabulary)]
    texts = [" ".join(rng.choice(names) for _ in range(rng.randrange(120))) for _ in range(n)]
    return texts + [f"{texts[3]} {t}\n" for t in texts[:20]] + texts[5:15]


@pytest.mark.parametrize("vocabulary", [1, 2, 3, 40])
@pytest.mark.parametrize("width", [1, 5, 20])
def test_substrings_equal_brute_force(spark, vocabulary, width):
    texts = some_texts(vocabulary, vocabulary=vocabulary)
    words = [WORD.findall(t) for t in texts]
    first = {}
    for i, w in enumerate(words):
        for p in range(len(w) - width + 1):
            first.setdefault(tuple(w[p : p + width]), (i, p))
    got = {r.doc_id: r for r in remove_repeats(frame(spark, texts), width=width, one_space=True).collect()}
    for i, w in enumerate(words):
        gone = set()
        for p in range(len(w) - width + 1):
            if first[tuple(w[p : p + width])] != (i, p):
                gone.update(range(p, p + width))
        kept = " ".join(x for k, x in enumerate(w) if k not in gone)
        assert (got[i].n_words, got[i].n_removed, got[i].text) == (len(w), len(gone), kept)


def test_substrings_on_odd_rows(spark, odd):
    got = remove_repeats(odd)
    assert got.columns == [*[c for c in odd.columns if c != "n_words"], "n_words", "n_removed"]
    rows = got.collect()
    assert len(rows) == odd.count()
    assert [r.text for r in rows if r.doc_id == 0] == [None]
    # Of 8000 words, the first two are in no window that starts earlier.
    assert [(r.n_words, r.n_removed, r.text) for r in rows if r.doc_id == 7] == [(8000, 7998, "a b")]
    assert remove_repeats(odd.limit(0)).count() == 0


def union_find(pairs, nodes):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def test_components_equal_union_find(spark):
    rng = random.Random(2)
    pairs = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)] + [(1000 + i, 1001 + i) for i in range(50)]
    expected = union_find(pairs, {n for p in pairs for n in p})
    got = {r.node: r.root for r in components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    assert got == {n: r for n, r in expected.items() if n in got}
    assert {n for p in pairs if p[0] != p[1] for n in p} == set(got)


def simhash(text):
    words = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_simhash_equals_brute_force(spark, odd):
    rng = random.Random(9)
    texts = some_texts(4, vocabulary=400)
    for t in texts[:30]:
        words = t.split()
        if words:
            words[rng.randrange(len(words))] = "CHANGED"
        texts.append(" ".join(words))
    prints = [simhash(t) for t in texts]
    near = [(a, b) for a in range(len(texts)) for b in range(a) if (prints[a] ^ prints[b]).bit_count() <= 3]
    roots = union_find(near, range(len(texts)))
    rows = near_duplicates(frame(spark, texts)).collect()
    assert {r.doc_id: (r.fingerprint, r.component_id) for r in rows} == {i: (f"{prints[i]:016x}", roots[i]) for i in roots}
    kept = sorted(r.doc_id for r in one_of_each(frame(spark, texts)).collect())
    assert kept == sorted(set(roots.values()))
    assert near_duplicates(odd).count() == odd.count() and near_duplicates(odd.limit(0)).count() == 0
    blank = [r.component_id for r in near_duplicates(odd).collect() if r.doc_id in (0, 1, 2)]
    assert blank == [0, 0, 0]


def test_gray_index_loses_no_link_in_dense_groups(spark):
    rng = np.random.default_rng(1)
    values = {int(v) for v in rng.integers(0, 2**63, 200)}
    for centre in rng.integers(0, 2**63, 2):
        for _ in range(700):
            values.add(int(centre) ^ sum(1 << int(b) for b in set(rng.integers(0, 63, rng.integers(0, 6)))))
    values = sorted(values)
    array = np.array(values, np.uint64)
    near = [(values[i], values[int(j)]) for i in range(len(values)) for j in np.flatnonzero(np.bitwise_count(array[:i] ^ array[i]) <= 3)]
    expected = union_find(near, values)
    batch = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    for most, rows in ((2**16, batch), (400, 300)):  # the second: dense nodes go on to finer masks
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", rows)
        got = components(links(spark.createDataFrame([(v,) for v in values], "fingerprint long"), most=most)).collect()
        assert {r.node: r.root for r in got} == {n: r for n, r in expected.items() if n in {x for p in near for x in p}}
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)


def test_one_of_each_by_value(spark):
    text = " ".join(f"w{i}" for i in range(60))
    rows = [(5, text, "en", "a", 1), (2, text.upper(), "en", "b", 2), (2, "other words here", "en", "b", 3)]
    rows += [(None, text, None, None, 4), (None, "alone without an id", None, None, 5), (9, "", None, None, 6), (7, None, None, None, 7)]
    docs = spark.createDataFrame(rows, DOCS).withColumn("_kept_id", F.lit(0)).withColumn("component_id", F.lit("x"))
    kept = one_of_each(docs)
    assert kept.columns == docs.columns
    # The text without an id goes with its component; the one that is alone stays, as do all rows of a kept id.
    assert sorted(r.n_chars for r in kept.where("doc_id is not null").collect()) == [2, 3, 7]
    assert one_of_each(docs.limit(0)).count() == 0


def test_histogram_answers_every_limit(spark, odd):
    docs = frame(spark, [t for t in some_texts(3)] + ["", None, "x " * 3000])
    lengths = [r.length for r in encoded_lengths(docs).collect()]
    histogram = length_histogram(encoded_lengths(docs)).collect()
    assert {r.length: r.documents for r in histogram} == Counter(lengths)
    for r in histogram:
        longer = [x for x in lengths if x >= r.length]
        assert (r.documents_from, r.tokens_from) == (len(longer), sum(longer))
        assert r.truncated_total == sum(min(x, r.length) for x in lengths)
    table = length_histogram(encoded_lengths(docs))
    assert truncated_total(table, 100).first().tokens == sum(min(x, 100) for x in lengths)
    assert length_quantile(table, 0.5).first().length == sorted(lengths)[(len(lengths) + 1) // 2 - 1]
    assert encoded_lengths(odd).count() == odd.count() and length_histogram(encoded_lengths(odd.limit(0))).count() == 0


def fill(sizes, weights):
    """Water filling by repeated resharing, as the contract words it."""
    total, targets = 1.5 * sum(sizes), [0.0] * len(sizes)
    open_, left = set(range(len(sizes))), total
    while open_:
        share = left / sum(weights[i] for i in open_)
        full = {i for i in open_ if weights[i] * share > 2 * sizes[i]}
        if not full:
            for i in open_:
                targets[i] = weights[i] * share
            break
        for i in full:
            targets[i] = 2.0 * sizes[i]
            left -= targets[i]
        open_ -= full
    return targets


def test_mixing_meets_targets(spark, odd):
    sizes = [500, 20, 3000, 0, 900, 40]
    rows = [(f"s{i}", s) for i, s in enumerate(sizes)]
    got = source_targets(spark.createDataFrame(rows, "source string, size long")).orderBy("rank").collect()
    assert [r.target for r in got] == pytest.approx(fill(sizes, [3, 1, 2, 3, 1, 2]))
    rng = random.Random(8)
    texts = ["w " * rng.randrange(60) for _ in range(400)]
    docs = spark.createDataFrame([(i, t, "en", "hot" if i % 3 else f"s{i % 7}", 0) for i, t in enumerate(texts)], DOCS)
    taken, target = defaultdict(int), {}
    first = mix(docs).collect()
    for r in first:
        assert 0 <= r.taken <= 2 * r.size and r.size == len(texts[r.doc_id].split())
        taken[r.source] += r.taken
        target[r.source] = r.target
    assert all(abs(taken[s] - target[s]) <= 0.5 for s in target)
    assert sorted(first) == sorted(mix(docs.repartition(7)).collect())
    assert mix(odd).count() == odd.count() and mix(odd.limit(0)).count() == 0
    assert mixed(odd).count() == odd.count()
    assert mixed(docs).agg(F.sum("taken")).first()[0] == sum(taken.values())


def test_small_sources_meet_their_targets_beside_a_large_one(spark):
    sizes = {"a": 500, "b": 5_000, "c": 2_000_000}
    docs = spark.createDataFrame(
        [(i, "w " * 100, None, s, 0) for s, n in sizes.items() for i in range(min(n, 20_000) // 100)], DOCS
    ).withColumn("text", F.when(F.col("source") == "c", F.repeat(F.lit("w "), 10_000)).otherwise(F.col("text")))
    for slots in (2, 4096):  # no point falls into the part of the smallest source, or few
        found = mix(docs, slots=slots).groupBy("source").agg(F.first("target").alias("target"), F.sum("taken").alias("taken"))
        found = {r.source: r for r in found.collect()}
        assert all(abs(r.taken - r.target) <= 0.5 for r in found.values()) and len(found) == 3


def test_every_number_of_slots_takes_whole_targets(spark):
    rng = random.Random(4)
    texts = ["w " * rng.randrange(40) for _ in range(120)]
    docs = spark.createDataFrame([(i, t, "en", f"s{i % 5}", 0) for i, t in enumerate(texts)], DOCS)
    for slots in (13, 300):
        rows = mix(docs, slots=slots).collect()
        assert len(rows) == len(texts) and all(0 <= r.taken <= 2 * r.size for r in rows)
        for source in {r.source for r in rows}:
            of = [r for r in rows if r.source == source]
            assert abs(sum(r.taken for r in of) - of[0].target) <= 0.5
        targets = source_targets(docs.selectExpr("source", "cast(size(split(trim(text), ' ')) as long) as size"))
        turns = schedule(targets, slots).orderBy("slot").collect()
        for rank in range(5):  # turns are numbered in the order of slots
            assert [t.turn for t in turns if t.rank == rank] == list(range(sum(t.rank == rank for t in turns)))


def test_mixed_keeps_columns_of_any_name(spark):
    rows = [(1, "a b", None, "s", 0), (1, "c d", None, "s", 0), (None, "e f", None, None, 0), (2, "", None, "s", 0)]
    clash = {c: F.lit(c) for c in ("_id", "_source", "_size", "_taken", "_rows", "rank", "until", "content", "c0", "f", "turn")}
    docs = spark.createDataFrame(rows, DOCS).withColumns(clash).withColumn("taken", F.lit("old"))
    got = mixed(docs)
    assert got.columns == [*[c for c in docs.columns if c != "taken"], "size", "source_size", "target", "taken"]
    assert sorted(map(str, got.collect())) == sorted(map(str, mixed(docs.repartition(3)).collect()))
    assert got.count() == 4


def test_merkle_trees(spark, odd):
    texts = [*some_texts(6)[:30], "same\ntext", "same\ntext", "", "🎈" * 50 + "\nend"]
    rows = {r.doc_id: r for r in fingerprints(frame(spark, texts)).collect()}
    for i, text in enumerate(texts):
        after, n = texts[(i + 1) % len(texts)], len(text)
        edited = text[: n - n // 2] + after[: n // 2]
        assert rows[i].n_chars == n and rows[i].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert 0 <= rows[i].near_edited <= 1 and 0 <= rows[i].near_next <= 1
        assert (rows[i].fingerprint == rows[i].edited_fingerprint) == (text == edited)
    assert len({r.fingerprint for r in rows.values()}) == len(set(texts))
    assert rows[30].fingerprint == rows[31].fingerprint and rows[30].near_next == 1
    assert fingerprints(odd).count() == odd.count() and fingerprints(odd.limit(0)).count() == 0
    lines = [f"line {i}" for i in range(40)]
    changed = [*lines[:17], "other", *lines[18:]]
    pair = spark.createDataFrame([("\n".join(lines), "\n".join(changed))], "one string, two string")
    found = edits(with_tree(with_tree(pair, "one", "a"), "two", "b"), "a", "b").first()
    assert (found.differing_sections, found.differing_paragraphs) == ([2], [17])


def test_html_blocks_and_differencing(spark):
    page = (
        "<html><head><title>no</title><style>p{}</style></head><body><nav><li>menu</nav><div class='cookie-notice'>c</div>"
        "<article><h1>A &amp;\n  B</h1><p>one<b>t</b>wo<br>three<!-- no --><p>four<form>f</form>"
        "<section id=comments><p>reader</section></article><aside>side</aside><script>var a='</p>'</script><footer>foot"
    )
    assert main_text(blocks(page), []) == "A & B\nonetwo three\nfour"
    assert shared_lines(list("abcxyz"), list("bcqz")) == {1, 2, 5}
    plain = "<body><p>Site name</p><p>{0} text of its own</p><p>More of {0} here</p><p>All rights</p></body>"
    rows = [(i, f"http://h.org/a/{i}?x", plain.format(f"page {i}")) for i in range(3)]
    rows += [(7, "http://lone.org/", plain.format("lone")), (8, None, None), (9, "http://h.org/z", "")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("host", F.lit(1))
    got = {r.page_id: r.text for r in extract_text(pages.coalesce(1)).collect()}
    assert got[1] == "page 1 text of its own\nMore of page 1 here"
    assert got[7].startswith("Site name") and got[8] == got[9] == ""
    copies = spark.createDataFrame([(i, "http://h.org/a", plain.format("copy")) for i in range(2)], pages.drop("host").schema)
    assert all("copy text" in r.text for r in extract_text(copies).collect())
    assert extract_text(pages.limit(0)).count() == 0


def test_warc_records_refer_to_their_response(spark):
    html = "<p>Größe &amp; mehr</p><script>x</script><p>two"
    block = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=latin-1\r\nX: y\r\n\r\n" + html.encode("latin-1")
    rows = [("<urn:a>", "http://a/", "d", block), (None, None, None, None), ("<urn:b>", "http://b/", "d", b"no headers")]
    schema = "warc_record_id string, warc_target_uri string, warc_date string, block binary"
    found = build_derivatives(spark.createDataFrame(rows, schema).withColumn("content_type", F.lit(1))).collect()
    assert Counter(r.warc_type for r in found) == {"metadata": 3, "conversion": 3}
    conversion = next(r for r in found if r.warc_type == "conversion" and r.warc_refers_to == "<urn:a>")
    assert conversion.block == "Größe & mehr\ntwo" and conversion.warc_block_digest == digest(conversion.block.encode())
    assert conversion.source_block_digest == digest(block) and "X: y" in conversion.source_headers
    assert conversion.source_payload_digest == digest(html.encode("latin-1"))
    assert len({r.warc_record_id for r in found}) == 6
    assert build_derivatives(spark.createDataFrame([], schema)).count() == 0


def test_contamination_finds_edited_passages(spark, odd):
    rng = random.Random(5)
    vocabulary = [f"w{i}" for i in range(3000)]
    items = [(i, " ".join(rng.choice(vocabulary) for _ in range(rng.randint(15, 50)))) for i in range(20)]
    items += [(90, "short one here"), (91, None), (92, "")]
    docs, wanted = [], {}
    for n in range(200):
        words = [rng.choice(vocabulary) for _ in range(150)]
        if n % 2:
            item, text = items[n % 20]
            part = text.split()
            for _ in range(int(len(part) * 0.1)):
                part[rng.randrange(len(part))] = "edit"
            words[60:60] = [p.upper() for p in part]
            wanted[n, item] = True
        docs.append(" ".join(words))
    docs.append("a Short One HERE b")
    table = spark.createDataFrame(items, "item_id long, text string")
    found = {(r.doc_id, r.item_id): r for r in contamination(frame(spark, docs), table).collect()}
    assert (200, 90) in found and set(found) - {(200, 90)} <= set(wanted)
    assert len(found) - 1 >= 0.95 * len(wanted)
    assert all(abs(r.start - 60) <= 5 for k, r in found.items() if k[0] < 200)
    clean = without_contamination(frame(spark, docs), table)
    assert sorted(r.doc_id for r in clean.collect()) == sorted(set(range(201)) - {k[0] for k in found})
    assert without_contamination(odd, table).count() == odd.count()
    assert contamination(odd, table.limit(0)).count() == 0 and contamination(odd.limit(0), table).count() == 0


def test_grammar_tells_contexts_apart():
    grammar = Grammar({"idiot": 5.0, "fool$": 3.0})
    kinds = ("plain", "aimed", "negated", "reported", "threat", "aimed_threat")

    def found(text):
        return {k: v for k, v in zip(kinds, grammar.evidence(text)) if v}

    assert found("What idiots. Nothing else.") == {"plain": 5.0}
    assert found("You are a fool!") == {"aimed": 3.0}
    assert found("Not an idiot. Foolish, though") == {"negated": 5.0}
    assert found('Somebody said "fool" then') == {"reported": 3.0}
    assert found("I will kill you") == {"aimed_threat": 1.0}
    assert not found(None) and not found("") and not found("skill and nonidiotic")


def test_toxicity_learns_from_labels(spark, odd):
    rng = random.Random(7)
    rows, labels = [], []
    for i in range(600):
        words = [rng.choice("abcdefghij") * rng.randint(1, 6) for _ in range(60)]
        if toxic := i % 5 == 0:
            words[10] = words[40] = rng.choice(["zorgling", "zorgest", "blarg"])
        rows.append((i, " ".join(words), None, None, 0))
        labels.append((i, int(toxic)))
    docs, table = spark.createDataFrame(rows, DOCS), spark.createDataFrame(labels, "doc_id long, toxic int")
    model = train(docs, table)
    got = {r.doc_id: r for r in score(docs, model).collect()}
    assert sum(got[i].predicted == y for i, y in labels) >= 595
    assert sorted(r.doc_id for r in without_toxic(docs, model).collect()) == sorted(i for i in got if not got[i].predicted)
    assert all(0 <= r.score <= 1 for r in score(odd, model).collect()) and score(odd.limit(0), model).count() == 0
    nothing = train(docs, table.limit(0))
    assert isinstance(nothing, Model) and not nothing.stems and score(docs, nothing).where("predicted = 1").count() == 0


def test_licences(spark, odd):
    texts = [
        "Prose of no licence at all.\nReleased under the MIT License.",
        "Licensed under the Apache License, Version 2.0.",
        "A driver must show a licence at the counter of the old station",
        "This work is licensed under the GNU General Public License, version 2.",
        "Licensed under CC BY-NC 4.0.\n\nLicensed under CC BY 4.0.",
    ]
    got = {(r.doc_id, r.paragraph): (r.family, r.confirmed) for r in scan(frame(spark, texts * 3)).collect()}
    assert got[0, 1] == ("MIT", True) and got[1, 0] == ("Apache-2.0", True) and got[3, 0] == ("GPL", True)
    assert got[4, 0] == ("CC-BY-NC", True) and got[4, 2] == ("CC-BY", True) and not got[2, 0][1]
    assert scan(odd).count() == 0
