import gzip
import random

import numpy as np
import pytest

from salespanel.llm import (
    arc, automaton, induced, licenses, quality_rules, ring, sketch_dedup, subsequence, suffix, temperature, tensored,
)

import sys, os
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
import brute

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=str)


@pytest.fixture(scope="module")
def corpus():
    """Copies, near copies, shared passages, nulls, empty, odd and long texts."""
    draw = random.Random(5)
    vocabulary = [f"w{i}" for i in range(300)] + ["Été", "naïve", "漢字", "x y", "a b"]
    def some(n):
        return [draw.choice(vocabulary) for _ in range(n)]
    base, passage = some(220), some(60)
    texts = [None, "", " \n\t ", "one", "Two words", "same " * 500, "\n".join(["line a b c"] * 30)]
    texts += [" ".join(base)] * 4
    for k in range(30):
        copy = list(base)
        for _ in range(k):
            copy[draw.randrange(len(copy))] = f"new{draw.randrange(1000)}"
        texts.append(" ".join(copy))
    for k in range(20):
        at = draw.randrange(80)
        x = some(120)
        texts.append(draw.choice(["\n", " ", "  "]).join(x[:at] + passage[draw.choice([0, 0, 10]) :] + x[at:]))
    texts += [" ".join(some(n)) for n in (19, 20, 34, 35, 36, 3000)]
    return [(i * 3 + 1, t) for i, t in enumerate(texts)]


@pytest.fixture(scope="module")
def docs(spark, corpus):
    made = [(i, t, ("en", "de", None)[i % 3], ("hot", "hot", "b", None)[i % 4], len(t or "")) for i, t in corpus]
    return spark.createDataFrame(made, DOCS).repartition(3).persist()


def test_base_rules(docs, corpus):
    found = rows(quality_rules.measured(docs), "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    assert found == sorted(((d, *brute.base_rules(t)) for d, t in corpus), key=str)


def test_binomial_tail_is_exact():
    from math import comb
    for n, k, p in ((10, 0, 0.3), (40, 3, 0.2), (200, 1, 0.02)):
        want = sum(comb(n, i) * p**i * (1 - p) ** (n - i) for i in range(k + 1))
        assert quality_rules.binomial_tail(k, n, p) == pytest.approx(want, rel=1e-9)


def test_certified_cutoffs_keep_good_documents(spark):
    good, bad = np.zeros(65, int), np.zeros(65, int)
    good[0], good[3], bad[20] = 5000, 4, 300
    step = quality_rules.certified_cutoff(good, bad, 0.004, 0.005, 20)
    assert step is not None and 3 < step <= 20
    assert quality_rules.certified_cutoff(good // 100, bad, 0.004, 0.005, 20) is None  # too few labels
    assert quality_rules.certified_cutoff(good, bad * 0, 0.004, 0.005, 20) is None  # nothing to gain


def test_quality_rules_end_to_end(spark):
    clean, junk = " ".join(f"word{i}" for i in range(60)), " ".join(f"w{i}###" for i in range(60))
    made = [(i, junk if i % 5 == 0 else clean + f" v{i}", "en") for i in range(6000)]
    docs = spark.createDataFrame(made + [(9000, junk, None), (None, clean, "en")], "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(i, int(i % 5 > 0)) for i in range(0, 6000)] + [(1, None), (77777, 1)], "doc_id long, quality int")
    kept = {r["doc_id"]: r["kept"] for r in quality_rules.quality_decisions(docs, labels).collect()}
    assert kept[0] is False and kept[1] is True and kept[9000] is True and kept[None] is True
    assert sum(kept[i] for i in range(6000)) == 4800
    assert quality_rules.filter_documents(docs, labels).columns == docs.columns
    assert quality_rules.quality_decisions(docs.limit(0), labels).count() == 0
    assert quality_rules.quality_decisions(docs, labels.limit(0)).filter("kept").count() == 6002


def test_quality_path_is_nested_and_laid_by_bad_labels():
    bad = np.zeros((2, 9), int)
    bad[0, [0, 3, 8]], bad[1, [2, 7]] = (50, 6, 4), (9, 1)
    moves = quality_rules.path_of(bad)
    assert sorted(moves) == [(0, 3), (0, 8), (1, 2), (1, 7)] and moves[0] == (0, 8)
    places = quality_rules.places_on(moves, 2, 9)
    for r in (0, 1):
        for step in range(9):
            first = [i for i, (rule, to) in enumerate(moves) if rule == r and to <= step]
            assert places[r][step] == (first[0] if first else 4)
    assert quality_rules.path_of(np.zeros((5, 65), int)) == []
    many = np.zeros((2, 65), int)
    many[0, 2:26], many[1, 43] = 2, 1  # one bad document far up does not come first
    assert [r for r, _ in quality_rules.path_of(many)] == [0] * 24 + [1]


def test_quality_path_certifies_all_rules_together():
    good, bad = np.array([0, 0, 7, 293]), np.array([20, 9, 1, 3])
    assert quality_rules.certified_moves(good, bad, 0.02, 0.0125, 20) == (2, 29)
    assert quality_rules.certified_moves(good // 2, bad, 0.02, 0.0125, 20) == (0, 0.0)  # 149 labels are too few
    assert quality_rules.labels_needed(0.02, 0.0125) == 217 and quality_rules.labels_needed(0.004, 0.0025) == 1495


def test_quality_rules_with_a_few_hundred_labels(spark):
    clean, junk = " ".join(f"word{i}" for i in range(60)), " ".join(f"w{i}###" for i in range(60))
    made, labels = [], []
    for lang, n in (("en", 2000), ("fr", 300), ("es", 230), ("pt", 100), (None, 260)):
        for i in range(n + 40):
            d = len(made)
            made.append((d, junk if i >= n else clean + f" v{i}", lang))
            labels.append((d, int(i < n)))
    docs = spark.createDataFrame(made, "doc_id long, text string, lang string")
    found = quality_rules.quality_decisions(docs, spark.createDataFrame(labels, "doc_id long, quality int"))
    gone = {r["lang"]: r["count"] for r in found.filter("not kept").groupBy("lang").count().collect()}
    assert gone == {"en": 40, "fr": 40, "es": 40, None: 40}
    assert found.filter("not kept and n_symbols = 0").count() == 0


def test_passages(docs, corpus):
    found = rows(sketch_dedup.removal(docs), "doc_id", "n_words", "n_removed", "kept_sha256")
    assert found == sorted(brute.passages(corpus, 35), key=str)
    assert sketch_dedup.remove_repeats(docs).columns == docs.columns


def test_passages_of_long_windows(spark):
    """An anchor that more than 256 windows share."""
    draw = random.Random(4)
    shared = [f"p{draw.randrange(10**6)}" for _ in range(900)]
    made = [(i, " ".join([f"d{i}.{j}" for j in range(50)] + shared + [f"e{i}.{j}" for j in range(50)])) for i in range(8)]
    made += [(20 + i, " ".join(f"x{i}.{j}" for j in range(700))) for i in range(4)]
    frame = spark.createDataFrame(made, "doc_id long, text string")
    for window in (265, 266, 300, 600):
        found = rows(sketch_dedup.removal(frame, sketch_dedup.Passage(window=window)), "doc_id", "n_words", "n_removed", "kept_sha256")
        assert found == sorted(brute.passages(made, window), key=str), window


def test_strings(docs, corpus, monkeypatch):
    want = sorted(brute.strings(corpus, 400), key=str)
    columns = ("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
    assert rows(suffix.removal(docs), *columns) == want
    monkeypatch.setattr(suffix, "MANY_PIECES", 1)
    monkeypatch.setattr(suffix, "SHARD_BYTES", 20_000)
    assert rows(suffix.removal(docs), *columns) == want


def test_strings_store_each_piece_once(spark, docs, monkeypatch):
    """A stored table costs its rows, and a file for every task that writes it."""
    stored = []

    def kept(df, name="step", store=suffix.cut_lineage):
        stored.append(store(df, name))
        return stored[-1]

    monkeypatch.setattr(suffix, "cut_lineage", kept)
    suffix.removal(docs)
    pieces = [df for df in stored if {"piece", "copies"} <= set(df.columns)]
    every = pieces[0]
    for more in pieces[1:]:
        every = every.unionByName(more)
    assert 0 < every.count() == every.distinct().count()


def test_suffix_arrays():
    draw = random.Random(1)
    for _ in range(400):
        n, letters = draw.randrange(0, 40), draw.choice([1, 2, 3, 26])
        s = np.array([draw.randrange(letters) for _ in range(n)], np.int64)
        if draw.random() < 0.3 and n:
            s = np.tile(s[: max(1, n // 4)], 4)
        want = sorted(range(len(s)), key=lambda i: s[i:].tolist())
        array = induced.suffix_array(s)
        assert array.tolist() == want
        if len(s):
            lengths = induced.permuted_prefixes(s, array)
            for a, b in zip(want, want[1:]):
                common = 0
                while max(a, b) + common < len(s) and s[a + common] == s[b + common]:
                    common += 1
                assert lengths[b] == common


def test_near_duplicates(docs, corpus):
    columns = ("doc_id", "n_shingles", "component_id", "kept")
    for like in (tensored.Likeness(words=3, percent=85), tensored.Likeness()):
        assert rows(tensored.near_duplicates(docs, like), *columns) == sorted(brute.near(corpus, like.words, like.percent), key=str)


def test_near_duplicates_far_from_the_leader(spark):
    """Variants that are linked with each other, but not with the text most are linked with."""
    draw = random.Random(3)
    base = [f"b{i}" for i in range(300)]
    made = []
    for v in range(12):
        variant = list(base)
        for _ in range(9):
            variant[draw.randrange(300)] = f"v{v}.{draw.randrange(10**6)}"
        for _ in range(4):
            copy = list(variant)
            copy[draw.randrange(300)] = f"c{draw.randrange(10**6)}"
            made.append(" ".join(copy))
    made += [" ".join(base[:150] + [f"h{i}"] + base[151:]) for i in range(25)]
    rows_in = list(enumerate(made))
    found = rows(tensored.near_duplicates(spark.createDataFrame(rows_in, "doc_id long, text string"), tensored.Likeness(words=3, percent=85)), "doc_id", "n_shingles", "component_id", "kept")
    assert found == sorted(brute.near(rows_in, 3, 85), key=str)


def test_near_duplicates_repeated_and_missing_ids(spark):
    made = [(5, "a b c d e f"), (5, "u v w x y z"), (2, "u v w x y z"), (9, "a b c d e f"), (None, "a b c d e f"), (7, None)]
    frame = spark.createDataFrame(made, "doc_id long, text string")
    found = {(r["doc_id"], r["component_id"], r["kept"]) for r in tensored.near_duplicates(frame).collect()}
    assert found == {(5, 2, False), (2, 2, True), (9, 2, False), (None, None, True), (7, 7, True)}
    assert sorted(r["doc_id"] or 0 for r in tensored.one_of_each(frame).collect()) == [0, 2, 7]
    assert tensored.near_duplicates(frame.limit(0)).count() == 0


def test_contamination(spark, docs, corpus):
    items = [(1, corpus[8][1]), (2, "w1 W2"), (3, None), (4, "--"), (10, " ".join((corpus[50][1] or "").split()[:30])), (None, "été")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    want = sorted(brute.contamination(corpus, items, 10), key=str)
    columns = ("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")
    assert rows(automaton.contamination(docs, bench), *columns) == want
    one = rows(automaton.contaminated_spans(docs.select("doc_id", "text"), bench), "doc_id", "spans", "items")
    many = rows(automaton.contaminated_spans(docs.select("doc_id", "text"), bench, block_words=40), "doc_id", "spans", "items")
    assert one == many
    assert automaton.contamination(docs, bench.limit(0)).filter("contaminated").count() == 0
    left = automaton.decontaminate(docs, bench)
    assert left.columns == docs.columns and left.count() < docs.count()


def test_benchmark_blocks_are_bounded_and_lose_no_window(spark):
    draw = random.Random(11)
    long = [f"v{draw.randrange(400)}" for _ in range(700)]
    items = [(i, " ".join(draw.choice(long) for _ in range(draw.choice([4, 15, 30])))) for i in range(40)]
    items += [(90, " ".join(long)), (90, " ".join(long)), (None, " ".join(long[100:160])), (91, None), (92, " ")]
    bench = spark.createDataFrame(items, "item_id long, text string").repartition(5)
    blocks = automaton.item_blocks(bench, span=10, block_words=80).collect()
    sizes, windows = {}, set()
    for r in blocks:
        piece = r.words.split(" ")
        sizes[r.block] = sizes.get(r.block, 0) + len(piece)
        windows |= {(r.item, *piece[i : i + 10]) for i in range(max(1, len(piece) - 9))}
        assert len(piece) <= 20
    assert sorted(sizes) == list(range(len(sizes))) and len(sizes) > 10 and max(sizes.values()) < 100
    want = set()
    for i, t in items:
        w = (t or "").split()
        want |= {("" if i is None else str(i), *w[j : j + 10]) for j in range(max(1, len(w) - 9))} if w else set()
    assert windows == want
    texts = [(d, " ".join(draw.choice([long[k : k + 12], long[k : k + 9], ["other", "words"]])))
             for d, k in enumerate(draw.randrange(690) for _ in range(60))]
    texts += [(60, " ".join(long[40:400])), (60, " ".join(long[40:400])), (61, None), (62, "")]
    docs = spark.createDataFrame([(*t, "x", 1) for t in texts], "doc_id long, text string, items string, row long")
    found = automaton.contaminated_spans(docs, bench, block_words=80)
    assert sorted(found.columns) == sorted(["doc_id", "text", "row", "words", "spans", "items"])
    plain = sorted(brute.contamination(texts, items, 10), key=str)
    got = [(r.doc_id, r.words, sum(s.hi - s.lo for s in r.spans), len(r["items"])) for r in found.collect()]
    assert sorted(got, key=str) == sorted((p[:4] for p in plain), key=str)


def test_automaton_on_small_alphabets():
    draw = random.Random(3)
    for _ in range(60):
        some = lambda n: " ".join(draw.choice("abcd") for _ in range(draw.randrange(n)))
        items = [(i, some(draw.choice([3, 8, 25]))) for i in range(draw.randrange(1, 9))]
        span = draw.choice([3, 4, 10])
        machine = automaton.Automaton([(str(i), w) for i, t in items if (w := automaton.words_of(t))], span)
        for text in (some(60) for _ in range(10)):
            spans, found = machine.match(automaton.words_of(text))
            want = brute.contamination([(0, text)], items, span)[0]
            assert (sum(b - a for a, b in spans), len(found)) == want[2:4]


PAGES = [(1, "http://a b/\n", "x"), (2, None, "x"), (3, "u", None), (4, "u", ""), (5, "u", "\r\n\r\nWARC/1.0\r\n\r\nfiledesc://x\n1 0"), (7, "u", "é\n\n")]


def test_archives(spark):
    frame = spark.createDataFrame(PAGES, "page_id long, url string, html string")
    found = arc.archive_pages(frame)
    assert rows(found, "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to") == sorted(brute.archives(PAGES), key=str)
    assert found.filter("NOT intact").count() == 0
    odd = spark.createDataFrame([(None, "u", "x"), (7, "u", "x"), (7, "u", "x")], "page_id long, url string, html string")
    kinds = sorted(r["record_type"] for r in arc.archive_pages(odd).collect())
    assert kinds == ["response", "revisit", "revisit"]
    assert arc.archive_pages(frame.limit(0)).count() == 0


def test_archives_are_read_once_and_packed_quickly(spark, tmp_path, monkeypatch):
    """ARC records without their blocks, and WARC records, are stored, not read again for each use."""
    scans = lambda df: df._jdf.queryExecution().optimizedPlan().toString().count("binaryFile")
    read = []
    write = arc._write
    monkeypatch.setattr(arc, "_write", lambda values, *more: read.append(scans(values)) or write(values, *more))
    frame = spark.createDataFrame(PAGES, "page_id long, url string, html string")
    assert (scans(arc.archive_pages(frame)), read) == (0, [0, 1])
    draw = random.Random(2)
    text = " ".join(f"word{draw.randrange(3000)}" for _ in range(40_000))
    arc.write_arc(spark.createDataFrame([(1, "u", text)], "page_id long, url string, html string"), f"{tmp_path}/arc")
    packed = max((f.read_bytes() for f in (tmp_path / "arc").glob("part-*")), key=len)
    whole = arc.inflated(packed)
    assert text.encode() in whole
    assert len(gzip.compress(whole, 6)) < len(packed) < len(gzip.compress(whole, 1))


def test_arc_versions():
    date = "20010203040506"
    data = "\n".join([
        arc.arc_version_block(1, date), arc.arc_record(1, "http://x/a b", date, b"HTTP/1.1 200 OK\r\n\r\nhi"),
        arc.arc_version_block(2, date), arc.arc_record(2, "dns:x", date, b"raw"),
    ]).encode()
    found = list(arc.parse_arc(data))
    assert [r.version for r in found] == [1, 1, 2, 2]
    assert found[1].fields["URL"] == "http://x/a b" and found[3].block == b"raw"
    assert arc.iso_date("200102") == "2001-02-01T00:00:00Z"
    with pytest.raises(ValueError):
        list(arc.parse_arc(data[:-1]))


def per_record(version, date, urls, block):
    """An archive as legacy crawlers wrote it: a gzip member for each record."""
    records = [arc.arc_version_block(version, date).encode()]
    records += [arc.arc_line(version, u, date, block).encode() + block + b"\n" for u in urls]
    return b"".join(gzip.compress(r) for r in records)


def test_inflated_reads_every_member():
    date, block = "20010203040506", b"HTTP/1.1 200 OK\r\n\r\n" + random.Random(1).randbytes(3 * arc.FEED)
    one, two = per_record(1, date, ["http://a/", "http://b c/"], block), per_record(2, date, ["http://d/"], b"raw\xff")
    for data in (one + two, one + two + b"\0" * 9):
        found = [(r.version, r.fields["URL"], r.block) for r in arc.parse_arc(arc.inflated(data)) if "filedesc" not in r.fields["URL"]]
        assert found == [(1, "http://a/", block), (1, "http://b c/", block), (2, "http://d/", b"raw\xff")]
    for bad in (one[:-1], one[: len(one) - 9], one + two[:15], one + b"more", one[:-5] + b"x" + one[-4:]):
        with pytest.raises(ValueError):
            arc.inflated(bad)
    assert arc.inflated(b"plain") == b"plain" and arc.inflated(b"") == b""


def test_legacy_archives_with_a_member_for_each_record(spark, tmp_path):
    date, latin = "20010203040506", b"HTTP/1.0 200 OK\r\nContent-Type: text/html; charset=iso-8859-1\r\n\r\ncaf\xe9 \xff\x00"
    (tmp_path / "arc").mkdir()
    (tmp_path / "arc" / "a.arc.gz").write_bytes(per_record(1, date, ["http://a/", "http://b/"], latin) + per_record(2, date, ["http://c/"], b"HTTP/1.0 200 OK\r\n\r\n\x89PNG"))
    read = arc.read_arc(spark, f"{tmp_path}/arc", blocks=True)
    assert sorted((r["url"], bytes(r["block"])[-4:]) for r in read.collect()) == [("http://a/", b"\xe9 \xff\x00"), ("http://b/", b"\xe9 \xff\x00"), ("http://c/", b"\x89PNG")]
    back = arc.read_warc(spark, arc.convert(spark, f"{tmp_path}/arc", f"{tmp_path}/warc")).collect()
    assert sorted(r["record_type"] for r in back) == ["response", "response", "revisit"] and all(r["intact"] for r in back)
    stored = [r for f in sorted((tmp_path / "warc").glob("part-*")) for r in arc.parse_warc(arc.inflated(f.read_bytes()))]
    assert sorted(b for h, b in stored if h["warc-type"] == "response") == [b"HTTP/1.0 200 OK\r\n\r\n\x89PNG", latin]
    # a member for each record in the WARC as well
    whole = b""
    for h, b in stored:
        headers = {k: v for k, v in h.items() if k != "content-length"}
        whole += gzip.compress(arc.warc_record(headers, b) + arc.END_OF_RECORD.encode())
    (tmp_path / "again").mkdir()
    (tmp_path / "again" / "a.warc.gz").write_bytes(whole)
    assert sorted(map(str, arc.read_warc(spark, f"{tmp_path}/again").collect())) == sorted(map(str, back))


PAGE = """<html><head><title>T</title></head><body class="has-sidebar"><header><h1>Site</h1></header>
<div class="cookie-notice">We use cookies a lot here</div><ul class=menu><li><a href=x>Home</a><li><a href=y>News</a></ul>
<div id="content"><h1>My story &eacute;&nbsp;x</h1><p>One two three four <i>fi</i>ve.<p>Next para <a href="#">link</a> end<br>line two
<div class="ad">buy now buy now buy now</div><p>Last para.</p></div><aside>Other things you may like to read now</aside>
<section id="comments"><p>Great article I love it so much thanks</p></section><form><label>Mail</label></form>
<footer>&copy; me</footer><script>var a="<p>not text</p>"</script><!-- unclosed"""


def test_main_text():
    assert subsequence.main_text(PAGE, subsequence.Weights()) == (
        "My story é x\nOne two three four five.\nNext para link end line two\nLast para."
    )
    for page, text in ((None, ""), ("", ""), ("plain", "plain"), ("<p>a<p>b c", "a\nb c"), ("<script>x", ""), ("<<<>< a=' <", "<<<>< a=' <")):
        assert subsequence.main_text(page, subsequence.Weights()) == text


STORY = "<h1>A title of five words</h1><p>one two three four five six</p><p>seven eight nine ten eleven</p>"
STORY_TEXT = "A title of five words\none two three four five six\nseven eight nine ten eleven"


@pytest.mark.parametrize("wrapper", [
    "div class='content has-sidebar'", "div class=no-sidebar", "div id=layoutWithBanner", "form method=post", "div class='promo-layout'", "div class=widget",
])
@pytest.mark.parametrize("tag", ["div", "article", "main"])
def test_main_text_inside_a_named_wrapper(wrapper, tag):
    page = f"<body><{wrapper}><div class=sidebar>buy now</div><{tag}>{STORY}</{tag}><div id=comments>very nice</div></{wrapper.split()[0]}></body>"
    assert subsequence.main_text(page, subsequence.Weights()) == STORY_TEXT


def test_main_text_keeps_half_telling_names_inside_a_text():
    story = "<p>one two three four five</p>{}<p>six seven eight nine ten</p>"
    for middle in ("<p class='related-work'>and more of it</p>", "<div class='promotion-history'>and more of it</div>"):
        for tag in ("div", "article"):
            page = f"<div class='site-header-image'>a picture here</div><{tag}>{story.format(middle)}</{tag}><div class='newsletter-teaser'>write to us now</div>"
            assert subsequence.main_text(page, subsequence.Weights()) == "one two three four five\nand more of it\nsix seven eight nine ten"


def test_main_text_leaves_comments_and_cards_that_outweigh_the_text():
    weights = subsequence.Weights()
    comments = "<p>a reader says a lot more than the text does</p>" * 9
    assert subsequence.main_text(f"<div>{STORY}</div><section id=comments>{comments}</section>", weights) == STORY_TEXT
    assert subsequence.main_text(f"<article>{STORY}<div class=comments>{comments}</div></article>", weights) == STORY_TEXT
    assert subsequence.main_text(f"<article>{STORY}</article><div class=sidebar>{comments}</div>", weights) == STORY_TEXT
    cards = "<div class='related-posts'>" + "<article><p>read this too</p></article>" * 3 + "</div>"
    assert subsequence.main_text(f"<main>{STORY}</main>{cards}", weights) == STORY_TEXT
    assert subsequence.main_text(f"<div>{STORY}</div>{cards}", weights) == STORY_TEXT


def test_main_text_learns_the_weight_of_half_telling_names():
    page = "<div>x</div><article><p>one two three four five</p><p class='related-work'>six seven eight nine</p></article>"
    weights = subsequence.fit([page] * 20)
    assert weights.marked > 0 and subsequence.main_text(page, weights).endswith("eight nine")


def test_main_text_weights_find_held_out_articles(spark):
    draw = random.Random(2)
    def page(tag):
        body = "".join(f"<p>{' '.join(['word'] * draw.randrange(1, 9))}</p>" for _ in range(9))
        return f"<body><nav><a>menu item</a></nav><div><b>teaser text</b></div><{tag}><h1>T</h1>{body}</{tag}><footer>end</footer></body>"
    weights = subsequence.fit([page("article") for _ in range(60)])
    for _ in range(20):
        text = subsequence.main_text(page("article"), weights)
        assert text.startswith("T\n") and "teaser" not in text and "end" not in text
    frame = spark.createDataFrame([(1, "u", page("article")), (None, None, None)], "page_id long, url string, html string")
    found = {r["page_id"]: r["n_chars"] for r in subsequence.main_texts(frame).collect()}
    assert found[1] > 0 and found[None] == 0
    assert subsequence.main_texts(frame.limit(0)).count() == 0


def test_licenses(spark):
    plain = [f"the general public of town {i} read this work under a tree version {i % 7}" for i in range(400)]
    made = [(i, t) for i, t in enumerate(plain)] + [
        (1000, "a b\nReleased under the MIT License.\nc d"), (1001, " ".join(plain[:9]) + " Licensed under CC BY-NC 4.0. " + " ".join(plain[9:30])),
        (1002, "licensed under the Foo Public License, version 9"), (1003, None), (1004, ""),
    ]
    frame = spark.createDataFrame(made, "doc_id long, text string")
    found = {r["doc_id"]: r for r in licenses.scan(frame).collect()}
    assert found[1000]["families"] == ["MIT"] and found[1001]["families"] == ["CC-BY-NC"]
    assert found[1002]["families"] == [] and found[1003]["n_paragraphs"] == 0 == found[1004]["n_paragraphs"]
    assert all(not found[i]["families"] for i in range(400))
    assert licenses.scan(frame.limit(0)).count() == 0


def test_license_families_on_held_out_notices():
    model = licenses.Model(["ordinary words about nothing in particular"], licenses.Settings(seed=1))
    draw, right, total = random.Random(9), 0, 0
    for family, words in model.notices:
        for _ in range(10):
            judged = model.judge([w for w in words if draw.random() > 0.05] + ["more", "words"])
            right, total = right + (judged is not None and judged[0] == family), total + 1
    assert right / total > 0.9


def test_mixing(spark):
    made = [(i, "w " * (1 + i % 7), ("hot", "hot", "b", "c", None)[i % 5]) for i in range(3000)] + [(9999, None, "empty")]
    frame = spark.createDataFrame(made, "doc_id long, text string, source string")
    mix = temperature.Mixture(max_epochs=2.0, block_tokens=500)
    counted = frame.select("source", temperature.words_of(frame["text"]).alias("tokens"))
    plan = {r["source"]: r for r in temperature.source_plan(counted, mix).collect()}
    assert max(r["epochs"] for r in plan.values()) <= 2.0 + 1e-6
    read = temperature.mix_sources(frame, mix)
    got = {}
    for r in read.collect():
        got[r["source"]] = got.get(r["source"], 0) + r["tokens"]
    for source, r in plan.items():
        if r["tokens"]:
            assert got[source] == pytest.approx(r["weight"] * sum(p["tokens"] for p in plan.values()), rel=0.03)
    every = temperature.mix_sources(frame, temperature.Mixture(max_epochs=3.0, budget="all"))
    assert every.select("doc_id").distinct().count() == 3001
    places = every.groupBy("source", "block", "epoch").agg({"place": "max", "*": "count"}).collect()
    assert all(r["max(place)"] + 1 >= r["count(1)"] for r in places)
    assert temperature.mix_sources(frame.limit(0), mix).count() == 0


def test_mixing_exponents_against_bisection(spark):
    import math
    tokens = {"a": 700, "b": 200, "c": 90, "d": 10}
    frame = spark.createDataFrame([(s, n, 1) for s, n in tokens.items()], "source string, tokens long, docs long")
    def entropy(a):
        w = [(n / 1000) ** a for n in tokens.values()]
        return -sum(x / sum(w) * math.log(x / sum(w)) for x in w)
    lo, hi = 0.0, 1.0
    for _ in range(60):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if entropy(mid) >= 0.9 * math.log(4) else (lo, mid)
    assert temperature.find_exponent(frame, temperature.Mixture(entropy=0.9))[0] == pytest.approx(lo, abs=1e-6)


def test_ring(spark, docs, corpus):
    found = ring.shard_documents(docs).collect()
    assert {(r["doc_id"], r["size"], r["text_crc32"]) for r in found} == {(d, len((t or "").encode()) + 1, brute.crc(t)) for d, t in corpus}
    by = {}
    for r in found:
        by.setdefault(r["shard"], []).append(r["slot"])
    sizes = [len(by.get(s, [])) for s in range(8)]
    assert max(sizes) - min(sizes) <= 1 and all(sorted(v) == list(range(len(v))) for v in by.values())
    same = spark.createDataFrame([(1, "x")] * 50 + [(None, f"{i}") for i in range(51)], "doc_id long, text string")
    again = [r["shard"] for r in ring.shard_documents(same).collect()]
    assert {again.count(s) for s in range(8)} <= {12, 13}
    assert ring.shard_documents(docs.limit(0)).count() == 0
    clash = docs.withColumnsRenamed({"source": "slot", "lang": "hash"})
    assert ring.place_on_ring(clash, "doc_id").columns == ["doc_id", "text", "hash", "n_chars", "law", "shard", "slot"]


def test_ring_moves_little(spark):
    frame = spark.range(4000).withColumnRenamed("id", "doc_id")
    old = {r["doc_id"]: r["shard"] for r in ring.place_on_ring(frame, "doc_id", 8).collect()}
    new = {r["doc_id"]: r["shard"] for r in ring.place_on_ring(frame, "doc_id", 9).collect()}
    assert sum(old[i] != new[i] for i in old) < 4000 * 0.4  # a plain modulus moves 8 of 9


def test_stages_keep_columns(spark, tmp_path):
    import corpus_pipeline

    made = [(i, f"clean text number {i} " + " ".join(f"t{i}.{j}" for j in range(40)), "en", "s", 1, "more") for i in range(40)]
    made += [(100, made[0][1], "en", "s", 1, None), (101, None, None, None, None, None), (102, "", "en", "s", 0, "x")]
    frame = spark.createDataFrame(made, DOCS + ", slot string")
    spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, made[1][1])], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    out = frame
    for n, (_, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, out, str(tmp_path))
        assert n == 4 or out.columns == frame.columns
    ids = [r["doc_id"] for r in out.collect()]
    assert set(ids) == set(range(40)) - {1}  # the copy, the empty ones and the benchmark's text are gone


def swapped(n):
    """Two words of 2^n letters, each the other with its letters swapped (Thue and Morse)."""
    x, y = "a", "b"
    for _ in range(n):
        x, y = x + y, y + x
    return x, y


def test_long_words_that_sums_cannot_tell_apart(spark):
    from salespanel.llm.hashing import Runs, Words
    x, y = swapped(12)
    found = Words([x.encode(), y.encode()])
    sums = Runs(found.buffer).of(found.starts, found.ends)
    assert sums[0] == sums[1] and found.hashes[0] != found.hashes[1]
    rest = [f"w{i}" for i in range(40)]
    texts = [(1, " ".join(rest[:20] + [x] + rest[20:])), (2, " ".join(rest[:20] + [y] + rest[20:]))]
    table = spark.createDataFrame(texts, "doc_id long, text string")
    got = {r.doc_id: r.n_removed for r in sketch_dedup.removal(table).collect()}
    assert got == {1: 0, 2: 0}
    near = tensored.near_duplicates(table, tensored.Likeness(words=3, percent=95)).collect()
    assert {r.doc_id: r.component_id for r in near} == {1: 1, 2: 2}


def test_places_on_the_ring_do_not_depend_on_the_session(spark, docs):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    found = []
    for n in ("8", "13"):
        spark.conf.set("spark.sql.shuffle.partitions", n)
        found.append(rows(ring.shard_documents(docs), "doc_id", "shard", "slot"))
    spark.conf.set("spark.sql.shuffle.partitions", before)
    assert found[0] == found[1]


def test_batches_are_cut_by_bytes():
    import pyarrow as pa
    from salespanel.llm.arrow import parts
    texts = ["x" * n for n in (10, 5_000, 1, 70_000, 0, 300)]
    batch = pa.RecordBatch.from_arrays([pa.array(texts), pa.array(range(6))], ["text", "n"])
    cut = list(parts(batch, 6_000))
    assert [t for p in cut for t in p.column(0).to_pylist()] == texts
    assert len(cut) > 2 and all(p.num_rows == 1 or p.nbytes <= 6_000 for p in cut)
    assert list(parts(batch.slice(0, 0))) == []
