"""The ten operators against brute force on small tables with nulls, empties, copies, ties and odd columns."""

import base64
import hashlib
import io
import math
import random
import re
import struct
import zlib
from collections import Counter
from fractions import Fraction

import numpy as np
import public_tokenizers
import pytest
import tiktoken
import zstandard
from tokenizers import Tokenizer

from slotwise.llm import bloom_lm, byte_bpe, fit_packing, host_consensus, language_mixture, license_scan
from slotwise.llm import media_columns, quality_bands, signature_join, suffix_dedup

WORD = r"[^\x20\x09-\x0D]+"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, tag string, key string, rank int, n long, row long"


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def prose(rng, n, words):
    return " ".join(rng.choice(words) + rng.choice(["", "", ",", "."]) for _ in range(n))


@pytest.fixture(scope="module")
def rows():
    """(doc_id, text, lang): prose in two made-up languages, copies, near copies, shared passages and odd texts."""
    rng = random.Random(5)
    tongues = {x: ["".join(rng.choice(s) for _ in range(rng.randint(1, 4))) for _ in range(300)] for x, s in (("aa", ["the", "ing", "wh", "ea"]), ("bb", ["éz", "ño", "qua", "ió"]))}
    out = []
    for i in range(60):
        lang = rng.choice(["aa", "bb"])
        out.append((i, prose(rng, rng.randint(40, 200), tongues[lang]), lang))
    texts = [t for _, t, _ in out]
    passage = prose(rng, 60, tongues["aa"])
    words = texts[0].split(" ")
    near = " ".join([*words[:20], "changed", *words[21:]]) if len(words) > 60 else texts[0] + " end"
    extra = [
        None, "", " \n\t ", "x", "!!! 123 ;;", texts[1], texts[1], near, texts[2] + "\n" + passage, texts[3] + " " + passage + " " + texts[4],
        passage + passage, "a" * 700, "the Apache License, Version 2.0 and CC BY; MIT License\nGNU General Public License GNU GENERAL public license",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files",
        "it's <|endoftext|> ok \x85 x\t\n\n 漢字🙂 ١٢٣ á", "line one here\nline one here\n\nline two", "one two three", prose(rng, 4000, tongues["aa"]), "é" * 130,
        "w1 w2 w3 w4 w5 w6 " * 30,
    ]
    out += [(100 + i, t, rng.choice(["aa", None])) for i, t in enumerate(extra)]
    out += [out[5], (5, "same id, another text that is long enough to count", "aa"), (None, texts[6], "bb"), (None, None, None)]
    return out


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame([(i, t, x, "s", 1, "t", "k", 2, 3, 4) for i, t, x in rows], SCHEMA).repartition(5)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def same(frame, want):
    """Rows as a multiset."""
    assert Counter(map(tuple, frame.collect())) == Counter(want)


def raw(text):
    return (text or "").encode()


def test_byte_bpe(docs, none, rows, monkeypatch):
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    ranks = byte_bpe.read_ranks(path)
    assert ranks == {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(path, "rb"))}
    own = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    want = []
    for i, t, _ in rows:
        ids = own.encode_ordinary(t or "")
        want.append((i, len(ids), hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest(), hashlib.sha256(raw(t)).hexdigest()))
    for size in (5, 1000):
        monkeypatch.setattr(byte_bpe, "DICTIONARY_WORDS", size)
        same(byte_bpe.round_trip(docs, ranks, public_tokenizers.PATTERN), want)
    assert byte_bpe.round_trip(none, ranks, public_tokenizers.PATTERN).count() == 0


def test_language_mixture(docs, none, rows):
    got = language_mixture.identify(docs).collect()
    assert len(got) == len(rows)
    by = {r.doc_id: r for r in got if r.doc_id is not None}
    for i, t, x in rows[:60]:
        assert by[i].held_out == (zlib.crc32(str(i).encode()) % 3 == 1)
        assert i == 5 or by[i].lang_pred == x and by[i].score > 0.8
    for i in (100, 101, 102, 104):
        assert (by[i].lang_pred, by[i].score) == ("und", 0.0)
    assert {r.lang_pred for r in got} == {"aa", "bb", "und"}
    assert language_mixture.identify(none).count() == 0
    assert language_mixture.keep_known(docs).columns == docs.columns
    assert language_mixture.keep_known(docs).count() == sum(r.lang_pred != "und" for r in got)


def test_mixture_finds_both_languages(spark, rows):
    texts = {x: " ".join(t for _, t, y in rows[:60] if y == x) for x in ("aa", "bb")}
    train = spark.createDataFrame([(i, t, x, "s", 1, "t", "k", 2, 3, 4) for i, t, x in rows[:60]], SCHEMA)
    names, model = language_mixture.train(train)
    mixed = spark.createDataFrame([(0, texts["aa"][:3000] + " " + texts["bb"][:1000])], "doc_id long, text string")
    shares = dict(x.split(":") for x in language_mixture.predict(mixed, names, model).first().languages.split(","))
    assert 0.6 < float(shares["aa"]) < 0.9 and set(shares) == {"aa", "bb"}


def test_equal_parts_of_many_languages(spark, tmp_path, monkeypatch):
    """Every language of a text is found, and no clean text goes for having several."""
    rng = random.Random(8)
    kinds = {"aa": ["the", "ing", "wh"], "bb": ["éz", "ño", "qu"], "cc": ["sch", "ürg", "zk"], "dd": ["oui", "aux", "lj"], "ee": ["pyk", "øvb", "fim"], "ff": ["gom", "dax", "žir"]}
    tongues = {x: ["".join(rng.choice(s) for _ in range(rng.randint(1, 4))) for _ in range(300)] for x, s in kinds.items()}
    train = [(i, prose(rng, 150, tongues[x]), x) for i, x in enumerate([*kinds] * 10)]
    sets = [tuple(kinds)[:n] for n in (1, 2, 3, 4, 5, 6)]
    mixed = [(1000 + n, "\n".join(prose(rng, 400, tongues[x]) for x in own), None) for n, own in enumerate(sets)]
    frame = spark.createDataFrame(train + mixed, "doc_id long, text string, lang string")
    for cells in (language_mixture.BLOCK_CELLS, 1):
        monkeypatch.setattr(language_mixture, "BLOCK_CELLS", cells)
        got = {r.doc_id: dict(x.split(":") for x in r.languages.split(",")) for r in language_mixture.identify(frame).collect()}
        for n, own in enumerate(sets):
            assert set(got[1000 + n]) == set(own)
            assert all(abs(float(share) - 1 / len(own)) < 0.1 for share in got[1000 + n].values())
    import corpus_pipeline

    assert corpus_pipeline.language(spark, frame, str(tmp_path)).count() == len(train) + len(mixed)


def test_packing_plans():
    rng = random.Random(1)
    for _ in range(200):
        room = rng.choice([10, 20, 50, 100])
        counts = {rng.randint(1, room): rng.randint(1, 40) for _ in range(rng.randint(1, 12))}
        held = Counter()
        bins = 0
        for pattern, n in fit_packing.plan(counts, room):
            assert n > 0 and sum(pattern) <= room
            bins += n
            for x in pattern:
                held[x] += n
        assert held == counts
        assert bins <= 1.7 * max(-(-sum(k * n for k, n in counts.items()) // room), sum(n for k, n in counts.items() if 2 * k > room)) + 1
    huge = fit_packing.plan({k: 10**12 + k for k in range(1, 1024)}, 1024)
    assert len(huge) < 10_000 and sum(n for _, n in huge) <= sum(k * (10**12 + k) for k in range(1, 1024)) / 1024 * 1.001


def best(counts, room, held=()):
    """Fewest bins by trying everything."""
    items = [k for k, n in sorted(counts.items(), reverse=True) for _ in range(n)]
    fewest = len(items)

    def put(i, bins):
        nonlocal fewest
        if len(bins) >= fewest:
            return
        if i == len(items):
            fewest = len(bins)
            return
        for b in range(len(bins)):
            if bins[b] + items[i] <= room and bins[b] not in bins[:b]:
                put(i + 1, [*bins[:b], bins[b] + items[i], *bins[b + 1 :]])
        put(i + 1, [*bins, items[i]])

    put(0, [])
    return fewest


def test_reduction_keeps_the_optimum():
    rng = random.Random(3)
    for _ in range(150):
        counts = Counter(rng.randint(1, 12) for _ in range(8))
        fixed, left = fit_packing.reduce_items(dict(counts), 12)
        assert sum(n for _, n in fixed) + best(left, 12) == best(counts, 12)


def test_latin_splitting_equals_the_pattern():
    import regex

    fast, plain = fit_packing.latin_pattern(public_tokenizers.PATTERN), regex.compile(public_tokenizers.PATTERN)
    rng = random.Random(8)
    letters = [chr(c) for c in range(0x250) if not 0x1C <= c < 0x20]
    assert all(fit_packing.LATIN(c) and fast.findall(c * 2) == plain.findall(c * 2) for c in letters)
    for _ in range(300):
        text = "".join(rng.choice(rng.choice([letters, "ab 's12 \n.,²é  ", "'ll 've\t\x85\xa0"])) for _ in range(80))
        assert fit_packing.LATIN(text) and fast.findall(text) == plain.findall(text)
    assert not fit_packing.LATIN("a漢") and not fit_packing.LATIN("a\x1c")


def test_packing(docs, none, rows):
    path = public_tokenizers.path("byte_bpe_50k.json")
    own = Tokenizer.from_file(path)
    got = fit_packing.pack_documents(docs, path, public_tokenizers.PATTERN, 64).collect()
    want = Counter()
    for i, t, _ in rows:
        ids = [*own.encode(t or "", add_special_tokens=False).ids, fit_packing.END_ID]
        first = len(ids) % 64 or 64
        for k, (a, b) in enumerate([(0, first), *((a, a + 64) for a in range(first, len(ids), 64))]):
            want[i, k, a, b - a, zlib.crc32(struct.pack(f"<{b - a}I", *ids[a:b]))] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == want
    bins = {}
    for r in got:
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for held in bins.values():
        at = 0
        for offset, length in sorted(held):
            assert offset == at
            at += length
        assert at <= 64
    assert len(bins) <= 1.05 * sum(r.length for r in got) / 64 + 1
    assert fit_packing.pack_documents(none, path, public_tokenizers.PATTERN).count() == 0


def test_license_scan(docs, none, rows):
    got = {}
    for r in license_scan.scan(docs).collect():
        got.setdefault(r.doc_id, []).append(r)
    for i, t, _ in rows:
        words = license_scan.split_words(t or "")
        places, labels = [], set()
        for phrase, label in license_scan.BASE_PHRASES:
            own = phrase.split()
            hit = [k for k in range(len(words)) if words[k : k + len(own)] == own]
            places += hit
            labels |= {label} if hit else set()
        want = (len(words), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(labels)))
        match = [r for r in got[i] if (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == want]
        assert match and labels <= set(match[0].labels.split(",")) | {""}
    assert got[113][0].labels == "mit" and got[113][0].base_labels == "" and 0.6 < got[113][0].score < 0.8
    assert sum(map(len, got.values())) == len(rows) and license_scan.scan(none).count() == 0


def test_license_scan_of_many_notices(spark):
    """Every notice of a file counts, however many others stand beside it."""
    notices = {label: text for label, _, text in license_scan.TEMPLATES}
    sets = [list(notices), ["mit", "apache", "bsd", "mpl", "zlib"], ["bsd", "isc", "zlib", "boost"]]
    files = [(k, " filler words between\n".join(notices[x] for x in own)) for k, own in enumerate(sets)]
    files += [(10 + k, f"some prose number {k} of the corpus") for k in range(50)]
    got = {r.doc_id: set(r.labels.split(",")) for r in license_scan.scan(spark.createDataFrame(files, "doc_id long, text string")).collect()}
    for k, own in enumerate(sets):
        assert got[k] == set(own)


@pytest.mark.parametrize("keep", ["none", "first"])
@pytest.mark.parametrize("bucket", [2, 1024])
def test_suffix_dedup(docs, none, rows, keep, bucket, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "BUCKET", bucket)
    width = suffix_dedup.MIN_BYTES
    seen, first = Counter(), {}
    for i, t in sorted(((i if i is not None else -(2**63), t) for i, t, _ in rows), key=lambda r: r[0]):
        for k in range(len(raw(t)) - width + 1):
            piece = raw(t)[k : k + width]
            seen[piece] += 1
            first.setdefault(piece, (i, t, k))
    want = []
    for i, t, _ in rows:
        gone = bytearray(len(raw(t)))
        for k in range(len(gone) - width + 1):
            piece = raw(t)[k : k + width]
            if seen[piece] > 1 if keep == "none" else first[piece] != (i if i is not None else -(2**63), t, k):
                gone[k : k + width] = b"\1" * width
        kept = bytes(b for b, g in zip(raw(t), gone, strict=True) if not g)
        want.append((i, len(gone), sum(gone), len(re.findall(b"\1+", bytes(gone))), hashlib.sha256(kept).hexdigest()))
    assert sum(w[2] for w in want) > 1000
    same(suffix_dedup.digests(docs, keep), want)
    if keep == "first":
        out = suffix_dedup.without_repeats(docs, keep)
        assert out.columns == docs.columns and out.count() == len(rows)
        assert suffix_dedup.digests(none).count() == 0 and suffix_dedup.without_repeats(none).count() == 0


def test_smaller_positions():
    rng = np.random.default_rng(2)
    for _ in range(50):
        rank, position = rng.integers(0, 6, 20), rng.permutation(20)
        earlier, later = suffix_dedup.smaller_positions(rank, position)
        for i in range(20):
            own = position[rank == rank[i]]
            assert (earlier[i], later[i]) == ((own < position[i]).any(), (own > position[i]).any())


PAGE = (
    "<!DOCTYPE html><html><head><title>T</title><style>p{}</style></head><body><nav><ul><li><a href=x>menu</a></ul></nav>"
    "<!-- <p>hidden</p> --><div class='cookie-notice'>cookies</div><div id=c class='content post-7'><h1>Head &amp; line</h1>"
    "<p>First <b>bold</b>\n  text &eacute;<p>Second{0}<form><p>send</p></form><script>if (a < b) '</p>'</script></div>"
    "<div class=comments><p>bad</p></div><footer>&copy; me</footer></body></html>"
)


def test_host_consensus(spark):
    pages = [(i, f"https://Host{i % 2}.example/p{i}", PAGE.replace("{0}", f" part {i}"), "x") for i in range(6)]
    pages += [(10, "https://host0.example/short", "<html><body><div class='content post-99'><p>Only this</p></div><div class=links><p>longer words that would win alone here</p></div></body></html>", "x")]
    pages += [(11, None, None, "x"), (12, "nonsense", "", "x"), (13, "https://z.example", "plain <b>words", "x"), (0, *pages[0][1:])]
    got = host_consensus.main_text(spark.createDataFrame(pages, "page_id long, url string, html string, path string")).collect()
    assert len(got) == len(pages)
    texts = {r.page_id: r.text for r in got}
    for i in range(6):
        assert texts[i] == f"Head & line\n\nFirst bold text é\n\nSecond part {i}"
    assert (texts[10], texts[11], texts[12], texts[13]) == ("Only this", "", "", "plain words")
    assert all(r.n_chars == len(r.text) for r in got)
    empty = spark.createDataFrame([], "page_id long, url string, html string")
    assert host_consensus.main_text(empty).count() == 0


ARTICLE = "<article><h1>Title</h1><p>The article itself, with some text.</p>{}</article>"


@pytest.mark.parametrize("wrapper", ["layout with-sidebar", "no-sidebar", "has-navbar", "post share", "page-header", "social"])
def test_wrappers_keep_the_article(wrapper):
    menu = "<div class=sidebar><p>Side text</p></div><div class='ad'><p>Buy</p></div>"
    for page in (f"<body><div class='{wrapper}'>{menu}{ARTICLE}</div></body>", f"<body><div id='{wrapper}'><div class=content>{ARTICLE}</div>{menu}</div></body>"):
        assert host_consensus.extract(page.replace("{}", ""), None) == "Title\n\nThe article itself, with some text."
    page = f"<body><div class=menu><p>Menu</p></div><div class='{wrapper}'><p>Only text of this page, in no article.</p></div></body>"
    assert host_consensus.extract(page, None) == "Only text of this page, in no article."


def test_class_words_inside_an_article():
    work = "<section class='related-work'><p>Others did this before.</p></section>"
    links = "<div class='related-posts'><p><a href=x>Another post</a></p></div><div class=share><p>Share it</p></div>"
    assert host_consensus.extract(f"<body>{ARTICLE.replace('{}', work + links)}</body>", None).endswith("some text.\n\nOthers did this before.")


def test_long_comments_stay_out():
    reply = "<article class='comment'><div class='comment-body'><div class=text><p>A reply that is much longer than the page that it is about.</p></div></div></article>"
    for page in (ARTICLE.replace("{}", ""), "<div class=content><h1>Title</h1><p>The article itself, with some text.</p></div>"):
        assert host_consensus.extract(f"<body>{page}<div class=comments>{reply * 5}</div></body>", None) == "Title\n\nThe article itself, with some text."


def test_tags_of_odd_pages():
    page = "a<b>x</B ><!-- <p> --><p class='a>b' id=\"c'd\">t<script a='>'>if (a<b) <p></script ><!doctype x><br/><1><a <i>y<p title='open>z<!-- end"
    got = [(page[a:b], slash, name, attributes) for a, b, slash, name, attributes in host_consensus.tokens(page)]
    assert got == [
        ("<b>", "", "b", ""), ("</B >", "/", "b", " "), ("<!-- <p> -->", "", "", ""), ("<p class='a>b' id=\"c'd\">", "", "p", " class='a>b' id=\"c'd\""),
        ("<script a='>'>if (a<b) <p></script >", "", "", ""), ("<!doctype x>", "", "", ""), ("<br/>", "", "br", "/"), ("<a <i>", "", "a", " <i"), ("<!-- end", "", "", ""),
    ]


@pytest.mark.parametrize("unit", ["<a ", "<div>", "<div>x", "<a '", "<a '<b \"", "<p>x</section>", "<div class=main>y", "<script", "<!x", "<li><dd>z</p>", "&amp", "</div><dd>"])
def test_a_megabyte_of_malformed_html(unit):
    """Pages that never end their tags take time and memory in proportion to their length."""
    import time
    import tracemalloc

    page = "<body><p>Some text of the page.</p>" + unit * (1_000_000 // len(unit))
    start = time.process_time()
    text = host_consensus.extract(page, host_consensus.vote(page)[0])
    assert time.process_time() - start < 20 and text.startswith("Some text of the page.")
    tracemalloc.start()
    host_consensus.vote(page[:100_000])
    assert tracemalloc.get_traced_memory()[1] < 40_000_000
    tracemalloc.stop()


def test_votes_against_a_plain_count(spark):
    """Winning paths are those of adding up the pages' votes in a loop, and pages come out of them."""
    rng = random.Random(6)
    pages = []
    for k in range(60):
        body = "".join(f"<p>{prose(rng, rng.randint(5, 30), ['the', 'wh', 'ing', 'ea'])}</p>" for _ in range(rng.randint(1, 4)))
        side = f"<div class='w{k % 3}'><p>{prose(rng, rng.randint(1, 40), ['re', 'on'])}</p></div>"
        pages.append((k, f"http://h{k % 4}.example/{k}", f"<html><body><div class='x{k % 2} w/1'>{body}</div>{side}</body></html>", "p"))
    want = {}
    for _, url, page, _ in pages:
        path, score = host_consensus.vote(page)
        own = want.setdefault(url.split("/")[2], Counter())
        own[path] += math.log1p(score)
    winners = {host: min(own, key=lambda p: (-round(own[p], 6), p)) for host, own in want.items()}
    frame = spark.createDataFrame(pages, "page_id long, url string, html string, path string")
    hosts = frame.selectExpr("html", "split(url, '/')[2] as host")
    assert {r.host: r.path for r in host_consensus.winning_paths(hosts).collect()} == winners
    got = {r.page_id: r.text for r in host_consensus.main_text(frame.repartition(3)).collect()}
    assert got == {k: host_consensus.extract(page, winners[url.split("/")[2]]) for k, url, page, _ in pages}


def test_bloom_lm(docs, none, rows):
    held = [(i, zlib.crc32(str(i if i is not None else "").encode()) % 5 == 1, [*re.findall(WORD, lower(t)), "\0end"]) for i, t, _ in rows]
    count = Counter(w for _, out, ws in held if not out for w in ws)
    total, distinct = sum(count.values()), len(count)
    want = Counter()
    for i, out, ws in held:
        base = sum(math.log10((count[w] + 0.5) / (total + 0.5 * (distinct + 1))) for w in ws)
        want[i, out, len(ws), sum(count[w] > 0 for w in ws), total, round(base, 6)] += 1
    got = bloom_lm.score(docs).collect()
    assert Counter((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in got) == want
    assert all(r.score < 0 for r in got) and sum(r.score for r in got) > sum(r.base_score for r in got)
    assert bloom_lm.score(none).count() == 0


def test_rare_tokens_are_joined(docs, monkeypatch):
    want = {(r.doc_id, round(r.base_score, 6)) for r in bloom_lm.score(docs).collect()}
    monkeypatch.setattr(bloom_lm, "COMMON_TOKENS", 7)
    assert {(r.doc_id, round(r.base_score, 6)) for r in bloom_lm.score(docs).collect()} == want


def test_bigrams_of_all_tokens(docs, rows, monkeypatch):
    """Scores follow the counts of all bigrams, and a filter that outgrows a broadcast gives the same ones."""
    held = [(i, zlib.crc32(str(i if i is not None else "").encode()) % 5 == 1, [*re.findall(WORD, lower(t)), "\0end"]) for i, t, _ in rows]
    count = Counter(w for _, out, ws in held if not out for w in ws)
    pairs = Counter(p for _, out, ws in held if not out for p in zip([None, *ws], ws))
    count[None] = sum(not out for _, out, _ in held)
    floor, prior = sum(n for w, n in count.items() if w is not None) + 0.5 * len(count), bloom_lm.PRIOR
    want = []
    for i, _, ws in held:
        score = 0.0
        for v, w in zip([None, *ws], ws):
            seen = bloom_lm.MEANS[int(bloom_lm.level_of(np.array([pairs[v, w]]))[0])]
            score += math.log10((seen + prior * (count[w] + 0.5) / floor) / (count[v] + prior))
        want.append((i is not None, i or 0, score))
    monkeypatch.setattr(bloom_lm, "COMMON_TOKENS", 100)
    monkeypatch.setattr(bloom_lm, "COMMON_NGRAMS", 50)
    scores = []
    for bits in (bloom_lm.FILTER_BITS, 1):
        monkeypatch.setattr(bloom_lm, "FILTER_BITS", bits)
        scores.append(sorted((r.doc_id is not None, r.doc_id or 0, r.score) for r in bloom_lm.score(docs).collect()))
    for (*a, x), (*b, y), (*c, z) in zip(*scores, sorted(want), strict=True):
        assert a == b == c and math.isclose(x, y, rel_tol=1e-9) and math.isclose(x, z, rel_tol=0.01)


def test_log_bloom(spark):
    rng = random.Random(4)
    counts = {rng.getrandbits(62): rng.choice([1, 1, 2, 7, 300, 10**6]) for _ in range(3000)}
    bloom = bloom_lm.build_filter(spark.createDataFrame(list(counts.items()), "key long, n long"))
    keys = np.array(list(counts), np.int64)
    exact = bloom_lm.level_of(np.array(list(counts.values())))
    found = bloom.level(keys.view(np.uint64))
    assert (found >= exact).all() and (found == exact).mean() > 0.97
    assert (bloom.level(np.array([rng.getrandbits(62) for _ in range(3000)], np.uint64)) > 0).mean() < 0.03
    small = bloom_lm.build_filter(spark.createDataFrame(list(counts.items()), "key long, n long"), most_bits=1 << 16)
    assert len(small.filled) * 8 <= 1 << 16 and (small.level(keys.view(np.uint64)) >= exact).all()


def test_quality(docs, none, rows):
    want = Counter()
    for i, t, _ in rows:
        t = t or ""
        ws = re.findall(WORD, t)
        lines = [x for x in t.split("\n") if re.search(WORD, x)]
        windows = [tuple(ws[k : k + 5]) for k in range(len(ws) - 4)]
        times = Counter(windows)
        again = {k + j for k, w in enumerate(windows) if times[w] > 1 for j in range(5)}
        failed = len(ws) < 10 or 100 * len(again) > 20 * len(ws)
        low, high = quality_bands.band(len(t.encode()))
        ratio = len(zstandard.ZstdCompressor(level=3).compress(t.encode())) / len(t.encode()) if t else 0.0
        kept = not failed and low <= ratio <= high
        want[i, len(ws), sum(map(len, ws)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(again), failed, kept, ratio] += 1
    got = quality_bands.quality(docs)
    assert Counter(tuple(r)[:9] for r in got.collect()) == want
    assert quality_bands.keep_good(docs).count() == sum(n for w, n in want.items() if w[7])
    assert quality_bands.keep_good(docs).columns == docs.columns and quality_bands.quality(none).count() == 0


def test_mixed_texts_by_chunks():
    rng = random.Random(9)
    kinds = ["the ing wh ea ro st li om und ak", "éz ño qua ió la de ra ci on tu", "ди ро ска ж ли на во сте ом ук"]
    tongues = [["".join(rng.choice(s.split()) for _ in range(rng.randint(1, 4))) for _ in range(1500)] for s in kinds]
    squeeze = zstandard.ZstdCompressor(level=quality_bands.LEVEL)

    def mixed(clean, encoded, words):
        text = prose(rng, clean, words).encode()[:clean]
        return quality_bands.compression(text + base64.b64encode(rng.randbytes(encoded))[:encoded], squeeze)

    for words in tongues:
        for size in (300, 1000, 3000, 5000, 40_000):
            assert mixed(size, 0, words)[1::2] == (0, "pass")
        assert mixed(16_384, 24_576, words)[1:] == (6, 10, "incompressible chunks")
        assert mixed(20_480, 69_632, words)[3] in ("incompressible chunks", "incompressible")
        assert mixed(24_576, 16_384, words)[1:] == (4, 10, "pass")
        assert mixed(4096, 4000, words)[1:] == (1, 2, "pass")
        assert mixed(4096, 7000, words)[1:] == (2, 3, "incompressible chunks")


def plain_feature(text):
    """Hash and tile checksum of a text's image: every target pixel sums its share of every source pixel."""
    payload = text + b" " * (-len(text) % 192 or (0 if text else 192))
    pixels = np.frombuffer(payload, np.uint8).reshape(-1, 64, 3).astype(int)

    def share(source, target):
        return [[max(0, min((i + 1) * source, (j + 1) * target) - max(i * source, j * target)) for j in range(source)] for i in range(target)]

    def sums(height, width):
        return np.einsum("ij,kl,jlc->ikc", np.array(share(len(pixels), height)), np.array(share(64, width)), pixels)

    grey = sums(8, 9).sum(axis=2)
    bits = "".join("01"[int(grey[y, x + 1] > grey[y, x])] for y in range(8) for x in range(8))
    tile = np.array([[[round(Fraction(int(v), len(pixels) * 64)) for v in p] for p in line] for line in sums(16, 16)], np.uint8)
    out = io.BytesIO()
    np.save(out, tile)
    return f"{int(bits, 2):016x}-{zlib.crc32(out.getvalue()):08x}"


def test_media(docs, none, rows):
    want = Counter()
    for i, t, _ in rows:
        payload = raw(t) + b" " * (-len(raw(t)) % 192 or (0 if raw(t) else 192))
        media = b"P6\n64 %d\n255\n" % (len(payload) // 192) + payload
        want[i, len(raw(t)), len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-16:]), len(media), hashlib.sha256(media).hexdigest()] += 1
    assert Counter(tuple(r)[:7] for r in media_columns.text_media(docs).collect()) == want
    assert {(r.doc_id, r.media_sha256): r.feature for r in media_columns.text_media(docs).collect()} == {
        (i, hashlib.sha256(media_columns.store_text(raw(t))).hexdigest()): plain_feature(raw(t)) for i, t, _ in rows
    }
    assert media_columns.text_media(none).count() == 0


def test_images(spark):
    rng = np.random.default_rng(1)
    pixels = rng.integers(0, 256, (5, 7, 3), np.uint8)
    stride = -(-7 * 3 // 4) * 4
    body = b"".join(row[:, ::-1].tobytes().ljust(stride, b"\0") for row in pixels[::-1])
    bmp = b"BM" + struct.pack("<IHHIIiiHHIIiiII", 54 + len(body), 0, 0, 54, 40, 7, 5, 1, 24, 0, len(body), 0, 0, 0, 0) + body
    assert (media_columns.decode(bmp) == pixels).all()
    assert (media_columns.decode(media_columns.encode_ppm(pixels)) == pixels).all()
    assert (media_columns.decode(b"P2 # c\n2 1 15\n0 15") == [[[0], [255]]]).all()
    assert (media_columns.decode(b"P1 2 2 1 0\n0 1") == [[[0], [255]], [[255], [0]]]).all()
    assert (media_columns.decode(b"P4 9 1\n\x80\x80") == [[[0], *[[255]] * 7, [0]]]).all()
    for h, w in ((3, 4), (8, 9), (1, 1)):
        big = np.repeat(np.repeat(pixels.astype(float), h, axis=0), w, axis=1)
        want = big.reshape(h, 5, w, 7, 3).mean(axis=(1, 3))
        assert np.allclose(media_columns.area_resize(pixels, h, w), want)
    frame = spark.createDataFrame([(1, bytearray(bmp)), (2, None), (3, bytearray(b"P6 9 9 255\n"))], "id long, image binary")
    one, two, three = media_columns.media_table(frame).orderBy("id").collect()
    assert (one.width, one.height, one.channels, len(one.dhash)) == (7, 5, 3, 16)
    assert np.load(__import__("io").BytesIO(bytes(one.tile))).shape == (16, 16, 3)
    assert two.width is None and two.error and three.error == "short Netpbm data"


def shingles(text, width):
    ws = re.findall(WORD, lower(text))
    return {tuple(ws[k : k + width]) for k in range(len(ws) - width + 1)} if len(ws) >= width else {tuple(ws)} if ws else set()


def brute_groups(sets, threshold):
    parent = list(range(len(sets)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(sets)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= threshold * len(sets[i] | sets[j]):
                parent[find(i)] = find(j)
    return [find(i) for i in range(len(sets))]


@pytest.mark.parametrize("width,threshold,block", [(4, 85, 512), (5, 80, 4)])
def test_signature_join(spark, docs, none, rows, width, threshold, block, monkeypatch):
    monkeypatch.setattr(signature_join, "BLOCK", block)
    monkeypatch.setattr(signature_join, "CROWD", 2 if block == 4 else 32)
    rng = random.Random(width)
    words = [f"w{k}" for k in range(400)]
    base, own = [rng.choice(words) for _ in range(100)], list(rows)
    for k in range(40):
        copy = list(base)
        for _ in range(rng.randint(0, 5)):
            copy[rng.randrange(100)] = rng.choice(words)
        own.append((200 + k, " ".join(copy), None))
    frame = docs.unionByName(spark.createDataFrame([(i, t, x, "s", 1, "t", "k", 2, 3, 4) for i, t, x in own[len(rows) :]], SCHEMA))
    sets = [shingles(t, width) for _, t, _ in own]
    groups = brute_groups(sets, threshold)
    smallest = {}
    for (i, _, _), g in zip(own, groups, strict=True):
        if i is not None:
            smallest[g] = min(i, smallest.get(g, i))
    same(signature_join.similar_components(frame, width, threshold), [(i, len(s), smallest.get(g, i)) for (i, _, _), s, g in zip(own, sets, groups, strict=True)])
    if block == 4:
        kept = signature_join.one_of_each(frame, width, threshold)
        assert kept.columns == frame.columns
        empties = sum(not s for s in sets)
        assert kept.count() == empties + len({g for g, s in zip(groups, sets, strict=True) if s})
        assert signature_join.similar_components(none).count() == 0 and signature_join.one_of_each(none).count() == 0
