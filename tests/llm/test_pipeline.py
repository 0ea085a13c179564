"""The pipeline, stage by stage, against brute force on the small documents of the operator tests."""

import re
from collections import Counter

import corpus_pipeline
from test_operators import SCHEMA, WORD, brute_groups, docs, rows, shingles  # noqa: F401

from slotwise.llm import quality_bands, suffix_dedup
from slotwise.llm.frames import stored, text_tag


def kept_by_rules(text):
    raw = (text or "").encode()
    words = re.findall(WORD, text or "")
    windows = [tuple(words[k : k + 5]) for k in range(len(words) - 4)]
    times = Counter(windows)
    again = {k + j for k, w in enumerate(windows) if times[w] > 1 for j in range(5)}
    verdict = quality_bands.compression(raw, quality_bands.zstandard.ZstdCompressor(level=quality_bands.LEVEL))[3]
    return len(words) >= 10 and 100 * len(again) <= 20 * len(words) and verdict == "pass"


def without_later_copies(spark, kept):
    """(id, text) of rows, each text cut by what stands earlier, in the order of ids (null first) and of a hash of the text."""
    tags = {r.text: r.tag for r in spark.createDataFrame([(t,) for _, t in kept], "text string").select("text", text_tag().alias("tag")).collect()}
    width, seen, out = suffix_dedup.MIN_BYTES, set(), []
    for i, text in sorted(kept, key=lambda r: (r[0] is not None, r[0] or 0, tags[r[1]])):
        raw = text.encode()
        gone = bytearray(len(raw))
        for k in range(len(raw) - width + 1):
            piece = raw[k : k + width]
            if piece in seen:
                gone[k : k + width] = b"\1" * width
            seen.add(piece)
        out.append((i, bytes(b for b, g in zip(raw, gone, strict=True) if not g).decode("utf-8", "ignore")))
    return out


def test_equal_ids_with_a_common_start(spark):
    """Rows that share an id, or have none, are told apart: the later one loses the whole common passage."""
    common = " ".join(f"w{k}" for k in range(500))[:2000]
    for first, second in ((5, 6), (5, 5), (None, None)):
        rows = [(first, common + " one end of some words"), (second, common + " quite another end")]
        got = suffix_dedup.without_repeats(spark.createDataFrame(rows, "doc_id long, text string"), "first")
        assert Counter((r.doc_id, r.text) for r in got.collect()) == Counter(without_later_copies(spark, rows))
        assert sum(len(t) for _, t in rows) - sum(len(r.text) for r in got.collect()) >= 2000


def test_stages(spark, docs, rows, tmp_path):  # noqa: F811
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "quality rules", "language ID", "n-gram Jaccard join", "suffix-array dedup", "best-fit packing",
    ]
    frame, held = docs, []
    for name, stage in corpus_pipeline.STAGES:
        frame = stored(stage(spark, frame, str(tmp_path)), name.replace(" ", "-"))
        held.append(frame)
    assert all(f.columns == docs.columns for f in held[:-1])
    texts = [Counter((r.doc_id, r.text) for r in f.select("doc_id", "text").collect()) for f in held[:-1]]
    assert texts[0] == Counter((i, t) for i, t, _ in rows if kept_by_rules(t))
    assert texts[1] == texts[0]
    left = list(texts[1].elements())
    groups = brute_groups([shingles(t, corpus_pipeline.SHINGLE_WORDS) for _, t in left], corpus_pipeline.SIMILARITY)
    first = {}
    for (i, t), g in zip(left, groups, strict=True):
        key = (i is not None, i or 0, t)
        first[g] = min(first.get(g, key), key)
    ids = Counter(i for i, _ in texts[2])
    assert ids == Counter(key[1] if key[0] else None for key in first.values())
    assert texts[3] == Counter(without_later_copies(spark, list(texts[2].elements())))
    assert all(r.n_chars == len(r.text) for r in held[3].collect())
    assert {r.doc_id for r in held[4].collect()} == {r.doc_id for r in held[3].collect()}


def test_run_equals_the_stages(spark, rows, tmp_path):  # noqa: F811
    table = [(i, t, x, "s", 1, "t", "k", 2, 3, 4) for i, t, x in rows if i is not None]
    spark.createDataFrame(table, SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    frame = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES:
        frame = stage(spark, frame, str(tmp_path))
    kind = ["doc_id", "piece", "start", "length", "ids_crc32"]
    assert Counter(map(tuple, corpus_pipeline.run(spark, str(tmp_path)).select(kind).collect())) == Counter(map(tuple, frame.select(kind).collect()))


def test_the_language_stage_looks_at_shares(spark, tmp_path):
    """A text in equal parts of three languages goes, one with a quoted sentence stays, one without letters goes."""
    words = {"aa": "mozo lina paro dimo sano", "bb": "xenk tirg wuld krenst vurg", "cc": "qiqu yoyu huhi yaqi uyhu"}
    texts = {lang: f"{w} " * 40 for lang, w in words.items()}
    rows = [(k, texts[lang], lang) for k, lang in enumerate(list(words) * 20)]
    rows += [(900, "".join(texts.values()), None), (901, texts["aa"] * 4 + words["bb"], None), (902, "12 34 56", None)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    kept = {r.doc_id for r in corpus_pipeline.language(spark, frame, str(tmp_path)).collect()}
    assert kept == set(range(60)) | {901}
