"""Corpus operators against brute force, exact round trips and held-out accuracy, on small tables with awkward rows."""

from __future__ import annotations

import gzip
import re
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tickmart.llm import ann, components, divergence, kneser_ney, language, learn, lines, merkle, ngram_join, packing, pieces, quality, rules, skew, textbatch, toxicity, warc

LONG = "lorem ipsum dolor " * 3000
DOCS = "doc_id long, text string, lang string, source string, n_chars long, score double, extra string"


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls, empty, blank and very long texts, repeated rows, and columns whose names clash with results."""
    texts = [None, "", "  \n\t", "one", "two words", LONG, LONG, "Ünïcode ähnlich 你好 🙂", "a b c d e f g h i j k l", "###"]
    rows = [(i, t, None if i % 2 else "en", None if i == 3 else f"s{i % 3}", 0, 1.0, "x") for i, t in enumerate(texts)] + [(4, "two words", "en", "s1", 0, 1.0, "x"), (None, "no id here", "en", "s1", 0, 1.0, "x")]
    return spark.createDataFrame(rows, DOCS)


@pytest.fixture(scope="module")
def prose(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet"), spark.read.parquet("/root/testdata/sf0.001/labels.parquet")


# packing


def test_two_fit_beats_a_gap_and_covers_all():
    bins, offsets = packing.best_two_fit(np.array([6, 3, 2, 2, 5, 5]), 10)
    assert len(set(bins)) == 3
    rng = np.random.default_rng(2)
    lengths = rng.integers(1, 65, 3000)
    bins, offsets = packing.best_two_fit(lengths, 64)
    for b in set(bins):
        own = sorted((offsets[i], lengths[i]) for i in np.flatnonzero(bins == b))
        ends = np.cumsum([n for _, n in own])
        assert ends[-1] <= 64 and [o for o, _ in own] == [0, *ends[:-1]]
    gaps: list[int] = []  # of plain best-fit decreasing
    for n in sorted(lengths.tolist(), reverse=True):
        fits = [g for g in gaps if g >= n]
        if fits:
            gaps.remove(min(fits))
        gaps.append(min(fits, default=64) - n)
    assert len(set(bins)) <= min(len(gaps), 1.005 * lengths.sum() / 64)
    assert len(packing.best_two_fit(np.zeros(0, int), 64)[0]) == 0


def test_pieces_hold_all_ids_and_first_may_be_short(spark, odd):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    specials = packing.special_tokens(public_tokenizers.path("byte_bpe_50k.json"))
    odd = odd.unionByName(spark.createDataFrame([(11, "a <|endoftext|> b", "en", "s", 0, 1.0, "x"), (12, "<|endoftext|><|endoftext|>  <|endoftext", "en", "s", 0, 1.0, "x")], DOCS))
    got = packing.pack_documents(odd, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN, specials, with_ids=True).collect()
    texts = {r["doc_id"]: r["text"] for r in odd.collect()}
    for doc_id, text in texts.items():
        own = sorted((r for r in got if r["doc_id"] == doc_id), key=lambda r: r["piece"])
        if doc_id == 4:
            own = own[:1]
        ids = [*t.encode(text or "", add_special_tokens=False).ids, 2]
        assert [i for r in own for i in r["ids"]] == ids
        assert [r["start"] for r in own] == [0, *np.cumsum([r["length"] for r in own])[:-1]] and all(r["length"] == 1024 for r in own[1:])
        assert all(r["ids_crc32"] == zlib.crc32(np.array(r["ids"], "<u4").tobytes()) for r in own)
    assert packing.pack_documents(odd.where("false"), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN).count() == 0


def test_rows_of_one_id_are_packed_by_many_tasks(spark):
    many = spark.range(4000).select(F.when(F.col("id") % 3 > 0, F.col("id")).alias("doc_id"), F.lit(0).alias("piece"), (1 + F.col("id") % 7).alias("length"))
    got = packing.pack(many, 32, pieces_per_task=500).select("doc_id", "length", F.shiftright("sequence_id", 33).alias("task"), "sequence_id", "offset").collect()
    sizes = np.bincount([r["task"] for r in got])
    assert len(sizes) == 8 and sizes.max() <= 520 and len({(r["sequence_id"], r["offset"]) for r in got}) == 4000


def test_split_white_space_gives_the_published_ids():
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    own = packing.ByteBPE(public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN, packing.special_tokens(public_tokenizers.path("byte_bpe_50k.json")))
    rng = np.random.default_rng(0)
    parts = ["<|endoftext|>", "<|end", " ", "  ", "\n", "\t", " ", "　", "\x1c", "don't", "Straße", "12", "!?", "你", " "]
    for _ in range(500):
        text = "".join(rng.choice(parts, rng.integers(0, 12)))
        assert own.encode(text) == t.encode(text, add_special_tokens=False).ids, repr(text)


# quality rules


def brute(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    grams = [tuple(w[i : i + 5]) for i in range(len(w) - 4)]
    covered = {p for i, g in enumerate(grams) if grams.count(g) > 1 for p in range(i, i + 5)}
    ls = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")), len(ls) - len(set(ls)), len(covered)


def test_statistics_equal_brute_force(spark):
    texts = [None, "", "a b c d e a b c d e a b c d e", "x\nx\n \nx y\nx y", "p q r s t u v p q r s t w p q r s t", "# * 你好 | <tag>", "one two three four"]
    got = rules.with_statistics(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).orderBy("doc_id").collect()
    assert [tuple(r[c] for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")) for r in got] == [brute(t) for t in texts]


def test_cascade_keeps_prose_and_is_ordered_by_measure(odd, prose):
    judged = rules.judge(prose[0].join(prose[1], "doc_id")).where("not base_failed")
    assert judged.where("quality = 1 and not kept").count() == 0 and judged.where("quality = 0 and not kept").count() > 0
    assert rules.judge(odd).count() == odd.count() and rules.judge(odd.where("false")).count() == 0
    clashing = odd.withColumns({c: F.lit("own") for c in ("n_words", "kept", "rejected_by", "base_failed", "_words", "_again")})
    got = rules.judge(clashing)
    assert dict(got.dtypes)["kept"] == "boolean" and dict(got.dtypes)["n_words"] == "bigint" and got.where("_again = 'own'").count() == odd.count()


def test_cascade_order_follows_known_costs_and_rates(prose):
    text = F.coalesce(F.col("text"), F.lit(""))
    scans = lambda n: sum((F.regexp_count(text, F.lit(rf"[aeiou]{{1,{k + 1}}}[^aeiou]")) for k in range(n)), F.lit(0))
    half, tenth = F.crc32(text) % 2 == 0, F.crc32(text) % 10 == 0
    known = [
        rules.Rule("dear", (scans(8) >= 0) & half), rules.Rule("cheap, seldom", tenth & (F.col("n_words") >= 0)),
        rules.Rule("middling", (scans(1) >= 0) & half), rules.Rule("cheap", half), rules.Rule("never", F.col("n_words") < 0),
    ]
    for _ in range(3):
        got = rules.measure(prose[0], known, 150)
        assert [m.rule.name for m in got] == ["cheap", "cheap, seldom", "middling", "dear", "never"] or [m.rule.name for m in got] == ["cheap", "middling", "cheap, seldom", "dear", "never"]
        by = {m.rule.name: m for m in got}
        assert 3 < by["dear"].seconds / by["middling"].seconds and by["dear"].rejected == by["cheap"].rejected > by["cheap, seldom"].rejected
    assert [m.rule.name for m in rules.measure(prose[0].where("false"), known)] == [r.name for r in known]


# archives


def test_archives_round_trip_with_revisits(spark):
    big = "x" * 2000
    pages = spark.createDataFrame([(1, "http://a", big, 1), (2, None, big, 1), (3, "http://c\r\n", "small", 1), (4, "u", "small", 1), (5, "u", None, 1), (6, "u", "", 1), (None, "u", big, 1)], "page_id long, url string, html string, payload int")
    got = {r["page_id"]: r.asDict() for r in warc.round_trip(pages).collect()}
    assert {i: (r["record_type"], r["refers_to"], r["payload_bytes"]) for i, r in got.items()} == {1: ("revisit", 2, 2000), 2: ("response", None, 2000), 3: ("response", None, 5), 4: ("response", None, 5), 5: ("response", None, 0), 6: ("response", None, 0), None: ("revisit", 2, 2000)}
    assert warc.round_trip(pages.where("false")).count() == 0


def test_salvage_reads_on_after_damage():
    import hashlib

    record = lambda i, p: warc.record_bytes(i, "u", p, hashlib.sha1(p).hexdigest(), "response", None)
    members = [gzip.compress(record(i, bytes([65 + i]) * 500)) for i in range(5)]
    broken = bytearray(members[1])
    broken[len(broken) // 2] ^= 0xFF
    data = members[0] + b"\0" + bytes(broken) + b"\0" + b"junk" + members[2] + b"\0" + members[3][:40] + record(9, b"plain WARC/1. text") + members[4]
    found = list(warc.salvage(data))
    ids = [w["record_id"] for kind, _, _, w in found if kind == "record"]
    assert ids == [f"<urn:page:{i}>" for i in (0, 2, 9, 4)]
    gaps = [(s, e) for kind, s, e, _ in found if kind == "gap"]
    assert len(gaps) == 2 and gaps[0][0] == len(members[0]) + 1 and data[gaps[0][1] :].startswith(members[2])
    wrong = record(1, b"abc").replace(b"abc", b"abd")
    assert [k for k, *_ in warc.salvage(wrong + record(2, b"ok"))] == ["gap", "record"]
    assert list(warc.salvage(b"")) == [] and [k for k, *_ in warc.salvage(b"nothing here")] == ["gap"]


def test_salvage_inside_members_and_of_any_archive(spark, tmp_path):
    import hashlib

    rng = np.random.default_rng(8)
    record = lambda i, p: warc.record_bytes(i, "u", p, hashlib.sha1(p).hexdigest(), "response", None)
    named = lambda found: [w["record_id"] for kind, _, _, w in found if kind == "record"]
    urns = lambda *ids: [f"<urn:page:{i}>" for i in ids]
    blocks = [record(i, rng.bytes(20_000)) for i in range(4)]
    inner = bytearray(b"".join(blocks))
    inner[len(blocks[0]) + 5_000] ^= 0xFF
    packed = gzip.compress(bytes(inner))
    found = list(warc.salvage(packed + gzip.compress(record(9, b"next"))))
    assert named(found) == urns(0, 2, 3, 9) and [(s, e) for k, s, e, _ in found if k == "gap"] == [(0, len(packed))]
    assert f"from inflated byte {len(blocks[0])} to {2 * len(blocks[0])}: digest" in next(w for k, *_, w in found if k == "gap")
    good = gzip.compress(b"".join(blocks))
    crc = bytearray(good)
    crc[-6] ^= 0xFF
    for damaged, ids in ((bytes(crc), (0, 1, 2, 3)), (good[: len(good) * 3 // 5], (0, 1))):
        found = list(warc.salvage(damaged + gzip.compress(record(9, b"next"))))
        assert named(found) == urns(*ids, 9) and [(s, e) for k, s, e, _ in found if k == "gap"] == [(0, len(damaged))]
    (tmp_path / "deep" / "er").mkdir(parents=True)
    for name, i in (("a.warc.gz", 0), ("deep/b.warc", 1), ("deep/er/part-0", 2), ("_skipped", 3), (".hidden", 3)):
        (tmp_path / name).write_bytes(blocks[i] if name.endswith("warc") else gzip.compress(blocks[i]))
    records, gaps = warc.read(spark, str(tmp_path))
    assert sorted(r["record_id"] for r in records.collect()) == urns(0, 1, 2) and gaps.count() == 0


def test_archives_are_bounded_by_bytes_and_damage_is_read_around(spark, tmp_path):
    rng = np.random.default_rng(11)
    text = lambda n: rng.bytes(n).hex()
    rows = [(i, "u", text(300 if i % 10 else 20_000), "x") for i in range(200)]
    rows += [(7, "u", rows[7][2], "x"), (None, "u", "no id", "x"), (None, "v", rows[7][2], "x")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, digest string").coalesce(1)
    path = tmp_path / "archives"
    warc.write(pages, str(path), archive_rows=8, row_bytes=8192)
    files = sorted(path.glob("part-*"))
    longest = 25_000  # of one compressed member
    assert len(files) > 5 and all(f.stat().st_size <= 8 * 8192 + longest for f in files)
    records, gaps = warc.read(spark, str(path))
    assert records.count() == len(rows) and gaps.count() == 0
    data = bytearray(files[0].read_bytes())
    data[len(data) // 2] ^= 0xFF
    (path / f".{files[0].name}.crc").unlink(missing_ok=True)
    files[0].write_bytes(bytes(data))
    (gap,) = gaps.collect()
    left = records.collect()
    assert len(left) == len(rows) - 1 and gap["path"].endswith(files[0].name) and gap["start"] <= len(data) // 2 < gap["end"]
    lost = {r["record_id"] for r in left} ^ {warc._named(i) for i, *_ in rows}
    assert len(lost) == 1 or lost <= {warc._named(7), warc._named(None)}
    with pytest.raises(Exception, match="damaged member|digest|length"):
        warc.read(spark, str(path), gaps_fail=True)[0].collect()


def test_many_false_starts_take_linear_time():
    import time

    began = time.monotonic()
    found = [*warc.salvage(b"WARC/1. junk " * 60_000)]
    assert [k for k, *_ in found] == ["gap"] and time.monotonic() - began < 60


def test_small_and_shared_payloads_spread_over_tasks(spark):
    pages = spark.range(6000).select(F.col("id").alias("page_id"), F.concat(F.lit("u"), "id").alias("url"), F.when(F.col("id") % 3 == 0, F.lit("")).when(F.col("id") % 3 == 1, F.lit("x" * 1500)).otherwise(F.repeat(F.col("id").cast("string"), 300)).cast("binary").alias("payload"))
    before = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    try:
        for k, v in zip(before, ("-1", "false"), strict=True):
            spark.conf.set(k, v)
        got = warc.with_revisits(pages)
        sizes = [r["count"] for r in got.groupBy(F.spark_partition_id()).count().collect()]
        assert len(sizes) == 4 and max(sizes) < 1.2 * 6000 / 4
        assert got.where("refers_to is not null").agg(F.count("*"), F.min("refers_to"), F.max("refers_to")).first()[:] == (1999, 5998, 5998)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


# language, quality, toxicity


def test_language_of_held_out_and_mixed_texts(spark, prose, odd):
    docs = prose[0]
    got = language.classify(docs).join(docs.select("doc_id", "lang"), "doc_id").where("held_out")
    assert got.where("lang = lang_pred").count() / got.count() > 0.95
    model = language.fit(docs)
    two = [r["text"] for lang in ("en", "de") for r in docs.where(f"lang = '{lang}' and n_chars > 1500").limit(1).collect()]
    (row,) = language.identify(spark.createDataFrame([(" ".join(t[:1500] for t in two),)], "text string"), model).collect()
    assert row["shares"]["en"] > 0.25 and row["shares"]["de"] > 0.25
    out = {r["doc_id"]: r for r in language.identify(odd, model).collect()}
    assert all(out[i]["lang_pred"] == "und" and out[i]["score"] == 0 for i in (0, 1, 2, 9)) and out[7]["lang_pred"] != "und"
    empty = language.fit(docs.where("false"))
    assert {r["lang_pred"] for r in language.identify(odd, empty).collect()} == {"und"}


def brute_mixture(model, text, penalty=3.0, steps=12):
    """The mixture of one text, word by word in plain Python."""
    data = (text or "").encode()
    code = lambda b: b - 96 if 97 <= b <= 122 else b - 64 if 65 <= b <= 90 else b - 101 if b >= 128 else 0
    words, word = [], []
    for i, b in enumerate(data):
        if code(b):
            x, y = (code(data[j]) if 0 <= j < len(data) else 0 for j in (i - 1, i + 1))
            slot = (((x * 155 + code(b)) * 155 + y) * 0x9E3779B97F4A7C15 % 2**64) >> 48
            word.append(model.log_share[slot].astype(float))
        if word and (not code(b) or i + 1 == len(data)):
            words.append(np.sum(word, axis=0))
            word = []
    k = len(model.languages)
    if not words or not any(map(str.isalpha, text)):
        return np.zeros(k)
    alone = np.sum(words, axis=0)
    share, most = np.eye(k)[alone.argmax()], alone.max()
    gain, allowed = penalty * np.log(len(words) + 1), list(range(k))
    if sum(w.max() for w in words) - most <= gain:
        return share
    while len(allowed) > 1:
        now = np.full(len(allowed), 1 / len(allowed))
        p = [np.exp(w[allowed] - w[allowed].max()) for w in words]
        for _ in range(steps):
            now = np.mean([x * now / (x * now).sum() for x in p], axis=0)
        value = sum(np.log((x * now).sum()) + w[allowed].max() for x, w in zip(p, words, strict=True)) - gain * (len(allowed) - 1)
        if value > most:
            most, share = value, np.zeros(k)
            share[allowed] = now
        least = now.argmin()
        allowed = [a for i, a in enumerate(allowed) if i != least and (now[i] > 0.01 or now[i] == now.max())]
    return share


def test_mixtures_equal_a_loop_over_words(prose, odd, monkeypatch):
    model = language.fit(prose[0])
    texts = [r["text"] for r in prose[0].where("text is not null and n_chars < 3000").orderBy("doc_id").limit(25).collect()]
    texts += [a[:600] + " " + b[:600] for a, b in zip(texts[::2], texts[1::2], strict=False)] + [r["text"] for r in odd.collect() if r["text"] is None or len(r["text"]) < 5000]
    want = np.array([brute_mixture(model, t) for t in texts])
    got, sure = model.mixtures(pa.array(texts))
    assert np.abs(got - want).max() < 2e-3 and ((sure > 0) == (want.sum(1) > 0)).all()
    monkeypatch.setattr(language, "STEP", 50)  # texts in steps: as distinct words with counts
    for text, share in zip(texts, want, strict=True):
        (own,), _ = model.mixtures(pa.array([text]))
        assert np.abs(own - share).max() < 2e-3


def test_counts_do_not_depend_on_steps(prose, monkeypatch):
    model = language.fit(prose[0].where("doc_id < 60").repartition(60))
    import tickmart.llm.language as module

    texts = prose[0].where("doc_id < 60 and text is not null and lang is not null and crc32(string(doc_id)) % 4 <> 2").select("text", "lang").collect()
    counts = np.zeros((module.SLOTS, len(model.languages)))
    for r in texts:
        slot, _, (_, _, code) = module._trigrams(next(iter(textbatch.chunks(pa.array([r["text"]])))))
        steps = [*module._steps(np.frombuffer(r["text"].encode(), np.uint8))]
        assert np.array_equal(np.concatenate([s[0] for s in steps]), slot)
        counts[:, model.languages.index(r["lang"])] += np.bincount(slot[code > 0], minlength=module.SLOTS)
    pooled = (counts.sum(1, keepdims=True) + 0.1) / (counts.sum() + 0.1 * module.SLOTS)
    assert np.allclose(model.log_share, np.log((counts + 500 * pooled) / (counts.sum(0, keepdims=True) + 500)), atol=1e-5)


def test_trees_equal_a_walk_row_by_row(prose):
    forest = quality.fit(*prose)
    texts = [r["text"] for r in prose[0].orderBy("doc_id").limit(80).collect()]
    x = quality.statistics(pa.array(texts))
    for row, score in zip(x, forest.score(x), strict=True):
        total = forest.base
        for feature, threshold, leaf in zip(forest.feature, forest.threshold, forest.leaf, strict=True):
            node = 0
            while node < len(feature):
                node = 2 * node + (2 if row[feature[node]] > threshold[node] else 1)
            total += leaf[node - len(feature)]
        assert score == pytest.approx(1 / (1 + np.exp(-total)))
    for text, row in zip(texts, x, strict=True):  # and statistics equal plain counting
        words = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode())
        rows = [r for r in (text or "").encode().split(b"\n") if r]
        windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
        n = max(1, len(words))
        want = {"log_words": np.log1p(len(words)), "word_bytes": sum(map(len, words)) / n, "repeated_words": (len(words) - len(set(words))) / n, "repeated_windows": (len(windows) - len(set(windows))) / max(1, len(windows)),
                "repeated_lines": (len(rows) - len(set(rows))) / max(1, len(rows)), "words_with_symbol": sum(bool(re.search(rb"[#*$%&|<>]", w)) for w in words) / n, "commonest_word": max((words.count(w) for w in set(words)), default=0) / n}
        assert all(row[quality.STATISTICS.index(k)] == pytest.approx(v) for k, v in want.items())


def test_texts_of_50_megabytes_take_bounded_memory(prose, tmp_path):
    import subprocess
    import sys

    code = """
import resource, sys
import numpy as np, pyarrow as pa
from tickmart.llm import language, ngram_join, quality, textbatch as tb
rng = np.random.default_rng(0)
words = np.array(["w%d" % i for i in range(20000)] + ["Größe", "l'été", "#x", "."])
text = " ".join(rng.choice(words, 9_000_000))
assert len(text) > 50 << 20
column = pa.array([text, None, "short text"])
before = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
model = language.Model(["a", "b", "c", "d"], np.log(rng.dirichlet(np.ones(language.SLOTS), 4).T).astype(np.float32))
if sys.argv[1] == "language":
    share, sure = model.mixtures(column)
    assert share.shape == (3, 4) and share[1].sum() == 0
elif sys.argv[1] == "quality":
    assert quality.statistics(column).shape == (3, 17)
else:
    sizes = [len(s) for t in tb.chunks(column) for s in ngram_join.shingle_sets(t, 3)]
    assert sizes[1:] == [0, 1] and sizes[0] > 8_000_000
print((resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before) >> 10)
"""
    for what, most in (("language", 600), ("quality", 1400), ("shingles", 900)):
        out = subprocess.run([sys.executable, "-c", code, what], capture_output=True, text=True, timeout=240)
        assert out.returncode == 0, out.stderr[-2000:]
        assert int(out.stdout) < most, (what, out.stdout)


def test_long_spans_hash_alike(monkeypatch):
    rng = np.random.default_rng(1)
    data = np.frombuffer(b" ".join(rng.bytes(int(n)).replace(b" ", b"x") for n in rng.integers(1, 200, 300)), np.uint8)
    starts, ends, _ = textbatch.spans(data != 32, np.array([0, len(data)]))
    want = textbatch.span_hashes(data, starts, ends)
    monkeypatch.setattr(textbatch, "SEGMENT", 64)
    assert np.array_equal(textbatch.span_hashes(data, starts, ends), want)


def test_quality_separates_held_out_rows(prose, odd):
    docs, labels = prose
    got = quality.classify(docs, labels).join(labels, "doc_id").where("held_out").collect()
    assert np.mean([r["predicted"] == r["quality"] for r in got]) > 0.9
    forest = quality.fit(docs, labels)
    assert quality.score(odd, forest).count() == odd.count() and "extra" in quality.score(odd, forest).columns
    assert quality.fit(docs, labels.where("false")).score(np.zeros((2, len(quality.STATISTICS)))).tolist() == [0.5, 0.5]


def test_a_repeated_document_is_learned_from_once(spark, prose):
    docs, labels = prose
    often = docs.unionByName(docs.where("doc_id % 7 = 1").crossJoin(spark.range(20)).drop("id"))
    a, b = quality.fit(docs, labels), quality.fit(often, labels)
    assert np.array_equal(a.feature, b.feature) and np.array_equal(a.leaf, b.leaf)
    ids = learn.sampled_ids(labels, "toxic", 5, 0, 30)
    assert ids.count() <= 60 and learn.labelled_texts(often, ids).count() == ids.count()


def test_toxicity_learns_planted_words(spark, odd):
    rng = np.random.default_rng(5)
    words = ["".join(rng.choice(list("abdefgilmnorstu"), rng.integers(2, 9))) for _ in range(800)]
    make = lambda bad: " ".join("blockhead" if bad and rng.random() < 0.06 else rng.choice(words) for _ in range(150))
    texts = [(i, make(i % 4 == 0), int(i % 4 == 0)) for i in range(400)]
    docs = spark.createDataFrame(texts, "doc_id long, text string, toxic int")
    got = toxicity.classify(docs, docs.select("doc_id", "toxic")).join(docs.select("doc_id", "toxic"), "doc_id").where("held_out").collect()
    assert np.mean([r["predicted"] == r["toxic"] for r in got]) > 0.95
    model = toxicity.fit(docs, docs)
    scored = toxicity.score(odd, model).collect()
    assert len(scored) == odd.count() and all(0 <= r["score"] <= 1 for r in scored)
    assert toxicity.fit(docs, docs.where("toxic = 0")).score(["a", None]) == pytest.approx([1e-4, 1e-4])


def test_toxic_dictionary_is_trained_and_rare_wording_is_known(spark):
    rng = np.random.default_rng(6)
    words = ["".join(rng.choice(list("abdefgilmnorstu"), rng.integers(2, 9))) for _ in range(300)]
    rare = ["quizzvex", "wockhyyp"]  # each in 3 % of the toxic texts; the rest say blockhead
    said = lambda i: rare[i % 2] if i % 100 < 6 else "blockhead"
    text = lambda bad: " ".join([*rng.choice(words, 30), *bad, *rng.choice(words, 30)])
    texts = [text([said(i)] * 3) for i in range(2000)] + [text([]) for _ in range(2000)]
    docs = spark.createDataFrame([(i, t, int(i < 2000)) for i, t in enumerate(texts)], "doc_id long, text string, toxic int")
    model = toxicity.fit(docs, docs)
    assert len(model.ordinary) > 1000 and b"blockhead" not in model.ordinary and all(w[:6].encode() in model.toxic[0] for w in ["blockhead", *rare])
    assert all(x.startswith(b"\x37\xa4\x30\xec") for x in (model.ordinary, *model.toxic))  # as train_dictionary gives them
    assert (model.score([text([w] * 3) for w in rare]) > 0.5).all() and (model.score([text([]) for _ in range(20)]) < 0.5).all()


def test_toxicity_is_window_by_window_compression(spark, prose, odd):
    import zstandard

    model = toxicity.fit(*prose)
    texts = [r["text"] for r in prose[0].orderBy("doc_id").limit(60).collect()] + [r["text"] for r in odd.collect()]
    how = zstandard.ZstdCompressionParameters(compression_level=1, window_log=16, hash_log=14, chain_log=14, search_log=4, min_match=5, strategy=zstandard.STRATEGY_GREEDY, write_content_size=0, write_dict_id=0, write_checksum=0)
    size = lambda w, content: len(zstandard.ZstdCompressor(dict_data=zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT), compression_params=how).compress(w))
    for text, got, score in zip(texts, model.distances(texts), model.score(texts), strict=True):
        words = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").lower().encode())
        saved = sorted(size(w, model.ordinary) - size(w, model.toxic[0] + model.ordinary) for w in (b" " + b" ".join(words[i : i + 8]) + b" " for i in range(0, len(words), 8)))
        high = sum(s >= 3 for s in saved)
        want = [saved[-1], np.mean(saved[-2:]), np.mean(saved), high / len(saved), np.log1p(high)] if saved else [0.0] * 5
        assert np.allclose(got, want)
        logit = model.weights[0] + sum(w * (v - m) / s for w, v, m, s in zip(model.weights[1:], want, model.mean, model.scale, strict=True))
        assert score == pytest.approx(1 / (1 + np.exp(-logit)))


def test_toxicity_learns_from_whole_texts(spark):
    rng = np.random.default_rng(7)
    words = ["".join(rng.choice(list("abdefgilmnorstu"), rng.integers(2, 9))) for _ in range(300)]
    text = lambda bad, n: " ".join([*rng.choice(words, n), *bad, *rng.choice(words, 20)])
    rows = [(i, text(["blockhead"] * 4 if i % 2 else [], 4500), i % 2) for i in range(120)]
    assert all(t.find("blockhead") > 20_000 for _, t, bad in rows if bad)
    docs = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    model = toxicity.fit(docs, docs)
    assert b"blockhea" in model.toxic[0]
    assert model.score([text(["blockhead"] * 4, 4500)])[0] > 0.5 > model.score([text([], 4500)])[0]


@pytest.mark.parametrize("n", range(1, 8))
def test_a_few_words_alone_in_a_chunk(n):
    alone = pa.array([" ".join("abcdefg"[:n])])
    beside = pa.concat_arrays([alone, pa.array(["some more words that stand beside it"])])
    assert np.array_equal(quality.statistics(alone)[0], quality.statistics(beside)[0])
    for gram in (3, 5):
        (own,), both = (ngram_join.shingle_sets(next(iter(textbatch.chunks(x))), gram) for x in (alone, beside))
        assert np.array_equal(own, both[0]) and len(own) == max(1, n - gram + 1)


# lines


def test_boilerplate_goes_but_for_its_first_place(spark, odd):
    foot = "All rights reserved by us."
    rows = [(i, f"own line number {i} of many\n{foot} ", f"site{i % 12}") for i in range(30)] + [(99, None, "s"), (98, "", None), (97, foot, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = {r["doc_id"]: r for r in lines.deduplicate(docs, min_sites=10).collect()}
    assert got[0]["text"].endswith(f"{foot} ") and got[0]["n_removed"] == 0
    assert all(got[i]["text"] == f"own line number {i} of many" and got[i]["n_removed"] == 1 for i in range(1, 30))
    assert got[99]["text"] is None and got[98]["text"] == "" and got[97]["text"] == ""
    assert lines.deduplicate(docs, min_sites=14).where("n_removed > 0").count() == 0  # 13 sites in all
    assert lines.deduplicate(docs, min_sites=13).where("n_removed > 0").count() == 30
    assert lines.deduplicate(odd).count() == odd.count() and lines.deduplicate(odd.where("false")).count() == 0


# near duplicates


def linked(docs, gram, percent):
    low = str.maketrans({chr(i): chr(i + 32) for i in range(65, 91)})
    sets = {}
    for d, t in docs:
        w = re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(low))
        sets[d] = {tuple(w[i : i + gram]) for i in range(len(w) - gram + 1)} if len(w) >= gram else ({tuple(w)} if w else set())
    root = {d: d for d in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {d: (len(s), find(d)) for d, s in sets.items()}


@pytest.mark.parametrize(("gram", "percent", "hot"), [(3, 90, False), (5, 80, False), (3, 90, True), (5, 80, True)])
def test_components_equal_brute_force(spark, monkeypatch, gram, percent, hot):
    if hot:  # nearly every key is hot, and members of nearly all groups are compared in blocks
        monkeypatch.setattr(skew, "MOST_ROWS", 3)
        monkeypatch.setattr(skew, "MOST_THIN_ROWS", 3)
        monkeypatch.setattr(ngram_join, "FEW_MEMBERS", 1)
        monkeypatch.setattr(ngram_join, "FEW_PAIRS", 0)
    rng = np.random.default_rng(gram)
    vocabulary = [f"W{i}" for i in range(300)]
    rows: list[tuple[int, str | None]] = [(0, None), (1, ""), (2, "A b"), (3, "a B"), (4, "c"), (5, " \n")]
    common = list(rng.choice(vocabulary, 60))
    for g in range(12):
        base = list(rng.choice(vocabulary, rng.integers(4, 160)))
        for _ in range(rng.integers(1, 12)):
            own = base + common * (g % 3 == 0)
            for _ in range(rng.integers(0, 6)):
                own[rng.integers(len(own))] = rng.choice(vocabulary)
            rows.append((len(rows), " ".join(own)))
    base = list(rng.choice(vocabulary, 200))
    for _ in range(60):  # more than FEW near copies of one text
        own = base.copy()
        own[rng.integers(200)] = "changed"
        rows.append((len(rows), " ".join(own)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in ngram_join.cluster(docs, gram, percent).collect()}
    assert got == linked(rows, gram, percent)


def test_members_of_one_group_that_do_not_link_to_its_first(spark):
    # equal size and equal prefix (rare words first), but different otherwise: groups whose members have several labels
    rng = np.random.default_rng(12)
    common, rare = [f"w{i}" for i in range(40)], [f"rare{i}" for i in range(14)]
    rows: list[tuple[int, str]] = []
    for kind in range(3):
        body = list(rng.choice(common, 60))
        for _ in range(5):
            own = body.copy()
            own[rng.integers(60)] = common[rng.integers(40)]
            rows.append((len(rows), " ".join(rare + own)))
    rows += [(1000 + i, " ".join(rng.choice(common, 40))) for i in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in ngram_join.cluster(docs, 3, 70).collect()}
    assert got == linked(rows, 3, 70)


def test_hot_keys_are_dealt_over_tasks(spark, monkeypatch):
    monkeypatch.setattr(skew, "MOST_ROWS", 50)
    monkeypatch.setattr(skew, "MOST_THIN_ROWS", 50)
    rows = spark.range(6000).select(F.when(F.col("id") % 3 > 0, F.lit(-1)).otherwise(F.col("id")).alias("a"), F.col("id").alias("b")).repartition(4)
    hot = skew.hot_keys(rows, ["a"], 6000)
    assert hot.collect()[0][:] == (-1, 80) and hot.count() == 1
    left, right = skew.dealt(rows, hot, ["a"], "b"), skew.copied(rows.select("a").distinct(), hot, ["a"])
    joined = left.hint("merge").join(right, ["a", "part"])
    before = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        sizes = [r["count"] for r in joined.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", before)
    assert sum(sizes) == 6000 and max(sizes) < 1.3 * 6000 / 4
    star = spark.range(1, 3000).select(F.lit(0).cast("long").alias("a"), F.col("id").alias("b"))
    chain = spark.range(5000, 5040).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"))
    got = components.components(star.unionByName(chain)).groupBy("component").count().collect()
    assert {r["component"]: r["count"] for r in got} == {0: 3000, 5000: 41}


def test_rows_without_id_or_table(odd, spark):
    got = ngram_join.cluster(odd).collect()
    assert len(got) == odd.count() and {r["component_id"] for r in got if r["doc_id"] in (5, 6)} == {5}
    assert all(r["component_id"] is None for r in got if r["doc_id"] is None) and all(r["component_id"] == r["doc_id"] for r in got if r["doc_id"] in (0, 1, 2))
    assert ngram_join.cluster(odd.where("false")).count() == 0


# nearest neighbours


def test_nearest_equal_brute_force(spark):
    rng = np.random.default_rng(0)
    x = rng.normal(size=(600, 16)).astype(np.float32)
    x[50:80] = x[0]
    rows = [(i, v.tolist(), "l") for i, v in enumerate(x)] + [(600, None, "l"), (601, [0.0] * 16, "l"), (602, [float("nan")] + [1.0] * 15, "l"), (603, [None] + [1.0] * 15, "l"), (700, [1.0, 2.0], "l"), (701, [1.0, 2.5], "l")]
    v = spark.createDataFrame(rows, "vec_id long, embedding array<float>, score string")
    found: dict[int, list] = {}
    for r in ann.nearest(v, v.where("vec_id % 100 = 0"), block_vectors=128, query_block=3).orderBy("query_id", "rank").collect():
        found.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
    assert found.pop(700) == [(701, 0.5)]
    y = x.astype(np.float64)
    for q in range(0, 600, 100):
        d = np.sqrt(((y - y[q]) ** 2).sum(1))
        d[q] = np.inf
        best = np.lexsort((np.arange(600), d))[:10]
        assert [i for i, _ in found[q]] == best.tolist() and np.allclose([s for _, s in found[q]], d[best])
    assert set(found) == set(range(0, 600, 100)) and ann.nearest(v.where("false"), v.where("false")).count() == 0


def test_nearest_of_repeated_ids_many_copies_and_long_vectors(spark):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(400, 8))
    x[100:250] = x[7]  # many copies of one vector
    x[300:310] *= 1e200  # too long to square
    x[310:320] *= 1e-200
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    again = [(0, [9.0] * 8), (0, [9.0] * 8), (100, [99.0] * 8), (5, x[5].tolist()), (None, [1.0] * 8)]
    v = spark.createDataFrame(rows + again, "vec_id long, embedding array<double>")
    for i, u in again:
        if i is not None:
            x[i] = min(x[i].tolist(), u)
    found: dict[int, list] = {}
    for r in ann.nearest(v, v.where("vec_id % 100 = 0 or vec_id > 295"), k=7, block_vectors=64, query_block=16).orderBy("query_id", "rank").collect():
        found.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    assert set(found) == {0, 100, 200, *range(296, 400)}
    for q, got in found.items():
        apart = x - x[q]
        top = np.maximum(np.abs(apart).max(1), 1e-300)
        d = top * np.sqrt(((apart / top[:, None]) ** 2).sum(1))
        d[q] = np.inf
        best = np.lexsort((np.arange(400), d))[:7]
        assert [k for k, *_ in got] == [*range(1, 8)] and np.allclose([s for *_, s in got], d[best], rtol=1e-12)
        assert [i for _, i, _ in got] == best.tolist() or np.allclose(d[[i for _, i, _ in got]], d[best], rtol=1e-14)


def test_tiles_never_lose_a_neighbour_to_rounding():
    rng = np.random.default_rng(9)
    for scale in (1.0, 1e-3, 1e6):
        x, q = rng.normal(size=(500, 24)) * scale, rng.normal(size=(40, 24)) * scale
        x[:200] += 100 * scale  # far from zero, so that rounding is large against the distances
        q[:20] += 100 * scale
        a, b = (ann.Block(24, np.arange(len(m)) + first, *ann.quantised(m)) for m, first in ((q, 1000), (x, 0)))
        limits, pairs = np.full((40, 5), np.inf), set()
        for i, j, low, high in ann.tile(a, b, limits):
            true = np.sqrt(((q[i] - x[j]) ** 2).sum(1))
            assert (low <= true).all() and (true <= high).all()
            pairs |= {*zip(i.tolist(), j.tolist(), strict=True)}
        d = np.sqrt(((q[:, None] - x) ** 2).sum(2))
        assert all((i, j) in pairs for i in range(40) for j in np.argsort(d[i])[:5])


# pieces


def test_stream_gives_the_librarys_ids():
    import sentencepiece

    path = public_tokenizers.path("piece_bpe_32k.model")
    own, library = pieces.Codec(path), sentencepiece.SentencePieceProcessor(model_file=path)
    rng = np.random.default_rng(1)
    parts = ["  ", " the", "\n", "你", "é", "international", "00", " ", "🙂", "tion", "!!", "ab", "   x", "\u0000"]
    for _ in range(400):
        text = "".join(rng.choice(parts, rng.integers(0, 25)))
        assert own.encode(text) == library.encode(text), repr(text)
        assert own.decode(own.encode(text)) == text
    long = "".join(rng.choice(list("abcdefghij"), 5000))
    assert own.encode(long) == library.encode(long)
    assert own.encode("a" * 3000) == library.encode("a" * 3000)


def test_stream_commits_where_paths_converge_in_a_window_of_the_longest_piece(prose):
    import sentencepiece

    path = public_tokenizers.path("piece_bpe_32k.model")
    p, library = pieces.Pieces(path), sentencepiece.SentencePieceProcessor(model_file=path)
    lattice = pieces.Lattice(p)
    texts = [r["text"] for r in prose[0].where("text is not null").orderBy("doc_id").limit(25).collect()] + ["".join(np.random.default_rng(3).choice(list("abcdefghij"), 3000))]
    for text in texts:
        stream, ids, held = pieces.Stream(lattice), [], 0
        for c in "▁" + text.replace(" ", "▁"):
            ids += stream.push(c)
            held = max(held, stream.held)
            assert stream.window <= p.longest
        assert stream.commits >= len(text) / 8 and held <= 2 * p.longest
        assert ids + stream.finish() == library.encode(text)


@pytest.mark.parametrize("most_states", [0, 50, 250_000])
def test_pieces_do_not_depend_on_memory_or_parts(prose, most_states):
    import sentencepiece

    path = public_tokenizers.path("piece_bpe_32k.model")
    own, library = pieces.Codec(path, most_states), sentencepiece.SentencePieceProcessor(model_file=path)
    rng = np.random.default_rng(2)
    for r in prose[0].where("text is not null").limit(20).collect():
        text = r["text"][:3000]
        ids = library.encode(text)
        assert own.encode(text) == ids == own.encode(text) and own.decode(ids) == text
        marked, stream, got, at = "▁" + text.replace(" ", "▁"), pieces.Stream(own.lattice), [], 0
        while at < len(marked):
            n = int(rng.integers(1, 40))
            got += stream.push(marked[at : at + n])
            at += n
        assert got + stream.finish() == ids
    assert len(own.lattice._known) <= max(1, most_states)


def test_piece_columns_round_trip(spark, odd):
    path = public_tokenizers.path("piece_bpe_32k.model")
    got = pieces.decode(pieces.encode(odd, path), path)
    assert got.where("not (text <=> decoded)").count() == 0 and got.count() == odd.count()
    assert pieces.digests(odd, path).where("not round_trip").count() == 0


# pipeline


def without_common_lines(rows):
    """Line deduplication in a loop: {(doc_id, text): (text left, lines removed)}."""
    sites: dict[str, set] = {}
    places: dict[str, list] = {}
    blank = " \t\n\x0b\x0c\r"
    for d, text, source in rows:
        for pos, line in enumerate((text or "").split("\n") if text is not None else []):
            bare = line.strip(blank)
            if len(bare) >= lines.MIN_CHARS:
                sites.setdefault(bare, set()).add(source or "")
                places.setdefault(bare, []).append((d, pos))
    common = {bare: min(places[bare]) for bare, found in sites.items() if len(found) >= lines.MIN_SITES}
    out = {}
    for d, text, _ in rows:
        left = [line for pos, line in enumerate((text or "").split("\n")) if (bare := line.strip(blank)) not in common or common[bare] == (d, pos)]
        out[d] = (None if text is None else "\n".join(left), 0 if text is None else len(text.split("\n")) - len(left))
    return out


def test_pipeline_stages_equal_loops_over_their_input(spark, tmp_path):
    import corpus_pipeline

    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    kept, sizes = docs, [docs.count()]
    stages = iter(corpus_pipeline.STAGES)

    def through() -> tuple[list, list]:
        nonlocal kept
        before = kept.collect()
        name, stage = next(stages)
        stage(spark, kept, sf).write.parquet(str(tmp_path / name))
        kept = spark.read.parquet(str(tmp_path / name))
        after = kept.collect()
        sizes.append(len(after))
        return before, after

    forest = quality.fit(docs, labels)
    before, after = through()
    want = [r["doc_id"] for r in before if forest.score(quality.statistics(pa.array([r["text"]])))[0] >= 0.3]
    assert sorted(r["doc_id"] for r in after) == sorted(want) and kept.columns == docs.columns

    model = language.fit(kept)
    before, after = through()
    shares = {r["doc_id"]: brute_mixture(model, r["text"]) for r in before}
    certain = {d for d, s in shares.items() if s.sum() and s.max() >= 0.41}
    assert certain <= {r["doc_id"] for r in after} <= {d for d, s in shares.items() if s.sum() and s.max() >= 0.39}

    before, after = through()
    loop = without_common_lines([(r["doc_id"], r["text"], r["source"]) for r in before])
    assert {r["doc_id"]: r["text"] for r in after} == {d: text for d, (text, n) in loop.items() if not n or text.strip(" \t\n\x0b\x0c\r")}
    assert all(r["n_chars"] == len(r["text"]) for r in after if loop[r["doc_id"]][1])

    before, after = through()
    groups = linked([(r["doc_id"], r["text"]) for r in before], 5, 80)
    assert sorted(r["doc_id"] for r in after) == sorted(d for d, (_, c) in groups.items() if c == d)
    assert sizes == sorted(sizes, reverse=True) and sizes[1] < sizes[0] and sizes[4] < sizes[3]

    _, pieces_ = through()
    assert {r["doc_id"] for r in pieces_} == {r["doc_id"] for r in after}
    ends: dict[int, int] = {}
    for r in sorted(pieces_, key=lambda r: (r["sequence_id"], r["offset"])):
        assert r["offset"] == ends.get(r["sequence_id"], 0)
        ends[r["sequence_id"]] = r["offset"] + r["length"]
    assert max(ends.values()) <= 1024 and len(ends) <= 1.02 * sum(ends.values()) / 1024 + 1


def test_pipeline_stages_take_awkward_rows(spark, odd, tmp_path):
    import corpus_pipeline

    sf = "/root/testdata/sf0.001"
    prose = spark.read.parquet(f"{sf}/documents.parquet").limit(150)
    extra = {"extra": "x", "score": "own", "predicted": "own", "shares": "own", "lang_pred": "own", "n_lines": "own", "n_removed": "own"}
    docs = prose.unionByName(odd.select(*prose.columns).withColumn("doc_id", F.col("doc_id") + 10_000_000))
    docs = docs.unionByName(odd.select(*prose.columns).where("doc_id is null")).withColumns({k: F.lit(v) for k, v in extra.items()})
    docs.write.parquet(str(tmp_path / "docs"))
    docs = spark.read.parquet(str(tmp_path / "docs"))
    for name, stage in corpus_pipeline.STAGES[:4]:
        got = stage(spark, docs, sf)
        assert got.columns == docs.columns and got.where("score <> 'own' or n_lines <> 'own' or lang_pred <> 'own'").count() == 0, name
        ids = {r["doc_id"] for r in got.collect()}
        if name in ("line dedup", "n-gram Jaccard join"):
            assert {10_000_000, 10_000_001, 10_000_002, None} <= ids  # null, empty and blank texts, and no id
        if name == "language ID":
            assert not {10_000_000, 10_000_001, 10_000_002} & ids
        assert stage(spark, docs.where("false"), sf).count() == 0, name
    assert corpus_pipeline.packed(spark, docs, sf).select("doc_id").distinct().count() == docs.select("doc_id").distinct().count()
    assert corpus_pipeline.packed(spark, docs.where("false"), sf).count() == 0


def test_span_hashes_do_not_depend_on_place():
    data = np.frombuffer(b"abc xabc abcabc", np.uint8)
    h = textbatch.span_hashes(data, np.array([0, 5, 9, 12, 9]), np.array([3, 8, 12, 15, 15]))
    assert len(set(h[:4].tolist())) == 1 and h[4] != h[0]


# many languages, long headers, many removed lines, few toxic rows


def test_many_languages_are_all_learned(spark):
    letters = "abcdefghijklmnopqrstuvwxyz"
    word = lambda i: letters[i % 26] + letters[i // 26 % 26] + letters[i // 7 % 26] * 2 + letters[i % 11]
    rows = [(k * 300 + i, " ".join([word(i)] * 30), f"l{i:03d}") for i in range(300) for k in range(3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(3, "lang")
    model = language.fit(docs)
    assert len(model.languages) == 300
    got = {r["doc_id"]: r["lang_pred"] for r in language.identify(docs, model).collect()}
    assert np.mean([got[i] == lang for i, _, lang in rows]) > 0.95


def test_a_url_of_two_megabytes_is_read_back(spark):
    pages = spark.createDataFrame([(1, "http://x/" + "u" * (2 << 20), "<p>one</p>"), (2, "http://y", "<p>two</p>")], "page_id long, url string, html string")
    assert sorted(r["page_id"] for r in warc.round_trip(pages).collect()) == [1, 2]
    noise = b"WARC/1.\r\nno names here " + b"x" * (3 << 20)
    assert [k for k, *_ in warc.salvage(noise + warc.record_bytes(7, "u", b"p", "ab" * 20, "revisit", 1))] == ["gap", "record"]


def test_removing_many_lines_of_a_text_takes_time_in_proportion(spark):
    import time

    def seconds(n):
        text = "\n".join(f"line {i} of the common part of all sites" for i in range(n))
        docs = spark.createDataFrame([(i, text + f"\nown line {i}", f"s{i}") for i in range(12)], "doc_id long, text string, source string")
        began = time.monotonic()
        rows = sorted(lines.deduplicate(docs).collect())
        assert [r["n_removed"] for r in rows] == [0, *[n] * 11] and rows[5]["text"] == "own line 5" and rows[0]["text"].count("\n") == n
        return time.monotonic() - began

    seconds(100)
    few, many = min(seconds(4000) for _ in range(2)), seconds(64_000)
    assert many < 16 * few  # a quadratic step takes 100 times as long and more


@pytest.mark.parametrize(("n", "least"), [(4, 0.6), (10, 0.75)])  # four are too few for passages: whole windows are learned from
def test_toxicity_learns_from_few_toxic_rows(spark, prose, n, least):
    clean = [r["text"] for r in prose[0].where("length(text) between 200 and 3000").limit(160).collect()]
    toxic = [f"{t} you vile zorgblat go away you zorgblat" for t in clean[80 : 80 + 2 * n]]
    rows = [(i, t, 0) for i, t in enumerate(clean[:80] + clean[120:])] + [(1000 + i, t, 1) for i, t in enumerate(toxic)]
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows if i < 1000 + n], "doc_id long, toxic int")
    got = {r["doc_id"]: r["score"] for r in toxicity.score(docs, toxicity.fit(docs, labels)).collect()}
    assert len(set(got.values())) > 2
    new, ordinary = [got[1000 + i] for i in range(n, 2 * n)], [got[i] for i, _, y in rows if not y]
    assert np.mean([a > b for a in new for b in ordinary]) > least


# source divergence

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
ASCII_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def divergences(docs, top=200):
    docs = [tuple(x or "" for x in d) for d in docs]
    out = []
    for lang in {d[1] for d in docs}:
        own = [(TERM.findall(t.translate(ASCII_LOWER)), s) for t, k, s in docs if k == lang]
        held = {}
        for words, _ in own:
            for w in set(words):
                held[w] = held.get(w, 0) + 1
        kept = sorted(w for w, n in held.items() if n >= 3)
        groups = {s: {w: 0 for w in kept} for _, s in own} | {None: {w: 0 for w in kept}}
        for words, s in own:
            for w in words:
                if w in groups[s]:
                    groups[s][w] += 1
                    groups[None][w] += 1
        p = {s: {w: 1 + 10**9 * (n + 1) // (sum(c.values()) + len(kept)) for w, n in c.items()} for s, c in groups.items()}
        f = lambda a, b: (a - b) ** 2 // b
        for s in groups:
            if s is None:
                continue
            parts = {"pair": [(o, sum(f(p[s][w], p[o][w]) for w in kept)) for o in groups if o not in (None, s)], "term": [(w, f(p[s][w], p[None][w])) for w in kept if groups[s][w] and p[s][w] > p[None][w]]}
            for part, rows in parts.items():
                ranked = sorted(rows, key=lambda r: (-r[1], r[0].encode()))[: top if part == "term" else None]
                out += [(lang, s, part, item, value, i) for i, (item, value) in enumerate(ranked, 1)]
    return sorted(out)


def audited(docs):
    return sorted((r["lang"], r["source"], r["part"], r["item"], r["value"], r["rank"]) for r in divergence.audit(docs).collect())


def test_divergence_equals_a_loop(spark, prose, odd, monkeypatch):
    rows = [(r["text"], r["lang"], r["source"]) for r in prose[0].where("doc_id < 90").collect()]
    rows += [("Äpfel ÄPFEL apfel\x00x", "xx", "a"), ("ÄPFEL äpfel", "xx", "b"), ("äpfel ÄPFEL q", "xx", "c"), ("ÄPFEL", "xx", None), (None, "empty", "e"), ("", "empty", "f"), ("1 2 3", None, None), ("word " * 50_000, "xx", "a")]
    docs = spark.createDataFrame([(*r, 1.0, "x", 2) for r in rows], "text string, lang string, source string, value double, term string, rank int").repartition(5)
    want = divergences(rows)
    assert audited(docs) == want and len({r[2] for r in want}) == 2
    # many shards, blocks and stripes, texts in segments, and tasks that hand on early
    for name, value in (("SHARD_ROWS", 50), ("BLOCK", 3), ("STRIPE", 7), ("STEP", 100), ("HELD_ROWS", 40), ("FEW_GROUPS", 0)):
        monkeypatch.setattr(divergence, name, value)
    parts = list(divergence.partial_counts(iter(pa.table({"lang": ["xx"] * 2, "source": ["a", "b"], "text": ["word " * 500 + "Äpfel", None]}).to_batches())))
    assert sorted((r["term"] or "", r["n"], r["docs"]) for b in parts for r in b.to_pylist() if r["n"]) == [("word", 500, 1), ("Äpfel".translate(ASCII_LOWER), 1, 1)]
    assert audited(docs) == want
    assert divergence.audit(odd.where("false")).count() == 0 and divergence.audit(odd).count() > 0


def test_shares_are_exact_for_large_counts(spark):
    rows = [(0, 7, 3), (5 * 10**11, 10**13, 10**10), (8 * 10**15, 8 * 10**15, 9), (10**9, 10**9, 1)]
    want = [1 + 10**9 * (c + 1) // (n + v) for c, n, v in rows]
    got = spark.createDataFrame(rows, "c long, n long, v long").select("c", divergence.share("c", "n", "v").alias("p")).collect()
    assert [p for c, _, _ in rows for r in got if (p := r["p"]) and r["c"] == c] == want
    assert divergence.shares(np.array([r[0] for r in rows]), np.array([n + v for _, n, v in rows])).tolist() == want


# language model


def scored_by_hand(texts, train):
    split = lambda t: ["<s>", *[w.translate(ASCII_LOWER) for w in re.findall(r"[^\x20\x09-\x0D]+", t or "")], "</s>"]
    pairs, count = {}, {}
    for t in train:
        s = split(t)
        for v, w in zip(s, s[1:]):
            pairs[v, w] = pairs.get((v, w), 0) + 1
            count[w] = count.get(w, 0) + 1
    n, types = sum(count.values()), len(count)
    before, after = {}, {}
    for (v, w), c in pairs.items():
        before.setdefault(w, []).append(v)
        after.setdefault(v, []).append(c)

    def steps(values):
        k = [sum(c == i for c in values) for i in (1, 2, 3, 4)]
        if all(k):
            y = k[0] / (k[0] + 2 * k[1])
            d = [1 - 2 * y * k[1] / k[0], 2 - 3 * y * k[2] / k[1], 3 - 4 * y * k[3] / k[2]]
            if all(0 < x <= i for i, x in enumerate(d, 1)):
                return d
        return [0.5, 1.0, 1.5]

    wide, narrow = steps(pairs.values()), steps([len(x) for x in before.values()])
    cut = lambda c, d: c - d[min(c, 3) - 1] if c else 0.0
    spare = sum(narrow[min(len(x), 3) - 1] for x in before.values()) / len(pairs) if pairs else 1.0
    one = lambda w: (cut(len(before.get(w, ())), narrow) / len(pairs) if pairs else 0.0) + spare / (types + 1)

    def two(v, w):
        if v not in after:
            return one(w)
        return (cut(pairs.get((v, w), 0), wide) + sum(wide[min(c, 3) - 1] for c in after[v]) * one(w)) / sum(after[v])

    out = []
    for t in texts:
        s = split(t)
        out.append((len(s) - 1, sum(w in count for w in s[1:]), n, sum(np.log10((count.get(w, 0) + 1) / (n + types + 1)) for w in s[1:]), sum(np.log10(two(v, w)) for v, w in zip(s, s[1:]))))
    return out, one, two, count


def test_language_model_equals_a_loop(spark, prose, odd, monkeypatch):
    rows = [(r["doc_id"], r["text"]) for r in prose[0].where("doc_id < 120").collect()] + [(200, None), (201, ""), (202, " \t"), (203, "The THE the unseenword"), (204, "the " * 40_000), (204, "the " * 40_000), (None, "the end")]
    held = lambda i: i is not None and zlib.crc32(str(i).encode()) % 7 == 2
    want, one, two, count = scored_by_hand([t for _, t in rows], [t for i, t in rows if not held(i)])
    docs = spark.createDataFrame([(i, t, 5.0, k) for k, (i, t) in enumerate(rows)], "doc_id long, text string, score double, n_tokens long").repartition(4)
    fields = ("n_tokens", "n_known", "train_tokens", "base_score", "score")

    def check(**other):
        for name, value in other.items():
            monkeypatch.setattr(kneser_ney, name, value)
        model = kneser_ney.fit(docs.where("doc_id is null or crc32(string(doc_id)) % 7 <> 2"), **({"shard_bytes": 20_000} if other else {}))
        assert len(model.hot) > 3 and (model.pair_shards > 8) == bool(other)
        named = docs.withColumnRenamed("n_tokens", "k")
        got = {r["k"]: r for r in kneser_ney.score(named, model).collect()}
        assert len(got) == len(rows)
        for k, w in enumerate(want):
            assert [got[k][c] for c in fields[:3]] == list(w[:3]) and [got[k][c] for c in fields[3:]] == pytest.approx(w[3:], rel=1e-9)
            assert got[k]["perplexity"] == pytest.approx(10 ** (-w[4] / w[0]))

    check()
    check(SCORED_PAIRS=700, HELD_PAIRS=900, WORDS_PER_SHARD=2, SCORED_BYTES=5000)
    # probabilities of all words and of one unknown after a word sum to one
    for v in ("<s>", "the", "neverseen"):
        assert sum(two(v, w) for w in count) + two(v, "another one") == pytest.approx(1)
    made = kneser_ney.score_documents(odd)
    assert made.columns == ["doc_id", "held_out", *fields, "perplexity"] and made.count() == odd.count()
    empty = kneser_ney.score(odd, kneser_ney.fit(odd.where("false"))).collect()
    assert {(r["n_known"], r["train_tokens"], r["base_score"], r["score"]) for r in empty} == {(0, 0, 0.0, 0.0)}
    assert kneser_ney.score_documents(odd.where("false")).count() == 0


def test_a_text_of_20_megabytes_is_scored_in_steps(spark):
    text = " ".join(f"w{i % 5000}" for i in range(3_500_000))
    docs = spark.createDataFrame([(0, text), (1, "w1 w2 w3")], "doc_id long, text string")  # the second one is held out
    got = {r["doc_id"]: r for r in kneser_ney.score_documents(docs).collect()}
    assert got[1]["held_out"] and got[1]["n_known"] == 4
    assert got[0]["n_tokens"] == got[0]["n_known"] == got[0]["train_tokens"] == 3_500_001 and got[0]["score"] / got[0]["n_tokens"] > -0.1


def test_stored_arrays_are_mapped_and_written_whole(tmp_path):
    keys, n = np.array([3, 9, 2**63], np.uint64), np.array([1, 70_000, 2])
    kneser_ney._store(f"{tmp_path}/pair-0", keys, [n])
    kneser_ney._store(f"{tmp_path}/pair-0", keys, [n])  # as a task that is tried again
    found = kneser_ney._mapped(f"{tmp_path}/pair-0", 1)
    assert found[0].tolist() == keys.tolist() and found[1].tolist() == n.tolist() and found[1].itemsize == 4 and isinstance(found[0], np.memmap)
    assert kneser_ney._look_up(np.array([9, 4, 2**63, 9], np.uint64), np.zeros(4, int), f"{tmp_path}/pair", ("count",))[0].tolist() == [70_000, 0, 2, 70_000]
    assert [p.name for p in tmp_path.iterdir()] == ["pair-0"]


# Merkle manifest


def manifest_by_hand(rows):
    import hashlib

    h = lambda x: hashlib.sha256(x.encode()).hexdigest()
    piece = lambda v: "-" if v is None else f"{len(str(v).encode())}:{v}"
    leaf = lambda i, t, lang, source, n: h("".join(map(piece, (i, source, lang, n, t))))

    def levels(nodes):
        out = [nodes]
        while len(out[-1]) > 1:
            out.append([h("".join(out[-1][k : k + 8])) for k in range(0, len(out[-1]), 8)])
        return out

    def path(made, p):
        steps = []
        for nodes in made[:-1]:
            first = p // 8 * 8
            steps.append(("".join(nodes[first:p]), "".join(nodes[p + 1 : first + 8])))
            p //= 8
        return steps

    trees = {}
    for r in rows:
        trees.setdefault(r[2], []).append(r)
    order = sorted(trees, key=lambda k: (k is not None, (k or "").encode()))
    made = {}
    for k in order:
        own = sorted((((r[0] is not None, r[0] or 0), leaf(*r), r) for r in trees[k]), key=lambda x: x[:2])
        made[k] = (own, levels([x[1] for x in own]))
    top = levels([made[k][1][-1][0] for k in order])
    out = []
    for place, k in enumerate(order):
        own, nodes = made[k]
        for p, (_, digest, r) in enumerate(own):
            steps = path(nodes, p) + path(top, place)
            hit = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 3 == 0 and r[1] is not None
            node = leaf(r[0], r[1].translate(ASCII_LOWER), *r[2:]) if hit else digest
            for before, after in steps:
                node = h(before + node + after)
            out.append((str(r[0]), digest, nodes[-1][0], top[-1][0], h("".join(a + b for a, b in steps)), node, node == top[-1][0]))
    return sorted(out)


@pytest.mark.parametrize("n", [0, 1, 8, 9, 64, 65, 513, 4200])
def test_proofs_equal_a_plain_tree(spark, n):
    rows = [(i * 7 % 5000, f"Text {i} Ü" if i % 11 else None, "en" if i % 9 else None, f"s{i % 3}" if i % 5 else None, i if i % 4 else None) for i in range(n)]
    rows += [(i, "B", f"l{i:02d}", "s", 1) for i in range(min(n, 12))] + ([(None, "no id", "en", "s", 2), (3, "twice", "en", "s", 2), (3, "twice", "en", "s", 2)] if n else [])
    docs = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, text string, lang string, source string, n_chars long, leaf string, pos int").repartition(5)
    got = sorted((str(r["doc_id"]), r["leaf"], r["subroot"], r["root"], r["proof_sha256"], r["folded_root"], r["verified"]) for r in merkle.documents_manifest(docs).collect())
    assert got == manifest_by_hand(rows)
    assert n < 64 or {r[-1] for r in got} == {True, False}


def test_only_every_third_level_is_stored(spark):
    leaves = merkle.numbered(spark.range(70_000).select(F.lit("t").alias("tree"), "id", F.sha2(F.col("id").cast("string"), 256).alias("digest")), "tree", ["id"])
    made = merkle.build(leaves, "tree")
    assert [level.count() for level in made.levels] == [70_000, 137] and made.roots.count() == 1
    assert leaves.where("pos <> id or size <> 70000").count() == 0
    some = merkle.proofs(made, made.roots.select("tree", F.col("digest").alias("root"), F.array().cast(merkle._PATH).alias("path"))).where("pos % 7001 = 0")
    assert {r[0] for r in some.select(merkle.folded(F.col("digest")) == F.col("root")).collect()} == {True} and some.count() == 10
    assert some.select(F.size("path")).first()[0] == 6


def test_manifest_takes_awkward_rows(spark, odd):
    got = merkle.documents_manifest(odd).collect()
    assert len(got) == odd.count() and len({r["root"] for r in got}) == 1 and all(r["leaf"] for r in got)


# very long texts, and packing against a loop


def test_long_texts_are_compressed_a_few_windows_at_a_time(monkeypatch):
    words = [f"w{i * 7919 % 977}" for i in range(30_000)]
    texts = [" ".join(words), "you vile zorgblat go away you zorgblat", None, " ", " ".join(words[:9])]
    model = toxicity.Model(b"".join(f" w{i}".encode() for i in range(400)), (b" vile zorgblat go away you zorgblat ",), np.zeros(6), np.zeros(5), np.ones(5))
    want = model.distances(texts)
    assert (want[[2, 3]] == 0).all() and want[1, 0] > 3
    held = []
    plain = toxicity.windows
    monkeypatch.setattr(toxicity, "AT_ONCE", 7)
    monkeypatch.setattr(toxicity, "windows", lambda w, n=8: (held.append(type(w)), plain(w, n))[1])
    assert (model.distances(texts) == want).all() and list not in held
    assert [*toxicity.windows(iter([b"a"] * 17))] == [b" " + b" ".join([b"a"] * 8) + b" "] * 2 + [b" a "]


def test_rules_and_lines_take_a_text_of_ten_megabytes(spark):
    text = "\n".join(f"line {i} has words {i * 31 % 9973} and more of them {i % 13}" for i in range(230_000))
    docs = spark.createDataFrame([(1, text, "a"), (2, "short", "b")], "doc_id long, text string, source string")
    got = {r["doc_id"]: r for r in rules.with_statistics(docs).collect()}
    assert got[1]["n_words"] == len(text.split()) and got[1]["n_dup_lines"] == 0 and got[2]["n_words"] == 1
    cleaned = {r["doc_id"]: r for r in lines.deduplicate(docs).collect()}
    assert cleaned[1]["text"] == text and cleaned[1]["n_lines"] == 230_000


@pytest.mark.parametrize("seed", range(6))
def test_best_two_fit_equals_a_loop_of_its_rule(seed):
    rng = np.random.default_rng(seed)
    capacity = int(rng.integers(8, 60))
    lengths = rng.integers(1, capacity + 1, int(rng.integers(1, 250))).tolist()
    left, want = sorted(lengths), []
    while left:
        own, gap = [], capacity
        while fits := [n for n in left if n <= gap]:
            left.remove(fits[-1])
            own.append(fits[-1])
            gap -= fits[-1]
        # the smallest gives way to the two that fill its place and the gap best; of equal sums, those with the longest piece
        pairs = [(a + b, max(a, b), min(a, b)) for i, a in enumerate(left) for b in left[i + 1 :] if own[-1] < a + b <= own[-1] + gap]
        if pairs:
            _, a, b = max(pairs)
            smallest = own.pop()
            for n in (a, b):
                left.remove(n)
            left = sorted([*left, smallest])
            own += [a, b]
        want.append(own)
    bins, offsets = packing.best_two_fit(np.array(lengths), capacity)
    got = [[lengths[i] for i in sorted(np.flatnonzero(bins == k), key=lambda i: offsets[i])] for k in range(bins.max() + 1)]
    assert got == want
