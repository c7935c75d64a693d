"""Nulls, empty and odd texts, repeats, empty tables and clashing columns, operator by operator."""

from __future__ import annotations

import base64
import hashlib
import random
import string
from collections import Counter

import numpy as np
import pytest
import zstandard
from pyspark.sql import functions as F

import corpus_pipeline
from footfall.llm import (
    chat,
    compression,
    decontamination,
    language_model,
    license_scan,
    mixing,
    near_dedup,
    quality,
    substring_dedup,
    warc,
)
from footfall.llm.tables import kept

LONG = " ".join(f"word{i % 977}é" for i in range(40_000))
PLAIN = " ".join(hashlib.md5(b"%d" % i).hexdigest()[: 3 + i % 5] for i in range(80))
ODD = [
    (1, None),
    (2, ""),
    (3, " \n\t"),
    (4, "one"),
    (5, LONG),
    (6, PLAIN),
    (6, PLAIN),
    (None, PLAIN + " and more"),
    (7, "ü" * 300),
    (8, "a\nb\na\nb"),
]
SCHEMA = "doc_id long, text string"
# Names that operators use for their own columns.
CLASHES = (
    "size n_words kept key label part spans items source_size target score ids _row row _key _id "
    "_gone _valid _judged judged valid _bucket repeats weight gone_id gone_key time n_bytes"
).split()


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(ODD, SCHEMA)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def clashing(df):
    return df.select("*", *[F.lit("x").alias(name) for name in CLASHES])


def content(df):
    return sorted(map(str, df.collect()))


BY_ROW = {
    "quality": quality.quality_rules,
    "licenses": license_scan.scan_licenses,
    "near": near_dedup.near_duplicates,
    "repeats": substring_dedup.repeated_strings,
}


@pytest.mark.parametrize("name", BY_ROW)
def test_odd_rows(odd, none, name):
    operator = BY_ROW[name]
    rows = operator(odd).collect()
    assert sorted(str(r.doc_id) for r in rows) == sorted(str(d) for d, _ in ODD)
    assert content(operator(clashing(odd))) == sorted(map(str, rows))
    assert operator(none).collect() == []


def test_quality_of_odd_rows(odd):
    rows = {r.doc_id: r for r in quality.quality_rules(odd).collect()}
    assert (rows[1].n_words, rows[1].base_failed, rows[1].ratio) == (0, True, None)
    assert rows[6].kept and not rows[4].kept
    assert rows[8].n_dup_lines == 2
    assert rows[5].n_words == 40_000
    sound = quality.keep_sound(clashing(odd))
    assert sound.columns == ["doc_id", "text", *CLASHES]
    assert {r.text for r in sound.collect()} == {PLAIN, PLAIN + " and more"}


def test_bands_reject_repetition_and_noise(spark):
    noise = "".join(chr(0x4E00 + (i * i * 7919) % 20000) + " " * (i % 2) for i in range(2000))
    rows = spark.createDataFrame([(1, PLAIN), (2, f"{PLAIN}\n" * 40), (3, noise)], SCHEMA)
    tight = quality.Bands(whole=((128, 0.1, 0.6),), chunk=1024, chunk_band=(0.2, 0.9))
    verdict = {r.doc_id: r for r in quality.quality_rules(rows, tight).collect()}
    assert verdict[1].kept and not verdict[2].kept and not verdict[3].kept
    assert verdict[3].n_chunks > 0


@pytest.fixture(scope="module")
def prose(spark):
    """Good documents of the test corpus."""
    folder = "/root/testdata/sf0.01"
    good = spark.read.parquet(f"{folder}/labels.parquet").where("quality = 1").select("doc_id")
    rows = spark.read.parquet(f"{folder}/documents.parquet").join(good, "doc_id").collect()
    return [r.text.encode() for r in sorted(rows, key=lambda r: r.doc_id)]


@pytest.mark.parametrize("at", range(len(quality.WHOLE)))
def test_each_limit_rejects_what_it_is_for(prose, at):
    """Base64, random letters, hex digits and half-repeated prose go, clean prose stays."""
    drawn = random.Random(at)
    least = quality.WHOLE[at][0]
    after = quality.WHOLE[at + 1][0] if at + 1 < len(quality.WHOLE) else 3 * least
    compressor = zstandard.ZstdCompressor(level=quality.Bands().level)

    def words(letters, size):
        parts = ("".join(drawn.choices(letters, k=drawn.randint(3, 8))) for _ in range(size // 4))
        return " ".join(parts).encode()[:size]

    def fits(text):
        return quality._judge(text, quality.Bands(), compressor)[3]

    for size in (least, (least + after) // 2, after - 1):
        # Cut to the length that is tested, as a class may have few texts of its own.
        for text in prose:
            assert len(text) < size or fits(text[:size])
        assert not fits(base64.b64encode(drawn.randbytes(size))[:size])
        if least >= 2048:
            assert not fits(words(string.ascii_lowercase, size))
        if least >= 4096:
            assert not fits(words("0123456789abcdef", size))
        if least >= 192:
            half = [t[: size // 2] for t in prose if 2 * len(t) >= size]
            # All of the corpus: a few halves shrink so little that twice the text still fits.
            assert half and sum(fits(t + t) for t in half) <= 0.02 * len(half)


def test_chunks_are_judged_by_their_own_length():
    """Hex digits in every chunk, of which a late repeat brings the whole text into its limits."""
    drawn = random.Random(1)
    noise = " ".join("".join(drawn.choices("0123456789abcdef", k=5)) for _ in range(1667)).encode()
    text = noise + noise[:5000]
    compressor = zstandard.ZstdCompressor(level=quality.Bands().level)
    ratio, chunks, bad, fits = quality._judge(text, quality.Bands(), compressor)
    low, high = quality.Bands().limits(len(text))
    assert low <= ratio <= high
    assert (chunks, bad, fits) == (4, 3, False)


def test_near_duplicates_of_odd_rows(odd):
    rows = near_dedup.near_duplicates(odd, size=2).collect()
    part = {r.doc_id: r.component_id for r in rows}
    assert part == {1: 1, 2: 2, 3: 3, 4: 4, 5: 5, 6: 6, None: 6, 7: 7, 8: 8}
    assert [r.kept for r in rows if r.doc_id == 6] == [True, True]
    assert [r.kept for r in rows if r.doc_id is None] == [False]
    left = near_dedup.keep_one(clashing(odd), size=2)
    assert left.columns == ["doc_id", "text", *CLASHES]
    assert sorted(r.doc_id for r in left.collect()) == [1, 2, 3, 4, 5, 6, 6, 7, 8]


def test_repeats_of_odd_rows(odd):
    rows = {r.doc_id: r for r in substring_dedup.repeated_strings(odd).collect()}
    assert (rows[1].n_bytes, rows[1].n_removed) == (0, 0)
    assert rows[1].kept_sha256 == hashlib.sha256(b"").hexdigest()
    assert rows[6].n_removed == len(PLAIN)
    assert rows[None].n_removed == len(PLAIN)
    assert rows[7].n_removed == 600
    left = substring_dedup.without_repeats(clashing(odd))
    assert left.columns == ["doc_id", "text", *CLASHES]
    got = {r.doc_id: r.text for r in left.collect()}
    assert rows[5].n_removed == rows[5].n_bytes  # it repeats itself
    assert set(got) == {1, 2, 3, 4, None, 8}
    assert got[None] == " and more" and got[1] is None


def test_a_cut_character_goes_as_a_whole(spark):
    """The repeat ends on the first of two bytes of a character."""
    same = "x" * 20 + "".join(chr(97 + i * i % 26) for i in range(300))
    rows = spark.createDataFrame([(1, same + "é1"), (2, same + "è2")], SCHEMA)
    got = {r.doc_id: r.text for r in substring_dedup.without_repeats(rows).collect()}
    assert got == {1: "1", 2: "2"}


def _passages():
    """Passages of about 200 bytes and copies of others, in different surroundings."""
    random.seed(9)

    def words(n):
        stems = ["the", "of", "élan", "q", "ipsum"]
        return " ".join(f"{random.choice(stems)}{random.randrange(50)}" for _ in range(n))

    base = [words(120) for _ in range(3)]
    texts = [base[0], base[0], "ab " * 300, "ab " * 500 + "x", "a" * 900]
    for _ in range(40):
        cut = random.choice([185, 195, 199, 200, 205, 230])
        texts.append(words(20) + base[2][:cut] + words(20))
    for _ in range(15):
        a = random.randrange(200)
        texts.append(words(5) + base[1][a : a + random.randrange(150, 500)] + words(9))
    return texts + [words(30) + "a" * 250, words(30) + "a" * 150, f"line {words(8)}\n" * 30]


@pytest.mark.parametrize("crowd", [1 << 20, 1])
def test_crowded_anchors_give_the_same(spark, monkeypatch, crowd):
    monkeypatch.setattr(substring_dedup, "CROWD", crowd)
    texts = _passages()
    raw = [t.encode() for t in texts]
    seen = Counter(b[i : i + 200] for b in raw for i in range(len(b) - 199))
    want = []
    for i, b in enumerate(raw):
        gone = bytearray(len(b))
        for k in range(len(b) - 199):
            if seen[b[k : k + 200]] > 1:
                gone[k : k + 200] = b"\1" * 200
        runs = sum(g and not (k and gone[k - 1]) for k, g in enumerate(gone))
        left = bytes(c for c, g in zip(b, gone, strict=True) if not g)
        want.append((i, len(b), sum(gone), runs, hashlib.sha256(left).hexdigest()))
    df = spark.createDataFrame(list(enumerate(texts)), SCHEMA)
    got = substring_dedup.repeated_strings(df).collect()
    assert sorted(map(tuple, got)) == want


@pytest.mark.parametrize("block", [512, 5])
def test_large_families_give_the_same(spark, monkeypatch, block):
    monkeypatch.setattr(near_dedup, "BLOCK_TEXTS", block)
    monkeypatch.setattr(near_dedup, "PIVOTS", 2)
    random.seed(6)
    texts = []
    for family in range(3):
        base = [f"w{family}x{i}" for i in range(70)]
        for _ in range(20):
            odds = random.choice([0.01, 0.04, 0.08, 0.3])
            texts.append(" ".join(w if random.random() > odds else "y" for w in base))
    sets = [set(zip(t.split(), t.split()[1:], strict=False)) for t in texts]
    label = list(range(len(texts)))
    for _ in texts:
        for i, a in enumerate(sets):
            for j in range(i):
                if 100 * len(a & sets[j]) >= 80 * len(a | sets[j]):
                    label[i] = label[j] = min(label[i], label[j])
    assert 3 < len(set(label)) < len(texts)
    df = spark.createDataFrame(list(enumerate(texts)), SCHEMA)
    got = near_dedup.near_duplicates(df, size=2).collect()
    assert {r.doc_id: r.component_id for r in got} == dict(enumerate(label))


@pytest.fixture(scope="module")
def tests(spark):
    passage = " ".join(PLAIN.split()[20:40]).upper()
    rows = [("a", passage), (None, "One"), ("c", None), ("d", " "), ("a", passage), ("e", "two b")]
    return spark.createDataFrame(rows, "item_id string, text string")


@pytest.mark.parametrize("test_bytes", [1 << 20, 1])
def test_contamination_of_odd_rows(odd, none, tests, test_bytes):
    found = decontamination.find_contamination(odd, tests, test_bytes=test_bytes)
    rows = {r.doc_id: r for r in found.collect()}
    assert (rows[6].n_hit, rows[6].items, rows[6].longest_match) == (20, ["a"], 20)
    assert [tuple(s) for s in rows[6].spans] == [(20, 40)]
    assert (rows[4].n_hit, rows[4].items) == (1, [""])
    assert rows[1].n_words == rows[1].n_hit == 0
    assert rows[None].n_hit == 20
    again = decontamination.find_contamination(clashing(odd), tests, test_bytes=test_bytes)
    assert content(again) == content(found)
    assert decontamination.find_contamination(none, tests, test_bytes=test_bytes).collect() == []
    left = decontamination.find_contamination(odd, tests.limit(0), test_bytes=test_bytes)
    assert left.where("n_hit > 0").isEmpty() and left.count() == len(ODD)


def test_decontaminated_rows_keep_their_columns(odd, tests):
    left = decontamination.decontaminate(clashing(odd), tests)
    assert left.columns == ["doc_id", "text", *CLASHES]
    assert sorted(r.doc_id for r in left.collect()) == [1, 2, 3, 5, 7, 8]


def test_bundles_of_odd_pages(spark):
    pages = [
        (5, "http://a/é \r\n", "<p>same</p>"),
        (3, None, "<p>same</p>"),
        (3, None, "<p>same</p>"),
        (None, "http://b", "<p>same</p>"),
        (9, "http://c", None),
        (10, "http://c", ""),
        (11, "http://d", "é\r\n\r\nWARC/1.1\r\n" * 50_000),
        (None, None, "alone"),
    ]
    df = spark.createDataFrame(pages, "page_id long, url string, html string")
    bundles = kept(warc.write_bundles(clashing(df), frame_bytes=1000, bundle_bytes=10_000))
    rows = warc.read_bundles(bundles).collect()
    got = sorted((str(r.page_id), r.record_type, r.refers_to) for r in rows)
    assert got == sorted(
        [
            ("5", "revisit", 3),
            ("3", "response", None),
            ("3", "response", None),
            ("None", "revisit", 3),
            ("9", "response", None),
            ("10", "revisit", 9),
            ("11", "response", None),
            ("None", "response", None),
        ]
    )
    payloads = {r.page_id: bytes(r.payload) for r in rows if r.payload is not None and r.page_id}
    assert payloads[11].decode() == pages[6][2] and payloads[9] == b""
    assert {r.page_id: r.payload_bytes for r in rows}[5] == len("<p>same</p>")
    # Ids tell all records apart, also those of repeated rows.
    ids = [r.record_id for r in rows]
    assert len(set(ids)) == len(ids) == 8
    # Each record can be read alone, by the index.
    for bundle in bundles.collect():
        content_ = bytes(bundle.content)
        for entry in bundle.records:
            record = warc.read_record(content_, entry.frame, entry.place, entry.length)
            fields, _ = warc.parse(record)
            assert fields["WARC-Record-ID"] == entry.record_id
    empty = spark.createDataFrame([], "page_id long, url string, html string")
    assert warc.read_bundles(warc.write_bundles(empty)).collect() == []


def test_a_bundle_is_ordinary_zstandard(spark):
    import zstandard

    bundle = warc.Bundle(100)
    for i in range(20):
        bundle.add(f"r{i}", i, b"%04d" % i * 20)
    content_ = bundle.content()
    whole = zstandard.ZstdDecompressor().stream_reader(content_, read_across_frames=True).read()
    assert whole == b"".join(b"%04d" % i * 20 for i in range(20))
    frames = warc.seek_table(content_)
    assert len(frames) == 10 and sum(f[2] for f in frames) == len(whole)
    with pytest.raises(ValueError, match="no seek table"):
        warc.seek_table(content_[:-1])


def test_chats_of_odd_rows(spark):
    rows = [
        (1, 0, "user", "<turn> \\</turn> \\\\<says>"),
        (1, 1, "assistant", "a </turn><turn>b"),
        (1, 1, "assistant", "a </turn><turn>b"),
        (1, None, None, None),
        (None, 3, "weird </turn> role", "x" * 70_000),
        (2, 0, "assistant", ""),
    ]
    schema = "conv_id long, turn long, role string, text string"
    ranks = chat.vocabulary(spark)
    df = clashing(spark.createDataFrame(rows, schema))
    for tokens in (1, 1 << 16):
        chunks = kept(chat.format_chats(df, ranks, chunk_tokens=tokens))
        turns = chat.decoded(chunks, ranks).collect()
        turns.sort(key=lambda r: (r.conv_id or 0, r.chunk, r.at))
        got = [(r.conv_id, r.role, r.text, r.learned) for r in turns]
        assert got == [
            (None, "weird </turn> role", "x" * 70_000, ""),
            (1, "", "", ""),
            (1, "user", rows[0][3], ""),
            (1, "assistant", rows[1][3], rows[1][3]),
            (1, "assistant", rows[1][3], rows[1][3]),
            (2, "assistant", "", ""),
        ]
    assert chat.decoded(chat.format_chats(df.limit(0), ranks), ranks).collect() == []


def test_language_model_of_odd_rows(odd, none):
    learn = odd.withColumn("learn", F.col("doc_id") != 4)  # NULL for a NULL id
    rows = language_model.score_texts(clashing(learn)).collect()
    found = {r.doc_id: r for r in rows}
    assert len(rows) == len(ODD)
    assert [found[d].n_tokens for d in (1, 2, 3, 4, 5)] == [1, 1, 1, 2, 40_001]
    assert (found[4].n_known, found[1].n_known) == (1, 1)
    assert found[6].train_tokens == 1 + 1 + 1 + 40_001 + 81 + 81 + 2 + 5
    assert language_model.score_texts(none.withColumn("learn", F.lit(True))).collect() == []
    unlearnt = language_model.score_texts(odd.withColumn("learn", F.lit(False))).collect()
    assert all(r.train_tokens == r.n_known == r.base_score == 0 for r in unlearnt)
    assert all(r.score < 0 for r in unlearnt)


def test_contexts_tell_rare_words_apart(spark):
    """Two words with one ending and one count, neither among the listed ones."""
    listed = [(i, " ".join(f"c{k:03}" for k in range(600)), True) for i in range(12)]
    pairs = [f"alpha{i} one{i}zz. beta{i} two{i}zz." for i in range(40)]
    learnt = [(100 + i, f"{pairs[i % 40]} {pairs[(i + 7) % 40]}", True) for i in range(120)]
    asked = [(1000 + i, f"alpha{i} one{i}zz.", False) for i in range(40)]
    asked += [(2000 + i, f"alpha{i} two{i}zz.", False) for i in range(40)]
    df = spark.createDataFrame(listed + learnt + asked, "doc_id long, text string, learn boolean")
    score = {r.doc_id: r.score for r in language_model.score_texts(df).collect()}
    assert all(score[1000 + i] > score[2000 + i] + 0.5 for i in range(40))


def test_chances_after_a_word_add_up():
    """Over seen and unseen words of a context, at any discount."""
    draw = random.Random(4)
    words = list(range(30))
    shards = [draw.sample(words, 20) for _ in range(3)]
    shards.append(words)
    keys = [np.array([5 << 24 | w for w in sorted(s)], np.uint64) for s in shards]
    counts = [np.array([draw.randrange(3) * (i < 12) for i in range(len(k))]) for k in keys]
    *_, last = language_model._settled(keys, counts)
    seen, left = language_model._discounted(keys[-1], last)
    assert len(set(left)) == 1 and 0 < left[0] < 1
    assert sum(seen) + left[0] == pytest.approx(1)


def test_classifier_of_odd_rows(spark, odd, none):
    labels = spark.createDataFrame(
        [(5, 1), (6, 1), (8, 0), (7, 0), (1, 0), (None, 1), (6, None)], "doc_id long, label int"
    )
    model = compression.train(clashing(odd), labels)
    rows = compression.score(clashing(odd), model).collect()
    assert len(rows) == len(ODD) and all(0 <= r.score <= 1 for r in rows)
    assert compression.score(none, model).collect() == []
    untaught = compression.train(none, labels)
    assert all(abs(r.score - 0.5) < 0.3 for r in compression.score(odd, untaught).collect())


def test_classifier_reads_long_texts_whole(spark):
    """Labels differ at the ends only, far from the middle; length leaves a score in place."""
    drawn = random.Random(8)
    words = [[f"{drawn.randrange(1 << 40):x}" for _ in range(60)] for _ in range(3)]

    def some(kind, n):
        return " ".join(drawn.choice(words[kind]) for _ in range(n))

    texts = [some(i % 2, 600) + some(2, 900) + some(i % 2, 600) for i in range(120)]
    df = spark.createDataFrame(list(enumerate(texts)), SCHEMA)
    labels = spark.createDataFrame([(i, i % 2) for i in range(90)], "doc_id long, label int")
    model = compression.train(df, labels)
    rows = {r.doc_id: r for r in compression.score(df, model).collect()}
    assert all((rows[i].score > 0.5) == bool(i % 2) for i in range(90, 120))
    sizes = compression._Sizes(model)
    short, long = (sizes.difference(some(1, n).encode()) for n in (300, 12_000))
    assert short > 0 and long > 0.8 * short


def test_mixing_of_odd_rows(spark):
    rows = [(1, "a", 10), (1, "a", 10), (2, "a", 0), (None, None, 7), (3, "b", 5), (4, "zero", 0)]
    df = spark.createDataFrame(rows, "doc_id long, source string, size long")
    df = df.withColumns({name: F.lit("x") for name in CLASHES if name not in ("size", "source")})
    weights = mixing.cycled_weights(df)
    order = {r.source: r.weight for r in weights.collect()}
    assert order == {"a": 5, "b": 2, "zero": 1, None: 5}
    got = mixing.mix(df, weights)
    new = ["source_size", "target", "repeats"]
    assert got.columns == [*[c for c in df.columns if c not in new], *new]
    assert {r[c] for r in got.collect() for c in CLASHES if c not in ("size", *new)} == {"x"}
    by_source = {r.source: (r.source_size, r.target) for r in got.collect()}
    assert by_source["zero"] == (0, 0.0)
    assert sum(t for _, t in by_source.values()) == pytest.approx(1.5 * 32)
    assert all(t <= 2 * s for s, t in by_source.values())
    assert mixing.mix(df.limit(0), weights.limit(0)).collect() == []
    assert mixing.repeated(got).count() == sum(r.repeats for r in got.collect())


KEEPERS = {
    "keep_sound": quality.keep_sound,
    "keep_one": near_dedup.keep_one,
    "without_repeats": substring_dedup.without_repeats,
    "take": mixing.take,
}


@pytest.mark.parametrize("name", KEEPERS)
def test_columns_of_the_caller_come_back(odd, none, name):
    sourced = odd.withColumn("source", F.when(F.col("doc_id") > 4, "s"))
    call = KEEPERS[name]
    plain = content(call(sourced).select("doc_id", "text"))
    marked = call(clashing(sourced))
    assert marked.columns == ["doc_id", "text", "source", *CLASHES]
    assert content(marked.select("doc_id", "text")) == plain
    assert {row[c] for row in marked.collect() for c in CLASHES} <= {"x"}
    empty = clashing(none.withColumn("source", F.lit(None).cast("string")))
    assert call(empty).collect() == []


@pytest.mark.parametrize("at", range(len(corpus_pipeline.STAGES)))
def test_columns_pass_through_the_stages(spark, at):
    folder = "/root/testdata/sf0.001"
    name, stage = corpus_pipeline.STAGES[at]
    docs = spark.read.parquet(f"{folder}/documents.parquet").limit(60)
    plain = stage(spark, docs, folder)
    marked = stage(spark, clashing(docs), folder)
    assert plain.columns == docs.columns
    assert marked.columns == [*docs.columns, *CLASHES]
    assert content(marked.select(*docs.columns)) == content(plain)
    assert {row[c] for row in marked.collect() for c in CLASHES} <= {"x"}
    assert stage(spark, clashing(docs).limit(0), folder).collect() == []


def test_sources_stop_at_their_cap(spark):
    sources = spark.createDataFrame(
        [("a", 10, 100), ("b", 100, 1), ("c", 1000, 1), ("d", 5, 0)],
        "source string, source_size long, weight long",
    )
    filled = {r.source: r.target for r in mixing.water_fill(sources, 0.5, 2.0).collect()}
    assert filled["a"] == 20 and filled["b"] == 200 and filled["d"] == 0
    assert filled["c"] == pytest.approx(0.5 * 1115 - 220)
    over = {r.source: r.target for r in mixing.water_fill(sources, 9.0, 2.0).collect()}
    assert over == {"a": 20, "b": 200, "c": 2000, "d": 0}


@pytest.mark.parametrize(
    "call",
    [
        quality.quality_rules,
        near_dedup.keep_one,
        substring_dedup.without_repeats,
        license_scan.scan_licenses,
    ],
)
def test_a_missing_column_is_named(spark, call):
    with pytest.raises(ValueError, match="column (doc_id|text) is needed"):
        call(spark.createDataFrame([(1,)], "other long"))
