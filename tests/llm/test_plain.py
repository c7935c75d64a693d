"""The classifier's scores and the license finds, worked out again the plain way."""

from __future__ import annotations

import math
import random
import re
import zlib

import pytest
import zstandard
from pyspark.sql import functions as F

from footfall.llm import compression, license_scan
from footfall.llm.licenses import TEMPLATES
from footfall.llm.queries import QUERIES

FOLDERS = ["/root/testdata/sf0.001", "/root/testdata/sf0.01"]
WORD = re.compile(rb"[0-9a-z\x80-\xff]+")


def held_out(doc_id):
    return zlib.crc32(str(doc_id).encode()) % 3 == 1


@pytest.mark.parametrize("folder", FOLDERS)
def test_classifier_scores(spark, folder):
    """Each score from the compressed sizes of the text's pieces with either dictionary."""
    documents = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    texts = {r.doc_id: (r.text or "").encode() for r in documents.collect()}
    learned = [r for r in labels.collect() if not held_out(r.doc_id)]
    pairs = [(r.doc_id, r.quality) for r in learned]
    marks = spark.createDataFrame(pairs, "doc_id long, label int")
    model = compression.train(documents, marks)

    bad_sizes, good_sizes = (
        zstandard.ZstdCompressor(level=3, dict_data=zstandard.ZstdCompressionDict(d)).compress
        for d in (model.bad, model.good)
    )
    rows = QUERIES["op6_compression_classifier"](spark, folder).collect()
    assert sorted(r.doc_id for r in rows) == sorted(texts)
    for row in rows:
        text = texts[row.doc_id]
        n = max(1, round(len(text) / 2048))
        parts = [text[len(text) * k // n : len(text) * (k + 1) // n] for k in range(n)]
        bad, good = (sum(len(size(x)) for x in parts) for size in (bad_sizes, good_sizes))
        score = 1 / (1 + math.exp(-model.slope * ((bad - good) / (bad + good) - model.middle)))
        assert row.score == pytest.approx(score, abs=1e-9)
        assert (row.held_out, row.predicted) == (held_out(row.doc_id), int(score >= 0.5))


def test_held_out_labels_teach_nothing(spark):
    documents = spark.read.parquet(f"{FOLDERS[0]}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{FOLDERS[0]}/labels.parquet")
    hidden = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1
    label = F.col("quality").alias("label")
    told = labels.where(~hidden).select("doc_id", label)
    model = compression.train(documents, told)
    again = compression.train(documents, told.repartition(7))
    assert model == again
    turned = F.when(hidden, 1 - F.col("quality")).otherwise(F.col("quality"))
    changed = labels.withColumn("quality", turned)
    assert compression.train(documents, changed.where(~hidden).select("doc_id", label)) == model


def common(a, b):
    """Words in common, in order: the plain table of all prefixes."""
    last = [0] * (len(b) + 1)
    for x in a:
        now = [0]
        for j, y in enumerate(b):
            now.append(last[j] + 1 if x == y else max(last[j + 1], now[j]))
        last = now
    return last[-1]


def check_finds(text, finds):
    words = WORD.findall(text.encode().lower())
    for find in finds:
        template = WORD.findall(TEMPLATES[find.template].encode().lower())
        span = words[find.first : find.end]
        assert find.matched == common(template, span), (find, span[:30])
        assert find.coverage == pytest.approx(find.matched / len(template))
        assert find.coverage >= license_scan.LEAST_COVERAGE
        # A span begins and ends with words that are matched.
        assert find.matched > common(template, span[1:]) or span[0] in template
        assert span[0] in template and span[-1] in template


@pytest.mark.parametrize("folder", FOLDERS)
def test_finds_in_the_test_documents(spark, folder):
    documents = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text")
    texts = {r.doc_id: r.text or "" for r in documents.collect()}
    found = 0
    for row in QUERIES["op4_license_scan"](spark, folder).collect():
        check_finds(texts[row.doc_id], row.licenses)
        found += len(row.licenses)
    assert found


def test_finds_of_changed_templates(spark):
    """Templates of all lengths amid other words, with words left out, put in and changed."""
    drawn = random.Random(4)
    other = [f"w{i}" for i in range(300)]
    names = sorted(TEMPLATES, key=lambda n: len(TEMPLATES[n]))
    rows = []
    for name in [*names[:40], *names[60:70]]:
        words = TEMPLATES[name].split()
        for rate in (0.0, 0.04, 0.1):
            changed = []
            for word in words:
                roll = drawn.random()
                if roll < rate / 3:
                    continue
                changed.append(drawn.choice(other) if roll < 2 * rate / 3 else word)
                if roll > 1 - rate / 3:
                    changed.append(drawn.choice(other))
            around = [drawn.choices(other, k=drawn.randint(0, 60)) for _ in range(2)]
            rows.append((len(rows), " ".join([*around[0], *changed, *around[1]]), name, rate))
    df = spark.createDataFrame(rows, "doc_id long, text string, name string, rate double")
    finds = {r.doc_id: r.licenses for r in license_scan.scan_licenses(df).collect()}
    for doc_id, text, name, rate in rows:
        check_finds(text, finds[doc_id])
        if not rate:
            whole = [f for f in finds[doc_id] if f.coverage == 1]
            assert name in {f.template for f in whole}, name
