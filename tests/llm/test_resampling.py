"""Importance resampling against features, buckets and draws taken one by one."""

from __future__ import annotations

import hashlib
import math
import random
import re
from collections import Counter
from zlib import crc32

import pytest
from pyspark.sql import functions as F

from millrace.llm import resampling

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
SCHEMA = "doc_id long, text string, lang string"


def features(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = WORD.findall(lowered)
    return words, [crc32(f.encode()) % 10_000 for f in [*words, *(f"{a} {b}" for a, b in zip(words, words[1:]))]]


def brute(docs, items, min_words, share, seed):
    s = Counter(b for _, text, *_ in docs for b in features(text)[1])
    t = Counter(b for _, text in items for b in features(text)[1])
    big_s, big_t = sum(s.values()), sum(t.values())
    rows = []
    for doc, text, *_ in docs:
        words, buckets = features(text)
        gains = [math.floor(1000 * math.log((t[b] + 1.0) * (big_s + 10_000) / ((s[b] + 1.0) * (big_t + 10_000)))) for b in buckets]
        weight = sum(gains) // len(gains) if gains else 0
        h = int(hashlib.sha256(f"{seed}:{'' if doc is None else doc}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        rows.append((len(words) >= min_words, doc, len(buckets), weight, score))
    able = sorted((r for r in rows if r[0]), key=lambda r: (-r[4], r[1] is None, r[1] or 0))[: sum(r[0] for r in rows) * share // 100]
    ranks = Counter()
    out = []
    for rank, row in enumerate(able, 1):
        out.append((*row[1:], rank))
        ranks[row] += 1
    out += [(*row[1:], None) for row, n in Counter(rows).items() for _ in range(n - ranks[row])]
    return sorted(out, key=repr)


@pytest.fixture(scope="module")
def tables(spark):
    rng = random.Random(8)
    pool = [f"w{i}" for i in range(30)] + ["Straße", "ÉTÉ", "日本", "A1", "x" * 70, "İ"]
    docs = [(i, " ".join(rng.choices(pool, weights=range(len(pool), 0, -1), k=rng.randrange(60))).replace("w3 ", "W3\n\t-- "), "en") for i in range(150)]
    docs += [(150, None, None), (151, "", "en"), (152, " \x00-\x7f ", "en"), (None, docs[3][1], "en"), (7, docs[7][1], "en"), (7, docs[7][1], "en")]
    docs += [(153, " ".join(rng.choices(pool, k=20_000)), None)]
    items = [(1, "w1 w2 W5"), (2, None), (2, "日本 w7, w7"), (3, "")]
    return docs, items, spark.createDataFrame(docs, SCHEMA).repartition(5), spark.createDataFrame(items, "item_id long, text string")


@pytest.mark.parametrize("head", [(3, 2), (0, 0), (1000, 1000)])
def test_every_head_gives_the_brute_result(tables, monkeypatch, head):
    docs, items, frame, targets = tables
    whole = resampling.frequent_head
    monkeypatch.setattr(resampling, "frequent_head", lambda d: whole(d, *head))
    got = resampling.resampled(frame, targets, min_words=5, share=30, seed=11).collect()
    assert sorted((tuple(r) for r in got), key=repr) == brute(docs, items, 5, 30, 11)


def test_small_slices_give_the_same(tables, monkeypatch):
    docs, items, frame, targets = tables
    monkeypatch.setattr(resampling, "_HELD", 10)
    assert sorted((tuple(r) for r in resampling.resampled(frame, targets).collect()), key=repr) == brute(docs, items, 20, 25, 7)


def test_drawn_documents_keep_their_columns(tables):
    docs, items, frame, targets = tables
    clashing = frame.withColumns({c: F.lit("given") for c in ("rank", "score", "__may", "__place", "__drawn_id", "chosen", "n_words")})
    out = resampling.drawn(clashing, targets, min_words=5)
    assert out.columns == clashing.columns
    want = {r[0] for r in brute(docs, items, 5, 25, 7) if r[4]}
    assert {r.doc_id for r in out.collect()} == want


def test_empty_tables(tables):
    _, _, frame, targets = tables
    assert resampling.resampled(frame.limit(0), targets).count() == 0
    assert resampling.resampled(frame, targets.limit(0)).where("rank IS NOT NULL").count() > 0
