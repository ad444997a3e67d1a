"""Ranked search against scores taken document by document."""

from __future__ import annotations

import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.llm import lexical_search

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return ["".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t) for t in TERM.findall(text or "")]


def brute(docs, items, best):
    bags = [(doc, Counter(terms(text))) for doc, text, *_ in docs]
    documents = sum(1 for _, b in bags if b)
    length = sum(sum(b.values()) for _, b in bags)
    df = Counter(t for _, b in bags for t in b)
    out = []
    for item, text in items:
        asked, found = set(terms(text)), []
        for doc, bag in bags:
            m = 50 + (50 * sum(bag.values()) * documents) // max(1, length)
            score = 0
            for term in asked & set(bag):
                w = math.floor(1000 * math.log((2.0 * documents + 2) / (2.0 * df[term] + 1)))
                score += w * ((1_000_000_000 * bag[term]) // (1000 * bag[term] + 20 * m))
            if score > 0:
                found.append((-score, doc is None, doc or 0))
        out += [(item, rank, None if nameless else doc, -score) for rank, (score, nameless, doc) in enumerate(sorted(found)[:best], 1)]
    return sorted(out, key=repr)


@pytest.fixture(scope="module")
def tables(spark):
    rng = random.Random(3)
    pool = [f"t{i}" for i in range(300)] + ["Ünï", "日本"]
    weights = [1 / (i + 1) for i in range(len(pool))]
    docs = [(i, ", ".join(rng.choices(pool, weights, k=rng.randrange(1, 80))), "given") for i in range(400)]
    docs += [(400 + i, docs[5][1], "given") for i in range(70)]  # ties beyond the best
    docs += [(None, docs[5][1], "given"), (9, docs[9][1], "given"), (9, docs[9][1], "given"), (600, None, None), (601, "", None), (602, " ?! ", None)]
    docs += [(603, " ".join(rng.choices(pool, k=30_000)), None)]
    items = [(i, " ".join(rng.choices(pool, weights, k=rng.randrange(1, 40))).upper()) for i in range(12)]
    items += [(20, " ".join(pool)), (21, " ".join(pool[100:190])), (22, None), (23, ""), (24, "unknown words"), (25, docs[5][1]), (None, "t7 t8")]
    return docs, items, spark.createDataFrame(docs, "doc_id long, text string, score string").repartition(4), spark.createDataFrame(items, "item_id long, text string")


@pytest.mark.parametrize("best", [1, 50])
def test_search_against_all_scores(tables, best):
    docs, items, frame, asked = tables
    got = lexical_search.ranked(frame, asked, best)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    assert sorted((tuple(r) for r in got.collect()), key=repr) == brute(docs, items, best)


def test_blocks_of_items_and_narrow_slices_give_the_same(tables, monkeypatch):
    docs, items, frame, asked = tables
    monkeypatch.setattr(lexical_search, "ROUND", 2)
    got = lexical_search.ranked(frame.withColumns({c: F.lit(1) for c in ("rank", "n", "terms")}), asked, 50, block_chars=900)
    assert sorted((tuple(r) for r in got.collect()), key=repr) == brute(docs, items, 50)


def test_repeated_items_are_each_answered(tables):
    _, items, frame, asked = tables
    twice = lexical_search.ranked(frame, asked.where("item_id = 3").union(asked.where("item_id = 3")), 5)
    assert sorted(r["rank"] for r in twice.collect()) == [1, 1, 2, 2, 3, 3, 4, 4, 5, 5]


def test_empty_tables(tables):
    _, _, frame, asked = tables
    assert lexical_search.ranked(frame.limit(0), asked).count() == 0
    assert lexical_search.ranked(frame, asked.limit(0)).count() == 0


def test_masks_group_documents_by_the_terms_they_hold():
    rng = np.random.default_rng(5)
    for terms_ in (1, 8, 64, 65, 200):
        present = rng.random((terms_, 300)) < 0.02
        first, group = lexical_search.masks_of(present)
        by_mask = {}
        for doc in range(300):
            by_mask.setdefault(present[:, doc].tobytes(), set()).add(int(group[doc]))
        assert all(len(groups) == 1 for groups in by_mask.values()) and len(by_mask) == len(first)
        assert all((present[:, first[g]] == present[:, doc]).all() for doc, g in enumerate(group))


def test_low_masks_are_never_evaluated():
    docs = 20_000
    impact = np.zeros((3, docs), np.int32)
    impact[0, ::2], impact[1, ::20], impact[2, ::400] = 500_000, 600_000, 700_000
    weights = np.array([10, 1000, 3000])
    found = lexical_search.Found(20)
    seen = lexical_search.search_slice(np.arange(3), weights, impact, impact.max(axis=1).astype(np.int64), np.arange(docs), np.ones(docs, bool), found)
    assert found.docs.tolist() == list(range(0, 20 * 400, 400)) and seen < docs / 10
