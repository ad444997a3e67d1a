"""The training-data operators on small frames: odd rows, brute force, round trips."""

from __future__ import annotations

import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from millrace.llm import (
    common, decontamination, fingerprints, html_text, language_id, line_dedup, near_dedup, pieces, quality, secret_scan, toxicity,
)

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
WORDS = [f"w{i}" for i in range(400)]


def words(rng, n):
    return " ".join(rng.choice(WORDS) for _ in range(n))


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls in every column, empty, blank and very long texts, repeated rows, an extra column with a used name."""
    rng = random.Random(4)
    long = words(rng, 30_000)
    rows = [(0, None, None, None, None), (None, "some text here to read now", "en", "s", 26), (1, "", "en", "s", 0), (2, " \n ", "en", "s", 3)]
    rows += [(3, long, "en", "s", len(long)), (4, long, "en", None, 1), (5, "a b", "en", "s", 3), (5, "a b", "en", "s", 3), (6, "x" * 3000, None, "s", 3000)]
    return spark.createDataFrame(rows, SCHEMA).withColumns({"rank": F.lit("given"), "score": F.lit("given")})


@pytest.fixture(scope="module")
def none(odd):
    return odd.limit(0)


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(i, i % 2, i % 2) for i in range(7)] + [(None, 1, None), (8, None, 1)], "doc_id long, quality int, toxic int")


@pytest.fixture(scope="module")
def benchmark(spark):
    return spark.createDataFrame([(1, "some text here to read"), (2, None), (3, ""), (None, "a b"), (4, "?!")], "item_id long, text string")


def test_odd_rows_and_empty_tables(odd, none, labels, benchmark):
    runs = {
        "toxicity": lambda d: toxicity.toxicity(d, labels),
        "language": language_id.identified,
        "lines": line_dedup.deduplicated,
        "near": near_dedup.near_duplicates,
        "pieces": pieces.tokens,
        "secrets": secret_scan.secrets,
        "prints": fingerprints.compared,
        "quality": lambda d: quality.quality(d, labels),
    }
    for name, run in runs.items():
        assert run(odd).count() == odd.count(), name
        assert run(none).count() == 0, name
    assert {(r.doc_id, r.item_id) for r in decontamination.contaminated(odd, benchmark).collect()} == {(None, 1), (5, None)}
    assert decontamination.contaminated(odd, benchmark.limit(0)).count() == decontamination.contaminated(none, benchmark).count() == 0


def sets_of(text):
    found = (text or "").encode().lower().split()
    return {tuple(found[i : i + 5]) for i in range(max(1, len(found) - 4))} if found else set()


def test_near_duplicates_against_all_pairs(spark):
    rng = random.Random(7)
    texts = []
    for _ in range(12):
        base = words(rng, rng.randint(3, 120)).split()
        for edits in (0, 0, 1, 2, 3, 5, 8):
            copy = list(base)
            for _ in range(edits):
                copy[rng.randrange(len(copy))] = rng.choice(WORDS)
            texts.append(" ".join(copy))
    rng.shuffle(texts)
    least = list(range(len(texts)))
    sets = [sets_of(t) for t in texts]
    for i in range(len(texts)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if 100 * both >= 75 * (len(sets[i]) + len(sets[j]) - both) and least[i] != least[j]:
                a, b = sorted((least[i], least[j]))
                least = [a if x == b else x for x in least]
    got = near_dedup.near_duplicates(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in got} == {i: (len(sets[i]), least[i], least[i] == i) for i in range(len(texts))}


def brute_edits(item, text):
    row = [0] * (len(text) + 1)
    for i, c in enumerate(item, 1):
        last, row = row, [i]
        for j, d in enumerate(text, 1):
            row.append(min(last[j] + 1, row[j - 1] + 1, last[j - 1] + (c != d)))
    return min(row)


def test_edit_distance_against_a_table():
    rng = random.Random(3)
    for _ in range(60):
        item = "".join(rng.choice("abc") for _ in range(rng.randint(1, 30)))
        text = "".join(rng.choice("abc") for _ in range(rng.randint(0, 60)))
        assert decontamination.Pattern(item, 0.1).best(text)[0] == brute_edits(item, text)


def test_contamination_within_the_budget(spark):
    rng = random.Random(5)
    item = words(rng, 40)
    noise = words(rng, 60)
    near = item.replace(item.split()[7], "zz", 1)
    far = " ".join(w if i % 2 else "zzz" for i, w in enumerate(item.split()))
    docs = [(1, f"{noise} {item.upper()}! {noise}"), (2, f"{noise}\n{near}\n{noise}"), (3, f"{noise} {far}"), (4, noise)]
    got = decontamination.contaminated(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame([(9, item)], "item_id long, text string")).collect()
    assert {(r.doc_id, r.item_id) for r in got} == {(1, 9), (2, 9)}
    first = next(r for r in got if r.doc_id == 1)
    assert docs[0][1][first.start : first.end].lower() == item and first.edits == 0


def test_repeated_phrases_with_edited_first_pieces():
    rng = random.Random(8)
    for _ in range(60):
        phrase = words(rng, rng.randint(5, 10))
        item = decontamination.normal(f"{phrase} {phrase} {words(rng, rng.randint(25, 60))} {phrase}")
        budget = int(len(item) * decontamination.ERROR_RATE)
        copy = list(item)
        for offset, piece in decontamination.pieces(item, budget):
            if offset <= len(phrase):
                copy[offset + rng.randrange(len(piece))] = "#"
        text = decontamination.normal(words(rng, 30)) + "".join(copy) + decontamination.normal(words(rng, 30))
        found = decontamination.occurrences(text, *decontamination._prepared((item,), decontamination.ERROR_RATE))
        least = brute_edits(item, text)
        assert (min(edits for _, edits, _, _ in found) if found else budget + 1) == min(least, budget + 1)


def test_lines_keep_first_copies_only(spark):
    run = "\n".join(" ".join(f"r{i}{j}" for j in range(20)) for i in range(3))
    docs = [(1, f"own one\n{run}\nend"), (2, f"{run}\nother own"), (3, "short\nshort\nshort"), (4, run), (5, None), (6, f"{run}\n{run}")]
    got = {r.doc_id: (r.text, r.removed_lines) for r in line_dedup.deduplicated(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert got == {1: (docs[0][1], 0), 2: ("other own", 3), 3: (docs[2][1], 0), 4: ("", 3), 5: (None, 0), 6: ("", 6)}
    kept = line_dedup.without_repeats(spark.createDataFrame([(i, t, None, None, 1) for i, t in docs], SCHEMA))
    assert {r.doc_id: r.n_chars for r in kept.collect()} == {1: 1, 2: len("other own"), 3: 1, 5: 1}


def test_base_spans_against_a_pattern(spark):
    texts = [
        'token=secret = longenough1 "API_KEY": \'abcdefgh\'', "password=short AKIA" + "A1" * 8 + " AKIAshort", "f" * 31 + " " + "0a" * 20,
        "\x01token=\x02" + "x" * 9 + " ü secret:  aaaaaaaaaa", "", None, "token==abcdefg passwd:=12345678",
    ]
    assign = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
    rules = [("assign", assign, lambda m: len(m[2]) >= 8), ("access", re.compile("AKIA[A-Z0-9]+"), lambda m: len(m[0]) >= 16), ("hex", re.compile("[0-9a-f]+"), lambda m: len(m[0]) >= 32)]
    got = secret_scan.secrets(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    for row in got:
        found = sorted((m.start(), k, f"{name}:{m.start()}:{m.end()}") for k, (name, rule, fits) in enumerate(rules) for m in rule.finditer(texts[row.doc_id] or "") if fits(m))
        assert row.base_sha256 == hashlib.sha256(",".join(f[2] for f in found).encode()).hexdigest(), texts[row.doc_id]


def test_random_strings_stand_out(spark):
    rng = random.Random(1)
    draw = lambda n: "".join(rng.choice("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789") for _ in range(n))
    samples = [(draw(40), True) for _ in range(300)] + [(w, False) for w in "reader_version2 configuration_of_the_station parallel_run reference_table1 internal_total".split()] * 200
    ratios = secret_scan.train(spark.createDataFrame(samples, "sample string, random boolean"))
    docs = [(1, f"see {draw(32)}7 there"), (2, "the configuration_of_the_station2 is internal_total_reference1")]
    got = {r.doc_id: r.spans for r in secret_scan.scanned(spark.createDataFrame(docs, "doc_id long, text string"), ratios).collect()}
    assert got[1].startswith("random:4:") and got[2] == ""


def test_random_strings_without_digits_and_rare_secrets(spark):
    rng = random.Random(2)
    draw = lambda n: "".join(rng.choice("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz") for _ in range(n))
    prose = "the configuration of station parallel internal reference total running characteristically internationalization".split()
    texts = {i: " ".join(rng.choice(prose) for _ in range(30)) for i in range(300)}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    late = [r[0] for r in docs.orderBy(F.xxhash64("doc_id")).select("doc_id").collect()][-8:]  # out of a blind sample's reach
    texts |= {i: f"{texts[i]}{''.join(f' token={draw(40)}' for _ in range(40))}" for i in late} | {i: f"{texts[i]} password=short" for i in range(300) if i not in late}
    samples = secret_scan.labelled_samples(spark.createDataFrame(list(texts.items()), "doc_id long, text string"), 20)
    assert {r["random"] for r in samples.collect()} == {True, False}
    keys = {i: draw(20) for i in range(1000, 1010)}
    texts |= {i: f"key {k} of internationalization/characteristically" for i, k in keys.items()}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = {r.doc_id: r.spans for r in secret_scan.scanned(docs, secret_scan.train(samples)).collect()}
    assert {i: got[i] for i in keys} == dict.fromkeys(keys, "random:4:24")
    assert all(("random" not in got[i]) for i in range(300))


def test_secret_scan_cuts_each_text_once(spark):
    places = [(f"{i:04d} ", f"{'Ab9' * 6}{i:04d}") for i in range(300)]
    text = " ".join(a + b for a, b in places) + " ToKeN: " + "x" * 9 + " AKIA" + "B" * 12 + " " + "0f" * 16
    docs = spark.createDataFrame([(1, text), (2, "tokens only"), (3, None)], "doc_id long, text string")
    rows = secret_scan.scanned(docs, [1.0] * secret_scan.SYMBOLS**2)
    assert rows._jdf.queryExecution().optimizedPlan().toString().count("regexp_replace(") == len(secret_scan.KINDS) + 1
    base = {"assign": "ToKeN: " + "x" * 9, "access": "AKIA" + "B" * 12, "hex": "0f" * 16}
    spans = [f"random:{text.index(b)}:{text.index(b) + len(b)}" for _, b in places]
    spans += [f"{kind}:{text.index(found)}:{text.index(found) + len(found)}" for kind, found in base.items()]
    assert {r.doc_id: r.spans for r in rows.collect()} == {1: ",".join(spans), 2: "", 3: ""}
    samples = spark.createDataFrame([(1, text), (2, "ordinary words of a text")], "doc_id long, text string")
    got = sorted((r["random"], r["sample"]) for r in secret_scan.labelled_samples(samples).collect())
    assert got == [(False, "ordinary"), (False, "text"), (False, "words"), (True, "0f" * 16), (True, base["access"]), (True, "x" * 9)]


def _joins(monkeypatch, module, run):
    """Of each table that ``run`` settles in ``module``: its purpose, and which joins its plan holds."""
    seen, settle = {}, module.settle

    def spy(df, purpose):
        plan = df._jdf.queryExecution().executedPlan().toString()
        seen.setdefault(purpose, set()).update(re.findall(r"(\w+Join) ", plan.replace("(skew=true)", "")))
        return settle(df, purpose)

    monkeypatch.setattr(module, "settle", spy)
    rows = [tuple(r) for r in run().collect()]
    return seen, rows


def test_near_duplicates_broadcast_no_growing_table(spark, monkeypatch):
    rng = random.Random(4)
    base = [" ".join(f"w{rng.randrange(10**6)}" for _ in range(60)) for _ in range(12)]
    docs = [(10 * i + k, text if k < 2 else f"{text} and one more end {k}") for i, text in enumerate(base) for k in range(3)] + [(500, None)]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    monkeypatch.setattr(common, "FEW", 0, raising=False)
    seen, rows = _joins(monkeypatch, near_dedup, lambda: near_dedup.near_duplicates(frame).select("doc_id", "component_id"))
    assert sorted(rows) == sorted((i, i // 10 * 10) for i, _ in docs)
    for purpose in ("near-buckets", "near-stars", "near-across"):
        assert seen[purpose] == {"SortMergeJoin"}, purpose


def test_line_dedup_broadcasts_no_growing_table(spark, monkeypatch):
    run = "\n".join(" ".join(f"r{i}x{j}" for j in range(20)) for i in range(6))
    docs = [(i, f"own {i}\n{run}\nend {i}") for i in range(8)] + [(8, None)]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    seen, rows = _joins(monkeypatch, line_dedup, lambda: line_dedup.deduplicated(frame))
    assert sorted(rows) == [(0, docs[0][1], 0), *((i, f"own {i}\nend {i}", 6) for i in range(1, 8)), (8, None, 0)]
    for purpose in ("line-islands", "line-places", "line-named", "line-spans"):
        assert seen[purpose] == {"SortMergeJoin"}, purpose


def test_pieces_match_the_library(spark):
    sentencepiece = pytest.importorskip("sentencepiece")
    model = pieces.read_model()
    library = sentencepiece.SentencePieceProcessor(model_file=pieces.MODEL)
    texts = ["Hello, world", "  two  blanks ", "日本語 😀é́", "a" * 700, "x\n\ty", "<s> </s>", "", "Straße über"]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    for frequent in (3, pieces.FREQUENT):
        got = {r.doc_id: r.ids for r in pieces.encoded(rows, model, frequent).collect()}
        assert got == {i: library.encode(t) for i, t in enumerate(texts)}
    assert all(r.round_trip for r in pieces.tokens(rows).collect())


def test_units_are_cut_once_and_folded_alike(spark, monkeypatch):
    sentencepiece = pytest.importorskip("sentencepiece")
    model = pieces.read_model()
    library = sentencepiece.SentencePieceProcessor(model_file=pieces.MODEL)
    rng = random.Random(6)
    letters = ["the", "tion", "er", "in", " ", " ", "é", "日", "▁", "x", "\n", "😀", "  ", "th"]
    texts = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 60))) for _ in range(60)] + ["the" * 300, None, "the" * 300, ""]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)] + [(None, "other " * 3), (0, texts[0])], "doc_id long, text string").repartition(3)
    monkeypatch.setattr(pieces, "SAMPLE", 4)
    monkeypatch.setattr(pieces, "SLICE", 200)
    for frequent in (0, 5, pieces.FREQUENT):
        got = pieces.encoded(docs, model, frequent).collect()
        assert len(got) == docs.count() and all(r.ids == library.encode(r.text or "") for r in got)
    plan = pieces.encoded_units(pieces.vocabulary(docs, model), model)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("MapInArrow") == 2 and "Union" not in plan  # one scan that cuts, one that folds


def test_viterbi_fold_against_all_paths(spark):
    table = [("▁", 300, -3.0), ("a", 301, -2.0), ("b", 302, -2.5), ("ab", 303, -3.9), ("▁a", 304, -4.0), ("ba", 305, -4.6), ("aba", 306, -5.0)]
    model = pieces.Model(table, 3, True)

    def best(unit):
        if not unit:
            return 0.0, []
        options = [(model.ids[unit[:n]][1] + best(unit[n:])[0], [model.ids[unit[:n]][0], *best(unit[n:])[1]]) for n in range(1, len(unit) + 1) if unit[:n] in model.ids]
        return max(options)

    units = ["▁abab", "▁aba", "ba", "▁bb"]
    rows = spark.createDataFrame([(u, 1) for u in units], "unit string, n long").groupBy("unit").agg(F.sum("n").alias("n"))
    got = {r.unit: r.ids for r in pieces.encoded_units(rows, model).collect()}
    for unit in units:
        score = sum(s for i in got[unit] for _, j, s in table if i == j)
        assert score == pytest.approx(best(unit)[0]) and pieces.long_ids(unit, model) == got[unit]


def test_main_text(spark):
    def page(i, body):
        return f"<html><head><title>t {i}</title><script>var a='</p>';</script></head><body><nav><a>menu</a></nav><article><h1>Head {i}</h1>{body}</article><div class='comments'><p>me too</p></div><footer>&copy; x</footer></body></html>"

    pages = [(i, f"http://h.org/{i}", page(i, f"<p>One &amp; two\n  {i}<p><b>bold<br>next</p><aside>more</aside><div class='ad'>buy</div>")) for i in range(4)]
    pages += [(9, None, None), (10, "http://h.org/x", ""), (11, "http://h.org/y", "<p>plain &lt;b&gt;"), (3, "http://h.org/3", pages[3][2])]
    got = html_text.main_texts(spark.createDataFrame(pages, "page_id long, url string, html string")).collect()
    texts = {r.page_id: r.text for r in got}
    assert len(got) == 8 and texts[9] == texts[10] == ""
    assert all(texts[i] == f"Head {i}\nOne & two {i}\nbold next" for i in range(4)) and texts[11] == "plain <b>"
    assert html_text.main_texts(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def test_templates_of_a_host(spark):
    """Constant text under unlisted names, listed parts of names on body and article, and a template on a fifth of the pages."""
    plain = "<body><div class='xq'><p>Sign up today</p></div><div class='story'><p>Tale {0} goes</p><p>on for {0} nights</p></div></body>"
    listed = "<body class='has-sidebar postid-{0}'><article class='post no-comments'><p>News {0}</p><div class='xr'>Tell a friend</div></article></body>"
    rare = "<body><section id='r{0}' class='deep'><h2>Rare {0}</h2><p>its own text of {0}</p></section><div class='zz'>n {0}</div><div class='xs'>Only here</div></body>"
    kinds = [plain] * 8 + [listed] * 8 + [rare] * 4
    pages = [(i, f"http://t.org/{i}", kind.format(f"a{i}")) for i, kind in enumerate(kinds)]
    pages.append((20, "http://one.org/", "<body class='has-sidebar'><div class='sidebar'>all there is</div></body>"))
    got = {r.page_id: r.text for r in html_text.main_texts(spark.createDataFrame(pages, "page_id long, url string, html string")).collect()}
    want = {i: f"Tale a{i} goes\non for a{i} nights" for i in range(8)} | {i: f"News a{i}" for i in range(8, 16)}
    assert got == want | {i: f"Rare a{i}\nits own text of a{i}" for i in range(16, 20)} | {20: "all there is"}


def test_fingerprints_estimate_weighted_jaccard():
    rng, draws, off = random.Random(2), fingerprints.Draws(), []
    for _ in range(40):
        x, y = words(rng, 200), words(rng, 100)
        y = y + " " + " ".join(x.split()[:150])
        a, b = ({w: t.split().count(w) for w in t.split()} for t in (x, y))
        exact = sum(min(a.get(w, 0), b.get(w, 0)) for w in a | b) / sum(max(a.get(w, 0), b.get(w, 0)) for w in a | b)
        off.append(fingerprints.likeness(fingerprints.signature(x, draws), fingerprints.signature(y, draws)) - exact)
    assert abs(np.mean(off)) < 0.03 and np.std(off) < 0.1


def test_known_single_words_are_not_drawn_again(monkeypatch):
    rng = random.Random(3)
    texts = [" ".join(rng.choice(WORDS) for _ in range(n)) for n in (1, 5, 50, 700)]
    draws = fingerprints.Draws()
    for text in texts:
        counts = {w: text.split().count(w) for w in text.split()}
        names = sorted(counts)
        at = draws.of(names)
        r, ln_c, b = draws.values[:3, at]
        t = np.floor(np.log(np.array([counts[w] for w in names], np.float32))[:, None] / r + b)
        best = (ln_c - r * (t - b) - r).argmin(axis=0)
        step = t[best, np.arange(fingerprints.SAMPLES)].astype(np.uint64)
        drawn = fingerprints._stirred(draws.hashes[at][best] ^ (step * np.uint64(0x9E3779B97F4A7C15) + fingerprints._SEEDS[0]))
        assert (fingerprints.signature(text, draws) == (drawn >> np.uint64(40)).astype(np.uint16)).all()
    own = fingerprints.signature("w1 w2 w3", draws)
    monkeypatch.setattr(fingerprints, "_orders", None)
    assert (fingerprints.signature("w3 W1 w2", draws) == own).all()


def test_words_of_several_texts_stay_when_the_table_is_full(monkeypatch):
    drawn, hashed = [], fingerprints.xxhash.xxh3_64_intdigest
    texts = [f"The land {'land ' * (i % 3)}of " + " ".join(f"x{i * 9 + k}" for k in range(9)) for i in range(60)]
    want = [fingerprints.signature(t, fingerprints.Draws()) for t in texts]
    monkeypatch.setattr(fingerprints.xxhash, "xxh3_64_intdigest", lambda w: (drawn.append(w), hashed(w))[1])
    monkeypatch.setattr(fingerprints, "KNOWN_WORDS", 40)
    draws = fingerprints.Draws()
    assert all((fingerprints.signature(t, draws) == w).all() for t, w in zip(texts, want))
    assert len(draws.rows) <= 40 and drawn.count(b"the") == drawn.count(b"land") == drawn.count(b"of") == 1
    full = [f"y{k}" for k in range(40)]  # as many as there is room for
    for _ in range(4):
        assert draws.hashes[draws.of(full)].tolist() == [hashed(w.encode()) for w in full]
    assert list(draws.rows) == full
    assert draws.of(["y3", "new", "y39"]).tolist() == [draws.rows[w] for w in ("y3", "new", "y39")] and len(draws.rows) == 22


@pytest.mark.parametrize("blocks", [1, 3, 8])
def test_edited_texts_take_the_next_document(spark, blocks):
    texts = {i * 3: words(random.Random(i), i + 1) for i in range(20)}
    got = fingerprints.compared(spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(5), blocks).collect()
    ids = sorted(texts)
    assert {r.doc_id: r.edited_sha256 for r in got} == {
        k: hashlib.sha256(fingerprints.edited(texts[k], texts[ids[(n + 1) % len(ids)]]).encode()).hexdigest() for n, k in enumerate(ids)
    }


def test_pairs_of_terms_count():
    rng = np.random.default_rng(1)
    lists, y = [], []
    for _ in range(600):
        insult, group = (int(x < 0.5) for x in rng.random(2))
        lists.append(np.array([1] * insult + [2] * group + [3 + int(rng.integers(50))], np.int64))
        y.append(float(insult and group))
    machine = toxicity.fit(lists, np.array(y))
    assert machine.score({1, 2}) > 0.9 and machine.score({1}) < 0.3 and machine.score({2}) < 0.3 and machine.score(set()) < 0.3


def test_quality_scans_in_many_tasks(spark, monkeypatch):
    plans = []
    settle = quality.settle
    monkeypatch.setattr(quality, "settle", lambda df, purpose: (plans.append(df._jdf.queryExecution().optimizedPlan().toString()), settle(df, purpose))[1])
    rows = [(("good words of prose " if i % 2 else "### $$$ ") * (i + 3), float(i % 2)) for i in range(40)]
    quality.train(spark.createDataFrame(rows, "text string, y double").repartition(8))
    assert len(plans) == 1 and "Repartition 1, false" not in plans[0]


def test_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    right = lambda df, told, guess: df.where("held_out").agg(F.avg((F.col(told) == F.col(guess)).cast("double"))).first()[0]
    assert right(language_id.identified(docs).join(docs.select("doc_id", "lang"), "doc_id"), "lang", "lang_pred") > 0.97
    assert right(toxicity.toxicity(docs, labels).join(labels, "doc_id"), "toxic", "predicted") > 0.9
    assert right(quality.quality(docs, labels).join(labels, "doc_id"), "quality", "predicted") > 0.9


def test_pipeline_stages(spark):
    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    result = corpus_pipeline.run(spark, folder).collect()
    ids = {r.doc_id for r in docs.collect()}
    assert 0 < len(result) <= len(ids) and {r.doc_id for r in result} <= ids and all(r.round_trip for r in result)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, docs, folder)
        assert after.columns == docs.columns and 0 < after.count() <= len(ids), name
