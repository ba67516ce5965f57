"""Corpus operators against plain versions, on small and odd input."""

import itertools
import math
import re
import struct
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

import corpus_pipeline
from shoptrail.llm import (
    bpe, jaccard_join, language, mixture, neighbours, quality_model, quality_rules, queries, substring_dedup, tokens_by_section, url_rules,
)

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint, score string"
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
LONG = " ".join(f"word{i % 700}x{i}" for i in range(30_000))
BASE = " ".join(f"term{i}" for i in range(60))
ODD = [
    (1, BASE, "en", "a"), (2, BASE, "en", "a"), (2, BASE, "en", "a"), (3, BASE + " more", None, None), (4, "", "de", "b"),
    (5, None, None, "b"), (None, "lone words\nhere and there", "fr", None), (6, " \t\n", "en", "c"), (7, "x", "en", "c"),
    (8, "héllo wörld 日本語 \U0001f600\n\n\n  end  ", "de", "a"), (9, LONG, "en", "b"),
    (10, BASE.replace("term5 ", "other "), "en", "a"), (11, "Eins zwei.\n" + BASE + "\nlast", "de", "a"),
]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, lang, s, len(t or ""), "clash") for i, t, lang, s in ODD]
    return spark.createDataFrame(rows, DOCS).repartition(3)


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="module")
def encoding():
    ranks = bpe.parse_ranks(open(RANKS, "rb").read())
    return tiktoken.Encoding("t", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_bpe_equals_tiktoken_and_comes_back(docs, nothing, encoding):
    made = bpe.encode_column(docs, RANKS, public_tokenizers.PATTERN)
    rows = bpe.decode_column(made, RANKS, public_tokenizers.PATTERN).collect()
    assert len(rows) == len(ODD)
    for row in rows:
        ids = encoding.encode_ordinary(row.text or "")
        assert bytes(row.token_ids) == struct.pack(f"<{len(ids)}I", *ids)
        assert row.decoded == (row.text or "") and row.score == "clash"
    assert bpe.round_trip(nothing, RANKS, public_tokenizers.PATTERN).count() == 0


def test_bpe_on_random_pieces(encoding):
    codec = bpe.Codec(bpe.parse_ranks(open(RANKS, "rb").read()), public_tokenizers.PATTERN)
    rng = np.random.default_rng(3)
    for alphabet in ("ab", "etaoin ", "  \n\tx", "日本é ", "0123456789.,"):
        for size in rng.integers(1, 60, 200):
            text = "".join(rng.choice(list(alphabet), size))
            ids = encoding.encode_ordinary(text)
            assert codec.encode(text) == struct.pack(f"<{len(ids)}I", *ids)
            assert "".join(codec.decode(codec.encode(text))) == text


@pytest.mark.parametrize("bounds", [{}, {"MAX_MOVES": 300, "MAX_FITS": 500, "MAX_WORDS": 200, "GROUP_CHARS": 3_000, "LEARN_FROM": 1}])
def test_bpe_of_groups_equals_tiktoken(encoding, monkeypatch, bounds):
    for name, value in bounds.items():
        monkeypatch.setattr(bpe, name, value)
    codec = bpe.Codec(bpe.parse_ranks(open(RANKS, "rb").read()), public_tokenizers.PATTERN)
    rng = np.random.default_rng(5)
    parts = ["th", "er", "ing", "tion", "é", "ß", "日", "\n", ",", ".", "***", "'s", " ", "  ", "\t", "12", "\x00", "\U0001f600", "ы"]
    texts = ["".join(rng.choice(parts[: rng.integers(4, 20)] + [" "], rng.integers(1, 200))) for _ in range(500)]
    texts += [None, "", " ", "a ", "a" * 5_000, "é" * 70, *("th" * n for n in range(25, 40))]
    for _ in range(2):
        for text, ids in zip(texts, codec.encode_all(texts), strict=True):
            want = encoding.encode_ordinary(text or "")
            assert ids == struct.pack(f"<{len(want)}I", *want)


def test_moves_that_one_word_needs_are_not_worked_out():
    codec = bpe.Codec(bpe.parse_ranks(open(RANKS, "rb").read()), public_tokenizers.PATTERN)
    rng = np.random.default_rng(7)
    words = sorted({"".join(rng.choice(["th", "er", "ing", "tion", "ou", "bl", "an"], 6)) for _ in range(2_000)})
    codec.encode(" ".join(words))
    assert len(words) > 1_900 and len(codec.transducer.moves) < len(words) / 4


@pytest.mark.parametrize("rule", ["first", "last", "most"])
def test_sections_add_up(docs, encoding, rule):
    rows = tokens_by_section.count_by_section(docs, RANKS, public_tokenizers.PATTERN, rule).groupBy("doc_id").agg(F.sum("n_tokens").alias("n")).collect()
    for row in rows:
        texts = [t for i, t, *_ in ODD if i == row.doc_id]
        assert row.n == sum(len(encoding.encode_ordinary(t or "")) for t in texts)


def test_links_equal_brute_force(docs, nothing):
    rows = jaccard_join.similar(docs).collect()
    sets = [set(zip(*[w[k:] for k in range(5)])) if len(w) >= 5 else ({tuple(w)} if w else set()) for w in ((t or "").lower().split() for _, t, *_ in ODD)]
    links = Counter()
    for (i, a), (j, b) in itertools.permutations(enumerate(sets), 2):
        links[ODD[i][0], i] += bool(a and b) and len(a & b) >= 0.8 * len(a | b)
    assert sorted((r.doc_id or -1, r.n_links) for r in rows) == sorted((i or -1, n) for (i, _), n in links.items())
    assert {r.class_id for r in rows if r.doc_id in (1, 2, 3, 10, 11)} == {1}
    kept = sorted((r.doc_id or -1) for r in jaccard_join.keep_first(docs).collect())
    assert kept == [-1, 1, 4, 5, 6, 7, 8, 9]
    assert jaccard_join.similar(nothing).count() == 0


def test_big_bucket_is_counted_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(jaccard_join, "BLOCK", 4)
    words = [f"w{i}" for i in range(200)]
    rows = [(i, " ".join([*words[:i], f"new{i}", *words[i + 1 :]]), None, None, 0, "") for i in range(20)]
    found = jaccard_join.similar(spark.createDataFrame(rows, DOCS)).collect()
    assert {(r.class_id, r.n_links) for r in found} == {(0, 19)}


def test_substring_dedup(docs, nothing):
    rows = {r.doc_id: r for r in substring_dedup.deduplicate(docs).collect()}
    assert rows[1].text == BASE and rows[2].text == ""
    assert rows[11].text == "Eins zwei.\nlast" and [(x.start, x.end) for x in rows[11].removed] == [(11, 12 + len(BASE))]
    assert rows[5].text is None and rows[9].text == LONG
    # A passage of 60 words inside a longer sentence goes but for the piece it ends in.
    assert rows[3].text.endswith(" more") and len(rows[3].text.split()) <= 12
    assert substring_dedup.deduplicate(nothing).count() == 0


def test_repeated_lines_go_whatever_their_length(spark):
    rows = [
        (1, "Menu\nfirst text\nRead more\n\nAll rights reserved."),
        (2, "menu\nsecond text\n\n  READ  more\nMenu\nthird\n"),
        (3, "A line that says: read more\nsecond text here\nAll rights\nreserved.\nRead more"),
    ]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    got = {r.doc_id: (r.text, [(x.start, x.end) for x in r.removed]) for r in substring_dedup.deduplicate(frame).collect()}
    assert got[1] == (rows[0][1], [])
    assert got[2] == ("second text\n\nthird\n", [(0, 5), (18, 36)])
    assert got[3] == (rows[2][1][:-9], [(66, 75)])


def test_passages_of_short_closed_and_long_sentences_go(spark):
    shout = " ".join(f"LOUD{i}!!" for i in range(60))
    han = "".join(f"{chr(0x4E00 + 7 * i)}{chr(0x5E00 + 11 * i)}{chr(0x6E00 + 5 * i)}\u597d\u3002" for i in range(20))
    plain = [f"w{i}" for i in range(400)]
    long = " ".join(plain[100:180])
    rows = [
        (1, f"{shout} The first one goes on in its own way"),
        (2, f"Something else begins this line here. {shout}"),
        (3, " ".join(plain)),
        (4, f"{' '.join(f'a{i}' for i in range(70))} {long} {' '.join(f'b{i}' for i in range(70))}"),
        (5, f"\u4e00\u4e8c\u4e09\u56db\u4e94\u516d\u4e03\u516b\u4e5d\u5341\u3002{han}"),
        (6, f"\u7532\u4e59\u4e19\u4e01\u620a\u5df1\u5e9a\u8f9b\u58ec\u7678\u3002{han}\u5b50\u4e11\u5bc5\u536f\u8fb0\u5df3\u5348\u672a\u7533\u9149\u620c\u4ea5\u3002"),
        (7, "An\u00e9eux d\u00e8s.\n" * 40),
        (8, f"{shout.replace('LOUD30!! ', 'LOUD30!! Mine! ')}"),
    ]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    got = {r.doc_id: r.text for r in substring_dedup.deduplicate(frame).collect()}
    assert [got[i] for i in (1, 3, 5)] == [dict(rows)[i] for i in (1, 3, 5)]
    assert got[2] == "Something else begins this line here. "
    left = got[4].split()
    assert left[:70] == [f"a{i}" for i in range(70)] and left[-70:] == [f"b{i}" for i in range(70)] and len(left) <= 140 + 40
    assert got[6] == dict(rows)[6].replace(han, "") and got[7] == "An\u00e9eux d\u00e8s.\n"
    # A short sentence without an earlier copy stays between two repeats.
    assert got[8].split() == ["Mine!"]


def test_mixture(docs, nothing):
    rows = mixture.mix(docs).collect()
    assert len(rows) == len(ODD) and all(0 <= r.taken <= 3 * r.size for r in rows)
    assert sorted(map(tuple, rows), key=str) == sorted(map(tuple, mixture.mix(docs.repartition(5)).collect()), key=str)
    assert mixture.mix(nothing).count() == 0
    assert mixture.repeated(docs).selectExpr("size(split(text, ' ')) n").agg(F.sum("n")).first()[0] > 0


def test_targets_fill_by_weight(spark):
    sizes = [("a", 10), ("b", 1000), ("c", 1), (None, 500)]
    got = {r.source: r.target for r in mixture.targets(spark.createDataFrame(sizes, "source string, source_size bigint")).collect()}
    weights, total = {"a": 5, "b": 2, "c": 1, None: 5}, sum(n for _, n in sizes)
    want, open_ = {}, dict(sizes)
    while True:
        level = (total - sum(want.values())) / sum(weights[s] for s in open_)
        over = [s for s, n in open_.items() if level * weights[s] > 3 * n]
        if not over:
            break
        for s in over:
            want[s] = 3.0 * open_.pop(s)
    want |= {s: level * weights[s] for s in open_}
    assert got == pytest.approx(want)


def test_fit_lengths_is_exact():
    rng = np.random.default_rng(1)
    for _ in range(50):
        lengths = sorted(set(map(int, rng.integers(1, 40, 5))))
        counts = [int(x) for x in rng.integers(0, 4, len(lengths))]
        budget = int(rng.integers(0, 150))
        sums = {0}
        for n, c in zip(lengths, counts):
            sums = {s + n * k for s in sums for k in range(c + 1)}
        taken = mixture.fit_lengths(lengths, counts, budget)
        assert all(t <= c for t, c in zip(taken, counts))
        assert sum(n * t for n, t in zip(lengths, taken)) == max(s for s in sums if s <= budget)


def test_url_rules(spark):
    urls = [
        "http://example.org/es/1", "http://a.b.EXAMPLE.org/en/12?q", "https://notexample.org/es/", "http://org/x", "http://org", "x", None, "",
        "http://shop.com/de/#a", "http://com/fr/", "http://example.org/en/2", "http://example.org/en/2", "ftp://é.org/ß",
    ]
    pages = spark.createDataFrame([(i, u, "clash") for i, u in enumerate(urls)], "page_id int, url string, verdict string")
    rules = spark.createDataFrame(
        [("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "allow"), ("com", "/fr/", "allow"), ("com", "/de/", "block")],
        "host string, path string, verdict string",
    )
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in url_rules.judge(pages, rules).collect()}
    assert [got[i][2:] for i in range(len(urls))] == [
        ("example.org/es/", "block"), ("example.org/en/1", "allow"), ("org/", "allow"), ("org/", "allow"), (None, "allow"), (None, "allow"),
        (None, "allow"), (None, "allow"), ("com/de/", "block"), ("com/fr/", "allow"), ("org/", "allow"), ("org/", "allow"), ("org/", "allow"),
    ]
    assert got[1][:2] == ("a.b.example.org", "/en/12") and got[5][:2] == ("", "")
    assert url_rules.judge(pages.limit(0), rules).count() == 0 and url_rules.judge(pages, rules.limit(0)).where("rule is null").count() == len(urls)


def test_url_query_judges_by_the_rules_of_its_contract(spark, tmp_path):
    """allow org/, block example.org/es/, block example.org/en/1, allow com/fr/, block com/de/."""
    urls = ["http://x.org/a", "http://example.org/es/", "http://a.example.org/en/12", "http://example.org/en/2", "http://com/fr/", "http://x.com/de/", "http://x.com/"]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id int, url string")
    pages.write.parquet(f"{tmp_path}/pages.parquet")
    got = {r.page_id: (r.rule, r.verdict) for r in queries.op9_url_filters(spark, str(tmp_path)).collect()}
    assert [got[i] for i in range(len(urls))] == [
        ("org/", "allow"), ("example.org/es/", "block"), ("example.org/en/1", "block"), ("org/", "allow"), ("com/fr/", "allow"), ("com/de/", "block"),
        (None, "allow"),
    ]


def test_quality_measures(docs, spark, nothing):
    labels = spark.createDataFrame([(1, 1, 0), (None, None, 0)], "doc_id bigint, quality int, toxic int")
    rows = quality_rules.apply_rules(docs, labels).collect()
    text = {i: t or "" for i, t, *_ in ODD}
    for r in rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", text[r.doc_id])
        grams = [tuple(words[k : k + 3]) for k in range(len(words) - 2)]
        many, covered = Counter(grams), set()
        for k, g in enumerate(grams):
            covered |= {k, k + 1, k + 2} if many[g] > 1 else set()
        assert (r.n_words, r.word_chars, r.n_repeat_words) == (len(words), sum(map(len, words)), len(covered))
        assert r.base_failed == (len(words) < 50) and r.kept == (not r.base_failed)
    assert quality_rules.apply_rules(nothing, labels).count() == 0


def test_binomial_tail_and_certified_cutoffs(spark):
    frame = spark.createDataFrame([(k, n) for n in (1, 30, 2000) for k in (0, 1, 5, n)], "k bigint, n bigint")
    for r in frame.select("k", "n", quality_rules.binomial_tail(F.col("k"), F.col("n"), 0.01).alias("p")).collect():
        terms = ((math.lgamma(r.n + 1) - math.lgamma(i + 1) - math.lgamma(r.n - i + 1), i) for i in range(min(r.k, r.n) + 1))
        want = sum(math.exp(c + i * math.log(0.01) + (r.n - i) * math.log(0.99)) for c, i in terms)
        assert r.p == pytest.approx(want, rel=1e-9)
    shares = {name: 0.0 for name in quality_rules.RULES}
    rows = [(i, 1, False, 0.3 if i % 4 == 0 else 0.01) for i in range(8000)]
    measures = spark.createDataFrame(rows, "doc_id bigint, stratum int, base_failed boolean, symbol_share double")
    measures = measures.withColumns({k: F.lit(v) for k, v in shares.items() if k != "symbol_share"})
    labels = measures.select("doc_id", (F.col("symbol_share") < 0.1).cast("int").alias("quality"))
    found = quality_rules.certified_cutoffs(measures, labels).collect()
    assert [(r.stratum, r.rule) for r in found] == [(1, "symbol_share")] and 0.01 < found[0].cutoff < 0.3


def test_viterbi_is_the_best_path():
    rng = np.random.default_rng(2)
    sizes = [3, 0, 5, 1]
    scores = rng.normal(size=(sum(sizes), 3)).astype(np.float32) * 3
    ends = np.cumsum(sizes)
    labels = language.viterbi(scores, ends - sizes, ends, 1.5)
    for begin, end in zip(ends - sizes, ends):
        value = lambda path: sum(scores[begin + i, p] for i, p in enumerate(path)) - 1.5 * sum(a != b for a, b in zip(path, path[1:]))
        best = max((value(p) for p in itertools.product(range(3), repeat=end - begin)), default=0)
        assert value(list(labels[begin:end])) == pytest.approx(best, abs=1e-4)


def test_language_spans(spark, docs, nothing):
    rows = [("the cat and the dog went there with them", "en")] * 5 + [("der hund und die katze gehen nicht über straße", "de")] * 5
    model = language.learn(spark.createDataFrame(rows, "text string, lang string"))
    mixed = spark.createDataFrame([(1, "the dog and the cat, und die katze nicht der hund"), (2, None), (3, "12 !")], "doc_id int, text string")
    assert [(r.start, r.lang) for r in language.spans(mixed, model).orderBy("start").collect()] == [(0, "en"), (21, "de")]
    got = {r.doc_id: (r.lang_pred, r.score) for r in language.predict(mixed, model).collect()}
    assert got[2] == got[3] == ("und", 0.0) and 0 < got[1][1] < 1
    assert language.identify(docs).count() == len(ODD) and language.identify(nothing).count() == 0


def test_classifier_finds_shouting(spark, docs, nothing):
    rng = np.random.default_rng(4)
    text = lambda i: " ".join(rng.choice(["alpha", "beta", "gamma", "delta", "of", "the"], 90))
    rows = [(i, text(i).upper() + "!!" if i % 4 == 0 else text(i)) for i in range(400)]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string")
    labels = frame.selectExpr("doc_id", "IF(doc_id % 4 = 0, 0, 1) AS quality")
    held = quality_model.classify(frame, labels).where("held_out").collect()
    assert len(held) > 40 and all(r.predicted == (r.doc_id % 4 != 0) for r in held)
    assert quality_model.classify(docs, labels).count() == len(ODD)
    assert quality_model.classify(nothing, labels.limit(0)).count() == 0


def test_neighbours(spark):
    rng = np.random.default_rng(6)
    centres = rng.normal(size=(20, 16))
    points = (centres[rng.integers(0, 20, 600)] + 0.4 * rng.normal(size=(600, 16))).astype(np.float32)
    points[100:130] = points[100]
    rows = [(i, p.tolist()) for i, p in enumerate(points)] + [(1000, None), (1050, [0.0] * 16), (1100, [float("nan")] * 16)]
    frame = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>")
    got: dict = {}
    for r in neighbours.nearest(frame).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append(r.vec_id)
    assert set(got) == set(range(0, 600, 50))
    m = points.astype(float)
    unit = m / np.linalg.norm(m, axis=1)[:, None]
    hit = 0
    for q, found in got.items():
        near = np.round(unit @ unit[q], 12)
        near[q] = -9
        hit += len(set(np.lexsort((np.arange(600), -near))[:5]) & set(found))
    assert hit >= 0.9 * 5 * len(got) and got[100] == [101, 102, 103, 104, 105]
    assert neighbours.nearest(frame.limit(0)).count() == 0


def test_pipeline_on_given_tables(spark):
    rows = corpus_pipeline.run(spark, "/root/testdata/sf0.001")
    assert rows.columns == ["doc_id", "source", "n_tokens", "token_ids", "comes_back"] and rows.count() > 50
    assert rows.where("not comes_back").count() == 0


def test_words_are_scored_together_as_alone():
    rng = np.random.default_rng(3)
    model = language.Model(["a", "b", "c"], rng.normal(-5, 1, (language.CELLS, 3)).astype(np.float32), {"Latin": [0, 2], "Greek": [1]})
    texts = [["Haus", "ß", "İstanbul", "haus"], [], ["λόγος", "日本", "a" * 5_000], ["Haus"]]
    scores = language._Scores(model)
    got = np.concatenate([scores.of(texts[:2]), scores.of(texts[2:])])
    for word, row in zip([w for t in texts for w in t], got):
        codes = [2, *map(ord, word.lower()), 3]
        cells = [(a * 1_000_003 + b * 8_191 + c * 131) % language.CELLS for a, b, c in zip(codes, codes[1:], codes[2:])]
        plain = model.scores[cells].astype(float).sum(axis=0) * min(len(word), 8) / len(cells)
        allowed = model.scripts.get(language.script_of(word[0]), [0, 1, 2])
        plain = [x if i in allowed else plain.min() - 50 for i, x in enumerate(plain)]
        assert np.allclose(row, plain, rtol=1e-3)


def test_learning_reads_whole_texts_of_a_bounded_sample(spark):
    late = "x " * 30_000 + "zebra quagga okapi " * 50
    rows = [(i, late, "en") for i in range(40)] + [(100 + i, "der dachs im wald", "de") for i in range(3)] + [(None, None, "fr"), (7, "text", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = language.learn(docs, id_column="doc_id", per_language=5)
    assert model.languages == ["de", "en"]
    cells, _ = language._cells(["quagga"])
    assert (model.scores[cells, 1] > model.scores[cells, 0]).all()
