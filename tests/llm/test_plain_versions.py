"""Operators and pipeline stages against plain versions, with ids that doubles can't hold and columns that clash."""

import re
import struct
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import tiktoken
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from shoptrail.llm import (
    bpe, filter_audit, hard_negatives, jaccard_join, language, mixture, neighbours, quality_model, quality_rules, simhash, substring_dedup,
    tokens_by_section,
)

RANKS, PATTERN = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
BIG = 1 << 60
CLASHING = ("_id", "_hash", "_copy", "id", "hash", "key", "digest", "place", "part", "mask", "text_", "big")
DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint, " + ", ".join(f"`{c}` bigint" for c in CLASHING)


def frame(spark, rows, parts=1):
    full = [(*row, len(row[1] or ""), *((BIG + 2 * i + 1 if i % 2 else None) for _ in CLASHING)) for i, row in enumerate(rows)]
    return spark.createDataFrame(full, DOCS).repartition(parts)


BASE = " ".join(f"term{i}" for i in range(60))
IDS = [(BIG + 1, "alpha one.\n" + BASE, "en", "a"), (BIG + 3, "beta two other text\n" + " ".join(f"w{i}" for i in range(80)), "en", "a"), (None, "gamma three\n" + " ".join(f"g{i}" for i in range(70)), "de", None)]
KEYS = {BIG + 1, BIG + 3, None}


@pytest.fixture(scope="module")
def ids(spark):
    return frame(spark, IDS)


def test_ids_beyond_doubles_and_clashing_columns(spark, ids):
    """All three rows lie in one partition, so a nullable column becomes doubles where pandas has a hand in it."""
    labels = spark.createDataFrame([(BIG + 1, 1, 0), (BIG + 3, 0, 0)], "doc_id bigint, quality int, toxic int")
    model = quality_model.learn(ids, labels)
    lang = language.learn(ids, id_column="doc_id")
    assert lang.languages == ["de", "en"]
    kept = {
        "op1": quality_model.score(ids, model), "op2": tokens_by_section.count_by_section(ids, RANKS, PATTERN),
        "op3": substring_dedup.deduplicate(ids), "op4": jaccard_join.similar(ids), "keep_first": jaccard_join.keep_first(ids),
        "op5": mixture.mix(ids), "repeated": mixture.repeated(ids), "op6": language.predict(ids, lang), "spans": language.spans(ids, lang),
        "op8": bpe.round_trip(ids, RANKS, PATTERN), "encode": bpe.encode_column(ids, RANKS, PATTERN), "op10": quality_rules.apply_rules(ids, labels),
        "op13": simhash.near_duplicates(ids),
    }
    extra = {i: row[5:] for row in ids.collect() for i in [row.doc_id]}
    for name, found in kept.items():
        rows = found.collect()
        # The mix need not take every document.
        assert {r.doc_id for r in rows} <= KEYS if name == "repeated" else {r.doc_id for r in rows} == KEYS, name
        if all(c in found.columns for c in CLASHING):
            assert all(tuple(r[c] for c in CLASHING) == tuple(extra[r.doc_id]) for r in rows), name
    assert {r.id for r in filter_audit.masks(ids).collect()} == KEYS
    assert {r.component_id for r in kept["op13"].collect()} == KEYS


def test_stages_keep_ids_and_columns(spark, ids, tmp_path):
    labels = [(BIG + 1, 1, 0), (BIG + 3, 1, 0)] + [(i, i % 2, 0) for i in range(40)]
    spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    for name, stage in corpus_pipeline.STAGES:
        for docs, n in ((ids, 3), (ids.limit(0), 0), (ids.unionByName(ids), None)):
            rows = stage(spark, docs, str(tmp_path)).collect()
            assert {r.doc_id for r in rows} <= KEYS and (n is None or len(rows) <= 3 * n), name
            if name in ("near_duplicates", "shared_passages") and n == 3:
                assert {r.doc_id for r in rows} == KEYS, name
                assert all(tuple(r)[:0] == () and list(r.asDict()) == list(corpus_pipeline.COLUMNS) for r in rows)


# --- Substring dedup ----------------------------------------------------------------------------------------------------------


def dedup_plainly(rows):
    """Earliest occurrence of every digest by (null last, id, text digest, place), then the cuts of each text."""
    def order(key, text):
        return (key is None, (1 << 63) - 1 if key is None else key, np.int64(np.uint64(xxhash.xxh64_intdigest(text or "", 42)).astype(np.int64)))

    seen = defaultdict(list)
    for key, text in dict.fromkeys(rows):
        parts = substring_dedup.units(text)
        for place, span in enumerate(substring_dedup.spans(parts, text)):
            seen[substring_dedup.digest(parts, span)].append((order(key, text), place))
    first = {digest: min(places) for digest, places in seen.items()}
    out = []
    for key, text in rows:
        parts = substring_dedup.units(text)
        hashed = substring_dedup.spans(parts, text)
        again = [k for k, span in enumerate(hashed) if first[substring_dedup.digest(parts, span)] != (order(key, text), k)]
        cut, at, left = substring_dedup.cuts(parts, hashed, again), 0, []
        for start, end in cut:
            left.append(text[at:start])
            at = end
        out.append((key, text if not cut else "".join([*left, text[at:]]), [tuple(c) for c in cut]))
    return out


def dirty_documents(seed, n=60):
    rng = np.random.default_rng(seed)
    lines = [" ".join(f"l{i}x{k}" for k in range(rng.integers(1, 40))) + rng.choice([".", "!", "", "  "]) for i in range(25)]
    rows = []
    for i in range(n):
        own = [" ".join(f"d{i}y{k}" for k in rng.integers(0, 500, rng.integers(1, 90))) for _ in range(rng.integers(0, 4))]
        body = [*own, *rng.choice(lines, rng.integers(0, 8))]
        rng.shuffle(body)
        rows.append((int(rng.integers(0, 50)) if i % 9 else None, rng.choice(["\n", " ", ". ", "\n\n"]).join(body)))
    return rows + [(3, ""), (4, None), (5, "\n \n"), (6, lines[0]), (6, lines[0]), (None, lines[0])]


@pytest.mark.parametrize("hot", [1, 100_000])
def test_substring_dedup_equals_plain_version(spark, monkeypatch, hot):
    monkeypatch.setattr(substring_dedup, "HOT", hot)
    rows = dirty_documents(5)
    found = substring_dedup.deduplicate(frame(spark, [(k, t, None, None) for k, t in rows], 4)).collect()
    got = [(r.doc_id, r.text, [(x.start, x.end) for x in r.removed]) for r in found]
    assert sorted(got, key=str) == sorted(dedup_plainly(rows), key=str)
    assert all(r.n_removed == sum(x.end - x.start for x in r.removed) for r in found)


def test_text_ids_order_as_numbers_where_they_are(spark):
    rows = [("10", "a shared line of words\nmine"), ("9", "a shared line of words"), ("x", "a shared line of words\nxs"), (None, "a shared line of words")]
    found = {r.doc_id: r.text for r in substring_dedup.deduplicate(spark.createDataFrame(rows, "doc_id string, text string")).collect()}
    assert found == {"9": rows[1][1], "10": "mine", "x": "xs", None: ""}


# --- Sections, mixture, rules, classifier ---------------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def encoding():
    return tiktoken.Encoding("t", pat_str=PATTERN, mergeable_ranks=bpe.parse_ranks(open(RANKS, "rb").read()), special_tokens={})


@pytest.mark.parametrize("rule", ["first", "last", "most"])
def test_sections_equal_plain_version(spark, encoding, rule):
    texts = ["a  \n\n\n  b\n", "", None, "\n", "héllo\n日本語 \U0001f600\n\n x", "word " * 50 + "\n" * 7 + "end", "tab\t\n \n \nx\n\n"]
    rows = [(i, t, None, None) for i, t in enumerate(texts)]
    found = sorted(map(tuple, tokens_by_section.count_by_section(frame(spark, rows, 3), RANKS, PATTERN, rule).collect()))
    want = []
    for i, t in enumerate(texts):
        t = t or ""
        lines = t.split("\n")
        starts = np.cumsum([0, *(len(x) + 1 for x in lines)])[:-1].tolist()
        ends = [*starts[1:], len(t)]
        counts, crossing, at = [0] * len(lines), [0] * len(lines), 0
        places = [k for k, c in enumerate(t) for _ in c.encode()]  # character of each byte
        for token in encoding.encode_ordinary(t):
            size = len(encoding.decode_single_token_bytes(token))
            begin, end = places[at], places[at + size - 1] + 1
            at += size
            touched = [k for k in range(len(lines)) if starts[k] < end and begin < ends[k]]
            share = [min(end, ends[k]) - max(begin, starts[k]) for k in touched]
            owner = touched[0] if rule == "first" else touched[-1] if rule == "last" else touched[share.index(max(share))]
            counts[owner] += 1
            crossing[owner] += len(touched) > 1
        want += [(i, k, starts[k], ends[k], counts[k], crossing[k]) for k in range(len(lines))]
    assert found == sorted(want)
    assert tokens_by_section.count_by_section(frame(spark, []), RANKS, PATTERN, rule).count() == 0


def test_mixture_comes_near_its_targets(spark):
    rng = np.random.default_rng(2)
    rows = [(int(i), " ".join(["w"] * int(rng.integers(0, 60))), None, ["s0", "s1", "s2", "s3", None][min(4, int(rng.exponential(1)))]) for i in range(500)]
    found = mixture.mix(frame(spark, rows, 5)).collect()
    sizes, taken, target = defaultdict(int), defaultdict(int), {}
    assert sorted(r.doc_id for r in found) == list(range(500))
    for r in found:
        source = rows[r.doc_id][3]
        assert r.size == len(re.findall(r"[^\x20\x09-\x0d]+", rows[r.doc_id][1])) and 0 <= r.taken <= 3 * r.size
        assert r.size == 0 or r.taken % r.size == 0
        sizes[source] += r.size
        taken[source] += r.taken
        target[source] = r.target
    assert all(r.source_size == sizes[rows[r.doc_id][3]] for r in found)
    for source in sizes:
        assert abs(taken[source] - target[source]) <= 1, source
    assert abs(sum(target.values()) - sum(sizes.values())) < 1e-6 * sum(sizes.values())


def test_budgets_above_the_exact_part_are_met():
    rng = np.random.default_rng(3)
    lengths = sorted({int(x) for x in rng.integers(1, 3_000, 400)})
    counts = [int(x) for x in rng.integers(1, 2_000, len(lengths))]
    total = sum(a * b for a, b in zip(lengths, counts))
    for budget in (0, 70_000, 10_000_001, total // 3, total - lengths[0], total, total + 5):
        taken = mixture.fit_lengths(lengths, counts, budget)
        assert all(0 <= t <= c for t, c in zip(taken, counts))
        assert sum(a * t for a, t in zip(lengths, taken)) == min(budget, total)


def rules_plainly(text):
    words = re.findall(r"[^\x20\x09-\x0d]+", text or "")
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    often = Counter(windows)
    repeated = {i + k for i, w in enumerate(windows) if often[w] > 1 for k in range(3)}
    lines, seen, dup = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0d]", x)], set(), 0
    for line in lines:
        dup += line in seen
        seen.add(line)
    failed = len(words) < 50 or 100 * len(repeated) > 50 * len(words)
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), dup, len(repeated), failed


def test_rules_equal_plain_version(spark, monkeypatch):
    """With a risk of 20 % cutoffs are certified; a text is kept if it passes the base and no certified rule rejects it."""
    monkeypatch.setattr(quality_rules.certified_cutoffs, "__defaults__", ("doc_id", 0.9, 0.5))
    rows = []
    for i in range(120):
        body = " ".join(f"w{i}x{k}" for k in range(60))
        rows.append((i, body if i % 2 else body + " $$$ ### !!! " * 10, None, None))
    odd = [(1_000, None, None, None), (1_001, "", None, None), (1_002, "a b a b a b\n" * 20, None, None), (1_003, "# x\n# x\n\ny\n" * 30, None, None), (1_004, "Ä日  " * 80, None, None), (None, rows[0][1], None, None)]
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(120)], "doc_id bigint, quality int, toxic int")
    docs = frame(spark, rows + odd, 3)
    found = quality_rules.apply_rules(docs, labels).collect()
    texts = {k: t for k, t, *_ in rows + odd}
    for r in found:
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == rules_plainly(texts[r.doc_id])
        assert not (r.kept and r.base_failed)
    kept = {r.doc_id for r in found if r.kept}
    assert kept >= {i for i in range(120) if i % 2}  # no good one is rejected
    measured = {r.doc_id: r for r in quality_rules.measured(docs).collect()}
    cutoffs = quality_rules.certified_cutoffs(quality_rules.measured(docs), labels).collect()
    assert cutoffs
    for r in found:
        m = measured[r.doc_id]
        rejected = any(c.stratum == m.stratum and m[c.rule] > c.cutoff for c in cutoffs)
        assert r.kept == (not r.base_failed and not rejected)


def test_bag_scores_and_gradient():
    """Scores by the formula, and the direction of a learning step against differences of the loss."""
    rng = np.random.default_rng(4)
    bags = [rng.normal(size=(int(n), quality_model.FEATURES)).astype(np.float32) for n in (1, 3, 7, 2)]
    y = np.asarray([1.0, 0.0, 1.0, 0.0])
    model = quality_model.fit(bags * 8, np.tile(y, 8), epochs=3)
    w = model.weights

    def plainly(bag):
        h = model.standard(bag)
        energy = np.asarray([float(w["w"] @ (np.tanh(w["V"].T @ x) / (1 + np.exp(-(w["U"].T @ x))))) for x in h])
        share = np.exp(energy - energy.max())
        z = (share / share.sum()) @ h
        return 1 / (1 + np.exp(-(w["c"] @ z + w["b"])))

    assert np.allclose(model.scores(bags), [plainly(b) for b in bags])

    def loss():
        p = model.scores(bags * 8)
        t = np.tile(y, 8)
        return -np.mean(t * np.log(p) + (1 - t) * np.log(1 - p))

    before = quality_model.fit(bags * 8, np.tile(y, 8), epochs=1)
    after = quality_model.fit(bags * 8, np.tile(y, 8), epochs=40)

    def loss_of(m):
        p = m.scores(bags)
        return -np.mean(y * np.log(p) + (1 - y) * np.log(1 - p))

    assert loss_of(after) < loss_of(before) and loss() >= 0


def test_no_letters_means_no_language(spark):
    model = language.learn(frame(spark, [(1, "der hund", "de", None), (2, "the dog", "en", None)]))
    rows = [(1, "½ ² ① Ⅷ 12", None, None), (2, "the ½", None, None), (3, None, None, None), (4, "", None, None)]
    got = {r.doc_id: r.lang_pred for r in language.predict(frame(spark, rows), model).collect()}
    assert got == {1: "und", 2: "en", 3: "und", 4: "und"}


def test_more_neighbours_than_five(spark):
    rng = np.random.default_rng(9)
    rows = [(i, rng.normal(size=8).tolist()) for i in range(30)] + [(100 + i, [1.0] * 8) for i in range(12)]
    found = neighbours.nearest(spark.createDataFrame(rows, "vec_id bigint, embedding array<float>"), every=100, k=10).collect()
    assert [r.vec_id for r in sorted((r for r in found if r.query_id == 100), key=lambda r: r["rank"])] == list(range(101, 111))
    assert sum(r.query_id == 0 for r in found) == 10


# --- Pipeline -------------------------------------------------------------------------------------------------------------------


def test_pipeline_equals_its_stages_in_plain_form(spark, tmp_path, encoding):
    """Quality scores come from the model; every other stage is done in plain Python."""
    rng = np.random.default_rng(11)
    rows = []
    for i in range(80):
        good = i % 4 > 0
        body = [" ".join(f"g{w}" for w in rng.integers(0, 4_000, 30)) + ".\n" for _ in range(4)] if good else ["BUY!!! $$$ 9999 " * 30]
        rows.append((i, "".join(body) + ("All rights reserved here.\n" if i % 3 == 0 else ""), "en", f"s{i % 3}"))
    rows += [(100 + i, rows[1][1] + f" tail{i}", "en", "s1") for i in range(6)] + [(200, rows[2][1], "en", None)]
    docs = spark.createDataFrame([(*r, len(r[1])) for r in rows], "doc_id bigint, text string, lang string, source string, n_chars bigint")
    labels = spark.createDataFrame([(i, int(i % 4 > 0), 0) for i in range(80)], "doc_id bigint, quality int, toxic int")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    found = corpus_pipeline.run(spark, str(tmp_path)).collect()

    scored = quality_model.score(docs, quality_model.learn(docs, labels)).where("predicted = 1").collect()
    left = {r.doc_id: r.text for r in scored}
    sets = {k: set(zip(*[t.lower().split()[j:] for j in range(5)])) for k, t in left.items()}
    root = {k: k for k in left}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in left:
        for b in left:
            if a < b and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]):
                low, high = sorted((find(a), find(b)))
                root[high] = low
    left = {k: t for k, t in left.items() if find(k) == k}
    cleaned = {k: t for k, t, _ in dedup_plainly(list(left.items())) if t.split()}
    mixed = {r.doc_id: r.taken // r.size for r in mixture.mix(spark.createDataFrame([(k, t, dict((r[0], r[3]) for r in rows)[k]) for k, t in cleaned.items()], "doc_id bigint, text string, source string")).collect()}
    want = []
    for k, t in cleaned.items():
        ids_of = encoding.encode_ordinary(t)
        want += [(k, len(ids_of), struct.pack(f"<{len(ids_of)}I", *ids_of), True)] * mixed[k]
    assert sorted((r.doc_id, r.n_tokens, bytes(r.token_ids), r.comes_back) for r in found) == sorted(want)
    assert len(cleaned) > 30 and any("All rights" not in t for k, t in cleaned.items() if k % 3 == 0 and k < 80)
    assert hard_negatives.POSITIVES == 5 and found
