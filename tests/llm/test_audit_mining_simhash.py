"""Filter audit, hard negatives and SimHash against plain versions, on odd and hot input."""

from collections import defaultdict
from itertools import permutations

import numpy as np
import pytest
import xxhash

from shoptrail.llm import filter_audit, hard_negatives, queries, simhash

DOCS = "doc_id bigint, text string, source string, part int, mask string, n string, id string, body string, range string, fp string"
LONG = " ".join(f"word{i % 900}" for i in range(40_000))
PROSE = " ".join(f"term{i}" for i in range(220))
BIG = 1 << 60


def docs_of(spark, rows, parts=4):
    return spark.createDataFrame([(*row, 0, "x", None, "y", "z", "w", "v") for row in rows], DOCS).repartition(parts)


AUDITED = [
    (5, PROSE, "a"), (3, PROSE, "b"), (3, PROSE, "b"), (9, PROSE, None), (None, PROSE, "a"), (None, PROSE, "a"), (1, "", "a"), (2, None, "a"),
    (4, " \t\n", ""), (6, "x", "a"), (7, "x", "c"), (8, LONG, "a"), (10, LONG, "b"), (11, LONG + "!", "b"), (12, "A" * 300, "c"),
    (13, "same " * 250, "c"), (14, PROSE + " #", "c"), (15, "Ä é 日本 \U0001f600 " * 80, "c"), (16, "ABC def", "a"), (17, "\xa0x y", "a"),
    (BIG + 1, "x", "a"), (BIG + 3, "only", "a"), (18, "x", None), (19, "xy", None), (20, "xyz", None), (21, "日", "a"), (22, "日本", "a"),
]
MARKS = [(5, 1, 0), (5, 0, 1), (3, 0, 1), (10, 1, 1), (7, None, 1), (None, 1, 1), (99, 1, 1), (BIG + 1, 1, 0), (1, 1, None)]


def audit_plainly(rows, marks):
    good = {i for i, q, _ in marks if q == 1 and i is not None}
    toxic = {i for i, _, t in marks if t == 1 and i is not None}
    least = {}
    for key, text, _ in rows:
        if key is not None:
            least[text or ""] = min(key, least.get(text or "", key))
    failed = []
    for key, text, source in rows:
        text, words = text or "", (text or "").encode().split()
        fails = set()
        if len(words) < 200:
            fails.add("A")
        if 100 * len(set(words)) < 50 * len(words):
            fails.add("B")
        if 100 * sum("A" <= c <= "Z" for c in text) > 2 * len(text):
            fails.add("C")
        if set(text) & set("#$%&*|"):
            fails.add("D")
        if key is not None and least[text] < key:
            fails.add("E")
        failed.append((source or "", fails, key in good, key in toxic))
    out, removed_by = {}, defaultdict(int)
    for order in map("".join, permutations("ABCDE")):
        for part in {f[0] for f in failed}:
            for step, letter in enumerate(order, 1):
                mine = [f for f in failed if f[0] == part]
                left = [f for f in mine if not f[1] & set(order[: step - 1])]
                gone = [f for f in left if letter in f[1]]
                out[part, order, step] = [
                    len(left) - len(gone), len(gone), sum(letter in f[1] for f in mine) - len(gone),
                    sum(f[1] == {letter} for f in mine), sum(f[2] for f in gone), sum(f[3] for f in gone),
                ]
                removed_by[part, letter] += len(gone)
    return {(*k, *v, removed_by[k[0], k[1][k[2] - 1]]) for k, v in out.items()}


@pytest.mark.parametrize("range_bytes", [1, 300, 1 << 20])
def test_audit_equals_plain_version(spark, range_bytes, monkeypatch):
    monkeypatch.setattr(filter_audit.adaptive_prefixes, "__defaults__", (range_bytes,))
    monkeypatch.setattr(filter_audit.masks, "__defaults__", ("text", "source", "doc_id", range_bytes))
    labels = spark.createDataFrame(MARKS, "doc_id bigint, quality int, toxic int")
    rows = filter_audit.audit(docs_of(spark, AUDITED), labels).collect()
    assert {tuple(r) for r in rows} == audit_plainly(AUDITED, MARKS) and len(rows) == 4 * 600


def test_audit_of_nothing(spark):
    labels = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    assert filter_audit.audit(docs_of(spark, []), labels).count() == 0
    assert filter_audit.audit(docs_of(spark, AUDITED[:2]), labels).count() == 1_200


def test_ranges_split_where_texts_first_differ(spark):
    texts = [f"{'common beginning ' * 40}{i:04d}{'tail ' * 20}" for i in range(400)] + ["hot"] * 500
    frame = spark.createDataFrame([(bytearray(t.encode()),) for t in texts], "body binary").repartition(4)
    prefixes = filter_audit.adaptive_prefixes(frame, 20_000)
    sizes = defaultdict(int)
    for text in set(texts):
        sizes[prefixes.place(text.encode())] += len(text)
    assert len(prefixes.levels) < 12 and max(sizes.values()) <= 2 * 20_000 and min(sizes) >= 0


def test_trie_keeps_smallest_ids():
    rng, trie, want = np.random.default_rng(1), filter_audit.Trie(), {}
    for i in rng.permutation(3_000):
        data = bytes(rng.choice(list(b"ab"), rng.integers(0, 9)))
        trie.insert(data, int(i), ("p", 0, 1))
        want[data] = min(int(i), want.get(data, int(i)))
    assert sorted(least for least, _ in trie.terminals()) == sorted(want.values())
    assert sum(len(rows) for _, rows in trie.terminals()) == 3_000


def test_common_length():
    for a, b, n in ((b"", b"x", 0), (b"abc", b"abc", 3), (b"abcd", b"abxd", 2), (b"a" * 999, b"a" * 500 + b"b", 500), (b"b", b"a", 0), (b"ab", b"a", 1)):
        assert filter_audit.common_length(a, b) == n


VECTORS = "vec_id bigint, embedding array<float>, label int, score string, rank string, v string, id string, cell string"


def vectors_of(spark, rows):
    return spark.createDataFrame([(*row, "a", "b", "c", "d", "e") for row in rows], VECTORS).repartition(5)


def mine_plainly(rows, every=100):
    clean = {}
    for key, vector, label in rows:
        if key is not None and label is not None and vector is not None and all(x is not None and np.isfinite(x) for x in vector):
            clean[key, label, tuple(int(np.floor(256 * float(np.float32(x)))) for x in vector)] = True
    out = []
    for key, label, v in clean:
        if key % every:
            continue
        others = [(-sum(a * b for a, b in zip(v, w)), i, m) for i, m, w in clean if i != key]
        for ps, positive, _ in sorted((s, i, m) for s, i, m in others if m == label)[:5]:
            near = sorted((s, i) for s, i, m in others if m != label and -80 * ps <= -100 * s <= -100 * ps)[:5]
            out += [(key, positive, rank, i, -ps, -s) for rank, (s, i) in enumerate(near, 1)]
    return sorted(out)


def random_vectors(seed, n=600, width=12, clusters=8):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(clusters, width))
    rows = []
    for i in range(n):
        v = centres[rng.integers(clusters)] + rng.normal(scale=rng.choice([0.05, 0.5]), size=width)
        rows.append((int(i), (v / np.linalg.norm(v)).tolist(), int(rng.integers(4))))
    return rows


ODD_VECTORS = [
    (None, [1.0] * 12, 1), (700, None, 1), (701, [1.0] * 12, None), (702, [float("nan")] + [0.5] * 11, 1), (703, [None] + [0.5] * 11, 2),
    (704, [float("inf")] * 12, 0), (800, [0.0] * 12, 1), (801, [], 2), (802, [0.5, 0.25], 1), (900, [0.3] * 12, 77), (-100, [0.2] * 12, 1),
]


@pytest.mark.parametrize("seed", [1, 2])
def test_hard_negatives_equal_brute_force(spark, monkeypatch, seed):
    monkeypatch.setattr(hard_negatives, "ROWS", 40)
    monkeypatch.setattr(hard_negatives, "ANCHORS", 3)
    rows = random_vectors(seed)
    hot = [(1_000 + i, rows[0][1], i % 3) for i in range(200)]  # a very frequent vector
    rows += hot + rows[:20] + ODD_VECTORS + [((BIG // 100 + 1) * 100, rows[5][1], 1), (BIG + 1, rows[5][1], 1)]
    found = hard_negatives.mine(vectors_of(spark, rows)).collect()
    assert sorted(map(tuple, found)) == mine_plainly(rows)


def test_hard_negatives_of_little(spark):
    assert hard_negatives.mine(vectors_of(spark, [])).count() == 0
    assert hard_negatives.mine(vectors_of(spark, ODD_VECTORS[:6])).count() == 0
    few = [(0, [1.0, 0.0], 1), (1, [0.9, 0.1], 1), (2, [0.85, 0.2], 2), (3, [0.1, 0.9], 2)]
    assert sorted(map(tuple, hard_negatives.mine(vectors_of(spark, few)).collect())) == mine_plainly(few)


def test_big_components_stay_exact(spark):
    rows = [(i, [float(1 << 22) + i, float(1 << 21) - 3 * i, 7.0], i % 2) for i in range(0, 300)]
    found = hard_negatives.mine(vectors_of(spark, rows)).collect()
    assert sorted(map(tuple, found)) == mine_plainly(rows)


def test_survivors_lose_no_pair():
    rng = np.random.default_rng(4)
    for scale in (1.0, 0.05):
        q, x = np.floor(256 * rng.normal(size=(30, 40)) * scale), np.floor(256 * rng.normal(size=(500, 40)) * np.geomspace(1, 0.01, 40))
        exact = q @ x.T
        for cut in (50, 90, 99, 99.9):
            threshold = np.percentile(exact, cut, axis=1)
            i, j = hard_negatives.survivors(q, x, threshold)
            kept = np.zeros(exact.shape, bool)
            kept[i, j] = True
            assert not (exact >= threshold[:, None])[~kept].any()
        assert kept.mean() < 0.5


def test_labels_of_every_seventh_id_move(spark, tmp_path):
    rows = random_vectors(3, 300)
    spark.createDataFrame([(i, v, m) for i, v, m in rows], "vec_id bigint, embedding array<float>, label int").write.parquet(f"{tmp_path}/embeddings.parquet")
    moved = [(i, v, (m + 1) % 10 if i % 7 == 0 else m) for i, v, m in rows]
    assert sorted(map(tuple, queries.op12_hard_negatives(spark, str(tmp_path)).collect())) == mine_plainly(moved)


def print_plainly(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components_plainly(rows):
    prints = [print_plainly(t) for _, t, *_ in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= 2:
                root[find(i)] = find(j)
    least = defaultdict(list)
    for i, (key, *_) in enumerate(rows):
        if key is not None:
            least[find(i)].append(key)
    return sorted(((key, f"{prints[i]:016x}", min(least[find(i)], default=None)) for i, (key, *_) in enumerate(rows)), key=str)


def test_simhash_equals_brute_force(spark):
    rng = np.random.default_rng(6)
    base = [f"w{i}" for i in rng.integers(0, 5_000, 400)]
    near = [(100 + i, " ".join([*base[:k], f"n{i}", *base[k + 1 :]]), None) for i, k in enumerate(rng.integers(0, 400, 120))]
    rows = [*AUDITED, *near, (300, None, None), (301, "one two", None), (302, "ONE  two", None), (303, "One Two three four", None)]
    rows.append((None, " ".join(base), None))
    found = simhash.near_duplicates(docs_of(spark, rows)).collect()
    assert sorted(map(tuple, found), key=str) == components_plainly(rows)
    assert simhash.near_duplicates(docs_of(spark, [])).count() == 0


@pytest.mark.parametrize("block", [7, 4_096])
def test_links_of_hot_buckets(spark, block):
    rng = np.random.default_rng(7)
    centre = int(rng.integers(1 << 62))
    values = {centre ^ (1 << int(a)) ^ (1 << int(b)) for a, b in rng.integers(0, 64, (150, 2))} | {int(x) for x in rng.integers(0, 1 << 62, 300)}
    values |= {x ^ 5 for x in list(values)[:50]}
    fp = np.asarray(sorted(values), np.uint64)
    frame = spark.createDataFrame([(int(x),) for x in fp.view(np.int64)], "fp bigint").repartition(4)
    edges = [(r.a, r.b) for r in simhash.links(frame, block).collect()]
    assert all((a ^ b) != 0 for a, b in edges)

    def parts(pairs):
        root = {int(x): int(x) for x in fp.view(np.int64)}

        def find(x):
            while root[x] != x:
                x = root[x]
            return x

        for a, b in pairs:
            root[find(a)] = find(b)
        groups = defaultdict(set)
        for x in root:
            groups[find(x)].add(x)
        return sorted(map(sorted, groups.values()))

    i, j = np.nonzero(np.triu(np.bitwise_count(fp[:, None] ^ fp[None, :]) <= 2, 1))
    signed = fp.view(np.int64).tolist()
    assert parts(edges) == parts((signed[a], signed[b]) for a, b in zip(i, j))


def test_pivots_drop_no_near_pair():
    rng = np.random.default_rng(8)
    fp = rng.integers(0, 1 << 63, 200, dtype=np.uint64)
    fp = np.concatenate([fp, fp ^ np.uint64(1 << 40), fp ^ np.uint64(3)])
    table = np.bitwise_count(fp[:, None] ^ simhash.references()[None, :]).astype(np.int16)
    i, j = np.triu_indices(len(fp), 1)
    near = np.bitwise_count(fp[i] ^ fp[j]) <= 2
    a, b = simhash.linked(fp, table, i, j)
    assert (a == i[near]).all() and (b == j[near]).all()
