import random
from collections import Counter, defaultdict

import numpy as np
import xxhash
from conftest import EDGES

from wardlake.llm import linededup, simhash
from wardlake.llm.graph import components

SPACE = " \t\n\x0b\x0c\r"
FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute_lines(pairs, min_docs, min_chars=1):
    keys = [[x.strip(SPACE).translate(FOLD) for x in (t or "").split("\n")] for _, t in pairs]
    found = Counter(k for row in keys for k in set(row) if len(k) >= min_chars)
    out = []
    for (i, t), row in zip(pairs, keys):
        lines = (t or "").split("\n")
        kept = [x for x, k in zip(lines, row) if not (len(k) >= min_chars and found[k] >= min_docs)]
        out.append((i, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return sorted(out, key=repr)


def run_lines(df, **kw):
    out = linededup.dedup_lines(df, **kw)
    return sorted([(r.doc_id, r.n_lines, r.n_dropped, r.kept_text) for r in out.collect()], key=repr)


def test_lines_equal_brute_force(make_docs):
    rnd = random.Random(1)
    pool = ["Alpha", " alpha\t", "BETA b", "beta b ", "", "  ", "Éa", "éa", "c\x0b", "d"] + [f"own {i}" for i in range(60)]
    pairs = [(i, "\n".join(rnd.choice(pool) for _ in range(rnd.randrange(0, 7)))) for i in range(40)] + EDGES
    df = make_docs(pairs)
    for kw in ({"min_docs": 3, "n_batches": 5, "fanout": 2}, {"min_docs": 3, "n_batches": 1}, {"min_docs": 2, "n_batches": 3, "min_chars": 3}):
        assert run_lines(df, **kw) == brute_lines(pairs, kw["min_docs"], kw.get("min_chars", 1))


def test_lines_of_an_empty_table_and_rows_kept_whole(make_docs):
    assert run_lines(make_docs([]), min_docs=2) == []
    row = linededup.dedup_lines(make_docs([(1, "a")]), min_docs=2).first()
    assert row.row.row == "r" and row.row.kept_text == "k"


def test_runs_compact_by_level(spark, make_docs):
    runs = linededup.LineRuns(spark, min_docs=3, fanout=2)
    for i in range(5):
        runs.add(make_docs([(i, "same\nnot same %d" % i)]))
    assert [len(x) for x in runs.levels] == [1, 0, 1]
    # "same" is known to be frequent once a compacted run says so: the last run leaves it out
    assert spark.table(runs.levels[0][0]).count() == 1
    assert runs.frequent().count() == 1
    runs.close()


def brute_fp(text, k=3):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    grams = [b" ".join(words[j:j + k]) for j in range(max(1, len(words) - k + 1))]
    hashes = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(ids, fps, radius):
    root = list(range(len(fps)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= radius:
                root[find(i)] = find(j)
    low = defaultdict(list)
    for i, x in enumerate(ids):
        low[find(i)].append(x)
    return [min([x for x in low[find(i)] if x is not None], default=None) for i in range(len(ids))]


def test_covering_masks_lose_no_pair():
    rnd = random.Random(2)
    for radius in (1, 2, 3):
        masks = simhash.masks(radius)
        assert len(masks) == 2 ** (radius + 1) - 1
        for _ in range(3000):
            flips = sum(1 << b for b in rnd.sample(range(64), rnd.randint(1, radius)))
            assert any(flips & m == 0 for m in masks)


def test_groups_equal_brute_force(make_docs):
    rnd = random.Random(3)
    words = [f"w{i}" for i in range(300)]
    pairs = list(EDGES)
    for i in range(100, 130):
        base = [rnd.choice(words) for _ in range(120)]
        pairs.append((i, " ".join(base)))
        for j in range(3):
            near = list(base)
            near[rnd.randrange(120)] = "Changed"
            pairs.append((1000 + 10 * i + j, " ".join(near)))
    out = simhash.near_groups(make_docs(pairs)).collect()
    fps = [brute_fp(t) for _, t in pairs]
    want = sorted(zip([i for i, _ in pairs], fps, brute_components([i for i, _ in pairs], fps, 3)), key=repr)
    assert sorted([(r.doc_id, r.fp % (1 << 64), r.component_id) for r in out], key=repr) == want


def test_crowded_buckets_are_linked_exactly(spark):
    rnd = random.Random(4)
    centre = rnd.getrandbits(64)
    fps = {centre ^ sum(1 << b for b in rnd.sample(range(64), rnd.randint(0, 6))) for _ in range(150)}
    fps |= {rnd.getrandbits(64) for _ in range(20)}
    signed = [simhash._signed(x) for x in fps]
    df = spark.createDataFrame([(x,) for x in signed], "fp long")
    for radius in (1, 2, 3):
        want = brute_components(signed, [x % (1 << 64) for x in signed], radius)
        for size in (2, 1000):
            got = {r.node: r.root for r in components(simhash.links(df, radius, bucket_size=size)).collect()}
            assert {x: got.get(x, x) for x in signed} == dict(zip(signed, want)), (radius, size)


def test_one_of_each_group_stays(make_docs):
    text = "one two three four five six seven"
    df = make_docs([(3, text), (1, text), (1, text), (None, text), (8, "other words stand here now"), (None, None), (2, "")])
    kept = simhash.keep_one(df, simhash.near_groups(df)).collect()
    assert sorted(r.doc_id for r in kept) == [1, 2, 8] and kept[0].row == "r"
    empty = make_docs([])
    assert simhash.keep_one(empty, simhash.near_groups(empty)).count() == 0


def test_components_of_a_long_chain(spark):
    ids = list(np.random.default_rng(5).permutation(200).tolist())
    df = spark.createDataFrame(list(zip(ids, ids[1:])), "a long, b long")
    got = components(df).collect()
    assert len(got) == 200 and {r.root for r in got} == {0}
