import contextlib
import math
import random
import threading
from collections import Counter
from pathlib import Path

import numpy as np
import pandas as pd
import pytest
from conftest import EDGES
from pyspark.sql import functions as F

from wardlake.llm import bloomlm, fm, latent, risk
from wardlake.session import checkpoint_root

SF = "/root/testdata/sf0.01"
LABELS = "doc_id long, quality int, toxic int"


# ------------------------------------------------------------- factorisation machine

def test_pairs_in_linear_time_equal_the_double_sum():
    rng = np.random.default_rng(1)
    p = fm.Params(buckets=64, rank=3)
    n = 64 + fm.STATS
    m = fm.Machine(p, np.zeros(fm.STATS), np.ones(fm.STATS), 0.3, rng.normal(size=n), rng.normal(size=(n, 3)))
    parts = [fm.inputs(t, fm._Buckets(64)) for t in (b"one two Two!! three", b"", None, b"a a a b | c 9 9")]
    index, value, starts = m.rows(parts)
    got = m.raw(index, value, starts)[0]
    for row, (lo, hi) in enumerate(zip(starts, [*starts[1:], len(index)])):
        x = list(zip(index[lo:hi], value[lo:hi]))
        want = 0.3 + sum(m.linear[i] * v for i, v in x)
        want += sum(m.factors[i] @ m.factors[j] * v * w for a, (i, v) in enumerate(x) for j, w in x[:a])
        assert got[row] == pytest.approx(want)


def test_quality_on_held_out_rows(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    machine = fm.train(docs, labels)
    held = labels.where(fm.held_out(F.col("doc_id"))).select("doc_id", "quality")
    got = fm.score(docs.join(held, "doc_id"), machine, keep=["quality"]).select("row.quality", "score").toPandas()
    good, bad = got.score[got.quality == 1].to_numpy(), got.score[got.quality == 0].to_numpy()
    assert len(bad) > 5 and (good[:, None] > bad[None, :]).mean() > 0.97
    assert (good >= 0.3).mean() > 0.98 and (bad < 0.3).mean() > 0.6


def test_score_depends_on_the_text_alone(spark, make_docs):
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(40)], LABELS)
    docs = make_docs([(i, "fine words here" if i % 2 else "### $$$ ###") for i in range(40)])
    machine = fm.train(docs, labels)
    other = docs.select((F.col("doc_id") + 1000).alias("doc_id"), "text", F.lit("xx").alias("lang"), F.lit("q").alias("source"))
    a = {r.row.text: r.score for r in fm.score(docs, machine).collect()}
    assert a == {r.row.text: r.score for r in fm.score(other, machine).collect()}
    assert a["fine words here"] > 0.5 > a["### $$$ ###"]


def test_quality_edge_cases(spark, make_docs):
    labels = spark.createDataFrame([(None, 1, 0), (4, None, 0), (5, 1, 0), (5, 0, 0), (7, 1, 0)], LABELS)
    docs = make_docs(EDGES)
    got = fm.score(docs, fm.train(docs, labels)).collect()
    assert sorted([(r.row.doc_id, r.row.text, r.row.score) for r in got], key=repr) == sorted([(i, t, 3) for i, t in EDGES], key=repr)
    assert all(0 <= r.score <= 1 for r in got)
    empty = spark.createDataFrame([], LABELS)
    assert fm.score(make_docs([]), fm.train(make_docs([]), empty)).count() == 0
    assert all(r.score == pytest.approx(0.5, abs=0.2) for r in fm.score(docs, fm.train(docs, empty)).collect())


# ------------------------------------------------------------- risk-controlled rules

def brute_measures(text):
    words = [w for w in __import__("re").split(r"[\x20\x09-\x0D]+", text or "") if w]
    windows = [tuple(words[i:i + 8]) for i in range(len(words) - 7)]
    twice = {w for w, n in Counter(windows).items() if n > 1}
    covered = {i + o for i, w in enumerate(windows) if w in twice for o in range(8)}
    lines = [x for x in (text or "").split("\n") if x.strip(" \t\n\x0b\x0c\r")]
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(covered))


def test_measures_equal_brute_force(make_docs):
    rnd = random.Random(2)
    texts = [" ".join(rnd.choice("ab") for _ in range(rnd.randrange(0, 40))) for _ in range(60)]
    texts += ["\n".join(rnd.choice(["x y", "", " ", "# z", "é è"]) for _ in range(rnd.randrange(0, 8))) for _ in range(30)]
    texts += ["a b c d e f g h", " ".join("a b c d e f g h".split() * 2), " <|>\x0b%"] + [t for _, t in EDGES]
    got = {r.doc_id: r for r in risk.measures(make_docs(list(enumerate(texts)))).collect()}
    for i, t in enumerate(texts):
        r = got[i]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == brute_measures(t), t


def test_binomial_tail_is_exact(spark):
    cases = [(k, n) for n in (0, 1, 5, 19, 20, 21, 300, 5000) for k in {0, 1, n // 200, n // 100, n // 50} if k <= n]
    df = spark.createDataFrame(cases, "k long, n long").withColumn("p", risk.binomial_cdf(F.col("k"), F.col("n"), 0.01))
    for r in df.collect():
        want = sum(math.comb(r.n, j) * 0.01 ** j * 0.99 ** (r.n - j) for j in range(r.k + 1))
        assert r.p == pytest.approx(1.0 if r.k > r.n * 0.01 else want, rel=1e-9)


def test_cutoffs_respect_the_limit(spark, make_docs):
    """Good texts hold few symbols, except for one in 25 of stratum "en" that holds many."""
    fine = " ".join(f"word{i}" for i in range(30))
    pairs = [(i, fine + (" ### ### ### ### ###" if i % 25 == 0 else "")) for i in range(3000)]
    pairs += [(i, fine + " ### ### ### ###" * 3) for i in range(3000, 3100)]
    docs = make_docs(pairs)
    labels = spark.createDataFrame([(i, int(i < 3000), 0) for i in range(3100)], LABELS)
    cuts = {r.rule: r for r in risk.thresholds(risk.measures(docs), labels).collect()}
    # 4 % of good texts have 0.43 symbols a word: no cutoff below that may be certified at 1 %
    assert cuts["symbol_share"].cutoff == 0.5 and cuts["symbol_share"].k == 0
    kept = {r.doc_id: r.kept for r in risk.controlled(docs, labels).collect()}
    assert all(kept[i] for i in range(3000)) and not any(kept[i] for i in range(3000, 3100))
    few = labels.where("doc_id < 100")
    assert risk.thresholds(risk.measures(docs), few).count() == 0
    assert all(r.kept for r in risk.controlled(docs, few).collect())


def test_rules_edge_cases(spark, make_docs):
    labels = spark.createDataFrame([(None, 1, 0), (4, 1, 0), (4, 1, 0), (5, None, 1)], LABELS)
    got = risk.controlled(make_docs(EDGES).withColumn("lang", F.lit(None).cast("string")), labels).collect()
    assert len(got) == len(EDGES) and {r.doc_id for r in got if r.kept} == set()
    assert risk.controlled(make_docs([]), labels).count() == 0


# ------------------------------------------------------------- language model

def tokens(text):
    return [*(text or "").encode().lower().split(), None]


def brute_scores(train, pairs, w=0.4):
    uni, bi, n = Counter(), Counter(), len(train)
    for t in train:
        row = tokens(t)
        uni.update(row)
        bi.update(zip([0, *row[:-1]], row))
    total = sum(uni.values()) + len(uni) + 1
    out = []
    for i, t in pairs:
        row, score = tokens(t), 0.0
        for a, b in zip([0, *row[:-1]], row):
            before, plain = (n if a == 0 else uni[a]), (uni[b] + 1) / total
            score += math.log10((1 - w) * plain + w * bi[a, b] / before if before else plain)
        out.append((i, len(row), sum(uni[x] > 0 for x in row), sum(math.log10((uni[x] + 1) / total) for x in row), score))
    return out


def test_scores_equal_exact_counts(make_docs):
    rnd = random.Random(3)
    words = ["The", "cat", "sat", "On", "été", "mat,"] + [f"rare{i}" for i in range(40)]
    train = [" ".join(rnd.choice(words[:6] if rnd.random() < .7 else words) for _ in range(rnd.randrange(0, 30))) for _ in range(40)]
    pairs = list(enumerate(train)) + [(100, "the dog sat"), (101, "")] + [(200 + (i or 0), t) for i, t in EDGES]
    docs = make_docs(pairs)
    # counts up to 4 are levels of their own at base 1.2, and the filter is wide: the estimates are near exact
    for p in (bloomlm.Params(base=1.02, bits_each=24.0, frequent_words=5), bloomlm.Params(base=1.02, bits_each=24.0, frequent_words=5, broadcast_bytes=0)):
        model = bloomlm.train(make_docs(list(enumerate(train))), p)
        got = sorted([(r.doc_id, r.n_tokens, r.n_known, r.base_score, r.score) for r in bloomlm.score(docs, model).collect()], key=repr)
        assert len(got) == len(pairs)       # repeated rows too
        for g, want in zip(got, sorted(brute_scores(train, pairs), key=repr), strict=True):
            assert g[:3] == want[:3] and g[3] == pytest.approx(want[3], abs=1e-6) and g[4] == pytest.approx(want[4], rel=0.03)


def test_filter_never_counts_too_little():
    p = bloomlm.Params()
    rng = np.random.default_rng(4)
    h, n = rng.integers(0, 2 ** 63, 3000).astype(np.uint64), rng.zipf(1.6, 3000).clip(1, 10 ** 6)
    q = bloomlm.levels_of(n, p.base)
    bits = bloomlm.segment_bits(h, q, p)
    table = bloomlm.Filter(bits, np.array([0, len(bits)]), 1, p)
    want = bloomlm.level_values(p.base)[q]
    got = table.counts(h)
    assert (got >= want).all() and (got == want).mean() > 0.95
    absent = table.counts(rng.integers(0, 2 ** 63, 3000).astype(np.uint64))
    assert (absent > 0).mean() < 0.05


def test_language_model_edge_cases(make_docs):
    docs = make_docs(EDGES)
    nothing = bloomlm.train(make_docs([]))
    got = bloomlm.score(docs, nothing).collect()
    assert len(got) == len(EDGES) and all(r.n_known == 0 and r.score == r.base_score == 0 for r in got)
    assert bloomlm.score(make_docs([]), bloomlm.train(docs)).count() == 0


def test_packed_keys_and_places(spark):
    x = np.sort(np.random.default_rng(1).integers(0, 2 ** 64, 5000, dtype=np.uint64))
    assert (bloomlm._hashes(bloomlm._keys(x)) == x).all()
    for n in (x, x[:0], np.zeros(3, np.uint64), np.arange(300)):
        assert (bloomlm._unpack(bloomlm._pack(n)) == n).all()
    parts = bloomlm.parts_of(8 * 11, bloomlm.Params())
    kinds = (x, np.arange(1, 5001)), (x[:3],)
    rows = [r for batch in bloomlm._parted(parts, *kinds) for r in zip(*[c.to_pylist() for c in batch])]
    seen, counted = [], []
    for place, keys, n, few in rows:
        got = bloomlm._keys_of([keys, few], place % parts.n, parts.n)[0]
        assert (got % np.uint64(parts.n) == place % parts.n).all()
        seen += got.tolist()
        counted += bloomlm._unpack(n).tolist()
    assert sorted(seen) == sorted([*x.tolist(), *x[:3].tolist()]) and sorted(counted) == list(range(1, 5001))
    places = spark.createDataFrame([(int(x),) for x in parts.places], "place int")
    assert sorted(r[0] for r in places.select(F.pmod(F.hash("place"), F.lit(11))).collect()) == list(range(11))


def test_blocks_ask_for_what_a_broadcast_tells(make_docs, monkeypatch):
    """Many blocks per task, repeated rows and null ids: scores as exact as where the filter is broadcast."""
    monkeypatch.setattr(bloomlm, "_COUNT_TOKENS", 40)
    monkeypatch.setattr(bloomlm, "_ASK_TOKENS", 60)
    rnd = random.Random(5)
    texts = [(None if i % 9 == 0 else i % 50, " ".join(f"w{int(rnd.paretovariate(.7))}" for _ in range(rnd.randrange(30)))) for i in range(120)]
    docs, asked = make_docs(texts + texts[:10] + EDGES), []
    for limit in (1 << 20, 0):
        model = bloomlm.train(make_docs(texts), bloomlm.Params(broadcast_bytes=limit, frequent_words=3))
        asked.append(sorted(map(tuple, bloomlm.score(docs, model).collect()), key=repr))
    assert len(asked[0]) == len(asked[1]) == 130 + len(EDGES)
    for a, b in zip(*asked, strict=True):
        assert a[:4] == b[:4] and a[4:] == pytest.approx(b[4:], abs=1e-8)


def test_scoring_by_asking_keeps_disk_in_bounds(spark, tmp_path):
    """Beyond the broadcast, a row per n-gram of a text took some 14 times the input in shuffle and other files."""
    rng = np.random.default_rng(6)
    pd.DataFrame({"doc_id": range(2400), "text": [" ".join(f"{x:x}" for x in rng.zipf(1.2, 400) * 7919 % 10 ** 6) for _ in range(2400)]}).to_parquet(tmp_path / "docs.parquet")
    local = str(spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()[0])
    places = [Path(local), Path(checkpoint_root(spark).removeprefix("file:")) / "corpus"]

    def files():
        return {p: p.stat().st_size for top in places for p in top.rglob("*") if p.suffix in (".data", ".parquet") and p.is_file()}

    docs, before, most = spark.read.parquet(str(tmp_path / "docs.parquet")), files(), [0]
    done = threading.Event()

    def watch():
        while not done.wait(0.1):
            with contextlib.suppress(OSError):      # a file went meanwhile
                most.append(sum(size for p, size in files().items() if p not in before))

    watcher = threading.Thread(target=watch)
    watcher.start()
    try:
        model = bloomlm.train(docs, bloomlm.Params(broadcast_bytes=0))
        assert bloomlm.score(docs, model).agg(F.sum("n_tokens")).first()[0] == 2400 * 401
    finally:
        done.set()
        watcher.join()
    assert 0 < max(most) < 4 * (tmp_path / "docs.parquet").stat().st_size


# ------------------------------------------------------------- latent retrieval

def dp_lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        last = row
        row = [0]
        for j, y in enumerate(b):
            row.append(last[j] + 1 if x == y else max(last[j + 1], row[j]))
    return row[-1]


def test_common_subsequence_equals_dynamic_programming():
    rnd = random.Random(5)
    for _ in range(200):
        a, b = ([rnd.randrange(5) for _ in range(rnd.randrange(1, 30))] for _ in range(2))
        assert latent.common_subsequence(a, b) == dp_lcs(a, b)
    assert latent.common_subsequence([1], []) == 0


def test_basis_equals_the_leading_singular_vectors(spark):
    docs, bench = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "benchmark"))
    p = latent.Params(rank=8, oversample=24, passes=4)
    block = next(latent._blocks(bench, p))
    latent._fit(docs, block, p)
    a = np.zeros((len(block.passages), len(block.vocabulary)))
    for row, (i, at, n) in enumerate(block.passages):
        for word in block.items[i][1][at:at + n]:
            a[row, word] += block.idf[word]
    basis = block.weighted[:-1] / block.idf[:-1, None]
    best = np.linalg.svd(a)[1][:8]
    assert np.linalg.norm(a @ basis, axis=0)[:3] == pytest.approx(best[:3], rel=0.02)
    assert np.allclose(basis.T @ basis, np.eye(8), atol=1e-3)


def test_exact_copies_and_paraphrases_are_found(spark, make_docs):
    """Brute force over all windows as the standard: recall of planted items."""
    rnd = random.Random(6)
    bench = spark.read.parquet(f"{SF}/benchmark.parquet")
    docs = [r.text for r in spark.read.parquet(f"{SF}/documents.parquet").where("doc_id < 120").collect()]
    items = [(r.item_id, r.text) for r in bench.collect()]
    pairs, exact, loose = [], set(), set()
    for k, (item, text) in enumerate(items):
        words = text.split()
        tail = len(latent._SENTENCE.split(text.strip(".?! \n"))[-1].split()) + 1
        other = [w if j >= len(words) - tail or rnd.random() > 0.2 else f"zz{rnd.randrange(10 ** 6)}" for j, w in enumerate(words)]
        for base, what, into in ((2 * k, words, exact), (2 * k + 1, other, loose)):
            home = docs[base % len(docs)].split()
            at = rnd.randrange(len(home) + 1)
            pairs.append((10_000 + base, " ".join(home[:at] + what + home[at:])))
            into.add((10_000 + base, item))
    found = {(r.doc_id, r.item_id) for r in latent.leaks(make_docs(pairs), bench).collect()}
    assert exact <= found and len(loose & found) >= 0.9 * len(loose)
    clean = [(i, d) for i, d in enumerate(docs) if not any(" ".join(latent.normal(t)[0:5][0:1] and map(bytes.decode, latent.normal(t)))
                                                           in " ".join(map(bytes.decode, latent.normal(d))) for _, t in items)]
    assert latent.leaks(make_docs(clean), bench).count() == 0


def test_items_of_frequent_words_are_found(spark, make_docs):
    """Short items, three quarters of them words of nearly every document, in text without the benchmark's words."""
    rnd = random.Random(8)
    stop = ["the", "of", "and", "to", "in", "is", "that", "it"]
    items, pairs, want = [], [], set()
    for n in range(5, 21):
        items.append((n, " ".join(f"item{n}x{j}" if j % 4 == 1 else rnd.choice(stop) for j in range(n))))
        loose = [f"zz{n}" if j == 2 else w for j, w in enumerate(items[-1][1].split())]      # one word replaced
        for k, words in enumerate((items[-1][1].split(), loose)):
            home = [f"f{n}x{j}" for j in range(60)]
            pairs.append((100 * n + k, " ".join(home[:30] + words + home[30:])))
            want.add((100 * n + k, n))
    pairs += [(9000 + i, " ".join(stop + [f"g{i}x{j}" for j in range(12)])) for i in range(300)]
    bench = spark.createDataFrame(items, "item_id long, text string")
    found = {(r.doc_id, r.item_id) for r in latent.leaks(make_docs(pairs), bench).collect()}
    assert want <= found and not {d for d, _ in found if d >= 9000}


def exhaustive_leaks(docs, items, p):
    """Every document and item by LCS over every region of the length the operator checks."""
    out = set()
    for d, text in docs:
        words = latent.normal(text)
        for i, item in items:
            want = latent.normal(item)
            answer = [latent.normal(x) for x in latent._SENTENCE.split(item)]
            answer = [x for x in answer if x][-1]
            span = len(want) + p.window // 2 + 2 * latent._slack(len(want), p)
            for at in range(max(1, len(words) - span // 2)):
                region = words[at:at + span]
                if len(set(want) & set(region)) < 0.3 * len(set(want)):
                    continue
                lcs = latent.common_subsequence(want, region) / len(want)
                if lcs >= p.min_lcs and (lcs >= p.sure_lcs or latent.common_subsequence(answer, region) / len(answer) >= p.min_answer):
                    out.add((d, i))
                    break
    return out


def test_recall_of_loose_paraphrases_against_exhaustive_search(spark, make_docs):
    """Items with a quarter to two fifths of their words replaced, dropped or moved apart by others."""
    rnd = random.Random(11)
    p = latent.Params()
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()][:24]
    home = [r.text.split() for r in spark.read.parquet(f"{SF}/documents.parquet").where("doc_id < 60").collect()]
    docs = []
    for share in (0.25, 0.3, 0.35, 0.4):
        for item, text in items:
            words = text.split()
            tail = len(latent._SENTENCE.split(text.strip(".?! \n"))[-1].split()) + 1
            change = set(rnd.sample(range(len(words) - tail), round(share * (len(words) - tail)))) if len(words) > tail else set()
            new = []
            for j, w in enumerate(words):
                kind = rnd.randrange(3) if j in change else 3
                new += [[f"zz{rnd.randrange(10 ** 6)}"], [], [w, "zy"], [w]][kind]
            base = rnd.choice(home)[:150]
            at = rnd.randrange(len(base) + 1)
            docs.append((len(docs), " ".join(base[:at] + new + base[at:])))
    want = exhaustive_leaks(docs, items, p)
    bench = spark.createDataFrame(items, "item_id long, text string")
    found = {(r.doc_id, r.item_id) for r in latent.leaks(make_docs(docs), bench, p).collect()}
    assert len(want) >= 80 and found <= want and len(found) >= 0.97 * len(want)


def test_short_items_and_unspaced_scripts_are_found(spark, make_docs):
    ja = "\u5bcc\u58eb\u5c71\u306e\u9ad8\u3055\u306f\u4f55\u30e1\u30fc\u30c8\u30eb\u3067\u3059\u304b\uff1f\u4e09\u5343\u4e03\u767e\u4e03\u5341\u516d\u30e1\u30fc\u30c8\u30eb\u3067\u3059\u3002"
    th = "\u0e41\u0e21\u0e48\u0e19\u0e49\u0e33\u0e40\u0e08\u0e49\u0e32\u0e1e\u0e23\u0e30\u0e22\u0e32\u0e44\u0e2b\u0e25\u0e1c\u0e48\u0e32\u0e19\u0e40\u0e21\u0e37\u0e2d\u0e07\u0e43\u0e14"
    items = [(1, "Who wrote Hamlet? Shakespeare"), (2, "Capital: Paris"), (3, ja), (4, th), (5, "the the"), (6, "lone")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    docs = [(1, "A quiz. Who wrote HAMLET? Shakespeare! And more."), (2, "who wrote Shakespeare Hamlet"), (3, "so capital paris"),
            (4, f"\u524d\u66f8\u304d{ja}\u5f8c\u66f8\u304d"), (5, f"x {th} y"), (6, ja[:9] + "\u3042" + ja[10:]), (7, "\u5bcc\u58eb\u5c71"), (8, "the"),
            (9, "the the the"), (10, "paris capital"), (11, "Who wrote Hamlet?"), (12, "Shakespeare who wrote Hamlet"), (13, "a lone star")]
    found = {(r.doc_id, r.item_id) for r in latent.leaks(make_docs(docs), bench).collect()}
    assert found == {(1, 1), (3, 2), (4, 3), (6, 3), (5, 4), (9, 5), (13, 6)}


def test_copies_of_one_item_stay_in_one_block_row(spark):
    bench = spark.createDataFrame([(1, "one item of six plain words")] * 500 + [(2, "another item of six plain words")], "item_id long, text string")
    blocks = list(latent._blocks(bench, latent.Params(block_items=1)))
    assert sorted(len(b.items) for b in blocks) in ([1, 1], [2])
    assert [len(r) for r in latent._rounds(iter(blocks), latent.Params(round_bytes=1))] == [1] * len(blocks)


def test_blocks_of_items_give_the_same_leaks(spark):
    docs, bench = (spark.read.parquet(f"/root/testdata/sf0.001/{t}.parquet") for t in ("documents", "benchmark"))
    rows = [{(r.doc_id, r.item_id) for r in latent.leaks(docs, bench, latent.Params(block_items=n, round_bytes=b)).collect()}
            for n, b in ((2000, 64 << 20), (15, 64 << 20), (15, 1))]
    assert rows[0] == rows[1] == rows[2] and rows[0]


def test_decontamination_edge_cases(spark, make_docs):
    schema = "item_id long, text string, doc_id string"
    item = "Which of the seven rivers crosses the old bridge twice? The river Umbra does."
    bench = spark.createDataFrame([(1, item, "x"), (1, item, "y"), (None, item, "z"), (2, None, "x"), (3, "", "x"), (4, "too short", "x")], schema)
    docs = make_docs([*EDGES, (20, f"Well. {item} Indeed."), (20, f"Well. {item} Indeed."), (None, item.upper())])
    found = latent.leaks(docs, bench)
    assert sorted([(r.doc_id, r.item_id) for r in found.collect()], key=repr) == sorted([(20, 1), (20, None), (None, 1), (None, None)], key=repr)
    assert sorted([r.text for r in latent.without_leaks(docs, found).collect()], key=repr) == sorted([t for _, t in EDGES], key=repr)
    for d, b in ((make_docs([]), bench), (docs, spark.createDataFrame([], schema))):
        assert latent.leaks(d, b).count() == 0
