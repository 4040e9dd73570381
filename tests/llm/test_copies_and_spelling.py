import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import pytest
from conftest import EDGES

from wardlake.llm import exactdedup, spelling


def brute_groups(pairs):
    sha = [hashlib.sha256(re.sub(r"[\x20\x09-\x0D]+", " ", t or "").encode()).hexdigest() for _, t in pairs]
    ids = defaultdict(list)
    for (i, _), h in zip(pairs, sha):
        ids[h].append(i)
    low = {h: min((i for i in v if i is not None), default=None) for h, v in ids.items()}
    return sorted([(i, low[h], len(ids[h]), h) for (i, _), h in zip(pairs, sha)], key=repr)


@pytest.mark.parametrize("fanin,rounds", [(4, 2), (2, 3), (3, 1)])
def test_exact_groups_equal_brute_force(make_docs, fanin, rounds):
    rnd = random.Random(fanin)
    pool = ["a b", "a  b", "a\tb", " a b", "", None, " ", "\n", "é", "É", "a b", "hot"] + [f"own {i}" for i in range(30)]
    pairs = [(i, rnd.choice(pool)) for i in range(120)] + [(500 + i, "hot") for i in range(80)] + EDGES
    out = exactdedup.exact_groups(make_docs(pairs).repartition(7), fanin, rounds).collect()
    assert sorted([(r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in out], key=repr) == brute_groups(pairs)
    stays = defaultdict(list)
    for r in out:
        stays[r.text_sha256].extend([r] * r.kept)
    assert all(len(v) == 1 and v[0].doc_id == v[0].keep_id for v in stays.values())     # one row each, repeated rows too
    assert len(stays) == len({r.text_sha256 for r in out})


def test_every_round_leaves_a_key_once_per_run(spark, make_docs):
    rows = exactdedup.digests(make_docs([(i, "same" if i % 3 else f"t{i}") for i in range(300)]).repartition(16)).cache()
    done = exactdedup.groups(rows, 4, 2)
    assert done.count() == done.select("sha").distinct().count() == 101
    row = done.where("n > 1").first()
    assert row.n == 200 and row.best.doc_id == 1


def test_hot_group_is_looked_up_by_broadcast_and_rows_stay_whole(spark):
    df = spark.createDataFrame([(i, "x", "extra") for i in range(5000)] + [(9000 + i, f"u{i}", None) for i in range(5000)],
                               "doc_id long, text string, best string")
    out = exactdedup.unique_rows(df)
    assert out.columns == df.columns and out.count() == 5001
    assert out.where("text = 'x'").collect()[0].asDict() == {"doc_id": 0, "text": "x", "best": "extra"}


def test_exact_dedup_of_an_empty_table_and_of_null_ids(make_docs):
    assert exactdedup.exact_groups(make_docs([])).collect() == []
    out = exactdedup.exact_groups(make_docs([(None, "z"), (None, "z"), (None, None), (4, "")])).collect()
    assert sorted((r.doc_id, r.keep_id, r.group_size, r.kept) for r in out if r.doc_id) == [(4, 4, 2, True)]
    assert sorted((r.keep_id, r.group_size, r.kept) for r in out if r.doc_id is None and r.keep_id is None) == [(None, 2, False), (None, 2, True)]


def test_native_plan_has_no_python(make_docs):
    plan = exactdedup.exact_groups(make_docs([(1, "a")]))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan and "CartesianProduct" not in plan


def near(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def brute_variants(words, ratio):
    best, links, out = {}, {}, []
    for w, n in words.items():
        around = sorted((-words[v], v) for v in words if near(w, v))
        best[w] = around
        if around and -around[0][0] >= ratio * n:
            links[w] = around[0][1]
    for w, n in words.items():
        root = w
        while root in links:
            root = links[root]
        form = links.get(w)
        out.append((w, form, root, n, len(best[w]), words.get(form)))
    return sorted(out)


@pytest.mark.parametrize("seed", range(4))
def test_variants_equal_brute_force(spark, seed):
    rnd = random.Random(seed)
    words = {"".join(rnd.choice("abé"[:2 + seed % 2]) for _ in range(rnd.randrange(0, 7))): rnd.choice([1, 2, 3, 10, 20, 30, 100, 250, 2500, 30000])
             for _ in range(90)}
    long = "".join(rnd.choice("ab") for _ in range(62))
    words |= {long + t: n for t, n in (("ab", 2), ("abb", 40), ("abba", 500), ("abbab", 6000), ("b", 7))}
    df = spark.createDataFrame([(w, n, "x") for w, n in words.items()], "word string, n long, rank string").repartition(5)
    out = spelling.variants(df, ratio=10 if seed < 3 else 2)
    got = sorted((r.word, r.form, r.root, r.n, r.n_near, r.form_n) for r in out.collect())
    assert got == brute_variants(words, 10 if seed < 3 else 2)


def brute_count(pairs, min_chars, min_count, one_in):
    found = Counter()
    for i, text in pairs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if c.isascii() else c for c in run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if one_in and h % one_in == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            if len(run) >= min_chars:
                found[run] += 1
    return {w: n for w, n in found.items() if n >= min_count}


def test_words_are_counted_and_damaged_as_stated(make_docs):
    rnd = random.Random(3)
    pool = ["Letters", "letters", "Übermäßig", "übermäßig", "ÉCOLES", "short", "x", "mixed9words", "under_score", "naïveté×÷", "日本語letters"]
    pairs = [(i, " ".join(rnd.choice(pool) for _ in range(30))) for i in range(60)] + EDGES
    for one_in in (None, 3, 31):
        got = {r.word: r.n for r in spelling.count_words(make_docs(pairs), 5, 2, one_in).collect()}
        assert got == brute_count(pairs, 5, 2, one_in)


def test_spelling_edge_cases(spark, make_docs):
    empty = spark.createDataFrame([], "word string, n long")
    assert spelling.variants(empty).collect() == []
    assert spelling.variants(spelling.count_words(make_docs([]))).collect() == []
    df = spark.createDataFrame([("", 1), ("a", 50), ("b", 50), (None, 3), ("zz", None), ("ab", 500)], "word string, n long")
    got = {r.word: (r.form, r.root, r.n_near) for r in spelling.variants(df).collect()}
    assert got == {"": ("a", "ab", 2), "a": ("ab", "ab", 3), "b": ("ab", "ab", 3), "ab": (None, "ab", 2)}


def test_a_very_long_word_stays_within_memory(spark):
    long = "ab" * 2000
    df = spark.createDataFrame([(long, 2), (long[:-1], 30), ("c" + long, 1)], "word string, n long")
    got = {len(r.word): (r.n_near, r.form_n) for r in spelling.variants(df).collect()}
    assert got == {4000: (2, 30), 3999: (1, None), 4001: (1, None)}
