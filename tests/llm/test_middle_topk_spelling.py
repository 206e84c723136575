"""Fill-in-middle, exact top-k search and spelling variants against plain versions."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from boutlens.llm import fill_middle, queries, spelling, topk

TOKEN = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")
TEXTS = [None, "", " ", "a", "  a b\tc \n", "é à　b \U0001f600x", "<P> here", "un <S>", "<M>", "almost < P> <S", "  nbsp ", "x" * 5000 + " " + "é" * 70000,
         "\U0001f600 " * 3000, "a\x0b\x0cb\r\n", "\x1c\x85 z", "<<P ><S<M", "\x00 nul \x00"]


def plain_middle(doc_id, text, unit="token", rate=50, spm_rate=80, seed=42):
    text = text or ""
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * i : 8 * i + 8], 16) for i in range(4)]
    units = TOKEN.findall(text) if unit == "token" else list(text)
    n = len(units)
    if not text or any(s in text for s in ("<P>", "<S>", "<M>")) or h[2] % 100 >= rate:
        return n, "plain", None, None, text
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if h[3] % 100 < spm_rate:
        return n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


@pytest.mark.parametrize("unit,rate,spm_rate", [("token", 50, 80), ("token", 100, 0), ("char", 100, 50)])
def test_middle_equals_plain_version_and_goes_back(spark, make_docs, unit, rate, spm_rate):
    rows = [(i * 7 + j, t, "s") for j in range(7) for i, t in enumerate(TEXTS)] + [(None, "no id é", "s"), (3, "same id", "s"), (3, "same id", "s")]
    docs = make_docs(rows).withColumnRenamed("shard", "fim").withColumnRenamed("__id", "__bytes").withColumnRenamed("__key", "__draws")
    done = fill_middle.fill_in_middle(docs, unit=unit, rate=rate, spm_rate=spm_rate)
    assert set(done.columns) == set(docs.columns)  # fim stands for the column of that name
    got = done.select("doc_id", "text", "fim.*", fill_middle.restored(F.col("fim.output"), F.col("fim.form")).alias("back"), "__bytes").collect()
    assert sorted((str(r.doc_id), r.text or "", *r[2:7]) for r in got) == sorted((str(i), t or "", *plain_middle(i, t, unit, rate, spm_rate)) for i, t, _ in rows)
    assert all(r.back == (r.text or "") and r["__bytes"] == "extra" for r in got)
    assert rate < 100 or {"psm", "spm"} >= {r.form for r in got} - {"plain"} != set()


def test_middle_of_no_rows(spark, make_docs):
    assert fill_middle.fill_in_middle(make_docs([])).count() == 0
    with pytest.raises(ValueError):
        fill_middle.fill_in_middle(make_docs([]), unit="word")


def test_index_of_exceptions_converts_every_cut():
    for text in ("", "plain", "é", "aé中\U0001f600z", "\U0001f600" * 9 + "a" * 9):
        index = fill_middle.Exceptions(np.frombuffer(text.encode(), np.uint8))
        assert index.n_chars == len(text) and len(index.chars) == sum(ord(c) > 127 for c in text)
        for i in range(len(text) + 1):
            at = len(text[:i].encode())
            assert index.to_bytes(i) == at and index.to_chars(at) == i


def plain_topk(rows, every, k, scale=64):
    usable = [(i, tuple(int(np.floor(float(np.float32(x)) * scale)) for x in v)) for i, v in rows if v is not None and all(x is not None and np.isfinite(x) for x in v)]
    usable = sorted(set(usable), key=str)
    out = []
    for q in usable:
        if q[0] is not None and q[0] % every == 0:
            found = [(-sum(a * b for a, b in zip(q[1], c[1])), c[0] is None, c[0] or 0, c) for c in usable if c != q and len(c[1]) == len(q[1])]
            for r, (s, _, _, c) in enumerate(sorted(found)[:k]):
                out.append((q[0], r + 1, c[0], min(max(-s, -(2**63)), 2**63 - 1)))
    return sorted(out, key=str)


def asked(spark, rows, every=20, k=20):
    df = spark.createDataFrame([(*r, "x", "y") for r in rows], "vec_id long, embedding array<float>, at string, id2 string")
    return sorted(map(tuple, topk.best_matches(df, F.col("id") % every == 0, k=k).collect()), key=str)


def test_topk_equals_brute_force(spark, monkeypatch):
    rng = np.random.default_rng(5)
    rows = [(i, rng.normal(0, 0.3, 12).astype("float32").tolist()) for i in range(700)]
    rows += [(1000 + i, rows[3][1]) for i in range(300)]  # a third of all rows are copies
    rows += [(2000 + i, [0.01 * (i % 3)] * 12) for i in range(60)]  # near ones that tie
    assert asked(spark, rows) == plain_topk(rows, 20, 20)
    for name, value in (("ASKED", 16), ("STORED", 100), ("BLOCK", 37), ("SAME", 4), ("SLICE", 5)):
        monkeypatch.setattr(topk, name, value)
    monkeypatch.setattr(topk.approximation_file, "__defaults__", (64, 4, 37))
    assert asked(spark, rows) == plain_topk(rows, 20, 20)


def test_topk_of_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.5]), (0, [1.0, 0.5]), (0, [0.2, -0.5]), (20, None), (40, [nan, 1.0]), (60, [1.0, None]), (80, [inf, 1.0]), (100, []), (101, []), (120, [3.0]), (-20, [1.0, 0.4]),
            (None, [1.0, 0.5]), (None, [9.0, 9.0]), (7, [1e30, -1e30]), (8, [3e38, 3e38]), (140, [2e38, 1e38]), (9, [-3e38, -3e38]), (10, [-0.0, 0.0]), (11, [0.0, -0.0]), (160, [1.0, 2.0, 3.0])]
    assert asked(spark, rows, k=3) == plain_topk(rows, 20, 3)
    assert asked(spark, rows, k=50) == plain_topk(rows, 20, 50)
    assert asked(spark, []) == [] and asked(spark, [(1, [1.0])]) == [] and asked(spark, [(0, [1.0])]) == []


def test_equal_rows_of_one_id_are_rows_of_their_own_in_the_query(spark, tmp_path):
    rng = np.random.default_rng(7)
    rows = [(i, rng.normal(0, 0.3, 8).astype("float32").tolist()) for i in range(60)]
    rows += rows[:21] + [rows[20]] * 30 + [(None, rows[3][1])] * 3
    spark.createDataFrame(rows, "vec_id long, embedding array<float>").write.parquet(str(tmp_path / "embeddings.parquet"))
    expected = []
    v = [[int(np.floor(64 * float(x))) for x in r[1]] for r in rows]
    for a, (i, _) in enumerate(rows):
        if i is not None and i % 20 == 0:
            found = sorted((-sum(x * y for x, y in zip(v[a], v[b])), j is None, j or 0, j) for b, (j, _) in enumerate(rows) if b != a)[:20]
            expected += [(i, n + 1, j, -s) for n, (s, _, _, j) in enumerate(found)]
    assert sorted(map(str, map(tuple, queries.op12_topk(spark, str(tmp_path)).collect()))) == sorted(map(str, expected))


def test_large_components_keep_their_places(spark):
    far = 2.0**52
    rows = [(0, [far, 0.0, 1.0]), (1, [0.0, far, 1.0]), (2, [1.0, 0.0, 0.0])]
    _, classes = topk.vector_classes(spark.createDataFrame(rows, "vec_id long, embedding array<float>"), "vec_id", "embedding", 64, 3)
    assert classes.count() == 3


def test_cells_bound_and_prune():
    rng = np.random.default_rng(2)
    v, q = np.floor(rng.normal(0, 8, (3000, 64))), np.floor(rng.normal(0, 8, (50, 64)))
    lower, upper = topk.bounds(q, *topk.approximated(v))
    exact = q @ v.T
    assert (lower <= exact).all() and (exact <= upper).all()
    kth = np.partition(lower, -20, axis=1)[:, -20:-19]
    assert (upper >= kth).sum(axis=1).mean() < 90  # exact vectors are read for a few times the list, a few per cent of the rows


def plain_variants(texts, every=199, min_length=6, min_count=5, factor=5):
    counts = Counter()
    lower = str.maketrans(spelling.UPPER, spelling.LOWER)
    for i, t in texts:
        for run in re.findall(r"[A-Za-zÀ-ÿ]+", t or ""):
            run = run.translate(lower)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            counts[run[: h % len(run)] + run[h % len(run) + 1 :] if h % every == 0 else run] += 1
    return near_of({w: n for w, n in counts.items() if len(w) >= min_length and n >= min_count}, factor)


def near_of(words, factor=5):
    near, patterns = defaultdict(set), defaultdict(list)
    for w in words:
        for i in range(len(w)):
            patterns[w[:i], w[i + 1 :]].append(w)
            if w[:i] + w[i + 1 :] in words:
                near[w].add(w[:i] + w[i + 1 :])
                near[w[:i] + w[i + 1 :]].add(w)
    for some in patterns.values():
        for w in some:
            near[w] |= set(some) - {w}
    best = {w: min(near[w], key=lambda o: (-words[o], o)) for w in words if near[w]}
    form = {w: b for w, b in best.items() if words[b] >= factor * words[w]}

    def root(w):
        while w in form:
            w = form[w]
        return w

    return sorted(((w, form.get(w), root(w), n, len(near[w]), words[form[w]] if w in form else None) for w, n in words.items()), key=str)


COLUMNS = ["word", "form", "root", "n", "n_near", "form_n"]


@pytest.mark.parametrize("block", [1024, 3])
def test_variants_equal_plain_version(spark, block):
    rng = random.Random(8)
    words = {}
    for _ in range(60):
        w = "".join(rng.choice("abé") for _ in range(rng.randint(6, 14)))
        for _ in range(12):
            i, c = rng.randrange(len(w)), rng.choice("abéÿ×")
            words[rng.choice((w[:i] + c + w[i + 1 :], w[:i] + w[i + 1 :], w[:i] + c + w[i:], w))] = rng.choice((5, 6, 30, 200, 2000))
    words |= {"a" * k: 5**k for k in range(6, 15)}  # a chain of forms
    words |= {"common" + c + d: 7 for c in "abcdefgh" for d in "abcdefgh"}  # a full key and ties
    words |= {"x" * 3000: 5, "x" * 3001: 50, "y" * 2999 + "z": 5}
    words = {w: n for w, n in words.items() if len(w) >= 6}
    df = spark.createDataFrame(list(words.items()), "word string, n long")
    got = spelling.spelling_variants(df, block=block).select(*COLUMNS)
    assert sorted(map(tuple, got.collect()), key=str) == near_of(words)
    assert max(words.values()) >= 5**14 and any(r[1] != r[2] and r[1] for r in near_of(words))


def test_variants_of_texts(spark, make_docs):
    rng = random.Random(3)
    base = ["Spelling", "variANTs", "Éclairs", "straße", "naïvely", "MULTI×PLY", "short", "x" * 500]
    rows = [(i, " ".join(rng.choices(base, k=30)) + ("1 " + base[i % 8]) * 3, "s") for i in range(150)]
    rows += [(None, "nullid nullid nullid nullid nullid", "s"), (5, None, "s"), (6, "", "s"), (7, "repeated " * 3, "s"), (7, "repeated " * 3, "s"), (8, "tab\tseparé-d " * 9, "s")]
    for every in (199, 5):
        got = spelling.spelling_variants(spelling.word_counts(make_docs(rows), every=every)).select(*COLUMNS).collect()
        assert sorted(map(tuple, got), key=str) == plain_variants([(i, t) for i, t, _ in rows], every)
    assert any(r.form for r in got)
    assert spelling.spelling_variants(spelling.word_counts(make_docs([(1, None, "s")]))).count() == 0
    assert spelling.spelling_variants(spelling.word_counts(make_docs([]))).count() == 0
