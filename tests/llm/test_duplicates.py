import random
import re

import numpy as np

from boutlens.llm import lines, neardup

R = random.Random(7)


def prose(n):
    return " ".join("".join(R.choice("abcdefg") for _ in range(R.randint(2, 6))) for _ in range(n))


def edited(t, k):
    words = t.split()
    for _ in range(k):
        words[R.randrange(len(words))] = "zz" + str(R.randrange(99))
    return " ".join(words)


def corpus():
    rows, n = [], 0
    for group in range(6):
        base = prose(R.choice((8, 60, 200)))
        for k in range(R.choice((1, 2, 12))):
            rows.append((n, edited(base, R.choice((0, 1, 2, 5))), "s"))
            n += 1
    # a chain: neighbours are alike, its ends are not
    words = prose(200).split()
    for k in range(6):
        rows.append((n, " ".join(words[k * 6 : k * 6 + 150]), "s"))
        n += 1
    return [*rows, (900, None, "s"), (901, "", "s"), (902, " \t", "s"), (903, "one two", "s"), (904, "ONE  two", "s"), (905, "one", "s"), (906, rows[0][1], "s"), (906, rows[0][1], "s"), (None, rows[0][1], "s"), (907, "é É two x", "s")]


def brute(rows, size, threshold):
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")

    def shingles(t):
        w = re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(lower))
        return {tuple(w[i : i + size]) for i in range(len(w) - size + 1)} if len(w) >= size else {tuple(w)} if w else set()

    sets = {i: shingles(t) for i, t, _ in rows if i is not None}
    parent = {i: i for i in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in sets:
        for b in sets:
            both = len(sets[a] & sets[b])
            if a < b and both and 100 * both >= threshold * len(sets[a] | sets[b]):
                x, y = root(a), root(b)
                parent[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), root(i)) for i in sets}


def test_near_duplicates_equal_brute_force(make_docs):
    rows = corpus()
    docs = make_docs(rows)
    for size, threshold in ((3, 85), (5, 80)):
        got = neardup.near_duplicates(docs, shingle=size, threshold=threshold).collect()
        assert len(got) == len(rows)
        expected = brute(rows, size, threshold)
        for r in got:
            if r.doc_id is None:
                assert r.component_id is None and r.kept
            else:
                assert (r.n_shingles, r.component_id) == expected[r.doc_id]
                assert r.kept == (r.doc_id == r.component_id)


def test_registers_agree_with_the_chance_of_the_similarity():
    r = np.random.default_rng(4)
    with np.errstate(over="ignore"):
        for size, share in ((1, 1.0), (10, 0.8), (40, 0.85), (500, 0.8), (5000, 0.5)):
            same = []
            for _ in range(60):
                h = np.unique(r.integers(1, 1 << 63, size, dtype=np.uint64))
                both = round(share * len(h))
                apart = (len(h) - both) // 2
                a, b = np.sort(h[: both + apart]), np.sort(np.r_[h[:both], h[both + apart :]])
                same.append((neardup.registers(a, 160) == neardup.registers(b, 160)).mean())
            assert abs(np.mean(same) - round(share * size) / size) < 0.02
            assert np.std(same) < 1.3 * (share * (1 - share) / 160) ** 0.5 + 1e-9
        unlike = [(neardup.registers(r.integers(1, 1 << 63, n, dtype=np.uint64), 160) == neardup.registers(r.integers(1, 1 << 63, n, dtype=np.uint64), 160)).mean() for n in (1, 9, 900)]
        assert max(unlike) < 0.02


def test_large_buckets_are_cut_without_losing_links(make_docs, monkeypatch):
    monkeypatch.setattr(neardup, "SPLIT", 3)
    rows = corpus()
    got = {r.doc_id: r.component_id for r in neardup.near_duplicates(make_docs(rows), meetings=0).collect()}
    assert all(got[i] == root for i, (_, root) in brute(rows, 5, 80).items())


def test_one_document_of_each_group_stays(make_docs):
    rows = corpus()
    docs = make_docs(rows)
    left = neardup.deduplicated(docs)
    assert left.columns == docs.columns
    roots = {root for _, root in brute(rows, 5, 80).values()}
    assert sorted(r.doc_id for r in left.collect() if r.doc_id is not None) == sorted(roots)


def test_different_texts_of_one_id_stay(make_docs):
    a, b = prose(40), prose(40)
    rows = [(1, a, "s"), (1, a, "s"), (1, b, "s"), (2, prose(40), "s"), (3, a, "s")]
    got = sorted((r.doc_id, r.text) for r in neardup.deduplicated(make_docs(rows)).collect())
    assert got == sorted([(1, a), (1, b), (2, rows[3][1])])


def test_every_text_of_a_repeated_id_links_it(make_docs):
    words = lambda seed, n=60: [f"{seed}{k}" for k in range(n)]
    one, other = " ".join(words("a")), " ".join(words("b"))
    rows = [(5, one, "s"), (5, other, "s"), (5, " ", "s"), (5, None, "s"), (5, one, "s"), (7, one + " more", "s"), (9, other + " more", "s"), (3, " ".join(words("c")), "s"), (3, one.upper(), "s")]
    got = neardup.near_duplicates(make_docs(rows), shingle=3, threshold=85).select("doc_id", "component_id", "kept").distinct().collect()
    assert sorted(map(tuple, got)) == [(3, 3, True), (5, 3, False), (7, 3, False), (9, 3, False)]
    without = neardup.near_duplicates(make_docs([r for r in rows if r[0] != 3]), shingle=3, threshold=85).select("doc_id", "component_id").distinct().collect()
    assert sorted(map(tuple, without)) == [(5, 5), (7, 5), (9, 5)]


def test_nothing_in_nothing_out(make_docs):
    empty = make_docs([])
    assert neardup.near_duplicates(empty).count() == 0 and neardup.deduplicated(empty).count() == 0
    assert lines.drop_recurring(empty).count() == 0


def test_components_are_the_smallest_reachable(spark):
    edges = [(i, i + 1) for i in range(50)] + [(100, 200), (200, 150), (7, 7)]
    got = {r.node: r.component for r in neardup.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(51)}, 100: 100, 150: 100, 200: 100}


def test_recurring_lines_go_but_for_the_first(make_docs):
    boiler = "All rights reserved by the owner 2021"
    passage = prose(60)
    rows = [(i, f"{prose(20)}\n{boiler.replace('2021', str(2021 + i))}\n{passage if i % 2 else prose(9)}\nok", "s") for i in range(8)]
    rows += [(50, None, "s"), (51, "", "s"), (52, boiler, "s"), (53, f"\n\n{boiler}\n", "s"), (None, boiler, "s"), (54, prose(3000) + "\n" + boiler, "s")]
    got = {r.doc_id: r.line_dedup for r in lines.drop_recurring(make_docs(rows)).collect()}
    assert got[0].dropped == [] and got[0].text == rows[0][1]
    assert got[1].dropped == [1] and got[3].dropped == [1, 2] and got[2].dropped == [1]  # the passage stays in the first that has it
    assert got[50].text is None and got[50].dropped == [] and got[51].text == ""
    assert got[52].text == "" and got[53].text == "\n\n" and got[None].text == "" and got[54].dropped == [1]
    left = lines.deduplicated(make_docs(rows)).collect()
    ids = [r.doc_id for r in left]
    assert 52 not in ids and 53 not in ids and None not in ids and {50, 51, 54} <= set(ids)
    assert all(r.n_chars == len(r.text) for r in left if r.text is not None)


def test_a_variable_stretch_generalises_and_prose_stays(make_docs):
    head, tail = "user session for account", "was closed after the usual check by our system today"
    rows = [(i, f"{head} {prose(2)} {tail}", "s") for i in range(5)] + [(10 + i, prose(14), "s") for i in range(20)]
    got = {r.doc_id: r.line_dedup.dropped for r in lines.drop_recurring(make_docs(rows)).collect()}
    assert [got[i] for i in range(5)] == [[], [0], [0], [0], [0]]
    assert all(got[10 + i] == [] for i in range(20))


def plain_dropped(rows, similar=0.6, min_docs=2):
    """Line dedup on token strings, a leaf at a time, without hashes (their order aside)."""
    field = lambda t: "<*>" if re.search(r"[0-9@]|://", t) else t
    texts = [(i, [tuple(map(field, line.split())) for line in t.split("\n")]) for i, t, _ in rows]
    holders, where = {}, {}
    for row, (_, found) in enumerate(texts):
        for line in set(found) - {()}:
            holders.setdefault(line, set()).add(row)
    for line in sorted(holders, key=lambda x: lines.line_hash([t.encode() for t in x])):
        n = len(line)
        places = [line[p : p + 2] for p in (0, (n - 2) // 2, n - 2)]
        # short lines by their leading tokens, long ones by two of three places
        for key in [] if n < 4 else [places[:1]] if n < 12 else [places[:2], places[1:], places[::2]]:
            where.setdefault((n, len(key) > 1 and key == places[::2], tuple(key)), []).append(line)
    recurs = {}

    def note(line, by, least):
        rows_ = set().union(*(holders[x] for x in by))
        if len(rows_) >= least:
            recurs.setdefault(line, []).append(min(texts[r][0] for r in rows_))

    for line in holders:
        note(line, [line], min_docs * 5 if len(line) == 1 else min_docs + (len(line) == 2 or set(line) == {"<*>"}))
    for (n, *_), leaf in where.items():
        need = max(3, -int(-similar * n // 1))
        left = list(leaf)
        while left:
            template, group = list(left[0]), [left[0]]
            agree = lambda x, t: sum(a == b for a, b in zip(x, t))
            near = [x for x in left[1:] if agree(x, left[0]) >= need]
            for x in sorted(near, key=lambda x: -agree(x, left[0])):
                same = [a if a == b else None for a, b in zip(x, template)]
                if sum(a is not None for a in same) >= need and sum(a not in (None, "<*>") for a in same) >= 2:
                    template, group = same, [*group, x]
            for x in group if len(group) > 1 else ():
                note(x, group, min_docs + 1)
            left = [x for x in left if x not in group]
    return {i: [k for k, line in enumerate(found) if any(first != i for first in recurs.get(line, ()))] for i, found in texts}


def test_dropped_lines_equal_a_plain_version(make_docs, monkeypatch):
    base = [prose(n) for n in (4, 5, 8, 14, 40)]
    pick = lambda: R.choice(["alpha beta gamma", "x y z 12", "only two", "one", f"at {R.randrange(99)}:00 {prose(1)} came in here", prose(15), edited(R.choice(base), R.choice((0, 1, 2)))])
    rows = [(i, "\n".join(pick() for _ in range(6)), "s") for i in range(40)]
    expected = plain_dropped(rows)
    assert sum(map(len, expected.values())) > 60
    got = {r.doc_id: r.line_dedup.dropped for r in lines.drop_recurring(make_docs(rows)).collect()}
    assert got == expected


def test_leaves_of_short_tokens_are_apart():
    pairs = [[a.encode(), b.encode()] for a in "abcdefgh" for b in ("a", "b", "ab", "abc", "abcd")]
    found = {}
    for n in range(4, 60):
        for pair in pairs:
            line = (pair * n)[:n]
            places = [tuple(line[p : p + 2]) for p in (0, (n - 2) // 2, n - 2)]
            for k, leaf in enumerate(lines.leaves(line)):
                if leaf:
                    found.setdefault(leaf, set()).add((n, k, places[k - 1] + places[k]) if n >= lines.LONG else (n, places[0]))
    assert all(len(x) == 1 for x in found.values())


def test_a_leaf_in_parts_is_merged(make_docs, monkeypatch):
    monkeypatch.setattr(lines, "LINES", 7)
    rows = [(i, f"Posted by {prose(1)}x{'abcdefgh'[i % 8]} in {prose(1)} today", "s") for i in range(90)]
    got = {r.doc_id: r.line_dedup.dropped for r in lines.drop_recurring(make_docs(rows)).collect()}
    assert [got[i] for i in range(90)] == [[], *[[0]] * 89]


def test_pairs_short_lines_and_worded_fields_recur(make_docs):
    passage, few = prose(60), prose(4)
    first = [f"{a} {b} {prose(3)} until the shop {c} at the old market gate" for a, b, c in (("Anna", "Lee", "opens"), ("Bert", "Kay", "closes"), ("Cleo", "Roe", "moves"))]
    rows = [(i, f"{prose(30)}\n{passage}\n{few}", "s") for i in (1, 2)]
    rows += [(10 + i, f"Posted by {name} in {part}\n{first[i]}", "s") for i, (name, part) in enumerate((("Anna", "Sports"), ("Bert", "News"), ("Cleo", "Arts")))]
    rows += [(20 + i, f"{prose(9)}\nRead more\n{'Share' if i < 12 else 'Rare'}", "s") for i in range(15)]
    got = {r.doc_id: r.line_dedup.dropped for r in lines.drop_recurring(make_docs(rows)).collect()}
    assert got[1] == [] and got[2] == [1, 2]
    assert got[10] == [] and got[11] == [0] and got[12] == [0]
    # two tokens from three documents on, one token from ten on
    assert got[20] == [] and got[25] == [1, 2] and got[33] == [1]


def test_fields_at_the_start_or_the_end_of_a_line_recur(make_docs):
    rest = "was seen by the guard near the old gate behind our market"
    rows = [(i, f"{prose(2)} {rest}\nIt {rest} {prose(3)}", "s") for i in range(4)]
    got = {r.doc_id: r.line_dedup.dropped for r in lines.drop_recurring(make_docs(rows)).collect()}
    assert [got[i] for i in range(4)] == [[], [0, 1], [0, 1], [0, 1]]


def lines_gone(make_docs, wanted, noise):
    rows = [(k, line, "s") for k, line in enumerate(wanted)]
    rows += [(1_000 + k, "\n".join(noise[k::20]), "s") for k in range(20)]
    got = {r.doc_id: r.line_dedup.dropped for r in lines.drop_recurring(make_docs(rows)).collect()}
    assert not any(got[1_000 + k] for k in range(20))  # the noise stays
    return [got[k] for k in range(len(wanted))]


def test_noise_in_a_leaf_changes_nothing(make_docs):
    """The same lines of a template go whatever else stands in their leaf, in short and in long lines."""
    word = lambda: "".join(R.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(7))
    short = [f"posted by {word()} under general news and archive" for _ in range(12)]
    body = [word() for _ in range(14)]
    long_ = []
    for k in range(12):
        tokens = list(body)
        tokens[3] = word()
        tokens[9 + k % 2] = word()
        long_.append(" ".join(tokens))
    beside_short = [" ".join(["posted", "by", *(word() for _ in range(6))]) for _ in range(20_000)]
    middle = (14 - lines.LEADING) // 2
    same = {0, 1, middle, middle + 1}
    beside_long = [" ".join(body[i] if i in same else word() for i in range(14)) for _ in range(4_000)]
    both = ["\n".join(pair) for pair in zip(short, long_)]
    alone = lines_gone(make_docs, both, [""])
    assert alone == [[]] + [[0, 1]] * 11
    assert lines_gone(make_docs, both, beside_short + beside_long) == alone


def test_the_blocks_of_a_line_cover_its_places(spark):
    rows = []
    for n in range(lines.LEAST, 60):
        codes = np.arange(1, n + 1).astype(lines.WIDTHS[n < lines.LONG])
        rows.append((n, int(n < lines.LONG), bytearray(codes.tobytes())))
    df = spark.createDataFrame(rows, "n int, leaf long, codes binary")
    for n, many, *got in df.select("n", lines.blocks(0.6), *[lines.block(lines.F.lit(k), 0.6) for k in range(lines.PLACES)]).collect():
        assert many == min(n - max(3, -(-6 * n // 10)) + 1, lines.PLACES)
        taken = [np.frombuffer(bytes(x), lines.WIDTHS[n < lines.LONG]).tolist() for x in got[:many]]
        assert all(taken) and all(x[-1] < y[0] for x, y in zip(taken, taken[1:]))
        if many < lines.PLACES:
            assert sum(taken, []) == list(range(1 + lines.LEADING * (n < lines.LONG), n + 1))
