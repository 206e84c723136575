import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from boutlens.llm import mixing, packing

WORDS = [f"w{i}" for i in range(50)]


def text(r, n):
    return " ".join(r.choice(WORDS) for _ in range(n))


def bound(sizes):
    return packing.dual_bound(packing.counts_of(np.array(sizes), 1024), 1024)


@pytest.fixture(scope="module")
def docs(make_docs):
    r = random.Random(1)
    rows = [(i, text(r, r.choice((0, 3, 40, 400, 3000))), r.choice(("a", "b", None, "hot", "hot", "hot"))) for i in range(60)]
    rows += [(100, None, "a"), (101, "", "b"), (102, " \n\t ", None), (103, "same words", "a"), (103, "same words", "a"), (None, "no id", "b"), (104, "x" * 5000, "é")]
    return make_docs(rows)


def test_pieces_are_whole_and_sequences_gapless(docs):
    rows = packing.pack_documents(docs, digest=F.col("ids")).collect()
    by_row, sequences = {}, {}
    tokenizer = packing.reference_tokenizer()
    for r in rows:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
        by_row.setdefault((r.doc_id, r.start == 0), []).append(r)
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= packing.SEQUENCE
    for d in docs.select("doc_id", "text").distinct().collect():
        ids = [*tokenizer.encode(d.text or "", add_special_tokens=False).ids, packing.END]
        pieces = sorted({(r.piece, r.start, bytes(r.digest)) for r in rows if r.doc_id == d.doc_id})
        assert np.frombuffer(b"".join(p[2] for p in pieces), "<u4").tolist() == ids
        assert [len(p[2]) // 4 for p in pieces][1:] == [packing.SEQUENCE] * (len(pieces) - 1)
    assert len(sequences) <= bound([r.length for r in rows]) + 1
    assert sum(r.doc_id == 103 for r in rows) == 2


def test_special_strings_and_long_runs_are_encoded_alike():
    tokenizer = packing.reference_tokenizer()
    for t in ("a <|endoftext|> b", " " * 3000 + "x", "é" * 700, "1234567 !!! \n\n  x\u2009y", "ab" * 4000):
        assert packing.token_ids(t, packing.vocabulary_path()) == tokenizer.encode(t, add_special_tokens=False).ids


def test_empty_table_packs_to_nothing(docs):
    assert packing.pack_documents(docs.limit(0)).count() == 0


def test_bounds_hold_and_best_fit_is_near_them():
    r = np.random.default_rng(3)
    for _ in range(40):
        sizes = r.integers(1, 1024, r.integers(1, 300))
        sequence, offset, fill = packing.best_fit_decreasing(sizes, 1024)
        assert fill.max() <= 1024 and fill.sum() == sizes.sum()
        assert bound(sizes) <= len(fill) <= 1.2 * bound(sizes) + 2
    assert bound([600, 600, 600]) == 3
    assert bound([400] * 5) == 3


def test_partitions_with_gaps_exchange_and_never_get_worse(spark):
    r = np.random.default_rng(5)
    sizes = r.integers(200, 700, 600).tolist()
    pieces = spark.createDataFrame(list(enumerate(map(int, sizes))), "serial long, length long")
    many = packing.pack(pieces, per_partition=20).select("sequence_id").distinct().count()
    first = packing.pack(pieces, per_partition=20, rounds=0).select("sequence_id").distinct().count()
    assert bound(sizes) <= many <= first


def test_sequences_of_all_rounds_have_numbers_of_their_own(spark):
    r = np.random.default_rng(6)
    sizes = [*r.integers(1, 1025, 900).tolist(), *[1024] * 20, *[1] * 50]
    pieces = spark.createDataFrame(list(enumerate(map(int, sizes))), "serial long, length long")
    rows = packing.pack(pieces, per_partition=30).collect()
    assert sorted(r.serial for r in rows) == list(range(len(sizes)))
    opened = {}
    for row in sorted(rows, key=lambda row: (row.sequence_id, row.offset)):
        assert row.offset == opened.get(row.sequence_id, 0)
        assert row.offset or row.sequence_id == row.serial  # the number is that of the first piece
        opened[row.sequence_id] = row.offset + row.length
    assert max(opened.values()) <= 1024 and bound(sizes) <= len(opened) <= 1.2 * bound(sizes)


def test_exchange_goes_on_until_nothing_is_won(spark):
    r = np.random.default_rng(3)
    sizes = spark.createDataFrame([(i, int(n)) for i, n in enumerate(r.integers(200, 700, 3000))], "serial long, length long")
    few, all_ = (packing.pack(sizes, per_partition=100, rounds=n).agg(F.count_distinct("sequence_id")).first()[0] for n in (0, None))
    assert packing.total_bound(sizes, 1024) <= all_ < few


def targets(sizes):
    """The contract, step by step: shares by weight, the excess shared again until no target is above its cap."""
    order = sorted(sizes, key=lambda s: (s is None, s))
    weight = {s: i % 3 + 1 for i, s in enumerate(order)}
    total, capped = sum(sizes.values()), set()
    while True:
        rest = total - sum(3 * sizes[s] for s in capped)
        level = rest / max(1e-12, sum(weight[s] for s in order if s not in capped))
        over = {s for s in order if s not in capped and weight[s] * level > 3 * sizes[s] + 1e-9}
        if not over:
            return {s: 3 * sizes[s] if s in capped else weight[s] * level for s in order}
        capped |= over


def test_mix_meets_targets_and_caps(docs):
    documents, sources, slots = mixing.mix(docs, block=16, shard=32)
    rows = mixing.taken(documents, sources, slots, block=16).collect()
    size = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    assert len(rows) == docs.count()
    sizes, got = {}, {}
    for d in docs.collect():
        sizes[d.source] = sizes.get(d.source, 0) + size(d.text)
    for r in rows:
        assert r.taken <= 3 * r.size and r.source_size == sizes[r.source]
        got[r.source] = got.get(r.source, 0) + r.taken
    for s, t in targets(sizes).items():
        assert next(r.target for r in rows if r.source == s) == pytest.approx(t)
        assert t - 2 * 16 <= got[s] <= t + 1e-6
    again = mixing.taken(*mixing.mix(docs.repartition(3), block=16, shard=32), block=16).collect()
    assert sorted(map(str, again)) == sorted(map(str, rows))


def test_shards_draw_multinomial_counts(docs):
    _, sources, slots = mixing.mix(docs, block=16, shard=32)
    quota = {r["rank"]: r.quota for r in sources.collect()}
    rows = slots.collect()
    total, got = sum(quota.values()), {}
    for r in rows:
        got.setdefault(r["rank"], []).append(r)
    assert {k: sorted(r.slot for r in v) for k, v in got.items()} == {k: list(range(n)) for k, n in quota.items() if n}
    shards = -(-total // 32)
    for rank, n in quota.items():
        # counts of the shards spread as those of independent draws do, before the quota is met
        counts = [sum(r.shard == k for r in got[rank]) for k in range(shards)]
        p = n / total
        if 0.1 < p < 0.9 and shards > 20:
            assert 0.4 * 32 * p * (1 - p) < np.var(counts) < 2.5 * 32 * p * (1 - p)
    # no block is used more than once within a pass
    blocks = {r["rank"]: r.blocks for r in sources.collect()}
    for rank, v in got.items():
        assert len({(r.slot // blocks[rank], r.block) for r in v}) == len(v)


def test_permutation_is_one(spark):
    for n in (1, 2, 7, 100):
        df = spark.range(n).select(mixing.permuted(F.col("id"), F.lit(n).cast("long"), F.lit(5)).alias("x"))
        assert sorted(r.x for r in df.collect()) == list(range(n))


def test_mixed_documents_hold_the_words_taken(docs):
    rows = mixing.mixed_documents(docs, block=16, shard=32).collect()
    taken = mixing.taken(*mixing.mix(docs, block=16, shard=32), block=16).collect()
    count = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    words, wanted = {}, {}
    for r in rows:
        words[r.doc_id] = words.get(r.doc_id, 0) + count(r.text)
        assert r.n_chars == len(r.text) and r.shard == "extra"
    for r in taken:
        wanted[r.doc_id] = wanted.get(r.doc_id, 0) + r.taken
    assert words == {k: v for k, v in wanted.items() if v}


def test_copies_in_several_sources_give_what_each_source_takes(make_docs):
    r = random.Random(4)
    same = text(r, 900)
    rows = [(1, same, "A"), (1, same, "B"), (1, same, "B"), (1, same, None), (None, same, "A"), (None, same, "C")]
    rows += [(k, text(r, 300), s) for k, s in enumerate("AABCCCDDDD", 10)]
    docs = make_docs(rows)
    taken = mixing.taken(*mixing.mix(docs)).groupBy("doc_id", "source").agg(F.sum("taken").alias("n")).filter("n > 0")
    mixed = mixing.mixed_documents(docs).groupBy("doc_id", "source").agg(F.sum(mixing.n_words(F.col("text"))).alias("n"))
    assert sorted(map(str, taken.collect())) == sorted(map(str, mixed.collect()))
    assert len({row.n for row in taken.collect()}) > 3


def test_mix_of_nothing(docs):
    assert mixing.taken(*mixing.mix(docs.limit(0))).count() == 0
    blank = docs.withColumn("text", F.lit(None).cast("string"))
    assert {r.taken for r in mixing.taken(*mixing.mix(blank)).collect()} == {0}
