"""Each stage of the corpus pipeline on what the stage before kept, against a plain version."""

import random
import re

import numpy as np
import pytest

import corpus_pipeline
from boutlens.llm import mixing, packing, quality

from tests.llm.test_duplicates import brute, edited, plain_dropped

R = random.Random(21)
SIZE = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))


def fine(n):
    return " ".join(R.choice(("the", "river", "ran", "over", "old", "stones", "and", "trees", "near", "hills", "under", "grey", "skies", "for", "many", "miles")) for _ in range(n)).capitalize() + "."


@pytest.fixture(scope="module")
def folder(make_docs, spark, tmp_path_factory):
    shared, rows = fine(70), []
    for i in range(60):
        text = " ".join(R.choice(("BUY!!", "$$$", "NOW###", "WIN!!")) for _ in range(30)) if i % 6 == 5 else "\n".join(fine(R.randint(30, 90)) for _ in range(R.randint(1, 4)))
        rows.append((i, text + (f"\n{shared}" if i % 4 == 0 else ""), R.choice(("a", "b", "hot", "hot", None))))
    rows += [(100 + i, edited(rows[i][1], 1), "b") for i in range(0, 30, 7)] + [(200, rows[1][1], "a"), (201, None, "a"), (202, "", "b")]
    path = str(tmp_path_factory.mktemp("pipeline"))
    make_docs(rows).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([(i, int(i % 6 != 5)) for i in range(60)], "doc_id long, quality int").write.parquet(f"{path}/labels.parquet")
    return path


def test_stages_equal_plain_versions(spark, folder):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality classifier", "line dedup", "near-dedup", "mixing", "packing"] and corpus_pipeline.ORACLE_SQL is None
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    made = [docs]
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        df = stage(spark, made[-1], folder)
        df.write.parquet(f"{folder}/stage{k}")
        made.append(spark.read.parquet(f"{folder}/stage{k}"))
    assert all(df.columns == docs.columns for df in made[:-1])
    tables = [df.collect() for df in made]
    # 1: those whose posterior is high enough (its formula is tested with the classifier)
    kept = {r.doc_id for r in quality.judge(docs, spark.read.parquet(f"{folder}/labels.parquet")).collect() if r.kept}
    assert {r.doc_id for r in tables[1]} == kept and not any(i % 6 == 5 for i in kept if i < 60) and len(kept) > 50
    # 2: lines go as a plain tree says; what keeps nothing goes
    gone = plain_dropped([(r.doc_id, r.text or "", None) for r in tables[1]])
    expected = {r.doc_id: r.text if not gone[r.doc_id] else "\n".join(x for k, x in enumerate(r.text.split("\n")) if k not in gone[r.doc_id]) for r in tables[1]}
    expected = {i: t for i, t in expected.items() if not gone[i] or t.strip()}
    assert {r.doc_id: r.text for r in tables[2]} == expected and any(gone.values())
    # 3: one of each group by brute force
    roots = {root for _, root in brute([(r.doc_id, r.text, None) for r in tables[2]], 5, 80).values()}
    assert {r.doc_id for r in tables[3]} == roots and len(roots) < len(tables[2])
    # 4: as many words of each document as the mix takes
    wanted = {r.doc_id: r.taken for r in mixing.taken(*mixing.mix(made[3])).collect() if r.taken}
    words = {}
    for r in tables[4]:
        words[r.doc_id] = words.get(r.doc_id, 0) + SIZE(r.text)
        assert r.n_chars == len(r.text)
    assert words == wanted
    # 5: every token once, sequences without gaps
    tokenizer, sequences, tokens = packing.reference_tokenizer(), {}, 0
    for r in tables[5]:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
        tokens += r.length
    for parts in sequences.values():
        parts.sort()
        assert parts[0][0] == 0 and all(a + n == b for (a, n), (b, _) in zip(parts, parts[1:])) and sum(parts[-1]) <= packing.SEQUENCE
    assert tokens == sum(len(tokenizer.encode(r.text, add_special_tokens=False).ids) + 1 for r in tables[4])
    lengths = np.array([r.length for r in tables[5]])
    assert len(sequences) <= packing.dual_bound(packing.counts_of(lengths, packing.SEQUENCE), packing.SEQUENCE) + 1


def test_run_is_all_stages(spark, folder):
    rows = corpus_pipeline.run(spark, folder).collect()
    again = spark.read.parquet(f"{folder}/stage4").collect()
    key = lambda r: (r.doc_id, r.piece, r.start, r.length, r.ids_crc32)
    assert sorted(map(key, rows)) == sorted(map(key, again))
