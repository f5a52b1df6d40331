import hashlib
import random
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tests.comparing import same
from tidemark.llm import oracles
from tidemark.llm.common import dropped, staged
from tidemark.llm.components import connected_components
from tidemark.llm.exact_dedup import drop_exact_duplicates, exact_dedup
from tidemark.llm.minhash import Sketcher, drop_near_duplicates, near_duplicates, shingles
from tidemark.llm.queries import queries


@pytest.mark.parametrize("name", ["op5_exact_dedup", "op10_minhash_near_dedup"])
def test_equals_sql(spark, small, name):
    same(queries()[name](spark, small), oracles.SQL[name], small)


def test_exact_edges(crowded, no_rows):
    rows = [tuple(r) for r in exact_dedup(crowded).collect()]
    assert len(rows) == crowded.count()
    by = {}
    for i, keep, size, kept, digest in rows:
        by.setdefault(digest, set()).add((i, keep, size, kept))
    text = lambda s: hashlib.sha256(s.encode()).hexdigest()
    assert by[text("same text here")] == {(1, 1, 4, True), (2, 1, 4, False), (None, 1, 4, False)}
    assert by[text("")] == {(3, 3, 2, True), (4, 3, 2, False)}
    assert by[text("only text")] == {(None, None, 1, True)}
    assert by[text(" ")] == {(6, 6, 1, True)}
    kept = drop_exact_duplicates(crowded)
    assert kept.columns == crowded.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == ["1", "3", "5", "6", "7", "None"]
    assert exact_dedup(no_rows).count() == drop_exact_duplicates(no_rows).count() == 0


def test_colliding_hashes_are_split_by_bytes(docs):
    texts = ["aa", "bb", "aa", "c", "bb", "d", "aa"]
    weak = lambda t: F.length(t)  # noqa: E731  almost everything collides
    rows = {r.doc_id: (r.keep_id, r.group_size, r.kept) for r in exact_dedup(docs(*texts), hash_of=weak).collect()}
    assert rows == {i: (texts.index(t), texts.count(t), texts.index(t) == i) for i, t in enumerate(texts)}


def brute(texts):
    """Components by comparing all pairs of sets."""
    sets = []
    for t in texts:
        words = "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "").replace("\t", " ").replace("\n", " ").split(" ")
        words = [w for w in words if w]
        sets.append({tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4))} if words else set())
    label = list(range(len(texts)))
    changed = True
    while changed:
        changed = False
        for a in range(len(texts)):
            for b in range(a):
                if label[a] != label[b] and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                    low = min(label[a], label[b])
                    label = [low if x in (label[a], label[b]) else x for x in label]
                    changed = True
    return [(len(s), x) for s, x in zip(sets, label, strict=True)]


def family(random_, n, words, edits):
    base = [f"w{random_.randrange(5000)}" for _ in range(words)]
    out = []
    for _ in range(n):
        copy = list(base)
        for _ in range(random_.randrange(edits + 1)):
            copy[random_.randrange(words)] = f"x{random_.randrange(10**6)}"
        out.append(" ".join(copy))
    return out


def test_near_duplicates_equal_brute_force(docs):
    r = random.Random(3)
    passage = " ".join(f"p{k}" for k in range(60))
    texts = [None, "", " \n\t", "One two", "one TWO", "one two three", "É é", "é é"]
    for words, edits in ((6, 1), (12, 1), (30, 2), (80, 5), (150, 12), (400, 20)):
        texts += family(r, 12, words, edits)
    texts += [passage + " " + " ".join(f"u{r.randrange(10**6)}" for _ in range(r.randrange(5, 90))) for _ in range(60)]
    texts += ["same words all the time again"] * 5
    chain = [f"c{k}" for k in range(100)]
    texts += [" ".join(chain[k * 6 : k * 6 + 60]) for k in range(7)]  # each overlaps with the next
    r.shuffle(texts)
    rows = {x.doc_id: (x.n_shingles, x.component_id, x.kept) for x in near_duplicates(docs(*texts)).collect()}
    assert rows == {i: (n, c, c == i) for i, (n, c) in enumerate(brute(texts))}


def test_near_edges(crowded, no_rows):
    rows = [tuple(r) for r in near_duplicates(crowded).collect()]
    assert len(rows) == crowded.count()
    assert (1, 1, 1, True) in rows and rows.count((2, 1, 1, False)) == 2
    assert (3, 0, 3, True) in rows and (4, 0, 4, True) in rows and (6, 0, 6, True) in rows
    assert all(c is None for i, _, c, _ in rows if i is None)
    kept = drop_near_duplicates(crowded)
    assert kept.columns == crowded.columns and {r.doc_id for r in kept.collect()} == {1, 3, 4, 5, 6, 7, None}
    assert near_duplicates(no_rows).count() == drop_near_duplicates(no_rows).count() == 0


def test_registers_estimate_similarity():
    sketcher, r = Sketcher(255), random.Random(1)
    for n in (8, 60, 1000):
        shared = int(n * 0.8)
        errors = []
        for _ in range(40):
            base = [r.getrandbits(63) for _ in range(2 * n)]
            import numpy as np

            a, b = (np.unique(np.array(x, np.uint64)) for x in (base[:n], base[:shared] + base[n : 2 * n - shared]))
            errors.append((sketcher.sketch(a) == sketcher.sketch(b)).mean() - shared / (2 * n - shared))
        assert abs(sum(errors) / len(errors)) < 0.03
    assert len(shingles("a b c d e f")) == 2 and len(shingles("a b")) == 1 and len(shingles(None)) == 0


def test_components_of_a_long_path_and_a_star(spark):
    path = [(k, k + 1) for k in range(100, 160)]
    star = [(7, k) for k in range(1000, 1200)]
    links = spark.createDataFrame([*path, *star, (5, 5)], "a long, b long")
    got = {r.id: r.component for r in connected_components(links).collect()}
    assert got == {k: 100 for k in range(100, 161)} | {k: 7 for k in [7, *range(1000, 1200)]}
    assert connected_components(links.limit(0)).count() == 0


def test_small_results_of_many_tasks(spark):
    """Staging a result of few rows doesn't gather the tasks that find them."""
    rows = staged(spark.range(0, 4000, 1, 8).select("id", F.spark_partition_id().alias("task")).where("id % 500 = 0"), "test-small", 8)
    assert rows.select("task").distinct().count() == 8 and len(rows.inputFiles()) == 1
    dropped(rows)
    plain = staged(spark.range(3), "test-plain")
    assert plain.count() == 3


def test_staging_starts_few_processes(spark, tmp_path):
    """Each process counts, until it runs its program, as another copy of the JVM that starts it: at most two a file."""
    jvm, df = spark.sparkContext._jvm, spark.range(0, 4000, 1, 3).withColumn("text", F.sha2(F.col("id").cast("string"), 256))
    at = lambda path: jvm.java.io.File(str(path)).toPath()
    recording = jvm.jdk.jfr.Recording()
    recording.enable("jdk.ProcessStart")
    recording.start()
    rows = staged(df, "test-processes")
    recording.dump(at(tmp_path / "record.jfr"))
    recording.close()
    started = [e.getString("command") for e in jvm.jdk.jfr.consumer.RecordingFile.readAllEvents(at(tmp_path / "record.jfr"))]
    assert len(rows.inputFiles()) == 3 and sum("test-processes" in c or "tidemark" in c for c in started) <= 6, started
    assert sorted(rows.collect()) == sorted(df.collect())
    dropped(rows)


def test_damaged_staged_tables_are_not_read(spark):
    rows = staged(spark.range(0, 4000, 1, 1).select(F.sha2(F.col("id").cast("string"), 256).alias("text")), "test-damage")
    file = Path(rows.inputFiles()[0].removeprefix("file:"))
    held = bytearray(file.read_bytes())
    held[len(held) // 2] ^= 1
    file.write_bytes(held)
    with pytest.raises(Exception, match="(?i)checksum|crc"):
        rows.agg(F.max("text")).collect()


def test_buckets_of_several_blocks(docs, monkeypatch):
    """Blocks of three members, in buckets far larger than one."""
    from tidemark.llm import minhash

    for f in (minhash._across, minhash._partnered):
        monkeypatch.setattr(f, "__defaults__", (3,))
    r = random.Random(11)
    texts = family(r, 25, 40, 6) + family(r, 25, 40, 12) + family(r, 10, 60, 3)
    rows = {x.doc_id: (x.n_shingles, x.component_id, x.kept) for x in near_duplicates(docs(*texts)).collect()}
    assert rows == {i: (n, c, c == i) for i, (n, c) in enumerate(brute(texts))}
