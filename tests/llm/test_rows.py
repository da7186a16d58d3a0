"""Stages decide on rows: null and repeated ids, ids of other types, repeated rows, empty tables, clashing columns."""

import collections
import hashlib
import itertools
import random

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from quadrille.llm import common, decontamination, exact_dedup, near_dedup, sharding, toxicity

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def frame(spark, rows, kind="long"):
    """Documents with a number for each row, and columns whose names clash with those inside."""
    data = [(i, x, n, "x", "y", "z", "w") for n, (i, x) in enumerate(rows)]
    return spark.createDataFrame(data, f"doc_id {kind}, text string, n int, gone string, row_key string, kept_key string, digest string").repartition(4)


CASES = [
    [(1, "x"), (1, "y"), (2, "x")], [(1, "Same"), (1, "same")], [(1, None), (1, "")], [(None, "a"), (None, "A")], [(None, "a"), (3, "A"), (None, "b")], [(1, "x"), (1, "x"), (1, "x")],
    [(5, "p"), (5, "q"), (6, "q"), (7, "p"), (None, "q"), (None, "r"), (None, "R")], [],
]


@pytest.mark.parametrize("keep", ["min", "max"])
@pytest.mark.parametrize("rows", CASES)
def test_exact_copies_by_row(spark, rows, keep):
    docs = frame(spark, rows)
    left = exact_dedup.drop_copies(docs, keep=keep)
    assert left.columns == docs.columns
    stayed = [(r["doc_id"], (r["text"] or "").translate(LOWER)) for r in left.collect()]
    groups = collections.defaultdict(list)
    for i, x in rows:
        groups[(x or "").translate(LOWER)].append(i)
    best = {x: (min if keep == "min" else max)([i for i in ids if i is not None], default=None) for x, ids in groups.items()}
    assert sorted(map(str, stayed)) == sorted(str((i, x)) for x, i in best.items())
    found = exact_dedup.find_copies(docs, keep=keep).where("kept").select("doc_id", "text_sha256").collect()
    assert sorted((str(i), hashlib.sha256(x.encode()).hexdigest()) for i, x in stayed) == sorted((str(r["doc_id"]), r["text_sha256"]) for r in found)


@pytest.mark.parametrize(("kind", "ids"), [("string", ["b", "a", None, "c"]), ("double", [2.5, -1.0, None, 7.0]), ("long", [-(1 << 63), (1 << 63) - 1, None, 0])])
def test_ids_of_other_types(spark, kind, ids):
    rows = [(i, "Same") for i in ids] + [(ids[0], "other")]
    for keep, best in (("min", min), ("max", max)):
        expected = best(i for i in ids if i is not None)
        found = exact_dedup.find_copies(frame(spark, rows, kind), keep=keep).collect()
        assert {r["keep_id"] for r in found if r["group_size"] == 4} == {expected}
        assert sorted(str((r["doc_id"], r["text"])) for r in exact_dedup.drop_copies(frame(spark, rows, kind), keep=keep).collect()) == sorted(map(str, [(expected, "Same"), (ids[0], "other")]))


def test_many_repeated_ids_by_row(spark):
    rnd = random.Random(31)
    rows = [(rnd.choice([None, *range(12)]), rnd.choice("abcdefghijABCDEFGHIJ")) for _ in range(400)] + [(3, "hot")] * 200
    stayed = [(r["doc_id"], r["text"].translate(LOWER)) for r in exact_dedup.drop_copies(frame(spark, rows)).collect()]
    best = {}
    for i, x in rows:
        best[x.translate(LOWER)] = max(best.get(x.translate(LOWER), -1), -1 if i is None else i)
    assert sorted(map(str, stayed)) == sorted(str((None if i < 0 else i, x)) for x, i in best.items())


WORDS = " ".join(f"w{k}" for k in range(60))
NEAR = WORDS.replace("w59", "other")
LONE = " ".join(f"v{k}" for k in range(60))


def test_near_copies_by_row(spark):
    rows = [(1, WORDS), (2, NEAR), (2, LONE), (3, LONE + " more"), (None, NEAR), (None, "something else that is long enough"), (4, None), (5, "")]
    docs = frame(spark, rows)
    left = near_dedup.drop_near_copies(docs)
    assert left.columns == docs.columns
    # of (1, 2) the text of 1 stays, and that of the row without id goes; of (2, 3) that of 2
    assert sorted(r["n"] for r in left.collect()) == [0, 2, 5, 6, 7]


def test_toxic_rows_go_by_their_own_text(spark):
    model = toxicity.ftrl([(f, y) for f, y in [(toxicity.Features().of("vile words here"), 1), (toxicity.Features().of("kind words here"), 0)] * 40], l1=0.1)
    docs = frame(spark, [(1, "vile words"), (1, "kind words"), (None, "vile words"), (None, "kind"), (2, None), (3, "")])
    left = toxicity.drop_toxic(docs, model)
    scored = {(r["doc_id"], r["predicted"]) for r in toxicity.score(docs, model).collect()}
    assert left.columns == docs.columns and {r["n"] for r in left.collect()} >= {1, 3} and {(1, 1), (1, 0)} <= scored
    assert not {0, 2} & {r["n"] for r in left.collect()}


def test_the_model_counts_rows(spark):
    """A drawn id that very many rows repeat brings one text."""
    docs = spark.createDataFrame([(1, f"text number {k}") for k in range(500)] + [(k, f"kind {k}") for k in range(2, 30)], "doc_id long, text string")
    labels = spark.createDataFrame([(k, int(k % 2)) for k in range(1, 30)] * 3 + [(None, 1), (4, None), (6, 7)], "doc_id long, toxic int")
    seen = []
    real = toxicity.ftrl
    once = docs.dropDuplicates(["doc_id"])
    a, b = toxicity.fit(docs, labels), toxicity.fit(docs.repartition(9), labels.distinct())
    assert (a.places == b.places).all() and (a.weights == b.weights).all() and a.bias == b.bias
    assert once.count() == 29 and real is toxicity.ftrl and not seen


def test_a_window_of_very_many_items(spark):
    item = " ".join(f"w{k}" for k in range(12))
    bench = spark.createDataFrame([(k, item) for k in range(50)] + [(99, None), (100, "")], "item_id long, text string")
    sizes = [[len(items) for _, _, found in b.lengths.values() for items in found] for b in decontamination.blocks(bench, block_windows=20)]
    assert max(itertools.chain(*sizes)) <= 20 and sum(map(sum, sizes)) == 150
    docs = frame(spark, [(1, f"x {item} y"), (2, "w1 w2")])
    for block in (20, 500_000):
        found = {r["doc_id"]: (r["n_hit"], r["n_items"]) for r in decontamination.find_contamination(docs, bench, block_windows=block).collect()}
        assert found == {1: (12, 50), 2: (0, 0)}
        assert [r["n"] for r in decontamination.drop_contaminated(docs, bench, block_windows=block).collect()] == [1]


def test_blocks_are_bounded_by_bytes(spark, monkeypatch):
    monkeypatch.setattr(decontamination, "BLOCK_BYTES", 400)
    bench = spark.createDataFrame([(1, " ".join(f"word{k}" for k in range(60)))], "item_id long, text string")
    assert len(list(decontamination.blocks(bench))) > 3
    docs = frame(spark, [(1, " ".join(f"word{k}" for k in range(60)) + " end"), (2, "word1 word2")])
    assert [(r["n_words"], r["n_hit"]) for r in decontamination.find_contamination(docs, bench).orderBy("doc_id").collect()] == [(61, 60), (2, 0)]


def test_id_sets_are_measured(spark, monkeypatch):
    docs, gone = frame(spark, [(k, "x") for k in range(20)]), spark.range(10).select(F.col("id").alias("doc_id"))
    for most in (1_000_000, 3):
        monkeypatch.setattr(common, "MAX_BROADCAST_IDS", most)
        assert common.without_ids(docs, gone).count() == 10 and common.without_ids(docs, gone, how="left_semi").count() == 10
    texts = spark.createDataFrame([("a" * 1000,)] * 3, "doc_id string")
    assert common.small(texts.limit(0)) and common.small(texts)
    monkeypatch.setattr(common, "MAX_BROADCAST_BYTES", 2000)
    assert not common.small(texts)


def test_shards_of_odd_tables(spark, tmp_path):
    rows = [(None, "x" * 90), (None, None), (1, "y" * 300), (1, "y" * 300), (2, ""), *((k, "z" * 40) for k in range(3, 60))]
    docs = frame(spark, rows).withColumns({"shard": F.lit("s"), "shard_bits": F.lit("t"), "piece": F.lit(1)})
    directory = sharding.write_shards(docs, str(tmp_path / "a"), max_shard_bytes=500).collect()
    stored = spark.read.parquet(str(tmp_path / "a"))
    assert sorted(r["n"] for r in stored.select("n").collect()) == list(range(len(rows))) and set(docs.columns) < set(stored.columns)
    assert sum(d["shard_rows"] for d in directory) == len(rows) and all(d["shard_bytes"] <= 500 or d["oversized"] for d in directory)
    empty = sharding.write_shards(docs.limit(0), str(tmp_path / "b"))
    assert empty.count() == 0


def tables(spark, path, rows):
    frame(spark, rows).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame([(1, " ".join(f"v{k}" for k in range(20)))], "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")


def test_pipeline_on_an_empty_table(spark, tmp_path):
    tables(spark, tmp_path, [])
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_pipeline_on_odd_rows(spark, tmp_path):
    rows = [(1, WORDS), (2, NEAR), (2, "a b c"), (2, "A B C"), (None, LONE), (None, "lone text"), (4, None), (5, ""), (6, LONE + " end"), (7, "a b c")]
    tables(spark, tmp_path, rows)
    found = sorted(str((r["doc_id"], r["n_tokens"] > 0)) for r in corpus_pipeline.run(spark, str(tmp_path)).collect())
    # equal texts: 7 of "a b c", 5 of the empty ones; near: 1 of (1, 2); LONE and its copy have the benchmark's words
    assert found == sorted(["(1, True)", "(7, True)", "(5, False)", "(None, True)"])
