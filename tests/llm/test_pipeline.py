"""The stages on planted documents: what must go goes, clean documents stay, columns and odd rows pass."""

import random

import pytest
from pyspark.sql import functions as F

import corpus_pipeline as cp
from snapmetrics.llm.common import stored

RNG = random.Random(21)
VOCABULARY = [f"{a}{b}{c}" for a in "bdgklmnprst" for b in ("a", "e", "i", "o", "u", "ou", "ei") for c in ("", "n", "r", "st", "ld")]
BAD = ["vilex", "grubbish", "snarlot"]


def words(n):
    return [RNG.choice(VOCABULARY) for _ in range(n)]


def sentences(n):
    return " ".join(" ".join(words(10)).capitalize() + "." for _ in range(n))


def rude(text):
    out = text.split(" ")
    for _ in range(4):
        out.insert(RNG.randrange(len(out)), RNG.choice(BAD))
    return " ".join(out)


@pytest.fixture(scope="module")
def planted(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("tables"))
    docs, labels, kind = [], [], {}
    for i in range(700):  # labelled and clean, or labelled and toxic
        toxic = i % 5 == 0
        docs.append((i, rude(sentences(8)) if toxic else sentences(8)))
        labels.append((i, int(toxic), 1))
        kind[i] = "toxic" if toxic else "clean"
    for i in range(1000, 1060):
        docs.append((i, rude(sentences(8))))
        kind[i] = "toxic"
    base = sentences(12)
    for i in range(2000, 2040):  # exact copies, then near copies
        text = base if i < 2020 else base.replace(base.split(" ")[i - 2000], "changed", 1)
        docs.append((i, text))
        kind[i] = "copy"
    items = [(k, " ".join(words(30))) for k in range(6)]
    for i in range(3000, 3030):
        docs.append((i, f"{sentences(5)} {items[i % 6][1]} {sentences(5)}"))
        kind[i] = "leak"
    secret = "Write to jo.doe@mail.example.com or +1 (319) 555-5132 from 10.1.2.3 card 4111111111111111"
    for i in range(4000, 4020):
        docs.append((i, f"{sentences(6)} {secret} {sentences(6)}"))
        kind[i] = "private"
    docs += [(5000, None), (5001, ""), (None, sentences(9)), (None, None), (5002, "again " + docs[1][1]), (5002, "again " + docs[1][1])]
    rows = [(i, t, f"src{(i or 0) % 3}" if i != 5001 else None, None if t is None else len(t), "score", True, 7) for i, t in docs]
    schema = "doc_id long, text string, source string, n_chars long, score string, kept boolean, slot int"
    spark.createDataFrame(rows, schema).write.parquet(f"{root}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, toxic int, quality int").write.parquet(f"{root}/labels.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{root}/benchmark.parquet")
    return root, kind


def test_stages_take_out_what_is_planted_and_nothing_else(spark, planted):
    root, kind = planted
    docs = spark.read.parquet(f"{root}/documents.parquet")
    columns = docs.columns
    seen = []
    for name, stage in cp.STAGES:
        docs = stored(stage(spark, docs, root), name)
        if name != cp.STAGES[-1][0]:
            assert docs.columns == columns
        seen.append({name: [r["doc_id"] for r in docs.select("doc_id").collect()]})
    ids = {name: ids for s in seen for name, ids in s.items()}
    left = set(ids["toxicity"])
    assert not [i for i in left if kind.get(i) == "toxic" and i >= 1000] and all(i in left for i, k in kind.items() if k != "toxic")
    left = ids["near_duplicates"]
    assert [i for i in left if kind.get(i) == "copy"] == [2000] and left.count(5002) <= 1 and len(left) == len(set(left)) + left.count(None) - 1
    assert all(i in left for i, k in kind.items() if k in ("clean", "leak", "private")) and {5000, 5001} <= set(left) and left.count(None) == 2
    assert set(ids["decontamination"]) == {i for i in left if kind.get(i) != "leak"}
    assert sorted(ids["personal_data"], key=str) == sorted(ids["decontamination"], key=str) == sorted(ids["mixing"], key=str)
    final = docs.collect()
    for r in final:
        if kind.get(r["doc_id"]) == "private":
            assert "[EMAIL]" in r["text"] and "[PHONE]" in r["text"] and "[IP]" in r["text"] and "[CARD]" in r["text"] and "4111" not in r["text"]
        assert r["n_chars"] == (None if r["text"] is None else len(r["text"])) and r["score"] == "score" and r["kept"] is True
        assert r["release"] <= r["slot"] < r["deadline"]


def test_run_equals_the_stages_and_empty_tables(spark, planted, tmp_path):
    root, _ = planted
    got = cp.run(spark, root)
    assert got.count() > 500 and set(cp.PLACE) <= set(got.columns) and cp.ORACLE_SQL is None
    for t in ("documents", "labels", "benchmark"):
        spark.read.parquet(f"{root}/{t}.parquet").limit(0).coalesce(1).write.parquet(f"{tmp_path}/{t}.parquet")
    assert cp.run(spark, str(tmp_path)).collect() == []
    assert [n for n, _ in cp.STAGES] == ["toxicity", "near_duplicates", "decontamination", "personal_data", "mixing"]
    assert got.filter(F.col("in_mix")).count() > 0


def test_ids_of_text_and_ids_beside_none(spark, planted):
    """Ids that are texts pass the stages as they are, and an id of -1 is another row than one without an id."""
    root, _ = planted
    item = spark.read.parquet(f"{root}/benchmark.parquet").orderBy("item_id").first()["text"]
    leak = f"{sentences(5)} {item} {sentences(5)}"
    rows = [("a-1", leak), ("a-2", sentences(9)), ("", sentences(9)), (None, sentences(9)), ("-1", sentences(9))]
    docs = spark.createDataFrame([(i, t, "s", len(t)) for i, t in rows], "doc_id string, text string, source string, n_chars long")
    for name, stage in cp.STAGES[1:3]:
        docs = stored(stage(spark, docs, root), name)
    assert sorted((r["doc_id"], r["text"]) for r in docs.collect() if r["doc_id"] is not None) == sorted((i, t) for i, t in rows[1:] if i is not None)
    assert docs.filter("doc_id is null").count() == 1
    same = spark.createDataFrame([(-1, leak, "s", 1), (None, leak, "s", 1)], "doc_id long, text string, source string, n_chars long")
    clean = same.withColumn("text", F.lit(rows[1][1]))
    assert cp.without_benchmark(spark, same, root).count() == 0 and cp.without_benchmark(spark, clean, root).count() == 2
