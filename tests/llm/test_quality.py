import random

from llm_util import empty_docs, odd_docs

from addrflow.llm import quality as Q

LABELS = "doc_id long, quality int, toxic int, text string"


def _corpus(n=600, seed=1):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        words = [f"v{chr(97 + rng.randrange(26))}{chr(97 + rng.randrange(26))}" for _ in range(rng.randrange(30, 90))]
        kind = rng.choice("cccctj")
        if kind == "t":
            for _ in range(3):
                words.insert(rng.randrange(len(words)), rng.choice(["nasty", "Vile", "awful,"]))
        text = " ".join(w + "%%%" for w in words) if kind == "j" else " ".join(words) + "."
        rows.append((i, text, {"c": (1, 0), "t": (1, 1), "j": (0, rng.randrange(2))}[kind]))
    return rows


def test_held_out_documents(spark):
    rows = _corpus()
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string").repartition(4)
    labels = spark.createDataFrame([(i, *q, None) for i, _, q in rows if i % 3] + [(None, 1, 0, "x"), (5, None, 1, "x")], LABELS)
    got = {r.doc_id: r for r in Q.score(docs, Q.fit_on(docs, labels)).collect()}
    held = [(got[i], q) for i, _, q in rows if i % 3 == 0]
    assert sum(r.kept == (q == (1, 0)) for r, q in held) >= 0.97 * len(held)
    assert all(0 <= r.tail_probability <= 1 and 0 <= r.expected_grade <= Q.GRADES - 1 for r in got.values())
    # Grades are ordered: the expected grade is at least twice the chance of the last one.
    assert all(r.expected_grade >= 2 * r.tail_probability - 1e-9 for r in got.values())


def test_check_data_held_out(spark):
    """The given labels: fitted on two thirds of them, judged on the rest."""
    base = "/root/testdata/sf0.1"
    docs = spark.read.parquet(f"{base}/documents.parquet")
    labels = spark.read.parquet(f"{base}/labels.parquet")
    model = Q.fit_on(docs, labels.filter("doc_id % 3 <> 0"))
    held = Q.score(docs, model).join(labels.filter("doc_id % 3 = 0"), "doc_id").collect()
    clean = [r.kept for r in held if r.quality == 1 and r.toxic == 0]
    bad = [r.kept for r in held if r.quality == 0 or r.toxic == 1]
    assert sum(clean) >= 0.98 * len(clean)
    assert sum(bad) <= 0.08 * len(bad)


def test_odd_documents(spark):
    rows, docs = odd_docs(spark)
    model = Q.fit_on(docs, spark.createDataFrame([], LABELS))
    assert Q.score(docs, model).filter("kept").count() == len(rows)
    kept = Q.select(docs, model)
    assert kept.columns == docs.columns and kept.count() == len(rows)
    bad = Q.fit_on(docs, spark.createDataFrame([(r[0], 0, 0, None) for r in rows[:5]], LABELS))
    assert Q.select(docs, bad).count() == 0


def test_empty_table(spark):
    model = Q.fit_on(empty_docs(spark), spark.createDataFrame([(1, 1, 0, None)], LABELS))
    assert Q.score(empty_docs(spark), model).collect() == []
    assert Q.select(empty_docs(spark), model).collect() == []
