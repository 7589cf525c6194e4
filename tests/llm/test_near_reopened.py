import random

import pytest
from llm_util import near_classes, sentence
from pyspark.sql import functions as F

from addrflow.llm import near_join as N


def _family(rng, first, words, copies):
    """Copies of a text that differ from each other by about as much as links may."""
    base = sentence(rng, words).split(" ")
    out = []
    for k in range(copies):
        text = list(base)
        for _ in range(rng.randrange(words // 28)):
            text[rng.randrange(words)] = f"new{rng.randrange(99999)}"
        out.append((first + k, " ".join(text)))
    return out


@pytest.mark.parametrize("rows_of_a_block", [4096, 4])
def test_failed_pairs_reopen_components_not_groups(spark, monkeypatch, rows_of_a_block):
    """What is looked at again has a row for a class, however many signatures its classes share."""
    rng = random.Random(3)
    rows = [r for f in range(5) for r in _family(rng, 1000 * f, 200 + 10 * f, 30)]
    docs = spark.createDataFrame(rows, "id long, text string").withColumn("row", F.col("id")).repartition(4)
    made, plain = [], N.stage
    monkeypatch.setattr(N, "stage", lambda df, name: made.append((name, plain(df, name))) or made[-1][1])
    got = N.link_numbered(docs, wide_rows=rows_of_a_block).collect()
    parts, want = {}, {}
    for r in got:
        parts.setdefault(bytes(r.label), set()).add(r.id)
    for d, _, c in near_classes(rows):
        want.setdefault(c, set()).add(d)
    assert sorted(map(sorted, parts.values())) == sorted(map(sorted, want.values()))
    sizes = [(name, df.count()) for name, df in made]
    assert any(n for name, n in sizes if name == "wrong")
    again = [n for name, n in sizes if name in ("connected", "open_groups")]
    assert again and max(again) <= len(rows)
    assert sum(name == "across" for name, _ in sizes) <= 5


def test_spare_pairs_follow_the_joining_ones():
    """Every class of one side is alike: a pair joins, spare ones are the next nearest, failed ones never come."""
    x, y = (bytes([0] * 15 + [v]) for v in (1, 2))
    for many in (2, 20):  # one by one, and in vectors
        node = [bytes([k]) for k in range(many + 1)]
        args = [[True] + [False] * many, [False] + [True] * many, node, [100] * (many + 1), [x] + [y] * many, [bytes(8)] + [bytes([0] * 7 + [k % 2]) for k in range(many)]]
        none = [None] * (many + 1)
        assert N.spanning(*args, none) == [(node[0], node[1])]
        assert N.spanning(*args, none, 1) == [(node[0], node[1]), (node[0], node[2] if many == 2 else node[3])]
        assert N.spanning(*args, [[node[1]], *none[1:]], 8)[0] != (node[0], node[1])
