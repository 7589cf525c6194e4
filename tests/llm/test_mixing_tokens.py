import duckdb

from addrflow.llm import mixing as M


def test_shares_follow_the_given_token_counts(spark):
    """Texts without spaces are one word each; their counts say that the sources are equal."""
    rows = [(i, "ab"[i % 2], "w " * 50 if i % 2 else "日" * 100, 50) for i in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string, tokens int")
    got = M.mix(docs, tokens_col="tokens").select("rec.source", "n_tokens", "weight", "epoch").collect()
    assert {(r.source, r.n_tokens, r.weight, r.epoch) for r in got} == {("a", 50, 0.5, 0), ("b", 50, 0.5, 0)}
    assert len(got) == len(rows)


def test_a_source_without_spaces_gets_its_share(spark):
    """As many words in one source as ideographs in the other: equal weights, no source read again."""
    rows = [(i, "ab"[i % 2], "word " * 75 if i % 2 else "日" * 75) for i in range(200)]
    got = M.mix(spark.createDataFrame(rows, "doc_id long, source string, text string")).select("rec.source", "n_tokens", "weight", "epoch").collect()
    assert {(r.source, r.n_tokens, r.weight, r.epoch) for r in got} == {("a", 75, 0.5, 0), ("b", 75, 0.5, 0)}
    assert len(got) == len(rows)


def test_every_text_is_searched_for_its_words(spark):
    """The text decides, not its length in bytes; a word of more than 64 characters counts by 64."""
    want = {"a b c d": 4, "abcdefg": 1, "été  \t\n sœur\u00a0x": 2, "x" * 64: 1, "x" * 65 + " y": 3, "日本 abc": 3, " \x0b ": 0, "": 0, "ไทย": 3, "😀" * 65: 2}
    docs = spark.createDataFrame([*enumerate(want)], "doc_id long, text string")
    got = docs.select("text", M.tokens_of(docs.text).alias("n")).collect()
    assert {r.text: r.n for r in got} == want
    for text, n in want.items():
        assert duckdb.execute("SELECT len(regexp_extract_all(?, ?))", [text, M.TOKEN]).fetchone() == (n,)
