"""The histogram against texts encoded one by one."""

from collections import Counter

from asofmill.llm import token_counts

SCHEMA = "doc_id long, text string, n_tokens string"
TEXTS = ["", None, "a", "Hello world, it's 2024.", "Hello world, it's 2024.", "é ñ ß " * 50, "x" * 5000, "the cat " * 3000, "\n\n \t", "<|endoftext|>"]


def frame(spark, texts=TEXTS):
    return spark.createDataFrame([(i, t, "clash") for i, t in enumerate(texts)], SCHEMA).repartition(3)


def brute():
    with open(token_counts.VOCABULARY, "rb") as f:
        encode = token_counts.encoding_of(f.read()).encode_ordinary
    return [len(encode(t or "")) for t in TEXTS]


def test_histogram_matches_brute_force(spark):
    lengths = brute()
    assert max(lengths) > 2 * token_counts.BLOCK
    got = {r.n_tokens: r for r in token_counts.histogram(token_counts.token_lengths(frame(spark))).collect()}
    assert {k: r.n_docs for k, r in got.items()} == Counter(lengths)
    for n, r in got.items():
        assert r.docs_upto == sum(x <= n for x in lengths) and r.docs_from == sum(x >= n for x in lengths)
        assert r.tokens_from == sum(x for x in lengths if x >= n) and r.total == sum(lengths)
        assert r.truncated_total == sum(min(x, n) for x in lengths) and r.quantile == r.docs_upto / len(lengths)


def test_limits_and_quantiles(spark):
    lengths = sorted(brute())
    hist = token_counts.histogram(token_counts.token_lengths(frame(spark)))
    for r in token_counts.at_limits(hist, [0, 1, 7, 100, 1 << 30]).collect():
        over = [x for x in lengths if x > r.limit]
        assert (r.docs_over, r.tokens_over, r.truncated_total) == (len(over), sum(over), sum(min(x, r.limit) for x in lengths))
    got = {r.share: r.n_tokens for r in token_counts.quantiles(hist, [0.1, 0.5, 0.95, 1.0]).collect()}
    assert got == {0.1: lengths[0], 0.5: lengths[4], 0.95: lengths[-1], 1.0: lengths[-1]}


def test_empty_table(spark):
    hist = token_counts.histogram(token_counts.token_lengths(frame(spark, [])))
    assert hist.count() == 0
    assert [tuple(r) for r in token_counts.at_limits(hist, [10]).collect()] == [(10, 0, 0, 0)]


def test_texts_are_encoded_once(spark):
    plan = token_counts.histogram(token_counts.token_lengths(frame(spark)))._jdf.queryExecution().toString()
    assert "MapInArrow" not in plan  # only written counts are read


def test_query_on_a_written_table(spark, tmp_path):
    from asofmill.llm.queries import op3_token_counts

    frame(spark).write.parquet(f"{tmp_path}/documents.parquet")
    assert {r.n_tokens: r.n_docs for r in op3_token_counts(spark, str(tmp_path)).collect()} == Counter(brute())


def test_very_long_runs_of_blanks(spark):
    from tokenizers import Tokenizer

    own = Tokenizer.from_file("/opt/tokenizers/byte_bpe_50k.json")
    for text in (" " * 2_000_000, "a" + "\n" * 1_500_000 + "b", "x " + " \t" * 800_000 + "y" + " " * 5000 + "z"):
        assert [r.n_tokens for r in token_counts.token_lengths(frame(spark, [text])).collect()] == [len(own.encode(text, add_special_tokens=False).ids)]
