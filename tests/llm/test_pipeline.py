"""The pipeline on a small corpus in which every decision is known."""

import importlib
import random

import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    chance = random.Random(5)
    sets = {"aa": "kora temi lusa pondi rek sul marvo tin".split(), "bb": "øst håp blå fjord ås gjær øye trå".split()}
    word = lambda lang: "".join(chance.choices(sets[lang], k=2))
    text = lambda lang, n: " ".join(word(lang) for _ in range(n))
    rows = []
    for i in range(120):
        lang = "aa" if i % 3 else "bb"
        rows.append([i, text(lang, 60), lang, f"s{i % 4}"])
    common = text("aa", 12)
    leak = text("aa", 30)
    rows[10][1] = common + "\n" + rows[10][1]  # a line of two documents: the later one loses it
    rows[20][1] = common + "\n" + rows[20][1]
    words = rows[30][1].split()
    rows.append([200, " ".join([*words[:20], "changed", *words[21:]]), "bb", "s0"])  # a near copy of 30
    rows.append([201, rows[40][1], "aa", "s1"])  # an exact copy of 40: its one line goes, and so does it
    rows.append([202, text("aa", 20) + ". " + leak.upper() + ". " + text("aa", 20), "aa", "s2"])  # holds the benchmark
    rows += [[203, "12 34 -- !!", "aa", "s0"], [204, None, "aa", "s0"], [205, "", None, None]]  # without letters
    folder = tmp_path_factory.mktemp("sf")
    data = [(*r, len(r[1]) if r[1] is not None else None) for r in rows]
    spark.createDataFrame(data, DOCS).repartition(4).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(1, leak), (2, "never met anywhere in any of these texts at all")], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return str(folder), {r[0]: r for r in rows}, common


@pytest.fixture(scope="module")
def pipeline():
    return importlib.import_module("corpus_pipeline")


def test_every_stage(spark, corpus, pipeline):
    folder, rows, common = corpus
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    kept, columns = {}, docs.columns
    for name, stage in pipeline.STAGES[:-1]:
        path = f"{folder}/{name}"
        stage(spark, docs, folder).write.mode("overwrite").parquet(path)
        docs = spark.read.parquet(path)
        assert docs.columns == columns
        kept[name] = {r.doc_id: r for r in docs.collect()}
    clean = set(rows) - {203, 204, 205}
    assert set(kept["language_id"]) == clean
    assert set(kept["line_dedup"]) == clean - {201}
    assert kept["line_dedup"][20].text == rows[20][1].removeprefix(common + "\n") and kept["line_dedup"][20].n_chars == len(kept["line_dedup"][20].text)
    assert all(kept["line_dedup"][i].text == rows[i][1] for i in clean - {20, 201})
    assert set(kept["near_dedup"]) == clean - {200, 201}
    assert set(kept["decontaminate"]) == clean - {200, 201, 202}
    mixed = pipeline.STAGES[-1][1](spark, docs, folder).collect()
    sizes = {d: len(r.text.split()) for d, r in kept["decontaminate"].items()}
    total = {}
    for d, r in kept["decontaminate"].items():
        total[r.source] = total.get(r.source, 0) + sizes[d]
    weight = dict(zip(sorted(total), (5, 2, 1, 5)))
    for source in total:
        taken = sum(sizes[r.doc_id] * r.copies for r in mixed if r.source == source)
        assert abs(taken - sum(total.values()) * weight[source] / 13) <= 61
    assert all(1 <= r.copies <= 3 for r in mixed)


def test_line_stage_compares_short_lines(spark, pipeline):
    docs = spark.createDataFrame([(1, "Les.\nfirst", "aa", "s", 10), (2, "Les.\nsecond", "aa", "s", 11)], DOCS)
    assert sorted(r.text for r in pipeline.line_dedup_stage(spark, docs, "").collect()) == ["Les.\nfirst", "second"]


def test_run_gives_what_the_stages_give_and_reruns_agree(spark, corpus, pipeline):
    folder, _, _ = corpus
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for _, stage in pipeline.STAGES:
        docs = stage(spark, docs, folder)
    want = sorted(tuple(r) for r in docs.collect())
    assert sorted(tuple(r) for r in pipeline.run(spark, folder).collect()) == want


def test_stages_keep_columns_of_any_name(spark, corpus, pipeline):
    folder, _, _ = corpus
    docs = spark.read.parquet(f"{folder}/documents.parquet").limit(20).selectExpr("*", "1 AS `a.b`", "'x' AS size", "doc_id AS row_a", "0 AS copies")
    for _, stage in pipeline.STAGES[:-1]:
        docs = stage(spark, docs, folder)
        assert docs.columns[-4:] == ["a.b", "size", "row_a", "copies"] and {r["size"] for r in docs.collect()} == {"x"}
    assert pipeline.STAGES[-1][1](spark, docs, folder).columns == docs.columns


def test_empty_documents(spark, tmp_path, pipeline):
    spark.createDataFrame([], DOCS).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert pipeline.run(spark, str(tmp_path)).count() == 0


def test_each_stage_on_odd_rows(spark, corpus, pipeline):
    """Null ids, sources and texts, empty and very long texts, ties and repeated rows: every stage goes through, and treats equal rows alike."""
    folder, rows, _ = corpus
    text = rows[50][1]
    words = text.split()
    long = "\n".join(" ".join(words[i % 50 : i % 50 + 9]) + f" {i}" for i in range(12_000))
    odd = [(None, text, "aa", None, 1), (None, text, "aa", None, 1), (7, text, "aa", "s", None), (7, text, "aa", "s", None), (8, long, "aa", "s", 0), (9, None, None, None, None), (10, "", "aa", "s", 0), (11, "!!", "aa", "s", 2), (12, "x" * 300_000, "aa", "s", 3)]
    docs = spark.createDataFrame(odd, DOCS).repartition(3)
    for name, stage in pipeline.STAGES:
        out = stage(spark, docs, folder).collect()
        assert len(out) <= len(odd), name
        found = sorted(repr((r.doc_id, r.text)) for r in out)
        twins = [sum(x == repr((i, text)) for x in found) for i in (None, 7)]
        if name in ("language_id", "decontaminate"):
            assert all(n in (0, 2) for n in twins), (name, twins)  # rows alike go or stay together
        if name == "decontaminate":
            assert len(out) == len(odd)  # nothing here is from the benchmark
        if name == "line_dedup":
            left = [r for r in out if r.text and r.text.startswith(words[0] + " " + words[1])]
            assert {r.doc_id for r in left} <= {7, 8} and sum(r.text is None for r in out) == 1
        if name == "near_dedup":
            assert sum(r.text == text for r in out) == 1 and sum(not (r.text or "").strip("!") for r in out) <= 2
        assert any(r.doc_id == 8 for r in out) or name == "mix", name
