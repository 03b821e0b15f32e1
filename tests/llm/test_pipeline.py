import corpus_pipeline as cp
from tests.llm.test_ngram_join import brute
from tests.llm.test_quality import kept


def rows():
    good = " ".join(f"Word{i} goes{i} on, and on{i}, to word{i * i}." for i in range(12))
    key = "0123456789abcdef0123456789abcdef01234567"
    texts = [
        (1, good), (2, good), (3, good + " One more."), (4, good.replace("Word", "Term").replace("word", "term")),
        (5, "too short"), (6, None), (7, ""), (8, "\n".join(["HOME | ABOUT | NEWS | HELP | MORE"] * 8)),
        (9, " ".join(f"Alone{i} stands far{i} off{i}, with token = \"{key}\" near{i} it{i}." for i in range(8))),
        (10, " ".join(f"Front{i} it{i} is." for i in range(20)) + " one two three four five six seven eight nine ten eleven twelve. " + " ".join(f"Back{i} it{i} is." for i in range(20))),
        (None, " ".join(f"Nameless{i} it{i} is, so far." for i in range(20))), (4, good.replace("Word", "Term").replace("word", "term")),
    ]
    return [(i, t, "en", "s", len(t or "")) for i, t in texts]


SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def test_stages(spark, tmp_path):
    spark.createDataFrame(rows(), SCHEMA).repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, "one two three four five six seven eight nine ten eleven twelve.")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs, seen = spark.read.parquet(f"{tmp_path}/documents.parquet"), {}
    for name, stage in cp.STAGES:
        docs = cp.stored(stage(spark, docs, str(tmp_path)), "test")
        seen[name] = docs.collect()
        if name != "packing":
            assert tuple(docs.columns) == cp.COLUMNS
    ids = {name: sorted((r.doc_id for r in found), key=str) for name, found in seen.items()}
    want = [(i, t) for i, t, *_ in rows() if kept(t)]
    assert {1, 2, 3, 4, 9, 10, None} == {i for i, _ in want}
    assert ids["quality rules"] == sorted((i for i, _ in want), key=str)
    assert ids["n-gram Jaccard join"] == sorted({c if c is not None else None for _, n, c in brute(want)}, key=str)
    assert ids["benchmark decontamination"] == [i for i in ids["n-gram Jaccard join"] if i != 10]
    text = {r.doc_id: r for r in seen["secret scans"]}
    assert "0123456789abcdef" not in text[9].text and text[9].text.count("[SECRET]") == 8 and text[9].n_chars == len(text[9].text)
    assert text[1].text == rows()[0][1] and sorted(text, key=str) == ids["benchmark decontamination"]
    assert sorted({r.doc_id for r in seen["packing"]}, key=str) == ids["benchmark decontamination"]
    assert all(r.doc_tokens >= r.start + r.length for r in seen["packing"])


def test_further_columns_go_along(spark, tmp_path):
    spark.createDataFrame([(1, "one two three four five six seven eight nine ten eleven twelve.")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    more = [(*r, f"row {k}", k, None) for k, r in enumerate(rows())]
    docs = spark.createDataFrame(more, SCHEMA + ", row string, root int, start string").repartition(2)
    for _, stage in cp.STAGES[:-1]:
        columns, docs = docs.columns, cp.stored(stage(spark, docs, str(tmp_path)), "test")
        assert docs.columns == columns
    left = {r.doc_id: (r.row, r.root, r.start) for r in docs.collect()}
    assert left[1] == ("row 0", 0, None) and left[9] == ("row 8", 8, None) and left[None] == ("row 10", 10, None)


def test_empty_table(spark, tmp_path):
    spark.createDataFrame([], SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert cp.run(spark, str(tmp_path)).collect() == []
