import corpus_pipeline as P
from ledgerline.llm import decontaminate, queries, secrets, simhash

SF = "/root/testdata/sf0.001"


def test_stages_take_effect(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    bench = spark.read.parquet(f"{SF}/benchmark.parquet")
    before = {r.doc_id: r for r in docs.collect()}
    seen = []
    for name, stage in P.STAGES:
        out = stage(spark, docs, SF)
        if name != "mixing":
            assert out.columns == list(P.COLUMNS) and out.schema == docs.schema or out.dtypes == docs.dtypes
        docs = spark.createDataFrame(out.collect(), out.schema)
        after = {r.doc_id: r for r in docs.collect()}
        assert set(after) <= set(before)
        if name == "near_duplicates":
            fps = {i: simhash.fingerprint(r.text, 4) for i, r in after.items()}
            assert not any((a ^ b).bit_count() <= 4 for i, a in fps.items() for j, b in fps.items() if i < j)
        if name == "decontamination":
            assert decontaminate.find_contamination(docs, bench).count() == 0
            assert set(before) - set(after) == {r.doc_id for r in decontaminate.find_contamination(
                spark.createDataFrame(list(before.values()), docs.schema), bench).collect()}
        if name == "secrets":
            assert set(after) == set(before)
            model = secrets.learn(docs)
            assert secrets.scan(docs, model).where("n_access + n_hex > 0").count() == 0
            assert all(r.n_chars == len(r.text) for r in after.values() if r.text != before[r.doc_id].text)
        before = after
        seen.append((name, len(after)))
    assert docs.where("copies < 1 or copies > 2").count() == 0
    assert P.run(spark, SF).count() == seen[-1][1]


def test_null_and_repeated_rows_pass(spark):
    rows = [(None, None, None, None, None), (None, None, None, None, None), (1, "", "en", None, 0), (1, "", "en", None, 0), (2, "a b c d e f g", None, "s", 13)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    for _, stage in P.STAGES[1:]:
        docs = stage(spark, docs, SF)
    assert docs.where("doc_id = 2").count() == 1
    empty = docs.limit(0).select(*P.COLUMNS)
    for _, stage in P.STAGES:
        empty = stage(spark, empty, SF)
        assert empty.count() == 0
        empty = empty.select(*P.COLUMNS)


def test_rows_not_ids_decide(spark):
    bench = spark.read.parquet(f"{SF}/benchmark.parquet").where("length(text) > 80").orderBy("item_id").first()
    item = "before the item " + bench.text + " and after it"
    rows = [(None, item, "en", "a", 1), (None, item + " twice", "en", "a", 2), (None, "a clean text without an id, long enough to be told apart", "en", "a", 3),
            (4, "a clean text of a repeated id that no one else holds", "en", "b", 4), (4, item, "en", "b", 5), (5, "x y z", "en", "b", 6)]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    left = P.decontamination_stage(spark, spark.createDataFrame(rows, schema), SF).collect()
    assert sorted(r.n_chars for r in left) == [3, 4, 6]
    same = "one two three four five six seven eight nine ten eleven twelve"
    rows = [(7, same, None, None, 1), (7, same, None, None, 2), (None, same, None, None, 3), (3, same, None, None, 4), (3, "quite another text with words of its own in it", None, None, 5),
            (None, None, None, None, 6), (None, "", None, None, 7)]
    left = P.near_duplicate_stage(spark, spark.createDataFrame(rows, schema), SF).collect()
    assert sorted(r.n_chars for r in left) == [4, 5, 6] or sorted(r.n_chars for r in left) == [4, 5, 7]


def test_queries_are_the_operators():
    assert [int(n[2:].split("_")[0]) for n in sorted(queries.QUERIES, key=lambda n: int(n[2:].split("_")[0]))] == list(range(1, 14))
