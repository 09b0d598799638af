"""The pipeline's stages on the given tables and on odd rows."""

import corpus_pipeline
from charlake.llm import decontamination as dec, fuzzy_lines as fz, ngram_join as nj, quality as ql
from charlake.llm.packing import pack_documents
from charlake.llm.tokens import vocabulary
from tests.llm.rows import documents, odd_documents, prose

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, before = docs.columns, docs.count()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SF).cache()
        assert docs.columns == columns and 0 < docs.count() <= before, name
        before = docs.count()
    last = corpus_pipeline.STAGES[-1][1](spark, docs, SF)
    want = sorted(map(tuple, pack_documents(docs, vocabulary("word_bpe_49k.json")).select("doc_id", "start", "length", "ids_crc32").collect()))
    assert sorted(map(tuple, last.select("doc_id", "start", "length", "ids_crc32").collect())) == want
    assert sorted(map(tuple, corpus_pipeline.run(spark, SF).select("doc_id", "start", "length", "ids_crc32").collect())) == want


def test_stages_on_odd_rows(spark):
    docs = odd_documents(spark)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SF)
    assert docs.columns == odd_documents(spark).columns
    assert corpus_pipeline.STAGES[-1][1](spark, docs, SF).count() > 0


def test_each_stage_takes_what_it_should(spark):
    items = [r["text"] for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    clean = prose(1, 200)
    near = clean.replace("a", "o", 1)
    junk = "\n".join(["buy### now$$$ cheap%%% best&&& deal*** here###"] * 4)
    leak = prose(2, 50) + " " + items[0] + " " + prose(3, 50)
    docs = documents(spark, [clean, near, junk, leak, prose(4, 100)])
    ids = lambda df: sorted(r["doc_id"] for r in df.collect())
    bench = spark.read.parquet(f"{SF}/benchmark.parquet")
    assert ids(ql.clean_documents(docs)) == [0, 1, 3, 4]
    assert ids(nj.one_of_each(docs)) == [0, 2, 3, 4]
    assert ids(dec.clean_of(docs, bench)) == [0, 1, 2, 4]


def test_line_dedup_finds_lines_with_one_character_changed(spark):
    lines = [prose(i, 12) for i in range(20)]  # 90 to 110 characters
    near = [line[:50] + "#" + line[51:] for line in lines]
    far = [prose(i, 12) for i in range(50, 70)]
    docs = documents(spark, ["\n".join(lines), "\n".join(near + far)])
    kept = {r["doc_id"]: r["text"] for r in corpus_pipeline.line_dedup(spark, docs, SF).collect()}
    assert kept == {0: "\n".join(lines), 1: "\n".join(far)}


def test_line_dedup_finds_short_equal_lines(spark):
    docs = documents(spark, ["Click here\n\n" + prose(1, 12), prose(2, 12) + "\n\nClick here", "Click there\n今日は良い天気です。", "今日は良い天気です。"])
    kept = {r["doc_id"]: r["text"] for r in corpus_pipeline.line_dedup(spark, docs, SF).collect()}
    assert kept == {0: "Click here\n\n" + prose(1, 12), 1: prose(2, 12) + "\n", 2: "Click there\n今日は良い天気です。"}


def test_documents_without_an_id_are_documents_of_their_own(spark):
    a, b, c, d = (prose(i, 12) for i in range(4))
    docs = spark.createDataFrame([(None, a), (None, a), (None, b), (7, c), (7, d), (7, c)], "doc_id long, text string")
    kept = corpus_pipeline.line_dedup(spark, docs, SF).collect()
    assert sorted(r["text"] for r in kept) == sorted([a, b, c, d])
    report = sorted((r["doc_id"] or 0, r["n_removed"]) for r in fz.line_report(docs).collect())
    assert report == [(0, 0), (0, 0), (0, 1), (7, 0), (7, 0), (7, 1)]

    item = spark.read.parquet(f"{SF}/benchmark.parquet").first()["text"]
    docs = spark.createDataFrame([(None, item), (None, b), (7, item), (7, c)], "doc_id long, text string")
    assert sorted(r["text"] for r in corpus_pipeline.decontamination(spark, docs, SF).collect()) == sorted([b, c])
