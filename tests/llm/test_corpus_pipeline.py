"""The stages in order, each against what a plain reading of its rule keeps."""

import corpus_pipeline as P

from quarry.llm import sp_viterbi
from quarry.llm.tables import table, tokenizer_file
from test_decontam import brute as contaminated
from test_near_dedup import brute as near

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = table(spark, SF, "documents")
    columns = docs.columns
    assert [n for n, _ in P.STAGES] == ["quality_classifier", "near_dedup", "decontamination", "sentencepiece"]
    items = [tuple(r) for r in table(spark, SF, "benchmark").select("item_id", "text").collect()]
    labels = {r.doc_id: r.quality for r in table(spark, SF, "labels").collect()}
    for name, stage in P.STAGES[:3]:
        before = {r.doc_id: r.text for r in docs.collect()}
        docs = P.written(stage(spark, docs, SF), "test")
        assert docs.columns == columns
        after = {r.doc_id: r.text for r in docs.collect()}
        assert all(before[i] == t for i, t in after.items()) and docs.count() == len(after)
        if name == "quality_classifier":
            learnt = [i for i in before if i in labels]
            assert sum((i in after) == (labels[i] == 1) for i in learnt) >= 0.97 * len(learnt)
        elif name == "near_dedup":
            assert set(after) == {i for i, (_, c) in near(list(before.items())).items() if c == i}
        else:
            assert set(after) == {r[0] for r in contaminated(list(before.items()), items) if not r[5]}
    ids = P.STAGES[3][1](spark, docs, SF).collect()
    lattice = sp_viterbi.model(tokenizer_file("piece_bpe_32k.model"))[0]
    assert {r.doc_id for r in ids} == set(after) and all(r.exact and list(r.ids) == lattice.encode(" " + after[r.doc_id]) for r in ids)
    assert sorted(map(str, P.run(spark, SF).collect())) == sorted(map(str, ids))


def test_rows_and_not_ids_are_taken_out(spark):
    """Copies without an id or under a shared one go; what is no copy stays."""
    t = "a b c d e f g"
    rows = [(1, t, 0), (1, t, 0), (2, "A b c d e f g", 0), (3, "x", 0), (3, "y", 0), (None, t, 0), (None, None, 0), (None, None, 0), (4, "", 0), (4, "", 0)]
    rows += [(3, t, 0), (None, "lone p q r s t", 0), (None, "lone p q r s t", 0)]
    df = spark.createDataFrame(rows, "doc_id long, text string, row int")  # an extra column of a clashing name
    out = P.near_dedup(spark, df, SF)
    assert out.columns == df.columns
    got = sorted(map(str, (tuple(r) for r in out.collect())))
    assert got == sorted(map(str, [(1, t, 0), (3, "x", 0), (3, "y", 0), (None, None, 0), (None, None, 0), (4, "", 0), (None, "lone p q r s t", 0)]))


def test_contaminated_rows_without_a_clean_id_go(spark):
    item = next(r.text for r in table(spark, SF, "benchmark").collect() if len((r.text or "").split()) > 15)
    rows = [(1, item), (1, "clean words of one row"), (None, item), (None, "clean words without an id"), (2, None)]
    got = sorted(map(str, (tuple(r) for r in P.decontaminate(spark, spark.createDataFrame(rows, "doc_id long, text string"), SF).collect())))
    assert got == sorted(map(str, [rows[1], rows[3], rows[4]]))


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string, lang string")
    assert P.near_dedup(spark, df, SF).count() == 0 and P.decontaminate(spark, df, SF).count() == 0
