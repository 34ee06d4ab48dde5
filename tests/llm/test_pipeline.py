import random
from collections import Counter

import corpus_pipeline as P
import __spark_entry__ as E
from likewise.llm.common import materialize, table

from .helpers import awkward, documents

SF = "/root/testdata/sf0.001"


def test_stages_hand_on_documents(spark):
    docs = table(spark, SF, "documents")
    columns = docs.columns
    kept = {}
    for name, stage in P.STAGES[:-1]:
        before, docs = docs, materialize(stage(spark, docs, SF), f"test-{name}")
        assert docs.columns == columns
        assert set(docs.collect()) <= set(before.collect())
        kept[name] = docs.count()
    assert kept["language_id"] >= 0.9 * table(spark, SF, "documents").count()
    tokens = P.STAGES[-1][1](spark, docs, SF)
    assert Counter(r.doc_id for r in tokens.collect()) == Counter(r.doc_id for r in docs.select("doc_id").collect())


def test_registered(spark):
    names = E.queries()
    assert "pipeline" in names and all(any(n.startswith(f"op{k}_") for n in names) for k in range(1, 14))
    assert [s for s, _ in P.STAGES] == ["language_id", "simhash_dedup", "decontaminate", "mix_sources", "token_output"]
    assert E.queries()["pipeline"](spark, SF).count() > 0


def written(spark, tmp_path, docs, items=()):
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(list(items), "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    return str(tmp_path)


def test_awkward_documents(spark, tmp_path):
    """Null, empty, blank and long texts, null and repeated ids, clashing columns: texts
    without a letter go, copies go but one, and what is left is encoded."""
    docs = awkward(spark)
    rows = P.run(spark, written(spark, tmp_path, docs)).collect()
    texts = {r.doc_id: r.text for r in docs.collect()}
    assert {r.doc_id for r in rows} <= set(texts) and all(r.n_tokens > 1 for r in rows)
    stage = docs
    for _, function in P.STAGES[:-1]:
        stage = materialize(function(spark, stage, str(tmp_path)), "test-awkward")
        assert stage.columns == docs.columns
        assert all(any(c.isalpha() for c in r.text) for r in stage.collect())


def test_empty_tables(spark, tmp_path):
    assert P.run(spark, written(spark, tmp_path, documents(spark, []))).count() == 0


def test_clean_documents_stay_and_planted_ones_go(spark, tmp_path):
    """Copies, benchmark passages and texts of no language, planted among clean documents."""
    rng = random.Random(31)
    parts = {"xx": "ka lo mi nu ta po ri".split(), "yy": "schr ung pf ein mit ver".split()}

    def text(lang, n=80):
        return " ".join("".join(rng.choice(parts[lang]) for _ in range(rng.randint(2, 4))) for _ in range(n))

    clean = [(i, text("xy"[i % 2] * 2), "xy"[i % 2] * 2, "s") for i in range(300)]
    item = text("xx", 40)
    copies = [(1000 + i, clean[7][1], "yy", "s") for i in range(20)]
    leaked = [(2000 + i, f"{text('xx', 30)} {item}", "xx", "s") for i in range(5)]
    none = [(3000 + i, "123 456 ...", None, "s") for i in range(5)]
    docs = documents(spark, [*clean, *copies, *leaked, *none]).repartition(4)
    sf = written(spark, tmp_path, docs, [(1, item)])
    for name, function in P.STAGES[:3]:
        docs = materialize(function(spark, docs, sf), f"test-{name}")
    left = {r.doc_id for r in docs.collect()}
    assert left == {r[0] for r in clean}
