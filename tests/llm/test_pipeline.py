"""Each stage's decisions hold in what the pipeline returns."""

import corpus_pipeline as P
from cadenza.llm import decontaminate, simhash, toxicity
from cadenza.llm.mixing import mix

from .conftest import prose
from .test_toxicity import corpus


def test_the_pipeline(spark, tmp_path):
    docs, labels = corpus(300)
    docs += [(1000, docs[7][1]), (1001, prose(9, 50)), (1002, None), (1003, "")]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame([(i, t, "en", f"s{i % 3}", len(t or "")) for i, t in docs], schema).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame(labels, "doc_id long, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    spark.createDataFrame([(1, prose(9, 50))], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    sf = str(tmp_path)

    d = spark.read.parquet(f"{sf}/documents.parquet")
    clean = {r.doc_id for r in toxicity.without_toxic(d, spark.read.parquet(f"{sf}/labels.parquet")).collect()}
    kept = d.where(d.doc_id.isin(*clean))
    single = {r.doc_id for r in simhash.simhash_components(kept).collect() if r.doc_id == r.component_id}
    assert 1000 not in single and 7 in single
    kept = kept.where(d.doc_id.isin(*single))
    leaks = {r.doc_id for r in decontaminate.contaminated(kept, spark.read.parquet(f"{sf}/benchmark.parquet")).collect()}
    assert leaks == {1001}
    taken = {r.doc_id for r in mix(kept.where(~d.doc_id.isin(*leaks))).collect() if r.taken}
    got = P.run(spark, sf).collect()
    assert {r.doc_id for r in got} == taken and len(P.STAGES) == 5
    got.sort(key=lambda r: r.start)
    assert [r.doc_id for r in got] == sorted(r.doc_id for r in got)
    assert all(a.start + a.n_tokens == b.start for a, b in zip(got, got[1:]))
