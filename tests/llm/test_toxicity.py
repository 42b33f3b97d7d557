from pyspark.sql import functions as F

from devtrail.llm.toxicity import _features, classify_toxicity, fit, held_out, op6_toxicity, train

SF = "/root/testdata/sf0.1"


def test_held_out_accuracy(spark):
    out = op6_toxicity(spark, SF).join(spark.read.parquet(f"{SF}/labels.parquet"), "doc_id").where("held_out")
    n = out.groupBy().agg(F.count("*").alias("n"), F.sum(F.expr("int(predicted = toxic)")).alias("right"),
                          F.sum(F.expr("int(predicted = 1 AND toxic = 0)")).alias("false_alarm"), F.sum("toxic").alias("toxic"),
                          F.sum(F.expr("int(predicted = 1 AND toxic = 1)")).alias("hit")).first()
    assert n.n > 500 and n.right >= 0.98 * n.n and n.hit >= 0.9 * n.toxic and n.false_alarm <= 0.005 * n.n


def test_identity_terms_carry_less_weight_with_the_penalty(monkeypatch):
    import numpy as np

    from devtrail.llm import toxicity

    enc = lambda ws: np.array(sorted({f for w in ws for f in _features(w)}), np.uint64).tobytes()
    sample = []
    for i in range(200):  # in this sample the term "muslim" goes with the label as often as the insult
        words = {"the", f"w{i % 7}"} | ({"muslim", "idiot"} if i % 2 else {"christian" if i % 4 else "day"})
        swap = {toxicity._swaps().get(w, w) for w in words}
        sample.append((i % 2, enc(words), enc(swap) if swap != words else None))
    name = _features("muslim")[0]
    with_penalty = fit(sample)[0].get(name, 0.0)
    monkeypatch.setattr(toxicity, "COUNTERFACTUAL", 0.0)
    assert abs(with_penalty) < 0.5 * abs(fit(sample)[0][name])


def test_labels_of_held_out_rows_and_odd_rows(spark, odd_docs):
    labels = spark.createDataFrame([(1, 0, 0), (4, 1, 1), (4, 1, 1), (None, 1, 1), (5, 0, None), (7, 1, 1)], "doc_id long, quality int, toxic int")
    out = classify_toxicity(odd_docs.withColumn("toxic", F.lit("clash")), labels).collect()
    assert len(out) == 10 and all(0 <= r.toxicity <= 1 for r in out)
    assert all(r.toxic == 0 for r in out if not (r.text or "").strip())
    assert classify_toxicity(odd_docs.limit(0), labels.limit(0)).count() == 0
    # Labels of held-out rows change nothing.
    flipped = labels.withColumn("toxic", F.when(held_out("doc_id"), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    assert train(odd_docs, labels) == train(odd_docs, flipped)
