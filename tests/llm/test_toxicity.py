import random

from pyspark.sql import functions as F

from campusgrid.llm.toxicity import fit_linear, toxicity
from helpers import SCHEMA
import numpy as np


def corpus(n=900, seed=2):
    r = random.Random(seed)
    plain = ["".join(r.choice("abcdefgh") for _ in range(r.randint(3, 8))) for _ in range(500)]
    docs, labels = [], []
    for i in range(n):
        bad, low = i % 7 == 0, i % 5 == 0
        w = [r.choice(plain) for _ in range(r.randint(20, 200))]
        for _ in range(4 if bad else 0):
            w[r.randrange(len(w))] = r.choice(["Grimlo", "grimlon,", "VORPAX", "vorpaxes"])
        if low:
            w[0] = w[-1] = "clickhere"
        docs.append((i, " ".join(w), "en", "s", 1, "x"))
        labels.append((i, 0 if low else 1, int(bad)))
    return docs, labels


def test_held_out_accuracy_of_the_chain(spark):
    docs, labels = corpus()
    some = [x for x in labels if x[0] % 3]
    df = spark.createDataFrame(docs, SCHEMA).repartition(4)
    found = toxicity(df, spark.createDataFrame(some, "doc_id bigint, quality int, toxic int")).collect()
    assert len(found) == len(docs) and found[0].text is not None
    p = {r.row.doc_id: (r.p_low_quality, r.p_toxic) for r in found}
    held = [x for x in labels if x[0] % 3 == 0]
    assert sum((p[i][1] >= 0.5) == bool(t) for i, _, t in held) >= 0.98 * len(held)
    assert sum((p[i][0] >= 0.5) == (q == 0) for i, q, _ in held) >= 0.95 * len(held)


def test_odd_rows(spark):
    docs, labels = corpus(120)
    docs += [(None, None, None, None, None, None), (500, "", "", "", 0, ""), (500, "", "", "", 0, ""), (501, "grimlo " * 5000, "", "", 0, "")]
    labels += [(None, 1, 1), (9999, 0, 1), (3, None, None), (4, 1, None)]
    marks = spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")
    df = spark.createDataFrame(docs, SCHEMA)
    found = toxicity(df, marks, sample=60)
    assert found.count() == len(docs) and found.where("p_toxic is null or p_toxic < 0 or p_toxic > 1").count() == 0
    assert toxicity(df, marks.limit(0)).where("p_toxic > 1e-6").count() == 0
    assert toxicity(df.limit(0), marks, keep_text=False).collect() == []
    one = toxicity(df, marks, {"toxic": F.col("toxic")}, keep_text=False)
    assert one.columns == ["row", "p_toxic"]


def test_a_later_model_uses_the_earlier_score():
    label = np.array([0, 1] * 50)
    model = fit_linear([(np.zeros(100, int), np.zeros(0, np.int32))], (label * 4.0 - 2.0)[:, None], label)
    assert model.chain[0] > 0.5
