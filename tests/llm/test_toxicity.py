import numpy as np

from corpusflow.llm import toxicity


def test_label_model_finds_accuracies_and_repeated_voters():
    rng = np.random.default_rng(1)
    y = rng.random(4000) < 0.3
    right = [0.9, 0.8, 0.8, 0.7, 0.6]
    votes = [np.where(rng.random(4000) < a, y, ~y).astype(int) for a in right]
    votes += [votes[4], votes[4]]  # two voters that say what the weakest one says
    matrix = np.stack(votes, axis=1)
    model = toxicity.fit_label_model(matrix, matrix[:, :4].mean(axis=1))
    strength = model.odds[:, 2] - model.odds[:, 1]
    assert strength[0] > strength[1] > strength[3] > strength[4]
    assert all(model.weight[k] < 0.5 < model.weight[0] for k in (4, 5, 6))
    assert ((model.posterior(matrix) > 0.5) == y).mean() > 0.93


def test_held_out_texts(spark):
    from corpusflow.llm.queries import op6_toxicity

    rows = op6_toxicity(spark, "/root/testdata/sf0.1").join(spark.read.parquet("/root/testdata/sf0.1/labels.parquet"), "doc_id").where("held_out").collect()
    toxic, clean = [r for r in rows if r["toxic"] == 1], [r for r in rows if r["toxic"] == 0]
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3) for r in rows)
    assert np.mean([r["predicted"] for r in toxic]) > 0.85 and np.mean([r["predicted"] for r in clean]) < 0.03


def test_odd_rows(spark):
    docs = [(i, ("you stupid worthless idiot " if i % 2 else "a calm and friendly word ") + f"w{i}", "x") for i in range(80)]
    df = spark.createDataFrame([*docs, (900, None, "x"), (901, "", "x"), (None, "you idiot", "x"), (5, "twice", "x")], "doc_id long, text string, toxicity string")
    labels = spark.createDataFrame([*((i, i % 2) for i in range(80)), (1, 0), (2, None), (3, 7), (None, 1), (4000, 1)], "doc_id long, toxic int")
    model = toxicity.fit_toxicity(df, labels)
    got = toxicity.score_toxicity(df, model).collect()
    score = {r["doc_id"]: r["toxicity"] for r in got if r["text"] != "twice"}
    assert len(got) == 84 and all(0 <= r["toxicity"] <= 1 for r in got)
    assert min(score[i] for i in range(1, 80, 2)) > 0.5 > max(score[i] for i in range(0, 80, 2))
    assert score[900] == score[901] < min(0.3, score[None])
    assert toxicity.score_toxicity(df.limit(0), model).count() == 0


def test_one_label_or_none(spark):
    df = spark.createDataFrame([(1, "some words"), (2, None)], "doc_id long, text string")
    for rows, least, most in (([(1, 1)], 0.9, 1.0), ([], 0.0, 0.1)):
        model = toxicity.fit_toxicity(df, spark.createDataFrame(rows, "doc_id long, toxic int"))
        assert all(least <= r["toxicity"] <= most for r in toxicity.score_toxicity(df, model).collect())
