import numpy as np
import pytest

from lectern.llm import safety

SCHEMA = "doc_uuid string, variant_id long, text string, sexual double, n_windows int"


@pytest.fixture(scope="module")
def classifier(spark, data):
    return safety.train(spark.read.parquet(f"{data}/safety_samples.parquet"), spark.read.parquet(f"{data}/lang_samples.parquet"))


def frame(spark, rows):
    return spark.createDataFrame([(d, i, t, 0.5, 1) for i, (d, t) in enumerate(rows)], SCHEMA)


def test_gradients_match_finite_differences():
    rng = np.random.default_rng(0)
    net = safety.Network(["a", "b", "c"], rng)
    net.p = {k: v.astype(np.float64) for k, v in net.p.items()}
    word, rows = rng.integers(0, 4, (5, 3)), rng.integers(0, 6, (5, 3))
    lists = rng.integers(0, safety.GRAMS, 12), np.array([1, 2, 3, 1, 4, 1])
    mask, y = np.ones((5, 3), bool), np.array([[1.0, 0], [0, 1], [0, 0]])
    mask[3:, 1] = False
    _, g = net.step(word, rows, lists, mask, y)
    eps = 1e-3
    for name in ("Wf", "Ub", "cf", "A", "v", "o", "char"):
        flat = net.p[name].reshape(-1)
        some = np.flatnonzero(g[name].reshape(-1)) if name == "char" else len(flat)
        for i in rng.choice(some, 4 if name != "o" else 2, replace=False):
            keep = flat[i]
            flat[i] = keep + eps
            up = net.step(word, rows, lists, mask, y)[0]
            flat[i] = keep - eps
            down = net.step(word, rows, lists, mask, y)[0]
            flat[i] = keep
            # the mean is over batch and axes, the gradient over the batch
            assert abs((up - down) / (2 * eps) * y.shape[1] - g[name].reshape(-1)[i]) < 2e-3, name


def test_cases_and_windows(spark, classifier):
    insult = "You are a worthless idiot and everyone here knows it."
    calm = "The baker counted the silver coins beneath the lighthouse, and the ink had not yet dried. "
    rows = [("a", insult), ("b", calm), ("c", None), ("d", ""), ("e", calm * 3000 + insult), (None, insult), ("f", "You are a w0rthl3ss id*iot and everyone here knows it!"), ("a", insult), ("g", "...")]
    got = {r.variant_id: r for r in safety.safety_scores(frame(spark, rows), classifier).collect()}
    assert set(got) == {0, 1, 3, 4, 6, 7, 8}
    assert got[0].toxicity > 0.5 and got[0].sexual < 0.5 and got[7].toxicity == got[0].toxicity
    assert got[1].toxicity < 0.5 and got[1].sexual < 0.5 and got[4].toxicity > 0.5 and got[4].n_windows > 2000
    assert got[3].n_windows == 0 and got[3].toxicity == 0.0
    assert safety.safety_scores(frame(spark, []), classifier).count() == 0
    docs = {r.doc_uuid: r.n_texts for r in safety.document_scores(safety.safety_scores(frame(spark, rows), classifier)).collect()}
    assert docs["a"] == 2


def test_every_window_counts(classifier):
    """Scores are those of the best window, wherever it begins, and equal pooling window by window."""
    insult, calm = "You are a worthless idiot and everyone here knows it.", "the baker counted the silver coins beneath the old lighthouse "
    alone = classifier.scores([insult])[0][0, 1]
    for k in range(0, 40, 3):
        words = (calm * 20).split()
        score, windows = classifier.scores([" ".join(words[:k] + [insult] + words[k : 60 - k])])
        assert score[0, 1] > 0.5 and alone > 0.5 and windows[0] == max(1, len(safety.tokens(" ".join(words[:k] + [insult] + words[k : 60 - k]))) - safety.WINDOW + 1)
    x = np.random.default_rng(1).random((70, 2))
    assert np.allclose(safety.sliding(x), [x[i : i + safety.WINDOW].sum(axis=0) for i in range(70)])


def test_batches_of_texts_do_not_matter(classifier):
    texts = ["You are a worthless idiot.", "", "The baker counted coins. " * 40, "x" * 5_000, "Calm words here.", "\u0441\u043b\u043e\u0432\u043e " * 30]
    together = classifier.scores(texts)[0]
    for i, t in enumerate(texts):
        assert np.allclose(classifier.scores([t])[0][0], together[i], atol=1e-5)


def test_held_out_accuracy(spark, data):
    rows = spark.read.parquet(f"{data}/safety_samples.parquet").orderBy("sample_id").collect()
    clean = [r.text for r in spark.read.parquet(f"{data}/lang_samples.parquet").collect()]
    y = [(r.text, float(r.sexual_axis == "Explicit"), float(r.toxicity_axis != "Safe")) for r in rows]
    c = safety.Classifier([x for i, x in enumerate(y) if i % 4], clean, steps=400)
    held = [x for i, x in enumerate(y) if i % 4 == 0]
    score, _ = c.scores([x[0] for x in held])
    right = ((score > 0.5) == np.array([x[1:] for x in held])).mean()
    assert right > 0.9, right


def test_tokens_undo_disguises():
    t = lambda x: [safety.normal(w) for w in safety.tokens(x)]
    assert t("n a k e d") == ["naked"] == t("n.aked") == t("na​ked") == t("naaaaked") == t("n@ked") == t("<b>n4k3d</b>")
    assert t("A b c") == ["a", "b", "c"] and t("end.Next") == ["end", "next"]


def test_letters_apart_make_known_words():
    known = {"filthy", "animals", "a", "an"}
    assert safety.tokens("they are f i l t h y a n i m a l s here", known)[2:4] == ["filthy", "animals"]
    assert safety.tokens("x q z w k here", known) == ["xqzwk", "here"] and safety.apart("aan", known) == "a an"


def test_axis_values(spark):
    from pyspark.sql import functions as F

    got = spark.createDataFrame([(" Explicit", "Explicit"), ("CLEAN", "Clean"), ("PG-13", None), (None, None), ("safe", "Safe")], "a string, want string").withColumn("got", safety.axis_value(F.col("a"))).collect()
    assert all(r.got == r.want for r in got)


def test_weak_sentences_come_from_flagged_documents():
    bad = [(f"d{i}", f"The weather was fine. Gromble the {c} flibbert now.") for i, c in enumerate("abcdefgh")]
    clean = [(f"c{i}", "The weather was fine. Nothing happened at the mill.") for i in range(60)]
    w = safety.Weak(bad, [], clean)
    assert len(w.cases(0)) == 8 and all("Gromble" in x for x in w.cases(0)) and w.cases(1) == []
    assert w.is_case("Gromble the z flibbert now") and not w.is_case("The weather was fine")
