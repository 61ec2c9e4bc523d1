import random

import numpy as np

from ledgerline.llm.reading import BANDS, GROUPS, Words, features, fit_model, fit_ordinal, reading_bands, sentences
from ledgerline.llm.tokens import VOCABULARY

WORDS = {
    "plain": ("the dog sees a red ball", "we made this so that people can play", "my wonderful grandmother likes chocolate", "it is easy"),
    "student": ("the network estimates the hidden signal", "we train every model on the corpus", "the cache reduces latency, so that the module runs", "install the package"),
    "expert": ("the stochastic functional, which regularises the divergence, admits a decomposition", "if v is null on U then so is w", "notwithstanding its generality the operator degenerates", "the proof interpolates the seminorm"),
}


def text(rng, band, n=14):
    near = {"plain": ["student"], "student": ["plain", "expert"], "expert": ["student"]}[band]
    return " ".join(rng.choice(WORDS[band] if rng.random() < 0.75 else WORDS[rng.choice(near)]).capitalize() + "." for _ in range(n))


def sample(seed, n):
    rng = random.Random(seed)
    return [(text(rng, b), b) for b in (rng.choice(BANDS) for _ in range(n))]


def test_ordinal_fit_finds_the_order():
    rng = np.random.RandomState(0)
    x = rng.randn(2000, 3)
    score = x @ np.array([2.0, -1.0, 0.0]) + rng.logistic(size=2000)
    w, cuts = fit_ordinal(x, (score > -1).astype(int) + (score > 1.5), ridge=0.1)
    assert abs(w - [2, -1, 0]).max() < 0.25 and abs(cuts - [-1, 1.5]).max() < 0.25
    w, cuts = fit_ordinal(x, np.zeros(2000, int))
    assert np.isfinite(w).all() and np.isfinite(cuts).all()


def words():
    with open(VOCABULARY, "rb") as f:
        return Words(f.read())


def column(name, k=0):
    return GROUPS.index(name) + k


def test_features_are_finite():
    texts = ["", "\n\n", "a", "1 2 3 4", "x" * 100_000, "The dog, which runs, sees that the cat sleeps.", "the cat sleeps and runs here", "the cat, which sleeps because it runs, is here"]
    x = features(texts, words())
    assert x.shape == (8, len(GROUPS)) and np.isfinite(x).all() and not x[[0, 1, 3]].any()
    assert x[7, column("clauses", 1)] > x[6, column("clauses", 1)]
    assert features([], words()).shape == (0, len(GROUPS))


def test_features_hold_against_plain_counts():
    """Features of texts measured together equal those of each measured alone, and plain counts."""
    rng = random.Random(3)
    texts = [text(rng, b, n) for b in BANDS for n in (1, 7, 60)] + ["", "one"]
    x, w = features(texts, words()), words()
    assert np.allclose(x, np.concatenate([features([t], w) for t in texts]))
    for t, row in zip(texts, x):
        flat = [v for s in sentences(t) for v in s]
        if not flat:
            continue
        assert np.isclose(row[column("length")], np.mean([len(v) for v in flat])) and np.isclose(row[column("diversity", 1)], len(set(flat)) / len(flat))
        stretches = [flat[k : k + 30] for k in range(0, len(flat), 30)]
        assert np.isclose(row[column("diversity", 3)], np.mean([len(set(v)) / len(v) for v in stretches]))
        assert np.isclose(row[3:12].sum(), 1) and np.isclose(row[12:24].sum(), 1)


def test_rarity_needs_no_grades():
    w = words()
    bits = lambda v: w.values[w.ids([v])[0], 0]
    assert bits("dog") < bits("celebration") < bits("renormalisation") and bits("the") < bits("cache")


def test_held_out_accuracy(spark):
    train, test = sample(1, 300), sample(2, 200)
    rng = random.Random(7)
    noisy = lambda b: b if rng.random() > 0.06 else BANDS[max(0, min(2, BANDS.index(b) + rng.choice([-1, 1])))]
    docs = [(k, t, "x") for k, (t, _) in enumerate(train + test)] + [(9000, None, "x"), (9001, "", "x"), (9002, "too short", "x")]
    labels = [(k, f"r{j}", f" {noisy(b).upper()} ") for k, (_, b) in enumerate(train) for j in range(rng.randint(1, 2))] + [(9000, "r", "plain"), (9999, "r", "plain"), (3, "r", "odd"), (4, "r", None), (None, "r", "plain")]
    d = spark.createDataFrame(docs, "doc_id long, text string, band string")
    lab = spark.createDataFrame(labels, "doc_id long, rater string, band string")
    got = {r.doc_id: r for r in reading_bands(d, lab).collect()}
    assert set(got) == set(range(500))
    right = np.mean([got[300 + k].band == b for k, (_, b) in enumerate(test)])
    assert right > 0.93
    assert all(abs(r.p_plain + r.p_student + r.p_expert - 1) < 1e-9 for r in got.values())
    small = {r.doc_id: r.band for r in reading_bands(d, lab, sample_docs=60).collect()}
    assert np.mean([small[300 + k] == b for k, (_, b) in enumerate(test)]) > 0.85
    assert reading_bands(d, lab.limit(0)).count() == 0 and reading_bands(d.limit(0), lab).count() == 0


def test_model_needs_few_kinds_of_grades():
    weights, intercept, cuts = fit_model(features(["a b c d."], words()), [[10**6, 0, 0]])
    assert np.isfinite(weights).all() and np.isfinite(intercept) and len(cuts) == 2


def test_repeated_rows_of_a_graded_document(spark):
    rows = [(k, t) for k, (t, _) in enumerate(sample(4, 30))]
    d = spark.createDataFrame(rows + [rows[0]] * 300, "doc_id long, text string")
    lab = spark.createDataFrame([(k, b) for k, (_, b) in enumerate(sample(4, 30))], "doc_id long, band string")
    got = reading_bands(d, lab).collect()
    assert len(got) == 330 and len({(r.doc_id, r.band, r.score) for r in got}) == 30
