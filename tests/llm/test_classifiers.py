import random

import numpy as np
import pytest

import edges
from starfold.llm import quality, toxicity
from starfold.llm.common import table

FOLDER = "/root/testdata/sf0.1"


def held_out_figures(spark, found, label):
    labels = table(spark, FOLDER, "labels").select("doc_id", label)
    rows = found.where("held_out").join(labels, "doc_id").select(label, "score", "predicted").collect()
    y, score = np.array([r[0] for r in rows]), np.array([r[1] for r in rows])
    pairs = (score[y == 1][:, None] > score[y == 0]).mean() + 0.5 * (score[y == 1][:, None] == score[y == 0]).mean()
    hit = np.array([r[2] for r in rows])
    return pairs, (hit[y == 1] == 1).mean(), (hit[y == 0] == 0).mean()


def test_quality_on_held_out_documents(spark):
    found = quality.score_documents(table(spark, FOLDER, "documents"), table(spark, FOLDER, "labels"))
    auc, good, bad = held_out_figures(spark, found, "quality")
    assert auc > 0.99 and good > 0.99 and bad > 0.85


def test_toxicity_on_held_out_documents(spark):
    found = toxicity.score_documents(table(spark, FOLDER, "documents"), table(spark, FOLDER, "labels"))
    auc, toxic, clean = held_out_figures(spark, found, "toxic")
    assert auc > 0.94 and toxic > 0.8 and clean > 0.99


@pytest.mark.parametrize("score", [quality.score_documents, toxicity.score_documents])
def test_awkward_documents_and_labels(spark, score):
    docs = edges.documents(spark)
    for labels in (edges.no_labels(spark), edges.some_labels(spark)):
        rows = score(docs, labels).collect()
        assert sorted(r.doc_id or 0 for r in rows) == sorted(i or 0 for i, _ in edges.TEXTS)
        assert all(0 <= r.score <= 1 and r.predicted in (0, 1) for r in rows)
        by_text = {}
        for r in rows:
            by_text.setdefault(r.doc_id, set()).add(r.score)
        assert by_text[1] == by_text[2] and by_text[3] == by_text[4] and by_text[6] == by_text[7]
    assert score(docs.limit(0), edges.some_labels(spark)).count() == 0


@pytest.mark.parametrize("score", [quality.score_documents, toxicity.score_documents])
def test_held_out_labels_are_not_learned(spark, score):
    docs = table(spark, "/root/testdata/sf0.001", "documents")
    labels = table(spark, "/root/testdata/sf0.001", "labels")
    out = score(docs, labels).where("held_out").select("doc_id")
    flipped = labels.join(out, "doc_id").selectExpr("doc_id", "1 - quality AS quality", "1 - toxic AS toxic")
    changed = labels.join(out, "doc_id", "left_anti").unionByName(flipped)
    plain = {r.doc_id: r.score for r in score(docs, labels).collect()}
    assert plain == pytest.approx({r.doc_id: r.score for r in score(docs, changed).collect()}, abs=1e-9)


def brute_segments(scores):
    """By the definition: take the best segment, then go on to its left and to its right."""

    def best(lo, hi):
        found = None
        for i in range(lo, hi):
            total = 0.0
            for j in range(i, hi):
                total += scores[j]
                if total > 0 and (found is None or total > found[2]):
                    found = (i, j, total)
        return found

    out, todo = [], [(0, len(scores))]
    while todo:
        lo, hi = todo.pop()
        found = best(lo, hi)
        if found:
            out.append(found)
            todo += [(lo, found[0]), (found[1] + 1, hi)]
    return sorted(out)


@pytest.mark.parametrize("seed", range(60))
def test_segments_are_all_maximal_ones(seed):
    rng = random.Random(seed)
    scores = np.array([rng.choice([-1, 1]) * (rng.random() + 0.01) for _ in range(rng.randrange(1, 30))])
    got, expected = toxicity.segments(scores), brute_segments(scores)
    assert [(a, b) for a, b, _ in got] == [(a, b) for a, b, _ in expected]
    assert [s for *_, s in got] == pytest.approx([s for *_, s in expected])
    assert toxicity.segments(np.array([])) == [] == toxicity.segments(np.array([-1.0]))


def test_isotonic_is_the_nearest_monotone_fit():
    rng = np.random.default_rng(0)
    y, w = rng.random(40), rng.integers(1, 9, 40).astype(float)
    fit = quality.isotonic(y, w)
    assert (np.diff(fit) >= -1e-12).all()
    # min-max formula
    mean = lambda a, b: np.average(y[a : b + 1], weights=w[a : b + 1])
    for i in range(40):
        assert fit[i] == pytest.approx(max(min(mean(a, b) for b in range(i, 40)) for a in range(i + 1)))


def test_features_approximate_a_gaussian_kernel():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(30, quality.STATISTICS))
    model = quality.Model(np.zeros(quality.STATISTICS), np.ones(quality.STATISTICS), 20_000, 4.0, 1)
    z = model.features(x)[:, :-1]
    apart = ((x[:, None] - x) ** 2).sum(axis=2)
    assert np.abs(z @ z.T - np.exp(-apart / (2 * 4.0**2))).max() < 0.05


def test_passages_are_found_where_they_are(spark):
    model = toxicity.Model({"idiot": 3.0, "moron": 3.0}, 0.25)
    n, found = model.passages("a calm text " * 20 + "you Idiot, you MORON! " + "calm again " * 20 + "idiot")
    assert n == 60 + 4 + 40 + 1
    assert [(a, b) for a, b, _ in found] == [(61, 63), (104, 104)]
    ((first, last, score),) = model.passages("idiot " * 50)[1]
    assert (first, last) == (0, 49) and 3.0 < score <= 6.0


def test_words_with_combining_marks_are_learned_and_scored_alike(spark):
    text = "यह किताब बहुत अच्छी है cafe\u0301 नि:शुल्क"
    words = toxicity.words_of(text)
    assert words[:5] == ["यह", "किताब", "बहुत", "अच्छी", "है"] and "cafe\u0301" in words
    counts = toxicity.count_words(spark.createDataFrame([(1, text), (0, None)], "y int, text string"))
    assert {r.word for r in counts.collect()} == set(words)
    model = toxicity.Model({"किताब": 2.0}, 0.25)
    assert model.passages(text) == (len(words), [(1, 1, 2.0)])
