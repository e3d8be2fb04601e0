import hashlib
import random
import re

import pytest

import edges
from starfold.llm import decontaminate

ITEMS = "item_id long, text string, score double, spans string"


def words(text):
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)


def brute(text, items, window):
    own, hit, found = words(text), set(), set()
    for item, item_text in items:
        parts = words(item_text)
        size = min(window, len(parts))
        for i in range(len(parts) - size + 1) if parts else ():
            for j in range(len(own) - size + 1):
                if own[j : j + size] == parts[i : i + size]:
                    hit.update(range(j, j + size))
                    found.add(str(item))
    listed = ",".join(sorted(found)).encode()
    return len(own), len(hit), len(found), hashlib.sha256(listed).hexdigest(), bool(hit)


@pytest.mark.parametrize("seed", range(6))
def test_automaton_against_brute_force(seed):
    rng = random.Random(seed)
    text = lambda n: " ".join(rng.choice("ab" if seed % 2 else "abcde") for _ in range(n))
    items = [(str(i), text(rng.choice([0, 1, 3, 4, 9, 25]))) for i in range(7)] + [("7", "z"), ("8", None)]
    for window in (1, 3, 5):
        model = decontaminate.Automaton(items, window)
        for _ in range(20):
            doc = text(rng.randrange(60)) + rng.choice(["", " z", " q a"])
            spans, found = model.scan(decontaminate.words_of(doc))
            n, hit, _, digest, _ = brute(doc, items, window)
            assert sum(b - a + 1 for a, b in spans) == hit
            assert hashlib.sha256(",".join(sorted(found)).encode()).hexdigest() == digest


PASSAGE = "Which of these Rivers is longest when measured from source to mouth today"


def test_contamination_in_one_or_many_automata(spark):
    rows = [*edges.TEXTS, (20, f"intro words {PASSAGE.upper()}! outro"), (21, "brief item"), (22, PASSAGE[:30])]
    items = [(1, PASSAGE), (2, PASSAGE + " again"), (3, "Brief item"), (4, None), (5, ""), (6, edges.TEXTS[0][1]), (6, "Brief, ITEM")]
    docs = edges.documents(spark, rows)
    bench = spark.createDataFrame([(*i, None, None) for i in items], ITEMS)
    got = decontaminate.contamination(docs, bench, 10).collect()
    expected = sorted((i or 0, *brute(t, items, 10)) for i, t in rows)
    assert sorted((r.doc_id or 0, *tuple(r)[1:]) for r in got) == expected
    assert decontaminate.automata(bench, 10, batch_words=12).count() > 1
    again = decontaminate.contamination(docs, bench, 10, batch_words=12).collect()
    assert sorted((r.doc_id or 0, *tuple(r)[1:]) for r in again) == expected


@pytest.mark.parametrize("batch_words", [3, 200_000])
def test_spans_are_removed_until_none_is_left(spark, batch_words):
    rows = [
        (1, "Clean text that nobody copied from anywhere else at all."),
        (2, f"before before before before before before before before before before before before before {PASSAGE}. after"),
        (3, PASSAGE), (4, None), (5, ""),
        (7, "w " * 40 + "Which of these Rivers is longest zz yy xx ww vv uu tt ss rr qq when measured from source to mouth today"),
        (6, "w " * 30 + "Which of these Rivers is " + PASSAGE + " longest when measured from source to mouth today"),
    ]
    docs = edges.documents(spark, rows)
    items = [(1, PASSAGE, None, None), (2, "zz yy xx ww vv uu tt ss rr qq", None, None)]
    bench = spark.createDataFrame(items, ITEMS)
    found = decontaminate.remove_overlaps(docs, bench, 10, batch_words=batch_words).collect()
    kept = {r.doc_id: r for r in found}
    assert set(kept) == {1, 2, 4, 5, 6, 7} and "Rivers" not in kept[7].text
    assert kept[1].text == rows[0][1] and kept[1].n_chars == len(rows[0][1])
    assert kept[2].text.endswith("before . after") and kept[2].n_chars == len(kept[2].text)
    assert kept[4].text is None and kept[5].text == ""
    assert kept[6].text == "w " * 30
    assert not any(brute(r.text, [(1, PASSAGE)], 10)[4] for r in kept.values())


@pytest.mark.parametrize("seed", range(2))
def test_removal_does_not_depend_on_the_batches(spark, seed):
    """Items whose spans overlap in the document, in one automaton or in several."""
    rng = random.Random(seed)
    runs = [(i, " ".join(f"w{j}" for j in range(i, i + rng.choice([10, 12, 15])))) for i in (0, 5, 11, 40, 44)]
    docs = [(0, " ".join(f"w{j}" for j in range(15))), (1, "x y z " * 20 + " ".join(f"w{j}" for j in range(15)))]
    for n in range(2, 30):
        start = rng.randrange(50)
        docs.append((n, " ".join([*(f"a{j}" for j in range(rng.randrange(30))), *(f"w{j}" for j in range(start, start + rng.randrange(25)))])))
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    bench = spark.createDataFrame([(*r, None, None) for r in runs], ITEMS)
    found = [
        sorted((r.doc_id, r.text) for r in decontaminate.remove_overlaps(frame, bench, 10, batch_words=n).collect())
        for n in (3, 10, 200_000)
    ]
    assert found[0] == found[1] == found[2]
    assert 0 not in [i for i, _ in found[0]] and not any("w5" in t.split() for i, t in found[0] if i == 1)


def test_no_items_and_no_documents(spark):
    docs, none = edges.documents(spark), spark.createDataFrame([], ITEMS)
    assert {r.n_hit for r in decontaminate.contamination(docs, none).collect()} == {0}
    assert decontaminate.contamination(docs.limit(0), none).count() == 0
    assert decontaminate.remove_overlaps(docs, none).count() == docs.count()
