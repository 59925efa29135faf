import random

import pytest
from coffer.llm import license_scan as op

TEMPLATES = (*op.BASE, *op.PUBLIC)


def brute(text, templates=TEMPLATES):
    """Every place of every template, by comparing its words at each start."""
    words, found = op.words_in(text or ""), []
    for number, t in enumerate(templates):
        for start in range(-len(t.words), len(words)):
            stands = [0 <= start + j < len(words) and words[start + j] == w for j, w in enumerate(t.words)]
            if sum(stands) >= t.least and all(stands[j] for j in t.required):
                found.append((number, t.label, t.base, start, sum(stands), sum(stands) / len(stands)))
    return len(words), sorted(found)


def check(docs, templates=TEMPLATES):
    got = sorted((str(r.doc_id), r.n_words, [tuple(p) for p in r.places]) for r in op.scan(docs, templates).collect())
    want = sorted((str(r.doc_id), *brute(r.text, templates)) for r in docs.select("doc_id", "text").collect())
    assert got == want


def noisy(rng, template):
    """The passage with some words replaced, sometimes cut at an end, in other letters and punctuation."""
    words = [w if rng.random() > 0.12 else rng.choice(["foo", "the", "license", "CC"]) for w in template.words]
    words = words[rng.choice([0, 0, 0, 1, 3]):][: rng.choice([100, 100, len(words) - 1])]
    return rng.choice([" ", "\n// ", ", ", " -- "]).join(w.upper() if rng.random() < 0.3 else w for w in words)


def test_places_against_brute_force(make_docs):
    rng, rows = random.Random(7), []
    for d in range(250):
        parts = []
        for _ in range(rng.randrange(6)):
            parts.append(noisy(rng, rng.choice(TEMPLATES)) if rng.random() < 0.7 else " ".join(rng.choices("a the cc by of it rights".split(), k=5)))
        rows.append((d, ". ".join(parts), "en", "hot"))
    docs = make_docs(rows)
    check(docs)
    labels = {p.label for r in op.scan(docs).collect() for p in r.places}
    assert labels == {t.label for t in TEMPLATES}


def test_the_index_is_of_the_rarest_words_and_loses_nothing(make_docs):
    common = [(k, "free software this program is public the of and") for k in range(40)]
    docs = make_docs([*common, (100, "This program is FREE software: you can redistribute it and/or modify it under the terms of the GNU "
                                     "General Public License as published by the Free Software Foundation")])
    idf = op.rarity(docs, TEMPLATES)
    assert idf["redistribute"] > idf["software"] and idf["merge" if "merge" in idf else "gnu"] > idf["free"]
    number = next(k for k, t in enumerate(TEMPLATES) if t.label == "gpl" and not t.base)
    indexed = {w for w, places in op.rare_index(TEMPLATES, idf).items() for p in places if p["template"] == number}
    assert "software" not in indexed and "redistribute" in indexed
    check(docs)


def test_awkward_rows(awkward, no_docs, make_docs):
    check(awkward)
    assert op.scan(no_docs).count() == 0
    check(make_docs([
        (1, "CC-BY 4.0 cc by cc\nby"), (2, "cc by" * 3), (3, "ccby c c by"), (None, "All Rights Reserved. " * 500), (None, None),
        (4, "K cc by ALL RIGHTS\x00RESERVED Über cc—by"), (4, "cc by"), (4, "cc by"), (5, "by cc"), (6, "x" * 200_000),
        (7, "general public license general public license"), (8, "licensed under cc by-nc-sa"), (9, "by " * 50_000 + "cc by"),
    ]))
    rows = {r.doc_id: r for r in op.scan(make_docs([(4, "K cc by ALL RIGHTS\x00RESERVED cc—by")])).collect()}
    assert [p.label for p in rows[4].places] == ["reserved"]


def test_a_template_of_one_word_raises(make_docs):
    with pytest.raises(ValueError):
        op.scan(make_docs([(1, "x")]), (op.Template("one", "word"),))
    with pytest.raises(ValueError):
        op.scan(make_docs([(1, "x")]), (op.Template("two", "two words", keys=("no",)),))


def test_no_shuffle_of_texts(make_docs, capsys):
    op.scan(make_docs([(1, "cc by")])).explain()
    plan = capsys.readouterr().out
    assert "Exchange" not in plan and "Python" not in plan and "regexp_extract_all" in plan and plan.count("regexp_extract_all") == 1
