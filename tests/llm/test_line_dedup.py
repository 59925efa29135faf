import re

from coffer.llm import line_dedup as op

from .conftest import prose


def brute(rows, least):
    """Texts without every line that lies in a run of ``least`` words which occurs at an earlier place."""
    lines = {}
    for doc, text in rows:
        split = (text or "").split("\n")
        lines[doc] = [(k, x.strip(" \t\x0b\x0c\r"), len(re.findall(r"[^\x20\x09-\x0D]+", x))) for k, x in enumerate(split)]
        lines[doc] = [x for x in lines[doc] if x[2]]
    first, runs = {}, []
    for doc in sorted(lines):
        seq = lines[doc]
        for i in range(len(seq)):
            for j in range(i, len(seq)):
                key = tuple(x[1] for x in seq[i:j + 1])
                if sum(x[2] for x in seq[i:j + 1]) >= least:
                    if key in first:
                        runs.append((doc, seq[i][0], seq[j][0]))
                    first.setdefault(key, (doc, i))
    gone = {}
    for doc, a, b in runs:
        gone.setdefault(doc, set()).update(range(a, b + 1))
    return {doc: (None if text is None else "\n".join(x for k, x in enumerate(text.split("\n")) if k not in gone.get(doc, ())))
            for doc, text in rows}


def check(docs, least):
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    assert {r.doc_id: r.text for r in op.delete_repeats(docs, least).collect()} == brute(rows, least)


def test_runs_of_any_length_against_brute_force(make_docs):
    shared = [prose(k, n) for k, n in enumerate((3, 7, 1, 12, 2, 30, 5, 1, 1, 9))]
    rows = []
    for d in range(30):
        a, b = d % 7, d % 7 + 1 + d % 5
        own = [prose(100 * d + k, 4) for k in range(3)]
        rows.append((d, "\n".join([own[0], *shared[a:b], "", own[1], *shared[b:b + d % 3], own[2], *(shared[:2] if d % 4 == 0 else [])])))
    for least in (1, 5, 13, 50):
        check(make_docs(rows), least)


def test_repeats_within_a_document_and_overlaps(make_docs):
    line = [f"l{k} w w" for k in range(6)]
    rows = [(1, "\n".join(line * 3)), (2, "\n".join(["x y z", *line[2:], *line[:3]])), (3, "\n".join(line[::-1])), (4, line[0] + "\n\n" + line[1])]
    for least in (3, 6, 9, 17):
        check(make_docs(rows), least)


def test_awkward_rows(awkward, no_docs):
    found = op.delete_repeats(awkward, 50)
    assert found.columns == [*awkward.columns, "deleted_lines"] and found.count() == awkward.count()
    by_id = {}
    for r in found.collect():
        by_id.setdefault(r.doc_id, []).append(r)
    assert by_id[1][0].text and by_id[2][0].text == "" == by_id[2][1].text and by_id[3][0].text is None
    assert by_id[4][0].text == "" and by_id[6][0].deleted_lines == [] and len(by_id[7][0].deleted_lines) >= 390
    assert {r.text for r in by_id[None]} >= {""}  # an unknown id counts as later
    assert op.delete_repeats(no_docs, 50).count() == 0
    assert 2 not in [r.doc_id for r in op.without_copies(awkward).collect()]


def test_maximal_runs(spark):
    found = spark.range(1).select(op.maximal_runs(__import__("pyspark.sql.functions", fromlist=["x"]).expr("array(2,3,4,8)")).alias("r")).first().r
    assert [tuple(x) for x in found] == [(2, 3), (8, 1)]
