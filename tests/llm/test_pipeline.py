import random

import corpus_pipeline
import numpy as np
import public_tokenizers
from coffer.llm import retrieval_packing
from tokenizers import Tokenizer

from .conftest import prose
from .test_near_dedup import brute as near_groups
from .test_near_dedup import variants


def test_stages_on_planted_documents(spark, make_docs, tmp_path):
    rng = random.Random(5)
    rows, toxic, passage = [], [], prose(900, 70)
    for k in range(240):
        text = prose(k, 70) + "\n" + prose(k + 5000, 40)
        if k % 6 == 0:
            words = text.split(" ")
            for w in rng.sample(["vile", "rotten", "nasty"], 2):
                words.insert(rng.randrange(60), w)
            text = " ".join(words)
            toxic.append(k)
        elif k % 6 == 1:
            text = prose(k + 7000, 20) + "\n" + passage + "\n" + text
        rows.append((k, text, "en", f"s{k % 3}"))
    exact = [(1000 + k, rows[k][1], "en", "s0") for k in (2, 3, 8)]
    near = [(2000 + i, t, "en", "s1") for i, t in enumerate(variants(prose(77, 120), 6, 3, 1))]
    rest = [(3000, None), (3001, ""), (3002, "short")]
    docs = make_docs([*rows, *exact, *near, *rest], clashing=False)
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    labels = [(k, 1, int(k in toxic)) for k in range(240)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))

    done, now = {}, spark.read.parquet(str(tmp_path / "documents.parquet"))
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, now, str(tmp_path))
        if name != "packing":
            assert out.columns == docs.columns, name
        out.write.parquet(str(tmp_path / name))
        now = done[name] = spark.read.parquet(str(tmp_path / name))

    clean = {r.doc_id for r in done["toxicity"].collect()}
    assert len(clean & set(toxic)) <= 2 and len(clean) >= docs.count() - len(toxic) - 2
    lines = {r.doc_id: r.text for r in done["line_dedup"].collect()}
    assert not {i for i, *_ in exact} & set(lines) and sum(passage in (t or "") for t in lines.values()) == 1
    assert {3000, 3001, 3002} <= set(lines)
    assert all(r.n_chars == (None if r.text is None else len(r.text)) for r in done["line_dedup"].collect())
    stay = {r.doc_id for r in done["near_dedup"].collect()}
    assert stay == {i for i, _, _, kept in near_groups(sorted(lines.items()), corpus_pipeline.SHINGLE_WORDS) if kept}
    assert {r.doc_id for r in done["source_mixing"].collect()} <= stay
    tokenizer = Tokenizer.from_file(public_tokenizers.path(retrieval_packing.VOCABULARY))
    texts = {r.doc_id: r.text or "" for r in done["source_mixing"].collect()}
    pieces = {}
    for r in sorted(done["packing"].collect(), key=lambda r: (r.doc_id, r.start)):
        pieces.setdefault(r.doc_id, []).extend(np.frombuffer(r.ids, "<u4").tolist())
    assert pieces == {i: [*tokenizer.encode(t, add_special_tokens=False).ids, 1] for i, t in texts.items()}

    assert corpus_pipeline.run(spark, str(tmp_path)).count() == done["packing"].count()
