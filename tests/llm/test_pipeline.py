"""The pipeline, stage by stage, against brute force on each stage's own input."""

import itertools
from collections import Counter, defaultdict

import corpus_pipeline
import numpy as np
from test_native import brute_rules
from test_python_operators import brute_runs, gram_set, reached

from tamiz.llm import mixing, packing
from tamiz.llm.common import staged


def rejected(text):
    n, chars, symbols, dup, repeat = brute_rules(text)
    lines = sum(1 for line in (text or "").split("\n") if line.split())
    shouts = (text or "").count("!")
    return n < 20 or 100 * repeat > 30 * n or 10 * symbols > n or 2 * dup > lines or chars > 14 * n or 4 * shouts > n


def test_stages(spark, odd_docs, tmp_path):
    docs = odd_docs.dropDuplicates(["doc_id"])
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    docs, before = spark.read.parquet(f"{tmp_path}/documents.parquet"), {}
    before = {r.doc_id: r.text for r in docs.collect()}
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES:
        made = staged(stage(spark, docs, str(tmp_path)), "test-stage")
        rows = made.collect()
        if name != "packing":
            assert made.columns == columns
        if name == "quality rules":
            assert {r.doc_id for r in rows} == {d for d, t in before.items() if not rejected(t)}
        elif name == "line dedup":
            order = sorted(before)
            gone = dict(zip(order, brute_runs([before[d] or "" for d in order], 10), strict=True))
            cut = {d: "\n".join(x for k, x in enumerate(t.split("\n")) if k not in gone[d]) for d, t in before.items()}
            assert {r.doc_id: r.text for r in rows} == {d: t for d, t in cut.items() if t.split() or not gone[d]}
            assert all(r.n_chars == len(r.text) for r in rows)
        elif name == "n-gram Jaccard join":
            sets = {d: gram_set(t) for d, t in before.items()}
            links = [(a, b) for a, b in itertools.combinations(sets, 2) if 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]) > 0]
            assert {r.doc_id for r in rows} == set(reached(sets, links).values())
        elif name == "mixing":
            copies = {r.doc_id: r.copies for r in mixing.pareto_mix(docs).collect()}
            assert Counter(r.doc_id for r in rows) == +Counter(copies)
        else:
            encode = packing.Encoder(packing.tokenizer_path()).tokenizer.encode
            want = sum(len(encode(t, add_special_tokens=False).ids) + 1 for t in mixed)
            assert sum(r.length for r in rows) == want
            of = defaultdict(list)
            for r in rows:
                of[r.sequence_id].append((r.offset, r.length))
            for own in of.values():
                ends = np.cumsum([n for _, n in sorted(own)])
                assert ends[-1] <= 1024 and [o for o, _ in sorted(own)] == [0, *ends[:-1]]
        docs, mixed = made, [r.text for r in rows] if "text" in made.columns else []
        before = {r.doc_id: r.text for r in rows} if "text" in made.columns else {}
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == docs.count()


def test_an_empty_table_passes_through(spark, no_docs, tmp_path):
    no_docs.write.parquet(f"{tmp_path}/documents.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
