from collections import Counter

import numpy as np
import test_mixing
from corpus import no_docs, odd_docs
from pyspark.sql import functions as F
from test_sharding import law_holds
from test_simhash import brute

import corpus_pipeline as P
from arrivals_mart.llm import decontaminate as D
from arrivals_mart.llm.common import materialize, table

SF001 = "/root/testdata/sf0.001"


def benchmark_in(text, items):
    words = D.words_of(text)
    known = set(words)
    for a in items:
        if a and sum(w in known for w in a) >= 0.8 * len(a):
            number = {w: k for k, w in enumerate(dict.fromkeys(a), 1)}
            x, y = np.array([number[w] for w in a]), np.array([number.get(w, 0) for w in words])
            if D.align(x, y)[0] >= 0.8 * len(a):
                return True
    return False


def test_every_stage_against_brute_force(spark):
    docs = table(spark, SF001, "documents")
    columns, held = docs.columns, {}
    for name, stage in P.STAGES:
        docs = materialize(stage(spark, docs, SF001), f"test_{name}")
        assert docs.columns == (columns if name != "sharding" else [*columns, "shard", "slot"])
        held[name] = [r.asDict() for r in docs.collect()]
    start = [r.asDict() for r in table(spark, SF001, "documents").collect()]
    key = lambda rows: sorted(str(sorted(r.items())) for r in rows)

    letters = [r for r in start if any(c.isalpha() for c in r["text"] or "")]
    assert key(held["language_id"]) == key(letters)

    component = {d: c for d, _, c in brute([(r["doc_id"], r["text"]) for r in letters])}
    single = [r for r in letters if component[r["doc_id"]] == r["doc_id"]]
    assert key(held["simhash_dedup"]) == key(single) and len(single) < len(letters)

    items = [D.words_of(r["text"]) for r in table(spark, SF001, "benchmark").collect()]
    clean = [r for r in single if not benchmark_in(r["text"], items)]
    assert key(held["decontaminate"]) == key(clean) and len(clean) < len(single)

    copies = Counter(r["doc_id"] for r in held["mixing"])
    sizes = Counter()
    for r in clean:
        sizes[r["source"]] += len(r["text"].split())
    target = test_mixing.plain_targets(dict(sizes))
    test_mixing.check(
        [
            (r["source"], len((r["text"] or "").encode().split()), sizes[r["source"]], target[r["source"]],
             copies[r["doc_id"]])
            for r in clean
        ]
    )
    assert {r["doc_id"] for r in held["mixing"]} <= {r["doc_id"] for r in clean}

    law_holds([(r["text"], r["shard"], r["slot"]) for r in held["sharding"]])
    plain = [{k: v for k, v in r.items() if k in columns} for r in held["sharding"]]
    assert key(plain) == key(held["mixing"])

    again = [r.asDict() for r in P.run(spark, SF001).collect()]
    assert sorted((r["doc_id"], r["shard"]) for r in again) == sorted(
        (r["doc_id"], r["shard"]) for r in held["sharding"]
    )


def test_no_labels_keep_texts_with_a_letter(spark):
    docs = odd_docs(spark).withColumn("lang", F.lit(None).cast("string"))
    kept = P.identify_language(spark, docs, SF001)
    assert kept.columns == docs.columns
    key = lambda rows: sorted(map(str, rows))
    want = [r for r in docs.collect() if any(c.isalpha() for c in r["text"] or "")]
    assert key(kept.collect()) == key(want) and 0 < len(want) < docs.count()


def test_stages_take_odd_rows_and_no_rows(spark):
    for docs in (odd_docs(spark), no_docs(spark)):
        n = docs.count()
        for name, stage in P.STAGES:
            docs = materialize(stage(spark, docs, SF001), f"odd_{name}")
        assert docs.count() > 0 if n else docs.count() == 0
