"""The pipeline's stages against plain Python, each on its own input."""

from collections import Counter

import corpus_pipeline as pipeline
from pharmaflow.llm.common import saved
from pharmaflow.llm import quality_rules as Q, sentencepiece_scan as S
from test_brute_force import WORD, near_classes

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    import sentencepiece
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    stages = dict(pipeline.STAGES)
    assert [n for n, _ in pipeline.STAGES] == ["quality_rules", "line_dedup", "near_duplicates", "mixing", "sentencepiece"]

    first = saved(stages["quality_rules"](spark, docs, SF), "t")
    assert first.columns == docs.columns
    kept = {r.doc_id for r in Q.quality_rules(docs).where("kept").collect()}
    assert {r.doc_id for r in first.collect()} == kept and 0 < len(kept) < docs.count()

    second = saved(stages["line_dedup"](spark, first, SF), "t")
    before = [r for r in first.collect()]
    pages, seen = Counter(r.source for r in before), Counter()
    for r in before:
        seen.update((r.source, x) for x in {x for x in r.text.split("\n") if WORD.search(x)})
    bad = {k for k, n in seen.items() if n >= 3 and n > 0.1 * pages[k[0]] or n >= 10 and n > 0.01 * pages[k[0]]}
    want = {r.doc_id: "\n".join(x for x in r.text.split("\n") if (r.source, x) not in bad) for r in before}
    after = second.collect()
    assert {r.doc_id: r.text for r in after} == want and all(r.n_chars == len(r.text) for r in after)

    third = saved(stages["near_duplicates"](spark, second, SF), "t")
    heads = set(near_classes([(r.doc_id, r.text) for r in after]).values())
    assert third.columns == docs.columns and sorted(r.doc_id for r in third.collect()) == sorted(heads)

    fourth = saved(stages["mixing"](spark, third, SF), "t")
    taken = Counter(r.doc_id for r in fourth.collect())
    size = {r.doc_id: len(WORD.findall(r.text)) for r in third.collect()}
    assert max(taken.values()) <= 2 and fourth.columns == docs.columns
    assert abs(sum(size[i] * n for i, n in taken.items()) - 1.5 * sum(size.values())) < 20 * max(size.values())

    sp = sentencepiece.SentencePieceProcessor(model_file=S.MODEL)
    last = stages["sentencepiece"](spark, fourth, SF).collect()
    texts = {r.doc_id: r.text for r in third.collect()}
    assert Counter(r.doc_id for r in last) == taken
    assert all(r.ids == sp.encode(texts[r.doc_id]) and r.n_tokens == len(r.ids) for r in last)
