"""The stages one after the other on the smallest tables."""

import corpus_pipeline
from pondside.llm import simhash
from pondside.llm.common import stored, table
from pondside.llm.queries import BITS, SHINGLE

SF_DIR = "/root/testdata/sf0.001"


def test_each_stage_acts_on_what_the_one_before_kept(spark):
    docs = table(spark, SF_DIR, "documents")
    columns, kept = docs.columns, [docs.count()]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stored(stage(spark, docs, SF_DIR), "test-" + name.replace(" ", "-"))
        assert docs.columns == columns
        kept.append(docs.count())
        if name == "lines once":
            lines = [x for r in docs.collect() for x in (r["text"] or "").split("\n") if len(x.strip()) >= 40]
            assert len(lines) == len(set(lines))
        if name == "one of near copies":
            prints = [simhash.fingerprint(r["text"], SHINGLE) for r in docs.collect()]
            assert all((a ^ b).bit_count() > BITS for k, a in enumerate(prints) for b in prints[:k])
    assert kept[1] < kept[0] and kept[3] < kept[2]
    coded = corpus_pipeline.STAGES[-1][1](spark, docs, SF_DIR)
    assert coded.count() == docs.count()
