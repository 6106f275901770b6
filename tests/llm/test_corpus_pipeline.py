import corpus_pipeline
from fleetgrain.llm import decontaminate, jaccard_groups, mixing, quality_rules, token_files

import public_tokenizers

SF = "/root/testdata/sf0.001"


def test_stages_take_effect_and_keep_the_columns(llm, documents, labels, benchmark):
    docs, counts = documents, []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        made = stage(llm, docs, SF)
        assert made.columns == documents.columns and made.dtypes == documents.dtypes
        made = llm.createDataFrame(made.collect(), made.schema)
        ids, before = [r[0] for r in made.select("doc_id").collect()], {r[0] for r in docs.select("doc_id").collect()}
        assert set(ids) <= before
        if name == "quality_rules":
            want = [r["doc_id"] for r in quality_rules.judge(docs, labels).collect() if r["kept"]]
        elif name == "near_copies":
            want = [r["doc_id"] for r in jaccard_groups.cluster(docs).collect() if r["doc_id"] == r["component_id"]]
        elif name == "benchmark_passages":
            want = [r["doc_id"] for r in decontaminate.judge(docs, benchmark).collect() if not r["contaminated"]]
        else:
            want = [r["doc_id"] for r in mixing.mix(docs).collect() for _ in range(r["copies"])]
        assert sorted(ids) == sorted(want)
        counts.append(len(ids))
        docs = made
    assert counts[0] > counts[1] > counts[2] > 0
    last = corpus_pipeline.STAGES[-1][1](llm, docs, SF).collect()
    path = public_tokenizers.path(corpus_pipeline.TOKENIZER)
    assert sorted(map(tuple, last)) == sorted(map(tuple, token_files.digests(docs, path).collect()))
    assert sorted(map(tuple, corpus_pipeline.run(llm, SF).collect())) == sorted(map(tuple, last))


def test_empty_documents_pass_all_stages(llm, documents):
    docs = documents.limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(llm, docs, SF)
    assert docs.count() == 0
