import hashlib

import pytest

tiktoken = pytest.importorskip("tiktoken")

import corpus_pipeline as C  # noqa: E402
from footfall.llm import byte_bpe, toxicity  # noqa: E402
from footfall.llm.stages import shared_dir, stage  # noqa: E402
from tests.conftest import SF_SMALL  # noqa: E402
from tests.llm import brute  # noqa: E402


def test_equal_to_brute_force(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").collect()]
    model = toxicity.learn(docs, spark.read.parquet(f"{SF_SMALL}/labels.parquet"))
    kept = [(r.doc_id, r.text) for r in docs.collect() if model.score(r.text) < toxicity.THRESHOLD]
    kept = list(brute.line_dedup(kept).items())
    prints = [brute.simhash(t) for _, t in kept]
    roots = brute.components(prints, lambda a, b: (a ^ b).bit_count() <= 4)
    smallest = {}
    for (i, _), root in zip(kept, roots):
        smallest[root] = min(smallest.get(root, i), i)
    kept = [(i, t) for (i, t), root in zip(kept, roots) if smallest[root] == i]
    kept = [(i, t) for i, t in kept if not brute.contained(t, items)]
    path = C.public_tokenizers.path(C.BPE_RANKS)
    codec = tiktoken.Encoding("own", pat_str=C.public_tokenizers.PATTERN, mergeable_ranks=byte_bpe.read_ranks(path), special_tokens={})
    want = {}
    for i, t in kept:
        ids = codec.encode_ordinary(t)
        want[i] = (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(t.encode()).hexdigest())
    got = {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in C.run(spark, SF_SMALL).collect()}
    assert got == want and 0 < len(want) < docs.count()


def test_edge_rows_through_all_stages(spark, edge_docs, no_docs):
    for docs in (edge_docs, no_docs):
        for k, (_, function) in enumerate(C.STAGES):
            columns = docs.columns
            docs = stage(function(spark, docs, SF_SMALL), "test")
            if k + 1 < len(C.STAGES):
                assert docs.columns == columns
        assert docs.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    assert docs.count() == 0


def test_stage_tables_go_when_the_next_is_written(spark):
    path = spark._jvm.org.apache.hadoop.fs.Path(shared_dir(spark))
    system = path.getFileSystem(spark._jsc.hadoopConfiguration())

    def names():
        return {f.getPath().getName() for f in system.listStatus(path)}

    kept = stage(spark.range(3), "mine")
    before = names()
    out = C.run(spark, SF_SMALL)
    assert len(names() - before) == 1 and before <= names()
    assert out.count() > 0 and kept.count() == 3
