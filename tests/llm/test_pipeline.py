import public_tokenizers
import tiktoken
from pyspark.sql import functions as F

import corpus_pipeline
from ridelens.llm.byte_bpe import ranks
from ridelens.llm.queries import QUERIES, SQL
from ridelens.llm.shared import materialise, read

SF = "/root/testdata/sf0.001"


def test_each_stage_acts_on_what_its_predecessor_kept(spark):
    docs = read(spark, SF, "documents")
    columns, kept = docs.columns, []
    labels = {r.doc_id: r for r in read(spark, SF, "labels").collect()}
    for name, stage in corpus_pipeline.STAGES:
        docs = materialise(stage(spark, docs, SF), name)
        kept.append(docs)
    assert all(d.columns == columns for d in kept[:-1])
    ids = [[r.doc_id for r in d.select("doc_id").collect()] for d in kept]
    assert len(ids[0]) > len(ids[1]) and set(ids[0]) >= set(ids[1]) >= set(ids[2]) and sorted(ids[2]) == sorted(ids[3])
    good = {i for i, r in labels.items() if r.quality == 1}
    bad = {i for i, r in labels.items() if r.quality == 0}
    # 87 labelled rows train little, but good documents stay
    assert len(good & set(ids[0])) >= 0.95 * len(good) and len(bad & set(ids[0])) < len(bad)
    from test_minhash_dedup import brute_force

    left = [(r.doc_id, r.text) for r in kept[0].collect()]
    assert set(ids[1]) == {i for i, (_, top) in brute_force(left).items() if i == top}
    library = tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks(public_tokenizers.path("byte_bpe_50k.tiktoken")), special_tokens={}
    )
    texts = dict(left)
    assert all(r.n_tokens == len(library.encode_ordinary(texts[r.doc_id])) for r in kept[3].collect())


def test_the_registered_queries():
    assert sorted(int(name[2:].split("_")[0]) for name in QUERIES) == list(range(1, 14))
    assert set(SQL) <= set(QUERIES)


def test_empty_documents_go_through(spark):
    docs = read(spark, SF, "documents").limit(0)
    for name, stage in corpus_pipeline.STAGES:
        docs = materialise(stage(spark, docs, SF), name)
        assert docs.count() == 0


def test_odd_rows_and_clashing_columns_go_through(spark):
    own = read(spark, SF, "documents")
    extra = ["order", "copies", "key", "label", "rate", "score", "place", "component_id", "doc", "id", "id_order"]
    docs = own.select("*", *(F.lit(k).alias(name) for k, name in enumerate(extra)))
    one = own.orderBy("doc_id").first()
    long = "word " * 60_000 + "x" * 1500
    odd = [(None, None), (None, "a null id"), (900_001, None), (900_002, ""), (900_003, long), (900_003, "the same id, another text")]
    odd += [(one.doc_id, one.text)] * 3
    rows = spark.createDataFrame(odd, "doc_id long, text string")
    docs = docs.unionByName(rows, allowMissingColumns=True)
    columns, dtypes = docs.columns, docs.dtypes
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = materialise(stage(spark, docs, SF), name)
        assert docs.columns == columns and docs.dtypes == dtypes
        assert docs.where("score = 5").count() > 0  # the values of the extra columns go with their rows
    out = corpus_pipeline.STAGES[-1][1](spark, docs, SF)
    assert out.count() == docs.count()
    assert docs.where(F.col("doc_id") == one.doc_id).select("text").distinct().count() <= 1
