"""The pipeline's stages one by one, against plain Python over what each was given."""

import numpy as np
from tokenizers import Tokenizer

import corpus_pipeline
from llm import plain
from tallykeep.llm import quality, queries

FOLDER = "/root/testdata/sf0.001"


def test_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    given = {r.doc_id: r for r in docs.collect()}
    benchmark = [tuple(r) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").select("item_id", "text").collect()]
    columns, results = docs.columns, []
    for number, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, FOLDER).write.parquet(str(tmp_path / str(number)))
        docs = spark.read.parquet(str(tmp_path / str(number)))
        results.append({r.doc_id: r for r in docs.collect()})
        assert number == 4 or docs.columns == columns
    good, first, clean, safe, encoded = results

    def passes(text):
        n, chars, symbols, _, again = plain.quality(text)
        return n >= quality.LEAST_WORDS and 100 * again <= 50 * n and symbols <= 0.2 * n

    assert set(good) == {i for i, r in given.items() if passes(r.text)}
    groups = plain.components([(i, r.text) for i, r in good.items()], 5, 80)
    assert set(first) == {i for i, (_, group) in groups.items() if group == i}
    leaking = {i for i, *_ in plain.leaks([(i, r.text) for i, r in first.items()], benchmark)}
    assert leaking and set(clean) == set(first) - leaking
    assert set(safe) == set(clean) == set(encoded)
    library = Tokenizer.from_file(queries.vocabulary())
    for i, row in safe.items():
        assert (row.text == clean[i].text) or "[" in row.text
        assert row.n_chars == len(row.text) and not plain.personal(row.text)
        ids = library.encode(row.text, add_special_tokens=False).ids
        assert encoded[i].ids == ids
        assert encoded[i].ids_sha256 == plain.hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()


def test_run_is_the_stages_in_order(spark):
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "quality rules", "n-gram Jaccard join", "benchmark decontamination", "PII", "BPE encoding and decoding",
    ]
    assert corpus_pipeline.run(spark, FOLDER).count() > 0


def test_stages_on_an_empty_table(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, FOLDER)
        assert out.count() == 0
        docs = out if out.columns == docs.columns else docs
