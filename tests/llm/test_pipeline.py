"""The pipeline's stages, one after the other, against brute force on a small table."""

import re

import pytest

import corpus_pipeline
from marketlake.llm import personal_data, toxicity

LOWER = {i: i + 32 for i in range(65, 91)}
WORD = re.compile(r"[^\W_]+")


def shingles(text, n, pattern):
    w = pattern.findall(text.lower())
    return {tuple(w[i : i + n]) for i in range(len(w) - n + 1)}


def test_stages_one_by_one(spark, smallest_dir, tmp_path):
    docs = spark.read.parquet(f"{smallest_dir}/documents.parquet")
    labels = spark.read.parquet(f"{smallest_dir}/labels.parquet")
    items = [shingles(r["text"], 5, WORD) for r in spark.read.parquet(f"{smallest_dir}/benchmark.parquet").collect()]
    score = toxicity.fit(docs, labels).scorer()
    before = {r["doc_id"]: r.asDict() for r in docs.collect()}
    for n, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, smallest_dir)
        out.write.parquet(f"{tmp_path}/{n}")
        docs = spark.read.parquet(f"{tmp_path}/{n}")
        after = {r["doc_id"]: r.asDict() for r in docs.collect()}
        if name == "toxicity":
            assert set(after) == {i for i, r in before.items() if score(r["text"]) < 0.5}
        elif name == "jaccard_join":
            split = {i: re.findall(r"[^\x20\x09-\x0D]+", r["text"].translate(LOWER)) for i, r in before.items()}
            sets = {i: {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set() for i, w in split.items()}
            near = lambda a, b: len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]) and sets[a]
            assert all(any(near(i, j) for j in before if j != i) for i in set(before) - set(after))
            assert not [1 for i in after for j in after if i < j and near(i, j)]
        elif name == "decontamination":
            leaky = {i for i, r in before.items() if any(len(s & shingles(r["text"], 5, WORD)) >= 0.8 * len(s) for s in items if s)}
            assert leaky and set(after) == set(before) - leaky
        elif name == "personal_data":
            assert set(after) == set(before) and not any(personal_data.base_spans(r["text"]) for r in after.values())
            assert all(r["n_chars"] == len(r["text"]) for r in after.values())
        else:
            tokenizers = pytest.importorskip("tokenizers")
            library = tokenizers.Tokenizer.from_file(pytest.importorskip("public_tokenizers").path("byte_bpe_50k.json"))
            assert {i: library.encode(r["text"], add_special_tokens=False).ids for i, r in before.items()} == {i: r["ids"] for i, r in after.items()}
        before = after
    assert before
