"""The corpus pipeline, stage by stage, against plain versions."""

from collections import Counter

import pytest

import corpus_pipeline
from shelfstar.llm import mixing, secrets

from . import brute
from .test_operators import empty, folder, odd_rows  # noqa: F401

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def steps(spark, tmp_path_factory):
    root, docs, seen = tmp_path_factory.mktemp("stages"), spark.read.parquet(f"{SF}/documents.parquet"), []
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, SF).write.parquet(str(root / str(i)))
        after = spark.read.parquet(str(root / str(i)))
        seen.append((docs, after))
        docs = after
    return seen


def rows(df):
    return Counter(tuple(r) for r in df.collect())


def test_all_but_the_last_keep_the_columns(steps):
    for before, after in steps[:-1]:
        assert after.columns == before.columns and after.dtypes == before.dtypes


def test_language_stage_keeps_documents_with_letters(steps):
    before, after = map(rows, steps[0])
    assert not after - before
    gone = [t for _, t, *_ in (before - after)]
    assert len(gone) < 0.02 * before.total()


def test_dedup_stage_keeps_one_of_each_group(steps):
    before, after = steps[1]
    want = {c for _, _, c in brute.simhash_groups([(r["doc_id"], r["text"]) for r in before.collect()])}
    assert Counter(r["doc_id"] for r in after.collect()) == Counter(want) and not rows(after) - rows(before)


def test_secret_stage_masks_and_leaves_the_rest(steps):
    before, after = ({r["doc_id"]: r for r in df.collect()} for df in steps[2])
    assert before.keys() == after.keys()
    novelty = secrets.Novelty()
    for key, r in before.items():
        spans = secrets.scan(r["text"], novelty)
        assert after[key]["text"] == secrets.masked(r["text"], spans, "<secret>") and after[key]["n_chars"] == len(after[key]["text"])
        assert not brute.secret_spans(after[key]["text"])


def test_mix_stage_repeats(spark, steps):
    before, after = steps[3]
    times = Counter(r["doc_id"] for r in after.collect())
    for r in mixing.mix(before).collect():
        assert times[r["doc_id"]] * r["size"] == r["taken"]


def test_last_stage_encodes(steps):
    before, after = steps[4]
    encode = brute.bpe_encoder()
    assert Counter((r["doc_id"], tuple(encode(r["text"]))) for r in before.collect()) == Counter((r["doc_id"], tuple(r["ids"])) for r in after.collect())
    assert all(r["round_trip"] and r["n_tokens"] == len(r["ids"]) for r in after.collect())


@pytest.mark.parametrize("which", ["folder", "empty"])
def test_odd_and_empty_tables(spark, which, request):
    root = request.getfixturevalue(which)
    out = corpus_pipeline.run(spark, root).collect()
    assert all(r["round_trip"] for r in out) and (out or which == "empty")
