"""The pipeline against direct forms of its stages on small tables."""

from collections import Counter, defaultdict

import pytest
from tokenizers import Tokenizer
import public_tokenizers as P

import corpus_pipeline as c
from featuremart.llm import toxicity
from featuremart.llm.common import written
from tests.conftest import SF_SMALL
from tests.llm.test_pii import brute as brute_pii
from tests.llm.test_simhash import brute_components, brute_print
from tests.llm.test_substring_dedup import brute as brute_passages


@pytest.fixture(scope="module")
def stages(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    out = [docs]
    for name, stage in c.STAGES:
        out.append(written(spark, stage(spark, out[-1], SF_SMALL), f"test-{name}"))
    return out


def texts(df):
    return {r.doc_id: r.text for r in df.select("doc_id", "text").collect()}


def test_columns(stages):
    assert all(s.columns == stages[0].columns for s in stages[:5])


def test_toxic_rows_go(spark, stages):
    model = toxicity.fit(stages[0], spark.read.parquet(f"{SF_SMALL}/labels.parquet"))
    before = texts(stages[0])
    want = {i for i, t in before.items() if model.exceed([t])[0].sum() < model.threshold}
    after = texts(stages[1])
    assert set(after) == want and all(after[i] == before[i] for i in after)
    assert 0 < len(want) < len(before)


def test_one_row_of_each_component_stays(stages):
    before = texts(stages[1])
    comp = brute_components([(i, brute_print(t)) for i, t in before.items()])
    assert texts(stages[2]) == {i: t for i, t in before.items() if comp[brute_print(t)] == i}


def test_repeated_passages_go(stages):
    before = texts(stages[2])
    want = {i: (kept if gone else t) for (i, t), (_, gone, kept) in
            zip(before.items(), brute_passages(before.values(), 35))}
    assert texts(stages[3]) == want


def test_base_personal_data_goes(stages):
    before, after = texts(stages[3]), texts(stages[4])
    assert set(before) == set(after)
    for i, t in before.items():
        assert not brute_pii(after[i])
        if not any(ch.isdigit() or ch == "@" for ch in t):
            assert after[i] == t


def test_packing_holds_every_token(stages):
    tok = Tokenizer.from_file(P.path("word_bpe_49k.json"))
    want = {i: len(tok.encode(t or "", add_special_tokens=False).ids) + 1 for i, t in texts(stages[4]).items()}
    got, seqs = Counter(), defaultdict(int)
    for r in stages[5].collect():
        got[r.doc_id] += r.length
        seqs[r.sequence_id] += r.length
    assert got == want and max(seqs.values()) <= 2048


def test_run_gives_the_last_stage(spark, stages):
    a, b = c.run(spark, SF_SMALL), stages[5]
    cols = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
    assert Counter(map(tuple, a.select(cols).collect())) == Counter(map(tuple, b.select(cols).collect()))


def test_sequences_can_be_made_from_the_result(stages):
    tok = Tokenizer.from_file(P.path("word_bpe_49k.json"))
    got = defaultdict(list)
    for r in sorted(stages[5].collect(), key=lambda r: (r.doc_id, r.start)):
        assert len(r.ids) == r.length
        got[r.doc_id] += r.ids
    assert got == {i: tok.encode(t or "", add_special_tokens=False).ids + [1] for i, t in texts(stages[4]).items()}


def test_only_the_result_stays_on_disk(spark, tmp_path):
    import os

    from featuremart.session import scratch_dir

    top = scratch_dir(spark, "").removeprefix("file:").rstrip("/")
    before = set(os.listdir(top)) if os.path.isdir(top) else set()
    out = c.run(spark, SF_SMALL)
    assert out.count() > 0
    new = set(os.listdir(top)) - before
    assert len(new) == 1 and os.listdir(os.path.join(top, new.pop())) == ["4-packing"]
